"""What the physical plans must look like for the jobs to hold at scale."""

import pytest

import turnmill as tm
from checks.queries import QUERIES
from checks import frames
from tests.plantools import main_nodes, plan_text as plan
from turnmill.functions import pii


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_and_no_cross_join(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    own = ["EvalPython", "MapInPandas"] if name != "filter_long_counted" else []  # the caller's counter is Python
    for node in (*own, "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in text


NARROW = ["filter_valid", "redact_all", "clean_text", "filter_long", "prepare_splits", "split_exact", "validate_messages_json"]


@pytest.mark.parametrize("name", NARROW)
def test_narrow_queries_do_not_shuffle(spark, sf_dir, name):
    nodes = main_nodes(QUERIES[name](spark, sf_dir))
    assert any(n.startswith("Scan parquet") for n in nodes) and "Exchange" not in nodes


@pytest.mark.parametrize("name", ["preview", "smoke_sample", "schema_report", "first_responses"])
def test_first_rows_are_a_top_n(spark, sf_dir, name):
    assert "TakeOrderedAndProject" in plan(QUERIES[name](spark, sf_dir))


def test_redaction_runs_once_in_curate(spark, sf_dir):
    text = tm.curate(frames.doc_samples(spark, sf_dir))._jdf.queryExecution().optimizedPlan().toString()
    assert text.count(pii.SSN.replace(r"\d", pii.DIGIT)) == 1


def test_statistics_shuffle_only_partial_sums(spark, sf_dir):
    samples = frames.doc_samples(spark, sf_dir)
    text = plan(tm.dataset_stats(samples))
    assert text.count("Exchange") == 1 and "partial_sum" in text and "Generate" in text
    assert "explode" not in text


def test_split_reads_only_the_key_for_the_cut(spark, sf_dir):
    docs = frames.table(spark, sf_dir, "documents")
    explained = tm.split_exact(docs, "doc_id")._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    schemas = [line for line in explained.splitlines() if line.startswith("ReadSchema")]
    assert schemas.count("ReadSchema: struct<doc_id:bigint>") == len(schemas) - 1


def test_pairs_order_only_the_ends_of_stretches_per_conversation(spark, sf_dir):
    """The one window over whole conversations reads an aggregate, a row per stretch."""
    text = plan(QUERIES["turn_pairs_sparse"](spark, sf_dir))
    whole = [line for line in text.splitlines() if "Window [" in line and "_first" in line]
    inside = [line for line in text.splitlines() if "Window [" in line and "_first" not in line]
    assert whole and inside and all("_stretch" in line.split("windowspecdefinition")[1] for line in inside)



def test_numbering_moves_no_wide_rows(spark, sf_dir):
    """Texts are neither range-partitioned nor written to be numbered."""
    text = plan(QUERIES["eval_prompt_file"](spark, sf_dir))
    assert "rangepartitioning" not in text and "Exchange hashpartitioning" not in text.split("BroadcastExchange")[0]
    numbered = plan(tm.number_rows(frames.table(spark, sf_dir, "conversations"), "conv_id", "turn"))
    assert "BroadcastHashJoin" in numbered and "rangepartitioning" not in numbered and "text" not in numbered.split("numbered")[-1]
