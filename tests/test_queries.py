"""Every registered query against its SQL, over the whole tables."""

import pytest

from __spark_entry__ import entry, queries
from checks.oracles import ORACLES
from checks.queries import QUERIES
from tests.compare import differences, views


@pytest.fixture(scope="module")
def con(sf_dir):
    return views(sf_dir)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES) and set(QUERIES) <= set(queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, con, name):
    assert differences(QUERIES[name](spark, sf_dir), con, ORACLES[name]) == []


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["doc_id", "split", "first_role", "question", "second_role", "answer"]
    assert {r["split"] for r in df.select("split").collect()} == {"train", "val"}


def test_queries_are_not_vacuous(spark, sf_dir):
    """The inputs exercise the branches they are there for."""
    known = queries()
    raw = known["validate_messages_json"](spark, sf_dir).groupBy("valid").count().count()
    rules = {r["rule"] for r in known["schema_issues_json"](spark, sf_dir).select("rule").distinct().collect()}
    results = known["eval_results"](spark, sf_dir).collect()
    assert raw == 2
    assert rules == {"missing_messages", "message_count", "first_role", "second_role", "missing_content"}
    assert {r["error"] for r in results} == {
        None,
        "no response",
        "response too long",
        "Sample must have 'messages' or 'prompt' field",
    }
    answered = [r for r in results if r["error"] is None]
    assert {r["n_metadata"] for r in answered} == {0, 1}
    assert {r["prompt"].startswith("Q: ") for r in answered} == {True, False}
    kept = known["filter_long"](spark, sf_dir).count()
    assert 0 < kept < known["scan_pairs"](spark, sf_dir).count()
