import json
from pathlib import Path

import pytest

import turnmill as tm
from checks import frames
from turnmill.operators.evals import unmatched_responses


def test_prepare_job(spark, sf_dir, tmp_path):
    pairs = frames.doc_pairs(spark, sf_dir)
    config = tm.PrepareConfig(out=str(tmp_path / "out"), preview=3)
    report = tm.prepare_to_jsonl(pairs, "doc_id", config)
    lazy = tm.prepare(pairs, "doc_id", config)

    assert report.total == pairs.count() and report.kept == lazy.count()
    assert report.skipped == report.total - report.kept
    assert report.train == int(report.kept * 0.97) and report.train + report.val == report.kept

    order = {r["doc_id"]: r["messages"] for r in lazy.collect()}
    for name, path, size in (("train", report.train_path, report.train), ("val", report.val_path, report.val)):
        files = sorted(Path(path).glob("part-*"))
        lines = [json.loads(line) for f in files for line in f.read_text(encoding="utf-8").split("\n") if line]
        want = tm.seeded_order(lazy.where(f"split = '{name}'"), "doc_id").collect()
        assert [line["messages"] for line in lines] == [[m.asDict() for m in r["messages"]] for r in want]
        assert list(lines[0]) == ["messages"] and len(lines) == size
        assert tm.read_jsonl(spark, path).count() == size

    shown = report.preview.collect()
    first = [r["doc_id"] for r in tm.seeded_order(lazy.where("split = 'train'"), "doc_id").limit(3).collect()]
    assert [r["doc_id"] for r in sorted(shown)[::2]] == first
    assert set(first) <= set(order)


PAIRS = "id int, Context string, Response string"


@pytest.mark.parametrize("ids", [[1, 1, 2], [1, None, 2]])
def test_prepare_needs_unique_keys(spark, tmp_path, ids):
    pairs = spark.createDataFrame([(i, "question one", "answer number one") for i in ids], PAIRS)
    with pytest.raises(ValueError):
        tm.prepare_to_jsonl(pairs, "id", tm.PrepareConfig(out=str(tmp_path / "o")))
    assert not (tmp_path / "o").exists()


def test_prepare_replaces_nothing_else(spark, tmp_path):
    out = tmp_path / "o"
    out.mkdir()
    (out / "notes.txt").write_text("mine")
    pairs = spark.createDataFrame([(i, f"question {i} one", "answer number one") for i in range(40)], PAIRS)
    for _ in range(2):
        report = tm.prepare_to_jsonl(pairs, "id", tm.PrepareConfig(out=str(out), train_split=0.5))
        assert (report.train, report.val) == (20, 20) and tm.read_jsonl(spark, report.train_path).count() == 20
    assert (out / "notes.txt").read_text() == "mine"


def test_prepare_refuses_to_write_over_its_input(spark, tmp_path):
    table = str(tmp_path / "o" / "in")
    spark.createDataFrame([(1, "question one", "answer number one")], PAIRS).write.parquet(table)
    with pytest.raises(ValueError):
        tm.prepare_to_jsonl(spark.read.parquet(table), "id", tm.PrepareConfig(out=str(tmp_path / "o")))
    assert spark.read.parquet(table).count() == 1


def test_responses_that_cannot_be_placed(spark):
    prompts = spark.createDataFrame([(1, "a"), (2, "b")], "sample_id long, prompt string")
    responses = spark.createDataFrame([(1, "x", None), (1, "y", None), (9, "z", None)], "sample_id long, response string, error string")
    assert sorted(map(tuple, unmatched_responses(prompts, responses).collect())) == [(1, 2), (9, 1)]


def test_prepare_with_an_empty_split(spark, tmp_path):
    pairs = spark.createDataFrame([(1, "question one", "answer number one")], "id int, Context string, Response string")
    report = tm.prepare_to_jsonl(pairs, "id", tm.PrepareConfig(out=str(tmp_path / "o"), train_split=1.0))
    assert (report.train, report.val) == (1, 0)
    assert tm.read_jsonl(spark, report.val_path).count() == 0


def test_results_on_disk(spark, tmp_path):
    prompts = spark.createDataFrame(
        [(1, [("user", "hi")], None, {"category": "x"}), (2, [("user", "ho")], "P", None), (3, None, None, None), (4, [("user", "no")], "", None)],
        "sample_id long, messages array<struct<role:string,content:string>>, prompt string, metadata map<string,string>",
    )
    responses = spark.createDataFrame([(1, "r1", None), (2, "r2", None), (3, "r3", None), (4, None, "out of memory")], "sample_id long, response string, error string")
    out = tmp_path / "results"
    assert tm.write_results(prompts, responses, str(out), tm.GenerationParams(temperature=1)) == 4
    records = [json.loads(line) for f in sorted(out.glob("part-*")) for line in f.read_text().splitlines()]
    params = {"max_new_tokens": 256, "temperature": 1.0, "top_p": 0.9}
    assert records == [
        {"sample_id": 1, "prompt": "hi", "response": "r1", "metadata": {"category": "x"}, "generation_params": params},
        {"sample_id": 2, "prompt": "P", "response": "r2", "metadata": {}, "generation_params": params},
        {"sample_id": 3, "error": "Sample must have 'messages' or 'prompt' field"},
        {"sample_id": 4, "error": "out of memory"},
    ]
    results = tm.assemble_results(prompts, responses)
    assert tm.eval_summary(results).first().asDict() == {"total": 4, "errors": 2}
    # Errors are left out after taking three.
    assert [r["sample_id"] for r in tm.first_responses(results).collect()] == [1, 2]
    assert tm.eval_preview(results).where("sample_id = 1").first()["prompt"] == "hi..."


def test_prompt_table_without_optional_columns(spark):
    prompts = spark.createDataFrame([(1, "hello")], "sample_id long, prompt string")
    responses = spark.createDataFrame([(1, "r", None)], "sample_id long, response string, error string")
    row = tm.assemble_results(prompts, responses).first()
    assert (row["prompt"], row["metadata"], row["error"]) == ("hello", {}, None)


def test_an_empty_message_list_cannot_be_recorded(spark):
    prompts = spark.createDataFrame(
        [(1, [], None), (2, [], "p"), (3, [], "")], "sample_id long, messages array<struct<role:string,content:string>>, prompt string"
    )
    responses = spark.createDataFrame([(1, "r", None), (2, "r", None), (3, None, "boom")], "sample_id long, response string, error string")
    rows = {r["sample_id"]: (r["prompt"], r["error"]) for r in tm.assemble_results(prompts, responses).collect()}
    assert rows == {1: (None, "list index out of range"), 2: ("p", None), 3: (None, "boom")}


def test_stateless_steps_accept_a_stream(spark, sf_dir, tmp_path):
    """The narrow operators give the same rows on a file stream as on the table."""
    table = frames.table(spark, sf_dir, "documents").selectExpr("doc_id", "lang as Context", "text as Response")
    table.repartition(3).write.parquet(str(tmp_path / "in"))

    def steps(df):
        return df.transform(tm.filter_valid, 2, 5000).transform(tm.pairs_to_messages).transform(tm.curate)

    stream = steps(spark.readStream.schema(table.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in")))
    query = (
        stream.select("doc_id", "text")
        .writeStream.format("parquet")
        .option("path", str(tmp_path / "out"))
        .option("checkpointLocation", str(tmp_path / "cp"))
        .trigger(availableNow=True)
        .start()
    )
    assert query.awaitTermination(120)
    got = sorted(spark.read.parquet(str(tmp_path / "out")).collect())
    assert got and got == sorted(steps(table).select("doc_id", "text").collect())


@pytest.mark.parametrize("name", ["train", "val"])
def test_prepare_is_the_same_for_any_layout(spark, sf_dir, name):
    pairs = frames.doc_pairs(spark, sf_dir)
    one = tm.prepare(pairs.repartition(1), "doc_id").where(f"split = '{name}'").select("doc_id").collect()
    many = tm.prepare(pairs.repartition(17), "doc_id").where(f"split = '{name}'").select("doc_id").collect()
    assert sorted(one) == sorted(many)
