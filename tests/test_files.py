import json

import pytest
from py4j.protocol import Py4JError
from pyspark.errors import PySparkException

import turnmill as tm
from turnmill import schemas
from turnmill.storage import scratch_path


def write(path, text):
    path.write_text(text, encoding="utf-8", newline="")
    return str(path)


def sample(text):
    return json.dumps({"messages": [{"role": "user", "content": text}]}, ensure_ascii=False)


def test_blank_lines_and_line_endings(spark, tmp_path):
    text = f"{sample('a')}\n\n  \t\n 　\n{sample('é')}\r\n\r\n{sample('c')}\r{sample('d')}"
    rows = tm.read_jsonl(spark, write(tmp_path / "x.jsonl", text)).collect()
    assert [r["messages"][0]["content"] for r in rows] == ["a", "é", "c", "d"]


def test_malformed_line_fails(spark, tmp_path):
    path = write(tmp_path / "x.jsonl", sample("a") + '\n{"messages": [\n')
    with pytest.raises((PySparkException, Py4JError), match="(?i)malformed"):
        tm.read_jsonl(spark, path).collect()


def test_malformed_line_can_be_set_aside(spark, tmp_path):
    path = write(tmp_path / "x.jsonl", sample("a") + '\n{"messages": [\n')
    schema = schemas.T.StructType([*schemas.MESSAGES.fields, schemas.T.StructField("_corrupt_record", schemas.T.StringType())])
    rows = tm.read_jsonl(spark, path, schema, mode="PERMISSIVE").collect()
    assert [r["_corrupt_record"] for r in rows] == [None, '{"messages": [']


def test_schema_can_be_found_in_the_files(spark, tmp_path):
    path = write(tmp_path / "x.jsonl", '{"a": 1, "messages": [{"role": "user", "content": "x", "n": 2}]}\n\u00a0\n{"b": "y"}\n')
    df = tm.read_jsonl(spark, path, schema=None)
    assert df.columns == ["a", "b", "messages"]
    assert [(r["a"], r["b"]) for r in df.collect()] == [(1, None), (None, "y")]


def test_write_returns_the_count_and_replaces(spark, tmp_path):
    out = str(tmp_path / "out")
    df = spark.createDataFrame([(1, "é", None), (2, "b", "x")], "a int, b string, c string")
    assert tm.write_jsonl(df, out) == 2
    assert tm.write_jsonl(df, out) == 2
    lines = sorted(line for f in (tmp_path / "out").glob("part-*") for line in f.read_text(encoding="utf-8").splitlines())
    assert lines == ['{"a":1,"b":"é"}', '{"a":2,"b":"b","c":"x"}']
    tm.write_jsonl(df, out, keep_nulls=True)
    assert any('"c":null' in f.read_text(encoding="utf-8") for f in (tmp_path / "out").glob("part-*"))


def test_splits(spark, tmp_path):
    train, val = write(tmp_path / "train.jsonl", sample("a") + "\n" + sample("b")), write(tmp_path / "val.jsonl", sample("c"))
    both = tm.load_splits(spark, {"train": train, "validation": val})
    assert {k: v.count() for k, v in both.items()} == {"train": 2, "validation": 1}
    assert {r["split"]: r["num_samples"] for r in tm.split_counts(tm.union_splits(both)).collect()} == {"train": 2, "validation": 1}
    assert list(tm.load_splits(spark, {"train": train, "validation": None})) == ["train"]


def test_pick_split():
    assert tm.pick_split({"test": 1, "train": 2}) == 2
    assert tm.pick_split({"test": 1, "dev": 2}) == 1


@pytest.mark.parametrize("format", ["parquet", "json", "csv"])
def test_pairs_from_any_format(spark, tmp_path, format):
    path = str(tmp_path / format)
    df = spark.createDataFrame([('say "x",\nthen y', "ok\n\nfine")], schemas.PAIRS)
    writer = df.write.option("escape", '"').option("header", True) if format == "csv" else df.write
    writer.format(format).save(path)
    assert [tuple(r) for r in tm.read_pairs(spark, path, format).collect()] == [('say "x",\nthen y', "ok\n\nfine")]


def test_eval_prompts_are_numbered_in_input_order(spark, tmp_path):
    lines = [json.dumps({"prompt": f"p{i}", "metadata": {"category": "c"}}) for i in range(500)]
    path = write(tmp_path / "eval.jsonl", "\n\n".join(lines))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4000")
    try:
        rows = tm.read_eval_prompts(spark, path).orderBy("sample_id").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [(r["sample_id"], r["prompt"]) for r in rows] == [(i + 1, f"p{i}") for i in range(500)]
    assert rows[0]["metadata"] == {"category": "c"} and rows[0]["messages"] is None


class _Session:
    """A session without a checkpoint folder."""

    class conf:
        @staticmethod
        def get(name, default):
            return default

    def __init__(self, master):
        self.sparkContext = self
        self.master = master
        self.folder = None

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def test_a_cluster_needs_a_shared_folder():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_path(_Session("spark://host:7077"), "x")


def test_a_local_session_gets_a_folder_once():
    session = _Session("local[2]")
    first, second = scratch_path(session, "x"), scratch_path(session, "x")
    assert first != second
    assert first.startswith(session.folder + "/x-") and second.startswith(session.folder + "/x-")


def test_scratch_is_under_the_named_folder(spark):
    assert scratch_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir") + "/x-")
