"""JSON Lines whose values keep their types, lines that are no records, streams, counters, and numbering in place."""

import json

import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F

import turnmill as tm
from checks import frames
from tests.plantools import plan_text
from turnmill.operators.order import number_lines

MIXED = [
    {"id": 1, "a": [1], "b": {"c": 1.5}, "n": None},
    {"id": "q", "a": "x", "b": {"c": "1.5", "d": [{}]}, "n": None},
    {"id": [1, "2", None], "a": True, "b": {"c": 12345678901234567890}, "odd name": "é"},
    {"id": {"k": [0.1]}, "a": 1e300, "b": {}, "text": "plain"},
]


def lines_of(folder):
    return [json.loads(x) for f in sorted(folder.glob("part-*")) for x in f.read_text(encoding="utf-8").split("\n") if x]


def without_nulls(value):
    return {k: v for k, v in value.items() if v is not None}


def test_values_keep_their_types(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.jsonl").write_text("\n".join(json.dumps(x) for x in MIXED) + "\n  \n", encoding="utf-8")
    df = tm.read_jsonl(spark, str(tmp_path / "in"))
    types = dict(df.dtypes)
    assert types["text"] == "string" and types["id"] == types["a"] == "variant"
    tm.write_jsonl(df, str(tmp_path / "out"))
    exact = lambda r: json.dumps(r, sort_keys=True)
    order = lambda rows: sorted((without_nulls(r) for r in rows), key=exact)
    assert order(lines_of(tmp_path / "out")) == order(MIXED)
    tm.write_records(tm.read_records(spark, str(tmp_path / "in")), str(tmp_path / "exact"))
    assert sorted(lines_of(tmp_path / "exact"), key=exact) == sorted(MIXED, key=exact)


def test_fields_of_one_type_are_typed(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"messages": [{"role": "user", "content": "x"}], "n": 1}\n{"n": 2}\n')
    df = tm.read_jsonl(spark, str(tmp_path / "a.jsonl"))
    assert dict(df.dtypes) == {"messages": "array<struct<content:string,role:string>>", "n": "bigint"}
    (tmp_path / "empty.jsonl").write_text("\n")
    assert tm.read_jsonl(spark, str(tmp_path / "empty.jsonl")).count() == 0


def test_quarantine(spark, tmp_path):
    bad = ["{", "[1]", "5", '"x"', '{"a": 1, "a": 2}', "null"]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.jsonl").write_text("\n".join(['{"a": 1}', *bad[:3], ""]))
    (tmp_path / "in" / "b.jsonl").write_text("\n".join(['{"a": "x", "b": 2}', "  ", *bad[3:]]))
    good, rest = tm.quarantine_jsonl(spark, str(tmp_path / "in"))
    assert sorted((r["a"], r["b"]) for r in good.select(F.to_json("a").alias("a"), "b").collect()) == [('"x"', 2), ("1", None)]
    got = {(r["file"].rsplit("/", 1)[1], r["text"]): r["reason"] for r in rest.collect()}
    assert got == {
        ("a.jsonl", "{"): "not valid JSON",
        ("a.jsonl", "[1]"): "not an object",
        ("a.jsonl", "5"): "not an object",
        ("b.jsonl", '"x"'): "not an object",
        ("b.jsonl", '{"a": 1, "a": 2}'): "not valid JSON",
        ("b.jsonl", "null"): "not an object",
    }
    schema = spark.createDataFrame([], "a long, b long").schema
    good, rest = tm.quarantine_jsonl(spark, str(tmp_path / "in"), schema)
    assert [tuple(r) for r in good.collect()] == [(1, None)]
    assert {r["text"]: r["reason"] for r in rest.collect()}['{"a": "x", "b": 2}'] == "does not fit the schema"


def test_all_lines_good_or_all_bad(spark, tmp_path):
    (tmp_path / "g").write_text('{"a": 1}\n')
    (tmp_path / "b").write_text("oops\n")
    good, bad = tm.quarantine_jsonl(spark, str(tmp_path / "g"))
    assert good.count() == 1 and bad.count() == 0
    good, bad = tm.quarantine_jsonl(spark, str(tmp_path / "b"))
    assert good.count() == 0 and bad.count() == 1


def test_stream_goes_on_where_it_stopped(spark, sf_dir, tmp_path):
    docs = frames.table(spark, sf_dir, "documents")
    half = F.col("doc_id") % 2 == 0
    docs.where(half).repartition(3).write.parquet(str(tmp_path / "in"))
    out, log = str(tmp_path / "out"), str(tmp_path / "log")

    def run():
        stream = tm.read_files(spark, str(tmp_path / "in"), docs.schema, files=1)
        tm.write_files(tm.curate_pairs(frames.pairs_of(stream), "doc_id"), out, log)
        return spark.read.parquet(out)

    wanted = tm.curate_pairs(frames.pairs_of(docs), "doc_id")
    rows = lambda df: sorted((r["doc_id"], repr(r["messages"]), r["split"]) for r in df.collect())
    assert rows(run()) == rows(wanted.where(half))
    docs.where(~half).write.mode("append").parquet(str(tmp_path / "in"))
    assert rows(run()) == rows(wanted) == rows(run())


def test_counter_is_set_up_once_and_sees_batches(spark, tmp_path):
    seen = str(tmp_path / "seen")

    def make():
        import uuid

        open(f"{seen}-{uuid.uuid4().hex}", "w").close()
        return lambda texts: pc.binary_length(texts)

    samples = spark.range(5000).selectExpr("id", "array(named_struct('role', 'user', 'content', repeat('x', CAST(id % 20 AS INT)))) AS messages").repartition(2)
    for _ in range(2):
        kept = tm.filter_long(samples, counter=tm.arrow_counter(make, f"test {seen}"), max_length=9, special_tokens=2)
        assert kept.count() == 5000 * 8 // 20
        assert plan_text(kept).count("ArrowEvalPython") == 1
    assert 1 <= len(list(tmp_path.glob("seen-*"))) <= 8


def test_counter_that_loses_texts_fails(spark):
    samples = spark.createDataFrame([([("user", "x")],)], "messages array<struct<role: string, content: string>>")
    with pytest.raises(Exception, match="0 counts for 1 texts"):
        tm.filter_long(samples, counter=tm.arrow_counter(lambda: lambda texts: pa.array([], pa.int64()))).collect()


def test_lines_are_numbered_where_they_lie(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for name in "abc":
        (tmp_path / "in" / name).write_text("".join(f"{name}{i:06d}\n" for i in range(4000)))
    sizes = {"spark.sql.files.maxPartitionBytes": "7000", "spark.sql.files.openCostInBytes": "10"}
    before = {k: spark.conf.get(k) for k in sizes}
    try:
        for k, v in sizes.items():
            spark.conf.set(k, v)
        df = number_lines(spark.read.text(str(tmp_path / "in")).where("NOT value LIKE '%7'"))
        got = [r["value"] for r in df.orderBy("sample_id").collect()]
        assert "Exchange hashpartitioning" not in plan_text(df.select("sample_id", "value")).split("BroadcastExchange")[0]
        assert [r["sample_id"] for r in df.orderBy("sample_id").collect()] == list(range(1, len(got) + 1))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == [f"{n}{i:06d}" for n in "abc" for i in range(4000) if i % 10 != 7]


def test_wide_rows_stay_when_they_are_numbered(spark):
    df = spark.range(1000).selectExpr("id % 37 AS a", "id AS b", "repeat('w', 50) AS wide")
    numbered = tm.number_rows(df, "a", "b")
    got = [(r["a"], r["b"], r["sample_id"]) for r in numbered.orderBy("sample_id").collect()]
    assert got == [(a, b, i + 1) for i, (a, b) in enumerate(sorted((i % 37, i) for i in range(1000)))]
    assert "rangepartitioning" not in plan_text(numbered)
    ties = tm.number_rows(df.select("a", "wide"), "a").collect()
    assert sorted(r["sample_id"] for r in ties) == list(range(1, 1001))


def test_hits_are_counted_as_they_are_replaced(spark):
    texts = ["5551234567@x.com and 5551234567.b@y.org 123-45-6789@z.org", "call 555-123-4567, id 123-45-6789", "555.123.4567.89 no", None]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    got = {r["kind"]: (r["n_hits"], r["n_rows"]) for r in tm.pii_counts(df).collect()}
    assert got["email"] == (3, 1) and got["ssn"] == (1, 1) and got["phone"][0] >= 1
    redacted = df.select(tm.redact_pii(F.col("text")).alias("t")).collect()
    assert sum((r["t"] or "").count("[REDACTED]") for r in redacted) == sum(n for n, _ in got.values())
