"""Two splits published as one, and outputs that would harm inputs."""

import os

import pytest

import turnmill as tm
from turnmill.plans import prepare as job
from turnmill.sinks import publish as pub

PAIRS = "id int, Context string, Response string"


def pairs(spark, n, word="question"):
    return spark.createDataFrame([(i, f"{word} {i} one", "answer number one") for i in range(n)], PAIRS)


def texts(spark, out):
    found = tm.published(spark, out)
    return {name: {r["messages"][0]["content"] for r in tm.read_jsonl(spark, path).collect()} for name, path in found.paths.items()}


def test_the_pair_before_stays_until_the_new_one_is_whole(spark, tmp_path, monkeypatch):
    out = str(tmp_path / "o")
    config = tm.PrepareConfig(out=out, train_split=0.5)
    first = tm.prepare_to_jsonl(pairs(spark, 40), "id", config)
    old = texts(spark, out)
    assert {k: len(v) for k, v in old.items()} == {"train": 20, "val": 20} == tm.published(spark, out).rows

    def broken(*_):
        raise OSError("lost")

    for place, name in ((job, "publish"), (pub, "_write")):
        with monkeypatch.context() as patch:
            patch.setattr(place, name, broken)
            with pytest.raises(OSError):
                tm.prepare_to_jsonl(pairs(spark, 10, "other"), "id", config)
        assert texts(spark, out) == old and tm.published(spark, out).paths["train"] == first.train_path

    report = tm.prepare_to_jsonl(pairs(spark, 10, "other"), "id", config)
    assert (report.train, report.val) == (5, 5)
    assert all(t.startswith("other") for split in texts(spark, out).values() for t in split)
    # A reader of the version before is not disturbed; the one before that is removed.
    assert tm.read_jsonl(spark, first.train_path).count() == 20
    tm.prepare_to_jsonl(pairs(spark, 10, "third"), "id", config)
    assert not os.path.exists(first.train_path) and tm.read_jsonl(spark, report.train_path).count() == 5


def test_rows_of_no_split_are_refused(spark, tmp_path):
    rows = spark.createDataFrame([("train", 1), ("test", 2), (None, 3)], "split string, n int")
    with pytest.raises(ValueError, match="2 rows"):
        tm.publish_splits(rows, str(tmp_path / "o"))
    with pytest.raises(FileNotFoundError):
        tm.published(spark, str(tmp_path / "o"))


@pytest.mark.parametrize("table, out", [("rel/split=train", "rel"), ("rel/in", "./rel/"), ("rel/in", "x/../rel"), ("rel/versions/v/split=val", "file:{}/rel"), ("rel", "rel")])
def test_an_output_folder_that_holds_the_input_is_refused(spark, tmp_path, monkeypatch, table, out):
    # Relative paths are taken from Hadoop's working folder, which is that of the JVM.
    here = str(spark._jvm.org.apache.hadoop.fs.FileSystem.getLocal(spark._jsc.hadoopConfiguration()).getWorkingDirectory().toUri().getPath())
    start = os.path.relpath(tmp_path, here)
    pairs(spark, 100).write.parquet(str(tmp_path / table))
    place = out.format(tmp_path) if out.startswith("file:") else f"{start}/{out}"
    for path in (str(tmp_path / table), f"{start}/{table}"):
        with pytest.raises(ValueError, match="lie in each other"):
            tm.prepare_to_jsonl(spark.read.parquet(path), "id", tm.PrepareConfig(out=place))
    assert spark.read.parquet(str(tmp_path / table)).count() == 100


def test_a_folder_whose_name_only_begins_alike_is_no_obstacle(spark, tmp_path):
    pairs(spark, 10).write.parquet(str(tmp_path / "rel-in a"))
    report = tm.prepare_to_jsonl(spark.read.parquet(str(tmp_path / "rel-in a")), "id", tm.PrepareConfig(out=str(tmp_path / "rel")))
    assert report.kept == 10
