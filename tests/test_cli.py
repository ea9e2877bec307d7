import json

from pyspark.sql import functions as F

import turnmill as tm
from turnmill.__main__ import main, parse


def test_defaults():
    args = parse(["prepare", "pairs.parquet"])
    assert (args.out, args.train_split, args.min_length, args.max_length, args.seed, args.preview) == (
        "./outputs/datasets", 0.97, 10, 8000, 42, 5,
    )


def test_prepare_then_stats(spark, tmp_path, capsys):
    spark.range(100).select(
        F.concat(F.lit("question number "), "id").alias("Context"), F.concat(F.lit("answer number "), "id").alias("Response")
    ).write.parquet(str(tmp_path / "pairs"))
    out = tmp_path / "out"
    main(["prepare", str(tmp_path / "pairs"), "--out", str(out), "--preview", "2", "--train-split", "0.9"])
    text = capsys.readouterr().out
    paths = tm.published(spark, str(out)).paths
    assert f"100 pairs: 100 kept, 0 skipped\n90 in {paths['train']}\n10 in {paths['val']}" in text
    assert text.count("question number") == 2 and text.count("answer number") == 2

    for which in ([paths["train"], paths["val"]], [str(out)]):
        main(["stats", *which])
        lines = [line.split() for line in capsys.readouterr().out.splitlines()]
        assert [line[-1] for line in lines if line[:1] == ["num_samples"]] == ["90", "10"]


def test_results(spark, tmp_path, capsys):
    prompts, responses = tmp_path / "p.jsonl", tmp_path / "r.jsonl"
    prompts.write_text("\n".join(json.dumps({"messages": [{"role": "user", "content": f"q{i}"}]}) for i in range(4)))
    responses.write_text("\n".join(json.dumps({"sample_id": i, "response": f"r{i}"}) for i in (1, 3)))
    main(["results", str(prompts), str(responses), str(tmp_path / "out"), "--temperature", "0.2"])
    table = [[cell.strip() for cell in line.split("|")[1:-1]] for line in capsys.readouterr().out.splitlines()]
    assert ["4", "2"] in table and ["1", "q0", "r1"] in table and ["3", "q2", "r3"] in table
