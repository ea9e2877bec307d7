"""From pairs to a checked, shuffled and split chat dataset."""

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from turnmill.config import PrepareConfig
from turnmill.operators.adapt import pairs_to_messages
from turnmill.operators.filters import filter_valid, pair_validity
from turnmill.operators.issues import assert_valid, sample_issues, schema_issues
from turnmill.operators.order import preview, seeded_layout, smoke_sample
from turnmill.operators.split import TRAIN, VALIDATION, split_exact
from turnmill.sinks.publish import publish, qualified, stage_splits
from turnmill.sources.jsonl import read_jsonl
from turnmill.storage import materialize


def to_samples(pairs: DataFrame, config: PrepareConfig = PrepareConfig()) -> DataFrame:
    """Usable pairs as chat samples, cleaned."""
    return filter_valid(pairs, config.min_length, config.max_length).transform(pairs_to_messages)


def _stage(rows: DataFrame, name: str) -> DataFrame:
    # Rebalanced, because a file of narrow rows per input task would be tiny.
    return materialize(rows.hint("rebalance"), name)


def _ledger(pairs: DataFrame, key: str, config: PrepareConfig) -> DataFrame:
    """One narrow row per pair: its key, whether it is kept, and size and issues if it is."""
    valid = pair_validity(pairs, config.min_length, config.max_length)
    sides = [F.octet_length(F.get("messages", F.lit(i))["content"]) for i in (0, 1)]
    issues = F.array_size(sample_issues(F.col(key), F.col("messages")))
    return (
        pairs.withColumn("_valid", valid)
        .transform(pairs_to_messages)
        .select(
            key,
            "_valid",
            F.when(F.col("_valid"), sides[0] + sides[1]).alias("_bytes"),
            F.when(F.col("_valid"), issues).alias("_broken"),
        )
    )


def _partitions(size: int, file_bytes: int, cores: int, least: int = 16 * 1024 * 1024) -> int:
    # By size, so that a task's sort fits in memory; small data still uses all cores.
    return max(1 + size // file_bytes, min(cores, 1 + size // least))


def prepare(pairs: DataFrame, key: str, config: PrepareConfig = PrepareConfig(), keys: DataFrame | None = None) -> DataFrame:
    """The prepared dataset as a frame ``(key, messages, split)``.

    The texts are read twice: now, to write the narrow table of the kept keys from which
    the split finds its cut, and when the result is used.  Pass that table as ``keys`` if
    there is one already.
    """
    samples = to_samples(pairs, config).select(key, "messages")
    if keys is None:
        keys = _stage(filter_valid(pairs, config.min_length, config.max_length).select(key), "keys")
    return split_exact(samples, key, config.train_split, config.seed, keys=keys)


@dataclass(frozen=True)
class PrepareReport:
    """What a prepare job did."""

    total: int
    kept: int
    skipped: int
    train: int
    val: int
    train_path: str
    val_path: str
    preview: DataFrame

    def summary(self) -> str:
        return (
            f"{self.total} pairs: {self.kept} kept, {self.skipped} skipped\n"
            f"{self.train} in {self.train_path}\n{self.val} in {self.val_path}"
        )


def prepare_to_jsonl(
    pairs: DataFrame,
    key: str,
    config: PrepareConfig = PrepareConfig(),
    file_bytes: int = 512 * 1024 * 1024,
) -> PrepareReport:
    """Run the whole job: filter, convert, check, split, shuffle, write.

    Two passes over the input.  The first writes a narrow ledger of keys, sizes and issues,
    from which the figures and the split are read.  The second writes both splits in shuffled
    order, in files of at most about ``file_bytes``, and counts their rows as it does so.
    They are published together when both are whole; until then ``published`` gives the pair before.
    Nothing is written to the output when a key is NULL or repeated, when a sample breaks the
    schema, or when ``out`` holds an input file.
    """
    _refuse_inputs_inside(pairs, config.out)
    ledger = _stage(_ledger(pairs, key, config), "ledger")
    figures = ledger.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if("_valid").alias("kept"),
        F.count_if(F.col(key).isNull()).alias("keyless"),
        F.sum("_broken").alias("broken"),
        F.sum("_bytes").alias("bytes"),
    ).first()
    if figures["keyless"]:
        raise ValueError(f"{figures['keyless']} rows have no {key}")
    repeated = ledger.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1).limit(1).collect()
    if repeated:
        raise ValueError(f"{key} must be unique: {repeated[0][key]} occurs {repeated[0]['n']} times")
    keys = ledger.where("_valid").select(key)
    samples = to_samples(pairs, config).select(key, "messages")
    if figures["broken"]:
        assert_valid(schema_issues(samples, key))

    split = prepare(pairs, key, config, keys)
    partitions = _partitions(figures["bytes"] or 0, file_bytes, pairs.sparkSession.sparkContext.defaultParallelism)
    shuffled = seeded_layout(split, key, partitions, config.seed, first=("split",))
    staged = stage_splits(shuffled.select("messages", "split"), config.out)
    sizes, paths = staged.rows, staged.paths
    if sum(sizes.values()) != figures["kept"]:
        raise RuntimeError(f"{figures['kept']} pairs are usable, {sum(sizes.values())} were written")
    publish(pairs.sparkSession, config.out, staged)

    placed = split_exact(keys, key, config.train_split, config.seed)
    first = smoke_sample(placed.where(F.col("split") == TRAIN).select(key), key, config.preview, config.seed)
    return PrepareReport(
        total=figures["total"],
        kept=figures["kept"],
        skipped=figures["total"] - figures["kept"],
        train=sizes[TRAIN],
        val=sizes[VALIDATION],
        train_path=paths[TRAIN],
        val_path=paths[VALIDATION],
        preview=preview(_first_written(first, paths[TRAIN], key, samples), key, config.preview, config.seed),
    )


def _refuse_inputs_inside(pairs: DataFrame, out: str) -> None:
    """Publishing removes old versions, so nothing under the output folder may be read; nor may it lie in an input file."""
    spark = pairs.sparkSession
    folder = qualified(spark, out)
    inside = lambda path, holder: f"{path}/".startswith(f"{holder}/")
    for path in pairs.inputFiles():
        file = qualified(spark, path, encoded=True)
        if inside(file, folder) or inside(folder, file):
            raise ValueError(f"the output folder {folder} and the input file {file} lie in each other")


def _first_written(first: DataFrame, path: str, key: str, samples: DataFrame) -> DataFrame:
    """The first written samples, by their keys in order: read from the first files, not from the pairs."""
    spark, wanted = first.sparkSession, [r[key] for r in first.collect()]
    written: list = []
    for file in sorted(spark.read.text(path).inputFiles()) if wanted else []:
        if len(written) >= len(wanted):
            break
        written += read_jsonl(spark, file, samples.select("messages").schema).limit(len(wanted) - len(written)).collect()
    rows = [(k, row["messages"]) for k, row in zip(wanted, written)]
    return spark.createDataFrame(rows, samples.schema)
