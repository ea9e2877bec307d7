"""Dataset statistics."""

from pyspark.sql import DataFrame, functions as F


def source_profile(df: DataFrame) -> DataFrame:
    """One row with the number of rows and the column names."""
    return df.agg(
        F.count(F.lit(1)).alias("num_rows"),
    ).withColumn("columns", F.array(*[F.lit(c) for c in df.columns]))


def dataset_stats(df: DataFrame, by: str | None = None, messages: str = "messages") -> DataFrame:
    """Sample, message and content-length figures, of everything or per ``by``.

    Content lengths are reduced inside each row, so nothing is exploded, and the average
    weights every message alike.  An empty table gives NULL averages; a table without
    ``messages`` gives the sample figures only.
    """
    features = [c for c in df.columns if c != by]
    group = [by] if by else []
    named = [
        F.lit(len(features)).alias("num_features"),
        F.array(*[F.lit(c) for c in features]).alias("features"),
    ]
    samples = F.count(F.lit(1)).alias("num_samples")
    if messages not in features:
        return df.groupBy(*group).agg(samples).select(*group, "num_samples", *named)

    lengths = F.filter(F.transform(df[messages]["content"], F.length), lambda n: n.isNotNull())
    rows = df.select(*group, F.array_size(messages).alias("m"), lengths.alias("len"))
    rows = rows.select(
        *group,
        "m",
        F.array_size("len").alias("c"),
        F.aggregate("len", F.lit(0).cast("long"), lambda total, n: total + n).alias("chars"),
        F.array_min("len").alias("shortest"),
        F.array_max("len").alias("longest"),
    )
    return (
        rows.groupBy(*group)
        .agg(
            samples,
            F.avg("m").alias("avg_messages_per_sample"),
            F.min("m").alias("min_messages"),
            F.max("m").alias("max_messages"),
            (F.sum("chars") / F.nullif(F.sum("c"), F.lit(0))).alias("avg_content_length"),
            F.min("shortest").alias("min_content_length"),
            F.max("longest").alias("max_content_length"),
        )
        .withColumns({"num_features": F.lit(len(features)), "features": F.array(*[F.lit(c) for c in features])})
    )
