"""The registered queries: name -> function of (spark, sf_dir)."""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

import turnmill as tm
from checks import frames
from turnmill.storage import scratch_path


def _messages() -> Column:
    return F.col("messages")


def _one_per_message(df: DataFrame, *keys: str) -> DataFrame:
    return df.select(*keys, F.posexplode("messages").alias("msg_idx", "m")).select(
        *keys, F.col("msg_idx").cast("long").alias("msg_idx"), "m.role", "m.content"
    )


def _two_sides(df: DataFrame, *keys: str) -> DataFrame:
    side = lambda i: F.get(_messages(), F.lit(i))
    return df.select(
        *keys,
        side(0)["role"].alias("first_role"),
        side(0)["content"].alias("question"),
        side(1)["role"].alias("second_role"),
        side(1)["content"].alias("answer"),
    )


def jsonl_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Samples written as JSON Lines and read back."""
    path = scratch_path(spark, "jsonl")
    samples = frames.turn_samples(spark, sf_dir).select("conv_id", "messages")
    tm.write_jsonl(samples, path)
    schema = samples.schema
    return _one_per_message(tm.read_jsonl(spark, path, schema), "conv_id")


def jsonl_mixed_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A field of several types, read without a schema and written back: every value is as it was."""
    paths = [scratch_path(spark, f"mixed-{i}") for i in (1, 2)]
    frames.mixed_lines(spark, sf_dir).write.text(paths[0])
    tm.write_jsonl(tm.read_jsonl(spark, paths[0]), paths[1])
    record = tm.read_records(spark, paths[1])
    field = lambda name, kind: F.variant_get("record", f"$.{name}", kind)
    same = F.to_json(field("value", "variant")).alias("value")
    return record.select(field("conv", "long").alias("conv"), field("turn", "long").alias("turn"), same)


def jsonl_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Good and bad lines told apart without a schema."""
    path = scratch_path(spark, "lines")
    frames.odd_lines(spark, sf_dir).write.text(path)
    good, bad = tm.quarantine_jsonl(spark, path)
    inside = lambda at: F.try_variant_get("messages", at, "string")
    content = F.coalesce(F.col("text.content"), inside("$[0].content"), inside("$.content"))
    none = F.lit(None).cast("string")
    rows = good.select(content.alias("content"), F.col("id").cast("long").alias("id"), none.alias("text"), none.alias("reason"))
    return rows.unionByName(bad.select(none.alias("content"), F.lit(None).cast("long").alias("id"), "text", "reason"))


def stream_curate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Document pairs curated as a stream of files, twice: the second call finds nothing new."""
    out, log = scratch_path(spark, "stream"), scratch_path(spark, "stream-log")
    schema = frames.table(spark, sf_dir, "documents").schema
    for _ in range(2):
        docs = tm.read_files(spark, f"{sf_dir}/documents.parquet", schema)
        tm.write_files(tm.curate_pairs(frames.pairs_of(docs), "doc_id", tm.PrepareConfig(train_split=0.9)), out, log)
    return _two_sides(spark.read.parquet(out), "doc_id", "split")


def published_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two datasets published one after the other; the second is what readers find."""
    docs, out = frames.table(spark, sf_dir, "documents").select("doc_id", "text"), scratch_path(spark, "published")
    tm.publish_splits(tm.split_hash(docs, "doc_id", 0.5, seed=1), out)
    tm.publish_splits(tm.split_hash(docs, "doc_id", 0.9, seed=7), out)
    found = tm.published(spark, out)
    splits = tm.union_splits(tm.load_splits(spark, found.paths, docs.schema))
    return splits.select("doc_id", "text", "split", F.when(F.col("split") == "train", found.rows["train"]).otherwise(found.rows["val"]).cast("long").alias("reported"))


def load_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two splits written in one job, loaded by name and put together again."""
    path = scratch_path(spark, "splits")
    samples = tm.prepare(frames.doc_pairs(spark, sf_dir), "doc_id")
    schema = samples.drop("split").schema
    tm.write_splits(samples, path)
    loaded = tm.load_splits(spark, {"train": f"{path}/split=train", "validation": f"{path}/split=val"}, schema)
    return _two_sides(tm.union_splits(loaded), "doc_id", "split")


def eval_prompt_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prompts numbered in the order of the lines of a file set."""
    path = scratch_path(spark, "prompts")
    turns = frames.table(spark, sf_dir, "conversations").where(F.col("role") == "user")
    message = F.struct(F.col("role"), F.col("text").alias("content"))
    metadata = F.create_map(F.lit("conv"), F.col("conv_id").cast("string")).alias("metadata")
    tm.write_jsonl(turns.orderBy("conv_id", "turn").select(F.array(message).alias("messages"), metadata), path)
    return tm.read_eval_prompts(spark, path).select(
        "sample_id", F.get(_messages(), F.lit(0))["content"].alias("text"), F.col("metadata")["conv"].alias("conv")
    )


def scan_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs written as JSON and as CSV, read back, and the split to use out of two."""
    pairs, paths = frames.doc_pairs(spark, sf_dir), {f: scratch_path(spark, f"pairs-{f}") for f in ("json", "csv")}
    odd = F.col("doc_id") % 2 == 1
    pairs.where(~odd).write.json(paths["json"])
    pairs.where(odd).write.csv(paths["csv"], header=True, quoteAll=True, escape='"')
    sides = [F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("Context", "Response")]
    read = {f: tm.read_pairs(spark, path, f).select(F.col("doc_id").cast("long"), *sides) for f, path in paths.items()}
    return tm.pick_split({"other": read["csv"], "train": read["json"].unionByName(read["csv"])})


def source_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    profile = tm.source_profile(frames.table(spark, sf_dir, "documents"))
    return profile.select("num_rows", F.array_join("columns", ",").alias("columns"))


def turn_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _one_per_message(frames.turn_samples(spark, sf_dir), "conv_id")


def turn_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tm.turns_to_pairs(frames.gapped_turns(spark, sf_dir))


def turn_pairs_sparse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs across measured stretches of a huge conversation with gaps and repeated numbers."""
    return tm.turns_to_pairs(frames.sparse_turns(spark, sf_dir), block=40)


def turn_messages_sparse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same conversations as samples."""
    return _one_per_message(tm.turns_to_messages(frames.sparse_turns(spark, sf_dir), block=40), "conv_id")


def keyed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unique keys for texts that come without one and with copies."""
    texts = frames.table(spark, sf_dir, "documents").select("text")
    return tm.with_row_key(texts, chunk=2).select(
        F.substring_index("row_key", "-", -1).cast("long").alias("copy"), "text"
    )


def clean_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = frames.dirty_turns(spark, sf_dir)
    return turns.select("conv_id", "turn", tm.clean_text(F.col("text")).alias("text"))


def filter_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frames.doc_pairs(spark, sf_dir).transform(tm.filter_valid)


def skip_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frames.doc_pairs(spark, sf_dir).transform(tm.skip_counts)


def pairs_to_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = tm.turns_to_pairs(frames.dirty_turns(spark, sf_dir))
    return _two_sides(tm.pairs_to_messages(pairs), "conv_id", "turn")


def messages_concat(spark: SparkSession, sf_dir: str) -> DataFrame:
    samples = frames.turn_samples(spark, sf_dir)
    return samples.select("conv_id", tm.concat_messages(_messages()).alias("text"))


def render_plain(spark: SparkSession, sf_dir: str) -> DataFrame:
    samples = frames.turn_samples(spark, sf_dir)
    return samples.select("conv_id", tm.render_chat(_messages()).alias("text"))


def render_tagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    samples = frames.turn_samples(spark, sf_dir)
    return samples.select(
        "conv_id",

        tm.render_chat(_messages(), tm.CHATML).alias("text"),
        tm.render_chat(_messages(), tm.CHATML, add_generation_prompt=True).alias("prompt"),
    )


def filter_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    samples = frames.doc_samples(spark, sf_dir).transform(tm.filter_long, max_length=512)
    return _two_sides(samples, "doc_id")


def filter_long_counted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The length filter with a caller's own measure, over Arrow batches."""

    def make():
        import pyarrow.compute as pc

        return lambda texts: pc.count_substring_regex(texts, "[A-Za-z]+|[0-9]")

    samples = frames.doc_samples(spark, sf_dir).transform(tm.filter_long, counter=tm.arrow_counter(make, "words and digits"), max_length=300, special_tokens=2)
    return _two_sides(samples, "doc_id")


def validate_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    samples = tm.turns_to_messages(frames.mixed_turns(spark, sf_dir))
    return samples.select("conv_id", tm.validate_messages(_messages()).alias("valid"))


def validate_messages_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = frames.raw_samples(spark, sf_dir)
    return raw.select("conv_id", "turn", tm.validate_messages_json(F.col("value")).alias("valid"))


def schema_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    issues = frames.turn_samples(spark, sf_dir).transform(tm.schema_issues, "conv_id")
    return issues.withColumn("msg_idx", F.col("msg_idx").cast("long"))


def schema_issues_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    issues = frames.raw_samples(spark, sf_dir).transform(tm.schema_issues_json, "key")
    return issues.withColumn("msg_idx", F.col("msg_idx").cast("long"))


def schema_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tm.schema_report(schema_issues(spark, sf_dir))


def content_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns, docs = frames.turn_samples(spark, sf_dir), frames.doc_samples(spark, sf_dir)
    ok = tm.content_rules(_messages()).alias("ok")
    return turns.select(F.lit("turns").alias("source"), F.col("conv_id").alias("id"), ok).unionByName(
        docs.select(F.lit("docs").alias("source"), F.col("doc_id").alias("id"), ok)
    )


def _redacted_turns(spark: SparkSession, sf_dir: str, *kinds: str) -> DataFrame:
    turns = frames.dirty_turns(spark, sf_dir)
    return turns.select("conv_id", "turn", tm.redact_pii(F.col("text"), kinds=kinds).alias("text"))


def redact_email(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _redacted_turns(spark, sf_dir, "email")


def redact_phone(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _redacted_turns(spark, sf_dir, "phone")


def redact_ssn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _redacted_turns(spark, sf_dir, "ssn")


def redact_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = frames.table(spark, sf_dir, "documents")
    return docs.select("doc_id", tm.redact_pii(F.col("text")).alias("text"))


def redact_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    samples = frames.dirty_samples(spark, sf_dir).transform(tm.redact_messages)
    return _one_per_message(samples, "conv_id")


def _flat_stats(stats: DataFrame) -> DataFrame:
    for name in ("num_features", "min_messages", "max_messages", "min_content_length", "max_content_length"):
        stats = stats.withColumn(name, F.col(name).cast("long"))
    for name in ("avg_messages_per_sample", "avg_content_length"):
        stats = stats.withColumn(name, F.round(name, 6))
    return stats.withColumn("features", F.array_join("features", ","))


def dataset_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat_stats(tm.dataset_stats(frames.turn_samples(spark, sf_dir)))


def split_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat_stats(tm.dataset_stats(prepared(spark, sf_dir), by="split"))


def prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tm.prepare(frames.doc_pairs(spark, sf_dir), "doc_id")


def split_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tm.split_counts(prepared(spark, sf_dir))


def seeded_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shuffled order, written as lines and made visible as their numbers."""
    path = scratch_path(spark, "ordered")
    docs = frames.table(spark, sf_dir, "documents").select("doc_id")
    tm.write_jsonl(tm.seeded_order(docs, "doc_id", seed=7), path)
    lines = spark.read.schema("doc_id long").json(path).select(
        "doc_id", F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("line")
    )
    return tm.number_rows(lines, "file", "line", name="position").drop("file", "line")


def split_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = frames.table(spark, sf_dir, "documents").select("doc_id")
    return tm.split_hash(docs, "doc_id", 0.9, seed=7)


def pii_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tm.pii_counts(frames.overlapping_turns(spark, sf_dir))


def skip_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frames.doc_pairs(spark, sf_dir).transform(tm.skip_reasons)


def eval_by_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tm.eval_by_category(frames.eval_results(spark, sf_dir))


def stored_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two stored splits with different columns, loaded with all their fields."""
    docs, path = frames.table(spark, sf_dir, "documents"), scratch_path(spark, "fields")
    late = F.col("doc_id") % 10 == 0
    tm.write_jsonl(docs.where(~late).select("doc_id", "source", "text"), f"{path}/train")
    tm.write_jsonl(docs.where(late).select("doc_id", "lang", "text"), f"{path}/validation")
    return tm.union_splits(tm.load_splits(spark, {s: f"{path}/{s}" for s in ("train", "validation")}))


def prepare_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole job with its output read back, and the sizes that it reports."""
    config = tm.PrepareConfig(out=scratch_path(spark, "job"))
    report = tm.prepare_to_jsonl(frames.doc_pairs(spark, sf_dir), "doc_id", config)
    splits = tm.load_splits(spark, {"train": report.train_path, "val": report.val_path})
    size = F.when(F.col("split") == "train", report.train).otherwise(report.val).cast("long").alias("reported")
    return _two_sides(tm.union_splits(splits).withColumn("reported", size), "split", "reported")


def split_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = frames.table(spark, sf_dir, "documents").select("doc_id", "text")
    return tm.split_exact(docs, "doc_id", 0.9, seed=7)


def preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    samples = prepared(spark, sf_dir).where(F.col("split") == "train")
    shown = tm.preview(samples, "doc_id")
    return shown.withColumns({c: F.col(c).cast("long") for c in ("sample_no", "msg_idx")})


def smoke_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tm.smoke_sample(frames.table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id")


def prepare_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole prepare job: filter, clean, convert, shuffle key, exact split."""
    return _two_sides(prepared(spark, sf_dir), "doc_id", "split")


def curate_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Well-formed, redacted, bounded, rendered conversations."""
    samples = frames.dirty_samples(spark, sf_dir)
    return tm.curate(samples, max_length=512).select("conv_id", "text")


def eval_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = tm.eval_prompts(frames.eval_turns(spark, sf_dir).drop("error"))
    return asked.select("sample_id", "model_prompt", "error")


def eval_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    params = F.col("generation_params")
    return frames.eval_results(spark, sf_dir).select(
        "sample_id",
        "model_prompt",
        "prompt",
        "response",
        F.try_element_at("metadata", F.lit("category")).alias("category"),
        F.array_size(F.map_keys("metadata")).cast("long").alias("n_metadata"),
        params["max_new_tokens"].cast("long").alias("max_new_tokens"),
        params["temperature"].alias("temperature"),
        params["top_p"].alias("top_p"),
        "error",
    )


def eval_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tm.eval_preview(frames.eval_results(spark, sf_dir))


def eval_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tm.eval_summary(frames.eval_results(spark, sf_dir))


def first_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tm.first_responses(frames.eval_results(spark, sf_dir))


QUERIES = {
    f.__name__: f
    for f in (
        jsonl_roundtrip,
        jsonl_mixed_types,
        jsonl_quarantine,
        stream_curate,
        published_splits,
        load_splits,
        eval_prompt_file,
        scan_pairs,
        source_profile,
        turn_messages,
        turn_pairs,
        turn_pairs_sparse,
        turn_messages_sparse,
        keyed_rows,
        clean_text,
        filter_valid,
        skip_counts,
        pairs_to_messages,
        messages_concat,
        render_plain,
        render_tagged,
        filter_long,
        filter_long_counted,
        validate_messages,
        validate_messages_json,
        schema_issues,
        schema_issues_json,
        schema_report,
        content_rules,
        redact_email,
        redact_phone,
        redact_ssn,
        redact_all,
        redact_messages,
        dataset_stats,
        split_stats,
        split_counts,
        seeded_order,
        split_exact,
        split_hash,
        pii_counts,
        skip_reasons,
        stored_fields,
        prepare_job,
        preview,
        smoke_sample,
        prepare_splits,
        curate_chat,
        eval_prompts,
        eval_results,
        eval_preview,
        eval_summary,
        eval_by_category,
        first_responses,
    )
}
