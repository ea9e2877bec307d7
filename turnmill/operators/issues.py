"""Strict check of question/answer samples: every violation as a row."""

from pyspark.sql import Column, DataFrame, functions as F

from turnmill.functions import checks
from turnmill.functions.binding import bind

# Report texts.
MISSING_MESSAGES = "Missing 'messages' key"
WRONG_COUNT = "Expected 2 messages, got %s"
FIRST_ROLE = "First message should have role 'user'"
SECOND_ROLE = "Second message should have role 'assistant'"
MISSING_CONTENT = "Missing 'content' key"


def _issue(when: Column, rule: str, key: Column, text: Column, msg_idx: int | None = None) -> Column:
    position = F.lit(msg_idx).cast("int")
    where = F.concat(F.lit("Sample "), key) if msg_idx is None else F.concat(F.lit("Sample "), key, F.lit(f", message {msg_idx}"))
    return F.when(
        F.coalesce(when, F.lit(False)),
        F.struct(
            F.lit(rule).alias("rule"),
            position.alias("msg_idx"),
            F.concat(where, F.lit(": "), text).alias("detail"),
        ),
    )


def issue_array(key: Column, present: Column, count: Column, roles: Column, has_content: Column) -> Column:
    """All issues of one sample as an array of ``{rule, msg_idx, detail}``.

    A missing array or a wrong number of messages ends the check of that sample.
    """
    key = key.cast("string")
    pair = present & F.coalesce(count == 2, F.lit(False))
    first, second = F.get(roles, F.lit(0)), F.get(roles, F.lit(1))
    found = F.array(
        _issue(~present, "missing_messages", key, F.lit(MISSING_MESSAGES)),
        _issue(present & ~pair, "message_count", key, F.format_string(WRONG_COUNT, count)),
        _issue(pair & ~first.eqNullSafe(F.lit("user")), "first_role", key, F.lit(FIRST_ROLE)),
        _issue(pair & ~second.eqNullSafe(F.lit("assistant")), "second_role", key, F.lit(SECOND_ROLE)),
        *(
            _issue(pair & ~F.get(has_content, F.lit(i)), "missing_content", key, F.lit(MISSING_CONTENT), i)
            for i in (0, 1)
        ),
    )
    return F.array_compact(found)


def sample_issues(key: Column, messages: Column) -> Column:
    """Issues of a typed ``messages`` column; a NULL content counts as missing."""
    return issue_array(
        key,
        messages.isNotNull(),
        F.array_size(messages),
        messages["role"],
        F.transform(messages, lambda m: m["content"].isNotNull()),
    )


def sample_issues_json(key: Column, value: Column) -> Column:
    """Issues of a line of JSON text; a content that is present and null is no issue."""

    def facts_of_items(items: Column) -> Column:
        return F.struct(
            F.coalesce(F.array_size(items), F.lit(0)).alias("count"),
            F.transform(items, checks.variant_role).alias("roles"),
            F.transform(items, lambda m: checks.variant_has_key(m, "content")).alias("has_content"),
        )

    def facts(sample: Column) -> Column:
        present = F.coalesce(checks.variant_has_key(sample, "messages"), F.lit(False))
        return F.struct(present.alias("present"), bind(checks.variant_items(sample), facts_of_items).alias("items"))

    def issues(found: Column) -> Column:
        items = found["items"]
        return issue_array(key, found["present"], items["count"], items["roles"], items["has_content"])

    return bind(bind(F.try_parse_json(value), facts), issues)


def _explode(df: DataFrame, key: str, issues: Column, order: list[str]) -> DataFrame:
    return df.select(F.col(key).alias("sample_id"), *order, F.explode(issues).alias("i")).select(
        "sample_id", *order, "i.msg_idx", "i.rule", "i.detail"
    )


def schema_issues(
    df: DataFrame,
    key: str,
    messages: str = "messages",
    by: tuple[str, ...] = (),
) -> DataFrame:
    """Issues table ``(sample_id, *by, msg_idx, rule, detail)`` of typed samples."""
    return _explode(df, key, sample_issues(F.col(key), F.col(messages)), list(by))


def schema_issues_json(df: DataFrame, key: str, value: str = "value") -> DataFrame:
    """Issues table of raw JSON lines; ``messages`` that are not a list count as none."""
    return _explode(df, key, sample_issues_json(F.col(key), F.col(value)), [])


def schema_report(issues: DataFrame, show: int = 10) -> DataFrame:
    """The first ``show`` issues, each with the total and the number not shown."""
    total = issues.agg(F.count(F.lit(1)).alias("n")).scalar()
    order = ["sample_id", F.col("msg_idx").asc_nulls_first(), "rule"]
    return issues.orderBy(*order).limit(show).select(
        "sample_id",
        "msg_idx",
        "rule",
        "detail",
        total.alias("n_issues"),
        F.greatest(total - show, F.lit(0)).alias("n_more"),
    )


class InvalidSamples(ValueError):
    """Raised when samples break the schema."""


def assert_valid(issues: DataFrame, show: int = 10) -> None:
    """Raise with the first issues, if there are any; at most ``show`` rows reach the driver."""
    rows = schema_report(issues, show).collect()
    if rows:
        lines = [f"  - {r['detail']}" for r in rows]
        if rows[0]["n_more"]:
            lines.append(f"  ... and {rows[0]['n_more']} more errors")
        raise InvalidSamples("Schema validation FAILED:\n" + "\n".join(lines))
