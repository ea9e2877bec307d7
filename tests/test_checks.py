import json

import pytest
from pyspark.sql import functions as F

import turnmill as tm

USER, BOT = {"role": "user", "content": "hi"}, {"role": "assistant", "content": "yo"}

# line, loose check, rules broken under the strict check
CASES = [
    ({"messages": [USER, BOT]}, True, []),
    ({"messages": [USER]}, False, ["message_count"]),
    ({"messages": []}, False, ["message_count"]),
    ({"messages": "str"}, False, ["message_count"]),
    ({"messages": None}, False, ["message_count"]),
    ({"messages": USER}, False, ["message_count"]),
    ({"text": "x"}, False, ["missing_messages"]),
    ({"messages": [USER, {"role": "bot", "content": "x"}]}, False, ["second_role"]),
    ({"messages": [USER, {"role": "User", "content": "x"}]}, False, ["second_role"]),
    ({"messages": [USER, {"role": "assistant"}]}, False, ["missing_content"]),
    ({"messages": [USER, {"role": "assistant", "content": None}]}, True, []),
    ({"messages": [USER, {"role": "assistant", "content": 5, "extra": [1]}]}, True, []),
    ({"messages": [USER, "x"]}, False, ["second_role", "missing_content"]),
    ({"messages": [{"role": "system", "content": "s"}, USER, BOT]}, True, ["message_count"]),
    ({"messages": [BOT, USER]}, True, ["first_role", "second_role"]),
    ({"messages": [USER, {"role": None, "content": "x"}]}, False, ["second_role"]),
    ({"messages": [USER, {"role": ["assistant"], "content": "x"}]}, False, ["second_role"]),
    ({"messages": [USER, {"content": "x"}]}, False, ["second_role"]),
    ([1], False, ["missing_messages"]),
    ({}, False, ["missing_messages"]),
    ('{"messages": [', False, ["missing_messages"]),
]


@pytest.fixture
def lines(spark):
    rows = [(i, c if isinstance(c, str) else json.dumps(c)) for i, (c, *_) in enumerate(CASES)]
    return spark.createDataFrame(rows, "id int, value string")


def test_loose_check_on_text(lines):
    got = lines.orderBy("id").select(tm.validate_messages_json(F.col("value")).alias("v")).collect()
    assert [r["v"] for r in got] == [v for _, v, _ in CASES]


def test_strict_check_on_text(lines):
    found = {i: [] for i in range(len(CASES))}
    for r in tm.schema_issues_json(lines, "id").collect():
        found[r["sample_id"]].append(r["rule"])
    assert [sorted(found[i]) for i in found] == [sorted(rules) for *_, rules in CASES]


def typed(spark, rows):
    return spark.createDataFrame(rows, "id int, messages array<struct<role:string,content:string>>")


def test_typed_checks(spark):
    df = typed(
        spark,
        [
            (1, [("user", "a"), ("assistant", "b")]),
            (2, [("user", "a"), ("bot", "b")]),
            (3, [("user", "a"), (None, "b")]),
            (4, None),
            (5, [("user", "a"), ("assistant", "")]),
            (6, [("user", "a"), ("assistant", None)]),
            (7, [("user", "a"), ("user", "b")]),
        ],
    )
    got = df.orderBy("id").select(
        tm.validate_messages(F.col("messages")).alias("v"), tm.content_rules(F.col("messages")).alias("c")
    )
    assert [(r["v"], r["c"]) for r in got.collect()] == [
        (True, True),
        (False, False),
        (False, False),
        (False, False),
        (True, False),
        (True, False),
        (True, False),
    ]


def test_issue_texts(spark):
    df = typed(spark, [(1, None), (2, [("user", "a")]), (3, [("x", None), ("y", "b")]), (4, [("user", "a"), ("assistant", "b")])])
    issues = tm.schema_issues(df, "id")
    got = {(r["sample_id"], r["msg_idx"], r["detail"]) for r in issues.collect()}
    assert got == {
        (1, None, "Sample 1: Missing 'messages' key"),
        (2, None, "Sample 2: Expected 2 messages, got 1"),
        (3, None, "Sample 3: First message should have role 'user'"),
        (3, None, "Sample 3: Second message should have role 'assistant'"),
        (3, 0, "Sample 3, message 0: Missing 'content' key"),
    }


def test_report_and_assert(spark):
    bad = typed(spark, [(i, [("user", "a")]) for i in range(13)])
    issues = tm.schema_issues(bad, "id")
    report = tm.schema_report(issues).collect()
    assert [r["sample_id"] for r in report] == list(range(10))
    assert {(r["n_issues"], r["n_more"]) for r in report} == {(13, 3)}
    with pytest.raises(tm.InvalidSamples, match=r"(?s)Sample 9: Expected 2 messages, got 1.*and 3 more errors"):
        tm.assert_valid(issues)
    tm.assert_valid(tm.schema_issues(typed(spark, [(1, [("user", "a"), ("assistant", "b")])]), "id"))


def test_limited_scope(spark):
    bad = typed(spark, [(i, [("user", "a")]) for i in range(30)])
