import re

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

import turnmill as tm
from turnmill.functions import pii

CASES = {
    "a@b.co": "[REDACTED]",
    "john@x.c|m": "[REDACTED]",
    "email jo@x.com5": "email jo@x.com5",
    "é@b.co mail": "é@b.co mail",
    "5551234567": "[REDACTED]",
    "555.123.4567": "[REDACTED]",
    "1-555-123-4567": "1-[REDACTED]",
    "(555) 123-4567": "(555) 123-4567",
    "x555-123-4567": "x555-123-4567",
    "a_123-45-6789": "a_123-45-6789",
    "电话555-123-4567": "电话555-123-4567",
    "café555-123-4567": "café[REDACTED]",
    "café555-123-4567": "café555-123-4567",
    "123-45-6789 ok": "[REDACTED] ok",
    "١٢٣-٤٥-٦٧٨٩": "[REDACTED]",
    "１２３-45-6789": "[REDACTED]",
    ".a@b.co": ".[REDACTED]",
    "x.a@b.co": "[REDACTED]",
    "a@b.co|": "[REDACTED]|",
    "a@b.co|x": "[REDACTED]",
    "": "",
    None: None,
}


def redact(spark, texts, **options):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    rows = df.select("i", tm.redact_pii(F.col("t"), **options).alias("x")).orderBy("i").collect()
    return [r["x"] for r in rows]


def python_redact(text, placeholder="[REDACTED]"):
    for pattern in (pii.EMAIL, pii.PHONE, pii.SSN):
        text = re.sub(r"\b" + pattern + r"\b", lambda _: placeholder, text)
    return text


def test_table(spark):
    assert redact(spark, list(CASES)) == list(CASES.values())


def test_table_agrees_with_python(spark):
    texts = [t for t in CASES if t is not None]
    assert [python_redact(t) for t in texts] == [CASES[t] for t in texts]


pieces = st.sampled_from(
    ["555", "123", "45", "6789", "4567", "-", ".", "_", " ", "\n", "@", "ab", "x", ".com", "|", "%", "+", "é", "́", "٣", "中", "😀", "1"]
)


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(pieces, max_size=14).map("".join), min_size=150, max_size=200))
def test_agrees_with_python(spark, texts):
    assert redact(spark, texts) == [python_redact(t) for t in texts]


def test_redacting_twice_changes_nothing(spark):
    once = redact(spark, list(CASES))
    assert redact(spark, once) == once


@pytest.mark.parametrize("placeholder", ["$1", r"\1", "", "<x>", "555-123-4567"])
def test_placeholder_is_literal(spark, placeholder):
    texts = ["mail a@b.co or 555-123-4567 or 123-45-6789.", "no", "12@b.co3 4"]
    assert redact(spark, texts, placeholder=placeholder) == [python_redact(t, placeholder) for t in texts]


def test_kinds(spark):
    text = "a@b.co 555-123-4567 123-45-6789"
    assert redact(spark, [text], kinds=("ssn",)) == ["a@b.co 555-123-4567 [REDACTED]"]
    assert redact(spark, [text], kinds=("email", "phone")) == ["[REDACTED] [REDACTED] 123-45-6789"]
    assert redact(spark, [text], kinds=()) == [text]
    with pytest.raises(ValueError):
        redact(spark, [text], kinds=("iban",))


def test_messages_keep_other_fields_and_nulls(spark):
    df = spark.sql(
        "select 1 as id, array(named_struct('role','user','content','a@b.co','n',7),"
        " named_struct('role','assistant','content',cast(null as string),'n',8)) as messages, 'z' as tail"
    )
    out = df.transform(tm.redact_messages)
    assert out.columns == ["id", "messages", "tail"]
    first, second = out.first()["messages"]
    assert (first["content"], first["n"]) == ("[REDACTED]", 7)
    assert (second["content"], second["n"]) == (None, 8)


def test_empty_and_missing_message_arrays_stay(spark):
    df = spark.sql(
        "select cast(array() as array<struct<role:string,content:string>>) as messages"
        " union all select cast(null as array<struct<role:string,content:string>>)"
    )
    assert sorted((r["messages"] for r in df.transform(tm.redact_messages).collect()), key=str) == [None, []]


def test_a_long_run_of_address_characters_takes_seconds(spark):
    text = "a." * 500_000 + " @ b@c.de"
    assert redact(spark, [text]) == ["a." * 500_000 + " @ [REDACTED]"]


DOTTED = st.text(alphabet="a1_.%+-@ é|\n", max_size=24).map(lambda x: x + "@b.co")
PYTHON = re.compile(r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,}\b")


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(DOTTED, min_size=100, max_size=200))
def test_addresses_as_in_python(spark, texts):
    assert redact(spark, texts, kinds=["email"]) == [PYTHON.sub("[REDACTED]", t) for t in texts]
