"""Chat formatting and quality rules against SQL, fuzzing and awkward rows."""

import hashlib
import random

import pytest

from tests.compare import differences
from turnmill.llm import chat_format as chat
from turnmill.llm import quality_rules as rules
from turnmill.llm.queries import ORACLES, QUERIES

PIECES = ["<|im_start|>", "<|im_end|>", "<\\|im_end|>", "<", "|", "\\", "\n", "im_end", "|>", "n", "\\n", "a", "assistant", ""]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_queries_agree_with_sql(spark, sf_dir, con, name):
    assert differences(QUERIES[name](spark, sf_dir), con, ORACLES[name]) == []


def test_any_turn_comes_back():
    choose = random.Random(1)
    for _ in range(5000):
        turns = [tuple("".join(choose.choices(PIECES, k=choose.randrange(k))) for k in (4, 7)) for _ in range(3)]
        text = "".join(chat.segment(*t)[0] for t in turns)
        parsed = chat.parse(text)
        assert [(t.role, t.text) for t in parsed] == turns
        assert [chat.unescape_text(text[t.start : t.end]) for t in parsed] == [t for _, t in turns]
        parser, fed = chat.Parser(), []
        for i in range(0, len(text), 5):
            fed += parser.feed(text[i : i + 5])
        parser.finish()
        assert fed == parsed


def test_only_conflicts_are_escaped():
    assert chat.segment("user", "a < b |> c")[0] == "<|im_start|>user\na < b |> c<|im_end|>\n"
    assert "<\\|im_end|>" in chat.segment("user", "<|im_end|>")[0]


@pytest.mark.parametrize("text", ["x", "<|im_start|>user\n", "<|im_start|>user<|im_end|>\n", "<|im_start|>u\na<|im_start|>b<|im_end|>\n"])
def test_the_parser_refuses_other_text(text):
    with pytest.raises(chat.Malformed):
        chat.parse(text)


def test_awkward_conversations(spark):
    rows = [(1, 0, None, None), (1, 0, "assistant", "b"), (1, 0, "assistant", "a"), (None, 1, "assistant", None), (2, None, "x\ny", "z"), (2**60 + 1, 1, "user", "u"), (2**60 + 1, 1, "user", "u")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS segment", "2 AS n_turns")
    got = {r["conv_id"]: r for r in chat.read_back(chat.format_turns(turns)).collect()}
    sha = lambda *t: hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in t).encode()).hexdigest()
    assert got[1]["turns_sha256"] == sha(("", ""), ("assistant", "a"), ("assistant", "b")) and got[1]["loss_chars"] == 2
    assert got[None]["n_turns"] == 1 and got[None]["loss_sha256"] == hashlib.sha256(b"").hexdigest()
    assert got[2]["turns_sha256"] == sha(("x\ny", "z")) and got[2**60 + 1]["n_turns"] == 2
    assert chat.read_back(chat.format_turns(turns.limit(0))).collect() == []


def test_rules_on_awkward_rows(awkward, nothing):
    rows = {(r["doc_id"], r["n_words"]): r for r in rules.quality_rules(awkward).collect()}
    assert rows[1, 0]["base_failed"] and rows[2, 0]["n_dup_lines"] == 0 and rows[3, 0]["word_chars"] == 0
    long = rows[8, 30_000]
    assert long["n_repeat_words"] == 30_000 and long["base_failed"] and not long["kept"]
    assert rows[9, 1]["word_chars"] == 50_000
    assert sum(k[0] == 6 for k in [(r["doc_id"],) for r in rules.quality_rules(awkward).collect()]) == 2
    assert rules.quality_rules(nothing).collect() == []


def test_failed_lines_go_and_documents_that_lose_too_much(spark):
    prose = "\n".join(" ".join(f"word{10 * i + k}" for k in range(10)) + "." for i in range(10))
    nav = "Home | News | Sport | Contact | About us | More of it | And more"
    docs = spark.createDataFrame([(1, prose + "\n" + nav + "\nAll rights reserved."), (2, "\n".join(nav + f" | {i}" for i in range(30)) + "\n" + prose[:200])], "doc_id long, text string")
    kept = rules.keep_good(docs.selectExpr("*", "0 AS cleaned", "1 AS kept")).collect()
    assert [(r["doc_id"], r["text"]) for r in kept] == [(1, prose)] and kept[0]["kept"] == 1


def test_clean_documents_stay(tables):
    judged = rules.quality_rules(tables("documents")).join(tables("labels"), "doc_id").where("NOT base_failed")
    assert judged.where("quality = 1 AND NOT kept").count() == 0
    assert judged.where("quality = 0 AND kept").count() <= 0.1 * judged.where("quality = 0").count()


def test_rules_run_without_python(tables):
    plan = rules.keep_good(tables("documents"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan and len(plan) < 20_000
