import pytest
from pyspark.sql import functions as F

import turnmill as tm

SCHEMA = "id int, messages array<struct<role:string,content:string>>, prompt string"


@pytest.fixture
def chats(spark):
    return spark.createDataFrame(
        [
            (1, [("user", "Hi"), ("assistant", "Yo")], None),
            (2, [("sYSTEM", "Be brief"), ("user", "Hi")], "asked"),
            (3, [("user", "Hi"), ("assistant", None)], None),
            (4, [], None),
            (5, None, "asked"),
            (6, None, None),
            (7, [("deep thinker", "a\nb")], ""),
        ],
        SCHEMA,
    )


def column(df, col):
    return [r[0] for r in df.orderBy("id").select(col).collect()]


def test_plain(chats):
    assert column(chats, tm.render_chat(F.col("messages"))) == [
        "User: Hi\nAssistant: Yo",
        "System: Be brief\nUser: Hi",
        None,
        "",
        None,
        None,
        "Deep thinker: a\nb",
    ]


def test_plain_ignores_generation_prompt(chats):
    plain = tm.render_chat(F.col("messages"))
    asked = tm.render_chat(F.col("messages"), add_generation_prompt=True)
    assert column(chats, plain) == column(chats, asked)


def test_template(chats):
    one = chats.where("id = 1")
    template = tm.ChatTemplate("<s>", "[", "] ", "</t>", generation_prefix="[assistant] ")
    assert column(one, tm.render_chat(F.col("messages"), template)) == ["<s>[user] Hi</t>[assistant] Yo</t>"]
    assert column(one, tm.render_chat(F.col("messages"), template, True)) == [
        "<s>[user] Hi</t>[assistant] Yo</t>[assistant] "
    ]


def test_concat(chats):
    assert column(chats, tm.concat_messages(F.col("messages"))) == ["Hi Yo", "Be brief Hi", None, "", None, None, "a\nb"]


def test_eval_prompt(chats):
    got = {r["id"]: (r["model_prompt"], r["error"]) for r in tm.eval_prompts(chats).collect()}
    assert got[1] == ("User: Hi\nAssistant: Yo\nAssistant:", None)
    assert got[2] == ("System: Be brief\nUser: Hi\nAssistant:", None)
    assert got[4] == ("\nAssistant:", None)
    assert got[5] == ("asked", None)
    assert got[6] == (None, "Sample must have 'messages' or 'prompt' field")


def test_eval_prompt_with_template(chats):
    got = tm.eval_prompts(chats.where("id = 1"), tm.CHATML).first()["model_prompt"]
    assert got == "<|im_start|>user\nHi<|im_end|>\n<|im_start|>assistant\nYo<|im_end|>\n<|im_start|>assistant\n"


def test_preview(spark):
    rows = [(i, [("user", "q" * 201), ("assistant", "a" * 200)]) for i in range(20)]
    df = spark.createDataFrame(rows, "id int, messages array<struct<role:string,content:string>>")
    shown = tm.preview(df, "id", n=2).orderBy("sample_no", "msg_idx").collect()
    assert [(r["sample_no"], r["msg_idx"], r["role"]) for r in shown] == [
        (1, 0, "USER"),
        (1, 1, "ASSISTANT"),
        (2, 0, "USER"),
        (2, 1, "ASSISTANT"),
    ]
    assert shown[0]["content"] == "q" * 200 + "..." and shown[1]["content"] == "a" * 200
    assert [r["id"] for r in tm.smoke_sample(df, "id", 2).collect()] == [shown[0]["id"], shown[2]["id"]]
