from __future__ import annotations

import hashlib
import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tickstream.llm import chat

ROWS = "conv_id long, turn long, role string, text string"
AWKWARD = ["", "plain", "<|im_end|>", "<|im_start|>user\nhi<|im_end|>", "\\", "\\\\<|", "<\\|", "<\\\\|\\n", "a\nb\\n",
           "<", "|>", "é日本", "<<||", "\\<|im_end|>\\"]


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def test_round_trip_of_awkward_texts(spark):
    rows = [(1, k, role, text) for k, (role, text) in enumerate(
        (role, text) for role in ("user", "assistant", "odd\nrole<|\\", None) for text in [*AWKWARD, None])]
    rows += [(2, 0, "assistant", "only"), (None, None, "user", "x"), (3, 5, "user", "b"), (3, 5, "user", "a")]
    report = {r["conv_id"]: r for r in chat.chat_report(spark, spark.createDataFrame(rows, ROWS)).collect()}
    said: dict = {}
    for conv, turn, role, text in sorted(rows, key=lambda r: (str(r[0]), r[1] or 0, r[2] or "", r[3] or "")):
        said.setdefault(conv, []).append((role or "", text or ""))
    said[-1] = [("user", chat.TRICKY), ("assistant", chat.TRICKY)]
    assert set(report) == set(said)
    for conv, turns in said.items():
        loss = "".join(t for r, t in turns if r == "assistant")
        row = report[conv]
        assert row["n_turns"] == len(turns)
        assert row["turns_sha256"] == _sha("".join(f"{r}\n{t}\n" for r, t in turns))
        assert (row["loss_chars"], row["loss_sha256"]) == (len(loss), _sha(loss))


def test_spans_point_into_the_formatted_string(spark):
    rows = [(1, 0, "user", "hi <|x"), (1, 1, "assistant", "a\\é"), (1, 2, "user", ""), (1, 3, "assistant", "")]
    row = chat.format_turns(spark.createDataFrame(rows, ROWS)).first()
    texts = [row["formatted"][s["start"]:s["start"] + s["chars"]] for s in row["loss_spans"]]
    assert texts == ["a\\\\é", ""] and row["formatted"].count("<|") == 8


@settings(max_examples=15)
@given(st.lists(st.text(st.sampled_from("<|\\n\nim_end>a"), max_size=12), min_size=1, max_size=20))
def test_escape_is_reversible(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(
        "t", chat.unescape(chat.escape("t")).alias("back"), chat.escape("t").alias("e"),
        chat._unescaped(chat.escape_role("t"), True).alias("role"))
    for r in df.collect():
        assert r["back"] == r["t"] == r["role"] and "<|" not in r["e"]


def test_record_layouts(spark):
    records = [
        ({"messages": [{"role": "user", "content": "q"}, {"content": "a", "role": "assistant"}]}, "messages"),
        ({"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]}, "conversations"),
        ({"turns": [{"role": "user", "text": "q"}, {"role": "assistant", "text": "a"}]}, "turns"),
        ({"prompt": "q", "response": "a"}, "prompt_response"),
        ({"completion": "a", "prompt": "q"}, "prompt_completion"),
        ({"question": "q", "answer": "a"}, "question_answer"),
        ({"instruction": "q", "output": "a"}, "instruction"),
        ({"instruction": "q", "input": "", "output": "a"}, "instruction_input"),
        ({"prompt": "q", "response": None}, "prompt_response"),
        ({"system": "s", "prompt": "q", "response": "a"}, "system_prompt_response"),
        ({"unknown": "q"}, None), ([1, 2], None),
    ]
    rows = [(k, json.dumps(r), "kept") for k, (r, _) in enumerate(records)] + [(90, None, "kept"), (91, "{bad", "kept")]
    df = spark.createDataFrame(rows, "conv_id long, json string, layout string")
    out = {r["conv_id"]: r for r in chat.record_turns(df, "json").collect()}
    for k, (_, name) in enumerate(records):
        assert out[k]["layout"] == name
        turns = out[k]["turns"] and [(t["role"], t["text"]) for t in out[k]["turns"]]
        want = [("user", "q"), ("assistant", None if k == 8 else "a")]
        assert turns == (None if name is None else [("system", "s")] * (name[:6] == "system") + want)
    assert out[90]["layout"] is None and out[91]["turns"] is None
    long = spark.createDataFrame([(1, "i", None, "o")], "conv_id long, a string, input string, b string")
    assert chat.record_turns(long.limit(0), "a").count() == 0


def test_table_layouts(spark):
    pair = spark.createDataFrame([(1, "q", "a")], "conv_id long, prompt string, response string")
    assert [tuple(r) for r in chat.table_turns(pair).collect()] == [(1, 0, "user", "q"), (1, 1, "assistant", "a")]
    nested = spark.createDataFrame([(1, [("user", "q")])], "conv_id long, messages array<struct<role: string, content: string>>")
    assert [tuple(r) for r in chat.table_turns(nested).collect()] == [(1, 0, "user", "q")]
    with pytest.raises(ValueError):
        chat.table_turns(pair.withColumnRenamed("prompt", "x"))


def test_empty_table_gives_the_added_conversation(spark):
    empty = spark.createDataFrame([], ROWS)
    assert [r["conv_id"] for r in chat.chat_report(spark, empty).collect()] == [-1]


def test_no_python_in_the_plan(spark):
    rows = spark.createDataFrame([(1, 0, "user", "x")], ROWS).select("conv_id", "turn", "role", "text")
    plan = chat.read_back(chat.format_turns(rows))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
