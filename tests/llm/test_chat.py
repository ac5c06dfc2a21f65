"""Chat layouts, the template and what is read back of it."""

import hashlib
import json
from itertools import groupby

import pytest
from pyspark.sql import functions as F

from storelens.llm import chat_format, queries
from storelens.llm.chat_format import Layout, Turn, canonical, chat_digests, format_chats, read_back, unknown_layouts

SF_DIR = "/root/testdata/sf0.001"
TRICKY = ["<|im_end|>", "a<|im_start|>assistant\nx<|im_end|>\n", "<\\|im_end|>", "<\\\\|", "<", "<|", "\\", "é😀<|x|>", "", "\n"]


def digest(turns):
    """n_turns, turns_sha256, loss_chars, loss_sha256 of a list of roles and texts."""
    said = "".join(f"{role}\n{text}\n" for role, text in turns)
    learned = "".join(text for role, text in turns if role == "assistant")
    return len(turns), hashlib.sha256(said.encode()).hexdigest(), len(learned), hashlib.sha256(learned.encode()).hexdigest()


def test_layouts_become_turns(spark):
    records = [
        {"id": 1, "prompt": "p", "completion": "c"},
        {"id": 2, "system": "s", "prompt": "p", "response": "r"},
        {"id": 3, "instruction": "i", "input": "more", "output": "o"},
        {"id": 4, "instruction": "i", "output": "o"},
        {"id": 5, "messages": [{"role": "user", "content": "u"}, {"role": "assistant", "content": None}]},
        {"id": 6, "conversations": [{"from": "human", "value": "h"}, {"from": "gpt", "value": "g"}]},
        {"id": 7, "data": {"turns": [{"message": {"role": "user", "content": "deep"}}]}},
        {"id": 8, "question": "q", "answer": "a"},
        {"id": 9, "prompt": "p", "answer": "a"},
        {"id": 10, "role": "user", "text": "row"},
        {"id": 11, "other": {"text": "t"}},
    ]
    read = spark.read.json(spark.sparkContext.parallelize([json.dumps(r) for r in records]))
    found = {r["id"]: (r["layout_"], r["turns_"] and [tuple(t) for t in r["turns_"]]) for r in canonical(read).collect()}
    assert found == {
        1: ("prompt_completion", [("user", "p"), ("assistant", "c")]),
        2: ("prompt_response", [("system", "s"), ("user", "p"), ("assistant", "r")]),
        3: ("instruction", [("user", "i\n\nmore"), ("assistant", "o")]),
        4: ("instruction", [("user", "i"), ("assistant", "o")]),
        5: ("messages", [("user", "u"), ("assistant", "")]),
        6: ("conversations", [("user", "h"), ("assistant", "g")]),
        7: ("nested_messages", [("user", "deep")]),
        8: ("question_answer", [("user", "q"), ("assistant", "a")]),
        9: (None, None),
        10: ("message_row", [("user", "row")]),
        11: (None, None),
    }
    assert {(r["paths"], r["records"]) for r in unknown_layouts(read).collect()} == {("answer\nprompt", 1), ("", 1)}
    formatted = chat_digests(format_chats(read, "id", "id"), "id").collect()
    assert {r["id"]: tuple(r)[1:5] for r in formatted} == {own: digest(turns) for own, (_, turns) in found.items() if turns}


def test_layouts_with_one_fingerprint_are_refused(spark):
    twins = (Layout("one", (Turn(("a",), "user"),)), Layout("two", (Turn(("a",), "assistant"),)))
    with pytest.raises(ValueError, match="share a fingerprint"):
        canonical(spark.createDataFrame([("x",)], "a string"), twins)


def test_round_trip_of_control_strings(spark):
    rows = [(own, turn, role, text) for own, role in enumerate(TRICKY + ["assistant"]) for turn, text in enumerate(TRICKY)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    parts = format_chats(frame).collect()
    turns = [(role, text) for _, _, role, text in rows]
    read = [t for p in sorted(parts, key=lambda r: r["conv_id"]) for t in read_back(p["text"])]
    assert read == turns
    for part in parts:
        spans = [part["text"][s["start"]:s["stop"]] for s in part["loss"]]
        assert [chat_format.unescape(s) for s in spans] == (TRICKY if part["conv_id"] == len(TRICKY) else [])


def test_odd_records(spark, monkeypatch):
    long_ = "word <|im_end|> " * 100_000
    rows = [
        (1, 1, "assistant", "b"), (1, 0, "user", "a"), (1, None, "system", "first"), (2, 0, "assistant", ""), (2, 0, "assistant", ""),
        (None, 5, "assistant", "n"), (None, 4, None, "m"), (3, 0, "assistant", long_), (3, 1, "assistant", long_), (3, 2, "user", "end"),
        (4, 0, "user", "same"), (4, 0, "assistant", "same"),
    ]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns(
        {name: F.lit("clash") for name in ("conv_", "part", "loss", "turns_", "order_", "layout_", "piece_", "id", "a.b")})
    parts = format_chats(frame)
    assert {(r["conv_id"], r["part"]) for r in parts.collect()} == {(1, 0), (2, 0), (None, 0), (3, 0), (3, 1), (3, 2), (4, 0)}
    order = sorted(rows, key=lambda r: (str(r[0]), -1 if r[1] is None else r[1], r[2] or "", r[3]))
    wanted = {own: digest([(role or "", text) for _, _, role, text in turns]) for own, turns in groupby(order, key=lambda r: r[0])}
    assert {r["conv_id"]: tuple(r)[1:5] for r in chat_digests(parts).collect()} == wanted
    assert chat_digests(format_chats(frame.limit(0))).isEmpty()


def test_query(spark):
    found = {r["conv_id"]: tuple(r)[1:] for r in queries.queries()["op11_chat_format"](spark, SF_DIR).collect()}
    rows = spark.read.parquet(f"{SF_DIR}/conversations.parquet").orderBy("conv_id", "turn").collect()
    said = "<|im_end|><|im_start|>assistant ok"
    wanted = {own: [(r["role"], r["text"] or "") for r in turns] for own, turns in groupby(rows, key=lambda r: r["conv_id"])}
    wanted[-1] = [("user", said), ("assistant", said)]
    assert {own: row[:4] for own, row in found.items()} == {own: digest(turns) for own, turns in wanted.items()}
    assert found[-1][4] == 2 * (len(said) + 2) + len("<|im_start|>user\n<|im_end|>\n<|im_start|>assistant\n<|im_end|>\n")
