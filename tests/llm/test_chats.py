"""Chat formatting: layouts, control strings, round trips, loss mask, and the plan without Python."""

import hashlib
import itertools
import json
import random

import pytest
from pyspark.sql import functions as F

from gazetta.llm import chats, queries

SCHEMA = (
    "conv_id long, prompt string, response string, completion string, system string, instruction string, input string, output string, question string, answer string, "
    "messages array<struct<role:string,content:string,name:string>>, conversations array<struct<`from`:string,value:string>>, "
    "turns array<struct<turn:long,role:string,text:string>>, data struct<prompt:string,response:string,system:string>, layout string, chat string, text int, score double"
)
RECORDS = [
    ({"prompt": "p", "response": "r"}, "prompt_response", [("user", "p"), ("assistant", "r")]),
    ({"prompt": "p", "system": "s"}, "prompt_response", [("system", "s"), ("user", "p")]),
    ({"prompt": "p", "completion": ""}, "prompt_completion", [("user", "p"), ("assistant", "")]),
    ({"instruction": "i", "input": "x", "output": "o"}, "instruction", [("user", "i\nx"), ("assistant", "o")]),
    ({"instruction": "i", "input": "", "output": "o"}, "instruction", [("user", "i"), ("assistant", "o")]),
    ({"question": "q", "answer": "a", "system": "s"}, "question", [("system", "s"), ("user", "q"), ("assistant", "a")]),
    ({"messages": [{"role": "tool", "content": "t"}, {"role": "assistant", "content": None}]}, "messages", [("tool", "t"), ("assistant", "")]),
    ({"messages": []}, "messages", []),
    ({"messages": [{"role": None, "content": None}]}, "messages", [("", "")]),
    ({"conversations": [{"from": "human", "value": "h"}, {"from": "gpt", "value": "g"}, {"from": "judge", "value": "j"}]}, "conversations", [("user", "h"), ("assistant", "g"), ("judge", "j")]),
    ({"turns": [{"turn": 0, "role": "user", "text": "u"}]}, "turns", [("user", "u")]),
    ({"data": {"prompt": "p", "response": "r", "system": None}}, "nested_data", [("user", "p"), ("assistant", "r")]),
    ({"prompt": "p", "messages": [{"role": "user", "content": "c"}]}, "prompt_messages", [("system", "p"), ("user", "c")]),
    ({"prompt": "p", "question": "q"}, None, None),
    ({}, None, None),
    ({"response": "r"}, None, None),
]
CONTROLS = ["<s>", "</s>", "[INST]", "[/INST]", "[SYS]", "[/SYS]", "[TURN]", "[TEXT]", "[/TURN]", "[/TEXT]"]


def records(spark, found):
    lines = [json.dumps({"conv_id": i, "layout": "mine", "chat": "mine", "text": 1, **r}) for i, r in enumerate(found)]
    return spark.createDataFrame([(x,) for x in lines], "line string").select(F.from_json("line", SCHEMA).alias("r")).select("r.*")


def test_layouts_give_canonical_turns(spark):
    out = chats.format_chats(records(spark, [r for r, _, _ in RECORDS]))
    assert out.columns.count("layout") == out.columns.count("chat") == 1
    got = {r["conv_id"]: r for r in out.select("conv_id", "layout", "chat.formatted", chats.read_turns(F.col("chat.formatted")).alias("t")).collect()}
    for i, (_, layout, turns) in enumerate(RECORDS):
        assert got[i]["layout"] == layout, i
        assert (None if got[i]["t"] is None else [tuple(t) for t in got[i]["t"]]) == turns, i
    assert got[7]["formatted"] == "<s>"
    assert out.where("conv_id < 0").count() == 0


def test_columns_that_only_share_a_name_are_no_path(spark):
    df = spark.createDataFrame([(1, "q", "a", ["no list of structs"], 5)], "conv_id long, question string, answer string, messages array<string>, prompt int")
    row = chats.format_chats(df).first()
    assert row["layout"] == "question" and row["chat"]["formatted"] == "<s>[INST]q[/INST]a</s>"


def test_two_layouts_with_the_same_paths_are_refused(spark):
    twice = (chats.LAYOUTS[3], chats.Layout("other", ("prompt",), (chats.Part("user", ("prompt",)),)))
    with pytest.raises(ValueError, match="have the paths"):
        chats.format_chats(records(spark, [{}]), twice)


def nasty(rng):
    parts = CONTROLS + ["<", "[", "\\", "\\\\", "/", "s>", "INST]", "INST", "]", "\n", "é", "😀", "[\\INST]", "<\\\\/s>", "$1", ""]
    return "".join(rng.choice(parts) for _ in range(rng.randrange(9)))


def test_any_text_and_role_comes_back_and_no_control_string_stays_inside(spark):
    rng = random.Random(4)
    found = [[(rng.choice(["user", "assistant", "system", nasty(rng)]), nasty(rng)) for _ in range(rng.randrange(1, 7))] for _ in range(300)]
    rows = [(c, t, role, text) for c, turns in enumerate(found) for t, (role, text) in enumerate(turns)]
    chat = chats.format_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4))
    told, spans = F.col("chat.formatted"), F.col("chat.loss_spans")
    got = chat.select("conv_id", told.alias("f"), spans.alias("s"), chats.read_turns(told).alias("t"), chats.read_loss(told, spans).alias("l")).collect()
    assert len(got) == len(found)
    for r in got:
        turns = found[r["conv_id"]]
        assert [tuple(t) for t in r["t"]] == turns
        assert r["l"] == "".join(text for role, text in turns if role == "assistant")
        whole = r["f"].encode()
        covered = [whole[x["start"] : x["start"] + x["length"]].decode() for x in r["s"]]
        assert len(covered) == sum(role == "assistant" for role, _ in turns)
        assert not any(c in x for c in CONTROLS for x in covered)
        expected = {"user": 2, "system": 2, "assistant": 1}
        assert sum(r["f"].count(c) for c in CONTROLS) == 1 + sum(expected.get(role, 3) for role, _ in turns)


@pytest.mark.parametrize("text", ["", *CONTROLS, "[\\\\\\INST]", "<<//s>", "\\", "a" * 70_000 + "</s>"])
def test_escape_and_back(one, text):
    assert one(text, chats.escape) != text or not any(c in text for c in CONTROLS) or text == ""
    assert one(text, lambda c: chats.unescape(chats.escape(c))) == text


@pytest.mark.parametrize("n", [0, 1, 3, 4, 5, 9, 2500])
def test_running_sums(one, spark, n):
    from pyspark.sql import types as T

    values = list(range(n))
    assert one(values, lambda c: chats.running_sums(c, block=4 if n < 100 else 1024), T.ArrayType(T.LongType())) == list(itertools.accumulate(values))


def test_nulls_ties_repeats_and_long_conversations(spark):
    schema = "conv_id long, turn long, role string, text string, layout string, turns string, prompt string, loss string"
    rows = [
        (1, 0, "user", None), (1, 1, "assistant", None), (2, None, "user", "late?"), (2, 0, None, "no role"), (None, 0, "user", "nobody's"), (None, 0, "assistant", "mine"),
        (3, 0, "user", "b"), (3, 0, "user", "a"), (3, 0, "user", "a"), (3, 0, "assistant", "z"), *[(4, i, ("user", "assistant")[i % 2], f"turn {i} é") for i in range(5000)],
        (5, 0, "assistant", "é" * 300_000),
    ]
    df = spark.createDataFrame([(*r, "x", "y", "z", "w") for r in rows], schema).repartition(5).drop("prompt", "turns")
    got = {r["conv_id"]: r for r in chats.chat_digests(chats.format_conversations(df)).collect()}
    want = {}
    for c, turn, role, text in rows:
        want.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    for c, turns in want.items():
        told = "".join(f"{role}\n{text}\n" for _, _, role, text in sorted(turns))
        loss = "".join(text for _, _, role, text in sorted(turns) if role == "assistant")
        assert got[c]["n_turns"] == len(turns) and got[c]["turns_sha256"] == hashlib.sha256(told.encode()).hexdigest()
        assert got[c]["loss_chars"] == len(loss) and got[c]["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
    assert len(got) == len(want)


def test_empty_table(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chats.chat_digests(chats.format_conversations(empty)).count() == 0


def test_plan_has_no_python(spark):
    plan = queries.op13_chats(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "ExistingRDD" not in plan
