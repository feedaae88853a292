"""Layouts to turns, and the template read back."""

import hashlib
import json

import pytest
from hypothesis import given
from hypothesis import strategies as st

from seriesforge.llm import chat as C

SF = "/root/testdata/sf0.01"


def test_sql(spark):
    from oracle_harness import compare
    assert compare(spark, "op4", C.op4_chat_formatting, C.ORACLE_SQL, SF) == []


TEXT = st.lists(st.sampled_from([*C.CONTROLS, "\\", "<", "[", ">", "|", "\n", "%", "%0A", "s>", "INST]", "é", "x"]), max_size=12).map("".join)


@given(TEXT, TEXT)
def test_every_text_and_role_comes_back(role, text):
    out, lo, hi = C.render(role, text)
    assert C.read_turn(out) == (role, text) and C.unescape(out[lo:hi]) == text
    assert not any(c in C.escape(text) for c in C.CONTROLS)
    assert C.TURN.pattern and out.count(C.END) == 1


@given(st.lists(st.tuples(TEXT, TEXT), max_size=5))
def test_turns_of_one_string_come_back(turns):
    import re
    whole = "".join(C.render(*t)[0] for t in turns)
    parts = re.findall(r"<\|im_start\|>[^\n]*\n.*?<\|im_end\|>\n", whole, re.S)
    assert [C.read_turn(p) for p in parts] == turns


def test_layouts(spark):
    records = [
        {"id": 1, "prompt": "p", "response": "r"}, {"completion": "c", "prompt": "p", "id": 2}, {"id": 3, "instruction": "i", "output": "o"},
        {"id": 4, "instruction": "i", "input": "in", "output": "o"}, {"id": 5, "instruction": "i", "input": "", "output": "o"},
        {"id": 6, "messages": [{"role": "system", "content": "s"}, {"role": "user", "content": None}]}, {"id": 7, "conversations": [{"from": "human", "value": "h"}, {"from": "gpt", "value": "g"}]},
        {"id": 8, "system_prompt": "s", "question": "q", "response": "r"}, {"conv_id": 9, "turn": 3, "role": "user", "text": "t"},
        {"id": 10, "other": 1}, {"id": 11, "messages": []}, [], "text",
    ]
    rows = [(json.dumps(r),) for r in records] + [(None,), ("{broken",)]
    turns, rest = C.turns_of_json(spark.createDataFrame(rows, "record string"))
    got = sorted((int(r.conv_id), r.turn, r.role, r.text) for r in turns.collect())
    assert got == [
        (1, 0, "user", "p"), (1, 1, "assistant", "r"), (2, 0, "user", "p"), (2, 1, "assistant", "c"), (3, 0, "user", "i"), (3, 1, "assistant", "o"),
        (4, 0, "user", "i\n\nin"), (4, 1, "assistant", "o"), (5, 0, "user", "i"), (5, 1, "assistant", "o"), (6, 0, "system", "s"), (6, 1, "user", ""),
        (7, 0, "user", "h"), (7, 1, "assistant", "g"), (8, 0, "system", "s"), (8, 1, "user", "q"), (8, 2, "assistant", "r"), (9, 3, "user", "t")]
    assert rest.count() == 6


def test_mixed_optional_and_odd_records(spark):
    """No turn loses its text: a record is mapped whole or not at all."""
    say = lambda *m: {"messages": [*m]}
    u, a = {"role": "user", "content": "q"}, {"role": "assistant", "content": "r"}
    good = [
        {"id": "abc", **say(u, a)}, {"id": "def", **say(a)}, {"id": 7, **say({**u, "name": "n"}, a)}, {"id": 8, **say(u, {**a, "name": "n"})},
        {"id": 9, **say({"role": "user"}, a)}, {"id": None, **say(u)}, {"id": None, **say(a)}, {"id": 10, "conversations": [{"from": "human", "value": "h", "weight": 0}, {"from": "gpt", "value": "g"}]}, {"id": 11, "conversations": [{"from": "gpt", "value": 5}]},
        {"id": 2.5, "prompt": "p", "response": None}]
    bad = [
        {"id": 1, **say(u, {"from": "gpt", "value": "LOST"})}, {"id": 2, **say(u, {"role": "assistant", "content": ["LOST"]})}, {"id": 3, **say(u, {"role": "assistant", "content": {"text": "LOST"}})},
        {"id": 4, **say()}, {"id": 5, **say(u, "LOST")}, {"id": 6, **say({**u, "tool": "LOST"}, a)}, {"id": 7, "messages": None}, {"messages": [u]}, {"id": 8, "messages": u}, {"id": 12, **say(u, {"role": "assistant", "content": 5})}]
    df = spark.createDataFrame([(json.dumps(r),) for r in good + bad] + [("{",), (None,), ("",)], "record string")
    turns, rest = C.turns_of_json(df)
    got = {}
    for r in turns.collect():
        got.setdefault(r.conv_id, []).append((r.turn, r.role, r.text))
    own = lambda r: hashlib.sha256(json.dumps(r).encode()).hexdigest()
    assert {k: sorted(v) for k, v in got.items()} == {
        "abc": [(0, "user", "q"), (1, "assistant", "r")], "def": [(0, "assistant", "r")], "7": [(0, "user", "q"), (1, "assistant", "r")], "8": [(0, "user", "q"), (1, "assistant", "r")],
        "9": [(0, "user", ""), (1, "assistant", "r")], own(good[5]): [(0, "user", "q")], own(good[6]): [(0, "assistant", "r")], "10": [(0, "user", "h"), (1, "assistant", "g")], "11": [(0, "assistant", "5")],
        "2.5": [(0, "user", "p"), (1, "assistant", "")]}
    assert sorted(r.record or "" for r in rest.collect()) == sorted([json.dumps(r) for r in bad] + ["{", "", ""])
    digests = {r.conv_id: r.n_turns for r in C.read_back(C.formatted(turns)).collect()}
    assert digests == {k: len(v) for k, v in got.items()}


def test_table_layouts(spark):
    nested = spark.createDataFrame([(1, [("user", "a"), ("assistant", "b")], "extra")], "id bigint, messages array<struct<role:string,content:string>>, note string")
    assert sorted(tuple(r) for r in C.turns_of_table(nested).collect()) == [(1, 0, "user", "a"), (1, 1, "assistant", "b")]
    with pytest.raises(ValueError):
        C.turns_of_table(spark.createDataFrame([(1,)], "x int"))
    assert len(C.registry()) == sum(2 ** len(m.optional) for m in C.MAPPINGS)


def test_ties_nulls_long_and_empty(spark):
    long = "</s>" * 100_000
    rows = [(1, 1, "user", "b"), (1, 1, "user", "a"), (1, None, None, None), (1, 0, "assistant", long), (1, 0, "assistant", long), (2, 0, "tool\nx", "[INST]"), (None, 0, "assistant", "z"), (None, 1, "assistant", None)]
    rows += [(3, i, "assistant", f"t{i}") for i in range(25_000)]
    turns = spark.createDataFrame([(*r, 1) for r in rows], "conv_id bigint, turn bigint, role string, text string, formatted int")
    got = {r.conv_id: r for r in C.read_back(C.formatted(C.turns_of_table(turns))).collect()}
    for conv in (1, 2, 3, None):
        own = sorted(((t is not None, t, r or "", x or "") for c, t, r, x in rows if c == conv), key=lambda r: (r[0], r[1] or 0, r[2], r[3]))
        loss = "".join(x for _, _, r, x in own if r == "assistant")
        assert got[conv].n_turns == len(own) and got[conv].turns_sha256 == hashlib.sha256("".join(f"{r}\n{x}\n" for _, _, r, x in own).encode()).hexdigest()
        assert got[conv].loss_chars == len(loss) and got[conv].loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
        assert got[conv].formatted_chars == sum(len(C.render(r, x)[0]) for _, _, r, x in own)
    assert C.read_back(C.formatted(C.turns_of_table(turns.limit(0)))).collect() == []
