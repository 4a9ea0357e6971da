"""Operator 9: the oracle, topological order, validation, canonical JSON."""

import json
import random

import duckdb
import pytest

from sparkmart.llm import chat
from sparkmart.llm.queries import ORACLES, op9_chat

SF = "/root/testdata/sf0.01"
CALLS = "conv long, call_id string, turn long, name string, arguments string, depends_on array<string>, level int"
RESULTS = "conv long, call_id string, turn long, content string, status string"


def test_query_against_its_sql(spark):
    con = duckdb.connect()
    con.sql(f"create view conversations as select * from read_parquet('{SF}/conversations.parquet')")
    rel = con.sql(ORACLES["op9_chat"])
    df = op9_chat(spark, SF)
    assert sorted(df.columns) == sorted(rel.columns)
    got = sorted((tuple(r[c] for c in rel.columns) for r in df.collect()), key=str)
    assert got == sorted(rel.fetchall(), key=str)


def run(spark, calls, results, schemas=chat.SCHEMAS):
    df = chat.format_calls(spark.createDataFrame([(*c, 0) for c in calls], CALLS),
                           spark.createDataFrame([(*r, "s") for r in results], RESULTS), schemas)
    return sorted(df.collect(), key=lambda r: (r.conv is not None, r.conv or 0, r.position))


def test_statuses(spark):
    ok = json.dumps({"prompt": "p", "turn": 1})
    calls = [(1, "a", 0, "respond", ok, []), (1, "a2", 1, "respond", ok, None), (1, "dup", 2, "respond", ok, []),
             (1, "dup", 3, "respond", ok, []), (1, None, 4, "respond", ok, []), (2, "a", 0, "respond", ok, []),
             (2, "a", 0, "respond", ok, []), (None, "n", None, "other", "{", [])]
    results = [(1, "a", 1, "late"), (1, "a", 0, "first"), (1, "lost", 9, "x"), (1, "dup", 5, "y"), (None, "n", 1, None)]
    rows = run(spark, calls, results)
    got = {(r.conv, r.call_id, r.turn): (r.status, r.n_results) for r in rows}
    assert got == {(1, "a", 0): ("linked", 2), (1, "a2", 1): ("no_result", 0), (1, "dup", 2): ("repeated_call", 1),
                   (1, "dup", 3): ("repeated_call", 1), (1, None, 4): ("no_id", 0), (1, "lost", 9): ("no_call", 1),
                   (2, "a", 0): ("no_result", 0), (None, "n", None): ("linked", 1)}
    assert rows[1].json == '{"arguments":{"prompt":"p","turn":1},"id":"a","name":"respond","result":"first"}'
    assert rows[0].error == "$: not JSON" and [r.position for r in rows] == [0, 0, 1, 2, 3, 4, 5, 0]


def test_a_call_without_name_and_arguments_is_still_a_call(spark):
    rows = run(spark, [(1, "a", 0, None, None, [])], [(1, "a", 1, "r"), (1, None, 2, "x")])
    got = {r.call_id: (r.status, r.valid, r.error) for r in rows}
    assert got == {"a": ("linked", False, "no schema"), None: ("no_id", None, None)}


def test_topological_order(spark):
    rng = random.Random(3)
    calls = []
    for conv in range(6):
        ids = [f"c{k}" for k in range(12)]
        rank = rng.sample(range(12), 12)
        for k in range(12):
            deps = [ids[j] for j in range(12) if rank[j] < rank[k] and rng.random() < 0.3]
            calls.append((conv, ids[k], k, "respond", "{}", deps + ["unknown"]))
    rows = run(spark, calls, [])
    at = {(r.conv, r.call_id): r.position for r in rows}
    assert all(at[c[0], d] < at[c[0], c[1]] for c in calls for d in c[5] if d != "unknown")
    assert sorted(at.values()) == sorted(list(range(12)) * 6)


def test_cycles_come_last(spark):
    calls = [(1, "a", 0, "respond", "{}", ["b"]), (1, "b", 1, "respond", "{}", ["a"]),
             (1, "c", 2, "respond", "{}", []), (1, "d", 3, "respond", "{}", ["b"])]
    rows = run(spark, calls, [])
    assert [(r.call_id, r.status) for r in rows] == [("c", "no_result"), ("a", "cycle"), ("b", "cycle"), ("d", "cycle")]


def test_hot_conversation_and_no_rows(spark):
    ok = json.dumps({"turn": 2, "prompt": "é"}, ensure_ascii=False)
    calls = [(7, f"h{k:04}", k, "respond", ok, [f"h{k - 1:04}"]) for k in range(3000)]
    rows = run(spark, calls, [])
    assert [r.turn for r in rows] == list(range(3000)) and all(r.valid for r in rows)
    assert run(spark, [], []) == []


def test_every_message_has_a_row(spark):
    rows = [(1, 0, "system", "s"), (1, 1, "user", "u"), (1, 2, "assistant", "a"), (1, 2, "assistant", "b"),
            (1, 3, None, "x"), (1, 4, "tool", None), (2, 1, "user", "p"), (2, 1, "user", "q"),
            (2, 2, "assistant", "r"), (2, None, "assistant", "n"), (2, None, "assistant", "m"),
            (3, 5, "assistant", "l"), (3, 5, "assistant", "k")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = sorted(chat.format_messages(df).collect(), key=lambda r: (r.conv_id, r.position))
    assert sorted(((r.conv_id, r.turn, r.status) for r in got), key=str) == sorted([
        (1, 0, "message"), (1, 1, "linked"), (1, 2, "further_result"), (1, 3, "message"), (1, 4, "message"),
        (2, None, "no_id"), (2, None, "no_id"), (2, 1, "repeated_call"), (2, 1, "repeated_call"),
        (2, 2, "further_result"), (3, 5, "no_call"), (3, 5, "further_result")], key=str)
    assert [r.turn for r in got if r.conv_id == 1] == [0, 1, 2, 3, 4]
    values = [json.loads(r.json) for r in got]
    assert values[0] == {"content": "s", "role": "system"} and values[3] == {"content": "x", "role": None}
    shown = [v[k] for v in values for k in ("result", "content") if v.get(k)]
    shown += [v["arguments"]["prompt"] for v in values if "arguments" in v]
    assert sorted(shown) == sorted(t for *_, t in rows if t)


@pytest.mark.parametrize("value,schema,wrong", [
    (1, {"type": "integer"}, None), (True, {"type": "integer"}, "$: not of type integer"),
    ({"a": [1, "x"]}, {"type": "object", "properties": {"a": {"type": "array", "items": {"type": "number"}}}},
     "$.a[1]: not of type number"),
    ({"b": 1}, {"type": "object", "additionalProperties": False}, "$.b: not permitted"),
    ({}, {"type": "object", "required": ["k"]}, "$.k: missing"), ("x", {"enum": ["y"]}, "$: not a permitted value"),
    (5, {"minimum": 6}, "$: out of range"), ("", {"minLength": 1}, "$: too short"), (None, {"type": "null"}, None)])
def test_validation(value, schema, wrong):
    assert chat.violation(value, schema) == wrong


def test_canonical_json():
    assert chat.canonical({"b": [1, {"z": None, "a": "é\n"}], "a": 1.5}) == '{"a":1.5,"b":[1,{"a":"é\\n","z":null}]}'
