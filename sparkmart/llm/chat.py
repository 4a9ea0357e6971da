"""Tool-call linking for chat data (operator 9).

Calls and results are hash-joined by conversation and call id.  The calls of a conversation are put
in a topological order: a call comes after the calls whose results it depends on, otherwise by turn
and id.  Arguments are validated against the schema of the tool, and each call with its result is
serialised as canonical JSON (sorted keys, no spaces, characters unescaped).

Where every dependency points to an earlier turn, the order by turn is a topological one.  Only
conversations with other dependencies are peeled: in each round, the calls whose dependencies all
have a level get the next one; calls left when a round adds none are on or behind a cycle.

Cases: rows repeated in full count once; different calls with one id are all kept as
``repeated_call`` and not linked; of several results of a call the one of the first turn (then the
smallest content) is linked and ``n_results`` counts all; a result without a call is
``no_call``, a call without a result ``no_result``, a null id ``no_id``; unknown dependencies are ignored;
a cycle is ``cycle``, placed after the others.  ``format_messages`` loses no text: results that no
row shows (of a null id, of a repeated call, further ones of an id) are rows of their own, and
messages of other roles stand in their place.  Null conversations are one conversation; a null turn
comes first; null or malformed arguments are invalid, as is a tool without schema.  Further columns
are ignored; no rows give no rows.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import numbered, store

#: Schema of the tool that the plain conversations call: the assistant's reply to a prompt.
SCHEMAS = {"respond": {
    "type": "object", "required": ["prompt", "turn"], "additionalProperties": False,
    "properties": {"prompt": {"type": "string", "minLength": 1},
                   "turn": {"type": "integer", "minimum": 0}}}}

_TYPES = {"object": dict, "array": list, "string": str, "boolean": bool, "null": type(None),
          "integer": int, "number": (int, float)}


def violation(value, schema: dict, at: str = "$") -> str | None:
    """First rule of a schema that a value breaks; objects are checked in the order of their keys."""
    kind = schema.get("type")
    if kind and (not isinstance(value, _TYPES[kind])
                 or isinstance(value, bool) and kind in ("integer", "number")):
        return f"{at}: not of type {kind}"
    if "enum" in schema and value not in schema["enum"]:
        return f"{at}: not a permitted value"
    if isinstance(value, str) and len(value) < schema.get("minLength", 0):
        return f"{at}: too short"
    if isinstance(value, (int, float)) and not isinstance(value, bool):
        if value < schema.get("minimum", value) or value > schema.get("maximum", value):
            return f"{at}: out of range"
    if isinstance(value, dict):
        for key in sorted(schema.get("required", ())):
            if key not in value:
                return f"{at}.{key}: missing"
        known = schema.get("properties", {})
        for key in sorted(value):
            if key in known:
                if found := violation(value[key], known[key], f"{at}.{key}"):
                    return found
            elif not schema.get("additionalProperties", True):
                return f"{at}.{key}: not permitted"
    if isinstance(value, list) and "items" in schema:
        for k, item in enumerate(value):
            if found := violation(item, schema["items"], f"{at}[{k}]"):
                return found
    return None


def canonical(value) -> str:
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def checked(name: str | None, arguments: str | None, schemas: dict) -> tuple[object, str | None]:
    """Parsed arguments and what is wrong with them."""
    try:
        value = json.loads(arguments) if arguments is not None else None
    except ValueError:
        return arguments, "$: not JSON"
    if name not in schemas:
        return value, "no schema"
    return value, violation(value, schemas[name])


def linked(calls: DataFrame, results: DataFrame, every: bool = False) -> DataFrame:
    """Outer join of calls and results: ``conv, call_id, turn, name, arguments, depends_on, content,
    n_results, is_call, status``.

    With ``every``, each result that would be counted only is a row too: ``no_id`` with a null id, else
    ``further_result``.
    """
    results = results.select("conv", "call_id", "turn", "content").distinct()
    named = results.where("call_id is not null") if every else results
    calls = calls.select("conv", "call_id", "turn", "name", "arguments", "depends_on").distinct()
    same = calls.groupBy("conv", "call_id").agg(F.count("*").alias("n_calls"))
    first = (named.groupBy("conv", "call_id").agg(
        F.min(F.struct("turn", "content")).alias("first"), F.count("*").alias("n_results")))
    known = F.col("c.conv").eqNullSafe(F.col("s.conv")) & F.col("c.call_id").eqNullSafe(F.col("s.call_id"))
    calls = calls.alias("c").join(same.alias("s"), known).select("c.*", "s.n_calls")
    hit = F.col("c.conv").eqNullSafe(F.col("r.conv")) & (F.col("c.call_id") == F.col("r.call_id"))
    both = calls.alias("c").join(first.alias("r"), hit, "full_outer")
    is_call = F.col("c.n_calls").isNotNull()
    alone = F.col("c.n_calls") == 1
    status = (F.when(~is_call, F.when(F.col("r.call_id").isNull(), "no_id").otherwise("no_call"))
              .when(F.col("c.call_id").isNull(), "no_id").when(~alone, "repeated_call")
              .when(F.col("r.n_results").isNull(), "no_result").otherwise("linked"))
    takes = ~is_call | alone
    rows = both.select(
        F.when(is_call, F.col("c.conv")).otherwise(F.col("r.conv")).alias("conv"),
        F.coalesce("c.call_id", "r.call_id").alias("call_id"),
        F.when(is_call, F.col("c.turn")).otherwise(F.col("r.first.turn")).alias("turn"),
        "c.name", "c.arguments", "c.depends_on", F.when(takes, F.col("r.first.content")).alias("content"),
        F.coalesce("r.n_results", F.lit(0)).alias("n_results"), is_call.alias("is_call"),
        status.alias("status"), F.when(takes, F.col("r.first.turn")).alias("shown"))
    if not every:
        return rows.drop("shown")
    rows = store(rows, "chat-shown")
    # a row shows the first result of its id; the whole result is the key, so no id is a hot one
    shown = rows.where("status in ('linked', 'no_call')")
    more = results.alias("m").join(shown.alias("s"), F.expr(
        "m.conv <=> s.conv and m.call_id <=> s.call_id and m.turn <=> s.shown and m.content <=> s.content"),
        "left_anti")
    none = F.lit(None)
    return rows.drop("shown").unionByName(more.select(
        "conv", "call_id", "turn", none.cast("string").alias("name"), none.cast("string").alias("arguments"),
        none.cast("array<string>").alias("depends_on"), "content",
        F.when(F.col("call_id").isNull(), 1).otherwise(0).cast("long").alias("n_results"),
        F.lit(False).alias("is_call"),
        F.when(F.col("call_id").isNull(), "no_id").otherwise("further_result").alias("status")))


def levels(calls: DataFrame) -> DataFrame:
    """``conv, call_id, level`` of the calls whose place the turns alone don't give; -1 on a cycle."""
    ends = calls.select("conv", "call_id", "turn").where("call_id is not null").distinct()
    edges = (calls.select("conv", "call_id", "turn", F.explode("depends_on").alias("dep")).alias("a")
             .join(ends.alias("b"), F.expr("a.conv <=> b.conv and a.dep = b.call_id"))
             .select("a.conv", "a.call_id", "a.dep",
                     (F.coalesce("b.turn", F.lit(-1)) >= F.coalesce("a.turn", F.lit(-1))).alias("late")))
    edges = store(edges.distinct(), "chat-edges")
    late = edges.where("late").select("conv").distinct()
    edges = store(edges.alias("e").join(late.alias("l"), F.expr("e.conv <=> l.conv"), "left_semi")
                  .select("conv", "call_id", "dep").distinct(), "chat-late-edges")
    todo = store(ends.alias("e").join(late.alias("l"), F.expr("e.conv <=> l.conv"), "left_semi")
                 .select("conv", "call_id").distinct(), "chat-late-calls")
    done = None
    level = 0
    while not todo.isEmpty():
        waits = edges.select("conv", "call_id").distinct()
        free = store(todo.alias("t").join(
            waits.alias("w"), F.expr("t.conv <=> w.conv and t.call_id = w.call_id"), "left_anti")
            .select("conv", "call_id", F.lit(level).alias("level")), "chat-level")
        if free.isEmpty():
            free = todo.withColumn("level", F.lit(-1))
        done = free if done is None else done.union(free)
        if level < 0:
            break
        gone = F.expr("x.conv <=> f.conv and x.call_id = f.call_id")
        rest = store(todo.alias("x").join(free.alias("f"), gone, "left_anti"), "chat-rest")
        edges = store(edges.alias("x").join(
            free.alias("f"), F.expr("x.conv <=> f.conv and x.dep = f.call_id"), "left_anti"), "chat-edges")
        todo, level = rest, level + 1
    return done if done is not None else todo.withColumn("level", F.lit(0))


def format_calls(calls: DataFrame, results: DataFrame, schemas: dict = SCHEMAS, *,
                 others: DataFrame | None = None) -> DataFrame:
    """``conv, position, call_id, turn, status, n_results, valid, error, json``, a row per call or
    unmatched result; ``position`` counts from 0 in a conversation.

    ``calls`` has conv, call_id, turn, name, arguments (JSON text) and depends_on (array of ids);
    ``results`` has conv, call_id, turn and content.  With ``others`` (conv, turn, role and content of
    further messages), these are rows of the status ``message``, and every result has its row.
    """
    rows = linked(calls, results, every=others is not None)
    if others is not None:
        rows = rows.unionByName(others.distinct().select(
            "conv", "turn", F.col("role").alias("name"), "content", F.lit(0).cast("long").alias("n_results"),
            F.lit(False).alias("is_call"), F.lit("message").alias("status")), allowMissingColumns=True)
    rows = store(rows, "chat-linked")
    level = levels(rows)
    rows = (rows.alias("r").join(level.alias("l"), F.expr("r.conv <=> l.conv and r.call_id = l.call_id"),
                                 "left")
            .select("r.*", F.coalesce("l.level", F.lit(0)).alias("level"))
            .withColumn("status", F.when(F.col("level") < 0, "cycle").otherwise(F.col("status")))
            .withColumn("after", F.when(F.col("level") < 0, F.lit((1 << 31) - 1)).otherwise(F.col("level"))))
    keys = ["conv", "after", "turn", "call_id", "name", "arguments", "content"]
    # only keys are sorted; long texts are compared where all else is equal
    placed = numbered(rows, keys, "place")
    placed = store(placed, "chat-placed")
    first = placed.groupBy("conv").agg(F.min("place").alias("first"))
    placed = (placed.alias("p").join(first.alias("f"), F.expr("p.conv <=> f.conv"))
              .select("p.*", (F.col("place") - F.col("f.first")).alias("position")))

    @F.pandas_udf("valid boolean, error string, json string")
    def serialise(parts: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
        for ids, names, arguments, contents, known, states in parts:
            out = []
            for i, name, text, content, is_call, status in zip(ids, names, arguments, contents, known, states):
                value, wrong = checked(name, text, schemas) if is_call else (None, None)
                row = {"id": i, "result": content}
                if status == "message":
                    row = {"content": content, "role": name}
                if is_call:
                    row |= {"name": name, "arguments": value}
                out.append((wrong is None if is_call else None, wrong, canonical(row)))
            yield pd.DataFrame(out, columns=["valid", "error", "json"]).astype({"valid": object})

    return (placed.withColumn("s", serialise("call_id", "name", "arguments", "content", "is_call", "status"))
            .select("conv", "position", "call_id", "turn", "status", "n_results", "s.valid", "s.error",
                    "s.json"))


def calls_of(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results of plain conversations (conv_id, turn, role, text).

    Each user turn calls the tool ``respond`` with its prompt and depends on the answer to the user
    turn before it; each assistant turn is the result of the call one turn before.
    """
    rows = messages.select(F.col("conv_id").alias("conv"), "turn", "role", F.col("text").alias("content"))
    name = lambda turn: F.concat(F.lit("call-"), F.col("conv").cast("string"), F.lit("-"),
                                 turn.cast("string"))
    arguments = F.to_json(F.struct(F.col("content").alias("prompt"), "turn"), {"ignoreNullFields": "false"})
    # two turns back is the previous user turn of an alternating conversation; others are ignored
    calls = rows.where("role = 'user'").select(
        "conv", name(F.col("turn")).alias("call_id"), "turn", F.lit("respond").alias("name"),
        arguments.alias("arguments"), F.array(name(F.col("turn") - 2)).alias("depends_on"))
    results = rows.where("role = 'assistant'").select(
        "conv", name(F.col("turn") - 1).alias("call_id"), "turn", "content")
    return calls, results


def format_conversations(messages: DataFrame, schemas: dict = SCHEMAS) -> DataFrame:
    """Linked calls of plain conversations."""
    return format_calls(*calls_of(messages), schemas).withColumnRenamed("conv", "conv_id")


def format_messages(messages: DataFrame, schemas: dict = SCHEMAS) -> DataFrame:
    """Linked calls of plain conversations, and in their place all other messages and results."""
    others = messages.where("role is null or role not in ('user', 'assistant')").select(
        F.col("conv_id").alias("conv"), "turn", "role", F.col("text").alias("content"))
    return format_calls(*calls_of(messages), schemas, others=others).withColumnRenamed("conv", "conv_id")
