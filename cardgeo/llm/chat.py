"""Chat formatting with tool-call linking.

Messages may hold tool calls and results in their text:

    <tools>[{"name": ..., "parameters": {JSON schema}}, ...]</tools>
    <tool_call>{"id": ..., "name": ..., "arguments": {...}}</tool_call>
    <tool_result>{"id": ..., "content": ...}</tool_result>

1. Each message is parsed into its plain text and its events.
2. Results are joined with calls, and calls with the schemas that their
   conversation declares, by hash joins on (conversation, identifier). A
   repeated identifier means the first call of it, so a join never multiplies.
3. Order is topological: a result follows its call, and a call that refers to
   another's result (``{"$result": id}`` in its arguments) follows that one.
   Levels are relaxed round by round until nothing changes; calls on a cycle
   keep level -1 and are invalid.
4. Arguments are checked against their schemas, and every message is
   serialised as canonical JSON: keys sorted, no spaces, UTF-8.

One row per message, no conversation is gathered in one place: the order is a
key (``order_turn``, ``order_level``, ``turn``) that sorts a conversation.

Defined results: null text or role is empty; null conversations or turns are
kept, but their events link with nothing; repeated rows are formatted like any
other; extra columns are ignored. An event is broken, and counts as invalid, if
its JSON is malformed, holds numbers or characters that JSON or UTF-8 cannot
(NaN, infinities, lone surrogates) or is nested deeper than ``DEPTH``. A call
whose schema is malformed (a bound that is no number, an enum that is no list)
is invalid. An event tag without its end is text.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize

_OPEN = re.compile("<(tools|tool_call|tool_result)>")
#: Levels of nested JSON that an event may have.
DEPTH = 100
#: JSON schema's names of types.
TYPES = {"object": dict, "array": list, "string": str, "number": (int, float), "integer": int, "boolean": bool,
         "null": type(None)}


def canonical(value) -> str:
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False)


def _refuse(name: str):
    raise ValueError(f"{name} is not JSON")


def load(text: str):
    """A JSON value that can be written again; else ``ValueError``."""
    try:
        value = json.loads(text, parse_constant=_refuse)
    except RecursionError:
        raise ValueError("nested too deeply") from None
    open_ = [(value, 1)]
    while open_:
        v, depth = open_.pop()
        if depth > DEPTH:
            raise ValueError("nested too deeply")
        if isinstance(v, (dict, list)):
            open_ += [(x, depth + 1) for x in (v.values() if isinstance(v, dict) else v)]
    canonical(value).encode()  # infinities, lone surrogates
    return value


def fits(value, schema) -> bool:
    """Whether a value satisfies a schema (types, enum, bounds, required and
    further properties, items); nothing satisfies a malformed one."""
    try:
        return _fits(value, schema)
    except (TypeError, AttributeError, ValueError):
        return False


def _fits(value, schema) -> bool:
    if not isinstance(schema, dict):
        return schema is not False
    kind = schema.get("type")
    if kind is not None:
        kinds = kind if isinstance(kind, list) else [kind]
        ok = any(isinstance(value, TYPES.get(k, object)) and (k == "boolean" or not isinstance(value, bool)
                                                              or k not in ("number", "integer")) for k in kinds)
        if not ok:
            return False
    if "enum" in schema and not any(value == x for x in list(schema["enum"])):
        return False
    if isinstance(value, (int, float)) and not isinstance(value, bool):
        if value < schema.get("minimum", value) or value > schema.get("maximum", value):
            return False
    if isinstance(value, dict):
        properties = schema.get("properties", {})
        if any(k not in value for k in schema.get("required", [])):
            return False
        more = schema.get("additionalProperties", True)
        return all([_fits(v, properties.get(k, more)) for k, v in value.items()])
    if isinstance(value, list):
        return all([_fits(v, schema.get("items", True)) for v in value])
    return True


def references(value) -> list[str]:
    """Identifiers of the results that arguments refer to."""
    if isinstance(value, dict):
        own = [str(value["$result"])] if "$result" in value else []
        return own + [r for v in value.values() for r in references(v)]
    return [r for v in value for r in references(v)] if isinstance(value, list) else []


def _pieces(text: str) -> Iterator[tuple[str | None, str]]:
    """A text in parts: (None, plain) and (tag, body). One look per tag: an end
    that is not found is not looked for again."""
    at, plain, missing = 0, 0, set()
    while m := _OPEN.search(text, at):
        at = m.end()
        close = -1 if m[1] in missing else text.find(f"</{m[1]}>", at)
        if close < 0:
            missing.add(m[1])
            continue
        yield None, text[plain:m.start()]
        yield m[1], text[at:close]
        at = plain = close + len(m[1]) + 3
    yield None, text[plain:]


def _events(tag: str, body: str) -> list[dict]:
    value = load(body)
    if tag == "tools":
        return [{"kind": "tool", "id": str(t["name"]), "body": canonical(t.get("parameters", {}))} for t in value]
    if tag == "tool_call":
        args = value.get("arguments", {})
        return [{"kind": "call", "id": str(value["id"]), "name": str(value["name"]), "body": canonical(args),
                 "needs": sorted(set(references(args)))}]
    return [{"kind": "result", "id": str(value["id"]), "body": canonical(value.get("content"))}]


def parse(text: str) -> tuple[str, list[dict]]:
    """A message's plain text and its events."""
    plain, events = [], []
    for tag, part in _pieces(text):
        if tag is None:
            plain.append(part)
            continue
        try:
            events += _events(tag, part)
        except (ValueError, KeyError, TypeError, AttributeError):
            events.append({"kind": "broken", "id": None, "body": part})
    return ("".join(plain).strip() if len(plain) > 1 else text), events


EVENTS = "array<struct<kind:string,id:string,name:string,body:string,needs:array<string>>>"
#: Ids and turns pass through pandas as text: a null beside them would make
#: them floats.
PARSED = f"row long, conv_id string, turn string, role string, content string, events {EVENTS}"


def _parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        both = [parse(t) if isinstance(t, str) else ("", []) for t in pdf["text"]]
        out = pdf[["row", "conv_id", "turn", "role"]]
        blank = {"name": None, "needs": []}
        yield out.assign(content=[c for c, _ in both], events=[[blank | e for e in ev] for _, ev in both])


def call_levels(calls: DataFrame) -> DataFrame:
    """``conv_id, id, level``: 0 without needs, else one more than the highest
    needed call; -1 on or behind a cycle, or where a needed call is missing."""
    needs = calls.select("conv_id", "id", F.explode("needs").alias("need"))
    done = materialize(calls.where(F.size("needs") == 0).select("conv_id", "id", F.lit(0).alias("level")), "op7-levels")
    total = done.count()
    while True:
        met = (needs.join(done.select("conv_id", F.col("id").alias("need"), "level"), ["conv_id", "need"], "left")
               .groupBy("conv_id", "id").agg(F.max("level").alias("top"),
                                             F.sum(F.when(F.col("level").isNull(), 1).otherwise(0)).alias("open")))
        ready = met.where("open = 0").select("conv_id", "id", (F.col("top") + 1).alias("level"))
        now = materialize(calls.where(F.size("needs") == 0).select("conv_id", "id", F.lit(0).alias("level"))
                          .unionByName(ready), "op7-levels")
        n = now.count()
        if n == total:
            break
        done, total = now, n
    return calls.select("conv_id", "id").join(now, ["conv_id", "id"], "left").withColumn(
        "level", F.coalesce("level", F.lit(-1)))


def _check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        ok = [s is None or pd.isna(s) or fits(json.loads(b), json.loads(s)) for b, s in zip(pdf["body"], pdf["schema"])]
        yield pdf[["conv_id", "id"]].assign(valid=ok)


def _serialise(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        out = []
        for role, content, turn, events in zip(pdf["role"], pdf["content"], pdf["turn"], pdf["events"]):
            message = {"role": "" if pd.isna(role) else role, "content": content,
                       "turn": None if pd.isna(turn) else int(turn)}
            calls = [{"id": e["id"], "name": e["name"], "arguments": json.loads(e["body"])} for e in events if e["kind"] == "call"]
            results = [{"id": e["id"], "content": json.loads(e["body"])} for e in events if e["kind"] == "result"]
            message |= ({"tool_calls": calls} if calls else {}) | ({"tool_results": results} if results else {})
            out.append(canonical(message))
        yield pdf.drop(columns=["content", "events"]).assign(json=out)


def format_chat(messages: DataFrame) -> DataFrame:
    """One row per message of ``messages`` (conv_id, turn, role, text):
    ``conv_id, turn, role, n_calls, n_results, n_linked, n_invalid,
    order_turn, order_level, json``."""
    text = lambda c: F.col(c).cast("long").cast("string").alias(c)
    docs = messages.select(F.monotonically_increasing_id().alias("row"), text("conv_id"), text("turn"),
                           F.col("role").cast("string").alias("role"), "text")
    whole = {c: F.col(c).cast("long") for c in ("conv_id", "turn")}
    parsed = materialize(docs.mapInPandas(_parse, PARSED).withColumns(whole), "op7-parsed")
    events = parsed.where(F.size("events") > 0).select("row", "conv_id", "turn", F.posexplode("events").alias("pos", "e"))
    events = materialize(events.select("row", "conv_id", "turn", "pos", "e.*"), "op7-events")
    out = parsed.withColumnsRenamed({"row": "__row"})
    if events.isEmpty():
        zero = F.lit(0).cast("long")
        linked = out.select("*", *(zero.alias(c) for c in ("n_calls", "n_results", "n_linked", "n_invalid")),
                            F.col("turn").alias("order_turn"), F.lit(0).alias("order_level"))
    else:
        first = F.min(F.struct("turn", "pos", "row", "name", "body", "needs")).alias("f")
        calls = (events.where("kind = 'call' and conv_id is not null").groupBy("conv_id", "id").agg(first)
                 .select("conv_id", "id", "f.*"))
        calls = materialize(calls, "op7-calls")
        schema = (events.where("kind = 'tool' and conv_id is not null").groupBy("conv_id", F.col("id").alias("name"))
                  .agg(F.min(F.struct("turn", "pos", "body")).alias("s")).select("conv_id", "name", F.col("s.body").alias("schema")))
        checked = (calls.join(schema, ["conv_id", "name"], "left").select("conv_id", "id", "body", "schema")
                   .mapInPandas(_check, "conv_id long, id string, valid boolean"))
        known = (calls.select("conv_id", "id", F.col("turn").alias("call_turn"))
                 .join(checked, ["conv_id", "id"]).join(call_levels(calls), ["conv_id", "id"]))
        known = materialize(known, "op7-known")
        joined = events.join(known, ["conv_id", "id"], "left")
        is_ = lambda k: F.col("kind") == k
        bad = is_("broken") | (is_("call") & ~F.coalesce(F.col("valid") & (F.col("level") >= 0), F.lit(False))) | (
            is_("result") & F.col("valid").isNull())
        count = lambda c: F.sum(F.when(c, 1).otherwise(0))
        per_row = joined.groupBy("row").agg(
            count(is_("call")).alias("n_calls"), count(is_("result")).alias("n_results"),
            count(is_("result") & F.col("valid").isNotNull()).alias("n_linked"), count(bad).alias("n_invalid"),
            F.max(F.when(is_("result"), F.greatest("call_turn", "turn"))).alias("after"),
            F.max(F.when(is_("call") | is_("result"), 2 * F.col("level") + is_("result").cast("int"))).alias("level"))
        n = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
        linked = (out.join(per_row, out["__row"] == per_row["row"], "left")
                  .select(*parsed.drop("row").columns, n("n_calls"), n("n_results"), n("n_linked"), n("n_invalid"),
                          F.coalesce("after", "turn").alias("order_turn"),
                          F.coalesce(F.col("level"), F.lit(0)).cast("int").alias("order_level")))
    columns = ["conv_id", "turn", "role", "n_calls", "n_results", "n_linked", "n_invalid", "order_turn", "order_level"]
    kinds = ("conv_id string, turn string, role string, n_calls long, n_results long, n_linked long, n_invalid long, "
             "order_turn string, order_level int, json string")
    named = linked.select(*(F.col(c).cast("string").alias(c) if c in ("conv_id", "turn", "order_turn") else c
                            for c in columns), "content", "events")
    return named.mapInPandas(_serialise, kinds).withColumns(whole | {"order_turn": F.col("order_turn").cast("long")})
