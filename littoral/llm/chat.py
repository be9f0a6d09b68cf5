"""Tool calls in chats: linked to their results, ordered, validated, and written as canonical JSON.

Every message becomes events: its own text, and each call, result and tool
schema in it. Calls and results of a conversation are hash-joined by identifier.
The edges (call before its result, result before a call whose arguments refer
to it) are ordered topologically by settling, in each round, what depends on
settled events alone; rounds are as many as the longest chain, and events
without edges take no part. An event's place is ``at_turn, at_depth``: the
latest turn of what it depends on and the number of steps within it. Ordering by
``conv_id, at_turn, at_depth, turn, row, seq`` is a topological order; no
conversation is gathered in one task.

Formats read (all JSON):

* ``<tools>[{"name": ..., "parameters": schema}, ...]</tools>`` in a system message
  (also as ``{"type": "function", "function": {...}}``);
* ``<tool_call>{"id": ..., "name": ..., "arguments": {...}}</tool_call>`` in any message;
  ``{"$ref": id}`` within the arguments stands for the result of that call;
* a message of role ``tool`` that is ``{"tool_call_id": ..., "content": ...}``, or
  ``<tool_response>`` blocks of that form.

Status of an event: ``ok``; ``malformed`` (a block that is not such JSON: kept as
text); ``duplicate`` (the identifier was used before in the conversation: the
first by turn, row and place counts); ``dangling`` (a call whose arguments refer to an
identifier that no call or result of the conversation has); ``unanswered`` (a call without result);
``orphan`` (a result without call); ``unknown tool`` (schemas are declared, not this one); ``invalid``
(arguments break the schema); ``unchecked`` (the schema is none, or has a part that
cannot be evaluated here: see ``valid``); ``cycle`` (it depends on itself). The first that
applies is given, in the order malformed, duplicate, cycle, dangling, orphan,
unknown tool, unchecked, invalid, unanswered.

Defined results: null texts are empty messages; null roles, turns and
conversations stay null (null conversations are one conversation, null turns come
first); repeated rows stay rows; very long texts are one event each; an empty
table gives an empty result.
"""

from __future__ import annotations

import json
import math
import re
from collections.abc import Iterator
from fractions import Fraction
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .common import discard, map_batches, materialize

_BLOCK = re.compile(r"<(tools|tool_call|tool_response)>(.*?)</\1>", re.S)


def canonical(value) -> str:
    """JSON with sorted keys and no spaces; whole floats are written as integers. Raises for what JSON lacks."""

    def plain(x):
        if isinstance(x, dict):
            return {k: plain(v) for k, v in x.items()}
        if isinstance(x, list):
            return [plain(v) for v in x]
        if isinstance(x, float):
            if not math.isfinite(x):
                raise ValueError("not a JSON number")
            return int(x) if x.is_integer() and abs(x) < 2**53 else x
        return x

    return json.dumps(plain(value), sort_keys=True, ensure_ascii=False, separators=(",", ":"), allow_nan=False)


_KINDS = {
    "object": lambda v: isinstance(v, dict),
    "array": lambda v: isinstance(v, list),
    "string": lambda v: isinstance(v, str),
    "boolean": lambda v: isinstance(v, bool),
    "null": lambda v: v is None,
    "number": lambda v: isinstance(v, (int, float)) and not isinstance(v, bool),
    "integer": lambda v: not isinstance(v, bool) and (isinstance(v, int) or isinstance(v, float) and v.is_integer()),
}


class SchemaError(ValueError):
    """A schema, or a part of it, that cannot be evaluated."""


def _is_ref(value) -> bool:
    return isinstance(value, dict) and set(value) == {"$ref"}


def _all(parts: list[bool | None]) -> bool | None:
    return False if False in parts else None if None in parts else True


def _any(parts: list[bool | None]) -> bool | None:
    return True if True in parts else None if None in parts else False


def _between(parts: list[bool | None], low: float, high: float) -> bool | None:
    """Whether the number of parts that hold lies within bounds."""
    least, most = parts.count(True), len(parts) - parts.count(False)
    return False if most < low or least > high else True if low <= least and most <= high else None


_SPACE = r"\t\n\v\f\r \u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000\ufeff"
_ECMA = {"$": r"\Z", ".": r"[^\n\r\u2028\u2029]", r"\s": f"[{_SPACE}]", r"\S": f"[^{_SPACE}]", r"\/": "/"}


def _search(pattern, text: str) -> bool:
    """An ECMA pattern, as far as it can be written for Python's ``re``."""
    if not isinstance(pattern, str):
        raise SchemaError("pattern")
    out, inside = [], False
    for t in re.findall(r"\\k<\w+>|\\.|\(\?<(?![=!])|.", pattern, re.S):
        if t == r"\S" and inside or t in (r"\A", r"\Z", r"\a"):
            raise SchemaError("pattern")
        if t.startswith(r"\k<"):
            t = f"(?P={t[3:]}".replace(">", ")")
        elif t == "(?<" and not inside:
            t = "(?P<"
        elif inside:
            t = _SPACE if t == r"\s" else "/" if t == r"\/" else r"\[" if t == "[" else t
        else:
            t = _ECMA.get(t, t)
        if t == "[" and not inside:
            inside = True
        elif t == "]" and inside:
            inside = False
        out.append(t)
    try:
        return re.search("".join(out), text, re.ASCII) is not None
    except (re.error, OverflowError) as e:
        raise SchemaError("pattern") from e


def _schemas(x) -> Iterator[dict]:
    if isinstance(x, dict):
        yield x
    for v in x.values() if isinstance(x, dict) else x if isinstance(x, list) else ():
        yield from _schemas(v)


def _resolve(ref, root):
    """What a reference within the schema stands for."""
    own = root.get("$id") if isinstance(root, dict) else None
    if isinstance(ref, str) and isinstance(own, str) and ref.split("#")[0] == own.rstrip("#"):
        ref = "#" + ref.partition("#")[2]
    if not isinstance(ref, str) or not ref.startswith("#"):
        raise SchemaError("a reference to another schema")
    path = unquote(ref[1:])
    if path and not path.startswith("/"):
        found = [x for x in _schemas(root) if x.get("$anchor") == path or x.get("$id") == "#" + path]
        if len(found) != 1:
            raise SchemaError("anchor")
        return found[0]
    at = root
    for step in path.split("/")[1:]:
        step = step.replace("~1", "/").replace("~0", "~")
        try:
            at = at[int(step)] if isinstance(at, list) else at[step]
        except (KeyError, IndexError, TypeError, ValueError) as e:
            raise SchemaError("a reference to nothing") from e
    return at


def _check(value, schema, root) -> bool | None:
    """None where it depends on a result that a reference stands for."""
    if isinstance(schema, bool):
        return schema
    if not isinstance(schema, dict):
        raise SchemaError("no schema")
    if schema is not root and isinstance(schema.get("$id"), str) and not schema["$id"].startswith("#"):
        raise SchemaError("a schema within the schema")
    for k in ("unevaluatedProperties", "unevaluatedItems", "$dynamicRef", "$recursiveRef"):
        if k in schema and schema[k] not in (True, {}):
            raise SchemaError(k)

    def get(key: str, kind: str, default=None):
        found = schema.get(key, default)
        if key in schema and not _KINDS[kind](found):
            raise SchemaError(key)
        return found

    def number(key: str, default: float) -> float:
        found = get(key, "number", default)
        if found < 0 and key not in ("minimum", "maximum"):
            raise SchemaError(key)
        return found

    def names(found) -> list[str]:
        if not isinstance(found, list) or not all(isinstance(k, str) for k in found):
            raise SchemaError("names")
        return found

    def many(key: str) -> list:
        found = get(key, "array", [])
        if key in schema and not found:
            raise SchemaError(key)
        return found

    def within(size: int, low: str, high: str) -> bool:
        low, high = number(low, 0), number(high, math.inf)
        return low <= size <= high

    def sub(inner, part=value) -> bool | None:
        return _check(part, inner, root)

    out: list[bool | None] = []
    if "$ref" in schema:
        out.append(sub(_resolve(schema["$ref"], root)))
    for key, combine in (("allOf", _all), ("anyOf", _any), ("oneOf", lambda p: _between(p, 1, 1))):
        if key in schema:
            out.append(combine([sub(x) for x in many(key)]))
    if "not" in schema:
        found = sub(schema["not"])
        out.append(None if found is None else not found)
    if "if" in schema:
        found = sub(schema["if"])
        then, other = (sub(schema.get(k, True)) for k in ("then", "else"))
        out.append(then if found else other if found is False else then if then == other else None)
    if _is_ref(value):
        # What the result is cannot be known: what is said above holds for every value or not.
        plain = set(schema) & {"type", "enum", "const", "multipleOf", "minimum", "maximum", "exclusiveMinimum", "exclusiveMaximum", "minLength", "maxLength", "pattern", "items", "additionalItems", "prefixItems", "contains", "minItems", "maxItems", "uniqueItems", "properties", "patternProperties", "additionalProperties", "propertyNames", "required", "minProperties", "maxProperties", "dependentRequired", "dependentSchemas", "dependencies"}
        return _all([*out, None] if plain else out)
    if "type" in schema:
        kinds = [schema["type"]] if isinstance(schema["type"], str) else names(schema["type"])
        if not all(k in _KINDS for k in kinds):
            raise SchemaError("type")
        out.append(any(_KINDS[k](value) for k in kinds))
    for key in ("enum", "const"):
        if key in schema:
            options = get("enum", "array") if key == "enum" else [schema["const"]]
            out.append(canonical(value) in map(canonical, options) or (None if _refs(value) else False))
    if isinstance(value, dict):
        own, patterns, rest = get("properties", "object", {}), get("patternProperties", "object", {}), schema.get("additionalProperties", True)
        out += [k in value for k in names(schema.get("required", []))]
        out.append(within(len(value), "minProperties", "maxProperties"))
        for k, v in value.items():
            those = [own[k]] if k in own else []
            those += [x for p, x in patterns.items() if _search(p, k)]
            out += [sub(x, v) for x in those or [rest]]
            if "propertyNames" in schema:
                out.append(sub(schema["propertyNames"], k))
        for key in ("dependentRequired", "dependentSchemas", "dependencies"):
            for k, x in get(key, "object", {}).items():
                if k in value:
                    out += [n in value for n in names(x)] if key == "dependentRequired" or isinstance(x, list) else [sub(x)]
    elif isinstance(value, list):
        out.append(within(len(value), "minItems", "maxItems"))
        first, rest = get("prefixItems", "array", []), schema.get("items", True)
        if isinstance(rest, list):
            first, rest = rest, schema.get("additionalItems", True)
        out += [sub(first[i] if i < len(first) else rest, v) for i, v in enumerate(value)]
        if "contains" in schema:
            out.append(_between([sub(schema["contains"], v) for v in value], number("minContains", 1), number("maxContains", math.inf)))
        if get("uniqueItems", "boolean", False):
            out.append(len(set(map(canonical, value))) == len(value) and (None if _refs(value) else True))
    elif isinstance(value, str):
        out.append(within(len(value), "minLength", "maxLength"))
        if "pattern" in schema:
            out.append(_search(schema["pattern"], value))
    elif _KINDS["number"](value):
        low, high = number("minimum", -math.inf), number("maximum", math.inf)
        out.append(low <= value <= high)
        # In draft 4 the exclusive bounds are flags.
        for key, bound, beyond in (("exclusiveMinimum", low, lambda b: value > b), ("exclusiveMaximum", high, lambda b: value < b)):
            flag = schema.get(key)
            if flag is not None and flag is not False:
                out.append(beyond(bound if flag is True else get(key, "number")))
        if "multipleOf" in schema:
            if number("multipleOf", 1) == 0:
                raise SchemaError("multipleOf")
            out.append((Fraction(repr(value)) / Fraction(repr(schema["multipleOf"]))).denominator == 1)
    return _all(out)


def valid(value, schema) -> bool:
    """Against JSON Schema (the keywords of draft 2020-12 and the older forms of items and dependencies).

    A reference to a result fits wherever some value does. ``format`` and contents of
    strings are annotations and not checked. Raises SchemaError for what cannot be
    evaluated: references to other schemas, ``unevaluated...``, dynamic references,
    patterns that ``re`` does not know, and schemas that are none.
    """
    try:
        return _check(value, schema, schema) is not False
    except (TypeError, ValueError, KeyError, AttributeError, OverflowError, RecursionError) as e:
        raise SchemaError(str(e)) from e


def _refs(value) -> list[str]:
    if isinstance(value, dict):
        if set(value) == {"$ref"}:
            return [str(value["$ref"])]
        return [r for v in value.values() for r in _refs(v)]
    return [r for v in value for r in _refs(v)] if isinstance(value, list) else []


def parse(role: str | None, text: str) -> list[dict]:
    """The events of a message: the rest of its text first, then its blocks in order."""
    out: list[dict] = []

    def event(kind: str, data) -> dict:
        if kind == "tools":
            tools = [t.get("function", t) for t in data]
            return [{"kind": "schema", "name": str(t["name"]), "body": canonical(t.get("parameters", {}))} for t in tools]
        if kind == "tool_call":
            arguments = data.get("arguments", {})
            arguments = json.loads(arguments) if isinstance(arguments, str) else arguments
            if not isinstance(arguments, dict):
                raise ValueError("arguments are an object")
            return [{"kind": "call", "call_id": str(data["id"]), "name": str(data["name"]), "body": canonical(arguments), "refs": sorted(set(_refs(arguments)))}]
        ident = data["tool_call_id"] if "tool_call_id" in data else data["id"]
        return [{"kind": "result", "call_id": str(ident), "body": canonical(data.get("content"))}]

    def read(kind: str, body: str) -> list[dict] | None:
        try:
            found = event(kind, json.loads(body))
            for e in found:  # escapes can write halves of characters, which no text can hold
                "".join([e.get("call_id", ""), e.get("name", ""), e["body"], *e.get("refs", [])]).encode()
            return found
        except (ValueError, TypeError, KeyError, AttributeError, RecursionError):
            return None

    if role == "tool" and (found := read("tool_response", text)):
        return found
    rest, end, bad = [], 0, False
    for m in _BLOCK.finditer(text):
        found = read(m[1], m[2])
        if found is None:
            bad = True
            continue
        rest.append(text[end : m.start()])
        end = m.end()
        out += found
    rest.append(text[end:])
    own = "".join(rest)
    if own.strip() or not out:
        out.insert(0, {"kind": "message", "body": canonical({"content": own, "role": role}), "bad": bad})
    return out


_EVENTS = "row long, conv_id long, turn long, seq int, role string, kind string, call_id string, name string, body string, refs array<string>, bad boolean"


def events(chats: DataFrame) -> DataFrame:
    named = chats.select(F.monotonically_increasing_id().alias("row"), F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.col("role").cast("string"), F.col("text").cast("string"))

    def make():
        def each(batch):
            rows = {k: [] for k in ("row", "conv_id", "turn", "seq", "role", "kind", "call_id", "name", "body", "refs", "bad")}
            for row, conv, turn, role, text in zip(*(c.to_pylist() for c in batch.columns)):
                for seq, e in enumerate(parse(role, text or "")):
                    for k, v in {"row": row, "conv_id": conv, "turn": turn, "seq": seq, "role": role, "kind": e["kind"], "call_id": e.get("call_id"), "name": e.get("name"), "body": e["body"], "refs": e.get("refs", []), "bad": e.get("bad", False)}.items():
                        rows[k].append(v)
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), *[pa.string()] * 5, pa.list_(pa.string()), pa.bool_()]
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(rows.values(), kinds)], names=list(rows))

        return each

    return map_batches(named, make, _EVENTS)


def _same(a: str, b: str):
    return F.col(a).eqNullSafe(F.col(b))


def link(chats: DataFrame) -> DataFrame:
    """One row for each event: ``conv_id, turn, row, seq, kind, call_id, name, status, at_turn, at_depth, json``."""
    spark = chats.sparkSession
    # Null conversations and turns get values of their own for joins and order.
    every = materialize(events(chats).withColumns({"c": F.coalesce(F.col("conv_id").cast("string"), F.lit("null")), "t": F.coalesce("turn", F.lit(-(1 << 62))), "node": F.struct("row", "seq")}), "chat-events")
    place = F.struct("t", "row", "seq")
    tools = every.filter("kind in ('call', 'result')")
    firsts = materialize(tools.groupBy("c", "call_id", "kind").agg(F.min(F.struct(place.alias("place"), F.col("node"))).alias("m")).select("c", "call_id", "kind", "m.node"), "chat-firsts")
    call = firsts.filter("kind = 'call'").select("c", "call_id", F.col("node").alias("call"))
    result = firsts.filter("kind = 'result'").select("c", "call_id", F.col("node").alias("result"))
    pairs = materialize(call.join(result, ["c", "call_id"], "full"), "chat-pairs")
    calls = every.filter("kind = 'call'").join(call.select("c", F.col("call").alias("node")), ["c", "node"])
    met = materialize(calls.select("c", "node", F.explode("refs").alias("call_id")).join(pairs, ["c", "call_id"], "left").select(F.coalesce("result", "call").alias("src"), F.col("node").alias("dst")), "chat-refs")
    # A reference to an identifier that nothing has is no edge, but its call says so.
    refs = met.filter("src is not null")
    dangling = met.filter("src is null").select(F.col("dst").alias("node"), F.lit(True).alias("dangles")).distinct()
    edges = materialize(pairs.filter("call is not null and result is not null").select(F.col("call").alias("src"), F.col("result").alias("dst")).union(refs).distinct(), "chat-edges")
    order = _order(every, edges)
    schemas = every.filter("kind = 'schema'").groupBy("c", "name").agg(F.min(F.struct(place.alias("place"), F.col("body"))).alias("m")).select("c", "name", F.col("m.body").alias("schema"))
    declared = every.filter("kind = 'schema'").select("c").distinct().withColumn("has_schemas", F.lit(True))
    # Only events of tools meet the joins; messages pass by.
    linked = tools.join(firsts.select("c", "node", F.lit(True).alias("counts")), ["c", "node"], "left").join(pairs.select("c", "call_id", "call", "result"), ["c", "call_id"], "left")
    linked = linked.join(schemas, ["c", "name"], "left").join(declared, "c", "left").join(dangling, "node", "left")
    if order is not None:
        linked = linked.join(order, "node", "left")
    else:
        linked = linked.withColumns({"at": F.lit(None).cast("struct<t:bigint,d:int>"), "settled": F.lit(True)})
    checked = linked.withColumn("fits", F.when((F.col("kind") == "call") & F.col("schema").isNotNull(), _fits(F.col("body"), F.col("schema"))).otherwise("ok"))
    status = (
        F.when(F.col("counts").isNull(), "duplicate")
        .when(~F.coalesce("settled", F.lit(True)), "cycle")
        .when(F.col("dangles"), "dangling")
        .when((F.col("kind") == "result") & F.col("call").isNull(), "orphan")
        .when((F.col("kind") == "call") & F.col("has_schemas") & F.col("schema").isNull(), "unknown tool")
        .when(F.col("fits") != "ok", F.col("fits"))
        .when((F.col("kind") == "call") & F.col("result").isNull(), "unanswered")
        .otherwise("ok")
    )
    at_turn = F.when(F.col("at.t") > -(1 << 62), F.col("at.t")).otherwise(F.col("turn"))
    of_tools = checked.select("conv_id", "turn", "row", "seq", "kind", "call_id", "name", status.alias("status"), at_turn.alias("at_turn"), F.coalesce("at.d", F.lit(0)).alias("at_depth"), "body", "role")
    plain = every.filter("kind not in ('call', 'result')").select("conv_id", "turn", "row", "seq", "kind", "call_id", "name", F.when(F.col("bad"), "malformed").otherwise("ok").alias("status"), F.col("turn").alias("at_turn"), F.lit(0).alias("at_depth"), "body", "role")
    both = of_tools.unionByName(plain)
    # Keys in order; bodies are canonical JSON already.
    quoted = lambda c: F.regexp_extract(F.to_json(F.array(c)), r"(?s)^\[(.*)\]$", 1)
    text = (
        F.when(F.col("kind") == "message", F.col("body"))
        .when(F.col("kind") == "call", F.concat(F.lit('{"arguments":'), "body", F.lit(',"id":'), quoted("call_id"), F.lit(',"name":'), quoted("name"), F.lit("}")))
        .when(F.col("kind") == "result", F.concat(F.lit('{"content":'), "body", F.lit(',"tool_call_id":'), quoted("call_id"), F.lit("}")))
        .otherwise(F.concat(F.lit('{"name":'), quoted("name"), F.lit(',"parameters":'), "body", F.lit("}")))
    )
    return both.select("conv_id", "turn", "row", "seq", "kind", "call_id", "name", "status", "at_turn", "at_depth", text.alias("json"))


@F.pandas_udf(StringType())
def _fits(bodies, schemas):
    import pandas as pd

    def fits(body, schema) -> str:
        try:
            return "ok" if body is None or schema is None or valid(json.loads(body), json.loads(schema)) else "invalid"
        except SchemaError:
            return "unchecked"

    return pd.Series([fits(b, s) for b, s in zip(bodies, schemas)], dtype="object")


def _order(every: DataFrame, edges: DataFrame) -> DataFrame | None:
    """``node, at, settled`` of the events that have edges: Kahn's rounds as joins."""
    if edges.isEmpty():
        return None
    nodes = materialize(edges.select(F.col("src").alias("node")).union(edges.select("dst")).distinct().join(every.select("node", "t"), "node"), "chat-nodes")
    done = materialize(nodes.join(edges.select(F.col("dst").alias("node")).distinct(), "node", "left_anti").select("node", F.struct("t", F.lit(0).alias("d")).alias("at")), "chat-done")
    size = done.count()
    while True:
        known = done.select(F.col("node").alias("src"), "at")
        open_edges = edges.join(done.select(F.col("node").alias("dst")), "dst", "left_anti").join(known, "src", "left")
        ready = open_edges.groupBy("dst").agg(F.count("*").alias("n"), F.count("at").alias("k"), F.max(F.struct(F.col("at.t").alias("t"), (F.col("at.d") + 1).alias("d"))).alias("after")).filter("n = k")
        fresh = ready.select(F.col("dst").alias("node"), "after").join(nodes, "node").select("node", F.greatest(F.struct("t", F.lit(0).alias("d")), F.col("after")).alias("at"))
        now = materialize(done.unionByName(fresh), "chat-done")
        n = now.count()
        discard(done)
        done = now
        if n == size:
            break
        size = n
    return nodes.join(done, "node", "left").select("node", "at", F.col("at").isNotNull().alias("settled"))
