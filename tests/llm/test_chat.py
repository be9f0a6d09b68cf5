import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from littoral.llm import chat

TOOLS = '<tools>[{"name": "add", "parameters": {"type": "object", "properties": {"a": {"type": "integer"}, "b": {}}, "required": ["a"], "additionalProperties": false}}]</tools>'


def call(ident, name="add", **arguments):
    return "<tool_call>" + json.dumps({"id": ident, "name": name, "arguments": arguments}) + "</tool_call>"


def result(ident, content):
    return json.dumps({"tool_call_id": ident, "content": content})


def table(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, seq string")


def rows():
    return [
        (1, 0, "system", TOOLS),
        (1, 1, "user", 'é "quoted"\n'),
        (1, 2, "assistant", "let me " + call("b", a={"$ref": "a"}) + call("a", a=2.0)),
        (1, 3, "tool", result("b", {"z": 1, "y": [1.50]})),
        (1, 4, "tool", result("a", None)),
        (1, 5, "assistant", call("c", a="no") + call("d", name="mul") + call("a", a=1)),
        (1, 6, "tool", result("zz", 1)),
        (2, 0, "assistant", call("p", a={"$ref": "q"}) + call("q", a={"$ref": "p"}) + "<tool_call>oops</tool_call>"),
        (2, 0, "assistant", call("e", a=1)),
        (3, None, None, None),
        (None, 1, "user", ""),
        (3, 1, "user", "same"),
        (3, 1, "user", "same"),
        (4, 1, "user", "w " * 50_000),
    ]


def test_links(spark):
    got = chat.link(table(spark, rows())).collect()
    by = {(r.conv_id, r.kind, r.call_id, r.turn): r for r in got if r.call_id}
    assert by[1, "call", "a", 2].status == "ok" and by[1, "call", "b", 2].status == "ok"
    assert by[1, "call", "a", 5].status == "duplicate"
    assert by[1, "call", "c", 5].status == "invalid"
    assert by[1, "call", "d", 5].status == "unknown tool"
    assert by[1, "result", "zz", 6].status == "orphan"
    assert by[2, "call", "p", 0].status == by[2, "call", "q", 0].status == "cycle"
    assert by[2, "call", "e", 0].status == "unanswered"
    ordered = sorted((r for r in got if r.conv_id == 1 and r.call_id in ("a", "b") and r.status == "ok"), key=lambda r: (r.at_turn, r.at_depth, r.turn, r.row, r.seq))
    assert [(r.kind, r.call_id) for r in ordered] == [("call", "a"), ("result", "a"), ("call", "b"), ("result", "b")]
    assert by[1, "call", "a", 2].json == '{"arguments":{"a":2},"id":"a","name":"add"}'
    assert by[1, "result", "b", 3].json == '{"content":{"y":[1.5],"z":1},"tool_call_id":"b"}'
    assert [r.status for r in got if r.conv_id == 2 and r.kind == "message"] == ["malformed"]
    assert sum(r.conv_id == 3 for r in got) == 3 and sum(r.conv_id is None for r in got) == 1
    for r in got:
        assert r.json == chat.canonical(json.loads(r.json))


def test_no_tools_and_empty(spark):
    got = chat.link(table(spark, [(7, 0, "user", "hi"), (7, 1, "assistant", "ho")])).collect()
    assert sorted(r.json for r in got) == ['{"content":"hi","role":"user"}', '{"content":"ho","role":"assistant"}']
    assert chat.link(table(spark, [])).collect() == []


@settings(max_examples=200, deadline=None)
@given(st.recursive(st.none() | st.booleans() | st.integers(-(2**50), 2**50) | st.floats(allow_nan=False, allow_infinity=False) | st.text(), lambda x: st.lists(x) | st.dictionaries(st.text(), x)))
def test_canonical_is_stable(value):
    text = chat.canonical(value)
    assert chat.canonical(json.loads(text)) == text and json.loads(text) == value


def test_schema():
    s = {"type": "object", "properties": {"k": {"enum": [1, "x"]}, "l": {"type": "array", "items": {"type": "number", "minimum": 0}, "maxItems": 2}}, "required": ["k"]}
    assert chat.valid({"k": 1, "l": [0, 1.5]}, s) and chat.valid({"k": "x", "m": None}, s)
    assert not chat.valid({}, s) and not chat.valid({"k": 2}, s) and not chat.valid({"k": 1, "l": [-1]}, s) and not chat.valid({"k": 1, "l": [1, 2, 3]}, s) and not chat.valid([], s)
    assert chat.valid({"k": {"$ref": "a"}}, s)


STRING_OR_NULL = {"anyOf": [{"type": "string"}, {"type": "null"}]}
KEYWORDS = [
    (STRING_OR_NULL, ["x", None], [5, []]),
    ({"oneOf": [{"type": "integer"}, {"minimum": 2}]}, [1, 2.5], [3, 1.5]),
    ({"allOf": [{"minimum": 1}, {"maximum": 2}]}, [1, 2], [0, 3]),
    ({"not": {"type": "string"}}, [1], ["x"]),
    ({"$ref": "#/$defs/X", "$defs": {"X": {"type": "string"}}}, ["x"], [5]),
    ({"$ref": "#/definitions/a~1b%25", "definitions": {"a/b%": {"const": 1}}}, [1, 1.0], [True]),
    ({"$ref": "#x", "$defs": {"y": {"$anchor": "x", "type": "null"}}}, [None], [0]),
    ({"type": "object", "properties": {"next": {"$ref": "#"}}, "additionalProperties": False}, [{"next": {"next": {}}}], [{"next": {"last": 1}}]),
    ({"exclusiveMinimum": 0, "exclusiveMaximum": 1}, [0.5, "x"], [0, 1]),
    ({"minimum": 0, "exclusiveMinimum": True}, [1], [0]),
    ({"multipleOf": 0.1}, [0.3, 1, 10**400], [0.35]),
    ({"uniqueItems": True}, [[1, True, "1"]], [[1, 1.0], [{"a": 1, "b": 2}, {"b": 2, "a": 1}]]),
    ({"prefixItems": [{"type": "string"}], "items": False}, [["x"], []], [[1], ["x", 1]]),
    ({"items": [{"type": "string"}], "additionalItems": False}, [["x"]], [["x", 1]]),
    ({"contains": {"type": "string"}, "maxContains": 1}, [["x", 1]], [[], ["x", "y"]]),
    ({"patternProperties": {"^n": {"type": "integer"}}, "additionalProperties": False}, [{"n1": 1}], [{"n1": "x"}, {"m": 1}]),
    ({"minProperties": 1, "maxProperties": 1}, [{"a": 1}], [{}, {"a": 1, "b": 1}]),
    ({"propertyNames": {"maxLength": 1}}, [{"a": 1}], [{"ab": 1}]),
    ({"dependentRequired": {"a": ["b"]}}, [{"b": 1}, {"a": 1, "b": 1}], [{"a": 1}]),
    ({"dependencies": {"a": ["b"], "c": {"required": ["d"]}}}, [{"a": 1, "b": 1}], [{"a": 1}, {"c": 1}]),
    ({"if": {"type": "string"}, "then": {"minLength": 2}, "else": {"minimum": 2}}, ["xx", 2], ["x", 1]),
    ({"pattern": "^[a-z\\d]+$"}, ["a1", 5], ["a1\n", "\u0661"]),
]


@pytest.mark.parametrize("schema,good,bad", KEYWORDS)
def test_keywords(schema, good, bad):
    assert all(chat.valid(v, schema) for v in good)
    assert not any(chat.valid(v, schema) for v in bad)


def test_references_to_results_fit_where_some_value_does():
    ref = {"$ref": "a"}
    for schema in (STRING_OR_NULL, {"oneOf": [{"type": "string"}, {"type": "integer"}]}, {"not": {"type": "string"}}, {"enum": [1]}):
        assert chat.valid(ref, schema) and chat.valid([ref], {"items": schema})
    assert not chat.valid({"k": ref, "l": 1}, {"properties": {"k": True}, "additionalProperties": False})
    assert not chat.valid({"k": ref}, {"properties": {"k": False}})


BROKEN = [{"properties": {"a": {"pattern": "^\\p{L}+$"}}}, {"required": 3}, {"required": "a"}, {"$ref": "https://example.org/x"}, {"$ref": "#/$defs/none"}, {"$ref": "#"}, {"type": "any"}, {"properties": {"a": {"minLength": "1"}}}, {"allOf": 1}, {"unevaluatedProperties": False}, None]


def test_schemas_that_cannot_be_evaluated(spark):
    schemas = [{"properties": {"a": STRING_OR_NULL}}, {"properties": {"a": {"$ref": "#/$defs/X"}}, "$defs": {"X": {"type": "null"}}}, *BROKEN]
    tools = "<tools>" + json.dumps([{"name": f"t{i}", "parameters": s} for i, s in enumerate(schemas)]) + "</tools>"
    chats = [(1, 0, "system", tools), (1, 1, "assistant", "".join(call(f"c{i}", f"t{i}", a="x" if i > 1 else 5) for i in range(len(schemas))))]
    got = {r.call_id: r.status for r in chat.link(table(spark, chats)).collect() if r.kind == "call"}
    assert got == {f"c{i}": "invalid" if i < 2 else "unchecked" for i in range(len(schemas))}


def test_dangling_references(spark):
    chats = [
        (1, 0, "assistant", call("a", x={"$ref": "gone"}) + call("b", x=[{"$ref": "a"}, {"$ref": "also gone"}, {"$ref": "gone"}]) + call("c", x={"$ref": "b"}) + call("d", x={"$ref": "late"}) + call("e", x={"$ref": "other"})),
        (1, 1, "tool", result("a", 1)),
        (1, 2, "tool", result("b", 1)),
        (1, 3, "tool", result("c", 1)),
        (1, 4, "tool", result("late", 1)),
        (1, 5, "tool", result("d", 1)),
        (2, 0, "assistant", call("other", x=1)),
    ]
    got = chat.link(table(spark, chats)).collect()
    assert {r.call_id: r.status for r in got if r.kind == "call"} == {"a": "dangling", "b": "dangling", "c": "ok", "d": "ok", "e": "dangling", "other": "unanswered"}
    assert len(got) == 11 and {r.call_id: r.status for r in got if r.kind == "result"} == {"a": "ok", "b": "ok", "c": "ok", "d": "ok", "late": "orphan"}
    # Without any edge the call says so all the same.
    assert chat.link(table(spark, [(3, 0, "assistant", call("a", x={"$ref": "gone"}))])).first().status == "dangling"


def test_generated_conversations_match_brute_force(spark):
    """The check tables hold no tool calls: chains, random dependencies, and one conversation with most of the rows."""
    import random

    rng = random.Random(11)
    chats, want = [], {}
    for conv, n, near in [(1, 40, 1), (2, 400, 3), *((k, rng.randrange(1, 9), 2) for k in range(3, 40))]:
        depth = []
        for i in range(n):
            refs = [i - 1] if near == 1 and i else sorted(rng.sample(range(i), min(i, rng.randrange(near)))) if i else []
            depth.append(1 + max((depth[r] for r in refs), default=-1))
            arguments = {"a": i, "b": [{"$ref": f"c{r}"} for r in refs]} if refs else {"a": i}
            bad = rng.random() < 0.1
            answered = rng.random() < 0.9
            # Calls may stand before what they depend on.
            chats.append((conv, 2 * rng.randrange(1000) + 1, "assistant", call(f"c{i}", a="no" if bad else i, **{k: v for k, v in arguments.items() if k != "a"})))
            if answered:
                chats.append((conv, 5000 + i, "tool", result(f"c{i}", i)))
            want[conv, f"c{i}"] = ("invalid" if bad else "ok" if answered else "unanswered", depth[i])
        chats.append((conv, 0, "system", TOOLS))
    got = {(r.conv_id, r.call_id): (r.status, r.at_depth) for r in chat.link(table(spark, chats)).collect() if r.kind == "call"}
    assert {k: s for k, (s, _) in got.items()} == {k: s for k, (s, _) in want.items()}
    # Within a turn a call comes behind what it depends on.
    assert all(got[k][1] is None or got[k][1] >= 0 for k in got)


def test_odd_numbers_and_characters(spark):
    big = "9" * 400
    tools = '<tools>[{"name": "add", "parameters": {"properties": {"a": {"type": "integer", "multipleOf": 7, "maximum": 1e308}}}}, {"name": "\\ud800", "parameters": {}}]</tools>'
    chats = [
        (1, 0, "system", tools),
        (1, 1, "assistant", '<tool_call>{"id": "a", "name": "add", "arguments": {"a": %s}}</tool_call>' % big),
        (1, 2, "assistant", '<tool_call>{"id": "b", "name": "\\ud800", "arguments": {"x": "\\udfff"}}</tool_call>'),
        (1, 3, "assistant", '<tool_call>{"id": "c", "name": "add", "arguments": {"a": 1e999}}</tool_call>'),
        (1, 4, "tool", '{"tool_call_id": "a", "content": NaN}'),
        (1, 5, "assistant", "<tool_call>" + "[" * 5000 + "</tool_call>"),
    ]
    assert chat.link(table(spark, chats)).count() >= len(chats) - 1
