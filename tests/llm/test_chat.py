import json
import random
import time

from cardgeo.llm import chat

TOOLS = ('<tools>[{"name":"add","parameters":{"type":"object","required":["a"],"properties":'
         '{"a":{"type":"integer","minimum":0},"b":{"type":["string","null"],"enum":["x",null]}},'
         '"additionalProperties":false}}]</tools>')


def call(i, args, name="add"):
    return f'<tool_call>{{"id":"{i}","name":"{name}","arguments":{json.dumps(args)}}}</tool_call>'


def result(i, content):
    return f'<tool_result>{{"id":"{i}","content":{json.dumps(content)}}}</tool_result>'


def run(spark, rows):
    df = spark.createDataFrame([(*r, "clash") for r in rows],
                               "conv_id long, turn long, role string, text string, json string")
    return chat.format_chat(df).collect()


def test_schemas():
    schema = {"type": "object", "required": ["a"], "properties": {"a": {"type": "integer", "minimum": 0},
                                                                  "l": {"type": "array", "items": {"type": "string"}}}}
    assert chat.fits({"a": 1, "l": ["x"], "more": None}, schema)
    for bad in ({}, {"a": -1}, {"a": True}, {"a": 1.5}, {"a": 1, "l": [2]}, [1]):
        assert not chat.fits(bad, schema)
    assert chat.fits(3, {}) and chat.fits(3, True) and not chat.fits(3, False)


def test_linking(spark):
    rows = [
        (1, 0, "system", TOOLS),
        (1, 1, "assistant", "Adding. " + call("c2", {"a": {"$result": "c1"}}) + call("c1", {"a": 1, "b": "x"})),
        (1, 2, "tool", result("c1", {"z": 1, "a": "é"})),
        (1, 3, "tool", result("c2", None) + result("nobody", 1)),
        (1, 4, "assistant", call("c3", {"a": -1}) + "<tool_call>{broken</tool_call>"),
        (1, 5, "assistant", call("c4", {"a": 0, "b": {"$result": "c5"}}) + call("c5", {"a": {"$result": "c4"}})),
        (2, 0, "tool", result("d1", 1)),            # before its call, in another order of turns
        (2, 1, "assistant", call("d1", {"any": 1}, "unknown")),
        (2, 2, "assistant", call("d1", {"any": 2}, "unknown")),  # the identifier again
        (3, 0, "user", "no tools"), (3, 1, None, None), (None, None, "user", call("c1", {})),
    ]
    out = {(r.conv_id, r.turn): r for r in run(spark, rows)}
    assert len(out) == len(rows)
    counts = lambda *k: tuple(out[k][c] for c in ("n_calls", "n_results", "n_linked", "n_invalid"))
    assert counts(1, 1) == (2, 0, 0, 1)  # c2's argument is no integer
    assert counts(1, 2) == (0, 1, 1, 0) and counts(1, 3) == (0, 2, 1, 1)
    assert counts(1, 4) == (1, 0, 0, 2) and counts(1, 5) == (2, 0, 0, 2)  # a cycle
    assert counts(2, 0) == (0, 1, 1, 0) and out[2, 0].order_turn == 1  # follows its call
    assert counts(2, 1) == (1, 0, 0, 0) and counts(3, 0) == (0, 0, 0, 0)
    assert counts(None, None) == (1, 0, 0, 1)
    # the second call refers to the first one's result: a deeper level
    assert [out[1, t].order_level for t in (1, 2, 3)] == [2, 1, 3]
    assert out[1, 2].json == ('{"content":"","role":"tool","tool_results":[{"content":{"a":"é","z":1},"id":"c1"}],'
                              '"turn":2}')
    assert out[3, 1].json == '{"content":"","role":"","turn":1}'
    assert json.loads(out[1, 1].json)["content"] == "Adding."


def test_plain_and_empty(spark):
    rows = [(1, t, "user", f'say "{t}"\n') for t in range(3)] * 2
    out = run(spark, rows)
    assert len(out) == 6 and {r.json for r in out} == {
        '{"content":"say \\"%d\\"\\n","role":"user","turn":%d}' % (t, t) for t in range(3)}
    assert run(spark, []) == []


def test_malformed_input_is_invalid(spark):
    schema = lambda s: '<tools>[{"name":"add","parameters":%s}]</tools>' % s
    schemas = ['{"minimum":"x"}', '{"enum":5}', '{"type":"object","required":7}', '{"properties":[1]}', '{"type":{"a":1}}',
               '{"type":[["x"]]}', '{"maximum":null}']
    args = [5, 5, {"a": 1}, {"a": 1}, 5, 5, 5]
    assert not any(chat.fits(a, json.loads(s)) for a, s in zip(args, schemas))
    broken = ['<tool_call>{"id":"x","name":"add","arguments":"\\ud800"}</tool_call>',
              '<tool_call>{"id":"\\udfff","name":"add"}</tool_call>',
              '<tool_call>{"id":"x","name":"add","arguments":' + "[" * 100_000 + "]" * 100_000 + "}</tool_call>",
              '<tool_call>{"id":"x","name":"add","arguments":' + "[" * 500 + "]" * 500 + "}</tool_call>",
              '<tool_result>{"id":"x","content":NaN}</tool_result>', '<tool_result>{"id":"x","content":1e999}</tool_result>',
              '<tool_result>{"id":"x","content":-Infinity}</tool_result>', '<tools>{"name":1}</tools>', "<tools>7</tools>"]
    rows = [(i, t, "system" if t == 0 else "assistant", x)
            for i, (s, a) in enumerate(zip(schemas, args)) for t, x in ((0, schema(s)), (1, call("c", a)))]
    rows += [(100 + i, 0, "tool", "before " + x + " after") for i, x in enumerate(broken)]
    deep = '{"a":' * 90 + "1" + "}" * 90
    rows.append((200, 0, "assistant", '<tool_call>{"id":"d","name":"n","arguments":%s}</tool_call>' % deep))
    out = {(r.conv_id, r.turn): r for r in run(spark, rows)}
    assert all(out[i, 1].n_invalid == 1 and out[i, 1].n_calls == 1 for i in range(len(schemas)))
    assert all(out[100 + i, 0].n_invalid == 1 and "before" in out[100 + i, 0].json for i in range(len(broken)))
    assert out[200, 0].n_invalid == 0 and deep in out[200, 0].json
    for r in out.values():
        json.loads(r.json, parse_constant=chat._refuse)


def test_tags_without_an_end_take_linear_time():
    at = time.time()
    text = "<tools>" * 200_000 + "<tool_call>" * 200_000
    assert chat.parse(text) == (text, []) and time.time() - at < 20
    assert chat.parse("a <tools> b" + call("x", 1) + "</tools> c")[0] == "a  c"
    assert chat.parse("<tool_call><tools>[]</tools>") == ("<tool_call>", [])


def brute(rows):
    """All pairs of events of each conversation, one after another."""
    events = []  # conversation, turn, position, row, event
    for n, (conv, turn, _, text) in enumerate(rows):
        events += [(conv, turn, i, n, e) for i, e in enumerate(chat.parse(text or "")[1])]
    first, schemas = {}, {}
    for conv, turn, i, n, e in sorted(events, key=lambda x: (x[0], x[1], x[2], x[3])):
        if e["kind"] == "call":
            first.setdefault((conv, e["id"]), (turn, e))
        if e["kind"] == "tool":
            schemas.setdefault((conv, e["id"]), json.loads(e["body"]))

    def level(key, path=()):
        if key not in first or key in path:
            return -1
        below = [level((key[0], need), (*path, key)) for need in first[key][1]["needs"]]
        return -1 if -1 in below else 1 + max(below, default=-1)

    out = [[0, 0, 0, 0] for _ in rows]
    for conv, turn, i, n, e in events:
        key = (conv, e["id"])
        calls, results, linked, invalid = range(4)
        if e["kind"] == "call":
            out[n][calls] += 1
            args, name = json.loads(first[key][1]["body"]), first[key][1]["name"]
            ok = level(key) >= 0 and ((conv, name) not in schemas or chat.fits(args, schemas[conv, name]))
            out[n][invalid] += not ok
        elif e["kind"] == "result":
            out[n][results] += 1
            out[n][linked if key in first else invalid] += 1
        elif e["kind"] == "broken":
            out[n][invalid] += 1
    return out


def test_linking_against_all_pairs(spark):
    r = random.Random(4)
    rows = []
    for conv in range(30):
        rows.append((conv, 0, "system", TOOLS if r.random() < 0.7 else "none"))
        ids = [f"c{i}" for i in range(r.randint(1, 6))]
        for turn in range(1, r.randint(3, 9)):
            text = "".join(r.choice([
                call(r.choice(ids), {"a": r.choice([1, -1, {"$result": r.choice(ids)}])}, r.choice(["add", "other"])),
                call(r.choice(ids), {"b": {"$result": r.choice(ids)}, "l": [{"$result": r.choice(ids)}]}, "other"),
                result(r.choice(ids), turn), "<tool_call>{</tool_call>", "text "]) for _ in range(r.randint(1, 3)))
            rows.append((conv, turn, "assistant", text))
    got = {(x.conv_id, x.turn): [x.n_calls, x.n_results, x.n_linked, x.n_invalid] for x in run(spark, rows)}
    assert got == {(conv, turn): n for (conv, turn, _, _), n in zip(rows, brute(rows))}
