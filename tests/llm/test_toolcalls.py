"""Tool calls: linking, order, validation and canonical form against a plain Python reading."""

import json

import pytest

pytest.importorskip("corpuswright.llm")
from corpuswright.llm import toolcalls as T  # noqa: E402

SCHEMA = "conv_id long, turn long, role string, text string, status string"


def call(ident, name="search", **arguments):
    return f"<tool_call>{json.dumps({'id': ident, 'name': name, 'arguments': arguments})}</tool_call>"


def result(ident, text):
    return f'<tool_result id="{ident}">{text}</tool_result>'


def rows_of(spark, rows):
    found = T.link_tool_calls(spark.createDataFrame([(*r, None) for r in rows], SCHEMA), T.TOOLS).collect()
    return {(r.kind, r.conv_id, r.turn, r.place): r for r in found}, found


def test_links_order_and_validation(spark):
    text = "hi " + call("b", "fetch", source={"$ref": "a"}) + call("a", query="é", limit=3) + call("x", query=1, limit=99, more=2)
    got, found = rows_of(spark, [
        (1, 0, "assistant", text),
        (1, 1, "tool", result("a", 'say "yes"\n') + result("zz", "?") + result("a", "again")),
        (1, 2, "assistant", call("a", query="q", limit=1) + call("c", "fetch", source={"$ref": "later"}) + "<tool_call>{oops</tool_call>"),
        (1, 3, "assistant", call("later", "nobody")),
        (2, 0, "tool", result("a", "other conversation")),
        (None, None, None, None),
    ])
    assert [got["call", 1, 0, i].id for i in range(3)] == ["a", "b", "x"]
    a = got["call", 1, 0, 0]
    assert a.status == "linked" and a.errors == "" and a.record == '{"arguments":{"limit":3,"query":"é"},"id":"a","name":"search","result":"say \\"yes\\"\\n"}'
    assert got["call", 1, 0, 1].status == "unanswered" and got["call", 1, 0, 1].errors == ""
    assert got["call", 1, 0, 2].errors == "$.more: unknown; $.limit: maximum; $.query: not string"
    assert got["call", 1, 2, 0].status == "duplicate" and json.loads(got["call", 1, 2, 0].record)["result"] is None
    assert got["call", 1, 2, 1].errors == "unresolved references: 1"
    assert (got["call", 1, 2, 2].status, got["call", 1, 2, 2].errors) == ("no_id", "unreadable")
    assert got["call", 1, 3, 0].errors == "unknown tool"
    assert [got["result", 1, 1, i].status for i in range(3)] == ["linked", "orphan", "extra"]
    assert got["result", 2, 0, 0].status == "orphan"
    assert got["message", 1, 0, 0].record == '{"content":"hi","role":"assistant"}'
    assert got["message", None, None, 0].record == '{"content":"","role":null}'
    assert len(found) == 6 + 7 + 4


def test_odd_json_gives_error_rows(spark):
    long_int, deep = "9" * 400, "[" * 100_000 + "]" * 100_000
    arguments = [
        f'{{"query":"q","limit":{long_int}}}', '{"query":"\\ud800","limit":1}', f'{{"query":{deep},"limit":1}}', '{"query":"q","limit":NaN}',
        f'{{"query":"q","limit":{"9" * 5000}}}', '{"query":"q","limit":1.0}', '{"query":"q","limit":1.5}', '{"\\udc00":1,"query":"q","limit":1}',
    ]
    text = "".join(f'<tool_call>{{"id":"\\udfff{i}","name":"search","arguments":{a}}}</tool_call>' for i, a in enumerate(arguments))
    got, found = rows_of(spark, [(1, 0, "assistant", text), (1, 1, "tool", result("x", "y" * 300_000))])
    errors = [got["call", 1, 0, i].errors for i in range(8)]
    assert errors == ["$.limit: maximum", "", "unreadable", "unreadable", "unreadable", "", "$.limit: not integer", "$.\\udc00: unknown"]
    body = json.loads(got["call", 1, 0, 1].record)
    assert body["arguments"]["query"] == "\ud800" and body["id"] == "\\udfff1"
    assert json.loads(got["call", 1, 0, 0].record)["arguments"]["limit"] == int(long_int)
    assert len(found) == 2 + 8 + 1


def test_joins_are_hash_joins(spark):
    df = T.link_tool_calls(spark.createDataFrame([(1, 0, "assistant", call("a", query="q", limit=1), None)], SCHEMA), T.TOOLS)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "ShuffledHashJoin" in plan


def test_references_across_turns(spark):
    chain = [(1, t, "assistant", call(f"c{t}", "fetch", source={"$ref": f"c{t - 1}"})) for t in range(6)]
    same_turn = call("k2", "fetch", source={"$ref": "k1"}) + call("k1", "fetch", source={"$ref": "c3"})
    _, found = rows_of(spark, [*chain, (1, 6, "assistant", same_turn)])
    calls = sorted((r for r in found if r.kind == "call"), key=lambda r: (r.turn, r.place))
    assert [r.id for r in calls] == ["c0", "c1", "c2", "c3", "c4", "c5", "k1", "k2"]
    assert [r.errors for r in calls] == ["unresolved references: 1"] + [""] * 7


def test_topological_order():
    order, looped = T.topological(["d", "c", "b", "a", None, "p", "q", "s"], [["c"], ["b"], ["a"], [], [], ["q"], ["p"], ["s"]])
    assert order == [3, 2, 1, 0, 4, 7, 5, 6] and looped == {5, 6, 7}


def test_empty_and_repeated(spark):
    assert rows_of(spark, [])[1] == []
    _, found = rows_of(spark, [(1, 0, "assistant", call("a", query="q", limit=1))] * 3)
    assert sorted(r.status for r in found if r.kind == "call") == ["duplicate", "duplicate", "unanswered"]


def plain_reading(text):
    """Calls and results of a message by string searches alone; calls ordered by repeatedly taking the first one that is ready."""
    calls, at = [], 0
    while (a := text.find("<tool_call>", at)) >= 0:
        at = text.index("</tool_call>", a)
        calls.append(json.loads(text[a + 11 : at]))
    ordered, waiting = [], list(calls)
    ids = {c["id"] for c in calls}
    while waiting:
        done = {c["id"] for c in ordered}
        needs = [c["arguments"].get("source", {}).get("$ref") for c in waiting]
        ready = next(i for i, n in enumerate(needs) if n is None or n not in ids or n in done)
        ordered.append(waiting.pop(ready))
    results, at = [], 0
    while (a := text.find('<tool_result id="', at)) >= 0:
        b = text.index('">', a)
        at = text.index("</tool_result>", b)
        results.append((text[a + 17 : b], text[b + 2 : at]))
    return ordered, results


def plain_errors(c):
    args = c["arguments"]
    if c["name"] == "search":
        return ["$.limit: maximum"] if args["limit"] > 20 else []
    return []


def test_query_against_plain_python(spark):
    messages = T.derived_messages(spark.read.parquet("/root/testdata/sf0.001/conversations.parquet"))
    rows = sorted((r.conv_id, r.turn, r.text) for r in messages.collect())
    read = [(conv, turn, *plain_reading(text)) for conv, turn, text in rows]
    own, answers, taken = {}, {}, {}
    for conv, turn, calls, _ in read:
        for c in calls:
            own.setdefault((conv, c["id"]), turn)
    for conv, turn, _, results in read:
        for i, (ident, body) in enumerate(results):
            if (conv, ident) in own and own[conv, ident] <= turn and (conv, ident) not in answers:
                answers[conv, ident] = body
                taken[conv, ident] = (turn, i)
    want = []
    for conv, turn, calls, results in read:
        for i, c in enumerate(calls):
            ref = c["arguments"].get("source", {}).get("$ref")
            lost = ref is not None and own.get((conv, ref), turn + 1) > turn
            errors = "; ".join(plain_errors(c) + ["unresolved references: 1"] * lost)
            record = json.dumps({**c, "result": answers.get((conv, c["id"]))}, ensure_ascii=False, sort_keys=True, separators=(",", ":"))
            want.append(("call", conv, turn, i, "linked" if (conv, c["id"]) in answers else "unanswered", errors, record))
        for i, (ident, body) in enumerate(results):
            status = "orphan" if (conv, ident) not in own else "linked" if taken.get((conv, ident)) == (turn, i) else "extra"
            want.append(("result", conv, turn, i, status, "", json.dumps({"content": body, "id": ident}, ensure_ascii=False, sort_keys=True, separators=(",", ":"))))
    found = T.link_tool_calls(messages, T.TOOLS).where("kind <> 'message'").collect()
    got = [(r.kind, r.conv_id, r.turn, r.place, r.status, r.errors, r.record) for r in found]
    assert want and sorted(got, key=str) == sorted(want, key=str)
