"""Tool-call linking for chat data.

Messages carry calls as ``<tool_call>{"id", "name", "arguments"}</tool_call>`` and results as ``<tool_result id="...">...
</tool_result>``. Each message is parsed once: calls are validated against the schema of their tool, their arguments become
canonical JSON (sorted keys, no blanks), and the calls of one message are put in topological order of the references
``{"$ref": "<call id>"}`` in their arguments. Calls, results and references then meet in hash joins on conversation and
identifier; nothing ever gathers a conversation. References reach back to the same or an earlier turn, so turn and
place together order all calls of a conversation topologically.

Defined results: the first call with an identifier (by turn and place) owns it, later ones are ``duplicate``; the first result
at or after its call is linked, others are ``extra``, and ``orphan`` without a call; calls without a result are
``unanswered``, without an identifier ``no_id``. References to calls that are absent or later are errors, as are cycles,
whose calls come last in their order. Null text is empty; null conversations are one conversation; repeated rows
are repeated calls; very long messages are parsed whole, one at a time; numbers of any length are compared exactly, and
a call that JSON cannot read or write (NaN, too deep, over 4300 digits) is ``unreadable``; half a surrogate pair is
written as its escape; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuswright.session import cut_lineage

CALL = re.compile(r"<tool_call>(.*?)</tool_call>", re.S)
RESULT = re.compile(r'<tool_result id="([^"]*)">(.*?)</tool_result>', re.S)
RECORD = "kind string, conv_id {conv}, turn {turn}, place int, id string, name string, body string, refs array<string>, errors array<string>"
TYPES = {"object": dict, "array": list, "string": str, "boolean": bool, "null": type(None)}


def storable(text: str) -> str:
    """``text`` with escapes for halves of surrogate pairs, which no UTF-8 holds."""
    return text.encode("utf-8", "backslashreplace").decode()


def canonical(value) -> str:
    return storable(json.dumps(value, ensure_ascii=False, sort_keys=True, separators=(",", ":"), allow_nan=False))


def _fits(value, kind: str) -> bool:
    if kind in ("integer", "number"):
        if isinstance(value, bool) or not isinstance(value, (int, float)):
            return False
        return kind == "number" or isinstance(value, int) or value.is_integer()
    return isinstance(value, TYPES[kind])


def schema_errors(value, schema: dict, at: str = "$") -> list[str]:
    """What a value breaks of a JSON schema (type, properties, required, additionalProperties, items, enum, bounds).

    A reference to another call's result fits every type.
    """
    if isinstance(value, dict) and set(value) == {"$ref"}:
        return []
    kinds = schema.get("type")
    kinds = [kinds] if isinstance(kinds, str) else kinds
    if kinds and not any(_fits(value, k) for k in kinds):
        return [f"{at}: not {'/'.join(kinds)}"]
    out = []
    if "enum" in schema and value not in schema["enum"]:
        out.append(f"{at}: not in enum")
    if isinstance(value, (int, float)) and not isinstance(value, bool):
        out += [f"{at}: {word}" for word, bad in (("minimum", value < schema.get("minimum", value)), ("maximum", value > schema.get("maximum", value))) if bad]
    if isinstance(value, dict):
        known = schema.get("properties", {})
        out += [f"{at}.{k}: missing" for k in schema.get("required", []) if k not in value]
        if schema.get("additionalProperties") is False:
            out += [f"{at}.{k}: unknown" for k in sorted(set(value) - set(known))]
        for k in sorted(set(value) & set(known)):
            out += schema_errors(value[k], known[k], f"{at}.{k}")
    if isinstance(value, list) and "items" in schema:
        for i, x in enumerate(value):
            out += schema_errors(x, schema["items"], f"{at}[{i}]")
    return out


def references(value) -> list[str]:
    """Identifiers that a value refers to, each once, in order."""
    found: dict[str, None] = {}
    stack = [value]
    while stack:
        x = stack.pop()
        if isinstance(x, dict):
            if set(x) == {"$ref"} and isinstance(x["$ref"], str):
                found[x["$ref"]] = None
            else:
                stack.extend(reversed(list(x.values())))
        elif isinstance(x, list):
            stack.extend(reversed(x))
    return list(found)


def topological(ids: list[str | None], refs: list[list[str]]) -> tuple[list[int], set[int]]:
    """Order of a message's calls in which referred calls come first, ties as written, and the calls in cycles."""
    first = {x: i for i, x in reversed(list(enumerate(ids))) if x is not None}
    needs = [{first[r] for r in rs if r in first and first[r] != i} for i, rs in enumerate(refs)]
    looped = {i for i, rs in enumerate(refs) if ids[i] is not None and ids[i] in rs and first[ids[i]] == i}
    users: list[list[int]] = [[] for _ in ids]
    for i, n in enumerate(needs):
        for j in n:
            users[j].append(i)
    import heapq

    open_count = [len(n) for n in needs]
    ready, order = [i for i, n in enumerate(open_count) if not n], []
    while ready:
        i = heapq.heappop(ready)
        order.append(i)
        for j in users[i]:
            open_count[j] -= 1
            if not open_count[j]:
                heapq.heappush(ready, j)
    rest = [i for i in range(len(ids)) if open_count[i]]
    return order + rest, looped | set(rest)


def parse_message(text: str, schemas: dict[str, dict]) -> tuple[str, list[tuple], list[tuple]]:
    """Content without tags; calls (id, name, canonical arguments, refs, errors) in order; results (id, content)."""
    calls = []
    for raw in CALL.findall(text):
        try:
            call = json.loads(raw)
            if not isinstance(call, dict):
                raise ValueError
            arguments, ident, name = call.get("arguments"), call.get("id"), call.get("name")
            if isinstance(arguments, str):
                arguments = json.loads(arguments)
            ident, name = (storable(x) if isinstance(x, str) else None for x in (ident, name))
            errors = schema_errors(arguments, schemas[name]) if name in schemas else ["unknown tool"]
            found = (ident, name, canonical(arguments), [storable(r) for r in references(arguments)], [storable(e) for e in errors])
        except (ValueError, RecursionError):
            found = (None, None, None, [], ["unreadable"])
        calls.append(found)
    order, looped = topological([c[0] for c in calls], [c[3] for c in calls])
    calls = [(*calls[i][:4], calls[i][4] + ["cycle"] * (i in looped)) for i in order]
    content = RESULT.sub("", CALL.sub("", text)).strip()
    return content, calls, RESULT.findall(text)


def parse(messages: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """Records of the messages (conv_id, turn, role, text): one for each message, call and result."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    kinds = {f.name: f.dataType.simpleString() for f in messages.schema}
    schema = _parse_datatype_string(RECORD.format(conv=kinds["conv_id"], turn=kinds["turn"]))
    arrow_schema = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                out = []
                for conv, turn, role, text in zip(*(c.to_pylist() for c in batch.slice(at, 2000).columns), strict=True):
                    content, calls, results = parse_message(text or "", schemas)
                    out.append(("message", conv, turn, 0, None, role, content, [], []))
                    out += [("call", conv, turn, i, c[0], c[1], c[2], c[3], c[4]) for i, c in enumerate(calls)]
                    out += [("result", conv, turn, i, r[0], None, r[1], [], []) for i, r in enumerate(results)]
                columns = list(zip(*out, strict=True)) if out else [[] for _ in arrow_schema]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow_schema, strict=True)], schema=arrow_schema)

    return messages.select("conv_id", "turn", "role", "text").mapInArrow(run, schema)


def _quoted(value: Column) -> Column:
    """A text as a JSON string, null as null."""
    whole = F.to_json(F.array(value))
    return F.when(value.isNull(), F.lit("null")).otherwise(F.substring(whole, F.lit(2), F.length(whole) - 2))


def link_tool_calls(messages: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """Rows kind, conv_id, turn, place, id, name, status, errors, record (canonical JSON).

    Order by turn and place for a topological order of a conversation's calls. Runs a job while the plan is built.
    """
    rows = cut_lineage(parse(messages, schemas).withColumn("conv", F.coalesce(F.concat(F.lit("c"), F.col("conv_id").cast("string")), F.lit(""))))
    rows = rows.withColumn("row", F.monotonically_increasing_id())
    spot = F.struct(F.coalesce("turn", F.lit(0)).alias("turn"), F.col("place"), F.col("row"))
    hashed = lambda df: df.hint("shuffle_hash")
    calls, results = rows.where("kind = 'call'"), rows.where("kind = 'result'")
    named = calls.where("id is not null")
    owners = cut_lineage(named.groupBy("conv", "id").agg(F.min(spot).alias("owner")))
    answers = results.select("conv", "id", spot.alias("spot")).join(hashed(owners), ["conv", "id"]).where(F.col("spot.turn") >= F.col("owner.turn"))
    # the first answer's place is found without its text, which joins afterwards
    first = cut_lineage(answers.groupBy("conv", "id").agg(F.min("spot")["row"].alias("answer")))
    bodies = results.select(F.col("row").alias("answer"), F.col("body").alias("result"))

    targets = owners.select("conv", F.col("id").alias("ref"), "owner")
    wanted = calls.select("row", "conv", F.coalesce("turn", F.lit(0)).alias("at"), F.explode("refs").alias("ref"))
    lost = wanted.join(hashed(targets), ["conv", "ref"], "left").where(F.col("owner").isNull() | (F.col("owner.turn") > F.col("at")))
    lost = lost.groupBy("row").agg(F.count(F.lit(1)).alias("lost"))

    linked = named.join(hashed(owners), ["conv", "id"]).join(hashed(first), ["conv", "id"], "left").join(hashed(lost), "row", "left")
    own = F.col("row") == F.col("owner.row")
    status = F.when(~own, "duplicate").when(F.col("answer").isNull(), "unanswered").otherwise("linked")
    # calls without an answer of their own ask for a row that does not exist, each for another one
    linked = linked.withColumn("status", status).withColumn("answer", F.when(F.col("status") == "linked", F.col("answer")).otherwise(-1 - F.col("row")))
    linked = linked.join(hashed(bodies), "answer", "left").select("kind", "conv_id", "turn", "place", "id", "name", "body", "errors", "status", "result", "lost")
    loose = calls.where("id is null").join(hashed(lost), "row", "left").select("kind", "conv_id", "turn", "place", "id", "name", "body", "errors", F.lit("no_id").alias("status"), F.lit(None).cast("string").alias("result"), "lost")
    unresolved = F.when(F.col("lost").isNotNull(), F.array(F.concat(F.lit("unresolved references: "), F.col("lost").cast("string")))).otherwise(F.array().cast("array<string>"))
    call_json = F.concat(F.lit('{"arguments":'), F.coalesce("body", F.lit("null")), F.lit(',"id":'), _quoted(F.col("id")), F.lit(',"name":'), _quoted(F.col("name")), F.lit(',"result":'), _quoted(F.col("result")), F.lit("}"))
    calls_out = linked.unionByName(loose).select("kind", "conv_id", "turn", "place", "id", "name", "status", F.array_join(F.concat("errors", unresolved), "; ").alias("errors"), call_json.alias("record"))

    used = results.join(hashed(owners), ["conv", "id"], "left").join(hashed(first), ["conv", "id"], "left")
    fate = F.when(F.col("owner").isNull(), "orphan").when(F.col("row") == F.col("answer"), "linked").otherwise("extra")
    result_json = F.concat(F.lit('{"content":'), _quoted(F.col("body")), F.lit(',"id":'), _quoted(F.col("id")), F.lit("}"))
    results_out = used.select("kind", "conv_id", "turn", "place", "id", "name", fate.alias("status"), F.lit("").alias("errors"), result_json.alias("record"))

    message_json = F.concat(F.lit('{"content":'), _quoted(F.col("body")), F.lit(',"role":'), _quoted(F.col("name")), F.lit("}"))
    messages_out = rows.where("kind = 'message'").select("kind", "conv_id", "turn", "place", "id", "name", F.lit("").alias("status"), F.lit("").alias("errors"), message_json.alias("record"))
    return messages_out.unionByName(calls_out).unionByName(results_out)


# tools of the derived messages: a search, a look-up that refers to a search, and one that takes limits
TOOLS = {
    "search": {"type": "object", "properties": {"query": {"type": "string"}, "limit": {"type": "integer", "minimum": 1, "maximum": 20}}, "required": ["query", "limit"], "additionalProperties": False},
    "fetch": {"type": "object", "properties": {"source": {"type": "string"}, "words": {"type": "array", "items": {"type": "string"}}}, "required": ["source"]},
}


def derived_messages(conversations: DataFrame) -> DataFrame:
    """Messages with calls and results made from plain conversations, each from its own row.

    An assistant's turn calls ``search`` with its first words and ``fetch``, written first, on that search's result or that of
    the turn before; limits above 20 break the schema. Every other kind of turn answers the turn before it: the search, and the fetch if its
    text has an even length.
    """
    name = lambda shift, kind: F.concat(F.lit(f"{kind}-"), F.coalesce(F.col("conv_id").cast("string"), F.lit("")), F.lit("-"), (F.col("turn") - shift).cast("string"))
    text = F.coalesce("text", F.lit(""))
    size, words = F.length(text), F.slice(F.split(text, " "), 1, 3)
    tagged = lambda s: F.concat(F.lit("\n<tool_call>"), F.to_json(s), F.lit("</tool_call>"))
    search = F.struct(name(0, "s").alias("id"), F.lit("search").alias("name"), F.struct(F.array_join(words, " ").alias("query"), (size % 23 + 1).alias("limit")).alias("arguments"))
    source = F.struct(F.when(size % 3 == 0, name(2, "s")).otherwise(name(0, "s")).alias("$ref"))
    fetch = F.struct(name(0, "f").alias("id"), F.lit("fetch").alias("name"), F.struct(words.alias("words"), source.alias("source")).alias("arguments"))
    answer = lambda ident: F.concat(F.lit('<tool_result id="'), ident, F.lit('">'), F.substring_index(text, ".", 1), F.lit("</tool_result>\n"))
    second = F.when(size % 2 == 0, answer(name(1, "f"))).otherwise(F.lit(""))
    made = F.when(F.col("role") == "assistant", F.concat(text, tagged(fetch), tagged(search))).otherwise(F.concat(answer(name(1, "s")), second, text))
    return conversations.select("conv_id", "turn", "role", made.alias("text"))
