"""Tool calls of conversations: linked to results, ordered, validated, serialised.

Calls and results meet in a hash join on conversation and call identifier. A
call may name others of its conversation that it depends on. Message order is a
topological order unless a call precedes one it depends on; positions are raised
only along such edges, round by round. In conversations that a few rounds don't
settle, calls without open dependencies are taken out until nothing changes, so
that only calls on a cycle and those that depend on one remain and are reported;
this has no limit of rounds. Arguments are checked against the schema of the
tool, and each call becomes one line of canonical JSON: sorted keys, no spaces.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Mapping
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from chronoloom.llm.batches import parts
from chronoloom.sources.shared import drop_shared, materialize

_TYPES = {"object": dict, "array": list, "string": str, "boolean": bool, "null": type(None)}


def _is(value: Any, kind: str) -> bool:
    if kind in ("integer", "number"):
        return isinstance(value, int) and not isinstance(value, bool) or isinstance(value, float) and (kind == "number" or value.is_integer())
    return isinstance(value, _TYPES[kind])


def schema_errors(value: Any, schema: Mapping[str, Any], path: str = "$") -> list[str]:
    """What of ``value`` doesn't fit a JSON schema: type, enum, required, properties, additionalProperties, items, bounds of numbers and lengths."""
    kinds = schema.get("type")
    if kinds and not any(_is(value, k) for k in ([kinds] if isinstance(kinds, str) else kinds)):
        return [f"{path}: type"]
    out = []
    if "enum" in schema and value not in schema["enum"]:
        out.append(f"{path}: enum")
    if isinstance(value, (int, float)) and not isinstance(value, bool):
        out += [f"{path}: {k}" for k, bad in (("minimum", lambda m: value < m), ("maximum", lambda m: value > m)) if k in schema and bad(schema[k])]
    if isinstance(value, str):
        out += [f"{path}: {k}" for k, bad in (("minLength", lambda m: len(value) < m), ("maxLength", lambda m: len(value) > m)) if k in schema and bad(schema[k])]
    if isinstance(value, list) and "items" in schema:
        out += [e for i, x in enumerate(value) for e in schema_errors(x, schema["items"], f"{path}[{i}]")]
    if isinstance(value, dict):
        known = schema.get("properties", {})
        out += [f"{path}.{k}: required" for k in schema.get("required", ()) if k not in value]
        for k in sorted(value):
            if k in known:
                out += schema_errors(value[k], known[k], f"{path}.{k}")
            elif schema.get("additionalProperties", True) is False:
                out.append(f"{path}.{k}: unknown")
    return out


def canonical(value: Any) -> str:
    """JSON with sorted keys and without spaces; NaN and infinities aren't JSON."""
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False)


def _no_constant(name: str) -> Any:
    raise ValueError(name)


def extract(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results of messages ``(conv_id, turn, role, text)`` whose texts are JSON.

    An assistant's ``{"tool_calls": [{"id", "name", "arguments", "depends_on"}]}``
    holds calls; a tool's ``{"tool_call_id", "content"}`` is a result. Other texts
    hold neither.
    """
    shape = "tool_calls array<struct<id: string, name: string, arguments: string, depends_on: array<string>>>"
    # Turns in the upper half, so that no turn runs into the next, however many calls it makes.
    place = F.call_function("shiftleft", F.col("turn").cast("long"), F.lit(32))
    found = messages.filter("role = 'assistant'").select("conv_id", place.alias("at"), F.posexplode(F.from_json("text", shape)["tool_calls"]).alias("n", "c"))
    calls = found.select("conv_id", F.col("c.id").alias("call_id"), F.col("at").bitwiseOR(F.col("n").cast("long")).alias("position"), F.col("c.name").alias("name"), F.col("c.arguments").alias("arguments"), F.col("c.depends_on").alias("depends_on"))
    given = messages.filter("role = 'tool'").select("conv_id", place.alias("position"), F.from_json("text", "tool_call_id string, content string").alias("r"))
    results = given.select("conv_id", F.col("r.tool_call_id").alias("call_id"), "position", F.col("r.content").alias("content")).filter("call_id is not null")
    return calls, results


def turns_as_calls(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Plain conversations as calls: a user's turn asks, the assistant's next turn is the result, and each question depends on the one two turns before."""
    name = lambda turn: F.concat_ws(":", F.col("conv_id").cast("string"), turn.cast("string"))
    user = messages.filter("role = 'user' and conv_id is not null and turn is not null")
    arguments = F.to_json(F.struct(F.col("text"), F.length("text").alias("chars")))
    depends = F.when(F.col("turn") >= 2, F.array(name(F.col("turn") - 2))).otherwise(F.array().cast("array<string>"))
    calls = user.select("conv_id", name(F.col("turn")).alias("call_id"), F.col("turn").cast("long").alias("position"), F.lit("ask").alias("name"), arguments.alias("arguments"), depends.alias("depends_on"))
    replies = messages.filter("role = 'assistant' and conv_id is not null and turn is not null")
    results = replies.select("conv_id", name(F.col("turn") - 1).alias("call_id"), F.col("turn").cast("long").alias("position"), F.col("text").alias("content"))
    return calls, results


#: The schema of the questions that turns_as_calls makes.
ASK = {"ask": {"type": "object", "required": ["text", "chars"], "properties": {"text": {"type": "string", "minLength": 1}, "chars": {"type": "integer", "minimum": 1}}, "additionalProperties": False}}


KEY = ["conv_id", "call_id"]


def _ordered(calls: DataFrame, rounds: int) -> DataFrame:
    """``(conv_id, call_id, place, cyclic)`` such that a call's place exceeds those of the calls it depends on."""
    named = calls.filter("conv_id is not null and call_id is not null")
    first = named.groupBy(KEY).agg(F.min("position").alias("place"))
    edges = named.select(*KEY, F.explode("depends_on").alias("on")).filter("on is not null").distinct()
    places, wrong = first, None
    for _ in range(rounds):
        other = places.select("conv_id", F.col("call_id").alias("on"), F.col("place").alias("p"))
        late = edges.join(other, ["conv_id", "on"]).groupBy(KEY).agg(F.max("p").alias("p"))
        wrong = materialize(places.join(late, KEY).filter("p >= place").select(*KEY, "p"), "late-calls")
        if wrong.isEmpty():
            return places.select(*KEY, "place", F.lit(False).alias("cyclic"))
        places = materialize(places.join(wrong, KEY, "left").select(*KEY, F.greatest("place", F.col("p") + 1).alias("place")), "places")
    unsettled = wrong.select("conv_id").distinct()
    peeled = _peeled(*(materialize(t.join(unsettled, "conv_id", "left_semi"), "unsettled") for t in (first, edges)))
    return places.join(unsettled, "conv_id", "left_anti").select(*KEY, "place", F.lit(False).alias("cyclic")).union(peeled)


def _peeled(first: DataFrame, edges: DataFrame) -> DataFrame:
    """``(conv_id, call_id, place, cyclic)`` by taking calls without open dependencies until none is left: only those on or behind a cycle remain."""
    on = ["conv_id", "on"]
    known = materialize(edges.join(first.select("conv_id", F.col("call_id").alias("on")), on).select(*KEY, "on"), "dependencies")
    needs = known.groupBy(KEY).agg(F.count("*").alias("open"))
    state = materialize(first.join(needs, KEY, "left").select(*KEY, "place", F.coalesce("open", F.lit(0)).alias("open")), "places")
    while not (ready := state.filter("open = 0")).isEmpty():
        taken = ready.select("conv_id", F.col("call_id").alias("on"), F.col("place").alias("p"))
        met = known.join(taken, on).groupBy(KEY).agg(F.count("*").alias("n"), F.max("p").alias("p"))
        left = F.when(F.col("open") > 0, F.col("open") - F.coalesce("n", F.lit(0))).otherwise(-1)
        new = materialize(state.join(met, KEY, "left").select(*KEY, F.greatest("place", F.col("p") + 1).alias("place"), left.cast("long").alias("open")), "places")
        drop_shared(state)
        state = new
    on_cycle = F.col("open") > 0
    return state.join(first.select(*KEY, F.col("place").alias("at")), KEY).select(*KEY, F.when(on_cycle, F.col("at")).otherwise(F.col("place")).alias("place"), on_cycle.alias("cyclic"))


def link_calls(calls: DataFrame, results: DataFrame, schemas: Mapping[str, Mapping[str, Any]], rounds: int = 8) -> DataFrame:
    """One row for each call and for each identifier that only results of its conversation have.

    ``calls (conv_id, call_id, position, name, arguments, depends_on)`` and
    ``results (conv_id, call_id, position, content)`` give ``(conv_id, call_id,
    position, place, n_results, status, errors, canonical)``. Identifiers count
    within their conversation. Of several results of a call the first counts (by
    position, then content). status: "linked", "unanswered", "orphan" (results
    without a call), "invalid" (arguments that don't fit or aren't JSON, numbers
    beyond doubles and halves of characters among them; a tool without a schema) or "cyclic". A null conversation or identifier links with
    nothing: such calls are unanswered, such results drop out. Repeated calls
    each give a row. Texts are taken whole; other columns are ignored. Empty
    tables give an empty result. ``rounds`` only decides when conversations whose
    calls precede what they depend on are ordered by taking calls out.
    """
    given = results.filter("conv_id is not null and call_id is not null").groupBy(KEY).agg(F.min(F.struct("position", "content")).alias("r"), F.count("*").alias("n"))
    given = given.select(*KEY, F.col("r.content").alias("result"), F.col("n").alias("n_results"), F.lit(True).alias("has"))
    asked = calls.select(*KEY, "position", "name", "arguments", "depends_on")
    asked = asked.join(_ordered(asked, rounds), KEY, "left").withColumn("called", F.lit(True))
    rows = asked.join(given, KEY, "full_outer")
    rows = rows.select("conv_id", "call_id", "position", F.coalesce("place", "position").alias("place"), "name", "arguments", "result", F.coalesce("n_results", F.lit(0)).alias("n_results"), F.coalesce("called", F.lit(False)).alias("called"), F.coalesce("has", F.lit(False)).alias("has"), F.coalesce("cyclic", F.lit(False)).alias("cyclic"))
    names = ["conv_id", "call_id", "position", "place", "n_results", "status", "errors", "canonical"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in parts(batches):
            status, errors, lines = [], [], []
            for r in b.to_pylist():
                wrong, line = [], None
                whole = {"arguments": None, "id": r["call_id"], "name": r["name"], "result": r["result"]}
                if r["called"]:
                    try:
                        value = json.loads(r["arguments"], parse_constant=_no_constant)
                        wrong = schema_errors(value, schemas[r["name"]]) if r["name"] in schemas else ["$: no schema"]
                        line = canonical(whole | {"arguments": value})
                        line.encode()  # half a character isn't text
                    except (TypeError, ValueError, RecursionError):
                        wrong, line = ["$: not JSON"], canonical(whole | {"arguments": r["arguments"]})
                status.append("orphan" if not r["called"] else "cyclic" if r["cyclic"] else "invalid" if wrong else "linked" if r["has"] else "unanswered")
                errors.append(wrong)
                lines.append(line or canonical(whole))
            cols = [b.column(b.schema.get_field_index(n)) for n in names[:5]]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(status, pa.string()), pa.array(errors, pa.list_(pa.string())), pa.array(lines, pa.string())], names=names)

    kind = dict(calls.dtypes)["conv_id"]
    return rows.mapInArrow(run, f"conv_id {kind}, call_id string, position long, place long, n_results long, status string, errors array<string>, canonical string")
