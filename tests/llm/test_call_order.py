"""Links and order of tool calls: shared identifiers, long reversed chains beside a cycle, awkward rows."""

import json

from chronoloom.llm import toolcalls

CALLS = "conv_id long, call_id string, position long, name string, arguments string, depends_on array<string>"
RESULTS = "conv_id long, call_id string, position long, content string"


def test_only_calls_on_or_behind_a_cycle_are_cyclic(spark):
    n = 12
    rows = [(1, f"a{i}", i, "f", "{}", [f"a{i + 1}"] if i < n - 1 else []) for i in range(n)]
    rows += [(2, "x", 0, "f", "{}", ["y"]), (2, "y", 1, "f", "{}", ["x"]), (2, "z", 2, "f", "{}", ["y"]), (3, "s", 0, "f", "{}", ["s"]), (4, "w", 5, "f", "{}", ["gone"])]
    rows += [(5, "a0", 3, "f", "{}", ["a1"]), (5, "a1", 4, "f", "{}", [])]  # identifiers of another conversation
    calls = spark.createDataFrame(rows, CALLS).coalesce(1)
    out = {(r.conv_id, r.call_id): r for r in toolcalls.link_calls(calls, spark.createDataFrame([], RESULTS), {"f": {}}, rounds=3).collect()}
    assert {k for k, r in out.items() if r.status == "cyclic"} == {(2, "x"), (2, "y"), (2, "z"), (3, "s")}
    assert [out[1, f"a{i}"].place for i in range(n)] == [2 * n - 2 - i for i in range(n)]
    assert (out[5, "a0"].place, out[5, "a1"].place) == (5, 4)


def test_identifiers_count_within_their_conversation(spark):
    say = lambda conv, turn, role, value: (conv, turn, role, value if isinstance(value, str) else json.dumps(value), "extra")
    call = lambda i, **k: {"tool_calls": [{"id": i, "name": "f", "arguments": "{}", **k}]}
    many = {"tool_calls": [{"id": f"m{i}", "name": "f", "arguments": "{}", "depends_on": [f"m{i - 1}"] if i else []} for i in range(1500)]}
    messages = [
        say(1, 0, "assistant", call("call_1")), say(1, 1, "tool", {"tool_call_id": "call_1", "content": "ONE"}),
        say(2, 0, "assistant", call("call_1")), say(2, 1, "tool", {"tool_call_id": "call_1", "content": "TWO"}),
        say(2, 2, "tool", {"tool_call_id": "lost", "content": "L" * 100_000}), say(3, 0, "assistant", call("call_1")),
        say(None, 0, "assistant", call("call_1")), say(None, 1, "tool", {"tool_call_id": "call_1", "content": "NONE"}),
        say(4, 0, "assistant", many), say(4, 1, "assistant", call("after", depends_on=["m1499"])), say(5, None, "assistant", call("q")), say(6, 0, None, None),
    ]
    df = spark.createDataFrame(messages, "conv_id long, turn long, role string, text string, call_id string").coalesce(1)
    calls, results = toolcalls.extract(df)
    again = calls.union(calls.filter("conv_id = 3"))
    out = toolcalls.link_calls(again, results, {"f": {}}).collect()
    by = {(r.conv_id, r.call_id): r for r in out}
    assert len(out) == 1508 and sum(r.conv_id == 3 for r in out) == 2
    said = lambda c, i: json.loads(by[c, i].canonical)["result"]
    assert (said(1, "call_1"), said(2, "call_1"), said(3, "call_1"), said(None, "call_1")) == ("ONE", "TWO", None, None)
    assert by[2, "lost"].status == "orphan" and len(said(2, "lost")) == 100_000 and by[None, "call_1"].status == by[3, "call_1"].status == "unanswered"
    assert len({r.position for r in out if r.conv_id == 4}) == 1501 and by[4, "after"].place > by[4, "m1499"].place
