"""Arguments that JSON's letter allows but no canonical line can hold."""

import json

from chronoloom.llm import toolcalls


def test_numbers_beyond_doubles_and_half_characters_are_invalid(spark):
    texts = ['{"x":1e999}', '{"x":-1e999}', '{"x":"\\ud83d"}', '{"x":NaN}', "[" * 100_000, "", None, '{"x":"\\ud83d\\ude00"}', '{"x":' + "9" * 400 + "}", '{"x":"' + "long " * 40_000 + '"}']
    rows = [("c", str(i), i, "f", t, []) for i, t in enumerate(texts)]
    calls = spark.createDataFrame([(*r, "extra") for r in rows], "conv_id string, call_id string, position long, name string, arguments string, depends_on array<string>, status string")
    results = spark.createDataFrame([("c", "0", 0, "r", 1), ("c", "7", 0, "r", 1)], "conv_id string, call_id string, position long, content string, place int")
    got = {r.call_id: r for r in toolcalls.link_calls(calls, results, {"f": {"type": "object"}}).collect()}
    assert [got[str(i)].status for i in range(len(texts))] == ["invalid"] * 7 + ["linked", "unanswered", "unanswered"]
    assert all(got[str(i)].errors == ["$: not JSON"] for i in range(7))
    assert json.loads(got["0"].canonical)["arguments"] == texts[0] and "😀" in got["7"].canonical and len(got["9"].canonical) > 200_000
