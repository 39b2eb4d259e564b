"""Tokens, decontamination, licenses, tool calls and shards against brute force."""

import base64
import collections
import hashlib
import json
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from chronoloom.llm import bpe, decontaminate, licenses, sharding, toolcalls
from chronoloom.llm.words import word_hashes


@pytest.fixture(scope="session")
def reference():
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="session")
def codec():
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        return bpe.Codec(bpe.Vocabulary.parse(f.read()), public_tokenizers.PATTERN, public_tokenizers.PATTERN)


def test_ids_are_those_of_the_library(codec, reference):
    rng = random.Random(1)
    letters = "aeiou  \n\t\r\x1c\x85  'sTtdHllrve0123%$#éñß漢字🙂́ठ  ½thequ"
    for _ in range(4000):
        x = "".join(rng.choice(letters) for _ in range(rng.randint(0, 50)))
        assert codec.encode(x).tolist() == reference.encode_ordinary(x), repr(x)
    for x in ("a" * 3000, "$" * 1000, " " * 1000 + "x", "ab" * 999, "the" * 500):
        assert codec.encode(x).tolist() == reference.encode_ordinary(x)


def test_small_tables_change_nothing(reference):
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        c = bpe.Codec(bpe.Vocabulary.parse(f.read()), public_tokenizers.PATTERN, None, max_pieces=5)
    c.fst.max_states = 20
    for x in ("internationalisation of réglementation " * 3, "one two three four five six seven eight"):
        assert c.encode(x).tolist() == reference.encode_ordinary(x)


def test_streaming_decode(codec):
    text = "aé漢🙂 ñandú " * 5
    ids = codec.encode(text)
    assert "".join(codec.decode_stream(ids[i : i + 1] for i in range(len(ids)))) == text
    bad = b"a\xc3\xff\xe0\x80z\xf0\x9f\xf4\x90x\xed\xa0"
    m = bpe.Utf8Machine()
    assert "".join(m.feed(bad[i : i + 1]) for i in range(len(bad))) + m.finish() == bad.decode("utf-8", "replace") and m.malformed
    good = text.encode() * 3
    for data in (good, bad, good + bad + good, good[:-1], b"", b"\x80", "é".encode()[:1]):
        for width in (1, 2, 3, 5, 64):
            m = bpe.Utf8Machine()
            got = "".join(m.feed(data[i : i + width]) for i in range(0, len(data), width)) + m.finish()
            assert got == data.decode("utf-8", "replace") and m.malformed == ("\ufffd" in got)


def test_digests_of_bytes_that_are_not_utf8(codec, monkeypatch):
    monkeypatch.setattr(bpe, "BLOCK", 3)
    for text in ("aé漢🙂 ñandú " * 5, ""):
        ids = codec.encode(text)
        assert codec.decoded_digest(ids) == hashlib.sha256(text.encode()).hexdigest()
        assert codec.decoded_digest(ids[1:]) == hashlib.sha256(codec.decode_bytes(ids[1:])).hexdigest()
    cut = codec.encode("🙂")[:1]
    assert codec.decoded_digest(cut) == hashlib.sha256(codec.decode_bytes(cut)).hexdigest()


def test_token_digests(docs, reference):
    rows = docs.select("doc_id", "text").collect()
    sha = lambda b: hashlib.sha256(b).hexdigest()
    want = collections.Counter((r.doc_id, len(i), sha(",".join(map(str, i)).encode()), sha((r.text or "").encode())) for r in rows for i in [reference.encode_ordinary(r.text or "")])
    assert collections.Counter(map(tuple, bpe.token_digests(docs).collect())) == want
    back = {r.doc_id: r.text for r in bpe.decode_documents(bpe.encode_documents(docs)).collect()}
    assert back == {r.doc_id: r.text or "" for r in rows}
    assert bpe.token_digests(docs.limit(0)).count() == 0


def distance(item, text):
    """Least edit distance of item to any passage, by the plain table."""
    row = [0] * (len(text) + 1)
    for i, w in enumerate(item, 1):
        new = [i]
        for j, t in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (w != t)))
        row = new
    return min(row)


@pytest.fixture(scope="session")
def leaks():
    rng = random.Random(5)
    words = ["of", "the", "and"] + ["w%d" % i for i in range(400)]
    prose = lambda n: [rng.choice(words) if rng.random() < 0.8 else rng.choice(words[:3]) for _ in range(n)]
    items = [prose(rng.randint(8, 60)) for _ in range(40)]
    rows = []
    for d in range(160):
        host, k = prose(rng.randint(0, 200)), rng.randrange(40)
        copy = list(items[k])
        for _ in range(rng.randint(0, max(0, (len(copy) - 1) // 5 + 1))):
            at = rng.randrange(len(copy))
            copy[at : at + rng.randint(0, 1)] = prose(rng.randint(0, 1))
        at = rng.randint(0, len(host))
        rows.append((d, host[:at] + (copy if d % 4 else []) + host[at:]))
    return items, rows


def test_decontamination_finds_all_within_the_distance(spark, leaks):
    items, rows = leaks
    docs = spark.createDataFrame([(d, "  ".join(w).title() + "!", "t") for d, w in rows] + [(900, None, ""), (901, "", "")], "doc_id long, text string, item_id string")
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(items)] + [(77, None), (78, "too short"), (None, "w1 w2 w3 w4 w5 w6 w7")], "item_id long, text string")
    want = {(d, i): n for d, w in rows for i, item in enumerate(items) for n in [distance(item, w)] if n <= (len(item) - 1) // 5}
    found = decontaminate.contaminations(docs, bench)
    got = {(r.doc_id, r.item_id): r.distance for r in found.collect()}
    assert set(got) <= set(want) and len(got) >= 0.97 * len(want) and all(got[k] == want[k] for k in got)
    assert {k for k, n in want.items() if n == 0} <= set(got)
    clean = decontaminate.drop_contaminated(docs, bench)
    assert clean.columns == docs.columns and {r.doc_id for r in clean.collect()} == ({r[0] for r in rows} | {900, 901}) - {d for d, _ in got}
    assert decontaminate.contaminations(docs.limit(0), bench).count() == 0
    assert decontaminate.contaminations(docs, bench.limit(0)).count() == 0


def test_best_distance_against_the_table():
    rng = np.random.default_rng(6)
    for _ in range(60):
        item, text = rng.integers(0, 4, rng.integers(1, 12)).astype(np.uint64), rng.integers(0, 4, rng.integers(0, 20)).astype(np.uint64)
        assert decontaminate.best_distance(item, text)[0] == distance(item.tolist(), text.tolist())


def test_word_hashes_of_long_texts():
    words = ["word%d" % (i % 977) for i in range(300_000)]
    h, begin = word_hashes([" ".join(words), None, "word1, WORD2!"])
    assert begin.tolist() == [0, 300_000, 300_000, 300_002]
    assert h[1] == h[300_000] and h[2] == h[300_001] and len(set(h.tolist())) == 977
    assert (h[977:1954] == h[:977]).all()


def test_licenses_by_containment(spark):
    rng = random.Random(7)
    templates = [("short", "all rights reserved"), ("five", "released under the mit license"), ("long", " ".join("t%d" % i for i in range(40))), ("none", "!!")]
    rows = []
    for d in range(120):
        name, text = templates[d % 3]
        words = text.split()
        for _ in range(rng.randint(0, 3) if d % 2 else 0):
            words[rng.randrange(len(words))] = "x%d" % d
        host = ["h%d" % rng.randrange(50) for _ in range(rng.randint(0, 30))]
        rows.append((d, " ".join(host[:10] + words + host[10:] + (words if d % 5 == 0 else []))))
    want = {}
    for d, text in rows:
        w = text.split()
        for name, t in templates[:3]:
            t = t.split()
            q = min(5, len(t))
            have = {tuple(t[i : i + q]) for i in range(len(t) - q + 1)}
            best = max((len(have & {tuple(w[s + i : s + i + q]) for i in range(len(t) - q + 1)}) / len(have) for s in range(len(w))), default=0)
            if best >= 0.8:
                want[d, name] = round(best, 9)
    df = spark.createDataFrame([(d, t.upper(), "x") for d, t in rows] + [(990, None, ""), (991, "", "")], "doc_id long, text string, template_id string")
    got = {(r.doc_id, r.template_id): round(r.containment, 9) for r in licenses.license_matches(df, templates).collect()}
    assert got == want
    assert licenses.license_matches(df.limit(0)).count() == 0
    assert [(r.template_id, r.n_places) for r in licenses.license_matches(spark.createDataFrame([(1, "All rights reserved. x All rights  reserved.")], "doc_id long, text string")).collect()] == [("all-rights-reserved", 2)]


def test_tool_calls(spark):
    schema = {"add": {"type": "object", "required": ["a"], "properties": {"a": {"type": "integer", "minimum": 0}, "b": {"type": "array", "items": {"type": "string"}}}, "additionalProperties": False}}
    call = lambda i, n, a, d=(): {"id": i, "name": n, "arguments": a, "depends_on": list(d)}
    said = lambda *c: json.dumps({"tool_calls": list(c)})
    messages = [
        (1, 1, "user", "hello"), (1, 2, "assistant", said(call("x", "add", '{"b": ["é"], "a": 1}'), call("y", "add", '{"a": -1}', ["x"]), call("z", "add", "{nope"), call("u", "other", "{}"))),
        (1, 3, "tool", json.dumps({"tool_call_id": "x", "content": "2"})), (1, 4, "tool", json.dumps({"tool_call_id": "x", "content": "3"})), (1, 5, "tool", json.dumps({"tool_call_id": "lost", "content": "4"})),
        (2, 1, "assistant", said(call("p", "add", '{"a": 1, "q": NaN}'), call("early", "add", '{"a": 2}', ["late"]), call("late", "add", '{"a": 3}'))),
        (2, 2, "assistant", said(call("c1", "add", '{"a": 1}', ["c2"]), call("c2", "add", '{"a": 1}', ["c1"]))), (2, 3, "assistant", None), (3, 1, "assistant", "plain"),
    ]
    calls, results = toolcalls.extract(spark.createDataFrame(messages, "conv_id long, turn long, role string, text string"))
    got = {r.call_id: r for r in toolcalls.link_calls(calls, results, schema, rounds=6).collect()}
    assert {k: r.status for k, r in got.items()} == {"x": "linked", "y": "invalid", "z": "invalid", "u": "invalid", "lost": "orphan", "p": "invalid", "early": "unanswered", "late": "unanswered", "c1": "cyclic", "c2": "cyclic"}
    assert got["x"].canonical == '{"arguments":{"a":1,"b":["é"]},"id":"x","name":"add","result":"2"}' and got["x"].n_results == 2
    assert got["y"].errors == ["$.a: minimum"] and got["z"].errors == ["$: not JSON"] and got["u"].errors == ["$: no schema"]
    assert got["early"].place > got["late"].place and got["y"].place > got["x"].place
    assert toolcalls.link_calls(calls.limit(0), results.limit(0), schema).count() == 0
    assert toolcalls.schema_errors({"b": [1]}, schema["add"]) == ["$.a: required", "$.b[0]: type"]


def least_capacity(sizes, shards):
    lo, hi = max(sizes), sum(sizes)
    while lo < hi:
        mid, n, held = (lo + hi) // 2, 1, 0
        for s in sizes:
            if held + s > mid:
                n, held = n + 1, 0
            held += s
        lo, hi = (lo, mid) if n <= shards else (mid + 1, hi)
    return lo


@pytest.mark.parametrize("bits", [(16, 8), (2, 1)])
def test_shards(spark, docs, bits, monkeypatch):
    monkeypatch.setattr(sharding, "FIRST_BITS", bits[0])
    monkeypatch.setattr(sharding, "MORE_BITS", bits[1])
    for shards in (1, 4, 16):
        rows = sharding.shard_documents(docs, shards).collect()
        texts = collections.Counter((r.doc_id, r.text) for r in docs.select("doc_id", "text").collect())
        assert len(rows) == sum(texts.values())
        by_id = {r.doc_id: r for r in rows}
        for (i, t), _ in texts.items():
            assert (by_id[i].size, by_id[i].text_crc32) == (len((t or "").encode()) + 1, zlib.crc32((t or "").encode()))
        groups = collections.defaultdict(set)
        for (i, t), _ in texts.items():
            groups[t].add(by_id[i].shard)
        assert all(len(g) == 1 for g in groups.values())
        slots = collections.defaultdict(list)
        load = collections.Counter()
        for r in rows:
            slots[r.shard].append(r.slot)
            load[r.shard] += r.size
        assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(shards))
        hashed = docs.selectExpr("coalesce(xxhash64(text), 0) as h", "text is null as missing", "coalesce(octet_length(text), 0) + 1 as s").selectExpr("if(missing, xxhash64(0), h) as h", "s").groupBy("h").sum("s").orderBy("h").collect()
        assert max(load.values()) == least_capacity([r[1] for r in hashed], shards)
    assert sharding.shard_documents(docs.limit(0)).count() == 0
