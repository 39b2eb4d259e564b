"""SimHash, suffix sort and vector joins against brute force."""

import collections
import hashlib

import numpy as np
import pytest
import xxhash

from chronoloom.llm import simhash, suffix, vectors


def roots(ids, linked):
    """Least reachable id by repeated sweeps."""
    label = dict(zip(ids, ids))
    while True:
        new = {i: min([label[i], *(label[j] for j in linked[i])]) for i in ids}
        if new == label:
            return label
        label = new


def brute_fingerprint(text):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").replace("\t", " ").replace("\n", " ").split(" ") if w]
    if not words:
        return 0
    grams = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    h = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_fingerprints(texts):
    assert [simhash.fingerprint(t) for t in texts] == [brute_fingerprint(t) for t in texts]


def test_golay_keys_meet_within_two_bits():
    rng = np.random.default_rng(0)
    w = rng.integers(0, 1 << 23, 3000)
    row, key = simhash.golay_keys(w)
    mine = collections.defaultdict(set)
    for a, b in zip(row.tolist(), key.tolist()):
        mine[a].add(b)
    assert {len(s) for s in mine.values()} == {1, 6}
    for _ in range(2):
        other = w ^ (1 << rng.integers(0, 23, len(w))) ^ (1 << rng.integers(0, 23, len(w)))
        row, key = simhash.golay_keys(other)
        assert {a for a, b in zip(row.tolist(), key.tolist()) if b in mine[a]} == set(range(len(w)))


@pytest.mark.parametrize("max_bucket", [512, 2])
def test_links_of_crowded_fingerprints(spark, max_bucket):
    rng = np.random.default_rng(1)
    centre = [int(x) for x in rng.integers(0, 1 << 62, 6)]
    fps = {c ^ sum(1 << int(b) for b in rng.choice(64, k, replace=False)) for c in centre for k in (0, 1, 1, 2, 2, 3, 4) for _ in range(12)}
    fps = sorted(x - (1 << 64) if x >= 1 << 63 else x for x in fps)
    linked = {a: [b for b in fps if a != b and bin((a ^ b) & (1 << 64) - 1).count("1") <= 2] for a in fps}
    df = spark.createDataFrame([(x,) for x in fps], "fp long")
    from chronoloom.operators.components import connected_components

    got = {r.node: r.component for r in connected_components(simhash.fingerprint_links(df, max_bucket)).collect()}
    want = roots(fps, linked)
    assert {x: got.get(x, x) for x in fps} == want


def test_simhash_components(docs):
    rows = docs.select("doc_id", "text").collect()
    fp = {r.doc_id: brute_fingerprint(r.text) for r in rows if r.doc_id is not None}
    linked = {a: [b for b in fp if bin(fp[a] ^ fp[b]).count("1") <= 2] for a in fp}
    got = simhash.simhash_components(docs).collect()
    assert len(got) == len(rows)
    want = roots(list(fp), linked)
    assert all(r.component_id == want[r.doc_id] and r.fingerprint == f"{fp[r.doc_id]:016x}" for r in got if r.doc_id is not None)
    kept = simhash.first_of_components(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == sorted(set(want.values()))
    assert simhash.simhash_components(docs.limit(0)).count() == 0


def brute_repeats(texts):
    data = [(t or "").encode() for t in texts]
    seen = collections.Counter(b[i : i + 200] for b in data for i in range(len(b) - 199))
    out = []
    for b in data:
        cut = np.zeros(len(b), dtype=bool)
        for i in range(len(b) - 199):
            if seen[b[i : i + 200]] > 1:
                cut[i : i + 200] = True
        runs = int((np.diff(np.concatenate(([0], cut.astype(int)))) == 1).sum())
        out.append((len(b), int(cut.sum()), runs, hashlib.sha256(np.frombuffer(b, np.uint8)[~cut].tobytes()).hexdigest()))
    return out


@pytest.mark.parametrize("bucket", [4096, 3])
def test_suffix_sort_removes_what_repeats(docs, bucket, monkeypatch):
    monkeypatch.setattr(suffix, "BUCKET", bucket)
    rows = docs.select("doc_id", "text").collect()
    want = collections.Counter((r.doc_id, *w) for r, w in zip(rows, brute_repeats([r.text for r in rows])))
    assert collections.Counter(map(tuple, suffix.repeat_digests(docs).collect())) == want
    assert suffix.repeat_digests(docs.limit(0)).count() == 0


def test_suffix_order_and_collisions():
    rng = np.random.default_rng(2)
    size = rng.integers(0, 30, 400)
    rows = np.zeros((400, 32), dtype=np.uint8)
    for i, n in enumerate(size):
        rows[i, :n] = rng.integers(97, 99, n)
    bucket = np.sort(rng.integers(0, 20, 400))
    order, common = suffix.suffix_sort(rows, size, bucket)
    keys = [(bucket[i], rows[i, : size[i]].tobytes()) for i in order]
    assert keys == sorted(keys)
    for k in range(1, 400):
        (a, x), (b, y) = keys[k - 1], keys[k]
        n = next((i for i, (p, q) in enumerate(zip(x, y)) if p != q), min(len(x), len(y)))
        assert common[k] == (n if a == b else -1)


def test_long_texts_are_hashed_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(suffix, "CHUNK", 1000)
    suffix._tables.cache_clear()
    rng = np.random.default_rng(3)
    long = "".join(chr(c) for c in rng.integers(97, 123, 9000))
    rows = [(1, long), (2, long[2500:7100]), (3, "z" * 50 + long[8000:8400])]
    data, ends = np.frombuffer(long.encode(), dtype=np.uint8), np.array([1199])
    assert len(suffix.find_runs(data[:1199], ends)[0]) > 0
    suffix._tables.cache_clear()
    monkeypatch.undo()
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, suffix.repeat_digests(df).collect())) == sorted((i, *w) for (i, _), w in zip(rows, brute_repeats([t for _, t in rows])))


@pytest.mark.parametrize("heavy", [10_000, 2])
def test_rows_are_texts_whatever_their_ids(spark, heavy, monkeypatch):
    monkeypatch.setattr(suffix, "HEAVY", heavy)
    rng = np.random.default_rng(8)
    a, b, c = ("".join(chr(x) for x in rng.integers(97, 123, 900)) for _ in range(3))
    rows = [(None, a), (None, b), (7, c), (7, a[:300]), (8, "x" + c[100:450] + "y"), (8, None), (None, ""), (9, b[:150])]
    rows += [(20 + i, c[:260] + f"{i:03d}" + c[500:]) for i in range(9)] + [(40, a[600:]), (40, a[600:])]
    df = spark.createDataFrame([(*r, 1, "k") for r in rows], "doc_id long, text string, anchor int, key string")
    want = brute_repeats([t for _, t in rows])
    assert want[1][1] == 0 and want[0][1] > 0
    assert sorted(map(repr, map(tuple, suffix.repeat_digests(df).collect()))) == sorted(repr((i, *w)) for (i, _), w in zip(rows, want))
    cut = suffix.remove_repeats(df)
    assert cut.columns == df.columns
    assert sorted(len(r.text.encode()) for r in cut.collect() if r.text is not None) == sorted(w[0] - w[1] for (_, t), w in zip(rows, want) if t is not None)


def test_row_hash_tells_rows_apart(spark, monkeypatch):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (None, "a"), (None, None), (1, "a")], "doc_id long, text string")
    assert df.select(suffix.row_hash(df, "doc_id", "text")).distinct().count() == 4


def test_cut_keeps_characters_whole(docs):
    assert suffix.cut_spans("aéb", [{"b": 2, "e": 3}]) == "aéb"
    assert suffix.cut_spans("aéb", [{"b": 1, "e": 3}, {"b": 3, "e": 4}]) == "a"
    assert suffix.cut_spans(None, None) is None
    out = suffix.remove_repeats(docs)
    assert out.columns == docs.columns and out.count() == docs.count()


def test_pivots_only_where_they_exclude():
    rng = np.random.default_rng(5)
    even = vectors._units(rng.normal(size=(512, 64)))
    assert len(vectors.choose_pivots(even, 0.374, 100_000)) == 0
    centres = vectors._units(rng.normal(size=(40, 64)))
    clustered = vectors._units(centres[rng.integers(0, 40, 512)] + rng.normal(size=(512, 64)) * 0.01)
    pivots = vectors.choose_pivots(clustered, 0.374, 100_000)
    assert len(pivots) >= 8
    home, copied = vectors.cells_of(clustered, pivots, 0.374)
    near = np.argwhere(clustered @ clustered.T >= 0.93)
    assert all(home[a] == home[b] or copied[a, home[b]] or copied[b, home[a]] for a, b in near)


def test_vectors_of_many_lengths_and_sizes(spark):
    rows = [(i, [1.0] * (i // 2 + 1), 1) for i in range(160)] + [(500, [1e200, 1e200, 1e200], 1), (501, [1e-300, 1e-300, 1e-300], 1)]
    got = {r.vec_id: r.component_id for r in vectors.cosine_links(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label long")).collect()}
    assert got == {i: i // 2 * 2 for i in range(160)} | {500: 4, 501: 4}


@pytest.mark.parametrize("numbers, pivots", [(1 << 19, 0), (16 * 16, 0), (16 * 20, 6), (1 << 19, 6)])
def test_cosine_links(spark, numbers, pivots, monkeypatch):
    monkeypatch.setattr(vectors, "BLOCK_NUMBERS", numbers)
    if pivots:
        monkeypatch.setattr(vectors, "PIVOT_FROM", 20)
        monkeypatch.setattr(vectors, "choose_pivots", lambda x, radius, n: x[:pivots])
    rng = np.random.default_rng(4)
    base = rng.normal(size=(12, 16))
    x = [base[i % 12] + rng.normal(size=16) * (0.2 if i % 3 else 0.05) for i in range(150)]
    rows = [(i * 2, [float(v) for v in p], i % 2) for i, p in enumerate(x)]
    rows += [(900, rows[4][1], rows[4][2]), (901, [2 * v for v in rows[4][1]], rows[4][2]), (902, rows[4][1], None), (903, None, 1), (904, [0.0] * 16, 1), (905, [float("nan")] * 16, 1), (906, [None] + [1.0] * 15, 1), (907, [], 1), (908, [1.0, 0.0], 1), (909, [1.0, 0.1], 1)]
    df = spark.createDataFrame([(*r, 1, "c") for r in rows], "vec_id long, embedding array<double>, label int, first int, cell string")

    def unit(p):
        if not p or any(v is None or not np.isfinite(v) for v in p) or not any(p):
            return None
        return np.array(p) / np.linalg.norm(p)

    u = {i: (unit(p), lab) for i, p, lab in rows}
    near = lambda a, b: a != b and u[a][0] is not None and u[b][0] is not None and u[a][1] is not None and u[a][1] == u[b][1] and len(u[a][0]) == len(u[b][0]) and float(u[a][0] @ u[b][0]) >= 0.93
    linked = {a: [b for b in u if near(a, b)] for a in u}
    want = roots(list(u), linked)
    assert sum(map(len, linked.values())) > 200
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in vectors.cosine_links(df).collect()}
    assert got == {i: (len(linked[i]), want[i], want[i] == i) for i in u}
    assert vectors.cosine_links(df.limit(0)).count() == 0
