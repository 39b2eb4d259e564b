"""Benchmark items of many words at the greatest allowed distance."""

import random

import pytest

from chronoloom.llm import decontaminate


def edited(rng, words, kinds, word):
    out = list(words)
    for _ in range(decontaminate.edits_allowed(len(words))):
        kind, i = rng.choice(kinds), rng.randrange(len(out))
        if kind == "delete":
            del out[i]
        elif kind == "insert":
            out.insert(i, word())
        else:
            out[i] = word()
    return out


@pytest.mark.parametrize("n", [7, 20, 59, 100, 200, 400])
@pytest.mark.parametrize("kinds", [("delete",), ("insert",), ("delete", "insert", "replace")])
def test_found_at_the_greatest_distance(n, kinds):
    rng = random.Random(n)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(5))
    items = [[word() for _ in range(n)] for _ in range(20)]
    index = decontaminate.Index(list(range(20)), [" ".join(w) for w in items])
    prose = lambda k: [word() for _ in range(k)]
    texts = [" ".join(prose(rng.randint(0, 300)) + edited(rng, w, kinds, word) + prose(rng.randint(0, 300))) for w in items]
    got = index.hits([*texts, " ".join(prose(2000)), None, ""])
    for i, found in enumerate(got[:20]):
        assert [f[0] for f in found] == [i] and found[0][1] <= decontaminate.edits_allowed(n)
    assert got[20:] == [[], [], []]


def test_places_in_small_pieces(monkeypatch):
    rng = random.Random(1)
    word = lambda: rng.choice(["aa", "bb", "cc", "dd"])
    texts = [" ".join(word() for _ in range(200)) for _ in range(30)]
    index = decontaminate.Index([0, 1], [" ".join(texts[3].split()[50:70]), " ".join(texts[9].split()[:60])])
    whole = index.hits(texts)
    monkeypatch.setattr(decontaminate, "PLACES", 5)
    assert index.hits(texts) == whole and 0 in [f[0] for f in whole[3]] and 1 in [f[0] for f in whole[9]]


def test_short_items_are_found_as_they_are(spark):
    items = ["what is two plus two", "yes", "a b", "one two three four five", "a", " ?! ", None]
    texts = ["so: What is two plus two? yes!", "what is two plus three", "yes " * 400 + "x " * 300_000 + "a b", "one two three four five six", "one two three four", None, "", "b a"]
    bench = spark.createDataFrame([(i, t, "x") for i, t in enumerate(items)], "item_id long, text string, doc_id string")
    rows = [(i, t, 1) for i, t in enumerate(texts)]
    docs = spark.createDataFrame([*rows, rows[3], (None, "yes", 1)], "doc_id long, text string, item_id long")
    got = sorted((r.doc_id if r.doc_id is not None else -1, r.item_id, r.distance) for r in decontaminate.contaminations(docs, bench).collect())
    assert got == [(-1, 1, 0), (0, 0, 0), (0, 1, 0), (2, 1, 0), (2, 2, 0), (2, 4, 0), (3, 3, 0), (3, 3, 0), (7, 4, 0)]
    assert sorted(r.doc_id for r in decontaminate.drop_contaminated(docs, bench).collect()) == [1, 4, 5, 6]
