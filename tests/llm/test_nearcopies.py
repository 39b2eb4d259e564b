"""Near copies by five-word shingles against brute force."""

import random

import pytest

import corpus_pipeline
from chronoloom.llm import nearcopies, simhash, suffix


def grams(text):
    w = (text or "").lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def alike(a, b):
    a, b = grams(a), grams(b)
    return len(a & b) >= 0.8 * len(a | b)


@pytest.fixture(scope="module")
def edited():
    """Texts with copies in which a few words differ, in runs of similar texts that link at their ends only."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    out = [None, "", "  ", "one two", "one two", "One two three"]
    for _ in range(60):
        words = [word() for _ in range(rng.choice((60, 120, 300)))]
        out.append(" ".join(words))
        for _ in range(rng.randint(0, 4)):
            for _ in range(rng.randint(1, max(1, len(words) // 45))):
                words[rng.randrange(len(words))] = word()
            out.append(" ".join(words))
    return out


def brute(texts):
    label = list(range(len(texts)))
    pairs = [(i, j) for i in range(len(texts)) for j in range(i) if alike(texts[i], texts[j])]
    for _ in texts:
        for i, j in pairs:
            label[i] = label[j] = min(label[i], label[j])
    return label


@pytest.mark.parametrize("crowd, few, block", [(64, 32, 1024), (1, 32, 1024), (64, 1, 1024), (64, 1, 2)])
def test_components_are_those_of_brute_force(spark, edited, crowd, few, block, monkeypatch):
    monkeypatch.setattr(nearcopies, "CROWD", crowd)
    monkeypatch.setattr(nearcopies, "FEW", few)
    monkeypatch.setattr(nearcopies, "BLOCK", block)
    want = brute(edited)
    assert len(set(want)) < 0.7 * len(edited)
    df = spark.createDataFrame(list(enumerate(edited)), "row long, t string").repartition(4)
    got = dict(map(tuple, nearcopies.near_copy_components(df).collect()))
    assert [got[i] for i in range(len(edited))] == want


def test_stage_drops_near_copies(spark, edited):
    df = spark.createDataFrame([(i, t, "s") for i, t in enumerate(edited)], "doc_id long, text string, lang string")
    kept = corpus_pipeline.near_duplicates_out(spark, df, "")
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(brute(edited)))
    assert corpus_pipeline.near_duplicates_out(spark, df.limit(0), "").count() == 0


TEXTS = [" ".join(f"{a}{i}" for i in range(40)) for a in "abcd"]


@pytest.mark.parametrize("first", ["stage", "operator"])
def test_rows_without_an_id_and_rows_of_one_id(spark, first):
    pick = simhash.first_of_components if first == "operator" else lambda df: corpus_pipeline.near_duplicates_out(spark, df, "")
    rows = [(None, TEXTS[0]), (None, TEXTS[1]), (None, TEXTS[2]), (5, TEXTS[2]), (7, TEXTS[2]), (7, TEXTS[3])]
    kept = [tuple(r) for r in pick(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    assert sorted(kept, key=str) == sorted([rows[0], rows[1], rows[3], rows[5]], key=str)


def test_spans_are_cut_from_their_own_row(spark):
    long = [" ".join(f"{a}{i}" for i in range(120)) for a in "abcdef"]
    rows = [(None, long[0] + long[1]), (None, long[2]), (3, long[1] + long[3]), (3, long[4]), (3, long[5])]
    out = suffix.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"))
    got = {tuple(r) for r in out.collect()}
    assert {rows[1], rows[3], rows[4]} <= got and (None, long[0]) in got and (3, long[3]) in got
