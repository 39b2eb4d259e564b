"""Classifiers on held-out rows, and what they do without text, labels or rows."""

import math
import random
import re

import pytest
import zstandard
from compare import DATA

from chronoloom.llm import quality, toxicity
from chronoloom.llm.labelled import sample


@pytest.fixture(scope="session")
def tables(spark):
    d = f"{DATA}/sf0.1"
    return spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")


def rates(scored, labels, column):
    got = scored.join(labels, "doc_id").filter("held_out").select("predicted", column).collect()
    yes, no = [r.predicted for r in got if r[1] == 1], [r.predicted for r in got if r[1] == 0]
    assert len(yes) > 50 and len(no) > 50
    return sum(yes) / len(yes), sum(no) / len(no)


def test_toxicity_on_held_out_rows(tables):
    docs, labels = tables
    caught, false = rates(toxicity.toxicity_scores(docs, labels), labels, "toxic")
    assert caught >= 0.9 and false < 0.02


def test_quality_on_held_out_rows(tables):
    docs, labels = tables
    good, bad = rates(quality.quality_scores(docs, labels), labels, "quality")
    assert good > 0.95 and bad < 0.1


def test_unseen_misspellings_share_n_grams():
    rng = random.Random(0)
    plain = ["".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(300)]
    stems = ["kwrtzy", "qupzzo"]
    text = lambda bad: " ".join(rng.choice(plain) if rng.random() < 0.9 or not bad else rng.choice(stems) + rng.choice(["s", "en", "ing", ""]) for _ in range(60))
    labels = [i % 2 for i in range(400)]
    model = toxicity.Model().fit([text(y) for y in labels], labels)
    clean = " ".join(rng.choice(plain) for _ in range(400))
    assert model.scores([clean])[0] < 0.3 < 0.5 < model.scores([clean + " kwrtzyness " + clean])[0]


@pytest.mark.parametrize("module, score", [(toxicity, toxicity.toxicity_scores), (quality, quality.quality_scores)])
def test_awkward_rows(spark, docs, module, score):
    labels = spark.createDataFrame([(1, 1, 0), (4, 0, 1), (7, None, None), (22, 1, 0), (25, 0, 1), (28, 1, 1), (31, 0, 0), (None, 1, 1), (22, 1, 0)], "doc_id long, quality int, toxic int")
    for use in (labels, labels.limit(0), labels.filter("quality = 1 and toxic = 0")):
        got = score(docs, use).collect()
        assert len(got) == docs.count() and all(0 <= r.score <= 1 and r.predicted in (0, 1) for r in got)
    assert score(docs.limit(0), labels).count() == 0


AWKWARD = [None, "", " ", "?!", "a", "Ünïcode wörds 漢字 🙂", "one two " * 3, "x" * 5000, "word " * 300_000, "tab\tand\nline, 12345 b_c"]


def plain_toxicity(model, text):
    """The score from its definition: n-gram by n-gram, word by word."""
    mask = (1 << 32) - 1
    shift = 32 - (len(model.value) - 1).bit_length()
    words = {}

    def word_value(w):
        marked = [32, *(48 if c < 58 else c for c in w), 32]
        total = 0
        n = 0
        for at in range(len(marked)):
            for size in (3, 4, 5, 6):
                if at + size <= len(marked):
                    h = sum(c * ((0x9E3779B1 * (2 * k + 1) * (k + 3) | 1) & mask) for k, c in enumerate(marked[at : at + size])) & mask
                    k = size - 1
                    h = (h ^ h >> 15) * (0x85EBCA6B + 2 * k) & mask
                    h = (h ^ h >> 13) * 0xC2B2AE35 & mask
                    total += float(model.value[h >> shift])
                    n += 1
        return total / n

    found = re.findall(rb"[0-9a-z_\x80-\xff]+", (text or "").lower().encode())
    values = sorted((words.setdefault(w, None) or words.update({w: word_value(w)}) or words[w] for w in found), reverse=True)
    x = [values[0], sum(values[:2]) / 2, sum(values) / len(values), math.log(len(values))] if values else [0.0] * 4
    z = sum(a * b for a, b in zip(x, model.calibration)) + model.calibration[-1]
    return 1 / (1 + math.exp(-max(-30, min(30, z))))


def test_toxicity_by_its_definition(tables):
    docs, labels = tables
    model = toxicity.fit(docs, labels, rows=150)
    texts = [r.text for r in docs.limit(40).collect()] + AWKWARD
    got = model.scores(texts)
    model = toxicity.Model.unpack(model.pack())
    assert got == pytest.approx([plain_toxicity(model, t) for t in texts], abs=1e-5)


def test_quality_by_its_definition(spark, tables):
    docs, labels = tables
    model = quality.fit(docs, labels, rows=150)

    def plain(text):
        data = (text or "").encode()
        blocks = [data[i : i + 1024] for i in range(0, len(data), 1024)] or [b""]
        bad, good = (sum(len(zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(d), level=3, write_content_size=False, write_checksum=False, write_dict_id=False).compress(b)) for b in blocks) for d in model.dictionaries)
        d, size, n = (bad - good) / (bad + good), (bad + good) / 2 / (max(len(data), 1) + 16), max(len(data), 1)
        z = sum(a * b for a, b in zip([10 * d, size, 10 * d * size, size**2, 20 * d**2, math.log(n), 1], model.weights))
        return 1 / (1 + math.exp(-max(-30, min(30, z))))

    texts = [r.text for r in docs.limit(40).collect()] + [t for t in AWKWARD if not t or len(t) < 100_000] + ["word " * 40_000]
    assert [model.score(t) for t in texts] == pytest.approx([plain(t) for t in texts], abs=1e-9)


def test_contradicting_labels_and_repeated_ids(spark):
    docs = spark.createDataFrame([(i, f"text {i} {k}", "x") for i in range(40) for k in (1, 0)], "doc_id long, text string, quality string")
    labels = spark.createDataFrame([(i, i % 2, "n") for i in range(40)] + [(i, 1 - i % 2, "n") for i in range(0, 40, 4)], "doc_id long, toxic int, text string")
    texts, y, _ = sample(docs, labels, "toxic", 40, 4096)
    ids = [int(t.split()[1]) for t in texts]
    assert all(i % 4 and t.endswith(" 0") and v == i % 2 for i, t, v in zip(ids, texts, y)) and len(set(ids)) == len(ids) > 15


def test_labels_decide_nothing_but_the_fit(spark, tables):
    docs, labels = tables
    texts, y, share = sample(docs, labels, "toxic", 30, 4096)
    assert sum(y) <= 30 and len(y) - sum(y) <= 30 and 0 < share < 1 and all(len(t.encode()) <= 4096 for t in texts)
    some = docs.limit(200)
    model = toxicity.fit(docs, labels, rows=100)
    changed = some.selectExpr("doc_id + 5 as doc_id", "text", "'xx' as lang", "'yy' as source", "n_chars")
    a = sorted(r.score for r in toxicity.score_column(some, model).collect())
    assert a == sorted(r.score for r in toxicity.score_column(changed, model).collect())
