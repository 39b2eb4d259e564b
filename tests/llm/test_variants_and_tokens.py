"""Spelling variants, merge-type pieces and aligned tokens against brute force and the libraries themselves."""

import hashlib
import random
import re
from collections import Counter, defaultdict
from zlib import crc32

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from chronoloom.llm import alignment, pieces, spelling


def one_edit(a: str, b: str) -> bool:
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    at = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[at + (len(a) == len(b)) :] == b[at + 1 :]


def plain_variants(rows, least=7, slip=31):
    n = Counter()
    for doc, text in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = "".join(c.lower() if c.isascii() else c for c in w)
            h = crc32(f"{'' if doc is None else doc}:{w}".encode())
            if h % slip == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            n[w] += len(w) >= least
    n = {w: k for w, k in n.items() if k >= 2}
    near = {w: [v for v in n if one_edit(w, v)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        if best is not None and n[best] >= 10 * n[w]:
            form[w] = best
    out = set()
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out.add((w, form.get(w), root, n[w], len(near[w]), n[form[w]] if w in form else None))
    return out


@pytest.fixture(scope="module")
def slips():
    """Words of few letters with slips of all kinds, chains of forms, long words, accents and capitals."""
    rng = random.Random(3)
    base = ["".join(rng.choice("abÀé") for _ in range(rng.choice([7, 7, 8, 9, 11, 16]))) for _ in range(40)] + ["Zwischenraumtexte", "wordsofpeople", "×÷×÷×÷×é"]

    def slip(w):
        i, kind = rng.randrange(len(w)), rng.randrange(3)
        return w[:i] + ("" if kind == 0 else rng.choice("abé")) + w[i + (kind < 2) :]

    rows = [(None, "wordsofpeople wordsofpeople"), (7, None), (8, ""), (9, "short 123 wordsofpeople_wordsofpeopleX"), (9, "short 123 wordsofpeople_wordsofpeopleX")]
    for doc in range(60):
        words = []
        for _ in range(120):
            w = base[min(int(rng.expovariate(0.2)), len(base) - 1)]
            while rng.random() < 0.15:
                w = slip(w)
            words.append(w)
        rows.append((doc, " ".join(words)))
    chain = ["abcdefghijk" + "z" * i for i in range(4)]
    rows.append((1001, " ".join(w for i, w in enumerate(chain) for _ in range(3 * 10**i))))
    return rows


def test_variants_equal_brute_force(spark, slips):
    docs = spark.createDataFrame([(d, t, "x", 1) for d, t in slips], "doc_id long, text string, word string, n long")
    got = {tuple(r) for r in spelling.spelling_variants(docs).collect()}
    want = plain_variants(slips)
    assert got == want
    assert sum(form is not None for _, form, *_ in got) > 20 and any(form is not None and form != root for _, form, root, *_ in got)


def test_every_edit_of_every_length_leaves_a_key(spark):
    rng = random.Random(5)
    words = {"".join(rng.choice("abcdefgh") for _ in range(n)) for n in range(4, 30)} | {"x" * 3000}
    for w in [*words]:
        words |= {w[:i] + w[i + 1 :] for i in range(min(len(w), 40)) if len(w) > 4} | {w[:i] + "éu"[i % 2] + w[i + 1 :] for i in range(0, min(len(w), 40), 2)} | {w[:i] + "ß" + w[i:] for i in range(min(len(w), 40) + 1)}
    got = {(r.word, r.near) for r in spelling.near_pairs(spark.createDataFrame([(w, 2) for w in words], "word string, n long")).select("word", "near").collect()}
    by = defaultdict(set)
    for w in words:  # neighbours by the deletions that two words share
        for i in range(len(w) if len(w) < 100 else 0):
            by[i, w[:i] + w[i + 1 :]].add(w)
    want = {(a, b) for g in by.values() for a in g for b in g if a != b} | {(a, b) for w in words if len(w) < 100 for i in range(len(w)) if w[:i] + w[i + 1 :] in words for a, b in ((w, w[:i] + w[i + 1 :]), (w[:i] + w[i + 1 :], w))}
    assert want <= got and all(one_edit(a, b) for a, b in got)
    assert {p for p in got if len(p[0]) < 100 and len(p[1]) < 100} == want


def test_no_words(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert spelling.spelling_variants(docs).count() == 0
    with pytest.raises(ValueError):
        spelling.spelling_variants(docs, least=3)


def odd_texts(seed, n):
    rng = random.Random(seed)
    alphabet = ["a", "th", "e", "tion", " ", "  ", "   ", " " * 17, "\n", "\t", "é", "▁", "語", "😀", "́", "</s>", "<0x0A>", "\x00", "1", "23", ".", "ing", "Zeit", "ß", "　", "'s"]
    return ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40))) for _ in range(n)]


@pytest.fixture(scope="module")
def processor():
    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def test_pieces_equal_the_library(processor):
    codec = pieces.PieceCodec(pieces.model_bytes(), max_parts=50)
    texts = odd_texts(1, 4000) + [" " * k for k in range(1, 80)] + ["a" + " " * k + "b" for k in range(1, 80)] + ["internationalization " * 300, "x" * 5000, "ab" * 4000, " " * 5000]
    for text, want in zip(texts, processor.encode(texts, add_eos=True)):
        ids, decimals = codec.encoded(text)
        assert ids.tolist() == want and decimals == " ".join(map(str, want)), repr(text[:80])
        assert codec.pieces.decode(want) == processor.decode(want), repr(text[:80])
    rng = random.Random(2)
    for _ in range(3000):
        ids = [rng.choice([rng.randrange(32000), rng.randrange(259), rng.randrange(180, 259), 28705]) for _ in range(rng.randint(0, 12))]
        assert codec.pieces.decode(ids) == processor.decode(ids), ids


def test_piece_documents(spark, docs, processor):
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = []
    for r in docs.collect():
        ids = processor.encode(r.text or "", add_eos=True)
        want.append((r.doc_id, len(ids), sha(" ".join(map(str, ids))), sha(processor.decode(ids))))
    key = lambda r: (r[0] is None, r[0] or 0)
    assert sorted(map(tuple, pieces.piece_digests(docs).collect()), key=key) == sorted(want, key=key)
    encoded = pieces.encode_documents(docs)
    texts = {r.doc_id: r.text for r in pieces.decode_documents(encoded).collect()}
    assert texts == {r.doc_id: r.text or "" for r in docs.collect()}
    assert pieces.piece_digests(docs.limit(0)).count() == 0
    with pytest.raises(Exception, match="outside the model"):
        pieces.decode_documents(spark.createDataFrame([(1, [40000])], "doc_id long, ids array<int>")).collect()


def plain_alignment(texts):
    """The contract word by word, with the vocabularies' own libraries."""
    a_tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a_tok.encode_special_tokens = True
    b_tok = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    signs = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in signs]
    byte = {chr(b): b for b in signs} | {chr(256 + i): b for i, b in enumerate(other)}

    def b_bytes(i):
        p = b_tok.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if b_tok.is_byte(i) else p.replace("▁", " ").encode()

    found = []
    for t in texts:
        a, b = (a_tok.encode(" " + t, add_special_tokens=False).ids, b_tok.encode(t)) if t else ([], [])
        x, y = [bytes(byte[c] for c in a_tok.id_to_token(i)) for i in a], [b_bytes(i) for i in b]
        if not t or b"".join(x) != (" " + t).encode() or b"".join(y) != (" " + t).encode():
            found.append(None)
            continue
        ends = [np.cumsum([len(z) for z in s]).tolist() for s in (x, y)]
        shared, groups, links = set(ends[0]) & set(ends[1]), [], []
        i = j = 0
        for end in sorted(shared):
            p, q = ends[0].index(end) + 1, ends[1].index(end) + 1
            groups.append(",".join(map(str, a[i:p])) + "|" + ",".join(map(str, b[j:q])))
            i, j = p, q
        links = [(a[p], b[q]) for p, e in enumerate(ends[0]) for q, f in enumerate(ends[1]) if e == f]
        found.append((len(a), len(b), ";".join(groups), links))
    count = Counter(link for f in found if f for link in f[3])
    most = Counter()
    for (_, b), n in count.items():
        most[b] = max(most[b], n)
    rows = [(0, 0, 0, 0, "", 0, 0) if f is None else (f[0], f[1], f[2].count(";") + 1, len(f[3]), hashlib.sha256(f[2].encode()).hexdigest(), sum(count[x] == most[x[1]] for x in f[3]), sum(count[x] for x in f[3])) for f in found]
    docs = Counter(link for f in found if f for link in set(f[3]))
    return rows, {(*p, docs[p], n, n == most[p[1]]) for p, n in count.items()}


def test_alignment_equals_the_contract(spark):
    texts = [None, "", "a▁b", "<|endoftext|> and </s>", "of the " * 700, " " * 30, "\n\n x"] + [t for t in odd_texts(9, 150) if len(t) < 150] + ["of the people"] * 40
    docs = spark.createDataFrame([(i if i % 9 else None, t, 5, "p") for i, t in enumerate(texts)], "doc_id long, text string, pair long, bits string").repartition(3)
    listed = docs.collect()
    rows, pairs = plain_alignment([r.text for r in listed])
    ids = [r.doc_id for r in listed]
    got = Counter(tuple(r) for r in alignment.alignment_scores(docs).collect())
    assert got == Counter((i, *r) for i, r in zip(ids, rows))
    assert {tuple(r) for r in alignment.pair_table(docs).collect()} == pairs
    assert alignment.alignment_scores(docs.limit(0)).count() == 0


def test_long_blanks_and_blocks(spark):
    texts = [" " * 20_000 + "x", "of " * 3] + ["and so on, and so on"] * 9000
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    blocks = alignment.aligned_blocks(docs)
    assert blocks.select("block").distinct().count() == 2
    got = {r.doc_id: r for r in alignment.alignment_scores(docs).collect()}
    assert len(got) == len(texts) and got[0].n_links > 0
    rows, _ = plain_alignment(texts[1:4])
    assert got[2].n_links == rows[1][3] and got[2].count_sum >= 9000 * got[2].n_links and got[2].groups_sha256 == got[9001].groups_sha256 == rows[1][4]


def test_bitmaps_of_any_size():
    rng = np.random.default_rng(4)
    for n in (1, 3, 511, 512, 513, 8192):
        slots = np.sort(rng.choice(8192, n, replace=False))
        count = rng.integers(1, 9, n)
        total = np.zeros(8192, dtype=np.int64)
        for pairs, plane, bits in alignment.postings(np.int64(5) << 13 | slots, count):
            assert pairs.tolist() == [5]
            np.add.at(total, alignment.positions(bits[0].as_py()), 1 if plane == alignment.PRESENT else 1 << plane)
        assert (total[slots] == count).all() and total.sum() == count.sum()
