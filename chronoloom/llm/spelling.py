"""Spelling variants of a corpus' words by asymmetric chunks and grams.

Of two words one edit apart, the shorter (or equal) one is cut into two
disjoint chunks, its halves; the other gives the grams of that length. The edit
lies in one half, so the other half is a gram of the other word, shifted by at
most one: by nothing if the edit comes after it, by the difference in length if
it comes before. A half alone is three letters of a word of seven and selects
too little, so a key also takes a chunk of the half with the edit, of which the
same holds: that half has two chunks, and the edit leaves one of them at a shift
that is known too. The words of a key are verified by their edit distance within
the join, so that only links leave it.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from chronoloom.llm.batches import parts
from chronoloom.sources.shared import drop_shared, materialize

#: Distinct words that a task counts before it hands them on.
HELD = 1 << 18
#: A form has ten times its word's occurrences at least and counts are below 10**19, so no chain has more forms.
LONGEST_CHAIN = 18


def count_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 7, slip: int = 31, least_count: int = 2) -> DataFrame:
    """``(word, n)``: words of at least ``least`` code points that occur at least ``least_count`` times.

    A run of ``[A-Za-z\\u00C0-\\u00FF]``, A-Z lower-cased, is a word; where
    ``slip`` divides the CRC-32 h of ``<doc_id>:<run>``, it loses the code point
    at h modulo its length first (slip None: never). A null id reads as nothing
    before the colon. Each task counts its own words before any shuffle.
    """
    find = re.compile(f"[a-zÀ-ÿ]{{{least},}}").findall

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()
        for b in parts(batches):
            for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if not text:
                    continue
                runs = Counter(find(text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")))
                if slip:
                    before = crc32(f"{'' if doc is None else doc}:".encode())
                    for word, n in [*runs.items()]:
                        h = crc32(word.encode(), before)
                        if not h % slip:
                            del runs[word]
                            at = h % len(word)
                            if len(word) > least:
                                held[word[:at] + word[at + 1 :]] += n
                held.update(runs)
            if len(held) > HELD:
                yield counted(held)
                held.clear()
        yield counted(held)

    def counted(held: Counter[str]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], names=["word", "n"])

    found = docs.select(F.col(id_col).cast("string").alias("d"), F.col(text_col).alias("t")).mapInArrow(run, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_count)


def _keys(shift: int) -> Column:
    """Keys under which a word looks for words that are ``shift`` shorter (their own keys: shift 0).

    Halves and their chunks are those of the shorter word: the first half [0, h)
    of chunks [0, a) and [a, h), the second of [h, h + c) and the rest. The edit
    may lie in the last chunk, in the one before it, in the second and in the first.
    """
    cut = f"length(word) - {shift}"
    h = f"(({cut}) div 2)"
    a, c = f"({h} div 2)", f"((({cut}) - {h}) div 2)"
    rest = lambda at: f"substr(word, cast({at} + {shift + 1} as int))"
    first = lambda size: f"left(word, cast({size} as int))"
    kinds = [f"xxhash64(1, {cut}, {first(f'{h} + {c}')})", f"xxhash64(2, {cut}, {first(h)}, {rest(f'{h} + {c}')})", f"xxhash64(3, {cut}, {first(a)}, {rest(h)})", f"xxhash64(4, {cut}, {rest(a)})"]
    return F.expr(f"array({', '.join(kinds)})")


def near_pairs(words: DataFrame) -> DataFrame:
    """``(word, n, near, near_n)``: each ordered pair of ``words`` (distinct, at least four code points) that one inserted, deleted or replaced code point parts."""
    own = words.select("word", "n", F.explode(_keys(0)).alias("key"))
    looking = own.select(F.col("word").alias("near"), F.col("n").alias("near_n"), "key", F.lit(0).alias("shift")).union(
        words.select(F.col("word").alias("near"), F.col("n").alias("near_n"), F.explode(_keys(1)).alias("key"), F.lit(1).alias("shift"))
    )
    meet = (F.expr("shift = 1 or word < near")) & (F.levenshtein("word", "near", 1) == 1)
    found = own.withColumnRenamed("key", "own_key").join(looking, (F.col("own_key") == F.col("key")) & meet)
    both = F.explode(F.array(F.struct("word", "n", "near", "near_n"), F.struct(F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("near"), F.col("n").alias("near_n"))))
    return found.select(both.alias("p")).select("p.*").repartition("word").dropDuplicates(["word", "near"])


def _roots(forms: DataFrame) -> DataFrame:
    """``(word, root)`` for the words with a form: forms followed to their last, twice as far in each round."""
    at = materialize(forms.select("word", F.col("form").alias("root")), "roots")
    reach = 1
    while True:
        onward = at.select(F.col("word").alias("root"), F.col("root").alias("further"))
        if reach > LONGEST_CHAIN or at.join(onward, "root", "left_semi").isEmpty():
            return at
        new = materialize(at.join(onward, "root", "left").select("word", F.coalesce("further", "root").alias("root")), "roots")
        drop_shared(at)
        at, reach = new, reach * 2


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 7, slip: int | None = 31, least_count: int = 2, ratio: int = 10) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)``, one row a word of ``count_words``.

    n_near counts the words one edit away. ``form`` is the one of them with the
    most occurrences (form_n; of equal ones the smallest in code-point order) if
    it has ``ratio`` (10 or more) times the word's, else null, and ``root`` is
    where forms of forms end (the word itself without a form). Null and empty
    texts have no words; repeated rows count each; an empty table gives an empty
    result; other columns are ignored; a text or word may have any length.
    """
    if least < 4 or ratio < 10:
        raise ValueError("words take four code points or more and a form ten times its word's occurrences")
    words = materialize(count_words(docs, id_col, text_col, least, slip, least_count), "words")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near"))).alias("best")
    near = near_pairs(words).groupBy("word").agg(F.first("n").alias("n"), F.count(F.lit(1)).alias("n_near"), best)
    formed = F.expr(f"-best.less >= {ratio} * n")
    near = materialize(near.select("word", "n_near", F.when(formed, F.col("best.near")).alias("form"), F.when(formed, -F.col("best.less")).alias("form_n")), "near")
    roots = _roots(near.filter("form is not null"))
    out = words.join(near, "word", "left").join(roots, "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), "form_n")
