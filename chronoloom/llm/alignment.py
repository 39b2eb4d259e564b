"""Alignment of two tokenizers' tokens over a corpus, scored by inverted bitmaps of token pairs.

Each text is encoded twice and cut where tokens of both end together. A task
deals its documents into blocks of at most 8192 and writes, for each pair of ids
linked in a block, the bitmap of the block's documents that hold it, and planes
of bits for how often more than once: plane k has the documents in whose further
links bit k is set. Bitmaps of few documents are lists of two-byte positions.
A pair's document count is the popcount of its bitmaps, its link count that plus
2**k times that of plane k. Scores go back by the same postings: joined by pair,
dealt by block, added up at the positions that the bitmaps name. A posting is a
pair in a block, so a hot pair has no more of them than there are blocks, and no
block more than its bound of links.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from chronoloom.llm.batches import parts
from chronoloom.llm.bpe import split
from chronoloom.llm.pieces import Pieces, model_bytes
from chronoloom.sources.shared import materialize

#: Documents and links of a block (a text longer than that is a block of its own); bytes of a full bitmap, which as many positions would take.
BLOCK_DOCS, BLOCK_LINKS = 1 << 13, 1 << 21
FULL = BLOCK_DOCS // 8
#: A pair is A's id, shifted, and B's id; a plane of documents, not of further links.
SHIFT = 20
PRESENT = -1
#: White space that the regular expressions of the byte-level library may not get through.
LONG_BLANK = re.compile(r"\s{4096}")

#: Columns of a document, of what blocks hold, and of the result.
_DOC = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
_BLOCKS = f"block long, slot int, {_DOC}, pair long, plane int, bits binary"
_OUT = f"{_DOC}, n_best long, count_sum long"


_PLAIN = [*range(33, 127), *range(161, 173), *range(174, 256)]
#: Byte-level vocabularies write printable Latin-1 bytes as themselves, the other bytes as the characters from U+0100 on.
_BYTE_OF = {chr(b): b for b in _PLAIN} | {chr(256 + i): b for i, b in enumerate(sorted(set(range(256)) - set(_PLAIN)))}


class Aligner:
    """Both tokenizers, made once a worker from their files."""

    def __init__(self, a: bytes, b: bytes, pattern: str):
        model = json.loads(a)["model"]
        special = {t["content"] for t in json.loads(a).get("added_tokens", [])}
        ranks = {bytes([_BYTE_OF[c] for c in t]): i for t, i in model["vocab"].items() if t not in special}
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        order = [model["vocab"][x + y] for x, y in merges]
        if order != sorted(order) or len(order) + 256 != len(ranks):
            raise ValueError("ids must follow the order of merges")
        self.a = tiktoken.Encoding("a", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b)
        pieces = Pieces(b)
        spelt = {i: t for t, i in ranks.items()}
        self.a_bytes = [spelt.get(i, b"") for i in range(max(spelt) + 1)]
        self.b_bytes = pieces.bytes
        self.sizes = [np.array([len(x) for x in t], dtype=np.int64) for t in (self.a_bytes, self.b_bytes)]
        #: Decimals with what may follow them: A's within and at the end of a group, then B's.
        n, m = len(self.a_bytes), len(self.b_bytes)
        self.decimals = [*(b"%d," % i for i in range(n)), *(b"%d|" % i for i in range(n)), *(b"%d," % i for i in range(m)), *(b"%d;" % i for i in range(m))]

    def encode_a(self, text: str) -> list[int]:
        if len(text) >= 4096 and LONG_BLANK.search(text):
            return [i for piece in split(text) for i in self.a._encode_single_piece(piece)]
        return self.a.encode_ordinary(text)

    def align(self, text: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray] | None:
        """Ids of A and B, and where in each a group ends; None if there are no tokens to align."""
        if not text:
            return None
        spaced = " " + text
        ids = self.encode_a(spaced), self.b.encode(text)
        whole = spaced.encode("utf-8", "surrogatepass")
        for table, found in zip((self.a_bytes, self.b_bytes), ids):
            if b"".join([table[i] for i in found]) != whole:
                return None
        a, b = (np.array(found, dtype=np.int64) for found in ids)
        ends_a, ends_b = np.cumsum(self.sizes[0][a]), np.cumsum(self.sizes[1][b])
        ends = np.zeros(len(whole) + 1, dtype=np.int8)
        ends[ends_a] = 1
        ends[ends_b] += 1
        return a, b, np.flatnonzero(ends[ends_a] == 2), np.flatnonzero(ends[ends_b] == 2)

    def groups(self, a: np.ndarray, b: np.ndarray, last_a: np.ndarray, last_b: np.ndarray) -> bytes:
        """``a1,a2|b1;a3|b2,b3``: ids of the groups."""
        # A token moves behind all tokens of the other kind in groups before its own (B's: in its own too).
        group_a = np.searchsorted(last_a, np.arange(len(a)))
        group_b = np.searchsorted(last_b, np.arange(len(b)))
        out = np.empty(len(a) + len(b), dtype=np.int64)
        before_b, upto_a = np.concatenate(([0], last_b + 1)), last_a + 1
        n, m = len(self.a_bytes), len(self.b_bytes)
        x, y = a.copy(), b + 2 * n
        x[last_a] += n
        y[last_b] += m
        out[np.arange(len(a)) + before_b[group_a]] = x
        out[np.arange(len(b)) + upto_a[group_b]] = y
        table = self.decimals
        return b"".join([table[i] for i in out.tolist()])[:-1]


_made: dict[int, Aligner] = {}


def _aligner(handle) -> Aligner:
    key = getattr(handle, "id", id(handle))
    if key not in _made:
        _made.clear()
        _made[key] = Aligner(*handle.value)
    return _made[key]


def _bitmaps(keys: np.ndarray) -> Iterator[tuple[np.ndarray, pa.Array]]:
    """Pairs and the bitmap of each one's slots, from keys (pair, slot) in order: lists of positions, then full bitmaps."""
    pair, slot = keys >> 13, keys & (BLOCK_DOCS - 1)
    begin = np.flatnonzero(np.concatenate(([True], pair[1:] != pair[:-1])))
    size = np.diff(np.append(begin, len(keys)))
    few = size < FULL // 2
    listed = slot[np.repeat(few, size)].astype("<u2")
    ends = np.concatenate(([0], np.cumsum(size[few] * 2))).astype(np.int32)
    yield pair[begin[few]], pa.Array.from_buffers(pa.binary(), int(few.sum()), [None, pa.py_buffer(ends), pa.py_buffer(listed)])
    full = []
    for at in np.flatnonzero(~few):
        bits = np.zeros(BLOCK_DOCS, dtype=np.uint8)
        bits[slot[begin[at] : begin[at] + size[at]]] = 1
        full.append(np.packbits(bits, bitorder="little").tobytes())
    yield pair[begin[~few]], pa.array(full, pa.binary())


def postings(keys: np.ndarray, count: np.ndarray) -> Iterator[tuple[np.ndarray, int, pa.Array]]:
    """A block's pairs, plane and bitmaps, from keys (pair, slot), in order and each once, and how often each is linked."""
    more = count - 1
    for plane in range(PRESENT, int(more.max(initial=0)).bit_length()):
        chosen = keys if plane == PRESENT else keys[(more >> plane & 1) > 0]
        if len(chosen):
            for pairs, bits in _bitmaps(chosen):
                if len(pairs):
                    yield pairs, plane, bits


def positions(bitmap: bytes) -> np.ndarray:
    """Slots of a bitmap."""
    if len(bitmap) == FULL:
        return np.flatnonzero(np.unpackbits(np.frombuffer(bitmap, dtype=np.uint8), bitorder="little"))
    return np.frombuffer(bitmap, dtype="<u2").astype(np.int64)


def popcount(bits: Column) -> Column:
    """Documents in a bitmap."""
    return F.when(F.octet_length(bits) == FULL, F.bitmap_count(bits)).otherwise((F.octet_length(bits) / 2).cast("long"))


class _Block:
    """The documents and links of one block: links of each batch as keys with counts, merged when the block is full."""

    def __init__(self, number: int):
        self.number, self.rows, self.keys, self.counts, self.links = number, [], [], [], 0

    def add(self, row: tuple, pairs: np.ndarray) -> None:
        keys, counts = np.unique(pairs << 13 | len(self.rows), return_counts=True)
        self.rows.append((self.number, len(self.rows), *row))
        self.keys.append(keys)
        self.counts.append(counts)
        self.links += len(pairs)

    def full(self) -> bool:
        return len(self.rows) >= BLOCK_DOCS or self.links >= BLOCK_LINKS

    def batches(self, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        columns = [pa.array(c, f.type) for c, f in zip(zip(*self.rows), schema)]
        n = len(self.rows)
        yield pa.RecordBatch.from_arrays([*columns, *(pa.nulls(n, f.type) for f in list(schema)[len(columns) :])], schema=schema)
        keys, counts = np.concatenate(self.keys), np.concatenate(self.counts)
        order = np.argsort(keys)  # ORs the documents' bits into one bitmap a pair
        for pairs, plane, bits in postings(keys[order], counts[order]):
            n = len(pairs)
            head = [pa.array(np.full(n, self.number), pa.int64()), *(pa.nulls(n, f.type) for f in list(schema)[1:-3])]
            yield pa.RecordBatch.from_arrays([*head, pa.array(pairs, pa.int64()), pa.array(np.full(n, plane), pa.int32()), bits], schema=schema)


def _files(a_path: str | None, b_path: str | None, pattern: str | None) -> tuple[bytes, bytes, str]:
    import public_tokenizers

    with open(a_path or public_tokenizers.path("byte_bpe_50k.json"), "rb") as f:
        return f.read(), model_bytes(b_path), pattern or public_tokenizers.PATTERN


def aligned_blocks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", a_path: str | None = None, b_path: str | None = None, pattern: str | None = None) -> DataFrame:
    """The documents' rows (``pair`` null) and the postings of their blocks, written to the shared folder.

    Blocks' numbers are right for the table as written: a task that is run again
    gives its blocks anew, and only one attempt's are kept.
    """
    handle = docs.sparkSession.sparkContext.broadcast(_files(a_path, b_path, pattern))  # two vocabularies, of fixed size
    types = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}
    schema = pa.schema([(name, types[kind]) for name, kind in (f.split() for f in _BLOCKS.split(", "))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, first = _aligner(handle), TaskContext.get().partitionId() << 32
        block = _Block(first)
        for b in parts(batches):
            for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                found = aligner.align(text)
                if found is None:
                    block.add((doc, 0, 0, 0, 0, ""), np.zeros(0, dtype=np.int64))
                else:
                    ids_a, ids_b, last_a, last_b = found
                    row = doc, len(ids_a), len(ids_b), len(last_a), len(last_a), hashlib.sha256(aligner.groups(*found)).hexdigest()
                    block.add(row, ids_a[last_a] << SHIFT | ids_b[last_b])
                if block.full():
                    yield from block.batches(schema)
                    first += 1
                    block = _Block(first)
        if block.rows:
            yield from block.batches(schema)

    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("t"))
    return materialize(picked.mapInArrow(run, _BLOCKS), "aligned")


def pair_counts(blocks: DataFrame) -> DataFrame:
    """``(pair, n_docs, n_links, best)``: documents and links of each pair; best: its links are its B id's most (ties included)."""
    n = popcount(F.col("bits"))
    weight = F.when(F.col("plane") == PRESENT, F.lit(1).cast("long")).otherwise(F.expr("shiftleft(1L, plane)"))
    counts = blocks.filter("pair is not null").groupBy("pair").agg(F.sum(F.when(F.col("plane") == PRESENT, n).otherwise(F.lit(0))).alias("n_docs"), F.sum(n * weight).alias("n_links"))
    counts = materialize(counts, "pairs")
    b = F.expr(f"pair & {(1 << SHIFT) - 1}")
    most = counts.groupBy(b.alias("b")).agg(F.max("n_links").alias("most"))  # a row a B id: not more than its vocabulary has
    return counts.join(F.broadcast(most), b == F.col("b")).select("pair", "n_docs", "n_links", (F.col("n_links") == F.col("most")).alias("best"))


def pair_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", a_path: str | None = None, b_path: str | None = None) -> DataFrame:
    """``(a, b, n_docs, n_links, best)``: each pair of A's and B's ids that is linked, its documents and its links in the corpus."""
    counts = pair_counts(aligned_blocks(docs, id_col, text_col, a_path, b_path))
    return counts.select(F.expr(f"pair >> {SHIFT}").alias("a"), F.expr(f"pair & {(1 << SHIFT) - 1}").alias("b"), "n_docs", "n_links", "best")


def _scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds up the scores of a block's postings, which come before its documents, and gives them to the documents."""
    block, sums, best = None, None, None
    for b in parts(batches, 1 << 14):
        numbers = b.column("block").to_numpy(zero_copy_only=False)
        cuts = np.flatnonzero(np.diff(numbers)) + 1
        for at, end in zip([0, *cuts.tolist()], [*cuts.tolist(), b.num_rows]):
            run = b.slice(at, end - at)
            if block is None or numbers[at] != block:
                block, sums, best = numbers[at], np.zeros(BLOCK_DOCS, dtype=np.int64), np.zeros(BLOCK_DOCS, dtype=np.int64)
            of_docs = run.column("pair").is_null().to_numpy(zero_copy_only=False)
            n_postings = int((~of_docs).sum())
            if n_postings:
                part = run.slice(0, n_postings)
                slots = [positions(x) for x in part.column("bits").to_pylist()]
                each = np.array([len(x) for x in slots])
                where = np.concatenate(slots)
                weight = np.left_shift(1, np.maximum(part.column("plane").to_numpy(zero_copy_only=False), 0).astype(np.int64))
                np.add.at(sums, where, np.repeat(weight * part.column("score").to_numpy(zero_copy_only=False).astype(np.int64), each))
                np.add.at(best, where, np.repeat(weight * part.column("best").to_numpy(zero_copy_only=False).astype(np.int64), each))
            if n_postings < run.num_rows:
                rows = run.slice(n_postings)
                slot = rows.column("slot").to_numpy(zero_copy_only=False).astype(np.int64)
                out = [rows.column(f.split()[0]) for f in _DOC.split(", ")] + [pa.array(best[slot], pa.int64()), pa.array(sums[slot], pa.int64())]
                yield pa.RecordBatch.from_arrays(out, names=[f.split()[0] for f in _OUT.split(", ")])


def alignment_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", a_path: str | None = None, b_path: str | None = None, pattern: str | None = None) -> DataFrame:
    """``(doc_id, n_a, n_b, n_groups, n_links, groups_sha256, n_best, count_sum)``, one row a document.

    A (a byte-level BPE file) encodes a space and the text, B (a merge-type piece
    model, which puts the space itself) the text, both without special tokens.
    Where tokens of both end at one byte, a group ends and its last two tokens are
    linked. count_sum adds up the corpus-wide link counts of a text's links,
    n_best counts the links whose count is their B id's highest. Texts that are
    null, empty or not what both tokenizers' tokens spell (those with U+2581, say)
    have zeros and no digest. Repeated rows count each, ids may be null or shared;
    an empty table gives an empty result; other columns are ignored.
    """
    blocks = aligned_blocks(docs, id_col, text_col, a_path, b_path, pattern)
    counts = pair_counts(blocks).select("pair", F.col("n_links").alias("score"), "best")
    held = blocks.filter("pair is not null").select("block", "pair", "plane", "bits").join(counts, "pair")
    rows = held.unionByName(blocks.filter("pair is null"), allowMissingColumns=True)
    dealt = rows.repartition("block").sortWithinPartitions("block", F.col("pair").isNull())
    return dealt.mapInArrow(_scored, _OUT)
