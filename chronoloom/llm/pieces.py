"""SentencePiece models of merge type: encoding by a table of prefixes, and decoding.

A sequence of pieces is the encoding of its characters exactly if each piece is
its own encoding and each adjacent pair is compatible (merging the two's
characters gives the two back). So each prefix of a text has one last piece.
An automaton lists the pieces that end at each place; the one that is compatible
with the last piece of the prefix before it is stored, and the ids are recovered
from the end backwards. Merges never join what no piece holds side by side: a
text is cut where a space follows anything else and where letters end, and its
parts are remembered.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from struct import pack, unpack

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from chronoloom.llm.batches import parts
from chronoloom.llm.bpe import Vocabulary, _uncollected

#: The mark that stands for a space in pieces, what an unknown id decodes to, and numbers of the public model format.
SPACE = "▁"
UNKNOWN = " ⁇ "
MODEL_TYPE_MERGES = 2
NORMAL, UNKNOWN_PIECE, CONTROL, BYTE = 1, 2, 3, 6


def _fields(data: bytes) -> Iterator[tuple[int, object]]:
    """Field numbers and values of one message: whole numbers, four or eight bytes, or bytes of a length."""
    at = 0

    def number() -> int:
        nonlocal at
        out = shift = 0
        while True:
            byte = data[at]
            at += 1
            out |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return out

    while at < len(data):
        tag = number()
        kind = tag & 7
        if kind == 0:
            value = number()
        else:
            size = {1: 8, 5: 4}.get(kind) or number()
            value = data[at : at + size]
            at += size
        yield tag >> 3, value


class Pieces(Vocabulary):
    """Pieces of a model: ``tokens`` by id, ``ranks`` by piece (order of merges; equal scores share one)."""

    def __init__(self, data: bytes):
        listed, self.prefix, kind, rules = [], True, 1, {"charsmap": b"", "trim": True, "escape": True}
        for field, value in _fields(data):
            if field == 1:
                piece, score, what = "", 0.0, NORMAL
                for f, v in _fields(value):
                    piece, score, what = (v.decode(), score, what) if f == 1 else (piece, unpack("<f", v)[0], what) if f == 2 else (piece, score, v) if f == 3 else (piece, score, what)
                listed.append((piece, score, what))
            elif field == 2:
                kind = dict(_fields(value)).get(3, 1)
            elif field == 3:
                found = dict(_fields(value))
                rules = {"charsmap": found.get(2, b""), "trim": found.get(4, 1), "escape": found.get(5, 1)}
                self.prefix = bool(found.get(3, 1))
        kinds = {what for _, _, what in listed}
        if kind != MODEL_TYPE_MERGES or rules["charsmap"] or rules["trim"] or not rules["escape"] or not kinds <= {NORMAL, UNKNOWN_PIECE, CONTROL, BYTE}:
            raise ValueError("only models of merges without normalisation rules, own symbols and unused pieces are read")
        order = {s: i for i, s in enumerate(sorted({s for _, s, what in listed if what == NORMAL}, reverse=True))}
        self.ranks = {p: order[s] for p, s, what in listed if what == NORMAL}
        self.tokens = {i: p for i, (p, _, what) in enumerate(listed) if what == NORMAL}
        self.kinds = [what for _, _, what in listed]
        self._pairs, self._edges = {}, {}
        self.size = len(listed)
        self.end_id = next(i for i, (p, _, what) in enumerate(listed) if p == "</s>" and what == CONTROL)
        self.unknown_id = next((i for i, what in enumerate(self.kinds) if what == UNKNOWN_PIECE), 0)
        self.byte_ids = {int(p[3:5], 16): i for i, (p, _, what) in enumerate(listed) if what == BYTE}
        #: Bytes that each id stands for; control ids for none.
        self.bytes = [p.replace(SPACE, " ").encode() if what == NORMAL else bytes([int(p[3:5], 16)]) if what == BYTE else UNKNOWN.encode() if what == UNKNOWN_PIECE else b"" for p, _, what in listed]
        self.automaton = ahocorasick.Automaton()
        for i, p in self.tokens.items():
            if self._own(p):
                self.automaton.add_word(p, (i, len(p)))
        self.automaton.make_automaton()
        chars = set().union(*self.tokens.values())
        if any(SPACE in p.lstrip(SPACE) for p in self.tokens.values()) or not chars <= self.ranks.keys():
            raise ValueError("pieces must hold spaces at their beginning only, and each character must be a piece")
        apart = "".join(c for c in "\n\r\t" if c not in chars)
        kin = "".join(map(re.escape, sorted(self._kin("e"))))
        #: Parts that no merge crosses: letters that pieces hold side by side, or anything else, with the spaces before them, and single characters that no piece holds.
        self.parts = re.compile(f"{SPACE}*[{kin}]+|{SPACE}*[^{SPACE}{kin}{apart}]+|{SPACE}+" + (f"|[{apart}]" if apart else "")).findall

    def _kin(self, char: str) -> set[str]:
        """Characters that pieces hold beside ``char``, beside those, and so on; the mark of spaces doesn't count."""
        beside: dict[str, set[str]] = {}
        for p in self.tokens.values():
            for x, y in zip(p, p[1:]):
                if x != SPACE:
                    beside.setdefault(x, set()).add(y)
                    beside.setdefault(y, set()).add(x)
        found, new = {char}, {char}
        while new:
            new = set().union(*(beside.get(c, ()) for c in new)) - found
            found |= new
        return found

    def _own(self, piece: str) -> bool:
        """Whether the merges of a piece's characters end in the piece."""
        at, get = list(piece), self.ranks.get
        while len(at) > 1:
            best = min(range(len(at) - 1), key=lambda i: get(at[i] + at[i + 1], 1 << 60))
            if get(at[best] + at[best + 1]) is None:
                return False
            at[best : best + 2] = [at[best] + at[best + 1]]
        return True

    def encode_part(self, part: str) -> list[int]:
        """Ids of a part: the last piece of each prefix (-1: a character without a piece), then backwards from the end."""
        last, pairs = [-1] * (len(part) + 1), self._pairs
        for end, (token, size) in self.automaton.iter(part):
            end += 1
            if last[end] < 0:
                left = last[end - size]
                if left >= 0:
                    fits = pairs.get(left << 32 | token)
                    if not (self.compatible(left, token) if fits is None else fits):
                        continue
                last[end] = token
        out, at, lengths = [], len(part), self.tokens
        while at:
            token = last[at]
            if token >= 0:
                out.append(token)
                at -= len(lengths[token])
            else:
                at -= 1
                data = part[at].encode("utf-8", "surrogatepass")
                out.extend([self.byte_ids[x] for x in data[::-1]] if self.byte_ids else [self.unknown_id])
        return out[::-1]

    def marked(self, text: str) -> str:
        """The text as the pieces spell it: spaces marked, one before it."""
        return ((SPACE if self.prefix else "") + text.replace(" ", SPACE)) if text else ""

    def decode(self, ids: list[int]) -> str:
        """Text of ids. One space at the beginning goes; bytes that aren't UTF-8 give U+FFFD each."""
        table = self.bytes
        data = b"".join([table[i] for i in ids])
        try:
            text = data.decode()
        except UnicodeDecodeError:
            text = self._mended(ids)
        if self.prefix and text.startswith(" "):
            first = next(i for i in ids if self.kinds[i] != CONTROL)
            if self.kinds[first] == NORMAL:
                return text[1:]
        return text

    def _mended(self, ids: list[int]) -> str:
        out, run = [], b""
        for i in [*ids, self.end_id]:
            if self.kinds[i] == BYTE:
                run += self.bytes[i]
                continue
            while run:
                for size in range(min(4, len(run)), 0, -1):
                    try:
                        c = run[:size].decode()
                    except UnicodeDecodeError:
                        continue
                    if len(c) == 1:
                        break
                else:
                    c, size = "�", 1
                out.append(c)
                run = run[size:]
            out.append(self.bytes[i].decode())
        return "".join(out)


class PieceCodec:
    """Whole texts to ids and back; ``max_parts`` bounds the table of parts already encoded."""

    def __init__(self, data: bytes, max_parts: int = 300_000):
        self.pieces, self.max_parts, self.known, self.older = Pieces(data), max_parts, {}, {}

    def _part(self, part: str) -> tuple[bytes, str]:
        if len(self.known) >= self.max_parts:  # what is still in use moves on from the older table
            self.older, self.known = self.known, {}
        got = self.older.get(part)
        if got is None:
            ids = self.pieces.encode_part(part)
            got = pack(f"<{len(ids)}I", *ids), " ".join(map(str, ids))
        if len(part) <= 64:
            self.known[part] = got
        return got

    def encoded(self, text: str) -> tuple[np.ndarray, str]:
        """Ids of a text with the end id, and the same as decimals joined by spaces."""
        get, part = self.known.get, self._part
        found = [get(p) or part(p) for p in self.pieces.parts(self.pieces.marked(text))]
        end = self.pieces.end_id
        return np.frombuffer(b"".join([*(f[0] for f in found), pack("<I", end)]), dtype="<u4"), " ".join([*(f[1] for f in found), str(end)])


_made: dict[int, PieceCodec] = {}


def _codec(handle) -> PieceCodec:
    """The codec of this Python worker, made once from the broadcast model."""
    key = getattr(handle, "id", id(handle))
    if key not in _made:
        _made.clear()
        _made[key] = PieceCodec(handle.value)
    return _made[key]


def model_bytes(path: str | None = None) -> bytes:
    """The model file, of fixed size."""
    import public_tokenizers

    with open(path or public_tokenizers.path("piece_bpe_32k.model"), "rb") as f:
        return f.read()


def encode_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model_path: str | None = None) -> DataFrame:
    """``(doc_id, ids array<int>)`` of every whole text, with the end id; null and empty texts have that alone."""
    handle = docs.sparkSession.sparkContext.broadcast(model_bytes(model_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(handle)
        for b in parts(batches):
            ids = [codec.encoded(t or "")[0].astype(np.int32) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "ids"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("t")).mapInArrow(run, "doc_id long, ids array<int>")


def decode_documents(encoded: DataFrame, model_path: str | None = None) -> DataFrame:
    """``(doc_id, text)`` of rows ``(doc_id, ids)``; null ids count as none, ids outside the model raise."""
    handle = encoded.sparkSession.sparkContext.broadcast(model_bytes(model_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(handle)
        for b in parts(batches):
            texts = []
            for ids in b.column(1).to_pylist():
                if ids and not (0 <= min(ids) and max(ids) < codec.pieces.size):
                    raise ValueError("an id outside the model")
                texts.append(codec.pieces.decode(ids or []))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def piece_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model_path: str | None = None) -> DataFrame:
    """Encode and decode every whole text: ``(doc_id, n_tokens, ids_sha256, decoded_sha256)``.

    n_tokens counts all ids, the end id included; ids_sha256 is of the decimal
    ids joined by one space, decoded_sha256 of the decoded text in UTF-8. Null
    texts count as empty (the end id alone). Repeated rows give repeated rows; an
    empty table gives an empty result; other columns are ignored. Parts that a
    worker remembers are bounded, whatever the texts.
    """
    handle = docs.sparkSession.sparkContext.broadcast(model_bytes(model_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sha = lambda s: hashlib.sha256(s.encode("utf-8", "surrogatepass")).hexdigest()
        with _uncollected():
            codec = _codec(handle)
            for b in parts(batches):
                count, one, two = [], [], []
                for text in b.column(1).to_pylist():
                    ids, decimals = codec.encoded(text or "")
                    count.append(len(ids))
                    one.append(sha(decimals))
                    two.append(sha(codec.pieces.decode(ids.tolist())))
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(count, pa.int64()), pa.array(one, pa.string()), pa.array(two, pa.string())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("t"))
    return picked.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
