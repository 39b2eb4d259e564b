"""Byte-level BPE as a lazily determinised transducer, and a streaming decoder.

A sequence of tokens is the BPE encoding of its bytes exactly if each adjacent
pair is (two tokens are compatible if the merges, run on their concatenation,
give those two back). So every prefix of a text has one encoding, fixed by its
last token. The transducer reads bytes; its state is the last token emitted and
the bytes not yet emitted. Positions from which some token could still reach
beyond the bytes read are alive; all their encodings agree up to a common
boundary, and the tokens before it are emitted. As no token is longer than the
longest in the vocabulary, the wait is bounded. States and transitions are made
when first needed and kept in tables of bounded size.
"""

from __future__ import annotations

import base64
import gc
import hashlib
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from functools import lru_cache
from struct import pack

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from chronoloom.llm.batches import parts


class Vocabulary:
    """Ranks of a tiktoken file, which are both the ids and the order of merges."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = {i: b for b, i in ranks.items()}
        self.longest = max(map(len, ranks), default=0)
        #: Every prefix of a token is a node: next nodes by byte (None: no longer token begins with it), and its token (-1: none).
        self.root = self._trie()
        self._pairs: dict[int, bool] = {}
        self._edges: dict[int, tuple[list, list]] = {}
        size = max(self.tokens, default=-1) + 1
        self.lengths = np.zeros(size, dtype=np.int64)
        for i, b in self.tokens.items():
            self.lengths[i] = len(b)
        self.sizes = self.lengths.tolist()
        self.offsets = np.concatenate(([0], np.cumsum(self.lengths)[:-1])) if size else self.lengths
        self.flat = np.frombuffer(b"".join(self.tokens.get(i, b"") for i in range(size)), dtype=np.uint8)

    def _trie(self) -> tuple[dict, int]:
        made: dict[bytes, dict] = {b"": {}}
        for t in self.ranks:
            for n in range(1, len(t)):
                made.setdefault(t[:n], {})
        for t, i in sorted(self.ranks.items(), key=lambda x: -len(x[0])):
            for n in range(len(t), 0, -1):  # leaves first, so that a node is whole when its parent gets it
                if t[n - 1] in made[t[: n - 1]]:
                    break
                own = self.ranks.get(t[:n], -1)
                made[t[: n - 1]][t[n - 1]] = made.get(t[:n]), own if own >= 0 and self.merge(t[:n]) == [own] else -1
        return made[b""], -1

    @classmethod
    def parse(cls, data: bytes) -> Vocabulary:
        return cls({base64.b64decode(a): int(b) for a, b in (line.split() for line in data.splitlines() if line)})

    def merge(self, piece: bytes) -> list[int]:
        """The merges themselves, lowest rank first; for checking single tokens and pairs."""
        parts = [piece[i : i + 1] for i in range(len(piece))]
        while len(parts) > 1:
            best = min(range(len(parts) - 1), key=lambda i: self.ranks.get(parts[i] + parts[i + 1], 1 << 60))
            if parts[best] + parts[best + 1] not in self.ranks:
                break
            parts[best : best + 2] = [parts[best] + parts[best + 1]]
        return [self.ranks[p] for p in parts]

    def _sides(self, token: int) -> tuple[list, list]:
        """Parts that stand at the left and at the right end of a token while it is merged: (bytes, when made, when merged on).

        Time is the highest rank merged so far.
        """
        known = self._edges.get(token)
        if known is None:
            b = self.tokens[token]
            parts, now = [b[i : i + 1] for i in range(len(b))], -1
            left, right = [(parts[0], -1)], [(parts[-1], -1)]
            while len(parts) > 1:
                best = min(range(len(parts) - 1), key=lambda i: self.ranks.get(parts[i] + parts[i + 1], 1 << 60))
                made = parts[best] + parts[best + 1]
                now = max(now, self.ranks[made])
                if best == 0:
                    left.append((made, now))
                if best == len(parts) - 2:
                    right.append((made, now))
                parts[best : best + 2] = [made]
            known = self._edges[token] = tuple([(x, t, side[i + 1][1] if i + 1 < len(side) else 1 << 60) for i, (x, t) in enumerate(side)] for side in (left, right))
        return known

    def compatible(self, left: int, right: int) -> bool:
        """Whether merging the two tokens' bytes gives the two back: no merge across their border comes in time.

        Of equal merges the leftmost is done first, so one within ``left`` goes
        before one across the border, and that before one within ``right``.
        """
        pair = left << 32 | right
        known = self._pairs.get(pair)
        if known is None:
            if len(self._pairs) > 400_000:  # bounded memory
                self._pairs.clear()
            known, get = True, self.ranks.get
            ours = self._sides(right)[0]
            for x, made, gone in self._sides(left)[1]:
                for y, made_y, gone_y in ours:
                    if made_y >= gone:
                        break
                    rank = get(x + y)
                    if rank is not None:
                        now = max(rank, made, made_y)
                        if now < gone and now <= gone_y:
                            known = False
            self._pairs[pair] = known
        return known


class Transducer:
    """Encodes one pre-token at a time; ``max_states`` bounds the memory of the lazy tables."""

    def __init__(self, vocabulary: Vocabulary, max_states: int = 300_000):
        self.v, self.max_states = vocabulary, max_states
        self._reset()

    def _reset(self) -> None:
        #: Per state: last token emitted (-1: none), pending bytes, last token of each prefix of these (-1: not needed), starts alive with their next nodes.
        self.states: list[tuple[int, bytes, tuple[int, ...], tuple[tuple[int, dict], ...]]] = [(-1, b"", (), ())]
        self.index = {(-1, b""): 0}
        self.steps: dict[int, tuple[int, tuple[int, ...]]] = {}
        #: What is emitted if a byte is a pre-token's last.
        self.ends: dict[int, tuple[int, ...]] = {}

    def _advance(self, state: int, byte: int) -> tuple[int, tuple[int, ...]]:
        v = self.v
        pairs = v._pairs
        before, pending, lasts, alive = self.states[state]
        n = len(pending)
        pending += bytes((byte,))
        last, still, front = -1, [], 2 << n
        for start, children in (*alive, (n, v.root[0])):
            found = children.get(byte)
            if found is None:
                continue
            children, token = found
            if children is not None:
                still.append((start, children))
                front |= 1 << start
            if last < 0 <= token:
                left = lasts[start - 1] if start else before
                if left < 0:
                    last = token
                else:
                    fits = pairs.get(left << 32 | token)
                    if fits or fits is None and v.compatible(left, token):
                        last = token
        lasts += (last,)
        # The encodings of all prefixes at which a token may still begin, walked back to their common boundary; positions are bits.
        kept, sizes = front, v.sizes
        while front & (front - 1):
            m = front.bit_length() - 1
            front ^= 1 << m
            front |= 1 << (m - sizes[lasts[m - 1]])
            kept |= front
        cut = front.bit_length() - 1
        if not cut:
            key, out = (before, pending), ()
        else:
            out = self._chain(lasts, cut)
            key = (out[-1], pending[cut:])
        nxt = self.index.get(key)
        if nxt is None:
            nxt = self.index[key] = len(self.states)
            self.states.append((*key, tuple([t if kept >> s & 1 else -1 for s, t in enumerate(lasts[cut:], cut + 1)]), tuple([(s - cut, c) for s, c in still])))
        return nxt, out

    def _chain(self, lasts: tuple[int, ...], end: int) -> tuple[int, ...]:
        out = []
        while end > 0:
            out.append(lasts[end - 1])
            end -= self.v.sizes[out[-1]]
        return tuple(out[::-1])

    def _finish(self, state: int, byte: int) -> tuple[int, ...]:
        """What is emitted if ``byte`` is the last one: the tokens of all that is pending. No state behind it is made."""
        before, pending, lasts, alive = self.states[state]
        for start, children in (*alive, (len(pending), self.v.root[0])):
            found = children.get(byte)
            if found is not None and (token := found[1]) >= 0:
                left = lasts[start - 1] if start else before
                if left < 0 or self.v.compatible(left, token):
                    return (*self._chain(lasts, start), token)
        raise ValueError("a byte without a token")

    def encode(self, piece: bytes) -> list[int]:
        """Ids of a pre-token: its own if the vocabulary has it whole, else what the transducer emits."""
        whole = self.v.ranks.get(piece)
        if whole is not None or not piece:
            return [] if whole is None else [whole]
        if len(self.states) > self.max_states or len(self.steps) + len(self.ends) > 3 * self.max_states:
            self._reset()
        state, out, steps = 0, [], self.steps
        for byte in piece[:-1]:
            at = state << 8 | byte
            step = steps.get(at)
            if step is None:
                step = steps[at] = self._advance(state, byte)
            state = step[0]
            if step[1]:
                out.extend(step[1])
        at = state << 8 | piece[-1]
        tail = self.ends.get(at)
        if tail is None:
            tail = self.ends[at] = self._finish(state, piece[-1])
        out.extend(tail)
        return out


class Utf8Machine:
    """Incremental UTF-8 decoding: a state machine over bytes that keeps an unfinished character.

    States: 0 at a boundary; 1-3 continuation bytes left; 4-7 after E0, ED, F0
    and F4, whose next byte has a narrower range. Malformed input gives U+FFFD
    for each maximal part, as Python's "replace" handler does, and sets
    ``malformed``. From a boundary on, whole characters are taken at once.
    """

    def __init__(self) -> None:
        self.state, self.held, self.out, self.malformed = 0, bytearray(), [], False

    @staticmethod
    def step(state: int, byte: int) -> int:
        """The next state, or -1 if ``byte`` can't follow."""
        if state == 0:
            if byte < 0x80:
                return 0
            if 0xC2 <= byte <= 0xDF:
                return 1
            if 0xE0 <= byte <= 0xEF:
                return {0xE0: 4, 0xED: 5}.get(byte, 2)
            if 0xF0 <= byte <= 0xF4:
                return {0xF0: 6, 0xF4: 7}.get(byte, 3)
            return -1
        low, high, after = {1: (0x80, 0xBF, 0), 2: (0x80, 0xBF, 1), 3: (0x80, 0xBF, 2), 4: (0xA0, 0xBF, 1), 5: (0x80, 0x9F, 1), 6: (0x90, 0xBF, 2), 7: (0x80, 0x8F, 2)}[state]
        return after if low <= byte <= high else -1

    def feed(self, data: bytes) -> str:
        """Characters finished by ``data``."""
        at = 0
        while at < len(data) and self.state:
            self._byte(data[at])
            at += 1
        # The last character may be unfinished: it begins at most three bytes before the end.
        end = len(data)
        while end > at and len(data) - end < 3 and data[end - 1] & 0xC0 == 0x80:
            end -= 1
        if end > at and data[end - 1] >= 0xC0:
            end -= 1
        else:
            end = len(data)
        try:
            self.out.append(data[at:end].decode("utf-8"))
            at = end
        except UnicodeDecodeError:
            pass
        for byte in data[at:]:
            self._byte(byte)
        got, self.out = "".join(self.out), []
        return got

    def _byte(self, byte: int) -> None:
        after = self.step(self.state, byte)
        if after < 0:
            self.malformed = True
            if self.held:
                self.out.append("\ufffd")
                self.held.clear()
                after = self.step(0, byte)
            if after < 0:
                self.out.append("\ufffd")
                self.state = 0
                return
        self.held.append(byte)
        self.state = after
        if after == 0:
            self.out.append(self.held.decode("utf-8"))
            self.held.clear()

    def finish(self) -> str:
        """What an unfinished character at the end gives."""
        got = "\ufffd" if self.held else ""
        self.malformed |= bool(self.held)
        self.state = 0
        self.held.clear()
        return got


@lru_cache(maxsize=1)
def _kinds() -> np.ndarray:
    """For each code point: 1 letter, 2 number, 3 white space but for 4 the space, 0 anything else."""
    out = np.zeros(0x110000, dtype=np.uint8)
    every = "".join(map(chr, range(0xD800))) + "\0" * 0x800 + "".join(map(chr, range(0xE000, 0x110000)))
    for kind, name in ((1, "L"), (2, "N"), (3, "White_Space")):
        for m in regex.finditer(rf"\p{{{name}}}+", every):
            out[m.start() : m.end()] = kind
    out[32] = 4
    return out


#: The endings that the public pattern splits off at an apostrophe.
ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")


def split(text: str) -> list[str]:
    """The public pattern's matches, found from the kinds of neighbouring characters.

    A run of letters, of numbers or of other characters is a match, with one
    space before it if there is one; white space but for its last character is a
    match if something else follows; an apostrophe that begins a match takes an
    ending of ENDINGS.
    """
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    if not len(code):
        return []
    kind = _kinds()[code]
    white = kind >= 3
    start = np.ones(len(code), dtype=bool)
    start[1:] = np.where(white[1:], ~white[:-1], (kind[1:] != kind[:-1]) & (kind[:-1] != 4))
    start[:-1] |= white[:-1] & ~white[1:]
    for q in np.flatnonzero(start & (code == 39)).tolist():
        for e in ENDINGS:
            if text.startswith(e, q + 1):
                start[q + 1] = False
                after = q + 1 + len(e)
                if after < len(code) and kind[after] == 1:
                    start[after] = True
                break
    at = np.flatnonzero(start).tolist()
    return [text[a:b] for a, b in zip(at, [*at[1:], len(text)])]


class Codec:
    """Whole texts to ids and back. ``max_pieces`` bounds the table of pre-tokens already encoded."""

    def __init__(self, vocabulary: Vocabulary, pattern: str, public: str | None = None, max_pieces: int = 300_000):
        self.v, self.fst = vocabulary, Transducer(vocabulary)
        # White space in the rank files' patterns is what Unicode defines.
        self.find = split if pattern == public else regex.compile(pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")).findall
        self.max_pieces, self.known, self.older = max_pieces, {}, {}

    def _piece(self, piece: str) -> tuple[bytes, str]:
        if len(self.known) >= self.max_pieces:  # what is still in use moves on from the older table
            self.older, self.known = self.known, {}
        got = self.older.get(piece)
        if got is None:
            ids = self.fst.encode(piece.encode("utf-8", "surrogatepass"))
            got = pack(f"<{len(ids)}I", *ids), ",".join(map(str, ids))
        if len(piece) <= 64:
            self.known[piece] = got
        return got

    def rest(self) -> None:
        """Let go of what is quickly made again, as the worker may now serve another operator."""
        self.older = {}
        self.fst._reset()
        self.v._pairs.clear()

    def pieces(self, text: str) -> list[tuple[bytes, str]]:
        """Each match of the pattern, encoded separately, without special tokens: ids as bytes, and as decimals."""
        get, piece = self.known.get, self._piece
        return [get(p) or piece(p) for p in self.find(text)]

    def encode(self, text: str) -> np.ndarray:
        """Ids of a text."""
        return np.frombuffer(b"".join([p[0] for p in self.pieces(text)]), dtype="<u4")

    def decode_bytes(self, ids: np.ndarray) -> bytes:
        """The bytes of a block of ids."""
        ids = np.asarray(ids, dtype=np.int64)
        n = self.v.lengths[ids]
        ends = np.cumsum(n)
        shift = self.v.offsets[ids] - (ends - n)
        return self.v.flat[np.repeat(shift, n) + np.arange(ends[-1] if len(ends) else 0)].tobytes()

    def decoded_digest(self, ids: np.ndarray) -> str:
        """SHA-256 of what ids decode to: a stream of blocks through the UTF-8 machine, or the bytes themselves where they aren't UTF-8."""
        machine, text = Utf8Machine(), hashlib.sha256()
        for at in range(0, len(ids), BLOCK):
            text.update(machine.feed(self.decode_bytes(ids[at : at + BLOCK])).encode("utf-8"))
        machine.finish()
        if machine.malformed:
            text = hashlib.sha256()
            for at in range(0, len(ids), BLOCK):
                text.update(self.decode_bytes(ids[at : at + BLOCK]))
        return text.hexdigest()

    def decode_stream(self, blocks: Iterable[np.ndarray]) -> Iterator[str]:
        """Text of a stream of id blocks; a character cut by a block's end comes with the next block."""
        machine = Utf8Machine()
        for ids in blocks:
            yield machine.feed(self.decode_bytes(ids))
        yield machine.finish()


class _Lazy:
    """The codec of this Python worker, made once from the broadcast file."""

    made: dict[int, Codec] = {}

    @classmethod
    def get(cls, handle, pattern: str) -> Codec:
        key = hash((pattern, handle.id if hasattr(handle, "id") else 0))
        if key not in cls.made:
            cls.made.clear()
            import public_tokenizers

            cls.made[key] = Codec(Vocabulary.parse(handle.value), pattern, public_tokenizers.PATTERN)
        return cls.made[key]


def _resolve(ranks_path: str | None, pattern: str | None) -> tuple[bytes, str]:
    import public_tokenizers

    with open(ranks_path or public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        return f.read(), pattern or public_tokenizers.PATTERN


#: Ids decoded at once.
BLOCK = 1 << 18


@contextmanager
def _uncollected() -> Iterator[None]:
    """Without searches for reference cycles: the tables' many tuples hold none, and going through them takes longer than encoding."""
    on = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if on:
            gc.enable()


def encode_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ranks_path: str | None = None, pattern: str | None = None) -> DataFrame:
    """``(doc_id, ids array<int>)``: the tokens of every whole text; null and empty texts have none."""
    data, pattern = _resolve(ranks_path, pattern)
    handle = docs.sparkSession.sparkContext.broadcast(data)  # one vocabulary file, of fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with _uncollected():
            codec = _Lazy.get(handle, pattern)
            for b in parts(batches):
                ids = [codec.encode(t or "") for t in b.column(1).to_pylist()]
                ends = np.cumsum([0, *map(len, ids)])
                flat = np.concatenate(ids).astype(np.int32) if ids else np.zeros(0, dtype=np.int32)
                yield pa.RecordBatch.from_arrays([b.column(0), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))], names=["doc_id", "ids"])
            codec.rest()

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("t")).mapInArrow(run, "doc_id long, ids array<int>")


def decode_documents(encoded: DataFrame, ranks_path: str | None = None) -> DataFrame:
    """``(doc_id, text)`` of ``encode_documents``' rows, decoded as a stream of blocks."""
    data, pattern = _resolve(ranks_path, None)
    handle = encoded.sparkSession.sparkContext.broadcast(data)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _Lazy.get(handle, pattern)
        for b in parts(batches):
            texts = []
            for ids in b.column(1).to_pylist():
                ids = np.array(ids or [], dtype=np.int64)
                texts.append("".join(codec.decode_stream(ids[i : i + BLOCK] for i in range(0, len(ids), BLOCK))))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def _digest_batch(codec: Codec, b: pa.RecordBatch) -> pa.RecordBatch:
    count, one, two = [], [], []
    for text in b.column(1).to_pylist():
        pieces = codec.pieces(text or "")
        ids = np.frombuffer(b"".join([p[0] for p in pieces]), dtype="<u4")
        count.append(len(ids))
        one.append(hashlib.sha256(",".join([p[1] for p in pieces]).encode()).hexdigest())
        two.append(codec.decoded_digest(ids))
    return pa.RecordBatch.from_arrays([b.column(0), pa.array(count, pa.int64()), pa.array(one, pa.string()), pa.array(two, pa.string())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])


def token_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ranks_path: str | None = None, pattern: str | None = None, max_pieces: int = 300_000, max_states: int = 300_000, rest_after_task: bool = False) -> DataFrame:
    """Encode and decode every whole text: ``(doc_id, n_tokens, ids_sha256, decoded_sha256)``.

    ids_sha256 is of the decimal ids joined by commas, decoded_sha256 of the
    bytes that the ids decode to, as the UTF-8 machine gives them back. Null texts count as empty (no tokens, both
    digests of no bytes). max_pieces and max_states bound what a worker remembers
    (about half a kilobyte each); fewer cost time only, as does letting it go
    after each task. Repeated rows give repeated rows; an empty table gives
    an empty result; other columns of ``docs`` are ignored.
    """
    data, pattern = _resolve(ranks_path, pattern)
    handle = docs.sparkSession.sparkContext.broadcast(data)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with _uncollected():
            codec = _Lazy.get(handle, pattern)
            codec.max_pieces, codec.fst.max_states = max_pieces, max_states
            for b in parts(batches):
                yield _digest_batch(codec, b)
            if rest_after_task:
                codec.rest()

    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("t"))
    return picked.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
