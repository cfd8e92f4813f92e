"""Byte-level BPE encoding and decoding (operator 4).

Pre-tokenisation without a regular expression: an array gives every code
point its class, neighbours turn classes into the symbols of a small automaton
(which reads the pattern ``'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+|
?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+``), and the state before every code point
comes from a scan over the automaton's transition functions.  Composition of
functions is associative and the automaton generates a small finite monoid, so
composing two functions is one table look-up and the scan runs blockwise over
whole batches, and window by window over a text of more than ``WINDOW`` code
points, each window starting at a boundary.  The slices between boundaries feed pair merging with a bounded
cache.  The token offsets in the bytes are kept for decoding.

Defined results: null and empty texts have no tokens and decode to no bytes;
every other column, repeated rows and empty input pass through.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import heapq
import os
import struct
import unicodedata
from collections.abc import Callable, Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from feedlake.llm.common import annotate

RANKS = "byte_bpe_50k.tiktoken"
#: Pieces in each of the two generations of a worker's cache.
CACHE_PIECES = 150_000
#: Code points of a long text handled at once, those at its end left to the next window, ids decoded at once.
WINDOW, AHEAD, DECODED = 1 << 20, 3, 1 << 18
#: Pieces up to this many bytes are merged side by side, and cached; longer
#: ones are merged one by one with a heap.
SHORT_BYTES = 64
NO_RANK = 1 << 30

# classes of code points
LETTER, NUMBER, SPACE, BLANK, OTHER, QUOTE, BREAK = range(7)
# symbols of the automaton: what a code point is, given its neighbours
S_LETTER, S_NUMBER, S_OTHER, S_SHORT, S_LONG, S_JOIN, S_LAST, S_MORE, S_BREAK = range(9)
# states: what has been read last
FRESH, IN_LETTERS, IN_NUMBERS, IN_OTHERS, IN_BLANKS, JOINING, ONE_LEFT, TWO_LEFT = range(8)

#: Code points with the White_Space property.
WHITE_SPACE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]


def _step(state: int, symbol: int) -> int:
    """The state after a symbol."""
    if symbol == S_BREAK:
        return FRESH
    if state == TWO_LEFT:
        return ONE_LEFT
    if state == ONE_LEFT:
        return FRESH
    if symbol == S_LETTER:
        return IN_LETTERS
    if symbol == S_NUMBER:
        return IN_NUMBERS
    if symbol == S_JOIN:
        return JOINING
    if symbol == S_LAST:
        return FRESH
    if symbol == S_MORE:
        return IN_BLANKS
    if symbol == S_OTHER or state in (IN_OTHERS, JOINING):
        return IN_OTHERS
    return ONE_LEFT if symbol == S_SHORT else TWO_LEFT


def _starts(state: int, symbol: int) -> bool:
    """Whether a token starts at a symbol read in a state."""
    if symbol == S_BREAK or state == FRESH:
        return True
    if state in (ONE_LEFT, TWO_LEFT):
        return False
    if symbol in (S_JOIN, S_LAST):
        return True
    if symbol == S_MORE:
        return state != IN_BLANKS
    goes_on = {S_LETTER: IN_LETTERS, S_NUMBER: IN_NUMBERS}.get(symbol, IN_OTHERS)
    return state not in (goes_on, JOINING)


@functools.cache
def automaton() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(monoid element of each symbol, composition table, state that each
    element leads to from ``FRESH``, token starts by state and symbol)."""
    states, symbols = range(8), range(9)
    elements = {tuple(states): 0}  # the identity
    made = [tuple(states)]
    generators = [tuple(_step(s, x) for s in states) for x in symbols]
    for element in made:  # grows while it is read: closure under the symbols
        for g in generators:
            product = tuple(g[s] for s in element)
            if product not in elements:
                elements[product] = len(made)
                made.append(product)
    table = np.array(
        [[elements[tuple(b[s] for s in a)] for b in made] for a in made], dtype=np.int16
    )
    return (
        np.array([elements[g] for g in generators], dtype=np.int16),
        table,
        np.array([e[FRESH] for e in made], dtype=np.int8),
        np.array([[_starts(s, x) for x in symbols] for s in states]),
    )


def scan(elements: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Inclusive prefix compositions: blocks are scanned side by side, then
    their totals, then each block is composed with what stands before it."""
    n = len(elements)
    if n <= 64:
        out = elements.copy()
        for i in range(1, n):
            out[i] = table[out[i - 1], out[i]]
        return out
    width = min(512, max(8, int(n**0.5)))
    rows = -(-n // width)
    grid = np.zeros((rows, width), dtype=elements.dtype)  # element 0 is the identity
    grid.ravel()[:n] = elements
    flat, size = table.ravel(), table.shape[0]
    cols = np.ascontiguousarray(grid.T)
    for j in range(1, width):
        cols[j] = flat[cols[j - 1].astype(np.int32) * size + cols[j]]
    before = np.concatenate([np.zeros(1, dtype=elements.dtype), scan(cols[-1].copy(), table)[:-1]])
    cols = flat[before.astype(np.int32)[None, :] * size + cols]
    return np.ascontiguousarray(cols.T).ravel()[:n]


@functools.cache
def classes() -> np.ndarray:
    """Class of every code point, from the Unicode categories."""
    kinds = {"L": LETTER, "N": NUMBER}
    out = np.array([kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)], dtype=np.int8)
    out[WHITE_SPACE] = BLANK
    out[0x20], out[0x27] = SPACE, QUOTE
    return out


def token_starts(codes: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Places of code points at which a pre-token starts.  ``ends`` marks the
    code points that only separate texts."""
    first, table, from_fresh, starts = automaton()
    kind = classes()[codes]
    kind[ends] = BREAK
    after = np.append(kind[1:], BREAK)
    symbol = np.array([S_LETTER, S_NUMBER, S_JOIN, S_LAST, S_OTHER, S_OTHER, S_BREAK], dtype=np.int8)[kind]
    symbol[((kind == SPACE) | (kind == BLANK)) & ((after == SPACE) | (after == BLANK) | (after == BREAK))] = S_MORE
    quote = np.flatnonzero(kind == QUOTE)
    if len(quote):
        padded = np.concatenate([np.where(ends, 0, codes), [0, 0]])
        one, two = padded[quote + 1], padded[quote + 2]
        symbol[quote[np.isin(one, [ord(c) for c in "stmd"])]] = S_SHORT
        long = np.zeros(len(quote), dtype=bool)
        for a, b in ("re", "ve", "ll"):
            long |= (one == ord(a)) & (two == ord(b))
        symbol[quote[long]] = S_LONG
    after_each = from_fresh[scan(first[symbol], table)]
    state = np.concatenate([[FRESH], after_each[:-1]])
    return np.flatnonzero(starts[state, symbol])


def pieces_of(texts: list[str]) -> list[list[str]]:
    """The pre-tokens of each text."""
    line = "\x00".join(texts) + "\x00"
    codes = np.frombuffer(line.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    stops = np.cumsum(np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))) - 1
    ends = np.zeros(len(codes), dtype=bool)
    ends[stops] = True
    starts = token_starts(codes, ends)
    cuts = np.append(starts, len(codes)).tolist()
    places = np.searchsorted(starts, stops).tolist()  # each separator is a start of its own
    out, lo = [], 0
    for hi in places:
        out.append([line[a:b] for a, b in zip(cuts[lo:hi], cuts[lo + 1 : hi + 1], strict=True)])
        lo = hi + 1
    return out


def long_pieces(text: str, window: int = 0) -> Iterator[list[str]]:
    """The pre-tokens of one long text, window by window.

    Whether a pre-token starts at a place depends on what stands before it,
    back to the pre-token before, and on the next two code points.  So a
    window that begins at a start has the whole text's starts up to ``AHEAD``
    from its end; the last of those begins the next window."""
    window = window or WINDOW
    lo, size = 0, window
    while lo < len(text):
        part = text[lo : lo + size]
        if lo + size >= len(text):
            yield pieces_of([part])[0]
            return
        codes = np.frombuffer((part + "\x00").encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        ends = np.zeros(len(codes), dtype=bool)
        ends[-1] = True
        starts = token_starts(codes, ends)
        cuts = starts[starts <= len(part) - AHEAD].tolist()
        if len(cuts) < 2:  # a pre-token longer than the window
            size *= 2
            continue
        yield [part[a:b] for a, b in pairwise(cuts)]
        lo, size = lo + cuts[-1], window


class Codec:
    """Encoder and decoder for one rank file."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        size = max(ranks.values(), default=-1) + 1
        tokens = [b""] * size
        for token, rank in ranks.items():
            tokens[rank] = token
        self.lengths = np.array([len(t) for t in tokens], dtype=np.int64)
        self.firsts = np.concatenate([[0], np.cumsum(self.lengths)])[:-1]
        self.bytes = np.frombuffer(b"".join(tokens), dtype=np.uint8)
        # every neighbouring pair that has a rank, as left * size + right
        pairs = {
            left * size + right: rank
            for token, rank in ranks.items()
            for i in range(1, len(token))
            if (left := ranks.get(token[:i])) is not None and (right := ranks.get(token[i:])) is not None
        }
        self.size = size
        self.pairs = np.array(sorted(pairs), dtype=np.int64)
        self.merged = np.array([pairs[k] for k in self.pairs.tolist()], dtype=np.int32)
        self.single = np.array([ranks[bytes([c])] for c in range(256)], dtype=np.int64)
        self.cache: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair of neighbours; ``NO_RANK`` for none or no token."""
        key = left * self.size + right
        slot = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        return np.where((self.pairs[slot] == key) & (left >= 0) & (right >= 0), self.merged[slot], NO_RANK)

    def merge_short(self, pieces: list[bytes]) -> list[bytes]:
        """Packed ids of pieces of similar length: in each round every piece
        merges its lowest-ranked neighbours, the leftmost of equal ones."""
        width = max(map(len, pieces))
        ids = np.full((len(pieces), width + 1), -1, dtype=np.int64)
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        live = np.arange(width + 1)[None, :] < sizes[:, None]
        ids[live] = self.single[np.frombuffer(b"".join(pieces), np.uint8)]
        ranks = self._ranks(ids[:, :-1], ids[:, 1:])
        whole, out = [self.ranks.get(p) for p in pieces], [b""] * len(pieces)
        row = np.arange(len(pieces))
        while len(row):
            at = ranks.argmin(axis=1)
            low = ranks[np.arange(len(row)), at]
            done = low == NO_RANK
            for r, line in zip(row[done].tolist(), ids[done].astype("<u4"), strict=True):
                out[r] = line[: sizes[r]].tobytes()
            go = ~done
            row, at, low, ids, ranks = row[go], at[go], low[go], ids[go], ranks[go]
            sizes[row] -= 1
            place = np.arange(width + 1)[None, :]
            shift = np.minimum(place + (place > at[:, None]), width)
            ids = np.take_along_axis(ids, shift, axis=1)
            ids[np.arange(len(row)), at] = low
            ranks = np.take_along_axis(ranks, np.minimum(shift[:, :-1], width - 1), axis=1)
            # the last column keeps its old value when the rest moves left
            ranks[:, -1] = NO_RANK
            ids[:, -1] = -1
            every = np.arange(len(row))
            ranks[every, at] = self._ranks(ids[every, at], ids[every, np.minimum(at + 1, width)])
            left = at > 0
            ranks[every[left], at[left] - 1] = self._ranks(ids[every[left], at[left] - 1], ids[every[left], at[left]])
        return [out[i] if w is None else struct.pack("<I", w) for i, w in enumerate(whole)]

    def merge_long(self, piece: bytes) -> bytes:
        """Packed ids of one piece, by a heap of neighbours."""
        rank = self.ranks.get
        if (whole := rank(piece)) is not None:
            return struct.pack("<I", whole)
        end = list(range(1, len(piece) + 1))  # of the part that starts here
        before = list(range(-1, len(piece) - 1))
        heap = [(r, i, i + 1, i + 2) for i in range(len(piece) - 1) if (r := rank(piece[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, a, b, c = heapq.heappop(heap)
            if end[a] != b or b >= len(piece) or end[b] != c:
                continue  # one of the two has been merged meanwhile
            end[a], end[b] = c, -1
            if c < len(piece):
                before[c] = a
                if (r := rank(piece[a : end[c]])) is not None:
                    heapq.heappush(heap, (r, a, c, end[c]))
            if before[a] >= 0 and (r := rank(piece[before[a] : c])) is not None:
                heapq.heappush(heap, (r, before[a], a, c))
        ids, at = [], 0
        while at < len(piece):
            ids.append(self.ranks[piece[at : end[at]]])
            at = end[at]
        return struct.pack(f"<{len(ids)}I", *ids)

    def _merge_new(self, pieces: list[str]) -> dict[str, bytes]:
        """Packed ids of pieces that the cache hasn't."""
        known: dict[str, bytes] = {}
        groups: dict[int, list[tuple[str, bytes]]] = {}
        for piece in pieces:
            data = piece.encode()
            if len(data) > SHORT_BYTES:
                known[piece] = self.merge_long(data)
            else:
                groups.setdefault(-(-len(data) // 4), []).append((piece, data))
        for group in groups.values():
            for lo in range(0, len(group), 8192):
                part = group[lo : lo + 8192]
                ids = self.merge_short([data for _, data in part])
                new = dict(zip((piece for piece, _ in part), ids, strict=True))
                known.update(new)
                self.cache.update(new)
        return known

    def encode(self, texts: list[str]) -> list[bytes]:
        """Packed ids (little-endian unsigned 32-bit integers) of each text."""
        short = [t for t in texts if len(t) <= WINDOW]
        packed = iter(self._pack(pieces_of(short)) if short else [])
        return [
            next(packed) if len(t) <= WINDOW else b"".join([self._pack([pieces])[0] for pieces in long_pieces(t)]) for t in texts
        ]

    def _pack(self, lists: list[list[str]]) -> list[bytes]:
        known: dict[str, bytes] = {}
        new = []
        for piece in set().union(*lists):
            ids = self.cache.get(piece)
            if ids is None and (ids := self.older.get(piece)) is not None:
                self.cache[piece] = ids
            if ids is None:
                new.append(piece)
            else:
                known[piece] = ids
        known.update(self._merge_new(new))
        if len(self.cache) >= CACHE_PIECES:  # what isn't used until the next turn goes
            self.older, self.cache = self.cache, {}
        return [b"".join([known[p] for p in pieces]) for pieces in lists]

    def offsets(self, packed: bytes) -> np.ndarray:
        """Start of each token in the text's bytes, and the end of the last."""
        return np.concatenate([[0], np.cumsum(self.lengths[np.frombuffer(packed, "<u4")])])

    def decoded(self, packed: bytes) -> Iterator[bytes]:
        """The bytes that the ids stand for, ``DECODED`` ids at a time."""
        for lo in range(0, len(packed), 4 * DECODED):
            part = packed[lo : lo + 4 * DECODED]
            ids = np.frombuffer(part, "<u4")
            place, sizes = self.offsets(part), self.lengths[ids]
            yield self.bytes[np.arange(place[-1]) + np.repeat(self.firsts[ids] - place[:-1], sizes)].tobytes()

    def decode(self, packed: bytes) -> bytes:
        return b"".join(self.decoded(packed))

    def decoded_sha256(self, packed: bytes) -> str:
        digest = hashlib.sha256()
        for part in self.decoded(packed):
            digest.update(part)
        return digest.hexdigest()


@functools.cache
def codec(path: str) -> Codec:
    """The codec of a rank file; a bare name is a file of ``public_tokenizers``."""
    if not os.path.dirname(path):
        import public_tokenizers

        path = public_tokenizers.path(path)
    with open(path, "rb") as lines:
        return Codec({base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)})


def encode_documents(docs: DataFrame, text_col: str = "text", ranks: str = RANKS, out_col: str = "token_ids") -> DataFrame:
    """``docs`` with the token ids (array of int) of each whole text."""

    def make() -> Callable[[list[str]], list]:
        coder = codec(ranks)

        def compute(texts: list[str]) -> list:
            packed = coder.encode(texts)
            stops = np.concatenate([[0], np.cumsum([len(p) // 4 for p in packed])]).astype(np.int32)
            ids = np.frombuffer(b"".join(packed), "<u4").astype(np.int32)
            return [pa.ListArray.from_arrays(pa.array(stops, pa.int32()), pa.array(ids, pa.int32()))]

        return compute

    return annotate(docs, text_col, f"`{out_col}` array<int>", make)


def decode_documents(docs: DataFrame, ids_col: str = "token_ids", ranks: str = RANKS, out_col: str = "decoded") -> DataFrame:
    """``docs`` with the bytes that the token ids stand for."""
    out = StructType([f for f in docs.drop(out_col).schema] + [StructField(out_col, BinaryType())])

    def run(batches):
        coder = codec(ranks)
        for batch in batches:
            ids = batch.column(ids_col).to_pylist()
            data = [coder.decode(np.array(i or [], "<u4").tobytes()) for i in ids]
            yield pa.RecordBatch.from_arrays(
                [batch.column(f.name) for f in out[:-1]] + [pa.array(data, pa.binary())], names=out.names
            )

    return docs.drop(out_col).mapInArrow(run, out)


def round_trip(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ranks: str = RANKS) -> DataFrame:
    """Per document: tokens, and digests of the ids and of the decoded bytes."""

    def make() -> Callable[[list[str]], list]:
        coder = codec(ranks)

        def compute(texts: list[str]) -> list:
            packed = coder.encode(texts)
            sha = hashlib.sha256
            return [
                [len(p) // 4 for p in packed],
                [sha(p).hexdigest() for p in packed],
                [coder.decoded_sha256(p) for p in packed],
            ]

        return compute

    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return annotate(narrow, "text", "n_tokens long, ids_sha256 string, decoded_sha256 string", make).drop("text")


def token_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ranks: str = RANKS) -> DataFrame:
    """Per document: id, tokens, token ids, and whether the ids decode to the
    text's bytes."""

    def make() -> Callable[[list[str]], list]:
        coder = codec(ranks)

        def compute(texts: list[str]) -> list:
            packed = coder.encode(texts)
            sizes = [len(p) // 4 for p in packed]
            ids = np.frombuffer(b"".join(packed), "<u4").astype(np.int32)
            stops = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            same = [coder.decode(p) == t.encode() for p, t in zip(packed, texts, strict=True)]
            return [sizes, pa.ListArray.from_arrays(pa.array(stops, pa.int32()), pa.array(ids, pa.int32())), same]

        return compute

    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return annotate(narrow, "text", "n_tokens long, token_ids array<int>, round_trip boolean", make).drop("text")
