"""Byte-level BPE encoding and decoding.

Pre-tokenisation follows the usual byte-level pattern (contractions, an optional space before a run of
letters, digits or other signs, white space) without a regular expression. Every code point has a class;
with what follows it, the class is a symbol of a small automaton, and every symbol is a function from
states to states. Composition of such functions is associative, so a whole buffer of documents is scanned
in parallel: the functions of equal blocks are composed side by side, the blocks' entry states follow, and a
second sweep gives each character's state and with it the boundaries. The slices' hashes are made unique per
batch; only slices that a worker hasn't met are merged, pair by pair, and byte offsets of all tokens are kept.
"""

from __future__ import annotations

import base64
import heapq
import sys
import unicodedata
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import released
from .textops import _BYTES, U64, buffer, chunks, mix

#: The vocabulary: lines of base64 token and rank.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"

#: Bytes of text encoded at once.
ENCODED_BYTES = 1 << 20
NONE = 1 << 40  # no rank

# Symbols: letter, digit, other, space or other white space before a non-space, white space before white space or
# the end, apostrophe that begins a contraction of one or two letters. Eight more: the same at a text's start.
_L, _N, _O, _S, _W, _X, _Q1, _Q2 = range(8)
# States: start, in letters, digits, others, after a joined space, in white space, after a lone white-space
# character, one and two letters before a contraction's end, after it.
_START, _IN_L, _IN_N, _IN_O, _JOIN, _IN_W, _LONE, _C1, _C2, _CEND = range(10)


def _automaton() -> tuple[np.ndarray, np.ndarray]:
    """Next state and whether a slice begins, for symbol and state."""
    to, begins = np.zeros((16, 10), np.uint8), np.ones((16, 10), bool)
    for sym, state, joined in ((_L, _IN_L, (_IN_L, _JOIN)), (_N, _IN_N, (_IN_N, _JOIN)), (_O, _IN_O, (_IN_O, _JOIN)), (_S, _JOIN, ()), (_W, _LONE, ()), (_X, _IN_W, (_IN_W,)), (_Q1, _C1, ()), (_Q2, _C2, ())):
        to[sym] = state
        begins[sym, list(joined)] = False
    for sym in (_Q1, _Q2):  # an apostrophe inside a run of signs or after a joined space is only a sign
        for s in (_IN_O, _JOIN):
            to[sym, s], begins[sym, s] = _IN_O, False
    to[_L, _C2], to[_L, _C1] = _C1, _CEND
    begins[_L, [_C1, _C2]] = False
    to[8:] = to[:8, [_START] * 10]  # a text's first character forgets the state before it
    return to, begins


_TO, _BEGINS = _automaton()
_BEGINS[8:] = True
_SPACES = [*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]


@lru_cache(1)
def classes() -> np.ndarray:
    """Class of every code point: letter, digit, other, space, other white space (as _L, _N, _O, _S, _W)."""
    kinds = {"L": _L, "N": _N}
    out = np.fromiter((kinds.get(unicodedata.category(chr(c))[0], _O) for c in range(sys.maxunicode + 1)), np.uint8, sys.maxunicode + 1)
    out[_SPACES] = _W
    out[32] = _S
    return out


def symbols(points: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The automaton's symbol of every code point; first: where texts begin (not past the end)."""
    n = len(points)
    kind = classes()[points]
    begins = np.zeros(n + 3, bool)
    begins[first] = True
    begins[n:] = True
    space = (kind == _S) | (kind == _W)
    after = np.ones(n, bool)  # white space or the text's end follows
    after[:-1] = space[1:]
    after |= begins[1 : n + 1]
    sym = kind.copy()
    sym[space & after] = _X
    at = np.flatnonzero(points == 39)
    if len(at):
        p = np.concatenate([points, np.zeros(2, points.dtype)])
        one, two = p[at + 1], p[at + 2]
        short = np.isin(one, [ord(c) for c in "stmd"]) & ~begins[at + 1]
        r, v, ll = one == ord("r"), one == ord("v"), one == ord("l")
        long = ((r | v) & (two == ord("e")) | ll & (two == ord("l"))) & ~begins[at + 1] & ~begins[at + 2]
        sym[at[short]] = _Q1
        sym[at[long]] = _Q2
    sym[first] += 8
    return sym


def scan(sym: np.ndarray) -> np.ndarray:
    """Which symbols begin a slice, by composing the blocks' transition functions."""
    n = len(sym)
    width = max(1, int(n**0.5) // 4)
    rows = -(-n // width)
    grid = np.full(rows * width, _O, np.uint8)
    grid[:n] = sym
    grid = np.ascontiguousarray(grid.reshape(rows, width).T)  # a row is the same place of every block
    flat = _TO.ravel()
    base = grid.astype(np.int32) * 10
    # every block's function, as its images of the ten states; once the images agree, one of them is enough
    live, image = np.arange(rows), np.broadcast_to(np.arange(10, dtype=np.uint8), (rows, 10))
    constant = np.zeros(rows, np.uint8)
    agreed = np.zeros(rows, bool)
    for t in range(width):
        constant = flat[base[t] + constant]
        if len(live):
            image = flat[base[t, live][:, None] + image]
            same = (image == image[:, :1]).all(1)
            if same.any():
                constant[live[same]] = image[same, 0]
                agreed[live[same]] = True
                live, image = live[~same], image[~same]
    entry = np.empty(rows, np.uint8)
    state, still = _START, {int(b): image[k] for k, b in enumerate(live)}
    for b, (fixed, end) in enumerate(zip(agreed.tolist(), constant.tolist())):
        entry[b] = state
        state = end if fixed else int(still[b][state])
    begins = np.empty((width, rows), bool)
    flat_begins = _BEGINS.ravel()
    for t in range(width):
        at = base[t] + entry
        begins[t] = flat_begins[at]
        entry = flat[at]
    return begins.T.ravel()[:n]


def slices(buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Byte positions at which the texts' pre-tokens begin."""
    if not len(buf):
        return np.empty(0, np.int64)
    lead = np.flatnonzero((buf & 0xC0) != 0x80)
    points = np.frombuffer(buf.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    first = np.searchsorted(lead, np.unique(offsets[offsets < len(buf)]))
    return lead[scan(symbols(points, first))]


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ranks of a slice's tokens: the adjacent pair of lowest rank is joined first, the leftmost of equals."""
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    parts = [piece[i : i + 1] for i in range(len(piece))]
    n = len(parts)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(r, i, parts[i] + parts[i + 1]) for i in range(n - 1) if (r := ranks.get(parts[i] + parts[i + 1])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, joined = heapq.heappop(heap)
        j = after[i]
        if j >= n or not parts[i] or parts[i] + parts[j] != joined:
            continue
        parts[i], parts[j] = joined, b""
        after[i] = k = after[j]
        if k < n:
            before[k] = i
            if (r := ranks.get(joined + parts[k])) is not None:
                heapq.heappush(heap, (r, i, joined + parts[k]))
        h = before[i]
        if h >= 0 and (r := ranks.get(parts[h] + joined)) is not None:
            heapq.heappush(heap, (r, h, parts[h] + joined))
    return [ranks[p] for p in parts if p]


def read_ranks(path: str = VOCABULARY) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class Codec:
    """Encodes and decodes whole batches; remembers the slices it has merged, up to KNOWN of them."""

    KNOWN = 200_000
    #: Longest slice that is merged side by side with others; longer ones are merged alone with a heap.
    WIDE = 32

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks = ranks
        size = max(ranks.values()) + 1
        self.length = np.zeros(size, np.int64)
        for t, r in ranks.items():
            self.length[r] = len(t)
        self.first = np.cumsum(self.length) - self.length
        by_rank = sorted(ranks.items(), key=lambda x: x[1])
        self.bytes = np.frombuffer(b"".join(t for t, _ in by_rank), np.uint8)
        self.single = np.array([ranks.get(bytes([i]), -1) for i in range(256)], np.int64)
        self.size = size
        joins = sorted((a * size + b, r) for t, r in ranks.items() for i in range(1, len(t)) if (a := ranks.get(t[:i])) is not None and (b := ranks.get(t[i:])) is not None)
        self.pairs, self.joined = np.array([k for k, _ in joins], np.int64), np.array([r for _, r in joins], np.int64)
        self.forget()

    def forget(self) -> None:
        self.known: dict[int, int] = {}  # hash of a slice -> where its tokens are in the store, after their number
        self.store = array("i")

    def _rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of the joined pairs, NONE where there is no such token or no pair."""
        key = a * self.size + b
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        return np.where((self.pairs[at] == key) & (a >= 0) & (b >= 0), self.joined[at], NONE)

    def _merge_side_by_side(self, buf: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Tokens of equally handled slices, a row each, -1 past their end: every round joins one pair of each."""
        wide = int(size.max())
        place = np.arange(wide)
        inside = place < size[:, None]
        part = np.where(inside, self.single[buf[np.minimum(start[:, None] + place, len(buf) - 1)]], -1)
        out = np.full((len(size), wide), -1, np.int64)
        rank = np.full((len(size), wide), NONE, np.int64)
        rank[:, :-1] = self._rank(part[:, :-1], part[:, 1:])
        rows = np.arange(len(size))
        while len(rows):
            at = rank.argmin(1)
            low = rank[np.arange(len(rows)), at]
            stop = low == NONE
            if stop.any():
                out[rows[stop]] = part[stop]
                rows, part, rank, at, low = rows[~stop], part[~stop], rank[~stop], at[~stop], low[~stop]
                if not len(rows):
                    break
            line = np.arange(len(rows))
            past = place[:-1] > at[:, None]
            part[:, :-1] = np.where(past, part[:, 1:], part[:, :-1])
            rank[:, :-1] = np.where(past, rank[:, 1:], rank[:, :-1])
            part[:, -1], rank[:, -1] = -1, NONE
            part[line, at] = low
            after = np.minimum(at + 1, wide - 1)
            rank[line, at] = np.where(at + 1 < wide, self._rank(low, part[line, after]), NONE)
            prior = np.flatnonzero(at > 0)
            rank[prior, at[prior] - 1] = self._rank(part[prior, at[prior] - 1], low[prior])
        return out

    def _learn(self, hashes: list[int], start: np.ndarray, end: np.ndarray, buf: np.ndarray, raw: bytes) -> None:
        size = end - start
        lone, rest = [], []
        for i, (a, b) in enumerate(zip(start.tolist(), end.tolist())):
            whole = self.ranks.get(raw[a:b])
            if whole is not None or b - a > self.WIDE:
                lone.append((i, [whole] if whole is not None else merge(raw[a:b], self.ranks)))
            else:
                rest.append(i)
        for i, ids in lone:
            self.known[hashes[i]] = len(self.store)
            self.store.append(len(ids))
            self.store.extend(ids)
        rest = np.array(rest, np.int64)
        rest = rest[np.argsort(size[rest], kind="stable")]
        for k in range(0, len(rest), 20_000):
            some = rest[k : k + 20_000]
            tokens = self._merge_side_by_side(buf, start[some], size[some])
            count = (tokens >= 0).sum(1)
            block = np.concatenate([count[:, None], tokens], 1)
            at = len(self.store) + np.cumsum(count + 1) - (count + 1)
            self.store.frombytes(block[block >= 0].astype(np.int32).tobytes())
            self.known.update(zip([hashes[i] for i in some.tolist()], at.tolist()))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(tokens, first token of each text and past the last, byte end of each token in its text, bytes, their offsets)."""
        buf, offsets = buffer(texts)
        start = slices(buf, offsets)
        end = np.append(start[1:], len(buf)) if len(start) else start
        up, down = _BYTES.get(len(buf) + 1)
        sums = np.zeros(len(buf) + 1, U64)
        np.cumsum((buf.astype(U64) + U64(1)) * up[: len(buf)], out=sums[1:])
        hashes = mix((sums[end] - sums[start]) * down[start] + (end - start).astype(U64))
        distinct, at, which = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.known) > self.KNOWN:
            self.forget()
        keys = distinct.tolist()
        new = np.array([i for i, h in enumerate(keys) if h not in self.known], np.int64)
        if len(new):
            self._learn([keys[i] for i in new.tolist()], start[at[new]], end[at[new]], buf, buf.tobytes())
        place = np.fromiter(map(self.known.__getitem__, keys), np.int64, len(keys))
        store = np.frombuffer(self.store, np.int32) if len(self.store) else np.empty(0, np.int32)
        count = store[place].astype(np.int64)
        tokens = store[_spread((place + 1)[which], count[which])]
        before = np.concatenate([[0], np.cumsum(count[which])])
        bound = before[np.searchsorted(start, offsets)]
        ends = np.cumsum(self.length[tokens])
        ends -= np.repeat(offsets[:-1], np.diff(bound))
        return tokens, bound, ends, buf, offsets

    def decode(self, tokens: np.ndarray) -> np.ndarray:
        """The bytes of a row of tokens."""
        return self.bytes[_spread(self.first[tokens], self.length[tokens])]


def _spread(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """first[i], first[i]+1 ... count[i] of them, for all i, in one array."""
    total = int(count.sum())
    past = np.cumsum(count)
    return np.repeat(first - (past - count), count) + np.arange(total)


_CODECS: dict[str, Codec] = {}


def codec(path: str, ranks: dict[bytes, int] | None = None) -> Codec:
    """The process's codec of a vocabulary, kept between tasks."""
    if path not in _CODECS:
        _CODECS.clear()
        _CODECS[path] = Codec(ranks or read_ranks(path))
    return _CODECS[path]


def _exactly(machine: Codec, text: bytes) -> list[int]:
    """The tokens of a text by merging each of its slices, without the slices' hashes."""
    buf = np.frombuffer(text, np.uint8)
    start = slices(buf, np.array([0, len(buf)])).tolist()
    return [t for a, b in zip(start, [*start[1:], len(text)]) for t in merge(text[a:b], machine.ranks)]


def encode(docs: DataFrame, path: str = VOCABULARY, columns: list[str] | None = None) -> DataFrame:
    """The chosen columns of docs (doc_id only by default) with n_tokens, tokens, ends and round_trip.

    ``ends`` holds the byte offset in the UTF-8 text at which each token ends, ``round_trip`` says that the tokens
    decode to exactly the text's bytes. Slices are known by a 64-bit hash; a text whose tokens don't decode to
    it is encoded again without hashes. Null and empty texts have no tokens (empty arrays; a null text's round_trip
    is null), very long ones are encoded whole. Repeated rows are encoded alike, an empty table gives no rows.
    Columns not chosen are ignored; a result column whose name a chosen one has gets underscores behind it. The
    vocabulary is read on the driver and sent along, a megabyte whatever the data's size.
    """
    columns = columns or ["doc_id"]
    ranks = docs.sparkSession.sparkContext.broadcast(read_ranks(path))
    todo = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(columns)], F.col("text").cast("string").alias("text"))
    names: list[str] = []
    for name in ("n_tokens", "tokens", "ends", "round_trip"):
        while name.lower() in {c.lower() for c in [*columns, *names]}:
            name += "_"
        names.append(name)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = codec(path, ranks.value)
        for batch in batches:
            for b in chunks(batch, "text", ENCODED_BYTES):
                texts = b.column("text")
                tokens, bound, ends, buf, offsets = machine.encode(texts)
                same = _same_bytes(machine.decode(tokens), buf, offsets)
                if not all(same):
                    each = [tokens[x:y] for x, y in zip(bound[:-1], bound[1:])]
                    for i in np.flatnonzero(~np.array(same)).tolist():
                        each[i] = np.array(_exactly(machine, buf[offsets[i] : offsets[i + 1]].tobytes()), np.int64)
                    tokens = np.concatenate(each).astype(np.int64)
                    bound = np.concatenate([[0], np.cumsum([len(x) for x in each])])
                    ends = np.concatenate([np.cumsum(machine.length[x]) for x in each])
                    same = _same_bytes(machine.decode(tokens), buf, offsets)
                live = texts.is_valid().to_pylist()
                lists = [pa.ListArray.from_arrays(pa.array(bound, pa.int32()), pa.array(x, pa.int32())) for x in (tokens, ends)]
                ok = pa.array([s if v else None for s, v in zip(same, live)], pa.bool_())
                yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(len(columns))), pa.array(np.diff(bound), pa.int32()), *lists, ok], [*b.schema.names[:-1], *names])
        machine.forget()  # workers outlive tasks

    kept = ", ".join(f"c{i} {f.dataType.simpleString()}" for i, f in enumerate(todo.schema.fields[:-1]))
    made = ", ".join(f"`{n}` {t}" for n, t in zip(names, ("int", "array<int>", "array<int>", "boolean")))
    out = todo.mapInArrow(released(run), f"{kept}, {made}")
    return out.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(columns)], *[F.col(n) for n in names])


def _same_bytes(got: np.ndarray, buf: np.ndarray, offsets: np.ndarray) -> list[bool]:
    if len(got) != len(buf):
        return [False] * (len(offsets) - 1)
    wrong = np.concatenate([[0], np.cumsum(got != buf)])
    return (wrong[offsets[1:]] == wrong[offsets[:-1]]).tolist()


def decode(encoded: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """(doc_id, text) of a table with doc_id and tokens.

    Null tokens give a null text, none an empty one; bytes that aren't UTF-8 (a cut row of tokens) become U+FFFD.
    """
    ranks = encoded.sparkSession.sparkContext.broadcast(read_ranks(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = codec(path, ranks.value)
        for b in batches:
            texts = [None if t is None else machine.decode(np.asarray(t, np.int64)).tobytes().decode("utf-8", "replace") for t in b.column("tokens").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    todo = encoded.select("doc_id", F.col("tokens").cast("array<int>").alias("tokens"))
    return todo.mapInArrow(released(run), f"doc_id {todo.schema['doc_id'].dataType.simpleString()}, text string")
