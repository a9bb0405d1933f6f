"""N-gram Jaccard self-join: all documents whose sets of word n-grams agree to ``THRESHOLD``, as classes with link counts.

1. One pass makes every document's set (64-bit digest of the set, size, a histogram of hash ranges) and each
   partition's counts of the grams in a fixed sketch; the merged sketch orders grams from rare to common. Any order common
   to all documents is right, a rarer-first one is fast. Documents with equal sets share the digest and
   are one *node* from there on.
2. A set of n grams sends its first n - ceil(t n) + 2 grams in that order (its prefix); two sets that agree to t
   share two, or one if that is all they need to share. Prefixes travel packed, a row for each bucket (a range of 40-bit gram ids), with places and sizes.
3. In a bucket, the nodes of a gram are paired, smallest first, if their sizes (length filter) allow it and if
   the gram can be the first or second that they share: with one shared before it, what follows its places must suffice (positional
   filter). Pairs that all buckets together report a single gram of met by chance and are dropped. Each node also carries its ``MARKS`` prefix grams of smallest
   salted hash: a pair that shares some of these is reported by the smallest one's bucket alone, which both are sure to visit,
   and needs no second gram, so that near copies aren't reported by every bucket they meet in.
4. The pairs of a neighbourhood meet in one cell, or in a grid of cells if it is large, and each node travels to a cell
   once. First its histogram goes there: the sum of the smaller counts bounds a pair's overlap (suffix filter). The
   sets of the pairs that remain go there next and are intersected, once a pair. A cell reports each node's links
   and closest partner and a spanning forest of its pairs, so that rows follow the nodes and not the pairs.
5. Thousands of copies of one text would still give a row for each of their pairs. So nodes carry the least gram of each of
   ``BINS`` ranges of the hash; ``DENSE`` nodes or more that agree in two neighbouring ranges and in most others make a
   *family*. Buckets pass over pairs inside a family; those are all counted by products of 0/1 matrices, a cell for any two
   parts of a family. Whatever the families, the links are the same: they only decide which way a pair is counted.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain
from math import ceil

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, discard, maybe_broadcast, partitions, released, remove_rows, tidy
from .textops import U64, chunks, gram_sets, mix

N, THRESHOLD = 2, 0.55
#: Counters of the sketch (a power of two) and slices it is merged in.
CELLS, SLICES = 1 << 24, 64
#: Grams of a prefix that a node carries with it.
MARKS = 2
#: Prefix entries of a bucket, and of a flush of a partition's prefixes.
BUCKET_ENTRIES, _FLUSH = 3_000_000, 1_000_000
#: Nodes of either side that a cell of a large neighbourhood holds.
CELL = 4096
#: Ranges of the hash whose least grams are a node's signature, and those of them in which the nodes of a family agree with most others.
BINS, ALIKE = 16, 7
#: Least nodes of a family, most nodes and grams that a part of it is meant to hold, and most (value, node) rows that families are made of (largest first).
DENSE, PART, PART_GRAMS, FAMILY_ROWS = 128, 2048, 1_000_000, 1_000_000
#: Pairs that are looked at together, and found pairs that a cell keeps.
_LOOK, _KEEP = 1_000_000, 100_000
_EPS = 1e-9
_IDS = 40
_SALT = U64(0x5851F42D4C957F2D)


def digest(grams: np.ndarray) -> int:
    """A 64-bit digest of a set of grams."""
    with np.errstate(over="ignore"):
        s = mix(grams).sum(dtype=U64) + U64(len(grams)) * U64(0x9E3779B97F4A7C15)
    return int(mix(np.array([s], U64)).view(np.int64)[0])


def needed(na, nb, t: float):  # noqa: ANN001, ANN201
    """Least overlap of sets of these sizes whose Jaccard similarity reaches t."""
    return np.ceil(t / (1 + t) * (na + nb) - _EPS)


def packed(*arrays: np.ndarray) -> bytes:
    """The arrays' bytes, place by place of their items, compressed: places that are nearly always 0 cost next to nothing."""
    return zstandard.compress(b"".join(np.ascontiguousarray(np.ascontiguousarray(a).view(np.uint8).reshape(len(a), -1).T).tobytes() for a in arrays), 1)


def unpacked(blob: bytes, *shapes: tuple[int, str]) -> list[np.ndarray]:
    """The arrays of packed(), given their lengths and types."""
    raw, at, out = zstandard.decompress(blob), 0, []
    for n, kind in shapes:
        size = np.dtype(kind).itemsize
        out.append(np.ascontiguousarray(np.frombuffer(raw, np.uint8, n * size, at).reshape(size, n).T).view(kind).ravel())
        at += n * size
    return out


def histogram(grams: np.ndarray) -> bytes:
    """Counts of a set's grams in equal ranges of the hash, a power of two of them and about a gram or two a range, compressed."""
    k = max((len(grams) - 1).bit_length() - 1, 1)
    counts = np.bincount((grams >> U64(56 - k)).astype(np.int64), minlength=1 << k)
    return zstandard.compress(counts.astype(np.uint8).tobytes(), 1) if counts.max() < 256 else b""


def most_common(p: np.ndarray, q: np.ndarray) -> int:
    """The largest overlap that sets with these histograms can have."""
    if len(p) < len(q):
        p, q = q, p
    return int(np.minimum(p.reshape(len(q), -1).sum(1), q).sum())


def signature(grams: np.ndarray) -> bytes:
    """Of each range of the hash the least gram's last 32 bits, 0 for an empty range."""
    at = np.searchsorted(grams, np.arange(BINS + 1, dtype=U64) * U64((1 << 56) // BINS))
    low = grams[np.minimum(at[:-1], len(grams) - 1)].astype(np.uint32)
    return np.where(at[1:] > at[:-1], low, np.uint32(0)).tobytes()


_FIRST = "kind int, node long, id long, mark long, n int, slice int, counts binary, sig binary"


def _first_pass(n: int):  # noqa: ANN202
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(CELLS, np.uint16)
        for batch in batches:
            for b in chunks(batch, "text"):
                sets = gram_sets(b.column("text"), n)
                cells, times = np.unique(np.concatenate(sets).astype(np.uint32) & np.uint32(CELLS - 1), return_counts=True)
                counts[cells] = np.minimum(counts[cells] + times, 65_535)
                nothing = pa.nulls(len(sets), pa.int32()), pa.array([histogram(s) if len(s) else None for s in sets], pa.binary()), pa.array([signature(s) if len(s) else None for s in sets], pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(np.zeros(len(sets), np.int32)), pa.array([digest(s) for s in sets], pa.int64()), b.column("id"), b.column("mark"), pa.array([len(s) for s in sets], pa.int32()), *nothing], ["kind", "node", "id", "mark", "n", "slice", "counts", "sig"])
        if counts.any():
            none, size = pa.nulls(SLICES, pa.int64()), CELLS // SLICES
            slices = [packed(counts[s * size : (s + 1) * size]) for s in range(SLICES)]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(SLICES, 1, np.int32)), none, none, none, pa.nulls(SLICES, pa.int32()), pa.array(np.arange(SLICES, dtype=np.int32)), pa.array(slices, pa.binary()), pa.nulls(SLICES, pa.binary())], ["kind", "node", "id", "mark", "n", "slice", "counts", "sig"])

    return run


def _merge_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[int, np.ndarray] = {}
    for b in batches:
        for s, blob in zip(b.column("slice").to_pylist(), b.column("counts").to_pylist()):
            c = unpacked(blob, (CELLS // SLICES, "<u2"))[0].astype(np.int64)
            held[s] = held[s] + c if s in held else c
    for s, c in held.items():
        common = np.minimum(255, 8 * np.log2(1.0 + c)).astype(np.uint8)
        yield pa.RecordBatch.from_arrays([pa.array([s], pa.int32()), pa.array([packed(common)], pa.binary())], ["slice", "common"])


def prefixes(sets: list[np.ndarray], common: np.ndarray, t: float) -> list[np.ndarray]:
    """Of each set its prefix in the global order: commonness, then hash."""
    out = []
    for s in sets:
        order = np.sort((common[(s & U64(CELLS - 1)).astype(np.int64)].astype(U64) << U64(56)) | s)
        out.append(order[: len(s) - ceil(t * len(s) - _EPS) + 2] if len(s) else order)
    return out


def _second_pass(common, n: int, t: float, buckets: int):  # noqa: ANN001, ANN202
    def flush(nodes: list[int], sizes: list[int], held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        count = np.array([len(h) for h in held])
        gram = mix(np.concatenate(held)) >> U64(64 - _IDS)
        first = np.cumsum(count) - count
        doc = np.repeat(np.arange(len(held), dtype=np.uint32), count)
        place = (np.arange(len(gram)) - np.repeat(first, count)).astype(np.uint32)
        marks = np.empty((MARKS, len(held)), U64)
        for i, (a, k) in enumerate(zip(first.tolist(), count.tolist())):
            own = gram[a : a + k]
            marks[:, i] = np.resize(own[np.argpartition(mix(own ^ _SALT), min(MARKS, k) - 1)[:MARKS]], MARKS)
        order = np.argsort(gram, kind="stable")
        gram, doc, place = gram[order], doc[order], place[order]
        bucket = (gram * U64(buckets)) >> U64(_IDS)
        cuts = np.searchsorted(bucket, np.arange(buckets + 1, dtype=U64))
        node, size = np.array(nodes, np.int64), np.array(sizes, np.uint32)
        for k in np.flatnonzero(np.diff(cuts)).tolist():
            a, b = int(cuts[k]), int(cuts[k + 1])
            used, local = np.unique(doc[a:b], return_inverse=True)
            gaps = np.diff(gram[a:b], prepend=U64(0))
            blob = packed(node[used], size[used], *marks[:, used], gaps, local.astype(np.uint32), place[a:b])
            yield pa.RecordBatch.from_arrays([pa.array([x], pa.int32()) for x in (k, len(used), b - a)] + [pa.array([blob], pa.binary())], ["bucket", "nodes", "entries", "blob"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nodes, sizes, held, total = [], [], [], 0
        seen: set[int] = set()
        for batch in batches:
            for b in chunks(batch, "text"):
                for s in gram_sets(b.column("text"), n):
                    d = digest(s)
                    if len(s) and d not in seen:  # a partition sends a node once
                        seen.add(d)
                        nodes.append(d)
                        sizes.append(len(s))
                        held += prefixes([s], common, t)
                        total += len(held[-1])
                        if total > _FLUSH:
                            yield from flush(nodes, sizes, held)
                            nodes, sizes, held, total = [], [], [], 0
        if held:
            yield from flush(nodes, sizes, held)

    return run


def _unpack(blobs: list[tuple[int, int, bytes]]) -> tuple[np.ndarray, ...]:
    """(node, size, marks of each distinct node; gram, node number, place of each entry); takes the blobs out of their list."""
    entries = sum(m for _, m, _ in blobs)
    gram, which, place = np.empty(entries, U64), np.empty(entries, np.int32), np.empty(entries, np.int32)
    node, size, marks, base, at = [], [], [], 0, 0
    while blobs:
        k, m, blob = blobs.pop()
        x = unpacked(blob, (k, "<i8"), (k, "<u4"), *[(k, "<u8")] * MARKS, (m, "<u8"), (m, "<u4"), (m, "<u4"))
        node.append(x[0])
        size.append(x[1])
        marks.append(np.stack(x[2:-3]))
        np.cumsum(x[-3], out=gram[at : at + m])
        which[at : at + m] = x[-2] + base
        place[at : at + m] = x[-1]
        base, at = base + k, at + m
    node, first, number = np.unique(np.concatenate(node), return_index=True, return_inverse=True)
    return node, np.concatenate(size)[first].astype(np.int64), np.concatenate(marks, 1)[:, first], gram, number.astype(np.int32)[which], place


def _spans(lo: np.ndarray, hi: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(i, j) of all lo[i] <= j < hi[i], about _LOOK at a time."""
    count = np.maximum(hi - lo, 0)
    total, at = np.cumsum(count), 0
    while at < len(lo):
        to = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + _LOOK, "right")))
        n = count[at:to]
        i = np.repeat(np.arange(at, to), n)
        yield i, lo[i] + np.arange(len(i)) - np.repeat(np.cumsum(n) - n, n)
        at = to


def _bucket_parts(blobs: list[tuple[int, int, bytes]], t: float, bucket: int, buckets: int, families: tuple[np.ndarray, np.ndarray] | None = None) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The nodes a < b of the pairs that this bucket has to report, in parts of bounded size, each once in a part, and how many of
    the first two shared grams it saw (1 or 2); 2, too, if no other gram is needed.

    families: sorted nodes and the number, from 1, of each one's family; pairs inside a family are left out.
    """
    node, size, marks, gram, who, place = _unpack(blobs)
    family = np.zeros(len(node), np.int64)
    if families is not None:
        at = np.minimum(np.searchsorted(families[0], node), len(families[0]) - 1)
        family = np.where(families[0][at] == node, families[1][at], 0)
    order = np.argsort(gram, kind="stable")
    g = gram[order]
    same = g[1:] == g[:-1]
    shared = np.zeros(len(g), bool)
    shared[1:] |= same
    shared[:-1] |= same
    order = order[shared]
    order = order[np.lexsort((place[order], who[order], size[who[order]], gram[order]))]
    g, w, p = gram[order], who[order], place[order]
    once = np.ones(len(order), bool)  # a node comes from several partitions
    once[1:] = (g[1:] != g[:-1]) | (w[1:] != w[:-1]) | (p[1:] != p[:-1])
    g, w, p = g[once], w[once].astype(np.int64), p[once].astype(np.int64)
    del order, gram, who, place, same, shared, once
    s = size[w]
    marked = (marks[:, w] == g).any(0)

    def reported(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        first = np.minimum(s[left] - p[left], s[right] - p[right]) + 1 >= needed(s[left], s[right], t)
        ok = (first | (marked[left] & marked[right])) & (w[left] != w[right])
        a, b = w[left[ok]], w[right[ok]]
        return np.minimum(a, b) * len(node) + np.maximum(a, b)

    def alone() -> Iterator[np.ndarray]:
        """Of entries without family, by size in each gram."""
        own = np.flatnonzero(family[w] == 0)
        group = np.cumsum(np.append(True, g[own][1:] != g[own][:-1])) if len(own) else own
        for at in range(0, len(own), _LOOK):
            left, step = np.arange(at, min(at + _LOOK, len(own))), 0
            while len(left):
                step += 1
                left = left[left + step < len(own)]
                go = (group[left] == group[left + step]) & (s[own[left]] >= t * s[own[left + step]] - _EPS)
                left = left[go]
                yield reported(own[left], own[left + step])

    def between() -> Iterator[np.ndarray]:
        """Of entries of different families, or of one and of none: each block of a gram's entries with the blocks behind it."""
        of = np.flatnonzero(np.isin(g, g[family[w] > 0]))
        of = of[np.lexsort((s[of], family[w[of]], g[of]))]
        if not len(of):
            return
        gram, kin = g[of], family[w[of]]
        block = np.cumsum(np.append(0, (gram[1:] != gram[:-1]) | (kin[1:] != kin[:-1])))
        gram_of = gram[np.append(True, block[1:] != block[:-1])]
        key, left, step = (block << 32) + s[of], np.arange(len(of)), 0
        while len(left):
            step += 1
            left = left[block[left] + step < len(gram_of)]
            left = left[gram_of[block[left]] == gram_of[block[left] + step]]
            base = (block[left] + step) << 32
            least, most = np.ceil(t * s[of[left]] - _EPS).astype(np.int64), np.floor(s[of[left]] / t + _EPS).astype(np.int64)
            for i, j in _spans(np.searchsorted(key, base + least), np.searchsorted(key, base + most, "right")):
                yield reported(of[left[i]], of[j])

    def twice(held: list[np.ndarray]) -> np.ndarray:
        """What is held, each twice at most."""
        found = np.sort(np.concatenate(held))
        return found[np.append(np.ones(min(len(found), 2), bool), found[2:] != found[:-2])]

    def mine(held: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        found, times = np.unique(twice(held), return_counts=True)
        a, b = np.divmod(found, max(len(node), 1))
        least = np.full(len(a), U64(1 << _IDS))  # the smallest mark that both have
        for x in marks:
            for y in marks:
                least = np.where(x[a] == y[b], np.minimum(least, x[a]), least)
        unmarked = least == U64(1 << _IDS)
        times = np.where(unmarked & (needed(size[a], size[b], t) > 1), times, 2)
        own = unmarked | ((least * U64(buckets)) >> U64(_IDS) == U64(bucket))
        return node[a[own]], node[b[own]], times[own]

    held, total = [np.empty(0, np.int64)], 0
    for found in chain(alone(), between()):
        held.append(found)
        total += len(found)
        if total > 3_000_000:
            held = [twice(held)]
            total = len(held[0])
            if total > 1_500_000:  # what meets again is reported again, and added up
                yield mine(held)
                held, total = [np.empty(0, np.int64)], 0
    yield mine(held)


def bucket_pairs(blobs: list[tuple[int, int, bytes]], t: float, bucket: int, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The nodes a < b of the pairs that this bucket has to report, each once."""
    found = np.unique(np.concatenate([np.stack(x[:2], 1) for x in _bucket_parts(blobs, t, bucket, buckets)]), axis=0)
    return found[:, 0], found[:, 1]


def _pairs(t: float, buckets: int, families=None):  # noqa: ANN001, ANN202
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blobs: dict[int, list[tuple[int, int, bytes]]] = {}
        for batch in batches:
            for bucket, k, m, blob in zip(*(batch.column(i).to_pylist() for i in range(4))):
                blobs.setdefault(bucket, []).append((k, m, blob))
        for bucket in sorted(blobs):
            for a, b, times in _bucket_parts(blobs.pop(bucket), t, bucket, buckets, families and families.value):
                for at in range(0, len(a), 100_000):
                    yield pa.RecordBatch.from_arrays([pa.array(x[at : at + 100_000]) for x in (a, b, times.astype(np.int8))], ["a", "b", "times"])

    return run


_CELL = "kind int, a long, b long, links long, jaccard double"


def _in_cells(load, agree, report):  # noqa: ANN001, ANN202
    """Runs agree(of x, of y) on the pairs of each cell, whose nodes come first, and reports a cell's [(x, y, members of x, of y, found)]."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, held, found = None, {}, []

        def rows() -> Iterator[pa.RecordBatch]:
            if found:
                cols = zip(*report(found))
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.float64()))], [c.split()[0] for c in _CELL.split(", ")])

        for batch in batches:
            for cell, kind, x, y, blob in zip(*(batch.column(i).to_pylist() for i in range(5))):
                if cell != here:
                    yield from rows()
                    here, held, found = cell, {}, []
                if kind == 0:
                    held[x] = load(blob), y
                elif x in held and y in held and (value := agree(held[x][0], held[y][0])) is not None:
                    found.append((x, y, held[x][1], held[y][1], value))
                    if len(found) >= _KEEP:  # parts of a cell's links add up, and its forests connect the same nodes
                        yield from rows()
                        found = []
        yield from rows()

    return run


def _bound(t: float):  # noqa: ANN202
    """The suffix filter: the pairs whose histograms allow t."""

    def load(blob: bytes) -> tuple[np.ndarray, int] | None:
        if not blob:
            return None
        counts = np.frombuffer(zstandard.decompress(blob), np.uint8)
        return counts, int(counts.sum())

    def agree(x: tuple[np.ndarray, int] | None, y: tuple[np.ndarray, int] | None) -> float | None:
        return 1.0 if x is None or y is None or most_common(x[0], y[0]) >= needed(x[1], y[1], t) else None

    return _in_cells(load, agree, lambda found: [(1, x, y, None, value) for x, y, _, _, value in found])


def _loaded(blob: bytes) -> np.ndarray:
    """A set that _sets packed."""
    return np.cumsum(unpacked(blob[4:], (int.from_bytes(blob[:4], "little"), "<u8"))[0])


def _verify(t: float):  # noqa: ANN202
    def agree(p: np.ndarray, q: np.ndarray) -> float | None:
        common = int((q[np.minimum(np.searchsorted(q, p), len(q) - 1)] == p).sum())
        return common / (len(p) + len(q) - common) if common >= needed(len(p), len(q), t) else None

    def report(found: list[tuple[int, int, int, int, float]]) -> Iterator[tuple]:
        links: dict[int, int] = {}
        best: dict[int, float] = {}
        root: dict[int, int] = {}

        def find(x: int) -> int:
            while root.setdefault(x, x) != x:
                root[x] = x = root[root[x]]
            return x

        for x, y, mx, my, value in found:
            for node, more in ((x, my), (y, mx)):
                links[node] = links.get(node, 0) + more
                best[node] = max(best.get(node, 0.0), value)
            if (p := find(x)) != (q := find(y)):
                root[max(p, q)] = min(p, q)
                yield 1, x, y, None, value
        for node, n in links.items():
            yield 0, node, None, n, best[node]

    return _in_cells(_loaded, agree, report)


def _sets(n: int):  # noqa: ANN202
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in chunks(batch, "text"):
                blobs = [len(s).to_bytes(4, "little") + packed(np.diff(s, prepend=U64(0))) for s in gram_sets(b.column("text"), n)]
                yield pa.RecordBatch.from_arrays([b.column("cell"), b.column("node"), b.column("members"), pa.array(blobs, pa.binary())], ["cell", "node", "members", "blob"])

    return run


def _values(sig: np.ndarray) -> np.ndarray:
    """Of each signature the hashes of its pairs of neighbouring ranges, 0 where one is empty."""
    a, b = sig[:, 0::2].astype(U64), sig[:, 1::2].astype(U64)
    with np.errstate(over="ignore"):
        v = mix(mix((a << U64(32)) | b) + np.arange(BINS // 2, dtype=U64))
    return np.where((a > 0) & (b > 0), v, U64(0))


def _banded(wanted=None):  # noqa: ANN001, ANN202
    """(v) of all values of (node, sig), or (v, node, sig) of the wanted ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            v = _values(np.frombuffer(b"".join(b.column("sig").to_pylist()), np.uint32).reshape(-1, BINS))
            if wanted is None:
                yield pa.RecordBatch.from_arrays([pa.array(v[v > 0].view(np.int64))], ["v"])
                continue
            row, k = np.nonzero(np.isin(v.view(np.int64), wanted.value))
            yield pa.RecordBatch.from_arrays([pa.array(v[row, k].view(np.int64)), b.column("node").take(pa.array(row)), b.column("sig").take(pa.array(row))], ["v", "node", "sig"])

    return run


def _alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(v, node) of the nodes of each value whose signatures agree with what is most frequent among (the first) nodes of that value."""

    def kept(v: int, nodes: list[int], sigs: list[bytes]) -> pa.RecordBatch:
        sig = np.frombuffer(b"".join(sigs), np.uint32).reshape(-1, BINS)
        usual = [np.unique(c, return_counts=True) for c in sig[:4096].T]
        ok = (sig == np.array([u[np.argmax(n)] for u, n in usual], np.uint32)).sum(1) >= ALIKE
        node = np.array(nodes, np.int64)[ok]
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(node), v, np.int64)), pa.array(node)], ["v", "node"])

    here, nodes, sigs = None, [], []
    for b in batches:
        for v, node, sig in zip(*(b.column(i).to_pylist() for i in range(3))):
            if v != here:
                if nodes:
                    yield kept(here, nodes, sigs)
                here, nodes, sigs = v, [], []
            nodes.append(node)
            sigs.append(sig)
    if nodes:
        yield kept(here, nodes, sigs)


def group_families(v: np.ndarray, node: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted nodes and the number, from 1, of each one's family, given (value, node) rows: what values connect, if much of it shares some.

    The bound on how much keeps the pairs that matrices look at to some times those that share a value.
    """
    values, vi = np.unique(v, return_inverse=True)
    nodes, ni = np.unique(node, return_inverse=True)
    label = np.arange(len(values))
    while True:
        least = np.full(len(nodes), len(values))
        np.minimum.at(least, ni, label[vi])
        new = label.copy()
        np.minimum.at(new, vi, least[ni])
        if (new == label).all():
            break
        label = new
    size = np.bincount(least, minlength=len(values))
    met = np.bincount(label, np.bincount(vi, minlength=len(values)).astype(float) ** 2, minlength=len(values))
    good = (size >= DENSE) & (met * 4 >= size.astype(float) ** 2)
    number = np.cumsum(good) * good
    return nodes[number[least] > 0], number[least][number[least] > 0]


def _families(leads: DataFrame) -> tuple[np.ndarray, np.ndarray] | None:
    """group_families of the values that DENSE nodes share."""
    spark = leads.sparkSession
    with tidy(spark):
        heavy = leads.select("node", "sig").mapInArrow(released(_banded()), "v long").groupBy("v").agg(F.count("*").alias("rows")).filter(F.col("rows") >= DENSE)
        heavy = heavy.orderBy(F.desc("rows"), "v").limit(FAMILY_ROWS // DENSE).toArrow()
    values = heavy["v"].to_numpy()[np.cumsum(heavy["rows"].to_numpy()) <= FAMILY_ROWS]
    if not len(values):
        return None
    wanted = spark.sparkContext.broadcast(values)
    with tidy(spark):
        found = leads.select("node", "sig").mapInArrow(released(_banded(wanted)), "v long, node long, sig binary").repartition(partitions(spark), "v").sortWithinPartitions("v").mapInArrow(released(_alike), "v long, node long").toArrow()
    wanted.unpersist()
    nodes, number = group_families(found["v"].to_numpy(), found["node"].to_numpy())
    return (nodes, number) if len(nodes) else None


def overlaps(x: list[np.ndarray], y: list[np.ndarray]) -> np.ndarray:
    """How many grams each set of x has in common with each of y: products of 0/1 matrices for frequent grams, one by one for the others."""
    out = np.zeros((len(x), len(y)), np.float32)
    gx, gy = np.concatenate(x), np.concatenate(y)
    rx, ry = (np.repeat(np.arange(len(z)), [len(s) for s in z]) for z in (x, y))
    ux, ix, nx = np.unique(gx, return_inverse=True, return_counts=True)
    uy, iy, ny = np.unique(gy, return_inverse=True, return_counts=True)
    _, ax, ay = np.intersect1d(ux, uy, assume_unique=True, return_indices=True)
    del gx, gy
    often = nx[ax] * ny[ay] * 300 > len(x) * len(y)
    columns = np.full(len(ux), -1), np.full(len(uy), -1)
    for chosen in np.split(np.flatnonzero(often), range(1024, int(often.sum()), 1024)):
        sides = []
        for column, i, r, a, z in zip(columns, (ix, iy), (rx, ry), (ax, ay), (x, y)):
            column[:] = -1
            column[a[chosen]] = np.arange(len(chosen))
            c = column[i]
            side = np.zeros((len(z), len(chosen)), np.float32)
            side[r[c >= 0], c[c >= 0]] = 1
            sides.append(side)
        out += sides[0] @ sides[1].T
    rare = np.flatnonzero(~often)
    for column, a in zip(columns, (ax, ay)):
        column[:] = -1
        column[a[rare]] = np.arange(len(rare))
    cx, cy = columns[0][ix], columns[1][iy]
    rx, cx = rx[cx >= 0], cx[cx >= 0]
    order = np.argsort(cy, kind="stable")
    order = order[cy[order] >= 0]
    ry, cy = ry[order], cy[order]
    for i, j in _spans(np.searchsorted(cy, cx), np.searchsorted(cy, cx, "right")):
        np.add.at(out.reshape(-1), rx[i] * len(y) + ry[j], 1)
    return out


def forest(agree: np.ndarray) -> list[tuple[int, int]]:
    """(row, column) pairs of a matrix that connect the same rows and columns as all its true cells."""
    rows, columns, out = agree.any(1), ~agree.any(0), []
    while rows.any():
        front = np.array([np.argmax(rows)])
        rows[front] = False
        while len(front):
            part = agree[front]
            new = np.flatnonzero(part.any(0) & ~columns)
            columns[new] = True
            out += zip(front[part[:, new].argmax(0)].tolist(), new.tolist())
            if not len(new):
                break
            part = agree[:, new]
            front = np.flatnonzero(part.any(1) & rows)
            rows[front] = False
            out += zip(front.tolist(), new[part[front].argmax(1)].tolist())
    return out


def _dense(t: float):  # noqa: ANN202
    """What _verify reports, of all pairs of the nodes of two parts of a family, or of one part."""

    def cell(x: dict[int, tuple[int, np.ndarray]], y: dict[int, tuple[int, np.ndarray]], one: bool) -> pa.RecordBatch:
        common = overlaps([s for _, s in x.values()], [s for _, s in y.values()])
        (nx, mx, sx), (ny, my, sy) = ((np.array(list(z), np.int64), np.array([m for m, _ in z.values()], float), np.array([len(s) for _, s in z.values()])) for z in (x, y))
        agree = np.zeros(common.shape, bool)
        links, best = [np.zeros(len(x)), np.zeros(len(y))], [np.zeros(len(x)), np.zeros(len(y))]
        for at in range(0, len(x), 256):
            rows = slice(at, at + 256)
            c = common[rows].astype(float)
            ok = c >= needed(sx[rows, None], sy[None], t)
            if one:
                ok[np.arange(len(ok)), np.arange(at, at + len(ok))] = False
            value = np.where(ok, c / (sx[rows, None] + sy[None] - c), 0)
            agree[rows] = ok
            links[0][rows], best[0][rows] = ok @ my, value.max(1)
            links[1] += mx[rows] @ ok
            best[1] = np.maximum(best[1], value.max(0))
        out = []
        for node, n, value in list(zip((nx, ny), links, best))[: 1 if one else 2]:
            has = n > 0
            k = int(has.sum())
            out.append(([0] * k, node[has].tolist(), [None] * k, n[has].astype(np.int64).tolist(), value[has].tolist()))
        pairs = forest(agree)
        i, j = np.array([a for a, _ in pairs], np.int64), np.array([b for _, b in pairs], np.int64)
        c = common[i, j].astype(float)
        out.append(([1] * len(pairs), nx[i].tolist(), ny[j].tolist(), [None] * len(pairs), (c / (sx[i] + sy[j] - c)).tolist()))
        return pa.RecordBatch.from_arrays([pa.array([v for part in out for v in part[k]], kind) for k, kind in enumerate((pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.float64()))], [c.split()[0] for c in _CELL.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, sides = None, ({}, {})

        def rows() -> Iterator[pa.RecordBatch]:
            if here and here[1] == here[2]:
                yield cell(sides[0], sides[0], True)
            elif sides[0] and sides[1]:
                yield cell(*sides, False)

        for b in batches:
            for family, low, high, side, node, members, blob in zip(*(b.column(i).to_pylist() for i in range(7))):
                if here != (family, low, high):
                    yield from rows()
                    here, sides = (family, low, high), ({}, {})
                sides[side][node] = members, _loaded(blob)  # a row that is repeated is one node
        yield from rows()

    return run


def _inside(todo: DataFrame, leads: DataFrame, families: tuple[np.ndarray, np.ndarray], n: int, t: float) -> DataFrame:
    """What _verify reports, of the pairs inside families."""
    spark = todo.sparkSession
    listed = cut(spark.createDataFrame(pa.table({"node": families[0], "family": families[1]})), "families")
    known = cut(leads.join(maybe_broadcast(listed), "node").select("family", "node", "lead_id", "lead_mark", "members", "n"), "members")
    parts = known.groupBy("family").agg(F.greatest(F.ceil(F.count("*") / PART), F.ceil(F.sum("n") / PART_GRAMS)).cast("int").alias("parts"))
    wanted = cut(known.join(parts, "family").select("lead_id", "lead_mark", F.struct("family", "parts", F.pmod(F.xxhash64("node"), "parts").cast("int").alias("part")).alias("cell"), "node", "members"), "wanted")
    mine = todo.join(maybe_broadcast(wanted), (F.col("id") == F.col("lead_id")) & (F.col("mark") == F.col("lead_mark")))
    sets = mine.select("cell", "node", "members", "text")
    sets = sets.mapInArrow(released(_sets(n)), "cell struct<family: long, parts: int, part: int>, node long, members long, blob binary")
    each = sets.select("cell.*", F.explode(F.sequence(F.lit(0), F.col("cell.parts") - 1)).alias("other"), "node", "members", "blob")
    placed = each.select("family", F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high"), (F.col("part") > F.col("other")).cast("int").alias("side"), "node", "members", "blob")
    return placed.repartition(partitions(spark), "family", "low", "high").sortWithinPartitions("family", "low", "high").mapInArrow(released(_dense(t)), _CELL)


def _placed(pairs: DataFrame, hops: int, name: str) -> DataFrame:
    """(cell, a, b) of the pairs, written: a neighbourhood's pairs share a cell, or the cells of a grid of nodes a and b.

    A neighbourhood is what has the same smallest node within so many hops.
    """
    ends = pairs.select("a", "b").unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    place = ends.groupBy("a").agg(F.min("b").alias("least")).select("a", F.least("a", "least").alias("place"))
    for _ in range(hops - 1):
        near = place.select(F.col("a").alias("b"), "place")
        place = ends.join(near, "b").select("a", "place").unionByName(place).groupBy("a").agg(F.min("place").alias("place"))
    placed = cut(pairs.select("a", "b").join(place, "a").select("place", "a", "b"), f"{name}-places")
    many = placed.groupBy("place").count().filter(F.col("count") > CELL).select("place")
    if many.isEmpty():
        out = placed.withColumnRenamed("place", "cell")
        out._cut_path = placed._cut_path
        return out
    side = lambda x: F.ceil(F.approx_count_distinct(x) / F.lit(CELL)).alias("n" + x)
    grid = cut(placed.join(many, "place", "left_semi").groupBy("place").agg(side("a"), side("b")).filter("na > 1 OR nb > 1"), f"{name}-grid")
    cell = F.when(F.col("na").isNull(), F.col("place")).otherwise(F.xxhash64("place", F.pmod(F.xxhash64("a"), "na"), F.pmod(F.xxhash64("b"), "nb")))
    out = cut(placed.join(maybe_broadcast(grid), "place", "left").select(cell.alias("cell"), "a", "b"), f"{name}-cells")
    discard(placed, grid)
    return out


def _members(placed: DataFrame) -> DataFrame:
    return placed.select("cell", F.col("a").alias("node")).unionByName(placed.select("cell", F.col("b").alias("node"))).distinct()


def _meet(sent: DataFrame, placed: DataFrame, run) -> DataFrame:  # noqa: ANN001
    """run over the cells of both: sent has (cell, node, members, blob), placed (cell, a, b)."""
    both = sent.select("cell", F.lit(0).alias("kind"), F.col("node").alias("a"), F.col("members").alias("b"), "blob").unionByName(placed.select("cell", F.lit(1).alias("kind"), "a", "b", F.lit(None).cast("binary").alias("blob")))
    return both.repartition(partitions(sent.sparkSession), "cell").sortWithinPartitions("cell", "kind").mapInArrow(released(run), _CELL)


def _ready(docs: DataFrame) -> DataFrame:
    return docs.filter("doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).withColumn("mark", F.xxhash64("text"))


def similar(docs: DataFrame, n: int = N, t: float = THRESHOLD) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(documents, leads, found), all written.

    documents: (node, id, mark, n) of every row with an id; leads: (node, lead_id, lead_mark, members) of each node with
    grams; found: of the pairs that agree, (kind 0, a, links, jaccard) in parts for each node and (kind 1, a, b,
    jaccard) of pairs that connect the same nodes as all pairs do.
    """
    spark = docs.sparkSession
    todo = _ready(docs)
    first = cut(todo.select("id", "mark", "text").mapInArrow(released(_first_pass(n)), _FIRST), "grams")
    every = cut(first.filter("kind = 0").select("node", "id", "mark", "n"), "documents")
    live = first.filter("kind = 0 AND n > 0")
    common = np.zeros(CELLS, np.uint8)
    size = CELLS // SLICES
    merged = first.filter("kind = 1").select("slice", "counts").repartition(SLICES, "slice").mapInArrow(released(_merge_counts), "slice int, common binary")
    with tidy(spark):
        slices = merged.collect()
    for r in slices:
        common[r["slice"] * size : (r["slice"] + 1) * size] = unpacked(bytes(r["common"]), (size, "u1"))[0]
    order = spark.sparkContext.broadcast(packed(common))  # CELLS bytes at most, whatever the data
    entries = live.agg(F.sum(F.col("n") - F.ceil(F.lit(t) * F.col("n") - F.lit(_EPS)) + 2)).first()[0] or 0
    once = live.groupBy("node").agg(F.min(F.struct("id", "mark")).alias("lead"), F.first("counts").alias("blob"), F.first("sig").alias("sig"), F.first("n").alias("n"))
    members = live.select("node", "id").distinct().groupBy("node").agg(F.count("*").alias("members"))
    leads = cut(once.join(members, "node").select("node", F.col("lead.id").alias("lead_id"), F.col("lead.mark").alias("lead_mark"), "members", "blob", "sig", "n"), "leads")
    discard(first)
    families = _families(leads)
    kin = families and spark.sparkContext.broadcast(families)
    buckets = max(1, -(-int(entries) // BUCKET_ENTRIES))

    def second(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _second_pass(unpacked(order.value, (CELLS, "u1"))[0], n, t, buckets)(batches)

    sent = todo.select("text").mapInArrow(released(second), "bucket int, nodes int, entries int, blob binary").repartitionById(buckets, "bucket")
    met = sent.mapInArrow(released(_pairs(t, buckets, kin)), "a long, b long, times byte")
    candidates = cut(met.groupBy("a", "b").agg(F.sum("times").alias("times")).filter("times > 1").select("a", "b"), "candidates")
    order.unpersist()
    if kin:
        kin.unpersist()
    placed = _placed(candidates, 1, "candidates")
    survivors = cut(_meet(_members(placed).join(leads.select("node", "members", "blob"), "node"), placed, _bound(t)).select("a", "b"), "survivors")
    discard(candidates, placed)
    placed = _placed(survivors, 2, "survivors")
    wanted = cut(_members(placed).join(leads.select("node", "lead_id", "lead_mark", "members"), "node"), "wanted")
    mine = todo.join(maybe_broadcast(wanted), (F.col("id") == F.col("lead_id")) & (F.col("mark") == F.col("lead_mark")))
    sets = mine.select("cell", "node", "members", "text").mapInArrow(released(_sets(n)), "cell long, node long, members long, blob binary")
    met = _meet(sets, placed, _verify(t))
    found = cut(met if families is None else met.unionByName(_inside(todo, leads, families, n, t)), "found")
    discard(survivors, placed, wanted)
    return every, leads.drop("blob", "sig", "n"), found


def components(edges: DataFrame) -> DataFrame:
    """(id, root), written: root is the smallest id of the component of each end of the edges (x, y).

    Alternating star operations: every vertex ties its larger neighbours, then its smaller ones, to the
    smallest it knows, until nothing changes.
    """
    now = cut(edges.filter("x <> y").select(F.greatest("x", "y").alias("x"), F.least("x", "y").alias("y")).distinct(), "edges")
    state = None
    while True:
        both = now.unionByName(now.select(F.col("y").alias("x"), F.col("x").alias("y")))
        least = both.groupBy("x").agg(F.min("y").alias("m")).select("x", F.least("x", "m").alias("m"))
        large = both.filter("y > x").join(least, "x").select(F.col("y").alias("x"), F.col("m").alias("y")).distinct()
        least = large.groupBy("x").agg(F.min("y").alias("m"))
        small = large.join(least, "x").select(F.col("y").alias("x"), F.col("m").alias("y")).filter("x <> y").unionByName(least.select("x", F.col("m").alias("y"))).distinct()
        before, now = now, cut(small, "edges")
        discard(before)
        then, state = state, tuple(now.agg(F.count("*"), F.sum(F.xxhash64("x", "y").cast("decimal(38,0)"))).first())
        if then == state:
            return now.select(F.col("x").alias("id"), F.col("y").alias("root"))


def _classes(leads: DataFrame, found: DataFrame) -> DataFrame:
    """(node, class_id, class_mark): the smallest (id, mark) of the component of each node that has a link."""
    ends = components(found.filter("kind = 1").select(F.col("a").alias("x"), F.col("b").alias("y")))
    ends = ends.unionByName(ends.select(F.col("root").alias("id"), "root")).distinct().withColumnRenamed("id", "node")
    known = cut(ends.join(leads, "node").select("node", "root", F.struct("lead_id", "lead_mark").alias("lead")), "components")
    least = known.groupBy("root").agg(F.min("lead").alias("least"))
    return known.join(least, "root").select("node", F.col("least.lead_id").alias("class_id"), F.col("least.lead_mark").alias("class_mark"))


def jaccard_classes(docs: DataFrame, n: int = N, t: float = THRESHOLD) -> DataFrame:
    """(doc_id, class_id, n_links, nearest): every document's class of near copies and number of links in it.

    A link is a pair of documents whose sets agree to t. class_id is the smallest doc_id of what links connect; nearest
    is the document's highest similarity to another one, null without a link. All pairs are found and counted, a class's
    are not listed. A text of fewer than n words has one gram, all its words. Texts without words, empty ones
    and nulls have no grams: they are classes of their own, without links. Rows that repeat a doc_id and set are
    one document; a doc_id with several sets is several documents, a row each. Rows without doc_id are left
    out. Texts are taken whole, whatever their length. There are no ties: class_id is unique, nearest a
    maximum. An empty table gives no rows, other columns are ignored.
    """
    every, leads, found = similar(docs, n, t)
    stats = found.filter("kind = 0").groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"), F.max("jaccard").alias("best"))
    known = leads.join(stats, "node", "left").join(_classes(leads, found).select("node", "class_id"), "node", "left")
    nearest = F.when(F.col("members") > 1, F.lit(1.0)).otherwise(F.col("best"))
    known = known.select("node", F.coalesce("class_id", "lead_id").alias("class_id"), (F.col("members") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), nearest.alias("nearest"))
    with_grams = every.filter("n > 0").select("node", "id").distinct().join(known, "node").select(F.col("id").alias("doc_id"), "class_id", "n_links", "nearest")
    without = every.filter("n = 0").select(F.col("id").alias("doc_id")).distinct()
    return with_grams.unionByName(without.select("doc_id", F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links"), F.lit(None).cast("double").alias("nearest")))


def drop_near_duplicates(docs: DataFrame, n: int = N, t: float = THRESHOLD) -> DataFrame:
    """docs with one document of each class of jaccard_classes, the one with the smallest doc_id, all columns kept.

    Rows that repeat doc_id and text count as one document, of a doc_id's several texts in one class one stays.
    Rows without words, text or doc_id belong to no class and stay. Very long texts are taken whole, an
    empty table gives an empty table.
    """
    every, leads, found = similar(docs, n, t)
    keep = leads.join(_classes(leads, found), "node", "left").select("node", F.coalesce("class_id", "lead_id").alias("keep_id"), F.when(F.col("class_id").isNull(), F.col("lead_mark")).otherwise(F.col("class_mark")).alias("keep_mark"))
    member = every.filter("n > 0").join(keep, "node").groupBy("id", "mark").agg(F.count("*").alias("copies"), F.bool_or(F.expr("id = keep_id AND mark = keep_mark")).alias("kept"))
    return remove_rows(docs, cut(member, "members"), "NOT kept")
