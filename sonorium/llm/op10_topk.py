"""Exact top-k search by inner product: a set of query vectors against the whole table.

Vectors are rotated by the singular vectors of the whole table's second-moment matrix, so that the first
coordinates carry most of every inner product, and sorted by descending length into blocks. By Cauchy-Schwarz no
item scores above ``|q||x|`` nor above ``q_head.x_head + |q_tail||x_tail|``: once the first bound of a block's
longest vector is below the k-th best of each query, the block and all after it are skipped, and an item
whose partial sum and residual bound stay below is never multiplied out. Scores that decide are computed in
double precision; bounds carry a slack above the rounding of the single-precision partial sums, so
nothing is lost.

The search has two phases. First, all queries meet the longest blocks only (``LEAD`` of them); each query's k-th
best there over its own length is the shortest vector that it can still need. Queries are then grouped by that
length, and a group is sent only the remaining blocks that reach the least of its queries' lengths, a stretch
of them a task, so that groups and stretches make up a grid: items travel once a group, queries once a stretch.
Last, each query's results of all stretches are merged, k from each at most.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, discard

K = 10
#: The queries of the search: rows whose id this divides.
EVERY = 20
#: Rows of a block of items, queries of a group, share of the second moment in the head coordinates.
BLOCK, GROUP, HEAD = 1024, 4096, 0.6
#: Blocks that all queries meet first, and blocks of a stretch that one task of a group meets.
LEAD, STRETCH = 2, 8
_SLACK = 1e-5


def _pack(table: pa.RecordBatch) -> np.ndarray:
    lists = table.column("v")
    flat = np.asarray(lists.flatten(), np.float64)
    return flat.reshape(len(lists), -1) if len(lists) else np.empty((0, 0))


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = None
    for b in batches:
        x = _pack(b)
        if len(x):
            total = x.T @ x if total is None else total + x.T @ x
    if total is not None:
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["m"])


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = None
    for b in batches:
        for m in b.column("m").to_pylist():
            part = np.frombuffer(m)
            total = part if total is None else total + part
    if total is not None:
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["m"])


def rotation(vectors: DataFrame, fan_in: int = 32) -> tuple[np.ndarray, int]:
    """(right singular vectors, number of head coordinates) of all rows.

    Partitions' d x d moments are added up in a tree, fan_in at a time, so that the driver receives fan_in of them at most.
    """
    parts, left = vectors.mapInArrow(_moments, "m binary"), vectors.rdd.getNumPartitions()
    while left > fan_in:
        left = -(-left // fan_in)
        parts = parts.repartition(left).mapInArrow(_summed, "m binary")
    total = np.sum([np.frombuffer(r["m"]) for r in parts.collect()], 0)
    d = int(len(total) ** 0.5)
    values, axes = np.linalg.eigh(total.reshape(d, d))
    values, axes = np.maximum(values[::-1], 0), axes[:, ::-1]
    share = np.cumsum(values) / max(values.sum(), 1e-300)
    return np.ascontiguousarray(axes), int(min(d, max(1, np.searchsorted(share, HEAD) + 1)))


class Group:
    """The k best of a group of queries, improved block by block; blocks come from the longest items on."""

    def __init__(self, ids: np.ndarray, rotated: np.ndarray, head: int, k: int) -> None:
        self.ids, self.q, self.head, self.k = ids, rotated, head, k
        self.length = np.linalg.norm(rotated, axis=1)
        self.front = rotated[:, :head].astype(np.float32)
        self.tail = np.linalg.norm(rotated[:, head:], axis=1)
        n = len(ids)
        self.score = np.full((n, k), -np.inf)
        self.found = np.full((n, k), np.iinfo(np.int64).max)
        self.floor = np.full(n, -np.inf)  # a k-th best known from elsewhere: what scores below can't matter
        self.multiplied = 0

    def meet(self, ids: np.ndarray, rotated: np.ndarray, length: np.ndarray) -> bool:
        """Takes a block in; False if neither it nor any later one can matter."""
        least = np.maximum(self.score[:, -1], self.floor)
        slack = _SLACK * (1 + self.length * length[0])
        alive = np.flatnonzero(self.length * length[0] + slack >= least)
        if not len(alive):
            return False
        tail = np.linalg.norm(rotated[:, self.head :], axis=1)
        bound = (self.front[alive] @ rotated[:, : self.head].astype(np.float32).T).astype(np.float64)
        bound += self.tail[alive][:, None] * tail
        row, col = np.nonzero(bound + slack[alive][:, None] >= least[alive][:, None])
        del bound
        if not len(row):
            return True
        self.multiplied += len(row)
        hit = np.unique(row)
        if len(row) > 0.2 * len(alive) * len(ids):  # dense: one product is cheaper than gathered ones
            exact = self.q[alive[hit]] @ rotated.T
        else:
            exact = np.full((len(hit), len(ids)), -np.inf)
            at = np.searchsorted(hit, row)
            for a in range(0, len(row), 200_000):
                r, c = row[a : a + 200_000], col[a : a + 200_000]
                exact[at[a : a + 200_000], c] = np.einsum("ij,ij->i", self.q[alive[r]], rotated[c])
        mine = alive[hit]
        exact = np.round(exact, 9)  # equal inner products stay equal, whatever the order of their sums
        exact[self.ids[mine][:, None] == ids] = -np.inf
        if exact.shape[1] > 4 * self.k:
            cut_at = np.partition(exact, exact.shape[1] - self.k, axis=1)[:, -self.k]
            cut_at = np.maximum(cut_at, self.score[mine, -1])
            many = (exact >= cut_at[:, None]) & np.isfinite(exact)
        else:
            many = np.isfinite(exact)
        r, c = np.nonzero(many)
        rows = np.concatenate([np.repeat(np.arange(len(mine)), self.k), r])
        score = np.concatenate([self.score[mine].ravel(), exact[r, c]])
        found = np.concatenate([self.found[mine].ravel(), ids[c]])
        order = np.lexsort((found, -score, rows))
        rows, score, found = rows[order], score[order], found[order]
        rank = np.arange(len(rows)) - np.searchsorted(rows, rows)
        best = rank < self.k
        self.score[mine[rows[best]], rank[best]] = score[best]
        self.found[mine[rows[best]], rank[best]] = found[best]
        return True


_OUT = "vec_id long, rank int, neighbour_id long, score double"


def _blocks(batches: Iterator[pa.RecordBatch], block: int) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for at in range(0, b.num_rows, block):
            part = b.slice(at, block)
            cols = ((float(part.column("length")[0].as_py()), pa.float64()), (int(part.column("id")[0].as_py()), pa.int64()), (part.column("id").to_numpy().tobytes(), pa.binary()), (b"".join(part.column("x").to_pylist()), pa.binary()))
            yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in cols], ["length", "first_id", "ids", "xs"])


def _search(d: int, head: int, k: int):  # noqa: ANN202
    """Of each cell, whose queries come first and then its blocks from the longest on, the queries' k best and k-th best."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here: Group | None = None
        cell, done, ids, xs, floors = None, False, [], [], []

        def ready() -> Group:
            g = Group(np.array(ids, np.int64), np.frombuffer(b"".join(xs)).reshape(-1, d), head, k)
            g.floor = np.array(floors)
            return g

        for b in batches:
            for c, kind, key, floor, raw, items in zip(*(b.column(n).to_pylist() for n in ("cell", "kind", "first_id", "floor", "xs", "ids"))):
                if c != cell:
                    if here is not None:
                        yield _answers(here)
                    here, cell, done, ids, xs, floors = None, c, False, [], [], []
                if kind == 0:
                    ids.append(key)
                    xs.append(raw)
                    floors.append(floor)
                elif ids and not done:
                    here = here or ready()
                    x = np.frombuffer(raw).reshape(-1, d)
                    done = not here.meet(np.frombuffer(items, np.int64), x, np.linalg.norm(x, axis=1))
        if here is not None:
            yield _answers(here)

    return run


def top_k(table: DataFrame, k: int = K, every: int = EVERY, block: int = BLOCK, group: int = GROUP, lead: int = LEAD, stretch: int = STRETCH) -> DataFrame:
    """(vec_id, rank, neighbour_id, score): the k largest inner products of each query with the other rows.

    Queries are the rows whose id ``every`` divides, items are all rows. Scores are rounded to 9 decimals; of ties the smaller
    id ranks first. A vector is no neighbour of its own id; repeated rows count as one item, an id with several
    vectors asks with all of them and answers with the k best of theirs. Rows with a null id, a null, empty or differently long vector, or a null or non-finite coordinate
    are left out (the length is that of most rows, the shorter of ties); vectors of any length are taken whole; k
    is cut to what the table has, an empty table gives no rows, other columns are ignored.
    """
    spark = table.sparkSession
    empty = spark.createDataFrame([], _OUT)
    v = F.col("embedding").cast("array<double>")
    sound = table.select(F.col("vec_id").cast("long").alias("id"), v.alias("v")).filter("id IS NOT NULL AND v IS NOT NULL AND size(v) > 0").filter(~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))))
    lengths = sound.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    if not lengths:
        return empty
    d = lengths[0]["d"]
    sound = cut(sound.filter(F.size("v") == d).dropDuplicates(["id", "v"]), "vectors")
    axes, head = rotation(sound)

    def prepare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = _pack(b) @ axes
            if len(x):
                yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(np.linalg.norm(x, axis=1)), pa.array([r.tobytes() for r in x], pa.binary())], ["id", "length", "x"])

    total = sound.count()
    n_queries = sound.filter(F.col("id") % every == 0).count()
    order = [F.desc("length"), F.col("id")]
    sorted_rows = sound.mapInArrow(prepare, "id long, length double, x binary").repartitionByRange(max(1, -(-total // (block * 16))), *order).sortWithinPartitions(*order)
    rotated = cut(sorted_rows, "rotated")
    discard(sound)
    items = cut(rotated.mapInArrow(lambda b: _blocks(b, block), "length double, first_id long, ids binary, xs binary"), "blocks")
    if not n_queries:
        return empty
    longest = [(r["length"], r["first_id"]) for r in items.select("length", "first_id").orderBy(F.desc("length"), "first_id").limit(lead).collect()]
    length, first = longest[-1]
    is_lead = (F.col("length") > F.lit(length)) | ((F.col("length") == F.lit(length)) & (F.col("first_id") <= F.lit(first)))
    asked = rotated.filter(F.col("id") % every == 0)
    search = _search(d, head, k)

    def cells(queries: DataFrame, blocks: DataFrame, n: int) -> DataFrame:
        """The search in the cells of both: queries (cell, id, x, floor), blocks (cell, length, first_id, ids, xs)."""
        none = F.lit(None).cast("binary")
        both = queries.select("cell", F.lit(0).alias("kind"), F.lit(0.0).alias("length"), F.col("id").alias("first_id"), "floor", none.alias("ids"), F.col("x").alias("xs"))
        both = both.unionByName(blocks.select("cell", F.lit(1).alias("kind"), (-F.col("length")).alias("length"), "first_id", F.lit(0.0).alias("floor"), "ids", "xs"))
        return both.repartitionById(n, F.pmod("cell", F.lit(n)).cast("int")).sortWithinPartitions("cell", "kind", "length", "first_id").mapInArrow(search, _OUT)

    groups = max(1, -(-n_queries // group))
    first_groups = asked.select(F.pmod(F.xxhash64("id"), F.lit(groups)).cast("long").alias("cell"), "id", "x", F.lit(float("-inf")).alias("floor"))
    met = cut(cells(first_groups, items.filter(is_lead).select(F.explode(F.sequence(F.lit(0), F.lit(groups - 1)).cast("array<long>")).alias("cell"), "length", "first_id", "ids", "xs"), groups), "lead")
    # the k-th best so far, and with it the shortest vector that a query can still need
    kth = met.filter(F.col("rank") == k).groupBy(F.col("vec_id").alias("id")).agg(F.min("score").alias("floor"))
    reach = F.coalesce((F.col("floor") - _SLACK * (1 + F.col("length") * F.lit(longest[0][0]))) / F.greatest("length", F.lit(1e-300)), F.lit(float("-inf")))
    known = asked.join(kth, "id", "left").select("id", "x", F.coalesce("floor", F.lit(float("-inf"))).alias("floor"), reach.alias("reach"))
    known = cut(known.repartitionByRange(groups, F.desc("reach"), "id").select(F.spark_partition_id().cast("long").alias("g"), "*"), "queries")
    # a row for each group of queries: 16 bytes to a few thousand queries
    need = known.groupBy("g").agg(F.min("reach").alias("least"))
    stretches = max(1, -(-total // (block * stretch)))
    rest = items.filter(~is_lead).select(F.pmod(F.xxhash64("first_id"), F.lit(stretches)).alias("s"), "length", "first_id", "ids", "xs")
    sent = rest.join(F.broadcast(need), F.col("length") >= F.col("least")).select((F.col("g") * stretches + F.col("s")).alias("cell"), "length", "first_id", "ids", "xs")
    asked_in = sent.select("cell").distinct().select("cell", F.floor(F.col("cell") / stretches).alias("g"))
    also = cells(known.join(asked_in, "g").select("cell", "id", "x", "floor"), sent, max(1, min(groups * stretches, 4096)))
    place = Window.partitionBy("vec_id").orderBy(F.desc("score"), "neighbour_id")
    return met.unionByName(also).withColumn("rank", F.row_number().over(place)).filter(F.col("rank") <= k).select("vec_id", "rank", "neighbour_id", "score")


def _answers(g: Group) -> pa.RecordBatch:
    row, rank = np.nonzero(np.isfinite(g.score))
    return pa.RecordBatch.from_arrays([pa.array(g.ids[row]), pa.array(rank + 1, pa.int32()), pa.array(g.found[row, rank]), pa.array(g.score[row, rank])], ["vec_id", "rank", "neighbour_id", "score"])
