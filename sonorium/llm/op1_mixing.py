"""Mixing sources to target weights by Poisson replication.

A source of n documents that is to make up the share w of a mixture of T documents has the mean
repetition rate w * T / n. Every document draws its own number of repetitions by inverting that Poisson
distribution at a uniform number hashed from its id and the seed: no state, the same draw in any order,
on any retry. Rates above ``PIECE`` are drawn as a sum of independent Poisson pieces, which keeps the
tables of the distribution short and exp() away from underflow. Copies are then shuffled globally: a
hashed partition for each copy and a hashed order inside it, which needs no sampling pass and no
range boundaries.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, fresh, key_text, maybe_broadcast, partitions

SEED = 20
#: Sources without an explicit target share the rest of the weight in proportion to n ** POWER.
POWER = 0.5
#: Length of the mixture in multiples of the input's documents.
EPOCHS = 1.0
PIECE = 32.0
TERMS = 120  # P(X >= 120) at a mean of 32 is below 2 ** -53


def uniform(*parts: Column | str) -> Column:
    """52 bits of MD5 as a number in [0, 1); the same in any SQL engine."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts)), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def rates(docs: DataFrame, targets: dict[str, float] | None = None, epochs: float = EPOCHS, power: float = POWER) -> DataFrame:
    """(source, n_docs, weight, rate) of every source; null is a source of its own.

    Weights are normalised to 1 over the sources present; those in ``targets`` weigh as given, the others
    share what is left of 1 (nothing, if the targets sum to 1 or more) by n ** power.
    """
    n = cut(docs.groupBy(F.col("source").cast("string").alias("source")).agg(F.count("*").alias("n_docs")), "sources")  # used several times
    raw = F.pow(F.col("n_docs").cast("double"), F.lit(power))
    if targets:
        given = F.create_map(*[x for k, v in targets.items() for x in (F.lit(k), F.lit(float(v)))])
        target = F.when(F.col("source").isNotNull(), F.try_element_at(given, F.coalesce("source", F.lit(""))))
        left = max(0.0, 1.0 - sum(targets.values()))
        n = n.withColumn("target", target)
        others = n.agg(F.sum(F.when(F.col("target").isNull(), raw)).alias("others"))
        n = n.crossJoin(others).withColumn("raw", F.coalesce("target", F.lit(left) * raw / F.col("others"))).drop("target", "others")
    else:
        n = n.withColumn("raw", raw)
    total = n.agg(F.sum("raw").alias("raw_total"), F.sum("n_docs").alias("docs_total"))
    weight = F.when(F.col("raw_total") > 0, F.col("raw") / F.col("raw_total")).otherwise(0.0)
    return n.crossJoin(total).withColumn("weight", weight).select("source", "n_docs", "weight", (F.col("weight") * F.lit(float(epochs)) * F.col("docs_total") / F.col("n_docs")).alias("rate"))


def distributions(rate: DataFrame) -> DataFrame:
    """rates() with pieces (how many draws are summed) and cdf, the array P(X <= k) of one piece."""
    pieces = F.greatest(F.lit(1), F.ceil(F.col("rate") / F.lit(PIECE)).cast("int"))
    start = F.struct(F.array().cast("array<double>").alias("cdf"), F.lit(0.0).alias("p"), F.lit(0.0).alias("sum"))

    def step(acc: Column, k: Column) -> Column:
        p = F.when(k == 0, F.exp(-F.col("mean"))).otherwise(acc["p"] * F.col("mean") / k)
        return F.struct(F.concat(acc["cdf"], F.array(acc["sum"] + p)).alias("cdf"), p.alias("p"), (acc["sum"] + p).alias("sum"))

    return rate.withColumn("pieces", pieces).withColumn("mean", F.col("rate") / F.col("pieces")).withColumn("cdf", F.aggregate(F.sequence(F.lit(0), F.lit(TERMS)), start, step, lambda a: a["cdf"])).drop("mean")


def mix_sources(docs: DataFrame, targets: dict[str, float] | None = None, epochs: float = EPOCHS, power: float = POWER, seed: int = SEED, columns: list[str] | None = None, copy: str | None = None) -> DataFrame:
    """docs with every row repeated as often as its Poisson draw says, in a global random order.

    ``columns`` restricts the columns, ``copy`` names a column for the number of the copy, from 0.

    A null source is a source of its own. Rows that share a doc_id share their draw, and each is repeated
    that often; a row without doc_id draws by its text (null as empty). An empty table gives an empty
    table. Extra columns are kept whatever their names, and a ``copy`` that one of them has gets underscores. Very long
    texts are carried whole.
    """
    spark = docs.sparkSession
    keep = columns or docs.columns
    who, src, reps, no = (fresh(docs, c) for c in ("mix_key", "mix_source", "mix_reps", "mix_copy"))
    dist = distributions(rates(docs, targets, epochs, power))
    dist = maybe_broadcast(dist.select(F.col("source").alias(src), F.col("pieces").alias(reps), F.col("cdf").alias(no)), row_bytes=64 + 8 * (TERMS + 1))
    keyed = docs.withColumn(who, key_text(F.col("doc_id"), F.col("text"))).alias("d")
    drawn = keyed.join(dist.alias("r"), F.col("d.source").cast("string").eqNullSafe(F.col(f"r.{src}")))
    one = lambda i: F.size(F.filter(F.col(f"r.{no}"), lambda c: c <= uniform(F.lit(str(seed)), F.col(f"d.{who}"), i.cast("string"))))
    count = F.aggregate(F.sequence(F.lit(1), F.col(f"r.{reps}")), F.lit(0), lambda a, i: a + one(i))
    drawn = drawn.select(*[F.col(f"d.`{c}`") for c in keep], F.col(f"d.{who}").alias(who), count.alias(reps)).filter(F.col(reps) > 0)
    copies = drawn.withColumn(no, F.explode(F.sequence(F.lit(0), F.col(reps) - 1)))
    while copy and copy.lower() in {c.lower() for c in keep}:
        copy += "_"
    spot = F.xxhash64(F.lit(seed), F.col(who), F.col(no))
    out = copies.withColumn(reps, spot).repartition(partitions(spark), reps).sortWithinPartitions(reps)
    return out.select(*[F.col(f"`{c}`") for c in keep], *([F.col(no).alias(copy)] if copy else []))
