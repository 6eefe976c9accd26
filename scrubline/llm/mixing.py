"""Mixing sources to target weights by Poisson replication, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scrubline.llm.common import written

# A draw's mean stays under this; above it, a document makes several independent draws.
MEAN_PER_DRAW = 8
# P(X > 64) at that mean is far below the resolution of a draw.
TERMS = 64
BROADCAST_SOURCES = 10_000


def uniform(*parts: Column | str) -> Column:
    """A number in [0, 1) of 52 bits from the MD5 of the parts."""
    digest = F.md5(F.concat_ws("|", *parts))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def poisson(mean: Column, u: Column) -> Column:
    """The Poisson variate of this mean (up to ``MEAN_PER_DRAW``) at probability ``u``, by inversion."""
    p0 = F.exp(-mean)
    start = F.struct(p0.alias("p"), p0.alias("cdf"), (u >= p0).cast("int").alias("k"))

    def step(acc: Column, i: Column) -> Column:
        p = acc["p"] * mean / i
        cdf = acc["cdf"] + p
        more = ((u >= cdf) & (p > F.lit(1e-18))).cast("int")
        return F.struct(p.alias("p"), cdf.alias("cdf"), (acc["k"] + more).alias("k"))

    terms = F.sequence(F.lit(1), F.lit(TERMS)).cast("array<double>")
    return F.aggregate(terms, start, step, lambda acc: acc["k"])


def mix(
    docs: DataFrame,
    weights: DataFrame | float,
    seed: int = 42,
    total: int | None = None,
    id_col: str = "doc_id",
    source_col: str = "source",
) -> DataFrame:
    """Repeat documents so that sources get the wanted share of ``total`` rows, and shuffle all.

    ``weights``: a table (source, weight), or an exponent that turns each source's
    number of documents into its weight. A source's documents are repeated
    ``total * share / documents`` times on average; how often one is, follows from
    its id and the seed alone, so rows with equal ids are repeated alike. Sources
    without a weight, or with a weight of 0, go. A null source is a source of its own.

    Adds ``copy`` (from 0) and ``mix_key``; rows are dealt out and sorted by the key.
    Clashing input columns of these names are replaced.
    """
    docs = docs.drop("copy", "mix_key")
    sizes = docs.groupBy(F.col(source_col).alias("__source")).agg(F.count("*").alias("__size"))
    if isinstance(weights, DataFrame):
        given = weights.select(F.col("source").alias("__of"), F.col("weight").cast("double").alias("__weight"))
        given = given.filter("__weight > 0").groupBy("__of").agg(F.sum("__weight").alias("__weight"))
        sizes = sizes.join(given, F.col("__source").eqNullSafe(F.col("__of"))).drop("__of")
    else:
        sizes = sizes.withColumn("__weight", F.pow(F.col("__size").cast("double"), F.lit(float(weights))))
    sizes = written(sizes, "mix-sources")

    whole = sizes.agg(F.sum("__weight"), F.sum("__size"), F.count("*")).first()
    wanted = float(total if total is not None else whole[1] or 0)
    mean = F.col("__weight") / F.lit(whole[0] or 1.0) * F.lit(wanted) / F.col("__size")
    rates = sizes.select("__source", mean.alias("__mean"))
    draws = F.greatest(F.lit(1), F.ceil(F.col("__mean") / MEAN_PER_DRAW)).cast("int")
    rates = rates.withColumn("__draws", draws).withColumn("__mean", F.col("__mean") / F.col("__draws"))
    if whole[2] <= BROADCAST_SOURCES:
        rates = F.broadcast(rates)

    key = F.coalesce(F.col(id_col).cast("string"), F.lit("null"))
    drawn = docs.join(rates, F.col(source_col).eqNullSafe(F.col("__source")))
    counts = F.aggregate(
        F.sequence(F.lit(0), F.col("__draws") - 1),
        F.lit(0),
        lambda acc, d: acc + poisson(F.col("__mean"), uniform(F.lit(str(seed)), key, d.cast("string"))),
    )
    copies = (
        drawn.withColumn("__count", counts)
        .filter("__count > 0")
        .withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("__count") - 1)))
    )
    order = F.md5(F.concat_ws("|", F.lit(f"order{seed}"), key, F.col("copy").cast("string")))
    keyed = copies.withColumn("mix_key", F.conv(F.substring(order, 1, 15), 16, 10).cast("long"))
    keyed = keyed.select(*docs.columns, "copy", "mix_key")
    return keyed.repartition("mix_key").sortWithinPartitions("mix_key")
