"""Mixing sources to target weights by Poisson replication. DataFrame functions only."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weir.llm.common import every, partitions, private


@dataclass(frozen=True)
class Mix:
    """weights: target share of each source; of sources not named, and where None, size ** `power`.

    size: rows of the result, as a multiple of the input's, in expectation.
    few: sources up to which their rates are broadcast (a row of a few hundred bytes each); above, they are joined.
    """

    weights: dict[str, float] | None = None
    power: float = 0.7
    size: float = 1.0
    seed: int = 17
    few: int = 2000


def uniform(key: Column) -> Column:
    """A number in [0, 1) from 52 bits of the MD5 of a text."""
    return F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("double") / float(1 << 52)


def rates(docs: DataFrame, mix: Mix) -> DataFrame:
    """source and cdf of each: the Poisson probabilities of at most 0, 1, 2, ... copies at its mean repetition rate.

    Rates over 30 are split into equal parts of which each is drawn for itself, so that no probability underflows.
    """
    counts = docs.groupBy(F.coalesce("source", F.lit("")).alias("source")).agg(F.count("*").alias("n"))
    weight = F.pow("n", F.lit(mix.power))
    for name, w in sorted((mix.weights or {}).items()):
        weight = F.when(F.col("source") == name, F.lit(float(w))).otherwise(weight)
    weighed = counts.withColumn("weight", weight)
    total = weighed.agg(F.sum("weight").alias("all_weights"), F.sum("n").alias("all_rows"))
    rate = F.lit(mix.size) * F.col("all_rows") * F.col("weight") / F.col("all_weights") / F.col("n")
    out = weighed.join(F.broadcast(total), F.lit(True)).select("source", "n", F.coalesce(rate, F.lit(0.0)).alias("rate"))  # one row
    out = out.withColumn("parts", F.greatest(F.lit(1), F.ceil(F.col("rate") / 30)).cast("int"))
    one = F.col("rate") / F.col("parts")
    steps = F.sequence(F.lit(1), F.ceil(one + 12 * F.sqrt(one) + 20).cast("int"))
    start = F.struct(F.exp(-one).alias("p"), F.array(F.exp(-one)).alias("cdf"))
    add = lambda a, k: F.struct((a.p * one / k).alias("p"), F.concat(a.cdf, F.array(F.element_at(a.cdf, -1) + a.p * one / k)).alias("cdf"))
    return out.withColumn("cdf", F.aggregate(steps, start, add, lambda a: a.cdf))


def mixed(docs: DataFrame, mix: Mix = Mix(), number: str | None = "copy") -> DataFrame:
    """docs, each row as often as its Poisson number says, with the copy's `number` (0, 1, ...), in globally shuffled order.

    The number of copies is the inverse of the source's Poisson distribution at a uniform number made from seed, doc_id and part, so
    every run and every partitioning gives the same rows. Its mean is the source's target share of the result over its
    share of the input. Null sources are one source, named by the empty text; a null doc_id is drawn as the empty text, rows with one
    doc_id alike. Texts of any length travel once, to the partition that a hash of doc_id and copy gives, and are sorted there by it.
    An empty table gives no rows. All columns stay, whatever their names, but one that is named as the copy's number, which
    that replaces; without a name no number is added.
    """
    source, parts, cdf, key, copy, order = private(docs.columns, "_source", "_parts", "_cdf", "_key", "_copy", "_order")
    r = rates(docs.select("source"), mix).select(F.col("source").alias(source), F.col("parts").alias(parts), F.col("cdf").alias(cdf))
    r = F.broadcast(r) if r.limit(mix.few + 1).count() <= mix.few else r
    joined = docs.join(r, F.coalesce(docs["source"], F.lit("")) == F.col(source))
    joined = joined.withColumn(key, F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    part = lambda k: uniform(F.concat(F.lit(f"{mix.seed}:"), F.col(key), F.lit(":"), k.cast("string")))
    drawn = F.transform(F.sequence(F.lit(1), F.col(parts)), part)
    n = F.aggregate(drawn, F.lit(0), lambda a, u: a + F.size(F.filter(cdf, lambda c: c <= u)))
    copies = joined.withColumn(parts, n).where(F.col(parts) > 0).withColumn(copy, F.explode(F.sequence(F.lit(0), F.col(parts) - 1)))
    placed = copies.withColumn(order, F.xxhash64(F.lit(mix.seed), key, copy))
    placed = placed.repartition(partitions(docs.sparkSession), order).sortWithinPartitions(order, copy)
    if number is None:
        return placed.select(*every(docs))
    own = [c for c, name in zip(every(docs), docs.columns, strict=True) if name.lower() != number.lower()]
    return placed.select(*own, F.col(copy).alias(number))
