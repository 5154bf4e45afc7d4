"""Mixing sources to target weights by Poisson replication.

A source's repetition rate is its share of the output over its share of the
input. Every document draws its number of copies from a Poisson distribution
with that mean by inverting it at a hash of seed and id, is exploded by the
number, and the copies are dealt out and sorted by a hash of their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waybill.llm.columns import free_name, quoted
from waybill.llm.scratch import Scratch

# A rate is split into equal parts of at most this mean, whose draws add up to a Poisson draw again.
PART_RATE = 16
# Beyond so many events the distribution of a part is 1 in doubles.
TERMS = 120
BROADCAST_SOURCES = 10_000


def _uniform(*parts: Column) -> Column:
    """A number strictly between 0 and 1 from a hash of `parts`."""
    digits = F.substring(F.md5(F.concat_ws("|", *parts)), 1, 12)
    return (F.conv(digits, 16, 10).cast("bigint") + F.lit(0.5)) / F.lit(float(1 << 48))


def _cumulative(rate: Column) -> Column:
    """The distribution function of a Poisson variable at 0, 1, 2 and so on."""
    start = F.struct(F.exp(-rate).alias("term"), F.array(F.exp(-rate)).alias("sums"))

    def add(state: Column, k: Column) -> Column:
        term = state["term"] * rate / k
        return F.struct(term.alias("term"), F.array_append(state["sums"], F.element_at(state["sums"], -1) + term)
                        .alias("sums"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(TERMS)), start, add, lambda state: state["sums"])


def rates(docs: DataFrame, weights: dict[str | None, float] | None = None, tempering: float = 0.5,
          epochs: float = 1.0) -> DataFrame:
    """`source`, `documents` and `rate` of every source.

    Without `weights` a source weighs as its number of documents to the power
    `tempering`. With them, unnamed sources weigh nothing. The output has
    `epochs` times as many documents as the input, in the mean. A null source
    is a source.
    """
    sizes = docs.groupBy("source").agg(F.count(F.lit(1)).alias("documents"))
    if weights is None:
        weighed = sizes.withColumn("_weight", F.pow(F.col("documents").cast("double"), F.lit(float(tempering))))
    else:
        given = docs.sparkSession.createDataFrame(
            [(str(name) if name is not None else None, float(weight)) for name, weight in weights.items()],
            "_name string, _weight double")
        weighed = (sizes.join(given, F.col("source").cast("string").eqNullSafe(F.col("_name")), "left")
                   .withColumn("_weight", F.coalesce("_weight", F.lit(0.0))).drop("_name"))
    # Two numbers over the sources, not over the documents.
    everything, weight = weighed.agg(F.sum("documents"), F.sum("_weight")).first()
    if not weight:
        return weighed.select("source", "documents", F.lit(0.0).alias("rate"))
    rate = F.lit(float(epochs)) * F.lit(everything) * F.col("_weight") / (F.lit(weight) * F.col("documents"))
    return weighed.select("source", "documents", rate.alias("rate"))


def replicate(docs: DataFrame, weights: dict[str | None, float] | None = None, tempering: float = 0.5,
              epochs: float = 1.0, seed: int = 0) -> DataFrame:
    """The columns of `docs` and `copy` (0, 1, ...; with underscores if the name
    is taken), each document as often as it draws, in an order that depends on
    the seed alone.

    `docs` needs `doc_id` and `source`. Rows with the same id, null included,
    draw the same uniform number; texts may be null or empty. An empty table
    gives an empty result.
    """
    spark = docs.sparkSession
    found = rates(docs, weights, tempering, epochs)
    parts = F.greatest(F.ceil(F.col("rate") / PART_RATE), F.lit(1)).cast("int")
    found = found.withColumn("parts", parts).withColumn("sums", _cumulative(F.col("rate") / F.col("parts")))
    # Rates come from sums over all documents: stored, they are the same for every task.
    found = Scratch(spark, "mixing").store(found.select(F.col("source").alias("_source"), "parts", "sums"), "rates")
    source, number, copy, order = (free_name(docs, name) for name in ("_source", "_copies", "copy", "_order"))
    few = found.count() <= BROADCAST_SOURCES
    found = found.withColumnsRenamed({"_source": source, "parts": f"{number}p", "sums": f"{number}s"})
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))

    def drawn(part: Column) -> Column:
        chance = _uniform(F.lit(str(seed)), name, part.cast("string"))
        return F.size(F.filter(F.col(f"{number}s"), lambda reached: reached < chance))

    copies = F.aggregate(F.sequence(F.lit(1), F.col(f"{number}p")), F.lit(0), lambda sum_, part: sum_ + drawn(part))
    counted = (docs.join(F.broadcast(found) if few else found, F.col("source").eqNullSafe(F.col(source)))
               .withColumn(number, copies).filter(F.col(number) > 0))
    exploded = counted.withColumn(copy, F.explode(F.sequence(F.lit(0), F.col(number) - 1)))
    shuffled = exploded.withColumn(order, F.md5(F.concat_ws("|", F.lit(f"order {seed}"), name, F.col(copy))))
    return (shuffled.select(*[quoted(column) for column in docs.columns], copy, order).repartition(order)
            .sortWithinPartitions(order, copy).drop(order))
