"""Work over one global order without putting all rows into one task.

`in_order` range-partitions the rows, sorts every range and stores them with
their position. Ranges follow the whole sort key, so a crowded hour or even a
crowded instant is spread over several of them as long as the key is unique.
What has to cross a range border is one total per range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waybill.session import store

_POSITION_BITS = 33


def in_order(df: DataFrame, *order: str, label: str) -> DataFrame:
    """Rows with `_range` and, within it, `_position`, both in the given order.

    The tags are written out before anything reads them: range borders are
    sampled, and a second evaluation could place them elsewhere.
    """
    tagged = (df.repartitionByRange(*order).sortWithinPartitions(*order)
              .withColumn("_tag", F.monotonically_increasing_id()))
    return store(tagged, label).select(
        *df.columns,
        F.shiftright("_tag", _POSITION_BITS).alias("_range"),
        F.col("_tag").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1)).alias("_position"),
    )


def before_range(ordered: DataFrame, how=F.sum, **totals: Column) -> DataFrame:
    """Per range, the totals over all earlier ranges, added up by `how`. One row per range."""
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sums = ordered.groupBy("_range").agg(*[total.alias(name) for name, total in totals.items()])
    return sums.select("_range", *[F.coalesce(how(name).over(earlier), F.lit(0)).alias(name) for name in totals])


def as_of(points: DataFrame, marks: DataFrame, order: tuple[str, ...], number: str) -> DataFrame:
    """The points with the `number` of the last mark at or before each, by `order`.

    `marks` has the columns of `order` and `number`, which is positive and rises along the order, and one mark comes before all points. The
    two are sorted as one, and the greatest number so far goes along, so neither side is broadcast.
    """
    both = points.withColumn(number, F.lit(None).cast("bigint")).withColumn("_point", F.lit(True)).unionByName(
        marks.withColumn(number, F.col(number).cast("bigint")).withColumn("_point", F.lit(False)), allowMissingColumns=True)
    ordered = in_order(both, *order, "_point", label="as-of")
    # As many rows as there are ranges, which is at most the shuffle partitions.
    before = F.broadcast(before_range(ordered, F.max, _earlier=F.max(number)))
    so_far = Window.partitionBy("_range").orderBy("_position").rowsBetween(Window.unboundedPreceding, 0)
    return (ordered.join(before, "_range").withColumn(number, F.greatest("_earlier", F.max(number).over(so_far)))
            .filter("_point").select(*points.columns, number))


def running_totals(df: DataFrame, order: str, *values: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Replace each of `values` by its running total along `order`, which must
    be unique; `keep` names columns to leave as they are."""
    ordered = in_order(df.select(order, *keep, *values), order, label="running")
    # As many rows as there are ranges, which is at most the shuffle partitions.
    before = F.broadcast(before_range(ordered, **{f"_before_{name}": F.sum(name) for name in values}))
    window = Window.partitionBy("_range").orderBy("_position").rowsBetween(Window.unboundedPreceding, 0)
    return ordered.join(before, "_range").select(
        order, *keep, *[(F.col(f"_before_{name}") + F.sum(name).over(window)).alias(name) for name in values])
