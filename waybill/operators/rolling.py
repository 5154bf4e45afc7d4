"""Rolling averages along the delivery order.

Both have no partition key, and a plain window would pull every row into one
task. Positions in the whole order are written to scratch first, so building
these results runs jobs; `clear_scratch` removes what they leave.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from waybill import schemas
from waybill.functions.time import micros_between
from waybill.operators.ordering import before_range, in_order
from waybill.session import store

BLOCK_ROWS = 250_000
# Steps of one minute that a task takes as they are.
HOT_ROWS = 50_000
# In microseconds.
MINUTE, DAY = 60_000_000, 86_400_000_000


def rolling_rows(df: DataFrame, value: str, order: tuple[str, ...], output: str,
                 rows: int = schemas.ROLLING_DELIVERIES, block_rows: int = BLOCK_ROWS,
                 index: str | None = None) -> DataFrame:
    """Average of `value` over the current and the `rows - 1` rows before it.

    Rows with a NULL value take a place in the frame and do not count in the
    average. `order` should be unique, or the frames are not determined. The
    order is cut into blocks of equal size; the last rows of each block are also
    sent to the next one, where they only fill frames. `index` names a column
    for the place of each row in the whole order, from 0.
    """
    halo = rows - 1
    if block_rows < max(halo, 1):
        raise ValueError("a block must hold at least one whole frame")
    ordered = in_order(df, *order, label="rolling")
    # As many rows as there are ranges, which is at most the shuffle partitions.
    before = F.broadcast(before_range(ordered, _before=F.count(F.lit(1))))
    place = F.col("_before") + F.col("_position")
    numbered = ordered.join(before, "_range").select(*df.columns, place.alias("_index"))
    home = F.expr(f"_index div {block_rows}")
    is_tail = F.col("_index") % block_rows >= block_rows - halo
    blocks = F.when(is_tail, F.array(home, home + 1)).otherwise(F.array(home))
    frame = Window.partitionBy("_block").orderBy("_index").rowsBetween(-halo, 0)
    return (
        numbered.withColumn("_block", F.explode(blocks))
        .withColumn(output, F.avg(value).over(frame))
        .filter(F.col("_block") == home)
        .select(*df.columns, output, *([F.col("_index").alias(index)] if index else []))
    )


def rolling_days(df: DataFrame, value: str, time: str, output: str,
                 days: int = schemas.ROLLING_DAYS, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Average of the integer column `value` over the `days` days up to `time`; NULL where `time` is.

    A row adds its value at its own time and takes it back one microsecond
    after the frame has moved past it, so that the running total of these steps
    is the sum over the frame. Steps are added up per minute, and minutes per
    day; what was added before a minute is then known for every minute, and the
    rest is a running total within it. Rows travel once, with their minute.

    Of a minute with more than `hot_rows` steps these are first added up per
    instant, at most sixty million of them, and its rows are joined with the
    instants, where crowded ones are split. Integer sums are exact, whatever the order.
    """
    df = store(df, "rolling-days")  # read twice: for the minutes and for the rows
    at = micros_between(F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col(time))
    known = F.col(value).isNotNull().cast("bigint")
    amount = F.coalesce(F.col(value), F.lit(0)).cast("decimal(19,0)")
    row = F.struct(*[F.col(name) for name in df.columns])
    steps = df.filter(F.col(time).isNotNull()).select(F.inline(F.array(
        F.struct(at.alias("_at"), amount.alias("_sum"), known.alias("_count"), row.alias("_row")),
        F.struct((at + days * DAY + 1).alias("_at"), (-amount).alias("_sum"), (-known).alias("_count"),
                 F.when(F.lit(False), row).alias("_row")),
    ))).withColumn("_minute", F.expr(f"(_at - pmod(_at, {MINUTE})) div {MINUTE}"))
    minutes = steps.groupBy("_minute").agg(F.sum("_sum").alias("_sum"), F.sum("_count").alias("_count"),
                                           F.count(F.lit(1)).alias("_steps")).withColumn(
        "_range", F.floor(F.col("_minute") / (DAY // MINUTE)))
    minutes = store(minutes, "rolling-minutes")
    # One row per day.
    earlier_days = F.broadcast(before_range(minutes, _day_sum=F.sum("_sum"), _day_count=F.sum("_count")))
    earlier = Window.partitionBy("_range").orderBy("_minute").rowsBetween(Window.unboundedPreceding, -1)
    before = store(minutes.join(earlier_days, "_range").select(
        "_minute", "_steps",
        (F.col("_day_sum") + F.coalesce(F.sum("_sum").over(earlier), F.lit(0))).alias("_before_sum"),
        (F.col("_day_count") + F.coalesce(F.sum("_count").over(earlier), F.lit(0))).alias("_before_count")),
        "rolling-before")

    so_far = Window.partitionBy("_minute").orderBy("_at")  # with all steps of the same instant
    total = F.col("_before_sum") + F.sum("_sum").over(so_far)
    count = F.col("_before_count") + F.sum("_count").over(so_far)

    def averaged(rows: DataFrame, name: str) -> DataFrame:
        return (rows.withColumn("_total", total).withColumn("_number", count)
                .withColumn(name, F.when(F.col("_number") > 0, F.col("_total").cast("double") / F.col("_number"))))

    def usual(steps: DataFrame) -> DataFrame:
        rows = averaged(steps.join(before, "_minute"), output).filter(F.col("_row").isNotNull()).select("_row.*", output)
        return rows.unionAll(df.filter(F.col(time).isNull()).withColumn(output, F.lit(None).cast("double")))

    # At most one minute for every `hot_rows` steps.
    hot = F.broadcast(before.filter(F.col("_steps") > hot_rows))
    if hot.isEmpty():
        return usual(steps)
    crowded = steps.join(hot, "_minute")
    instants = crowded.groupBy("_minute", "_at", "_before_sum", "_before_count").agg(
        F.sum("_sum").alias("_sum"), F.sum("_count").alias("_count"))
    found = averaged(instants, output).select("_at", output)
    rows = crowded.filter(F.col("_row").isNotNull()).select("_at", "_row")
    others = steps.join(hot.select("_minute"), "_minute", "left_anti")
    return usual(others).unionAll(rows.join(found, "_at", "left").select("_row.*", output))
