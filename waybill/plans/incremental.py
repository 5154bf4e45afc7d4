"""The SLA mart, brought up to date without making it anew.

The mart is kept in blocks along the delivery order. The index of the blocks has
for each where it begins, how many rows it holds, and the last six rows up to
its end. What new scans change are parcels: a delivery comes in, or moves, or a
pickup is earlier. The blocks in which a changed parcel stood or will stand are
made again, and the block after each, whose first frames reach back into it;
the rows before a stretch of such blocks come from the index. All other blocks
keep their files. A block that has grown to more than twice the size is cut.

Milestones per parcel are kept in runs, merged in tiers: of a changed parcel the
earliest pickup and the last delivery over all runs are what it had before.

The index has one entry per block and is part of the published version, like the
list of files that a reader of the mart needs anyway.
"""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, IntegerType, LongType, StringType, StructType, TimestampNTZType

from waybill import schemas
from waybill.operators.milestones import MILESTONE_SCANS, first_time, last_time, sla_flag, transit
from waybill.operators.ordering import as_of
from waybill.operators.rolling import rolling_rows
from waybill.plans.gold import COLUMNS, DELIVERY_ORDER
from waybill.session import remove, store
from waybill.sinks.batches import BatchSet
from waybill.sinks.runs import due
from waybill.sinks.versions import Versions
from waybill.sources.bronze import read_accepted

BLOCK_ROWS = 1_000_000
HALO = schemas.ROLLING_DELIVERIES - 1
ROLLED = "rolling_7_delivery_avg_hours"

BRONZE = StructType([*schemas.TELEMETRY]).add("source", StringType()).add("batch_id", IntegerType())
PARCEL = (StructType().add("tracking_number", StringType()).add("pickup_time", TimestampNTZType())
          .add("delivery_time", TimestampNTZType()))
MART = (StructType([*PARCEL]).add("transit_hours", DoubleType()).add(ROLLED, DoubleType())
        .add("is_sla_breached", BooleanType()))


class IncrementalMart:
    """The mart of a folder of bronze, below `root`, which must be shared storage on a cluster."""

    def __init__(self, spark: SparkSession, root: str, block_rows: int = BLOCK_ROWS):
        if block_rows < 1:
            raise ValueError("a block holds at least one row")
        self.spark, self.root, self.block_rows = spark, root.rstrip("/"), block_rows
        self._versions = Versions(spark, self.root)

    def _published(self) -> dict:
        return self._versions.current() or {"merged": [], "parcels": [], "blocks": [], "next": 0}

    def _fresh(self) -> str:
        return f"{self.root}/data/run={uuid.uuid4().hex}"

    def read(self) -> DataFrame:
        """The mart of the published version, in one scan."""
        return self._read_blocks(self._published()["blocks"]).select(*COLUMNS)

    def _read_blocks(self, blocks: list[dict]) -> DataFrame:
        schema = StructType([*MART]).add("run", StringType()).add("block", LongType())
        if not blocks:
            return self.spark.createDataFrame([], schema)
        paths = [f"{block['folder']}/block={block['number']}" for block in blocks]
        return self.spark.read.schema(schema).option("basePath", f"{self.root}/data").parquet(*paths)

    def refresh(self, bronze: str) -> bool:
        """Take over the batches of accepted records below `bronze` that the mart has not seen, in whatever order
        they came. Whether there were any. A failure leaves what is published as it is."""
        published = self._published()
        merged = BatchSet.from_facts(published["merged"])
        new = read_accepted(self.spark, bronze, BRONZE).filter(~merged.condition())
        batches = [tuple(row) for row in new.select("source", "batch_id").distinct().collect()]  # one row per new batch
        if not batches:
            return False
        made = []
        try:
            scans = new.filter(F.col("scan_type").isin(*MILESTONE_SCANS))
            delta = store(_milestones(scans, first_time(schemas.PICKUP), last_time(schemas.DELIVERED)), "delta")
            changes = store(self._changes(delta, published["parcels"]), "changes")
            taken, tier = due(published["parcels"])
            run = {"folder": self._fresh(), "tier": tier}
            made.append(run["folder"])
            added = _merged(self._read_parcels(taken).unionByName(delta)) if taken else delta
            added.write.parquet(run["folder"])
            blocks, following = published["blocks"], published["next"]
            if not changes.isEmpty():
                made.append(self._fresh())
                blocks, following = self._updated(blocks, following, changes, made[-1])
            parcels = [one for one in published["parcels"] if one not in taken] + [run]
            folders = dict.fromkeys([one["folder"] for one in (*parcels, *blocks)])
            self._versions.publish(list(folders), merged=merged.plus(batches).facts(), parcels=parcels, blocks=blocks,
                                   next=following)
        except BaseException:
            for folder in made:
                remove(self.spark, folder)
            raise
        return True

    def _read_parcels(self, runs: list[dict]) -> DataFrame:
        if not runs:
            return self.spark.createDataFrame([], PARCEL)
        return self.spark.read.schema(PARCEL).parquet(*[run["folder"] for run in runs])

    def _changes(self, delta: DataFrame, runs: list[dict]) -> DataFrame:
        """Delivered parcels whose milestones are new, with the delivery they had."""
        named = delta.select(F.col("tracking_number").alias("_number"), F.col("pickup_time").alias("_pickup"),
                             F.col("delivery_time").alias("_delivery"))
        same = F.col("tracking_number").eqNullSafe(F.col("_number"))
        known = _merged(self._read_parcels(runs).join(named.select("_number"), same, "left_semi"))
        pickup, delivery = F.least("pickup_time", "_pickup"), F.greatest("delivery_time", "_delivery")
        return (named.join(known, same, "left")
                .select(F.col("_number").alias("tracking_number"), pickup.alias("pickup_time"),
                        delivery.alias("delivery_time"), F.col("delivery_time").alias("old_delivery"),
                        F.col("pickup_time").alias("_old_pickup"))
                .filter(F.col("delivery_time").isNotNull()
                        & ~(F.col("delivery_time").eqNullSafe(F.col("old_delivery"))
                            & F.col("pickup_time").eqNullSafe(F.col("_old_pickup"))))
                .drop("_old_pickup"))

    def _updated(self, blocks: list[dict], following: int, changes: DataFrame, folder: str) -> tuple[list[dict], int]:
        """Make the blocks anew that the changes touch. All rows of one old block, the *home*, stay between its borders."""
        homes = blocks or [{"number": -1, "low": None, "rows": 0, "tail": []}]
        there = changes.select(*PARCEL.names, F.lit(True).alias("_new"))
        gone = changes.filter(F.col("old_delivery").isNotNull()).select(
            "tracking_number", "pickup_time", F.col("old_delivery").alias("delivery_time"), F.lit(False).alias("_new"))
        marks = self.spark.createDataFrame(
            [(*(_key(home["low"]) if i else (None, None)), i + 1) for i, home in enumerate(homes)],
            "delivery_time timestamp_ntz, tracking_number string, home bigint")
        placed = store(as_of(there.unionByName(gone), marks, DELIVERY_ORDER, "home"), "placed")
        again = self._again(homes, [row[0] - 1 for row in placed.select("home").distinct().collect()])
        before = self._before(homes, again)
        numbers = self.spark.createDataFrame([(homes[i]["number"], i + 1) for i in again], "block bigint, home bigint")
        changed = changes.select(F.col("tracking_number").alias("_number"))
        stay = (self._read_blocks([homes[i] for i in again] if blocks else []).join(F.broadcast(numbers), "block")
                .join(changed, F.col("tracking_number").eqNullSafe(F.col("_number")), "left_anti"))
        rows = transit(stay.select(*PARCEL.names, "home").unionByName(
            placed.filter("_new").select(*PARCEL.names, "home"))).unionByName(before)
        rolled = store(rolling_rows(rows, "transit_hours", DELIVERY_ORDER, ROLLED, index="_index")
                       .filter(F.col("home") > 0), "rolled")

        counted = {row["home"] - 1: row for row in rolled.groupBy("home").agg(
            F.count(F.lit(1)).alias("rows"), F.min("_index").alias("first")).collect()}  # one row per block made anew
        cuts, made = [], {}
        for i in again:
            if i not in counted:
                continue
            rows_now = counted[i]["rows"]
            size = self.block_rows if rows_now > 2 * self.block_rows else rows_now
            made[i] = range(following, following - -rows_now // size)
            cuts.append((i + 1, following, counted[i]["first"], size, rows_now))
            following = made[i].stop
        cut = self.spark.createDataFrame(cuts, "home bigint, _base bigint, _first bigint, _size bigint, _rows bigint")
        part = F.expr("(_index - _first) div _size")
        last = F.least((part + 1) * F.col("_size"), F.col("_rows")) - 1
        cut_rows = (rolled.join(F.broadcast(cut), "home").withColumn("block", F.col("_base") + part)
                    .withColumn("_left", last - (F.col("_index") - F.col("_first"))))
        (sla_flag(cut_rows).select(*COLUMNS, "block").hint("rebalance", "block")
         .write.partitionBy("block").parquet(folder))
        return self._indexed(homes, again, made, cut_rows, folder), following

    def _again(self, homes: list[dict], touched: list[int]) -> list[int]:
        """The blocks that are touched, and those after them whose frames reach back into one."""
        found = set(touched)
        for i in touched:
            for j in range(i + 1, len(homes)):
                found.add(j)
                if homes[j]["rows"] >= HALO:
                    break
        return sorted(found)

    def _before(self, homes: list[dict], again: list[int]) -> DataFrame:
        """The last rows before each stretch of blocks that are made anew, from the index."""
        anew = {homes[i]["number"] for i in again}
        rows = {tuple(row[:2]): row for i in again if i and homes[i - 1]["number"] not in anew
                for row in homes[i - 1]["tail"] if row[3] not in anew}
        schema = StructType([*PARCEL]).add("home", LongType()).add("transit_hours", DoubleType())
        return self.spark.createDataFrame([(number, None, datetime.fromisoformat(time), 0, hours)
                                           for time, number, hours, _ in rows.values()], schema)

    def _indexed(self, homes: list[dict], again: list[int], made: dict[int, range], cut_rows: DataFrame,
                 folder: str) -> list[dict]:
        """The index with the new blocks in the place of their homes."""
        key = F.struct(*DELIVERY_ORDER)
        stats = {row["block"]: row for row in cut_rows.groupBy("block").agg(
            F.count(F.lit(1)).alias("rows"), F.min(key).alias("low")).collect()}  # one row per new block
        tails: dict[int, list] = {}
        ends = cut_rows.filter(F.col("_left") < HALO).select("block", *DELIVERY_ORDER, "transit_hours", "_index")
        for row in sorted(ends.collect(), key=lambda row: row["_index"]):  # at most six rows per new block
            tails.setdefault(row["block"], []).append(
                [row["delivery_time"].isoformat(), row["tracking_number"], row["transit_hours"], row["block"]])
        blocks: list[dict] = []
        anew = set(again)
        for i, home in enumerate(homes):
            new = [home]
            if i in anew:
                new = [{"number": number, "folder": folder, "rows": stats[number]["rows"], "tail": tails[number],
                        "low": home["low"] if place == 0 else [stats[number]["low"][0].isoformat(), stats[number]["low"][1]]}
                       for place, number in enumerate(made.get(i, ()))]
            for block in new:
                # The rows of a short block alone are no whole frame; what stands before it may have changed.
                own, carried = block["tail"][-block["rows"]:], blocks[-1]["tail"] if blocks else []
                blocks.append({**block, "tail": [*carried, *own][-HALO:]})
        return blocks


def _key(low: list) -> tuple:
    return datetime.fromisoformat(low[0]), low[1]


def _milestones(rows: DataFrame, pickup, delivery) -> DataFrame:
    return rows.groupBy("tracking_number").agg(pickup.alias("pickup_time"), delivery.alias("delivery_time"))


def _merged(parcels: DataFrame) -> DataFrame:
    """Several runs, stacked, as one."""
    return _milestones(parcels, F.min("pickup_time"), F.max("delivery_time"))
