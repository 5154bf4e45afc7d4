"""The registered queries, each over the whole `events` table of a test folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from waybill import schemas
from waybill.functions.text import batch_label, record_json, telemetry_json
from waybill.functions.time import iso_text, iso_to_timestamp
from waybill.operators import contracts, latest, milestones, quality, rolling, status
from waybill.operators.audit import offset_audit
from waybill.plans import gold, medallion
from waybill.plans.incremental import IncrementalMart
from waybill.query_data import file_count, read_events, stream_events, telemetry, telemetry_messages, webhook_requests
from waybill.session import scratch_path, store
from waybill.sinks.files import ACCEPTED, PLACE, REJECTED, outcome_path, write_batch, write_bronze
from waybill.sinks.replay import replay_rejects
from waybill.sinks.tables import ensure_database, write_table
from waybill.sinks.webhooks import compact, current_events, upsert_events
from waybill.sources.bronze import read_accepted, read_bronze, read_rejects
from waybill.sources.topic import messages
from waybill.sources.samples import register, stacked, staged_scans
from waybill.sources.variants import damaged_files, elements, field_kinds, inferred, merged_kinds, read_documents, telemetry_of
from waybill.sources.webhook import read_webhooks
from waybill.streaming.flags import flag_sink, read_flags
from waybill.streaming.ingest import BatchSink, bronze_sink, drain, webhook_sink

# Doubles are compared after rounding: the last bits depend on summation order.
DIGITS = 6


def _rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({name: F.round(name, DIGITS) for name in names})


def _scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return telemetry(read_events(spark, sf_dir))


def _milestone_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return telemetry(read_events(spark, sf_dir), milestones.MILESTONE_SCANS)


def _parcels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return milestones.milestones(_milestone_scans(spark, sf_dir))


def _mart(df: DataFrame) -> DataFrame:
    return _rounded(df, "transit_hours", "rolling_7_delivery_avg_hours")


# Gold.

def gold_sla(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mart(gold.gold_sla(_milestone_scans(spark, sf_dir)))


def milestone_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _parcels(spark, sf_dir)


def transit_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    hours = milestones.transit(_parcels(spark, sf_dir)).select("tracking_number", "transit_hours")
    return _rounded(hours, "transit_hours")


def sla_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    flagged = _parcels(spark, sf_dir).transform(milestones.transit).transform(milestones.sla_flag)
    return flagged.select("tracking_number", "is_sla_breached")


def rolling_7_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    parcels = milestones.transit(_parcels(spark, sf_dir))
    rolled = rolling.rolling_rows(parcels, "transit_hours", gold.DELIVERY_ORDER, "rolling_7_delivery_avg_hours")
    return _rounded(rolled, "rolling_7_delivery_avg_hours").select("tracking_number", "rolling_7_delivery_avg_hours")


def rolling_7_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    rolled = gold.rolling_week(_parcels(spark, sf_dir))
    return _rounded(rolled, "rolling_7_day_avg_hours").select("tracking_number", "rolling_7_day_avg_hours")


def gold_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mart through staging views and a catalog table."""
    staged = register("stg_scans", _milestone_scans(spark, sf_dir))
    ensure_database(spark, "waybill", scratch_path(spark, "database"))
    return _mart(write_table(gold.gold_sla(staged), "waybill.sla_mart_by_query", scratch_path(spark, "gold")))


def staging_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return register("stg_scans_all", staged_scans(_scans(spark, sf_dir)))


def staging_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scans of the topic and events of the webhook under each other."""
    hooks = contracts.accepted(_checked_webhooks(spark, sf_dir), contracts.WEBHOOK)
    return stacked(staged_scans(_scans(spark, sf_dir)), hooks.select("event_id", "tracking_number", "scan_type", "timestamp"))


# Silver.

def silver_clean_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return status.clean_events(_scans(spark, sf_dir))


def silver_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(status.status_summary(_scans(spark, sf_dir), schemas.TELEMETRY_SCANS), "avg_latency")


def silver_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver without any rounding, from the summaries of three parts of the events."""
    scans = _scans(spark, sf_dir)
    parts = [medallion.parcel_summary(scans.filter(F.col("event_id") % 3 == part)) for part in range(3)]
    summed = medallion.add_summaries(parts[0].unionByName(parts[1]).unionByName(parts[2]))
    return medallion.silver_of(summed)


def silver_latest_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return status.latest_scan(_scans(spark, sf_dir))


def silver_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "silver")
    status.status_summary(_scans(spark, sf_dir), schemas.TELEMETRY_SCANS).write.parquet(path)
    return _rounded(spark.read.parquet(path), "avg_latency")


# Quality gate.

def gate_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.run_gate(_scans(spark, sf_dir))


def gate_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.violations(_scans(spark, sf_dir)).select("event_id", "tracking_number", "ping_latency_ms")


def gate_halt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A gate with a tighter limit, and whether it lets later steps run."""
    found = quality.run_gate(_scans(spark, sf_dir), (quality.not_null("tracking_number"),
                                                     quality.between("ping_latency_ms", 0, 50, schemas.LATENCY_MOSTLY)))
    try:
        quality.enforce(found)
        halted = False
    except quality.QualityGateError:
        halted = True
    return found.withColumn("halted", F.lit(halted))


def gate_no_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gate over scans of a type that none has: no rows pass."""
    return quality.run_gate(_scans(spark, sf_dir).filter(F.col("scan_type") == "RETURNED"))


# Contracts.

def _checked_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contracts.validate(telemetry_messages(read_events(spark, sf_dir)), contracts.TELEMETRY)


def _checked_webhooks(spark: SparkSession, sf_dir: str) -> DataFrame:
    requests = webhook_requests(read_events(spark, sf_dir))
    return contracts.validate(read_webhooks(requests), contracts.WEBHOOK)


def contract_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contracts.accepted(_checked_messages(spark, sf_dir), contracts.TELEMETRY, "sent_at")


def contract_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    rejects = contracts.rejected(_checked_messages(spark, sf_dir), contracts.TELEMETRY, "event_id")
    return rejects.select("event_id", "tracking_number", "reason", F.size("reasons").alias("reason_count"))


def batch_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (_checked_messages(spark, sf_dir).groupBy(F.expr("event_id div 100").alias("batch_id"))
            .agg(batch_label(F.min("sent_at")).alias("batch_label"), F.count(F.lit(1)).alias("rows"),
                 F.count_if(contracts.is_accepted()).alias("valid")))


def webhook_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contracts.webhook_status(_checked_webhooks(spark, sf_dir), "arrival")


def webhook_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = contracts.accepted(_checked_webhooks(spark, sf_dir), contracts.WEBHOOK, "arrival")
    return events.select("arrival", "event_id", "scan_type", "facility_code", "is_duplicate")


def webhook_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches out of order around two merges: the last one comes first, and one of those merged comes again."""
    path = scratch_path(spark, "webhooks")
    events = store(contracts.accepted(_checked_webhooks(spark, sf_dir), contracts.WEBHOOK, "arrival"), "events")
    for batch in (3, 1, None, 0, None, 1, 2):
        if batch is None:
            compact(spark, path)
        else:
            upsert_events(events.filter(F.col("arrival") % 4 == batch), path, batch)
    return current_events(spark, path)


def duplicate_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events once, and the error scans once more, half of them at the same
    moment and half an hour later; some moments are not known."""
    sent = _scans(spark, sf_dir).select("event_id", "scan_type", F.col("timestamp").alias("arrival"))
    later = F.when(F.col("event_id") % 2 == 0, F.col("arrival")).otherwise(F.col("arrival") + F.expr("INTERVAL '1' HOUR"))
    resent = sent.filter(F.col("scan_type") == "UNKNOWN_ERROR").withColumn("arrival", later)
    known = F.when(F.col("event_id") % 7 != 0, F.col("arrival"))
    both = sent.unionAll(resent).withColumn("arrival", known).drop("scan_type")
    return latest.duplicate_flag(both, "event_id", "arrival")


# Bronze and streams.

def message_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages as bytes, some of which are no text."""
    raw = F.encode(F.concat(F.lit("é "), F.col("event_type")), "UTF-8")
    broken = F.concat(raw, F.unhex(F.lit("FFFE")))
    value = F.when(F.col("event_id") % 13 == 0, broken).when(F.col("event_id") % 13 == 1, F.lit(None)).otherwise(raw)
    return messages(read_events(spark, sf_dir).select("event_id", value.alias("value")))


def iso_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts of several shapes as timestamps: with a blank, with a zone, without seconds, a date, and no time at all."""
    text = iso_text(F.col("timestamp"))
    date, minute = F.substring(text, 1, 10), F.substring(text, 12, 5)
    shapes = {1: F.replace(text, F.lit("T"), F.lit(" ")), 2: F.concat(text, F.lit("Z")), 3: F.concat(text, F.lit("+02:00")),
              4: F.concat(date, F.lit("T"), minute, F.lit("-0130")), 5: date, 6: F.concat(date, F.lit(" 25:00")), 7: F.lit("")}
    given = text
    for remainder, shape in shapes.items():
        given = F.when(F.col("event_id") % 9 == remainder, shape).otherwise(given)
    return _scans(spark, sf_dir).select("event_id", iso_to_timestamp(given).alias("timestamp"))


def json_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scans(spark, sf_dir).select("event_id", telemetry_json().alias("record"))


def bronze_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "bronze")
    write_bronze(_scans(spark, sf_dir), 0, path)
    return read_bronze(spark, path)


BATCHES = 4


def _event_stream(spark: SparkSession, sf_dir: str, copies: int = 1) -> DataFrame:
    """The events in as many files for each batch."""
    folder, events = scratch_path(spark, "events"), read_events(spark, sf_dir)
    files = file_count(events, BATCHES)
    # Many events with one id would leave files out if the ranges went by it alone.
    order = ["event_id"] if files == 1 else ["event_id", "ts", "user_id"]
    for _ in range(copies):
        events.repartitionByRange(BATCHES * files, *order).write.mode("append").parquet(folder)
    return stream_events(spark, folder, files)


def _with_a_replay(sink: BatchSink) -> BatchSink:
    """The second batch comes twice, as after a failure."""
    def write(batch: DataFrame, batch_id: int) -> None:
        for _ in range(2 if batch_id == 1 else 1):
            sink(batch, batch_id)

    return write


def _drained(spark: SparkSession, sf_dir: str, on_counts: Callable[[int, dict], None] | None = None) -> medallion.Lake:
    lake = medallion.Lake(scratch_path(spark, "stream"))
    stream = telemetry_messages(_event_stream(spark, sf_dir))
    drain(stream, _with_a_replay(bronze_sink(lake.messages, on_counts)), lake.checkpoint)
    return lake


def stream_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_accepted(spark, _drained(spark, sf_dir).bronze, schemas.TELEMETRY)


def stream_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    rejects = read_rejects(spark, _drained(spark, sf_dir).rejects)
    return rejects.select("reject_key", "reason", F.size("reasons").alias("reason_count"), "payload")


def stream_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counts observed while the batches were written."""
    seen: dict[int, dict] = {}
    _drained(spark, sf_dir, lambda batch, counts: seen.update({batch: counts}))
    observed = spark.createDataFrame([(one["rows"], one["valid"]) for one in seen.values()], "rows bigint, valid bigint")
    return observed.agg(F.count(F.lit(1)).alias("batches"), F.sum("rows").alias("rows"), F.sum("valid").alias("valid"))


def stream_webhooks(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "webhook-stream")
    sink = _with_a_replay(webhook_sink(f"{root}/store"))
    drain(webhook_requests(_event_stream(spark, sf_dir)), sink, f"{root}/checkpoint")
    compact(spark, f"{root}/store")
    return current_events(spark, f"{root}/store")


def stream_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event comes twice and is passed on once."""
    root = scratch_path(spark, "duplicates")
    events = _event_stream(spark, sf_dir, copies=2).select("event_id", F.col("ts").cast("timestamp").alias("at"))
    unique = latest.drop_duplicates_stream(events, "event_id", "at", "400 days")
    query = (unique.writeStream.format("parquet").option("checkpointLocation", f"{root}/checkpoint")
             .option("path", f"{root}/out").trigger(availableNow=True).start())
    query.awaitTermination()
    return spark.read.schema("event_id bigint").parquet(f"{root}/out")


# Files of a batch of messages, of `FILE_ROWS` events each.
MESSAGE_FILES = 100


def _medallion(spark: SparkSession, sf_dir: str) -> medallion.Lake:
    """Three runs, each with the messages that came since the last one, broken ones among them."""
    lake, folder = medallion.Lake(scratch_path(spark, "lake")), scratch_path(spark, "messages")
    events = read_events(spark, sf_dir)
    files = file_count(events, 3)
    for part in range(3):
        sent = events.filter(F.col("event_id") % 3 == part)
        sent.repartition(files, "event_id").write.mode("append").parquet(folder)
        medallion.run(spark, telemetry_messages(stream_events(spark, folder, MESSAGE_FILES)), lake)
    return lake


def medallion_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mart(spark.table(_medallion(spark, sf_dir).gold))


def medallion_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(medallion.read_silver(spark, _medallion(spark, sf_dir)), "avg_latency")


def stream_duplicate_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events in four batches, the second one twice; some come again in their batch and some in the next one."""
    root, schema = scratch_path(spark, "flags"), "event_id bigint, part int, at timestamp_ntz"
    events = read_events(spark, sf_dir).withColumn("batch", (F.col("event_id") % BATCHES).cast("int"))
    copies = F.array(F.struct(F.lit(0).alias("part"), F.lit(0).alias("later"), F.col("ts").alias("at")),
                     F.struct(F.when(F.col("event_id") % 5 == 0, 1).alias("part"), F.lit(0).alias("later"),
                              (F.col("ts") + F.expr("INTERVAL '1' HOUR")).alias("at")),
                     F.struct(F.when(F.col("event_id") % 3 == 0, 2).alias("part"), F.lit(1).alias("later"),
                              F.col("ts").alias("at")))
    sent = store(events.select("event_id", "batch", F.inline(copies)).filter("part IS NOT NULL")
                 .withColumn("batch", F.col("batch") + F.col("later")), "sent")
    files, sink = file_count(sent, BATCHES), _with_a_replay(flag_sink(f"{root}/out", "event_id", "at", "at", "part", days=400))
    for batch in range(BATCHES):  # what has come since the last batch is one batch
        (sent.filter(F.col("batch") == batch).select("event_id", "part", "at").repartition(files)
         .write.mode("append").parquet(f"{root}/events"))
        drain(spark.readStream.schema(schema).parquet(f"{root}/events"), sink, f"{root}/checkpoint")
    return read_flags(spark, f"{root}/out", StructType.fromDDL("event_id bigint, part int, is_duplicate boolean"))


def ingest_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of three topic partitions in a lake that lost some offsets and took some twice."""
    root = scratch_path(spark, "audited")
    placed = telemetry_messages(read_events(spark, sf_dir)).withColumns(
        {"topic": F.lit("scans"), "partition": (F.col("event_id") % 3).cast("int"), "offset": F.expr("event_id div 3")})
    lost = (F.col("offset").between(100, 140) & (F.col("partition") == 1)) | (F.col("event_id") % 977 == 5)
    kept = placed.filter(~lost)
    names = [*contracts.TELEMETRY.names, *PLACE]
    for source, messages in (("one", kept), ("other", kept.filter(F.col("event_id").between(300, 420)))):
        write_batch(contracts.validate(messages, contracts.TELEMETRY), names, 0, root, source)
    schema = StructType.fromDDL("topic string, partition int, offset bigint")
    arrived = [read_accepted(spark, outcome_path(root, outcome), schema) for outcome in (ACCEPTED, REJECTED)]
    return offset_audit(arrived[0].unionByName(arrived[1]))


def rejects_replayed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejected messages sent again three times: with their scan types put right, once more, and with their times too."""
    root = scratch_path(spark, "replayed")
    bronze_sink(root)(telemetry_messages(read_events(spark, sf_dir)), 0)

    def scans(payload):
        return F.replace(payload, F.lit('"LOST"'), F.lit('"TRANSIT"'))

    def scans_and_times(payload):
        return F.replace(scans(payload), F.lit('"nope"'), F.lit('"2024-01-01T00:00:00"'))

    for attempt, fix in enumerate((scans, scans, scans_and_times), 1):
        replay_rejects(spark, root, contracts.TELEMETRY, fix, attempt)
    attempt = F.when(F.col("source") == "replay", F.col("batch_id")).otherwise(0)
    return read_accepted(spark, outcome_path(root, ACCEPTED), medallion.BRONZE).select(
        *contracts.TELEMETRY.names, attempt.alias("attempt"))


def _array_files(records: DataFrame, path: str, text: Column | None = None) -> None:
    """Records (`batch`, `event_id`, `record`) as one file a batch, an array over several lines."""
    listed = F.transform(F.array_sort(F.collect_list(F.struct("event_id", "record"))), lambda one: one["record"])
    arrays = records.groupBy("batch").agg(F.concat(F.lit("[\n  "), F.array_join(listed, ",\n  "), F.lit("\n]")).alias("text"))
    arrays.select("batch", (F.col("text") if text is None else text).alias("value")).write.partitionBy("batch").text(path)


ARRAY_RECORDS = 200
# Files without a meaning of their own are larger: listing, opening and committing one takes longer than its records.
INFERRED_RECORDS = 20_000


def bronze_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of arrays over several lines; every tenth one was cut off and is told by its batch."""
    path = scratch_path(spark, "arrays")
    records = _scans(spark, sf_dir).select(F.expr(f"event_id div {ARRAY_RECORDS}").alias("batch"), "event_id",
                                           telemetry_json().alias("record"))
    cut = F.when(F.col("batch") % 10 == 3, F.expr("left(text, length(text) - 20)")).otherwise(F.col("text"))
    _array_files(records, path, cut)
    documents = read_documents(spark, path)
    batch = F.regexp_extract("file", "batch=([0-9]+)", 1).cast("bigint").alias("batch")
    good = telemetry_of(elements(documents), batch).withColumn("damaged", F.lit(False))
    return good.unionByName(damaged_files(documents).select(batch, F.lit(True).alias("damaged")), allowMissingColumns=True)


def bronze_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches of records with other types in the second one, read by the fields of both."""
    scans = _scans(spark, sf_dir)
    whole, even = F.floor(F.abs("ping_latency_ms")).cast("bigint"), F.col("event_id") % 2 == 0
    first = record_json(event_id=F.col("event_id"), latency=whole, code=F.col("event_id") % 7, seen=even)
    second = record_json(event_id=F.col("event_id"), latency=F.col("ping_latency_ms"), code=F.col("scan_type"), note=F.when(
        F.col("event_id") % 3 == 0, "late"))
    files, kinds = [], []
    for number, (record, chosen) in enumerate(((first, even), (second, ~even))):
        path = scratch_path(spark, f"inferred-{number}")
        _array_files(scans.filter(chosen).select(F.expr(f"event_id div {INFERRED_RECORDS}").alias("batch"), "event_id",
                                                 record.alias("record")), path)
        files.append(elements(read_documents(spark, path)))
        kinds.append(field_kinds(files[-1]))
    return inferred(files[0].unionByName(files[1]), merged_kinds(*kinds))


# Blocks of the mart for the small test tables.
BLOCK_ROWS = 500


def _waves(events: DataFrame) -> DataFrame:
    """The events with the `wave` they come in: the first half, the second half, and some of all times that are late."""
    half = events.agg(F.timestamp_add("MICROSECOND", F.expr("timestampdiff(MICROSECOND, min(ts), max(ts)) div 2"),
                                      F.min("ts")).alias("_half"))
    wave = F.when(F.col("event_id") % 97 == 0, 2).when(F.col("ts") < F.lit(half.first()[0]), 0).otherwise(1)
    return events.withColumn("wave", wave)


def gold_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mart after three refreshes, the last one with deliveries of all times; batches are numbered out of order."""
    root = scratch_path(spark, "incremental")
    mart, waves = IncrementalMart(spark, f"{root}/mart", BLOCK_ROWS), store(_waves(read_events(spark, sf_dir)), "waves")
    sink = bronze_sink(f"{root}/messages")
    for wave, number in enumerate((5, 3, 4)):
        sink(telemetry_messages(waves.filter(F.col("wave") == wave)), number)
        mart.refresh(outcome_path(f"{root}/messages", ACCEPTED))
    return _mart(mart.read())


QUERIES = {
    "gold_sla": gold_sla,
    "milestones": milestone_times,
    "transit_hours": transit_hours,
    "sla_flag": sla_flag,
    "rolling_7_rows": rolling_7_rows,
    "rolling_7_days": rolling_7_days,
    "gold_table": gold_table,
    "staging_events": staging_events,
    "staging_union": staging_union,
    "silver_clean_events": silver_clean_events,
    "silver_status": silver_status,
    "silver_exact": silver_exact,
    "silver_latest_scan": silver_latest_scan,
    "silver_roundtrip": silver_roundtrip,
    "gate_report": gate_report,
    "gate_violations": gate_violations,
    "gate_halt": gate_halt,
    "gate_no_rows": gate_no_rows,
    "contract_valid": contract_valid,
    "contract_rejects": contract_rejects,
    "batch_counts": batch_counts,
    "webhook_status": webhook_status,
    "webhook_defaults": webhook_defaults,
    "webhook_upsert": webhook_upsert,
    "duplicate_flag": duplicate_flag,
    "json_encode": json_encode,
    "message_text": message_text,
    "iso_times": iso_times,
    "bronze_roundtrip": bronze_roundtrip,
    "stream_bronze": stream_bronze,
    "stream_rejects": stream_rejects,
    "stream_counts": stream_counts,
    "stream_duplicates": stream_duplicates,
    "stream_webhooks": stream_webhooks,
    "stream_duplicate_flag": stream_duplicate_flag,
    "ingest_audit": ingest_audit,
    "rejects_replayed": rejects_replayed,
    "bronze_arrays": bronze_arrays,
    "bronze_inferred": bronze_inferred,
    "gold_incremental": gold_incremental,
    "medallion_gold": medallion_gold,
    "medallion_silver": medallion_silver,
}
