"""Record contracts as column expressions.

`validate` parses the JSON payload once into a variant, which keeps the JSON
type of every field, and turns each rule of a contract into an expression. A
record with no reason against it is accepted; any other keeps its payload and
all its reasons.
"""

from __future__ import annotations

from contextlib import contextmanager
from dataclasses import dataclass
from threading import RLock

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from waybill import schemas
from waybill.functions.text import or_default
from waybill.functions.time import epoch_to_timestamp, iso_to_timestamp

MALFORMED = "malformed_json"

# Texts that count as a truth value or as a number.
TRUE_TEXTS = ("1", "on", "t", "true", "y", "yes")
FALSE_TEXTS = ("0", "off", "f", "false", "n", "no")
NUMBER = r"^[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|(?i:inf|infinity|nan))\z"


@dataclass(frozen=True)
class Field:
    """One field of a contract. `pattern` must match from start to end."""

    name: str
    type: str = "string"
    required: bool = False
    nullable: bool = False
    allowed: tuple[str, ...] | None = None
    pattern: str | None = None
    default: object = None


@dataclass(frozen=True)
class Contract:
    """`name` tells the counters of several contracts in one query apart."""

    fields: tuple[Field, ...]
    key: str
    name: str = "record"

    @property
    def names(self) -> list[str]:
        return [field.name for field in self.fields]


TELEMETRY = Contract(
    name="telemetry",
    key="tracking_number",
    fields=(
        Field("tracking_number", required=True),
        Field("scan_type", required=True, allowed=schemas.TELEMETRY_SCANS),
        Field("timestamp", "timestamp", required=True),
        Field("ping_latency_ms", "double", nullable=True),
    ),
)

WEBHOOK = Contract(
    name="webhook",
    key="tracking_number",
    fields=(
        Field("event_id", required=True),
        Field("tracking_number", required=True),
        Field("scan_type", required=True, allowed=schemas.WEBHOOK_SCANS),
        Field("timestamp", "timestamp", required=True),
        Field("facility_code", nullable=True),
        Field("is_duplicate", "boolean", default=False),
    ),
)


def validate(df: DataFrame, contract: Contract, value: str = "value",
             counts: Observation | None = None) -> DataFrame:
    """Add the contract's typed columns, `reject_key` and `reasons` to `df`.

    `reasons` lists the broken rules in field order, separated by commas, and
    is empty for an accepted record.

    Counters are collected after parsing and after checking. They are borders
    as well: the optimizer does not move a later filter on `reasons` below the
    parsing, which would parse every payload again for each rule, and either
    side is compiled on its own, as the JVM runs very long methods slowly.
    """
    others = [name for name in df.columns if name not in contract.names]
    names = contract.names
    with _last_key_counts(df.sparkSession):
        documents = df.select(*others, _parse(F.col(value)).alias("_doc"))
    parsed = (
        documents.select(*others, _is_record(F.col(value)).alias("_ok"),
                *[F.try_variant_get("_doc", f"$[0].{name}", "variant").alias(f"_{name}") for name in names])
    )
    kinds = [F.schema_of_variant(f"_{name}").alias(f"_{name}_kind") for name in names]
    texts = [F.try_variant_get(f"_{name}", "$", "string").alias(f"_{name}_text") for name in names]
    numbers = [_number(field).alias(f"_{field.name}_number") for field in contract.fields]
    checked = (
        observe_payloads(parsed, contract.name)
        .select(*others, "_ok", *kinds, *texts)
        .select("*", *numbers)
        .select("*", *[_typed(field).alias(field.name) for field in contract.fields])
        .select(*others, *names, _reject_key(contract).alias("reject_key"), _reasons(contract).alias("reasons"))
    )
    return observe_counts(checked, counts, contract.name)


_setting = RLock()


@contextmanager
def _last_key_counts(spark: SparkSession):
    """Of a repeated JSON key the last one counts, whatever the session says;
    the setting is read when an expression is analysed. One thread at a time
    changes it, so each finds what the session had."""
    key = "spark.sql.variant.allowDuplicateKeys"
    with _setting:
        before = spark.conf.get(key)
        spark.conf.set(key, "true")
        try:
            yield
        finally:
            spark.conf.set(key, before)


def observe_payloads(parsed: DataFrame, name: str = "record") -> DataFrame:
    """Count payloads and those that are no JSON object while a job runs over them."""
    return parsed.observe(
        _observer(parsed, f"{name}_payloads"),
        F.count(F.lit(1)).alias("payloads"),
        F.count_if(~F.col("_ok")).alias("malformed"),
    )


def observe_counts(checked: DataFrame, counts: Observation | None = None, name: str = "record") -> DataFrame:
    """Count checked and valid rows while another job runs over them. A stream
    reports the counts of each batch in its progress, under the contract's name
    and `_counts`."""
    return checked.observe(
        counts or _observer(checked, f"{name}_counts"),
        F.count(F.lit(1)).alias("rows"),
        F.count_if(is_accepted()).alias("valid"),
    )


def _observer(df: DataFrame, name: str) -> Observation | str:
    return name if df.isStreaming else Observation()


def is_accepted() -> Column:
    return F.col("reasons") == ""


def first_reason() -> Column:
    return F.substring_index("reasons", ",", 1)


def reason_list() -> Column:
    return F.split("reasons", ",")


def accepted(checked: DataFrame, contract: Contract, *keep: str) -> DataFrame:
    return checked.filter(is_accepted()).select(*keep, *contract.names)


def rejected(checked: DataFrame, contract: Contract, *keep: str, value: str = "value") -> DataFrame:
    """Rejected payloads with the key they name, the first reason and all reasons."""
    return checked.filter(~is_accepted()).select(
        *keep,
        F.col("reject_key").alias(contract.key),
        first_reason().alias("reason"),
        reason_list().alias("reasons"),
        F.col(value).alias("payload"),
    )


def webhook_status(checked: DataFrame, *keep: str) -> DataFrame:
    """Outcome code and message of every checked webhook payload."""
    malformed = F.col("reasons") == MALFORMED
    invalid = ~is_accepted()
    return checked.select(
        *keep,
        F.when(malformed, 500).when(invalid, 400).otherwise(200).alias("status_code"),
        F.when(malformed, MALFORMED).when(invalid, schemas.REJECTED_MESSAGE)
        .otherwise(schemas.ACCEPTED_MESSAGE).alias("message"),
    )


def _parse(value: Column) -> Column:
    """The payload as the first element of an array, its hash as the second.

    The JSON parser stops after one document and ignores what follows. With
    the hash behind it, a payload is known to be one whole document.
    """
    return F.try_parse_json(F.concat(F.lit("["), value, F.lit(","), F.xxhash64(value), F.lit("]")))


def _is_record(value: Column) -> Column:
    """The payload is one JSON object and nothing else."""
    whole = F.try_variant_get("_doc", "$[1]", "bigint").eqNullSafe(F.xxhash64(value))
    return whole & F.coalesce(F.ltrim(value, F.lit(" \t\r\n")).startswith("{"), F.lit(False))


def _number(field: Field) -> Column:
    """The field as a number, whether JSON number or text. No other JSON value
    has a text of that shape."""
    if field.type == "string":
        return F.lit(None).cast("double")
    text = F.trim(F.col(f"_{field.name}_text"))
    return F.when(text.rlike(NUMBER), text.try_cast("double"))


def _typed(field: Field) -> Column:
    """The field as its type; an absent one takes its default."""
    if field.default is None:
        return _coerced(field)
    return F.when(F.col(f"_{field.name}_kind").isNull(), F.lit(field.default)).otherwise(_coerced(field))


def _coerced(field: Field) -> Column:
    """The field as its type, NULL if its JSON value does not count as one."""
    kind, text = F.col(f"_{field.name}_kind"), F.col(f"_{field.name}_text")
    number = F.col(f"_{field.name}_number")
    if field.type == "string":
        return F.when(kind == "STRING", text)
    if field.type == "double":
        return number
    if field.type == "timestamp":
        return F.coalesce(iso_to_timestamp(text), epoch_to_timestamp(number))
    if field.type == "boolean":
        word = (F.when(kind.isin("STRING", "BOOLEAN"), F.lower(text))
                .when(number == 1, "1").when(number == 0, "0"))
        return F.when(word.isin(*TRUE_TEXTS), True).when(word.isin(*FALSE_TEXTS), False)
    raise ValueError(f"unknown field type {field.type}")


def _reject_key(contract: Contract) -> Column:
    """The key as the payload gives it, of whatever type."""
    return or_default(F.when(F.col("_ok"), F.col(f"_{contract.key}_text")), schemas.UNKNOWN_KEY)


def _reasons(contract: Contract) -> Column:
    return F.when(F.col("_ok"), F.concat_ws(",", *[_reason(field) for field in contract.fields])).otherwise(MALFORMED)


def _reason(field: Field) -> Column:
    """The first rule the field breaks, NULL if none."""
    kind, value = F.col(f"_{field.name}_kind"), F.col(field.name)
    none = F.lit(None).cast("string")
    if field.required:
        reason = F.when(kind.isNull() | (kind == "VOID"), f"missing:{field.name}")
    elif field.nullable:
        reason = F.when(kind.isNull() | (kind == "VOID"), none)
    else:
        reason = F.when(kind.isNull(), none)
    reason = reason.when(value.isNull(), f"type:{field.name}")
    if field.allowed is not None:
        reason = reason.when(~value.isin(*field.allowed), f"pattern:{field.name}")
    if field.pattern is not None:
        reason = reason.when(~value.rlike(rf"^(?:{field.pattern})\z"), f"pattern:{field.name}")
    return reason
