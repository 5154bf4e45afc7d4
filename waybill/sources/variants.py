"""Bronze files whose records are elements of JSON arrays, and fields that were not declared.

A file is read as one document, so an array may go over any number of lines. Its
elements become rows of their own and are dealt out again, so that one large
file does not stay one task in what follows. A file that is no JSON array or
object is told by its name, and the others are read all the same.

Fields and their types are found by looking at all records. Types of several
batches are merged by widening: integers into doubles, and what does not fit
together into text, so a batch may change a type without making older ones
unreadable.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waybill import schemas
from waybill.functions.text import utf8_text
from waybill.functions.time import iso_to_timestamp

TYPES = {"BIGINT": "bigint", "DOUBLE": "double", "BOOLEAN": "boolean", "STRING": "string"}
# A number with a fraction is a decimal to a variant. Everything that is not named here is kept as text.
KINDS = {"DECIMAL": "DOUBLE", "FLOAT": "DOUBLE", "VOID": "VOID", **{kind: kind for kind in TYPES}}


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """One row per file below `path` that is not empty: `file`, its `text` (null if it is not UTF-8) and `bytes`."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select(F.col("path").alias("file"), utf8_text(F.col("content")).alias("text"), F.col("length").alias("bytes"))


def _parsed(documents: DataFrame) -> DataFrame:
    kind = F.schema_of_variant("_document")
    return (documents.withColumn("_document", F.try_parse_json("text"))
            .withColumn("_kind", F.when(kind.startswith("ARRAY"), "array").when(kind.startswith("OBJECT"), "object")))


def damaged_files(documents: DataFrame) -> DataFrame:
    """The files that are no JSON array or object: `file`, `bytes`."""
    return _parsed(documents).filter(F.col("_kind").isNull()).select("file", "bytes")


def elements(documents: DataFrame, partitions: int | None = None) -> DataFrame:
    """One row per element of the documents: `file`, `place` (from 0) and `record`, a variant; a document that
    is an object is its own element. Damaged files have none. The rows are dealt out over all tasks."""
    spark = documents.sparkSession
    whole = _parsed(documents).filter(F.col("_kind").isNotNull()).select("file", F.when(
        F.col("_kind") == "array", F.col("_document")).otherwise(F.try_parse_json(F.concat(F.lit("["), "text", F.lit("]"))))
        .alias("_document"))
    exploded = whole.lateralJoin(spark.tvf.variant_explode(F.col("_document").outer()))
    # A variant is no key of a shuffle; its text is, and takes less.
    dealt = exploded.select("file", F.col("pos").alias("place"), F.to_json("value").alias("record"))
    dealt = dealt.repartition(partitions, "file", "place") if partitions else dealt.repartition("file", "place")
    return dealt.withColumn("record", F.parse_json("record"))


def telemetry_of(records: DataFrame, *keep: str) -> DataFrame:
    """The telemetry columns of records, which bronze holds only checked ones of."""
    fields = {field.name: F.try_variant_get("record", f"$.{field.name}", field.dataType.simpleString())
              for field in schemas.BRONZE}
    return records.select(*keep, *[(iso_to_timestamp(column) if name == "timestamp" else column).alias(name)
                                   for name, column in fields.items()])


def field_kinds(records: DataFrame) -> dict[str, str]:
    """The fields of all records that are objects, and the narrowest type that holds all values of each.

    Nulls have any type. Objects and arrays inside a record are kept as JSON text. One row per field and type comes to the driver.
    """
    spark = records.sparkSession
    objects = records.filter(F.schema_of_variant("record").startswith("OBJECT")).select("record")
    found = objects.lateralJoin(spark.tvf.variant_explode(F.col("record").outer()))
    kind = F.regexp_extract(F.schema_of_variant("value"), "^[A-Z]+", 0)
    rows = found.select("key", kind.alias("kind")).filter("key IS NOT NULL").distinct().collect()
    kinds: dict[str, list[str]] = {}
    for row in rows:
        kinds.setdefault(row["key"], []).append(KINDS.get(row["kind"], "STRING"))
    return {name: reduce(widen, sorted(own)) for name, own in sorted(kinds.items())}


def widen(one: str, other: str) -> str:
    """The narrowest type that holds the values of both."""
    if one == other or other == "VOID":
        return one
    if one == "VOID":
        return other
    return "DOUBLE" if {one, other} == {"BIGINT", "DOUBLE"} else "STRING"


def merged_kinds(*batches: dict[str, str]) -> dict[str, str]:
    """The fields of several batches: new ones are added, types only widen."""
    names = sorted({name for batch in batches for name in batch})
    return {name: reduce(widen, [batch[name] for batch in batches if name in batch]) for name in names}


def inferred(records: DataFrame, kinds: dict[str, str], *keep: str) -> DataFrame:
    """Records as columns of the given types; a field that a record lacks is null."""
    def typed(name: str, kind: str):
        mark = '"' if "'" in name else "'"
        if mark in name:
            raise ValueError(f"a field name with both kinds of quotes cannot be read: {name}")
        value = F.try_variant_get("record", f"$[{mark}{name}{mark}]", "variant")
        if kind == "VOID":
            return F.lit(None).cast("string")
        if kind == "STRING":
            # Text as it is, anything else as its JSON.
            return F.coalesce(F.when(F.schema_of_variant(value) == "STRING", F.try_variant_get(value, "$", "string")),
                              F.when(F.schema_of_variant(value) != "VOID", F.to_json(value)))
        return F.try_variant_get(value, "$", TYPES[kind])

    return records.select(*keep, *[typed(name, kind).alias(name) for name, kind in kinds.items()])
