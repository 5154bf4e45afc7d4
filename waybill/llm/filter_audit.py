"""How the filters of a corpus interact, from a sparse document-term matrix.

Five filters look at whole texts; each says which documents fail it:

* A: fewer than 50 words. B: fewer than 65 distinct words per 100 words.
* C: more than 5 capital letters A-Z per 100 code points. D: one of `#$%&*|`.
* E: the same text as a document with a smaller id.

Words are runs of characters other than space and 0x09-0x0D. Documents are
gathered into shards of the matrix in compressed sparse rows: per document the
columns of its words and their counts. A shard is first written with columns of
its own. Their words are ranked in buckets over all shards, which gives each
word one global number, and every shard is given the numbers of its own, so
words travel once per shard and not once per document. Row sums and the numbers of nonzeros decide A and B.

A very long text is cut into rows of several shards. Its nonzeros are counted
by the global numbers, which are the same in all of them.

What an order of filters does to documents depends only on the set of filters
that each one fails. The report is made from the numbers of documents per set:
those that pass all filters of a set are summed up once per set, and every
figure is a difference of two such sums.
"""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import count, permutations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StructField, StructType

from waybill.llm.arrow import text_slices, utf8
from waybill.llm.scratch import Scratch
from waybill.llm.tasks import over_batches

FILTERS = "ABCDE"
LEAST_WORDS, DISTINCT_PERCENT, CAPITAL_PERCENT = 50, 65, 5
# Text that one shard holds, and what one of its rows holds at most if there is white space to cut at.
SHARD_BYTES = 32 << 20
ROW_BYTES = 4 << 20
# Words are numbered in so many buckets per shuffle partition.
BUCKETS_PER_PARTITION = 8

_CAPITALS = bytes(range(65, 91))
_MARKS = b"#$%&*|"
_CONTINUING = bytes(range(0x80, 0xC0))
_SPACES = b"\t\n\x0b\x0c\r "


def pieces(raw: bytes, size: int = ROW_BYTES) -> Iterator[bytes]:
    """A text in pieces of about `size` bytes that cut no word."""
    low = 0
    while len(raw) - low > size:
        high = low + size
        while high < len(raw) and raw[high] not in _SPACES:
            high += 1
        yield raw[low:high]
        low = high
    yield raw[low:]


def planes(values: np.ndarray) -> bytes:
    """32-bit numbers with their first bytes, second bytes and so on together, which compresses well."""
    return values.astype("<i4").view(np.uint8).reshape(-1, 4).T.tobytes()


def from_planes(raw: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(4, -1).T).view("<i4").ravel()


class _Shard:
    """Rows of the matrix with columns of their own."""

    def __init__(self) -> None:
        self.columns: defaultdict[bytes, int] = defaultdict(count().__next__)
        self.indices: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []
        self.rows: list[tuple] = []
        self.size = 0

    def add(self, row: tuple, piece: bytes) -> None:
        counted = Counter(piece.split())  # splits at the same six bytes
        self.indices.append(np.fromiter(map(self.columns.__getitem__, counted), np.int32, len(counted)))
        self.counts.append(np.fromiter(counted.values(), np.int32, len(counted)))
        self.rows.append(row)
        self.size += len(piece)


def _shards(batches: Iterator[pa.RecordBatch], schema: pa.Schema, shard_bytes: int,
            row_bytes: int) -> Iterator[pa.RecordBatch]:
    # Tags are unique over tasks; the table is written before anything reads them.
    base = TaskContext.get().partitionId() << 32
    shards = documents = 0
    held = _Shard()

    def flush() -> pa.RecordBatch:
        starts = np.cumsum([0, *map(len, held.indices)], dtype=np.int64)
        columns = [[base + shards], [list(held.columns)], [starts.tobytes()],
                   [planes(np.concatenate(held.indices))], [planes(np.concatenate(held.counts))],
                   [[dict(zip(names, row)) for row in held.rows]]]
        return pa.RecordBatch.from_arrays([pa.array(column, field.type) for column, field in zip(columns, schema)],
                                          schema=schema)

    names = [schema.field("rows").type.value_type.field(i).name
             for i in range(schema.field("rows").type.value_type.num_fields)]
    for batch in text_slices(batches):
        data, offsets = utf8(batch.column("text"))
        data = data.tobytes()
        for doc_id, part, low, high in zip(batch.column("doc_id").to_pylist(), batch.column("part").to_pylist(),
                                           offsets[:-1].tolist(), offsets[1:].tolist()):
            raw = data[low:high]
            chars = len(raw.translate(None, _CONTINUING))
            capitals = len(raw) - len(raw.translate(None, _CAPITALS))
            marks = len(raw.translate(None, _MARKS)) < len(raw)
            whole = high - low <= row_bytes
            row = (base + documents, doc_id, part, chars, capitals, marks, hashlib.sha256(raw).digest(), whole)
            documents += 1
            for piece in (raw,) if whole else pieces(raw, row_bytes):
                held.add(row, piece)
                if held.size >= shard_bytes:
                    yield flush()
                    held, shards = _Shard(), shards + 1
    if held.rows:
        yield flush()


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The global numbers of each shard's columns, in one row per shard, from rows sorted by shard and column."""
    current, held = None, []

    def flush() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([current], pa.int64()),
                                           pa.array([np.concatenate(held).tobytes()], pa.binary())], ["shard", "numbers"])

    for batch in batches:
        shards = batch.column("shard").to_numpy()
        numbers = batch.column("number").to_numpy()
        cuts = np.concatenate([[0], np.flatnonzero(shards[1:] != shards[:-1]) + 1, [len(shards)]])
        for low, high in zip(cuts[:-1], cuts[1:]):
            if high == low:
                continue
            if current is not None and shards[low] != current:
                yield flush()
                held = []
            current = int(shards[low])
            held.append(numbers[low:high].copy())
    if current is not None:
        yield flush()


def _rows_of(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Row sums and nonzeros of global shards; rows that are pieces also pass on their columns."""
    for batch in batches:
        for shard in batch.to_pylist():
            starts = np.frombuffer(shard["starts"], np.int64)
            numbers = np.frombuffer(shard["numbers"] or b"", np.int64)
            columns = numbers[from_planes(shard["indices"])]
            sums = np.concatenate([[0], np.cumsum(from_planes(shard["counts"]), dtype=np.int64)])
            made = [{**row, "n_words": int(sums[high] - sums[low]), "n_distinct": int(high - low),
                     "columns": None if row["whole"] else columns[low:high]}
                    for row, low, high in zip(shard["rows"], starts[:-1], starts[1:])]
            yield pa.RecordBatch.from_pylist(made, schema)


def word_counts(docs: DataFrame, shard_bytes: int = SHARD_BYTES, row_bytes: int = ROW_BYTES) -> DataFrame:
    """One row per row of `docs`, with `doc_id` and `part` as they are, the
    numbers of words, distinct words, code points and capitals, whether marks
    occur, and the SHA-256 of the text. A null text counts as empty."""
    scratch = Scratch(docs.sparkSession, "filter-audit")
    kept = docs.select("doc_id", "part", "text")
    row = StructType([StructField("document", LongType()), kept.schema["doc_id"], kept.schema["part"],
                      *StructType.fromDDL("n_chars bigint, n_capitals bigint, marks boolean, digest binary, whole boolean")])
    schema = StructType([StructField("shard", LongType()), StructField("words", ArrayType(BinaryType())),
                         *StructType.fromDDL("starts binary, indices binary, counts binary"),
                         StructField("rows", ArrayType(row))])
    arrow = _arrow(schema)
    local = scratch.store(over_batches(kept, lambda batches: _shards(batches, arrow, shard_bytes, row_bytes), schema),
                          "shards")
    own = local.select("shard", F.posexplode("words").alias("place", "word"))
    # A word's number is its bucket and its rank there, which come out the same whenever they are made again.
    buckets = BUCKETS_PER_PARTITION * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranked = own.withColumn("bucket", F.pmod(F.xxhash64("word"), F.lit(buckets)))
    rank = F.dense_rank().over(Window.partitionBy("bucket").orderBy("word"))
    numbered = (ranked.select("shard", "place", (rank * F.lit(buckets).cast("bigint") + F.col("bucket")).alias("number"))
                .repartition("shard").sortWithinPartitions("shard", "place"))
    numbers = over_batches(numbered, _pack, "shard bigint, numbers binary")
    made = StructType([*row, *StructType.fromDDL("n_words bigint, n_distinct bigint, columns array<bigint>")])
    made_arrow = _arrow(made)
    matrix = local.drop("words").join(numbers, "shard", "left")
    rows = scratch.store(over_batches(matrix, lambda batches: _rows_of(batches, made_arrow), made), "rows")
    scratch.drop(local)
    names = [name for name in made.names if name not in ("whole", "columns")]
    parts = rows.filter(~F.col("whole"))
    distinct = (parts.select("document", F.explode("columns").alias("column")).distinct()
                .groupBy("document").agg(F.count(F.lit(1)).alias("n_distinct")))
    same = [name for name in names if name not in ("n_words", "n_distinct")]
    joined = (parts.groupBy(*same).agg(F.sum("n_words").alias("n_words")).join(distinct, "document", "left")
              .withColumn("n_distinct", F.coalesce("n_distinct", F.lit(0).cast("bigint"))))
    return rows.filter("whole").select(*names).unionByName(joined.select(*names)).drop("document")


def _arrow(schema: StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    return to_arrow_schema(schema)


def document_flags(docs: DataFrame, part: str = "source", **sizes: int) -> DataFrame:
    """Which filters each document fails: `doc_id`, `part` (text; null counts as
    empty), `n_words`, `n_distinct`, `n_chars`, `n_capitals` and `fails_a` to `fails_e`.

    A null text counts as empty. Rows that repeat with their id do not fail E by each other, and a document without an
    id fails it by no other nor makes another fail it. Other columns of `docs` are not looked at. An empty table gives an empty result.
    """
    kept = docs.select("doc_id", F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), "text")
    rows = word_counts(kept, **sizes)
    first = (rows.groupBy(F.col("digest").alias("_digest")).agg(F.min("doc_id").alias("_first"))
             .filter(F.col("_first").isNotNull()))
    # Joined on digest and id, so of a group of copies only the first one meets its row.
    found = rows.join(first, (F.col("digest") == F.col("_digest")) & (F.col("doc_id") == F.col("_first")), "left")
    return found.select(
        "doc_id", "part", "n_words", "n_distinct", "n_chars", "n_capitals",
        (F.col("n_words") < LEAST_WORDS).alias("fails_a"),
        (100 * F.col("n_distinct") < DISTINCT_PERCENT * F.col("n_words")).alias("fails_b"),
        (100 * F.col("n_capitals") > CAPITAL_PERCENT * F.col("n_chars")).alias("fails_c"),
        F.col("marks").alias("fails_d"),
        (F.col("_digest").isNull() & F.col("doc_id").isNotNull()).alias("fails_e"))


def _bit(letter: str) -> int:
    return 1 << FILTERS.index(letter)


def _failed() -> Column:
    return sum((F.col(f"fails_{letter.lower()}").cast("int") * _bit(letter) for letter in FILTERS), F.lit(0))


def interactions(flags: DataFrame, labels: DataFrame) -> DataFrame:
    """What each filter does at each place of every order of the filters, per part.

    One row per `part`, `filter_order` (all 120) and `step`, with the documents
    kept after the step and removed by it; `redundant` ones fail its filter and were removed
    before, `unique_fails` fail no other filter; `good_lost` and `toxic_lost`
    are the removed ones labelled so; `shapley` is the number the filter removes
    summed over all orders. Of several labels of a document the greatest counts. Parts
    are those that occur, so an empty table gives an empty result.
    """
    known = labels.groupBy(F.col("doc_id").alias("_id")).agg(F.max("quality").alias("_quality"), F.max("toxic").alias("_toxic"))
    # Rows that are alike are one row before they meet their labels.
    alike = flags.select("doc_id", "part", _failed().alias("failed")).groupBy("doc_id", "part", "failed").count()
    sets = alike.join(known, F.col("doc_id") == F.col("_id"), "left").groupBy("part", "failed").agg(
        F.sum("count").alias("documents"),
        F.coalesce(F.sum(F.when(F.col("_quality") == 1, F.col("count"))), F.lit(0)).alias("good"),
        F.coalesce(F.sum(F.when(F.col("_toxic") == 1, F.col("count"))), F.lit(0)).alias("toxic"))
    every = (1 << len(FILTERS)) - 1
    # Documents that pass all filters of a set, for all sets: at most 32 rows a part.
    passing = (sets.withColumn("set", F.explode(F.expr(f"filter(sequence(0, {every}), s -> (s & failed) = 0)")))
               .groupBy("part", "set").agg(*[F.sum(name).alias(name) for name in ("documents", "good", "toxic")])
               .groupBy("part").agg(*[F.map_from_entries(F.collect_list(F.struct("set", name))).alias(name)
                                      for name in ("documents", "good", "toxic")]))

    def passes(name: str, members: str) -> str:
        return f"coalesce({name}[{members}], 0L)"

    # An order in which `s` stands before the filter: |s|! times (4 - |s|)! of them.
    weighed = (f"transform(array(1, 2, 4, 8, 16), bit -> aggregate(filter(sequence(0, {every}), s -> (s & bit) = 0), 0L,"
               f" (total, s) -> total + array(24L, 6L, 4L, 6L, 24L)[bit_count(s)]"
               f" * ({passes('documents', 's')} - {passes('documents', 's | bit')})))")
    orders = " ".join("".join(order) for order in permutations(FILTERS))
    placed = passing.withColumn("values", F.expr(weighed)).withColumn(
        "filter_order", F.explode(F.split(F.lit(orders), " "))).withColumn(
        "step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))))
    before = " + ".join(f"if(instr(filter_order, '{letter}') < step, {_bit(letter)}, 0)" for letter in FILTERS)
    own = placed.withColumn("place", F.expr(f"instr('{FILTERS}', substring(filter_order, step, 1))")).withColumn(
        "bit", F.expr("shiftleft(1, place - 1)")).withColumn("before", F.expr(before))

    def removed(name: str) -> str:
        return f"{passes(name, 'before')} - {passes(name, 'before | bit')}"

    return own.selectExpr(
        "part", "filter_order", "step",
        f"{passes('documents', 'before | bit')} AS kept",
        f"{removed('documents')} AS removed",
        f"documents[0] - {passes('documents', 'bit')} - ({removed('documents')}) AS redundant",
        f"{passes('documents', f'{every} - bit')} - {passes('documents', str(every))} AS unique_fails",
        f"{removed('good')} AS good_lost",
        f"{removed('toxic')} AS toxic_lost",
        "values[place - 1] AS shapley")
