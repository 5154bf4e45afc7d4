"""Scoring texts with a hierarchical Pitman-Yor language model of the corpus.

A token is served by the restaurant of its context, which is the class of the
word before (by a hash of its last seven bytes; the start of a text is a class
too). There are about as many classes as the square root of the bytes of the
texts, so contexts become finer as the corpus grows. The restaurants of all contexts share one parent, the restaurant of words, whose
parents are the restaurants of spelling in `pitman_yor`. What was never learned
is one further word, as in the base score: it has what the spelling model leaves
to all unlearned words together.

All data move in blocks. Texts are read once, in packs of a few megabytes: a
pack knows which pairs of word and context each text has how often, and sends
its words to buckets by hash. A bucket adds up the counts of its words over all
packs and holds their seating. A Gibbs sweep goes over all buckets with the
spelling model and the totals of the sweep before; tables are added up to the
customers of the next spelling model. The predictive probabilities of the sweeps
after the first are averaged. Each bucket then answers its packs, and a pack
adds up what its texts need. A frequent word is one entry per pack, never one
group of rows; the number of buckets grows with the input, and the spelling
model has a fixed bound.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waybill.llm.arrow import binary, text_slices, utf8
from waybill.llm.codes import add_up, grouped, merged, packed
from waybill.llm.pitman_yor import STRENGTH, Spelling, seat, spelling_codes
from waybill.llm.scratch import Scratch
from waybill.llm.tasks import over_batches
from waybill.llm.tokens import LOWER, distinct_counts, hashes_at, mix, word_borders

PACK_BYTES = 6 << 20
# Bytes of text for each bucket of words, and the least number of buckets.
BUCKET_BYTES, LEAST_BUCKETS = 16 << 20, 12
# Bytes of the word before that make a context, and bits of the least and greatest number of classes; class 0 is the
# start of a text. Totals per context go to all executors: 24 MB for the greatest number, which a terabyte has.
TAIL = 7
LEAST_BITS, MOST_BITS = 8, 20
# Pairs of word and context a bucket collects before it adds them up.
HELD_PAIRS = 1 << 21
BURN_IN = 1
SAMPLES = 3
SEED = 29
# The end of a text is a word of its own, spelled with no bytes.
END_HASH = np.uint64(0x5A17E0D1C3B2A495)


def _squeeze(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed block, each with its length before it; of numbers all first bytes stand together, then
    all second ones and so on."""
    parts = []
    for array in arrays:
        array = np.ascontiguousarray(array)
        raw = array.view(np.uint8).reshape(-1, array.itemsize).T.tobytes() if array.size else b""
        parts += [len(raw).to_bytes(8, "little"), raw]
    return zstandard.ZstdCompressor(level=3).compress(b"".join(parts))


def _spread(block: bytes, *types: str) -> list[np.ndarray]:
    raw, at, arrays = zstandard.ZstdDecompressor().decompress(block), 0, []
    for kind in types:
        size, width = int.from_bytes(raw[at:at + 8], "little"), np.dtype(kind).itemsize
        planes = np.frombuffer(raw, np.uint8, size, at + 8).reshape(width, -1)
        arrays.append(np.ascontiguousarray(planes.T).reshape(-1).view(kind))
        at += 8 + size
    return arrays


def _steps(hashes: np.ndarray) -> np.ndarray:
    """Ascending numbers by how far each is from the one before."""
    return np.diff(hashes, prepend=np.uint64(0))


def _from_steps(steps: np.ndarray) -> np.ndarray:
    return np.cumsum(steps, dtype=np.uint64)


def context_bits(size: int) -> int:
    """Bits of the number of classes of contexts for so many bytes of text."""
    return min(max(round(math.log2(max(size, 1)) / 2), LEAST_BITS), MOST_BITS)


def _bucket_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Buckets are ranges of hashes, so words in order of hash are in order of bucket."""
    return ((hashes >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)


def _gather(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The bytes of given ranges, one after the other."""
    ends = np.cumsum(sizes)
    return data[np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)]


def _classes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, bits: int) -> np.ndarray:
    """The class of a word as a context, from 1 on, from its last bytes."""
    tail = np.zeros(len(starts), np.uint64)
    for back in range(1, TAIL + 1):
        at = ends - back
        tail = tail << np.uint64(8) | np.where(at >= starts, data[np.maximum(at, 0)], 0).astype(np.uint64)
    return (mix(tail) % np.uint64((1 << bits) - 1)).astype(np.int64) + 1


def _key(word: np.ndarray, context: np.ndarray) -> np.ndarray:
    """A pair of word and context as one number."""
    return word.astype(np.int64) << MOST_BITS | context.astype(np.int64)


def _context(key: np.ndarray) -> np.ndarray:
    return (key & ((1 << MOST_BITS) - 1)).astype(np.uint32)


_PACKS = ("pack bigint, bucket int, pairs binary, facts binary, doc_ids array<bigint>, learned array<boolean>, "
          "uses binary")
# Words and contexts of a pack: steps of hashes, numbers of contexts, contexts. Facts: counts of the pairs in what is
# learned from, and sizes and bytes of the words that are.
_PAIRS = ("<u8", "<u4", "<u4")
_FACTS = ("<u4", "<u4", "u1")


def _pack(buckets: int, bits: int):
    """Per pack: a row for each bucket with its words, and one with the uses of words by texts."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        for number, part in enumerate(text_slices(batches, limit=PACK_BYTES)):
            data, offsets = utf8(part.column("text"))
            data = LOWER[data]
            starts, ends = word_borders(data, offsets)
            texts, words = len(part), len(starts)
            text_of = np.searchsorted(offsets, starts, side="right") - 1
            owner = np.concatenate([text_of, np.arange(texts)])
            hashes = np.concatenate([hashes_at(data, starts, ends), np.full(texts, END_HASH)])
            kinds = _classes(data, starts, ends, bits)
            context = np.zeros(words + texts, np.int64)
            context[1:words] = np.where(text_of[1:] == text_of[:-1], kinds[:-1], 0)
            last = np.searchsorted(text_of, np.arange(texts), side="right") - 1
            some = (last >= 0) & (np.take(text_of, np.maximum(last, 0), mode="clip") == np.arange(texts)) \
                if words else np.zeros(texts, bool)
            context[words:][some] = kinds[last[some]]

            order = np.argsort(hashes)
            fresh = np.concatenate([[True], hashes[order][1:] != hashes[order][:-1]])
            word = np.empty(len(hashes), np.int64)
            word[order] = np.cumsum(fresh) - 1
            distinct, first = hashes[order][fresh], order[fresh]
            key = _key(word, context)
            order = np.argsort(key)
            fresh = np.concatenate([[True], key[order][1:] != key[order][:-1]])
            pair = np.empty(len(key), np.int64)
            pair[order] = np.cumsum(fresh) - 1
            pairs = key[order][fresh]
            pair_word, pair_context = pairs >> MOST_BITS, _context(pairs)
            learned = np.array(part.column("learned").to_pylist(), bool)
            counts = np.bincount(pair[learned[owner]], minlength=len(pairs)).astype(np.uint32)

            at, size = np.zeros(len(distinct), np.int64), np.zeros(len(distinct), np.int64)
            real = first < words
            at[real] = starts[first[real]]
            size[real] = ends[first[real]] - starts[first[real]]
            used, times = distinct_counts(owner.astype(np.uint64) << np.uint64(32) | pair.astype(np.uint64))
            cuts = np.searchsorted(used, np.arange(texts + 1, dtype=np.uint64) << np.uint64(32)).astype(np.int64)
            steps = np.diff((used & np.uint64(0xFFFFFFFF)).astype(np.uint32), prepend=np.uint32(0))  # wraps, and back

            home = np.searchsorted(_bucket_of(distinct, buckets), np.arange(buckets + 1))
            rows = []
            for bucket in np.flatnonzero(np.diff(home)).tolist():
                low, high = home[bucket], home[bucket + 1]
                own = slice(*np.searchsorted(pair_word, [low, high]))
                numbers = np.bincount(pair_word[own] - low, minlength=high - low).astype(np.uint32)
                known = np.bincount(pair_word[own] - low, counts[own], high - low) > 0
                rows.append((bucket, _squeeze(_steps(distinct[low:high]), numbers, pair_context[own]),
                             _squeeze(counts[own], np.where(known, size[low:high], 0).astype(np.uint32),
                                      _gather(data, at[low:high][known], size[low:high][known])), None, None, None))
            rows.append((-1, None, None, part.column("doc_id").to_pylist(), learned.tolist(),
                         _squeeze(steps, times.astype(np.uint32), cuts)))
            types = (pa.int32(), pa.binary(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.binary())
            columns = [pa.array(list(column), kind) for column, kind in zip(zip(*rows), types)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([task << 32 | number] * len(rows), pa.int64()), *columns],
                ["pack", "bucket", "pairs", "facts", "doc_ids", "learned", "uses"])
    return pack


def _trained(pairs: bytes, facts: bytes) -> list[np.ndarray]:
    """The words of a pack that are learned from: hashes, numbers of contexts, contexts, counts, sizes, bytes."""
    steps, numbers, context = _spread(pairs, *_PAIRS)
    hashes = _from_steps(steps)
    counts, sizes, spelled = _spread(facts, *_FACTS)
    keep = counts > 0
    numbers = np.bincount(np.repeat(np.arange(len(hashes)), numbers)[keep], minlength=len(hashes)).astype(np.uint32)
    some = numbers > 0
    return [hashes[some], numbers[some], context[keep], counts[keep], sizes[some], spelled]


# The state of a bucket. Per word: step of the hash, number of contexts, size; bytes; tables in the restaurant of words;
# predictive probabilities there, a row per sample. Per context of a word: class, customers, tables, summed tables.
_STATE_TYPES = ("<u8", "<u4", "<u4", "u1", "<u4", "<f4", "<u4", "<u4", "<u4", "<u4")
_STATE = ("bucket int, state binary, contexts array<int>, customers array<bigint>, tables array<bigint>, words bigint, word_tables bigint, "
          "learnable double, ones bigint, twos bigint, word_ones bigint, word_twos bigint")


@dataclass
class Words:
    """The words of a bucket and their seating."""

    hashes: np.ndarray
    numbers: np.ndarray
    sizes: np.ndarray
    spelled: np.ndarray
    word_tables: np.ndarray
    chances: np.ndarray
    context: np.ndarray
    counts: np.ndarray
    tables: np.ndarray
    table_sums: np.ndarray

    @classmethod
    def from_block(cls, block: bytes) -> Words:
        arrays = _spread(block, *_STATE_TYPES)
        arrays[0] = _from_steps(arrays[0])
        arrays[5] = arrays[5].reshape(SAMPLES, -1)
        return cls(*arrays)

    @property
    def owner(self) -> np.ndarray:
        """The word of each pair."""
        return np.repeat(np.arange(len(self.hashes)), self.numbers)

    def per_word(self, values: np.ndarray) -> np.ndarray:
        """Sums over the contexts of each word; every word has one at least."""
        return np.add.reduceat(values.astype(np.int64), np.cumsum(self.numbers, dtype=np.int64) - self.numbers)

    def row(self, bucket: int, learnable: float) -> tuple:
        block = _squeeze(_steps(self.hashes), self.numbers.astype("<u4"), self.sizes.astype("<u4"), self.spelled,
                         self.word_tables.astype("<u4"), self.chances.astype("<f4"), self.context.astype("<u4"),
                         self.counts.astype("<u4"), self.tables.astype("<u4"), self.table_sums.astype("<u4"))
        served = self.per_word(self.tables)
        contexts, place = np.unique(self.context, return_inverse=True)
        totals = [contexts.tolist(), *(np.bincount(place, values, len(contexts)).astype(np.int64).tolist()
                                       for values in (self.counts, self.tables))]
        return (bucket, block, *totals, len(self.hashes), int(self.word_tables.sum()), learnable,
                *(int((values == k).sum()) for values in (self.counts, served) for k in (1, 2)))


def _state_batch(row: tuple) -> pa.RecordBatch:
    kinds = (pa.int32(), pa.binary(), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int64(), pa.int64(), pa.float64(),
             *[pa.int64()] * 4)
    return pa.RecordBatch.from_arrays([pa.array([value], kind) for value, kind in zip(row, kinds)],
                                      [column.split(" ")[0] for column in _STATE.split(", ")])


def _joined(pieces: list[list[np.ndarray]]) -> list[np.ndarray]:
    """Several results of `_trained` in one: words ascending by hash, contexts ascending, counts added."""
    hashes, numbers, context, counts, sizes, spelled = (np.concatenate(column) for column in zip(*pieces))
    order = np.argsort(hashes, kind="stable")
    fresh = np.concatenate([[True], hashes[order][1:] != hashes[order][:-1]])
    word = np.empty(len(hashes), np.int64)
    word[order] = np.cumsum(fresh) - 1
    firsts = order[fresh]
    starts = np.cumsum(sizes, dtype=np.int64) - sizes
    key = _key(np.repeat(word, numbers), context)
    order = np.argsort(key, kind="stable")
    key, counts, _ = grouped(key[order], counts[order].astype(np.uint64))
    numbers = np.bincount(key >> MOST_BITS, minlength=len(firsts)).astype(np.uint32)
    return [hashes[firsts], numbers, _context(key), counts, sizes[firsts],
            _gather(spelled, starts[firsts], sizes[firsts].astype(np.int64))]


def _vocabulary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One state per bucket from the words of its packs; all customers of a dish sit at one table."""
    bucket, pieces, held = None, [], 0

    def flush() -> Iterator[pa.RecordBatch]:
        if not sum(len(piece[0]) for piece in pieces):
            return
        hashes, numbers, context, counts, sizes, spelled = _joined(pieces)
        one = np.ones(len(context), np.uint32)
        words = Words(hashes, numbers, sizes, spelled, np.ones(len(hashes), np.uint32),
                      np.zeros((SAMPLES, len(hashes)), np.float32), context, counts, one, np.zeros_like(one))
        yield _state_batch(words.row(bucket, 0.0))

    for batch in batches:
        for own, pairs, facts in zip(*(batch.column(i).to_pylist() for i in range(3))):
            if bucket is not None and own != bucket:
                yield from flush()
                pieces, held = [], 0
            bucket = own
            pieces.append(_trained(pairs, facts))
            held += len(pieces[-1][2])
            if held > HELD_PAIRS:
                pieces, held = [_joined(pieces)], 0
    if bucket is not None:
        yield from flush()


@dataclass
class Sweep:
    """What all buckets know of the sweep before: spelling, totals per context
    and of the restaurant of words, and the discounts of both."""

    number: int
    spelling: Spelling
    customers: np.ndarray
    tables: np.ndarray
    word_customers: int
    word_tables: int
    rebate: float
    word_rebate: float

    @property
    def weights(self) -> np.ndarray:
        """The weight of the parent in each context."""
        return STRENGTH + self.rebate * self.tables

    def word_chances(self, served, tables, spelled) -> np.ndarray:
        """Predictive probabilities in the restaurant of words."""
        mass = (STRENGTH + self.word_rebate * self.word_tables) * spelled
        return (served - self.word_rebate * tables + mass) / (STRENGTH + self.word_customers)

    def go(self, row: dict) -> tuple:
        """The bucket's next state."""
        words = Words.from_block(row["state"])
        borders = np.concatenate([[0], np.cumsum(words.sizes, dtype=np.int64)])
        spelled = np.exp(self.spelling.log_words(words.spelled, borders))
        chances = self.word_chances(words.per_word(words.tables), words.word_tables.astype(np.int64), spelled)
        sample = self.number - BURN_IN - 1
        if sample >= 0:
            words.chances = words.chances.copy()
            words.chances[sample] = chances
            words.table_sums = words.table_sums + words.tables
        if sample < SAMPLES - 1:
            random = np.random.default_rng([SEED, self.number, row["bucket"]])
            words.tables = seat(words.counts.astype(np.int64), self.weights[words.context] * chances[words.owner],
                                self.rebate, random)
            mass = (STRENGTH + self.word_rebate * self.word_tables) * spelled
            words.word_tables = seat(words.per_word(words.tables), mass, self.word_rebate, random)
        return words.row(row["bucket"], float(spelled.sum()))


def _advance(shared):
    def advance(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                yield _state_batch(shared.value.go(row))
    return advance


def _customers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What the tables of the words spell: customers of the longest contexts."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    for batch in batches:
        for state in batch.column(0).to_pylist():
            words = Words.from_block(state)
            sizes, spelled, tables = words.sizes, words.spelled, words.word_tables
            borders = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
            low = 0
            while low < len(sizes):
                high = max(int(np.searchsorted(borders, borders[low] + (1 << 20), side="right")) - 1, low + 1)
                codes, places = spelling_codes(spelled[borders[low]:borders[high]], borders[low:high + 1] - borders[low])
                weight = np.repeat(tables[low:high].astype(np.int64), np.diff(places))
                if weight.any():
                    held.append(merged([(codes[weight > 0], weight[weight > 0])]))
                low = high
            if sum(len(piece[0]) for piece in held) > 1 << 21:
                held = [merged(held)]
    if held:
        yield packed({(0,): held}, _SPELLED_KEYS)


_SPELLED_KEYS = (("level", pa.int32()),)
_SPELLED = "level int, part int, codes binary, counts binary"


def _spelling(states: DataFrame, before: Spelling | None, number: int) -> Spelling:
    counted = over_batches(states.select("state"), _customers, _SPELLED)
    sums = over_batches(counted.repartition("part").sortWithinPartitions("level", "part"), add_up(_SPELLED_KEYS),
                        _SPELLED)
    # At most as many rows as there are ranges of numbers below 2**24.
    rows = sorted(sums.collect(), key=lambda row: row["part"])
    codes = np.concatenate([np.frombuffer(row["codes"], np.uint32) for row in rows])
    counts = np.concatenate([np.frombuffer(row["counts"], "<i8") for row in rows])
    return Spelling(codes, counts, np.random.default_rng([SEED, number, 1 << 20]), before)


@dataclass
class Averages:
    """What answers need besides the states: customers per context, the
    parent's weights per sample and context, the discount, and the logarithm of
    the probability of the unlearned word per context."""

    customers: np.ndarray
    weights: np.ndarray
    rebate: float
    unknown: np.ndarray

    def logs(self, words: Words, hashes: np.ndarray, numbers: np.ndarray, context: np.ndarray) -> tuple:
        """Log probabilities of asked pairs of word and context, and the counts of the words."""
        at = np.minimum(np.searchsorted(words.hashes, hashes), len(words.hashes) - 1)
        known = words.hashes[at] == hashes
        totals = np.where(known, words.per_word(words.counts)[at], 0)
        word, found = np.repeat(at, numbers), np.repeat(known, numbers)
        keys, wanted = _key(words.owner, words.context), _key(word, context)
        pair = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        seated = keys[pair] == wanted
        own = np.where(seated, words.counts[pair] - self.rebate * words.table_sums[pair] / SAMPLES, 0.0)
        parent = (self.weights[:, context] * words.chances[:, word]).sum(axis=0) / SAMPLES
        logs = np.where(found, np.log10((own + parent) / (STRENGTH + self.customers[context])), self.unknown[context])
        return logs.astype(np.float32), totals.astype(np.uint64), numbers


def _answers(shared):
    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """For each pack, the log probabilities and counts of its words; a bucket's state comes first."""
        bucket = words = None
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                if row["state"] is not None:
                    bucket, words = row["bucket"], Words.from_block(row["state"])
                    continue
                steps, numbers, context = _spread(row["pairs"], *_PAIRS)
                hashes = _from_steps(steps)
                if row["bucket"] == bucket:
                    found = shared.value.logs(words, hashes, numbers, context)
                else:  # nothing in this bucket is learned
                    found = shared.value.unknown[context].astype(np.float32), np.zeros(len(hashes), np.uint64), numbers
                rows.append((row["pack"], row["bucket"], _squeeze(*found)))
            if rows:
                columns = list(zip(*rows))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int32()), binary(list(columns[2]))],
                    ["pack", "bucket", "answers"])
    return answer


_SCORES = "doc_id bigint, learned boolean, n_tokens bigint, n_known bigint, base_score double, score double"


def _add_scores(tokens: int, types: int):
    """The scores of a pack's texts; the answers of its buckets come in order and before its uses."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        logs, counts = [], []
        for batch in batches:
            for row in batch.to_pylist():
                if row["answers"] is not None:
                    log, count, numbers = _spread(row["answers"], "<f4", "<u8", "<u4")
                    logs.append(log)
                    counts.append(np.repeat(count, numbers))
                    continue
                steps, times, cuts = _spread(row["uses"], "<u4", "<u4", "<i8")
                pair = np.cumsum(steps, dtype=np.uint32)
                log, count = np.concatenate(logs).astype(np.float64), np.concatenate(counts)
                base = np.log10((count + 1.0) / (tokens + types + 1.0))

                def total(values: np.ndarray) -> np.ndarray:
                    return np.add.reduceat(values, cuts[:-1])

                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["doc_ids"], pa.int64()), pa.array(row["learned"]),
                     pa.array(total(times.astype(np.int64))), pa.array(total(times * (count[pair] > 0).astype(np.int64))),
                     pa.array(total(times * base[pair])), pa.array(total(times * log[pair]))],
                    [column.split(" ")[0] for column in _SCORES.split(", ")])
                logs, counts = [], []
    return add


def _rebate(ones: int, twos: int) -> float:
    return min(max(ones / (ones + 2 * twos), 0.05), 0.95) if ones and twos else 0.5


def _per_context(states: DataFrame, name: str, bits: int) -> np.ndarray:
    """Totals of an array column over all buckets, for every context."""
    totals = np.zeros(1 << bits, np.int64)
    pairs = states.select(F.inline(F.arrays_zip("contexts", F.col(name).alias("number"))))
    # One row per context.
    for context, total in pairs.groupBy("contexts").agg(F.sum("number")).collect():
        totals[context] = total
    return totals


def score(docs: DataFrame, learn: Column) -> DataFrame:
    """Per row: `doc_id`, `learned`, `n_tokens`, `n_known`, `train_tokens`,
    `base_score`, `score` and `perplexity`, learning from the rows where `learn`
    holds (null: it does not).

    A null text counts as empty and has one token, its end. Rows may repeat and
    count as often. An empty table gives an empty result. If nothing is learned
    from, there is only the unlearned word, and every score is 0.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "scoring")
    chosen = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"),
                         F.coalesce(learn, F.lit(False)).alias("learned"))
    size = chosen.agg(F.sum(F.octet_length("text").cast("bigint"))).first()[0] or 0
    buckets = max(size // BUCKET_BYTES, LEAST_BUCKETS)
    bits = context_bits(size)
    packs = scratch.store(over_batches(chosen, _pack(buckets, bits), _PACKS), "packs")
    filled = packs.filter("bucket >= 0")
    states = scratch.store(
        over_batches(filled.select("bucket", "pairs", "facts").repartition(buckets, "bucket")
                     .sortWithinPartitions("bucket"), _vocabulary, _STATE), "states")
    names = ("words", "word_tables", "learnable", "ones", "twos", "word_ones", "word_twos")
    customers = _per_context(states, "customers", bits)
    tokens, types = int(customers.sum()), states.agg(F.sum("words")).first()[0] or 0
    spelling, rebate, weights, unknown = None, 0.5, [], []
    for number in range(1, BURN_IN + SAMPLES + 1) if tokens else ():
        sums = states.agg(*[F.sum(name).alias(name) for name in names]).first()
        tables = _per_context(states, "tables", bits)
        spelling = _spelling(states, spelling, number)
        rebate = _rebate(sums["ones"], sums["twos"])
        sweep = Sweep(number, spelling, customers, tables, int(tables.sum()), sums["word_tables"], rebate,
                      _rebate(sums["word_ones"], sums["word_twos"]))
        shared = spark.sparkContext.broadcast(sweep)
        advanced = scratch.store(over_batches(states, _advance(shared), _STATE), "states")
        scratch.drop(states)
        states = advanced
        if number > BURN_IN:
            left = max(1.0 - states.agg(F.sum("learnable")).first()[0], 1e-12)
            weights.append(sweep.weights)
            unknown.append(sweep.weights * sweep.word_chances(0, 0, left) / (STRENGTH + customers))
    averages = Averages(customers, np.array(weights), rebate,
                        np.log10(np.mean(unknown, axis=0)) if unknown else np.zeros(1 << bits))
    nothing = F.lit(None)
    asked = filled.select("bucket", nothing.cast("binary").alias("state"), "pack", "pairs")
    known = states.select("bucket", "state", nothing.cast("bigint").alias("pack"), nothing.cast("binary").alias("pairs"))
    met = known.unionAll(asked).repartition(buckets, "bucket").sortWithinPartitions(
        "bucket", F.col("pack").asc_nulls_first())
    answers = over_batches(met, _answers(spark.sparkContext.broadcast(averages)),
                           "pack bigint, bucket int, answers binary")
    parts = answers.select("pack", "bucket", "answers", nothing.cast("array<bigint>").alias("doc_ids"),
                           nothing.cast("array<boolean>").alias("learned"), nothing.cast("binary").alias("uses"))
    uses = packs.filter("bucket < 0").select("pack", F.lit(buckets).cast("int").alias("bucket"),
                                             nothing.cast("binary").alias("answers"), "doc_ids", "learned", "uses")
    together = parts.unionAll(uses).repartition("pack").sortWithinPartitions("pack", "bucket")
    return (over_batches(together, _add_scores(tokens, types), _SCORES)
            .withColumn("train_tokens", F.lit(tokens).cast("bigint"))
            .withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens"))))
