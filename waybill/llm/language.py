"""Language identification by character models with Kneser-Ney smoothing.

Letters are told apart as they are, after lower case; those beyond 16 bits share
the numbers of the private use area by a hash. Combining marks (vowel signs, tone
marks, accents) count as letters in texts that have some, as words go on over
them. Everything between letters is one border; letters in one run with digits
belong to a number or code and are passed over, unless a text has no others. A
model of a language predicts each character, and the border that ends a word,
from the three characters before it in the same word. Four characters make a
64-bit number.

Interpolated Kneser-Ney: the longest context uses counts, shorter ones count the
distinct characters seen before them. Numbers of n-grams stand in sorted arrays
next to their log probabilities and are found by binary search.

N-grams of all texts are counted, in ranges of a hash. Models of at most
`ENTRIES` n-grams of full length together go to all executors. Beyond that the
same models are tables with a row per n-gram: the distinct n-grams of the texts
are joined with them, and what was found is added up per text.

The language with the lowest cross-entropy per predicted class is chosen. How
high it may be is calibrated per language and text length on a fold of the
learning documents that this model has not seen; a text above that limit is
rejected, as is one without a letter.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waybill.llm.arrow import text_slices
from waybill.llm.codes import grouped, merged
from waybill.llm.columns import free_name, quoted, with_text
from waybill.llm.scratch import Scratch
from waybill.llm.tasks import over_batches, with_made
from waybill.llm.tokens import distinct_counts, mix
from waybill.session import remove

ORDER = 4
BITS = 16
CLASSES = 1 << BITS
UNKNOWN = "und"
# N-grams of full length in models that go to all executors, and the ranges in which a language's are counted.
ENTRIES = 1 << 24
PARTS = 64
# N-grams a task holds before it passes their counts on.
HELD_CODES = 1 << 22
# The limit lies so many standard deviations above the mean of texts of similar length, and at
# least at this part of the way from the mean to the entropy of an alphabet's letters drawn at random: texts
# with passages in a second language are no noise.
DEVIATIONS = 6.0
LEAST_WAY = 0.4
RANDOM_BITS = 6.0
SLICE = 1 << 20
MADE = "lang_pred string, score double, cross_entropy double, rejected boolean"

DIGIT = CLASSES - 1
_PRIVATE, _PRIVATE_SIZE = 0xE000, 6400

_classes: tuple[np.ndarray, np.ndarray] | None = None


def letter_classes() -> tuple[np.ndarray, np.ndarray]:
    """The number of every code point as a character of words: its lower case, `DIGIT` for digits, else 0; and
    whether it is a letter."""
    global _classes
    if _classes is None:
        table, letters = np.zeros(0x110000, np.uint16), np.zeros(0x110000, bool)
        for code in range(0x110000):
            character = chr(code)
            letters[code] = character.isalpha()
            if letters[code] or unicodedata.category(character)[0] == "M":
                low = ord(character.lower()[0])
                table[code] = low if low < CLASSES else _PRIVATE + (low * 2654435761 >> 7) % _PRIVATE_SIZE
            elif character.isdigit():
                table[code] = DIGIT
        _classes = table, letters
    return _classes


def _words_only(classes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Classes with digits as borders, and letters next to them too, except in texts that have no other letters."""
    digit = classes == DIGIT
    if not digit.any():
        return classes
    inside = classes > 0
    fresh = inside.copy()
    fresh[1:] &= ~inside[:-1]
    run = np.cumsum(fresh, dtype=np.int32)
    coded = np.zeros(run[-1] + 1, bool)
    coded[run[digit]] = True
    plain = np.where(digit, np.uint16(0), classes)
    words = np.where(coded[run], np.uint16(0), plain)
    sums = np.concatenate([[0], np.cumsum(words > 0, dtype=np.int32)])
    for text in np.flatnonzero(sums[starts[1:]] == sums[starts[:-1]]):
        low, high = starts[text], starts[text + 1]
        words[low:high] = plain[low:high]
    return words


def text_codes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of all predicted n-grams of a slice of texts, and where each text's begin and end.

    The number of an n-gram holds the predicted class in its lowest bits. A
    context ends at the border of its word, so texts do not touch each other.
    """
    lengths = pc.fill_null(pc.utf8_length(column), 0).to_numpy()
    joined = " " + " ".join(text or "" for text in column.to_pylist()) + " "
    starts = 1 + np.concatenate([[0], np.cumsum(lengths + 1)])  # of each text in the joined one
    table, letters = letter_classes()
    read = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
    classes, sums = table[read], np.concatenate([[0], np.cumsum(letters[read], dtype=np.int32)])
    for text in np.flatnonzero((sums[starts[1:]] == sums[starts[:-1]]) & (lengths > 0)):
        classes[starts[text]:starts[text + 1]] = 0  # marks without a letter
    classes = _words_only(classes, starts)
    keep = classes > 0
    keep[1:] |= classes[:-1] > 0
    places = np.flatnonzero(keep)
    borders = np.searchsorted(places, starts)
    borders[-1] = len(places)
    kept = classes[places].astype(np.uint64)
    code, context = kept.copy(), np.ones(len(kept), bool)
    for back in range(1, ORDER):
        before = np.zeros(len(kept), np.uint64)
        before[back:] = kept[:-back]
        context &= before > 0
        code |= np.where(context, before, np.uint64(0)) << np.uint64(BITS * back)
    return code, borders


@dataclass
class Model:
    """Sorted n-gram numbers of one language with log probabilities, per order,
    and sorted contexts with the log weight they leave to the shorter context."""

    grams: list[np.ndarray]
    logs: list[np.ndarray]
    contexts: list[np.ndarray]
    weights: list[np.ndarray]

    def log2(self, codes: np.ndarray) -> np.ndarray:
        """Log probabilities of n-grams; unseen ones fall back to shorter contexts."""
        result = np.full(len(codes), -np.log2(CLASSES))
        pending, scale = np.arange(len(codes)), np.zeros(len(codes))
        for order in range(ORDER, 0, -1):
            keys = codes[pending] & np.uint64((1 << BITS * order) - 1)
            grams = self.grams[order - 1]
            at = np.minimum(np.searchsorted(grams, keys), len(grams) - 1)
            seen = grams[at] == keys
            result[pending[seen]] = scale[pending[seen]] + self.logs[order - 1][at[seen]]
            pending, keys = pending[~seen], keys[~seen]
            contexts = self.contexts[order - 1]
            at = np.minimum(np.searchsorted(contexts, keys >> np.uint64(BITS)), len(contexts) - 1)
            known = contexts[at] == keys >> np.uint64(BITS)
            scale[pending[known]] += self.weights[order - 1][at[known]]
        result[pending] = scale[pending] - np.log2(CLASSES)
        return result


def fit(codes: np.ndarray, counts: np.ndarray) -> Model:
    """The model of one language from ascending distinct n-grams and their counts."""
    model = Model([None] * ORDER, [None] * ORDER, [None] * ORDER, [None] * ORDER)
    levels = {ORDER: (codes, counts.astype(np.float64))}
    for order in range(ORDER - 1, 0, -1):
        shorter = np.sort(levels[order + 1][0] & np.uint64((1 << BITS * order) - 1))
        keys, kinds, _ = grouped(shorter, np.ones(len(shorter)))
        levels[order] = keys, kinds
    below = np.full(1, 1.0 / CLASSES)
    for order in range(1, ORDER + 1):
        keys, values = levels[order]
        ones, twos = (values == 1).sum(), (values == 2).sum()
        discount = ones / (ones + 2 * twos) if ones and twos else 0.5
        contexts, totals, kinds = grouped(keys >> np.uint64(BITS), values)
        place = np.searchsorted(contexts, keys >> np.uint64(BITS))
        left = discount * kinds / totals
        if order == 1:
            shorter = np.full(len(keys), below[0])
        else:
            at = np.searchsorted(model.grams[order - 2], keys & np.uint64((1 << BITS * (order - 1)) - 1))
            shorter = np.exp2(model.logs[order - 2][at])
        chance = (values - discount) / totals[place] + left[place] * shorter
        model.grams[order - 1], model.logs[order - 1] = keys, np.log2(chance)
        model.contexts[order - 1], model.weights[order - 1] = contexts, np.log2(left)
    return model


_COUNTS = "lang string, fold int, part int, codes binary, counts binary"
_LEVELS = "lang string, fold int, level int, number bigint"

Pieces = list[tuple[np.ndarray, np.ndarray]]


def _rows(held: dict[tuple[str, int], Pieces]) -> pa.RecordBatch:
    """One row per language, fold and range of a hash."""
    rows = []
    for (lang, fold), pieces in held.items():
        codes, counts = merged(pieces)
        parts = (mix(codes.copy()) >> np.uint64(58)).astype(np.int32)
        order = np.argsort(parts, kind="stable")
        cuts = np.searchsorted(parts[order], np.arange(PARTS + 1))
        for part, (low, high) in enumerate(zip(cuts[:-1], cuts[1:])):
            if high > low:
                chosen = order[low:high]  # ascending, as the order is stable
                rows.append((lang, fold, part, codes[chosen].tobytes(), counts[chosen].astype("<i8").tobytes()))
    kinds = (pa.string(), pa.int32(), pa.int32(), pa.binary(), pa.binary())
    columns = list(zip(*rows)) if rows else [[]] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(list(column), kind) for column, kind in zip(columns, kinds)],
                                      ["lang", "fold", "part", "codes", "counts"])


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[tuple[str, int], Pieces] = {}
    number = 0
    for part in text_slices(batches, limit=SLICE):
        codes, borders = text_codes(part.column("text"))
        owners = list(zip(part.column("lang").to_pylist(), part.column("fold").to_pylist()))
        kinds: dict[tuple[str, int], int] = {}
        owner = np.repeat([kinds.setdefault(one, len(kinds)) for one in owners], np.diff(borders))
        for one, kind in kinds.items():
            keys, counts = distinct_counts(codes[owner == kind])
            if len(keys):
                held.setdefault(one, []).append((keys, counts))
                number += len(keys)
        if number > HELD_CODES:
            held = {one: [merged(pieces)] for one, pieces in held.items()}
            number = sum(len(pieces[0][0]) for pieces in held.values())
            if number > HELD_CODES // 2:
                yield _rows(held)
                held, number = {}, 0
    if held:
        yield _rows(held)


def _read(row: dict) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(row["codes"], np.uint64), np.frombuffer(row["counts"], "<i8")


def _add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per language, fold and range, from rows sorted by these."""
    current, pieces, number = None, [], 0

    def flush() -> pa.RecordBatch:
        codes, counts = merged(pieces)
        return pa.RecordBatch.from_arrays(
            [pa.array([current[0]], pa.string()), pa.array([current[1]], pa.int32()), pa.array([current[2]], pa.int32()),
             pa.array([codes.tobytes()], pa.binary()), pa.array([counts.astype("<i8").tobytes()], pa.binary())],
            ["lang", "fold", "part", "codes", "counts"])

    for batch in batches:
        for row in batch.to_pylist():
            group = (row["lang"], row["fold"], row["part"])
            if current is not None and group != current:
                yield flush()
                pieces, number = [], 0
            current = group
            pieces.append(_read(row))
            number += len(pieces[-1][0])
            if len(pieces) > 1 and number > HELD_CODES:
                pieces = [merged(pieces)]
                number = len(pieces[0][0])
    if current is not None:
        yield flush()


def _counted_levels(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many n-grams occur 1, 2 to 3, 4 to 7, … times."""
    for batch in batches:
        for row in batch.to_pylist():
            levels, numbers = np.unique(np.log2(_read(row)[1]).astype(np.int32), return_counts=True)
            yield pa.RecordBatch.from_pydict(
                {"lang": [row["lang"]] * len(levels), "fold": pa.array([row["fold"]] * len(levels), pa.int32()),
                 "level": pa.array(levels, pa.int32()), "number": pa.array(numbers, pa.int64())})


def least_counts(levels: dict[tuple[str, int], dict[int, int]], entries: int) -> dict[tuple[str, int], int]:
    """Per language and fold the least power of two such that at most its share of `entries` n-grams occur as often."""
    share = entries // max(len(levels), 1)
    least = {}
    for group, numbers in levels.items():
        left, level = sum(numbers.values()), 0
        while left > share:
            left -= numbers.get(level, 0)
            level += 1
        least[group] = 1 << level
    return least


def _kept(batches: Iterator[pa.RecordBatch], least: dict[tuple[str, int], int]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for row in batch.to_pylist():
            codes, counts = _read(row)
            chosen = counts >= least[row["lang"], row["fold"]]
            if chosen.any():
                rows.append({**row, "codes": codes[chosen].tobytes(), "counts": counts[chosen].tobytes()})
        if rows:
            yield pa.RecordBatch.from_pylist(rows, batch.schema)


def _models(counted: list, folds: tuple[int, ...]) -> dict[str, Model]:
    pieces: dict[str, Pieces] = {}
    for row in counted:
        if row["fold"] in folds:
            pieces.setdefault(row["lang"], []).append(_read(row))
    return {lang: fit(*merged(found)) for lang, found in sorted(pieces.items())}


def entropies(column: pa.Array, models: dict[str, Model]) -> tuple[np.ndarray, np.ndarray]:
    """Bits per predicted character of each text under each model, and the number of predictions."""
    codes, borders = text_codes(column)
    found, place = np.unique(codes, return_inverse=True)
    bits = np.zeros((len(column), len(models)))
    for number, model in enumerate(models.values()):
        sums = np.concatenate([[0.0], np.cumsum(model.log2(found)[place])])
        bits[:, number] = sums[borders[:-1]] - sums[borders[1:]]
    sizes = np.diff(borders)
    return bits / np.maximum(sizes, 1)[:, None], sizes


Spread = dict[str, tuple[float, float, float]]


def _decided(bits: np.ndarray, sizes: np.ndarray, langs: list[str],
             spread: Spread) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """Languages, scores, cross-entropies and whether each text is rejected, from its bits per predicted
    character in every language and the number of predictions."""
    best = bits.argmin(axis=1)
    least = bits[np.arange(len(bits)), best]
    # How sure the choice is, by at most as many predictions as a short sentence has.
    weight = np.exp2(-(bits - least[:, None]) * np.minimum(sizes, 40)[:, None]).sum(axis=1)
    mean, single, between = np.array([spread.get(lang, (np.inf, 0.0, 0.0)) for lang in langs])[best].T
    above = DEVIATIONS * np.sqrt(single / np.maximum(sizes, 1) + between)
    limit = mean + np.maximum(above, LEAST_WAY * (RANDOM_BITS - np.minimum(mean, RANDOM_BITS)))
    empty = sizes == 0
    names = [UNKNOWN if none else langs[i] for i, none in zip(best, empty)]
    return names, np.where(empty, 0.0, 1 / weight), np.where(empty, 0.0, least), empty | (least > limit)


@dataclass
class Tables:
    """The models of all languages as tables, by order: `lang, key, log` of
    n-grams, and `lang, context, weight`."""

    langs: list[str]
    grams: list[DataFrame]
    contexts: list[DataFrame]
    scratch: Scratch


@dataclass
class Identifier:
    """Models per language and, per language, mean, variance of a single
    prediction and variance between texts of the cross-entropy.

    With `tables`, which have all n-grams, texts are scored by these, and
    `models` has only the most frequent n-grams, as many as one machine holds.
    """

    models: dict[str, Model]
    spread: Spread
    tables: Tables | None = None

    def predict(self, column: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
        """Languages, scores, cross-entropies and whether each text is rejected."""
        rows = len(column)
        if not self.models:
            return [UNKNOWN] * rows, np.zeros(rows), np.zeros(rows), np.ones(rows, bool)
        return _decided(*entropies(column, self.models), list(self.models), self.spread)


def _part(key: str, order: int) -> Column:
    """The last `order` characters of an n-gram."""
    return F.col(key).bitwiseAND(F.lit((1 << BITS * order) - 1)) if order < ORDER else F.col(key)


def _context(key: Column) -> Column:
    return F.shiftrightunsigned(key, BITS)


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            codes, counts = _read(row)
            for low in range(0, len(codes), SLICE):
                keys = pa.array(codes[low:low + SLICE].view(np.int64))
                yield pa.RecordBatch.from_arrays([pa.array([row["lang"]] * len(keys), pa.string()), keys,
                                                  pa.array(counts[low:low + SLICE].astype(np.int64))], ["lang", "key", "value"])


def tabled(counted: DataFrame, folds: tuple[int, ...], langs: list[str], scratch: Scratch) -> Tables:
    """What `fit` computes, for all languages and in tables, from the packed counts of n-grams."""
    rows = over_batches(counted.filter(F.col("fold").isin(*folds)), _unpacked, "lang string, key bigint, value bigint")
    values = {ORDER: scratch.store(rows.groupBy("lang", "key").agg(F.sum("value").alias("value")), "values")}
    for order in range(ORDER - 1, 0, -1):
        shorter = values[order + 1].groupBy("lang", _part("key", order).alias("key")).agg(F.count(F.lit(1)).alias("value"))
        values[order] = scratch.store(shorter, "values")
    made = Tables(langs, [], [], scratch)
    for order in range(1, ORDER + 1):
        # One row per language.
        seldom = values[order].groupBy("lang").agg(F.count_if(F.col("value") == 1), F.count_if(F.col("value") == 2)).collect()
        discount = F.lit(0.5)
        for lang, ones, twos in seldom:
            if ones and twos:
                discount = F.when(F.col("lang") == lang, ones / (ones + 2 * twos)).otherwise(discount)
        totals = (values[order].groupBy("lang", _context(F.col("key")).alias("context"))
                  .agg(F.sum("value").alias("_total"), F.count(F.lit(1)).alias("_kinds"))
                  .withColumn("_left", discount * F.col("_kinds") / F.col("_total")))
        grams = values[order].withColumn("context", _context(F.col("key"))).join(totals, ["lang", "context"])
        if order == 1:
            grams = grams.withColumn("_shorter", F.lit(1.0 / CLASSES))
        else:
            below = made.grams[-1].select("lang", F.col("key").alias("_below"), F.pow(F.lit(2.0), "log").alias("_shorter"))
            grams = grams.withColumn("_below", _part("key", order - 1)).join(below, ["lang", "_below"])
        chance = (F.col("value") - discount) / F.col("_total") + F.col("_left") * F.col("_shorter")
        made.contexts.append(scratch.store(totals.select("lang", "context", F.log2("_left").alias("weight")), "contexts"))
        made.grams.append(scratch.store(grams.select("lang", "key", F.log2(chance).alias("log")), "grams"))
    scratch.drop(*values.values())
    return made


def _logs(codes: DataFrame, tables: Tables) -> DataFrame:
    """`code, logs`: the log probabilities of n-grams in each language, unseen ones by shorter contexts, as `Model.log2`."""
    asked = codes.withColumn("lang", F.explode(F.array(*[F.lit(lang) for lang in tables.langs])))
    scale, found = F.lit(0.0), []
    for order in range(ORDER, 0, -1):
        grams = tables.grams[order - 1].select("lang", F.col("key").alias("_key"), F.col("log").alias(f"_log{order}"))
        contexts = tables.contexts[order - 1].select("lang", F.col("context").alias("_key"),
                                                     F.col("weight").alias(f"_weight{order}"))
        # Those of single characters have a bound.
        grams, contexts = (F.broadcast(grams) if order == 1 else grams), (F.broadcast(contexts) if order <= 2 else contexts)
        asked = asked.withColumn("_key", _part("code", order)).join(grams, ["lang", "_key"], "left").drop("_key")
        asked = (asked.withColumn("_key", _context(_part("code", order))).join(contexts, ["lang", "_key"], "left")
                 .drop("_key"))
        found.append(scale + F.col(f"_log{order}"))
        scale = scale + F.coalesce(f"_weight{order}", F.lit(0.0))
    log = F.coalesce(*found, scale - float(np.log2(CLASSES)))
    return asked.select("code", "lang", log.alias("log")).groupBy("code").agg(
        *[F.max(F.when(F.col("lang") == lang, F.col("log"))).alias(f"_l{number}") for number, lang in enumerate(tables.langs)])


def _distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct n-grams of every text, and how often it has them."""
    for part in text_slices(batches, limit=SLICE):
        codes, borders = text_codes(part.column("text"))
        for row, low, high in zip(part.column("row").to_pylist(), borders[:-1], borders[1:]):
            keys, counts = distinct_counts(codes[low:high])
            if len(keys):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(keys), row, np.int64)), pa.array(keys.astype(np.uint64).view(np.int64)),
                     pa.array(counts.astype(np.int64))], ["row", "code", "number"])


def _scored_by_tables(docs: DataFrame, identifier: Identifier, keep: tuple[str, ...]) -> DataFrame:
    tables, spread = identifier.tables, identifier.spread
    langs, schema = list(tables.langs), with_made(docs, keep, MADE)
    kept = with_text(docs, keep)
    row = free_name(kept, "_row")
    # Written first, so that the numbers of rows never change.
    numbered = tables.scratch.store(kept.withColumn(row, F.monotonically_increasing_id()), "rows")
    pieces = tables.scratch.store(over_batches(numbered.select(F.col(row).alias("row"), "text"), _distinct,
                                               "row bigint, code bigint, number bigint"), "pieces")
    logs = tables.scratch.store(_logs(pieces.select("code").distinct(), tables), "logs")
    names = [f"_l{number}" for number in range(len(langs))]
    sums = pieces.join(logs, "code").groupBy(F.col("row").alias("_of")).agg(
        F.sum("number").alias("_size"), *[F.sum(F.col("number") * F.col(name)).alias(name) for name in names])
    # The names of the sums are told apart from kept ones by a struct.
    sums = sums.select("_of", F.struct("_size", *names).alias("_sums"))
    made = free_name(kept, "_sums")
    joined = (numbered.join(sums, F.col(quoted(row)) == F.col("_of"), "left")
              .select(*[numbered[quoted(name)] for name in keep], sums["_sums"].alias(made)))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sums or {} for sums in batch.column(made).to_pylist()]
            sizes = np.array([one.get("_size") or 0 for one in found], np.int64)
            total = np.array([[one.get(name) or 0.0 for name in names] for one in found]).reshape(len(found), len(names))
            decided = _decided(-total / np.maximum(sizes, 1)[:, None], sizes, langs, spread)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(name) for name in keep), *(pa.array(values) for values in decided)], schema.names)

    return over_batches(joined, score, schema)


def _scored(docs: DataFrame, identifier: Identifier, keep: tuple[str, ...]) -> DataFrame:
    if identifier.tables is not None:
        return _scored_by_tables(docs, identifier, keep)
    shared = docs.sparkSession.sparkContext.broadcast(identifier)
    schema = with_made(docs, keep, MADE)
    columns = schema.names

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, limit=SLICE):
            text = part.column("text")
            names, scores, bits, rejected = shared.value.predict(text)
            yield pa.RecordBatch.from_arrays(
                [*(part.column(name) for name in keep), pa.array(names), pa.array(scores), pa.array(bits),
                 pa.array(rejected)], columns)

    return over_batches(with_text(docs, keep), score, schema)


def _calibrated(checked: DataFrame) -> dict[str, tuple[float, float, float]]:
    """Mean and spread of the cross-entropy per language, from one row per language and length class."""
    sized = checked.filter("lang = lang_pred").withColumn("_bin", F.floor(F.log2(F.col("_letters") + 1)))
    rows = sized.groupBy("lang", "_bin").agg(
        F.count(F.lit(1)).alias("n"), F.avg("cross_entropy").alias("mean"),
        F.var_pop("cross_entropy").alias("variance"),
        F.avg(1 / F.greatest("_letters", F.lit(1))).alias("inverse")).collect()
    spread = {}
    for lang in {row["lang"] for row in rows}:
        n, mean, variance, inverse = np.array(
            [(row["n"], row["mean"], row["variance"], row["inverse"]) for row in rows if row["lang"] == lang]).T
        centre = (n * mean).sum() / n.sum()
        wide = variance + (mean - centre) ** 2
        weight = np.sqrt(n)
        single, between = np.linalg.lstsq(
            np.column_stack([inverse, np.ones(len(n))]) * weight[:, None], wide * weight, rcond=None)[0]
        least = (n * wide).sum() / n.sum() / 4
        spread[lang] = float(centre), max(float(single), 0.5), max(float(between), float(least), 1e-3)
    return spread


def learn(docs: DataFrame, fold: Column, entries: int = ENTRIES) -> Identifier:
    """Models of the values of `lang` from the texts whose `fold` is 0 or 1.

    Limits of rejection come from texts of fold 1 under models of fold 0; the
    models returned are learned from both. Rows with a null text, language or
    fold are not learned from. Without any there are no models, and every text
    is unknown. If the texts have more than `entries` n-grams, models are tables.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "language")
    chosen = (docs.select("text", F.col("lang").cast("string").alias("lang"), fold.cast("int").alias("fold"))
              .filter("text IS NOT NULL AND lang IS NOT NULL AND fold IN (0, 1)"))
    keys = ("lang", "fold", "part")
    counted = over_batches(chosen, _count, _COUNTS).repartition(*keys).sortWithinPartitions(*keys)
    stored = scratch.store(over_batches(counted, _add_up, _COUNTS), "counts")
    levels: dict[tuple[str, int], dict[int, int]] = {}
    # At most 64 rows per language and fold, and then at most `entries` n-grams.
    for row in over_batches(stored, _counted_levels, _LEVELS).groupBy("lang", "fold", "level").agg(
            F.sum("number").alias("number")).collect():
        levels.setdefault((row["lang"], row["fold"]), {})[row["level"]] = row["number"]
    whole = sum(sum(numbers.values()) for numbers in levels.values()) <= entries
    least = dict.fromkeys(levels, 1) if whole else least_counts(levels, entries)
    rows = over_batches(stored, lambda batches: _kept(batches, least), _COUNTS).collect()

    def identifier(folds: tuple[int, ...], place: Scratch) -> Identifier:
        langs = sorted({lang for lang, own in levels if own in folds})
        return Identifier(_models(rows, folds), {}, None if whole or not langs else tabled(stored, folds, langs, place))

    trial = Scratch(spark, "language-trial")
    checked = _scored(chosen.filter("fold = 1").withColumn("_letters", F.length("text")), identifier((0,), trial),
                      ("lang", "_letters"))
    spread = _calibrated(checked)
    if not whole:
        remove(spark, trial.root)
    found = identifier((0, 1), scratch)
    found.spread = spread
    scratch.drop(stored)
    return found


def identify(docs: DataFrame, identifier: Identifier, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns `keep`, `lang_pred`, `score` (0 to 1), `cross_entropy` in
    bits and `rejected`; a new name that is taken gets underscores appended.

    A null text, or one without letters, is `und` with score 0 and is rejected.
    Equal entropies go to the alphabetically first language. Rows may repeat;
    an empty table gives an empty result.
    """
    return _scored(docs, identifier, keep)


def accepted(docs: DataFrame, identifier: Identifier) -> DataFrame:
    """The rows of `docs` whose text is in one of the learned languages."""
    columns = docs.columns
    found = identify(docs, identifier, tuple(columns))
    return found.filter(~F.col(quoted(found.columns[-1]))).select(*[quoted(name) for name in columns])
