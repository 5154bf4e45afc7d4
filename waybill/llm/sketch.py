"""Document fingerprints: invertible Bloom lookup sketches of paragraphs.

A text is cut into paragraphs at line ends, and longer paragraphs at content-
defined places, so that an edit changes the pieces around it only. The digest of
each piece, with its occurrence number, goes into three cells. A cell holds how
many digests fell into it, their exclusive or, and that of a check value.

Sketches of two versions subtract cell by cell; what they have in common
vanishes, and cells with one digest left are peeled until the differing digests
are recovered. A comparison begins with sketches folded to about the cells that
the difference needs; if peeling gets stuck it is retried with twice the cells. Cell numbers are remainders by a
power of two, so folding needs the sketch alone. A sketch is made so large that
it can be peeled by itself; a comparison that needs more cells can thus take its
digests out and put them into that many.
"""

from __future__ import annotations

import base64
import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waybill.llm.arrow import text_slices
from waybill.llm.tasks import over_batches
from waybill.llm.tokens import hashes_at, mix, word_borders
from waybill.operators.ordering import before_range, in_order

HASHES = 3
LEAST_WIDTH = 4
# Cells per digest from which peeling usually succeeds.
ROOM = 1.3
# A piece ends after a word with a chance of one in this many, by the word's hash.
PIECE_WORDS = 32
# Among the first words of a text pieces are shorter, so that short texts have several.
FINE_WORDS, FINE_PIECE = 48, 3
RANGE_ROWS = 4096
MOST_RANGES = 100_000


def _cells(digest: int, width: int) -> tuple[int, int, int]:
    """One cell in each third of a sketch whose thirds have `width` cells, a power of two."""
    last = width - 1
    return digest & last, width + (digest >> 21 & last), 2 * width + (digest >> 42 & last)


def _check(digest: int) -> int:
    return digest * 0x9E3779B97F4A7C15 >> 24 & 0xFFFFFFFF


def _width_for(items: int) -> int:
    width = LEAST_WIDTH
    while HASHES * width < ROOM * items:
        width *= 2
    return width


@dataclass
class Sketch:
    """`width` cells in each third: `counts`, exclusive ors of digests and of
    checks per cell; and the number of digests."""

    width: int
    items: int
    counts: list[int]
    keys: list[int]
    checks: list[int]

    @classmethod
    def empty(cls, width: int) -> Sketch:
        return cls(width, 0, [0] * (HASHES * width), [0] * (HASHES * width), [0] * (HASHES * width))

    @classmethod
    def of(cls, digests: list[int], width: int) -> Sketch:
        sketch = cls.empty(width)
        counts, keys, checks = sketch.counts, sketch.keys, sketch.checks
        for digest in digests:
            check = _check(digest)
            for cell in _cells(digest, width):
                counts[cell] += 1
                keys[cell] ^= digest
                checks[cell] ^= check
        sketch.items = len(digests)
        return sketch

    def folded(self, width: int) -> Sketch:
        """The sketch of the same digests in fewer cells."""
        if width == self.width:
            return self
        result = Sketch.empty(width)
        result.items = self.items
        for third in range(HASHES):
            low, to = third * self.width, third * width
            for start in range(low, low + self.width, width):
                for at in range(width):
                    result.counts[to + at] += self.counts[start + at]
                    result.keys[to + at] ^= self.keys[start + at]
                    result.checks[to + at] ^= self.checks[start + at]
        return result

    def minus(self, other: Sketch) -> Sketch:
        return Sketch(self.width, self.items - other.items, [a - b for a, b in zip(self.counts, other.counts)],
                      [a ^ b for a, b in zip(self.keys, other.keys)],
                      [a ^ b for a, b in zip(self.checks, other.checks)])

    def peeled(self) -> tuple[list[int], list[int]] | None:
        """The digests with a positive and those with a negative count; None if peeling gets stuck."""
        counts, keys, checks, width = list(self.counts), list(self.keys), list(self.checks), self.width
        more: list[int] = []
        less: list[int] = []
        work = [cell for cell, count in enumerate(counts) if count == 1 or count == -1]
        while work:
            cell = work.pop()
            sign, digest = counts[cell], keys[cell]
            if sign != 1 and sign != -1:
                continue
            check = _check(digest)
            cells = _cells(digest, width)
            if checks[cell] != check or cell not in cells:
                continue
            (more if sign == 1 else less).append(digest)
            for at in cells:
                count = counts[at] = counts[at] - sign
                keys[at] ^= digest
                checks[at] ^= check
                if count == 1 or count == -1:
                    work.append(at)
        return None if any(counts) or any(keys) else (more, less)

    def guess(self) -> float:
        """About how many digests a difference of sketches holds, by its share of empty cells."""
        empty = sum(not (count or key) for count, key in zip(self.counts, self.keys))
        cells = HASHES * self.width
        return self.width * math.log(cells / empty) if empty else 2.0 * cells

    def to_text(self) -> str:
        head = np.array([self.items, len(self.counts)], "<u4").tobytes()
        return base64.b64encode(b"".join((
            head, np.array(self.counts, "<i4").tobytes(), np.array(self.keys, "<u8").tobytes(),
            np.array(self.checks, "<u4").tobytes()))).decode()

    @classmethod
    def from_text(cls, text: str) -> Sketch:
        raw = base64.b64decode(text)
        items, size = np.frombuffer(raw, "<u4", 2).tolist()
        return cls(size // HASHES, items, np.frombuffer(raw, "<i4", size, 8).tolist(),
                   np.frombuffer(raw, "<u8", size, 8 + 4 * size).tolist(),
                   np.frombuffer(raw, "<u4", size, 8 + 12 * size).tolist())


def build(digests: list[int]) -> Sketch:
    """The sketch of distinct digests, in the fewest cells from which it can be peeled again."""
    width = _width_for(len(digests))
    while True:
        sketch = Sketch.of(digests, width)
        if sketch.peeled() is not None:
            return sketch
        width *= 2


def difference(one: Sketch, other: Sketch) -> tuple[list[int], list[int]]:
    """The digests that only `one` and that only `other` holds.

    The first try has as many cells as the difference seems to need.
    """
    least, most = sorted((one.width, other.width))
    first = one.folded(least).minus(other.folded(least))
    width = min(_width_for(max(first.guess(), abs(first.items))), most)
    while width <= most:
        if width <= least:
            apart = first.folded(width)
        else:
            pair = [sketch.folded(width) if width <= sketch.width else Sketch.of(sketch.peeled()[0], width)
                    for sketch in (one, other)]
            apart = pair[0].minus(pair[1])
        found = apart.peeled()
        if found is not None:
            return found
        width *= 2
    ones, others = set(one.peeled()[0]), set(other.peeled()[0])
    return list(ones - others), list(others - ones)


def likeness(one: Sketch, other: Sketch) -> float:
    """Common pieces over all pieces; 1 for two empty texts."""
    differing = sum(map(len, difference(one, other)))
    either = (one.items + other.items + differing) // 2
    return 1.0 if either == 0 else (either - differing) / either


def digests_of(text: str) -> list[int]:
    """The digests of the pieces of a text, each with its occurrence number; they cover every byte."""
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    if not len(data):
        return []
    offsets = np.array([0, len(data)])
    starts, ends = word_borders(data, offsets)
    cuts = np.flatnonzero(data == 10) + 1
    if len(starts):
        hashes = hashes_at(data, starts, ends)
        chosen = hashes % np.uint64(PIECE_WORDS) == 0
        chosen[:FINE_WORDS] |= hashes[:FINE_WORDS] % np.uint64(FINE_PIECE) == 0
        cuts = np.concatenate([cuts, np.append(starts[1:], len(data))[chosen]])
    cuts = np.concatenate([[0], np.sort(cuts), [len(data)]])
    cuts = cuts[np.concatenate([[True], cuts[1:] != cuts[:-1]])]
    pieces = np.sort(hashes_at(data, cuts[:-1], cuts[1:]))
    firsts = np.flatnonzero(np.concatenate([[True], pieces[1:] != pieces[:-1]]))
    number = np.arange(len(pieces)) - np.repeat(firsts, np.diff(np.append(firsts, len(pieces))))
    return mix(pieces + number.astype(np.uint64) * np.uint64(0x632BE59BD9B4E019)).tolist()


def edited(text: str, following: str) -> str:
    """The last quarter of a text replaced by as much of the beginning of the next, or all of it."""
    changed = len(text) // 4
    return text[:len(text) - changed] + following[:changed]


# A place in the order of documents: whether the id is null, the id, a hash of the text.
Place = tuple[bool, int | None, int]


def _borders(keyed: DataFrame) -> list[Place]:
    """The first places of the ranges, ascending: of every so many rows the first. Rows of one id fall apart by their
    texts."""
    ordered = in_order(keyed.select(F.col("doc_id").isNull().alias("none"), "doc_id", "key"), "none", "doc_id", "key",
                       label="places")
    # As many rows as there are ranges of the sort, which is at most the shuffle partitions.
    before = F.broadcast(before_range(ordered, _before=F.count(F.lit(1))))
    size = max(RANGE_ROWS, -(-ordered.count() // MOST_RANGES))
    firsts = (ordered.join(before, "_range").filter((F.col("_before") + F.col("_position")) % size == 0)
              .select("none", "doc_id", "key").distinct().collect())
    return sorted((tuple(row) for row in firsts), key=lambda place: (place[0], place[1] or 0, place[2]))


def _ranges(borders: list[Place], ids: list[int | None], keys: list[int]) -> list[int]:
    """The range of each row: that of the last border at or before its place."""
    known = [place for place in borders if not place[0]]
    edges, texts = np.array([place[1] for place in known], np.int64), np.array([place[2] for place in known], np.int64)
    rest = np.array([place[2] for place in borders[len(known):]], np.int64)
    plain = np.array([0 if one is None else one for one in ids], np.int64)
    low, high = np.searchsorted(edges, plain, "left"), np.searchsorted(edges, plain, "right")
    found = low - 1
    for i in np.flatnonzero(high > low):  # rows with the id of a border
        found[i] = low[i] + np.searchsorted(texts[low[i]:high[i]], keys[i], "right") - 1
    for i, one in enumerate(ids):
        if one is None:
            found[i] = len(known) + np.searchsorted(rest, keys[i], "right") - 1
    return found.tolist()


def _deal(borders: list[Place]):
    """Rows with their range, the text packed. The first row of a range also goes to the one before it."""
    before = {place[1:]: (i - 1) % len(borders) for i, place in enumerate(borders)}

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1).compress
        for part in text_slices(batches):
            ids, keys = part.column("doc_id").to_pylist(), part.column("key").to_pylist()
            texts = [pack((text or "").encode()) for text in part.column("text").to_pylist()]
            rows = [(at, False, one, key, text) for at, one, key, text in zip(_ranges(borders, ids, keys), ids, keys, texts)]
            rows += [(before[one, key], True, one, key, text) for one, key, text in zip(ids, keys, texts)
                     if (one, key) in before]
            kinds = (pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(column), kind) for column, kind in zip(zip(*rows), kinds)],
                ["range", "halo", "doc_id", "key", "packed"])
    return deal


_RESULT = ("doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
           "near_edited double, near_next double")


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each row with the row after it; rows come by range, the first of the next range last."""
    unpack = zstandard.ZstdDecompressor().decompress
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
    names = [column.split(" ")[0] for column in _RESULT.split(", ")]
    waiting = None  # range, id, text, sketch of the row before
    for batch in batches:
        rows = []
        for at, halo, name, packed in zip(*(batch.column(i).to_pylist() for i in (0, 1, 2, 4))):
            if halo and (waiting is None or waiting[0] != at):
                continue  # rows that equal the first of the next range
            text = unpack(packed).decode()
            sketch = build(digests_of(text))
            if waiting is not None and waiting[0] == at:
                _, before, own, fingerprint = waiting
                changed = edited(own, text)
                other = build(digests_of(changed))
                rows.append((before, len(own), hashlib.sha256(changed.encode()).hexdigest(), fingerprint.to_text(),
                             other.to_text(), likeness(fingerprint, other), likeness(fingerprint, sketch)))
            waiting = None if halo else (at, name, text, sketch)
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(list(column), kind) for column, kind in zip(zip(*rows), kinds)],
                                             names)


def fingerprints(docs: DataFrame) -> DataFrame:
    """Per row: `doc_id`, `n_chars`, `edited_sha256`, `fingerprint`,
    `edited_fingerprint`, `near_edited`, `near_next`, against the next document
    by ascending id; the last one's next is the first.

    A null text counts as empty. Rows with the same id follow each other by a
    hash of their texts; rows without an id come after all others. A single row
    is its own next. An empty table gives an empty result. Rows are dealt to
    ranges of `RANGE_ROWS` rows or more by id and text, so neither a repeated nor a
    missing id makes a large one, and a task holds two texts at a time.
    """
    if docs.schema["doc_id"].dataType.simpleString() not in ("tinyint", "smallint", "int", "bigint"):
        raise TypeError("doc_id must be a whole number")
    keyed = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    keyed = keyed.withColumn("key", F.xxhash64("text"))
    borders = _borders(keyed)
    dealt = over_batches(keyed, _deal(borders), "range bigint, halo boolean, doc_id bigint, key bigint, packed binary")
    sorted_rows = dealt.repartition(max(len(borders), 1), "range").sortWithinPartitions(
        "range", "halo", F.col("doc_id").asc_nulls_last(), "key")
    return over_batches(sorted_rows, _compare, _RESULT)
