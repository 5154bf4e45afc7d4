"""Byte-pair encoding with a published vocabulary, and decoding.

The normal form, the split into words and the merges follow the tokenizer file
of the word-end kind: NFC, lower case, white space dropped, words by a pattern,
bytes as printable characters, and an end mark on the last symbol of a word.
Within a word all mergeable neighbours stand in a priority queue by merge rank
and place; symbols are a doubly linked list, and an entry whose symbols have
changed since is skipped. Decoding joins the vocabulary's strings.

Words recur, so each Python worker keeps the ids of recent ones, in two
generations of bounded size; only work is saved by that, never results.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession

from waybill.llm.arrow import text_slices
from waybill.llm.columns import with_text
from waybill.llm.tasks import over_batches, with_made

CACHED_WORDS = 120_000

# Fixed values of the format: contractions, letters, single digits, other marks.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\p{White_Space}\p{L}\p{N}]+"
# These count as white space in Python and not in the format.
_SEPARATORS = re.compile("[\x1c-\x1f]")
_SPACES = regex.compile(r"\p{White_Space}+")


def byte_characters() -> list[str]:
    """The printable character that stands for each byte in vocabulary strings."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(byte) if byte in printable else chr(next(spare)) for byte in range(256)]


class Encoder:
    """Encodes and decodes texts; made from the content of a tokenizer file."""

    def __init__(self, content: bytes, cached_words: int = CACHED_WORDS):
        described = json.loads(content)
        model = described["model"]
        vocabulary = model["vocab"]
        self.strings = {number: string for string, number in vocabulary.items()}
        self.special = {token["content"]: token["id"] for token in described["added_tokens"]}
        self.strings.update({number: string for string, number in self.special.items()})
        self._special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self._words = regex.compile(WORDS)
        characters = byte_characters()
        end = model["end_of_word_suffix"] or ""
        self._inner = [vocabulary.get(c) for c in characters]
        self._last = [vocabulary.get(c + end) for c in characters]
        pairs = [pair if isinstance(pair, list) else pair.split(" ") for pair in model["merges"]]
        self._ranks = {vocabulary[a] << 32 | vocabulary[b]: rank for rank, (a, b) in enumerate(pairs)}
        self._merged = [vocabulary[a + b] for a, b in pairs]
        self.limit = cached_words
        self._young: dict[str, tuple[int, ...]] = {}
        self._old: dict[str, tuple[int, ...]] = {}

    def merge(self, symbols: list[int]) -> list[int]:
        """The symbols of one word after all merges, by rank and then by place."""
        n, ranks, merged = len(symbols), self._ranks, self._merged
        queue = []
        for i in range(n - 1):
            rank = ranks.get(symbols[i] << 32 | symbols[i + 1])
            if rank is not None:
                queue.append(rank * n + i)
        if not queue:
            return symbols
        heapify(queue)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        while queue:
            rank, i = divmod(heappop(queue), n)
            j = after[i]
            if j >= n or symbols[i] < 0 or ranks.get(symbols[i] << 32 | symbols[j]) != rank:
                continue  # stale: one of the two was merged meanwhile
            symbols[i], symbols[j] = merged[rank], -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                right = ranks.get(symbols[i] << 32 | symbols[k])
                if right is not None:
                    heappush(queue, right * n + i)
            h = before[i]
            if h >= 0:
                left = ranks.get(symbols[h] << 32 | symbols[i])
                if left is not None:
                    heappush(queue, left * n + h)
        return [symbol for symbol in symbols if symbol >= 0]

    def _word(self, word: str) -> list[int]:
        raw = word.encode()
        symbols = [self._inner[byte] for byte in raw[:-1]]
        symbols.append(self._last[raw[-1]])
        return self.merge([symbol for symbol in symbols if symbol is not None])

    def _run(self, run: str) -> tuple[int, ...]:
        """The ids of a run without white space."""
        words = self._words.findall(run)
        if len(words) == 1:
            return tuple(self._word(words[0]))
        ids: list[int] = []
        for word in words:
            found = self._young.get(word)
            ids += found if found is not None else self._remember(word)
        return tuple(ids)

    def _remember(self, run: str) -> tuple[int, ...]:
        found = self._old.get(run)
        if found is None:
            found = self._run(run)
        if len(run) <= 64:
            if len(self._young) >= self.limit:
                self._old, self._young = self._young, {}
            self._young[run] = found
        return found

    def _plain(self, text: str, ids: list[int]) -> None:
        text = unicodedata.normalize("NFC", text)
        runs = text.replace("Σ", "σ").lower()  # lower case goes by single characters, also for a final sigma
        young, remember = self._young.get, self._remember
        for run in (_SPACES.split(runs) if _SEPARATORS.search(runs) else runs.split()):
            found = young(run)
            if found is None:
                found = remember(run)
                young = self._young.get
            ids += found

    def encode(self, text: str) -> list[int]:
        ids: list[int] = []
        if self._special is not None and "<" in text and self._special.search(text):
            for part in self._special.split(text):
                if part in self.special:
                    ids.append(self.special[part])
                else:
                    self._plain(part, ids)
        else:
            self._plain(text, ids)
        return ids

    def decode(self, ids: list[int]) -> str:
        return " ".join(map(self.strings.__getitem__, ids))


_encoders: dict[str, Encoder] = {}


def _encoder(content: bytes) -> Encoder:
    """One encoder for all tasks of a Python worker."""
    key = hashlib.sha256(content).hexdigest()
    if key not in _encoders:
        _encoders[key] = Encoder(content)
    return _encoders[key]


def read_vocabulary(spark: SparkSession, path: str) -> Broadcast:
    """The tokenizer file, whose size is fixed, for all executors."""
    with open(path, "rb") as file:
        return spark.sparkContext.broadcast(file.read())


def round_trip(docs: DataFrame, vocabulary: Broadcast, keep: tuple[str, ...] = ("doc_id",),
               with_ids: bool = True) -> DataFrame:
    """Encode every text and decode it again.

    Gives the columns `keep`, `ids` if asked for, `n_tokens`, `ids_sha256` of
    the ids in decimal and `decoded_sha256` of the decoded text; a new name that
    is taken gets underscores appended. A null text counts as empty and has no ids. Rows may
    repeat and come back as often; an empty table gives an empty result.
    """
    made = "ids array<int>, " * with_ids + "n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    schema = with_made(docs, keep, made)
    names = schema.names

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(vocabulary.value)
        decimal = {number: str(number) for number in encoder.strings}
        for part in text_slices(batches):
            counts, lists, digests, decoded = [], [], [], []
            for text in part.column("text").to_pylist():
                ids = encoder.encode(text or "")
                counts.append(len(ids))
                digests.append(hashlib.sha256(" ".join(map(decimal.__getitem__, ids)).encode()).hexdigest())
                decoded.append(hashlib.sha256(encoder.decode(ids).encode()).hexdigest())
                if with_ids:
                    lists.append(ids)
            columns = [part.column(name) for name in keep]
            columns += [pa.array(lists, pa.list_(pa.int32()))] if with_ids else []
            columns += [pa.array(counts, pa.int64()), pa.array(digests, pa.string()), pa.array(decoded, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names)

    return over_batches(with_text(docs, keep), encode, schema)
