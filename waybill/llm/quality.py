"""Quality of texts by a byte-level convolutional network.

Learned filters slide over the bytes of the whole document. Their activations
are summarised (mean and spread) over overlapping chunks of 128 bytes; a hidden
layer looks at each chunk, the strongest response over all chunks counts, and
these maxima are combined into one probability. Text of any length is covered
from the first byte to the last.

The network is trained with Adam on a bounded sample of labelled rows, of at
most `SAMPLE_ROWS` rows and `SAMPLE_BYTES` bytes of text, taken by a hash of the
id. If their texts have more bytes than that, the longest are levelled to one
size, each to pieces from its begin to its end, so that no row is shut out by
long texts. All documents are scored, whole. Nothing but the bytes of the text
enters a score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waybill.llm.arrow import text_slices, utf8
from waybill.llm.columns import with_text
from waybill.llm.tasks import over_batches, with_made

SAMPLE_ROWS = 3000
SAMPLE_BYTES = 24 << 20
# A text of the sample is never cut to fewer bytes, and cut ones are made up of pieces of whole chunks.
ROW_BYTES = SAMPLE_BYTES // SAMPLE_ROWS
PIECE = 1024
WIDTH, STRIDE = 8, 4  # bytes; a window is two strides
FILTERS, HIDDEN = 24, 24
HALF = 16  # windows in half a chunk
HALF_BYTES = HALF * STRIDE
# A byte is an echo if it and the next three stood here at most so many bytes before.
ECHO = 28
# Small samples are gone through more often, so that all have as many steps.
STEPS, BATCH, RATE = 504, 48, 4e-3
SEED = 11
SLICE = 1 << 19


def byte_features() -> np.ndarray:
    """What the filters see of a byte: its kinds, and fixed random numbers to tell bytes apart. Byte 0 is padding."""
    byte = np.arange(256)
    upper, lower = (byte >= 65) & (byte <= 90), (byte >= 97) & (byte <= 122)
    kinds = [upper, lower, (byte >= 48) & (byte <= 57), (byte == 32) | (byte == 9), byte == 10, byte >= 128,
             (byte > 32) & (byte < 127) & ~upper & ~lower & ~((byte >= 48) & (byte <= 57)),
             np.isin(byte | 32, list(b"aeiou")) & (upper | lower)]
    table = np.column_stack([np.array(kinds, np.float32).T,
                             np.random.default_rng(SEED).normal(0, 0.5, (256, 6)).astype(np.float32)])
    table[0] = 0
    return table.astype(np.float32)


FEATURES = byte_features()


def padded(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts one after the other, each after `STRIDE` zeros and filled up
    with zeros to whole halves of chunks, of which each text has at least two,
    and the borders of the halves. No window reaches into a second text, and no
    byte can be an echo of one."""
    sizes = np.diff(offsets)
    halves = np.maximum(-(-(sizes + ECHO) // HALF_BYTES), 2)
    borders = np.concatenate([[0], np.cumsum(halves)])
    out = np.zeros(borders[-1] * HALF_BYTES + STRIDE, np.uint8)
    out[np.arange(len(data)) + np.repeat(borders[:-1] * HALF_BYTES + STRIDE - offsets[:-1], sizes)] = data
    return out, borders


def channels(out: np.ndarray) -> np.ndarray:
    """The features of every byte, and whether it is an echo; padding keeps texts out of each other's reach."""
    seen = np.empty((len(out), FEATURES.shape[1] + 1), np.float32)
    seen[:, :-1] = FEATURES[out]
    four = np.zeros(len(out), np.uint32)
    for i in range(4):
        four[:len(out) - i] |= out[i:].astype(np.uint32) << np.uint32(8 * i)
    echo = np.zeros(len(out), bool)
    for back in range(2, ECHO):
        echo[back:] |= four[back:] == four[:-back]
    echo &= out > 0
    seen[:, -1] = echo
    return seen


@dataclass
class Network:
    """`parameters`: weights and biases of filters, hidden layer and output."""

    parameters: list[np.ndarray]

    @classmethod
    def fresh(cls) -> Network:
        random = np.random.default_rng(SEED)
        inputs = WIDTH * (FEATURES.shape[1] + 1)
        shapes = [(inputs, FILTERS), (FILTERS,), (2 * FILTERS, HIDDEN), (HIDDEN,), (HIDDEN,), (1,)]
        return cls([(random.normal(0, np.sqrt(2 / shape[0]), shape) if len(shape) > 1 else
                     random.normal(0, 0.3, shape) if i == 4 else np.zeros(shape)).astype(np.float32)
                    for i, shape in enumerate(shapes)])

    def _forward(self, out: np.ndarray, borders: np.ndarray, seen: np.ndarray | None = None) -> dict:
        filters, bias, hidden, hidden_bias, last, last_bias = self.parameters
        # A window is a block of `STRIDE` bytes and the next one, so each block is multiplied once by both halves.
        blocks = (channels(out) if seen is None else seen).reshape(-1, filters.shape[0] // 2)
        both = blocks @ np.concatenate(np.split(filters, 2), axis=1)
        active = both[:-1, :FILTERS] + both[1:, FILTERS:]
        active += bias
        np.maximum(active, 0, out=active)
        grouped = active.reshape(-1, HALF, FILTERS)
        sums, squares = grouped.sum(axis=1), np.einsum("hwf,hwf->hf", grouped, grouped)
        # A chunk is a half and the next one of the same text.
        firsts = np.delete(np.arange(borders[-1]), borders[1:] - 1)
        chunk_borders = borders - np.arange(len(borders))
        mean = (sums[firsts] + sums[firsts + 1]) / (2 * HALF)
        spread = np.sqrt(np.maximum((squares[firsts] + squares[firsts + 1]) / (2 * HALF) - mean * mean, 0) + 1e-4)
        summary = np.concatenate([mean, spread], axis=1)
        response = np.maximum(summary @ hidden + hidden_bias, 0)
        strongest = np.maximum.reduceat(response, chunk_borders[:-1], axis=0)
        return {"blocks": blocks, "active": active, "firsts": firsts, "chunks": chunk_borders, "mean": mean,
                "spread": spread, "summary": summary, "response": response, "strongest": strongest,
                "logit": strongest @ last + last_bias[0]}

    def _long(self, data: np.ndarray, part: int) -> np.ndarray:
        """The logit of one text, in runs of halves of which only the strongest responses are held."""
        size = max(-(-(len(data) + ECHO) // HALF_BYTES), 2)
        out = np.zeros(size * HALF_BYTES + STRIDE, np.uint8)
        out[STRIDE:STRIDE + len(data)] = data
        strongest = np.zeros(HIDDEN, np.float32)
        for low in range(0, size - 1, part):
            high = min(low + part + 1, size)
            # What may be an echo needs the bytes before, and a window and a byte's next three what follows.
            begin, end = max(low * HALF_BYTES - ECHO, 0), high * HALF_BYTES + STRIDE
            near = out[begin:end + 3]
            seen = channels(near)[low * HALF_BYTES - begin:end - begin]
            strongest = np.maximum(strongest, self._forward(near, np.array([0, high - low]), seen)["strongest"][0])
        return strongest[None, :] @ self.parameters[4] + self.parameters[5][0]

    def probabilities(self, data: np.ndarray, offsets: np.ndarray, part: int = SLICE) -> np.ndarray:
        """Of a text longer than `part` bytes about so many are looked at at a time."""
        if len(offsets) == 2 and len(data) > part:
            logit = self._long(data, max(part // HALF_BYTES, 1)).astype(np.float64)
        else:
            logit = self._forward(*padded(data, offsets))["logit"].astype(np.float64)
        return 1 / (1 + np.exp(-np.clip(logit, -40, 40)))

    def gradients(self, data: np.ndarray, offsets: np.ndarray, labels: np.ndarray) -> list[np.ndarray]:
        """Of the mean log loss over the texts."""
        out, borders = padded(data, offsets)
        seen = self._forward(out, borders)
        filters, bias, hidden, hidden_bias, last, last_bias = self.parameters
        texts = len(labels)
        error = ((1 / (1 + np.exp(-seen["logit"])) - labels) / texts).astype(np.float32)
        # Only the strongest chunk of each text and unit passes the error on.
        back = np.zeros_like(seen["response"])
        for text in range(texts):
            low, high = seen["chunks"][text:text + 2]
            at = low + seen["response"][low:high].argmax(axis=0)
            back[at, np.arange(HIDDEN)] = error[text] * last
        back *= seen["response"] > 0
        down = back @ hidden.T
        mean_back, spread_back = down[:, :FILTERS], down[:, FILTERS:] / seen["spread"]
        # d spread / d activation = (activation - mean) / (windows * spread)
        constant = (mean_back - spread_back * seen["mean"]) / (2 * HALF)
        factor = spread_back / (2 * HALF)
        halves_constant = np.zeros((borders[-1], FILTERS), np.float32)
        halves_factor = np.zeros((borders[-1], FILTERS), np.float32)
        for shift in (0, 1):  # a half is in at most one chunk as first and in one as second
            halves_constant[seen["firsts"] + shift] += constant
            halves_factor[seen["firsts"] + shift] += factor
        active = seen["active"].reshape(-1, HALF, FILTERS)
        below = (halves_constant[:, None, :] + halves_factor[:, None, :] * active) * (active > 0)
        below = below.reshape(-1, FILTERS)
        blocks = seen["blocks"]
        return [np.concatenate([blocks[:-1].T @ below, blocks[1:].T @ below]), below.sum(axis=0),
                seen["summary"].T @ back, back.sum(axis=0), error @ seen["strongest"], np.array([error.sum()], np.float32)]


def train(texts: list[bytes], labels: np.ndarray, epochs: int | None = None) -> Network:
    """The network for labels 0 and 1; without any text it says 1/2 to all. Goes
    through the texts as often as `STEPS` steps ask for, or `epochs` times."""
    network = Network.fresh()
    if not texts:
        network.parameters[4][:] = 0
        return network
    if epochs is None:
        epochs = max(round(STEPS / -(-len(texts) // BATCH)), 1)
    share = float(np.clip(labels.mean(), 0.02, 0.98))
    network.parameters[5][:] = np.log(share / (1 - share))
    random = np.random.default_rng(SEED + 1)
    first = [np.zeros_like(p) for p in network.parameters]
    second = [np.zeros_like(p) for p in network.parameters]
    steps = epochs * -(-len(texts) // BATCH)
    step = 0
    for _ in range(epochs):
        order = random.permutation(len(texts))
        for low in range(0, len(texts), BATCH):
            chosen = order[low:low + BATCH]
            data = np.frombuffer(b"".join(texts[i] for i in chosen), np.uint8)
            offsets = np.concatenate([[0], np.cumsum([len(texts[i]) for i in chosen])])
            step += 1
            rate = RATE * (1 - step / (steps + 1))
            for i, slope in enumerate(network.gradients(data, offsets, labels[chosen])):
                first[i] += 0.1 * (slope - first[i])
                second[i] += 0.001 * (slope * slope - second[i])
                network.parameters[i] -= (rate * first[i] / (1 - 0.9 ** step)
                                          / (np.sqrt(second[i] / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)
    return network


def level(sizes: list[int], size: int) -> int:
    """The bytes to which longer texts are cut so that all together have at most `size`, but at least `ROW_BYTES`."""
    left, most = size, 0
    for done, one in enumerate(sorted(sizes)):
        most = left // (len(sizes) - done)
        if one > most:
            return max(most, ROW_BYTES)
        left -= one
    return max(sizes, default=0)


def _pieces(most: int) -> Column:
    """The bytes of `text`, or evenly spread pieces of them, `most` bytes at most."""
    raw, width = F.col("text").cast("binary"), min(PIECE, most)
    number = max(most // max(width, 1), 1)
    step = (F.octet_length("text") - width) / max(number - 1, 1)
    spread = F.transform(F.sequence(F.lit(0), F.lit(number - 1)),
                         lambda i: F.substring(raw, (F.floor(i * step) + 1).cast("int"), F.lit(width)))
    return F.when(F.octet_length("text") <= most, F.array(raw)).otherwise(spread)


def learn(docs: DataFrame, labels: DataFrame, may_learn: Column, rows: int = SAMPLE_ROWS,
          size: int = SAMPLE_BYTES) -> Network:
    """Train on a sample of the rows of `labels` (`doc_id`, `quality`) for which
    `may_learn` holds and whose document has a text. Null labels are left out;
    of repeated ids every row counts."""
    picked = (labels.filter(may_learn & F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1))
              .select("doc_id", F.col("quality").cast("double").alias("quality"))
              .orderBy(F.xxhash64(F.col("doc_id").cast("string"), F.lit(SEED)), "doc_id", "quality").limit(rows))
    keys = (F.xxhash64(F.col("doc_id").cast("string"), F.lit(SEED)), "doc_id", "quality", "_key")
    joined = (docs.filter("text IS NOT NULL").select("doc_id", "text", F.xxhash64("text").alias("_key"),
                                                     F.octet_length("text").alias("_size"))
              .join(F.broadcast(picked), "doc_id"))
    # At most `rows` rows; sizes first, so that long texts are cut where they are read.
    most = level([row["_size"] for row in joined.drop("text").orderBy(*keys).limit(rows).collect()], size)
    chosen = (joined.withColumn("_pieces", _pieces(most)).withColumn("_size", F.least("_size", F.lit(most)))
              .drop("text").orderBy(*keys).limit(rows)
              .withColumn("_sum", F.sum("_size").over(Window.orderBy(*keys))).filter(F.col("_sum") <= size)
              .select("_pieces", "quality").collect())
    return train([b"".join(row["_pieces"]) for row in chosen], np.array([row["quality"] for row in chosen], np.float32))


def rate(docs: DataFrame, network: Network, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns `keep` and `score` (with underscores appended if that name is
    taken), the probability of label 1.

    A null text counts as empty; empty texts get the score of padding alone.
    Equal texts get equal scores. Rows may repeat; an empty table gives an empty
    result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(network)
    schema = with_made(docs, keep, "score double")
    names = schema.names

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, limit=SLICE):
            scores = shared.value.probabilities(*utf8(part.column("text")))
            yield pa.RecordBatch.from_arrays([*(part.column(name) for name in keep), pa.array(scores, pa.float64())],
                                             names)

    return over_batches(with_text(docs, keep), score, schema)
