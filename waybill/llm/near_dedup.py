"""Near duplicates by an inverted join over MinHash signature coordinates.

A document is the set of its distinct five-word shingles. Equal sets are one
node. A node has a signature of `COORDINATES` minima; it is posted under each
of the first `PREFIX` coordinate-value pairs. Nodes that share a posting list
are candidates: their collisions are counted over all coordinates, where the
lists beyond the prefix are never merged but skipped to through the signatures,
and pairs above `MATCHES` are confirmed on the full sets. A pair at similarity
0.75 shares no prefix list with a chance of 0.25**16 (2e-10) and stays below the
match threshold with a chance of about 1e-6; both fall steeply above 0.75.

No list emits all its pairs. Each ties its members to the one that agrees best
with the others, which is the original in a group of copies; what hangs together
by such ties is a family. Pairs within a family are compared where its sets lie
together, and only links that join what was apart are passed on. What is left
are pairs of different families in one list. Large lists are worked on in pairs
of blocks, so no task holds more than two blocks and no pair is left out.

A large family is first compared within its blocks, and in each also with the
member that has the most ties. Mostly that links all of it. Where it does not,
what hangs together by then is a core, and members of the largest core are
compared with those of other cores only: their blocks are not paired with each
other, so what moves grows with the family and with what is apart in it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from waybill.llm.arrow import binary, text_slices, utf8, whole_groups
from waybill.llm.components import connected
from waybill.llm.columns import free_name, quoted
from waybill.llm.scratch import Scratch
from waybill.llm.tasks import over_batches
from waybill.llm.tokens import mix, shingle_set, word_hashes

COORDINATES = 128
PREFIX = 16
MATCHES = 72
SIMILARITY_PERCENT = 75
BLOCK = 2048
BLOCK_SHINGLES = 1 << 20
# Keys of candidate texts are broadcast up to this number, some 100 bytes each once hashed; beyond it texts are shuffled.
BROADCAST_KEYS = 1_000_000

_random = np.random.Generator(np.random.PCG64(75))
_FACTOR = _random.integers(1, 1 << 63, COORDINATES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFT = _random.integers(0, 1 << 63, COORDINATES, dtype=np.uint64)

_SIGNED = "n_shingles bigint, node binary, tokens array<bigint>, signature binary"


def signature(shingles: np.ndarray) -> np.ndarray:
    """The least value of every hash function over a set of shingles."""
    least = np.full(COORDINATES, np.iinfo(np.uint64).max, np.uint64)
    for low in range(0, len(shingles), 2048):
        part = shingles[None, low:low + 2048] * _FACTOR[:, None]
        part += _SHIFT[:, None]
        np.minimum(least, part.min(axis=1), out=least)
    return least


def _sign(names: list[str]):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = mix(np.arange(1, PREFIX + 1, dtype=np.uint64))
        for part in text_slices(batches):
            words, borders = word_hashes(*utf8(part.column("text")))
            sizes, nodes, tokens, signatures = [], [], [], []
            for low, high in zip(borders[:-1], borders[1:]):
                shingles = shingle_set(words[low:high])
                sizes.append(len(shingles))
                nodes.append(_digest(shingles))
                if len(shingles):
                    least = signature(shingles)
                    tokens.append(mix(least[:PREFIX] ^ places).view(np.int64))
                    signatures.append(mix(least).astype(np.uint8).tobytes())
                else:
                    tokens.append(np.zeros(0, np.int64))
                    signatures.append(b"")
            ends = np.cumsum([0, *map(len, tokens)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(ends, pa.array(np.concatenate(tokens)))
            yield pa.RecordBatch.from_arrays(
                [*(part.column(name) for name in names), pa.array(sizes, pa.int64()), binary(nodes), lists,
                 binary(signatures)],
                [*names, "n_shingles", "node", "tokens", "signature"])
    return sign


def _digest(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def _shingle_arrays(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sets of texts; a text of another node under the same key is passed over."""
    for part in text_slices(batches):
        words, borders = word_hashes(*utf8(part.column("text")))
        sets = [shingle_set(words[low:high]) for low, high in zip(borders[:-1], borders[1:])]
        found = [(node, own) for node, own in zip(part.column("node").to_pylist(), sets) if _digest(own) == node]
        ends = np.cumsum([0, *(len(own) for _, own in found)]).astype(np.int32)
        values = np.concatenate([np.zeros(0, np.uint64), *(own for _, own in found)]).view(np.int64)
        yield pa.RecordBatch.from_arrays(
            [binary([node for node, _ in found]), pa.ListArray.from_arrays(ends, pa.array(values))], ["node", "shingles"])


def _may_be_alike(size: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sets whose sizes alone do not rule the similarity out."""
    return 100 * np.minimum(size, sizes) >= SIMILARITY_PERCENT * np.maximum(size, sizes)


def _members(table: pa.Table, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    part = table.slice(low, high - low)
    signatures = np.frombuffer(b"".join(part.column("signature").to_pylist()), np.uint8)
    return signatures.reshape(high - low, COORDINATES), part.column("n_shingles").to_numpy()


_PAIRS = "a binary, b binary"


def _pairs(left: list[bytes], right: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([binary(left), binary(right)], ["a", "b"])


def _consensus(signatures: np.ndarray) -> np.ndarray:
    """The commonest value of every coordinate."""
    return np.array([np.bincount(column, minlength=256).argmax() for column in signatures.T], np.uint8)


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each list, pairs of its most typical member and those that collide with it often enough."""
    for table, borders in whole_groups(batches, ["token", "block"]):
        left, right = [], []
        for low, high in zip(borders[:-1], borders[1:]):
            if high - low < 2:
                continue
            signatures, sizes = _members(table, low, high)
            hub = int((signatures == _consensus(signatures)).sum(axis=1).argmax()) if high - low > 2 else 0
            matches = (signatures == signatures[hub]).sum(axis=1) >= MATCHES
            matches &= _may_be_alike(sizes[hub], sizes)
            matches[hub] = False
            nodes = table.column("node").slice(low, high - low).to_pylist()
            chosen = np.flatnonzero(matches)
            left += [min(nodes[hub], nodes[i]) for i in chosen]
            right += [max(nodes[hub], nodes[i]) for i in chosen]
        if left:
            yield _pairs(left, right)


def _similar(own: np.ndarray, flat: np.ndarray, borders: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Those of `others` whose sets are similar enough to the set `own`; set i is flat[borders[i]:borders[i + 1]]."""
    sizes = borders[others + 1] - borders[others]
    ends = np.cumsum(sizes)
    places = np.arange(ends[-1]) + np.repeat(borders[others] - (ends - sizes), sizes)
    values = flat[places]
    found = own[np.minimum(np.searchsorted(own, values), len(own) - 1)] == values
    common = np.add.reduceat(found, ends - sizes, dtype=np.int64)
    return others[(100 + SIMILARITY_PERCENT) * common >= SIMILARITY_PERCENT * (len(own) + sizes)]


def _within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each family or pair of its blocks, links that connect all that is linked there."""
    for table, borders in whole_groups(batches, ["family", "low", "high"], rows=2000):
        left, right = [], []
        for low, high in zip(borders[:-1], borders[1:]):
            signatures, sizes = _members(table, low, high)
            part = table.slice(low, high - low)
            nodes, block = part.column("node").to_pylist(), part.column("block").to_numpy()
            lists = part.column("shingles").combine_chunks()
            cuts = lists.offsets.to_numpy().astype(np.int64)
            flat = lists.flatten().to_numpy().view(np.uint64)
            cuts = cuts - cuts[0]
            first, last = part.column("low")[0].as_py(), part.column("high")[0].as_py()
            # What is linked already has one root.
            root = np.unique(part.column("core").to_numpy(), return_inverse=True)[1]
            typical = int((signatures == _consensus(signatures)).sum(axis=1).argmax())
            order = [typical, *range(typical), *range(typical + 1, high - low)]
            done = np.zeros(high - low, bool)
            for i in order:
                done[i] = True
                others = ~done & (root != root[i]) & _may_be_alike(sizes[i], sizes)
                if first != last:
                    others &= block != block[i]
                others = np.flatnonzero(others)
                if len(others):
                    others = others[(signatures[others] == signatures[i]).sum(axis=1) >= MATCHES]
                if not len(others):
                    continue
                for j in _similar(flat[cuts[i]:cuts[i + 1]], flat, cuts, others):
                    if root[j] != root[i]:
                        root[root == root[j]] = root[i]
                        left.append(nodes[i])
                        right.append(nodes[j])
        if left:
            yield _pairs(left, right)


def _crossing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each list or pair of blocks, the pairs that collide often enough and
    lie in different families."""
    for table, borders in whole_groups(batches, ["token", "low", "high"]):
        left, right = [], []
        for low, high in zip(borders[:-1], borders[1:]):
            signatures, sizes = _members(table, low, high)
            part = table.slice(low, high - low)
            nodes, block = part.column("node").to_pylist(), part.column("block").to_numpy()
            family = part.column("family").to_numpy()
            same = part.column("low")[0].as_py() == part.column("high")[0].as_py()
            for i in range(high - low):
                others = (family != family[i]) & _may_be_alike(sizes[i], sizes)
                others[:i + 1] = False
                if not same:
                    others &= block != block[i]
                others = np.flatnonzero(others)
                if len(others):
                    others = others[(signatures[others] == signatures[i]).sum(axis=1) >= MATCHES]
                    left += [min(nodes[i], nodes[j]) for j in others]
                    right += [max(nodes[i], nodes[j]) for j in others]
        if left:
            yield _pairs(left, right)


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs whose full sets are similar enough. A crowded node is split by adaptive skew handling."""
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("_left"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("_right"))
    common = F.size(F.array_intersect("_left", "_right")).cast("bigint")
    both = (F.size("_left") + F.size("_right")).cast("bigint")
    # 100 * common >= percent * (both - common), with the intersection taken once.
    alike = (100 + SIMILARITY_PERCENT) * common >= SIMILARITY_PERCENT * both
    return pairs.join(left, "a").join(right, "b").filter(alike).select("a", "b")


def _in_block_pairs(members: DataFrame, *group: str) -> DataFrame:
    """Rows with `block` and `blocks`, once for each pair `low`, `high` of blocks that the row's block is in."""
    other = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1))
    paired = (members.withColumn("_other", other).withColumn("low", F.least("block", "_other"))
              .withColumn("high", F.greatest("block", "_other")).drop("_other", "blocks"))
    keys = (*group, "low", "high")
    return paired.repartition(*keys).sortWithinPartitions(*keys)


def _inner_links(member: DataFrame, degree: DataFrame, scratch: Scratch) -> DataFrame:
    """Links that connect what is linked within each family. `member`: `family`, `blocks`, `block`, `node` with its
    set and signature; `degree`: the number of ties of each node, as `ties`."""
    columns = ["family", "block", "node", "n_shingles", "signature", "shingles"]
    alone = F.xxhash64("node").alias("core")
    crowded = member.filter("blocks > 1")
    large = not crowded.select("family").isEmpty()
    first = member.select(*columns, alone)
    if large:
        most = (crowded.select("family", "node").join(degree, "node").groupBy("family")
                .agg(F.max_by("node", F.struct("ties", "node")).alias("_hub")))
        hubs = (crowded.join(most, "family").filter(F.col("node") == F.col("_hub"))
                .withColumn("_own", F.col("block"))
                .withColumn("block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)))
                .filter("block != _own").select(*columns, alone))
        first = first.unionByName(hubs)
    keys = ("family", "low", "high")
    within = (first.withColumn("low", F.col("block")).withColumn("high", F.col("block"))
              .repartition(*keys).sortWithinPartitions(*keys))
    links = scratch.store(over_batches(within, _within, _PAIRS), "links")
    if not large:
        return links
    ours = links.join(crowded.select(F.col("node").alias("a")), "a", "left_semi")
    labels = connected(ours, scratch).select("node", F.xxhash64("label").alias("_core"))
    cored = (crowded.join(labels, "node", "left").withColumn("core", F.coalesce("_core", F.xxhash64("node"))).drop("_core"))
    cores = cored.groupBy("family", "core").agg(F.count(F.lit(1)).alias("_members"))
    largest = (cores.groupBy("family").agg(F.count(F.lit(1)).alias("_cores"), F.sum("_members").alias("_all"),
                                           F.max(F.struct("_members", "core")).alias("_most"))
               .filter("_cores > 1"))
    # Members of the largest core keep their blocks; the others' blocks are numbered after these.
    apart = F.col("core") != F.col("_most.core")
    others = F.ceil((F.col("_all") - F.col("_most._members")) * F.col("blocks") / F.col("_all")).cast("bigint")
    divided = (cored.join(largest, "family").withColumn("_others", others).withColumn("block", F.when(
        apart, F.col("blocks") + F.pmod(F.xxhash64("node"), F.col("_others"))).otherwise(F.col("block"))))
    first_other = F.when(apart, F.lit(0)).otherwise(F.col("blocks")).cast("bigint")
    paired = (divided.withColumn("_other", F.explode(F.sequence(first_other, F.col("blocks") + F.col("_others") - 1)))
              .select(*columns, "core", F.least("block", "_other").alias("low"), F.greatest("block", "_other").alias("high"))
              .repartition(*keys).sortWithinPartitions(*keys))
    return links.unionAll(scratch.store(over_batches(paired, _within, _PAIRS), "links"))


def _sets_of(docs: DataFrame, wanted: DataFrame, scratch: Scratch) -> DataFrame:
    """The full shingle sets of the nodes `wanted`, each from one of its texts."""
    keyed = docs.filter("text IS NOT NULL").select("text", F.xxhash64("text").alias("_key"))
    few = wanted.count() <= BROADCAST_KEYS
    texts = keyed.join(F.broadcast(wanted) if few else wanted, "_key").select("node", "text")
    sets = over_batches(texts, _shingle_arrays, "node binary, shingles array<bigint>")
    return scratch.store(sets.groupBy("node").agg(F.first("shingles").alias("shingles")), "sets")


def near_duplicates(docs: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """Per row of `docs` (`doc_id`, `text`): `doc_id`, `n_shingles`, `node` (a
    digest of the shingle set), `class` (the least node of the component),
    `component_id` (the component's smallest doc_id) and `kept`.

    Documents without words, or with a null text, are linked with nothing.
    Repeated rows and repeated ids are rows of their own; equal texts are always
    in one component. A null doc_id is never the smallest; a component of such
    rows alone has a null id, and its rows are kept. An empty table gives an
    empty result; other columns are not looked at.
    """
    spark = docs.sparkSession
    scratch = scratch or Scratch(spark, "near-dedup")
    named = docs.select("doc_id", "text", F.xxhash64("text").alias("text_key"))
    id_type = docs.schema["doc_id"].dataType.simpleString()
    signed = scratch.store(
        over_batches(named, _sign(["doc_id", "text_key"]), f"doc_id {id_type}, text_key bigint, {_SIGNED}"), "signed")
    filled = signed.filter("n_shingles > 0")
    nodes = scratch.store(
        filled.groupBy("node").agg(*[F.first(name).alias(name)
                                     for name in ("n_shingles", "text_key", "tokens", "signature")]), "nodes")
    posted = nodes.select("node", F.explode("tokens").alias("token"))
    lists = posted.groupBy("token").agg(F.count(F.lit(1)).alias("members")).filter("members > 1")
    blocks = F.ceil(F.col("members") / BLOCK).cast("bigint")
    described = nodes.select("node", "n_shingles", "signature")
    postings = scratch.store(
        posted.join(lists, "token").join(described, "node")
        .select("token", "node", "n_shingles", "signature", blocks.alias("blocks"),
                # Another division in every list, so that its parts are tied together through the other lists.
                F.pmod(F.xxhash64("node", "token"), blocks).alias("block")), "postings")

    listed = postings.repartition("token", "block").sortWithinPartitions("token", "block")
    ties = scratch.store(over_batches(listed, _stars, _PAIRS).distinct(), "ties")
    families = connected(ties, scratch).select("node", F.xxhash64("label").alias("family"))
    sets = _sets_of(docs, _keys(ties, nodes), scratch)
    extent = families.join(nodes.select("node", "n_shingles"), "node").groupBy("family").agg(
        F.ceil(F.greatest(F.count(F.lit(1)) / BLOCK, F.sum("n_shingles") / BLOCK_SHINGLES)).cast("bigint")
        .alias("blocks"))
    member = (families.join(extent, "family").join(described, "node").join(sets, "node")
              .withColumn("block", F.pmod(F.xxhash64("node"), "blocks")))
    ends = ties.select(F.explode(F.array("a", "b")).alias("node"))
    inner = _inner_links(member, ends.groupBy("node").agg(F.count(F.lit(1)).alias("ties")), scratch)

    # A node without a tie is a family of its own.
    placed = postings.join(families, "node", "left").withColumn("family", F.coalesce("family", F.xxhash64("node")))
    mixed = (placed.groupBy("token").agg(F.min("family").alias("_least"), F.max("family").alias("_most"))
             .filter("_least != _most").select("token"))
    crossing = over_batches(_in_block_pairs(placed.join(mixed, "token"), "token"), _crossing, _PAIRS)
    pairs = scratch.store(crossing.distinct(), "pairs")
    outer_sets = _sets_of(docs, _keys(pairs, nodes), scratch)
    outer = scratch.store(_confirmed(pairs, outer_sets), "links")
    final = scratch.store(connected(inner.unionAll(outer), scratch), "labels")
    scratch.drop(nodes, postings, ties, sets, inner, pairs, outer_sets, outer)

    rows = (signed.select("doc_id", "text_key", "n_shingles", "node").join(final, "node", "left")
            .withColumn("class", F.coalesce("label", "node")))
    smallest = rows.filter("n_shingles > 0").groupBy("class").agg(F.min("doc_id").alias("_smallest"))
    alone = F.col("n_shingles") == 0
    component = F.when(alone, F.col("doc_id")).otherwise(F.col("_smallest"))
    return (rows.join(smallest, "class", "left")
            .select("doc_id", "n_shingles", "node", "text_key", "class", component.alias("component_id"),
                    F.col("doc_id").eqNullSafe(component).alias("kept")))


def _keys(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The text keys of all nodes that stand in a pair."""
    seen = pairs.select(F.col("a").alias("node")).unionAll(pairs.select(F.col("b").alias("node"))).distinct()
    return nodes.join(seen, "node").select("node", F.col("text_key").alias("_key"))


def survivors(docs: DataFrame) -> DataFrame:
    """One document of each component, with the columns of `docs`: the row with
    the smallest id, a single one if rows repeat. Rows without words all stay,
    repeated ones included."""
    found = near_duplicates(docs).filter("kept").select("doc_id", "text_key", "n_shingles", "class")
    name, key, hash_, once, place = (free_name(docs, one) for one in ("_id", "_key", "_text_key", "_once", "_place"))
    one = found.filter("n_shingles > 0").groupBy("doc_id", "class").agg(F.min("text_key").alias("text_key"))
    alone = found.filter("n_shingles = 0").select("doc_id", "text_key", F.lit(False).alias(once)).distinct()
    chosen = (one.select("doc_id", "text_key", F.lit(True).alias(once)).unionAll(alone)
              .withColumnsRenamed({"doc_id": name, "text_key": key}))
    same = F.col("doc_id").eqNullSafe(F.col(name)) & (F.col(hash_) == F.col(key))
    order = Window.partitionBy(name, key).orderBy(key)
    return (docs.withColumn(hash_, F.xxhash64("text")).join(chosen, same)
            .withColumn(place, F.row_number().over(order)).filter(~F.col(once) | (F.col(place) == 1))
            .select(*[quoted(column) for column in docs.columns]))
