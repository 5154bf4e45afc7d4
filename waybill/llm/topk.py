"""Exact top-k search by inner product with M-trees and best-first search.

Vectors of integers are lifted by one coordinate so that all have the same
length; the nearest vector to a query by Euclidean distance is then the one
with the largest inner product, and distances obey the triangle inequality.
Rows are dealt to trees of about `TREE_ROWS` and queries to blocks of about
`BLOCK_QUERIES`; a task builds one tree and searches it for one block, and the
best of all trees are merged per query.

A tree consists of pages. Every entry stores its distance to the page's routing
object and, above the leaves, a covering radius. A search takes pages by their
least possible distance; an entry whose stored distances already rule it out is
passed over without computing its distance.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from waybill.llm.tasks import ship

TREE_ROWS = 8192
BLOCK_QUERIES = 8192
PAGE = 96
# Distances are rounded; bounds give way by this part of the common length.
SLACK = 1e-6


@dataclass
class Page:
    """Entries below one routing object: rows of the tree's vectors in a leaf,
    routing rows and pages otherwise."""

    rows: np.ndarray
    to_parent: np.ndarray
    radii: np.ndarray
    pages: list[Page] | None


class MTree:
    """Lifted vectors in metric pages, loaded in bulk."""

    def __init__(self, vectors: np.ndarray, length: float, page: int = PAGE):
        self.vectors, self.length2, self.page = vectors, length, page
        rest = np.sqrt(np.maximum(length - (vectors * vectors).sum(axis=1), 0))
        self._lifted = np.column_stack([vectors, rest])
        leaves = self._split(np.arange(len(vectors)))
        level = [self._leaf(rows) for rows in leaves]
        while len(level) > 1:
            level = [self._above(level[i:i + page]) for i in range(0, len(level), page)]
        self.routing, self.radius, self.root = level[0]

    def _distances(self, row: int, rows: np.ndarray) -> np.ndarray:
        return np.sqrt(((self._lifted[rows] - self._lifted[row]) ** 2).sum(axis=1))

    def _split(self, rows: np.ndarray) -> list[np.ndarray]:
        """Halves between two far apart objects until each fits a page; neighbours in the list lie close."""
        if len(rows) <= self.page:
            return [rows]
        one = rows[self._distances(rows[0], rows).argmax()]
        from_one = self._distances(one, rows)
        other = rows[from_one.argmax()]
        order = np.argsort(from_one - self._distances(other, rows), kind="stable")
        middle = len(rows) // 2
        return self._split(rows[order[:middle]]) + self._split(rows[order[middle:]])

    def _central(self, rows: np.ndarray) -> int:
        points = self._lifted[rows]
        return int(rows[((points - points.mean(axis=0)) ** 2).sum(axis=1).argmin()])

    def _leaf(self, rows: np.ndarray) -> tuple[int, float, Page]:
        routing = self._central(rows)
        away = self._distances(routing, rows)
        return routing, float(away.max()), Page(rows, away, np.zeros(len(rows)), None)

    def _above(self, below: list[tuple[int, float, Page]]) -> tuple[int, float, Page]:
        rows, radii = np.array([row for row, _, _ in below]), np.array([radius for _, radius, _ in below])
        routing = self._central(rows)
        away = self._distances(routing, rows)
        return routing, float((away + radii).max()), Page(rows, away, radii, [page for _, _, page in below])

    def search(self, query: np.ndarray, ids: np.ndarray, own: int, k: int) -> list[tuple[int, int]]:
        """The `k` best (score, id), without the id `own`; equal scores go to the smaller id."""
        base, slack = float(query @ query) + self.length2, SLACK * math.sqrt(self.length2 + 1)

        def distances(scores: np.ndarray) -> np.ndarray:
            return np.sqrt(np.maximum(base - 2 * scores, 0))

        best: list[tuple[int, int]] = []  # heap of (score, -id), the worst first
        reach = math.inf
        away = float(distances(self.vectors[self.routing:self.routing + 1] @ query)[0])
        queue: list[tuple[float, int, float, Page]] = [(max(away - self.radius, 0.0), 0, away, self.root)]
        pushed = 0
        while queue and queue[0][0] <= reach + slack:
            _, _, away, page = heappop(queue)
            possible = np.abs(away - page.to_parent) - page.radii <= reach + slack
            places = np.flatnonzero(possible)
            scores = self.vectors[page.rows[places]] @ query
            found = distances(scores)
            if page.pages is not None:
                for place, distance in zip(places.tolist(), found.tolist()):
                    least = max(distance - page.radii[place], 0.0)
                    if least <= reach + slack:
                        pushed += 1
                        heappush(queue, (least, pushed, distance, page.pages[place]))
                continue
            near = found <= reach + slack
            for score, name in zip(scores[near].tolist(), ids[page.rows[places[near]]].tolist()):
                if name == own:
                    continue
                entry = (int(score), -name)
                if len(best) < k:
                    heappush(best, entry)
                elif entry > best[0]:
                    heappop(best)
                    heappush(best, entry)
            if len(best) == k:
                reach = math.sqrt(max(base - 2 * best[0][0], 0))
        return [(score, -name) for score, name in sorted(best, key=lambda one: (-one[0], -one[1]))]


def integral(embeddings: DataFrame) -> DataFrame:
    """`vec_id`, `vector` of floor(256 * x) and `width`, without vectors that
    are null or hold a null or non-finite component, or have no id."""
    values = F.transform("embedding", lambda x: x.cast("double"))
    sound = F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    floors = F.transform(values, lambda x: F.floor(F.lit(256.0) * x))
    return (embeddings.filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & sound)
            .select(F.col("vec_id").cast("bigint"), floors.alias("vector"), F.size("embedding").alias("width")))


def _search(k: int):
    def search(table: pa.Table) -> pa.Table:
        width = table.column("width")[0].as_py()
        flat = table.column("vector").combine_chunks().flatten().to_numpy().astype(np.float64)
        vectors = flat.reshape(table.num_rows, width)
        ids = table.column("vec_id").to_numpy()
        asks = table.column("asks").to_numpy(zero_copy_only=False)
        out: dict[str, list] = {"query_id": [], "query_key": [], "vec_id": [], "score": []}
        if (~asks).any() and asks.any():
            # Doubles hold every sum of products exactly below 2**53; beyond, whole numbers are used.
            length = float(table.column("length")[0].as_py())
            tree = MTree(vectors[~asks], length)
            if length >= 1 << 52:
                tree.vectors = tree.vectors.astype(object)
            keys = table.column("query_key").to_numpy()
            for place in np.flatnonzero(asks):
                query = vectors[place] if length < 1 << 52 else vectors[place].astype(np.int64).astype(object)
                for score, name in tree.search(query, ids[~asks], int(ids[place]), k):
                    out["query_id"].append(int(ids[place]))
                    out["query_key"].append(int(keys[place]))
                    out["vec_id"].append(name)
                    out["score"].append(score)
        return pa.table({name: pa.array(values, pa.int64()) for name, values in out.items()})
    return search


def top_k(embeddings: DataFrame, is_query, k: int = 5, tree_rows: int = TREE_ROWS,
          block_queries: int = BLOCK_QUERIES) -> DataFrame:
    """`query_id`, `rank`, `vec_id`, `score`: for each row for which `is_query`
    holds, the `k` rows with the largest integer inner product, or all if fewer.

    Vectors are compared with those of the same width. Rows with the query's
    own id are no candidates; other repeated rows and ids count one by one, and
    equal query rows are answered once. Ties go to the smaller id. Vectors that
    `integral` leaves out take no part; an empty table gives an empty result.
    Scores are exact while they fit 63 bits.
    """
    spark = embeddings.sparkSession
    ship(spark.sparkContext)
    vectors = integral(embeddings)
    squares = F.aggregate("vector", F.lit(0.0), lambda total, x: total + x.cast("double") * x)
    queries = vectors.filter(is_query).distinct().withColumn("query_key", F.xxhash64("vec_id", "vector"))
    # One row per width of vectors.
    sizes = (vectors.groupBy("width").agg(F.max(squares).alias("length"), F.count(F.lit(1)).alias("_rows"))
             .join(queries.groupBy("width").agg(F.count(F.lit(1)).alias("_asked")), "width")
             .select("width", "length", F.ceil(F.col("_rows") / tree_rows).cast("bigint").alias("trees"),
                     F.ceil(F.col("_asked") / block_queries).cast("bigint").alias("blocks")))
    tasks = sizes.agg(F.sum(F.col("trees") * F.col("blocks"))).first()[0] or 1

    def numbers(n: str):
        return F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(n) - 1))

    columns = ("width", "length", "tree", "block", "asks", "vec_id", "query_key", "vector")
    rows = (vectors.join(sizes, "width")
            .withColumn("tree", F.pmod(F.xxhash64("vec_id", "vector"), "trees")).withColumn("block", numbers("blocks"))
            .withColumn("asks", F.lit(False)).withColumn("query_key", F.lit(0).cast("bigint")).select(*columns))
    asked = (queries.join(sizes, "width")
             .withColumn("block", F.pmod("query_key", "blocks")).withColumn("tree", numbers("trees"))
             .withColumn("asks", F.lit(True)).select(*columns))
    grid = rows.unionAll(asked).repartition(int(min(tasks, 1 << 20)), "width", "tree", "block")
    found = grid.groupBy("width", "tree", "block").applyInArrow(
        _search(k), "query_id bigint, query_key bigint, vec_id bigint, score bigint")
    order = Window.partitionBy("query_id", "query_key").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
