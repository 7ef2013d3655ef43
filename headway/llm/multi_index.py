"""Approximate nearest neighbours by an inverted multi-index."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from headway.llm.common import hash_sample, in_batches, python_rows, staged

#: Vectors that the centroids of the halves are fitted on, at most.
TRAIN_VECTORS = 20_000
#: Centroids of a half, at most; there are this many squared cells.
MOST_CENTROIDS = 1024
#: Vectors that a cell should hold.
CELL_VECTORS = 50
#: A query walks through cells until it has met this share of all vectors: the least
#: that finds nine of ten neighbours where vectors have as good as no clusters ...
PROBE_SHARE = 0.55
#: ... and at least so many.
PROBE_LEAST = 2000
#: Vectors, and queries, that are compared with each other at a time: cells of
#: together about so many vectors are one block, a larger cell is several.
BLOCK_VECTORS = 4000
BLOCK_QUERIES = 2000


def _vector(raw, width: int | None = None) -> np.ndarray | None:
    """The vector in double precision, None if it takes no part."""
    if raw is None or None in raw:
        return None
    value = np.array(raw, np.float64)
    if not len(value) or (width is not None and len(value) != width):
        return None
    return value if np.isfinite(value).all() and value.any() else None


def _unit(vectors: np.ndarray) -> np.ndarray:
    # Scaled first, so that squares neither overflow nor vanish.
    scaled = vectors / np.abs(vectors).max(axis=-1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=-1, keepdims=True))


def k_means(points: np.ndarray, k: int, rounds: int = 12, seed: int = 0) -> np.ndarray:
    """``k`` centroids, or as many as there are distinct points if those are fewer."""
    distinct = np.unique(points, axis=0)
    rng = np.random.default_rng(seed)
    centroids = distinct[rng.permutation(len(distinct))[:k]]
    for _ in range(rounds):
        nearest = _distances(points, centroids).argmin(axis=1)
        counts = np.bincount(nearest, minlength=len(centroids))
        sums = np.zeros_like(centroids)
        np.add.at(sums, nearest, points)
        filled = counts > 0
        centroids[filled] = sums[filled] / counts[filled, None]
    return centroids


def _distances(points: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distances, up to a constant of each point."""
    return (centroids**2).sum(axis=1)[None, :] - 2 * points @ centroids.T


class MultiIndex:
    """Both halves of a vector have centroids of their own; a cell is a pair of them."""

    def __init__(self, sample: np.ndarray, k: int) -> None:
        self.width = sample.shape[1]
        self.half = max(1, self.width // 2)
        self.first = k_means(sample[:, : self.half], k)
        second = sample[:, self.half :]
        self.second = k_means(second, k) if second.shape[1] else np.zeros((1, 0))

    def cells(self, vectors: np.ndarray) -> np.ndarray:
        one = _distances(vectors[:, : self.half], self.first).argmin(axis=1)
        two = _distances(vectors[:, self.half :], self.second).argmin(axis=1)
        return one * len(self.second) + two

    def walk(self, vector: np.ndarray) -> Iterator[int]:
        """Cells by summed distance of the pair, nearest first.

        Each half's centroids are sorted; a heap holds the frontier of pairs. A
        pair is pushed when the one before it in each half has been taken.
        """
        a = _distances(vector[None, : self.half], self.first)[0]
        b = _distances(vector[None, self.half :], self.second)[0]
        by_a, by_b = np.argsort(a, kind="stable"), np.argsort(b, kind="stable")
        a, b = a[by_a], b[by_b]
        heap = [(a[0] + b[0], 0, 0)]
        taken = np.zeros(len(a), np.int64)  # pairs taken of each row
        while heap:
            _, i, j = heapq.heappop(heap)
            yield int(by_a[i]) * len(by_b) + int(by_b[j])
            taken[i] = j + 1
            if j + 1 < len(b) and (i == 0 or taken[i - 1] > j + 1):
                heapq.heappush(heap, (a[i] + b[j + 1], i, j + 1))
            if i + 1 < len(a) and taken[i + 1] == j:
                heapq.heappush(heap, (a[i + 1] + b[j], i + 1, j))


_ENTRY_SQL = "cell long, vec_id long, vector binary"
_ENTRY = pa.schema([("cell", pa.int64()), ("vec_id", pa.int64()), ("vector", pa.binary())])


def _entries(index: MultiIndex, kind: str):
    def run(batches):
        def rows():
            for one in batches:
                ids, raw = (c.to_pylist() for c in one.columns)
                pairs = [(i, v) for i, x in zip(ids, raw) if (v := _vector(x, index.width)) is not None]
                if pairs:
                    cells = index.cells(_unit(np.stack([v for _, v in pairs])))
                    for cell, (vec_id, vector) in zip(cells.tolist(), pairs):
                        yield cell, vec_id, vector.astype(kind).tobytes()

        return in_batches(_ENTRY, rows(), 1000)

    return run


_ASKED_SQL = "block long, part int, lot int, vec_id long, vector binary, cells binary"
_ASKED = pa.schema(
    [
        ("block", pa.int64()),
        ("part", pa.int32()),
        ("lot", pa.int32()),
        ("vec_id", pa.int64()),
        ("vector", pa.binary()),
        ("cells", pa.binary()),
    ]
)


def _block_of(cell, blocks: int):
    """The block of a cell, for numbers and for columns."""
    return cell * 2_654_435_761 % blocks


def _probes(index: MultiIndex, kind: str, sizes: dict[int, int], wanted: int, blocks: int, lots: int):
    """For each query the cells to look into, until they hold ``wanted`` vectors, by block."""

    def run(batches):
        def rows():
            for _, vec_id, raw in python_rows(batches):
                met = 0
                found: dict[tuple[int, int], list[int]] = {}
                for cell in index.walk(_unit(np.frombuffer(raw, kind).astype(np.float64)[None, :])[0]):
                    size = sizes.get(cell)
                    if size:
                        if size > BLOCK_VECTORS:
                            for part in range(-(-size // BLOCK_VECTORS)):
                                found[-1 - cell, part] = [cell]
                        else:
                            found.setdefault((_block_of(cell, blocks), 0), []).append(cell)
                        met += size
                        if met >= wanted:
                            break
                lot = xxhash.xxh3_64_intdigest(b"%d" % vec_id) % lots
                for (block, part), cells in found.items():
                    yield block, part, lot, vec_id, raw, np.array(sorted(cells), np.int64).tobytes()

        return in_batches(_ASKED, rows(), 500)

    return run


def _cosines(vectors: np.ndarray, queries: np.ndarray) -> np.ndarray:
    """Cosine of each row with the query's row; equal rows get the same bits."""
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    queries = queries / np.abs(queries).max(axis=1, keepdims=True)
    dots = (vectors * queries).sum(axis=1)
    return dots / (np.sqrt((vectors * vectors).sum(axis=1)) * np.sqrt((queries * queries).sum(axis=1)))


_FOUND_SQL = "query_id long, vec_id long, score double"


def _block_nearest(ids, vectors, query_ids, queries, open_to, top: int):
    """(query's place, entry's place, score) of the ``top`` nearest entries of each query.

    ``open_to`` tells which entries are in cells that the query looks into.
    """
    rough = _unit(queries) @ _unit(vectors).T
    rough[(query_ids[:, None] == ids[None, :]) | ~open_to] = -np.inf
    least = np.full(len(queries), -2.0)
    if rough.shape[1] > top:
        least = np.maximum(least, np.partition(rough, -top, axis=1)[:, -top] - 1e-9)
    near = rough >= least[:, None]
    del rough
    # Many entries may tie, so queries are taken few enough at a time.
    ends = np.cumsum(near.sum(axis=1)) // 100_000
    for lot in np.unique(ends):
        own = np.flatnonzero(ends == lot)
        q, e = np.nonzero(near[own])
        q = own[q]
        score = _cosines(vectors[e], queries[q])
        order = np.lexsort((ids[e], -score, q))
        q, e, score = q[order], e[order], score[order]
        first = np.searchsorted(q, q)
        kept = np.arange(len(q)) - first < top
        yield q[kept], e[kept], score[kept]


def _rerank(top: int, kind: str):
    """The ``top`` nearest of a block's entries for each of the block's queries."""

    def run(_key, entries: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        names = ["query_id", "vec_id", "score"]
        if not len(entries) or not len(queries):
            return pd.DataFrame({n: np.empty(0) for n in names})
        ids = entries["vec_id"].to_numpy(np.int64)
        vectors = np.frombuffer(b"".join(entries["vector"]), kind).reshape(len(ids), -1).astype(np.float64)
        asked = queries["vec_id"].to_numpy(np.int64)
        wanted = np.frombuffer(b"".join(queries["vector"]), kind).reshape(len(asked), -1).astype(np.float64)
        cells, cell_of = np.unique(entries["cell"].to_numpy(np.int64), return_inverse=True)
        looks = np.zeros((len(asked), len(cells)), bool)
        for i, raw in enumerate(queries["cells"]):
            looks[i, np.searchsorted(cells, np.frombuffer(raw, np.int64))] = True
        found = []
        for start in range(0, len(asked), 250):
            part = slice(start, start + 250)
            open_to = looks[part][:, cell_of]
            for q, e, score in _block_nearest(ids, vectors, asked[part], wanted[part], open_to, top):
                found.append(pd.DataFrame({"query_id": asked[part][q], "vec_id": ids[e], "score": score}))
        return pd.concat(found) if found else pd.DataFrame({n: np.empty(0) for n in names})

    return run


def nearest(
    vectors: DataFrame,
    is_query: Column,
    top: int = 5,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    probe_share: float = PROBE_SHARE,
    probe_least: int = PROBE_LEAST,
) -> DataFrame:
    """The ``top`` vectors found nearest by cosine to each query: query_id, rank, vec_id, score.

    ``is_query`` is a condition on ``vectors``. Every vector is indexed; the
    centroids are fitted on a sample of ``TRAIN_VECTORS``, the first in hash
    order. Scores are cosines of the original vectors in double precision; ties
    go to the smaller vec_id. Vectors that are null, empty, zero, hold null or
    non-finite components, or are not of the commonest length take no part, and so do rows without an id. Rows that repeat
    an id are one query, are not candidates of it, and each a candidate of
    others. Without valid vectors the result is empty.

    Cells are gathered in blocks of bounded size, large cells are split, and so
    are the queries; each block gives a query that looks into it ``top`` rows.
    """
    spark = vectors.sparkSession
    # Single-precision vectors travel as they are; nothing is lost.
    single = vectors.select(vector_col).schema[0].dataType == ArrayType(FloatType())
    kind = "<f4" if single else "<f8"
    plain = vectors.select(
        F.col(id_col).cast("long").alias("vec_id"),
        F.col(vector_col).cast("array<double>").alias("vector"),
        F.coalesce(is_query, F.lit(False)).alias("is_query"),
    ).filter("vec_id IS NOT NULL")
    good = plain.filter("size(vector) > 0").filter(
        ~F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
        & F.exists("vector", lambda x: x != 0)
    )
    # The commonest width, the smaller of equally common ones.
    widths = good.groupBy(F.size("vector").alias("width")).agg(F.count(F.lit(1)).alias("n"))
    most = widths.orderBy(F.desc("n"), "width").first()
    if most is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    width, total = most
    good = good.filter(F.size("vector") == width)
    sample = hash_sample(good, ["vec_id"], TRAIN_VECTORS, 5).select("vec_id", "vector").collect()
    points = _unit(np.array([row["vector"] for row in sample]))
    k = int(min(MOST_CENTROIDS, max(4, round((total / CELL_VECTORS) ** 0.5)), len(points)))
    index = MultiIndex(points, k)
    entries = staged(good.select("vec_id", "vector").mapInArrow(_entries(index, kind), _ENTRY_SQL), "cells")
    queries = good.filter("is_query").select("vec_id", "vector").dropDuplicates(["vec_id"])
    queries = staged(queries.mapInArrow(_entries(index, kind), _ENTRY_SQL), "queries")
    # At most MOST_CENTROIDS squared rows, whatever the number of vectors.
    sizes = {row["cell"]: row["n"] for row in entries.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect()}
    wanted = max(probe_least, int(probe_share * total))
    blocks = max(1, -(-total // BLOCK_VECTORS))
    lots = max(1, -(-queries.count() // BLOCK_QUERIES))
    asked = queries.mapInArrow(_probes(index, kind, sizes, wanted, blocks, lots), _ASKED_SQL)
    large = [(c, -(-n // BLOCK_VECTORS)) for c, n in sizes.items() if n > BLOCK_VECTORS]
    large = F.broadcast(spark.createDataFrame(large, "cell long, parts int"))
    own = (
        entries.join(large, "cell", "left")
        .withColumns(
            {
                "block": F.when(F.col("parts").isNull(), _block_of(F.col("cell"), blocks)).otherwise(-1 - F.col("cell")),
                "part": F.coalesce(F.pmod(F.xxhash64("vec_id"), F.col("parts")), F.lit(0)).cast("int"),
                "lot": F.explode(F.sequence(F.lit(0), F.lit(lots - 1))),
            }
        )
        .select("block", "part", "lot", "cell", "vec_id", "vector")
    )
    key = ["block", "part", "lot"]
    found = (
        own.groupBy(*key).cogroup(asked.groupBy(*key)).applyInPandas(_rerank(top, kind), _FOUND_SQL)
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= top)
        .select("query_id", "rank", "vec_id", "score")
    )
