"""Approximate nearest neighbours: inverted lists over k-means cells, probed and re-ranked by exact similarity.

Cells are fitted on a bounded sample; every row is assigned to its nearest cell and stored there, in packed
blocks of bounded size. A query meets the blocks of the cells that it probes. Blocks of rows and of queries
are joined on the cell, so a task multiplies two small matrices at a time, whatever the size of a cell, and
what leaves it is a query's k best. All cells probed is an exact search.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Rows that cells are fitted on at most, the first by a hash of their id, and rounds of k-means.
SAMPLE, ROUNDS = 20_000, 12
#: Rows of a packed block, and of a packed block of queries.
ROW_BLOCK, QUERY_BLOCK = 1024, 256
_BLOCKS = "cell int, ids array<long>, packed binary"


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-30)


def _raw(column: pa.Array, n: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float32).reshape(n, -1)


def _matrix(column: pa.Array, n: int) -> np.ndarray:
    return _unit(_raw(column, n))


def fit_cells(vectors: DataFrame, cells: int, *, sample: int = SAMPLE, id_col: str = "vec_id", vector_col: str = "embedding") -> np.ndarray:
    """Centres of ``cells`` cells by spherical k-means on at most ``sample`` rows, which come to the driver. Fewer rows, fewer cells."""
    given = vectors.where(F.col(vector_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<float>").alias("v"))
    rows = given.orderBy(F.xxhash64("id"), "id").limit(sample).select("v").toArrow().column("v").combine_chunks()
    if not len(rows):
        return np.zeros((0, 0), np.float32)
    points = _matrix(rows, len(rows))
    # every next centre is the point that is farthest from those before it, from the first on: no random start
    centres, nearest = [points[0]], points @ points[0]
    while len(centres) < min(cells, len(points)):
        far = int(nearest.argmin())
        if nearest[far] > 1 - 1e-6:
            break
        centres.append(points[far])
        nearest = np.maximum(nearest, points @ points[far])
    centre = np.stack(centres)
    for _ in range(ROUNDS):
        cell = (points @ centre.T).argmax(axis=1)
        sums = np.zeros_like(centre)
        np.add.at(sums, cell, points)
        empty = np.bincount(cell, minlength=len(centre)) == 0
        centre = np.where(empty[:, None], centre, _unit(sums))
    return centre


def _packed(rows: DataFrame, size: int) -> DataFrame:
    """Rows (cell, id, v), in order of cell within their partitions, as blocks of one cell and at most ``size`` rows."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            cell, ids = batch.column("cell").to_numpy(), batch.column("id").to_numpy()
            matrix = _raw(batch.column("v"), len(batch))
            edges = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]]))
            for low, high in zip(edges, [*edges[1:], len(batch)], strict=True):
                starts = range(low, high, size)
                parts = [slice(s, min(s + size, high)) for s in starts]
                columns = [pa.array(np.full(len(parts), cell[low])), pa.array([ids[p] for p in parts], pa.list_(pa.int64())), pa.array([matrix[p].tobytes() for p in parts], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["cell", "ids", "packed"])

    return rows.sortWithinPartitions("cell").mapInArrow(pack, _BLOCKS)


def _assigned(rows: DataFrame, centre: np.ndarray, probes: int) -> DataFrame:
    """(cell, id, v): each row once for each of its ``probes`` nearest cells, ties to the smaller number."""

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, len(whole), ROW_BLOCK):
                batch = whole.slice(at, ROW_BLOCK)
                near = np.argsort(-(_matrix(batch.column("v"), len(batch)) @ centre.T), axis=1, kind="stable")[:, :probes]
                take = pa.array(np.repeat(np.arange(len(batch)), near.shape[1]))
                yield pa.RecordBatch.from_arrays([pa.array(near.ravel().astype(np.int32)), batch.column("id").take(take), batch.column("v").take(take)], names=["cell", "id", "v"])

    return rows.mapInArrow(assign, "cell int, id long, v array<float>")


@dataclass(frozen=True)
class VectorIndex:
    """An index in a folder: ``centres`` (cell, centre) and ``lists`` (packed blocks, a folder for each cell)."""

    spark: SparkSession
    path: str

    @classmethod
    def build(cls, vectors: DataFrame, path: str, cells: int, *, sample: int = SAMPLE, id_col: str = "vec_id", vector_col: str = "embedding") -> VectorIndex:
        """Fits cells and stores every row but those without a vector. Vectors have one length; ids that repeat are rows each.

        One shuffle by cell, balanced by size: a cell that holds a third of all rows is several files and tasks.
        """
        spark, centre = vectors.sparkSession, fit_cells(vectors, cells, sample=sample, id_col=id_col, vector_col=vector_col)
        spark.createDataFrame([(i, c.tolist()) for i, c in enumerate(centre)], "cell int, centre array<float>").write.parquet(f"{path}/centres")
        given = vectors.where(F.col(vector_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<float>").alias("v"))
        _packed(_assigned(given, centre, 1).hint("rebalance", F.col("cell")), ROW_BLOCK).write.partitionBy("cell").parquet(f"{path}/lists")
        return cls(spark, path)

    def centres(self) -> np.ndarray:
        rows = self.spark.read.schema("cell int, centre array<float>").parquet(f"{self.path}/centres").orderBy("cell").collect()  # one row a cell
        return np.array([r["centre"] for r in rows], np.float32)

    def search(self, queries: DataFrame, k: int, probes: int, *, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
        """(query_id, id, similarity, rank): the k best of the probed cells by exact cosine, to nine places, without the query's own id.

        Queries may be as many as rows: none are sent to all tasks. Blocks of rows meet blocks of queries by a
        join on the cell, whose hot keys Spark splits; a task holds one pair of blocks, 1,024 by 256. Cells
        that no query probes aren't read where Spark prunes their folders.
        """
        centre = self.centres()
        given = queries.where(F.col(vector_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<float>").alias("v"))
        if not len(centre):
            return given.limit(0).select(F.col("id").alias("query_id"), "id", F.lit(0.0).alias("similarity"), F.lit(0).alias("rank"))
        asked = _packed(_assigned(given, centre, probes).hint("rebalance", F.col("cell")), QUERY_BLOCK).select("cell", F.col("ids").alias("query_ids"), F.col("packed").alias("query_packed"))
        lists = self.spark.read.schema(_BLOCKS).parquet(f"{self.path}/lists").select("cell", "ids", "packed")
        best = lists.join(asked, "cell").drop("cell").mapInArrow(_best(k, centre.shape[1]), "query_id long, id long, similarity double")
        window = Window.partitionBy("query_id").orderBy(F.col("similarity").desc(), "id")
        return best.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= k)


    def probes_for(self, queries: DataFrame, k: int, recall: float, *, sample: int = 200, id_col: str = "vec_id", vector_col: str = "embedding") -> int:
        """The fewest probes with which at least ``recall`` of the exact k best of a sample of queries are found.

        At most ``sample`` queries, the first by a hash of their id, are searched in all cells; the cells of what
        they find, ``sample`` times ``k`` rows, come to the driver. Vectors without structure need most cells.
        """
        centre = self.centres()
        some = queries.where(F.col(vector_col).isNotNull()).orderBy(F.xxhash64(F.col(id_col).cast("long")), id_col).limit(sample).cache()
        try:
            hits = self.search(some, k, len(centre), id_col=id_col, vector_col=vector_col).select("query_id", "id")
            cells = self.spark.read.schema(_BLOCKS).parquet(f"{self.path}/lists").select("cell", F.explode("ids").alias("id")).groupBy("id").agg(F.min("cell").alias("cell"))
            found = cells.join(hits, "id").select("query_id", "cell").collect()
            asked = {r[0]: np.array(r[1], np.float32) for r in some.select(F.col(id_col).cast("long"), vector_col).collect()}
        finally:
            some.unpersist()
        if not found:
            return max(1, len(centre))
        order = {q: np.argsort(np.argsort(-(_unit(v[None]) @ centre.T)[0], kind="stable"), kind="stable") for q, v in asked.items()}
        place = np.sort([order[r["query_id"]][r["cell"]] for r in found])
        return int(place[min(len(place) - 1, int(np.ceil(recall * len(place))) - 1)]) + 1


def _best(k: int, width: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, packed, query_ids, query_packed in zip(*[batch.column(c) for c in ("ids", "packed", "query_ids", "query_packed")], strict=True):
                have, asked = np.array(ids.as_py(), np.int64), np.array(query_ids.as_py(), np.int64)
                rows, queries = (_unit(np.frombuffer(p.as_buffer(), np.float32).reshape(-1, width).astype(np.float64)) for p in (packed, query_packed))
                score = np.round(queries @ rows.T, 9)
                score[asked[:, None] == have[None, :]] = -np.inf
                # by similarity, ties by id: columns are in order of id, and the sort is stable
                order = np.argsort(have, kind="stable")
                top = order[np.argsort(-score[:, order], axis=1, kind="stable")[:, :k]]
                found = np.take_along_axis(score, top, axis=1).ravel()
                query, hit = np.repeat(asked, top.shape[1]), have[top].ravel()
                real = np.isfinite(found)
                yield pa.RecordBatch.from_arrays([pa.array(query[real]), pa.array(hit[real]), pa.array(found[real])], names=["query_id", "id", "similarity"])

    return best
