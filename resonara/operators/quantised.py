"""Exact nearest neighbours from a quantised vector file.

Every vector is stored a second time with one byte per dimension, together with
the exact length of what the bytes lose.  The distance to the decoded vector, less
and plus that length, bounds the true distance from below and above, so the bytes
alone tell which items can be among the k nearest; only these are measured.

The file lies in rings: cells around pivots, cut by the distance to the pivot.  The
span of a ring's distances bounds all of its items at once, and rings beyond what
a query has found in its own cell are not visited.  In high dimension, where no
bound on cells helps, the search still moves and compares bytes instead of
numbers, and measures little more than k items to a query.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from resonara.operators import neighbours as N
from resonara.workspace import written

LEVELS = 256
RINGS = 8  # of a cell
SAMPLE_ROWS = 4096  # rows from which the levels are taken; any levels give the same neighbours


def _levels(corpus: DataFrame, metric: str) -> np.ndarray:
    """Ascending marks per dimension, ``LEVELS`` + 1 of them: quantiles of some rows."""
    rows = N.present(corpus, "vector").orderBy(F.xxhash64("item_id"), "item_id").limit(SAMPLE_ROWS).toPandas()
    if rows.empty:
        return np.zeros((1, LEVELS + 1))
    matrix = N._matrix(rows["vector"], metric)
    matrix = matrix[~np.isnan(matrix).any(axis=1)]
    return np.quantile(matrix, np.linspace(0, 1, LEVELS + 1), axis=0).T if len(matrix) else np.zeros((1, LEVELS + 1))


def _decoded(codes: np.ndarray, marks: np.ndarray) -> np.ndarray:
    middles = (marks[:, 1:] + marks[:, :-1]) / 2
    return middles[np.arange(len(marks)), codes]


def _encode(corpus: DataFrame, marks: np.ndarray, pivots: np.ndarray, metric: str) -> DataFrame:
    """``item_id, vector`` (the codes), ``lost`` (length of what they lose), ``cell`` and ``radius``."""
    @F.pandas_udf("vector binary, lost double, cell int, radius double")
    def encode(vectors: pd.Series) -> pd.DataFrame:
        matrix = N._matrix(vectors, metric)
        known = np.nan_to_num(matrix)
        codes = np.stack([np.searchsorted(own[1:-1], column, side="right") for own, column in zip(marks, known.T)], axis=1).astype(np.uint8)
        away = N._to_pivots(matrix, pivots)
        lost = np.sqrt(np.square(matrix - _decoded(codes, marks)).sum(axis=1))
        return pd.DataFrame({"vector": [row.tobytes() for row in codes], "lost": lost, "cell": away.argmin(axis=1).astype("int32"), "radius": away.min(axis=1)})

    found = N.present(corpus, "vector").select("item_id", encode("vector").alias("code")).select("item_id", "code.*")
    return found.where(F.col("lost") < float("inf"))  # cosine vectors of no length, whose loss is no number, are near nothing


class _Bounded:
    """For a block of queries, the items met so far that can be among a query's k nearest: those whose least
    distance is not beyond the k-th smallest greatest one."""

    def __init__(self, points: np.ndarray, ids: pa.Array, items: pa.DataType, k: int, skip_self: bool, block_rows: int, lowest: np.ndarray):
        self.points, self.kind, self.ids, self.items = points, ids.type, N.flat_ids(ids), items
        self.skip_self, self.block_rows, self.lowest = skip_self, block_rows, lowest
        self.squares = np.einsum("ij,ij->i", points, points)
        self.kept = N.Kept(len(points), k, 2)
        self.visited, self.compared = np.zeros(lowest.shape, bool), np.zeros(len(points), np.int64)

    def meet(self, cell: int, pack: tuple[np.ndarray, ...]) -> None:
        """``pack``: points, what they lost, places of their rings, which ascend, and ids."""
        rings = pack[2]
        unbounded = np.flatnonzero(np.isinf(self.kept.limit))
        for start in range(0, len(rings), self.block_rows):  # until k are found, no ring can be left out
            self._visit(unbounded, pack, start, min(start + self.block_rows, len(rings)))
        bounded = np.setdiff1d(np.arange(len(self.points)), unbounded, assume_unique=True)
        starts = np.flatnonzero(np.diff(rings, prepend=-1))
        for first, end in zip(starts, [*starts[1:], len(rings)]):
            for start in range(first, end, self.block_rows):
                near = bounded[self.lowest[bounded, rings[first]] <= self.kept.limit[bounded]]
                self._visit(near, pack, start, min(start + self.block_rows, end))

    def _visit(self, rows: np.ndarray, pack: tuple[np.ndarray, ...], start: int, end: int) -> None:
        if not len(rows):
            return
        points, lost, rings, ids = (column[start:end] for column in pack)
        self.compared[rows] += len(points)
        self.visited[np.ix_(rows, np.unique(rings))] = True
        squares = np.einsum("ij,ij->i", points, points)
        step = max(1, min(self.block_rows, N._TILE_CELLS // len(points)))
        none = np.isinf(self.kept.limit[rows])
        for part, meet in ((rows[none], self._first), (rows[~none], self._further)):
            for at in range(0, len(part), step):
                meet(part[at:at + step], points, lost, squares, ids)
        self.kept.settle(bool(none.any()))

    def _slack(self, own: np.ndarray, squares: np.ndarray) -> np.ndarray:
        """The rounding of the product may move a distance this far."""
        return 1e-6 * (1.0 + np.sqrt(own + squares))

    def _first(self, part: np.ndarray, points: np.ndarray, lost: np.ndarray, squares: np.ndarray, ids: np.ndarray) -> None:
        """For queries that have not found k yet."""
        own, k = self.squares[part][:, None], self.kept.k
        away = np.sqrt(np.clip(own + squares[None] - 2.0 * (self.points[part] @ points.T), 0.0, None))
        slack = self._slack(own, squares[None])
        least, most = away - lost - slack, away + lost + slack
        if self.skip_self:
            most[N.same_ids(self.ids[part][:, None], ids[None])] = np.inf
        most[np.isnan(most)] = np.inf
        kth = np.partition(most, k - 1, axis=1)[:, k - 1] if most.shape[1] >= k else np.full(len(most), np.inf)
        i, j = np.nonzero((least <= kth[:, None]) & np.isfinite(most))
        self.kept.add(part[i], least[i, j], most[i, j], ids[j])

    def _further(self, part: np.ndarray, points: np.ndarray, lost: np.ndarray, squares: np.ndarray, ids: np.ndarray) -> None:
        """For queries with a limit: away - lost <= limit, squared, is one product and one comparison."""
        reach = self.kept.limit[part] + self._slack(self.squares[part], squares.max())
        own = self.squares[part]
        left = np.hstack([-2.0 * self.points[part], np.ones((len(part), 1)), -2.0 * reach[:, None]])
        right = np.hstack([points, (squares - lost * lost)[:, None], lost[:, None]])
        margin = 1e-9 * (1.0 + own + squares.max() + reach * reach + np.square(lost).max())
        i, j = np.divmod(np.flatnonzero((left @ right.T <= (reach * reach - own + margin)[:, None]).ravel()), len(points))
        for at in range(0, len(i), N._EXACT_ROWS):
            row, item = part[i[at:at + N._EXACT_ROWS]], j[at:at + N._EXACT_ROWS]
            away, slack = np.sqrt(np.square(self.points[row] - points[item]).sum(axis=1)), self._slack(self.squares[row], squares[item])
            least, most = away - lost[item] - slack, away + lost[item] + slack
            near = (least <= self.kept.limit[row]) & np.isfinite(most)
            if self.skip_self:
                near &= ~N.same_ids(self.ids[row], ids[item])
            self.kept.add(row[near], least[near], most[near], ids[item[near]])

    def result(self) -> Iterator[pa.RecordBatch]:
        """The survivors; the work for a query stands in its first row."""
        self.kept.settle()
        rows, _, _, ids = self.kept.entries
        first = np.diff(rows, prepend=-1) > 0
        rings, compared = (np.where(first, work[rows], 0) for work in (self.visited.sum(axis=1), self.compared))
        for at in range(0, len(rows), 1 << 16):
            part = slice(at, at + (1 << 16))
            yield pa.RecordBatch.from_arrays([N.arrow_ids(self.ids[rows[part]], self.kind), N.arrow_ids(ids[part], self.items), pa.array(rings[part]), pa.array(compared[part])],
                                             ["query_id", "item_id", "rings", "compared"])


def knn_quantised(corpus: DataFrame, queries: DataFrame, k: int, *, metric: str = "l2", corpus_id: str = "item_id", query_id: str = "query_id",
                  vector: str = "embedding", skip_self: bool = True, cells: int | None = None, block_rows: int | None = None) -> tuple[DataFrame, DataFrame]:
    """The rows of ``neighbours.knn``, and a report on the work.

    Ids are unique.  The report has a row per query that found anything: ``query_id,
    candidates`` (items measured), ``compared`` (items whose bytes were compared)
    and ``rings`` (visited, of ``all_rings``).  Starts Spark jobs.
    """
    if metric not in N.METRICS:
        raise ValueError(f"metric must be one of {N.METRICS}")
    if k < 1:
        raise ValueError("k must be positive")
    corpus, queries = N._columns(corpus, corpus_id, vector, "item_id"), N._columns(queries, query_id, vector, "query_id")
    marks, pivots = _levels(corpus, metric), N._pick_pivots(corpus, corpus.count(), metric, cells)
    if not len(pivots):  # no vector that anything could be near to
        item_type, query_type = (df.schema[name].dataType for df, name in ((corpus, "item_id"), (queries, "query_id")))
        nothing = corpus.sparkSession.createDataFrame([], T.StructType([T.StructField("query_id", query_type), T.StructField("item_id", item_type)]))
        empty = nothing.select("query_id", "item_id", F.lit(0.0).alias("distance_sq"))
        counts = [F.lit(0).cast("long").alias(name) for name in ("candidates", "rings", "compared")]
        return N._finish(N._best(empty, k), metric), nothing.select("query_id", *counts, F.lit(0).alias("all_rings"))
    codes = written(_encode(corpus, marks, pivots, metric), "codes")
    shares = [n / RINGS for n in range(1, RINGS)]
    # stored: an approximate quantile may come out otherwise when computed again
    edges = written(codes.groupBy("cell").agg(F.percentile_approx("radius", shares, 1000).alias("edges")), "edges")
    ring = (F.col("cell") * RINGS + F.size(F.filter("edges", lambda edge: edge < F.col("radius")))).alias("ring")
    codes = codes.join(F.broadcast(edges), "cell").select("item_id", "vector", "lost", "radius", "cell", ring)
    # at most MAX_PIVOTS * RINGS rows
    spans = codes.groupBy("cell", "ring").agg(F.min("radius").alias("inner"), F.max("radius").alias("outer"), F.count("*").alias("rows")).orderBy("ring").toPandas()
    numbers, inner, outer = spans["ring"].to_numpy(), spans["inner"].to_numpy(), spans["outer"].to_numpy()
    centres, between = numbers // RINGS, N._to_pivots(pivots, pivots)

    def lowest(matrix: np.ndarray) -> np.ndarray:
        """The least possible distance to each ring."""
        away = N._to_pivots(matrix, pivots)
        own = away.argmin(axis=1)
        span = np.maximum(away[:, centres] - outer, inner - away[:, centres])
        with np.errstate(invalid="ignore", divide="ignore"):
            plane = (away ** 2 - away[np.arange(len(own)), own][:, None] ** 2) / (2.0 * between[own])
        return np.maximum(span, np.nan_to_num(plane, nan=0.0, posinf=0.0, neginf=0.0)[:, centres]) - 1e-6 * (1.0 + away[:, centres])

    stored = written(N._assign_cell(queries, pivots, metric), "queries")
    asked = stored.groupBy("cell").agg(F.count("*").alias("rows")).toPandas().set_index("cell")["rows"]
    rows, query_rows = N.rows_of_packs(N._width(corpus), int(asked.sum()), corpus.sparkSession.sparkContext.defaultParallelism)
    query_type, item_type, item_kind = queries.schema["query_id"].dataType, corpus.schema["item_id"].dataType, to_arrow_type(corpus.schema["item_id"].dataType)

    def start(pack: Callable) -> _Bounded:
        points = N.unpacked(pack, metric)
        return _Bounded(points, pack("ids").values, item_kind, k, skip_self, block_rows or N.MAX_BLOCK_ROWS, lowest(points))

    def read(pack: Callable) -> tuple[np.ndarray, ...]:
        ids = N.flat_ids(pack("ids").values)
        points = _decoded(np.frombuffer(pack("vectors").as_buffer(), np.uint8).reshape(len(ids), -1), marks)
        return points, np.frombuffer(pack("lost").as_buffer()), np.searchsorted(numbers, np.frombuffer(pack("ring").as_buffer(), np.int32)), ids

    schema = T.StructType([T.StructField("query_id", query_type), T.StructField("item_id", item_type), T.StructField("rings", T.LongType()), T.StructField("compared", T.LongType())])
    file = N.packs(codes.select("item_id", "vector", "lost", "ring", "cell"), "item_id", spans.groupby("cell")["rows"].sum(), 4 * rows, "rings", order="ring")
    blocks = N.packs(stored.select("query_id", "vector", "cell"), "query_id", asked, query_rows, "query-packs")
    pairs = written(N.stream_past(file, blocks, max(1, math.ceil(asked.sum() / query_rows)), len(pivots) > 1, start, read, schema), "survivors")

    measured = pairs.select("query_id", "item_id").join(stored.select("query_id", "vector"), "query_id").join(
        N.present(corpus, "vector").select("item_id", F.col("vector").alias("other")), "item_id")

    @F.pandas_udf("double")
    def distance_sq(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series(np.square(N._matrix(a, metric) - N._matrix(b, metric)).sum(axis=1))

    found = N._finish(N._best(measured.select("query_id", "item_id", distance_sq("vector", "other").alias("distance_sq")), k), metric)
    report = pairs.groupBy("query_id").agg(F.count("*").alias("candidates"), F.sum("rings").alias("rings"), F.sum("compared").alias("compared"))
    return found, report.withColumn("all_rings", F.lit(len(numbers)))
