"""Exact nearest neighbours.

Three plans give the same rows:

* ``scan``: the queries are few (their size is checked) and travel to the
  corpus; each corpus partition keeps a running top-k.
* ``blocks``: queries lie in packs of bounded size, a task holds some of them, and
  the stored corpus streams past it in packs.  A cell is a Voronoi cell of a few
  pivots; after the own cell has been searched, the k-th distance rules out cells
  by the triangle and hyperplane bounds, so only the cells that can still matter
  are searched.  Nothing is copied for a pair: the disk holds each row a few times.
* inside clusters: queries and items of a cluster meet in (block, block) tasks.

A task never sees more than a few packs or one block of each side, however large a
cell is, and emits at most k rows per query.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from resonara.workspace import written

BLOCK_BYTES = 32 << 20  # one side of a block pair; every row is copied once per block of the other side
MIN_BLOCK_ROWS, MAX_BLOCK_ROWS = 1024, 1 << 17
MAX_SCAN_QUERIES = 2048
MAX_SCAN_BYTES = 64 << 20
MAX_PIVOTS = 512
ROWS_PER_PIVOT = 4096
_STRIPE_CELLS = 4 << 20  # distances held at once inside a task
PACK_BYTES = 2 << 20  # vectors, at 8 bytes a number, that travel as one row
MIN_QUERY_ROWS = 256  # of a pack
_TILE_CELLS = 1 << 18  # distances between two packs that are computed at once
_EXACT_ROWS = 1 << 14
METRICS = ("l2", "cosine")


def _matrix(vectors: pd.Series, metric: str) -> np.ndarray:
    matrix = np.stack(vectors.to_list()).astype(np.float64)
    if metric == "cosine":
        with np.errstate(invalid="ignore", divide="ignore"):
            matrix = matrix / np.linalg.norm(matrix, axis=1, keepdims=True)
    return matrix


def _top_k(queries: np.ndarray, query_ids: np.ndarray, corpus: np.ndarray, corpus_ids: np.ndarray,
           k: int, skip_self: bool) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(query row, corpus rows, distances)`` of the k nearest, ties by corpus row.

    Candidates are picked with one matrix product and a rounding margin, then
    measured exactly.  Rows of zero-length cosine vectors are NaN and never match.
    """
    corpus_sq = np.einsum("ij,ij->i", corpus, corpus)
    stripe = max(1, _STRIPE_CELLS // max(len(corpus), 1))
    for start in range(0, len(queries), stripe):
        block = queries[start:start + stripe]
        block_sq = np.einsum("ij,ij->i", block, block)
        rough = block_sq[:, None] + corpus_sq[None, :] - 2.0 * (block @ corpus.T)
        rough[np.isnan(rough)] = np.inf
        if skip_self:
            rough[query_ids[start:start + stripe][:, None] == corpus_ids[None, :]] = np.inf
        kth = min(k, corpus.shape[0]) - 1
        bound = np.partition(rough, kth, axis=1)[:, kth]
        margin = 1e-9 * (1.0 + block_sq + corpus_sq.max(initial=0.0, where=~np.isnan(corpus_sq)))
        for i in range(len(block)):
            near = np.flatnonzero((rough[i] <= bound[i] + margin[i]) & np.isfinite(rough[i]))
            exact = np.square(block[i] - corpus[near]).sum(axis=1)
            best = np.argsort(exact, kind="stable")[:k]
            yield start + i, near[best], exact[best]


def nearest_rows(vectors: np.ndarray, corpus: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``_top_k`` over plain matrices: (row, corpus rows, exact squared distances)."""
    nobody = np.full(len(vectors), -1)
    return _top_k(vectors, nobody, corpus, np.arange(len(corpus)), k, False)


def _result_schema(queries: DataFrame, corpus: DataFrame, *extra: T.StructField) -> T.StructType:
    return T.StructType([
        T.StructField("query_id", queries.schema["query_id"].dataType),
        T.StructField("item_id", corpus.schema["item_id"].dataType),
        T.StructField("distance_sq", T.DoubleType()),
        *extra,
    ])


def _rows(found, query_ids, corpus_ids) -> pd.DataFrame:
    q, c, d = [], [], []
    for row, items, distances in found:
        q.append(np.repeat(query_ids[row:row + 1], len(items)))
        c.append(corpus_ids[items])
        d.append(distances)
    if not q:
        return pd.DataFrame({"query_id": query_ids[:0], "item_id": corpus_ids[:0],
                             "distance_sq": np.zeros(0)})
    return pd.DataFrame({"query_id": np.concatenate(q), "item_id": np.concatenate(c),
                         "distance_sq": np.concatenate(d)})


def _best(found: DataFrame, k: int, *order: str) -> DataFrame:
    """Rank by ``order`` then distance then id, and keep k per query."""
    per_query = Window.partitionBy("query_id").orderBy(*order, "distance_sq", "item_id")
    return found.withColumn("rank", F.row_number().over(per_query)).where(F.col("rank") <= k)


def _finish(found: DataFrame, metric: str) -> DataFrame:
    if metric == "cosine":
        # unit vectors: squared distance = 2 - 2 cos
        return found.withColumn("similarity", 1.0 - F.col("distance_sq") / 2.0)
    return found.withColumn("distance", F.sqrt("distance_sq"))


def _columns(df: DataFrame, id_col: str, vector: str, name: str, *extra: str) -> DataFrame:
    return df.select(F.col(id_col).alias(name), F.col(vector).alias("vector"), *extra)


def present(df: DataFrame, vector: str = "embedding") -> DataFrame:
    """Rows with a vector.  The rule of all vector operators: rows without one are left out."""
    return df.where(F.col(vector).isNotNull())


def _present(df: DataFrame) -> DataFrame:
    """Applied late, so that counting rows reads no vectors."""
    return present(df, "vector")


# --- queries travel to the corpus -------------------------------------------

def _scan(corpus: DataFrame, queries: pd.DataFrame, query_schema: DataFrame, k: int, metric: str,
          skip_self: bool) -> DataFrame:
    query_ids = queries["query_id"].to_numpy()
    query_matrix = _matrix(queries["vector"], metric) if len(queries) else np.zeros((0, 0))

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept: pd.DataFrame | None = None
        for batch in batches:
            if batch.empty or not len(query_ids):
                continue
            batch = batch.sort_values("item_id", kind="stable")
            ids = batch["item_id"].to_numpy()
            found = _rows(_top_k(query_matrix, query_ids, _matrix(batch["vector"], metric), ids, k, skip_self),
                          query_ids, ids)
            kept = found if kept is None else pd.concat([kept, found], ignore_index=True)
            kept = kept.sort_values(["query_id", "distance_sq", "item_id"], kind="stable")
            kept = kept.groupby("query_id", sort=False).head(k)
        if kept is not None:
            yield kept

    return _present(corpus).mapInPandas(scan, _result_schema(query_schema, corpus))


def _width(df: DataFrame) -> int:
    """Dimensions of a table whose vectors all have the same."""
    one = _present(df).select(F.size("vector").alias("d")).first()
    return max(one["d"], 1) if one else 1


def _few(queries: DataFrame, max_rows: int, max_bytes: int) -> pd.DataFrame | None:
    """The queries as one pandas frame if they fit the bounds, else None."""
    rows = queries.limit(max_rows + 1).count()
    if rows > max_rows or rows * _width(queries) * 8 > max_bytes:
        return None
    return _present(queries).toPandas()


# --- queries and corpus meet in blocks --------------------------------------

def _rows_per_block(corpus: DataFrame, queries: DataFrame) -> int:
    """As many rows as fill a block, unless that leaves cores idle."""
    cores = corpus.sparkSession.sparkContext.defaultParallelism
    busy = math.isqrt(corpus.count() * queries.count() // (2 * cores))
    full = min(MAX_BLOCK_ROWS, BLOCK_BYTES // (4 * _width(corpus)))
    return int(max(MIN_BLOCK_ROWS, min(full, busy)))


def meet_in_blocks(corpus: DataFrame, queries: DataFrame, meet: Callable, schema: T.StructType, block_rows: int) -> DataFrame:
    """Run ``meet(query rows, corpus rows)`` on every block of queries and block of items of one ``cell``.

    ``corpus`` has ``item_id, vector, cell``, ``queries`` has ``query_id, vector, cell``, and either any other columns.
    """
    corpus_blocks = corpus.groupBy("cell").agg(F.ceil(F.count("*") / block_rows).alias("corpus_blocks"))
    query_blocks = queries.groupBy("cell").agg(F.ceil(F.count("*") / block_rows).alias("query_blocks"))
    sizes = corpus_blocks.join(query_blocks, "cell")

    def spread(df: DataFrame, key: str, own: str, other: str) -> DataFrame:
        own_block = F.pmod(F.xxhash64(key), F.col(f"{own}_blocks")).alias(f"{own}_block")
        copies = F.explode(F.sequence(F.lit(0).cast("long"), F.col(f"{other}_blocks") - 1))
        return _present(df).join(sizes, "cell").select(*df.columns, own_block, copies.alias(f"{other}_block"))

    keys = ["cell", "query_block", "corpus_block"]
    left = spread(queries, "query_id", "query", "corpus").groupBy(*keys)
    right = spread(corpus, "item_id", "corpus", "query").groupBy(*keys)
    return left.cogroup(right).applyInPandas(meet, schema)


def _block_join(corpus: DataFrame, queries: DataFrame, k: int, metric: str, skip_self: bool,
                block_rows: int | None) -> DataFrame:
    """Top-k of every query within its cell, from blocks of bounded size.

    ``corpus``: item_id, vector, cell.  ``queries``: query_id, vector, cell and
    optionally ``cell_rank``, the visiting order of the cell, and ``within``, a
    squared distance beyond which nothing is wanted.
    """
    ranked, limited = "cell_rank" in queries.columns, "within" in queries.columns
    extra = [T.StructField("cell_rank", T.IntegerType())] if ranked else []

    def meet(query_rows: pd.DataFrame, corpus_rows: pd.DataFrame) -> pd.DataFrame:
        columns = ["query_id", "item_id", "distance_sq"] + (["cell_rank"] if ranked else [])
        if query_rows.empty or corpus_rows.empty:
            return pd.DataFrame(columns=columns)
        corpus_rows = corpus_rows.sort_values("item_id", kind="stable")
        query_ids = query_rows["query_id"].to_numpy()
        ids = corpus_rows["item_id"].to_numpy()
        found = _rows(
            _top_k(_matrix(query_rows["vector"], metric), query_ids,
                   _matrix(corpus_rows["vector"], metric), ids, k, skip_self),
            query_ids, ids)
        extras = [c for c, used in (("cell_rank", ranked), ("within", limited)) if used]
        if extras:
            found = found.merge(query_rows[["query_id", *extras]], on="query_id")
        if limited:
            found = found[found["distance_sq"] <= found["within"].fillna(np.inf)]
        return found[columns]

    return meet_in_blocks(corpus, queries, meet, _result_schema(queries, corpus, *extra), block_rows or _rows_per_block(corpus, queries))


def _pick_pivots(corpus: DataFrame, rows: int, metric: str, cells: int | None) -> np.ndarray:
    """Rows spread over the corpus, ``cells`` of them or by its size.  They steer
    the work only; any choice gives the same neighbours.  A cell may hold any
    number of rows, as cells are searched in blocks."""
    wanted = cells or int(min(MAX_PIVOTS, max(1, rows // ROWS_PER_PIVOT)))
    picked = _present(corpus).orderBy(F.xxhash64("item_id"), "item_id").limit(wanted).toPandas()
    pivots = _matrix(picked["vector"], metric) if len(picked) else np.zeros((0, 0))
    return np.unique(pivots[~np.isnan(pivots).any(axis=1)], axis=0) if pivots.size else pivots


def _to_pivots(matrix: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    squares = (np.einsum("ij,ij->i", matrix, matrix)[:, None]
               + np.einsum("ij,ij->i", pivots, pivots)[None, :] - 2.0 * (matrix @ pivots.T))
    return np.sqrt(np.clip(np.nan_to_num(squares, nan=0.0), 0.0, None))


def _assign_cell(df: DataFrame, pivots: np.ndarray, metric: str) -> DataFrame:
    @F.pandas_udf("cell int, radius double")
    def nearest_pivot(vectors: pd.Series) -> pd.DataFrame:
        away = _to_pivots(_matrix(vectors, metric), pivots)
        return pd.DataFrame({"cell": away.argmin(axis=1).astype("int32"), "radius": away.min(axis=1)})

    return _present(df).withColumn("_at", nearest_pivot("vector")).select(*df.columns, "_at.cell", "_at.radius")


def _lowest(pivots: np.ndarray, outer: np.ndarray, inner: np.ndarray) -> Callable:
    """Function from points, and their own cells if not those of the nearest pivots, to the least possible distance to each cell's items, less what rounding may move it."""
    between = _to_pivots(pivots, pivots) if len(pivots) else None

    def lowest(points: np.ndarray, own_cell: np.ndarray | None = None) -> np.ndarray:
        away = _to_pivots(points, pivots)
        own_cell = away.argmin(axis=1) if own_cell is None else own_cell
        at_own = away[np.arange(len(away)), own_cell]
        triangle = np.maximum(away - outer[None, :], inner[None, :] - away)
        with np.errstate(invalid="ignore", divide="ignore"):
            plane = (away ** 2 - at_own[:, None] ** 2) / (2.0 * between[own_cell])
        return np.maximum(triangle, np.nan_to_num(plane, nan=0.0, posinf=0.0, neginf=0.0)) - 1e-6 * (1.0 + away)

    return lowest


def _other_cells(pivots: np.ndarray, outer: np.ndarray, inner: np.ndarray, metric: str) -> Callable:
    """UDF: the cells, other than the own one, that may hold something nearer
    than ``bound``."""
    lowest = _lowest(pivots, outer, inner)

    @F.pandas_udf("array<int>")
    def cells_in_reach(vectors: pd.Series, own: pd.Series, bound: pd.Series) -> pd.Series:
        own_cell = own.to_numpy()
        reach = bound.fillna(np.inf).to_numpy()
        wanted = (lowest(_matrix(vectors, metric), own_cell) <= reach[:, None]) & np.isfinite(outer)[None, :]
        wanted[np.arange(len(wanted)), own_cell] = False
        return pd.Series([np.flatnonzero(row).astype("int32") for row in wanted])

    return cells_in_reach


# --- the corpus streams past blocks of queries ------------------------------

def flat_ids(ids: pa.Array) -> np.ndarray:
    """Whole numbers as such, other ids and those with nulls among them as objects."""
    if pa.types.is_integer(ids.type) and not ids.null_count:
        return ids.to_numpy(zero_copy_only=False)
    found = np.empty(len(ids), object)
    found[:] = ids.to_pylist()
    return found


def arrow_ids(ids: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.array(ids.tolist() if ids.dtype == object else ids, kind)


def id_order(ids: np.ndarray) -> np.ndarray:
    """Numbers that sort as the ids do, null first."""
    if ids.dtype != object:
        return ids
    places = {value: place for place, value in enumerate(sorted(set(ids), key=lambda value: (value is not None, value)))}
    return np.fromiter((places[value] for value in ids), np.int64, len(ids))


def same_ids(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    same = np.equal(one, other).astype(bool)
    return same & (other != None) if other.dtype == object else same  # noqa: E711


def _stacked(vectors: pa.ChunkedArray) -> np.ndarray:
    column = vectors.combine_chunks()
    values, sizes = column.flatten(), pc.list_value_length(column)
    if not values.null_count and len(pc.unique(sizes)) == 1:
        matrix = values.to_numpy(zero_copy_only=False).reshape(len(column), -1)
    else:
        matrix = np.stack([np.asarray(row, dtype=np.float64) for row in column.to_pylist()])
    return np.ascontiguousarray(matrix if matrix.dtype == np.float32 else matrix.astype(np.float64))


def packs(df: DataFrame, key: str, sizes: pd.Series, rows: int, name: str, order: str | None = None) -> DataFrame:
    """Stored ``cell, block, ids, vectors, single`` and the bytes of all other columns: rows of a cell, about ``rows`` of them to a pack.

    ``sizes`` has the number of rows by cell.  ``order`` names a column by which a pack is sorted.
    Vectors are lists of numbers or bytes; ``single`` tells that numbers have 32 bits.
    """
    others = [c for c in df.columns if c not in (key, "vector", "cell")]
    kinds = {c: np.dtype({"int": "i4", "double": "f8"}[df.schema[c].dataType.simpleString()]) for c in others}
    coded = isinstance(df.schema["vector"].dataType, T.BinaryType)
    blocks = np.ones(int(sizes.index.max()) + 1 if len(sizes) else 1, int)
    blocks[sizes.index.to_numpy(dtype=int)] = np.ceil(sizes.to_numpy(dtype=float) / rows)
    block = F.pmod(F.xxhash64(key), F.element_at(F.lit(blocks.tolist()), F.col("cell") + 1)).cast("int").alias("block")

    def pack(group: pa.Table) -> pa.Table:
        if order:
            group = group.sort_by(order)
        ids = group[key].combine_chunks()
        if coded:
            vectors, single = b"".join(group["vector"].to_pylist()), False
        else:
            matrix = _stacked(group["vector"])
            vectors, single = matrix.tobytes(), matrix.dtype == np.float32
        columns = {"cell": pa.array([group["cell"][0].as_py()], pa.int32()), "block": pa.array([group["block"][0].as_py()], pa.int32()),
                   "ids": pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids), "vectors": pa.array([vectors], pa.binary()), "single": pa.array([single])}
        return pa.table(columns | {c: pa.array([group[c].to_numpy().astype(kinds[c]).tobytes()], pa.binary()) for c in others})

    schema = T.StructType([T.StructField("cell", T.IntegerType()), T.StructField("block", T.IntegerType()), T.StructField("ids", T.ArrayType(df.schema[key].dataType)),
                           T.StructField("vectors", T.BinaryType()), T.StructField("single", T.BooleanType()), *[T.StructField(c, T.BinaryType()) for c in others]])
    found = _present(df).select(key, "vector", F.col("cell").cast("int").alias("cell"), *others, block).groupBy("cell", "block").applyInArrow(pack, schema)
    # a reader holds a row group at once, and a writer looks at its size after so many rows only
    return written(found, name, **{"parquet.block.size": 4 * PACK_BYTES, "parquet.page.size.row.check.min": 1, "parquet.enable.dictionary": "false"})


def unpacked(pack: Callable[[str], pa.Scalar], metric: str) -> np.ndarray:
    """Vectors of a pack whose columns ``pack`` gives, as numbers."""
    numbers = np.frombuffer(pack("vectors").as_buffer(), np.float32 if pack("single").as_py() else np.float64)
    matrix = numbers.reshape(len(pack("ids").values), -1).astype(np.float64)
    if metric == "cosine":
        with np.errstate(invalid="ignore", divide="ignore"):
            matrix = matrix / np.linalg.norm(matrix, axis=1, keepdims=True)
    return matrix


def stream_past(corpus: DataFrame, queries: DataFrame, parts: int, several: bool, start: Callable, read: Callable, schema: T.StructType) -> DataFrame:
    """Every pack of queries meets every pack of the corpus, those of its own cell first; no row is shuffled for it.

    A task holds the packs of queries of one of ``parts`` partitions and reads the
    stored corpus once from end to end, so that what lies on disk grows with the rows
    and not with their pairs.  ``start(column)`` makes the state of a pack of queries,
    ``read(column)`` what it meets, by ``state.meet(cell, rows)``; ``state.result()``
    yields record batches of ``schema``.  The order steers the work only: each pair meets once.
    """
    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        states, last, rows = {}, None, None
        for batch in batches:
            for at in range(batch.num_rows):
                here = [batch[name][at].as_py() for name in ("cell", "block", "first")]
                if here != last:
                    last, rows = here, read(lambda name: batch[name][at])  # noqa: B023
                key = batch["asked_cell"][at].as_py(), batch["asked_block"][at].as_py()
                if key not in states:
                    states[key] = start(lambda name: batch[f"asked_{name}"][at])  # noqa: B023
                states[key].meet(here[0], rows)
        for state in states.values():
            yield from state.result()

    stream = corpus.withColumn("first", F.lit(True))
    if several:
        stream = stream.unionByName(corpus.withColumn("first", F.lit(False)))
    asked = queries.select([F.col(c).alias(f"asked_{c}") for c in queries.columns]).repartitionByRange(parts, "asked_cell", "asked_block")
    own = F.col("first") == (F.col("cell") == F.col("asked_cell"))
    return stream.coalesce(1).join(asked.hint("shuffle_replicate_nl"), own).mapInArrow(meet, schema)


def rows_of_packs(width: int, asked: int, cores: int) -> tuple[int, int]:
    """Rows of a pack of the corpus, and of one of queries: such that all cores have some."""
    full = max(64, PACK_BYTES // (8 * width))
    return full, max(MIN_QUERY_ROWS, min(full, math.ceil(asked / (2 * cores))))


class Kept:
    """Entries of a block's queries: their row, numbers to sort by and the item's id; ``limit`` is what further ones must not exceed.

    New entries wait until they are worth a sort.
    """

    def __init__(self, rows: int, k: int, numbers: int):
        self.k, self.limit, self.numbers = k, np.full(rows, np.inf), numbers
        self.entries: list[np.ndarray] = [np.zeros(0, np.int64), *(np.zeros(0) for _ in range(numbers)), np.zeros(0, np.int64)]
        self.waiting: list[tuple] = []
        self.new, self.least = 0, max(1 << 16, rows * k // 2)

    def add(self, rows: np.ndarray, *columns: np.ndarray) -> None:
        if len(rows):
            self.waiting.append((rows, *columns))
            self.new += len(rows)

    def settle(self, now: bool = True) -> None:
        """Sort by query, the last number and the id; the k-th of a query is its limit, and entries whose first number exceeds it go."""
        if not self.waiting or not now and self.new < self.least:
            return
        if not len(self.entries[0]):
            self.entries[-1] = self.waiting[0][-1][:0]
        columns = [np.concatenate(column) for column in zip(self.entries, *self.waiting)]
        order = np.lexsort((id_order(columns[-1]), columns[-2], columns[0]))
        columns = [column[order] for column in columns]
        place = np.arange(len(order)) - np.searchsorted(columns[0], columns[0])
        kth = place == self.k - 1
        self.limit[columns[0][kth]] = columns[-2][kth]
        # with one number, those beyond the k-th place go, equal ones too
        keep = place < self.k if self.numbers == 1 else columns[1] <= self.limit[columns[0]]
        self.entries, self.waiting, self.new = [column[keep] for column in columns], [], 0


class _Nearest:
    """The k nearest of a block of queries among the items met so far."""

    def __init__(self, points: np.ndarray, ids: pa.Array, items: pa.DataType, k: int, skip_self: bool, block_rows: int, least: np.ndarray | None):
        self.points, self.kind, self.ids, self.items = points, ids.type, flat_ids(ids), items
        self.skip_self, self.block_rows, self.least = skip_self, block_rows, least
        self.squares = np.einsum("ij,ij->i", points, points)
        self.left = np.hstack([-2.0 * points, np.ones((len(points), 1))])
        self.kept = Kept(len(points), k, 1)

    def meet(self, cell: int, found: tuple[np.ndarray, np.ndarray]) -> None:
        for start in range(0, len(found[0]), self.block_rows):
            rows = np.arange(len(self.points)) if self.least is None else np.flatnonzero(self.least[:, cell] <= np.sqrt(self.kept.limit))
            self._meet(rows, *(column[start:start + self.block_rows] for column in found))

    def _meet(self, rows: np.ndarray, corpus: np.ndarray, ids: np.ndarray) -> None:
        squares, k, limit = np.einsum("ij,ij->i", corpus, corpus), self.kept.k, self.kept.limit
        right = np.hstack([corpus, squares[:, None]]).T
        largest = squares.max(initial=0.0, where=~np.isnan(squares))
        step = max(1, min(self.block_rows, _TILE_CELLS // len(corpus)))
        some_open = False
        for start in range(0, len(rows), step):
            part = rows[start:start + step]
            rough = self.left[part] @ right  # the squared distance less the query's square
            margin = 1e-9 * (1.0 + self.squares[part] + largest)
            bound = limit[part] - self.squares[part] + margin
            unbounded = np.flatnonzero(np.isinf(limit[part]))
            if len(unbounded):
                some_open = True
                own = np.where(np.isnan(rough[unbounded]), np.inf, rough[unbounded])
                if self.skip_self:
                    own[same_ids(self.ids[part[unbounded]][:, None], ids[None])] = np.inf
                bound[unbounded] = np.partition(own, k - 1, axis=1)[:, k - 1] + margin[unbounded] if len(corpus) >= k else np.inf
            i, j = np.divmod(np.flatnonzero((rough <= bound[:, None]).ravel()), len(corpus))
            keep = np.isfinite(rough[i, j])
            if self.skip_self:
                keep &= ~same_ids(self.ids[part[i]], ids[j])
            i, j = part[i[keep]], j[keep]
            away = np.empty(len(i))
            for at in range(0, len(i), _EXACT_ROWS):
                pairs = slice(at, at + _EXACT_ROWS)
                away[pairs] = np.square(self.points[i[pairs]] - corpus[j[pairs]]).sum(axis=1)
            near = away <= limit[i]
            self.kept.add(i[near], away[near], ids[j[near]])
        self.kept.settle(some_open)

    def result(self) -> Iterator[pa.RecordBatch]:
        self.kept.settle()
        rows, away, ids = self.kept.entries
        for at in range(0, len(rows), 1 << 16):
            part = slice(at, at + (1 << 16))
            yield pa.RecordBatch.from_arrays([arrow_ids(self.ids[rows[part]], self.kind), arrow_ids(ids[part], self.items), pa.array(away[part])],
                                             ["query_id", "item_id", "distance_sq"])


def _by_pivots(corpus: DataFrame, queries: DataFrame, k: int, metric: str, skip_self: bool,
               block_rows: int | None, cells: int | None = None) -> DataFrame:
    pivots = _pick_pivots(corpus, corpus.count(), metric, cells)
    several = len(pivots) > 1
    if several:
        corpus, queries = (written(_assign_cell(df, pivots, metric), name) for df, name in ((corpus, "corpus-cells"), (queries, "query-cells")))
    else:
        corpus, queries = (_present(df).withColumns({"cell": F.lit(0), "radius": F.lit(0.0)}) for df in (corpus, queries))
    # one row per pivot, at most MAX_PIVOTS
    spans = corpus.groupBy("cell").agg(F.max("radius").alias("outer"), F.min("radius").alias("inner"), F.count("*").alias("rows")).toPandas()
    asked = queries.groupBy("cell").agg(F.count("*").alias("rows")).toPandas().set_index("cell")["rows"]
    outer, inner = np.full(len(pivots), np.inf), np.zeros(len(pivots))
    if several:
        outer[spans["cell"]] = spans["outer"]
        inner[spans["cell"]] = spans["inner"]
    rows, query_rows = rows_of_packs(_width(corpus), int(asked.sum()), corpus.sparkSession.sparkContext.defaultParallelism)
    lowest = _lowest(pivots, outer, inner)

    def start(pack: Callable) -> _Nearest:
        points = unpacked(pack, metric)
        return _Nearest(points, pack("ids").values, items, k, skip_self, block_rows or MAX_BLOCK_ROWS, lowest(points) if several else None)

    def read(pack: Callable) -> tuple[np.ndarray, np.ndarray]:
        return unpacked(pack, metric), flat_ids(pack("ids").values)

    items = to_arrow_type(corpus.schema["item_id"].dataType)
    found = stream_past(packs(corpus.select("item_id", "vector", "cell"), "item_id", spans.set_index("cell")["rows"], rows, "corpus-packs"),
                        packs(queries.select("query_id", "vector", "cell"), "query_id", asked, query_rows, "query-packs"),
                        max(1, math.ceil(asked.sum() / query_rows)), several, start, read, _result_schema(queries, corpus))
    return _best(found, k)


# --- public operators -------------------------------------------------------

def knn(corpus: DataFrame, queries: DataFrame, k: int, *, metric: str = "l2", corpus_id: str = "item_id",
        query_id: str = "query_id", vector: str = "embedding", skip_self: bool = True, plan: str = "auto",
        block_rows: int | None = None, cells: int | None = None) -> DataFrame:
    """The k corpus items nearest to every query, exact.

    Columns ``query_id, item_id, rank, distance_sq`` with ``distance`` (l2) or
    ``similarity`` (cosine).  Ties go to the smaller id.  A corpus smaller than k
    gives fewer rows.  ``plan`` is ``auto``, ``scan`` or ``blocks``; ``cells`` sets
    the number of cells of the blocks.  All plans give the same rows.
    """
    if metric not in METRICS:
        raise ValueError(f"metric must be one of {METRICS}")
    if k < 1:
        raise ValueError("k must be positive")
    corpus = _columns(corpus, corpus_id, vector, "item_id")
    queries = _columns(queries, query_id, vector, "query_id")
    local = None
    if plan != "blocks" and cells is None:  # a scan of too many queries goes on in blocks
        local = _few(queries, MAX_SCAN_QUERIES, MAX_SCAN_BYTES)
    if local is not None:
        found = _best(_scan(corpus, local, queries, k, metric, skip_self), k)
    else:
        found = _by_pivots(corpus, queries, k, metric, skip_self, block_rows, cells)
    return _finish(found, metric)


def knn_in_cluster(corpus: DataFrame, queries: DataFrame, k: int, *, cluster: str = "cluster",
                   metric: str = "l2", corpus_id: str = "item_id", query_id: str = "query_id",
                   vector: str = "embedding", skip_self: bool = True,
                   block_rows: int | None = None) -> DataFrame:
    """``knn`` restricted to items of the query's cluster."""
    if metric not in METRICS:
        raise ValueError(f"metric must be one of {METRICS}")
    cell = F.col(cluster).alias("cell")
    found = _block_join(_columns(corpus, corpus_id, vector, "item_id", cell),
                        _columns(queries, query_id, vector, "query_id", cell),
                        k, metric, skip_self, block_rows)
    return _finish(_best(found, k), metric)


def search_cells(corpus: DataFrame, queries: DataFrame, k: int, *, skip_self: bool = True, block_rows: int | None = None) -> DataFrame:
    """``query_id, item_id, distance_sq, cell_rank``: up to k nearest of each query in each cell it is listed with.

    ``corpus`` has ``item_id, vector, cell``, ``queries`` has ``query_id, vector, cell, cell_rank``; stored tables.
    """
    return _block_join(corpus, queries, k, "l2", skip_self, block_rows)


def knn_widen(corpus: DataFrame, queries: DataFrame, visits: DataFrame, n: int, *,
              cluster: str = "cluster", corpus_id: str = "item_id", query_id: str = "query_id",
              vector: str = "embedding", block_rows: int | None = None, skip_self: bool = True) -> DataFrame:
    """n neighbours per query: own cluster first, then the next clusters.

    ``visits`` holds ``query_id, cluster, cell_rank``: the clusters each query
    needs, in order (see ``cluster_visits``).  One pass, each item at most once.
    """
    corpus = _columns(corpus, corpus_id, vector, "item_id", F.col(cluster).alias("cell"))
    queries = _columns(queries, query_id, vector, "query_id").join(
        visits.select("query_id", F.col(cluster).alias("cell"), F.col("cell_rank").cast("int")), "query_id")
    queries = written(queries, "visits")  # read for the block sizes and for the blocks
    found = _block_join(corpus, queries, n, "l2", skip_self, block_rows)
    return _finish(_best(found, n, "cell_rank"), "l2")


def pair_similarity(items: DataFrame, pairs: DataFrame, *, item_id: str = "item_id",
                    vector: str = "embedding") -> DataFrame:
    """Cosine and euclidean for the listed ``key1, key2`` pairs.  Pairs with an
    unknown key are left out."""
    from resonara.functions.vectors import cosine_similarity, euclidean

    one = items.select(F.col(item_id).alias("key1"), F.col(vector).alias("_v1"))
    two = items.select(F.col(item_id).alias("key2"), F.col(vector).alias("_v2"))
    return pairs.join(one, "key1").join(two, "key2").select(
        *pairs.columns,
        cosine_similarity(F.col("_v1"), F.col("_v2")).alias("cosine"),
        euclidean(F.col("_v1"), F.col("_v2")).alias("euclidean"),
    )
