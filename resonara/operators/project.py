"""Principal components, covariance and the layouts of result pages."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from resonara.functions.vectors import to_double
from resonara.operators.neighbours import knn
from resonara.workspace import written

# --- fixed values -----------------------------------------------------------
RADIUS = 1.5
CANVAS_LOW, CANVAS_HIGH, CANVAS_MIDDLE = 10.0, 90.0, 50.0
TOP_LOADINGS = 10
# ----------------------------------------------------------------------------

MAX_DIMS = 4096  # a covariance matrix of this width still fits one process


@dataclass
class PcaModel:
    mean: np.ndarray
    components: np.ndarray  # k x D
    explained: np.ndarray  # share of the total variance per component


def _mean(df: DataFrame, vector: str) -> tuple[int, np.ndarray]:
    typed = df.where(F.col(vector).isNotNull()).select(array_to_vector(to_double(F.col(vector))).alias("_v"))
    row = typed.agg(F.count("*").alias("n"), Summarizer.mean(F.col("_v")).alias("m")).first()
    if not row["n"]:
        raise ValueError("no vectors")
    mean = row["m"].toArray()
    if len(mean) > MAX_DIMS:
        raise ValueError(f"more than {MAX_DIMS} dimensions")
    return row["n"], mean


def _scatter(df: DataFrame, vector: str, mean: np.ndarray) -> DataFrame:
    """``i, j, total``: centred products, one D x D partial sum per task.

    There are as many tasks as keep the cores busy, however many files there are,
    so the partial sums do not grow with the data.
    """
    dims, tasks = len(mean), 2 * df.sparkSession.sparkContext.defaultParallelism

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((dims, dims))
        for batch in batches:
            if len(batch):
                centred = np.stack(batch[vector].to_list()).astype(np.float64) - mean
                total += centred.T @ centred
        yield pd.DataFrame({"i": np.arange(dims, dtype="int32"), "products": list(total)})

    rows = df.where(F.col(vector).isNotNull()).select(vector).coalesce(tasks).mapInPandas(partial, "i int, products array<double>")
    cells = rows.select("i", F.posexplode("products").alias("j", "product"))
    return cells.groupBy("i", "j").agg(F.sum("product").alias("total"))


def covariance(df: DataFrame, vector: str = "embedding") -> DataFrame:
    """``i, j, cov``: sample covariance of the dimensions."""
    n, mean = _mean(df, vector)
    return _scatter(df, vector, mean).select("i", "j", (F.col("total") / (n - 1)).alias("cov"))


def _oriented(components: np.ndarray) -> np.ndarray:
    """Fix each sign so that the largest loading in size is positive."""
    largest = np.abs(components).argmax(axis=1)
    signs = np.sign(components[np.arange(len(components)), largest])
    return components * np.where(signs == 0, 1.0, signs)[:, None]


def fit_pca(df: DataFrame, k: int = 2, vector: str = "embedding") -> PcaModel:
    """Centred principal components.  Only the D x D covariance reaches the
    driver; its width is checked."""
    n, mean = _mean(df, vector)
    cells = _scatter(df, vector, mean).toPandas()
    matrix = np.zeros((len(mean), len(mean)))
    matrix[cells["i"], cells["j"]] = cells["total"] / max(n - 1, 1)
    values, columns = np.linalg.eigh(matrix)
    order = np.argsort(values)[::-1][:k]
    total = values.sum()
    share = values[order] / total if total > 0 else np.zeros(len(order))
    return PcaModel(mean, _oriented(columns[:, order].T), share)


def fit_pca_wide(df: DataFrame, k: int = 2, vector: str = "embedding", *, spare: int = 8, passes: int = 30, tolerance: float = 1e-9,
                 seed: int = 42) -> PcaModel:
    """``fit_pca`` for vectors of any width, without a D x D matrix.

    A random subspace of ``k + spare`` directions is turned towards the data: each
    pass projects the rows on it, adds up what the projections give back in every
    task, and makes the sum orthonormal.  Ends when the k leading shares change by
    less than ``tolerance``, or after ``passes``; directions whose shares are nearly
    equal are told apart slowly.  The driver holds D x (k + spare) numbers.
    """
    typed = df.where(F.col(vector).isNotNull())
    if typed.isEmpty():
        raise ValueError("no vectors")
    summed = typed.select(array_to_vector(to_double(F.col(vector))).alias("_v")).agg(
        F.count("*").alias("n"), Summarizer.mean(F.col("_v")).alias("mean"), Summarizer.variance(F.col("_v")).alias("variance")).first()
    n = summed["n"]
    mean, total = summed["mean"].toArray(), float(summed["variance"].toArray().sum())
    width = min(k + spare, len(mean))
    basis, _ = np.linalg.qr(np.random.default_rng(seed).normal(size=(len(mean), width)))
    rows = typed.select(vector).coalesce(2 * df.sparkSession.sparkContext.defaultParallelism)
    before = np.full(min(k, width), np.inf)
    for _ in range(passes):
        turned = _turned(rows, vector, mean, basis) / max(n - 1, 1)  # covariance times basis
        # within the subspace the covariance is small and solved at once
        values, inner = np.linalg.eigh((basis.T @ turned + turned.T @ basis) / 2)
        order = np.argsort(values)[::-1]
        values, leading = np.clip(values[order], 0.0, None), (basis @ inner[:, order])[:, :k]
        if np.all(np.abs(values[:k] - before) <= tolerance * max(total, 1e-300)):
            break
        before = values[:k]
        basis, _ = np.linalg.qr(turned)
    share = values[:k] / total if total > 0 else np.zeros(min(k, width))
    return PcaModel(mean, _oriented(leading.T), share)


def _turned(rows: DataFrame, vector: str, mean: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """Centred rows, transposed, times centred rows times ``basis``: one D x l partial sum per task."""
    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(basis.shape)
        for batch in batches:
            if len(batch):
                centred = np.stack(batch[vector].to_list()).astype(np.float64) - mean
                total += centred.T @ (centred @ basis)
        yield pd.DataFrame({"column": np.arange(basis.shape[1], dtype="int32"), "part": list(total.T)})

    sums = rows.mapInPandas(partial, "column int, part array<double>").groupBy("column").agg(
        Summarizer.sum(array_to_vector("part")).alias("total")).collect()
    return np.stack([row["total"].toArray() for row in sorted(sums, key=lambda row: row["column"])], axis=1)


def project(df: DataFrame, model: PcaModel, vector: str = "embedding", name: str = "coordinates") -> DataFrame:
    """Add the coordinates of every row with a vector; also for rows the model has not seen."""
    df = df.where(F.col(vector).isNotNull())
    mean, components = model.mean, model.components

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def coordinates(vectors: pd.Series) -> pd.Series:
        centred = np.stack(vectors.to_list()).astype(np.float64) - mean
        return pd.Series(list(centred @ components.T))

    return df.withColumn(name, coordinates(vector))


def explained(spark: SparkSession, model: PcaModel) -> DataFrame:
    """``component, share``: the part of the variance that each component holds."""
    return spark.createDataFrame([(i, float(share)) for i, share in enumerate(model.explained)], "component int, share double")


def to_xy(df: DataFrame, name: str = "coordinates") -> DataFrame:
    return df.withColumns({"x": F.get(name, F.lit(0)), "y": F.get(name, F.lit(1))}).drop(name)


def loadings(df: DataFrame, model: PcaModel, names: list[str] | None = None) -> DataFrame:
    """``component, feature, loading``: k x D rows."""
    names = names or [f"e{i}" for i in range(model.components.shape[1])]
    rows = [(c + 1, names[i], float(value)) for c, row in enumerate(model.components) for i, value in enumerate(row)]
    return df.sparkSession.createDataFrame(rows, "component int, feature string, loading double")


def top_loadings(loading_rows: DataFrame, n: int = TOP_LOADINGS) -> DataFrame:
    """The n features with the largest absolute loading per component."""
    order = Window.partitionBy("component").orderBy(F.desc(F.abs("loading")), "feature")
    return loading_rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


def result_coordinates(rows: DataFrame, group: str, key: str, vector: str = "embedding") -> DataFrame:
    """``group, key, x, y``: a two-component map of each result on its own.

    A result is a query with its n neighbours, so a group is n + 1 rows.
    """
    schema = T.StructType([rows.schema[group], rows.schema[key],
                           T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())])

    def place(result: pd.DataFrame) -> pd.DataFrame:
        result = result.sort_values(key, kind="stable")
        points = np.stack(result[vector].to_list()).astype(np.float64)
        centred = points - points.mean(axis=0)
        axes = _oriented(np.linalg.svd(centred, full_matrices=False)[2][:2])
        xy = np.zeros((len(points), 2))
        xy[:, :len(axes)] = centred @ axes.T
        return pd.DataFrame({group: result[group].to_numpy(), key: result[key].to_numpy(), "x": xy[:, 0], "y": xy[:, 1]})

    return rows.select(group, key, vector).groupBy(group).applyInPandas(place, schema)


def radial_layout(found: DataFrame, query: str = "query_id", radius: float = RADIUS) -> DataFrame:
    """``query, rank, x, y``: the query at the origin as rank 0, its n neighbours
    on a circle by rank.  Starts a Spark job."""
    found = written(found.select(query, "rank"), "ranks")  # read twice, and a search may stand behind it
    counts = found.groupBy(query).agg(F.max("rank").alias("n"))
    angle = (F.col("rank") - 1) * (2.0 * F.pi()) / F.col("n")
    circle = found.join(counts, query).select(
        query, "rank", (F.lit(radius) * F.cos(angle)).alias("x"), (F.lit(radius) * F.sin(angle)).alias("y"))
    centre = counts.select(query, F.lit(0).alias("rank"), F.lit(0.0).alias("x"), F.lit(0.0).alias("y"))
    return circle.unionByName(centre)


def canvas_scale(df: DataFrame, *columns: str, within: list[str] = ()) -> DataFrame:
    """Scale columns to the canvas with margins, over the table or per group; a
    constant column sits in the middle."""
    spans = [F.min(c).alias(f"_{c}_low") for c in columns] + [F.max(c).alias(f"_{c}_high") for c in columns]
    if within:
        ranged = df.join(df.groupBy(*within).agg(*spans), list(within))
    else:
        ends = df.agg(*spans).first().asDict()  # one row
        ranged = df.withColumns({name: F.lit(value) for name, value in ends.items()})

    def scaled(c: str):
        low, high = F.col(f"_{c}_low"), F.col(f"_{c}_high")
        position = (F.col(c) - low) / (high - low) * (CANVAS_HIGH - CANVAS_LOW) + CANVAS_LOW
        clamped = F.greatest(F.lit(CANVAS_LOW), F.least(F.lit(CANVAS_HIGH), position))
        return F.when(high == low, CANVAS_MIDDLE).otherwise(clamped)

    extra = [f"_{c}_{end}" for c in columns for end in ("low", "high")]
    return ranged.withColumns({c: scaled(c) for c in columns}).drop(*extra)


def place_new_points(new: DataFrame, items: DataFrame, coordinates: DataFrame, k: int = 5, *,
                     query_id: str = "query_id", item_id: str = "item_id", vector: str = "embedding") -> DataFrame:
    """``query_id, x, y``: the mean map position of the k nearest mapped items."""
    near = knn(items, new, k, corpus_id=item_id, query_id=query_id, vector=vector, skip_self=False)
    at = coordinates.select(F.col(item_id).alias("item_id"), "x", "y")
    return near.join(at, "item_id").groupBy("query_id").agg(F.avg("x").alias("x"), F.avg("y").alias("y"))
