import numpy as np
import pytest
from pyspark.sql import functions as F

from resonara.operators import cluster as C
from resonara.operators import neighbours as N
from resonara.workspace import written


def frame(spark, matrix, ids=None, **columns):
    ids = list(range(len(matrix))) if ids is None else ids
    names = list(columns)
    rows = [(int(i), [float(x) for x in row], *[columns[c][j] for c in names]) for j, (i, row) in enumerate(zip(ids, matrix))]
    return spark.createDataFrame(rows, "item_id long, embedding array<float>" + "".join(f", {c} int" for c in names))


def naive(corpus, queries, k, skip_self=True):
    found = set()
    for qi, q in enumerate(queries.astype(np.float32).astype(float)):
        d = ((corpus.astype(np.float32).astype(float) - q) ** 2).sum(axis=1)
        order = [i for i in np.lexsort((np.arange(len(d)), d)) if not (skip_self and i == qi)][:k]
        found |= {(qi, int(i), r + 1) for r, i in enumerate(order)}
    return found


def triples(df):
    return {(r["query_id"], r["item_id"], r["rank"]) for r in df.collect()}


@pytest.fixture(scope="module")
def clustered():
    rng = np.random.default_rng(7)
    centres = rng.normal(scale=8.0, size=(12, 16))
    return np.round(centres[rng.integers(0, 12, 1500)] + rng.normal(size=(1500, 16)), 3)


@pytest.mark.parametrize("plan, options", [
    ("scan", {}), ("blocks", {}), ("blocks", {"block_rows": 100})])
def test_knn_equals_naive(spark, clustered, plan, options):
    df = frame(spark, clustered).repartition(5)
    found = N.knn(df, df.withColumnRenamed("item_id", "query_id"), 4, plan=plan, **options)
    assert triples(found) == naive(clustered, clustered, 4)


def test_knn_with_pivots_equals_naive(spark, clustered, monkeypatch):
    """Many cells, several blocks per cell."""
    monkeypatch.setattr(N, "ROWS_PER_PIVOT", 40)
    df = frame(spark, clustered)
    found = N.knn(df, df.withColumnRenamed("item_id", "query_id"), 4, plan="blocks", block_rows=64)
    assert triples(found) == naive(clustered, clustered, 4)


def test_pivots_rule_out_most_cells(spark, clustered):
    pivots = clustered[:40].astype(float)
    away = N._to_pivots(clustered.astype(float), pivots)
    cell, radius = away.argmin(axis=1), away.min(axis=1)
    outer = np.array([radius[cell == c].max(initial=0.0) for c in range(40)])
    inner = np.array([radius[cell == c].min(initial=0.0) for c in range(40)])
    reach = N._other_cells(pivots, outer, inner, "l2")
    df = spark.createDataFrame([(row.tolist(), int(c), 5.0) for row, c in zip(clustered, cell)],
                               "v array<double>, c int, b double")
    visited = df.select(F.avg(F.size(reach("v", "c", "b")))).first()[0]
    assert visited < 10


def test_many_copies_and_pivots(spark, monkeypatch):
    """A third of the rows are one vector; ties go to the smaller id."""
    monkeypatch.setattr(N, "ROWS_PER_PIVOT", 30)
    rng = np.random.default_rng(3)
    matrix = np.vstack([np.ones((150, 4)), rng.normal(size=(300, 4))])
    df = frame(spark, matrix)
    for plan in ("scan", "blocks"):
        found = N.knn(df, df.withColumnRenamed("item_id", "query_id"), 3, plan=plan, block_rows=50)
        assert triples(found) == naive(matrix, matrix, 3)


def local_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(n).getPath(): files.apply(n).length() for n in range(files.size())}


def test_small_blocks_copy_no_rows(spark):
    """With a copy for every block of the other side, 1,200 rows in blocks of 30 took 1.6 MB of shuffle files."""
    matrix = np.random.default_rng(5).normal(size=(1200, 16))
    df = frame(spark, matrix)
    before = local_files(spark)
    found = N.knn(df, df.withColumnRenamed("item_id", "query_id"), 3, plan="blocks", block_rows=30, cells=2)
    assert triples(found) == naive(matrix, matrix, 3)
    assert sum(size for path, size in local_files(spark).items() if path not in before) < 5e5


def test_ids_of_text_and_none_in_blocks(spark):
    """Ties go to the smaller text; rows without an id are items like others."""
    rows = [(f"v{n:02d}", [float(n // 3), 0.0]) for n in range(30)] + [(None, [4.0, 0.1])]
    df = spark.createDataFrame(rows, "item_id string, embedding array<float>").repartition(4)
    queries = df.where("item_id is not null").withColumnRenamed("item_id", "query_id")
    seen = [sorted((r["query_id"], r["rank"], r["item_id"] or "", round(r["distance_sq"], 6)) for r in N.knn(df, queries, 4, **options).collect())
            for options in ({"plan": "scan"}, {"plan": "blocks", "block_rows": 5}, {"cells": 4, "block_rows": 5})]
    assert seen[0] == seen[1] == seen[2] and len(seen[0]) == 120


def test_a_query_that_stands_twice_gets_its_neighbours_twice(spark):
    """In whatever cells they lie, as in a join of both tables."""
    matrix = np.random.default_rng(8).normal(size=(60, 5))
    df = frame(spark, matrix)
    queries = df.unionByName(df.where("item_id < 20")).withColumnRenamed("item_id", "query_id")
    found = N.knn(df, queries, 4, plan="blocks", cells=9).where("query_id < 20").collect()
    once = {(r["query_id"], r["rank"]): r["item_id"] for r in N.knn(df, df.withColumnRenamed("item_id", "query_id"), 2, plan="scan").collect()}
    assert {(r["query_id"], r["rank"]): r["item_id"] for r in found} == {(q, rank): once[q, (rank + 1) // 2] for q in range(20) for rank in (1, 2, 3, 4)}


def test_knn_cosine(spark, clustered):
    unit = clustered / np.linalg.norm(clustered, axis=1, keepdims=True)
    df = frame(spark, np.vstack([clustered, np.zeros((1, 16))]))
    found = N.knn(df, df.withColumnRenamed("item_id", "query_id"), 1, metric="cosine").collect()
    similarity = unit @ unit.T
    np.fill_diagonal(similarity, -2)
    assert len(found) == len(clustered)  # the zero vector has no neighbour and is none
    for r in found:
        assert r["similarity"] == pytest.approx(similarity[r["query_id"]].max(), abs=1e-6)


def test_small_corpus_gives_fewer_rows(spark):
    df = frame(spark, np.eye(3))
    for plan in ("scan", "blocks"):
        found = N.knn(df, df.withColumnRenamed("item_id", "query_id"), 10, plan=plan)
        assert found.groupBy("query_id").count().where("count = 2").count() == 3
    with pytest.raises(ValueError):
        N.knn(df, df.withColumnRenamed("item_id", "query_id"), 0)
    with pytest.raises(ValueError):
        N.knn(df, df, 1, metric="manhattan")


def test_widen_visits_nearest_clusters_first(spark):
    rng = np.random.default_rng(5)
    matrix = np.vstack([rng.normal(0, 1, (2, 8)), rng.normal(6, 1, (50, 8)), rng.normal(30, 1, (500, 8))])
    labels = [0] * 2 + [1] * 50 + [2] * 500
    df = frame(spark, matrix, cluster=labels)
    queries = df.where("item_id = 0").withColumnRenamed("item_id", "query_id")
    for n, clusters in ((1, [0]), (10, [0] + [1] * 9), (60, [0] + [1] * 50 + [2] * 9), (1000, [0] + [1] * 50 + [2] * 500)):
        visits = C.cluster_visits(df, queries, C.centroids(df), n)
        found = N.knn_widen(df, queries, visits, n, block_rows=100).orderBy("rank").collect()
        assert [labels[r["item_id"]] for r in found] == clusters
        assert len({r["item_id"] for r in found}) == len(found) == min(n, 551)


def test_visits_without_shipping_centroids(spark, monkeypatch):
    rng = np.random.default_rng(6)
    df = frame(spark, rng.normal(size=(300, 4)), cluster=[i % 20 for i in range(300)])
    queries = df.withColumnRenamed("item_id", "query_id")
    shipped = sorted(map(tuple, C.cluster_visits(df, queries, C.centroids(df), 40).collect()))
    near = sorted((r["item_id"], r["cluster"]) for r in C.nearest_centroid(df, C.centroids(df)).collect())
    monkeypatch.setattr(C, "MAX_LOCAL_BYTES", 1)
    assert sorted(map(tuple, C.cluster_visits(df, queries, C.centroids(df), 40).collect())) == shipped
    assert sorted((r["item_id"], r["cluster"]) for r in C.nearest_centroid(df, C.centroids(df)).collect()) == near


def test_pair_similarity(spark):
    df = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [0.0, 2.0]), ("z", [0.0, 0.0])], "item_id string, embedding array<float>")
    pairs = spark.createDataFrame([("a", "b"), ("a", "a"), ("a", "z"), ("a", "missing")], "key1 string, key2 string")
    found = {(r["key1"], r["key2"]): (r["cosine"], r["euclidean"]) for r in N.pair_similarity(df, pairs).collect()}
    assert found == {("a", "b"): (0.0, pytest.approx(5 ** 0.5)), ("a", "a"): (1.0, 0.0), ("a", "z"): (None, 1.0)}


def test_kmeans(spark):
    rng = np.random.default_rng(2)
    matrix = np.vstack([rng.normal(c, 0.2, (40, 3)) for c in (0, 5, 10)])
    df = frame(spark, matrix)
    model = C.fit_kmeans(df, 3)
    placed = C.assign_kmeans(df, model)
    centres = np.array(model.clusterCenters())
    for r in placed.collect():
        away = ((centres - np.array(r["embedding"])) ** 2).sum(axis=1)
        assert away.argmin() == r["cluster"]
    costs = [C.lloyd_step(df, C.model_centroids(df, C.fit_kmeans(df, k))).agg(F.sum("cost")).first()[0] for k in (2, 3)]
    assert costs[1] < costs[0]
    assert {r["cluster"] for r in C.assign_kmeans(df, C.fit_kmeans(df, 1)).collect()} == {0}
    swept = C.kmeans_sweep(df, (2, 3))
    assert swept.select("Cluster_2").distinct().count() == 2 and swept.count() == 120
    with pytest.raises(ValueError):
        C.fit_kmeans(df, 0)


def test_neighbour_map_keeps_neighbours(spark):
    from resonara.operators.neighbour_map import neighbour_map, perplexity_affinity

    rng = np.random.default_rng(4)
    matrix = np.vstack([rng.normal(c * 6, 1.0, (40, 10)) for c in range(3)])
    df = frame(spark, matrix)
    near = N.knn(df, df.withColumnRenamed("item_id", "query_id"), 30)
    sums = perplexity_affinity(near, 10.0).groupBy("query_id").agg(
        F.sum("p").alias("p"), F.exp(-F.sum(F.col("p") * F.log("p"))).alias("perplexity")).collect()
    assert all(r["p"] == pytest.approx(1.0) and r["perplexity"] == pytest.approx(10.0, rel=1e-3) for r in sums)
    found = neighbour_map(df, perplexity=8.0, rounds=40).orderBy("item_id").collect()
    at = np.array([[r["x"], r["y"]] for r in found])
    assert np.isfinite(at).all()
    away = ((at[:, None] - at[None]) ** 2).sum(axis=2)
    np.fill_diagonal(away, np.inf)
    nearest = away.argsort(axis=1)[:, :5] // 40
    assert (nearest == (np.arange(120) // 40)[:, None]).mean() > 0.9


def test_quadtree_pushes_as_all_points_do():
    import pandas as pd

    from resonara.operators import neighbour_map as M

    rng = np.random.default_rng(0)
    at = np.concatenate([rng.normal(size=(300, 2)), rng.normal(size=(300, 2)) * 0.01 + 5, [[1, 1], [1, 1]]])
    box = M._Box.around(*at.min(axis=0), *at.max(axis=0))
    rows = pd.DataFrame({"code": box.codes(at), "mass": 1, "x": at[:, 0], "y": at[:, 1]}).groupby("code", as_index=False).sum()
    tree = M.Quadtree(box, rows.assign(depth=M.DEPTH), 1)
    push, kernel = tree.push(at, box.codes(at))
    gap = at[:, None] - at[None]
    weight = 1 / (1 + (gap ** 2).sum(axis=2))
    np.fill_diagonal(weight, 0)
    exact = (weight[:, :, None] ** 2 * gap).sum(axis=1)
    assert np.abs(push - exact).max() < 0.02 * np.abs(exact).max()
    assert kernel == pytest.approx(weight.sum(axis=1), rel=0.05) and tree.normaliser() == pytest.approx(weight.sum(), rel=0.01)


def test_quadtree_is_cut_where_points_are_crowded(spark, monkeypatch):
    from resonara.operators import neighbour_map as M

    monkeypatch.setattr(M, "TREE_POINTS", 10)
    monkeypatch.setattr(M, "LEAVES", 40)
    rng = np.random.default_rng(1)
    at = np.concatenate([rng.normal(size=(200, 2)), rng.normal(size=(400, 2)) * 1e-3 + 3])
    points = spark.createDataFrame([(float(x), float(y)) for x, y in at], "x double, y double")
    box = M._Box.around(*at.min(axis=0), *at.max(axis=0))
    tree = M.quadtree(points, box, len(at))
    assert tree.mass[0] == 600 and tree.mass[tree.children == 0].sum() == 600
    assert (tree.mass[tree.children == 0] <= 600 / 40).all() and tree.depth.max() > 8 and len(tree.mass) < 600
    push, _ = tree.push(at, box.codes(at))
    gap = at[:, None] - at[None]
    exact = (gap / (1 + (gap ** 2).sum(axis=2))[:, :, None] ** 2).sum(axis=1)
    assert np.abs(push - exact).max() < 0.05 * np.abs(exact).max()


def test_map_diverges_less_than_its_start(spark):
    from resonara.operators import neighbour_map as M

    rng = np.random.default_rng(4)
    df = written(frame(spark, np.vstack([rng.normal(c * 3, 1.0, (30, 8)) for c in range(3)])), "test-map")
    edges, start = written(M.affinity_edges(df, 8.0), "test-edges"), M.start_map(df)
    at = {r["item_id"]: (r["x"], r["y"]) for r in start.collect()}
    w = {(a, b): 1 / (1 + (at[a][0] - at[b][0]) ** 2 + (at[a][1] - at[b][1]) ** 2) for a in at for b in at if a != b}
    plain = sum(r["p"] * np.log(r["p"] * sum(w.values()) / w[r["a"], r["b"]]) for r in edges.where("p > 0").collect())
    before = M.map_divergence(edges, start)
    assert before == pytest.approx(plain, rel=0.01)
    assert M.map_divergence(edges, M.lay_out(edges, start, rounds=40)) < 0.8 * before
    one = df.where("item_id = 0")
    assert M.neighbour_map(one).count() == 1


def counted(spark, df):
    """The same rows, and an accumulator of how many of them were computed."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    return df.mapInPandas(count, df.schema), seen


def test_what_stands_behind_a_layout_or_a_map_is_computed_once(spark):
    from resonara.operators import neighbour_map as M
    from resonara.operators.project import radial_layout

    found, seen = counted(spark, spark.createDataFrame([(q, r) for q in range(50) for r in (1, 2, 3)], "query_id int, rank int").repartition(3))
    assert radial_layout(found).count() == 200 and seen.value == 150
    pairs, seen = counted(spark, spark.createDataFrame([(q, (q + r) % 20, 0.5) for q in range(20) for r in (1, 2)], "query_id int, item_id int, p double").repartition(3))
    assert M._symmetric(pairs).agg(F.sum("p")).first()[0] == pytest.approx(1.0) and seen.value == 40


def test_rounds_of_a_map_shuffle_no_edges(spark, monkeypatch):
    from resonara.operators import neighbour_map as M

    rng = np.random.default_rng(2)
    points = written(spark.createDataFrame([(n, *map(float, rng.normal(size=2))) for n in range(300)], "item_id long, x double, y double"), "test-points")
    edges = written(spark.createDataFrame([(a, int(b), 1.0 / 9000) for a in range(300) for b in rng.choice(300, 30, replace=False)],
                                          "a long, b long, p double").repartition(6, "a"), "test-edges")
    degrees = edges.groupBy(F.col("a").alias("item_id")).agg(F.count("*").alias("rows"))
    moved = []
    for held in (1000, 10):
        monkeypatch.setattr(M, "HELD_POINTS", held)
        before = local_files(spark)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
        rows = sorted(map(tuple, M._ends(edges, points, degrees, False, 300).collect()))
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        moved.append((rows, sum(size for path, size in local_files(spark).items() if path not in before)))
    assert moved[0][0] == moved[1][0] and len(moved[0][0]) == 9000
    assert moved[0][1] < 1e4 < moved[1][1]


def test_both_centroid_plans_measure_exactly(spark):
    """Far from the origin the expanded square would lose all digits."""
    points = spark.createDataFrame([(1, [1e8 + 0.5])], "item_id int, embedding array<double>")
    centres = spark.createDataFrame([(1, [1e8 + 0.25]), (2, [1e8 + 0.5])], "cluster int, embedding array<double>")
    for limit in (0, 1 << 20):
        row = C.nearest_centroid(points, centres, local_bytes=limit).first()
        assert (row["cluster"], row["centroid_distance_sq"]) == (2, 0.0)


def test_rows_without_vector_are_left_out(spark):
    df = spark.createDataFrame([(1, [0.0, 1.0], 0), (2, None, 0), (3, [4.0, 1.0], 1)], "item_id int, embedding array<double>, cluster int")
    for limit in (0, 1 << 20):
        placed = C.nearest_centroid(df.drop("cluster"), C.centroids(df), local_bytes=limit)
        assert sorted(row["item_id"] for row in placed.collect()) == [1, 3]
    assert C.assign_kmeans(df.drop("cluster"), C.fit_kmeans(df, 2)).count() == 2


def test_widening_passes_over_empty_clusters(spark):
    corpus = spark.createDataFrame([(n, [100.0 + n], 9) for n in range(20)], "item_id int, embedding array<double>, cluster int")
    centres = spark.createDataFrame([(c, [float(c)]) for c in range(9)] + [(9, [110.0])], "cluster int, embedding array<double>")
    query = spark.createDataFrame([("q", [0.0], 0)], "query_id string, embedding array<double>, cluster int")
    for limit in (0, 1 << 20):
        visits = C.cluster_visits(corpus, query, centres, 5, local_bytes=limit, among_items=False)
        assert [row["cluster"] for row in visits.collect()] == [9]
