"""Several embedding models of the same items."""

from __future__ import annotations

from pyspark.sql import functions as F

from registry.common import as_queries, items, rounded
from resonara.operators import spaces as S
from resonara.operators.neighbours import knn
from resonara.workspace import new_folder

K = 5
HALF = 32


def _models(spark, sf):
    """Two models of each item: the whole vector, and for most items its first half with each value squared."""
    base = items(spark, sf).select("item_id", F.col("embedding").cast("array<double>").alias("embedding"))
    squares = F.transform(F.slice("embedding", 1, HALF), lambda x: x * x)
    return base.withColumn("model", F.lit("whole")).unionByName(
        base.where("item_id % 9 <> 0").select("item_id", squares.alias("embedding")).withColumn("model", F.lit("squares")))


def _stored(spark, sf):
    path = new_folder(spark, "models")
    S.write_models(_models(spark, sf), path)
    return path


def model_neighbours(spark, sf):
    """The nearest items by the model that the caller names."""
    base = S.read_model(spark, _stored(spark, sf), "squares")
    found = knn(base, as_queries(base), K)
    return found.select("query_id", "item_id", "rank", rounded("distance_sq").alias("distance_sq"))


def model_agreement(spark, sf):
    path = _stored(spark, sf)
    found = S.neighbourhood_agreement(S.read_model(spark, path, "whole"), S.read_model(spark, path, "squares"), K)
    return found.select("item_id", "shared", rounded("overlap").alias("overlap"), rounded("rank_biased").alias("rank_biased"))


def model_likeness(spark, sf):
    models = _models(spark, sf)
    found = S.linear_cka(S.select_model(models, "whole"), S.select_model(models, "squares"))
    return found.select("items", rounded("cka").alias("cka"))


QUERIES = {f.__name__: f for f in (model_neighbours, model_agreement, model_likeness)}

_MODELS = f"""
whole as (select vec_id as item_id, embedding::double[] as e from embeddings),
squares as (select item_id, list_transform(e[1:{HALF}], lambda x: x * x) as e from whole where item_id % 9 <> 0)"""


def _near(name: str, source: str) -> str:
    return f"""{name} as (
  select q.item_id as query_id, c.item_id, list_distance(q.e, c.e) as d,
    row_number() over (partition by q.item_id order by list_distance(q.e, c.e), c.item_id) as rank
  from {source} q join {source} c on q.item_id <> c.item_id qualify rank <= {K})"""


_P = S.PERSISTENCE
SQL = {
    "model_neighbours": f"""
with {_MODELS}, {_near("near", "squares")}
select query_id, item_id, rank::int as rank, round(power(d, 2), 6) as distance_sq from near""",
    "model_agreement": f"""
with {_MODELS}, common as (select * from whole where item_id in (select item_id from squares)),
{_near("a", "common")}, {_near("b", "squares")},
depths as (select unnest(range(1, {K} + 1)) as depth),
shared as (select query_id, greatest(a.rank, b.rank) as rank from a join b using (query_id, item_id)),
per_depth as (select c.item_id, depth, count(s.rank) as n from common c cross join depths left join shared s on s.query_id = c.item_id and s.rank <= depth
  group by all)
select item_id, max(n) as shared, round(max(n) / {K}, 6) as overlap,
  round(sum(n / depth * power({_P}, depth - 1)) * (1 - {_P}) / (1 - power({_P}, {K})), 6) as rank_biased
from per_depth group by item_id""",
    "model_likeness": f"""
with {_MODELS}, common as (select w.item_id, w.e || s.e as e from whole w join squares s using (item_id)),
cells as (select item_id, unnest(range(len(e))) as dim, unnest(e) as value from common),
centred as (select item_id, dim, value - avg(value) over (partition by dim) as value from cells),
sums as (select a.dim as i, b.dim as j, sum(a.value * b.value) as s from centred a join centred b using (item_id) group by all)
select (select count(*) from common) as items, round(
  sum(s * s) filter (i < 64 and j >= 64) / sqrt(sum(s * s) filter (i < 64 and j < 64) * sum(s * s) filter (i >= 64 and j >= 64)), 6) as cka from sums""",
}
