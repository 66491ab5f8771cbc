"""A two-dimensional map that keeps neighbours together.

The attraction between items comes from their nearest-neighbour graph with
per-item perplexity, the repulsion from the cells of a quadtree that Spark builds
each round by grouped sums over Morton codes, and that points open by angle.  Each
round is a join over graph edges plus a pass over the points; nothing compares all
pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from resonara.operators.lookup import keyed_lookup
from resonara.operators.neighbours import knn, present
from resonara.operators.project import fit_pca, project, to_xy
from resonara.workspace import replaced, written

# --- fixed values -----------------------------------------------------------
PERPLEXITY = 30.0
# ----------------------------------------------------------------------------

DEPTH = 26  # levels of the quadtree at most
TREE_POINTS, LEAVES = 16_384, 4096
ANGLE = 0.5  # a cell counts as one point if its side is below this share of its distance
START_SPREAD = 1.0
EXAGGERATION = 4.0
STALLED, SETTLING = 0.05, 20
HUB_EDGES = 1_000_000
HELD_POINTS = 1_000_000  # places of so many points are sent to every executor, 24 bytes each


def _match_perplexity(squares: np.ndarray, perplexity: float) -> np.ndarray:
    """Row of probabilities whose entropy is log(perplexity), by bisection."""
    wanted = np.log(min(perplexity, len(squares)))
    shifted = squares - squares.min()
    low, high, beta = 0.0, np.inf, 1.0 / max(shifted.mean(), 1e-12)
    weights = np.ones(len(squares))
    for _ in range(64):
        weights = np.exp(-shifted * beta)
        total = weights.sum()
        entropy = np.log(total) + beta * (shifted * weights).sum() / total
        if abs(entropy - wanted) < 1e-7:
            break
        if entropy > wanted:
            low = beta
            beta = beta * 2.0 if np.isinf(high) else (beta + high) / 2.0
        else:
            high = beta
            beta = (beta + low) / 2.0
    return weights / weights.sum()


def perplexity_affinity(neighbours: DataFrame, perplexity: float = PERPLEXITY) -> DataFrame:
    """``query_id, item_id, p``: affinities summing to 1 per query.

    ``neighbours`` is a ``knn`` result with about three times the perplexity as k.
    """
    row = F.array_sort(F.collect_list(F.struct("distance_sq", "item_id")))  # k entries
    listed = neighbours.groupBy("query_id").agg(row.alias("row")).select(
        "query_id", F.col("row.item_id").alias("ids"), F.col("row.distance_sq").alias("squares"))

    @F.pandas_udf("array<double>")
    def affinities(squares: pd.Series) -> pd.Series:
        return pd.Series([_match_perplexity(np.asarray(s, dtype=np.float64), perplexity) for s in squares])

    return listed.select("query_id", F.inline(F.arrays_zip(F.col("ids").alias("item_id"),
                                                           affinities("squares").alias("p"))))


def _symmetric(affinity: DataFrame) -> DataFrame:
    """``a, b, p``: both directions averaged, over all pairs summing to 1."""
    affinity = written(affinity, "affinities")  # read three times, and a search stands behind it
    n = affinity.select("query_id").distinct().count()
    there = affinity.select(F.col("query_id").alias("a"), F.col("item_id").alias("b"), "p")
    back = affinity.select(F.col("item_id").alias("a"), F.col("query_id").alias("b"), "p")
    return there.unionByName(back).groupBy("a", "b").agg((F.sum("p") / (2.0 * n)).alias("p"))


def _bits_apart(values: np.ndarray) -> np.ndarray:
    """Whole numbers below 2 ** DEPTH with a free bit before each of theirs."""
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
        values = (values | values << shift) & mask
    return values


def _spans(first: np.ndarray, number: np.ndarray) -> np.ndarray:
    """All places of several runs, run after run."""
    starts = np.cumsum(number) - number
    return np.repeat(first - starts, number) + np.arange(number.sum())


@dataclass
class _Box:
    """The square that is cut; points outside count to the outermost cells."""

    x: float
    y: float
    side: float

    @classmethod
    def around(cls, low_x: float, low_y: float, high_x: float, high_y: float) -> _Box:
        return cls(low_x, low_y, max(high_x - low_x, high_y - low_y, 1e-12) * (1 + 1e-9))

    def codes(self, at: np.ndarray) -> np.ndarray:
        """Morton code of each point: its cell at ``DEPTH``; two bits less name the cell around it."""
        steps = np.floor((at - [self.x, self.y]) / self.side * 2 ** DEPTH).clip(0, 2 ** DEPTH - 1).astype(np.int64)
        return _bits_apart(steps[:, 0]) << 1 | _bits_apart(steps[:, 1])


class Quadtree:
    """Mass and centre of nested square cells, linked from the cells at the fringe.

    ``fringe`` has ``depth, code, mass, x, y`` (sums of the coordinates) of cells
    that cover all points once.  A cell of at most ``capacity`` points is not opened.
    """

    def __init__(self, box: _Box, fringe: pd.DataFrame, capacity: float):
        self.box = box
        levels = {depth: rows[["code", "mass", "x", "y"]] for depth, rows in fringe.groupby("depth")}
        for depth in range(max(levels), 0, -1):
            above = levels[depth].assign(code=levels[depth]["code"].to_numpy() >> 2).groupby("code", as_index=False).sum()
            levels[depth - 1] = pd.concat([levels[depth - 1], above]) if depth - 1 in levels else above
        ordered = [levels[depth].sort_values("code", ignore_index=True).assign(depth=depth) for depth in sorted(levels)]
        starts = np.cumsum([0, *map(len, ordered)])
        rows = pd.concat(ordered, ignore_index=True)
        self.code, self.depth, self.mass = rows["code"].to_numpy(), rows["depth"].to_numpy(), rows["mass"].to_numpy(dtype=np.float64)
        self.centre = rows[["x", "y"]].to_numpy() / self.mass[:, None]
        self.size = box.side / 2.0 ** self.depth
        self.first, self.children = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
        for depth, (level, start) in enumerate(zip(ordered[1:], starts[1:]), 1):
            parents, first, number = np.unique(level["code"].to_numpy() >> 2, return_index=True, return_counts=True)
            at = starts[depth - 1] + np.searchsorted(ordered[depth - 1]["code"].to_numpy(), parents)
            self.first[at], self.children[at] = start + first, number
        self.children[self.mass <= capacity] = 0
        self._drop_unreached()

    def _drop_unreached(self) -> None:
        """Leave out the cells below those that are not opened."""
        reached = np.zeros(len(self.code), bool)
        front = np.zeros(1, np.int64)
        while len(front):
            reached[front] = True
            front = _spans(self.first[front], self.children[front])
        place = np.cumsum(reached) - 1
        self.first = place[self.first]
        for name in ("code", "depth", "mass", "centre", "size", "first", "children"):
            setattr(self, name, getattr(self, name)[reached])

    def push(self, at: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each point the push of all others, not normalised, and its sum of the kernel.

        A cell is taken whole where it is small for its distance or is not opened;
        the point itself is left out of its own.
        """
        forces, kernel = np.zeros((len(at), 2)), np.zeros(len(at))
        who, node = np.arange(len(at)), np.zeros(len(at), np.int64)
        while len(who):
            gap = at[who] - self.centre[node]
            away = (gap ** 2).sum(axis=1)
            leaf = self.children[node] == 0
            whole = leaf | (self.size[node] ** 2 < ANGLE ** 2 * away)
            own = leaf & (codes[who] >> 2 * (DEPTH - self.depth[node]) == self.code[node])
            weight = np.where(whole, (self.mass[node] - own) / (1.0 + away), 0.0)
            kernel += np.bincount(who, weight, len(at))
            for axis in (0, 1):
                forces[:, axis] += np.bincount(who, weight / (1.0 + away) * gap[:, axis], len(at))
            open_who, open_node = who[~whole], node[~whole]
            who, node = np.repeat(open_who, self.children[open_node]), _spans(self.first[open_node], self.children[open_node])
        return forces, kernel

    def normaliser(self) -> float:
        """The sum of the kernel over all pairs of points, unopened cell by unopened cell."""
        leaves = np.flatnonzero(self.children == 0)
        codes = self.code[leaves] << 2 * (DEPTH - self.depth[leaves])
        return max(float(sum((self.mass[part] * self.push(self.centre[part], own)[1]).sum() for part, own in (
            (leaves[start:start + 2048], codes[start:start + 2048]) for start in range(0, len(leaves), 2048)))), 1e-12)


# The round's numbers (box, tree, normaliser) live in the Python functions and
# not in Spark expressions, so that every round runs the same compiled code.

def _cells(points: DataFrame, box: _Box, depth: int, inside: np.ndarray | None, above: int) -> pd.DataFrame:
    """``code, mass, x, y`` of the cells at ``depth``, or of those in the cells ``inside`` at depth ``above``.

    Each task sums up its own points first.
    """
    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            codes = box.codes(batch[["x", "y"]].to_numpy())
            if inside is not None:
                wanted = np.isin(codes >> 2 * (DEPTH - above), inside)
                batch, codes = batch[wanted], codes[wanted]
            if len(batch):
                yield batch.assign(code=codes >> 2 * (DEPTH - depth), mass=1).groupby("code", as_index=False)[["mass", "x", "y"]].sum()

    parts = points.select("x", "y").mapInPandas(partial, "code long, mass long, x double, y double")
    return parts.groupBy("code").agg(F.sum("mass").alias("mass"), F.sum("x").alias("x"), F.sum("y").alias("y")).toPandas()


def quadtree(points: DataFrame, box: _Box, n: int) -> Quadtree:
    """The tree over ``x, y``, built by grouped sums.

    Up to ``TREE_POINTS`` points every one is resolved.  More are cut level by level
    where cells are crowded; at most ``LEAVES`` cells can be, each into 64, so what
    reaches the driver does not grow with the points.
    """
    if n <= TREE_POINTS:
        return Quadtree(box, _cells(points, box, DEPTH, None, 0).assign(depth=DEPTH), 1)
    capacity, depth, crowded, fringe = n / LEAVES, 5, None, []
    while True:
        found = _cells(points, box, depth, crowded, depth - 3)
        heavy = found["mass"] > capacity if depth + 3 <= DEPTH else found["mass"] < 0
        fringe.append(found[~heavy].assign(depth=depth))
        if not heavy.any():
            return Quadtree(box, pd.concat(fringe), capacity)
        crowded, depth = found["code"].to_numpy()[heavy], depth + 3


def _step(tree: Quadtree, normaliser: float, n: int, factor: float, rate: float, momentum: float):
    """Function that moves points by the pull of their neighbours and the push of the tree.

    Each coordinate has a gain that grows while its gradient keeps its direction and
    falls when it turns.
    """
    def step(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            at = batch[["x", "y"]].to_numpy()
            push = np.concatenate([np.zeros((0, 2)), *(tree.push(at[start:start + 1024], tree.box.codes(at[start:start + 1024]))[0]
                                                       for start in range(0, len(at), 1024))])
            gradient = 4.0 * (factor * batch[["px", "py"]].fillna(0.0).to_numpy() - push / normaliser)
            speed, gains = batch[["vx", "vy"]].to_numpy(), batch[["gx", "gy"]].to_numpy()
            gains = np.where(np.sign(gradient) != np.sign(speed), gains + 0.2, gains * 0.8).clip(0.01, None)
            speed = momentum * speed - rate * gains * gradient
            at = at + speed
            yield pd.DataFrame({"item_id": batch["item_id"], "x": at[:, 0], "y": at[:, 1], "vx": speed[:, 0], "vy": speed[:, 1],
                                "gx": gains[:, 0], "gy": gains[:, 1], "steep": np.square(gradient).sum(axis=1)})

    return step


def _ends(edges: DataFrame, points: DataFrame, degrees: DataFrame, hubs: bool, n: int) -> DataFrame:
    """Edges with the coordinates of both ends.

    Up to ``HELD_POINTS`` points go to the edges, so that no edge is shuffled.  Of more, the
    edges go to the points; where an item is an end of very many edges, by a lookup that splits it.
    """
    for end in ("a", "b"):
        place = points.select(F.col("item_id").alias(end), F.col("x").alias(f"{end}x"), F.col("y").alias(f"{end}y"))
        if n <= HELD_POINTS:
            edges = edges.join(F.broadcast(place), end)
        elif hubs:
            edges = keyed_lookup(edges, place.join(degrees.withColumnRenamed("item_id", end), end), [end], "rows").drop("rows")
        else:
            edges = edges.join(place, end)
    return edges


def map_divergence(edges: DataFrame, points: DataFrame) -> float:
    """Kullback-Leibler divergence of the map from the affinities ``a, b, p``, which sum to 1."""
    low_x, low_y, high_x, high_y, n = points.agg(F.min("x"), F.min("y"), F.max("x"), F.max("y"), F.count("*")).first()
    normaliser = quadtree(points, _Box.around(low_x, low_y, high_x, high_y), n).normaliser()
    degrees = edges.groupBy(F.col("a").alias("item_id")).agg(F.count("*").alias("rows"))
    ends = _ends(edges, points.select("item_id", "x", "y"), degrees, False, n)
    kernel = 1.0 / (1.0 + (F.col("ax") - F.col("bx")) ** 2 + (F.col("ay") - F.col("by")) ** 2)
    return ends.where("p > 0").agg(F.sum(F.col("p") * F.log(F.col("p") * F.lit(normaliser) / kernel))).first()[0]


def affinity_edges(items: DataFrame, perplexity: float = PERPLEXITY) -> DataFrame:
    """``a, b, p`` of the nearest-neighbour graph of ``item_id, embedding``, both directions, summing to 1.

    To be stored: edges of one ``a`` lie together, so that sums over them are made where they are read.
    """
    n = items.count()
    k = int(max(1, min(n - 1, 3 * perplexity)))
    near = knn(items, items.withColumnRenamed("item_id", "query_id"), k)
    return _symmetric(perplexity_affinity(near, min(perplexity, max(k / 3.0, 1.0)))).hint("rebalance", "a")


def start_map(items: DataFrame) -> DataFrame:
    """``item_id, x, y``: two principal components, scaled to a small spread."""
    start = to_xy(project(items, fit_pca(items, 2))).select("item_id", "x", "y")
    scale = START_SPREAD / (start.agg(F.stddev_pop("x")).first()[0] or 1.0)
    return start.select("item_id", *[(F.col(c) * scale).alias(c) for c in ("x", "y")])


def lay_out(edges: DataFrame, start: DataFrame, *, rounds: int = 100) -> DataFrame:
    """``item_id, x, y`` from stored affinities ``a, b, p`` and a start.

    The first quarter of the rounds exaggerates the attraction; when it ends, the
    gradient leaps up.  Ends early when, ``SETTLING`` rounds later or more, it is below
    the share ``STALLED`` of its largest size since.
    Every round is written in place of the one before, so a lost executor costs one
    round at most.
    """
    zeros = [F.lit(0.0).alias(c) for c in ("vx", "vy")] + [F.lit(1.0).alias(c) for c in ("gx", "gy")] + [F.lit(0.0).alias("steep")]
    points = written(start.select("item_id", F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y"), *zeros), "map-round")
    degrees = written(edges.groupBy(F.col("a").alias("item_id")).agg(F.count("*").alias("rows")), "degrees")
    hubs = (degrees.agg(F.max("rows")).first()[0] or 0) > HUB_EDGES
    span = [F.min("x"), F.min("y"), F.max("x"), F.max("y"), F.count("*"), F.sqrt(F.sum("steep"))]
    *corners, n, _ = points.agg(*span).first()
    exaggerated, largest = rounds // 4, 0.0
    for turn in range(rounds if n > 1 else 0):
        early = turn < exaggerated
        tree = quadtree(points, _Box.around(*corners), n)
        dx, dy = F.col("ax") - F.col("bx"), F.col("ay") - F.col("by")
        pull = F.col("p") / (1.0 + dx * dx + dy * dy)
        pulled = _ends(edges, points, degrees, hubs, n).groupBy(F.col("a").alias("item_id")).agg(F.sum(pull * dx).alias("px"), F.sum(pull * dy).alias("py"))
        step = _step(tree, tree.normaliser(), n, EXAGGERATION if early else 1.0, max(n / EXAGGERATION, 50.0), 0.5 if early else 0.8)
        points = replaced(points.join(pulled, "item_id", "left").mapInPandas(step, points.schema), "map-round", points)
        *corners, _, steep = points.agg(*span).first()
        if not early:
            largest = max(largest, steep)
            if turn >= exaggerated + SETTLING and steep < STALLED * largest:
                break
    return points.select("item_id", "x", "y")


def neighbour_map(items: DataFrame, *, item_id: str = "item_id", vector: str = "embedding",
                  perplexity: float = PERPLEXITY, rounds: int = 100) -> DataFrame:
    """``item_id, x, y``.  Starts from two principal components, see ``lay_out``.
    Items without a vector are left out; ids are unique."""
    items = written(present(items, vector).select(F.col(item_id).alias("item_id"), F.col(vector).alias("embedding")), "map-items")
    edges = written(affinity_edges(items, perplexity), "map-edges")
    return lay_out(edges, start_map(items), rounds=rounds).withColumnRenamed("item_id", item_id)
