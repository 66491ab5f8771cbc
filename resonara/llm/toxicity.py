"""Toxicity scores: gradient-boosted trees over dense text features, with isotonic calibration.

Features come from the text alone: densities of insult words (plain, and spelt
with digits, symbols or gaps), how close they stand to a second person, shares of
capitals, punctuation, digits and symbols, repeated letters and words, lengths.
Beside the built-in words stands a lexicon that Spark learns from the labelled
sample: words and pieces of words that stand in more toxic texts than clean ones,
weighted by shrunken log-odds.  It serves every language that has labels.

The sample is dealt into parts.  A row's lexicon features come from the other
parts, so the trees do not trust words that only their own rows made toxic, and the
isotonic regression that turns scores into probabilities is fitted on the scores
that trees of the other parts give.  Trees and lexicon of all parts score the texts.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

import numpy as np
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from resonara.llm.toxicity_features import (
    FEATURES, KNOWN_INSULTS, LEAST_WEIGHT, PARTS, Lexicon, feature_array, features, lexicon_words, term_counter,
)
from resonara.workspace import written

__all__ = ["FEATURES", "Lexicon", "ToxicityModel", "accepted", "features", "fit", "fold", "learn_lexicons", "sample_labels", "scored", "toxicity"]

THRESHOLD = 0.7
SAMPLE_ROWS = 30_000
FOLDS = 3
HELD_OUT = 1
SEED = 17

#: A term is learnt if so many toxic texts, and this share of them, hold it; the most frequent ones first, up to a bound.
LEAST_TEXTS, LEAST_SHARE, CANDIDATES = 3, 0.002, 100_000
#: Texts of average toxicity that are added to a term's own.
SHRINK = 10.0


def fold(key: Column) -> Column:
    """crc32 of the key as text, modulo ``FOLDS``; null keys count as empty text."""
    return F.pmod(F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), F.lit(FOLDS)).cast("int")


def _term_counts(rows: DataFrame, candidates: dict[str, int] | None = None) -> DataFrame:
    """``term``, ``part`` and in how many of the rows' texts it stands; only the ``candidates``, by number, if given."""
    counted = rows.select("text", "part").mapInArrow(term_counter(candidates), f"term {'int' if candidates else 'string'}, part int, texts long")
    return counted.groupBy("term", "part").agg(F.sum("texts").alias("texts"))


def learn_lexicons(drawn: DataFrame, sizes: dict[tuple[int, float], int]) -> list[dict[str, float]]:
    """Weights of terms, without each part in turn and last with all.

    ``drawn`` has ``text``, ``label`` and ``part``; ``sizes`` the rows by part and
    label.  Terms are counted once per text: first in toxic texts, where a term must
    stand often enough, then those terms in clean ones.  At most ``CANDIDATES`` terms
    come to the driver.  A weight is the log of the odds that a text with the term is
    toxic, over those of any text, ``SHRINK`` texts of average toxicity added.
    """
    toxic, clean = (sum(n for (_, label), n in sizes.items() if (label > 0.5) == wanted) for wanted in (True, False))
    if not toxic or not clean:
        return [{}] * (PARTS + 1)
    by_part = _term_counts(drawn.where("label > 0.5")).groupBy("term").pivot("part", list(range(PARTS))).agg(F.sum("texts")).na.fill(0)
    total = sum((F.col(str(part)) for part in range(1, PARTS)), F.col("0"))
    rows = (by_part.where(total >= max(LEAST_TEXTS, LEAST_SHARE * toxic)).orderBy(total.desc(), "term").limit(CANDIDATES).toArrow())
    terms = rows["term"].to_pylist()
    if not terms:
        return [{}] * (PARTS + 1)
    held = np.zeros((2, PARTS, len(terms)))
    held[1] = [rows[str(part)].to_numpy() for part in range(PARTS)]
    counted = _term_counts(drawn.where("label <= 0.5"), {term: n for n, term in enumerate(terms)}).toArrow()
    held[0, counted["part"].to_numpy(), counted["term"].to_numpy()] = counted["texts"].to_numpy()
    lexicons = []
    for part in range(PARTS + 1):
        others = [of for of in range(PARTS) if of != part]
        share = sum(sizes.get((of, 1.0), 0) for of in others) / max(sum(sizes.get((of, label), 0) for of in others for label in (0.0, 1.0)), 1)
        if not 0 < share < 1:
            lexicons.append({})
            continue
        here = held[:, others].sum(axis=1)
        weights = np.log((here[1] + SHRINK * share) / (here[0] + SHRINK * (1 - share))) - np.log(share / (1 - share))
        lexicons.append({terms[n]: float(weights[n]) for n in np.flatnonzero(weights >= LEAST_WEIGHT)})
    return lexicons


@dataclass
class ToxicityModel:
    """``trees`` and ``calibration`` are None where the labels do not hold both classes; ``base`` is then the score."""

    trees: GBTClassificationModel | None
    calibration: IsotonicRegressionModel | None
    base: float
    insults: frozenset[str] = KNOWN_INSULTS
    lexicon: dict[str, float] = field(default_factory=dict)

    def score(self, rows: DataFrame) -> DataFrame:
        """Add ``score``, a probability, to rows with ``text``."""
        if self.trees is None:
            return rows.withColumn("score", F.lit(self.base))
        rows = rows.withColumn("features", feature_array(self.insults, [self.lexicon])("text", F.lit(0)))
        raw = self.trees.transform(rows.withColumn("input", array_to_vector("features")))
        margin = raw.withColumn("margin", vector_to_array("rawPrediction")[1])
        kept = [*[name for name in rows.columns if name != "features"], "margin", "score"]
        found = self.calibration.setFeaturesCol("margin").setPredictionCol("score").transform(margin)
        # the margin, squeezed, orders rows that share a calibrated step
        tie = (F.lit(1.0) / (F.lit(1.0) + F.exp(-F.col("margin"))) - 0.5) * 1e-6
        return found.select(*kept).withColumn("score", F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("score") + tie))).drop("margin")


def sample_labels(marks: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """About ``sample_rows`` of the rows ``id, label`` at most, drawn by a hash of the id.

    This is the documented bound on what a fit reads.  Repeated rows count once;
    null ids and labels are left out.
    """
    known = marks.select("id", F.col("label").cast("double").alias("label")).dropna().distinct()
    share = min(1.0, sample_rows / max(known.count(), 1))
    return known.where(F.pmod(F.xxhash64(F.lit(SEED), "id"), F.lit(1_000_000)) < F.lit(int(share * 1_000_000)))


def fit(drawn: DataFrame, trees: int = 12, depth: int = 3) -> ToxicityModel:
    """Learn from columns ``key``, ``text``, ``label``, a sample of bounded size.

    Rows of either class are dealt evenly into ``PARTS`` by a hash of their key.
    Calibration uses scores from trees that have not seen the row, at every size.
    Starts Spark jobs.
    """
    dealt = F.row_number().over(W.partitionBy("label").orderBy(F.xxhash64(F.lit(SEED + 1), "key"), "key", "text"))
    drawn = written(drawn.withColumn("part", F.pmod(dealt, F.lit(PARTS)).cast("int")).repartition(drawn.sparkSession.sparkContext.defaultParallelism),
                    "drawn")
    # words of the lexicon that mostly stand in clean texts of this corpus are ordinary words of it
    usual = (drawn.select("label", F.explode(lexicon_words("text")).alias("word")).groupBy("word")
             .agg(F.avg("label").alias("share"), F.sum(1 - F.col("label")).alias("clean")).where("clean >= 2 and share < 0.5").collect())
    insults = KNOWN_INSULTS - {row["word"] for row in usual}
    sizes = {(row["part"], row["label"]): row["n"] for row in drawn.groupBy("part", "label").agg(F.count("*").alias("n")).collect()}
    toxic = sum(n for (_, label), n in sizes.items() if label > 0.5)
    base = toxic / max(sum(sizes.values()), 1)
    if base in (0, 1):
        return ToxicityModel(None, None, base, insults)
    lexicons = learn_lexicons(drawn, sizes)
    rows = written(drawn.select("part", "label", feature_array(insults, lexicons)("text", "part").alias("features")), "features")
    rows = rows.withColumn("input", array_to_vector("features")).coalesce(8)
    learner = GBTClassifier(featuresCol="input", labelCol="label", maxIter=trees, maxDepth=depth, stepSize=0.3,
                            minInstancesPerNode=2, subsamplingRate=1.0, seed=SEED, cacheNodeIds=False)
    unseen = [learner.fit(rows.where(F.col("part") != part)).transform(rows.where(F.col("part") == part)) for part in range(PARTS)]
    margins = reduce(DataFrame.unionByName, unseen).select("label", vector_to_array("rawPrediction")[1].alias("margin"))
    calibration = IsotonicRegression(featuresCol="margin", labelCol="label", predictionCol="score").fit(margins)
    return ToxicityModel(learner.fit(rows), calibration, base, insults, lexicons[-1])


def scored(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Columns ``id``, ``score``, ``text`` and the others of ``docs`` in the struct ``row``; see ``toxicity``."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.struct(*[c for c in docs.columns if c != text_col]).alias("row"))
    marks = labels.select(F.col(id_col).alias("id"), F.col(label_col).alias("label")).where(fold(F.col("id")) != HELD_OUT)
    # the sample is bounded, so it travels to the texts and no text is shuffled
    drawn = rows.select("id", "text").join(F.broadcast(sample_labels(marks, sample_rows)), "id")
    return fit(drawn.withColumnRenamed("id", "key")).score(rows)


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
             sample_rows: int = SAMPLE_ROWS, threshold: float = THRESHOLD) -> DataFrame:
    """Score every row: ``id``, ``held_out``, ``score``, ``predicted``.

    Only labels of rows outside the held-out fold are learnt from.  Empty and null
    texts are scored by the same model.  Ids that occur more than once in
    ``labels`` count with each label; other columns are not read.
    """
    found = scored(docs.select(id_col, text_col), labels, id_col, text_col, label_col, sample_rows)
    return found.select("id", (fold(F.col("id")) == HELD_OUT).alias("held_out"), "score",
                        (F.col("score") >= threshold).cast("int").alias("predicted"))


def accepted(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
             threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` whose score stays below the threshold."""
    found = scored(docs, labels, id_col, text_col, label_col).where(F.col("score") < threshold)
    return found.select(*[F.col("text").alias(text_col) if c == text_col else F.col("row").getField(c).alias(c) for c in docs.columns])
