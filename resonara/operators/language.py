"""Language probability of texts from character-trigram profiles.

Texts are reduced to word counts first.  Trigrams are cut from distinct words
only, so the large tables hold words, not characters, and a word frequent in
every text is counted before it is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from resonara.operators.lookup import keyed_lookup
from resonara.workspace import written

# --- fixed values -----------------------------------------------------------
KEEP_ABOVE = 0.5
# ----------------------------------------------------------------------------

GRAM = 3
MAX_LANGUAGES = 256  # languages become columns


def words(df: DataFrame, key: list[str], text: str) -> DataFrame:
    """``key, word``: lower-case runs of letters of the whole text."""
    runs = F.split(F.lower(F.col(text)), r"[^\p{L}]+")
    return df.select(*key, F.explode(runs).alias("word")).where("word <> ''")


def _trigrams(word: Column) -> Column:
    padded = F.concat(F.lit(" "), word, F.lit(" "))
    return F.transform(F.sequence(F.lit(1), F.length(word)), lambda i: F.substring(padded, i, F.lit(GRAM)))


def profiles(labelled: DataFrame, lang: str = "lang", text: str = "text") -> DataFrame:
    """``lang, gram, n``: trigram counts of the labelled texts."""
    counted = words(labelled.where(F.col(lang).isNotNull()), [lang], text).groupBy(lang, "word").agg(
        F.count("*").alias("_n"))
    grams = counted.select(F.col(lang).alias("lang"), "_n", F.explode(_trigrams(F.col("word"))).alias("gram"))
    return grams.groupBy("lang", "gram").agg(F.sum("_n").alias("n"))


def _word_scores(vocabulary: DataFrame, profile: DataFrame) -> tuple[DataFrame, list[str]]:
    """``word``, its ``texts`` and its log-likelihood in every language."""
    totals = {r["lang"]: r["n"] for r in
              profile.groupBy("lang").agg(F.sum("n").alias("n")).orderBy("lang").limit(MAX_LANGUAGES + 1).collect()}
    if len(totals) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    langs = list(totals)
    distinct = profile.select("gram").distinct().count()
    wide = profile.groupBy("gram").pivot("lang", langs).agg(F.first("n"))
    seen = wide.select("gram", F.array(*[
        F.log((F.coalesce(F.col(f"`{lang}`"), F.lit(0)) + 1.0) / float(totals[lang] + distinct)) for lang in langs
    ]).alias("logs"))
    unseen = F.array(*[F.log(F.lit(1.0 / float(totals[lang] + distinct))) for lang in langs])
    cut = vocabulary.select("word", "texts", F.explode(_trigrams(F.col("word"))).alias("gram"))
    logs = cut.join(seen, "gram", "left").withColumn("logs", F.coalesce("logs", unseen))
    sums = logs.groupBy("word", "texts").agg(*[F.sum(F.col("logs")[i]).alias(f"s{i}") for i in range(len(langs))])
    return sums, langs


def lang_prob(df: DataFrame, profile: DataFrame, key: str, text: str = "text") -> DataFrame:
    """``key, lang, prob`` for every language; texts without letters have none."""
    # read for the vocabulary and for the sums: stored, so the texts are split once
    counted = written(words(df, [key], text).groupBy(key, "word").agg(F.count("*").alias("_n")), "text-words")
    scores, langs = _word_scores(counted.groupBy("word").agg(F.count("*").alias("texts")), profile)
    slots = [f"s{i}" for i in range(len(langs))]
    # a common word stands in nearly every text
    per_text = keyed_lookup(counted, written(scores, "word-scores"), ["word"], "texts").groupBy(key).agg(
        *[F.sum(F.col(s) * F.col("_n")).alias(s) for s in slots])
    top = F.greatest(*slots) if len(slots) > 1 else F.col(slots[0])
    weights = [F.exp(F.col(s) - top) for s in slots]
    total = sum(weights[1:], weights[0])
    rows = F.array(*[F.struct(F.lit(lang).alias("lang"), (w / total).alias("prob")) for lang, w in zip(langs, weights)])
    return per_text.select(key, F.inline(rows))


def lang_filter(df: DataFrame, profile: DataFrame, target: str, key: str, text: str = "text",
                keep_above: float = KEEP_ABOVE) -> DataFrame:
    """``df`` with ``prob`` of the target language and ``kept``; a text without
    letters has probability 0."""
    probs = lang_prob(df.select(key, text), profile, key, text).where(F.col("lang") == target).select(key, "prob")
    marked = df.join(probs, key, "left").withColumn("prob", F.coalesce("prob", F.lit(0.0)))
    return marked.withColumn("kept", F.col("prob") > keep_above)
