"""Catalogue joins, counts and row checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from resonara.functions.text import blank_to_null, sanitize_name, strip
from resonara.workspace import written

# --- fixed values -----------------------------------------------------------
NOT_AVAILABLE = "N/A"
# ----------------------------------------------------------------------------

GRAM = 4


def keep_one(df: DataFrame, key: str, order: str, last: bool = True) -> DataFrame:
    """First or last row per key by an explicit order column.

    An aggregate, not a window: duplicates collapse before the shuffle.
    """
    others = [c for c in df.columns if c != key]
    whole = F.struct(order, *[c for c in others if c != order])
    pick = F.max(whole) if last else F.min(whole)
    one = df.where(F.col(key).isNotNull()).groupBy(key).agg(pick.alias("_row"))
    return one.select(*[F.col(key) if c == key else F.col(f"_row.{c}").alias(c) for c in df.columns])


def join_metadata(items: DataFrame, metadata: DataFrame, key: str, suffix: str = "_original") -> DataFrame:
    """Left join; metadata columns that clash with item columns get a suffix."""
    clash = {c: f"{c}{suffix}" for c in metadata.columns if c != key and c in items.columns}
    return items.join(metadata.withColumnsRenamed(clash), key, "left")


def join_files(files: DataFrame, metadata: DataFrame, key: str, order: str) -> DataFrame:
    """Files with metadata.  The last metadata row of an id wins; files without
    metadata are skipped."""
    return files.join(keep_one(metadata, key, order, last=True), key)


def ids_seen(*tables: DataFrame, key: str) -> DataFrame:
    """Distinct ids over all tables."""
    out = tables[0].select(key)
    for table in tables[1:]:
        out = out.unionByName(table.select(key))
    return out.where(F.col(key).isNotNull()).distinct()


def _grams(text: Column, width: int) -> Column:
    """All distinct pieces of a width; the whole text where it is shorter."""
    starts = F.sequence(F.lit(1), F.length(text) - (width - 1))
    cuts = F.array_distinct(F.transform(starts, lambda at: F.substring(text, at, F.lit(width))))
    return F.when(F.length(text) > width, cuts).otherwise(F.array(text))


def contains_join(files: DataFrame, metadata: DataFrame, name: str, key: str, order: str, width: int = GRAM) -> DataFrame:
    """Files joined to the first metadata id, by ``order``, occurring anywhere in their name.

    An id is indexed by one of its grams, the one that fewest names hold; an id with
    a gram that no name holds occurs nowhere.  Names look up their grams, and only
    the ids found so are compared.  A name is cut into grams of one width, however
    many lengths the ids have, and besides into the lengths of ids shorter than that.
    Ids of no length match nothing.  The first hit is found over (id, order) alone;
    its columns are joined last.
    """
    ids = written(metadata.where(F.length(key) > 0).groupBy(F.col(key).alias("_id")).agg(F.min(order).alias("_first")), "ids")
    short = [row["n"] for row in ids.select(F.length("_id").alias("n")).where(F.col("n") < width).distinct().collect()]  # below the width
    names = files.select(F.col(name).alias("_name")).where("_name is not null").distinct()
    cut = F.concat(*[F.when(F.length("_name") >= n, _grams(F.col("_name"), n)).otherwise(F.array().cast("array<string>")) for n in (*sorted(short), width)])
    held = written(names.select("_name", F.explode(cut).alias("gram")), "name-grams")
    counts = held.groupBy("gram").agg(F.count("*").alias("names"))
    # an id keeps its rarest gram if names hold all of them
    own = ids.select("_id", "_first", _grams(F.col("_id"), width).alias("grams"))
    indexed = (own.select("_id", "_first", F.size("grams").alias("size"), F.explode("grams").alias("gram")).join(counts, "gram")
               .groupBy("_id", "_first", "size").agg(F.count("*").alias("known"), F.min(F.struct("names", "gram")).alias("rarest"))
               .where("known = size").select("_id", "_first", F.col("rarest.gram").alias("gram")))
    best = (held.join(indexed, "gram").where(F.contains("_name", "_id")).groupBy("_name")
            .agg(F.min_by("_id", F.struct("_first", "_id")).alias(key)).withColumnRenamed("_name", name))
    return best.join(keep_one(metadata, key, order, last=False), key).select(name, key, *[c for c in metadata.columns if c != key])


def rename_plan(files: DataFrame, name: str, file_id: str, channel: str, title: str) -> DataFrame:
    """``file, new name, action`` for files already joined to their metadata.

    ``keep``: already right.  ``skip``: the new name exists, or an earlier file
    takes it.  ``rename``: otherwise.  The winner per new name is a grouped
    minimum, so one name shared by many files is no hot task.
    """
    ext = F.regexp_extract(name, r"(\.[^.]*)$", 1)
    target = F.concat(sanitize_name(F.col(channel)), F.lit("-"), sanitize_name(F.col(title)), ext)
    planned = files.select(F.col(name).alias("file_name"), F.col(file_id).alias("file_id"),
                           target.alias("new_name"))
    winners = planned.groupBy("new_name").agg(F.min("file_id").alias("_first"))
    existing = planned.select(F.col("file_name").alias("new_name"), F.lit(True).alias("_exists")).distinct()
    action = (
        F.when(F.col("file_name") == F.col("new_name"), "keep")
        .when(F.col("_exists") | (F.col("file_id") != F.col("_first")), "skip")
        .otherwise("rename")
    )
    return (
        planned.join(winners, "new_name").join(existing, "new_name", "left")
        .select("file_id", "file_name", "new_name", action.alias("action"))
    )


def removed_report(removed: DataFrame, metadata: DataFrame, lyrics: DataFrame, key: str,
                   order: str, text: str = "lyrics") -> DataFrame:
    """Removed ids with known metadata and their first lyrics."""
    # only the removed texts are moved
    theirs = lyrics.select(key, order, text).join(removed.select(key), key, "left_semi")
    first = keep_one(theirs, key, order, last=False).select(key, text)
    report = removed.select(key).join(metadata, key).join(first, key, "left")
    return report.withColumn(text, F.coalesce(text, F.lit("")))


def backfill_worklist(lyrics: DataFrame, files: DataFrame, key: str, text: str = "lyrics") -> DataFrame:
    """Ids to transcribe: blank lyrics with audio (``retry``), audio without a
    lyrics row (``new``)."""
    blank = lyrics.where(blank_to_null(F.col(text)).isNull())
    retry = blank.select(key).join(files.select(key), key, "left_semi").withColumn("reason", F.lit("retry"))
    new = files.select(key).join(lyrics.select(key), key, "left_anti").withColumn("reason", F.lit("new"))
    return retry.unionByName(new)


def upsert(current: DataFrame, incoming: DataFrame, key: str, text: str = "lyrics") -> DataFrame:
    """Fill blanks and add new ids; texts already there are kept."""
    old = current.select(key, blank_to_null(F.col(text)).alias("_old"))
    new = incoming.select(key, blank_to_null(F.col(text)).alias("_new"))
    return old.join(new, key, "full").select(key, F.coalesce("_old", "_new").alias(text))


def lookup(df: DataFrame, wanted: DataFrame, *keys: str) -> DataFrame:
    """Every wanted key with its matching row, and ``found``."""
    marked = df.withColumn("found", F.lit(True))
    joined = wanted.join(marked, list(keys), "left")
    return joined.withColumn("found", F.coalesce("found", F.lit(False)))


def search(df: DataFrame, text: str, *columns: str) -> DataFrame:
    """Case-insensitive literal substring in any of the columns; empty finds all."""
    if not text:
        return df
    found = F.lit(False)
    for column in columns:
        found = found | F.contains(F.lower(F.col(column)), F.lit(text.lower()))
    return df.where(F.coalesce(found, F.lit(False)))


def subset(df: DataFrame, key: str, *wanted: DataFrame) -> DataFrame:
    """Rows whose id occurs in any of the wanted tables (query and neighbours)."""
    return df.join(ids_seen(*wanted, key=key), key, "left_semi")


def complete_rows(df: DataFrame, *required: str) -> DataFrame:
    """Rows whose required fields are all non-blank."""
    return df.where(_all_present(required))


def _all_present(required: tuple[str, ...]) -> Column:
    present = F.lit(True)
    for column in required:
        present = present & (F.coalesce(strip(F.col(column).cast("string")), F.lit("")) != "")
    return present


def mark_valid(df: DataFrame, *required: str) -> DataFrame:
    return df.withColumn("valid", _all_present(required))


def split_valid(df: DataFrame, *required: str) -> tuple[DataFrame, DataFrame]:
    """``(valid, rejected)`` rows."""
    marked = mark_valid(df, *required)
    return marked.where("valid").drop("valid"), marked.where("not valid").drop("valid")


def default_columns(df: DataFrame, defaults: dict[str, str] | list[str]) -> DataFrame:
    """Add absent columns and fill NULLs, by default with ``N/A``."""
    if not isinstance(defaults, dict):
        defaults = {name: NOT_AVAILABLE for name in defaults}
    filled = {
        name: F.coalesce(F.col(name).cast("string"), F.lit(value)) if name in df.columns else F.lit(value)
        for name, value in defaults.items()
    }
    return df.withColumns(filled)


def missing_counts(df: DataFrame, *columns: str) -> DataFrame:
    """``total`` rows and, per column, how many are NULL."""
    missing = [F.count_if(F.col(c).isNull()).alias(f"missing_{c}") for c in columns]
    return df.agg(F.count("*").alias("total"), *missing)


def distinct_categories(df: DataFrame, *columns: str) -> DataFrame:
    """``feature, category`` for every distinct value of the given columns, in
    one pass over the table."""
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("category"))
                      for c in columns])
    return df.select(F.inline(pairs)).where("category is not null").distinct()


def top_liked(events: DataFrame, item: str, like: str, k: int) -> DataFrame:
    """The k most liked items with their display rank."""
    from pyspark.sql import Window

    totals = events.groupBy(item).agg(F.sum(like).cast("long").alias("likes"))
    best = totals.orderBy(F.desc("likes"), F.asc(item)).limit(k)
    # at most k rows are numbered here
    return best.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("likes"), F.asc(item))))
