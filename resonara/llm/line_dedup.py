"""Line dedup: later copies of repeated runs of lines go.

A run of consecutive lines is repeated if the same lines stand, in the same
order, at an earlier place: earlier by document id, then by line.  It counts when
its lines hold at least ``min_chars`` characters together.  Every line that lies
in a later copy of such a run is deleted; the first copy stays.  Runs do not
reach over documents and may overlap.

Lines become ids, and prefix doubling names every suffix by its first 2^k lines:
the name for 2^(k+1) joins the names at a place and 2^k further on.  Places of one
name are the suffixes that share that prefix, an interval of the suffix array; the
question asked of it is only which place of an interval comes first, so names
take the part of sorted ranks.  A run of any length is named by two names of the
largest power within it, one at its start and one at its end.

A maximal repeated run is the union of its shortest counting runs: those that
start at each of its lines and those that end at each of its lines.  What these
are follows from their lines alone, so only they are named and looked up, and no
run is compared with another.  Lines that occur once cannot lie in a repeated run
and leave at the start.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from resonara.llm.common import keyed_lookup
from resonara.workspace import written

MIN_CHARS = 40


def _name(*parts: Column) -> Column:
    """128 bits over the parts, from two hashes with different seeds."""
    return F.struct(F.xxhash64(*parts).alias("p"), F.xxhash64(F.lit(7), *parts).alias("q"))


def _shortest_runs(places: DataFrame, min_chars: int) -> DataFrame:
    """(row, start, size) of the shortest counting run from each line and up to each line.

    ``places`` has ``row``, ``stretch`` (lines without a gap between), ``line``,
    ``total`` (characters of the stretch up to and with the line) and ``chars``.
    One sort by running totals lays the other end of each run next to it.
    """
    ends, begins = F.col("total"), F.col("total") - F.col("chars")

    def events(known: Column, asked: Column) -> DataFrame:
        return places.select("row", "stretch", F.inline(F.array(
            F.struct(known.alias("key"), F.lit(0).alias("asks"), F.col("line").alias("line")),
            F.struct(asked.alias("key"), F.lit(1).alias("asks"), F.col("line").alias("line")))))

    def other(order: list[Column]) -> Column:
        seen = W.partitionBy("row", "stretch").orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)
        return F.last(F.when(F.col("asks") == 0, F.col("line")), ignorenulls=True).over(seen)

    forward = (events(ends, begins + min_chars)
               .withColumn("end", other([F.col("key").desc(), F.col("asks"), F.col("line").desc()]))
               .where("asks = 1 and end is not null").select("row", F.col("line").alias("start"), F.col("end")))
    backward = (events(begins, ends - min_chars)
                .withColumn("start", other([F.col("key"), F.col("asks"), F.col("line")]))
                .where("asks = 1 and start is not null").select("row", "start", F.col("line").alias("end")))
    return forward.unionByName(backward).select("row", "start", (F.col("end") - F.col("start") + 1).alias("size")).distinct()


def deleted_lines(lines: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(row, line) of each line in a later copy of a repeated run.

    ``lines`` has ``row`` (unique per document), ``id`` (documents are ordered by
    id, then row; null ids first), ``line`` (from 0), ``chars``, ``p`` and ``q``
    (the line's name).  Starts Spark jobs.
    """
    twice = written(lines.groupBy("p", "q").agg(F.count("*").alias("places")).where("places > 1"), "repeated")
    kept = keyed_lookup(lines, twice, ["p", "q"], "places")
    run = W.partitionBy("row", "stretch").orderBy("line")
    places = written(
        kept.withColumn("stretch", F.col("line") - F.row_number().over(W.partitionBy("row").orderBy("line")))
        .select("row", "id", "stretch", "line", "chars", F.sum("chars").over(run).alias("total"), F.struct("p", "q").alias("n0")), "places")
    runs = written(_shortest_runs(places, min_chars), "runs")
    longest = runs.agg(F.max("size")).first()[0] or 1
    levels = int(longest).bit_length()
    named = places
    for level in range(1, levels):
        further = F.lead(f"n{level - 1}", 1 << (level - 1)).over(run)
        named = named.withColumn(f"n{level}", F.when(further.isNotNull(), _name(F.col(f"n{level - 1}"), further)))
    named = written(named.select("row", "id", "line", F.array(*[f"n{level}" for level in range(levels)]).alias("names")), "names")
    level = F.floor(F.log2(F.col("size"))).cast("int")
    heads = named.select("row", "id", F.col("line").alias("start"), F.col("names").alias("heads"))
    tails = named.select("row", F.col("line").alias("tail"), F.col("names").alias("tails"))
    runs = (runs.withColumn("level", level).withColumn("tail", F.expr("start + size - shiftleft(1, level)"))
            .join(heads, ["row", "start"]).join(tails, ["row", "tail"])
            .select("row", "id", "start", "size", F.expr("heads[level]").alias("head"), F.expr("tails[level]").alias("end"))
            .select("row", "id", "start", "size", F.col("head.p").alias("a"), F.col("head.q").alias("b"),
                    F.col("end.p").alias("c"), F.col("end.q").alias("d")))
    key = ["size", "a", "b", "c", "d"]
    runs = written(runs, "runs")
    first = written(runs.groupBy(*key).agg(F.count("*").alias("places"), F.min(F.struct("id", "row", "start")).alias("first"))
                    .where("places > 1"), "first")
    later = (keyed_lookup(runs, first, key, "places").where("struct(id, row, start) > first")
             .groupBy("row", F.col("start").alias("line")).agg(F.max(F.col("start") + F.col("size")).alias("until")))
    reach = F.max("until").over(W.partitionBy("row").orderBy("line").rowsBetween(W.unboundedPreceding, W.currentRow))
    return (places.select("row", "line").join(later, ["row", "line"], "left").withColumn("reach", reach)
            .where("reach > line").select("row", "line"))


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS) -> DataFrame:
    """``docs`` with its texts less the deleted lines; all rows and other columns stay.

    A text whose lines all go becomes empty; null and empty texts stay as they
    are.  Rows of one id are ordered by their place in the input; null ids come
    first.  Other columns pass through whatever their names.  Starts Spark jobs.
    """
    rows = written(docs.select(F.monotonically_increasing_id().alias("row"), F.struct(*docs.columns).alias("kept")), "documents")
    parts = F.split(F.col("kept")[text_col], "\n", -1)
    lines = written(
        rows.select("row", F.col("kept")[id_col].alias("id"), F.posexplode(parts).alias("line", "content"))
        .select("row", "id", "line", F.char_length("content").cast("long").alias("chars"), _name(F.col("content")).alias("name"))
        .select("row", "id", "line", "chars", "name.p", "name.q"), "lines")
    gone = deleted_lines(lines, min_chars).groupBy("row").agg(F.collect_list("line").alias("gone"))
    left = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), "gone")
    text = F.array_join(F.transform(left, lambda at: F.col("lines")[at]), "\n")
    found = rows.join(gone, "row", "left").withColumn("lines", F.when(F.col("gone").isNotNull(), parts))
    cleaned = F.when(F.col("gone").isNull(), F.col("kept")[text_col]).otherwise(text)
    return found.select(*[(cleaned if name == text_col else F.col("kept")[name]).alias(name) for name in docs.columns])
