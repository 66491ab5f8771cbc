"""Readers that conform raw inputs to the library's tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from resonara.functions.text import blank_to_null, strip
from resonara.functions.vectors import mean_pool_or_pass

FRAMES = T.ArrayType(T.ArrayType(T.FloatType()))
VECTOR = T.ArrayType(T.FloatType())

FRAME_RECORDS = T.StructType([
    T.StructField("artist", T.StringType()),
    T.StructField("song", T.StringType()),
    T.StructField("embedding", FRAMES),
])
METADATA_CSV = T.StructType([
    T.StructField("ID", T.StringType()),
    T.StructField("Song Name", T.StringType()),
    T.StructField("Band", T.StringType()),
    T.StructField("Instrumentation", T.IntegerType()),
    T.StructField("Genre", T.StringType()),
    T.StructField("Acoustic vs Electronic", T.StringType()),
    T.StructField("Gender Voice", T.StringType()),
    T.StructField("Bpm", T.IntegerType()),
    T.StructField("YT Link", T.StringType()),
])

# --- fixed values: accepted spellings of each column, best first ------------
RECORD_COLUMNS = {
    "item_id": ("video_id", "id"),
    "artist": ("channel_name", "artist"),
    "song": ("song_title", "song"),
    "link": ("youtube_link",),
}
METADATA_COLUMNS = {"id": "ID", "Band": "Artist", "Song Name": "Song"}
# ----------------------------------------------------------------------------


def tag_population(df: DataFrame, label: str) -> DataFrame:
    return df.withColumn("population", F.lit(label))


def union_tagged(**populations: DataFrame) -> DataFrame:
    """Union of tables by column name, each tagged with its label; columns a
    table lacks are NULL."""
    tagged = [tag_population(df, label) for label, df in populations.items()]
    out = tagged[0]
    for df in tagged[1:]:
        out = out.unionByName(df, allowMissingColumns=True)
    return out


def conform_records(df: DataFrame) -> DataFrame:
    """Records of either naming scheme as ``item_id, artist, song, link`` plus
    the remaining columns.  Blank strings become NULL."""
    used = {old for names in RECORD_COLUMNS.values() for old in names}

    def first_present(names: tuple[str, ...]) -> Column:
        present = [blank_to_null(F.col(n).cast("string")) for n in names if n in df.columns]
        return F.coalesce(*present) if present else F.lit(None).cast("string")

    conformed = [first_present(names).alias(new) for new, names in RECORD_COLUMNS.items()]
    return df.select(*conformed, *[c for c in df.columns if c not in used])


def pooled(df: DataFrame, frames: str = "frames", vector: str = "vector") -> DataFrame:
    """One double vector ``embedding`` from a matrix column or a vector column."""
    matrix = F.col(frames) if frames in df.columns else F.lit(None).cast(FRAMES)
    flat = F.col(vector) if vector in df.columns else F.lit(None).cast(VECTOR)
    kept = [c for c in df.columns if c not in (frames, vector)]
    return df.select(*kept, mean_pool_or_pass(matrix, flat).alias("embedding"))


def read_frame_json(spark: SparkSession, path: str, population: str, multi_line: bool = True) -> DataFrame:
    """Frame-matrix records from JSON, pooled to one vector per item."""
    raw = spark.read.schema(FRAME_RECORDS).json(path, multiLine=multi_line)
    return tag_population(pooled(raw, frames="embedding"), population)


def read_records(spark: SparkSession, path: str, population: str) -> DataFrame:
    """Embedding records of either naming scheme from parquet."""
    raw = spark.read.parquet(path)
    kind = raw.schema["embedding"].dataType
    matrix = isinstance(kind.elementType, T.ArrayType)
    named = raw.withColumnRenamed("embedding", "frames" if matrix else "vector")
    return tag_population(conform_records(pooled(named)), population)


def read_token_rows(spark: SparkSession, path: str, population: str) -> DataFrame:
    """``frames, artist, song`` rows, with any further columns left unread."""
    return tag_population(spark.read.parquet(path).select("frames", "artist", "song"), population)


def conform_metadata(df: DataFrame) -> DataFrame:
    """Trimmed headers under their common names."""
    renamed = df.toDF(*[c.strip() for c in df.columns])
    wanted = {old: new for old, new in METADATA_COLUMNS.items()
              if old in renamed.columns and new not in renamed.columns}
    return renamed.withColumnsRenamed(wanted)


def read_metadata_csv(spark: SparkSession, *paths: str, schema: T.StructType | None = METADATA_CSV,
                      mode: str = "PERMISSIVE") -> DataFrame:
    """Curated metadata from one or more CSV files with a header."""
    reader = spark.read.options(header=True, multiLine=True, escape='"', mode=mode, enforceSchema=True)
    reader = reader.schema(schema) if schema is not None else reader
    return conform_metadata(reader.csv(list(paths)))


def as_catalogue(df: DataFrame) -> DataFrame:
    """Every column as a string."""
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])


def read_catalogue(spark: SparkSession, path: str) -> DataFrame:
    """A CSV catalogue with all columns as strings; a missing file is an error."""
    return spark.read.options(header=True, multiLine=True, escape='"').csv(path)


def seed_urls(df: DataFrame, column: str = "playlist_url") -> DataFrame:
    return df.select(column).dropna(subset=[column])


def read_seed_urls(spark: SparkSession, path: str) -> DataFrame:
    return seed_urls(read_catalogue(spark, path))


def list_audio(spark: SparkSession, folder: str, recursive: bool = True, content: bool = False,
               pattern: str = "*.[mM][pP]3") -> DataFrame:
    """Audio files below a folder: ``path, file_name, stem, length``.  The bytes
    are read only when asked for."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", str(recursive).lower())
        .option("pathGlobFilter", pattern)
        .load(folder)
    )
    name = F.try_url_decode(F.element_at(F.split("path", "/"), -1))
    stem = F.regexp_replace(name, r"\.[^.]*$", "")
    kept = ["path", name.alias("file_name"), stem.alias("stem"), "length"]
    return files.select(*kept, *(["content"] if content else []))


def conform_strings(df: DataFrame, *columns: str) -> DataFrame:
    """Trim blanks of any kind and turn blank strings into NULL."""
    return df.withColumns({c: blank_to_null(strip(F.col(c))) for c in columns})
