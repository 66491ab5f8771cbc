"""Results that are handed out once, kept in a keyed state store until then."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery
from pyspark.sql.types import StructType

_STORE = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_keyed_store(spark: SparkSession) -> None:
    """Queries of the session keep their state in RocksDB, the only store for processors with states of their own."""
    spark.conf.set(_STORE, _ROCKS)


class _HandOut(StatefulProcessor):
    """Per request: its result rows until somebody reads them, then a mark that they are gone."""

    def __init__(self, columns: list[str], schema: StructType, keep_ms: int | None):
        self.columns, self.schema, self.keep_ms = columns, schema, keep_ms

    def init(self, handle) -> None:
        self.rows = handle.getListState("rows", self.schema)
        self.gone = handle.getValueState("gone", "read_id long", **({"ttlDurationMs": self.keep_ms} if self.keep_ms else {}))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        found, reads = [], []
        for row in rows:
            (found if row["read_id"] is None else reads).append(row.asDict())
        # each call to a state is a round trip to the JVM, which costs more than all else here: rows that are read at once never enter it
        if self.gone.exists():
            return  # a later read finds nothing
        if not reads:
            if found:
                self.rows.appendList([tuple(row[name] for name in self.columns) for row in found])
            return
        # a batch that was answered again brought its rows twice
        held, stored = {tuple(row[name] for name in self.columns) for row in found}, self.rows.exists()
        if stored:
            held.update(map(tuple, self.rows.get()))
        first, *later = sorted({row["read_id"] for row in reads})
        if not held:
            for read_id in (first, *later):
                yield self._out(key, read_id, "processing", None)
            return
        for row in held:
            yield self._out(key, first, None, row)
        if stored:
            self.rows.clear()
        self.gone.update((first,))

    def _out(self, key, read_id, status, row) -> Row:
        values = dict(zip(self.columns, row)) if row else dict.fromkeys(self.columns)
        if status:
            values["status"] = status
        return Row(request_id=key[0], read_id=read_id, **values)

    def close(self) -> None:
        pass


def read_once(results: DataFrame, reads: DataFrame, path: str, checkpoint: str, *, keep_ms: int | None = None, once: bool = True,
              interval: str = "5 seconds") -> StreamingQuery:
    """Hand every request's results to its first reader.

    ``results`` streams rows with ``request_id, status, ...``, ``reads`` streams
    ``request_id, read_id`` with growing numbers.  Written to ``path``: for the first
    read that finds results all their columns with ``read_id``, for an earlier one a
    row with the status ``processing``, for a later one nothing.  Results that no one
    has read and marks of those read stay in the state store; ``keep_ms`` lets the
    marks expire.
    """
    columns = [name for name in results.columns if name != "request_id"]
    schema = StructType([results.schema[name] for name in columns])
    blank = [F.lit(None).cast(results.schema[name].dataType).alias(name) for name in columns]
    both = results.select("request_id", F.lit(None).cast("long").alias("read_id"), *columns).unionByName(
        reads.select("request_id", F.col("read_id").cast("long").alias("read_id"), *blank))
    use_keyed_store(both.sparkSession)
    out = StructType([both.schema["request_id"], both.schema["read_id"], *schema.fields])
    handed = both.groupBy("request_id").transformWithState(
        statefulProcessor=_HandOut(columns, schema, keep_ms), outputStructType=out, outputMode="append",
        timeMode="processingTime" if keep_ms else "none")
    writer = handed.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime=interval)).start()
