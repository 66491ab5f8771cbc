"""A growing catalogue whose known ids live in a keyed state store."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from resonara.streaming.reading import use_keyed_store


class _FirstSeen(StatefulProcessor):
    """Per id: whether it has been taken."""

    def __init__(self, columns: list[str], arrival: str | None):
        self.columns, self.arrival = columns, arrival

    def init(self, handle) -> None:
        self.taken = handle.getValueState("taken", "taken boolean")

    def handleInitialState(self, key, initialState, timerValues) -> None:
        self.taken.update((True,))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        taken = self.taken.exists()
        first = None
        for row in rows:
            if taken:
                continue
            # nulls come first, as they do in a minimum over structs
            place = [(row[name] is not None, row[name]) for name in ([self.arrival] if self.arrival else []) + self.columns]
            if first is None or _before(place, first[0]):
                first = (place, row)
        if first is not None:
            self.taken.update((True,))
            yield Row(**{name: first[1][name] for name in self.columns})

    def close(self) -> None:
        pass


def _before(one: list[tuple], other: list[tuple]) -> bool:
    for (held, value), (other_held, other_value) in zip(one, other):
        if held != other_held:
            return other_held
        if held and value != other_value:
            return value < other_value
    return False


def ingest_first_seen(stream: DataFrame, path: str, checkpoint: str, *, key: str, arrival: str | None = None, known: DataFrame | None = None,
                      once: bool = True, interval: str = "1 minute") -> StreamingQuery:
    """Append the first row of every id not seen before to the table at ``path``.

    The ids taken so far are state, spread over the tasks by key and kept in RocksDB,
    whose files are compacted and carry Bloom filters: a batch looks up its own ids
    and reads nothing of the stored table.  The first batch that holds an id wins;
    within a batch the smallest ``arrival``, then the smallest row.  ``known`` ids
    are taken from the start.  Rows without an id are left out; columns are of
    ordered types.
    """
    use_keyed_store(stream.sparkSession)
    before = None if known is None else known.where(F.col(key).isNotNull()).select(F.col(key).cast(stream.schema[key].dataType).alias(key)).distinct().groupBy(key)
    fresh = stream.where(F.col(key).isNotNull()).groupBy(key).transformWithState(
        statefulProcessor=_FirstSeen(stream.columns, arrival), outputStructType=stream.schema, outputMode="append", timeMode="none", initialState=before)
    writer = fresh.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime=interval)).start()
