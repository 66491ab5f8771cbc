"""Results that are handed out once: what a request costs in calls to the state."""

from collections import Counter

from pyspark.sql import Row
from pyspark.sql.types import StructType

from resonara.streaming.reading import _HandOut

COLUMNS = ["status", "rank"]


class _State:
    """A list or value state that counts its calls."""

    def __init__(self, calls: Counter):
        self.calls, self.held = calls, None

    def __getattr__(self, name):
        def call(*given):
            self.calls[name] += 1
            if name == "exists":
                return self.held is not None
            if name == "get":
                return iter(self.held)
            self.held = {"appendList": lambda: [*(self.held or []), *given[0]], "update": lambda: given[0], "clear": lambda: None}[name]()
        return call


def hand_out():
    calls = Counter()
    processor = _HandOut(COLUMNS, StructType(), None)
    processor.rows, processor.gone = _State(calls), _State(calls)

    def batch(results=(), reads=()):
        rows = [Row(read_id=None, status=status, rank=rank) for status, rank in results] + [Row(read_id=n, status=None, rank=None) for n in reads]
        return sorted(((row["read_id"], row["status"], row["rank"]) for row in processor.handleInputRows(("r",), iter(rows), None)), key=str)

    return batch, calls


def test_results_read_in_their_own_batch_never_enter_the_state():
    batch, calls = hand_out()
    assert batch([("completed", 1), ("completed", 2), ("completed", 2)], [2, 1]) == [(1, "completed", 1), (1, "completed", 2)]
    assert calls == {"exists": 2, "update": 1}
    assert batch([("completed", 1)], [3]) == [] and calls["exists"] == 3


def test_results_wait_for_their_reader():
    batch, _ = hand_out()
    assert batch(reads=[1, 2]) == [(1, "processing", None), (2, "processing", None)]
    assert batch([("completed", 1)]) == [] == batch([("completed", 2)])
    assert batch([("completed", 1)], [7, 5]) == [(5, "completed", 1), (5, "completed", 2)]
    assert batch(reads=[8]) == []
