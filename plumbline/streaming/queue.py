"""The outgoing queue with its answers on a stream: what ``replay_queue`` gives for a table."""

from __future__ import annotations

import sys

from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.operators.batching import BATCH_SIZE, FLUSH_SECONDS, QUEUE_LIMIT
from plumbline.operators.queue import Queue, queue_data, queue_rows, replay_held
from plumbline.streaming.stateful import _InOrder, _stateful

cloudpickle.register_pickle_by_value(sys.modules[__name__])


class _Queue(_InOrder):
    columns = ["client_id", "uid", "fate", "batch_id", "place", "at_ms"]

    def __init__(self, size: int, seconds: int, limit: int):
        self.size, self.wait_ms, self.limit = size, seconds * 1000, limit

    def replay(self, key, rows, memory):
        queue = Queue(key[0], self.size, self.wait_ms, self.limit)
        if memory is not None:
            queue.restore(memory)
        return replay_held(queue, rows), queue.state()


def queue_stream(arrivals: DataFrame, answers: DataFrame, size: int = BATCH_SIZE, seconds: int = FLUSH_SECONDS, limit: int = QUEUE_LIMIT) -> DataFrame:
    """Every time a row is sent or lost; both inputs carry a watermark on ``ts``."""
    if size < 1 or limit < 1:
        raise ValueError("batch size and queue limit must be at least 1")
    rows = queue_rows(arrivals, answers)
    # at one instant answers come first
    order = F.concat(F.col("kind").cast("string"), "uid", F.coalesce("batch_id", F.lit("")))
    rows = rows.select("client", "ts", order.alias("uid"), queue_data(rows).alias("data"))
    schema = "client_id string, uid string, fate string, batch_id string, place int, at_ms long"
    return _stateful(rows, ["client"], F.col("data"), _Queue(size, seconds, limit), schema)
