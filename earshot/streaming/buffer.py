"""A delivery buffer: events are held until there are enough bytes or enough time has passed, whichever is first.

Spark's triggers are bounded by time or by the size of what they read. Here a
buffer per key lives in the state of the stream, with the sum of its bytes and a
timer, so that a delivery spans as many triggers as it takes. The state survives
restarts: nothing that was taken in is lost or delivered twice.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

BUFFER_SECONDS = 300
BUFFER_BYTES = 5 << 20
STATE = "held array<string>, bytes bigint, number bigint, due bigint"
DELIVERY = T.StructType(
    [
        T.StructField("delivery", T.LongType()),
        T.StructField("delivered_by", T.StringType()),
        T.StructField("value", T.StringType()),
    ]
)


def _buffer(names: Sequence[str], max_bytes: int, max_seconds: float) -> Callable:
    """The state function of one key: events held, their bytes, the number of the delivery, when it is due."""

    def delivered(key: tuple, values: list[str], number: int, by: str) -> pd.DataFrame:
        columns = dict(zip(names, key, strict=True))
        return pd.DataFrame({**{k: [v] * len(values) for k, v in columns.items()}, "delivery": number, "delivered_by": by, "value": values})

    def hold(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held, total, number, due = state.get if state.exists else ((), 0, 0, 0)
        held = list(held)
        now = int(time.time() * 1000)
        if state.hasTimedOut:
            yield delivered(key, held, number, "time")
            state.update(([], 0, number + 1, 0))
            return
        for batch in batches:
            for value in batch["value"]:
                size = len(value.encode())
                # A delivery is closed before the event that would make it too large; one event may be larger.
                if held and total + size > max_bytes:
                    yield delivered(key, held, number, "size")
                    held, total, number, due = [], 0, number + 1, 0
                held.append(value)
                total += size
                if total >= max_bytes:
                    yield delivered(key, held, number, "size")
                    held, total, number, due = [], 0, number + 1, 0
        if held:
            due = due or now + int(max_seconds * 1000)
            state.setTimeoutDuration(max(1, due - now))
        state.update((held, total, number, due))

    return hold


def buffered(
    events: DataFrame,
    keys: Sequence[str] = (),
    buffers: int = 8,
    max_bytes: int = BUFFER_BYTES,
    max_seconds: float = BUFFER_SECONDS,
) -> DataFrame:
    """The events of a stream, each with the delivery it belongs to.

    A delivery goes out when its texts reach ``max_bytes`` or ``max_seconds`` after
    its first event was taken in. There is a buffer for each combination of
    ``keys`` and, below it, each of ``buffers`` numbers that events are dealt to by
    their hash, so a busy key has several; a buffer never holds more than
    ``max_bytes``. The output has the keys, ``buffer``, ``delivery`` (counting from
    0 in each buffer), ``delivered_by`` (size or time) and ``value``. Time passes
    with the triggers of the query; events held when it stops are delivered when
    it goes on. A pulse, one empty event a second, sees to it that there are
    triggers even if a restarted stream gets no event. As a buffer may fall due at
    any time, there always is a next batch: give the query an interval and not
    ``availableNow``, which would never end. A null ``value`` is left out.
    """
    number = F.pmod(F.xxhash64("value"), F.lit(buffers)).cast("int").alias("buffer")
    events = events.select(*keys, "value")
    pulse = events.sparkSession.readStream.format("rate").option("rowsPerSecond", 1).load()
    pulse = pulse.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in events.schema])
    dealt = events.unionByName(pulse).where(F.col("value").isNotNull()).select(*keys, number, "value")
    names = [*keys, "buffer"]
    found = T.StructType([*[dealt.schema[k] for k in names], *DELIVERY.fields])
    hold = _buffer(names, max_bytes, max_seconds)
    return dealt.groupBy(*names).applyInPandasWithState(hold, found, STATE, "Append", GroupStateTimeout.ProcessingTimeTimeout)
