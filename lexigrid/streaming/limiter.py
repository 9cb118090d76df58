"""An admission limiter: windows open with the first hit after the last one ended; a global gate comes before each client's own.

`admitted` decides over a finished table. The global gate is a sequential state over all requests: what it needs of them is only their
times, so a pass over (time, order) alone finds which requests it rejects, and the clients' gates run in parallel over the rest.
`stream` does the clients' gates over a stream, with state that expires.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def millis(requests: DataFrame, at: str) -> Column:
    """Milliseconds since 1970; a time without a zone counts as it is, whatever the session's zone."""
    if requests.schema[at].dataType.typeName() == "timestamp_ntz":
        return F.expr(f"timestampdiff(MILLISECOND, timestamp_ntz'1970-01-01 00:00:00', `{at}`)")
    return F.unix_millis(at)


def gate(times: np.ndarray, window: int, most: int) -> np.ndarray:
    """For rising times in milliseconds: the number of each hit in its window. Jumps from window to window."""
    out = np.empty(len(times), np.int64)
    at = 0
    while at < len(times):
        end = int(np.searchsorted(times, times[at] + window, "left"))
        out[at:end] = np.arange(1, end - at + 1)
        at = end
    return out


def _limited(window: int, most: int):
    def run(_: tuple, group: pa.Table) -> pa.Table:
        group = group.sort_by([("ms", "ascending"), ("order", "ascending")])
        count = gate(group.column("ms").to_numpy(), window, most)
        return group.select(["client", "order", "ms"]).append_column("hits", pa.array(count)).append_column("limited", pa.array(count > most))

    return run


def per_client(requests: DataFrame, client: str, at: str, order: str, window_ms: int = 60_000, most: int = 120) -> DataFrame:
    """(client, order, ms, hits, limited): each client's own gate.

    A request that comes a window or more after the client's last one opens a window for certain: there the client's history is cut, so that
    a group is a burst of requests, not all of a client's. The cut needs no shuffle of its own.
    """
    base = requests.select(F.col(client).cast("string").alias("client"), F.col(order).cast("long").alias("order"), millis(requests, at).alias("ms"))
    w = Window.partitionBy("client").orderBy("ms", "order")
    opens = F.coalesce(F.col("ms") - F.lag("ms").over(w) >= window_ms, F.lit(True)).cast("int")
    cut = base.withColumn("opens", opens).withColumn("burst", F.sum("opens").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("opens")
    return cut.groupBy("client", "burst").applyInArrow(_limited(window_ms, most), "client string, order long, ms long, hits long, limited boolean")


def global_rejections(requests: DataFrame, at: str, order: str, window_ms: int = 60_000, most: int = 1200) -> DataFrame:
    """(order) of the requests that the global gate rejects.

    Times are counted by millisecond first. The chain of windows is found over those counts, sorted, in one task: its input is no more
    than one row for each millisecond that has a hit. The requests themselves are ranked by window in parallel.
    """
    base = requests.select(F.col(order).cast("long").alias("order"), millis(requests, at).alias("ms"))
    moments = base.select("ms").distinct().coalesce(1).sortWithinPartitions("ms")

    def starts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            out = []
            for ms in batch.column("ms").to_pylist():
                if last is None or ms >= last + window_ms:
                    last = ms
                out.append(last)
            yield pa.RecordBatch.from_arrays([batch.column("ms"), pa.array(out, pa.int64())], ["ms", "start"])

    windows = moments.mapInArrow(starts, "ms long, start long")
    ranked = base.join(windows, "ms").withColumn("n", F.expr("row_number() OVER (PARTITION BY start ORDER BY ms, order)"))
    return ranked.where(F.col("n") > most).select("order")


def admitted(requests: DataFrame, client: str, at: str, order: str, window_ms: int = 60_000, most: int = 120, most_global: int = 1200) -> DataFrame:
    """(client, order, status): 503 where the global gate rejects (the client's counter stays), 429 where the client's does, else 200."""
    busy = global_rejections(requests, at, order, window_ms, most_global)
    passed = requests.join(busy.select(F.col("order").alias(order)), order, "left_anti")
    own = per_client(passed, client, at, order, window_ms, most).select("client", "order", F.when(F.col("limited"), 429).otherwise(200).alias("status"))
    rejected = requests.join(busy.select(F.col("order").alias(order)), order, "left_semi").select(F.col(client).cast("string").alias("client"), F.col(order).cast("long").alias("order"), F.lit(503).alias("status"))
    return own.unionByName(rejected)


def tumbling(requests: DataFrame, client: str, at: str, window: str = "60 seconds", most: int = 120) -> DataFrame:
    """(client, start, hits, limited) of windows that are aligned to the clock: an approximation of the gate above."""
    counted = requests.groupBy(F.col(client).cast("string").alias("client"), F.window(at, window).alias("w")).agg(F.count("*").alias("hits"))
    return counted.select("client", F.col("w.start").alias("start"), "hits", (F.col("hits") > most).alias("limited"))


def stream(requests: DataFrame, client: str, at: str, order: str, window_ms: int = 60_000, most: int = 120, delay: str = "1 minute") -> DataFrame:
    """The clients' gates over a stream: (client, order, ms, hits, limited). State is (window's start, hits), dropped a window after it."""
    from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

    base = requests.withWatermark(at, delay).select(F.col(client).cast("string").alias("client"), F.col(order).cast("long").alias("order"), F.col(at).alias("at"), millis(requests, at).alias("ms"))

    def run(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        start, hits = state.get if state.exists else (None, 0)
        rows = pd.concat(list(frames)).sort_values(["ms", "order"])
        counts = []
        for ms in rows["ms"]:
            if start is None or ms >= start + window_ms:
                start, hits = int(ms), 0
            hits += 1
            counts.append(hits)
        state.update((start, hits))
        state.setTimeoutTimestamp(max(start + window_ms, state.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame({"client": key[0], "order": rows["order"], "ms": rows["ms"], "hits": counts, "limited": [c > most for c in counts]})

    return base.groupBy("client").applyInPandasWithState(run, "client string, order long, ms long, hits long, limited boolean", "start long, hits long", "append", GroupStateTimeout.EventTimeTimeout)
