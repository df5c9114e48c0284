"""Guards that speak when a stream falls silent: keyed state with processing-time timers."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

ALARMS = "event_id bigint, layer string, state string, last_seen timestamp, silent_seconds double"
#: Keyed state with timers needs this provider.
PROVIDER = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


class LayerGuard(StatefulProcessor):
    """For each live event when each layer was last heard of; one timer for the next layer that is due."""

    def __init__(self, layers: Sequence[str], limit_ms: int):
        self.layers, self.limit = tuple(layers), limit_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.heard = handle.getMapState("heard", "layer string", "arrived bigint, last_seen timestamp, silent boolean")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        now, last, ended = timerValues.getCurrentProcessingTimeInMs(), {}, False
        for part in rows:
            ended = ended or bool((part["status"] == "ENDED").any())
            for layer, at in part.groupby("layer")["captured_at"].max().items():
                if layer in self.layers:
                    last[layer] = max(at, last.get(layer, at))
        if ended:
            self._forget()
            return
        known = dict(self._all())
        back = []
        for layer in self.layers:
            old = known.get(layer)
            if layer in last:
                seen = last[layer] if old is None or old[1] is None or last[layer] > old[1] else old[1]
                if old is not None and old[2]:
                    back.append((key[0], layer, "RECOVERED", seen, (now - old[0]) / 1000))
                known[layer] = (now, seen, False)
            elif old is None:
                known[layer] = (now, None, False)  # due from the event's first row on
            else:
                continue
            self.heard.updateValue((layer,), known[layer])
        self._set_timer(known, now)
        if back:
            yield pd.DataFrame(back, columns=[c.split()[0] for c in ALARMS.split(", ")])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now, known, out = timerValues.getCurrentProcessingTimeInMs(), dict(self._all()), []
        for layer, (arrived, seen, silent) in sorted(known.items()):
            if not silent and arrived + self.limit <= now:
                known[layer] = (arrived, seen, True)
                self.heard.updateValue((layer,), known[layer])
                out.append((key[0], layer, "SILENT", seen, (now - arrived) / 1000))
        self._set_timer(known, now)
        if out:
            yield pd.DataFrame(out, columns=[c.split()[0] for c in ALARMS.split(", ")])

    def close(self) -> None:
        pass

    def _all(self) -> list[tuple[str, tuple]]:
        return [(k[0], tuple(v)) for k, v in self.heard.iterator()] if self.heard.exists() else []

    def _set_timer(self, known: dict[str, tuple], now: int) -> None:
        for t in list(self.handle.listTimers()):
            self.handle.deleteTimer(t)
        due = [arrived + self.limit for arrived, _, silent in known.values() if not silent]
        if due:
            self.handle.registerTimer(max(min(due), now + 1))

    def _forget(self) -> None:
        for t in list(self.handle.listTimers()):
            self.handle.deleteTimer(t)
        self.heard.clear()


def layer_alarms(stream: DataFrame, layers: Sequence[str], limit_seconds: float = 180) -> DataFrame:
    """event_id, layer, state, last_seen, silent_seconds: SILENT once a live event's layer has sent nothing for the limit, also if no row of any
    event arrives any more; RECOVERED with its next row. stream: event_id, layer, captured_at, status. A row of status ENDED forgets the event; a layer that never sent counts from the event's first row.

    The state of an event is one entry for each layer. The session's state store has to be the one of PROVIDER when the query starts.
    """
    rows = stream.selectExpr("CAST(event_id AS BIGINT) AS event_id", "layer", "CAST(captured_at AS TIMESTAMP) AS captured_at", "status")
    return rows.groupBy("event_id").transformWithStateInPandas(LayerGuard(layers, int(limit_seconds * 1000)), outputStructType=ALARMS, outputMode="Append", timeMode="ProcessingTime")


def start_alarms(stream: DataFrame, table: str, checkpoint: str, layers: Sequence[str], limit_seconds: float = 180, every: str = "5 seconds"):
    """`layer_alarms` appended to a table; batches go on without input, so timers fire in silence."""
    spark = stream.sparkSession
    before = spark.conf.get(PROVIDER[0], None)
    spark.conf.set(*PROVIDER)
    try:
        return layer_alarms(stream, layers, limit_seconds).writeStream.format("parquet").option("path", table).option("checkpointLocation", checkpoint).outputMode("append").trigger(processingTime=every).start()
    finally:
        spark.conf.set(PROVIDER[0], before) if before is not None else spark.conf.unset(PROVIDER[0])
