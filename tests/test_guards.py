"""A guard over a stream that falls silent."""

import time
from datetime import datetime

from matchlake.streaming import guards

SCHEMA = "event_id bigint, layer string, captured_at timestamp, status string"
T0 = datetime(2026, 1, 1, 12)


def wait_for(read, least, seconds=90):
    end = time.time() + seconds
    while time.time() < end:
        rows = read()
        if len(rows) >= least:
            return rows
        time.sleep(0.5)
    return read()


def test_silence_raises_alarms_without_input(spark, tmp_path):
    source, table = str(tmp_path / "in"), str(tmp_path / "out")
    put = lambda rows: spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(source)
    put([(1, "score", T0, "LIVE"), (1, "stats", T0, "LIVE"), (2, "score", T0, "LIVE"), (3, "score", T0, "LIVE"), (3, "score", T0, "ENDED"), (1, "other", T0, "LIVE")])
    query = guards.start_alarms(spark.readStream.schema(SCHEMA).parquet(source), table, str(tmp_path / "check"), ("score", "stats"), 3, "500 milliseconds")
    read = lambda: [tuple(r)[:4] for r in spark.read.schema(guards.ALARMS).parquet(table).collect()]
    try:
        time.sleep(2)
        got = wait_for(read, 4)
        assert sorted(got) == [(1, "score", "SILENT", T0), (1, "stats", "SILENT", T0), (2, "score", "SILENT", T0), (2, "stats", "SILENT", None)]
        later = datetime(2026, 1, 1, 13)
        put([(1, "score", later, "LIVE"), (2, "score", later, "ENDED")])
        got = wait_for(read, 6)
        assert [r for r in got if r[2] == "RECOVERED"] == [(1, "score", "RECOVERED", later)]
        assert sorted(r for r in got if r[3] == later) == [(1, "score", "RECOVERED", later), (1, "score", "SILENT", later)]  # silent again; event 2 is forgotten
        assert len(got) == 6
    finally:
        query.stop()
    assert query.exception() is None
