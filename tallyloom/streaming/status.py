"""Status of sources as their rows come in: what each has had last, and a note when nothing comes any more."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def status_stream(stream: DataFrame, key: str, at: str, late_days: int = 62) -> DataFrame:
    """(key, last, n, status, change) for update mode: a row whenever a source has new rows ("ok") or none for `late_days` ("late").

    The state of a source is its latest time and its number of rows. The watermark follows the latest time of all sources by
    `late_days`; a source's timer is its own latest time, so it goes off when the watermark is past it. Rows behind the
    watermark are dropped. `change` grows with each row of a source, so a keyed sink keeps the newest one. Null keys are a
    source like others; null times are left out.
    """
    kind = {f.name: f.dataType.simpleString() for f in stream.schema}[key]

    def run(own: tuple[Any, ...], parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last, n, change = state.get if state.exists else (None, 0, 0)
        if state.hasTimedOut:
            status = "late"
        else:
            status = "ok"
            for part in parts:
                n += len(part)
                newest = part["_at"].max()
                last = newest if last is None or newest > last else last
        change += 1
        state.update((last, n, change))
        if status == "ok":
            instant = int(pd.Timestamp(last).value // 1_000_000)
            if instant > state.getCurrentWatermarkMs():
                state.setTimeoutTimestamp(instant)
            else:
                status = "late"
        yield pd.DataFrame({"key": [own[0]], "last": [last], "n": [n], "status": [status], "change": [change]})

    rows = stream.filter(F.col(at).isNotNull()).select(F.col(key).alias("key"), F.col(at).alias("_at")).withWatermark("_at", f"{late_days} days")
    found = rows.groupBy("key").applyInPandasWithState(run, f"key {kind}, last timestamp, n long, status string, change long", "last timestamp, n long, change long", "update", GroupStateTimeout.EventTimeTimeout)
    return found.withColumnRenamed("key", key)
