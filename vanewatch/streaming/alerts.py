"""Alert de-duplication as keyed state."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from vanewatch.streaming.rolling import in_arrival_order

ALERT_SCHEMA = "engine_id STRING, arrival BIGINT, risk_level STRING, failure_risk DOUBLE"


def opened_alerts(log: DataFrame) -> DataFrame:
    """Alert rows that open while their engine has no open alert.

    Input: ``engine_id, arrival, risk_level, failure_risk, is_alert, is_ack``. State: is one open.
    """

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        batch = in_arrival_order(frames)
        is_open = state.get[0] if state.exists else False
        acks = batch["is_ack"].to_numpy(dtype=bool)
        epoch = np.cumsum(acks) - acks  # acknowledgements before the row
        wanted = batch[batch["is_alert"].to_numpy(dtype=bool)]
        epochs = epoch[batch["is_alert"].to_numpy(dtype=bool)]
        first = ~pd.Series(epochs).duplicated().to_numpy()
        if is_open:
            first &= epochs > 0
        total = int(acks.sum())
        open_now = bool((epochs == total).any()) or (is_open and total == 0)
        state.update((open_now,))
        if first.any():
            out = wanted[first]
            yield out[["arrival", "risk_level", "failure_risk"]].assign(engine_id=key[0])[
                ["engine_id", "arrival", "risk_level", "failure_risk"]
            ]

    return log.groupBy("engine_id").applyInPandasWithState(
        step, ALERT_SCHEMA, "open BOOLEAN", "append", GroupStateTimeout.NoTimeout
    )
