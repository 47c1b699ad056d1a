"""The strike machine on a stream of probe results: keyed state, the same fold as the batch."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from kalends.operators.liveness import DEAD, GAP_S, KILL

OUT = "url string, strikes int, last_status int, last_checked_s long, last_strike_s long, dead boolean"
STATE = "strikes int, last_strike_s long"


def after(strikes: int, last: int | None, status: int | None, at: int) -> tuple[int, int | None]:
    """One probe's effect, as in the batch fold."""
    if status in DEAD:
        if not strikes or last is None:
            return 1, at
        return (strikes + 1, at) if at - last >= GAP_S else (strikes, last)
    return (0, None) if status is not None and status < 400 else (strikes, last)


def strikes(probes: DataFrame) -> DataFrame:
    """Updates of (url, strikes, ...) from a stream of probes (url, checked_s, n, status), in order of (checked_s, n)
    within a batch; later batches are taken as later."""

    def fold(key: tuple, batches, state: GroupState):
        n, last = state.get if state.exists else (0, None)
        last = None if last is None or last < 0 else last
        rows = pd.concat(list(batches)).sort_values(["checked_s", "n"])
        for at, status in zip(rows["checked_s"], rows["status"]):
            n, last = after(n, last, None if pd.isna(status) else int(status), int(at))
        state.update((n, -1 if last is None else last))
        newest = rows.iloc[-1]
        status = None if pd.isna(newest["status"]) else int(newest["status"])
        yield pd.DataFrame({"url": [key[0]], "strikes": [n], "last_status": pd.array([status], "Int32"), "last_checked_s": [int(newest["checked_s"])], "last_strike_s": pd.array([last], "Int64"), "dead": [n >= KILL]})

    return probes.groupBy("url").applyInPandasWithState(fold, OUT, STATE, "update", GroupStateTimeout.NoTimeout)
