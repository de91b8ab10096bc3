"""Keyed state for streams: processors whose cost per batch follows the keys in it, and whose keys can expire.

State lives in the stream's RocksDB store below its checkpoint. With a time to live a key that had no new rows for so long
leaves the state; it then starts anew, as at its first row.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

#: State that expires by the clock would ask for batches without data for ever; expired state is dropped by the next batch.
SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
}


def start_with_state(df: DataFrame, start: Callable[[], StreamingQuery]) -> StreamingQuery:
    """Start a query with ``SETTINGS``; the session's own are put back, as a query keeps those it started with."""
    conf = df.sparkSession.conf
    before = {key: conf.get(key, None) for key in SETTINGS}
    for key, value in SETTINGS.items():
        conf.set(key, value)
    try:
        return start()
    finally:
        for key, value in before.items():
            conf.unset(key) if value is None else conf.set(key, value)


def _milliseconds(ttl: float | None) -> int | None:
    return None if ttl is None else max(1, round(ttl * 1000))


class Baselines(StatefulProcessor):
    """Per key the last reading whose time advanced and the first time; gives each reading's change since its baseline."""

    def __init__(self, keys: Sequence[str], types: dict[str, str], ttl: float | None):
        self.keys, self.types, self.ttl = list(keys), types, ttl

    def init(self, handle) -> None:
        t, c = self.types["t"], self.types["c"]
        self.last = handle.getValueState("last", f"t {t}, c {c}, unknown boolean, start {t}", _milliseconds(self.ttl))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        frame = pd.concat(list(rows)).sort_values("seq", kind="stable")
        t, c, unknown = (frame[x].to_numpy() for x in ("t", "c", "unknown"))
        known = self.last.get() if self.last.exists() else None
        if known is None:
            before, start = t[:1], t.min()
            first = frame.iloc[:1]
        else:
            before, start = np.array([known[0]], t.dtype), min(known[3], t.min())
            first = pd.DataFrame({"c": np.array([known[1]], c.dtype), "unknown": [known[2]]})
        reached = np.maximum.accumulate(np.concatenate([before, t]))
        span = t - reached[:-1]
        advanced = span > 0
        if known is None:
            advanced[0] = True
        # The baseline of a row is the last one before it that advanced; place 0 is the one carried over.
        place = np.maximum.accumulate(np.where(advanced, np.arange(1, len(t) + 1), 0))
        base = np.concatenate([[0], place[:-1]])
        bases = np.concatenate([first["c"].to_numpy(), c])
        holes = np.concatenate([first["unknown"].to_numpy().astype(bool), unknown.astype(bool)])
        at = place[-1]
        self.last.update((reached[-1].item(), bases[at].item(), bool(holes[at]), start.item() if hasattr(start, "item") else start))
        told = (span > 0) & ~unknown.astype(bool) & (c != 0) & (frame["lim"].fillna(0).to_numpy() != 0)
        if not told.any():
            return
        out = {name: [value] * int(told.sum()) for name, value in zip(self.keys, key)}
        change = pd.Series(c - bases[base])[told].mask(holes[base][told])
        yield pd.DataFrame(
            {**out, "seq": frame["seq"].to_numpy()[told], "t": t[told], "change": change.astype("object").to_numpy(), "span": span[told],
             "lim": frame["lim"].to_numpy()[told], "start": start}
        )

    def close(self) -> None:
        pass


class FirstDecision(StatefulProcessor):
    """Per run the first deciding event by ``seq``; gives the run's row for every batch that has events of it."""

    def __init__(self, keys: Sequence[str], seq_type: str, ttl: float | None):
        self.keys, self.seq_type, self.ttl = list(keys), seq_type, ttl

    def init(self, handle) -> None:
        self.first = handle.getValueState("first", f"seq {self.seq_type}, outcome string, info string", _milliseconds(self.ttl))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        best = tuple(self.first.get()) if self.first.exists() else None
        found = best
        for frame in rows:
            deciding = frame[frame["outcome"].notna()]
            if len(deciding):
                row = deciding.loc[deciding["seq"].idxmin()]
                if found is None or row["seq"] < found[0]:
                    seq = row["seq"]
                    found = (seq.item() if hasattr(seq, "item") else seq, row["outcome"], row["info"])
        if found is not None and found != best:
            self.first.update(found)
        seq, outcome, info = found or (None, None, None)
        out = {name: [value] for name, value in zip(self.keys, key)}
        yield pd.DataFrame({**out, "seq": pd.array([seq], dtype="object"), "outcome": [outcome], "info": [info]})

    def close(self) -> None:
        pass


def with_state(df: DataFrame, keys: Sequence[str], processor: StatefulProcessor, schema: str) -> DataFrame:
    """The processor's rows for every key of every batch."""
    grouped = df.groupBy(*keys)
    return grouped.transformWithStateInPandas(processor, outputStructType=schema, outputMode="Update", timeMode="ProcessingTime")
