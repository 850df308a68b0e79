"""Stateful next-fit packing across micro-batches.

Keyed by slot; the value state holds (archive ordinal, bytes in the open
archive), so a slot's archives continue across micro-batches exactly as one
sequential pass would (provided each slot's rows arrive in claim order across
batches, e.g. files written in claim order and read one per trigger).
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators.packing import NextFit

STATE = T.StructType([T.StructField("k", T.LongType()), T.StructField("fill", T.LongType())])
OUT = T.StructType([
    T.StructField("archive_id", T.StringType()),
    T.StructField("slot", T.IntegerType()),
    T.StructField("claim_seq", T.LongType()),
    T.StructField("declared", T.LongType()),
    T.StructField("actual", T.LongType()),
    T.StructField("k", T.LongType()),
])


class NextFitProcessor(StatefulProcessor):
    def __init__(self, cap_bytes: int):
        self.cap = cap_bytes

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("pack", STATE)

    def handleInputRows(self, key, rows, timerValues):
        # one micro-batch of one slot may come in several Arrow batches
        pdf = pd.concat(list(rows), ignore_index=True).sort_values("claim_seq", kind="stable")
        fit = NextFit(self.cap, rotate=False)
        if self.state.exists():   # continue the slot's open archive from earlier batches
            fit.key, (fit.k, fit.fill) = key, self.state.get()
        out = [fit.step(key, d, a)[0] for d, a in zip(pdf["declared"].fillna(0).astype("int64").tolist(),
                                                       pdf["actual"].fillna(0).astype("int64").tolist())]
        self.state.update((fit.k, fit.fill))
        yield pd.DataFrame({
            "archive_id": pdf["archive_id"].tolist(), "slot": pdf["slot"].astype("int32").tolist(),
            "claim_seq": pdf["claim_seq"].astype("int64").tolist(), "declared": pdf["declared"].tolist(),
            "actual": pdf["actual"].tolist(), "k": out,
        })

    def close(self) -> None:
        pass


def stream_pack(rows: DataFrame, cap_bytes: int) -> DataFrame:
    """Streaming ``pack_next_fit`` (slot mode) with per-slot state in the state store."""
    return rows.groupBy("slot").transformWithStateInPandas(
        statefulProcessor=NextFitProcessor(cap_bytes), outputStructType=OUT,
        outputMode="Append", timeMode="None")
