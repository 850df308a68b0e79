"""Next-fit packing of one slot by many tasks: jump tables of blocks, composed in a tree.

``pack_next_fit`` runs a slot through one task, because each archive starts where the one before ended. But what a stretch of
the order does to the open archive can be tabulated without knowing that archive. With ``before(i)`` the actual bytes before
item i and ``reach(i) = before(i) + declared(i)``, the archive opened by item i ends at the first later item j with
``reach(j) > cap + before(i)``. So an open archive is one number, its *limit* ``cap + before(opener)``, and a block maps the limit
it is entered with to the limit it is left with and a count of archives opened:

* only items whose reach exceeds all earlier ones of the block can be the first to open an archive, and, as no limit exceeds
  ``cap + before(first item)``, only those of the block's first cap of bytes: a table has as many rows as an archive has items
  at most, whatever the block's length, and neighbouring rows with the same outcome are one;
* two tables compose to one of the left table's size, so the tables of ``fan_in`` neighbours become their parent's in one task,
  round by round up to the root, and the limits go down the same tree to every block;
* each block then numbers its items from the limit and count it is entered with.

The rows of a block (``block_rows`` at most) and ``fan_in`` tables are what a task holds; no step sees a whole slot. Rows are
exchanged twice by (slot, block) and once by range for the running sums, metadata only.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import constants as C
from ..session import staging_path
from .ordering import with_global_rank

_NONE_OPEN = -(1 << 62)   # the limit with which a slot begins: every item exceeds it
# ``most``: the largest limit the stretch can be entered with (the same in all rows of a node)
_TABLE = "slot int, node long, most long, reach long, limit long, opened long"
_ENTRY = "slot int, node long, limit long, opened long"


def _openers(before: np.ndarray, reach: np.ndarray, cap: int) -> list[int]:
    """For each item the one that ends its archive (the number of items if none does). Never decreases, so one pass does."""
    ends, at, n = [0] * len(before), 0, len(before)
    start, top = before.tolist(), reach.tolist()
    for i in range(n):
        at, limit = max(at, i + 1), start[i] + cap
        while at < n and top[at] <= limit:
            at += 1
        ends[i] = at
    return ends


def _block_table(cap: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_seq", kind="stable")
        before, reach = pdf["_before"].to_numpy("int64"), pdf["_reach"].to_numpy("int64")
        n, ends = len(before), _openers(before, reach, cap)
        limit, opened = (before + cap).tolist(), [1] * n
        for i in range(n - 1, -1, -1):
            if ends[i] < n:
                limit[i], opened[i] = limit[ends[i]], opened[ends[i]] + 1
        top = np.maximum.accumulate(reach)
        first = np.flatnonzero(np.r_[True, top[1:] > top[:-1]])
        first = first[: int(np.searchsorted(reach[first], before[0] + cap, side="right")) + 1]
        table = pd.DataFrame({"reach": reach[first], "limit": [limit[i] for i in first], "opened": [opened[i] for i in first]})
        return _labelled(_merged(table), pdf["slot"].iloc[0], pdf["node"].iloc[0], before[0] + cap)

    return run


def _merged(table: pd.DataFrame) -> pd.DataFrame:
    """Neighbouring rows with the same outcome as one (the last: a lookup takes the first row whose reach is over the limit)."""
    same = (table["limit"].shift(-1) == table["limit"]) & (table["opened"].shift(-1) == table["opened"])
    return table[~same]


def _labelled(table: pd.DataFrame, slot, node, most) -> pd.DataFrame:
    return table.assign(slot=np.int32(slot), node=np.int64(node), most=np.int64(most))[["slot", "node", "most", "reach", "limit", "opened"]]


def _reachable(table: pd.DataFrame, most: int) -> pd.DataFrame:
    """Rows that a limit up to ``most`` can find."""
    return table[: int(np.searchsorted(table["reach"].to_numpy("int64"), most, side="right")) + 1]


def _through(limit: np.ndarray, opened: np.ndarray, table: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Limits and counts after the stretch of ``table`` that is entered with these."""
    at = np.searchsorted(table["reach"].to_numpy("int64"), limit, side="right")
    hit = at < len(table)
    row = np.minimum(at, len(table) - 1)
    return (np.where(hit, table["limit"].to_numpy("int64")[row], limit),
            opened + np.where(hit, table["opened"].to_numpy("int64")[row], 0))


def _compose(fan_in: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["node", "reach"])
        whole, most = None, int(pdf["most"].iloc[0])
        for _, table in pdf.groupby("node"):
            table = table[["reach", "limit", "opened"]]
            if whole is None:
                whole = table
                continue
            limit, opened = _through(whole["limit"].to_numpy("int64"), whole["opened"].to_numpy("int64"), table)
            # a limit that nothing on the left exceeds comes to the right unchanged
            rest = table[table["reach"] > whole["reach"].iloc[-1]]
            whole = pd.concat([whole.assign(limit=limit, opened=opened), rest], ignore_index=True)
            whole = _merged(_reachable(whole, most))
        return _labelled(whole, pdf["slot"].iloc[0], pdf["node"].iloc[0] // fan_in, most)

    return run


def _descend(key, entry: pd.DataFrame, tables: pd.DataFrame) -> pd.DataFrame:
    """The limit and count with which each child is entered, from its parent's."""
    limit, opened, out = entry["limit"].to_numpy("int64"), entry["opened"].to_numpy("int64"), []
    for node, table in tables.sort_values(["node", "reach"]).groupby("node"):
        out.append((key[0], node, int(limit[0]), int(opened[0])))
        limit, opened = _through(limit, opened, table)
    return pd.DataFrame(out, columns=["slot", "node", "limit", "opened"])


def _number(cap: int, names: list[str]):
    def run(key, entry: pd.DataFrame, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_seq", kind="stable")
        before, reach = pdf["_before"].to_numpy("int64"), pdf["_reach"].to_numpy("int64")
        ends, opens = _openers(before, reach, cap), np.zeros(len(pdf), dtype="int64")
        over = np.flatnonzero(reach > entry["limit"].iloc[0])
        at = int(over[0]) if len(over) else len(pdf)
        while at < len(pdf):
            opens[at] = 1
            at = ends[at]
        return pdf.assign(k=entry["opened"].iloc[0] + np.cumsum(opens))[names]

    return run


def pack_next_fit_blocks(df: DataFrame, cap_bytes: int, block_rows: int = 200_000, fan_in: int = 32, seq_col: str = "claim_seq",
                         declared: str = "declared", actual: str = "actual") -> DataFrame:
    """``pack_next_fit(mode="slot")`` with many tasks a slot: adds ``k``, the archive ordinal within the slot.

    ``seq_col`` is an integer, unique within a slot; a block is a stretch of ``block_rows`` consecutive values. Sizes that are null
    or below 0 count as 0; a null slot or
    sequence number is an error. Empty input gives no rows. A cap of
    ``UNLIMITED_BYTES`` or more is one archive a slot."""
    if block_rows < 1 or fan_in < 2:
        raise ValueError("block_rows must be at least 1 and fan_in at least 2")
    cols = list(dict.fromkeys(["archive_id", "slot", seq_col, declared, actual]))
    rows = df.select(*cols)
    if cap_bytes >= C.UNLIMITED_BYTES:
        return rows.withColumn("k", F.lit(1).cast("long"))
    spark = df.sparkSession
    size = lambda c: F.greatest(F.coalesce(F.col(c), F.lit(0)), F.lit(0)).cast("long")
    known = lambda c: F.coalesce(F.col(c), F.raise_error(F.lit(f"a row without a {c}")))
    summed = with_global_rank(rows.withColumn("_seq", known(seq_col).cast("long")).withColumn("slot", known("slot").cast("int")),
                              [F.col("slot"), F.col("_seq")], "_upto", weight=size(actual))
    first, last = summed.agg(F.min("_seq"), F.max("_seq")).first()
    if first is None:
        return rows.withColumn("k", F.lit(1).cast("long"))
    summed = summed.withColumn("_before", F.col("_upto") - size(actual)).withColumn("_reach", F.col("_before") + size(declared)) \
        .withColumn("node", F.expr(f"(_seq - {first}L) div {block_rows}"))

    levels = [_staged(summed.select("slot", "node", "_seq", "_before", "_reach").groupBy("slot", "node")
                      .applyInPandas(_block_table(cap_bytes), _TABLE))]
    top, up = (last - first) // block_rows, F.expr(f"node div {fan_in}")
    while top:
        levels.append(_staged(levels[-1].withColumn("_up", up).groupBy("slot", "_up").applyInPandas(_compose(fan_in), _TABLE)))
        top //= fan_in
    entries = levels[-1].select("slot", "node").distinct().select(
        "slot", "node", F.lit(_NONE_OPEN).alias("limit"), F.lit(0).cast("long").alias("opened"))
    for tables in reversed(levels[:-1]):
        children = tables.withColumn("_up", up).groupBy("slot", "_up")
        entries = _staged(entries.groupBy("slot", "node").cogroup(children).applyInPandas(_descend, _ENTRY))
    out = T.StructType([*rows.schema.fields, T.StructField("k", T.LongType(), False)])
    return entries.groupBy("slot", "node").cogroup(summed.groupBy("slot", "node")) \
        .applyInPandas(_number(cap_bytes, out.names), out)


def _staged(df: DataFrame) -> DataFrame:
    path = staging_path(df.sparkSession, "pack-blocks")
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
