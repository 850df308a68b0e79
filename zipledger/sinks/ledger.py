"""Ledger snapshots: versioned, never written over the input path.

Layout: ``<root>/version=<n>/`` Parquet, plus ``<root>/_committed_<n>`` marker
written after the data; the marker also names the last update-log batch folded
into the version, so version and fold are committed together. Readers take the newest committed version, so a
crashed write is never visible and the previous version stays intact.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import DataFrame, SparkSession

from ..schema import LEDGER
from . import fs as fsx


def committed_versions(root: str) -> list[int]:
    return sorted(int(m.group(1)) for f in fsx.list_dir(root) if (m := re.fullmatch(r"_committed_(\d+)", f)))


def folded_batch(root: str, version: int) -> int:
    """The last update-log batch that a committed version contains (-1: none)."""
    return json.loads(fsx.read_text(fsx.join(root, f"_committed_{version}")))["folded"]


def last_archive(root: str) -> int | None:
    """The highest archive index that the newest committed version's run knew of (None: not recorded)."""
    done = committed_versions(root)
    return json.loads(fsx.read_text(fsx.join(root, f"_committed_{done[-1]}"))).get("last_archive") if done else None


def write_ledger_snapshot(ledger: DataFrame, root: str, version: int | None = None, folded: int | None = None,
                          last_archive: int | None = None) -> int:
    """Write ``ledger`` as the next (or given) version and mark it committed. Without ``folded``
    the version contains the update-log batches that its predecessor contains."""
    done = committed_versions(root)
    if version is None:
        version = (done[-1] + 1) if done else 1
    if folded is None:
        before = [v for v in done if v < version]
        folded = folded_batch(root, before[-1]) if before else -1
    target = fsx.join(root, f"version={version}")
    ledger.write.mode("overwrite").parquet(target)
    fsx.write_text(fsx.join(root, f"_committed_{version}"), json.dumps(
        {"path": target, "folded": folded, "last_archive": last_archive}))
    return version


def read_ledger_snapshot(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    done = committed_versions(root)
    if not done:
        raise FileNotFoundError(f"no committed ledger version under {root}")
    v = version if version is not None else done[-1]
    if v not in done:
        raise FileNotFoundError(f"ledger version {v} is not committed")
    return spark.read.schema(LEDGER).parquet(fsx.join(root, f"version={v}"))
