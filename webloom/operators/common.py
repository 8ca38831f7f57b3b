"""Shared helpers: size-checked broadcast, lineage cuts."""

from __future__ import annotations

import uuid

from pyspark import StorageLevel

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from webloom.session import checkpoint_dir

# Largest side we broadcast without asking the optimizer: rule / site / fragment
# tables are config-sized; anything bigger goes through a shuffle join instead.
BROADCAST_MAX_ROWS = 100_000


def small_enough(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> bool:
    """True when ``df`` has at most ``max_rows`` rows (reads at most max_rows + 1)."""
    return df.limit(max_rows + 1).count() <= max_rows


def maybe_broadcast(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Broadcast hint only behind a row-count check; otherwise leave it to the planner."""
    return F.broadcast(df) if small_enough(df, max_rows) else df


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the session's shared checkpoint directory."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into ``spark.checkpoint.dir`` (survives executor loss).

    The rows are cached while the checkpoint is written so the plan runs once (a
    reliable checkpoint of an uncached plan computes it twice), then released.
    """
    checkpoint_dir(df.sparkSession)
    cached = df.persist(StorageLevel.MEMORY_AND_DISK)
    out = cached.checkpoint(eager=True)
    cached.unpersist()
    return out
