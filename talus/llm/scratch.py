"""Tables written to the folder that driver and executors share, to cut lineage."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..sources.stored import shared_folder, stored as materialize

__all__ = ["materialize", "shared_folder", "small_side"]

#: A side of a join is broadcast only when a count has shown that it holds at most this many rows.
BROADCAST_ROWS = 500_000


def small_side(df: DataFrame, rows: int) -> DataFrame:
    """df with a broadcast hint if its counted rows stay under BROADCAST_ROWS; the plan shuffles it otherwise."""
    from pyspark.sql import functions as F

    return F.broadcast(df) if rows <= BROADCAST_ROWS else df
