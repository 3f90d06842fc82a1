"""Size checks for choosing between plans that give the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame


def estimated_bytes(rows: DataFrame) -> int:
    """The optimizer's size estimate (exact file sizes for a plain scan)."""
    stats = rows._jdf.queryExecution().optimizedPlan().stats()
    return int(str(stats.sizeInBytes()))


def exchanged(rows: DataFrame) -> bool:
    """Whether the plan deals rows out by key, in as many parts as their size asks for."""
    return "Exchange hashpartitioning" in rows._jdf.queryExecution().executedPlan().toString()


def broadcast_limit(rows: DataFrame) -> int:
    """``spark.sql.autoBroadcastJoinThreshold`` in bytes."""
    return int(rows.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold())


def fits_broadcast(rows: DataFrame) -> bool:
    return estimated_bytes(rows) <= broadcast_limit(rows)
