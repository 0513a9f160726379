"""Row counts of a load (A8): sent, skipped, rejected per reason.

Counts are Spark aggregates over the kept and rejected rows (or ``observe``
metrics collected while the rows are written), never driver loops.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def load_counts(kept: DataFrame, rejects: DataFrame, reason: str = "reason") -> DataFrame:
    """One row per outcome: ``('kept', n)`` and ``(<reason>, n)`` for every reject reason."""
    ok = kept.agg(F.lit("kept").alias("outcome"), F.count(F.lit(1)).alias("n"))
    bad = rejects.groupBy(F.col(reason).alias("outcome")).agg(F.count(F.lit(1)).alias("n"))
    return ok.unionByName(bad)


def outcome_counts(flagged: DataFrame, reason: str = "reason") -> DataFrame:
    """The same counts from one pass over flagged rows (reason NULL = kept).

    A ``kept`` row is there even when nothing was kept.
    """
    per = flagged.groupBy(F.coalesce(F.col(reason), F.lit("kept")).alias("outcome")).agg(
        F.count(F.lit(1)).alias("n"))
    none = per.sparkSession.range(1).select(F.lit("kept").alias("outcome"), F.lit(0).cast("bigint").alias("n"))
    return per.unionByName(none).groupBy("outcome").agg(F.sum("n").alias("n"))


def observed(df: DataFrame, name: str, **conditions) -> tuple[DataFrame, Observation]:
    """Attach counters that are filled while ``df`` is consumed by its action.

    ``conditions`` maps counter name -> boolean column (``count_if``); a total
    ``rows`` counter is always present. Read ``observation.get`` after the
    action, e.g. the number of points written including filtered ones.
    """
    obs = Observation(name)
    metrics = [F.count(F.lit(1)).alias("rows")]
    metrics += [F.count_if(c).alias(k) for k, c in conditions.items()]
    return df.observe(obs, *metrics), obs
