"""Fact enrichment joins.

All are left outer joins with the fact on the left, so the fact row count is
kept (J1, J2) or multiplied by the version count (J3, by definition). The
dimension is on the build side: Catalyst broadcasts it only when its
estimated size is under ``spark.sql.autoBroadcastJoinThreshold`` and AQE
switches to a broadcast at run time only when the shuffled dimension really
is that small; otherwise the join is a sort-merge join, and AQE splits a hot
fact key (a left outer join may split its left side) across several tasks,
each joined with the replicated versions of that key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riverbed.functions.parse import floor_ntz, in_half_open


def _prefixed(dim: DataFrame, prefix: str) -> DataFrame:
    return dim.select(*[F.col(c).alias(prefix + c) for c in dim.columns])


def join_current(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str | None = None,
                 prefix: str = "_d_") -> DataFrame:
    """``fact LEFT JOIN dim ON fact.key = dim.key``; dimension columns come
    back prefixed, so the caller chooses which key to show (the reference
    shows the dimension's, NULL when unmatched)."""
    d = _prefixed(dim, prefix)
    return fact.join(d, fact[fact_key] == d[prefix + (dim_key or fact_key)], "left")


def join_as_of(fact: DataFrame, versions: DataFrame, fact_key: str, fact_ts: str, *,
               dim_key: str | None = None, valid_from: str = "valid_from",
               valid_to: str = "valid_to", prefix: str = "_d_") -> DataFrame:
    """Point-in-interval (SCD2 as-of) left join: equal key and
    ``valid_from <= ts < valid_to`` (open end when NULL).

    Planned as an equi join on the key with the interval as a residual
    condition: no cross product, no custom rule. With non-overlapping
    versions (what ``scd2_from_history`` produces) each fact row matches at
    most once, so the fact row count is kept."""
    d = _prefixed(versions, prefix)
    cond = (fact[fact_key] == d[prefix + (dim_key or fact_key)]) & in_half_open(
        fact[fact_ts], d[prefix + valid_from], d[prefix + valid_to])
    return fact.join(d, cond, "left")


def join_as_of_sweep(fact: DataFrame, versions: DataFrame, key: str, fact_ts: str,
                     version_cols: Sequence[str], *, valid_from: str = "valid_from",
                     prefix: str = "_d_", bucket_unit: str | None = None) -> DataFrame:
    """J2, linear form: union facts and versions, order each key by time (a
    version before a fact at the same instant) and carry the last version
    forward. Valid when the versions of a key are contiguous (SCD2 built by
    ``lead``); a fact before the first version gets NULLs. No pairwise
    comparison at all.

    With ``bucket_unit`` ("day", "hour") the carry runs per (key, bucket),
    so a key that holds a large share of both facts and versions is spread
    over its buckets; each bucket is seeded with the key's last version of
    the earlier buckets, found on a table of one row per (key, bucket) (partly
    aggregated before its shuffle). Both sides are read twice."""
    fcols = fact.columns
    f = fact.select(*fcols, F.col(fact_ts).alias("_t"), F.lit(1).alias("_side"),
                    *[F.lit(None).cast(versions.schema[c].dataType).alias(prefix + c)
                      for c in version_cols])
    v = versions.select(*[F.lit(None).cast(fact.schema[c].dataType).alias(c) if c != key
                          else F.col(key).alias(c) for c in fcols],
                        F.col(valid_from).alias("_t"), F.lit(0).alias("_side"),
                        *[F.col(c).alias(prefix + c) for c in version_cols])
    u = f.unionByName(v)
    part = [key]
    if bucket_unit is not None:
        u = u.withColumn("_b", floor_ntz(F.col("_t"), bucket_unit))
        part = [key, "_b"]
    w = (Window.partitionBy(*part).orderBy(F.col("_t").asc_nulls_first(), "_side")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ver = F.struct(*[F.col(prefix + c).alias(c) for c in version_cols])
    carried = u.select(*fcols, *part[1:], "_side", "_t", F.last(
        F.when(F.col("_side") == 0, ver), ignorenulls=True).over(w).alias("_ver"))
    facts = carried.filter(F.col("_side") == 1)
    if bucket_unit is not None:
        own = F.col("_side") == 0
        seeds = (u.groupBy(key, "_b").agg(F.max_by(F.when(own, ver), F.when(own, F.col("_t"))).alias("_lv"))
                 .withColumn("_seed", F.last("_lv", ignorenulls=True).over(
                     Window.partitionBy(key).orderBy("_b")
                     .rowsBetween(Window.unboundedPreceding, -1)))
                 .select(key, "_b", "_seed"))
        facts = (facts.join(seeds, [key, "_b"], "left")
                 .withColumn("_ver", F.coalesce("_ver", "_seed")))
    # A fact with a NULL key or time never matches (as in the interval join).
    return facts.select(
        *fcols, *[F.when(F.col("_t").isNotNull() & F.col(key).isNotNull(), F.col("_ver")[c]).alias(prefix + c)
                  for c in version_cols])


# A fact is compared with at most so many versions; cards with more take the sweep.
MAX_VERSIONS = 1000
MAX_HOT_KEYS = 10_000


def hot_keys(versions: DataFrame, key: str, max_versions: int = MAX_VERSIONS) -> DataFrame:
    """Keys of more than ``max_versions`` versions: a count with partial
    aggregation over the key column alone."""
    return (versions.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
            .filter((F.col("_n") > max_versions) & F.col(key).isNotNull()).select(key))


def join_as_of_routed(fact: DataFrame, versions: DataFrame, key: str, fact_ts: str, version_cols: Sequence[str], *,
                      valid_from: str = "valid_from", valid_to: str = "valid_to", prefix: str = "_d_",
                      bucket_unit: str = "day", max_versions: int = MAX_VERSIONS,
                      max_hot: int = MAX_HOT_KEYS) -> DataFrame:
    """J2 for any distribution of keys: the equi join with its residual
    interval compares a fact with every version of its key, so keys of more
    than ``max_versions`` versions are taken out of it and swept, by day;
    no fact is ever compared with more, and no key's facts and versions meet in
    one task unless they are few. Without such keys the plan is the equi join's
    alone. The hot keys are looked up once, when the plan is made (at most
    ``max_hot`` names, which are sent to the tasks; with more, all is swept)."""
    hot = [r[0] for r in hot_keys(versions, key, max_versions).limit(max_hot + 1).collect()]
    keep = [*fact.columns, *[prefix + c for c in version_cols]]
    if not hot:
        return join_as_of(fact, versions, key, fact_ts, valid_from=valid_from, valid_to=valid_to,
                          prefix=prefix).select(*keep)
    if len(hot) > max_hot:
        return join_as_of_sweep(fact, versions, key, fact_ts, version_cols, valid_from=valid_from, prefix=prefix,
                                bucket_unit=bucket_unit).select(*keep)
    is_hot = F.coalesce(F.col(key).isin(hot), F.lit(False))
    cold = join_as_of(fact.filter(~is_hot), versions.filter(~is_hot), key, fact_ts, valid_from=valid_from,
                      valid_to=valid_to, prefix=prefix).select(*keep)
    swept = join_as_of_sweep(fact.filter(is_hot), versions.filter(is_hot), key, fact_ts, version_cols,
                             valid_from=valid_from, prefix=prefix, bucket_unit=bucket_unit).select(*keep)
    return cold.unionByName(swept)


def join_all_versions(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str | None = None,
                      prefix: str = "_d_") -> DataFrame:
    """Left join to every version of the key, no interval test (the
    archive form). Rows multiply by the version count of their key."""
    return join_current(fact, dim, fact_key, dim_key, prefix)

