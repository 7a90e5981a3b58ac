"""Validation and reconciliation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .aggregate import money
from .fingerprint import rows_of_differing


def violations(df: DataFrame, checks: Mapping[str, Column]) -> DataFrame:
    """(check_name, violations, status) of row conditions that must not hold, in one pass."""
    one = df.agg(*[F.count(F.when(c, 1)).alias(f"_{k}") for k, c in enumerate(checks.values())])
    rows = [F.struct(F.lit(n).alias("check_name"), F.col(f"_{k}").alias("violations")) for k, n in enumerate(checks)]
    out = one.select(F.explode(F.array(*rows)).alias("x")).select("x.*")
    return out.withColumn("status", F.when(F.col("violations") == 0, "PASS").otherwise("FAIL"))


def output_invariants(core: str = "core") -> dict[str, Column]:
    """What must not be in gated rows."""
    t = F.col("match_tier")
    return {
        "tier vocabulary": ~t.isin("family", "category", "manufacturer", "hs_prior", ""),
        "unmatched has no tier": (F.col("match_status") != "Matched") & (t != ""),
        "category has product": (t == "category") & (F.col("product") == ""),
        "manufacturer has maker": (t == "manufacturer") & (F.col("maker") == ""),
        "included is core": (F.col("include") == "Y") & (F.col("match_scope") != core),
        "included is valid": (F.col("include") == "Y") & (F.col("ref_valid") != "Y"),
        "included has no flag": (F.col("include") == "Y") & (F.col("scope_flag") != ""),
        "included is mapped": (F.col("include") == "Y") & (F.col("qa_status") != "Mapped"),
    }


def anchors(observed: DataFrame, pins: DataFrame, keys: Sequence[str], tolerance: float = 0.005) -> DataFrame:
    """Observed rows exactly, and value within a tolerance, as pinned."""
    p = pins.select(*keys, F.col("n_rows").alias("pin_rows"), F.col("value").alias("pin_value"))
    out = observed.join(p, list(keys))
    ok = (F.col("n_rows") == F.col("pin_rows")) & (F.abs(F.col("value") - F.col("pin_value")) <= tolerance * F.abs(F.col("pin_value")))
    return out.withColumn("status", F.when(ok, "PASS").otherwise("FAIL"))


def partition_reconciliation(source: DataFrame, parts: DataFrame, key: str) -> DataFrame:
    """C4: (check_name, violations, status): equal rows and value, the same ids, none twice."""
    a = source.agg(F.count("*").alias("n"), F.sum(money("value")).alias("v"))
    b = parts.agg(F.count("*").alias("m"), F.sum(money("value")).alias("w"))
    both = source.select(key, F.lit(1).alias("s")).join(parts.select(key, F.lit(1).alias("p")).distinct(), key, "full_outer")
    ids = both.agg(F.count(F.when(F.col("s").isNull() | F.col("p").isNull(), 1)).alias("ids"))
    twice = parts.groupBy(key).agg(F.count("*").alias("c")).agg(F.count(F.when(F.col("c") > 1, 1)).alias("dups"))
    one = a.crossJoin(b).crossJoin(ids).crossJoin(twice)  # one row each
    checks = {
        "rows": F.abs(F.col("n") - F.col("m")), "value": F.when(F.col("v").eqNullSafe(F.col("w")), 0).otherwise(1),
        "ids": F.col("ids"), "duplicates": F.col("dups"),
    }
    out = one.select(F.explode(F.array(*[F.struct(F.lit(n).alias("check_name"), c.cast("bigint").alias("violations")) for n, c in checks.items()])).alias("x")).select("x.*")
    return out.withColumn("status", F.when(F.col("violations") == 0, "PASS").otherwise("FAIL"))


def compare_aggregates(a: DataFrame, b: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """Keys missing on either side and absolute differences of measures, over a full outer join of what
    lies in buckets whose fingerprints differ; other rows are equal and add nothing."""
    a, b = rows_of_differing(a.select(*keys, *measures), b.select(*keys, *measures), keys, measures)
    x = a.select(*keys, *[F.col(m).alias(f"a_{m}") for m in measures], F.lit(1).alias("in_a"))
    y = b.select(*keys, *[F.col(m).alias(f"b_{m}") for m in measures], F.lit(1).alias("in_b"))
    j = x.join(y, list(keys), "full_outer")
    gap = lambda m: F.abs(F.coalesce(f"a_{m}", F.lit(0)).cast("decimal(20,2)") - F.coalesce(f"b_{m}", F.lit(0)).cast("decimal(20,2)"))
    return j.agg(
        F.count(F.when(F.col("in_a").isNull(), 1)).alias("only_b"), F.count(F.when(F.col("in_b").isNull(), 1)).alias("only_a"),
        *[F.coalesce(F.sum(gap(m)).cast("double"), F.lit(0.0)).alias(f"delta_{m}") for m in measures],
    )


def unknown_keys(df: DataFrame, key: Column, known: DataFrame, row_id: str, samples: int = 5) -> DataFrame:
    """(key, n_rows, sample_ids) of keys that aren't known; the samples are the least ids.

    Each key's least ids are taken before they are collected, so a frequent key stays small.
    """
    from .review import ranked

    rows = df.select(F.col(row_id), key.alias("key")).join(known.select("key").distinct(), "key", "left_anti")
    counts = rows.groupBy("key").agg(F.count("*").alias("n_rows"))
    few = ranked(rows, ["key"], [row_id], samples).groupBy("key").agg(F.array_join(F.array_sort(F.collect_list(row_id)), ",").alias("sample_ids"))
    return counts.join(few, "key")


def acceptance(checks: DataFrame) -> DataFrame:
    """(n_checks, n_failed, accepted)."""
    return checks.agg(F.count("*").alias("n_checks"), F.count(F.when(F.col("status") == "FAIL", 1)).alias("n_failed")).withColumn("accepted", F.col("n_failed") == 0)


def assert_accepted(checks: DataFrame) -> DataFrame:
    """``checks``, or an error that names the failed ones."""
    bad = [r.check_name for r in checks.filter("status = 'FAIL'").limit(50).collect()]
    if bad:
        raise ValueError(f"failed: {bad}")
    return checks


def status_summary(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(source, status, n_checks) with one row for each failure as detail."""
    rows = None
    for name, df in tables.items():
        df = df.select(F.lit(name).alias("source"), "check_name", "status")
        rows = df if rows is None else rows.unionByName(df)
    summary = rows.groupBy("source", "status").agg(F.count("*").alias("n_checks"))
    detail = rows.filter("status = 'FAIL'").select("source", "status", "check_name")
    return summary.unionByName(detail, allowMissingColumns=True)
