"""The first rows of groups by quotas that are data, without sorting a group in one task (for V9 and others)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tradeweave.sources.tables import staged


def numbered(rows: DataFrame, by: Sequence[str], order: Sequence[Column], name: str = "n") -> DataFrame:
    """``rows`` with their numbers, from 1 on, in each group by ``order``, which must tell rows apart.

    Rows are sorted by range over all, so a group spreads over tasks; only the first place and the count of
    each group in each task's range are joined back.
    """
    keys = [*(F.col(c).asc_nulls_first() for c in by), *order]
    at = staged(rows.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_m", F.monotonically_increasing_id()), "sorted")
    part = F.shiftright("_m", 33)
    runs = at.groupBy(*(F.col(c).alias(f"_{c}") for c in by), part.alias("_p")).agg(F.min("_m").alias("_first"), F.count("*").alias("_c"))
    before = F.sum("_c").over(Window.partitionBy(*(f"_{c}" for c in by)).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1))
    runs = runs.withColumn("_before", F.coalesce(before, F.lit(0)))
    same = part == F.col("_p")
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    out = at.join(runs, same).withColumn(name, F.col("_m") - F.col("_first") + F.col("_before") + 1)
    return out.drop("_m", "_p", "_first", "_c", "_before", *(f"_{c}" for c in by))


def first_by_quota(rows: DataFrame, by: Sequence[str], place: Column, key: str, quotas: DataFrame, bits: int = 12) -> DataFrame:
    """The rows of each group with the least ``place`` (a long from 0 to 2**31 - 1), of equal places by
    ``key``: as many as the group's ``quota`` in ``quotas`` (by, quota); groups without one have none.

    A histogram of places, 2**``bits`` bins a group, merges over tasks and tells the bin in which a quota
    ends. Rows of bins before it are taken as they are; only rows of that bin are ranked, by range.
    """
    at = rows.withColumns({"_place": place.cast("long"), "_bin": F.shiftright(place.cast("long"), 31 - bits)})
    sizes = at.groupBy(*by, "_bin").agg(F.count("*").alias("_c"))
    sum_to = F.sum("_c").over(Window.partitionBy(*by).orderBy("_bin"))
    own = quotas.select(*(F.col(c).alias(f"_{c}") for c in by), F.col("quota").alias("_quota"))
    same = F.lit(True)
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    cut = sizes.withColumn("_to", sum_to).join(own, same).filter(F.col("_to") - F.col("_c") < F.col("_quota"))
    # The bins that a quota reaches: whole ones, and the one in which it ends, with what is left of it.
    rest = F.col("_quota") - (F.col("_to") - F.col("_c"))
    cut = staged(cut.select(*(f"_{c}" for c in by), F.col("_bin").alias("_b"), F.when(F.col("_to") > F.col("_quota"), rest).alias("_rest")), "cut")
    taken = at.join(cut, same & (F.col("_bin") == F.col("_b"))).drop("_b", *(f"_{c}" for c in by))
    whole, partly = taken.filter("_rest is null"), taken.filter("_rest is not null")
    last = numbered(partly, by, [F.col("_place").asc(), F.col(key).asc()], "_n").filter(F.col("_n") <= F.col("_rest")).drop("_n")
    return whole.unionByName(last).drop("_place", "_bin", "_rest")
