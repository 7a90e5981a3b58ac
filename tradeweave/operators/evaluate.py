"""Evaluation and sampling."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeweave.functions import text as X

from .quota import first_by_quota

from .aggregate import money, total


def overlap(a: Column | str, b: Column | str, stop: Iterable[str] = ()) -> Column:
    """V1: a shared token, or a shared prefix of four characters among longer tokens."""
    x, y = X.content_tokens(a, stop), X.content_tokens(b, stop)
    prefix = lambda t: F.transform(F.filter(t, lambda w: F.length(w) >= 4), lambda w: F.substring(w, 1, 4))
    return F.coalesce(F.arrays_overlap(x, y) | F.arrays_overlap(prefix(x), prefix(y)), F.lit(False))


def agrees(a: Column | str, b: Column | str, stop: Iterable[str] = ()) -> Column:
    """V2: one normal form within the other, or an overlap."""
    x, y = X.desc_key(a), X.desc_key(b)
    return (x != "") & (y != "") & (x.contains(y) | y.contains(x) | overlap(a, b, stop))


def overall(df: DataFrame, predicted: str, actual: str, by: Iterable[str] = ()) -> DataFrame:
    """V3, V4: n, fired, right, wrong, missed, recall and precision, over all or by columns."""
    has, fires, ok = X.text(actual) != "", X.text(predicted) != "", agrees(predicted, actual)
    out = df.groupBy(*by).agg(
        F.count(F.when(has, 1)).alias("n"), F.count(F.when(has & fires, 1)).alias("fired"), F.count(F.when(has & fires & ok, 1)).alias("right"),
        F.count(F.when(has & fires & ~ok, 1)).alias("wrong"), F.count(F.when(has & ~fires, 1)).alias("missed"),
    )
    return out.withColumns({"recall": F.when(F.col("n") > 0, F.col("right") / F.col("n")), "precision": F.when(F.col("fired") > 0, F.col("right") / F.col("fired"))})


def worst_buckets(df: DataFrame, predicted: str, actual: str, k: int, by: Iterable[str] = ()) -> DataFrame:
    """V5, V6: the confusions (predicted, actual, n_rows) of most rows, also by other columns."""
    wrong = df.filter((X.text(actual) != "") & (X.text(predicted) != "") & ~agrees(predicted, actual))
    out = wrong.groupBy(*by, F.col(predicted).alias("predicted"), F.col(actual).alias("actual")).agg(F.count("*").alias("n_rows"))
    return out.orderBy(F.desc("n_rows"), "predicted", "actual", *by).limit(k)


def keyword_precision(df: DataFrame, keyword: str, right: Column, least: int = 15, low: float = 0.5, high: float = 0.8) -> DataFrame:
    """V5, V7: (keyword, n_rows, precision, value, verdict) of keywords with enough rows."""
    out = df.groupBy(keyword).agg(F.count("*").alias("n_rows"), F.avg(right.cast("int")).alias("precision"), total(money("value")).alias("value"))
    verdict = F.when(F.col("precision") >= high, "keep").when(F.col("precision") >= low, "watch").otherwise("drop")
    return out.filter(F.col("n_rows") >= least).withColumn("verdict", verdict)


def split_keys(df: DataFrame, key: str, share: float = 0.3) -> DataFrame:
    """V8: (key, is_test) by hash."""
    return df.select(key, X.held_out(F.col(key).cast("string"), share).alias("is_test")).distinct()


def seeded_sample(df: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    """V9: the ``n`` rows that come first by a hash of key and seed: the same for any partitioning. However
    many they are, they aren't sorted in one task."""
    digest = F.md5(F.concat_ws(":", F.col(key).cast("string"), F.lit(str(seed))))
    place = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
    rows = df.withColumns({"_all": F.lit(0), "_digest": digest})
    quota = df.sparkSession.range(1).select(F.lit(0).alias("_all"), F.lit(n).alias("quota"))
    # Equal leading bits are told apart by the whole digest, then by the key.
    return first_by_quota(rows.withColumn("_tie", F.struct("_digest", key)), ["_all"], F.shiftright(place, 1), "_tie", quota).drop("_all", "_digest", "_tie")


def snapshot(df: DataFrame, label: str) -> DataFrame:
    """Rows and value by tier, proxies, and review rows of high value, in one pass."""
    from .evidence import EXCLUDED, REVIEW, TRUSTED, output_tier

    tier, v = output_tier(), money("value")
    out = df.agg(
        F.lit(label).alias("label"), F.count("*").alias("n_rows"),
        *[F.count(F.when(tier == t, 1)).alias(f"{n}_rows") for n, t in (("trusted", TRUSTED), ("review", REVIEW), ("excluded", EXCLUDED))],
        *[total(F.when(tier == t, v)).alias(f"{n}_value") for n, t in (("trusted", TRUSTED), ("review", REVIEW))],
        F.count(F.when((tier == REVIEW) & (X.safe_number("value") >= 50_000), 1)).alias("high_value_review"),
    )
    return out.withColumn("capture_proxy", F.when(F.col("n_rows") > 0, (F.col("trusted_rows") + F.col("review_rows")) / F.col("n_rows")))
