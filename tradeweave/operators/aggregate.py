"""Value bounds, roll-ups and summaries."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeweave.functions import text as X

from .mapping import BOUND

DIMS = ("country", "segment", "sub_segment", "product", "family", "maker")


def money(c: Column | str) -> Column:
    """A value as a decimal of two places: sums don't depend on the order of rows."""
    return X.safe_number(c).cast("decimal(18,2)")


def total(c: Column) -> Column:
    return F.coalesce(F.sum(c).cast("double"), F.lit(0.0))


def value_bounds(df: DataFrame, dims: Sequence[str] = DIMS) -> DataFrame:
    """Upper bound over bound rows, lower bound over tier-1 rows, by value and by count."""
    v, one = money("value"), F.col("match_tier") == "family"
    return df.filter(F.col("match_tier").isin(*BOUND)).groupBy(*dims).agg(
        total(F.when(one, v)).alias("lower_value"), total(v).alias("upper_value"),
        F.count(F.when(one, 1)).alias("lower_rows"), F.count("*").alias("upper_rows"),
    )


def trusted(df: DataFrame, core: str = "core") -> DataFrame:
    """D2."""
    return df.filter(F.col("match_tier").isin(*BOUND) & (F.col("match_scope") == core) & (F.col("include") == "Y"))


def line_items(df: DataFrame, dims: Sequence[str]) -> DataFrame:
    """D3: revenue, volume, least, largest and average unit price; the average is null for no volume."""
    q = X.safe_number("quantity").cast("decimal(18,2)")
    out = df.groupBy(*dims).agg(
        total(money("value")).alias("revenue"), total(q).alias("volume"), F.min("unit_price").alias("min_price"), F.max("unit_price").alias("max_price"), F.count("*").alias("shipments")
    )
    return out.withColumn("avg_price", F.when(F.col("volume") != 0, F.col("revenue") / F.col("volume")))


def roll_up(df: DataFrame, dims: Sequence[str]) -> DataFrame:
    """The line items' sums at each level of the hierarchy; ``level`` counts its dimensions. One pass sums the
    finest level; the others are made of its sums, so groups are expanded and not rows."""
    q = X.safe_number("quantity").cast("decimal(18,2)")
    fine = df.groupBy(*dims).agg(F.sum(money("value")).alias("_v"), F.sum(q).alias("_q"), F.min("unit_price").alias("_a"), F.max("unit_price").alias("_b"), F.count("*").alias("_n"))
    return fine.rollup(*dims).agg(
        total(F.col("_v")).alias("revenue"), total(F.col("_q")).alias("volume"), F.min("_a").alias("min_price"), F.max("_b").alias("max_price"),
        F.coalesce(F.sum("_n"), F.lit(0)).alias("shipments"), (len(dims) - F.bit_count(F.grouping_id())).cast("int").alias("level"),
    ).filter("shipments > 0")


def scope_table(df: DataFrame) -> DataFrame:
    """Trusted rows of the core scope, rows pending in the extended scope, and their total."""
    bucket = F.when(F.col("include") == "Y", "core trusted").when(F.col("qa_status") == "Review - extended scope", "extended pending")
    out = df.withColumn("bucket", bucket).filter("bucket is not null").rollup("bucket").agg(F.count("*").alias("n_rows"), total(money("value")).alias("value"))
    return out.filter("n_rows > 0").fillna("total", ["bucket"])


def match_summary(df: DataFrame) -> DataFrame:
    """D6."""
    return df.groupBy("match_tier", "segment", "sub_segment", "product").agg(F.count("*").alias("n_rows"))


def qa_by_status(df: DataFrame) -> DataFrame:
    """Rows and value by status."""
    return df.groupBy("qa_status").agg(F.count("*").alias("n_rows"), total(money("value")).alias("value"))


def qa_top_labels(df: DataFrame, label: str, condition: Column, k: int) -> DataFrame:
    """The ``k`` labels of most value among rows that meet a condition."""
    rows = df.filter(condition).groupBy(label).agg(F.count("*").alias("n_rows"), total(money("value")).alias("value"))
    return rows.orderBy(F.desc("value"), label).limit(k)


def dashboard(df: DataFrame, dims: Sequence[str]) -> DataFrame:
    """Rows, quantity, value and unit price."""
    q = X.safe_number("quantity").cast("decimal(18,2)")
    out = df.groupBy(*dims).agg(F.count("*").alias("n_rows"), total(q).alias("quantity"), total(money("value")).alias("value"))
    return out.withColumn("unit_price", F.when(F.col("quantity") > 0, F.col("value") / F.col("quantity")))


def country_comparison(bounds: DataFrame, condition: Column | None = None, least: float = 0.0) -> DataFrame:
    """Lower and upper bound, gap, coverage and lines by country, of bounds that pass filters."""
    rows = bounds.filter(F.col("upper_value") >= least)
    if condition is not None:
        rows = rows.filter(condition)
    cents = lambda c: F.sum(F.col(c).cast("decimal(20,2)")).cast("double")
    out = rows.groupBy("country").agg(cents("lower_value").alias("lower_value"), cents("upper_value").alias("upper_value"), F.count("*").alias("n_lines"))
    return out.withColumns({"gap": F.round(F.col("upper_value") - F.col("lower_value"), 2), "coverage": F.when(F.col("upper_value") > 0, F.col("lower_value") / F.col("upper_value"))})


def tier_summary(df: DataFrame, tier: str) -> DataFrame:
    """Rows and value by tier with a total row."""
    out = df.rollup(tier).agg(F.count("*").alias("n_rows"), total(money("value")).alias("value"), F.grouping_id().alias("_g"))
    return out.withColumn(tier, F.when(F.col("_g") == 1, "total").otherwise(F.col(tier))).drop("_g").filter("n_rows > 0")


def review_burden(df: DataFrame, review: Column, thresholds: Iterable[float]) -> DataFrame:
    """Rows and value under review from each value threshold on, in one pass."""
    rows = df.filter(review).select(money("value").alias("v"))
    each = rows.select("v", F.explode(F.filter(F.array(*[F.lit(float(t)) for t in thresholds]), lambda t: F.col("v") >= t)).alias("threshold"))
    return each.groupBy("threshold").agg(F.count("*").alias("n_rows"), F.sum("v").cast("double").alias("value"))


def compliance_metrics(df: DataFrame) -> DataFrame:
    """Precision and recall proxies by rows and value for each market and year."""
    v, t, r = money("value"), F.col("include") == "Y", F.col("qa_status").startswith("Review")
    out = df.groupBy("country", "year").agg(
        F.count(F.when(t, 1)).alias("trusted_rows"), F.count(F.when(r, 1)).alias("review_rows"), F.count("*").alias("n_rows"),
        F.count(F.when(t & (F.col("ref_valid") == "Y") & (F.col("match_tier") == "family"), 1)).alias("strict_rows"),
        total(F.when(t, v)).alias("trusted_value"), total(F.when(r, v)).alias("review_value"),
    )
    return out.withColumns(
        {
            "precision_proxy": F.when(F.col("trusted_rows") > 0, F.col("strict_rows") / F.col("trusted_rows")),
            "recall_proxy": F.when(F.col("trusted_rows") + F.col("review_rows") > 0, F.col("trusted_rows") / (F.col("trusted_rows") + F.col("review_rows"))),
            "value_recall_proxy": F.when(F.col("trusted_value") + F.col("review_value") > 0, F.col("trusted_value") / (F.col("trusted_value") + F.col("review_value"))),
        }
    )
