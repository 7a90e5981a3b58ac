"""Learned priors (K1-K18): dominant labels by code, token and maker, applied under gates."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tradeweave.functions import text as X
from tradeweave.sources.tables import small, staged

from .lexicon import dominant, first_by


def attach_labels(rows: DataFrame, truth: DataFrame, key: str, order: Iterable[str]) -> DataFrame:
    """K1: ``rows`` with the columns of the first ground-truth row of their key."""
    return rows.join(first_by(truth, [key], list(order)), key, "left")


def train_rows(rows: DataFrame, test_keys: DataFrame, key: str) -> DataFrame:
    """K2: the rows that aren't held out."""
    return rows.join(test_keys.select(key).distinct(), key, "left_anti")


def parent_of(train: DataFrame, label: str = "label", parent: str = "parent") -> DataFrame:
    """K4: (label, parent): each label's dominant parent."""
    return dominant(train, [label], parent).select(label, parent)


def key_prior(train: DataFrame, keys: list[str], label: str = "label", min_n: int = 3, min_share: float = 0.5) -> DataFrame:
    """K5, K6: (*keys, label, n, total, share) where the dominant label is frequent and pure."""
    rows = train
    for k in keys:
        rows = rows.filter(~X.is_blank(k, ("",)))
    return dominant(rows, keys, label).filter((F.col("n") >= min_n) & (F.col("share") >= min_share))


def token_rows(train: DataFrame, text: str, columns: Iterable[str], stop: Iterable[str] = ()) -> DataFrame:
    """One row for each distinct token of a text, with ``columns``."""
    return train.select(*columns, F.explode(X.tokens(text, 3, stop)).alias("token"))


def token_prior(train: DataFrame, text: str, code: str, label: str = "label", min_n: int = 5, min_share: float = 0.7, stop: Iterable[str] = ()) -> DataFrame:
    """K7, K9: (code, token) to the dominant label."""
    return key_prior(token_rows(train, text, [code, label], stop), [code, "token"], label, min_n, min_share)


def transfer_prior(
    train: DataFrame, text: str, coarse: str, vocabulary: DataFrame, label: str = "label",
    global_n: int = 5, global_share: float = 0.7, min_n: int = 5, min_share: float = 0.7, contained: bool = True, stop: Iterable[str] = (),
) -> DataFrame:
    """K8: (coarse code, token) to a label, fit for other markets: the token is of the vocabulary,
    pure over all codes and within the code, and stands in the label it predicts."""
    rows = token_rows(train, text, [coarse, label], stop).join(vocabulary.select("token").distinct(), "token")
    safe = key_prior(rows, ["token"], label, global_n, global_share).select("token")
    out = key_prior(rows.join(safe, "token"), [coarse, "token"], label, min_n, min_share)
    return out.filter(F.array_contains(X.tokens(label), F.col("token"))) if contained else out


def corroboration_vocabulary(train: DataFrame, text: str, label: str = "label", min_n: int = 3, min_share: float = 0.5, stop: Iterable[str] = ()) -> DataFrame:
    """(label, words): the tokens whose most frequent label this is, often and purely enough,
    with the words of the label's own name."""
    rows = train.select(label, F.explode(F.array_distinct(F.transform(X.tokens(text, 3, stop), X.sing))).alias("token"))
    good = key_prior(rows, ["token"], label, min_n, min_share)
    learned = good.groupBy(label).agg(F.collect_set("token").alias("w"))
    names = train.filter(~X.is_blank(label, ("",))).select(label).distinct()
    none = F.expr("cast(array() as array<string>)")
    words = F.array_sort(F.array_union(F.coalesce("w", none), X.cue_tokens(label)))
    return names.join(learned, label, "left").select(F.col(label).alias("label"), words.alias("words"))


def family_postings(train: DataFrame, text: str, code: str, family: str, min_rows: int = 3, stop: Iterable[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Postings (code, feature, family, cnt, df) and families (code, family, rows, nf), of codes
    with enough rows; df counts the families of a code that have the feature."""
    rows = train.filter(~X.is_blank(family, ("",)) & F.col(code).isNotNull())
    families = rows.groupBy(code, family).agg(F.count("*").alias("rows"))
    codes = families.groupBy(code).agg(F.count("*").alias("nf"), F.sum("rows").alias("total")).filter(F.col("total") >= min_rows)
    families = staged(families.join(codes.drop("total"), code), "families")
    # Codes go as a whole, and before their rows are taken apart; what is left is dealt out by feature once.
    rows = rows.join(small(families.select(code, family)), [code, family], "left_semi")
    cnt = rows.select(code, family, F.explode(X.family_features(text, stop)).alias("feature")).groupBy(code, "feature", family).agg(F.count("*").alias("cnt"))
    return cnt.withColumn("df", F.count("*").over(Window.partitionBy(code, "feature"))), families


def score_families(rows: DataFrame, key: str, text: str, code: str, postings: DataFrame, families: DataFrame, family: str, stop: Iterable[str] = ()) -> DataFrame:
    """(key, family, score): the family of the highest score; where no feature fires, the
    code's most frequent one with score 0.

    score = sum of w * idf * ln(1 + cnt), w 4 for codes, 2 for pairs, 1 for words; and 0.01 of the
    logarithm of the family's rows. Rounded to nine places; of equals the first by name.
    """
    # Rows are dealt out by key before they are taken apart, as their features are many times as large.
    dealt = rows.select(key, code, text).repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)
    f = dealt.select(key, code, F.explode(X.family_features(text, stop)).alias("feature")).groupBy(key, code, "feature").agg(F.count("*").alias("times"))
    hits = f.join(postings, [code, "feature"]).join(small(families), [code, family])
    w = F.when(F.col("feature").startswith("C_"), 4.0).when(F.col("feature").contains("_"), 2.0).otherwise(1.0)
    idf = F.log((F.col("nf") + 1) / (F.col("df") + 1)) + 0.1
    # Sums of whole billionths don't depend on the order of rows.
    part = F.round(w * idf * F.log(1.0 + F.col("cnt")) * F.col("times") * 1e9).cast("decimal(38,0)")
    scores = hits.groupBy(key, family, "rows").agg(F.sum(part).alias("s"))
    scores = scores.select(key, family, F.round(F.col("s").cast("double") / 1e9 + 0.01 * F.log(1.0 + F.col("rows")), 6).alias("score"))
    best = scores.groupBy(key).agg(F.min(F.struct((-F.col("score")).alias("m"), family)).alias("b")).select(key, F.col(f"b.{family}").alias(family), (-F.col("b.m")).alias("score"))
    best = staged(best, "best-families")  # read twice
    common = families.groupBy(code).agg(F.min(F.struct((-F.col("rows")).alias("m"), family)).alias("c"))
    rest = rows.select(key, code).join(common, code).join(best.select(key), key, "left_anti").select(key, F.col(f"c.{family}").alias(family), F.lit(0.0).alias("score"))
    return best.unionByName(rest)


def best_token(rows: DataFrame, key: str, text: str, code: str, prior: DataFrame, label: str = "label", stop: Iterable[str] = ()) -> DataFrame:
    """(key, label, share): the purest token rule that fires; of equals by n, then token."""
    hits = token_rows(rows, text, [key, code], stop).join(prior.select(code, "token", label, "n", "share"), [code, "token"])
    best = hits.groupBy(key).agg(F.min(F.struct((-F.col("share")).alias("s"), (-F.col("n")).alias("m"), "token", label)).alias("b"))
    return best.select(key, F.col(f"b.{label}").alias(label), (-F.col("b.s")).alias("share"))


def apply_product_prior(
    rows: DataFrame, key: str, text: str, code: str, coarse: str, maker: str, priors: dict[str, DataFrame],
    vocabulary: DataFrame | None = None, veto: Column | None = None, cross_market: bool = False, stop: Iterable[str] = (),
) -> DataFrame:
    """``rows`` with predicted label, via and confidence.

    Rows of tier family and category are left alone. The purest (code, token) rule goes first, then
    the purest (coarse, token) rule; rows without a product fall back to (code, maker), then (code),
    but not across markets, where those rules don't hold. ``veto`` (over ``predicted``) and a text
    that shares no word with the label's vocabulary reject a prediction.
    """
    open_rows = rows.filter(~F.col("match_tier").isin("family", "category"))
    one = best_token(open_rows, key, text, code, priors["token"], stop=stop).withColumns({"via": F.lit("token"), "rank": F.lit(0)})
    found = one
    if "transfer" in priors:
        two = best_token(open_rows, key, text, coarse, priors["transfer"], stop=stop)
        found = found.unionByName(two.withColumns({"via": F.lit("transfer"), "rank": F.lit(1)}))
    if not cross_market:
        empty = open_rows.filter(X.is_blank("product", ("",)))
        three = empty.join(priors["maker"].select(code, maker, "label", "share"), [code, maker]).select(key, "label", "share")
        four = empty.join(priors["code"].select(code, "label", "share"), code).select(key, "label", "share")
        found = found.unionByName(three.withColumns({"via": F.lit("maker"), "rank": F.lit(2)})).unionByName(four.withColumns({"via": F.lit("code"), "rank": F.lit(3)}))
    best = found.groupBy(key).agg(F.min(F.struct("rank", "label", "share", "via")).alias("p"))
    out = rows.join(best, key, "left").withColumns({"predicted": F.col("p.label"), "share": F.col("p.share"), "via": F.col("p.via")}).drop("p")
    ok = F.col("predicted").isNotNull()
    if veto is not None:
        ok = ok & ~veto
    if vocabulary is not None:
        from .guards import corroborated

        out = corroborated(out, "predicted", text, vocabulary, stop)
        ok = ok & F.col("supported")
        out = out.withColumn("_ok", ok).drop("supported")
    else:
        out = out.withColumn("_ok", ok)
    confidence = F.when(F.col("_ok"), F.when(F.col("share") >= 0.85, "high").otherwise("med"))
    return out.withColumns(
        {
            "confidence": confidence,
            "rejected": F.col("predicted").isNotNull() & ~F.col("_ok"),
            "match_tier": F.when(F.col("_ok"), "hs_prior").otherwise(F.col("match_tier")),
            "product": F.when(F.col("_ok"), F.col("predicted")).otherwise(F.col("product")),
        }
    ).drop("_ok")


def fill_maker(rows: DataFrame, key: str, text: str, code: str, coarse: str, maker: str, prior: DataFrame, transfer: DataFrame | None = None, stop: Iterable[str] = ()) -> DataFrame:
    """Blank makers filled by the purest (code, token) rule, else by (coarse, token)."""
    need = rows.filter(X.is_blank(maker))
    found = best_token(need, key, text, code, prior, maker, stop).withColumn("rank", F.lit(0))
    if transfer is not None:
        found = found.unionByName(best_token(need, key, text, coarse, transfer, maker, stop).withColumn("rank", F.lit(1)))
    best = found.groupBy(key).agg(F.min(F.struct("rank", F.col(maker).alias("m")))["m"].alias("_maker"))
    return rows.join(best, key, "left").withColumn(maker, F.coalesce("_maker", maker)).drop("_maker")


def fill_family(rows: DataFrame, key: str, text: str, code: str, postings: DataFrame, families: DataFrame, family: str, stop: Iterable[str] = ()) -> DataFrame:
    """Blank families of rows that tier 1 didn't match, filled by the scored family."""
    need = rows.filter((F.col("match_tier") != "family") & X.is_blank(family)).drop(family)
    found = score_families(need, key, text, code, postings, families, family, stop).select(key, F.col(family).alias("_family"))
    return rows.join(found, key, "left").withColumn(family, F.coalesce("_family", family)).drop("_family")


def transfer_impact(rows: DataFrame, key: str, text: str, coarse: str, transfer: DataFrame, value: str, stop: Iterable[str] = ()) -> DataFrame:
    """(label, n_rows, value) that transfer rules would recover among rows without a product."""
    hits = best_token(rows.filter(X.is_blank("product", ("",))), key, text, coarse, transfer, stop=stop)
    joined = hits.join(rows.select(key, value), key)
    return joined.groupBy("label").agg(F.count("*").alias("n_rows"), F.sum(X.safe_number(value).cast("decimal(18,2)")).cast("double").alias("value"))


def ceiling(train: DataFrame, test: DataFrame, keys: list[str], thresholds: Iterable[float], label: str = "label", min_n: int = 3) -> DataFrame:
    """(threshold, n_fired, n_right) of a key's prior over test rows, for several purities."""
    prior = key_prior(train, keys, label, min_n, 0.0).select(*keys, F.col(label).alias("_p"), "share")
    hits = test.join(prior, keys)
    each = hits.select(label, "_p", F.explode(F.filter(F.array(*[F.lit(float(t)) for t in thresholds]), lambda t: F.col("share") >= t)).alias("threshold"))
    return each.groupBy("threshold").agg(F.count("*").alias("n_fired"), F.count(F.when(F.col("_p") == F.col(label), 1)).alias("n_right"))


