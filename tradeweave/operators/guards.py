"""Guards that release or veto a hit (G1-G5), as boolean columns or joins."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeweave.functions import predicates as P
from tradeweave.functions import text as X


def conflict(product: Column | str, text: Column | str, rules: Sequence[Mapping]) -> Column:
    """G1: whether a rule's cue is in the product, a forbidden word in the text and none allowed."""
    out = F.lit(False)
    for r in rules:
        fits = F.lower(X.text(product)).contains(r["product_cue"])
        out = out | (fits & P.has_cue(text, r["forbid"]) & ~P.has_cue(text, r["allow"]))
    return out


def inconsistent(df: DataFrame, key: str, text: str, shares: DataFrame, floor: float = 0.1, alien: float = 0.02) -> DataFrame:
    """The keys of hits (with product and segment) that a cue in the text makes alien.

    A hit stays if a word of its product is in the text, or if a present cue supports its segment
    with at least ``floor``; it goes if for some present cue the segment's share is below ``alien``.
    A share that isn't listed is 0.
    """
    words = X.cue_tokens(text)
    rows = df.filter((X.text("segment") != "") & ~F.arrays_overlap(words, X.cue_tokens("product")))
    present = rows.select(key, "segment", F.explode(words).alias("cue")).join(shares.select("cue").distinct(), "cue")
    judged = present.join(shares, ["cue", "segment"], "left").groupBy(key).agg(
        F.max(F.coalesce("share", F.lit(0.0))).alias("most"), F.min(F.coalesce("share", F.lit(0.0))).alias("least")
    )
    return judged.filter((F.col("most") < floor) & (F.col("least") < alien)).select(key)


def ambiguous(keyword: Column | str, text: Column | str, labels: Iterable[str], names: Iterable[str]) -> Column:
    """Whether a listed keyword's labels share no word with the text."""
    own = F.flatten(F.array(*map(X.cue_tokens, labels)))
    keyword = F.col(keyword) if isinstance(keyword, str) else keyword
    return keyword.isin(*names) & ~F.arrays_overlap(own, X.cue_tokens(text))


def component_veto(product: Column | str, text: Column | str, products: Iterable[str], cues: Iterable[str]) -> Column:
    """Whether the predicted product is of a kind that the text's component cue rules out."""
    return P.has_cue(product, products) & P.has_cue(text, cues)


def corroborated(df: DataFrame, product: str, text: str, vocabulary: DataFrame, stop: Iterable[str] = ()) -> DataFrame:
    """``df`` with ``supported``: whether the text shares a word with the product's learned
    vocabulary (label, words), or with its own name where none was learned."""
    learned = vocabulary.select(F.col("label").alias("_label"), F.col("words").alias("_words"))
    out = df.join(learned, df[product] == F.col("_label"), "left")
    words = F.coalesce("_words", X.cue_tokens(product))
    mine = F.transform(X.tokens(text, 3, stop), X.sing)
    return out.withColumn("supported", F.coalesce(F.arrays_overlap(mine, words), F.lit(False))).drop("_label", "_words")
