"""Evidence scores and routing."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeweave.functions import predicates as P
from tradeweave.functions import text as X
from tradeweave.sources.tables import small, staged

from .aggregate import money, total

#: Statuses of routing, beside those of the gate.
CANDIDATE = "Review - candidate evidence"
MAKER_PRODUCT = "Review - manufacturer with product"
UNSPECIFIED_EVIDENCE = "Review - unspecified with product"
PRECISION_RISK = "Review - precision risk"
TRUSTED, REVIEW, EXCLUDED = "Trusted_Dashboard", "Review_Queue", "Excluded_Unmapped"


def product_evidence(row: Column, rules: Sequence[Mapping]) -> dict[str, Column]:
    """Labels of the first fitting rule, a blank one from the next; the largest score."""
    fits = [row.rlike(r["pattern"]) for r in rules]

    def first(name):
        return F.coalesce(*[F.when(f & F.lit(r[name] != ""), F.lit(r[name])) for f, r in zip(fits, rules)], F.lit(""))

    out = {f"candidate_{n}": first(n) for n in ("segment", "sub_segment", "product")}
    score = F.greatest(F.lit(0.0), *[F.when(f, F.lit(float(r["score"]))).otherwise(0.0) for f, r in zip(fits, rules)])
    return {"product_group": first("group"), **out, "product_score": score}


def build_evidence(
    df: DataFrame, row: Column, rules: Sequence[Mapping], negative: Mapping[str, str], maker_aliases: Mapping[str, str],
    generic: Iterable[str], generic_pattern: str, core: Iterable[str], extended: Iterable[str],
) -> DataFrame:
    """E1-E6, E8 and E9 as columns of ``df``; the row's text is normalised once."""
    df = df.withColumn("row_norm", X.norm_text(row))
    text = F.col("row_norm")
    generic = sorted({*generic, *X.BLANK})
    maker, family = X.norm_text("maker"), X.norm_text("family")
    alias = P.first_group(text, maker_aliases)
    known = ~maker.isin(*X.BLANK)
    in_text = known & text.contains(maker)
    family_in = ~family.isin(*generic) & (F.length(family) >= 3) & text.contains(family)
    df = df.withColumns(
        {
            **product_evidence(text, rules),
            "negative_group": P.first_group(text, negative),
            "maker_alias": alias,
            "maker_evidence": in_text | (alias != ""),
            "family_evidence": family_in,
            "generic_risk": text.rlike(generic_pattern) | family.isin(*generic),
            "code_scope": F.when(F.col("hs4").isin(*core), "core").when(F.col("hs4").isin(*extended), "extended").otherwise("outside"),
        }
    )
    maker_score = F.when(F.col("maker_evidence"), 24.0).when(known, 8.0).otherwise(0.0)
    df = df.withColumns(
        {
            "exclusion_score": F.when(F.col("negative_group") != "", 100.0).otherwise(0.0),
            "maker_score": maker_score,
            "family_score": F.when(F.col("family_evidence"), 28.0).otherwise(0.0),
            "generic_penalty": F.when(F.col("generic_risk"), 12.0).otherwise(0.0),
            "code_score": F.when(F.col("code_scope") == "core", 16.0).when(F.col("code_scope") == "extended", 6.0).otherwise(0.0),
            "category_confidence": F.when(F.col("include") == "Y", 0.95)
            .when((F.col("product_score") >= 40) & (F.col("code_scope") == "core"), 0.86)
            .when((F.col("product_score") > 0) & F.col("code_scope").isin("core", "extended"), 0.68)
            .otherwise(0.0),
        }
    )
    hit = F.col("product_score") > 0
    fuzzy, word, char = (F.when(hit, x).otherwise(0.0) for x in (0.72, 0.82, 0.74))
    score = (
        F.col("product_score") + F.col("family_score") + F.col("maker_score") + F.col("code_score")
        + fuzzy * 10 + word * 10 + char * 8 - F.col("generic_penalty") - F.col("exclusion_score") * 0.55
    )
    return df.withColumns({"candidate_score": F.bround(score, 2), "priority": X.value_band(X.safe_number("value"))})


def validation_status(df: DataFrame, strict: DataFrame, full: DataFrame, categories: DataFrame) -> DataFrame:
    """Key flags and the validation status; the key tables have a normalised ``key``.

    Distinct combinations of labels, of which there are far fewer than rows, are looked up and become a table."""
    from .gate import LABELS

    five, three = (F.concat_ws("|", *map(X.norm_exact, c)) for c in (LABELS, LABELS[:3]))
    out = staged(df.select(five.alias("_k5"), three.alias("_k3")).distinct(), "keys")
    for name, keys, on in (("strict_valid", strict, "_k5"), ("full_valid", full, "_k5"), ("category_valid", categories, "_k3")):
        out = out.join(keys.select(F.col("key").alias(on), F.lit(True).alias(name)).distinct(), on, "left").fillna(False, [name])
    out = df.withColumns({"_k5": five, "_k3": three}).join(small(staged(out, "key-flags")), ["_k5", "_k3"])
    family, category = F.col("match_tier") == "family", F.col("match_tier") == "category"
    status = (
        F.when(family & F.col("strict_valid"), "pass_full_strict").when(family & F.col("full_valid"), "pass_full_generic_risk").when(family, "reference_update_needed")
        .when(category & F.col("category_valid"), "pass_category").when(category, "category_update_needed").otherwise("not_applicable")
    )
    return out.withColumn("validation_status", status).drop("_k5", "_k3")


def route_rows(df: DataFrame, core: str = "core") -> DataFrame:
    """Routed status, flag and include, and ``change``, the kind of move ('' for none)."""
    from . import gate

    product, negative = F.col("product_score") > 0, F.col("negative_group") != ""
    was = F.col("include") == "Y"
    weak = was & F.col("generic_risk") & ~product & ((F.col("family_score") == 0) | (F.col("maker_score") < 20))
    change = (
        F.when(was & (negative | weak), "trusted to precision risk")
        .when((F.col("qa_status") == gate.UNMAPPED) & product & ~negative, "unmapped to review")
        .when((F.col("qa_status") == gate.AUDIT_MAKER) & product & ~negative, "maker only to product review")
        .when((F.col("qa_status") == gate.REVIEW_UNSPECIFIED) & product & ~negative, "unspecified with evidence")
        .otherwise("")
    )
    df = df.withColumn("change", change)
    status = (
        F.when(F.col("change") == "trusted to precision risk", PRECISION_RISK).when(F.col("change") == "unmapped to review", CANDIDATE)
        .when(F.col("change") == "maker only to product review", MAKER_PRODUCT).when(F.col("change") == "unspecified with evidence", UNSPECIFIED_EVIDENCE).otherwise(F.col("qa_status"))
    )
    flag = F.when(F.col("change") == "trusted to precision risk", F.concat(F.lit("precision_risk:"), F.when(negative, F.col("negative_group")).otherwise("generic_token_weak_evidence"))).otherwise(F.col("scope_flag"))
    df = df.withColumns({"before_include": F.col("include"), "before_status": F.col("qa_status")})
    df = df.withColumns({"qa_status": status, "scope_flag": flag})
    ok = (F.col("qa_status") == gate.MAPPED) & (F.col("ref_valid") == "Y") & (F.col("scope_flag") == "") & (F.col("match_scope") == core)
    return df.withColumn("include", F.when(ok, "Y").otherwise(""))


def routing_changes(df: DataFrame) -> DataFrame:
    """(change, n_rows, value)."""
    return df.filter("change <> ''").groupBy("change").agg(F.count("*").alias("n_rows"), total(money("value")).alias("value"))


def output_tier(include: Column | str = "include", status: Column | str = "qa_status") -> Column:
    """Every row is trusted, under review or excluded."""
    include, status = (F.col(c) if isinstance(c, str) else c for c in (include, status))
    return F.when(include == "Y", TRUSTED).when(status.startswith("Review") | status.startswith("Audit"), REVIEW).otherwise(EXCLUDED)


def apply_guards(df: DataFrame, guards: Sequence[tuple[str, Column, str, str]], trusted_gate: Column) -> DataFrame:
    """Guards (name, mask, status, flag) in order over the state before any of them.

    The status of the last mask that holds stands; the flag is the first one's, and only where there
    was none. Then the trusted gate (over the new columns) decides include anew. ``guards_hit`` lists
    the names.
    """
    df = df.withColumns({f"_g{k}": F.coalesce(m, F.lit(False)) for k, (_, m, _, _) in enumerate(guards)})
    status, flag = F.col("qa_status"), F.lit("")
    for k, (_, _, s, _) in enumerate(guards):
        status = F.when(F.col(f"_g{k}"), F.lit(s)).otherwise(status)
    for k in reversed(range(len(guards))):
        group = F.when(F.col("negative_group") != "", F.col("negative_group")).otherwise(F.lit(guards[k][3]))
        flag = F.when(F.col(f"_g{k}"), F.concat(F.lit(guards[k][3] + ":"), group)).otherwise(flag)
    hit = F.filter(F.array(*[F.when(F.col(f"_g{k}"), F.lit(g[0])) for k, g in enumerate(guards)]), lambda x: x.isNotNull())
    df = df.withColumns({"qa_status": status, "scope_flag": F.when(F.col("scope_flag") != "", F.col("scope_flag")).otherwise(flag), "guards_hit": hit})
    return df.withColumn("include", F.when(trusted_gate, "Y").otherwise("")).drop(*[f"_g{k}" for k in range(len(guards))])


def net_movement(df: DataFrame, before: str, after: str) -> DataFrame:
    """Rows and value by tier before and after."""
    return df.groupBy(before, after).agg(F.count("*").alias("n_rows"), total(money("value")).alias("value"))


def audit_flags(df: DataFrame, flags: Mapping[str, Column]) -> DataFrame:
    """A Y/'' column for each flag, and ``risk_flag``, the first that holds."""
    df = df.withColumns({n: F.when(c, "Y").otherwise("") for n, c in flags.items()})
    return df.withColumn("risk_flag", F.coalesce(*[F.when(F.col(n) == "Y", F.lit(n)) for n in flags], F.lit("")))
