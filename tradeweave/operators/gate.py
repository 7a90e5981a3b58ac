"""The reference gate: which mapped rows the master list bears out.

Validation looks at distinct label combinations, of which there are far fewer than rows, and joins
its findings back.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeweave.functions import predicates as P
from tradeweave.functions import text as X
from tradeweave.sources.tables import small, staged

#: The statuses.
MAPPED = "Mapped"
REVIEW_GENERIC = "Review - generic family"
REVIEW_CATEGORY = "Review - category conflict"
REVIEW_NOREF = "Review - not in reference"
REVIEW_UNSPECIFIED = "Review - unspecified"
REVIEW_SCOPE = "Review - scope"
REVIEW_ANOMALY = "Review - generic anomaly"
REVIEW_EXTENDED = "Review - extended scope"
AUDIT_PRIOR = "Audit - prior"
AUDIT_MAKER = "Audit - manufacturer only"
UNMAPPED = "Unmapped"
PARKED = "Parked - no reference"

LABELS = ("segment", "sub_segment", "product", "maker", "family")


def _key(norm, columns) -> Column:
    return F.concat_ws("|", *map(norm, columns))


def _canonical(df: DataFrame, keys: DataFrame, on: str, prefix: str, renamed: bool = True) -> DataFrame:
    """Left join of a key table with canonical labels, as ``<prefix>_<label>`` columns."""
    names = [c for c in keys.columns if c != "key"]
    out = keys.select(F.col("key").alias(on), *[F.col(c).alias(f"{prefix}_{'maker' if c == 'player' else c}") for c in names], F.lit(True).alias(f"{prefix}_hit"))
    return df.join(out, on, "left")


def validate_families(combos: DataFrame, keys: Mapping[str, DataFrame]) -> DataFrame:
    """Distinct family labels with their verdict: ref_valid, qa_status and new labels.

    In order: an exact strict key; a loose strict key (relabelled); an exact or loose generic key
    (relabelled, to review); the maker with this family elsewhere (conflict); no reference. The last
    two take over the wording of a known category.
    """
    c = combos.select(*LABELS).distinct()
    c = c.withColumns({"ke": _key(X.norm_exact, LABELS), "kl": _key(X.norm_loose, LABELS), "kc": _key(X.norm_loose, LABELS[:3]), "kp": _key(X.norm_loose, LABELS[3:])})
    c = _canonical(c, keys["full_exact"], "ke", "x")
    c = _canonical(c, keys["full_loose"], "kl", "l")
    c = _canonical(c, keys["generic_exact"], "ke", "g")
    c = _canonical(c, keys["generic_loose"], "kl", "h")
    c = _canonical(c, keys["category_loose"], "kc", "c")
    c = _canonical(c, keys["player_family"], "kp", "p")
    exact, strict, generic = F.col("x_hit").isNotNull(), F.col("l_hit").isNotNull(), F.col("g_hit").isNotNull() | F.col("h_hit").isNotNull()
    new = []
    for n in LABELS:
        aligned = F.coalesce(f"c_{n}", n) if n in LABELS[:3] else F.col(n)
        new.append(F.when(exact, F.col(n)).when(strict, F.col(f"l_{n}")).when(generic, F.coalesce(f"g_{n}", f"h_{n}")).otherwise(aligned).alias(f"new_{n}"))
    status = F.when(exact | strict, MAPPED).when(generic, REVIEW_GENERIC).when(F.col("p_hit").isNotNull(), REVIEW_CATEGORY).otherwise(REVIEW_NOREF)
    return c.select(*LABELS, *new, F.when(exact | strict | generic, "Y").otherwise("").alias("ref_valid"), status.alias("qa_status"))


def validate_categories(combos: DataFrame, keys: Mapping[str, DataFrame]) -> DataFrame:
    """R2: distinct (match_tier, category labels) with their verdict and new labels.

    An unspecified label goes to review; an exact or loose category is mapped (to audit for the
    prior tier, which never becomes valid); another isn't in the reference.
    """
    three = LABELS[:3]
    c = combos.select("match_tier", *three).distinct()
    c = c.withColumns({"ke": _key(X.norm_exact, three), "kl": _key(X.norm_loose, three)})
    c = _canonical(_canonical(c, keys["category_exact"], "ke", "x"), keys["category_loose"], "kl", "l")
    blank = P.unspecified("product", "segment", "sub_segment")
    exact, loose = F.col("x_hit").isNotNull(), F.col("l_hit").isNotNull()
    ok = ~blank & (exact | loose)
    new = [F.when(~blank & ~exact & loose, F.col(f"l_{n}")).otherwise(F.col(n)).alias(f"new_{n}") for n in three]
    status = F.when(blank, REVIEW_UNSPECIFIED).when(ok & (F.col("match_tier") == "category"), MAPPED).when(ok, AUDIT_PRIOR).otherwise(REVIEW_NOREF)
    valid = F.when(ok & (F.col("match_tier") == "category"), "Y").otherwise("")
    return c.select("match_tier", *three, *new, valid.alias("ref_valid"), status.alias("qa_status"))


def disposition(df: DataFrame, keys: Mapping[str, DataFrame] | None) -> DataFrame:
    """R1-R3 over all rows: relabelled, with ref_valid and qa_status.

    Maker-tier rows go to audit, unmatched ones are unmapped; without a reference matched rows are
    parked for review. Rows are read twice: for their distinct combinations of labels, which become a
    table and are judged, and for the join with the verdicts.
    """
    if keys is None:
        bound = F.col("match_tier").isin("family", "category", "hs_prior")
        status = F.when(bound & P.unspecified("product", "segment", "sub_segment"), REVIEW_UNSPECIFIED).when(bound, PARKED)
        status = status.when(F.col("match_tier") == "manufacturer", AUDIT_MAKER).otherwise(UNMAPPED)
        return df.withColumns({"ref_valid": F.lit(""), "qa_status": status})
    tier, judged = F.col("match_tier"), ("family", "category", "hs_prior")
    combos = staged(df.filter(tier.isin(*judged)).select("match_tier", *LABELS).distinct(), "combinations")
    family = validate_families(combos.filter("match_tier = 'family'"), keys).withColumn("match_tier", F.lit("family"))
    other = combos.filter("match_tier <> 'family'")
    three = validate_categories(other, keys)
    category = other.join(three, ["match_tier", *LABELS[:3]]).withColumns({f"new_{c}": F.col(c) for c in LABELS[3:]})
    found = family.unionByName(category)
    renamed = {c: f"_{c}" for c in ("match_tier", *LABELS, "ref_valid", "qa_status")}
    found = staged(found.withColumnsRenamed(renamed), "verdicts")
    same = [F.col(c) == F.col(f"_{c}") for c in ("match_tier", *LABELS)]
    out = df.join(small(found), same, "left")
    status = F.coalesce("_qa_status", F.when(tier == "manufacturer", AUDIT_MAKER).otherwise(UNMAPPED))
    out = out.withColumns({**{n: F.coalesce(f"new_{n}", n) for n in LABELS}, "ref_valid": F.coalesce("_ref_valid", F.lit("")), "qa_status": status})
    return out.drop(*renamed.values(), *(f"new_{n}" for n in LABELS))


def scope_exclusion(df: DataFrame, text: str, groups: Mapping[str, str], whitelist: str | None) -> DataFrame:
    """scope_flag and qa_status after the scope cues.

    Bound rows only. The whitelist clears a prior flag; a hit inside a valid family's own name is
    cleared; another sets the flag (a prior flag without a hit stays) and demotes rows that were
    mapped or at audit by prior.
    """
    low = F.lower(X.text(text))
    hit = P.first_hit(low, groups)
    white = F.coalesce(low.rlike(whitelist), F.lit(False)) if whitelist else F.lit(False)
    bound = F.col("match_tier").isin("family", "category", "hs_prior")
    flag = F.coalesce(hit["name"], F.trim(X.text("scope_flag")))
    keyword = X.norm_loose(hit["hit"])
    own = (F.col("match_tier") == "family") & (F.col("ref_valid") == "Y") & (keyword != "") & X.norm_loose("family").contains(keyword)
    flagged = bound & ~white & (flag != "") & ~own
    cleared = bound & (white | own)
    demoted = flagged & F.col("qa_status").isin(MAPPED, AUDIT_PRIOR, "")
    return df.withColumns(
        {
            "scope_flag": F.when(cleared, "").when(flagged, flag).otherwise(X.text("scope_flag")),
            "qa_status": F.when(demoted, F.concat(F.lit(REVIEW_SCOPE + ": "), flag)).otherwise(F.col("qa_status")),
        }
    )


def blank_fallback(df: DataFrame) -> DataFrame:
    """Bound rows without a status."""
    bound = F.col("match_tier").isin("family", "category", "hs_prior") & (X.text("qa_status") == "")
    status = F.when(bound & (F.col("ref_valid") == "Y"), MAPPED).when(bound, REVIEW_NOREF).otherwise(F.col("qa_status"))
    return df.withColumn("qa_status", status)


def generic_anomaly(df: DataFrame, text: str, generic, capital: str) -> DataFrame:
    """Mapped family rows whose family is a generic word, in a text of capital equipment."""
    odd = (F.col("match_tier") == "family") & (F.col("qa_status") == MAPPED) & X.norm_loose("family").isin(*generic) & F.lower(X.text(text)).rlike(capital)
    return df.withColumn("qa_status", F.when(odd, REVIEW_ANOMALY).otherwise(F.col("qa_status")))


def include(df: DataFrame, core: str = "core") -> DataFrame:
    """Demotes mapped rows outside the core scope, then marks what is trusted."""
    status = F.when((F.col("qa_status") == MAPPED) & (F.col("match_scope") != core), REVIEW_EXTENDED).otherwise(F.col("qa_status"))
    trusted = (F.col("qa_status") == MAPPED) & (F.col("match_scope") == core) & (F.col("ref_valid") == "Y") & (F.col("scope_flag") == "")
    return df.withColumn("qa_status", status).withColumn("include", F.when(trusted, "Y").otherwise(""))


def apply_gate(df: DataFrame, keys, text: str, groups, whitelist=None, generic=(), capital: str | None = None) -> DataFrame:
    """R1-R7 in order. A missing scope_flag counts as blank."""
    if "scope_flag" not in df.columns:
        df = df.withColumn("scope_flag", F.lit(""))
    out = blank_fallback(scope_exclusion(disposition(df, keys), text, groups, whitelist))
    if capital:
        out = generic_anomaly(out, text, generic, capital)
    return include(out)


def gate_violations(df: DataFrame, keys: Mapping[str, DataFrame], text: str, groups, whitelist=None) -> DataFrame:
    """(check_name, violations) over trusted rows; ``assert_gate`` raises on any."""
    trusted = df.filter("include = 'Y'")
    family = trusted.filter("match_tier = 'family'").select(_key(X.norm_exact, LABELS).alias("key")).distinct()
    category = trusted.select(_key(X.norm_exact, LABELS[:3]).alias("key")).distinct()
    hit = P.scope_hit(F.lower(X.text(text)), groups, whitelist)
    own = (F.col("match_tier") == "family") & X.norm_loose("family").contains(X.norm_loose(hit["hit"]))
    leaks = trusted.filter(hit.isNotNull() & ~own)
    count = lambda d, n: d.agg(F.lit(n).alias("check_name"), F.count("*").alias("violations"))
    out = count(family.join(keys["full_exact"], "key", "left_anti"), "family_in_master")
    out = out.unionByName(count(category.join(keys["category_exact"], "key", "left_anti"), "category_in_master"))
    return out.unionByName(count(leaks, "scope_leaks"))


def assert_gate(violations: DataFrame) -> None:
    bad = violations.filter("violations > 0").collect()
    if bad:
        raise ValueError(f"reference gate: {[(r.check_name, r.violations) for r in bad]}")


def compliance_actions(before: DataFrame, after: DataFrame, key: str, value: str) -> DataFrame:
    """(action, n_rows, value) of what the gate changed in a table that was mapped already."""
    a = before.select(key, *[F.col(c).alias(f"b_{c}") for c in (*LABELS, "qa_status", "include")])
    j = after.join(a, key)
    relabel = F.lit(False)
    for c in LABELS:
        relabel = relabel | (F.col(c) != F.col(f"b_{c}"))
    flags = {
        "relabelled": relabel,
        "demoted": (F.col("b_include") == "Y") & (F.col("include") != "Y"),
        "promoted": (F.col("b_include") != "Y") & (F.col("include") == "Y"),
        "status_changed": F.col("qa_status") != F.col("b_qa_status"),
        "scope_hit": F.col("scope_flag") != "",
    }
    rows = j.select(X.safe_number(value).cast("decimal(18,2)").alias("v"), F.explode(F.filter(F.array(*[F.when(c, F.lit(n)) for n, c in flags.items()]), lambda x: x.isNotNull())).alias("action"))
    return rows.groupBy("action").agg(F.count("*").alias("n_rows"), F.sum("v").cast("double").alias("value"))


def candidate_screen(df: DataFrame, text: str, candidate: str, exclusion: str, value: str) -> DataFrame:
    """Unmatched rows that look like candidates, with the matched word; highest value first."""
    low = F.lower(X.text(text))
    rows = df.filter((F.col("match_status") != "Matched") & low.rlike(candidate) & ~low.rlike(exclusion))
    return rows.withColumn("hit", F.regexp_extract(low, candidate, 0)).orderBy(X.safe_number(value).desc(), "row_id")


def route_by_tree(df: DataFrame, evidence: Column, risk: Column, maker_evidence: Column, core: str = "core") -> DataFrame:
    """(route, reasons) by one decision tree over tier, validity, evidence and risk."""
    tier, valid = F.col("match_tier"), F.col("ref_valid") == "Y"
    flagged = F.col("scope_flag") != ""
    reasons = F.array_distinct(
        F.filter(
            F.array(
                F.when(flagged, F.concat(F.lit("scope:"), F.col("scope_flag"))),
                F.when(~valid & (tier != ""), F.lit("not in reference")),
                F.when(risk, F.lit("risk token")),
                F.when(~evidence & tier.isin("family", "category"), F.lit("no product evidence")),
                F.when(~maker_evidence & (tier == "family"), F.lit("no maker evidence")),
                F.when(F.col("match_scope") != core, F.lit("extended scope")),
            ),
            lambda x: x.isNotNull(),
        )
    )
    route = (
        F.when(flagged, F.when(evidence, "Review").otherwise("Excluded"))
        .when(tier == "family", F.when(valid & (F.col("match_scope") == core) & ~(risk & ~evidence & ~maker_evidence), "Trusted").otherwise("Review"))
        .when(tier == "category", F.when(valid & evidence & (F.col("match_scope") == core), "Trusted").otherwise("Review"))
        .when(tier.isin("hs_prior", "manufacturer"), F.when(evidence, "Review").otherwise("Excluded"))
        .otherwise(F.when(evidence & ~risk, "Review").otherwise("Excluded"))
    )
    return df.withColumns({"route": route, "reasons": F.concat_ws("; ", reasons)})
