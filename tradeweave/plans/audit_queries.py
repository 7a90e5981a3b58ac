"""Queries for evidence, review, validation, audit, governance, retrieval and sources (E, Q, C, U, B, T, S)."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import functions as F

from tradeweave.functions import predicates as P
from tradeweave.functions import text as X
from tradeweave.operators import aggregate, audit, evaluate, evidence, gate, governance, lexicon, match, registry, retrieval, review, validate
from tradeweave.sources import fixtures as fx
from tradeweave.sources import tables

from .mapping_queries import gated, master_views, sql, stage
from .registry import query

RULES = [
    {"group": "r1", "pattern": "gear", "segment": "S1", "sub_segment": "", "product": "gear", "score": 45},
    {"group": "r2", "pattern": "red|ring", "segment": "S2", "sub_segment": "T2", "product": "ring", "score": 30},
]
NEGATIVE = {"n1": "cold", "n2": r"\bbrand 7\b"}
ALIASES = {"Seven": "supplier 000000007"}
GENERIC = ("small ring", "new gear")


def evidenced(spark, sf_dir, keep=True):
    return stage(spark, sf_dir, "evidence", _build_evidence, keep)


def _build_evidence(spark, sf_dir):
    rows = gated(spark, sf_dir)
    row = X.row_text("description", "importer", "exporter")
    return evidence.build_evidence(rows, row, RULES, NEGATIVE, ALIASES, GENERIC, "gizmo", ("9018", "9019", "9021", "9022"), ("9020",)).drop("row_norm")


_EV = {
    "ev0": r"""SELECT *, trim(regexp_replace(lower(description || ' ' || importer || ' ' || exporter), '[^a-z0-9]+', ' ', 'g')) AS row_norm,
      trim(regexp_replace(lower(maker), '[^a-z0-9]+', ' ', 'g')) AS mk FROM gated""",
    "ev1": r"""SELECT *, CASE WHEN contains(row_norm, 'gear') THEN 'r1' WHEN regexp_matches(row_norm, 'red|ring') THEN 'r2' ELSE '' END AS product_group,
      CASE WHEN contains(row_norm, 'gear') THEN 'S1' WHEN regexp_matches(row_norm, 'red|ring') THEN 'S2' ELSE '' END AS candidate_segment,
      CASE WHEN regexp_matches(row_norm, 'red|ring') THEN 'T2' ELSE '' END AS candidate_sub_segment,
      CASE WHEN contains(row_norm, 'gear') THEN 45.0 WHEN regexp_matches(row_norm, 'red|ring') THEN 30.0 ELSE 0.0 END::DOUBLE AS product_score,
      CASE WHEN contains(row_norm, 'cold') THEN 'n1' WHEN regexp_matches(row_norm, '\bbrand 7\b') THEN 'n2' ELSE '' END AS negative_group,
      CASE WHEN contains(row_norm, 'supplier 000000007') THEN 'Seven' ELSE '' END AS maker_alias,
      mk NOT IN ('', 'nan', 'none', 'unspecified') AS mk_known,
      lower(family) NOT IN ('', 'nan', 'none', 'unspecified', 'small ring', 'new gear') AND contains(row_norm, lower(family)) AS family_evidence,
      contains(row_norm, 'gizmo') OR lower(family) IN ('', 'nan', 'none', 'unspecified', 'small ring', 'new gear') AS generic_risk,
      CASE WHEN hs4 IN ('9018', '9019', '9021', '9022') THEN 'core' WHEN hs4 = '9020' THEN 'extended' ELSE 'outside' END AS code_scope FROM ev0""",
    "ev2": """SELECT *, (mk_known AND contains(row_norm, mk)) OR maker_alias <> '' AS maker_evidence FROM ev1""",
    "ev": """SELECT *, CASE WHEN negative_group <> '' THEN 100.0 ELSE 0.0 END::DOUBLE AS exclusion_score, CASE WHEN maker_evidence THEN 24.0 WHEN mk_known THEN 8.0 ELSE 0.0 END::DOUBLE AS maker_score,
      CASE WHEN family_evidence THEN 28.0 ELSE 0.0 END::DOUBLE AS family_score, CASE WHEN generic_risk THEN 12.0 ELSE 0.0 END::DOUBLE AS generic_penalty,
      CASE code_scope WHEN 'core' THEN 16.0 WHEN 'extended' THEN 6.0 ELSE 0.0 END::DOUBLE AS code_score,
      CASE WHEN include = 'Y' THEN 0.95 WHEN product_score >= 40 AND code_scope = 'core' THEN 0.86 WHEN product_score > 0 AND code_scope <> 'outside' THEN 0.68 ELSE 0.0 END::DOUBLE AS category_confidence FROM ev2""",
    "routed0": """SELECT *, CASE WHEN include = 'Y' AND (negative_group <> '' OR (generic_risk AND product_score = 0 AND (family_score = 0 OR maker_score < 20))) THEN 'trusted to precision risk'
      WHEN product_score > 0 AND negative_group = '' AND qa_status = 'Unmapped' THEN 'unmapped to review' WHEN product_score > 0 AND negative_group = '' AND qa_status = 'Audit - manufacturer only' THEN 'maker only to product review'
      WHEN product_score > 0 AND negative_group = '' AND qa_status = 'Review - unspecified' THEN 'unspecified with evidence' ELSE '' END AS change FROM ev""",
    "routed1": """SELECT * EXCLUDE (qa_status, scope_flag, include), include AS before_include, qa_status AS before_status, CASE change WHEN 'trusted to precision risk' THEN 'Review - precision risk' WHEN 'unmapped to review' THEN 'Review - candidate evidence'
      WHEN 'maker only to product review' THEN 'Review - manufacturer with product' WHEN 'unspecified with evidence' THEN 'Review - unspecified with product' ELSE qa_status END AS qa_status,
      CASE WHEN change = 'trusted to precision risk' THEN 'precision_risk:' || CASE WHEN negative_group <> '' THEN negative_group ELSE 'generic_token_weak_evidence' END ELSE scope_flag END AS scope_flag FROM routed0""",
    "routed": "SELECT *, CASE WHEN qa_status = 'Mapped' AND ref_valid = 'Y' AND scope_flag = '' AND match_scope = 'core' THEN 'Y' ELSE '' END AS include FROM routed1",
}
_TIER = "CASE WHEN {i} = 'Y' THEN 'Trusted_Dashboard' WHEN {s} LIKE 'Review%' OR {s} LIKE 'Audit%' THEN 'Review_Queue' ELSE 'Excluded_Unmapped' END"
_NOW = _TIER.format(i="include", s="qa_status")
_VAL = "sum(value::DECIMAL(18,2))::DOUBLE AS value"


def ev_sql(body: str, **more: str) -> str:
    return sql(body, **_EV, **more)


def routed(spark, sf_dir, keep=True):
    return evidence.route_rows(evidenced(spark, sf_dir, keep))


@query(ev_sql("SELECT row_id, product_group, candidate_segment, candidate_sub_segment, product_score FROM ev"))
def e01_product_evidence(spark, sf_dir):
    return evidenced(spark, sf_dir).select("row_id", "product_group", "candidate_segment", "candidate_sub_segment", "product_score")


@query(ev_sql("SELECT row_id, negative_group, exclusion_score FROM ev"))
def e02_negative(spark, sf_dir):
    return evidenced(spark, sf_dir).select("row_id", "negative_group", "exclusion_score")


@query(ev_sql("SELECT row_id, maker_alias FROM ev"))
def e03_maker_alias(spark, sf_dir):
    return evidenced(spark, sf_dir).select("row_id", "maker_alias")


@query(ev_sql("SELECT row_id, maker_evidence, family_evidence, maker_score, family_score FROM ev"))
def e04_presence(spark, sf_dir):
    return evidenced(spark, sf_dir).select("row_id", "maker_evidence", "family_evidence", "maker_score", "family_score")


@query(ev_sql("SELECT generic_risk, generic_penalty, code_scope, code_score, category_confidence, count(*) AS n_rows FROM ev GROUP BY ALL"))
def e05_e06_e08_scores(spark, sf_dir):
    keys = ["generic_risk", "generic_penalty", "code_scope", "code_score", "category_confidence"]
    return evidenced(spark, sf_dir).groupBy(*keys).agg(F.count("*").alias("n_rows"))


_K5 = "lower(concat_ws('|', segment, sub_segment, product, {m}, family))"


@query(sql(f"""SELECT row_id, CASE WHEN match_tier = 'family' THEN 'pass_full_strict' WHEN match_tier = 'category' AND EXISTS (SELECT 1 FROM strict s WHERE s.segment = g.segment AND s.sub_segment = g.sub_segment AND s.product = g.product) THEN 'pass_category'
  WHEN match_tier = 'category' THEN 'category_update_needed' ELSE 'not_applicable' END AS validation_status FROM gated g"""))
def e07_validation_status(spark, sf_dir):
    strict, generic, full = master_views(spark, sf_dir)
    keys = lexicon.build_reference_keys(strict, generic)
    every = lexicon.build_reference_keys(full, generic)["full_exact"]
    return evidence.validation_status(gated(spark, sf_dir), keys["full_exact"], every, keys["category_exact"]).select("row_id", "validation_status")


_SCORE = "product_score + family_score + maker_score + code_score + CASE WHEN product_score > 0 THEN 7.2 + 8.2 + 5.92 ELSE 0 END::DOUBLE - generic_penalty - exclusion_score * 0.55::DOUBLE"


@query(ev_sql(f"SELECT row_id, round({_SCORE}, 2) AS candidate_score FROM ev"))
def e09_candidate_score(spark, sf_dir):
    return evidenced(spark, sf_dir).select("row_id", "candidate_score")


@query(ev_sql("SELECT row_id, qa_status, scope_flag, include FROM routed"))
def e10_route_rows(spark, sf_dir):
    return routed(spark, sf_dir).select("row_id", "qa_status", "scope_flag", "include")


@query(ev_sql(f"SELECT change, count(*) AS n_rows, {_VAL} FROM routed WHERE change <> '' GROUP BY change"))
def e11_routing_changes(spark, sf_dir):
    return evidence.routing_changes(routed(spark, sf_dir))


@query(ev_sql(f"SELECT {_NOW} AS tier, count(*) AS n_rows FROM routed GROUP BY 1"))
def e12_output_tier(spark, sf_dir):
    return routed(spark, sf_dir).groupBy(evidence.output_tier().alias("tier")).agg(F.count("*").alias("n_rows"))


def guarded(spark, sf_dir, keep=True):
    low = F.lower("description")
    was = F.col("include") == "Y"
    guards = [
        ("extended false positive", (F.col("hs4") == "9020") & low.contains("old"), "Excluded - false positive", "excluded_false_positive"),
        ("trusted conflict", was & (F.col("negative_group") != ""), evidence.PRECISION_RISK, "precision_risk"),
        ("weak category", was & (F.col("match_tier") == "category") & (F.col("product_score") == 0), "Review - weak category", "review"),
        ("promo", was & low.contains("promo"), "Review - promo", "review"),
    ]
    ok = (F.col("qa_status") == gate.MAPPED) & (F.col("ref_valid") == "Y") & (F.col("match_scope") == "core") & (F.col("scope_flag") == "") & (F.col("negative_group") == "")
    return evidence.apply_guards(routed(spark, sf_dir, keep), guards, ok)


_GUARD = {
    "g0": """SELECT *, hs4 = '9020' AND contains(lower(description), 'old') AS m1, include = 'Y' AND negative_group <> '' AS m2, include = 'Y' AND match_tier = 'category' AND product_score = 0 AS m3,
      include = 'Y' AND contains(lower(description), 'promo') AS m4, CASE WHEN negative_group <> '' THEN negative_group END AS ng FROM routed""",
    "guarded": """SELECT row_id, CASE WHEN m4 THEN 'Review - promo' WHEN m3 THEN 'Review - weak category' WHEN m2 THEN 'Review - precision risk' WHEN m1 THEN 'Excluded - false positive' ELSE qa_status END AS qa_status,
      CASE WHEN scope_flag <> '' THEN scope_flag WHEN m1 THEN 'excluded_false_positive:' || coalesce(ng, 'excluded_false_positive') WHEN m2 THEN 'precision_risk:' || coalesce(ng, 'precision_risk') WHEN m3 OR m4 THEN 'review:' || coalesce(ng, 'review') ELSE '' END AS scope_flag,
      negative_group, ref_valid, match_scope FROM g0""",
}


@query(ev_sql("SELECT row_id, qa_status, scope_flag, CASE WHEN qa_status = 'Mapped' AND ref_valid = 'Y' AND match_scope = 'core' AND scope_flag = '' AND negative_group = '' THEN 'Y' ELSE '' END AS include FROM guarded", **_GUARD))
def e13_apply_guards(spark, sf_dir):
    return guarded(spark, sf_dir, keep=False).select("row_id", "qa_status", "scope_flag", "include")


@query(ev_sql(f"SELECT {_TIER.format(i='before_include', s='before_status')} AS before_tier, {_NOW} AS after_tier, count(*) AS n_rows, {_VAL} FROM routed GROUP BY 1, 2"))
def e14_net_movement(spark, sf_dir):
    rows = routed(spark, sf_dir).withColumns({"before_tier": evidence.output_tier("before_include", "before_status"), "after_tier": evidence.output_tier()})
    return evidence.net_movement(rows, "before_tier", "after_tier")


@query(ev_sql("SELECT CASE WHEN negative_group <> '' THEN 'negative' WHEN generic_risk THEN 'generic' ELSE '' END AS risk_flag, count(*) AS n_rows FROM ev GROUP BY 1"))
def e15_audit_flags(spark, sf_dir):
    out = evidence.audit_flags(evidenced(spark, sf_dir, keep=False), {"negative": F.col("negative_group") != "", "generic": F.col("generic_risk")})
    return out.groupBy("risk_flag").agg(F.count("*").alias("n_rows"))


# Review tables.


@query(ev_sql("SELECT row_id, CASE WHEN lower(segment) NOT IN ('', 'unspecified', 'nan', 'none') THEN segment ELSE candidate_segment END AS proposed_segment, concat_ws('; ', CASE WHEN product_score > 0 THEN 'product' END, CASE WHEN maker_evidence THEN 'maker' END) AS reason FROM routed WHERE qa_status LIKE 'Review%' AND product_score > 0"))
def q01_candidates(spark, sf_dir):
    rows = routed(spark, sf_dir)
    out = review.candidates(rows, F.col("qa_status").startswith("Review") & (F.col("product_score") > 0), {"product": F.col("product_score") > 0, "maker": F.col("maker_evidence")})
    return out.select("row_id", "proposed_segment", "reason")


#: Methods that propose candidates: condition and label, as SQL that Spark and DuckDB share.
_METHODS = {
    "product": ("product_score > 0", "candidate_segment"), "alias": ("maker_alias <> ''", "maker_alias"), "family": ("family_evidence", "family"), "maker": ("maker_evidence", "maker"),
    "category": ("match_tier = 'category'", "product"), "core code": ("code_scope = 'core' AND product_score > 0", "hs4"), "extended code": ("code_scope = 'extended'", "hs4"),
    "generic token": ("generic_risk", "family"), "conflict": ("negative_group <> ''", "negative_group"), "confident": ("category_confidence >= 0.86", "segment"),
    "high value": ("CAST(value AS DOUBLE) >= 50000", "hs_code"), "no reference": ("ref_valid <> 'Y' AND match_tier <> ''", "product"),
}
_FIRED = " UNION ALL ".join(f"SELECT row_id, value::DOUBLE AS value, {k} AS rank, '{n}' AS method, {label} AS label FROM ev WHERE {c}" for k, (n, (c, label)) in enumerate(_METHODS.items()))


@query(ev_sql(f"""SELECT row_id, method, label, value FROM (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY row_id ORDER BY rank, label) AS r3 FROM (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY row_id, label ORDER BY rank) AS r2 FROM (
  SELECT *, row_number() OVER (PARTITION BY method ORDER BY value DESC, row_id) AS r1 FROM ({_FIRED})) WHERE r1 <= 300) WHERE r2 = 1)) WHERE r3 <= 4)
  ORDER BY value DESC, row_id, rank LIMIT 500"""))
def q02_top_candidates(spark, sf_dir):
    methods = {n: (F.expr(c), F.col(label)) for n, (c, label) in _METHODS.items()}
    return review.top_candidates(evidenced(spark, sf_dir, keep=False), "row_id", methods, 300, 4, 500)


_REQ = "SELECT product, maker, CASE WHEN ref_valid = 'Y' THEN 'scope' ELSE 'reference' END AS issue, count(*) AS n_rows, sum(value::DECIMAL(18,2))::DOUBLE AS value, arg_min(description, (-value::DOUBLE, row_id)) AS sample FROM gated WHERE {w} GROUP BY ALL"


def _request(spark, sf_dir, condition):
    return review.grouped_request(gated(spark, sf_dir).filter(condition), ["product", "maker"], F.when(F.col("ref_valid") == "Y", "scope").otherwise("reference"), "description", "row_id")


@query(sql(_REQ.format(w="qa_status LIKE 'Review%'")))
def q03_reference_requests(spark, sf_dir):
    return _request(spark, sf_dir, "qa_status LIKE 'Review%'")


@query(sql(_REQ.format(w="match_tier = 'manufacturer'")))
def q04_alias_requests(spark, sf_dir):
    return _request(spark, sf_dir, "match_tier = 'manufacturer'")


@query(sql(f"SELECT hs4, CASE WHEN contains(lower(description), 'promo') THEN 'c' WHEN contains(lower(description), 'gear') THEN 'b' WHEN contains(lower(description), 'red') THEN 'a' ELSE 'other' END AS category, count(*) AS n_rows, {_VAL} FROM gated WHERE qa_status = 'Review - extended scope' GROUP BY 1, 2"))
def q05_extended_decisions(spark, sf_dir):
    low = F.lower("description")
    category = review.last_rule([(low.contains("red"), "a"), (low.contains("gear"), "b"), (low.contains("promo"), "c")], "other")
    return review.decision_table(gated(spark, sf_dir).filter(F.col("qa_status") == gate.REVIEW_EXTENDED), category, ["hs4"])


@query(sql(f"SELECT qa_status, product, count(*) AS n_rows, count(*) FILTER (value::DOUBLE >= 50000) AS n_high, {_VAL}, CASE WHEN qa_status LIKE 'Review - scope%' THEN 'check scope' ELSE 'check reference' END AS playbook FROM gated WHERE qa_status LIKE 'Review%' GROUP BY ALL"))
def q06_clusters(spark, sf_dir):
    return review.clusters(gated(spark, sf_dir).filter("qa_status LIKE 'Review%'"), ["product"], 50_000, {"Review": "check reference", "Review - scope": "check scope"})


@query(ev_sql("SELECT row_id, include, qa_status, before_include, before_status AS before_qa_status FROM routed WHERE include <> before_include OR qa_status <> before_status"))
def q07_changed_rows(spark, sf_dir):
    rows = evidenced(spark, sf_dir)
    return review.changed_rows(rows, evidence.route_rows(rows), "row_id", ["include", "qa_status"])


def _screen_sql(where: str, wanted: str, unwanted: str | None = None) -> str:
    no = f" AND NOT regexp_matches(lower(description), '{unwanted}')" if unwanted else ""
    return sql(f"SELECT row_id, regexp_extract(lower(description), '{wanted}') AS hit FROM gated WHERE {where} AND regexp_matches(lower(description), '{wanted}'){no}")


def _screen(spark, sf_dir, where, wanted, unwanted=None):
    return review.screen(gated(spark, sf_dir).filter(where), F.lower("description"), wanted, unwanted).select("row_id", "hit")


@query(_screen_sql("qa_status = 'Unmapped'", "gear|ring", "hot"))
def q08_potential_missed(spark, sf_dir):
    return _screen(spark, sf_dir, "qa_status = 'Unmapped'", "gear|ring", "hot")


@query(_screen_sql("include <> 'Y'", "red bolt"))
def q09_false_negatives(spark, sf_dir):
    return _screen(spark, sf_dir, "include <> 'Y'", "red bolt")


@query(_screen_sql("include = 'Y'", "small|new"))
def q10_trusted_generic(spark, sf_dir):
    return _screen(spark, sf_dir, "include = 'Y'", "small|new")


@query("SELECT p_partkey, CASE WHEN p_name IN ('small ring', 'red march') THEN 'rejected' WHEN p_size > 40 THEN 'needs review' ELSE 'clean' END AS disposition FROM part")
def q11_split_requests(spark, sf_dir):
    return review.split_requests(fx.table(spark, sf_dir, "part"), "p_name", ("small ring",), ("march",), F.col("p_size") > 40).select("p_partkey", "disposition")


@query(sql(_REQ.format(w="qa_status = 'Review - not in reference' OR qa_status = 'Review - unspecified'")))
def q12_reference_gaps(spark, sf_dir):
    return _request(spark, sf_dir, "qa_status IN ('Review - not in reference', 'Review - unspecified')")


@query(_screen_sql("match_tier = 'family' AND include <> 'Y'", "small|promo"))
def q13_dashboard_risks(spark, sf_dir):
    return _screen(spark, sf_dir, "match_tier = 'family' AND include <> 'Y'", "small|promo")


@query(_screen_sql("scope_flag <> ''", "old|small"))
def q14_scope_audit(spark, sf_dir):
    return _screen(spark, sf_dir, "scope_flag <> ''", "old|small")


@query(ev_sql("SELECT row_id, concat_ws('; ', CASE WHEN negative_group <> '' THEN 'negative' END, CASE WHEN generic_risk THEN 'generic' END, CASE WHEN NOT maker_evidence THEN 'no maker' END) AS reasons FROM ev WHERE include = 'Y' AND (negative_group <> '' OR generic_risk OR NOT maker_evidence)"))
def q15_trusted_anomalies(spark, sf_dir):
    rows = evidenced(spark, sf_dir, keep=False).filter("include = 'Y'")
    return review.anomalies(rows, {"negative": F.col("negative_group") != "", "generic": F.col("generic_risk"), "no maker": ~F.col("maker_evidence")}).select("row_id", "reasons")


@query(sql(f"SELECT CASE WHEN contains(lower(description), 'gear') THEN 'gears' WHEN contains(lower(description), 'ring') THEN 'rings' ELSE '' END AS category, count(*) AS n_rows, {_VAL} FROM gated WHERE match_scope = 'extended' GROUP BY 1"))
def q16_extended_buckets(spark, sf_dir):
    return review.decision_table(gated(spark, sf_dir).filter("match_scope = 'extended'"), P.first_group(F.lower("description"), {"gears": "gear", "rings": "ring"}), [])


_SCREENS = "(VALUES ('a', 'red'), ('b', 'gear|rod'), ('c', 'promo')) v(screen, p)"


@query(sql(f"SELECT screen, count(*) AS n_rows, {_VAL}, arg_min(description, (-value::DOUBLE, row_id)) AS sample FROM ship, {_SCREENS} WHERE regexp_matches(lower(description), p) GROUP BY screen", "ship"))
def q17_named_screens(spark, sf_dir):
    return review.named_screens(fx.shipments(spark, sf_dir), F.lower("description"), {"a": "red", "b": "gear|rod", "c": "promo"}, "row_id", "description")


@query(sql("""SELECT row_id, bucket, '' AS label FROM (SELECT *, row_number() OVER (PARTITION BY row_id ORDER BY rank) AS f FROM (SELECT *, row_number() OVER (PARTITION BY bucket ORDER BY value DESC, row_id) AS n FROM (
  SELECT row_id, value::DOUBLE AS value, 0 AS rank, 'extended' AS bucket FROM gated WHERE match_scope = 'extended' UNION ALL SELECT row_id, value::DOUBLE, 1, 'unmapped' FROM gated WHERE qa_status = 'Unmapped')) WHERE bucket = 'unmapped' OR n <= 50) WHERE f = 1"""))
def q18_gold_template(spark, sf_dir):
    buckets = {"extended": F.col("match_scope") == "extended", "unmapped": F.col("qa_status") == "Unmapped"}
    return review.gold_template(gated(spark, sf_dir), "row_id", buckets, {"extended": 50}, ["label"])


@query(sql("SELECT row_id, qa_status FROM gated QUALIFY row_number() OVER (PARTITION BY qa_status ORDER BY value::DOUBLE DESC, row_id) <= 20"))
def q19_bucket_sample(spark, sf_dir):
    return review.ranked(gated(spark, sf_dir), ["qa_status"], [X.safe_number("value").desc(), "row_id"], 20).select("row_id", "qa_status")


@query(ev_sql("SELECT 'product' AS type, count(*) FILTER (product_score > 0 AND include <> 'Y') AS n_rows FROM ev UNION ALL SELECT 'maker', count(*) FILTER (maker_evidence AND maker = '') FROM ev"))
def q20_active_learning(spark, sf_dir):
    flags = {"product": (F.col("product_score") > 0) & (F.col("include") != "Y"), "maker": F.col("maker_evidence") & (F.col("maker") == "")}
    return review.counts_by_type(flags, evidenced(spark, sf_dir))


@query(sql("SELECT row_id, match_tier, qa_status, CASE WHEN include = 'Y' THEN 'accept' WHEN qa_status LIKE 'Review%' THEN 'review' ELSE 'none' END AS decision, concat_ws(' / ', segment, product, family) AS target FROM gated"))
def q21_decision_log(spark, sf_dir):
    decision = F.when(F.col("include") == "Y", "accept").when(F.col("qa_status").startswith("Review"), "review").otherwise("none")
    return review.decision_log(gated(spark, sf_dir), "row_id", decision)


@query(sql(f"SELECT signature, count(*) AS n_rows, {_VAL} FROM gated, (VALUES ('x', 'gear', 'red', 'promo'), ('y', 'ring', 'brand', 'small')) v(signature, a, b, c) WHERE contains(lower(product), a) AND contains(lower(description), b) AND NOT contains(lower(description), c) GROUP BY signature"))
def q22_signature_impact(spark, sf_dir):
    return review.signature_impact(gated(spark, sf_dir), "product", "description", [("x", "gear", "red", "promo"), ("y", "ring", "brand", "small")])


@query(ev_sql(f"""SELECT *, (trusted_rows + review_rows) / n_rows AS capture_proxy FROM (SELECT 'after' AS label, count(*) AS n_rows, count(*) FILTER (t = 'Trusted_Dashboard') AS trusted_rows, count(*) FILTER (t = 'Review_Queue') AS review_rows, count(*) FILTER (t = 'Excluded_Unmapped') AS excluded_rows,
  coalesce(sum(value::DECIMAL(18,2)) FILTER (t = 'Trusted_Dashboard'), 0)::DOUBLE AS trusted_value, coalesce(sum(value::DECIMAL(18,2)) FILTER (t = 'Review_Queue'), 0)::DOUBLE AS review_value, count(*) FILTER (t = 'Review_Queue' AND value::DOUBLE >= 50000) AS high_value_review FROM (SELECT *, {_NOW} AS t FROM routed))"""))
def v10_snapshot(spark, sf_dir):
    return evaluate.snapshot(routed(spark, sf_dir, keep=False), "after")


# Validation.


#: What damages gated rows so that checks fail, as SQL that Spark and DuckDB share.
_DAMAGE = {
    "match_tier": "CASE WHEN month = '1' THEN 'odd' ELSE match_tier END", "include": "CASE WHEN month = '2' THEN 'Y' ELSE include END", "product": "CASE WHEN month = '3' THEN '' ELSE product END",
    "maker": "CASE WHEN month = '4' THEN '' ELSE maker END", "match_status": "CASE WHEN month = '5' THEN 'Unmatched' ELSE match_status END",
}
_DAMAGED = {
    "damaged": "SELECT * REPLACE (" + ", ".join(f"{e} AS {c}" for c, e in _DAMAGE.items()) + ") FROM gated",
    "broken": """SELECT unnest(['tier vocabulary', 'unmatched has no tier', 'category has product', 'manufacturer has maker', 'included is core', 'included is valid', 'included has no flag', 'included is mapped']) AS check_name,
      unnest([count(*) FILTER (match_tier NOT IN ('family', 'category', 'manufacturer', 'hs_prior', '')), count(*) FILTER (match_status <> 'Matched' AND match_tier <> ''), count(*) FILTER (match_tier = 'category' AND product = ''),
      count(*) FILTER (match_tier = 'manufacturer' AND maker = ''), count(*) FILTER (include = 'Y' AND match_scope <> 'core'), count(*) FILTER (include = 'Y' AND ref_valid <> 'Y'),
      count(*) FILTER (include = 'Y' AND scope_flag <> ''), count(*) FILTER (include = 'Y' AND qa_status <> 'Mapped')]) AS violations FROM damaged""",
    "checks": "SELECT *, CASE WHEN violations = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM broken",
}


def damaged(spark, sf_dir):
    return gated(spark, sf_dir).withColumns({c: F.expr(e) for c, e in _DAMAGE.items()})


@query(sql("SELECT * FROM checks", **_DAMAGED))
def c01_output_invariants(spark, sf_dir):
    return validate.violations(damaged(spark, sf_dir), validate.output_invariants())


_PINS = {
    "seen": "SELECT country, count(*) AS n_rows, sum(value::DECIMAL(18,2))::DOUBLE AS value FROM ship GROUP BY country",
    "pins": """SELECT n_name AS country, count(*) + (n_nationkey % 3 = 0)::BIGINT AS pin_rows, round(sum(l_extendedprice) * CASE n_nationkey % 4 WHEN 1 THEN 1.003 WHEN 2 THEN 1.01 ELSE 1 END, 2) AS pin_value
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name, n_nationkey""",
}


@query(sql("SELECT country, n_rows, value, pin_rows, pin_value, CASE WHEN n_rows = pin_rows AND abs(value - pin_value) <= 0.005 * abs(pin_value) THEN 'PASS' ELSE 'FAIL' END AS status FROM seen JOIN pins USING (country)", "ship", **_PINS))
def c02_anchors(spark, sf_dir):
    t = lambda n: fx.table(spark, sf_dir, n)
    seen = fx.shipments(spark, sf_dir).groupBy("country").agg(F.count("*").alias("n_rows"), aggregate.total(aggregate.money("value")).alias("value"))
    lines = t("lineitem").join(t("orders"), F.col("l_orderkey") == F.col("o_orderkey")).join(t("customer"), F.col("o_custkey") == F.col("c_custkey"))
    by = lines.join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey")).groupBy(F.col("n_name").alias("country"), "n_nationkey")
    off = F.when(F.col("n_nationkey") % 4 == 1, 1.003).when(F.col("n_nationkey") % 4 == 2, 1.01).otherwise(1.0)
    pins = by.agg((F.count("*") + (F.any_value("n_nationkey") % 3 == 0).cast("bigint")).alias("n_rows"), F.sum("l_extendedprice").alias("v"))
    return validate.anchors(seen, pins.select("country", "n_rows", F.round(F.col("v") * off, 2).alias("value")), ["country"])


@query(ev_sql("SELECT 'trusted has evidence' AS check_name, v AS violations, CASE WHEN v = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM (SELECT count(*) FILTER (include = 'Y' AND product_score = 0 AND NOT maker_evidence) AS v FROM routed) UNION ALL SELECT 'matched has no conflict', v, CASE WHEN v = 0 THEN 'PASS' ELSE 'FAIL' END FROM (SELECT count(*) FILTER (match_tier <> '' AND negative_group <> '') AS v FROM routed)"))
def c03_trusted_validations(spark, sf_dir):
    t = F.col("include") == "Y"
    return validate.violations(routed(spark, sf_dir, keep=False), {"trusted has evidence": t & (F.col("product_score") == 0) & ~F.col("maker_evidence"), "matched has no conflict": (F.col("match_tier") != "") & (F.col("negative_group") != "")})


_PARTS = {
    "parts": "SELECT row_id, value FROM gated WHERE month <> '1' UNION ALL SELECT row_id, value FROM gated WHERE month = '2'",
    "found": """SELECT abs((SELECT count(*) FROM ship) - (SELECT count(*) FROM parts)) AS a, ((SELECT sum(value::DECIMAL(18,2)) FROM ship) IS DISTINCT FROM (SELECT sum(value::DECIMAL(18,2)) FROM parts))::BIGINT AS b,
      (SELECT count(*) FROM ship FULL OUTER JOIN (SELECT DISTINCT row_id FROM parts) p USING (row_id) WHERE ship.row_id IS NULL OR p.row_id IS NULL) AS c, (SELECT count(*) FROM (SELECT row_id FROM parts GROUP BY 1 HAVING count(*) > 1)) AS d""",
}


@query(sql("SELECT check_name, violations, CASE WHEN violations = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM (SELECT unnest(['rows', 'value', 'ids', 'duplicates']) AS check_name, unnest([a, b, c, d]) AS violations FROM found)", **_PARTS))
def c04_partition_reconciliation(spark, sf_dir):
    rows = gated(spark, sf_dir)
    parts = rows.filter("month <> '1'").unionByName(rows.filter("month = '2'"))
    return validate.partition_reconciliation(fx.shipments(spark, sf_dir), parts, "row_id")


@query(ev_sql("""SELECT check_name, violations, CASE WHEN violations = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM (SELECT unnest(['promo trusted', 'gear mapped']) AS check_name,
  unnest([count(*) FILTER (s.description LIKE '%promo%' AND g.qa_status = 'Mapped' AND g.scope_flag = ''), count(*) FILTER (contains(s.description, 'gear') AND g.qa_status = 'Mapped')]) AS violations FROM guarded g JOIN ship s USING (row_id))""", **_GUARD))
def c05_guard_validations(spark, sf_dir):
    low, mapped_ = F.lower("description"), F.col("qa_status") == "Mapped"
    return validate.violations(guarded(spark, sf_dir), {"promo trusted": mapped_ & (F.col("scope_flag") == "") & low.contains("promo"), "gear mapped": mapped_ & low.contains("gear")})


_BY = "SELECT product, count(*) AS n_rows, sum(value::DECIMAL(18,2)) AS value FROM gated WHERE {} GROUP BY product"


@query(sql("""SELECT count(*) FILTER (a.product IS NULL) AS only_b, count(*) FILTER (b.product IS NULL) AS only_a, sum(abs(coalesce(a.n_rows, 0) - coalesce(b.n_rows, 0)))::DOUBLE AS delta_n_rows, sum(abs(coalesce(a.value, 0) - coalesce(b.value, 0)))::DOUBLE AS delta_value
  FROM a FULL OUTER JOIN b ON a.product = b.product""", a=_BY.format("match_tier = 'family'"), b=_BY.format("include = 'Y'")))
def c06_compare_aggregates(spark, sf_dir):
    rows = gated(spark, sf_dir)
    of = lambda w: rows.filter(w).groupBy("product").agg(F.count("*").alias("n_rows"), aggregate.total(aggregate.money("value")).alias("value"))
    return validate.compare_aggregates(of("match_tier = 'family'"), of("include = 'Y'"), ["product"], ["n_rows", "value"])


@query(sql("""SELECT key, n_rows, array_to_string(ids[1:5], ',') AS sample_ids FROM (SELECT lower(concat_ws('|', segment, sub_segment, product)) AS key, count(*) AS n_rows, list_sort(list(row_id)) AS ids FROM gated
  WHERE match_tier = 'category' AND lower(concat_ws('|', segment, sub_segment, product)) NOT IN (SELECT lower(concat_ws('|', segment, sub_segment, product)) FROM strict) GROUP BY 1)"""))
def c07_unknown_keys(spark, sf_dir):
    strict, generic, _ = master_views(spark, sf_dir)
    key = F.concat_ws("|", *map(X.norm_exact, ("segment", "sub_segment", "product")))
    return validate.unknown_keys(gated(spark, sf_dir).filter("match_tier = 'category'"), key, lexicon.build_reference_keys(strict, generic)["category_exact"], "row_id")


@query(sql("SELECT count(*) AS n_checks, count(*) FILTER (status = 'FAIL') AS n_failed, count(*) FILTER (status = 'FAIL') = 0 AS accepted FROM checks", **_DAMAGED))
def c08_acceptance(spark, sf_dir):
    return validate.acceptance(validate.violations(damaged(spark, sf_dir), validate.output_invariants()))


@query(sql("""SELECT 'gate' AS source, status, count(*) AS n_checks, NULL::VARCHAR AS check_name FROM checks GROUP BY status UNION ALL SELECT 'gate', status, NULL, check_name FROM checks WHERE status = 'FAIL'
  UNION ALL SELECT 'rows', CASE WHEN n = 0 THEN 'PASS' ELSE 'FAIL' END, 1, NULL FROM (SELECT count(*) FILTER (value::DOUBLE < 0) AS n FROM ship) UNION ALL SELECT 'rows', 'FAIL', NULL, 'negative value' FROM (SELECT count(*) FILTER (value::DOUBLE < 0) AS n FROM ship) WHERE n > 0""", **_DAMAGED))
def c09_status_summary(spark, sf_dir):
    rows = damaged(spark, sf_dir)
    return validate.status_summary({"gate": validate.violations(rows, validate.output_invariants()), "rows": validate.violations(rows, {"negative value": X.safe_number("value") < 0})})


# The audit mart.


SAMPLE = audit.Sample({
    "Vague": "generic_risk", "Guessed": "match_tier IN ('manufacturer', 'hs_prior')", "Missed": "tier <> 'Trusted' AND exists(hits, h -> h.rule_id = 'missed')",
    "Not trusted": "tier <> 'Trusted'",
})
RETAINED = {"guessed": "tier <> 'Trusted' AND match_tier IN ('manufacturer', 'hs_prior')"}


def shipment_registry() -> registry.Registry:
    return registry.Registry.of(fx.REGISTRY)


def facts(spark, sf_dir):
    """The facts as a table, without the hash, which a single query reads and which would be half of it."""
    return stage(spark, sf_dir, "facts", lambda s, d: _build_facts(s, d).drop("source_hash"))


def _build_facts(spark, sf_dir):
    return audit.row_facts(routed(spark, sf_dir, keep=False), "row_id", shipment_registry(), ["generic_risk"])


_FACTS = {
    "facts0": """SELECT *, CASE WHEN include = 'Y' THEN 'Trusted' WHEN qa_status LIKE 'Review%' OR qa_status LIKE 'Audit%' THEN 'Review' ELSE 'Excluded' END AS tier,
      contains(lower(qa_status), 'precision') AS precise, match_tier IN ('family', 'category') AND ref_valid <> 'Y' AS missing, generic_risk OR description LIKE '%small%plate%' AS vague FROM routed""",
    "facts1": """SELECT *, CASE WHEN tier = 'Trusted' THEN ['accepted', 'desk'] WHEN precise THEN ['precision', 'reading'] WHEN scope_flag <> '' THEN ['beyond: ' || scope_flag, 'border'] WHEN negative_group <> '' THEN ['contradiction', 'reading']
      WHEN missing THEN ['not_listed', 'listing'] WHEN vague THEN ['vague', 'reading'] WHEN qa_status <> '' THEN [qa_status, 'desk'] WHEN tier = 'Review' THEN ['review_required', 'desk'] ELSE ['no_accepted_candidate', 'desk'] END AS why FROM facts0""",
    "facts": """SELECT row_id, country AS output_id, maker, family, product, match_tier, match_scope, product_score, tier, negative_group, scope_flag, generic_risk, precise, vague, include, qa_status, ref_valid, value::DECIMAL(18,2) AS value, quantity::DECIMAL(18,2) AS volume,
      description, importer, exporter, why[1] AS primary_reason, why[2] AS removal_stage FROM facts1""",
    "states": """SELECT row_id, 1 AS o, 'naming' AS stage_id, CASE WHEN match_tier IN ('family', 'category') THEN 'Named' WHEN match_tier <> '' THEN 'Guessed' ELSE 'Nameless' END AS outcome,
        CASE match_tier WHEN 'family' THEN 'own_name' WHEN 'category' THEN 'kind_of_goods' WHEN '' THEN 'unnamed' ELSE 'guess by ' || match_tier END AS reason FROM facts
      UNION ALL SELECT row_id, 2, 'reading', CASE WHEN negative_group = '' AND product_score > 0 THEN 'Agreed' ELSE 'Doubted' END,
        CASE WHEN negative_group <> '' THEN 'contradicted by ' || negative_group WHEN product_score > 0 THEN 'supported' ELSE 'silent' END FROM facts WHERE match_tier <> ''
      UNION ALL SELECT row_id, 3, 'listing', CASE WHEN ref_valid = 'Y' THEN 'Agreed' ELSE 'Doubted' END, CASE WHEN ref_valid = 'Y' THEN 'listed' ELSE 'unlisted' END FROM facts WHERE match_tier IN ('family', 'category')
      UNION ALL SELECT row_id, 4, 'border', CASE WHEN scope_flag <> '' THEN 'Dropped' ELSE 'Doubted' END, CASE WHEN scope_flag <> '' THEN scope_flag ELSE 'at_the_edge' END FROM facts WHERE scope_flag <> '' OR match_scope = 'extended'
      UNION ALL SELECT row_id, 5, 'desk', tier, primary_reason FROM facts""",
    "hits_": """SELECT row_id, 'reading' AS stage_id, 'precision' AS rule_id, qa_status AS evidence FROM facts WHERE precise UNION ALL SELECT row_id, 'border', 'beyond_scope', scope_flag FROM facts WHERE scope_flag <> ''
      UNION ALL SELECT row_id, 'reading', 'contradiction', negative_group FROM facts WHERE negative_group <> '' UNION ALL SELECT row_id, 'reading', 'vague', '1' FROM facts WHERE vague
      UNION ALL SELECT row_id, 'naming', 'plate_cue', 'plate' FROM facts WHERE contains(description, 'plate') UNION ALL SELECT row_id, 'desk', 'missed', product_score::INT::VARCHAR FROM facts WHERE include <> 'Y' AND product_score > 0
      UNION ALL SELECT row_id, 'naming', 'guessed', match_tier FROM facts WHERE match_tier IN ('manufacturer', 'hs_prior')""",
    "stages_": """SELECT * FROM (VALUES ('naming', 10, 'What names the goods', 'candidate'), ('reading', 20, 'What the text says', 'candidate'), ('listing', 25, 'In the list of goods', 'candidate'), ('border', 40, 'Within the trade looked at', 'candidate'),
      ('desk', 90, 'Decision', 'terminal')) v(stage_id, execution_order, label, stage_type)""",
}
_METRICS = "count(*) AS n_rows, sum(value)::DOUBLE AS value, sum(volume)::DOUBLE AS volume, 0 AS missing_value, 0 AS invalid_value, 0 AS missing_volume, 0 AS invalid_volume, CASE WHEN sum(volume) <> 0 THEN sum(value)::DOUBLE / sum(volume)::DOUBLE END AS weighted_price"


def fact_sql(body: str, **more: str) -> str:
    return ev_sql(body, **_FACTS, **more)


@query(fact_sql("SELECT row_id, tier FROM facts"))
def u01_terminal_tier(spark, sf_dir):
    return facts(spark, sf_dir).select("row_id", "tier")


@query(fact_sql("SELECT row_id, primary_reason, removal_stage FROM facts"))
def u02_primary_reason(spark, sf_dir):
    return facts(spark, sf_dir).select("row_id", "primary_reason", "removal_stage")


@query(fact_sql("SELECT row_id, string_agg(stage_id || '=' || outcome || ':' || reason, ' ' ORDER BY o) AS path FROM states GROUP BY row_id"))
def u03_stage_path(spark, sf_dir):
    return facts(spark, sf_dir).select("row_id", _path_text().alias("path"))


def _path_text():
    steps = F.transform("path", lambda s: F.concat(s["stage_id"], F.lit("="), s["outcome"], F.lit(":"), s["reason"]))
    return F.array_join(steps, " ")


@query("""SELECT event_id, CASE WHEN value < 20 THEN 'arrival=Void:worthless' ELSE 'arrival=In:counted' || CASE WHEN value >= 60 THEN ' size=Large:large' ELSE '' END || ' end=Done:' || event_type END AS path,
  CASE WHEN user_id % 2 = 0 THEN 'arrival:even_user:' || user_id ELSE '' END AS hits FROM events""")
def u03_registry_of_events(spark, sf_dir):
    """Any table and any stage names: the registry is read from a file."""
    path = _shared(spark, "registry")
    spark.createDataFrame([(json.dumps(fx.EVENT_REGISTRY),)], "value string").write.text(path)
    found = registry.Registry.read(spark, path)
    rows = found.prepared(fx.table(spark, sf_dir, "events")).select("event_id", found.path().alias("path"), found.hits().alias("hits"))
    hits = F.array_join(F.transform("hits", lambda h: F.concat_ws(":", h["stage_id"], h["rule_id"], h["evidence"])), " ")
    return rows.select("event_id", _path_text().alias("path"), hits.alias("hits"))


@query(fact_sql("SELECT * FROM hits_"))
def u04_rule_hits(spark, sf_dir):
    return audit.rule_hits(facts(spark, sf_dir))


@query(fact_sql("SELECT row_id, output_id, value::DOUBLE AS value, 'valid' AS value_status, sha256(description || ' ' || importer || ' ' || exporter) AS source_hash FROM facts"))
def u05_row_facts(spark, sf_dir):
    return _build_facts(spark, sf_dir).select("row_id", "output_id", F.col("value").cast("double").alias("value"), "value_status", "source_hash")


@query(fact_sql("SELECT DISTINCT row_id, rule_id AS risk_type FROM hits_ JOIN facts USING (row_id) WHERE tier <> 'Trusted'"))
def u06_risk_inventory(spark, sf_dir):
    return audit.risk_inventory(facts(spark, sf_dir))


@query(fact_sql("SELECT stage_id, outcome, count(*) AS n_rows FROM states GROUP BY ALL"))
def u07_stage_states(spark, sf_dir):
    return audit.stage_states(facts(spark, sf_dir)).groupBy("stage_id", "outcome").agg(F.count("*").alias("n_rows"))


@query(fact_sql("SELECT rule_id AS risk_type, count(*) AS n_rows, sum(value)::DOUBLE AS value FROM (SELECT DISTINCT row_id, rule_id FROM hits_) JOIN facts USING (row_id) WHERE tier <> 'Trusted' GROUP BY 1"))
def u08_risk_summary(spark, sf_dir):
    return audit.risk_summary(facts(spark, sf_dir))


@query(fact_sql(f"SELECT tier, {_METRICS} FROM facts GROUP BY tier"))
def u09_metrics(spark, sf_dir):
    return facts(spark, sf_dir).groupBy("tier").agg(*audit.metrics())


@query(fact_sql(f"SELECT coalesce(output_id, 'OVERALL') AS output_id, stage_id, outcome, execution_order, label, stage_type, {_METRICS} FROM states JOIN facts USING (row_id) JOIN stages_ USING (stage_id) GROUP BY GROUPING SETS ((output_id, stage_id, outcome, execution_order, label, stage_type), (stage_id, outcome, execution_order, label, stage_type))"))
def u10_funnel(spark, sf_dir):
    return audit.funnel(facts(spark, sf_dir), shipment_registry().stage_table(spark))


_CUBE = """SELECT '{kind}' AS kind, CASE WHEN grouping(output_id) = 1 THEN 'OVERALL' ELSE output_id END AS output_id, stage, tier, reason, concat_ws('+', CASE WHEN grouping(maker) = 0 THEN 'maker' END, CASE WHEN grouping(family) = 0 THEN 'family' END, CASE WHEN grouping(product) = 0 THEN 'product' END) AS level,
  CASE WHEN grouping(maker) = 1 THEN '' ELSE maker END AS maker, CASE WHEN grouping(family) = 1 THEN '' ELSE family END AS family, CASE WHEN grouping(product) = 1 THEN '' ELSE product END AS product, {metrics}
  FROM ({rows}) GROUP BY GROUPING SETS ({sets})"""
_SETS = ", ".join(f"({o}stage, tier, reason{lv})" for o in ("", "output_id, ") for lv in ("", ", maker", ", family", ", product", ", maker, family", ", maker, family, product"))
_PRIMARY = "SELECT *, removal_stage AS stage, primary_reason AS reason FROM facts WHERE tier <> 'Trusted'"
_SECONDARY = "SELECT f.*, h.stage_id AS stage, h.rule_id AS reason FROM facts f JOIN hits_ h USING (row_id)"


@query(fact_sql(_CUBE.format(kind="Primary", metrics=_METRICS, rows=_PRIMARY, sets=_SETS) + " UNION ALL " + _CUBE.format(kind="Secondary", metrics=_METRICS, rows=_SECONDARY, sets=_SETS)))
def u11_removal_cube(spark, sf_dir):
    return audit.removal_cube(facts(spark, sf_dir))


_RISKY = "(generic_risk OR match_tier IN ('manufacturer', 'hs_prior') OR tier <> 'Trusted')"
_SAMPLE = {
    "risky": f"SELECT output_id, row_id, value, generic_risk AS f1, match_tier IN ('manufacturer', 'hs_prior') AS f2, tier <> 'Trusted' AND include <> 'Y' AND product_score > 0 AS f3 FROM facts WHERE {_RISKY}",
    "one": """SELECT output_id, row_id, 'Targeted risk' AS sample_type, CASE WHEN f1 THEN 'Vague' WHEN f2 THEN 'Guessed' WHEN f3 THEN 'Missed' ELSE 'Not trusted' END AS stratum FROM risky
      QUALIFY row_number() OVER (PARTITION BY output_id ORDER BY f1 DESC, f2 DESC, f3 DESC, value DESC, row_id) <= 12""",
    "two": """SELECT output_id, row_id, 'Deterministic stratified-random' AS sample_type, 'Deterministic random — ' || tier AS stratum FROM (SELECT f.output_id, f.row_id, f.tier FROM facts f ANTI JOIN one USING (row_id))
      QUALIFY row_number() OVER (PARTITION BY output_id, tier ORDER BY (('0x' || left(md5(row_id), 7))::BIGINT * 1103515245 + 12345) & 2147483647, row_id) <= CASE tier WHEN 'Trusted' THEN 5 ELSE 4 END""",
    "sample_": "SELECT * FROM one UNION ALL SELECT * FROM two",
}


@query(fact_sql("SELECT * FROM sample_", **_SAMPLE))
def u12_review_sample(spark, sf_dir):
    return audit.review_sample(facts(spark, sf_dir), SAMPLE)


_CHECKS = {
    "picked": "SELECT f.*, s.sample_type FROM facts f LEFT JOIN sample_ s USING (output_id, row_id)",
    "free": "SELECT output_id, sum(least(n, CASE tier WHEN 'Trusted' THEN 5 ELSE 4 END)) AS design FROM (SELECT output_id, tier, count(*) AS n FROM picked WHERE sample_type IS DISTINCT FROM 'Targeted risk' GROUP BY ALL) GROUP BY 1",
    "per": f"""SELECT output_id, count(*) AS n, count(*) FILTER (sample_type = 'Targeted risk') AS targeted, count(*) FILTER (sample_type <> 'Targeted risk') AS random, count(*) FILTER {_RISKY} AS risky,
      sum(value)::DOUBLE AS v, sum(volume)::DOUBLE AS q, count(*) FILTER (match_tier IN ('manufacturer', 'hs_prior') AND tier <> 'Trusted') AS odd FROM picked GROUP BY 1""",
    "kept": "SELECT output_id, count(DISTINCT row_id) AS kept FROM hits_ JOIN facts USING (row_id) WHERE rule_id = 'guessed' AND tier <> 'Trusted' GROUP BY 1",
    "ends": "SELECT output_id, count(*) AS en, sum(value)::DOUBLE AS ev, sum(volume)::DOUBLE AS eq FROM states JOIN facts USING (row_id) WHERE stage_id = 'desk' GROUP BY 1",
    "want": "SELECT country AS output_id, count(*) AS want FROM ship GROUP BY 1",
    "checks": """SELECT output_id, unnest(['source rows', 'one terminal tier', 'targeted sample', 'random sample', 'value', 'volume', 'retained: guessed']) AS check_name,
      unnest([n, n, targeted, random, ev, eq, coalesce(kept, 0)]::DOUBLE[]) AS observed, unnest([want, want, least(12, risky), design, v, q, odd]::DOUBLE[]) AS expected
      FROM want JOIN per USING (output_id) LEFT JOIN free USING (output_id) LEFT JOIN kept USING (output_id) JOIN ends USING (output_id)
      UNION ALL SELECT 'OVERALL', unnest(['outputs add up: rows', 'outputs add up: value', 'outputs add up: volume']), unnest([count(*), sum(value), sum(volume)]::DOUBLE[]), unnest([count(*), sum(value), sum(volume)]::DOUBLE[]) FROM facts""",
}


@query(fact_sql("SELECT output_id, check_name, round(observed, 2) AS observed, round(expected, 2) AS expected, CASE WHEN abs(observed - expected) < 0.005 THEN 'PASS' ELSE 'FAIL' END AS status FROM checks", **_SAMPLE, **_CHECKS))
def u13_reconciliation(spark, sf_dir):
    f = facts(spark, sf_dir)
    expected = fx.shipments(spark, sf_dir).groupBy(F.col("country").alias("output_id")).agg(F.count("*").alias("n_rows"))
    out = audit.reconciliation(f, audit.review_sample(f, SAMPLE), audit.funnel(f), audit.risk_inventory(f, ["output_id"]), expected, SAMPLE, shipment_registry().last, RETAINED)
    return out.withColumns({"observed": F.round("observed", 2), "expected": F.round("expected", 2)})


@query(fact_sql("SELECT s.*, tier, primary_reason, maker, family, product, value::DOUBLE AS value FROM sample_ s JOIN facts USING (output_id, row_id)", **_SAMPLE))
def u14_sample_view(spark, sf_dir):
    f = facts(spark, sf_dir)
    return audit.sample_view(audit.review_sample(f, SAMPLE), f).withColumn("value", F.col("value").cast("double"))


# Governance.


@query(sql("""SELECT lower(p.product) AS product, lower(p.maker) AS maker, coalesce(n_rows, 0) AS n_rows, coalesce(value, 0)::DOUBLE AS value, CASE WHEN coalesce(n_rows, 0) = 0 THEN 'error: no rows' WHEN p.ok THEN 'ok' ELSE 'error: not in master' END AS status
  FROM (SELECT DISTINCT product, maker, p_ok AS ok FROM (SELECT split_part(p_name, ' ', 2) || CASE WHEN p_size % 2 = 0 THEN ' (unspecified)' ELSE '' END AS product, 'Unspecified' AS maker, p_size % 3 <> 0 AS p_ok FROM part)) p
  LEFT JOIN (SELECT lower(product) AS product, lower(maker) AS maker, count(*) AS n_rows, sum(value::DECIMAL(18,2)) AS value FROM gated WHERE qa_status LIKE 'Review%' GROUP BY ALL) g ON g.product = lower(p.product) AND g.maker = lower(p.maker)"""))
def b01_build_proposals(spark, sf_dir):
    s = fx.table(spark, sf_dir, "part").selectExpr(
        "concat(split_part(p_name, ' ', 2), CASE WHEN p_size % 2 = 0 THEN ' (unspecified)' ELSE '' END) AS product", "'Unspecified' AS maker", "CASE WHEN p_size % 3 = 0 THEN 'nowhere' ELSE 'bolt' END AS proposed"
    ).distinct()
    m = fx.table(spark, sf_dir, "part").select(F.lit("bolt").alias("proposed")).distinct()
    out = governance.build_proposals(gated(spark, sf_dir).filter("qa_status LIKE 'Review%'"), s, ["product", "maker"], m, ["proposed"])
    return out.select("product", "maker", "n_rows", "value", "status")


@query("SELECT 'alias' AS map_name, 'x ' || p_name AS key, count(*) AS n FROM (SELECT DISTINCT p_name FROM part) GROUP BY ALL")
def b02_ingest_approved(spark, sf_dir):
    part = fx.table(spark, sf_dir, "part")
    p = part.select(F.lit("term_mappings").alias("target_table"), F.col("p_brand").alias("player"), F.col("p_name").alias("family"), F.concat(F.lit("X "), F.col("p_name"), F.lit(";")).alias("alias_entries"))
    empty_maps = spark.createDataFrame([], "map_name string, key string, value string")
    empty_terms = spark.createDataFrame([], "list_name string, term string")
    out = governance.ingest_approved(p, fx.master(spark, sf_dir), empty_maps, empty_terms)["map_rows"]
    return out.groupBy("map_name", "key").agg(F.count("*").alias("n"))


@query("SELECT s_name AS k, 'known' AS note FROM supplier UNION ALL SELECT k, 'new' FROM (SELECT DISTINCT c_name AS k FROM customer UNION SELECT s_name FROM supplier) WHERE k NOT IN (SELECT s_name FROM supplier)")
def b03_append_new(spark, sf_dir):
    known = fx.table(spark, sf_dir, "supplier").select(F.col("s_name").alias("k"))
    offered = fx.table(spark, sf_dir, "customer").select(F.col("c_name").alias("k")).unionByName(known)
    note = lambda d, n: d.withColumn("note", F.lit(n))
    return governance.append_new(note(known, "known"), note(offered, "new"), ["k"])


# Retrieval: documents as rows, benchmark items as objects.


def _objects(spark, sf_dir):
    b = fx.table(spark, sf_dir, "benchmark")
    return b.select(F.col("item_id").cast("string").alias("object_id"), F.col("item_id").cast("string").alias("target_id"), F.when(F.col("item_id") % 5 == 0, "exclusion").otherwise("target").alias("object_type"), X.norm_text("text").alias("retrieval_text"))


def _pairs(spark, sf_dir):
    docs = fx.table(spark, sf_dir, "documents")
    short = retrieval.shortlist(docs, "doc_id", "text", _objects(spark, sf_dir), 5)
    return short.join(docs.select("doc_id", "text"), "doc_id").join(_objects(spark, sf_dir), "object_id")


_TOKS = "list_distinct(regexp_extract_all(lower({}), '[a-z]{{3,}}'))"


def _short(k: int) -> str:
    return f"""a AS (SELECT doc_id, unnest({_TOKS.format('text')}) AS token FROM documents), b AS (SELECT item_id::VARCHAR AS object_id, unnest({_TOKS.format(r"trim(regexp_replace(lower(text), '[^a-z0-9]+', ' ', 'g'))")}) AS token FROM benchmark),
  short AS (SELECT doc_id, object_id, count(*) AS shared FROM a JOIN b USING (token) GROUP BY doc_id, object_id QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY count(*) DESC, object_id) <= {k})"""


@query(f"WITH {_short(5)} SELECT * FROM short")
def t1_shortlist(spark, sf_dir):
    return retrieval.shortlist(fx.table(spark, sf_dir, "documents"), "doc_id", "text", _objects(spark, sf_dir), 5)


_NORM = r"trim(regexp_replace(replace(lower({}), '&', ' and '), '[^a-z0-9]+', ' ', 'g'))"


@query(f"""WITH {_short(5)}, s AS (SELECT doc_id, object_id, {_TOKS.format(_NORM.format('d.text'))} AS x, {_TOKS.format(_NORM.format('i.text'))} AS y FROM short JOIN documents d USING (doc_id) JOIN benchmark i ON i.item_id::VARCHAR = object_id)
  SELECT doc_id, object_id, CASE WHEN len(x) > 0 AND len(y) > 0 THEN round(len(list_intersect(x, y)) / sqrt(len(x) * len(y)), 6) ELSE 0.0 END AS cosine, round(len(list_intersect(x, y)) / (len(x) + len(y) - len(list_intersect(x, y))), 6) AS jaccard FROM s""")
def t2_set_scores(spark, sf_dir):
    a, b = X.tokens(X.norm_text("text")), X.tokens("retrieval_text")
    return _pairs(spark, sf_dir).select("doc_id", "object_id", F.round(retrieval.set_cosine(a, b), 6).alias("cosine"), F.round(retrieval.jaccard(a, b), 6).alias("jaccard"))


_FLAGS = {"evidence": r"\b(ether|rein|chen|entre|amente)", "generic": r"\b(the|und|les|que)\b", "excluded": r"(keit|cion|tion)\b"}


def _flagged(spark, sf_dir):
    """Documents as rows to be matched: normalised text, and flags by cues as stand-ins of a domain's."""
    docs = fx.table(spark, sf_dir, "documents").select("doc_id", X.norm_text("text").alias("text"))
    return docs.select("doc_id", "text", *(F.coalesce(F.col("text").rlike(p), F.lit(False)).alias(c) for c, p in _FLAGS.items()))


def _typed_objects(spark, sf_dir):
    """Benchmark items as objects of four kinds whose labels are words of their texts."""
    objects = _objects(spark, sf_dir)
    words, kind = F.split("retrieval_text", " "), F.col("object_id").cast("long") % 5
    some = lambda a, n: F.array_join(F.slice(words, a, n), " ")
    return objects.select(
        "object_id", F.when(kind != 4, F.col("target_id")).alias("target_id"), "retrieval_text", some(1, 1).alias("maker"), some(2, 2).alias("family"), some(4, 3).alias("alias"),
        F.when(kind == 0, "hard_exclusion_term").when(kind == 1, "reviewed_mapping_example").when(kind == 4, "product_family_alias").otherwise("canonical_tuple").alias("object_type"),
    )


_LABELS = ["object_id", "target_id", "object_type"]


def _compared(spark, sf_dir, k: int = 3, best: int | None = None, variants=("D",)):
    """The flags of each document (a table), and its candidates with the parts of their scores: max(20 k, 60) of either
    pool by shared tokens, or those of them that can be among the ``best``."""
    rows, objects = tables.staged(_flagged(spark, sf_dir), "flagged"), _typed_objects(spark, sf_dir)
    against = F.col("object_type").isin(*retrieval.AGAINST)
    pairs = retrieval.candidates(rows, "doc_id", objects, max(20 * k, 60), (~against, against), True, ("evidence", "generic"), ("target_id", "object_type"), best, variants)
    return rows.drop("text"), pairs


def _top(spark, sf_dir, k: int):
    """The best ``k`` candidates of each document in either pool."""
    return retrieval.top_k(retrieval.weigh(_compared(spark, sf_dir, best=k)[1]), "doc_id", k)


def _decided(flags, pairs, variant: str = "D"):
    return retrieval.decide(flags, retrieval.top_k(retrieval.weigh(pairs, variant), "doc_id", 3), "doc_id", variant)


@query()
def t3_phrase_score(spark, sf_dir):
    parts = fx.table(spark, sf_dir, "part")
    return parts.select("p_partkey", F.round(retrieval.phrase_score(X.norm_text(F.concat_ws(" ", "p_name", "p_type")), F.array("p_brand", "p_type")), 6).alias("score"))


@query()
def t4_score_candidates(spark, sf_dir):
    return retrieval.weigh(_compared(spark, sf_dir)[1]).select("doc_id", "object_id", *retrieval.WEIGHTS, "score", "methods")


@query()
def t5_top_k(spark, sf_dir):
    return _top(spark, sf_dir, 3).select("doc_id", "pool", "object_id", "score")


@query()
def t6_decide(spark, sf_dir):
    return _decided(*_compared(spark, sf_dir, best=3))


def _truth(spark, sf_dir):
    """(doc_id, target_id): documents with the first eight words of an item."""
    runs = match.word_runs(fx.table(spark, sf_dir, "documents"), "doc_id", X.norm_text("text"), 8)
    first = _objects(spark, sf_dir).select("target_id", F.array_join(F.slice(F.split("retrieval_text", " "), 1, 8), " ").alias("run"))
    return runs.join(first, "run").select("doc_id", "target_id").distinct()


@query()
def t7_variant_metrics(spark, sf_dir):
    flags, pairs = _compared(spark, sf_dir, best=3, variants=("B", "D"))
    pairs = tables.staged(pairs, "compared")
    out = _decided(flags, pairs, "B").withColumn("variant", F.lit("B")).unionByName(_decided(flags, pairs).withColumn("variant", F.lit("D")))
    truth = _truth(spark, sf_dir).withColumn("is_right", F.lit(True))
    out = out.join(truth, ["doc_id", "target_id"], "left")
    return retrieval.variant_metrics(out, "variant", F.coalesce("is_right", F.lit(False)))


@query()
def t7_candidate_recall(spark, sf_dir):
    return retrieval.candidate_recall(_top(spark, sf_dir, 10), _truth(spark, sf_dir), "doc_id")


@query(sql(f"""SELECT split_part(description, ' ', 1) AS term, count(*) AS n_rows, {_VAL}, array_to_string(list_sort(list_distinct(list(country))), ',') AS countries, array_to_string(list_sort(list_distinct(list(hs4))), ',') AS reasons FROM ship GROUP BY 1""", "ship"))
def t8_new_target_clusters(spark, sf_dir):
    rows = fx.shipments(spark, sf_dir).withColumn("terms", F.regexp_replace("description", " ", ";"))
    return retrieval.new_target_clusters(rows, "terms", "country", "hs4")


@query(sql("SELECT term, count(*) AS n FROM (SELECT unnest(string_split(description, ' ')) AS term FROM ship) GROUP BY term ORDER BY n DESC, term LIMIT 10", "ship"))
def t9_suggested_terms(spark, sf_dir):
    rows = fx.shipments(spark, sf_dir).withColumn("terms", F.regexp_replace("description", " ", ";"))
    return retrieval.suggested_terms(rows, "terms", 10)


# Sources and sinks over tables; file readers have tests.


@query(sql("SELECT row_id, hs4, country AS original_country, 'x' AS note FROM ship", "ship"))
def s03_s08_columns(spark, sf_dir):
    rows = tables.narrow(fx.shipments(spark, sf_dir), ["row_id", "hs4", "country"])
    return tables.ensure_columns(rows, {"note": "x", "hs4": "y"}, ["country"]).drop("country")


@query(sql("SELECT generic_flag = '' AS strict, count(*) AS n_rows FROM master GROUP BY 1", "master"))
def s04_load_master(spark, sf_dir):
    strict, generic, _ = master_views(spark, sf_dir)
    return tables.combine_tables({"true": strict, "false": generic}, "s").groupBy(F.col("s").cast("boolean").alias("strict")).agg(F.count("*").alias("n_rows"))


_TERM_ROWS = "SELECT p_brand AS list_name, ' ' || p_name AS term, CASE WHEN p_size % 4 = 0 THEN 'retired' ELSE 'Active' END AS status, p_partkey AS ord FROM part"


def _terms(spark, sf_dir):
    return fx.table(spark, sf_dir, "part").selectExpr("p_brand AS list_name", "concat(' ', p_name) AS term", "CASE WHEN p_size % 4 = 0 THEN 'retired' ELSE 'Active' END AS status", "p_partkey AS ord")


@query(f"SELECT list_name, trim(term) AS term, min(ord) AS ord FROM ({_TERM_ROWS}) WHERE status = 'Active' GROUP BY ALL")
def s05_active_terms(spark, sf_dir):
    return tables.active_terms(_terms(spark, sf_dir))


@query("SELECT p_brand AS map_name, p_name AS key, arg_max(p_type, p_partkey) AS value FROM part GROUP BY ALL")
def s06_active_map(spark, sf_dir):
    return tables.active_map(fx.table(spark, sf_dir, "part").selectExpr("p_brand AS map_name", "p_name AS key", "p_type AS value", "p_partkey AS ord"))


@query(f"""SELECT c.list_name, coalesce(a, 0)::BIGINT AS n_active, coalesce(n, 0) AS n_total FROM (SELECT DISTINCT p_brand AS list_name FROM part UNION SELECT DISTINCT 'map ' || p_type FROM part UNION SELECT 'empty' FROM part) c
  LEFT JOIN (SELECT list_name, count(*) FILTER (status = 'Active') AS a, count(*) AS n FROM ({_TERM_ROWS}) GROUP BY 1 UNION ALL SELECT 'map ' || p_type, count(*), count(*) FROM part GROUP BY 1) USING (list_name)""")
def s07_list_catalog_counts(spark, sf_dir):
    part = fx.table(spark, sf_dir, "part")
    maps = part.selectExpr("concat('map ', p_type) AS map_name")
    names = part.selectExpr("explode(array(p_brand, concat('map ', p_type), 'empty')) AS list_name").distinct()
    return tables.list_catalog_counts(names, _terms(spark, sf_dir), maps)


@query("SELECT p_name || '#' || row_number() OVER (PARTITION BY p_name ORDER BY p_partkey) AS id, p_partkey FROM part")
def s09_with_row_id(spark, sf_dir):
    return tables.with_row_id(fx.table(spark, sf_dir, "part"), "p_name", ["p_partkey"], "id").select("id", "p_partkey")


@query(sql("SELECT row_id FROM gated WHERE match_status = 'Matched' ORDER BY value::DOUBLE DESC, row_id LIMIT 100"))
def s13_capped_extract(spark, sf_dir):
    return tables.capped_extract(gated(spark, sf_dir), 100, "match_status", "value", "row_id").select("row_id")


@query("SELECT 'part' AS source, p_partkey AS k, p_name AS a, NULL::VARCHAR AS b FROM part UNION ALL SELECT 'supplier', s_suppkey, NULL, s_name FROM supplier")
def s14_combine_tables(spark, sf_dir):
    p = fx.table(spark, sf_dir, "part").select(F.col("p_partkey").alias("k"), F.col("p_name").alias("a"))
    s = fx.table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("k"), F.col("s_name").alias("b"))
    return tables.combine_tables({"part": p, "supplier": s})


@query("SELECT o_orderkey, 'Nation' AS market, CASE WHEN year(o_orderdate) >= 2000 THEN year(o_orderdate)::VARCHAR END AS year FROM orders")
def s15_parse_market_year(spark, sf_dir):
    o = fx.table(spark, sf_dir, "orders")
    path = F.concat(F.lit("/data/in/Nation_FY"), F.year("o_orderdate").cast("string"), F.lit("_x.csv"))
    return o.select("o_orderkey", tables.parse_market_year(path).alias("m")).select("o_orderkey", "m.market", "m.year")


def _shared(spark, label):
    """A new path in the shared folder."""
    return f"{tables.shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


@query("SELECT p_partkey::VARCHAR AS p_partkey, CASE WHEN p_size % 2 = 0 THEN p_name || ' \"x\"' ELSE p_name || ' é México' END AS p_name, p_size::VARCHAR AS p_size FROM part")
def s01_read_delimited(spark, sf_dir):
    """A folder with files in UTF-8 and files in Latin-1."""
    path = _shared(spark, "delimited")
    name = F.when(F.col("p_size") % 2 == 0, F.concat("p_name", F.lit(' "x"'))).otherwise(F.concat("p_name", F.lit(" é México")))
    rows = fx.table(spark, sf_dir, "part").select("p_partkey", name.alias("p_name"), "p_size")
    for third, encoding in ((0, "ISO-8859-1"), (1, "UTF-8"), (2, "ISO-8859-1")):
        part = rows.filter(F.col("p_partkey") % 3 == third)
        part.write.mode("append").csv(path, sep="\t", header=True, quote='"', escape='"', encoding=encoding)
    return tables.read_delimited(spark, path, "\t", ["p_partkey", "p_name", "p_size"])


@query("SELECT CASE WHEN n_nationkey % 2 = 0 THEN n_name ELSE upper(n_name) END AS country, n_regionkey::VARCHAR AS segment, n_nationkey::DOUBLE AS upper_value FROM nation")
def s10_write_and_read_slices(spark, sf_dir):
    path, nation = _shared(spark, "slices"), fx.table(spark, sf_dir, "nation")
    none = F.lit("").alias
    rows = nation.select(
        F.when(F.col("n_nationkey") % 2 == 0, F.col("n_name")).otherwise(F.upper("n_name")).alias("country"), F.col("n_regionkey").cast("string").alias("segment"),
        F.col("n_nationkey").cast("double").alias("upper_value"), *map(none, ("sub_segment", "product", "family", "maker")), "n_nationkey",
    )
    tables.write_slice(rows.withColumn("upper_value", F.lit(-1.0)).drop("n_nationkey"), path)
    for odd in (0, 1):  # two runs replace each its own slices
        tables.write_slice(rows.filter(F.col("n_nationkey") % 2 == odd).drop("n_nationkey"), path)
    return tables.read_slices(spark, path).select("country", "segment", "upper_value")


@query("""SELECT 'lineitem' AS "table", 'l_orderkey' AS "column", true AS found, count(*) AS n_rows, count(*) - count(l_orderkey) AS n_missing FROM lineitem
  UNION ALL SELECT 'lineitem', 'l_unit', false, count(*), NULL FROM lineitem UNION ALL SELECT 'labels', 'toxic', true, count(*), count(*) - count(toxic) FROM labels
  UNION ALL SELECT 'documents', 'text', true, count(*), count(*) - count(text) FROM documents UNION ALL SELECT 'documents', 'licence', false, count(*), NULL FROM documents""")
def s02_column_check(spark, sf_dir):
    required = {"lineitem": ["l_orderkey", "l_unit"], "labels": ["toxic"], "documents": ["text", "licence"]}
    return tables.column_check({n: fx.table(spark, sf_dir, n) for n in required}, required)


@query("""SELECT n_name AS country, count(*) AS n_rows, sum(round(l_extendedprice * 100)::BIGINT * CASE WHEN n_nationkey % 2 = 0 THEN 2 ELSE 1 END)::BIGINT AS cents
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1""")
def s12_publish_slices(spark, sf_dir):
    """All slices are published; then those of even nations anew, and once with a wrong count, which fails
    and changes nothing."""
    path, nation = _shared(spark, "published"), fx.table(spark, sf_dir, "nation").select("n_name", "n_nationkey")
    rows = fx.shipments(spark, sf_dir).select("row_id", "country", F.round(F.col("value").cast("double") * 100).cast("long").alias("cents"))
    want = {r.country: (r.n, r.v) for r in rows.groupBy("country").agg(F.count("*").alias("n"), F.sum("cents").alias("v")).collect()}
    tables.publish_slices(rows, path, {c: n for c, (n, _) in want.items()}, value="cents", totals={c: v for c, (_, v) in want.items()})
    even = [r.n_name for r in nation.filter("n_nationkey % 2 = 0").collect() if r.n_name in want]
    twice = rows.filter(F.col("country").isin(*even)).withColumn("cents", F.col("cents") * 2)
    tables.publish_slices(twice, path, {c: want[c][0] for c in even}, value="cents", totals={c: 2 * want[c][1] for c in even})
    try:
        tables.publish_slices(twice.withColumn("cents", F.lit(0).cast("long")), path, {c: want[c][0] + 1 for c in even})
    except ValueError:
        pass
    return tables.read_published(spark, path).groupBy("country").agg(F.count("*").alias("n_rows"), F.sum("cents").alias("cents"))


@query(r"""SELECT src_file, maker, desc_key, code, value_key FROM (SELECT CASE WHEN p_size % 2 = 0 THEN 'even' ELSE 'odd' END AS src_file, CASE WHEN p_size % 2 = 0 THEN p_brand END AS maker, trim(regexp_replace(lower(p_name || '-' || p_type), '[^a-z0-9]+', ' ', 'g')) AS desc_key,
  p_partkey::VARCHAR AS code, round_even(p_retailprice, 0)::BIGINT AS value_key, p_size FROM part) WHERE p_size % 3 = 1""")
def s11_ground_truth(spark, sf_dir):
    part = fx.table(spark, sf_dir, "part").select(
        F.concat_ws("-", "p_name", "p_type").alias("description"), F.col("p_partkey").cast("string").alias("hs_code"), F.col("p_retailprice").cast("string").alias("value"),
        (F.col("p_size") % 3 + 2000).cast("string").alias("year"), F.col("p_brand").alias("maker"), "p_size",
    )
    files = {"even": part.filter("p_size % 2 = 0").drop("p_size"), "odd": part.filter("p_size % 2 = 1").drop("p_size", "maker")}
    out = tables.build_ground_truth(files, ["description", "hs_code", "value", "year", "maker"], "year", "2001")
    return out.select("src_file", "maker", "desc_key", "code", "value_key")


@query("SELECT n_name AS country, count(*) AS n FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1")
def s12_row_count_gate(spark, sf_dir):
    rows = fx.shipments(spark, sf_dir)
    return tables.assert_row_count(rows, fx.table(spark, sf_dir, "lineitem").count(), "shipments").groupBy("country").agg(F.count("*").alias("n"))


@query("""SELECT r_name AS stage_id, '1' AS version, r_regionkey * 10 AS execution_order, 'Region ' || r_name AS label, CASE WHEN r_regionkey = 4 THEN 'terminal' ELSE 'candidate' END AS stage_type,
  'On,Off' AS outcomes, CASE WHEN r_regionkey = 4 THEN '' ELSE 'On' END AS continues, 'first,second' AS reason_precedence FROM region""")
def u15_registry_stages(spark, sf_dir):
    """A registry whose stages are the regions, written by Spark and read as a file."""
    path, region = _shared(spark, "registry"), fx.table(spark, sf_dir, "region")
    last = F.col("r_regionkey") == 4
    goes_on = F.struct((~last).alias("On"), F.lit(False).alias("Off"))
    case = F.struct(F.lit("first").alias("reason"), F.lit("On").alias("outcome"))
    one = F.struct(
        F.col("r_name").alias("stage_id"), F.lit("1").alias("version"), (F.col("r_regionkey") * 10).alias("execution_order"), F.concat(F.lit("Region "), "r_name").alias("documentation_label"),
        F.when(last, "terminal").otherwise("candidate").alias("stage_type"), F.array(F.lit("On"), F.lit("Off")).alias("outcomes"), goes_on.alias("row_continues"),
        F.array(F.lit("first"), F.lit("second")).alias("reason_precedence"), F.array(case).alias("cases"),
    )
    region.agg(F.collect_list(one).alias("stages")).write.json(path)  # a registry has a few stages
    out = audit.registry_stages(spark, path)
    return out.withColumns({c: F.array_join(c, ",") for c in ("outcomes", "continues", "reason_precedence")})
