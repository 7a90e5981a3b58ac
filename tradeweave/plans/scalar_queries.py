"""Queries for the column expressions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tradeweave.functions import predicates as P
from tradeweave.functions import text as X
from tradeweave.sources import fixtures as fx

from .registry import register

_LABEL = "concat_ws(' ', '  ', p_name, '-', p_type, '|', p_brand || '®/' || p_size || 's')"
_STOP = ("the", "and", "for", "with")
_STOP_SQL = "('the', 'and', 'for', 'with')"


def _squeeze(x: str) -> str:
    return rf"trim(regexp_replace({x}, '\s+', ' ', 'g'))"


def _party(x: str) -> str:
    return rf"trim(regexp_replace(lower({x}), '[^a-z0-9]+', ' ', 'g'))"


def _text_query(name: str, expression, sql: str, source: str = "part") -> None:
    """A query that shows one expression of a text: of part labels, documents or shipments."""
    if source == "part":
        def run(spark, sf_dir):
            rows = fx.table(spark, sf_dir, "part").select("p_partkey", F.expr(_LABEL).alias("t"))
            return rows.select("p_partkey", expression(F.col("t")).alias("out"))

        register(name, run, f"SELECT p_partkey, {sql} AS out FROM (SELECT p_partkey, {_LABEL} AS t FROM part)")
    elif source == "documents":
        def run(spark, sf_dir):
            rows = fx.table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("t"))
            return rows.select("doc_id", expression(F.col("t")).alias("out"))

        register(name, run, f"SELECT doc_id, {sql} AS out FROM (SELECT doc_id, text AS t FROM documents)")
    else:
        def run(spark, sf_dir):
            return fx.shipments(spark, sf_dir).select("row_id", expression(None).alias("out"))

        register(name, run, f"SELECT row_id, {sql} AS out FROM ({fx.SHIPMENTS_SQL})")


def _list(sql: str) -> str:
    """An array's elements sorted and joined: order inside an array isn't part of a result."""
    return f"array_to_string(list_sort({sql}), ' ')"


def _joined(array):
    return F.array_join(F.array_sort(array), " ")


def _size_and_hash(array):
    return F.concat_ws(":", F.size(array).cast("string"), F.md5(_joined(array)))


def _size_and_hash_sql(sql: str) -> str:
    return f"concat_ws(':', len({sql})::VARCHAR, md5({_list(sql)}))"


_text_query("n01_norm_exact", X.norm_exact, f"lower({_squeeze('t')})")
_LOOSE = r"lower(trim(regexp_replace(regexp_replace(regexp_replace({}, '[™®©]', '', 'g'), '[_\-–—/\\]+', ' ', 'g'), '\s+', ' ', 'g')))"
_text_query("n02_norm_loose", X.norm_loose, _LOOSE.format("t"))
_PHRASE = r"trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower({}), '[_/]', ' ', 'g'), 's\b', '', 'g'), '[^a-z0-9 ]', ' ', 'g'), '\s+', ' ', 'g'))"
_text_query("n03_norm_phrase", X.norm_phrase, _PHRASE.format("t"))
_text_query("n04_norm_party", X.norm_party, _party("t"))
_text_query("n05_norm_text", X.norm_text, _party("replace(t, '&', ' and ')"), "documents")
_text_query("n06_desc_key", X.desc_key, _party("t"), "documents")
_text_query(
    "n07_normalize_text", X.normalize_text,
    r"trim(regexp_replace(replace(lower(strip_accents(t)), '&', ' and '), '[^a-z0-9./+\-]+', ' ', 'g'))", "documents",
)
_text_query(
    "n08_canon_sep", X.canon_sep,
    _squeeze(r"regexp_replace(regexp_replace(regexp_replace(t, '\s*\|\s*', '_', 'g'), '\s+[-–—]\s+', '_', 'g'), '\s*_\s*', '_', 'g')"),
)
_WORDS = "list_filter(regexp_split_to_array(lower(t), '[^a-z0-9]+'), lambda w: w <> '')"
_text_query("n09_canon_tokens", lambda t: F.array_join(X.canon_tokens(t), " "), _list(f"list_distinct({_WORDS})"))
_TOKENS = f"list_filter(list_distinct(regexp_extract_all(lower(t), '[a-z]{{3,}}')), lambda w: w NOT IN {_STOP_SQL})"
_text_query("n10_tokens", lambda t: _size_and_hash(X.tokens(t, 3, _STOP)), _size_and_hash_sql(_TOKENS), "documents")
_SING = "CASE WHEN length(w) > 3 AND w LIKE '%s' THEN left(w, length(w) - 1) ELSE w END"
_text_query("n11_sing", lambda t: X.sing(X.norm_party(t)), f"(SELECT {_SING} FROM (SELECT {_party('t')} AS w))")
_text_query(
    "n12_cue_tokens", lambda t: _size_and_hash(X.cue_tokens(t)),
    _size_and_hash_sql(f"list_distinct(list_transform(regexp_extract_all(lower(t), '[a-z]{{3,}}'), lambda w: {_SING}))"), "documents",
)
_text_query(
    "n13_content_tokens", lambda t: _size_and_hash(X.content_tokens(t, _STOP)),
    _size_and_hash_sql(f"list_distinct(list_filter(string_split({_party('t')}, ' '), lambda w: length(w) > 2 AND w NOT IN {_STOP_SQL}))"), "documents",
)
_FW = f"list_filter(regexp_extract_all(lower(t), '[a-z]{{3,}}'), lambda w: w NOT IN {_STOP_SQL})"
_FEATURES = f"""list_concat(list_concat({_FW}, list_transform(range(1, len({_FW})), lambda i: ({_FW})[i] || '_' || ({_FW})[i + 1])),
 list_transform(list_concat(list_filter(regexp_extract_all(lower(t), '[a-z0-9]{{3,}}'), lambda w: regexp_matches(w, '[a-z]') AND regexp_matches(w, '[0-9]')),
 regexp_extract_all(lower(t), '[0-9]{{5,}}')), lambda w: 'C_' || w))"""
_text_query("n14_family_features", lambda t: _joined(X.family_features(t, _STOP)), _list(_FEATURES))
_NG = _squeeze("t")
_text_query(
    "n15_char_ngrams", lambda t: F.array_join(F.array_sort(X.char_ngrams(t, 3)), "|"),
    f"CASE WHEN length({_NG}) <= 3 THEN {_NG} ELSE array_to_string(list_sort(list_distinct(list_transform(range(1, length({_NG}) - 1), lambda i: substr({_NG}, i, 3)))), '|') END",
)
_text_query("n16_hs8", lambda _: X.hs8("hs_code"), "coalesce(TRY_CAST(TRY_CAST(hs_code AS DOUBLE) AS BIGINT)::VARCHAR, '<NA>')", "ship")
_text_query("n17_hs6", lambda _: X.hs6(F.col("hs_code")), "CASE WHEN regexp_matches(hs_code, '^[0-9]') THEN left(hs_code, 6) ELSE hs_code END", "ship")
_text_query(
    "n18_hs4", lambda _: X.hs4(F.when(F.col("month") == "1", "").otherwise(F.col("hs4")), "hs_code"),
    "CASE WHEN month = '1' THEN left(regexp_replace(hs_code, '[^0-9]', '', 'g'), 4) ELSE regexp_extract(hs4, '[0-9]{4}') END", "ship",
)
_text_query("n19_safe_number", lambda _: X.safe_number(F.when(F.col("month") == "2", "abc").otherwise(F.col("value"))), "CASE WHEN month = '2' THEN 0.0 ELSE value::DOUBLE END", "ship")
_RAW = "CASE month WHEN '1' THEN '' WHEN '2' THEN 'inf' WHEN '3' THEN '1,200' WHEN '4' THEN 'abc' ELSE value END"
_text_query(
    "n20_number_status", lambda _: F.concat_ws("/", X.number_status(F.expr(_RAW))["status"], F.round(X.number_status(F.expr(_RAW))["value"]).cast("bigint").cast("string")),
    "CASE month WHEN '1' THEN 'missing' WHEN '2' THEN 'invalid' WHEN '3' THEN 'valid/1200' WHEN '4' THEN 'invalid' ELSE 'valid/' || round(value::DOUBLE)::BIGINT::VARCHAR END", "ship",
)
_text_query("n21_truthy", lambda _: X.truthy(F.expr("CASE month WHEN '1' THEN ' Yes' WHEN '2' THEN 'TRUE' WHEN '3' THEN '0' ELSE month END")), "month IN ('1', '2')", "ship")
_text_query("n22_unit_price", lambda _: X.unit_price(X.number("value"), X.number("quantity") - 10), "CASE WHEN quantity::DOUBLE - 10 > 0 THEN value::DOUBLE / (quantity::DOUBLE - 10) END", "ship")
_text_query("n23_row_text", lambda _: X.row_text("description", "importer", "exporter", F.lit(None)), "description || ' ' || importer || ' ' || exporter || ' '", "ship")
_text_query("n24_is_blank", lambda _: X.is_blank(F.expr("CASE month WHEN '1' THEN ' Unspecified ' WHEN '2' THEN NULL WHEN '3' THEN 'NaN' ELSE description END")), "month IN ('1', '2', '3')", "ship")
_text_query("n25_blank_to", lambda _: X.blank_to(F.expr("CASE month WHEN '1' THEN '' WHEN '2' THEN NULL ELSE description END"), "Unspecified"), "CASE WHEN month IN ('1', '2') THEN 'Unspecified' ELSE description END", "ship")
_ROUND = "CASE WHEN v - floor(v) = 0.5 AND floor(v)::BIGINT % 2 = 0 THEN floor(v) ELSE floor(v + 0.5) END"
_ROW_KEY = f"{_party('description')} || '|' || hs_code || '|' || (SELECT ({_ROUND})::BIGINT::VARCHAR FROM (SELECT value::DOUBLE AS v))"
_text_query("n26_row_key", lambda _: X.row_key("description", "hs_code", "value"), _ROW_KEY, "ship")
_MD5 = "md5({})"


def bucket_sql(key: str, buckets: int = 1000) -> str:
    """md5 of a text as a 128-bit number modulo ``buckets``."""
    parts, out = [f"('0x' || substr(md5({key}), {8 * k + 1}, 8))::BIGINT" for k in range(4)], "0"
    for p in parts:
        out = f"(({out}) * {2**32 % buckets} + {p}) % {buckets}"
    return out


_text_query("n27_hash_bucket", lambda t: X.hash_bucket(t), bucket_sql("t"), "documents")
_text_query("n28_source_hash", X.source_hash, "sha256(t)", "documents")
_text_query(
    "n29_value_band", lambda _: X.value_band(X.number("value") * 4),
    "CASE WHEN value::DOUBLE * 4 >= 250000 THEN 'P0 >=250K' WHEN value::DOUBLE * 4 >= 100000 THEN 'P1 100K-250K' WHEN value::DOUBLE * 4 >= 50000 THEN 'P2 50K-100K' WHEN value::DOUBLE * 4 >= 25000 THEN 'P3 25K-50K' ELSE '' END", "ship",
)
_text_query("n30_model_codes", lambda t: F.array_join(X.model_codes(F.regexp_replace(t, "#", " b")), " "), r"array_to_string(list_sort(list_distinct(regexp_extract_all(lower(replace(t, '#', ' b')), '\b([a-z]{1,4}[0-9]{1,6})\b', 1))), ' ')")
_ALIAS = "p_name || '; ' || p_type || ' => ' || p_brand || ';; '"


def n31_alias_entries(spark, sf_dir):
    rows = fx.table(spark, sf_dir, "part").select("p_partkey", F.explode(X.alias_entries(F.expr(_ALIAS))).alias("e"))
    return rows.select("p_partkey", "e.term", "e.target")


register("n31_alias_entries", n31_alias_entries, f"""SELECT p_partkey, trim(split_part(e, '=>', 1)) AS term, trim(split_part(e, '=>', 2)) AS target FROM (SELECT p_partkey, unnest(string_split({_ALIAS}, ';')) AS e FROM part) WHERE trim(e) <> ''""")
_text_query("n32_target_id", lambda t: X.target_id(t, F.lit(" A  b"), F.lit(None)), f"lower({_squeeze('t')}) || '|a b|'")
_text_query("n33_target_list", lambda t: X.target_list(F.concat(F.lit("term_lists: "), F.regexp_replace(X.norm_party(t), " ", "_"), F.lit(" (note)"))), f"replace({_party('t')}, ' ', '_')")

# Predicates over shipments.


def _row():
    return F.lower(F.col("description"))


_T = "lower(description)"
_IN = lambda codes: ", ".join(map(str, codes))
_pred = lambda name, expression, sql: _text_query(name, lambda _: expression(), sql, "ship")
_pred("p01_match_allowed", lambda: P.match_allowed("hs4", fx.CORE, fx.EXCLUDED, open_gate=False), f"hs4::INT IN ({_IN(fx.CORE)})")
_pred("p02_scope_label", lambda: P.scope_label("hs4", fx.CORE), f"CASE WHEN hs4::INT IN ({_IN(fx.CORE)}) THEN 'core' ELSE 'extended' END")
_pred("p03_has_cue", lambda: P.has_cue("description", ("hot", "PROMO".lower())), f"contains({_T}, 'hot') OR contains({_T}, 'promo')")
_GROUP = rf"CASE WHEN regexp_matches({_T}, '\bold\b') THEN 'g1' WHEN regexp_matches({_T}, '\bsmall\b') THEN 'g2' ELSE '' END"
_pred("p04_first_group", lambda: P.first_group(_row(), fx.SCOPE_GROUPS), _GROUP)
_HIT = rf"CASE WHEN regexp_matches({_T}, '\bold\b') THEN 'g1:old' WHEN regexp_matches({_T}, '\bsmall\b') THEN 'g2:small' END"


def _pair(hit):
    return F.when(hit.isNotNull(), F.concat_ws(":", hit["name"], hit["hit"]))


_pred("p05_first_hit", lambda: _pair(P.first_hit(_row(), fx.SCOPE_GROUPS)), _HIT)
_pred("p06_union_pattern", lambda: _row().rlike(P.union_pattern(["red", "bro(ken", "", r"\bnew\b"])), rf"contains({_T}, 'red') OR regexp_matches({_T}, '\bnew\b')")
_pred("p07_scope_hit", lambda: _pair(P.scope_hit(_row(), fx.SCOPE_GROUPS, fx.WHITELIST)), rf"CASE WHEN regexp_matches({_T}, '\bwidget\b') THEN NULL ELSE {_HIT} END")
_pred("p08_unspecified", lambda: P.unspecified(F.expr("CASE month WHEN '1' THEN 'Ring (unspecified)' ELSE 'x' END"), F.expr("CASE month WHEN '2' THEN ' ' ELSE 'y' END"), F.expr("CASE month WHEN '3' THEN 'Unspecified' ELSE 'z' END")), "month IN ('1', '2', '3')")
_pred("p09_risk_token", lambda: P.risk_token("description", "exporter", ("old", "new", "small ring")), rf"CASE WHEN contains(' ' || {_party('description')} || ' ', ' small ring ') THEN 'small ring' WHEN regexp_matches({_T}, '\bnew\b') THEN 'new' WHEN regexp_matches({_T}, '\bold\b') THEN 'old' ELSE '' END")
_pred("p10_label_in_text", lambda: P.label_in_text(F.split("description", " ")[1], X.norm_text(F.concat_ws(" ", F.split("description", " ")[0], F.when(F.col("month") == "1", F.col("description"))))), "month = '1'")
_pred("p11_product_evidence", lambda: P.product_evidence(F.split("description", " ")[1], _row(), {"gear": "large|red", "bolt": "cold"}, "promo"),
      f"CASE WHEN split_part(description, ' ', 2) = 'gear' THEN nullif(regexp_extract({_T}, 'large|red'), '') WHEN split_part(description, ' ', 2) = 'bolt' THEN nullif(regexp_extract({_T}, 'cold'), '') ELSE nullif(regexp_extract({_T}, 'promo'), '') END")
_FAMILY = "CASE WHEN month IN ('3', '5') THEN 'march' ELSE 'other' END"
_NAMED = "CASE WHEN year = '1998' THEN 'march ' ELSE '' END"
_pred("p12_month_as_brand", lambda: P.month_as_brand(F.expr(_FAMILY), F.concat(F.expr(_NAMED), _row()), ("march", "june"), _row().rlike("promo"), _row().rlike("hot"), _row().rlike("ring")),
      f"month IN ('3', '5') AND year = '1998' AND (NOT contains({_T}, 'ring') OR contains({_T}, 'promo') OR contains({_T}, 'hot'))")
_pred("p13_lacks_context", lambda: P.lacks_context(F.expr(_FAMILY), "march", F.col("exporter").rlike("1$"), _row().rlike("ring|rod"), _row().rlike("hot")),
      f"month IN ('3', '5') AND NOT (exporter LIKE '%1' AND regexp_matches({_T}, 'ring|rod') AND NOT contains({_T}, 'hot'))")
_pred("p14_domain_conflict", lambda: P.domain_conflict(_row(), "hot", P.first_group(_row(), fx.SCOPE_GROUPS), "g2"), rf"contains({_T}, 'hot') OR ({_GROUP}) = 'g2'")
_pred("p15_independent_signal", lambda: P.independent_signal(_row(), "red gear", X.number("value"), "plate"), f"contains({_T}, 'red gear') OR (value::DOUBLE >= 50000 AND contains({_T}, 'plate'))")
_pred("p16_extended_false_positive", lambda: P.extended_false_positive(F.col("hs4") == "9020", _row().rlike("hot"), _row().rlike("ring"), _row().rlike("old|new"), _row().rlike("gear")),
      f"hs4 = '9020' AND NOT contains({_T}, 'ring') AND (contains({_T}, 'hot') OR (regexp_matches({_T}, 'old|new') AND NOT contains({_T}, 'gear')))")
_pred("p17_product_support", lambda: P.product_support(F.when(_row().rlike("red"), 10).otherwise(0), F.lit("gear"), _row()), f"contains({_T}, 'red') OR contains({_T}, 'gear')")
_pred("p18_code_review_hit", lambda: _pair(P.code_review_hit(F.col("hs4"), "9020", _row(), fx.SCOPE_GROUPS)), f"CASE WHEN hs4 = '9020' THEN {_HIT} END")
