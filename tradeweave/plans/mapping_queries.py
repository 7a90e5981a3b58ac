"""Queries for dictionaries, matching, guards, mapping, gate and aggregates (L, M, G, A, R, D)."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeweave.functions import predicates as P
from tradeweave.functions import text as X
from tradeweave.operators import aggregate, gate, guards, lexicon, mapping, match
from tradeweave.sources import fixtures as fx
from tradeweave.sources import tables

from .mapping import PARTIES, Rules, distinct_texts, gate_texts, judge_texts, map_rows
from .registry import query

RULES = Rules(
    core=fx.CORE, exclude=fx.EXCLUDED, heads=fx.HEADS, negative=fx.NEGATIVE_CUES, guard_rules=fx.GUARD_RULES,
    scope_groups=fx.SCOPE_GROUPS, whitelist=fx.WHITELIST, generic=("small ring", "red ring"), capital="promo",
)
BLACKLIST = ("red bolt", "cold rod")


def master_views(spark, sf_dir):
    return tables.load_master(fx.master(spark, sf_dir), {}, "generic_flag")


def keywords(spark, sf_dir) -> DataFrame:
    strict, _, _ = master_views(spark, sf_dir)
    return lexicon.build_keywords(strict, spark.createDataFrame([(t,) for t in BLACKLIST], "term string"))


def cores(spark, sf_dir) -> DataFrame:
    s = fx.table(spark, sf_dir, "supplier")
    rows = s.filter("s_suppkey % 3 = 0").select(F.col("s_name").alias("core"), F.concat(F.lit("Maker "), F.col("s_suppkey").cast("string")).alias("canonical"))
    extra = s.filter("s_suppkey % 5 = 0").select(F.col("s_name").alias("core"), F.lit("Harvested").alias("canonical"))
    return lexicon.build_makers(rows, extra)


def curated(spark) -> DataFrame:
    return lexicon.as_rows(spark, fx.CURATED_PHRASES | {"odd thing": "nothing"}, "phrase", "product")


_STAGES: dict[tuple, object] = {}


#: The tables that stages read.
STAGE_TABLES = ("lineitem", "part", "orders", "supplier", "customer", "nation")


def stage(spark, sf_dir, name: str, build, keep: bool = True) -> DataFrame:
    """The stage table ``name`` over the tables of ``sf_dir``, built once in an application as long as
    their files don't change. What has one reader needn't be kept: it is the table if there is one, else
    the plan of it.

    Many queries look at the same trade rows and judged texts; as in a real run these are tables.
    """
    return once(spark, sf_dir, name, lambda s, d: tables.staged(build(s, d), name)) if keep else once(spark, sf_dir, name, build, False)


def once(spark, sf_dir, name: str, build, keep: bool = True):
    """What ``build`` makes of the tables of ``sf_dir``, kept for the application as long as their files don't change."""
    state = tables.file_state(spark, [f"{sf_dir}/{t}.parquet" for t in STAGE_TABLES])
    key = (spark.sparkContext.applicationId, sf_dir, name, state)
    if key not in _STAGES:
        made = build(spark, sf_dir)
        if not keep:
            return made
        _STAGES[key] = made
    return _STAGES[key]


def forget() -> None:
    """Stage tables are built anew from here on."""
    _STAGES.clear()


def shipments(spark, sf_dir) -> DataFrame:
    """The trade rows as a table."""
    return stage(spark, sf_dir, "rows", fx.shipments)


def judged(spark, sf_dir) -> DataFrame:
    """The distinct texts of the rows with their labels."""
    strict, _, _ = master_views(spark, sf_dir)
    return stage(spark, sf_dir, "judged", lambda s, d: judge_texts(shipments(s, d), strict, curated(s), RULES, keywords(s, d)))


def makers(spark, sf_dir) -> dict[str, DataFrame]:
    return once(spark, sf_dir, "makers", lambda s, d: match.party_values(shipments(s, d), PARTIES, cores(s, d)))


def mapped(spark, sf_dir) -> DataFrame:
    return map_rows(shipments(spark, sf_dir), judged(spark, sf_dir), makers(spark, sf_dir))


def gated(spark, sf_dir) -> DataFrame:
    """What the gate says of a text becomes a table; rows only look it up."""
    strict, generic, _ = master_views(spark, sf_dir)
    texts = stage(spark, sf_dir, "gated", lambda s, d: gate_texts(judged(s, d), strict, generic, RULES))
    return map_rows(shipments(spark, sf_dir), texts, makers(spark, sf_dir))


def trusted(spark, sf_dir) -> DataFrame:
    """What lists, line items and roll-ups need of trusted rows."""
    return aggregate.trusted(gated(spark, sf_dir))


CTES = {
    "ship": fx.SHIPMENTS_SQL,
    "master": fx.MASTER_SQL,
    "strict": "SELECT * FROM master WHERE generic_flag = ''",
    "keywords": """SELECT lower(family) AS keyword, left(lower(family), 4) AS prefix, length(family)::INT AS len, segment, sub_segment, product, player, family FROM strict
      WHERE lower(family) NOT IN ('red bolt', 'cold rod') QUALIFY row_number() OVER (PARTITION BY lower(family) ORDER BY segment, sub_segment, player, product) = 1""",
    "hits": "SELECT row_id, keyword FROM ship JOIN keywords ON contains(' ' || lower(description) || ' ', ' ' || keyword || ' ') WHERE hs4 <> '9023'",
    "fam": """SELECT h.row_id, k.* FROM hits h JOIN keywords k USING (keyword) JOIN ship s USING (row_id)
      WHERE NOT (product = 'gear' AND contains(lower(description), 'blue') AND NOT contains(lower(description), 'large'))""",
    "code_segment": """SELECT hs_code, segment, n / total AS share FROM (SELECT hs_code, segment, n, sum(n) OVER (PARTITION BY hs_code) AS total,
      row_number() OVER (PARTITION BY hs_code ORDER BY n DESC, segment) AS r FROM (SELECT hs_code, segment, count(*) AS n FROM fam JOIN ship USING (row_id) GROUP BY ALL)) WHERE r = 1""",
    "pair": """SELECT product, segment, sub_segment FROM (SELECT product, segment, sub_segment, count(*) AS n FROM strict GROUP BY ALL)
      QUALIFY row_number() OVER (PARTITION BY product ORDER BY n DESC, segment, sub_segment) = 1""",
    "phrases": """SELECT phrase, segment, sub_segment, product, 'high' AS confidence FROM (VALUES ('red bolt', 'bolt'), ('cold rod', 'rod')) v(phrase, product) JOIN pair USING (product)""",
    "catrows": "SELECT * FROM ship WHERE hs4 <> '9023' AND NOT contains(lower(description), 'hot') AND row_id NOT IN (SELECT row_id FROM fam)",
    "byphrase": """SELECT row_id, phrase, p.product, p.segment, p.sub_segment, confidence FROM catrows JOIN phrases p
      ON contains(' ' || trim(regexp_replace(regexp_replace(lower(description), 's\\b', '', 'g'), '[^a-z0-9 ]', ' ', 'g')) || ' ', ' ' || phrase || ' ')""",
    "byhead": """SELECT row_id, head AS phrase, upper(left(head, 1)) || substr(head, 2) || ' (unspecified)' AS product,
      CASE WHEN share >= 0.5 THEN segment ELSE '' END AS segment, '' AS sub_segment, 'low' AS confidence
      FROM (SELECT row_id, hs_code, CASE WHEN contains(' ' || lower(description) || ' ', ' ring ') THEN 'ring' WHEN contains(' ' || lower(description) || ' ', ' plate ') THEN 'plate'
        WHEN contains(' ' || lower(description) || ' ', ' gizmo ') THEN 'gizmo' END AS head FROM catrows WHERE row_id NOT IN (SELECT row_id FROM byphrase)) h
      LEFT JOIN code_segment USING (hs_code) WHERE head IS NOT NULL""",
    "cat": "SELECT * FROM byphrase UNION ALL SELECT * FROM byhead",
    "cores": """SELECT lower(replace(s_name, '#', ' ')) AS core, 'Maker ' || s_suppkey AS canonical FROM supplier WHERE s_suppkey % 3 = 0
      UNION ALL SELECT lower(replace(s_name, '#', ' ')), 'Harvested' FROM supplier WHERE s_suppkey % 5 = 0 AND s_suppkey % 3 <> 0""",
    "mak": """SELECT row_id, canonical AS maker FROM ship JOIN cores ON lower(replace(exporter, '#', ' ')) = core
      WHERE hs4 <> '9023' AND row_id NOT IN (SELECT row_id FROM fam) AND row_id NOT IN (SELECT row_id FROM cat)""",
    "raw_mapped": """SELECT s.*, coalesce(f.segment, c.segment, '') AS segment, coalesce(f.sub_segment, c.sub_segment, '') AS sub_segment, coalesce(f.product, c.product, '') AS product,
      coalesce(f.player, m.maker, '') AS maker, coalesce(f.family, '') AS family,
      CASE WHEN f.row_id IS NOT NULL THEN 'family' WHEN c.row_id IS NOT NULL THEN 'category' WHEN m.row_id IS NOT NULL THEN 'manufacturer' ELSE '' END AS match_tier,
      CASE WHEN f.row_id IS NOT NULL THEN 'high' WHEN c.row_id IS NOT NULL THEN c.confidence WHEN m.row_id IS NOT NULL THEN 'low' ELSE '' END AS match_confidence,
      CASE WHEN hs4::INT IN (9018, 9019, 9021, 9022) THEN 'core' ELSE 'extended' END AS match_scope
      FROM ship s LEFT JOIN fam f USING (row_id) LEFT JOIN cat c USING (row_id) LEFT JOIN mak m USING (row_id)""",
    "mapped": """SELECT * REPLACE (CASE WHEN match_tier IN ('family', 'category') AND segment = '' THEN 'Unspecified' ELSE segment END AS segment,
      CASE WHEN match_tier IN ('family', 'category') AND sub_segment = '' THEN 'Unspecified' ELSE sub_segment END AS sub_segment,
      CASE WHEN match_tier IN ('family', 'category') AND product = '' THEN 'Unspecified' ELSE product END AS product,
      CASE WHEN match_tier IN ('family', 'category') AND maker = '' THEN 'Unspecified' ELSE maker END AS maker,
      CASE WHEN match_tier = 'category' THEN 'Unspecified' ELSE family END AS family),
      CASE WHEN match_tier = '' THEN 'Unmatched' ELSE 'Matched' END AS match_status,
      CASE WHEN quantity::DOUBLE > 0 THEN value::DOUBLE / quantity::DOUBLE END AS unit_price FROM raw_mapped""",
    "judged": """SELECT m.*, CASE WHEN match_tier = 'family' THEN 'Y' WHEN match_tier = 'category' AND NOT unspec AND known THEN 'Y' ELSE '' END AS ref_valid,
      CASE WHEN match_tier = 'family' THEN 'Mapped' WHEN match_tier = 'category' AND unspec THEN 'Review - unspecified' WHEN match_tier = 'category' AND known THEN 'Mapped'
        WHEN match_tier = 'category' THEN 'Review - not in reference' WHEN match_tier = 'manufacturer' THEN 'Audit - manufacturer only' ELSE 'Unmapped' END AS qa0
      FROM (SELECT m.*, contains(lower(product), '(unspecified)') OR lower(segment) IN ('', 'unspecified') OR lower(sub_segment) IN ('', 'unspecified') OR lower(product) IN ('', 'unspecified') AS unspec,
        EXISTS (SELECT 1 FROM strict s WHERE s.segment = m.segment AND s.sub_segment = m.sub_segment AND s.product = m.product) AS known FROM mapped m) m""",
    "scoped": """SELECT *, CASE WHEN match_tier IN ('family', 'category') AND NOT white AND g <> '' AND NOT own THEN g ELSE '' END AS scope_flag FROM (
      SELECT *, regexp_matches(lower(description), '\\bwidget\\b') AS white,
      CASE WHEN regexp_matches(lower(description), '\\bold\\b') THEN 'g1' WHEN regexp_matches(lower(description), '\\bsmall\\b') THEN 'g2' ELSE '' END AS g,
      match_tier = 'family' AND ref_valid = 'Y' AND CASE WHEN regexp_matches(lower(description), '\\bold\\b') THEN contains(family, 'old') ELSE contains(family, 'small') END AS own FROM judged)""",
    "demoted": "SELECT *, CASE WHEN scope_flag <> '' AND qa0 = 'Mapped' THEN 'Review - scope: ' || scope_flag ELSE qa0 END AS qa1 FROM scoped",
    "odd": "SELECT *, CASE WHEN match_tier = 'family' AND qa1 = 'Mapped' AND family IN ('small ring', 'red ring') AND contains(lower(description), 'promo') THEN 'Review - generic anomaly' ELSE qa1 END AS qa2 FROM demoted",
    "gated": """SELECT *, CASE WHEN qa2 = 'Mapped' AND match_scope <> 'core' THEN 'Review - extended scope' ELSE qa2 END AS qa_status,
      CASE WHEN qa2 = 'Mapped' AND match_scope = 'core' AND ref_valid = 'Y' AND scope_flag = '' THEN 'Y' ELSE '' END AS include FROM odd""",
}


def sql(body: str, last: str = "gated", **more: str) -> str:
    """``body`` after those common table expressions, up to ``last`` and ``more``, that it leads to."""
    names = list(CTES)
    parts = {n: CTES[n] for n in names[: names.index(last) + 1]} | more
    needed, texts = set(), [body]
    while texts:
        found = set(re.findall(r"\w+", texts.pop())) & parts.keys() - needed
        needed |= found
        texts += [parts[n] for n in found]
    return "WITH " + ",\n".join(f"{n} AS MATERIALIZED ({s})" for n, s in parts.items() if n in needed) + "\n" + body


_V = "CASE WHEN count(*) = 0 THEN 0 ELSE coalesce(sum(value::DECIMAL(18,2)), 0)::DOUBLE END"
_DIMS = "country, segment, sub_segment, product, family, maker"
_BOUNDS = f"""SELECT {_DIMS}, coalesce(sum(CASE WHEN match_tier = 'family' THEN value::DECIMAL(18,2) END), 0)::DOUBLE AS lower_value, sum(value::DECIMAL(18,2))::DOUBLE AS upper_value,
  count(CASE WHEN match_tier = 'family' THEN 1 END) AS lower_rows, count(*) AS upper_rows FROM gated WHERE match_tier IN ('family', 'category') GROUP BY ALL"""


@query(sql(_BOUNDS))
def flagship_value_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregate.value_bounds(gated(spark, sf_dir))


# Dictionaries.


@query(sql("SELECT * FROM keywords", "keywords"))
def l01_build_keywords(spark, sf_dir):
    return keywords(spark, sf_dir)


@query(sql("""SELECT keyword, segment FROM keywords UNION ALL
  SELECT lower(family), segment FROM master WHERE lower(family) NOT IN (SELECT keyword FROM keywords) QUALIFY row_number() OVER (PARTITION BY family ORDER BY segment, sub_segment, player) = 1""", "keywords"))
def l02_merge_missing(spark, sf_dir):
    _, _, full = master_views(spark, sf_dir)
    return lexicon.merge_missing(keywords(spark, sf_dir), lexicon.build_keywords(full)).select("keyword", "segment")


@query(sql("SELECT keyword, family FROM keywords UNION ALL SELECT 'alias ' || lower(p_brand), min(p_name) FROM part GROUP BY 1", "keywords"))
def l03_merge_aliases(spark, sf_dir):
    p = fx.table(spark, sf_dir, "part").groupBy("p_brand").agg(F.min("p_name").alias("f"))
    rows = p.select(F.concat(F.lit("Alias "), F.col("p_brand")).alias("key"), F.concat(F.lit("a|b|c|d|"), F.col("f")).alias("value"))
    rows = rows.unionByName(p.select(F.lit("broken").alias("key"), F.lit("a|b").alias("value")))
    return lexicon.merge_aliases(keywords(spark, sf_dir), rows)[0].select("keyword", "family")


_LABELS = """SELECT DISTINCT CASE p_size % 3 WHEN 0 THEN replace(p_name, ' ', '_') WHEN 1 THEN p_name ELSE upper(p_name) || ' ' END AS label FROM part"""


@query(f"""SELECT label, first_value(label) OVER (PARTITION BY array_to_string(list_sort(list_filter(regexp_split_to_array(lower(label), '[^a-z0-9]+'), lambda w: w <> '')), ' ')
  ORDER BY NOT contains(label, '_'), length(label), label) AS canonical FROM ({_LABELS})""")
def l04_canonical_labels(spark, sf_dir):
    label = F.expr("CASE p_size % 3 WHEN 0 THEN replace(p_name, ' ', '_') WHEN 1 THEN p_name ELSE concat(upper(p_name), ' ') END")
    return lexicon.canonical_labels(fx.table(spark, sf_dir, "part").select(label.alias("label")), "label")


@query("""SELECT p_partkey, replace(lower(trim(p_name)), ' ', '_') AS name FROM part""")
def l05_canonicalize(spark, sf_dir):
    p = fx.table(spark, sf_dir, "part")
    label = F.expr("CASE p_size % 3 WHEN 0 THEN replace(p_name, ' ', '_') WHEN 1 THEN p_name ELSE concat(upper(p_name), ' ') END")
    rows = p.select("p_partkey", label.alias("name"))
    forms = rows.select("name").unionByName(p.select(F.regexp_replace("p_name", " ", "_").alias("name")))
    return lexicon.canonicalize(rows, "name", lexicon.canonical_labels(forms, "name"))


@query(sql("SELECT phrase, 2 AS n_tokens, segment, sub_segment, product, confidence FROM phrases", "phrases"))
def l06_build_phrases(spark, sf_dir):
    strict, _, _ = master_views(spark, sf_dir)
    return lexicon.build_phrases(curated(spark), strict)[0]


@query(sql("SELECT core, 2 AS n_tokens, length(core)::INT AS len, canonical FROM cores", "cores"))
def l07_build_makers(spark, sf_dir):
    return cores(spark, sf_dir)


@query(sql("""SELECT 'full_exact' AS kind, lower(concat_ws('|', segment, sub_segment, product, player, family)) AS key FROM strict
  UNION SELECT 'category_exact', lower(concat_ws('|', segment, sub_segment, product)) FROM strict
  UNION SELECT 'category_loose', lower(concat_ws('|', segment, sub_segment, product)) FROM strict
  UNION SELECT 'full_loose', lower(concat_ws('|', segment, sub_segment, product, player, family)) FROM strict
  UNION SELECT 'generic_exact', lower(concat_ws('|', segment, sub_segment, product, player, family)) FROM master WHERE generic_flag <> ''
  UNION SELECT 'generic_loose', lower(concat_ws('|', segment, sub_segment, product, player, family)) FROM master WHERE generic_flag <> ''
  UNION SELECT 'player_family', lower(concat_ws('|', player, family)) FROM strict""", "strict"))
def l08_reference_keys(spark, sf_dir):
    strict, generic, _ = master_views(spark, sf_dir)
    keys = lexicon.build_reference_keys(strict, generic)
    return tables.combine_tables({k: d.select("key") for k, d in keys.items()}, "kind")


@query(sql("SELECT hs_code, segment AS code_segment, share FROM code_segment", "code_segment"))
def l09_code_segments(spark, sf_dir):
    words, texts = tables.staged(keywords(spark, sf_dir), "keywords"), tables.staged(distinct_texts(shipments(spark, sf_dir)), "texts")
    hits = match.match_keywords(texts, "_text", "description", words, P.match_allowed("hs4", fx.CORE, fx.EXCLUDED), ["description", "hs_code", "n"])
    rows = hits.join(words.select("keyword", "product", "segment"), "keyword")
    return match.code_segments(rows.filter(~guards.conflict("product", "description", fx.GUARD_RULES)), "hs_code", weight="n")


_SHARES = """SELECT cue, segment, n / sum(n) OVER (PARTITION BY cue) AS share FROM (
  SELECT label AS cue, segment, count(*) AS n FROM (SELECT DISTINCT product AS label, segment FROM strict UNION SELECT DISTINCT sub_segment, segment FROM strict)
  WHERE label IN ('ring', 'gear', 'bolt', 'rod') GROUP BY ALL) QUALIFY sum(n) OVER (PARTITION BY cue) >= 2"""


@query(sql(_SHARES, "strict"))
def l10_cue_shares(spark, sf_dir):
    return lexicon.cue_shares(master_views(spark, sf_dir)[0], ("ring", "gear", "bolt", "rod"))


@query("SELECT DISTINCT unnest(regexp_extract_all(lower(p_name || ' ' || p_type || ' ' || p_brand), '[a-z]{3,}')) AS token FROM part")
def l11_vocabulary(spark, sf_dir):
    return lexicon.vocabulary(fx.table(spark, sf_dir, "part"), ["p_name", "p_type", "p_brand"])


_TRAIN = "SELECT description AS text, split_part(description, ' ', 1) || ' ' || split_part(description, ' ', 2) AS family, CASE WHEN contains(description, 'red') THEN 'a' WHEN month < '3' THEN 'b' ELSE 'c' END AS label, exporter AS maker FROM ship"


def _train(spark, sf_dir):
    words = F.split("description", " ")
    return fx.shipments(spark, sf_dir).select(
        F.col("description").alias("text"), F.concat_ws(" ", words[0], words[1]).alias("family"),
        F.expr("CASE WHEN contains(description, 'red') THEN 'a' WHEN month < '3' THEN 'b' ELSE 'c' END").alias("label"), F.col("exporter").alias("maker"),
    )


@query(sql(f"""SELECT keyword, sum(n)::BIGINT AS n_rows, 1.0::DOUBLE AS present, arg_max(label, (n, label)) AS label, max(n) / sum(n) AS purity
  FROM (SELECT family AS keyword, label, count(*) AS n FROM ({_TRAIN}) GROUP BY ALL) GROUP BY keyword HAVING sum(n) >= 5 AND max(n) / sum(n) >= 0.8""", "ship"))
def l12_harvest_keywords(spark, sf_dir):
    return lexicon.harvest_keywords(_train(spark, sf_dir))


@query(sql("SELECT lower(replace(exporter, '#', ' ')) AS core, exporter AS canonical, count(*) AS n_rows FROM ship GROUP BY ALL HAVING count(*) >= 5", "ship"))
def l13_harvest_makers(spark, sf_dir):
    return lexicon.harvest_makers(_train(spark, sf_dir))


@query("SELECT DISTINCT w AS name FROM (SELECT lower(split_part(p_name, ' ', 2)) AS w FROM part) WHERE length(w) BETWEEN 5 AND 18 AND w <> 'plate'")
def l14_fuzzy_targets(spark, sf_dir):
    rows = fx.table(spark, sf_dir, "part").select(F.split("p_name", " ")[1].alias("n"))
    return lexicon.fuzzy_targets(rows, "n", ("plate",), least=5)


@query(sql("""SELECT object_type, count(DISTINCT id) AS n FROM (
  SELECT 'target' AS object_type, concat_ws('|', segment, sub_segment, product, player, family) AS id FROM strict
  UNION ALL SELECT 'alias', concat_ws('|', segment, sub_segment, product, player, family) FROM strict
  UNION ALL SELECT 'exclusion', 'old' UNION ALL SELECT 'exclusion', 'small'
  UNION ALL SELECT 'example', concat_ws('|', segment, sub_segment, product, player, family) FROM strict) GROUP BY 1""", "strict"))
def l15_retrieval_objects(spark, sf_dir):
    strict, _, _ = master_views(spark, sf_dir)
    texts = strict.withColumn("text", F.concat_ws(" ", "family", "player"))
    out = lexicon.retrieval_objects(strict, texts, lexicon.as_rows(spark, {"old": "age", "small": "size"}, "term", "category"), texts)
    return out.groupBy("object_type").agg(F.count("*").alias("n"))


# Matching.

_DOC_KEYWORDS = r"SELECT DISTINCT regexp_extract(lower(text), '[\p{L}\p{N}]{6,}') AS keyword FROM benchmark WHERE regexp_matches(lower(text), '[\p{L}\p{N}]{6,}')"


def _doc_keywords(spark, sf_dir):
    rows = fx.table(spark, sf_dir, "benchmark").select(F.regexp_extract(F.lower("text"), r"([\p{L}\p{N}]{6,})", 1).alias("keyword"))
    return rows.filter("keyword <> ''").distinct()


@query(rf"""WITH k AS ({_DOC_KEYWORDS}), w AS (SELECT doc_id, regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}]+') AS a FROM documents),
  u AS (SELECT doc_id, i - 1 AS pos, a[i] AS keyword FROM w, unnest(range(1, len(a) + 1)) AS t(i))
  SELECT doc_id, arg_min(keyword, pos) AS keyword, min(pos)::INT AS pos FROM u JOIN k USING (keyword) GROUP BY doc_id""")
def m01_match_keywords(spark, sf_dir):
    return match.match_keywords(fx.table(spark, sf_dir, "documents"), "doc_id", "text", _doc_keywords(spark, sf_dir))


_DOC_PHRASES = r"SELECT DISTINCT concat_ws(' ', w[1], w[2]) AS phrase FROM (SELECT string_split(trim(regexp_replace(regexp_replace(regexp_replace(lower(text), 's\b', '', 'g'), '[^a-z0-9 ]', ' ', 'g'), '\s+', ' ', 'g')), ' ') AS w FROM benchmark) WHERE len(w) >= 2"


def _ascii_docs(spark, sf_dir):
    """English documents: the word boundary of DuckDB's patterns knows ASCII only."""
    return fx.table(spark, sf_dir, "documents").filter("lang = 'en'")


def _ascii_text():
    """Letters beyond ASCII as spaces, as they part words, but for the two whose lower case is ASCII."""
    return F.regexp_replace(F.translate("text", "\u0130\u212a", "ik"), r"[^\x00-\x7F]", " ")


@query(rf"""WITH p AS ({_DOC_PHRASES.replace("FROM benchmark", "FROM benchmark WHERE regexp_matches(text, '^[\x00-\x7F]*$')")}),
  d AS (SELECT doc_id, ' ' || trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower(text), '[_/]', ' ', 'g'), 's\b', '', 'g'), '[^a-z0-9 ]', ' ', 'g'), '\s+', ' ', 'g')) || ' ' AS t FROM documents WHERE lang = 'en')
  SELECT doc_id, arg_min(phrase, (-length(phrase), phrase)) AS phrase FROM d JOIN p ON contains(t, ' ' || phrase || ' ') GROUP BY doc_id""")
def m02_match_phrases(spark, sf_dir):
    items = fx.table(spark, sf_dir, "benchmark").filter(F.col("text").rlike(r"^[\x00-\x7F]*$"))
    words = F.split(X.norm_phrase("text"), " ")
    phrases = items.filter(F.size(words) >= 2).select(F.concat_ws(" ", words[0], words[1]).alias("phrase"), F.lit(2).alias("n_tokens")).distinct()
    return match.match_phrases(_ascii_docs(spark, sf_dir).select("doc_id", _ascii_text().alias("text")), "doc_id", "text", phrases)


def _segments(spark, sf_dir):
    return l09_code_segments(spark, sf_dir)


@query(sql("""SELECT row_id, head AS phrase, upper(left(head, 1)) || substr(head, 2) || ' (unspecified)' AS product, CASE WHEN share >= 0.3 THEN segment ELSE '' END AS segment
  FROM (SELECT row_id, hs_code, CASE WHEN contains(description, ' ring ') THEN 'ring' WHEN contains(description, ' plate ') THEN 'plate' WHEN contains(description, ' gizmo ') THEN 'gizmo' END AS head FROM ship)
  LEFT JOIN code_segment USING (hs_code) WHERE head IS NOT NULL""", "code_segment"))
def m03_match_heads(spark, sf_dir):
    return match.match_heads(shipments(spark, sf_dir), "row_id", "description", "hs_code", fx.HEADS, _segments(spark, sf_dir), 0.3)


@query(sql("SELECT row_id, phrase, product, segment, sub_segment, confidence FROM cat", "cat", catrows="SELECT * FROM ship WHERE hs4 <> '9023' AND NOT contains(lower(description), 'hot')"))
def m04_match_category(spark, sf_dir):
    strict, _, _ = master_views(spark, sf_dir)
    phrases, _ = lexicon.build_phrases(curated(spark), strict)
    return match.match_category(shipments(spark, sf_dir), "row_id", "description", "hs_code", phrases, fx.HEADS, _segments(spark, sf_dir), fx.NEGATIVE_CUES, P.match_allowed("hs4", fx.CORE, fx.EXCLUDED))


@query(sql("SELECT row_id, core, canonical AS maker FROM ship JOIN cores ON lower(replace(exporter, '#', ' ')) = core WHERE importer <> 'Customer#000000077'", "cores"))
def m05_match_party(spark, sf_dir):
    rows = fx.shipments(spark, sf_dir)
    return match.match_party(rows, "row_id", ("importer", "exporter"), cores(spark, sf_dir), ("customer 000000077",))


@query(sql("SELECT row_id, match_tier, match_confidence FROM mapped", "mapped"))
def m06_cascade(spark, sf_dir):
    return mapped(spark, sf_dir).select("row_id", "match_tier", "match_confidence")


@query(sql("SELECT row_id, coalesce(canonical, country) AS maker FROM ship LEFT JOIN cores ON lower(replace(exporter, '#', ' ')) = core", "cores"))
def m07_derive_maker(spark, sf_dir):
    rows = fx.shipments(spark, sf_dir).withColumn("maker", F.col("country"))
    return match.derive_maker(rows, "row_id", ("importer", "exporter", "description"), cores(spark, sf_dir), "maker").select("row_id", "maker")


_TERMS = {"red": "a", "gear": "a", "small ring": "b", "large": "b", "new gear promo": "b"}
_PARTY = r"' ' || trim(regexp_replace(lower(description), '[^a-z0-9]+', ' ', 'g')) || ' '"


@query(sql(f"""SELECT row_id, array_to_string(list_sort(list(term)), ',') AS hits FROM ship JOIN (VALUES ('red'), ('gear'), ('small ring'), ('large'), ('new gear promo')) v(term)
  ON contains({_PARTY}, ' ' || term || ' ') GROUP BY row_id""", "ship"))
def m08_phrase_hits(spark, sf_dir):
    out = match.phrase_hits(fx.shipments(spark, sf_dir), "row_id", "description", lexicon.as_rows(spark, _TERMS, "term", "of"))
    return out.select("row_id", F.array_join("hits", ",").alias("hits"))


_NAMES = r"SELECT DISTINCT unnest(regexp_extract_all(lower(text), '\b[a-z]{6,18}\b')) AS name FROM benchmark WHERE regexp_matches(text, '^[\x00-\x7F]*$')"


@query(rf"""WITH names AS ({_NAMES}), d AS (SELECT doc_id, list_distinct(list_filter(string_split(trim(regexp_replace(replace(lower(text), '&', ' and '), '[^a-z0-9]+', ' ', 'g')), ' '), lambda w: regexp_full_match(w, '[a-z]{{6,18}}'))) AS w FROM documents WHERE lang = 'en'),
  t AS (SELECT doc_id, unnest(w) AS token FROM d), rare AS (SELECT token FROM t GROUP BY token HAVING count(*) <= greatest(25, (SELECT count(*) FROM d) // 500)),
  c AS (SELECT token, name, levenshtein(token, name) AS distance FROM rare JOIN names ON left(token, 1) = left(name, 1) AND abs(length(token) - length(name)) <= 2 WHERE token NOT IN (SELECT name FROM names)),
  best AS (SELECT token, min((distance, name)) AS b FROM c WHERE distance <= CASE WHEN length(name) < 10 THEN 1 ELSE 2 END GROUP BY token),
  h AS (SELECT doc_id, min((b[1], b[2], token)) AS h FROM t JOIN best USING (token) GROUP BY doc_id)
  SELECT doc_id, h[3] AS token, h[2] AS name, h[1]::INT AS distance, 1 - h[1] / greatest(length(h[2]), length(h[3])) AS similarity FROM h""")
def m09_fuzzy_match(spark, sf_dir):
    items = fx.table(spark, sf_dir, "benchmark").filter(F.col("text").rlike(r"^[\x00-\x7F]*$"))
    names = items.select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"\b([a-z]{6,18})\b"), 1)).alias("name")).distinct()
    return match.fuzzy_match(_ascii_docs(spark, sf_dir).select("doc_id", _ascii_text().alias("text")), "doc_id", "text", names)


@query(sql(f"""SELECT s.row_id, array_to_string(list_distinct(regexp_extract_all(lower(replace(description, '#', '')), '\\b([a-z]{{1,5}}[0-9]{{1,6}})\\b', 1)), ' ') AS codes,
  coalesce(array_to_string(list_sort(list(term) FILTER (k = 'a')), ','), '') AS a, coalesce(array_to_string(list_sort(list(term) FILTER (k = 'b')), ','), '') AS b
  FROM ship s LEFT JOIN (VALUES ('red', 'a'), ('gear', 'a'), ('small ring', 'b'), ('large', 'b'), ('new gear promo', 'b')) v(term, k) ON contains({_PARTY}, ' ' || term || ' ') GROUP BY s.row_id, description""", "ship"))
def m10_extract_features(spark, sf_dir):
    terms = lexicon.as_rows(spark, _TERMS, "term", "of")
    rows = fx.shipments(spark, sf_dir)
    out = match.extract_features(rows, "row_id", "description", {k: terms.filter(F.col("of") == k) for k in ("a", "b")})
    codes = rows.select("row_id", X.model_codes(F.regexp_replace("description", "#", ""), r"\b([a-z]{1,5}[0-9]{1,6})\b").alias("codes"))
    return out.drop("codes").join(codes, "row_id").select("row_id", *[F.array_join(c, "," if c != "codes" else " ").alias(c) for c in ("codes", "a", "b")])


# Guards.


@query(sql("SELECT row_id, product = 'gear' AND contains(lower(description), 'blue') AND NOT contains(lower(description), 'large') AS released FROM hits JOIN keywords USING (keyword) JOIN ship USING (row_id)", "hits"))
def g01_conflict(spark, sf_dir):
    rows = fx.shipments(spark, sf_dir)
    hits = match.match_keywords(rows, "row_id", "description", keywords(spark, sf_dir), P.match_allowed("hs4", fx.CORE, fx.EXCLUDED))
    hits = hits.join(keywords(spark, sf_dir).select("keyword", "product"), "keyword").join(rows.select("row_id", "description"), "row_id")
    return hits.select("row_id", guards.conflict("product", "description", fx.GUARD_RULES).alias("released"))


_SEG2 = "CASE WHEN hs4 = '9018' THEN 'PROMO' WHEN hs4 = '9019' THEN 'nowhere' ELSE '' END"


@query(sql(f"""SELECT r.row_id FROM (SELECT row_id, {_SEG2} AS segment, split_part(description, ' ', 2) AS cue FROM ship WHERE month <> '1') r
  LEFT JOIN shares s ON s.cue = r.cue AND s.segment = r.segment WHERE r.segment <> '' AND r.cue IN (SELECT cue FROM shares) AND coalesce(share, 0) < 0.02""", "strict", shares=_SHARES))
def g02_inconsistent(spark, sf_dir):
    shares = lexicon.cue_shares(master_views(spark, sf_dir)[0], ("ring", "gear", "bolt", "rod"))
    rows = fx.shipments(spark, sf_dir).select("row_id", "description", F.expr(_SEG2).alias("segment"), F.when(F.col("month") == "1", F.col("description")).otherwise("thing").alias("product"))
    return guards.inconsistent(rows, "row_id", "description", shares)


@query(sql("SELECT row_id, split_part(description, ' ', 1) IN ('red', 'old') AND month <> '2' AS released FROM ship", "ship"))
def g03_ambiguous(spark, sf_dir):
    rows = fx.shipments(spark, sf_dir).withColumns({"keyword": F.split("description", " ")[0], "product": F.when(F.col("month") == "2", F.split("description", " ")[1]).otherwise("other")})
    return rows.select("row_id", guards.ambiguous("keyword", "description", ["product", F.lit("none")], ("red", "old")).alias("released"))


@query(sql("SELECT row_id, split_part(description, ' ', 2) IN ('gear', 'bolt') AND contains(lower(description), 'promo') AS vetoed FROM ship", "ship"))
def g04_component_veto(spark, sf_dir):
    return fx.shipments(spark, sf_dir).select("row_id", guards.component_veto(F.split("description", " ")[1], "description", ("gear", "bolt"), ("promo",)).alias("vetoed"))


@query(sql("SELECT row_id, CASE split_part(description, ' ', 2) WHEN 'gear' THEN contains(lower(description), 'red') OR contains(lower(description), 'large') ELSE true END AS supported FROM ship", "ship"))
def g05_corroborated(spark, sf_dir):
    rows = fx.shipments(spark, sf_dir).withColumn("product", F.split("description", " ")[1])
    words = spark.createDataFrame([("gear", ["red", "large"])], "label string, words array<string>")
    return guards.corroborated(rows, "product", "description", words).select("row_id", "supported")


# Mapping and gate.

_LABEL_COLUMNS = "segment, sub_segment, product, maker, family, match_tier, match_confidence, match_scope, match_status"


@query(sql(f"SELECT row_id, {_LABEL_COLUMNS} FROM mapped", "mapped"))
def a01_assemble(spark, sf_dir):
    return mapped(spark, sf_dir).select("row_id", *_LABEL_COLUMNS.split(", "))


@query(sql("SELECT match_tier, family, maker, count(*) AS n_rows, count(unit_price) AS n_priced FROM mapped GROUP BY ALL", "mapped"))
def a02_standardize(spark, sf_dir):
    return mapped(spark, sf_dir).groupBy("match_tier", "family", "maker").agg(F.count("*").alias("n_rows"), F.count("unit_price").alias("n_priced"))


@query(sql("SELECT row_id, CASE WHEN month IN ('1', '2') THEN exporter ELSE importer END AS maker FROM ship", "ship"))
def a03_preserve_or_propose(spark, sf_dir):
    current = F.expr("CASE month WHEN '1' THEN ' Unspecified' WHEN '2' THEN NULL ELSE importer END")
    return fx.shipments(spark, sf_dir).select("row_id", mapping.preserve_or_propose(current, "exporter").alias("maker"))


_COMBOS = """SELECT DISTINCT CASE WHEN p_size % 7 = 0 THEN 'Other' ELSE p_type END AS segment, CASE WHEN p_size % 5 = 0 THEN replace(p_brand, '#', '_#') ELSE p_brand END AS sub_segment,
  split_part(p_name, ' ', 2) AS product, p_brand AS maker, CASE WHEN p_size % 2 = 0 THEN upper(p_name) WHEN p_size % 3 = 0 THEN replace(p_name, ' ', ' - ') ELSE p_name END AS family FROM part"""
_LOOSE = r"lower(trim(regexp_replace(regexp_replace({}, '[_\-–—/\\]+', ' ', 'g'), '\s+', ' ', 'g')))"


def _combos(spark, sf_dir):
    return fx.table(spark, sf_dir, "part").selectExpr(
        "CASE WHEN p_size % 7 = 0 THEN 'Other' ELSE p_type END AS segment", "CASE WHEN p_size % 5 = 0 THEN replace(p_brand, '#', '_#') ELSE p_brand END AS sub_segment",
        "split_part(p_name, ' ', 2) AS product", "p_brand AS maker",
        "CASE WHEN p_size % 2 = 0 THEN upper(p_name) WHEN p_size % 3 = 0 THEN replace(p_name, ' ', ' - ') ELSE p_name END AS family",
    ).distinct()


def _k(norm: str, columns: str) -> str:
    return "concat_ws('|', " + ", ".join(norm.format(c) for c in columns.split()) + ")"


_FIVE, _MFIVE, _THREE = "segment sub_segment product maker family", "segment sub_segment product player family", "segment sub_segment product"


@query(sql(f"""SELECT c.segment, c.sub_segment, c.product, c.maker, c.family,
  CASE WHEN x OR l.kl IS NOT NULL THEN 'Mapped' WHEN g.kl IS NOT NULL THEN 'Review - generic family' WHEN p THEN 'Review - category conflict' ELSE 'Review - not in reference' END AS qa_status,
  CASE WHEN x OR l.kl IS NOT NULL OR g.kl IS NOT NULL THEN 'Y' ELSE '' END AS ref_valid,
  CASE WHEN x THEN c.family WHEN l.kl IS NOT NULL THEN l.family WHEN g.kl IS NOT NULL THEN g.family ELSE c.family END AS new_family
  FROM (SELECT *, {_k(_LOOSE, _FIVE)} AS kl, {_k('lower({})', _FIVE)} IN (SELECT {_k('lower({})', _MFIVE)} FROM strict) AS x, {_k(_LOOSE, 'maker family')} IN (SELECT {_k(_LOOSE, 'player family')} FROM strict) AS p FROM ({_COMBOS})) c
  LEFT JOIN (SELECT {_k(_LOOSE, _MFIVE)} AS kl, min(family) AS family FROM strict GROUP BY 1) l ON l.kl = c.kl
  LEFT JOIN (SELECT {_k(_LOOSE, _MFIVE)} AS kl, min(family) AS family FROM master WHERE generic_flag <> '' GROUP BY 1) g ON g.kl = c.kl""", "strict"))
def r01_validate_families(spark, sf_dir):
    strict, generic, _ = master_views(spark, sf_dir)
    out = gate.validate_families(_combos(spark, sf_dir), lexicon.build_reference_keys(strict, generic))
    return out.select(*gate.LABELS, "qa_status", "ref_valid", "new_family")


@query(sql(f"""SELECT c.*, CASE WHEN b THEN 'Review - unspecified' WHEN k THEN CASE WHEN match_tier = 'category' THEN 'Mapped' ELSE 'Audit - prior' END ELSE 'Review - not in reference' END AS qa_status,
  CASE WHEN NOT b AND k AND match_tier = 'category' THEN 'Y' ELSE '' END AS ref_valid FROM (SELECT DISTINCT CASE WHEN family = upper(family) THEN 'category' ELSE 'hs_prior' END AS match_tier, CASE WHEN family LIKE '% - %' THEN '' ELSE segment END AS segment, sub_segment, product FROM ({_COMBOS})) c,
  LATERAL (SELECT segment = '' AS b, {_k(_LOOSE, "c.segment c.sub_segment c.product")} IN (SELECT {_k(_LOOSE, _THREE)} FROM strict) AS k)""", "strict"))
def r02_validate_categories(spark, sf_dir):
    strict, generic, _ = master_views(spark, sf_dir)
    rows = _combos(spark, sf_dir).withColumns({"match_tier": F.expr("CASE WHEN family = upper(family) THEN 'category' ELSE 'hs_prior' END"), "segment": F.expr("CASE WHEN family LIKE '% - %' THEN '' ELSE segment END")})
    out = gate.validate_categories(rows, lexicon.build_reference_keys(strict, generic))
    return out.select("match_tier", "segment", "sub_segment", "product", "qa_status", "ref_valid")


@query(sql("SELECT match_tier, qa0 AS qa_status, ref_valid, count(*) AS n_rows FROM judged GROUP BY ALL", "judged"))
def r03_dispositions(spark, sf_dir):
    strict, generic, _ = master_views(spark, sf_dir)
    out = gate.disposition(mapped(spark, sf_dir), lexicon.build_reference_keys(strict, generic))
    return out.groupBy("match_tier", "qa_status", "ref_valid").agg(F.count("*").alias("n_rows"))


@query(sql("SELECT row_id, scope_flag, qa1 AS qa_status FROM demoted", "demoted"))
def r04_scope_exclusion(spark, sf_dir):
    strict, generic, _ = master_views(spark, sf_dir)
    out = gate.disposition(mapped(spark, sf_dir).withColumn("scope_flag", F.lit("")), lexicon.build_reference_keys(strict, generic))
    return gate.scope_exclusion(out, "description", fx.SCOPE_GROUPS, fx.WHITELIST).select("row_id", "scope_flag", "qa_status")


@query(sql("SELECT row_id, CASE WHEN match_tier IN ('family', 'category') AND month = '1' THEN CASE WHEN ref_valid = 'Y' THEN 'Mapped' ELSE 'Review - not in reference' END WHEN month = '1' THEN '' ELSE qa_status END AS qa_status FROM gated"))
def r05_blank_fallback(spark, sf_dir):
    rows = gated(spark, sf_dir).withColumn("qa_status", F.when(F.col("month") == "1", "").otherwise(F.col("qa_status")))
    return gate.blank_fallback(rows).select("row_id", "qa_status")


@query(sql("SELECT row_id, qa_status FROM gated WHERE qa_status = 'Review - generic anomaly'"))
def r06_generic_anomaly(spark, sf_dir):
    return gated(spark, sf_dir).filter(F.col("qa_status") == gate.REVIEW_ANOMALY).select("row_id", "qa_status")


@query(sql("SELECT row_id, qa_status, ref_valid, scope_flag, include FROM gated"))
def r07_gate(spark, sf_dir):
    return gated(spark, sf_dir).select("row_id", "qa_status", "ref_valid", "scope_flag", "include")


@query("SELECT unnest(['family_in_master', 'category_in_master', 'scope_leaks']) AS check_name, 0 AS violations WHERE EXISTS (SELECT 1 FROM lineitem)")
def r08_gate_invariant(spark, sf_dir):
    strict, generic, _ = master_views(spark, sf_dir)
    return gate.gate_violations(gated(spark, sf_dir), lexicon.build_reference_keys(strict, generic), "description", fx.SCOPE_GROUPS, fx.WHITELIST)


@query(sql(f"""SELECT action, count(*) AS n_rows, sum(value::DECIMAL(18,2))::DOUBLE AS value FROM (
  SELECT value, unnest(list_filter([CASE WHEN include <> 'Y' THEN 'demoted' END, CASE WHEN qa_status <> 'Mapped' THEN 'status_changed' END, CASE WHEN scope_flag <> '' THEN 'scope_hit' END], lambda x: x IS NOT NULL)) AS action FROM gated WHERE match_tier <> '') GROUP BY action"""))
def r09_compliance_actions(spark, sf_dir):
    before = mapped(spark, sf_dir).filter("match_tier <> ''").withColumns({"qa_status": F.lit("Mapped"), "include": F.lit("Y")})
    return gate.compliance_actions(before, gated(spark, sf_dir), "row_id", "value")


@query(sql(f"SELECT row_id, regexp_extract(lower(description), 'gear|bolt') AS hit FROM mapped WHERE match_status <> 'Matched' AND regexp_matches(lower(description), 'gear|bolt') AND NOT contains(lower(description), 'promo')", "mapped"))
def r10_candidate_screen(spark, sf_dir):
    return gate.candidate_screen(mapped(spark, sf_dir), "description", "gear|bolt", "promo", "value").select("row_id", "hit")


_EV, _RISK, _MEV = "regexp_matches(lower(description), 'ring|gear|bolt')", "contains(lower(description), 'small')", "exporter LIKE '%1'"


@query(sql(f"""SELECT row_id, CASE WHEN scope_flag <> '' THEN CASE WHEN {_EV} THEN 'Review' ELSE 'Excluded' END
  WHEN match_tier = 'family' THEN CASE WHEN ref_valid = 'Y' AND match_scope = 'core' AND NOT ({_RISK} AND NOT {_EV} AND NOT {_MEV}) THEN 'Trusted' ELSE 'Review' END
  WHEN match_tier = 'category' THEN CASE WHEN ref_valid = 'Y' AND {_EV} AND match_scope = 'core' THEN 'Trusted' ELSE 'Review' END
  WHEN match_tier = 'manufacturer' THEN CASE WHEN {_EV} THEN 'Review' ELSE 'Excluded' END
  ELSE CASE WHEN {_EV} AND NOT {_RISK} THEN 'Review' ELSE 'Excluded' END END AS route,
  concat_ws('; ', CASE WHEN scope_flag <> '' THEN 'scope:' || scope_flag END, CASE WHEN ref_valid <> 'Y' AND match_tier <> '' THEN 'not in reference' END, CASE WHEN {_RISK} THEN 'risk token' END,
    CASE WHEN NOT {_EV} AND match_tier IN ('family', 'category') THEN 'no product evidence' END, CASE WHEN NOT ({_MEV}) AND match_tier = 'family' THEN 'no maker evidence' END, CASE WHEN match_scope <> 'core' THEN 'extended scope' END) AS reasons FROM gated"""))
def r11_route_by_tree(spark, sf_dir):
    low = F.lower("description")
    out = gate.route_by_tree(gated(spark, sf_dir), low.rlike("ring|gear|bolt"), low.contains("small"), F.col("exporter").endswith("1"))
    return out.select("row_id", "route", "reasons")


# Aggregates.


@query(sql(_BOUNDS))
def d01_value_bounds(spark, sf_dir):
    return aggregate.value_bounds(gated(spark, sf_dir))


_TRUSTED = "SELECT * FROM gated WHERE match_tier IN ('family', 'category') AND match_scope = 'core' AND include = 'Y'"


@query(sql(f"SELECT row_id FROM ({_TRUSTED})"))
def d02_trusted(spark, sf_dir):
    return trusted(spark, sf_dir).select("row_id")


_LINES = "sum(value::DECIMAL(18,2))::DOUBLE AS revenue, sum(quantity::DECIMAL(18,2))::DOUBLE AS volume, min(unit_price) AS min_price, max(unit_price) AS max_price, count(*) AS shipments"


@query(sql(f"SELECT *, revenue / volume AS avg_price FROM (SELECT product, maker, family, {_LINES} FROM ({_TRUSTED}) GROUP BY ALL)"))
def d03_line_items(spark, sf_dir):
    return aggregate.line_items(trusted(spark, sf_dir), ["product", "maker", "family"])


@query(sql(f"SELECT product, maker, family, {_LINES}, (3 - (grouping(product) + grouping(maker) + grouping(family)))::INT AS level FROM ({_TRUSTED}) GROUP BY ROLLUP (product, maker, family)"))
def d04_roll_up(spark, sf_dir):
    return aggregate.roll_up(trusted(spark, sf_dir), ["product", "maker", "family"])


@query(sql("""SELECT coalesce(bucket, 'total') AS bucket, count(*) AS n_rows, sum(value::DECIMAL(18,2))::DOUBLE AS value FROM (
  SELECT value, CASE WHEN include = 'Y' THEN 'core trusted' WHEN qa_status = 'Review - extended scope' THEN 'extended pending' END AS bucket FROM gated) WHERE bucket IS NOT NULL GROUP BY ROLLUP (bucket)"""))
def d05_scope_table(spark, sf_dir):
    return aggregate.scope_table(gated(spark, sf_dir))


@query(sql("SELECT match_tier, segment, sub_segment, product, count(*) AS n_rows FROM gated GROUP BY ALL"))
def d06_match_summary(spark, sf_dir):
    return aggregate.match_summary(gated(spark, sf_dir))


@query(sql("SELECT qa_status, count(*) AS n_rows, sum(value::DECIMAL(18,2))::DOUBLE AS value FROM gated GROUP BY ALL"))
def d07_qa_by_status(spark, sf_dir):
    return aggregate.qa_by_status(gated(spark, sf_dir))


@query(sql("SELECT product, count(*) AS n_rows, sum(value::DECIMAL(18,2))::DOUBLE AS value FROM gated WHERE qa_status LIKE 'Review%' GROUP BY ALL ORDER BY value DESC, product LIMIT 25"))
def d07_qa_top_labels(spark, sf_dir):
    return aggregate.qa_top_labels(gated(spark, sf_dir), "product", F.col("qa_status").startswith("Review"), 25)


@query(sql("SELECT *, CASE WHEN quantity > 0 THEN value / quantity END AS unit_price FROM (SELECT country, segment, product, maker, family, count(*) AS n_rows, sum(quantity::DECIMAL(18,2))::DOUBLE AS quantity, sum(value::DECIMAL(18,2))::DOUBLE AS value FROM gated GROUP BY ALL)"))
def d08_dashboard(spark, sf_dir):
    return aggregate.dashboard(gated(spark, sf_dir), ["country", "segment", "product", "maker", "family"])


@query(sql(f"""SELECT *, round(upper_value - lower_value, 2) AS gap, CASE WHEN upper_value > 0 THEN lower_value / upper_value END AS coverage FROM (
  SELECT country, sum(lower_value::DECIMAL(20,2))::DOUBLE AS lower_value, sum(upper_value::DECIMAL(20,2))::DOUBLE AS upper_value, count(*) AS n_lines FROM ({_BOUNDS}) WHERE upper_value >= 1000 AND segment <> 'PROMO' GROUP BY country)"""))
def d09_country_comparison(spark, sf_dir):
    return aggregate.country_comparison(aggregate.value_bounds(gated(spark, sf_dir)), F.col("segment") != "PROMO", 1000.0)


@query(sql("SELECT CASE WHEN grouping(match_tier) = 1 THEN 'total' ELSE match_tier END AS match_tier, count(*) AS n_rows, sum(value::DECIMAL(18,2))::DOUBLE AS value FROM gated GROUP BY ROLLUP (match_tier)"))
def d10_tier_summary(spark, sf_dir):
    return aggregate.tier_summary(gated(spark, sf_dir), "match_tier")


@query(sql("SELECT t::DOUBLE AS threshold, count(*) AS n_rows, sum(value::DECIMAL(18,2))::DOUBLE AS value FROM gated, (VALUES (0), (10000), (25000), (50000), (100000)) v(t) WHERE qa_status LIKE 'Review%' AND value::DOUBLE >= t GROUP BY 1"))
def d10_review_burden(spark, sf_dir):
    return aggregate.review_burden(gated(spark, sf_dir), F.col("qa_status").startswith("Review"), (0, 10_000, 25_000, 50_000, 100_000))


@query(sql("""SELECT *, CASE WHEN trusted_rows > 0 THEN strict_rows / trusted_rows END AS precision_proxy, CASE WHEN trusted_rows + review_rows > 0 THEN trusted_rows / (trusted_rows + review_rows) END AS recall_proxy,
  CASE WHEN trusted_value + review_value > 0 THEN trusted_value / (trusted_value + review_value) END AS value_recall_proxy FROM (
  SELECT country, year, count(*) FILTER (include = 'Y') AS trusted_rows, count(*) FILTER (qa_status LIKE 'Review%') AS review_rows, count(*) AS n_rows,
    count(*) FILTER (include = 'Y' AND ref_valid = 'Y' AND match_tier = 'family') AS strict_rows, coalesce(sum(value::DECIMAL(18,2)) FILTER (include = 'Y'), 0)::DOUBLE AS trusted_value,
    coalesce(sum(value::DECIMAL(18,2)) FILTER (qa_status LIKE 'Review%'), 0)::DOUBLE AS review_value FROM gated GROUP BY country, year)"""))
def d11_compliance_metrics(spark, sf_dir):
    return aggregate.compliance_metrics(gated(spark, sf_dir))
