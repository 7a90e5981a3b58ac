"""Queries for priors and evaluation (K, V) over labelled documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from tradeweave.functions import text as X
from tradeweave.operators import evaluate, lexicon, priors
from tradeweave.sources import fixtures as fx

from .registry import query
from .scalar_queries import bucket_sql

_L = f"l AS (SELECT * FROM ({fx.LABELLED_SQL}))"
_TRAIN = f"{_L}, train AS (SELECT * FROM l WHERE {bucket_sql('doc_id::VARCHAR')} >= 300), test AS (SELECT * FROM l WHERE {bucket_sql('doc_id::VARCHAR')} < 300)"
_TOK = "tok AS (SELECT DISTINCT doc_id, code, left(code, 4) AS coarse, maker, label, unnest(regexp_extract_all(lower(text), '[a-z]{3,}')) AS token FROM train)"


def _labelled(spark, sf_dir):
    return fx.labelled_documents(spark, sf_dir)


def _test_keys(spark, sf_dir):
    return evaluate.split_keys(_labelled(spark, sf_dir), "doc_id").filter("is_test").select("doc_id")


def train(spark, sf_dir):
    """Whether a row is held out follows from its own key, so no text is shuffled for it."""
    return _labelled(spark, sf_dir).filter(~X.held_out("doc_id")).withColumn("coarse", F.substring("code", 1, 4))


def test(spark, sf_dir):
    return _labelled(spark, sf_dir).filter(X.held_out("doc_id")).withColumn("coarse", F.substring("code", 1, 4))


def _dominant_sql(keys: str, label: str, source: str, having: str = "") -> str:
    """The most frequent label of keys with n, total and share; of equals the first by name."""
    return f"""SELECT {keys}, {label}, n, total, n / total AS share FROM (SELECT {keys}, {label}, n, sum(n) OVER (PARTITION BY {keys})::BIGINT AS total,
      row_number() OVER (PARTITION BY {keys} ORDER BY n DESC, {label}) AS r FROM (SELECT {keys}, {label}, count(*) AS n FROM {source} GROUP BY ALL)) WHERE r = 1 {having}"""


@query(f"WITH {_L} SELECT d.doc_id, l.label FROM documents d LEFT JOIN l USING (doc_id)")
def k01_attach_labels(spark, sf_dir):
    truth = _labelled(spark, sf_dir).select("doc_id", "label", "parent")
    return priors.attach_labels(fx.table(spark, sf_dir, "documents").select("doc_id"), truth, "doc_id", ["label", "parent"]).select("doc_id", "label")


@query(f"WITH {_TRAIN} SELECT doc_id, label FROM train")
def k02_train_rows(spark, sf_dir):
    return priors.train_rows(_labelled(spark, sf_dir), _test_keys(spark, sf_dir), "doc_id").select("doc_id", "label")


@query(f"WITH {_L} " + _dominant_sql("code", "label", "l"))
def k03_dominant(spark, sf_dir):
    return lexicon.dominant(_labelled(spark, sf_dir), ["code"], "label")


@query(f"WITH {_L} SELECT label, parent FROM (" + _dominant_sql("label", "parent", "l") + ")")
def k04_parent_of(spark, sf_dir):
    return priors.parent_of(_labelled(spark, sf_dir))


@query(f"WITH {_TRAIN} " + _dominant_sql("code, maker", "label", "train", "AND n >= 3 AND n / total >= 0.5"))
def k05_code_maker_prior(spark, sf_dir):
    return priors.key_prior(train(spark, sf_dir), ["code", "maker"])


@query(f"WITH {_TRAIN} " + _dominant_sql("code", "label", "train", "AND n >= 3 AND n / total >= 0.55"))
def k06_code_prior(spark, sf_dir):
    return priors.key_prior(train(spark, sf_dir), ["code"], min_share=0.55)


@query(f"WITH {_TRAIN}, {_TOK} " + _dominant_sql("code, token", "label", "tok", "AND n >= 5 AND n / total >= 0.7"))
def k07_token_prior(spark, sf_dir):
    return priors.token_prior(train(spark, sf_dir), "text", "code")


_VOCAB = "vocab AS (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[a-z]{3,}')) AS token FROM benchmark)"
_SAFE = "safe AS (SELECT token FROM (" + _dominant_sql("token", "label", "voc", "AND n >= 5 AND n / total >= 0.7") + "))"
_TRANSFER_SQL = f"WITH {_TRAIN}, {_TOK}, {_VOCAB}, voc AS (SELECT * FROM tok JOIN vocab USING (token)), {_SAFE}, st AS (SELECT * FROM voc JOIN safe USING (token)) " + _dominant_sql("coarse, token", "label", "st", "AND n >= 5 AND n / total >= 0.7")


def _transfer(spark, sf_dir):
    vocabulary = lexicon.vocabulary(fx.table(spark, sf_dir, "benchmark"), ["text"])
    return priors.transfer_prior(train(spark, sf_dir), "text", "coarse", vocabulary, contained=False)


@query(_TRANSFER_SQL)
def k08_transfer_prior(spark, sf_dir):
    return _transfer(spark, sf_dir)


_PART_TOK = """tok AS (SELECT coarse, label, unnest(list_distinct(regexp_extract_all(lower(t), '[a-z]{3,}'))) AS token
  FROM (SELECT p_size % 6 AS coarse, split_part(p_name, ' ', 2) AS label, p_name || ' ' || p_type AS t FROM part)), vocab AS (SELECT DISTINCT unnest(regexp_extract_all(lower(p_name), '[a-z]{3,}')) AS token FROM part)"""


@query(f"WITH {_PART_TOK}, voc AS (SELECT * FROM tok JOIN vocab USING (token)), {_SAFE}, st AS (SELECT * FROM voc JOIN safe USING (token)) SELECT * FROM ("
       + _dominant_sql("coarse, token", "label", "st", "AND n >= 5 AND n / total >= 0.7") + ") WHERE list_contains(regexp_extract_all(lower(label), '[a-z]{3,}'), token)")
def k08_transfer_prior_contained(spark, sf_dir):
    part = fx.table(spark, sf_dir, "part")
    rows = part.select((F.col("p_size") % 6).alias("coarse"), F.split("p_name", " ")[1].alias("label"), F.concat_ws(" ", "p_name", "p_type").alias("text"))
    return priors.transfer_prior(rows, "text", "coarse", lexicon.vocabulary(part, ["p_name"]))


@query(f"WITH {_TRAIN}, {_TOK} " + _dominant_sql("code, token", "maker", "tok", "AND n >= 5 AND n / total >= 0.7"))
def k09_token_maker_prior(spark, sf_dir):
    return priors.token_prior(train(spark, sf_dir), "text", "code", "maker")


_SING = "CASE WHEN length(token) > 3 AND token LIKE '%s' THEN left(token, length(token) - 1) ELSE token END"


@query(f"""WITH {_TRAIN}, {_TOK}, sg AS (SELECT DISTINCT doc_id, label, {_SING} AS token FROM tok), good AS ({_dominant_sql("token", "label", "sg", "AND n >= 3 AND n / total >= 0.5")})
  SELECT l.label, coalesce(n_words, 0) AS n_words FROM (SELECT DISTINCT label FROM train) l LEFT JOIN (SELECT label, count(*)::INT AS n_words FROM good GROUP BY label) g USING (label)""")
def k10_corroboration_vocabulary(spark, sf_dir):
    out = priors.corroboration_vocabulary(train(spark, sf_dir), "text")
    return out.select("label", F.size("words").alias("n_words"))


_F = """feat AS (SELECT doc_id, code, maker, unnest(list_concat(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || '_' || w[i + 1])),
  list_transform(list_concat(list_filter(regexp_extract_all(t, '[a-z0-9]{3,}'), lambda x: regexp_matches(x, '[a-z]') AND regexp_matches(x, '[0-9]')), regexp_extract_all(t, '[0-9]{5,}')), lambda x: 'C_' || x))) AS feature
  FROM (SELECT doc_id, code, maker, lower(text) AS t, regexp_extract_all(lower(text), '[a-z]{3,}') AS w FROM %s))"""
_POST = "post AS (SELECT *, count(*) OVER (PARTITION BY code, feature) AS df FROM (SELECT code, maker AS family, feature, count(*) AS cnt FROM feat GROUP BY ALL))"
_FAM = "fam AS (SELECT *, count(*) OVER (PARTITION BY code) AS nf FROM (SELECT code, maker AS family, count(*) AS rows FROM train GROUP BY ALL) QUALIFY sum(rows) OVER (PARTITION BY code) >= 3)"


@query(f"WITH {_TRAIN}, {_F % 'train'}, {_POST}, {_FAM} SELECT code, family, count(*) AS n_features, sum(cnt)::BIGINT AS n, sum(df)::BIGINT AS df FROM post JOIN fam USING (code, family) GROUP BY ALL")
def k11_family_postings(spark, sf_dir):
    rows = train(spark, sf_dir).withColumn("family", F.col("maker"))
    postings, _ = priors.family_postings(rows, "text", "code", "family")
    return postings.groupBy("code", "family").agg(F.count("*").alias("n_features"), F.sum("cnt").alias("n"), F.sum("df").alias("df"))


_K12_SQL = f"""WITH {_TRAIN}, {_F % 'train'}, {_POST}, {_FAM}, tf AS (SELECT doc_id, code, feature, count(*) AS times FROM ({(_F % 'test').split(' AS ', 1)[1][1:-1]}) GROUP BY ALL),
  s AS (SELECT doc_id, family, rows, sum(round(CASE WHEN feature LIKE 'C\\_%' ESCAPE '\\' THEN 4.0 WHEN contains(feature, '_') THEN 2.0 ELSE 1.0 END::DOUBLE * (ln((nf + 1) / (df + 1)) + 0.1::DOUBLE) * ln(1.0::DOUBLE + cnt) * times * 1e9)::HUGEINT) AS s
    FROM tf JOIN post USING (code, feature) JOIN fam USING (code, family) GROUP BY ALL),
  b AS (SELECT doc_id, family FROM (SELECT doc_id, family, row_number() OVER (PARTITION BY doc_id ORDER BY round(s::DOUBLE / 1e9 + 0.01::DOUBLE * ln(1.0::DOUBLE + rows), 6) DESC, family) AS r FROM s) WHERE r = 1),
  common AS (SELECT code, family FROM fam QUALIFY row_number() OVER (PARTITION BY code ORDER BY rows DESC, family) = 1)
  SELECT doc_id, family FROM b UNION ALL SELECT doc_id, family FROM test JOIN common USING (code) WHERE doc_id NOT IN (SELECT doc_id FROM b)"""


@query(_K12_SQL)
def k12_score_families(spark, sf_dir):
    rows = train(spark, sf_dir).withColumn("family", F.col("maker"))
    postings, families = priors.family_postings(rows, "text", "code", "family")
    return priors.score_families(test(spark, sf_dir), "doc_id", "text", "code", postings, families, "family").select("doc_id", "family")


_BEST = """SELECT doc_id, {label} FROM (SELECT t.doc_id, p.{label}, row_number() OVER (PARTITION BY t.doc_id ORDER BY share DESC, n DESC, token, p.{label}) AS r
  FROM tt t JOIN ({prior}) p USING ({key}, token)) WHERE r = 1"""
_TT = "tt AS (SELECT DISTINCT doc_id, code, left(code, 4) AS coarse, unnest(regexp_extract_all(lower(text), '[a-z]{3,}')) AS token FROM test)"
_TOKEN_PRIOR = _dominant_sql("code, token", "label", "tok", "AND n >= 5 AND n / total >= 0.7")
_PRODUCT_SQL = f"""WITH {_TRAIN}, {_TOK}, {_TT}, one AS ({_BEST.format(label="label", prior=_TOKEN_PRIOR, key="code")}),
  four AS (SELECT doc_id, p.label FROM test JOIN ({_dominant_sql("code, maker", "label", "train", "AND n >= 3 AND n / total >= 0.5")}) p USING (code, maker)),
  five AS (SELECT doc_id, p.label FROM test JOIN ({_dominant_sql("code", "label", "train", "AND n >= 3 AND n / total >= 0.55")}) p USING (code))
  SELECT t.doc_id, coalesce(o.label, f.label, v.label) AS predicted, CASE WHEN o.label IS NOT NULL THEN 'token' WHEN f.label IS NOT NULL THEN 'maker' WHEN v.label IS NOT NULL THEN 'code' END AS via
  FROM test t LEFT JOIN one o USING (doc_id) LEFT JOIN four f USING (doc_id) LEFT JOIN five v USING (doc_id)"""


def _applied(spark, sf_dir, cross_market=False, vocabulary=None):
    t = train(spark, sf_dir)
    p = {"token": priors.token_prior(t, "text", "code"), "maker": priors.key_prior(t, ["code", "maker"]), "code": priors.key_prior(t, ["code"], min_share=0.55)}
    rows = test(spark, sf_dir).drop("label", "parent").withColumns({"match_tier": F.lit(""), "product": F.lit("")})
    if cross_market:
        p = {"token": p["token"].limit(0), "transfer": _transfer(spark, sf_dir)}
    return priors.apply_product_prior(rows, "doc_id", "text", "code", "coarse", "maker", p, vocabulary, cross_market=cross_market)


@query(_PRODUCT_SQL)
def k13_apply_product_prior(spark, sf_dir):
    return _applied(spark, sf_dir).select("doc_id", "predicted", "via")


@query(f"""WITH {_TRAIN}, {_TOK}, {_TT}, one AS ({_BEST.format(label="maker", prior=_dominant_sql("code, token", "maker", "tok", "AND n >= 5 AND n / total >= 0.7"), key="code")})
  SELECT t.doc_id, coalesce(o.maker, '') AS maker FROM test t LEFT JOIN one o USING (doc_id)""")
def k14_fill_maker(spark, sf_dir):
    rows = test(spark, sf_dir).withColumn("maker", F.lit(""))
    return priors.fill_maker(rows, "doc_id", "text", "code", "coarse", "maker", priors.token_prior(train(spark, sf_dir), "text", "code", "maker")).select("doc_id", "maker")


@query(f"""WITH {_TRAIN} SELECT doc_id, CASE WHEN maker = 'en' THEN 'Unspecified' WHEN maker = 'de' THEN 'own' ELSE coalesce(k.family, 'Unspecified') END AS family FROM test LEFT JOIN ({_K12_SQL}) k USING (doc_id)""")
def k15_fill_family(spark, sf_dir):
    rows = train(spark, sf_dir).withColumn("family", F.col("maker"))
    postings, families = priors.family_postings(rows, "text", "code", "family")
    tier = F.when(F.col("maker") == "en", "family").otherwise("")  # tier 1's own blanks stay
    blank = test(spark, sf_dir).withColumns({"match_tier": tier, "family": F.when(F.col("maker") == "de", "own").otherwise("Unspecified")})
    return priors.fill_family(blank, "doc_id", "text", "code", postings, families, "family").select("doc_id", "family")


@query(f"""WITH {_TRAIN}, {_TOK}, {_VOCAB}, voc AS (SELECT * FROM tok JOIN vocab USING (token)), {_SAFE}, st AS (SELECT * FROM voc JOIN safe USING (token)), {_TT},
  one AS ({_BEST.format(label="label", prior=_dominant_sql("coarse, token", "label", "st", "AND n >= 5 AND n / total >= 0.7"), key="coarse")})
  SELECT t.doc_id, o.label AS predicted FROM test t LEFT JOIN one o USING (doc_id)""")
def k16_cross_market(spark, sf_dir):
    return _applied(spark, sf_dir, cross_market=True).select("doc_id", "predicted")


@query(f"""WITH {_TRAIN}, {_TOK}, {_VOCAB}, voc AS (SELECT * FROM tok JOIN vocab USING (token)), {_SAFE}, st AS (SELECT * FROM voc JOIN safe USING (token)), {_TT},
  one AS ({_BEST.format(label="label", prior=_dominant_sql("coarse, token", "label", "st", "AND n >= 5 AND n / total >= 0.7"), key="coarse")})
  SELECT o.label, count(*) AS n_rows, sum(value)::DOUBLE AS value FROM one o JOIN test USING (doc_id) GROUP BY o.label""")
def k17_transfer_impact(spark, sf_dir):
    rows = test(spark, sf_dir).drop("label").withColumn("product", F.lit(""))
    return priors.transfer_impact(rows, "doc_id", "text", "coarse", _transfer(spark, sf_dir), "value")


@query(f"""WITH {_TRAIN}, p AS ({_dominant_sql("code", "label", "train", "AND n >= 3")}) SELECT th::DOUBLE AS threshold, count(*) AS n_fired, count(*) FILTER (p.label = t.label) AS n_right
  FROM test t JOIN p USING (code), (VALUES (0.5), (0.7), (0.9)) v(th) WHERE share >= th GROUP BY 1""")
def k18_ceiling(spark, sf_dir):
    return priors.ceiling(train(spark, sf_dir), test(spark, sf_dir), ["code"], (0.5, 0.7, 0.9))


# Evaluation.

_P = "CASE p_size % 4 WHEN 0 THEN '' WHEN 1 THEN p_name WHEN 2 THEN split_part(p_name, ' ', 2) || ' ' || p_type WHEN 3 THEN left(split_part(p_name, ' ', 2), 4) || 'x' ELSE 'thing' END"
_A = "CASE WHEN p_size % 5 = 0 THEN '' ELSE p_name END"
_PAIR = f"SELECT p_partkey, p_size, {_P} AS predicted, {_A} AS actual, p_retailprice AS value FROM part"
_NORM = "trim(regexp_replace(lower({}), '[^a-z0-9]+', ' ', 'g'))"
_WORDS = f"list_filter(string_split({_NORM}, ' '), lambda w: length(w) > 2)"
_PREFIXES = f"list_transform(list_filter({_WORDS}, lambda w: length(w) >= 4), lambda w: left(w, 4))"
_OVERLAP = f"(list_has_any({_WORDS.format('predicted')}, {_WORDS.format('actual')}) OR list_has_any({_PREFIXES.format('predicted')}, {_PREFIXES.format('actual')}))"
_AGREE = f"""({_NORM.format('predicted')} <> '' AND {_NORM.format('actual')} <> '' AND (contains({_NORM.format('predicted')}, {_NORM.format('actual')})
  OR contains({_NORM.format('actual')}, {_NORM.format('predicted')}) OR {_OVERLAP}))"""


def _pairs(spark, sf_dir):
    return fx.table(spark, sf_dir, "part").selectExpr("p_partkey", "p_size", f"{_P} AS predicted", f"{_A} AS actual", "p_retailprice AS value")


@query(f"SELECT p_partkey, {_OVERLAP} AS same FROM ({_PAIR})")
def v01_overlap(spark, sf_dir):
    return _pairs(spark, sf_dir).select("p_partkey", evaluate.overlap("predicted", "actual").alias("same"))


@query(f"SELECT p_partkey, {_AGREE} AS same FROM ({_PAIR})")
def v02_agrees(spark, sf_dir):
    return _pairs(spark, sf_dir).select("p_partkey", evaluate.agrees("predicted", "actual").alias("same"))


def _overall_sql(by: str = "") -> str:
    select = f"{by}, " if by else ""
    return f"""SELECT *, CASE WHEN n > 0 THEN "right" / n END AS recall, CASE WHEN fired > 0 THEN "right" / fired END AS precision FROM (SELECT {select}count(*) FILTER (actual <> '') AS n,
      count(*) FILTER (actual <> '' AND predicted <> '') AS fired, count(*) FILTER (actual <> '' AND predicted <> '' AND {_AGREE}) AS "right",
      count(*) FILTER (actual <> '' AND predicted <> '' AND NOT {_AGREE}) AS wrong, count(*) FILTER (actual <> '' AND predicted = '') AS missed FROM ({_PAIR}) {'GROUP BY ' + by if by else ''})"""


@query(_overall_sql())
def v03_overall(spark, sf_dir):
    return evaluate.overall(_pairs(spark, sf_dir), "predicted", "actual")


@query(_overall_sql("p_size"))
def v04_by_dimension(spark, sf_dir):
    return evaluate.overall(_pairs(spark, sf_dir), "predicted", "actual", ["p_size"])


@query(f"SELECT predicted, actual, count(*) AS n_rows FROM ({_PAIR}) WHERE actual <> '' AND predicted <> '' AND NOT {_AGREE} GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2 LIMIT 20")
def v05_worst_buckets(spark, sf_dir):
    return evaluate.worst_buckets(_pairs(spark, sf_dir), "predicted", "actual", 20)


@query(f"SELECT p_size % 4 AS tier, predicted, actual, count(*) AS n_rows FROM ({_PAIR}) WHERE actual <> '' AND predicted <> '' AND NOT {_AGREE} GROUP BY ALL ORDER BY 4 DESC, 2, 3, 1 LIMIT 20")
def v06_wrong_anatomy(spark, sf_dir):
    pairs = _pairs(spark, sf_dir).withColumn("tier", F.col("p_size") % 4)
    return evaluate.worst_buckets(pairs, "predicted", "actual", 20, by=("tier",))


@query(f"""SELECT *, CASE WHEN precision >= 0.8 THEN 'keep' WHEN precision >= 0.5 THEN 'watch' ELSE 'drop' END AS verdict FROM (
  SELECT actual, count(*) AS n_rows, avg({_AGREE}::INT) AS precision, sum(value::DECIMAL(18,2))::DOUBLE AS value FROM ({_PAIR}) GROUP BY 1) WHERE n_rows >= 5""")
def v07_keyword_precision(spark, sf_dir):
    return evaluate.keyword_precision(_pairs(spark, sf_dir), "actual", evaluate.agrees("predicted", "actual"), 5)


@query(f"SELECT doc_id, {bucket_sql('doc_id::VARCHAR')} < 300 AS is_test FROM documents")
def v08_split_keys(spark, sf_dir):
    return evaluate.split_keys(fx.table(spark, sf_dir, "documents"), "doc_id")


@query("SELECT doc_id FROM documents ORDER BY md5(doc_id || ':7'), doc_id LIMIT 100")
def v09_seeded_sample(spark, sf_dir):
    return evaluate.seeded_sample(fx.table(spark, sf_dir, "documents").select("doc_id"), "doc_id", 100, 7)
