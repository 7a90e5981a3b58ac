"""Work and written data grow no faster than the input."""

import difflib
import random
import time

from tradeweave.operators import match, retrieval


def _seconds(f):
    began = time.time()
    return f(), time.time() - began


def test_keywords_of_a_long_text_take_linear_time(spark):
    """the text was cut into words anew for each of its words."""
    rows = spark.createDataFrame([(1, "wort " * 60_000 + "mesh"), (2, "a mesh")], "id int, text string")
    found, s = _seconds(lambda: {(r.id, r.keyword, r.pos) for r in match.match_keywords(rows, "id", "text", spark.createDataFrame([("mesh",)], "keyword string")).collect()})
    assert found == {(1, "mesh", 60_000), (2, "mesh", 1)} and s < 40


def test_phrases_of_a_long_text_take_linear_time(spark):
    """each place at which a phrase could go on carried the whole text."""
    rows = spark.createDataFrame([(1, "red " * 30_000 + "red bolt xl"), (2, "red bolt"), (3, "red, bolt"), (4, "redbolt")], "id int, text string")
    phrases = spark.createDataFrame([("red bolt",), ("red bolt xl",), ("red gear",)], "phrase string")
    found, s = _seconds(lambda: {(r.id, r.phrase) for r in match.match_phrases(rows, "id", "text", phrases).collect()})
    assert found == {(1, "red bolt xl"), (2, "red bolt"), (3, "red bolt")} and s < 40


def test_texts_are_normalised_and_taken_apart_once(spark):
    """normal forms were made six times a text, and places exploded for each length, whether or not an entry has it."""
    rows = spark.createDataFrame([(1, "Red Bolts"), (2, None), (3, "a red bolt"), (4, "red")], "id int, text string")
    out = match.match_phrases(rows, "id", "text", spark.createDataFrame([("red bolt",), ("a bolt",)], "phrase string"))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Generate posexplode") == 1 and "isnotnull(unhex" not in plan
    assert {(r.id, r.phrase) for r in out.collect()} == {(1, "red bolt"), (3, "red bolt")}
    mixed = spark.createDataFrame([("red",), ("red bolt",), ("q red bolt x",)], "phrase string")
    assert {(r.id, r.phrase) for r in match.match_phrases(rows, "id", "text", mixed, how="left").collect()} == {(1, "red bolt"), (2, None), (3, "red bolt"), (4, "red")}
    assert match.match_phrases(rows, "id", "text", mixed.filter("false")).count() == 0


def test_phrases_beside_letters_beyond_ascii(spark, tmp_path):
    """in the SQL a word ends before such a letter, so its final s goes."""
    from tradeweave.plans import mapping_queries as q

    docs = [(1, "a thats\u00f3 x", "en"), (2, "thats x", "en"), (3, "that\u00f3 x", "en"), (4, "that x", "de")]
    spark.createDataFrame(docs, "doc_id long, text string, lang string").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([("That x is",)], "text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert {(r.doc_id, r.phrase) for r in q.m02_match_phrases(spark, str(tmp_path)).collect()} == {(1, "that x"), (2, "that x"), (3, "that x")}


def test_pairs_of_long_texts_take_linear_time(spark):
    """Words and n-grams of a text were compared anew for each of its candidates, and its text was copied for each."""
    rng = random.Random(6)
    words = ["".join(rng.choices("abcdefghijklmnop", k=rng.randrange(3, 8))) for _ in range(3_000)]
    some = lambda n: " ".join(rng.choices(words, k=n))
    rows = spark.createDataFrame([(k, some(40_000), k % 2 == 0, False) for k in range(8)], "doc_id long, text string, evidence boolean, generic boolean")
    objects = spark.createDataFrame([(f"o{k}", some(40), words[k], some(2), some(3), "canonical_tuple") for k in range(120)], "object_id string, retrieval_text string, maker string, family string, alias string, object_type string")
    short = rows.select("doc_id").crossJoin(objects.select("object_id"))
    found, s = _seconds(lambda: {(r.doc_id, r.object_id) for r in retrieval.compare(short, rows, objects, "doc_id").collect()})
    assert len(found) == 960 and s < 25
    few = [d.filter(c) for d, c in ((rows, "doc_id < 2"), (objects, "object_id < 'o11'"))]
    pairs = few[0].crossJoin(few[1])
    want = {(r.doc_id, r.object_id): r.score for r in retrieval.score_candidates(pairs).select("doc_id", "object_id", "score").collect()}
    parts = retrieval.compare(pairs.select("doc_id", "object_id"), *few, "doc_id")
    apart = retrieval.weigh(parts.join(rows.drop("text"), "doc_id").join(objects.select("object_id", "object_type"), "object_id"))
    assert {(r.doc_id, r.object_id): r.score for r in apart.collect()} == want and want


def test_ratios_are_those_of_difflib():
    """Ratios of a text with many others, made faster."""
    rng = random.Random(7)
    for n in range(3_000):
        letters = ("ab", "abcd ", "abcdefghijkl ")[n % 3]
        a, b = ("".join(rng.choices(letters, k=rng.randrange(k))) for k in (60, 40))
        if n % 10 == 0:  # from 200 characters on, difflib begins no match at a frequent one
            b = "".join(rng.choices(letters + "qwxyz", weights=[5] * len(letters) + [1] * 5, k=rng.randrange(195, 260))) + a[5:20]
        length, begun = rng.randrange(60), retrieval.Prefix(a, 50)
        for other in (b, b[:8], a[3:]):
            assert begun.ratio(other, length) == difflib.SequenceMatcher(None, a[:50][:length], other).ratio()


def test_keys_of_compared_rows_stay_exact(spark):
    """Blocks hold rows and objects side by side; long keys must not become doubles, and rows without text have scores too."""
    rows = spark.createDataFrame([(2**62 + 1, "red bolt"), (2**62 + 2, None), (None, "red")], "k long, text string")
    objects = spark.createDataFrame([(2**61 + 1, "red bolt"), (2**61 + 2, "")], "object_id long, retrieval_text string")
    out = {(r.k, r.object_id): (r.lexical, r.fuzzy) for r in retrieval.compare(rows.select("k").filter("k is not null").crossJoin(objects.select("object_id")), rows, objects, "k").collect()}
    a, b, x, y = 2**62 + 1, 2**62 + 2, 2**61 + 1, 2**61 + 2
    assert out == {(a, x): (1.0, 0.75), (a, y): (0.0, 0.0), (b, x): (0.0, 0.0), (b, y): (0.0, 0.75)}


def test_fuzzy_names_fit_whole_words(spark):
    """F8: letters within codes and the beginnings of longer words were taken for words."""
    rows = spark.createDataFrame([(1, "widgex7 9plates"), (2, "widgex, x"), (3, "abcdefghijklmnopqrx widget"), (4, "k9widgex")], "id int, text string")
    names = spark.createDataFrame([("widget",), ("abcdefghijklmnopqs",), ("plates",)], "name string")
    assert [(r.id, r.token, r["name"], r.distance) for r in match.fuzzy_match(rows, "id", "text", names).collect()] == [(2, "widgex", "widget", 1)]


def test_parties_by_value_as_by_pair(spark):
    """Every distinct pair of parties was matched; now values are, and pairs only where a core may go on in the next column."""
    rows = spark.createDataFrame(
        [(1, "North", "Star Ltd"), (2, "north star", "Acme"), (3, None, "acme"), (4, "x", None), (5, "big north", ""), (6, "", "star ltd"), (7, "a north", "wind"), (8, "acme", "polar bear inc")], "id int, a string, b string",
    )
    cores = spark.createDataFrame([("north star", "N"), ("acme", "A"), ("star ltd", "S"), ("north", "O"), ("polar bear", "P"), ("big north x", "B")], "core string, canonical string")
    want = {r.id: r.maker for r in match.match_party(rows, "id", ("a", "b"), cores).collect()}
    found = match.with_maker(rows, ("a", "b"), match.party_values(rows, ("a", "b"), cores), "maker")
    assert {r.id: r.maker for r in found.collect()} == {k: want.get(k) for k in range(1, 9)}
    assert want[1] == "N" and want[8] == "P"


def test_rows_look_labels_up_without_a_shuffle(spark):
    """Rows were shuffled once for their texts, once for their parties and once for the gate's verdicts."""
    from tradeweave.plans import mapping_queries as q

    rows = q.gated(spark, "/root/testdata/sf0.001")
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "SortMergeJoin" not in plan


def test_features_of_texts_are_made_once_and_texts_stay(spark):
    """texts were shuffled for labels and for the split, features from step to step, and all of it was done twice."""
    from tradeweave.operators import priors
    from tradeweave.plans import learning_queries as q

    for f in (q.train, q.test):
        assert "Exchange hashpartitioning" not in f(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    train = spark.createDataFrame([(1, "red bolt", "c", "x"), (2, "red gear", "c", "x"), (3, "blue gear 12345", "c", "y"), (4, "red", "d", "x"), (5, "red", None, "y"), (6, "red", "c", "")], "id int, text string, code string, family string")
    postings, families = priors.family_postings(train, "text", "code", "family")
    assert {(r.code, r.feature, r.family, r.cnt, r.df) for r in postings.collect()} == {
        ("c", "red", "x", 2, 1), ("c", "bolt", "x", 1, 1), ("c", "red_bolt", "x", 1, 1), ("c", "gear", "x", 1, 2), ("c", "red_gear", "x", 1, 1), ("c", "blue", "y", 1, 1),
        ("c", "gear", "y", 1, 2), ("c", "blue_gear", "y", 1, 1), ("c", "C_12345", "y", 1, 1)}
    out = priors.score_families(train.drop("family"), "id", "text", "code", postings, families, "family")
    assert "Generate explode" not in out._jdf.queryExecution().executedPlan().toString()
    got = {r.id: (r.family, r.score > 0) for r in out.collect()}
    assert got == {1: ("x", True), 2: ("x", True), 3: ("y", True), 6: ("x", True)}
    none = priors.score_families(spark.createDataFrame([(7, "zzz", "c")], "id int, text string, code string"), "id", "text", "code", postings, families, "family")
    assert [tuple(r) for r in none.collect()] == [(7, "x", 0.0)]


def test_only_rows_that_can_be_among_the_first_are_ranked(spark):
    """every row was taken apart by method and sorted by value."""
    from pyspark.sql import functions as F

    from tradeweave.operators import review

    rng = random.Random(8)
    rows = [(k, rng.choice(["-5", "0", "7.5", "abc", None, str(rng.randrange(1, 100_000)), "99999"]), rng.randrange(6), rng.choice("xyz")) for k in range(600)]
    df = spark.createDataFrame(rows, "k int, value string, n int, l string")
    methods = {"a": (F.col("n") > 1, F.col("l")), "b": (F.col("n") % 2 == 0, F.lit("x")), "c": ((F.col("n") == 5) & (F.col("k") < 100), F.col("value")), "d": (F.col("k") < 0, F.col("l"))}
    number = lambda v: float(v) if v not in ("abc", None) else 0.0

    def want(names, per, cap):
        fits = {"a": lambda r: r[2] > 1, "b": lambda r: r[2] % 2 == 0, "c": lambda r: r[2] == 5 and r[0] < 100, "d": lambda r: False}
        label = {"a": lambda r: r[3], "b": lambda r: "x", "c": lambda r: r[1]}
        some = {}
        for rank, n in enumerate(names):
            for r in sorted(filter(fits[n], rows), key=lambda r: (-number(r[1]), r[0]))[:per]:
                some.setdefault(r[0], {}).setdefault(label[n](r), (rank, n, number(r[1])))
        out = [(-v, k, rank, n, l) for k, ls in some.items() for l, (rank, n, v) in sorted(ls.items(), key=lambda x: x[1][0])[:2]]
        return [(k, n, l, -v) for v, k, _, n, l in sorted(out, key=lambda x: x[:3])[:cap]]

    for names, per in (("ab", 20), ("ab", 1), ("abcd", 40), ("ab", 500)):
        out = review.top_candidates(df, "k", {n: methods[n] for n in names}, per, 2, 50)
        assert [tuple(r) for r in out.collect()] == want(names, per, 50)
    plan = review.top_candidates(df, "k", {n: methods[n] for n in "ab"}, 20, 2, 50)._jdf.queryExecution().executedPlan().toString()
    assert "LOG1P" in plan.upper().split("GENERATE")[-1]  # below the step that takes rows apart
