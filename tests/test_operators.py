"""Boundary cases on small hand-made tables."""

import difflib
import hashlib
import math
import os
import random
import re

import pytest
from pyspark.sql import functions as F

from tradeweave.functions import text as X
from tradeweave.operators import evidence, gate, lexicon, match, retrieval, validate
from tradeweave.sources import tables


def one(spark, expression, *values):
    names = [f"c{k}" for k in range(len(values))]
    df = spark.createDataFrame([tuple(values)], ", ".join(f"{n} string" for n in names))
    return df.select(expression(*map(F.col, names)).alias("x")).first().x


@pytest.mark.parametrize(
    "f, given, want",
    [
        (X.norm_exact, "  A \t b\n", "a b"), (X.norm_exact, None, ""), (X.norm_loose, "Foo™_bar – Baz/qux\\z", "foo bar baz qux z"),
        (X.norm_phrase, "Screws_and Plates/2", "screw and plate 2"), (X.norm_text, "R&D, Ltd.", "r and d ltd"), (X.normalize_text, "Éclair & Co./x", "eclair and co./x"), (X.normalize_text, "a\u20d0b \u0301c", "ab c"), (X.normalize_text, None, ""),
        (X.canon_sep, "a | b - c_d e-f", "a_b_c_d e-f"), (X.hs8, " 12.0 ", "12"), (X.hs8, "abc", "<NA>"), (X.hs8, "NaN", "<NA>"), (X.safe_number, "inf", 0.0), (X.safe_number, "1e3", 1000.0),
    ],
)
def test_normal_forms(spark, f, given, want):
    assert one(spark, f, given) == want


@pytest.mark.parametrize("raw, want", [("1,200", (1200.0, "valid")), (" 12 ", (12.0, "valid")), ("", (None, "missing")), (None, (None, "missing")), ("inf", (None, "invalid")), ("abc", (None, "invalid"))])
def test_number_status(spark, raw, want):
    assert tuple(one(spark, X.number_status, raw)) == want


def test_row_key_rounds_half_to_even(spark):
    assert one(spark, lambda d, c, v: X.row_key(d, c, v), "A-b", "7", "2.5") == "a b|7|2"
    assert one(spark, lambda d, c, v: X.row_key(d, c, v), "A-b", "7", "3.5") == "a b|7|4"


@pytest.mark.parametrize("key", ["1", "abc", ""])
def test_hash_bucket(spark, key):
    assert one(spark, X.hash_bucket, key) == int(hashlib.md5(key.encode()).hexdigest(), 16) % 1000


def keyword_table(spark, words):
    return spark.createDataFrame([(w,) for w in words], "keyword string")


@pytest.mark.parametrize(
    "text, want",
    [
        ("a root canal", "root"), ("roots grow", None), ("uproot", None), ("mesh plus", "mesh plus"), ("mesh", "mesh"), ("mesh plussed", "mesh"),
        ("x, mesh-root", "mesh"), ("", None), (None, None), ("éroot", None), ("ROOT", "root"), ("longer keyword after root", "root"),
    ],
)
def test_leftmost_longest_keyword(spark, text, want):
    rows = spark.createDataFrame([(1, text)], "id int, t string")
    found = match.match_keywords(rows, "id", "t", keyword_table(spark, ["root", "mesh", "mesh plus", "longer keyword afterwards"])).first()
    assert (found.keyword if found else None) == want


@pytest.mark.parametrize("seed", range(3))
def test_occurrences_over_a_trie_match_brute_force(spark, seed):
    rng = random.Random(seed)
    words, gaps = ["a", "b", "ab", "é1", "7", "x"], [" ", "-", "  ", "+", ". ", ""]
    text = lambda n: "".join(rng.choice(words) + rng.choice(gaps) for _ in range(n))
    texts = [(k, rng.choice(["", "-", " "]) + text(rng.randrange(0, 14))) for k in range(80)]
    entries = sorted({e for e in (text(rng.randrange(1, 5)) for _ in range(120)) if e and e[0].isalnum()})
    want = set()
    for k, t in texts:
        starts = [m.start() for m in re.finditer(r"[^\W_]+", t)]
        for pos, at in enumerate(starts):
            for e in entries:
                end = at + len(e)
                if t.startswith(e, at) and not (end < len(t) and t[end].isalnum()):
                    want.add((k, pos, e))
    out = match.occurrences(spark.createDataFrame(texts, "id long, t string"), spark.createDataFrame([(e,) for e in entries], "e string"), "e")
    got = [tuple(r) for r in out.collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_many_entries_with_one_first_word_multiply_nothing(spark):
    """30,000 entries begin with a word that stands 4,000 times: all pairs would be 120 million."""
    entries = spark.range(30_000).select(F.concat(F.lit("common part "), F.col("id").cast("string")).alias("e"))
    texts = spark.range(200).select("id", F.concat_ws(" ", *[F.concat(F.lit("common part "), (F.col("id") * 20 + k).cast("string")) for k in range(20)]).alias("t"))
    assert match.occurrences(texts, entries, "e").count() == 4000


def test_party_exclusion_and_longest_core(spark):
    rows = spark.createDataFrame([(1, "Acme Medical Ltd"), (2, "ACME vet"), (3, None)], "id int, p string")
    cores = spark.createDataFrame([("acme", 1, 4, "A"), ("acme medical", 2, 12, "AM")], "core string, n_tokens int, len int, canonical string")
    assert {r.id: r.maker for r in match.match_party(rows, "id", ["p"], cores, ("vet",)).collect()} == {1: "AM"}


def test_dominant_breaks_ties_by_name(spark):
    rows = spark.createDataFrame([("k", "b"), ("k", "a"), ("k", ""), ("l", None)], "k string, v string")
    assert [tuple(r) for r in lexicon.dominant(rows, ["k"], "v").collect()] == [("k", "a", 1, 2, 0.5)]


def test_gate_branches(spark):
    dims = "segment string, sub_segment string, product string, player string, family string"
    strict = spark.createDataFrame([("S", "T", "P", "M", "Fam")], dims)
    generic = spark.createDataFrame([("S", "T", "P", "M", "Gen")], dims)
    keys = lexicon.build_reference_keys(strict, generic)
    given = [("S", "T", "P", "M", "Fam"), ("S", "T", "P", "M", "fam™ "), ("S", "T", "P", "M", "gen"), ("X", "T", "P", "M", "Fam"), ("s", "t_", "p", "M", "other")]
    rows = spark.createDataFrame(given, dims.replace("player", "maker"))
    out = {(r.segment, r.family): (r.qa_status, r.ref_valid, r.new_segment, r.new_family) for r in gate.validate_families(rows, keys).collect()}
    assert out["S", "Fam"] == (gate.MAPPED, "Y", "S", "Fam")
    assert out["S", "fam™ "] == (gate.MAPPED, "Y", "S", "Fam")
    assert out["S", "gen"] == (gate.REVIEW_GENERIC, "Y", "S", "Gen")
    assert out["X", "Fam"] == (gate.REVIEW_CATEGORY, "", "X", "Fam")
    assert out["s", "other"] == (gate.REVIEW_NOREF, "", "S", "other")


def test_last_guard_sets_status_first_sets_flag(spark):
    rows = spark.createDataFrame([("Mapped", "", "")], "qa_status string, scope_flag string, negative_group string")
    out = evidence.apply_guards(rows, [("a", F.lit(True), "A", "fa"), ("b", F.lit(True), "B", "fb")], F.lit(False)).first()
    assert (out.qa_status, out.scope_flag, out.guards_hit, out.include) == ("B", "fa:fa", ["a", "b"], "")


def test_reconciliation_finds_differences(spark):
    a = spark.createDataFrame([("1", "5"), ("2", "6")], "id string, value string")
    b = spark.createDataFrame([("1", "5"), ("1", "6")], "id string, value string")
    out = {r.check_name: r.status for r in validate.partition_reconciliation(a, b, "id").collect()}
    assert out == {"rows": "PASS", "value": "PASS", "ids": "FAIL", "duplicates": "FAIL"}


OBJECTS = [
    ("o1", "t1", "canonical_tuple", "medtronic", "covidien;medtronic", "endo gia", "surgical stapling", "tri staple reload", "medtronic covidien endo gia tri staple reload"),
    ("o2", "", "product_family_alias", "", "", "", "", "video endoscopy system", "video endoscopy system endoscope processor"),
    ("o3", "", "hard_exclusion_term", "", "", "", "", "orthodontic dental", "orthodontic dental abutment"),
    ("o4", "", "hard_exclusion_term", "", "", "", "", "aesthetic filler", "aesthetic filler dermal cosmetic"),
    ("o5", "t5", "canonical_tuple", "acme", "", "target", "implants", "", "acme target implant screw"),
    ("o6", "t6", "reviewed_mapping_example", "", "", "trocar", "", "bladeless trocar", "bladeless trocar 12mm approved"),
]
OBJECT = "object_id string, target_id string, object_type string, maker string, aliases string, family string, import_terms string, alias string, retrieval_text string"
ROWS = [
    (1, "covidien endo gia tri staple reload purple 60mm", True, False, False),
    (2, "covidien medical device accessory", False, False, False),
    (3, "orthodontic dental abutment kit", False, False, True),
    (4, "aesthetic filler cannula dermal injection", True, False, True),
    (5, "target medical device kit", False, True, False),
    (6, "video endoscopy system with endoscope processor", True, False, False),
    (7, "bladeless trocar 12mm", False, False, False),
    (8, "nothing of the kind", False, False, False),
]


def brute_score(text, evidence, generic, o, variant):
    """The score of one pair, written for a single row."""
    ratio = lambda a, b: difflib.SequenceMatcher(None, a, b).ratio()
    words = set(text.split())

    def phrase(values):
        best = 0.0
        for v in filter(None, values):
            if v in text if " " in v else v in words:
                return 1.0
            if len(v) >= 5 and words & set(v.split()):
                best = max(best, min(0.82, ratio(text[:400], v)))
        return best

    cosine = lambda a, b: len(a & b) / math.sqrt(len(a) * len(b)) if a and b else 0.0
    grams = lambda t, n: {t[k : k + n] for k in range(len(t) - n + 1)} if len(t) > n else {t} - {""}
    _, _, kind, maker, aliases, family, terms, alias, obj = o
    m, f = phrase([maker, *aliases.split(";")]), phrase([family, alias])
    product = max(phrase([family, terms]), 0.72 if evidence and kind == "canonical_tuple" else 0.0)
    exact = max(m, f, phrase([alias]))
    fuzzy = max(0.75 * ratio(text[:500], obj[:500]), ratio(text[:240], alias) if alias else 0.0)
    a, b = grams(text, 4), grams(obj, 4)
    dense = re.sub("[^a-z0-9]+", " ", " ".join([obj, maker, aliases, family, terms, alias])).strip()
    vector = 0.0 if variant == "B" else cosine(words | grams(text, 5), set(dense.split()) | grams(dense, 5))
    prior = float(kind == "reviewed_mapping_example" and exact >= 0.9)
    score = 0.25 * exact + 0.2 * cosine(words, set(obj.split())) + 0.15 * fuzzy + 0.1 * len(a & b) / len(a | b) + 0.2 * vector + 0.1 * prior
    if f >= 0.95 and m >= 0.95 and product >= 0.8:
        score = max(score, 0.92)
    elif exact >= 0.95 and product >= 0.9 and not generic:
        score = max(score, 0.62)
    return min(1.0, score)


@pytest.mark.parametrize("variant", ["B", "D"])
def test_candidate_scores_against_brute_force(spark, variant):
    rows = spark.createDataFrame(ROWS, "id long, text string, evidence boolean, generic boolean, excluded boolean")
    objects = spark.createDataFrame(OBJECTS, OBJECT)
    scored = retrieval.score_candidates(rows.crossJoin(objects), variant).collect()  # 48 pairs of a fixture
    for r in scored:
        want = brute_score(*[x[1:4] for x in ROWS if x[0] == r.id][0], [o for o in OBJECTS if o[0] == r.object_id][0], variant)
        assert r.score == pytest.approx(want, abs=6e-5), (r.id, r.object_id)
    assert len(scored) == len(ROWS) * len(OBJECTS)


def test_retrieval_decisions(spark):
    rows = spark.createDataFrame(ROWS, "id long, text string, evidence boolean, generic boolean, excluded boolean")
    objects = spark.createDataFrame(OBJECTS, OBJECT)
    pairs = retrieval.shortlist(rows, "id", "text", objects, 60).join(rows, "id").join(objects, "object_id")
    top = retrieval.top_k(retrieval.score_candidates(pairs), "id", 10)
    out = {r.id: r for r in retrieval.decide(rows, top, "id").collect()}
    assert {i: r.decision for i, r in out.items()} == {1: "map", 2: "unmatched", 3: "exclude", 4: "review", 5: "unmatched", 6: "new_target", 7: "review", 8: "unmatched"}
    assert out[1].target_id == "t1" and out[2].target_id is None and out[3].reason == "excluded without evidence" and out[4].reason == "evidence on both sides"
    truth = spark.createDataFrame([(1, "t1"), (7, "t6"), (8, "t5")], "id long, target_id string")
    assert tuple(retrieval.candidate_recall(top, truth, "id").first()) == (3, 2)


def test_phrase_hits_of_cut_words(spark):
    texts = [(1, "Knee implants, steel"), (2, "the ee implants steel!"), (3, "knee implant"), (4, "a b"), (5, None), (6, "xa by"), (7, "steel")]
    terms = ["ee implant", "knee implants steel", "a b", "steel", "implant", "nothing at all"]
    df = spark.createDataFrame(texts, "id long, text string")
    got = {r.id: list(r.hits) for r in match.phrase_hits(df, "id", "text", spark.createDataFrame([(t,) for t in terms], "term string")).collect()}
    norm = lambda t: re.sub("[^a-z0-9]+", " ", (t or "").lower()).strip()
    want = {i: sorted(x for x in terms if (x in norm(t) if " " in x else x in norm(t).split())) for i, t in texts}
    assert got == {i: h for i, h in want.items() if h} and want[1] == ["ee implant", "knee implants steel", "steel"] and want[6] == ["a b"]


def test_fuzzy_names_against_brute_force(spark):
    rng = random.Random(4)
    names = sorted({"".join(rng.choices("abcde", k=rng.randrange(6, 14))) for _ in range(60)})

    def edited(w):
        for _ in range(rng.randrange(0, 4)):
            k = rng.randrange(len(w))
            w = rng.choice([w[:k] + w[k + 1 :], w[:k] + rng.choice("abcde") + w[k + 1 :], w[:k] + rng.choice("abcde") + w[k:]])
        return w

    rows = [(k, " ".join(edited(rng.choice(names)) for _ in range(3))) for k in range(120)]
    df, known = spark.createDataFrame(rows, "id long, text string"), spark.createDataFrame([(n,) for n in names], "name string")
    got = {r.id: (r.distance, r.name, r.token) for r in match.fuzzy_match(df, "id", "text", known).collect()}

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row = [last := i] + [last := min(last + 1, row[j] + 1, row[j - 1] + (x != y)) for j, y in enumerate(b, 1)]
        return row[-1]

    want = {}
    for i, t in rows:
        found = []
        for token in {w for w in t.split() if 6 <= len(w) <= 18 and w not in names}:
            near = [(distance(token, n), n) for n in names if n[0] == token[0]]
            near = [x for x in near if 1 <= x[0] <= (1 if len(x[1]) < 10 else 2)]
            found += [(*min(near), token)] if near else []
        if found:
            want[i] = min(found)
    assert got == want and len(want) > 30


def test_read_delimited_falls_back_to_latin_1(spark, tmp_path):
    path = tmp_path / "x.tsv"
    path.write_bytes("a\tb\nné\t1\n".encode("latin-1"))
    assert [tuple(r) for r in tables.read_delimited(spark, str(path), "\t", ["a"]).collect()] == [("né", "1")]
    with pytest.raises(ValueError, match="lacks"):
        tables.read_delimited(spark, str(path), "\t", ["zz"])


def test_each_file_has_its_own_encoding(spark, tmp_path):
    (tmp_path / "a b.tsv").write_bytes("k\tname\n1\tMéxico\n2\tÅse ™\n".encode())
    (tmp_path / "b.tsv").write_bytes("k\tname\n3\tcafé\n4\tplain\n".encode("latin-1"))
    (tmp_path / "c.tsv").write_bytes("\ufeffk\tname\n5\tñ\n".encode())
    (tmp_path / "d.tsv").write_bytes(b"k\tname\n6\tascii\n")
    out = {r.k: r.name for r in tables.read_delimited(spark, str(tmp_path), "\t", ["k", "name"]).collect()}
    assert out == {"1": "México", "2": "Åse ™", "3": "café", "4": "plain", "5": "ñ", "6": "ascii"}


def test_large_files_of_either_encoding_stay_split(spark, tmp_path):
    for name, encoding in (("u.tsv", "utf-8"), ("l.tsv", "latin-1")):
        (tmp_path / name).write_bytes(("k\tv\n" + "".join(f"{n}\té{n}\n" for n in range(40_000))).encode(encoding))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100000")
    try:
        df = tables.read_delimited(spark, str(tmp_path))
        assert df.rdd.getNumPartitions() > 6
        assert df.filter("v <> concat('é', k)").count() == 0 and df.count() == 80_000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_state_of_files_follows_any_of_them(spark, tmp_path):
    for name in ("a", "b"):
        spark.range(3).write.parquet(str(tmp_path / name))
    paths = [str(tmp_path / n) for n in ("a", "b")]
    first = tables.file_state(spark, paths)
    assert first == tables.file_state(spark, paths)
    spark.range(4).write.mode("overwrite").parquet(paths[1])
    assert first != tables.file_state(spark, paths)


def test_stages_follow_every_table_that_they_read(spark, tmp_path):
    """Mapped shipments show the new names of suppliers whose file was replaced."""
    from tradeweave.plans import mapping_queries as mq

    source = "/root/testdata/sf0.001"
    if not os.path.isdir(source):
        pytest.skip("no test tables")
    for t in ("lineitem", "part", "orders", "supplier", "customer", "nation"):
        spark.read.parquet(f"{source}/{t}.parquet").write.parquet(f"{tmp_path}/{t}.parquet")
    assert mq.mapped(spark, str(tmp_path)).filter("exporter like 'New%'").count() == 0
    spark.read.parquet(f"{source}/supplier.parquet").withColumn("s_name", F.concat(F.lit("New "), "s_name")).write.mode("overwrite").parquet(f"{tmp_path}/supplier.parquet")
    rows = mq.mapped(spark, str(tmp_path))
    assert rows.filter("exporter like 'New%'").count() == rows.count() > 0


def test_slices_replace_only_their_own(spark, tmp_path):
    row = lambda c, v: (c, "s", "t", v, "p", "f", "m")
    schema = "country string, segment string, sub_segment string, upper_value double, product string, family string, maker string"
    path = str(tmp_path / "s")
    tables.write_slice(spark.createDataFrame([row("A", 1.0), row("B", 2.0)], schema), path)
    tables.write_slice(spark.createDataFrame([row("A", 9.0)], schema), path)
    assert [(r.country, r.upper_value) for r in tables.read_slices(spark, path).collect()] == [("A", 9.0), ("B", 2.0)]


def test_a_version_is_published_only_if_its_counts_are_right(spark, tmp_path, monkeypatch):
    path, schema = str(tmp_path / "p"), "country string, v double"
    read = lambda: sorted((r.country, r.v) for r in tables.read_published(spark, path).collect())
    df = lambda *rows: spark.createDataFrame(list(rows), schema)
    tables.publish_slices(df(("A", 1.0), ("A", 2.0), ("B", 3.0)), path, {"A": 2, "B": 1}, value="v", totals={"A": 3.0})
    assert read() == [("A", 1.0), ("A", 2.0), ("B", 3.0)]
    for rows, expected, totals, said in (
        ([("A", 9.0)], {"A": 2}, None, "A: 1 rows, expected 2"), ([("A", 9.0), ("C", 1.0)], {"A": 1}, None, "1 rows of other slices"),
        ([("A", 9.0), (None, 1.0)], {"A": 1}, None, "1 rows of other slices"), ([("A", 9.0)], {"A": 1}, {"A": 8.0}, "v 9.0, expected 8.0"), ([], {"A": 1}, None, "A: 0 rows"),
    ):
        with pytest.raises(ValueError, match=said):
            tables.publish_slices(df(*rows), path, expected, value="v", totals=totals)
        assert read() == [("A", 1.0), ("A", 2.0), ("B", 3.0)]

    with monkeypatch.context() as m:  # lost after the rows are written, before they are published

        def lost(*_):
            raise RuntimeError("lost")

        m.setattr(tables, "_publish", lost)
        with pytest.raises(RuntimeError):
            tables.publish_slices(df(("A", 9.0)), path, {"A": 1})
    assert read() == [("A", 1.0), ("A", 2.0), ("B", 3.0)]
    tables.publish_slices(df(("A", 9.0)), path, {"A": 1})
    assert read() == [("A", 9.0), ("B", 3.0)]
    tables.publish_slices(df(), path, {"B": 0})
    assert read() == [("A", 9.0)]


def test_only_buckets_that_differ_are_joined(spark):
    from tradeweave.operators import fingerprint, review, validate

    rows = [(k, f"s{k % 5}", float(k)) for k in range(20_000)]
    before = spark.createDataFrame(rows, "k long, s string, v double")
    after = before.filter("k <> 7").withColumn("s", F.when(F.col("k").isin(11, 12_345), "new").otherwise(F.col("s"))).unionByName(spark.createDataFrame([(50_000, None, None)], before.schema))
    a, b = fingerprint.rows_of_differing(before, after, ["k"], ["s", "v"])
    assert {7, 11, 12_345} <= {r.k for r in a.collect()} and {11, 12_345, 50_000} <= {r.k for r in b.collect()}
    assert a.count() < 40 and b.count() < 40  # of 20,000
    assert sorted((r.k, r.before_s, r.s) for r in review.changed_rows(before, after, "k", ["s"]).collect()) == [(11, "s1", "new"), (12_345, "s0", "new")]
    assert tuple(validate.compare_aggregates(before, after.fillna(4.5), ["k"], ["v"]).first()) == (1, 1, 11.5)
    assert review.changed_rows(before, before, "k", ["s", "v"]).count() == 0
    halves = [fingerprint.fingerprints(before.filter(c), ["k"], ["s"]) for c in ("k < 9999", "k >= 9999")]
    whole = fingerprint.fingerprints(before, ["k"], ["s"])
    assert fingerprint.differing_buckets(fingerprint.merged(halves[0].unionByName(halves[1])), whole).count() == 0


@pytest.mark.parametrize("hot", [False, True])
def test_quotas_that_are_data(spark, hot):
    """Groups of any size and many equal places give the same rows as a sort of each group."""
    from tradeweave.operators import quota

    rng = random.Random(4)
    rows = [(k, "a" if hot or k % 3 else rng.choice(["b", "c", None]), rng.choice([5, 5, rng.randrange(2**31)]) if k % 2 else rng.randrange(2**31)) for k in range(3000)]
    quotas = [("a", 700), ("b", 0), ("c", 10**6), (None, 17), ("unused", 3)]
    want = set()
    for g, n in quotas:
        want |= {k for _, k in sorted((p, k) for k, h, p in rows if h == g)[:n]}
    df = spark.createDataFrame(rows, "k long, g string, p long").repartition(5)
    out = [r.k for r in quota.first_by_quota(df, ["g"], F.col("p"), "k", spark.createDataFrame(quotas, "g string, quota long")).collect()]
    assert len(out) == len(set(out)) and set(out) == want


def test_capped_buckets_keep_their_top_rows(spark):
    from tradeweave.operators import review

    df = spark.createDataFrame([(k, str(k % 50)) for k in range(200)], "k long, value string")
    buckets = {"even": F.col("k") % 2 == 0, "all": F.col("k") >= 0, "late": F.col("k") > 190}
    out = {r.k: r.bucket for r in review.gold_template(df, "k", buckets, {"even": 3, "all": 2, "late": None}, ["label"]).collect()}
    assert sorted(k for k, b in out.items() if b == "even") == [48, 98, 148] and {k for k, b in out.items() if b == "all"} == {49, 99}
    assert {k for k, b in out.items() if b == "late"} == set(range(191, 200))


def test_row_count_gate(spark):
    tables.assert_row_count(spark.range(3), 3)
    with pytest.raises(ValueError, match="expected 4"):
        tables.assert_row_count(spark.range(3), 4)


def test_ground_truth(spark):
    a = spark.createDataFrame([("Screw, big", "90", "2.5", "2024")], "description string, hs_code string, value string, year string")
    out = tables.build_ground_truth({"f": a}, ["description", "hs_code", "value", "year", "maker"], "year", "2024").first()
    assert (out.desc_key, out.code, out.value_key, out.src_file, out.maker) == ("screw big", "90", 2, "f", None)


def test_stream_of_rows(spark, tmp_path):
    from tradeweave.streaming.incremental import map_stream

    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    spark.createDataFrame([("a b",)], "t string").write.parquet(src)
    rows = spark.readStream.schema("t string").parquet(src)
    map_stream(rows, lambda d: d.withColumn("k", X.norm_exact("t")), out, str(tmp_path / "cp")).awaitTermination()
    assert spark.read.parquet(out).first().k == "a b"


def test_candidates_of_both_pools_match_brute_force(spark, tmp_path):
    from tradeweave.plans import audit_queries as q

    rng = random.Random(3)
    words = ["".join(rng.choices("abcdefghij", k=rng.randrange(3, 7))) for _ in range(40)]
    docs = [(k, " ".join(rng.choices(words, k=12))) for k in range(6)]
    items = [(k, " ".join(rng.choices(words, k=8))) for k in range(100)] + [(202, docs[0][1]), (205, docs[1][1])]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))

    sets = lambda t: set(re.findall("[a-z]{3,}", t))
    kinds = ["hard_exclusion_term", "reviewed_mapping_example", "canonical_tuple", "canonical_tuple", "product_family_alias"]
    want, best = {}, {}
    for d, x in docs:
        evidence, generic = (bool(re.search(q._FLAGS[c], x)) for c in ("evidence", "generic"))
        for negative in (False, True):
            pool = [(-len(sets(x) & sets(y)), str(i), y) for i, y in items if (i % 5 == 0) == negative and sets(x) & sets(y)]
            assert len(pool) > 5
            scored = []
            for _, i, y in sorted(pool)[:60]:
                w = y.split()
                o = (i, i, kinds[int(i) % 5], w[0], "", " ".join(w[1:3]), "", " ".join(w[3:6]), y)
                want[d, i] = brute_score(x, evidence, generic, o, "D")
                scored.append((-round(want[d, i], 4), i))
            best[d, negative] = sorted(scored)[:3]
    got = {(r.doc_id, r.object_id): r.score for r in q.t4_score_candidates(spark, str(tmp_path)).collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-4 for k in want)
    top = {(r.doc_id, r.pool, r.object_id) for r in q.t5_top_k(spark, str(tmp_path)).collect()}
    assert top == {(d, "negative" if n else "positive", i) for (d, n), rows in best.items() for _, i in rows}
    out = {r.doc_id: r for r in q.t6_decide(spark, str(tmp_path)).collect()}
    for d, _ in docs:
        pos, neg = (-best[d, n][0][0] for n in (False, True))
        assert abs(out[d].positive - pos) < 2e-4 and abs(out[d].negative - neg) < 2e-4
    assert (out[0].decision, out[0].target_id) == ("map", "202") and out[1].target_id is None
    m = {r.variant: r for r in q.t7_variant_metrics(spark, str(tmp_path)).collect()}
    assert m["D"].n_rows == m["B"].n_rows == len(docs) and m["D"].n_map == sum(r.decision == "map" for r in out.values())
    assert tuple(q.t7_candidate_recall(spark, str(tmp_path)).first()) == (2, 1)  # an exclusion is no candidate
