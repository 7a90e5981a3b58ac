"""Operators 11 to 13 against plain versions."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tradeweave.llm import lexical_search, merkle, packing, queries

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def field(x):
    return "-" if x is None else f"{len(str(x).encode())}:{x}"


def plain_manifest(rows, tampered):
    """(doc_id, leaf) -> (subroot, root, proof digest, folded root), node by node."""

    def tree(digests):
        levels = [digests]
        while len(levels[-1]) > 1:
            levels.append([sha("".join(levels[-1][k : k + 8])) for k in range(0, len(levels[-1]), 8)])
        return levels

    def path(levels, k):
        out = []
        for level in levels[:-1]:
            a = k - k % 8
            out.append(("".join(level[a:k]), "".join(level[k + 1 : a + 8])))
            k //= 8
        return out

    groups = defaultdict(list)
    for i, text, lang, source, n in rows:
        own = sha("".join(map(field, (i, source, lang, n, text))))
        groups[lang].append((i is not None, i, own, sha("".join(map(field, (i, source, lang, n, tampered(i, text)))))))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: tree([r[2] for r in sorted(groups[g], key=lambda r: (r[0], r[1] or 0, r[2]))]) for g in names}
    top = tree([trees[g][-1][0] for g in names])
    out = Counter()
    for at, g in enumerate(names):
        for k, (_, i, own, other) in enumerate(sorted(groups[g], key=lambda r: (r[0], r[1] or 0, r[2]))):
            steps = path(trees[g], k) + path(top, at)
            x = other
            for a, b in steps:
                x = sha(a + x + b)
            out[i, own, trees[g][-1][0], top[-1][0], sha("".join(a + b for a, b in steps)), x] += 1
    return out


def random_documents(n, seed=3):
    rng = random.Random(seed)
    langs = ["aa"] * 6 + ["bb", "cc", None, "", "é"]
    rows = [(k, f"Text {rng.random()} É", langs[rng.randrange(11)], f"S{k % 3}" if k % 4 else None, k if k % 5 else None) for k in range(n)]
    return rows + [(n, None, "aa", None, None), (n + 1, "", "aa", "", 0), (n + 2, "alone", "zz", "x", 5), (None, "no id", "aa", "x", 1), (None, "None", "aa", "x", 1), (7, "twice", "aa", "x", 2), (7, "twice", "aa", "x", 2)]


@pytest.mark.parametrize("n", [0, 5, 80, 1500])
def test_manifest_matches_plain_trees(spark, tmp_path, n):
    rows = random_documents(n)
    spark.createDataFrame(rows, SCHEMA).repartition(5).write.parquet(f"{tmp_path}/documents.parquet")
    low = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})
    tampered = lambda i, t: t.translate(low) if t is not None and i is not None and zlib.crc32(str(i).encode()) % 3 == 0 else t
    got = Counter()
    for r in queries.op11_merkle_manifest(spark, str(tmp_path)).collect():
        got[r.doc_id, r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root] += 1
        assert r.verified == (r.folded_root == r.root)
    assert got == plain_manifest(rows, tampered)


def test_superblocks_on_several_levels(spark):
    """With superblocks of 8 leaves, a tree of 1,000 has four levels of them; so have the groups."""
    rows = [(k, f"t{k}", "aa" if k % 3 else f"g{k:04d}", "s", 1) for k in range(1000)]
    out = merkle.manifest(spark.createDataFrame(rows, SCHEMA), claimed={"text": F.when(F.col("doc_id") == 5, "else").otherwise(F.col("text"))}, height=1).collect()
    got = Counter((r.doc_id, r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root) for r in out)
    assert got == plain_manifest(rows, lambda i, t: "else" if i == 5 else t)
    assert [r.doc_id for r in out if not r.verified] == [5]


def test_manifest_of_odd_and_no_rows(spark):
    assert merkle.manifest(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = [(1, "x" * 300_000, "aa", "s", 1, {"k": 1}, "clash", 3), (2, None, None, None, None, None, None, None)]
    docs = spark.createDataFrame(rows, SCHEMA + ", `a.b` map<string,int>, digest string, pos long")
    out = {r.doc_id: r for r in merkle.manifest(docs).collect()}
    assert out[1].leaf == sha("".join(map(field, (1, "s", "aa", 1, "x" * 300_000)))) and out[2].leaf == sha("1:2----")
    assert out[1].root == sha(out[2].leaf + out[1].leaf) and all(r.verified for r in out.values())
    wide = {r.doc_id: r for r in merkle.manifest(docs, ["doc_id", "a.b"]).collect()}
    assert wide[1].leaf != wide[2].leaf and len(wide) == 2


# --- packing ---------------------------------------------------------------------------------


def check_packed(rows, most):
    """Sequences without gaps or overlaps, none too long; how many there are."""
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= most
    return len(by)


def test_packed_pieces_are_the_librarys(spark, tmp_path):
    from tokenizers import Tokenizer

    rng = random.Random(5)
    words = "one Two three forty-five déjà vu ☺ 77 isn't <|endoftext|> ΣΑΣ \u1680 \u2028x".split(" ")
    rows = [(k, " ".join(rng.choices(words, k=rng.randrange(0, 900))), "aa", "s", 0) for k in range(60)]
    rows += [(100, None, None, None, None), (101, "", "aa", "s", 0), (None, "no id", "aa", "s", 0), (102, "word " * 9000, "aa", "s", 0), (7, "twice", "aa", "s", 0), (7, "twice", "aa", "s", 0)]
    spark.createDataFrame(rows, SCHEMA).repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    library, want = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), Counter()
    for i, text, *_ in rows:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 1]
        for start in range(0, len(ids), 4096):
            part = ids[start : start + 4096]
            want[i, start // 4096, start, len(part), zlib.crc32(np.array(part, "<u4").tobytes())] += 1
    out = queries.op12_best_fit_packing(spark, str(tmp_path)).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in out) == want
    total = sum(r.length for r in out)
    assert check_packed(out, 4096) <= -(-total // 4096) + 1


def test_sequences_hold_the_ids(spark):
    docs = spark.createDataFrame([(k, f"some words {k} " * (k % 7), "aa", "s", 0) for k in range(40)], SCHEMA)
    path = public_tokenizers.path("word_bpe_49k.json")
    pieces = packing.tokenized_pieces(docs, path, max_tokens=32)
    packed = packing.pack(pieces, 32)
    whole = {(r.doc_id, r.piece): r.ids for r in pieces.collect()}
    by = {r.sequence_id: r for r in packing.sequences(packed).collect()}
    for r in packed.collect():
        assert by[r.sequence_id].ids[r.offset : r.offset + r.length] == whole[r.doc_id, r.piece]
    assert all(len(r.ids) <= 32 for r in by.values())
    assert packing.pack(pieces.limit(0), 32).count() == 0


def plain_best_two_fit(lengths, most):
    """One bin at a time over single pieces, as the method says."""
    left, bins = sorted(lengths, reverse=True), []
    while left:
        bin_, room = [], most
        for n in list(left):
            if n <= room:
                bin_.append(n)
                left.remove(n)
                room -= n
        while room:
            least, best = min(bin_), (0, 0, 0)
            for k, a in enumerate(left):
                for b in left[k + 1 :]:
                    if a + b <= room + least:
                        best = max(best, (a + b, a, b))
            if best[0] <= least:
                break
            bin_.remove(least)
            left = sorted(left + [least], reverse=True)
            for n in best[1:]:
                bin_.append(n)
                left.remove(n)
            room += least - best[0]
        bins.append(sorted(bin_))
    return bins


@pytest.mark.parametrize("seed", range(12))
def test_bins_over_a_histogram_are_those_of_single_pieces(seed):
    rng = random.Random(seed)
    most = rng.choice([10, 40, 100])
    lengths = [rng.randrange(1, most + 1) for _ in range(rng.randrange(1, 70))] + [most // 3] * rng.randrange(0, 30)
    bins = packing.best_two_fit(np.bincount(lengths, minlength=most + 1), most)
    got = [sorted(b.elements()) for b, times in bins for _ in range(times)]
    assert sorted(got) == sorted(plain_best_two_fit(lengths, most))
    assert sorted(n for b in got for n in b) == sorted(lengths)


def test_two_pieces_take_the_place_of_the_smallest():
    """6 + 3 leaves a gap of 1; 2 + 2 in place of the 3 closes it."""
    bins = packing.best_two_fit(np.bincount([6, 3, 2, 2], minlength=11), 10)
    assert [sorted(b.elements()) for b, _ in bins] == [[2, 2, 6], [3]]


def test_many_pieces_take_few_rounds():
    rng = np.random.default_rng(1)
    counts = np.bincount(np.minimum(4096, rng.lognormal(6, 1.2, 3_000_000).astype(int) + 1), minlength=4097)
    bins = packing.best_two_fit(counts, 4096)
    used = sum(times for _, times in bins)
    total = int((counts * np.arange(4097)).sum())
    assert len(bins) < 4 * 4096 and used <= math.ceil(total / 4096) * 1.001


def test_places_of_hot_lengths(spark):
    """A third of all pieces has one length; columns that clash with own names are replaced or stay."""
    rows = [(k, 7 if k % 3 == 0 else 1 + k % 20, "x", 99) for k in range(3000)]
    pieces = spark.createDataFrame(rows, "doc_id long, length long, `a.b` string, offset long").repartition(7)
    out = packing.pack(pieces, 20).collect()
    assert len(out) == 3000 and {r["a.b"] for r in out} == {"x"}
    used, least = check_packed(out, 20), -(-sum(r[1] for r in rows) // 20)
    assert least <= used <= 1.12 * least  # three of the hot length don't fit, so no packing is without gaps


# --- search ----------------------------------------------------------------------------------

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOW = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def plain_ranks(docs, items, k=10):
    texts = [(i, Counter(TERM.findall((t or "").translate(LOW)))) for i, t in docs]
    texts = [(i, c, sum(c.values())) for i, c in texts if c]
    big, total = len(texts), sum(n for *_, n in texts)
    df = Counter(t for _, c, _ in texts for t in c)
    asked = defaultdict(set)
    for i, t in items:
        asked[i].update(TERM.findall((t or "").translate(LOW)))
    out = []
    for item, terms in asked.items():
        scored = []
        for i, c, n in texts:
            m = 10 + 90 * n * big // total
            s = sum(math.floor(1000 * math.log((2 * big + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in terms if t in c)
            if s > 0:
                scored.append((-s, i is not None, i or 0, i))
        out += [(item, r + 1, x[3], -x[0]) for r, x in enumerate(sorted(scored, key=lambda x: x[:3])[:k])]
    return Counter(out)


def search_rows(seed, n=150):
    rng = random.Random(seed)
    word = lambda: rng.choice(["Alpha", "beta", "gamma-ray", "Élan", "x1", "ÀB", "w%d" % rng.randrange(60)])
    docs = [(k, " ".join(word() for _ in range(rng.randrange(0, 60)))) for k in range(n)]
    docs += [(n + k, docs[3][1]) for k in range(40)] + [(3, docs[3][1]), (None, "alpha beta"), (None, None), (900, None), (901, ""), (902, "... !"), (903, "alpha " * 40_000)]
    items = [(k, " ".join(word() for _ in range(rng.randrange(0, 12)))) for k in range(30)]
    return docs, items + [(3, "w1 w2 w3"), (None, "alpha w5"), (77, None), (78, ""), (79, "unseen words only"), (80, docs[3][1])]


@pytest.mark.parametrize("sizes", [{}, {"shard_terms": 60, "tile": (4, 5), "block": 16}])
def test_search_matches_plain_ranks(spark, sizes):
    docs, items = search_rows(2)
    d = spark.createDataFrame([(*r, "x", 1) for r in docs], "doc_id long, text string, item_id string, score int").repartition(6)
    q = spark.createDataFrame([(*r, "y") for r in items], "item_id long, text string, `a.b` string").repartition(3)
    out = lexical_search.search(d, q, **sizes)
    assert out.dtypes == [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
    assert Counter(map(tuple, out.collect())) == plain_ranks(docs, items)


def test_search_of_no_rows(spark):
    docs, items = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([(1, "a")], "item_id long, text string")
    some = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    assert lexical_search.search(docs, items).count() == 0
    assert lexical_search.search(some, items.limit(0)).count() == 0
    assert [tuple(r) for r in lexical_search.search(some.selectExpr("cast(doc_id as string) doc_id", "text"), items).collect()] == [(1, 1, "1", 287 * (10**9 // 1800))]


def test_products_stay_exact():
    for n in (1, 10**6, 10**12):
        assert lexical_search.tile_width(n) * lexical_search.weight(n, 0) * 10**6 < 2**53
    big = np.full((1, 4096), float(lexical_search.weight(10**12, 0)))
    assert int((big @ np.full((4096, 1), 999_999.0))[0, 0]) == 4096 * lexical_search.weight(10**12, 0) * 999_999
