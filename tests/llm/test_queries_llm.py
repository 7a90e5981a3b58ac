"""The registered queries over small tables against plain versions of their operators."""

import hashlib
import math
import random
import re
import unicodedata
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tradeweave.llm import queries, quality, url_filter

STEMS = {"aa": "ka lo mi tu no".split(), "bb": "ster ing ough el".split(), "cc": "ça né üb ka".split()}


def some_words(rng, lang, n):
    return " ".join("".join(rng.choices(STEMS[lang], k=rng.randrange(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Documents, labels, pages and benchmark items in a folder, and the rows."""
    path, rng = tmp_path_factory.mktemp("tables"), random.Random(41)
    langs, spread = list(STEMS), "this very line stands on many sites of the corpus"
    items = [(k, some_words(rng, "bb", 24)) for k in range(4)] + [(4, "short item"), (5, None)]
    docs = []
    for k in range(90):
        lang = langs[k % 3]
        text = f"{some_words(rng, lang, 40)}\n{spread if k % 2 else some_words(rng, lang, 9)}\n{some_words(rng, lang, 30)}"
        if k % 9 == 4:
            text += f" {items[k % 4][1].upper()} {some_words(rng, lang, 20)}"
        docs.append((k, text, lang if k % 5 else None, f"s{k % 7}", len(text)))
    near = docs[10][1].replace(docs[10][1].split()[3], "edited")
    docs += [(200, docs[7][1], "bb", "s9", 5), (201, near, "bb", "s1", 5), (202, None, None, None, None), (203, "", "aa", "s0", 0), (204, "☺️ 12 !", "aa", "s0", 6), (205, items[1][1], "bb", "s2", 1), (206, docs[7][1], "bb", None, 5)]
    labels = [(k, int(k % 4 != 1), 0) for k in range(0, 60)] + [(None, 1, 0), (999, 1, 0)]
    part = lambda x: "".join(rng.choices(x, k=9))
    pages = [(k, f"http://h{k % 5}.{'com/fr' if k % 3 else 'com/de'}/{part('abcde' if k % 3 else 'defgh')}", "x") for k in range(160)]
    pages += [(300 + k, f"http://h.net/{part('abcde' if k % 2 else 'defgh')}", "x") for k in range(40)] + [(400, None, None), (401, "no scheme", "y")]
    for name, rows, schema in (
        ("documents", docs, "doc_id long, text string, lang string, source string, n_chars long"), ("labels", labels, "doc_id long, quality int, toxic int"),
        ("pages", pages, "page_id long, url string, html string"), ("benchmark", items, "item_id long, text string"),
    ):
        spark.createDataFrame(rows, schema).repartition(3).write.parquet(str(path / f"{name}.parquet"))
    return str(path), docs, labels, pages, items


def ranked_grams(texts):
    """Ranks of the n-grams of texts, by count, then by code points."""
    counts = Counter()
    for t in texts:
        letters = "".join(c if unicodedata.category(c)[0] in "LM" else " " for c in (t or "").lower())
        for w in letters.split():
            w = f" {w} "
            counts.update(g for n in (1, 2, 3) for k in range(len(w) - n + 1) if (g := w[k : k + n]) != " ")
    code = lambda g: sum(ord(c) << 21 * k for k, c in enumerate(reversed(g)))
    return {g: r for r, g in enumerate(sorted(counts, key=lambda g: (-counts[g], code(g)))[:300])}


def test_language_id_against_plain_ranks(spark, folder):
    path, docs, *_ = folder
    held = lambda i: zlib.crc32(str(i).encode()) % 4 == 2
    texts = defaultdict(list)
    for i, t, lang, *_ in docs:
        if lang and not held(i):
            texts[lang].append(t)
    profiles = {lang: ranked_grams(ts) for lang, ts in texts.items()}
    out = {r.doc_id: r for r in queries.op7_language_id(spark, path).collect()}
    assert len(out) == len(docs)
    for i, t, *_ in docs:
        own = ranked_grams([t]) if any(unicodedata.category(c)[0] == "L" for c in t or "") else {}
        best = min(((sum(abs(r - p[g]) if g in p else 300 for g, r in own.items()), lang) for lang, p in profiles.items())) if own else None
        want = (best[1], 1 - best[0] / (300 * len(own))) if own else ("und", 0.0)
        assert (out[i].held_out, out[i].lang_pred) == (held(i), want[0]) and out[i].score == pytest.approx(want[1])


def test_url_filter_against_plain_models(spark, folder):
    path, _, _, pages, _ = folder
    table = queries.table(spark, path, "pages")
    fold = {r.page_id: r.f for r in table.select("page_id", F.pmod(F.xxhash64("url"), F.lit(4)).alias("f")).collect()}

    def rule(url):
        after = url.split("://", 1)[1] if url and "://" in url else ""
        host, at = re.match("[^/?#]*", after)[0].lower(), re.match("[^/?#]*([^?#]*)", after)[1]
        fits = [r for r in url_filter.RULES for h, p in [r.split("/", 1)] if (host == h or host.endswith("." + h)) and at.startswith("/" + p)]
        return host, at, max(fits, key=len, default=None)

    counts = {"allow": Counter(), "block": Counter()}
    for i, url, _ in pages:
        r = rule(url)[2]
        if r and fold[i]:
            t = f"\x02{url}\x03"
            counts[url_filter.RULES[r]].update(t[k - n : k + 1] for k in range(len(t)) for n in range(min(5, k) + 1))
    kept = {v: {g: n for g, n in c.items() if len(g) <= 2 or n >= 3} for v, c in counts.items()}

    def chance(grams, g):
        shorter = chance(grams, g[1:]) if len(g) > 1 else 1 / 256
        after = [n for x, n in grams.items() if x[:-1] == g[:-1]]
        return (grams.get(g, 0) + len(after) * shorter) / (sum(after) + len(after)) if after else shorter

    memo = {}

    def score(url):
        t = f"\x02{url or ''}\x03"
        for k in range(len(t)):
            for v in kept:
                memo.setdefault((v, t[max(0, k - 5) : k + 1]), math.log(chance(kept[v], t[max(0, k - 5) : k + 1])))
        return sum(memo["allow", g] - memo["block", g] for k in range(len(t)) for g in [t[max(0, k - 5) : k + 1]]) / len(t)

    judged = [(score(u), url_filter.RULES[rule(u)[2]]) for i, u, _ in pages if rule(u)[2] and not fold[i]]
    best = (-1, 0, 0)
    for k in range(401):
        at = k / 50 - 4
        share = lambda v, ok: sum(ok(s) for s, w in judged if w == v) / sum(w == v for _, w in judged)  # noqa: E731, B023
        best = max(best, (round(share("allow", lambda s: s >= at) + share("block", lambda s: s < at), 9), -abs(at), at))  # noqa: B023
    out = {r.page_id: r for r in queries.op6_url_filter(spark, path).collect()}
    assert len(out) == len(pages)
    for i, url, _ in pages:
        host, at, r = rule(url)
        assert (out[i].host, out[i].path, out[i].rule) == (host, at, r)
        assert out[i].verdict == (url_filter.RULES[r] if r else "allow" if score(url) >= best[2] else "block")
        assert (out[i].score is None) == bool(r) and (r or out[i].score == pytest.approx(score(url), abs=1e-9))
    assert {out[i].verdict for i in range(300, 340)} == {"allow", "block"}


def test_quality_against_plain_sums(spark, folder):
    path, docs, labels, *_ = folder
    out = {r.doc_id: r for r in queries.op5_quality(spark, path).collect()}
    assert len(out) == len(docs)
    truth = {i: y for i, y, _ in labels if i is not None}
    known = [truth[i] for i, *_ in docs if i in truth]
    base = (sum(known) + 1) / (len(known) + 2)
    x = [quality.features(t) for i, t, *_ in docs if i in truth]
    w = quality.fit(quality.np.array(x), quality.np.array(known, dtype=float))
    rates, sites = defaultdict(list), defaultdict(list)
    for i, t, lang, site, _ in docs:
        e = float(quality.np.clip(quality.expanded(quality.np.array([quality.features(t)])) @ w, -30, 30)[0]) - math.log(base / (1 - base))
        assert out[i].evidence == pytest.approx(e, abs=1e-6)
        good = truth[i] if i in truth else 1 / (1 + math.exp(-e) * (1 - base) / base)
        rates[site or "", lang or ""].append(good)
        sites[site or ""].append(good)
    everything = [g for gs in sites.values() for g in gs]
    overall = (sum(everything) + 1) / (len(everything) + 2)

    def strength(groups, prior):
        seen = chance = more = 0.0
        for key, gs in groups.items():
            p = prior(key)
            seen += len(gs) * (sum(gs) / len(gs) - p) ** 2
            chance += p * (1 - p)
            more += p * (1 - p) * (len(gs) - 1)
        return min(1e4, max(1.0, more / (seen - chance) - 1)) if more and seen > chance else 1e4

    s1 = strength(sites, lambda _: overall)
    of_site = {k: (sum(gs) + overall * s1) / (len(gs) + s1) for k, gs in sites.items()}
    s2 = strength(rates, lambda k: of_site[k[0]])
    for i, _, lang, site, _ in docs:
        gs, p = rates[site or "", lang or ""], of_site[site or ""]
        rate = (sum(gs) + p * s2) / (len(gs) + s2)
        assert out[i].site_rate == pytest.approx(p, abs=1e-4) and out[i].section_rate == pytest.approx(rate, abs=1e-4)
        score = 1 / (1 + math.exp(-out[i].evidence) * (1 - rate) / rate)
        assert out[i].score == pytest.approx(score, abs=1e-3) and out[i].kept == (out[i].score >= 0.5)


def test_pipeline_against_plain_stages(spark, folder):
    from tokenizers import Tokenizer

    path, docs, _, _, items = folder
    rows = [(i, t, s or "") for i, t, _, s, _ in docs if any(unicodedata.category(c)[0] == "L" for c in t or "")]
    # Lines of 20 characters on five sites stay at their first place.
    sites, first = defaultdict(set), {}
    for i, t, s in sorted(rows):
        for pos, line in enumerate(t.split("\n")):
            sites[line.strip(" ")].add(s)
            first.setdefault(line.strip(" "), (i, pos))
    gone = {x for x, on in sites.items() if len(x) >= 20 and len(on) >= 5}
    lines = lambda i, t: [x for pos, x in enumerate(t.split("\n")) if x.strip(" ") not in gone or first[x.strip(" ")] == (i, pos)]
    rows = [(i, "\n".join(lines(i, t))) for i, t, _ in rows]
    # One of each group of similar texts.
    sets = {}
    for i, t in rows:
        w = re.sub("[A-Z]", lambda m: m[0].lower(), t).split()
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    up = {i: i for i in sets}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                up[y] = x
    rows = [(i, t) for i, t in rows if root(i) == i]
    # Words within windows of items go, documents that are mostly such words too.
    find = lambda t: list(re.finditer(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", t or ""))
    low = lambda ms: [re.sub("[A-Z]", lambda m: m[0].lower(), m[0]) for m in ms]
    windows = {tuple(w[k : k + n]) for _, t in items for w in [low(find(t))] for n in [min(10, len(w))] if n for k in range(len(w) - n + 1)}
    cut = []
    for i, t in rows:
        total, removed = None, 0
        while True:
            ms = find(t)
            w = low(ms)
            total = len(w) if total is None else total
            hit = sorted({p for n in {len(x) for x in windows} for k in range(len(w) - n + 1) if tuple(w[k : k + n]) in windows for p in range(k, k + n)})
            if not hit:
                break
            removed += len(hit)
            parts, at = [], 0
            for k, h in enumerate(hit):
                if not k or hit[k - 1] != h - 1:
                    parts.append(t[at : ms[h].start()])
                at = ms[h].end()
            t = "".join([*parts, t[at:]])
        if removed <= 0.5 * total:
            cut.append((i, t))
    theirs = Tokenizer.from_file(queries.tokenizer_path())
    theirs.no_padding()
    theirs.no_truncation()
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    want = {}
    for i, t in cut:
        ids = theirs.encode(t, add_special_tokens=False).ids
        want[i] = (len(ids), sha(" ".join(map(str, ids))), sha(theirs.decode(ids, skip_special_tokens=False)))
    out = queries.pipeline(spark, path).collect()
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in out} == want and len(out) == len(want)
    assert 200 not in want and 205 not in want and 203 not in want and len(want) > 70
