"""Text-to-dictionary matching as equi-joins.

The places of a text follow the dictionary, a trie of words kept as a table, by joins on a derived key.
What the dictionary's size allows, Spark broadcasts; beyond that the same plan shuffles both sides. Equal
texts of many rows are matched once, and a short id takes a text's place in the explosion.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeweave.functions import predicates as P
from tradeweave.functions import text as X
from tradeweave.sources.tables import small, staged

#: A word, and a word with what stands between it and the next.
_ONE = r"([\p{L}\p{N}]+)"
_WORD = r"([\p{L}\p{N}]+[^\p{L}\p{N}]*)"


def max_words(dictionary: DataFrame, column: str) -> int:
    """The most words that an entry has: how long windows must be (a single number)."""
    n = dictionary.agg(F.max(F.size(F.regexp_extract_all(column, F.lit(_WORD), 1))).alias("n")).first().n
    return int(n or 1)


def by_text(df: DataFrame, key: str, text: Column, find: Callable[[DataFrame], DataFrame], keep: Iterable[str] = (), how: str = "inner") -> DataFrame:
    """``find``, a function of distinct texts (id, t) that gives rows with id, for each row: key, the
    columns to keep, and what was found. Texts of transactions repeat often, so each is matched once;
    their ids are digests of 16 bytes, which take the texts' place in explosions and joins."""
    own = df.select(F.col(key), *keep, text.alias("_t"))
    # Never null, so that no filter of the join makes each text's normal form once more.
    id_ = F.coalesce(F.unhex(F.md5("_t")), F.lit(b""))
    # The text is a key too: kept by an aggregate, texts would make Spark sort all rows.
    texts = own.filter("_t is not null").select(id_.alias("id"), F.col("_t").alias("t")).distinct()
    found = find(texts).withColumnRenamed("id", "_text_id")
    return own.withColumn("_text_id", id_).drop("_t").join(found, "_text_id", how).drop("_text_id")


def occurrences(texts: DataFrame, entries: DataFrame, column: str) -> DataFrame:
    """(id, pos, ``column``): each place at which an entry stands in a text (id, t) between characters that
    are no letters or digits. Entries begin with a letter or digit.

    The entries form a trie over words, each with the separators after it, kept as a table of its inner
    nodes. A place of a text follows it word by word, one join a word, and only places at an inner node go on.
    As a place is at one node at most, many entries with a common beginning don't multiply it. A place carries
    the words that the deepest entry may need and never the text, so work is linear in the text.
    """
    entries = entries.select(column).distinct()
    parts, stem = F.regexp_extract_all(column, F.lit(_WORD), 1), F.regexp_extract(column, r"(?s)^(.*[\p{L}\p{N}])", 1)
    tail = F.regexp_extract(column, r"([^\p{L}\p{N}]*)$", 1)
    ends = entries.select(column, stem.alias("_stem"), tail.alias("_tail"))
    before = F.transform(F.sequence(F.lit(1), F.size(parts) - 1), lambda k: F.array_join(F.slice(parts, F.lit(1), k), ""))
    inner = entries.filter(F.size(parts) > 1).select(F.explode(before).alias("_node")).distinct()
    # How many words entries have (a few numbers): places aren't held against the entries of a length that none has.
    lengths = {max(r.n or 1, 1) for r in entries.select(F.size(parts).alias("n")).distinct().collect()} or {1}
    depth = max(lengths)

    # The tokens are a column before they are exploded: made beside the generator, they would be made again for each place.
    tokens = F.regexp_extract_all("t", F.lit(_WORD), 1)
    cut = texts.select("id", tokens.alias("s"))
    if depth > 1:  # read once a word of the deepest entry
        cut = staged(cut, "words")
    cut = cut.withColumn("n", F.size("s"))
    next_ = [F.slice("s", F.lit(k + 1), F.greatest(F.col("n"), F.lit(1))).alias(f"t{k}") for k in range(1, depth)]
    start = cut.select("id", "n", F.posexplode(F.arrays_zip(F.col("s").alias("t0"), *next_)).alias("pos", "z"))
    start = start.select("id", "pos", (F.col("n") - F.col("pos") - 1).alias("left"), F.lit("").alias("node"), "z.*")

    def found(places, k):
        # What follows the entry's own last separators must not be a word.
        at = places.select("id", "pos", "left", "node", F.col(f"t{k}").alias("token")).withColumn("word", F.regexp_extract("token", _ONE, 1))
        rest = F.expr("substring(token, length(word) + 1)")
        fits = (F.col("_tail") == "") | (rest.startswith(F.col("_tail")) & ((rest != F.col("_tail")) | (F.col("left") == k)))
        at = at.withColumn("_at", F.concat("node", "word"))
        return at.join(ends, F.col("_at") == F.col("_stem")).filter(fits).select("id", "pos", column)

    out, places = found(start, 0) if 1 in lengths else None, start
    for k in range(1, depth):
        on = places.withColumn("node", F.concat("node", f"t{k - 1}")).filter(F.col("left") >= k)
        places = on.join(inner, F.col("node") == F.col("_node"), "left_semi").drop(f"t{k - 1}")
        if k < depth - 1:
            places = staged(places, "places")
        if k + 1 in lengths:
            out = found(places, k) if out is None else out.unionByName(found(places, k))
    return out


def match_keywords(df: DataFrame, key: str, text: str, keywords: DataFrame, allowed: Column | None = None, keep: Iterable[str] = ()) -> DataFrame:
    """M1: (key, keyword, pos): the leftmost keyword that stands in the lower-cased text between
    characters that are no letters or digits; at one place the longest.

    Keywords begin with a letter or digit. Rows for which ``allowed`` doesn't hold and rows without
    a hit are not in the result.
    """
    rows = df.filter(allowed) if allowed is not None else df

    def find(texts):
        hits = occurrences(texts, keywords, "keyword")
        best = hits.groupBy("id").agg(F.min(F.struct("pos", (-F.length("keyword")).alias("l"), "keyword")).alias("b"))
        return best.select("id", "b.keyword", "b.pos")

    return by_text(rows, key, F.lower(X.text(text)), find, keep)


def word_runs(df: DataFrame, key: str, words: Column, most: int) -> DataFrame:
    """(key, run): the distinct runs of 1 to ``most`` words of a text in normal form."""
    split = F.filter(F.split(words, " "), lambda w: w != "")
    rows = df.select(F.col(key), split.alias("_w")).filter(F.size("_w") > 0)
    runs = F.flatten(
        F.transform(
            F.sequence(F.lit(1), F.size("_w")),
            lambda i: F.transform(F.sequence(F.lit(1), F.least(F.lit(most), F.size("_w") - i + 1)), lambda n: F.array_join(F.slice("_w", i, n), " ")),
        )
    )
    return rows.select(key, F.explode_outer(F.array_distinct(runs)).alias("run")).filter("run is not null")


def match_phrases(
    df: DataFrame, key: str, text: str, phrases: DataFrame, allowed: Column | None = None, keep: Iterable[str] = (), how: str = "inner"
) -> DataFrame:
    """M2: (key, phrase): the longest phrase whose words stand in the text; of equals the first."""
    rows = df.filter(allowed) if allowed is not None else df

    def find(texts):
        hits = occurrences(texts, phrases, "phrase")
        return hits.groupBy("id").agg(F.min(F.struct((-F.length("phrase")).alias("l"), "phrase"))["phrase"].alias("phrase"))

    return by_text(rows, key, X.norm_phrase(text), find, keep, how)


def code_segments(matched: DataFrame, code: str, segment: str = "segment", weight: str | None = None) -> DataFrame:
    """(code, code_segment, share): the dominant segment of each code's tier-1 matches."""
    from .lexicon import dominant

    return dominant(matched, [code], segment, weight).select(code, F.col(segment).alias("code_segment"), "share")


def _head(text: Column, heads: Iterable[str]) -> Column:
    """The first head that is a word of the text in phrase form."""
    words = F.split(text, " ")
    return F.coalesce(*[F.when(F.array_contains(words, h), F.lit(h)) for h in heads])


def _of_head(head: Column, min_share: float) -> dict[str, Column]:
    """Product and segment of a head; the segment is the code's, if dominant enough."""
    segment = F.when(F.col("share") >= min_share, F.col("code_segment")).otherwise("")
    return {"product": F.concat(F.initcap(head), F.lit(" (unspecified)")), "segment": segment}


def match_heads(df: DataFrame, key: str, text: str, code: str, heads: Iterable[str], segments: DataFrame, min_share: float = 0.5) -> DataFrame:
    """M3: (key, phrase, product, segment): the first head that is a word of the text, its product
    marked as unspecified; the segment is the code's, if dominant enough, else ''."""
    rows = df.select(key, code, _head(X.norm_phrase(text), heads).alias("phrase")).filter("phrase is not null")
    rows = rows.join(segments, code, "left")
    return rows.select(key, "phrase", *(c.alias(n) for n, c in _of_head(F.col("phrase"), min_share).items()))


def match_category(
    df: DataFrame, key: str, text: str, code: str, phrases: DataFrame, heads: Iterable[str], segments: DataFrame,
    negative: Iterable[str] = (), allowed: Column | None = None, min_share: float = 0.5,
) -> DataFrame:
    """M4: (key, phrase, product, segment, sub_segment, confidence) by phrase, else by head. Rows are
    read once: phrases and segments are joined to them."""
    ok = ~P.has_cue(text, negative)
    rows = df.filter(ok & allowed if allowed is not None else ok)
    rows = match_phrases(rows, key, text, phrases, keep=(code, text), how="left").join(phrases.drop("n_tokens"), "phrase", "left").join(segments, code, "left")
    rows = rows.withColumn("head", F.when(F.col("phrase").isNull(), _head(X.norm_phrase(text), heads)))
    by_head = _of_head(F.col("head"), min_share) | {"phrase": F.col("head"), "sub_segment": F.lit(""), "confidence": F.lit("low")}
    rows = rows.filter(F.col("phrase").isNotNull() | F.col("head").isNotNull())
    columns = ["phrase", "product", "segment", "sub_segment", "confidence"]
    return rows.select(key, *(F.when(F.col("head").isNotNull(), by_head[c]).otherwise(F.col(c)).alias(c) for c in columns))


def match_party(df: DataFrame, key: str, columns: Iterable[str], cores: DataFrame, exclude: Iterable[str] = (), allowed: Column | None = None) -> DataFrame:
    """M5: (key, core, maker): the longest core whose words stand in the party columns; a row with
    an exclusion cue has none."""
    blob = X.norm_party(X.row_text(*columns))
    rows = df.filter(allowed) if allowed is not None else df

    def find(texts):
        hits = occurrences(texts.filter(~P.has_cue("t", exclude)), cores, "core").join(cores.select("core", "canonical"), "core")
        best = hits.groupBy("id").agg(F.min(F.struct((-F.length("core")).alias("l"), "core", "canonical")).alias("b"))
        return best.select("id", "b.core", F.col("b.canonical").alias("maker"))

    return by_text(rows, key, blob, find)


def party_values(df: DataFrame, columns: Sequence[str], cores: DataFrame) -> dict[str, DataFrame]:
    """M5 by distinct value: what :func:`with_maker` needs to find the longest core in the columns of each row.

    By column the values that hold a core, with the best of them, or whose last words begin one (``open``),
    as it may go on in the next column. Only rows with such a value are judged as a whole, by their distinct
    combinations (under ``pairs``); the others' core is the best of their values'.
    """
    cores = staged(cores.select("core", "canonical"), "cores")
    split = F.split("core", " ")
    nodes = F.transform(F.sequence(F.lit(1), F.size(split) - 1), lambda k: F.array_join(F.slice(split, F.lit(1), k), " "))
    nodes = staged(cores.filter(F.size(split) > 1).select(F.explode(nodes).alias("_node")).distinct(), "core-beginnings")
    most, words, out, parted = max_words(cores, "core"), F.split("t", " "), {}, []
    for n, c in enumerate(columns):
        texts = staged(df.select(F.col(c).alias("id")).distinct().select("id", X.norm_party("id").alias("t")).filter("t <> ''"), "party")
        hits = occurrences(texts, cores, "core").join(small(cores), "core")
        found = hits.groupBy("id").agg(F.min(F.struct((-F.length("core")).alias("l"), "core", "canonical")).alias("best"))
        if n < len(columns) - 1 and most > 1:
            last = F.transform(F.sequence(F.lit(1), F.least(F.size(words), F.lit(most - 1))), lambda k: F.array_join(F.slice(words, -k, k), " "))
            begun = texts.select("id", F.explode(last).alias("_node")).join(small(nodes), "_node", "left_semi").select("id").distinct()
            found = found.join(begun.withColumn("open", F.lit(True)), "id", "full")
        else:
            found = found.withColumn("open", F.lit(None).cast("boolean"))
        out[c] = staged(found, "party-values")
        if not out[c].filter("open").isEmpty():
            parted.append(c)
    if parted:
        rows = with_ids(df.select(*columns), {"_party": columns})
        begun = None
        for c in parted:
            own = rows.join(small(staged(out[c].filter("open").select(F.col("id").alias(c)), "open")), c, "left_semi")
            begun = own if begun is None else begun.unionByName(own)
        out["pairs"] = staged(match_party(distinct_by(begun, "_party", columns, "_party"), "_party", columns, cores).select("_party", "maker"), "pairs")
    return out


def with_maker(df: DataFrame, columns: Sequence[str], values: Mapping[str, DataFrame], maker: str) -> DataFrame:
    """M5: ``df`` with ``maker``, that of the longest core in the columns (null if none), by :func:`party_values`."""
    out, best, open_ = df, [], F.lit(False)
    for n, c in enumerate(columns):
        out = out.join(small(values[c]).select(F.col("id").alias(f"_v{n}"), F.col("best").alias(f"_b{n}"), F.col("open").alias(f"_o{n}")), F.col(c) == F.col(f"_v{n}"), "left")
        best.append(F.col(f"_b{n}"))
        open_ = open_ | F.coalesce(f"_o{n}", F.lit(False))
    found = (F.least(*best) if len(best) > 1 else best[0])["canonical"]
    if "pairs" in values:
        whole = small(values["pairs"]).withColumnsRenamed({"_party": "_pair", "maker": "_whole"})
        out = with_ids(out, {"_own": columns}).join(whole, F.col("_own") == F.col("_pair"), "left")
        found = F.when(open_, F.col("_whole")).otherwise(found)
    return out.withColumn(maker, found).select(*df.columns, maker)


def cascade(df: DataFrame, key: str, family, category, maker, staged=lambda d: d) -> DataFrame:
    """M6: (key, tier, keyword, phrase, maker, ...): each tier is a function of the rows that no
    tier before it matched. ``family`` gives (key, keyword), ``category`` (key, phrase, product,
    segment, sub_segment, confidence), ``maker`` (key, maker). ``staged`` keeps a tier's matches and
    what it left, which are read several times."""
    one = staged(family(df))
    rest = staged(df.join(one.select(key), key, "left_anti"))
    two = staged(category(rest, one))
    three = maker(staged(rest.join(two.select(key), key, "left_anti")))
    tiers = [d.withColumn("tier", F.lit(t)) for t, d in (("family", one), ("category", two), ("manufacturer", three))]
    out = tiers[0].unionByName(tiers[1], allowMissingColumns=True).unionByName(tiers[2], allowMissingColumns=True)
    return out


def with_ids(df: DataFrame, ids: Mapping[str, Sequence[str]]) -> DataFrame:
    """``df`` with ids: a digest of 16 bytes of some columns under each name, nulls told from texts."""
    def part(c):
        return F.coalesce(F.concat(F.length(c).cast("string"), F.lit(":"), F.col(c).cast("string")), F.lit("-"))

    return df.withColumns({name: F.unhex(F.md5(F.concat(*map(part, columns)))) for name, columns in ids.items()})


def distinct_by(df: DataFrame, id_: str, columns: Sequence[str], key: str) -> DataFrame:
    """(key, columns, n): one row per id of :func:`with_ids`, and how many rows have it."""
    # The columns are keys too: kept by an aggregate, texts would make Spark sort all rows.
    return df.groupBy(F.col(id_).alias(key), *columns).agg(F.count("*").alias("n"))


def derive_maker(df: DataFrame, key: str, columns: Iterable[str], cores: DataFrame, maker: str) -> DataFrame:
    """M7: ``df`` with ``maker`` replaced by the one found in parties and description, if any."""
    found = match_party(df, key, columns, cores).select(key, F.col("maker").alias("_found"))
    return df.join(found, key, "left").withColumn(maker, F.coalesce("_found", maker)).drop("_found")


def phrase_hits(df: DataFrame, key: str, text: str, terms: DataFrame) -> DataFrame:
    """M8: (key, hits): all terms (term) in the text, sorted: single words whole, others anywhere, also
    where they begin or end within a word.

    Terms of several words join the texts on up to three characters on either side of their first
    space; what joins is checked.
    """
    terms = terms.select(X.norm_text("term").alias("term")).filter("term <> ''").distinct()
    single, several = (terms.filter(F.col("term").contains(" ") == x) for x in (False, True))
    parts = F.split("term", " ", 3)
    several = several.withColumns({"a": F.right(parts[0], F.lit(3)), "b": F.left(parts[1], F.lit(3))})
    several = several.select("term", F.concat_ws(" ", "a", "b").alias("gap"), F.length("a").alias("a"), F.length("b").alias("b"))
    sides = several.select("a", "b").distinct().collect()  # nine at most

    def find(texts):
        words = texts.select("id", F.explode(F.array_distinct(F.split("t", " "))).alias("term")).join(single, "term").select("id", "term")
        if sides:
            gaps = F.flatten(F.array(*(F.regexp_extract_all("t", F.lit(f"(?=([^ ]{{{r.a}}} [^ ]{{{r.b}}}))"), 1) for r in sides)))
            near = texts.select("id", F.explode(F.array_distinct(gaps)).alias("gap")).join(several.select("term", "gap"), "gap")
            near = near.join(texts, "id").filter(F.col("t").contains(F.col("term")))
            words = words.unionByName(near.select("id", "term"))
        return words.groupBy("id").agg(F.array_sort(F.collect_set("term")).alias("hits"))

    return by_text(df, key, X.norm_text(text), find)


def _shortened(word: str, twice: Column) -> Column:
    """The word without any one letter after its first, where ``twice`` holds without any two, and whole."""
    def without(w):
        return F.transform(F.sequence(F.lit(2), F.length(w)), lambda i: F.concat(F.left(w, i - 1), F.substr(w, i + 1)))

    once = without(F.col(word))
    two = F.when(twice, F.flatten(F.transform(once, without)))
    return F.array_distinct(F.concat(F.array(F.col(word)), once, F.coalesce(two, F.expr("cast(array() as array<string>)"))))


def fuzzy_match(
    df: DataFrame, key: str, text: str, names: DataFrame, blacklist: Iterable[str] = (), max_df_share: float = 0.002, min_df: int = 25, n_rows: int | None = None
) -> DataFrame:
    """M9: (key, token, name, distance, similarity): the best misspelt name in each text.

    Tokens are whole words of 6 to 18 letters, no parts of codes or longer words, that are rare enough,
    not a name and not blacklisted; a name of under ten letters may differ by one edit, a longer one by
    two, with the same first letter. Distinct tokens join the names on what is left of either after up to that many deletions, which two words
    within that many edits share; each row then looks its tokens up.
    """
    words = F.array_distinct(F.filter(F.split(X.norm_text(text), " "), lambda w: w.rlike("^[a-z]{6,18}$")))
    pairs = df.select(F.col(key), F.explode(words).alias("token"))
    n = df.count() if n_rows is None else n_rows
    seen = pairs.groupBy("token").agg(F.count("*").alias("df")).filter(F.col("df") <= max(min_df, int(max_df_share * n)))
    if list(blacklist):
        seen = seen.filter(~F.col("token").isin(*blacklist))
    names = names.select("name", F.length("name").alias("len")).distinct()
    seen = seen.join(names.select(F.col("name").alias("token")), "token", "left_anti")
    most = F.when(F.length("name") < 10, 1).otherwise(2)
    near = names.select("name", most.alias("most")).select("name", F.explode(_shortened("name", F.col("most") > 1)).alias("left"))
    pairs_of = seen.select("token", F.explode(_shortened("token", F.length("token") >= 8)).alias("left"))
    found = pairs_of.join(near, "left").select("token", "name").distinct().filter(F.left("token", F.lit(1)) == F.left("name", F.lit(1)))
    found = found.withColumn("distance", F.levenshtein("token", "name", 2)).filter((F.col("distance") >= 1) & (F.col("distance") <= most))
    best = found.groupBy("token").agg(F.min(F.struct("distance", "name")).alias("b"))
    hits = pairs.join(best, "token").groupBy(key).agg(F.min(F.struct("b.distance", "b.name", "token")).alias("h"))
    similarity = 1 - F.col("h.distance") / F.greatest(F.length("h.name"), F.length("h.token"))
    return hits.select(key, F.col("h.token").alias("token"), F.col("h.name").alias("name"), F.col("h.distance").alias("distance"), similarity.alias("similarity"))


def extract_features(df: DataFrame, key: str, text: str, classes: dict[str, DataFrame]) -> DataFrame:
    """(key, codes, <class> ...): model codes and the hits of each class of terms."""
    out = df.select(key, X.model_codes(text).alias("codes"))
    for name, terms in classes.items():
        hits = phrase_hits(df, key, text, terms).withColumnRenamed("hits", name)
        none = F.expr("cast(array() as array<string>)")
        out = out.join(hits, key, "left").withColumn(name, F.coalesce(name, none))
    return out


