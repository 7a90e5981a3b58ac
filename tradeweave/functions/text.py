"""Normal forms, tokens, numbers, codes and hashes as column expressions.

Null text counts as empty unless a function says otherwise. Everything is built from Spark's own
functions, so it runs inside generated code; only ``normalize_text`` needs Python, for Unicode
decomposition, and takes batches.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterable, Mapping

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def text(c: Column | str) -> Column:
    """Null as the empty text."""
    return F.coalesce(_col(c).cast("string"), F.lit(""))


def squeeze(c: Column) -> Column:
    """Runs of white space as one space, none at the ends."""
    return F.trim(F.regexp_replace(c, r"\s+", " "))


# Normal forms


def norm_exact(c: Column | str) -> Column:
    """White space collapsed and trimmed, in lower case."""
    return F.lower(squeeze(text(c)))


def norm_loose(c: Column | str) -> Column:
    """``norm_exact`` without trade marks and with separators folded into one space."""
    plain = F.regexp_replace(text(c), "[™®©]", "")
    return norm_exact(F.regexp_replace(plain, r"[_\-–—/\\]+", " "))


def norm_phrase(c: Column | str) -> Column:
    """Lower-case words of a-z and 0-9, each without its final ``s``."""
    low = F.regexp_replace(F.lower(text(c)), "[_/]", " ")
    return squeeze(F.regexp_replace(F.regexp_replace(low, r"s\b", ""), "[^a-z0-9 ]", " "))


def norm_party(c: Column | str) -> Column:
    """Lower-case words of a-z and 0-9; an ampersand parts words."""
    return squeeze(F.regexp_replace(F.lower(text(c)), "[^a-z0-9]+", " "))


def norm_text(c: Column | str) -> Column:
    """As ``norm_party``, with ``and`` for an ampersand."""
    return norm_party(F.regexp_replace(text(c), "&", " and "))


desc_key = norm_party  # N6: the form in which descriptions are joined


def _without_marks(t: str) -> str:
    """The text in compatibility decomposition without combining characters."""
    return t if t.isascii() else "".join(c for c in unicodedata.normalize("NFKD", t) if not unicodedata.combining(c))


@F.pandas_udf(StringType())
def _folded(s: pd.Series) -> pd.Series:
    plain = s.fillna("").map(_without_marks).astype("object")
    plain = plain.str.lower().str.replace("&", " and ", regex=False)
    return plain.str.replace(r"[^a-z0-9./+\-]+", " ", regex=True).str.strip()


def normalize_text(c: Column | str) -> Column:
    """Accents dropped, lower case, ``and`` for an ampersand; of signs, ``. / + -`` stay."""
    return _folded(_col(c))


def canon_sep(c: Column | str) -> Column:
    """One underscore for spaced bars and spaced hyphens, none beside spaces."""
    s = F.regexp_replace(text(c), r"\s*\|\s*", "_")
    s = F.regexp_replace(s, r"\s+[-–—]\s+", "_")
    return squeeze(F.regexp_replace(s, r"\s*_\s*", "_"))


def canon_tokens(c: Column | str) -> Column:
    """The sorted distinct words of a-z and 0-9: equal for labels that differ in order or signs."""
    words = F.split(F.lower(text(c)), "[^a-z0-9]+")
    return F.array_sort(F.array_distinct(F.filter(words, lambda w: w != "")))


# Tokens and features


def tokens(c: Column | str, min_len: int = 3, stop: Iterable[str] = ()) -> Column:
    """Distinct runs of a-z of at least ``min_len`` letters that are no stop words."""
    found = F.array_distinct(F.regexp_extract_all(F.lower(text(c)), F.lit(f"([a-z]{{{min_len},}})"), 1))
    stop = sorted(stop)
    return F.array_except(found, F.array(*map(F.lit, stop))) if stop else found


def sing(w: Column) -> Column:
    """A word without its final ``s`` if it has more than three letters."""
    return F.when((F.length(w) > 3) & w.endswith("s"), F.left(w, F.length(w) - 1)).otherwise(w)


def cue_tokens(c: Column | str) -> Column:
    """Distinct singular words of at least three letters."""
    found = F.regexp_extract_all(F.lower(text(c)), F.lit("([a-z]{3,})"), 1)
    return F.array_distinct(F.transform(found, sing))


def content_tokens(c: Column | str, stop: Iterable[str] = ()) -> Column:
    """Distinct words of ``desc_key`` of over two characters that are no stop words."""
    words = F.filter(F.split(desc_key(c), " "), lambda w: F.length(w) > 2)
    stop = sorted(stop)
    words = F.array_except(words, F.array(*map(F.lit, stop))) if stop else words
    return F.array_distinct(words)


def family_features(c: Column | str, stop: Iterable[str] = ()) -> Column:
    """Words, pairs of neighbouring words, and codes (``C_``): a list that keeps repetitions."""
    low = F.lower(text(c))
    stop = sorted(stop)
    words = F.regexp_extract_all(low, F.lit("([a-z]{3,})"), 1)
    if stop:
        words = F.filter(words, lambda w: ~w.isin(stop))
    pairs = F.when(
        F.size(words) > 1,
        F.zip_with(
            F.slice(words, 1, F.size(words) - 1), F.slice(words, 2, F.size(words) - 1),
            lambda a, b: F.concat(a, F.lit("_"), b),
        ),
    ).otherwise(F.expr("cast(array() as array<string>)"))
    mixed = F.filter(
        F.regexp_extract_all(low, F.lit("([a-z0-9]{3,})"), 1), lambda w: w.rlike("[a-z]") & w.rlike("[0-9]")
    )
    long = F.regexp_extract_all(low, F.lit("([0-9]{5,})"), 1)
    code = F.transform(F.concat(mixed, long), lambda w: F.concat(F.lit("C_"), w))
    return F.concat(words, pairs, code)


def char_ngrams(c: Column | str, n: int = 3) -> Column:
    """Distinct n-grams of the squeezed text; a text that is no longer than n is its own."""
    s = squeeze(text(c))
    # A look-ahead at each place: linear in the text, which substring by position isn't.
    grams = F.regexp_extract_all(s, F.lit(f"(?s)(?=(.{{{n}}}))"), 1)
    return F.when(F.length(s) <= n, F.filter(F.array(s), lambda x: x != "")).otherwise(F.array_distinct(grams))


# Codes and numbers


def hs8(c: Column | str) -> Column:
    """A code as the text of a whole number; ``<NA>`` if it is none."""
    n = _finite(_col(c).try_cast("double"))
    return F.coalesce(n.cast("bigint").cast("string"), F.lit("<NA>"))


def hs6(c: Column) -> Column:
    """The first six characters of a code that begins with a digit."""
    return F.when(c.rlike("^[0-9]"), F.substring(c, 1, 6)).otherwise(c)


def hs4(own: Column | str, code: Column | str) -> Column:
    """Four digits of the first column, else the first four digits of the code."""
    found = F.regexp_extract(text(own), "([0-9]{4})", 1)
    return F.when(found != "", found).otherwise(F.substring(F.regexp_replace(text(code), "[^0-9]", ""), 1, 4))


def _finite(n: Column) -> Column:
    return F.when(~F.isnan(n) & (F.abs(n) != float("inf")), n)


def number(c: Column | str) -> Column:
    """A number, or null where the text is none."""
    return _finite(F.trim(_col(c).cast("string")).try_cast("double"))


def safe_number(c: Column | str) -> Column:
    """A number, or 0."""
    return F.coalesce(number(c), F.lit(0.0))


def number_status(c: Column | str) -> Column:
    """(value, status): valid, missing (blank) or invalid; commas between thousands are dropped."""
    raw = F.trim(text(c))
    value = number(F.regexp_replace(raw, ",", ""))
    status = F.when(raw == "", "missing").when(value.isNull(), "invalid").otherwise("valid")
    return F.struct(value.alias("value"), status.alias("status"))


def truthy(c: Column | str) -> Column:
    return F.lower(F.trim(text(c))).isin("1", "true", "yes", "y")


def unit_price(value: Column, quantity: Column) -> Column:
    """Value by quantity where the quantity is positive."""
    return F.when(quantity > 0, value / quantity)


# Rows, keys, bands


def row_text(*columns: Column | str) -> Column:
    """The columns as one text, parted by spaces; nulls are empty."""
    return F.concat_ws(" ", *map(text, columns))


#: Texts that count as blank.
BLANK = ("", "nan", "none", "unspecified")


def is_blank(c: Column | str, blank: Iterable[str] = BLANK) -> Column:
    return F.lower(F.trim(text(c))).isin(*blank)


def blank_to(c: Column | str, label: str) -> Column:
    return F.when(text(c) == "", F.lit(label)).otherwise(_col(c))


def row_key(description: Column | str, code: Column | str, value: Column | str) -> Column:
    """Description key, code and value rounded half to even, joined by bars."""
    rounded = F.bround(number(value)).cast("bigint").cast("string")
    return F.concat_ws("|", desc_key(description), hs8(code), F.coalesce(rounded, F.lit("<NA>")))


def hash_bucket(key: Column | str, buckets: int = 1000) -> Column:
    """md5 of the key as a 128-bit number modulo ``buckets``, folded by four 32-bit parts."""
    digest, out = F.md5(text(key)), F.lit(0).cast("bigint")
    step = 2**32 % buckets
    for k in range(4):
        part = F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("bigint")
        out = (out * step + part) % buckets
    return out


def held_out(key: Column | str, share: float = 0.3) -> Column:
    """Whether a key belongs to the test split."""
    return hash_bucket(key) < int(share * 1000)


def source_hash(c: Column | str) -> Column:
    return F.sha2(text(c), 256)


#: Lower bounds and labels of value bands.
BANDS = {250_000: "P0 >=250K", 100_000: "P1 100K-250K", 50_000: "P2 50K-100K", 25_000: "P3 25K-50K"}


def value_band(value: Column, bands: Mapping[float, str] = BANDS) -> Column:
    out = F.lit("")
    for least in sorted(bands):
        out = F.when(value >= least, F.lit(bands[least])).otherwise(out)
    return out


def model_codes(c: Column | str, pattern: str = r"\b([a-z]{1,4}[0-9]{1,6})\b") -> Column:
    """The sorted distinct codes in a text."""
    return F.array_sort(F.array_distinct(F.regexp_extract_all(F.lower(text(c)), F.lit(pattern), 1)))


def alias_entries(c: Column | str) -> Column:
    """``a; b => x; c`` as an array of (term, target); a term without a target has ''."""
    parts = F.filter(F.transform(F.split(text(c), ";"), lambda p: F.trim(p)), lambda p: p != "")
    return F.transform(
        parts,
        lambda p: F.struct(
            F.trim(F.element_at(F.split(p, "=>"), 1)).alias("term"),
            F.trim(F.coalesce(F.try_element_at(F.split(p, "=>"), F.lit(2)), F.lit(""))).alias("target"),
        ),
    )


def target_id(*labels: Column | str) -> Column:
    """The labels in their exact normal form, joined by bars."""
    return F.concat_ws("|", *map(norm_exact, labels))


def target_list(c: Column | str) -> Column:
    """The list's name out of ``term_lists:name (note)``."""
    return F.regexp_extract(text(c), r"^term_lists:\s*([A-Za-z0-9_]+)", 1)
