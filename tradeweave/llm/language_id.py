"""Language identification by rank-order profiles.

A profile is the list of a language's most frequent character n-grams by rank; a document's own
list is compared with each profile by the out-of-place distance: the sum over the document's
n-grams of how far the ranks lie apart, with a fixed distance for n-grams that the profile lacks.
"""

from __future__ import annotations

import sys
import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .common import batch, numbered_names

#: N-grams of 1 to 3 characters; a code point takes 21 bits of a 64-bit code.
_BITS = 21


@lru_cache(None)
def _letters() -> np.ndarray:
    """For each code point 2 for a letter, 1 for a mark, which may combine with one, else 0."""
    kinds = np.frompyfunc(lambda c: " ML".find(unicodedata.category(chr(c))[0]), 1, 1)
    return np.maximum(0, kinds(np.arange(sys.maxunicode + 1)).astype(np.int8))


def ngrams(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """The codes of the n-grams of a text's words and their counts.

    Words are runs of letters in lower case with a space on either side; an n-gram lies in one word
    with its spaces. Marks belong to words, but a text without letters has none.
    """
    c = np.frombuffer((text or "").lower().encode("utf-32-le", "replace"), dtype="<u4").astype(np.int64)
    kind = _letters()[c] if len(c) else np.zeros(0, dtype=np.int8)
    if not (kind == 2).any():
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    ok = kind > 0
    c = np.where(ok, c, 32)
    c = np.concatenate([[32], c[ok | np.append(False, ok[:-1])], [32]])
    word = c != 32
    two = c[:-1] << _BITS | c[1:]
    three = (two[:-1] << _BITS | c[2:])[word[1:-1]]
    two = two[word[:-1] | word[1:]]
    return np.unique(np.concatenate([c[word], two, three]), return_counts=True)


def ranked(codes: np.ndarray, counts: np.ndarray, top: int) -> np.ndarray:
    """The codes of the ``top`` most frequent n-grams by rank; of equals, the smaller code first."""
    return codes[np.lexsort((codes, -counts))[:top]]


def train_profiles(docs: DataFrame, top: int = 300, flush: int = 200_000) -> dict[str, np.ndarray]:
    """The profile of each lang that has a text with letters, from all rows of ``docs``.

    Counts are summed in each task, then by Spark; only ``top`` n-grams a language reach the driver.
    """
    schema = pa.schema([("lang", pa.string()), ("code", pa.int64()), ("n", pa.int64())])

    def run(batches):
        sums: dict[str, dict[int, int]] = {}
        size = 0

        def out():
            for lang, d in sums.items():
                yield batch({"lang": [lang] * len(d), "code": list(d), "n": list(d.values())}, schema)

        for b in batches:
            parts: dict[str, list] = {}
            for lang, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                parts.setdefault(lang, []).append(ngrams(t))
            for lang, found in parts.items():
                codes, at = np.unique(np.concatenate([x for x, _ in found]), return_inverse=True)
                n = np.bincount(at, np.concatenate([x for _, x in found]), len(codes)).astype(np.int64)
                d = sums.setdefault(lang, {})
                size -= len(d)
                for c, k in zip(codes.tolist(), n.tolist()):
                    d[c] = d.get(c, 0) + k
                size += len(d)
            if size > flush:
                yield from out()
                sums, size = {}, 0
        yield from out()

    rows = docs.filter("lang is not null").select("lang", "text")
    counts = rows.mapInArrow(run, "lang string, code bigint, n bigint").groupBy("lang", "code").agg(
        F.sum("n").alias("n")
    )
    order = (F.desc("n"), F.asc("code"))
    part = F.pmod(F.hash("code"), F.lit(16))
    best = (
        counts.withColumn("part", part)
        .withColumn("r", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order)))
        .filter(F.col("r") <= top)
        .withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
        .filter(F.col("r") <= top)
    )
    found: dict[str, list] = {}
    for x in best.select("lang", "code", "r").orderBy("lang", "r").toLocalIterator():
        found.setdefault(x.lang, []).append(x.code)
    return {k: np.array(v, dtype=np.int64) for k, v in found.items()}


class Profiles:
    """Profiles of languages as sorted arrays, for lookups of many n-grams at once."""

    def __init__(self, profiles: dict[str, np.ndarray], top: int = 300):
        self.top, self.langs, self.sorted = top, sorted(profiles), []
        for lang in self.langs:
            at = np.argsort(profiles[lang], kind="stable")
            self.sorted.append((profiles[lang][at], at))

    def distances(self, codes: np.ndarray) -> list[int]:
        """The out-of-place distance of ranked n-grams to each profile, in the order of langs."""
        ranks, out = np.arange(len(codes)), []
        for keys, rank in self.sorted:
            at = np.minimum(np.searchsorted(keys, codes), len(keys) - 1)
            d = np.where(keys[at] == codes, np.abs(rank[at] - ranks), self.top)
            out.append(int(d.sum()))
        return out

    def predict(self, text: str | None) -> tuple[str, float]:
        """The language of least distance (the first by name of equals) and 1 - distance / most."""
        codes = ranked(*ngrams(text), self.top)
        if not len(codes) or not self.langs:
            return "und", 0.0
        d = self.distances(codes)
        best = min(range(len(d)), key=d.__getitem__)
        return self.langs[best], 1 - d[best] / (self.top * len(codes))


def held_out(doc_id):
    """Whether a document is kept from training: crc32 of its id as text is 2 modulo 4."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def predict(docs: DataFrame, profiles: dict[str, np.ndarray], top: int = 300) -> DataFrame:
    """``docs`` with all its columns, and lang_pred and score, which replace columns so named.

    A null text, one without letters, and every text if there are no profiles is ``und`` with score 0.
    Equal distances go to the first language by name. Texts of any length count as a whole; rows that
    repeat are judged each; an empty table gives no rows; columns may have any names and types.
    """
    sc = docs.sparkSession.sparkContext
    model = sc.broadcast(Profiles(profiles, top))  # at most ``top`` numbers a language
    docs = docs.drop("lang_pred", "score")
    names, at = docs.columns, docs.columns.index("text")
    rows = numbered_names(docs)

    def run(batches):
        for b in batches:
            done = [model.value.predict(t) for t in b.column(at).to_pylist()]
            new = [pa.array([x for x, _ in done], pa.string()), pa.array([x for _, x in done], pa.float64())]
            yield pa.RecordBatch.from_arrays([*b.columns, *new], names=[*b.schema.names, "lang_pred", "score"])

    schema = T.StructType([*rows.schema, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return rows.mapInArrow(run, schema).toDF(*names, "lang_pred", "score")


def identify(docs: DataFrame, top: int = 300) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred and score.

    Profiles come from the text and non-null lang of all documents that aren't held out. A null
    text or one without letters is ``und`` with score 0, and so is every text if no profile could
    be learned. Equal distances go to the first language by name. A null doc_id isn't held out.
    Texts of any length count as a whole. Rows that repeat are judged each; an empty table gives no
    rows; other columns are ignored.
    """
    profiles = train_profiles(docs.filter(~held_out("doc_id")), top)
    rows = docs.select("doc_id", held_out("doc_id").alias("held_out"), "text")
    return predict(rows, profiles, top).drop("text")
