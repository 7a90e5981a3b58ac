"""Benchmark decontamination with a generalised suffix automaton of the test items' words.

The automaton holds every run of words of every item. A document's words stream through it; the
length of the longest match that ends at each word tells which windows of items occur there. Spark
deals out the documents; the items, which are few, go to all tasks in automata of a checked size.
"""

from __future__ import annotations

import functools
import pickle
import re
import uuid
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import alnum_words, batch, numbered_names, read_file, shared_path, write_file

_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


class SuffixAutomaton:
    """All runs of the words of all items, with the windows marked where they end.

    An item of at least ``window`` words has a window at each run of ``window`` words; a shorter
    one is a window as a whole; one without words has none.
    """

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int):
        self.ids: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        coded = [(k, [self.ids.setdefault(w, len(self.ids)) for w in ws]) for k, ws in items if ws]
        for _, codes in coded:
            last = 0
            for c in codes:
                last = self._extend(last, c)
        marks: list[set[tuple[int, str]]] = [set() for _ in self.next]
        for k, codes in coded:
            w, s = min(window, len(codes)), 0
            for i, c in enumerate(codes):
                s = self.next[s][c]
                if i >= w - 1:
                    end = s
                    while self.length[self.link[end]] >= w:
                        end = self.link[end]
                    marks[end].add((w, k))
        self.marks = [sorted(m) for m in marks]
        #: The nearest state with marks on the way from a state to the root, itself included.
        self.marked = [-1] * len(self.next)
        for s in sorted(range(len(self.next)), key=self.length.__getitem__):
            up = self.marked[self.link[s]] if s else -1
            self.marked[s] = s if self.marks[s] else up
        self.least = min((min(window, len(c)) for _, c in coded), default=0)
        n = max(1, len(self.ids))
        self.pairs = np.array(
            sorted({a * n + b for _, c in coded for a, b in zip(c, c[1:])}), dtype=np.int64
        )

    def _state(self, length: int, link: int, out: dict[int, int]) -> int:
        self.next.append(out)
        self.link.append(link)
        self.length.append(length)
        return len(self.next) - 1

    def _split(self, p: int, c: int, q: int) -> int:
        """The state for the shorter runs of ``q``, those that end a run of ``p`` and ``c``."""
        clone = self._state(self.length[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = clone
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = clone
            p = self.link[p]
        return clone

    def _extend(self, last: int, c: int) -> int:
        q = self.next[last].get(c)
        if q is not None:
            return q if self.length[q] == self.length[last] + 1 else self._split(last, c, q)
        new, p = self._state(self.length[last] + 1, 0, {}), last
        while p >= 0 and c not in self.next[p]:
            self.next[p][c] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][c]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, c, q)
        return new

    def _runs(self, codes: np.ndarray) -> Iterator[tuple[int, int]]:
        """Runs of words that are long enough for a window and whose neighbours are neighbours in
        some item; no window lies outside of one."""
        if not len(codes) or not self.least:
            return
        good = codes >= 0
        joined = np.zeros(len(codes), dtype=bool)
        both = np.flatnonzero(good[1:] & good[:-1])
        if len(both) and len(self.pairs):
            pair = codes[both] * max(1, len(self.ids)) + codes[both + 1]
            at = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
            joined[both[self.pairs[at] == pair] + 1] = True
        starts = np.flatnonzero(good & ~joined)
        ends = np.flatnonzero(good & ~np.append(joined[1:], False)) + 1
        keep = ends - starts >= self.least
        yield from zip(starts[keep].tolist(), ends[keep].tolist())

    def scan(self, words: list[bytes]) -> tuple[list[int], set[str]]:
        """The positions of the words inside windows, ascending, and the keys of their items."""
        codes = np.fromiter(map(self.ids.get, words, repeat(-1)), dtype=np.int64, count=len(words))
        spans: list[tuple[int, int]] = []  # apart from each other, ascending
        found: set[str] = set()
        for start, end in self._runs(codes):
            s = n = 0
            for i, c in enumerate(codes[start:end].tolist(), start):
                while s and c not in self.next[s]:
                    s = self.link[s]
                    n = self.length[s]
                if c in self.next[s]:
                    s, n = self.next[s][c], n + 1
                most, m = 0, self.marked[s]
                while m >= 0:
                    for w, k in self.marks[m]:
                        if w <= n:
                            found.add(k)
                            most = max(most, w)
                    up = self.link[m]
                    m = self.marked[up] if up >= 0 else -1
                if most:
                    first = i - most + 1
                    while spans and spans[-1][1] >= first:  # a longer window may begin before
                        first = min(first, spans.pop()[0])
                    spans.append((first, i + 1))
        return [k for a, b in spans for k in range(a, b)], found


def _item_words(items: DataFrame) -> DataFrame:
    return items.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("k"),
        F.coalesce(F.col("text"), F.lit("")).alias("t"),
    )


def automata(items: DataFrame, window: int, max_words: int) -> list[str]:
    """Files, in the shared folder, of automata of at most ``max_words`` words each, or of one item,
    over all items. Tasks build them, each from its share of the items."""
    rows, folder = _item_words(items), shared_path(items.sparkSession, "automata")

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([len(alnum_words(t)) for t in b.column(1).to_pylist()], pa.int64())], names=["n"])

    total = rows.mapInArrow(sizes, "n bigint").agg(F.sum("n")).first()[0] or 0
    share = F.pmod(F.xxhash64("k", "t"), F.lit(max(1, -(-total // max_words))))

    def build(table):
        paths, part, n = [], [], 0

        def write():
            paths.append(f"{folder}/{uuid.uuid4().hex}")
            write_file(paths[-1], pickle.dumps(SuffixAutomaton(part, window), pickle.HIGHEST_PROTOCOL))

        for k, t in zip(table.column("k").to_pylist(), table.column("t").to_pylist()):
            words = alnum_words(t)
            if part and n + len(words) > max_words:
                write()
                part, n = [], 0
            part.append((k, words))
            n += len(words)
        write()
        return pa.table({"path": pa.array(paths, pa.string())})

    return sorted(r.path for r in rows.withColumn("p", share).groupBy("p").applyInArrow(build, "path string").collect())


@functools.lru_cache(1)
def _automaton(path: str) -> SuffixAutomaton:
    return pickle.loads(read_file(path))


def _scan_all(paths: list[str], texts: list[list[bytes]]) -> list[tuple[list[int], set[str]]]:
    """What :meth:`SuffixAutomaton.scan` gives for each of ``texts``, united over all automata."""
    hits: list[set[int]] = [set() for _ in texts]
    found: list[set[str]] = [set() for _ in texts]
    for path in paths:
        automaton = _automaton(path)
        for k, words in enumerate(texts):
            h, f = automaton.scan(words)
            hits[k].update(h)
            found[k] |= f
    return [(sorted(h), f) for h, f in zip(hits, found)]


def _gathered(batches, paths: list[str], size: int = 1 << 24) -> Iterator[list[pa.RecordBatch]]:
    """Batches one by one, or some together where each automaton must be read for them."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        held.append(b)
        if len(paths) < 2 or sum(x.nbytes for x in held) >= size:
            yield held
            held = []
    if held:
        yield held


_HITS = pa.schema(
    [("hits", pa.list_(pa.int64())), ("items", pa.list_(pa.string())), ("n_words", pa.int64())]
)


def _hits(docs: DataFrame, paths: list[str]) -> DataFrame:
    """``docs`` (id, t) with n_words, hits and items of all automata, without t."""

    def run(batches):
        for held in _gathered(batches, paths):
            for b in pa.Table.from_batches(held).combine_chunks().to_batches():
                words = [alnum_words(t) for t in b.column(1).to_pylist()]
                done = _scan_all(paths, words)
                new = batch(
                    {
                        "hits": [h for h, _ in done],
                        "items": [sorted(k) for _, k in done],
                        "n_words": [len(w) for w in words],
                    },
                    _HITS,
                )
                yield pa.RecordBatch.from_arrays([b.column(0), *new.columns], names=["id", *_HITS.names])

    kind = docs.schema["id"].dataType.simpleString()
    return docs.select("id", "t").mapInArrow(
        run, f"id {kind}, hits array<bigint>, items array<string>, n_words bigint"
    )


def find_contamination(
    docs: DataFrame, items: DataFrame, window: int = 10, max_words: int = 500_000
) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items, contaminated.

    Words are runs of digits, a-z (A-Z is lower-cased) and characters beyond ASCII. A null or empty
    text has no words and no hits; a null item text is no window; a null item_id is the key ''.
    Equal item_ids count once. Items beyond ``max_words`` words go to further automata, whose hits
    are united. Texts of any length count as a whole, and rows that repeat are judged each. Without
    items nothing is hit; an empty table gives no rows. Other columns are ignored.
    """
    rows = docs.select(F.col("doc_id").alias("id"), F.coalesce("text", F.lit("")).alias("t"))
    found = _hits(rows, automata(items, window, max_words))
    none_hit, none_item = F.expr("cast(array() as array<bigint>)"), F.expr("cast(array() as array<string>)")
    return found.select(
        F.col("id").alias("doc_id"),
        "n_words",
        F.size(F.coalesce("hits", none_hit)).cast("long").alias("n_hit"),
        F.size(F.coalesce("items", none_item)).cast("long").alias("n_items"),
        F.array_sort(F.coalesce("items", none_item)).alias("items"),
        (F.size(F.coalesce("hits", none_hit)) > 0).alias("contaminated"),
    )


def _without(raw: bytes, spans: list[tuple[int, int]], hits: list[int]) -> bytes:
    """The text without the words at ``hits`` of ``spans``. A run of hits goes from its first word to
    its last, with what stands between."""
    out, at = [], 0
    for k, h in enumerate(hits):
        if not k or hits[k - 1] != h - 1:
            out.append(raw[at : spans[h][0]])
        at = spans[h][1]
    return b"".join([*out, raw[at:]])


def cut_all(paths: list[str], texts: list[str | None]) -> list[tuple[str | None, int, int]]:
    """Each text without the words that any automaton hits, how many those are, and of how many words.

    The hits of all automata unite before a cut; cutting repeats over all of them until no window
    is left, since the two sides of a cut may form one.
    """
    out: list[tuple[str | None, int, int]] = [(t, 0, 0) for t in texts]
    left = [k for k, t in enumerate(texts) if t]
    while left:
        words = [alnum_words(out[k][0]) for k in left]
        again = []
        for k, w, (hits, _) in zip(left, words, _scan_all(paths, words)):
            text, removed, total = out[k]
            if hits:
                raw = text.encode()
                text = _without(raw, [m.span() for m in _WORD.finditer(raw)], hits).decode()
                again.append(k)
            out[k] = text, removed + len(hits), total or len(w)
        left = again
    return out


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    window: int = 10,
    max_coverage: float = 0.5,
    max_words: int = 500_000,
) -> DataFrame:
    """``docs`` with all its columns, without the spans of item words in its texts.

    A document goes as a whole when more than ``max_coverage`` of its words were inside windows.
    Columns may have any names and types. Both count the hits of all automata, to which items beyond ``max_words`` words go.
    Documents without hits, null and empty texts stay as they are; without items all do. Texts of any
    length count as a whole, rows that repeat are judged each, an empty table gives no rows. n_chars,
    where there is such a column, follows a changed text; other columns stay as they are.
    """
    names, rows = docs.columns, numbered_names(docs)
    at, paths = names.index("text"), automata(items, window, max_words)

    def run(batches):
        for held in _gathered(batches, paths):
            done = iter(cut_all(paths, [t for b in held for t in b.column(at).to_pylist()]))
            for b in held:
                rows = [next(done) for _ in range(b.num_rows)]
                columns = list(b.columns)
                columns[at] = pa.array([t for t, _, _ in rows], type=columns[at].type)
                keep = pa.array([removed <= max_coverage * total for _, removed, total in rows], pa.bool_())
                yield pa.RecordBatch.from_arrays(columns, schema=b.schema).filter(keep)

    out = rows.mapInArrow(run, rows.schema).toDF(*names)
    if "n_chars" in names:
        out = out.withColumn(
            "n_chars",
            F.when(F.col("n_chars").isNotNull(), F.length("text").cast(docs.schema["n_chars"].dataType)),
        )
    return out


