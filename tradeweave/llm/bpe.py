"""BPE encoding and decoding with a memory-mapped transducer of frequent words.

The words of all documents are counted by Spark. The most frequent ones go with their ids into a
minimal acyclic automaton: words share prefixes and suffixes, and the number of words below each
arc gives a word its index into a table of ids. The file reaches each executor through Spark's
file distribution and is memory-mapped there. Words that it lacks are merged exactly.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import mmap
import re
import struct
import sys
import unicodedata
import uuid
from bisect import bisect_left
from collections import Counter
from functools import lru_cache

import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batch, dropped, most_frequent, saved, shared_path, write_file

#: Fixed values of the vocabulary file's pre-tokenizer: contractions that stand alone.
CONTRACTIONS = ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d")
#: White space as the normalizer's pattern has it.
SPACE = r"\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


_SHIFT, _NONE = 20, 1 << 60


@lru_cache(None)
def _word_pattern(most: int) -> re.Pattern:
    """The pre-tokenizer's pattern for texts of characters up to ``most``: letters, one number, a
    contraction, or other signs. Classes over fewer characters compile to faster tables."""
    found: dict[str, list[str]] = {"L": [], "N": []}
    start = kind = None
    for c in range(most + 2):
        now = unicodedata.category(chr(c))[0] if c <= most else None
        if now != kind:
            if kind in found:
                found[kind].append(f"\\U{start:08x}-\\U{c - 1:08x}")
            start, kind = c, now
    letters, numbers = "".join(found["L"]), "".join(found["N"])
    return re.compile(f"[{letters}]+|[{numbers}]|{'|'.join(CONTRACTIONS)}|[^{SPACE}{letters}{numbers}]+")


def byte_characters() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary: itself for
    visible Latin-1 characters, else the next free one from U+0100 on."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b) if b in visible else chr(next(rest)) for b in range(256)]


class WordBPE:
    """A tokenizer file of BPE with word ends: normalise, split, merge, decode."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.end: str = model["end_of_word_suffix"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.names = {i: t for t, i in self.vocab.items()} | {i: t for t, i in self.special.items()}
        self.first = [self.vocab[c] for c in byte_characters()]
        self.last = [self.vocab[c + self.end] for c in byte_characters()]
        #: The rank of the merge of two ids, by one number for both, and what each merge gives.
        self.rank: dict[int, int] = {}
        self.merged: list[int] = []
        for k, m in enumerate(model["merges"]):
            a, b = m if isinstance(m, list) else m.split(" ")
            self.merged.append(self.vocab[a + b])
            self.rank.setdefault(self.vocab[a] << _SHIFT | self.vocab[b], k)
        self._parts = re.compile("(" + "|".join(map(re.escape, self.special)) + ")")

    def words(self, text: str) -> list[str]:
        """The words to encode, in order; special tokens that the text holds stand as they are."""
        if not any(s in text for s in self.special):
            return self._split(text)
        out: list[str] = []
        for k, part in enumerate(self._parts.split(text)):
            out.extend([part] if k % 2 else self._split(part))
        return out

    def _split(self, text: str) -> list[str]:
        if text.isascii():
            return _word_pattern(0x7F).findall(text.lower())
        # Each capital is lower-cased by itself: a sigma that ends a word isn't treated apart.
        text = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
        plane_0 = len(text.encode("utf-16-le")) == 2 * len(text)
        return _word_pattern(0xFFFF if plane_0 else sys.maxunicode).findall(text)

    def merge(self, word: str) -> list[int]:
        """The ids of a word: the pair of least rank merges first, the leftmost of equals."""
        if word in self.special:
            return [self.special[word]]
        raw = word.encode()
        ids = [self.first[b] for b in raw]
        ids[-1] = self.last[raw[-1]]
        return (_merge_long if len(ids) > 200 else _merge_short)(ids, self.rank, self.merged)

    def decode(self, ids) -> str:
        """The text of ids as the file's decoder gives it: there is none, so tokens and spaces."""
        return " ".join([self.names[i] for i in ids])


def _merge_short(ids: list[int], rank: dict[int, int], merged: list[int]) -> list[int]:
    """Merges in place; the ranks of all neighbours are kept beside the ids."""
    get = rank.get
    ranks = [get(a << _SHIFT | b, _NONE) for a, b in zip(ids, ids[1:])]
    while ranks and (best := min(ranks)) != _NONE:
        k = ranks.index(best)
        ids[k] = merged[best]
        del ids[k + 1], ranks[k]
        if k:
            ranks[k - 1] = get(ids[k - 1] << _SHIFT | ids[k], _NONE)
        if k < len(ranks):
            ranks[k] = get(ids[k] << _SHIFT | ids[k + 1], _NONE)
    return ids


def _merge_long(ids: list[int], rank: dict[int, int], merged: list[int]) -> list[int]:
    """The same for long words: a heap of ranks over a doubly linked list."""
    n = len(ids)
    after, before = [*range(1, n), -1], list(range(-1, n - 1))
    heap = [(r, k) for k in range(n - 1) if (r := rank.get(ids[k] << _SHIFT | ids[k + 1])) is not None]
    heapq.heapify(heap)

    def of(k: int) -> int | None:
        return rank.get(ids[k] << _SHIFT | ids[after[k]]) if k >= 0 and ids[k] >= 0 and after[k] >= 0 else None

    while heap:
        r, k = heapq.heappop(heap)
        if of(k) != r:
            continue
        gone = after[k]
        ids[k], ids[gone] = merged[r], -1
        after[k] = after[gone]
        if after[k] >= 0:
            before[after[k]] = k
        for x in (before[k], k):
            if (new := of(x)) is not None:
                heapq.heappush(heap, (new, x))
    return [i for i in ids if i >= 0]


# --- the transducer ---------------------------------------------------------------------------


def compile_lexicon(entries: dict[bytes, list[int]]) -> bytes:
    """The minimal acyclic automaton of the words, with their ids: a flat array of 32-bit numbers.

    Words are added in sorted order; the states that a word can no longer change are replaced by
    equal ones met before, which shares suffixes. An arc is (label, target, words that sort before
    those through this arc); their sum along a path is the word's index.
    """
    register: dict[tuple, int] = {}
    states: list[tuple[bool, tuple[tuple[int, int], ...]]] = []
    path: list[list] = [[False, []]]  # of the last word: [final, [(label, state)]]

    def freeze(depth: int, last: bytes) -> None:
        while len(path) > depth + 1:
            final, arcs = path.pop()
            key = (final, tuple(arcs))
            at = register.get(key)
            if at is None:
                at = register[key] = len(states)
                states.append(key)
            path[-1][1].append((last[len(path) - 1], at))

    last, words = b"", sorted(entries)
    for w in words:
        common = next((k for k, (a, b) in enumerate(zip(w, last)) if a != b), min(len(w), len(last)))
        freeze(common, last)
        path.extend([False, []] for _ in w[common:])
        path[-1][0] = True
        last = w
    freeze(0, last)
    root, _ = len(states), states.append((path[0][0], tuple(path[0][1])))

    below = []
    for final, arcs in states:  # targets come first
        below.append(final + sum(below[t] for _, t in arcs))
    first, labels, targets, before = [], [], [], []
    for final, arcs in states:
        first.append(len(labels))
        n = int(final)
        for label, target in arcs:
            labels.append(label)
            targets.append(target)
            before.append(n)
            n += below[target]
    first.append(len(labels))
    ids, starts = [], [0]
    for w in words:
        ids += entries[w]
        starts.append(len(ids))
    finals = [int(f) for f, _ in states]
    parts = [first, finals, labels, targets, before, starts, ids]
    head = [root, *map(len, parts)]
    return struct.pack(f"<{len(head)}i", *head) + b"".join(struct.pack(f"<{len(p)}i", *p) for p in parts)


class Lexicon:
    """A compiled lexicon over a buffer, such as a memory-mapped file."""

    def __init__(self, buffer):
        numbers = memoryview(buffer).cast("i")
        self.root, *sizes = numbers[:8].tolist()
        views, at = [], 8
        for n in sizes:
            views.append(numbers[at : at + n])
            at += n
        self.first, self.final, self.labels, self.targets, self.before, self.starts, self.ids = views

    @classmethod
    def of_file(cls, path: str) -> Lexicon:
        with open(path, "rb") as f:
            return cls(mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ))

    def get(self, word: bytes) -> list[int] | None:
        """The ids of a word, or None."""
        s, index, first, labels = self.root, 0, self.first, self.labels
        for c in word:
            end = first[s + 1]
            a = bisect_left(labels, c, first[s], end)
            if a == end or labels[a] != c:
                return None
            s, index = self.targets[a], index + self.before[a]
        return self.ids[self.starts[index] : self.starts[index + 1]].tolist() if self.final[s] else None


# --- over documents ---------------------------------------------------------------------------

_state: dict = {}


def _tokenizer(path: str) -> WordBPE:
    """The tokenizer of this process; workers keep it from task to task."""
    if _state.get("path") != path:
        _state.clear()
        _state.update(path=path, bpe=WordBPE(path))
    return _state["bpe"]


def word_counts(docs: DataFrame, path: str, flush: int = 500_000) -> DataFrame:
    """(word, n) over all words of all texts. A task adds up what it sees before the shuffle."""

    def run(batches):
        bpe, counts = _tokenizer(path), Counter()
        schema = pa.schema([("word", pa.string()), ("n", pa.int64())])
        for b in batches:
            for t in b.column(0).to_pylist():
                counts.update(bpe.words(t))
                if len(counts) > flush:
                    yield batch({"word": list(counts), "n": list(counts.values())}, schema)
                    counts.clear()
        if counts:
            yield batch({"word": list(counts), "n": list(counts.values())}, schema)

    parts = docs.filter("length(text) > 0").select("text").mapInArrow(run, "word string, n bigint")
    return parts.groupBy("word").agg(F.sum("n").alias("n"))


def build_lexicon(docs: DataFrame, path: str, size: int = 50_000) -> str:
    """Compiles up to ``size`` most frequent words and gives the file to all executors; its name.

    Words that were seen once or have more than 100 characters aren't compiled but merged.
    """
    counts = saved(word_counts(docs, path).filter("n > 1 and length(word) <= 100"), "word-counts")
    top = most_frequent(counts, "n", size)
    bpe = WordBPE(path)
    words = [r.word for r in top.collect() if r.word not in bpe.special]  # at most ``size`` of bounded length
    dropped(counts)
    data = compile_lexicon({w.encode(): bpe.merge(w) for w in words})
    name = f"lexicon-{uuid.uuid4().hex}.bin"
    file = f"{shared_path(docs.sparkSession, 'lexicon')}/{name}"
    write_file(file, data)
    docs.sparkSession.sparkContext.addFile(file)  # executors fetch it from the shared folder
    return name


class Encoder:
    """Encodes words from the lexicon or by merging, and remembers those met last."""

    def __init__(self, path: str, lexicon: Lexicon, most: int = 400_000):
        self.bpe, self.lexicon, self.most = _tokenizer(path), lexicon, most
        self.decimal = {i: str(i) for i in self.bpe.names}
        self.ids: dict[str, str] = {}
        self.text: dict[str, str] = {}

    def encode(self, text: str) -> tuple[str, str]:
        """Ids of a text as decimal numbers and its decoded text, both joined by spaces."""
        words = self.bpe.words(text)
        try:
            return self._joined(words)
        except KeyError:
            if len(self.ids) > self.most:
                self.ids.clear()
                self.text.clear()
            for w in set(words).difference(self.ids):
                ids = self.lexicon.get(w.encode()) or self.bpe.merge(w)
                self.ids[w] = " ".join([self.decimal[i] for i in ids])
                self.text[w] = self.bpe.decode(ids)
            return self._joined(words)

    def _joined(self, words: list[str]) -> tuple[str, str]:
        return " ".join(map(self.ids.__getitem__, words)), " ".join(map(self.text.__getitem__, words))


def _encoder(path: str, name: str) -> Encoder:
    _tokenizer(path)
    if _state.get("lexicon") != name:
        _state.update(lexicon=name, encoder=Encoder(path, Lexicon.of_file(SparkFiles.get(name))))
    return _state["encoder"]


def encode(docs: DataFrame, path: str, lexicon_size: int = 50_000, digests: bool = False) -> DataFrame:
    """One row per document: doc_id, n_tokens and ids (array<int>), or digests of ids and text.

    The ids are those of the tokenizer file at ``path`` with the special tokens that the text
    itself holds and no others. A null or empty text has no tokens. ``digests`` gives ids_sha256
    (decimal ids joined by one space) and decoded_sha256 in place of ids. Rows that repeat are
    encoded each; texts of any length are encoded as a whole; other columns are ignored; an empty
    table gives no rows.
    """
    name = build_lexicon(docs, path, lexicon_size)
    rest = (
        [("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]
        if digests
        else [("ids", pa.list_(pa.int32()))]
    )

    def run(batches):
        encoder = _encoder(path, name)
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        for b in batches:
            schema = pa.schema([b.schema.field(0).with_name("doc_id"), ("n_tokens", pa.int64()), *rest])
            out = [encoder.encode(t) for t in b.column(1).to_pylist()]
            columns = {
                "doc_id": b.column(0),
                "n_tokens": [i.count(" ") + 1 if i else 0 for i, _ in out],
            }
            if digests:
                columns |= {"ids_sha256": [sha(i) for i, _ in out], "decoded_sha256": [sha(t) for _, t in out]}
            else:
                columns["ids"] = [list(map(int, i.split())) for i, _ in out]
            yield batch(columns, schema)

    kind = docs.schema["doc_id"].dataType.simpleString()
    tail = "ids_sha256 string, decoded_sha256 string" if digests else "ids array<int>"
    return docs.select(F.col("doc_id"), F.coalesce("text", F.lit("")).alias("t")).mapInArrow(
        run, f"doc_id {kind}, n_tokens bigint, {tail}"
    )


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``encoded`` (doc_id, ids) as doc_id and text; null or empty ids give the empty text.

    Rows that repeat are decoded each; other columns are ignored; an empty table gives no rows.
    """

    def run(batches):
        bpe = _tokenizer(path)
        for b in batches:
            schema = pa.schema([b.schema.field(0), ("text", pa.string())])
            yield batch(
                {b.schema.names[0]: b.column(0), "text": [bpe.decode(i or ()) for i in b.column(1).to_pylist()]},
                schema,
            )

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, text string")
