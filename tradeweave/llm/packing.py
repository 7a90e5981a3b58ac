"""Packing of token pieces into sequences of bounded length by best-two-fit.

Pieces of one length are alike, so what is packed is their histogram, which has at most ``max_tokens``
rows however many documents there are. A bin is filled greedily, longest first; then its smallest piece
gives way to the two unpacked ones that fit the widened gap most tightly, as long as that gains. The bin
so found is repeated as often as its lengths last. Spark counts the lengths, numbers the pieces of each
length without bringing them together, and gives every piece its place from the bins' ranges of numbers.
"""

from __future__ import annotations

import pickle
import zlib
from bisect import bisect_right
from collections import Counter
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .bpe import _SHIFT as PAIR_SHIFT
from .bpe import WordBPE
from .common import batch, read_file, saved, shared_path, write_file

#: The id that ends each document.
END = 1
#: No merge: a rank beyond all others.
_NONE = np.int32(2**31 - 1)


class _Ids:
    """The ids of texts as little-endian 32-bit numbers; the words met last are remembered with theirs."""

    def __init__(self, path: str, most: int = 400_000):
        self.bpe, self.most, self.known = WordBPE(path), most, {}
        self.first, self.last = np.array(self.bpe.first, np.int32), np.array(self.bpe.last, np.int32)
        ranks = self.bpe.rank
        keys = sorted(ranks)
        self.pairs, self.ranks = np.array(keys, np.int64), np.array([ranks[k] for k in keys], np.int32)
        self.merged = np.array(self.bpe.merged, np.int32)
        #: Ranks of two letters' merge; from 256 on, of a letter and one that ends the word.
        self.of_letters = self.rank_of(*np.broadcast_arrays(self.first[:, None], np.concatenate([self.first, self.last])))

    def of(self, texts: list[str]) -> list[bytes]:
        """The ids of each text. The words of all of them that aren't remembered are merged together."""
        words = [self.bpe.words(t) for t in texts]
        lacks = set().union(*words).difference(self.known)
        if len(self.known) + len(lacks) > self.most:
            self.known.clear()
            lacks = set().union(*words)
        self.learn(lacks)
        get = self.known.__getitem__
        return [b"".join(map(get, w)) for w in words]

    def learn(self, words: set[str]) -> None:
        shorter = [[], [], [], []]  # of up to 8, 16, 32 and 64 bytes: rows of a table have one width
        for w in words:
            n = len(w.encode())
            if n > 64 or w in self.bpe.special:
                self.known[w] = np.array(self.bpe.merge(w), "<u4").tobytes()
            else:
                shorter[0 if n <= 8 else 1 if n <= 16 else 2 if n <= 32 else 3].append(w)
        for some in shorter:
            for k in range(0, len(some), 20_000):
                part = some[k : k + 20_000]
                self.known.update(zip(part, self.merge_all(part)))

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of the merge of each pair, _NONE where there is none or no right one (-1)."""
        key = left.astype(np.int64) << PAIR_SHIFT | right
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        return np.where((self.pairs[at] == key) & (right >= 0), self.ranks[at], _NONE)

    def merge_all(self, words: list[str]) -> list[bytes]:
        """The ids of words of few bytes each, as :meth:`.bpe.WordBPE.merge` gives them, all at once: in each
        step every word does its merge of least rank, the leftmost of equals."""
        raw = [w.encode() for w in words]
        size = np.array([len(r) for r in raw])
        width, n = int(size.max()), len(raw)
        row, ends = np.repeat(np.arange(n), size), np.cumsum(size)
        column, letters = np.arange(ends[-1]) - np.repeat(ends - size, size), np.frombuffer(b"".join(raw), np.uint8)
        ids, ranks = np.full((n, width + 1), -1, np.int32), np.full((n, width + 1), _NONE, np.int32)
        second = letters.astype(np.int64)
        second[ends - 1] += 256
        inner = column > 0
        ids[row, column] = np.concatenate([self.first, self.last])[second]
        ranks[row[inner], column[inner] - 1] = self.of_letters[letters[:-1][inner[1:]], second[1:][inner[1:]]]
        live = np.arange(n)
        while len(live):
            best = ranks[live].argmin(axis=1)
            least = ranks[live, best]
            live, best, least = (x[least < _NONE] for x in (live, best, least))
            if not len(live):
                break
            ids[live, best] = self.merged[least]
            for table, gone in ((ids, best + 1), (ranks, best)):  # what follows moves up one place
                from_ = np.arange(width) + (np.arange(width) >= gone[:, None])
                table[live, :-1] = np.take_along_axis(table[live], from_, axis=1)
            ranks[live, best] = self.rank_of(ids[live, best], ids[live, best + 1])
            inner = best > 0
            r, k = live[inner], best[inner] - 1
            ranks[r, k] = self.rank_of(ids[r, k], ids[r, k + 1])
        kept = ids >= 0
        data, stops = ids[kept].astype("<u4").tobytes(), (np.cumsum(kept.sum(axis=1)) * 4).tolist()
        return [data[a:b] for a, b in zip([0, *stops], stops)]


@lru_cache(1)
def _ids(path: str) -> _Ids:
    return _Ids(path)


def tokenized_pieces(docs: DataFrame, path: str, max_tokens: int = 4096, end: int = END, keep_ids: bool = True) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, ids): the token ids of each text and ``end``.

    Texts of more ids are cut into pieces of ``max_tokens``, of which the last may be shorter; no other
    is cut. A null text counts as empty: its only id is ``end``. Rows that repeat are documents each, a
    null doc_id stays null, texts of any length are encoded as a whole, other columns are ignored, an
    empty table gives no rows. The ids are those of the tokenizer file at ``path``, as in :mod:`.bpe`, with
    the special tokens that the text itself holds and no others. Without ``keep_ids`` only their checksum (unsigned, of little-endian
    32-bit ids) is kept.
    """

    def run(batches):
        encode, last = _ids(path).of, np.array([end], "<u4").tobytes()
        for b in batches:
            out: dict[str, list] = {n: [] for n in ("at", "piece", "start", "length", "ids_crc32", "ids")}
            for k, ids in enumerate(encode(b.column(1).to_pylist())):
                ids += last
                for start in range(0, len(ids) // 4, max_tokens):
                    part = ids[4 * start : 4 * (start + max_tokens)]
                    row = (k, start // max_tokens, start, len(part) // 4, zlib.crc32(part), np.frombuffer(part, "<i4") if keep_ids else None)
                    for column, value in zip(out.values(), row):
                        column.append(value)
            key = b.column(0).take(pa.array(out.pop("at"), pa.int64()))
            fields = [("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("ids", pa.list_(pa.int32()))]
            rest = batch(out, pa.schema(fields if keep_ids else fields[:-1]))
            yield pa.RecordBatch.from_arrays([key, *rest.columns], names=["doc_id", *rest.schema.names])

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint" + (", ids array<int>" if keep_ids else "")
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("t")).mapInArrow(run, schema)


# --- bins of lengths ---------------------------------------------------------------------------


def _filled(counts: np.ndarray, gap: int) -> Counter:
    """Greedy: the longest unpacked length that fits, again and again."""
    lengths = np.flatnonzero(counts).tolist()
    found: Counter = Counter()
    while gap and (k := bisect_right(lengths, gap)):
        n = lengths[k - 1]
        times = min(gap // n, int(counts[n]))
        found[n] = times
        gap -= times * n
        del lengths[k - 1 :]
    return found


def _best_two(counts: np.ndarray, gap: int) -> tuple[int, int]:
    """Two unpacked lengths with the largest sum up to ``gap``, the first the longer one; (0, 0) if none."""
    have = np.flatnonzero(counts[:gap])
    if not len(have):
        return 0, 0
    at = np.searchsorted(have, gap - have, "right") - 1  # the longest partner of each
    lone = (at >= 0) & (have[at] == have) & (counts[have] == 1)
    at = np.where(lone, at - 1, at)
    sums = np.where(at >= 0, have + have[at], 0)
    best = int(sums.max())
    if not best:
        return 0, 0
    k = int(np.flatnonzero(sums == best)[-1])
    return int(have[k]), int(have[at[k]])


def best_two_fit(counts: np.ndarray, max_tokens: int) -> list[tuple[Counter, int]]:
    """Bins for ``counts[n]`` pieces of each length n: (how many of each length, how often).

    A round uses up what is left of at least one length, but for less than one bin's worth, so there are
    few rounds per length, whatever the counts.
    """
    counts, out = counts.copy(), []
    while counts.any():
        bin_ = _filled(counts, max_tokens)
        left = counts.copy()
        for n, times in bin_.items():
            left[n] -= times
        gap = max_tokens - sum(n * times for n, times in bin_.items())
        while gap:
            least = min(bin_)
            pair = _best_two(left, gap + least)
            if sum(pair) <= least:
                break
            bin_[least] -= 1
            left[least] += 1
            bin_ += Counter()  # drops zeros
            for n in pair:
                bin_[n] += 1
                left[n] -= 1
            gap += least - sum(pair)
        times = min(int(counts[n]) // k for n, k in bin_.items())
        for n, k in bin_.items():
            counts[n] -= k * times
        out.append((bin_, times))
    return out


def _places(bins: list[tuple[Counter, int]]) -> dict[str, np.ndarray]:
    """The numbers of each length that a bin takes, in order of length and first number: length, first,
    each (pieces of this length in the bin), sequence (of the first bin of its kind), offset."""
    rows, taken, sequence = [], Counter(), 0
    for bin_, times in bins:
        offset = 0
        for n in sorted(bin_, reverse=True):
            rows.append((n, taken[n], bin_[n], sequence, offset))
            taken[n] += bin_[n] * times
            offset += bin_[n] * n
        sequence += times
    rows.sort()
    table = np.array(rows, np.int64).reshape(-1, 5)
    return dict(zip(("length", "first", "each", "sequence", "offset"), table.T))


@lru_cache(1)
def _loaded(path: str) -> dict[str, np.ndarray]:
    return pickle.loads(read_file(path))


def pack(pieces: DataFrame, max_tokens: int = 4096) -> DataFrame:
    """``pieces`` with sequence_id and offset: as few sequences of at most ``max_tokens`` as it can.

    A piece has a ``length`` of 1 to ``max_tokens``. Places in a sequence follow each other without gaps
    from 0, longer pieces first. Pieces of equal length are interchangeable; which of them goes where
    depends on how Spark read them, the number of sequences and their lengths don't. All columns stay.
    An empty table gives no rows.
    """
    pieces = pieces.drop("sequence_id", "offset")
    names, at = pieces.columns, pieces.columns.index("length")
    own = pieces.toDF(*(f"c{k}" for k in range(len(names))))  # any name can go through Arrow so

    def number(batches):
        task, seen = TaskContext.get().partitionId(), Counter()
        for b in batches:
            nth = []
            for n in b.column(at).to_pylist():
                nth.append(seen[n])
                seen[n] += 1
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([task] * len(nth), pa.int64()), pa.array(nth, pa.int64())], names=[*b.schema.names, "_task", "_nth"])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in own.schema)
    rows = saved(own.mapInArrow(number, f"{fields}, _task bigint, _nth bigint"), "pieces")
    runs = saved(rows.groupBy(F.col(f"c{at}").alias("length"), "_task").agg(F.count("*").alias("n")), "lengths")
    counts = np.zeros(max_tokens + 1, np.int64)
    for r in runs.groupBy("length").agg(F.sum("n").alias("n")).collect():  # at most max_tokens rows
        counts[r.length] = r.n
    path = shared_path(pieces.sparkSession, "bins")
    write_file(path, pickle.dumps(_places(best_two_fit(counts, max_tokens))))

    before = F.sum("n").over(Window.partitionBy("length").orderBy("_task").rowsBetween(Window.unboundedPreceding, -1))
    runs = runs.select(F.col("length").alias("_length"), F.col("_task").alias("_of"), F.coalesce(before, F.lit(0)).alias("_before"))
    joined = rows.join(runs, (F.col(f"c{at}") == F.col("_length")) & (F.col("_task") == F.col("_of")))
    numbers = joined.select(*own.columns, (F.col("_before") + F.col("_nth")).alias("_n"))

    def place(batches):
        for b in batches:
            t = _loaded(path)
            length, n = b.column(at).to_numpy(), b.column(len(b.columns) - 1).to_numpy()
            # Ranges are sorted by length and first number; both fit one key, as no length has 2**48 pieces.
            k = np.searchsorted((t["length"] << 48) + t["first"], (length << 48) + n, "right") - 1
            within, each = n - t["first"][k], t["each"][k]
            sequence, offset = t["sequence"][k] + within // each, t["offset"][k] + within % each * length
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(sequence), pa.array(offset)], names=[*b.schema.names[:-1], "sequence_id", "offset"])

    return numbers.mapInArrow(place, f"{fields}, sequence_id bigint, offset bigint").toDF(*names, "sequence_id", "offset")


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids, doc_ids): the packed sequences themselves, from pieces that kept their ids."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids", "doc_id")))
    return packed.groupBy("sequence_id").agg(parts.alias("p")).select("sequence_id", F.flatten("p.ids").alias("ids"), F.col("p.doc_id").alias("doc_ids"))
