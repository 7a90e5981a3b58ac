"""Secret scans: fixed patterns, and a linear-chain conditional random field over tokens.

The field tags each token as the beginning, the inside or the outside of a secret, from the
token's shape, its neighbours and features of the whole file, and is decoded by Viterbi. It is
trained on windows of a bounded sample of documents in which the patterns mark secrets. So that
neither the few alphabets that the patterns know nor the words before a value explain all, each
secret comes again with its value drawn anew, and drawn anew in a place of plain text; paths, names,
addresses, dates and numbers come as no secrets. The cost of a beginning is calibrated on
windows that took no part in training.
"""

from __future__ import annotations

import math
import random
import re
import string
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batch

#: Kinds in order, their patterns and the least length of the group that counts.
KINDS = ("assign", "access", "hex")
PATTERNS = {
    "assign": (re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 2, 12),
    "access": (re.compile(r"AKIA[A-Z0-9]+"), 0, 18),
    "hex": (re.compile(r"[0-9a-f]{16,}"), 0, 16),
}
O, B, I = range(3)
_TOKEN = re.compile(r"[\w+/\-]+|[^\w\s]")


def base_spans(text: str) -> list[tuple[int, int, int, int]]:
    """(start, kind's number, end, start of the value) of all matches that are long enough."""
    out, low = [], text.lower()
    for k, kind in enumerate(KINDS):
        if kind == "assign" and not ("passw" in low or "secret" in low or "token" in low or "api" in low):
            continue  # no match is possible
        if kind == "access" and "AKIA" not in text:
            continue
        pattern, group, least = PATTERNS[kind]
        for m in pattern.finditer(text):
            if m.end(group) - m.start(group) >= least:
                out.append((m.start(), k, m.end(), m.start(group)))
    return sorted(out)


# --- features ---------------------------------------------------------------------------------

_HEX = re.compile(r"[0-9a-f]+")
_DIGIT = re.compile(r"\d")
_PARTS = re.compile(r"[-_/+]+")
_LETTERS = re.compile(r"[^\W\d_]+")
_STEPS = (4, 8, 12, 16, 24, 48)


def shape(token: str) -> tuple:
    """What a token's own features are made of: length, alphabet, case, digits, variety, changes
    between letters and digits, changes of case, the longest run of letters, entropy, the number of
    parts between signs, and whether one of them has letters and digits."""
    n = len(token)
    if n < 12 and token.islower() and token.isalpha():  # most words
        return n, "hex" if _HEX.fullmatch(token) else "word", "low", False, -1, -1, -1, -1, -1, 0, False
    alphabet = "hex" if _HEX.fullmatch(token) else "word" if token.isalpha() else "other"
    case = "low" if token.islower() else "up" if token.isupper() else "title" if token.istitle() else "mixed"
    if n < 12:
        return n, alphabet, case, bool(_DIGIT.search(token)), -1, -1, -1, -1, -1, 0, False
    pairs, counts = list(zip(token, token[1:])), [token.count(c) for c in set(token)]
    turns = sum(x.isdigit() != y.isdigit() for x, y in pairs)
    cases = sum(x.isalpha() and y.isalpha() and x.isupper() != y.isupper() for x, y in pairs)
    run = max(map(len, _LETTERS.findall(token)), default=0)
    parts = _PARTS.split(token)
    mixed = any(_DIGIT.search(x) and _LETTERS.search(x) for x in parts)
    entropy = sum(k * math.log2(n / k) for k in counts) / n
    return (
        max(x for x in _STEPS if x <= n), alphabet, case, 4 * len(_DIGIT.findall(token)) // n, 3 * len(counts) // min(n, 36),
        min(4, turns), min(4, 8 * cases // n), min(4, 4 * run // n), int(2 * entropy),
        min(4, len(parts)), mixed,
    )


def shape_features(s: tuple) -> list[str]:
    length, alphabet, case, digits, variety, turns, cases, run, entropy, parts, mixed = s
    long = length >= 12
    return [
        "bias",
        f"length {length}",
        f"alphabet {alphabet} {long}",
        f"case {case} {long}",
        f"digits {digits} {long}",
        f"variety {variety}",
        f"turns {turns} {cases}",
        f"run {run} {digits}",
        f"entropy {entropy}",
        f"parts {parts} {mixed}",
        f"all {alphabet} {case} {digits} {long}",
    ]


def word_features(token: str, where: str) -> tuple[str, str]:
    """A token as a neighbour: the word itself, if short, and its kind."""
    word = token.lower() if len(token) <= 10 else "?"
    return f"{where} {word}", f"{where} is {'alpha' if token.isalpha() else 'digit' if token.isdigit() else 'other'}"


def file_features(text: str, n_tokens: int) -> tuple[str, str]:
    """Features of the whole text."""
    lines = text.count("\n") + 1
    return (
        f"file tokens a line {min(8, (n_tokens // lines).bit_length())}",
        f"file assignments {min(4, text.count('=').bit_length())}",
    )


# --- the field --------------------------------------------------------------------------------


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


def train(windows: list[tuple[list[list[str]], list[int]]], steps: int = 80, l2: float = 1e-3):
    """Weights (by feature, one for each tag) and transitions (tags x tags) by gradient ascent on
    the likelihood.

    A window is the features of each token and its tags; before and after it stands an outside
    tag. Without windows every token is outside.
    """
    t = np.zeros((3, 3))
    if not windows:
        return {"bias": (1.0, 0.0, 0.0)}, t
    names = sorted({f for x, _ in windows for s in x for f in s})
    number = {f: k for k, f in enumerate(names)}
    longest = max(len(x) for x, _ in windows)
    most = max(len(s) for x, _ in windows for s in x)
    at = np.full((len(windows), longest, most), len(names), dtype=np.int64)  # the last: none
    tags = np.zeros((len(windows), longest + 2), dtype=np.int64)
    for i, (x, y) in enumerate(windows):
        for j, s in enumerate(x):
            at[i, j, : len(s)] = [number[f] for f in s]
        tags[i, 1 : len(y) + 1] = y
    n, eye = len(windows), np.eye(3)
    gold = eye[tags[:, 1:-1]]
    gold_t = np.einsum("nla,nlb->ab", eye[tags[:, :-1]], eye[tags[:, 1:]])
    u = np.zeros((len(names) + 1, 3))
    outside = (at == len(names)).all(axis=2)
    moments = [np.zeros_like(u), np.zeros_like(u), np.zeros_like(t), np.zeros_like(t)]
    for step in range(1, steps + 1):
        e = u[at].sum(axis=2)
        e[outside] = (50.0, 0.0, 0.0)  # behind the end of a short window
        a = np.zeros((n, longest, 3))
        b = np.zeros((n, longest, 3))
        a[:, 0] = e[:, 0] + t[O]
        for j in range(1, longest):
            a[:, j] = e[:, j] + _log_sum(a[:, j - 1, :, None] + t, 1)
        b[:, -1] = t[:, O]
        for j in range(longest - 2, -1, -1):
            b[:, j] = _log_sum(t + (e[:, j + 1] + b[:, j + 1])[:, None, :], 2)
        z = _log_sum(a[:, -1] + t[:, O], 1)
        p = np.exp(a + b - z[:, None, None])
        pair = np.exp(
            a[:, :-1, :, None] + t + (e[:, 1:] + b[:, 1:])[:, :, None, :] - z[:, None, None, None]
        ).sum(axis=(0, 1))
        pair[O] += p[:, 0].sum(axis=0)
        pair[:, O] += p[:, -1].sum(axis=0)
        d = (gold - p).reshape(-1, 3)
        gu = np.stack(
            [np.bincount(at.reshape(-1), np.repeat(d[:, k], most), len(u)) for k in range(3)], axis=1
        ) / n - l2 * u
        gu[-1] = 0
        gt = (gold_t - pair) / n - l2 * t
        for x, g, m, v in ((u, gu, *moments[:2]), (t, gt, *moments[2:])):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            x += 0.15 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        t[O, I] = min(t[O, I], -4.0)  # an inside needs a beginning
    return dict(zip(names, map(tuple, u.tolist()))), t


def viterbi(e: np.ndarray, t: np.ndarray) -> list[int]:
    """The best tags of a chain with an outside tag before and after it."""
    score, back = e[0] + t[O], []
    for row in e[1:]:
        s = score[:, None] + t
        back.append(s.argmax(axis=0))
        score = s.max(axis=0) + row
    tag = int((score + t[:, O]).argmax())
    out = [tag]
    for at in reversed(back):
        tag = int(at[tag])
        out.append(tag)
    return out[::-1]


def calibrated(weights: dict[str, tuple], t: np.ndarray, windows: list[tuple[list[list[str]], list[int]]], allowed: float = 0.01) -> np.ndarray:
    """Transitions whose way into a secret costs so much that of the windows without one at most the
    share ``allowed`` is tagged. Training has as many windows with a secret as without; texts haven't."""
    margins = []
    for x, tags in windows:
        if any(tags) or not x:
            continue
        e = np.array([[sum(weights[f][k] for f in s if f in weights) for k in range(3)] for s in x])
        score = e[0] + t[O]
        for row in e[1:]:
            score = (score[:, None] + t).max(axis=0) + row
        margins.append((score + t[:, O]).max() - e[:, O].sum() - (len(e) + 1) * t[O, O])
    t = t.copy()
    if margins:
        t[O, B:] -= max(0.0, float(np.quantile(margins, 1 - allowed, method="higher"))) + 1e-6
    return t


class Tagger:
    """The trained field, with the classes of the tokens that it has met.

    Tokens of one shape whose word is in no feature score alike: they share a row of the table.
    """

    def __init__(self, weights: dict[str, tuple], t: np.ndarray, most: int = 400_000):
        self.weights, self.t, self.most = weights, t, most
        self.gain = max(float(t[a, b] - t[O, O]) for a in range(3) for b in range(3) if a or b)
        self.words = {f.split(" ", 1)[1] for f in weights if f.startswith(("-1 ", "-2 ", "+1 ")) and " is " not in f} - {"?"}
        self.types: dict[str, int] = {}
        self.classes: dict[tuple, int] = {}
        self.table = np.zeros((0, 4, 3))

    def _sum(self, features) -> tuple[float, float, float]:
        rows = [self.weights[f] for f in features if f in self.weights]
        return (sum(r[0] for r in rows), sum(r[1] for r in rows), sum(r[2] for r in rows))

    def _class(self, token: str) -> int:
        s = shape(token)
        word = token.lower() if s[0] <= 10 else ""
        key = (s, token.isdigit(), word if word in self.words else s[0] <= 10)
        found = self.classes.get(key)
        if found is None:
            found = self.classes[key] = len(self.classes)
            row = [self._sum(shape_features(s)), *(self._sum(word_features(token, w)) for w in ("-1", "-2", "+1"))]
            self.table = np.concatenate([self.table, np.array([row])])
        return found

    def _codes(self, tokens: list[str]) -> np.ndarray:
        types = self.types
        try:
            return np.fromiter(map(types.__getitem__, tokens), dtype=np.int64, count=len(tokens))
        except KeyError:
            if len(types) > self.most:
                types.clear()
            for x in set(tokens).difference(types):
                types[x] = self._class(x)
            return np.fromiter(map(types.__getitem__, tokens), dtype=np.int64, count=len(tokens))

    def emissions(self, text: str, tokens: list[str]) -> np.ndarray:
        """Scores (tokens x tags)."""
        codes = self._codes(tokens)
        row = self.table[codes]
        e = row[:, 0].copy()
        e[1:] += row[:-1, 1]
        e[2:] += row[:-2, 2]
        e[:-1] += row[1:, 3]
        return e + self._sum(file_features(text, len(tokens)))

    def spans(self, text: str) -> list[tuple[int, int]]:
        """The secrets of a text by the best tags of all its tokens.

        A run of tokens of a secret gains at most the sum of ``a`` over its tokens and one
        transition over staying outside, so tokens in no run with a gain are outside for sure;
        what is left between them is decoded apart, with the same result as the whole chain.
        """
        tokens = _TOKEN.findall(text)
        if not tokens:
            return []
        e = self.emissions(text, tokens)
        a = e[:, 1:].max(axis=1) - e[:, O] + self.gain
        total = np.concatenate([[0.0], np.cumsum(a)])
        left = total[1:] - np.minimum.accumulate(total[:-1])
        right = np.maximum.accumulate(total[:0:-1])[::-1] - total[:-1]
        maybe = np.flatnonzero(left + right - a + max(0.0, self.gain) > -1e-6)
        if not len(maybe):
            return []
        runs = np.split(maybe, np.flatnonzero(np.diff(maybe) > 1) + 1)
        found = []
        for run in runs:
            tags = viterbi(e[run[0] : run[-1] + 1], self.t)
            for k, tag in enumerate(tags, int(run[0])):
                if tag == B or tag == I and not (found and found[-1][1] == k - 1):
                    found.append([k, k])
                elif tag == I:
                    found[-1][1] = k
        if not found:
            return []
        at = [m.span() for m in _TOKEN.finditer(text)]
        return [(at[x][0], at[y][1]) for x, y in found]


_DIGITS, _LETTER = string.digits, string.ascii_letters
#: Alphabets of values drawn anew.
_ALPHABETS = (
    _LETTER + _DIGITS, _LETTER + _DIGITS + "+/", _LETTER + _DIGITS + "-_", string.ascii_lowercase + _DIGITS, string.ascii_uppercase + _DIGITS,
    "0123456789ABCDEF", "0123456789abcdef",
)


def drawn_value(rng: random.Random) -> str:
    """A random string, now and then in parts as keys have them."""
    alphabet = rng.choice(_ALPHABETS)
    part = lambda n: "".join(rng.choices(alphabet, k=n))
    kind = rng.randrange(6)
    if kind == 0:
        return f"{''.join(rng.choices(string.ascii_lowercase, k=rng.randrange(2, 5)))}{rng.choice('-_')}{part(rng.randrange(16, 44))}"
    if kind == 1:
        return ".".join(part(rng.randrange(12, 40)) for _ in range(3))
    return part(rng.randrange(12, 50))


def plain_token(words: list[str], rng: random.Random) -> str:
    """A long string that is no secret: words as a path, a name with hyphens or underscores or in
    mixed case, an address, or short groups of digits as in dates and numbers."""
    picked, number = rng.choices(words, k=rng.randrange(2, 6)), lambda n: "".join(rng.choices(_DIGITS, k=n))
    kind = rng.randrange(4)
    if kind == 0:
        return "".join(w.title() for w in picked)
    if kind == 1:
        if rng.random() < 0.3:
            return f"20{number(2)}-{number(2)}-{number(2)}T{number(2)}:{number(2)}:{number(2)}Z"
        return rng.choice(["", "+"]) + rng.choice("-/.:+").join(number(rng.randrange(1, 8)) for _ in range(rng.randrange(2, 6)))
    if kind == 2:
        parts = [rng.choice([w, number(rng.randrange(1, 5)), f"{w}-{v}"]) for w, v in zip(picked, reversed(picked))]
        return f"{rng.choice(['http://', 'https://', 'www.', 'mailto:'])}{picked[0]}{rng.choice('.@')}{picked[1]}.{picked[0][:3]}/{'/'.join(parts)}"
    return rng.choice("-_/+").join([*picked, number(rng.randrange(1, 5))][: None if rng.random() < 0.3 else -1])


def windows_of(text: str, reach: int = 6, spare: int = 3) -> Iterator[tuple[bool, list, list]]:
    """Training windows of a text as (has a secret, features, tags).

    One stands around each secret that the patterns mark, two with its value drawn anew there
    and four with values in places of plain text. ``spare`` others of three kinds have none: around tokens with
    digits or of 12 characters, around words by steps, and around words joined to one token. What is
    drawn depends on the text alone.
    """
    at = [m.span() for m in _TOKEN.finditer(text)]
    if not at:
        return
    tokens, rng = [text[a:b] for a, b in at], random.Random(zlib.crc32(text.encode()))
    tags, secrets, end = [O] * len(at), [], -1
    for _, _, stop, start in base_spans(text):
        inside = [k for k, (a, b) in enumerate(at) if a < stop and b > start]
        if inside and inside[0] > end:
            end = inside[-1]
            tags[inside[0] : end + 1] = [B] + [I] * (len(inside) - 1)
            secrets.append((inside[0], end + 1))
    whole = file_features(text, len(tokens))

    def window(first: int, stop: int, value: list[str], labels: list[int]):
        """Around ``value`` in place of the tokens from ``first`` to ``stop``."""
        xs = [*tokens[max(0, first - reach - 2) : first], *value, *tokens[stop : stop + reach + 1]]
        ys = [*tags[max(0, first - reach - 2) : first], *labels, *tags[stop : stop + reach + 1]]
        before = min(first, reach + 2) - min(first, reach)
        features = []
        for j in range(before, min(len(xs), min(first, reach + 2) + len(value) + reach)):
            f = [*shape_features(shape(xs[j])), *whole]
            f += word_features(xs[j - 1], "-1") if j else ()
            f += word_features(xs[j - 2], "-2") if j > 1 else ()
            f += word_features(xs[j + 1], "+1") if j + 1 < len(xs) else ()
            features.append(f)
        ys = ys[before : before + len(features)]
        return any(ys), features, ys

    doubtful = {k for k, x in enumerate(tokens) if tags[k] == O and len(x) >= 12 and _DIGIT.search(x) and _LETTERS.search(x)}
    plain = [k for k in range(len(at)) if tags[k] == O and not doubtful.intersection(range(k - reach, k + reach + 1))]
    step = max(1, len(plain) // (spare + 1))
    for first, stop in secrets:
        yield window(first, stop, tokens[first:stop], tags[first:stop])
        places = [(k, k) for k in rng.choices(plain or [first], k=4)]
        for a, b in [(first, stop)] * 2 + places:
            value = _TOKEN.findall(drawn_value(rng))
            yield window(a, b, value, [B] + [I] * (len(value) - 1))
    odd = [k for k in plain if len(tokens[k]) >= 12 or any(c.isdigit() for c in tokens[k])]
    for k in [*odd[: 2 * spare], *plain[step::step][:spare]]:
        yield window(k, k + 1, [tokens[k]], [O])
    words = [tokens[k] for k in plain[:1000] if tokens[k].isalpha()]
    for k in rng.sample(plain, min(2 * spare, len(plain))) if words else ():
        value = _TOKEN.findall(plain_token(words, rng))
        yield window(k, k, value, [O] * len(value))


def sample_windows(docs: DataFrame, n_docs: int = 2_000, n_windows: int = 1_500) -> list:
    """At most ``n_windows`` windows with a secret, from about ``n_docs`` of the documents with a
    pattern's span, and as many without, from about ``n_docs`` of all; hashes of the texts decide."""
    texts = docs.select("text").filter(F.length("text") > 0)
    at = F.pmod(F.xxhash64("text"), F.lit(1 << 20))

    def marked(batches):
        for b in batches:
            hit = [any(True for _ in base_spans(t)) for t in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(1), pa.array(hit, pa.bool_())], names=["at", "hit"])

    places = texts.select("text", at.alias("at")).mapInArrow(marked, "at bigint, hit boolean")
    n = places.agg(F.count("*").alias("all"), F.count(F.when(F.col("hit"), 1)).alias("hit")).first()
    share, share_hit = (int(min(1.0, n_docs / max(1, x)) * (1 << 20)) + 1 for x in (n["all"], n["hit"]))
    drawn = texts.filter(at < max(share, share_hit)).select("text", (at < share).alias("plain"), (at < share_hit).alias("labelled"))

    schema = pa.schema([("secret", pa.bool_()), ("features", pa.list_(pa.list_(pa.string()))), ("tags", pa.list_(pa.int32()))])

    def run(batches):
        for b in batches:
            drawn_as = zip(*(b.column(k).to_pylist() for k in range(3)))
            rows = [
                x
                for t, plain, labelled in drawn_as
                if plain or any(True for _ in base_spans(t))
                for x in windows_of(t)
                if (labelled if x[0] else plain)
            ]
            yield batch({"secret": [x[0] for x in rows], "features": [x[1] for x in rows], "tags": [x[2] for x in rows]}, schema)

    all_windows = drawn.mapInArrow(run, "secret boolean, features array<array<string>>, tags array<int>")
    all_windows = all_windows.dropDuplicates().withColumn("h", F.xxhash64("features", "tags"))
    secret, other = (all_windows.filter(F.col("secret") == x).orderBy("h").limit(n_windows) for x in (True, False))
    rows = secret.unionByName(other).collect()  # bounded by n_windows
    rows.sort(key=lambda r: r.h)
    return [(r.features, r.tags) for r in rows] if any(r.secret for r in rows) else []


_SPANS = "doc_id {}, spans array<struct<kind:string,start:bigint,end:bigint>>"


def scan(docs: DataFrame, n_docs: int = 2_000, n_windows: int = 1_500, min_chars: int = 12) -> DataFrame:
    """One row per document: doc_id and spans (kind, start, end) in code points, end exclusive.

    Spans are those of the patterns, and ``crf`` for what the field tags beside them: at least
    ``min_chars`` characters that no pattern's span touches. They are in order of start, then kind.
    A null or empty text has none. A corpus without any pattern's span trains a field that tags
    nothing. Rows that repeat are scanned each; an empty table gives no rows; other columns are
    ignored.
    """
    spark = docs.sparkSession
    windows = sample_windows(docs, n_docs, n_windows)
    weights, t = train([w for k, w in enumerate(windows) if k % 5])
    model = spark.sparkContext.broadcast((weights, calibrated(weights, t, windows[::5])))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        tagger = Tagger(*model.value)
        for b in batches:
            spans = []
            for t in b.column(1).to_pylist():
                base = [(s, k, e) for s, k, e, _ in base_spans(t)]
                more = [
                    (s, len(KINDS), e)
                    for s, e in tagger.spans(t)
                    if e - s >= min_chars and all(e <= x or s >= y for x, _, y in base)
                ]
                spans.append(
                    [{"kind": (*KINDS, "crf")[k], "start": s, "end": e} for s, k, e in sorted(base + more)]
                )
            span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(spans, pa.list_(span))], names=["doc_id", "spans"])

    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("t")).mapInArrow(run, _SPANS.format(kind))
