"""Secrets in texts: fixed patterns, and a linear-chain conditional random field that adds spans.

A text is a row of tokens, each tagged as outside, begin or inside of a secret. The field's features are the shape of
a token (length, kinds of characters, how they mix), the words and shapes of its neighbours, and a few
of the whole file (how dense signs, lines and digits are). It learns from a bounded sample of windows around what the patterns
find: as they are, without their words, and with the secret swapped for random strings of other alphabets, so that
neither one key word nor one alphabet is all it knows; other windows, preferably at odd tokens, are what it must leave alone.

Decoding is Viterbi's and exact. A token whose margin for "outside" exceeds all that transitions could make up for is
outside on every best path, so only the runs between such tokens are decoded step by step.
"""

from __future__ import annotations

import random
import re
import string
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from limnocast.session import checkpointed

#: The base patterns, in the order in which spans with one start are listed.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
KEYWORDS = ("password", "passwd", "secret", "token", "api")
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
LEAST_VALUE = 6
#: Spans that the field adds.
ADDED = "crf"

#: Documents looked at for training, and windows of each kind that the field learns from, at most; chosen by hash.
TRAIN_DOCS, TRAIN_WINDOWS = 20_000, 1000
#: Tokens on either side of a window's middle, windows a document gives, longest word that is a feature, times it must occur.
REACH, WINDOWS_EACH, WORD_CHARS, WORD_TIMES = 12, 2, 24, 3
OUTSIDE, BEGIN, INSIDE = range(3)
#: Characters of a text whose tokens are held at a time, and tokens held with what they give.
BLOCK_CHARS, CACHE_TOKENS = 1 << 20, 300_000

TOKEN = re.compile(r"""\w+(?:[+/.~-]+\w+)*(?:={1,2}(?![\w"'=]))?|[^\w\s]""")
_SPACE = re.compile(r"\s")
_LENGTHS = (1, 2, 4, 6, 8, 12, 16, 20, 24, 32, 40, 48, 64, 128)
_SHARES = (0.0, 0.15, 0.35, 0.65, 0.999)


def _classes(fine: bool) -> bytes:
    table = bytearray(b"u" * 128 + b"U" * 128)
    for chars, low in ((string.digits, "0"), ("abcdef", "x"), (string.ascii_lowercase[6:], "a")):
        for c in chars:
            table[ord(c)] = ord(low if fine or low == "0" else "a")
    for chars, up in (("ABCDEF", "X"), (string.ascii_uppercase[6:], "A")):
        for c in chars:
            table[ord(c)] = ord(up if fine else "a")
    for c in "+/.~-_=":
        table[ord(c)] = ord("-")
    return bytes(table)


_FINE, _COARSE = _classes(True), _classes(False)


def base_spans(text: str) -> list[tuple[str, int, int, int]]:
    """``(kind, start, end, start of the secret itself)`` by the patterns, by start and then kind."""
    found = []
    lower = text.lower()
    # A text without the key words cannot match; that is quicker to see.
    if any(word in lower for word in KEYWORDS):
        for m in ASSIGN.finditer(text):
            if m.end(2) - m.start(2) >= LEAST_VALUE:
                found.append((m.start(), 0, m.end(), m.start(2)))
    if "AKIA" in text:
        found += [(m.start(), 1, m.end(), m.start()) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end(), m.start()) for m in HEX.finditer(text)]
    return [(KINDS[kind], start, end, secret) for start, kind, end, secret in sorted(found)]


def shape(token: str) -> tuple[int, ...]:
    """Length, kinds of characters, shares of digits and capitals, distinct characters, borders of letters and digits."""
    raw = token.encode("utf-8", "surrogatepass")
    fine, coarse, size = raw.translate(_FINE), raw.translate(_COARSE), len(raw)
    count = fine.count
    digits, hex_low, low, hex_up, up, joins = count(b"0"), count(b"x"), count(b"a"), count(b"X"), count(b"A"), count(b"-")
    other = size - digits - hex_low - low - hex_up - up - joins
    kinds = (digits > 0) + 2 * (hex_low + low > 0) + 4 * (hex_up + up > 0) + 8 * (joins > 0) + 16 * (other > 0)
    only_hex = 1 if digits + hex_low == size else 2 if digits + hex_up == size else 0
    borders = coarse.count(b"a0") + coarse.count(b"0a")
    return (
        bisect_right(_LENGTHS, len(token)), kinds, only_hex, bisect_right(_SHARES, digits / size),
        bisect_right(_SHARES, (hex_up + up) / size), min(len(set(raw)) // 3, 12), min(borders.bit_length(), 5),
    )


def word(token: str) -> str:
    return token.lower() if len(token) <= WORD_CHARS else ""


def file_shape(text: str) -> tuple[int, ...]:
    """Size, and how dense assignments, lines, quotes and brackets are."""
    size = max(1, len(text))
    per = [1000 * text.count(c) // size for c in ("=", "\n", '"', "{")]
    return (size.bit_length(), *(min(x, 255).bit_length() for x in per))


def _own(key: tuple[int, ...]) -> list[tuple]:
    size, kinds, only_hex, digits, ups, distinct, borders = key
    return [
        ("bias",), ("size", size), ("kinds", kinds), ("kinds", kinds, size), ("hex", only_hex, size), ("digits", digits, kinds),
        ("ups", ups, kinds), ("distinct", distinct), ("distinct", distinct, size), ("borders", borders), ("borders", borders, size),
    ]


def _beside(side: str, key: tuple[int, ...], text: str) -> list[tuple]:
    return [(side, text), (side, key[1], min(key[0], 6))] if text else [(side, key[1], min(key[0], 6))]


#: Where a token's neighbour stands, and the name of its features.
_SIDES = ((-1, "before"), (-2, "second before"), (1, "after"))


def features(keys: list[tuple[int, ...]], words: list[str], at: int, file: tuple[int, ...]) -> list[tuple]:
    """Names of all features of the token at ``at``."""
    out = [*_own(keys[at]), *(("file", i, x) for i, x in enumerate(file))]
    if words[at]:
        out.append(("word", words[at]))
    for step, side in _SIDES:
        if 0 <= at + step < len(keys):
            out += _beside(side, keys[at + step], words[at + step])
    return out


@dataclass(frozen=True)
class Window:
    keys: list[tuple[int, ...]]
    words: list[str]
    tags: list[int]
    file: tuple[int, ...]


def _tags(tokens: list[tuple[int, int]], spans: Iterable[tuple[int, int]]) -> list[int]:
    """Tags of tokens (start, end): of those that a span reaches the first begins."""
    tags = [OUTSIDE] * len(tokens)
    starts = [t[0] for t in tokens]
    for start, end in spans:
        at, tag = max(0, bisect_right(starts, start) - 1), BEGIN
        while at < len(tokens) and tokens[at][0] < end:
            if tokens[at][1] > start and tags[at] == OUTSIDE:
                tags[at], tag = tag, INSIDE
            at += 1
    return tags


def windows_of(text: str, seed: int) -> Iterator[tuple[bool, Window]]:
    """Windows at secrets, and one elsewhere; values of letters alone (a word after ``token:``) teach nothing."""
    spans = base_spans(text)
    found = [(m.start(), m.end()) for m in TOKEN.finditer(text)]
    if not found:
        return
    tags = _tags(found, ((secret, end) for *_, end, secret in spans))
    doubtful = _tags(found, ((start, end) for kind, start, end, secret in spans if kind == "assign" and text[secret:end].isalpha()))
    file, rng = file_shape(text), random.Random(seed)

    def window(middle: int) -> Window:
        part = slice(max(0, middle - REACH), middle + REACH + 1)
        tokens = [text[a:b] for a, b in found[part]]
        return Window([shape(t) for t in tokens], [word(t) for t in tokens], tags[part], file)

    secret = [i for i, tag in enumerate(tags) if tag == BEGIN and not doubtful[i]]
    for middle in secret[:WINDOWS_EACH]:
        yield True, window(middle)
    plain = [i for i, tag in enumerate(tags) if tag == OUTSIDE and not doubtful[i]]
    odd = [i for i in plain if found[i][1] - found[i][0] >= 10 or any(c.isdigit() for c in text[found[i][0] : found[i][1]])]
    picks = rng.sample(plain, min(1, len(plain))) + rng.sample(odd, min(1, len(odd)))
    for middle in picks:
        out = window(middle)
        if not any(out.tags):
            yield False, out


def _varied(windows: list[Window], rng: random.Random) -> Iterator[Window]:
    """The windows, the same without words, and secrets of other alphabets in their place."""
    alphabets = (string.ascii_letters + string.digits, string.ascii_letters + string.digits + "+/", string.digits + "ABCDEF",
                 string.ascii_lowercase + string.digits, string.ascii_letters + string.digits + "_-")
    for w in windows:
        yield w
        yield Window(w.keys, [""] * len(w.words), w.tags, w.file)
        if any(w.tags):
            token = "a" + "".join(rng.choices(rng.choice(alphabets), k=rng.randint(20, 64))) + "1"
            keys = [shape(token) if tag == BEGIN else key for key, tag in zip(w.keys, w.tags, strict=True)]
            words = ["" if tag else text for text, tag in zip(w.words, w.tags, strict=True)]
            yield Window(keys, words if rng.random() < 0.5 else [""] * len(words), w.tags, w.file)


@dataclass(frozen=True)
class Field:
    """``weights[feature]`` for begin and inside against outside; ``moves[from, to]`` between tags."""

    weights: dict[tuple, np.ndarray]
    moves: np.ndarray

    def score(self, names: Iterable[tuple]) -> np.ndarray:
        total = np.zeros(2)
        for name in names:
            if (w := self.weights.get(name)) is not None:
                total += w
        return total


def train(windows: list[Window], steps: int = 60, rate: float = 0.4, decay: float = 2e-4, seed: int = 5) -> Field:
    """Maximum likelihood by forward and backward sums over all windows at once, with AdaGrad steps."""
    windows = list(_varied(windows, random.Random(seed)))
    if not any(tag for w in windows for tag in w.tags):
        # Nothing to learn from: nothing is ever added.
        return Field({("bias",): np.array([-50.0, -50.0])}, np.zeros((3, 3)))
    times = Counter(text for w in windows for text, tag in zip(w.words, w.tags, strict=True) if text and not tag)
    known = {text for text, n in times.items() if n >= WORD_TIMES}
    number: dict[tuple, int] = {}
    length = max(len(w.keys) for w in windows)
    rows, columns = [], []
    tags = np.zeros((len(windows), length), np.int64)
    real = np.zeros((len(windows), length), bool)
    for i, w in enumerate(windows):
        words = [text if text in known else "" for text in w.words]
        tags[i, : len(w.tags)], real[i, : len(w.tags)] = w.tags, True
        for t in range(len(w.keys)):
            for name in features(w.keys, words, t, w.file):
                rows.append(i * length + t)
                columns.append(number.setdefault(name, len(number)))
    row, column = np.array(rows), np.array(columns)
    weights, moves = np.zeros((len(number), 2)), np.zeros((3, 3))
    squares = [np.full(weights.shape, 1e-8), np.full(moves.shape, 1e-8)]
    cells = len(windows) * length
    truth = np.stack([(tags == BEGIN) & real, (tags == INSIDE) & real], axis=-1).astype(float)
    # Before the first and after the last token of a window a tag is outside.
    for _ in range(steps):
        emit = np.zeros((cells, 3))
        for k in range(2):
            emit[:, k + 1] = np.bincount(row, weights[column, k], cells)
        emit = emit.reshape(len(windows), length, 3)
        forward, backward = np.zeros_like(emit), np.zeros_like(emit)
        forward[:, 0] = emit[:, 0] + moves[OUTSIDE]
        for t in range(1, length):
            step = np.logaddexp.reduce(forward[:, t - 1, :, None] + moves, axis=1) + emit[:, t]
            forward[:, t] = np.where(real[:, t, None], step, forward[:, t - 1])
        ends = np.logaddexp.reduce(forward[:, -1] + moves[:, OUTSIDE], axis=1)
        backward[:, -1] = moves[:, OUTSIDE]
        for t in range(length - 2, -1, -1):
            step = np.logaddexp.reduce(moves + (emit[:, t + 1] + backward[:, t + 1])[:, None, :], axis=2)
            backward[:, t] = np.where(real[:, t + 1, None], step, moves[:, OUTSIDE])
        share = np.exp(forward + backward - ends[:, None, None]) * real[:, :, None]
        wrong = (share[:, :, 1:] - truth).reshape(cells, 2)
        slope = np.stack([np.bincount(column, wrong[row, k], len(number)) for k in range(2)], axis=1) / len(windows)
        turn = np.zeros((3, 3))
        pairs = real[:, 1:]
        joint = forward[:, :-1, :, None] + moves + (emit[:, 1:] + backward[:, 1:])[:, :, None, :] - ends[:, None, None, None]
        turn += (np.exp(np.minimum(joint, 0)) * pairs[:, :, None, None]).sum(axis=(0, 1))
        np.subtract.at(turn, (tags[:, :-1][pairs], tags[:, 1:][pairs]), 1)
        last = real.sum(axis=1) - 1
        each = np.arange(len(windows))
        turn[OUTSIDE] += share[:, 0].sum(axis=0)
        turn[:, OUTSIDE] += share[each, last].sum(axis=0)
        np.subtract.at(turn, (np.full(len(windows), OUTSIDE), tags[:, 0]), 1)
        np.subtract.at(turn, (tags[each, last], np.full(len(windows), OUTSIDE)), 1)
        for value, gradient, square in ((weights, slope, squares[0]), (moves, turn / len(windows), squares[1])):
            gradient = gradient + decay * value
            square += gradient**2
            value -= rate * gradient / np.sqrt(square)
    return Field({name: weights[i].copy() for name, i in number.items()}, moves)


class Tagger:
    """A field with what each kind of token gives held in tables."""

    def __init__(self, field: Field):
        self.field = field
        self.words = {name[-1] for name in field.weights if isinstance(name[-1], str) and len(name) == 2}
        self.rows: dict[tuple, int] = {}
        self.table = np.zeros((0, 2 * (1 + len(_SIDES))))
        self.cache: dict[str, int] = {}
        self.older: dict[str, int] = {}
        moves = field.moves
        #: What transitions can at most gain by a tag in place of "outside", whatever stands around it.
        self.slack = np.array(
            [max(moves[p, y] + moves[y, n] - moves[p, 0] - moves[0, n] for p in range(3) for n in range(3)) for y in (1, 2)]
        )

    def _row(self, token: str) -> int:
        text = word(token)
        text = text if text in self.words else ""
        kind = (shape(token), text)
        if kind not in self.rows:
            key = kind[0]
            own = self.field.score([*_own(key), *([("word", text)] if text else [])])
            sides = [self.field.score(_beside(side, key, text)) for _, side in _SIDES]
            self.rows[kind] = len(self.rows)
            if len(self.rows) > len(self.table):
                self.table = np.concatenate([self.table, np.zeros((1 + len(self.table), self.table.shape[1]))])
            self.table[len(self.rows) - 1] = np.concatenate([own, *sides])
        return self.rows[kind]

    def _numbers(self, text: str) -> np.ndarray:
        """The table's row of every token."""
        out = []
        for block in _blocks(text):
            tokens = TOKEN.findall(block)
            found = np.fromiter((self.cache.get(t, -1) for t in tokens), np.int32, len(tokens))
            for i in np.flatnonzero(found < 0).tolist():
                token = tokens[i]
                row = self.cache.get(token)
                if row is None:
                    row = self.older.get(token)
                    row = self._row(token) if row is None else row
                    self.cache[token] = row
                found[i] = row
            if len(self.cache) > CACHE_TOKENS:
                self.older, self.cache = self.cache, {}
            out.append(found)
        return np.concatenate(out) if out else np.empty(0, np.int32)

    def tags(self, text: str) -> list[tuple[int, int]]:
        """``(first token, token after the last)`` of the spans on the best path."""
        rows = self._numbers(text)
        if not len(rows):
            return []
        emit = self.table[rows, :2] + self.field.score(("file", i, x) for i, x in enumerate(file_shape(text)))
        for k, (step, _) in enumerate(_SIDES, 1):
            part = self.table[rows, 2 * k : 2 * k + 2]
            if step < 0:
                emit[-step:] += part[:step]
            else:
                emit[:-step] += part[step:]
        maybe = np.flatnonzero((emit + self.slack >= 0).any(axis=1))
        spans: list[tuple[int, int]] = []
        for run in np.split(maybe, np.flatnonzero(np.diff(maybe) > 1) + 1) if len(maybe) else []:
            begin = int(run[0])
            best = self._viterbi(emit[begin : begin + len(run)].tolist())
            spans += [(begin + a, begin + b) for a, b in _spans(best)]
        return spans

    def _viterbi(self, emit: list[list[float]]) -> list[int]:
        """The best tags of a run between tokens that are outside; of equal paths the one with less inside."""
        moves = self.field.moves.tolist()
        best, back = [0.0, float("-inf"), float("-inf")], []
        for begin, inside in emit:
            own, steps, now = (0.0, begin, inside), [], []
            for to in range(3):
                score, tag = max((best[p] + moves[p][to], -p) for p in range(3))
                now.append(score + own[to])
                steps.append(-tag)
            best = now
            back.append(steps)
        tag = -max((best[p] + moves[p][OUTSIDE], -p) for p in range(3))[1]
        path = []
        for steps in reversed(back):
            path.append(tag)
            tag = steps[tag]
        return path[::-1]


def _spans(tags: list[int]) -> list[tuple[int, int]]:
    """A begin, or an inside after an outside, and the insides that follow."""
    out: list[tuple[int, int]] = []
    for i, tag in enumerate(tags):
        if tag == INSIDE and out and out[-1][1] == i:
            out[-1] = (out[-1][0], i + 1)
        elif tag != OUTSIDE:
            out.append((i, i + 1))
    return out


def _blocks(text: str) -> Iterator[str]:
    begin = 0
    while begin < len(text):
        gap = _SPACE.search(text, begin + BLOCK_CHARS)
        end = gap.start() if gap else len(text)
        yield text[begin:end]
        begin = end


def spans_of(text: str, tagger: Tagger) -> list[tuple[str, int, int]]:
    """``(kind, start, end)`` in code points: all that the patterns find, and what the field adds beside them."""
    base = [(kind, start, end) for kind, start, end, _ in base_spans(text)]
    added = tagger.tags(text)
    if added:
        ends = iter(TOKEN.finditer(text))
        at, found = 0, []
        for first, after in added:
            start = next(islice(ends, first - at, None)).span()
            end = start if after == first + 1 else next(islice(ends, after - first - 2, None)).span()
            at = after
            if not any(a < end[1] and start[0] < b for _, a, b in base):
                found.append((ADDED, start[0], end[1]))
        order = {kind: i for i, kind in enumerate((*KINDS, ADDED))}
        base = sorted([*base, *found], key=lambda s: (s[1], order[s[0]]))
    return base


def _field(docs: DataFrame, train_docs: int, train_windows: int) -> Field:
    """A field trained on a sample by hash of ``docs(id, body)``, and of its windows about so many of each kind."""
    hashed = docs.withColumn("hash", F.xxhash64("id", "body", F.lit(3)))
    share = min(1.0, train_docs / max(1, docs.count()))
    sample = hashed.where(F.pmod("hash", F.lit(1 << 20)) < round(share * (1 << 20)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.bool_(), pa.list_(pa.list_(pa.int32())), pa.list_(pa.string()), pa.list_(pa.int32()), pa.list_(pa.int32())]
        names = ["hash", "secret", "keys", "words", "tags", "file"]
        for batch in batches:
            rows = [
                (mark, secret, w.keys, w.words, w.tags, w.file)
                for mark, text in zip(batch["hash"].to_pylist(), batch["body"], strict=True)
                for secret, w in windows_of(text.as_py() or "", mark)
            ]
            columns = list(zip(*rows, strict=True)) or [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    schema = "hash long, secret boolean, keys array<array<int>>, words array<string>, tags array<int>, file array<int>"
    windows = checkpointed(sample.select("hash", "body").mapInArrow(run, schema))
    # Copies of a text give one window; the driver gets about ``train_windows`` rows of bounded size on either side.
    windows = windows.dropDuplicates(["hash", "secret", "words"])
    sizes = {r["secret"]: r["n"] for r in windows.groupBy("secret").agg(F.count("*").alias("n")).collect()}
    limit = {side: round(min(1.0, train_windows / n) * (1 << 20)) for side, n in sizes.items()}
    chance = F.pmod(F.xxhash64("hash", "words", F.lit(9)), F.lit(1 << 20))
    bound = F.when(F.col("secret"), limit.get(True, 0)).otherwise(limit.get(False, 0))
    picked = windows.where(chance < bound).collect()
    picked.sort(key=lambda r: (not r["secret"], r["hash"], r["words"], r["keys"]))
    return train([Window([tuple(k) for k in r["keys"]], r["words"], r["tags"], tuple(r["file"])) for r in picked])


def find_secrets(
    docs: DataFrame,
    train_docs: int = TRAIN_DOCS,
    train_windows: int = TRAIN_WINDOWS,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_masked: bool = False,
) -> DataFrame:
    """``(doc_id, secrets[, masked])`` for each row of ``docs``; ``secrets`` is an array of (kind, start, end).

    Starts and ends are code points, the end exclusive, in order of the start. Kinds ``assign``, ``access`` and ``hex`` are the
    whole matches of the patterns; ``crf`` are spans that the field adds where none of those lies. ``masked`` is the text
    with every span struck out. A null text counts as empty and has no spans. Repeated rows and null ids each
    give a row; an empty table gives an empty result; where the patterns find nothing in the sample, nothing is added.
    Other columns are not read.
    """
    narrow = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("body"))
    field = _field(narrow, train_docs, train_windows)
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = Tagger(field)
        for batch in batches:
            found, masked = [], []
            for text in batch["body"]:
                text = text.as_py() or ""
                spans = spans_of(text, tagger)
                found.append([dict(zip(("kind", "start", "end"), s, strict=True)) for s in spans])
                if with_masked:
                    masked.append(mask(text, spans))
            arrays, names = [batch["id"], pa.array(found, pa.list_(span))], ["id", "secrets"]
            if with_masked:
                arrays, names = [*arrays, pa.array(masked, pa.string())], [*names, "masked"]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    schema = "id long, secrets array<struct<kind: string, start: long, end: long>>" + (", masked string" if with_masked else "")
    return narrow.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def mask(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with the characters of all spans as asterisks."""
    parts, at = [], 0
    for _, start, end in spans:
        parts += [text[at : max(at, start)], "*" * max(0, end - max(at, start))]
        at = max(at, end)
    return "".join([*parts, text[at:]])
