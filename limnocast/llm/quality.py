"""Quality of documents by gradient-boosted trees over statistics of their whole texts."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from limnocast.llm.boosting import Trees, fit

#: Labelled documents that trees are fitted on, about; with more, a sample by hash of the id.
TRAIN_ROWS = 20_000
KEEP_SCORE = 0.3
#: Bytes of text that are cut into words at a time.
BLOCK_BYTES = 1 << 22

_UPPER, _LOWER, _DIGIT, _SPACE, _STOP, _SIGN, _HIGH = range(7)
_CLASS = np.full(256, _SIGN)
_CLASS[128:] = _HIGH
for _kind, _text in (
    (_UPPER, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    (_LOWER, b"abcdefghijklmnopqrstuvwxyz"),
    (_DIGIT, b"0123456789"),
    (_SPACE, b" \t\n\v\f\r"),
    (_STOP, b".,;:?'\"()-"),
):
    _CLASS[list(_text)] = _kind

STATISTICS = (
    "log_bytes", "log_words", "word_bytes", "longest_word", "upper", "lower", "digit", "space", "stop", "sign", "high",
    "cased_upper", "commonest_sign", "sign_kinds", "words_with_sign", "words_with_digit", "upper_words", "capital_words",
    "distinct_words", "commonest_word", "repeats_in_a_row", "log_lines", "line_words", "distinct_lines", "commonest_line",
    "lines_with_stop",
)


def _share(part: float, whole: float) -> float:
    return part / whole if whole else 0.0


def _blocks(text: bytes) -> Iterator[bytes]:
    """The text a few megabytes at a time, cut at white space."""
    begin = 0
    while begin < len(text):
        end = begin + BLOCK_BYTES
        while end < len(text) and text[end] not in b" \t\n\v\f\r":
            end += 1
        yield text[begin:end]
        begin = end


def statistics(text: bytes | None) -> list[float]:
    """Numbers that describe a UTF-8 text, in the order of ``STATISTICS``; an empty text gives zeros."""
    text = text or b""
    codes = np.zeros(256, np.int64)
    words: Counter[bytes] = Counter()
    again, last = 0, None
    for block in _blocks(text):
        codes += np.bincount(np.frombuffer(block, np.uint8), minlength=256)
        part = block.split()
        words.update(part)
        again += sum(map(bytes.__eq__, part[1:], part)) + (bool(part) and part[0] == last)
        last = part[-1] if part else last
    kinds = np.bincount(_CLASS, codes, 7)
    size, number = len(text), sum(words.values())
    lines = Counter(x for x in map(bytes.strip, text.split(b"\n")) if x)
    signs = codes[_CLASS == _SIGN]
    with_sign = with_digit = upper = capital = 0
    for word, n in words.items():
        if not word.isalpha():
            bare = word.strip(b".,;:?'\"()-")
            if bare.isascii() and not bare.isalnum():
                with_sign += n
            with_digit += n * any(c in word for c in b"0123456789")
        if word.isupper():
            upper += n * (len(word) > 1)
        elif word.istitle():
            capital += n
    count = sum(lines.values())
    return [
        np.log1p(size),
        np.log1p(number),
        _share(size - kinds[_SPACE], number),
        np.log1p(max(map(len, words), default=0)),
        *(_share(kinds[k], size) for k in range(7)),
        _share(kinds[_UPPER], kinds[_UPPER] + kinds[_LOWER]),
        _share(signs.max(), size),
        float(np.count_nonzero(signs)),
        _share(with_sign, number),
        _share(with_digit, number),
        _share(upper, number),
        _share(capital, number),
        _share(len(words), number),
        _share(max(words.values(), default=0), number),
        _share(again, number),
        np.log1p(count),
        np.log1p(_share(number, count)),
        _share(len(lines), count),
        _share(max(lines.values(), default=0), count),
        _share(sum(n for x, n in lines.items() if x.endswith((b".", b"!", b"?"))), count),
    ]


def _table(texts: pa.ChunkedArray | pa.Array) -> np.ndarray:
    return np.array([statistics(x.as_py()) for x in texts], np.float64).reshape(-1, len(STATISTICS))


def _train(docs: DataFrame, labels: DataFrame, train_rows: int) -> Trees:
    """Trees fitted on about ``train_rows`` of the labelled ``docs(id, body)``, one row for each id chosen."""
    marks = labels.where("target is not null and id is not null").groupBy("id").agg(F.avg("target").alias("target"))
    share = min(1.0, train_rows / max(1, marks.count()))
    # One row for each id that the sample holds, so its size is bounded and it can go to every task.
    chosen = marks.where(F.pmod(F.xxhash64("id", F.lit(7)), F.lit(1 << 20)) < round(share * (1 << 20)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            stats = pa.array(_table(batch["body"]).tolist(), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch["id"], batch["target"], stats], names=["id", "target", "stats"])

    found = docs.join(F.broadcast(chosen), "id").groupBy("id").agg(
        F.min_by(F.struct("target", "body"), F.xxhash64("body")).alias("row")
    )
    found = found.select("id", "row.target", "row.body")
    rows = found.mapInArrow(run, "id long, target double, stats array<double>").collect()
    rows.sort(key=lambda r: (r["id"], r["stats"], r["target"]))
    stats = np.array([r["stats"] for r in rows], np.float64).reshape(-1, len(STATISTICS))
    return fit(stats, np.array([r["target"] for r in rows], np.float64))


def score_quality(
    docs: DataFrame,
    labels: DataFrame,
    train_rows: int = TRAIN_ROWS,
    keep_score: float = KEEP_SCORE,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    keep: tuple[str, ...] | None = None,
) -> DataFrame:
    """``(id, held_out, score, predicted)`` per row of ``docs``; with ``keep``, those columns of ``docs`` in place of the id.

    Trees learn from rows of ``labels(id, label)`` whose ``crc32(id as text) mod 5`` is not 0: a bounded sample, the
    mean of an id with several labels, and of rows that share an id the text of the least hash. A null label or id teaches nothing and a null id is not held out. A null
    text counts as empty, and an empty text has a score too. Every row is scored by its whole text and nothing
    else; repeated rows each get a row. With no labels every score is one half; empty ``docs`` give an empty result.
    """
    held = F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5 == 0, F.lit(False))
    known = docs.where(~held).select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("body"))
    marks = labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("double").alias("target"))
    marks = marks.where(F.crc32(F.col("id").cast("string")) % 5 != 0)
    trees = _train(known, marks, train_rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = pa.array(trees.score(_table(batch.column(batch.num_columns - 1))))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], scores], names=[*names, "c_score"])

    kept = (id_col,) if keep is None else keep
    # Positions stand in for names, so a column of any name can be kept.
    names = [f"c{i}" for i in range(len(kept) + 1)]
    held_back = docs.select(
        *(F.col(f"`{c}`").alias(n) for c, n in zip(kept, names, strict=False)),
        held.alias(names[-1]),
        F.col(text_col).cast("binary").alias("c_body"),
    )
    kinds = ", ".join(f"{n} {k}" for n, k in held_back.dtypes[:-1])
    out = held_back.mapInArrow(run, f"{kinds}, c_score double")
    return out.select(
        *(F.col(n).alias(c) for c, n in zip(kept, names, strict=False)),
        F.col(names[-1]).alias("held_out"),
        F.col("c_score").alias("score"),
        (F.col("c_score") >= keep_score).cast("int").alias("predicted"),
    )
