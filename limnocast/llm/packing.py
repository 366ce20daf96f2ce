"""Best-fit packing of documents into sequences, certified by lower bounds.

Pieces are dealt into groups of a bounded number of tokens, each packed best-fit
decreasing. Dual-feasible functions bound how few sequences a group can need; a group that
meets its bound is done. The others exchange their pieces: they are dealt anew among themselves
and packed again, as long as that saves sequences. At last the emptiest sequences of all groups
are packed anew together while the bound of the whole corpus is not met.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from limnocast.llm.word_tokens import tokens_of
from limnocast.session import checkpointed

CAPACITY = 2048
#: Tokens dealt to one packing task.
GROUP_TOKENS = 2_000_000
#: Exchanges among groups that miss their bound.
ROUNDS = 3
END_ID = 0


def pieces(
    docs: DataFrame,
    tokenizer: str,
    capacity: int = CAPACITY,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32[, ids])``: each document's ids and a final 0, cut at ``capacity``.

    A null text is an empty one: a single 0. Each row of ``docs`` gives pieces, repeated
    rows included. The checksum is over the ids as little-endian unsigned 32-bit words.
    """
    names = ["id", "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokens_of(tokenizer).ids_of
        end = END_ID.to_bytes(4, "little")
        for batch in batches:
            rows: list[tuple] = []
            for key, ids in zip(batch["id"].to_pylist(), encode(batch["body"].to_pylist()), strict=True):
                ids += end
                for n, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    row = (key, n, at // 4, len(part) // 4, zlib.crc32(part))
                    rows.append((*row, np.frombuffer(part, "<u4").tolist()) if with_ids else row)
            columns = list(zip(*rows, strict=True)) or [[]] * len(names)
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64())]
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=False)]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    narrow = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("body"))
    schema = "id long, piece int, start long, length long, ids_crc32 long" + (", ids array<long>" if with_ids else "")
    return narrow.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def lower_bound(counts: np.ndarray) -> int:
    """Fewest bins of size ``len(counts) - 1`` for ``counts[x]`` items of each size ``x``.

    The best of two families of dual-feasible functions: one rounds items beyond ``C - k`` up to a
    bin and drops those below ``k``; the other rounds sizes to multiples of ``C / k``.
    """
    capacity = len(counts) - 1
    sizes = np.arange(capacity + 1)
    number = np.cumsum(counts)
    volume = np.cumsum(counts * sizes)
    k = np.arange(1, capacity // 2 + 1)
    large = number[capacity] - number[capacity - k]
    middle = volume[capacity - k] - volume[k - 1]
    best = max(int(-(-volume[capacity] // capacity)), int((large - -(-middle // capacity)).max(initial=0)))
    for k in range(1, 33):
        scaled = sizes * (k + 1)
        exact = scaled % capacity == 0
        # In units of 1 / (k * C), so that all stays whole.
        value = np.where(exact, sizes * k, scaled // capacity * capacity)
        best = max(best, int(-(-(counts * value).sum() // (k * capacity))))
    return best


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each item, packed best-fit decreasing."""
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0  # bit r is set if a bin with room r is open
    used = 0
    for item in np.argsort(-lengths, kind="stable").tolist():
        length = int(lengths[item])
        fits = rooms >> length
        if fits:
            room = length + (fits & -fits).bit_length() - 1
            place = open_bins[room].pop()
            if not open_bins[room]:
                rooms ^= 1 << room
        else:
            room, place, used = capacity, used, used + 1
        bins[item], offsets[item] = place, capacity - room
        left = room - length
        if left:
            open_bins[left].append(place)
            rooms |= 1 << left
    return bins, offsets


def _packed(dealt: DataFrame, capacity: int) -> DataFrame:
    """``dealt(key, length, part)`` with ``bin``, ``offset``, ``fill`` and the part's ``gap`` above its bound."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("key", kind="stable")
        lengths = group["length"].to_numpy()
        bins, offsets = best_fit(lengths, capacity)
        fills = np.bincount(bins, weights=lengths).astype(np.int64)
        gap = len(fills) - lower_bound(np.bincount(lengths, minlength=capacity + 1))
        return group.assign(bin=bins, offset=offsets, fill=fills[bins], gap=gap)

    schema = "key long, length long, part long, bin long, offset long, fill long, gap long"
    return dealt.select("key", "length", "part").groupBy("part").applyInPandas(run, schema)


def _dealt(rows: DataFrame, tokens: int, group_tokens: int, first_part: int, salt: int) -> DataFrame:
    """Rows spread over parts of about ``group_tokens``, numbered from ``first_part``."""
    parts = max(1, -(-tokens // group_tokens))
    return rows.withColumn("part", F.pmod(F.xxhash64("key", F.lit(salt)), F.lit(parts)) + first_part)


def _number(packed: DataFrame) -> int:
    return packed.where("offset = 0").count()


def pack(
    cut: DataFrame, capacity: int = CAPACITY, group_tokens: int = GROUP_TOKENS, rounds: int = ROUNDS
) -> DataFrame:
    """``cut`` with ``sequence_id`` and ``offset`` for each piece, and the ``bound`` of the whole corpus.

    ``cut`` needs ``length`` (1 to ``capacity``); other columns are kept and may have any name but
    those added. Pieces of full length are sequences by themselves. Equal lengths are told apart by the row, so
    repeated rows are packed like any. An empty table gives an empty result. The histogram of lengths
    (``capacity`` numbers) is the only thing the driver gets.
    """
    keyed = checkpointed(cut.withColumn("_key", F.monotonically_increasing_id()))
    counts = np.zeros(capacity + 1, np.int64)
    for length, n in keyed.groupBy("length").count().collect():
        counts[length] = n
    bound = lower_bound(counts)
    counts[capacity] = 0
    tokens = int((counts * np.arange(capacity + 1)).sum())
    rows = keyed.where(F.col("length") < capacity).select(F.col("_key").alias("key"), "length")
    now = checkpointed(_packed(_dealt(rows, tokens, group_tokens, 0, 0), capacity))
    next_part = max(1, -(-tokens // group_tokens))

    def again(chosen: DataFrame, salt: int) -> DataFrame | None:
        """The chosen pieces packed anew, if that takes fewer sequences."""
        nonlocal next_part
        total = chosen.agg(F.sum("length")).head()[0] or 0
        if not total:
            return None
        new = checkpointed(_packed(_dealt(chosen.select("key", "length"), total, group_tokens, next_part, salt), capacity))
        next_part += -(-total // group_tokens)
        return new if _number(new) < _number(chosen) else None

    for salt in range(1, rounds + 1):
        loose = now.where("gap > 0")
        if loose.select("part").distinct().limit(2).count() < 2:
            break
        new = again(loose, salt)
        if new is None:
            break
        now = now.where("gap <= 0").union(new)
    full = int(keyed.where(F.col("length") == capacity).count())
    for level in range(rounds):
        if full + _number(now) <= bound:
            break
        # The emptiest sequences: those less than three quarters, a half, a quarter short of full.
        chosen = F.col("fill") <= capacity * (3 - level) // 4
        new = again(now.where(chosen), rounds + 1 + level)
        if new is not None:
            now = now.where(~chosen).union(new)
    alone = keyed.where(F.col("length") == capacity).select(
        F.col("_key").alias("key"), F.col("_key").alias("part"), F.lit(-1).cast("long").alias("bin"), F.lit(0).cast("long").alias("offset")
    )
    placed = now.select("key", "part", "bin", "offset").union(alone)
    # Parts and bins are below 2^31; the ids of full pieces are negative, so the two never meet.
    sequence = F.when(F.col("bin") < 0, -F.col("key") - 1).otherwise(F.shiftleft(F.col("part"), 31) + F.col("bin"))
    placed = placed.select(F.col("key").alias("_key"), sequence.alias("sequence_id"), "offset")
    return keyed.join(placed, "_key").drop("_key").withColumn("bound", F.lit(bound).cast("long"))


def pack_documents(
    docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Pieces of all documents and where they are packed; see ``pieces`` and ``pack``."""
    return pack(pieces(docs, tokenizer, capacity, id_col, text_col), capacity)
