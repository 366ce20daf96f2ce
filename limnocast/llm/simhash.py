"""SimHash near-duplicates found with a Gray-ordered hierarchical index.

Fingerprints within ``d`` bits agree on at least one of ``d + 1`` bands of bits. The masked patterns of the
bands are the upper nodes of the index; two fingerprints meet only below a
shared upper node. Below it fingerprints are sorted by Gray rank, so neighbours share long
runs of bits, and packed into a tree: each node holds the bits that all its members share,
a child adds what is newly shared. Pairs of nodes are compared from the top; differences of the shared bits
add up on the way down, and a pair of groups is dropped as a whole once they exceed ``d``.

An upper node that holds too many fingerprints is replaced by upper nodes that pin further bits
(again ``d + 1`` bands of the bits still free, so no link is lost) until it fits one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from limnocast.llm.graph import Forest, components
from limnocast.session import checkpointed

SEED = 42
FAN = 8
#: Rows under one upper node beyond which more bits are pinned.
NODE_ROWS = 1 << 15
#: Numbers of rows that every task may hold to tell which rows go.
HELD_ROWS = 1_000_000
#: Bytes of text and pairs of nodes that are worked on at a time.
BLOCK_BYTES, BLOCK_PAIRS = 1 << 22, 1 << 14

_LANES = np.uint64(0x0101010101010101)


def _blocks(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text, a few megabytes at a time, cut between words."""
    text = text.lower()
    begin = 0
    while begin < len(text):
        end = begin + BLOCK_BYTES
        if end < len(text):
            while end < len(text) and text[end] not in b" \t\n\v\f\r":
                end += 1
        yield text[begin:end].split()
        begin = end


def _count_bits(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes have each bit set, bit 0 first."""
    counts = np.zeros(64, np.int64)
    padded = np.zeros(-(-len(hashes) // 255) * 255, np.uint64)
    padded[: len(hashes)] = hashes
    for shift in range(8):
        # Eight counters of eight bits each; 255 additions cannot overflow one.
        lanes = ((padded >> np.uint64(shift)) & _LANES).reshape(-1, 255).sum(axis=1, dtype=np.uint64)
        counts[shift::8] = lanes.astype("<u8").view(np.uint8).reshape(-1, 8).sum(axis=0, dtype=np.int64)
    return counts


def fingerprint(text: bytes | None, words: int) -> int:
    """The 64-bit SimHash of a UTF-8 text over ``words``-word shingles; no words give zero."""
    digest, carry = xxhash.xxh64_intdigest, []
    counts, total = np.zeros(64, np.int64), 0
    for block in _blocks(text or b""):
        block = carry + block
        if len(block) >= words:
            lengths = np.fromiter(map(len, block), np.int64, len(block))
            ends = np.cumsum(lengths + 1) - 1
            starts = (ends - lengths)[: len(block) - words + 1].tolist()
            joined = b" ".join(block)
            hashes = [digest(joined[i:j], SEED) for i, j in zip(starts, ends[words - 1 :].tolist(), strict=True)]
            counts += _count_bits(np.array(hashes, np.uint64))
            total += len(hashes)
        carry = block[max(0, len(block) - words + 1) :] if words > 1 else []
    if not total:
        return digest(b" ".join(carry), SEED) if carry else 0
    return sum(1 << int(bit) for bit in np.flatnonzero(counts * 2 > total))


def with_fingerprint(docs: DataFrame, body: str, words: int) -> DataFrame:
    """``docs`` with the UTF-8 text column ``body`` replaced by ``print``, the fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.fromiter((fingerprint(x.as_py(), words) for x in batch[body]), np.uint64, batch.num_rows)
            held = [c for c in batch.schema.names if c != body]
            arrays = [*(batch[c] for c in held), pa.array(prints.view(np.int64))]
            yield pa.RecordBatch.from_arrays(arrays, names=[*held, "print"])

    kinds = [f"{name} {kind}" for name, kind in docs.dtypes if name != body]
    return docs.withColumn(body, F.col(body).cast("binary")).mapInArrow(run, ", ".join([*kinds, "print long"]))


def gray_rank(prints: np.ndarray) -> np.ndarray:
    """Position of each 64-bit word in the reflected Gray sequence."""
    rank = prints.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


def _levels(keys: np.ndarray, prints: np.ndarray) -> list[tuple[np.ndarray, ...]]:
    """Levels of the trees under all upper nodes, rows first: (all-ones bits, any-ones bits, first child, end child)."""
    here, ones, some = keys, prints, prints
    rows = np.arange(len(keys))
    levels = [(ones, some, rows, rows)]
    while True:
        new = np.r_[True, here[1:] != here[:-1]]
        start = np.flatnonzero(new)
        if len(start) == len(here):
            return levels
        place = np.arange(len(here)) - np.repeat(start, np.diff(np.r_[start, len(here)]))
        first = np.flatnonzero(place % FAN == 0)
        ones, some = np.bitwise_and.reduceat(ones, first), np.bitwise_or.reduceat(some, first)
        levels.append((ones, some, first, np.r_[first[1:], len(here)]))
        here = here[first]


def near_links(keys: np.ndarray, prints: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the pairs that share a key and differ in at most ``max_bits`` bits."""
    order = np.lexsort((gray_rank(prints), keys))
    keys, prints = keys[order], prints[order]
    forest = Forest(len(keys))
    levels = _levels(keys, prints)
    top = len(levels) - 1
    roots = np.arange(len(levels[top][0]))
    stack = [(top, roots, roots, np.zeros(len(roots), np.uint8), np.zeros(len(roots), np.uint64))] if top else []
    while stack:
        level, g, h, differ, pinned = stack.pop()
        if len(g) > BLOCK_PAIRS:
            for i in range(0, len(g), BLOCK_PAIRS):
                stack.append((level, *(x[i : i + BLOCK_PAIRS] for x in (g, h, differ, pinned))))
            continue
        _, _, first, end = levels[level]
        width = end[h] - first[h]
        each = (end[g] - first[g]) * width
        of = np.repeat(np.arange(len(g)), each)
        step = np.arange(len(of)) - np.repeat(np.cumsum(each) - each, each)
        x, y = first[g][of] + step // width[of], first[h][of] + step % width[of]
        keep = (x < y) if level == 1 else (x <= y)
        x, y, of = x[keep], y[keep], of[keep]
        ones, some, _, _ = levels[level - 1]
        common = ~(ones[x] ^ some[x]) & ~(ones[y] ^ some[y])
        total = differ[of] + np.bitwise_count((ones[x] ^ ones[y]) & common & ~pinned[of])
        keep = total <= max_bits
        x, y = x[keep], y[keep]
        if level == 1:
            forest.link(x, y)
        elif len(x):
            stack.append((level - 1, x, y, total[keep], common[keep]))
    moved = np.flatnonzero(forest.label != np.arange(len(keys)))
    return prints[moved], prints[forest.label[moved]]


def _bands(free: int, count: int) -> list[int]:
    """The set bits of ``free`` cut into ``count`` masks of about equal size."""
    bits = [i for i in range(64) if free >> i & 1]
    cuts = [len(bits) * i // count for i in range(count + 1)]
    return [sum(1 << i for i in bits[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _upper_nodes(prints: DataFrame, max_bits: int, node_rows: int) -> DataFrame:
    """``(key, print)``: each fingerprint under every upper node that holds it."""
    count, full = max_bits + 1, (1 << 64) - 1

    def pinned(rows: DataFrame, frees: list[int]) -> DataFrame:
        masks = F.lit(None)
        for free in frees:
            nodes = F.array(
                *(
                    F.struct(
                        F.xxhash64("key", F.lit(_signed(m)), F.col("print").bitwiseAND(F.lit(_signed(m)))).alias("key"),
                        F.lit(_signed(free & ~m)).alias("free"),
                    )
                    for m in _bands(free, count)
                )
            )
            masks = F.when(F.col("free") == _signed(free), nodes).otherwise(masks)
        return rows.select("print", F.inline(masks))

    frees = [full]
    done, rows = None, pinned(prints.select("print", F.lit(0).cast("long").alias("key"), F.lit(-1).cast("long").alias("free")), frees)
    while True:
        frees = sorted({free & ~m for free in frees for m in _bands(free, count)})
        # With so few bits free a node cannot hold more rows than that.
        if 1 << max(free.bit_count() for free in frees) <= node_rows:
            break
        large = checkpointed(rows.groupBy("key").count().where(F.col("count") > node_rows).select("key"))
        if large.isEmpty():
            break
        fits = rows.join(large, "key", "left_anti").select("key", "print")
        done = fits if done is None else done.union(fits)
        rows = checkpointed(pinned(rows.join(large, "key", "left_semi"), frees))
    rows = rows.select("key", "print")
    return rows if done is None else done.union(rows)


def _links(prints: DataFrame, max_bits: int, node_rows: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def solve(keys: np.ndarray, held: np.ndarray) -> pa.RecordBatch:
            a, b = near_links(keys, held, max_bits)
            arrays = [pa.array(a.view(np.int64)), pa.array(b.view(np.int64))]
            return pa.RecordBatch.from_arrays(arrays, names=["a", "b"])

        keys, held = np.empty(0, np.int64), np.empty(0, np.uint64)
        for batch in batches:
            keys = np.r_[keys, batch["key"].to_numpy()]
            held = np.r_[held, batch["print"].to_numpy().view(np.uint64)]
            if len(keys) > 2 * node_rows:
                # The rows of the last node may go on in the next batch.
                cut = np.searchsorted(keys, keys[-1])
                if cut:
                    yield solve(keys[:cut], held[:cut])
                    keys, held = keys[cut:], held[cut:]
        if len(keys):
            yield solve(keys, held)

    nodes = _upper_nodes(prints, max_bits, node_rows)
    return nodes.repartition("key").sortWithinPartitions("key").mapInArrow(run, "a long, b long")


def _components(hashed: DataFrame, max_bits: int, node_rows: int) -> DataFrame:
    """``(print, root)`` for every fingerprint of ``hashed``; the root is a fingerprint of its component."""
    prints = checkpointed(hashed.select("print").distinct())
    found = components(_links(prints, max_bits, node_rows)).withColumnRenamed("node", "print")
    return prints.join(found, "print", "left").withColumn("root", F.coalesce("root", "print"))


def near_duplicates(
    docs: DataFrame,
    words: int = 3,
    max_bits: int = 3,
    id_col: str = "doc_id",
    text_col: str = "text",
    node_rows: int = NODE_ROWS,
) -> DataFrame:
    """One row per row of ``docs``: its id, fingerprint (16 hex digits) and component.

    Fingerprints that differ in at most ``max_bits`` bits link; a component is named by the smallest id in it.
    A null or empty text, or one of white space, has fingerprint zero and links like any other.
    A text of fewer than ``words`` words is one shingle. A null id takes the component of its fingerprint and
    never names one. Repeated rows each get a row; other columns are not read. An empty table gives an
    empty result. Only ids and fingerprints are shuffled; copies collapse to one fingerprint before any search.
    """
    narrow = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("body"))
    hashed = checkpointed(with_fingerprint(narrow, "body", words))
    placed = checkpointed(_components(hashed, max_bits, node_rows))
    lows = hashed.groupBy("print").agg(F.min("id").alias("low")).join(placed, "print")
    lowest = lows.groupBy("root").agg(F.min("low").alias("component_id"))
    named = placed.join(lowest, "root").select("print", "component_id")
    return hashed.join(named, "print").select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id"
    )


def without_near_duplicates(
    docs: DataFrame, words: int = 3, max_bits: int = 3, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The rows of ``docs`` less all but one of each group; its columns are kept, whatever their names.

    The row with the smallest id of a group stays, of repeated rows any one; a row without an id stays only where its
    group has none. Rows are told apart by their place in ``docs``, so that must read the same twice, as files do.
    """
    row = "_row"
    while row in docs.columns:
        row += "_"
    marked = docs.withColumn(row, F.monotonically_increasing_id())
    narrow = marked.select(F.col(row).alias("row"), F.col(id_col).alias("id"), F.col(text_col).alias("body"))
    hashed = checkpointed(with_fingerprint(narrow, "body", words))
    best = F.min(F.struct(F.col("id").isNull().alias("bare"), "id", "row"))
    firsts = hashed.groupBy("print").agg(best.alias("best"))
    placed = firsts.join(_components(hashed, max_bits, NODE_ROWS), "print")
    stays = placed.groupBy("root").agg(F.min("best").alias("best")).select(F.col("best.row").alias("row"))
    goes = checkpointed(hashed.select("row").join(stays, "row", "left_anti").withColumnRenamed("row", row))
    # Numbers of the rows that go; where they are few enough to hold, no text is moved.
    few = goes.count() <= HELD_ROWS
    return marked.join(F.broadcast(goes) if few else goes, row, "left_anti").drop(row)
