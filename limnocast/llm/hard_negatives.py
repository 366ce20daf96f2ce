"""Hard negatives by exact inner products in a residue number system.

Components become whole numbers. A tile of scores is one float32 matrix product per small prime: both sides are taken
modulo the prime first, so every partial sum is a whole number that float32 holds exactly. The residues
give the signed score by Chinese remaindering, as long as the product of the primes exceeds twice the largest possible
score; that bound comes from the longest vectors (Cauchy-Schwarz), and as many primes are taken as it needs.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from limnocast.llm.vectors import with_sizes
from limnocast.session import checkpointed

POSITIVES, NEGATIVES = 5, 10
#: A negative's score lies between these hundredths of its positive's score.
LOW, HIGH = 30, 90
#: Whole numbers per unit of a component.
UNIT = 256
#: Most rows in a block of candidates and of anchors, most numbers in a block, candidate blocks that one task walks through.
CANDIDATE_ROWS, ANCHOR_ROWS, BLOCK_NUMBERS, STRIPE_BLOCKS = 8192, 2048, 1 << 19, 16
#: Anchors whose scores against a block of candidates are held at a time.
STRIP_ROWS = 128
#: Components beyond this cannot be scored as 64-bit integers.
LARGEST = 1 << 31


def primes_for(bound: int) -> list[int]:
    """The largest primes below 256 whose product exceeds ``2 * bound``, so that signed scores up to it are told apart."""
    sieve = [n for n in range(255, 2, -1) if all(n % d for d in range(2, math.isqrt(n) + 1))]
    taken: list[int] = []
    while math.prod(taken) <= 2 * bound:
        if len(taken) == len(sieve):
            raise ValueError("the scores are too large")
        taken.append(sieve[len(taken)])
    return taken


class Residues:
    """Rows of whole numbers as their remainders, the nearest to zero, modulo each prime."""

    def __init__(self, whole: np.ndarray, primes: list[int]):
        self.primes = primes
        self.parts = []
        for p in primes:
            low = whole % p
            self.parts.append(np.where(low > p // 2, low - p, low).astype(np.float32))

    def scores(self, other: Residues, rows: slice) -> np.ndarray:
        """Exact inner products of some rows with all of ``other``, as 64-bit integers."""
        width = self.parts[0].shape[1]
        out, base = np.zeros((len(self.parts[0][rows]), len(other.parts[0])), np.int64), 1
        for p, a, b in zip(self.primes, self.parts, other.parts, strict=True):
            # So many products of remainders stay below 2**24, up to which float32 is exact.
            step = max(1, (1 << 24) // ((p // 2) ** 2) - 1)
            product = np.zeros(out.shape, np.float32)
            for begin in range(0, width, step):
                product += np.mod(a[rows, begin : begin + step] @ b[:, begin : begin + step].T, np.float32(p))
            # Balanced mixed-radix digits: what the primes so far leave open is settled modulo the next one. The
            # last sum may pass through a wrap of 64 bits, yet ends at the score, which fits.
            digit = (np.mod(product, np.float32(p)).astype(np.int64) - out % p) * pow(base, -1, p) % p
            out += base * np.where(digit > p // 2, digit - p, digit)
            base *= p
        return out


def _best(scores: np.ndarray, ids: np.ndarray, places: np.ndarray, number: int) -> list[tuple[int, int]]:
    """The ``number`` best of the rows at ``places``, in order of id: highest score first, then the smaller id."""
    held = scores[places]
    if len(held) > number:
        least = np.partition(held, len(held) - number)[len(held) - number]
        above = np.flatnonzero(held > least)
        ties = np.flatnonzero(held == least)[: number - len(above)]
        places = places[np.concatenate([above, ties])]
    return sorted(((-int(scores[i]), int(ids[i])) for i in places))


class _Block:
    """Rows of one block, by id."""

    def __init__(self, row: pd.Series, width: int, primes: list[int]):
        self.id, self.key, self.label = (np.frombuffer(row[c], np.int64) for c in ("id", "key", "label"))
        self.residues = Residues(np.frombuffer(row["whole"], np.int32).reshape(len(self.id), width).astype(np.int64), primes)
        self.wanted = row["wanted"]


def _walk(group: pd.DataFrame, width: int, primes: list[int]) -> Iterator[tuple[_Block, _Block, int, np.ndarray]]:
    """Anchor block, candidate block, an anchor's place and its scores there; candidate blocks one after another."""
    asking, offered = group[group["asks"]], group[~group["asks"]]
    for _, a in asking.iterrows():
        anchors = _Block(a, width, primes)
        for _, c in offered.iterrows():
            block = _Block(c, width, primes)
            for begin in range(0, len(anchors.id), STRIP_ROWS):
                scores = anchors.residues.scores(block.residues, slice(begin, begin + STRIP_ROWS))
                for i in range(len(scores)):
                    yield anchors, block, begin + i, scores[i]


def positives_in(group: pd.DataFrame, width: int, primes: list[int], number: int) -> pd.DataFrame:
    """Per anchor its best rows among the candidate blocks of a task; all are of one label."""
    held: dict[int, list[tuple[int, int]]] = {}
    for anchors, block, at, scores in _walk(group, width, primes):
        key = int(anchors.key[at])
        found = _best(scores, block.id, np.flatnonzero(block.key != key), number)
        held[key] = heapq.nsmallest(number, [*held.get(key, []), *found])
    flat = [(key, i, -s) for key, best in held.items() for s, i in best]
    return pd.DataFrame(flat, columns=["key", "positive_id", "positive_score"])


def negatives_in(group: pd.DataFrame, width: int, primes: list[int], number: int, low: int, high: int) -> pd.DataFrame:
    """Per anchor and positive score its best rows of another label within the score's window."""
    held: dict[tuple[int, int], list[tuple[int, int]]] = {}
    for anchors, block, at, scores in _walk(group, width, primes):
        key, strange = int(anchors.key[at]), block.label != anchors.label[at]
        for wanted in map(int, anchors.wanted[at]):
            begin, end = -(-low * wanted // 100), high * wanted // 100
            places = np.flatnonzero(strange & (scores >= begin) & (scores <= end))
            if len(places):
                best = held.get((key, wanted), [])
                held[key, wanted] = heapq.nsmallest(number, [*best, *_best(scores, block.id, places, number)])
    flat = [(key, wanted, i, -s) for (key, wanted), best in held.items() for s, i in best]
    return pd.DataFrame(flat, columns=["key", "positive_score", "negative_id", "negative_score"])


def _packed(rows: DataFrame, keys: list[str]) -> DataFrame:
    """One row per block: ids, keys, labels and whole numbers as bytes in the order of ids; ``wanted`` as it is."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["id", "key"], kind="stable")
        out = {k: [group[k].iloc[0]] for k in keys}
        out |= {c: [group[c].to_numpy(np.int64).tobytes()] for c in ("id", "key", "label")}
        out["whole"] = [np.stack(group["whole"].to_list()).astype(np.int32).tobytes()]
        return pd.DataFrame(out | {"wanted": [group["wanted"].to_list()]})

    kinds = dict(rows.dtypes)
    schema = [f"{k} {kinds[k]}" for k in keys] + ["id binary", "key binary", "label binary", "whole binary", "wanted array<array<long>>"]
    return rows.select(*keys, "id", "key", "label", "whole", "wanted").groupBy(*keys).applyInPandas(run, ", ".join(schema))


def _pairs(anchors: DataFrame, rows: DataFrame, keys: list[str], candidate_rows: int, anchor_rows: int) -> DataFrame:
    """Every block of anchors beside every stripe of candidate blocks of the same ``keys``, as groups of few rows."""

    def blocks(frame: DataFrame, name: str, size: int) -> DataFrame:
        rows_each = F.least(F.lit(size), F.greatest(F.lit(1), F.floor(BLOCK_NUMBERS / F.greatest(F.col("width"), F.lit(1)))))
        return frame.groupBy(*keys).agg(F.count("*").alias("n")).select(*keys, F.ceil(F.col("n") / rows_each).alias(name))

    sizes = blocks(anchors, "n_a", anchor_rows).join(blocks(rows, "n_c", candidate_rows), keys)
    sizes = sizes.withColumn("n_s", F.ceil(F.col("n_c") / STRIPE_BLOCKS))

    def dealt(frame: DataFrame, number: str) -> DataFrame:
        placed = with_sizes(frame, sizes, keys, "key").withColumn("block", F.pmod(F.xxhash64("key"), number))
        return _packed(placed, [*keys, "n_a", "n_s", "block"])

    def spread(number: str) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.col(number) - 1))

    asking = dealt(anchors, "n_a").withColumnRenamed("block", "a").withColumn("s", spread("n_s")).withColumn("asks", F.lit(True))
    offered = dealt(rows, "n_c").withColumn("s", F.pmod("block", "n_s")).withColumn("a", spread("n_a")).withColumn("asks", F.lit(False))
    names = [*keys, "a", "s", "asks", "id", "key", "label", "whole", "wanted"]
    return asking.select(*names).union(offered.select(*names))


def hard_negatives(
    rows: DataFrame,
    is_anchor: Column,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
    unit: int = UNIT,
    candidate_rows: int = CANDIDATE_ROWS,
    anchor_rows: int = ANCHOR_ROWS,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    A component x counts as ``floor(unit * x)``; a score is the integer inner product with the anchor, higher is nearer
    and ties go to the smaller id. An anchor's positives are its first ``positives`` other rows of its label; for each of
    them, the negatives are the first ``negatives`` rows of other labels whose score lies within ``low`` to ``high``
    hundredths of the positive's. Fewer than asked for are all returned; a positive without negatives gives no row.

    Rows without an id or label, without a vector or with null or non-finite components take no part, nor do
    null verdicts of ``is_anchor`` ask; vectors of different lengths do not meet. A repeated row is a row of its
    own: it can be the other's positive, and as an anchor it gives its rows once more. An empty vector
    scores 0. An empty table gives an empty result. Whole components must be below 2**31, and scores below 2**62; larger ones
    are an error, as they would not fit the result. Other columns are not read.
    """
    label = F.col(label_col).cast("long")
    sound = F.forall(vector_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    # Beyond the range a component stands at it, so that the check below sees it.
    whole = F.transform(
        vector_col, lambda x: F.greatest(F.least(F.floor(x.cast("double") * unit), F.lit(LARGEST)), F.lit(-LARGEST)).cast("long")
    )
    held = (
        rows.where(F.coalesce(sound, F.lit(False)) & label.isNotNull() & F.col(id_col).isNotNull())
        .select(F.col(id_col).cast("long").alias("id"), label.alias("label"), whole.alias("whole"), F.coalesce(is_anchor, F.lit(False)).alias("asks"))
        .withColumn("key", F.monotonically_increasing_id())
        .withColumn("width", F.size("whole"))
        .withColumn("wanted", F.lit(None).cast("array<long>"))
    )
    held = checkpointed(held)
    square = F.aggregate("whole", F.lit(0.0), lambda a, x: a + x.cast("double") * x)
    top = F.max(F.array_max(F.transform("whole", F.abs))).alias("top")
    size = held.agg(F.max(square).alias("square"), top).first()
    if (size["top"] or 0) >= LARGEST or (size["square"] or 0) >= 2.0**62:
        raise ValueError(f"{vector_col} holds numbers that cannot be scored as 64-bit integers")
    primes = primes_for(int((size["square"] or 0) * (1 + 1e-9)) + 1)
    anchors = held.where("asks").drop("asks")
    held = held.drop("asks")

    def find_positives(group: pd.DataFrame) -> pd.DataFrame:
        return positives_in(group, int(group["width"].iloc[0]), primes, positives)

    own = F.col("label").alias("own")
    alike = _pairs(anchors.select("*", own), held.select("*", own), ["width", "own"], candidate_rows, anchor_rows)
    found = alike.groupBy("width", "own", "a", "s").applyInPandas(find_positives, "key long, positive_id long, positive_score long")
    order = Window.partitionBy("key").orderBy(F.desc("positive_score"), "positive_id")
    chosen = found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= positives)
    chosen = checkpointed(chosen)

    wanted = chosen.groupBy("key").agg(F.collect_set("positive_score").alias("wanted"))
    asking = anchors.drop("wanted").join(wanted, "key")

    def find_negatives(group: pd.DataFrame) -> pd.DataFrame:
        return negatives_in(group, int(group["width"].iloc[0]), primes, negatives, low, high)

    strange = _pairs(asking, held, ["width"], candidate_rows, anchor_rows)
    near = strange.groupBy("width", "a", "s").applyInPandas(
        find_negatives, "key long, positive_score long, negative_id long, negative_score long"
    )
    order = Window.partitionBy("key", "positive_score").orderBy(F.desc("negative_score"), "negative_id")
    near = near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    return (
        chosen.join(near, ["key", "positive_score"])
        .join(anchors.select("key", F.col("id").alias("anchor_id")), "key")
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    )
