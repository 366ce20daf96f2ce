import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from limnocast.llm.hard_negatives import Residues, hard_negatives, primes_for

SCHEMA = "vec_id long, embedding array<float>, label int, positive_id string, key string"


def brute(rows, positives=5, negatives=10):
    """All scores, row by row; a row is told from its copies by its place."""
    held = []
    for vec_id, vector, label, *_ in rows:
        if vec_id is None or label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        held.append((vec_id, [math.floor(256 * float(np.float32(x))) for x in vector], label))
    out = []
    for i, (anchor, a, own) in enumerate(held):
        if anchor % 100:
            continue
        scored = [
            (-sum(x * y for x, y in zip(a, v, strict=True)), key, label)
            for j, (key, v, label) in enumerate(held)
            if j != i and len(v) == len(a)
        ]
        for p, positive, _ in sorted(s for s in scored if s[2] == own)[:positives]:
            near = sorted(s for s in scored if s[2] != own and 30 * -p <= 100 * -s[0] <= 90 * -p)[:negatives]
            out += [(anchor, positive, rank, key, -p, -n) for rank, (n, key, _) in enumerate(near, 1)]
    return sorted(out)


def mined(spark, rows, **options):
    frame = spark.createDataFrame(rows, SCHEMA)
    return sorted(tuple(r) for r in hard_negatives(frame, F.col("vec_id") % 100 == 0, **options).collect())


def family(seed, n, width=6, labels=3):
    rng = np.random.default_rng(seed)
    base = np.abs(rng.normal(size=(labels, width))) + 0.5
    picked = rng.integers(0, labels, n)
    return [(i * 10, (base[k] + rng.normal(scale=0.4, size=width)).tolist(), int(k), "x", "y") for i, k in enumerate(picked)]


@pytest.mark.parametrize("options", [{}, {"candidate_rows": 13, "anchor_rows": 4}, {"candidate_rows": 1, "anchor_rows": 1}])
def test_equals_brute_force(spark, options):
    rows = family(1, 60 if options.get("candidate_rows") == 1 else 150)
    want = brute(rows)
    assert len(want) > 50
    assert mined(spark, rows, **options) == want


def test_odd_rows_ties_and_copies(spark):
    rows = family(2, 40)
    rows += [rows[0], rows[3], rows[3]]  # an anchor twice, a row three times
    rows += [(7000 + i, rows[5][1], 1 - rows[5][2] % 2, "x", "y") for i in range(15)]  # ties of another label
    rows += [(100, None, 1, "", ""), (200, [], 1, "", ""), (201, [], 2, "", ""), (300, [1.0, None], 1, "", "")]
    rows += [(400, [float("nan")] * 6, 1, "", ""), (500, [float("inf")] * 6, 1, "", ""), (None, rows[1][1], 1, "", "")]
    rows += [(600, rows[1][1], None, "", ""), (800, [0.0] * 6, 1, "", ""), (900, [1.0, 2.0], 1, "", ""), (901, [1.0, 1.5], 1, "", "")]
    rows += [(902, [0.5, 1.0], 2, "", ""), (1000, [-1.0] * 6, 0, "", "")]
    assert mined(spark, rows, candidate_rows=7, anchor_rows=2) == brute(rows)


def test_empty_table(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(100, [1.0], 1, "", "")]) == []


def test_too_large_numbers_are_an_error(spark):
    frame = spark.createDataFrame([(100, [1e200, 1.0], 1), (1, [1.0, 1.0], 1)], "vec_id long, embedding array<double>, label int")
    with pytest.raises(ValueError, match="64-bit"):
        hard_negatives(frame, F.col("vec_id") % 100 == 0)


def test_large_numbers_stay_exact(spark):
    rng = random.Random(4)
    rows = [(i * 50, [rng.uniform(2e5, 4e5) for _ in range(40)], i % 2, "", "") for i in range(12)]
    got = mined(spark, rows, low=0, high=100)
    assert got and got == sorted(brute_wide(rows))


def brute_wide(rows):
    held = [(k, [math.floor(256 * float(np.float32(x))) for x in v], label) for k, v, label, *_ in rows]
    for i, (anchor, a, own) in enumerate(held):
        if anchor % 100:
            continue
        scored = [(-sum(map(int.__mul__, a, v)), k, label) for j, (k, v, label) in enumerate(held) if j != i]
        for p, positive, _ in sorted(s for s in scored if s[2] == own)[:5]:
            near = sorted(s for s in scored if s[2] != own and 0 <= -s[0] <= -p)[:10]
            yield from ((anchor, positive, rank, k, -p, -n) for rank, (n, k, _) in enumerate(near, 1))


@pytest.mark.parametrize("width,size", [(3, 10), (1100, 200), (5000, 3000), (16, 1 << 30)])
def test_residues_give_exact_products(width, size):
    rng = np.random.default_rng(width)
    a, b = (rng.integers(-size, size, (7, width)) for _ in range(2))
    want = a.astype(object) @ b.astype(object).T
    primes = primes_for(int(max(abs(x) for x in want.flat)))
    got = Residues(a, primes).scores(Residues(b, primes), slice(0, 7))
    assert (got.astype(object) == want).all()


def test_primes_cover_the_bound():
    for bound in (1, 100, 10**6, 2**62):
        primes = primes_for(bound)
        assert math.prod(primes) > 2 * bound and len(set(primes)) == len(primes)
