import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from limnocast.llm.embedding_dups import near_duplicates, tile_links
from limnocast.llm.nearest import _block, nearest, nearest_in_block
from limnocast.llm.vectors import Rounded


def family(rng, n, width=8):
    base = rng.normal(size=(max(1, n // 5), width))
    return base[rng.integers(0, len(base), n)] + rng.normal(scale=rng.choice([0.02, 0.1, 0.3]), size=(n, width))


def test_bounds_hold():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(50, 16)) * rng.lognormal(size=(50, 1))
    r = Rounded.of(x)
    near = r.whole.astype(float) * r.scale[:, None]
    assert (np.linalg.norm(x - near, axis=1) <= r.error).all()
    off = np.abs(x @ x.T - r.dots(r))
    assert (off <= r.norm[:, None] * r.error + r.error[:, None] * (r.norm + r.error) + 1e-9).all()


@pytest.mark.parametrize("seed", range(5))
def test_tile_links_equal_all_pairs(seed):
    rng = np.random.default_rng(seed)
    a, b = family(rng, 60), family(rng, 40)

    def cosine(u, v):
        return u @ v / math.sqrt(u @ u) / math.sqrt(v @ v)

    want = {(i, j) for i in range(60) for j in range(40) if cosine(a[i], b[j]) >= 0.98}
    assert set(zip(*map(np.ndarray.tolist, tile_links(a, b, 0.98)), strict=True)) == want
    want = {(i, j) for i in range(60) for j in range(i + 1, 60) if cosine(a[i], a[j]) >= 0.98}
    assert set(zip(*map(np.ndarray.tolist, tile_links(a, None, 0.98)), strict=True)) == want


ODD = [None, [], [0.0, 0.0], [1.0, None], [float("nan"), 1.0], [float("inf"), 0.0], [-0.0, 0.0]]


def odd_rows(first):
    return [(first + i, v, 1) for i, v in enumerate(ODD)]


def usable(v):
    return bool(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)


@pytest.mark.parametrize("block_rows", [2048, 7])
def test_components_equal_brute_force(spark, block_rows):
    rng = np.random.default_rng(block_rows)
    vectors = family(rng, 90, 6).astype(np.float32)
    rows = [(i, v.tolist(), [1, 2, None][min(2, i % 7)]) for i, v in enumerate(vectors)]
    rows += [(i + 200, rows[0][1], 1) for i in range(5)] + odd_rows(300) + [(400, [1.0, 2.0], 1), (401, [2.0, 4.0], 1), (401, [2.0, 4.0], 1)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("key", F.lit("clash"))
    got = sorted(tuple(r) for r in near_duplicates(frame, block_rows=block_rows).collect())
    n = len(rows)
    links = [set() for _ in rows]
    for i in range(n):
        for j in range(n):
            (_, u, k), (_, v, m) = rows[i], rows[j]
            if i != j and k == m and k is not None and usable(u) and usable(v) and len(u) == len(v):
                a, b = np.array(u, np.float64), np.array(v, np.float64)
                if a @ b / math.sqrt(a @ a) / math.sqrt(b @ b) >= 0.98:
                    links[i].add(j)
    root = [r[0] for r in rows]
    for _ in range(n):
        root = [min([root[i], *(root[j] for j in links[i])]) for i in range(n)]
    assert got == sorted((r[0], len(links[i]), root[i], r[0] == root[i]) for i, r in enumerate(rows))


def test_null_ids_and_empty(spark):
    kind = "vec_id long, embedding array<double>, label int"
    got = near_duplicates(spark.createDataFrame([(None, [1.0], 1), (3, [2.0], 1), (None, None, 1)], kind)).collect()
    assert sorted(map(tuple, got), key=str) == sorted([(None, 1, 3, False), (3, 1, 3, True), (None, 0, None, False)], key=str)
    assert near_duplicates(spark.createDataFrame([], kind)).collect() == []
    assert nearest(spark.createDataFrame([], kind), F.col("vec_id") % 2 == 0).collect() == []


def plain_nearest(rows, asks, number):
    good = {(i, tuple(v)) for i, v, _ in rows if i is not None and usable(v)}
    out = []
    for q in {i for i, _ in good if asks(i)}:
        best = {}
        for i, u in good:
            for j, v in good:
                if i == q and j != q and len(u) == len(v):
                    d = math.sqrt(sum((a - b) * (a - b) for a, b in zip(u, v, strict=True)))
                    best[j] = min(d, best.get(j, math.inf))
        out += [(q, n + 1, j, d) for n, (d, j) in enumerate(sorted((d, j) for j, d in best.items())[:number])]
    return sorted(out)


@pytest.mark.parametrize("blocks", [(8192, 1024), (13, 4)])
def test_nearest_equals_brute_force(spark, blocks):
    rng = random.Random(blocks[0])
    rows = [(i, [float(rng.randrange(3)) for _ in range(3)], 1) for i in range(80)]
    rows += [rows[3], rows[3], (5, [9.0, 9.0, 9.0], 1), (10, [1.0, 2.0], 1), (None, [1.0, 1.0, 1.0], 1)] + odd_rows(500)
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("asks", F.lit("clash"))
    got = nearest(frame, F.col("vec_id") % 10 == 0, 10, *blocks)
    assert sorted(map(tuple, got.collect())) == plain_nearest(rows, lambda i: i % 10 == 0, 10)


def test_fewer_candidates_than_asked(spark):
    frame = spark.createDataFrame([(0, [1.0]), (1, [3.0])], "vec_id long, embedding array<double>")
    assert list(map(tuple, nearest(frame, F.col("vec_id") == 0, 10).collect())) == [(0, 1, 1, 2.0)]


def test_very_near_and_very_far():
    base = np.full((1, 4), 1e6)
    rows = base + np.arange(30)[:, None] * 1e-7
    found = nearest_in_block(base, np.array([-1]), rows, np.arange(30), 3)
    assert [key for _, key in found[0]] == [0, 1, 2]


@pytest.mark.parametrize("size", [1e-200, 1.0, 1e200])
def test_nearest_of_very_small_and_large_numbers(spark, size):
    rng = np.random.default_rng(5)
    vectors = rng.normal(size=(120, 5)) * size
    vectors[60:] *= 1e-90
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    got = {}
    for r in nearest(frame, F.col("vec_id") % 10 == 0, candidate_rows=17, query_rows=5).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))

    def distance(a, b):
        """Plain sums of doubles, of differences brought near one by a power of two."""
        apart = [y - x for x, y in zip(a, b, strict=True)]
        power = math.frexp(max(map(abs, apart)))[1]
        total = 0.0
        for x in apart:
            total += math.ldexp(x, -power) * math.ldexp(x, -power)
        return math.ldexp(math.sqrt(total), power)

    plain = vectors.tolist()
    for q in range(0, 120, 10):
        want = sorted((distance(plain[q], plain[i]), i) for i in range(120) if i != q)[:10]
        assert [(score, i) for _, i, score in sorted(got[q])] == want


def test_a_task_hands_on_no_more_than_it_is_asked_for():
    rng = np.random.default_rng(6)
    queries, blocks = rng.normal(size=(3, 4)), [rng.normal(size=(50, 4)) for _ in range(6)]
    rows = [{"asks": True, "id": np.arange(3).tobytes(), "vector": queries.astype("<f8").tobytes(), "kind": "<f8"}]
    rows += [{"asks": False, "id": (np.arange(50) + 100 * n).tobytes(), "vector": b.astype("<f8").tobytes(), "kind": "<f8"} for n, b in enumerate(blocks, 1)]
    out = _block(pd.DataFrame(rows), 10)
    assert len(out) == 30
    every = np.concatenate(blocks)
    for q in range(3):
        want = np.sort(np.linalg.norm(every - queries[q], axis=1))[:10]
        assert np.allclose(np.sort(out[out.query_id == q].score), want)
