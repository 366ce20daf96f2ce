import random
import zlib
from collections import defaultdict
from itertools import pairwise, product

import numpy as np
import pytest
from pyspark.sql import functions as F

from limnocast.llm.sharding import hilbert_index, hilbert_indices, manifest, shard, write_shards


@pytest.mark.parametrize("dims,bits", [(1, 3), (2, 4), (3, 3), (4, 2)])
def test_curve_visits_every_cell_by_single_steps(dims, bits):
    cells = sorted(product(range(1 << bits), repeat=dims), key=lambda p: hilbert_index(p, bits))
    assert [hilbert_index(p, bits) for p in cells] == list(range(len(cells)))
    assert all(sum(abs(a - b) for a, b in zip(p, q, strict=True)) == 1 for p, q in pairwise(cells))


    points = np.array(cells)
    assert hilbert_indices(points, bits).tolist() == list(range(len(cells)))


def plain_levels(values, cuts=16):
    """Levels by the value at each sixteenth of the sorted column, equal cuts once, null first."""
    key = lambda v: (v is not None, v if v is not None else 0)
    order = sorted(values, key=key)
    at = {key(order[-(-len(order) * i // cuts) - 1]) for i in range(1, cuts)}
    return [sum(key(v) > c for c in at) for v in values]


def test_placement_equals_a_plain_one(spark):
    held = [(i, "z" * (i * 7919 % 6000), f"https://host{i * 31 % 200:03}.org", ["", "a", None, "bb"][i % 4]) for i in range(640)]
    # One empty source must not make all others one level.
    held.append((900, "z", "", "a"))
    docs = spark.createDataFrame(held, "doc_id long, text string, source string, lang string")
    got = sorted(shard(docs).collect(), key=lambda r: r.doc_id)
    lang, source, size = (plain_levels(v) for v in ([h[3] for h in held], [h[2] for h in held], [len(h[1]) + 1 for h in held]))
    assert len(set(source)) == 16 and max(source) == 15
    want = [hilbert_index(p, 4) for p in zip(lang, source, size, strict=True)]
    assert [r.curve for r in got] == want
    order = sorted(range(len(held)), key=lambda i: (want[i], zlib.crc32(held[i][1].encode()), held[i][0]))
    place = {i: n for n, i in enumerate(order)}
    each, more = divmod(len(held), 16)
    for i, r in enumerate(got):
        at = place[i]
        s = at // (each + 1) if at < more * (each + 1) else more + (at - more * (each + 1)) // each
        assert (r.shard, r.slot) == (s, at - s * each - min(s, more))


def test_many_dimensions_are_an_error_or_fit(spark):
    docs = spark.createDataFrame([(i, "t", "a", "b") for i in range(20)], "doc_id long, text string, lang string, source string")
    assert shard(docs, dims=("lang", "source", "doc_id", "lang", "source")).count() == 20
    with pytest.raises(ValueError, match="64 bits"):
        shard(docs, dims=("lang",) * 20)


def rows(n, seed=1):
    rng = random.Random(seed)
    return [
        (i, rng.choice(["", "x" * rng.randrange(300), "same text", None]), rng.choice(["en", "de", None]), f"src{rng.choice([0, 0, 1, 12])}")
        for i in range(n)
    ]


@pytest.mark.parametrize("n", [0, 1, 5, 16, 203])
def test_law_slots_and_sizes(spark, n):
    held = rows(n) + rows(3 if n else 0)
    docs = spark.createDataFrame(held, "doc_id long, text string, lang string, source string").withColumn("shard", F.lit("clash"))
    got = shard(docs).collect()
    assert sorted((r.doc_id, r.size, r.text_crc32) for r in got) == sorted(
        (i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, *_ in held
    )
    by = defaultdict(list)
    for r in got:
        assert r.law == "rows" and r.grown_shard is None
        by[r.shard].append(r)
    counts = [len(by[s]) for s in range(16)]
    assert set(by) <= set(range(16)) and max(counts) - min(counts) <= 1
    last = (-1,)
    for s in sorted(by):
        assert sorted(r.slot for r in by[s]) == list(range(len(by[s])))
        for r in sorted(by[s], key=lambda r: r.slot):
            assert (r.curve,) >= last
            last = (r.curve,)


def test_columns_all_null(spark):
    docs = spark.createDataFrame([(None, None, None, None)] * 3, "doc_id long, text string, lang string, source string")
    assert sorted(r.shard for r in shard(docs).collect()) == [0, 1, 2]


def test_files_can_be_skipped(spark, tmp_path):
    rng = random.Random(3)
    held = [(i, "y" * rng.randrange(2000), rng.choice(["aa", "bb", "cc", "dd"]), f"s{rng.randrange(8)}") for i in range(800)]
    spark.createDataFrame(held, "doc_id long, text string, lang string, source string").write.parquet(str(tmp_path / "in"))
    write_shards(spark.read.parquet(str(tmp_path / "in")), str(tmp_path / "out"))
    written = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(map(tuple, written.drop("shard").collect())) == sorted(held)
    ranges = manifest(written).collect()
    assert len(ranges) == 16 and sum(r.rows for r in ranges) == 800
    hit = [r for r in ranges if r.min_lang <= "bb" <= r.max_lang and r.min_size <= 1500]
    small = [r for r in ranges if r.max_size < 1200 or r.min_size > 800]
    assert len(hit) < 16 and len(small) >= 4
