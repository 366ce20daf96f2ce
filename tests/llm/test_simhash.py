import random
import re

import numpy as np
import pytest
import xxhash

from limnocast.llm import simhash
from limnocast.llm.graph import components
from limnocast.llm.simhash import fingerprint, gray_rank, near_duplicates, near_links, without_near_duplicates


def plain_fingerprint(text, k=3):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    shingles = [" ".join(words[i : i + k]) for i in range(len(words) - k + 1)] if len(words) >= k else [" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def plain_components(prints, bits):
    """Smallest id reachable, by plain search over (id, fingerprint)."""
    root = {i: i for i, _ in prints}
    changed = True
    while changed:
        changed = False
        for i, a in prints:
            for j, b in prints:
                if (a ^ b).bit_count() <= bits and root[i] > root[j]:
                    root[i], changed = root[j], True
    return root


TEXTS = [None, "", " \t\n", "one", "Two words", "a b c", "A  B\tC", "é É ß x", "x" * 5000, "w " * 3000, "a b c d", "a\x1cb c d e"]


@pytest.mark.parametrize("text", TEXTS)
def test_fingerprint_equals_plain(text):
    assert fingerprint(None if text is None else text.encode(), 3) == plain_fingerprint(text)


def test_fingerprint_over_block_borders(monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK_BYTES", 7)
    rng = random.Random(3)
    for _ in range(50):
        text = "".join(rng.choice("ab \n") for _ in range(rng.randrange(120)))
        assert fingerprint(text.encode(), 3) == plain_fingerprint(text)


def test_gray_rank_inverts_the_gray_code():
    ranks = np.random.default_rng(1).integers(0, 2**63, 100).astype(np.uint64)
    assert (gray_rank(ranks ^ (ranks >> np.uint64(1))) == ranks).all()


def cluster(rng, n):
    base = [rng.getrandbits(64) for _ in range(max(1, n // 6))]
    out = set()
    while len(out) < n:
        x = rng.choice(base)
        for _ in range(rng.randrange(6)):
            x ^= 1 << rng.randrange(64)
        out.add(x)
    return sorted(out)


@pytest.mark.parametrize("seed", range(6))
def test_links_of_one_node_equal_all_pairs(seed):
    rng = random.Random(seed)
    prints = cluster(rng, 400)
    a, b = near_links(np.zeros(len(prints), np.int64), np.array(prints, np.uint64), 3)
    root = {x: x for x in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        root[max(find(x), find(y))] = min(find(x), find(y))
    want = plain_components([(x, x) for x in prints], 3)
    groups = {}
    for x in prints:
        groups.setdefault(find(x), set()).add(x)
    expected = {}
    for x in prints:
        expected.setdefault(want[x], set()).add(x)
    assert {frozenset(g) for g in groups.values()} == {frozenset(g) for g in expected.values()}


def docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, print string, component_id int")


def corpus(rng):
    words = ["alpha", "beta", "gamma", "delta", "eps", "zeta", "eta", "theta"]
    out = []
    for _ in range(12):
        text = [rng.choice(words) for _ in range(rng.randrange(3, 200))]
        for _ in range(rng.randrange(1, 5)):
            copy = list(text)
            for _ in range(rng.randrange(2)):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            out.append(" ".join(copy))
    return out


@pytest.mark.parametrize("node_rows", [1 << 15, 4])
def test_components_equal_brute_force(spark, node_rows):
    texts = corpus(random.Random(node_rows)) + TEXTS + TEXTS[:3]
    rows = [(i * 3, t, "clash", 1) for i, t in enumerate(texts)]
    got = {r.doc_id: r for r in near_duplicates(docs(spark, rows), node_rows=node_rows).collect()}
    prints = [(i, plain_fingerprint(t)) for i, t, *_ in rows]
    want = plain_components(prints, 3)
    assert {i: (f"{p:016x}", want[i]) for i, p in prints} == {i: (r.fingerprint, r.component_id) for i, r in got.items()}


def test_null_and_repeated_ids(spark):
    rows = [(None, "a b c", "", 0), (None, "q w e r t", "", 0), (5, "a b c", "", 0), (5, "a b c", "", 0), (2, "A B C", "", 0)]
    got = [(r.doc_id, r.component_id) for r in near_duplicates(docs(spark, rows)).collect()]
    assert sorted(got, key=str) == sorted([(None, 2), (None, None), (5, 2), (5, 2), (2, 2)], key=str)


def test_empty_table(spark):
    assert near_duplicates(docs(spark, [])).collect() == []
    assert without_near_duplicates(docs(spark, [])).collect() == []


def test_one_row_of_each_group_stays(spark, tmp_path):
    rows = [(9, "a b c", "x", 1), (4, "a b c", "y", 2), (4, "a b c", "y", 2), (None, "a b c", "z", 3), (None, "lone text here now", "n", 4)]
    docs(spark, rows).write.parquet(str(tmp_path / "d"))
    stays = without_near_duplicates(spark.read.parquet(str(tmp_path / "d")))
    assert stays.columns == ["doc_id", "text", "print", "component_id"]
    assert sorted(map(tuple, stays.collect()), key=str) == sorted([rows[1], rows[4]], key=str)


def test_components_of_chains_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(200, 200), (7, 6)]
    got = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}}
