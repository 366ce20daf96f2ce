import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from limnocast.llm.merkle import folded, grown, height, manifest, siblings

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, part_of string, leaf string"


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(doc_id, source, lang, n_chars, text):
    return sha(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)))


def climb(nodes):
    """Levels of a tree, and per leaf its siblings as (left, right) pairs."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for path, i in zip(paths, at, strict=True):
            begin = i // 3 * 3
            path.append(("".join(nodes[begin:i]), "".join(nodes[i + 1 : begin + 3])))
        nodes = [sha(*nodes[i : i + 3]) for i in range(0, len(nodes), 3)]
        at = [i // 3 for i in at]
    return nodes[0], paths


def brute(rows):
    groups = defaultdict(list)
    for doc_id, text, lang, source, n_chars, *_ in rows:
        struck = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 2 == 0
        changed = text.replace("\n", "") if struck and text is not None else text
        order = (doc_id is not None, doc_id or 0, leaf(doc_id, source, lang, n_chars, text))
        groups[source].append((order, doc_id, leaf(doc_id, source, lang, n_chars, changed)))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: climb([x[0][2] for x in sorted(groups[s], key=lambda x: x[0])]) for s in names}
    root, tops = climb([trees[s][0] for s in names])
    out = []
    for s, top in zip(names, tops, strict=True):
        subroot, paths = trees[s]
        for place, (order, doc_id, own) in enumerate(sorted(groups[s], key=lambda x: x[0])):
            got = own
            for left, right in (steps := paths[place] + top):
                got = sha(left, got, right)
            out.append((doc_id, order[2], subroot, root, sha(*(x + y for x, y in steps)), got, got == root, s, place))
    return sorted(out, key=repr)


def made(spark, rows):
    frame = spark.createDataFrame(rows, SCHEMA)
    struck = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    text = F.when(struck, F.replace(F.col("text"), F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    return sorted((tuple(r) for r in manifest(frame, changed={"text": text}).collect()), key=repr)


def doc(i, source="s", text=None):
    return (i, f"line {i}\nnext" if text is None else text, "en", source, 7, "clash", "clash")


@pytest.mark.parametrize("number", [1, 2, 3, 4, 9, 10, 28])
def test_small_trees_equal_brute_force(spark, number):
    rows = [doc(i * 5) for i in range(number)]
    assert made(spark, rows) == brute(rows)


def test_odd_rows(spark):
    rng = random.Random(3)
    ids = [rng.choice([1, -1]) * rng.getrandbits(rng.choice([4, 17, 40, 63])) for _ in range(300)]
    ids += [-(2**63), 2**63 - 1, 32767, 32768, -32768, 511, 512]
    rows = [doc(i, rng.choice([None, "", "a", "é", "Z", "\U0001f600", "￿"])) for i in ids]
    rows += [doc(None, "a", f"t{i}") for i in range(40)] + [doc(None, None)] * 3 + [doc(12, "a")] * 9  # null and repeated ids
    rows += [doc(12, "a", f"other {i}") for i in range(20)] + [doc(13, "a")] * 4
    rows += [(20, None, None, "a", None, "", ""), (21, "", "", "a", 0, "", ""), (22, "\n\n" * 3, "en", "b", 1, "", "")]
    rows += [doc(14, "lone", "x" * 200_000 + "\n")]
    rng.shuffle(rows)
    got = made(spark, rows)
    assert got == brute(rows)
    assert {r[6] for r in got} == {True, False}


def test_large_group_takes_several_passes(spark):
    rows = [doc(i * 3) for i in range(2400)] + [doc(9)] * 2300 + [doc(i, "few") for i in range(5)]
    assert made(spark, rows) == brute(rows)


def test_many_groups(spark):
    rows = [doc(i, f"host-{i % 2300}") for i in range(2400)]
    assert made(spark, rows) == brute(rows)


def test_empty_table(spark):
    assert made(spark, []) == []


def test_path_leads_to_the_root(spark):
    frame = spark.createDataFrame([doc(i, f"s{i % 3}") for i in range(40)], SCHEMA)
    for row in manifest(frame, with_path=True).collect():
        assert folded(row["leaf"], row["path"]) == row["root"] and row["verified"]
        assert sha(*row["path"]) == row["proof_sha256"]


def test_heights():
    assert [height(n) for n in (1, 2, 3, 4, 9, 10, 2187, 2188)] == [0, 1, 1, 2, 2, 3, 7, 8]
    levels = grown(["a", "b", "c", "d"], 2)
    assert siblings(levels, 3) == ["", "", levels[1][0], ""]
