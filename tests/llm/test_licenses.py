import math
import random
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from limnocast.llm.licence_texts import FILES, NOTICES
from limnocast.llm.licenses import idf, leading_terms, longest_run, scan, vector, words_of

COMMON = Path("/usr/share/common-licenses")


def plain_scan(rows, line_cosine=0.8, file_cosine=0.5):
    """(id, path, licence, basis, cosine, notices, heir) by loops over (id, text, path)."""
    number, df = len(rows), Counter(t for _, text, _ in rows for t in set(words_of(text or "")))
    told = [(licence, words_of(text)) for licence, text in NOTICES]
    opened = [(licence, words_of(text)) for licence, text in FILES]

    def weights(words):
        return {w: (1 + math.log(n)) * idf(df[w], number) for w, n in Counter(words).items()}

    def cosine(a, b):
        a, b = weights(a), weights(b)
        dot = sum(x * b.get(w, 0) for w, x in a.items())
        return round(dot / math.sqrt(sum(x * x for x in a.values()) * sum(x * x for x in b.values())), 9) if a and b else 0

    longest, known = longest_run([w for _, w in told], line_cosine), {w for _, ws in told for w in ws}
    own = []
    for _, text, path in rows:
        lines = [w for x in (text or "").split("\n") if (w := words_of(x))]
        best_of = {}
        for a in range(len(lines)):
            for b in range(a, len(lines)):
                run = [w for line in lines[a : b + 1] for w in line]
                if (a != b and len(run) > longest) or not known & set(lines[a]) or not known & set(lines[b]):
                    continue
                hits = [(-c, licence) for licence, ws in told if (c := cosine(run, ws)) >= line_cosine]
                if hits:
                    rank = (min(hits)[0], b - a, a, min(hits)[1])
                    for i in range(a, b + 1):
                        best_of[i] = min(best_of.get(i, rank), rank)
        words = words_of(text or "")
        files = [(-c, licence) for licence, ws in opened if (c := cosine(words[: len(ws)], ws)) >= line_cosine and cosine(words, ws) >= file_cosine]
        notice = min(((r[0], r[3]) for r in best_of.values()), default=None)
        best = ("file", *min(files)) if files else ("notice", *notice) if notice else None
        own.append((best, ",".join(sorted({r[3] for r in best_of.values()})), (path or "").rpartition("/")[0]))
    votes = {}
    for best, _, folder in own:
        if best and best[0] == "file":
            votes.setdefault(folder, Counter())[best[2]] += 1
    spoken = {d: min((-n, x) for x, n in c.items())[1] for d, c in votes.items()}
    out = []
    for (key, _, path), (best, notices, folder) in zip(rows, own, strict=True):
        parts = folder.split("/")
        above = ["/".join(parts[:n]) for n in range(len(parts), -1, -1)]
        heir = next(((d, spoken[d]) for d in above if d in spoken), None)
        if best:
            out.append((key, path or "", best[2], best[0], -best[1], notices, None))
        else:
            out.append((key, path or "", heir and heir[1], heir and "inherited", None, notices, heir and heir[0]))
    return out


def scanned(spark, rows):
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, path string, row int, term string")
    got = scan(docs, F.col("path"))
    assert got.columns == ["doc_id", "path", "license", "basis", "cosine", "notices", "from_dir"]
    return got.collect()


def wrapped(text, width, mark=""):
    lines, line = [], ""
    for word in text.split():
        if len(line) + len(word) > width:
            lines.append(mark + line)
            line = ""
        line += word + " "
    return "\n".join([*lines, mark + line])


def test_against_plain_loops(spark):
    rng = random.Random(1)
    notices = [n for _, n in NOTICES]
    rows = []
    for i in range(90):
        words = ["the", "code", "license", "lake", "of", "mit", "water", *(f"w{k}" for k in range(60))]
        body = [" ".join(rng.choice(words) for _ in range(rng.randrange(12))) for _ in range(rng.randrange(2, 6))]
        if i % 3 == 0:
            body.insert(rng.randrange(2), wrapped(rng.choice(notices).replace("the", rng.choice(["the", "a"])), rng.choice([30, 70, 500]), "# "))
        if i % 9 == 0:
            body = [wrapped(FILES[i % 3][1], 70), *body[: i % 2]]
        folder = rng.choice(["a", "a/b/c"] if i % 9 == 0 else ["a", "a/b", "a/b/c", "d/e", "f"])
        rows.append((i, "\n".join(body), f"{folder}/{i}" if folder else str(i)))
    rows += [(500, None, "a/b/x"), (501, "", "d/e/y"), (502, "w " * 20000, "a/z"), (503, "plain", None), (503, "plain", None), (None, notices[1], "q/r")]
    rows += [(504, "license\n" * 700 + notices[0], "q/s"), (505, "mit " * 400, "q/t")]
    want = plain_scan(rows)
    assert sorted(map(str, map(tuple, scanned(spark, rows)))) == sorted(map(str, want))
    assert {r[3] for r in want} == {"file", "notice", "inherited", None}


GPL_HEAD = dict((x[0], x[1]) for x in NOTICES if x[0] in ("GPL-3.0", "MPL-2.0", "Apache-2.0"))


def test_wrapped_heads_are_notices(spark):
    code = "\n".join(f"int water_{i} = level_{i} + {i};" for i in range(30))
    heads = {f"{n}{k}": (licence, mark) for n, licence in enumerate(GPL_HEAD) for k, mark in enumerate(["", "# ", " * ", "// "])}
    rows = []
    for n, (licence, mark) in heads.items():
        head = wrapped(GPL_HEAD[licence], 66, mark)
        rows += [(int(n), f"{mark}Copyright 2024 John Smith\n{head}\n\n{code}", f"r{n}/src/a.c"), (100 + int(n), code, f"r{n}/src/b.c")]
    got = {r.doc_id: r for r in scanned(spark, rows)}
    for n, (licence, _) in heads.items():
        mine = got[int(n)]
        assert (mine.license, mine.basis, mine.notices) == (licence, "notice", licence) and mine.cosine >= 0.95
        # A head speaks for its own file only.
        assert got[100 + int(n)].license is None


def test_a_line_or_junk_is_no_licence_file(spark):
    junk = "Enor, " * 1200 + "\nThis work is licensed under the GNU General Public License, version 3."
    rows = [(1, "Released under the MIT License. John Smith 2024", "r/a"), (2, junk, "r/b"), (3, "other", "r/x/c")]
    got = {r.doc_id: r for r in scanned(spark, rows)}
    assert got[1].basis in ("notice", None) and got[2].basis == "notice" and got[2].license == "GPL-3.0" and got[3].basis is None


@pytest.mark.skipif(not COMMON.is_dir(), reason="no licence files here")
def test_whole_licence_files_speak_for_their_directory(spark):
    files = {"GPL-3": "GPL-3.0", "GPL-2": "GPL-2.0", "Apache-2.0": "Apache-2.0", "LGPL-3": "LGPL-3.0", "MPL-2.0": "MPL-2.0", "BSD": "BSD-3-Clause"}
    rows = [(i, f"some other text {i} about lakes", f"s/{i}") for i in range(30)]
    for n, file in enumerate(files):
        rows += [(100 + n, (COMMON / file).read_text(), f"r{n}/LICENSE"), (200 + n, "int a;", f"r{n}/x/z.c")]
    got = {r.doc_id: r for r in scanned(spark, rows)}
    for n, licence in enumerate(files.values()):
        assert (got[100 + n].license, got[100 + n].basis) == (licence, "file")
        assert (got[200 + n].license, got[200 + n].basis, got[200 + n].from_dir) == (licence, "inherited", f"r{n}")
    assert got[3].license is None


def test_short_licences_with_a_name_and_a_year(spark):
    rows = []
    for n in range(3):
        text = wrapped(FILES[n][1].replace("(c)", "(c) 2024 Jane Doe <jane@example.org>"), 72)
        rows += [(n, text, f"r{n}/LICENSE"), (10 + n, "code", f"r{n}/x/z.c")]
    got = {r.doc_id: r for r in scanned(spark, rows)}
    for n in range(3):
        assert (got[n].license, got[n].basis, got[10 + n].license) == (FILES[n][0], "file", FILES[n][0])


def test_cosine_of_a_line_does_not_fall_with_the_corpus():
    line = words_of("Released under the MIT License. John Smith 2024")
    notice = words_of("Released under the MIT License.")
    seen = []
    for number in (10**5, 10**6, 10**9):
        share = {"the": 0.9, "under": 0.2, "released": 0.02, "license": 0.02, "mit": 0.01}
        weight = {w: idf(round(share[w] * number) if w in share else 1, number) for w in {*line, *notice}}
        a, b = vector(line, weight), vector(notice, weight)
        dot = sum(x * b.get(w, 0) for w, x in a.items())
        seen.append(dot / math.sqrt(sum(x * x for x in a.values()) * sum(x * x for x in b.values())))
    assert max(seen) - min(seen) < 0.01


def test_leading_terms_miss_nothing():
    rng = random.Random(2)
    for _ in range(300):
        template = {w: rng.uniform(1, 5) for w in rng.sample("abcdefghij", rng.randrange(1, 8))}
        lead = leading_terms([template], 0.8, {w: rng.randrange(9) for w in template})
        shared = sum(x * x for w, x in template.items() if w not in lead)
        assert shared / math.sqrt(shared * sum(x * x for x in template.values()) or 1) < 0.8


def test_weights():
    assert idf(3, 3) == 1 and idf(0, 10**5) == idf(9, 10**5) == 2 and 1 < idf(10, 1000) < idf(1, 1000) < 2
    assert vector(["a", "b", "a"], {"a": 1, "b": 2}) == {"a": 1 + math.log(2), "b": 2}


def test_empty_table(spark):
    assert scan(spark.createDataFrame([], "doc_id long, text string, path string"), F.col("path")).collect() == []
