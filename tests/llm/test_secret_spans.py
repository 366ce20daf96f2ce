import itertools
import random
import re
import string

import numpy as np
import pytest

from limnocast.llm import secret_spans
from limnocast.llm.secret_spans import (
    TOKEN,
    Field,
    Tagger,
    base_spans,
    features,
    file_shape,
    find_secrets,
    mask,
    shape,
    spans_of,
    train,
    windows_of,
    word,
)

SCHEMA = "doc_id long, text string, body string, hash long"


def plain_base(text):
    """The patterns as written, matched first and judged afterwards."""
    rules = [
        (r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
        (r"AKIA[A-Z0-9]+", 0, 20),
        (r"[0-9a-f]+", 0, 24),
    ]
    found = []
    for kind, (pattern, group, least) in enumerate(rules):
        found += [(m.start(), kind, m.end()) for m in re.finditer(pattern, text) if len(m[group]) >= least]
    return [(secret_spans.KINDS[kind], a, b) for a, kind, b in sorted(found)]


def prose(rng, number=60):
    words = ["the", "lake", "is", "calm", "Water", "token", "of", "2024", "levels", "internationally", "a.b", "x-ray", ",", ".", "\n", "14:30"]
    return " ".join(rng.choice(words) for _ in range(number))


def secret_text(rng, key="token = "):
    value = "".join(rng.choices("0123456789abcdef", k=40))
    return f'{prose(rng, 20)} {key}"{value}" {prose(rng, 20)}'


@pytest.fixture(scope="module")
def field():
    rng = random.Random(1)
    texts = [secret_text(rng, rng.choice(["token = ", "password: ", "api_key="])) for _ in range(120)] + [prose(rng) for _ in range(150)]
    return train([w for i, x in enumerate(texts) for _, w in windows_of(x, i)])


def test_patterns_equal_the_plain_ones():
    rng = random.Random(2)
    bits = ["password", "PassWD", "secret", "toKen", "apikey", "API_key", "AKIA", "AKIAAKIA", "0123456789abcdef", "ABCDEF0123", '"', "'", " ", "  ",
            ":", "=", "==", "a", "abcdefg", "\n", "é", "K", "ſ", "_", "x.y", "fade", "9"]
    hits = 0
    for _ in range(4000):
        text = "".join(rng.choice(bits) for _ in range(rng.randint(0, 14)))
        got = [s[:3] for s in base_spans(text)]
        assert got == plain_base(text), text
        hits += len(got)
    assert hits > 300
    # What fails is used up: the value is "secret", and "secret=" is not looked at again.
    assert base_spans("token=secre:abcdefghi") == [] and [s[:3] for s in base_spans("token:secret=abcdefghi")] == [("assign", 0, 22)]


def full_tags(field, text):
    """Viterbi over every token with features looked up by name."""
    tokens = TOKEN.findall(text)
    keys = [shape(t) for t in tokens]
    known = {n[-1] for n in field.weights if len(n) == 2 and isinstance(n[-1], str)}
    words = [w if (w := word(t)) in known else "" for t in tokens]
    best, paths = {0: 0.0}, {0: []}
    for t in range(len(tokens)):
        b, i = field.score(features(keys, words, t, file_shape(text)))
        now, then = {}, {}
        for to, own in ((0, 0.0), (1, b), (2, i)):
            score, tag = max((best[p] + field.moves[p, to], -p) for p in best)
            now[to], then[to] = score + own, paths[-tag] + [to]
        best, paths = now, then
    end = -max((best[p] + field.moves[p, 0], -p) for p in best)[1]
    return paths[end]


@pytest.mark.parametrize("seed", range(6))
def test_pruned_decoding_equals_full_decoding(field, seed):
    rng = random.Random(seed)
    noise = np.random.default_rng(seed)
    # A field with strong and odd transitions, so that runs matter.
    wild = Field({n: w + noise.normal(scale=0.6, size=2) for n, w in field.weights.items()}, noise.normal(scale=2.0, size=(3, 3)))
    some = 0
    for which, _ in itertools.product((field, wild), range(8)):
        text = secret_text(rng, rng.choice(["token = ", "Bearer ", ""])) + " ".join("".join(rng.choices(string.ascii_letters + string.digits, k=rng.randint(1, 30))) for _ in range(6))
        want = full_tags(which, text)
        got = [0] * len(want)
        for a, b in Tagger(which).tags(text):
            got[a:b] = [1] + [2] * (b - a - 1)
            if want[a] == 2 and (a == 0 or want[a - 1] == 0):
                got[a] = 2  # an inside after an outside begins a span
        assert got == want
        some += sum(map(bool, want))
    assert some


def test_gradient_fits_the_training_windows(field):
    rng = random.Random(8)
    texts = [secret_text(rng) for _ in range(30)]
    tagger = Tagger(field)
    for text in texts:
        (_, a, b), *_ = [s for s in spans_of(text, tagger) if s[0] == "hex"]
        found = [m.span() for m in TOKEN.finditer(text)]
        assert [(found[x][0], found[y - 1][1]) for x, y in tagger.tags(text)] == [(a, b)]


def test_finds_unseen_forms_and_leaves_clean_texts_alone(field):
    rng, tagger = random.Random(9), Tagger(field)
    caught = 0
    for _ in range(100):
        value = "Z" + "".join(rng.choices(string.ascii_letters + string.digits, k=rng.randint(24, 48))) + "7"
        text = f"{prose(rng, 15)} {rng.choice(['Bearer ', 'key ', 'use '])}{value} {prose(rng, 15)}"
        spans = [text[a:b] for kind, a, b in spans_of(text, tagger) if kind == "crf"]
        caught += spans == [value]
    assert caught >= 90
    assert not any(spans_of(prose(rng, 80), tagger) for _ in range(300))


def test_blocks_and_cache_change_nothing(field, monkeypatch):
    rng = random.Random(10)
    text = "\n".join(secret_text(rng, "see ").replace("9", "Z") for _ in range(40))
    want = spans_of(text, Tagger(field))
    monkeypatch.setattr(secret_spans, "BLOCK_CHARS", 50)
    monkeypatch.setattr(secret_spans, "CACHE_TOKENS", 7)
    assert spans_of(text, Tagger(field)) == want and any(s[0] == "crf" for s in want)


def test_nothing_to_learn_from_adds_nothing():
    tagger = Tagger(train([w for _, w in windows_of("only prose here, 123456789012", 1)]))
    assert spans_of("x " + "a1B2" * 10, tagger) == [] and spans_of("", tagger) == []


def test_mask():
    assert mask("ab token=abcdefg cd", [("assign", 3, 16), ("hex", 9, 16)]) == "ab " + "*" * 13 + " cd"


def test_operator_on_odd_rows(spark):
    rng = random.Random(11)
    rows = [(i, secret_text(rng, "token = "), "clash", i) for i in range(60)] + [(100 + i, prose(rng), "clash", 1) for i in range(60)]
    value = "Zx9" + "".join(rng.choices(string.ascii_letters + string.digits, k=30)) + "7"
    lost = f'{prose(rng, 30)} see "{value}" {prose(rng, 30)}'
    rows += [(500, None, "", 0), (501, "", "", 0), (None, rows[0][1], "", 0), (502, lost, "", 0), (0, rows[0][1], "clash", 0)]
    rows += [(503, "é😀 " * 400_000 + "AKIA" + "B2" * 10, "", 0)]
    out = find_secrets(spark.createDataFrame(rows, SCHEMA), with_masked=True).collect()
    assert len(out) == len(rows)
    texts = {}
    for key, text, *_ in rows:
        texts.setdefault(key, text or "")
    for row in out:
        spans = [tuple(s) for s in row["secrets"]]
        text = texts[row["doc_id"]]
        assert [s for s in spans if s[0] != "crf"] == plain_base(text)
        assert len(row["masked"]) == len(text)
        if row["doc_id"] is not None and 100 <= row["doc_id"] < 200:
            assert spans == []
    again = find_secrets(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()
    assert sorted(str(r["secrets"]) for r in again) == sorted(str(r["secrets"]) for r in out)
    assert find_secrets(spark.createDataFrame([], SCHEMA)).collect() == []
