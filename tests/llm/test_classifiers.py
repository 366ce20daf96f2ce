import random
import zlib

import numpy as np
import pytest

from limnocast.llm.boosting import fit
from limnocast.llm.language_id import BUCKETS, LanguageModel, identify, subwords, train
from limnocast.llm.quality import STATISTICS, score_quality, statistics


def test_trees_learn_and_agree_with_plain_traversal():
    rng = np.random.default_rng(1)
    rows = rng.normal(size=(3000, 5))
    target = ((rows[:, 0] > 0.3) ^ (rows[:, 3] < -0.2)).astype(float)
    trees = fit(rows[:2000], target[:2000])
    score = trees.score(rows)
    assert ((score >= 0.5) == target)[2000:].mean() > 0.97

    def walk(x, at):
        while trees.left[at] != at:
            at = trees.left[at] if x[trees.feature[at]] <= trees.cut[at] else trees.right[at]
        return trees.value[at]

    plain = [1 / (1 + np.exp(-trees.base - sum(walk(x, r) for r in trees.roots))) for x in rows[:50]]
    assert np.allclose(plain, score[:50])


def test_trees_without_rows_or_with_one_label():
    nothing = np.empty((0, 3))
    assert fit(nothing, np.empty(0)).score(np.zeros((2, 3))).tolist() == [0.5, 0.5]
    assert fit(np.zeros((9, 3)), np.ones(9)).score(np.zeros((1, 3)))[0] > 0.9
    assert len(fit(np.zeros((9, 3)), np.ones(9)).score(nothing)) == 0


def test_statistics_of_odd_texts():
    for text in (None, b"", b" \n\t", b"a", "é 漢".encode(), b"x" * 10**6, b"!!! $$$"):
        found = statistics(text)
        assert len(found) == len(STATISTICS) and np.isfinite(found).all()


def test_statistics_over_block_borders(monkeypatch):
    rng = random.Random(2)
    texts = ["".join(rng.choice("aB. \n$9") for _ in range(200)).encode() for _ in range(20)]
    whole = [statistics(t) for t in texts]
    monkeypatch.setattr("limnocast.llm.quality.BLOCK_BYTES", 11)
    assert [statistics(t) for t in texts] == whole


def prose(rng, words, n=60):
    return " ".join(rng.choice(words) for _ in range(n)) + "."


GOOD = ["water", "river", "stone", "green", "winter", "calm", "letter", "window"]


def test_quality_on_held_out_rows(spark):
    rng = random.Random(4)
    rows = []
    for i in range(400):
        bad = i % 4 == 0
        rows.append((i, prose(rng, ["$$$", "&&&", "@@", "x1"] if bad else GOOD), int(not bad)))
    docs = spark.createDataFrame([(i, t, 0, 0.5) for i, t, _ in rows] + [(None, None, 0, 0.5), (7, "", 0, 0.5)], "doc_id long, text string, predicted int, score double")
    labels = spark.createDataFrame([(i, q) for i, _, q in rows] + [(None, 1), (3, None)], "doc_id long, quality int")
    out = score_quality(docs, labels)
    got = out.collect()
    truth = {i: q for i, _, q in rows}
    assert len(got) == 402
    for r in got:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
    held = [r for r in got if r.held_out]
    assert len(held) > 40 and np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.97
    kept = score_quality(docs, labels, keep=("doc_id", "predicted", "text"))
    assert kept.columns == ["doc_id", "predicted", "text", "held_out", "score", "predicted"]


def test_quality_ignores_held_out_labels(spark):
    docs = spark.createDataFrame([(i, prose(random.Random(i), GOOD)) for i in range(60)], "doc_id long, text string")
    marks = [(i, int(i % 2)) for i in range(60)]
    flipped = [(i, 1 - q if zlib.crc32(str(i).encode()) % 5 == 0 else q) for i, q in marks]
    one, two = (score_quality(docs, spark.createDataFrame(m, "doc_id long, quality int")).collect() for m in (marks, flipped))
    assert sorted(one) == sorted(two)


def test_quality_of_empty_tables(spark):
    docs, labels = (spark.createDataFrame([], k) for k in ("doc_id long, text string", "doc_id long, quality int"))
    assert score_quality(docs, labels).collect() == []
    one = score_quality(spark.createDataFrame([(1, "a")], "doc_id long, text string"), labels).collect()
    assert [(r.score, r.predicted) for r in one] == [(0.5, 1)]


TONGUES = {"aa": ["kala", "tuma", "ruka", "mina"], "bb": ["éte", "ouri", "lèse", "queu"], "cc": ["strun", "pflem", "schka", "drift"]}


def test_languages_on_held_out_rows(spark):
    rng = random.Random(5)
    rows = [(i, prose(rng, TONGUES[lang], 30), lang, 1.0) for i, lang in enumerate(sorted(TONGUES) * 60)]
    rows += [(900, None, "aa", 1.0), (901, "12 %!", "aa", 1.0), (None, rows[0][1], None, 1.0), (902, "", None, 1.0), (0, rows[0][1], "aa", 1.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score double")
    got = identify(docs).collect()
    truth = {r[0]: r[2] for r in rows}
    assert len(got) == len(rows)
    for r in got:
        assert 0 <= r.score <= 1
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        if r.doc_id in (900, 901, 902):
            assert (r.lang_pred, r.score, r.rejected) == ("und", 0.0, True)
        elif r.doc_id is not None:
            assert r.lang_pred == truth[r.doc_id] and not r.rejected
    assert identify(docs, keep=("text", "score")).columns == ["text", "score", "held_out", "lang_pred", "score", "rejected"]


def test_languages_of_empty_tables(spark):
    kind = "doc_id long, text string, lang string"
    assert identify(spark.createDataFrame([], kind)).collect() == []
    got = identify(spark.createDataFrame([(1, "some words", None)], kind)).collect()
    assert [(r.lang_pred, r.score) for r in got] == [("und", 0.0)]


def test_what_looks_like_no_language_is_unsure():
    rng = random.Random(6)

    def buckets(text):
        found, n = np.unique(np.concatenate(list(subwords(text))), return_counts=True)
        return found, (n / n.sum()).astype(np.float32)

    model = train([(*buckets(prose(rng, words)), lang) for lang, words in TONGUES.items() for _ in range(80)])
    sure = model.probabilities(prose(rng, TONGUES["bb"])).max()
    assert sure > 0.9 > model.probabilities("zzz wxw vvv jjj").max()
    assert isinstance(model, LanguageModel) and 0 < model.least <= 0.5


def test_subwords_do_not_depend_on_blocks(monkeypatch):
    text = "abc défg " * 50
    whole = np.sort(np.concatenate(list(subwords(text))))
    assert whole.max() < BUCKETS
    monkeypatch.setattr("limnocast.llm.language_id.BLOCK_BYTES", 64)
    cut = np.concatenate(list(subwords(text)))
    # Blocks overlap, so a few n-grams at a border count twice and two touch the border.
    assert len(whole) <= len(cut) <= len(whole) * 1.5
    assert set(whole.tolist()) <= set(cut.tolist())
    assert list(subwords("")) == list(subwords(None)) == []


@pytest.mark.parametrize("text", ["", None, "1 2", "ß"])
def test_odd_texts_have_probabilities(text):
    model = train([(np.array([1]), np.array([1.0]), "x"), (np.array([2]), np.array([1.0]), "y")])
    assert np.isclose(model.probabilities(text).sum(), 1)


def tongue(rng, n):
    """Words of a made-up language: its own syllables."""
    syllables = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(3)) for _ in range(8)]
    return lambda: " ".join(rng.choice(syllables) + rng.choice(syllables) for _ in range(n))


def test_every_language_is_learned(spark):
    rng = random.Random(21)
    rows = []
    for k in range(300):
        speak = tongue(rng, 60)
        rows += [(len(rows) + i, speak(), f"l{k:03}") for i in range(9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(8)
    got = {r.doc_id: r for r in identify(docs).collect()}
    assert len({r.lang_pred for r in got.values()}) == 300
    held = [(r, lang) for i, _, lang in rows if (r := got[i]).held_out]
    assert sum(r.lang_pred == lang for r, lang in held) > 0.9 * len(held)


def test_the_sample_does_not_depend_on_order_repeats_or_null_ids(spark):
    rng = random.Random(22)
    speak = {lang: tongue(rng, 30) for lang in ("aa", "bb")}
    rows = [(None if i % 2 else i, speak[lang](), lang) for i in range(300) for lang in speak]
    rows += [rows[4]] * 400
    kind = "doc_id long, text string, lang string"
    found = []
    for seed, parts in ((1, 1), (2, 5)):
        random.Random(seed).shuffle(rows)
        docs = spark.createDataFrame(rows, kind).repartition(parts)
        found.append(sorted((str(r.doc_id), r.lang_pred, r.score) for r in identify(docs, train_docs=40).collect()))
    assert found[0] == found[1]


def test_bytes_of_the_sample_are_bounded(spark, monkeypatch):
    from limnocast.llm import language_id

    seen = []
    monkeypatch.setattr(language_id, "train", lambda docs: seen.append(docs) or train(docs))
    rng = random.Random(23)
    speak = {f"l{k}": tongue(rng, 200) for k in range(3)}
    rows = [(i, speak[lang](), lang) for i in range(40) for lang in speak]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    identify(docs, train_docs=90, train_bytes=60_000).count()
    size = sum(6 * len(buckets) for buckets, _, _ in seen[0])
    assert size <= 60_000 and len({lang for *_, lang in seen[0]}) == 3


def test_quality_takes_one_text_for_an_id(spark):
    rng = random.Random(24)
    good, bad = "The lake is calm and clear today. ", "$$$ !!! buy buy %%% "
    rows = [(i, (good if i % 2 else bad) * rng.randrange(3, 9)) for i in range(400)]
    rows += [(1, bad)] * 500 + [(1, good)] * 3
    labels = spark.createDataFrame([(i, i % 2) for i in range(400)], "doc_id long, quality int")
    found = []
    for parts in (1, 5):
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
        found.append(sorted((r.doc_id, r.score) for r in score_quality(docs, labels, train_rows=100).collect()))
    assert found[0] == found[1]
