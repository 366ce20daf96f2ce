import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer, pre_tokenizers

from limnocast.llm import sentence_pieces, word_tokens
from limnocast.llm.packing import best_fit, lower_bound, pack, pack_documents
from limnocast.llm.sentence_pieces import MergePieces, digest, digests, encode_documents
from limnocast.llm.word_tokens import WordTokens

PIECES, WORDS = public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("word_bpe_49k.json")
BITS = ["a", "B", "the", "é", "ß", " ", "  ", "\n", "\t", "'s", "'", "!", "1", "23", "²", "²."] + [
    "漢", "́", "İ", "<|endoftext|>", "\x1c", "\x85", " ", "▁", "😀", "<0x41>", "<s>", "\x00", "(", "Hello", "."
]


def random_texts(seed, number):
    rng = random.Random(seed)
    return ["".join(rng.choice(BITS) for _ in range(rng.randrange(25))) for _ in range(number)]


def test_pieces_equal_the_library():
    model, library = MergePieces(PIECES), sentencepiece.SentencePieceProcessor(model_file=PIECES)
    assert model.splits
    for text in random_texts(1, 1500) + ["x" * 300, " ".join(["word"] * 500), "", "abc" * 200]:
        run, shown, same = model.encode(text)
        ids = library.encode(text)
        assert same and run == ",".join(map(str, ids)) and shown == library.decode(ids), repr(text)


def test_both_agendas_agree():
    model = MergePieces(PIECES)
    for text in random_texts(2, 300):
        assert not text or model.merge(text) == model._spell(model._merge_many(text))


def test_pieces_over_block_borders_and_full_cache(monkeypatch):
    monkeypatch.setattr(sentence_pieces, "BLOCK_CHARS", 5)
    monkeypatch.setattr(sentence_pieces, "CACHE_SEGMENTS", 3)
    model, library = MergePieces(PIECES), sentencepiece.SentencePieceProcessor(model_file=PIECES)
    for text in random_texts(3, 200):
        ids = library.encode(text)
        assert model.encode(text)[:2] == (",".join(map(str, ids)), library.decode(ids))


def test_library_result_stands_where_they_differ(monkeypatch):
    model = MergePieces(PIECES)
    monkeypatch.setattr(model, "merge_all", lambda segments: [[5] for _ in segments])
    ids = model.library.encode("hello world")
    number, ids_sha, _, same = digest(model, "hello world")
    assert (number, same) == (len(ids), False)
    assert ids_sha == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()


def test_ids_are_those_of_the_digests(spark):
    rows = [(i, text) for i, text in enumerate(random_texts(5, 60))]
    for r in encode_documents(spark.createDataFrame(rows, "doc_id long, text string"), PIECES, with_ids=True).collect():
        assert r.n_tokens == len(r.ids) and r.ids_sha256 == hashlib.sha256(",".join(map(str, r.ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(r.decoded.encode()).hexdigest()


def test_batches_equal_single_texts():
    texts = [*random_texts(6, 400), None, "", "y" * 100, "x y" * 50]
    together, alone = list(digests(MergePieces(PIECES), texts)), MergePieces(PIECES)
    assert together == [digest(alone, text) for text in texts]


def test_encode_documents(spark):
    rows = [(1, None, 1), (1, None, 1), (None, "", 2), (2, "two words\n", 3)]
    out = encode_documents(spark.createDataFrame(rows, "doc_id long, text string, n_tokens int"), PIECES, with_ids=True)
    got = {r.doc_id: r for r in out.collect()}
    nothing = hashlib.sha256(b"").hexdigest()
    assert out.count() == 4 and (got[1].n_tokens, got[1].ids_sha256, got[1].decoded_sha256) == (0, nothing, nothing)
    assert got[2].decoded_sha256 == hashlib.sha256(b"two words\n").hexdigest() and got[2].decoded == "two words\n"
    assert encode_documents(spark.createDataFrame([], "doc_id long, text string"), PIECES).collect() == []


@pytest.mark.parametrize("block,cache", [(1 << 20, 300_000), (4, 3)])
def test_words_equal_the_library(monkeypatch, block, cache):
    monkeypatch.setattr(word_tokens, "BLOCK_CHARS", block)
    monkeypatch.setattr(word_tokens, "CACHE_WORDS", cache)
    words, library = WordTokens(WORDS), Tokenizer.from_file(WORDS)
    for text in random_texts(4, 1500):
        want = np.array(library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        assert words.ids(text) == want, repr(text)


def test_added_tokens_are_one_id():
    words, library = WordTokens(WORDS), Tokenizer.from_file(WORDS)
    for text in ("end <|endoftext|> next", "a<|startoftext|>b", "<|endoftext|><|endoftext|>", "<|ENDOFTEXT|>", "<|endoftext|", "é<|endoftext|>漢"):
        ids = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(words.ids(text), "<u4").tolist() == ids, text
    assert np.frombuffer(words.ids("end <|endoftext|> next"), "<u4").tolist() == [806, 49407, 1131]


def test_another_file_goes_to_the_library(tmp_path):
    changed = Tokenizer.from_file(WORDS)
    changed.pre_tokenizer = pre_tokenizers.Whitespace()
    changed.save(str(tmp_path / "other.json"))
    words = WordTokens(str(tmp_path / "other.json"))
    for text in ("it's a Test", "x<|endoftext|>y", ""):
        assert np.frombuffer(words.ids(text), "<u4").tolist() == changed.encode(text, add_special_tokens=False).ids


def test_lower_bound_is_one():
    rng = random.Random(5)
    for _ in range(200):
        capacity = rng.randrange(4, 40)
        sizes = np.array([rng.randrange(1, capacity + 1) for _ in range(rng.randrange(1, 9))])
        bound = lower_bound(np.bincount(sizes, minlength=capacity + 1))
        assert -(-sizes.sum() // capacity) <= bound <= fewest(sorted(sizes.tolist(), reverse=True), capacity)
    assert lower_bound(np.zeros(11, np.int64)) == 0
    assert lower_bound(np.bincount([6, 6, 6], minlength=11)) == 3


def fewest(sizes, capacity):
    """Fewest bins, by trying every bin for every item."""
    best = [len(sizes)]

    def place(i, rooms):
        if len(rooms) >= best[0]:
            return
        if i == len(sizes):
            best[0] = len(rooms)
            return
        for r in {room for room in rooms if room >= sizes[i]}:
            place(i + 1, [*rooms[: rooms.index(r)], r - sizes[i], *rooms[rooms.index(r) + 1 :]])
        place(i + 1, [*rooms, capacity - sizes[i]])

    place(0, [])
    return best[0]


def test_best_fit_takes_the_tightest_bin():
    bins, offsets = best_fit(np.array([6, 5, 4, 3, 2]), 10)
    assert bins.tolist() == [0, 1, 0, 1, 1] and offsets.tolist() == [0, 0, 6, 5, 8]


def valid(rows, capacity):
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


def test_pack_documents_against_the_library(spark):
    texts = [None, "", "one two", "word " * 700, "漢字 x " * 100, "a" * 3000] + random_texts(6, 40)
    rows = [(i // 2, t, 0, 0) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, piece int, _key int")
    got = pack_documents(docs, WORDS, 64).collect()
    library = Tokenizer.from_file(WORDS)
    want = []
    for i, text, *_ in rows:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 0]
        for n, at in enumerate(range(0, len(ids), 64)):
            part = ids[at : at + 64]
            want.append((i, n, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    assert sorted(tuple(r[:5]) for r in got) == sorted(want)
    assert valid(got, 64) >= got[0].bound
    assert pack_documents(spark.createDataFrame([], "doc_id long, text string"), WORDS).collect() == []


def test_exchanges_come_near_the_bound(spark):
    rng = random.Random(8)
    rows = [(rng.choice([30, 45, 55, 70, 20, 10, 100]),) for _ in range(600)]
    cut = spark.createDataFrame(rows, "length long")
    got = pack(cut, 100, group_tokens=1500).collect()
    assert len(got) == 600
    one = pack(cut, 100, group_tokens=10**9).collect()
    assert valid(one, 100) <= valid(got, 100) <= got[0].bound + 3
