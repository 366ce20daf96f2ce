"""Token ids of whole texts by a word-BPE file of the tokenizers library, word by word."""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Iterator

import numpy as np
from tokenizers import Tokenizer

#: Characters for which lower-casing and splitting below are those of the file, letter by letter.
_PLAIN = re.compile(r"[\t\n\r\x20-\x7eÀ-ÖØ-öø-ÿ]*")
#: The file's own split over those characters, after lower-casing. Fixed values.
_WORDS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\sa-zß-öø-ÿ0-9]+")
_SPACES = re.compile(r"[\t\n\r ]+")
#: Words held in a generation, and characters worked on at a time.
CACHE_WORDS, BLOCK_CHARS = 200_000, 1 << 20


#: The file's normalising and splitting steps that the patterns above stand for. Fixed values.
_NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
_SPLIT = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"


def _splits_as_above(file: dict) -> bool:
    """Whether a tokenizer file splits texts into words as the patterns do, and encodes each word by itself."""
    steps = (file.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
    plain = all(not (t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"]) for t in file["added_tokens"])
    return (
        plain
        and (file.get("normalizer") or {}).get("normalizers") == _NORMALIZERS
        and len(steps) == 2
        and (steps[0].get("pattern"), steps[0].get("behavior"), steps[0].get("invert")) == ({"Regex": _SPLIT}, "Removed", True)
        and (steps[1].get("type"), steps[1].get("add_prefix_space"), steps[1].get("use_regex")) == ("ByteLevel", False, False)
        and file["model"]["type"] == "BPE"
        and not file["model"].get("dropout")
    )


class WordTokens:
    """Ids as little-endian unsigned 32-bit words.

    The file drops white space and encodes each word by itself, so the ids of a text are those of its words in
    a row, and a word is encoded by the library only when it is not held yet. A stretch with other characters than
    plain ones goes to the library as a whole. Added tokens of the file, wherever they stand in a text, are one id and part it.
    Texts of a file that splits in another way go to the library whole.
    """

    def __init__(self, path: str):
        self._tokenizer = Tokenizer.from_file(path)
        # Words hold no added token, so for them the library need not look for any.
        self._of_words = Tokenizer.from_file(path)
        self._of_words.encode_special_tokens = True
        file = json.loads(self._tokenizer.to_str())
        self._by_words = _splits_as_above(file)
        self._added = {t["content"]: np.array([t["id"]], "<u4").tobytes() for t in file["added_tokens"]}
        longest_first = sorted(self._added, key=lambda t: (-len(t), t))
        self._parts = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")") if longest_first else None
        #: Ids of words of this generation and of the one before.
        self._held: dict[str, bytes] = {}
        self._older: dict[str, bytes] = {}

    def _learn(self, words: list[str]) -> None:
        """Hold the ids of new words: plain ones are encoded as one text, which falls apart at its spaces."""
        plain = [w for w in words if _PLAIN.fullmatch(w)]
        found = self._of_words.encode(" ".join(plain), add_special_tokens=False)
        ids, numbers = np.array(found.ids, "<u4"), np.array(found.word_ids, np.int64)
        ends = np.flatnonzero(np.diff(numbers, append=-1)) + 1
        if len(ends) != len(plain):
            raise ValueError("the tokenizer splits words that it should not")
        run = ids.tobytes()
        starts = ends - np.diff(ends, prepend=0)
        for word, start, end in zip(plain, (4 * starts).tolist(), (4 * ends).tolist(), strict=True):
            self._held[word] = run[start:end]
        rest = [w for w in words if w not in self._held]
        for word, one in zip(rest, self._of_words.encode_batch_fast(rest, add_special_tokens=False), strict=True):
            self._held[word] = np.array(one.ids, "<u4").tobytes()

    def _blocks(self, text: str) -> Iterator[str]:
        begin = 0
        while begin < len(text):
            end = begin + BLOCK_CHARS
            if end < len(text):
                space = _SPACES.search(text, end)
                end = space.start() if space else len(text)
            yield text[begin:end]
            begin = end

    def _words(self, block: str) -> list[str]:
        if _PLAIN.fullmatch(block):
            return _WORDS.findall(block.lower())
        out = []
        for part in _SPACES.split(block):
            if not _PLAIN.fullmatch(part):
                out.append(part)
            elif part:
                out += _WORDS.findall(part.lower())
        return out

    def ids(self, text: str | None) -> bytes:
        return next(self.ids_of([text]))

    def ids_of(self, texts: Iterable[str | None]) -> Iterator[bytes]:
        """Ids of each text. Every text is split once, and the new words of about a megabyte of texts are learned at once."""
        out: list[bytes] = []
        for last, words in self._held_blocks(texts):
            if isinstance(words, bytes):
                out.append(words)
            else:
                held = self._held
                out.append(b"".join([held[w] for w in words]))
            if last:
                yield b"".join(out)
                out = []

    def _split(self, text: str) -> Iterator[list[str] | bytes]:
        """Words of the blocks of a text, and ids where they are known without: of added tokens, or from the library."""
        if not self._by_words:
            yield np.array(self._tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        elif self._parts is None or not any(t in text for t in self._added):
            yield from map(self._words, self._blocks(text))
        else:
            for part in self._parts.split(text):
                if part in self._added:
                    yield self._added[part]
                else:
                    yield from map(self._words, self._blocks(part))

    def _held_blocks(self, texts: Iterable[str | None]) -> Iterator[tuple[bool, list[str] | bytes]]:
        """What every text splits into, all words held, and whether it is the last of its text."""
        waiting: list[tuple[bool, list[str] | bytes]] = []
        size = 0
        for text in texts:
            waiting += [(False, part) for part in self._split(text or "")]
            waiting.append((True, b""))
            size += len(text or "")
            if size >= BLOCK_CHARS:
                self._hold(set().union(*(part for _, part in waiting if not isinstance(part, bytes))))
                yield from waiting
                waiting, size = [], 0
        self._hold(set().union(*(part for _, part in waiting if not isinstance(part, bytes))))
        yield from waiting

    def _hold(self, words: set[str]) -> None:
        """See that the ids of all ``words`` are held. Those not used since the last but one generation are forgotten."""
        if len(self._held) > CACHE_WORDS:
            self._older, self._held = self._held, {}
        new = []
        for word in words.difference(self._held):
            if word in self._older:
                self._held[word] = self._older[word]
            else:
                new.append(word)
        for begin in range(0, len(new), 10_000):
            self._learn(new[begin : begin + 10_000])


_loaded: dict[str, WordTokens] = {}


def tokens_of(path: str) -> WordTokens:
    """The tokenizer of a file, one per worker process."""
    if path not in _loaded:
        _loaded[path] = WordTokens(path)
    return _loaded[path]
