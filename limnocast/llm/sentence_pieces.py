"""SentencePiece encoding and decoding with a merge-type vocabulary.

A text is a row of symbols; an agenda holds the adjacent pairs that form a piece, best score first and
leftmost among equals, and merges them until none is left. A merge across two characters needs
a piece that holds them side by side, so the text falls apart exactly into segments between which no piece reaches;
equal segments are merged once and held. Every new segment of a batch is also encoded and decoded by the
sentencepiece library; where the two ever differ, the library's whole-text result stands and the row says so.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterable, Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACE = "▁"
#: Segments held in a generation, characters worked on at a time, and segments that go to the library in one text.
CACHE_SEGMENTS, BLOCK_CHARS, TOGETHER = 300_000, 1 << 20, 2000
#: Symbols up to which agendas are rows of ranks; the rank of a pair that is no piece; more than any symbol's number.
FEW, NO_RANK, WIDEST = 48, 1 << 31, 1 << 31


class MergePieces:
    """Encoder and decoder of one model file."""

    def __init__(self, path: str):
        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        model = self.library
        every = range(model.get_piece_size())
        self._bytes = {int(model.id_to_piece(i)[3:-1], 16): i for i in every if model.is_byte(i)}
        plain = [i for i in every if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        self._ids = {model.id_to_piece(i): i for i in plain}
        self._costs = {model.id_to_piece(i): -model.get_score(i) for i in plain}
        self._text = {i: piece for piece, i in self._ids.items()}
        self._byte_of = {i: value for value, i in self._bytes.items()}
        self._unknown = model.unk_id()
        self._joined = {a + b for piece in self._ids for a, b in pairwise(piece)}
        self._splitter = self._segments()
        # The model keeps texts as they are, but for a leading mark and marks in place of spaces.
        probe = " a  Ａ\t́b "
        self._as_is = model.normalize(probe) == SPACE + probe.replace(" ", SPACE)
        self._names = [str(i) for i in every]
        #: Segments with their ids as decimals and their text, of this generation and the one before.
        self._held: dict[str, tuple[str, str]] = {}
        self._older: dict[str, tuple[str, str]] = {}
        self._odd: set[str] = set()
        self._pair_table()

    def _segments(self) -> re.Pattern | None:
        """A pattern whose matches are segments, or none if pieces reach over space marks or line ends."""
        if any(b == SPACE and a != SPACE for a, b in self._joined) or any("\n" in pair for pair in self._joined):
            return None
        # A segment can start at a sign, unless before it stands one of the few characters that signs follow in pieces.
        signs = {c for pair in self._joined for c in pair if not c.isalnum() and c != SPACE}
        sticky = {a for a, b in self._joined if b in signs and a not in signs and a != SPACE}
        held, glue = ("".join(re.escape(c) for c in sorted(x)) or "\n" for x in (signs, sticky))
        word = f"(?:[^{held}{SPACE}\n]+|(?<=[{glue}])[{held}]+)+"
        return re.compile(f"{SPACE}*[{held}]*{word}|{SPACE}*[{held}]+|\n|{SPACE}+")

    def _pair_table(self) -> None:
        """Every split of a piece into two symbols, as sorted keys, with the piece and the order of its score."""
        # A symbol is a piece, or a character that is none and so stands above all pieces.
        self._first_odd = self.library.get_piece_size()
        self._symbols = self._first_odd + np.arange(0x110000, dtype=np.int64)
        for piece, i in self._ids.items():
            if len(piece) == 1:
                self._symbols[ord(piece)] = i
        order = {cost: n for n, cost in enumerate(sorted(set(self._costs.values())))}
        splits = []
        for piece, i in self._ids.items():
            for at in range(1, len(piece)):
                left, right = self._symbol(piece[:at]), self._symbol(piece[at:])
                if left is not None and right is not None:
                    splits.append((left * WIDEST + right, order[self._costs[piece]], i))
        splits.sort()
        keys, ranks, pieces = zip(*splits, strict=True) if splits else ((), (), ())
        # A last key that no pair reaches saves a test of the bounds.
        self._keys = np.array([*keys, np.iinfo(np.int64).max], np.int64)
        self._ranks = np.array([*ranks, NO_RANK], np.int64)
        self._pieces = np.array([*pieces, 0], np.int64)

    def _symbol(self, text: str) -> int | None:
        if text in self._ids:
            return self._ids[text]
        return int(self._symbols[ord(text)]) if len(text) == 1 else None

    def _look_up(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank and place in the table of adjacent pairs, as one number; pairs that are no piece have the rank NO_RANK."""
        key = left * WIDEST + right
        at = np.searchsorted(self._keys, key)
        return np.where(self._keys[at] == key, self._ranks[at], NO_RANK) * len(self._keys) + at

    def merge(self, segment: str) -> list[int]:
        """Ids of a segment: the best adjacent pair, leftmost among equals, is merged until there is none."""
        return self.merge_all([segment])[0]

    def merge_all(self, segments: list[str]) -> list[list[int]]:
        """Ids of segments. Short ones of a length are merged side by side, each with its own agenda."""
        out: list[list[int]] = [[]] * len(segments)
        lengths: dict[int, list[int]] = {}
        for i, segment in enumerate(segments):
            lengths.setdefault(len(segment), []).append(i)
        for length, places in lengths.items():
            if length > FEW:
                for i in places:
                    out[i] = self._spell(self._merge_many(segments[i]))
                continue
            raw = "".join([segments[i] for i in places]).encode("utf-32-le", "surrogatepass")
            grid = self._symbols[np.frombuffer(raw, "<u4")].reshape(len(places), length)
            for i, symbols in zip(places, self._merge_few(grid), strict=True):
                out[i] = symbols if max(symbols) < self._first_odd else self._with_odd(symbols)
        return out

    def _merge_few(self, grid: np.ndarray) -> list[list[int]]:
        """Symbols left of each row; a row's agenda is the row of the ranks of its pairs, and a step takes the least of each."""
        out: list[list[int]] = [[]] * len(grid)
        row, agenda = np.arange(len(grid)), self._look_up(grid[:, :-1], grid[:, 1:])
        size = len(self._keys)
        while len(grid):
            if grid.shape[1] > 1:
                # Of equal ranks the leftmost is first; the places in the table must not decide between them.
                at = (agenda // size).argmin(axis=1)
                best = agenda[np.arange(len(grid)), at]
                live = best < NO_RANK * size
            else:
                live = np.zeros(len(grid), bool)
            for i, symbols in zip(row[~live].tolist(), grid[~live].tolist(), strict=True):
                out[i] = symbols
            if not live.any():
                break
            if not live.all():
                row, grid, agenda, at, best = row[live], grid[live], agenda[live], at[live], best[live]
            each, width = np.arange(len(grid)), grid.shape[1]
            grid[each, at] = self._pieces[best % size]
            keep = np.ones(grid.shape, bool)
            keep[each, at + 1] = False
            grid = grid[keep].reshape(len(each), width - 1)
            keep = np.ones(agenda.shape, bool)
            keep[each, at] = False
            agenda = agenda[keep].reshape(len(each), width - 2)
            # The pairs on both sides of the new symbol are looked up anew.
            some = np.flatnonzero(at > 0)
            agenda[some, at[some] - 1] = self._look_up(grid[some, at[some] - 1], grid[some, at[some]])
            some = np.flatnonzero(at < width - 2)
            agenda[some, at[some]] = self._look_up(grid[some, at[some]], grid[some, at[some] + 1])
        return out

    def _with_odd(self, symbols: list[int]) -> list[int]:
        """Characters that are no piece as their bytes, or as unknown."""
        return self._spell([self._text[i] if i < self._first_odd else chr(i - self._first_odd) for i in symbols])

    def _merge_many(self, segment: str) -> list[str]:
        """A long agenda is a heap; entries whose symbols have changed since are passed over."""
        symbols: list[str | None] = list(segment)
        before, after = list(range(-1, len(symbols) - 1)), [*range(1, len(symbols)), -1]
        costs, agenda = self._costs, []

        def offer(left: int, right: int) -> None:
            if left >= 0 and right >= 0:
                piece = symbols[left] + symbols[right]
                if piece in costs:
                    heapq.heappush(agenda, (costs[piece], left, right, piece))

        for at in range(len(symbols) - 1):
            offer(at, at + 1)
        while agenda:
            _, left, right, piece = heapq.heappop(agenda)
            if symbols[left] is None or symbols[right] is None or symbols[left] + symbols[right] != piece:
                continue
            if after[left] != right:
                continue
            symbols[left], symbols[right] = piece, None
            after[left] = after[right]
            if after[right] >= 0:
                before[after[right]] = left
            offer(before[left], left)
            offer(left, after[left])
        return [x for x in symbols if x is not None]

    def _spell(self, symbols: list[str]) -> list[int]:
        ids: list[int] = []
        for symbol in symbols:
            if symbol in self._ids:
                ids.append(self._ids[symbol])
            elif self._bytes:
                ids.extend([self._bytes[value] for value in symbol.encode()])
            else:
                ids.append(self._unknown)
        return ids

    def surface(self, ids: list[int]) -> str:
        """The characters that ids stand for, space marks kept."""
        try:
            return "".join([self._text[i] for i in ids])
        except KeyError:
            parts = (self._text[i].encode() if i in self._text else bytes([self._byte_of[i]]) for i in ids)
            return b"".join(parts).decode("utf-8", "replace")

    def _learn(self, segments: list[str]) -> None:
        """Merge new segments and hold them; note those of which the library makes something else."""
        merged = self.merge_all(segments)
        # The library puts a space mark before a text, and no piece reaches over a line end: so segments go to it
        # in one text, each after a line end of its own, and only a text that differs is looked at segment by segment.
        fence, line = self.library.encode("\n"), self._ids["\n"] if "\n" in self._ids else self._bytes.get(10, self._unknown)
        for begin in range(0, len(segments), TOGETHER):
            part, ours = segments[begin : begin + TOGETHER], merged[begin : begin + TOGETHER]
            spoken = [self.surface(ids).replace(SPACE, " ") for ids in ours]
            whole = [*fence, *ours[0], *(i for ids in ours[1:] for i in (line, *ids))]
            theirs = self.library.encode("\n" + "\n".join(part).replace(SPACE, " "))
            same = theirs == whole and self.library.decode(theirs) == "\n" + "\n".join(spoken)
            for segment, ids, shown in zip(part, ours, spoken, strict=True):
                self._held[segment] = ",".join([self._names[i] for i in ids]), shown
                if not same:
                    alone = self.library.encode("\n" + segment.replace(SPACE, " "))
                    if fence + ids != alone or self.library.decode(alone) != "\n" + shown:
                        self._odd.add(segment)

    def _hold(self, segments: set[str]) -> None:
        """See that what all ``segments`` give is held. Those not used since the last but one generation are forgotten."""
        if len(self._held) > CACHE_SEGMENTS:
            self._older, self._held = self._held, {}
            self._odd.intersection_update(self._older)
        new = []
        for segment in segments.difference(self._held):
            if segment in self._older:
                self._held[segment] = self._older[segment]
            else:
                new.append(segment)
        if new:
            self._learn(sorted(new))

    def encode(self, text: str) -> tuple[str, str, bool]:
        """Ids as decimals joined by commas, the decoded text, and whether the library agrees on every segment."""
        return next(self.encode_all([text]))

    def encode_all(self, texts: Iterable[str]) -> Iterator[tuple[str, str, bool]]:
        """``encode`` of each text. Every text is split once, and the new segments of about a megabyte are learned at once."""
        runs, shown, same = [], [], True
        for last, segments in self._held_blocks(texts):
            if segments:
                held = [self._held[x] for x in segments]
                runs.append(",".join([x[0] for x in held]))
                shown.append("".join([x[1] for x in held]))
                same = same and self._odd.isdisjoint(segments)
            if last:
                yield ",".join(runs), "".join(shown)[1:], same  # without the leading mark
                runs, shown, same = [], [], True

    def _held_blocks(self, texts: Iterable[str]) -> Iterator[tuple[bool, list[str]]]:
        """Segments of every block of the texts, all held, and whether it is the last of its text."""
        waiting: list[tuple[bool, list[str]]] = []
        size = 0
        for text in texts:
            blocks = list(self._blocks(SPACE + text.replace(" ", SPACE))) if text else [""]
            for n, block in enumerate(blocks, 1):
                waiting.append((n == len(blocks), self._splitter.findall(block)))
                size += len(block)
                if size >= BLOCK_CHARS:
                    self._hold(set().union(*(segments for _, segments in waiting)))
                    yield from waiting
                    waiting, size = [], 0
        self._hold(set().union(*(segments for _, segments in waiting)))
        yield from waiting

    def _blocks(self, marked: str) -> Iterator[str]:
        begin = 0
        while begin < len(marked):
            end = begin + BLOCK_CHARS
            if end < len(marked):
                end = marked.find(SPACE, end)
                while 0 <= end and marked[end - 1] == SPACE:
                    end = marked.find(SPACE, end + 1)
                end = len(marked) if end < 0 else end
            yield marked[begin:end]
            begin = end

    @property
    def splits(self) -> bool:
        return self._splitter is not None and self._as_is


_loaded: dict[str, MergePieces] = {}


def pieces_of(path: str) -> MergePieces:
    """The model of a file, one per worker process."""
    if path not in _loaded:
        _loaded[path] = MergePieces(path)
    return _loaded[path]


def told_all(model: MergePieces, texts: Iterable[str | None]) -> Iterator[tuple[str, str, bool]]:
    """Ids and decoded text of each text, and whether they are the agenda's; else they are the library's."""
    texts = [text or "" for text in texts]
    found = model.encode_all(texts) if model.splits else (("", "", False) for _ in texts)
    for text, (run, shown, same) in zip(texts, found, strict=True):
        if not same:
            ids = model.library.encode(text)
            run, shown = ",".join(map(str, ids)), model.library.decode(ids)
        yield run, shown, same


def digests(model: MergePieces, texts: Iterable[str | None]) -> Iterator[tuple[int, str, str, bool]]:
    """Number of ids, SHA-256 of ids and of the decoded text, and whether the agenda's result stands."""
    for run, shown, same in told_all(model, texts):
        yield _digest(run, shown, same)


def _digest(run: str, shown: str, same: bool) -> tuple[int, str, str, bool]:
    sha = hashlib.sha256
    return run.count(",") + bool(run), sha(run.encode()).hexdigest(), sha(shown.encode()).hexdigest(), same


def digest(model: MergePieces, text: str | None) -> tuple[int, str, str, bool]:
    return next(digests(model, [text]))


def encode_documents(
    docs: DataFrame, model_file: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False
) -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256, agreed[, ids, decoded])`` for each row of ``docs``.

    Whole texts, no begin or end ids, no sampling. A null text is an empty one: no ids, and the digests of
    nothing. ``agreed`` is false where the library's result differed and was taken. ``ids`` and ``decoded`` are what the digests
    are of. Repeated rows and null ids each give a row; other columns are not read. An empty table gives an empty result.
    """
    names = ["id", "n_tokens", "ids_sha256", "decoded_sha256", "agreed", *(["ids", "decoded"] if with_ids else [])]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.bool_(), pa.list_(pa.int32()), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces_of(model_file)
        for batch in batches:
            rows = []
            found = told_all(model, batch["body"].to_pylist())
            for key, (run, shown, same) in zip(batch["id"].to_pylist(), found, strict=True):
                row = (key, *_digest(run, shown, same))
                rows.append((*row, [int(i) for i in run.split(",") if i], shown) if with_ids else row)
            columns = list(zip(*rows, strict=True)) or [[]] * len(names)
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=False)]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    schema = "id long, n_tokens long, ids_sha256 string, decoded_sha256 string, agreed boolean"
    narrow = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("body"))
    out = narrow.mapInArrow(run, schema + (", ids array<int>, decoded string" if with_ids else ""))
    return out.withColumnRenamed("id", id_col)
