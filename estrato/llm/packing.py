"""Vector bin packing of token sequences under limits on tokens, segments and loss tokens.

Each open bin has three remaining capacities. The dot-product heuristic puts next the
example whose demand vector, relative to the limits, has the largest product with what is
left, among those that fit; where none fits, the largest demand is cut to fill the bin, and
the rest waits as an example of its own. Full stretches of long examples fill bins at once.
A bin that has to close with tokens to spare is split at powers of two, which need no
padding, so the only loss is in the pieces themselves. Bins are filled from a bounded window
of examples within one input partition: no shuffle, bounded memory, and the same result when
a partition is computed again.

Which tokens bear loss is an argument: ranges of each text, such as the answers of
instruction data. Without ranges all do, so that the limits on tokens and loss are alike.

A null text has no tokens but the closing one. Texts of any length are packed whole. Repeated
rows are packed each. Sequence ids are unique: partition number times 2**33 plus a counter.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from unicodedata import normalize

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from estrato.llm.common import arrow_ready, fields, record

WINDOW = 256
END_ID = 2


@dataclass(frozen=True)
class Limits:
    tokens: int = 4096
    segments: int = 256
    loss_tokens: int = 4096


@dataclass
class Piece:
    """Tokens start to start + length of an example. Of those that bear loss in the example,
    all do here but the first of the piece, which nothing in the sequence predicts. `loss` is
    True or False for all tokens, or holds how many bear loss before each place."""

    example: int
    start: int
    length: int
    loss: bool | np.ndarray = True

    def losses(self, length: int) -> int:
        """Loss tokens of the first `length` tokens of the piece."""
        if isinstance(self.loss, bool):
            return max(length - 1, 0) if self.loss else 0
        return int(self.loss[self.start + length] - self.loss[self.start + min(length, 1)])

    @property
    def demand(self) -> tuple[int, int, int]:
        return self.length, 1, self.losses(self.length)

    def fitting(self, tokens: int, loss_tokens: int) -> int:
        """Length of the longest beginning within both limits."""
        if isinstance(self.loss, bool):
            return min(tokens, self.length, loss_tokens + 1 if self.loss else tokens)
        reach = self.loss[self.start : self.start + min(tokens, self.length) + 1]
        return int(np.searchsorted(reach, reach[min(1, len(reach) - 1)] + loss_tokens, "right")) - 1


class Packer:
    """Packs examples as they come; `take` and `close` yield finished bins (lists of pieces)."""

    def __init__(self, limits: Limits, window: int = WINDOW):
        self.limits, self.window = limits, window
        self.waiting: list[Piece] = []
        self.scale = np.array([limits.tokens, limits.segments, limits.loss_tokens], float)

    def take(
        self, example: int, length: int, loss: bool | np.ndarray = True
    ) -> Iterator[list[Piece]]:
        start = 0
        while start < length:
            rest = Piece(example, start, length - start, loss)
            most = rest.fitting(self.limits.tokens, self.limits.loss_tokens)
            if most == rest.length < self.limits.tokens:
                self.waiting.append(rest)
            else:
                yield from split_even([Piece(example, start, most, loss)], self.limits.tokens)
            start += most
        if len(self.waiting) >= self.window:
            yield from self._fill(self.window // 2)

    def close(self) -> Iterator[list[Piece]]:
        yield from self._fill(0)

    def _fill(self, keep: int) -> Iterator[list[Piece]]:
        """Close bins until at most `keep` examples wait."""
        while len(self.waiting) > keep:
            yield from split_even(self._bin(), self.limits.tokens)

    def _bin(self) -> list[Piece]:
        demands = np.array([p.demand for p in self.waiting], float)
        left, used, out = self.scale.copy(), np.zeros(len(demands), bool), []
        weights = demands / self.scale
        while True:
            fits = ~used & (demands <= left).all(axis=1)
            if not fits.any():
                break
            score = np.where(fits, weights @ (left / self.scale), -1.0)
            best = int(score.argmax())
            used[best] = True
            left -= demands[best]
            out.append(self.waiting[best])
        rest = [p for p, u in zip(self.waiting, used) if not u]
        if rest and left[0] > 0 and left[1] > 0:
            longest = max(range(len(rest)), key=lambda i: rest[i].length)
            p = rest[longest]
            n = min(p.fitting(int(left[0]), int(left[2])), p.length - 1)
            if n > 0:
                out.append(Piece(p.example, p.start, n, p.loss))
                rest[longest] = Piece(p.example, p.start + n, p.length - n, p.loss)
        self.waiting = rest
        return out


def split_even(pieces: list[Piece], tokens: int) -> Iterator[list[Piece]]:
    """The bin itself if it is full, else bins whose lengths are powers of two."""
    left = sum(p.length for p in pieces)
    if left == tokens:
        yield pieces
        return
    queue, at = list(pieces), 0
    while left:
        room = 1 << (left.bit_length() - 1)
        left -= room
        out = []
        while room:
            p = queue[at]
            n = min(room, p.length)
            out.append(Piece(p.example, p.start, n, p.loss))
            if n == p.length:
                at += 1
            else:
                queue[at] = Piece(p.example, p.start + n, p.length - n, p.loss)
            room -= n
        yield out


class WordTokens(dict):
    """Token ids of texts as little-endian 32-bit bytes, remembered stretch by stretch.

    The tokenizer drops white space and no token spans it, so the ids of a text are those of
    its stretches between blanks. A stretch of letters goes straight to the vocabulary's
    merges, one that ends in a mark is its stem and the mark, and any other through the
    whole tokenizer. The memory is bounded; it starts anew when full.
    """

    MOST = 800_000

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.encoder = Tokenizer.from_file(path)
        self.merges = self.encoder.model

    def __missing__(self, word: str) -> bytes:
        if word[-1:] in MARKS and word[:-1].isalpha() and word[:-1].lower().isalpha():
            ids = self[word[:-1]] + self[word[-1]]
        else:
            ids = self._ids(word)
        self[word] = ids
        return ids

    def _ids(self, word: str) -> bytes:
        if word.isalpha() and SIGMA not in word:
            plain = word.lower() if word.isascii() else normalize("NFC", word).lower()
            if plain.isalpha():
                letters = plain if plain.isascii() else "".join([AS_LETTERS[b] for b in plain.encode()])
                return np.array([t.id for t in self.merges.tokenize(letters)], "<u4").tobytes()
        ids = self.encoder.encode(word, add_special_tokens=False).ids
        return np.array(ids, "<u4").tobytes()

    def encode(self, text: str) -> bytes:
        if len(self) > self.MOST:
            self.clear()
        for blank in BLANKS:
            text = text.replace(blank, " ")
        return b"".join(map(self.__getitem__, text.split(" ")))


def loss_reach(tokens: bytes, words: WordTokens, text: str, ranges: list | None) -> np.ndarray:
    """How many tokens bear loss before each place of `tokens`, the ids of the text and the
    closing one. A token does if the stretch between blanks it belongs to overlaps one of the
    ranges (start, end) of code points; the closing one if the end of the text lies in one."""
    cover = np.zeros(len(text) + 2, np.int64)
    for span in ranges or []:
        if span is not None and span[0] is not None and span[1] is not None:
            low, high = (min(max(at, 0), len(text) + 1) for at in span)
            if low < high:
                cover[low] += 1
                cover[high] -= 1
    # The closing token stands behind the last character and shares its range.
    covered = np.concatenate([[0], np.cumsum(np.cumsum(cover)[: len(text)] > 0)])
    for blank in BLANKS:
        text = text.replace(blank, " ")
    marks, at = [np.zeros(1, bool)], 0
    for word in text.split(" "):
        bears = covered[at + len(word)] > covered[at]
        marks.append(np.full(len(words[word]) // 4, bears))
        at += len(word) + 1
    last = len(text) > 0 and covered[-1] > covered[-2]
    marks.append(np.array([last]))
    reach = np.cumsum(np.concatenate(marks))
    assert len(reach) == len(tokens) // 4 + 1
    return reach


# Blanks that the tokenizer takes as white space; the ones left out stay inside a stretch.
BLANKS = "\t\n\v\f\r"
MARKS = (".", ",")
SIGMA = "\u03a3"  # lower-cased by its place in the word here, never in the tokenizer


def _byte_letters() -> list[str]:
    """The letters that stand for bytes in a byte-level vocabulary: printable Latin-1 for
    itself, the other bytes in order from U+0100 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return [chr(b) if b in shown else chr(256 + hidden.index(b)) for b in range(256)]


AS_LETTERS = _byte_letters()
_encoders: dict[str, WordTokens] = {}


def encoder(path: str) -> WordTokens:
    """One per Python worker, kept over its tasks."""
    if path not in _encoders:
        _encoders[path] = WordTokens(path)
    return _encoders[path]


ADDED = fields(
    "start long, length long, token_ids binary, doc_tokens long, sequence_id long, offset long, "
    "loss_tokens long"
)


def pack(
    docs: DataFrame, tokenizer: str, limits: Limits = Limits(), doc_id: str = "doc_id",
    text: str = "text", carry: tuple[str, ...] = (), loss: str | None = None,
) -> DataFrame:
    """One row per piece: doc_id, the columns in `carry`, place in its document, its token
    ids (little-endian 32 bits), its sequence, the place there and its loss tokens.

    `loss` names a column of arrays of structs of two integers, start and end (exclusive) of
    the code points whose tokens bear loss; null and empty arrays mean none. Without it all
    tokens do."""
    keys = [doc_id, *carry]
    schema = T.StructType([docs.schema[c] for c in keys] + ADDED)
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(limits)
        tokens: dict[int, bytes] = {}
        keyed: dict[int, tuple] = {}
        to_come: dict[int, int] = {}
        count, sequence = 0, TaskContext.get().partitionId() << 33
        rows: list[tuple] = []

        def add(bins):
            nonlocal sequence
            for pieces in bins:
                offset = 0
                for p in pieces:
                    ids = tokens[p.example][4 * p.start : 4 * (p.start + p.length)]
                    rows.append((
                        *keyed[p.example], p.start, p.length, ids,
                        len(tokens[p.example]) // 4, sequence, offset, p.losses(p.length),
                    ))
                    offset += p.length
                    to_come[p.example] -= p.length
                    if not to_come[p.example]:
                        del tokens[p.example], keyed[p.example], to_come[p.example]
                sequence += 1

        def out():
            ready = record(arrow, rows)
            rows.clear()
            return ready

        for batch in batches:
            values = list(zip(*(batch.column(c).to_pylist() for c in keys)))
            texts = [t or "" for t in batch.column(text).to_pylist()]
            ranges = batch.column(loss).to_pylist() if loss else [None] * len(texts)
            for low in range(0, len(texts), 64):
                part = slice(low, low + 64)
                for value, whole, spans in zip(values[part], texts[part], ranges[part]):
                    words = encoder(tokenizer)
                    tokens[count] = words.encode(whole) + END_ID.to_bytes(4, "little")
                    keyed[count] = value
                    to_come[count] = len(tokens[count]) // 4
                    bears = True if loss is None else loss_reach(
                        tokens[count], words, whole, [s and tuple(s.values()) for s in spans or []]
                    )
                    add(packer.take(count, to_come[count], bears))
                    count += 1
                yield out()
        add(packer.close())
        yield out()

    used = list(dict.fromkeys([*keys, text, *([loss] if loss else [])]))
    return arrow_ready(docs.select(*used)).mapInArrow(run, schema)
