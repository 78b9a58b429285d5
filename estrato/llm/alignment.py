"""Alignment of the tokens of two tokenizers over the same text.

A is a byte-level tokenizer of the tokenizers library, B a sentencepiece model with byte
fallback that puts a blank before a text; A gets the text with that blank. The ends of A's
tokens are taken from its character offsets, those of B's from the spans of its proto, as
coarse cuts. They are whole characters, so the tokens that share a character (parts of a
multibyte character in A, byte pieces in B) are refined by the bytes that each token decodes
to. Bytes where tokens of both end cut a text into groups; all tokens of a group are linked.

Texts are worked on stretch by stretch, where both tokenizers are known to cut: before a
blank or line end that follows a visible character. A's pattern starts a word there and no
piece of B holds such a place, which is checked when the model is loaded. The new stretches
of a block are joined to one text, whose tokens, cuts and groups are found on numpy arrays;
what a stretch gives is remembered in a bounded memory. A text whose tokens do not spell it in
full (B reads U+2581 as a blank) has no tokens, like a null or empty one.

How many documents hold a pair of ids linked is a count over the whole corpus. Documents are
read in blocks of bounded size: a block's pairs, with the number of its documents that hold
each, are summed by pair, and the sums return to the blocks, not to single documents. So a
pair in every document is sent once per block, and nothing is broadcast or gathered but one
block. A document keeps its pairs as places in its block's list. Repeated rows count each.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from estrato.llm.bpe import byte_letters, portions
from estrato.llm.common import arrow_ready, fields
from estrato.workspace import freeze

MOST_REMEMBERED = 300_000  # stretches; those met once make room for new ones
MOST_TOKENS = 2_000_000
PORTION = 1 << 18  # characters whose tokens are looked up at a time
BLOCK_CHARS = 1 << 20  # a block ends with the row that reaches this many characters
BLOCK_ROWS = 2048
SMALL = 256  # links of a group up to which they are listed before they are counted
PAIR = 1 << 32  # a pair of ids as one number: a * PAIR + b

# Stretches end before blanks and line ends that follow something visible, unless nothing
# visible follows. A text of white space only is one.
STRETCH = re.compile(r"\s*\S+(?:[^\S \n]\s*\S+)*(?:\s+\Z)?|\s+\Z")


class Ragged:
    """Lists of numbers of known lengths, end to end."""

    def __init__(self, values: np.ndarray, lengths: np.ndarray):
        self.values, self.lengths = values, lengths
        self.starts = np.cumsum(lengths) - lengths

    def __getitem__(self, rows: np.ndarray) -> Ragged:
        lengths = self.lengths[rows]
        shift = self.starts[rows] - (np.cumsum(lengths) - lengths)
        return Ragged(self.values[np.repeat(shift, lengths) + np.arange(lengths.sum())], lengths)

    @staticmethod
    def end_to_end(parts: list[Ragged]) -> Ragged:
        return Ragged(
            np.concatenate([p.values for p in parts]), np.concatenate([p.lengths for p in parts])
        )

    def joined(self, counts: np.ndarray) -> Ragged:
        """The same values with so many lists at a time made one."""
        ends = np.concatenate([[0], np.cumsum(self.lengths)])[np.cumsum(counts)]
        return Ragged(self.values, np.diff(ends, prepend=0))

    def arrow(self, kind: pa.DataType) -> pa.Array:
        offsets = np.concatenate([[0], np.cumsum(self.lengths)]).astype(np.int32)
        return pa.ListArray.from_arrays(offsets, pa.array(self.values).cast(kind))

    def packed(self, kind: str) -> pa.Array:
        """The lists as binaries of numbers of a numpy type."""
        data = self.values.astype(kind)
        offsets = np.concatenate([[0], np.cumsum(self.lengths)]) * data.itemsize
        return pa.Array.from_buffers(
            pa.binary(), len(self.lengths),
            [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data)],
        )


class Growing:
    """Numbers end to end with room behind them: adding copies what is new, seldom the rest."""

    def __init__(self, kind: type):
        self.room, self.size = np.empty(1024, kind), 0

    def add(self, new: np.ndarray) -> None:
        end = self.size + len(new)
        if end > len(self.room):
            room = np.empty(max(end, len(self.room) * 3 // 2), self.room.dtype)
            room[: self.size] = self.room[: self.size]
            self.room = room
        self.room[self.size : end] = new
        self.size = end

    def all(self) -> np.ndarray:
        return self.room[: self.size]


class Store(Ragged):
    """Lists to which more are added."""

    def __init__(self, kind: type):
        self._values, self._lengths, self._starts = map(Growing, (kind, np.int64, np.int64))

    values, lengths, starts = (
        property(lambda self, name=name: getattr(self, name).all())
        for name in ("_values", "_lengths", "_starts")
    )

    def add(self, part: Ragged) -> None:
        self._starts.add(part.starts + self._values.size)
        self._lengths.add(part.lengths)
        self._values.add(part.values)


NOTHING = Ragged(np.empty(0, np.int64), np.empty(0, np.int64))
# What a stretch has: ids of both tokenizers, how many of each make up its groups, and linked
# pairs with the number of their occurrences (a pair may stand in the list twice).
PARTS = ("a_ids", "b_ids", "a_sizes", "b_sizes", "pairs", "times")


def _stores() -> dict[str, Store]:
    return {name: Store(np.int64 if name in ("pairs", "times") else np.int32) for name in PARTS}


class Aligner:
    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        self.b = SentencePieceProcessor(model_file=path_b)
        byte_of = {letter: n for n, letter in enumerate(byte_letters())}
        vocab = self.a.get_vocab(with_added_tokens=False)
        if self.a.normalizer is not None:
            raise ValueError("the first tokenizer has to be byte-level, without normaliser")
        self.a_bytes = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            self.a_bytes[i] = bytes(byte_of.get(c, 0) for c in token)
        self.b_bytes = [
            bytes([int(self.b.id_to_piece(i)[3:-1], 16)]) if self.b.is_byte(i)
            else self.b.id_to_piece(i).replace("▁", " ").encode()
            for i in range(self.b.get_piece_size())
        ]
        self.a_lengths, self.b_lengths = (
            np.array([len(x) for x in table]) for table in (self.a_bytes, self.b_bytes)
        )
        self.cuts = self._b_cuts()
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.uses = np.empty(0, np.int64)
        self.unspelt: set[str] = set()
        self.parts = _stores()

    def _make_room(self) -> None:
        """Keeps the stretches met more than once, if they are few enough."""
        rows = np.flatnonzero(self.uses > 1)
        kept = {name: part[rows] for name, part in self.parts.items()}
        if len(rows) > MOST_REMEMBERED // 2 or len(kept["a_ids"].values) > MOST_TOKENS // 2:
            return self._forget()
        new = np.full(len(self.uses), -1)
        new[rows] = np.arange(len(rows))
        self.known = {s: at for s, at in zip(self.known, new.tolist()) if at >= 0}
        self.unspelt &= self.known.keys()
        self.uses = np.ones(len(rows), np.int64)
        self.parts = _stores()
        for name, part in kept.items():
            self.parts[name].add(part)

    def _b_cuts(self) -> bool:
        """Whether no piece of B holds a line end, or a blank after something else."""
        whole = [
            piece.decode() for i, piece in enumerate(self.b_bytes)
            if not (self.b.is_byte(i) or self.b.is_control(i) or self.b.is_unknown(i))
        ]
        return not any("\n" in p or " " in p.lstrip(" ") for p in whole)

    def align(self, texts: list[str | None]) -> dict[str, Ragged]:
        """What each text has, by the names in PARTS."""
        if len(self.known) > MOST_REMEMBERED or len(self.parts["a_ids"].values) > MOST_TOKENS:
            self._make_room()
        cut = [
            [] if not t else STRETCH.findall(f" {t}") if self.cuts else [f" {t}"] for t in texts
        ]
        self._learn(list(set().union(*cut).difference(self.known)))
        if self.unspelt:
            cut = [[] if self.unspelt.intersection(stretches) else stretches for stretches in cut]
        counts = np.array([len(stretches) for stretches in cut], np.int64)
        places = map(self.known.__getitem__, chain.from_iterable(cut))
        rows = np.fromiter(places, np.int64, counts.sum())
        self.uses += np.bincount(rows, minlength=len(self.uses))
        return {name: part[rows].joined(counts) for name, part in self.parts.items()}

    def _learn(self, stretches: list[str]) -> None:
        """Files stretches as rows of `parts`. Those that end in something visible can be
        read as one text; B reads U+2581 as a blank, so it stays out of that."""
        alone = [s for s in stretches if not self.cuts or s[-1].isspace() or "▁" in s]
        lone = set(alone)
        together = [s for s in stretches if s not in lone]
        found = self._read(together) if together else {}
        if found is None:
            alone, together = stretches, []
        added = [found] if together else []
        for s in alone:
            one = self._read([s])
            if one is None:
                self.unspelt.add(s)
                one = {name: Ragged(NOTHING.values, np.zeros(1, np.int64)) for name in PARTS}
            added.append(one)
        for s in [*together, *alone]:
            self.known[s] = len(self.known)
        self.uses = np.append(self.uses, np.zeros(len(stretches), np.int64))
        if added:
            for name, part in self.parts.items():
                part.add(Ragged.end_to_end([x[name] for x in added]))

    def _read(self, stretches: list[str]) -> dict[str, Ragged] | None:
        """The parts of stretches that make up one text; None if its tokens do not spell it."""
        text = "".join(stretches)
        data = text.encode()
        a, a_ends = self._a_tokens(text)
        b, b_ends = self._b_tokens(text)
        # A has no normaliser, so its bytes are the text's; B's are compared.
        if b"".join([self.b_bytes[i] for i in b.tolist()]) != data:
            return None
        both = np.intersect1d(a_ends, b_ends, assume_unique=True)
        a_to, b_to = np.searchsorted(a_ends, both) + 1, np.searchsorted(b_ends, both) + 1
        a_sizes, b_sizes = np.diff(a_to, prepend=0), np.diff(b_to, prepend=0)
        ends = np.cumsum([len(s) if s.isascii() else len(s.encode()) for s in stretches])
        groups = np.searchsorted(both, ends) + 1
        n_groups = np.diff(groups, prepend=0)
        owner, pairs, times = _links(a, b, a_sizes, b_sizes)
        linked = np.diff(np.searchsorted(owner, groups), prepend=0)
        return {
            "a_ids": Ragged(a, np.diff(a_to[groups - 1], prepend=0)),
            "b_ids": Ragged(b, np.diff(b_to[groups - 1], prepend=0)),
            "a_sizes": Ragged(a_sizes, n_groups), "b_sizes": Ragged(b_sizes, n_groups),
            "pairs": Ragged(pairs, linked), "times": Ragged(times, linked),
        }

    def _a_tokens(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Ids and end bytes. The end of a token is a clean cut unless the next one starts
        inside its last character."""
        coded = self.a.encode(text, add_special_tokens=False)
        ids = np.array(coded.ids, np.int64)
        spans = np.fromiter(chain.from_iterable(coded.offsets), np.int64, 2 * len(ids))
        spans = spans.reshape(-1, 2)
        coarse = spans[:, 1]
        if not text.isascii():
            data = np.frombuffer(text.encode(), np.uint8)
            coarse = np.append(np.flatnonzero(data & 0xC0 != 0x80), len(data))[coarse]
        clean = np.append(spans[1:, 0] >= spans[:-1, 1], True)
        return ids, _refined(coarse, clean, self.a_lengths[ids])

    def _b_tokens(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Ids and end bytes. The spans of B's proto are in bytes; of the byte pieces of one
        character only the last has a span. They are taken as lists (`offset_mapping`), which
        costs less than a proto's messages. B puts a blank before its text: it is the first of
        this one, or where that starts with a line end, a piece of its own."""
        blank = text[0] == " "
        found = self.b.encode(text[blank:].encode(), return_type="offset_mapping")
        ids = np.array(found["ids"], np.int64)
        ends = np.array([end for _, end in found["offsets"]], np.int64)
        clean = np.diff(ends, prepend=0) > 0
        if not blank:
            ids, ends, clean = ids[1:], ends[1:], clean[1:]
        return ids, _refined(ends + blank, clean, self.b_lengths[ids])


def _refined(coarse: np.ndarray, clean: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The coarse ends where they are clean; else the last clean one before, and the bytes
    that the tokens since then decode to."""
    total = np.cumsum(lengths)
    last = np.maximum.accumulate(np.where(clean, np.arange(len(clean)), -1))
    start = np.where(last >= 0, coarse[last] - total[last], 0)
    return np.where(clean, coarse, start + total)


def _links(
    a: np.ndarray, b: np.ndarray, a_sizes: np.ndarray, b_sizes: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Group, pair and number of occurrences, by group. Large groups are counted first."""
    a_starts, b_starts = np.cumsum(a_sizes) - a_sizes, np.cumsum(b_sizes) - b_sizes
    listed = np.flatnonzero(a_sizes * b_sizes <= SMALL)
    many = (a_sizes * b_sizes)[listed]
    owner = np.repeat(listed, many)
    nth = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
    pairs = a[a_starts[owner] + nth // b_sizes[owner]] * PAIR + b[
        b_starts[owner] + nth % b_sizes[owner]
    ]
    found = [(owner, pairs, np.ones(len(pairs), np.int64))]
    for g in np.flatnonzero(a_sizes * b_sizes > SMALL).tolist():
        x, times_x = np.unique(a[a_starts[g] : a_starts[g] + a_sizes[g]], return_counts=True)
        y, times_y = np.unique(b[b_starts[g] : b_starts[g] + b_sizes[g]], return_counts=True)
        pairs = (x[:, None] * PAIR + y).ravel()
        found.append((np.full(len(pairs), g), pairs, (times_x[:, None] * times_y).ravel()))
    owner, pairs, times = (np.concatenate(c) for c in zip(*found))
    if len(found) > 1:
        order = np.argsort(owner, kind="stable")
        owner, pairs, times = owner[order], pairs[order], times[order]
    return owner, pairs, times


_aligners: dict[tuple[str, str], Aligner] = {}


def aligner(path_a: str, path_b: str) -> Aligner:
    """One per Python worker, kept over its tasks."""
    if (path_a, path_b) not in _aligners:
        _aligners[path_a, path_b] = Aligner(path_a, path_b)
    return _aligners[path_a, path_b]


def ids_of(packed: bytes, count: int) -> np.ndarray:
    """The ids of a column such as `a_ids`, given their number."""
    return np.frombuffer(packed, "<u2" if len(packed) == 2 * count else "<u4")


INTS, LONGS = T.ArrayType(T.IntegerType()), T.ArrayType(T.LongType())
ALIGNED = [
    # Ids, little-endian, 16 bits each where the vocabulary allows it, else 32 (see `ids_of`),
    # and a byte per token: 1 on the last of a group.
    *fields("a_ids binary, b_ids binary, a_last binary, b_last binary"),
    *fields("n_a long, n_b long, n_groups long, n_links long, block long"),
    # What the document links: places in the list of its block, and how often.
    T.StructField("places", INTS), T.StructField("times", INTS),
]
# On one row of each block, which is no document.
LISTED = [T.StructField("pairs", LONGS), T.StructField("holders", INTS)]


@dataclass
class Alignment:
    """documents: the kept columns, tokens and groups as in ALIGNED, and references to the
    block's pairs. pairs: one row per block."""

    documents: DataFrame
    pairs: DataFrame


def align(
    docs: DataFrame, path_a: str, path_b: str, text: str = "text",
    keep: tuple[str, ...] = ("doc_id",),
    derive: tuple[str, Callable[[bytes, bytes, bytes, bytes], str]] | None = None,
) -> Alignment:
    """Aligns every text and stores the result; see `scored` for the corpus-wide counts.

    `derive` names a text column and the function of a_ids, b_ids, a_last and b_last that
    gives it; it is then stored in place of these four.
    """
    names = [f"__keep_{i}" for i in range(len(keep))]
    source = docs.select(*[F.col(c).alias(n) for c, n in zip(keep, names)],
                         F.col(text).alias("__text"))
    own = [T.StructField(n, source.schema[n].dataType) for n in names]
    tokens = ALIGNED[:4] if derive is None else [T.StructField(derive[0], T.StringType())]
    schema = T.StructType([*own, *tokens, *ALIGNED[4:], *LISTED])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = aligner(path_a, path_b)
        number = TaskContext.get().partitionId() << 33
        for rows in _blocks(batches):
            texts = rows.column(len(names)).to_pylist()
            found = [work.align(texts[p]) for p in portions([len(t or "") for t in texts], PORTION)]
            parts = {name: Ragged.end_to_end([x[name] for x in found]) for name in PARTS}
            columns = _block(parts, number, (len(work.a_bytes), len(work.b_bytes)))
            if derive is not None:
                made = [
                    None if a is None else derive[1](a, *rest)
                    for a, *rest in zip(*(c.to_pylist() for c in columns[:4]))
                ]
                columns = [pa.array(made, pa.string()), *columns[4:]]
            kept = [
                pa.concat_arrays([*c.chunks, pa.nulls(1, c.type)])
                for c in rows.columns[: len(names)]
            ]
            whole = [c.cast(f.type) for c, f in zip([*kept, *columns], arrow)]
            yield pa.RecordBatch.from_arrays(whole, schema=arrow)
            number += 1

    stored = freeze(arrow_ready(source).mapInArrow(run, schema), "alignment")
    documents = stored.where(F.col("pairs").isNull()).select(
        *[F.col(n).alias(c) for c, n in zip(keep, names)],
        *[f.name for f in (*tokens, *ALIGNED[4:])],
    )
    return Alignment(
        documents, stored.where(F.col("pairs").isNotNull()).select("block", "pairs", "holders")
    )


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Consecutive rows; the last column decides when a block is full."""
    waiting, size, count = [], 0, 0
    for batch in batches:
        lengths = [len(t or "") for t in batch.column(batch.num_columns - 1).to_pylist()]
        first = 0
        for i, length in enumerate(lengths):
            size, count = size + length, count + 1
            if size >= BLOCK_CHARS or count >= BLOCK_ROWS:
                yield pa.Table.from_batches([*waiting, batch.slice(first, i + 1 - first)])
                waiting, size, count, first = [], 0, 0, i + 1
        if first < len(lengths):
            waiting.append(batch.slice(first))
    if waiting:
        yield pa.Table.from_batches(waiting)


def _block(parts: dict[str, Ragged], number: int, ids: tuple[int, int]) -> list[pa.Array]:
    """The columns from `a_ids` on: the documents, and last the row of the block's pairs.
    `ids`: the sizes of the vocabularies."""
    linked = parts["pairs"]
    n = len(linked.lengths)
    pairs, places = np.unique(linked.values, return_inverse=True)
    keys = np.repeat(np.arange(n), linked.lengths) * len(pairs) + places
    keys, back = np.unique(keys, return_inverse=True)
    times = np.bincount(back, parts["times"].values, len(keys)).astype(np.int64)
    doc, places = (keys // len(pairs), keys % len(pairs)) if len(pairs) else (keys, keys)
    sizes = np.bincount(doc, minlength=n)
    links = np.bincount(doc, times, n).astype(np.int64)
    tokens = [
        parts[name].packed("<u2" if n_ids <= 1 << 16 else "<u4")
        for name, n_ids in zip(("a_ids", "b_ids"), ids)
    ]
    tokens += [_last(parts, side).packed("i1") for side in "ab"]
    counts = [parts[name].lengths for name in ("a_ids", "b_ids", "a_sizes")]
    own = [
        *tokens, *[pa.array(c) for c in (*counts, links, np.full(n, number))],
        Ragged(places, sizes).arrow(pa.int32()), Ragged(times, sizes).arrow(pa.int32()),
    ]
    own = [pa.concat_arrays([c, pa.nulls(1, c.type)]) for c in own]
    own[-3] = pa.array(np.full(n + 1, number))
    holders = np.bincount(places, minlength=len(pairs))
    listed = [
        pa.concat_arrays([
            pa.nulls(n, pa.list_(kind)), Ragged(x, np.array([len(x)])).arrow(kind)
        ])
        for x, kind in ((pairs, pa.int64()), (holders, pa.int32()))
    ]
    return [*own, *listed]


def _last(parts: dict[str, Ragged], side: str) -> Ragged:
    """A flag per token: it is the last of its group."""
    tokens = parts[f"{side}_ids"]
    flags = np.zeros(len(tokens.values), np.int8)
    flags[np.cumsum(parts[f"{side}_sizes"].values) - 1] = 1
    return Ragged(flags, tokens.lengths)


def pair_counts(pairs: DataFrame) -> DataFrame:
    """a_id, b_id, `held` (documents that hold the pair linked), `best` (no pair of the same
    a_id is held by more) over the whole corpus."""
    held = (
        pairs.select(F.explode(F.arrays_zip("pairs", "holders")).alias("p"))
        .groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.holders").alias("held"))
        .select("pair", F.floor(F.col("pair") / PAIR).alias("a_id"),
                (F.col("pair") % PAIR).alias("b_id"), "held")
    )
    held = freeze(held, "pairs")
    most = held.groupBy("a_id").agg(F.max("held").alias("most"))
    return held.join(most, "a_id").withColumn("best", F.col("held") == F.col("most")).drop("most")


def scored(documents: DataFrame, pairs: DataFrame) -> DataFrame:
    """`documents` of an `Alignment`, or rows that keep its block, places and times, with
    `n_best` (links whose pair is the best of its A id) and `count_sum` (sum of the counts of
    all links)."""
    listed = pairs.select("block", F.posexplode("pairs").alias("place", "pair"))
    # Count and flag as one number, so that a document's sums are plain arithmetic.
    number = F.shiftleft("held", 1) + F.col("best").cast("long")
    counted = (
        listed.join(pair_counts(pairs).select("pair", number.alias("number")), "pair")
        .groupBy("block")
        .agg(F.array_sort(F.collect_list(F.struct("place", "number"))).alias("__sorted"))
        .select("block", F.col("__sorted.number").alias("__numbers"))
    )

    def total(value) -> Column:
        links = F.zip_with(
            "places", "times", lambda place, times: times * value(F.get("__numbers", place))
        )
        return F.aggregate(links, F.lit(0).cast("long"), lambda a, x: a + x)

    sums = {
        "n_best": total(lambda n: n.bitwiseAND(F.lit(1).cast("long"))),
        "count_sum": total(lambda n: F.shiftright(n, 1)),
    }
    rows = documents.join(counted, "block", "left")
    names = [c for c in documents.columns if c not in ("block", "places", "times")]
    return rows.select(*names, *[value.alias(name) for name, value in sums.items()])
