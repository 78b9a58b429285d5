"""Repeated passages: runs of at least LENGTH words that stand in the corpus more than once,
wherever in a line they begin.

Hashed lines miss a passage whose copies are wrapped, edited or embedded differently. Words
are compared as lines compare them (ASCII lower case, any white space between). Found is every
window of LENGTH words that occurs again, in the same text or another.

1. Each window names the least of its SEED-word strings (by hash, leftmost on ties). Equal
   windows name the same place, so one anchor in about 20 words is enough. An anchor owns the
   run of windows that name it; its region is their union.
2. Anchors whose seed occurs once are dropped. Those with equal regions are one class, whose
   windows all repeat if it has several members.
3. Where a seed has several classes, the windows of the first member of each are compared by
   hash; whatever else the classes share shows there.
4. A window stays where it comes first, by (doc_id, 64-bit key of doc_id and text, place), and
   is removed elsewhere. Windows of one kind that overlap or touch are one passage.

Hashes have 64 bits and stand for their content. Rows equal in doc_id and text share their
occurrences, and each gets its passages. Null and short texts have none.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from estrato.llm.bpe import portions
from estrato.llm.common import Texts, arrow_ready, row_key
from estrato.llm.substrings import _least_in_span
from estrato.llm.words import Words, _powers, mix
from estrato.workspace import freeze

LENGTH = 51
SEED = 12
BLOCK = 1 << 18  # windows looked at together; a run of windows is cut there
PLACE_BITS = 20
PORTION = 1 << 22  # bytes of texts whose words are looked at together

_turns = lru_cache(maxsize=1)(lambda: _powers(1 << PLACE_BITS))

ANCHOR_DDL = (
    "doc_id long, key long, seed long, region long, at int, windows int, start int, end int"
)
ANCHOR = pa.schema([
    ("doc_id", pa.int64()), ("key", pa.int64()), ("seed", pa.int64()), ("region", pa.int64()),
    ("at", pa.int32()), ("windows", pa.int32()), ("start", pa.int32()), ("end", pa.int32()),
])
WINDOW_DDL = "doc_id long, key long, window long, at int, start int, end int, several boolean"
WINDOW = pa.schema([
    ("doc_id", pa.int64()), ("key", pa.int64()), ("window", pa.int64()), ("at", pa.int32()),
    ("start", pa.int32()), ("end", pa.int32()), ("several", pa.bool_()),
])


def _sums(hashes: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * _turns()[0][: len(hashes)], out=sums[1:])
    return sums


def _rolled(sums: np.ndarray, k: int) -> np.ndarray:
    """Hash of every k words in a row, whatever stands before them."""
    return mix((sums[k:] - sums[:-k]) * _turns()[1][: len(sums) - k])


class Places:
    """Where the words of a batch lie: in code points of their text."""

    def __init__(self, texts: Texts, words: Words):
        begin = int(texts.ends[0])
        points = np.zeros(int(texts.ends[-1]) - begin + 1, np.int64)
        np.cumsum((texts.data[begin : texts.ends[-1]] & 0xC0) != 0x80, out=points[1:])
        self.text = np.repeat(np.arange(len(texts)), np.diff(words.first))
        self.nth = np.arange(len(self.text)) - words.first[self.text]
        base = points[texts.ends[:-1] - begin][self.text]
        self.starts = points[words.starts - begin] - base
        self.stops = points[words.stops - begin] - base


def _lots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_pylist()
        for part in portions(sizes, PORTION):
            yield batch.slice(part.start, part.stop - part.start)


def anchors_of(
    words: Words, texts: np.ndarray, block: int = BLOCK
) -> Iterator[tuple[np.ndarray, ...]]:
    """By block: seed, region, first window (a word of the batch) and number of windows.
    `texts`: the text of each word."""
    span = LENGTH - SEED + 1
    for a in range(0, len(words.hashes) - LENGTH + 1, block):
        sums = _sums(words.hashes[a : a + block + LENGTH - 1])
        n = len(sums) - LENGTH
        low = np.uint64((1 << PLACE_BITS) - 1)
        seeds = _rolled(sums, SEED)
        least = _least_in_span((seeds & ~low) | np.arange(len(seeds), dtype=np.uint64), span)
        place = (least & low).astype(np.int64)
        inside = texts[a : a + n] == texts[a + LENGTH - 1 : a + LENGTH - 1 + n]
        same = np.zeros(n + 1, bool)
        same[1:-1] = (place[1:] == place[:-1]) & inside[1:] & inside[:-1]
        first = np.flatnonzero(inside & ~same[:-1])
        last = np.flatnonzero(inside & ~same[1:])
        region = (sums[last + LENGTH] - sums[first]) * _turns()[1][first]
        shape = (last - first) * LENGTH + place[first] - first
        region = mix(region + shape.astype(np.uint64) + np.uint64(1))
        yield seeds[place[first]], region, first + a, last - first + 1


def anchors(keyed: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row per anchor of `keyed` (doc_id, key, text): where its windows begin, in words,
    their number, and where its region lies, in code points."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _lots(batches):
            texts = Texts(batch.column("text"))
            words = Words(texts)
            if len(words.hashes) < LENGTH:
                continue
            places = Places(texts, words)
            for seed, region, first, windows in anchors_of(words, places.text, block):
                rows = pa.array(places.text[first])
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id").take(rows), batch.column("key").take(rows),
                    pa.array(seed.view(np.int64)), pa.array(region.view(np.int64)),
                    *(pa.array(x.astype(np.int32)) for x in (
                        places.nth[first], windows, places.starts[first],
                        places.stops[first + windows + LENGTH - 2],
                    )),
                ], schema=ANCHOR)

    return arrow_ready(keyed).mapInArrow(run, ANCHOR_DDL)


def _windows(keyed: DataFrame, classes: DataFrame, block: int) -> DataFrame:
    """One row per window of the first member of each class, read from its text."""
    wanted = classes.groupBy("key").agg(
        F.collect_list(F.struct("at", "windows", "several")).alias("wanted")
    )
    rows = keyed.join(wanted, "key").select("doc_id", "key", "text", "wanted")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _lots(batches):
            texts = Texts(batch.column("text"))
            words = Words(texts)
            places = Places(texts, words)
            lists = batch.column("wanted")
            sizes = np.diff(lists.offsets.to_numpy())
            at, windows, several = (
                c.to_numpy(zero_copy_only=False) for c in lists.flatten().flatten()
            )
            row = np.repeat(np.arange(len(sizes)), sizes)
            nth = np.arange(windows.sum()) - np.repeat(np.cumsum(windows) - windows, windows)
            word = np.repeat(words.first[row] + at, windows) + nth
            row, several = np.repeat(row, windows), np.repeat(several, windows)
            for a in range(0, len(words.hashes) - LENGTH + 1, block):
                hashes = _rolled(_sums(words.hashes[a : a + block + LENGTH - 1]), LENGTH)
                own = np.flatnonzero((word >= a) & (word < a + block))
                here, of = word[own], pa.array(row[own])
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id").take(of), batch.column("key").take(of),
                    pa.array(hashes[here - a].view(np.int64)),
                    *(pa.array(x.astype(np.int32)) for x in (
                        places.nth[here], places.starts[here], places.stops[here + LENGTH - 1]
                    )),
                    pa.array(several[own]),
                ], schema=WINDOW)

    return arrow_ready(rows).mapInArrow(run, WINDOW_DDL)


def _spans(keyed: DataFrame, block: int) -> DataFrame:
    """Runs of repeated windows (doc_id, key, at, windows, start, end, kept); each window of
    a row is in one of them."""
    found = anchors(keyed, block)
    seeds = found.groupBy("seed").agg(
        F.count("*").alias("n"), F.min("region").alias("low"), F.max("region").alias("high")
    ).filter("n > 1").select("seed", (F.col("low") == F.col("high")).alias("alike"))
    seeds = freeze(seeds, "passage-seeds")  # a join of exchanges only can be split
    shared = freeze(found.join(seeds, "seed").drop("seed"), "passage-anchors")
    place = F.struct("doc_id", "key", "at")
    classes = shared.groupBy("region").agg(
        F.min(F.struct("doc_id", "key", "at", "windows")).alias("first"),
        F.count("*").alias("members"), F.first("alike").alias("alike"),
    ).filter("members > 1 or not alike")
    classes = freeze(
        classes.select("region", "alike", "first.*", (F.col("members") > 1).alias("several")),
        "passage-classes",
    )
    firsts = classes.filter("several").select("region", place.alias("first"))
    whole = (
        shared.join(firsts, "region")
        .withColumn("kept", place.eqNullSafe(F.col("first"))).filter("alike or not kept")
        .select("doc_id", "key", "at", "windows", "start", "end", "kept")
    )
    windows = freeze(_windows(keyed, classes.filter("not alike"), block), "passage-windows")
    repeated = windows.groupBy("window").agg(
        F.min(place).alias("first"), F.count("*").alias("n"), F.max("several").alias("some")
    ).filter("n > 1 or some").select("window", "first")
    repeated = freeze(repeated, "repeated-windows")
    return whole.unionByName(windows.join(repeated, "window").select(
        "doc_id", "key", "at", F.lit(1).alias("windows"), "start", "end",
        place.eqNullSafe(F.col("first")).alias("kept"),
    ))


def passages(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row per repeated passage: doc_id, start, end (code points, end exclusive), words,
    kept (true where all its windows come first; false where all stand earlier too)."""
    keyed = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        row_key(F.col("doc_id"), F.col("text")).alias("key"), "text",
    )
    stop = F.col("at") + F.col("windows") + (LENGTH - 1)
    ordered = Window.partitionBy("doc_id", "key", "kept").orderBy("at")
    before = F.max("stop").over(ordered.rowsBetween(Window.unboundedPreceding, -1))
    spans = _spans(keyed, block).withColumn("stop", stop)
    runs = spans.withColumn("new", F.when(F.col("at") <= before, 0).otherwise(1)).withColumn(
        "run", F.sum("new").over(ordered.rowsBetween(Window.unboundedPreceding, 0))
    )
    found = runs.groupBy("doc_id", "key", "kept", "run").agg(
        F.min("start").alias("start"), F.max("end").alias("end"),
        (F.max("stop") - F.min("at")).cast("int").alias("words"),
    )
    copies = keyed.groupBy("key").agg(F.count("*").cast("int").alias("rows")).filter("rows > 1")
    each = F.explode(F.array_repeat(F.lit(0), F.coalesce("rows", F.lit(1))))
    return found.join(copies, "key", "left").select(
        "doc_id", "start", "end", "words", "kept", each.alias("copy")
    ).drop("copy")
