"""Repeated substrings by common-prefix intervals of a sparse enhanced suffix array.

Removed is every byte covered by a string of LENGTH bytes that starts anywhere else too.

1. Anchors. Each window of LENGTH bytes names the least of its SEED-byte strings (by hash,
   leftmost on ties). Equal windows name the same place, so a repeated window shows as two
   equal anchors, and one position in about 75 is enough. An anchor owns the run of windows
   that name it; its region is their union.
2. Anchors whose seed occurs once are dropped. Those with equal seed and equal region are one
   class: all its occurrences are repeats, whatever their number.
3. The suffixes at the remaining anchors, one per class, are sorted within their seed: a
   suffix array of the places that matter, with its common-prefix lengths. A stack scan lists
   the intervals; inside each, members are told apart by what stands to their left. Members
   that share l bytes to the left and r to the right, with l + r >= LENGTH, are a maximal
   repeat (it ends on the right where the interval does, on the left where left extensions
   differ), and every occurrence is put out.
4. A seed with more than MOST_MEMBERS different regions is not sorted in one task; its
   windows are grouped by hash across the cluster, which finds the same bytes.

Hashes have 64 bits; those of equal regions stand for their bytes. Null and short texts have
no repeats. Repeated rows repeat each other. Long texts are read whole, in overlapping
stretches. Other columns pass through; `repeats` is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from estrato.llm.common import Texts, arrow_ready, record, row_key
from estrato.llm.words import _powers, mix
from estrato.workspace import freeze

LENGTH = 200
SEED = 48
SPAN = LENGTH - SEED + 1
STRETCH = 1 << 20
PLACE_BITS = 21
MOST_MEMBERS = 20_000


# -- anchors -----------------------------------------------------------------------------


def stretches(texts: Texts) -> Iterator[list[tuple[int, int, np.ndarray]]]:
    """(row, offset, bytes) in lots of about STRETCH bytes; every window is in one stretch."""
    lot, size = [], 0
    for i in range(len(texts)):
        data = texts[i]
        for offset in range(0, len(data) - LENGTH + 1, STRETCH):
            part = data[offset : offset + STRETCH + LENGTH - 1]
            if lot and size + len(part) > STRETCH:
                yield lot
                lot, size = [], 0
            lot.append((i, offset, part))
            size += len(part)
    if lot:
        yield lot


def _least_in_span(keys: np.ndarray, span: int = SPAN) -> np.ndarray:
    """Minimum of each `span` consecutive keys, by running minima over blocks."""
    n = len(keys) - span + 1
    rest = -len(keys) % span
    blocks = np.concatenate((keys, np.full(rest, np.uint64(2**64 - 1)))).reshape(-1, span)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[span - 1 : span - 1 + n])


def anchors_of(parts: list[np.ndarray]) -> tuple[np.ndarray, ...]:
    """Stretch, place, bytes owned to the left and right, seed hash, region hash."""
    data = np.concatenate(parts)
    ends = np.cumsum([len(p) for p in parts])
    up, down = _powers(1 << PLACE_BITS)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
    seeds = mix((sums[SEED:] - sums[:-SEED]) * down[: len(data) - SEED + 1])
    low = np.uint64((1 << PLACE_BITS) - 1)
    least = _least_in_span((seeds & ~low) | np.arange(len(seeds), dtype=np.uint64))
    inside = np.ones(len(least) + 1, bool)
    inside[-1] = False
    for end in ends[:-1]:
        inside[end - LENGTH + 1 : end] = False
    place = (least & low).astype(np.int64)
    same = np.zeros(len(least) + 1, bool)
    same[1:-1] = (place[1:] == place[:-1]) & inside[:-2]
    first = np.flatnonzero(inside[:-1] & ~same[:-1])
    last = np.flatnonzero(inside[:-1] & ~(same[1:] & inside[1:]))
    p = place[first]
    left, right = p - first, last + LENGTH - p
    region = (sums[last + LENGTH] - sums[first]) * down[first]
    region = mix(region + (left * 1024 + right).astype(np.uint64))
    return np.searchsorted(ends, p, "right"), p, left, right, seeds[p], region


ANCHOR = pa.schema([
    ("seed", pa.int64()), ("region", pa.int64()), ("row", pa.int64()), ("pos", pa.int64()),
    ("reach", pa.int32()),
])


def anchors(keyed: DataFrame) -> DataFrame:
    """One row per anchor; reach is 1024 * bytes owned to the left + bytes to the right."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column("row").to_numpy()
            for lot in stretches(Texts(batch.column("text"))):
                which, p, left, right, seed, region = anchors_of([x[2] for x in lot])
                begin = np.cumsum([0, *(len(x[2]) for x in lot[:-1])])
                offset = np.array([x[1] for x in lot]) - begin
                row = rows[np.array([x[0] for x in lot])]
                columns = (
                    seed.view(np.int64), region.view(np.int64), row[which], p + offset[which],
                    (left * 1024 + right).astype(np.int32),
                )
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], schema=ANCHOR)

    return arrow_ready(keyed).mapInArrow(
        run, "seed long, region long, row long, pos long, reach int"
    )


# -- the interval tree of one seed -------------------------------------------------------


def common(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    differ = int.from_bytes(a[:n], "big") ^ int.from_bytes(b[:n], "big")
    return n - (differ.bit_length() + 7) // 8


def intervals(prefixes: list[int]) -> Iterator[tuple[int, int, int]]:
    """(common prefix, first, last) of every interval of at least two suffixes.

    prefixes[i] is the common prefix of suffixes i and i + 1 in sorted order.
    """
    stack: list[tuple[int, int]] = []
    for i, r in enumerate([*prefixes, -1]):
        begin = i
        while stack and stack[-1][0] > r:
            depth, begin = stack.pop()
            yield depth, begin, i
        if r >= 0 and (not stack or stack[-1][0] < r):
            stack.append((r, begin))


def maximal_repeats(members: list[tuple[bytes, bytes]]) -> Iterator[tuple[int, int, int]]:
    """(member, l, r): with some other member it shares l bytes to the left of the anchor
    and r from it on, in a maximal repeat of at least LENGTH bytes.

    A member is the bytes to its left, reversed, and those from the anchor on.
    """
    order = sorted(range(len(members)), key=lambda i: members[i][1])
    prefixes = [common(members[i][1], members[j][1]) for i, j in zip(order, order[1:])]
    by_left = sorted(range(len(members)), key=lambda i: members[i][0])
    rank = [0] * len(members)
    for k, i in enumerate(by_left):
        rank[i] = k
    for r, first, last in intervals(prefixes):
        inside = sorted(order[first : last + 1], key=rank.__getitem__)
        shared = [common(members[i][0], members[j][0]) for i, j in zip(inside, inside[1:])]
        for k, i in enumerate(inside):
            l = max(shared[k - 1] if k else 0, shared[k] if k < len(shared) else 0)
            if l + r >= LENGTH:
                yield i, l, r


# -- the operator ------------------------------------------------------------------------


REGION = pa.schema([
    ("seed", pa.int64()), ("row", pa.int64()), ("pos", pa.int64()), ("n", pa.int64()),
    ("left", pa.binary()), ("right", pa.binary()),
])
REGION_DDL = "seed long, row long, pos long, n long, left binary, right binary"
FOUND = pa.schema([
    ("group", pa.int64()), ("row", pa.int64()), ("start", pa.int64()), ("end", pa.int64()),
])
FOUND_DDL = "group long, row long, start long, end long"


def _regions(keyed: DataFrame, wanted: DataFrame) -> DataFrame:
    """The bytes around each wanted anchor, read from its text."""
    places = wanted.groupBy("row").agg(F.collect_list(F.struct("seed", "pos", "reach", "n")).alias("places"))
    rows = keyed.join(places, "row").select("row", "text", "places")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, found = Texts(batch.column("text")), []
            rows, places = batch.column("row").to_pylist(), batch.column("places").to_pylist()
            for i, (row, anchors_) in enumerate(zip(rows, places)):
                data = texts[i].tobytes()
                for a in anchors_:
                    p, left, right = a["pos"], a["reach"] >> 10, a["reach"] & 1023
                    before = data[p - left : p][::-1]
                    found.append((a["seed"], row, p, a["n"], before, data[p : p + right]))
            yield record(REGION, found)

    return arrow_ready(rows).mapInArrow(run, REGION_DDL)


def _group_id(text: bytes) -> int:
    return int(np.uint64(xxhash.xxh3_64_intdigest(text)).view(np.int64))


def _by_intervals(regions: DataFrame) -> DataFrame:
    """Occurrences found by the interval tree of each seed, one seed after the other."""

    def scan(rows: list[tuple]) -> list[tuple]:
        members = [(r[4], r[5]) for r in rows]
        out = set()
        for i, l, r in maximal_repeats(members):
            _, row, pos, n, left, right = rows[i]
            if n == 1:
                out.add((_group_id(left[:l][::-1] + right[:r]), row, pos - l, pos + r))
        return list(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_rows: list[tuple] = []
        for batch in batches:
            found = []
            rows = zip(*(c.to_pylist() for c in batch.columns))
            for seed, group in groupby(rows, key=lambda r: r[0]):
                if open_rows and open_rows[0][0] != seed:
                    found += scan(open_rows)
                    open_rows = []
                open_rows += group
            yield record(FOUND, found)
        if open_rows:
            yield record(FOUND, scan(open_rows))

    ordered = regions.repartition("seed").sortWithinPartitions("seed")
    return ordered.mapInArrow(run, FOUND_DDL)


def _by_windows(regions: DataFrame) -> DataFrame:
    """The same bytes for crowded seeds: windows grouped by hash, with partial counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 64):
                found = []
                part = batch.slice(low, 64)
                for _, row, pos, n, left, right in zip(*(c.to_pylist() for c in part.columns)):
                    data, begin = left[::-1] + right, pos - len(left)
                    found += [
                        (_group_id(data[i : i + LENGTH]), row, begin + i, begin + i + LENGTH)
                        for i in range(len(data) - LENGTH + 1)
                    ]
                yield record(FOUND, found)

    windows = arrow_ready(regions).mapInArrow(run, FOUND_DDL)
    twice = windows.groupBy("group").agg(F.count("*").alias("n")).filter("n > 1")
    return windows.join(twice.select("group"), "group")


def occurrences(keyed: DataFrame, most_members: int = MOST_MEMBERS) -> DataFrame:
    """(group, row, start, end) in bytes: occurrences of repeats that cover every window of
    LENGTH bytes that starts more than once; `keyed` has (row, text)."""
    seeds = anchors(keyed).groupBy("seed").agg(
        F.count("*").alias("anchors"), F.min("region").alias("low"), F.max("region").alias("high"),
    ).filter("anchors > 1")
    seeds = seeds.select("seed", (F.col("low") == F.col("high")).alias("alike"))
    shared = freeze(anchors(keyed).join(seeds, "seed"), "shared-anchors")
    place = F.struct("row", "pos", "reach")
    classes = shared.filter("not alike").groupBy("seed", "region").agg(
        F.min(place).alias("first"), F.count("*").alias("n")
    )
    classes = freeze(classes.select("seed", "region", "first.*", "n"), "anchor-classes")
    crowds = classes.groupBy("seed").agg(F.count("*").alias("members"))
    crowded = freeze(crowds.filter(F.col("members") > most_members), "crowded-seeds")
    regions = freeze(_regions(keyed, classes), "anchor-regions")
    apart = _by_intervals(regions.join(crowded, "seed", "left_anti")).unionByName(
        _by_windows(regions.join(crowded, "seed", "left_semi"))
    )
    several = classes.filter("n > 1").select("seed", "region")
    alike = shared.filter("alike").select("region", "row", "pos", "reach").unionByName(
        shared.filter("not alike").join(several, ["seed", "region"])
        .select("region", "row", "pos", "reach")
    )
    return apart.unionByName(alike.select(
        F.col("region").alias("group"), "row",
        (F.col("pos") - F.shiftright("reach", 10)).alias("start"),
        (F.col("pos") + F.col("reach").bitwiseAND(1023)).alias("end"),
    ))


MERGED = pa.schema([
    ("row", pa.int64()),
    ("repeats", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
])
MERGED_DDL = "row long, repeats array<struct<start:long,end:long>>"


def merged(spans: list[dict]) -> list[dict]:
    """Sorted union of spans; touching ones become one."""
    out: list[dict] = []
    for span in sorted(spans, key=lambda s: s["start"]):
        if out and span["start"] <= out[-1]["end"]:
            out[-1]["end"] = max(out[-1]["end"], span["end"])
        else:
            out.append(dict(span))
    return out


def mark_repeats(docs: DataFrame, most_members: int = MOST_MEMBERS) -> DataFrame:
    """The rows with `repeats`: disjoint spans of bytes, in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = batch.column("spans").to_pylist()
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(map(merged, spans), type=MERGED.field(1).type)],
                schema=MERGED,
            )

    kept = [c for c in docs.columns if c != "repeats"]
    keyed = docs.select(row_key(F.col("doc_id"), F.col("text")).alias("row"), "text")
    spans = occurrences(keyed, most_members).groupBy("row").agg(
        F.collect_set(F.struct("start", "end")).alias("spans")
    )
    spans = freeze(arrow_ready(spans).mapInArrow(run, MERGED_DDL), "repeat-spans")
    rows = docs.select(*kept, row_key(F.col("doc_id"), F.col("text")).alias("__row"))
    none = F.array().cast("array<struct<start:long,end:long>>")
    return rows.join(spans, F.col("__row") == F.col("row"), "left").select(
        *kept, F.coalesce("repeats", none).alias("repeats")
    )
