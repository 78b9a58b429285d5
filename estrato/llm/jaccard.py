"""N-gram Jaccard join: grouped prefix join over sets of word shingles.

Order and prefix. Shingles are 64-bit hashes, ordered by value. Let two sets be linked, U the
size of their union and D the number of shingles in only one of them. Among the first 2D + 2
shingles of the union at most D are not shared, so two shared ones are neighbours there, and
then in both sets. D is at most `spoiled(n)` for a set of n. So the prefix of a set is its
first 2 * spoiled(n) + 2 shingles, and its tokens are the pairs of neighbours in it: linked
sets share a token, while unrelated texts that share a frequent phrase hardly ever do.

1. Documents with equal sets are one class. Classes with identical prefix and size are one
   group, with one posting per token and task.
2. Tokens of several groups give lists of groups, the same list once per task; groups are
   expanded to classes there, and a group of several classes is a list too.
3. Round one pairs the members of a list with its middle one. Sizes and the distance of two
   sketches of 256 buckets, a lower bound for D, drop pairs before they leave the task; whole
   sets decide on the rest.
4. Round two takes from each list the members that size and sketch allow to be linked with
   one of another component. Lists that hang on one component are merged, so a class comes
   once to each component it is near, with its whole set. The merged list is decided there
   and puts out only links that join two components.

Every linked pair is in some list, so it is verified or connected when round two ends: the
components are exact. No pair that is no link leaves a task of round two, and a list puts out
fewer links than it has members, so rows grow with the lists and not with their square.

Null or empty text, or one without words, has an empty set and is linked with nothing. Rows
that share a doc_id, or have none, are judged each by its own text. Long texts enter whole; other columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from estrato.llm.common import Texts, arrow_ready, fields, record, row_key
from estrato.llm.graph import connected
from estrato.llm.words import Words, mix, shingle_sets
from estrato.workspace import freeze

BUCKETS = 256
# Shingles of a list that one pass over its members holds as codes.
BLOCK_SHINGLES = 1 << 21
# Members of a hub's own component that one part of its list holds.
PART_MEMBERS = 2000


@dataclass(frozen=True)
class Likeness:
    """Linked when whole * intersection >= part * union, over shingles of `words` words."""

    words: int = 5
    part: int = 80
    whole: int = 100

    def __post_init__(self):
        if 4 * self.part < 3 * self.whole:
            raise ValueError("the prefix is proven for a likeness of 0.75 and more")

    def spoiled(self, n: int) -> int:
        """Shingles that a set of n and one linked with it can hold one without the other."""
        return (self.whole - self.part) * n // self.part

    def prefix(self, hashes: np.ndarray) -> np.ndarray:
        """Empty where only equal sets can be linked."""
        spoiled = self.spoiled(len(hashes))
        return hashes[: 2 * spoiled + 2 if spoiled else 0]

    def near(self, difference, n_a, n_b):
        """Can sets of these sizes that differ in so many shingles be linked?"""
        return difference * (self.whole + self.part) <= (n_a + n_b) * (self.whole - self.part)


# -- signatures and postings -------------------------------------------------------------


def _sets(batch: pa.RecordBatch, like: Likeness) -> Iterator[tuple[int, list[np.ndarray]]]:
    column = batch.column("text")
    for low in range(0, len(column), 64):
        yield low, shingle_sets(Words(Texts(column.slice(low, 64))), like.words)


def _hash64(data: bytes) -> int:
    return int(np.uint64(xxhash.xxh3_64_intdigest(data)).view(np.int64))


def _class_id(hashes: np.ndarray) -> int:
    return _hash64(hashes.tobytes())


def _group_id(hashes: np.ndarray, like: Likeness) -> int:
    """31 bits for prefix and size; groups that collide are one group, which costs pairs but
    loses none."""
    prefix = like.prefix(hashes)
    if not len(prefix):
        prefix = hashes
    return xxhash.xxh3_64_intdigest(prefix.tobytes(), seed=len(hashes)) >> 33


def signatures(docs: DataFrame, like: Likeness) -> DataFrame:
    """Per row: doc_id, key, n, class, group and sketch (null for an empty set)."""
    schema = T.StructType([
        docs.schema["doc_id"], *fields("key long, n int, class long, group long, sketch binary")
    ])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys, rows = *(batch.column(c).to_pylist() for c in ("doc_id", "key")), []
            for low, sets in _sets(batch, like):
                for i, s in enumerate(sets):
                    if len(s):
                        sketch = np.bincount((s & np.uint64(BUCKETS - 1)).astype(np.int64), minlength=BUCKETS)
                        rows.append((
                            ids[low + i], keys[low + i], len(s), _class_id(s), _group_id(s, like),
                            sketch.astype(np.uint8).tobytes(),
                        ))
                    else:
                        rows.append((ids[low + i], keys[low + i], 0, None, None, None))
            yield record(arrow, rows)

    return arrow_ready(
        docs.select("doc_id", row_key(F.col("doc_id"), F.col("text")).alias("key"), "text")
    ).mapInArrow(run, schema)


POSTING = pa.schema([("token", pa.int64()), ("entry", pa.int64())])


def postings(docs: DataFrame, like: Likeness) -> DataFrame:
    """(token, entry) once per group and task; entry is n * 2**31 + group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for batch in batches:
            tokens, entries = [], []
            for _, sets in _sets(batch, like):
                for s in sets:
                    prefix = like.prefix(s)
                    if not len(prefix):
                        continue
                    key = _hash64(prefix.tobytes()) ^ len(s)
                    if key not in seen:
                        seen.add(key)
                        tokens.append(mix(prefix[:-1] * np.uint64(3) + prefix[1:]))
                        entry = len(s) << 31 | _group_id(s, like)
                        entries.append(np.full(len(prefix) - 1, entry, np.int64))
            if tokens:
                columns = np.concatenate(tokens).view(np.int64), np.concatenate(entries)
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], schema=POSTING)

    return arrow_ready(docs.select("text")).mapInArrow(run, "token long, entry long")


# -- lists -------------------------------------------------------------------------------


LISTED = pa.schema([("list", pa.int64()), ("group", pa.int64())])


def listed(posted: DataFrame) -> DataFrame:
    """(list, group) for the tokens that several groups share, each list once per task."""

    def scan(tokens: np.ndarray, entries: np.ndarray, seen: set[int]) -> list[tuple]:
        fresh = np.ones(len(tokens), bool)
        fresh[1:] = (tokens[1:] != tokens[:-1]) | (entries[1:] != entries[:-1])
        tokens, entries = tokens[fresh], entries[fresh]
        first = np.flatnonzero(np.concatenate(([True], tokens[1:] != tokens[:-1])))
        sizes = np.diff(first, append=len(tokens))
        rows = []
        for a, m in zip(first[sizes > 1].tolist(), sizes[sizes > 1].tolist()):
            key = _hash64(entries[a : a + m].tobytes())
            if key not in seen:
                seen.add(key)
                rows += [(key, g) for g in (entries[a : a + m] & (2**31 - 1)).tolist()]
        return rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        tokens = entries = np.empty(0, np.int64)
        for batch in batches:
            tokens = np.concatenate((tokens, batch.column(0).to_numpy()))
            entries = np.concatenate((entries, batch.column(1).to_numpy()))
            # The last token's list may go on in the next batch.
            whole = int(np.searchsorted(tokens, tokens[-1])) if len(tokens) else 0
            if whole:
                yield record(LISTED, scan(tokens[:whole], entries[:whole], seen))
                tokens, entries = tokens[whole:], entries[whole:]
        if len(tokens):
            yield record(LISTED, scan(tokens, entries, seen))

    ordered = posted.repartition("token").sortWithinPartitions("token", "entry")
    return ordered.mapInArrow(run, "list long, group long")


PAIR = pa.schema([("a", pa.int64()), ("b", pa.int64())])
OPEN = pa.schema([("hub", pa.int64()), ("class", pa.int64()), ("root", pa.int64())])


def class_lists(docs: DataFrame, classes: DataFrame, like: Likeness) -> DataFrame:
    """(list, group) of all lists; a group of several classes is a list too."""
    several = classes.groupBy("group").agg(F.count("*").alias("k")).filter("k > 1")
    return listed(postings(docs, like)).unionByName(
        several.select((-F.col("group") - 1).alias("list"), "group")
    ).distinct()


# -- pairs -------------------------------------------------------------------------------


@dataclass(frozen=True)
class Members:
    """The classes of one list by size: class, root, n and sketch."""

    classes: np.ndarray
    roots: np.ndarray
    sizes: np.ndarray
    sketches: np.ndarray

    @staticmethod
    def of(rows: list[tuple]) -> "Members":
        columns = (np.array([r[i] for r in rows], np.int64) for i in (1, 2, 3))
        sketches = np.frombuffer(b"".join(r[4] for r in rows), np.uint8)
        return Members(*columns, sketches.reshape(-1, BUCKETS))

    def near(self, i: int, others: np.ndarray, like: Likeness) -> np.ndarray:
        """Those of the other members with another root that size and sketch allow."""
        n, m = self.sizes[others], self.sizes[i]
        sized = (like.part * np.maximum(n, m) <= like.whole * np.minimum(n, m))
        others, found = others[sized & (self.roots[others] != self.roots[i])], []
        for low in range(0, len(others), 4096):
            some = others[low : low + 4096]
            apart = self.sketches[some] - self.sketches[i]
            apart = np.minimum(apart, -apart).sum(axis=1, dtype=np.int64)
            found.append(some[like.near(apart, self.sizes[some], self.sizes[i])])
        return np.concatenate(found) if found else others

    def middle(self) -> int:
        """The member nearest to the list's mean sketch."""
        mean = np.zeros(BUCKETS)
        for low in range(0, len(self.classes), 4096):
            mean += self.sketches[low : low + 4096].sum(axis=0)
        mean = (mean / len(self.classes)).round().astype(np.int16)
        return int(np.argmin([int(np.abs(s.astype(np.int16) - mean).sum()) for s in self.sketches]))

    def middle_pairs(self, like: Likeness) -> list[tuple[int, int]]:
        i = self.middle()
        c = int(self.classes[i])
        others = self.classes[self.near(i, np.arange(len(self.classes)), like)]
        return [(min(c, o), max(c, o)) for o in others.tolist()]

    def open_members(self, like: Likeness) -> list[tuple[int, int, int]]:
        """(hub, class, root) of the members that may be linked with one of another root; the
        middle one has been tried with all. The hub is the root that most of them have."""
        middle, open_ = self.middle(), np.zeros(len(self.classes), bool)
        for i in range(len(self.classes) - 1):
            end = np.searchsorted(self.sizes, like.whole * self.sizes[i] // like.part, "right")
            found = self.near(i, np.arange(i + 1, end), like)
            found = found[found != middle]
            if i != middle and len(found):
                open_[i] = True
                open_[found] = True
        if not open_.any():
            return []
        names, times = np.unique(self.roots[open_], return_counts=True)
        hub = int(names[np.argmax(times)])
        return [(hub, c, r) for c, r in zip(self.classes[open_].tolist(), self.roots[open_].tolist())]


def spanning_links(
    classes: list[int], roots: list[int], sets: list[np.ndarray], like: Likeness
) -> list[tuple[int, int]]:
    """Links that connect all linked members of a list, none between members connected before.

    Whole sets decide. Members of the largest component are not tried with each other; every
    link returned joins two components, so there are fewer links than members.
    """
    _, part, size = np.unique(np.array(roots, np.int64), return_inverse=True, return_counts=True)
    order = np.argsort(part == np.argmax(size), kind="stable")
    probes = len(order) - int(size.max())
    part, sets = part[order], [sets[i] for i in order]
    classes = [classes[i] for i in order]
    n = np.array([len(s) for s in sets], np.int64)
    links: list[tuple[int, int]] = []
    low = 0
    while low < len(sets):
        high = max(low + 1, int(np.searchsorted(np.cumsum(n[low:]), BLOCK_SHINGLES, "right")) + low)
        flat = np.concatenate(sets[low:high])
        words = np.unique(flat)
        codes = np.searchsorted(words, flat).astype(np.int32)
        starts = np.concatenate(([0], np.cumsum(n[low:high])[:-1]))
        held = np.zeros(len(words), bool)
        for j in range(min(probes, high - 1)):
            first = max(low, j + 1)
            if (part[first:high] == part[j]).all():
                continue
            at = np.minimum(np.searchsorted(words, sets[j]), len(words) - 1)
            at = at[words[at] == sets[j]]
            held[at] = True
            begin = starts[first - low]
            common = np.add.reduceat(
                held[codes[begin:]], starts[first - low :] - begin, dtype=np.int64
            )
            held[at] = False
            linked = like.whole * common >= like.part * (n[j] + n[first:high] - common)
            for i in (np.flatnonzero(linked & (part[first:high] != part[j])) + first).tolist():
                if part[i] != part[j]:
                    links.append((min(classes[i], classes[j]), max(classes[i], classes[j])))
                    part[part == part[i]] = part[j]
        low = high
    return links


def _each_list(rows: DataFrame, scan, out: pa.Schema, ddl: str) -> DataFrame:
    """What scan(rows of one list) returns, for every list; the first column names the list."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        seen: set[tuple] = set()
        for batch in batches:
            found: set[tuple] = set()
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if held and held[0][0] != row[0]:
                    found.update(scan(held))
                    held = []
                held.append(row)
            yield record(out, list(found - seen))
            seen = found
        if held:
            yield record(out, list(set(scan(held)) - seen))

    return arrow_ready(rows).mapInArrow(run, ddl)


def _list_rows(lists: DataFrame, rooted: DataFrame, least: int) -> DataFrame:
    """list, class, root, n and sketch of the lists with several roots and `least` members."""
    rows = lists.join(rooted.select("group", "class", "root"), "group").drop("group")
    mixed = rows.groupBy("list").agg(
        F.min("root").alias("low"), F.max("root").alias("high"), F.count("*").alias("members")
    ).filter((F.col("low") != F.col("high")) & (F.col("members") >= least)).select("list")
    rows = rows.join(mixed, "list").join(rooted.select("class", "n", "sketch"), "class")
    return rows.select("list", "class", "root", "n", "sketch").repartition(
        "list"
    ).sortWithinPartitions("list", "n", "class")


def middle_pairs(lists: DataFrame, classes: DataFrame, like: Likeness) -> DataFrame:
    """Round one: pairs of each list's members with its middle one."""
    rows = _list_rows(lists, classes.withColumn("root", F.col("class")), 2)
    return _each_list(rows, lambda r: Members.of(r).middle_pairs(like), PAIR, "a long, b long")


def open_lists(
    lists: DataFrame, classes: DataFrame, roots: DataFrame, like: Likeness
) -> DataFrame:
    """(list, class, root): what round two has to look at.

    Lists with one hub are one list, so near copies that share a hundred tokens meet once. In
    a long one the hub's own members, which are connected, are dealt into parts; the others
    go to every part.
    """
    rooted = classes.join(roots.withColumnRenamed("node", "class"), "class", "left").withColumn(
        "root", F.coalesce("root", "class")
    )
    opened = freeze(_each_list(
        _list_rows(lists, rooted, 3), lambda r: Members.of(r).open_members(like), OPEN,
        "hub long, class long, root long",
    ).distinct(), "jaccard-open")
    own = F.col("hub") == F.col("root")
    parts = opened.filter(own).groupBy("hub").agg(
        F.ceil(F.count("*") / PART_MEMBERS).cast("int").alias("parts")
    )
    dealt = opened.join(parts, "hub", "left").withColumn("part", F.explode(
        F.when(own, F.array((F.abs(F.hash("class")) % F.col("parts")).cast("int")))
        .otherwise(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1))
    ))
    return dealt.select(F.xxhash64("hub", "part").alias("list"), "class", "root")


def list_links(opened: DataFrame, sets: DataFrame, like: Likeness) -> DataFrame:
    """Round two: links between the components of each open list, by whole sets."""

    def scan(rows: list[tuple]) -> list[tuple[int, int]]:
        _, classes, roots, hashes = zip(*rows)
        return spanning_links(classes, roots, [np.frombuffer(h, np.uint64) for h in hashes], like)

    rows = opened.join(sets.hint("merge"), "class").select("list", "class", "root", "hashes")
    return _each_list(
        rows.repartition("list").sortWithinPartitions("list", "class"), scan, PAIR, "a long, b long"
    )


# -- verification ------------------------------------------------------------------------


def distinct_pairs(pairs: DataFrame) -> DataFrame:
    return pairs.select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
    ).distinct()


def sets_of(docs: DataFrame, classes: DataFrame, like: Likeness) -> DataFrame:
    """(class, hashes): whole sets, rebuilt from the texts that stand for the classes.

    Both sides grow with the corpus, so neither is ever broadcast.
    """
    wanted = classes.select("class", F.col("doc_id").alias("of")).hint("merge")
    texts = docs.select("doc_id", "text").join(
        wanted, F.col("doc_id").eqNullSafe(F.col("of"))
    ).select("class", "text")
    schema = pa.schema([("class", pa.int64()), ("hashes", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            classes_, rows = batch.column("class").to_pylist(), []
            for low, sets in _sets(batch, like):
                rows += [
                    (classes_[low + i], s.tobytes()) for i, s in enumerate(sets)
                    if len(s) and _class_id(s) == classes_[low + i]
                ]
            yield record(schema, rows)

    return arrow_ready(texts).mapInArrow(run, "class long, hashes binary")


def verified(sets: DataFrame, pairs: DataFrame, like: Likeness) -> DataFrame:
    """The linked ones among pairs of classes, by their whole sets."""

    @F.pandas_udf("boolean")
    def linked(p: pd.Series, q: pd.Series) -> pd.Series:
        out = np.zeros(len(p), bool)
        for i, (x, y) in enumerate(zip(p, q)):
            x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            common = len(np.intersect1d(x, y, assume_unique=True))
            out[i] = like.whole * common >= like.part * (len(x) + len(y) - common)
        return pd.Series(out)

    x = sets.withColumnsRenamed({"class": "a", "hashes": "hashes_a"})
    y = sets.withColumnsRenamed({"class": "b", "hashes": "hashes_b"})
    return freeze(
        pairs.join(x, "a").join(y, "b").filter(linked("hashes_a", "hashes_b"))
        .select("a", "b").distinct(),
        "jaccard-links",
    )


# -- the operator ------------------------------------------------------------------------


def _joined(docs: DataFrame, like: Likeness) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Signatures of the rows, classes, and the root (class, root) of linked classes."""
    signed = freeze(signatures(docs, like), "jaccard-signatures")
    classes = freeze(
        signed.filter("n > 0").groupBy("class").agg(
            F.min("doc_id").alias("doc_id"), F.min("n").alias("n"),
            F.min("group").alias("group"), F.any_value("sketch").alias("sketch"),
        ), "jaccard-classes",
    )
    lists = freeze(class_lists(docs, classes, like), "jaccard-lists")
    listed_ = classes.join(lists.select("group").distinct(), "group", "left_semi")
    sets = freeze(sets_of(docs, listed_, like), "jaccard-sets")
    middle = freeze(distinct_pairs(middle_pairs(lists, classes, like)), "jaccard-pairs")
    links = verified(sets, middle, like)
    opened = freeze(open_lists(lists, classes, connected(links), like), "jaccard-dealt")
    links = links.unionByName(freeze(list_links(opened, sets, like), "jaccard-links"))
    return signed, classes, connected(links).withColumnRenamed("node", "class")


def components(docs: DataFrame, like: Likeness = Likeness()) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id (the least doc_id reachable by links)."""
    signed, classes, roots = _joined(docs, like)
    owners = classes.select("class", "doc_id").join(roots, "class").select(
        "class", "root", "doc_id"
    )
    least = owners.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    linked = owners.join(least, "root").select("class", "component_id")
    named = classes.select("class", F.col("doc_id").alias("first_id")).join(linked, "class", "left")
    return signed.select("doc_id", F.col("n").cast("long").alias("n_shingles"), "class").join(
        named, "class", "left"
    ).select(
        "doc_id", "n_shingles",
        F.coalesce("component_id", "first_id", "doc_id").alias("component_id"),
    )


def keep_first(docs: DataFrame, like: Likeness = Likeness(), once: bool = False) -> DataFrame:
    """The rows that come first in their component, with all their columns.

    Rows are ordered by doc_id, null last, then by a 64-bit key of doc_id and text. Where the
    first row is repeated with its doc_id and text, all of these stay, or with `once` the one
    least in its other columns; rows without a doc_id are never taken for the same document,
    so one of them stays. Rows with an empty set stay.
    """
    signed, _, roots = _joined(docs, like)
    rows = signed.filter("n > 0").groupBy("class", "doc_id", "key").agg(F.count("*").alias("times"))
    rows = freeze(rows.join(roots, "class", "left").select(
        F.coalesce("root", "class").alias("root"), "doc_id", "key", "times"
    ), "jaccard-rows")
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "key")
    first = rows.groupBy("root").agg(F.min(place).alias("first"))
    later = rows.join(first, "root").filter(~place.eqNullSafe(F.col("first"))).select("key")
    later = freeze(later, "later-copies")
    repeated = rows.filter("times > 1")
    if not once:
        repeated = repeated.filter("doc_id is null")
    repeated = freeze(
        repeated.select("key").join(later, "key", "left_anti"), "repeated-rows"
    )
    named = _unused("key", docs)
    keyed = docs.withColumn(named, row_key(F.col("doc_id"), F.col("text")))
    repeated = repeated.withColumnRenamed("key", named)
    kept = keyed.join(later.withColumnRenamed("key", named), named, "left_anti")
    others = [
        f.name for f in docs.schema
        if isinstance(f.dataType, T.AtomicType) and f.name not in ("doc_id", "text")
    ]
    nth = _unused("nth", docs)
    order = Window.partitionBy(named).orderBy(*(others or [named]))
    picked = kept.join(repeated, named, "left_semi").withColumn(
        nth, F.row_number().over(order)
    ).filter(F.col(nth) == 1)
    return kept.join(repeated, named, "left_anti").select(docs.columns).unionByName(
        picked.select(docs.columns)
    )


def _unused(name: str, docs: DataFrame) -> str:
    while name in (c.lower() for c in docs.columns):
        name += "_"
    return name
