"""Benchmark decontamination: word pairs as seeds, counted, Smith-Waterman as the judge.

Words are lower-cased, ASCII punctuation and white space separate them. A document is
contaminated when its local alignment with an item reaches `least` of the score of the whole
item. No such alignment is missed. Let it have M matches and E errors, so that 2M - E >= s,
the score asked for. Of the M - 1 steps from one match to the next, those with two errors or
more are at most E / 2, so at least s / 2 - 1 steps have one error or none: two words at
distance 1 or 2 in the item stand at distance 1 or 2 in the document. These pairs are the
seeds. All of them begin within M + E <= 3 * words - s words of the document, so that many
words must hold s / 2 - 1 places with a seed of the item. Places of the item whose seeds are
shared by many items may be left out, if as many hits less are asked for; half of the hits
are given up for that. Nothing is counted in the corpus, so copies cannot hide each other.

The benchmark is the query set: it goes to the executors in blocks of at most BLOCK_ITEMS
items, with one pass over the documents per block. Items of fewer than LEAST_WORDS words, or
that reach the score by one word, and documents without words, match nothing. Repeated rows
are judged each, null ids are carried.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from estrato.llm.common import Texts, arrow_ready, fields, record
from estrato.llm.words import NO_MARKS, Words, mix

LEAST_WORDS = 3
LEAST = 0.5
MATCH, MISMATCH, GAP = 2, -1, -1
BLOCK_ITEMS = 20_000


def words_of(texts: list[str | None]) -> Words:
    lower = [t.lower() if t is not None else None for t in texts]
    return Words(Texts(pa.array(lower, type=pa.large_string())), NO_MARKS)


def pairs(hashes: np.ndarray, first: np.ndarray, apart: int) -> tuple[np.ndarray, np.ndarray]:
    """Place of each word that has another one `apart` words on in its text, and their hash."""
    n = len(hashes)
    left = np.repeat(first[1:], np.diff(first)) - np.arange(n)
    place = np.flatnonzero(left > apart)
    return place, mix(mix(hashes[place]) * np.uint64(3) + hashes[place + apart])


@dataclass(frozen=True)
class Items:
    """Items of one block: their words, the score asked for, the hits that a stretch of `span`
    words must hold, and their seeds: distinct hashes, and the owners of each."""

    ids: list
    words: list[np.ndarray]
    score: np.ndarray
    hits: np.ndarray
    span: np.ndarray
    seeds: np.ndarray
    first: np.ndarray
    owner: np.ndarray

    @staticmethod
    def of(ids: list, texts: list[str | None], least: float) -> "Items":
        words = words_of(texts)
        lists = [words.hashes[a:b] for a, b in zip(words.first[:-1], words.first[1:])]
        size = np.diff(words.first)
        score = np.ceil(least * MATCH * size - 1e-9).astype(np.int64)
        steps = np.maximum(-(-score // 2) - 1, 0)
        spare = steps // 2
        place, seed = (np.concatenate(x) for x in zip(
            *(pairs(words.hashes, words.first, d) for d in (1, 2))
        ))
        owner = np.repeat(np.arange(len(ids)), size)[place]
        # The `spare` places of each item with the most shared seeds are left out.
        _, which = np.unique(seed, return_inverse=True)
        both = np.unique(np.stack((which, owner)), axis=1)
        shared = np.bincount(both[0])[which] if len(seed) else which
        load = np.bincount(place, shared, len(words.hashes))
        held = np.repeat(np.arange(len(ids)), size)
        order = np.lexsort((-load, held))
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order)) - words.first[held[order]]
        keep = (rank[place] >= spare[owner]) & (size >= LEAST_WORDS)[owner] & (steps > 0)[owner]
        both = np.unique(np.rec.fromarrays((seed[keep], owner[keep]), names="seed,owner"))
        seeds, first = np.unique(both.seed, return_index=True)
        return Items(
            ids, lists, score, steps - spare, 3 * size - score, seeds,
            np.append(first, len(both)), both.owner,
        )


def blocks(
    benchmark: DataFrame, least: float, size: int = BLOCK_ITEMS
) -> Iterator[Items]:
    """The benchmark in blocks of about `size` items."""
    number = -(-benchmark.count() // size)
    for i in range(number):
        block = F.pmod(F.xxhash64("item_id", "text"), F.lit(number)) == i
        rows = benchmark.filter(block).select("item_id", "text").dropDuplicates().collect()
        yield Items.of([r[0] for r in rows], [r[1] for r in rows], least)


def _portions(column: pa.Array, rows: int = 64):
    for low in range(0, len(column), rows):
        yield low, words_of(column.slice(low, rows).to_pylist())


def smith_waterman(item: np.ndarray, passage: np.ndarray) -> tuple[int, int, int]:
    """Best local alignment: score, first word and end in the passage.

    One vector step per word of the item; gaps along the passage are a running maximum.
    """
    n = len(passage)
    ramp = -GAP * np.arange(n + 1)
    score, start = np.zeros(n + 1, np.int64), np.arange(n + 1)
    best = (0, 0, 0)
    for word in item:
        diagonal = score[:-1] + np.where(passage == word, MATCH, MISMATCH)
        up = score[1:] + GAP
        here = np.maximum(diagonal, up)
        origin = np.where(diagonal >= up, start[:-1], start[1:])
        fresh = here <= 0
        new = np.concatenate(([0], np.where(fresh, 0, here)))
        source = np.concatenate(([0], np.where(fresh, np.arange(1, n + 1), origin)))
        lifted = new + ramp
        lead = np.maximum.accumulate(lifted)
        leader = np.maximum.accumulate(np.where(lifted == lead, np.arange(n + 1), 0))
        along = lead - ramp
        start = np.where(along > new, source[leader], source)
        score = np.maximum(new, along)
        end = int(score.argmax())
        if score[end] > best[0]:
            best = (int(score[end]), int(start[end]), end)
    return best


def candidates(items: Items, words: Words) -> np.ndarray:
    """Rows (text, item, first place, last place) of stretches of words that hold enough hits,
    in order; stretches of a text and item may overlap."""
    hits, n = [], len(words.hashes)
    for apart in (1, 2):
        place, hashes = pairs(words.hashes, words.first, apart)
        at = np.searchsorted(items.seeds, hashes)
        found = np.flatnonzero(items.seeds[np.minimum(at, len(items.seeds) - 1)] == hashes)
        place, at = place[found], at[found]
        many = items.first[at + 1] - items.first[at]
        nth = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        owner = items.owner[np.repeat(items.first[at], many) + nth]
        hits.append(owner * n + np.repeat(place, many))
    # One hit per item and place; places ascend, and texts with them.
    held = np.unique(np.concatenate(hits))
    owner, place = held // n, held % n
    text = np.searchsorted(words.first, place, "right") - 1
    last = np.arange(len(held)) + items.hits[owner] - 1
    whole = last < len(held)
    last = np.minimum(last, len(held) - 1)
    whole &= (owner[last] == owner) & (text[last] == text)
    whole &= place[last] - place < items.span[owner]
    return np.stack((text, owner, place, place[last]))[:, whole].T


def matches(items: Items, words: Words) -> list[tuple[int, int, float, int, int]]:
    """(text, item, score as a share, first word, end word) of contaminated passages."""
    if not len(items.seeds) or not len(words.hashes):
        return []
    regions: dict[tuple[int, int], list[list[int]]] = {}
    for t, item, first, last in candidates(items, words).tolist():
        # Every alignment with these hits begins and ends inside.
        a = max(last - int(items.span[item]), int(words.first[t]))
        b = min(first + int(items.span[item]) + 1, int(words.first[t + 1]))
        found = regions.setdefault((t, item), [])
        if found and found[-1][1] >= a:
            found[-1][1] = max(found[-1][1], b)
        else:
            found.append([a, b])
    out = []
    for (t, item), spans in regions.items():
        target, best = items.words[item], (0, 0, 0)
        for a, b in spans:
            score, first, end = smith_waterman(target, words.hashes[a:b])
            best = max(best, (score, a + first, a + end))
        if best[0] >= items.score[item]:
            begin = int(words.first[t])
            share = best[0] / (MATCH * len(target))
            out.append((t, item, share, best[1] - begin, best[2] - begin))
    return out


def _found(column: pa.Array, items: Items):
    for low, words in _portions(column):
        for t, *rest in matches(items, words):
            yield low + t, *rest


LEAK = fields("item_id long, score double, first_word long, end_word long")


def leaks(docs: DataFrame, benchmark: DataFrame, least: float = LEAST) -> DataFrame:
    """One row per document and item it contains: doc_id, item_id, score (share of the
    item's own score, to four digits) and the words of the document that align best."""
    schema = T.StructType([docs.schema["doc_id"], *LEAK])
    arrow = to_arrow_schema(schema)
    parts = []
    for items in blocks(benchmark, least):

        def run(batches, items=items):
            for batch in batches:
                rows = [
                    (batch.column(0)[t].as_py(), items.ids[i], round(share, 4), *place)
                    for t, i, share, *place in _found(batch.column(1), items)
                ]
                yield record(arrow, rows)

        parts.append(arrow_ready(docs.select("doc_id", "text")).mapInArrow(run, schema))
    if not parts:
        return docs.sparkSession.createDataFrame([], schema)
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def keep_clean(docs: DataFrame, benchmark: DataFrame, least: float = LEAST) -> DataFrame:
    """Only the rows without a contaminated passage, decided where they lie."""
    for items in blocks(benchmark, least):

        def run(batches, items=items):
            for batch in batches:
                bad = {t for t, *_ in _found(batch.column("text"), items)}
                yield batch.filter(pa.array([i not in bad for i in range(len(batch))], pa.bool_()))

        docs = arrow_ready(docs).mapInArrow(run, docs.schema)
    return docs
