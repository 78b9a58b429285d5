"""Substring deduplication by hashed lines or paragraphs.

Texts are cut into units; a unit is normalised (ASCII lower case, runs of white space as one
blank, none at the ends) and digested to 128 bits. Digests are grouped globally; the
earliest occurrence by (rank, doc_id, 64-bit key of doc_id and text, start) stays and every
other one is removed. Both kinds are returned, with their offsets in the original text (code
points, end exclusive, without the line break).

Units without words stay, and with `min_words` those of fewer. Null and empty texts have no
units. Rows that repeat a doc_id, or have none, are told apart by their texts; only rows equal
in doc_id and text share their occurrences: the earliest stays in each of them. A null rank or
doc_id comes first; without `rank`, doc_id decides. doc_id is a number; other columns are
ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from estrato.llm.common import arrow_ready, fields, record, row_key
from estrato.workspace import freeze

BREAKS = {"line": re.compile(r"\n"), "paragraph": re.compile(r"\n(?:[ \t\r]*\n)+")}
MIN_WORDS = 1


def cut(text: str, breaks: re.Pattern) -> Iterator[tuple[int, int]]:
    at = 0
    for m in breaks.finditer(text):
        yield at, m.start()
        at = m.end()
    yield at, len(text)


def unit_digest(words: list[bytes]) -> bytes:
    return xxhash.xxh3_128_digest(b" ".join(words))


def units(
    docs: DataFrame, unit: str = "line", min_words: int = MIN_WORDS, rank: Column | None = None
) -> DataFrame:
    """One row per unit: digest, rank, doc_id, key, start, end, words."""
    breaks = BREAKS[unit]
    rows = docs.select(
        F.lit(0).cast("double").alias("rank") if rank is None else rank.cast("double").alias("rank"),
        F.col("doc_id").cast("long").alias("doc_id"),
        row_key(F.col("doc_id"), F.col("text")).alias("key"), "text",
    )
    schema = T.StructType(fields(
        "digest binary, rank double, doc_id long, key long, start int, end int, words int"
    ))
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for rank_, doc_id, key, text in zip(*(c.to_pylist() for c in batch.columns)):
                for a, b in cut(text or "", breaks):
                    words = text[a:b].encode().lower().split() if b > a else []
                    if len(words) >= min_words:
                        found.append((unit_digest(words), rank_, doc_id, key, a, b, len(words)))
            yield record(arrow, found)

    return arrow_ready(rows).mapInArrow(run, schema)


def repeats(
    docs: DataFrame, unit: str = "line", min_words: int = MIN_WORDS, rank: Column | None = None
) -> DataFrame:
    """One row per occurrence of a repeated unit: doc_id, start, end, words, kept (true for the
    earliest, which stays), first_doc_id, first_start and first_end of the earliest, and the
    number of occurrences.

    Earliest occurrences are aggregated before the shuffle, so a unit of which every document
    holds a copy costs one row a task; those of a single occurrence are dropped before the
    join, which adaptive execution splits where one digest is frequent.
    """
    found = units(docs, unit, min_words, rank)
    place = F.struct("rank", "doc_id", "key", "start", "end")
    firsts = found.groupBy("digest").agg(
        F.min(place).alias("first"), F.count("*").alias("occurrences")
    ).filter("occurrences > 1")
    firsts = freeze(firsts, "repeated-units")
    return found.join(firsts, "digest").select(
        "doc_id", "start", "end", "words", place.eqNullSafe(F.col("first")).alias("kept"),
        F.col("first.doc_id").alias("first_doc_id"), F.col("first.start").alias("first_start"),
        F.col("first.end").alias("first_end"), "occurrences",
    )
