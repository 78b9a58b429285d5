"""Secret scan by a trigram index: Boolean trigram queries, postings, verification.

Every rule has a regular expression and the literal words it cannot match without. Each
word gives the conjunction of its trigrams, a rule the disjunction over its words; a rule
without such words (or with words below three characters) is scanned in full. Texts are
indexed in segments of one Arrow batch: trigram -> ascending list of texts, lower-cased, for
the trigrams that occur in queries. Postings are intersected and united, and only the
candidates are matched. A segment's index lives and dies with its task, so no shuffle is
needed, no list outgrows a batch and a lost executor costs its segments alone.

Null text is empty. Matches of one rule do not overlap (leftmost first); those of different
rules may. Offsets are code points, end exclusive. Other columns pass through; repeated rows
are scanned each.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from estrato.llm.common import Texts, arrow_ready
from estrato.llm.words import PLAIN


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: re.Pattern
    accept: Callable[[re.Match], bool] = field(default=lambda m: True)
    # Lower-cased words of which every match holds at least one; none: scan in full.
    words: tuple[str, ...] = ()


# The patterns of the contract, then two that the scan adds.
BASE_RULES = (
    Rule(
        "assign",
        re.compile(
            r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?"""
            r"([A-Za-z0-9+/_.=-]+)"
        ),
        lambda m: len(m[2]) >= 12,
        ("password", "passwd", "secret", "token", "apikey", "api_key"),
    ),
    Rule("access", re.compile(r"AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 18, ("akia",)),
    Rule("hex", re.compile(r"[0-9a-f]{16,}")),
)
# The header, the lines of base64 and header fields that follow, and the END line if it comes
# next; text of another kind ends the span. Line ends may be escaped, indented or quoted.
PEM = re.compile(
    r"""-----BEGIN\x20[A-Z ]{0,30}PRIVATE\x20KEY-----
    (?: (?:\s|\\+[nrt]|["'`,;>|#*+&\\])*+
        (?: [A-Za-z][A-Za-z0-9-]*:\x20[^\n\\]*+
          | (?:[A-Za-z0-9/]|\+(?=[A-Za-z0-9+/=])|\\/)++={0,2}+
            (?=[\s"'`,;\\+]*(?:[\r\n]|\\+[nr]|-----END\x20|\Z))
          | (?:[A-Za-z0-9+/]|\\/){40,}+={0,2}+ ) )*+
    (?: (?:\s|\\+[nrt]|["'`,;>|#*+&\\])*+ -----END\x20[A-Z ]{0,30}PRIVATE\x20KEY----- )?+""",
    re.VERBOSE,
)
RULES = BASE_RULES + (
    Rule("pem", PEM, words=("-----begin ",)),
    Rule("github", re.compile(r"gh[pousr]_[A-Za-z0-9]{36,}"), words=(
        "ghp_", "gho_", "ghu_", "ghs_", "ghr_")),
)


def trigrams(word: str) -> list[int]:
    b = word.encode()
    return [b[i] << 16 | b[i + 1] << 8 | b[i + 2] for i in range(len(b) - 2)]


def trigram_query(rule: Rule) -> list[list[int]] | None:
    """Any of these lists must be present in full; None: no mandatory trigrams."""
    if not rule.words or min(len(w.encode()) for w in rule.words) < 3:
        return None
    return [trigrams(w) for w in rule.words]


class SegmentIndex:
    """Postings of the wanted trigrams over one batch of texts."""

    SLICE = 1 << 20

    def __init__(self, texts: Texts, wanted: list[int]):
        self.number = {t: i for i, t in enumerate(wanted)}
        self.all = np.arange(len(texts))
        lists: list[list[np.ndarray]] = [[] for _ in wanted]
        first = np.zeros(256, bool)
        first[[t >> 16 for t in wanted]] = True
        sorted_wanted = np.sort(np.array(wanted, np.int64))
        order = np.argsort(np.array(wanted, np.int64))
        begin, end = int(texts.ends[0]), int(texts.ends[-1])
        for a in range(begin, end, self.SLICE):
            b = PLAIN[texts.data[a : min(a + self.SLICE + 2, end)]]
            at = np.flatnonzero(first[b[: max(len(b) - 2, 0)]])
            code = b[at].astype(np.int64) << 16 | b[at + 1].astype(np.int64) << 8 | b[at + 2]
            place = np.searchsorted(sorted_wanted, code)
            place[place == len(wanted)] = 0
            hit = sorted_wanted[place] == code
            at, place = at[hit] + a, order[place[hit]]
            text = np.searchsorted(texts.ends, at, "right") - 1
            inside = at + 3 <= texts.ends[text + 1]
            for i in np.unique(place[inside]):
                lists[i].append(np.unique(text[inside & (place == i)]))
        none = np.empty(0, np.int64)
        self.postings = [np.unique(np.concatenate(x)) if x else none for x in lists]

    def candidates(self, query: list[list[int]] | None) -> np.ndarray:
        if query is None:
            return self.all
        each = [
            reduce(np.intersect1d, [self.postings[self.number[t]] for t in sorted(set(grams))])
            for grams in query
        ]
        return reduce(np.union1d, each)


def find_spans(texts: Texts, rules: tuple[Rule, ...]) -> list[list[tuple[int, int, int]]]:
    """Per text its matches (start, rule number, end), sorted."""
    queries = [trigram_query(r) for r in rules]
    wanted = sorted({t for q in queries if q for grams in q for t in grams})
    index = SegmentIndex(texts, wanted)
    found: list[list[tuple[int, int, int]]] = [[] for _ in range(len(texts))]
    chosen = [index.candidates(q) for q in queries]
    rules_of: dict[int, list[int]] = {}
    for number, candidates in enumerate(chosen):
        for i in candidates:
            rules_of.setdefault(int(i), []).append(number)
    for i, numbers in rules_of.items():
        text = texts[i].tobytes().decode()
        for number in numbers:
            rule = rules[number]
            found[i] += [
                (m.start(), number, m.end()) for m in rule.pattern.finditer(text)
                if rule.accept(m)
            ]
    return [sorted(spans) for spans in found]


def _mapped(docs: DataFrame, schema: T.StructType, make) -> DataFrame:
    """`make(batch, texts, spans)` gives the columns of the result for each batch."""
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = Texts(batch.column("text"))
            columns = make(batch, texts)
            yield pa.RecordBatch.from_arrays(
                [
                    c.cast(f.type) if isinstance(c, pa.Array) else pa.array(c, type=f.type)
                    for c, f in zip(columns, arrow)
                ],
                schema=arrow,
            )

    return arrow_ready(docs).mapInArrow(run, schema)


SPAN = T.StructType([
    T.StructField("kind", T.StringType(), False),
    T.StructField("start", T.LongType(), False),
    T.StructField("end", T.LongType(), False),
])


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows with `secrets`: spans (kind, start, end) by start, then rule order."""
    kept = [c for c in docs.columns if c != "secrets"]

    def make(batch, texts):
        spans = [
            [{"kind": rules[n].kind, "start": a, "end": b} for a, n, b in found]
            for found in find_spans(texts, rules)
        ]
        return [batch.column(c) for c in kept] + [spans]

    schema = T.StructType(
        [docs.schema[c] for c in kept] + [T.StructField("secrets", T.ArrayType(SPAN, False))]
    )
    return _mapped(docs, schema, make)


def redact(docs: DataFrame, rules: tuple[Rule, ...] = RULES, mark: str = "[secret]") -> DataFrame:
    """The rows with every span, overlapping ones merged, replaced by `mark`; n_chars, where
    it is a column and the text is not null, follows."""

    names = docs.columns

    def make(batch, texts):
        column = batch.column("text").to_pylist()
        for i, spans in enumerate(find_spans(texts, rules)):
            if spans:
                column[i] = _without(column[i], spans, mark)
        out = {c: batch.column(c) for c in names} | {"text": column}
        if "n_chars" in out:
            known = batch.column("n_chars").to_pylist()
            out["n_chars"] = [n if t is None else len(t) for t, n in zip(column, known)]
        return [out[c] for c in names]

    return _mapped(docs, docs.schema, make)


def _without(text: str, spans: list[tuple[int, int, int]], mark: str) -> str:
    parts, at = [], 0
    for start, _, end in spans:
        if start >= at:
            parts += [text[at:start], mark]
        at = max(at, end)
    return "".join(parts) + text[at:]
