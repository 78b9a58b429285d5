"""The operators applied to the test tables, and the SQL that must give the same rows.

Each query derives the digest columns of its contract from the operator's own output.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from estrato.llm import (
    alignment, bpe, chat, decontaminate, jaccard, linededup, merkle, packing, passages, quality,
    reputation, secrets, sharding, substrings,
)
from estrato.llm.common import arrow_ready, fields, map_batches, record, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql:
            SQL[name] = sql.strip()
        return fn

    return register


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


@query("op1_sampled_splitters")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sharding.shard(table(spark, sf_dir, "documents"), 40)
    return rows.select(
        "doc_id", "size",
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query("op2_secret_scan")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = [r.kind for r in secrets.BASE_RULES]
    spans = F.col("secrets")

    def counted(kind: str) -> Column:
        return F.size(F.filter(spans, lambda s: s["kind"] == kind))

    def joined(array: Column) -> Column:
        return F.array_join(
            F.transform(
                array,
                lambda s: F.concat_ws(
                    ":", s["kind"], s["start"].cast("string"), s["end"].cast("string")
                ),
            ),
            ",",
        )

    rows = secrets.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.select(
        "doc_id",
        *[counted(kind).cast("long").alias(f"n_{kind}") for kind in base],
        F.sha2(joined(F.filter(spans, lambda s: s["kind"].isin(*base))), 256)
        .alias("base_sha256"),
        joined(spans).alias("spans"),
    )


@query("op3_ngram_jaccard_join")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.components(
        table(spark, sf_dir, "documents"), jaccard.Likeness(words=3, part=90, whole=100)
    )


@query("op4_common_prefix_intervals")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    schema = T.StructType([
        docs.schema["doc_id"],
        *fields("n_bytes long, n_removed long, n_spans long, kept_sha256 string"),
    ])
    arrow = to_arrow_schema(schema)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for doc_id, text, spans in zip(*(c.to_pylist() for c in batch.columns)):
                data, kept, at = (text or "").encode(), hashlib.sha256(), 0
                for span in spans:
                    kept.update(data[at : span["start"]])
                    at = span["end"]
                kept.update(data[at:])
                removed = sum(s["end"] - s["start"] for s in spans)
                found.append((doc_id, len(data), removed, len(spans), kept.hexdigest()))
            yield record(arrow, found)

    marked = substrings.mark_repeats(docs.select("doc_id", "text"))
    return map_batches(marked.select("doc_id", "text", "repeats"), digest, schema)


@query("op5_vector_packing")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())
    return pieces.select(
        "doc_id", "start", "length", F.crc32("token_ids").alias("ids_crc32"), "doc_tokens",
        "sequence_id", "offset",
    )


@query("op6_benchmark_leaks")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


@query("op7_host_reputation", """
WITH

p AS (
  SELECT page_id, coalesce(url, '') AS u, strpos(coalesce(url, ''), '://') AS pos FROM pages
),
q AS (
  SELECT page_id,
    CASE WHEN pos > 0 THEN translate(regexp_extract(substr(u, pos + 3), '^([^/?#]*)', 1),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE '' END AS host,
    CASE WHEN pos > 0 THEN regexp_extract(substr(u, pos + 3), '^[^/?#]*([^?#]*)', 1)
      ELSE '' END AS path
  FROM p
),
r(place, name, start, says) AS (VALUES
  ('net/', 'net', '/', 'block'), ('example.net/en/', 'example.net', '/en/', 'allow'),
  ('example.com/de/', 'example.com', '/de/', 'block'), ('org/fr/', 'org', '/fr/', 'allow')
),
ruled AS (
  SELECT q.page_id, max_by(place, length(place)) AS rule, max_by(says, length(place)) AS says
  FROM q JOIN r ON (host = name OR ends_with(host, '.' || name)) AND starts_with(path, start)
  GROUP BY q.page_id
),
h AS (
  SELECT host, count(bad) AS n, coalesce(sum(bad), 0) AS bad,
    string_split(host, '.') AS parts,
    len(regexp_extract(host, '(^|\\.)(co\\.uk|org\\.uk|com\\.au|co\\.jp|com\\.br|co\\.in|com\\.mx|co\\.nz)$', 2))
      > 0 AS wide
  FROM q LEFT JOIN (
    SELECT doc_id, CASE WHEN toxic = 1 OR quality = 0 THEN 1
      WHEN toxic IS NOT NULL AND quality IS NOT NULL THEN 0 END AS bad FROM labels
  ) l ON q.page_id = l.doc_id
  WHERE host <> '' GROUP BY host
),
hosts AS (
  SELECT *, array_to_string(parts[CASE WHEN wide THEN -2 ELSE -1 END:], '.') AS suffix,
    array_to_string(parts[CASE WHEN wide THEN -3 ELSE -2 END:], '.') AS domain
  FROM h
),
domains AS (SELECT domain, suffix, sum(n) AS n, sum(bad) AS bad FROM hosts GROUP BY ALL),
suffixes AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad FROM domains GROUP BY ALL),
levels AS (
  SELECT 1 AS level, n, bad FROM suffixes UNION ALL SELECT 2, n, bad FROM domains
  UNION ALL SELECT 3, n, bad FROM hosts
),
sums AS (
  SELECT level, coalesce(sum(l.n), 0) AS n, coalesce(sum(bad), 0) AS bad, count(l.n) AS k,
    sum(l.n * l.n) AS squares, sum(bad * bad / l.n) AS rates,
  FROM (SELECT unnest([1, 2, 3]) AS level) x LEFT JOIN (SELECT * FROM levels WHERE n > 0) l
    USING (level) GROUP BY level
),
means AS (SELECT *, (bad + 1) / (n + 2) AS mean FROM sums),
fits AS (
  SELECT level, mean, 1 / least(greatest(coalesce(CASE
    WHEN n - squares / n - (k - 1) > 0
    THEN (rates - 2 * mean * bad + n * mean * mean - (k - 1) * mean * (1 - mean))
      / (mean * (1 - mean) * (n - squares / n - (k - 1))) END, 0.5), 0.01), 0.5) - 1 AS s,
    coalesce(n - squares / n - (k - 1) > 0, false) AS fitted
  FROM means
),
rd AS (
  SELECT domain, d.n, d.bad, (s.bad - d.bad + f.s * mean) / (s.n - d.n + f.s) AS above
  FROM domains d JOIN suffixes s USING (suffix), fits f WHERE level = 1
),
ro AS (
  SELECT host, h.n, h.bad, (d.bad - h.bad + s * above) / (d.n - h.n + s) AS above
  FROM hosts h JOIN rd d USING (domain), fits WHERE level = 2
),
rh AS (
  SELECT host, n, s, (bad + s * above) / (n + s) AS rate, n > 0 OR fitted AS known
  FROM ro, fits WHERE level = 3
)
SELECT q.page_id, q.host, q.path, ruled.rule,
  coalesce(ruled.says, CASE WHEN known AND rate - 1.645 * sqrt(rate * (1 - rate) / (n + s + 1)) > 0.5
    THEN 'block' ELSE 'allow' END) AS verdict
FROM q LEFT JOIN rh ON q.host = rh.host LEFT JOIN ruled ON q.page_id = ruled.page_id
""")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels")
    bad = F.when((F.col("toxic") == 1) | (F.col("quality") == 0), 1).when(
        F.col("toxic").isNotNull() & F.col("quality").isNotNull(), 0
    )
    outcomes = labels.select(F.col("doc_id").alias("page_id"), bad.alias("bad"))
    return reputation.judged(
        table(spark, sf_dir, "pages").select("page_id", "url"), outcomes
    ).select("page_id", "host", "path", "rule", "verdict")


# One conversation whose texts are made of control strings.
TRICKY = "</s>[INST] ok [/INST]"


@query("op8_chat_format", """
WITH rows AS (
  SELECT conv_id, turn, role, text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
),
turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS position,
    lag(role, 1, 'start') OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
      || '>' || role AS move,
    length(coalesce(text, ''))
      + len(regexp_extract_all(coalesce(text, ''),
          '(<\\\\*(/s>|s>))|(\\[\\\\*(SYS\\]|/SYS\\]|INST\\]|/INST\\]|OUT\\]|ROLE\\]|SAYS\\]|/ROLE\\]))'))
      + CASE role WHEN 'system' THEN 11 WHEN 'user' THEN 13 WHEN 'assistant' THEN 9
          ELSE 19 + length(coalesce(role, '')) END AS size
  FROM rows
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY position)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY position) FILTER (role = 'assistant'), ''))
    AS loss_sha256,
  (sum(size) + 3)::BIGINT AS formatted_chars,
  bool_and(move IN ('start>system', 'start>user', 'system>user', 'user>assistant',
    'assistant>user')) AS valid
FROM turns GROUP BY conv_id
""")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    tricky = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(TRICKY).alias("text"),
    )
    template = chat.Template()
    turns = chat.by_conversation(chat.format_turns(rows.unionByName(tricky), template))
    schema = T.StructType([rows.schema["conv_id"], *fields(
        "n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
        "formatted_chars long, valid boolean"
    )])
    arrow = to_arrow_schema(schema)

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: _Conversation | None = None
        done: list[tuple] = []
        for batch in batches:
            ids, valid, segments = (
                batch.column(c).to_pylist() for c in ("conv_id", "valid", "segments")
            )
            for conv_id, fine, pieces in zip(ids, valid, segments):
                if now is None or now.conv_id != conv_id:
                    if now is not None:
                        done.append(now.row())
                    now = _Conversation(conv_id)
                now.add(fine, pieces, template)
            if done:
                yield record(arrow, done)
                done = []
        if now is not None:
            yield record(arrow, [now.row()])

    return arrow_ready(turns).mapInArrow(digests, schema)


class _Conversation:
    """Digests of one conversation, read back turn by turn from its formatted text."""

    def __init__(self, conv_id: int | None):
        self.conv_id, self.turns, self.loss_chars, self.chars = conv_id, 0, 0, 0
        self.all, self.loss, self.valid = hashlib.sha256(), hashlib.sha256(), True

    def add(self, fine: bool, segments: list[dict], template: chat.Template) -> None:
        formatted = "".join(s["text"] for s in segments)
        masked = "".join(s["text"] for s in segments if s["loss"])
        self.chars += len(formatted)
        self.valid &= fine
        for role, text, _ in template.read(formatted):
            self.turns += 1
            self.all.update(f"{role}\n{text}\n".encode())
        under_loss = template.unescape(masked)
        self.loss_chars += len(under_loss)
        self.loss.update(under_loss.encode())

    def row(self) -> tuple:
        return (
            self.conv_id, self.turns, self.all.hexdigest(), self.loss_chars,
            self.loss.hexdigest(), self.chars, self.valid,
        )


@query("op9_repeated_lines")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated lines, and passages of over 50 words that repeat wherever they begin. A row is
    one or the other: `kept` and the first occurrence are a line's, `passage_kept` and
    `passage_words` (0 on a line) a passage's."""
    docs = table(spark, sf_dir, "documents")
    lines = linededup.repeats(docs).withColumn("passage_words", F.lit(0))
    found = passages.passages(docs).withColumn("passage_words", F.col("words"))
    return lines.unionByName(
        found.withColumnRenamed("kept", "passage_kept"), allowMissingColumns=True
    )


STOPS = ", ".join(
    f"'{w}'" for w in sorted({*quality.STOP_WORDS, *(w.capitalize() for w in quality.STOP_WORDS)})
)


@query("op10_quality_rules", rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')
      AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)),
      lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM documents
),
windows AS (
  SELECT doc_id, i, w[i:i + 7] AS x FROM d, unnest(range(1, len(w) - 6)) AS r(i)
),
twins AS (
  SELECT doc_id, i FROM (
    SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, x) AS n FROM windows
  ) WHERE n > 1
),
covered AS (
  SELECT doc_id, sum(least(8, coalesce(next - i, 8)))::BIGINT AS n FROM (
    SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS next FROM twins
  ) GROUP BY doc_id
),
counts AS (
  SELECT d.doc_id, len(w) AS n_words,
    coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
    len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols,
    len(l) AS n_lines, len(l) - len(list_distinct(l)) AS n_dup_lines,
    len(list_filter(l, lambda x: regexp_matches(x, '^[\x20\x09]*[-*•]'))) AS n_marked,
    len(list_filter(w, lambda x: x IN ({STOPS}))) AS n_stop,
    coalesce(covered.n, 0) AS n_repeat_words
  FROM d LEFT JOIN covered ON d.doc_id = covered.doc_id
),
judged AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM counts
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND 1000 * word_chars BETWEEN 1500 * n_words AND 20000 * n_words
    AND 1000 * n_symbols <= 300 * n_words AND 1000 * n_dup_lines <= 500 * n_lines
    AND 1000 * n_marked <= 900 * n_lines AND 1000 * n_stop >= 20 * n_words AS kept
FROM judged
""")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = F.col("quality")
    return quality.judged(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id",
        *[
            q[c].alias(c)
            for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
        ],
        "base_failed", "kept",
    )


@query("op11_token_alignment")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = alignment.align(
        table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"),
        tokenizer_path("piece_bpe_32k.model"), derive=("groups_sha256", _groups_sha256),
    )
    return alignment.scored(found.documents, found.pairs)


@lru_cache(maxsize=1)
def _shown(n: int) -> np.ndarray:
    """Row 3 * id + mark, for ids below n: the id and what follows it, with zero bytes behind."""
    shown = np.array([f"{i}{mark}".encode() for i in range(n) for mark in ",|;"])
    return shown.view(np.uint8).reshape(len(shown), -1)


def _groups_sha256(a: bytes, b: bytes, a_last: bytes, b_last: bytes) -> str:
    """Digest of `a1,a2|b1;a3|b2,b3`: the tokens of A and B by group, each with its mark,
    without the last mark."""
    if not a:
        return ""
    a_ends, b_ends = (np.frombuffer(last, np.int8).astype(np.int64) for last in (a_last, b_last))
    a_to, b_to = np.flatnonzero(a_ends) + 1, np.flatnonzero(b_ends) + 1
    # Before a token of A stand those of B in earlier groups, before one of B its group's A too.
    others = np.append(0, b_to)[np.cumsum(a_ends) - a_ends]
    marked = np.empty(len(a_ends) + len(b_ends), np.int64)
    ids = alignment.ids_of(a, len(a_ends)).astype(np.int64)
    marked[np.arange(len(ids)) + others] = 3 * ids + a_ends
    others = a_to[np.cumsum(b_ends) - b_ends]
    ids = alignment.ids_of(b, len(b_ends)).astype(np.int64)
    marked[np.arange(len(ids)) + others] = 3 * ids + 2 * b_ends
    text = _shown(1 << max(16, int(marked.max() // 3).bit_length()))[marked].ravel()
    return hashlib.sha256(text[text != 0][:-1]).hexdigest()


DIGESTED = ("doc_id", "source", "lang", "n_chars", "text")


@query("op12_merkle_manifest", """
WITH RECURSIVE
d AS (
  SELECT row_number() OVER () AS r, doc_id, source, lang, n_chars, text,
    list_reduce(
      list_prepend(4294967295::BIGINT,
        list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
      lambda crc, byte: list_reduce(
        list_prepend(xor(crc, byte), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
        lambda x, bit: xor(x >> 1, 3988292384::BIGINT * (x & 1)))
    ) AS turned
  FROM documents
),
e AS (
  SELECT *, n_chars + CASE WHEN xor(turned, 4294967295::BIGINT) % 7 = 0 THEN 1 ELSE 0 END
    AS altered FROM d
),
hashed AS (
  SELECT r, doc_id, lang, sha256(own || more || rest) AS leaf,
    sha256(own || coalesce(strlen(altered::VARCHAR) || ':' || altered, '-') || rest) AS bad_leaf
  FROM (
    SELECT r, doc_id, lang, altered,
      coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-')
        || coalesce(strlen(source) || ':' || source, '-')
        || coalesce(strlen(lang) || ':' || lang, '-') AS own,
      coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS more,
      coalesce(strlen(text) || ':' || text, '-') AS rest
    FROM e
  )
),
placed AS (
  SELECT *, row_number() OVER w - 1 AS i, count(*) OVER (PARTITION BY lang) AS n,
    dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS g
  FROM hashed WINDOW w AS (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf)
),
up AS (
  SELECT g, 0 AS level, i, n, leaf AS node FROM placed
  UNION ALL
  SELECT g, level + 1, i // 2, (n + 1) // 2, sha256(string_agg(node, '' ORDER BY i))
  FROM up WHERE n > 1 GROUP BY g, level, i // 2, n
),
subroots AS (SELECT g, node FROM up WHERE n = 1),
top AS (
  SELECT 0 AS level, g AS i, (SELECT count(*) FROM subroots) AS n, node FROM subroots
  UNION ALL
  SELECT level + 1, i // 2, (n + 1) // 2, sha256(string_agg(node, '' ORDER BY i))
  FROM top WHERE n > 1 GROUP BY level, i // 2, n
),
steps AS (
  SELECT p.r, u.level AS step, (p.i >> u.level) & 1 AS slot, s.node AS sibling
  FROM placed p
  JOIN up u ON u.g = p.g AND u.i = p.i >> u.level AND u.n > 1
  LEFT JOIN up s ON s.g = u.g AND s.level = u.level AND s.i = xor(u.i, 1)
  UNION ALL
  SELECT p.r, 1000 + u.level, (p.g >> u.level) & 1, s.node
  FROM placed p
  JOIN top u ON u.i = p.g >> u.level AND u.n > 1
  LEFT JOIN top s ON s.level = u.level AND s.i = xor(u.i, 1)
),
ordered AS (
  SELECT *, row_number() OVER (PARTITION BY r ORDER BY step) AS nth FROM steps
),
folded AS (
  SELECT r, 0 AS done, bad_leaf AS node FROM placed
  UNION ALL
  SELECT f.r, done + 1, sha256(CASE WHEN sibling IS NULL THEN node
    WHEN slot = 0 THEN node || sibling ELSE sibling || node END)
  FROM folded f JOIN ordered o ON o.r = f.r AND o.nth = f.done + 1
),
proofs AS (
  SELECT r, sha256(coalesce(string_agg(sibling, '' ORDER BY nth), '')) AS proof
  FROM ordered GROUP BY r
)
SELECT p.doc_id, p.leaf, s.node AS subroot, t.node AS root,
  coalesce(q.proof, sha256('')) AS proof_sha256, f.node AS folded_root,
  f.node = t.node AS verified
FROM placed p JOIN subroots s ON s.g = p.g
JOIN (SELECT node FROM top WHERE n = 1) t ON true
LEFT JOIN proofs q ON q.r = p.r
JOIN (SELECT r, max_by(node, done) AS node FROM folded GROUP BY r) f ON f.r = p.r
""")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    altered = {c: F.col(c) for c in DIGESTED} | {
        "n_chars": F.col("n_chars").cast("long") + F.when(hit, 1).otherwise(0)
    }
    rows = merkle.manifest(
        docs.withColumn("shown_leaf", merkle.leaf_digest(*altered.values())),
        DIGESTED, "lang", "doc_id", keep=("shown_leaf",),
    )
    proof = F.transform(merkle.siblings(F.col("path")), merkle.as_hex)
    folded = rows.select(
        "doc_id", *[merkle.as_hex(F.col(c)).alias(c) for c in ("leaf", "subroot", "root")],
        F.sha2(F.array_join(proof, ""), 256).alias("proof_sha256"),
        merkle.as_hex(merkle.fold(F.col("shown_leaf"), F.col("path"))).alias("folded_root"),
    )
    return folded.withColumn("verified", F.col("folded_root") == F.col("root"))


@query("op13_speculative_bpe")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = tokenizer_path()
    rows = bpe.decode(bpe.encode(table(spark, sf_dir, "documents"), path), path)
    return rows.select(
        "doc_id", "n_tokens", F.sha2("token_ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
