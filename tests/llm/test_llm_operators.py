"""The text operators against brute force, and on null, empty, long, tied and repeated rows."""

import base64
import collections
import hashlib
import re
import zlib

import numpy as np
import pytest
from compare import connect, difference
from conftest import SF, rows
from pyspark.sql import functions as F

import corpus_pipeline
import estrato.llm.queries as q
from estrato.llm import (
    chat, decontaminate, graph, jaccard, linededup, packing, passages, quality, reputation,
    secrets, sharding, substrings,
)


@pytest.fixture(scope="session")
def documents(spark):
    return {
        r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()
    }


WORD = "lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor".split()


def prose(n, salt=0):
    """n words that do not repeat in sequence."""
    return " ".join(f"{WORD[(i * 7 + salt) % 12]}{(i * i + salt) % 97}" for i in range(n))


EDGES = [
    (1, None, "x"), (2, "", "x"), (3, " \n\t", None), (4, "one", "x"), (4, "one", "x"),
    (None, "no id", "x"), (6, prose(60), "x"), (7, prose(60), "y"), (8, "é" * 5000, "x"),
    (9, "a " * 40000, "z"), (10, "z" * 300000, "z"),
]


@pytest.fixture(scope="session")
def edges(spark):
    """Null, empty, long, tied and repeated rows, with a column that no operator knows."""
    return spark.createDataFrame(EDGES, "doc_id long, text string, shard string").withColumn(
        "root", F.lit(1)
    )


def rows_of(df):
    return [tuple(r) for r in df.collect()]


@pytest.mark.parametrize("name", list(q.SQL))
def test_same_rows_as_sql(spark, name):
    assert difference(connect(SF), q.QUERIES[name](spark, SF), q.SQL[name]) is None


# -- sharding ------------------------------------------------------------------------------


def check_shards(found, shards):
    bytes_, slots = collections.Counter(), collections.defaultdict(list)
    for size, shard, slot in found:
        bytes_[shard] += size
        slots[shard].append(slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert set(bytes_) <= set(range(shards))
    return bytes_


def test_shards(spark, documents):
    found = rows_of(q.op1(spark, SF))
    assert sorted(r[0] for r in found) == sorted(documents)
    for doc_id, size, crc, *_ in found:
        text = (documents[doc_id] or "").encode()
        assert (size, crc) == (len(text) + 16, zlib.crc32(text))
    check_shards([(r[1], r[4], r[5]) for r in found], 40)


def test_shards_of_a_hot_text_are_even_and_small_groups_whole(spark):
    docs = spark.range(6000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 3 == 0, "hot " * 30)
        .otherwise(F.concat(F.lit("t"), (F.col("id") % 1500).cast("string"))).alias("text"),
    )
    found = rows_of(sharding.shard(docs, 10).select("size", "shard", "slot", "text"))
    bytes_ = check_shards([r[:3] for r in found], 10)
    mean = sum(bytes_.values()) / 10
    assert all(abs(b - mean) <= mean / sharding.WHOLE_GROUP + 200 for b in bytes_.values())
    homes = collections.defaultdict(set)
    for _, shard, _, text in found:
        homes[text].add(shard)
    assert all(len(h) == 1 for t, h in homes.items() if not t.startswith("hot"))


# -- secrets -------------------------------------------------------------------------------

BASE = {
    "assign": (
        re.compile(r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?"""
                   r"([A-Za-z0-9+/_.=-]+)"), lambda m: len(m[2]) >= 12),
    "access": (re.compile("AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 18),
    "hex": (re.compile("[0-9a-f]+"), lambda m: len(m[0]) >= 16),
}


def base_spans(text):
    found = [
        (m.start(), i, f"{kind}:{m.start()}:{m.end()}")
        for i, (kind, (pattern, fits)) in enumerate(BASE.items())
        for m in pattern.finditer(text or "") if fits(m)
    ]
    return [s for _, _, s in sorted(found)]


def test_secrets(spark, documents):
    for r in q.op2(spark, SF).collect():
        base = base_spans(documents[r["doc_id"]])
        assert r["base_sha256"] == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert set(base) <= set(r["spans"].split(",")) | {""}
        counts = collections.Counter(s.split(":")[0] for s in base)
        assert [r[f"n_{k}"] for k in BASE] == [counts[k] for k in BASE]


def test_secrets_of_tricky_texts(spark):
    texts = [
        "é PassWord = 'abcdefghijkl'", "token=secret=abcdefghijklmnop", "to\u212aen=abcdefghijkl",
        "pass\nword=abcdefghijkl", "AKIA" + "A" * 14 + "AKIAB", "x" + "0f" * 8, None, "",
        "apikey: short", "-----BEGIN RSA PRIVATE KEY-----", "ghp_" + "a" * 36,
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in secrets.scan(docs).collect():
        spans = [f"{s['kind']}:{s['start']}:{s['end']}" for s in r["secrets"]]
        base = base_spans(r["text"])
        assert [s for s in spans if s.split(":")[0] in BASE] == base
    kinds = {s["kind"] for r in secrets.scan(docs).collect() for s in r["secrets"]}
    assert {"pem", "github"} <= kinds
    clean = {r["doc_id"]: r["text"] for r in secrets.redact(docs).collect()}
    assert clean[0] == "é [secret]'" and clean[6] is None and clean[8] == texts[8]


def test_redaction_leaves_no_byte_of_a_key(spark):
    body = base64.b64encode(bytes((i * i * 7 + i) % 251 for i in range(600))).decode()
    head, foot = "-----BEGIN RSA PRIVATE KEY-----", "-----END RSA PRIVATE KEY-----"
    texts, expected = [], []
    for gap in ("\n", "\r\n", "\n    ", "\\n", '" +\n  "', "\n> ", " "):
        key = gap.join([head, *(body[i : i + 64] for i in range(0, len(body), 64))])
        texts += [f"a {key}{gap}{foot} b", f"a {key}\nThe end of it.", f"a {key}"]
        expected += ["a [secret] b", "a [secret]\nThe end of it.", "a [secret]"]
    fields = "\nProc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC,0A1B\n\n"
    texts += [
        f"{head}{fields}{body}", f"{head}{fields}{body}\n{foot}\nb", f"see {head} in a sentence",
        f"{head}\n{body}\n{head}\n{body}\n{foot} b", f"{head}\n{body}\n{foot} x {foot}",
    ]
    expected += [
        "[secret]", "[secret]\nb", "see [secret] in a sentence", "[secret]\n[secret] b",
        f"[secret] x {foot}",
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    clean = {r["doc_id"]: r["text"] for r in secrets.redact(docs).collect()}
    assert [clean[i] for i in range(len(texts))] == expected


def test_prose_between_the_marks_of_a_key_stays(spark):
    head, foot = "-----BEGIN PRIVATE KEY-----", "-----END PRIVATE KEY-----"
    prose = "plain prose of many words " * 700
    texts = [
        f"Use {head} as the header {prose}... {foot} done", f"{head}MIIEabc=={foot} tail",
        f"{head} {prose}",
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    clean = {r["doc_id"]: r["text"] for r in secrets.redact(docs).collect()}
    assert clean[0] == texts[0].replace(head, "[secret]")
    assert clean[1] == "[secret] tail" and clean[2] == texts[2].replace(head, "[secret]")


# -- Jaccard join --------------------------------------------------------------------------


def brute_components(texts, like):
    sets, root = {}, {}
    for d, text in texts.items():
        w, k = (text or "").encode().lower().split(), like.words
        sets[d] = {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()
        root[d] = d

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            common = len(sets[a] & sets[b])
            if common and like.whole * common >= like.part * (len(sets[a]) + len(sets[b]) - common):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {(d, len(sets[d]), find(d)) for d in sets}


def test_jaccard_join(spark, documents):
    assert set(rows_of(q.op3(spark, SF))) == brute_components(
        documents, jaccard.Likeness(3, 90, 100)
    )


def test_chains_of_near_copies_and_cluster_edges(spark):
    like = jaccard.Likeness(3, 80, 100)
    base = prose(80).split()
    texts = {}
    for i in range(60):  # each differs from the one before it, the ends are far apart
        words = list(base)
        for j in range(i // 3):
            words[(j * 13) % 80] = f"x{j}"
        texts[i] = " ".join(words)
    texts |= {100 + i: prose(80, salt=i) for i in range(5)} | {200: "a b", 201: "A  b", 202: ""}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert set(rows_of(jaccard.components(docs, like))) == brute_components(texts, like)


def test_copies_of_one_template_with_scattered_edits(spark, monkeypatch):
    """2,000 copies whose edits leave many of them just below the likeness."""
    monkeypatch.setattr(jaccard, "PART_MEMBERS", 150)
    like, rng = jaccard.Likeness(), np.random.default_rng(5)
    base = prose(300).split()
    texts = {}
    for i in range(2000):
        words = list(base)
        for at in rng.choice(300, rng.integers(2, 10), replace=False):
            words[at] = f"e{rng.integers(1 << 40)}"
        texts[i] = " ".join(words)
    texts |= {5000 + i: prose(100, salt=i) for i in range(3)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    found = {r[0]: r[2] for r in rows_of(jaccard.components(docs, like))}
    sets = [{tuple(w[k : k + 5]) for k in range(len(w) - 4)} for w in map(str.split, texts.values())]
    names = {}
    flat = [[names.setdefault(x, len(names)) for x in s] for s in sets]
    held, ids = np.zeros(len(names), bool), list(texts)
    parent = np.arange(len(ids))
    starts, every = np.cumsum([0] + [len(f) for f in flat[:-1]]), np.concatenate(flat)
    n = np.array([len(f) for f in flat])
    for i in range(len(ids)):
        held[flat[i]] = True
        common = np.add.reduceat(held[every], starts, dtype=np.int64)
        held[flat[i]] = False
        for root in np.unique(parent[100 * common >= 80 * (n + n[i] - common)]):
            low, high = sorted((parent[i], root))
            parent[parent == high] = low
    assert found == {d: ids[parent[i]] for i, d in enumerate(ids)}
    assert len(set(found.values())) > 4  # some copies stay alone


@pytest.mark.parametrize("block", [1, 100, 1 << 21])
def test_links_of_a_list_connect_what_is_linked(monkeypatch, block):
    monkeypatch.setattr(jaccard, "BLOCK_SHINGLES", block)
    like, rng = jaccard.Likeness(), np.random.default_rng(3)
    base = np.arange(1, 41, dtype=np.uint64)
    sets = []
    for _ in range(60):
        s = np.where(rng.random(40) < 0.1, rng.integers(100, 10**9, 40).astype(np.uint64), base)
        sets.append(np.unique(s))
    roots = [i % 7 if i % 2 else 100 + i for i in range(60)]
    links = jaccard.spanning_links(list(range(60)), roots, sets, like)
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in links:
        common = len(np.intersect1d(sets[a], sets[b]))
        assert 100 * common >= 80 * (len(sets[a]) + len(sets[b]) - common)
        assert find(roots[a]) != find(roots[b])
        root[find(roots[a])] = find(roots[b])
    for a in range(60):
        for b in range(a):
            common = len(np.intersect1d(sets[a], sets[b]))
            if 100 * common >= 80 * (len(sets[a]) + len(sets[b]) - common):
                assert find(roots[a]) == find(roots[b])


def test_one_row_of_each_group_stays(spark):
    clean, near = prose(60, 3), prose(60, 9)
    copy = near.rsplit(" ", 1)[0]
    data = [
        (1, near, "a"), (2, copy, "b"), (2, clean, "c"),  # an id of a copy and of a clean text
        (5, prose(60, 20), "d"), (5, near + " end", "e"), (6, prose(60, 20), "f"),
        (7, prose(60, 30), "h"), (7, prose(60, 30), "g"),  # a row repeated
        (None, prose(60, 40), "i"), (None, prose(60, 40), "j"), (None, near, "k"),
        (None, None, "l"), (8, "", "m"), (None, prose(60, 50), "n"), (9, prose(60, 50), "o"),
    ]
    docs = spark.createDataFrame(data, "doc_id long, text string, tag string")

    def tags(**how):
        return "".join(sorted(r["tag"] for r in jaccard.keep_first(docs, **how).collect()))

    assert tags(once=True) == "acdgilmo"
    assert tags() == "acdghilmo"
    assert jaccard.keep_first(docs, once=True).columns == docs.columns


def test_connected_components_of_a_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7)]
    found = dict(rows_of(graph.connected(spark.createDataFrame(path, "a long, b long"))))
    assert found == {i: 0 for i in range(41)} | {100 + i: 100 for i in range(30)}


# -- repeated substrings ---------------------------------------------------------------------


def brute_repeats(texts, n=substrings.LENGTH):
    count = collections.Counter(t[i : i + n] for t in texts.values() for i in range(len(t) - n + 1))
    out = {}
    for d, t in texts.items():
        cover, end = bytearray(len(t)), 0
        for i in range(len(t) - n + 1):
            if count[t[i : i + n]] > 1:
                cover[max(i, end) : i + n] = b"\1" * (i + n - max(i, end))
                end = i + n
        kept = bytes(c for c, v in zip(t, cover) if not v)
        runs = len(re.findall(b"\1+", bytes(cover)))
        out[d] = (len(t), sum(cover), runs, hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("most_members", [substrings.MOST_MEMBERS, 1])
def test_repeated_substrings(spark, documents, monkeypatch, most_members):
    whole = substrings.mark_repeats
    monkeypatch.setattr(substrings, "mark_repeats", lambda d: whole(d, most_members))
    found = {r[0]: r[1:] for r in rows_of(q.op4(spark, SF))}
    assert found == brute_repeats({d: (t or "").encode() for d, t in documents.items()})


def test_stretches_of_a_long_text_share_no_window(monkeypatch):
    from estrato.llm.common import Texts
    import pyarrow as pa

    monkeypatch.setattr(substrings, "STRETCH", 500)
    windows = collections.Counter()
    for lot in substrings.stretches(Texts(pa.array(["ab" * 1500, None, "c" * 199, "d" * 200]))):
        for i, offset, data in lot:
            windows.update((i, offset + k) for k in range(len(data) - substrings.LENGTH + 1))
    assert windows == {**{(0, k): 1 for k in range(2801)}, (3, 0): 1}


# -- packing ---------------------------------------------------------------------------------


def test_packing(spark, documents):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(q.tokenizer_path())
    pieces, sequences = collections.defaultdict(list), collections.defaultdict(list)
    for doc, start, length, crc, total, sequence, offset in rows_of(q.op5(spark, SF)):
        pieces[doc].append((start, length, crc, total))
        sequences[sequence].append((offset, length))
    assert set(pieces) == set(documents)
    for doc, own in pieces.items():
        ids = tokenizer.encode(documents[doc] or "", add_special_tokens=False).ids + [2]
        at = 0
        for start, length, crc, total in sorted(own):
            part = np.array(ids[start : start + length], "<u4").tobytes()
            assert (start, total, crc) == (at, len(ids), zlib.crc32(part))
            at += length
        assert at == len(ids)
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 4096 and (at & (at - 1)) == 0


def test_words_are_encoded_as_in_the_text():
    words = packing.WordTokens(q.tokenizer_path())
    for text in [
        "", " ", "ΑΣΣ ΟΔΟΣ.", "İstanbul, İ.", "don't I'll x's", "a\x1cb", "e\u0301a \u0301b",
        "<|endoftext|> a<|startoftext|>b", "ﬁne ß ẞ. Ǆ", "١٢ 12.5, a1.b", "a\xa0b", "a..", "«x»",
    ]:
        ids = words.encoder.encode(text, add_special_tokens=False).ids
        assert words.encode(text) == np.array(ids, "<u4").tobytes(), text


@pytest.mark.parametrize("limits", [
    packing.Limits(64, 3, 64), packing.Limits(64, 50, 20), packing.Limits(64, 1, 63),
])
def test_all_limits_hold_at_once(limits):
    packer, sizes = packing.Packer(limits, window=8), [(i * 37) % 150 + 1 for i in range(200)]
    bins = [b for i, n in enumerate(sizes) for b in packer.take(i, n)] + list(packer.close())
    seen = collections.defaultdict(list)
    for pieces in bins:
        totals = np.sum([p.demand for p in pieces], axis=0)
        assert totals[0] <= limits.tokens and totals[2] <= limits.loss_tokens
        assert totals[1] <= limits.segments
        for p in pieces:
            seen[p.example] += range(p.start, p.start + p.length)
    assert all(sorted(seen[i]) == list(range(n)) for i, n in enumerate(sizes))


# -- decontamination -------------------------------------------------------------------------


@pytest.mark.parametrize("loss_tokens", [24, 512])
def test_loss_ranges_close_sequences(spark, loss_tokens):
    """Prompts bear no loss, answers do; only the loss limit can bind at 24."""
    from tokenizers import Tokenizer

    tokenizer, docs = Tokenizer.from_file(q.tokenizer_path()), []
    for i in range(60):
        prompt, answer = prose(5 + i % 7), prose(3 + i % 11)
        spans = [(len(prompt) + 1, len(prompt) + 1 + len(answer))]
        docs.append((i, f"{prompt} {answer}", [spans, None, [], [(0, 4), None, (9, 2)]][i % 4 if i % 5 else 0]))
    docs += [(60, prose(700), [(100, 3000)]), (61, None, [(0, 9)]), (62, "", [(-5, 5)]),
             (None, "a b", [(2, 99)]), (None, "a b", [(2, 99)]), (63, "a b", [(None, 3)])]
    df = spark.createDataFrame(
        docs, "doc_id long, text string, loss_at array<struct<start: int, end: int>>"
    ).coalesce(1)
    limits = packing.Limits(512, 256, loss_tokens)
    rows = packing.pack(df, q.tokenizer_path(), limits, loss="loss_at").collect()

    def bears(text, spans):
        """For each token of the text and the closing one, from the tokenizer's offsets."""
        covered = {c for x in spans or [] if x and None not in x for c in range(*x)}
        stretches = [(m.start(), m.end()) for m in re.finditer(r"[^ \t-\r]+", text)]
        hit = [any(c in covered for c in range(*x)) for x in stretches]
        marks = [
            next(h for (low, high), h in zip(stretches, hit) if low <= at < high)
            for at, _ in tokenizer.encode(text, add_special_tokens=False).offsets
        ]
        return [*marks, bool(text) and len(text) - 1 in covered]

    expected = {i: bears(t or "", x) for i, t, x in docs}
    sequences, seen = collections.defaultdict(list), collections.Counter()
    for r in rows:
        part = expected[r.doc_id][r.start : r.start + r.length]
        assert r.loss_tokens == sum(part[1:])
        sequences[r.sequence_id].append(r)
        seen[r.doc_id] += r.length
    assert seen == {i: len(m) * (2 if i is None else 1) for i, m in expected.items()}
    totals = [(sum(r.length for r in x), sum(r.loss_tokens for r in x)) for x in sequences.values()]
    assert all(n <= 512 and loss <= loss_tokens for n, loss in totals)
    full, most = sum(n == 512 for n, _ in totals), max(loss for _, loss in totals)
    # With 512 the tokens fill sequences; with 24 the loss closes them before.
    assert full > 2 and most > 24 if loss_tokens == 512 else most == 24
    least = sum(sum(m[1:]) for m in expected.values()) / loss_tokens
    assert len(totals) >= least / 2 and sum(loss == 24 and n < 512 for n, loss in totals) > (
        2 if loss_tokens == 24 else -1
    )


def test_leaks_exact_edited_and_none(spark):
    item = prose(30)
    words = item.split()
    edited = words[:8] + ["new"] + words[9:20] + words[21:]
    docs = [
        (1, f"{prose(50, 5)} {item}. {prose(40, 9)}"), (2, f"Intro {' '.join(edited).upper()}!"),
        (3, prose(200, 3)), (4, None), (5, ""), (6, " ".join(words[:7])), (None, item),
    ]
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame([(7, item), (8, None), (9, "a b")], "item_id long, text string")
    found = {(r["doc_id"], r["item_id"]): r for r in decontaminate.leaks(docs, bench).collect()}
    assert set(found) == {(1, 7), (2, 7), (None, 7)}
    assert found[1, 7]["score"] == 1.0 and found[1, 7]["first_word"] == 50
    assert 0.8 < found[2, 7]["score"] < 1
    assert rows(decontaminate.keep_clean(docs, bench).select("doc_id")) == [(3,), (4,), (5,), (6,)]


def test_edited_copies_are_found_as_by_brute_force(spark):
    def edited(words, step):
        """Copies with every step-th word replaced, left out, or followed by a new one."""
        at = range(step - 1, len(words), step)
        yield [f"new{i}" if i in at else w for i, w in enumerate(words)]
        yield [w for i, w in enumerate(words) if i not in at]
        yield [x for i, w in enumerate(words) for x in ([w, f"new{i}"] if i in at else [w])]

    bench = {i: prose(20 + i, salt=i * 5).split() for i in range(12)}
    copies = [
        " ".join([*prose(30, 70).split(), *c, *prose(30, 71).split()])
        for words in bench.values() for step in (1, 2, 3, 4, 5, 6) for c in edited(words, step)
    ] + [" ".join(words[: len(words) * 55 // 100]) for words in bench.values()]
    copies = dict(enumerate(copies * 2))
    hashes = {i: decontaminate.words_of([" ".join(w)]).hashes for i, w in bench.items()}
    expected = {}
    for d, text in copies.items():
        passage = decontaminate.words_of([text]).hashes
        for i, item in hashes.items():
            score = decontaminate.smith_waterman(item, passage)[0]
            if score >= len(item):
                expected[d, i] = round(score / 2 / len(item), 4)
    found = decontaminate.leaks(
        spark.createDataFrame(list(copies.items()), "doc_id long, text string"),
        spark.createDataFrame([(i, " ".join(w)) for i, w in bench.items()],
                              "item_id long, text string"),
    )
    assert {(r["doc_id"], r["item_id"]): r["score"] for r in found.collect()} == expected
    assert len(expected) > len(copies) / 2


def test_alignment_equals_the_plain_recurrence():
    rng = np.random.default_rng(1)
    for _ in range(60):
        a, b = rng.integers(0, 4, rng.integers(1, 12)), rng.integers(0, 4, rng.integers(1, 15))
        h = np.zeros((len(a) + 1, len(b) + 1), int)
        for i in range(len(a)):
            for j in range(len(b)):
                h[i + 1, j + 1] = max(
                    0, h[i, j] + (2 if a[i] == b[j] else -1), h[i, j + 1] - 1, h[i + 1, j] - 1
                )
        assert decontaminate.smith_waterman(a, b)[0] == h.max()


def test_query_finds_the_items_that_texts_contain(spark, documents):
    bench = dict(rows_of(spark.read.parquet(f"{SF}/benchmark.parquet")))
    there = {(d, i) for d, t in documents.items() for i, x in bench.items() if x in (t or "")}
    found = {r[:2] for r in rows_of(q.op6(spark, SF))}
    assert there <= found and len(found) <= len(there) + 3


# -- repeated lines --------------------------------------------------------------------------


PLACES = ["doc_id", "start", "end", "first_doc_id", "first_start", "first_end", "occurrences"]


def removed(found):
    return {tuple(r) for r in found.filter("not kept").select(PLACES).collect()}


def test_repeated_lines(spark, documents):
    first, expected, times = {}, set(), collections.Counter()
    for d in sorted(documents):
        at = 0
        for line in (documents[d] or "").split("\n"):
            key, end = tuple(line.encode().lower().split()), at + len(line)
            if len(key) >= linededup.MIN_WORDS:
                times[key] += 1
                if key in first:
                    expected.add((d, at, end, *first[key]))
                else:
                    first[key] = (d, at, end)
            at = end + 1
    found = q.op9(spark, SF)
    assert {r[:6] for r in removed(found)} == expected
    kept = [tuple(r) for r in found.filter("kept").select(PLACES[:3] + PLACES[6:] + ["words"]).collect()]
    assert sorted(kept) == sorted(
        (*first[k], n, len(k)) for k, n in times.items() if n > 1
    )


def test_rows_with_one_id_or_none_are_told_apart(spark):
    texts = [(1, "a"), (1, "b"), (None, "c"), (None, "d"), (None, "e")]
    docs = spark.createDataFrame(
        [(i, f"one shared line\n{t}", t) for i, t in texts], "doc_id long, text string, kept string"
    )
    found = linededup.repeats(docs).collect()
    assert len(found) == 5 and sum(not r["kept"] for r in found) == 4
    assert {r["occurrences"] for r in found} == {5} and {r["words"] for r in found} == {3}
    assert [r["doc_id"] for r in found if r["kept"]] == [None]
    twice = spark.createDataFrame([(1, "x y"), (1, "x y"), (2, "X  y")], "doc_id long, text string")
    assert sorted((r["doc_id"], r["kept"]) for r in linededup.repeats(twice).collect()) == [
        (1, True), (1, True), (2, False)
    ]


def test_short_lines_repeat_too(spark):
    texts = ["Home | News\n\nMenu\nonce", " home |  NEWS\r\n \t\nmenu", None, "Menu"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = removed(linededup.repeats(docs))
    assert found == {(1, 0, 14, 0, 0, 11, 2), (1, 18, 22, 0, 13, 17, 3), (3, 0, 4, 0, 13, 17, 3)}
    longer = {r[:2] for r in removed(linededup.repeats(docs, min_words=2))}
    assert longer == {(1, 0)}


def test_every_repeated_line_of_the_query(spark, documents):
    seen, expected = set(), set()
    for d in sorted(documents):
        at = 0
        for line in (documents[d] or "").split("\n"):
            key = tuple(line.encode().lower().split())
            if key in seen:
                expected.add((d, at, at + len(line)))
            if key:
                seen.add(key)
            at += len(line) + 1
    assert {r[:3] for r in removed(q.op9(spark, SF))} == expected


def test_paragraphs_and_rank(spark):
    text = "one two three four five six\nseven\n\nUno dos tres cuatro cinco seis"
    docs = [(1, text, 5.0), (2, "intro\n\n" + text.upper(), 1.0)]
    docs = spark.createDataFrame(docs, "doc_id long, text string, score double")
    found = linededup.repeats(docs, "paragraph", rank=F.col("score"))
    gone = found.filter("not kept")
    assert rows(gone.select("doc_id", "start", "first_doc_id")) == [(1, 2, 0), (1, 2, 35)]


# -- repeated passages -------------------------------------------------------------------------


def brute_passages(docs):
    """docs: [(doc_id, text)] with distinct ids in order, a null first."""
    n, first, times, spans = passages.LENGTH, {}, collections.Counter(), {}
    for d, text in docs:
        spans[d] = [(m.group().encode().lower(), *m.span())
                    for m in re.finditer(r"[^\x20\x09-\x0D]+", text or "")]
    windows = {
        d: [tuple(w[0] for w in s[i : i + n]) for i in range(len(s) - n + 1)]
        for d, s in spans.items()
    }
    for d, _ in docs:
        for i, w in enumerate(windows[d]):
            times[w] += 1
            first.setdefault(w, (d, i))
    out = []
    for d, own in windows.items():
        for kept in (True, False):
            runs = []
            for i, w in enumerate(own):
                if times[w] > 1 and (first[w] == (d, i)) == kept:
                    if runs and i <= runs[-1][1]:
                        runs[-1][1] = i + n
                    else:
                        runs.append([i, i + n])
            out += [(d, spans[d][a][1], spans[d][b - 1][2], b - a, kept) for a, b in runs]
    return sorted(out, key=str)


def found_passages(df):
    return sorted(rows_of(df.select("doc_id", "start", "end", "words", "kept")), key=str)


def test_passages_that_begin_and_end_inside_a_line(spark):
    body = prose(60).split()
    docs = [
        (None, "Où é " + " ".join(body[:55]) + " fin\nété"),
        (1, "a b c " + "\n".join(body[:51]).upper() + " tail"),  # wrapped otherwise, 51 words
        (2, "x " + " ".join(body[4:60]) + " y\n\n" + prose(70, 5)),
        (3, " ".join(body[:50]) + " end"),  # one word less
        (4, prose(70, 5) + " z"), (5, "one " * 53), (6, None), (7, " \n"),
    ]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    found = found_passages(passages.passages(df))
    assert found == brute_passages(docs)
    assert {r[0] for r in found} == {None, 1, 2, 4, 5}
    line_rows = linededup.repeats(df).filter("doc_id in (1, 2, 4)").count()
    assert line_rows < 3  # lines alone miss them


@pytest.mark.parametrize("block", [passages.BLOCK, 64])
def test_passages_whose_windows_lie_in_several_blocks(spark, documents, block):
    own = passages.passages(spark.read.parquet(f"{SF}/documents.parquet"), block)
    assert found_passages(own) == brute_passages(sorted(documents.items()))


def test_copies_in_rows_with_one_id(spark):
    data = [(1, prose(80)), (1, prose(80)), (1, prose(80) + " q"), (None, "a " + prose(90))]
    df = spark.createDataFrame(data, "doc_id long, text string")
    found = [(r["doc_id"], r["words"], r["kept"]) for r in passages.passages(df).collect()]
    assert sorted(found, key=str) == [
        (1, 80, False), (1, 80, False), (1, 80, False), (None, 80, True)
    ]


def test_query_of_lines_has_a_row_for_every_passage(spark, documents):
    found = q.op9(spark, SF).filter("passage_words > 0")
    own = found_passages(found.drop("kept").withColumnRenamed("passage_kept", "kept"))
    assert own == brute_passages(sorted(documents.items()))
    assert {r["kept"] for r in found.collect()} == {None}


# -- chat, quality, reputation -----------------------------------------------------------------


def test_escaping_can_be_undone(spark):
    template = chat.Template()
    texts = ["</s>", "<\\/s>", "<\\\\/s> [INST", "[[INST]]", "<<s>", "[/ROLE][SAYS]x", "\\", ""]
    found = spark.createDataFrame([(t,) for t in texts], "t string").select(
        "t", template.escape(F.col("t")).alias("e")
    ).collect()
    for t, e in found:
        assert template.unescape(e) == t
        assert not any(c in e for c in template.controls)


def test_turn_order(spark):
    turns = [(1, 0, "system"), (1, 1, "user"), (1, 2, "assistant"), (1, 3, "user"),
             (2, 0, "assistant"), (3, 0, "user"), (3, 1, "user"), (4, 0, None), (None, 0, "user")]
    df = spark.createDataFrame([(*t, "x") for t in turns], "conv_id long, turn long, role string, text string")
    valid = chat.format_turns(df).groupBy("conv_id").agg(F.min("valid").alias("v"))
    assert dict(rows_of(valid)) == {1: True, 2: False, 3: False, 4: False, None: True}


def test_addresses(spark):
    urls = [None, "", "no scheme", "http://A.Net/x", "https://net", "http://example.net/en/1?q",
            "x://example.com/de/", "http://notexample.com/de/", "ftp://a.org/fr/#f", "http://net/"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    labels = spark.createDataFrame([], "page_id long, bad int")
    found = {r["page_id"]: r for r in reputation.judged(pages, labels).collect()}
    assert [found[i]["rule"] for i in range(10)] == [
        None, None, None, "net/", None, "example.net/en/", "example.com/de/", None, "org/fr/", "net/"
    ]
    assert found[0]["host"] == "" and found[3]["host"] == "a.net"


def test_registered_domains(spark):
    expected = {
        "a.b.ac.uk": ("ac.uk", "b.ac.uk"), "x.co.kr": ("co.kr", "x.co.kr"),
        "p.github.io": ("github.io", "p.github.io"), "github.io": ("github.io", "github.io"),
        "a.b.c.ck": ("c.ck", "b.c.ck"), "a.www.ck": ("ck", "www.ck"), "ck": ("ck", "ck"),
        "www.example.com:8080": ("com", "example.com"), "me:1@example.com.": ("com", "example.com"),
        "10.0.0.1:80": ("10.0.0.1", "10.0.0.1"), "[::1]:80": ("[::1]", "[::1]"), "": ("", ""),
        "a.b.unknown-suffix": ("unknown-suffix", "b.unknown-suffix"),
        "w.a.xn--55qx5d.cn": ("xn--55qx5d.cn", "a.xn--55qx5d.cn"),
    }
    hosts = spark.createDataFrame([(h,) for h in expected], "host string")
    found = reputation.with_owner(hosts, reputation.suffix_table(spark)).collect()
    assert {r["host"]: (r["suffix"], r["domain"]) for r in found} == expected
    own = spark.createDataFrame([("unknown-suffix",), ("b.unknown-suffix",)], "rule string")
    found = {r["host"]: r["suffix"] for r in reputation.with_owner(hosts, own).collect()}
    assert found["a.b.unknown-suffix"] == "b.unknown-suffix" and found["a.b.ac.uk"] == "uk"


def test_bad_hosts_are_blocked_by_many_labels_not_by_one(spark):
    pages = [(i, "http://bad.a.com/x") for i in range(40)] + [
        (100 + i, f"http://h{i % 30}.b{i % 7}.com/") for i in range(200)
    ] + [(999, "http://once.c.com/")]
    labels = [(i, 1) for i in range(40)] + [(100 + i, i % 20 == 0) for i in range(200)] + [(999, 1)]
    labels = [(p, int(b)) for p, b in labels]
    found = reputation.judged(
        spark.createDataFrame(pages, "page_id long, url string"),
        spark.createDataFrame(labels, "page_id long, bad int"),
    )
    blocked = {r["host"] for r in found.filter("verdict = 'block'").collect()}
    assert blocked == {"bad.a.com"}


@pytest.mark.parametrize("labelled", [1, 2, 3])
@pytest.mark.parametrize("one_host", [True, False])
def test_few_labels_do_not_block_strangers(spark, labelled, one_host):
    """Too few labels to fit a prior: one blocks nothing, more of them their own hosts only."""
    urls = [f"http://w.s{0 if one_host else i}.com/{i}" for i in range(labelled)]
    urls += ["http://other.com/", "http://w.other.org/", "no scheme", "", None]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    labels = [(i, 1) for i in range(labelled)] + [(len(urls) - 1, 1), (len(urls) - 2, 1)]
    found = reputation.judged(pages, spark.createDataFrame(labels, "page_id long, bad int"))
    blocked = {r["page_id"] for r in found.filter("verdict = 'block'").collect()}
    assert blocked == (set() if labelled == 1 else set(range(labelled)))


def test_url_filter_edge_rows(spark):
    pages = spark.createDataFrame(
        [(None, None, "a"), (1, "http://a.com/", "b"), (1, "http://a.com/", "b"), (2, "", None)],
        "page_id long, url string, host string",
    ).withColumns({"bad": F.lit(3), "known": F.lit("x"), "rate": F.lit(0), "rated_host": F.lit("y")})
    labels = spark.createDataFrame(
        [(None, 1), (1, None), (2, 1)], "page_id long, bad int"
    ).withColumn("url", F.lit("z"))
    found = reputation.judged(pages, labels)
    assert [(r["page_id"], r["host"], r["verdict"], r["known"]) for r in found.orderBy("page_id").collect()] == [
        (None, "", "allow", "x"), (1, "a.com", "allow", "x"), (1, "a.com", "allow", "x"),
        (2, "", "allow", "x"),
    ]
    assert reputation.judged(pages.limit(0), labels).collect() == []
    assert len(reputation.judged(pages, labels.limit(0)).collect()) == 4


# -- all of them -------------------------------------------------------------------------------

OPERATORS = {
    "shard": (lambda d: sharding.shard(d, 3), 11),
    "secrets": (lambda d: secrets.scan(d), 11),
    "redact": (lambda d: secrets.redact(d), 11),
    "jaccard": (lambda d: jaccard.components(d), 11),
    "keep_first": (lambda d: jaccard.keep_first(d), 10),
    "substrings": (lambda d: substrings.mark_repeats(d), 11),
    "pack": (lambda d: packing.pack(d, q.tokenizer_path()), None),
    "lines": (lambda d: linededup.repeats(d), 4),
    "quality": (lambda d: quality.judged(d), 11),
}


@pytest.mark.parametrize("name", list(OPERATORS))
def test_edge_rows_and_empty_tables(spark, edges, name):
    run, expected = OPERATORS[name]
    found = run(edges).collect()
    assert len(found) == expected if expected is not None else found
    assert run(edges.limit(0)).collect() == []


def test_pipeline(spark, documents):
    pieces = corpus_pipeline.run(spark, SF).collect()
    kept = {r["doc_id"] for r in pieces}
    good = {r["doc_id"] for r in q.op10(spark, SF).filter("kept").collect()}
    bench = [r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    like = jaccard.Likeness()
    first = {c for _, _, c in brute_components({d: documents[d] for d in good}, like)}
    assert kept <= first
    assert not any(x in documents[d] for d in kept for x in bench)
    clean = {d for d in first if not any(x in documents[d] for x in bench)}
    assert len(clean - kept) <= 2
