"""Token alignment, the Merkle manifest and speculative BPE against brute force and on edges."""

import collections
import hashlib
import random
import re

import numpy as np
import pytest
from compare import connect, difference
from conftest import SF
from pyspark.sql import functions as F

import estrato.llm.queries as q
from estrato.llm import alignment, bpe, merkle

ROWS = [
    (1, None, "en", 1), (2, "", None, None), (3, " \n\t", "", 3), (4, "one", "en", 4),
    (4, "one", "en", 4), (4, "two", "en", 4), (None, "no id", "en", 5), (None, "no id", "en", 5),
    (7, "é👍🏽 ▁", "fr", 6), (8, "é中" * 3000 + "  tail \n", "fr", 7), (9, "z" * 100000, "z", 8),
    (10, "a b\n\nc <s> <0x41> <|endoftext|>'s", "Z", 9), (11, "word " * 30000, "z", 10),
]


@pytest.fixture(scope="module")
def edges(spark):
    """Null, empty, long, tied and repeated rows; columns whose names operators use inside."""
    return spark.createDataFrame(
        ROWS, "doc_id long, text string, lang string, n_chars int"
    ).withColumns({
        "source": F.lit("s"), "root": F.lit(1), "leaf": F.lit(2), "position": F.lit(3),
        "block": F.lit(4), "pairs": F.lit(5), "token_ids": F.lit(6), "n_tokens": F.lit(7),
        "path": F.lit(8), "decoded": F.lit(9),
    })


@pytest.fixture(scope="module")
def texts(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    return {r["doc_id"]: r["text"] for r in docs}


def scrambled(parts, n, most, seed):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, most))) for _ in range(n)]


# -- BPE -----------------------------------------------------------------------------------

MIX = [
    "a", "b", "e", "th", "h", "'s", "'", "1", " ", "\t", "\r\n", "<|endoftext|>", "<|", "é",
    "é", "Σ", "ΣΑΣ", "İ", "中", "👍", "zz", "ing", "The", " ", "\x85", "\x1c", "ß", "!",
    "...", "́", "\x00",
]


@pytest.fixture(scope="module")
def coder():
    return bpe.WordTokenizer(q.tokenizer_path())


def library_ids(coder, texts):
    return [e.ids for e in coder.library.encode_batch(texts, add_special_tokens=False)]


def ids_of(coder, texts):
    return [np.frombuffer(x, "<u4").tolist() for x in coder.encode(texts)]


@pytest.mark.parametrize("parts, most", [(MIX, 40), (list("aabething"), 30), (list("xyzé"), 90)])
def test_same_ids_and_text_as_the_library(coder, parts, most):
    words = scrambled(parts, 4000, most, 5)
    found = coder.encode(words)
    expected = library_ids(coder, words)
    assert [np.frombuffer(x, "<u4").tolist() for x in found] == expected
    for x, ids in zip(found, expected):
        assert coder.decode(x).decode() == coder.library.decode(ids, skip_special_tokens=False)


def test_accepted_proposals_are_the_exact_encoding(coder):
    """Every proposal that passes the test of its borders is what merging gives, and some
    words of either kind occur."""
    words = list({w.encode() for w in scrambled(list("aabethingrs"), 6000, 14, 9) if w})
    speculator = coder.words
    before = speculator.tried, speculator.failed
    found = speculator.encode(words)
    assert found == [speculator.exact(w) for w in words]
    tried, failed = speculator.tried - before[0], speculator.failed - before[1]
    assert 0 < failed < tried == len(words)


def test_short_and_long_merging_agree(coder, monkeypatch):
    words = [w.encode() for w in scrambled(list("aabbeth"), 500, 60, 3) if w]
    short = [coder.words.exact(w) for w in words]
    monkeypatch.setattr(bpe, "SHORT", 0)
    assert [coder.words.exact(w) for w in words] == short


def test_a_small_memory_changes_nothing(coder, monkeypatch):
    words = scrambled(MIX, 300, 30, 4)
    expected = ids_of(coder, words)
    monkeypatch.setattr(bpe, "MOST_REMEMBERED", 1)
    assert [ids_of(coder, [w])[0] for w in words] == expected


def test_merges_out_of_order_and_other_tokenizers_are_refused():
    vocab = {"a": 0, "b": 1, "c": 2, "bc": 3, "abc": 4}
    bpe.Merges(vocab, [("b", "c"), ("a", "bc")])
    with pytest.raises(ValueError):
        bpe.Merges(vocab, [("a", "bc"), ("b", "c")])
    with pytest.raises(ValueError):
        bpe.WordTokenizer(q.tokenizer_path("byte_bpe_50k.json"))


def test_a_token_that_is_not_its_own_encoding_fails():
    """`abc` is made of a and bc, but ab comes first: it is never the encoding of its bytes."""
    vocab = {c: i for i, c in enumerate(["a", "b", "c", "ab", "bc", "abc"])}
    words = bpe.Speculator(vocab, [("a", "b"), ("b", "c"), ("a", "bc")], "")
    assert not words.merges.sound[vocab["abc"]]
    assert words.encode([b"abc", b"ab"]) == [[vocab["ab"], vocab["c"]], [vocab["ab"]]]
    assert words.failed == 1


def test_bpe_query(spark, coder, texts):
    expected = {}
    for doc_id, ids in zip(texts, library_ids(coder, [t or "" for t in texts.values()])):
        decoded = coder.library.decode(ids, skip_special_tokens=False)
        expected[doc_id] = (
            len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
            hashlib.sha256(decoded.encode()).hexdigest(),
        )
    found = q.QUERIES["op13_speculative_bpe"](spark, SF).collect()
    assert {r[0]: tuple(r)[1:] for r in found} == expected and len(found) == len(texts)


def test_bpe_on_edge_rows(spark, edges, coder):
    path = q.tokenizer_path()
    rows = bpe.decode(bpe.encode(edges, path, keep=("doc_id", "lang")), path).collect()
    expected = library_ids(coder, [r[1] or "" for r in ROWS])
    assert sorted(r["n_tokens"] for r in rows) == sorted(map(len, expected))
    assert bpe.encode(edges.limit(0), path).collect() == []
    nulls = bpe.decode(edges.select(F.lit(None).cast("binary").alias("token_ids"), "root"), path)
    assert {r["decoded"] for r in nulls.collect()} == {None}


# -- alignment -----------------------------------------------------------------------------

PARTS = [
    "a", "the", " ", "  ", "\n", "\n\n", "\r\n", "\t", "é", "中", "👍🏽", "▁", "<0x41>", "<s>",
    "<|endoftext|>", "'s", "22", " word", "word", "\xa0", "\x1c", "\x85", "...", "ing", "𐍈",
    "\x00", "\r", " {\r",
]


@pytest.fixture(scope="module")
def aligner():
    return alignment.Aligner(
        q.tokenizer_path("byte_bpe_50k.json"), q.tokenizer_path("piece_bpe_32k.model")
    )


def brute_groups(aligner, text):
    """Groups of one text by the lengths of all token bytes; none where they do not spell it."""
    if not text:
        return []
    whole = f" {text}"
    a, b = aligner.a.encode(whole, add_special_tokens=False).ids, aligner.b.encode(text)
    bytes_a, bytes_b = [aligner.a_bytes[i] for i in a], [aligner.b_bytes[i] for i in b]
    if not b"".join(bytes_a) == b"".join(bytes_b) == whole.encode():
        return []
    ends_a, ends_b = (np.cumsum([len(x) for x in y]).tolist() for y in (bytes_a, bytes_b))
    at_a, at_b = ({end: k + 1 for k, end in enumerate(x)} for x in (ends_a, ends_b))
    groups, i, j = [], 0, 0
    for end in sorted(at_a.keys() & at_b):
        m, n = at_a[end], at_b[end]
        groups.append((a[i:m], b[j:n]))
        i, j = m, n
    return groups


def groups_of(parts):
    a, b, m, n = (
        [x.values[s : s + k].tolist() for s, k in zip(x.starts, x.lengths)]
        for x in (parts[name] for name in alignment.PARTS[:4])
    )
    out = []
    for a_ids, b_ids, a_sizes, b_sizes in zip(a, b, m, n):
        i, j = np.cumsum([0, *a_sizes]), np.cumsum([0, *b_sizes])
        out.append([
            (a_ids[i[k] : i[k + 1]], b_ids[j[k] : j[k + 1]]) for k in range(len(a_sizes))
        ])
    return out


def brute_links(groups):
    return collections.Counter((x, y) for a, b in groups for x in a for y in b)


def test_groups_and_links_of_scrambled_texts(aligner):
    words = scrambled(PARTS, 3000, 14, 2)
    expected = [brute_groups(aligner, w) for w in words]
    assert any(not e for w, e in zip(words, expected) if w) and any(expected)
    parts = aligner.align(words)
    assert groups_of(parts) == expected
    pairs, times = parts["pairs"], parts["times"]
    for k, groups in enumerate(expected):
        here = slice(pairs.starts[k], pairs.starts[k] + pairs.lengths[k])
        found = collections.Counter()
        for pair, n in zip(pairs.values[here].tolist(), times.values[here].tolist()):
            found[divmod(pair, alignment.PAIR)] += n
        assert found == brute_links(groups)


def test_large_groups_are_counted_before_they_are_listed(aligner, monkeypatch):
    words = scrambled(PARTS, 400, 14, 8)
    expected = [x.values.tolist() for x in (aligner.align(words)["times"],)]
    total = sum(expected[0])
    monkeypatch.setattr(alignment, "SMALL", 1)
    aligner._forget()
    assert aligner.align(words)["times"].values.sum() == total
    aligner._forget()


def test_learning_adds_to_what_is_remembered(aligner):
    """What is known is not copied whenever a stretch is learnt."""
    aligner._forget()
    words = scrambled(PARTS, 2500, 14, 11)
    aligner.align(words[:2000])
    aligner.align(words[2000:2010])
    before = {name: part.values for name, part in aligner.parts.items()}
    expected = [brute_groups(aligner, w) for w in words[2010:2020]]
    assert groups_of(aligner.align(words[2010:2020])) == expected
    for name, part in aligner.parts.items():
        assert len(part.values) > len(before[name])
        assert np.shares_memory(part.values, before[name])


def test_room_is_made_between_blocks(aligner, monkeypatch):
    monkeypatch.setattr(alignment, "MOST_REMEMBERED", 40)
    words = scrambled(PARTS, 600, 14, 12)
    expected = [brute_groups(aligner, w) for w in words]
    for at in range(0, len(words), 20):
        own = [*words[at : at + 20], *words[:10]]
        assert groups_of(aligner.align(own)) == expected[at : at + 20] + expected[:10]
    aligner._forget()


def test_stretches_and_spans(aligner):
    """Cuts as the pattern between stretches has them; spans as in B's proto."""
    between = re.compile(r"(?<=\S)(?=[ \n]\s*\S)")
    for text in scrambled(PARTS, 3000, 14, 13):
        assert alignment.STRETCH.findall(f" {text}") == between.split(f" {text}")
        found = aligner.b.encode(text.encode(), return_type="offset_mapping")
        pieces = aligner.b.encode(text, return_type="proto").pieces
        assert list(found["ids"]) == [p.id for p in pieces]
        assert [end for _, end in found["offsets"]] == [p.end for p in pieces]


def brute_alignment(aligner, rows):
    """The rows of the contract for (doc_id, text) pairs."""
    groups = [brute_groups(aligner, text) for _, text in rows]
    links = [brute_links(g) for g in groups]
    count = collections.Counter(pair for x in links for pair in x)
    best = collections.defaultdict(int)
    for (a, _), n in count.items():
        best[a] = max(best[a], n)
    out = []
    for (doc_id, _), g, x in zip(rows, groups, links):
        text = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in g)
        out.append((
            doc_id, sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g),
            sum(x.values()), sum(n for p, n in x.items() if count[p] == best[p[0]]),
            sum(n * count[p] for p, n in x.items()),
            hashlib.sha256(text.encode()).hexdigest() if g else "",
        ))
    return sorted(out, key=repr)


CONTRACT = "doc_id n_a n_b n_groups n_links n_best count_sum groups_sha256".split()


def test_alignment_query(spark, aligner, texts):
    found = q.QUERIES["op11_token_alignment"](spark, SF).select(*CONTRACT).collect()
    assert sorted(map(tuple, found), key=repr) == brute_alignment(aligner, list(texts.items()))


@pytest.mark.parametrize("spread", [False, True])
def test_alignment_on_edge_rows(spark, edges, aligner, tmp_path, spread):
    """The same however rows fall into blocks; repeated rows, null ids and clashing names."""
    folder = str(tmp_path)
    edges.coalesce(2).write.parquet(f"{folder}/documents.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    if spread:
        docs = docs.repartition(5)
    found = alignment.align(docs, q.tokenizer_path("byte_bpe_50k.json"),
                            q.tokenizer_path("piece_bpe_32k.model"), keep=("doc_id", "root"))
    rows = alignment.scored(found.documents, found.pairs).collect()
    expected = brute_alignment(aligner, [(r[0], r[1]) for r in ROWS])
    shown = sorted((tuple(r[c] for c in CONTRACT[:-1]) for r in rows), key=repr)
    for r in rows:
        assert len(alignment.ids_of(r["a_ids"], r["n_a"])) == r["n_a"]
        assert len(alignment.ids_of(r["b_ids"], r["n_b"])) == r["n_b"]
        assert sum(r["a_last"]) == sum(r["b_last"]) == r["n_groups"]
    assert shown == sorted((e[:7] for e in expected), key=repr)
    assert {r["root"] for r in rows} == {1}
    empty = alignment.align(docs.limit(0), q.tokenizer_path("byte_bpe_50k.json"),
                            q.tokenizer_path("piece_bpe_32k.model"))
    assert alignment.scored(empty.documents, empty.pairs).collect() == []


# -- manifest ------------------------------------------------------------------------------


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def entry(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def brute_tree(nodes, fanout):
    """The last node and, for each, (slot, siblings) per level."""
    paths, place = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for path, at in zip(paths, place):
            first = at // fanout * fanout
            run = nodes[first : first + fanout]
            path.append((at - first, run[: at - first] + run[at - first + 1 :]))
        nodes = [sha(*nodes[i : i + fanout]) for i in range(0, len(nodes), fanout)]
        place = [at // fanout for at in place]
    return nodes[0], paths


def brute_manifest(rows, fanout):
    groups = collections.defaultdict(list)
    for doc_id, text, lang, n_chars in rows:
        leaf = sha(*map(entry, (doc_id, "s", lang, n_chars, text)))
        groups[lang].append((doc_id is not None, doc_id or 0, leaf, doc_id))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = []
    for name in order:
        leaves = sorted(groups[name], key=lambda x: x[:3])
        trees.append((leaves, *brute_tree([x[2] for x in leaves], fanout)))
    root, tops = brute_tree([t[1] for t in trees], fanout)
    return sorted((
        (leaf[3], leaf[2], subroot, root, sha(*[x for _, s in path + top for x in s]))
        for (leaves, subroot, paths), top in zip(trees, tops)
        for leaf, path in zip(leaves, paths)
    ), key=repr)


def manifest_rows(docs, **how):
    found = merkle.manifest(docs, q.DIGESTED, "lang", "doc_id", **how)
    proof = F.array_join(F.transform(merkle.siblings(F.col("path")), merkle.as_hex), "")
    rows = found.select(
        "doc_id", *[merkle.as_hex(F.col(c)) for c in ("leaf", "subroot", "root")],
        F.sha2(proof, 256), merkle.fold(F.col("leaf"), F.col("path")) == F.col("root"),
    ).collect()
    assert all(r[5] for r in rows)
    return sorted((tuple(r[:5]) for r in rows), key=repr)


@pytest.mark.parametrize("fanout, levels", [(2, 9), (2, 1), (2, 3), (3, 2), (5, 1)])
def test_manifest_of_any_shape(spark, edges, fanout, levels):
    """Null and repeated keys and groups; several rounds of blocks; short last runs."""
    found = manifest_rows(edges, fanout=fanout, levels=levels)
    assert found == brute_manifest(ROWS, fanout)


@pytest.mark.parametrize("n", [1, 2, 9, 33, 65])
def test_manifest_of_groups_of_every_size(spark, n):
    rows = [(i, f"t{i}", "ab"[i % n == 0], i) for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, n_chars int")
    docs = docs.withColumn("source", F.lit("s")).repartition(4)
    assert manifest_rows(docs, levels=2) == brute_manifest(rows, 2)


def test_manifest_of_an_empty_table(spark, edges):
    assert manifest_rows(edges.limit(0)) == []


def test_manifest_query(spark):
    run = q.QUERIES["op12_merkle_manifest"](spark, SF)
    assert difference(connect(SF), run, q.SQL["op12_merkle_manifest"]) is None
    bad = {r["doc_id"] for r in run.filter("NOT verified").collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").filter("n_chars IS NOT NULL").collect()
    import zlib

    assert bad == {r["doc_id"] for r in docs if zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0}
