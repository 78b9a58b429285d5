"""BPE encoding by speculation and verification, and decoding.

Greedy longest match proposes tokens for a word. A proposal is the encoding exactly when
every token is its own encoding and every two neighbours are compatible, that is, when no
merge across their border would have come before the merges on either side had used up its
parts. All borders of a batch of words are tested at once on numpy arrays; only the words
that fail are merged step by step.

The test rests on two facts about the list of merges, which are checked when it is loaded:
a merge makes a token of its own, and it comes after the merges that made its parts. Then
the first merge of a text that crosses a border of proposed tokens depends on the two tokens
at that border alone. At the border, a suffix u of the left token lives from the merge that
made it to the merge that takes it up, a prefix v of the right token likewise; the border is
crossed if a merge (u, v) falls in both lives. A merge of equal rank goes to the left first,
so v may still be used by the very merge that would take it up, u may not.

Tokenizers of the kind "white space is dropped, words are byte letters" are accepted; others
are refused. Texts are cut at blanks, and the tokens of a stretch between blanks, like those
of a word, are remembered in a bounded memory. A null or empty text has no tokens. Texts of
any length are encoded whole, in linear memory. Repeated rows are encoded each.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterable, Iterator
from string import ascii_letters

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from estrato.llm.common import SPACE, arrow_ready, fields, record

NEVER = np.iinfo(np.int64).max
MOST_REMEMBERED = 600_000
SHORT = 64  # letters up to which looking through all pairs beats a heap
PORTION = 1 << 21  # characters worked on at a time


def byte_letters() -> list[str]:
    """The letters that stand for bytes in byte-level vocabularies. Printable
    Latin-1 stands for itself, the other bytes for U+0100 on, in order."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = (chr(256 + i) for i in range(256))
    return [chr(b) if b in shown else next(hidden) for b in range(256)]


class Merges:
    """The merges of a vocabulary as arrays over token ids.

    left, right: the two parts of a token, -1 for a single letter; born: the rank of the
    merge that makes it, -1 for a letter; sound: whether a token is its own encoding.
    """

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]]):
        n = max(vocab.values()) + 1
        self.left, self.right, self.born = (np.full(n, -1, np.int64) for _ in range(3))
        pairs = np.array([(vocab[a], vocab[b]) for a, b in merges], np.int64).reshape(-1, 2)
        made = np.array([vocab[a + b] for a, b in merges], np.int64)
        self.left[made], self.right[made] = pairs.T
        self.born[made] = np.arange(len(made))
        if len(np.unique(made)) < len(made):
            raise ValueError("two merges make the same token")
        if (self.born[pairs].max(axis=1, initial=-1) >= np.arange(len(made))).any():
            raise ValueError("a merge comes before the merges that make its parts")
        keys = self._key(pairs[:, 0], pairs[:, 1])
        order = np.argsort(keys)
        self.keys, self.ranks = keys[order], order
        self.rank_of = dict(zip(map(tuple, pairs.tolist()), range(len(made))))
        self.token_of = made.tolist()
        self.sound = np.ones(n, bool)
        whole = self._crossed(pairs[:, 0], pairs[:, 1], made)
        for token in made[np.argsort(self.born[made])].tolist():
            parts = self.left[token], self.right[token]
            self.sound[token] = self.sound[parts[0]] and self.sound[parts[1]]
            self.sound[token] &= not whole[self.born[token]]

    @staticmethod
    def _key(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return (a << 32) | b

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of the merge of each pair; NEVER where there is none."""
        if not len(self.keys):
            return np.full(len(a), NEVER)
        keys = self._key(a, b)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.ranks[at], NEVER)

    def _crossed(self, a: np.ndarray, b: np.ndarray, whole: np.ndarray | None = None) -> np.ndarray:
        """Whether a merge crosses the border of each pair, other than the one that makes
        `whole`. Walks down both sides, each time splitting the part that was made later."""
        out = np.zeros(len(a), bool)
        rows, u, v = np.arange(len(a)), a, b
        u_ends, v_ends = np.full(len(a), NEVER), np.full(len(a), NEVER)
        while len(rows):
            rank = self.rank(u, v)
            hit = (rank < u_ends) & (rank <= v_ends) & (rank < NEVER)
            if whole is not None:
                hit &= rank != self.born[whole[rows]]
            out[rows[hit]] = True
            on = ~hit & ((self.born[u] >= 0) | (self.born[v] >= 0))
            rows, u, v, u_ends, v_ends = (x[on] for x in (rows, u, v, u_ends, v_ends))
            split_u = self.born[u] > self.born[v]
            u_ends = np.where(split_u, self.born[u], u_ends)
            v_ends = np.where(split_u, v_ends, self.born[v])
            u, v = np.where(split_u, self.right[u], u), np.where(split_u, v, self.left[v])
        return out

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        keys, back = np.unique(self._key(a, b), return_inverse=True)
        return ~self._crossed(keys >> 32, keys & 0xFFFFFFFF)[back]

    def merge(self, letters: list[int]) -> list[int]:
        """The encoding of a sequence of letters, merge by merge: least rank first, from the
        left among equals."""
        if len(letters) <= SHORT:
            return self._merge_short(list(letters))
        tokens, n = list(letters), len(letters)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [
            (self.rank_of[pair], i) for i, pair in enumerate(zip(tokens, tokens[1:]))
            if pair in self.rank_of
        ]
        heapq.heapify(heap)
        while heap:
            rank, i = heapq.heappop(heap)
            j = after[i] if tokens[i] is not None else n
            if j >= n or self.rank_of.get((tokens[i], tokens[j])) != rank:
                continue
            tokens[i], tokens[j], after[i] = self.token_of[rank], None, after[j]
            if after[i] < n:
                before[after[i]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y < n and (tokens[x], tokens[y]) in self.rank_of:
                    heapq.heappush(heap, (self.rank_of[tokens[x], tokens[y]], x))
        return [t for t in tokens if t is not None]

    def _merge_short(self, tokens: list[int]) -> list[int]:
        rank_of = self.rank_of
        ranks = [rank_of.get(pair, NEVER) for pair in zip(tokens, tokens[1:])]
        while ranks:
            rank = min(ranks)
            if rank == NEVER:
                break
            i = ranks.index(rank)
            tokens[i] = self.token_of[rank]
            del tokens[i + 1], ranks[i]
            if i:
                ranks[i - 1] = rank_of.get((tokens[i - 1], tokens[i]), NEVER)
            if i < len(ranks):
                ranks[i] = rank_of.get((tokens[i], tokens[i + 1]), NEVER)
        return tokens


class Speculator:
    """Encodes words (bytes) in batches; `failed` counts those that had to be merged."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]], suffix: str):
        self.merges = Merges(vocab, merges)
        byte_of = {letter: b for b, letter in enumerate(byte_letters())}
        self.inner: dict[bytes, int] = {}
        self.last: dict[bytes, int] = {}
        for token, i in vocab.items():
            if suffix and token.endswith(suffix):
                table, token = self.last, token[: -len(suffix)]
            else:
                table = self.inner
            table[bytes(byte_of[c] for c in token)] = i
        if not suffix:
            self.last = self.inner
        self.longest = max(map(len, [*self.inner, *self.last]))
        self.tried = self.failed = 0

    def propose(self, word: bytes) -> list[int]:
        found, at, end = [], 0, len(word)
        while at < end:
            token = self.last.get(word[at:]) if end - at <= self.longest else None
            if token is not None:
                found.append(token)
                break
            for to in range(min(end - 1, at + self.longest), at, -1):
                token = self.inner.get(word[at:to])
                if token is not None:
                    found.append(token)
                    at = to
                    break
        return found

    def encode(self, words: list[bytes]) -> list[list[int]]:
        proposed = [self.propose(word) for word in words]
        sizes = np.array([len(p) for p in proposed], np.int64)
        ids = np.fromiter((i for p in proposed for i in p), np.int64, int(sizes.sum()))
        owner = np.repeat(np.arange(len(words)), sizes)
        fails = np.zeros(len(words), bool)
        fails[owner[~self.merges.sound[ids]]] = True
        borders = np.flatnonzero(owner[:-1] == owner[1:])
        bad = ~self.merges.compatible(ids[borders], ids[borders + 1])
        fails[owner[borders[bad]]] = True
        for i in np.flatnonzero(fails).tolist():
            proposed[i] = self.exact(words[i])
        self.tried += len(words)
        self.failed += int(fails.sum())
        return proposed

    def exact(self, word: bytes) -> list[int]:
        letters = [self.inner[word[i : i + 1]] for i in range(len(word) - 1)]
        return self.merges.merge([*letters, self.last[word[-1:]]]) if word else []


class WordTokenizer:
    """A tokenizer file that drops white space, encoded through a `Speculator`.

    The library normalises and splits; special tokens are found in the raw text as it does.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            told = json.load(file)
        self.library = Tokenizer.from_file(path)
        model = told["model"]
        self._check(told, model)
        merges = [tuple(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
        self.words = Speculator(model["vocab"], merges, model["end_of_word_suffix"] or "")
        self.special = {t["content"]: t["id"] for t in told["added_tokens"]}
        self.letters = self._letters_are_words()
        self.special_cut = re.compile(
            "(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")"
        ) if self.special else None
        self.byte_of = {letter: b for b, letter in enumerate(byte_letters())}
        names = {i: t.encode() for t, i in {**model["vocab"], **self.special}.items()}
        self.names = [names.get(i, b"") for i in range(max(names) + 1)]
        self.known = np.array([i in names for i in range(len(self.names))])
        self.of_word: dict[bytes, list[int]] = {}
        self.of_stretch: dict[str, bytes] = {"": b""}

    def _check(self, told: dict, model: dict) -> None:
        unlike = [
            model["type"] != "BPE", model.get("dropout"), model.get("continuing_subword_prefix"),
            model.get("byte_fallback"), model.get("ignore_merges"), told.get("decoder"),
            self.library.encode(f"a{SPACE}", add_special_tokens=False).ids
            != self.library.encode("a", add_special_tokens=False).ids,
            any(
                t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"]
                or set(t["content"]) & set(SPACE) for t in told["added_tokens"]
            ),
        ]
        if any(unlike):
            raise ValueError("only byte-letter BPE without decoder that drops white space")

    def _letters_are_words(self) -> bool:
        """Whether runs of the letters A-Z, in either case, are lower-cased and not split."""
        every = [a + b for a in ascii_letters for b in ascii_letters]
        plain = self.library.normalizer.normalize_str(" ".join(every))
        pieces = [p for p, _ in self.library.pre_tokenizer.pre_tokenize_str(plain)]
        return pieces == [pair.lower() for pair in every]

    def _split(self, stretch: str) -> list[bytes | int]:
        """Words as bytes and ids of special tokens, in order."""
        if self.letters and stretch.isascii() and stretch.isalpha():
            return [stretch.lower().encode()]
        found: list[bytes | int] = []
        for part in self.special_cut.split(stretch) if self.special_cut else [stretch]:
            if part in self.special:
                found.append(self.special[part])
            elif part:
                plain = self.library.normalizer.normalize_str(part)
                found += [
                    bytes(map(self.byte_of.__getitem__, letters))
                    for letters, _ in self.library.pre_tokenizer.pre_tokenize_str(plain)
                    if letters
                ]
        return found

    def _learn(self, stretches: Iterable[str]) -> None:
        parts = {s: self._split(s) for s in stretches}
        new = list({
            p for found in parts.values() for p in found
            if isinstance(p, bytes) and p not in self.of_word
        })
        self.of_word.update(zip(new, self.words.encode(new)))
        for s, found in parts.items():
            ids = [i for p in found for i in ([p] if isinstance(p, int) else self.of_word[p])]
            self.of_stretch[s] = b"".join([i.to_bytes(4, "little") for i in ids])

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, little-endian, 32 bits each."""
        if len(self.of_stretch) + len(self.of_word) > MOST_REMEMBERED:
            self.of_word.clear()
            self.of_stretch = {"": b""}
        cut = [self._stretches(text) for text in texts]
        self._learn({s for stretches in cut for s in stretches}.difference(self.of_stretch))
        return [b"".join(map(self.of_stretch.__getitem__, stretches)) for stretches in cut]

    @staticmethod
    def _stretches(text: str) -> list[str]:
        for blank in SPACE[1:]:
            text = text.replace(blank, " ")
        return text.split(" ")

    def decode(self, ids: bytes) -> bytes:
        """The names of the tokens, joined by blanks, as the library joins them where a
        tokenizer has no decoder; ids that it does not know are left out."""
        ids = np.frombuffer(ids, "<u4")
        ids = ids[ids < len(self.names)]
        return b" ".join([self.names[i] for i in ids[self.known[ids]].tolist()])


_tokenizers: dict[str, WordTokenizer] = {}


def tokenizer(path: str) -> WordTokenizer:
    """One per Python worker, kept over its tasks."""
    if path not in _tokenizers:
        _tokenizers[path] = WordTokenizer(path)
    return _tokenizers[path]


def portions(sizes: list[int], most: int = PORTION) -> Iterator[slice]:
    """Slices of consecutive items of about `most` in total, or one larger item."""
    first = total = 0
    for i, size in enumerate(sizes):
        if total and total + size > most:
            yield slice(first, i)
            first, total = i, 0
        total += size
    if first < len(sizes):
        yield slice(first, len(sizes))


def encode(
    docs: DataFrame, path: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",),
) -> DataFrame:
    """The columns in `keep`, `token_ids` (little-endian 32 bits each) and `n_tokens`."""
    schema = T.StructType(
        [docs.schema[c] for c in keep] + fields("token_ids binary, n_tokens long")
    )
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = tokenizer(path)
        for batch in batches:
            kept = list(zip(*(batch.column(i).to_pylist() for i in range(len(keep)))))
            texts = [t or "" for t in batch.column(len(keep)).to_pylist()]
            for part in portions([len(t) for t in texts]):
                ids = coder.encode(texts[part])
                rows = kept[part] if keep else [()] * len(ids)
                yield record(arrow, [
                    (*row, i, len(i) // 4) for row, i in zip(rows, ids)
                ])

    return arrow_ready(docs.select(*keep, docs[text].alias("__text"))).mapInArrow(run, schema)


def decode(rows: DataFrame, path: str, token_ids: str = "token_ids") -> DataFrame:
    """The rows with `decoded`, the text of their tokens; null ids have none."""
    names = [c for c in rows.columns if c != "decoded"]
    schema = T.StructType([rows.schema[c] for c in names] + fields("decoded string"))
    arrow = to_arrow_schema(schema)
    at = names.index(token_ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = tokenizer(path)
        for batch in batches:
            ids = batch.column(at).to_pylist()
            for part in portions([len(i or b"") for i in ids]):
                texts = [
                    None if i is None else coder.decode(i).decode()
                    for i in ids[part]
                ]
                size = part.stop - part.start
                columns = [
                    c.cast(f.type) for c, f in zip(batch.slice(part.start, size).columns, arrow)
                ]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(texts, pa.string())], schema=arrow
                )

    return arrow_ready(rows.select(*names)).mapInArrow(run, schema)
