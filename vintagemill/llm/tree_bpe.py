"""Byte-level byte-pair encoding by a segment tree over the ranks of adjacent pairs, and decoding."""

from __future__ import annotations

import hashlib
import json
import os
import re
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vintagemill.llm.batches import bound_batches
from vintagemill.llm.memory import ByteMemory
from vintagemill.llm.tokens import tokenizer_path

# fixed values: the splitting rule of byte-level vocabularies
_SPLIT = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
#: Below this sign the pattern's letters, numbers and spaces are the library's; from it on the library itself splits.
_SURE = "\u0530"

# byte-level vocabularies write a byte that is no printable Latin-1 sign as the next sign from U+0100 on
_PRINTABLE = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
_SIGN_OF = {b: chr(b) for b in _PRINTABLE} | {b: chr(0x100 + i) for i, b in enumerate(b for b in range(256) if b not in _PRINTABLE)}
_BYTE_OF = {sign: b for b, sign in _SIGN_OF.items()}

_NONE = np.iinfo(np.int32).max  # rank of a pair that is not merged
#: Pre-tokens up to so many bytes are merged in step with each other, longer ones one by one, with equal results.
_IN_STEP = 64
_WORDS_A_STEP = 20_000


class PairTree:
    """A segment tree over the pairs of one sequence: a leaf holds its pair's rank, an inner node the least below it."""

    def __init__(self, ranks: Iterable[int]):
        ranks = array("i", ranks)
        self.size = 1 << max(0, len(ranks) - 1).bit_length()
        empty = array("i", [_NONE])
        self.least = empty * self.size + ranks + empty * (self.size - len(ranks))
        least = np.frombuffer(self.least, np.int32)
        level = self.size
        while level > 1:
            level //= 2
            np.minimum(least[2 * level: 4 * level: 2], least[2 * level + 1: 4 * level: 2], out=least[level: 2 * level])

    def first_least(self) -> tuple[int, int]:
        """The root's rank, and the leftmost pair that has it."""
        least, at = self.least, 1
        rank = least[1]
        while at < self.size:
            at = 2 * at + (least[2 * at] != rank)
        return rank, at - self.size

    def set(self, pair: int, rank: int) -> None:
        least, at = self.least, pair + self.size
        least[at] = rank
        while at > 1:
            at //= 2
            found = min(least[2 * at], least[2 * at + 1])
            if least[at] == found:
                return
            least[at] = found


class TreeMerges:
    """The merges of a byte-level vocabulary file of the tokenizers library."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, split = spec["model"], spec["pre_tokenizer"] or {}
        plain = not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges", "byte_fallback"))
        if not (model["type"] == "BPE" and plain and split.get("type") == "ByteLevel" and split.get("use_regex", True)
                and not split["add_prefix_space"] and spec["normalizer"] is None and spec["post_processor"] is None):
            raise ValueError(f"{path} is no plain byte-level vocabulary")
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
            raise ValueError(f"{path} has added tokens that take in their surroundings")
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        vocab = model["vocab"]
        spelled = {i: bytes(map(_BYTE_OF.__getitem__, t)) for t, i in vocab.items()}
        spelled |= {i: t.encode() for t, i in self.added.items()}
        self.spelled = [spelled.get(i, b"") for i in range(max(spelled) + 1)]
        self.byte_ids = np.array([vocab[_SIGN_OF[b]] for b in range(256)], np.int32)
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        rows = sorted((vocab[a] << 32 | vocab[b], rank, vocab[a + b]) for rank, (a, b) in enumerate(merges))
        keys, ranks, merged = zip(*rows)
        self.keys, self.ranks, self.merged = np.array(keys, np.int64), np.array(ranks, np.int32), np.array(merged, np.int32)
        self.pairs = {k: (r, m) for k, r, m in rows}
        # neighbours of bytes within tokens: where two others meet, no merge can ever reach across
        self.inside = np.zeros((256, 256), bool)
        for token in set(spelled.values()):
            own = np.frombuffer(token, np.uint8)
            self.inside[own[:-1], own[1:]] = True

    def _pair(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and merged id of pairs of ids."""
        wanted = a.astype(np.int64) << 32 | b
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.ranks[at], _NONE), self.merged[at]

    def encode(self, words: list[bytes]) -> list[bytes]:
        """Ids of pre-tokens as little-endian unsigned 32-bit integers."""
        out: list[bytes] = [b""] * len(words)
        by_size: dict[int, list[int]] = {}
        for i, word in enumerate(words):
            if len(word) > _IN_STEP:
                out[i] = self._long(word)
            elif word:
                by_size.setdefault(1 << max(0, len(word) - 2).bit_length(), []).append(i)
        for size, some in by_size.items():
            for lo in range(0, len(some), _WORDS_A_STEP):
                part = some[lo: lo + _WORDS_A_STEP]
                for i, ids in zip(part, self._in_step([words[i] for i in part], size)):
                    out[i] = ids
        return out

    def _in_step(self, words: list[bytes], size: int) -> list[bytes]:
        """One segment tree of ``size`` pairs a word, a merge a word at a time; words have at most ``size + 1`` bytes."""
        n, width = len(words), size + 1
        lengths = np.array(list(map(len, words)))
        alive = np.arange(width) < lengths[:, None]
        piece = np.zeros((n, width), np.int32)
        piece[alive] = self.byte_ids[np.frombuffer(b"".join(words), np.uint8)]
        follow, before = np.tile(np.arange(1, width + 1), (n, 1)), np.tile(np.arange(-1, width - 1), (n, 1))
        least = np.full((n, 2 * size), _NONE, np.int32)
        row, at = np.nonzero(alive[:, 1:])
        least[row, size + at] = self._pair(piece[row, at], piece[row, at + 1])[0]
        level = size
        while level > 1:
            level //= 2
            np.minimum(least[:, 2 * level: 4 * level: 2], least[:, 2 * level + 1: 4 * level: 2], out=least[:, level: 2 * level])
        rows = np.arange(n)
        while len(rows):
            rank = least[rows, 1]
            rows, rank = rows[rank != _NONE], rank[rank != _NONE]
            node = np.ones(len(rows), np.int64)
            while len(node) and node[0] < size:  # down to the leftmost pair with the root's rank
                node = 2 * node + (least[rows, 2 * node] != rank)
            a = node - size
            b = follow[rows, a]
            end = follow[rows, b]
            own = self._pair(piece[rows, a], piece[rows, b])[1]
            piece[rows, a], follow[rows, a], alive[rows, b] = own, end, False
            inside = end < lengths[rows]
            right = np.full(len(rows), _NONE, np.int32)
            right[inside] = self._pair(own[inside], piece[rows[inside], end[inside]])[0]
            before[rows[inside], end[inside]] = a[inside]
            left = before[rows, a]
            some = left >= 0
            least[rows, size + a] = right
            at = np.minimum(b, size - 1)  # the last byte leads no pair: its place is that of a pair that ends in it
            gone = b < size
            least[rows[gone], size + b[gone]] = _NONE
            least[rows[some], size + left[some]] = self._pair(piece[rows[some], left[some]], own[some])[0]
            nodes = np.stack([a, at, np.where(some, left, a)]) + size
            while size > 1 and len(rows) and nodes[0, 0] > 1:
                nodes >>= 1
                for up in nodes:
                    least[rows, up] = np.minimum(least[rows, 2 * up], least[rows, 2 * up + 1])
        flat, counts = piece[alive].astype("<u4").tobytes(), 4 * alive.sum(1)
        return [flat[e - c: e] for e, c in zip(np.cumsum(counts).tolist(), counts.tolist())]

    def _long(self, word: bytes) -> bytes:
        """Cut where no merge can reach across, which leaves the same merges on both sides."""
        own = np.frombuffer(word, np.uint8)
        cuts = [0, *(np.flatnonzero(~self.inside[own[:-1], own[1:]]) + 1).tolist(), len(word)]
        parts = [word[a:b] for a, b in zip(cuts, cuts[1:])]
        short = list({p for p in parts if len(p) <= _IN_STEP})
        known = dict(zip(short, self.encode(short)))
        return b"".join([known[p] if p in known else self._merge(p) for p in parts])

    def _merge(self, word: bytes) -> bytes:
        """One sequence by itself."""
        n, pairs, none = len(word), self.pairs, (_NONE, -1)
        first = self.byte_ids[np.frombuffer(word, np.uint8)]
        piece = array("i", first.tobytes())
        follow, before = array("i", range(1, n + 1)), array("i", range(-1, n - 1))
        tree = PairTree(array("i", self._pair(first[:-1], first[1:])[0].tobytes()))
        while True:
            rank, a = tree.first_least()
            if rank == _NONE:
                break
            b = follow[a]
            end = follow[b]
            piece[a] = pairs[piece[a] << 32 | piece[b]][1]
            piece[b] = -1
            follow[a] = end
            if b < n - 1:
                tree.set(b, _NONE)
            if end < n:
                before[end] = a
                tree.set(a, pairs.get(piece[a] << 32 | piece[end], none)[0])
            else:
                tree.set(a, _NONE)
            left = before[a]
            if left >= 0:
                tree.set(left, pairs.get(piece[left] << 32 | piece[a], none)[0])
        ids = np.frombuffer(piece, np.int32)
        return ids[ids >= 0].astype("<u4").tobytes()


class TreeEncoder:
    """Encodes whole texts by words between spaces and line ends, each distinct word once while it is remembered."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.merges = TreeMerges(path)
        self.split_by_library = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
        self.memory = ByteMemory()
        added = sorted(self.merges.added, key=len, reverse=True)
        self.added = re.compile("(" + "|".join(map(re.escape, added)) + ")") if added else None
        # a line end that is kept in front of a word and stands for no space is the first of its ids
        self.line_end = self.merges.encode([b"\n"])[0]

    def pre_tokens(self, text: str) -> list[str]:
        if text.isascii() or max(text) < _SURE:
            return _SPLIT.findall(text)
        return [text[a:b] for _, (a, b) in self.split_by_library(text)]

    def _learn(self, texts: list[str]) -> list[bytes]:
        """Ids of texts, their distinct pre-tokens encoded together."""
        split = [self.pre_tokens(t) for t in texts]
        distinct = list(set().union(*split))
        known = dict(zip(distinct, self.merges.encode([w.encode() for w in distinct])))
        return [b"".join([known[w] for w in words]) for words in split]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids as little-endian unsigned 32-bit integers; strings of added tokens become their ids."""
        if self.added is None or not any(self.added.search(t) for t in texts):
            return self._encode(texts)
        split = [self.added.split(t) for t in texts]
        plain = iter(self._encode([x for parts in split for x in parts[::2]]))
        added = {t: np.array([i], "<u4").tobytes() for t, i in self.merges.added.items()}
        return [b"".join([added[x] if i % 2 else next(plain) for i, x in enumerate(parts)]) for parts in split]

    def _encode(self, texts: list[str]) -> list[bytes]:
        """A word goes with the space before it, or with the line end: a pre-token reaches across neither.

        Runs of white space are the exception; a text that has some is split as a whole.
        """
        known = self.memory.known
        found: dict[str, bytes] = {}
        out: list[list[bytes] | None] = []
        missing: set[str] = set()
        whole: dict[int, str] = {}
        split: list[list[str]] = []
        for i, text in enumerate(texts):
            words = ("\n" + text).replace("\n", " \n").split(" ")[1:]
            ids = list(map(known.get, words))
            if None in ids:
                new = {w for w, x in zip(words, ids) if x is None}
                if any(_has_edge_space(w) for w in new):
                    whole[i], ids, words = text, None, []
                else:
                    missing |= new
            out.append(ids)
            split.append(words)
        if missing:
            order = list(missing)
            found = dict(zip(order, self._learn([w if w[0] == "\n" else " " + w for w in order])))
            for ids, words in zip(out, split):
                if ids is not None and None in ids:
                    ids[:] = [found[w] if x is None else x for w, x in zip(words, ids)]
            self.memory.keep(found)
        encoded = dict(zip(whole, self._learn(list(whole.values()))))
        skip = len(self.line_end)
        return [encoded[i] if ids is None else b"".join(ids)[skip:] for i, ids in enumerate(out)]


def _has_edge_space(word: str) -> bool:
    """Whether white space, besides one line end in front, is at a word's ends or all there is."""
    rest = word[1:] if word[:1] == "\n" else word
    return not rest or rest[0].isspace() or rest[-1].isspace()


def in_slices(texts: list[str], chars: int = 2_000_000) -> Iterator[slice]:
    """Consecutive texts of a bounded size together, at least one."""
    lo = held = 0
    for hi, text in enumerate(texts, 1):
        held += len(text)
        if held >= chars or hi == len(texts):
            yield slice(lo, hi)
            lo, held = hi, 0


@lru_cache(maxsize=2)
def _encoder(path: str) -> TreeEncoder:
    return TreeEncoder(path)


@lru_cache(maxsize=2)
def _tables(path: str) -> tuple[pa.Array, pa.Array]:
    """Bytes and decimals, each followed by a comma, of every id."""
    spelled = TreeMerges(path).spelled
    return pa.array(spelled, pa.large_binary()), pa.array([b"%d," % i for i in range(len(spelled))], pa.large_binary())


def _joined(table: pa.Array, ids: pa.Array) -> memoryview:
    """Entries of all ids one after the other."""
    taken = table.take(ids)
    return memoryview(taken.buffers()[2] or b"").cast("B")


def encode(docs: DataFrame, tokenizer: str = "byte_bpe_50k.json") -> DataFrame:
    """doc_id, ids (little-endian unsigned 32-bit integers, as binary) of every whole text.

    The ids are those of the tokenizers library without special tokens added; strings of
    added tokens within a text become their ids.  The root of a segment tree over the
    ranks of adjacent pairs gives the leftmost merge of lowest rank; a merge changes three
    leaves and the nodes above them; no rank at the root ends a pre-token.  One row per
    input row, repeated ones too; a NULL text counts as empty and has no ids; a NULL doc_id
    stays NULL; an empty table gives an empty table; other columns than doc_id and text are
    not looked at.  A pre-token of n bytes needs about 20 n bytes while it is worked on.
    """
    bound_batches(docs.sparkSession)
    path = tokenizer_path(tokenizer)

    def encode_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for part in in_slices(texts):
                ids = pa.array(encoder.encode(texts[part]), pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column("doc_id")[part.start: part.stop], ids], ["doc_id", "ids"])

    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).mapInArrow(encode_batches, "doc_id long, ids binary")


def decode(encoded: DataFrame, tokenizer: str = "byte_bpe_50k.json") -> DataFrame:
    """doc_id, text, n_tokens, ids_sha256 (of the decimal ids with commas between) of encoded rows.

    Bytes that are no UTF-8 become U+FFFD.  NULL ids count as none; repeated rows stay; an empty
    table gives an empty table; other columns than doc_id and ids are not looked at.
    """
    path = tokenizer_path(tokenizer)

    def decode_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spelled, decimals = _tables(path)
        widths = [np.diff(np.frombuffer(t.buffers()[1], np.int64)) for t in (spelled, decimals)]
        for batch in batches:
            rows = [x or b"" for x in batch.column("ids").to_pylist()]
            for part in in_slices(rows):
                ids = np.frombuffer(b"".join(rows[part]), "<u4").astype(np.int64)
                counts = np.array([len(x) // 4 for x in rows[part]], np.int64)
                ends = np.cumsum(counts)
                column = pa.array(ids)
                cut = []
                for table, width in zip((spelled, decimals), widths):
                    upto = np.concatenate([[0], np.cumsum(width[ids])])
                    flat, starts, stops = _joined(table, column), upto[ends - counts].tolist(), upto[ends].tolist()
                    cut.append([flat[a:b] for a, b in zip(starts, stops)])
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id")[part.start: part.stop],
                    pa.array([str(x, "utf-8", "replace") for x in cut[0]], pa.string()),
                    pa.array(counts),
                    pa.array([hashlib.sha256(x[:-1]).hexdigest() for x in cut[1]]),
                ], ["doc_id", "text", "n_tokens", "ids_sha256"])

    return encoded.select("doc_id", "ids").mapInArrow(decode_batches, "doc_id long, text string, n_tokens long, ids_sha256 string")
