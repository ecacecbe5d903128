"""Byte-pair pieces with seeded merge-dropout: varied segmentations that decode to the same text."""

from __future__ import annotations

import heapq
import itertools
import math
import zlib
from collections.abc import Callable, Iterator
from functools import cached_property, lru_cache

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vintagemill.llm.batches import bound_batches
from vintagemill.llm.memory import MEMORY_BYTES
from vintagemill.llm.tokens import tokenizer_path

WORD_START = "▁"
DROPOUT, SEED = 0.1, 17
_ODD = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)
_WORD = (1 << 64) - 1
#: Words up to so many signs are merged in step with each other, longer ones by a heap, with equal results.
_IN_STEP = 48
#: Words are kept in tables of their length, so that short ones take little room.
_WIDTHS = (6, 9, 12, 16, 24, 48)
_NONE = np.iinfo(np.int32).max
_WORDS_AT_ONCE, _ROWS_IN_STEP = 100_000, 50_000
_ENTRY = 320  # what a word takes besides its spans


def _skips(base: int, limit: int) -> Callable[[int, int, int], bool]:
    """Whether the pair with these three ends is skipped: its hash falls below the limit."""
    def skips(a: int, b: int, end: int) -> bool:
        h = (base ^ a * _ODD[0] ^ b * _ODD[1] ^ end * _ODD[2]) & _WORD
        h = ((h ^ h >> 33) * _ODD[1]) & _WORD
        h = ((h ^ h >> 29) * _ODD[0]) & _WORD
        return (h ^ h >> 32) < limit

    return skips


class MergePieces:
    """The merge-type vocabulary of a sentencepiece file."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.ids: dict[str, int] = {}
        self.rank: dict[str, float] = {}
        self.bytes = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.spelled: list[bytes] = []
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.spelled.append(bytes([int(piece[1:-1], 16)]))
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                self.spelled.append(b"")
            else:
                self.spelled.append(piece.replace(WORD_START, " ").encode())
                self.ids[piece], self.rank[piece] = i, -model.get_score(i)

    def segment(self, word: str, key: int, dropout: float, spaced: bool) -> list[int]:
        """Ids of one word; if ``spaced``, its first sign stands for the space before it.

        The agenda holds adjacent pairs that a piece spells, best rank first, then
        leftmost.  A pair that comes up is merged, unless a hash of the key, the word and
        the pair's three ends falls below ``dropout``: then it is never merged.
        Characters that are no pieces become their bytes, any other word-start sign too.
        """
        signs = [c if c in self.ids and (c != WORD_START or spaced and not i) else None for i, c in enumerate(word)]
        limit = int(dropout * 2.0**64)
        skips = _skips(xxhash.xxh64_intdigest(word, key), limit) if limit else None
        parts = self._agenda(word, signs, skips)
        at, out = 0, []
        for part in parts:
            out += [self.bytes[x] for x in word[at].encode()] if part is None else [self.ids[part]]
            at += 1 if part is None else len(part)
        return out

    def segment_by(self, word: str, spaced: bool, skips: Callable[[int], bool]) -> tuple[list[int], int]:
        """As ``segment``, with the pairs whose number ``skips`` names, as they come up, skipped; and how many came up."""
        signs = [c if c in self.ids and (c != WORD_START or spaced and not i) else None for i, c in enumerate(word)]
        tries = itertools.count()
        at, out = 0, []
        for part in self._agenda(word, signs, lambda a, b, end: skips(next(tries))):
            out += [self.bytes[x] for x in word[at].encode()] if part is None else [self.ids[part]]
            at += 1 if part is None else len(part)
        return out, next(tries)

    def segment_all_by(self, words: list[str], spaced: list[bool], paths: list[tuple[int, ...]]) -> list[tuple[bytes, int]]:
        """As ``segment_by`` for each word, with the pairs skipped whose numbers its path names."""
        out: dict[int, tuple[bytes, int]] = {}
        stepped = []
        for i, (word, lead, path) in enumerate(zip(words, spaced, paths)):
            if 0 < len(word) <= _IN_STEP and WORD_START not in word[lead:] and all(c in self.ids for c in word):
                stepped.append(i)
            else:
                ids, tries = self.segment_by(word, lead, set(path).__contains__)
                out[i] = np.array(ids, np.uint32).tobytes(), tries
        for lo in range(0, len(stepped), 20_000):
            some = stepped[lo: lo + 20_000]
            skipped = np.full((len(some), max(1, max(len(paths[i]) for i in some))), -1, np.int64)
            for row, i in enumerate(some):
                skipped[row, : len(paths[i])] = paths[i]
            tries = np.zeros(len(some), np.int64)
            ids = self._in_step([words[i] for i in some], 0, 0.0, skipped, tries)
            out.update(zip(some, zip(ids, tries.tolist())))
        return [out[i] for i in range(len(words))]

    def _agenda(self, word: str, signs: list[str | None], skips: Callable | None) -> list[str | None]:
        """The agenda as a heap; stale pairs are passed over when they come up."""
        n = len(signs)
        ends, before, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
        heap: list[tuple[float, int, int, int]] = []

        def propose(a: int, b: int) -> None:
            if signs[a] is not None and signs[b] is not None:
                rank = self.rank.get(word[a: ends[b]])
                if rank is not None:
                    heapq.heappush(heap, (rank, a, b, ends[b]))

        for i in range(n - 1):
            propose(i, i + 1)
        while heap:
            _, a, b, end = heapq.heappop(heap)
            if not (alive[a] and alive[b]) or ends[a] != b or ends[b] != end or skips and skips(a, b, end):
                continue
            ends[a], alive[b] = end, False
            if end < n:
                before[end] = a
                propose(a, end)
            if before[a] >= 0:
                propose(before[a], a)
        parts, i = [], 0
        while i < n:
            parts.append(None if signs[i] is None else word[i: ends[i]])
            i = ends[i]
        return parts

    @cached_property
    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All pairs of pieces that spell a piece: sorted keys, the piece's id and its rank."""
        rows = [(self.ids[p[:i]] << 32 | self.ids[p[i:]], self.ids[p], self.rank[p])
                for p in self.ids for i in range(1, len(p)) if p[:i] in self.ids and p[i:] in self.ids]
        keys, merged, rank = map(np.array, zip(*sorted(rows)))
        return keys.astype(np.int64), merged.astype(np.int64), rank.astype(np.float64)

    def _pair(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merged id and rank of pairs; an infinite rank where they spell no piece."""
        keys, merged, rank = self.pairs
        wanted = a << 32 | b
        at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        return merged[at], np.where(keys[at] == wanted, rank[at], np.inf)

    def segment_many(self, words: list[str], key: int, dropout: float, spaced: bool) -> list[bytes]:
        """As ``segment`` for each word: all agendas advance in step, a merge a word at a time.

        Ids come as little-endian unsigned 32-bit integers.  Long words and words with
        signs that are no pieces go one by one.
        """
        def plain(w: str) -> bool:
            return 0 < len(w) <= _IN_STEP and WORD_START not in w[spaced:] and all(c in self.ids for c in w)

        out: dict[int, bytes] = {}
        stepped = []
        for i, word in enumerate(words):
            if plain(word):
                stepped.append(i)
            else:
                out[i] = np.array(self.segment(word, key, dropout, spaced), np.uint32).tobytes()
        for lo in range(0, len(stepped), 20_000):
            some = stepped[lo: lo + 20_000]
            out.update(zip(some, self._in_step([words[i] for i in some], key, dropout)))
        return [out[i] for i in range(len(words))]

    def _in_step(self, words: list[str], key: int, dropout: float, skipped: np.ndarray | None = None, tries: np.ndarray | None = None) -> list[bytes]:
        """``skipped`` names the pairs to skip by their number instead; ``tries`` takes how many came up."""
        lengths = np.array([len(w) for w in words])
        n, width = len(words), int(lengths.max())
        column = np.arange(width)
        alive = column < lengths[:, None]
        piece = np.zeros((n, width + 1), np.int64)
        piece[:, :width][alive] = [self.ids[c] for w in words for c in w]
        follow, before = np.tile(np.arange(1, width + 2), (n, 1)), np.tile(np.arange(-1, width), (n, 1))
        ranks = np.full((n, width), np.inf)
        row, at = np.nonzero(column < lengths[:, None] - 1)
        ranks[row, at] = self._pair(piece[row, at], piece[row, at + 1])[1]
        limit = np.uint64(int(dropout * 2.0**64))
        base = np.array([xxhash.xxh64_intdigest(w, key) for w in words] if limit else [0] * n, np.uint64)
        odd = [np.uint64(x) for x in _ODD]
        rows = np.arange(n)
        while len(rows):
            a = ranks[rows].argmin(1)
            some = ranks[rows, a] < np.inf
            rows, a = rows[some], a[some]
            b = follow[rows, a]
            end = follow[rows, b]
            merging = np.ones(len(rows), bool)
            if limit:
                h = base[rows] ^ a.astype(np.uint64) * odd[0] ^ b.astype(np.uint64) * odd[1] ^ end.astype(np.uint64) * odd[2]
                h = (h ^ h >> np.uint64(33)) * odd[1]
                h = (h ^ h >> np.uint64(29)) * odd[0]
                merging = (h ^ h >> np.uint64(32)) >= limit
            elif skipped is not None:
                merging = (skipped[rows] != tries[rows, None]).all(1)
                tries[rows] += 1
            ranks[rows[~merging], a[~merging]] = np.inf
            r, a, b, end = rows[merging], a[merging], b[merging], end[merging]
            piece[r, a] = self._pair(piece[r, a], piece[r, b])[0]
            follow[r, a], alive[r, b], ranks[r, b] = end, False, np.inf
            inside = end < lengths[r]
            before[r[inside], end[inside]] = a[inside]
            ranks[r, a] = np.where(inside, self._pair(piece[r, a], piece[r, end])[1], np.inf)
            left = before[r, a]
            some = left >= 0
            r, a, left = r[some], a[some], left[some]
            ranks[r, left] = self._pair(piece[r, left], piece[r, a])[1]
        flat, counts = piece[:, :width][alive].astype("<u4").tobytes(), alive.sum(1) * 4
        ends = np.cumsum(counts).tolist()
        return [flat[e - c: e] for e, c in zip(ends, counts.tolist())]

    def decode(self, ids: np.ndarray) -> str:
        """The text whose ids these are; the space before the first word is not part of it."""
        spelled = self.spelled
        return b"".join([spelled[i] for i in ids.tolist()]).decode()[1:]


class PieceTrie:
    """The pieces as a trie whose steps are looked up for many places at once, in an open hash table."""

    _BITS = 20

    def __init__(self, pieces: MergePieces):
        nodes: dict[str, int] = {"": 0}
        for piece in pieces.ids:
            for end in range(1, len(piece) + 1):
                nodes.setdefault(piece[:end], len(nodes))
        self.piece = np.zeros(len(nodes), np.int64)  # the id, plus one, of the piece that ends here
        for piece, i in pieces.ids.items():
            self.piece[nodes[piece]] = i + 1
        bits = max(self._BITS, (4 * len(nodes)).bit_length())
        self.mask, self.shift = (1 << bits) - 1, np.uint64(64 - bits)
        self.keys, self.nodes = np.full(1 << bits, -1, np.int64), np.zeros(1 << bits, np.int64)
        for prefix, node in nodes.items():
            if prefix:
                key = nodes[prefix[:-1]] << 21 | ord(prefix[-1])
                at = int(self._place(np.array([key]))[0])
                while self.keys[at] >= 0:
                    at = at + 1 & self.mask
                self.keys[at], self.nodes[at] = key, node

    def _place(self, keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * np.uint64(_ODD[0]) >> self.shift).astype(np.int64)

    def step(self, nodes: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """The nodes that signs lead to; -1 where no piece begins so."""
        keys = nodes << 21 | codes
        at = self._place(keys)
        found = self.keys[at]
        open_ = np.flatnonzero((found != keys) & (found >= 0))
        while len(open_):
            at[open_] = at[open_] + 1 & self.mask
            found[open_] = self.keys[at[open_]]
            open_ = open_[(found[open_] != keys[open_]) & (found[open_] >= 0)]
        return np.where(found == keys, self.nodes[at], -1)


class SpanTable:
    """Of words up to one length: the id of the piece, plus one, that each span of their signs spells."""

    def __init__(self, width: int, kind: np.dtype):
        self.width, self.kind, self.size = width, kind, 0
        self.lengths = np.zeros(256, np.int64)
        self.spans = np.zeros((256, width * (width + 1)), kind)
        self.odd: dict[int, str] = {}  # words with signs that are no pieces

    @property
    def row_bytes(self) -> int:
        return self.spans.shape[1] * self.spans.itemsize + 8

    def add(self, words: list[str], trie: PieceTrie) -> range:
        """Rows of new words."""
        n, end = self.size, self.size + len(words)
        if end > len(self.lengths):
            size = max(end, len(self.lengths) * 3 // 2)
            for name in ("lengths", "spans"):
                old = getattr(self, name)
                new = np.zeros((size, *old.shape[1:]), old.dtype)
                new[:n] = old[:n]
                setattr(self, name, new)
        lengths = np.array(list(map(len, words)))
        codes = np.zeros((len(words), self.width), np.int64)
        codes[np.arange(self.width) < lengths[:, None]] = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4")
        self.lengths[n:end], self.size = lengths, end
        spans, odd = self.spans[n:end], np.zeros(len(words), bool)
        for a in range(self.width):
            rows = np.flatnonzero(lengths > a)
            nodes = np.zeros(len(rows), np.int64)
            for upto in range(a + 1, self.width + 1):
                nodes = trie.step(nodes, codes[rows, upto - 1])
                found = np.where(nodes >= 0, trie.piece[nodes], 0)
                spans[rows, a * (self.width + 1) + upto] = found
                if upto == a + 1:
                    odd[rows[found == 0]] = True
                some = (nodes >= 0) & (lengths[rows] > upto)
                rows, nodes = rows[some], nodes[some]
                if not len(rows):
                    break
        self.odd.update((n + i, words[i]) for i in np.flatnonzero(odd).tolist())
        return range(n, end)


class Segmenter:
    """Segments texts by the words between spaces and line ends; each occurrence of a word skips merges of its own.

    Pairs come up one after the other, and each is skipped with probability ``dropout``,
    so the number of pairs up to the next skipped one is drawn at once.  An occurrence in
    which none is skipped is the word's own segmentation, which is kept.  The agendas of
    all others advance in step, whatever text they are of; the pieces that spans of
    a word spell are looked up once a word.
    """

    def __init__(self, pieces: MergePieces, dropout: float, seed: int):
        self.pieces, self.dropout, self.seed = pieces, dropout, seed
        self.line_end = np.array(pieces.segment("\n", 0, 0, False), np.uint32).tobytes()
        order = sorted(set(pieces.rank.values()))
        places = {r: i for i, r in enumerate(order)}
        self.rank = np.full(len(pieces.spelled) + 1, _NONE, np.int32)
        for piece, i in pieces.ids.items():
            self.rank[i + 1] = places[pieces.rank[piece]]
        self.trie = PieceTrie(pieces)
        self._forget()

    def _forget(self) -> None:
        kind = np.dtype(np.uint16 if len(self.rank) <= 1 << 16 else np.uint32)
        self.tables = [SpanTable(w, kind) for w in _WIDTHS]
        self.number: dict[str, int] = {}
        self.ids: list[bytes] = []
        self.tries, self.table, self.row = (np.zeros(1024, k) for k in (np.int32, np.int8, np.int32))
        self.held = 0

    def _spelled(self, word: str) -> str:
        return word[1:] if word.startswith("\n") else WORD_START + word

    def _learn(self, words: list[str]) -> None:
        """Numbers new words of bounded length, and segments them with no pair skipped."""
        by_table: dict[int, list[str]] = {}
        for word in words:
            length = len(self._spelled(word))
            by_table.setdefault(next(i for i, w in enumerate(_WIDTHS) if length <= w), []).append(word)
        for at, some in by_table.items():
            table, n = self.tables[at], len(self.ids)
            rows = table.add([self._spelled(w) for w in some], self.trie)
            ids, tries = self._in_step(table, np.arange(rows.start, rows.stop))
            end = n + len(some)
            if end > len(self.tries):
                for name in ("tries", "table", "row"):
                    old = getattr(self, name)
                    setattr(self, name, np.concatenate([old, np.zeros(max(len(old), end), old.dtype)]))
            self.tries[n:end], self.table[n:end], self.row[n:end] = tries, at, rows
            self.ids += [self.line_end + x if w.startswith("\n") else x for w, x in zip(some, ids)]
            self.number.update(zip(some, range(n, end)))
            self.held += len(some) * (table.row_bytes + _ENTRY) + sum(map(len, ids))

    def _kept(self, at: np.ndarray, depth: np.ndarray | int) -> np.ndarray:
        """Pairs kept before the next skipped one, for words whose hashes these are: geometric, from the upper 53 bits."""
        h = at ^ (np.atleast_1d(np.asarray(depth, np.uint64)) + np.uint64(1)) * np.uint64(_ODD[2])
        h = (h ^ h >> np.uint64(33)) * np.uint64(_ODD[1])
        h = (h ^ h >> np.uint64(29)) * np.uint64(_ODD[0])
        u = ((h ^ h >> np.uint64(32)) >> np.uint64(11)).astype(np.float64) * 2.0**-53
        if self.dropout >= 1:
            return np.zeros(len(at), np.int64)
        return np.minimum(np.log1p(-u) / math.log1p(-self.dropout), 2.0**31).astype(np.int64)

    def encode(self, texts: list[str], names: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers; its name and a word's place in it draw what is skipped."""
        words: list[str] = []
        at: list[np.ndarray] = []
        out: list[list[bytes]] = [[] for _ in texts]
        spans: list[tuple[int, int]] = []  # text, and where its words end

        def flush() -> None:
            if words:
                found, lo = self._encode(words, np.concatenate(at)), 0
                for text, hi in spans:
                    out[text] += found[lo:hi]
                    lo = hi
            for part in (words, at, spans):
                part.clear()

        for i, (text, name) in enumerate(zip(texts, names)):
            # a word at the start of a line takes the line end along and has no space before it; the text's first word has one
            own = text.replace("\n", " \n").split(" ")
            drawn = np.uint64(xxhash.xxh64_intdigest(name, self.seed))
            for lo in range(0, len(own), _WORDS_AT_ONCE):
                part = own[lo: lo + _WORDS_AT_ONCE]
                words.extend(part)
                at.append(drawn ^ np.arange(lo, lo + len(part), dtype=np.uint64) * np.uint64(_ODD[0]))
                spans.append((i, len(words)))
                if len(words) >= _WORDS_AT_ONCE:
                    flush()
        flush()
        return [b"".join(parts) for parts in out]

    def _encode(self, words: list[str], at: np.ndarray) -> list[bytes]:
        """Ids of each word; ``at`` draws what it skips."""
        if self.held > MEMORY_BYTES:
            self._forget()
        number = list(map(self.number.get, words))
        if None in number:
            new = {w for w, x in zip(words, number) if x is None}
            kept = [w for w in new if len(w) < _IN_STEP and WORD_START not in w]
            self._learn(kept)
            number = [self.number.get(w, -1) for w in words]
        node = np.array(number, np.int64)
        out = [self.ids[k] if k >= 0 else b"" for k in number]
        for i in np.flatnonzero(node < 0).tolist():  # long words, and those that hold the word-start sign, go one by one
            out[i] = self._alone(words[i], at[i: i + 1])
        if self.dropout:
            first = self._kept(at, 0)
            open_ = np.flatnonzero((node >= 0) & (first < self.tries[np.maximum(node, 0)]))
            tables = self.table[node[open_]]
            for k, table in enumerate(self.tables):
                own = open_[tables == k]
                for lo in range(0, len(own), _ROWS_IN_STEP):
                    some = own[lo: lo + _ROWS_IN_STEP]
                    ids, _ = self._in_step(table, self.row[node[some]], at[some], first[some])
                    for i, x in zip(some.tolist(), ids):
                        out[i] = self.line_end + x if words[i].startswith("\n") else x
        return out

    def _in_step(self, table: SpanTable, rows: np.ndarray, at: np.ndarray | None = None, skip: np.ndarray | None = None) -> tuple[list[bytes], np.ndarray]:
        """Ids of words, and how many pairs came up; ``skip`` is the number of each one's first skipped pair."""
        n, width, stride, rank = len(rows), table.width, table.width + 1, self.rank
        spans, base = table.spans.reshape(-1), rows.astype(np.int64) * (width * stride)
        lengths = table.lengths[rows]
        alive = np.arange(width) < lengths[:, None]
        # a sign that is no piece stands alone, as no span of one sign spells it
        ranks = np.full((n, width), _NONE, np.int32)
        first = np.arange(width - 1) * stride + np.arange(2, stride)
        ranks[:, :-1] = rank[spans[base[:, None] + first]]
        follow, before = np.tile(np.arange(1, width + 2), (n, 1)), np.tile(np.arange(-1, width), (n, 1))
        tries, depth, active = np.zeros(n, np.int32), np.zeros(n, np.int64), np.arange(n)
        skip = None if skip is None else skip.copy()
        while len(active):
            held = ranks[active]
            a = held.argmin(1)
            some = held[np.arange(len(active)), a] != _NONE
            active, a = active[some], a[some]
            r = active
            if skip is not None:
                skipped = tries[r] == skip[r]
                gone = r[skipped]
                ranks[gone, a[skipped]] = _NONE
                depth[gone] += 1
                skip[gone] += 1 + self._kept(at[gone], depth[gone])
                tries[r] += 1
                r, a = r[~skipped], a[~skipped]
            else:
                tries[r] += 1
            b = follow[r, a]
            end = follow[r, b]
            follow[r, a], alive[r, b], ranks[r, b] = end, False, _NONE
            inside = end < lengths[r]
            before[r, end] = a
            upto = follow[r, np.minimum(end, width)]
            place = base[r] + a * stride
            ranks[r, a] = np.where(inside, rank[spans[place + np.where(inside, upto, 0)]], _NONE)
            left = before[r, a]
            some = left >= 0
            r, left, end = r[some], left[some], end[some]
            ranks[r, left] = rank[spans[base[r] + left * stride + end]]
        row, a = np.nonzero(alive)
        ids = spans[base[row] + a * stride + follow[row, a]].astype(np.int64) - 1
        flat, counts = ids.astype("<u4").tobytes(), 4 * alive.sum(1)
        ends = np.cumsum(counts).tolist()
        out = [flat[e - c: e] for e, c in zip(ends, counts.tolist())]
        for i in np.unique(row[ids < 0]).tolist():  # signs that are no pieces become their bytes
            word = table.odd[int(rows[i])]
            own = [[x] if x >= 0 else [self.pieces.bytes[y] for y in word[k].encode()] for k, x in zip(a[row == i].tolist(), ids[row == i].tolist())]
            out[i] = np.array(list(itertools.chain.from_iterable(own)), "<u4").tobytes()
        return out, tries

    def _alone(self, word: str, at: np.ndarray) -> bytes:
        state = [int(self._kept(at, 0)[0]) if self.dropout else -1, 0]

        def skips(number: int) -> bool:
            if number != state[0]:
                return False
            state[1] += 1
            state[0] += 1 + int(self._kept(at, state[1])[0])
            return True

        line_start = word.startswith("\n")
        ids, _ = self.pieces.segment_by(self._spelled(word), not line_start, skips)
        return (self.line_end if line_start else b"") + np.array(ids, np.uint32).tobytes()


@lru_cache(maxsize=2)
def _segmenter(path: str, dropout: float, seed: int) -> Segmenter:
    return Segmenter(MergePieces(path), dropout, seed)


def encode(docs: DataFrame, tokenizer: str = "piece_bpe_32k.model", dropout: float = DROPOUT, seed: int = SEED) -> DataFrame:
    """doc_id, ids (little-endian unsigned 32-bit integers, as binary) of every whole text.

    A text is segmented as if a space stood before it.  The same seed, doc_id and text
    give the same ids on any cluster; ``dropout`` 0 gives the vocabulary's own merges.
    A NULL text counts as empty and has the ids of an empty first word.  One row per
    input row; an empty table gives an empty table; other columns than doc_id and text
    are not looked at.
    """
    bound_batches(docs.sparkSession)
    path = tokenizer_path(tokenizer)

    def segment(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        segmenter = _segmenter(path, dropout, seed)
        for batch in batches:
            for lo in range(0, len(batch), 2_000):
                some = batch.iloc[lo: lo + 2_000]
                doc_id = some["doc_id"].astype("Int64")
                yield pd.DataFrame({"doc_id": doc_id, "ids": segmenter.encode(some["text"].tolist(), list(map(str, doc_id)))})

    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).mapInPandas(segment, "doc_id long, ids binary")


def decode(encoded: DataFrame, tokenizer: str = "piece_bpe_32k.model") -> DataFrame:
    """doc_id, text, n_tokens, ids_crc32 of encoded rows."""
    path = tokenizer_path(tokenizer)

    def spell(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pieces = _segmenter(path, 0.0, 0).pieces
        for batch in batches:
            yield pd.DataFrame({
                "doc_id": batch["doc_id"].astype("Int64"), "text": [pieces.decode(np.frombuffer(x, "<u4")) for x in batch["ids"]],
                "n_tokens": [len(x) // 4 for x in batch["ids"]], "ids_crc32": [zlib.crc32(x) for x in batch["ids"]]})

    return encoded.mapInPandas(spell, "doc_id long, text string, n_tokens long, ids_crc32 long")
