"""Best-fit-decreasing packing of documents into sequences of a fixed number of tokens.

Lengths are whole numbers up to the capacity, so best fit is decided on the histogram of
lengths: items of one length that find the same tightest bins are placed together.  The
driver holds as many counts as the capacity has lengths, whatever the number of
documents; the documents themselves are placed by their rank among those as long.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Mapping

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vintagemill.llm.batches import bound_batches
from vintagemill.llm.tokens import encode_in_slices, tokenizer_path, word_memory
from vintagemill.session import materialise

CAPACITY = 2048
END_ID = 0

_RANK_BITS = 44


class OpenBins:
    """Open bins by remaining capacity, with a segment tree that finds the tightest that holds a length."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.some = [False] * (2 * self.size)
        self.runs: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]

    def _mark(self, room: int) -> None:
        at = room + self.size
        self.some[at] = bool(self.runs[room])
        while at > 1:
            at //= 2
            self.some[at] = self.some[2 * at] or self.some[2 * at + 1]

    def add(self, room: int, first: int, count: int) -> None:
        """Bins ``first`` .. ``first + count - 1`` have ``room`` left; full ones are not kept."""
        if room and count:
            self.runs[room].append((first, count))
            self._mark(room)

    def take(self, room: int) -> tuple[int, int]:
        run = self.runs[room].pop()
        self._mark(room)
        return run

    def tightest(self, length: int) -> int | None:
        """The least room of at least ``length`` some open bin has."""
        at = length + self.size
        while not self.some[at]:
            while at & 1:  # a right child: go up until there is a subtree to the right
                at //= 2
                if at <= 1:
                    return None
            at += 1
        while at < self.size:
            at = 2 * at if self.some[2 * at] else 2 * at + 1
        return at - self.size


def best_fit_plan(counts: Mapping[int, int], capacity: int) -> np.ndarray:
    """Best fit decreasing over ``counts`` items of each length.

    Rows (length, rank, per_bin, bins, first_bin, offset): the items of that length from
    that rank on go ``per_bin`` at a time into ``bins`` successive bins, from that offset.
    The same bins as placing items one by one: once an item is in the tightest bin, that
    bin stays the tightest for the next item of the length as long as it has room.
    """
    bins, plan, opened = OpenBins(capacity), [], 0
    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        while left:
            room = bins.tightest(length)
            if room is None:
                room = capacity
                first, count = opened, -(-left // (capacity // length))
                opened += count
            else:
                first, count = bins.take(room)
            per_bin = room // length
            full = min(count, left // per_bin)
            for each, n in ((per_bin, full), (left - full * per_bin, int(full < count and left > full * per_bin))):
                if n:
                    plan.append((length, rank, each, n, first, capacity - room))
                    bins.add(room - each * length, first, n)
                    first, count, left, rank = first + n, count - n, left - each * n, rank + each * n
            bins.add(room, first, count)
    return np.array(plan, np.int64).reshape(-1, 6)


def token_pieces(docs: DataFrame, tokenizer: str = "word_bpe_49k.json", capacity: int = CAPACITY, with_ids: bool = False,
                 memory_bytes: int | None = None) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 [, ids] and (part, rank): the piece is the rank-th of its length in that task.

    A document is its ids and an end id; longer ones are cut every ``capacity`` ids.
    Nothing is shuffled.
    """
    bound_batches(docs.sparkSession)
    vocabulary = tokenizer_path(tokenizer)
    schema = "part int, rank long, doc_id long, piece int, start long, length long, ids_crc32 long" + (", ids array<int>" if with_ids else "")
    names = [c.split()[0] for c in schema.split(", ")]

    def pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        memory, part = word_memory(vocabulary, memory_bytes), TaskContext.get().partitionId()
        seen = [0] * (capacity + 1)
        end, width = np.array([END_ID], "<u4").tobytes(), 4 * capacity
        for batch in batches:
            rows = []
            for doc_id, ids in zip(batch["doc_id"].tolist(), encode_in_slices(memory, batch["text"].tolist())):
                ids += end
                for piece, at in enumerate(range(0, len(ids), width)):
                    own = ids[at: at + width]
                    n = len(own) // 4
                    rows.append((part, seen[n], doc_id, piece, at // 4, n, zlib.crc32(own)) + ((np.frombuffer(own, "<i4"),) if with_ids else ()))
                    seen[n] += 1
            if rows:
                yield pd.DataFrame(rows, columns=names).astype({"doc_id": "Int64"})

    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).mapInPandas(pieces, schema)


def place(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds sequence_id and offset to pieces with part, rank and length.

    ``pieces`` must be a written table, as it is read three times.
    """
    sizes = pieces.groupBy("part", "length").agg(F.count("*").alias("n"))
    counts = {r["length"]: r["n"] for r in sizes.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most one row a length
    plan = best_fit_plan(counts, capacity)
    starts = (plan[:, 0] << _RANK_BITS) + plan[:, 1]
    order = np.argsort(starts)
    plan, starts = plan[order], starts[order]

    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    ranked = pieces.join(bases, ["part", "length"]).withColumn("rank", F.col("rank") + F.col("base")).drop("part", "base")
    names = [c for c in ranked.columns if c != "rank"]
    schema = ", ".join(f"{c} {kind}" for c, kind in ranked.dtypes if c != "rank") + ", sequence_id long, offset long"

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            length, rank = batch["length"].to_numpy(), batch["rank"].to_numpy()
            row = plan[np.searchsorted(starts, (length << _RANK_BITS) + rank, side="right") - 1]
            bin_, inside = np.divmod(rank - row[:, 1], row[:, 2])
            yield batch[names].assign(sequence_id=row[:, 4] + bin_, offset=row[:, 5] + inside * length)

    return ranked.mapInPandas(assign, schema)


def pack(docs: DataFrame, tokenizer: str = "word_bpe_49k.json", capacity: int = CAPACITY, with_ids: bool = False,
         memory_bytes: int | None = None) -> DataFrame:
    """Packs all documents: doc_id, piece, start, length, ids_crc32 [, ids], sequence_id, offset.

    A NULL text counts as empty and is its end id alone.  One document per input row:
    repeated rows are packed each by themselves; NULL doc_ids are kept.  An empty table gives an
    empty table; other columns than doc_id and text are not looked at.  A worker holds about
    ``memory_bytes`` of words and their ids, which changes no result.
    """
    pieces = materialise(token_pieces(docs, tokenizer, capacity, with_ids, memory_bytes), "pieces")
    placed = place(pieces, capacity)
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32", *["ids"] * with_ids, "sequence_id", "offset")


def sequences(placed: DataFrame) -> DataFrame:
    """sequence_id, ids, doc_ids, lengths of pieces packed ``with_ids``; a group never exceeds the capacity."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "length", "ids")))
    return placed.groupBy("sequence_id").agg(parts.alias("p")).select(
        "sequence_id", F.flatten("p.ids").alias("ids"), F.col("p.doc_id").alias("doc_ids"), F.col("p.length").alias("lengths"))
