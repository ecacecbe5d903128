"""Token-id files of directly addressable codes: any token is reached without decoding a block.

Ids are split into 8-bit chunks.  Level 0 holds the lowest chunk of every id and a bitmap
that says which ids go on; level 1 holds the next chunk of those, and so on.  The place of
an id in the next level is the rank of its bit, found from a directory of counts every 512
bits.  A shard is one self-contained image; shards are rows of a Parquet table, so that any
store Spark writes to can hold them and a lost task leaves nothing half written.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vintagemill.llm.batches import bound_batches
from vintagemill.llm.tokens import encode_in_slices, tokenizer_path, word_memory

SHARD_IDS = 1 << 18
#: Bytes of words and their ids a worker holds while it encodes; it has no other use of memory than a shard.
MEMORY_BYTES = 400 << 20
END_ID = 0

_MAGIC = b"DAC8"
_BLOCK = 512  # bits between two counts of a directory
_SCHEMA = "part int, seq int, n_ids long, docs array<struct<doc_id: long, n_tokens: long>>, codes binary"


def encode(ids: np.ndarray) -> bytes:
    """The image of an array of ids below 2**32."""
    left = np.ascontiguousarray(ids, dtype=np.uint32)
    levels = []
    while True:
        more = left > 0xFF
        bits = np.zeros(-(-len(left) // _BLOCK) * _BLOCK, np.uint8)
        bits[: len(left)] = more
        counts = np.concatenate([[0], np.cumsum(bits.reshape(-1, _BLOCK).sum(1, dtype=np.int64))]).astype("<u4")
        levels.append(struct.pack("<Q", len(left)) + (left & 0xFF).astype(np.uint8).tobytes()
                      + np.packbits(bits, bitorder="little").tobytes() + counts.tobytes())
        if not more.any():
            return _MAGIC + struct.pack("<I", len(levels)) + b"".join(levels)
        left = left[more] >> np.uint32(8)


class Codes:
    """Reads an image: ``codes[i]`` is one id, ``codes.ids(a, b)`` an array of them."""

    def __init__(self, image: bytes):
        if image[:4] != _MAGIC:
            raise ValueError("not an image of directly addressable codes")
        at, self.levels = 8, []
        for _ in range(struct.unpack_from("<I", image, 4)[0]):
            n = struct.unpack_from("<Q", image, at)[0]
            blocks = -(-n // _BLOCK)
            chunks = np.frombuffer(image, np.uint8, n, at + 8)
            bits = np.frombuffer(image, np.uint8, blocks * _BLOCK // 8, at + 8 + n)
            counts = np.frombuffer(image, "<u4", blocks + 1, at + 8 + n + len(bits))
            at += 8 + n + len(bits) + 4 * len(counts)
            self.levels.append((chunks, bits, counts))

    def __len__(self) -> int:
        return len(self.levels[0][0])

    @staticmethod
    def _rank(bits: np.ndarray, counts: np.ndarray, i: int) -> int:
        """Set bits before place i: the block's count and at most 64 bytes after it."""
        block = i // _BLOCK
        inside = np.unpackbits(bits[block * _BLOCK // 8: -(-i // 8)], bitorder="little")[: i - block * _BLOCK]
        return int(counts[block]) + int(inside.sum())

    def __getitem__(self, i: int) -> int:
        if not 0 <= i < len(self):
            raise IndexError(i)
        value = shift = 0
        for chunks, bits, counts in self.levels:
            value |= int(chunks[i]) << shift
            if not bits[i // 8] >> (i % 8) & 1:
                break
            i, shift = self._rank(bits, counts, i), shift + 8
        return value

    def ids(self, a: int, b: int) -> np.ndarray:
        """The ids at places a to b, the latter exclusive."""
        out, at, shift = np.zeros(b - a, np.uint32), np.arange(b - a), 0
        for chunks, bits, counts in self.levels:
            out[at] |= chunks[a:b].astype(np.uint32) << np.uint32(shift)
            on = np.unpackbits(bits[a // 8: -(-b // 8)], bitorder="little")[a % 8:][: b - a].astype(bool)
            at, shift = at[on], shift + 8
            if not len(at):
                break
            a = self._rank(bits, counts, a)
            b = a + len(at)
        return out


def write_codes(docs: DataFrame, path: str, tokenizer: str = "byte_bpe_50k.json", shard_ids: int = SHARD_IDS) -> None:
    """Encodes the whole text of every document, id 0 after each, and writes shards in ascending doc_id order.

    Documents are dealt by ranges of doc_id and sorted within them (NULL doc_ids first,
    equal ones by text); Parquet files and their rows follow that order.  A NULL text
    counts as empty and has the end id only.  A document is never cut: a shard ends with
    the document that fills it.  Other columns than doc_id and text are not looked at.
    """
    bound_batches(docs.sparkSession)
    vocabulary = tokenizer_path(tokenizer)

    def shards(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        memory, part, seq = word_memory(vocabulary, MEMORY_BYTES), TaskContext.get().partitionId(), 0
        end = np.array([END_ID], "<u4").tobytes()
        held, index, size = [], [], 0

        def image() -> pd.DataFrame:
            ids = np.frombuffer(b"".join(held), "<u4")
            return pd.DataFrame({"part": [part], "seq": [seq], "n_ids": [len(ids)], "docs": [index], "codes": [encode(ids)]})

        for batch in batches:
            for doc_id, ids in zip(batch["doc_id"].tolist(), encode_in_slices(memory, batch["text"].tolist())):
                held += [ids, end]
                n = len(ids) // 4 + 1
                index.append({"doc_id": None if pd.isna(doc_id) else int(doc_id), "n_tokens": n})
                size += n
                if size >= shard_ids:
                    yield image()
                    held, index, size, seq = [], [], 0, seq + 1
        if index:
            yield image()

    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    ordered.mapInPandas(shards, _SCHEMA).write.parquet(path)


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(_SCHEMA).parquet(path)


def shard_starts(shards: DataFrame) -> DataFrame:
    """(part, seq, base): ids of all shards before each.

    A running sum inside each part, and one over the parts' totals, of which there are as
    many as there were writing tasks.
    """
    sizes = shards.select("part", "seq", "n_ids")
    before = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("n"))
    parts = parts.select("part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("whole"))
    inside = sizes.select("part", "seq", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("inside"))
    return inside.join(parts, "part").select("part", "seq", (F.col("whole") + F.col("inside")).alias("base"))


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids_crc32, read back from the files.

    One row per document written, repeated doc_ids too; an empty table gives an empty one.
    """
    bound_batches(spark)
    shards = read_shards(spark, path)

    def digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for part, seq, docs, image in zip(batch["part"], batch["seq"], batch["docs"], batch["codes"]):
                codes, at, rows = Codes(image), 0, []
                ids = memoryview(codes.ids(0, len(codes)).astype("<u4").tobytes())
                for doc in docs:
                    n = doc["n_tokens"]
                    rows.append((part, seq, doc["doc_id"], at, n, zlib.crc32(ids[4 * at: 4 * (at + n)])))
                    at += n
                out = pd.DataFrame(rows, columns=["part", "seq", "doc_id", "at", "n_tokens", "ids_crc32"])
                yield out.astype({"doc_id": "Int64"})

    read = shards.select("part", "seq", "docs", "codes").mapInPandas(
        digests, "part int, seq int, doc_id long, at long, n_tokens long, ids_crc32 long")
    return (read.join(shard_starts(shards), ["part", "seq"])
            .select("doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32"))
