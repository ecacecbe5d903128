"""Alignment of two tokenizers' ids over the same bytes, as Arrow columns; link counts over the whole corpus."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vintagemill import session
from vintagemill.llm.batches import bound_batches
from vintagemill.llm.tokens import WordMemory, tokenizer_path
from vintagemill.llm.tree_bpe import TreeMerges, in_slices

WORD_START = "▁"
#: Pairs that more link rows hold than this many are looked up apart, so that none is dealt to one task alone.
HOT_ROWS = 100_000

_PAIR_BITS = 32
_ROW_BITS = 40
_SCHEMA = ("row long, doc_id long, n_a long, n_b long, n_groups long, groups_sha256 string, pairs array<long>, times array<long>, "
           "part_pairs array<long>, part_times array<long>, part_rows array<long>")


@dataclass
class Side:
    """Bytes, their number and the decimals of every id of one vocabulary."""

    spelled: pa.Array
    widths: pa.Array
    decimals: pa.Array

    @classmethod
    def of(cls, spelled: list[bytes]) -> Side:
        return cls(pa.array(spelled, pa.large_binary()), pa.array([len(x) for x in spelled], pa.int64()),
                   pa.array([str(i) for i in range(len(spelled))]))


def piece_bytes(path: str) -> list[bytes]:
    """Bytes of each id of a sentencepiece file: the word-start sign is a space; control pieces have none."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    out = []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            out.append(bytes([int(piece[1:-1], 16)]))
        else:
            out.append(b"" if model.is_control(i) or model.is_unknown(i) else piece.replace(WORD_START, " ").encode())
    return out


class Aligner:
    """Aligns texts encoded by a byte-level vocabulary (A) and by a sentencepiece vocabulary (B)."""

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece

        self.words = WordMemory(a_path)
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=b_path)
        self.a, self.b = Side.of(TreeMerges(a_path).spelled), Side.of(piece_bytes(b_path))

    def _ids(self, texts: list[str]) -> tuple[pa.Array, pa.Array]:
        """Lists of ids; none for empty texts and for those whose bytes a side does not give back."""
        a = [np.frombuffer(x, "<u4").astype(np.int64) if t else np.zeros(0, np.int64) for t, x in zip(texts, self.words.encode(texts, after_space=True))]
        b = [np.array(x if t else [], np.int64) for t, x in zip(texts, self.pieces.encode(texts, num_threads=1))]
        sound = np.array([bool(t) for t in texts])
        spelled = [(" " + t).encode("utf-8", "surrogatepass") if t else b"" for t in texts]
        out = []
        for side, ids in ((self.a, a), (self.b, b)):
            flat, ends = np.concatenate([*ids, np.zeros(0, np.int64)]), np.cumsum([len(x) for x in ids])
            own = memoryview(side.spelled.take(pa.array(flat)).buffers()[2] or b"").cast("B")
            upto = np.concatenate([[0], np.cumsum(np.asarray(side.widths)[flat])])[np.concatenate([[0], ends])].tolist()
            sound &= np.array([own[lo:hi] == text for lo, hi, text in zip(upto, upto[1:], spelled)], bool)
            out.append((flat, ends))
        return tuple(self._sound_lists(flat, ends, sound) for flat, ends in out)

    @staticmethod
    def _sound_lists(flat: np.ndarray, ends: np.ndarray, sound: np.ndarray) -> pa.Array:
        counts = np.diff(ends, prepend=0)
        cuts = np.concatenate([[0], np.cumsum(counts * sound)])
        return pa.LargeListArray.from_arrays(pa.array(cuts, pa.int64()), pa.array(flat[np.repeat(sound, counts)]))

    @staticmethod
    def _ends(ids: pa.Array, side: Side, name: str) -> pa.Table:
        """A row for each token: its document, id, number and the byte its document ends it at."""
        flat, parent = pc.list_flatten(ids), pc.list_parent_indices(ids)
        running = pc.cumulative_sum(side.widths.take(flat))
        # a sum over all documents becomes one a document when what came before each is taken off
        firsts = np.asarray(ids.offsets)[:-1]
        upto = np.concatenate([[0], np.asarray(running)])
        end = pc.subtract(running, pa.array(upto[firsts]).take(parent))
        return pa.table({"doc": parent, "end": end, name: flat, f"{name}_at": pa.array(np.arange(len(flat)))})

    def _groups(self, ids: pa.Array, side: Side, ends: np.ndarray) -> pa.Array:
        """Decimals with commas of the tokens between ends."""
        cuts = pa.array(np.concatenate([[0], ends + 1]), pa.int64())
        return pc.binary_join(pa.LargeListArray.from_arrays(cuts, side.decimals.take(pc.list_flatten(ids))), ",")

    def align(self, texts: list[str]) -> tuple[dict[str, list], pa.Table]:
        """Columns with an entry for each text, and (doc, pair, times) of their links."""
        a, b = self._ids(texts)
        joined = self._ends(a, self.a, "a").join(self._ends(b, self.b, "b"), ["doc", "end"], join_type="inner", use_threads=False)
        a_ends, b_ends = (np.sort(joined[f"{s}_at"].to_numpy()) for s in "ab")
        groups = pc.binary_join_element_wise(self._groups(a, self.a, a_ends), self._groups(b, self.b, b_ends), "|")
        doc = np.asarray(pc.list_parent_indices(a))[a_ends]
        n_groups = np.bincount(doc, minlength=len(texts))
        cuts = pa.array(np.concatenate([[0], np.cumsum(n_groups)]), pa.int64())
        spelled = pc.binary_join(pa.LargeListArray.from_arrays(cuts, groups), ";")
        pair = pc.bit_wise_or(pc.shift_left(joined["a"], _PAIR_BITS), joined["b"])
        links = pa.table({"doc": joined["doc"], "pair": pair}).group_by(["doc", "pair"], use_threads=False).aggregate([([], "count_all")])
        links = links.rename_columns(["doc", "pair", "times"])
        return {
            "n_a": pc.list_value_length(a), "n_b": pc.list_value_length(b), "n_groups": pa.array(n_groups, pa.int64()), "groups": spelled,
        }, links


@lru_cache(maxsize=1)
def _aligner(a_path: str, b_path: str) -> Aligner:
    return Aligner(a_path, b_path)


def _by_document(links: pa.Table, n: int) -> tuple[pa.Array, pa.Array]:
    """Pairs and times as one list a document."""
    links = links.sort_by("doc")
    cuts = pa.array(np.concatenate([[0], np.cumsum(np.bincount(links["doc"].to_numpy(), minlength=n))]), pa.int32())
    return tuple(pa.ListArray.from_arrays(cuts, links[c].combine_chunks().cast(pa.int64())) for c in ("pair", "times"))


def aligned_texts(docs: DataFrame, a: str = "byte_bpe_50k.json", b: str = "piece_bpe_32k.model", with_groups: bool = False) -> DataFrame:
    """A row for each document with its groups' digest [and groups] and its links, and partial counts of links.

    Partial counts, of some texts together, stand in the first of their rows.  ``row``
    numbers rows, as doc_ids may repeat.  Nothing is shuffled.
    """
    bound_batches(docs.sparkSession)
    paths = tokenizer_path(a), tokenizer_path(b)
    schema = _SCHEMA + (", groups string" if with_groups else "")
    names = [c.split()[0] for c in schema.split(", ")]

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, row = _aligner(*paths), TaskContext.get().partitionId() << _ROW_BITS
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for part in in_slices(texts, 1_000_000):
                n = part.stop - part.start
                columns, links = aligner.align(texts[part])
                pairs, times = _by_document(links, n)
                whole = links.group_by("pair", use_threads=False).aggregate([("times", "sum"), ([], "count_all")])
                first = pa.array([0, *[whole.num_rows] * n], pa.int32())
                partial = [pa.ListArray.from_arrays(first, whole[c].combine_chunks().cast(pa.int64())) for c in ("pair", "times_sum", "count_all")]
                digests = pa.array([hashlib.sha256(g.encode()).hexdigest() if g else "" for g in columns["groups"].to_pylist()])
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.arange(row, row + n)), batch.column("doc_id")[part.start: part.stop], columns["n_a"], columns["n_b"], columns["n_groups"],
                    digests, pairs, times, *partial, *[columns["groups"].cast(pa.string())] * with_groups], names)
                row += n

    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).mapInArrow(align, schema)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(pair, n, link_rows, best): how many links hold an id pair, and whether none of its B id's pairs has more."""
    partial = aligned.select(F.inline(F.arrays_zip("part_pairs", "part_times", "part_rows"))).toDF("pair", "n", "link_rows")
    counts = partial.groupBy("pair").agg(F.sum("n").alias("n"), F.sum("link_rows").alias("link_rows"))
    counts = session.materialise(counts.withColumn("b_id", F.col("pair").bitwiseAND((1 << _PAIR_BITS) - 1)), "pair-counts")
    # a row a pair: a B id has at most as many as the A vocabulary has ids
    most = counts.groupBy("b_id").agg(F.max("n").alias("most"))
    return counts.join(most, "b_id").select("pair", "n", "link_rows", (F.col("n") == F.col("most")).alias("best"))


def _looked_up(links: DataFrame, counts: DataFrame) -> DataFrame:
    """Links with the counts of their pairs.

    A count table of proven size is broadcast.  Of a larger one only the pairs that stand
    in most link rows are; every other pair has a bounded number of rows to meet.
    """
    slim = counts.select("pair", "n", "best")
    size, held = counts.agg(F.count("*"), F.coalesce(F.max("link_rows"), F.lit(0))).first()
    if session.may_broadcast(size, slim.schema):
        return links.join(F.broadcast(slim), "pair")
    if held <= HOT_ROWS:
        return links.join(slim, "pair")
    bound = HOT_ROWS
    while not session.may_broadcast(counts.where(F.col("link_rows") > bound).count(), slim.schema):
        bound *= 2
    hot = slim.join(counts.where(F.col("link_rows") > bound).select("pair"), "pair", "left_semi")
    rest = links.join(F.broadcast(hot.select("pair")), "pair", "left_anti")
    return links.join(F.broadcast(hot), "pair").unionByName(rest.join(slim, "pair"))


def align(docs: DataFrame, a: str = "byte_bpe_50k.json", b: str = "piece_bpe_32k.model", with_groups: bool = False) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 [, groups] of every document.

    Both sides encode a space and the text, strings of special tokens as ordinary text.
    Bytes at which a token of each side ends cut the tokens into groups and link the two
    tokens.  A pair of ids counts as many links as hold it in all documents; n_best of a
    document's links have the highest count of their B id, count_sum adds up their counts.
    NULL and empty texts, and those whose bytes a side does not give back, have no tokens: zeros
    and an empty digest.  One row per input row: repeated rows each count; NULL doc_ids
    stay; an empty table gives an empty table; other columns than doc_id and text are not
    looked at.
    """
    aligned = session.materialise(aligned_texts(docs, a, b, with_groups), "aligned")
    counts = session.materialise(pair_counts(aligned), "pair-scores")
    links = aligned.select("row", F.inline(F.arrays_zip("pairs", "times"))).toDF("row", "pair", "times")
    sums = _looked_up(links, counts).groupBy("row").agg(
        F.sum("times").alias("n_links"), F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
        F.sum(F.col("times") * F.col("n")).alias("count_sum"))
    rows = aligned.drop("pairs", "times", "part_pairs", "part_times", "part_rows").join(sums, "row", "left")
    none = F.lit(0).cast("long")
    return rows.select(
        "doc_id", "n_a", "n_b", "n_groups", *[F.coalesce(c, none).alias(c) for c in ("n_links", "n_best", "count_sum")],
        "groups_sha256", *["groups"] * with_groups)
