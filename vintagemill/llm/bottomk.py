"""Near-duplicate groups by bottom-k sketches of one hash function, confirmed on full shingle sets."""

from __future__ import annotations

import math
import string
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vintagemill.llm.batches import bound_batches
from vintagemill.llm.components import connected
from vintagemill.session import materialise, may_broadcast

WORDS = 5
PERCENT = 75
SKETCH = 48
#: Standard deviations by which a sketch may understate what two sets share.
SLACK = 5.5
#: Members, and values they hold, in one step; longer lists and larger clusters are dealt to pairs of blocks.
BLOCK, BLOCK_VALUES = 2_000, 4_000_000


def words_of(text: Column) -> Column:
    """A-Z lower-cased, cut at space and \\t to \\r."""
    text = F.coalesce(text, F.lit(""))
    # the same for either kind of text; without other letters the plain function is faster
    lower = (F.when(F.octet_length(text) == F.char_length(text), F.lower(text))
             .otherwise(F.translate(text, string.ascii_uppercase, string.ascii_lowercase)))
    return F.array_remove(F.split(lower, r"[ \t-\r]+"), "")


def shingles_of(words: Column, size: int = WORDS) -> Column:
    """Hashes of ``size`` words in a row, repeated ones too; of all words where they are fewer."""
    first = F.slice(words, 1, F.greatest(F.size(words) - (size - 1), F.lit(1)))
    return F.transform(first, lambda w, i: F.xxhash64(w, *[F.get(words, i + j) for j in range(1, size)]))


def _with_shingles(docs: DataFrame, name: str, size: int) -> DataFrame:
    """Sorted distinct shingle hashes of each text, and its words' checksum."""
    return (docs.withColumn("_words", words_of(F.col("text")))
            .withColumn("_class", F.md5(F.array_join("_words", " ")))
            .withColumn(name, F.sort_array(F.array_distinct(shingles_of(F.col("_words"), size)))).drop("_words"))


def least_shared(percent: int, sketch: int) -> int:
    """Values two full sketches share at least, if their sets are alike by ``percent``."""
    t = percent / 100
    return max(1, math.floor(sketch * t - SLACK * math.sqrt(sketch * t * (1 - t))))


class Groups:
    """Labels of members that are joined as links between them are found."""

    def __init__(self, n: int):
        self.labels = np.arange(n)

    def join(self, i: int, others: np.ndarray) -> np.ndarray:
        """Joins i with others; returns one of them for each group that was not yet i's."""
        found, first = np.unique(self.labels[others], return_index=True)
        new = found != self.labels[i]
        self.labels[np.isin(self.labels, found[new])] = self.labels[i]
        return others[first[new]]


def _dense(values: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, int]:
    """Values as numbers from 0, end to end, where each begins, and how many there are."""
    every, flat = np.unique(np.concatenate(values), return_inverse=True)
    begins = np.concatenate([[0], np.cumsum([len(v) for v in values])])
    return flat, begins, len(every)


def _counts(flat: np.ndarray, begins: np.ndarray, mark: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """How many values of each row are marked."""
    sizes = begins[rows + 1] - begins[rows]
    starts = np.concatenate([[0], np.cumsum(sizes)])
    at = np.repeat(begins[rows] - starts[:-1], sizes) + np.arange(starts[-1])
    return np.add.reduceat(mark[flat[at]], starts[:-1], dtype=np.int64)


def spanning_links(sets: list[np.ndarray], sizes: np.ndarray, side: np.ndarray, alike: Callable) -> list[tuple[int, int]]:
    """Links that connect what all links connect.

    ``alike(i, rows, shared)`` says which rows are linked with i, given the number of
    values they share.  Pairs already connected are not compared, and with two blocks
    (``side`` 0 and 1) neither are pairs within one: other steps compare those.
    """
    if len(sets) == 2 and 100 * sizes.min() >= PERCENT * sizes.max():
        shared = np.array([len(np.intersect1d(sets[0], sets[1], assume_unique=True))])
        return [(0, 1)] if alike(0, np.array([1]), shared)[0] and (side[0] != side[1] or not side[0]) else []
    flat, begins, n_values = _dense(sets)
    groups, links = Groups(len(sets)), []
    mark = np.zeros(n_values, bool)
    both = side.any()
    for i in range(len(sets) - 1):
        rows = np.arange(i + 1, len(sets))
        rows = rows[(groups.labels[rows] != groups.labels[i]) & ((side[rows] != side[i]) | (not both))]
        rows = rows[(np.minimum(sizes[rows], sizes[i]) * 100 >= PERCENT * np.maximum(sizes[rows], sizes[i]))]
        if not len(rows):
            continue
        own = flat[begins[i]: begins[i + 1]]
        mark[own] = True
        near = rows[alike(i, rows, _counts(flat, begins, mark, rows))]
        mark[own] = False
        links += [(i, int(j)) for j in groups.join(i, near)] if len(near) else []
    return links


def _grouped(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[dict[str, np.ndarray]]:
    """Columns of the rows of one key at a time, from batches sorted by key."""
    held: dict[str, np.ndarray] | None = None
    for batch in batches:
        if not len(batch):
            continue
        columns = {c: batch[c].to_numpy() for c in batch.columns}
        new = np.zeros(len(batch), bool)
        for k in keys:
            new[1:] |= columns[k][1:] != columns[k][:-1]
        edges = [0, *np.flatnonzero(new).tolist(), len(batch)]
        for a, b in zip(edges[:-1], edges[1:]):
            part = {c: v[a:b] for c, v in columns.items()}
            if held is not None and all(held[k][0] == part[k][0] for k in keys):
                held = {c: np.concatenate([v, part[c]]) for c, v in held.items()}
            else:
                if held is not None:
                    yield held
                held = part
    if held is not None:
        yield held


def in_blocks(df: DataFrame, key: str, member: str, block: int = BLOCK, weight: str | None = None) -> DataFrame:
    """Adds _a, _b, _side: each pair of members of a key meets in some (_a, _b).

    A key of up to ``block`` members, which hold up to BLOCK_VALUES values by ``weight``, is
    one step; the members of a larger one are dealt to blocks by hash, and each block
    visits the steps it shares with every other.
    """
    parts = F.ceil(F.greatest(F.count("*") / block, F.sum(weight or F.lit(0)) / BLOCK_VALUES)).cast("int")
    sizes = df.groupBy(key).agg(parts.alias("_n")).where("_n > 1")
    dealt = df.join(sizes, key, "left").withColumn("_own", F.when(F.col("_n").isNull(), 0).otherwise(F.pmod(F.xxhash64(member), F.col("_n")).cast("int")))
    steps = F.transform(F.sequence(F.lit(0), F.coalesce("_n", F.lit(1)) - 1), lambda j: F.struct(
        F.least(F.col("_own"), j).alias("_a"), F.greatest(F.col("_own"), j).alias("_b"), (F.col("_own") > j).cast("int").alias("_side")))
    return dealt.select("*", F.inline(steps)).drop("_n", "_own")


def _links_by_step(df: DataFrame, key: str, member: str, values: str, make_alike: Callable) -> DataFrame:
    """(u, v): spanning links of each step of ``in_blocks``."""
    keys = [key, "_a", "_b"]
    bound_batches(df.sparkSession)

    def links(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out: list[tuple[int, int]] = []
        for group in _grouped(batches, keys):
            if len(group[key]) > 1:
                ids, sizes, side = group[member], group["n_shingles"], group["_side"]
                sets = list(group[values])
                out += [(ids[i], ids[j]) for i, j in spanning_links(sets, sizes, side, make_alike(sets, sizes))]
            if len(out) > 10_000:
                yield pd.DataFrame(out, columns=["u", "v"])
                out = []
        yield pd.DataFrame(out, columns=["u", "v"], dtype="int64")

    dealt = df.select(*keys, "_side", member, "n_shingles", values).repartition(*keys).sortWithinPartitions(*keys)
    return dealt.mapInPandas(links, "u long, v long")


def sketch_table(docs: DataFrame, words: int = WORDS, sketch: int = SKETCH) -> DataFrame:
    """doc_id, class, n_shingles, sketch (the least hashes) of each document."""
    rows = _with_shingles(docs.select("doc_id", "text"), "_set", words)
    return rows.select("doc_id", F.col("_class").alias("class"), F.size("_set").cast("long").alias("n_shingles"), F.slice("_set", 1, sketch).alias("sketch"))


def candidate_links(reps: DataFrame, percent: int = PERCENT, sketch: int = SKETCH) -> DataFrame:
    """(u, v) that connect all pairs of representatives whose sketches could belong to near-duplicates.

    Values retained by one document only are counted, not listed.  Of the others each
    document is listed under its rarest ones, as many as it takes so that two documents
    sharing the least number of values have one in common: those in a passage that
    many texts quote are rarely among them.  In each inverted list, the shared values
    among the least ``sketch`` of the union estimate the likeness.
    """
    least_full = least_shared(percent, sketch)
    one = reps.select("node", "n_shingles", F.explode("sketch").alias("value"))
    often = one.groupBy("value").agg(F.count("*").alias("df")).where("df > 1")
    shared = one.join(often, "value").groupBy("node", "n_shingles").agg(F.sort_array(F.collect_list(F.struct("df", "value"))).alias("_listed"))
    held = F.least(F.col("n_shingles"), F.lit(sketch))
    # a set no larger than the sketch is there in whole, and its share is exact
    least = F.when(F.col("n_shingles") > math.ceil(sketch * percent / 100), F.least(F.lit(least_full), F.ceil(held * percent / 100))).otherwise(F.ceil(held * percent / 100))
    take = held - least + 1 - (held - F.size("_listed"))
    listed = shared.select("node", F.explode(F.slice("_listed", 1, F.greatest(take, F.lit(0)).cast("int"))).alias("_v")).select("node", "_v.value")
    # two near-duplicates stand together in many lists; lists with the same members are compared once
    members = [F.count("*").alias("_n"), F.sum(F.xxhash64("node").cast("decimal(38,0)")).alias("_a"),
               F.sum(F.xxhash64("node", F.lit(1)).cast("decimal(38,0)")).alias("_b"), F.min("node").alias("_c")]
    again = listed.groupBy("value").agg(*members).where("_n > 1").groupBy("_n", "_a", "_b", "_c").agg(F.min("value").alias("value"))
    listed = materialise(listed.join(again.select("value"), "value", "left_semi"), "lists")
    accept = least_full / sketch

    def make_alike(sets: list[np.ndarray], sizes: np.ndarray) -> Callable:
        lengths = np.array([len(s) for s in sets])
        whole = (sizes <= lengths)
        tops = np.array([s[-1] for s in sets])

        def alike(i: int, rows: np.ndarray, shared: np.ndarray) -> np.ndarray:
            # shared values may lie beyond the least of the union, so this overstates the likeness, never the reverse
            union = np.minimum(lengths[i] + lengths[rows] - shared, np.maximum(lengths[i], lengths[rows]))
            exact = whole[i] & whole[rows]
            return np.where(exact, shared * 100 >= percent * (lengths[i] + lengths[rows] - shared), shared >= accept * union)

        return alike

    steps = in_blocks(listed, "value", "node").join(reps.select("node", "n_shingles", "sketch"), "node")
    links = _links_by_step(steps, "value", "node", "sketch", make_alike)
    return links.distinct()


def confirmed_links(docs: DataFrame, clusters: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """(u, v) that connect all near-duplicates among the nodes of each cluster, on their full sets.

    ``clusters`` has node, component, n_shingles, and the doc_id and class of the text.
    """
    steps = in_blocks(clusters, "component", "node", weight="n_shingles")
    texts = _with_shingles(docs.select("doc_id", "text").join(steps, "doc_id"), "_set", words)
    # a doc_id may have several texts; written as an equality, this would be taken for a key of the join above
    sets = texts.where(F.instr("_class", F.col("class")) > 0).withColumn("n_shingles", F.size("_set").cast("long"))

    def make_alike(sets: list[np.ndarray], sizes: np.ndarray) -> Callable:
        return lambda i, rows, shared: 100 * shared >= percent * (sizes[i] + sizes[rows] - shared)

    return _links_by_step(sets, "component", "node", "_set", make_alike)


def text_class(text: Column) -> Column:
    """Equal for equal word sequences."""
    return F.md5(F.array_join(words_of(text), " "))


def near_duplicates(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, sketch: int = SKETCH, with_class: bool = False) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every document [, class: its word sequence, NULL where it is linked with nothing].

    Two documents are linked if 100 * common >= percent * all shingles of both; component_id
    is the smallest doc_id reachable by links, and that document is kept.  Equal word
    sequences are one class, represented by its smallest doc_id, so copies never
    multiply.  Representatives whose sketches may belong to linked sets are clustered,
    and each cluster is settled on full sets; only links that connect something new leave a task.

    Without words or text a document has no shingles, is linked with nothing and kept.
    Rows are judged each by itself: of rows that repeat the smallest doc_id of a group all
    are kept.  A NULL doc_id is linked with nothing and kept.  An empty table gives an
    empty table; other columns than doc_id and text are not looked at.
    """
    table = materialise(sketch_table(docs, words, sketch), "sketches")
    linkable = table.where("doc_id is not null and n_shingles > 0")
    least = linkable.groupBy("class").agg(F.min("doc_id").alias("doc_id"))
    # written, so that the numbers stay as they are
    reps = materialise(linkable.join(least, ["class", "doc_id"], "left_semi").dropDuplicates(["class"])
                       .withColumn("node", F.monotonically_increasing_id()), "representatives")
    clusters = connected(candidate_links(reps, percent, sketch)).join(reps.select("node", "class", "doc_id", "n_shingles"), "node")
    groups = connected(confirmed_links(docs, materialise(clusters, "clusters"), words, percent))
    of_class = reps.select("node", "class", F.col("doc_id").alias("rep")).join(groups, "node", "left")
    smallest = of_class.where("component is not null").groupBy("component").agg(F.min("rep").alias("least"))
    of_class = of_class.join(smallest, "component", "left").select("class", F.coalesce("least", "rep").alias("least"))
    rows = table.select("doc_id", "n_shingles", F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.col("class")).alias("class"))
    component = F.coalesce("least", "doc_id")
    return (rows.join(of_class, "class", "left")
            .select("doc_id", "n_shingles", component.alias("component_id"), component.eqNullSafe(F.col("doc_id")).alias("kept"), *["class"] * with_class))


def without_near_duplicates(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One row of each group of near-duplicates, and all rows that are linked with nothing; all columns stay.

    A row goes by its doc_id and text, so that another text of the same doc_id stays.  Of rows
    that repeat the kept doc_id and text one stays.  NULL texts and doc_ids, and texts
    without words, stay; an empty table gives an empty table; columns of any name stay as they are.
    """
    key, own = (next(x for x in (f"_{c}{i}" for i in range(len(docs.columns) + 1)) if x not in docs.columns) for c in ("class", "id"))
    judged = materialise(near_duplicates(docs, words, percent, with_class=True), "judged").where("class is not null")
    gone = judged.where("not kept").select(F.col("doc_id").alias(own), F.col("class").alias(key)).distinct()
    again = judged.where("kept").groupBy(F.col("doc_id").alias(own), F.col("class").alias(key)).count().where("count > 1").drop("count")

    def looked_up(table: DataFrame) -> tuple[DataFrame, int]:
        written = materialise(table, "rows")
        rows = written.count()
        return (F.broadcast(written) if may_broadcast(rows, written.schema) else written), rows

    (gone, _), (again, repeated) = looked_up(gone), looked_up(again)
    named = docs.withColumns({own: F.col("doc_id"), key: text_class(F.col("text"))})
    kept = named.join(gone, [own, key], "left_anti")
    if repeated:
        kept = kept.join(again, [own, key], "left_anti").unionByName(kept.join(again, [own, key], "left_semi").dropDuplicates([own, key]))
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])
