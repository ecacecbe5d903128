"""Near-duplicate vectors by spherical-cap filters: structured random directions, list decoding, exact check."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vintagemill.llm.batches import bound_batches
from vintagemill.llm.bottomk import BLOCK, Groups, _grouped, in_blocks
from vintagemill.llm.components import connected
from vintagemill.session import materialise

COSINE = 0.9
PARTS = 4
#: Share of the pairs at the threshold exactly that some filter holds both of, whatever the number of vectors and dimensions.
RECALL = 0.99
#: Filters a vector exceeds unless ``settings`` works out how many it takes.
CAPS = 32
SEED = 11

_SMALLEST_CODE, _LARGEST_CODE = 8, 128
_CODES = (2, 3, 4, 6, 8, 11, 16, 23, 32, 45, 64, 91, 128)
#: Numbers are whole steps of 1/65,536 while filters are decoded: all sums are exact then, so a vector's filters
#: do not depend on the rows it is decoded with.
_STEPS = 65_536.0
#: A filter's key is its number and, above these bits, the dimension.
_DIM_BITS = 40
#: Most filters a vector may be in, and random pairs that recall is measured on.
_MOST_CAPS, _PAIRS = 512, 1_000


def code_size(vectors: int) -> int:
    """Code words a part, so that there are about as many filters as vectors."""
    return min(_LARGEST_CODE, max(_SMALLEST_CODE, math.ceil(vectors ** (1 / PARTS))))


@lru_cache(maxsize=8)
def _code(dim: int, size: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """A random rotation and the unit code words of each part, in whole steps."""
    rng = np.random.default_rng([seed, dim, size])
    rotation = np.linalg.qr(rng.normal(size=(dim, dim)))[0]
    words = rng.normal(size=(PARTS, size, dim // PARTS))
    return np.rint(rotation * _STEPS), np.rint(words / np.linalg.norm(words, axis=2, keepdims=True) * _STEPS)


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length one, in double precision."""
    scaled = vectors / np.abs(vectors).max(1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def filters_of(units: np.ndarray, size: int, caps: int, seed: int = SEED) -> np.ndarray:
    """For each unit vector the sorted numbers of the filters whose direction it exceeds its threshold for.

    A filter's direction is one code word from each of the four parts; its number is
    theirs in base ``size``.  The threshold is the one that ``caps`` filters reach, so that a
    vector in a thin region is in as many filters as any other.  Decoding joins the
    scores of two parts each: of either list only the best ``caps`` can be in the result.
    """
    return np.sort(_ranked_filters(units, size, caps, seed), axis=1)


@lru_cache(maxsize=64)
def _ladder(caps: int, left: int, right: int) -> tuple[np.ndarray, np.ndarray]:
    """Places in two lists, best first, whose sums may be among the best ``caps``: of any other, as many are better."""
    i, j = np.divmod(np.arange(left * right), right)
    some = (i + 1) * (j + 1) <= caps
    return i[some], j[some]


def _ranked_filters(units: np.ndarray, size: int, caps: int, seed: int = SEED) -> np.ndarray:
    """As ``filters_of``, best first: the first filters are those of smaller ``caps``."""
    n, dim = units.shape
    padded = np.zeros((n, -(-dim // PARTS) * PARTS))
    padded[:, :dim] = np.rint(units * _STEPS)
    rotation, words = _code(padded.shape[1], size, seed)
    scores = np.einsum("npd,pcd->npc", (padded @ rotation).reshape(n, PARTS, -1), words)

    def best(s: np.ndarray) -> np.ndarray:
        some = np.argpartition(-s, min(caps, s.shape[1]) - 1, axis=1)[:, :caps]
        return np.take_along_axis(some, np.argsort(-np.take_along_axis(s, some, 1), axis=1, kind="stable"), 1)

    left = (scores[:, 0, :, None] + scores[:, 1, None, :]).reshape(n, -1)
    right = (scores[:, 2, :, None] + scores[:, 3, None, :]).reshape(n, -1)
    a, b = best(left), best(right)
    i, j = _ladder(caps, a.shape[1], b.shape[1])
    at = best(np.take_along_axis(left, a, 1)[:, i] + np.take_along_axis(right, b, 1)[:, j])
    return np.take_along_axis(a, i[at], 1) * size * size + np.take_along_axis(b, j[at], 1)


def pairs_at(cosine: float, dim: int, pairs: int, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors in random directions, and for each another at this cosine exactly."""
    rng = np.random.default_rng([seed, dim, pairs])
    x, noise = unit(rng.normal(size=(pairs, dim))), rng.normal(size=(pairs, dim))
    noise = unit(noise - (noise * x).sum(1, keepdims=True) * x)
    return x, cosine * x + math.sqrt(1 - cosine**2) * noise


@lru_cache(maxsize=1024)
def caps_for(size: int, dim: int, cosine: float, recall: float = RECALL) -> int | None:
    """Filters each vector must be in so that a pair at ``cosine`` shares one with probability ``recall``; None if it takes too many.

    Measured on random pairs with the code that is used.  The code is turned at random,
    so no pair is worse off than another in expectation, wherever the vectors lie.
    """
    if dim < 2 or cosine >= 1:
        return None
    needed = []
    for lo in range(0, _PAIRS, 100):
        x, y = (_ranked_filters(v[lo: lo + 100], size, _MOST_CAPS) for v in pairs_at(cosine, dim, _PAIRS))
        for p, q in zip(x.tolist(), y.tolist()):
            place = {f: r for r, f in enumerate(p)}
            needed.append(min((max(r, place[f]) for r, f in enumerate(q) if f in place), default=_MOST_CAPS))
    caps = int(np.sort(needed)[math.ceil(recall * _PAIRS) - 1]) + 1
    return caps if caps <= min(_MOST_CAPS, size**PARTS) else None


def settings(dim: int, vectors: int, cosine: float = COSINE, recall: float = RECALL) -> tuple[int, int]:
    """Code words a part and filters a vector for this recall, at least cost in microseconds a vector.

    More filters are emptier, but each vector must be in more of them.  Few vectors go
    through filters as many do.  Only where no code reaches the recall with 512 filters (one
    dimension, a cosine of 1) one filter holds all vectors: exact, at the square of their number.
    """
    def cost(size: int, caps: int) -> float:
        members = vectors * caps / size**PARTS
        rows = caps * math.ceil(members / BLOCK)
        return rows * (6 + 0.04 * dim) + caps * members * (0.005 + 0.0004 * dim) + 0.02 * size * size

    found = []
    for size in _CODES:
        caps = caps_for(size, dim, cosine, recall) if size <= 2 * code_size(vectors) else None
        if caps is None:  # larger codes take more filters still
            break
        found.append((size, caps))
    return min(found, key=lambda x: cost(*x), default=(1, 1))


def _filters(vectors: Sequence, size: int, caps: int) -> np.ndarray:
    """The sorted filters of each of these vectors of one length; number 0 alone if there is no code."""
    if size == 1:
        return np.zeros((len(vectors), 1), np.int64)
    return filters_of(unit(np.array(list(vectors), np.float64)), size, caps)


def _rows_by_filter(vectors: DataFrame, chosen: dict[int, tuple[int, int]]) -> DataFrame:
    """One row for each vector and filter: filter, node, copies, vector.

    ``chosen`` has the code size and the filters a vector for each dimension of two vectors or more.
    """
    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for dim, same in batch.groupby(batch["vector"].map(len)):
                if int(dim) not in chosen:
                    continue
                for lo in range(0, len(same), 500):
                    some = same.iloc[lo: lo + 500]
                    found = _filters(some["vector"], *chosen[int(dim)])
                    rows = some.iloc[np.repeat(np.arange(len(some)), found.shape[1])]
                    yield pd.DataFrame({"filter": (np.int64(dim) << _DIM_BITS) + found.ravel(), "node": rows["node"].to_numpy(),
                                        "copies": rows["copies"].to_numpy(), "vector": rows["vector"].to_numpy()})

    kind = vectors.schema["vector"].dataType.simpleString()
    return vectors.mapInPandas(decode, f"filter long, node long, copies long, vector {kind}")


def _share(sets: list[np.ndarray]) -> np.ndarray:
    """Which sets have a value in common, by a bounded number of values at a time."""
    known, flat, often = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row, number = np.repeat(np.arange(len(sets)), [len(f) for f in sets]), np.cumsum(often > 1) - 1
    row, flat = row[often[flat] > 1], number[flat[often[flat] > 1]]
    order = np.argsort(flat, kind="stable")
    row, flat = row[order], flat[order]
    share = np.zeros((len(sets), len(sets)), bool)
    for lo in range(0, int(flat[-1]) + 1 if len(flat) else 0, 2048):
        a, b = np.searchsorted(flat, [lo, lo + 2048])
        has = np.zeros((len(sets), 2048), np.float32)
        has[row[a:b], flat[a:b] - lo] = 1
        share |= has @ has.T > 0
    return share


def _links(rows: DataFrame, cosine: float, chosen: dict[int, tuple[int, int]]) -> DataFrame:
    """(node, n, other): how many vectors each node is linked with, counted in the first filter of a pair only,
    and edges that connect all linked nodes.

    Only vectors with a link are decoded again, for the filters of smaller numbers that they are in."""
    keys = ["filter", "_a", "_b"]

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for group in _grouped(batches, keys):
            if len(group["node"]) < 2:
                continue
            units, side = unit(np.array(group["vector"].tolist(), np.float64)), group["_side"]
            linked = units @ units.T >= cosine
            np.fill_diagonal(linked, False)
            if side.any():  # pairs within a block meet in the block's own step
                linked &= side[:, None] != side
            some = np.flatnonzero(linked.any(1))
            if not len(some):
                continue
            linked = linked[np.ix_(some, some)]
            node, copies = group["node"][some], group["copies"][some]
            dim, this = divmod(int(group["filter"][0]), 1 << _DIM_BITS)
            every = np.vstack([_filters(group["vector"][some[lo: lo + 500]], *chosen[dim]) for lo in range(0, len(some), 500)])
            n = (linked & ~_share([f[f < this] for f in every])) @ copies
            groups, edges = Groups(len(some)), []
            for i in range(len(some)):
                edges += [(i, j) for j in groups.join(i, np.flatnonzero(linked[i]))]
            u = [node[i] for i, _ in edges]
            yield pd.DataFrame({"node": [*node, *u], "n": [*n, *[0] * len(u)], "other": pd.array([None] * len(node) + [node[j] for _, j in edges], "Int64")})

    dealt = in_blocks(rows, "filter", "node").repartition(*keys).sortWithinPartitions(*keys)
    return dealt.mapInPandas(verify, "node long, n long, other long")


def near_vectors(embeddings: DataFrame, cosine: float = COSINE, recall: float = RECALL) -> DataFrame:
    """vec_id, n_links, component_id, kept of every vector.

    Two vectors are linked if some filter holds both and their cosine, in double
    precision, is at least ``cosine``; there are no false links, and a pair near the
    threshold is missed only if no filter holds both, which at the threshold exactly
    befalls one in a hundred by ``recall``, for few vectors as for many.  Equal vectors are one node with
    a number of copies: n_links counts the other vectors, copies too.  component_id is
    the smallest vec_id reachable by links; that vector is kept.  Each pair is counted
    in its first common filter, so no pairs leave the tasks.

    A vector that is NULL, empty, zero or has a NULL or non-finite component is linked
    with nothing and kept, as are vectors of different lengths with each other.  One row
    per input row; a NULL vec_id is never another's component.  An empty table gives an
    empty table; other columns are not looked at.
    """
    bound_batches(embeddings.sparkSession)
    rows = embeddings.select("vec_id", "embedding")
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("embedding", lambda x: x != 0)
    valid = rows.where(F.coalesce(fine, F.lit(False))).withColumn("vector", F.transform("embedding", lambda x: x + F.lit(0).cast("float")))
    nodes = materialise(valid.groupBy("vector").agg(F.count("*").alias("copies"), F.min("vec_id").alias("rep"))
                        .withColumn("node", F.monotonically_increasing_id()), "vectors")
    many = nodes.groupBy(F.size("vector").alias("dim")).count().where("count > 1").collect()
    chosen = {r["dim"]: settings(r["dim"], r["count"], cosine, recall) for r in many}
    found = materialise(_links(_rows_by_filter(nodes, chosen), cosine, chosen), "vector-links")
    counts = found.groupBy("node").agg(F.sum("n").alias("n"))
    groups = connected(found.select(F.col("node").alias("u"), F.col("other").alias("v")).distinct())
    of_node = nodes.join(counts, "node", "left").join(groups, "node", "left")
    least = of_node.where("component is not null").groupBy("component").agg(F.min("rep").alias("least"))
    of_node = of_node.join(least, "component", "left").select(
        "vector", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("least", "rep").alias("least"))
    keyed = rows.withColumn("vector", F.when(fine, F.transform("embedding", lambda x: x + F.lit(0).cast("float"))))
    component = F.coalesce("least", "vec_id")
    return keyed.join(of_node, "vector", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        component.eqNullSafe(F.col("vec_id")).alias("kept"))
