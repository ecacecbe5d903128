"""Scoring with saved tree ensembles, reason codes and what-if applications."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vintagemill.functions import codes, numeric
from vintagemill.operators import columns, features

NODE_SCHEMA = (
    "tree int, node int, feature string, threshold double, left int, right int, default_left boolean, "
    "missing string, value double, count double"
)


@dataclass(frozen=True)
class Node:
    """Inner node (``feature`` set) or leaf (``value`` set); ids are unique in a tree."""

    node: int
    feature: str | None = None
    threshold: float | None = None
    left: int | None = None
    right: int | None = None
    default_left: bool = True
    # "zero": a missing value counts as 0; "default": it follows the default branch;
    # "zero_default": so does a 0.
    missing: str = "zero"
    value: float | None = None
    # training rows of a leaf, where the model knows them
    count: float | None = None


def _descend(
    x: np.ndarray, root: int, leaf: np.ndarray, feature: np.ndarray, threshold: np.ndarray, left: np.ndarray,
    right: np.ndarray, default_left: np.ndarray, as_zero: np.ndarray, zero_gap: np.ndarray,
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(rows, their nodes, their next nodes) of a batch, one level of a tree after another."""
    rows = np.arange(0 if leaf[root] else len(x))
    here = np.full(len(rows), root)
    while rows.size:
        v = x[rows, feature[here]]
        gap = np.isnan(v) | (zero_gap[here] & (v == 0))
        go = np.where(gap & as_zero[here], 0.0, v) <= threshold[here]
        go = np.where(gap & ~as_zero[here], default_left[here], go)
        there = np.where(go, left[here], right[here])
        yield rows, here, there
        inner = ~leaf[there]
        rows, here = rows[inner], there[inner]


@dataclass
class TreeEnsemble:
    """Additive trees over numeric features: ``x <= threshold`` goes left."""

    features: list[str]
    trees: list[dict[int, Node]] = field(default_factory=list)
    roots: list[int] = field(default_factory=list)
    slope: float = 1.0

    @property
    def size(self) -> int:
        return sum(len(t) for t in self.trees)

    def _walk(self, tree: dict[int, Node], at: int) -> Column:
        node = tree[at]
        if node.feature is None:
            return F.lit(float(node.value))
        x = numeric.to_double(node.feature)  # NaN is missing, as in the vectorised form
        if node.missing == "zero":
            goes_left = F.coalesce(x, F.lit(0.0)) <= node.threshold
        else:
            known = x if node.missing == "default" else F.nullif(x, F.lit(0.0))
            goes_left = F.coalesce(known <= node.threshold, F.lit(node.default_left))
        return F.when(goes_left, self._walk(tree, node.left)).otherwise(self._walk(tree, node.right))

    def raw_expression(self) -> Column:
        """Sum of the trees as nested conditions, evaluated inside the JVM: for one or two small trees."""
        total = F.lit(0.0)
        for tree, root in zip(self.trees, self.roots):
            total = total + self._walk(tree, root)
        return total

    def _packed(self) -> list[tuple]:
        """Each tree as arrays over its nodes, the root's place first."""
        position = {f: i for i, f in enumerate(self.features)}
        packed = []
        for tree, root in zip(self.trees, self.roots):
            order = {n: i for i, n in enumerate(tree)}
            nodes = list(tree.values())
            packed.append((
                order[root], np.array([n.feature is None for n in nodes]),
                np.array([position.get(n.feature, 0) for n in nodes]),
                np.array([0.0 if n.threshold is None else n.threshold for n in nodes]),
                np.array([order[n.left] if n.left is not None else -1 for n in nodes]),
                np.array([order[n.right] if n.right is not None else -1 for n in nodes]),
                np.array([n.default_left for n in nodes]),
                np.array([n.missing == "zero" for n in nodes]),
                np.array([n.missing == "zero_default" for n in nodes]),
                np.array([0.0 if n.value is None else n.value for n in nodes]),
            ))
        return packed

    def _inputs(self) -> Column:
        return F.struct(*[F.col(f).cast("double").alias(f) for f in self.features])

    def raw_vectorised(self) -> Column:
        """The same sum over Arrow batches; its cost grows with the depth of the trees, not their nodes."""
        packed = self._packed()

        @F.pandas_udf("double")
        def evaluate(table: pd.DataFrame) -> pd.Series:
            x = table.to_numpy(dtype=float)
            total = np.zeros(len(x))
            for root, *nodes, value in packed:
                at = np.full(len(x), root)
                for rows, _, there in _descend(x, root, *nodes):
                    at[rows] = there
                total += value[at]
            return pd.Series(total)

        return evaluate(self._inputs())

    def expected(self) -> list[dict[int, float]]:
        """For each tree the mean value of the training rows that reached a node, from the leaves' counts."""
        found = []
        for tree, root in zip(self.trees, self.roots):
            means: dict[int, float] = {}
            sizes: dict[int, float] = {}
            waiting = [root]
            while waiting:  # children before parents, without recursion
                node = tree[waiting[-1]]
                if node.feature is None:
                    if node.count is None:
                        raise ValueError("contributions need the training rows of each leaf")
                    means[node.node], sizes[node.node] = node.value, node.count
                elif node.left not in means or node.right not in means:
                    waiting += [n for n in (node.left, node.right) if n not in means]
                    continue
                else:
                    n = sizes[node.node] = sizes[node.left] + sizes[node.right]
                    sums = means[node.left] * sizes[node.left] + means[node.right] * sizes[node.right]
                    means[node.node] = sums / n if n else 0.0
                waiting.pop()
            found.append(means)
        return found

    def base(self) -> float:
        """What every row's raw score starts from: the expected values of the roots."""
        return float(sum(means[root] for means, root in zip(self.expected(), self.roots)))

    def contributions(self) -> Column:
        """array<double>: what each feature adds to the raw score, in the order of ``features``.

        A step from a node to its child changes the expected value; the change goes to the
        node's feature.  All of a row add up to its raw score less ``base``.
        """
        packed = [(*tree[:-1], np.array([means[n] for n in nodes]))
                  for tree, means, nodes in zip(self._packed(), self.expected(), self.trees)]

        @F.pandas_udf("array<double>")
        def evaluate(table: pd.DataFrame) -> pd.Series:
            x = table.to_numpy(dtype=float)
            pushes = np.zeros(x.shape)
            for root, leaf, feature, *nodes, mean in packed:
                for rows, here, there in _descend(x, root, leaf, feature, *nodes):
                    pushes[rows, feature[here]] += mean[there] - mean[here]
            return pd.Series(list(pushes))

        return evaluate(self._inputs())

    def probability(self, method: str = "vectorised") -> Column:
        if method not in ("vectorised", "expression"):
            raise ValueError(f"unknown method {method!r}")
        raw = self.raw_expression() if method == "expression" else self.raw_vectorised()
        return numeric.sigmoid(F.lit(self.slope) * raw, bound=None)

    def node_table(self, spark: SparkSession) -> DataFrame:
        """One row per node, to store a model as a dataset."""
        rows = [
            (i, n.node, n.feature, n.threshold, n.left, n.right, n.default_left, n.missing, n.value, n.count)
            for i, tree in enumerate(self.trees) for n in tree.values()
        ]
        return spark.createDataFrame(rows, NODE_SCHEMA)


def ensemble_from_nodes(nodes: DataFrame, feature_order: Sequence[str], slope: float = 1.0) -> TreeEnsemble:
    """Rebuild an ensemble from its node table; the root of a tree is nobody's child."""
    trees: dict[int, dict[int, Node]] = {}
    for r in nodes.collect():
        node = Node(
            r["node"], r["feature"], r["threshold"], r["left"], r["right"], r["default_left"], r["missing"], r["value"],
            r["count"] if "count" in nodes.columns else None)
        trees.setdefault(r["tree"], {})[r["node"]] = node
    model = TreeEnsemble(list(feature_order), slope=slope)
    for i in sorted(trees):
        tree = trees[i]
        children = {c for n in tree.values() for c in (n.left, n.right) if c is not None}
        model.trees.append(tree)
        model.roots.append(next(n for n in tree if n not in children))
    return model


def _fields(block: str) -> dict[str, str]:
    return dict(line.split("=", 1) for line in block.splitlines() if "=" in line)


def read_tree_file(spark: SparkSession, path: str) -> TreeEnsemble:
    """Load a boosted-tree text file: a header and one ``Tree=`` block per tree.

    Inner nodes are numbered from 0; a child ``-k`` is leaf ``k - 1``.  Bit 0 of a
    node's decision type marks a categorical split (not supported), bit 1 the
    default branch, bits 2-3 how missing values are treated.
    """
    text = spark.read.text(path, wholetext=True).first()[0].split("end of trees")[0]
    head, *blocks = text.split("\nTree=")
    header = _fields(head)
    names = header["feature_names"].split()
    slope = 1.0
    for word in header.get("objective", "").split():
        if word.startswith("sigmoid:"):
            slope = float(word.split(":")[1])
    model = TreeEnsemble(names, slope=slope)
    for block in blocks:
        f = _fields(block)
        if int(f.get("num_cat", 0)):
            raise ValueError("categorical splits are not supported")
        leaves = [float(v) for v in f["leaf_value"].split()]
        counts = [float(v) for v in f.get("leaf_count", "").split()] or [None] * len(leaves)
        tree = {-(i + 1): Node(-(i + 1), value=v, count=n) for i, (v, n) in enumerate(zip(leaves, counts))}
        if len(leaves) > 1:
            columns_ = zip(*[f[k].split() for k in ("split_feature", "threshold", "left_child", "right_child", "decision_type")])
            for i, (feature, threshold, left, right, kind) in enumerate(columns_):
                missing = ("zero", "zero_default", "default")[int(kind) >> 2 & 3]
                tree[i] = Node(
                    i, names[int(feature)], float(threshold), int(left), int(right), bool(int(kind) & 2), missing)
        model.trees.append(tree)
        model.roots.append(0 if len(leaves) > 1 else -1)
    return model


def score_cohort(
    df: DataFrame, model: TreeEnsemble, medians: Mapping[str, float], keep: Sequence[str] = ("loan_id", "orig_date", "msa"),
    method: str = "vectorised",
) -> DataFrame:
    """Raw probability of a cohort: conform, coerce, impute, predict; keys travel along."""
    kept = [k for k in keep if k in df.columns]
    shadow = df.withColumns({f"_keep_{k}": F.col(k) for k in kept})
    ready = columns.conform(shadow, model.features, [f"_keep_{k}" for k in kept])
    ready = columns.impute(ready, model.features, medians)
    return ready.select(*[F.col(f"_keep_{k}").alias(k) for k in kept], model.probability(method).alias("pd_raw"))


def reason_codes(
    df: DataFrame, terms: Mapping[str, tuple[float, float]], key: str = "loan_id", k: int = 8
) -> DataFrame:
    """(key, rank, feature, value, contribution): the ``k`` largest linear contributions.

    ``terms`` maps a feature to its coefficient and mean; a missing value
    contributes nothing.
    """
    pushes = {name: F.coalesce(F.lit(coefficient) * (F.col(name) - F.lit(mean)), F.lit(0.0))
              for name, (coefficient, mean) in terms.items()}
    return _largest(df, pushes, key, k)


def tree_reason_codes(df: DataFrame, model: TreeEnsemble, key: str = "loan_id", k: int = 8) -> DataFrame:
    """(key, rank, feature, value, contribution): the ``k`` features that move a tree score most, in units of the raw score.

    ``df`` holds the model's features; a missing value goes the way it does in scoring.
    """
    pushed = df.withColumn("_pushes", model.contributions())
    return _largest(pushed, {f: F.get("_pushes", F.lit(i)) for i, f in enumerate(model.features)}, key, k)


def _largest(df: DataFrame, pushes: Mapping[str, Column], key: str, k: int) -> DataFrame:
    parts = [F.struct(
        (-F.abs(push)).alias("order"), F.lit(name).alias("feature"),
        F.col(name).cast("double").alias("value"), push.alias("contribution")) for name, push in pushes.items()]
    top = F.slice(F.sort_array(F.array(*parts)), 1, k)
    ranked = df.select(key, F.posexplode(top).alias("rank", "s"))
    return ranked.select(key, (F.col("rank") + 1).alias("rank"), "s.feature", "s.value", "s.contribution")


def application_rows(
    applications: DataFrame, feature_order: Sequence[str], medians: Mapping[str, float], key: str = "application_id",
    compat: bool = False,
) -> DataFrame:
    """Applications (display names, few numbers) as complete model rows.

    Given numbers win, everything else starts from the training medians.  Features
    derived from given numbers are recomputed; ``compat`` recomputes only the score
    gap and its product with LTV and leaves the rest at their medians.
    """
    named = applications.withColumns({
        c: codes.code_of(c, table) for c, table in codes.CODE_TABLES.items() if c in applications.columns
    })
    given = set(applications.columns) - set(codes.CODE_TABLES) - {key}
    base = [c for c in ("fico", "ltv", "dti", "cltv", "orig_rate") if c in given or c in feature_order]
    filled = named.withColumns({
        c: F.coalesce(F.col(c).cast("double") if c in given else F.lit(None).cast("double"), F.lit(float(medians.get(c, 0.0))))
        for c in base
    })
    derived = features.derive(filled)
    always = ("fico_gap", "int_fico_gap_x_ltv")
    out = []
    for f in feature_order:
        prefix = next((c for c in codes.CODE_TABLES if f.startswith(f"{c}_") and c in named.columns and not f.endswith("_te")), None)
        is_derived = f in derived.columns and f not in filled.columns
        if f in base or (f in given and f in filled.columns):
            value = F.coalesce(F.col(f).cast("double"), F.lit(float(medians.get(f, 0.0))))
        elif prefix is not None:
            value = codes.one_hot(prefix, prefix, [f[len(prefix) + 1:]])[0]
        elif is_derived and (f in always or not compat):
            value = F.coalesce(F.col(f), F.lit(float(medians.get(f, 0.0))))
        else:
            value = F.lit(float(medians.get(f, 0.0)))
        out.append(value.alias(f))
    return derived.select(key, *out)


def decide(
    rows: DataFrame, model: TreeEnsemble, threshold: float, a: float | None = None, b: float | None = None,
    key: str = "application_id",
) -> DataFrame:
    """(key, pd_raw, pd, approved) of complete model rows."""
    raw = rows.select(key, model.probability().alias("pd_raw"))
    scored = raw.withColumn("pd", numeric.platt("pd_raw", a, b))
    return scored.withColumn("approved", numeric.approves("pd", threshold))
