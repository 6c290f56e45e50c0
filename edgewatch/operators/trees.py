"""Shallow one-against-the-rest decision trees by exhaustive split search, and the rules they contain.

All trees grow together, a level at a time. A row's places in all trees are expressions over its features.
Rows are counted per place, class, feature and value; those counts, not the rows, are spread over the
trees, sorted by value inside each node and feature, and summed. The running sums of all rows and of the
class's own rows give the impurity on both sides of every cut between two neighbouring values. The driver
gets one row per node. A level takes the same passes however many classes there are.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from edgewatch.functions.ordering import with_running_sums
from edgewatch.functions.scalar import named
from edgewatch.operators.attributes import CLASS, profile_features, stored_features
from edgewatch.operators.clean import column_medians, fill_medians
from edgewatch.schemas import BENIGN
from edgewatch.session import materialize

MIN_POSITIVES = 20
MAX_DEPTH = 3
MIN_LEAF = 10
RULE_DEPTH = 2


@dataclass(frozen=True)
class Node:
    """Rows and positives of a node; ``feature <= threshold`` leads to its left child, if it is split."""

    n: int
    positives: int
    feature: str | None = None
    threshold: float | None = None

    @property
    def purity(self) -> float:
        """Rows times (1 - Gini impurity)."""
        others = float(self.n - self.positives)
        return (float(self.positives) ** 2 + others**2) / self.n if self.n else 0.0

    @property
    def predicts(self) -> bool:
        return 2 * self.positives > self.n


@dataclass
class Tree:
    """Nodes by number: the root is 1, the children of ``i`` are ``2 i`` and ``2 i + 1``."""

    nodes: dict[int, Node] = field(default_factory=dict)

    def splits(self, max_depth: int = RULE_DEPTH) -> list[tuple[str, float]]:
        """Feature and threshold of the inner nodes down to ``max_depth``, parents first, left before right."""
        found, stack = [], [1]
        while stack:
            number = stack.pop()
            node = self.nodes.get(number)
            if node is not None and node.feature is not None and number.bit_length() - 1 <= max_depth:
                found.append((node.feature, node.threshold))
                stack += [2 * number + 1, 2 * number]
        return found

    def leaves(self) -> dict[int, Node]:
        return {i: node for i, node in self.nodes.items() if node.feature is None}

    def place(self, columns: dict[str, str], keep: set[int], number: int = 1) -> Column:
        """Number of the node in ``keep`` that a row falls into, or null. ``columns`` names the features' columns."""
        node = self.nodes[number]
        if node.feature is None:
            return F.lit(number if number in keep else None).cast("int")
        left, right = (self.place(columns, keep, 2 * number + side) for side in (0, 1))
        return F.when(named(columns[node.feature]) <= node.threshold, left).otherwise(right)

    def predict(self) -> Column:
        """Whether a row, whose features are complete, is of the tree's class."""
        leaves = self.leaves()
        columns = {node.feature: node.feature for node in self.nodes.values() if node.feature is not None}
        positive = [i for i, node in leaves.items() if node.predicts]
        return F.coalesce(self.place(columns, set(leaves)).isin(positive), F.lit(False))

    def quality(self) -> tuple[float, float, float]:
        """Accuracy, precision and recall over the rows the tree was made from; 0 where undefined."""
        leaves = self.leaves().values()
        found = sum(x.positives for x in leaves if x.predicts)
        named_so = sum(x.n for x in leaves if x.predicts)
        rows, positives = (sum(getattr(x, a) for x in leaves) for a in ("n", "positives"))
        right = found + (rows - positives) - (named_so - found)
        return right / rows, found / named_so if named_so else 0.0, found / positives if positives else 0.0

    def importances(self) -> dict[str, float]:
        """Share of each used feature in the whole decrease of impurity."""
        gains: dict[str, float] = {}
        for i, node in self.nodes.items():
            if node.feature is not None:
                gain = self.nodes[2 * i].purity + self.nodes[2 * i + 1].purity - node.purity
                gains[node.feature] = gains.get(node.feature, 0.0) + gain
        whole = sum(gains.values())
        return {f: g / whole for f, g in gains.items()} if whole > 0 else {}


@dataclass(frozen=True)
class Trees:
    """``metrics(attack_type, accuracy, precision, recall)``,
    ``rules(attack_type, position, feature, threshold, direction)``, one row per rule,
    ``importances(attack_type, feature, importance)``, one row per class and feature, and
    ``nodes(attack_type, node, rows, positives, feature, threshold)``."""

    metrics: DataFrame
    rules: DataFrame
    importances: DataFrame
    nodes: DataFrame
    trees: dict[str, Tree]


def _best_cuts(
    data: DataFrame, plain: list[str], attacks: list[str], places: list[Column], growing: DataFrame, min_leaf: int
) -> dict[tuple[int, int], tuple]:
    """``(feature, threshold, rows left, positives left)`` of the best cut for each tree and node that has one.

    The purest children win; among equals the first feature, then the smallest value.
    """
    joint = F.concat_ws(",", *[F.coalesce(p.cast("string"), F.lit("0")) for p in places])
    cells = F.inline(F.array(*[F.struct(F.lit(i).alias("feature"), F.col(c).alias("value")) for i, c in enumerate(plain)]))
    counted = data.select(F.col(CLASS).alias("class"), joint.alias("joint"), cells)
    counted = counted.groupBy("class", "joint", "feature", "value").agg(F.count(F.lit(1)).alias("n"))
    own = F.element_at(F.array(*[F.lit(a) for a in attacks]), F.col("tree") + 1)
    spread = counted.select("class", "feature", "value", "n", F.posexplode(F.split("joint", ",")).alias("tree", "node"))
    spread = spread.withColumn("node", F.col("node").cast("int")).filter("node > 0")
    per_value = spread.groupBy("tree", "node", "feature", "value").agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("class") == own, F.col("n")).otherwise(0)).alias("p")
    )
    keys = ["tree", "node", "feature"]
    running = with_running_sums(per_value, keys, ["n", "p"])
    cuts = running.join(F.broadcast(growing), ["tree", "node"]).select(
        *keys, "value", F.col("n_upto").alias("n"), F.col("p_upto").alias("p"), "all_n", "all_p"
    )
    exact = [F.col(c).cast("decimal(19,0)") for c in ("n", "p", "all_n", "all_p")]
    useful = (exact[1] * exact[2]) != (exact[3] * exact[0])  # another share of positives than in the node
    enough = (F.col("n") >= min_leaf) & (F.col("all_n") - F.col("n") >= min_leaf)

    def purity(n: Column, p: Column) -> Column:
        n, p = n.cast("double"), p.cast("double")
        return (p * p + (n - p) * (n - p)) / n

    score = purity(F.col("n"), F.col("p")) + purity(F.col("all_n") - F.col("n"), F.col("all_p") - F.col("p"))
    order = F.struct(score, -F.col("feature"), -F.col("value"))
    best = cuts.filter(enough & useful).groupBy("tree", "node").agg(
        F.max_by(F.struct("feature", "value", "n", "p"), order).alias("best")
    )
    chosen = {(r["tree"], r["node"]): tuple(r["best"]) for r in best.collect()}
    if not chosen:
        return {}
    rows = [(*key, feature, value) for key, (feature, value, _, _) in chosen.items()]
    cut_at = data.sparkSession.createDataFrame(rows, "tree int, node int, feature int, cut double")
    after = running.join(F.broadcast(cut_at), keys).filter("value > cut").groupBy("tree", "node").agg(F.min("value").alias("after"))
    following = {(r["tree"], r["node"]): r["after"] for r in after.collect()}
    return {key: (f, (v + following[key]) / 2, n, p) for key, (f, v, n, p) in chosen.items()}


def decision_trees(
    flows: DataFrame,
    features: list[str] | None = None,
    rows: int | None = None,
    min_positives: int = MIN_POSITIVES,
    max_depth: int = MAX_DEPTH,
    min_leaf: int = MIN_LEAF,
) -> Trees:
    """One tree per attack class that has at least ``min_positives`` rows.

    A node is split at the threshold, halfway between two neighbouring values of one feature in that node,
    that leaves the purest children (Gini) of at least ``min_leaf`` rows each; ties go to the first feature
    and the smallest value. It stays a leaf at ``max_depth``, if it is pure, or if no cut changes the share of
    positives. Gaps are filled with medians first; a feature without any value is left out.
    """
    features = profile_features(flows, features)
    flows = stored_features(flows, features)
    medians = column_medians(flows, features, rows=rows)
    features = [f for f in features if f in medians]
    plain = [f"_c{i}" for i in range(len(features))]
    filled = fill_medians(flows, medians).select(CLASS, *[named(f).cast("double").alias(p) for f, p in zip(features, plain)])
    data = materialize(filled, "filled")
    sizes = {r[CLASS]: r.n for r in data.groupBy(CLASS).agg(F.count(F.lit(1)).alias("n")).collect()}
    attacks = sorted(a for a, n in sizes.items() if a is not None and a != BENIGN and n >= min_positives)
    trees = [Tree({1: Node(sum(sizes.values()), sizes[a])}) for a in attacks]
    columns = dict(zip(features, plain))
    for depth in range(max_depth if features else 0):
        growing = [
            (k, i, node.n, node.positives)
            for k, tree in enumerate(trees)
            for i, node in tree.leaves().items()
            if i.bit_length() - 1 == depth and 0 < node.positives < node.n and node.n >= 2 * min_leaf
        ]
        if not growing:
            break
        kept = [{i for k, i, *_ in growing if k == own} for own in range(len(trees))]
        places = [tree.place(columns, keep) for tree, keep in zip(trees, kept)]
        table = data.sparkSession.createDataFrame(growing, "tree int, node int, all_n long, all_p long")
        for (k, i), (feature, threshold, n, p) in _best_cuts(data, plain, attacks, places, table, min_leaf).items():
            nodes, node = trees[k].nodes, trees[k].nodes[i]
            nodes[i] = Node(node.n, node.positives, features[feature], threshold)
            nodes[2 * i], nodes[2 * i + 1] = Node(n, p), Node(node.n - n, node.positives - p)
    return _tables(flows, features, dict(zip(attacks, trees)))


def _tables(flows: DataFrame, features: list[str], trees: dict[str, Tree]) -> Trees:
    spark = flows.sparkSession
    rules = [
        (a, 2 * position + side, feature, float(threshold), sign)
        for a, tree in trees.items()
        for position, (feature, threshold) in enumerate(tree.splits())
        for side, sign in enumerate(("<=", ">"))
    ]
    shares = [(a, f, tree.importances().get(f, 0.0)) for a, tree in trees.items() for f in features]
    nodes = [(a, i, x.n, x.positives, x.feature, x.threshold) for a, tree in trees.items() for i, x in tree.nodes.items()]
    return Trees(
        spark.createDataFrame(
            [(a, *tree.quality()) for a, tree in trees.items()], f"{CLASS} string, accuracy double, precision double, recall double"
        ),
        spark.createDataFrame(rules, f"{CLASS} string, position int, feature string, threshold double, direction string"),
        spark.createDataFrame(shares, f"{CLASS} string, feature string, importance double"),
        spark.createDataFrame(nodes, f"{CLASS} string, node int, rows long, positives long, feature string, threshold double"),
        trees,
    )
