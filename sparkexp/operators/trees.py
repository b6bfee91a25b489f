"""Regression trees for boosting, grown by Spark level by level on rows that were binned once.

A quantile sketch over all rows fixes the cuts of each column once for a whole
training. Rows are stored as the numbers of their bins. One level of a tree
is then one aggregation of gradient, curvature and rows by node, column and bin: each task adds up its rows
with numpy, in Arrow batches, and Spark adds up the tasks' sums. They come to the driver, for their
number does not depend on the rows, and it looks for the best split of each node. Of two
children only the one with fewer rows is aggregated; the other's sums are the parent's minus these.
At most ``CELLS`` sums are taken at once: more are aggregated in several passes, a block of columns
each, and are not kept for the subtraction, so the driver's memory is bounded for any number of columns.

A missing value is a bin of its own. Each split is tried with the missing rows on either
side and remembers where they belong.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.ml.regression import DecisionTreeRegressionModel, GBTRegressionModel
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sparkexp.config import TrainingParams
from sparkexp.functions.columns import col
from sparkexp.operators.features import FEATURES, FINITE, PREFIX

LABEL, WEIGHT, MARGIN = f"{PREFIX}label", f"{PREFIX}weight", f"{PREFIX}margin"
# The bin of a missing value.
MISSING = -1
# Curvature is not taken as smaller than this, so that a certain row's step stays finite.
LEAST_CURVATURE = 1e-6
MOST_BINS = 32_000
# The rank of a cut is off by at most one in SKETCH times the number of bins.
SKETCH = 20
# Sums that are aggregated at once, 24 bytes each on the driver.
CELLS = 1_000_000
# Gains are compared to so many decimals, so that the order in which Spark adds does not choose among equal splits.
GAIN_DECIMALS = 9


@dataclass(frozen=True)
class Sketch:
    """What is known of the training rows: counts, and the cuts of each column.

    The bin of a value is the number of cuts that are not above it.
    """

    rows: int
    positives: int
    negatives: int
    cuts: tuple[tuple[float, ...], ...]


def distinct_counts(columns: Sequence[Column]) -> list[Column]:
    """About how many distinct values each column has; :func:`sketch_columns` takes these."""
    return [F.approx_count_distinct(c, 0.02).alias(f"d{i}") for i, c in enumerate(columns)]


def sketch_columns(train: DataFrame, columns: Sequence[Column], label: Column, max_bin: int, known: Mapping[str, int] | None = None) -> Sketch:
    """Count rows and classes, then find the cuts, for ``max_bin`` bins a column at most.

    The columns hold finite doubles, and null where a value is missing. A column with no more
    distinct values than bins gets a cut at each value but the least. Others are cut at quantiles.
    ``known`` has what a pass before has counted.
    """
    bins = min(max_bin, MOST_BINS)
    row = known or train.agg(*class_counts(label), *distinct_counts(columns)).first()
    few = [0 < row[f"d{i}"] <= bins + bins // 10 for i in range(len(columns))]
    shares = [i / bins for i in range(bins)]
    quantiles = [F.percentile_approx(c, shares, SKETCH * bins) for c in columns]
    points = [F.collect_set(c) if few[i] else quantiles[i] for i, c in enumerate(columns)]
    found = train.agg(*[c.alias(f"c{i}") for i, c in enumerate(points)]).first()
    # The count was approximate: a column with a few more values than bins after all.
    over = [i for i in range(len(columns)) if few[i] and len(found[f"c{i}"]) > bins]
    again = train.agg(*[quantiles[i].alias(f"c{i}") for i in over]).first() if over else {}
    cuts = []
    for i in range(len(columns)):
        # Both zeros are one value to the bins, as they are to a comparison.
        values = {point + 0.0 for point in (again if i in over else found)[f"c{i}"] or []}
        cuts.append(tuple(sorted(values)[1:]))
    return Sketch(row["rows"], row["positives"], row["negatives"], tuple(cuts))


def class_counts(label: Column) -> list[Column]:
    """Rows, and those of either class."""
    return [F.count(F.lit(1)).alias("rows"), F.count_if(label).alias("positives"), F.count_if(~label).alias("negatives")]


def bin_names(count: int) -> list[str]:
    return [f"bin{i}" for i in range(count)]


def with_bins(df: DataFrame, columns: Sequence[Column], sketch: Sketch) -> DataFrame:
    """Add the bin of each column, a short; ``MISSING`` where there is no value."""
    values = [F.coalesce(column, F.lit(float("nan"))).alias(f"{PREFIX}x{i}") for i, column in enumerate(columns)]
    raw = df.select("*", *values)
    cut = [i for i, cuts in enumerate(sketch.cuts) if cuts]
    if cut:
        raw = Bucketizer(
            inputCols=[f"{PREFIX}x{i}" for i in cut],
            outputCols=[f"{PREFIX}b{i}" for i in cut],
            splitsArray=[[-math.inf, *sketch.cuts[i], math.inf] for i in cut],
            handleInvalid="keep",
        ).transform(raw)
    bins = []
    for i, cuts in enumerate(sketch.cuts):
        known = F.col(f"{PREFIX}b{i}") if cuts else F.lit(0)
        bins.append(F.when(F.isnan(f"{PREFIX}x{i}"), F.lit(MISSING)).otherwise(known).cast("short").alias(f"bin{i}"))
    return raw.select(*[col(name) for name in df.columns], *bins)


@dataclass
class Node:
    """A node of a growing tree with the sums of its rows. ``column`` is -1 in a leaf."""

    gradient: float
    curvature: float
    rows: int
    column: int = -1
    bin: int = -1
    missing_right: bool = True
    left: int = -1
    right: int = -1
    gain: float = 0.0


@dataclass
class Tree:
    """Nodes, the root first; and the value that each leaf adds to a margin."""

    nodes: list[Node] = field(default_factory=list)
    values: dict[int, float] = field(default_factory=dict)

    def leaves(self, start: int = 0) -> list[int]:
        node = self.nodes[start]
        return [start] if node.column < 0 else self.leaves(node.left) + self.leaves(node.right)

    def arrays(self) -> dict[str, np.ndarray]:
        """The nodes as tasks use them, with the value of each leaf."""
        made = {name: np.array([getattr(node, name) for node in self.nodes]) for name in ("column", "bin", "missing_right", "left", "right")}
        return made | {"value": np.array([self.values.get(i, 0.0) for i in range(len(self.nodes))])}


# The functions that tasks run are nested, so that Spark sends them whole to executors without this package.


def _router() -> Callable[[dict[str, np.ndarray], np.ndarray], np.ndarray]:
    def route(tree: dict[str, np.ndarray], bins: np.ndarray) -> np.ndarray:
        """The leaf in which each row (a column of ``bins``) lies."""
        node, row = np.zeros(bins.shape[1], np.int64), np.arange(bins.shape[1])
        while True:
            column = tree["column"][node]
            if (column < 0).all():
                return node
            here = bins[column, row]
            right = np.where(here < 0, tree["missing_right"][node], here > tree["bin"][node])
            node = np.where(column < 0, node, np.where(right, tree["right"][node], tree["left"][node]))

    return route


def add_margins(rows: DataFrame, trees: Sequence[Tree], count: int) -> DataFrame:
    """The binned rows with what ``trees`` add in their margin."""
    if not trees:
        return rows
    arrays, route, schema = [tree.arrays() for tree in trees], _router(), rows.schema
    bins_at, margin_at = [rows.columns.index(name) for name in bin_names(count)], rows.columns.index(MARGIN)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bins = np.stack([batch.column(i).to_numpy() for i in bins_at])
            margin = batch.column(margin_at).to_numpy()
            for tree in arrays:
                margin = margin + tree["value"][route(tree, bins)]
            columns = [pa.array(margin) if i == margin_at else column for i, column in enumerate(batch.columns)]
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return rows.mapInArrow(run, schema)


def level_sums(
    rows: DataFrame,
    tree: Tree,
    pending: Sequence[Tree],
    nodes: Sequence[int],
    columns: Sequence[int],
    count: int,
    width: int,
    logistic: bool,
) -> DataFrame:
    """Gradient ``g``, curvature ``h`` and rows ``n`` by cell, which counts bins (the missing one first)
    within nodes within columns. The margins are those of ``rows`` plus what the trees in ``pending`` add."""
    arrays, route, growing = [t.arrays() for t in pending], _router(), tree.arrays()
    place = np.full(len(tree.nodes), -1)
    place[list(nodes)] = np.arange(len(nodes))
    size, wanted, least = len(nodes) * width, list(columns), LEAST_CURVATURE

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((3, len(wanted), size))
        for batch in batches:
            bins = np.stack([batch.column(i).to_numpy() for i in range(count)])
            label, weight, margin = (batch.column(count + i).to_numpy() for i in range(3))
            at = place[route(growing, bins)]
            here = at >= 0
            bins, at, label, weight, margin = bins[:, here], at[here], label[here], weight[here], margin[here]
            for added in arrays:
                margin = margin + added["value"][route(added, bins)]
            if logistic:
                guess = 1 / (1 + np.exp(-margin))
                curvature = weight * np.maximum(guess * (1 - guess), least)
            else:
                guess, curvature = margin, weight
            gradient = weight * (label - guess)
            for k, column in enumerate(wanted):
                cell = at * width + 1 + bins[column]
                sums[0, k] += np.bincount(cell, gradient, size)
                sums[1, k] += np.bincount(cell, curvature, size)
                sums[2, k] += np.bincount(cell, minlength=size)
        flat = sums.reshape(3, -1)
        cells = np.flatnonzero(flat[2])
        made = [pa.array(cells), pa.array(flat[0, cells]), pa.array(flat[1, cells]), pa.array(flat[2, cells].astype(np.int64))]
        yield pa.RecordBatch.from_arrays(made, names=["cell", "g", "h", "n"])

    used = rows.select(*bin_names(count), LABEL, WEIGHT, MARGIN)
    by_task = used.mapInArrow(run, "cell long, g double, h double, n long")
    return by_task.groupBy("cell").agg(F.sum("g").alias("g"), F.sum("h").alias("h"), F.sum("n").alias("n"))


def _shrunk(g: float, alpha: float) -> float:
    return math.copysign(max(abs(g) - alpha, 0.0), g)


def leaf_value(g: float, h: float, params: TrainingParams) -> float:
    """The step of a leaf: penalised gradient over penalised curvature, times the learning rate."""
    bottom = h + params.reg_lambda
    return params.eta * _shrunk(g, params.reg_alpha) / bottom if bottom > 0 else 0.0


@dataclass(frozen=True)
class Split:
    """The best split of a node, with the sums of gradient, curvature and rows on both sides."""

    gain: float
    column: int
    bin: int
    missing_right: bool
    left: tuple[float, float, int]
    right: tuple[float, float, int]


def best_split(sums: np.ndarray, columns: Sequence[int], params: TrainingParams) -> Split | None:
    """The best split of one node over its sums by kind (gradient, curvature, rows), column and bin, missing bin first.

    The gain is half of what the penalised loss falls by. Children must weigh
    ``min_child_weight`` and hold a row. Among equal gains the first column and bin win, then missing values go right.
    """
    total = sums[:, :1].sum(axis=2, keepdims=True)
    below = np.cumsum(sums, axis=2)[:, :, 1:]
    # On the left: all up to the bin without and with the missing rows.
    left = np.stack([below - sums[:, :, :1], below], axis=-1)
    right = total[..., None] - left

    def score(side: np.ndarray) -> np.ndarray:
        top, bottom = np.maximum(np.abs(side[0]) - params.reg_alpha, 0.0) ** 2, side[1] + params.reg_lambda
        return np.divide(top, bottom, out=np.zeros_like(top), where=bottom > 0)

    gain = np.round(0.5 * (score(left) + score(right) - score(total[..., None])), GAIN_DECIMALS)
    least = params.min_child_weight
    may = (left[2] > 0) & (right[2] > 0) & (left[1] >= least) & (right[1] >= least) & (gain > 0)
    if not may.any():
        return None
    at = np.unravel_index(np.argmax(np.where(may, gain, -1.0)), gain.shape)
    sides = [(float(side[0][at]), float(side[1][at]), round(side[2][at])) for side in (left, right)]
    return Split(float(gain[at]), columns[at[0]], int(at[1]), at[2] == 0, *sides)


class TreeGrower:
    """Grows one tree after another on binned rows with label, weight and margin, and turns them into MLlib models."""

    def __init__(self, spark: SparkSession, sketch: Sketch, params: TrainingParams, cells: int = CELLS) -> None:
        self.spark, self.cuts, self.params, self.cells = spark, sketch.cuts, params, cells

    def grow(self, rows: DataFrame, columns: Sequence[int], pending: Sequence[Tree] = ()) -> Tree | None:
        """A tree that may split on ``columns``; None when there are no rows.

        The rows' margins do not hold what the trees in ``pending`` add.
        """
        params, tree = self.params, Tree()
        # By node the sums of its rows, as long as its children may be had by subtraction.
        held: dict[int, np.ndarray] = {}
        open_nodes, built, rest = [0], [0], {}
        growing = Tree([Node(0.0, 0.0, 0)])
        for depth in range(max(1, params.max_depth)):
            width = 1 + max((len(self.cuts[i]) for i in columns), default=0) + 1
            at_once = max(1, self.cells // (len(built) * width))
            found: dict[int, Split] = {}
            whole = at_once >= len(columns)
            if not whole:  # every open node is aggregated itself
                built, rest = list(open_nodes), {}
                at_once = max(1, self.cells // (len(built) * width))
            sums: dict[int, np.ndarray] = {}
            for start in range(0, len(columns), at_once):
                block = columns[start : start + at_once]
                sums = self._sums(rows, growing, pending, built, block, width)
                for large, (parent, small) in rest.items():
                    sums[large] = held[parent] - sums[small]
                if not depth and not start:
                    if not sums[0][2].any():
                        return None
                    g, h, n = sums[0][:, 0].sum(axis=1)
                    tree.nodes.append(Node(float(g), float(h), round(n)))
                for node in open_nodes:
                    split = best_split(sums[node], block, params)
                    if split and (node not in found or split.gain > found[node].gain):
                        found[node] = split
            held = sums if whole else {}
            open_nodes, growing = self._split(tree, open_nodes, found), tree
            if not open_nodes:
                break
            built, rest = self._plan(tree, open_nodes, held)
        self._prune(tree)
        tree.values = {leaf: leaf_value(tree.nodes[leaf].gradient, tree.nodes[leaf].curvature, params) for leaf in tree.leaves()}
        return tree

    def _sums(
        self, rows: DataFrame, tree: Tree, pending: Sequence[Tree], nodes: Sequence[int], columns: Sequence[int], width: int
    ) -> dict[int, np.ndarray]:
        """Gradient, curvature and rows of each node by column and bin."""
        logistic = self.params.objective == "logistic"
        table = level_sums(rows, tree, pending, nodes, columns, len(self.cuts), width, logistic).toArrow()
        found = np.zeros((3, len(columns) * len(nodes) * width))
        for kind, name in enumerate("ghn"):
            found[kind, table.column("cell").to_numpy()] = table.column(name).to_numpy()
        by_column = found.reshape(3, len(columns), len(nodes), width)
        return {node: by_column[:, :, i] for i, node in enumerate(nodes)}

    def _split(self, tree: Tree, nodes: Sequence[int], found: dict[int, Split]) -> list[int]:
        """Split the nodes that have a split; returns the children that may be split further."""
        children = []
        if self.params.max_depth == 0:
            return children
        for number in nodes:
            split = found.get(number)
            if split is None:
                continue
            node = tree.nodes[number]
            node.column, node.bin, node.gain, node.missing_right = split.column, split.bin, split.gain, split.missing_right
            node.left, node.right = len(tree.nodes), len(tree.nodes) + 1
            tree.nodes += [Node(*split.left), Node(*split.right)]
            children += [
                child
                for child in (node.left, node.right)
                if tree.nodes[child].rows > 1 and tree.nodes[child].curvature >= 2 * self.params.min_child_weight
            ]
        return children

    def _plan(self, tree: Tree, open_nodes: Sequence[int], held: Mapping[int, np.ndarray]) -> tuple[list[int], dict[int, tuple[int, int]]]:
        """Which nodes to aggregate, and for the others their parent and the sibling to take from it."""
        wanted, built, rest = set(open_nodes), [], {}
        for number, node in enumerate(tree.nodes):
            pair = sorted((node.left, node.right), key=lambda child: tree.nodes[child].rows)
            if node.column < 0 or not wanted.intersection(pair):
                continue
            small, large = pair
            if large in wanted and number in held:
                built.append(small)
                rest[large] = (number, small)
            else:
                built += [child for child in pair if child in wanted]
        return built, rest

    def _prune(self, tree: Tree) -> None:
        """Take back splits that lower the loss by less than ``gamma``, from the leaves up."""
        for node in reversed(tree.nodes):  # children come after their parents
            if node.column >= 0 and node.gain < self.params.gamma:
                if all(tree.nodes[child].column < 0 for child in (node.left, node.right)):
                    node.column = -1

    # ------------------------------------------------------------ as MLlib models

    def tree_model(self, tree: Tree) -> DecisionTreeRegressionModel:
        """The tree as MLlib's, over the vector of values: first each with gaps beyond every cut, then each with gaps below.

        Python has no constructors for MLlib's trees, so this calls the public Scala ones.
        """
        jvm, gateway = self.spark._jvm, self.spark.sparkContext._gateway
        kinds = jvm.org.apache.spark.ml.tree
        stats = jvm.org.apache.spark.mllib.tree.impurity.VarianceCalculator(gateway.new_array(jvm.double, 3), 0)

        def build(number: int):
            node = tree.nodes[number]
            if node.column < 0:
                return kinds.LeafNode(float(tree.values[number]), 0.0, stats)
            feature = node.column if node.missing_right else len(self.cuts) + node.column
            cuts = self.cuts[node.column]
            # MLlib sends values up to the threshold to the left.
            threshold = math.nextafter(cuts[node.bin], -math.inf) if node.bin < len(cuts) else FINITE
            split = kinds.ContinuousSplit(feature, threshold)
            return kinds.InternalNode(0.0, 0.0, float(node.gain), build(node.left), build(node.right), split, stats)

        scala = jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel
        return DecisionTreeRegressionModel(scala("binned_tree", build(0), 2 * len(self.cuts)))


def ensemble_of(spark: SparkSession, trees: Sequence[DecisionTreeRegressionModel]) -> GBTRegressionModel:
    """Trees whose values MLlib adds up in one call a row."""
    jvm, gateway = spark._jvm, spark.sparkContext._gateway
    scala = jvm.org.apache.spark.ml.regression
    array = gateway.new_array(scala.DecisionTreeRegressionModel, len(trees))
    for i, tree in enumerate(trees):
        array[i] = tree._java_obj
    weights = gateway.new_array(jvm.double, len(trees))
    jvm.java.util.Arrays.fill(weights, 1.0)
    return GBTRegressionModel(scala.GBTRegressionModel("binned_trees", array, weights)).setFeaturesCol(FEATURES)
