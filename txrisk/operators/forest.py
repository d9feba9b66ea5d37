"""Forests as tables: one row per node, scored by built-in expressions, cut back by the size of their nodes.

A fitted forest becomes ``(tree, id, feature, threshold, left, right, n, risk)``: leaves have -1 as their children, ``n`` is the number of
training rows that reached the node, ``risk`` the share of the positive class among them. Scoring walks arrays with higher-order
functions: no Python and no model object.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Model
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txrisk.functions.columns import named
from txrisk.session import materialise, scratch_path

BROADCAST_NODES = 1_000_000  # of about 60 bytes


def forest_nodes(spark: SparkSession, model: Model) -> DataFrame:
    """The node table of a fitted forest or tree."""
    path = scratch_path(spark, "forest")
    model.write().save(path)
    saved = spark.read.parquet(f"{path}/data")
    tree = F.col("treeID") if "treeID" in saved.columns else F.lit(0)
    node = F.col("nodeData") if "nodeData" in saved.columns else F.struct("*")
    stats = F.col("node.impurityStats")
    nodes = saved.select(tree.cast("int").alias("tree"), node.alias("node")).select(
        "tree",
        F.col("node.id").alias("id"),
        F.col("node.split.featureIndex").alias("feature"),
        F.get("node.split.leftCategoriesOrThreshold", F.lit(0)).alias("threshold"),
        F.col("node.leftChild").alias("left"),
        F.col("node.rightChild").alias("right"),
        F.col("node.rawCount").alias("n"),
        (stats[1] / F.aggregate(stats, F.lit(0.0), lambda a, x: a + x)).alias("risk"),
    )
    return materialise(nodes)


def cut_small_nodes(nodes: DataFrame, min_samples_split: int) -> DataFrame:
    """The forest that growing with ``min_samples_split`` gives: nodes with fewer training rows aren't split.

    A node's split depends on its own rows only, so cutting the grown tree is the same; what lies below a cut stays in the table,
    out of reach.
    """
    small = F.col("n") < min_samples_split
    return nodes.withColumns({c: F.when(small, F.lit(-1)).otherwise(F.col(c)) for c in ("left", "right")})


def _walk(vector: Column, depth: int) -> Column:
    """The leaf that ``vector`` reaches in the arrays of its tree."""

    def step(node: Column, _: Column) -> Column:
        goes_left = F.get(vector, F.get("feature", node)) <= F.get("threshold", node)
        child = F.when(goes_left, F.get("left", node)).otherwise(F.get("right", node))
        return F.when(F.get("left", node) < 0, node).otherwise(child)

    return F.aggregate(F.sequence(F.lit(1), F.lit(max(depth, 1))), F.lit(0), step)


def leaf_shares(
    vectors: DataFrame, nodes: DataFrame, keys: Sequence[str], depth: int, match: Sequence[str] = (), forest: Sequence[str] = ()
) -> DataFrame:
    """(*keys, *match, *forest, _risk): for each row and tree the share in the leaf that the row reaches.

    ``nodes`` may hold several forests, told apart by ``forest``; a row meets those that equal it in the ``match`` columns.
    """
    node = F.sort_array(F.collect_list(F.struct("id", "feature", "threshold", "left", "right", "risk")))
    fields = ("feature", "threshold", "left", "right", "risk")
    trees = nodes.groupBy(*match, *forest, "tree").agg(node.alias("node"))
    trees = trees.select(*match, *forest, "tree", *(F.col(f"node.{c}").alias(c) for c in fields))
    size = nodes.agg(F.count(F.lit(1)), F.max("tree")).first()
    each = vectors.select(*(named(c) for c in keys), *match, vector_to_array("features").alias("_x"))
    each = each.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(size[1]))))
    joined = each.join(F.broadcast(trees) if size[0] <= BROADCAST_NODES else trees, [*match, "tree"])
    return joined.select(*(named(c) for c in keys), *match, *forest, F.get("risk", _walk(F.col("_x"), depth)).alias("_risk"))


def score_forest(vectors: DataFrame, nodes: DataFrame, keys: Sequence[str], depth: int, output: str = "risk_probability") -> DataFrame:
    """(*keys, output): the mean of the leaves' shares over all trees, for rows of unique ``keys`` with ``features``."""
    return leaf_shares(vectors, nodes, keys, depth).groupBy(*(named(c) for c in keys)).agg(F.avg("_risk").alias(output))
