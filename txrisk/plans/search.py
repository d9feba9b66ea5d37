"""Search over the forest's settings, every setting and fold evaluated in one job."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import product
from multiprocessing.pool import ThreadPool
from typing import Any, NamedTuple

from pyspark.ml import Model
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txrisk.operators.forest import cut_small_nodes, forest_nodes, leaf_shares
from txrisk.operators.metrics import areas_of
from txrisk.operators.split import stratified_folds
from txrisk.operators.train import GRID_DEPTHS, GRID_MIN_SPLIT, GRID_TREES, LABEL, random_forest
from txrisk.schema import CUSTOMER
from txrisk.session import materialise

SETTING = ("trees", "max_depth", "min_samples_split")


class Search(NamedTuple):
    """``areas``: (trees, max_depth, min_samples_split, fold, n, roc_auc). ``nodes`` is ``model`` cut by the best ``min_samples_split``."""

    areas: DataFrame
    best: dict[str, Any]
    model: Model
    nodes: DataFrame


def search_forests(
    train: DataFrame,
    trees: Sequence[int] = tuple(GRID_TREES),
    depths: Sequence[int] = tuple(GRID_DEPTHS),
    min_splits: Sequence[int] = tuple(GRID_MIN_SPLIT),
    folds: int = 3,
    seed: int = 42,
    parallelism: int = 4,
) -> Search:
    """Stratified cross-validation on the exact ROC area; the best setting (first on ties) is fitted again on all of ``train``.

    ``train``: customer id, which decides the folds, label and ``features``. Forests that differ in ``min_samples_split`` only are one fit,
    cut afterwards. Scores of all settings and folds go through one count per distinct score.
    """
    spark = train.sparkSession
    folded = materialise(stratified_folds(train, folds, LABEL, CUSTOMER, seed).select(CUSTOMER, LABEL, "fold", "features"))

    def fitted(setting: tuple[int, int, int]) -> DataFrame:
        count, depth, fold = setting
        nodes = forest_nodes(spark, random_forest(count, depth, seed).fit(folded.where(F.col("fold") != fold)))
        return nodes.withColumns({"trees": F.lit(count), "max_depth": F.lit(depth), "fold": F.lit(fold)})

    with ThreadPool(parallelism) as pool:
        grown = pool.map(fitted, list(product(trees, depths, range(folds))))
    every = None
    for nodes in grown:
        for limit in min_splits:
            cut = cut_small_nodes(nodes, limit).withColumn("min_samples_split", F.lit(limit))
            every = cut if every is None else every.unionByName(cut)
    name = F.concat_ws("/", *SETTING, "fold").alias("model")
    shares = leaf_shares(folded, materialise(every), [CUSTOMER, LABEL], max(depths), match=["fold"], forest=list(SETTING))
    scores = shares.groupBy(CUSTOMER, LABEL, "fold", *SETTING).agg(F.avg("_risk").alias("score"))
    positive = F.col(LABEL) == 1
    per_score = materialise(scores.groupBy(name, "score").agg(F.count_if(positive).alias("pos"), F.count_if(~positive).alias("neg")))
    sizes = per_score.groupBy("model").agg(F.sum(F.col("pos") + F.col("neg")).alias("n"))
    parts = F.split("model", "/")
    columns = [parts[i].cast("int").alias(c) for i, c in enumerate((*SETTING, "fold"))]
    areas = materialise(sizes.join(areas_of(per_score), "model", "left").select(*columns, "n", "roc_auc"))
    means = areas.groupBy(*SETTING).agg(F.avg("roc_auc").alias("roc_auc"))
    best = means.orderBy(F.desc_nulls_last("roc_auc"), *SETTING).first().asDict()
    model = random_forest(best["trees"], best["max_depth"], seed).fit(train)
    return Search(areas, best, model, cut_small_nodes(forest_nodes(spark, model), best["min_samples_split"]))
