"""Evaluation of scored rows: a score in [0, 1] against a 0/1 label."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txrisk.functions.columns import named
from txrisk.session import materialise

METRIC_NAMES = ["accuracy", "precision", "recall", "f1", "roc_auc"]
Keep = Callable[[DataFrame], DataFrame]
SCORES_PER_RANGE = 1_000_000


def _ratios() -> list[Column]:
    """``n`` and the four metrics from the counts ``n, tp, fp, fn``."""
    n, tp, fp, fn = (F.col(c) for c in ("n", "tp", "fp", "fn"))

    def ratio(part, whole):
        return F.coalesce(F.try_divide(part, whole), F.lit(0.0))

    return [
        n,
        F.try_divide(n - fp - fn, n).alias("accuracy"),
        ratio(tp, tp + fp).alias("precision"),
        ratio(tp, tp + fn).alias("recall"),
        ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
    ]


def classification_metrics(scored: DataFrame, label: str, score: str, threshold: float = 0.5) -> DataFrame:
    """``(n, accuracy, precision, recall, f1)``; a row is positive when its score is above ``threshold``.

    Precision, recall and F1 are 0 where their denominator is. Rows whose score is null or NaN are left out.
    """
    positive, predicted = named(label) == 1, named(score) > threshold
    counts = scored.where(named(label).isNotNull() & named(score).isNotNull() & ~F.isnan(named(score).cast("double"))).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(positive & predicted).alias("tp"),
        F.count_if(~positive & predicted).alias("fp"),
        F.count_if(positive & ~predicted).alias("fn"),
    )
    return counts.select(*_ratios())


def _per_score(scored: DataFrame, label: str, scores: Mapping[str, str]) -> DataFrame:
    """``(model, score, pos, neg)``: class counts per distinct score of every model, in one scan."""
    pairs = F.array(*(F.struct(F.lit(m).alias("model"), named(s).cast("double").alias("score")) for m, s in scores.items()))
    long = scored.where(named(label).isNotNull()).select((named(label) == 1).alias("positive"), F.inline(pairs))
    known = long.where(F.col("score").isNotNull() & ~F.isnan("score"))
    return known.groupBy("model", "score").agg(
        F.count_if(F.col("positive")).alias("pos"), F.count_if(~F.col("positive")).alias("neg")
    )


def _areas(per_score: DataFrame, ranges: int, keep: Keep = materialise) -> DataFrame:
    """``(model, roc_auc)`` from ``_per_score`` cut into ``ranges`` ranges by (model, score)."""
    ranged = keep(per_score.repartitionByRange(ranges, "model", "score").withColumn("range", F.spark_partition_id()))
    totals = ranged.groupBy("model", "range").agg(F.sum("neg").alias("_neg"))
    before = Window.partitionBy("model").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("model", "range", F.coalesce(F.sum("_neg").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("model", "range").orderBy("score").rowsBetween(Window.unboundedPreceding, -1)
    placed = ranged.withColumn("below", F.coalesce(F.sum("neg").over(inside), F.lit(0))).join(offsets, ["model", "range"])
    won = F.col("pos") * (F.col("offset") + F.col("below") + F.col("neg") / 2)
    sums = placed.groupBy("model").agg(F.sum(won).alias("won"), F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    return sums.select("model", F.try_divide("won", F.col("pos").cast("double") * F.col("neg")).alias("roc_auc"))


def _ranges_for(per_score: DataFrame) -> int:
    return per_score.count() // SCORES_PER_RANGE + 1


def areas_of(per_score: DataFrame) -> DataFrame:
    """``(model, roc_auc)`` of a materialised table ``(model, score, pos, neg)``, for any number of models at once."""
    return _areas(per_score, _ranges_for(per_score))


def roc_auc(scored: DataFrame, label: str, score: str, ranges: int | None = None) -> DataFrame:
    """One row ``roc_auc``: the exact area, tied scores counting one half; null when only one class is present.

    Works on class counts per distinct score (which runs a job). A running count over all scores would be one task, so
    the distinct scores are range-partitioned, about ``SCORES_PER_RANGE`` to a range unless ``ranges`` is given; counts run
    inside each range and the totals of the ranges before, one row per range, are added. The bounds only balance the
    work: any bounds give the same area. Rows whose score is null or NaN are left out.
    """
    per_score = materialise(_per_score(scored, label, {"score": score}))
    return _areas(per_score, ranges or _ranges_for(per_score)).agg(F.max("roc_auc").alias("roc_auc"))


def evaluate(scored: DataFrame, label: str, score: str, threshold: float = 0.5, keep: Keep = materialise) -> DataFrame:
    """All metrics in one row, from one scan."""
    return compare_models(scored, label, {"score": score}, threshold, keep).drop("model")


def compare_models(scored: DataFrame, label: str, scores: Mapping[str, str], threshold: float = 0.5, keep: Keep = materialise) -> DataFrame:
    """One ``evaluate`` row per model; ``scores`` maps a model name to its score column.

    One scan of ``scored`` counts the classes per model and distinct score; all metrics of all models come from those counts.
    ``keep`` holds the counts, ``Scratch.keep`` for an owner who ends them.
    """
    if not scores:
        raise ValueError("No models to compare")
    per_score = keep(_per_score(scored, label, scores))
    above = F.col("score") > threshold
    counts = per_score.groupBy("model").agg(
        F.sum(F.col("pos") + F.col("neg")).alias("n"),
        F.sum(F.when(above, F.col("pos")).otherwise(0)).alias("tp"),
        F.sum(F.when(above, F.col("neg")).otherwise(0)).alias("fp"),
        F.sum(F.when(above, 0).otherwise(F.col("pos"))).alias("fn"),
    )
    models = scored.sparkSession.createDataFrame([(m,) for m in scores], "model string")
    # A model without any known score has a row of its own, of no rows.
    rows = models.join(counts, "model", "left").fillna(0, ["n", "tp", "fp", "fn"])
    return rows.join(_areas(per_score, _ranges_for(per_score), keep), "model", "left").select("model", *_ratios(), "roc_auc")
