"""Classifier evaluation as aggregations over a scored table.

A scored table has ``label`` and ``prediction`` (0 / 1), a ``score`` for the positive class
and, where several models are compared, a ``model`` column. Everything is counted in one pass;
what follows works on a handful of rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beatgrid.config import GateParams
from beatgrid.functions.numeric import ratio
from beatgrid.operators.ordered import bucket_edges, cumulative
from beatgrid.sources.files import materialised

# Thresholds of the sweep, 0.1 to 0.9.
THRESHOLDS = tuple(i / 10 for i in range(1, 10))


def _hit(label: int, prediction: int | Column, guess: Column | None = None) -> Column:
    guess = F.col("prediction") if guess is None else guess
    return F.count_if((F.col("label") == label) & (guess == prediction))


def outcome_counts(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """tp, fp, fn, tn per group in one pass."""
    return scored.groupBy(*by).agg(
        _hit(1, 1).alias("tp"), _hit(0, 1).alias("fp"), _hit(1, 0).alias("fn"), _hit(0, 0).alias("tn")
    )


def confusion_matrix(scored: DataFrame) -> DataFrame:
    """Four rows (label, prediction, n), empty cells included."""
    cells = F.array(
        *[
            F.struct(F.lit(a).alias("label"), F.lit(p).alias("prediction"), F.col(c).alias("n"))
            for a, p, c in ((0, 0, "tn"), (0, 1, "fp"), (1, 0, "fn"), (1, 1, "tp"))
        ]
    )
    return outcome_counts(scored).select(F.explode(cells).alias("cell")).select("cell.*")


def with_metrics(counts: DataFrame) -> DataFrame:
    """accuracy, precision, recall and F1; 0 where a denominator is 0."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return counts.withColumns(
        {
            "accuracy": ratio(tp + tn, tp + fp + fn + tn),
            "precision": ratio(tp, tp + fp),
            "recall": ratio(tp, tp + fn),
            "f1_score": ratio(2 * tp, 2 * tp + fp + fn),
        }
    )


def metrics(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return with_metrics(outcome_counts(scored, by)).select(
        *by, "accuracy", "precision", "recall", "f1_score"
    )


def class_report(scored: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support per class, with macro and weighted averages."""
    counts = outcome_counts(scored)
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))

    def row(name: str, hit: Column, wrong: Column, missed: Column) -> Column:
        return F.struct(
            F.lit(name).alias("class"),
            ratio(hit, hit + wrong).alias("precision"),
            ratio(hit, hit + missed).alias("recall"),
            ratio(2 * hit, 2 * hit + wrong + missed).alias("f1_score"),
            (hit + missed).alias("support"),
        )

    classes = counts.select(row("0", tn, fn, fp).alias("a"), row("1", tp, fp, fn).alias("b"))
    a, b = F.col("a"), F.col("b")
    total = a["support"] + b["support"]

    def average(name: str, blend) -> Column:
        return F.struct(
            F.lit(name).alias("class"),
            *[blend(m).alias(m) for m in ("precision", "recall", "f1_score")],
            total.alias("support"),
        )

    macro = average("macro avg", lambda m: (a[m] + b[m]) / 2)
    weighted = average(
        "weighted avg", lambda m: ratio(a[m] * a["support"] + b[m] * b["support"], total)
    )
    accuracy = ratio(
        a["recall"] * a["support"] + b["recall"] * b["support"], total
    )
    overall = F.struct(
        F.lit("accuracy").alias("class"),
        *[accuracy.alias(m) for m in ("precision", "recall", "f1_score")],
        total.alias("support"),
    )
    return classes.select(
        F.explode(F.array(a, b, overall, macro, weighted)).alias("r")
    ).select("r.*")


def roc_auc(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Area under the ROC curve by rank sums, ties averaged; NULL with one class only.

    Scores are counted per distinct value and staged, ranks come from bucketed running totals.
    """
    by = list(by)
    rows = scored.select(*by, F.col("score").cast("double").alias("score"), "label")
    counted = rows.groupBy(*by, "score").agg(
        F.count_if(F.col("label") == 1).alias("pos"), F.count("*").alias("n")
    )
    counted = materialised(counted, "counted")
    ranked = cumulative(counted, "score", "n", bucket_edges(counted, ["score"])["score"], by)
    pos = F.col("n_pos").cast("double")
    return (
        ranked.groupBy(*by)
        .agg(
            F.sum("pos").alias("n_pos"),
            F.sum(F.col("n") - F.col("pos")).alias("n_neg"),
            F.sum(F.col("pos") * (F.col("below") + (F.col("n") + 1) / 2)).alias("rank_sum"),
        )
        .select(
            *by,
            "n_pos",
            "n_neg",
            F.try_divide(
                F.col("rank_sum") - pos * (pos + 1) / 2, pos * F.col("n_neg").cast("double")
            ).alias("roc_auc"),
        )
    )


def compare_models(scored: DataFrame) -> DataFrame:
    """One row per model, best F1 first. The pruned scores are staged and read from there."""
    scored = materialised(scored.select("model", "label", "prediction", "score"), "scores")
    areas = roc_auc(scored, ["model"]).select("model", "roc_auc")
    return (
        metrics(scored, ["model"]).join(areas, "model", "left").orderBy(F.desc("f1_score"), "model")
    )


def quality_gate(compared: DataFrame, params: GateParams = GateParams()) -> DataFrame:
    """Whether a model may be registered, and its risk label."""
    f1 = F.col("f1_score")
    return compared.select(
        "model",
        "f1_score",
        (f1 >= params.f1_threshold).alias("approved"),
        F.when(f1 < params.high_risk_below, "High").otherwise("Low").alias("risk"),
    )


def threshold_sweep(scored: DataFrame, thresholds: Sequence[float] = THRESHOLDS) -> DataFrame:
    """Metrics at each threshold. All thresholds are counted in one pass over the scores."""
    at = [
        F.struct(
            F.lit(float(t)).alias("threshold"),
            *[
                _hit(label, 1, (F.col("score") >= t).cast("int")).alias(name)
                if guess
                else _hit(label, 0, (F.col("score") >= t).cast("int")).alias(name)
                for name, label, guess in (("tp", 1, 1), ("fp", 0, 1), ("fn", 1, 0), ("tn", 0, 0))
            ],
        )
        for t in thresholds
    ]
    counts = scored.agg(F.array(*at).alias("at")).select(F.explode("at").alias("x")).select("x.*")
    return with_metrics(counts)


def evaluation_report(scored: DataFrame, n_features: int, model_type: str) -> DataFrame:
    """One row: metrics, test size, positive share, feature count."""
    counts = with_metrics(outcome_counts(scored))
    size = F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")
    return counts.select(
        F.lit(model_type).alias("model_type"),
        "accuracy",
        "precision",
        "recall",
        "f1_score",
        size.alias("test_size"),
        ratio(F.col("tp") + F.col("fn"), size).alias("positive_class_ratio"),
        F.lit(n_features).alias("feature_count"),
    )


def vote(
    scores: DataFrame,
    weights: dict[str, float],
    voting: str = "soft",
) -> DataFrame:
    """Weighted voting over one score column per model.

    Soft: weighted mean of scores, positive above one half. Hard: weighted vote of the single
    predictions; a tie goes to class 0.
    """
    total = float(sum(weights.values()))
    if voting == "soft":
        parts = [F.col(c) * F.lit(float(w)) for c, w in weights.items()]
    elif voting == "hard":
        parts = [
            F.when(F.col(c) > 0.5, F.lit(float(w))).otherwise(F.lit(0.0))
            for c, w in weights.items()
        ]
    else:
        raise ValueError(f"unknown voting: {voting}")
    out = parts[0]
    for part in parts[1:]:
        out = out + part
    return scores.withColumn("score", out / total).withColumn(
        "prediction", (F.col("score") > 0.5).cast("int")
    )
