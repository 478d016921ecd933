"""Training, tuning, resampling and scoring as queries over the given tables.

Fits use the published inputs, settings, grids, draws and folds. All rows of the tables take part.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from beatgrid.learn import anomaly, evaluate, importance, prep, resample, score, singles, train
from beatgrid.operators import splits
from beatgrid.plans import features
from beatgrid.config import WeatherParams
from beatgrid.sources import files
from beatgrid.sources import stand_ins as src
from workload.queries import _event_features, _events, query, rounded, snake

LABEL = features.LABEL
INPUT = list(features.MODEL_INPUT)
BY_HOUR = WeatherParams(keys=("area", "date", "hour"))


def model_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Model rows with weather and an 80 / 20 time split.

    Fits read their input many times, so they start from a written table.
    """
    base = _events(spark, sf_dir).select("incident_id", "area", "date", "hour", "category")
    full = features.engineer(
        base, src.event_population(spark, sf_dir), src.event_weather(spark, sf_dir), weather_params=BY_HOUR
    )
    rows = files.materialised(features.model_rows(full), "model-rows")
    parts = splits.split_by_time(rows, order="Datetime_Key")
    return files.read_table(spark, files.write_split(parts, files.scratch_path(spark, "model-split")))


def halves(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    table = model_split(spark, sf_dir)
    return table.filter(F.col("split") == "train"), table.filter(F.col("split") == "test")


def _metrics_of(model, test: DataFrame) -> DataFrame:
    result = train.scored(model, train.vectors(test, INPUT), LABEL).select(
        F.lit("model").alias("model"), "label", "prediction", "score"
    )
    return evaluate.compare_models(result).drop("model")


def _fit_query(name: str, family: str, use_smote: bool = False) -> None:
    @query(name)
    def run(spark, sf_dir):
        fit_on, test = halves(spark, sf_dir)
        return _metrics_of(train.train(fit_on, INPUT, LABEL, family, use_smote), test)


# ------------------------------------------------------------------ preparation


@query("ds3_mean_imputer")
def ds3(spark, sf_dir):
    cols = ["rate_last_row", "rate_last_3_avg", "rate_yesterday_same_hour", "z_score"]
    df = prep.numeric(_event_features(spark, sf_dir).select("incident_id", *cols), cols)
    return rounded(prep.mean_imputer(cols).fit(df).transform(df))


@query("ds4_min_max_scaling")
def ds4(spark, sf_dir):
    cols = ["hourly_rate", "daily_rate", "rate_last_6_sum", "hour_sin"]
    df = _event_features(spark, sf_dir).select("incident_id", *cols)
    return rounded(prep.min_max_scaled(df, cols))


# ------------------------------------------------------------------ resampling and training


@query("ml1_smote")
def ml1(spark, sf_dir):
    fit_on, _ = halves(spark, sf_dir)
    balanced = resample.smote(fit_on, INPUT, LABEL)
    return balanced.groupBy(LABEL, "is_synthetic").agg(F.count("*").alias("n"))


@query("ml1b_smote_copies")
def ml1b(spark, sf_dir):
    """Synthetic rows made from each row of the smaller class."""
    fit_on, _ = halves(spark, sf_dir)
    made = resample.smote(fit_on, INPUT, LABEL).filter("is_synthetic")
    return made.groupBy("incident_id").agg(F.count("*").alias("n"))


_fit_query("ml2_random_forest", "random_forest")
_fit_query("ml2b_random_forest_smote", "random_forest", use_smote=True)
_fit_query("ml3_boosted_weighted", "xgboost")
_fit_query("ml4_boosted_early_stop", "catboost")
_fit_query("ml4b_boosted_class_weights", "catboost_weighted")
_fit_query("ml5_extra_trees", "extra_trees")
_fit_query("ml6_balanced_forest", "balanced_random_forest")


@query("ml4c_patience_on_given_rows")
def ml4c(spark, sf_dir):
    """Light class weights on resampled rows, cut by F1 on the test rows: sizes, and whether the best
    round is the first best one up to the end and the cut model scores there like the curve."""
    fit_on, test = halves(spark, sf_dir)
    found = train.train_with_patience(fit_on, INPUT, LABEL, "catboost_weighted", test, use_smote=True)
    upto = found.scores[: found.stopped]
    again = evaluate.metrics(train.scored(found.model, train.vectors(test, INPUT), LABEL)).first()
    row = (
        len(found.scores), found.n_fit, found.n_evaluation, found.best <= found.stopped <= min(found.best + 20, len(found.scores)),
        upto.index(max(upto)) + 1 == found.best == len(found.model.treeWeights), abs(again["f1_score"] - max(upto)) < 1e-6,
    )
    return spark.createDataFrame([row], "n_rounds bigint, n_fit bigint, n_evaluation bigint, in_order boolean, is_first_best boolean, cut_agrees boolean")


@query("ml5b_random_cuts")
def ml5b(spark, sf_dir):
    """Trees of the extra-trees forest, cut points that two of them share, and those outside their feature's range."""
    fit_on, _ = halves(spark, sf_dir)
    model = train.train(fit_on, INPUT, LABEL, "extra_trees")
    table = spark.createDataFrame(model.trees.table()).filter("feature >= 0")
    split = table.select("tree", "feature", "threshold").distinct()
    shared = split.groupBy("feature", "threshold").agg(F.count_distinct("tree").alias("n"))
    low = train.vectors(fit_on, INPUT).agg(*[F.min(F.col(f"`{c}`").cast("double")).alias(f"a{i}") for i, c in enumerate(INPUT)]).first()
    high = train.vectors(fit_on, INPUT).agg(*[F.max(F.col(f"`{c}`").cast("double")).alias(f"b{i}") for i, c in enumerate(INPUT)]).first()
    ends = spark.createDataFrame([(i, low[i], high[i]) for i in range(len(INPUT))], "feature int, low double, high double")
    outside = split.join(F.broadcast(ends), "feature").agg(F.count_if(~F.col("threshold").between(F.col("low"), F.col("high"))).alias("n_outside"))
    return split.agg(F.count_distinct("tree").alias("n_trees")).join(shared.agg(F.count_if(F.col("n") > 1).alias("n_shared_cuts"))).join(outside)


@query("ml6b_balanced_draws")
def ml6b(spark, sf_dir):
    """Rows of each class in the sample of each tree."""
    fit_on, _ = halves(spark, sf_dir)
    trees = train.BASELINES["balanced_random_forest"]["numTrees"]
    drawn = singles.balanced_draws(fit_on.select("incident_id", LABEL), LABEL, trees, "incident_id", train.SEED)
    return drawn.groupBy("tree", LABEL).agg(F.count("*").alias("n"))


@query("ml7_model_dispatch")
def ml7(spark, sf_dir):
    fit_on, test = halves(spark, sf_dir)

    def of(family: str) -> DataFrame:
        model = train.train(fit_on, INPUT, LABEL, family)
        return _metrics_of(model, test).withColumn("model", F.lit(family))

    return reduce(DataFrame.unionByName, train.each_family(train.available(), of))


@query("ml8_random_search")
def ml8(spark, sf_dir):
    fit_on, _ = halves(spark, sf_dir)
    found = train.random_search(fit_on, INPUT, LABEL, "random_forest")
    return train.search_results(found, fit_on)


@query("ml8b_resampled_folds")
def ml8b(spark, sf_dir):
    """Rows of each class that each fold of a resampled search fits on and holds back."""
    fit_on, _ = halves(spark, sf_dir)
    out = None
    for fold, (fit, held) in enumerate(train.fold_tables(fit_on, INPUT, LABEL, 5, "incident_id", "smote")):
        for part, df in (("fit", fit), ("held", held.withColumn("is_synthetic", F.lit(False)))):
            n = df.groupBy(F.lit(fold).alias("fold"), F.lit(part).alias("part"), LABEL, "is_synthetic").agg(F.count("*").alias("n"))
            out = n if out is None else out.unionByName(n)
    return out


@query("ml8c_search_after_resampling")
def ml8c(spark, sf_dir):
    """Classes balanced inside each fold, then the random search, as one call."""
    fit_on, _ = halves(spark, sf_dir)
    return train.search_results(train.random_search(fit_on, INPUT, LABEL, "random_forest", resample="smote"), fit_on)


@query("ml9_grid_search")
def ml9(spark, sf_dir):
    fit_on, _ = halves(spark, sf_dir)
    found = train.grid_search(fit_on, INPUT, LABEL, "random_forest")
    return train.search_results(found, fit_on)


@query("ml9b_grid_checks")
def ml9b(spark, sf_dir):
    """The published grid: candidates, folds, rows each candidate is scored on, and whether accuracies
    lie between 0 and 1, a tree count or depth changes them, and the best one beats always saying no."""
    fit_on, _ = halves(spark, sf_dir)
    found = train.grid_search(fit_on, INPUT, LABEL, "random_forest")
    scores = found.avgMetrics
    names = [{p.name: v for p, v in m.items()} for m in found.points]
    by = {tuple(sorted((k, v) for k, v in n.items())): s for n, s in zip(names, scores)}
    plain = fit_on.agg(F.avg((F.col(LABEL) == 0).cast("double"))).first()[0]
    row = (len(by), min(map(len, found.foldMetrics)), min(found.rows), max(found.rows), all(0 <= s <= 1 for s in scores), len(set(scores)) > 1, max(scores) > plain)
    return spark.createDataFrame(
        [row], "n_points bigint, n_folds bigint, least_rows bigint, most_rows bigint, in_range boolean, differ boolean, beats_majority boolean"
    )


@query("ml10b_vote_models")
def ml10b(spark, sf_dir):
    fit_on, test = halves(spark, sf_dir)
    models = {
        "forest": train.train(fit_on, INPUT, LABEL, "random_forest"),
        "boosted": train.train(fit_on, INPUT, LABEL, "xgboost"),
    }
    voted = train.vote_models(models, train.vectors(test, INPUT), {"forest": 2.0, "boosted": 1.0})
    return evaluate.metrics(voted.withColumn("label", F.col(LABEL)))


@query("ml11_stacking")
def ml11(spark, sf_dir):
    fit_on, test = halves(spark, sf_dir)
    model = train.stack(fit_on, INPUT, LABEL, {"random_forest": {}, "xgboost": {}})
    return _metrics_of(model, test)


@query("ml11b_out_of_fold_scores")
def ml11b(spark, sf_dir):
    """Per fold: rows with out-of-fold scores of every base model, positive ones, scores between 0 and 1,
    and whether positive rows score higher on average by each model."""
    fit_on, _ = halves(spark, sf_dir)
    data = train.vectors(fit_on, INPUT).withColumn("fold", prep.fold_column("incident_id", 5))
    scored, _ = train.out_of_fold(data, LABEL, {"random_forest": {}, "xgboost": {}}, 5, "incident_id")
    bases = ["base_random_forest", "base_xgboost"]
    inside = F.lit(True)
    for c in bases:
        inside = inside & F.col(c).between(0, 1)
    y = F.col(LABEL) == 1
    apart = [F.avg(F.when(y, F.col(c))) > F.avg(F.when(~y, F.col(c))) for c in bases]
    return scored.groupBy(prep.fold_column("incident_id", 5).alias("fold")).agg(
        F.count("*").alias("n_rows"), F.sum(F.col(LABEL).cast("bigint")).alias("n_positive"), F.count_if(inside).alias("n_in_range"), (apart[0] & apart[1]).alias("separates")
    )


@query("ml12_reconstruction_anomaly")
def ml12(spark, sf_dir):
    table = model_split(spark, sf_dir)
    model = anomaly.fit_reconstruction(table, INPUT, LABEL)
    errors = files.materialised(
        model.transform(table).select("incident_id", LABEL, "recon_error"), "errors"
    )
    flagged = anomaly.flag_errors(errors, "recon_error", LABEL)
    return evaluate.class_report(
        flagged.select(F.col(LABEL).alias("label"), F.col("is_anomaly").alias("prediction"))
    )


@query("ml12b_error_threshold")
def ml12b(spark, sf_dir):
    given = (
        _event_features(spark, sf_dir)
        .select("incident_id", F.col("is_hourly_hot").alias("label"), F.col("category"))
        .join(
            spark.read.parquet(f"{sf_dir}/events.parquet").select(
                F.col("event_id").alias("incident_id"), F.col("value").alias("recon_error")
            ),
            "incident_id",
        )
    )
    flagged = anomaly.flag_errors(
        files.materialised(given.select("incident_id", "label", "recon_error"), "errors"),
        "recon_error",
        "label",
    )
    return rounded(flagged)


@query("ml13_encoded_features")
def ml13(spark, sf_dir):
    table = splits.split_stratified(model_split(spark, sf_dir).drop("split"), LABEL)
    model = anomaly.fit_reconstruction(table, INPUT, LABEL)
    encoded = files.materialised(
        model.transform(table).select("incident_id", LABEL, "split", F.col("encoded").alias("features")),
        "encoded",
    )
    fit_on = train.prepared(encoded.filter(F.col("split") == "train"), "xgboost", LABEL)
    test = encoded.filter(F.col("split") == "test")
    out = None
    for family in ("random_forest", "xgboost"):
        learner = train.estimator(family, LABEL).fit(fit_on)
        part = evaluate.metrics(train.scored(learner, test, LABEL)).withColumn("model", F.lit(family))
        out = part if out is None else out.unionByName(part)
    return out


@query("ml14_refit_on_top")
def ml14(spark, sf_dir):
    fit_on, test = halves(spark, sf_dir)
    first = train.train(fit_on, INPUT, LABEL, "random_forest")
    return _metrics_of(train.refit_on_top(fit_on, INPUT, LABEL, first), test)


def _forest(spark, sf_dir):
    fit_on, test = halves(spark, sf_dir)
    return train.train(fit_on, INPUT, LABEL, "random_forest"), test


@query("tk5_top_features")
def tk5(spark, sf_dir):
    model, test = _forest(spark, sf_dir)
    return train.top_features(train.importance_table(model, test, INPUT), 12)


@query("ev5_feature_importance")
def ev5(spark, sf_dir):
    model, test = _forest(spark, sf_dir)
    table = train.importance_table(model, test, INPUT)
    return train.importance_by_group(table, features.FEATURE_GROUPS)


@query("ev6_permutation_importance")
def ev6(spark, sf_dir):
    model, test = _forest(spark, sf_dir)
    return importance.permutation_importance(model, test, INPUT, LABEL)


class FixedRule:
    """A model that is written down instead of fitted, so that SQL can score with it."""

    def transform(self, df: DataFrame) -> DataFrame:
        x = vector_to_array("features")

        def of(name: str):
            return x[INPUT.index(name)]

        recent = (of("was_hourly_hotspot_last_hour") == 1) & (of("Hour_sin") > 0.1)
        seasonal = (of("was_daily_hotspot_yesterday") == 1) & (of("Month_sin") < -0.3)
        return df.withColumn("prediction", (recent | seasonal).cast("double"))


@query("ev6b_permutation_of_a_rule")
def ev6b(spark, sf_dir):
    """Permutation importance of a fixed rule on the test rows."""
    _, test = halves(spark, sf_dir)
    found = importance.permutation_importance(FixedRule(), test, INPUT, LABEL)
    return found.select(F.lower("feature").alias("feature"), (F.round("importance", 6) + 0.0).alias("importance"))


@query("ev5c_importance_from_nodes")
def ev5c(spark, sf_dir):
    """Importances summed from the forest's nodes against those of the model: inputs on which both
    agree, and leading inputs that both name."""
    model, test = _forest(spark, sf_dir)
    theirs = train.importance_table(model, test, INPUT).withColumnRenamed("importance", "theirs")
    ours = train.importances_from_nodes(model, test, INPUT)
    both = ours.join(theirs, "feature")
    top = train.top_features(ours, 12).join(train.top_features(theirs.withColumnRenamed("theirs", "importance"), 12).select("feature"), "feature")
    return both.agg(F.count_if(F.abs(F.col("importance") - F.col("theirs")) < 1e-9).alias("n_agree")).join(top.agg(F.count("*").alias("n_top")))


def _batch_scored(spark, sf_dir):
    model, test = _forest(spark, sf_dir)
    model_path = score.save(score.scoring_chain(model, INPUT), files.scratch_path(spark, "model"))
    plain = test.select(
        "incident_id", *[F.col(f"`{c}`").cast("double").alias(c) for c in INPUT]
    )
    schema = ", ".join(["incident_id bigint", *[f"`{c}` double" for c in INPUT]])
    out = None
    for fmt in ("json", "csv"):
        path = files.write_table(plain, files.scratch_path(spark, f"rows-{fmt}"), fmt)
        part = score.score_files(spark, model_path, path, fmt, schema, INPUT).select(
            "incident_id", F.lit(fmt).alias("format"), "prediction", "probability_0", "probability_1"
        )
        out = part if out is None else out.unionByName(part)
    return out


@query("ev11_batch_scoring")
def ev11(spark, sf_dir):
    return snake(_batch_scored(spark, sf_dir))


@query("ev11b_scoring_checks")
def ev11b(spark, sf_dir):
    """Per format: rows scored, rows whose probabilities sum to one, rows both formats agree on."""
    out = files.materialised(_batch_scored(spark, sf_dir), "scored")
    other = out.select("incident_id", F.when(F.col("format") == "json", "csv").otherwise("json").alias("format"), F.col("probability_1").alias("p"))
    sums = F.abs(F.col("probability_0") + F.col("probability_1") - 1) < 1e-9
    return out.join(other, ["incident_id", "format"]).groupBy("format").agg(
        F.count("*").alias("n_rows"), F.count_if(sums).alias("n_sums"), F.count_if(F.abs(F.col("p") - F.col("probability_1")) < 1e-9).alias("n_agree")
    )


@query("ml7b_family_checks")
def ml7b(spark, sf_dir):
    """Per family: test rows scored, positive ones, scores between 0 and 1, and whether positive rows
    score higher than the others on average."""
    fit_on, test = halves(spark, sf_dir)

    def of(family: str) -> DataFrame:
        result = train.scored(train.train(fit_on, INPUT, LABEL, family), train.vectors(test, INPUT), LABEL)
        result = files.materialised(result.select("label", "score"), "scores")  # else each mention scores anew
        return result.groupBy(F.lit(family).alias("model")).agg(
            F.count("*").alias("n_rows"), F.sum(F.col("label").cast("bigint")).alias("n_positive"), F.count_if((F.col("score") >= 0) & (F.col("score") <= 1)).alias("n_in_range"),
            (F.avg(F.when(F.col("label") == 1, F.col("score"))) > F.avg(F.when(F.col("label") == 0, F.col("score")))).alias("separates"),
        )

    return reduce(DataFrame.unionByName, train.each_family(train.available(), of))


@query("ev5b_importance_sums")
def ev5b(spark, sf_dir):
    """Importances sum to one over all inputs, each in its group."""
    model, test = _forest(spark, sf_dir)
    table = train.importance_by_group(train.importance_table(model, test, INPUT), features.FEATURE_GROUPS)
    counts = test.agg(F.count("*").alias("n_test"))
    return table.agg(
        F.count("*").alias("n_features"), F.round(F.sum("importance"), 6).alias("total"), F.min(F.col("importance") >= 0).alias("none_negative")
    ).join(F.broadcast(counts))
