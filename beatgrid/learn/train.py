"""Classifier families, training by name, tuning and ensembles on Spark ML."""

from __future__ import annotations

import random
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import cached_property
from itertools import product
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Model, PipelineModel
from pyspark.ml.classification import (
    GBTClassifier,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.feature import VectorSlicer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from beatgrid.learn import forest as by_tasks
from beatgrid.learn import nodes, singles
from beatgrid.learn.prep import assembler, fold_column, numeric
from beatgrid.learn.resample import smote, undersample
from beatgrid.sources.files import discard, materialised

SEED = 42

#: Deeper forests keep each row's node from level to level instead of walking there from the root.
NODE_ID_DEPTH = 10

#: Nodes of the trees that one fit of a search grows on the driver, and of all its fits side by side.
FIT_NODES, ALL_NODES = 250_000, 1_250_000
#: Up to so many rows a forest of more than ``FIT_NODES`` nodes is fitted by Spark in blocks, beyond it grows in tasks.
FEW_ROWS = 10_000

# Published baseline settings per family.
BASELINES: dict[str, dict] = {
    "random_forest": {"numTrees": 30, "maxDepth": 10, "minInstancesPerNode": 2},
    "xgboost": {"maxIter": 50, "maxDepth": 4, "stepSize": 0.1},
    "catboost": {"maxIter": 200, "maxDepth": 4, "stepSize": 0.05},
    "catboost_weighted": {"maxIter": 200, "maxDepth": 4, "stepSize": 0.05},
    "extra_trees": {"numTrees": 50, "maxDepth": 10, "minInstancesPerNode": 2},
    "balanced_random_forest": {"numTrees": 50, "maxDepth": 10, "minInstancesPerNode": 2},
}
# Weight of a positive row.
POSITIVE_WEIGHT = {"xgboost": 10.0, "catboost_weighted": 1.2}

# Ranges of the randomised search.
SEARCH_RANGES: dict[str, dict[str, list]] = {
    "random_forest": {
        "numTrees": [20, 30, 50],
        "maxDepth": [5, 10, 15],
        "minInstancesPerNode": [2, 4, 8],
        "featureSubsetStrategy": ["sqrt", "log2"],
    },
    "xgboost": {
        "maxIter": [30, 50],
        "maxDepth": [3, 4, 5],
        "stepSize": [0.05, 0.1],
        "subsamplingRate": [0.8],
        "featureSubsetStrategy": ["0.8"],
        "minInfoGain": [0.0, 1.0],
    },
}
# Grids of the exhaustive search. Depth 30 is the deepest tree Spark grows.
SEARCH_GRIDS: dict[str, dict[str, list]] = {
    "random_forest": {
        "numTrees": [100, 200],
        "maxDepth": [30, 10, 20],
        "minInstancesPerNode": [1, 2],
        "impurity": ["gini", "entropy"],
    },
    "xgboost": {
        "maxIter": [100, 200],
        "maxDepth": [3, 5, 7],
        "stepSize": [0.01, 0.1],
        "subsamplingRate": [0.8, 1.0],
        "featureSubsetStrategy": ["0.8", "all"],
        "minInfoGain": [0.0, 1.0],
    },
}


def _forest(params: Mapping, label: str) -> RandomForestClassifier:
    return RandomForestClassifier(
        labelCol=label, featuresCol="features", seed=SEED, **params
    )


def _boosted(params: Mapping, label: str) -> GBTClassifier:
    return GBTClassifier(labelCol=label, featuresCol="features", seed=SEED, **params)


FAMILIES: dict[str, Callable[[Mapping, str], Estimator]] = {
    "random_forest": _forest,
    "xgboost": lambda p, y: _boosted(p, y).setWeightCol("weight"),
    # these two are cut at the best round, see ``train_with_patience``
    "catboost": _boosted,
    "catboost_weighted": lambda p, y: _boosted(p, y).setWeightCol("weight"),
    # inside a search or a stack, where one fit serves all trees; ``train`` grows them one by one
    "extra_trees": lambda p, y: _forest(p, y).setBootstrap(False).setFeatureSubsetStrategy("sqrt"),
    "balanced_random_forest": _forest,
}
# Rounds without a better F1 after which boosting ends.
PATIENCE = {"catboost": 20, "catboost_weighted": 20}


def available() -> list[str]:
    return sorted(FAMILIES)


def estimator(family: str, label: str, overrides: Mapping | None = None) -> Estimator:
    if family not in FAMILIES:
        raise ValueError(f"unknown model type: {family}")
    return FAMILIES[family]({**BASELINES[family], **(overrides or {})}, label)


@dataclass
class BaggedModel:
    """Several models on the same vector; the score is the mean probability."""

    members: list[Model] = field(default_factory=list)

    def transform(self, df: DataFrame) -> DataFrame:
        names = []
        for i, member in enumerate(self.members):
            df = positive_score(member, df, f"_score_{i}")
            names.append(f"_score_{i}")
        total = F.col(names[0])
        for n in names[1:]:
            total = total + F.col(n)
        return (
            df.withColumn("score", total / len(names))
            .withColumn("prediction", (F.col("score") > 0.5).cast("double"))
            .drop(*names)
        )

    @property
    def featureImportances(self):  # same name as on Spark ML models
        return sum(m.featureImportances.toArray() for m in self.members) / len(self.members)


def positive_score(model, df: DataFrame, name: str = "score") -> DataFrame:
    """Add the probability of class 1 and drop the model's own columns."""
    out = model.transform(df)
    if "probability" in out.columns:
        out = out.withColumn(name, vector_to_array("probability")[1])
        return out.drop("probability", "rawPrediction", "prediction")
    return out.withColumnRenamed("score", name).drop("prediction")


def scored(model, df: DataFrame, label: str) -> DataFrame:
    """(everything, label, prediction, score) in the shape the evaluation works on."""
    out = model.transform(df)
    if "probability" in out.columns:
        out = out.withColumn("score", vector_to_array("probability")[1])
    return out.drop("probability", "rawPrediction").withColumns(
        {"label": F.col(label).cast("int"), "prediction": F.col("prediction").cast("int")}
    )


def vectors(df: DataFrame, features: Sequence[str]) -> DataFrame:
    return assembler(features).transform(numeric(df, features).na.fill(0.0, list(features)))


def prepared(df: DataFrame, family: str, label: str, ident: str = "incident_id") -> DataFrame:
    """Add what the family needs besides the vector: row weights, held-out rows."""
    weight = POSITIVE_WEIGHT.get(family, 1.0)
    return df.withColumns(
        {
            "weight": F.when(F.col(label) == 1, weight).otherwise(1.0),
            "held_out": fold_column(ident, 10, SEED + 7) == 0,
        }
    )


def train(
    train_df: DataFrame,
    features: Sequence[str],
    label: str,
    family: str,
    use_smote: bool = False,
    overrides: Mapping | None = None,
    ident: str = "incident_id",
    evaluation: DataFrame | None = None,
):
    """Fit one family by name on a table of plain feature columns.

    The two ``catboost`` families stop early (``train_with_patience``). ``extra_trees`` draws the cut
    points of every tree at random and ``balanced_random_forest`` a balanced sample for every tree.
    """
    learner = estimator(family, label, overrides)  # an unknown name fails before any work
    if family in PATIENCE:
        return train_with_patience(train_df, features, label, family, evaluation, PATIENCE[family], use_smote, overrides, ident).model
    if use_smote:
        train_df = smote(train_df, features, label, ident)
    data = prepared(vectors(train_df, features), family, label, ident)
    settings = {**BASELINES[family], **(overrides or {})}
    if family == "extra_trees":
        return singles.extra_trees(data, label, settings, SEED, _packed)
    if family == "balanced_random_forest":
        return singles.balanced_forest(data, label, settings, ident, SEED, _packed)
    return learner.fit(data)


def each_family(families: Sequence[str], work: Callable[[str], DataFrame]) -> list[DataFrame]:
    """What ``work`` gives for each family, in their order. A fit is a long row of small jobs, so all run side by side."""
    spark = SparkSession.getActiveSession()
    with ThreadPool(max(1, len(families))) as pool:
        return pool.map(inheritable_thread_target(spark)(work), families, chunksize=1)


@dataclass
class PatientFit:
    """A boosted model cut at its best round, with the F1 of every round on the evaluation rows."""

    model: Model
    scores: list[float]
    best: int
    stopped: int
    n_fit: int
    n_evaluation: int


def train_with_patience(
    train_df: DataFrame,
    features: Sequence[str],
    label: str,
    family: str = "catboost",
    evaluation: DataFrame | None = None,
    patience: int = 20,
    use_smote: bool = False,
    overrides: Mapping | None = None,
    ident: str = "incident_id",
) -> PatientFit:
    """Boosting that ends when ``patience`` rounds bring no better F1 on the evaluation rows, and keeps
    the rounds up to the best one.

    Without ``evaluation`` a tenth of the rows, chosen by id, is held out for it; synthetic rows are made
    from the others only. All rounds are fitted at once and scored in one pass, since Spark's boosting
    cannot go on from a model; rounds after the end do not change the result. Without any evaluation
    row all rounds stay.
    """
    learner = estimator(family, label, overrides)
    if evaluation is None:
        out = fold_column(ident, 10, SEED + 7) == 0
        train_df, evaluation = train_df.filter(~out), train_df.filter(out)
    if use_smote:
        train_df = smote(train_df, features, label, ident)
    data = materialised(prepared(vectors(train_df, features), family, label, ident).select("features", label, ident, "weight"), "boosted-rows")
    spark = data.sparkSession
    model = learner.fit(_packed(data))
    curve = nodes.boosting_curve(nodes.Trees.of(nodes.node_table(model, spark)), vectors(evaluation, features), label)
    curve = curve.filter(F.col("n") > 0).orderBy("round").collect()  # one row a round
    scores = [r["f1"] for r in curve]
    best, stopped = nodes.best_round(scores, patience) if scores else (len(model.treeWeights),) * 2
    cut = model if best == len(model.treeWeights) else nodes.first_rounds(model, best, spark)
    return PatientFit(cut, scores, best, stopped, data.count(), curve[0]["n"] if curve else 0)


def param_grid(learner: Estimator, values: Mapping[str, Sequence]) -> list[dict]:
    names = list(values)
    return [
        {learner.getParam(n): v for n, v in zip(names, combo)}
        for combo in product(*(values[n] for n in names))
    ]


#: Rows of one partition when a table is fitted to.
FIT_ROWS = 50_000


def fold_tables(
    train_df: DataFrame, features: Sequence[str], label: str, folds: int, ident: str, resample: str | None = None, parallelism: int = 8
) -> list[tuple[DataFrame, DataFrame]]:
    """(rows to fit on, held rows) of each fold as vectors, staged.

    ``resample`` balances the classes of each fold's fit rows, ``smote`` with synthetic rows and
    ``undersample`` by a draw from the larger class; held rows are always given ones. A row's fold
    hangs on its id alone. The folds are made side by side.
    """
    plain = numeric(train_df.select(ident, label, *[F.col(f"`{c}`") for c in features]), features)
    rows = materialised(plain.withColumn("fold", fold_column(ident, folds)), "folds")

    def made(fold: int) -> tuple[DataFrame, DataFrame]:
        fit, held = rows.filter(F.col("fold") != fold).drop("fold"), rows.filter(F.col("fold") == fold)
        fit = vectors(resampled(fit, features, label, ident, resample), features)
        keep = ["features", label, ident, *(["is_synthetic"] if "is_synthetic" in fit.columns else [])]
        fit = prepared(fit, "", label, ident).select(*keep, "weight", "held_out")
        return materialised(fit, "fold-fit"), materialised(vectors(held, features).select("features", label, ident), "fold-held")

    with ThreadPool(max(1, min(parallelism, folds))) as pool:
        return pool.map(inheritable_thread_target(train_df.sparkSession)(made), range(folds), chunksize=1)


def resampled(df: DataFrame, features: Sequence[str], label: str, ident: str, how: str | None) -> DataFrame:
    if how is None:
        return df
    if how == "smote":
        return smote(df, features, label, ident)
    if how == "undersample":
        return undersample(df, label, ident)
    raise ValueError(f"unknown resampling: {how}")


def _packed(df: DataFrame) -> DataFrame:
    """Small tables in few partitions: a fit makes a job a level, and its tasks should have work."""
    return df.coalesce(max(1, -(-df.count() // FIT_ROWS)))


@dataclass
class SearchResult:
    """The candidates of a search with their mean scores over the folds, and the best one refitted."""

    points: list[dict]
    foldMetrics: list[list[float]]
    #: Rows that each candidate was scored on, over all folds.
    rows: list[int]
    refit: Callable[[dict], Model]

    @property
    def avgMetrics(self) -> list[float]:
        return [sum(m) / len(m) if m else 0.0 for m in self.foldMetrics]

    @property
    def best(self) -> dict:
        """The first of the best candidates."""
        return self.points[max(range(len(self.points)), key=lambda i: (self.avgMetrics[i], -i))]

    @cached_property
    def bestModel(self) -> Model:
        return self.refit(self.best)

    def getEstimatorParamMaps(self) -> list[dict]:
        return self.points


def _fits(learner: Estimator, grid: list[dict]) -> list[tuple[dict, list[int]]]:
    """(parameters to fit with, candidates they answer).

    Candidates that differ in the number of trees or rounds are answered by the largest one's first
    trees, and those of a forest that differ in depth by its trees cut at that depth. A forest of one
    tree draws its features in another way and keeps a fit of its own.
    """
    forest = isinstance(learner, RandomForestClassifier)
    free = ("numTrees", "maxDepth") if forest else ("maxIter",)
    groups: dict[tuple, list[int]] = {}
    for i, point in enumerate(grid):
        values = {p.name: v for p, v in point.items()}
        fixed = sorted((k, str(v)) for k, v in values.items() if k not in free)
        groups.setdefault((forest and values.get("numTrees") == 1, *fixed), []).append(i)
    out = []
    for members in groups.values():
        params = dict(grid[members[0]])
        for param in list(params):
            if param.name in free:
                params[param] = max(grid[i][param] for i in members)
        out.append((params, members))
    return out


def tree_blocks(trees: int, nodes_a_tree: int) -> list[int]:
    """Trees of each fit of a forest, as even as can be, so that none grows more than ``FIT_NODES`` nodes or has one tree."""
    n = -(-trees // max(1, FIT_NODES // max(1, nodes_a_tree)))
    return [trees * (k + 1) // n - trees * k // n for k in range(n)]


def _search(
    train_df: DataFrame,
    learner: Estimator,
    grid: list[dict],
    features: Sequence[str],
    label: str,
    metric: str,
    folds: int,
    ident: str,
    parallelism: int,
    resample: str | None = None,
) -> SearchResult:
    """Cross-validated scores of all candidates, from as few fits as answer them (see ``_fits``).

    The fits of all folds run side by side, ``parallelism`` at a time. Folds without held rows give
    no score.

    Spark grows a forest on the driver. One whose trees would pass ``FIT_NODES`` (by a small forest fitted
    first, where that can't pass it too) is grown by tasks, see ``forest``; of ``FEW_ROWS`` rows at most,
    it is fitted in blocks of trees with a seed each, and the held rows keep the sums of the votes.
    """
    spark = train_df.sparkSession
    tables = fold_tables(train_df, features, label, folds, ident, resample, parallelism)
    forest = isinstance(learner, RandomForestClassifier)
    many, deep = ("numTrees", "maxDepth") if forest else ("maxIter", None)
    scores: list[list[float]] = [[] for _ in grid]
    rows = [0] * len(grid)

    def value(point: dict, params: dict, name: str):
        found = {p.name: v for p, v in {**params, **point}.items()}
        return found.get(name, learner.getOrDefault(name))

    def settled(params: dict) -> dict:
        settings = dict(params)
        if forest and value({}, params, "maxDepth") > NODE_ID_DEPTH:
            settings[learner.cacheNodeIds] = True
        return settings

    def nodes_of_a_tree(params: dict) -> int:
        few = {**settled(params), learner.numTrees: 2}
        if learner.getFeatureSubsetStrategy() == "auto":
            few.setdefault(learner.featureSubsetStrategy, "sqrt")
        return -(-learner.copy(few).fit(_packed(tables[0][0])).totalNumNodes // 2)

    def in_blocks(job: tuple[int, dict, list[int]], sizes: list[int], counts: list[int], depths: list[int]) -> DataFrame:
        fold, params, _ = job
        fit, held = tables[fold]
        depths = sorted(depths)
        ends, first, state = [0, *counts], 0, held
        for block, size in enumerate(sizes):
            settings = {**settled(params), learner.numTrees: size, learner.seed: SEED + 1_000_003 * block}
            if learner.getFeatureSubsetStrategy() == "auto":  # of a single tree, "auto" is another rule
                settings.setdefault(learner.featureSubsetStrategy, "sqrt")
            trees = nodes.Trees.of(nodes.node_table(learner.copy(settings).fit(_packed(fit)), spark))
            parts = [(min(max(a - first, 0), size), min(max(b - first, 0), size)) for a, b in zip(ends, ends[1:])]
            before, state = state, materialised(nodes.with_votes(trees, state, label, depths, parts), "votes")
            if block:
                discard(before)
            first += size
        return nodes.vote_counts(state, label, counts, depths)

    def in_tasks(job: tuple[int, dict, list[int]], counts: list[int], depths: list[int]) -> list:
        fold, params, _ = job
        rows = binned[fold, value({}, params, "maxBins")]
        named = ("numTrees", "maxDepth", "minInstancesPerNode", "minWeightFractionPerNode", "minInfoGain", "impurity", "featureSubsetStrategy", "bootstrap", "subsamplingRate")
        growth = by_tasks.Growth.of({name: value({}, params, name) for name in named}, len(features), rows.n_rows, SEED)
        trees = by_tasks.grow(spark, rows, growth)
        depths = sorted(depths)
        found = nodes.vote_counts(by_tasks.votes(trees, tables[fold][1], label, rows, counts, depths), label, counts, depths).collect()  # a row a candidate
        discard(trees)
        return found

    def run(job: tuple[int, dict, list[int]]) -> list[tuple[int, int, dict]]:
        fold, params, members = job
        fit, held = tables[fold]
        wanted = {i: (value(grid[i], params, many), value(grid[i], params, deep) if deep else None) for i in members}
        counts, depths = sorted({n for n, _ in wanted.values()}), sorted({d for _, d in wanted.values()}, key=str)
        sizes = blocks[members[0]]
        if not sizes:
            table = {(r["trees"], r["depth"]): r.asDict() for r in in_tasks(job, counts, depths)}
            return [(fold, i, table.get(at, {})) for i, at in wanted.items()]
        if len(sizes) > 1:
            table = {(r["trees"], r["depth"]): r.asDict() for r in in_blocks(job, sizes, counts, depths).collect()}
            return [(fold, i, table.get(at, {})) for i, at in wanted.items()]
        model = learner.copy(settled(params)).fit(_packed(fit))
        trees = nodes.Trees.of(nodes.node_table(model, spark))
        # boosting may end before its last round
        reached = {n: min(n, len(trees.roots)) for n in counts}
        found = nodes.cut_counts(trees, held, label, sorted(set(reached.values())), depths)
        table = {(r["trees"], r["depth"]): r.asDict() for r in found.collect()}
        return [(fold, i, table.get((reached[n], d), {})) for i, (n, d) in wanted.items()]

    fits = _fits(learner, grid)
    jobs = [(fold, params, members) for params, members in fits for fold in range(folds)]
    blocks, side_by_side = {members[0]: [0] for _, members in fits}, min(parallelism, len(jobs))
    binned: dict[tuple[int, int], by_tasks.Binned] = {}
    if forest:
        n_rows = tables[0][0].count()
        most = {members[0]: value({}, params, many) for params, members in fits}
        # no tree has more nodes than its depth allows, or than two for each row
        bound = {members[0]: min(2 ** (value({}, params, deep) + 1), 2 * n_rows) for params, members in fits}
        unsure = [(params, members[0]) for params, members in fits if n_rows and bound[members[0]] * most[members[0]] > FIT_NODES]
        tried = [(params, k) for params, k in unsure if n_rows <= FEW_ROWS or 2 * bound[k] <= FIT_NODES]
        if tried:
            with ThreadPool(min(parallelism, len(tried))) as pool:
                bound |= zip([k for _, k in tried], pool.map(inheritable_thread_target(spark)(nodes_of_a_tree), [p for p, _ in tried], chunksize=1))
        blocks = {k: tree_blocks(n, bound[k]) for k, n in most.items()}
        if n_rows > FEW_ROWS and not learner.isDefined(learner.weightCol):
            large = [(params, k) for params, k in unsure if bound[k] * most[k] > FIT_NODES]
            blocks |= {k: [] for _, k in large}
            wanted_bins = [(fold, bins) for bins in sorted({value({}, params, "maxBins") for params, _ in large}) for fold in range(folds)]
            with ThreadPool(max(1, min(parallelism, len(wanted_bins)))) as pool:
                made = pool.map(inheritable_thread_target(spark)(lambda at: by_tasks.binned(tables[at[0]][0], label, len(features), at[1], SEED)), wanted_bins, chunksize=1)
            binned |= zip(wanted_bins, made)
        largest = max(max(sizes, default=0) * bound[k] for k, sizes in blocks.items())
        side_by_side = max(1, min(side_by_side, ALL_NODES // max(1, largest)))
    with ThreadPool(side_by_side) as pool:
        done = [r for part in pool.imap_unordered(inheritable_thread_target(spark)(run), jobs) for r in part]
    discard(*[rows.blocks for rows in binned.values()])
    for _, i, r in sorted(done, key=lambda x: x[:2]):
        if r:
            whole = 2 * r["tp"] + r["fp"] + r["fn"]
            scores[i].append(r["n_right"] / r["n"] if metric == "accuracy" else 2 * r["tp"] / whole if whole else 0.0)
            rows[i] += r["n"]

    def refit(point: dict) -> Model:
        data = vectors(resampled(train_df, features, label, ident, resample), features)
        return learner.copy(point).fit(prepared(data, "", label, ident))

    return SearchResult(grid, scores, rows, refit)


def random_search(
    train_df: DataFrame,
    features: Sequence[str],
    label: str,
    family: str,
    draws: int = 20,
    folds: int = 5,
    ranges: Mapping[str, Sequence] | None = None,
    ident: str = "incident_id",
    parallelism: int = 8,
    resample: str | None = None,
) -> SearchResult:
    """Cross-validated F1 over random draws without repetition from the published ranges.

    With ``resample`` the classes are balanced first, inside each fold, and for the best model's refit.
    """
    if ranges is None:
        if family not in SEARCH_RANGES:
            raise ValueError(f"no search ranges for model type: {family}")
        ranges = SEARCH_RANGES[family]
    learner = FAMILIES[family]({}, label)
    everything = param_grid(learner, ranges)
    grid = random.Random(SEED).sample(everything, min(draws, len(everything)))
    return _search(train_df, learner, grid, features, label, "f1", folds, ident, parallelism, resample)


def grid_search(
    train_df: DataFrame,
    features: Sequence[str],
    label: str,
    family: str,
    folds: int = 5,
    grid: Mapping[str, Sequence] | None = None,
    ident: str = "incident_id",
    parallelism: int = 8,
    resample: str | None = None,
) -> SearchResult:
    """Cross-validated search of a whole grid: forests by accuracy, boosted trees by F1."""
    learner = FAMILIES[family]({}, label)
    values = SEARCH_GRIDS[family] if grid is None else grid
    metric = "accuracy" if family == "random_forest" else "f1"
    return _search(train_df, learner, param_grid(learner, values), features, label, metric, folds, ident, parallelism, resample)


def search_results(model: SearchResult, df: DataFrame) -> DataFrame:
    """One row per parameter set with its mean score; one row per candidate, so it is small."""
    rows = [
        (
            ", ".join(f"{p.name}={v}" for p, v in sorted(m.items(), key=lambda x: x[0].name)),
            float(score),
        )
        for m, score in zip(model.getEstimatorParamMaps(), model.avgMetrics)
    ]
    return df.sparkSession.createDataFrame(rows, "params string, score double").orderBy(
        F.desc("score"), "params"
    )


def importance_table(model, df: DataFrame, features: Sequence[str]) -> DataFrame:
    """(feature, importance) of a fitted tree model; one row per feature."""
    values = model.featureImportances
    values = values.toArray() if hasattr(values, "toArray") else values
    rows = [(f, float(v)) for f, v in zip(features, values)]
    return df.sparkSession.createDataFrame(rows, "feature string, importance double")


def importances_from_nodes(model, df: DataFrame, features: Sequence[str]) -> DataFrame:
    """(feature, importance) of a fitted tree model, summed from its table of nodes."""
    found = nodes.importances(nodes.node_table(model, df.sparkSession), len(features))
    names = F.array(*[F.lit(f) for f in features])
    return found.select(F.get(names, F.col("feature")).alias("feature"), "importance")


def importance_by_group(
    importances: DataFrame, groups: Mapping[str, Sequence[str]]
) -> DataFrame:
    """Importance of each feature with its group and the group's sum."""
    spark = importances.sparkSession
    members = spark.createDataFrame(
        [(f, g) for g, fs in groups.items() for f in fs], "feature string, feature_group string"
    )
    joined = importances.join(F.broadcast(members), "feature", "left")
    sums = joined.groupBy("feature_group").agg(F.sum("importance").alias("group_importance"))
    return joined.join(sums, "feature_group", "left")


def top_features(importances: DataFrame, n: int) -> DataFrame:
    return importances.orderBy(F.desc("importance"), "feature").limit(n)


def refit_on_top(
    train_df: DataFrame,
    features: Sequence[str],
    label: str,
    model,
    family: str = "random_forest",
    n: int = 12,
    overrides: Mapping | None = None,
    ident: str = "incident_id",
) -> PipelineModel:
    """Refit on the n most important features; scores the full vector by slicing it."""
    best = [r["feature"] for r in top_features(importance_table(model, train_df, features), n).collect()]
    slicer = VectorSlicer(
        inputCol="features", outputCol="top_features", indices=[list(features).index(f) for f in best]
    )
    learner = estimator(family, label, overrides).setFeaturesCol("top_features")
    data = prepared(vectors(train_df, features), family, label, ident)
    return PipelineModel([slicer, learner.fit(slicer.transform(data))])


@dataclass
class VotingModel:
    """Several models on the same vector with a weight each; see ``evaluate.vote``."""

    members: dict[str, object]
    weights: dict[str, float]
    voting: str = "soft"

    def transform(self, df: DataFrame) -> DataFrame:
        out = vote_models(self.members, df, self.weights, self.voting)
        return out.drop(*[f"vote_{n}" for n in self.members]).withColumn(
            "prediction", F.col("prediction").cast("double")
        )


@dataclass
class StackedModel:
    """Base models whose scores feed a logistic regression."""

    bases: dict[str, object]
    meta: Model

    def transform(self, df: DataFrame) -> DataFrame:
        for name, base in self.bases.items():
            df = positive_score(base, df, f"base_{name}")
        names = [f"base_{n}" for n in self.bases]
        return self.meta.transform(assembler(names, "base_scores").transform(df))


def out_of_fold(
    data: DataFrame, label: str, families: Mapping[str, Mapping], folds: int, ident: str, parallelism: int = 8
) -> tuple[DataFrame, dict[str, Model]]:
    """((ident, label, base_<family>...), base models): every row's scores by models fitted without its
    fold, staged, and each family fitted to all rows.

    ``data`` has vectors and ``fold``. All fits are independent and run side by side. A row without
    exactly one score of each family is an error; so are repeated ids.
    """
    spark = data.sparkSession
    data = materialised(data.select(ident, label, "features", "fold"), "stack-rows")

    def fit(job: tuple[str, int | None]) -> Model:
        name, fold = job
        rest = data if fold is None else data.filter(F.col("fold") != fold)
        return estimator(name, label, families[name]).fit(_packed(prepared(rest, name, label, ident)))

    jobs = [(name, fold) for fold in [*range(folds), None] for name in families]
    with ThreadPool(min(parallelism, len(jobs))) as pool:
        models = dict(zip(jobs, pool.map(inheritable_thread_target(spark)(fit), jobs, chunksize=1)))
    parts = [
        positive_score(models[name, fold], data.filter(F.col("fold") == fold), "score").select(ident, label, F.lit(name).alias("family"), "score")
        for name, fold in jobs
        if fold is not None
    ]
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    columns = [F.max(F.when(F.col("family") == n, F.col("score"))).alias(f"base_{n}") for n in families]
    scored = materialised(every.groupBy(ident, label).agg(F.count("score").alias("n"), *columns), "out-of-fold")
    n_rows = data.count()
    found = scored.agg(F.count("*"), F.coalesce(F.min("n"), F.lit(0)), F.coalesce(F.max("n"), F.lit(0))).first()
    if tuple(found) != (n_rows, len(families), len(families)):
        raise ValueError(f"{n_rows} rows have {found[0]} rows of {found[1]} to {found[2]} scores, not one by each of {len(families)} families")
    return scored.drop("n"), {name: models[name, None] for name in families}


def stack(
    train_df: DataFrame,
    features: Sequence[str],
    label: str,
    families: Mapping[str, Mapping],
    folds: int = 5,
    ident: str = "incident_id",
) -> StackedModel:
    """Stacking: out-of-fold scores of every base train the meta learner, bases refit on all."""
    data = vectors(train_df, features).withColumn("fold", fold_column(ident, folds))
    scored, bases = out_of_fold(data, label, families, folds, ident)
    meta = LogisticRegression(labelCol=label, featuresCol="base_scores")
    return StackedModel(bases, meta.fit(assembler([f"base_{n}" for n in families], "base_scores").transform(scored)))


def vote_models(
    models: Mapping[str, object], df: DataFrame, weights: Mapping[str, float], voting: str = "soft"
) -> DataFrame:
    """Score with every model, then vote."""
    from beatgrid.learn.evaluate import vote

    for name, model in models.items():
        df = positive_score(model, df, f"vote_{name}")
    return vote(df, {f"vote_{n}": w for n, w in weights.items()}, voting)
