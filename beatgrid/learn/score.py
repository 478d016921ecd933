"""Saving, loading and batch scoring of single models and ensembles."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.util import DefaultParamsReader
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from beatgrid.learn.nodes import Trees
from beatgrid.learn.prep import assembler, numeric
from beatgrid.learn.singles import NodeModel
from beatgrid.learn.train import BaggedModel, StackedModel, VotingModel
from beatgrid.sources.files import read_table, write_table


@dataclass
class ScoringChain:
    """A model and the columns it is fed with, as one object that can be written and read."""

    model: object
    features: list[str]

    def transform(self, rows: DataFrame) -> DataFrame:
        return self.model.transform(assembler(self.features).transform(rows))


def scoring_chain(model, features: Sequence[str]) -> ScoringChain:
    return ScoringChain(model, list(features))


def _describe(spark: SparkSession, path: str, **what) -> None:
    spark.createDataFrame([(json.dumps(what),)], "value string").write.mode("overwrite").text(f"{path}/about")


def _described(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(f"{path}/about").first()[0])


def _write(spark: SparkSession, model, path: str) -> None:
    """A folder with a description and the parts an ensemble is made of."""
    if isinstance(model, BaggedModel):
        parts = {str(i): m for i, m in enumerate(model.members)}
        _describe(spark, path, kind="bagged", parts=list(parts))
    elif isinstance(model, VotingModel):
        parts = model.members
        _describe(spark, path, kind="voting", parts=list(parts), weights=model.weights, voting=model.voting)
    elif isinstance(model, NodeModel):
        parts = {}
        _describe(spark, path, kind="nodes", importances=list(model.featureImportances))
        write_table(spark.createDataFrame(model.trees.table()), f"{path}/nodes")
    elif isinstance(model, StackedModel):
        parts = {**model.bases, "meta learner": model.meta}
        _describe(spark, path, kind="stacked", parts=list(model.bases))
    else:
        parts = {}
        _describe(spark, path, kind="single")
        model.write().overwrite().save(f"{path}/model")
    for name, part in parts.items():
        _write(spark, part, f"{path}/{name.replace(' ', '-')}")


def _read(spark: SparkSession, path: str):
    about = _described(spark, path)
    part = lambda name: _read(spark, f"{path}/{name.replace(' ', '-')}")
    if about["kind"] == "single":
        return DefaultParamsReader.loadParamsInstance(f"{path}/model", spark)
    if about["kind"] == "nodes":
        return NodeModel(Trees.of(read_table(spark, f"{path}/nodes")), np.array(about["importances"]))
    parts = {name: part(name) for name in about["parts"]}
    if about["kind"] == "bagged":
        return BaggedModel(list(parts.values()))
    if about["kind"] == "voting":
        return VotingModel(parts, about["weights"], about["voting"])
    return StackedModel(parts, part("meta learner"))


def save(chain: ScoringChain, path: str, spark: SparkSession | None = None) -> str:
    """Write a chain: any trained family, a pipeline, bagged, voting and stacked models."""
    spark = spark or SparkSession.getActiveSession()
    _describe(spark, path, features=chain.features)
    _write(spark, chain.model, f"{path}/chain")
    return path


def load(path: str, spark: SparkSession | None = None) -> ScoringChain:
    spark = spark or SparkSession.getActiveSession()
    return ScoringChain(_read(spark, f"{path}/chain"), _described(spark, path)["features"])


def score(chain: ScoringChain | PipelineModel, rows: DataFrame, features: Sequence[str]) -> DataFrame:
    """Class and both probabilities for every row. An ensemble's probability is its score."""
    ready = numeric(rows, features).na.fill(0.0, list(features))
    out = chain.transform(ready)
    if "probability" in out.columns:
        p = vector_to_array("probability")
        zero, one = p[0], p[1]
    else:
        zero, one = 1 - F.col("score"), F.col("score")
    return out.withColumns(
        {"prediction": F.col("prediction").cast("int"), "probability_0": zero, "probability_1": one}
    ).select(*rows.columns, "prediction", "probability_0", "probability_1")


def score_files(
    spark: SparkSession, model_path: str, path: str, fmt: str, schema: str, features: Sequence[str]
) -> DataFrame:
    """Score JSON or CSV rows with a stored model."""
    return score(load(model_path, spark), read_table(spark, path, fmt, schema), features)
