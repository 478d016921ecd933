"""From a model table to the vector columns Spark ML works on."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline
from pyspark.ml.feature import Imputer, MinMaxScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beatgrid.functions.draws import fold


def numeric(df: DataFrame, features: Sequence[str]) -> DataFrame:
    return df.withColumns({c: F.col(f"`{c}`").cast("double") for c in features})


def assembler(features: Sequence[str], output: str = "features") -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol=output)


def mean_imputer(features: Sequence[str], suffix: str = "") -> Imputer:
    return Imputer(
        strategy="mean", inputCols=list(features), outputCols=[f"{c}{suffix}" for c in features]
    )


def scaling_stages(features: Sequence[str], output: str = "scaled") -> list:
    """Mean imputation, assembly, scaling to 0..1."""
    return [
        mean_imputer(features),
        assembler(features, "raw_vector"),
        MinMaxScaler(inputCol="raw_vector", outputCol=output),
    ]


def min_max_scaled(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """The features as scaled plain columns."""
    data = numeric(df, features)
    model = Pipeline(stages=scaling_stages(features)).fit(data)
    out = model.transform(data).withColumn("scaled", vector_to_array("scaled"))
    return out.withColumns({c: F.col("scaled")[i] for i, c in enumerate(features)}).drop(
        "scaled", "raw_vector"
    )


def fold_column(ident: str, folds: int, seed: int = 42):
    """Fold number of a row by its id, equal in every run."""
    return fold(F.col(ident), folds, seed)
