"""Anomaly flag from the reconstruction error of a low-dimensional projection."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import PCA, StandardScaler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beatgrid.learn.prep import numeric, scaling_stages
from beatgrid.operators.ordered import quantiles


@dataclass
class Reconstruction:
    """Imputation and scaling from all rows, projection from the normal rows."""

    scaling: PipelineModel
    projection: PipelineModel
    features: list[str]

    def transform(self, df: DataFrame) -> DataFrame:
        """Add ``encoded`` (the projection) and ``recon_error`` (mean squared error)."""
        out = self.projection.transform(self.scaling.transform(numeric(df, self.features)))

        def squares(vector: str):
            return F.aggregate(
                vector_to_array(vector), F.lit(0.0), lambda acc, x: acc + x * x
            )

        # the axes are orthonormal: what the projection does not hold is the error
        lost = squares("centered") - squares("encoded")
        error = F.greatest(lost, F.lit(0.0)) / len(self.features)
        return out.withColumn("recon_error", error).drop("raw_vector", "scaled", "centered")


def fit_reconstruction(
    df: DataFrame, features: Sequence[str], label: str, k: int = 16
) -> Reconstruction:
    """Fit on rows without a hotspot; k is at most half of the features, so it compresses."""
    data = numeric(df, features)
    scaling = Pipeline(stages=scaling_stages(features)).fit(data)
    normal = scaling.transform(data).filter(F.col(label) == 0)
    k = max(1, min(k, len(features) // 2))
    projection = Pipeline(
        stages=[
            StandardScaler(withMean=True, withStd=False, inputCol="scaled", outputCol="centered"),
            PCA(k=k, inputCol="centered", outputCol="encoded"),
        ]
    ).fit(normal)
    return Reconstruction(scaling, projection, list(features))


def flag_errors(
    df: DataFrame, error: str, label: str, percentile: float = 0.8, name: str = "is_anomaly"
) -> DataFrame:
    """1 where the error lies above the given quantile of the normal rows."""
    cut = quantiles(df.filter(F.col(label) == 0), error, {"cut": percentile}).scalar()
    return df.withColumn(name, F.coalesce((F.col(error) > cut).cast("int"), F.lit(0)))
