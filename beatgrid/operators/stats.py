"""Two-sample, independence, normality and correlation statistics as aggregates."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.stat import Correlation
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from beatgrid.functions.numeric import chi2_upper_tail, normal_upper_tail
from beatgrid.operators.ordered import bucket_edges, cumulative
from beatgrid.sources.files import materialised


def rank_sum(df: DataFrame, value: str, in_first: Column) -> DataFrame:
    """One row: sizes, rank sum of the first sample (ties averaged) and the tie term.

    Values are counted per sample first; ranks come from the cumulative counts.
    """
    rows = df.select(F.col(value).cast("double").alias("v"), in_first.alias("a")).filter(
        F.col("v").isNotNull() & ~F.isnan("v") & F.col("a").isNotNull()
    )
    counted = (
        rows.groupBy("v")
        .agg(
            F.sum(F.col("a").cast("bigint")).alias("n_a"),
            F.count("*").alias("n"),
        )
    )
    counted = materialised(counted, "counted")
    ranked = cumulative(counted, "v", "n", bucket_edges(counted, ["v"])["v"])
    n = F.col("n").cast("double")
    return ranked.agg(
        F.sum("n_a").alias("n1"),
        F.sum(F.col("n") - F.col("n_a")).alias("n2"),
        F.sum(F.col("n_a") * (F.col("below") + (n + 1) / 2)).alias("rank_sum"),
        F.sum(n * n * n - n).alias("tie_term"),
    )


def mann_whitney(df: DataFrame, value: str, in_first: Column, alpha: float = 0.05) -> DataFrame:
    """Two-sided Mann-Whitney U with tie and continuity correction (normal approximation)."""
    n1, n2 = F.col("n1").cast("double"), F.col("n2").cast("double")
    n = n1 + n2
    u1 = F.col("rank_sum") - n1 * (n1 + 1) / 2
    sigma = F.sqrt(n1 * n2 / 12 * ((n + 1) - F.coalesce(F.try_divide(F.col("tie_term"), n * (n - 1)), F.lit(0.0))))
    larger = F.greatest(F.col("u_stat"), n1 * n2 - F.col("u_stat"))
    z = F.try_divide(larger - n1 * n2 / 2 - 0.5, F.col("sigma"))
    return (
        rank_sum(df, value, in_first)
        .withColumns({"u_stat": u1, "sigma": sigma})
        .withColumn("z", z)
        .withColumn(
            "p_value",
            F.least(
                F.lit(1.0),
                F.when(F.col("z") >= 0, 2 * normal_upper_tail(F.abs("z"))).otherwise(
                    2 * (1 - normal_upper_tail(F.abs("z")))
                ),
            ),
        )
        .select(
            "n1", "n2", "u_stat", "z", "p_value", (F.col("p_value") < alpha).alias("significant")
        )
    )


def chi_square(df: DataFrame, row: str, col: str, alpha: float = 0.05) -> DataFrame:
    """Independence test on the cross-tab of two columns; Yates correction for a 2 x 2 table.

    Works on the long cross-tab: empty cells need no row because the statistic equals
    sum(observed^2 / expected) - n. Marginals are windows over that small table.
    """
    cells = (
        df.filter(F.col(row).isNotNull() & F.col(col).isNotNull())
        .groupBy(F.col(row).alias("r"), F.col(col).alias("c"))
        .agg(F.count("*").cast("double").alias("o"))
        .withColumn("row_total", F.sum("o").over(Window.partitionBy("r")))
        .withColumn("col_total", F.sum("o").over(Window.partitionBy("c")))
    )
    # the grand total is one number; joining it avoids a window over everything
    total = cells.agg(F.sum("o").alias("n"))
    expected = F.col("row_total") * F.col("col_total") / F.col("n")
    sums = (
        cells.join(F.broadcast(total))
        .withColumn("e", expected)
        .agg(
            F.max("n").alias("n"),
            (F.count_distinct("r") - 1).alias("dof_r"),
            (F.count_distinct("c") - 1).alias("dof_c"),
            F.sum(F.col("o") * F.col("o") / F.col("e")).alias("ratio_sum"),
            F.max(F.abs(F.col("o") - F.col("e"))).alias("gap"),
            F.min("row_total").alias("r_min"),
            F.min("col_total").alias("c_min"),
        )
    )
    n, gap = F.col("n"), F.col("gap")
    # 2 x 2: all four cells miss their expectation by the same gap
    inverse_e = (
        n
        * (1 / F.col("r_min") + 1 / (n - F.col("r_min")))
        * (1 / F.col("c_min") + 1 / (n - F.col("c_min")))
    )
    corrected = F.pow(gap - F.least(gap, F.lit(0.5)), F.lit(2.0)) * inverse_e
    dof = F.col("dof_r") * F.col("dof_c")
    return (
        sums.withColumn("dof", dof)
        .withColumn(
            "chi2", F.when(F.col("dof") == 1, corrected).otherwise(F.col("ratio_sum") - n)
        )
        .withColumn("p_value", F.when(F.col("dof") > 0, chi2_upper_tail(F.col("chi2"), F.col("dof"))).otherwise(1.0))
        .select(
            F.col("n").cast("bigint").alias("n"),
            "chi2",
            "dof",
            "p_value",
            (F.col("p_value") < alpha).alias("significant"),
        )
    )


def jarque_bera(df: DataFrame, value: str, by: str) -> DataFrame:
    """Normality per group from skewness and kurtosis; chi-square with two degrees."""
    stats = (
        df.filter(F.col(value).isNotNull() & F.col(by).isNotNull())
        .groupBy(by)
        .agg(
            F.count("*").alias("n"),
            F.skewness(value).alias("skewness"),
            F.kurtosis(value).alias("excess_kurtosis"),
        )
    )
    s, k = F.col("skewness"), F.col("excess_kurtosis")
    return stats.withColumn("jb", F.col("n") / 6 * (s * s + k * k / 4)).withColumn(
        "p_value", F.exp(-F.col("jb") / 2)
    )


def correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of all column pairs over rows without NULL, long form.

    Spark ML sums the cross products on the executors; only the matrix of columns x columns
    comes back. A constant column has no correlation (NULL).
    """
    complete = df.select(*[F.col(c).cast("double").alias(c) for c in columns]).na.drop()
    vectors = VectorAssembler(inputCols=list(columns), outputCol="v").transform(complete)
    matrix = Correlation.corr(vectors, "v").head()[0].toArray()
    rows = [
        (a, b, None if math.isnan(matrix[i, j]) else float(matrix[i, j]))
        for i, a in enumerate(columns)
        for j, b in enumerate(columns)
        if i <= j
    ]
    return df.sparkSession.createDataFrame(rows, "feature_a string, feature_b string, r double")


def drop_correlated(df: DataFrame, listed: Sequence[str]) -> DataFrame:
    return df.drop(*listed)


def correlated_above(corr: DataFrame, threshold: float) -> DataFrame:
    """Pairs of different features whose correlation is at least the threshold in size."""
    return corr.filter(
        (F.col("feature_a") != F.col("feature_b")) & (F.abs("r") >= threshold)
    )
