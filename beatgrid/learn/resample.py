"""Class balancing: synthetic minority rows and majority undersampling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beatgrid.functions.draws import draw, uniform
from beatgrid.learn.neighbours import nearest
from beatgrid.operators.ordered import rank_cut


def class_sizes(df: DataFrame, label: str) -> dict[int, int]:
    return {r[label]: r["n"] for r in df.groupBy(label).agg(F.count("*").alias("n")).collect()}


def smote(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    ident: str = "incident_id",
    k: int = 5,
    seed: int = 42,
) -> DataFrame:
    """Add synthetic rows of the smaller class until both classes are equally large.

    A synthetic row lies at a random place between a minority row and one of its k nearest
    minority rows. Every minority row gets the same number of them, the rest of the division
    goes to the rows with the lowest hashes. Returns (ident, is_synthetic, features, label).
    """
    sizes = class_sizes(df, label)
    small = min(sizes, key=lambda c: (sizes[c], c))
    n_small, n_new = sizes[small], max(sizes.values()) - sizes[small]
    base = df.select(ident, F.lit(False).alias("is_synthetic"), *[F.col(f"`{c}`").cast("double").alias(c) for c in features], label)
    if len(sizes) < 2 or n_new == 0:
        return base
    minority = (
        df.filter(F.col(label) == small)
        .select(ident, F.array(*[F.col(f"`{c}`").cast("double") for c in features]).alias("point"))
        .withColumn("draw", draw(F.col(ident), seed))
    )
    each, rest = divmod(n_new, n_small)
    copies = F.lit(each)
    if rest:
        target = df.sparkSession.range(1).select(F.lit(rest).cast("bigint").alias("rank"))
        cut = rank_cut(minority.select("draw"), "draw", target).first()["cut_id"]
        copies = copies + F.when(F.col("draw") <= cut, 1).otherwise(0)
    distinct = minority.groupBy("point").agg(
        F.min(ident).alias("vid"), F.count("*").alias("n")
    )
    neighbours = nearest(distinct, k, seed=seed).select("point", "neighbours")
    seeds = (
        minority.withColumn("copies", copies.cast("int"))
        .filter(F.col("copies") > 0)
        .join(neighbours, "point")
        .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
        .withColumn(
            "pick",
            F.floor(
                uniform(F.col(ident), F.col("copy"), seed) * F.size("neighbours")
            ).cast("int"),
        )
        .withColumn("u", uniform(F.col(ident), F.col("copy"), seed + 1))
        .withColumn("other", F.coalesce(F.get("neighbours", F.col("pick")), F.col("point")))
    )
    moved = F.zip_with("point", "other", lambda a, b: a + F.col("u") * (b - a))
    synthetic = seeds.withColumn("moved", moved).select(
        ident,
        F.lit(True).alias("is_synthetic"),
        *[F.col("moved")[i].alias(c) for i, c in enumerate(features)],
        F.lit(small).cast(dict(df.dtypes)[label]).alias(label),
    )
    return base.unionByName(synthetic)


def undersample(
    df: DataFrame, label: str, ident: str = "incident_id", bag: int = 0, seed: int = 42
) -> DataFrame:
    """All rows of the smaller class and about as many of the larger one, drawn by hash."""
    sizes = class_sizes(df, label)
    small = min(sizes, key=lambda c: (sizes[c], c))
    keep = sizes[small] / max(sizes.values())
    drawn = uniform(F.col(ident), seed, bag) < keep
    return df.filter((F.col(label) == small) | drawn)
