"""Train / test splits with exact sizes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from beatgrid.functions.draws import draw
from beatgrid.operators.ordered import rank_cut
from beatgrid.sources.files import materialised

TRAIN, TEST = "train", "test"


def _boundary(df: DataFrame, order: str, ratio: float, by: Sequence[str]) -> DataFrame:
    """(by..., cut_ts, rank): the hour in which the cut falls and how many of its rows are train.

    ``order`` is an hour key, so a group has at most 8,784 rows per year after counting. Rows
    without an hour come last, as one more hour; then ``cut_ts`` is NULL.
    """
    by = list(by)
    upto = Window.partitionBy(*by).orderBy(F.asc_nulls_last(order))
    whole = Window.partitionBy(*by)
    counted = (
        df.groupBy(*by, order)
        .agg(F.count("*").alias("n"))
        .withColumn("total", F.sum("n").over(whole))
        .withColumn("upto", F.sum("n").over(upto))
        .withColumn("k", F.floor(F.col("total") * F.lit(float(ratio))))
    )
    return counted.filter(
        (F.col("upto") >= F.col("k")) & (F.col("upto") - F.col("n") < F.col("k"))
    ).select(*by, F.col(order).alias("cut_ts"), (F.col("k") - F.col("upto") + F.col("n")).alias("rank"))


def _before(order: Column, cut: Column) -> Column:
    """Whether an hour lies before the cut hour; every hour lies before a missing one."""
    return F.coalesce(order < cut, order.isNotNull() & cut.isNull())


def _check_cut(rows: DataFrame, ident: str, by: Sequence[str], targets: DataFrame, ids: DataFrame) -> None:
    """Fail if ids repeat at a cut, where no exact split by id exists."""
    by = list(by)
    taken = rows.join(ids, by) if by else rows.join(F.broadcast(ids))
    taken = taken.filter(F.col(ident) <= F.col("cut_id")).groupBy(*by).agg(F.count("*").alias("taken"))
    wrong = (taken.join(targets, by) if by else taken.join(F.broadcast(targets))).filter("taken <> rank")
    if wrong.limit(1).count():
        raise ValueError(f"column {ident} repeats within an hour, so the rows there have no order to split by")


def split_by_time(
    df: DataFrame,
    order: str = "hour_ts",
    ident: str = "incident_id",
    ratio: float = 0.8,
    labels: tuple[str, str] = (TRAIN, TEST),
) -> DataFrame:
    """First floor(n * ratio) rows in time order are train; rows of the cut hour go by id.

    Rows without an hour are the last ones. The cut is found as two scalars, so the split itself
    is a projection whose filters reach the scan. The cut hour travels as text: a Python datetime
    would be read in the driver's time zone. Ids that repeat at the cut are an error.
    """
    first, second = labels
    kind = df.schema[order].dataType
    edge = _boundary(df, order, ratio, ()).select(F.col("cut_ts").cast("string"), "rank").first()
    if edge is None:
        return df.withColumn("split", F.lit(second))
    spark = df.sparkSession
    cut = F.lit(edge["cut_ts"]).cast(kind)
    at_edge = F.col(order).isNull() if edge["cut_ts"] is None else F.col(order) == cut
    target = spark.range(1).select(F.lit(edge["rank"]).cast("bigint").alias("rank"))
    rows = df.filter(at_edge).select(ident)
    found = rank_cut(rows, ident, target)
    _check_cut(rows, ident, (), target, found)
    is_first = _before(F.col(order), cut) | (at_edge & (F.col(ident) <= F.lit(found.first()["cut_id"])))
    return df.withColumn("split", F.when(F.coalesce(is_first, F.lit(False)), first).otherwise(second))


def split_by_group(
    df: DataFrame,
    by: str = "area",
    order: str = "hour_ts",
    ident: str = "incident_id",
    ratio: float = 0.8,
) -> DataFrame:
    """The same per group: each group's first floor(n * ratio) rows are train.

    Rows with a NULL group belong to no group and drop out.
    """
    grouped = df.filter(F.col(by).isNotNull())
    edges = materialised(_boundary(grouped, order, ratio, [by]), "edges")
    at_edge = (
        grouped.select(by, order, ident)
        .join(edges.select(by, "cut_ts"), by)
        .filter(F.col(order).eqNullSafe(F.col("cut_ts")))
        .select(by, ident)
    )
    ids = rank_cut(at_edge, ident, edges.select(by, "rank"), [by])
    _check_cut(at_edge, ident, [by], edges.select(by, "rank"), ids)
    cuts = edges.select(by, "cut_ts").join(ids, by)
    is_train = _before(F.col(order), F.col("cut_ts")) | (
        F.col(order).eqNullSafe(F.col("cut_ts")) & (F.col(ident) <= F.col("cut_id"))
    )
    is_train = F.col("cut_id").isNotNull() & F.coalesce(is_train, F.lit(False))
    return (
        grouped.join(cuts, by, "left")
        .withColumn("split", F.when(is_train, TRAIN).otherwise(TEST))
        .drop("cut_ts", "cut_id")
    )


def validation_split(
    train: DataFrame, order: str = "hour_ts", ident: str = "incident_id", ratio: float = 0.2
) -> DataFrame:
    """Hold out the tail of the training rows."""
    return split_by_time(train, order, ident, 1 - ratio, labels=(TRAIN, "validation"))


def split_stratified(
    df: DataFrame, label: str, ident: str = "incident_id", test_ratio: float = 0.2, seed: int = 42
) -> DataFrame:
    """Random split that keeps the class shares: per class the lowest hashes are train."""
    hashed = df.withColumn("draw", draw(F.col(ident), seed))
    targets = df.groupBy(label).agg(
        (F.count("*") - F.ceil(F.count("*") * F.lit(test_ratio))).alias("rank")
    )
    cuts = rank_cut(hashed.select(label, "draw"), "draw", targets, [label])
    return (
        hashed.join(cuts, label, "left")
        .withColumn("split", F.when(F.col("draw") <= F.col("cut_id"), TRAIN).otherwise(TEST))
        .drop("draw", "cut_id")
    )


def union_splits(train: DataFrame, test: DataFrame) -> DataFrame:
    return train.withColumn("split", F.lit(TRAIN)).unionByName(
        test.withColumn("split", F.lit(TEST))
    )


def class_balance(split: DataFrame, label: str, order: str = "hour_ts") -> DataFrame:
    """Size, positives, positive share and time range of each split."""
    positives = F.sum(F.col(label).cast("bigint"))
    return split.groupBy("split").agg(
        F.count("*").alias("n_rows"),
        positives.alias("n_positive"),
        (positives / F.count("*") * 100).alias("positive_pct"),
        F.min(order).alias("first_ts"),
        F.max(order).alias("last_ts"),
    )


def numeric_features(df: DataFrame, label: str, exclude: Sequence[str] = ()) -> list[str]:
    """Columns of a number type, in order; booleans, text and times are not features."""
    numeric = ("tinyint", "smallint", "int", "bigint", "float", "double")
    return [
        name
        for name, kind in df.dtypes
        if name != label and name not in exclude and (kind in numeric or kind.startswith("decimal"))
    ]
