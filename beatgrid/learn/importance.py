"""Permutation importance as one distributed rescoring."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from beatgrid.functions.draws import draw, uniform
from beatgrid.sources.files import materialised

def permutation_importance(
    model,
    test: DataFrame,
    features: Sequence[str],
    label: str,
    ident: str = "incident_id",
    repeats: int = 3,
    sample_rows: int | None = None,
    seed: int = 42,
) -> DataFrame:
    """Mean drop in accuracy when one feature is shuffled, per feature.

    The row with the i-th lowest hash of its id takes the value of the row with the i-th lowest
    second hash: a permutation of the whole table, whatever its size. Ranks come from counts per
    range of hashes and an order within each range, so no task sorts the table. All rows are
    used unless ``sample_rows`` asks for a random sample.
    """
    values = F.array(*[F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(0.0)) for c in features])
    rows = test.select(ident, F.col(label).cast("int").alias("label"), values.alias("x"))
    if sample_rows is not None:
        rows = rows.orderBy(draw(F.col(ident), seed)).limit(sample_rows)
    rows = materialised(rows, "rows")
    ranges = int(test.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    repeated = rows.withColumn("repeat", F.explode(F.array(*[F.lit(r) for r in range(repeats)])))

    def placed(df: DataFrame, side: int) -> DataFrame:
        lot = uniform(F.col(ident), F.col("repeat"), seed + side)
        spread = df.withColumn("draw", lot).withColumn("range", F.floor(F.col("draw") * ranges))
        upto = Window.partitionBy("repeat").orderBy("range")  # one row per range
        sizes = spread.groupBy("repeat", "range").agg(F.count("*").alias("n"))
        sizes = sizes.select("repeat", "range", (F.sum("n").over(upto) - F.col("n")).alias("before"))
        inside = Window.partitionBy("repeat", "range").orderBy("draw", ident)
        return (
            spread.withColumn("inside", F.row_number().over(inside))
            .join(sizes, ["repeat", "range"])
            .withColumn("place", F.col("before") + F.col("inside"))
        )

    partner = placed(repeated, 2).select("repeat", "place", F.col("x").alias("other"))
    paired = placed(repeated, 1).join(partner, ["repeat", "place"]).select("label", "x", "other")
    paired = materialised(paired, "pairs")  # read once a feature, so no task holds a row once for each
    right = F.avg((F.col("prediction").cast("int") == F.col("label")).cast("double"))
    plain = model.transform(rows.select("label", array_to_vector("x").alias("features"))).agg(
        right.alias("plain")
    ).scalar()

    def without(j: int) -> DataFrame:
        swapped = F.transform("x", lambda v, i: F.when(i == j, F.col("other")[j]).otherwise(v))
        shuffled = model.transform(paired.select("label", array_to_vector(swapped).alias("features")))
        return shuffled.agg(right.alias("after")).select(F.lit(j).alias("j"), "after")

    after = without(0)
    for j in range(1, len(features)):
        after = after.unionByName(without(j))
    names = F.array(*[F.lit(c) for c in features])
    return after.select(
        F.get(names, F.col("j")).alias("feature"), (plain - F.col("after")).alias("importance")
    )
