"""Readers and writers, dataset metadata and run-versioned outputs."""

from __future__ import annotations

import tempfile
import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Only in a session on one machine a temporary folder is set where nothing is configured.
    """
    folder = spark.conf.get("spark.checkpoint.dir", "") or ""
    if not folder:
        folder = spark.sparkContext.getCheckpointDir() or ""
    if not folder:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="beatgrid-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/beatgrid/{label}-{uuid.uuid4().hex}"


# text formats would otherwise cut timestamps to milliseconds
_MICROS = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def read_table(
    spark: SparkSession, path: str, fmt: str = "parquet", schema: str | None = None
) -> DataFrame:
    """CSV (with header), JSON records or parquet; a fixed schema avoids an inference pass."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    if fmt == "parquet":
        return reader.parquet(path)
    if fmt == "csv":
        # quote doubling as other CSV writers do it
        return reader.options(**_MICROS).option("header", True).option("escape", '"').csv(path)
    if fmt == "json":
        return reader.options(**_MICROS).json(path)
    raise ValueError(f"unknown format: {fmt}")


def write_table(df: DataFrame, path: str, fmt: str = "parquet", by: tuple[str, ...] = ()) -> str:
    """Parallel write, one file per task; ``by`` makes directory partitions."""
    writer = df.write.mode("overwrite")
    if by:
        writer = writer.partitionBy(*by)
    if fmt == "parquet":
        writer.parquet(path)
    elif fmt == "csv":
        writer.options(**_MICROS).option("header", True).option("escape", '"').csv(path)
    elif fmt == "json":
        writer.options(**_MICROS).option("ignoreNullFields", False).json(path)
    else:
        raise ValueError(f"unknown format: {fmt}")
    return path


def materialised(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared folder and read back: cuts the lineage and survives executor loss."""
    spark = df.sparkSession
    staged = read_table(spark, write_table(df, scratch_path(spark, label)))
    staged.staged_files = staged.inputFiles()
    return staged


def discard(*tables: DataFrame) -> None:
    """Remove staged tables (results of ``materialised``) that nothing still to be run reads.

    What was computed from them must have been written; tables that were not staged are left alone.
    """
    for df in tables:
        for folder in {name.rpartition("/")[0] for name in getattr(df, "staged_files", [])}:
            jvm = df.sparkSession._jvm
            path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(folder))
            path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)
        df.staged_files = []


def write_split(split: DataFrame, path: str) -> str:
    """Train / test dataset, one directory per value of ``split``."""
    return write_table(split, path, by=("split",))


def split_metadata(split: DataFrame, label: str) -> DataFrame:
    """One row per (split, class): row count, column count and column list."""
    features = [c for c in split.columns if c not in (label, "split")]
    return (
        split.groupBy("split", label)
        .agg(F.count("*").alias("n_rows"))
        .withColumn("n_features", F.lit(len(features)))
        .withColumn("feature_columns", F.lit(",".join(sorted(features))))
    )


def new_run_id() -> str:
    now = datetime.now(timezone.utc).strftime("%Y%m%d_%H%M%S")
    return f"run_{now}_{uuid.uuid4().hex[:8]}"


def run_path(base: str, run_id: str, kind: str) -> str:
    return f"{base.rstrip('/')}/{kind}/run_id={run_id}"


def write_run(df: DataFrame, base: str, kind: str, run_id: str | None = None) -> str:
    run_id = run_id or new_run_id()
    write_table(df, run_path(base, run_id, kind))
    return run_id


def list_runs(spark: SparkSession, base: str, kind: str) -> DataFrame:
    """Run ids, newest first. Reads partition values only."""
    return (
        spark.read.option("basePath", f"{base}/{kind}")
        .parquet(f"{base}/{kind}/run_id=*")
        .select("run_id")
        .distinct()
        .orderBy(F.desc("run_id"))
    )
