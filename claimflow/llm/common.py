"""Shared Spark helpers of the training-data operators."""

from __future__ import annotations

import hashlib
import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from ..session import scratch_path


def ship(spark: SparkSession) -> None:
    """Send the package to the executors, whose Python may not find it by itself."""
    package = Path(__file__).resolve().parents[1]
    files = sorted(package.rglob("*.py"))
    digest = hashlib.sha256(b"".join(p.read_bytes() for p in files)).hexdigest()[:16]
    name = f"{package.name}-{digest}.zip"
    if any(x == name for x in spark.sparkContext._python_includes):
        return
    to = Path(os.path.realpath(tempfile.mkdtemp())) / name   # the driver serves it from here
    with zipfile.ZipFile(to, "w") as z:
        for p in files:
            z.write(p, p.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(to))


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a new folder below the shared one and read it back.

    Cuts the lineage at a table every executor can read, so a lost executor
    costs a re-read, not a recomputation.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(name: str, taken: list[str]) -> str:
    """``name``, with underscores added until no column is called so (column
    names are compared without case, as Spark resolves them)."""
    low = {c.lower() for c in taken}
    while name.lower() in low:
        name = "_" + name
    return name
