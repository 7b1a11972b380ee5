"""Keyed JSON-lines files, manifests and environment files, through Hadoop's file systems."""

from __future__ import annotations

import json
import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators.merge import last_wins


def _path(spark: SparkSession, at: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(at)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, at: str) -> bool:
    path, fs = _path(spark, at)
    return fs.exists(path)


def read_keyed(spark: SparkSession, at: str, schema: T.StructType, key: str = "id", defaults: dict | None = None) -> DataFrame:
    """Records by key; of equal keys the last line counts. A missing file is empty, blank lines are skipped, a broken line fails.

    Lines are ordered by file, then by block and place within it.
    """
    if not exists(spark, at):
        return spark.createDataFrame([], schema)
    raw = spark.read.schema(schema).option("mode", "FAILFAST").json(at)
    rows = raw.withColumn("__at", F.struct(F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), F.monotonically_increasing_id().alias("n")))
    rows = last_wins(rows, key, "__at").drop("__at")
    for name, value in (defaults or {}).items():
        default = F.array(*map(F.lit, value)) if isinstance(value, list) else F.lit(value)
        rows = rows.withColumn(name, F.coalesce(F.col(name), default.cast(schema[name].dataType)))
    return rows


def write_keyed(rows: DataFrame, at: str, key: str = "id", single: bool = True) -> None:
    """Replaces ``at`` by one JSON object per line in order of the key, nulls included, text unescaped.

    Written beside the target and renamed, so a file may be replaced by what was read from it; the old one is
    moved aside first and deleted last, so at no time are both gone. ``single`` asks for one file; without it
    each task writes its own range of keys.
    """
    spark, new = rows.sparkSession, f"{at}.{uuid.uuid4().hex}"
    rows = rows.orderBy(key)
    (rows.coalesce(1) if single else rows).write.option("ignoreNullFields", False).json(new)
    path, fs = _path(spark, at)
    fs.mkdirs(path.getParent())
    old = _path(spark, f"{at}.{uuid.uuid4().hex}.old")[0]
    before = fs.exists(path)
    if before and not fs.rename(path, old) or not fs.rename(_path(spark, new)[0], path):
        raise OSError(f"can't replace {at}")
    if before:
        fs.delete(old, True)


def write_manifest(spark: SparkSession, at: str, manifest: dict) -> None:
    path, fs = _path(spark, at)
    fs.mkdirs(path.getParent())
    out = fs.create(path, True)
    out.write(bytearray(json.dumps(manifest, ensure_ascii=False, indent=2).encode()))
    out.close()


def read_manifest(spark: SparkSession, at: str, default: dict | None = None) -> dict:
    """The manifest at ``at``, or ``default`` where there is none."""
    if not exists(spark, at):
        return dict(default or {})
    return json.loads(spark.read.text(at, wholetext=True).first()[0])


def load_env(at: str = ".env") -> dict[str, str]:
    """Sets variables of a file of NAME=value lines that aren't set yet; comments, blank lines and quotes are known."""
    found = {}
    if os.path.exists(at):
        with open(at, encoding="utf-8") as f:
            for line in map(str.strip, f):
                name, sign, value = line.partition("=")
                if sign and not line.startswith("#"):
                    found[name.strip()] = value.strip().strip("'\"")
    for name, value in found.items():
        os.environ.setdefault(name, value)
    return found
