"""Reading tables and cutting lineage for the operators of this folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import shared_place, ship


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's tables, read through Spark so that any store works."""
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """A new folder that driver and executors see.

    ``spark.checkpoint.dir`` names the place. Where it is unset, a temporary folder of this process stands in on
    a local master; on a cluster that is an error.
    """
    return shared_place(spark)


_COMPACT = "spark.sql.adaptive.coalescePartitions.parallelismFirst"


def stored(df: DataFrame, compact: bool = False) -> DataFrame:
    """``df`` written to the shared folder and read back: computed once, lineage cut, safe from lost executors.

    ``compact`` is for narrow rows: tasks take the advised size, however few they are, instead of one for each core.
    """
    spark, at = df.sparkSession, shared_folder(df.sparkSession)
    before = spark.conf.get(_COMPACT, "true")
    try:
        if compact:
            spark.conf.set(_COMPACT, "false")
        df.write.parquet(at)
    finally:
        spark.conf.set(_COMPACT, before)
    return spark.read.schema(df.schema).parquet(at)


def text_tag(text: str) -> Column:
    """CRC-32 of a text, as an int: tells texts that share an id apart."""
    return (F.crc32(F.col(text).cast("binary")) - F.lit(1 << 31)).cast("int")


def drop_stored(df: DataFrame) -> None:
    """Deletes what ``stored`` wrote; nothing may read ``df`` any more."""
    spark = df.sparkSession
    for at in {name.rsplit("/", 1)[0] for name in df.inputFiles()}:
        if "/tessera-" in at:
            path = spark._jvm.org.apache.hadoop.fs.Path(at)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def own_columns(df: DataFrame, *names: str) -> None:
    """Raises if a needed column is missing; further columns of any name are left alone."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
