"""Session helpers."""

from __future__ import annotations

import re
import tempfile
import uuid
import zipfile
from functools import lru_cache
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_shipped: set[str] = set()
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
_BATCH_DEFAULT, _BATCH_BYTES = "67108864b", "4m"


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors, once for each application; their Python workers import it.

    Where the session has Spark's default of 64 MB for an Arrow batch, 4 MB are set: a worker holds several
    times its batch while it works on long texts.
    """
    if spark.conf.get(_BATCH, _BATCH_DEFAULT) == _BATCH_DEFAULT:
        spark.conf.set(_BATCH, _BATCH_BYTES)
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="tessera-code-")) / "tessera_code.zip"
    with zipfile.ZipFile(target, "w") as z:
        for path in sorted(root.rglob("*.py")):
            z.write(path, path.relative_to(root.parent))
    context.addPyFile(str(target))
    _shipped.add(context.applicationId)


@lru_cache(maxsize=1)
def _own_folder() -> str:
    return "file://" + tempfile.mkdtemp(prefix="tessera-")


def shared_place(spark: SparkSession) -> str:
    """A new path under ``spark.checkpoint.dir``; where that is unset, in this machine's temporary folder if the master is local."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir isn't set: executors need a folder that they share")
        base = _own_folder()
    return f"{base.rstrip('/')}/tessera-{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """``df`` written where all executors see it, and read back: computed once, lineage cut."""
    at = shared_place(df.sparkSession)
    df.write.parquet(at)
    return df.sparkSession.read.schema(df.schema).parquet(at)
