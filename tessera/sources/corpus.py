"""Corpus scans."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def load_corpus(spark: SparkSession, *paths: str, text: str = "text") -> tuple[DataFrame, str, list[str]]:
    """The first of ``paths`` (Parquet) that opens and has the text column, its path, and why earlier ones failed."""
    return first_of([(p, lambda p=p: spark.read.parquet(p)) for p in paths], text)


def first_of(readers: list[tuple[str, Callable[[], DataFrame]]], text: str = "text") -> tuple[DataFrame, str, list[str]]:
    failed = []
    for name, read in readers:
        try:
            rows = read()
            if text not in rows.columns:
                raise ValueError(f"no column {text}")
            return rows, name, failed
        except Exception as e:  # noqa: BLE001 - any failure moves on to the next place
            failed.append(f"{name}: {type(e).__name__}: {str(e).splitlines()[0][:200]}")
    raise RuntimeError("no corpus could be read: " + "; ".join(failed))
