"""Command line, entry points, streaming windows."""

import subprocess
import sys

import pytest

from tessera.cli import parser
from tessera.sources.config import Config


def test_command_line():
    a = parser().parse_args(["--config", "c.json", "--no-resume", "--limit", "5"])
    assert (a.stage, a.resume, a.dry_run, a.limit) == ("all", False, None, 5)
    with pytest.raises(SystemExit):
        parser().parse_args(["--config", "c.json", "--stage", "nothing"])


def test_judge_model():
    c = Config(judge_provider="some_local", judge_model="far", qwen3vl_model="near")
    assert c.judge_model_id == "near" and Config(judge_provider="http", judge_model="far").judge_model_id == "far"


def test_every_oracle_has_a_query():
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())


def test_entry(spark):
    import __spark_entry__ as e

    assert {r.source_length_bucket for r in e.entry(spark).collect()} == {"short", "medium", "long"}


def test_rest_imports_without_optional_parts(tmp_path):
    """The llm folder and the pipeline may be deleted."""
    import shutil
    from pathlib import Path

    root = Path(__file__).resolve().parents[1]
    shutil.copytree(root / "tessera", tmp_path / "tessera", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; assert e.queries() and not [k for k in e.queries() if k.startswith('op') or k == 'pipeline']"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": str(tmp_path)})


def test_windows(spark, tmp_path):
    from tessera.streaming.ingest import windowed_counts

    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    (tmp_path / "in").mkdir()
    events.limit(200).write.mode("overwrite").parquet(str(tmp_path / "in"))
    stream = windowed_counts(spark.readStream.schema(events.schema).parquet(str(tmp_path / "in")))
    query = stream.writeStream.outputMode("complete").format("memory").queryName("windows").trigger(availableNow=True).start()
    query.awaitTermination()
    assert spark.table("windows").agg({"n": "sum"}).first()[0] == 200
