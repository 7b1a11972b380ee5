"""spark-submit entry: runs one stage, or all, of a configuration."""

from __future__ import annotations

import argparse
import logging

from pyspark.sql import SparkSession

from tessera.plans.stages import STAGES, Stages
from tessera.sources.config import load, override


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(description=__doc__)
    p.add_argument("--config", required=True)
    p.add_argument("--stage", choices=STAGES, default="all")
    # Unset flags leave the file's values.
    p.add_argument("--resume", action=argparse.BooleanOptionalAction, default=None)
    p.add_argument("--dry-run", action=argparse.BooleanOptionalAction, default=None)
    p.add_argument("--limit", type=int)
    p.add_argument("--log-level", default=None)
    return p


def main(args: list[str] | None = None) -> None:
    a = parser().parse_args(args)
    config = override(load(a.config), a.dry_run, a.resume, a.limit)
    logging.basicConfig(level=a.log_level or config.log_level)
    Stages(SparkSession.builder.getOrCreate(), config).run(a.stage)


if __name__ == "__main__":
    main()
