"""What the jobs share: config files, logs, the command line."""

from __future__ import annotations

import argparse
import json
import logging
from collections.abc import Callable

from pyspark.sql import SparkSession


def log(name: str) -> logging.Logger:
    return logging.getLogger(f"jobs.{name}")


def config(spark: SparkSession, path: str) -> dict:
    """A small JSON file: one of the driver's machine, or one of a store that Spark reads, by its scheme."""
    if "://" in path and not path.startswith("file:"):
        return json.loads("\n".join(r.value for r in spark.read.option("wholetext", True).text(path).collect()))
    with open(path.removeprefix("file://"), encoding="utf-8") as f:
        return json.load(f)


def command(name: str, about: str, arguments: dict[str, str], run: Callable) -> None:
    """Parse plain path arguments, start a session, run, stop it."""
    top = argparse.ArgumentParser(prog=f"python -m jobs.{name}", description=about)
    for argument, text in arguments.items():
        top.add_argument(f"--{argument}", required=True, help=text)
    own = vars(top.parse_args())
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(name)s %(message)s")
    from terminus.session import session

    spark = session(app=name)
    try:
        run(spark, **own)
    finally:
        spark.stop()
