"""Session factory and run settings."""

from __future__ import annotations

import logging
import os
from contextlib import contextmanager

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(app: str = "riskloom", **conf: str) -> SparkSession:
    """SRC5: the session, with UTC times and adaptive execution; other settings come from spark-submit."""
    builder = SparkSession.builder.appName(app)
    for key, value in (DEFAULTS | conf).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def session_scope(app: str = "riskloom", **conf: str):
    """SRC5: a session that ends with the block."""
    spark = get_session(app, **conf)
    try:
        yield spark
    finally:
        spark.stop()


def configure_logging(path: str | None = None, level: str | None = None) -> None:
    """Console logging, and a file where ``LOGS_FILE`` or ``path`` names one."""
    path = path or os.environ.get("LOGS_FILE")
    handlers: list[logging.Handler] = [logging.StreamHandler()]
    if path:
        handlers.append(logging.FileHandler(path))
    logging.basicConfig(level=level or os.environ.get("LOG_LEVEL", "INFO"), handlers=handlers, format="%(asctime)s %(levelname)s %(name)s %(message)s")
