"""One local session for tests and tools."""

from __future__ import annotations

import os

from paysift import build_session


def session():
    """A small local session; the checkpoint folder is the configured one, if any."""
    cpus = os.environ.get("TEST_CPUS", "8")
    spark = build_session("paysift-tests", f"local[{cpus}]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
                          spark__driver__memory="8g", spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    return spark
