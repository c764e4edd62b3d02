"""Report sinks (S10): every DataFrame of a run written under one run id.

Reports are small tables (metrics, leaderboards, importances, summaries) or
row-level tables (predictions, attributions); both are written by Spark,
never collected.
"""

from __future__ import annotations

import dataclasses
import time
import uuid

from pyspark.sql import DataFrame

from carepath.sources.tables import write_table


def run_id() -> str:
    return f"{time.strftime('%Y%m%d-%H%M%S')}-{uuid.uuid4().hex[:8]}"


def write_run(run, out_dir: str, rid: str | None = None, fmt: str = "parquet") -> dict[str, str]:
    """Write every DataFrame field (and DataFrames inside dict fields) of a
    run object to ``<out_dir>/<run id>/<name>``; returns name -> path."""
    rid = rid or run_id()
    base = out_dir.rstrip("/") + "/" + rid
    written = {}

    def put(name, df):
        path = f"{base}/{name}"
        write_table(df, path, fmt=fmt)
        written[name] = path

    for f in dataclasses.fields(run):
        value = getattr(run, f.name)
        if isinstance(value, DataFrame):
            put(f.name, value)
        elif isinstance(value, dict):
            for k, v in value.items():
                if isinstance(v, DataFrame):
                    put(f"{f.name}_{k}", v)
    return written
