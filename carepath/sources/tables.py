"""Scans and sinks for the encounter tables.

Every reader returns a lazy DataFrame; column pruning and predicate
pushdown are left to Catalyst, so ``load_tables(...)["diagnoses_icd"]
.filter(...).select(...)`` only reads the columns and row groups it needs.
"""

from __future__ import annotations

import uuid
import warnings

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Declared schemas of the encounter tables.  ``icd_code`` is always a
# string so that codes with leading zeros keep them.
SCHEMAS: dict[str, T.StructType] = {
    "patients": T.StructType([
        T.StructField("subject_id", T.LongType()),
        T.StructField("gender", T.StringType()),
        T.StructField("anchor_age", T.IntegerType()),
    ]),
    "admissions": T.StructType([
        T.StructField("subject_id", T.LongType()),
        T.StructField("hadm_id", T.LongType()),
        T.StructField("admittime", T.TimestampType()),
        T.StructField("dischtime", T.TimestampType()),
        T.StructField("deathtime", T.TimestampType()),
        T.StructField("admission_type", T.StringType()),
        T.StructField("admission_location", T.StringType()),
        T.StructField("discharge_location", T.StringType()),
        T.StructField("insurance", T.StringType()),
        T.StructField("language", T.StringType()),
        T.StructField("marital_status", T.StringType()),
        T.StructField("race", T.StringType()),
        T.StructField("edregtime", T.TimestampType()),
        T.StructField("edouttime", T.TimestampType()),
        T.StructField("hospital_expire_flag", T.IntegerType()),
    ]),
    "diagnoses_icd": T.StructType([
        T.StructField("subject_id", T.LongType()),
        T.StructField("hadm_id", T.LongType()),
        T.StructField("seq_num", T.IntegerType()),
        T.StructField("icd_code", T.StringType()),
        T.StructField("icd_version", T.IntegerType()),
    ]),
    "labevents": T.StructType([
        T.StructField("subject_id", T.LongType()),
        T.StructField("hadm_id", T.LongType()),
        T.StructField("itemid", T.LongType()),
        T.StructField("charttime", T.TimestampType()),
        T.StructField("valuenum", T.DoubleType()),
    ]),
}

DEFAULT_TABLES = ["patients", "admissions", "diagnoses_icd", "labevents",
                  "prescriptions", "transfers"]


def read_table(spark: SparkSession, path: str, name: str | None = None,
               fmt: str | None = None) -> DataFrame:
    """Scan one table.  CSV uses the declared schema (blank -> NULL)."""
    fmt = fmt or ("csv" if path.endswith(".csv") or path.endswith(".csv.gz") else "parquet")
    if fmt == "csv":
        reader = spark.read.option("header", True).option("mode", "PERMISSIVE")
        schema = SCHEMAS.get(name or "")
        if schema is not None:
            # Keep the header order of the file: read the header, map types by name.
            header = spark.read.option("header", True).csv(path).columns
            by_name = {f.name: f for f in schema.fields}
            schema = T.StructType([by_name.get(c, T.StructField(c, T.StringType()))
                                   for c in header])
            reader = reader.schema(schema)
        # Columns of an undeclared table stay strings: inferring types would read it whole.
        return reader.csv(path)
    return spark.read.parquet(path)


def _exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists in whatever store Spark resolves it to."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def _resolve(spark: SparkSession, root: str, name: str) -> tuple[str, str] | None:
    for ext, fmt in ((".parquet", "parquet"), (".csv", "csv"), (".csv.gz", "csv"), ("", "parquet")):
        p = f"{root.rstrip('/')}/{name}{ext}"
        if _exists(spark, p):
            return p, fmt
    return None


def load_tables(spark: SparkSession, root: str, names: list[str] | None = None,
                required: tuple[str, ...] = ()) -> dict[str, DataFrame]:
    """Lazy scans for the named tables under ``root``.

    ``root`` may be in any store Spark reads.  A missing table is skipped with
    a warning, or an error if it is ``required``; nothing is read until an
    action runs.
    """
    out: dict[str, DataFrame] = {}
    for name in names or DEFAULT_TABLES:
        hit = _resolve(spark, root, name)
        if hit is None:
            if name in required:
                raise FileNotFoundError(f"table {name!r} not found under {root}")
            warnings.warn(f"table {name!r} not found under {root}; skipped")
            continue
        out[name] = read_table(spark, hit[0], name, hit[1])
    return out


def require_inputs(tables: dict[str, DataFrame], required: list[str]) -> None:
    """Fail fast when a stage's declared inputs are missing."""
    missing = [r for r in required if r not in tables]
    if missing:
        raise FileNotFoundError(f"missing required inputs: {missing}")


def write_table(df: DataFrame, path: str, fmt: str = "parquet",
                partition_by: list[str] | None = None) -> None:
    """Overwrite sink (S5/S10).  CSV keeps a header like the reference."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.parquet(path)


def write_colocated(df: DataFrame, path: str, key: str, sort: list[str] = (), buckets: int | None = None) -> DataFrame:
    """Write ``df`` at ``path`` in buckets of ``key``, sorted, one file a bucket,
    and return it as a table that remembers this (S5).

    Joins on ``key``, groups by it and windows over it then need no exchange, between
    tables with the same number of buckets.  ``buckets`` should put some hundred
    megabytes in a file (default: the session's shuffle partitions).  The catalog entry
    that Spark needs to write buckets is dropped again; the files stay."""
    spark = df.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"colocated_{uuid.uuid4().hex}"
    (df.repartition(n, key).write.format("parquet").option("path", path).bucketBy(n, key).sortBy(key, *sort)
       .mode("overwrite").saveAsTable(name))
    out = spark.table(name)
    out.schema                                     # resolved, with its buckets, before the entry goes
    spark.sql(f"DROP TABLE {name}")
    return out


def save_model(model, path: str) -> None:
    """Model sink (S9): Spark ML's own writer instead of pickle."""
    model.write().overwrite().save(path)


def load_model(path: str):
    """Model source."""
    from pyspark.ml import PipelineModel
    return PipelineModel.load(path)
