"""Reports of the catalog, SQL functions by name, manifests and values for JSON."""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Mapping
from datetime import date, datetime
from pathlib import PurePath

from pyspark.sql import DataFrame, SparkSession

from ..functions.text import guarded_name


def tables(spark: SparkSession) -> DataFrame:
    """(name, kind, temporary) of the tables and views of the current database."""
    return spark.createDataFrame([(t.name, t.tableType, t.isTemporary) for t in spark.catalog.listTables()], "name string, kind string, temporary boolean").orderBy("name")


def columns(spark: SparkSession, table: str) -> DataFrame:
    """(position, name, type, nullable) of a table's columns."""
    fields = spark.table(guarded_name(table)).schema.fields
    return spark.createDataFrame([(i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(fields)], "position int, name string, type string, nullable boolean")


def dropped(spark: SparkSession, table: str) -> None:
    """DROP of a table or view, if there is one."""
    spark.sql(f"DROP VIEW IF EXISTS {guarded_name(table)}") if any(t.name == table and "VIEW" in t.tableType or t.name == table and t.isTemporary for t in spark.catalog.listTables()) else spark.sql(f"DROP TABLE IF EXISTS {guarded_name(table)}")


def analyzed(spark: SparkSession, table: str) -> None:
    """ANALYZE: row counts and column statistics for the optimizer."""
    spark.sql(f"ANALYZE TABLE {guarded_name(table)} COMPUTE STATISTICS FOR ALL COLUMNS")


def registered(spark: SparkSession, functions: Mapping[str, Callable], kind: str = "string") -> list[str]:
    """Functions for SQL under their names: vectorized ones as they are, plain Python ones with the return type `kind`."""
    for name, f in functions.items():
        if hasattr(f, "evalType"):
            spark.udf.register(guarded_name(name), f)
        else:
            spark.udf.register(guarded_name(name), f, kind)
    return sorted(functions)


def json_safe(x: object) -> object:
    """A value that JSON can hold: times as ISO text, paths as text, sets sorted as lists, numbers that are none as null, what else there is as text."""
    if x is None or isinstance(x, (str, bool, int)):
        return x
    if isinstance(x, float):
        return x if math.isfinite(x) else None
    if isinstance(x, Mapping):
        return {str(k): json_safe(v) for k, v in x.items()}
    if isinstance(x, (set, frozenset)):
        return sorted((json_safe(v) for v in x), key=str)
    if isinstance(x, (list, tuple)):
        return [json_safe(v) for v in x]
    if isinstance(x, (datetime, date)):
        return x.isoformat()
    if isinstance(x, PurePath):
        return str(x)
    return json_safe(x.item()) if hasattr(x, "item") else str(x)


def write_manifest(spark: SparkSession, path: str, entries: Mapping[str, object]) -> None:
    """One JSON document under `path`, in any store of Spark; it replaces the one that was there."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    at = jvm.org.apache.hadoop.fs.Path(path)
    out = at.getFileSystem(conf).create(at, True)
    try:
        out.write(json.dumps(json_safe(entries), ensure_ascii=False, indent=2, sort_keys=True).encode())
    finally:
        out.close()
