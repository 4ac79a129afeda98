"""Writers, column-name cleaning and report fan-out."""

from __future__ import annotations

import re
import time
import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructField, StructType

from tallyloom.session import fresh_path, shuffles_removed

FORMATS = ("csv", "parquet", "delta")
VERSION = "version-"


def write_output(df: DataFrame, path: str, fmt: str = "csv", mode: str = "overwrite") -> None:
    """Write files. ``delta`` needs the Delta package on the session's class path."""
    if fmt not in FORMATS:
        raise ValueError(f"unsupported format {fmt!r}; choose one of {', '.join(FORMATS)}")
    writer = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True)
    try:
        writer.save(path)
    except Exception as err:
        if "DATA_SOURCE_NOT_FOUND" in str(err):
            raise RuntimeError(f"writing {fmt} needs its package on the session's class path") from err
        raise


def save_table(
    df: DataFrame, name: str, mode: str = "overwrite", fmt: str = "parquet", path: str | None = None
) -> DataFrame:
    """Create or replace a catalog table, its schema included, and return the stored table.

    ``overwrite`` writes a new version below ``path`` (or the warehouse) and then points the table at it. A write
    that fails leaves the old table as it was, and a table may be made from its own rows. With the same columns the
    switch is one catalog call, so readers meet the old rows or the new ones; with other columns the entry is dropped
    and made anew over the finished files, a moment in which the name is unknown. Queries that were planned before the
    switch go on reading the old files until ``drop_versions`` removes them. Delta has versions of its own.
    """
    spark = df.sparkSession
    if fmt == "delta" or mode != "overwrite":
        writer = df.write.mode(mode).format(fmt)
        if fmt == "delta" and mode == "overwrite":
            writer = writer.option("overwriteSchema", True)
        (writer.option("path", path) if path else writer).saveAsTable(name)
        return spark.table(name)
    version = f"{versions_of(spark, name, path)}/{VERSION}{uuid.uuid4().hex}"
    df.write.format(fmt).save(version)
    return _switch(spark, name, version, spark.read.format(fmt).load(version).schema, fmt)


def _switch(spark: SparkSession, name: str, place: str, schema: StructType, fmt: str) -> DataFrame:
    """Point the table at a finished folder."""
    if spark.catalog.tableExists(name) and spark.table(name).schema == schema and _provider(spark, name) == fmt:
        quoted = place.replace("'", "\\'")
        spark.sql(f"ALTER TABLE {_quoted(name)} SET LOCATION '{quoted}'")
        spark.catalog.refreshTable(name)
    else:
        spark.sql(f"DROP TABLE IF EXISTS {_quoted(name)}")
        spark.catalog.createTable(name, path=place, source=fmt, schema=schema)
    return spark.table(name)


def save_split(
    df: DataFrame, branches: Mapping[str, tuple[Column | None, Sequence[Column | str]]], path: str
) -> dict[str, DataFrame]:
    """Several tables from one pass over ``df``: each row goes to the first table whose condition holds.

    ``branches`` maps a table's name to its condition and its columns; a condition that is null does not hold, and
    ``None``, for the last table only, takes every row that is left. Without it such rows go nowhere. The rows are
    written once, as Parquet in a folder per table below a new version in ``path``; columns that a table does not have
    are null in its folder. Then the tables are pointed there one after the other, as ``save_table`` does; a write that
    fails leaves all of them as they were. ``drop_versions`` takes all names that share the path. A column of two
    tables must have one type.
    """
    spark = df.sparkSession
    last = len(branches) - 1
    if any(cond is None and n < last for n, (cond, _) in enumerate(branches.values())):
        raise ValueError("only the last table can go without a condition")
    number = F.lit(None).cast("int")
    for n, (cond, _) in reversed(list(enumerate(branches.values()))):
        number = F.lit(n) if cond is None else F.when(cond, F.lit(n)).otherwise(number)
    wanted = {name: [F.col(f"`{c}`") if isinstance(c, str) else c for c in cols] for name, (_, cols) in branches.items()}
    schemas = {name: df.select(*cols).schema for name, cols in wanted.items()}
    types: dict[str, object] = {}
    parts: dict[str, list] = {}
    for n, (name, cols) in enumerate(wanted.items()):
        for field, col in zip(schemas[name], cols):
            if types.setdefault(field.name, field.dataType) != field.dataType:
                raise ValueError(f"column {field.name!r} has two types")
            parts.setdefault(field.name, []).append((n, col))
    branch = "__branch"
    merged = []
    for name, uses in parts.items():
        value = F.lit(None).cast(types[name])
        for n, col in uses:
            value = F.when(F.col(branch) == n, col).otherwise(value)
        merged.append(value.alias(name))
    version = f"{path.rstrip('/')}/{VERSION}{uuid.uuid4().hex}"
    routed = df.withColumn(branch, number).filter(F.col(branch).isNotNull()).select(*merged, branch)
    routed.write.partitionBy(branch).parquet(version)
    out = {}
    for n, (name, schema) in enumerate(schemas.items()):
        place = f"{version}/{branch}={n}"
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(place)
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(folder)  # a table may get no rows
        nullable = StructType([StructField(f.name, f.dataType, True) for f in schema])
        out[name] = _switch(spark, name, place, nullable, "parquet")
    return out


def _quoted(name: str) -> str:
    return ".".join(f"`{part}`" for part in name.replace("`", "").split("."))


def _provider(spark: SparkSession, name: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {_quoted(name)}").filter("col_name = 'Provider'").collect()
    return rows[0]["data_type"].lower() if rows else ""


def versions_of(spark: SparkSession, name: str, path: str | None = None) -> str:
    """The folder that holds the versions of a table."""
    return path.rstrip("/") if path else f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/{name}_versions"


def drop_versions(
    spark: SparkSession, name: str | Sequence[str], path: str | None = None, older_than: float = 86_400
) -> int:
    """Remove the versions of a table, but for the current one, that were written ``older_than`` seconds ago; how many.

    For tables of ``save_split``: all names that share the ``path``. A version that one of them uses stays.
    """
    names = [name] if isinstance(name, str) else list(name)
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(versions_of(spark, names[0], path))
    store = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    used = [f for n in names for f in spark.table(n).inputFiles()]
    for n in names:
        place = spark.sql(f"DESCRIBE TABLE EXTENDED {_quoted(n)}").filter("col_name = 'Location'").first()
        used.append(place["data_type"])
    current = {part for place in used for part in place.split("/") if part.startswith(VERSION)}
    gone = [s.getPath() for s in store.listStatus(root) if s.getModificationTime() <= (time.time() - older_than) * 1000]
    gone = [p for p in gone if p.getName().startswith(VERSION) and p.getName() not in current]
    return sum(store.delete(p, True) for p in gone)


def sanitize_columns(df: DataFrame, pattern: str = r"[^A-Za-z0-9_]") -> DataFrame:
    """Replace characters a table format may refuse by ``_``; two names that become one are an error."""
    names = [re.sub(pattern, "_", c) for c in df.columns]
    clashes = sorted({n for n in names if names.count(n) > 1})
    if clashes:
        raise ValueError(f"column names collide after cleaning: {clashes}")
    return df.toDF(*names)


def run_reports(
    shared: DataFrame | Sequence[DataFrame], reports: Mapping[str, Callable[[DataFrame], DataFrame]]
) -> dict[str, DataFrame]:
    """Store a table once in the shared folder and derive every report from the stored copy.

    Runs one write job, in place of the table's whole plan again for each report. What that job shuffled is removed as
    soon as the rows are stored, so the disk does not hold it beside the shuffles of the reports. A table in several
    parts is stored one part after the other, so that the disk never holds the shuffles of two.
    """
    parts = [shared] if isinstance(shared, DataFrame) else list(shared)
    spark = parts[0].sparkSession
    path = fresh_path(spark, "shared")
    with shuffles_removed(spark):
        for part in parts:
            part.write.mode("append").option("compression", "zstd").parquet(path)
    stored = spark.read.parquet(path)
    return {name: report(stored) for name, report in reports.items()}
