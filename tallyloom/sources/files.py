"""File and table sources."""

from __future__ import annotations

import csv
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType


def read_csv(
    spark: SparkSession, path, schema: StructType | str | None = None, header: bool = True, rename: Mapping[str, str] | None = None
) -> DataFrame:
    """Header CSV. Give a schema for large input: without one Spark reads the files once more to infer it.

    Declared columns are found by the names in the header (``rename``: header name to declared name), in any order;
    further columns are left out. A declared column that is missing, files whose headers differ, short or long
    lines, and fields that are not of the declared type stop the query: nothing turns into NULL unseen. Without a
    header the schema's order counts.
    """
    reader = spark.read.option("header", header)
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    declared = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    # Whole lines are parsed, else a line that is too short for a column nobody reads would pass.
    strict = reader.option("mode", "FAILFAST").option("columnPruning", False)
    if not header:
        return strict.schema(declared).csv(path)
    names = spark.read.option("header", True).csv(path).columns
    known = {f.name: f.dataType for f in declared.fields}
    ours = [(rename or {}).get(n, n) for n in names]
    missing = [n for n in known if n not in ours]
    if missing:
        raise ValueError(f"columns {missing} are not in the header {names}")
    in_file = StructType([StructField(n, known.get(o, StringType())) for n, o in zip(names, ours, strict=True)])
    found = strict.option("enforceSchema", False).schema(in_file).csv(path)
    place = {o: n for n, o in zip(names, ours, strict=True)}
    return found.select(*[F.col(f"`{place[n]}`").alias(n) for n in known])


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def read_many(
    spark: SparkSession,
    paths: str | Sequence[str] | Mapping[str, object],
    schema=None,
    file_column: str | None = "FileName",
    full_path: bool = False,
) -> DataFrame:
    """Several CSV files as one table, with the source file's name (``full_path``: its whole path).

    A glob or a list of paths is one scan, whose files share the columns. A mapping of path to its schema is one
    scan per entry, united by column name; a column that an entry lacks is NULL.
    """

    def scan(path, schema) -> DataFrame:
        df = read_csv(spark, path, schema)
        if not file_column:
            return df
        return df.select("*", F.col("_metadata.file_path" if full_path else "_metadata.file_name").alias(file_column))

    if not isinstance(paths, Mapping):
        return scan(paths if isinstance(paths, str) else list(paths), schema)
    scans = [scan(path, declared) for path, declared in paths.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), scans)


# From narrow to wide; any other mixture of types is text.
WIDER = ("void", "int", "bigint", "double")


def _widened(kinds: set[str]) -> str:
    kinds = kinds - {"void"} or {"string"}
    if len(kinds) == 1:
        return kinds.pop()
    if kinds <= {"date", "timestamp"}:
        return "timestamp"
    return max(kinds, key=WIDER.index) if kinds <= set(WIDER) else "string"


def first_lines(spark: SparkSession, path) -> DataFrame:
    """``file`` (its path) and ``line`` of the first line of every file that has one. Reads the files once, in parallel."""
    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start")
    )
    # Inside a block the ids follow the lines.
    lines = lines.filter("start = 0").withColumn("at", F.monotonically_increasing_id())
    return lines.groupBy("file").agg(F.min_by("value", "at").alias("line"))


def read_by_header(spark: SparkSession, path, file_column: str | None = "FileName", full_path: bool = False) -> DataFrame:
    """CSV files of any headers as one table, columns united by name, with the source file's name.

    The headers are read in one distributed pass and files with the same header make one scan, so the number of scans
    is that of the different headers. Types are inferred per header and widened over all of them (whole numbers to
    larger ones and to double, dates to timestamps, all else to text) before the rows are read, so text keeps its
    spelling. A column that a file lacks is NULL, one without any value is text, an empty file has no rows. The same
    name twice in a header is an error; a line that does not fit its header stops the query.
    """
    groups = first_lines(spark, path).groupBy("line").agg(F.sort_array(F.collect_list("file")).alias("files")).orderBy("line").collect()
    if not groups:
        raise ValueError(f"no header in {path}")
    scans = []
    for group in groups:
        found = spark.read.option("header", True).option("inferSchema", True).csv(group["files"])
        names = [n.lower() for n in next(csv.reader([group["line"]]))]
        if len(set(names)) < len(names):
            raise ValueError(f"a name stands twice in the header {group['line']!r}")
        scans.append((group["files"], dict(found.dtypes)))
    kinds: dict[str, set[str]] = {}
    for _, columns in scans:
        for name, kind in columns.items():
            kinds.setdefault(name, set()).add(kind)
    wide = {name: _widened(found) for name, found in kinds.items()}

    def scan(files: list[str], names: list[str]) -> DataFrame:
        declared = ", ".join(f"`{n}` {wide[n]}" for n in names)
        df = read_csv(spark, files, declared)
        if not file_column:
            return df
        return df.select("*", F.col("_metadata.file_path" if full_path else "_metadata.file_name").alias(file_column))

    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [scan(files, list(columns)) for files, columns in scans])


def skip_lines(spark: SparkSession, path, lines: int, file_column: str | None = None) -> DataFrame:
    """The lines (``line``) of text files without the first ``lines`` of each file, whatever those hold.

    Lines are numbered inside the first block of a file only, so large files still split across tasks: every other
    block passes through. One row per file, the id of its first line, is found by a first pass and comes back by
    join; both passes cut the files into the same blocks. The lines to skip must end within the first block
    (``spark.sql.files.maxPartitionBytes``); a file with fewer lines has none left.
    """
    raw = spark.read.text(path).select(
        F.col("value").alias("line"),
        F.col("_metadata.file_path").alias("__file"),
        F.col("_metadata.file_name").alias("__name"),
        F.col("_metadata.file_block_start").alias("__start"),
    )
    raw = raw.withColumn("__at", F.monotonically_increasing_id())
    first = raw.filter("__start = 0").groupBy(F.col("__file").alias("__of")).agg(F.min("__at").alias("__first"))
    joined = raw.join(first, (F.col("__file") == F.col("__of")) & (F.col("__start") == 0), "left")
    rest = joined.filter(F.col("__first").isNull() | (F.col("__at") - F.col("__first") >= lines))
    return rest.select("line", *([F.col("__name").alias(file_column)] if file_column else []))


def read_csv_after(
    spark: SparkSession, path, schema: StructType, lines: int, file_column: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """CSV files whose first ``lines`` lines (titles and header) are skipped by count: the rows, and the lines that cannot be read.

    Blank lines are left out. As with ``read_csv_preamble``, a field cannot hold a line break.
    """
    kept = [file_column] if file_column else []
    return _parsed(skip_lines(spark, path, lines, file_column).filter(F.trim("line") != ""), schema, kept)


def read_csv_preamble(
    spark: SparkSession, path, schema: StructType, title: str, file_column: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """CSV files with title lines above the header: the data rows, and the lines that could not be read.

    Known to be no data are blank lines, lines that match the pattern ``title`` as a whole, and the exact header
    (the schema's names, joined by commas). Every other line is a row, or else one of the rejects (``line`` and
    the file column): too few or too many fields, or a field that is not of its type. That needs no line numbers, so
    large files still split across tasks. A field cannot hold a line break.
    """
    raw = spark.read.text(path).withColumnRenamed("value", "line")
    if file_column:
        raw = raw.select("line", F.col("_metadata.file_name").alias(file_column))
    kept = [file_column] if file_column else []
    bare = F.trim(F.col("line"))
    data = raw.filter((bare != "") & ~bare.rlike(f"^(?:{title})$") & (bare != ",".join(schema.fieldNames())))
    return _parsed(data, schema, kept)


def _parsed(data: DataFrame, schema: StructType, kept: list[str]) -> tuple[DataFrame, DataFrame]:
    """Lines as typed rows, and the lines with too few or too many fields or one that is not of its type."""
    names = schema.fieldNames()
    text = StructType([StructField(n, StringType()) for n in names] + [StructField("__bad", StringType())])
    fields = F.from_csv("line", text.simpleString()[len("struct<") : -1].replace(":", " "), {"columnNameOfCorruptRecord": "__bad"})
    parsed = data.withColumn("__text", fields)
    given = {f.name: F.trim(F.col(f"__text.`{f.name}`")) for f in schema.fields}
    typed = {f.name: given[f.name].try_cast(f.dataType) for f in schema.fields}
    bad = F.col("__text.__bad").isNotNull()
    for n in names:
        bad = bad | (typed[n].isNull() & (F.coalesce(given[n], F.lit("")) != ""))
    good = parsed.filter(~bad).select(*[typed[n].alias(n) for n in names], *kept)
    return good, parsed.filter(bad).select("line", *kept)


def list_files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """Path, name, size and time of the files under a folder; the contents are not read."""
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", True)
        .load(path)
    )
    return files.select(
        F.col("path").alias("FullPath"),
        F.element_at(F.split("path", "/"), -1).alias("FileName"),
        F.col("length").alias("Size"),
        F.col("modificationTime").alias("LastWriteTime"),
    )


def inline_table(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A small lookup table written in the code."""
    return spark.createDataFrame(list(rows), schema)


def ingest_bronze(spark: SparkSession, manifest: Mapping[str, str], fmt: str = "csv", **options) -> dict[str, DataFrame]:
    """Open every listed source that exists; an absent path is skipped."""
    tables = {}
    for name, path in manifest.items():
        try:
            if fmt == "csv":
                tables[name] = read_csv(spark, path, **options)
            else:
                tables[name] = spark.read.format(fmt).options(**options).load(path)
        except AnalysisException as err:
            if err.getCondition() != "PATH_NOT_FOUND":
                raise
    return tables
