"""Folder snapshots: ``<root>/<day>/<entity>/*.{json,csv,parquet}`` as one DataFrame per entity and day.

Files of one folder may differ in layout. A first pass over their lines (no parsing) gives each text file its class: JSON lines or one
JSON document, and the header of a CSV file. Files of one class are then read together, so that no record is lost and no column
lands under another one's name.
"""

from __future__ import annotations

import csv
import re
from collections.abc import Sequence
from functools import reduce
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import field_type
from tidemark.schemas import CORRUPT, MISTYPED, empty

LINEAGE = T.StructField("source_path", T.StringType())
FORMATS = ("json", "csv", "parquet")
FILE = "_metadata.file_path"
#: What Spark says of Parquet files with one column of several types.
DISAGREE = {"CANNOT_MERGE_SCHEMAS", "CANNOT_MERGE_INCOMPATIBLE_DATA_TYPE"}
NOTHING_THERE = {"PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"}


def snapshot_schema(entity: T.StructType) -> T.StructType:
    """What a read returns: the entity's fields, the text of a record that did not parse, and its file."""
    return T.StructType([*entity.fields, T.StructField(CORRUPT, T.StringType()), LINEAGE])


def union_fill(frames: list[DataFrame]) -> DataFrame:
    """Union by column name; a column one side lacks is null there."""
    return reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), frames)


def unwrap_results(df: DataFrame, envelope: str = "results") -> DataFrame:
    """Promote the records of an API envelope to rows; a frame without the envelope passes unchanged."""
    if envelope not in df.columns:
        return df
    return df.select(F.inline(envelope))


def wrap_row(df: DataFrame, alias: str = "t") -> DataFrame:
    """The whole row as one struct, so that bare and unwrapped records share the same paths."""
    return df.select(F.struct("*").alias(alias))


def select_day(df: DataFrame, day: str, column: str = "day") -> DataFrame:
    """One day of a frame that holds many; on a day-partitioned table this prunes to that partition."""
    return df.filter(F.col(column) == F.lit(day).cast(df.schema[column].dataType))


def _from_text(df: DataFrame, field: T.StructField) -> Column:
    """A CSV cell as the declared type: scalars by cast, nested values from their JSON text."""
    if field.name not in df.columns:
        return F.lit(None).cast(field.dataType).alias(field.name)
    cell = F.col(f"`{field.name}`")
    nested = isinstance(field.dataType, (T.StructType, T.ArrayType, T.MapType))
    return (F.from_json(cell, field.dataType) if nested else cell.try_cast(field.dataType)).alias(field.name)


def _from_native(df: DataFrame, field: T.StructField) -> Column:
    if field.name not in df.columns:
        return F.lit(None).cast(field.dataType).alias(field.name)
    column = F.col(f"`{field.name}`")
    if df.schema[field.name].dataType == field.dataType:
        return column
    if isinstance(field.dataType, (T.StructType, T.MapType)):
        # A nested value whose layout differs is brought over field by field, by name.
        return F.from_json(F.to_json(column), field.dataType).alias(field.name)
    return column.try_cast(field.dataType).alias(field.name)


def page_schema(entity: T.StructType) -> T.StructType:
    """Schema under which a bare record and a ``{"results": [...]}`` page both parse."""
    return T.StructType([
        *entity.fields,
        T.StructField("results", T.ArrayType(entity)),
        T.StructField(CORRUPT, T.StringType()),
    ])


def page_records(raw: DataFrame, entity: T.StructType, path: Column | None = None) -> DataFrame:
    """Rows of the entity from bare records and pages, mixed as they come, with lineage (``path``, else the file's).

    When one record of a multi-line file has a mistyped field, Spark reports the text of the whole file with every
    record in it. The text is kept where nothing could be parsed. Records that did parse are good but for that field,
    which is null; a remark stands for the text there, and the path tells the file.
    """
    names = entity.fieldNames()
    parsed = F.coalesce(F.col("results").isNotNull(), F.lit(False))
    for name in names:
        parsed = parsed | F.col(f"`{name}`").isNotNull()
    trouble = F.when(F.col(CORRUPT).isNotNull() & parsed, F.lit(MISTYPED)).otherwise(F.col(CORRUPT))
    records = F.coalesce(F.col("results"), F.array(F.struct(*[F.col(f"`{name}`") for name in names])))
    return raw.select(
        F.explode(records).alias("r"), trouble.alias(CORRUPT), (F.col(FILE) if path is None else path).alias("source_path")
    ).select("r.*", CORRUPT, "source_path")


def _of_files(raw: DataFrame, files: Sequence[str] | None, without: Sequence[str] = ()) -> DataFrame:
    """Rows of some files; Spark leaves out the others when it lists them."""
    if files is not None:
        raw = raw.filter(F.col(FILE).isin(list(files)))
    return raw.filter(~F.col(FILE).isin(list(without))) if without else raw


def listing(spark: SparkSession, root: str, day: str, entity: str) -> DataFrame:
    """``source_path, length, modified`` of the files that a read would take; their contents are not read."""
    shape = "source_path string, length bigint, modified timestamp"
    try:
        files = spark.read.format("binaryFile").option("pathGlobFilter", f"*.{{{','.join(FORMATS)}}}").load(_folder(root, day, entity))
    except AnalysisException as error:
        if error.getCondition() not in NOTHING_THERE:
            raise
        return spark.createDataFrame([], shape)
    return files.select(F.col(FILE).alias("source_path"), "length", F.col("modificationTime").alias("modified"))


def _first_lines(spark: SparkSession, path: str, glob: str, files: Sequence[str] | None) -> DataFrame:
    """``file, head, lines``: each file's first line that is not blank, and how many such lines it has."""
    text = _of_files(spark.read.option("pathGlobFilter", glob).text(path), files)
    placed = text.filter(F.trim("value") != "").select(
        F.col(FILE).alias("file"), "value", F.struct(F.col("_metadata.file_block_start"), F.monotonically_increasing_id().alias("n")).alias("at")
    )
    return placed.groupBy("file").agg(F.min_by("value", "at").alias("head"), F.count(F.lit(1)).alias("lines"))


def _json_lines_files(spark: SparkSession, path: str, files: Sequence[str] | None) -> list[str]:
    """Files of several lines whose first line is a whole JSON value by itself."""
    whole = F.when(F.col("lines") > 1, F.expr("try_parse_json(head)").isNotNull())
    return [row.file for row in _first_lines(spark, path, "*.json", files).filter(whole).select("file").collect()]


def _read_json(
    spark: SparkSession, path: str, entity: T.StructType, multiline: bool, files: Sequence[str] | None = None, without: Sequence[str] = ()
) -> DataFrame:
    raw = (
        spark.read.schema(page_schema(entity))
        .option("multiLine", multiline)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("pathGlobFilter", "*.json")
        .json(path)
    )
    return page_records(_of_files(raw, files, without), entity)


def _json_by_layout(spark: SparkSession, path: str, entity: T.StructType, multiline: bool | None, files: Sequence[str] | None) -> list[DataFrame]:
    if multiline is not None:
        return [_read_json(spark, path, entity, multiline, files)]
    lines = _json_lines_files(spark, path, files)
    documents = _read_json(spark, path, entity, True, files, lines)
    return [documents, _read_json(spark, path, entity, False, lines)] if lines else [documents]


def csv_layout(header: str) -> T.StructType:
    """Columns of a CSV header line, all text, and one for lines that don't fit; unnamed and repeated ones get their number."""
    names: list[str] = []
    for k, name in enumerate(next(csv.reader([header.lstrip("\ufeff")]), [])):
        names.append(name if name and name not in {*names, CORRUPT} else f"_c{k}")
    return T.StructType([T.StructField(name, T.StringType()) for name in [*names, CORRUPT]])


def text_records(raw: DataFrame, entity: T.StructType, path: Column) -> DataFrame:
    """Rows of the entity from text cells; a line with too few or too many cells keeps its text."""
    return raw.select(
        *[_from_text(raw, field) for field in entity], F.col(CORRUPT), path.alias("source_path")
    )


def csv_lines(lines: DataFrame, entity: T.StructType, headers: Sequence[str], line: str = "line", header: str = "header") -> DataFrame:
    """Rows of the entity from CSV lines at hand, each with the header of its file; ``headers`` are those that occur."""
    frames = []
    for text in headers:
        own = lines.filter(F.col(header) == text)
        cells = own.select(F.from_csv(line, csv_layout(text).simpleString()[7:-1].replace(":", " "), {"columnNameOfCorruptRecord": CORRUPT}).alias("r"))
        frames.append(text_records(cells.select("r.*"), entity, F.lit(None).cast("string")))
    return union_fill(frames)


def _csv_by_layout(spark: SparkSession, path: str, entity: T.StructType, files: Sequence[str] | None) -> list[DataFrame]:
    """One read for each header that occurs."""
    heads = _first_lines(spark, path, "*.csv", files).groupBy("head").agg(F.collect_list("file").alias("files")).collect()
    frames = []
    for row in sorted(heads, key=lambda r: r["head"]):
        # Without pruning the parser sees all cells of a line, and tells when their number is wrong.
        raw = (
            spark.read.schema(csv_layout(row["head"]))
            .option("header", True)
            .option("columnPruning", False)
            .option("columnNameOfCorruptRecord", CORRUPT)
            .option("pathGlobFilter", "*.csv")
            .csv(path)
        )
        frames.append(text_records(_of_files(raw, row["files"]), entity, F.col(FILE)))
    return frames


def native_records(raw: DataFrame, entity: T.StructType, path: Column) -> DataFrame:
    """Rows of the entity from typed columns, bare or in pages."""

    def own(df: DataFrame, at: Column) -> DataFrame:
        return df.select(*[_from_native(df, field) for field in entity], F.lit(None).cast("string").alias(CORRUPT), at.alias("source_path"))

    if not isinstance(field_type(raw.schema, "results"), T.ArrayType) or "results" in entity.fieldNames():
        return own(raw, path)
    pages = raw.filter(F.col("results").isNotNull()).select(F.explode("results").alias("r"), path.alias("_path")).select("r.*", "_path")
    return own(raw.filter(F.col("results").isNull()), path).unionByName(own(pages, F.col("_path")))


def _parquet_by_layout(spark: SparkSession, path: str, entity: T.StructType, files: Sequence[str] | None) -> list[DataFrame]:
    """All files as one frame with all their columns; where they disagree on a type, one frame for each schema."""
    reader = spark.read.option("pathGlobFilter", "*.parquet")
    try:
        return [native_records(_of_files(reader.option("mergeSchema", True).parquet(path), files), entity, F.col(FILE))]
    except (PySparkException, Py4JJavaError) as error:
        # Footers are merged in a job, so the condition may stand in the failed task's message only.
        if not any(condition in str(error) for condition in DISAGREE):
            raise
    named = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
    groups: dict[str, tuple[T.StructType, list[str]]] = {}
    for row in _of_files(named.select(F.col(FILE).alias("file"), "_metadata"), files).select("file").collect():
        plain = re.sub(r"([\[\]{}*?\\])", r"\\\1", unquote(row["file"]))
        schema = spark.read.parquet(plain).schema
        groups.setdefault(schema.json(), (schema, []))[1].append(row["file"])
    return [
        native_records(_of_files(reader.schema(schema).parquet(path), own), entity, F.col(FILE)) for schema, own in groups.values()
    ]


def _folder(root: str, day: str, entity: str) -> str:
    return f"{root.rstrip('/')}/{day}/{entity}"


def read_entity(
    spark: SparkSession,
    root: str,
    day: str,
    entity: str,
    schema: T.StructType,
    multiline: bool | None = None,
    files: Sequence[str] | None = None,
) -> DataFrame:
    """Every file of one entity on one day, whatever of JSON, CSV and Parquet lies there.

    The schema is declared, so no data is read to infer it. A folder that is absent or holds no file of a format
    yields an empty frame of the right shape; any other read error is raised. JSON files are told apart by their first line; ``multiline``
    declares them all to be documents or JSON lines, and saves the pass that tells. A document is parsed by one task, so large
    dumps should come as many pages or as JSON lines, which Spark splits. ``files`` (paths as in ``listing``) restricts the read.
    """
    path = _folder(root, day, entity)
    readers = {
        "json": lambda: _json_by_layout(spark, path, schema, multiline, files),
        "csv": lambda: _csv_by_layout(spark, path, schema, files),
        "parquet": lambda: _parquet_by_layout(spark, path, schema, files),
    }
    frames = []
    for name in FORMATS:
        try:
            frames += readers[name]()
        except AnalysisException as error:
            if error.getCondition() not in NOTHING_THERE:
                raise
    return union_fill(frames) if frames else empty(spark, snapshot_schema(schema))


def infer_entity(
    spark: SparkSession, root: str, day: str, entity: str, sampling: float = 1.0
) -> DataFrame | None:
    """The same folder with the schema taken from the files, for dumps whose layout is not known beforehand.

    Inference reads the data once more; ``sampling`` sets the share of it. None where there is no file at all.
    """
    path = f"{root.rstrip('/')}/{day}/{entity}"
    options = {
        "json": {"multiLine": True, "samplingRatio": sampling},
        "csv": {"header": True, "inferSchema": True, "samplingRatio": sampling},
        "parquet": {},
    }
    frames = []
    for name in FORMATS:
        try:
            reader = spark.read.options(**options[name]).option("pathGlobFilter", f"*.{name}")
            raw = reader.format(name).load(path)
        except AnalysisException as error:
            if error.getCondition() not in NOTHING_THERE:
                raise
            continue
        if raw.columns:
            frames.append(raw.select("*", F.col("_metadata.file_path").alias("source_path")))
    if not frames:
        return None
    return union_fill([_unwrap_keeping_path(frame) for frame in frames])


def _unwrap_keeping_path(df: DataFrame) -> DataFrame:
    if "results" not in df.columns:
        return df
    return df.select(F.explode("results").alias("r"), "source_path").select("r.*", "source_path")
