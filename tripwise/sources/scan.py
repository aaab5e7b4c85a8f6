"""Scans of the raw and processed zones."""

from __future__ import annotations

import re

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .load import align_schema
from .sinks import file_system, list_names

FILE_PATH, FILE_NAME, FILE_SIZE = "SOURCE_FILE", "SOURCE_NAME", "SOURCE_SIZE"


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Columnar scan; filters and projections on the result reach the
    Parquet reader (pushed filters, pruned read schema)."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(path)


def decoded(path: Column) -> Column:
    """A stored name from its URI form.  Only percent escapes are decoded: a
    plus sign stands for itself in a path."""
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


def with_source(df: DataFrame) -> DataFrame:
    """Attach the file each row came from (hidden metadata column, decoded)."""
    return df.withColumns({FILE_PATH: decoded(F.col("_metadata.file_path")),
                           FILE_NAME: decoded(F.col("_metadata.file_name"))})


def no_data(error: AnalysisException) -> bool:
    """Whether a scan failed because there is no such path, or no file in it
    to take a schema from; any other failure is a failure."""
    return error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def scan_prefix(spark: SparkSession, root: str, schema: T.StructType | None = None,
                glob: str = "*.parquet") -> DataFrame | None:
    """All files below ``root`` whose name matches ``glob``, read as one
    table with their source path.  A missing prefix, or one without files,
    gives ``None`` (nothing to load); anything else that is wrong with it
    fails."""
    reader = (spark.read.option("recursiveFileLookup", "true")
              .option("pathGlobFilter", glob))
    if schema is not None:
        reader = reader.schema(schema)
    try:
        return with_source(reader.parquet(root))
    except AnalysisException as error:
        if no_data(error):
            return None
        raise


def scan_tables(spark: SparkSession, root: str, names: list[str]) -> dict[str, DataFrame]:
    """One DataFrame per table folder under ``root``; folders that are not
    there and tables without rows are skipped.  A damaged file fails the scan
    rather than losing its rows unseen."""
    out: dict[str, DataFrame] = {}
    for name in names:
        try:
            df = spark.read.parquet(f"{root}/{name}")
        except AnalysisException as error:
            if no_data(error):
                continue
            raise
        if not df.isEmpty():
            out[name] = df
    return out


def scan_csv(spark: SparkSession, root: str, schema: T.StructType,
             exclude: tuple[str, ...] = ("poi",), skip_suffixes: tuple[str, ...] = (".zip",)) -> DataFrame:
    """The CSV datasets at and below ``root``, by header.

    All files are listed at any depth; those of one folder (``root`` itself
    too) are a dataset, with the files of its ``key=value`` folders.  Each
    dataset is scanned for itself: its columns are found by the names in
    its header, whatever their order, and cast to ``schema`` leniently; files
    of a dataset whose headers differ fail the scan.  Folders and files whose
    name contains an excluded word or ends with a skipped suffix are left out
    while listing, before any byte is read.  A missing root gives no rows; one
    that is there but holds no dataset fails."""
    def wanted(name: str) -> bool:
        return not any(w in name for w in exclude) and not name.endswith(tuple(skip_suffixes))

    names_below = list_names(spark, root)
    if names_below is None:
        source = T.StructType([*schema.fields, T.StructField(FILE_PATH, T.StringType()), T.StructField(FILE_NAME, T.StringType())])
        return spark.createDataFrame([], source)
    datasets: dict[tuple[str, ...], list[str]] = {}
    for parts in names_below:
        if all(map(wanted, parts)):
            folder = parts[:-1]
            while folder and "=" in folder[-1]:
                folder = folder[:-1]
            datasets.setdefault(folder, []).append(literal_path("/".join((root.rstrip("/"), *parts))))
    if not datasets:
        raise FileNotFoundError(f"no CSV dataset at or below {root}")
    out = None
    for _, files in sorted(datasets.items()):
        reader = spark.read.option("header", "true").option("basePath", root)
        text = T.StructType([T.StructField(c, T.StringType()) for c in reader.csv(files).columns])
        df = with_source(reader.option("enforceSchema", "false").schema(text).csv(files))
        part = align_schema(df, schema, keep_extra=True)
        part = part.select(*[f.name for f in schema.fields], FILE_PATH, FILE_NAME)
        out = part if out is None else out.unionByName(part)
    return out


def literal_path(path: str) -> str:
    """``path`` so that none of its characters is read as a pattern."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)


def plain_path(path: Column) -> Column:
    """A path without scheme and host, however many slashes follow them."""
    return F.regexp_replace(path, "^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?/+", "/")


def relative_path(spark: SparkSession, path: Column, root: str) -> Column:
    """Part of a (decoded) file path below ``root``, which may be relative or
    spelt with another scheme form."""
    fs, hpath, _ = file_system(spark, root)
    base = re.sub("^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?/+", "/", str(fs.makeQualified(hpath).toString())).rstrip("/")
    inside = plain_path(path)
    return F.when(inside.startswith(base + "/"), F.substring(inside, len(base) + 2, F.char_length(inside)))


def is_gps_file(name_col) -> "F.Column":
    return F.lower(name_col).contains("gps")


def list_files(spark: SparkSession, root: str, glob: str = "*") -> DataFrame:
    """Distributed file listing with sizes (content is never read), including
    files that hold no rows."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
            .option("pathGlobFilter", glob).load(root)
            .select(F.col("path").alias(FILE_PATH), F.col("length").alias(FILE_SIZE)))
