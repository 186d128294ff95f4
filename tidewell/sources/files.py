"""File readers: format by extension, selection by age, discovery streams."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# File extension to reader format, and each format's default options.
FORMAT_BY_EXTENSION = {
    "csv": "csv", "json": "json", "parquet": "parquet", "delta": "delta",
    "txt": "text", "text": "text", "avro": "avro",
}
DEFAULT_OPTIONS = {
    "csv": {"header": "true", "inferSchema": "true", "escape": '"', "sep": ","},
    "json": {"multiline": "true"},
    "parquet": {}, "delta": {}, "text": {}, "avro": {},
}


def format_of(path: str) -> str:
    """Reader format for a file name."""
    extension = path.rstrip("/").rsplit(".", 1)[-1].lower()
    if extension not in FORMAT_BY_EXTENSION:
        raise ValueError(f"Unknown file format: {path}")
    return FORMAT_BY_EXTENSION[extension]


def list_files(spark: SparkSession, path: str, recursive: bool = True) -> DataFrame:
    """One row per file: ``path, dir, name, modified_at, length``.

    The listing is Spark's own; file contents are not read.
    """
    listing = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", str(recursive).lower())
        .load(path)
    )
    return listing.select(
        "path",
        F.regexp_extract("path", r"^(.*)/[^/]+$", 1).alias("dir"),
        F.regexp_extract("path", r"([^/]+)$", 1).alias("name"),
        F.col("modificationTime").alias("modified_at"),
        "length",
    )


def without(files: DataFrame, exclude: Sequence[str] = ()) -> DataFrame:
    """Leave out files whose path contains one of the substrings."""
    for part in exclude:
        files = files.where(~F.col("path").contains(part))
    return files


def newest_per_dir(files: DataFrame) -> DataFrame:
    """The newest file of every directory; equal times go to the greater path."""
    latest = F.max(F.struct("modified_at", "path", "name", "length"))
    return files.groupBy("dir").agg(latest.alias("f")).select(
        "f.path", "dir", "f.name", "f.modified_at", "f.length")


def newest(files: DataFrame) -> DataFrame:
    """The single newest file."""
    return files.orderBy(F.desc("modified_at"), F.desc("path")).limit(1)


def select_files(spark: SparkSession, path: str | Sequence[str], policy: str = "all",
                 exclude: Sequence[str] = ()) -> DataFrame:
    """Files chosen by policy.

    ``single`` and ``list`` name files; ``all``, ``newest`` and
    ``newest_per_dir`` name a directory.
    """
    if policy in ("single", "list"):
        paths = [path] if isinstance(path, str) else list(path)
        chosen = list_files(spark, paths[0], recursive=False)
        for other in paths[1:]:
            chosen = chosen.unionByName(list_files(spark, other, recursive=False))
        return without(chosen, exclude)
    files = without(list_files(spark, path, recursive=policy == "newest_per_dir"), exclude)
    if policy == "all":
        return files
    if policy == "newest":
        return newest(files)
    if policy == "newest_per_dir":
        return newest_per_dir(files)
    raise ValueError(f"Unknown selection policy: {policy}")


def read_files(spark: SparkSession, path: str | Sequence[str], fmt: str | None = None,
               options: Mapping[str, str] | None = None, schema: T.StructType | None = None) -> DataFrame:
    """Batch read of a file, a directory or a list of files.

    Without ``fmt`` the extension decides; for a directory, that of its first
    visible file.  A declared schema switches inference off.
    """
    if fmt is None:
        first = path if isinstance(path, str) else path[0]
        try:
            fmt = format_of(first)
        except ValueError:
            listed = list_files(spark, first, recursive=False).agg(F.min("path")).first()[0]
            if listed is None:
                raise ValueError(f"No readable file in {first}") from None
            fmt = format_of(listed)
    if fmt not in DEFAULT_OPTIONS:
        raise ValueError(f"Unknown file format: {fmt}")
    defaults = dict(DEFAULT_OPTIONS[fmt])
    reader = spark.read.format(fmt)
    if schema is not None:
        defaults.pop("inferSchema", None)
        reader = reader.schema(schema)
    return reader.options(**{**defaults, **(options or {})}).load(path if isinstance(path, str) else list(path))


def file_stream(spark: SparkSession, path: str, options: Mapping[str, str] | None = None,
                schema: T.StructType | None = None, fmt: str | None = None) -> DataFrame:
    """Stream of newly discovered files.

    Options in the ``cloudFiles.`` namespace are accepted: its ``format`` picks the
    reader and the others lose the prefix.
    """
    plain: dict[str, str] = {}
    for name, value in (options or {}).items():
        short = name.removeprefix("cloudFiles.")
        if short == "format" and name != short:
            fmt = fmt or value
        else:
            plain[short] = value
    reader = spark.readStream.format(fmt or "parquet").options(**plain)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)
