"""Table readers: aliased and incremental scans, high-water mark, staging."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.session import scratch_path


def source_of(target_name: str, aliases: Mapping[str, str]) -> str:
    """Source column behind a target name; case and outer blanks do not matter.

    ``aliases`` maps source name to target name.
    """
    wanted = target_name.strip().lower()
    for source, target in aliases.items():
        if target.strip().lower() == wanted:
            return source
    raise ValueError(f"No source column is mapped to {target_name!r}")


def aliased_scan(df: DataFrame, columns: Sequence[str], aliases: Mapping[str, str] | None = None) -> DataFrame:
    """Declared source columns, in declared order, under their target names."""
    aliases = aliases or {}
    return df.select(*[F.col(f"`{name}`").alias(aliases.get(name, name)) for name in columns])


def incremental_scan(df: DataFrame, columns: Sequence[str], aliases: Mapping[str, str],
                     watermark: str | None = None, after: Any = None) -> DataFrame:
    """Aliased scan of the rows strictly after a watermark value.

    ``watermark`` is a target name.  The value is cast to the column's own type,
    so the comparison stays between a bare column and a literal and reaches the
    source as a pushed filter.  No watermark or no value means a full scan.
    """
    if watermark is not None:
        source = source_of(watermark, aliases)
        if after is not None:
            df = df.where(F.col(f"`{source}`") > F.lit(after).cast(df.schema[source].dataType))
    return aliased_scan(df, columns, aliases)


def open_table(spark: SparkSession, name_or_path: str) -> DataFrame | None:
    """A catalog table, or parquet when the name holds a slash; None if missing."""
    try:
        if "/" in name_or_path:
            return spark.read.parquet(name_or_path)
        return spark.table(name_or_path) if spark.catalog.tableExists(name_or_path) else None
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def high_watermark_frame(target: DataFrame, column: str, initial: Any = None) -> DataFrame:
    """One row, one column: the greatest watermark, or ``initial`` if there is none."""
    top = F.max(f"`{column}`")
    if initial is not None:
        top = F.coalesce(top, F.lit(initial).cast(target.schema[column].dataType))
    return target.agg(top.alias(column))


def high_watermark(target: DataFrame | None, column: str | None = None, initial: Any = None) -> Any:
    """The value to resume from; ended rows count too.  None without a column."""
    if column is None:
        return None
    if target is None:
        return initial
    return high_watermark_frame(target, column, initial).first()[0]


def current_rows(df: DataFrame, end_column: str = "end_at") -> DataFrame:
    """Open versions only; a table without the end column is returned as it is."""
    return df.where(F.col(end_column).isNull()) if end_column in df.columns else df


def stage(df: DataFrame, enabled: bool = True, path: str | None = None) -> DataFrame:
    """Write the extraction once and read it back.

    Later passes then see one frozen snapshot and do not query the source again.
    The default place is the shared scratch folder.
    """
    if not enabled:
        return df
    spark = df.sparkSession
    path = path or scratch_path(spark, "stage")
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def staged_table(df: DataFrame, table: str, enabled: bool = True) -> Iterator[DataFrame]:
    """As :func:`stage`, but in a catalog table that is dropped at the end."""
    if not enabled:
        yield df
        return
    spark = df.sparkSession
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    df.write.format("parquet").saveAsTable(table)
    try:
        yield spark.table(table)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
