"""Report files, and runs whose files appear together."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..params import ReportParams
from ..plans.domains import HEADINGS
from .versions import VersionedFolder


def with_headings(df: DataFrame) -> DataFrame:
    """Published column headings, which may hold spaces and percent signs."""
    return df.select(*(F.col(c).alias(HEADINGS.get(c, c)) for c in df.columns))


def write_report(
    df: DataFrame,
    name: str,
    params: ReportParams,
    null_token: str | None = None,
    single_file: bool = False,
    headings: bool = True,
    order: Sequence[str] = (),
) -> str:
    """Write a report as CSV with a header and return its folder.

    The folder carries the report name and the week.  ``single_file`` is for tables
    whose row count is bounded by months, brands, categories or centres, sorted by ``order``
    with missing values last; others keep one file per task.
    """
    path = f"{params.out_dir}/{name}_WE_{params.eow}.csv"
    out = with_headings(df) if headings else df
    if single_file:
        # A shuffle, so that the aggregate above keeps its tasks; then the file's own order.
        out = out.repartition(1)
        if order:
            out = out.sortWithinPartitions(
                *(F.col(f"`{HEADINGS.get(c, c) if headings else c}`").asc_nulls_last() for c in order)
            )
    writer = out.write.mode("overwrite").option("header", True).option("escape", '"')
    if null_token is not None:
        writer = writer.option("nullValue", null_token)
    writer.csv(path)
    return path


def tee(df: DataFrame, path: str) -> DataFrame:
    """Write a CSV copy and pass the table on, read back from that copy: it is computed once."""
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
    return df.sparkSession.read.schema(df.schema).option("header", True).option("escape", '"').csv(path)


def write_book(tables: Mapping[str, DataFrame], path: str) -> dict[str, str]:
    """Several tables under one folder, one sub-folder each."""
    paths = {name: f"{path}/{name.replace(' ', '_')}" for name in tables}
    for name, df in tables.items():
        with_headings(df).write.mode("overwrite").option("header", True).csv(paths[name])
    return paths


def publish_run(
    spark: SparkSession,
    params: ReportParams,
    name: str,
    write: Callable[[ReportParams], dict[str, str]],
) -> dict[str, str]:
    """Write the files of a run and publish them together.

    ``write`` gets parameters whose output folder is new, and returns the path of each table.
    The run is published when all of them are written; if one fails, the files of the last
    run stay the published ones, all of them.  Returns the published paths.
    """
    runs = VersionedFolder(spark, f"{params.out_dir}/{name}")
    folder = runs.new_folder()
    try:
        paths = write(replace(params, out_dir=folder))
    except Exception:
        runs.drop(folder)
        raise
    runs.publish(folder, {table: path.removeprefix(f"{folder}/") for table, path in paths.items()})
    runs.clean()
    return paths


def published_files(spark: SparkSession, params: ReportParams, name: str) -> dict[str, str]:
    """The paths of the last whole run, by table; empty if there is none."""
    current = VersionedFolder(spark, f"{params.out_dir}/{name}").current()
    return {t: f"{current.folder}/{file}" for t, file in current.notes.items()} if current else {}
