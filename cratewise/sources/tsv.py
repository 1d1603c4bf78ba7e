"""Tab-separated dump files: scan, table-set load, audit and writer."""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cratewise.sources.manifest import TableSpec

NULL_TEXT = r"\N"

# File suffixes that are looked for in turn; Spark unpacks by suffix, and bz2 files split.
COMPRESSED = ("", ".bz2", ".gz", ".zst")


def scan_tsv(
    spark: SparkSession,
    path: str,
    spec: TableSpec,
    keep: Sequence[str] | None = None,
    raw_line: str | None = None,
) -> DataFrame:
    """Typed scan of one headerless file, with the kept columns only.

    ``\\N`` is NULL and the empty text is not; quotes and backslashes are plain characters; short rows
    are padded with NULL, extra fields and blank lines are ignored. A value that does not fit the
    type of a kept column fails the job, whatever the session's ANSI setting; pruned columns are never
    looked at. Spark's CSV reader cannot tell the empty text from NULL, hence the text source. ``raw_line`` names an extra
    column that holds the untouched line.
    """
    kept = spec.keep if keep is None else keep
    lines = spark.read.text(path, lineSep="\n").filter(F.col("value") != "")
    fields = lines.select("value", F.split("value", "\t", -1).alias("fields"))
    columns = []
    for name in kept:
        column = spec.column(name)
        text = F.get("fields", F.lit(column.position))
        columns.append(_typed(F.nullif(text, F.lit(NULL_TEXT)), column.dtype, name).alias(name))
    if raw_line is not None:
        columns.append(F.col("value").alias(raw_line))
    return fields.select(*columns)


def _typed(text: Column, kind: str, name: str) -> Column:
    """``text`` as a value of that type; an error if it is none."""
    value = text.try_cast(kind)
    message = F.concat(F.lit(f"CAST_INVALID_INPUT: {name} is no {kind}: "), text)
    return F.when(text.isNotNull() & value.isNull(), F.raise_error(message).cast(kind)).otherwise(value)


def _find(spark: SparkSession, path: str, *scan: object) -> DataFrame | None:
    """Scan of a file or of its compressed form, by suffix; None if there is neither."""
    for suffix in COMPRESSED:
        try:
            return scan_tsv(spark, f"{path}{suffix}", *scan)
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
    return None


def load_all(
    spark: SparkSession,
    directory: str,
    manifest: Mapping[str, TableSpec],
    keep: Mapping[str, Sequence[str]] | None = None,
    raw_line: str | None = None,
    absent: Collection[str] = (),
) -> dict[str, DataFrame]:
    """Every table of the manifest, plain or compressed.

    A missing file raises ``FileNotFoundError``, except for the tables named in ``absent``, which then
    are empty frames of the declared schema. ``keep`` overrides the kept columns table by table.
    """
    keep = keep or {}
    tables, missing = {}, []
    for name, spec in manifest.items():
        columns = keep.get(name)
        found = _find(spark, f"{directory}/{spec.file_name}", spec, columns, raw_line)
        if found is None and name in absent:
            schema = spec.schema(columns)
            if raw_line is not None:
                schema = schema.add(raw_line, "string")
            found = spark.createDataFrame([], schema)
        if found is None:
            missing.append(spec.file_name)
        else:
            tables[name] = found
    if missing:
        raise FileNotFoundError(f"{directory} lacks {', '.join(missing)}")
    return tables


def load_audit(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``(table_name, row_count)`` of every table, counted in one job."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def with_dump_version(df: DataFrame, version: str) -> DataFrame:
    """Tag every row with the version of the dump it came from."""
    return df.withColumn("dump_version", F.lit(version))


def to_tsv_lines(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Lines in the dump dialect, at full width; columns the frame lacks are written as NULL.

    Values go out as they are, as :func:`scan_tsv` reads them: escaping tabs and line breaks is up to
    the caller.
    """
    ordered = sorted(spec.columns, key=lambda c: c.position)
    texts = [
        F.coalesce(F.col(c.name).cast("string"), F.lit(NULL_TEXT))
        if c.name in df.columns
        else F.lit(NULL_TEXT)
        for c in ordered
    ]
    return df.select(F.concat_ws("\t", *texts).alias("value"))


def write_tsv(df: DataFrame, path: str, spec: TableSpec) -> None:
    to_tsv_lines(df, spec).write.mode("overwrite").text(path)
