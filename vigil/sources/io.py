"""Sources and sinks.

Everything here is a thin, declarative use of the DataFrame reader/writer:
schemas are given up front (no inference pass over the data), casts happen in
one ``select`` so Catalyst can prune and push filters through them.
"""
from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

DRIVER_TABLES = ("region nation customer supplier part orders lineitem events documents "
                 "embeddings pages benchmark labels conversations").split()


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet table ``{sf_dir}/{name}.parquet`` (lazy; pruning/pushdown apply)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


class Tables:
    """Lazy accessor: ``t = Tables(spark, dir); t.orders``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name in DRIVER_TABLES:
            return read_table(self.spark, self.sf_dir, name)
        raise AttributeError(name)


# S1 ---------------------------------------------------------------------------
def read_delimited(spark: SparkSession, path: str, schema: T.StructType | str,
                   sep: str = "\t", escape: str = "\\", header: bool = False, mode: str = "FAILFAST") -> DataFrame:
    """Headerless delimited scan with names assigned by an explicit schema.  A
    cell that doesn't parse fails the read; ``mode="PERMISSIVE"`` asks for NULL."""
    return (spark.read.schema(schema).option("sep", sep).option("escape", escape)
            .option("header", str(header).lower()).option("mode", mode).csv(path))


# S2 ---------------------------------------------------------------------------
def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """CSV with a header row.  With a ``schema`` a cell that doesn't parse fails
    the read; without one every column is text under its own header (no
    inference pass, codes keep their leading zeros): see ``cast_columns``."""
    r = spark.read.option("header", "true")
    return (r.schema(schema).option("mode", "FAILFAST") if schema is not None else r).csv(path)


def cast_columns(df: DataFrame, types: dict[str, str], on_error: str = "fail") -> DataFrame:
    """Casts the named text columns (blank cells are NULL), the others stay text."""
    cell = lambda c: F.when(F.trim(F.col(c)) == "", None).otherwise(F.col(c))
    return df.withColumns({c: _cast(cell(c), t, on_error) for c, t in types.items() if c in df.columns})


# S4 / S5 ----------------------------------------------------------------------
_CAMEL = re.compile(r"(?<=[a-z0-9])(?=[A-Z])")
_NON_WORD = re.compile(r"[^a-z0-9]+")


def snake_case(name: str) -> str:
    """``"Incident Date (eTimes.03)"`` -> ``"incident_date_e_times_03"``."""
    s = _CAMEL.sub("_", name.strip()).lower()
    s = _NON_WORD.sub("_", s).strip("_")
    return s or "x"


def _dedupe(names: Sequence[str]) -> list[str]:
    seen: dict[str, int] = {}
    out = []
    for n in names:
        if n in seen:
            seen[n] += 1
            out.append(f"{n}_{seen[n]}")
        else:
            seen[n] = 1
            out.append(n)
    return out


def clean_names(df: DataFrame) -> DataFrame:
    """Normalise every column name to snake_case (metadata only)."""
    return df.toDF(*_dedupe([snake_case(c) for c in df.columns]))


def rename_with(df: DataFrame, fn: Callable[[str], str]) -> DataFrame:
    """Rename all columns with a function (metadata only)."""
    return df.toDF(*_dedupe([fn(c) for c in df.columns]))


# S3 ---------------------------------------------------------------------------
_TYPE_ALIASES = {"int": "int", "integer": "int", "bigint": "bigint", "long": "bigint",
                 "double": "double", "float": "double", "number": "double", "string": "string",
                 "str": "string", "any": "string", "date": "date", "bool": "boolean",
                 "boolean": "boolean", "timestamp": "timestamp_ntz", "datetime": "timestamp_ntz",
                 "time": "time_of_day"}


def _cast(c: Column, t: str, on_error: str) -> Column:
    t = _TYPE_ALIASES.get(t.lower(), t)
    if t == "time_of_day":
        # clock text "H:mm:ss[.ffffff]" -> microseconds of day
        txt = F.concat(F.lit("1970-01-01 "), F.trim(c))
        # validate with try_to_timestamp, convert with to_timestamp_ntz: no session-zone round trip
        ntz = F.when(F.call_function("try_to_timestamp", txt).isNotNull(), F.to_timestamp_ntz(txt))
        us = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), ntz)
        if on_error == "fail":
            return F.when(c.isNull() | (F.trim(c) == ""), None).otherwise(
                F.coalesce(us, F.raise_error(F.concat(F.lit("bad time cell: "), c))))
        return us
    if on_error == "fail":
        return c.cast(t)
    return c.try_cast(t)


def header_from_first_row(df: DataFrame, order_col: str) -> DataFrame:
    """A text grid whose first row (by ``order_col``, e.g. the sheet row
    number) holds the column names: that one row becomes the header and is
    removed from the data (only that row reaches the driver).  Rows that share
    its number, or have none, stay."""
    first = df.orderBy(F.asc_nulls_last(order_col)).limit(1).collect()
    if not first:
        raise ValueError("empty grid: no header row")
    row = first[0].asDict()
    cols = [c for c in df.columns if c != order_col]
    names = _dedupe([str(row[c]) if row[c] is not None else f"column_{i + 1}" for i, c in enumerate(cols)])
    same = F.lit(True)
    for c in df.columns:
        same = same & F.col(f"`{c}`").eqNullSafe(F.lit(row[c]))
    return df.where(~same).select(*[F.col(f"`{c}`") for c in cols]).toDF(*names)


def apply_type_spec(df: DataFrame, types: Sequence[str], clean_up: bool = True,
                    on_error: str = "fail", blank_as_null: bool = True) -> DataFrame:
    """Typed ingest of an all-text table: positional type list, length check,
    null-preserving cast in ONE select, optional name cleaning.

    An unparseable cell raises (the reference's convert behaviour);
    ``on_error="null"`` asks for NULL instead (``try_cast``)."""
    if len(types) != len(df.columns):
        raise ValueError(f"type spec has {len(types)} entries, table has {len(df.columns)} columns")
    cols = []
    for name, t in zip(df.columns, types):
        c = F.col(f"`{name}`")
        if blank_as_null:
            c = F.when(F.trim(c.cast("string")) == "", None).otherwise(c.cast("string"))
        cols.append(_cast(c, t, on_error).alias(name))
    out = df.select(*cols)
    return clean_names(out) if clean_up else out


# S6 / S7 / S8 -----------------------------------------------------------------
def _complete(spark: SparkSession, path: str) -> bool:
    """Whether a finished write left ``path``: its folder holds ``_SUCCESS``.
    Asked of the path's own file system (Spark's readers hide such files);
    errors other than "not there" are raised."""
    jvm = spark.sparkContext._jvm
    marker = jvm.org.apache.hadoop.fs.Path(path, "_SUCCESS")
    return marker.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(marker)


def write_table(df: DataFrame, path: str, mode: str = "overwrite", fmt: str = "parquet",
                single_file: bool = False, partition_by: Sequence[str] | None = None) -> None:
    """Table sink.  ``mode="overwrite"`` replaces (S7), ``"errorifexists"``
    creates only (S8).  ``single_file`` is for small report tables only."""
    w = (df.repartition(1) if single_file else df).write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w.option("header", "true").csv(path)
    else:
        w.format(fmt).save(path)


def materialize(spark: SparkSession, path: str, build_fn: Callable[[], DataFrame],
                mode: str = "reuse") -> DataFrame:
    """Cached-table load: reuse the stored result when a finished write left
    one (``_SUCCESS``), otherwise build, write and re-read it.  The re-read also cuts lineage, so a lost
    executor recomputes from the written table, not from the raw inputs."""
    if mode == "reuse" and _complete(spark, path):
        return spark.read.parquet(path)
    write_table(build_fn(), path, mode="overwrite")
    return spark.read.parquet(path)


# S9 ---------------------------------------------------------------------------
def literal_table(spark: SparkSession, rows: Iterable[Sequence], schema: T.StructType | str) -> DataFrame:
    """Small literal table (manual rows, exclusion lists, code maps); typed
    NULL columns come from the schema.  Its size is fixed by the code that
    builds it, so it is always safe to broadcast."""
    return spark.createDataFrame(list(rows), schema=schema)


def typed_null(dtype: str) -> Column:
    return F.lit(None).cast(dtype)
