"""Surrogate identifiers.

The reference draws ``LLLLLLLLLL-##########`` ids from a seeded global RNG in
row order.  On Spark a row-order RNG is partition-dependent, so the id is
derived from a hash of a seed and the row's key columns: deterministic under
re-partitioning and task retries, same shape (10 letters from A-Z a-z, a dash,
10 digits whose first digit is not 0).  ``with_surrogate_id`` gives every row
its own id, also where rows repeat.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil.functions.strings import ColumnOrName, bind, col

SPREAD = 8   # rows that are numbered or sorted whole go to this many times the session's shuffle partitions
LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"


def _hex_byte(h: Column, i: int) -> Column:
    return F.conv(F.substring(h, 2 * i + 1, 2), 16, 10).cast("int")


def surrogate_id(keys: Sequence[ColumnOrName], seed: int, occurrence: Column | None = None) -> Column:
    """sha256 of the seed and the keys, each written as ``length:value;`` (``N;``
    for NULL), so different key tuples never read alike: bytes 0-9 pick the
    letters, the next 60 bits give the number in [1e9, 1e10).  An
    ``occurrence`` above 1 is hashed along.  The hash is taken once a row."""
    def part(k: ColumnOrName) -> Column:
        v = col(k).cast("string")
        return F.coalesce(F.concat(F.length(v).cast("string"), F.lit(":"), v, F.lit(";")), F.lit("N;"))
    again = [] if occurrence is None else [F.when(occurrence > 1, part(occurrence)).otherwise("")]

    def spell(h: Column) -> Column:
        letters = F.concat(*[F.substring(F.lit(LETTERS), (F.pmod(_hex_byte(h, i), F.lit(52)) + 1), 1) for i in range(10)])
        num = F.conv(F.substring(h, 21, 15), 16, 10).cast("bigint")
        digits = F.pmod(num, F.lit(9_000_000_000)) + F.lit(1_000_000_000)
        return F.concat(letters, F.lit("-"), digits.cast("string"))
    return bind(F.sha2(F.concat(F.lit(f"{seed};"), *[part(k) for k in keys], *again), 256), spell)


def spread(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of equal keys together, dealt to ``SPREAD`` times the session's shuffle partitions, so
    a task that sorts its rows holds a small part of them; windows and aggregates by ``keys`` need no further shuffle."""
    parts = SPREAD * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(parts, *[F.col(f"`{k}`") for k in keys])


def with_surrogate_id(df: DataFrame, keys: Sequence[str], seed: int, name: str) -> DataFrame:
    """Adds an id to every ROW: rows with equal keys are numbered (by their
    other columns; rows equal in all columns are interchangeable) and from the second on
    the number is hashed along with the keys, so repeated rows keep ids of their own, whatever the partitioning."""
    rest = [F.col(f"`{f.name}`").asc_nulls_last() for f in df.schema if f.name not in keys and not isinstance(f.dataType, (T.MapType, T.VariantType))]
    w = Window.partitionBy(*[F.col(f"`{k}`") for k in keys]).orderBy(*(rest or [F.lit(1)]))
    return (spread(df, keys).withColumn("__occurrence", F.row_number().over(w))
            .withColumn(name, surrogate_id(keys, seed, F.col("__occurrence"))).drop("__occurrence"))
