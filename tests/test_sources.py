import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql import types as T

from vigil.sources import io as IO


def test_snake_case_and_clean_names(spark):
    assert IO.snake_case("Incident Date (eTimes.03)") == "incident_date_e_times_03"
    assert IO.snake_case("  Total=Price ") == "total_price"
    df = spark.createDataFrame([(1, 2)], "`A b` int, `a_b` int")
    assert IO.clean_names(df).columns == ["a_b", "a_b_2"]


def test_apply_type_spec(spark):
    raw = spark.createDataFrame([("1", "2024-01-02", "3.5", "23:50:01", "x"), ("n/a", "", " ", "bad", None)],
                                "`Id (key)` string, `Use Date` string, `Amount=USD` string, `Time On` string, Note string")
    out = IO.apply_type_spec(raw, ["bigint", "date", "double", "time", "string"], on_error="null")
    assert out.columns == ["id_key", "use_date", "amount_usd", "time_on", "note"]
    r = out.collect()
    assert tuple(r[0]) == (1, dt.date(2024, 1, 2), 3.5, (23 * 3600 + 50 * 60 + 1) * 1_000_000, "x")
    assert tuple(r[1]) == (None, None, None, None, None)
    with pytest.raises(ValueError):
        IO.apply_type_spec(raw, ["bigint"])
    with pytest.raises(Exception):
        IO.apply_type_spec(raw, ["bigint", "date", "double", "time", "string"]).collect()


def test_delimited_materialize_and_sinks(spark):
    d = tempfile.mkdtemp(prefix="vigil-src-", dir="/tmp")
    p = os.path.join(d, "places.txt")
    with open(p, "w") as f:
        f.write("1\tAmes\tStory\n2\tAdel\\\tx\tDallas\n")
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType()),
                           T.StructField("county", T.StringType())])
    with pytest.raises(Exception):   # the second row has a cell too many
        IO.read_delimited(spark, p, schema).collect()
    df = IO.read_delimited(spark, p, schema, mode="PERMISSIVE")
    assert [r.id for r in df.collect()] == [1, 2]
    out = os.path.join(d, "t")
    calls = []

    def build():
        calls.append(1)
        return df
    a = IO.materialize(spark, out, build)
    b = IO.materialize(spark, out, build)
    assert len(calls) == 1 and a.count() == b.count() == 2
    with pytest.raises(Exception):
        IO.write_table(df, out, mode="errorifexists")
    IO.write_table(df, out, mode="overwrite")
    csv = os.path.join(d, "c")
    IO.write_table(df, csv, fmt="csv", single_file=True)
    assert IO.read_csv(spark, csv).count() == 2


def test_literal_table_typed_nulls(spark):
    df = IO.literal_table(spark, [("A", None), ("B", 3)], "name string, admin3 int")
    assert dict(df.dtypes) == {"name": "string", "admin3": "int"}


def test_header_from_first_row_then_typed(spark):
    grid = spark.createDataFrame([(2, "1", "2024-01-02"), (1, "Incident Id", "Date Of Use"), (3, "2", None)],
                                 "r int, A string, B string")
    df = IO.header_from_first_row(grid, "r")
    assert df.columns == ["Incident Id", "Date Of Use"]
    typed = IO.apply_type_spec(df, ["bigint", "date"])
    assert sorted(typed.collect(), key=lambda x: x[0]) == [(1, dt.date(2024, 1, 2)), (2, None)]
    assert typed.columns == ["incident_id", "date_of_use"]


def test_header_row_is_the_only_row_removed(spark):
    grid = spark.createDataFrame([(0, "Id"), (0, "7"), (None, "8"), (2, "9")], "r int, A string")
    assert IO.header_from_first_row(grid, "r").count() == 3


def test_materialize_rebuilds_half_written_results(spark, tmp_path):
    p, calls = str(tmp_path / "t"), []

    def build():
        calls.append(1)
        return spark.range(3)
    assert IO.materialize(spark, p, build).count() == 3 and IO.materialize(spark, p, build).count() == 3 and len(calls) == 1
    (tmp_path / "t" / "_SUCCESS").rename(tmp_path / "marker")
    assert IO.materialize(spark, p, build).count() == 3 and len(calls) == 2
