"""Inferred types, unreadable requests, and lookups that find nothing."""

from __future__ import annotations

import datetime
import math

import pytest
from pyspark.sql import functions as F

from farekit.operators import validation
from farekit.sources import fixtures, inference, readers, schemas, sinks
from tests import oracle


def texts(spark, **columns):
    rows = list(zip(*columns.values(), strict=True))
    return spark.createDataFrame(rows, ", ".join(f"`{name}` string" for name in columns))


CASES = {
    "whole": (["1", "-20", "+3", None], "int"),
    "last_int": (["2147483647", "-2147483648", "", None], "int"),
    "beyond_int": (["1", "2147483648", "", None], "bigint"),
    "beyond_long": (["1", "9223372036854775808", "", None], "double"),
    "number": (["1", "2.5", "1e3", ".5"], "double"),
    "special": (["1", "NaN", "Inf", "-Infinity"], "double"),
    "date": (["2025-01-31", None, "", "0001-01-01"], "date"),
    "no_date": (["2025-02-30", "2025-01-01", None, None], "string"),
    "date_and_number": (["2025-01-01", "1", None, None], "string"),
    "zeros": (["007", "08", "1", None], "int"),
    "blanks": (["1", " 2", None, None], "string"),
    "letters": (["1d", "2", "0x1", None], "string"),
    "mixed": (["1", "2.5", "two", None], "string"),
    "empty": (["", None, "", None], "string"),
}


def test_every_column_gets_the_smallest_type_that_holds_its_values(spark):
    table = texts(spark, **{name: values for name, (values, _) in CASES.items()})
    schema = inference.inferred_schema(table)
    assert {f.name: f.dataType.simpleString() for f in schema} == {name: kind for name, (_, kind) in CASES.items()}
    rows = inference.typed(table, schema).collect()
    assert [r.last_int for r in rows] == [2147483647, -2147483648, None, None]
    assert rows[0].date == datetime.date(2025, 1, 31) and [r.zeros for r in rows] == [7, 8, 1, None]
    assert math.isnan(rows[1].special) and [r.special for r in rows[2:]] == [math.inf, -math.inf]
    assert [r.number for r in rows] == [1.0, 2.5, 1000.0, 0.5] and rows[1].beyond_long == 9223372036854775808.0


def test_codes_may_keep_their_zeros(spark):
    table = texts(spark, code=["007", "8"], number=["0", "-5"], share=["0.5", "00.5"])
    kinds = [f.dataType.simpleString() for f in inference.inferred_schema(table, codes_as_text=True)]
    assert kinds == ["string", "int", "double"]


def test_odd_tables(spark):
    assert [f.dataType.simpleString() for f in inference.inferred_schema(texts(spark, a=["1"], b=["x"]).limit(0))] == ["string"] * 2
    odd = texts(spark, **{"a b.c": ["1"]})
    assert inference.typed(odd, inference.inferred_schema(odd)).first()[0] == 1


def test_texts_are_told_from_numbers_without_a_pattern(spark):
    """One comparison settles texts that start with a letter; those that hold a number that is not finite keep their sort."""
    said = spark.createDataFrame([("a",)], "text string").select(inference.sort_of(F.col("text"))).columns[0]
    assert said.index("ELSE 16 END") < said.index("RLIKE")
    odd = {
        "Delhi": 16, "é1": 16, "１２": 16, " 12": 16, "*1": 16, ":1": 16, "/2": 16, "NaN": 4, "Inf": 4, "-Infinity": 4, "+Inf": 4,
        "+": 16, ".": 16, ".5": 4, "9": 1, "2025-02-28": 8, "2025-02-30": 16, "2147483648": 2, "9" * 19: 4, "": 0,
    }
    found = spark.createDataFrame(list(odd.items()), "text string, sort int").where(inference.sort_of(F.col("text")) != F.col("sort"))
    assert found.collect() == []


def test_inference_is_one_aggregation_over_the_files(spark, data_dir, tmp_path, monkeypatch):
    sinks.write_csv(fixtures.fares(spark, data_dir, "class", "price", "date"), str(tmp_path / "csv"))
    table = readers.read_untyped_csv(spark, str(tmp_path / "csv"))
    plans = []
    with monkeypatch.context() as patch:
        collect = type(table).collect
        patch.setattr(type(table), "collect", lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or collect(df))
        inference.inferred_schema(table)
    assert len(plans) == 1 and plans[0].count("FileScan") == 1 and plans[0].count("Exchange") == 1 and "Python" not in plans[0]
    assert [t for _, t in inference.read_inferred_csv(spark, str(tmp_path / "csv")).dtypes] == ["string", "double", "date"]


@pytest.fixture(scope="module")
def holed(spark, data_dir, tmp_path_factory):
    """The tables with keys that are null or lead nowhere."""
    out = str(tmp_path_factory.mktemp("holed"))
    for name in oracle.TABLES:
        rows = spark.read.parquet(f"{data_dir}/{name}.parquet")
        if name == "lineitem":
            rows = rows.withColumns(
                {
                    "l_partkey": F.when(F.col("l_orderkey") % 7 != 0, F.col("l_partkey")),
                    "l_suppkey": F.when(F.col("l_orderkey") % 5 == 0, -1).otherwise(F.col("l_suppkey")),
                }
            )
        elif name == "orders":
            rows = rows.where("o_orderkey % 11 <> 0").withColumn("o_custkey", F.when(F.col("o_orderkey") % 3 != 0, F.col("o_custkey")))
        elif name == "nation":
            rows = rows.where("n_nationkey <> 4")
        rows.coalesce(1).write.parquet(f"{out}/{name}.parquet")
    return out


@pytest.fixture(scope="module")
def holed_connection(holed):
    import duckdb

    connection = duckdb.connect()
    for name in oracle.TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{holed}/{name}.parquet/*.parquet')")
    return connection


@pytest.mark.parametrize("name", ["p01_project", "p02_derive", "a09_count_distinct", "f06_route_key", "p09_dangling_keys", "s02_untyped_scan"])
def test_rows_without_a_partner_stay(spark, holed, holed_connection, name):
    import __spark_entry__ as entry

    assert oracle.compare(entry.queries()[name](spark, holed), holed_connection, entry.oracle_sql()[name]) == []


def test_the_rows_are_the_same_whichever_columns_are_asked_for(spark, holed):
    n = fixtures.table(spark, holed, "lineitem").count()
    for columns in (("class",), ("source_city",), ("destination_city", "stops"), ("airline", "price"), ()):
        assert fixtures.fares(spark, holed, *columns).count() == n


def test_dangling_keys_are_counted_in_one_pass(spark, holed):
    report = fixtures.dangling(spark, holed)
    assert report._jdf.queryExecution().executedPlan().toString().count("lineitem.parquet") == 1
    rows = {r.lookup: r for r in report.collect()}
    n = fixtures.table(spark, holed, "lineitem").count()
    assert rows["orders"].missing_keys > 0 and rows["customer"].null_keys > 0 and rows["part"].null_keys > 0
    assert rows["part"].null_keys + rows["part"].missing_keys + rows["part"].used == n
    assert rows["customer"].null_keys + rows["customer"].missing_keys + rows["customer"].used == rows["orders"].used
    assert rows["home"].missing_keys > 0 and rows["supplier"].missing_keys > 0


LINES = [
    '{"request_id": 1, "airline": "SMALL", "source_city": "Delhi", "destination_city": "Goa", "departure_time": "Morning", '
    '"cabin_class": "Economy", "days_before_departure": 30}',
    '{"request_id": 2, "airline": "SMA',
    "no request",
    '{"request_id": 4, "days_before_departure": "soon"}',
    "[5]",
    "6",
    '"seven"',
    "",
    "   ",
    "{}",
    '{"request_id": 9, "airline": "SMALL", "unknown": [1, 2], "source_city": "Delhi", "destination_city": "Delhi"}',
]


@pytest.mark.parametrize("streaming", [False, True])
def test_every_line_is_accepted_or_rejected_once(spark, tmp_path, streaming):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "lines.json").write_text("\n".join(LINES))
    names = validation.Vocabularies(
        spark.createDataFrame([("SMALL",)], "airline string"), spark.createDataFrame([("Delhi",), ("Goa",)], "city string")
    )
    if streaming:
        checked = validation.with_reasons(readers.stream_requests(spark, str(tmp_path / "in")), names)
        run = checked.writeStream.format("parquet").option("path", str(tmp_path / "out")).option(
            "checkpointLocation", str(tmp_path / "checkpoint")).trigger(availableNow=True).start()
        run.awaitTermination()
        checked = spark.read.parquet(str(tmp_path / "out"))
    else:
        checked = validation.with_reasons(readers.read_json_requests(spark, str(tmp_path / "in")), names)
    good, bad = validation.accepted(checked), validation.rejected(checked).collect()
    assert schemas.UNREADABLE not in good.columns and [r.request_id for r in good.collect()] == [1]
    texts_of = sorted(r[schemas.UNREADABLE].strip() for r in bad if r[schemas.UNREADABLE] is not None)
    assert texts_of == sorted(LINES[i] for i in (1, 2, 3, 4, 5, 6))
    assert all((r.reasons == ["unreadable"]) == (r[schemas.UNREADABLE] is not None) for r in bad)
    readable = {r.request_id: r.reasons for r in bad if r[schemas.UNREADABLE] is None}
    assert set(readable) == {None, 9} and "same_city" in readable[9] and len(bad) == 8


def test_report_of_a_file_with_its_columns_in_any_order(spark, data_dir, tmp_path, monkeypatch):
    from farekit import __main__ as command

    rows = fixtures.flights(spark, data_dir)
    names = sorted(rows.columns)
    sinks.write_csv(rows.select(*names, F.lit("more").alias("a column more")), str(tmp_path / "csv"))
    monkeypatch.setattr("sys.argv", ["farekit", "report", str(tmp_path / "csv"), str(tmp_path / "out"), "--infer"])
    command.main()
    summary = readers.read_untyped_csv(spark, str(tmp_path / "out" / "summary")).first()
    assert int(summary.total_flights) == rows.count() and summary.avg_price.startswith("₹")
    median = readers.read_untyped_csv(spark, str(tmp_path / "out" / "median_price")).first()
    assert float(median["median"]) == rows.agg(F.median("price")).first()[0]
