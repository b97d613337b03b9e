from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from tidemark.operators import catalog
from tidemark.operators.catalog import physical_schemas, read_widened, wider, widened


def write(spark, folder, select, mode="append", by=()):
    spark.sql(f"SELECT {select}").coalesce(1).write.mode(mode).partitionBy(*by).parquet(str(folder))


def kind(text):
    return StructType.fromDDL(f"c {text}")["c"].dataType


@pytest.mark.parametrize(
    "a, b, want",
    [
        ("int", "bigint", "bigint"), ("tinyint", "int", "int"), ("float", "double", "double"), ("float", "int", "double"),
        ("int", "double", "double"), ("bigint", "double", None), ("int", "string", None), ("date", "timestamp_ntz", "timestamp_ntz"),
        ("decimal(10,2)", "decimal(8,4)", "decimal(12,4)"), ("int", "decimal(4,2)", "decimal(12,2)"), ("decimal(38,0)", "decimal(38,10)", None),
        ("array<int>", "array<bigint>", "array<bigint>"), ("struct<a:int>", "struct<b:int,A:bigint>", "struct<a:bigint,b:int>"), ("array<int>", "int", None),
    ],
)
def test_least_common_type(spark, a, b, want):
    for found in (wider(kind(a), kind(b)), wider(kind(b), kind(a))):
        assert (found is None) == (want is None)
    if want:
        assert wider(kind(a), kind(b)).simpleString() == want


def test_types_that_come_and_go_are_read_as_the_widest(spark, tmp_path):
    folder = tmp_path / "t"
    for i, (key, price, seen) in enumerate(
        [("1", "CAST(1.5 AS FLOAT)", "DATE'2025-01-01'"), ("2L", "2.25D", "TIMESTAMP_NTZ'2025-01-02 03:00:00'"), ("3", "CAST(NULL AS FLOAT)", "DATE'2025-01-03'"), ("9000000000", "4.0D", "DATE'2025-01-04'")]
    ):
        write(spark, folder, f"{key} AS id, {price} AS price, {seen} AS seen, {i} AS n{i}")
    assert 2 <= len(physical_schemas(spark, str(folder))) <= 4
    found = read_widened(spark, str(folder))
    assert dict(found.dtypes) == {"id": "bigint", "price": "double", "seen": "timestamp_ntz"} | {f"n{i}": "int" for i in range(4)}
    rows = sorted((r.id, r.price, str(r.seen), r.n0, r.n1) for r in found.collect())
    assert rows == [
        (1, 1.5, "2025-01-01 00:00:00", 0, None), (2, 2.25, "2025-01-02 03:00:00", None, 1),
        (3, None, "2025-01-03 00:00:00", None, None), (9000000000, 4.0, "2025-01-04 00:00:00", None, None),
    ]
    assert found.where("id > 3000000000").count() == 1 and found.where("id = 3").count() == 1


def test_a_discovered_table_is_widened(spark, lake, tmp_path):
    folder, name = str(tmp_path / "t"), f"{lake.database}.landed"
    write(spark, folder, "1 AS id, CAST(2.50 AS DECIMAL(6,2)) AS price, NAMED_STRUCT('a', 1) AS s, 2024 AS year", by=["year"])
    assert dict(catalog.discover_table(spark, name, folder).dtypes)["id"] == "int"
    write(spark, folder, "5000000000 AS id, CAST(3.1234 AS DECIMAL(12,4)) AS price, NAMED_STRUCT('a', 2, 'b', 'x') AS s, 'new' AS extra, 2025 AS year", by=["year"])
    for _ in range(2):  # the second time there is nothing to do
        found = catalog.discover_table(spark, name, folder)
        assert dict(found.dtypes) == {"id": "bigint", "price": "decimal(12,4)", "s": "struct<a:int,b:string>", "extra": "string", "year": "int"}
        assert sorted((r.id, r.price, r.s.b, r.extra, r.year) for r in found.collect()) == [
            (1, Decimal("2.5000"), None, None, 2024), (5000000000, Decimal("3.1234"), "x", "new", 2025)
        ]
    # Narrower files leave the types as they are.
    write(spark, folder, "7 AS id, CAST(1.00 AS DECIMAL(6,2)) AS price, 2025 AS year", by=["year"])
    assert catalog.discover_table(spark, name, folder).schema == found.schema
    assert spark.table(name).where("year = 2025").agg(F.sum("id")).first()[0] == 5000000007
    spark.sql(f"DROP TABLE {name}")


def test_types_with_nothing_in_common_are_named(spark, tmp_path):
    folder = tmp_path / "t"
    write(spark, folder, "1 AS id, 1 AS code")
    write(spark, folder, "1 AS id, 'a' AS code")
    with pytest.raises(ValueError, match="column code is (int|string) in some files"):
        read_widened(spark, str(folder))
    assert widened([]) == StructType([])
