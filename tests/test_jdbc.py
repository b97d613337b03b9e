"""Reader options only: no database may be started here."""

from tidemark.operators.increments import Mark
from tidemark.sources import jdbc


def test_known_bounds_split_the_read():
    options = jdbc.scan_options("jdbc:x", "public.orders", "order_id", (1, 900), 8, user="u")
    assert options["partitionColumn"] == "order_id"
    assert (options["lowerBound"], options["upperBound"], options["numPartitions"]) == ("1", "900", "8")
    assert options["user"] == "u" and options["dbtable"] == "public.orders"


def test_empty_table_is_read_by_one_task():
    options = jdbc.scan_options("jdbc:x", "public.orders", "order_id", (None, None))
    assert "partitionColumn" not in options


def test_bounds_come_from_one_query():
    assert jdbc.bounds_query("t", "k") == "SELECT MIN(k) AS lo, MAX(k) AS hi FROM t"


def test_ranges_cut_the_increment():
    where = jdbc.mark_condition(Mark("2025-01-02 00:00:00", "9", "4"), "k")
    assert where == "(updated_at >= '2025-01-02 00:00:00' OR updated_at IS NULL)"
    assert jdbc.bounds_query("t", "k", where).endswith(f" WHERE {where}")
    assert jdbc.mark_condition(None, "k") is None
    assert jdbc.mark_condition(Mark(None, "9"), "k") == "k > 9"
    assert jdbc.mark_condition(Mark(None, "it's"), "k") == "k > 'it''s'"


def test_other_keys_are_dealt_by_hash():
    found = jdbc.hash_predicates("code", 3)
    assert found[0] == "MOD(hashtext(code::text), 3) IN (0, -3) OR code IS NULL"
    assert found[2] == "MOD(hashtext(code::text), 3) IN (2, -1)"
    # Remainders of either sign fall in exactly one of them.
    wanted = [{i, i - 3} for i in range(3)]
    assert all(sum(r in w for w in wanted) == 1 for r in (-2, -1, 0, 1, 2))


def test_zone_less_stamps_stay_zone_less_and_compile(spark):
    """The watermark literal is quoted as the database expects it."""
    assert jdbc.scan_options("jdbc:x", "t")["preferTimestampNTZ"] == "true"
    jvm = spark._jvm
    dialect = jvm.org.apache.spark.sql.jdbc.JdbcDialects.get("jdbc:postgresql://host/db")
    moment = jvm.java.time.LocalDateTime.parse("2025-01-01T10:11:12.123456")
    assert dialect.compileValue(moment) == "'2025-01-01 10:11:12.123456'"
