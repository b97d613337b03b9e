import data
from tidemark.main import main
from tidemark.operators.lake import Lake


def test_commands(spark, tmp_path, capsys):
    landed = str(tmp_path / "landed")
    data.orders(spark, data.order(1, "2025-01-15"), data.order(2, "2025-01-16", "7.00")).write.parquet(
        f"{landed}/orders"
    )
    data.customers(spark, (1, "ann", "2025-01-01", "2025-01-01")).write.parquet(f"{landed}/customers")
    base = ["--database", "command_line", "--location", str(tmp_path / "lake")]
    load = [*base, "load", "customers", "orders", "--files", landed, "--verify"]
    try:
        assert main(load) == 0
        assert "orders: 2 rows read, 2 in the table" in capsys.readouterr().out
        assert main(load) == 0
        assert "orders: 0 rows read" in capsys.readouterr().out
        assert main([*base, "marks"]) == 0
        assert "2025-01-16 00:00:00" in capsys.readouterr().out
        assert main([*base, "reset", "orders"]) == 0
        assert main(load) == 0
        assert "orders: 2 rows read, 2 in the table" in capsys.readouterr().out
        results = str(tmp_path / "results")
        assert main([*base, "report", "total_revenue", "--results", results]) == 0
        assert str(spark.read.parquet(f"{results}/total_revenue").first()[0]) == "17.00"
        total = "SELECT SUM(quantity * price) AS total_revenue FROM command_line.orders"
        assert str(spark.sql(total).first()[0]) == "17.00"
        age = "current_timestamp() - etl_processed_at < INTERVAL 1 HOUR"
        assert spark.table("command_line.orders").where(age).count() == 2
        assert main([*base, "check"]) == 0
    finally:
        Lake(spark, "command_line").drop()
