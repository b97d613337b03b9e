"""The registered queries in DuckDB's SQL, for checking."""

from __future__ import annotations

SALES = """
SELECT l_orderkey AS order_id, o_custkey AS customer_id, p_name AS product_name,
       CAST(l_quantity AS INT) AS quantity,
       CAST(p_retailprice AS DECIMAL(10,2)) AS price,
       CAST(o_orderdate AS DATE) AS order_date, l_shipdate AS updated_at
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
"""

ORDER_ROWS = """
SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderpriority AS product_name,
       1 AS quantity, CAST(o_totalprice AS DECIMAL(10,2)) AS price,
       CAST(o_orderdate AS DATE) AS order_date, o_orderdate AS updated_at
FROM orders
"""

CUSTOMERS = """
SELECT c_custkey AS customer_id, c_name AS name,
       lower(replace(c_name, '#', '.')) || '@example.com' AS email,
       c_mktsegment AS customer_segment,
       CAST(DATE '1995-01-01' + CAST(c_custkey % 365 AS INT) AS TIMESTAMP) AS created_at,
       CAST(DATE '1995-01-01' + CAST(c_custkey % 365 + c_custkey % 3 AS INT) AS TIMESTAMP)
           AS updated_at
FROM customer
"""

CUSTOMER_COLUMNS = "customer_id, name, email, customer_segment, created_at, updated_at"
RENAMED = "customer_id, name || ' (Updated)' AS name, email, customer_segment, created_at"


def _with(body: str, **views: str) -> str:
    names = {"customers": CUSTOMERS, "order_rows": ORDER_ROWS, "sales": SALES, **views}
    ctes = ", ".join(f"{name} AS ({sql})" for name, sql in names.items())
    return f"WITH {ctes} {body}"


def _orders(columns: str = "", source: str = "order_rows", where: str = "TRUE", **change: str) -> str:
    """Order rows with the price as a double and some columns changed."""
    names = "order_id customer_id product_name quantity price order_date updated_at".split()
    exprs = {name: name for name in names} | change
    exprs["price"] = f"CAST({exprs['price']} AS DOUBLE)"
    picked = ", ".join(f"{e} AS {n}" for n, e in exprs.items())
    return f"SELECT {picked}{columns} FROM {source} WHERE {where}"


def _parts(stamp: str = "updated_at") -> str:
    return "".join(
        f", CAST({part}({stamp}) AS INT) AS {part}" for part in ("year", "month", "day")
    )


REPRICED = "CAST(ROUND(price * CAST(1.050 AS DECIMAL(4,3)), 2) AS DECIMAL(10,2))"
MARKED = """updated_at > TIMESTAMP '1999-12-31'
  OR (updated_at = TIMESTAMP '1999-12-31' AND order_id > 5000)"""
RECENT = "order_date >= DATE '2001-07-26'"
CHANGED_ORDERS = "updated_at >= TIMESTAMP '1999-07-01'"
KNOWN_CHANGED = "updated_at >= TIMESTAMP '1999-07-01' AND updated_at < TIMESTAMP '2000-01-01'"
MOVED = f"CASE WHEN {KNOWN_CHANGED} THEN updated_at + INTERVAL 184 DAY ELSE updated_at END"
CHANGED_CUSTOMERS = "updated_at >= TIMESTAMP '1995-05-15'"
OLD_CUSTOMERS = "created_at < TIMESTAMP '1995-07-01'"

CUSTOMER_TOTALS = """
SELECT c.customer_id, c.name, c.email, COUNT(o.order_id) AS total_orders,
       CAST(SUM(o.quantity * o.price) AS DOUBLE) AS total_spent,
       CAST(SUM(o.quantity * o.price) AS DOUBLE) / COUNT(o.quantity * o.price) AS avg_order_value,
       MIN(o.order_date) AS first_order_date, MAX(o.order_date) AS last_order_date
FROM customers c LEFT JOIN sales o ON c.customer_id = o.customer_id
GROUP BY c.customer_id, c.name, c.email
"""

PRODUCT_TOTALS = """
SELECT product_name, COUNT(order_id) AS order_count,
       CAST(SUM(quantity) AS BIGINT) AS total_quantity,
       CAST(SUM(quantity * price) AS DOUBLE) AS total_revenue,
       CAST(SUM(price) AS DOUBLE) / COUNT(price) AS avg_price
FROM sales GROUP BY product_name
"""

FEED = f"""
SELECT *, 'INSERT' AS change_type FROM customers WHERE created_at > TIMESTAMP '1995-07-01'
UNION ALL
SELECT *, 'UPDATE' AS change_type FROM customers
WHERE updated_at > created_at AND updated_at > TIMESTAMP '1995-07-01'
"""

CONTACTS = """
SELECT -1 - s_suppkey AS customer_id, s_name AS name,
       lower(replace(s_name, '#', '.')) || '@example.com' AS email,
       CAST(NULL AS VARCHAR) AS customer_segment,
       TIMESTAMP '1996-01-02' AS created_at, TIMESTAMP '1996-01-02' AS updated_at
FROM supplier
"""

OFFERED = f"""
SELECT * FROM contacts
UNION ALL
SELECT customer_id * 1000 - 1, name || ' (Updated)', email, customer_segment,
       created_at, updated_at FROM contacts
UNION ALL
SELECT customer_id * -1000 - 7, name || ' (Updated)', email, customer_segment,
       created_at, updated_at FROM customers
"""

UPSERTED_CUSTOMERS = f"""
SELECT {RENAMED}, updated_at FROM customers WHERE {CHANGED_CUSTOMERS}
UNION ALL
SELECT {CUSTOMER_COLUMNS} FROM customers WHERE {OLD_CUSTOMERS} AND NOT ({CHANGED_CUSTOMERS})
"""


def _profile(stored: bool = False) -> str:
    """Columns and counts of the tables; ``stored`` ones carry audit and date columns."""
    columns = {
        "customers": [
            ("customer_id", "bigint"),
            ("name", "string"),
            ("email", "string"),
            ("customer_segment", "string"),
            ("created_at", "timestamp_ntz"),
            ("updated_at", "timestamp_ntz"),
        ],
        "order_rows": [
            ("order_id", "bigint"),
            ("customer_id", "bigint"),
            ("product_name", "string"),
            ("quantity", "int"),
            ("price", "decimal(10,2)"),
            ("order_date", "date"),
            ("updated_at", "timestamp_ntz"),
        ],
    }
    if stored:
        audit = [("etl_processed_at", "timestamp"), ("etl_job_run_id", "string")]
        dates = [(part, "int") for part in ("year", "month", "day")]
        columns = {view: found + audit + dates for view, found in columns.items()}
    rows = [
        f"SELECT '{view.replace('order_rows', 'orders')}' AS table_name, TRUE AS found, "
        f"{i} AS position, '{name}' AS column_name, '{kind}' AS data_type, "
        f"(SELECT COUNT(*) FROM {view}) AS row_count"
        for view, found in columns.items()
        for i, (name, kind) in enumerate(found, start=1)
    ]
    if not stored:
        rows.append("SELECT 'returns', FALSE, NULL, NULL, NULL, NULL")
    return " UNION ALL ".join(rows)


def _violations() -> str:
    def row(table: str, name: str, count: str) -> str:
        return (
            f"SELECT '{table}' AS table_name, '{name}' AS constraint_name, "
            f"CAST(({count}) AS BIGINT) AS violations"
        )

    def nulls(view: str, column: str) -> str:
        return f"SELECT COUNT(*) FROM {view} WHERE {column} IS NULL"

    def surplus(view: str, column: str) -> str:
        return f"SELECT COUNT({column}) - COUNT(DISTINCT {column}) FROM {view}"

    orphans = """SELECT COUNT(*) FROM sales s WHERE s.customer_id IS NOT NULL
        AND NOT EXISTS (SELECT 1 FROM customers c WHERE c.customer_id = s.customer_id)"""
    checks = [
        *[
            row("customers", f"{c} not null", nulls("customers", c))
            for c in ("customer_id", "name", "email")
        ],
        *[
            row("customers", f"{c} unique", surplus("customers", c))
            for c in ("customer_id", "email")
        ],
        *[
            row("orders", f"{c} not null", nulls("sales", c))
            for c in ("order_id", "product_name", "quantity", "price")
        ],
        row("orders", "order_id unique", surplus("sales", "order_id")),
        row("orders", "customer_id references", orphans),
    ]
    return " UNION ALL ".join(checks)


def _sample(view: str, key: str, where: str, k: int) -> str:
    return (
        f"SELECT * FROM {view} WHERE {where} "
        f"ORDER BY md5('7:' || CAST({key} AS VARCHAR)), {key} LIMIT {k}"
    )


INSERTED_CUSTOMERS = f"""SELECT {CUSTOMER_COLUMNS} FROM customers
UNION ALL
SELECT {CUSTOMER_COLUMNS} FROM (
    SELECT *, row_number() OVER (PARTITION BY email ORDER BY customer_id) AS place
    FROM offered)
WHERE place = 1 AND email NOT IN (SELECT email FROM customers)"""

ORACLE: dict[str, str] = {
    "customer_orders_summary": _with(
        f"{CUSTOMER_TOTALS} ORDER BY total_spent DESC NULLS LAST, c.customer_id"
    ),
    "monthly_sales_trend": _with(
        """SELECT CAST(EXTRACT(YEAR FROM order_date) AS INT) AS year,
               CAST(EXTRACT(MONTH FROM order_date) AS INT) AS month,
               COUNT(order_id) AS total_orders,
               CAST(SUM(quantity * price) AS DOUBLE) AS total_revenue,
               CAST(SUM(quantity * price) AS DOUBLE) / COUNT(quantity * price) AS avg_order_value,
               COUNT(DISTINCT customer_id) AS unique_customers
        FROM sales GROUP BY 1, 2 ORDER BY 1, 2"""
    ),
    "top_products": _with(
        f"""SELECT product_name, order_count, total_quantity AS total_quantity_sold,
               total_revenue, avg_price
        FROM ({PRODUCT_TOTALS}) ORDER BY total_revenue DESC NULLS LAST, product_name LIMIT 20"""
    ),
    "customer_count": _with("SELECT COUNT(*) AS total_customers FROM customers"),
    "order_count": _with("SELECT COUNT(*) AS total_orders FROM sales"),
    "total_revenue": _with(
        "SELECT CAST(SUM(quantity * price) AS DOUBLE) AS total_revenue FROM sales"
    ),
    "top5_customers": _with(
        f"""SELECT name, email, total_orders, total_spent FROM ({CUSTOMER_TOTALS})
        ORDER BY total_spent DESC NULLS LAST, customer_id LIMIT 5"""
    ),
    "top5_products": _with(
        f"""SELECT product_name, order_count, total_quantity, total_revenue
        FROM ({PRODUCT_TOTALS}) ORDER BY total_revenue DESC NULLS LAST, product_name LIMIT 5"""
    ),
    "customer_lifetime_value": _with(
        """SELECT c.customer_segment, COUNT(DISTINCT c.customer_id) AS customers,
               CAST(SUM(s.total_spent) AS DOUBLE) / COUNT(s.total_spent) AS avg_lifetime_value,
               CAST(SUM(s.total_orders) AS DOUBLE) / COUNT(s.total_orders)
                   AS avg_orders_per_customer
        FROM customers c JOIN (
            SELECT customer_id, SUM(quantity * price) AS total_spent,
                   COUNT(order_id) AS total_orders
            FROM sales GROUP BY customer_id) s ON c.customer_id = s.customer_id
        GROUP BY c.customer_segment"""
    ),
    "monthly_revenue_partitioned": _with(
        """SELECT CAST(year(updated_at) AS INT) AS year, CAST(month(updated_at) AS INT) AS month,
               CAST(SUM(quantity * price) AS DOUBLE) AS monthly_revenue,
               COUNT(DISTINCT customer_id) AS unique_customers,
               CAST(SUM(quantity * price) AS DOUBLE) / COUNT(quantity * price) AS avg_order_value
        FROM sales WHERE year(updated_at) = 1998 GROUP BY 1, 2"""
    ),
    "recent_changes": _with(
        """SELECT (SELECT COUNT(*) FROM customers
                WHERE created_at >= TIMESTAMP '1995-12-30'
                   OR updated_at >= TIMESTAMP '1995-12-30') AS recent_customers,
               (SELECT COUNT(*) FROM order_rows
                WHERE order_date >= DATE '2001-08-01'
                   OR updated_at >= TIMESTAMP '2001-07-30') AS recent_orders"""
    ),
    "change_status": _with(
        """SELECT name, email,
               CASE WHEN updated_at > created_at THEN 'UPDATED' ELSE 'NEW' END AS status,
               updated_at
        FROM customers"""
    ),
    "latest_changes": _with(
        """SELECT name, email,
               CASE WHEN updated_at > created_at THEN 'UPDATED' ELSE 'NEW' END AS status,
               updated_at
        FROM customers WHERE updated_at >= TIMESTAMP '1995-12-03'
        ORDER BY updated_at DESC, customer_id LIMIT 5"""
    ),
    "inc_bookmark": _with(_orders(where=MARKED)),
    "inc_customers_filter": _with(
        """SELECT * FROM customers
        WHERE created_at > TIMESTAMP '1995-07-01' OR updated_at > TIMESTAMP '1995-07-01'"""
    ),
    "inc_orders_filter": _with(
        _orders(
            source="sales",
            where=f"""(order_date >= DATE '2001-07-20' AND {RECENT})
                OR updated_at > TIMESTAMP '2001-07-20'""",
        )
    ),
    "inc_first_run": _with(_orders(where="updated_at >= TIMESTAMP '2001-07-03'")),
    "inc_since_last_run": _with(_orders(where="updated_at > TIMESTAMP '2000-01-01'")),
    "inc_micro_batch": _with(
        f"{_orders(where=f'({MARKED})')} ORDER BY updated_at, order_id LIMIT 1000"
    ),
    "cdc_union": _with(FEED),
    "recent_orders": _with(_orders(where=RECENT)),
    "sample_customers": _with(_sample("customers", "customer_id", "TRUE", 3)),
    "sample_recent_orders": _with(
        _orders(source="sampled"), sampled=_sample("order_rows", "order_id", RECENT, 5)
    ),
    "upsert_orders": _with(
        f"""{_orders(where=CHANGED_ORDERS, price=REPRICED)}
        UNION ALL
        {_orders(where=f"updated_at < TIMESTAMP '2000-01-01' AND NOT ({CHANGED_ORDERS})")}"""
    ),
    "upsert_customers": _with(UPSERTED_CUSTOMERS),
    "upsert_change_feed": _with(
        f"""SELECT {CUSTOMER_COLUMNS}, CAST(NULL AS VARCHAR) AS change_type FROM customers
        WHERE created_at <= TIMESTAMP '1995-07-01'
            AND customer_id NOT IN (SELECT customer_id FROM feed)
        UNION ALL
        SELECT {CUSTOMER_COLUMNS}, change_type FROM (
            SELECT *, row_number() OVER (PARTITION BY customer_id
                ORDER BY updated_at DESC, change_type DESC) AS place FROM feed)
        WHERE place = 1""",
        feed=FEED,
    ),
    "upsert_only_newer": _with(
        f"""SELECT {RENAMED}, updated_at FROM customers WHERE updated_at = created_at
        UNION ALL
        SELECT {CUSTOMER_COLUMNS} FROM customers WHERE updated_at > created_at"""
    ),
    "insert_ignore": _with(INSERTED_CUSTOMERS, contacts=CONTACTS, offered=OFFERED),
    "keyed_update": _with(
        _orders(
            quantity=f"CASE WHEN {RECENT} THEN GREATEST(1, quantity - 1) ELSE quantity END",
            price=f"CASE WHEN {RECENT} THEN {REPRICED} ELSE price END",
            updated_at=f"CASE WHEN {RECENT} THEN TIMESTAMP '2001-08-02' ELSE updated_at END",
        )
    ),
    "keyed_update_customers": _with(
        f"""SELECT {RENAMED}, TIMESTAMP '1996-01-02' AS updated_at
        FROM customers WHERE updated_at > created_at
        UNION ALL
        SELECT {CUSTOMER_COLUMNS} FROM customers WHERE updated_at = created_at"""
    ),
    "transform_audit": _with(
        _orders(
            """, TIMESTAMP '2001-08-02' AS etl_processed_at,
            'orders_996710400' AS etl_job_run_id"""
        )
    ),
    "transform_date_parts": _with(_orders(_parts())),
    "lake_initial_write": _with(_orders(_parts())),
    "lake_upsert": _with(f"SELECT *{_parts()} FROM ({UPSERTED_CUSTOMERS})"),
    "lake_full_refresh": _with(
        f"SELECT {RENAMED}, updated_at{_parts()} FROM customers"
    ),
    "lake_insert_ignore": _with(
        f"SELECT *{_parts()}, 0::BIGINT AS added_again FROM ({INSERTED_CUSTOMERS})",
        contacts=CONTACTS,
        offered=OFFERED,
    ),
    "lake_compact": _with(f"SELECT *{_parts()} FROM customers"),
    "lake_latest": _with(
        f"SELECT *{_parts()} FROM customers ORDER BY updated_at DESC, customer_id LIMIT 5"
    ),
    "incremental_orders": _with(
        _orders(
            _parts(MOVED),
            price=f"CASE WHEN {KNOWN_CHANGED} THEN {REPRICED} ELSE price END",
            updated_at=MOVED,
        )
    ),
    "incremental_empty": _with(f"SELECT *{_parts()}, 0::BIGINT AS read_again FROM customers"),
    "incremental_after_reset": _with(
        f"SELECT *{_parts()}, (SELECT COUNT(*) FROM customers) AS read_again FROM customers"
    ),
    "incremental_micro_batches": _with(f"SELECT *{_parts()} FROM customers"),
    "lake_manifest": _with(f"SELECT DISTINCT {_parts()[2:]} FROM customers"),
    "lake_partitions": _with(f"SELECT DISTINCT {_parts()[2:]} FROM customers"),
    "lake_file_inventory": _with(
        """SELECT folder, CAST(NULL AS INT) AS place, COUNT(*) AS files, CAST(SUM(bytes) AS BIGINT) AS bytes
        FROM landed GROUP BY folder
        UNION ALL
        SELECT 'all', NULL, COUNT(*), CAST(SUM(bytes) AS BIGINT) FROM landed
        UNION ALL
        SELECT folder, CAST(place AS INT), 1, bytes FROM (
            SELECT *, row_number() OVER (PARTITION BY folder ORDER BY batch DESC) AS place FROM landed)
        WHERE place <= 5""",
        landed="""SELECT 'customer_segment=' || customer_segment AS folder, customer_id % 7 AS batch,
            customer_id // 100000 AS chunk, CAST(SUM(length(email) + 1) AS BIGINT) AS bytes
        FROM customers GROUP BY ALL""",
    ),
    "lake_inventory": _with(
        """SELECT folder, COUNT(*) > 0 AS has_files
        FROM customers, (VALUES ('customers'), ('manifest_customers')) folders(folder)
        GROUP BY folder"""
    ),
    "load_all_profile": _with(_profile(stored=True)),
    "saved_report": _with(
        f"""SELECT product_name, order_count, total_quantity AS total_quantity_sold,
               total_revenue, avg_price
        FROM ({PRODUCT_TOTALS}) ORDER BY total_revenue DESC NULLS LAST, product_name LIMIT 20"""
    ),
    "inc_unstamped": _with(
        _orders(updated_at="CASE WHEN order_id % 3 <> 0 THEN updated_at END")
    ),
    "top_per_group": _with(
        _orders(source="ranked", where="place <= 3"),
        ranked="""SELECT *, row_number() OVER (
            PARTITION BY customer_id ORDER BY price DESC, order_id) AS place FROM order_rows""",
    ),
    "schema_widened": _with(_orders(order_id="CAST(order_id AS BIGINT)", quantity="CAST(quantity AS BIGINT)")),
    "schema_merge": _with(
        f"""SELECT customer_id, name, email, created_at, updated_at,
               CASE WHEN NOT ({OLD_CUSTOMERS}) THEN customer_segment END AS customer_segment
        FROM customers"""
    ),
    "table_profile": _with(_profile()),
    "check_constraints": _with(_violations()),
}
