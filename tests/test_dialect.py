"""Report files in the dialect of the database give the rows of the named reports."""

import pytest
from catalog.bronze import bronze
from compare import rows

from clearwell.plans import dialect, reports

SF = "/root/testdata/sf0.001"

FILES = {
    "01_sales_by_product": """
        -- what was sold; "o" is a comment
        SELECT i.product_id, COALESCE(p.product_name, 'Produit supprimé') AS "product_name",
               COALESCE(p.category, 'Inconnue') AS category, COALESCE(p.brand, 'Inconnue') AS brand,
               SUM(i.quantity) AS quantity_sold, ROUND(SUM(i.quantity * i.unit_price * (1 - i.discount)), 2) AS revenue
        FROM order_items i LEFT JOIN products p ON i.product_id = p.product_id
        GROUP BY i.product_id, p.product_name, p.category, p.brand
        ORDER BY revenue DESC;
    """,
    "02_customer_orders": """
        SELECT o.customer_id, COALESCE(CONCAT(c.first_name, ' ', c.last_name), 'x') AS full_name,
               COALESCE(c.email, 'Inconnu') AS email, COUNT(DISTINCT o.order_id) AS number_of_orders,
               COALESCE(SUM(o.total_amount), 0) AS total_spent
        FROM orders AS o LEFT JOIN customers AS c ON o.customer_id = c.customer_id
        GROUP BY o.customer_id, c.first_name, c.last_name, c.email
        ORDER BY total_spent DESC
    """,
    "03_orders_by_status": """
        SELECT status, COUNT(*) AS number_of_orders, SUM(total_amount) AS total_amount,
               ROUND(AVG(total_amount), 2) AS average_amount
        FROM orders GROUP BY status ORDER BY number_of_orders DESC, status;
    """,
    "04_monthly_revenue": r"""
        WITH days AS (
            SELECT CASE
                WHEN TRIM(order_date) ~ '^\d{2}/\d{2}/\d{4}$' THEN TO_DATE(TRIM(order_date), 'DD/MM/YYYY')
                WHEN TRIM(order_date) ~ '^\d{4}-\d{2}-\d{2}$' THEN TO_DATE(TRIM(order_date), 'YYYY-MM-DD')
                WHEN TRIM(order_date) ~ '^\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}:\d{2}$'
                    THEN TO_TIMESTAMP(REPLACE(TRIM(order_date), 'T', ' '), 'YYYY-MM-DD HH24:MI:SS')::date
                END AS day, total_amount, status
            FROM orders
        )
        SELECT DATE_TRUNC('month', day)::date AS order_month, COUNT(*) AS number_of_orders,
               COALESCE(SUM(total_amount), 0) AS monthly_revenue, ROUND(COALESCE(AVG(total_amount), 0), 2) AS average_order_amount
        FROM days
        WHERE day IS NOT NULL AND COALESCE(UPPER(TRIM(status)), 'UNKNOWN') NOT IN ('CANCELLED', 'ANNULÉE', 'ANNULEE')
        GROUP BY DATE_TRUNC('month', day) ORDER BY order_month
    """,
    "05_top_customers": """
        SELECT o.customer_id, CONCAT(c.first_name, ' ', c.last_name) AS full_name,
               COUNT(DISTINCT o.order_id) AS number_of_orders, SUM(o.total_amount) AS total_spent
        FROM orders o LEFT JOIN customers c ON o.customer_id = c.customer_id
        GROUP BY o.customer_id, c.first_name, c.last_name
        ORDER BY total_spent DESC, o.customer_id, full_name LIMIT 10;
    """,
}


def printed(df):
    names = sorted(df.columns)
    return rows(names, [tuple(str(r[c].normalize()) if hasattr(r[c], "normalize") else str(r[c]) for c in names) for r in df.collect()])


def test_five_files_give_the_rows_of_the_reports(spark, tmp_path):
    for name, text in FILES.items():
        (tmp_path / f"{name}.sql").write_text(text, encoding="utf-8")
    views = reports.raw_views(bronze(spark, SF))
    run = reports.run_reports(spark, views, reports.load_catalogue(str(tmp_path), database_dialect=True))
    named = reports.run_reports(spark, views)
    assert not run.errors and set(run.results) == set(named.results)
    for name, df in run.results.items():
        assert sorted(df.columns) == sorted(named.results[name].columns)
        assert printed(df) == printed(named.results[name]), name
    order = [r["total_spent"] for r in run.results["05_top_customers"].collect()]
    assert order == [r["total_spent"] for r in named.results["05_top_customers"].collect()]


@pytest.mark.parametrize(
    ("expression", "value"),
    [
        ("'a.b' ~ '^a\\.b$'", "True"), ("'aXb' ~ 'a\\.b'", "False"), ("'it''s' ~ 'it''s'", "True"), ("'x' = 'x' AND 'ab~' ~ 'b~'", "True"),
        ("concat('a', NULL, 'b')", "ab"), ("concat(concat('a', NULL), ')')", "a)"), ("to_date('31/12/2024', 'DD/MM/YYYY')", "2024-12-31"),
        ("to_date('31/02/2024', 'DD/MM/YYYY')", "None"), ("to_timestamp('2024-01-02 13:14:15', 'YYYY-MM-DD HH24:MI:SS')::text", "2024-01-02 13:14:15"),
        ("'to_date(x, ''DD'') -- no'", "to_date(x, 'DD') -- no"), ("1 /* ~ */ + 2", "3"), ("'5'::int8 + 1", "6"), ("'a\\d'", "a\\d"),
    ],
)
def test_expressions(spark, expression, value):
    sql = dialect.to_spark(f'SELECT {expression} AS "the value"')
    assert str(spark.sql(sql).first()["the value"]) == value


def test_order_of_nulls(spark):
    values = "(SELECT * FROM VALUES (1, 'b'), (NULL, 'a'), (2, NULL) AS t(k, s)) u"
    for order, want in (
        ("k", [1, 2, None]), ("k ASC", [1, 2, None]), ("k DESC", [None, 2, 1]), ("k DESC NULLS LAST", [2, 1, None]),
        ("coalesce(s, 'z') DESC, k", [2, 1, None]), ("s DESC, k LIMIT 1", [2]),
    ):
        assert [r["k"] for r in spark.sql(dialect.to_spark(f"SELECT k FROM {values} ORDER BY {order}")).collect()] == want, order
    window = dialect.to_spark(f"SELECT k, row_number() OVER (PARTITION BY 1 ORDER BY k DESC) AS n FROM {values}")
    assert {r["k"]: r["n"] for r in spark.sql(window).collect()} == {None: 1, 2: 2, 1: 3}


def test_exact_averages(spark):
    rows = "(SELECT CAST(v AS decimal(10,2)) AS v FROM VALUES (0.01), (0.00), (0.00) AS t(v)) u"
    assert str(spark.sql(dialect.to_spark(f"SELECT AVG(v) AS a FROM {rows}")).first()["a"]).startswith("0.00333333333")


@pytest.mark.parametrize(
    ("sql", "why"),
    [
        ("SELECT a ~* 'x' FROM t", "without regard to case"), ("SELECT a !~ 'x'", "negated"), ("SELECT a ~ b", "not written out"),
        ("SELECT to_char(d, 'YYYY')", "to_char"), ("SELECT to_date(a, 'Mon DD')", "format field"), ("SELECT to_date(a, f)", "written out"),
        ("SELECT 1; SELECT 2", "several statements"), ("SELECT a->>'b'", "JSON"), ("SELECT $$x$$", "at character"), ("SELECT (1", "close"),
        ("SELECT avg(DISTINCT a)", "distinct"), ("SELECT a ILIKE 'b'", "ILIKE"),
    ],
)
def test_other_forms_are_named(sql, why):
    with pytest.raises(dialect.Unsupported, match=why):
        dialect.to_spark(sql if "(1" not in sql else "SELECT concat(1")


def test_the_file_is_named(tmp_path):
    (tmp_path / "odd.sql").write_text("SELECT a ~* 'b'")
    with pytest.raises(dialect.Unsupported, match="odd.sql"):
        reports.load_catalogue(str(tmp_path), database_dialect=True)
    assert reports.load_catalogue(str(tmp_path)) == {"odd": "SELECT a ~* 'b'"}
