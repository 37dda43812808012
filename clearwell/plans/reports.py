"""Named SQL reports over the raw relational tables, and their runner.

The texts aggregate each fact by its key before joining and fold equal dimension
rows into a copy count, so a hot key is combined map-side and the join sees one
row per key.  Null order is written out (NULLS FIRST on descending sums, as in the
database the reports come from) and a key breaks ties.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from pathlib import Path

from uuid import uuid4

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clearwell.operators.silver import MALFORMED
from clearwell.plans import dialect
from clearwell.sources import sinks

# Declared numeric columns of the relational tables.  Everything else, the order
# date included, stays text: the data does not honour its declared types.
NUMERIC_COLUMNS = {
    "orders": {"total_amount": "decimal(10,2)"},
    "products": {"current_price": "decimal(10,2)"},
    "order_items": {
        "quantity": "int",
        "unit_price": "decimal(10,2)",
        "discount": "decimal(5,2)",
    },
    "customers": {},
}

SALES_BY_PRODUCT = """
WITH sold AS (
  SELECT product_id,
         sum(quantity) AS quantity_sold,
         sum(quantity * unit_price * (1 - discount)) AS revenue
  FROM order_items
  GROUP BY product_id
), catalogue AS (
  SELECT product_id, product_name, category, brand, count(*) AS copies
  FROM products
  GROUP BY product_id, product_name, category, brand
)
SELECT sold.product_id,
       coalesce(product_name, 'Produit supprimé') AS product_name,
       coalesce(category, 'Inconnue') AS category,
       coalesce(brand, 'Inconnue') AS brand,
       quantity_sold * coalesce(copies, 1) AS quantity_sold,
       round(revenue * coalesce(copies, 1), 2) AS revenue
FROM sold LEFT JOIN catalogue ON sold.product_id = catalogue.product_id
"""

CUSTOMER_ORDERS = """
WITH spent AS (
  SELECT customer_id,
         count(DISTINCT order_id) AS number_of_orders,
         sum(total_amount) AS total_spent
  FROM orders
  GROUP BY customer_id
), people AS (
  SELECT customer_id, first_name, last_name, email, count(*) AS copies
  FROM customers
  GROUP BY customer_id, first_name, last_name, email
)
SELECT spent.customer_id,
       concat(coalesce(first_name, ''), ' ', coalesce(last_name, '')) AS full_name,
       coalesce(email, 'Inconnu') AS email,
       number_of_orders,
       coalesce(total_spent * coalesce(copies, 1), 0) AS total_spent
FROM spent LEFT JOIN people ON spent.customer_id = people.customer_id
"""

ORDERS_BY_STATUS = """
SELECT status,
       count(*) AS number_of_orders,
       sum(total_amount) AS total_amount,
       round(sum(total_amount) / nullif(count(total_amount), 0), 2) AS average_amount
FROM orders
GROUP BY status
ORDER BY number_of_orders DESC, status
"""

MONTHLY_REVENUE = r"""
WITH dated AS (
  SELECT trim(order_date) AS day, total_amount, upper(trim(status)) AS status
  FROM orders
), parsed AS (
  SELECT CASE
           -- fixed values: the three spellings of a date that this report knows
           WHEN day RLIKE '^\\d{2}/\\d{2}/\\d{4}$'
             THEN try_to_date(day, 'dd/MM/yyyy')
           WHEN day RLIKE '^\\d{4}-\\d{2}-\\d{2}$'
             THEN try_to_date(day, 'yyyy-MM-dd')
           WHEN day RLIKE '^\\d{4}-\\d{2}-\\d{2}[ T]\\d{2}:\\d{2}:\\d{2}$'
             THEN CAST(try_to_timestamp(replace(day, 'T', ' '), 'yyyy-MM-dd HH:mm:ss')
                       AS DATE)
         END AS order_day,
         total_amount
  FROM dated
  WHERE status IS NULL OR status NOT IN ('CANCELLED', 'ANNULÉE', 'ANNULEE')
)
SELECT trunc(order_day, 'MM') AS order_month,
       count(*) AS number_of_orders,
       coalesce(sum(total_amount), 0) AS monthly_revenue,
       round(coalesce(sum(total_amount) / nullif(count(total_amount), 0), 0), 2)
         AS average_order_amount
FROM parsed
WHERE order_day IS NOT NULL
GROUP BY trunc(order_day, 'MM')
ORDER BY order_month
"""

TOP_CUSTOMERS = """
WITH spent AS (
  SELECT customer_id,
         count(DISTINCT order_id) AS number_of_orders,
         sum(total_amount) AS total_spent
  FROM orders
  GROUP BY customer_id
), people AS (
  SELECT customer_id, first_name, last_name, count(*) AS copies
  FROM customers
  GROUP BY customer_id, first_name, last_name
)
SELECT spent.customer_id,
       concat(coalesce(first_name, ''), ' ', coalesce(last_name, '')) AS full_name,
       number_of_orders,
       total_spent * coalesce(copies, 1) AS total_spent
FROM spent LEFT JOIN people ON spent.customer_id = people.customer_id
ORDER BY total_spent DESC NULLS FIRST, customer_id, full_name
LIMIT 10
"""

REPORTS = {
    "01_sales_by_product": SALES_BY_PRODUCT,
    "02_customer_orders": CUSTOMER_ORDERS,
    "03_orders_by_status": ORDERS_BY_STATUS,
    "04_monthly_revenue": MONTHLY_REVENUE,
    "05_top_customers": TOP_CUSTOMERS,
}


# The reading order of the reports whose size grows with the data.  Their texts leave
# it out: sorting before a Parquet write costs a range shuffle that no reader uses.
_ORDERS = {
    "01_sales_by_product": lambda: [F.col("revenue").desc_nulls_first(), F.col("product_id")],
    "02_customer_orders": lambda: [F.col("total_spent").desc_nulls_first(), F.col("customer_id")],
}


def present(name: str, df: DataFrame) -> DataFrame:
    """A report in its reading order."""
    return df.orderBy(*_ORDERS[name]()) if name in _ORDERS else df


@dataclass
class ReportRun:
    """Results by report name, the message of each report that failed, rows written."""

    results: dict[str, DataFrame] = field(default_factory=dict)
    errors: dict[str, str] = field(default_factory=dict)
    counts: dict[str, int] = field(default_factory=dict)

    def status(self, spark: SparkSession) -> DataFrame:
        rows = [(name, "OK", None) for name in self.results]
        rows += [(name, "ERREUR", text) for name, text in self.errors.items()]
        return spark.createDataFrame(rows, "report string, status string, error string")


def raw_views(bronze: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The relational raw tables with their numbers typed; bad numbers are NULL.

    A record that its reader could not take apart is no row of them.
    """
    views = {}
    for name, columns in NUMERIC_COLUMNS.items():
        df = bronze[name]
        if MALFORMED in df.columns:
            df = df.where(F.col(MALFORMED).isNull()).drop(MALFORMED)
        views[name] = df.withColumns({c: F.col(c).try_cast(t) for c, t in columns.items()}) if columns else df
    return views


def tidy(sql: str) -> str:
    return sql.strip().rstrip(";").rstrip()


def load_catalogue(directory: str, database_dialect: bool = False) -> dict[str, str]:
    """Report texts of a directory: every ``*.sql``, by name, keyed by stem.

    With ``database_dialect`` they are in the dialect of the database and are rewritten;
    a form that cannot be is an error that names the file.
    """
    root = Path(directory)
    if not root.is_dir():
        raise FileNotFoundError(directory)
    texts = {}
    for p in sorted(root.glob("*.sql")):
        text = tidy(p.read_text(encoding="utf-8"))
        try:
            texts[p.stem] = dialect.to_spark(text) if database_dialect else text
        except dialect.Unsupported as e:
            raise dialect.Unsupported(f"{p.name}: {e}") from e
    return texts


def run_reports(
    spark: SparkSession,
    views: Mapping[str, DataFrame],
    catalogue: Mapping[str, str] = REPORTS,
) -> ReportRun:
    """Plan every report over ``views``; one bad report does not stop the others.

    Each view exists under a name of its own and only while the reports are planned;
    a report sees it by the plain name through a common table expression, so views
    of the caller are neither replaced nor dropped.
    """
    run, own = ReportRun(), {name: f"clearwell_{uuid4().hex}" for name in views}
    known = ", ".join(f"`{name}` AS (SELECT * FROM {view})" for name, view in own.items())
    try:
        for name, df in views.items():
            df.createTempView(own[name])
        for name, sql in catalogue.items():
            try:
                run.results[name] = spark.sql(f"WITH {known} SELECT * FROM ({tidy(sql)}\n)")
            except PySparkException as error:
                run.errors[name] = str(error)
    finally:
        for view in own.values():
            spark.catalog.dropTempView(view)
    return run


def write_reports(spark: SparkSession, run: ReportRun, base: str) -> ReportRun:
    """Write each report and the status of all; one that fails while running is noted.

    A failed write leaves the others alone: its message joins ``errors``, and the
    table ``_status`` under ``base`` lists every report with its outcome.
    """
    for name, df in list(run.results.items()):
        try:
            run.counts[name] = sinks.write_table(df, f"{base}/{name}")
        except PySparkException as error:
            del run.results[name]
            run.errors[name] = str(error)
    sinks.write_table(run.status(spark).coalesce(1), f"{base}/_status")
    return run


def report(spark: SparkSession, bronze: Mapping[str, DataFrame], name: str) -> DataFrame:
    run = run_reports(spark, raw_views(bronze), {name: REPORTS[name]})
    if run.errors:
        raise RuntimeError(run.errors[name])
    return run.results[name]
