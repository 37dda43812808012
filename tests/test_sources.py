"""Readers, drift, sinks, reports and the whole pipeline on files."""

import json

import pytest
from compare import connect, rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalog import oracles
from catalog.bronze import bronze
from catalog.queries import portable, valid_tables
from clearwell.operators import silver
from clearwell.plans import controls, gold, pipeline, reports
from clearwell.plans.entities import DELIVERY_EVENTS, ENTITIES, ORDERS, REVIEWS
from clearwell.sources import drift, readers, sinks

SF = "/root/testdata/sf0.001"


def test_csv_is_read_as_text(spark, tmp_path):
    (tmp_path / "orders.csv").write_text(
        "order_id,customer_id,order_date,status,payment_method,total_amount,currency\r\n"
        " ORD2,c004,bad-date,paid,WIRE,-20,\r\n",
        newline="",
    )
    row = readers.read_csv_text(
        spark, str(tmp_path / "orders.csv"), ORDERS.raw_schema
    ).first()
    assert (row.order_id, row.total_amount, row.currency) == (" ORD2", "-20", None)


EVENT = (
    '{"event_id": "E1", "order_id": "1", "event_type": "SHIPPED",'
    ' "event_timestamp": "2026-03-17T08:30:00",'
    ' "location": {"city": "Paris", "country": "FR"}, "carrier": null}'
)


@pytest.mark.parametrize("multi_line", [False, True])
def test_json_with_declared_schema(spark, tmp_path, multi_line):
    text = f"[\n{EVENT},\n{EVENT}\n]" if multi_line else f"{EVENT}\n{EVENT}\n"
    (tmp_path / "a.json").write_text(text)
    (tmp_path / "notes.txt").write_text("not json")
    events = readers.read_delivery_events(spark, str(tmp_path), multi_line)
    assert events.schema == readers.delivery_events_schema()
    assert events.count() == 2
    cleaned = silver.clean(events, DELIVERY_EVENTS).first()
    assert cleaned.carrier is not None and cleaned.carrier.id is None
    inferred = readers.read_json(spark, str(tmp_path), multi_line=multi_line)
    assert drift.schema_diff(spark, inferred.schema, events.schema).collect() == [
        ("carrier", "type_differs", "struct", "string"),
        ("carrier.id", "missing", "string", None),
        ("carrier.name", "missing", "string", None),
    ]


def test_schema_diff_ignores_field_order(spark):
    a = T.StructType.fromDDL("a int, b struct<c: string, d: int>")
    b = T.StructType.fromDDL("b struct<d: int, c: string>, a int")
    assert drift.schema_diff(spark, a, b).isEmpty()


def test_document_drift(spark):
    docs = [
        ('{"a": "x", "n": {"k": "v"}}',),
        ('{"a": 1, "n": {"k": null, "z": true}, "new": 2}',),
        ("{}",),
        ('{"n": "flat"}',),
    ]
    df = spark.createDataFrame(docs, "doc string")
    want = T.StructType.fromDDL("a string, n struct<k: string>")
    got = {tuple(r) for r in drift.document_drift(df, "doc", want).collect()}
    assert got == {
        ("a", "type_differs", "string", "bigint", 1),
        ("a", "missing", "string", None, 2),
        ("n", "missing", "struct", None, 1),
        ("n", "type_differs", "struct", "string", 1),
        ("n.k", "missing", "string", None, 2),
        ("n.z", "unexpected", None, "boolean", 1),
        ("new", "unexpected", None, "bigint", 1),
    }


def test_drift_reaches_every_depth(spark):
    want = T.StructType.fromDDL(
        "id bigint, price double, a struct<b: struct<c: string>>, tags array<string>,"
        " lines array<struct<sku: string, n: int>>, m map<string, int>, day date"
    )
    good = (
        '{"id": 1, "price": 1.5, "a": {"b": {"c": "x"}}, "tags": ["t"],'
        ' "lines": [{"sku": "s", "n": 2}], "m": {"k": 1}, "day": "2026-01-01"}'
    )
    deep = (
        '{"id": 2, "price": 12.25, "a": {"b": {"c": {"d": [1]}}}, "tags": [1, 2],'
        ' "lines": [{"sku": 1, "n": 2}, {"sku": "s", "n": 2, "x": true}], "m": {}, "day": 5}'
    )
    df = spark.createDataFrame([(good,), (good,), (deep,)], "doc string").repartition(2)
    got = {tuple(r) for r in drift.document_drift(df, "doc", want).collect()}
    assert got == {
        ("a.b.c", "type_differs", "string", "struct", 1),
        ("a.b.c.d", "unexpected", None, "array", 1),
        ("a.b.c.d[]", "unexpected", None, "bigint", 1),
        ("tags[]", "type_differs", "string", "bigint", 1),
        ("lines[].sku", "type_differs", "string", "bigint", 1),
        ("lines[].x", "unexpected", None, "boolean", 1),
        ("day", "type_differs", "date", "bigint", 1),
    }
    nested = "[" * 400 + "]" * 400
    many = spark.createDataFrame([(f'{{"id": {nested}}}',)], "doc string")
    assert drift.document_drift(many, "doc", T.StructType.fromDDL("id array<int>")).count() > 300


def test_drift_of_malformed_texts_and_dotted_names(spark):
    docs = [("{broken",), (None,), ("[1]",), ('{"n.k": 1, "n": {"k": "v"}}',), ('{"n": {"k": "v"}, "`": 1}',)]
    df = spark.createDataFrame(docs, "doc string")
    got = {tuple(r) for r in drift.document_drift(df, "doc", T.StructType.fromDDL("n struct<k: string>")).collect()}
    assert got == {
        ("", "malformed", "struct", None, 3),
        ("`n.k`", "unexpected", None, "bigint", 1),
        ("````", "unexpected", None, "bigint", 1),
    }
    assert drift.document_drift(df.limit(0), "doc", T.StructType.fromDDL("a int")).count() == 0


def test_schema_diff_ignores_field_order_inside_arrays(spark):
    a = T.StructType.fromDDL("x array<struct<b: int, c: array<struct<d: int, e: int>>>>")
    b = T.StructType.fromDDL("x array<struct<c: array<struct<e: int, d: int>>, b: int>>")
    assert drift.schema_diff(spark, a, b).isEmpty()
    c = T.StructType.fromDDL("x array<struct<c: array<struct<e: int, d: string>>, b: int>>")
    assert [tuple(r) for r in drift.schema_diff(spark, a, c).collect()] == [
        ("x[].c[].d", "type_differs", "string", "int")
    ]


def test_jdbc_options():
    split = readers.JdbcRange("id", "0", "1000", 8)
    scan = readers.jdbc_options("jdbc:x", table="public.orders", split=split, user="u")
    assert scan["dbtable"] == "public.orders" and scan["user"] == "u"
    assert (scan["partitionColumn"], scan["numPartitions"]) == ("id", "8")
    query = readers.jdbc_options("jdbc:x", query="SELECT 1;\n")
    assert query["dbtable"] == "(SELECT 1) AS pushed_query"
    with pytest.raises(ValueError):
        readers.jdbc_options("jdbc:x")
    with pytest.raises(ValueError):
        readers.jdbc_options("jdbc:x", table="t", query="q")


def test_document_connector_options_are_required(spark):
    with pytest.raises(ValueError, match="collection"):
        readers.read_documents(spark, "json", {"uri": "x"}, ["uri", "collection"])


def test_document_connector_passes_through(spark, tmp_path):
    (tmp_path / "r.json").write_text('{"_id": "REV1", "rating": 5}\n')
    df = readers.read_documents(spark, "json", {"path": str(tmp_path)}, ["path"])
    assert df.first().rating == 5


def test_all_sources_are_required(spark):
    with pytest.raises(KeyError, match="reviews"):
        readers.load_sources(spark, {})


def test_raw_tables_are_text_whatever_the_source_types(spark):
    df = spark.sql(
        "SELECT 'R1' AS _id, 'c1' AS customerId, 'p1' AS productId, 'o1' AS orderId,"
        " 4 AS rating, '' AS comment, date'2026-03-01' AS reviewDate,"
        " true AS verifiedPurchase"
    )
    valid, _ = silver.split(readers.as_raw(df, "reviews"), REVIEWS)
    row = valid.first()
    assert (row.rating, str(row.reviewDate), row.verifiedPurchase) == (4, "2026-03-01", True)


def test_parquet_round_trip_counts_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(10).withColumn("part", F.col("id") % 2)
    assert sinks.write_table(df, path, partition_by=["part"]) == 10
    assert sinks.write_table(df.where("id < 3"), path) == 3
    assert sinks.write_table(df.where("id < 0"), path) == 0
    assert spark.read.schema(df.schema).parquet(path).count() == 0


def test_shared_dir_comes_from_the_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir")
    assert sinks.shared_dir(spark, "/elsewhere") == configured.rstrip("/")


def views(spark):
    money = "total_amount decimal(10,2)"
    return {
        "orders": spark.createDataFrame(
            [
                ("1", "a", "01/03/2026", "paid", None),
                ("2", "b", "2026-03-02", " annulée ", 5),
                ("3", "b", "2026-03-02 10:00:00", None, 7),
                ("4", "b", "31/02/2026", "paid", 9),
            ],
            "order_id string, customer_id string, order_date string, status string,"
            " total_amount int",
        ).withColumn("total_amount", F.col("total_amount").cast(money.split()[1])),
        "customers": spark.createDataFrame(
            [("b", None, "Lee", "x"), ("b", None, "Lee", "x")],
            "customer_id string, first_name string, last_name string, email string",
        ),
    }


def test_reports_on_awkward_rows(spark):
    run = reports.run_reports(spark, views(spark))
    # nothing offers order items here; only that report fails, and says why
    assert set(run.errors) == {"01_sales_by_product"}
    assert not spark.catalog.tableExists("orders")
    top = run.results["05_top_customers"].collect()
    assert [tuple(r)[:3] for r in top] == [("a", " ", 1), ("b", " Lee", 3)]
    assert [r.total_spent for r in top] == [None, 42]
    monthly = run.results["04_monthly_revenue"].collect()
    assert [(str(r[0]), r[1], int(r[2]), float(r[3])) for r in monthly] == [
        ("2026-03-01", 2, 7, 7.0)
    ]
    status = run.results["03_orders_by_status"].where("status = 'paid'").first()
    assert (status.number_of_orders, status.average_amount) == (2, 9)


def test_a_bad_report_does_not_stop_the_others(spark, tmp_path):
    (tmp_path / "b.sql").write_text("SELECT count(*) AS n FROM orders;\n")
    (tmp_path / "a.sql").write_text("SELECT nope FROM orders")
    catalogue = reports.load_catalogue(str(tmp_path))
    assert list(catalogue) == ["a", "b"]
    run = reports.run_reports(spark, views(spark), catalogue)
    assert run.results["b"].first().n == 4 and "nope" in run.errors["a"]
    assert {tuple(r)[:2] for r in run.status(spark).collect()} == {
        ("a", "ERREUR"),
        ("b", "OK"),
    }
    with pytest.raises(FileNotFoundError):
        reports.load_catalogue(str(tmp_path / "none"))


def test_pipeline_writes_every_layer(spark, tmp_path):
    """End to end on the benchmark tables; every written table equals its SQL."""
    out, staging = str(tmp_path / "out"), str(tmp_path / "staging")
    run = pipeline.run_pipeline(
        spark, bronze(spark, SF), out, staging, gold_tables=list(gold.BUILDERS)
    )
    con, sql = connect(SF), oracles.oracle_sql()
    written = {f"gold/{name}": name for name in gold.BUILDERS}
    written |= {f"sql_results/{name}": f"report_{name[3:]}" for name in reports.REPORTS}
    written |= {
        "quality/silver_counts": "silver_counts",
        "quality/silver_quality": "quality_silver",
        "validation_results": "validation_results",
    }
    for path, query in written.items():
        got = portable(spark.read.parquet(f"{out}/{path}"))
        cursor = con.execute(sql[query])
        want = rows([d[0] for d in cursor.description], cursor.fetchall())
        assert rows(got.columns, got.collect()) == want, path
        layer, _, table = path.rpartition("/")
        if layer:
            assert run.counts[layer][table] == len(want)

    counted = con.execute(sql["silver_counts"]).fetchall()
    assert run.counts["rejects"] == {r[0]: r[2] for r in counted}
    parts = [spark.read.parquet(f"{out}/rejects/{e}") for e in ENTITIES]
    columns = ["source", "rejection_reason", "original_data"]
    got = [tuple(r) for p in parts for r in p.select(*columns).collect()]
    assert sorted(got) == sorted(con.execute(sql["reject_envelope"]).fetchall())


CSV_FILES = {
    "customers": [
        "customer_id,first_name,last_name,email,phone,city,country,birth_date,created_at",
        "c001,ann,LEE,Ann@x.org,0612345678,PARIS,fr,1990-01-02,2026-01-01 10:00:00",
        "' C002',bo,,bo-at-x.org,,lyon,france,31-02-2020,2026-01-01 10:00:00",
        "cust-17,cy,poe,cy@x.org,0033612345678,,French Republic,,2026-01-01 10:00:00",
    ],
    "orders": [
        "order_id,customer_id,order_date,status,payment_method,total_amount,currency",
        "ord-0001,c001,2026/03/01,paid,cb,-20,",
        "' ORD2',C001,01/03/2026,annulée,virement,5.50,EUR",
        "ORD-0003,C999,bad-date,Terminée,paypal,7,usd",
    ],
    "products": [
        "product_id,product_name,category,brand,current_price,active",
        "P1,blue pen,high-tech,hp,1.20,True",
        "p002,mug,INFORMATIQUE,acme,3,False",
    ],
    "order_items": [
        "order_id,product_id,quantity,unit_price,discount",
        "ord1,p1,2,10.00,0.1",
        "ORD-0001,P001,1,10.00,",
        "ORD-0001,P002,3,-5,0",
        "ORD-0002,P001,0,10,0",
        "ORD-0002,P009,-1,10,0",
    ],
}
JSON_FILES = {
    "reviews": [
        {"_id": "R1", "customerId": "c1", "productId": "p1", "orderId": "ord1", "rating": 4, "comment": " ok ", "reviewDate": "2026-03-02T10:00:00Z", "verifiedPurchase": True},
        {"_id": "R2", "customerId": "c1", "productId": "P999", "orderId": "ord1", "rating": 2, "comment": "", "reviewDate": None, "verifiedPurchase": "no"},
        {"_id": "R3", "customerId": "c1", "productId": "P1", "orderId": "ord1", "rating": 7, "comment": "x", "reviewDate": None, "verifiedPurchase": 0},
    ],
    "delivery_events": [
        {"event_id": "E1", "order_id": "ord1", "event_type": "shipped", "event_timestamp": "2026-03-02T08:00:00", "location": {"city": "paris", "country": "fr"}, "carrier": {"id": "dhl1", "name": "dhl"}},
        {"event_id": "E2", "order_id": "ord1", "event_type": "X", "event_timestamp": "2026-03-02T09:00:00", "location": {"city": "paris", "country": "fr"}, "carrier": {"id": "dhl1", "name": "dhl"}},
    ],
}


@pytest.fixture
def sources(tmp_path):
    """CSV files with CRLF ends and JSON collections, as the sources deliver them."""
    found = {}
    for name, lines in CSV_FILES.items():
        (tmp_path / f"{name}.csv").write_bytes(("\r\n".join(lines).replace("'", "") + "\r\n").encode())
        found[name] = readers.Source("csv", str(tmp_path / f"{name}.csv"), {"header": "true"}, ENTITIES[name].raw_schema)
    for name, documents in JSON_FILES.items():
        (tmp_path / name / "2026" / "03").mkdir(parents=True)
        (tmp_path / name / "2026" / "03" / "a.json").write_text(json.dumps(documents))
        options = {"multiLine": "true", "recursiveFileLookup": "true", "pathGlobFilter": "*.json"}
        found[name] = readers.Source("json", str(tmp_path / name), options, ENTITIES[name].raw_schema)
    return found


def test_pipeline_on_files(spark, sources, tmp_path):
    """Files to reports; the expected values are worked out by hand from the rules."""
    out = str(tmp_path / "out")
    bronze = readers.load_sources(spark, sources)
    run = pipeline.run_pipeline(
        spark, bronze, out, str(tmp_path / "staging"), quality_score=True, currencies=["EUR"]
    )
    assert run.staging == str(tmp_path / "staging") and run.report_errors == {}

    def table(path):
        return spark.read.parquet(f"{out}/{path}")

    counts = {r.entity: (r.n_valid, r.n_rejected) for r in table("quality/silver_counts").collect()}
    assert counts == {
        "customers": (2, 1),
        "orders": (3, 0),
        "products": (2, 0),
        "order_items": (2, 3),
        "reviews": (2, 1),
        "delivery_events": (1, 1),
    }
    reasons = table("rejects/order_items").groupBy("rejection_reason").count().collect()
    assert {r[0]: r[1] for r in reasons} == {"QUANTITY_NOT_POSITIVE": 2, "DISCOUNT_INVALID": 1}
    sales = {r.product_id: (r.quantity_sold, float(r.revenue)) for r in table("gold/sales_by_product").collect()}
    assert sales == {"P001": (2, 18.0), "P002": (3, 15.0)}
    orders = {r.order_id: r for r in table("gold/customer_order_360").collect()}
    assert sorted(orders) == ["ORD-0001", "ORD-0002", "ORD-0003"]
    first = orders["ORD-0001"]
    assert (first.number_of_products, first.total_quantity, float(first.net_amount)) == (2, 5, 33.0)
    assert first.product_names == "Blue Pen, Mug" and first.number_of_reviews == 2
    assert (first.last_delivery_status, first.customer_found) == ("SHIPPED", True)
    assert not orders["ORD-0003"].customer_found and orders["ORD-0003"].order_date is None
    checks = {(r.entity, r.check_name): r.n_bad for r in table("quality/silver_quality").collect()}
    assert [n for (e, c), n in checks.items() if e == "orders" and "currency" in c.lower()]
    controls = {r.controle: r.statut for r in table("validation_results").collect()}
    assert controls["Colonne data_quality_score absente"] == "OK"
    status = {r.report: r.status for r in table("sql_results/_status").collect()}
    assert status == {name: "OK" for name in reports.REPORTS}
    month = table("sql_results/04_monthly_revenue").collect()
    assert len(month) == 0  # one date is cancelled, the others have spellings it does not know


def test_empty_and_unsplit_sources_are_refused(spark, sources, tmp_path):
    (tmp_path / "none").mkdir()
    with pytest.raises(ValueError, match="no rows"):
        readers.read_delivery_events(spark, str(tmp_path / "none"))
    assert readers.read_delivery_events(spark, str(tmp_path / "none"), allow_empty=True).count() == 0
    deep = str(tmp_path / "delivery_events")
    assert readers.read_delivery_events(spark, deep, multi_line=True, recursive=True).count() == 2
    empty = readers.Source("json", str(tmp_path / "none"), {}, ENTITIES["reviews"].raw_schema)
    with pytest.raises(ValueError, match="source reviews"):
        readers.load_sources(spark, sources | {"reviews": empty})
    assert readers.load_sources(spark, sources | {"reviews": empty}, allow_empty=True)["reviews"].count() == 0
    with pytest.raises(ValueError, match="split"):
        readers.read_source(spark, readers.Source("jdbc", options={"url": "jdbc:x", "dbtable": "t"}))
    with pytest.raises(ValueError, match="split"):
        readers.read_jdbc(spark, "jdbc:x", table="t")


def test_reports_leave_the_callers_views_alone(spark):
    spark.range(3).createOrReplaceTempView("orders")
    try:
        run = reports.run_reports(spark, views(spark), {"n": "SELECT count(*) AS n FROM orders"})
        assert run.results["n"].first().n == 4
        assert spark.table("orders").count() == 3
        with pytest.raises(AttributeError):  # no text: not an error of a report
            reports.run_reports(spark, views(spark), {"worse": None})
        assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("clearwell_")]
    finally:
        spark.catalog.dropTempView("orders")


def test_a_report_that_fails_while_running_is_isolated(spark, tmp_path):
    catalogue = {
        "a_bad": "SELECT CAST(order_date AS INT) AS n FROM orders",
        "b_good": "SELECT count(*) AS n FROM orders",
    }
    planned = reports.run_reports(spark, views(spark), catalogue)
    assert set(planned.results) == set(catalogue)
    done = reports.write_reports(spark, planned, str(tmp_path / "r"))
    assert done.counts == {"b_good": 1} and set(done.errors) == {"a_bad"}
    status = {r.report: (r.status, r.error is None) for r in spark.read.parquet(str(tmp_path / "r/_status")).collect()}
    assert status == {"a_bad": ("ERREUR", False), "b_good": ("OK", True)}


def test_newest_rows_can_be_kept(spark, tmp_path):
    out = str(tmp_path / "out")
    run = pipeline.run_pipeline(
        spark, bronze(spark, SF), out, str(tmp_path / "staging"), ["delivery_status"], unique_keys=True
    )
    con, sql = connect(SF), oracles.oracle_sql()
    want = {r[0]: r[2] for r in con.execute(sql["duplicate_counts"]).fetchall()}
    assert run.counts["duplicates"] == want and sum(want.values()) > 0
    rejected = spark.read.parquet(f"{out}/duplicates/orders")
    assert {r[0] for r in rejected.select("rejection_reason").distinct().collect()} <= {"DUPLICATE_KEY"}
    controlled = spark.read.parquet(f"{out}/gold/delivery_status")
    assert controlled.count() == controlled.select("order_id").distinct().count()


def test_each_raw_source_is_read_once(spark, tmp_path):
    """Sources that refuse a second scan: the run still ends well."""
    reads = spark.sparkContext.accumulator(0)
    raw = dict(bronze(spark, SF))
    rows = raw["customers"].count()

    def seen(batches):
        for batch in batches:
            reads.add(batch.num_rows)
            yield batch

    raw["customers"] = raw["customers"].mapInArrow(seen, raw["customers"].schema)
    pipeline.run_pipeline(spark, raw, str(tmp_path / "out"), str(tmp_path / "staging"))
    assert reads.value == rows


def test_local_folders_are_refused_on_a_cluster():
    class Conf:
        def get(self, name, default=None):
            return default

    class Context:
        master = "spark://host:7077"

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError, match="allow_local"):
        sinks.check_shared(Session(), "file:///tmp/x")
    assert sinks.check_shared(Session(), "file:///tmp/x", allow_local=True)
    assert sinks.check_shared(Session(), "hdfs://name/x")


def test_the_shared_folder_of_a_cluster_is_accepted():
    class Conf:
        def get(self, name, default=None):
            return "file:///shared/kept" if name == "spark.checkpoint.dir" else default

    class Context:
        master = "spark://host:7077"

    class Session:
        conf, sparkContext = Conf(), Context()

    for path in ("file:///shared/kept", "file:///shared/kept/published-1"):
        assert sinks.check_shared(Session(), path) == path
    for path in ("file:///shared/kept2/x", "file:///shared/kept/../x", "/shared", "/tmp/x"):
        with pytest.raises(ValueError, match="allow_local"):
            sinks.check_shared(Session(), path)


def test_reading_orders(spark):
    """Every sorted view against the order worked out from its own rows."""
    tables, raw = valid_tables(spark, SF), bronze(spark, SF)

    def key_order(row):
        return row[1] is not None, row[1] or ""

    def ordered(df, value, key):
        got = [(r[value], r[key]) for r in df.collect()]
        nulls = [x for x in got if x[0] is None]
        rest = sorted([x for x in got if x[0] is not None], key=key_order)
        return got, nulls, sorted(rest, key=lambda x: x[0], reverse=True)

    for name, (value, key) in {
        "sales_by_product": ("revenue", "product_id"),
        "customer_orders": ("total_spent", "customer_id"),
        "product_ratings": ("average_rating", "product_id"),
        "delivery_status": ("last_event_timestamp", "order_id"),
    }.items():
        got, nulls, rest = ordered(gold.present(name, gold.BUILDERS[name](tables)), value, key)
        assert got == rest + sorted(nulls, key=key_order), name
    for name, (value, key) in {
        "01_sales_by_product": ("revenue", "product_id"),
        "02_customer_orders": ("total_spent", "customer_id"),
        "03_orders_by_status": ("number_of_orders", "status"),
        "05_top_customers": ("total_spent", "customer_id"),
    }.items():
        df = reports.present(name, reports.report(spark, raw, name))
        got, nulls, rest = ordered(df, value, key)
        assert got == sorted(nulls, key=key_order) + rest, name
    months = [r[0] for r in reports.report(spark, raw, "04_monthly_revenue").collect()]
    assert months == sorted(months)
    results = controls.present(controls.validation_results(gold.customer_order_360(tables)))
    got = [(r.statut, r.controle) for r in results.collect()]
    assert got == sorted(sorted(got, key=lambda x: x[1]), key=lambda x: x[0], reverse=True)
