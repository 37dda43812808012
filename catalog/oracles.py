"""DuckDB SQL for the registered queries, written from the rules.

Nothing here is generated from the Spark code: only the raw tables (see
``catalog.bronze``) are shared.  Joins are plain joins of raw rows, without the
pre-aggregation the Spark plans use, so they check it.
"""

from __future__ import annotations

from catalog.bronze import DUCKDB, TABLES, duckdb_sql

NAME_FALLBACK, UNKNOWN_F, UNKNOWN_M = "Produit supprimé", "Inconnue", "Inconnu"

# --- scalar rules ----------------------------------------------------------------------


def ident(x: str, prefix: str, width: int, exact: bool = False) -> str:
    digits = rf"regexp_extract({x}, '([0-9]+)', 1)"
    target = str(width) if exact else f"CAST(greatest({width}, length({digits})) AS INT)"
    return (
        f"CASE WHEN {digits} <> '' THEN '{prefix}' || lpad({digits}, {target}, '0') END"
    )


def customer_id(x: str, exact: bool = False) -> str:
    return ident(x, "C", 3, exact)


def order_id(x: str, exact: bool = False) -> str:
    return ident(x, "ORD-", 4, exact)


def product_id(x: str, exact: bool = False) -> str:
    return ident(x, "P", 3, exact)


def initcap(x: str) -> str:
    return (
        f"array_to_string(list_transform(string_split(lower({x}), ' '),"
        " lambda w: upper(w[1]) || w[2:]), ' ')"
    )


def name(x: str) -> str:
    return initcap(f"trim({x}, ' ')")


# The spellings that the cleaning rules know, by SQL value.
COUNTRY_SPELLINGS = ["fr", "france", "french republic"]
STATUS_SPELLINGS = {
    "'PAID'": ["paid", "payée", "payee"],
    "'COMPLETED'": ["completed", "complete", "terminée", "terminee"],
    "'CANCELLED'": ["cancelled", "canceled", "annulée", "annulee"],
    "'PENDING'": ["pending", "en attente"],
}
PAYMENT_SPELLINGS = {
    "'CARD'": ["credit card", "card", "cb", "carte bancaire"],
    "'WIRE'": ["bank transfer", "wire", "virement"],
    "'PAYPAL'": ["paypal"],
}
BOOLEAN_SPELLINGS = {
    "true": ["true", "yes", "oui", "1", "active", "verified"],
    "false": ["false", "no", "non", "0", "inactive"],
}
CATEGORY_SPELLINGS = {
    "'High-tech'": ["high tech", "hightech"],
    "'Electronique'": ["electronique"],
    "'Informatique'": ["informatique"],
}
EVENT_TYPES = [
    "ORDER_CREATED",
    "PREPARING",
    "SHIPPED",
    "IN_TRANSIT",
    "OUT_FOR_DELIVERY",
    "DELIVERED",
    "DELIVERY_FAILED",
    "CANCELLED",
]


def words(x: str, mapping: dict[str, list[str]], otherwise: str) -> str:
    cases = " ".join(
        f"WHEN {x} IN ({', '.join(repr(w) for w in spelled)}) THEN {value}"
        for value, spelled in mapping.items()
    )
    return f"CASE {cases} ELSE {otherwise} END"


def low(x: str) -> str:
    return f"lower(trim({x}, ' '))"


def up(x: str) -> str:
    return f"upper(trim({x}, ' '))"


def country(x: str) -> str:
    return words(
        low(x), {"'FRANCE'": COUNTRY_SPELLINGS}, f"nullif({up(x)}, '')"
    )


def status(x: str) -> str:
    return words(low(x), STATUS_SPELLINGS, up(x))


def payment(x: str) -> str:
    return words(low(x), PAYMENT_SPELLINGS, up(x))


def currency(x: str) -> str:
    return f"CASE WHEN {x} IS NULL OR trim({x}, ' ') = '' THEN 'EUR' ELSE {up(x)} END"


def boolean(x: str) -> str:
    return words(low(x), BOOLEAN_SPELLINGS, "NULL")


def category(x: str) -> str:
    spaced = f"lower(regexp_replace(trim({x}, ' '), '[-_]+', ' ', 'g'))"
    return words(spaced, CATEGORY_SPELLINGS, initcap(spaced))


def event_type(x: str) -> str:
    return words(up(x), {up(x): EVENT_TYPES}, "'UNKNOWN'")


def phone(x: str) -> str:
    kept = f"regexp_replace(trim({x}, ' '), '[^0-9+]', '', 'g')"
    plus = f"regexp_replace({kept}, '^0033', '+33')"
    full = (
        f"CASE WHEN regexp_matches({plus}, '^0[67][0-9]{{8}}$')"
        f" THEN '+33' || substr({plus}, 2) ELSE {plus} END"
    )
    return f"CASE WHEN regexp_matches({full}, '^[+]33[67][0-9]{{8}}$') THEN {full} END"


_SHAPES = {"%Y": "[0-9]{4}"} | {f"%{c}": "[0-9]{2}" for c in "mdHMS"}


def moment(x: str, *formats: str) -> str:
    """First format that parses; the digit counts are checked as well."""
    tries = []
    for f in formats:
        shape = f
        for code, digits in _SHAPES.items():
            shape = shape.replace(code, digits)
        tries.append(
            f"CASE WHEN regexp_matches({x}, '^{shape}$') THEN try_strptime({x}, '{f}') END"
        )
    return f"coalesce({', '.join(tries)})"


ISO, SLASH, FRENCH = "%Y-%m-%d", "%Y/%m/%d", "%d/%m/%Y"


def date(x: str) -> str:
    return f"CAST({moment(x, ISO, SLASH, FRENCH)} AS DATE)"


def review_date(x: str) -> str:
    return f"CAST({moment(x, ISO, FRENCH, SLASH, '%Y-%m-%dT%H:%M:%S')} AS DATE)"


def created_at(x: str) -> str:
    return moment(x, "%Y-%m-%d %H:%M:%S", "%Y/%m/%d %H:%M:%S", "%Y-%m-%dT%H:%M:%S")


def event_timestamp(x: str) -> str:
    return moment(
        x,
        "%Y-%m-%dT%H:%M:%S",
        "%Y-%m-%d %H:%M:%S",
        "%Y/%m/%d %H:%M:%S",
        "%d/%m/%Y %H:%M:%S",
    )


def integer(x: str) -> str:
    return (
        f"CASE WHEN regexp_matches({x}, '^[+-]?[0-9]+$') THEN TRY_CAST({x} AS INT) END"
    )


def money(x: str) -> str:
    return f"TRY_CAST({x} AS DECIMAL(10,2))"


def discount(x: str) -> str:
    d = f"TRY_CAST({x} AS DECIMAL(5,2))"
    # percent to ratio in whole cents, half up
    ratio = f"((CAST({d} * 100 AS INT) + 50) // 100) * CAST(0.01 AS DECIMAL(5,2))"
    return (
        f"CAST(CASE WHEN {d} < 0 THEN 0 WHEN {d} > 1 AND {d} <= 100 THEN {ratio}"
        f" ELSE {d} END AS DECIMAL(5,2))"
    )


# --- cleaned entities: column -> expression, then reason rules in order ----------------


def cleaned_columns(exact: bool = False) -> dict[str, dict[str, str]]:
    return {
        "customers": {
            "customer_id": customer_id("customer_id", exact),
            "first_name": name("first_name"),
            "last_name": name("last_name"),
            "email": low("email"),
            "phone": phone("phone"),
            "city": name("city"),
            "country": country("country"),
            "birth_date": date("birth_date"),
            "created_at": created_at("created_at"),
        },
        "orders": {
            "order_id": order_id("order_id", exact),
            "customer_id": customer_id("customer_id", exact),
            "order_date": date("order_date"),
            "status": status("status"),
            "payment_method": payment("payment_method"),
            "total_amount": f"abs({money('total_amount')})",
            "currency": currency("currency"),
        },
        "products": {
            "product_id": product_id("product_id", exact),
            "product_name": name("product_name"),
            "category": category("category"),
            "brand": name("brand"),
            "current_price": money("current_price"),
            "active": f"coalesce({boolean('active')}, false)",
        },
        "order_items": {
            "order_id": order_id("order_id", exact),
            "product_id": product_id("product_id", exact),
            "quantity": integer("quantity"),
            "unit_price": f"abs({money('unit_price')})",
            "discount": discount("discount"),
        },
        "reviews": {
            "_id": "trim(_id, ' ')",
            "customerId": customer_id('"customerId"', exact),
            "productId": product_id('"productId"', exact),
            "orderId": order_id('"orderId"', exact),
            "rating": integer("rating"),
            "comment": "trim(comment, ' ')",
            "reviewDate": review_date('"reviewDate"'),
            "verifiedPurchase": boolean('"verifiedPurchase"'),
        },
        "delivery_events": {
            "event_id": up("event_id"),
            "order_id": order_id("order_id", exact),
            "event_type": event_type("event_type"),
            "event_timestamp": event_timestamp("event_timestamp"),
            "location_city": name("city"),
            "location_country": country("country"),
            "carrier_id": up("carrier_id"),
            "carrier_name": name("carrier_name"),
        },
    }


REASONS = {
    "customers": [
        ("customer_id IS NULL", "CUSTOMER_ID_INVALID"),
        ("email IS NULL", "EMAIL_MISSING"),
        (
            "NOT regexp_matches(email,"
            " '^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+[.][A-Za-z]{2,}$')",
            "EMAIL_INVALID",
        ),
    ],
    "orders": [
        ("order_id IS NULL", "ORDER_ID_INVALID"),
        ("customer_id IS NULL", "CUSTOMER_ID_INVALID"),
        ("total_amount IS NULL", "TOTAL_AMOUNT_INVALID"),
    ],
    "products": [
        ("product_id IS NULL", "PRODUCT_ID_INVALID"),
        ("product_name IS NULL", "PRODUCT_NAME_MISSING"),
        ("current_price IS NULL", "CURRENT_PRICE_INVALID"),
        ("current_price <= 0", "CURRENT_PRICE_NOT_POSITIVE"),
    ],
    "order_items": [
        ("order_id IS NULL", "ORDER_ID_INVALID"),
        ("product_id IS NULL", "PRODUCT_ID_INVALID"),
        ("quantity IS NULL", "QUANTITY_INVALID"),
        ("quantity <= 0", "QUANTITY_NOT_POSITIVE"),
        ("unit_price IS NULL", "UNIT_PRICE_INVALID"),
        ("unit_price = 0", "UNIT_PRICE_ZERO"),
        ("discount IS NULL", "DISCOUNT_INVALID"),
        ("discount < 0 OR discount > 1", "DISCOUNT_OUT_OF_RANGE"),
    ],
    "reviews": [
        ("_id IS NULL", "REVIEW_ID_INVALID"),
        ('"productId" IS NULL', "PRODUCT_ID_INVALID"),
        ("rating IS NULL", "RATING_INVALID"),
        ("rating < 1 OR rating > 5", "RATING_OUT_OF_RANGE"),
    ],
    "delivery_events": [
        ("event_id IS NULL", "EVENT_ID_INVALID"),
        ("order_id IS NULL", "ORDER_ID_INVALID"),
        ("event_timestamp IS NULL", "EVENT_TIMESTAMP_INVALID"),
        ("event_type = 'UNKNOWN'", "EVENT_TYPE_UNKNOWN"),
    ],
}

# columns whose printed form must be fixed: decimals and temporal values
AS_DOUBLE = {"total_amount", "current_price", "unit_price", "discount"}
AS_TEXT = {"birth_date", "created_at", "order_date", "reviewDate", "event_timestamp"}


def raw_cte(entity: str) -> str:
    return f"raw_{entity} AS (\n{duckdb_sql(entity)}\n)"


def entity_ctes(entity: str) -> list[str]:
    """``raw_x``, ``cleaned_x`` (with reason) and ``x`` (valid rows)."""
    columns = cleaned_columns()[entity]
    listed = ",\n  ".join(f'{e} AS "{c}"' for c, e in columns.items())
    reasons = " ".join(f"WHEN {test} THEN '{why}'" for test, why in REASONS[entity])
    names = ", ".join(f'"{c}"' for c in columns)
    return [
        raw_cte(entity),
        f"values_{entity} AS (SELECT {listed}\nFROM raw_{entity})",
        f"cleaned_{entity} AS (SELECT *, CASE {reasons} END AS rejection_reason"
        f" FROM values_{entity})",
        f"silver_{entity} AS (SELECT {names} FROM cleaned_{entity}"
        " WHERE rejection_reason IS NULL)",
    ]


def with_(ctes: list[str], body: str) -> str:
    return "WITH " + ",\n".join(dict.fromkeys(ctes)) + "\n" + body


def silver(*entities: str) -> list[str]:
    return [cte for e in entities for cte in entity_ctes(e)]


ALL = tuple(TABLES)


def printed(column: str) -> str:
    quoted = f'"{column}"'
    if column in AS_DOUBLE:
        return f"CAST({quoted} AS DOUBLE) AS {quoted}"
    if column in AS_TEXT:
        return f"CAST({quoted} AS VARCHAR) AS {quoted}"
    return quoted


def printed_columns(entity: str) -> str:
    return ", ".join(printed(c) for c in cleaned_columns()[entity])


def dbl(expression: str, alias: str) -> str:
    return f"CAST({expression} AS DOUBLE) AS {alias}"


def txt(expression: str, alias: str) -> str:
    return f"CAST({expression} AS VARCHAR) AS {alias}"


def big(expression: str, alias: str) -> str:
    return f"CAST({expression} AS BIGINT) AS {alias}"


def cents_half_up(total: str, n: str) -> str:
    """total / n rounded half away from zero to two places; total has two places."""
    scaled = f"CAST({total} * 100 AS HUGEINT)"
    rounded = f"(2 * abs({scaled}) + {n}) // (2 * {n})"
    return f"sign({scaled}) * CAST({rounded} AS DOUBLE) / 100"


def rating(total: str, n: str) -> str:
    return f"CAST((200 * {total} + {n}) // (2 * {n}) AS DOUBLE) / 100"


# --- sources ------------------------------------------------------------------------------


def scan(entity: str) -> str:
    columns = TABLES[entity][1](DUCKDB)
    renamed = {"city": "location_city", "country": "location_country"}
    listed = ", ".join(
        f'"{c}" AS "{renamed[c]}"'
        if entity == "delivery_events" and c in renamed
        else f'"{c}"'
        for c in columns
    )
    return with_([raw_cte(entity)], f"SELECT {listed} FROM raw_{entity}")


def schema_drift() -> str:
    number = "TRY_CAST(regexp_extract(event_id, '([0-9]+)', 1) AS BIGINT)"
    key = f"coalesce({number}, 0)"
    docs = (
        "docs AS (SELECT *, " + key + " % 9 <> 4 AS has_carrier, "
        + key + " % 10 = 3 AS has_priority, "
        + key + " % 37 = 1 AS is_number FROM raw_delivery_events)"
    )

    def row(field: str, kind: str, expected: str, actual: str, condition: str) -> str:
        return (
            f"SELECT '{field}' AS field, '{kind}' AS kind, {expected} AS expected,"
            f" {actual} AS actual, count(*) AS n_docs FROM docs WHERE {condition}"
            " HAVING count(*) > 0"
        )

    absent = {
        "event_id": "event_id IS NULL",
        "order_id": "order_id IS NULL",
        "event_type": "event_type IS NULL",
        "event_timestamp": "event_timestamp IS NULL",
        "location.city": "city IS NULL",
        "location.country": "country IS NULL",
        "carrier.id": "NOT has_carrier OR carrier_id IS NULL",
        "carrier.name": "NOT has_carrier OR carrier_name IS NULL",
    }
    rows = [row(f, "missing", "'string'", "NULL", c) for f, c in absent.items()]
    rows.append(row("carrier", "missing", "'struct'", "NULL", "NOT has_carrier"))
    rows.append(
        row(
            "event_id",
            "type_differs",
            "'string'",
            "'bigint'",
            "is_number AND event_id IS NOT NULL",
        )
    )
    rows.append(row("priority", "unexpected", "NULL", "'bigint'", "has_priority"))
    return with_([raw_cte("delivery_events"), docs], "\nUNION ALL ".join(rows))


def reject_malformed() -> str:
    """The damaged lines and documents, spelled out as the readers see them."""
    order = "coalesce(TRY_CAST(regexp_extract(order_id, '([0-9]+)', 1) AS BIGINT), 0)"
    columns = list(TABLES["orders"][1](DUCKDB))
    values = [f"coalesce({c}, '')" for c in columns]
    quoted = " || ',' || ".join(f"""'"' || replace({v}, '"', '""') || '"'""" for v in values)
    lines = (
        f"lines AS (SELECT CASE {order} % 50 WHEN 7 THEN {values[0]} || ',' || {values[1]}"
        f" WHEN 8 THEN {quoted} || ',extra' WHEN 9 THEN {values[0]} || ',\"' || {values[1]} END AS original_data"
        " FROM raw_orders)"
    )
    number = "TRY_CAST(regexp_extract(event_id, '([0-9]+)', 1) AS BIGINT)"

    def text(name: str, column: str) -> str:
        return f"""'"{name}":' || CAST(to_json({column}) AS VARCHAR)"""

    def struct(name: str, *fields: tuple[str, str]) -> str:
        inner = ", ".join(text(f, c) for f, c in fields)
        return f"""'"{name}":{{' || concat_ws(',', {inner}) || '}}'"""

    event_id = f"""CASE WHEN k % 37 = 1 THEN '"event_id":' || k ELSE {text("event_id", "event_id")} END"""
    fields = ", ".join(
        [
            event_id,
            *[text(c, c) for c in ("order_id", "event_type", "event_timestamp")],
            struct("location", ("city", "city"), ("country", "country")),
            f"CASE WHEN k % 9 <> 4 THEN {struct('carrier', ('id', 'carrier_id'), ('name', 'carrier_name'))} END",
            """CASE WHEN k % 10 = 3 THEN '"priority":' || k % 3 END""",
        ]
    )
    keyed = f"keyed AS (SELECT *, coalesce({number}, 0) AS k FROM raw_delivery_events)"
    docs = f"docs AS (SELECT '{{' || concat_ws(',', {fields}) || '}}' AS doc FROM keyed)"
    key = """coalesce(TRY_CAST(regexp_extract(doc, '"event_id":"?\\D*(\\d+)', 1) AS BIGINT), 0)"""
    marked = f"marked AS (SELECT doc, {key} AS k FROM docs)"
    head = "SELECT '{}' AS source, 'MALFORMED' AS rejection_reason, {} AS original_data FROM {} WHERE {}"
    body = "\nUNION ALL ".join(
        [
            head.format("orders", "original_data", "lines", "original_data IS NOT NULL"),
            head.format("event_lines", "substr(doc, 1, length(doc) - 3)", "marked", "k % 40 = 3"),
            head.format("event_arrays", "'{\"event_id\":EVT' || k || '}'", "marked", "k % 40 = 5"),
        ]
    )
    return with_([raw_cte("orders"), raw_cte("delivery_events"), lines, keyed, docs, marked], body)


# --- normalisers ----------------------------------------------------------------------------


def normalised(*parts: tuple[str, str, str, str]) -> str:
    """Parts are (kind, entity, raw column, expression over ``raw_value``)."""
    selects = [
        f"SELECT '{kind}' AS kind, raw_value, {expression} AS value, n_rows FROM"
        f" (SELECT {column} AS raw_value, count(*) AS n_rows FROM raw_{entity}"
        " GROUP BY ALL)"
        for kind, entity, column, expression in parts
    ]
    ctes = [raw_cte(entity) for _, entity, _, _ in parts]
    return with_(ctes, "\nUNION ALL ".join(selects))


def normalisers() -> dict[str, str]:
    r = "raw_value"

    def ids(exact: bool) -> str:
        return normalised(
            ("customer", "orders", "customer_id", customer_id(r, exact)),
            ("order", "orders", "order_id", order_id(r, exact)),
            ("product", "products", "product_id", product_id(r, exact)),
        )

    def as_text(e: str) -> str:
        return f"CAST({e} AS VARCHAR)"

    def as_double(e: str) -> str:
        return f"CAST({e} AS DOUBLE)"

    return {
        "norm_ids": ids(False),
        "norm_ids_exact_width": ids(True),
        "norm_phone": normalised(("phone", "customers", "phone", phone(r))),
        "norm_dates": normalised(
            ("order_date", "orders", "order_date", as_text(date(r))),
            ("birth_date", "customers", "birth_date", as_text(date(r))),
            ("review_date", "reviews", '"reviewDate"', as_text(review_date(r))),
        ),
        "norm_timestamps": normalised(
            ("created_at", "customers", "created_at", as_text(created_at(r))),
            (
                "event_timestamp",
                "delivery_events",
                "event_timestamp",
                as_text(event_timestamp(r)),
            ),
        ),
        "norm_status": normalised(("status", "orders", "status", status(r))),
        "norm_payment": normalised(
            ("payment_method", "orders", "payment_method", payment(r))
        ),
        "norm_currency": normalised(("currency", "orders", "currency", currency(r))),
        "norm_country": normalised(
            ("customer", "customers", "country", country(r)),
            ("event", "delivery_events", "country", country(r)),
        ),
        "norm_category": normalised(("category", "products", "category", category(r))),
        "norm_boolean": normalised(
            ("verified", "reviews", '"verifiedPurchase"', boolean(r)),
            ("active", "products", "active", f"coalesce({boolean(r)}, false)"),
        ),
        "norm_money": normalised(
            ("total_amount", "orders", "total_amount", as_double(f"abs({money(r)})")),
            ("current_price", "products", "current_price", as_double(money(r))),
        ),
        "norm_discount": normalised(
            ("discount", "order_items", "discount", as_double(discount(r)))
        ),
        "norm_event_type": normalised(
            ("event_type", "delivery_events", "event_type", event_type(r))
        ),
        "norm_text": normalised(
            ("name", "customers", "first_name", name(r)),
            ("code", "delivery_events", "carrier_id", up(r)),
            ("email", "customers", "email", low(r)),
            ("text", "reviews", "comment", f"trim({r}, ' ')"),
        ),
    }


# --- cleaning, rejects --------------------------------------------------------------------------


def clean(entity: str) -> str:
    return with_(
        entity_ctes(entity), f"SELECT {printed_columns(entity)} FROM values_{entity}"
    )


def reject(entity: str) -> str:
    return with_(
        entity_ctes(entity),
        f"SELECT {printed_columns(entity)}, rejection_reason FROM cleaned_{entity}"
        " WHERE rejection_reason IS NOT NULL",
    )


# Key and recency of each entity.
UNIQUE_BY = {
    "customers": (["customer_id"], ["created_at"]),
    "orders": (["order_id"], ["order_date"]),
    "products": (["product_id"], []),
    "order_items": (["order_id", "product_id"], []),
    "reviews": (["_id"], ["reviewDate"]),
    "delivery_events": (["event_id"], ["event_timestamp"]),
}


def ranked(entity: str) -> str:
    """``ranked_x``: valid rows with their place among the rows of the key."""
    key, recency = UNIQUE_BY[entity]
    columns = list(cleaned_columns()[entity])
    order = recency + [c for c in columns if c not in recency]
    by = ", ".join(f'"{c}" DESC NULLS LAST' for c in order)
    keys = ", ".join(f'"{k}"' for k in key)
    null = " OR ".join(f'"{k}" IS NULL' for k in key)
    return (
        f"ranked_{entity} AS (SELECT *, {null} OR"
        f" row_number() OVER (PARTITION BY {keys} ORDER BY {by}) = 1 AS kept FROM silver_{entity})"
    )


def unique(entity: str) -> str:
    body = f"SELECT {printed_columns(entity)} FROM ranked_{entity} WHERE kept"
    return with_([*silver(entity), ranked(entity)], body)


def duplicate_counts() -> str:
    parts = [
        f"SELECT '{e}' AS entity, count(*) FILTER (kept) AS n_kept,"
        f" count(*) FILTER (NOT kept) AS n_duplicates FROM ranked_{e}"
        for e in ALL
    ]
    return with_([*silver(*ALL), *map(ranked, ALL)], "\nUNION ALL ".join(parts))


def reject_summary() -> str:
    parts = [
        f"SELECT '{e}' AS source, rejection_reason, count(*) AS n_rows"
        f" FROM cleaned_{e} WHERE rejection_reason IS NOT NULL GROUP BY ALL"
        for e in ALL
    ]
    return with_(silver(*ALL), "\nUNION ALL ".join(parts))


def reject_envelope() -> str:
    """Raw and cleaned row side by side, so that the raw one can be printed."""
    ctes, parts = [], []
    for e in ALL:
        columns = list(TABLES[e][1](DUCKDB))
        if e == "delivery_events":
            raw = (
                "event_id := event_id, order_id := order_id, event_type := event_type,"
                " event_timestamp := event_timestamp,"
                " location := struct_pack(city := city, country := country),"
                " carrier := struct_pack(id := carrier_id, name := carrier_name)"
            )
        else:
            raw = ", ".join(f'"{c}" := "{c}"' for c in columns)
        tests = cleaned_columns()[e]
        listed = ", ".join(f'{x} AS "{c}"' for c, x in tests.items())
        reasons = " ".join(f"WHEN {test} THEN '{why}'" for test, why in REASONS[e])
        ctes += [
            raw_cte(e),
            f"both_{e} AS (SELECT to_json(struct_pack({raw})) AS original_data,"
            f" {listed} FROM raw_{e})",
        ]
        parts.append(
            f"SELECT '{e}' AS source, rejection_reason, CAST(original_data AS VARCHAR)"
            f" AS original_data FROM (SELECT original_data, CASE {reasons} END AS"
            f" rejection_reason FROM both_{e}) WHERE rejection_reason IS NOT NULL"
        )
    return with_(ctes, "\nUNION ALL ".join(parts))


def silver_counts() -> str:
    parts = [
        f"SELECT '{e}' AS entity, count(*) FILTER (rejection_reason IS NULL) AS n_valid,"
        " count(*) FILTER (rejection_reason IS NOT NULL) AS n_rejected,"
        f" count(*) AS n_rows FROM cleaned_{e}"
        for e in ALL
    ]
    return with_(silver(*ALL), "\nUNION ALL ".join(parts))


def layer_counts() -> str:
    parts = [f"SELECT '{e}' AS table_name, count(*) AS n_rows FROM raw_{e}" for e in ALL]
    return with_([raw_cte(e) for e in ALL], "\nUNION ALL ".join(parts))


def null_profile() -> str:
    parts = []
    for e in ALL:
        for c in TABLES[e][1](DUCKDB):
            if e == "delivery_events" and c in ("country", "carrier_name"):
                continue
            struct = {"city": "location", "carrier_id": "carrier"}.get(c)
            if e == "delivery_events" and struct:
                # the struct itself is never NULL, whatever its fields are
                column, missing = struct, "0"
            else:
                column, missing = c, f"""count(*) FILTER ("{c}" IS NULL OR "{c}" = '')"""
            parts.append(
                f"SELECT '{e}' AS entity, '{column}' AS column_name,"
                f" {big(missing, 'n_missing')}, count(*) AS n_rows FROM raw_{e}"
            )
    return with_([raw_cte(e) for e in ALL], "\nUNION ALL ".join(parts))


# --- joins and business tables ----------------------------------------------------------------------

PRODUCT_LABELS = (
    f"coalesce(p.product_name, '{NAME_FALLBACK}') AS product_name,"
    f" coalesce(p.category, '{UNKNOWN_F}') AS category,"
    f" coalesce(p.brand, '{UNKNOWN_F}') AS brand"
)
LINE = "i.quantity * i.unit_price"


def line(expression: str) -> str:
    return f"CAST({expression} AS DECIMAL(20,2))"


SALES = f"""sales_by_product AS (
  SELECT i.product_id, {PRODUCT_LABELS},
         {big("sum(i.quantity)", "quantity_sold")},
         {dbl(f"sum({line(LINE + ' * (1 - i.discount)')})", "revenue")}
  FROM silver_order_items i LEFT JOIN silver_products p USING (product_id)
  GROUP BY ALL)"""

CUSTOMER_ORDERS = f"""customer_orders AS (
  SELECT o.customer_id,
         CASE WHEN c.customer_id IS NULL THEN 'Client inconnu'
              ELSE concat_ws(' ', c.first_name, c.last_name) END AS full_name,
         coalesce(c.email, '{UNKNOWN_M}') AS email,
         coalesce(c.city, '{UNKNOWN_F}') AS city,
         coalesce(c.country, '{UNKNOWN_M}') AS country,
         c.customer_id IS NOT NULL AS customer_found,
         count(DISTINCT o.order_id) AS number_of_orders,
         {dbl("coalesce(sum(o.total_amount), 0)", "total_spent")}
  FROM silver_orders o LEFT JOIN silver_customers c ON o.customer_id = c.customer_id
  GROUP BY ALL)"""

RATINGS = f"""product_ratings AS (
  SELECT r."productId" AS product_id, {PRODUCT_LABELS},
         p.product_id IS NOT NULL AS product_found,
         {rating("sum(r.rating)", "count(r.rating)")} AS average_rating,
         count(r._id) AS number_of_reviews,
         count(*) FILTER (r."verifiedPurchase") AS verified_reviews
  FROM silver_reviews r LEFT JOIN silver_products p ON r."productId" = p.product_id
  GROUP BY r."productId", p.product_name, p.category, p.brand, p.product_id)"""

ITEMS = f"""order_items_summary AS (
  SELECT order_id, count(DISTINCT product_id) AS number_of_products,
         {big("sum(quantity)", "total_quantity")},
         {dbl(f"sum({line(LINE)})", "gross_amount")},
         {dbl(f"sum({line(LINE + ' * i.discount')})", "discount_amount")},
         {dbl(f"sum({line(LINE + ' * (1 - i.discount)')})", "net_amount")}
  FROM silver_order_items i GROUP BY order_id)"""


def listed(column: str) -> str:
    return f"array_to_string(list_sort(list_distinct(list({column}))), ', ')"


PRODUCTS = f"""order_products_summary AS (
  SELECT order_id, {listed("product_name")} AS product_names,
         {listed("category")} AS categories, {listed("brand")} AS brands,
         count(DISTINCT category) AS number_of_categories
  FROM (SELECT i.order_id, {PRODUCT_LABELS}
        FROM silver_order_items i LEFT JOIN silver_products p USING (product_id))
  GROUP BY order_id)"""

REVIEWS = f"""order_reviews_summary AS (
  SELECT "orderId" AS order_id,
         {rating("sum(rating)", "count(rating)")} AS average_rating,
         count(_id) AS number_of_reviews,
         count(*) FILTER ("verifiedPurchase") AS verified_reviews
  FROM silver_reviews GROUP BY "orderId")"""

LAST_EVENT = """last_event AS (
  SELECT order_id, event_timestamp AS last_event_timestamp,
         event_type AS last_delivery_status,
         location_city AS last_city, location_country AS last_country,
         carrier_id, carrier_name
  FROM silver_delivery_events
  QUALIFY row_number() OVER (PARTITION BY order_id
          ORDER BY event_timestamp DESC NULLS LAST, event_id DESC NULLS LAST) = 1)"""

DELIVERY = """delivery_moments AS (
  SELECT order_id, min(event_timestamp) AS first_event_timestamp,
         count(*) AS number_of_events,
         min(event_timestamp) FILTER
           (event_type IN ('SHIPPED', 'IN_TRANSIT', 'OUT_FOR_DELIVERY')) AS shipping_date,
         min(event_timestamp) FILTER (event_type = 'DELIVERED') AS delivery_date
  FROM silver_delivery_events GROUP BY order_id),
delivery_summary AS (
  SELECT * FROM delivery_moments JOIN last_event USING (order_id))"""

STATUS = f"""delivery_status AS (
  SELECT o.order_id, o.customer_id, o.order_date,
         coalesce(d.last_delivery_status, 'AUCUN ÉVÉNEMENT') AS delivery_status,
         d.first_event_timestamp, d.last_event_timestamp,
         coalesce(d.number_of_events, 0) AS number_of_events,
         d.shipping_date, d.delivery_date,
         coalesce(d.last_city, '{UNKNOWN_F}') AS last_known_city,
         coalesce(d.last_country, '{UNKNOWN_M}') AS last_known_country,
         coalesce(d.carrier_id, '{UNKNOWN_M}') AS carrier_id,
         coalesce(d.carrier_name, '{UNKNOWN_M}') AS carrier_name,
         d.order_id IS NOT NULL AS delivery_event_found
  FROM silver_orders o LEFT JOIN delivery_summary d ON o.order_id = d.order_id)"""

ORDER_360 = f"""customer_order_360 AS (
  SELECT o.order_id, o.customer_id, o.order_date, o.status AS order_status,
         o.total_amount AS order_total_amount,
         c.first_name, c.last_name, c.email, c.city AS customer_city,
         c.country AS customer_country, c.customer_id IS NOT NULL AS customer_found,
         coalesce(oi.number_of_products, 0) AS number_of_products,
         coalesce(oi.total_quantity, 0) AS total_quantity,
         coalesce(oi.gross_amount, 0) AS gross_amount,
         coalesce(oi.discount_amount, 0) AS discount_amount,
         coalesce(oi.net_amount, 0) AS net_amount,
         coalesce(op.product_names, 'Aucun produit') AS product_names,
         coalesce(op.categories, '{UNKNOWN_F}') AS categories,
         coalesce(op.brands, '{UNKNOWN_F}') AS brands,
         coalesce(op.number_of_categories, 0) AS number_of_categories,
         r.average_rating,
         coalesce(r.number_of_reviews, 0) AS number_of_reviews,
         coalesce(r.verified_reviews, 0) AS verified_reviews,
         d.first_event_timestamp, d.last_event_timestamp,
         coalesce(d.number_of_events, 0) AS number_of_events,
         coalesce(d.last_delivery_status, 'AUCUN ÉVÉNEMENT') AS last_delivery_status,
         d.shipping_date, d.delivery_date,
         coalesce(d.last_city, '{UNKNOWN_F}') AS last_city,
         coalesce(d.last_country, '{UNKNOWN_M}') AS last_country,
         coalesce(d.carrier_id, '{UNKNOWN_M}') AS carrier_id,
         coalesce(d.carrier_name, '{UNKNOWN_M}') AS carrier_name,
         d.order_id IS NOT NULL AS delivery_found
  FROM silver_orders o
  LEFT JOIN silver_customers c ON o.customer_id = c.customer_id
  LEFT JOIN order_items_summary oi ON o.order_id = oi.order_id
  LEFT JOIN order_products_summary op ON o.order_id = op.order_id
  LEFT JOIN order_reviews_summary r ON o.order_id = r.order_id
  LEFT JOIN delivery_summary d ON o.order_id = d.order_id)"""

TABLE_CTES = {
    "sales_by_product": silver("order_items", "products") + [SALES],
    "customer_orders": silver("orders", "customers") + [CUSTOMER_ORDERS],
    "product_ratings": silver("reviews", "products") + [RATINGS],
    "order_items_summary": silver("order_items") + [ITEMS],
    "order_products_summary": silver("order_items", "products") + [PRODUCTS],
    "order_reviews_summary": silver("reviews") + [REVIEWS],
    "delivery_summary": silver("delivery_events") + [LAST_EVENT, DELIVERY],
    "delivery_status": silver("delivery_events", "orders")
    + [LAST_EVENT, DELIVERY, STATUS],
    "customer_order_360": silver(*ALL)
    + [ITEMS, PRODUCTS, REVIEWS, LAST_EVENT, DELIVERY, ORDER_360],
}

TEMPORAL = (
    "first_event_timestamp",
    "last_event_timestamp",
    "shipping_date",
    "delivery_date",
    "order_date",
)
TEMPORAL_IN = {
    "delivery_summary": TEMPORAL[:4],
    "delivery_status": TEMPORAL,
    "customer_order_360": TEMPORAL,
}


def table(name: str) -> str:
    changed = [txt(c, c) for c in TEMPORAL_IN.get(name, ())]
    if name == "customer_order_360":
        changed.append(dbl("order_total_amount", "order_total_amount"))
    replace = f" REPLACE ({', '.join(changed)})" if changed else ""
    return with_(TABLE_CTES[name], f"SELECT *{replace} FROM {name}")


def gold_counts() -> str:
    ctes = [cte for name in TABLE_CTES for cte in TABLE_CTES[name]]
    parts = [
        f"SELECT '{n}' AS table_name, count(*) AS n_rows FROM {n}" for n in TABLE_CTES
    ]
    return with_(ctes, "\nUNION ALL ".join(parts))


def latest_event() -> str:
    return with_(
        silver("delivery_events") + [LAST_EVENT],
        "SELECT * REPLACE (CAST(last_event_timestamp AS VARCHAR) AS"
        " last_event_timestamp) FROM last_event",
    )


def join_orders_customers() -> str:
    columns = ", ".join(
        printed(c).replace(f'"{c}"', f'o."{c}"', 1) if c not in AS_DOUBLE | AS_TEXT
        else f'CAST(o."{c}" AS {"DOUBLE" if c in AS_DOUBLE else "VARCHAR"}) AS "{c}"'
        for c in cleaned_columns()["orders"]
    )
    return with_(
        silver("orders", "customers"),
        f"SELECT {columns}, c.first_name, c.last_name, c.email, c.city AS"
        " customer_city, c.country AS customer_country, c.customer_id IS NOT NULL AS"
        " customer_found FROM silver_orders o LEFT JOIN silver_customers c"
        " ON o.customer_id = c.customer_id",
    )


def join_items_products() -> str:
    return with_(
        silver("order_items", "products"),
        "SELECT i.order_id, i.product_id, i.quantity,"
        f" {dbl('i.unit_price', 'unit_price')}, {dbl('i.discount', 'discount')},"
        f" {PRODUCT_LABELS}, p.product_id IS NOT NULL AS product_found"
        " FROM silver_order_items i LEFT JOIN silver_products p"
        " ON i.product_id = p.product_id",
    )


def join_orphans() -> str:
    relations = {
        "orders_customers": ("orders", "customer_id", "customers", "customer_id"),
        "order_items_orders": ("order_items", "order_id", "orders", "order_id"),
        "order_items_products": ("order_items", "product_id", "products", "product_id"),
        "reviews_products": ("reviews", '"productId"', "products", "product_id"),
        "reviews_orders": ("reviews", '"orderId"', "orders", "order_id"),
        "delivery_events_orders": ("delivery_events", "order_id", "orders", "order_id"),
    }
    parts = [
        f"SELECT '{r}' AS relation, count(*) AS n_rows, count(*) FILTER (NOT EXISTS"
        f" (SELECT 1 FROM silver_{dim} d WHERE d.{key} = f.{fk})) AS n_unmatched"
        f" FROM silver_{fact} f"
        for r, (fact, fk, dim, key) in relations.items()
    ]
    return with_(silver(*ALL), "\nUNION ALL ".join(parts))


# --- quality and controls ---------------------------------------------------------------------------

CHECKS = {
    "customers": {
        "customer_id_null": "customer_id IS NULL",
        "email_null": "email IS NULL",
        "phone_invalid": "phone IS NULL OR NOT regexp_matches(phone,"
        " '^[+]33[67][0-9]{8}$')",
    },
    "orders": {
        "order_id_null": "order_id IS NULL",
        "customer_id_null": "customer_id IS NULL",
        "total_amount_invalid": "total_amount IS NULL OR total_amount < 0",
    },
    "products": {
        "product_id_null": "product_id IS NULL",
        "product_name_null": "product_name IS NULL",
        "current_price_invalid": "current_price IS NULL OR current_price <= 0",
    },
    "order_items": {
        "order_id_null": "order_id IS NULL",
        "product_id_null": "product_id IS NULL",
        "quantity_invalid": "quantity IS NULL OR quantity <= 0",
        "unit_price_invalid": "unit_price IS NULL OR unit_price <= 0",
        "discount_invalid": "discount IS NULL OR discount < 0 OR discount > 1",
    },
    "reviews": {
        "review_id_null": "_id IS NULL",
        "order_id_null": '"orderId" IS NULL',
        "rating_invalid": "rating IS NULL OR rating < 1 OR rating > 5",
    },
    "delivery_events": {
        "event_id_null": "event_id IS NULL",
        "order_id_null": "order_id IS NULL",
        "event_timestamp_null": "event_timestamp IS NULL",
        "event_type_unknown": "event_type IS NULL OR event_type = 'UNKNOWN'",
    },
}


def quality(entity: str, checks: dict[str, str]) -> list[str]:
    return [
        f"SELECT '{entity}' AS entity, '{name}' AS check_name,"
        f" count(*) FILTER ({bad}) AS n_bad, count(*) AS n_rows FROM silver_{entity}"
        for name, bad in checks.items()
    ]


def quality_silver() -> str:
    parts = [p for e in ALL for p in quality(e, CHECKS[e])]
    return with_(silver(*ALL), "\nUNION ALL ".join(parts))


def quality_currency() -> str:
    domain = {
        "currency_outside_domain": "currency NOT IN ('EUR', 'USD', 'GBP', 'MAD')"
    }
    parts = quality("orders", CHECKS["orders"] | domain)
    return with_(silver("orders"), "\nUNION ALL ".join(parts))


STATUSES = (
    "'CREATED', 'PAID', 'PENDING', 'PREPARING', 'SHIPPED', 'COMPLETED', 'DELIVERED',"
    " 'CANCELLED', 'RETURNED', 'UNKNOWN'"
)
# amounts are compared as decimals: doubles would differ in the last place
NET = "CAST(net_amount AS DECIMAL(30,2))"
GROSS_LESS = (
    "CAST(gross_amount AS DECIMAL(30,2)) - CAST(discount_amount AS DECIMAL(30,2))"
)
CONTROLS = {
    "Order_id manquants": "order_id IS NULL",
    "Customer_id manquants": "customer_id IS NULL",
    "Montants négatifs ou absents": "order_total_amount IS NULL OR"
    " order_total_amount < 0 OR gross_amount < 0 OR discount_amount < 0 OR net_amount < 0",
    "Incohérence des montants calculés": f"{NET} <> {GROSS_LESS}",
    "Quantités ou compteurs négatifs": "number_of_products < 0 OR total_quantity < 0 OR"
    " number_of_categories < 0 OR number_of_reviews < 0 OR verified_reviews < 0 OR"
    " number_of_events < 0",
    "Notes moyennes hors intervalle": "average_rating < 1 OR average_rating > 5",
    "Livraison antérieure à la commande": "CAST(delivery_date AS DATE) < order_date",
    "Expédition antérieure à la commande": "CAST(shipping_date AS DATE) < order_date",
    "Livraison antérieure à l''expédition": "delivery_date < shipping_date",
    "Dernier événement antérieur au premier":
        "last_event_timestamp < first_event_timestamp",
    "Statuts de commande non normalisés":
        f"order_status IS NULL OR order_status NOT IN ({STATUSES})",
    "Commandes annulées marquées livrées":
        "order_status = 'CANCELLED' AND last_delivery_status = 'DELIVERED'",
    "Commandes livrées sans date": "(order_status = 'DELIVERED' OR"
    " last_delivery_status = 'DELIVERED') AND delivery_date IS NULL",
    "Date de livraison sans statut DELIVERED":
        "delivery_date IS NOT NULL AND last_delivery_status <> 'DELIVERED'",
    "Incohérence de l''indicateur customer_found": "NOT customer_found AND"
    " (first_name IS NOT NULL OR last_name IS NOT NULL OR email IS NOT NULL)",
    "Incohérence de l''indicateur delivery_found": "NOT delivery_found AND"
    " (first_event_timestamp IS NOT NULL OR last_event_timestamp IS NOT NULL OR"
    " number_of_events > 0)",
}


def validation() -> str:
    parts = [
        f"SELECT '{label}' AS controle, count(*) FILTER ({bad}) AS nombre_anomalies"
        " FROM customer_order_360"
        for label, bad in CONTROLS.items()
    ]
    parts += [
        "SELECT 'Unicité des commandes', count(*) FROM (SELECT order_id FROM"
        " customer_order_360 GROUP BY order_id HAVING count(*) > 1)",
        "SELECT 'Colonne data_quality_score absente', 1",
        "SELECT 'Scores qualité hors intervalle', 0",
    ]
    union = "\nUNION ALL ".join(parts)
    return with_(
        TABLE_CTES["customer_order_360"],
        f"SELECT controle, {big('nombre_anomalies', 'nombre_anomalies')},"
        " CASE WHEN nombre_anomalies = 0 THEN 'OK' ELSE 'ERREUR' END AS statut"
        f" FROM ({union})",
    )


def quality_score() -> str:
    broken = " + ".join(
        f"coalesce(CAST(({bad}) AS INT), 0)" for bad in CONTROLS.values()
    )
    n = len(CONTROLS)
    score = f"round(({n} - ({broken})) * 100.0 / {n}, 2)"
    return with_(
        TABLE_CTES["customer_order_360"],
        f"SELECT {dbl(score, 'data_quality_score')}, count(*) AS n_orders"
        " FROM customer_order_360 GROUP BY ALL",
    )


# --- reports over the raw tables -----------------------------------------------------------------------

TYPED = {
    "orders": f"orders_r AS (SELECT * REPLACE ({money('total_amount')} AS total_amount)"
    " FROM raw_orders)",
    "order_items": f"items_r AS (SELECT * REPLACE ({integer('quantity')} AS quantity,"
    f" {money('unit_price')} AS unit_price,"
    " TRY_CAST(discount AS DECIMAL(5,2)) AS discount) FROM raw_order_items)",
}
SPOKEN = "concat(c.first_name, ' ', c.last_name)"


def report_ctes(*entities: str) -> list[str]:
    ctes = [raw_cte(e) for e in entities]
    return ctes + [TYPED[e] for e in entities if e in TYPED]


def reports() -> dict[str, str]:
    day = "trim(order_date, ' ')"
    parsed = (
        f"CASE WHEN regexp_matches({day}, '^[0-9]{{2}}/[0-9]{{2}}/[0-9]{{4}}$')"
        f" THEN try_strptime({day}, '%d/%m/%Y')"
        f" WHEN regexp_matches({day}, '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}$')"
        f" THEN try_strptime({day}, '%Y-%m-%d')"
        f" WHEN regexp_matches({day}, '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}[ T]"
        "[0-9]{2}:[0-9]{2}:[0-9]{2}$')"
        f" THEN try_strptime(replace({day}, 'T', ' '), '%Y-%m-%d %H:%M:%S') END"
    )
    return {
        "report_sales_by_product": with_(
            report_ctes("order_items", "products"),
            f"SELECT i.product_id, {PRODUCT_LABELS},"
            f" {big('sum(i.quantity)', 'quantity_sold')},"
            f" {dbl(f'round(sum({LINE} * (1 - i.discount)), 2)', 'revenue')}"
            " FROM items_r i LEFT JOIN raw_products p ON i.product_id = p.product_id"
            " GROUP BY i.product_id, p.product_name, p.category, p.brand",
        ),
        "report_customer_orders": with_(
            report_ctes("orders", "customers"),
            f"SELECT o.customer_id, {SPOKEN} AS full_name,"
            f" coalesce(c.email, '{UNKNOWN_M}') AS email,"
            " count(DISTINCT o.order_id) AS number_of_orders,"
            f" {dbl('coalesce(sum(o.total_amount), 0)', 'total_spent')}"
            " FROM orders_r o LEFT JOIN raw_customers c"
            " ON o.customer_id = c.customer_id"
            " GROUP BY o.customer_id, c.first_name, c.last_name, c.email",
        ),
        "report_orders_by_status": with_(
            report_ctes("orders"),
            "SELECT status, count(*) AS number_of_orders,"
            f" {dbl('sum(total_amount)', 'total_amount')},"
            f" {cents_half_up('sum(total_amount)', 'count(total_amount)')}"
            " AS average_amount FROM orders_r GROUP BY status",
        ),
        "report_monthly_revenue": with_(
            report_ctes("orders")
            + [f"parsed AS (SELECT *, CAST({parsed} AS DATE) AS day FROM orders_r)"],
            f"SELECT {txt('CAST(date_trunc(' + repr('month') + ', day) AS DATE)', 'order_month')},"
            " count(*) AS number_of_orders,"
            f" {dbl('coalesce(sum(total_amount), 0)', 'monthly_revenue')},"
            f" coalesce({cents_half_up('sum(total_amount)', 'count(total_amount)')}, 0)"
            " AS average_order_amount FROM parsed WHERE day IS NOT NULL AND"
            " coalesce(upper(trim(status, ' ')), 'UNKNOWN') NOT IN"
            " ('CANCELLED', 'ANNULÉE', 'ANNULEE') GROUP BY date_trunc('month', day)",
        ),
        "report_top_customers": with_(
            report_ctes("orders", "customers"),
            f"SELECT o.customer_id, {SPOKEN} AS full_name,"
            " count(DISTINCT o.order_id) AS number_of_orders,"
            f" {dbl('sum(o.total_amount)', 'total_spent')}"
            " FROM orders_r o LEFT JOIN raw_customers c"
            " ON o.customer_id = c.customer_id"
            " GROUP BY o.customer_id, c.first_name, c.last_name"
            " ORDER BY sum(o.total_amount) DESC NULLS FIRST, o.customer_id, full_name"
            " LIMIT 10",
        ),
    }


def sql_results() -> str:
    texts = reports()
    names = {
        "01_sales_by_product": "report_sales_by_product",
        "02_customer_orders": "report_customer_orders",
        "03_orders_by_status": "report_orders_by_status",
        "04_monthly_revenue": "report_monthly_revenue",
        "05_top_customers": "report_top_customers",
    }
    return "\nUNION ALL ".join(
        f"SELECT '{n}' AS report, 'OK' AS status, count(*) AS n_rows FROM ({texts[q]}\n)"
        for n, q in names.items()
    )


def oracle_sql() -> dict[str, str]:
    found = {f"scan_{e}": scan(e) for e in ALL}
    found["source_csv_tables"] = scan("orders")
    found["source_json_declared"] = found["source_json_array"] = scan("delivery_events")
    found["reject_malformed"] = reject_malformed()
    found["source_splits"] = (
        "SELECT scan, n AS n_rows, n AS n_held, 0 AS n_repeated, true AS is_even"
        " FROM (SELECT count(*) AS n FROM lineitem), (VALUES ('order'), ('hot'), ('day'), ('price')) t(scan)"
    )
    found["source_json_inferred"] = found["source_documents"] = scan("reviews")
    found["sink_rejects"] = reject_envelope()
    found["sink_gold"] = found["sink_published"] = table("sales_by_product")
    found["sink_validation"] = validation()
    found["sink_sql_results"] = sql_results()
    found["schema_drift_events"] = schema_drift()
    found |= normalisers()
    found |= {f"clean_{e}": clean(e) for e in ALL}
    found["silver_counts"] = silver_counts()
    found |= {f"reject_{e}": reject(e) for e in ALL}
    found["reject_summary"] = reject_summary()
    found["reject_envelope"] = reject_envelope()
    found["join_orders_customers"] = join_orders_customers()
    found["join_items_products"] = join_items_products()
    found |= {f"unique_{e}": unique(e) for e in ("customers", "orders", "delivery_events")}
    found["duplicate_counts"] = duplicate_counts()
    found["join_orphans"] = join_orphans()
    found |= {name: table(name) for name in TABLE_CTES}
    found["customer_order_360_routed"] = found["customer_order_360"]
    found["latest_event_window"] = latest_event()
    found["gold_counts"] = gold_counts()
    found["layer_counts"] = layer_counts()
    found["null_profile"] = null_profile()
    found["quality_silver"] = quality_silver()
    found["quality_currency_domain"] = quality_currency()
    found["validation_results"] = validation()
    found["quality_score"] = quality_score()
    found |= reports()
    for name in ("monthly_revenue", "top_customers"):
        found[f"report_file_{name}"] = found[f"report_{name}"]
    return found
