"""The six entities: raw schema, cleaned columns and validity rules of each.

An entity is data for the operators in ``clearwell.operators.silver``: a mapping
of column name to cleaning expression and an ordered list of rules.  The first
broken rule names the reject.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from clearwell.functions import normalize as N
from clearwell.functions import vocab as V

Columns = dict[str, Column]


@dataclass(frozen=True)
class Rule:
    """``broken`` is true (never needed to be non-NULL) where the row must go."""

    reason: str
    broken: Column


@dataclass(frozen=True)
class Entity:
    name: str
    raw_schema: str
    clean: Callable[[bool], Columns]
    rules: Callable[[], list[Rule]]


def _missing(column: str, reason: str) -> Rule:
    return Rule(reason, F.col(column).isNull())


def _clean_customers(exact: bool) -> Columns:
    c = F.col
    return {
        "customer_id": N.customer_id(c("customer_id"), exact),
        "first_name": N.name(c("first_name")),
        "last_name": N.name(c("last_name")),
        "email": N.email(c("email")),
        "phone": N.phone(c("phone")),
        "city": N.name(c("city")),
        "country": N.country(c("country")),
        "birth_date": N.date(c("birth_date")),
        "created_at": N.timestamp(c("created_at"), V.CREATED_AT_FORMATS),
    }


def _customer_rules() -> list[Rule]:
    return [
        _missing("customer_id", "CUSTOMER_ID_INVALID"),
        _missing("email", "EMAIL_MISSING"),
        Rule("EMAIL_INVALID", ~F.col("email").rlike(V.EMAIL_PATTERN)),
    ]


def _clean_orders(exact: bool) -> Columns:
    c = F.col
    return {
        "order_id": N.order_id(c("order_id"), exact),
        "customer_id": N.customer_id(c("customer_id"), exact),
        "order_date": N.date(c("order_date")),
        "status": N.order_status(c("status")),
        "payment_method": N.payment_method(c("payment_method")),
        "total_amount": N.absolute_money(c("total_amount")),
        "currency": N.currency(c("currency")),
    }


def _order_rules() -> list[Rule]:
    return [
        _missing("order_id", "ORDER_ID_INVALID"),
        _missing("customer_id", "CUSTOMER_ID_INVALID"),
        _missing("total_amount", "TOTAL_AMOUNT_INVALID"),
    ]


def _clean_products(exact: bool) -> Columns:
    c = F.col
    return {
        "product_id": N.product_id(c("product_id"), exact),
        "product_name": N.name(c("product_name")),
        "category": N.category(c("category")),
        "brand": N.name(c("brand")),
        "current_price": N.money(c("current_price")),
        "active": N.flag(c("active")),
    }


def _product_rules() -> list[Rule]:
    return [
        _missing("product_id", "PRODUCT_ID_INVALID"),
        _missing("product_name", "PRODUCT_NAME_MISSING"),
        _missing("current_price", "CURRENT_PRICE_INVALID"),
        Rule("CURRENT_PRICE_NOT_POSITIVE", F.col("current_price") <= 0),
    ]


def _clean_order_items(exact: bool) -> Columns:
    c = F.col
    return {
        "order_id": N.order_id(c("order_id"), exact),
        "product_id": N.product_id(c("product_id"), exact),
        "quantity": N.integer(c("quantity")),
        "unit_price": N.absolute_money(c("unit_price")),
        "discount": N.discount(c("discount")),
    }


def _order_item_rules() -> list[Rule]:
    return [
        _missing("order_id", "ORDER_ID_INVALID"),
        _missing("product_id", "PRODUCT_ID_INVALID"),
        _missing("quantity", "QUANTITY_INVALID"),
        Rule("QUANTITY_NOT_POSITIVE", F.col("quantity") <= 0),
        _missing("unit_price", "UNIT_PRICE_INVALID"),
        Rule("UNIT_PRICE_ZERO", F.col("unit_price") == 0),
        _missing("discount", "DISCOUNT_INVALID"),
        Rule("DISCOUNT_OUT_OF_RANGE", ~F.col("discount").between(0, 1)),
    ]


def _clean_reviews(exact: bool) -> Columns:
    c = F.col
    return {
        "_id": N.text(c("_id").cast("string")),
        "customerId": N.customer_id(c("customerId"), exact),
        "productId": N.product_id(c("productId"), exact),
        "orderId": N.order_id(c("orderId"), exact),
        "rating": N.integer(c("rating")),
        "comment": N.text(c("comment")),
        "reviewDate": N.review_date(c("reviewDate")),
        "verifiedPurchase": N.boolean(c("verifiedPurchase")),
    }


def _review_rules() -> list[Rule]:
    return [
        _missing("_id", "REVIEW_ID_INVALID"),
        _missing("productId", "PRODUCT_ID_INVALID"),
        _missing("rating", "RATING_INVALID"),
        Rule("RATING_OUT_OF_RANGE", ~F.col("rating").between(1, 5)),
    ]


def _clean_delivery_events(exact: bool) -> Columns:
    c = F.col
    return {
        "event_id": N.code(c("event_id")),
        "order_id": N.order_id(c("order_id"), exact),
        "event_type": N.event_type(c("event_type")),
        "event_timestamp": N.timestamp(
            c("event_timestamp"), V.EVENT_TIMESTAMP_FORMATS
        ),
        "location": F.struct(
            N.name(c("location.city")).alias("city"),
            N.country(c("location.country")).alias("country"),
        ),
        "carrier": F.struct(
            N.code(c("carrier.id")).alias("id"),
            N.name(c("carrier.name")).alias("name"),
        ),
    }


def _delivery_event_rules() -> list[Rule]:
    return [
        _missing("event_id", "EVENT_ID_INVALID"),
        _missing("order_id", "ORDER_ID_INVALID"),
        _missing("event_timestamp", "EVENT_TIMESTAMP_INVALID"),
        Rule("EVENT_TYPE_UNKNOWN", F.col("event_type") == V.UNKNOWN_EVENT_TYPE),
    ]


CUSTOMERS = Entity(
    "customers",
    "customer_id string, first_name string, last_name string, email string,"
    " phone string, city string, country string, birth_date string,"
    " created_at string",
    _clean_customers,
    _customer_rules,
)
ORDERS = Entity(
    "orders",
    "order_id string, customer_id string, order_date string, status string,"
    " payment_method string, total_amount string, currency string",
    _clean_orders,
    _order_rules,
)
PRODUCTS = Entity(
    "products",
    "product_id string, product_name string, category string, brand string,"
    " current_price string, active string",
    _clean_products,
    _product_rules,
)
ORDER_ITEMS = Entity(
    "order_items",
    "order_id string, product_id string, quantity string, unit_price string,"
    " discount string",
    _clean_order_items,
    _order_item_rules,
)
REVIEWS = Entity(
    "reviews",
    "_id string, customerId string, productId string, orderId string,"
    " rating string, comment string, reviewDate string, verifiedPurchase string",
    _clean_reviews,
    _review_rules,
)
DELIVERY_EVENTS = Entity(
    "delivery_events",
    "event_id string, order_id string, event_type string, event_timestamp string,"
    " location struct<city: string, country: string>,"
    " carrier struct<id: string, name: string>",
    _clean_delivery_events,
    _delivery_event_rules,
)

ENTITIES: dict[str, Entity] = {
    e.name: e
    for e in (CUSTOMERS, ORDERS, PRODUCTS, ORDER_ITEMS, REVIEWS, DELIVERY_EVENTS)
}
