"""Value normalisers: each takes a Column of untrusted text and returns a Column.

All of them are built-in expressions, so a whole entity is cleaned in one
code-generated projection.  None of them can fail on a bad value: what cannot
be read becomes NULL, and the entity rules turn that into a named reject.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from clearwell.functions import vocab as V


def padded_id(
    raw: Column, prefix: str, width: int, exact_width: bool = False
) -> Column:
    """Prefix plus the first digit run of ``raw``, zero-padded; NULL without digits.

    ``lpad`` cuts text longer than its target, which would merge ``12345`` and
    ``12349`` at width 4.  The default therefore pads to *at least* ``width``;
    ``exact_width=True`` gives the cutting behaviour.
    """
    digits = F.regexp_extract(raw, r"(\d+)", 1)
    target = F.lit(width)
    if not exact_width:
        target = F.greatest(target, F.length(digits))
    # concat is NULL if any part is: the last, empty part is NULL without digits.
    # Written without a branch so that the digit run is extracted once per row.
    return F.concat(
        F.lit(prefix),
        F.lpad(digits, target, F.lit("0")),
        F.when(digits != "", F.lit("")),
    )


def customer_id(raw: Column, exact_width: bool = False) -> Column:
    return padded_id(raw, *V.CUSTOMER_ID, exact_width)


def order_id(raw: Column, exact_width: bool = False) -> Column:
    return padded_id(raw, *V.ORDER_ID, exact_width)


def product_id(raw: Column, exact_width: bool = False) -> Column:
    return padded_id(raw, *V.PRODUCT_ID, exact_width)


def from_vocabulary(key: Column, words: Mapping[object, Iterable[str]]) -> Column:
    """The canonical value whose spelling list holds ``key``, else NULL.

    One literal map lookup, so ``key`` is evaluated once however long the lists are.
    """
    entries = [
        F.lit(item)
        for canonical, spellings in words.items()
        for spelling in spellings
        for item in (spelling, canonical)
    ]
    return F.create_map(*entries)[key]


def folded(raw: Column) -> Column:
    return F.lower(F.trim(raw))


def boolean(raw: Column) -> Column:
    return from_vocabulary(folded(raw.cast("string")), V.BOOLEAN_WORDS)


def country(raw: Column) -> Column:
    shouted = F.upper(F.trim(raw))
    return F.coalesce(
        from_vocabulary(folded(raw), V.COUNTRY_WORDS), F.nullif(shouted, F.lit(""))
    )


def order_status(raw: Column) -> Column:
    return F.coalesce(
        from_vocabulary(folded(raw), V.ORDER_STATUS_WORDS), F.upper(F.trim(raw))
    )


def payment_method(raw: Column) -> Column:
    return F.coalesce(
        from_vocabulary(folded(raw), V.PAYMENT_WORDS), F.upper(F.trim(raw))
    )


def currency(raw: Column) -> Column:
    return F.coalesce(
        F.nullif(F.upper(F.trim(raw)), F.lit("")), F.lit(V.DEFAULT_CURRENCY)
    )


def category(raw: Column) -> Column:
    spaced = F.lower(F.regexp_replace(F.trim(raw), r"[-_]+", " "))
    return F.coalesce(from_vocabulary(spaced, V.CATEGORY_WORDS), F.initcap(spaced))


def event_type(raw: Column) -> Column:
    code = F.upper(F.trim(raw))
    return F.when(code.isin(V.DELIVERY_EVENT_TYPES), code).otherwise(
        V.UNKNOWN_EVENT_TYPE
    )


def phone(raw: Column) -> Column:
    """A French mobile number as ``+33[67]`` and eight digits, else NULL."""
    dialled = F.regexp_replace(F.trim(raw), r"[^0-9+]", "")
    international = F.regexp_replace(dialled, r"^0033", "+33")
    full = F.when(
        international.rlike(V.NATIONAL_MOBILE_PATTERN),
        F.concat(F.lit("+33"), F.substring(international, 2, 9)),
    ).otherwise(international)
    return F.when(full.rlike(V.MOBILE_PATTERN), full)


def _layout(pattern: str) -> str:
    """The ``LIKE`` pattern of texts with each non-digit that a date pattern demands at its place."""
    plain = pattern.replace("'", "")
    quoted = {c for part in pattern.split("'")[1::2] for c in part}
    return "".join(c if c in quoted or not c.isalpha() else "_" for c in plain).rstrip("_") + "%"


def _parse_first(
    raw: Column, formats: Sequence[str], parse: Callable[[str], Column]
) -> Column:
    """``coalesce(parse(f1), parse(f2), ...)``, trying only the format that fits.

    A failed parse costs several times a successful one, so the separators pick
    the format.  They decide it alone except after a leading sign, which shifts
    every position; that rare text tries all formats in order.  Each format is parsed in
    one place and its separators are one comparison: the JVM compiles no method of more
    than 8,000 bytes, and a row's cleaning is one method.
    """
    signed = F.substring(raw, 1, 1).isin("+", "-")
    return F.coalesce(
        *[F.when(signed | F.upper(raw).like(_layout(f)), parse(f)) for f in formats]
    )


def date(raw: Column, formats: Sequence[str] = tuple(V.DATE_FORMATS)) -> Column:
    """First format that parses; no trimming, so padded text is not a date."""
    return _parse_first(raw, formats, lambda f: F.try_to_date(raw, f))


def timestamp(raw: Column, formats: Sequence[str]) -> Column:
    return _parse_first(raw, formats, lambda f: F.try_to_timestamp(raw, F.lit(f)))


def review_date(raw: Column) -> Column:
    moment = timestamp(raw, [V.REVIEW_TIMESTAMP_FORMAT])
    return F.coalesce(date(raw), moment.cast("date"))


def integer(raw: Column) -> Column:
    return raw.try_cast("int")


def money(raw: Column) -> Column:
    return raw.try_cast(V.MONEY)


def absolute_money(raw: Column) -> Column:
    return F.abs(money(raw))


def discount(raw: Column) -> Column:
    """A ratio: below 0 is 0, percentages (1, 100] are divided by 100."""
    ratio = raw.try_cast(V.RATIO)
    return (
        F.when(ratio < 0, F.lit(0))
        .when((ratio > 1) & (ratio <= 100), ratio / 100)
        .otherwise(ratio)
        .cast(V.RATIO)
    )


def name(raw: Column) -> Column:
    return F.initcap(F.trim(raw))


def code(raw: Column) -> Column:
    return F.upper(F.trim(raw))


def text(raw: Column) -> Column:
    return F.trim(raw)


def email(raw: Column) -> Column:
    return folded(raw)


def flag(raw: Column) -> Column:
    """A boolean word, with anything unreadable counted as false."""
    return F.coalesce(boolean(raw), F.lit(False))
