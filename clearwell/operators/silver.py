"""Bronze to Silver: clean, tag with a reject reason, split.

One tagged plan per entity feeds both outcomes.  ``valid`` is exactly "no
reason", so no row can fall out of both sides, whatever a rule does with NULL.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clearwell.plans.entities import ENTITIES, Entity, Rule

REASON = "rejection_reason"
RAW = "_raw"
#: The text of a record that its reader could not take apart, NULL for all others.
MALFORMED = "_malformed"
MALFORMED_RECORD = "MALFORMED"


@dataclass(frozen=True)
class Silver:
    """Lazy plans per entity name."""

    tagged: Mapping[str, DataFrame]
    valid: dict[str, DataFrame] = field(default_factory=dict)
    rejected: dict[str, DataFrame] = field(default_factory=dict)


def require(tables: Mapping[str, object], names: Iterable[str]) -> None:
    missing = sorted(set(names) - set(tables))
    if missing:
        raise KeyError(f"missing tables: {', '.join(missing)}")


def clean(df: DataFrame, entity: Entity, exact_width: bool = False) -> DataFrame:
    """Replace the entity's columns by their cleaned values; keep any others."""
    return df.withColumns(entity.clean(exact_width))


def first_broken(rules: Iterable[Rule]) -> Column:
    """The reason of the first broken rule, NULL when all hold."""
    broken, *others = list(rules)
    return reduce(
        lambda reason, rule: reason.when(rule.broken, F.lit(rule.reason)),
        others,
        F.when(broken.broken, F.lit(broken.reason)),
    )


def tag(
    df: DataFrame,
    entity: Entity,
    exact_width: bool = False,
    keep_raw: bool = False,
) -> DataFrame:
    """Cleaned rows plus ``rejection_reason``; ``_raw`` holds the row as read.

    Where the reader kept the text of malformed records, these are rejects whatever
    else their columns say.
    """
    if keep_raw:
        df = df.withColumn(RAW, F.struct(*[c for c in df.columns if c != MALFORMED]))
    rules = list(entity.rules())
    if MALFORMED in df.columns:
        rules.insert(0, Rule(MALFORMED_RECORD, F.col(MALFORMED).isNotNull()))
    # One row in, one row out: the generator only keeps Catalyst from pushing
    # "reason IS NULL" below the cleaning, where the filter would hold a copy of
    # every cleaning expression per rule.  That ran ten times slower.
    reason = F.explode(F.array(first_broken(rules)))
    return clean(df, entity, exact_width).select("*", reason.alias(REASON))


def valid(tagged: DataFrame) -> DataFrame:
    return tagged.where(F.col(REASON).isNull()).drop(REASON, RAW, MALFORMED)


def rejected(tagged: DataFrame) -> DataFrame:
    return tagged.where(F.col(REASON).isNotNull())


def split(
    df: DataFrame, entity: Entity, exact_width: bool = False
) -> tuple[DataFrame, DataFrame]:
    tagged = tag(df, entity, exact_width, keep_raw=True)
    return valid(tagged), rejected(tagged)


def build_silver(
    bronze: Mapping[str, DataFrame],
    exact_width: bool = False,
    keep_raw: bool = True,
) -> Silver:
    require(bronze, ENTITIES)
    tagged = {
        name: tag(bronze[name], entity, exact_width, keep_raw)
        for name, entity in ENTITIES.items()
    }
    return Silver(
        tagged,
        {name: valid(df) for name, df in tagged.items()},
        {name: rejected(df) for name, df in tagged.items()},
    )


def silver_tables(
    bronze: Mapping[str, DataFrame], exact_width: bool = False
) -> dict[str, DataFrame]:
    """The valid rows of every entity, as the Gold builders take them."""
    return build_silver(bronze, exact_width, keep_raw=False).valid
