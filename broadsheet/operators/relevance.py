"""Row filters."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class RelevanceSets:
    """Labels and industries that make an article relevant.  Either may be empty."""

    categories: frozenset[str] = field(default_factory=frozenset)
    industries: frozenset[str] = field(default_factory=frozenset)

    @classmethod
    def from_mapping(cls, config: Mapping) -> RelevanceSets:
        """From a configuration mapping with one list of strings per set."""
        if not isinstance(config, Mapping):
            raise ValueError("relevance configuration must be a mapping")
        found = {}
        for key in ("ai_relevant_categories", "ai_relevant_industries"):
            if key not in config:
                raise ValueError(f"relevance configuration lacks {key!r}")
            values = config[key]
            if not isinstance(values, list):
                raise ValueError(f"{key!r} must be a list")
            if not all(isinstance(v, str) for v in values):
                raise ValueError(f"{key!r} must hold strings only")
            found[key] = frozenset(values)
        return cls(found["ai_relevant_categories"], found["ai_relevant_industries"])


# The default sets.
DEFAULT_SETS = RelevanceSets(
    frozenset(["AI_ML", "Data_Analytics"]),
    frozenset(["AI/ML", "Data Analytics"]),
)


def relevant(sets: RelevanceSets = DEFAULT_SETS) -> Column:
    """Exact, case-sensitive test; never null."""
    tests = []
    if sets.categories:
        tests.append(F.col("category").isin(*sorted(sets.categories)))
    if sets.industries:
        tests.append(F.col("meta_industry").isin(*sorted(sets.industries)))
    if not tests:
        return F.lit(False)
    return F.coalesce(tests[0] if len(tests) == 1 else tests[0] | tests[1], F.lit(False))


def keep_relevant(df: DataFrame, sets: RelevanceSets = DEFAULT_SETS) -> DataFrame:
    """Articles whose category or whose company's industry is listed."""
    return df.where(relevant(sets))


def export_condition(first_year: int = 2022, last_year: int = 2024, min_revenue: int = 50_000_000) -> Column:
    """AI articles of the given years and size."""
    return (
        ((F.col("category") == "AI_ML") | (F.col("meta_industry") == "AI/ML"))
        & F.col("pub_year").between(first_year, last_year)
        & (F.col("revenue_usd") >= min_revenue)
    )


def keep_matching(df: DataFrame, condition: str) -> DataFrame:
    """Rows that satisfy a SQL condition given as text.

    Only an expression parses here; a second statement is refused.
    """
    return df.where(F.expr(condition))
