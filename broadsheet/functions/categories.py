"""Category labels."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from broadsheet.functions.text import strip

# ---- fixed values: lower-cased raw category -> label ----
CATEGORY_MAP = {
    "ai/ml": "AI_ML",
    "ai & ml": "AI_ML",
    "ai&ml": "AI_ML",
    "artificial intelligence": "AI_ML",
    "machine learning": "AI_ML",
    "analytics": "Data_Analytics",
    "data analytics": "Data_Analytics",
    "big data": "Data_Analytics",
    "cloud": "Cloud_Computing",
    "cloud computing": "Cloud_Computing",
    "cloud services": "Cloud_Computing",
    "cybersecurity": "Cybersecurity",
    "security": "Cybersecurity",
    "infosec": "Cybersecurity",
    "fintech": "FinTech",
    "finance": "FinTech",
    "financial technology": "FinTech",
    "saas": "SaaS_Software",
    "enterprise software": "SaaS_Software",
    "software": "SaaS_Software",
}
# ---- end of fixed values ----


def standard_category(raw: Column) -> Column:
    """Label for a raw category; ``Unknown`` when there is none."""
    table = F.create_map(*[F.lit(v) for v in chain.from_iterable(CATEGORY_MAP.items())])
    return F.coalesce(F.try_element_at(table, F.lower(strip(raw))), F.lit("Unknown"))
