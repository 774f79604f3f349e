"""Clean stage: revenue, date, date parts and category columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from broadsheet.functions.categories import standard_category
from broadsheet.functions.dates import date_sql
from broadsheet.functions.revenue import with_revenue
from broadsheet.functions.text import squeeze_sql, strip_sql
from broadsheet.session import settled


def with_dates(df: DataFrame) -> DataFrame:
    """Replace ``published_date`` by its ISO form and add the three parts.

    A text that is no date stays as it was, so that validation can reject it.
    """
    steps = {
        "_date_raw": "CAST(published_date AS string)",
        "_date_bare": strip_sql("_date_raw"),
        "_date_text": squeeze_sql("_date_bare"),
        "_date": date_sql("_date_text"),
    }
    dated = df.selectExpr("*", *[f"{sql} AS {name}" for name, sql in steps.items()])
    parts = ("pub_year", "pub_quarter", "pub_month")
    rest = [f"`{c}`" for c in df.columns if c not in (*parts, "published_date")]
    return dated.selectExpr(
        *rest,
        "coalesce(date_format(_date, 'yyyy-MM-dd'), _date_raw, '') AS published_date",
        "year(_date) AS pub_year",
        "quarter(_date) AS pub_quarter",
        "month(_date) AS pub_month",
    )


def with_category(df: DataFrame) -> DataFrame:
    """Replace ``category`` by its standard label."""
    return df.withColumn("category", standard_category(F.col("category").cast("string")))


def clean(df: DataFrame) -> DataFrame:
    """All cleaning steps; adds the flags behind the three error counters.

    Dates and categories have a defined result for every text, so only revenue
    can fail: a number too large for the target type.
    """
    out = with_category(with_dates(settled(with_revenue(df))))
    return out.withColumnRenamed("revenue_usd_overflow", "revenue_error")
