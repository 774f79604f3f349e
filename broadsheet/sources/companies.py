"""The company dimension."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from broadsheet.schema import COMPANY_FIELDS

# An invented dimension for the generated articles:
# key, founded_year, headquarters, employee_count, industry, is_public, stock_ticker
COMPANIES = [
    ("Lumen Harbor", 1991, "Oslo, Norway", 31250, "AI/ML", True, "LUHA"),
    ("Brightloom Foods", 2009, "Lyon, France", 880, "Retail", False, None),
    ("Quarry & Pine", 1987, "Boise, ID", 9999, "Logistics", True, "QPN"),
    ("Tidewater Analytics", 2013, "Cork, Ireland", 4120, "Data Analytics", False, None),
    ("Ostrava Motors", 1964, "Ostrava, Czechia", 58400, "Manufacturing", True, "OSTM"),
    ("Fenwick Bank", 1952, "Leeds, UK", 27010, "FinTech", True, "FENW"),
    ("Juniper Cloudworks", 2016, "Denver, CO", 10000, "Cloud Computing", False, None),
    ("Saffron Shield", 2018, "Pune, India", 640, "Cybersecurity", False, None),
    ("Deepwell Robotics", 2011, "Nagoya, Japan", 30001, "AI/ML", True, "DWRB"),
    ("Marigold Media", 1999, "Porto, Portugal", 2300, "Media", False, None),
    ("Kestrel Insight", 2007, "Ghent, Belgium", 15300, "Data Analytics", True, "KSTI"),
    ("Northgate Hosting", 2003, "Tallinn, Estonia", 7420, "Cloud Computing", False, None),
    ("Vela Payments", 2020, "Lagos, Nigeria", 410, "FinTech", False, None),
    ("Amberline Software", 1995, "Graz, Austria", 12040, "SaaS", True, "AMBL"),
    ("Cobalt Orchard", 2014, "Hobart, Australia", 30000, "AI/ML", False, None),
    ("Hazel & Finch", 1978, "Bergen, Norway", 5050, "Retail", True, "HFN"),
    ("Polder Energy", 1983, "Utrecht, Netherlands", 44800, "Energy", True, "PLDR"),
    ("Riverstone Labs", 2005, "Austin, TX", 18900, "Biotech", False, None),
    ("Zenith Parcel", 2001, "Osaka, Japan", 61200, "Logistics", True, "ZNTH"),
    ("Willow Vault", 2019, "Zurich, Switzerland", 95, "Cybersecurity", False, None),
    ("Copperfield Games", 2010, "Malmo, Sweden", 3600, "SaaS", True, "CPFG"),
]

DIMENSION_SCHEMA = T.StructType(
    [T.StructField("company_key", T.StringType()), T.StructField("pos", T.LongType())]
    + [T.StructField(name, kind) for name, kind in COMPANY_FIELDS.items()]
)

# Numbers and booleans are read as text so that "2016" and 2016 both work.
_JSON_TYPE = T.MapType(T.StringType(), T.StructType([T.StructField(n, T.StringType()) for n in COMPANY_FIELDS]))


def default_companies(spark: SparkSession) -> DataFrame:
    """The invented dimension above as a table."""
    rows = [(row[0], pos, *row[1:]) for pos, row in enumerate(COMPANIES)]
    return spark.createDataFrame(rows, DIMENSION_SCHEMA)


def parse_companies(documents: DataFrame, text: str, order: Column | None = None) -> DataFrame:
    """Company rows from JSON texts of the form ``{name: {field: value}}``.

    A name given twice keeps its first position and its last value.  ``order``
    ranks the documents when there are several; each then needs its own number
    below 2^31.
    """
    base = F.lit(0).cast("bigint") if order is None else order.cast("bigint")
    parsed = documents.select(base.alias("doc"), F.from_json(text, _JSON_TYPE, {"mode": "FAILFAST"}).alias("m"))
    entries = parsed.select("doc", F.posexplode("m").alias("i", "company_key", "fields")).select(
        "company_key", (F.shiftleft("doc", 32) + F.col("i")).alias("pos"), "fields"
    )
    typed = entries.select(
        "company_key",
        "pos",
        *[F.col(f"fields.{name}").try_cast(kind).alias(name) for name, kind in COMPANY_FIELDS.items()],
    )
    return unique_companies(typed)


def unique_companies(companies: DataFrame) -> DataFrame:
    """One row per key: the first position, the last values."""
    unique = companies.groupBy("company_key").agg(
        F.min("pos").alias("pos"), F.max_by(F.struct(*COMPANY_FIELDS), "pos").alias("fields")
    )
    return unique.select("company_key", "pos", "fields.*")


def write_companies_json(companies: DataFrame, path: str) -> None:
    """The dimension as one JSON object; a dimension too large for that is written as Parquet instead."""
    entry = F.struct("pos", "company_key", F.struct(*COMPANY_FIELDS).alias("fields"))
    entries = F.transform(F.array_sort(F.collect_list(entry)), lambda e: F.struct(e["company_key"], e["fields"]))
    whole = companies.agg(F.to_json(F.map_from_entries(entries)).alias("value"))
    whole.coalesce(1).write.text(path)


def read_companies(spark: SparkSession, path: str) -> DataFrame:
    """Read the dimension: one JSON object, or a Parquet table of its rows.

    A JSON object is a single value and is parsed by one task.  A dimension too
    large for that belongs in Parquet with the columns of ``DIMENSION_SCHEMA``.
    """
    if path.rstrip("/").endswith(".parquet"):
        return unique_companies(spark.read.schema(DIMENSION_SCHEMA).parquet(path))
    return parse_companies(spark.read.text(path, wholetext=True), "value")
