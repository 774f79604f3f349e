"""Read article tables."""

from __future__ import annotations

import csv
import io

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from broadsheet.schema import ENRICHED_TYPES, SURPLUS_FLAG
from broadsheet.sources.csv_records import csv_records

_BAD = "_bad_record"


def _header(spark: SparkSession, path: str, multi_line: bool) -> list[str]:
    first = spark.read.csv(path, header=False, multiLine=multi_line, escape='"', encoding="UTF-8").first()
    if first is None:
        raise ValueError(f"no header line in {path}")
    return ["" if cell is None else cell.lstrip("﻿") for cell in first]


def read_articles_csv(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """All-text article table with columns bound by header name.

    An empty cell is ``""`` and a cell that a short line lacks is null.  A line
    with more cells than the header is flagged, so that validation refuses it.
    The last of several columns of one name counts.  Every file must carry the
    same header.

    Quoted line breaks make a file unsplittable: keep files at a size one task
    can read, or pass ``multi_line=False`` when texts hold no line breaks.
    """
    header = _header(spark, path, multi_line)
    named = {name: i for i, name in enumerate(header) if name}
    cells = [f"c{i}" for i in range(len(header))]
    fields = [n if n and named[n] == i else f"_unused_{i}" for i, n in enumerate(header)]
    unique = fields == header
    schema = T.StructType([T.StructField(f, T.StringType()) for f in [*fields, _BAD]])
    rows = spark.read.csv(
        path,
        schema=schema,
        header=True,
        multiLine=multi_line,
        escape='"',
        encoding="UTF-8",
        columnNameOfCorruptRecord=_BAD,
        # Refuse files whose header differs; impossible when names were changed.
        enforceSchema=not unique,
    ).toDF(*cells, _BAD)
    odd = F.col(_BAD).isNotNull()
    surplus = odd & F.col(cells[-1]).isNotNull()
    short = odd & ~surplus
    return rows.select(
        *[F.when(short, F.col(f"c{i}")).otherwise(F.coalesce(f"c{i}", F.lit(""))).alias(n) for n, i in named.items()],
        surplus.alias(SURPLUS_FLAG),
    )


def read_articles_csv_split(spark: SparkSession, path: str) -> DataFrame:
    """As ``read_articles_csv``, but files with quoted line breaks are read by many tasks.

    Records come from ``csv_records`` and each is parsed by itself, with the
    cells bound by the header of the first file; the first record of every
    file is taken as its header and not compared.
    """
    records = csv_records(spark, path)
    first = records.where("header").orderBy("file").select("record").first()
    if first is None:
        raise ValueError(f"no header line in {path}")
    options = {"escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BAD}
    # One record, on the driver: the header.
    header = [cell.lstrip("\ufeff") for cell in next(csv.reader(io.StringIO(first[0])), [])]
    named = {name: i for i, name in enumerate(header) if name}
    cells = [f"c{i}" for i in range(len(header))]
    schema = ", ".join(f"{c} string" for c in cells) + f", {_BAD} string"
    rows = records.where("NOT header").select(F.from_csv("record", schema, options).alias("p")).select("p.*")
    odd = F.col(_BAD).isNotNull()
    surplus = odd & F.col(cells[-1]).isNotNull()
    short = odd & ~surplus
    return rows.select(
        *[F.when(short, F.col(f"c{i}")).otherwise(F.coalesce(f"c{i}", F.lit(""))).alias(n) for n, i in named.items()],
        surplus.alias(SURPLUS_FLAG),
    )


def _typed(name: str, kind: T.DataType):
    col = F.col(name)
    if isinstance(kind, T.StringType):
        return col.cast(kind).alias(name)
    if isinstance(kind, T.BooleanType):
        return col.cast("string").try_cast(kind).alias(name)
    # A whole number may come back as "2020.0" from other tools.
    return F.coalesce(col.cast("string").try_cast(kind), col.cast("string").try_cast("double").try_cast(kind)).alias(name)


def read_enriched(spark: SparkSession, path: str, fmt: str = "csv", multi_line: bool = True) -> DataFrame:
    """Typed enriched table from CSV or Parquet.  Empty texts become null."""
    if fmt == "parquet":
        rows = spark.read.parquet(path)
    elif fmt == "csv":
        rows = read_articles_csv(spark, path, multi_line).drop(SURPLUS_FLAG)
        rows = rows.select(*[F.nullif(F.col(c), F.lit("")).alias(c) for c in rows.columns])
    else:
        raise ValueError(f"unknown format {fmt!r}")
    absent = [n for n in ENRICHED_TYPES if n not in rows.columns]
    if absent:
        raise ValueError(f"columns are missing from the enriched table: {absent}")
    extra = [F.col(c) for c in rows.columns if c not in ENRICHED_TYPES]
    return rows.select(*[_typed(n, k) for n, k in ENRICHED_TYPES.items()], *extra)
