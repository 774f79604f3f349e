"""Write result tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from broadsheet.schema import ENRICHED_TYPES, OUTPUT_COLUMNS

# Spark's CSV writer trims texts and marks empty ones unless told otherwise.
_CSV = {
    "header": True,
    "escape": '"',
    "emptyValue": "",
    "nullValue": "",
    "encoding": "UTF-8",
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


def output_projection(df: DataFrame) -> DataFrame:
    """The enriched columns in output order; other columns are left out and
    absent ones are null."""
    present = set(df.columns)
    return df.select(
        *[
            F.col(n) if n in present else F.lit(None).cast(ENRICHED_TYPES[n]).alias(n)
            for n in OUTPUT_COLUMNS
        ]
    )


def write_enriched(df: DataFrame, path: str, fmt: str = "csv") -> None:
    """Write the enriched table.  CSV has a header even when there are no rows."""
    _write(output_projection(df), path, fmt)


def with_json_arrays(df: DataFrame) -> DataFrame:
    """Turn array columns into JSON texts."""
    return df.select(
        *[
            F.to_json(f.name).alias(f.name) if isinstance(f.dataType, T.ArrayType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def write_export(df: DataFrame, path: str, fmt: str = "csv") -> None:
    """Write the similarity export: JSON texts in CSV, native arrays in Parquet."""
    _write(with_json_arrays(df) if fmt == "csv" else df, path, fmt)


def write_articles_csv(df: DataFrame, path: str) -> None:
    """Write any flat table in the form the article reader expects."""
    df.write.mode("overwrite").options(**_CSV).csv(path)


def _write(df: DataFrame, path: str, fmt: str) -> None:
    if fmt == "csv":
        write_articles_csv(df, path)
    elif fmt == "parquet":
        df.write.mode("overwrite").parquet(path)
    else:
        raise ValueError(f"unknown format {fmt!r}")
