"""Helpers that the operators of this package share."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from broadsheet.plans.order_articles import table
from broadsheet.session import configure

#: Rows of one Arrow batch; texts of a batch are in a Python worker's memory.
BATCH_ROWS = 1000
#: Text that ``ascii_lower`` and the word patterns of several operators share.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SPACE = "[\\x20\\x09-\\x0D]+"


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings of these operators: small Arrow batches bound worker memory."""
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return table(prepare(spark), sf_dir, name)


def worker_cache(name: str, make: Callable[[], object]) -> object:
    """One object per Python worker, made at first use and kept between tasks."""
    holder = sys.modules.setdefault("_broadsheet_worker", types.ModuleType("_broadsheet_worker"))
    if not hasattr(holder, name):
        setattr(holder, name, make())
    return getattr(holder, name)


def map_text(
    df: DataFrame,
    text: str,
    start: Callable[[], Callable[[list[str | None]], Sequence[Sequence]]],
    fields: list[tuple[str, T.DataType]],
) -> DataFrame:
    """``df`` with columns computed from the texts, one list of values per field.

    ``start`` runs once per task and gives the function for a batch.  Columns of
    ``df`` with the name of a new one are replaced.
    """
    names = [n for n, _ in fields]
    kept = df.drop(*[n for n in names if n != text])
    schema = T.StructType([f for f in kept.schema.fields if f.name not in names])
    for name, kind in fields:
        schema = schema.add(name, kind)
    at = kept.columns.index(text)
    carried = [i for i, c in enumerate(kept.columns) if c not in names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type

        f = start()
        kinds = [to_arrow_type(kind) for _, kind in fields]
        for batch in batches:
            made = f(batch.column(at).to_pylist())
            arrays = [v if isinstance(v, pa.Array) else pa.array(v, k) for v, k in zip(made, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in carried), *arrays], [*(batch.schema.names[i] for i in carried), *names]
            )

    return kept.mapInArrow(run, schema)


def ascii_lower(text: Column) -> Column:
    """``text`` with A to Z in lower case and all else as it is."""
    return F.translate(text, UPPER, LOWER)


def words(text: Column, between: str) -> Column:
    """The non-empty parts of ``text`` between matches of a pattern; none for null."""
    parts = F.filter(F.split(text, between), lambda w: w != "")
    return F.coalesce(parts, F.array().cast("array<string>"))


def held_out(doc_id: Column, modulus: int, remainder: int) -> Column:
    """Whether a document's id falls into the held-out share (null: not)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % modulus == remainder, F.lit(False))


def hash_limit(wanted: int, rows: int) -> int:
    """A bound on ``xxhash64`` values under which about twice ``wanted`` of ``rows`` distinct ones lie.

    Taking the ``wanted`` least hashes below it keeps what tasks and the driver
    sort near that number, however many partitions there are.
    """
    share = min(1.0, (2 * wanted + 50) / max(1, rows))
    return min((1 << 63) - 1, int(share * (1 << 64)) - (1 << 63))
