"""CSV records with quoted line breaks, read by many tasks.

The text reader cuts files into byte ranges at line ends, so a record with a
quoted line break may span ranges.  Whether a line starts a record depends only
on the parity of the quotes before it in its file.  Each task notes, per line,
the last line of its range that would start a record if the range began outside
quotes, and the same if it began inside; a table with one row per range then
combines the parities of earlier ranges of the file and picks the right one.
Lines are grouped by the line that starts their record, so only the lines of a
record meet; the ranges parse in parallel.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_LINES = "file string, block long, id long, head boolean, quotes long, ls0 long, ls1 long, value string"


def _mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per line: the last record start of its range so far, were the range to begin outside (0) or inside (1) quotes."""
    block, inside, last = None, [0, 1], [None, None]
    for batch in batches:
        files, blocks, ids, values = (batch.column(i) for i in range(4))
        quotes = pc.subtract(pc.utf8_length(values), pc.utf8_length(pc.replace_substring(values, '"', ""))).to_numpy(zero_copy_only=False)
        b = blocks.to_numpy(zero_copy_only=False)
        i = ids.to_numpy(zero_copy_only=False)
        head, ls0, ls1 = np.zeros(len(b), bool), np.zeros(len(b), np.int64), np.zeros(len(b), np.int64)
        known0, known1 = np.zeros(len(b), bool), np.zeros(len(b), bool)
        for r in range(len(b)):
            if b[r] != block:
                # A new range: its first line may be the file's first (the header).
                head[r] = b[r] == 0
                block, inside, last = b[r], [0, 1], [None, None]
            for s in (0, 1):
                if inside[s] == 0:
                    last[s] = i[r]
                inside[s] = (inside[s] + int(quotes[r])) % 2
            ls0[r], known0[r] = (last[0], True) if last[0] is not None else (0, False)
            ls1[r], known1[r] = (last[1], True) if last[1] is not None else (0, False)
        yield pa.RecordBatch.from_arrays(
            [files, blocks, ids, pa.array(head), pa.array(quotes.astype(np.int64)), pa.array(ls0, mask=~known0), pa.array(ls1, mask=~known1), values],
            ["file", "block", "id", "head", "quotes", "ls0", "ls1", "value"],
        )


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """``(file, block, id, header, record)``: every record of the CSV files at ``path``, in order by (file, block, id).

    Empty records are left out; a carriage return before a line end is dropped.
    """
    text = spark.read.option("lineSep", "\n").text(path)
    lines = text.select(
        F.input_file_name().alias("file"), F.input_file_block_start().alias("block"), F.monotonically_increasing_id().alias("id"), "value"
    ).mapInArrow(_mark, _LINES)
    per_block = lines.groupBy("file", "block").agg(
        (F.sum("quotes") % 2).alias("parity"), F.max("ls0").alias("ls0"), F.max("ls1").alias("ls1")
    )
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    states = per_block.withColumn("state", F.coalesce(F.sum("parity").over(earlier), F.lit(0)) % 2)
    starts = states.withColumn(
        "last", F.when(F.col("state") == 0, F.struct(F.col("block").alias("b"), F.col("ls0").alias("i"))).otherwise(
            F.struct(F.col("block").alias("b"), F.col("ls1").alias("i"))
        )
    ).withColumn("last", F.when(F.col("last.i").isNotNull(), F.col("last")))
    carried = starts.select("file", "block", "state", F.last("last", ignorenulls=True).over(earlier).alias("carry"))
    own = F.when(F.col("state") == 0, F.col("ls0")).otherwise(F.col("ls1"))
    keyed = lines.join(carried, ["file", "block"]).select(
        "file", "block", "id", "head", "value",
        F.when(own.isNotNull(), F.struct(F.col("block").alias("b"), own.alias("i"))).otherwise(F.col("carry")).alias("key"),
    )
    grouped = keyed.groupBy("file", "key").agg(
        F.sort_array(F.collect_list(F.struct("block", "id", "value"))).alias("parts"), F.max("head").alias("head")
    )
    record = F.regexp_replace(F.array_join(F.transform("parts", lambda p: p["value"]), "\n"), "\r$", "")
    out = grouped.select("file", F.col("key.b").alias("block"), F.col("key.i").alias("id"), F.col("head").alias("header"), record.alias("record"))
    return out.where(F.col("header") | (F.col("record") != ""))
