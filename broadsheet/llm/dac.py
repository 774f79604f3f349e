"""Token files with directly addressable codes.

An id is split into chunks of ``width`` bits, lowest first.  Level k of a segment
holds the k-th chunks of all ids that have one, and a bitmap that says which of
them go on at level k + 1.  A rank directory counts the bitmap's ones before
every 512th bit, so the place of an id's next chunk is a rank away and any id is
read without decoding its neighbours.  The widths of the levels follow the ids
of the segment: those of the fewest bits.

A segment holds whole documents, about ``SEGMENT`` ids (more only if one
document has more), and begins with a header, so it is readable by itself:
magic ``DAC1``, number of ids and levels, then per level width, count and byte
lengths, then the chunks, bitmaps and directories.  The files are a table of
segments in ascending order of document id, range-partitioned; a second small
table has the number of ids before each part.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from broadsheet.llm.tokens import tokenizer_path, word_tokens

MAGIC = b"DAC1"
SEGMENT = 1 << 18
END_ID = 2
RANK_STEP = 512
WIDTHS = (8, 16)


def _chunk_type(width: int) -> str:
    return "<u1" if width == 8 else "<u2"


def _level_widths(ids: np.ndarray) -> list[int]:
    """Widths of the levels (8 or 16 bits) with the fewest bits in all."""
    top = int(ids.max()) if len(ids) else 0
    options: list[list[int]] = [[]]
    done: list[list[int]] = []
    while options:
        widths = options.pop()
        covered = sum(widths)
        if widths and top >> covered == 0:
            done.append(widths)
        elif covered < 32:
            options += [[*widths, w] for w in WIDTHS]

    def cost(widths: list[int]) -> int:
        bits, below = 0, 0
        for w in widths:
            n = int((ids >= 1 << below).sum()) if below else len(ids)
            bits += n * (w + 1)
            below += w
        return bits

    return min(done, key=lambda x: (cost(x), len(x)))


def encode(ids: np.ndarray) -> bytes:
    """One segment."""
    rest, head, body = ids.astype("<u4"), [], []
    widths = _level_widths(rest)
    for w in widths:
        chunk = (rest & ((1 << w) - 1)).astype(_chunk_type(w))
        more = (rest >> w) > 0 if w < 32 else np.zeros(len(rest), bool)
        bitmap = np.packbits(more, bitorder="little")
        ones = np.concatenate([[0], np.cumsum(np.add.reduceat(more, np.arange(0, len(more), RANK_STEP)))]) if len(more) else [0]
        parts = [chunk.tobytes(), bitmap.tobytes(), np.array(ones, "<u4").tobytes()]
        head.append(struct.pack("<BIIII", w, len(rest), *map(len, parts)))
        body += parts
        rest = rest[more] >> w
    return MAGIC + struct.pack("<IB", len(ids), len(widths)) + b"".join(head) + b"".join(body)


class Segment:
    """Random access to the ids of one encoded segment."""

    def __init__(self, data: bytes) -> None:
        if data[:4] != MAGIC:
            raise ValueError("not a DAC segment")
        self.n, levels = struct.unpack_from("<IB", data, 4)
        at, self.levels = 9, []
        sizes = [struct.unpack_from("<BIIII", data, at + 17 * k) for k in range(levels)]
        at += 17 * levels
        for w, n, a, b, c in sizes:
            chunk = np.frombuffer(data, _chunk_type(w), n, at)
            bitmap = np.frombuffer(data, np.uint8, b, at + a)
            ranks = np.frombuffer(data, "<u4", c // 4, at + a + b)
            self.levels.append((w, chunk, bitmap, ranks))
            at += a + b + c

    def _rank(self, level: int, i: int) -> int:
        _, _, bitmap, ranks = self.levels[level]
        block = i // RANK_STEP
        first, whole = block * RANK_STEP // 8, i // 8
        n = int(ranks[block]) + int(np.bitwise_count(bitmap[first:whole]).sum())
        return n + (int(bitmap[whole]) & ((1 << i % 8) - 1)).bit_count() if i % 8 else n

    def __getitem__(self, i: int) -> int:
        if not 0 <= i < self.n:
            raise IndexError(i)
        value, shift = 0, 0
        for k, (w, chunk, bitmap, _) in enumerate(self.levels):
            value |= int(chunk[i]) << shift
            if not bitmap[i // 8] >> i % 8 & 1:
                break
            i, shift = self._rank(k, i), shift + w
        return value

    def range(self, start: int, end: int) -> np.ndarray:
        """Ids ``start`` to ``end`` (exclusive); reads only their chunks."""
        out = np.zeros(max(0, end - start), np.uint32)
        at, shift = np.arange(len(out)), 0
        for k, (w, chunk, bitmap, _) in enumerate(self.levels):
            if start >= end:
                break
            out[at] |= chunk[start:end].astype(np.uint32) << np.uint32(shift)
            bits = np.unpackbits(bitmap[start // 8 : (end + 7) // 8], bitorder="little")
            more = bits[start % 8 : start % 8 + end - start].astype(bool)
            at = at[more]
            start = self._rank(k, start)
            end, shift = start + len(at), shift + w
        return out


def write_tokens(
    docs: DataFrame,
    folder: str,
    key: str = "doc_id",
    text: str = "text",
    path: str | None = None,
    end_id: int = END_ID,
    segment: int = SEGMENT,
) -> None:
    """Encode all rows of ``docs`` in ascending key order into token files in ``folder``.

    Null texts are empty, rows without key come first, and rows of one key stand
    in the order of their texts.
    """
    spark = docs.sparkSession
    model = path or tokenizer_path()
    schema = T.StructType(
        [T.StructField("part", T.IntegerType()), T.StructField("segment", T.IntegerType())]
        + [T.StructField(n, T.LongType()) for n in ("first", "n_tokens")]
        + [T.StructField("keys", T.ArrayType(docs.schema[key].dataType)), T.StructField("starts", T.ArrayType(T.LongType()))]
        + [T.StructField("data", T.BinaryType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        from pyspark.sql.pandas.types import to_arrow_schema

        kinds, part = to_arrow_schema(schema), TaskContext.get().partitionId()
        tokens, end = word_tokens(model), np.array([end_id], "<u4").tobytes()
        keys, starts, buffer, n, first, number = [], [], [], 0, 0, 0

        def closed() -> pa.RecordBatch:
            data = encode(np.frombuffer(b"".join(buffer), "<u4"))
            columns = [[part], [number], [first], [n], [keys], [starts], [data]]
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, kinds, strict=True)], kinds.names)

        for batch in batches:
            for k, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = tokens.ids(body) + end
                if n and n + len(ids) // 4 > segment:
                    yield closed()
                    keys, starts, buffer, n, first, number = [], [], [], 0, first + n, number + 1
                keys.append(k)
                starts.append(n)
                buffer.append(ids)
                n += len(ids) // 4
        if n:
            yield closed()

    rows = docs.select(F.col(f"`{key}`"), F.col(text)).repartitionByRange(F.col(f"`{key}`").asc_nulls_first())
    rows = rows.sortWithinPartitions(F.col(f"`{key}`").asc_nulls_first(), F.col(text))
    rows.mapInArrow(run, schema).write.parquet(f"{folder}/segments")
    # One number for each part: bounded by the partitions, not by the rows.
    sums = spark.read.parquet(f"{folder}/segments").groupBy("part").agg(F.sum("n_tokens").alias("n")).orderBy("part").collect()
    base, before = [], 0
    for r in sums:
        base.append((r["part"], before))
        before += r["n"]
    spark.createDataFrame(base, "part int, before long").coalesce(1).write.parquet(f"{folder}/parts")


def read_segments(spark: SparkSession, folder: str) -> DataFrame:
    """The segments with ``first`` counted over all files."""
    parts = spark.read.parquet(f"{folder}/parts")
    return spark.read.parquet(f"{folder}/segments").join(F.broadcast(parts), "part").withColumn(
        "first", F.col("first") + F.col("before")
    ).drop("before")


def read_documents(spark: SparkSession, folder: str, key: str = "doc_id") -> DataFrame:
    """``(key, start, n_tokens, ids)`` of every document, ids as little-endian bytes."""
    segments = read_segments(spark, folder).select("first", "n_tokens", "keys", "starts", "data")
    kind = segments.schema["keys"].dataType.elementType
    schema = T.StructType(
        [T.StructField(key, kind), T.StructField("start", T.LongType()), T.StructField("n_tokens", T.LongType())]
        + [T.StructField("ids", T.BinaryType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        kinds = to_arrow_schema(schema)
        for batch in batches:
            for r in range(batch.num_rows):
                first, total, keys, starts, data = (batch.column(i)[r].as_py() for i in range(5))
                segment = Segment(data)
                ends = [*starts[1:], total]
                ids = [segment.range(a, b).astype("<u4").tobytes() for a, b in zip(starts, ends, strict=True)]
                columns = [keys, [first + a for a in starts], [b - a for a, b in zip(starts, ends, strict=True)], ids]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, kinds, strict=True)], kinds.names)

    return segments.mapInArrow(run, schema)


def token_at(spark: SparkSession, folder: str, places: list[int]) -> dict[int, int]:
    """The ids at places counted over all files; only their segments are read."""
    segments = read_segments(spark, folder)
    out = {}
    for place in places:
        row = segments.where((F.col("first") <= place) & (F.col("first") + F.col("n_tokens") > place)).first()
        out[place] = Segment(bytes(row["data"]))[place - row["first"]]
    return out


def checksum(ids: bytes) -> int:
    return zlib.crc32(ids)


def with_checksums(documents: DataFrame, ids: str = "ids", out: str = "ids_crc32") -> DataFrame:
    return documents.withColumn(out, F.crc32(ids))


Reader = Callable[[SparkSession, str], DataFrame]
