"""Best-fit decreasing packing of token sequences, with whole-corpus plans.

Documents longer than a sequence are cut into full pieces and a rest.  Pieces of
one length are interchangeable, and so are open sequences with one remaining
capacity.  Best-fit decreasing over all pieces of the corpus therefore needs
only their number by length: for each length, longest first, a segment tree over
the remaining capacities finds the tightest capacity with open sequences that
takes it, and as many pieces as there are such sequences are placed at once.
The resulting plan is a short table of ranges (length, ranks -> sequences,
offset) whose size depends on the capacity and not on the corpus; it is exactly
the packing that best-fit decreasing gives piece by piece.

A piece's rank among those of its length is its rank in its part of the input
plus the number in earlier parts.  Parts are stored once, so ranks are stable.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from broadsheet.llm.tokens import tokenizer_path, word_tokens
from broadsheet.session import materialise

CAPACITY = 2048
END_ID = 0


class CapacityTree:
    """Number of open sequences by remaining capacity; tightest fit in log time."""

    def __init__(self, capacity: int) -> None:
        self.size = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.size)

    def add(self, remaining: int, n: int) -> None:
        at = remaining + self.size
        while at:
            self.count[at] += n
            at >>= 1

    def tightest(self, least: int) -> int | None:
        """The smallest remaining capacity of at least ``least`` that is open."""
        at = least + self.size
        if self.count[at]:
            return least
        while at > 1:
            if not at & 1 and self.count[at + 1]:
                at += 1
                while at < self.size:
                    at = 2 * at if self.count[2 * at] else 2 * at + 1
                return at - self.size
            at >>= 1
        return None


def plan(pieces: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Ranges ``(length, first_rank, n, first_sequence, offset)`` of best-fit decreasing."""
    tree = CapacityTree(capacity)
    open_runs: dict[int, list[tuple[int, int]]] = {}
    out, sequences = [], 0
    for length in sorted((x for x in pieces if x > 0), reverse=True):
        rank, left = 0, pieces[length]
        while left:
            room = tree.tightest(length)
            if room is None:
                room, first, n = capacity, sequences, -(-left // (capacity // length))
                sequences += n
            else:
                first, n = open_runs[room].pop()
                tree.add(room, -n)
            # After a piece its sequence is the tightest for the next of that
            # length, so each sequence is filled before another one is taken.
            per = room // length
            full, rest = min(n, left // per), 0
            for k in range(per if full else 0):
                out.append((length, rank, full, first, capacity - room + k * length))
                rank += full
            _open(tree, open_runs, room - per * length, first, full)
            if full < n:
                rest = left - full * per
                for k in range(rest):
                    out.append((length, rank, 1, first + full, capacity - room + k * length))
                    rank += 1
                used = 1 if rest else 0
                _open(tree, open_runs, room - rest * length, first + full, used)
                _open(tree, open_runs, room, first + full + used, n - full - used)
            left -= full * per + rest
    return out


def _open(tree: CapacityTree, runs: dict, room: int, first: int, n: int) -> None:
    if room > 0 and n > 0:
        runs.setdefault(room, []).append((first, n))
        tree.add(room, n)


def pieces(docs: DataFrame, key: str, text: str, path: str, end_id: int, capacity: int, with_ids: bool = False) -> DataFrame:
    """Pieces of every row with their part of the input and rank there."""
    schema = T.StructType(
        [docs.schema[key], *(T.StructField(n, T.LongType()) for n in ("start", "length", "ids_crc32", "local_rank"))]
        + [T.StructField("piece", T.IntegerType()), T.StructField("part", T.IntegerType())]
    )
    if with_ids:
        schema = schema.add("ids", T.BinaryType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, tokens, end = TaskContext.get().partitionId(), word_tokens(path), np.array([end_id], "<u4").tobytes()
        met: dict[int, int] = {}
        for batch in batches:
            rows: list[list] = [[] for _ in range(7)]
            cut, keys = [], []
            for k, body in enumerate(batch.column(1).to_pylist()):
                ids = tokens.ids(body) + end
                for i in range(0, len(ids), 4 * capacity):
                    one = ids[i : i + 4 * capacity]
                    n = len(one) // 4
                    met[n] = met.get(n, -1) + 1
                    keys.append(k)
                    for column, v in zip(rows, (i // 4, n, zlib.crc32(one), met[n], i // (4 * capacity), part), strict=False):
                        column.append(v)
                    cut.append(one)
            arrays = [batch.column(0).take(pa.array(keys, pa.int64())), *(pa.array(c, pa.int64()) for c in rows[:4])]
            arrays += [pa.array(rows[4], pa.int32()), pa.array(rows[5], pa.int32())]
            if with_ids:
                arrays.append(pa.array(cut, pa.binary()))
            yield pa.RecordBatch.from_arrays(arrays, schema.names)

    return docs.select(F.col(f"`{key}`"), F.col(text)).mapInArrow(run, schema)


def pack(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    path: str | None = None,
    end_id: int = END_ID,
    capacity: int = CAPACITY,
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece: key, piece, start, length, ids_crc32, sequence_id, offset (and ids)."""
    stored = materialise(pieces(docs, key, text, path or tokenizer_path(), end_id, capacity, with_ids))
    by_part = stored.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = by_part.select("part", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    totals = {r["length"]: r["n"] for r in by_part.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    shared = docs.sparkSession.sparkContext.broadcast(_by_length(plan(totals, capacity)))
    ranked = stored.join(base, ["part", "length"]).withColumn("rank", F.col("base") + F.col("local_rank"))
    ranked = ranked.drop("part", "base", "local_rank")
    out = T.StructType([f for f in ranked.schema.fields if f.name != "rank"])
    out = out.add("sequence_id", T.LongType()).add("offset", T.LongType())

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup = shared.value
        for batch in batches:
            length, rank = (batch.column(batch.schema.names.index(c)).to_numpy() for c in ("length", "rank"))
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for n in np.unique(length):
                at = np.flatnonzero(length == n)
                ranks, firsts, offsets = lookup[int(n)]
                which = np.searchsorted(ranks, rank[at], side="right") - 1
                sequence[at] = firsts[which] + rank[at] - ranks[which]
                offset[at] = offsets[which]
            kept = [(c, batch.column(i)) for i, c in enumerate(batch.schema.names) if c != "rank"]
            arrays = [a for _, a in kept] + [pa.array(sequence), pa.array(offset)]
            yield pa.RecordBatch.from_arrays(arrays, out.names)

    return ranked.mapInArrow(place, out)


def _by_length(ranges: list[tuple[int, int, int, int, int]]) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    grouped: dict[int, list] = {}
    for length, rank, _, first, offset in ranges:
        grouped.setdefault(length, []).append((rank, first, offset))
    return {n: tuple(np.array(c, np.int64) for c in zip(*sorted(rows), strict=True)) for n, rows in grouped.items()}


def sequences(packed: DataFrame) -> DataFrame:
    """``(sequence_id, ids, doc_ends)`` of packed pieces with ids; at most one capacity each."""
    parts = packed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "length", "ids"))).alias("p"))
    joined = F.aggregate("p", F.lit(b"").cast("binary"), lambda acc, x: F.concat(acc, x["ids"]))
    return parts.select("sequence_id", joined.alias("ids"), F.transform("p", lambda x: x["offset"] + x["length"]).alias("doc_ends"))
