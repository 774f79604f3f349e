"""Importance resampling towards a target distribution of hashed word n-grams.

Texts are cut into words with Arrow kernels inside tasks: ``ascii_lower``,
``split_pattern_regex``, ``list_flatten`` and ``dictionary_encode``.  Runs of
``n`` words are formed from the dictionary indices shifted against each other
(within a document only); each distinct run of a batch is hashed once (CRC-32 of
its UTF-8 bytes) into one of ``buckets``.  Bucket counts of the raw corpus and
of the target texts are summed by Spark; the gain of a bucket is the floored log
ratio of their smoothed shares.  A document's weight is the sum of the gains of
its features, taken from the gain array and reduced per document segment.  A
Gumbel key from a hash of the id makes the top ``share`` of scores a sample
without replacement in proportion to ``exp(weight / 1000)``.

The draw is a distributed sort with a unique tie-breaker; ranks come from
per-partition counts, so no task holds more than its range of the sort.

Null and empty texts have no features (weight 0).  A null id gets no score and
no rank.  Repeated rows are drawn as separate rows (ties go to the stored row
order).  Extra columns are kept; columns named like a result are replaced.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from broadsheet.session import materialise

BETWEEN = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
BUCKETS = 10_000
NGRAMS = (1,)
MIN_WORDS = 20
SHARE = 10  # per cent of eligible documents drawn
SEED = "2024"
#: Position bits of ``monotonically_increasing_id`` under the partition number.
_POSITION = 33


def tokens(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Words of all texts in a row, and the document of each (null: no words)."""
    parts = pc.split_pattern_regex(pc.ascii_lower(texts.cast(pa.large_string())), BETWEEN)
    flat = pc.list_flatten(parts)
    parents = pc.list_parent_indices(parts).to_numpy()
    keep = pc.greater(pc.utf8_length(flat), 0)
    return pc.filter(flat, keep), parents[keep.to_numpy(zero_copy_only=False)]


def feature_buckets(
    found: pa.Array, parents: np.ndarray, ngrams=NGRAMS, buckets: int = BUCKETS
) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per n, the bucket of every run of n words of ``tokens``' result and the document it belongs to."""
    if not len(found):
        return [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in ngrams]
    coded = pc.dictionary_encode(found)
    index = coded.indices.to_numpy().astype(np.int64)
    vocabulary = coded.dictionary.to_pylist()
    size = len(vocabulary)
    out = []
    for n in ngrams:
        if len(index) < n:
            out.append((np.zeros(0, np.int64), np.zeros(0, np.int64)))
            continue
        starts = np.flatnonzero(parents[n - 1 :] == parents[: len(parents) - n + 1])
        if n == 1:
            crc = np.fromiter((zlib.crc32(w.encode("utf-8")) for w in vocabulary), np.int64, size)
            out.append(((crc % buckets)[index[starts]], parents[starts]))
            continue
        if size ** n < 1 << 62:
            # Shifted indices as one number per run: distinct runs by a plain sort.
            key = np.zeros(len(starts), np.int64)
            for j in range(n):
                key = key * size + index[starts + j]
            runs, which = np.unique(key, return_inverse=True)
            parts = [(runs // size ** (n - 1 - j)) % size for j in range(n)]
            runs = np.stack(parts, axis=1)
        else:
            runs, which = np.unique(np.stack([index[starts + j] for j in range(n)], axis=1), axis=0, return_inverse=True)
        crc = np.fromiter(
            (zlib.crc32(" ".join(vocabulary[i] for i in run).encode("utf-8")) for run in runs), np.int64, len(runs)
        )
        out.append(((crc % buckets)[which.ravel()], parents[starts]))
    return out


def bucket_counts(df: DataFrame, text: str = "text", ngrams=NGRAMS, buckets: int = BUCKETS) -> DataFrame:
    """``(bucket, n)``: features of all texts of ``df`` in each bucket, only buckets with some."""
    at = df.select(F.col(f"`{text}`").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for b, _ in feature_buckets(*tokens(batch.column(0)), ngrams, buckets):
                total += np.bincount(b, minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(total[used])], ["bucket", "n"])

    counted = at.mapInArrow(run, "bucket int, n long")
    return counted.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(raw: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """``(bucket, gain)`` of every bucket: floor(1000 ln((t+1)(S+B) / ((s+1)(T+B))))."""
    spark = raw.sparkSession
    every = spark.range(buckets).select(F.col("id").cast("int").alias("bucket"))
    s = raw.withColumnRenamed("n", "s")
    t = target.withColumnRenamed("n", "t")
    # Stored once: the corpus counts behind it are not computed again for the gains.
    both = materialise(every.join(s, "bucket", "left").join(t, "bucket", "left").fillna(0, ["s", "t"]))
    totals = both.agg(F.sum("s").alias("S"), F.sum("t").alias("T")).first()
    b = float(buckets)
    ratio = ((F.col("t") + 1) * F.lit(totals["S"] + b)) / ((F.col("s") + 1) * F.lit(totals["T"] + b))
    return both.select("bucket", F.floor(1000 * F.log(ratio.cast("double"))).cast("long").alias("gain"))


def weigh(df: DataFrame, gain: np.ndarray, text: str = "text", ngrams=NGRAMS) -> DataFrame:
    """``df`` with ``n_words``, ``n_features`` and ``weight`` (sum of gains) of each text."""
    names = ["n_words", "n_features", "weight"]
    kept = df.drop(*[n for n in names if n != text])
    at = kept.columns.index(text)
    schema = T.StructType(list(kept.schema.fields))
    for n in names:
        schema = schema.add(n, T.LongType())
    shared = df.sparkSession.sparkContext.broadcast(gain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g = shared.value
        for batch in batches:
            rows = batch.num_rows
            texts = batch.column(at).cast(pa.string())
            found, parents = tokens(texts)
            n_words = np.bincount(parents, minlength=rows)
            n_features = np.zeros(rows, np.int64)
            weight = np.zeros(rows, np.int64)
            for bucket, of in feature_buckets(found, parents, ngrams, len(g)):
                # Runs of a document are contiguous: a segment sum of cumulative gains.
                count = np.bincount(of, minlength=rows)
                ends = np.concatenate([[0], np.cumsum(count)])
                total = np.concatenate([[0], np.cumsum(g[bucket])])
                n_features += count
                weight += total[ends[1:]] - total[ends[:-1]]
            columns = [*batch.columns, pa.array(n_words, pa.int64()), pa.array(n_features), pa.array(weight)]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, *names])

    return kept.mapInArrow(run, schema)


def gumbel_key(key) -> F.Column:
    """floor(-1000 ln(-ln((h + 0.5) / 2^32))), h the first 32 bits of sha256('<seed>:<key>')."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{SEED}:"), key.cast("string")), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / float(1 << 32))))


def ranks(scored: DataFrame, eligible: F.Column, wanted: int, key: str = "doc_id") -> DataFrame:
    """``scored`` with ``rank`` 1 to ``wanted`` for the highest eligible scores (ties to the smaller key)."""
    stored = materialise(scored.withColumn("_row", F.monotonically_increasing_id()).withColumn("_in", eligible))
    order = [F.col("score").desc(), F.col(f"`{key}`").asc(), F.col("_row").asc()]
    placed = materialise(
        stored.where("_in").select("_row", "score", F.col(f"`{key}`")).orderBy(*order)
        .select("_row", F.monotonically_increasing_id().alias("_pos"))
    )
    placed = placed.withColumn("_part", F.shiftright("_pos", _POSITION))
    # One row per partition of the sort: their offsets are a running sum over a small table.
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    offsets = sizes.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before"))
    rank = F.col("_before") + F.col("_pos").bitwiseAND(F.lit((1 << _POSITION) - 1)) + 1
    ranked = placed.join(F.broadcast(offsets), "_part").select("_row", rank.alias("rank")).where(F.col("rank") <= wanted)
    return stored.drop("rank").join(ranked, "_row", "left").drop("_row", "_in")


def resample(
    docs: DataFrame,
    target: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    share: int = SHARE,
    min_words: int = MIN_WORDS,
    buckets: int = BUCKETS,
) -> DataFrame:
    """``docs`` with ``n_words``, ``n_features``, ``weight``, ``score`` and ``rank`` (null: not drawn).

    Of the documents with at least ``min_words`` words and an id, floor(share * N / 100)
    are drawn.
    """
    table = gains(bucket_counts(docs, text, buckets=buckets), bucket_counts(target, "text", buckets=buckets), buckets)
    # One value per bucket: the array is as large as the parameter, whatever the corpus.
    gain = np.zeros(buckets, np.int64)
    for r in table.collect():
        gain[r["bucket"]] = r["gain"]
    weighed = materialise(weigh(docs.drop("score", "rank"), gain, text))
    scored = weighed.withColumn("score", (F.col("weight") + gumbel_key(F.col(f"`{key}`"))).cast("long"))
    eligible = (F.col("n_words") >= min_words) & F.col("score").isNotNull()
    n = weighed.where((F.col("n_words") >= min_words) & F.col(f"`{key}`").isNotNull()).count()
    return ranks(scored, eligible, math.floor(share * n / 100), key)
