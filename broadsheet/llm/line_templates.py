"""Line deduplication with a log-template tree.

Lines are parsed by a tree of fixed depth: token count first, then the leading
tokens.  Tokens with a digit are variable from the start and become ``<*>``.
Below the leading tokens a line of at least ``MIN_GENERAL`` tokens is cut into
``FIELDS`` runs of tokens, and each template of the line lets one run vary: two
lines share a template if they agree in count, leading tokens and all runs but
one.  So at most a quarter of a line varies besides its numbers.  Shorter lines
have their masked tokens as their only template.  A line of which less than
``MIN_CONSTANT`` of the tokens are without digit, such as a row of a number
table, has its exact tokens as its only template.  A template is a function of
its line alone, so the order of lines is no matter and a leaf is never gathered.

A template that occurs in two or more documents is recurring: its lines are
dropped from all documents but the one of the least id.  A document of which
less than ``MIN_LEFT`` of the words is left is marked as a copy.  It goes only if
no line of ``MIN_TOKENS`` tokens is left; all others keep their remaining lines,
so a line that others lost to a document never goes with that document.  Lines
of fewer than ``MIN_TOKENS`` tokens are never dropped by themselves.  Documents without id take no part and stay as they are; rows of one
id count as one document; null texts stay null.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from broadsheet.llm.common import map_text
from broadsheet.session import materialise

DEPTH = 3
FIELDS = 4
MIN_TOKENS = 3
MIN_GENERAL = 8
MIN_LEFT = 0.2
MIN_CONSTANT = 0.5
ANY = b"<*>"
DIGIT = re.compile(rb"[0-9]")


def line_tokens(line: bytes) -> list[bytes]:
    """Tokens between ASCII white space, those with a digit masked."""
    tokens = line.split()
    if DIGIT.search(line):
        tokens = [ANY if DIGIT.search(t) else t for t in tokens]
    return tokens


def line_templates(line: bytes) -> list[bytes]:
    """The templates of a line; none for very short ones."""
    tokens = line_tokens(line)
    n = len(tokens)
    if n < MIN_TOKENS:
        return []
    if n - tokens.count(ANY) < MIN_CONSTANT * n:
        return [b"%d=%b" % (n, b" ".join(line.split()))]
    if n < MIN_GENERAL:
        return [b"%d:%b" % (n, b" ".join(tokens))]
    cuts = [DEPTH + j * (n - DEPTH) // FIELDS for j in range(FIELDS + 1)]
    runs = [b" ".join(tokens[a:b]) for a, b in zip([0, *cuts], cuts, strict=False)]
    return [b"%d:%d:%b" % (n, j, b" ".join([*runs[: j + 1], ANY, *runs[j + 2 :]])) for j in range(FIELDS)]


def template_rows(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc, body, at, template)``: the hashed templates of the line at each place.

    ``body`` is the hash of the whole text, so that rows of one id stay apart.
    """
    rows = docs.select(F.col(f"`{key}`").alias("doc"), F.xxhash64(text).alias("body"), F.col(text).alias("text"))
    rows = rows.where("doc IS NOT NULL AND text IS NOT NULL")
    schema = T.StructType([*rows.schema.fields[:2], T.StructField("at", T.IntegerType()), T.StructField("template", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np
        import xxhash

        digest = xxhash.xxh64_intdigest
        for batch in batches:
            row, at, template = [], [], []
            for k, body in enumerate(batch.column(2).to_pylist()):
                for i, line in enumerate(body.encode("utf-8", "surrogatepass").split(b"\n")):
                    found = line_templates(line)
                    row += [k] * len(found)
                    at += [i] * len(found)
                    template += map(digest, found)
            taken = pa.array(row, pa.int64())
            hashes = pa.array(np.array(template, "<u8").view("<i8"), pa.int64())
            arrays = [batch.column(0).take(taken), batch.column(1).take(taken), pa.array(at, pa.int32()), hashes]
            yield pa.RecordBatch.from_arrays(arrays, schema.names)

    return rows.mapInArrow(run, schema)


def dropped_lines(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc, body, drop)``: the places of the lines to drop from a document.

    The template rows are stored once: both the first holders and the lines to
    drop come from them, and lines are parsed and hashed a single time.
    """
    rows = materialise(template_rows(docs, key, text))
    first = rows.groupBy("template").agg(F.min("doc").alias("first"), F.max("doc").alias("last"))
    first = first.where("first < last").select("template", "first")
    found = rows.join(first, "template").where("doc > first")
    return found.groupBy("doc", "body").agg(F.collect_set("at").alias("drop"))


def _without(work: dict | None) -> tuple:
    if work is None:
        return None, 0, False, False
    drop, kept, words, left, longest = set(work["drop"]), [], 0, 0, 0
    lines = work["text"].encode("utf-8", "surrogatepass").split(b"\n")
    for i, line in enumerate(lines):
        n = len(line.split())
        words += n
        if i not in drop:
            kept.append(line)
            left += n
            longest = max(longest, n)
    is_copy = left < MIN_LEFT * words
    return b"\n".join(kept).decode("utf-8", "surrogatepass"), len(lines) - len(kept), is_copy, is_copy and longest < MIN_TOKENS


def line_dedup(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``_doc`` (the input row), ``new`` (its remaining text), ``n_lines``, ``n_dropped``, ``is_copy`` and ``is_empty``.

    Of an ``is_empty`` document at most lines of fewer than ``MIN_TOKENS`` tokens are left.
    """
    drops = dropped_lines(docs, key, text)
    doc = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rows = docs.select(doc.alias("_doc"), F.col(f"`{key}`").alias("doc"), F.xxhash64(text).alias("body"))
    body = F.col(f"_doc.`{text}`")
    rows = rows.join(drops, ["doc", "body"], "left").select(
        "_doc", F.when(F.col("drop").isNotNull(), F.struct(body.alias("text"), "drop")).alias("work")
    )

    def start() -> Callable:
        return lambda works: [list(x) for x in zip(*map(_without, works), strict=True)] or [[], [], [], []]

    fields = [("new", T.StringType()), ("n_dropped", T.LongType()), ("is_copy", T.BooleanType()), ("is_empty", T.BooleanType())]
    done = map_text(rows, "work", start, fields).drop("work")
    return done.select(
        "_doc",
        F.when(F.col("n_dropped") > 0, F.col("new")).otherwise(body).alias("new"),
        F.coalesce(F.size(F.split(body, "\n")), F.lit(0)).cast("long").alias("n_lines"),
        "n_dropped",
        "is_copy",
        "is_empty",
    )


def dedup_lines(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The columns of ``docs`` with the remaining texts, without the documents of which nothing is left."""
    kept = line_dedup(docs, key, text).where(~F.col("is_empty"))
    return kept.select(*[F.col("new" if c == text else f"_doc.`{c}`").alias(c) for c in docs.columns])
