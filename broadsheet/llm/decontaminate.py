"""Benchmark decontamination: a hash set of normalised test n-grams, scanned in every text.

A window is 10 consecutive words of an item (all words of a shorter item).  The
windows become a hash table that travels to the tasks inside the expression;
its size is measured first and bounded by ``TABLE_BYTES``.  Every document row
is then scanned where it is read: hash each of its windows, look the hash up,
verify the words, and mark the words under verified windows.  There is no
shuffle and no join.  A larger benchmark takes another way with equal results:
the windows of each distinct text are joined with those of the items.

Null texts have no words.  Items without words have no window; items without id
mark words but count as the empty id.  Repeated items count once.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from broadsheet.llm.common import ascii_lower, words
from broadsheet.session import materialise, settled

WINDOW = 10
TABLE_BYTES = 8 << 20
BETWEEN = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
# The same in texts as they are written, capitals being letters too.
WRITTEN_BETWEEN = "[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
WRITTEN_WORD = "[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
TABLE_TYPE = "array<array<struct<h:bigint,w:string,ids:array<string>>>>"
NONE = "array<struct<i:int,l:int,ids:array<string>>>"


def _window(w: Column, i: Column, length: int) -> Column:
    return F.concat_ws(" ", *[F.get(w, i + k) for k in range(length)])


def _starts(w: Column, length: int) -> Column:
    n = F.size(w)
    return F.when(n >= length, F.sequence(F.lit(0), n - length)).otherwise(F.array().cast("array<int>"))


def _hashes(w: Column, length: int) -> Column:
    return F.transform(_starts(w, length), lambda i: F.xxhash64(_window(w, i, length)))


def item_windows(benchmark: DataFrame, item: str = "item_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """``(l, w, h, ids)``: every distinct window, its hash and its items."""
    ids = F.coalesce(F.col(item).cast("string"), F.lit("")).alias("id")
    b = benchmark.select(ids, words(ascii_lower(F.col(text)), BETWEEN).alias("ws"))
    length = F.least(F.size("ws"), F.lit(window))
    b = b.where(F.size("ws") > 0).select("id", "ws", length.alias("l"), F.explode(F.sequence(F.lit(1), F.size("ws") - length + 1)).alias("at"))
    b = b.select("id", "l", F.array_join(F.slice("ws", F.col("at"), F.col("l")), " ").alias("w"))
    return b.groupBy("l", "w").agg(F.array_sort(F.collect_set("id")).alias("ids")).withColumn("h", F.xxhash64("w"))


def _hits_by_table(w: Column, hashes: Column, length: int, rows: list) -> Column:
    size = 1 << max(1, len(rows)).bit_length()
    buckets: list[list] = [[] for _ in range(size)]
    for r in rows:
        buckets[r["h"] % size].append({"h": r["h"], "w": r["w"], "ids": r["ids"]})
    table = F.from_json(F.lit(json.dumps(buckets)), TABLE_TYPE)

    def bucket(i: Column) -> Column:
        return F.get(table, F.pmod(F.get(hashes, i), F.lit(size)).cast("int"))

    seen = F.filter(_starts(w, length), lambda i: F.exists(bucket(i), lambda e: e["h"] == F.get(hashes, i)))
    return F.flatten(
        F.transform(
            seen,
            lambda i: F.transform(
                F.filter(bucket(i), lambda e: e["w"] == _window(w, i, length)),
                lambda e: F.struct(i.alias("i"), F.lit(length).alias("l"), e["ids"].alias("ids")),
            ),
        )
    )


def scan(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    table_bytes: int = TABLE_BYTES,
) -> DataFrame:
    """``_doc`` (the input row), its ``words``, and ``hits``: place, length and items of every verified window."""
    items = materialise(item_windows(benchmark, item, item_text, window))
    total = items.agg(F.sum(F.length("w") + 40 + 16 * F.size("ids") + F.length(F.array_join("ids", "")))).first()[0] or 0
    d = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"))
    d = d.select("_doc", words(ascii_lower(F.col(f"_doc.`{text}`")), BETWEEN).alias("words"))
    if total > table_bytes:
        return _scan_joined(d, items, text)
    by_length: dict[int, list] = {}
    for r in items.collect():
        by_length.setdefault(r["l"], []).append(r)
    w = F.col("words")
    d = d.select("_doc", "words", *[_hashes(w, n).alias(f"h{n}") for n in by_length])
    hits = [_hits_by_table(w, F.col(f"h{n}"), n, rows) for n, rows in by_length.items()]
    none = F.array().cast(NONE)
    return d.select("_doc", "words", F.array_sort(F.concat(none, *hits)).alias("hits"))


def _scan_joined(d: DataFrame, items: DataFrame, text: str) -> DataFrame:
    lengths = [r[0] for r in items.select("l").distinct().collect()]
    d = d.withColumn("_key", F.sha2(F.array_join("words", " "), 256))
    # One row for each distinct text, with the hashes of its windows only.
    each = d.groupBy("_key").agg(F.first("words").alias("words"))
    found = None
    for n in lengths:
        places = each.select("_key", F.explode(_starts(F.col("words"), n)).alias("i"), "words").select(
            "_key", "i", _window(F.col("words"), F.col("i"), n).alias("w")
        )
        hits = places.join(items.where(F.col("l") == n).select("w", "l", "ids"), "w").select(
            "_key", F.struct("i", "l", "ids").alias("hit")
        )
        found = hits if found is None else found.union(hits)
    if found is None:
        return d.select("_doc", "words", F.array().cast(NONE).alias("hits"))
    hits = found.groupBy("_key").agg(F.array_sort(F.collect_list("hit")).alias("hits"))
    return d.join(hits, "_key", "left").select("_doc", "words", F.coalesce("hits", F.array().cast(NONE)).alias("hits"))


def n_hit(hits: Column) -> Column:
    """Words under any of the windows, which are sorted by place."""
    start = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))

    def step(acc: Column, h: Column) -> Column:
        end = h["i"] + h["l"]
        return F.struct(
            F.greatest(acc["end"], end).alias("end"),
            (acc["n"] + F.greatest(F.lit(0), end - F.greatest(acc["end"], h["i"]))).alias("n"),
        )

    return F.aggregate(hits, start, step, lambda acc: acc["n"])


def hit_items(hits: Column) -> Column:
    """The ids of the items with verified windows, sorted as strings."""
    return F.array_sort(F.array_distinct(F.flatten(F.transform(hits, lambda h: h["ids"]))))


def contamination(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``_doc``, ``n_words``, ``n_hit``, ``items`` and ``contaminated`` of every row."""
    d = scan(docs, benchmark, **options)
    d = d.select("_doc", F.size("words").cast("long").alias("n_words"), n_hit(F.col("hits")).alias("n_hit"), hit_items(F.col("hits")).alias("items"))
    return d.withColumn("contaminated", F.col("n_hit") > 0)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, most_share: float = 0.0, **options) -> DataFrame:
    """Rows of ``docs`` of whose words no more than ``most_share`` are hit."""
    # Settled: the filter must not sink below the scan and repeat it for every window.
    d = settled(contamination(docs, benchmark, **options))
    return d.where(F.col("n_hit") <= most_share * F.col("n_words")).select("_doc.*")


def remove_spans(docs: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """``docs`` with the hit words, and what stands before each, cut out of the texts."""
    d = scan(docs, benchmark, text=text, **options)
    # Runs of hit words: each window that starts after all earlier ones ended opens one.
    start = F.array().cast("array<struct<a:int,b:int>>")

    def step(acc: Column, h: Column) -> Column:
        end = (h["i"] + h["l"]).cast("int")
        last = F.element_at(acc, -1)
        joined = F.concat(
            F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(last["a"].alias("a"), F.greatest(last["b"], end).alias("b")))
        )
        return F.when((F.size(acc) > 0) & (F.try_element_at(acc, F.lit(-1))["b"] >= h["i"]), joined).otherwise(
            F.concat(acc, F.array(F.struct(h["i"].cast("int").alias("a"), end.alias("b"))))
        )

    body = F.col(f"_doc.`{text}`")
    d = d.select(
        "_doc",
        F.aggregate("hits", start, step).alias("runs"),
        words(body, WRITTEN_BETWEEN).alias("w"),
        F.split(body, WRITTEN_WORD).alias("gaps"),
    )
    # Kept runs of words lie between the hit ones.
    n = F.size("w")
    cut = F.concat(
        F.transform(
            "runs",
            lambda r, k: F.struct(
                F.when(k == 0, F.lit(0)).otherwise(F.get("runs", k - 1)["b"]).alias("a"), r["a"].alias("b")
            ),
        ),
        F.array(F.struct(F.coalesce(F.try_element_at("runs", F.lit(-1))["b"], F.lit(0)).alias("a"), n.alias("b"))),
    )
    pieces = F.transform(
        cut,
        lambda r: F.array_join(
            F.transform(
                F.when(r["b"] > r["a"], F.sequence(r["a"], r["b"] - 1)).otherwise(F.array().cast("array<int>")),
                lambda i: F.concat(F.get("gaps", i), F.get("w", i)),
            ),
            "",
        ),
    )
    new = F.when(F.size("runs") > 0, F.concat(F.array_join(pieces, ""), F.get("gaps", n))).otherwise(body)
    d = d.select("_doc", new.alias("new"))
    names = docs.columns
    return d.select(*[F.col("new").alias(c) if c == text else F.col(f"_doc.`{c}`").alias(c) for c in names])
