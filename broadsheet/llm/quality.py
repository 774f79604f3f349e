"""Quality rules: a table of thresholds compiled into one Spark projection.

Words are runs of anything but the ASCII white space characters.  A document
fails the base rules if it has fewer than 50 words or more than half of its
words lie in repeated three-word windows.  Others are judged by ``RULES``: each
names a measure and the least and greatest value that passes.  A null or empty
text has no words and fails.  Everything is native expressions of one row, so
there is no shuffle, and long texts cost n log n at most.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from broadsheet.llm.common import SPACE, words
from broadsheet.session import settled

SYMBOLS = "#*$%&|<>"
#: Very frequent words of the languages the rules know.
STOP_WORDS = {
    "en": "the of and to in a is that for it as was with be by on not he his but at are this have had from or an".split(),
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er".split(),
    "fr": "de la le et les des en un du une que est pour qui dans par plus pas au sur ne se ce il sont avec son".split(),
    "es": "de la que el en y a los se del las un por con no una su para es al lo como más o pero sus le".split(),
}
#: (rule, measure, least, greatest)
RULES = [
    ("length", "n_words", 50, None),
    ("word_length", "mean_word_chars", 2.0, 14.0),
    ("symbols", "symbol_ratio", None, 0.1),
    ("stop_words", "stop_ratio", 0.06, None),
    ("repeated_lines", "dup_line_ratio", None, 0.5),
]
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def stop_forms() -> list[str]:
    """The stop words as they stand in running text."""
    base = sorted({w for group in STOP_WORDS.values() for w in group})
    return [form + end for w in base for form in dict.fromkeys([w, w.capitalize()]) for end in ("", ",", ".")]


def _repeated_words(sorted_windows: Column) -> Column:
    """Words under windows that equal another one, from windows sorted by hash and text."""

    def at(k: Column) -> Column:
        return F.get(sorted_windows, k)

    def same(s: Column, k: Column) -> Column:
        other = at(k)
        return F.coalesce((other["h"] == s["h"]) & (other["w"] == s["w"]), F.lit(False))

    twice = F.filter(sorted_windows, lambda s, k: same(s, k - 1) | same(s, k + 1))
    places = F.array_sort(F.transform(twice, lambda s: s["i"]))
    start = F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("n"))
    return F.aggregate(
        places, start, lambda acc, i: F.struct(i.alias("last"), (acc["n"] + F.least(F.lit(3), i - acc["last"])).alias("n")), lambda acc: acc["n"]
    )


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the measures that ``RULES`` and the base rules use."""
    body = F.coalesce(F.col(f"_doc.`{text}`"), F.lit(""))
    d = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"))
    d = d.select(
        "_doc",
        words(body, SPACE).alias("w"),
        F.filter(F.split(body, "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]")).alias("lines"),
        F.length(F.regexp_replace(body, SPACE, "")).cast("long").alias("word_chars"),
        (F.length(body) - F.length(F.translate(body, SYMBOLS, ""))).cast("long").alias("n_symbols"),
    )
    n = F.size("w")
    windows = F.transform(
        F.when(n >= 3, F.sequence(F.lit(0), n - 3)).otherwise(F.array().cast("array<int>")),
        lambda i: F.concat_ws(" ", F.get("w", i), F.get("w", i + 1), F.get("w", i + 2)),
    )
    d = d.select(
        "_doc",
        "word_chars",
        "n_symbols",
        n.cast("long").alias("n_words"),
        F.size("lines").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size(F.filter("w", lambda x: x.isin(stop_forms()))).alias("n_stop"),
        windows.alias("windows"),
    )
    d = d.select(
        *[c for c in d.columns if c != "windows"],
        F.array_sort(
            F.transform("windows", lambda w, i: F.struct(F.xxhash64(w).alias("h"), w.alias("w"), i.alias("i")))
        ).alias("sorted"),
    )
    d = d.select(*[c for c in d.columns if c != "sorted"], _repeated_words(F.col("sorted")).alias("n_repeat_words"))
    return d.select(
        "_doc",
        *MEASURES,
        "n_lines",
        (F.col("word_chars") / F.greatest("n_words", F.lit(1))).alias("mean_word_chars"),
        (F.col("n_symbols") / F.greatest("n_words", F.lit(1))).alias("symbol_ratio"),
        (F.col("n_stop") / F.greatest("n_words", F.lit(1))).alias("stop_ratio"),
        (F.col("n_dup_lines") / F.greatest("n_lines", F.lit(1))).alias("dup_line_ratio"),
    )


def compile_rules(rules: list[tuple] = RULES) -> Column:
    """The names of the rules that a measured row breaks, as one expression."""
    broken = []
    for name, of, least, greatest in rules:
        tests = [F.col(of) < least] if least is not None else []
        tests += [F.col(of) > greatest] if greatest is not None else []
        for test in tests:
            broken.append(F.when(test, F.lit(name)))
    return F.filter(F.array(*broken), lambda x: x.isNotNull())


def quality(docs: DataFrame, text: str = "text", rules: list[tuple] = RULES) -> DataFrame:
    """``_doc`` (the input row), the measures, ``broken`` rules, ``base_failed`` and ``kept``."""
    d = measure(docs, text)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    d = d.withColumns({"base_failed": failed, "broken": compile_rules(rules)})
    return d.withColumn("kept", ~F.col("base_failed") & (F.size("broken") == 0))


def keep_good(docs: DataFrame, text: str = "text", rules: list[tuple] = RULES) -> DataFrame:
    """The rows of ``docs`` that pass, with their own columns."""
    # Settled: the filter must not sink below the measures and repeat them.
    return settled(quality(docs, text, rules)).where("kept").select("_doc.*")
