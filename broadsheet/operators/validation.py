"""Row rules at the three stage boundaries.

A rule names a field and the reason a value is refused.  Field rules are tried
in order and a field reports its first failure; row rules are looked at only
when every field passes and every earlier row rule holds.  Rows are tagged, not
filtered, until the caller asks: a filter on computed columns would be pushed
below the cleaning steps and repeat them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from broadsheet.functions.text import strip_sql
from broadsheet.schema import CATEGORY_LABELS, REQUIRED_COLUMNS, SIZE_LABELS, SURPLUS_FLAG
from broadsheet.session import settled

VIOLATION_TYPE = "array<struct<field:string,rule:string>>"
STAGES = ("raw", "clean", "enriched")


@dataclass(frozen=True)
class Rule:
    """``broken`` is a SQL condition: true, never null, on rows that break the
    rule.  Text costs one call to the JVM per stage; columns built piece by
    piece cost one per piece."""

    field: str
    name: str
    broken: str
    whole_row: bool = False


def _text_rules(field: str) -> list[Rule]:
    # Most texts start with visible ASCII, which one comparison tells.
    blank = f"CASE WHEN {field} >= '!' AND {field} < '\x7f' THEN false ELSE coalesce({strip_sql(field)} = '', true) END"
    return [Rule(field, "missing", f"{field} IS NULL"), Rule(field, "empty", blank)]


def _label_rules(field: str, labels: list[str]) -> list[Rule]:
    allowed = ", ".join(f"'{label}'" for label in labels)
    return [Rule(field, "not an allowed label", f"coalesce({field} NOT IN ({allowed}), true)")]


_WHOLE_TEXT = r"^[+-]?[0-9]+(_[0-9]+)*(\.0*)?$"
#: Spellings of a flag in text, as the typed fields of the reference take them (fixed values).
FLAG_TRUE = ("1", "on", "t", "true", "y", "yes")
FLAG_FALSE = ("0", "off", "f", "false", "n", "no")


def _kind(columns, field: str) -> str:
    """``integral``, ``fractional``, ``boolean`` or ``text``: how a field's type is compared."""
    fields = getattr(columns, "fields", None)
    kind = next((f.dataType for f in fields if f.name == field), None) if fields else None
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return "integral"
    if isinstance(kind, (T.FloatType, T.DoubleType, T.DecimalType)):
        return "fractional"
    if isinstance(kind, T.BooleanType):
        return "boolean"
    return "text"


def _range_rules(field: str, low: int | None, high: int | None, nullable: bool = True, columns=None) -> list[Rule]:
    """Whole-number and range rules, compiled for the field's type.

    Integers are compared as they are; fractional numbers must have no
    fraction (NaN and infinities have one); text must read as a whole number:
    digits with an optional sign, underscores between digits and a fraction
    of zeros ("5d" and "1e3" do not).
    """
    kind = _kind(columns, field)
    given = f"{field} IS NOT NULL AND " if nullable else ""
    if kind == "integral":
        whole, number = ("false" if nullable else f"{field} IS NULL"), field
    elif kind == "boolean":
        whole, number = ("false" if nullable else f"{field} IS NULL"), f"int({field})"
    elif kind == "fractional":
        whole, number = f"{given}coalesce(NOT ({field} % 1 = 0), true)", field
    else:
        text = f"trim(CAST({field} AS string))"
        whole = f"{given}coalesce(NOT ({text} RLIKE r'{_WHOLE_TEXT}'), true)"
        number = rf"try_cast(regexp_replace({text}, r'_|\.0*$', '') AS decimal(38, 0))"
    rules = [Rule(field, "not a whole number", whole)]
    if low is not None:
        rules.append(Rule(field, f"below {low}", f"coalesce({number} < {low}, false)"))
    if high is not None:
        rules.append(Rule(field, f"above {high}", f"coalesce({number} > {high}, false)"))
    return rules


def _flag(field: str, columns) -> tuple[str, str]:
    """SQL for (the field is no flag, the flag is set), compiled for the field's type."""
    kind = _kind(columns, field)
    if kind == "boolean":
        return "false", f"coalesce({field}, false)"
    if kind in ("integral", "fractional"):
        return f"coalesce(NOT ({field} IN (0, 1)), false)", f"coalesce({field} = 1, false)"
    text = f"lower(trim(CAST({field} AS string)))"
    spellings = ", ".join(f"'{x}'" for x in FLAG_TRUE + FLAG_FALSE)
    return f"coalesce(NOT ({text} IN ({spellings})), false)", f"coalesce({text} IN ({', '.join(repr(x) for x in FLAG_TRUE)}), false)"


def raw_rules(columns) -> list[Rule]:
    """Rules for rows as read.  Columns a table need not have are skipped."""
    columns = [getattr(c, "name", c) for c in getattr(columns, "fields", columns)]
    rules = []
    if SURPLUS_FLAG in columns:
        rules.append(Rule("<row>", "more cells than columns", f"coalesce({SURPLUS_FLAG}, false)"))
    for field in ("article_id", "title", "company_name", "published_date", "category", "summary", "url"):
        rules += _text_rules(field)
    # The usual form is tested first; only other texts need stripping.
    schemes = [f"startswith({t}, '{s}')" for t in ("url", strip_sql("url")) for s in ("https://", "http://")]
    rules.append(Rule("url", "no http scheme", f"coalesce(NOT ({' OR '.join(schemes)}), true)"))
    plain = r"article_id RLIKE r'^[A-Za-z0-9_-]+\z'"
    other = rf"{strip_sql('article_id')} RLIKE r'(?iu)^[A-Z0-9_-]+\z'"
    rules.append(Rule("article_id", "unexpected characters", f"coalesce(NOT ({plain} OR {other}), true)"))
    if "author" in columns:
        rules.append(Rule("author", "missing", "author IS NULL"))
    return rules


def clean_rules(columns) -> list[Rule]:
    """Rules for cleaned rows."""
    rules = _text_rules("article_id") + _text_rules("company_name")
    date, bare = "published_date", strip_sql("published_date")
    iso = r"RLIKE r'^\d{4}-\d{2}-\d{2}\z'"
    rules += [
        Rule(date, "missing", f"{date} IS NULL"),
        Rule(date, "not an ISO date", f"coalesce(NOT ({date} {iso} OR {bare} = '' OR {bare} {iso}), true)"),
    ]
    rules += _label_rules("category", CATEGORY_LABELS)
    rules += _range_rules("revenue_usd", 0, None, nullable=False, columns=columns)
    rules += _range_rules("pub_year", 1900, 2100, columns=columns)
    rules += _range_rules("pub_quarter", 1, 4, columns=columns)
    rules += _range_rules("pub_month", 1, 12, columns=columns)
    parts = " + ".join(f"int({c} IS NULL)" for c in ("pub_year", "pub_quarter", "pub_month"))
    rules.append(Rule("<row>", "date parts partly missing", f"{parts} NOT IN (0, 3)", whole_row=True))
    return rules


def enriched_rules(columns) -> list[Rule]:
    """Rules for enriched rows: the clean rules and those on company fields.

    ``columns`` is a schema, whose types decide how numbers and flags are
    compared, or a list of names (then every field is taken as text).
    """
    names = [getattr(c, "name", c) for c in getattr(columns, "fields", columns)]
    rules = clean_rules(columns)
    no_flag, matched = _flag("metadata_matched", columns)
    rules.append(Rule("metadata_matched", "missing", "metadata_matched IS NULL"))
    rules.append(Rule("metadata_matched", "not a flag", f"metadata_matched IS NOT NULL AND {no_flag}"))
    if "meta_founded_year" in names:
        rules += _range_rules("meta_founded_year", 1800, 2100, columns=columns)
    if "meta_employee_count" in names:
        rules += _range_rules("meta_employee_count", 0, None, columns=columns)
    rules += _label_rules("company_size_category", SIZE_LABELS)
    rules += _range_rules("company_age", -10, 300, columns=columns)
    founded = "meta_founded_year" if "meta_founded_year" in names else "NULL"
    unfounded = f"{matched} AND {founded} IS NULL"
    rules.append(Rule("<row>", "matched without founding year", unfounded, whole_row=True))
    return rules


RULES = {"raw": raw_rules, "clean": clean_rules, "enriched": enriched_rules}


def absent_columns(df: DataFrame, stage: str) -> list[str]:
    return sorted(set(REQUIRED_COLUMNS.get(stage, [])) - set(df.columns))


def check_columns(df: DataFrame, stage: str) -> None:
    """Raise when a required column is absent.  Needs no data unless one is:
    an empty table passes whatever its columns."""
    absent = absent_columns(df, stage)
    if absent and not df.isEmpty():
        raise ValueError(f"stage {stage!r}: required columns are missing: {absent}")


def column_faults(df: DataFrame, stage: str) -> DataFrame:
    """``(stage, field, rows)``: each absent required column and the rows that lack it."""
    fields = F.array(*[F.lit(c) for c in absent_columns(df, stage)]).cast("array<string>")
    counted = df.agg(F.count(F.lit(1)).alias("rows")).where("rows > 0")
    return counted.select(F.lit(stage).alias("stage"), F.explode(fields).alias("field"), "rows")


def violations(rules: list[Rule]) -> Column:
    """Every reported fault of a row, as an array."""
    by_field: dict[str, list[Rule]] = {}
    for rule in rules:
        if not rule.whole_row:
            by_field.setdefault(rule.field, []).append(rule)
    cases = [
        (field, " ".join(f"WHEN {c.broken} THEN '{c.name}'" for c in checks)) for field, checks in by_field.items()
    ]
    earlier = [f"({r.broken})" for r in rules if not r.whole_row]
    for rule in (r for r in rules if r.whole_row):
        cases.append((rule.field, f"WHEN ({rule.broken}) AND NOT ({' OR '.join(earlier)}) THEN '{rule.name}'"))
        earlier.append(f"({rule.broken})")
    faults = ", ".join(f"named_struct('field', '{field}', 'rule', CASE {when} END)" for field, when in cases)
    return F.expr(f"filter(array({faults}), v -> v.rule IS NOT NULL)").cast(VIOLATION_TYPE)


def passes(rules: list[Rule]) -> Column:
    """Whether a row keeps every rule."""
    return F.expr(" AND ".join(f"NOT ({r.broken})" for r in rules))


def tag_stage(df: DataFrame, stage: str) -> DataFrame:
    """Mark the rows that fail at ``stage`` in ``outcome`` and ``violations``.

    A row that an earlier stage marked keeps that mark and counts once.
    """
    check_columns(df, stage)
    rules = RULES[stage](df.schema)
    seen = "outcome" in df.columns
    before = F.col("outcome") if seen else F.lit(None).cast("string")
    faults = F.col("violations") if seen else F.lit(None).cast(VIOLATION_TYPE)
    fails = before.isNull() & ~passes(rules)
    return settled(df).withColumns(
        {
            "outcome": F.coalesce(before, F.when(fails, F.lit(stage))),
            "violations": F.when(fails, violations(rules)).otherwise(faults),
        }
    )


@dataclass(frozen=True)
class StageResult:
    """Rows that pass, unchanged; rows that fail, one row per fault; counts."""

    valid: DataFrame
    rejects: DataFrame
    counts: Observation


def split_stage(df: DataFrame, stage: str) -> StageResult:
    """Split a table at a stage boundary.

    ``counts`` holds ``rows`` and ``failed`` once an action ran over ``valid``.
    An unknown stage has no rules and keeps every row.
    """
    counts = Observation()
    if stage in RULES:
        tagged = tag_stage(df.drop("outcome", "violations"), stage)
    else:
        tagged = df.withColumns({"outcome": F.lit(None).cast("string"), "violations": F.lit(None).cast(VIOLATION_TYPE)})
    watched = tagged.observe(
        counts, F.count(F.lit(1)).alias("rows"), F.count_if(F.col("outcome").isNotNull()).alias("failed")
    )
    valid = watched.where(F.col("outcome").isNull()).drop("outcome", "violations")
    return StageResult(valid, reject_table(tagged), counts)


def reject_table(tagged: DataFrame) -> DataFrame:
    """One row per fault of every row that a stage refused."""
    return (
        settled(tagged)
        .where(F.col("outcome").isin(*STAGES))
        .select("article_id", F.col("outcome").alias("stage"), F.explode("violations").alias("v"))
        .select("article_id", "stage", F.col("v.field").alias("field"), F.col("v.rule").alias("rule"))
    )
