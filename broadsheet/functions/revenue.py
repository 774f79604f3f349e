"""Free-form revenue text to whole US dollars.

Every step is used several times by the next one, so the steps are aliases in a
select that refer to earlier aliases: Spark turns them into consecutive
projections and computes each once.  They are SQL text because that costs one
call to the JVM for all of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from broadsheet.functions.text import WORD_END, WORD_START, WS, strip_sql
from broadsheet.session import settled

# ---- fixed values: rates, currency signs, multipliers and accepted spellings ----
USD_RATES = {"USD": 1.0, "GBP": 1.27, "EUR": 1.10, "JPY": 1 / 150}
CURRENCY_SIGNS = {"$": "USD", "£": "GBP", "€": "EUR", "¥": "JPY"}  # in priority order
MULTIPLIERS = {"billion": 1e9, "b": 1e9, "million": 1e6, "m": 1e6, "k": 1e3}
NO_REVENUE = rf"(?i)^(nan|null|n/?a|not{WS}+disclosed|none|--|)$"
_CODE = "USD|EUR|GBP|JPY"
_UNIT = "billion|million|[bmk]"
_AMOUNT = rf"([£€¥$]?[0-9,.]+(?:{WS}*(?:{_UNIT}))?(?:{WS}*(?:{_CODE}))?)"
RANGE = rf"(?iu){_AMOUNT}{WS}*[-–to]+{WS}*{_AMOUNT}"
FIRST_CODE = rf"(?isu)^(.*?){WS}*{WORD_START}({_CODE}){WORD_END}{WS}*(.*)$"
NUMBER_WITH_UNIT = rf"(?iu)[0-9.]+{WS}*(?:{_UNIT}){WORD_END}"
PLAIN_NUMBER = r"[0-9]+(?:\.[0-9]+)?"
# ---- end of fixed values ----

# A cheap test without which the range pattern cannot match.
_MAY_BE_RANGE = rf"[-–tToO]{WS}*[£€¥$]?[0-9,.]"


def _lookup(key: str, table: dict[str, float]) -> str:
    """Value of a key, 1 when there is none.

    A literal map compiles to far less code than a chain of conditions, and
    only small methods get compiled to machine code.
    """
    entries = ", ".join(f"'{name}', {float(value)!r}D" for name, value in table.items())
    return f"coalesce(try_element_at(map({entries}), {key}), 1.0D)"


def _split(end: str) -> dict[str, str]:
    """Currency, and the number with its unit, of one end."""
    signs = " ".join(f"WHEN contains({end}, '{sign}') THEN '{sign}'" for sign in CURRENCY_SIGNS)
    named = " OR ".join(f"contains(upper({end}), '{code}')" for code in USD_RATES)
    return {
        f"{end}_sign": f"CASE {signs} END",
        f"{end}_coded": f"CASE WHEN {end}_sign IS NULL AND ({named}) THEN {end} END",
        f"{end}_code": f"upper(regexp_extract({end}_coded, r'{FIRST_CODE}', 2))",
        f"{end}_body": f"""replace(CASE WHEN {end}_sign IS NOT NULL THEN replace({end}, {end}_sign)
            WHEN {end}_code <> '' THEN regexp_replace({end}, r'{FIRST_CODE}', '$1$3')
            ELSE {end} END, ',')""",
        f"{end}_found": f"regexp_extract({end}_body, r'{NUMBER_WITH_UNIT}', 0)",
    }


def _dollars(end: str) -> dict[str, str]:
    """Dollars of one end: the number with a unit, else the first plain number."""
    rates = {sign: USD_RATES[code] for sign, code in CURRENCY_SIGNS.items()} | USD_RATES
    unit = strip_sql(f"regexp_replace({end}_found, '^[0-9.]+', '')")
    return {
        f"{end}_unit": f"lower({unit})",
        f"{end}_digits": f"""CASE WHEN {end}_found <> '' THEN regexp_replace({end}_found, '[^0-9.]+$', '')
            ELSE regexp_extract({end}_body, r'{PLAIN_NUMBER}', 0) END""",
        f"{end}_usd": f"""coalesce(try_cast({end}_digits AS double), 0D) * {_lookup(f"{end}_unit", MULTIPLIERS)}
            * {_lookup(f"coalesce({end}_sign, {end}_code)", rates)}""",
    }


def _with(df: DataFrame, steps: dict[str, str]) -> DataFrame:
    return df.selectExpr("*", *[f"{sql} AS {name}" for name, sql in steps.items()])


def with_revenue(df: DataFrame, source: str = "revenue", target: str = "revenue_usd") -> DataFrame:
    """Add ``target`` (bigint dollars) and the flag ``<target>_overflow``.

    Empty, missing and unreadable texts give 0.  A value beyond bigint also
    gives 0 and raises the flag.
    """
    raw = f"CAST(`{source}` AS string)" if source in df.columns else "CAST(NULL AS string)"
    steps = {
        "_rev_bare": strip_sql(raw),
        # A text that means "nothing" becomes null, and every later step skips it.
        "_rev_text": f"CASE WHEN NOT (_rev_bare RLIKE r'{NO_REVENUE}') THEN _rev_bare END",
        "_rev_ranged": f"CASE WHEN _rev_text RLIKE r'{_MAY_BE_RANGE}' THEN _rev_text END",
        "_rev_g1": f"regexp_extract(_rev_ranged, r'{RANGE}', 1)",
        "_rev_g2": f"regexp_extract(_rev_ranged, r'{RANGE}', 2)",
        # Two ends of a range, else the whole text as the only end.
        "_rev_lo": "CASE WHEN _rev_g2 <> '' THEN _rev_g1 ELSE _rev_text END",
        "_rev_hi": "CASE WHEN _rev_g2 <> '' THEN _rev_g2 END",
    }
    split = settled(_with(df, steps | _split("_rev_lo") | _split("_rev_hi")))
    value = "CASE WHEN _rev_hi IS NOT NULL THEN (_rev_lo_usd + _rev_hi_usd) / 2 ELSE _rev_lo_usd END"
    steps = _dollars("_rev_lo") | _dollars("_rev_hi")
    steps |= {
        "_rev_usd": f"coalesce(rint({value}), 0D)",
        "_rev_whole": "try_cast(_rev_usd AS bigint)",
        target: "coalesce(_rev_whole, 0L)",
        f"{target}_overflow": "_rev_whole IS NULL",
    }
    kept = [f"`{c}`" for c in df.columns if c not in (target, f"{target}_overflow")]
    return _with(split, steps).select(*kept, target, f"{target}_overflow")
