"""Mixed-format dates."""

from __future__ import annotations

# ---- fixed values: texts that mean "no date", and the accepted formats, each
# behind the shape a text must have for that format to be able to succeed.
# Within a shape the order decides ambiguous texts: 12/06/2020 is 6 December.
NO_DATE = ["", "nan", "n/a", "null", "none"]
DATE_SHAPES = [
    (r"(?i)^\d{4}-\d{1,2}-\d{1,2}T", ["yyyy-M-d'T'H:m:s'Z'"]),
    (r"^\d{4}-", ["yyyy-M-d"]),
    (r"^\d{1,2}/", ["M/d/yyyy", "d/M/yyyy"]),
    (r"^\d{1,2}-", ["d-M-yyyy"]),
    (r"^\d{1,2} ", ["d MMM yyyy", "d MMMM yyyy"]),
    (r"^\p{L}", ["MMMM d, yyyy", "MMM d, yyyy"]),
]
# ---- end of fixed values ----


def date_sql(text: str) -> str:
    """SQL for the date in a text that was stripped and squeezed.

    The shapes exclude each other, so a row tries at most two formats; a failed
    attempt costs a Java exception, which is what makes a long list slow.
    """
    cases = [f"WHEN lower({text}) IN ({', '.join(repr(t) for t in NO_DATE)}) THEN CAST(NULL AS timestamp)"]
    for shape, patterns in DATE_SHAPES:
        quoted = [p.replace("'", "\\'") for p in patterns]
        attempts = ", ".join(f"try_to_timestamp({text}, '{p}')" for p in quoted)
        cases.append(f"WHEN {text} RLIKE r'{shape}' THEN coalesce({attempts}, NULL)")
    return f"CAST(CASE {' '.join(cases)} END AS date)"
