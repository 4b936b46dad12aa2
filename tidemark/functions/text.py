"""Text normalisation with built-ins only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_TRIMMED = r"lower(btrim({c}, ' \t\n\r\u000B\u000C'))"
_BY_RUNS = (
    r"aggregate(regexp_extract_all({low}, '(\\p{{L}}+|\\P{{L}}+)', 1), '', "
    r"(acc, run) -> concat(acc, upper(left(run, 1)), substr(run, 2)))"
)


def title_case(column: str) -> Column:
    """Trim, then capitalise every run of letters (``e-mail o'neil`` -> ``E-Mail O'Neil``).

    ``initcap`` only restarts at blanks; it is exact, and cheaper, for plain words, so the
    higher-order form runs only on values holding anything else.
    """
    low = _TRIMMED.format(c=f"`{column}`")
    runs = _BY_RUNS.format(low=low)
    return F.expr(f"CASE WHEN {low} RLIKE '[^a-z ]' THEN {runs} ELSE initcap({low}) END")
