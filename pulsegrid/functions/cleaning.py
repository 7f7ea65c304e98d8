"""Column expressions used by the silver cleaning (all JVM-side, codegen'd).

Every function returns a ``Column``; none of them touches rows in Python.
Casts of dirty input use ``try_cast`` so that ANSI mode turns bad values into
NULL instead of failing the job.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_string(c: str | Column) -> Column:
    """CAST(x AS STRING) without trimming (event keys)."""
    return col_(c).cast("string")


def trim_id(c: str | Column) -> Column:
    """TRIM(CAST(x AS STRING)); a blank id stays blank (not NULL)."""
    return F.trim(col_(c).cast("string"))


def blank_to_null(c: str | Column) -> Column:
    """NULLIF(TRIM(x), '')."""
    return F.nullif(F.trim(col_(c).cast("string")), F.lit(""))


def _norm(c: str | Column) -> Column:
    return F.lower(F.trim(col_(c).cast("string")))


def vocab(c: str | Column, values: Iterable[str]) -> Column:
    """Lower-cased closed vocabulary, anything else NULL."""
    v = _norm(c)
    return F.when(v.isin(*list(values)), v)


def canonical(c: str | Column, labels: Mapping[str, str]) -> Column:
    """Case-insensitive match to a display label (lower key -> label)."""
    v = _norm(c)
    expr = None
    for key, label in labels.items():
        expr = F.when(v == key, F.lit(label)) if expr is None else expr.when(v == key, F.lit(label))
    return expr


TRUE_WORDS = ("true", "1", "yes")
FALSE_WORDS = ("false", "0", "no")


def parse_bool(c: str | Column) -> Column:
    """Tri-state boolean from text."""
    v = _norm(c)
    return F.when(v.isin(*TRUE_WORDS), F.lit(True)).when(v.isin(*FALSE_WORDS), F.lit(False))


def to_ts(c: str | Column) -> Column:
    """Wall-clock timestamp (timestamp_ntz), NULL when unparsable."""
    return col_(c).try_cast("timestamp_ntz")


def to_date(c: str | Column) -> Column:
    """Date, NULL when unparsable."""
    return col_(c).try_cast("date")


def non_negative(c: str | Column) -> Column:
    """P10: double, negative or unparsable -> NULL."""
    v = col_(c).try_cast("double")
    return F.when(v >= 0, v)


def flag(cond: Column) -> Column:
    """0/1 flag; a NULL comparison counts as 0 (as pandas NaN == x is False)."""
    return F.coalesce(cond.cast("int"), F.lit(0))


def clip(c: str | Column, lo: float | None = None, hi: float | None = None) -> Column:
    """Clip to [lo, hi]."""
    out = col_(c)
    if lo is not None:
        out = F.greatest(out, F.lit(lo))
    if hi is not None:
        out = F.least(out, F.lit(hi))
    return out


def coerce_numeric(c: str | Column) -> Column:
    """Non-numeric -> NULL -> 0."""
    return F.coalesce(col_(c).try_cast("double"), F.lit(0.0))


def any_negative(cols: Iterable[str]) -> Column:
    """OR-chain of ``c < 0`` (NULL comparisons are not true)."""
    return reduce(lambda a, b: a | b, [F.col(c) < 0 for c in cols])


def ratio(num: Column, den: Column, digits: int | None = 4) -> Column:
    """A4: ROUND(num * 1.0 / NULLIF(den, 0), digits) as double; NULL when den = 0."""
    r = num.cast("double") / F.nullif(den.cast("double"), F.lit(0.0))
    return F.round(r, digits) if digits is not None else r


def exact_avg(c: str | Column, digits: int | None = None) -> Column:
    """AVG over a decimal copy of the input: exact sum / count, so the result
    does not depend on summation order (a rounded average then never flips
    at a .5 tie between runs, partitionings or engines). Returns double."""
    a = F.avg(col_(c).cast("decimal(24,6)"))
    if digits is not None:
        a = F.round(a, digits)
    return a.cast("double")


def pct_rescale(c: str | Column) -> Column:
    """A value in (0, 1] is a fraction -> times 100; anything else unchanged."""
    v = col_(c)
    return F.when((v > 0) & (v <= 1), v * 100).otherwise(v)


def normalize_id(c: str | Column, prefix: str = "HCP", width: int = 4) -> Column:
    """``1`` -> ``HCP0001``, ``hcp523`` -> ``HCP0523``; width is a minimum."""
    v = F.upper(F.trim(col_(c).cast("string")))
    digits = F.regexp_extract(v, r"^(?:" + prefix + r")?0*(\d+)$", 1)
    padded = F.when(F.length(digits) >= width, digits).otherwise(F.lpad(digits, width, "0"))
    return F.when(digits != "", F.concat(F.lit(prefix), padded)).otherwise(v)


def channel_key(c: str | Column) -> Column:
    """Lower-case, drop underscores and spaces (``Sales_Rep`` == ``sales rep``)."""
    return F.regexp_replace(F.lower(col_(c)), "[_ ]", "")
