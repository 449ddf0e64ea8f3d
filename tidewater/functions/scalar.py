"""Scalar Column builders."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from tidewater.fixed_values import (
    AUTHORISED_CODE, NOTE_KEY_LENGTH, NOTE_KEY_PREFIX, STATUS_AUTHORISED, STATUS_CANCELLED, STATUS_PENDING,
)


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def map_code(col, mapping: Mapping, fallback: str = "self") -> Column:
    """Small literal code map as a CASE chain (no join, no broadcast).

    ``fallback='self'`` keeps the code itself when unmapped; ``None`` gives NULL.
    """
    col = _c(col)
    out = None
    for k, v in mapping.items():
        out = F.when(col == F.lit(k), F.lit(v)) if out is None else out.when(col == F.lit(k), F.lit(v))
    other = col if fallback == "self" else F.lit(fallback)
    if out is None:
        return other
    return out.otherwise(other)


def starts_with_ci(col, prefix: str) -> Column:
    """``col ~~* 'prefix%'`` (case-insensitive prefix, accents kept)."""
    return F.startswith(F.lower(_c(col)), F.lit(prefix.lower()))


def hotel_of(prefix_col, fallback_cols: Sequence, rules: Sequence[tuple[str, str]], sep: str = "-") -> Column:
    """site code from location text.

    The first rule ``(prefix, code)`` whose prefix matches ``prefix_col``
    case-insensitively wins; otherwise the trimmed part before the first
    ``sep`` of ``coalesce(*fallback_cols)``.
    """
    pc = _c(prefix_col)
    other = F.trim(F.split_part(F.coalesce(*[_c(c) for c in fallback_cols]), F.lit(sep), F.lit(1)))
    out = None
    for prefix, code in rules:
        cond = starts_with_ci(pc, prefix)
        out = F.when(cond, F.lit(code)) if out is None else out.when(cond, F.lit(code))
    return other if out is None else out.otherwise(other)


def status_of(cancelled, sefaz_status, authorised_code: str = AUTHORISED_CODE) -> Column:
    """note status; order matters -- a cancelled note is 'Cancelada' even
    if it was authorised first."""
    return (F.when(_c(cancelled), F.lit(STATUS_CANCELLED))
            .when(_c(sefaz_status) == F.lit(authorised_code), F.lit(STATUS_AUTHORISED))
            .otherwise(F.lit(STATUS_PENDING)))


def unit_price(total, count) -> Column:
    """total / count when count > 0, else 0 (decimal division)."""
    total, count = _c(total), _c(count)
    return F.when(count > 0, total / count).otherwise(F.lit(0).cast("decimal(38,18)"))


def export_quantity(count) -> Column:
    """F19 quantity: ``lineCount or 1`` (NULL and 0 both become 1)."""
    count = _c(count)
    return F.when(count.isNull() | (count == 0), F.lit(1)).otherwise(count)


def export_unit_price(total, count) -> Column:
    """F19 price: total / (count or 1), HALF_UP to 2 places on decimals."""
    q = export_quantity(count)
    return F.round(F.coalesce(_c(total).cast("decimal(38,18)"), F.lit(0).cast("decimal(38,18)")) / q, 2)


def hours_between(start, end) -> Column:
    """``EXTRACT(epoch FROM end - start) / 3600`` as DOUBLE (microsecond exact)."""
    return F.expr("timestampdiff(MICROSECOND, {}, {})".format(_sql(start), _sql(end))) / F.lit(3.6e9)


def micros_between(start, end) -> Column:
    return F.expr("timestampdiff(MICROSECOND, {}, {})".format(_sql(start), _sql(end)))


def _sql(x) -> str:
    if isinstance(x, str):
        return f"`{x}`"
    raise TypeError("pass column names to hours_between/micros_between")


def blank_to_null(col) -> Column:
    """``NULLIF(x, '')`` -- blank keys must not meet in one task."""
    return F.nullif(_c(col), F.lit(""))


def full_name(a, b) -> Column:
    """F8: ``a || ' ' || b``, NULL if either is NULL (as PostgreSQL ``||``)."""
    return F.concat(_c(a), F.lit(" "), _c(b))


def iso_date(col) -> Column:
    """Date of an ISO text, taking the literal date (offset ignored); NULL if it is none."""
    return F.try_to_date(F.substring(_c(col), 1, 10), "yyyy-MM-dd")


def text_to_utc(col) -> Column:
    """Read the local date-time of an ISO text as UTC, dropping any offset;
    fractional seconds are kept. NULL if the text is no date-time."""
    local = F.regexp_replace(_c(col), r"(:\d{2}(?:\.\d+)?)\s*(?:Z|[+-]\d{2}(?::?\d{2})?)$", "$1").try_cast("timestamp_ntz")
    return F.convert_timezone(F.lit("UTC"), F.current_timezone(), local).cast("timestamp")


def instant(col) -> Column:
    """``text::timestamptz``: ISO text with offset -> instant; NULL if it is none."""
    return F.try_to_timestamp(_c(col))


def local_day(col, zone: str | None = None) -> Column:
    """instant -> calendar day in ``zone`` (default: session zone, D11).

    The instant's wall time in the session zone is converted to ``zone``, so
    the result does not depend on the session setting."""
    c = _c(col)
    if zone:
        c = F.convert_timezone(F.current_timezone(), F.lit(zone), c.cast("timestamp_ntz"))
    return F.to_date(c)


def month_of(col) -> Column:
    """``DATE_TRUNC('month', x)::date``."""
    return F.trunc(F.to_date(_c(col)), "month")


def abs_diff(a, b) -> Column:
    """F13."""
    return F.abs(_c(a) - _c(b))


def differs(a, b, tol: float = 0.01) -> Column:
    """``abs(a - b) > tol``."""
    return abs_diff(a, b) > F.lit(tol)


def is_one(col) -> Column:
    """``x::int = 1``."""
    return _c(col).try_cast("int") == F.lit(1)


def present(col) -> Column:
    """F15."""
    return _c(col).isNotNull()


def only_digits(col) -> Column:
    """F16: strip non-digits."""
    return F.regexp_replace(_c(col), r"[^0-9]", "")


def digits(col, n: int = NOTE_KEY_LENGTH) -> Column:
    """F16: first run of ``n`` digits, NULL if none."""
    return F.nullif(F.regexp_extract(_c(col), rf"(\d{{{n}}})", 1), F.lit(""))


def clean_key(col, prefix: str = NOTE_KEY_PREFIX, n: int = NOTE_KEY_LENGTH) -> Column:
    """drop the prefix; NULL unless exactly ``n`` long."""
    k = F.replace(_c(col), F.lit(prefix), F.lit(""))
    return F.when(F.length(k) == n, k)


def config_key(name) -> Column:
    """``upper(name)`` with spaces turned into ``_``."""
    return F.replace(F.upper(_c(name)), F.lit(" "), F.lit("_"))


def int_or_zero(col) -> Column:
    """integer setting, 0 when missing or malformed."""
    return F.coalesce(_c(col).try_cast("int"), F.lit(0))


def slice_text(col, start, length) -> Column:
    """fixed-offset field of a free-text column (1-based, SQL substr)."""
    s = _c(start) if not isinstance(start, int) else F.lit(start)
    n = _c(length) if not isinstance(length, int) else F.lit(length)
    return F.substr(_c(col), s, n)


def decimal(col, p: int = 12, s: int = 2) -> Column:
    """G6 input: exact decimal so that sums agree across engines."""
    return _c(col).cast(f"decimal({p},{s})")
