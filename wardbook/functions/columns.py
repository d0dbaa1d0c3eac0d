"""Column → Column helpers for cleansing, keys, dates, predicates and rates."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, functions as F

from wardbook.config import Kind

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---- cleansing ---------------------------------------------------------------


def clean_text(
    c: ColumnOrName, default: str | None = None, *, strip_quotes: bool = True, trim: bool = True
) -> Column:
    """Line breaks (and double quotes) become blanks, outer blanks go.

    With a ``default``, text that is NULL or ends up empty is replaced by it; without
    one, NULL stays NULL and empty stays empty. Only blanks are trimmed, tabs survive.
    """
    out = _col(c)
    # Plain byte replacement: these are single characters, no pattern matching needed.
    for char in ("\r", "\n", '"') if strip_quotes else ("\r", "\n"):
        out = F.replace(out, F.lit(char), F.lit(" "))
    if trim:
        out = F.trim(out)
    return out if default is None else F.coalesce(F.nullif(out, F.lit("")), F.lit(default))


def sentinel_fill(c: ColumnOrName, sentinel) -> Column:
    return F.coalesce(_col(c), F.lit(sentinel))


def map_values(c: ColumnOrName, mapping: Mapping, default) -> Column:
    """First matching key wins; anything else, NULL included, gives ``default``."""
    out = F.lit(default)
    for key, value in reversed(list(mapping.items())):
        out = F.when(_col(c) == F.lit(key), F.lit(value)).otherwise(out)
    return out


def backfill(c: ColumnOrName, source: ColumnOrName, sentinel) -> Column:
    """Take ``source`` where ``c`` is the sentinel and ``source`` is known."""
    c, source = _col(c), _col(source)
    return F.when((c == F.lit(sentinel)) & source.isNotNull(), source).otherwise(c)


# ---- keys and dates ----------------------------------------------------------


def surrogate_key(*parts: ColumnOrName) -> Column:
    """Parts joined by ``_``; NULL as soon as one part is NULL."""
    pieces: list[Column] = []
    for i, part in enumerate(parts):
        if i:
            pieces.append(F.lit("_"))
        pieces.append(_col(part).cast("string"))
    return F.concat(*pieces)


def month_of(ts: ColumnOrName) -> Column:
    return F.date_format(_col(ts), "yyyy-MM")


# ---- predicates --------------------------------------------------------------


def valid_key(c: ColumnOrName) -> Column:
    return _col(c).isNotNull() & (_col(c) >= 0)


def any_present(*cols: ColumnOrName) -> Column:
    return reduce(or_, [_col(c).isNotNull() for c in cols])


def since_year(c: ColumnOrName, year: int, *, is_year: bool = False) -> Column:
    """Year cut-off on a timestamp, or on a year number with ``is_year``.

    On timestamps this is a plain range predicate, so it reaches the Parquet reader.
    """
    return _col(c) >= (F.lit(year) if is_year else F.make_timestamp_ntz(*[F.lit(v) for v in (year, 1, 1, 0, 0, 0)]))


def since_month(c: ColumnOrName, month: str) -> Column:
    return _col(c) >= F.lit(month)


def is_kind(id_col: ColumnOrName, name_col: ColumnOrName, kind: Kind) -> Column:
    return (_col(id_col) == kind.id) & (_col(name_col) == kind.name)


def same_all(pairs: Iterable[tuple[ColumnOrName, ColumnOrName]]) -> Column:
    return reduce(and_, [_col(a) == _col(b) for a, b in pairs])


def differs_any(pairs: Iterable[tuple[ColumnOrName, ColumnOrName]]) -> Column:
    """Some pair is known to differ; NULL on either side never makes a difference by itself."""
    return reduce(or_, [_col(a) != _col(b) for a, b in pairs])


def meets(count: ColumnOrName, standard: ColumnOrName) -> Column:
    """1 if the count reaches the standard or there is none, else 0."""
    return F.when(_col(standard).isNull() | (_col(count) >= _col(standard)), 1).otherwise(0)


# ---- rates -------------------------------------------------------------------


def safe_ratio(num: ColumnOrName, den: ColumnOrName, digits: int = 2) -> Column:
    """Rounded ratio, NULL for a zero or missing denominator."""
    return F.round(F.try_divide(_col(num), _col(den)), digits)


def percent_text(num: ColumnOrName, den: ColumnOrName, *, round_first: bool = False) -> Column:
    """``'66.67%'``. ``round_first`` rounds the ratio, then scales (``'57.0%'`` steps, float tails included)."""
    num = _col(num)
    value = safe_ratio(num, den) * 100 if round_first else safe_ratio(num * 100, den)
    return F.concat(value.cast("string"), F.lit("%"))
