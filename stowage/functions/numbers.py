"""Numbers: coercing casts, ratios, rounding."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Measures are summed as decimals, so a total never depends on the order rows arrive in.
MEASURE = "decimal(18,4)"
DEFAULT_VOLUME = 1.5  # fixed value: cubic metres of a product that has no volume yet


def measure(c: Column) -> Column:
    """Any text or number as an exact measure; text that is no number becomes null."""
    return c.try_cast(MEASURE)


def coerce_measures(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: measure(F.col(n)) for n in names if n in df.columns})


NUMBER = r"^\s*[+-]?([0-9]+)?(?:\.([0-9]*))?\s*$"  # plain decimals; other spellings are measured as the default
SUM_DIGITS = 10  # digits that a sum of a decimal may have beyond its values


def fitted_types(df: DataFrame, *names: str) -> dict[str, str]:
    """The decimal type that each named column needs to keep all of its numbers, from one pass over the table.

    ``MEASURE`` where that holds them; else as many digits before and behind the point as some number has. A column
    that would need more digits than a decimal can sum raises.
    """
    names = [n for n in names if n in df.columns]
    if not names:
        return {}
    digits = []
    for n in names:
        text = F.col(n).cast("string")
        plain = text.rlike(NUMBER) & text.rlike("[0-9]")
        whole = F.length(F.regexp_replace(F.regexp_extract(text, NUMBER, 1), "^0+", ""))
        part = F.length(F.regexp_replace(F.regexp_extract(text, NUMBER, 2), "0+$", ""))
        digits += [F.max(F.when(plain, whole)).alias(f"{n}_whole"), F.max(F.when(plain, part)).alias(f"{n}_part")]
    found = df.agg(*digits).first()
    out = {}
    for n in names:
        whole, part = found[f"{n}_whole"] or 0, found[f"{n}_part"] or 0
        if whole <= 14 and part <= 4:
            out[n] = MEASURE
            continue
        whole, part = max(whole, 1), max(part, 4)
        if whole + part + SUM_DIGITS > 38:
            raise OverflowError(f"{n}: numbers of {whole} digits before and {part} behind the point cannot be summed exactly")
        out[n] = f"decimal({whole + part},{part})"
    return out


def coerce_fitted(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """The named columns as exact numbers of their types; text that is no number becomes null.

    A number that its type cannot hold, because ``types`` came from other data, raises instead of being cut or nulled.
    """
    changes = {}
    for n, kind in types.items():
        text = F.col(n).cast("string")
        value = F.col(n).try_cast(kind)
        plain = text.rlike(NUMBER) & text.rlike("[0-9]")
        scale = int(kind.split(",")[1].rstrip(")"))
        lost = value.isNull() | (F.length(F.regexp_replace(F.regexp_extract(text, NUMBER, 2), "0+$", "")) > scale)
        stop = F.raise_error(F.concat(F.lit(f"{n} does not fit {kind}: "), text)).cast(kind)
        changes[n] = F.when(plain & lost, stop).otherwise(value)
    return df.withColumns(changes)


def as_double(c: Column) -> Column:
    """Coercing cast to double in which the text ``nan`` is null too."""
    number = c.try_cast("double")
    return F.when(F.isnan(number), None).otherwise(number)


def total(c: Column | str) -> Column:
    """Sum that is zero, not null, when nothing is summed."""
    return F.coalesce(F.sum(c), F.lit(0).cast(MEASURE))


def tally(condition: Column) -> Column:
    """Rows that meet ``condition``."""
    return F.count(F.when(condition, 1))


def positive_part(c: Column) -> Column:
    return F.greatest(c, F.lit(0))


def round2(c: Column) -> Column:
    """Two decimals, halves to the even digit, rounded on the scaled double as numpy does."""
    return F.rint(c.cast("double") * 100) / 100


def ratio(a: Column, b: Column) -> Column:
    """a / b as double; null where b is zero."""
    return F.try_divide(a.cast("double"), b.cast("double"))


def percent(a: Column, b: Column) -> Column:
    return ratio(a, b) * 100


def change_percent(now: Column, before: Column) -> Column:
    """Change against an earlier value in percent; null where that value is zero or missing."""
    return (ratio(now, before) - 1) * 100


def near_zero(c: Column, epsilon: float = 1e-6) -> Column:
    return F.when(F.abs(c) < epsilon, F.lit(0)).otherwise(c)


def clip_near_zero(df: DataFrame, names: Iterable[str] | None = None, epsilon: float = 1e-6) -> DataFrame:
    """Values closer to zero than ``epsilon`` become 0, in all numeric columns or those named."""
    if names is None:
        names = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    kinds = {f.name: f.dataType for f in df.schema.fields}
    return df.withColumns({n: near_zero(F.col(n), epsilon).cast(kinds[n]) for n in names})


def pallets_for(rows: Column, fill: Column) -> Column:
    """Pallets needed for ``rows`` items when a pallet usually carries ``fill`` of them."""
    return F.ceil(rows / fill).cast("long")


def detached_later(modified: Column, received: Column, measures: Iterable[Column], order_qty: Column) -> Column:
    """Quantity detached after the month of receipt: the pick quantity of an emptied item.

    Months are compared as month-of-year, as billing does.
    """
    emptied = F.lit(True)
    for m in measures:
        emptied = emptied & (m == 0)
    return F.when((F.month(modified) >= F.month(received)) & emptied, order_qty)
