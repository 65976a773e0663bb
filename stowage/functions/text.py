"""Keys and text: padding, site tags, defaults, pallet tags."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What the extracts' reader treats as missing.
NA_TEXT = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]


def na_to_null(name: str) -> Column:
    """The named text column with missing-value spellings as null."""
    listed = ", ".join(f"'{t}'" for t in NA_TEXT)
    return F.expr(f"CASE WHEN `{name}` IN ({listed}) THEN NULL ELSE `{name}` END")


def tag_site(c: Column, suffix: str) -> Column:
    """Append the site suffix; null stays null."""
    return F.concat(c, F.lit(suffix))


def receipt_of(product_id: Column) -> Column:
    """Receipt id: the first ten characters of a product id."""
    return F.substring(product_id, 1, 10)


def zero_pad(c: Column, width: Column | int) -> Column:
    """Left-pad with zeros, leaving longer text alone (``lpad`` alone would cut it)."""
    width = width if isinstance(width, Column) else F.lit(width)
    return F.lpad(c, F.greatest(width, F.length(c)), F.lit("0"))


def number_order(c: Column) -> Column:
    """Sort key of ids and line numbers: their leading digits as a number, those without any last, then text."""
    number = F.regexp_extract(c, "^[0-9]+", 0).try_cast("decimal(38,0)")
    return F.struct(number.isNull().alias("wordy"), number.alias("number"), c.alias("text"))


def ten_digit_receipt(c: Column) -> Column:
    """Numeric receipt ids as ten digits; anything else is trimmed and padded to ten."""
    digits = F.regexp_replace(c, "^0+", "")
    return zero_pad(F.trim(F.when(c.rlike("^[0-9]+$"), zero_pad(digits, 10)).otherwise(c)), 10)


def blank_to(c: Column, default: str) -> Column:
    """Null or blank text becomes ``default``; other text is kept as it is."""
    return F.when(c.isNull() | (F.trim(c) == ""), F.lit(default)).otherwise(c)


def norm(c: Column) -> Column:
    return F.upper(F.trim(c))


def item_key(receipt: Column, item: Column) -> Column:
    """Stock item id: receipt followed by item; null if either part is."""
    return F.concat(receipt, item)


def pallet_tag(c: Column) -> Column:
    """The tag of a real pallet (``TA…``), else null: such rows are a pallet of their own."""
    return F.when(c.startswith("TA"), c)


def pallet_tag_or_own(c: Column, *row_key: Column) -> Column:
    """Pallet tag, or a repeatable surrogate made from the row's own key columns."""
    own = F.concat(F.lit("U"), F.xxhash64(*row_key).cast("string"))
    return F.coalesce(pallet_tag(c), own)


def na_label(c: Column, label: str = "N/A") -> Column:
    """Text for display, with a label in place of null."""
    return F.coalesce(c.cast("string"), F.lit(label))
