"""Text expressions for codes and keys: padding, trimming, tolerant comparison, parsing tests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def pad_code(code: Column, width: int = 20) -> Column:
    """Zero-pad on the left to ``width``; a longer code keeps its last ``width`` characters."""
    return F.when(F.length(code) <= width, F.lpad(code, width, "0")).otherwise(F.right(code, F.lit(width)))


def varchar(text: Column, width: int) -> Column:
    """Cut to at most ``width`` characters, as a cast to a sized text column does."""
    return F.substring(text, 1, width)


def fold_case(text: Column) -> Column:
    """Key form under which case and trailing blanks do not count."""
    return F.lower(F.rtrim(text))


def same_text(left: Column, right: Column) -> Column:
    """Equality that ignores case and trailing blanks."""
    return fold_case(left) == fold_case(right)


def clean_keys(df: DataFrame, *names: str) -> DataFrame:
    """Right-trim the named key columns once at load, so later joins compare plain values."""
    return df.withColumns({name: F.rtrim(F.col(name)) for name in names})


def is_digits(text: Column) -> Column:
    """True when no character other than 0-9 occurs; the empty text passes."""
    return text.rlike("^[0-9]*$")


def is_numeric(text: Column) -> Column:
    """True when the text parses as a number. Currency signs and thousands commas do not parse here."""
    return F.trim(text).try_cast("decimal(38,10)").isNotNull()


def drop_last_three(text: Column) -> Column:
    """Receipt id without its three-character suffix; ids of three or fewer characters become empty."""
    trimmed = F.rtrim(text)
    return F.left(trimmed, F.greatest(F.length(trimmed) - 3, F.lit(0)))


def filled(text: Column) -> Column:
    """Empty text as null."""
    return F.nullif(F.rtrim(text), F.lit(""))


def ean(isbn: Column, upc: Column) -> Column:
    """Title code: the ISBN, else the first 13 characters of the UPC, else null."""
    return F.coalesce(filled(isbn), filled(F.substring(upc, 1, 13)))


def joined(*parts: Column) -> Column:
    """Concatenation that skips nulls (plain ``concat`` turns the whole text null)."""
    return F.concat_ws("", *parts)


def list_test(text: Column, values) -> Column:
    """Membership in a fixed list, ignoring trailing blanks."""
    return F.rtrim(text).isin(*values)
