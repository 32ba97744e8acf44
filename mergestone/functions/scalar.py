"""Scalar functions of the table model, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def duration_nanos(text: Column) -> Column:
    """``[-]HH:MM:SS[.fraction]`` as nanoseconds; hours may exceed a day. Null if it isn't one."""
    form = r"^(-?)(\d+):(\d{1,2}):(\d{1,2})(?:\.(\d{1,9}))?$"
    part = lambda i: F.regexp_extract(text, form, i)
    number = lambda c: F.coalesce(F.nullif(c, F.lit("")), F.lit("0")).cast("long")
    seconds = number(part(2)) * 3600 + number(part(3)) * 60 + number(part(4))
    nanos = seconds * 1_000_000_000 + number(F.rpad(part(5), 9, "0"))
    return F.when(text.rlike(form), F.when(part(1) == "-", -nanos).otherwise(nanos))


def xor(a: Column, b: Column) -> Column:
    """Exclusive or of conditions; null if either is."""
    return a != b


def parse_timestamp(text: Column, form: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    return F.try_to_timestamp(text, F.lit(form))


def format_timestamp(value: Column, form: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    return F.date_format(value, form)


def from_hex(text: Column) -> Column:
    """A hexadecimal literal's bytes as text."""
    return F.decode(F.unhex(F.regexp_replace(text, "^0[xX]", "")), "UTF-8")


def unsigned_long(value: Column) -> Column:
    """A long that holds an unsigned 64-bit pattern, as decimal(20,0)."""
    wide = value.cast("decimal(20,0)")
    return F.when(value < 0, wide + F.lit("18446744073709551616").cast("decimal(20,0)")).otherwise(wide).cast("decimal(20,0)")


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often it is named."""
    return F.transform(F.array(value), body)[0]


#: A number's sign, its digits before and after the point and its exponent.
_NUMBER = r"\A\s*+([+-]?)(?=\.?\d)0*+(\d*+)(?:\.(\d*+))?(?:[eE]([+-]?\d{1,9}))?\s*\z"


def wide_decimal(value: Column, precision: int, scale: int, column: str) -> Column:
    """Numbers, or text of them, as exact text of a DECIMAL with more digits than Spark's: rounded half up, with every
    digit of the scale. What is no number or out of range raises, with the column's name."""

    def raised(what: str) -> Column:
        return F.raise_error(F.lit(f"{what} for column {column}")).cast("string")

    def shown(minus: Column, number: Column) -> Column:
        """A number of at least a digit more than the scale, without its point."""
        return F.when(minus, F.concat(F.lit("-"), pointed(number))).otherwise(pointed(number))

    def pointed(number: Column) -> Column:
        whole = F.length(number) - scale
        return F.concat(number.substr(F.lit(1), whole), F.lit("."), number.substr(whole + 1, F.lit(scale))) if scale else number

    def rounded(digits: Column, kept: Column, minus: Column) -> Column:
        """kept: so many of the digits, which begin with none that is 0, are before the end of the scale."""
        number = F.concat(F.lit("0"), F.rpad(digits, F.greatest(F.least(kept, F.lit(precision + 1)), F.lit(0)), "0"))
        last = "[0-8]9*$"  # what changes if one is added
        more = lambda n: F.concat(F.regexp_replace(n, last, ""), F.translate(F.regexp_extract(n, last, 0), "0123456789", "1234567890"))
        number = F.when((kept >= 0) & (digits.substr(kept + 1, F.lit(1)) >= "5"), let(number, more)).otherwise(number)
        ended = lambda n: F.when(F.length(n) > precision, raised("value out of range")).otherwise(shown(minus & (n != ""), F.lpad(n, F.greatest(F.length(n), F.lit(scale + 1)), "0")))
        return let(F.ltrim(number, F.lit("0")), ended)

    def made(parts: Column) -> Column:
        sign, whole, after, exponent = (F.get(parts, i) for i in range(4))
        digits = F.ltrim(F.concat(whole, after), F.lit("0"))
        shift = F.when(exponent == "", 0).otherwise(exponent.cast("int")) - F.length(after) + scale
        kept = lambda d: F.when(d == "", 0).otherwise(F.length(d) + shift)
        plain = (whole != "") & (exponent == "") & (F.length(whole) <= precision - scale) & (F.length(after) <= scale)
        as_is = F.concat(F.when(sign == "-", "-").otherwise(""), whole, *[F.lit("."), F.rpad(after, scale, "0")][: 2 * bool(scale)])
        other = let(digits, lambda d: rounded(d, kept(d), sign == "-"))
        return F.when(F.size(parts) == 1, raised("not a number")).when(plain, as_is).otherwise(other)

    text = F.translate(value.cast("string"), ",", ";")  # so that only a number has commas afterwards
    return let(F.split(F.regexp_replace(text, _NUMBER, "$1,$2,$3,$4"), ","), made)
