"""Number parsing, rounding and tolerance as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Scales of printed units.
SCALES = {"million": 1_000_000, "thousand": 1_000}

# Digits that a reader confuses with each other, both ways.
CONFUSIONS = (("0", "8"), ("0", "6"), ("0", "9"), ("1", "7"), ("1", "4"), ("2", "7"), ("3", "5"), ("3", "8"), ("4", "9"), ("5", "6"), ("5", "8"), ("6", "8"), ("8", "9"))


def round_up_half(value: Column, places: int = 4) -> Column:
    """Half-up toward plus infinity: floor(x * 10^p + 0.5) / 10^p."""
    k = F.lit(float(10**places))
    return F.floor(value * k + F.lit(0.5)) / k


def round_decimal(value: Column, places: int = 4) -> Column:
    """Rounding of the decimal string of the binary value."""
    return F.format_string(f"%.{places}f", value).try_cast("double")  # "null" is none


def finite(value: Column) -> Column:
    """Null where the value is not a finite number."""
    return F.when(F.abs(value) < F.lit(float("inf")), value)  # a NaN is greater than all


def ratio(a: Column, b: Column) -> Column:
    """a / b; null if a side is null or b is zero."""
    return F.try_divide(a.cast("double"), b.cast("double"))


def percent(a: Column, b: Column) -> Column:
    return F.lit(100.0) * ratio(a, b)


def sum_present(*values: Column, at_least: int = 1) -> Column:
    """Sum of the values that are there; null if fewer than ``at_least`` are."""
    count = sum((F.when(v.isNotNull(), 1).otherwise(0) for v in values), F.lit(0))
    total = sum((F.coalesce(v, F.lit(0.0)) for v in values), F.lit(0.0))
    return F.when(count >= at_least, total)


def _trimmed(text: Column) -> Column:
    text = F.translate(text, "−–—‒ ", "---- ")
    text = F.regexp_replace(text, r"(?U)\s+", "")
    text = F.regexp_replace(text, r"^[|_'`~*.,:]+|[|_'`~*:]+$", "")
    return F.regexp_replace(text, r"(?<=[0-9]);(?=[0-9]{3}(?![0-9]))", ",")


_SHAPE = r"^[(\[{-]?-?[0-9]{1,3}(,[0-9]{2,3})*(\.[0-9]+)?[)\]}]?$|^[(\[{-]?-?[0-9]+(\.[0-9]+)?[)\]}]?$|^[(\[{-]?\.[0-9]+[)\]}]?$"


def figure(text: Column) -> Column:
    """Printed figure to number: dash or Nil is 0, brackets or a leading minus negate, anything else unreadable is null."""

    def parsed(t: Column) -> Column:
        digits = F.regexp_replace(t, r"[^0-9.]", "")
        negative = t.rlike(r"[()\[\]{}]|^-")
        value = F.when(t.rlike(r"^-+$") | F.lower(t).isin("nil", "-nil-"), F.lit(0.0)).when(t.rlike(_SHAPE), digits.try_cast("double"))
        return F.transform(F.array(value), lambda v: F.when(negative & (v != 0), -v).otherwise(v))[0]

    # digits alone, or in groups of three, need no more than a cast; a letter that Nil lacks makes a text no figure
    plain = text.rlike(r"^(?:[0-9]+|[0-9]{1,3}(?:,[0-9]{3})+)\z")
    words = text.rlike("[A-HJKMO-Za-hjkmo-z]")
    two = F.regexp_count(F.trim(text), F.lit(r"[0-9)]\s+[(0-9]")) > 0
    # the trimmed text is bound once: as a plain expression it would be evaluated at each of its uses
    return F.when(plain, F.replace(text, F.lit(","), F.lit("")).try_cast("double")).when(text == "-", F.lit(0.0)).when(~words & ~two, F.transform(F.array(_trimmed(text)), parsed)[0])


def nth_from_right(text: Column, n: int) -> Column:
    """The n-th number from the right of a line, commas dropped."""
    found = F.regexp_extract_all(text, F.lit(r"-?[0-9][0-9,]*(?:\.[0-9]+)?"), F.lit(0))
    return F.regexp_replace(F.try_element_at(found, F.lit(-n)), ",", "").try_cast("double")


def unit_scale(text: Column) -> Column:
    """1,000,000, 1,000 or, for a header that names the currency alone, 1; null if no unit is printed."""
    t = F.lower(text)
    return (
        F.when(t.rlike(r"(rupees|rs\.?|pkr)[^a-z]{0,6}(in )?million|in millions?|million rupees"), SCALES["million"])
        .when(t.rlike(r"(rupees|rs\.?|pkr)[^a-z]{0,6}(in )?('?000|thousand)|in thousands?|000s|'000'?"), SCALES["thousand"])
        .when(t.rlike(r"^\W*(rupees|rs\.?|pkr)\W*$"), 1)
    )


def tolerance(terms: Column, largest_scale: Column, per_share: Column | None = None) -> Column:
    """Half a unit for each term and half of the largest scale; 0.005 each for figures per share."""
    usual = F.lit(0.5) * terms + F.lit(0.5) * largest_scale
    return usual if per_share is None else F.when(per_share, F.lit(0.005) * terms + F.lit(0.005)).otherwise(usual)


def misreadings(text: Column) -> Column:
    """Array of what a printed figure may have been: a digit confused, the sign lost, a digit dropped or doubled, neighbours swapped, comma for point."""
    at = F.sequence(F.lit(1), F.length(text))
    # for each digit the digits it is confused with, in one string
    confusion = {str(d): "".join(b if a == str(d) else a for a, b in CONFUSIONS if str(d) in (a, b)) for d in range(10)}
    confusion = F.create_map(*[F.split(F.lit(x), "") if i % 2 else F.lit(x) for of in confusion.items() for i, x in enumerate(of)])
    nothing = F.array().cast("array<string>")
    head = lambda i: F.substr(text, F.lit(1), i - 1)
    char = lambda i: F.substr(text, i, F.lit(1))
    tail = lambda i, n=1: F.substr(text, i + n)
    confused = F.flatten(F.transform(at, lambda i: F.transform(F.coalesce(F.try_element_at(confusion, char(i)), nothing), lambda c: F.concat(head(i), c, tail(i)))))
    dropped = F.transform(F.filter(at, lambda i: char(i).rlike("[0-9]")), lambda i: F.concat(head(i), tail(i)))
    digits = F.array(*[F.lit(str(d)) for d in range(10)])
    extra = F.flatten(F.transform(at, lambda i: F.transform(digits, lambda d: F.concat(head(i), d, char(i), tail(i)))))
    swapped = F.transform(F.filter(at, lambda i: F.substr(text, i, F.lit(2)).rlike("^[0-9]{2}$")), lambda i: F.concat(head(i), char(i + 1), char(i), tail(i, 2)))
    sign = F.array(F.when(text.rlike(r"[()-]"), F.regexp_replace(text, r"[()-]", "")).otherwise(F.concat(F.lit("("), text, F.lit(")"))))
    points = F.array(F.regexp_replace(text, r"\.", ","), F.regexp_replace(text, r",([0-9]+)$", ".$1"))
    return F.array_except(F.concat(confused, sign, dropped, extra, swapped, points), F.array(text))  # each once


#: Powers of ten that a bigint holds, and by how much the digits change that a digit is confused with, in the order of ``misreadings``.
_POWERS = [10**k for k in range(19)]
_CHANGES = [[int(b if a == str(d) else a) - d for a, b in CONFUSIONS if str(d) in (a, b)] for d in range(10)]
MOST_DIGITS = 15


def misread_numbers(v: Column, n: Column) -> Column:
    """Array of the numbers that ``misreadings`` of ``n`` digits alone print, in their order; ``v`` is what the digits print, a bigint.  At most ``MOST_DIGITS``."""
    div = lambda a, b: F.call_function("div", a, b)
    long = lambda x: F.lit(x).cast("long")
    powers, changes = F.array(*map(long, _POWERS)), F.array(*[F.array(*map(long, of)) for of in _CHANGES])
    ones = F.reverse(F.slice(powers, F.lit(1), n))
    tens = F.reverse(F.slice(powers, F.lit(2), F.greatest(n - 1, F.lit(0))))
    digit = lambda w: div(v % (w * 10), w)
    left = lambda w: v - v % (w * 10)
    confused = F.flatten(F.transform(ones, lambda w: F.transform(F.get(changes, digit(w).cast("int")), lambda c: v + c * w)))
    dropped = F.transform(F.when(n > 1, ones).otherwise(F.slice(ones, 1, 0)), lambda w: div(left(w), long(10)) + v % w)
    extra = F.flatten(F.transform(ones, lambda w: F.sequence(left(w) * 10 + v % (w * 10), left(w) * 10 + v % (w * 10) + w * 90, w * 10)))
    swapped = F.transform(tens, lambda w: v + (digit(div(w, long(10))) - digit(w)) * (w - div(w, long(10))))
    return F.concat(confused, F.array(-v), dropped, extra, swapped)
