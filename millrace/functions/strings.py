"""Text functions as column expressions."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed patterns: ASCII punctuation, a dotted address, an amount of money.
PUNCTUATION = r"[!-/:-@\[-`{-~]"
DOTTED_ADDRESS = r"[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}"


def title_case(text: Column) -> Column:
    """Upper-case each run of letters at its start, also after a hyphen or digit."""
    runs = F.regexp_extract_all(text, F.lit(r"(\p{L}+|\P{L}+)"), 1)
    return F.array_join(F.transform(runs, F.initcap), "")


def capitalize(text: Column) -> Column:
    return F.concat(F.upper(F.substring(text, 1, 1)), F.lower(F.substring(text, 2, 2**31 - 1)))


def strip_chars(text: Column, chars: str) -> Column:
    return F.trim(text, F.lit(chars))


def find(text: Column, part: str) -> Column:
    """Position from 0, or -1 when absent."""
    return F.locate(part, text) - 1


def index_of(text: Column, part: str) -> Column:
    """Position from 0; an absent part is an error."""
    place = F.locate(part, text)
    return F.when(place > 0, place - 1).otherwise(F.raise_error(F.lit(f"substring not found: {part}")).cast("int"))


def count_of(text: Column, part: str) -> Column:
    """Number of non-overlapping occurrences."""
    gone = F.length(text) - F.length(F.replace(text, F.lit(part), F.lit("")))
    return (gone / len(part)).cast("int")


def is_digits(text: Column) -> Column:
    return text.rlike("^[0-9]+$")


def is_alnum(text: Column) -> Column:
    return text.rlike(r"^[\p{L}\p{N}]+$")


def words(text: Column) -> Column:
    """Split on runs of white space, without empty parts."""
    return F.regexp_extract_all(text, F.lit(r"(\S+)"), 1)


def split_max(text: Column, separator: str, splits: int) -> Column:
    """At most ``splits`` splits from the left; the rest stays together."""
    return F.split(text, "\\Q" + separator + "\\E", splits + 1)


def lines(text: Column) -> Column:
    return F.split(text, r"\r\n|\n|\r")


def mask(text: Column, pattern: str = DOTTED_ADDRESS, by: str = "[ip]") -> Column:
    return F.regexp_replace(text, pattern, by)


def compose(*steps: Callable[[Column], Column]) -> Callable[[Column], Column]:
    """Apply column functions from left to right."""
    return lambda column: reduce(lambda c, step: step(c), steps, column)


def drop_punctuation(text: Column) -> Column:
    return F.regexp_replace(text, PUNCTUATION, "")


normalize = compose(F.trim, F.lower, drop_punctuation)


def domain_class(address: Column, internal: Sequence[str], partners: Sequence[str]) -> Column:
    """Class of an address by the domain after its @."""
    domain = F.lower(F.split_part(address, F.lit("@"), F.lit(2)))
    return (
        F.when(address.isNull() | (F.locate("@", address) == 0), "invalid")
        .when(domain.isin(list(internal)), "internal")
        .when(domain.isin(list(partners)), "external_partner")
        .otherwise("unknown")
    )


def money_text(amount: Column) -> Column:
    return F.concat(F.lit("$"), F.format_number(amount, 2))


def clean_price(text: Column) -> Column:
    """Struct of the amount and an error: $ and commas go, (12.00) is negative."""
    plain = F.regexp_replace(F.trim(text), r"[$,\s]", "")
    inner = F.regexp_extract(plain, r"^\((.*)\)$", 1)
    negative = plain.rlike(r"^\(.*\)$")
    digits = F.when(negative, inner).otherwise(plain)
    amount = F.when(digits.rlike(r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)$"), digits.try_cast("double"))
    value = F.when(negative, -amount).otherwise(amount)
    error = F.when(text.isNull(), "price is missing").when(
        value.isNull(), F.concat(F.lit("cannot parse price: "), text)
    )
    return F.struct(value.alias("amount"), error.alias("error"))
