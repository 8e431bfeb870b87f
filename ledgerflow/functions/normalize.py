"""Names, employers, keys and amounts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerflow.schemas import CONDUIT_NAMES, FACTOR, MONEY, PART


def normalize_name(c: Column) -> Column:
    """Upper case, trimmed, a comma with the white space around it one space, runs of white space one space."""
    return F.regexp_replace(F.regexp_replace(F.trim(F.upper(c)), r"\s*,\s*", " "), r"\s+", " ")


def normalize_employer(c: Column) -> Column:
    """Upper case, trimmed, without commas and full stops, runs of white space one space."""
    return F.regexp_replace(F.regexp_replace(F.trim(F.upper(c)), r"[,.]", ""), r"\s+", " ")


def key_of(*parts: Column) -> Column:
    return F.substring(F.sha2(F.concat_ws("|", *parts), 256), 1, 16)


def donor_key(name: Column, employer: Column) -> Column:
    return key_of(normalize_name(name), normalize_employer(employer))


def employer_key(employer: Column) -> Column:
    return key_of(normalize_employer(employer))


def employer_or_default(c: Column) -> Column:
    return F.when(F.coalesce(c, F.lit("")) == "", F.lit("NOT EMPLOYED")).otherwise(c)


def amount(c: Column) -> Column:
    """A raw amount: empty counts as 0, what is not a number as null (a cast alone would accept '1d')."""
    text = F.trim(c)
    number = text.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$")
    return F.when(text == "", F.lit(0).cast(MONEY)).when(number, text.try_cast("double").try_cast(MONEY))


def conduit_name(c: Column) -> Column:
    """The name patterns of pass-along platforms."""
    return F.coalesce(F.upper(c).rlike("|".join(CONDUIT_NAMES)), F.lit(False))


def identifier_key(c: Column) -> Column:
    """The key in an identifier like committees/C1; a bare key stands for itself."""
    return F.element_at(F.split(c, "/"), -1)


def identifier_collection(c: Column) -> Column:
    """The collection in such an identifier, null for a bare key."""
    return F.when(c.contains("/"), F.element_at(F.split(c, "/"), 1))


def part_of(amount_: Column, factor: Column) -> Column:
    """A share of an amount, as a decimal, so that sums of shares do not depend on their order."""
    return amount_.cast(PART) * F.round(factor, 12).cast(FACTOR)


def percent(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, F.round(part.cast("double") / whole.cast("double") * 100, 1)).otherwise(F.lit(0.0))


#: What is taken out of a committee's name, in this order.
COMPANY_SUFFIXES = [
    " POLITICAL ACTION COMMITTEE", " PAC", " EMPLOYEE FEDERAL POLITICAL ACTION COMMITTEE", " EMPLOYEES POLITICAL ACTION COMMITTEE",
    " GOOD GOVERNMENT FUND", " EMPLOYEES' PAC", ", INC.", " INC.", " LLC", " CORPORATION", " CORP", " COMPANY", " CO.", " EMPLOYEES OF", " EMPLOYEES",
]


def extract_company(c: Column) -> Column:
    """The company in a committee's name: ordered removals anywhere in it, then trimmed and in upper case."""
    return F.upper(F.trim(reduce(lambda x, s: F.replace(x, F.lit(s), F.lit("")), COMPANY_SUFFIXES, c)))


def format_money(c: Column) -> Column:
    """$1.20B, $3.40M, $5.6K or $7 (presentation only)."""
    x = c.cast("double")
    return (
        F.when(F.abs(x) >= 1e9, F.format_string("$%.2fB", x / 1e9)).when(F.abs(x) >= 1e6, F.format_string("$%.2fM", x / 1e6))
        .when(F.abs(x) >= 1e3, F.format_string("$%.1fK", x / 1e3)).otherwise(F.format_string("$%.0f", x))
    )
