"""Identifiers: member keys, person ids and NPI validation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from claimloom.payer import PayerProfile

# Fixed value: the card-issuer prefix under which an NPI carries its Luhn check digit.
NPI_LUHN_PREFIX = "80840"
NPI_DIGITS = 10


def member_key(subscriber: str = "cursubid", member: str = "bcmbrnbr") -> Column:
    """Both halves glued without separator; NULL when either half is NULL."""
    return F.concat(F.col(subscriber), F.col(member))


def person_id(profile: PayerProfile, member: str | Column) -> Column:
    return F.concat(F.lit(profile.person_prefix), member)


def valid_npi(column: str | Column) -> Column:
    """The NPI reduced to its ten digits if its check digit holds, else NULL.

    Built from JVM expressions only, and without casting single digits, so that a short or
    malformed value can never raise under ANSI mode.
    """
    text = (F.col(column) if isinstance(column, str) else column).cast("string")
    digits = F.regexp_replace(text, "[^0-9]", "")
    check_holds = F.call_function("luhn_check", F.concat(F.lit(NPI_LUHN_PREFIX), digits))
    return F.when((F.length(digits) == NPI_DIGITS) & check_holds, digits)


def absent_or_valid(source: str, validated: str) -> Column:
    """True when there was no NPI or a valid one; false for any other value, '' included."""
    return F.col(source).isNull() | F.col(validated).isNotNull()
