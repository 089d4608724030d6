"""Text standardisation as built-in column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns, labels, lengths and messages that decide the results.
HOMEPAGE_ODD_CHARACTER = r"[^a-zA-Z0-9\s.\-_/:@#%&+=]"
LOCAL_POSTAL = r"\A(\d{5}|\d{5}-\d{4})\z"
NATIONAL_POSTAL = r"\A\d{3}-\d{3}\z"
PHONE_DIGITS = 10
MIN_NAME_LENGTH = 5
REASON_NULL = "Product name cannot be NULL"
REASON_SHORT = "Product name must be at least 5 characters long (after trimming)"
REASON_START = "Product name must start with an uppercase letter (A-Z)"
REASON_LETTER = "Product name must contain at least one letter"


def has_odd_character(homepage: Column) -> Column:
    """True where a home page holds a character outside the plain Latin set; null stays null."""
    return homepage.rlike(HOMEPAGE_ODD_CHARACTER)


def drop_first_separator(phone: Column) -> Column:
    """Remove only the first non-digit: the literal reading of a replace without a global flag."""
    return F.regexp_replace(phone, r"\A([0-9]*)[^0-9]", "$1")


def drop_all_separators(phone: Column) -> Column:
    return F.regexp_replace(phone, "[^0-9]", "")


def us_phone(digits: Column) -> Column:
    """(XXX) XXX-XXXX from the last ten characters, right-padded with zeros when shorter."""
    ten = F.when(F.length(digits) > PHONE_DIGITS, F.right(digits, F.lit(PHONE_DIGITS))).otherwise(
        F.rpad(digits, PHONE_DIGITS, "0")
    )
    return F.concat(
        F.lit("("), F.substring(ten, 1, 3), F.lit(") "),
        F.substring(ten, 4, 3), F.lit("-"), F.substring(ten, 7, 4),
    )


def postal_class(postal_code: Column) -> Column:
    """Unknown, Local, National or International. Only spaces count as blank; a tab does not."""
    code = F.upper(F.regexp_replace(postal_code, r"\s", ""))
    return (
        F.when(postal_code.isNull() | (F.trim(postal_code) == ""), "Unknown")
        .when(code.rlike(LOCAL_POSTAL), "Local")
        .when(code.rlike(NATIONAL_POSTAL), "National")
        .otherwise("International")
    )


def name_rejection(name: Column) -> Column:
    """First failed naming rule, or null for a name that passes."""
    trimmed = F.trim(name)
    return (
        F.when(name.isNull(), REASON_NULL)
        .when(F.length(trimmed) < MIN_NAME_LENGTH, REASON_SHORT)
        .when(~trimmed.rlike(r"\A[A-Z]"), REASON_START)
        .when(~trimmed.rlike("[A-Za-z]"), REASON_LETTER)
    )
