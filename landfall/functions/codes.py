"""Decoding of coded columns and of code-book labels."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Code meanings that results must carry.
TRAVEL_MODES = {1: "Air", 2: "Sea", 3: "Land"}
OTHER_TRAVEL_MODE = "Not Reported"
VISA_CATEGORIES = {1: "Business", 2: "Pleasure", 3: "Student"}
OTHER_VISA_CATEGORY = "Unknown"
NOT_REPORTED_MODE = 9
OTHER_STATE = "All Other Codes"

# Words that open a country label which is not a country.
COUNTRY_CLASSES = {
    "INVALID": "INVALID",
    "Collapsed": "Collapsed",
    "No Country Code": "No Country Code",
}

# Words that open a port label which is not a place.
NOT_A_PLACE = ("Collapsed ", "No PORT Code")


def _decode(code: Column, names: dict[int, str], other: str) -> Column:
    chain = F
    for number, name in names.items():
        chain = chain.when(code == number, name)
    return chain.otherwise(other)


def travel_mode(col: str) -> Column:
    return _decode(F.col(col), TRAVEL_MODES, OTHER_TRAVEL_MODE)


def visa_category(col: str) -> Column:
    return _decode(F.col(col), VISA_CATEGORIES, OTHER_VISA_CATEGORY)


def travel_mode_status(col: str) -> Column:
    """Tells the three reasons apart for which a travel mode reads "Not Reported"."""
    code = F.col(col)
    return (
        F.when(code.isNull(), "missing")
        .when(code.isin(list(TRAVEL_MODES)), "reported")
        .when(code == NOT_REPORTED_MODE, "not reported")
        .otherwise("other code")
    )


def whole_code(col: str) -> Column:
    """A code stored as floating point, as an int; null when it is not a whole number."""
    code = F.col(col)
    return F.when(F.rint(code) == code, code.try_cast("int"))


def country_class(label: str) -> Column:
    """valid, INVALID, Collapsed or No Country Code, read from the label's opening words."""
    text = F.trim(F.col(label))
    chain = F
    for opening, name in COUNTRY_CLASSES.items():
        chain = chain.when(text.startswith(opening), name)
    return chain.when(text.isNotNull(), "valid")


# `key = 'label'`, with an unquoted number or quoted text as key and '' as escaped quote.
_LABEL_LINE = r"(?s)^\s*(?:'([^']*)'|(\d+))\s*=\s*'([^']*(?:''[^']*)*)'.*$"
_MARK = "\u0001"


def is_label(line: str) -> Column:
    return F.col(line).rlike(_LABEL_LINE)


def label_parts(line: str) -> Column:
    """Key and label text of a label line, found by one match: read them with the next two."""
    return F.split(F.regexp_replace(F.col(line), _LABEL_LINE, f"$1$2{_MARK}$3"), _MARK, 2)


def label_code(parts: str) -> Column:
    """Trimmed key."""
    return F.trim(F.get(F.col(parts), F.lit(0)))


def label_text(parts: str) -> Column:
    """Label with quotes unescaped and padding kept."""
    return F.replace(F.get(F.col(parts), F.lit(1)), F.lit("''"), F.lit("'"))


# Remarks that may follow the state: `(BPS)`, `#ARPT`.
_REMARKS = r"\s*(?:\([^)]*\)|#\w+)\s*$"
_PLACE = r"^(.*?)(?:\s*,\s*|\s+)([A-Z]{2})$"


def port_place(label: str) -> Column:
    """Port label without padding and without the remarks after the state.

    Null for a collapsed or missing port, whose label names no place.
    """
    text = F.trim(F.col(label))
    named = reduce(lambda a, b: a & b, [~text.startswith(opening) for opening in NOT_A_PLACE])
    return F.when(named, F.trim(F.regexp_replace(text, _REMARKS, "")))


def port_parts(place: str) -> Column:
    """City and the two capitals that end a place; the capitals are missing if there are none."""
    return F.split(F.regexp_replace(F.col(place), _PLACE, f"$1{_MARK}$2"), _MARK, 2)


_ALIAS = r"^Collapsed (?:\(|into )(\w+)"


def port_alias_target(label: str) -> Column:
    """Code that a collapsed port points to; null for all other ports."""
    text = F.trim(F.col(label))
    return F.when(
        text.startswith("Collapsed "), F.nullif(F.regexp_extract(text, _ALIAS, 1), F.lit(""))
    )
