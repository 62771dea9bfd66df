"""Turning raw document values into typed columns.

Raw values arrive as VARIANT so that *absent*, *null*, *string* and *number* stay apart.
All functions are null-safe expressions (no UDF) and never raise under ANSI mode.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The text forms accepted as whole and as real numbers (sign, digits that may be
# grouped with single underscores, surrounding blanks; exponents and inf/nan for reals).
WHOLE_TEXT = r"^\s*[+-]?[0-9]+(_[0-9]+)*\s*$"
REAL_TEXT = (
    r"(?i)^\s*[+-]?("
    r"([0-9]+(_[0-9]+)*\.?([0-9]+(_[0-9]+)*)?|\.[0-9]+(_[0-9]+)*)(e[+-]?[0-9]+(_[0-9]+)*)?"
    r"|inf|infinity|nan)\s*$"
)


def whole_from_text(text: Column) -> Column:
    """bigint of a text such as ``"015"`` or ``" +5 "``; null for anything else, or beyond 64 bits."""
    plain = F.replace(text, F.lit("_"), F.lit(""))
    return F.coalesce(text.try_cast("bigint"), F.when(text.rlike(WHOLE_TEXT), plain.try_cast("bigint")))


def real_from_text(text: Column) -> Column:
    """double of a numeric text; null for anything else.

    Texts with letters or underscores are checked first, as a cast alone would also take forms
    like ``1d``.
    """
    plain = F.replace(F.lower(F.trim(text)), F.lit("_"), F.lit(""))
    spelled = F.when(plain.contains("nan"), F.lit(float("nan"))).otherwise(plain.try_cast("double"))
    return F.when(~text.rlike("[A-Za-z_]"), text.try_cast("double")).when(
        text.rlike(REAL_TEXT), spelled
    )


def days_past_due_text(text: Column) -> Column:
    """Days past due from its text form; codes such as ``XXX`` or ``STD`` and null mean 0.

    Null for a whole number beyond 64 bits; the caller quarantines the document that holds it.
    """
    whole = whole_from_text(text)
    return F.when(whole.isNull() & text.rlike(WHOLE_TEXT), None).otherwise(
        F.coalesce(whole, F.lit(0).cast("bigint"))
    )


def _is_text(value: Column) -> Column:
    return F.schema_of_variant(value) == "STRING"


def _text(value: Column) -> Column:
    return F.try_variant_get(value, "$", "string")


def days_past_due(value: Column) -> Column:
    """Days past due from a VARIANT: text as above, numbers cut toward zero, true is 1.

    Null beyond 64 bits, as above.
    """
    number = F.try_variant_get(value, "$", "bigint")
    beyond = number.isNull() & (F.abs(F.try_variant_get(value, "$", "double")) >= float(2**63))
    cut = F.when(beyond, None).otherwise(F.coalesce(number, F.lit(0).cast("bigint")))
    return F.when(_is_text(value), days_past_due_text(_text(value))).otherwise(cut)


def amount(value: Column) -> Column:
    """Money amount from a VARIANT: 0.0 when the key is absent, **null when unusable**.

    An explicit JSON null, an object, an array or a non-numeric text is unusable; the caller
    quarantines the document that holds it.
    """
    return (
        F.when(value.isNull(), F.lit(0.0))
        .when(_is_text(value), real_from_text(_text(value)))
        .otherwise(F.try_variant_get(value, "$", "double"))
    )


# Forms of statement dates besides ISO, in the order they are tried, as a pattern of the text and
# the order of its groups that makes it ISO. A time of day may follow.
DATE_FORMS = (
    (r"^\s*(\d{4})[/.](\d{1,2})[/.](\d{1,2})(.*)$", "$1-$2-$3$4"),  # year, month, day
    (r"^\s*(\d{1,2})[/.-](\d{1,2})[/.-](\d{4})(.*)$", "$3-$1-$2$4"),  # month, day, year
    (r"^\s*(\d{1,2})[/.-](\d{1,2})[/.-](\d{4})(.*)$", "$3-$2-$1$4"),  # day, month, year
    (r"^\s*(\d{4})(\d{2})(\d{2})\s*$", "$1-$2-$3"),  # eight digits
)
NAMED_MONTH = r"^\s*(\d{1,2})[ -]([A-Za-z]{3})[a-z]*[ -](\d{4})(.*)$"  # tried last
MONTHS = "janfebmaraprmayjunjulaugsepoctnovdec"


def _named_month(text: Column) -> Column:
    """ISO form of a date such as ``05-Jan-2024``; null for an unknown month."""
    day, name, year, rest = (F.regexp_extract(text, NAMED_MONTH, i) for i in range(1, 5))
    place = F.position(F.lower(name), F.lit(MONTHS))
    month = F.when(place % 3 == 1, ((place + 2) / 3).cast("int").cast("string"))
    return F.when(text.rlike(NAMED_MONTH), F.concat(year, F.lit("-"), month, F.lit("-"), day, rest))


def _readings(text: Column) -> list[Column]:
    """The timestamp that each form reads in a text; null where the form does not fit."""
    forms = [F.when(text.rlike(p), F.regexp_replace(text, p, order)) for p, order in DATE_FORMS]
    return [timestamp(text), *[timestamp(F.trim(iso)) for iso in (*forms, _named_month(text))]]


def date_form(items: Column, field: str) -> Column:
    """Number of the first form that reads the first readable date of an array of items; null without one.

    ``05/01/2024`` fits two forms; the earlier one wins, unless the first readable date rules it out.
    """

    def fitting(text: Column) -> Column:
        return F.coalesce(*[F.when(read.isNotNull(), k) for k, read in enumerate(_readings(text))])

    return F.aggregate(
        items, F.lit(None).cast("int"), lambda found, item: F.coalesce(found, fitting(item[field]))
    )


def timestamp_of_form(text: Column, form: Column) -> Column:
    """Timestamp without zone of a text in the given form (see ``date_form``); null if it does not fit."""
    first, *others = _readings(text)
    read = F.when(form == 0, first)
    for k, other in enumerate(others, 1):
        read = read.when(form == k, other)
    return read


def timestamp(text: Column) -> Column:
    """Timestamp without zone from an ISO text; unparseable becomes null. Statement dates are local
    calendar dates, so the session's time zone must not shift them."""
    return text.try_cast("timestamp_ntz")


def known(value: Column) -> Column:
    """NaN as null, so that aggregates skip it like any missing value."""
    return F.when(~F.isnan(value), value)
