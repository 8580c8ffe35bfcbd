"""Dates from text and spreadsheet serials, periods."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_moment(c: Column | str, compact: bool = True) -> Column:
    """Timestamp of a text or serial day number: serials 1 to 99,999 up to the year 2100, fractions cut off; dd/MM/yyyy and
    yyyy-MM-dd, with or without a time of day; yyyyMMdd if compact. Anything else is null."""
    t = F.nullif(F.trim((F.col(c) if isinstance(c, str) else c).cast("string")), F.lit(""))
    number = t.try_cast("double")
    serial = F.when((number > 0) & (number < 100000), F.date_add(F.lit("1899-12-30").cast("date"), F.floor(number).cast("int")))
    serial = F.when(serial <= F.lit("2100-12-31").cast("date"), serial).cast("timestamp")
    forms = [
        (r"^\d{2}/\d{2}/\d{4}$", "dd/MM/yyyy"),
        (r"^\d{2}/\d{2}/\d{4} \d{2}:\d{2}:\d{2}$", "dd/MM/yyyy HH:mm:ss"),
        (r"^\d{4}-\d{2}-\d{2}$", "yyyy-MM-dd"),
        (r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$", "yyyy-MM-dd HH:mm:ss"),
    ] + ([(r"^(19|20)\d{6}$", "yyyyMMdd")] if compact else [])
    return F.coalesce(serial, *[F.when(t.rlike(rx), F.try_to_timestamp(t, F.lit(f))) for rx, f in forms])


def period_of_file(name: Column) -> tuple[Column, Column]:
    """(mois, annee) of a name MM_YYYY...; both null unless 1-12 and 1900-2100."""
    mm = F.regexp_extract(name, r"^(\d{2})_(\d{4})", 1).try_cast("int")
    yy = F.regexp_extract(name, r"^(\d{2})_(\d{4})", 2).try_cast("int")
    ok = mm.between(1, 12) & yy.between(1900, 2100)
    return F.when(ok, mm), F.when(ok, yy)


def period(annee: Column, mois: Column) -> Column:
    """YYYY_MM, null if either is."""
    return F.when(annee.isNotNull() & mois.isNotNull(), F.format_string("%d_%02d", annee.cast("int"), mois.cast("int")))


def file_period(annee: Column, mois: Column) -> Column:
    return F.format_string("%02d_%04d", mois.cast("int"), annee.cast("int"))


def quarter(mois: Column) -> Column:
    return F.ceil(mois / 3).cast("int")


def half(mois: Column) -> Column:
    return F.ceil(mois / 6).cast("int")


def number_of_period(annee: Column, mois: Column) -> Column:
    return annee * 12 + mois
