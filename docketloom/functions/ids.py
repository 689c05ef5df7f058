"""Case numbers ``IMM-<sequence>-<yy>``, years and file names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def format_number(sequence: Column | str, year: Column | int) -> Column:
    """``IMM-<sequence>-<yy>``; the sequence is not padded."""
    return F.format_string("IMM-%d-%02d", _c(sequence).cast("long"), ((year if isinstance(year, Column) else F.lit(year)) % 100).cast("int"))


def sequence_of(case_id: Column | str) -> Column:
    """The sequence of a three-part number that starts with IMM, else null."""
    return F.regexp_extract(_c(case_id), r"^IMM-(\d+)-[^-]*$", 1).try_cast("long")


def suffix_year(case_id: Column | str) -> Column:
    """The year a number ends in: four digits as they are, two digits after 2000, else null."""
    c = _c(case_id)
    four, two = F.regexp_extract(c, r"-(\d{4})$", 1).try_cast("int"), F.regexp_extract(c, r"-(\d{2})$", 1).try_cast("int")
    return F.coalesce(four, two + 2000)


def strict_year(case_id: Column | str) -> Column:
    """The year of a well-formed ``IMM-<digits>-<yy>``, else null."""
    return F.regexp_extract(_c(case_id), r"^IMM-\d+-(\d{2})$", 1).try_cast("int") + 2000


def year_of(value: Column | str) -> Column:
    """The year of a date, time or text that starts with one, else null."""
    return F.substring(_c(value).cast("string"), 1, 4).try_cast("int")


def like_year(case_id: Column | str, year: int) -> Column:
    """Whether the number's last two digits are the year's. Years a century apart are not told apart."""
    return _c(case_id).like(f"IMM-%-{year % 100:02d}")


def safe_name(name: Column | str) -> Column:
    """A file name: runs of unsafe characters become one dash, dashes and underscores at the ends go; ``case`` if nothing is left."""
    s = F.regexp_replace(F.trim(F.coalesce(_c(name), F.lit(""))), r"[^A-Za-z0-9._-]+", "-")
    s = F.regexp_replace(F.regexp_replace(s, r"-{2,}", "-"), r"^[-_]+|[-_]+$", "")
    return F.coalesce(F.nullif(s, F.lit("")), F.lit("case"))


def plain_name(name: Column | str) -> Column:
    """A file name: each unsafe character becomes an underscore."""
    return F.regexp_replace(_c(name), r"[^A-Za-z0-9._-]", "_")


def path_safe(case_id: Column | str) -> Column:
    return F.replace(_c(case_id), F.lit("/"), F.lit("_"))


def export_year(case_id: Column | str, filing: Column | str, scraped: Column | str, today: Column) -> Column:
    """The year folder of a case: of its number, else of its filing or scraping date, else today's."""
    return F.coalesce(strict_year(case_id), year_of(filing), year_of(scraped), F.year(today))


def file_stem(case_id: Column | str, filing: Column | str, scraped: Column | str, today: Column) -> Column:
    """``<id>-<yyyymmdd>``; the date is the first of the year if the number gave it."""
    year, known = strict_year(case_id), F.coalesce(_c(filing).cast("date"), _c(scraped).cast("date"), today)
    day = F.when(year.isNotNull(), F.format_string("%d0101", year)).otherwise(F.date_format(known, "yyyyMMdd"))
    return F.concat(plain_name(case_id), F.lit("-"), day)


def stamp(at: Column) -> Column:
    """``yyyymmdd_hhmmss``."""
    return F.date_format(at, "yyyyMMdd_HHmmss")
