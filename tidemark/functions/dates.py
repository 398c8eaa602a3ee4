"""Dates of a published dataset."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .decode import trimmed

NEVER = 2**31 - 1

# The marks of a dataset date in a page.
LAYER_MARK = r"Navigator_AllSites_([0-9]{6})_"
UPDATE_MARK = r"Last update:\s*([0-9]{2}-[0-9]{2}-[0-9]{4})"


def normalize_date(c: Column) -> Column:
    """ISO dates and MMDDYY of this century, blanks around them aside; impossible dates are null."""
    c = trimmed(c)
    iso = F.when(c.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"), F.try_to_timestamp(c, F.lit("yyyy-MM-dd")))
    short = F.when(c.rlike(r"^[0-9]{6}$"), F.try_to_timestamp(F.concat(F.lit("20"), F.substring(c, 5, 2), F.lit("-"), F.substring(c, 1, 2), F.lit("-"), F.substring(c, 3, 2)), F.lit("yyyy-MM-dd")))
    return F.coalesce(iso, short).cast("date")


def page_date(html: Column) -> Column:
    """The newest dataset date that a page names: in layer names and after 'Last update:'; null if none."""
    layers = F.regexp_extract_all(html, F.lit(LAYER_MARK), F.lit(1))
    marks = F.regexp_extract_all(html, F.lit(UPDATE_MARK), F.lit(1))
    iso = F.transform(marks, lambda s: F.concat(F.substring(s, 7, 4), F.lit("-"), F.substring(s, 1, 5)))
    return F.array_max(F.transform(F.concat(layers, iso), normalize_date))


def is_newer(upstream: Column, published: Column) -> Column:
    return F.when(upstream.isNull(), False).when(published.isNull(), True).otherwise(upstream > published)


def days_between(start: Column, end: Column) -> Column:
    """Whole days; without a start the baseline is infinitely old."""
    return F.coalesce(F.datediff(end, start), F.lit(NEVER))
