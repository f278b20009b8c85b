"""Packed label strings (``name-d;name-d;...``) as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def label_fields(categories: Column | str) -> Column:
    """The packed string split on ``;``."""
    c = F.col(categories) if isinstance(categories, str) else categories
    return F.split(c, ";")


def label_name(field: Column) -> Column:
    """A field's name = the field with every digit and hyphen removed."""
    return F.regexp_replace(field, "[-0-9]", "")


def label_value(field: Column) -> Column:
    """A field's value = its last character as INT; malformed -> NULL."""
    return F.substring(field, -1, 1).try_cast("int")


def label_at(categories: Column | str, position: int) -> Column:
    """Value of the field at 0-based ``position``; missing field -> NULL."""
    return label_value(F.try_element_at(label_fields(categories), F.lit(position + 1)))


def label_names(categories: Column | str) -> Column:
    """All field names of one packed string, in order."""
    return F.transform(label_fields(categories), label_name)
