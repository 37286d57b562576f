"""Access to open-ended JSON attributes held as text.

Keys are literals, never path syntax, so any key is safe: one with a dot is
one name and a quote needs no escaping.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_map(json: Column) -> Column:
    """JSON object text as map<string,string>; blank or NULL gives no entries."""
    return F.coalesce(
        F.from_json(F.when(F.trim(json) != "", json), "map<string,string>"),
        F.create_map().cast("map<string,string>"),
    )


def text_value(json: Column, key: str) -> Column:
    """The value under ``key`` as text; NULL when missing or JSON null."""
    return F.try_element_at(F.from_json(json, "map<string,string>"), F.lit(key))


def typed_value(json: Column, key: str) -> Column:
    """The value under ``key`` with its JSON type, as VARIANT."""
    return F.try_element_at(F.from_json(json, "map<string,variant>"), F.lit(key))
