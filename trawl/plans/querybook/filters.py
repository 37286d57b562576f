"""Registered filters: each predicate over the whole element or event table."""

from __future__ import annotations

from pyspark.sql import functions as F

from trawl.functions import filters as f
from trawl.functions.filters import column, combine
from trawl.plans.querybook import sql
from trawl.plans.querybook.registry import register
from trawl.sources import corpus as c

LANG = "json_extract_string(metadata, '$.lang')"
SOURCE = "json_extract_string(metadata, '$.source')"
TITLE = "json_extract_string(metadata, '$.title')"
SIZE = "TRY_CAST(json_extract_string(metadata, '$.n_chars') AS DOUBLE)"

# name -> (filter, SQL condition).  Pages have no lang, source or n_chars and
# chunks no title, so every predicate meets missing keys.
ON_ELEMENTS = {
    "filter_eq": (f.Eq("lang", "en"), f"coalesce({LANG} = 'en', false)"),
    "filter_ne": (f.Ne("lang", "en"), f"NOT coalesce({LANG} = 'en', false)"),
    "filter_gt": (f.Gt("n_chars", 500), f"{SIZE} > 500"),
    "filter_gte": (f.Gte("n_chars", 500), f"{SIZE} >= 500"),
    "filter_lt": (f.Lt("n_chars", 500), f"{SIZE} < 500"),
    "filter_lte": (f.Lte("n_chars", 500), f"{SIZE} <= 500"),
    "filter_in": (f.In("source", ["src1", "src2"]), f"{SOURCE} IN ('src1', 'src2')"),
    "filter_nin": (f.Nin("source", ["src1", "src2"]), f"{SOURCE} NOT IN ('src1', 'src2')"),
    "filter_contains": (f.Contains("title", "ent 1"), f"contains({TITLE}, 'ent 1')"),
    "filter_contains_ignore_case": (f.ContainsIgnoreCase("title", "DOCUMENT 2"), f"contains(lower({TITLE}), 'document 2')"),
    "filter_eq_ignore_case": (f.EqIgnoreCase("lang", "FR"), f"lower({LANG}) = 'fr'"),
    "filter_starts_with": (f.StartsWith("title", "Page"), f"starts_with({TITLE}, 'Page')"),
    "filter_ends_with": (f.EndsWith("title", "7"), f"ends_with({TITLE}, '7')"),
    "filter_like": (f.Like("title", r"\d{2}5$"), f"regexp_matches({TITLE}, '\\d{{2}}5$')"),
    "filter_and": (f.And([f.Eq("lang", "de"), f.Gt("n_chars", 1000)]), f"coalesce({LANG} = 'de', false) AND {SIZE} > 1000"),
    "filter_or": (
        f.Or([f.And([f.Eq("lang", "de"), f.Lt("n_chars", 300)]), f.And([f.Eq("lang", "es"), f.Gte("n_chars", 300)])]),
        f"({LANG} = 'de' AND {SIZE} < 300) OR ({LANG} = 'es' AND {SIZE} >= 300)",
    ),
    "filter_not": (f.Not(f.Gt("n_chars", 500)), f"NOT ({SIZE} > 500)"),
    "filter_has_any_label": (f.HasAnyLabel(["ContentRoot", "Section"]), "list_has_any(labels, ['ContentRoot', 'Section'])"),
}


def _on_elements(node):
    return lambda spark, sf: c.elements(spark, sf, embeddings=False).where(column(node)).select("id")


for _name, (_node, _condition) in ON_ELEMENTS.items():
    register(_name, _on_elements(_node), f"WITH {sql.ELEMENTS} SELECT id FROM elements WHERE {_condition}")


def _combined(spark, sf):
    keep = combine(f.Or([f.Eq("lang", "en"), f.Eq("lang", "fr")]), f.HasAnyLabel(["Chunk"]))
    return c.elements(spark, sf, embeddings=False).where(keep).select("id")


# The alternatives stay inside the label condition.
register(
    "filter_combined",
    _combined,
    f"WITH {sql.ELEMENTS} SELECT id FROM elements WHERE ({LANG} = 'en' OR {LANG} = 'fr') AND list_has_any(labels, ['Chunk'])",
)

ON_EVENTS = {
    "filter_events_eq_number": (f.Eq("k", 69), "TRY_CAST(json_extract_string(metadata, '$.k') AS DOUBLE) = 69"),
    "filter_events_eq_text": (f.Eq("k", "69"), "json_type(metadata, '$.k') = 'VARCHAR' AND json_extract_string(metadata, '$.k') = '69'"),
    "filter_events_nested": (
        f.And([f.Or([f.Lt("k", 10), f.Gte("k", 90)]), f.Not(f.Eq("k", 95)), f.HasAnyLabel(["error", "purchase"])]),
        "(CAST(json_extract_string(metadata, '$.k') AS DOUBLE) < 10 OR CAST(json_extract_string(metadata, '$.k') AS DOUBLE) >= 90)"
        " AND json_extract_string(metadata, '$.k') <> '95' AND list_has_any(labels, ['error', 'purchase'])",
    ),
}


def _on_events(node):
    return lambda spark, sf: c.event_elements(spark, sf).where(column(node)).select(
        "id", F.col("metadata").alias("props")
    )


for _name, (_node, _condition) in ON_EVENTS.items():
    register(
        _name, _on_events(_node),
        f"WITH {sql.EVENTS} SELECT id, metadata AS props FROM event_elements WHERE {_condition}",
    )
