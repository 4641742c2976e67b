"""The registered queries over the driver tables, with the SQL that states each one's result where SQL can."""

from __future__ import annotations

from . import change_queries, model_queries, phrase_queries, review_queries, rule_queries, source_queries, text_queries, view_queries

QUERIES: dict = {}
ORACLES: dict = {}
for _module in (text_queries, model_queries, rule_queries, review_queries, phrase_queries, source_queries, view_queries, change_queries):
    QUERIES |= _module.QUERIES
    ORACLES |= _module.ORACLES

entry_query = QUERIES["search_folded"]
