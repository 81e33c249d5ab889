"""The registered queries, each with the DuckDB SQL that gives the same rows."""

from __future__ import annotations

from kpitide.plans import arrays, offsets, recharge, streams, words
from kpitide.plans.registry import Query

QUERIES: dict[str, Query] = {}
for _module in (recharge, offsets, words, arrays, streams):
    QUERIES.update(_module.QUERIES)
