"""Every registered query with its check SQL."""

from __future__ import annotations

from waymark.plans import filters, graphs, shapes, stored

QUERIES = {**filters.QUERIES, **shapes.QUERIES, **graphs.QUERIES, **stored.QUERIES}
ORACLES = {**filters.ORACLES, **shapes.ORACLES, **graphs.ORACLES, **stored.ORACLES}
