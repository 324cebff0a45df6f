"""Queries on features stored in zones: any tag, any box, and what the catalog alone can answer."""

from __future__ import annotations

import uuid

from waymark.functions.geometry import envelope
from waymark.operators.features import BOUNDS
from waymark.operators.large_groups import shared_folder
from waymark.plans.filters import BOX
from waymark.plans.oracle import overlap, with_tables
from waymark.sources.derived import derived_tables
from waymark.sources.zones import read_zones, register_zones, stored_counts, stored_keys, write_zones

SMALL_BOX = (-9000000.0, -9000000.0, -3000000.0, -2000000.0)
#: Small zones, so that small tables have several, too.
ZONE_ROWS = 20_000
_written: dict[tuple[str, str], str] = {}


def stored(spark, path) -> str:
    """The folder with the features of ``path``, written once a session."""
    key = (spark.sparkContext.applicationId, path)
    if key not in _written:
        folder = f"{shared_folder(spark)}/zones-{uuid.uuid4().hex}"
        write_zones(derived_tables(spark, path), folder, zone_rows=ZONE_ROWS)
        _written[key] = folder
    return _written[key]


def _read(*keep, **tests):
    def run(spark, path):
        return read_zones(spark, stored(spark, path), **{k: f() for k, f in tests.items()}).select("fid", "type", *keep)
    return run


def _search(arguments):
    def run(spark, path):
        register_zones(spark, "stored", stored(spark, path))
        return spark.sql(f"SELECT fid, type, is_area FROM stored_search({arguments})")
    return run


def counts(spark, path):
    return stored_counts(spark, stored(spark, path)).select("type", "n", "areas", *BOUNDS)


def keys(spark, path):
    return stored_keys(spark, stored(spark, path))


_SIDES = ", ".join(f"{v!r}D" for v in SMALL_BOX)

QUERIES = {
    "q_stored_tag_eq": _read(tags=lambda: {"network": ["BUILDING"]}),
    "q_stored_tag_in": _read(tags=lambda: {"size": ["1", "7", "23"]}),
    "q_stored_tag_exists": _read(tags=lambda: {"building": None, "name": None}),
    "q_stored_bbox": _read(*BOUNDS, box=lambda: envelope(*BOX)),
    "q_stored_search": _search(f"'wa', 'building', 'yes', {_SIDES}"),
    "q_stored_search_box": _search(f"'*', NULL, NULL, {_SIDES}"),
    "q_stored_search_key": _search("'nr', 'name', NULL, NULL, NULL, NULL, NULL"),
    "q_stored_counts": counts,
    "q_stored_keys": keys,
}

_KEYS = ("name", "brand", "size", "amenity", "building", "highway", "leisure", "kind", "network")
_ALL = "features LEFT JOIN bounds USING (fid, type)"

ORACLES = {
    "q_stored_tag_eq": with_tables("SELECT fid, type FROM features WHERE network = 'BUILDING'", "features"),
    "q_stored_tag_in": with_tables("SELECT fid, type FROM features WHERE size IN ('1', '7', '23')", "features"),
    "q_stored_tag_exists": with_tables(
        "SELECT fid, type FROM features WHERE building IS NOT NULL AND name IS NOT NULL", "features"),
    "q_stored_bbox": with_tables(
        f"SELECT fid, type, xmin, ymin, xmax, ymax FROM bounds WHERE {overlap(*BOX)}", "bounds"),
    "q_stored_search": with_tables(
        f"""SELECT fid, type, is_area FROM {_ALL}
            WHERE type = 1 AND building = 'yes' AND {overlap(*SMALL_BOX)}""", "features", "bounds"),
    "q_stored_search_box": with_tables(
        f"SELECT fid, type, is_area FROM {_ALL} WHERE {overlap(*SMALL_BOX)}", "features", "bounds"),
    "q_stored_search_key": with_tables(
        "SELECT fid, type, is_area FROM features WHERE name IS NOT NULL AND type <> 1 AND NOT is_area", "features"),
    "q_stored_counts": with_tables(
        f"""SELECT type, count(*) AS n, CAST(count(*) FILTER (is_area) AS BIGINT) AS areas, min(xmin) AS xmin,
                   min(ymin) AS ymin, max(xmax) AS xmax, max(ymax) AS ymax
            FROM {_ALL} GROUP BY type""", "features", "bounds"),
    "q_stored_keys": with_tables(
        "SELECT key, CAST(count(*) AS BIGINT) AS n, CAST(count(DISTINCT value) AS BIGINT) AS n_values FROM ("
        + " UNION ALL ".join(f"SELECT '{'type' if c == 'kind' else c}' AS key, {c} AS value FROM features" for c in _KEYS)
        + ") WHERE value IS NOT NULL GROUP BY key", "features"),
}
