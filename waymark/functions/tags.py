"""Predicates and expressions on the ``tags`` map and the feature type."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from waymark.schema import NODE, RELATION, WAY


def tag(key: str, tags="tags") -> Column:
    """The tag's value as text, NULL when the key is missing."""
    return F.col(tags)[key]


def tag_equals(key: str, value: str, tags="tags") -> Column:
    return tag(key, tags) == F.lit(value)


def tag_in(key: str, values: Iterable[str], tags="tags") -> Column:
    return tag(key, tags).isin(list(values))


def tag_exists(key: str, tags="tags") -> Column:
    return F.map_contains_key(F.col(tags), key)


def tag_not_null(key: str, tags="tags") -> Column:
    return tag(key, tags).isNotNull()


def tags_contain(wanted: Mapping[str, str], tags="tags") -> Column:
    """True where the tags hold every given pair."""
    tests = [F.coalesce(tag_equals(k, v, tags), F.lit(False)) for k, v in wanted.items()]
    return reduce(lambda a, b: a & b, tests, F.lit(True))


def selector(types: str, *tests: Column) -> Column:
    """One reusable predicate: type letters OR-ed, then every tag test AND-ed.

    n = node, w = way that is no area, a = area (way or relation),
    r = relation that is no area, * = everything.
    """
    letters = {
        "n": F.col("type") == NODE,
        "w": (F.col("type") == WAY) & ~F.col("is_area"),
        "a": F.col("is_area"),
        "r": (F.col("type") == RELATION) & ~F.col("is_area"),
        "*": F.lit(True),
    }
    unknown = sorted(set(types) - set(letters))
    if unknown or not types:
        raise ValueError(f"selector types must be letters of 'nwar*', got {types!r}")
    kinds = reduce(lambda a, b: a | b, [letters[c] for c in dict.fromkeys(types)])
    return reduce(lambda a, b: a & b, tests, kinds)


def type_name(type_code="type") -> Column:
    code = F.col(type_code) if isinstance(type_code, str) else type_code
    return (F.when(code == NODE, "node").when(code == WAY, "way")
            .when(code == RELATION, "relation").otherwise("unknown"))


def type_label(type_code="type") -> Column:
    code = F.col(type_code)
    return F.when(code == NODE, "Node").when(code == WAY, "Way").when(code == RELATION, "Relation")


def shape_label(is_area="is_area") -> Column:
    return F.when(F.col(is_area), "Area").otherwise("Linear")


def tags_json(tags="tags") -> Column:
    """Canonical JSON text: keys ordered by byte length, then bytes."""
    def order(a, b):
        by_length = F.octet_length(a["key"]) - F.octet_length(b["key"])
        by_bytes = F.when(a["key"] < b["key"], -1).when(a["key"] > b["key"], 1).otherwise(0)
        return F.when(by_length != 0, by_length).otherwise(by_bytes)

    entries = F.array_sort(F.map_entries(F.col(tags)), order)
    return F.to_json(F.map_from_entries(entries))
