"""Version-aware choices within and between rows. Comparisons keep SQL's three-valued logic: an element whose version or
key is null is dropped where it would have to win a comparison (`null_version` gives nulls a version instead)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _version(x: Column, null_version: float | None) -> Column:
    return x["version"] if null_version is None else F.coalesce(x["version"], F.lit(null_version))


def newest(items: Column, key: str, null_version: float | None = None) -> Column:
    """Elements that no other of the same key has a greater version than; equal versions all stay."""
    return F.filter(items, lambda e: ~F.exists(items, lambda o: (o[key] == e[key]) & (_version(o, null_version) > _version(e, null_version))))


def first_newest(items: Column, key: str) -> Column:
    """The first of `newest`, null if there is none."""
    return F.get(newest(items, key), 0)


def distinct_ties(items: Column, key: str) -> Column:
    """Of elements with equal key and version the first only."""
    at = F.sequence(F.lit(0), F.size(items) - 1)
    alone = F.filter(at, lambda i: ~F.exists(F.filter(at, lambda j: j < i), lambda j: (F.get(items, j)[key] == F.get(items, i)[key]) & (F.get(items, j)["version"] == F.get(items, i)["version"])))
    return F.when(F.size(items) > 0, F.transform(alone, lambda i: F.get(items, i))).otherwise(items)


def newer(source: Column, target: Column) -> Column:
    """Whether a source version replaces a target version."""
    return source.isNotNull() & (source > F.coalesce(target, F.lit(0)))


def merge_struct(source: Column, target: Column) -> Column:
    """The one there is; of two the source if its version is greater, else the target."""
    return F.when(source.isNull(), target).when(target.isNull(), source).when(source["version"] > F.coalesce(target["version"], F.lit(0)), source).otherwise(target)


def merge_array(source: Column, target: Column, key: str, null_version: float | None = None) -> Column:
    """The one that isn't null or empty; of two the source's elements that no target element of that key has an equal or
    greater version than, then the target's that no source element has a greater version than."""
    v = lambda x: _version(x, null_version)
    from_source = F.filter(source, lambda s: ~F.exists(target, lambda t: (t[key] == s[key]) & (v(t) >= v(s))))
    from_target = F.filter(target, lambda t: ~F.exists(source, lambda s: (s[key] == t[key]) & (v(s) > v(t))))
    none = lambda a: a.isNull() | (F.size(a) == 0)
    return F.when(none(source), target).when(none(target), source).otherwise(F.concat(from_source, from_target))
