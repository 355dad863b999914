"""Values of VARIANT columns whose shape isn't known: nested objects as dotted keys, items of lists."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ENTRIES = "array<struct<key: string, value: variant>>"


def as_object(v: Column) -> Column:
    """The entries of an object; null for anything else."""
    return F.map_entries(F.try_variant_get(v, "$", "map<string,variant>"))


def flattened(v: Column) -> Column:
    """An object's values as (key, value), keys of nested objects joined by dots; null where v isn't an object.

    Each step opens one level of every entry, and an object is no deeper than the braces in its text, so any depth is
    reached. Nulls and empty objects have no entry; lists are values.
    """
    named = lambda e: F.transform(
        as_object(e["value"]),
        lambda f: F.struct(F.concat(e["key"], F.lit("."), f["key"]).alias("key"), f["value"].alias("value")),
    )
    open_ = lambda found: F.flatten(F.transform(found, lambda e: F.coalesce(named(e), F.array(e))))
    first = as_object(v).cast(ENTRIES)
    deeper = F.regexp_count(F.to_json(v), F.lit(r"\{")) - 1
    steps = F.when(deeper > 0, F.sequence(F.lit(1), deeper))
    whole = F.aggregate(F.coalesce(steps, F.array().cast("array<int>")), first, lambda found, _: open_(found).cast(ENTRIES))
    return F.filter(whole, lambda e: ~F.is_variant_null(e["value"]) & as_object(e["value"]).isNull())


def text_of(v: Column) -> Column:
    """A value as text: strings as they are, all else as JSON; null for a JSON null."""
    return F.coalesce(F.try_variant_get(v, "$", "string"), F.when(~F.is_variant_null(v), F.to_json(v)))


def paths_to(key: str) -> list[str]:
    """The paths under which a dotted key may stand: as one key, and with each choice of its dots as steps down."""
    parts = key.split(".")
    found = [[parts[0]]]
    for p in parts[1:]:
        found = [[*f[:-1], f"{f[-1]}.{p}"] for f in found] + [[*f, p] for f in found]
    quote = lambda k: '["' + k.replace("\\", "\\\\").replace('"', '\\"') + '"]'
    return ["$" + "".join(map(quote, f)) for f in found]


def at_key(v: Column, key: str, kind: str) -> Column:
    """The value at a dotted key, whichever of its dots are nesting."""
    found = [F.try_variant_get(v, path, kind) for path in paths_to(key)]
    return found[0] if len(found) == 1 else F.coalesce(*found)
