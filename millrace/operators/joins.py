"""Equi-joins. Which side is broadcast is left to Spark, which checks the size before and while it runs.

Hot keys: adaptive execution splits the hot partition of an inner join on either side, and of a left, semi or anti
join on the left side. Where it could not (hot keys on the right of an outer join) the join is written as an inner join
plus the unmatched rows, and the right side of semi and anti joins is reduced to its distinct keys first.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import all_of
from millrace.operators.project import as_list, quoted
from millrace.operators.windows import group_select_first

Keys = str | Sequence[str]


def key_pairs(keys: Keys | None, left_keys: Keys | None, right_keys: Keys | None) -> tuple[list[str], list[str]]:
    """The key columns of both sides, from one common list or from one list per side."""
    if left_keys is not None and right_keys is not None:
        left, right = as_list(left_keys), as_list(right_keys)
    elif keys is not None:
        left = right = as_list(keys)
    else:
        raise ValueError("give keys, or left_keys and right_keys")
    if not left or len(left) != len(right):
        raise ValueError("both sides need the same number of key columns, at least one")
    return left, right


def matching(left_keys: Sequence[str], right_keys: Sequence[str]) -> Column:
    return all_of(F.col(f"l.`{a}`") == F.col(f"r.`{b}`") for a, b in zip(left_keys, right_keys))


def output_columns(
    left: DataFrame,
    right: DataFrame,
    hidden: Sequence[str],
    left_mark: str = "",
    right_mark: str = "",
    suffix: bool = False,
) -> list[tuple[str, str, str]]:
    """(side, column, output name): all of left, then right without `hidden`. Names on both sides get the marks."""
    kept = [c for c in right.columns if c not in hidden]
    clash = set(left.columns) & set(kept)
    if clash and left_mark == right_mark:
        raise ValueError(f"both sides have {', '.join(sorted(clash))}: give two different prefixes or suffixes")

    def shown(name: str, mark: str) -> str:
        if name not in clash:
            return name
        return name + mark if suffix else mark + name

    return [("l", c, shown(c, left_mark)) for c in left.columns] + [("r", c, shown(c, right_mark)) for c in kept]


def _selected(columns: Sequence[tuple[str, str, str]]) -> list[Column]:
    return [F.col(f"{side}.`{c}`").alias(name) for side, c, name in columns]


def _unmatched(
    left: DataFrame,
    right: DataFrame,
    left_keys: Sequence[str],
    right_keys: Sequence[str],
    columns: Sequence[tuple[str, str, str]],
) -> DataFrame:
    """Left rows without a partner, with NULL for every right column."""
    rest = _filtering_join(left, right, left_keys, right_keys, "left_anti")
    return rest.select(
        *[
            quoted(c).alias(name) if side == "l" else F.lit(None).cast(right.schema[c].dataType).alias(name)
            for side, c, name in columns
        ]
    )


def _filtering_join(
    left: DataFrame, right: DataFrame, left_keys: Sequence[str], right_keys: Sequence[str], how: str
) -> DataFrame:
    names = [f"__k{i}" for i in range(len(left_keys))]
    partners = right.select(*[quoted(k).alias(n) for k, n in zip(right_keys, names)]).distinct()
    condition = all_of(F.col(f"l.`{k}`") == F.col(f"r.{n}") for k, n in zip(left_keys, names))
    return left.alias("l").join(partners.alias("r"), condition, how)


def join(
    left: DataFrame,
    right: DataFrame,
    keys: Keys | None = None,
    left_keys: Keys | None = None,
    right_keys: Keys | None = None,
    left_prefix: str = "",
    right_prefix: str = "",
) -> DataFrame:
    """Inner join: all left columns, then the right columns that are not keys."""
    a, b = key_pairs(keys, left_keys, right_keys)
    columns = output_columns(left, right, b, left_prefix, right_prefix)
    return left.alias("l").join(right.alias("r"), matching(a, b), "inner").select(*_selected(columns))


def inner_join(left: DataFrame, right: DataFrame, keys: Keys, suffixes: tuple[str, str] = ("", "")) -> DataFrame:
    a, b = key_pairs(keys, None, None)
    columns = output_columns(left, right, b, *suffixes, suffix=True)
    return left.alias("l").join(right.alias("r"), matching(a, b), "inner").select(*_selected(columns))


def left_join(
    left: DataFrame,
    right: DataFrame,
    keys: Keys,
    suffixes: tuple[str, str] = ("", ""),
    hot_right_keys: bool = False,
) -> DataFrame:
    """Left outer join on columns of the same name.

    Set `hot_right_keys` when a key may occur very often on the right: see the note at the top.
    """
    a, b = key_pairs(keys, None, None)
    return _left_outer(left, right, a, b, output_columns(left, right, b, *suffixes, suffix=True), hot_right_keys)


def left_join_different_key_names(
    left: DataFrame,
    right: DataFrame,
    left_keys: Keys,
    right_keys: Keys,
    suffixes: tuple[str, str] = ("", ""),
    hot_right_keys: bool = False,
) -> DataFrame:
    """Left outer join that keeps the key columns of both sides."""
    a, b = key_pairs(None, left_keys, right_keys)
    return _left_outer(left, right, a, b, output_columns(left, right, (), *suffixes, suffix=True), hot_right_keys)


def _left_outer(
    left: DataFrame,
    right: DataFrame,
    left_keys: Sequence[str],
    right_keys: Sequence[str],
    columns: Sequence[tuple[str, str, str]],
    hot_right_keys: bool,
) -> DataFrame:
    how = "inner" if hot_right_keys else "left"
    joined = left.alias("l").join(right.alias("r"), matching(left_keys, right_keys), how).select(*_selected(columns))
    if not hot_right_keys:
        return joined
    return joined.unionByName(_unmatched(left, right, left_keys, right_keys, columns))


def outer_join(
    left: DataFrame,
    right: DataFrame,
    keys: Keys,
    suffixes: tuple[str, str] = ("", ""),
    unique_keys: bool = False,
) -> DataFrame:
    """Full outer join with one, coalesced, set of key columns.

    A full outer join cannot be split on a hot key, so unless the keys are known to be unique on both sides it is
    written as matches + left rows without a match + right rows without a match.
    """
    names, _ = key_pairs(keys, None, None)
    columns = output_columns(left, right, names, *suffixes, suffix=True)
    if unique_keys:
        either = {n: F.coalesce(F.col(f"l.`{n}`"), F.col(f"r.`{n}`")).alias(n) for n in names}
        joined = left.alias("l").join(right.alias("r"), matching(names, names), "full")
        return joined.select(
            *[either[c] if c in names else F.col(f"{side}.`{c}`").alias(shown) for side, c, shown in columns]
        )
    matched = left.alias("l").join(right.alias("r"), matching(names, names), "inner").select(*_selected(columns))
    left_only = _unmatched(left, right, names, names, columns)
    rest = _filtering_join(right, left, names, names, "left_anti")
    right_only = rest.select(
        *[
            quoted(c).alias(shown)
            if side == "r" or c in names
            else F.lit(None).cast(left.schema[c].dataType).alias(shown)
            for side, c, shown in columns
        ]
    )
    return matched.unionByName(left_only).unionByName(right_only)


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    keys: Keys | None = None,
    left_keys: Keys | None = None,
    right_keys: Keys | None = None,
    order_by: Sequence[str | Column] = (),
    left_prefix: str = "",
    right_prefix: str = "",
) -> DataFrame:
    """Left join against one row per key of the right side: the first by `order_by`."""
    a, b = key_pairs(keys, left_keys, right_keys)
    first = group_select_first(right, b, order_by)
    return _left_outer(left, first, a, b, output_columns(left, right, b, left_prefix, right_prefix), False)


def anti_join(
    left: DataFrame,
    right: DataFrame,
    keys: Keys | None = None,
    left_keys: Keys | None = None,
    right_keys: Keys | None = None,
) -> DataFrame:
    """Left rows whose keys (all of them) do not occur on the right. A NULL key never matches, so its row stays."""
    a, b = key_pairs(keys, left_keys, right_keys)
    return _filtering_join(left, right, a, b, "left_anti")


def semi_join(
    left: DataFrame,
    right: DataFrame,
    keys: Keys | None = None,
    left_keys: Keys | None = None,
    right_keys: Keys | None = None,
) -> DataFrame:
    """Left rows whose keys occur on the right."""
    a, b = key_pairs(keys, left_keys, right_keys)
    return _filtering_join(left, right, a, b, "left_semi")


def surrogate_key_lookup(
    source: DataFrame,
    dimension: DataFrame,
    natural_keys: Keys,
    surrogate_key: str,
    foreign_key: str,
    source_keys: Keys,
    how: str = "left",
) -> DataFrame:
    """Swap a natural key for the dimension's surrogate key, under the name of the foreign key."""
    natural, own = as_list(natural_keys), as_list(source_keys)
    if len(natural) != len(own):
        raise ValueError("natural_keys and source_keys differ in length")
    renamed = dimension.select(
        *[quoted(n).alias(s) for n, s in zip(natural, own)], quoted(surrogate_key).alias(foreign_key)
    )
    return source.join(renamed, own, how).drop(*own)


def enrich(
    df: DataFrame, lookups: Sequence[tuple[DataFrame, Keys, Mapping[str, str]]], required: bool = False
) -> tuple[DataFrame, DataFrame | None]:
    """Follow a chain of lookup tables.

    Each lookup is (table, key columns, {column of the table: name in the result}); its key columns must exist by then
    and its keys be unique. Rows without an entry get NULLs. With `required` the second result holds, for every lookup,
    the keys that had no entry.
    """
    result, unmapped = df, None
    for table, keys, wanted in lookups:
        names = as_list(keys)
        picked = table.select(*[quoted(k) for k in names], *[quoted(c).alias(n) for c, n in wanted.items()])
        if required:
            text = F.concat_ws("|", *[quoted(k).cast("string") for k in names])
            wanted_keys = result.select(*[quoted(k) for k in names]).dropna().distinct()
            missing = anti_join(wanted_keys, picked, names).select(
                F.lit(",".join(names)).alias("lookup"), text.alias("key")
            )
            unmapped = missing if unmapped is None else unmapped.union(missing)
        result = result.join(picked, names, "left")
    return result, unmapped


def bridge(
    links: DataFrame,
    left: DataFrame,
    right: DataFrame,
    left_keys: str | Sequence[str],
    right_keys: str | Sequence[str],
    agree: Sequence[str] = (),
    keep: Sequence[str] = (),
) -> DataFrame:
    """Distinct pairs of the keys of two tables that a table of links puts together, with the `keep` columns of the links; only
    pairs that have the same values in `agree`, if any. NULLs match nothing. Repeated links do not multiply, as a key and its
    agreeing values come once in each table; they are reduced at the end, when what does not agree is gone: most links are distinct
    and reducing them first would hold them all in memory.
    """
    lefts, rights = as_list(left_keys), as_list(right_keys)
    columns = list(dict.fromkeys([*keep, *lefts, *rights]))
    needed = links.select(*[quoted(c) for c in columns])
    same = {c: f"__same_{c}" for c in agree}
    with_left = needed.join(left.select(*[quoted(c) for c in lefts], *[quoted(c).alias(n) for c, n in same.items()]).distinct(), lefts)
    other = right.select(*[quoted(c) for c in rights], *[quoted(c).alias(n) for c, n in same.items()]).distinct()
    return with_left.join(other, [*rights, *same.values()]).select(*[quoted(c) for c in columns]).distinct()
