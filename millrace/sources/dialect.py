"""The dialect of delimited files: delimiter, header, order of columns and escape, from one scan of all their lines.

For every line and every candidate the number of cells outside quotes is counted by built-in functions. Lines are aggregated by
file and by whether they look like a header, so strings are keys of an aggregation and never wait in its buffers: per file
a few rows come out, whatever its size. A header is a first line that holds the declared names, as a set: in any order, with
further names between them.
"""

from __future__ import annotations

import csv
import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DELIMITERS = ",|;\t~"
MOST_LAYOUTS = 100  # orders of columns that one source may have
MOST_KINDS = 1000


@dataclass(frozen=True)
class Dialect:
    """`layouts` has the columns of the files with a header as they stand there, and the files; None for all files."""

    delimiter: str
    header: bool
    escape: str = "\\"
    layouts: tuple[tuple[tuple[str, ...], tuple[str, ...] | None], ...] = ()


def split_start() -> Column:
    """Where the part of the file begins that a line was read with."""
    return F.col("_metadata.file_block_start").alias("start")


def file_name(column: str = "file") -> Column:
    """A path from `_metadata.file_path` as the reader wants it."""
    return F.url_decode(F.replace(column, F.lit("+"), F.lit("%2B")))


def _patterns(candidates: Sequence[str]) -> tuple[str, str, str]:
    """Regular expressions of a quoted cell (from an opening quote at the start of a cell to a closing one at its end; \\" and ""
    stand for a quote), of an opening quote, and of a doubled quote within a cell."""
    edges = "".join(re.escape(c) for c in dict.fromkeys([*DELIMITERS, *candidates]))
    opening = f'(?<![^{edges}])"'
    return f'{opening}(?:[^"\\\\]|\\\\.|"")*"(?![^{edges}])', opening, f'[^{edges}"]""|""[^{edges}"]'


def cells_of(line: str, delimiter: str) -> list[str]:
    """Cells of a header, trimmed."""
    return [c.strip() for c in next(csv.reader([line.lstrip("\ufeff")], delimiter=delimiter), [])]


def _profile(lines: DataFrame, names: Sequence[str], candidates: Sequence[str]) -> DataFrame:
    """Of the lines of each file, part and heading (the line itself if it holds all names, else null): how many, the first one's
    number, and the least and most cells for each candidate."""
    cell, opening, doubled = _patterns(candidates)
    escapes = F.contains("value", F.lit('"'))
    bare = F.when(escapes, F.regexp_replace("value", cell, "")).otherwise(F.col("value"))
    lines = lines.withColumn("bare", bare)
    low = F.lower("value")
    holds = F.lit(True)
    for name in names:
        holds = holds & F.contains(low, F.lit(name.strip().lower()))
    counts = [(F.length("bare") - F.length(F.replace("bare", F.lit(d), F.lit("")))).alias(f"n{k}") for k, d in enumerate(candidates)]
    counted = lines.select(
        "file", "start", "line", F.when(holds, F.col("value")).alias("heading"), *counts,
        F.when(escapes, F.regexp_like("bare", F.lit(opening))).alias("open"),
        F.when(escapes, F.regexp_like("value", F.lit(doubled))).alias("doubled"),
        F.when(escapes, F.contains("value", F.lit('\\"'))).alias("slashed"),
    )
    return counted.groupBy("file", "start", "heading").agg(
        F.count(F.lit(1)).alias("lines"), F.min("line").alias("line"), F.max("open").alias("open"), F.max("doubled").alias("doubled"),
        F.max("slashed").alias("slashed"), *[f(f"n{k}").alias(f"{f.__name__}{k}") for k in range(len(candidates)) for f in (F.min, F.max)],
    )


def _by_file(profile: DataFrame, candidates: Sequence[str]) -> DataFrame:
    """One row per file: its first line if that holds all names, and what the profile says of all its lines."""
    place = F.struct("start", "line")
    return profile.groupBy("file").agg(
        F.min(F.struct(place.alias("place"), "heading")).alias("head"), F.max("open").alias("open"),
        F.max("doubled").alias("doubled"), F.max("slashed").alias("slashed"), F.sum("lines").alias("lines"),
        *[f(f"{f.__name__}{k}").alias(f"{f.__name__}{k}") for k in range(len(candidates)) for f in (F.min, F.max)],
    )


def detect_dialect(
    spark: SparkSession, path: str, names: Sequence[str], default: str = ",", header: bool | None = None, delimiter: str | None = None
) -> Dialect:
    """What the files at `path` are written in; what is declared is taken as given.

    A delimiter fits if it cuts every line of a file into as many cells: as its header has, or as there are declared names. Files
    that no delimiter fits, or several, files with a header beside files without one, quotes that are open at the end of a
    line, and headers that lack a declared name or have it twice are errors that say what was found.
    """
    if not names:
        raise ValueError("without declared names a header cannot be told from data")
    candidates = [delimiter] if delimiter else list(dict.fromkeys([*DELIMITERS, default]))
    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), split_start(), F.monotonically_increasing_id().alias("line")
    )
    files = _by_file(_profile(lines.filter("trim(value) <> ''"), names, candidates), candidates)
    one = range(len(candidates))
    alike = [(F.col(f"min{k}") == F.col(f"max{k}")).alias(f"alike{k}") for k in one]
    declared = [(F.col(f"alike{k}") & (F.col(f"min{k}") == len(names) - 1)).alias(f"declared{k}") for k in one]
    kinds = files.select("*", F.col("head.heading").alias("heading"), *alike).select("*", *declared)
    # files of one kind are one row here; a file list is only needed where headings differ
    found = kinds.groupBy("heading", "open", *[f"{n}{k}" for k in one for n in ("alike", "declared")]).agg(
        F.min("file").alias("one"), F.max("doubled").alias("doubled"), F.max("slashed").alias("slashed"),
        *[f(f"{f.__name__}{k}").alias(f"{f.__name__}{k}") for k in one for f in (F.min, F.max)],
    ).limit(MOST_KINDS + 1).collect()
    if len(found) > MOST_KINDS:
        raise ValueError(f"the files at {path} are of too many kinds; declare header and delimiter")
    if not found:
        return Dialect(delimiter or default, bool(header), layouts=((tuple(names), None),) if header else ())
    for r in found:
        if r["open"]:
            raise ValueError(f"a quoted cell goes on over the end of a line in {r['one']}; declare header and delimiter")
    wanted = {n.strip().lower() for n in names}
    fits, why = [], []
    for k, d in enumerate(candidates):
        heads = []
        for r in found:
            cells = cells_of(r["heading"], d) if r["heading"] is not None and header is not False else []
            headed = bool(wanted) and wanted <= {c.lower() for c in cells}
            if header and not headed:
                why.append(f"{r['one']} has no header with {', '.join(names)}" + f" when cut at {d!r}")
                break
            size = len(cells) if headed else len(names)
            if not r[f"{'alike' if headed else 'declared'}{k}"]:
                why.append(f"{d!r} cuts lines of {r['one']} into {r[f'min{k}'] + 1} to {r[f'max{k}'] + 1} cells, not {size}")
                break
            heads.append(tuple(cells) if headed else None)
        else:
            fits.append((d, heads))
    if len(names) == 1 and len(fits) > 1:
        fits = [f for f in fits if any(h and len(h) > 1 for h in f[1])] or [f for f in fits if f[0] == default]
    if len(fits) != 1:
        several = f"{' and '.join(repr(d) for d, _ in fits)} all fit"
        raise ValueError(f"no delimiter is certain for {path}; declare header and delimiter: {several if fits else '; '.join(why)}")
    chosen, heads = fits[0]
    if any(h is None for h in heads) and any(heads):
        bare, headed = (next(r["one"] for r, h in zip(found, heads) if (h is None) == without) for without in (True, False))
        raise ValueError(f"some files have a header and some have none; declare it: {headed}, {bare}")
    doubled, slashed = any(r["doubled"] for r in found), any(r["slashed"] for r in found)
    escape = '"' if doubled and not slashed else "\\"
    if heads[0] is None:
        return Dialect(chosen, False, escape)
    for cells in dict.fromkeys(heads):
        twice = [n for n in names if [c.lower() for c in cells].count(n.strip().lower()) > 1]
        if twice:
            raise ValueError(f"a header has {twice[0]} twice: {', '.join(cells)}")
    layouts = dict.fromkeys(heads)
    if len(layouts) == 1:
        return Dialect(chosen, True, escape, ((heads[0], None),))
    if len(layouts) > MOST_LAYOUTS:
        raise ValueError(f"the files at {path} have {len(layouts)} orders of columns")
    by_heading = {r["heading"]: h for r, h in zip(found, heads)}
    of: dict[tuple[str, ...], list[str]] = {h: [] for h in layouts}
    for r in files.select(file_name().alias("file"), F.col("head.heading").alias("heading")).toLocalIterator():
        of[by_heading[r["heading"]]].append(r["file"])
    return Dialect(chosen, True, escape, tuple((h, tuple(sorted(f))) for h, f in of.items()))


def detect_header_and_delimiter(spark: SparkSession, path: str, names: Sequence[str], default: str = ",") -> tuple[bool, str]:
    """(has a header, delimiter) of `detect_dialect`."""
    found = detect_dialect(spark, path, names, default)
    return found.header, found.delimiter
