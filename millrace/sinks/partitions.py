"""Change feeds into partitioned tables: only partitions that hold touched keys are read and written again.

Which partitions hold a key is told by a key index: for each partition a copy of its key columns, sorted, in a hidden folder
of the table. An index is named by the files of the partition that it was made from, so one that does not fit any more is not
used but made anew, from the key columns of that partition only.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from millrace.operators.cdc import merge_by_indicator
from millrace.operators.filters import INSERTS, UPDATES, change_types
from millrace.operators.joins import anti_join, semi_join
from millrace.operators.project import as_list, drop_technical_columns, quoted
from millrace.sinks.commits import children, commit, file_system, remove, settle, staged_folder
from millrace.sinks.files import append_execution, partition_folder, staged_files, written_by

FOLDER = "__folder"


def _folders(spark: SparkSession, path: str, column: str) -> list[str]:
    mark = partition_folder(spark, column, "")
    return [f.rpartition("/")[2] for f in children(spark, path) if f.rpartition("/")[2].startswith(mark)]


def _part_of_path(place: int) -> Column:
    part = F.element_at(F.split(F.col("_metadata.file_path"), "/"), place)
    return F.url_decode(F.replace(part, F.lit("+"), F.lit("%2B")))


def _read_folders(spark: SparkSession, path: str, folders: Sequence[str]) -> DataFrame:
    """Rows of some partitions, each with the name of its partition's folder."""
    rows = spark.read.parquet(*[f"{path}/{f}" for f in folders])
    return rows.withColumn(FOLDER, _part_of_path(-2))


def key_index(spark: SparkSession, path: str, keys: str | Sequence[str], column: str) -> DataFrame | None:
    """The key columns of a partitioned table and the folder that each row lies in; None for a table without partitions.

    Indexes that are missing or out of date are made first, in one job over the key columns of their partitions.
    """
    path, names = path.rstrip("/"), as_list(keys)
    folders = _folders(spark, path, column)
    prints = {}
    for folder in folders:
        files = [f.rpartition("/")[2] for f in children(spark, f"{path}/{folder}")]
        prints[folder] = hashlib.md5("\0".join([*names, "", *files]).encode()).hexdigest()
    places = {f: f"{path}/_keys/{f}/{prints[f]}" for f in folders}
    stale = [f for f in folders if not children(spark, places[f])]
    if stale:
        fresh = f"{path}/_keys/_staged"
        rows = _read_folders(spark, path, stale).select(*[quoted(n) for n in names], FOLDER)
        sorted_rows = rows.repartitionByRange(FOLDER, quoted(names[0])).sortWithinPartitions(FOLDER, *[quoted(n) for n in names])
        sorted_rows.write.mode("overwrite").partitionBy(FOLDER).parquet(fresh)
        for folder in stale:
            remove(spark, f"{path}/_keys/{folder}")  # made from earlier files
            (source, system), (target, _) = (
                file_system(spark, p) for p in (f"{fresh}/{partition_folder(spark, FOLDER, folder)}", places[folder])
            )
            if system.exists(source):  # a partition without rows has no index
                system.mkdirs(target.getParent())
                system.rename(source, target)
        remove(spark, fresh)
    there = [p for p in places.values() if children(spark, p)]
    if not there:
        return None
    return spark.read.parquet(*there).withColumn(FOLDER, _part_of_path(-3))


def touched_folders(
    spark: SparkSession, path: str, touched: DataFrame, keys: str | Sequence[str], column: str
) -> list[str]:
    """Partitions with a key of `touched`; the scan of the index gets the range of the first key."""
    index = key_index(spark, path, keys, column)
    if index is None:
        return []
    first = as_list(keys)[0]
    low, high = touched.agg(F.min(quoted(first)), F.max(quoted(first))).first()
    if low is None:
        return []
    kind = index.schema[first].dataType
    near = index.filter(quoted(first).between(F.lit(low).cast(kind), F.lit(high).cast(kind)))
    return sorted(r[0] for r in semi_join(near, touched, keys).select(FOLDER).distinct().collect())  # one row a partition


def untouched_rows(
    spark: SparkSession, path: str, touched: DataFrame, keys: str | Sequence[str], folders: Sequence[str], without: Sequence[str] = ()
) -> DataFrame:
    """Rows of the given partitions whose key is not touched, and which do not lie in the files `without`."""
    rows = _read_folders(spark, path.rstrip("/"), folders)
    if without:
        rows = rows.filter(~F.col("_metadata.file_name").isin([f.rpartition("/")[2] for f in without]))
    return anti_join(rows, touched, keys)


def merge_into_partitions(
    spark: SparkSession,
    path: str,
    incoming: DataFrame,
    keys: str | Sequence[str],
    partition_column: str,
    run_date: date | str,
    execution_id: str,
    indicator: str | None = None,
) -> int:
    """Apply an increment to a table partitioned by load date, so that each key has one row; the number of rows it adds.

    New versions go to the run date's partition, their old ones leave the partition they lie in, and other partitions are
    neither read nor written. With an `indicator` the increment is a change feed, as for `cdc.merge_by_indicator`; without
    one it is an upsert. A key must not come twice. Rows with a NULL in the key match nothing. A repeated execution gives the
    same table. The whole change is one commit.
    """
    settle(spark, path)
    path, column = path.rstrip("/"), partition_column
    incoming = incoming.drop(column)
    touched, changes = incoming, incoming
    if indicator:
        first_load = not _folders(spark, path, column)
        alive = merge_by_indicator(None, incoming, keys, indicator)
        touched = incoming.filter(quoted(indicator).isNotNull())
        changes = alive if first_load else drop_technical_columns(change_types(incoming, indicator, UPDATES + INSERTS), indicator)
    added = Observation(f"added-{uuid.uuid4().hex}")
    changes = changes.observe(added, F.count(F.lit(1)).alias("rows"))
    own = written_by(spark, path, execution_id)
    folders = set(touched_folders(spark, path, touched, keys, column)) | {f.split("/")[-2] for f in own}
    if not folders:
        append_execution(changes, path, column, run_date, execution_id)
        return added.get["rows"]
    staged = staged_folder(spark, path)
    today = partition_folder(spark, column, run_date)
    stay = untouched_rows(spark, path, touched, keys, sorted(folders), own)
    stay.write.partitionBy(FOLDER).parquet(f"{staged}/kept")
    changes.write.parquet(f"{staged}/data")
    moves, removes = [], []
    for folder in sorted(folders):
        kept = f"{staged}/kept/{partition_folder(spark, FOLDER, folder)}"
        before = children(spark, f"{path}/{folder}", hidden=True)
        # file by file, as the run date's partition gets new files in the same commit
        removes += before
        moves += [(f, f"{path}/{folder}/{f.rpartition('/')[2]}") for f in children(spark, kept)]
    moves += staged_files(spark, staged, path, today, execution_id)
    commit(spark, path, staged, moves, removes)
    for folder in folders - {today}:
        if not children(spark, f"{path}/{folder}"):
            remove(spark, f"{path}/{folder}")
            remove(spark, f"{path}/_keys/{folder}")
    return added.get["rows"]
