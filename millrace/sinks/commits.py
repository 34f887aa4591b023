"""Changes of a table's folder that take effect all at once, or not at all.

A change is prepared in a staged folder beside the table. Then one small file, the commit, lists what has to be moved and
removed; it appears under its name when it is complete, and from that moment the change is decided. `settle` carries it out
and may be repeated from any point: whoever reads or writes the table next finishes what a lost driver left. Without a commit
file staged folders mean nothing, and the next writer removes them. One writer at a time per table.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable

from pyspark.sql import SparkSession


def file_system(spark: SparkSession, path: str):
    """(Hadoop path, its file system)."""
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location, location.getFileSystem(spark._jsc.hadoopConfiguration())


def _beside(path: str, mark: str) -> str:
    parent, _, name = path.rstrip("/").rpartition("/")
    return f"{parent}/_{name}.{mark}"


def commit_file(path: str) -> str:
    return _beside(path, "commit")


def exists(spark: SparkSession, path: str) -> bool:
    location, system = file_system(spark, path)
    return system.exists(location)


def children(spark: SparkSession, path: str, hidden: bool = False) -> list[str]:
    """Paths of the files and folders in a folder; without those that Spark does not see, unless asked for."""
    location, system = file_system(spark, path)
    if not system.exists(location):
        return []
    found = [entry.getPath() for entry in system.listStatus(location)]
    return sorted(f"{path.rstrip('/')}/{p.getName()}" for p in found if hidden or p.getName()[:1] not in "_.")


def remove(spark: SparkSession, path: str) -> None:
    location, system = file_system(spark, path)
    system.delete(location, True)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    location, system = file_system(spark, path)
    out = system.create(location, True)
    out.write(bytearray(text.encode()))
    out.close()


def read_text(spark: SparkSession, path: str) -> str | None:
    """The text of a small file, or None where there is none."""
    location, system = file_system(spark, path)
    if not system.exists(location):
        return None
    stream = system.open(location)
    text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    stream.close()
    return text


def staged_folder(spark: SparkSession, path: str) -> str:
    """A fresh folder beside the table, after what is pending was settled and what was given up was removed."""
    settle(spark, path)
    parent, _, name = path.rstrip("/").rpartition("/")
    for old in children(spark, parent, hidden=True):
        if old.rpartition("/")[2].startswith(f"_{name}.staged-"):
            remove(spark, old)
    return _beside(path, f"staged-{uuid.uuid4().hex}")


def decide(
    spark: SparkSession, path: str, staged: str, moves: Iterable[tuple[str, str]], removes: Iterable[str] = ()
) -> None:
    """Decide on a change, which `settle` carries out: first `removes`, then `moves` (from, to) in order; what stands at a
    move's end is replaced. No path may be removed and also be a move's end or below one, as both may be repeated."""
    plan = {"staged": staged, "removes": list(removes), "moves": [list(m) for m in moves]}
    draft = f"{staged}/commit"
    write_text(spark, draft, json.dumps(plan))
    (source, system), (target, _) = file_system(spark, draft), file_system(spark, commit_file(path))
    if not system.rename(source, target):
        system.delete(source, True)
        raise OSError(f"a change of {path} is pending: two writers?")


def commit(
    spark: SparkSession, path: str, staged: str, moves: Iterable[tuple[str, str]], removes: Iterable[str] = ()
) -> None:
    """Decide on a change and carry it out."""
    decide(spark, path, staged, moves, removes)
    settle(spark, path)


def settle(spark: SparkSession, path: str) -> bool:
    """Carry out the pending change of a table, if there is one, from wherever it stopped."""
    text = read_text(spark, commit_file(path))
    if text is None:
        return False
    plan = json.loads(text)
    for gone in plan["removes"]:
        remove(spark, gone)
    for start, end in plan["moves"]:
        (source, system), (target, _) = file_system(spark, start), file_system(spark, end)
        if system.exists(source):
            system.delete(target, True)
            system.mkdirs(target.getParent())
            if not system.rename(source, target) and system.exists(source):
                raise OSError(f"{start} could not be moved to {end}; the change stays pending")
        elif not system.exists(target):
            raise OSError(f"neither {start} nor {end} is there; {commit_file(path)} says what was to be moved")
    remove(spark, plan["staged"])
    remove(spark, commit_file(path))
    return True
