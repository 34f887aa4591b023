"""Tags below the root of XML files, which tasks read as streams.

Without a known row tag a file cannot be split, but it need not be held either: a task feeds it to an incremental parser
piece by piece, and keeps the tags that it has met right below the root.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from xml.parsers import expat

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.sinks.commits import file_system

PIECE = 1 << 20  # bytes
MOST_TAGS = 1000  # of a file; more is an error, as then they are no row tags
# Names of schemes in Spark's paths and in pyarrow's.
SCHEMES = {"file": "file", "hdfs": "hdfs", "s3": "s3", "s3a": "s3", "gs": "gs", "abfs": "abfs", "abfss": "abfss"}


def _opened(path: str):
    scheme, rest = re.fullmatch(r"(\w+):/*(.*)", path, re.DOTALL).groups()
    if scheme == "file":
        return fs.LocalFileSystem().open_input_stream(f"/{rest}")  # compressed files are opened by their extension
    system, place = fs.FileSystem.from_uri(f"{SCHEMES[scheme]}://{rest}")
    return system.open_input_stream(place)


class TopTags:
    """Feed it a document; `tags` has those below the root, as written, without their namespaces resolved."""

    def __init__(self) -> None:
        self.depth, self.tags = 0, set()
        self.parser = expat.ParserCreate()
        self.parser.StartElementHandler, self.parser.EndElementHandler = self._begin, self._end

    def _begin(self, tag: str, _: dict) -> None:
        if self.depth == 1:
            self.tags.add(tag)
            if len(self.tags) > MOST_TAGS:
                raise ValueError(f"over {MOST_TAGS} different tags below the root")
        self.depth += 1

    def _end(self, _: str) -> None:
        self.depth -= 1

    def read(self, stream) -> set[str]:
        while piece := stream.read(PIECE):
            self.parser.Parse(piece, False)
        self.parser.Parse(b"", True)
        return self.tags


def row_tags(spark: SparkSession, path: str) -> DataFrame:
    """tag and files: the tags right below the root elements of all files, as written, with the number of files. The scan gives
    names of files only, which tasks open themselves; files in stores that only Spark reads come with their content."""
    files = spark.read.format("binaryFile").load(path)
    location, system = file_system(spark, path)
    streams = system.makeQualified(location).toUri().getScheme() in SCHEMES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for value in batch.column(0):
                with _opened(value.as_py()) if streams else pa.BufferReader(value.as_buffer()) as stream:
                    yield pa.RecordBatch.from_pydict({"tag": pa.array(sorted(TopTags().read(stream)), pa.string())})

    found = files.select("path" if streams else "content").mapInArrow(run, "tag string")
    return found.groupBy("tag").agg(F.count(F.lit(1)).alias("files"))
