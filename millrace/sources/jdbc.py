"""Database scans and writes through Spark's JDBC source."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Driver classes by database.
DRIVERS = {
    "postgres": "org.postgresql.Driver",
    "sqlserver": "com.microsoft.sqlserver.jdbc.SQLServerDriver",
    "sybase": "com.sybase.jdbc4.jdbc.SybDriver",
    "db2": "com.ibm.db2.jcc.DB2Driver",
    "oracle": "oracle.jdbc.driver.OracleDriver",
    "mysql": "com.mysql.jdbc.Driver",
}

# Rows per round trip, and parallel reads of a partitioned scan.
FETCH_SIZE = 500_000
READ_PARTITIONS = 5


@dataclass(frozen=True)
class Database:
    """Where and as whom to connect. Credentials come from the caller."""

    kind: str
    url: str
    user: str | None = None
    password: str | None = None
    driver: str | None = None
    fetch_size: int = FETCH_SIZE

    def options(self) -> dict[str, str]:
        found = {
            "url": self.url,
            "driver": self.driver or DRIVERS[self.kind],
            "user": self.user,
            "password": self.password,
            "fetchsize": str(self.fetch_size),
        }
        return {k: v for k, v in found.items() if v is not None}


def query_options(database: Database, query: str) -> dict[str, str]:
    return {**database.options(), "query": query}


def table_options(database: Database, table: str) -> dict[str, str]:
    return {**database.options(), "dbtable": table}


def partitioned_options(
    database: Database, query: str, column: str, low: int, high: int, partitions: int = READ_PARTITIONS
) -> dict[str, str]:
    """Options of a scan in ranges of a numeric column. Spark allows ranges on `dbtable` only, so the query is wrapped."""
    return {
        **database.options(),
        "dbtable": f"({query}) t",
        "partitionColumn": column,
        "lowerBound": str(low),
        "upperBound": str(high),
        "numPartitions": str(partitions),
    }


def bounds_query(query: str, column: str) -> str:
    return f"SELECT MIN({column}) AS low, MAX({column}) AS high FROM ({query}) t"


def numbered_query(query: str, order_by: str, name: str = "record_key") -> str:
    """A query with a row number to split on, for sources without a numeric key.

    Every range reads and sorts the query anew, and the numbers must come out the same each time: an order is required.
    `read_by_ranges` does without numbers.
    """
    return f"SELECT q.*, ROW_NUMBER() OVER (ORDER BY {order_by}) AS {name} FROM ({query}) q"


def bounds_by_rank_query(query: str, column: str, partitions: int) -> str:
    """The least value of each of `partitions` equally large ranges of a column of any type, once for ranges that begin with the
    same value. The source counts its values and sorts those, not its rows: ranges are as NTILE would cut the sorted rows."""
    counted = f"SELECT {column} AS k, COUNT(*) AS n FROM ({query}) q WHERE {column} IS NOT NULL GROUP BY {column}"
    placed = f"SELECT k, SUM(n) OVER (ORDER BY k ROWS UNBOUNDED PRECEDING) AS upto, n, SUM(n) OVER () AS total FROM ({counted}) c"
    sized = f"SELECT k, upto, n, FLOOR(total / {partitions}) AS size, total - {partitions} * FLOOR(total / {partitions}) AS longer FROM ({placed}) p"

    def range_of(row: str) -> str:
        """The range, from 1, that a row number from 1 falls into: the first `longer` ranges hold one row more than the others."""
        return (
            f"CASE WHEN {row} <= longer * (size + 1) THEN FLOOR(({row} + size) / (size + 1)) "
            f"ELSE longer + FLOOR(({row} - longer * (size + 1) + size - 1) / size) END"
        )

    # a range begins in the value if its last row lies in a later range than the row before its first
    return f"SELECT k AS low FROM ({sized}) s WHERE {range_of('upto')} > {range_of('(upto - n)')} ORDER BY low"


def sql_literal(value: object) -> str:
    """A value as it stands in SQL: numbers plain, dates and timestamps by their keyword, anything else a quoted text."""
    if isinstance(value, (bool, int, float, Decimal)):
        return str(value).upper() if isinstance(value, bool) else str(value)
    if isinstance(value, datetime):
        return f"TIMESTAMP '{value.isoformat(sep=' ')}'"
    if isinstance(value, date):
        return f"DATE '{value.isoformat()}'"
    return "'" + str(value).replace("'", "''") + "'"


def range_predicates(column: str, lows: Iterable[object]) -> list[str]:
    """Conditions that cut a table into disjoint ranges, of which each row, NULLs included, meets one. `lows` are the least values
    of the ranges in order; what lies below the first belongs to the first, equal ones make one range."""
    cuts = [sql_literal(v) for v in dict.fromkeys(lows)][1:]
    if not cuts:
        return [f"{column} IS NULL OR {column} IS NOT NULL"]
    inner = [f"{column} >= {a} AND {column} < {b}" for a, b in zip(cuts, cuts[1:])]
    return [f"{column} < {cuts[0]} OR {column} IS NULL", *inner, f"{column} >= {cuts[-1]}"]


def read_by_ranges(
    spark: SparkSession, database: Database, query: str, column: str, partitions: int = READ_PARTITIONS
) -> DataFrame:
    """A scan split by ranges of a column of any type, each a condition that the source evaluates itself, by an index if it has
    one. The source finds the bounds in one query; rows that come later fall into a range all the same."""
    lows = [r["low"] for r in read_query(spark, database, bounds_by_rank_query(query, column, partitions)).collect()]  # one a range
    options = database.options()
    return spark.read.jdbc(options.pop("url"), f"({query}) t", predicates=range_predicates(column, lows), properties=options)


def read_query(spark: SparkSession, database: Database, query: str) -> DataFrame:
    return spark.read.format("jdbc").options(**query_options(database, query)).load()


def read_table(spark: SparkSession, database: Database, table: str) -> DataFrame:
    """A whole table; filters and columns used later are pushed to the database."""
    return spark.read.format("jdbc").options(**table_options(database, table)).load()


def read_tables(spark: SparkSession, database: Database, tables: Iterable[str]) -> dict[str, DataFrame]:
    return {t: read_table(spark, database, t) for t in tables}


def read_partitioned(
    spark: SparkSession, database: Database, query: str, column: str, partitions: int = READ_PARTITIONS
) -> DataFrame:
    """A scan split by ranges of a numeric column, with the bounds taken from the data."""
    bounds = read_query(spark, database, bounds_query(query, column)).select(F.col("low"), F.col("high")).first()
    if bounds is None or bounds[0] is None:
        return read_query(spark, database, query)
    options = partitioned_options(database, query, column, int(bounds[0]), int(bounds[1]), partitions)
    return spark.read.format("jdbc").options(**options).load()


def read_numbered(
    spark: SparkSession, database: Database, query: str, order_by: str, partitions: int = READ_PARTITIONS
) -> DataFrame:
    """A scan split by row numbers, which do not appear in the result."""
    return read_partitioned(spark, database, numbered_query(query, order_by), "record_key", partitions).drop("record_key")


# Where databases list their tables, and how names are compared there.
TABLE_LISTS = {
    "postgres": "SELECT COUNT(*) AS n FROM information_schema.tables WHERE table_schema = '{schema}' AND table_name = '{table}'",
    "mysql": "SELECT COUNT(*) AS n FROM information_schema.tables WHERE table_schema = '{schema}' AND table_name = '{table}'",
    "sqlserver": "SELECT COUNT(*) AS n FROM information_schema.tables WHERE table_schema = '{schema}' AND table_name = '{table}'",
    "oracle": "SELECT COUNT(*) AS n FROM all_tables WHERE owner = UPPER('{schema}') AND table_name = UPPER('{table}')",
    "db2": "SELECT COUNT(*) AS n FROM syscat.tables WHERE tabschema = UPPER('{schema}') AND tabname = UPPER('{table}')",
    "sybase": "SELECT COUNT(*) AS n FROM sysobjects WHERE USER_NAME(uid) = '{schema}' AND name = '{table}' AND type = 'U'",
}


def exists_query(database: Database, table: str) -> str:
    """Counts the tables of a name, `schema.table`."""
    schema, _, name = table.rpartition(".")
    if not schema:
        raise ValueError(f"{table} needs its schema")
    return TABLE_LISTS[database.kind].format(schema=schema.replace("'", "''"), table=name.replace("'", "''"))


def read_target(spark: SparkSession, database: Database, table: str, partition_column: str | None = None) -> DataFrame | None:
    """The current target without its partition column, or None before the first load."""
    if not read_query(spark, database, exists_query(database, table)).first()[0]:
        return None
    target = read_table(spark, database, table)
    return target.drop(partition_column) if partition_column else target


def write_options(database: Database, table: str, truncate: bool = True, batch_size: int = 10_000) -> dict[str, str]:
    """With `truncate`, overwriting keeps the table's own definition, keys and grants."""
    return {**table_options(database, table), "truncate": str(truncate).lower(), "batchsize": str(batch_size)}


def write_table(
    df: DataFrame, database: Database, table: str, mode: str = "overwrite", extra: Mapping[str, str] | None = None
) -> None:
    df.write.format("jdbc").options(**write_options(database, table), **(extra or {})).mode(mode).save()
