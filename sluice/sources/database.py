"""Database tables through JDBC: queries, partitioned scans, and truncate-and-fill.

The drivers of the databases are not part of this package; put their jars on the
session's class path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# URL forms of the two kinds of database.
URLS = {
    "sqlserver": "jdbc:sqlserver://{host}:{port};databaseName={database}",
    "postgresql": "jdbc:postgresql://{host}:{port}/{database}",
}
PORTS = {"sqlserver": 1433, "postgresql": 5432}


def connection(
    kind: str,
    host: str,
    database: str,
    user: str,
    password: str,
    port: int | None = None,
) -> dict[str, str]:
    """JDBC options for a server, given what a DSN entry holds."""
    if kind not in URLS:
        raise ValueError(f"kind must be one of {sorted(URLS)}")
    url = URLS[kind].format(host=host, port=port or PORTS[kind], database=database)
    return {"url": url, "user": user, "password": password}


def scan_options(
    query: str | None = None,
    table: str | None = None,
    partition_column: str | None = None,
    bounds: tuple[object, object] | None = None,
    partitions: int = 1,
    fetch_size: int = 10_000,
) -> dict[str, str]:
    """Options of a scan; with a partition column it is read in parallel."""
    if (query is None) == (table is None):
        raise ValueError("give either a query or a table")
    options = {"fetchsize": str(fetch_size)}
    if partition_column is None:
        return options | ({"query": query} if query else {"dbtable": table})
    if bounds is None or partitions < 1:
        raise ValueError("a parallel scan needs bounds and a number of partitions")
    return options | {
        "dbtable": table or f"({query}) scanned",
        "partitionColumn": partition_column,
        "lowerBound": str(bounds[0]),
        "upperBound": str(bounds[1]),
        "numPartitions": str(partitions),
    }


def read_database(spark: SparkSession, server: dict[str, str], **scan: object) -> DataFrame:
    """A query or table as a DataFrame; names and types come from the database."""
    return spark.read.format("jdbc").options(**server, **scan_options(**scan)).load()


def fill_options(table: str, batch_rows: int = 1000) -> dict[str, str]:
    return {"dbtable": table, "truncate": "true", "batchsize": str(batch_rows)}


def truncate_and_fill(
    df: DataFrame, server: dict[str, str], table: str, batch_rows: int = 1000
) -> None:
    """Empty the table, keeping its definition, and insert the rows in batches.

    Each partition commits by itself.  Where a half-filled table must never be
    seen, load a staging table and let the database swap the two.
    """
    options = server | fill_options(table, batch_rows)
    df.write.format("jdbc").options(**options).mode("overwrite").save()
