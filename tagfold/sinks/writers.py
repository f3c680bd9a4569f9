"""Writers and table publication (K1, K2, K4, K5, K9).

Outputs go to fresh paths; a published table is switched to a new location
with ``ALTER TABLE ... SET LOCATION`` (never overwrite a path being read).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Column family and the qualifiers of the cell layout (cells are
# emitted in byte order of (row_key, qualifier), as a sorted bulk load needs).
CELL_FAMILY = "cf1"
CELL_QUALIFIERS = ["ac", "ci", "dt", "gki", "rcc", "rkd", "ri", "sw", "ua", "un", "vt"]


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> str:
    """K1: parquet overwrite of a fresh path."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def write_bucketed(df: DataFrame, table: str, path: str, by: str, buckets: int, order: list[str],
                   dealt: bool = False) -> DataFrame:
    """A table at ``path`` bucketed by ``by`` and sorted within the buckets, one
    file each, registered as ``table`` (its name is the only place where Spark
    keeps the bucketing), and a scan of it. ``dealt`` rows lie in their buckets
    already and are written as they lie."""
    spark = df.sparkSession
    df = df if dealt else df.repartition(buckets, by)
    (df.write.format("parquet").bucketBy(buckets, by).sortBy(*order)
       .option("path", path).mode("errorifexists").saveAsTable(table))
    return spark.table(table)


def write_delimited(df: DataFrame, path: str, sep: str = "&") -> str:
    """K2: delimited text; fields holding the separator or quotes are quoted
    and escaped by the CSV writer, so the reader restores them exactly."""
    df.write.mode("overwrite").option("sep", sep).csv(path)
    return path


def write_partitioned_by_date(df: DataFrame, path: str, date_col: str = "date",
                              order_col: str = "count") -> str:
    """K4: one directory per date, rows sorted by ``order_col`` descending
    inside each file. Rows are range-partitioned by date, count and the other
    columns, so a large day is split over several tasks even where most of its
    counts are equal."""
    rest = [c for c in df.columns if c not in (date_col, order_col)]
    (df.repartitionByRange(date_col, F.desc(order_col), *rest)
       .sortWithinPartitions(date_col, F.desc(order_col), *rest)
       .write.mode("overwrite").partitionBy(date_col).option("sep", ",").csv(path))
    return path


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _partition_keys(spark: SparkSession, path: str) -> list[str]:
    """Partition columns of a written table, from the names of its folders."""
    jvm, keys, at = spark._jvm, [], spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(at):
        raise ValueError(f"there is nothing at {path} to publish")
    while True:
        inner = [s.getPath() for s in fs.listStatus(at) if s.isDirectory() and "=" in s.getPath().getName()]
        if not inner:
            return keys
        at = inner[0]
        keys.append(jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName(at.getName().split("=", 1)[0]))


def _text_schema(spark: SparkSession, path: str, fmt: str, options: dict[str, str]) -> str:
    """Columns at ``path`` as DDL; partition values are text, as in the names."""
    key = "spark.sql.sources.partitionColumnTypeInference.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        return spark.read.format(fmt).options(**options).load(path)._jdf.schema().toDDL()
    finally:
        spark.conf.set(key, before)


def publish_location(spark: SparkSession, table: str, path: str, fmt: str = "parquet", schema: str | None = None,
                     options: dict[str, str] | None = None) -> None:
    """K5/K6: point ``table`` at ``path`` (create it on first use), then
    refresh cached metadata so readers see the new data. Delimited text needs
    its columns (``schema``, DDL) and ``options`` such as the separator.

    A snapshot is a folder, and the table's location is the one pointer to it:
    switching it is one change of the catalog, so a reader sees the rows of one
    snapshot or of the next and never some of both, and a failed run leaves the
    old one in place. That holds for a partitioned table too, as its partitions
    are not registered one by one but are the folders at the location. Their
    values are the folders' names, unescaped, as text (``01`` stays ``01``, the
    default partition is null) unless ``schema`` gives their types. No file is
    deleted. A managed table owns its files and is refused, as is a table that
    registers its partitions in the catalog."""
    keys = _partition_keys(spark, path)
    options = options or {}
    if not spark.catalog.tableExists(table):
        opts = f" OPTIONS ({', '.join(f'{_quoted(k)} {_quoted(v)}' for k, v in options.items())})" if options else ""
        if keys:
            schema = schema or _text_schema(spark, path, fmt, options)
        cols = f" ({schema})" if schema else ""
        parts = f" PARTITIONED BY ({', '.join(f'`{k}`' for k in keys)})" if keys else ""
        managed = "spark.sql.hive.manageFilesourcePartitions"
        before = spark.conf.get(managed)
        spark.conf.set(managed, "false")
        try:
            spark.sql(f"CREATE TABLE {table}{cols} USING {fmt}{opts}{parts} LOCATION {_quoted(path)}")
        finally:
            spark.conf.set(managed, before)
        return
    if spark.catalog.getTable(table).tableType != "EXTERNAL":
        raise ValueError(f"{table} is not an external table; its files are not this job's to replace")
    state = spark._jsparkSession.sessionState()
    known = state.catalog().getTableMetadata(state.sqlParser().parseTableIdentifier(table))
    if known.tracksPartitionsInCatalog() and known.partitionColumnNames().nonEmpty():
        raise ValueError(f"{table} registers its partitions one by one and can't be switched at once; "
                         "drop it (its files stay) and publish again")
    own = [c.name for c in spark.catalog.listColumns(table) if c.isPartition]
    if keys and keys != own:
        raise ValueError(f"{path} is partitioned by {keys}, {table} by {own}")
    spark.sql(f"ALTER TABLE {table} SET LOCATION {_quoted(path)}")
    spark.catalog.refreshTable(table)


def row_key(log: DataFrame) -> F.Column:
    """D-4: deterministic row key ``md5(all fields) || '-' || vt``; a retried
    task writes the same keys."""
    from ..schemas import LOG_FIELDS
    return F.concat(F.md5(F.concat_ws("\u0001", *[F.coalesce(F.col(c), F.lit("")) for c in LOG_FIELDS])),
                    F.lit("-"), F.col("vt"))


def rows_to_cells(df: DataFrame, key: F.Column, columns: list[str], family: str = CELL_FAMILY) -> DataFrame:
    """Any rows as (row_key, family, qualifier, value) cells, one per
    column, range-partitioned and sorted by (row_key, qualifier) as a sorted
    bulk load expects. Values are written as text. The key is computed once per
    row, before the row becomes cells: an expression selected beside ``explode``
    is evaluated for every cell."""
    stack = F.array(*[F.struct(F.lit(c).alias("qualifier"), F.col(c).cast("string").alias("value")) for c in columns])
    cells = (df.select(key.alias("row_key"), stack.alias("cells")).select("row_key", F.explode("cells").alias("c"))
             .select("row_key", F.lit(family).alias("family"), "c.qualifier", "c.value"))
    return cells.repartitionByRange("row_key", "qualifier").sortWithinPartitions("row_key", "qualifier")


def log_to_cells(log: DataFrame, qualifiers: list[str] = CELL_QUALIFIERS) -> DataFrame:
    """K9: cells of a log under family ``cf1``, keyed by the deterministic
    row key."""
    return rows_to_cells(log, row_key(log), qualifiers, CELL_FAMILY)


def index_path(path: str) -> str:
    return path.rstrip("/") + "_index"


def write_cells(cells: DataFrame, path: str) -> str:
    """Write sorted cells with a key index next to them: least and greatest row
    key of every file. The cells are range-partitioned, so a file holds a short
    range of keys and a range scan needs the files of its range only."""
    cells.write.parquet(path)
    back = cells.sparkSession.read.schema(cells.schema).parquet(path)
    (back.groupBy(F.col("_metadata.file_name").alias("file"))
     .agg(F.min("row_key").alias("least"), F.max("row_key").alias("greatest"), F.count(F.lit(1)).alias("cells"))
     .coalesce(1).write.parquet(index_path(path)))  # one row per file
    return path
