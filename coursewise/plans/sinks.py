"""Sinks and table maintenance.

Tables are parquet/ORC folders partitioned by ``dt``/``dn`` and written by
column name (the reference's ``insertInto`` is positional). Paths should sit
under the cluster's shared folder (see ``session.shared_dir``).

File count: the reference ``coalesce``s to 1 or 3 files, which also squeezes
the upstream stage to that many tasks. Here AQE rebalances to the advisory
partition size: small outputs become one file, large or hot partitions several.
"""

from __future__ import annotations

import re
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, path: str, partition_cols=("dt", "dn"), fmt: str = "parquet") -> DataFrame:
    """Read a partitioned table keeping partition values as text.

    Spark would otherwise infer ``dt='20190722'`` as an integer (and drop
    leading zeros of such keys); the declared schema pins them to strings.
    """
    from pyspark.sql import types as T
    inferred = spark.read.format(fmt).load(path).schema
    fields = [T.StructField(f.name, T.StringType(), True) if f.name in partition_cols else f
              for f in inferred.fields]
    return spark.read.format(fmt).schema(T.StructType(fields)).load(path)


def compact(df: DataFrame, partition_cols=()) -> DataFrame:
    """Shape the output into few, well-sized files."""
    return df.hint("rebalance", *partition_cols) if partition_cols else df.hint("rebalance")


#: Most folders into which every task may write a file of its own.
FEW_FOLDERS = 16


def few_folders(df: DataFrame, partition_cols) -> bool:
    """Whether the rows of ``df`` fall into so few partitions that each task can write its own files.

    Then a table needs no shuffle of its rows before the write. Only the
    partition columns are read.
    """
    return df.select(*partition_cols).distinct().limit(FEW_FOLDERS + 1).count() <= FEW_FOLDERS


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text line scan (column ``value``)."""
    return spark.read.text(path)


#: Lines in a gzip file, which one task reads: a few hundred MB of text at most.
PACKED_LINES = 1_000_000


def write_lines(df: DataFrame, path: str, col: str = "value", packed: bool = False) -> str:
    """Text lines of ``col``; ``packed``: as gzip files of a bounded number of lines, a fraction of the text's size."""
    w = df.select(F.col(col).alias("value")).write.mode("errorifexists")
    (w.option("compression", "gzip").option("maxRecordsPerFile", PACKED_LINES) if packed else w).text(path)
    return path


def write_orc(df: DataFrame, path: str) -> str:
    """S5 (+S12): ORC, snappy, fails if the path exists (the reference's default)."""
    compact(df).write.mode("errorifexists").option("compression", "snappy").orc(path)
    return path


def append_partitioned(df: DataFrame, path: str, partition_cols=("dt", "dn"), fmt: str = "parquet",
                       shaped: bool = False) -> str:
    """Append rows under dynamic partitions (re-running a day duplicates it); ``shaped``: as the tasks have them."""
    ((df if shaped else compact(df, partition_cols)).write.mode("append").partitionBy(*partition_cols)
     .option("compression", "snappy").format(fmt).save(path))
    return path


def overwrite_partitions(df: DataFrame, path: str, partition_cols=("dt", "dn"), fmt: str = "parquet",
                         shaped: bool = False) -> str:
    """Replace only the partitions present in ``df``; others stay; ``shaped`` as for ``append_partitioned``."""
    ((df if shaped else compact(df, partition_cols)).write.mode("overwrite").partitionBy(*partition_cols)
     .option("partitionOverwriteMode", "dynamic").option("compression", "snappy").format(fmt).save(path))
    return path


def copy_partitions(spark: SparkSession, src: str, dst: str, dt=None, partition_cols=("dt",),
                    fmt: str = "parquet") -> str:
    """Copy partition ``dt`` (every partition when None) of one table into
    another, replacing the same partitions there. ``partition_cols`` are all of
    the source's, the day first: they are read as text, so keys keep their
    leading zeros, and the copy is partitioned like the source. The filter on
    the day prunes the source listing; columns are matched by name."""
    df = read_table(spark, src, partition_cols, fmt)
    if dt is not None:
        df = df.where(F.col(partition_cols[0]) == F.lit(str(dt)))
    return overwrite_partitions(df, dst, tuple(partition_cols), fmt=fmt)


def save_table(df: DataFrame, name: str, path: str, fmt: str = "parquet") -> str:
    """Drop-and-create a table from a query (CTAS), stored at ``path``."""
    df.write.mode("overwrite").format(fmt).option("path", path).saveAsTable(name)
    return name


def replace_table(df: DataFrame, name: str, root: str, fmt: str = "parquet") -> str:
    """S9 without a gap: fill a catalog table anew while readers keep the old rows.

    The rows go to a fresh folder under ``root``; when they are all written,
    the table's location is set to it in one catalog change. A write that
    fails leaves the table as it was. Older folders stay for queries still
    reading them (remove them when those have ended). The columns of an
    existing table must stay the same; otherwise ``save_table`` makes it anew.
    """
    import uuid
    spark = df.sparkSession
    old = spark.table(name).schema if spark.catalog.tableExists(name) else None
    shape = lambda schema: [(f.name, f.dataType.simpleString()) for f in schema.fields]
    if old is not None and shape(old) != shape(df.schema):
        raise ValueError(f"{name} has other columns than the new rows")
    path = f"{root.rstrip('/')}/{uuid.uuid4().hex[:12]}"
    compact(df).write.mode("errorifexists").format(fmt).save(path)
    at = path.replace("\\", "\\\\").replace("'", "\\'")
    if old is None:
        columns = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in df.schema.fields)
        spark.sql(f"CREATE TABLE {name} ({columns}) USING {fmt} LOCATION '{at}'")
    else:
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{at}'")
        spark.catalog.refreshTable(name)
    return name


def write_tsv(df: DataFrame, path: str) -> str:
    """Tab-delimited text result (overwrite)."""
    df.write.mode("overwrite").option("sep", "\t").option("header", "false").csv(path)
    return path


def read_tsv(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).option("sep", "\t").csv(path)


# Text of a result table: fields between tabs, one row a line, NULL as \N, and these characters escaped.
NULL_MARK, ESCAPED = "\\N", (("\t", "\\t"), ("\n", "\\n"), ("\r", "\\r"))


class ResultTable:
    """A catalog table of plain delimited text with declared columns, NULL mark and location.

    The text table ``<name>_text`` is created by DDL at ``path`` and filled by
    INSERT OVERWRITE; its properties record delimiter, NULL mark and columns.
    Every value survives: NULL, empty text, tabs, line breaks and backslashes.
    """

    def __init__(self, spark: SparkSession, name: str, schema, path: str, sep: str = "\t"):
        from pyspark.sql import types as T
        self.spark, self.name, self.path, self.sep = spark, name, path, sep
        self.schema = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
        self.marks = ESCAPED if sep == "\t" else (*ESCAPED, (sep, "\\s"))

    def create(self) -> "ResultTable":
        quoted = lambda x: "'" + x.replace("\\", "\\\\").replace("'", "\\'").replace("\t", "\\t") + "'"
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in self.schema.fields)
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {self.name}_text (value STRING) USING text LOCATION {quoted(self.path)} TBLPROPERTIES ("
                       f"'field.delim' = {quoted(self.sep)}, 'null.mark' = {quoted(NULL_MARK)}, 'columns' = {quoted(columns)})")
        return self

    def insert_overwrite(self, df: DataFrame) -> "ResultTable":
        """Fills the table with the rows of ``df``, columns by name."""
        fields = []
        for f in self.schema.fields:
            v = F.replace(F.col(f.name).cast(f.dataType).cast("string"), F.lit("\\"), F.lit("\\\\"))
            for raw, mark in self.marks:
                v = F.replace(v, F.lit(raw), F.lit(mark))
            fields.append(F.coalesce(v, F.lit(NULL_MARK)))
        view = f"{self.name}_rows"
        df.select(F.concat_ws(self.sep, *fields).alias("value")).createOrReplaceTempView(view)
        self.spark.sql(f"INSERT OVERWRITE TABLE {self.name}_text SELECT value FROM {view}")
        self.spark.catalog.dropTempView(view)
        return self

    def read(self) -> DataFrame:
        """The rows with their declared types."""
        part = F.split(F.col("value"), re.escape(self.sep), -1)
        out = []
        for i, f in enumerate(self.schema.fields):
            raw = part[i]
            # a doubled backslash is one; between those, marks are what they stand for
            def plain(x):
                for c, mark in self.marks:
                    x = F.replace(x, F.lit(mark), F.lit(c))
                return x
            text = F.array_join(F.transform(F.split(raw, r"\\\\", -1), plain), "\\")
            out.append(F.when(raw != NULL_MARK, text).cast(f.dataType).alias(f.name))
        return self.spark.table(f"{self.name}_text").select(*out)


def register_views(views: dict) -> None:
    """Name -> DataFrame as temp views."""
    for name, df in views.items():
        df.createOrReplaceTempView(name)


@contextmanager
def cached(*dfs: DataFrame):
    """Dimension tables that several joins reuse stay cached within the block."""
    for df in dfs:
        df.cache()
    try:
        yield
    finally:
        for df in dfs:
            df.unpersist()


def preview(df: DataFrame, n: int = 20) -> None:
    """Print the first rows (a driver-side look, never a data path)."""
    df.show(n, truncate=False)
