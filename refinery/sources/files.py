"""Raw-file ingest and table IO: landing CSV -> bronze tables, layer DDL.

Columns are taken by header name, never by position: a reordered extract loads
correctly, one with a missing, renamed or additional column is refused, and so
is a folder whose files disagree.  No value is lost silently: the strict read
fails on a value that does not fit its type, the lenient one keeps the value in
``_rejected``.  Writes are full refreshes beside the table in use, which they
replace once they are whole (``Staging``), so re-running a load gives the same
table and a failed one changes nothing.  Tables are Parquet.
"""

from __future__ import annotations

import re
import uuid
import warnings
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from refinery.session import concurrently, move_folder, remove_folder
from refinery.sources.schemas import LAYERS, SOURCES, SourceSpec

TABLE_FORMAT = "parquet"
REJECTED = "_rejected"       # array of (column, value): what a lenient read could not convert


def read_csv(spark: SparkSession, path: str, infer: bool = False) -> DataFrame:
    """Headered, comma-separated files with the names of their header: text
    columns, or inferred types (an extra pass).  An empty field reads as NULL."""
    reader = spark.read.option("header", "true")
    return (reader.option("inferSchema", "true") if infer else reader).csv(path)


def header_order(spark: SparkSession, path: str, schema: StructType) -> list[StructField]:
    """The fields of ``schema`` in the order of the files' header, under the
    header's spelling (names match without regard to case).  Raises when the
    header lacks a column or has another one."""
    header = spark.read.options(header="true", recursiveFileLookup="true").csv(path).columns
    wanted = {f.name.lower(): f for f in schema.fields}
    found = [h.lower() for h in header]
    if sorted(found) != sorted(wanted):
        missing, other = sorted(set(wanted) - set(found)), sorted(set(found) - set(wanted))
        raise ValueError(f"{path}: header {header} does not have the expected columns; missing {missing}, not expected {other}")
    return [StructField(h, wanted[h.lower()].dataType, True) for h in header]


def _by_header(spark: SparkSession, path: str, fields: list[StructField], **options: str) -> DataFrame:
    # enforceSchema=false: Spark compares every file's header with these names
    return spark.read.options(header="true", enforceSchema="false", recursiveFileLookup="true", **options).schema(StructType(fields)).csv(path)


def ingest_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Strict typed read of one raw extract, a single pass; a value that does
    not fit its type fails the read."""
    raw = _by_header(spark, path, header_order(spark, path, schema), mode="FAILFAST")
    return raw.select([F.col(f.name).alias(f.name) for f in schema.fields])


def ingest_csv_strings(spark: SparkSession, path: str, schema: StructType, keep_rejected: bool = False) -> DataFrame:
    """Lenient read: every column as text, then ``try_cast`` to its type.  Text
    that does not convert becomes NULL; with ``keep_rejected`` the column
    ``_rejected`` holds (column, value) of each such text."""
    text = [StructField(f.name, StringType(), True) for f in header_order(spark, path, schema)]
    raw = _by_header(spark, path, text)
    typed = [f for f in schema.fields if not isinstance(f.dataType, StringType)]
    bad = {f.name: F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull() & (F.trim(F.col(f.name)) != "") for f in typed}
    none = F.lit(None).cast("struct<column:string,value:string>")
    found = F.array_compact(F.array(none, *[F.when(b, F.struct(F.lit(n).alias("column"), F.col(n).alias("value"))) for n, b in bad.items()]))
    # the list is built for rows that have something to tell, which are few
    some = reduce(or_, bad.values(), F.lit(False))
    rejected = [F.when(some, found).otherwise(F.array_compact(F.array(none))).alias(REJECTED)] if keep_rejected else []
    return raw.select([F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields] + rejected)


def write_csv(df: DataFrame, path: str, compression: str | None = None) -> None:
    """Write a headered CSV folder (one file per partition), as plain text or
    compressed (``gzip``, ``lz4``: every reader here takes them, but reads such a
    file in one task).  Leading and trailing blanks are kept: padding is part of
    the raw data."""
    (df.write.mode("overwrite").option("header", "true")
       .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false")
       .csv(path, compression=compression))


def _named(table: str) -> tuple[str, str]:
    """(schema, table) of a qualified name, without quotes; the schema is empty
    when the name has none."""
    parts = [p.replace("`", "") for p in re.findall(r"`[^`]+`|[^.`]+", table)]
    return ".".join(parts[:-1]), parts[-1]


def _quoted(*names: str) -> str:
    return ".".join(f"`{p}`" for n in names if n for p in n.split("."))


@dataclass
class _Staged:
    """A table version that is written but not yet what its name reads."""
    table: str               # the name it will have
    staged: str              # the name it has until then
    folder: str
    old_folder: str | None = None
    retired: str | None = None      # the name of the version it replaced, when that has another layout
    switched: bool = False


class Staging:
    """Tables written beside the ones in use, which take their place together.

        with Staging(spark) as stage:
            stage.write(df, "silver.crm_sales")
            fact = make(stage.read("silver.crm_sales"))    # the new version
            stage.write(fact, "gold.fact_sales")
            stage.publish()

    Each write goes to a fresh folder in the schema's location, registered under
    a name of its own.  ``publish`` then makes every table's name read its new
    folder: one catalog call a table where the layout (columns, buckets) is as it
    was, otherwise the two versions exchange names.  If a call fails, what was
    switched is switched back.  Folders that are replaced are deleted only when
    all tables have switched.  Leaving the block without ``publish``, by an
    exception or not, drops what was staged and leaves every table as it was.

    ``write`` can take sums while it writes (``DataFrame.observe`` in the stage
    that writes the files, where every partition is counted once, whatever was
    retried); they are in ``measured`` afterwards."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.measured: dict[tuple[str, str], int] = {}
        self._tables: dict[str, _Staged] = {}

    def __enter__(self) -> Staging:
        return self

    def __exit__(self, *_exc) -> None:
        self.discard()

    def write(self, df: DataFrame, table: str, bucket_by: str | None = None, buckets: int | None = None,
              partition_by: str | None = None, spread_by: tuple[str, ...] = (),
              measures: Mapping[str, Column] | None = None, compression: str | None = None) -> None:
        """Write a version of ``table`` (with the session's codec, unless
        ``compression`` names one).

        With ``bucket_by`` the table is hash-bucketed (and sorted) on that column
        into ``buckets`` buckets; rows are first spread into exactly that many
        partitions so each bucket is one file, not one file per writing task.

        With ``partition_by`` the table gets one folder per value (partition
        pruning for filters on it).  Rows are first range-partitioned on the
        partition column and ``spread_by``, so each task covers a contiguous
        stretch of values and writes few files, while a value holding many rows
        is still split over several tasks by the trailing columns.

        ``measures`` are named aggregates over the rows; their values are in
        ``measured`` under (table, name) once the write has ended."""
        schema, name = _named(table)
        tag = uuid.uuid4().hex[:12]
        location = self.spark.catalog.getDatabase(schema or self.spark.catalog.currentDatabase()).locationUri
        new = _Staged(table, _quoted(schema, f"{name}__staged_{tag}"), f"{location.rstrip('/')}/{name}-{tag}")
        if table in self._tables:
            raise ValueError(f"{table} is already staged")
        self._tables[table] = new
        if partition_by:
            df = df.repartitionByRange(partition_by, *spread_by)
        elif bucket_by:
            df = df.repartition(buckets, bucket_by)
        seen = Observation() if measures else None
        if seen is not None:         # after the last shuffle: in the stage that writes
            df = df.observe(seen, *[c.alias(f"m{i}") for i, c in enumerate(measures.values())])
        writer = df.write.format(TABLE_FORMAT).option("path", new.folder)
        if compression:
            writer = writer.option("compression", compression)
        if partition_by:
            writer = writer.partitionBy(partition_by)
        elif bucket_by:
            writer = writer.bucketBy(buckets, bucket_by).sortBy(bucket_by)
        writer.saveAsTable(new.staged)
        if seen is not None:         # a write of no rows may observe nothing: then nothing is known
            got = seen.get
            self.measured |= {(table, n): got[f"m{i}"] for i, n in enumerate(measures) if got.get(f"m{i}") is not None}

    def read(self, table: str) -> DataFrame:
        """The staged version of a table if there is one, else the one in use."""
        staged = self._tables.get(table)
        return self.spark.table(staged.staged if staged else table)

    def publish(self) -> None:
        """Every staged table takes its place, or none does."""
        tables = list(self._tables.values())
        try:
            for t in tables:
                self._switch(t)
        except Exception:
            for t in reversed(tables):
                if t.switched or t.retired:
                    self._switch_back(t)
            raise
        for t in tables:
            if t.retired:
                self.spark.sql(f"DROP TABLE IF EXISTS {t.retired}")
            if t.old_folder and t.old_folder != t.folder:
                remove_folder(self.spark, t.old_folder)
        self._tables = {}

    def _switch(self, t: _Staged) -> None:
        if not self.spark.catalog.tableExists(t.table):
            self.spark.sql(f"ALTER TABLE {t.staged} RENAME TO {t.table}")
        else:
            layout, t.old_folder = _layout(self.spark, t.table)
            if _layout(self.spark, t.staged)[0] == layout and "# Partition Information" not in layout:
                self.spark.sql(f"ALTER TABLE {t.table} SET LOCATION '{t.folder}'")
                t.switched = True
                self.spark.sql(f"DROP TABLE {t.staged}")             # its files are the table's now
                return
            schema, name = _named(t.staged)
            t.retired = _quoted(schema, name.replace("__staged_", "__retired_"))
            self.spark.sql(f"ALTER TABLE {t.table} RENAME TO {t.retired}")
            t.old_folder = _layout(self.spark, t.retired)[1]          # a rename moves the files of a managed table
            self.spark.sql(f"ALTER TABLE {t.staged} RENAME TO {t.table}")
        t.switched = True

    def _switch_back(self, t: _Staged) -> None:
        """Undo ``_switch``; the new version is dropped."""
        if t.switched and t.old_folder and not t.retired:
            self.spark.sql(f"ALTER TABLE {t.table} SET LOCATION '{t.old_folder}'")
        else:
            if t.switched:
                self.spark.sql(f"DROP TABLE IF EXISTS {t.table}")
            if t.retired and self.spark.catalog.tableExists(t.retired):
                self.spark.sql(f"ALTER TABLE {t.retired} RENAME TO {t.table}")
        t.switched, t.retired = False, None

    def discard(self) -> None:
        """Drop what is staged and not published, with its files."""
        for t in self._tables.values():
            self.spark.sql(f"DROP TABLE IF EXISTS {t.staged}")
            remove_folder(self.spark, t.folder)
        self._tables = {}


def _layout(spark: SparkSession, table: str) -> tuple[tuple, str]:
    """What readers of a table depend on besides its rows (columns, types,
    partitions, buckets), and its folder."""
    rows = [(r.col_name, r.data_type) for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()]
    names = [n for n, _ in rows]
    cut = names.index("# Detailed Table Information")
    told = dict(rows[cut + 1:])
    kept = tuple(rows[:cut]) + tuple((k, told.get(k)) for k in ("Provider", "Num Buckets", "Bucket Columns", "Sort Columns"))
    return (*kept, *[n for n in names[:cut] if n.startswith("# Partition")]), told["Location"]


def write_table(df: DataFrame, table: str, **layout) -> None:
    """Full refresh of a catalog table: a version beside the old one, which it
    replaces once it is whole.  A write that fails leaves the table readable with
    its old rows and no folder behind.  ``layout`` as in ``Staging.write``."""
    with Staging(df.sparkSession) as stage:
        stage.write(df, table, **layout)
        stage.publish()


def detach_table(spark: SparkSession, table: str, folder: str) -> DataFrame:
    """Take a table out of the catalog with its rows kept: its files are renamed
    to ``folder``, which must not exist yet, not copied.  Returns a frame that
    reads them.  Not for partitioned tables, whose folders hold a column."""
    schema = spark.table(table).schema
    layout, location = _layout(spark, table)
    if "# Partition Information" in layout:
        raise ValueError(f"{table} is partitioned")
    move_folder(spark, location, folder)
    spark.sql(f"DROP TABLE {table}")
    return spark.read.schema(schema).parquet(folder)


def create_layer_schemas(spark: SparkSession, root: str | None = None, names: Mapping[str, str] | None = None,
                         prefix: str = "") -> list[str]:
    """``CREATE SCHEMA IF NOT EXISTS`` for each layer, with its comment; ``names``
    gives layers a name of their own, and with ``root`` a layer's tables live
    under ``root/<name>``."""
    done = []
    for layer, comment in LAYERS.items():
        db = prefix + (names or {}).get(layer, layer)
        stmt = f"CREATE SCHEMA IF NOT EXISTS `{db}` COMMENT '{comment}'"
        if root:
            stmt += f" LOCATION '{root.rstrip('/')}/{db}'"
        spark.sql(stmt)
        done.append(db)
    return done


def drop_layer_schemas(spark: SparkSession, layers: Iterable[str] = tuple(LAYERS),
                       dry_run: bool = False, prefix: str = "") -> list[str]:
    """``DROP SCHEMA IF EXISTS ... CASCADE`` per layer.  A dry run only returns
    the statements; a failing statement becomes a warning, not an error."""
    names = [prefix + name for name in layers]
    stmts = [f"DROP SCHEMA IF EXISTS `{name}` CASCADE" for name in names]
    if dry_run:
        return stmts
    for name, stmt in zip(names, stmts):
        try:
            folders = _folders_inside(spark, name)
            spark.sql(stmt)
            for folder in folders:           # a catalog may keep the files of tables with a folder of their own
                remove_folder(spark, folder)
        except Exception as exc:  # noqa: BLE001 - cleanup continues past a failed drop
            warnings.warn(f"{stmt}: {exc}", stacklevel=2)
    return stmts


def _folders_inside(spark: SparkSession, schema: str) -> list[str]:
    """The folders of a schema's tables that lie in the schema's location."""
    if not spark.catalog.databaseExists(schema):
        return []
    root = spark.catalog.getDatabase(schema).locationUri.rstrip("/") + "/"
    tables = [_quoted(schema, t.name) for t in spark.catalog.listTables(schema) if not t.isTemporary and t.tableType != "VIEW"]
    return [f for f in (_layout(spark, t)[1] for t in tables) if f.startswith(root)]


def use_layer(spark: SparkSession, database: str, catalog: str | None = None) -> None:
    """Make a layer schema current (``USE [CATALOG c;] SCHEMA s``); jobs in this
    library still use qualified names, so this only affects ad-hoc SQL."""
    if catalog:
        spark.catalog.setCurrentCatalog(catalog)
    spark.catalog.setCurrentDatabase(database)


def landing_files(spark: SparkSession, root: str) -> DataFrame:
    """Path, name and size of every file under a landing folder, from file
    metadata alone: no content is read, and files without rows are listed."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    return files.select(F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_name").alias("file_name"),
                        F.col("length").alias("file_size"))


def landing_rows(spark: SparkSession, root: str) -> DataFrame:
    """``landing_files`` with each file's row count (this reads the files)."""
    rows = spark.read.option("header", "true").option("recursiveFileLookup", "true").csv(root)
    counts = rows.groupBy(F.col("_metadata.file_path").alias("__path")).agg(F.count(F.lit(1)).alias("rows"))
    files = landing_files(spark, root)
    return (files.join(counts, files["file_path"] == counts["__path"], "left").drop("__path")
            .withColumn("rows", F.coalesce("rows", F.lit(0).cast("long"))))


def land_sources(inputs: Mapping[str, DataFrame], root: str,
                 specs: Sequence[SourceSpec] = SOURCES, compression: str | None = None) -> None:
    """Write each extract as headered CSV under ``root/<spec.path>``, side by side
    (used to build a landing area from the test projections)."""
    concurrently(*[lambda s=spec: write_csv(inputs[s.fixture], extract_folder(root, s), compression) for spec in specs])


def extract_folder(root: str, spec: SourceSpec) -> str:
    return f"{root.rstrip('/')}/{spec.path}"


def ingest_source(spark: SparkSession, root: str, table: str, spec: SourceSpec, stage: Staging, strict: bool = False,
                  measures: Mapping[str, Column] | None = None, compression: str | None = None) -> None:
    """One extract of the config, staged as ``table`` (see ``Staging.write``)."""
    path = extract_folder(root, spec)
    df = ingest_csv(spark, path, spec.schema) if strict else ingest_csv_strings(spark, path, spec.schema, keep_rejected=True)
    stage.write(df, table, measures=measures, compression=compression)


def ingest_catalog(spark: SparkSession, root: str, database: str,
                   specs: Sequence[SourceSpec] = SOURCES, strict: bool = False) -> dict[str, str]:
    """Config-driven full-refresh load: every extract under ``root`` becomes
    the table ``database.<spec.table>``, all of them side by side; either all are
    replaced or none.  Returns {table: qualified name}.  The lenient load (the
    default) gives each table the column ``_rejected``; with ``strict`` a bad value
    fails the load."""
    names = {spec.table: f"`{database}`.`{spec.table}`" for spec in specs}
    with Staging(spark) as stage:
        concurrently(*[lambda s=spec: ingest_source(spark, root, names[s.table], s, stage, strict) for spec in specs])
        stage.publish()
    return names


def rejected_values(tables: Iterable[DataFrame]) -> DataFrame:
    """(column, value, n) of what lenient loads could not convert."""
    parts = [t.select(F.explode(REJECTED).alias("r")).select("r.column", "r.value") for t in tables if REJECTED in t.columns]
    if not parts:
        raise ValueError("no table has a column of rejected values")
    found = parts[0]
    for p in parts[1:]:
        found = found.unionByName(p)
    return found.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
