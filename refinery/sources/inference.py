"""Column types of text files, told with their reasons.

Every value of every column is put in the first class it fits (``CLASSES``), and
one aggregate counts the classes of all columns in one scan.  A column's type is
the narrowest that holds all classes found in it, as Spark's CSV inference has
it; ``forced_by`` is a value of the class that made it so, which is what to look
at when a column is wider than expected.
"""

from __future__ import annotations

from collections.abc import Callable
from string import ascii_letters

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

# Narrowest first; a value that fits none of the typed ones is text.
CLASSES = ("int", "long", "decimal", "double", "date", "timestamp", "boolean", "string")
_NUMBERS = CLASSES[:4]
_INTEGER, _WHOLE = r"^[+-]?[0-9]+$", r"^[+-]?[0-9]+\.?$"
_FLOAT = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?[dDfF]?\s*$"
_NAMED = r"^(NaN|[+-]?Inf|[+-]?Infinity)$"
_DAY = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
# Letters that begin none of NaN, Inf, true and false, nor a timestamp (T12:30)
_TEXT_STARTS = [c for c in ascii_letters if c not in "NITFtf"]


def _digits(value: Column) -> Column:
    return F.length(F.regexp_replace(value, r"^[+-]?0*|\.", ""))


def _classified(value: Column, named: Callable[[str], object]) -> Column:
    """What ``named`` makes of the class of a text value; NULL for NULL and for
    empty text.  A first letter that begins no typed value ends the search: a
    cast that fails costs more than all patterns."""
    integer = value.rlike(_INTEGER)
    return (F.when(value.isNull() | (value == ""), None)
            .when(integer & value.try_cast("int").isNotNull(), named("int"))
            .when(integer & value.try_cast("bigint").isNotNull(), named("long"))
            .when(F.substring(value, 1, 1).isin(_TEXT_STARTS), named("string"))
            .when(value.rlike(_WHOLE) & (_digits(value) <= 38), named("decimal"))
            .when(value.rlike(_FLOAT) | value.rlike(_NAMED), named("double"))
            .when(value.rlike(_DAY) & value.try_cast("date").isNotNull(), named("date"))
            .when(value.try_cast("timestamp").isNotNull(), named("timestamp"))
            .when(F.lower(value).isin("true", "false"), named("boolean"))
            .otherwise(named("string")))


def value_class(value: Column) -> Column:
    """The class of a text value; NULL for NULL and for empty text."""
    return _classified(value, str)


def _joined(found: Column) -> Column:
    """The narrowest type that holds all classes of an array."""
    alone = F.size(found) == 1
    numeric = F.forall(found, lambda c: c.isin(*_NUMBERS))
    dated = F.forall(found, lambda c: c.isin("date", "timestamp"))
    widest = F.when(F.array_contains(found, "double"), "double").when(F.array_contains(found, "decimal"), "decimal").otherwise("long")
    return (F.when(F.size(found) == 0, "string").when(alone, found[0]).when(numeric, widest)
            .when(dated, "timestamp").otherwise("string"))


def column_types(text: DataFrame) -> DataFrame:
    """One row per column of a frame of text columns, in their order: ``position``,
    ``column``, ``type``, ``n_null`` (NULL or empty), ``n_<class>`` for each class,
    and ``forced_by``, the greatest value of the last class found, which the type
    is owed to (a text among numbers, say).  A column without values is text.  All
    columns are counted in one scan."""
    if not text.columns:
        raise ValueError("a frame without columns has no types")
    named = {f"v{i}": F.col(f"`{c}`") for i, c in enumerate(text.columns)}
    # one rule over the row's values: a rule for each column makes code too long to be compiled, at nine columns already
    classes = F.transform(F.array(*[F.col(v) for v in named]), lambda value: _classified(value, CLASSES.index))
    kinds = text.select(*[c.alias(v) for v, c in named.items()]).select("*", classes.alias("kinds"))
    # no grouping: every task folds its rows into one, whatever is in them
    sums = []
    for i, v in enumerate(named):
        kind = F.col("kinds")[i]
        sums.append(F.count_if(kind.isNull()).alias(f"c{i}_null"))
        sums += [F.count_if(kind == w).alias(f"c{i}_{k}") for w, k in enumerate(CLASSES)]
        sums.append(F.max(F.when(kind.isNotNull(), F.struct(kind.alias("w"), F.col(v).alias("v"))))["v"].alias(f"f{i}"))
        sums.append(F.max(F.when(kind == CLASSES.index("decimal"), _digits(F.col(v)))).alias(f"d{i}"))
    one = kinds.agg(*sums)
    rows = [F.struct(F.lit(i).alias("position"), F.lit(c).alias("column"), F.col(f"c{i}_null").alias("n_null"),
                     *[F.col(f"c{i}_{k}").alias(f"n_{k}") for k in CLASSES],
                     F.col(f"f{i}").alias("forced_by"), F.col(f"d{i}").alias("digits"))
            for i, c in enumerate(text.columns)]
    told = one.select(F.inline(F.array(*rows)))
    # the classes that were found, narrowest first
    found = F.array_compact(F.array(*[F.when(F.col(f"n_{k}") > 0, F.lit(k)) for k in CLASSES]))
    told = told.withColumn("found", found)
    kind = _joined(F.col("found"))
    # a decimal holds the ints and longs beside it, too
    beside = F.when(F.col("n_long") > 0, 20).when(F.col("n_int") > 0, 10).otherwise(1)
    decimal = F.concat(F.lit("decimal("), F.greatest("digits", beside).cast("string"), F.lit(",0)"))
    typed = F.when(kind == "decimal", decimal).when(kind == "long", "bigint").otherwise(kind)
    return told.select("position", "column", typed.alias("type"), "n_null", *[f"n_{k}" for k in CLASSES], "forced_by")


def inferred_schema(text: DataFrame) -> StructType:
    """The types of ``column_types`` as a schema, for a typed read."""
    rows = column_types(text).select("position", "column", "type").orderBy("position").collect()       # a row per column
    fields = StructType.fromDDL(", ".join(f"c{r.position} {r.type}" for r in rows)).fields if rows else []
    return StructType([StructField(r.column, f.dataType, True) for r, f in zip(rows, fields)])


def ingest_csv_inferred(spark: SparkSession, path: str) -> DataFrame:
    """Headered files with types from their values: one scan for the types, then
    a strict read with them."""
    text = spark.read.options(header="true", recursiveFileLookup="true").csv(path)
    return spark.read.options(header="true", recursiveFileLookup="true", mode="FAILFAST").schema(inferred_schema(text)).csv(path)
