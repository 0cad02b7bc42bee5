"""Training features as sparse vectors over a stored vocabulary.

A row's features come from numbers (null counts as 0), from maps (each entry is a
feature; keys are learned from the rows) and from categories (one feature per
value, null is ``unknown``).  All of them are first written one per row, as
(column, name, number).  The vocabulary is the distinct (column, name) with dense
numbers, given by a range-partitioned running count; it is a table, so neither a
column nor an entry on the driver belongs to a category, and a column may have
millions of them.  Features that are 0 are not stored.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import partial

from pyspark.ml.classification import LogisticRegressionModel
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.joins import probe_join
from ..operators.ordering import running_totals
from ..session import cut_lineage

UNKNOWN = "unknown"
ENTRY = "struct<column:string,name:string,number:double>"


def entries(df: DataFrame, key: str, numeric: Sequence[str] = (), mapped: Sequence[str] = (), categories: Sequence[str] = ()) -> DataFrame:
    """``key``, ``column``, ``name`` and ``number``, one row per feature; ``key`` is unique in ``df``."""

    def entry(column: str, name: Column, number: Column) -> Column:
        return F.struct(F.lit(column).alias("column"), name.alias("name"), F.coalesce(number.cast("double"), F.lit(0.0)).alias("number"))

    parts = [F.array(*[entry(c, F.lit(""), F.col(c)) for c in numeric]).cast(f"array<{ENTRY}>")]
    parts += [F.array(*[entry(c, F.coalesce(F.col(c).cast("string"), F.lit(UNKNOWN)), F.lit(1.0)) for c in categories]).cast(f"array<{ENTRY}>")]
    for c in mapped:
        listed = F.transform(F.map_entries(c), partial(lambda column, e: entry(column, e["key"], e["value"]), c))
        parts.append(F.coalesce(listed, F.array()).cast(f"array<{ENTRY}>"))
    return df.select(key, F.explode(F.concat(*parts)).alias("_e")).select(key, "_e.*")


def feature_name(column: Column, name: Column, mapped: Sequence[str] = ()) -> Column:
    """A number has the name of its column, a map entry its key, a category ``column_value``."""
    joined = F.concat(column, F.lit("_"), name)
    return F.when(name == "", column).when(column.isin(list(mapped)), name).otherwise(joined)


def vocabulary(long: DataFrame, mapped: Sequence[str] = ()) -> DataFrame:
    """``column``, ``name``, ``feature`` and dense ``index`` from 0, in the order of column and name; on disk."""
    distinct = long.select("column", "name").distinct()
    numbered = running_totals(distinct, [F.col("column"), F.col("name")], "index")
    return cut_lineage(numbered.select("column", "name", feature_name(F.col("column"), F.col("name"), mapped).alias("feature"), (F.col("index") - 1).cast("int").alias("index")))


def sparse_rows(long: DataFrame, words: DataFrame, key: str, keep: DataFrame) -> DataFrame:
    """``keep`` (one row per ``key``) with ``indices`` and ``values`` of the features that are not 0; names beyond ``words`` are left out."""
    found = probe_join(long.where("number <> 0"), words.select("column", "name", "index"), ["column", "name"], "inner")
    pair = F.array_sort(F.collect_list(F.struct("index", "number")))  # as many as the row has features
    rows = found.groupBy(key).agg(pair.alias("_p"))
    joined = keep.join(rows, key, "left")  # unique on both sides
    pairs = F.coalesce(F.col("_p"), F.array().cast("array<struct<index:int,number:double>>"))
    return joined.select(*keep.columns, F.transform(pairs, lambda p: p["index"]).alias("indices"), F.transform(pairs, lambda p: p["number"]).alias("values"))


def write_features(rows: DataFrame, size: int, path: str) -> DataFrame:
    """Store ``sparse_rows`` in the form of vectors of length ``size``, and read them back with a ``features`` column.

    A vector is stored as a struct of its kind (0: sparse), size, indices and values, so building it needs no function
    beyond SQL's.
    """
    parts = F.struct(F.lit(0).cast("byte").alias("type"), F.lit(size).alias("size"), F.col("indices"), F.col("values"))
    stored = rows.withColumn("features", parts).drop("indices", "values")
    stored.write.mode("errorifexists").parquet(path)
    fields = [f if f.name != "features" else T.StructField("features", VectorUDT()) for f in stored.schema.fields]
    return rows.sparkSession.read.schema(T.StructType(fields)).parquet(path)


def weights_table(spark: SparkSession, model: LogisticRegressionModel, words: DataFrame) -> DataFrame:
    """``feature`` and ``weight`` of a fitted model: its coefficients, which the driver holds as one array, joined to the vocabulary."""
    weights = spark.createDataFrame(list(enumerate(model.coefficients.toArray().tolist())), "index int, weight double")
    return probe_join(words, weights, "index", "inner").select("feature", "weight")
