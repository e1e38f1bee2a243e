"""Exploratory summaries."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DataType, NumericType, StructType

from sigloom.functions.signal import mean_power
from sigloom.operators.preprocessing import values


def numeric_summary(df: DataFrame) -> DataFrame:
    """(channel, minimum, maximum, mean, std) of all I, all Q and the rows' mean powers; std is the
    population's. One explode for I and Q, and one aggregate of each kind."""
    pairs = values(df)
    stats = lambda c: [F.min(c).alias("minimum"), F.max(c).alias("maximum"), F.avg(c).alias("mean"), F.stddev_pop(c).alias("std")]
    powers = df.select(mean_power(F.col("i"), F.col("q")).alias("p"))
    long = pairs.select(F.stack(F.lit(2), F.lit("i"), F.col("x"), F.lit("q"), F.col("y")).alias("channel", "v"))
    both = long.unionByName(powers.select(F.lit("power").alias("channel"), F.col("p").alias("v")))
    return both.groupBy("channel").agg(*stats("v"))


def class_distribution(df: DataFrame) -> DataFrame:
    return df.groupBy("label").agg(F.count(F.lit(1)).alias("n"))


#: Kinds of labels by the type of their column.
KINDS = {"string": "str", "tinyint": "int", "smallint": "int", "int": "int", "bigint": "int", "float": "float", "double": "float", "boolean": "bool"}


def typed_distribution(df: DataFrame, label: str = "label", kind: Column | None = None) -> DataFrame:
    """(kind, label, n), sorted by kind, then by the label as text, so that int 10 comes before 2.

    A column has one type, which gives the kind; a table of labels of several types holds them as text, and
    ``kind`` says which each one is. A null label has the kind NoneType."""
    held = KINDS.get(df.schema[label].dataType.simpleString(), df.schema[label].dataType.simpleString())
    named = F.when(F.col(label).isNull(), "NoneType").otherwise(F.lit(held) if kind is None else kind)
    counts = df.groupBy(named.alias("kind"), F.col(label).cast("string").alias("label")).agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy("kind", "label")


def snr_distribution(df: DataFrame) -> DataFrame:
    """Counts by SNR; all that is not finite is one row with a null SNR."""
    finite = F.when(~F.isnan("snr_db") & (F.abs("snr_db") < float("inf")), F.col("snr_db"))
    return df.groupBy(finite.alias("snr_db")).agg(F.count(F.lit(1)).alias("n"))


def length_distribution(df: DataFrame) -> DataFrame:
    return df.groupBy(F.size("i").alias("signal_length")).agg(F.count(F.lit(1)).alias("n"))


def finite_statistics(df: DataFrame, column: Column, keep: Sequence[str] = ("sample_id",)) -> DataFrame:
    """Of each row's array: count, finite count, and min, max, mean, population std of what is finite."""
    exploded = df.select(*keep, F.explode(column).alias("v")).withColumn("f", F.when(~F.isnan("v") & (F.abs("v") < float("inf")), F.col("v").cast("double")))
    return exploded.groupBy(*keep).agg(F.count(F.lit(1)).alias("n"), F.count("f").alias("finite"), F.min("f").alias("minimum"), F.max("f").alias("maximum"), F.avg("f").alias("mean"), F.stddev_pop("f").alias("std"))


def _pair(kind: DataType) -> bool:
    """A complex number: a struct of two numbers, re and im or i and q."""
    return isinstance(kind, StructType) and kind.names in (["re", "im"], ["i", "q"]) and all(isinstance(f.dataType, NumericType) for f in kind)


def _leaves(name: str, column: Column, kind: DataType) -> Iterator[tuple[str, Column]]:
    """(path, array of doubles) of every number below a column: structs by field, arrays flattened,
    complex pairs as magnitudes."""
    if _pair(kind):
        a, b = (column[f].cast("double") for f in kind.names)
        yield name, F.array(F.hypot(a, b))
    elif isinstance(kind, StructType):
        for field in kind:
            yield from _leaves(f"{name}.{field.name}", column[field.name], field.dataType)
    elif isinstance(kind, ArrayType):
        if isinstance(kind.elementType, StructType) and not _pair(kind.elementType):
            for field in kind.elementType:
                inner = ArrayType(field.dataType)
                yield from _leaves(f"{name}.{field.name}", F.transform(column, lambda v, f=field.name: v[f]), inner)
        elif isinstance(kind.elementType, ArrayType):
            yield from _leaves(name, F.flatten(column), kind.elementType)
        elif _pair(kind.elementType):
            a, b = kind.elementType.names
            yield name, F.transform(column, lambda v: F.hypot(v[a].cast("double"), v[b].cast("double")))
        elif isinstance(kind.elementType, (NumericType, BooleanType)):
            yield name, F.transform(column, lambda v: v.cast("double"))
    elif isinstance(kind, (NumericType, BooleanType)):
        yield name, F.array(column.cast("double"))


def walked_statistics(df: DataFrame, columns: Sequence[str], keep: str = "sample_id") -> DataFrame:
    """(keep, field, n, finite, minimum, maximum, mean, std) of every number below the columns, however they are
    nested: a row a field. Complex pairs count by magnitude; a field without finite values has nulls; text and
    dates are no numbers, and null arrays are empty. Rows of one ``keep`` count together."""
    leaves = [leaf for c in columns for leaf in _leaves(c, F.col(f"`{c}`"), df.schema[c].dataType)]
    if not leaves:
        raise ValueError("no numbers below the columns")
    fields = F.array(*[F.struct(F.lit(name).alias("field"), F.coalesce(values, F.array().cast("array<double>")).alias("v")) for name, values in leaves])
    rows = df.select(F.col(keep), F.explode(fields).alias("f")).select(keep, "f.field", F.explode_outer("f.v").alias("v"))
    v = F.when(~F.isnan("v") & (F.abs("v") < float("inf")), F.col("v"))
    return rows.groupBy(keep, "field").agg(F.count("v").alias("n"), F.count(v).alias("finite"), F.min(v).alias("minimum"), F.max(v).alias("maximum"), F.avg(v).alias("mean"), F.stddev_pop(v).alias("std"))


def block_offsets(blocks: DataFrame, n: str = "n", order: str = "block") -> DataFrame:
    """(block, n, first, last): where each block of rows begins and ends, blocks in order. One row a block."""
    from pyspark.sql import Window

    w = Window.orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    first = F.coalesce(F.sum(n).over(w), F.lit(0))
    return blocks.withColumn("first", first).withColumn("last", F.col("first") + F.col(n) - 1)
