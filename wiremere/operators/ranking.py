"""First row and top rows per key, safe for keys that hold a large part of the table.

Both work on narrow columns: keys, order and nothing else is sorted and shuffled. What they choose is
stored, so Spark knows its size when it joins it to the rows: little is sent to where the rows lie,
and only for much do the rows move. Orders are ascending columns.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wiremere.session import materialise


def first_keys(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Per key the smallest order, as a struct `first_at`; map tasks merge a key's rows before the shuffle."""
    return df.select(*keys, F.struct(*order).alias("at")).groupBy(*keys).agg(F.min("at").alias("first_at"))


def first_per_key(df: DataFrame, keys: list[str], order: list[Column], unique: bool = False) -> DataFrame:
    """One row per key, the first in the given order; a null key is a key of its own.

    Rows that tie in the order must be equal; `unique` says that no two rows of the table do.
    """
    return pick(df, first_keys(df, keys, order), keys, order, unique)


def pick(df: DataFrame, chosen: DataFrame, keys: list[str], order: list[Column], unique: bool = False) -> DataFrame:
    """The rows of df that `chosen` (keys, first_at) names, one for each.

    Where the order is unique in the whole table it names the rows alone: keys are not worked out a
    second time, and every winner moves once at most.
    """
    named = [] if unique else keys
    chosen = materialise(chosen).select(*[F.col(k).alias(f"_of_{k}") for k in named], F.col("first_at").alias("_first"))
    rows = df.withColumn("first_at", F.struct(*order))
    same = rows["first_at"].eqNullSafe(chosen["_first"])
    for k in named:
        same &= rows[k].eqNullSafe(chosen[f"_of_{k}"])
    found = rows.join(chosen, same, "left_semi")
    return (found if unique else found.dropDuplicates([*keys, "first_at"])).drop("first_at")


def top_per_key(df: DataFrame, keys: list[str], order: str, n: int) -> DataFrame:
    """The first n rows per key by a column that is unique in it, by the same plan for any n.

    A key's rows are dealt over as many salts as there are shuffle partitions and cut to n in each;
    the second cut sees n rows per salt at most. It gives the key's last value, a table of one row
    per key, which the rows are then compared with where they lie.
    """
    salts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # The salt depends on the row alone, so a retried task puts a row in the same place.
    narrow = df.select(*keys, order).withColumn("_salt", F.pmod(F.xxhash64(*keys, order), F.lit(salts)))
    for by in ([*keys, "_salt"], keys):
        rank = F.row_number().over(Window.partitionBy(*by).orderBy(order))
        narrow = narrow.withColumn("_rank", rank).filter(F.col("_rank") <= n)
    last = narrow.groupBy(*[F.col(k).alias(f"_last_{k}") for k in keys]).agg(F.max(order).alias("_last"))
    last = materialise(last)
    same = [df[k].eqNullSafe(last[f"_last_{k}"]) for k in keys]
    # A null comes first in its key, so it is among the first n of any n.
    found = df.join(last, [*same, df[order].isNull() | (df[order] <= last["_last"])])
    return found.select(*[df[c] for c in df.columns])
