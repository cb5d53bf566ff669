"""A3, mergeable form: exact distinct users as bit words over a dictionary of user numbers.

Every user has a number from 0 on; 64 numbers make a word, and a group's users are rows
(word, bits). Words merge by ``bit_or`` and count by ``bit_count``, both
primitive aggregates inside generated code, so partial results of any grain can be stored, merged and counted exactly without
meeting the rows again. A group of few users has a row for each, a dense one a 64th; a fixed 4 KiB
bitmap per 32,768 numbers would be several hundred times larger for the sparse panes of a minute. No group is
collected: a hot store spreads over its words.

Null users have no number and count as none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WORD, BITS = "user_word", "user_bits"
NUMBER_BUCKETS = 1024


def number_users(users: DataFrame, start: int = 0) -> DataFrame:
    """(user_id, user_no): the distinct non-null users of the one column of ``users``, numbered without gaps from ``start``.

    Two levels: ranks inside hash buckets, and a running sum over the sizes of the buckets. The same users get the
    same numbers, however they are spread.
    """
    users = users.select(F.col(users.columns[0]).alias("user_id")).filter("user_id IS NOT NULL").distinct()
    users = users.withColumn("_b", F.pmod(F.xxhash64("user_id"), F.lit(NUMBER_BUCKETS)).cast("int"))
    ranked = users.withColumn("_r", F.row_number().over(Window.partitionBy("_b").orderBy("user_id")))
    sizes = users.groupBy("_b").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("_b", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return ranked.join(sizes, "_b").select("user_id", (F.lit(start) + F.col("_before") + F.col("_r") - 1).cast("bigint").alias("user_no"))


def user_word(number: str = "user_no") -> Column:
    """The word that holds a user's bit."""
    return F.shiftright(F.col(number), 6).alias(WORD)


def user_bits(number: str = "user_no") -> Column:
    """Aggregate: the bits of the users of a group and word."""
    return F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), (F.col(number) % 64).cast("int"))).alias(BITS)


def merged_bits() -> Column:
    return F.bit_or(BITS).alias(BITS)


def counted_users() -> Column:
    """Aggregate over the words of a group: its distinct users."""
    return F.coalesce(F.sum(F.bit_count(BITS)), F.lit(0)).cast("bigint").alias("user_cnt")
