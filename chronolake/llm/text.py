"""Expressions on whole texts that several operators share."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed value: a word is a longest run of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"


def text_of(column: Column) -> Column:
    """The text, null read as empty."""
    return F.coalesce(column.cast("string"), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else.

    A text of one byte per character is ASCII, where the fast ``lower`` does the same; only other
    texts pay for the character map.
    """
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    )


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def crc_remainder(key: Column, parts: int) -> Column:
    """crc32 of the id written as text, modulo ``parts``; a null id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), F.lit(parts))


def packed(rows: DataFrame) -> Column:
    """Every column of a table as one struct, so that helper columns can't clash with any of them."""
    return F.struct(*[rows[f"`{name}`"] for name in rows.columns])


def hash_sample(rows: DataFrame, by: str, key: str, most: int) -> DataFrame:
    """At most ``most`` rows for each value of ``by``: the first in the order of a hash of ``key``.

    Every value's rows are counted, and only hashes below a bound that keeps about three times the wanted
    number go on to be ranked: the ranking task of a value stays small however many rows there are.
    """
    counts = rows.groupBy(F.col(by).alias("_by")).agg(F.count(F.lit(1)).alias("_rows"))
    place = F.pmod(F.xxhash64(key), F.lit(1 << 40)) / F.lit(float(1 << 40))
    few = rows.join(counts, F.col(by).eqNullSafe(F.col("_by"))).where(place * F.col("_rows") < 3 * most + 50)
    ranked = Window.partitionBy(by).orderBy(F.xxhash64(key), key)
    return few.withColumn("_n", F.row_number().over(ranked)).where(F.col("_n") <= most).drop("_n", "_by", "_rows")
