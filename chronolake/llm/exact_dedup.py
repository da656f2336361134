"""Exact dedup by content sort.

``repartitionByRange`` samples splitters and deals the rows into ranges of the normalised texts' heads; behind
a common head (a licence, say) a fingerprint cuts on, so that the driver sees short splitters only and no
range is forced to hold all texts of one head. The window's sort (external: it spills) places equal texts
next to each other, and the window closes a group where a text differs from its neighbour: whole texts are
compared, no fingerprint decides.

A text with very many copies would fill one range. Such texts are found first by a combined count of
fingerprints of a coarser text (full lower case: equal texts stay equal), and only their rows get a
salt, a second sort key. Each salted chunk is then a group of its own; one row for each chunk meets the
other chunks of its text in a second, small content sort.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronolake.llm.text import ascii_lower, packed, text_of
from chronolake.session import stored

# Copies of one text that one task sorts and buffers.
MAX_COPIES = 256

# Characters of a text that the splitters of the ranges hold.
HEAD = 64

# Bound of the broadcast list of texts that are salted: the limit of copies rises with the table, so that
# no more than this many texts can exceed it.
MAX_HOT_TEXTS = 500_000


def exact_dedup(
    docs: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    max_copies: int = MAX_COPIES,
    keep_row: bool = True,
) -> DataFrame:
    """Group equal texts; of each group the row with the largest id stays.

    Returns one row for each row of ``docs``: ``row`` (all its columns; only the id with
    ``keep_row=False``), ``keep_id``, ``group_size`` (long), ``kept`` (boolean), ``text_sha256``.

    Null texts count as empty texts, and all empty texts are one group. Texts are equal if they are
    identical after lower-casing A-Z. Null ids come last; of repeated rows with the same id exactly
    one stays. An empty table gives an empty result. Columns of any name may be present.
    """
    rows = docs.select(packed(docs if keep_row else docs.select(key, text)).alias("row"))
    raw = text_of(F.col(f"row.`{text}`"))
    coarse = F.xxhash64(F.lower(raw))
    limit = max(max_copies, docs.count() // MAX_HOT_TEXTS)
    hot = stored(
        rows.groupBy(coarse.alias("hot_text")).agg(F.count(F.lit(1)).alias("copies")).where(F.col("copies") > limit),
        "hot-texts",
    )
    salted = not hot.isEmpty()
    rows = rows.withColumns({"head": ascii_lower(F.left(raw, F.lit(HEAD))), "coarse": coarse})
    groups = ["head", "coarse"]
    if salted:
        chunks = F.ceil(F.col("copies") / F.lit(limit)).cast("int")
        salts = F.broadcast(hot.select("hot_text", chunks.alias("chunks")))
        spread = F.pmod(F.xxhash64(F.col(f"row.`{key}`")), F.col("chunks")).cast("int")
        rows = rows.join(salts, F.col("coarse") == F.col("hot_text"), "left")
        rows = rows.select("row", *groups, F.coalesce(spread, F.lit(-1)).alias("salt"))
        groups.append("salt")  # only here: a constant would hide that the window needs no second shuffle

    # The whole text is normalised behind the shuffle; equal texts agree in all columns of the ranges.
    ranged = rows.repartitionByRange(*[F.col(c).asc() for c in groups]).withColumn("norm", ascii_lower(raw))
    grouped = _neighbours(ranged, [*groups, "norm"], F.col(f"row.`{key}`"), F.lit(1))
    if not salted:
        grouped = grouped.withColumn("salt", F.lit(-1))
    sha = F.sha2(F.col("norm").cast("binary"), 256)
    result = F.col("row") if keep_row else F.struct(F.col(f"row.`{key}`").alias(key))
    grouped = grouped.select(
        result.alias("row"),
        "salt",
        "keep_id",
        "group_size",
        (F.col("place") == 1).alias("kept"),
        sha.alias("text_sha256"),
        F.when((F.col("place") == 1) & (F.col("salt") >= 0), F.col("norm")).alias("norm"),
    )
    columns = ["row", "keep_id", "group_size", "kept", "text_sha256"]
    if not salted:
        return grouped.select(columns)

    grouped = stored(grouped, "content-sort")
    tops = grouped.where(F.col("norm").isNotNull()).select("norm", "salt", "text_sha256", "keep_id", "group_size")
    tops = tops.withColumn("head", F.left("norm", F.lit(HEAD)))
    whole = _neighbours(
        tops.withColumnRenamed("keep_id", "top").withColumnRenamed("group_size", "part").repartitionByRange("head", "text_sha256"),
        ["head", "text_sha256", "norm"],
        F.col("top"),
        F.col("part"),
    )
    # At most two chunks for each ``limit`` rows: bounded by 2 * MAX_HOT_TEXTS rows of 100 bytes.
    whole = F.broadcast(
        whole.select(
            F.unhex("text_sha256").alias("w_sha"),
            F.col("salt").alias("w_salt"),
            F.col("keep_id").alias("w_keep"),
            F.col("group_size").alias("w_size"),
            (F.col("place") == 1).alias("w_first"),
        )
    )
    same = (F.unhex("text_sha256") == F.col("w_sha")) & (F.col("salt") == F.col("w_salt"))
    joined = grouped.drop("norm").join(whole, same, "left")
    hot_row = F.col("salt") >= 0
    return joined.select(
        "row",
        F.when(hot_row, F.col("w_keep")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.when(hot_row, F.col("w_size")).otherwise(F.col("group_size")).alias("group_size"),
        F.when(hot_row, F.col("kept") & F.col("w_first")).otherwise(F.col("kept")).alias("kept"),
        "text_sha256",
    )


def _neighbours(rows: DataFrame, groups: list[str], key: Column, weight: Column) -> DataFrame:
    """Add place (1: largest key), keep_id and group_size for runs of equal ``groups``."""
    ordered = Window.partitionBy(*groups).orderBy(key.desc_nulls_last())
    everything = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return rows.withColumns(
        {
            "place": F.row_number().over(ordered),
            "keep_id": F.first(key).over(everything),
            "group_size": F.sum(weight).over(everything).cast("long"),
        }
    )
