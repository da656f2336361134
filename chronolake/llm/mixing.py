"""Mix sources to target weights by systematic sampling.

Within a source, every document has the same expected number of copies (target / size of the source).
The documents stand in the order (size, id); the expected copies are summed along it, one random offset
is added, and a document is emitted once for each integer that its stretch crosses. As neighbours have
about the same size, the words taken stay within about one long document of the target. Few long documents
can make that much, so the offset is drawn OFFSETS times, and the draw whose words come nearest is used.

A source may hold a third of all rows, so no task numbers a whole source. Narrow rows are range-partitioned
by (source, size, id); each piece counts its rows, the counts are summed over the pieces of a source (one
row each), and rows are numbered within their piece only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronolake.llm.ranks import numbered
from chronolake.llm.text import packed, text_of, word_count
from chronolake.session import stored

# Copies of its words that a source, and so a document, may give at most.
MAX_REPEATS = 3

# Weights of the sources in the order of their names, repeating.
WEIGHTS = (1, 2, 3)

SEED = "mixing"
OFFSETS = 16  # random offsets that are drawn for each source


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """Words to take from each source, from rows (source, size).

    Sources share the sum of all sizes by weight, but none gives more than ``max_repeats`` times its size;
    what it can't give is shared again among the others. That ends at one water level: a source gets
    min(cap, weight * level). Sorted by cap / weight, the full sources are a prefix, and running sums give
    the level. Works on one row for each source.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("source_rows"))
    by_name = Window.partitionBy(F.lit(0)).orderBy(F.col("source").asc_nulls_last())
    place = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights)))
    ranked = totals.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (place + 1).cast("int")))
    ranked = ranked.withColumn("cap", F.col("source_size") * F.lit(max_repeats).cast("long"))
    fill = Window.partitionBy(F.lit(0)).orderBy(
        (F.col("cap").cast("double") / F.col("weight")).asc(), F.col("source").asc_nulls_last()
    )
    everything = Window.partitionBy(F.lit(0))
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    after = fill.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    # The level if exactly the sources before this one are full. The first that then stays below its cap sets it;
    # behind that one the levels only fall.
    ranked = ranked.withColumns(
        {
            "rest": F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0)),
            "open_weight": F.sum("weight").over(after),
        }
    )
    level = F.col("rest").cast("double") / F.col("open_weight")
    fits = level * F.col("weight") <= F.col("cap")
    ranked = ranked.withColumn("level", F.max(F.when(fits, level)).over(everything))
    target = F.least(F.col("cap").cast("double"), F.col("weight") * F.col("level"))
    return ranked.select("source", "source_size", "source_rows", "weight", target.alias("target"))


def offset(source: Column, draw: int, seed: str = SEED) -> Column:
    """A random offset of a source in [0, 1), from the digest of its name and the number of the draw."""
    digest = F.md5(F.concat(F.lit(f"{seed}:{draw}:"), F.coalesce(source, F.lit("\u0000"))).cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long").cast("double") / F.lit(float(2**52))


def _copies(start: Column) -> Column:
    """Integers crossed by the stretch of the row, which ends at rank * expected."""
    return (F.floor(F.col("rank") * F.col("expected") + start) - F.floor((F.col("rank") - 1) * F.col("expected") + start)).cast("long")


def mix(
    docs: DataFrame,
    text: str = "text",
    source: str = "source",
    key: str = "doc_id",
    weights: tuple[int, ...] = WEIGHTS,
    max_repeats: int = MAX_REPEATS,
) -> DataFrame:
    """How often each document enters the mix.

    Returns one row for each row of ``docs``: ``key``, ``size`` (words), ``source_size``, ``target``
    (double, of its source), ``copies`` and ``taken`` (words: copies * size), all long.

    A null text has size 0. A null source is a source of its own, last in the order. A source whose texts
    are all empty has target 0 and gives no copies. Of equal (source, size), the smaller id comes first,
    null ids foremost; repeated rows count one by one. An empty table gives an empty result.
    """
    found = _mixed(_sizes(docs, f"`{text}`", f"`{source}`", f"`{key}`"), ("key",), weights, max_repeats)
    return found.select(F.col("key").alias(key), "size", "source_size", "target", "copies", "taken")


def _sizes(rows: DataFrame, text: str, source: str, key: str, *more: Column) -> DataFrame:
    """Narrow rows (key, source, size) and ``more``; ``text``, ``source`` and ``key`` are expressions."""
    return rows.select(
        F.col(key).alias("key"),
        F.col(source).cast("string").alias("source"),
        word_count(text_of(F.col(text))).alias("size"),
        *more,
    )


def _mixed(
    narrow: DataFrame, order: tuple[str, ...], weights: tuple[int, ...] = WEIGHTS, max_repeats: int = MAX_REPEATS
) -> DataFrame:
    """The narrow rows with source_size, target, copies and taken; rows of one size stand in ``order``."""
    narrow = stored(narrow, "mix-sizes")
    targets = source_targets(narrow, weights, max_repeats).withColumnRenamed("source", "t_source")
    ranked = numbered(narrow, "source", "size", *order)
    ranked = ranked.join(targets, F.col("source").eqNullSafe(F.col("t_source"))).drop("t_source")
    expected = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    ranked = stored(ranked.withColumn("expected", expected), "mix-ranks")
    draws = [offset(F.col("source"), i) for i in range(OFFSETS)]
    drawn = ranked.groupBy(F.col("source").alias("d_source"), F.col("target").alias("d_target")).agg(
        *[F.sum(F.col("size") * _copies(u)).alias(f"w{i}") for i, u in enumerate(draws)]
    )
    tried = [
        F.struct(F.abs(F.col(f"w{i}") - F.col("d_target")).alias("off"), F.lit(i).alias("i"), u.alias("u"))
        for i, u in enumerate(offset(F.col("d_source"), i) for i in range(OFFSETS))
    ]
    drawn = drawn.select("d_source", F.array_min(F.array(*tried))["u"].alias("start"))
    ranked = ranked.join(drawn, F.col("source").eqNullSafe(F.col("d_source")))
    return ranked.withColumn("copies", _copies(F.col("start"))).select(
        *narrow.columns,
        "source_size",
        "target",
        "copies",
        (F.col("copies") * F.col("size")).alias("taken"),
    )


def mixed_rows(
    docs: DataFrame, text: str = "text", source: str = "source", key: str = "doc_id", **options
) -> DataFrame:
    """The rows of ``docs`` repeated as often as the mix takes them.

    Each row is taken as often as the mix says for it, whatever its id. Of equal (source, size, id), the order
    is that of a hash of the text.
    """
    rows = docs.select(packed(docs).alias("whole")).withColumn("row", F.monotonically_increasing_id())
    rows = stored(rows, "mix-rows")  # fixes the row numbers: ids may be null or repeated
    tie = F.xxhash64(F.col(f"whole.`{text}`")).alias("tie")
    narrow = _sizes(rows, f"whole.`{text}`", f"whole.`{source}`", f"whole.`{key}`", tie, F.col("row"))
    copies = _mixed(narrow, ("key", "tie", "row"), **options).where("copies > 0")
    copies = copies.select(F.col("row").alias("m_row"), "copies")
    taken = rows.join(copies, F.col("row") == F.col("m_row"))
    return taken.select("whole", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select("whole.*")
