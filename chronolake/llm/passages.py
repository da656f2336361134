"""Repeated passages through sparse suffix arrays.

Of each text only the suffixes at minimiser positions are kept: of every WINDOW successive runs of GRAM
words, the run with the least hash. A passage of PASSAGE words (= WINDOW + GRAM - 1) or more that occurs
twice has the same minimisers in both places, so its suffixes are kept in both, about 4.5 % of all.

A kept suffix is a row: the hash of its run, the words behind it and, backwards, those before it, as far
as passages with this minimiser reach. The rows are dealt by run, and each partition sorts them to an array
of suffixes, in which those that start with the same run are neighbours. There matches are extended: for
every number of words to the left, the suffixes so lengthened are sorted and compared with their
neighbours again; equal ones over PASSAGE words are a repeat. That finds the longest extension to both
sides against all partners, not only against the neighbour with the longest common prefix.

A run that is in very many texts would fill one task. Such runs are counted first; their suffixes are
compared by fingerprints, first of all their words, then of single passages, and counted before the shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chronolake.llm.words import mix, rolled, word_hashes
from chronolake.session import stored

PASSAGE = 50  # words
GRAM = 8
WINDOW = PASSAGE - GRAM + 1
REACH = PASSAGE - GRAM  # words that a passage can hold on one side of its run
BYTES = 3  # of each word's hash in a row; the run itself is compared by 64 bits

# Suffixes of one run that one task compares.
MAX_SUFFIXES = 2000

# Bound of the list of frequent runs: the limit rises with the number of suffixes.
MAX_HOT_RUNS = 500_000

_NONE = -(2**63)  # stands for a missing id
_LEFT, _RIGHT = np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F)
_BASE = np.uint64(0x2545F4914F6CDD1D)


def minimisers(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs' hashes and, for the passage that starts at each word, the position of its minimiser."""
    runs = rolled(words, GRAM)
    if len(runs) < WINDOW:
        return runs, np.zeros(0, dtype=np.int64)
    least = np.lib.stride_tricks.sliding_window_view(runs, WINDOW).argmin(1)
    return runs, least + np.arange(len(least))


def _run_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        found = []
        for text in batch["text"]:
            runs, at = minimisers(word_hashes(text))
            found.append(runs[np.unique(at)])
        yield pd.DataFrame({"run": np.concatenate(found).view(np.int64) if found else []}, dtype="int64")


def _suffixes(hot: np.ndarray):
    """Rows (run, key, at, left, right) of the kept suffixes, without those of hot runs."""

    def run(batches):
        for batch in batches:
            columns: list[list] = [[], [], [], [], []]
            for key, text in zip(batch["key"], batch["text"]):
                words = word_hashes(text)
                runs, least = minimisers(words)
                if not len(least):
                    continue
                short = words.view(np.uint8).reshape(-1, 8)[:, :BYTES].copy()
                after, before = short.tobytes(), short[::-1].tobytes()
                at, first = np.unique(least, return_index=True)  # passages of one minimiser are successive
                last = np.append(first[1:], len(least)) - 1
                names = runs[at].view(np.int64)
                cold = ~np.isin(names, hot)
                n = len(words)
                for name, p, s, e in zip(*(x[cold].tolist() for x in (names, at, first, last))):
                    columns[0].append(name)
                    columns[1].append(key)
                    columns[2].append(p)
                    columns[3].append(before[BYTES * (n - p) : BYTES * (n - s)])
                    columns[4].append(after[BYTES * (p + GRAM) : BYTES * (e + PASSAGE)])
            yield pd.DataFrame(dict(zip(("run", "key", "at", "left", "right"), columns)))

    return run


def _hot_passages(hot: np.ndarray):
    """Rows (whole, key, start, prints) of hot suffixes: fingerprints of all their words, and of each passage."""

    def run(batches):
        for batch in batches:
            columns: list[list] = [[], [], [], []]
            for key, text in zip(batch["key"], batch["text"]):
                words = word_hashes(text)
                runs, least = minimisers(words)
                if not len(least):
                    continue
                at, first = np.unique(least, return_index=True)
                last = np.append(first[1:], len(least))
                prints = rolled(words, PASSAGE).view(np.int64)
                for i in np.flatnonzero(np.isin(runs[at].view(np.int64), hot)).tolist():
                    own = prints[first[i] : last[i]]
                    columns[0].append(int(mix(rolled(own.view(np.uint64), len(own)) + np.uint64(len(own))).view(np.int64)[0]))
                    columns[1].append(key)
                    columns[2].append(int(first[i]))
                    columns[3].append(own)
            yield pd.DataFrame(dict(zip(("whole", "key", "start", "prints"), columns)))

    return run


def _matrix(blobs: pd.Series) -> tuple[np.ndarray, np.ndarray]:
    """Words as rows of REACH numbers, and how many each row has."""
    sizes = np.array([len(b) for b in blobs], dtype=np.int64) // BYTES
    flat = np.frombuffer(b"".join(blobs), dtype=np.uint8).reshape(-1, BYTES).astype(np.uint64)
    values = flat[:, 0] | flat[:, 1] << np.uint64(8) | flat[:, 2] << np.uint64(16)
    full = np.zeros((len(blobs), REACH), dtype=np.uint64)
    full[np.arange(REACH)[None, :] < sizes[:, None]] = values
    return full, sizes


def _prefixes(words: np.ndarray) -> np.ndarray:
    """Hashes of the first 0, 1, ... REACH words of each row."""
    result = np.zeros((len(words), REACH + 1), dtype=np.uint64)
    for i in range(REACH):
        result[:, i + 1] = result[:, i] * _BASE + words[:, i] + np.uint64(1)
    return result


def _spans_of(rows: pd.DataFrame) -> pd.DataFrame:
    """Spans (key, start, end, first) of passages that suffixes of different texts share."""
    nothing = pd.DataFrame({c: [] for c in ("key", "start", "end", "first")}, dtype="int64")
    runs = rows["run"].to_numpy()
    near = runs[1:] == runs[:-1]
    if not near.any():
        return nothing
    rows = rows[np.append(near, False) | np.append(False, near)]
    left, n_left = _matrix(rows["left"])
    right, n_right = _matrix(rows["right"])
    to_left = np.arange(REACH + 1)
    lengthened = mix(_prefixes(left) * _LEFT + _prefixes(right)[:, ::-1] * _RIGHT + to_left.astype(np.uint64))
    lengthened ^= mix(rows["run"].to_numpy().view(np.uint64))[:, None]
    real = (to_left[None, :] <= n_left[:, None]) & (REACH - to_left[None, :] <= n_right[:, None])
    row, by = np.nonzero(real)
    values, keys = lengthened[real], rows["key"].to_numpy()[row]
    order = np.argsort(values, kind="stable")
    starts = np.flatnonzero(np.append(True, values[order][1:] != values[order][:-1]))
    low, high = np.minimum.reduceat(keys[order], starts), np.maximum.reduceat(keys[order], starts)
    group = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(order))))
    shared, first = np.zeros(len(order), dtype=bool), np.zeros(len(order), dtype=np.int64)
    shared[order], first[order] = (low < high)[group], low[group]
    row, by, first = row[shared], by[shared], first[shared]
    if not len(row):
        return nothing
    # Successive passages of a row make one span; more words to the left mean an earlier start.
    cut = np.flatnonzero(np.append(True, (row[1:] != row[:-1]) | (by[1:] != by[:-1] + 1)))
    end = np.append(cut[1:], len(row)) - 1
    at = rows["at"].to_numpy()[row[cut]]
    return pd.DataFrame(
        {
            "key": rows["key"].to_numpy()[row[cut]],
            "start": at - by[end],
            "end": at - by[cut] + PASSAGE,
            "first": np.minimum.reduceat(first, cut),
        }
    )


def _compared(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Walk the sorted suffixes; the last run of a batch waits for its rest in the next one."""
    rest = None
    for batch in batches:
        rows = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
        if not len(rows):
            continue
        runs = rows["run"].to_numpy()
        cut = int(np.searchsorted(runs, runs[-1]))
        yield _spans_of(rows.iloc[:cut])
        rest = rows.iloc[cut:]
    if rest is not None:
        yield _spans_of(rest)


def _hot_spans(texts: DataFrame, hot: np.ndarray) -> DataFrame:
    """Spans that hot suffixes share.

    Suffixes that agree in all their words (copies, one passage in many texts) are settled as a whole. Passage
    by passage go only the others, and of each settled group the text with the smallest id.
    """
    schema = "whole long, key long, start long, prints array<long>"
    rows = stored(texts.mapInPandas(_hot_passages(hot), schema), "hot-passages")
    least = [F.min("key").alias("first"), F.max("key").alias("last")]
    groups = rows.groupBy(F.col("whole").alias("g")).agg(*least).where(F.col("first") < F.col("last"))
    groups = stored(groups, "hot-groups")
    rows = stored(rows.join(groups.hint("merge"), F.col("whole") == F.col("g"), "left"), "hot-settled")
    length = F.size("prints")
    settled = rows.where(F.col("first").isNotNull())
    settled = settled.select("key", "start", (F.col("start") + length + PASSAGE - 1).alias("end"), "first")
    others = rows.where(F.col("first").isNull() | (F.col("key") == F.col("first")))
    prints = others.select("key", "start", F.posexplode("prints").alias("i", "print"))
    prints = prints.select("key", (F.col("start") + F.col("i")).alias("start"), "print")
    shared = prints.groupBy(F.col("print").alias("s_print")).agg(*least).where(F.col("first") < F.col("last"))
    shared = stored(shared, "hot-shared")
    prints = prints.join(shared.hint("merge"), F.col("print") == F.col("s_print"))
    return settled.unionByName(prints.select("key", "start", (F.col("start") + PASSAGE).alias("end"), "first"))


def repeated_passages(
    docs: DataFrame, text: str = "text", key: str = "doc_id", max_suffixes: int = MAX_SUFFIXES
) -> DataFrame:
    """The parts of texts that also occur in other texts, as passages of PASSAGE words or more.

    Returns one row for each maximal part of a text that such passages cover: ``key`` (long), ``start_word``
    and ``end_word`` (end exclusive; words count from 0), ``first_id``: a text with a smaller id that shares
    a passage of it, or the own id if there is none. The part is a repeat to remove where they differ.

    Words are runs of anything but ASCII white space, A-Z in lower case. A passage that only one text
    holds, even several times, is no repeat; nor are rows of the same id, which count as one text. Rows
    without an id are one text without id, taken as the smallest. Null, empty and shorter texts have no
    passages; texts of any length are read whole. An empty table gives an empty result, other columns are
    ignored whatever their names.
    """
    texts = docs.select(
        F.coalesce(F.col(f"`{key}`").cast("long"), F.lit(_NONE)).alias("key"),
        F.col(f"`{text}`").cast("string").alias("text"),
    )
    counts = texts.select("text").mapInPandas(_run_counts, "run long").groupBy("run").agg(F.count(F.lit(1)).alias("n"))
    counts = stored(counts.where(F.col("n") > max_suffixes), "frequent-runs")
    total = counts.agg(F.count(F.lit(1))).first()[0]
    least = max_suffixes
    while total > MAX_HOT_RUNS:  # more entries than may be sent to every task: raise the limit
        least *= 2
        total = counts.where(F.col("n") > least).count()
    hot = np.array(sorted(r["run"] for r in counts.where(F.col("n") > least).collect()), dtype=np.int64)
    rows = texts.mapInPandas(_suffixes(hot), "run long, key long, at int, left binary, right binary")
    rows = rows.repartition("run").sortWithinPartitions("run", "right", "left", "key")
    spans = rows.mapInPandas(_compared, "key long, start long, end long, first long")
    if len(hot):
        spans = spans.unionByName(_hot_spans(texts, hot))
    by_text = Window.partitionBy("key").orderBy("start", F.col("end").desc())
    reached = F.max("end").over(by_text.rowsBetween(Window.unboundedPreceding, -1))
    spans = spans.withColumn("new", F.coalesce(F.col("start") >= reached, F.lit(True)).cast("int"))
    spans = spans.withColumn("part", F.sum("new").over(by_text.rowsBetween(Window.unboundedPreceding, 0)))
    merged = spans.groupBy("key", "part").agg(
        F.min("start").alias("start_word"), F.max("end").alias("end_word"), F.min("first").alias("first_id")
    )
    none = F.lit(_NONE)
    return merged.select(
        F.nullif("key", none).alias(key), "start_word", "end_word", F.nullif("first_id", none).alias("first_id")
    )
