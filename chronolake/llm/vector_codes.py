"""Product-quantisation codes with memoised grid cells.

A vector is cut into equal parts, and each part is coded as the index of the nearest entry of its
codebook. Instead of comparing a part with all entries, it is hashed to its coarse grid cell. The first
part in a cell compares the whole box with the entries: an entry whose least distance to the box exceeds
another one's greatest distance is dominated, it is nearest to no point in the box. The entries left are
kept with the cell, and only they are evaluated, exactly and in integers. The grid's step decides how much
is skipped, never the result.

Each round of training is one pass over the stored vectors with the codebooks in the task. A task sends
one sum for each entry and component, so what is shuffled and what the driver sees (the codebooks) does not
grow with the vectors of a task, and neither does the memory: a batch, the codebooks, and a memo that is
emptied at ``MAX_CELLS``.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronolake.session import stored

SCALE = 1024
PARTS = 4
ENTRIES = 256
ROUNDS = 4
MAX_CELLS = 50_000  # cells that a task remembers for each part
PAIRS = 100_000  # exact distances computed at a time
CELLS_AT_ONCE = 64
LARGEST = 2**61  # components beyond it are an error


@dataclass(frozen=True)
class Codebooks:
    """Entries of each part as integers, shape (parts, entries, components of a part)."""

    entries: np.ndarray
    step: int

    def sha256(self) -> str:
        return hashlib.sha256(",".join(str(x) for x in self.entries.ravel().tolist()).encode()).hexdigest()


def _grid_step(entries: np.ndarray) -> int:
    """A third of the mean deviation of the entries' components: cells smaller than the gaps between entries."""
    return max(1, int(entries.astype(np.float64).std(axis=1).mean() / 3)) if entries.size else 1


class _Cells:
    """Nearest entries of one part, by grid cell."""

    def __init__(self, entries: np.ndarray, step: int):
        self.entries, self.step = entries, step
        self.slots: dict[bytes, int] = {}
        self.left = np.zeros((0, len(entries)), dtype=bool)

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The index of each point's nearest entry (ties: the lower one) and its squared distance."""
        entries = self.entries
        most = int(max(np.abs(points).max(initial=0), np.abs(entries).max(initial=0))) + self.step
        if (8 * most) ** 2 * max(1, points.shape[1]) >= 2**63:  # exact in Python's integers
            points, entries = points.astype(object), entries.astype(object)
        slots = self._slots_of(points, entries)
        owner, entry = np.nonzero(self.left[slots])
        index, error = np.zeros(len(points), dtype=np.int64), np.zeros(len(points), dtype=points.dtype)
        distance = np.empty(len(owner), dtype=points.dtype)
        for start in range(0, len(owner), PAIRS):
            some = slice(start, start + PAIRS)
            apart = points[owner[some]] - entries[entry[some]]
            distance[some] = (apart * apart).sum(1)
        # Pairs come by point, then by entry; every point has one at least.
        first = np.flatnonzero(np.diff(owner, prepend=-1))
        if len(first):
            error[:] = np.minimum.reduceat(distance, first)
            best = np.flatnonzero(distance == error[owner])
            best = best[np.diff(owner[best], prepend=-1) > 0]
            index[:] = entry[best]
        return index, error

    def _slots_of(self, points: np.ndarray, entries: np.ndarray) -> np.ndarray:
        cells = points // self.step
        names = [row.tobytes() for row in np.ascontiguousarray(cells.astype(np.int64))]
        new = {name: i for i, name in enumerate(names) if name not in self.slots}
        if len(self.slots) + len(new) > MAX_CELLS:
            self.slots, self.left = {}, self.left[:0]
            new = {name: i for i, name in enumerate(names)}
        if new:
            at = list(new.values())
            parts = [self._undominated(cells[at[i : i + CELLS_AT_ONCE]], entries) for i in range(0, len(at), CELLS_AT_ONCE)]
            self.slots.update(zip(new, range(len(self.left), len(self.left) + len(at))))
            self.left = np.concatenate([self.left, *parts])
        return np.array([self.slots[name] for name in names], dtype=np.int64)

    def _undominated(self, cells: np.ndarray, entries: np.ndarray) -> np.ndarray:
        # In half units, so that the middle of a box is an integer, too.
        middle = 2 * cells * self.step + (self.step - 1)
        doubled = 2 * entries
        if entries.dtype != object and 16 * self._most(cells, entries) ** 2 * entries.shape[1] < 2**53:
            middle, doubled = middle.astype(np.float64), doubled.astype(np.float64)  # exact, and faster
        apart = np.abs(doubled[None] - middle[:, None, :])
        across, outside = apart + (self.step - 1), np.maximum(apart - (self.step - 1), 0)
        greatest = (across * across).sum(2) if entries.dtype == object else np.einsum("ijk,ijk->ij", across, across)
        least = (outside * outside).sum(2) if entries.dtype == object else np.einsum("ijk,ijk->ij", outside, outside)
        return (least <= greatest.min(1)[:, None]).astype(bool)

    def _most(self, cells: np.ndarray, entries: np.ndarray) -> int:
        return int(max((np.abs(cells).max(initial=0) + 1) * self.step, np.abs(entries).max(initial=0)))


def _matrices(blobs, parts: int) -> np.ndarray:
    """Rows of packed components as (rows, parts, components)."""
    flat = np.frombuffer(b"".join(blobs), dtype="<i8")
    return flat.reshape(len(blobs), parts, -1)


def _names(batch: pd.DataFrame) -> pd.DataFrame:
    """Ids and labels travel as text: pandas would read longs with nulls as doubles."""
    names = batch[["vec_id", "label"]]
    return names.astype(object).where(names.notna(), None)


def _padded(width: int):
    def run(batches):
        for batch in batches:
            blobs = []
            for values in batch["parts"]:
                row = np.zeros(width, dtype="<i8")
                row[: len(values)] = values
                blobs.append(row.tobytes())
            yield _names(batch).assign(vec=blobs)

    return run


def _sums(shared):
    def run(batches):
        books: Codebooks = shared.value
        parts, size, width = books.entries.shape
        cells = [_Cells(books.entries[p], books.step) for p in range(parts)]
        totals = np.zeros((parts, size, width), dtype=object)
        counts = np.zeros((parts, size), dtype=np.int64)
        for batch in batches:
            if not len(batch):
                continue
            points = _matrices(batch["vec"], parts)
            for p in range(parts):
                index, _ = cells[p].nearest(points[:, p])
                counts[p] += np.bincount(index, minlength=size)
                order = np.argsort(index, kind="stable")
                found, start = np.unique(index[order], return_index=True)
                own = points[order, p]
                if int(np.abs(own).max(initial=0)) * len(own) >= 2**63:
                    own = own.astype(object)
                totals[p, found] += np.add.reduceat(own, start, axis=0)
        part, entry = np.nonzero(counts)
        if not len(part):
            return
        yield pd.DataFrame(
            {
                "part": np.repeat(part, width),
                "entry": np.repeat(entry, width),
                "place": np.tile(np.arange(width), len(part)),
                "total": [str(x) for x in totals[part, entry].ravel()],
                "rows": np.repeat(counts[part, entry], width),
            }
        )

    return run


def _coded(shared):
    def run(batches):
        books: Codebooks = shared.value
        parts = books.entries.shape[0]
        cells = [_Cells(books.entries[p], books.step) for p in range(parts)]
        for batch in batches:
            if not len(batch):
                continue
            points = _matrices(batch["vec"], parts)
            found = [cells[p].nearest(points[:, p]) for p in range(parts)]
            error = np.sum([e.astype(object) for _, e in found], axis=0)
            if max(error) >= 2**63:
                raise ValueError("an error doesn't fit a long")
            codes = ["".join(f"{int(index[i]):02x}" for index, _ in found) for i in range(len(batch))]
            yield _names(batch).assign(code=codes, error=error.astype(np.int64))

    return run


def _stored_vectors(vectors: DataFrame, key: str, vector: str, label: str, parts: int, scale: float) -> DataFrame | None:
    """Rows (vec_id, label, vec): sound vectors as packed integers, filled up to one width."""
    sound = F.col("parts").isNotNull() & ~F.exists(
        "parts", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    )
    scaled = F.transform("parts", lambda x: F.floor(x * F.lit(float(scale))))
    too_large = F.exists("parts", lambda x: F.abs(x * F.lit(float(scale))) > F.lit(float(LARGEST)))
    checked = F.when(too_large, F.raise_error(F.lit("components beyond 2^61"))).otherwise(scaled)
    whole = (
        vectors.select(
            F.col(f"`{key}`").cast("long").cast("string").alias("vec_id"),
            F.col(f"`{label}`").cast("string").alias("label"),
            F.col(f"`{vector}`").cast("array<double>").alias("parts"),
        )
        .where(sound)
        .withColumn("parts", checked.cast("array<bigint>"))
    )
    width = whole.agg(F.max(F.size("parts"))).first()[0]
    if width is None:
        return None
    width = max(1, -(-width // parts)) * parts
    return stored(whole.mapInPandas(_padded(width), "vec_id string, label string, vec binary"), "code-vectors")


def _trained(rows: DataFrame, parts: int, entries: int, rounds: int) -> Codebooks:
    spark = rows.sparkSession
    first = rows.select("vec_id", "vec").orderBy(F.col("vec_id").cast("long").asc_nulls_last(), "vec").limit(entries).collect()
    book = np.ascontiguousarray(_matrices([r["vec"] for r in first], parts).transpose(1, 0, 2))
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast(Codebooks(book, _grid_step(book)))
        sent = rows.select("vec").mapInPandas(_sums(shared), "part int, entry int, place int, total string, rows long")
        sums = sent.groupBy("part", "entry", "place").agg(
            F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("rows").alias("rows")
        )
        book = book.copy()
        for r in sums.collect():  # a row for each component of the codebooks
            book[r["part"], r["entry"], r["place"]] = int(r["total"]) // r["rows"]
    return Codebooks(book, _grid_step(book))


def vector_codes(
    vectors: DataFrame,
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    scale: float = SCALE,
) -> DataFrame:
    """Codes of all vectors under codebooks trained on all of them, over components floor(scale * x).

    Each part's codebook starts as that part of the vectors with the smallest ids (ids null last, equal ids by
    components); each round assigns every part to the nearest entry (squared distance, ties to the lower
    index) and moves each used entry to the floor of its parts' mean. Returns for each vector ``vec_id``
    (long), ``code`` (two hex digits for each part), ``error`` (squared distances to the entries, summed over
    parts), ``label_error`` (errors summed over equal labels, null being one label; both long), and
    ``codebooks_sha256`` (of all final components as decimal text, by part, entry and place).

    Vectors that are null or hold a null, NaN or infinite component are left out. Rows without an id or a
    label, and repeated rows, are coded like others. Vectors shorter than the longest are filled up with
    zeros, as is a width that the parts don't divide. With fewer vectors than ``entries`` the codebooks are
    smaller; an empty table gives an empty result. Other columns are ignored. Components beyond 2^61 and
    errors beyond a long are an error.
    """
    if not 1 <= entries <= 256:
        raise ValueError("two hex digits tell at most 256 entries apart")
    rows = _stored_vectors(vectors, key, vector, label, parts, scale)
    if rows is None:
        return vectors.sparkSession.createDataFrame(
            [], "vec_id long, code string, error long, label_error long, codebooks_sha256 string"
        )
    books = _trained(rows, parts, entries, rounds)
    shared = rows.sparkSession.sparkContext.broadcast(books)
    coded = rows.mapInPandas(_coded(shared), "vec_id string, label string, code string, error long")
    coded = stored(coded, "vector-codes")
    by_label = coded.groupBy(F.col("label").alias("own")).agg(F.sum("error").alias("label_error"))
    by_label = stored(by_label, "label-errors")  # its size is known, so a small one is broadcast
    return coded.join(by_label, F.col("label").eqNullSafe(F.col("own"))).select(
        F.col("vec_id").cast("long").alias("vec_id"), "code", "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256")
    )
