"""Exact top-k search by inner product with a pivot table.

The distances of every vector to a few pivots are computed once. By the triangle inequality the distance of
two vectors is at least max |d(q, p) - d(x, p)| over the pivots p, and
q.x = (|q|^2 + |x|^2 - |q - x|^2) / 2 turns that into an upper bound of the score. A query takes its
candidates in the order of their bounds and stops where a bound falls below its k-th best score: nothing
behind it can enter, so the result is exact.

Vectors are dealt into chunks of like vectors (by nearest pivot, large cells split by hash), queries into
blocks; every block meets every chunk in one group of bounded size, where whole chunks out of reach are
skipped by their intervals of pivot distances. Pivots and first thresholds come from a bounded sample; they
only decide how much is skipped.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chronolake.session import stored

SCALE = 1024
SAMPLE = 2048  # vectors that the driver sees
PIVOTS = 16
CHUNK = 1024  # vectors of a group
BLOCK = 4096  # queries of a group
STEP = 128  # candidates scored between two looks at the stopping rule

_TABLE = "row long, vec_id long, vec binary, norm2 double, dist binary, cell int"
_FOUND = "query_row long, query_id long, vec_id long, row long, score long"


def _matrix(blobs, width: int) -> np.ndarray:
    """Rows of int64 components, short ones filled up with zeros."""
    if all(len(b) == 8 * width for b in blobs):
        return np.frombuffer(b"".join(blobs), dtype="<i8").reshape(len(blobs), width)
    full = np.zeros((len(blobs), width), dtype=np.int64)
    for i, b in enumerate(blobs):
        full[i, : len(b) // 8] = np.frombuffer(b, dtype="<i8")
    return full


def _products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """left @ right.T in integers: doubles where all sums are exact in them, which is faster."""
    top = float(np.abs(left).max(initial=0)) * float(np.abs(right).max(initial=0)) * max(1, left.shape[1])
    if top < 2**53:
        return np.rint(left.astype(np.float64) @ right.astype(np.float64).T).astype(np.int64)
    if top < 2**63:
        return left @ right.T
    # Only pairs with a large vector are multiplied in Python's integers; an error is a score that is too large.
    small = int((2**63 // max(1, left.shape[1])) ** 0.5) - 1
    rows, columns = (np.abs(m.astype(np.float64)).max(1, initial=0) < small for m in (left, right))
    scores = np.zeros((len(left), len(right)), dtype=np.int64)
    scores[np.ix_(rows, columns)] = left[rows] @ right[columns].T
    for own, other in ((~rows, np.ones(len(right), dtype=bool)), (rows, ~columns)):
        if own.any() and other.any():
            exact = left[own].astype(object) @ right[other].T.astype(object)
            if max(abs(x) for x in exact.ravel()) >= 2**63:
                raise ValueError("scores don't fit a long")
            scores[np.ix_(own, other)] = exact.astype(np.int64)
    return scores


def _choose_pivots(sample: np.ndarray, wanted: int) -> np.ndarray:
    """Farthest-first: each pivot is the sample's vector farthest from those before it."""
    vectors = sample.astype(np.float64)
    if not len(vectors):
        return vectors
    chosen = [0]
    nearest = ((vectors - vectors[0]) ** 2).sum(1)
    while len(chosen) < wanted and nearest.max() > 0:
        chosen.append(int(nearest.argmax()))
        nearest = np.minimum(nearest, ((vectors - vectors[chosen[-1]]) ** 2).sum(1))
    return vectors[chosen]


def _tabled(width: int, pivots: np.ndarray):
    def run(batches):
        for batch in batches:
            vectors = _matrix(batch["vec"].tolist(), width)
            real = vectors.astype(np.float64)
            dist = np.stack([np.sqrt(((real - p) ** 2).sum(1)) for p in pivots], axis=1)
            yield pd.DataFrame(
                {
                    "row": batch["row"],
                    "vec_id": batch["vec_id"],
                    "vec": batch["vec"],
                    "norm2": (real**2).sum(1),
                    "dist": [d.tobytes() for d in dist],
                    "cell": dist.argmin(1).astype(np.int32),
                }
            )

    return run


def _thresholds(width: int, sample: np.ndarray, sample_rows: np.ndarray, k: int):
    """Add the k-th best score within the sample, less rounding errors: no smaller score can be in the result."""
    others = sample.astype(np.float64)

    def run(batches):
        for batch in batches:
            least = np.full(len(batch), -np.inf)
            if len(sample) > k:
                own = _matrix(batch["vec"].tolist(), width).astype(np.float64)
                scores = own @ others.T - 1e-12 * width * np.outer(np.abs(own).max(1, initial=0), np.abs(others).max(1, initial=0)) * width
                scores[batch["row"].to_numpy()[:, None] == sample_rows[None, :]] = -np.inf
                least = -np.partition(-scores, k - 1, axis=1)[:, k - 1]
            yield batch.assign(least=least)

    return run


def _searched(width: int, n_pivots: int, k: int):
    def run(queries: pd.DataFrame, chunk: pd.DataFrame) -> pd.DataFrame:
        found: list[tuple] = []
        if len(queries) and len(chunk):
            vectors, asked = _matrix(chunk["vec"].tolist(), width), _matrix(queries["vec"].tolist(), width)
            dist = np.frombuffer(b"".join(chunk["dist"]), dtype=np.float64).reshape(-1, n_pivots)
            far = np.frombuffer(b"".join(queries["dist"]), dtype=np.float64).reshape(-1, n_pivots)
            norm2, own2 = chunk["norm2"].to_numpy(), queries["norm2"].to_numpy()
            ids = np.array([2**63 - 1 if pd.isna(x) else int(x) for x in chunk["vec_id"]], dtype=np.int64)
            rows, own = chunk["row"].to_numpy(), queries["row"].to_numpy()
            names, least = queries["vec_id"].to_numpy(), queries["least"].to_numpy()
            low, high, most = dist.min(0), dist.max(0), norm2.max()
            # Bounds carry a slack of rounding errors: too high a bound costs time, never results.
            slack = 1 + 1e-9 * (most + own2)
            gap = np.maximum(0, np.maximum(low - far, far - high)).max(1)
            for q in np.flatnonzero((own2 + most - gap * gap) / 2 + slack >= least):
                apart = np.abs(dist - far[q]).max(1)
                bound = (own2[q] + norm2 - apart * apart) / 2 + slack[q]
                order = np.flatnonzero((bound >= least[q]) & (rows != own[q]))
                order = order[np.argsort(-bound[order], kind="stable")]
                best: list[tuple] = []
                for at in range(0, len(order), STEP):
                    some = order[at : at + STEP]
                    if len(best) == k and bound[some[0]] < -best[-1][0]:
                        break
                    scores = _products(asked[q : q + 1], vectors[some])[0]
                    good = scores >= max(least[q], -best[-1][0] if len(best) == k else -np.inf)
                    some, scores = some[good], scores[good]
                    best = sorted(best + list(zip((-scores).tolist(), ids[some].tolist(), rows[some].tolist())))[:k]
                found += [(own[q], names[q], i, r, -s) for s, i, r in best]
        result = pd.DataFrame(found, columns=["query_row", "query_id", "vec_id", "row", "score"])
        return result.astype("int64")

    return run


def top_k(
    vectors: DataFrame,
    is_query,
    k: int = 10,
    key: str = "vec_id",
    vector: str = "embedding",
    scale: int = SCALE,
    sample: int = SAMPLE,
    pivots: int = PIVOTS,
    chunk: int = CHUNK,
    block: int = BLOCK,
) -> DataFrame:
    """The k rows with the highest inner product for each query row, over components floor(scale * x).

    ``is_query`` is a condition on the id, given as a function of its column. Returns ``query_id``, ``rank``
    (int, from 1), ``vec_id`` (all ids long) and ``score`` (long); ties go to the smaller id. A query with
    fewer than k other rows gets them all.

    Vectors that are null or hold a null, NaN or infinite component take no part, neither as queries nor
    as candidates; an empty vector takes part with scores of 0, and a shorter vector is filled up with
    zeros. A row without an id is a candidate, last among ties, and no query. Rows are told apart as rows:
    repeated rows are candidates of each other and each a query of its own. An empty table gives an empty
    result. Other columns are ignored. Scores beyond a long are an error.
    """
    spark = vectors.sparkSession
    parts = F.col("parts")
    sound = parts.isNotNull() & ~F.exists(
        parts, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    )
    whole = (
        vectors.select(F.col(f"`{key}`").cast("long").alias("vec_id"), F.col(f"`{vector}`").alias("parts"))
        .withColumn("parts", F.col("parts").cast("array<double>"))
        .where(sound)
        .select(
            F.monotonically_increasing_id().alias("row"),
            "vec_id",
            F.transform(parts, lambda x: F.floor(x * F.lit(float(scale))).cast("long")).alias("parts"),
        )
        .mapInPandas(_packed, "row long, vec_id long, vec binary")
    )
    whole = stored(whole, "vectors")  # fixes the row numbers
    width = whole.agg(F.max(F.length("vec"))).first()[0]
    if width is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    width //= 8
    seen = whole.orderBy(F.xxhash64("vec_id", "row"), "row").limit(sample).select("row", "vec").collect()
    sampled, sampled_rows = _matrix([r["vec"] for r in seen], width), np.array([r["row"] for r in seen])
    chosen = _choose_pivots(sampled, pivots)
    tabled = stored(whole.mapInPandas(_tabled(width, chosen), _TABLE), "pivot-table")

    cells = {r["cell"]: r["count"] for r in tabled.groupBy("cell").count().collect()}  # one row for each pivot
    first, chunks, start = [], [], 0
    for cell in range(len(chosen)):
        n = -(-cells.get(cell, 0) // chunk)
        first.append(start)
        chunks.append(max(1, n))
        start += n
    place = (F.col("cell") + 1).cast("int")
    at = lambda values: F.element_at(F.array(*[F.lit(v).cast("long") for v in values]), place)
    tabled = tabled.withColumn("chunk", at(first) + F.pmod(F.xxhash64("row"), at(chunks)))

    asked = tabled.where(F.coalesce(is_query(F.col("vec_id")), F.lit(False))).drop("cell", "chunk")
    schema = "row long, vec_id long, vec binary, norm2 double, dist binary, least double"
    asked = stored(asked.mapInPandas(_thresholds(width, sampled, sampled_rows, k), schema), "queries")
    blocks = max(1, -(-asked.count() // block))
    asked = asked.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("long"))
    asked = asked.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(start - 1).cast("long"))))
    tabled = tabled.drop("cell").withColumn(
        "block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long")))
    )
    found = (
        asked.groupBy("block", "chunk")
        .cogroup(tabled.groupBy("block", "chunk"))
        .applyInPandas(_searched(width, len(chosen), k), _FOUND)
    )
    best = Window.partitionBy("query_row").orderBy(F.col("score").desc(), "vec_id", "row")
    return (
        found.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", F.nullif("vec_id", F.lit(2**63 - 1)).alias("vec_id"), "score")
    )


def _packed(batches):
    for batch in batches:
        blobs = [np.asarray(v, dtype="<i8").tobytes() for v in batch["parts"]]
        yield batch[["row", "vec_id"]].assign(vec=blobs)
