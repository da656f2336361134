"""Language ID by string kernels.

Two windows of text are compared by the blended spectrum: the number of character n-grams (n = 1 to 4,
hashed into BUCKETS) that both contain, normalised to 1 for a window with itself. A Nystroem
approximation replaces the kernel matrix of the training windows by their kernels with a few landmarks,
and kernel ridge regression is fitted for each language against the rest.

The kernel of a window with all landmarks, times the fitted coefficients, is a product of three matrices:
presence (windows x buckets), landmarks (buckets x landmarks), coefficients (landmarks x languages). The
last two are multiplied once, so a batch of windows costs one matrix product. A text is scored in windows
of WINDOW characters, all of them, and gets their mean by length: presence stays telling in long texts,
and passages in another language weigh what they are long.

Only the fit uses a bounded sample: at most PER_LANGUAGE documents of each language, of their windows at
most WINDOWS for each language.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chronolake.llm.text import crc_remainder, hash_sample, text_of
from chronolake.session import stored

FOLDS = 5
GRAMS = 4
BUCKETS = 1 << 14
WINDOW = 2048
BATCH = 128  # windows of one matrix product
PER_LANGUAGE = 500
WINDOWS = 500
LANDMARKS = 60  # for each language
RIDGE = 1e-2
UNKNOWN = "und"

_REST = re.compile(r"[\W\d_]+")


def has_letter(text: str) -> bool:
    """Whether any character is a letter (category L, as in the training rows' pattern)."""
    return any(map(str.isalpha, text))


def windows(text: str) -> list[str]:
    """The letters of a whole text, words set apart by blanks, cut into even windows."""
    clean = f" {_REST.sub(' ', text.lower()).strip()} "
    n = max(1, -(-len(clean) // WINDOW))
    size = -(-len(clean) // n)
    return [clean[i : i + size] for i in range(0, len(clean), size)]


def buckets(window: str) -> np.ndarray:
    """Buckets of all n-grams of a window, with repeats."""
    codes = np.frombuffer(window.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    found, gram = [], np.zeros(len(codes), dtype=np.uint64)
    for n in range(GRAMS):
        if len(codes) <= n:
            break
        gram = gram[: len(codes) - n] * np.uint64(0x100000001B3) + codes[n:] + np.uint64(n + 1)
        found.append((gram * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - 14))
    return np.concatenate(found).astype(np.int64)


def presence(texts: list[str]) -> np.ndarray:
    """Rows of 0 and 1 for windows, divided by their norms, so that products are normalised kernels."""
    rows = np.zeros((len(texts), BUCKETS), dtype=np.float32)
    for row, text in zip(rows, texts):
        row[buckets(text)] = 1
    return rows / np.sqrt(rows.sum(1, keepdims=True))


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    weights: np.ndarray | None  # buckets x languages: landmarks times coefficients

    def scores(self, texts: list[str]) -> np.ndarray:
        """Mean of the windows' scores by length, for each text and language."""
        cut = [windows(t) for t in texts]
        flat = [w for ws in cut for w in ws]
        parts = [presence(flat[i : i + BATCH]) @ self.weights for i in range(0, len(flat), BATCH)]
        values = np.concatenate(parts).astype(np.float64)
        length = np.array([len(w) for w in flat], dtype=np.float64)
        owner = np.repeat(np.arange(len(texts)), [len(ws) for ws in cut])
        sums = np.zeros((len(texts), len(self.languages)))
        np.add.at(sums, owner, values * length[:, None])
        return sums / np.bincount(owner, weights=length, minlength=len(texts))[:, None]


def fit(rows: np.ndarray, languages: np.ndarray, landmarks: np.ndarray) -> Model:
    """One ridge regression for each language on the kernels with the landmarks (Nystroem)."""
    names = tuple(sorted(set(languages.tolist())))
    target = np.where(languages[:, None] == np.array(names)[None, :], 1.0, -1.0)
    # Each language weighs the same in the fit.
    share = np.array([1 / (languages == name).sum() for name in languages])[:, None]
    cross = (rows @ landmarks.T).astype(np.float64)
    among = (landmarks @ landmarks.T).astype(np.float64)
    left = cross.T @ (cross * share) + RIDGE * among + 1e-6 * np.eye(len(landmarks))
    alpha = np.linalg.solve(left, cross.T @ (target * share))
    return Model(names, (landmarks.T.astype(np.float64) @ alpha).astype(np.float32))


def _cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        cut = [windows(t) for t in batch["text"]]
        n = [len(c) for c in cut]
        yield pd.DataFrame(
            {
                "lang": pd.Series(np.repeat(batch["lang"].to_numpy(dtype=object), n), dtype=object),
                "piece": pd.Series([w for ws in cut for w in ws], dtype=object),
            }
        )


def learn(docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id") -> Model:
    known = docs.select(
        F.col(f"`{key}`").alias("key"),
        F.col(f"`{lang}`").cast("string").alias("lang"),
        text_of(F.col(f"`{text}`")).alias("text"),
    ).where(F.col("lang").isNotNull() & (crc_remainder(F.col("key"), FOLDS) != 0) & F.col("text").rlike(r"\p{L}"))
    # Ids first, so that no texts are sorted.
    ids = hash_sample(known.select("lang", "key"), "lang", "key", PER_LANGUAGE)
    ids = F.broadcast(stored(ids.select(F.col("key").alias("s_key")).distinct(), "lang-ids"))
    sample = known.join(ids, F.col("key") == F.col("s_key")).select("lang", "text")
    pieces = sample.mapInPandas(_cut, "lang string, piece string")
    chosen = hash_sample(stored(pieces, "lang-pieces"), "lang", "piece", WINDOWS)
    in_order = Window.partitionBy("lang").orderBy(F.xxhash64("piece"), "piece")
    chosen = chosen.withColumn("n", F.row_number().over(in_order))
    rows = sorted((r["lang"], r["n"], r["piece"]) for r in chosen.collect())
    if not rows:
        return Model((), None)
    points = presence([piece for _, _, piece in rows])
    marks = np.array([n <= LANDMARKS for _, n, _ in rows])
    return fit(points, np.array([name for name, _, _ in rows]), points[marks])


def _predicted(model: Model):
    def run(batches):
        for batch in batches:
            texts = batch["text"].tolist()
            names = np.full(len(texts), UNKNOWN, dtype=object)
            scores = np.zeros(len(texts))
            real = [i for i, t in enumerate(texts) if has_letter(t)] if model.languages else []
            if real:
                values = model.scores([texts[i] for i in real])
                best = values.argmax(1)
                names[real] = np.array(model.languages, dtype=object)[best]
                scores[real] = np.clip((values[np.arange(len(best)), best] + 1) / 2, 0, 1)
            yield pd.DataFrame({"key": batch["key"], "lang_pred": pd.Series(names, dtype=object), "score": scores})

    return run


def language(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    key: str = "doc_id",
    model: Model | None = None,
) -> DataFrame:
    """Predict the language of every whole text.

    Returns one row for each row of ``docs``: ``key``, ``held_out``, ``lang_pred`` and ``score`` (0 to 1).

    Null texts and texts without a letter are ``und`` with score 0; so is every text if no labelled text
    is there to learn from. Equal scores go to the language that sorts first. Rows with a null language
    are predicted and never learned from. Repeated rows stay repeated, an empty table gives an empty
    result, other columns are ignored whatever their names.
    """
    model = model or learn(docs, text, lang, key)
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(f"`{key}`").alias("key"), text_of(F.col(f"`{text}`")).alias("text"))
    found = rows.mapInPandas(_predicted(model), f"key {kind}, lang_pred string, score double")
    held_out = crc_remainder(F.col("key"), FOLDS) == 0
    return found.select(F.col("key").alias(key), held_out.alias("held_out"), "lang_pred", "score")
