"""Score whole texts by a recurrent language model and by word frequencies.

Frequencies are counted over all training texts. The network (gru.py) knows the LISTED most frequent words;
any other word belongs to one of RARE classes by its last two bytes. Its probability is the network's for
the class, times (c + 1) / Z: its share in the class, in which one more count stands for unseen words.

Frequent words (at most FREQUENT, a bounded table) are looked up in the tasks. The counts of all others are
joined by a shuffle of (word, text) rows, so no table that grows with the corpus is broadcast.

Texts are cut into words once; counts and ids are made from the stored hashes. The network learns from every
training text, in bulk-synchronous rounds: the texts are dealt to the rounds; in a round each task learns from its texts in mapInPandas (truncated backpropagation), and the
weights and moments of all tasks, weighted by their tokens, are averaged and sent out again. No text reaches
the driver. The schedule is the same for every corpus: ROUNDS rounds of one pass, whatever its size.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronolake.llm import gru
from chronolake.llm.text import crc_remainder
from chronolake.llm.words import word_hashes_and_ends
from chronolake.session import stored

FOLDS, HELD_OUT = 7, 2
LISTED = 1024  # words that the network knows
RARE = 32  # classes of the other words
FREQUENT = 200_000  # words whose counts every task holds
ROUNDS = 8  # rounds of the one pass over the training texts, for corpora of any size
ROUND_TOKENS = 250_000  # no longer steers the schedule: rounds and passes don't switch by size
ENOUGH = 4_000_000  # likewise
PASSED = 400_000  # tokens that a task gathers for one call of the learner
RANGE_BITS = 18  # of a hash, for looking up frequent words
BINS = 16  # of the histogram of counts, for each factor of two

_END = np.uint64(0x5851F42D4C957F2D)  # stands for the end of a text


def tokens(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words and the end, as signed numbers, and the rare class of each."""
    hashes, tails = word_hashes_and_ends(text)
    classes = (tails * 2654435761 >> 7) % RARE
    return np.append(hashes, _END).view(np.int64), np.append(classes, 0)


def _tokenised(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Hashes and classes of each text's tokens."""
    for whole in batches:
        for start in range(0, len(whole), 2048):
            batch = whole.iloc[start : start + 2048]
            parts = [tokens(t) for t in batch["text"]]
            words, classes = [p[0].tobytes() for p in parts], [p[1].astype(np.uint8).tobytes() for p in parts]
            yield pd.DataFrame({**batch.drop(columns="text"), "words": words, "classes": classes})


def _read(batch: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """All hashes and classes of a batch of tokenised texts, one text after the other."""
    return np.frombuffer(b"".join(batch["words"]), np.int64), np.frombuffer(b"".join(batch["classes"]), np.uint8)


def _counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(word, class, n) of each batch."""
    for batch in batches:
        words, classes = _read(batch)
        codes, distinct = pd.factorize(words)
        own = np.zeros(len(distinct), np.int32)
        own[codes] = classes  # equal for all copies of a word
        yield pd.DataFrame({"word": distinct, "class": own, "n": np.bincount(codes, minlength=len(distinct))})


def _range_of(words: np.ndarray) -> np.ndarray:
    """The leading bits of signed hashes, in their order."""
    return (words >> (64 - RANGE_BITS)) + (1 << (RANGE_BITS - 1))


class Model:
    """What every task needs: frequent words, the network, and the sizes of the corpus."""

    def __init__(self, words: np.ndarray, n: np.ndarray, total: int, distinct: int, rare: np.ndarray):
        order = np.argsort(-n, kind="stable")[:LISTED]
        self.ids = np.full(len(words), -1, dtype=np.int64)  # words are sorted, for searching
        self.ids[order] = np.arange(len(order))
        self.words, self.logs = words, np.log10(n + 1.0)
        self.total, self.distinct, self.rare = total, distinct, rare
        # Where the words of each range of hashes start; hashes are even, so a range has few words.
        self.starts = np.searchsorted(_range_of(words), np.arange(1 << RANGE_BITS))
        self.longest = int(np.diff(np.append(self.starts, len(words))).max())
        self.end = int(self.ids[np.searchsorted(words, _END.view(np.int64))])
        self.frequency = np.zeros(LISTED + RARE)
        self.frequency[: len(order)] = n[order]
        self.frequency[LISTED:] = rare
        self.weights: gru.Weights = {}

    def places(self, words: np.ndarray) -> np.ndarray:
        """Places of the words among the frequent ones, or -1."""
        at = np.minimum(self.starts[_range_of(words)], len(self.words) - 1)
        for _ in range(self.longest):
            at = np.minimum(at + (self.words[at] < words), len(self.words) - 1)
        return np.where(self.words[at] == words, at, -1)


def _placed(model: Model, rounds: int):
    """Each text's ids for the network, the sums over its frequent words, and its other words.

    Training texts are dealt to the rounds in turn; the others get round -1.
    """
    log_base = math.log10(model.total + model.distinct + 1)
    log_rare = np.log10(model.rare)

    def run(batches):
        dealt = 0
        for whole in batches:
            for start in range(0, len(whole), 2048):
                batch = whole.iloc[start : start + 2048]
                words, classes = _read(batch)
                at = model.places(words)
                known = at >= 0
                ids = np.where(known, model.ids[at], -1)
                other = ids < 0  # words that the network doesn't know: their share in their class
                ids = np.where(other, LISTED + classes.astype(np.int64), ids)
                logs = np.where(known, model.logs[at], 0.0)
                rest = np.where(other, logs - log_rare[classes], 0.0)
                n = np.array([len(w) // 8 for w in batch["words"]])
                first = np.cumsum(n) - n  # no text is without its end
                left = [np.unique(w[~k], return_counts=True) for w, k in zip(np.split(words, first[1:]), np.split(known, first[1:]))]
                turn = np.cumsum(batch["learned"].to_numpy(dtype=np.int64)) + dealt
                dealt = int(turn[-1])
                yield pd.DataFrame(
                    {
                        "row": batch["row"],
                        "key": batch["key"],
                        "round": np.where(batch["learned"], turn % rounds, -1),
                        "ids": [part.astype("<u2").tobytes() for part in np.split(ids, first[1:])],
                        "n_tokens": n,
                        "known": np.add.reduceat(known.astype(np.int64), first),
                        "base": np.add.reduceat(logs, first) - n * log_base,
                        "rest": np.add.reduceat(rest, first),
                        "words": [w for w, _ in left],
                        "times": [times for _, times in left],
                    }
                )

    return run


def _scored(model: Model):
    """``own``: the network's share of each text's score, and that of the frequent words in their classes."""

    def run(batches):
        for whole in batches:
            for start in range(0, len(whole), 2048):
                batch = whole.iloc[start : start + 2048]
                ids = [np.frombuffer(i, dtype="<u2").astype(np.int64) for i in batch["ids"]]
                own = gru.score(model.weights, ids, model.end) / math.log(10) + batch["rest"]
                yield pd.DataFrame({**batch.drop(columns=["ids", "rest"]), "own": own})

    return run


def _round(state: np.ndarray, like: gru.Weights, end: int, rate: float):
    """What one task has learned, times its tokens."""

    def run(batches):
        learner, tokens_seen, waiting, size = gru.Learner.unflat(state, like), 0, [], 0
        for batch in batches:
            for ids in batch["ids"]:
                waiting.append(np.frombuffer(ids, dtype="<u2").astype(np.int64))
                size += len(waiting[-1])
                if size >= PASSED:
                    tokens_seen += learner.learn(waiting, end, rate)
                    waiting, size = [], 0
        if waiting:
            tokens_seen += learner.learn(waiting, end, rate)
        if tokens_seen:
            yield pd.DataFrame({"tokens": [tokens_seen], "state": [(learner.flat() * tokens_seen).tobytes()]})

    return run


def _summed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    tokens_seen, total = 0, None
    for batch in batches:
        for n, state in zip(batch["tokens"], batch["state"]):
            own = np.frombuffer(state)
            tokens_seen, total = tokens_seen + n, own if total is None else total + own
    if total is not None:
        yield pd.DataFrame({"tokens": [tokens_seen], "state": [total.tobytes()]})


def _trained(placed: DataFrame, model: Model, rounds: int) -> gru.Weights:
    """Weights learned from all training texts, each once; of each round, at most eight summed states reach the driver."""
    like = gru.initial(model.frequency, LISTED)
    state = gru.Learner(like).flat()
    for n in range(rounds):
        rate = gru.RATE * (1 - 0.9 * n / rounds)
        own = placed.where(F.col("round") == n % rounds).select("ids")
        sums = own.mapInPandas(_round(state, like, model.end, rate), "tokens long, state binary")
        sums = sums.repartition(8).mapInPandas(_summed, "tokens long, state binary").collect()
        if sums:
            state = sum(np.frombuffer(r["state"]) for r in sums) / sum(r["tokens"] for r in sums)
    return gru.Learner.unflat(state, like).w


def _counts(tokenised: DataFrame) -> DataFrame:
    """(word, class, n) over all training texts."""
    counts = tokenised.where("learned").select("words", "classes").mapInPandas(_counted, "word long, class int, n long")
    return stored(counts.groupBy("word").agg(F.max("class").alias("class"), F.sum("n").alias("n")), "word-counts")


def _sized(counts: DataFrame) -> Model | None:
    """The model, without its network: frequent words and sizes."""
    sizes = counts.groupBy(F.floor(F.log2("n") * BINS).cast("int").alias("bin"))
    sizes = sizes.agg(F.count(F.lit(1)).alias("words"), F.sum("n").alias("n")).collect()  # at most 64 * BINS rows
    total, distinct = sum(r["n"] for r in sizes), sum(r["words"] for r in sizes)
    if not total:
        return None
    taken, least = 0, 64 * BINS
    for r in sorted(sizes, key=lambda r: -r["bin"]):
        taken += r["words"]
        if taken > FREQUENT:
            break
        least = r["bin"]
    frequent = counts.where((F.floor(F.log2("n") * BINS) >= least) | (F.col("word") == F.lit(int(_END.view(np.int64)))))
    rows = frequent.select("word", "class", "n").toArrow()  # at most FREQUENT + 1
    words, classes, n = (rows.column(c).to_numpy().astype(np.int64) for c in ("word", "class", "n"))
    order = np.argsort(words)
    n, classes = n[order], classes[order]
    # Mass of the rare classes: all words of a class but the listed ones, each with one more count.
    mass = {r["class"]: r["m"] for r in counts.groupBy("class").agg(F.sum(F.col("n") + 1).alias("m")).collect()}
    rare = np.array([mass.get(c, 0) + 1.0 for c in range(RARE)])
    listed = np.argsort(-n, kind="stable")[:LISTED]
    np.subtract.at(rare, classes[listed], n[listed] + 1.0)
    return Model(words[order], n, total, distinct, rare)


def lm_scores(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Score every whole text; learn from those whose crc32 remainder isn't HELD_OUT.

    Returns one row for each row of ``docs``: ``key``, ``held_out``, ``n_tokens`` (words and one end),
    ``n_known`` (tokens seen in training), ``train_tokens``, ``base_score`` and ``score`` (log10
    probabilities by word frequencies and by the model).

    Null and empty texts are the end alone. Without any training text all tokens are unknown and both
    scores are those of one count for anything (log10 1 = 0). A null id counts as an empty one in the
    remainder; repeated rows count and are scored one by one. An empty table gives an empty
    result, other columns are ignored whatever their names.
    """
    kind = docs.schema[key].dataType.simpleString()
    texts = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("string").alias("text"))
    learned = (crc_remainder(F.col("key"), FOLDS) != HELD_OUT).alias("learned")
    texts = texts.select(F.monotonically_increasing_id().alias("row"), "key", learned, "text")
    schema = f"row long, key {kind}, learned boolean, words binary, classes binary"
    tokenised = stored(texts.mapInPandas(_tokenised, schema), "lm-tokens")  # fixes the row numbers
    held_out = (crc_remainder(F.col("key"), FOLDS) == HELD_OUT).alias("held_out")
    counts = _counts(tokenised)
    model = _sized(counts)
    if model is None:
        n_tokens = (F.length("words") / 8).cast("long").alias("n_tokens")
        nothing = [F.lit(0).cast("long").alias(c) for c in ("n_known", "train_tokens")]
        scores = [F.lit(0.0).alias("base_score"), F.lit(0.0).alias("score")]
        return tokenised.select(F.col("key").alias(key), held_out, n_tokens, *nothing, *scores)
    rounds = ROUNDS
    schema = f"row long, key {kind}, round int, ids binary, n_tokens long, known long, base double, rest double"
    placed = tokenised.mapInPandas(_placed(model, rounds), f"{schema}, words array<long>, times array<long>")
    placed = stored(placed, "lm-ids", "round")
    model.weights = _trained(placed, model, rounds)
    rows = placed.select("row", "key", "n_tokens", "known", "base", "rest", "ids")
    rows = rows.mapInPandas(_scored(model), f"row long, key {kind}, n_tokens long, known long, base double, own double")
    pairs = placed.select("row", F.explode(F.arrays_zip("words", "times")).alias("p"))
    pairs = pairs.select("row", F.col("p.words").alias("p_word"), F.col("p.times").alias("times"))
    joined = pairs.join(counts.select("word", "n"), F.col("p_word") == F.col("word"))  # the others are unseen
    more = joined.groupBy(F.col("row").alias("m_row")).agg(
        F.sum("times").alias("m_known"), F.sum(F.col("times") * F.log10(F.col("n") + F.lit(1.0))).alias("m_logs")
    )
    result = rows.join(more, F.col("row") == F.col("m_row"), "left")
    logs = F.coalesce("m_logs", F.lit(0.0))
    return result.select(
        F.col("key").alias(key),
        held_out,
        "n_tokens",
        (F.col("known") + F.coalesce("m_known", F.lit(0))).cast("long").alias("n_known"),
        F.lit(model.total).cast("long").alias("train_tokens"),
        (F.col("base") + logs).alias("base_score"),
        (F.col("own") + logs).alias("score"),
    )
