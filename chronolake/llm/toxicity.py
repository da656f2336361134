"""Toxicity by a weighted finite-state grammar of clauses.

A lexical transducer maps words to classes (insult, threat, target, negation, reported speech, clause end,
other). Five small transducers follow the classes, each with a state of its own: is an insult negated, is the
clause somebody else's speech, was a target named, is a threat open? Their product is composed once into
one table; a text is then one walk through that table, which emits weights of matched clauses, never of
isolated words: a threat counts only with a target in its clause, and an insult adds to the sum of its
way of being said (plain, negated, reported) and again if its clause has a target.

Insult words and their weights are learned: words and stems of labelled toxic documents that clean ones
hardly hold. How much each way of being said counts is a logistic fit on labelled documents. Both use
bounded samples of labelled rows (MAX_TOXIC, MAX_CLEAN, in the order of a hash); scoring covers all texts.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronolake.llm.text import crc_remainder, hash_sample, packed, text_of
from chronolake.session import stored

MAX_TOXIC, MAX_CLEAN = 2000, 6000  # labelled rows to learn from
FOLDS = 5  # of which one is held out
STEMS = (4, 5, 6)  # lengths of word beginnings
SUPPORT = 0.02  # share of independent toxic documents that an insult must occur in
LEAST = 4  # such documents at least
CONTRAST = 30.0  # times that an insult is likelier in toxic documents than in clean ones
PRIOR = 3.0  # weight of a seed word that the labelled rows don't show

# Seed words of the grammar's classes.
INSULTS = "idiot moron stupid loser scum trash pathetic worthless disgusting clown".split()
THREATS = "kill hurt destroy smash crush strangle stab".split()
TARGETS = "you your yours he she him her they them him these those vous du ihr usted ustedes".split()
NEGATIONS = "not never neither nor nicht kein jamais nunca".split()
REPORTS = "said says told wrote quoted claimed reported called sagte dijo".split()

_WORD = re.compile(r"[^\W\d_]+|[.!?;:,\n|]+")

# Classes of words, as symbols of the transducers.
OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT, PAUSE, STOP = range(8)
FEATURES = ("plain", "negated", "reported", "targeted", "threat")


@dataclass(frozen=True)
class Machine:
    """A transducer over word classes: moves[(state, symbol)]; other symbols leave the state as it is."""

    moves: dict = field(default_factory=dict)

    def step(self, state: int, symbol: int) -> int:
        return self.moves.get((state, symbol), state)


def _until(symbol: int, *ends: int) -> Machine:
    """On from ``symbol`` until one of ``ends``."""
    return Machine({(0, symbol): 1, **{(1, end): 0 for end in ends}})


# A negation reaches over at most two other words; speech is reported to the end of the sentence.
MACHINES = {
    "negation": Machine(
        {(s, NEGATION): 3 for s in range(4)}
        | {(s, OTHER): s - 1 for s in range(1, 4)}
        | {(s, end): 0 for s in range(1, 4) for end in (PAUSE, STOP)}
    ),
    "report": _until(REPORT, STOP),
    "target": _until(TARGET, PAUSE, STOP),
    "threat": _until(THREAT, PAUSE, STOP),
    "insult": _until(INSULT, PAUSE, STOP),
}


def compose(machines: dict[str, Machine] = MACHINES) -> list[list[tuple[int, tuple[int, ...]]]]:
    """The product of the machines: table[state][symbol] = (next state, states of all machines before it)."""
    start = (0,) * len(machines)
    number, table, open_ = {start: 0}, [], [start]
    while open_:
        state = open_.pop(0)
        row = []
        for symbol in range(8):
            after = tuple(m.step(s, symbol) for m, s in zip(machines.values(), state))
            if after not in number:
                number[after] = len(number)
                open_.append(after)
            row.append((number[after], state))
        table.append(row)
    return table


@dataclass(frozen=True)
class Model:
    """Weights of insult words and stems, and the fit of the clause features (the last is the constant)."""

    insults: dict[str, float]
    fit: tuple[float, ...] = (1.0, 0.3, 0.6, 0.5, 1.0, -3.0)


def _stems(word: str) -> list[str]:
    """The word and its beginnings, marked so that a beginning never equals a whole word."""
    return [word] + [word[:n] + "*" for n in STEMS if len(word) > n]


class Grammar:
    """The composed grammar with a model's words; one for each Python task."""

    def __init__(self, model: Model):
        self.table, self.model = compose(), model
        classes = ((TARGETS, TARGET), (NEGATIONS, NEGATION), (REPORTS, REPORT), (THREATS, THREAT))
        self.words = {w: (symbol, 0.0) for words, symbol in classes for w in words}
        self.cues = ahocorasick.Automaton()
        for cue in {w.rstrip("*") for w in model.insults} | set(THREATS):
            self.cues.add_word(cue, cue)
        self.cues.make_automaton()
        self.known: dict[str, tuple[int, float]] = {}

    def _symbol(self, word: str) -> tuple[int, float]:
        found = self.known.get(word)
        if found is None:
            if word[0] in ".!?;:,\n|":
                found = (PAUSE if set(word) <= set(",:") else STOP, 0.0)
            else:
                weight = max((self.model.insults.get(s, 0.0) for s in _stems(word)), default=0.0)
                found = (INSULT, weight) if weight > 0 else self.words.get(word, (OTHER, 0.0))
            if len(self.known) > 200_000:  # a cache only
                self.known.clear()
            self.known[word] = found
        return found

    def features(self, text: str) -> list[float]:
        """Sums of the weights that the matched clauses of a whole text emit, by feature."""
        low, sums = text.lower(), dict.fromkeys(FEATURES, 0.0)
        if next(self.cues.iter(low), None) is None:
            return list(sums.values())
        state, clause = 0, 0.0
        for word in [*_WORD.findall(low), "."]:
            symbol, weight = self._symbol(word)
            state, (negated, reported, targeted, threat, _) = self.table[state][symbol]
            if symbol == INSULT:
                sums["negated" if negated else "reported" if reported else "plain"] += weight
                clause += weight
            elif symbol >= PAUSE:
                if targeted:
                    sums["targeted"] += clause
                    sums["threat"] += PRIOR * threat
                clause = 0.0
        return list(sums.values())

    def score(self, features: np.ndarray) -> np.ndarray:
        fit = np.array(self.model.fit)
        return 1 / (1 + np.exp(-np.clip(np.log1p(features) @ fit[:-1] + fit[-1], -30, 30)))


# --- learning --------------------------------------------------------------------------------------


def _sample(docs: DataFrame, labels: DataFrame, text: str, key: str) -> DataFrame:
    """Texts of labelled rows outside the held-out part: at most MAX_TOXIC and MAX_CLEAN of them."""
    known = labels.select(F.col("doc_id").alias("l_key"), F.col("toxic").cast("int").alias("toxic"))
    known = known.where(F.col("l_key").isNotNull() & F.col("toxic").isin(0, 1))
    known = known.where(crc_remainder(F.col("l_key"), FOLDS) != 0)
    known = known.groupBy("l_key").agg(F.max("toxic").alias("toxic"))
    known = stored(known, "toxic-known")
    chosen = None
    for value, most in ((1, MAX_TOXIC), (0, MAX_CLEAN)):
        part = hash_sample(known.where(F.col("toxic") == value), "toxic", "l_key", most)
        chosen = part if chosen is None else chosen.unionByName(part)
    chosen = F.broadcast(stored(chosen, "toxic-labels"))  # at most MAX_TOXIC + MAX_CLEAN rows
    rows = docs.select(F.col(f"`{key}`").alias("key"), text_of(F.col(f"`{text}`")).alias("text"))
    return stored(rows.join(chosen, F.col("key") == F.col("l_key")).select("text", "toxic"), "toxic-sample")


def _words(text: str) -> set[str]:
    return {w for w in _WORD.findall(text.lower()) if w[0].isalpha()}


def _toxic_stems(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(stem, signature) for each text: near copies mostly share their signature, the least hash of a word."""
    for batch in batches:
        stems, signatures = [], []
        for text in batch["text"]:
            words = _words(text)
            own = {s for w in words if len(w) >= 3 for s in _stems(w)}
            sign = min((zlib.crc32(w.encode()) for w in words), default=0)
            stems += own
            signatures += [sign] * len(own)
        yield pd.DataFrame({"stem": pd.Series(stems, dtype=object), "sign": pd.Series(signatures, dtype="int64")})


def _clean_stems(wanted: frozenset[str]):
    def run(batches):
        found: Counter = Counter()
        for batch in batches:
            for text in batch["text"]:
                found.update({s for w in _words(text) for s in _stems(w) if s in wanted})
        yield pd.DataFrame({"stem": pd.Series(list(found), dtype=object), "n": pd.Series(list(found.values()), dtype="int64")})

    return run


def _features(model: Model, *keep: str):
    def run(batches):
        grammar = Grammar(model)
        for batch in batches:
            values = np.array([grammar.features(t) for t in batch["text"]], dtype=float).reshape(-1, len(FEATURES))
            out = {name: batch[name] for name in keep}
            yield pd.DataFrame(out | {n: values[:, i] for i, n in enumerate(FEATURES)} | {"score": grammar.score(values)})

    return run


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> tuple[float, ...]:
    """Newton's method; weights below zero are held at zero, as no match makes a text less toxic."""
    x = np.hstack([np.log1p(x), np.ones((len(x), 1))])
    free, w = np.ones(x.shape[1], dtype=bool), np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-3
    while True:
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            slope = x.T @ (p - y) + penalty * w
            curve = (x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty)
            step = np.zeros_like(w)
            step[free] = np.linalg.solve(curve[np.ix_(free, free)], slope[free])
            w -= step
            if np.abs(step).max() < 1e-8:
                break
        bad = free & (w < 0)
        bad[-1] = False
        if not bad.any():
            return tuple(w.tolist())
        free &= ~bad
        w[:] = 0


def learn(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id") -> Model:
    """The insult lexicon and the fit, from labelled rows whose crc32 remainder isn't 0."""
    sample = _sample(docs, labels, text, key)
    sizes = {r["toxic"]: (r["texts"], r["signs"]) for r in _sizes(sample)}
    toxic, clean = sizes.get(1, (0, 0)), sizes.get(0, (0, 0))
    model = Model(dict.fromkeys(INSULTS, PRIOR))
    if not toxic[0] or not clean[0]:
        return model
    least = max(LEAST, math.ceil(SUPPORT * toxic[1]))
    hits = (
        sample.where("toxic = 1")
        .select("text")
        .mapInPandas(_toxic_stems, "stem string, sign long")
        .groupBy("stem")
        .agg(F.count_distinct("sign").alias("signs"))
        .where(F.col("signs") >= least)
    )
    # Each toxic text of the sample supports its own words only: at most their number / ``least`` stems.
    hits = {r["stem"]: r["signs"] for r in hits.collect()}
    seen = (
        sample.where("toxic = 0")
        .select("text")
        .mapInPandas(_clean_stems(frozenset(hits) | frozenset(INSULTS)), "stem string, n long")
        .groupBy("stem")
        .agg(F.sum("n").alias("n"))
    )
    seen = {r["stem"]: r["n"] for r in seen.collect()}
    weights = {w: PRIOR for w in INSULTS if w not in hits and w not in seen}
    for stem, n in hits.items():
        ratio = ((n + 0.5) / (toxic[1] + 1)) / ((seen.get(stem, 0) + 0.5) / (clean[0] + 1))
        if ratio >= CONTRAST:
            weights[stem] = math.log(ratio)
    model = Model(weights)
    schema = "toxic int, " + ", ".join(f"{n} double" for n in (*FEATURES, "score"))
    rows = sample.mapInPandas(_features(model, "toxic"), schema).drop("score").collect()  # bounded sample
    x = np.array([[r[n] for n in FEATURES] for r in rows])
    return Model(weights, _logistic(x, np.array([r["toxic"] for r in rows], dtype=float)))


def _sizes(sample: DataFrame) -> list:
    schema = "toxic int, sign long"

    def run(batches):
        for batch in batches:
            signs = [min((zlib.crc32(w.encode()) for w in _words(t)), default=0) for t in batch["text"]]
            yield pd.DataFrame({"toxic": batch["toxic"], "sign": pd.Series(signs, dtype="int64")})

    counted = sample.mapInPandas(run, schema).groupBy("toxic")
    return counted.agg(F.count(F.lit(1)).alias("texts"), F.count_distinct("sign").alias("signs")).collect()


# --- scoring ---------------------------------------------------------------------------------------


def held_out(key: Column) -> Column:
    return crc_remainder(key, FOLDS) == 0


def toxicity(
    docs: DataFrame,
    labels: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    model: Model | None = None,
) -> DataFrame:
    """Score every whole text.

    Returns one row for each row of ``docs``: ``key``, ``held_out``, ``score`` (0 to 1), ``predicted`` (int,
    1 from a score of 0.5), and the sums that the grammar emitted (plain, negated, reported, targeted,
    threat).

    Null and empty texts have no clause and get the score of a text without matches. Labels other than 0
    and 1 are ignored, of several labels of one id the largest counts; without any labels the seed words
    and a fixed fit are used. Rows without an id are scored and never learned from. Repeated rows stay
    repeated, an empty table gives an empty result, other columns are ignored whatever their names.
    """
    model = model or learn(docs, labels, text, key)
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(f"`{key}`").alias("key"), text_of(F.col(f"`{text}`")).alias("text"))
    schema = f"key {kind}, " + ", ".join(f"{n} double" for n in (*FEATURES, "score"))
    scored = rows.mapInPandas(_features(model, "key"), schema)
    return scored.select(
        F.col("key").alias(key),
        held_out(F.col("key")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        *FEATURES,
    )


def without_toxic(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` that aren't predicted toxic, with all their columns; each row is judged itself."""
    model = learn(docs, labels, text, key)
    rows = docs.select(packed(docs).alias("row"), text_of(F.col(f"`{text}`")).alias("text"))

    @F.pandas_udf("double")
    def score(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        grammar = Grammar(model)
        for texts in parts:
            values = np.array([grammar.features(t) for t in texts], dtype=float).reshape(-1, len(FEATURES))
            yield pd.Series(grammar.score(values))

    return rows.where(score("text") < 0.5).select("row.*")
