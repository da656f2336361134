"""Toxicity, language ID and language-model scores: held-out results, exact parts, awkward rows."""

import math
import os
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from chronolake.llm import gru, lm_scoring
from chronolake.llm.language import language
from chronolake.llm.lm_scoring import lm_scores
from chronolake.llm.toxicity import INSULT, NEGATION, STOP, TARGET, Grammar, Model, compose, toxicity, without_toxic

FOLDER = "/root/testdata/sf0.01"
tables = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables not present")


def remainder(key, n):
    return zlib.crc32(("" if key is None else str(key)).encode()) % n


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


def test_grammar_tells_ways_of_saying_apart():
    grammar = Grammar(Model({"idiot": 2.0, "mor*": 1.0}))

    def features(text):
        return dict(zip(("plain", "negated", "reported", "targeted", "threat"), grammar.features(text)))

    assert features("Nothing here.")["plain"] == 0
    assert features("An idiot.") == {"plain": 2, "negated": 0, "reported": 0, "targeted": 0, "threat": 0}
    assert features("You idiot!")["targeted"] == 2
    assert features("Not an idiot.")["negated"] == 2
    assert features("Not this. An idiot.")["plain"] == 2
    assert features("He wrote: an idiot.")["reported"] == 2
    assert features("I kill time, you know")["threat"] == 0  # the clause has no target
    assert features("I kill you")["threat"] > 0
    assert features("such idiots")["plain"] == 0 and features("you are")["targeted"] == 0


def test_composed_table_follows_each_machine():
    table, state = compose(), 0
    for symbol in (NEGATION, INSULT, TARGET, STOP):
        state, before = table[state][symbol]
    assert before[0] and before[2] and before[4] and state == 0


@tables
def test_toxicity_held_out(spark, documents):
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    found = {r.doc_id: r for r in toxicity(documents, labels).collect()}
    assert len(found) == documents.count()
    assert all(r.held_out == (remainder(r.doc_id, 5) == 0) and r.predicted == (r.score >= 0.5) for r in found.values())
    known = [(found[r.doc_id], r.toxic) for r in labels.collect() if r.doc_id in found]
    held = [(r.predicted, toxic) for r, toxic in known if r.held_out]
    assert sum(p == t for p, t in held) >= 0.9 * len(held)


def test_toxicity_of_awkward_rows(spark, awkward, nothing):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    found = toxicity(awkward, none).collect()
    assert len(found) == awkward.count() and {r.predicted for r in found} == {0}
    assert toxicity(nothing, none).count() == 0
    odd = spark.createDataFrame([(1, 1), (1, 0), (None, 1), (11, None), (14, 7), (12, 0)], "doc_id long, toxic int")
    assert toxicity(awkward, odd).count() == awkward.count()
    insulted = awkward.selectExpr("doc_id", "IF(doc_id = 8, 'You pathetic idiot, you moron', text) AS text", "kept")
    assert {r.doc_id for r in insulted.exceptAll(without_toxic(insulted, none)).collect()} == {8}


@tables
def test_language_held_out(documents):
    found = language(documents).collect()
    actual = {r.doc_id: r.lang for r in documents.collect()}
    held = [r for r in found if r.held_out]
    assert sum(r.lang_pred == actual[r.doc_id] for r in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 and r.held_out == (remainder(r.doc_id, 5) == 0) for r in found)


def test_language_of_awkward_rows(awkward, nothing):
    found = language(awkward).collect()
    assert len(found) == awkward.count()
    by_id = {r.doc_id: r for r in found}
    assert all(by_id[i].lang_pred == "und" and by_id[i].score == 0 for i in (1, 2, 3))
    assert by_id[5].lang_pred == "en"
    assert language(nothing).count() == 0
    assert {r.lang_pred for r in language(awkward.selectExpr("doc_id", "text", "string(null) AS lang")).collect()} == {"und"}


def base_scores(rows):
    counts, texts = Counter(), []
    for key, text in rows:
        own = [*re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower()), None]
        texts.append((key, own))
        if remainder(key, 7) != 2:
            counts.update(own)
    n, v = sum(counts.values()), len(counts)
    return Counter(
        (
            str(key),
            remainder(key, 7) == 2,
            len(own),
            sum(counts[w] > 0 for w in own),
            n,
            f"{sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in own):.6f}",
        )
        for key, own in texts
    )


def found_scores(frame):
    return Counter(
        (str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, f"{r.base_score:.6f}") for r in frame.collect()
    )


@tables
def test_lm_scores(documents):
    found = lm_scores(documents).cache()
    assert found_scores(found) == base_scores([(r.doc_id, r.text) for r in documents.collect()])
    held = [r for r in found.collect() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_network_learns_from_every_training_text(spark, monkeypatch):
    """All rounds together read each training text once, however many there are, and nothing is sampled."""
    monkeypatch.setattr(lm_scoring, "ROUND_TOKENS", 2000)
    monkeypatch.setattr(lm_scoring, "ENOUGH", 1)
    seen = spark.sparkContext.accumulator(0)
    plain = lm_scoring._round

    def counting(*given):
        run = plain(*given)

        def counted(batches):
            for found in run(batches):
                seen.add(int(found["tokens"].sum()))
                yield found

        return counted

    monkeypatch.setattr(lm_scoring, "_round", counting)
    frame = spark.range(3000).selectExpr("id AS doc_id", "concat('some words of text ', id) AS text")
    found = lm_scores(frame).collect()
    assert seen.value == found[0].train_tokens == sum(r.n_tokens for r in found if not r.held_out)
    assert sum(r.score for r in found) > sum(r.base_score for r in found)


def test_lm_scores_of_awkward_rows(awkward, nothing):
    found = lm_scores(awkward)
    assert found_scores(found) == base_scores([(r.doc_id, r.text) for r in awkward.collect()])
    assert all(math.isfinite(r.score) for r in found.collect())
    assert lm_scores(nothing).count() == 0


def test_network_gradients_and_carried_states():
    """Slopes against differences; a text scored in windows equals one scored step by step."""
    listed, rare, end = 64, 3, 0
    random = np.random.default_rng(1)
    w = {k: v.astype(np.float64) for k, v in gru.initial(random.integers(1, 50, listed + rare), listed).items()}
    ids = random.integers(0, listed + rare, (6, 5))
    inputs, targets = ids[:-1], ids[1:]
    h = np.zeros((5, gru.HIDDEN))
    _, slopes, _ = gru._gradients(w, h, inputs, targets, end)
    for name in w:
        at = tuple(random.integers(0, n) for n in w[name].shape)
        values = []
        for move in (1e-5, -1e-5):
            moved = {**w, name: w[name].copy()}
            moved[name][at] += move
            values.append(gru._gradients(moved, h, inputs, targets, end)[0])
        assert math.isclose((values[0] - values[1]) / 2e-5, slopes[name][at], rel_tol=1e-3, abs_tol=1e-6), name
    texts = [np.append(random.integers(1, listed + rare, n), end) for n in (0, 3, 100, 33)]
    given = w["emb"] @ w["wx"] + w["b"]
    for text, total in zip(texts, gru.score(w, texts, end)):
        h, last, alone = np.zeros((1, gru.HIDDEN)), end, 0.0
        for token in text:
            h, _ = gru._step(h, given[[last]], w["u"])
            alone += gru.log_probabilities(w, h, np.array([token]))[0]
            last = token
        assert math.isclose(total, alone, rel_tol=1e-6)


def test_network_schedule_does_not_switch_by_corpus_size(spark, monkeypatch):
    """A small corpus gets the same schedule as a large one: ROUNDS rounds, each training text read once."""
    seen, calls = spark.sparkContext.accumulator(0), []
    plain = lm_scoring._round

    def counting(*given):
        calls.append(given)
        run = plain(*given)

        def counted(batches):
            for found in run(batches):
                seen.add(int(found["tokens"].sum()))
                yield found

        return counted

    monkeypatch.setattr(lm_scoring, "_round", counting)
    frame = spark.range(500).selectExpr("id AS doc_id", "concat('a few words ', id) AS text")
    found = lm_scores(frame).collect()
    assert len(calls) == lm_scoring.ROUNDS
    assert seen.value == found[0].train_tokens


def test_network_keeps_openblas_to_one_thread():
    """Spark runs a task on each core; the network's products must not start a spinning thread on every core too."""
    import ctypes

    with open("/proc/self/maps") as maps:
        paths = sorted({line.split()[-1] for line in maps if "openblas" in line.lower() and line.rstrip().endswith(".so")})
    libraries = [ctypes.CDLL(p) for p in paths]
    getters = [getattr(lib, n) for lib in libraries for n in ("scipy_openblas_get_num_threads64_", "openblas_get_num_threads") if hasattr(lib, n)]
    if not getters:
        pytest.skip("numpy is not built on OpenBLAS here")
    w = gru.initial(np.arange(1.0, 1057.0), 1024)
    texts = [np.array([3, 40, 1030, 7]), np.array([7])]
    gru.Learner(w).learn(texts, 7, gru.RATE)
    gru.score(w, texts, 7)
    assert [get() for get in getters] == [1] * len(getters)
