"""Toxicity and language scores against plain restatements of their models, on whole tables and on texts made to be difficult."""

import os
import random
import sys

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

sys.path.insert(0, os.path.dirname(__file__))
import brute  # noqa: E402

from frameloom.llm import entries, langid, toxicity  # noqa: E402


@settings(deadline=None, max_examples=300)
@given(st.lists(st.sampled_from("IHTNRww"), max_size=18))
def test_composed_transducers_are_looks_around_each_word(symbols):
    grammar = toxicity.Grammar(dict.fromkeys(toxicity.INSULTS, 1.0))
    got = sorted(x for x in grammar.patterns.read(symbols) if x in toxicity.PATTERNS)
    assert got == sorted(brute.clause_patterns(symbols))


def test_toxicity_of_every_document(spark, tiny):
    docs, labels = (spark.read.parquet(f"{tiny}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.fit(docs.select("doc_id", "text"), labels.select("doc_id", "toxic").where(entries._crc(5) != 0))
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in entries.op4_toxicity(spark, tiny).collect():
        assert r["held_out"] == brute.held(r["doc_id"], 5, 0)
        assert r["score"] == pytest.approx(brute.toxicity(texts[r["doc_id"]], model, toxicity), abs=1e-9) and r["predicted"] == (r["score"] >= 0.5)


def test_toxicity_of_made_texts(spark):
    rnd = random.Random(1)
    model = {"insults": dict.fromkeys((*toxicity.INSULTS, *toxicity.INSULT_PHRASES), 1.5), "weights": [0.3, 0.9, -0.4, -0.6, 0.5, 1.1, -0.2, -0.7, 0.4, 0.1, 0.2, 0.3], "bias": -1.0}
    some = [*toxicity.INSULTS[:6], *toxicity.INSULT_PHRASES, *toxicity.THREATS[:4], *toxicity.THREAT_PHRASES, *toxicity.TARGETS[:6], *toxicity.NEGATIONS[:6], *toxicity.REPORTS[:4], "word", "a", "piece", "of", "don't", "Trash.", "YOU", "x;", "idiots!", "kill:", "y\nz", "é"]
    texts = [" ".join(rnd.choices(some, k=rnd.randrange(0, 40))) for _ in range(300)] + [None, "", "...", "idiot", "you idiot " * 2000]
    got = toxicity.score(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), model)
    for r in got.collect():
        assert r["score"] == pytest.approx(brute.toxicity(r["text"], model, toxicity), abs=1e-9)


def test_language_of_every_document(spark, tiny):
    docs = spark.read.parquet(f"{tiny}/documents.parquet").select("doc_id", "text", "lang")
    model = langid.fit(docs.where(entries._crc(4) != 2))
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    taught = [t for i, t in texts.items() if not brute.held(i, 4, 2)]
    # document frequencies count every learning row
    df = np.zeros(langid.DIM)
    for t in taught:
        df[list(brute.language_vector(t, np.ones(langid.DIM)))] += 1
    seen = sum(bool(t and any(c.isalpha() for c in t)) for t in taught)
    assert np.abs(model["idf"] - (np.log((1 + seen) / (1 + df)) + 1)).max() < 0.02
    for r in entries.op9_language(spark, tiny).collect():
        lang, score = brute.language(texts[r["doc_id"]], model, langid.DIM)
        assert (r["held_out"], r["lang_pred"]) == (brute.held(r["doc_id"], 4, 2), lang) and r["score"] == pytest.approx(score, abs=1e-6)


def test_steps_of_the_regularised_leader():
    rnd = random.Random(5)
    rows = [({f: rnd.uniform(-1, 1) for f in rnd.sample(range(30), 6)} | {langid.DIM: 1.0}, rnd.randrange(3)) for _ in range(80)]
    own = langid.Ftrl(3)
    for v, y in rows:
        at = [f for f in v if f != langid.DIM]
        own.learn(np.array(at), np.array([v[f] for f in at]), y)
    want = brute.ftrl(rows, 3, own.alpha, own.beta, own.l1, own.l2)
    got = own.weights()
    assert all(got[c, f] == pytest.approx(w, abs=1e-9) for (c, f), w in want.items())
    # the elastic net leaves weights at nothing
    assert any(w == 0.0 for w in want.values()) and sum(got[:, f].any() for f in range(langid.DIM)) <= 30


def test_labels_are_balanced_within_a_bound():
    y, c = np.array([1.0, 0.0, 0.0]), np.array([2.0, 5.0, 3.0])
    assert toxicity.balanced(y, c).tolist() == [8.0, 5.0, 3.0] and toxicity.balanced(1 - y, c).tolist() == [8.0, 5.0, 3.0]
    assert toxicity.balanced(y, np.array([1.0, 900.0, 100.0])).tolist() == [10.0, 900.0, 100.0]
    assert toxicity.balanced(np.ones(2), np.ones(2)).tolist() == [1.0, 1.0]
