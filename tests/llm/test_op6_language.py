import itertools
import zlib

import numpy as np
import pytest

from fellwalk.llm import op6_language as op

DATA = "/root/testdata/sf0.01"


def brute(emission, transitions):
    """Label probabilities by going through all labellings."""
    n, k = emission.shape
    out = np.zeros((n, k))
    for path in itertools.product(range(k), repeat=n):
        weight = np.exp(sum(emission[i, p] for i, p in enumerate(path)) + sum(transitions[a, b] for a, b in zip(path, path[1:])))
        for i, p in enumerate(path):
            out[i, p] += weight
    return out / out.sum(axis=1, keepdims=True)


@pytest.mark.parametrize("piece", [1, 2, 3, 64])
def test_forward_backward_agrees_with_all_labellings(monkeypatch, piece):
    monkeypatch.setattr(op, "PIECE", piece)
    rng = np.random.default_rng(piece)
    sizes = [1, 7, 2, 5, 6, 3]
    bounds = np.append(0, np.cumsum(sizes))
    emission, transitions = rng.normal(size=(bounds[-1], 3)) * 2, rng.normal(size=(3, 3))
    expected = np.concatenate([brute(emission[a:b], transitions) for a, b in zip(bounds, bounds[1:])])
    assert np.allclose(op.marginals(emission, bounds, transitions), expected, atol=1e-9)


def test_held_out_accuracy_and_split(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    gold = {r.doc_id: (r.lang, r.text) for r in docs.collect()}
    got = op.identify(docs).collect()
    assert len(got) == len(gold)
    tested = [r for r in got if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 for r in got)
    assert sum(r.lang_pred == gold[r.doc_id][0] for r in tested) >= 0.97 * len(tested)


def test_switched_text_is_labelled_word_by_word():
    en, de = "the cat sat with the other and then they were here", "der hund und die katze nicht mit einem aber schnell"
    model = op.fit([en, de] * 30, ["en", "de"] * 30)
    words = op.words_of(en + " " + de + " " + en)
    found = op.marginals(op._emissions(words, model), np.array([0, len(words)]), model.transitions)
    n = len(op.words_of(en))
    names = [model.labels[i] for i in found.argmax(axis=1)]
    assert names == ["en"] * n + ["de"] * (len(words) - 2 * n) + ["en"] * n
    assert model.transitions[0, 0] > model.transitions[0, 1]


def test_rare_languages_are_labels(spark):
    ids = [i for i in range(9000) if zlib.crc32(str(i).encode()) % 3 != 1]
    rare = {f"r{k}": f"{chr(97 + k) * 3} {chr(98 + k) * 4} {chr(97 + k) * 2}{chr(99 + k) * 2}" for k in range(12)}
    rows = [(i, f"the cat number w{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676)} sat with the dog", "en") for i in ids[12:]]
    rows += [(i, text, lang) for i, (lang, text) in zip(ids, rare.items())]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    assert op.learn(docs).labels == sorted(["en", *rare])


def test_words_are_letters_with_their_marks():
    assert op.words_of("½ ² ① Ⅷ 12 _ +") == []
    assert op.words_of("हिन्दी ภาษาไทย العَرَبِيَّة e\u0301a x1y ²z") == ["हिन्दी", "ภาษาไทย", "العَرَبِيَّة", "e\u0301a", "x", "y", "z"]


def test_number_signs_are_no_language(spark):
    rows = [(i, t, l) for i, (t, l) in enumerate([("the cat and the dog", "en"), ("यह एक हिन्दी वाक्य है", "hi")] * 40)]
    rows += [(900, "½ ² ①", "en"), (901, "Ⅷ", "en"), (902, "हिन्दी वाक्य है", None)]
    got = {r.doc_id: r for r in op.identify(spark.createDataFrame(rows, "doc_id bigint, text string, lang string")).collect()}
    assert [(got[i].lang_pred, got[i].score, got[i].n_words) for i in (900, 901)] == [("und", 0.0, 0)] * 2
    assert got[902].lang_pred == "hi" and got[902].n_words == 3


def test_odd_rows(spark):
    rows = [(i, t, l, 1, "x") for i, (t, l) in enumerate([("the cat and the dog", "en"), ("der hund und die katze", "de")] * 40)]
    rows += [(900, None, "en", 1, "x"), (901, "", None, 1, "x"), (902, "123 !!", "de", 1, "x"), (None, "der hund und", None, 1, "x"), (903, "und " * 50_000, "de", 1, "x"), (903, "und " * 50_000, "de", 1, "x"), (904, "a" * 100_000, "en", 1, "x")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, score int, _row string")
    got = {r.doc_id: r for r in op.identify(docs).collect()}
    assert [(got[i].lang_pred, got[i].score) for i in (900, 901, 902)] == [("und", 0.0)] * 3
    assert got[None].lang_pred == "de" and got[None].held_out is False and got[903].n_words == 50_000
    kept = op.keep_identified(docs)
    assert kept.columns == docs.columns and kept.count() == len(rows) - 3
    nothing = docs.filter("doc_id = 901")
    assert [(r.lang_pred, r.score) for r in op.identify(nothing).collect()] == [("und", 0.0)]
    assert op.identify(docs.limit(0)).collect() == [] and op.keep_identified(docs.limit(0)).collect() == []
