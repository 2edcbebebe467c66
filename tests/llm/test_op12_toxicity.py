"""Toxicity: held-out accuracy, what may be learned from, the label model on votes with known accuracies, odd input."""

import zlib

import numpy as np
import pytest

from fellwalk.llm import op12_toxicity as op12

DOCS, LABELS = "doc_id bigint, text string, lang string", "doc_id bigint, quality int, toxic int"


def held(doc):
    return doc is not None and zlib.crc32(str(doc).encode()) % 5 == 0


def made(seed, count):
    """Documents of random words; toxic ones hold insults, or words with a start that no fixed list knows."""
    draw = np.random.default_rng(seed)
    docs, labels = [], []
    for i in range(count):
        words = [f"{a}{b}" for a, b in draw.choice(["ab", "cer", "dolu", "mi", "nast", "per", "quo", "ver"], (int(draw.integers(15, 120)), 2))]
        toxic = draw.random() < 0.2
        if toxic:
            for at in draw.integers(0, len(words), 4):
                words[at] = str(draw.choice(["idiot", "pathetic", "loser"])) if i % 2 else "zorg" + str(draw.choice(["a", "ent", "ul"]))
        docs.append((i, " ".join(words), "xx"))
        labels.append((i, 1, int(toxic)))
    return docs, labels


def scores(spark, docs, labels):
    out = op12.toxicity(spark.createDataFrame(docs, DOCS).repartition(3), spark.createDataFrame(labels, LABELS)).collect()
    assert all(r.held_out == held(r.doc_id) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in out)
    return sorted(((r.doc_id, r.score) for r in out), key=repr)


@pytest.fixture(scope="module")
def learned(spark):
    docs, labels = made(1, 1200)
    return docs, labels, scores(spark, docs, labels)


def test_held_out_accuracy(learned):
    _, labels, found = learned
    toxic = {d: t for d, _, t in labels}
    pairs = [(toxic[d], s) for d, s in found if held(d)]
    high, low = np.asarray([s for t, s in pairs if t]), np.asarray([s for t, s in pairs if not t])
    assert (high[:, None] > low[None]).mean() > 0.99
    assert (high >= 0.5).mean() > 0.95 and (low >= 0.5).mean() < 0.02


def test_reruns_agree_and_held_out_labels_are_not_learned(spark, learned):
    docs, labels, found = learned
    turned = [(d, q, 1 - t if held(d) else t) for d, q, t in labels]
    assert scores(spark, docs, turned) == found


def test_odd_rows(spark):
    docs, labels = made(2, 300)
    docs += [(1000, None, None), (1001, "", "xx"), (1002, " !!! ...", None), (None, "idiot loser", None), (1003, "idiot " + "mi" * 60_000, None),
             (1004, "cerab idiot pathetic loser idiot", "a"), (1004, "cerab idiot pathetic loser idiot", "b")]
    labels += [(None, 0, 1), (1000, None, None), (1001, 1, 0), (1001, 1, 0), (5000, 1, 1)]
    found = scores(spark, docs, labels)
    assert len(found) == len(docs)
    same = [s for d, s in found if d == 1004]
    assert same[0] == same[1] > 0.5
    empty = [s for d, s in found if d in (1000, 1001)]
    assert empty[0] == empty[1] < 0.5


@pytest.mark.parametrize("labels", [[], [(1, 1, 1), (2, 1, 1)], [(2, 1, 0), (4, 1, 0)]])
def test_labels_of_one_class_or_none(spark, labels):
    docs = [(1, "you are an idiot, a pathetic loser", "x"), (2, "plain words of a text", "x"), (3, None, "x")]
    found = dict(scores(spark, docs, labels))
    assert found[1] > found[2]


def test_empty_tables_and_clashing_columns(spark):
    labels = spark.createDataFrame([(1, 1, 1, "a", 0.5)], LABELS + ", text string, score double")
    assert op12.toxicity(spark.createDataFrame([], DOCS), labels).collect() == []
    docs = spark.createDataFrame([(1, "a b", "x", 7, True, 3)], DOCS + ", toxic int, held_out boolean, votes int")
    assert len(op12.toxicity(docs, labels.limit(0)).collect()) == 1


def test_label_model_finds_accuracies_and_correlations():
    """Votes drawn with known accuracies; the third voter copies the second nine times in ten. Few rows have labels."""
    draw = np.random.default_rng(3)
    count, share = 60_000, 0.2
    toxic = draw.random(count) < share
    on_toxic, on_clean = np.asarray([0.6, 0.5, 0.5, 0.7, 0.1]), np.asarray([0.05, 0.1, 0.1, 0.2, 0.8])
    votes = draw.random((count, 5)) < np.where(toxic[:, None], on_toxic, on_clean)
    copies = draw.random(count) < 0.9
    votes[copies, 2] = votes[copies, 1]
    both = votes.T.astype(float) @ votes
    some = draw.permutation(count)[:400]
    seen = [votes[some][toxic[some] == s].sum(axis=0) for s in (True, False)]
    sizes = [int((toxic[some] == s).sum()) for s in (True, False)]
    model = op12.LabelModel(both, count, seen[0], sizes[0], seen[1], sizes[1], 4)
    assert np.abs(model.on_toxic - on_toxic).max() < 0.08 and np.abs(model.on_clean - on_clean).max() < 0.03
    found = {(i, j) for i, j in zip(*np.nonzero(model.correlation > op12.CORRELATED)) if i < j}
    assert found == {(1, 2)}
    bits = (votes * (1 << np.arange(5))).sum(axis=1)
    odds = model.log_odds(bits)
    assert ((odds > 0) == toxic).mean() > 0.9
    high, low = odds[toxic][:1500], odds[~toxic][:1500]
    assert (high[:, None] > low[None]).mean() > 0.93


def test_votes_and_counts_of_texts(spark):
    """Slots and counts against a plain count."""
    texts = ["Idiot idiot! You are such an idiot", "idioten und IDIOTA", "quiet words", "NO!!! STOP THIS RIGHT NOW!!!", "zorga zorgul"]
    rows = op12.features(spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string"), [("zorg-", 0.0), ("quiet", 0.9)]).orderBy("doc_id").collect()
    names = [*op12.FIXED, "zorg-", "quiet"]
    found = [{names[s]: c for s, c in zip(r.slots, r.counts)} for r in rows]
    assert found == [
        {"insults": 3, "german": 3, "french": 3, "attack": 1}, {"german": 1, "spanish": 1}, {"quiet": 1}, {"shouting": 1, "exclaimed": 2}, {"zorg-": 2}]
    fixed = len(op12.FIXED)
    bits = [{i for i in range(fixed + 4) if r.votes >> i & 1} for r in rows]
    assert bits[4] == {fixed, fixed + 2} and bits[2] == {fixed + 2, fixed + 3}  # "quiet" is not dense enough to vote
