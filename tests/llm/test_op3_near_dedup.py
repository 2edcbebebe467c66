import random

import pytest
from brute_near_dedup import components, shingles

from fellwalk.llm import op3_near_dedup as op

SCHEMA = "doc_id bigint, text string, lang string, node int, _words string"


def edited(rng, words, share):
    return [rng.choice(["x", "y", "z"]) + str(rng.randrange(10**6)) if rng.random() < share else w for w in words]


def corpus(seed):
    """Copies, light and heavy edits, chains, a dense group around one base, and odd texts."""
    rng = random.Random(seed)
    fresh = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    texts = [None, "", " \n\t", "one", "ONE", "one two three four", "one two three four five", "A b\x0bC d e", "é É é é é f", None]
    for _ in range(25):
        base = fresh(rng.randrange(30, 250))
        texts += [" ".join(base), " ".join(base).upper(), "\n".join(base) + " "]
        texts += [" ".join(edited(rng, base, share)) for share in (0.004, 0.01, 0.015, 0.02, 0.03, 0.08)]
    chain = fresh(200)
    for _ in range(15):
        chain = chain[6:] + fresh(6)
        texts.append(" ".join(chain))
    dense = fresh(150)
    texts += [" ".join(dense)] + [" ".join(edited(rng, dense, rng.choice([0.01, 0.014, 0.02]))) for _ in range(330)]
    rng.shuffle(texts)
    return [(i * 3, t) for i, t in enumerate(texts)]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", 5, "x") for i, t in rows], SCHEMA).repartition(4)


def test_components_agree_with_brute_force(spark):
    rows = corpus(3)
    expected = {doc: found for (doc, _), found in zip(rows, components(rows))}
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in op.groups(frame(spark, rows)).collect()}
    assert {d for d in expected if got[d] != expected[d]} == set()
    kept = op.deduplicate(frame(spark, rows))
    assert kept.columns == ["doc_id", "text", "lang", "node", "_words"]
    assert sorted(r.doc_id for r in kept.collect()) == sorted(d for d, (_, c) in expected.items() if d == c)


@pytest.mark.parametrize("similar", [80, 85, 92])
def test_every_similarity_agrees_with_brute_force(spark, similar):
    """Planted pairs around the similarity asked for; near copies of 0.8 to 0.85 are links at 0.8 alone."""
    rng = random.Random(similar)
    rows = []
    for k in range(150):
        base = [f"w{rng.randrange(10**6)}" for _ in range(rng.randrange(40, 160))]
        rows += [(2 * k, " ".join(base)), (2 * k + 1, " ".join(edited(rng, base, rng.choice([0.008, 0.016, 0.02, 0.024, 0.03]))))]
    got = sorted((r.doc_id, r.component_id) for r in op.groups(frame(spark, rows), (similar, 100)).collect())
    assert got == [(doc, found) for (doc, _), (_, found) in zip(rows, components(rows, similar))]


def test_misses_are_bounded_at_every_similarity():
    for similar, least, trees in ((85, 5, 24), (80, 4, 27)):
        forest = op.Forest((similar, 100))
        assert (forest.least, forest.trees) == (least, trees)
        assert (1 - forest.share**forest.least) ** forest.trees < op.MISS
    assert 0.69 < op.Forest((85, 100)).likely < 0.71 and 0.62 < op.Forest((80, 100)).likely < 0.66


def test_crowded_regions_lose_no_link(spark, monkeypatch):
    """Hundreds of pages from one template, each with its own field or two: regions are crowded down to the full depth."""
    monkeypatch.setattr(op, "REGION", 8)
    rng = random.Random(8)
    page = [f"p{i}" for i in range(120)]
    texts = []
    for k in range(400):
        words = list(page)
        for at in rng.sample(range(120), rng.choice([1, 2, 3, 4])):
            words[at] = f"v{rng.randrange(10**6)}"
        texts.append(" ".join(words))
    rows = list(enumerate(texts))
    got = sorted((r.doc_id, r.component_id) for r in op.groups(frame(spark, rows)).collect())
    assert got == [(doc, found) for (doc, _), (_, found) in zip(rows, components(rows))]


def test_sets_are_those_of_the_definition():
    texts = [t for _, t in corpus(9)][:200]
    for text, found in zip(texts, op.shingle_sets([t or "" for t in texts])):
        assert len(found) == len(shingles(text))


def test_null_and_repeated_ids(spark):
    long = " ".join(f"t{i}" for i in range(60))
    rows = [(None, long), (None, long), (7, long + " end"), (7, long + " end"), (4, "other text of some few words"), (4, "other text of some few words"), (None, "lonely words without any id at all"), (None, None), (9, None), (9, None)]
    got = sorted(((r.doc_id or -1, r.component_id or -1, r.kept) for r in op.groups(frame(spark, rows)).collect()))
    assert got == sorted([(-1, 7, False)] * 2 + [(7, 7, True)] * 2 + [(4, 4, True)] * 2 + [(-1, -1, True)] * 2 + [(9, 9, True)] * 2)
    kept = sorted((str(r.doc_id), r.text or "") for r in op.deduplicate(frame(spark, rows)).collect())
    assert kept == sorted([("7", long + " end"), ("4", "other text of some few words"), ("None", "lonely words without any id at all"), ("None", ""), ("9", ""), ("9", "")])


def test_empty_table(spark):
    assert op.groups(frame(spark, [])).collect() == [] and op.deduplicate(frame(spark, [])).collect() == []
