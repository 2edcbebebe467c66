"""The pipeline against brute force, stage by stage, each on what the one before it kept."""

import re
import zlib

import numpy as np
import pytest
import regex
from brute_near_dedup import components
from brute_personal_data import base_spans
from test_op4_mixing import expected_targets

import corpus_pipeline
from fellwalk.llm.common import documents
from fellwalk.workspace import settled

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """Rows after every stage, the given rows first, with rows of nulls and odd texts among them."""
    given = documents(spark, DATA)
    odd = spark.createDataFrame([(10**6, None, "en", "src0", 0), (10**6 + 1, "12 34 ..", "de", None, 8), (10**6 + 2, "", None, "src0", 0)], given.schema)
    docs, out = settled(given.unionByName(odd), "given"), []
    out.append(docs)
    for name, stage in corpus_pipeline.STAGES:
        docs = settled(stage(spark, docs, DATA), name)
        out.append(docs)
    return out


def test_columns_stay_until_the_last_stage(stages):
    for frame in stages[:-1]:
        assert frame.columns == ["doc_id", "text", "lang", "source", "n_chars"]


def test_language_rejects_texts_without_letters_alone(stages):
    before, after = ({r.doc_id: r.text for r in s.collect()} for s in stages[:2])
    assert set(after) == {d for d, t in before.items() if regex.search(r"\p{L}", t or "")}
    assert all(after[d] == before[d] for d in after)


def test_one_document_of_each_group_stays(stages):
    rows = [(r.doc_id, r.text) for r in stages[1].collect()]
    kept = [d for (d, _), (_, c) in zip(rows, components(rows, 80)) if d == c]
    assert sorted(r.doc_id for r in stages[2].collect()) == sorted(kept)


def test_personal_data_is_masked(stages):
    before, after = ({r.doc_id: r for r in s.collect()} for s in stages[2:4])
    assert set(before) == set(after)
    for d, row in after.items():
        assert base_spans(row.text) == [] and row.n_chars == len(row.text)
        if not base_spans(before[d].text):
            assert row.text == before[d].text
    assert any(base_spans(r.text) for r in before.values())


def test_sources_come_near_their_targets(stages):
    words = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t))
    before, after = ([(r.doc_id, r.source, words(r.text)) for r in s.collect()] for s in stages[3:5])
    assert set(after) <= set(before) and max(after.count(r) for r in set(after)) <= 2
    sizes, taken, largest = {}, {}, {}
    for _, s, n in before:
        sizes[s], largest[s] = sizes.get(s, 0) + n, max(n, largest.get(s, 0))
    for _, s, n in after:
        taken[s] = taken.get(s, 0) + n
    for s, target in expected_targets(sizes).items():
        assert abs(taken.get(s, 0) - target) <= max(0.1 * target, largest[s])


def test_packing_places_every_token_once(spark, stages):
    from tokenizers import Tokenizer

    from fellwalk.llm.queries import vocabulary

    tokenizer = Tokenizer.from_file(vocabulary())
    expected = []
    for r in stages[4].collect():
        ids = np.asarray([*tokenizer.encode(r.text, add_special_tokens=False).ids, 1], dtype="<u4")
        expected += [(r.doc_id, k, s, len(ids[s : s + 4096]), zlib.crc32(ids[s : s + 4096])) for k, s in enumerate(range(0, len(ids), 4096))]
    packed = stages[5].collect()
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in packed) == sorted(expected)
    filled = {}
    for r in sorted(packed, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == filled.get(r.sequence_id, 0)
        filled[r.sequence_id] = r.offset + r.length
    assert max(filled.values()) <= 4096 and len(filled) <= sum(filled.values()) / 4096 + 2
    assert corpus_pipeline.run(spark, DATA).columns == stages[5].columns
