import random
import re
import textwrap

import pytest

from fellwalk.llm import op7_licences as op


def words(text):
    return re.findall(r"[^\x09-\x0D\x20-\x2F\x3A-\x40\x5B-\x60\x7B-\x7E]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def shingles(found):
    return [" ".join(found[i : i + 5]) for i in range(max(1, len(found) - 4))] if found else []


def brute(rows):
    """Every window of every text against every template."""
    best = {}
    for doc, text in rows:
        there = shingles(words(text))
        for name, notice in op.TEMPLATES.items():
            wanted = set(shingles(words(notice)))
            span = max(len(words(notice)) - 4, 1)
            stride = max(span // 4, 1)
            for start in range(0, len(there), stride):
                if wanted & set(there[start : start + span]):
                    matched = len(wanted & set(there[max(0, start - stride) : start + span + stride]))
                    if matched >= 0.8 * len(wanted):
                        best[doc, name] = max(best.get((doc, name), (0, 0)), (matched, -start))
    return {key: (matched, -back) for key, (matched, back) in best.items()}


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id bigint, text string, hashes int, span string")


def test_notices_agree_with_brute_force(spark):
    rng = random.Random(2)
    rows = [(-1, None), (-2, ""), (-3, "MIT"), (-4, "Released under the MIT License."), (-5, "released UNDER\nthe mit\tlicense.")]
    notices = list(op.TEMPLATES.values())
    for i in range(150):
        text = [f"w{rng.randrange(500)}" for _ in range(rng.randrange(0, 120))]
        for _ in range(rng.randrange(0, 3)):
            notice = rng.choice(notices).split()
            for _ in range(rng.randrange(0, 3)):
                notice[rng.randrange(len(notice))] = "changed"
            at = rng.randrange(0, len(text) + 1)
            text[at:at] = notice
        rows.append((i, " ".join(text)))
    rows += [rows[20], (500, "x " * 30_000 + notices[4])]
    got = {(r.doc_id, r.license): (r.matched, r.first_shingle) for r in op.scan(frame(spark, rows)).collect()}
    assert got == brute(rows) and len(got) > 40


@pytest.mark.parametrize("mark", ["// ", "# ", " * ", "<!-- ", ";; "])
def test_headers_behind_comment_marks(spark, mark):
    """Standard headers and bodies, wrapped at any width and commented out, are found with nearly all of their shingles."""
    long = {name: text for name, text in op.TEMPLATES.items() if len(text) > 150}
    assert len(long) >= 9
    rows = []
    for i, (name, text) in enumerate(long.items()):
        lines = textwrap.wrap(" ".join(text.split()), 40 + 7 * i)
        rows.append((i, "int main() {\n" + "\n".join(mark + line for line in lines) + "\nreturn 0; }"))
    got = {(r.doc_id, r.license): r.containment for r in op.scan(frame(spark, rows)).collect()}
    for i, name in enumerate(long):
        assert got[i, name] > 0.95


def test_odd_tables(spark):
    assert op.scan(frame(spark, [])).collect() == []
    assert op.scan(frame(spark, [(1, "Released under the MIT License.")]), {}).collect() == []
    found = op.scan(frame(spark, [(None, "a short notice"), (2, "two")]), {"own": "a short notice", "one": "Two"}).collect()
    assert sorted((str(r.doc_id), r.license, r.containment) for r in found) == [("2", "one", 1.0), ("None", "own", 1.0)]
