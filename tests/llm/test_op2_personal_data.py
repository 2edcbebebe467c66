import random
import re

from brute_personal_data import base_sha256, base_spans
from pyspark.sql import functions as F

from fellwalk.llm import op2_personal_data as op

ODD = [
    None, "", " ", "mail a@b.c_d@e.f.g and x@y", "1.2.3.4.5.6.7.8 256.1.1.1 001.002.003.004 1.2.3.99999999999999",
    "4111 1111 1111 1111 and 4111-1111-1111-1112, 4111111111111111.1.2.3", "+1 (626) 555-5759 +49 (0)30 1234567 +1 2", "+1 4111 1111 1111 1111",
    "ééé \U0001F600 joe@mail.example.com\n\U0001F600 +33 1 23 45 67 89", "GB82 WEST 1234 5698 7654 32 and GB82 WEST 1234 5698 7654 33",
    "his social security number is 078-05-1120, not 078-05-1121-2", "order 078-05-1120", "9" * 30000, "a" * 30000 + "@", "a.b" * 20000, "a@b" + ".c" * 20000,
    "1 2" * 9000, "x" * 5000 + " joe@mail.example.com " + "y" * 5000 + " 55.77.148.237", "1.1.1.14111 1111 1111 1111@x.yz",
]


def frame(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string")


def test_base_spans_agree_with_brute_force(spark):
    rng = random.Random(5)
    texts = ODD + ["".join(rng.choice(["1", "23", "4111 1111 1111 1111", ".", "@", "+", "-", " ", "a", "é", "(", "255", "\n"]) for _ in range(rng.randrange(60))) for _ in range(600)]
    got = {r.doc_id: r for r in op.digest(frame(spark, texts)).collect()}
    for i, text in enumerate(texts):
        assert got[i].base_sha256 == base_sha256(text), text
        spans = [s for s in got[i].spans.split(",") if s]
        assert [s for s in spans if s.split(":")[0] in ("email", "ip", "card", "phone")] == base_spans(text)
        assert got[i].n_email == sum(s.startswith("email") for s in spans)


def test_checksum_and_context_decide_the_added_kinds(spark):
    got = {r.doc_id: r.spans for r in op.digest(frame(spark, ODD)).collect()}
    assert [s for s in got[9].split(",") if s.startswith("iban")] == ["iban:0:27"]
    assert got[10] == "ssn:30:41" and got[11] == ""


def test_ibans_end_before_upper_case_words_and_numbers(spark):
    de, gb, no = "DE89 3704 0044 0532 0130 00", "GB82 WEST 1234 5698 7654 32", "NO9386011117947"
    cases = [
        (f"IBAN {de} BIC COBADEFF", [de]), (f"{gb} EUR 500", [gb]), (f"{de} {gb} {no}", [de, gb, no]), (f"REF GB12 {de} 2024 AB", [de]), (f"{no} 12", [no]),
        (f"{de}7", []), (f"{de} {'AB12 ' * 40}", [de]), ("DE89 3704 0044 0532 0130 01 BIC COBADEFF", []), (f"{gb.replace(' ', '')} X", [gb.replace(" ", "")]),
    ]
    got = {r.doc_id: r.spans for r in op.find_spans(frame(spark, [t for t, _ in cases])).collect()}
    for i, (text, wanted) in enumerate(cases):
        assert [text[s.start : s.end] for s in got[i] if s.kind == "iban"] == wanted, text


def test_context_is_the_text_before_a_span_whatever_matches_in_it(spark):
    word, number = re.compile(r"\b(?:ssn|social security|security number)", re.IGNORECASE), re.compile(r"\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b")
    texts = ["SSN: 078-05-1120, 219-09-9999", "SSN " + "078-05-1120 " * 9, "ssn" + " " * 57 + "078-05-1120", "ssn" + " " * 58 + "078-05-1120",
             "078-05-1120 ssn 078-05-1120" + "-" * 40 + " 078-05-1120 " + "\U0001F600" * 9 + " 078-05-1120", "078-05-1120 " * 4 + "ssn " + "078-05-1120 " * 4, "ssn 078-05-1120-219-09-9999"]
    got = {r.doc_id: r.spans for r in op.find_spans(frame(spark, texts)).collect()}
    for i, text in enumerate(texts):
        wanted = [m.start() for m in number.finditer(text) if word.search(text[max(0, m.start() - op.CONTEXT_CHARS) : m.start()])]
        assert [s.start for s in got[i] if s.kind == "ssn"] == wanted, text
    assert op.redact(frame(spark, texts[:1])).first().text == "SSN: [SSN], [SSN]"


def test_columns_of_any_name_stay(spark):
    docs = spark.createDataFrame([(1, "to a@b.cd", [5], "r", 9, 0.5)], "doc_id bigint, text string, _spans array<int>, row string, n_chars int, spans double")
    found = op.redact(docs)
    assert found.dtypes == docs.dtypes
    assert tuple(found.first()) == (1, "to [EMAIL]", [5], "r", 10, 0.5)


def test_redaction_masks_every_span_and_nothing_else(spark):
    docs = frame(spark, ODD).withColumn("n_chars", F.length("text").cast("bigint")).withColumn("_at", F.lit("kept")).withColumn("spans", F.lit(1))
    got = {r.doc_id: r for r in op.redact(docs).collect()}
    assert got[0].text is None and got[1].text == "" and got[0]["_at"] == "kept" and got[0]["spans"] == 1
    assert got[8].text == "ééé \U0001F600 [EMAIL]\n\U0001F600 [PHONE]" and got[8].n_chars == len(got[8].text)
    assert got[17].text == "x" * 5000 + " [EMAIL] " + "y" * 5000 + " [IP]"
    for i, text in enumerate(ODD):
        assert base_spans(got[i].text) == []
        if not base_spans(text) and i not in (9, 10):
            assert got[i].text == text


def test_empty_table(spark):
    assert op.digest(frame(spark, [])).collect() == [] and op.redact(frame(spark, [])).collect() == []
