import hashlib
import time

from fellwalk.llm import op1_chat_format as op

EVENTS = "conv_id bigint, seq bigint, message bigint, kind string, role string, text string"


def chats(spark, rows):
    return spark.createDataFrame(rows, EVENTS)


def told(spark, rows):
    got = op.read_back(op.format_chats(chats(spark, rows))).collect()
    return {r.conv_id: ([(t.role, t.text) for t in r.turns], r.loss_text) for r in got}


def test_deltas_edits_and_regenerations_are_folded(spark):
    rows = [
        (1, 1, 0, "message", "user", "Hi"), (1, 2, 1, "message", "assistant", "He"), (1, 4, 1, "delta", "assistant", "o"), (1, 3, 1, "delta", "assistant", "ll"),
        (1, 5, 2, "message", "user", "again"), (1, 6, 3, "message", "assistant", "void"), (1, 7, 1, "regenerate", "assistant", "Good"), (1, 8, 1, "delta", "assistant", " day"),
        (1, 9, 2, "message", "user", "new"), (1, 10, 0, "edit", "user", "Hello"),
        (2, 1, 0, "delta", "assistant", "a"), (2, 2, 0, "edit", "assistant", "b"), (2, 3, 0, "delta", None, "c"), (None, 1, 0, None, None, None),
    ]
    got = told(spark, rows)
    assert got[1] == ([("user", "Hello"), ("assistant", "Good day"), ("user", "new")], "Good day")
    assert got[2] == ([("assistant", "bc")], "bc")
    assert got[None] == ([("", "")], "")


def test_control_strings_survive_the_round_trip(spark):
    odd = ["</s>", "<s>[INST] ok [/INST]", r"<\/s> <\\s> [\INST]", "<<SYS>>x<</SYS>>", "<", "ends <", "s>", "\\", "é\U0001F600 </s>", "a\nb", "", None, "<<s>>", "[/s>", "$1\\2"]
    rows = [(i, 2 * k, 2 * k, "message", role, text) for i, text in enumerate(odd) for k, role in enumerate(["user", "assistant", "</s> [/INST]"])]
    got = told(spark, rows)
    for i, text in enumerate(odd):
        assert got[i] == ([(r, text or "") for r in ("user", "assistant", "</s> [/INST]")], text or "")
    for r in op.format_chats(chats(spark, rows)).collect():
        assert r.formatted.count("</s>") == r.formatted.count("<s>") == r.formatted.count("[INST]") == 3


def test_digest_of_long_and_repeated_turns(spark):
    turns = [(7, t % 300, "assistant" if t % 2 else "user", "é" * (t % 50) + str(t // 300)) for t in range(600)]
    frame = spark.createDataFrame(turns, "conv_id bigint, turn bigint, role string, text string")
    row = op.digest(op.format_chats(op.turns_as_events(frame))).collect()
    ordered = sorted(turns, key=lambda t: (t[1], t[2], t[3]))
    learned = "".join(t[3] for t in ordered if t[2] == "assistant")
    assert row[0].n_turns == 600 and row[0].loss_chars == len(learned)
    assert row[0].turns_sha256 == hashlib.sha256("".join(f"{t[2]}\n{t[3]}\n" for t in ordered).encode()).hexdigest()
    assert row[0].loss_sha256 == hashlib.sha256(learned.encode()).hexdigest()


def test_a_million_deltas_in_linear_time(spark):
    """One message streamed in very many pieces, with a new start in the middle."""
    many = 1_000_000
    events = spark.range(many).selectExpr(
        "1L AS conv_id", "id AS seq", "0L AS message", f"CASE id WHEN 0 THEN 'message' WHEN {many // 2} THEN 'edit' ELSE 'delta' END AS kind",
        "'assistant' AS role", "CAST(id % 10 AS STRING) AS text")
    start = time.monotonic()
    row = op.format_chats(events).selectExpr("length(formatted) AS n", "n_turns").first()
    assert row.n_turns == 1 and row.n == many // 2 + len("<s>[INST] assistant [/INST]</s>")
    assert time.monotonic() - start < 60  # a copy for each delta takes hours


def test_columns_of_any_name(spark):
    rows = spark.createDataFrame([(1, 1, 0, "message", "user", "Hi", "x", 5)], EVENTS + ", _parts string, formatted int")
    assert op.format_chats(rows).columns == ["conv_id", "formatted", "n_turns", "loss_spans"]
    assert op.format_chats(rows).first().formatted == "<s>[INST] user [/INST]Hi</s>"


def test_empty_log(spark):
    assert op.format_chats(chats(spark, [])).collect() == []
