"""Chat formatting: conversations rebuilt from an event log, then rendered with turn marks and a loss mask.

The log has one row per event: ``conv_id``, ``seq`` (order in the conversation), ``message`` (position of the message it is
about), ``kind``, ``role``, ``text``. Kinds:

* ``message`` starts a message; ``delta`` appends streamed text to it; ``edit`` replaces its text;
* ``regenerate`` replaces its text too, and everything said after that message before the event is void.

The fold needs no row-at-a-time state: a regeneration voids the earlier events of later messages (a running maximum over the
messages), and a message's text is what it was last set to, followed by the deltas after that.

Rendering: each turn is ``<s>[INST] role [/INST]text</s>``. A control string inside a role or text gets a backslash after its
first character, one more than it has, so escaping is undone exactly and no control string is left but the marks.
``formatted`` comes with ``loss_spans``, the code points of it that hold assistant text.

One conversation becomes one row of output and so must fit into a row; nothing else is gathered.

Nulls and odd input: null texts and roles are empty; a null ``conv_id`` is a conversation of its own; events with equal
``seq`` follow ``message`` and then text; an event whose message was never started starts it; unknown kinds count as
``message``; an empty log gives no rows; columns of other names are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from fellwalk.llm.common import bound, cut, text_blocks

# The template (fixed values): marks of a turn, and the control strings that texts must not contain unescaped.
OPEN, ROLE_END, CLOSE = "<s>[INST] ", " [/INST]", "</s>"
CONTROL = r"</?SYS>>|/?s>|/?INST\]"
LEARNED_ROLE = "assistant"


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, rf"([<\[])(\\*)({CONTROL})", r"$1\\$2$3")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, rf"([<\[])\\(\\*)({CONTROL})", "$1$2$3")


def rebuild(events: DataFrame) -> DataFrame:
    """``conv_id, message, role, text``: the final messages after deltas, edits and regenerations."""
    log = events.select(
        "conv_id", "seq", "message", F.coalesce("kind", F.lit("message")).alias("kind"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    )
    earlier = Window.partitionBy("conv_id").orderBy("message").rangeBetween(Window.unboundedPreceding, -1)
    voided = F.max(F.when(F.col("kind") == "regenerate", F.col("seq"))).over(earlier)
    kept = log.withColumn("_void", voided).filter("_void IS NULL OR seq > _void")
    place = F.struct("seq", "text", "role")
    setting = F.col("kind") != "delta"
    per_message = kept.groupBy("conv_id", "message").agg(
        F.sort_array(F.collect_list(F.struct("seq", "text", setting.alias("sets")))).alias("_parts"),
        F.max(F.when(setting, place)).alias("_set"),
        F.min_by("role", "seq").alias("_first_role"),
    )
    # from the last part that sets the text on; all of them if none does
    last = F.coalesce(F.array_max(F.transform("_parts", lambda p, i: F.when(p["sets"], i))), F.lit(0))
    texts = F.transform(F.slice("_parts", last + 1, F.size("_parts")), lambda p: p["text"])
    return per_message.select("conv_id", "message", F.coalesce("_set.role", "_first_role").alias("role"), F.array_join(texts, "").alias("text"))


def render(messages: DataFrame, order: str = "message") -> DataFrame:
    """``conv_id, formatted, n_turns, loss_spans`` of messages ``conv_id, <order>, role, text``."""
    turns = messages.select(
        "conv_id", F.col(order).alias("_order"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    shown = turns.select(
        "conv_id", "_order",
        F.concat(F.lit(OPEN), escaped(F.col("role")), F.lit(ROLE_END)).alias("head"), escaped(F.col("text")).alias("body"),
        (F.col("role") == LEARNED_ROLE).alias("learned"),
    )
    lists = shown.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("_order", "head", "body", "learned"))).alias("_turns"))
    step = f"""(state, t) -> named_struct(
        'at', state.at + length(t.head) + length(t.body) + {len(CLOSE)},
        'out', IF(t.learned, array_append(state.out, named_struct('start', state.at + length(t.head), 'end', state.at + length(t.head) + length(t.body))), state.out))"""
    zero = "named_struct('at', 0, 'out', cast(array() AS array<struct<start:int,end:int>>))"
    return lists.select(
        "conv_id",
        F.array_join(F.transform("_turns", lambda t: F.concat(t["head"], t["body"], F.lit(CLOSE))), "").alias("formatted"),
        F.size("_turns").cast("bigint").alias("n_turns"),
        F.expr(f"aggregate(_turns, {zero}, {step}, state -> state.out)").alias("loss_spans"),
    )


def format_chats(events: DataFrame) -> DataFrame:
    """The operator: an event log to ``conv_id, formatted, n_turns, loss_spans``."""
    return render(rebuild(events))


def read_back(formatted: DataFrame) -> DataFrame:
    """``conv_id, turns, loss_text, formatted``: roles and texts parsed from the marks, learned text cut by the mask."""
    pattern = r"(?s)<s>\[INST\] (.*?) \[/INST\](.*?)</s>"
    part = lambda group: F.regexp_extract_all("formatted", F.lit(pattern), F.lit(group))
    turns = F.transform(
        F.arrays_zip(part(1).alias("role"), part(2).alias("text")),
        lambda t: F.struct(unescaped(t["role"]).alias("role"), unescaped(t["text"]).alias("text")))
    learned = bound(text_blocks(F.col("formatted")), lambda blocks: F.transform("loss_spans", lambda s: unescaped(cut(blocks, s["start"], s["end"]))))
    return formatted.select("conv_id", "formatted", turns.alias("turns"), F.array_join(learned, "").alias("loss_text"))


def digest(formatted: DataFrame) -> DataFrame:
    """Sizes and hashes of what :func:`read_back` finds."""
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read_back(formatted).select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length("loss_text").cast("bigint").alias("loss_chars"),
        F.sha2(F.col("loss_text"), 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )


def turns_as_events(turns: DataFrame) -> DataFrame:
    """Stored turns as a log: every row one message. Rows that share a turn are messages of their own, by role and text."""
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    place = F.row_number().over(order).cast("bigint")
    return turns.select("conv_id", place.alias("seq"), place.alias("message"), F.lit("message").alias("kind"), "role", "text")
