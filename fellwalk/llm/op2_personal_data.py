"""Personal data: patterns propose spans, checksums confirm them, context words adjust the score; spans can be masked.

SQL functions alone. A kind's matches and the texts between them come from one pattern (``regexp_extract_all`` and
``split`` see the same leftmost matches), so positions are running sums of lengths, and the text is gone through once per kind.

Kinds, in the order that settles equal starts:

==========  =====================================================  =======================================================
email       local part, @, labels parted by dots                   always kept
ip          four numbers parted by dots                            each at most 255
card        digits with single blanks or hyphens                   12 to 19 digits that pass Luhn
phone       + and digits with blanks, dots, brackets, hyphens      9 to 15 digits
iban        two letters, two digits, 11 to 30 letters and digits   mod-97 is 1; ends at any word of the run
ssn         three, two and four digits parted by hyphens           a context word nearby
==========  =====================================================  =======================================================

A run of upper-case words may go on after an IBAN, so each word's end is tried; the registered length of the country goes
first, then the longest that passes.

A span's score starts at what its kind alone is worth, rises when one of the kind's context words stands in the 60
characters before it, and must reach ``MIN_SCORE``. The first four kinds are kept whatever their context; context decides
for ``ssn`` only. Spans of different kinds may overlap; those of one kind do not.

Nulls and odd input: a null or empty text has no spans and stays as it is; long runs of digits or letters cost linear time
(quantifiers do not backtrack and matches start where a run starts); repeated rows and null ids are treated row by row; columns
of other names are kept by :func:`redact` and ignored by :func:`find_spans`; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from fellwalk.llm.common import bound, cut, text_blocks

MIN_SCORE = 0.5
CONTEXT_CHARS = 60
CONTEXT_WEIGHT = 0.35

SPANS = "array<struct<start:int,rank:int,end:int,kind:string,score:double>>"


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    needs: str  # a text without it has no match, so the pattern is not tried
    score: float
    context: str


# Patterns (possessive where only the longest run can match), and the words that raise a score.
KINDS = (
    Kind("email", r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@", 0.9,
         "mail|email|contact|courriel|correo|kontakt"),
    Kind("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", ".", 0.8, "ip|host|server|address|adresse"),
    Kind("card", r"[0-9](?:[\x20-]?[0-9]){11,}+", "", 0.8, "card|visa|mastercard|credit|carte|karte|tarjeta"),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", "+", 0.7, "phone|tel|call|mobile|fax|telefon|téléphone"),
    # only the country is consumed, so that every start is tried, whatever the run after another one holds
    Kind("iban", r"\b(?=([A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}\b))[A-Z]{2}", "", 0.8, "iban|account|bank|konto|compte|cuenta"),
    # a number that goes on after a hyphen is of another kind, unless it goes on with a whole one
    Kind("ssn", r"\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b(?!-(?![0-9]{3}-[0-9]{2}-[0-9]{4}\b)[0-9])", "-", 0.3, "ssn|social security|security number"),
)
BASE_KINDS = 4
IBAN_LEAST = 15

# Lengths of registered IBANs by country (fixed values).
IBAN_LENGTHS = {
    country: length
    for length, countries in {
        15: "NO", 16: "BE", 18: "DK FI FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU XK", 21: "CH HR LI LV",
        22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR",
        27: "FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU", 31: "MT SC", 32: "LC",
    }.items()
    for country in countries.split()
}


def _characters(text: Column) -> Column:
    return F.filter(F.split(text, ""), lambda c: c != "")


def _luhn(digits: Column) -> Column:
    """Every second digit from the right is doubled; the sum of all digits is a multiple of ten."""
    values = F.transform(_characters(F.reverse(digits)), lambda c: c.cast("int"))
    weighed = F.transform(values, lambda v, i: F.when(i % 2 == 0, v).when(v > 4, v * 2 - 9).otherwise(v * 2))
    return F.aggregate(weighed, F.lit(0), lambda total, v: total + v) % 10 == 0


def _mod97(text: Column) -> Column:
    """With the first four characters at the end and letters as numbers from A = 10, division by 97 leaves 1."""
    compact = F.regexp_replace(text, r"\x20", "")
    moved = F.concat(F.substr(compact, F.lit(5)), F.substring(compact, 1, 4))
    values = F.transform(_characters(moved), lambda c: F.when(F.ascii(c) >= 65, F.ascii(c) - 55).otherwise(F.ascii(c) - 48))
    return F.aggregate(values, F.lit(0), lambda rest, v: (F.when(v > 9, rest * 100).otherwise(rest * 10) + v) % 97) == 1


def _iban(run: Column) -> Column:
    """The IBAN at the start of a run of words: of those that pass, the one of its country's length, or else the longest; or null."""
    words = F.split(run, r"\x20")
    begins = F.transform(F.sequence(F.size(words), F.lit(1), F.lit(-1)), lambda n: F.array_join(F.slice(words, 1, n), " "))
    size = lambda p: F.length(F.regexp_replace(p, r"\x20", ""))
    passing = F.filter(begins, lambda p: (size(p) >= IBAN_LEAST) & _mod97(p))
    lengths = F.create_map(*[F.lit(x) for pair in IBAN_LENGTHS.items() for x in pair])
    wanted = lambda p: F.coalesce(size(p) == F.try_element_at(lengths, F.substring(p, 1, 2)), F.lit(False))
    return bound(passing, lambda some: F.coalesce(F.get(F.filter(some, wanted), F.lit(0)), F.get(some, F.lit(0))))


def _confirmed(kind: Kind, text: Column) -> Column:
    if kind.name == "ip":
        parts = F.transform(F.split(text, r"\."), lambda p: F.regexp_replace(p, "^0+(?=.)", ""))
        return F.forall(parts, lambda p: (F.length(p) <= 3) & (F.substring(p, 1, 4).cast("int") <= 255))
    if kind.name in ("card", "phone"):
        digits = F.regexp_replace(text, "[^0-9]", "")
        if kind.name == "phone":
            return F.length(digits).between(9, 15)
        return F.length(digits).between(12, 19) & _luhn(digits)
    return F.lit(True)


def _spans_of(rank: int, kind: Kind, text: Column) -> Column:
    """The kept spans of one kind, in order: starts are running sums over the lengths of matches and of what lies between."""
    found = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
    between = F.split(text, kind.pattern, -1)  # one more than the matches
    iban = kind.name == "iban"
    runs = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(1)) if iban else found
    pairs = F.filter(F.arrays_zip(between.alias("before"), found.alias("match"), runs.alias("run")), lambda p: p["match"].isNotNull())
    whole = lambda run: _iban(run) if iban else F.when(_confirmed(kind, run), run)
    last = lambda text: F.right(text, F.lit(CONTEXT_CHARS))
    score = lambda around: F.lit(kind.score) + F.when(F.lower(around).rlike(rf"\b(?:{kind.context})"), F.lit(CONTEXT_WEIGHT)).otherwise(F.lit(0.0))
    judged = F.transform(pairs, lambda p: F.struct(
        F.length(p["before"]).alias("gap"),
        F.length(p["match"]).alias("taken"),
        F.length(whole(p["run"])).alias("size"),
        last(p["before"]).alias("before"),
        last(p["match"]).alias("match"),
    ))

    def step(state: Column, match: Column) -> Column:
        start = state["at"] + match["gap"]
        around = last(F.concat(state["tail"], match["before"]))
        span = F.struct(start.alias("start"), F.lit(rank).alias("rank"), (start + match["size"]).alias("end"),
                        F.lit(kind.name).alias("kind"), score(around).alias("score"))
        kept = match["size"].isNotNull() & (span["score"] >= MIN_SCORE) & (start >= state["free"])
        return F.struct(last(F.concat(around, match["match"])).alias("tail"), (start + match["taken"]).alias("at"), F.when(kept, start + match["size"]).otherwise(state["free"]).alias("free"),
                        F.when(kept, F.array_append(state["out"], span)).otherwise(state["out"]).alias("out"))

    nothing = F.array().cast(SPANS)
    begin = F.struct(F.lit("").alias("tail"), F.lit(0).alias("at"), F.lit(0).alias("free"), nothing.alias("out"))
    spans = F.aggregate(judged, begin, step, lambda state: state["out"])
    return F.when(F.contains(text, F.lit(kind.needs)), spans).otherwise(nothing)


def span_column(text: Column) -> Column:
    """All spans of a text, by start and then kind: ``array<struct<start, rank, end, kind, score>>``, code points, end exclusive."""
    text = F.coalesce(text, F.lit(""))
    return F.array_sort(F.concat(*[_spans_of(i, kind, text) for i, kind in enumerate(KINDS)]))


def masked(text: Column, spans: Column) -> Column:
    """The text with every span replaced by its kind in brackets; overlapping spans become one."""

    def rebuilt(blocks: Column) -> Column:
        def step(state: Column, span: Column) -> Column:
            fresh = F.array(cut(blocks, state["at"], span["start"]), F.concat(F.lit("["), F.upper(span["kind"]), F.lit("]")))
            out = F.when(span["start"] >= state["at"], F.concat(state["out"], fresh)).otherwise(state["out"])
            return F.struct(F.greatest(state["at"], span["end"]).alias("at"), out.alias("out"))

        start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
        rest = lambda state: F.concat(F.array_join(state["out"], ""), cut(blocks, state["at"], F.length(text)))
        return F.aggregate(spans, start, step, rest)

    return F.when(F.size(spans) > 0, bound(text_blocks(text), rebuilt)).otherwise(text)


def find_spans(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``spans`` of every document."""
    return docs.select("doc_id", span_column(F.col("text")).alias("spans"))


def redact(docs: DataFrame) -> DataFrame:
    """The documents with personal data masked in ``text``, and ``n_chars``, if there, counted anew. All columns stay."""
    found = docs.select(F.struct("*").alias("row"), span_column(F.col("text")).alias("spans"))
    hidden = found.select("row", masked(F.col("row.text"), F.col("spans")).alias("text"))
    anew = {"text": F.col("text"), "n_chars": F.length("text")}
    kinds = {f.name: f.dataType for f in docs.schema}
    return hidden.select(*[anew[c].cast(kinds[c]).alias(c) if c in anew else F.col(f"row.`{c}`").alias(c) for c in docs.columns])


def digest(docs: DataFrame) -> DataFrame:
    """Counts by kind, the hash of the base spans, and all spans as text."""
    named = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    joined = lambda spans: F.array_join(F.transform(spans, named), ",")
    count = lambda rank: F.size(F.filter("spans", lambda s: s["rank"] == rank)).cast("bigint")
    return find_spans(docs).select(
        "doc_id",
        *[count(i).alias(f"n_{kind.name}") for i, kind in enumerate(KINDS)],
        F.sha2(joined(F.filter("spans", lambda s: s["rank"] < BASE_KINDS)), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )
