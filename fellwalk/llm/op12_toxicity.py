"""Toxicity by weak supervision: many voters, a generative model of their votes, a linear classifier on its posterior labels.

1. *Voters.* Fixed word lists and patterns (:data:`LEXICONS`, :data:`PATTERNS`), terms mined from labelled rows, and two voters for
   clean texts. A term is a word or a word's first ``AFFIX`` letters. It is mined from a bounded sample of labelled rows, the
   ``SAMPLE_TOXIC`` and ``SAMPLE_CLEAN`` with the smallest hash of their id, counted by tasks; the ``TERMS`` that tell the classes
   apart best are kept, and the first ``MINED_VOTERS`` of them vote. A term votes where it is denser than the geometric mean of its
   densities in toxic and in clean documents that hold it, or anywhere if hardly any clean one does.
2. *One pass over whole texts* writes, for every document, its words, its counts of terms and patterns, and its votes.
3. *Label model.* How often voters vote, and vote together, is counted over all documents; how often they vote on each label,
   over all labelled rows that may be learned from. The accuracies are fitted to both: pairs that are independent given the class
   covary by the product of their accuracies, and labels show each accuracy alone. Pairs whose covariance this leaves
   unexplained are correlated: they no longer bear on the accuracies, and each counts for less by the correlations it has.
4. *Classifier.* A logistic regression on term and pattern densities and votes, fitted on the sample and ``SAMPLE_OTHER`` documents
   without a label. Its targets are posteriors: of the votes, and of votes and label where there is one (right with probability
   ``LABEL_TRUST``). The driver holds the sample's counts, never texts; the model has ``TERMS`` rows whatever the corpus.

Labels are learned only from rows that :func:`held_out` leaves; labels, languages, sources and ids are no inputs of a score.

Nulls and odd input: a null text is empty; an empty text has no votes but those for clean, and a score like any other; a
null id is not held out and matches no label; a null label is none; of several labels of one id the highest counts; labels of one
class only, or none, leave the fixed voters with the accuracies of :data:`PRIOR`; ties and repeated rows score alike, since a score
reads the text alone; an empty table gives no rows; columns of other names are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from fellwalk.llm.common import lean, settle_llm
from fellwalk.llm.op13_lexical_search import split_terms
from fellwalk.workspace import settled

SAMPLE_TOXIC, SAMPLE_CLEAN, SAMPLE_OTHER = 2500, 5000, 2500
TERMS, MINED_VOTERS, LEAST_DOCS, LEAST_Z = 192, 40, 3, 4.0
AFFIX = (3, 4, 5, 6, 7)
SMOOTH_WORDS = 30  # added to a text's words where densities are taken, so that one hit in a short text is no high density
CORRELATED = 0.1
LABEL_TRUST = 0.98
RIDGE = 2.0
# How often a fixed voter votes on toxic and on clean texts, as far as nothing is known (fixed values), worth so many labels.
PRIOR, PRIOR_WORTH = (0.3, 0.02), 4.0

# Word lists of the fixed voters (fixed values).
LEXICONS = {
    "insults": "idiot idiots moron morons imbecile stupid dumb dumbass fool fools loser losers clown clowns jerk jerks creep freak dimwit halfwit",
    "contempt": "pathetic worthless disgusting useless trash garbage scum vermin filth filthy parasite parasites subhuman degenerate repulsive",
    "profanity": "fuck fucking fucked fucker shit shitty bullshit bitch bitches bastard bastards asshole assholes crap damn dickhead wanker",
    "threats": "kill murder strangle exterminate eradicate hurt smash destroy",
    "german": "idiot idioten trottel depp deppen vollidiot dummkopf blödmann arschloch scheiße scheisse schwachkopf abschaum versager hurensohn widerlich erbärmlich wertlos",
    "french": "idiot idiote imbécile crétin crétins débile abruti abrutis connard connards connasse salaud salope merde pourriture ordure minable dégoûtant",
    "spanish": "idiota idiotas imbécil estúpido estúpida estúpidos tonto tonta pendejo cabrón gilipollas mierda basura escoria asqueroso patético inútil",
}
# Patterns of the fixed voters, in the syntax of RE2 (fixed values).
PATTERNS = {
    "attack": r"(?i)\b(you are|you're|ur|you|such) (a|an|the|all|just|so) ?(\w+ )?(idiot|moron|loser|fool|clown|joke|disgrace|trash|stupid|pathetic|worthless|disgusting)",
    "dismissal": r"(?i)\b(shut up|get lost|go to hell|drop dead|nobody (likes|wants) you|kill yourself|halt die klappe|ferme[- ]la|cállate)\b",
    "masked": r"(?i)\b(f[*@#$!]+ck?|sh[*@#$!1]+t|b[*@#$!1]+tch|a[*@#$]{2}(hole)?|id[1!]ot|m[0@]r[0o]n|st[*u@]p[1!]d)",
    "shouting": r"\b[A-Z]{3,}(?:[ ,!]+[A-Z]{3,}){3,}",
    "exclaimed": r"!{3,}",
}
FIXED = [*LEXICONS, *PATTERNS]

# Sums over sample documents that hold a term, toxic and clean: documents, occurrences, densities.
SUMS = ["d1", "t1", "r1", "d0", "t0", "r0"]
FEATURES = "doc_id bigint, n_words bigint, slots array<int>, counts array<int>, votes bigint"
SCORED = "doc_id bigint, n_words bigint, score double"


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def learnable(labels: DataFrame) -> DataFrame:
    """``doc_id, toxic`` of the labels that may be learned from, one row per id."""
    known = labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL").filter(~held_out(F.col("doc_id")))
    return known.groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg((F.max("toxic") > 0).cast("int").alias("toxic"))


# ---- words and terms ----


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct words in lower case, and the text and the word of every word of the texts."""
    pieces, sizes = split_terms(texts)
    lower = pc.utf8_lower(pieces.dictionary).dictionary_encode()
    at = lower.indices.to_numpy()[pieces.indices.to_numpy()] if len(pieces) else np.zeros(0, dtype=np.int64)
    text = np.repeat(np.arange(len(sizes)), sizes)
    words = lower.dictionary
    full = pc.not_equal(words, "").to_numpy(zero_copy_only=False)[at] if len(words) else np.zeros(0, dtype=bool)
    return words, text[full], at[full].astype(np.int64)


def affixes(words: pa.Array) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """The terms of distinct words: each length's first letters with a mark, then the words; and the words that have them."""
    length = pc.utf8_length(words).to_numpy()
    for size in AFFIX:
        some = np.flatnonzero(length > size)
        yield pc.binary_join_element_wise(pc.utf8_slice_codeunits(words.take(pa.array(some)), 0, size), pa.scalar("-", pa.large_string()), pa.scalar("", pa.large_string())), some
    yield words, np.arange(len(words))


def mine(sample: DataFrame, terms: int = TERMS) -> list[tuple[str, float]]:
    """The terms that tell the classes apart best, with the density above which each votes.

    ``sample`` is ``toxic, text``. A term is judged by the documents that hold it more often than the mean of its class densities
    would have it by chance, as a z-score on documents.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            toxic = batch.column("toxic").to_numpy().astype(np.int64)
            words, text, at = words_of(batch.column("text"))
            n = np.bincount(text, minlength=len(toxic))
            for found, where in affixes(words):
                coded = found.dictionary_encode()
                term = np.full(len(words), -1)
                term[where] = coded.indices.to_numpy()
                there = term[at]
                keys, times = np.unique(there[there >= 0] * len(toxic) + text[there >= 0], return_counts=True)
                which, side = keys // max(1, len(toxic)), toxic[keys % max(1, len(toxic))]
                density = times / (n[keys % max(1, len(toxic))] + SMOOTH_WORDS)
                sums = [np.bincount(which[side == s], weights=w[side == s], minlength=len(coded.dictionary)).astype(float) for s in (1, 0) for w in (np.ones(len(keys)), times, density)]
                yield pa.RecordBatch.from_arrays([coded.dictionary.cast(pa.string()), *map(pa.array, sums)], names=["term", *SUMS])
            totals = [float(v) for s in (1, 0) for v in ((toxic == s).sum(), (toxic[text] == s).sum(), 0)]  # under the term of no text
            yield pa.RecordBatch.from_arrays([pa.array([""]), *[pa.array([v]) for v in totals]], names=["term", *SUMS])

    types = "term string, " + ", ".join(f"{c} double" for c in SUMS)
    counted = settled(sample.select("toxic", "text").mapInArrow(lean(run), types).groupBy("term").agg(*[F.sum(c).alias(c) for c in SUMS]), "toxic-terms")
    total = counted.filter("term = ''").first()
    if total is None or not total.d1 or not total.d0:
        return []
    held, share = F.col("d1") + F.col("d0"), total.d1 / (total.d1 + total.d0)
    # documents over expectation, and density over expectation: a term of every long text is no sign, one dense in toxic texts is
    by_docs = (F.col("d1") - held * share) / F.sqrt(held * share * (1 - share))
    times, words = F.col("t1") + F.col("t0"), total.t1 / max(1, total.t1 + total.t0)
    by_words = (F.col("t1") - times * words) / F.sqrt(times * words * (1 - words) + 1)
    best = counted.filter("term <> ''").filter(held >= LEAST_DOCS).withColumn("z", F.least(by_docs, by_words)).filter(F.col("z") > LEAST_Z)
    rows = best.orderBy(F.col("z").desc(), F.length("term").desc(), "term").limit(20 * terms).collect()
    chosen: list[tuple[str, float]] = []
    for r in rows:
        start = r.term.removesuffix("-")
        # what a better term contains, or is contained in, tells nothing new
        if any(start.startswith(t.removesuffix("-")) or t.removesuffix("-").startswith(start) for t, _ in chosen):
            continue
        # between the densities in toxic and in clean documents that hold it; none if nearly all that hold it are toxic
        between = math.sqrt(r.r1 / r.d1 * r.r0 / r.d0) if r.d0 else 0.0
        chosen.append((r.term, between * min(1.0, 2 * r.d0 / (r.d1 + r.d0))))
    return chosen[:terms]


def floors_of(mined: list[tuple[str, float]]) -> np.ndarray:
    """The density from which each slot counts as dense: any for the fixed ones."""
    return np.append(np.zeros(len(FIXED)), [density for _, density in mined])


def features(docs: DataFrame, mined: list[tuple[str, float]]) -> DataFrame:
    """``doc_id, n_words, slots, counts, votes``: what every whole text holds, and one bit per voter.

    Slots are the fixed lists and patterns, then the mined terms. Voters are the fixed ones, the first mined ones, a text
    without a fixed hit, and a text in which no mined term is dense.
    """
    fixed, voting = len(FIXED), min(MINED_VOTERS, len(mined))
    listed_words = sorted({w for words in LEXICONS.values() for w in words.split()})
    lists_of = [[i for i, words in enumerate(LEXICONS.values()) if w in words.split()] for w in listed_words]
    # the lists of each word, one column for each list that a word may be on
    slots_of = [np.asarray([some[k] if k < len(some) else -1 for some in lists_of]) for k in range(max(map(len, lists_of)))]
    terms, floors = [t for t, _ in mined], floors_of(mined)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        listed = pa.array(listed_words, pa.large_string())
        vocabulary = pa.array(terms, pa.large_string())
        for batch in batches:
            texts = pc.fill_null(batch.column("text").cast(pa.large_string()), "")
            count = len(texts)
            words, text, at = words_of(texts)
            n = np.bincount(text, minlength=count)
            hits = [np.zeros(0, dtype=np.int64)]  # text * slots + slot, one for each occurrence
            slots = fixed + len(terms)
            on_list = pc.fill_null(pc.index_in(words, value_set=listed), -1).to_numpy()[at] if len(words) else at
            for lists in slots_of:
                there = np.append(lists, -1)[on_list]
                hits.append(text[there >= 0] * slots + there[there >= 0])
            for found, where in affixes(words):
                slot = np.full(len(words), -1, dtype=np.int64)
                slot[where] = pc.fill_null(pc.index_in(found, value_set=vocabulary), -1).to_numpy()
                there = slot[at] if len(words) else slot
                hits.append(text[there >= 0] * slots + fixed + there[there >= 0])
            keys, times = np.unique(np.concatenate(hits), return_counts=True)
            for i, pattern in enumerate(PATTERNS.values()):
                matched = pc.count_substring_regex(texts, pattern).to_numpy()
                some = np.flatnonzero(matched)
                keys, times = np.append(keys, some * slots + len(LEXICONS) + i), np.append(times, matched[some])
            order = np.argsort(keys, kind="stable")
            row, slot, times = keys[order] // slots, keys[order] % slots, times[order]
            dense = times / (n[row] + SMOOTH_WORDS) >= floors[slot]
            votes = np.zeros(count, dtype=np.int64)
            voter = dense & (slot < fixed + voting)
            np.bitwise_or.at(votes, row[voter], np.int64(1) << slot[voter])
            quiet = np.ones((2, count), dtype=bool)
            quiet[0, row[slot < fixed]] = False
            quiet[1, row[dense & (slot >= fixed)]] = False
            votes |= (quiet[0].astype(np.int64) << (fixed + voting)) | (quiet[1].astype(np.int64) << (fixed + voting + 1))
            bounds = pa.array(np.searchsorted(row, np.arange(count + 1)), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.ListArray.from_arrays(bounds, pa.array(slot, pa.int32())),
                 pa.ListArray.from_arrays(bounds, pa.array(times, pa.int32())), pa.array(votes)], names=["doc_id", "n_words", "slots", "counts", "votes"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(lean(run), FEATURES)


# ---- the label model ----


def vote_counts(votes: DataFrame, voters: int) -> tuple[np.ndarray, int]:
    """How many documents each pair of voters votes on (each voter with itself too), and all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, count = np.zeros((voters, voters)), 0
        for batch in batches:
            bits = (batch.column("votes").to_numpy()[:, None] >> np.arange(voters)) & 1
            sums += bits.T.astype(float) @ bits
            count += len(bits)
        first, second = np.triu_indices(voters)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(first, -1), pa.int32()), pa.array(np.append(second, -1), pa.int32()), pa.array(np.append(sums[first, second], count).astype(np.int64))],
            names=["i", "j", "n"])

    rows = votes.select("votes").mapInArrow(run, "i int, j int, n bigint").groupBy("i", "j").agg(F.sum("n").alias("n")).collect()  # one for each pair
    both, count = np.zeros((voters, voters)), 0
    for r in rows:
        if r.i < 0:
            count = r.n
        else:
            both[r.i, r.j] = both[r.j, r.i] = r.n
    return both, count


class LabelModel:
    """Accuracies and correlations of voters, fitted to their counts.

    ``both`` and ``count`` are of :func:`vote_counts` over all documents; ``on_toxic`` and ``on_clean`` are the votes on ``toxic``
    and ``clean`` labelled rows. ``clean_from``: the first voter for clean texts.
    """

    def __init__(self, both: np.ndarray, count: int, on_toxic: np.ndarray, toxic: int, on_clean: np.ndarray, clean: int, clean_from: int):
        voters = len(both)
        self.share = (toxic + 0.5) / (toxic + clean + 5.0)
        spread = self.share * (1 - self.share)
        self.mean = (np.diag(both) + 0.5) / (count + 1)
        covariance = both / max(1, count) - np.outer(self.mean, self.mean)
        variance = self.mean * (1 - self.mean)
        guess = np.tile(np.asarray(PRIOR)[:, None], voters)
        guess[:, clean_from:] = [[0.1], [0.9]]
        on1, on0 = ((seen + PRIOR_WORTH * g) / (rows + PRIOR_WORTH) for seen, rows, g in zip((on_toxic, on_clean), (toxic, clean), guess))
        shown = on1 - on0  # what labels show: how much oftener a voter votes on toxic texts
        doubt = on1 * (1 - on1) / (toxic + PRIOR_WORTH) + on0 * (1 - on0) / (clean + PRIOR_WORTH) + 1e-9
        # besides the chance of a finite count, pairs are never as independent as the model has them
        noise = np.outer(variance, variance) * (1 / max(1, count) + 0.01) + 1e-12
        gain, edges = shown.copy(), np.eye(voters, dtype=bool)
        for _ in range(5):
            for _ in range(20):
                for i in range(voters):
                    free = ~edges[i]
                    pull = spread * gain[free] / noise[i, free]
                    gain[i] = (pull @ covariance[i, free] + shown[i] / doubt[i]) / (spread * (pull @ gain[free]) + 1 / doubt[i])
            rest = covariance - spread * np.outer(gain, gain)
            inner = np.sqrt(np.maximum(variance - spread * gain**2, 0.05 * variance))
            self.correlation = rest / np.outer(inner, inner)
            found = np.eye(voters, dtype=bool) | (np.abs(self.correlation) > CORRELATED)
            if (found == edges).all():
                break
            edges = found
        np.fill_diagonal(self.correlation, 0)
        self.on_toxic = np.clip(self.mean + gain * (1 - self.share), 1e-4, 1 - 1e-4)
        self.on_clean = np.clip(self.mean - gain * self.share, 1e-4, 1 - 1e-4)
        worth = 1 / (1 + np.where(self.correlation > CORRELATED, self.correlation, 0).sum(axis=1))
        self.voted = worth * np.log(self.on_toxic / self.on_clean)
        self.silent = worth * np.log((1 - self.on_toxic) / (1 - self.on_clean))

    def log_odds(self, votes: np.ndarray) -> np.ndarray:
        """The log-odds of toxic for rows of votes (one bit per voter)."""
        bits = ((votes[:, None] >> np.arange(len(self.voted))) & 1).astype(float)
        return math.log(self.share / (1 - self.share)) + bits @ self.voted + (1 - bits) @ self.silent


# ---- the classifier ----


def design(n_words: np.ndarray, sizes: np.ndarray, slots: np.ndarray, counts: np.ndarray, votes: np.ndarray, floors: np.ndarray, voters: int) -> np.ndarray:
    """The classifier's inputs: a one; for every slot whether it is dense, and the logarithm of its density in percent; the votes."""
    width = len(floors)
    row = np.repeat(np.arange(len(sizes)), sizes)
    out = np.zeros((len(sizes), 1 + 2 * width + voters), dtype=np.float32)
    out[:, 0] = 1
    density = counts / (n_words[row] + SMOOTH_WORDS)
    out[row, 1 + slots] = density >= floors[slots]
    out[row, 1 + width + slots] = np.log1p(100 * density)
    out[:, 1 + 2 * width :] = (votes[:, None] >> np.arange(voters)) & 1
    return out


def fit(inputs: np.ndarray, target: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weights of a ridge logistic regression on targets between 0 and 1, by Newton's steps."""
    scale = np.maximum(np.sqrt((inputs.astype(float) ** 2).mean(axis=0)), 1e-3)
    x = inputs / scale
    ridge = np.full(x.shape[1], RIDGE)
    ridge[0] = 1e-3
    found = np.zeros(x.shape[1])
    found[0] = math.log((target @ weight + 0.5) / ((1 - target) @ weight + 0.5))

    def loss(at: np.ndarray) -> float:
        odds = x @ at
        return float(weight @ (np.logaddexp(0, odds) - target * odds) + 0.5 * ridge @ at**2)

    now = loss(found)
    for _ in range(50):
        guess = 1 / (1 + np.exp(-np.clip(x @ found, -30, 30)))
        gradient = x.T @ (weight * (guess - target)) + ridge * found
        curve = weight * np.maximum(guess * (1 - guess), 1e-6)
        step = np.linalg.solve((x * curve[:, None]).T @ x + np.diag(ridge), gradient)
        share = 1.0
        while (after := loss(found - share * step)) > now and share > 1e-4:
            share /= 2
        if now - after < 1e-6 * max(1.0, now):
            break
        found, now = found - share * step, after
    return found / scale


def _collected(rows: DataFrame) -> tuple[np.ndarray, ...]:
    """A bounded frame of features as arrays."""
    table = rows.orderBy("doc_id", "votes").toArrow().combine_chunks()
    one = lambda name: (pa.concat_arrays(table.column(name).chunks) if table.column(name).num_chunks else pa.array([], table.schema.field(name).type))
    slots, counts = one("slots"), one("counts")
    return (one("n_words").to_numpy(), pc.list_value_length(slots).to_numpy(), slots.flatten().to_numpy(), counts.flatten().to_numpy(), one("votes").to_numpy(),
            pc.fill_null(one("toxic"), -1).to_numpy())


def score(found: DataFrame, weights: np.ndarray, floors: np.ndarray, voters: int) -> DataFrame:
    carried = found.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slots, counts = batch.column("slots"), batch.column("counts")
            inputs = design(batch.column("n_words").to_numpy(), pc.list_value_length(slots).to_numpy(), slots.flatten().to_numpy(), counts.flatten().to_numpy(),
                            batch.column("votes").to_numpy(), floors, voters)
            value = 1 / (1 + np.exp(-np.clip(inputs @ carried.value, -500, 500)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_words"), pa.array(value, pa.float64())], names=["doc_id", "n_words", "score"])

    return found.mapInArrow(lean(run), SCORED)


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The operator: ``doc_id, held_out, score, predicted, n_words`` of every document, learned from ``labels.toxic``."""
    settle_llm(docs.sparkSession)
    known = settled(learnable(labels), "toxic-labels")
    drawn = F.xxhash64("doc_id")
    smallest = lambda rows, most: rows.orderBy(drawn, "doc_id").limit(most)  # noqa: E731  bounded by the sample's size
    here = known.join(docs.select(F.col("doc_id").cast("bigint").alias("doc_id")).distinct(), "doc_id", "left_semi")
    sample = settled(smallest(here.filter("toxic = 1"), SAMPLE_TOXIC).unionByName(smallest(here.filter("toxic = 0"), SAMPLE_CLEAN)), "toxic-sample")
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    mined = mine(texts.join(F.broadcast(sample), "doc_id"))
    found = settled(features(docs, mined), "toxic-features")
    floors, clean_from = floors_of(mined), len(FIXED) + min(MINED_VOTERS, len(mined))
    voters = clean_from + 2

    both, count = vote_counts(found, voters)
    judged = found.select("doc_id", "votes").join(known, "doc_id")
    on = {side: vote_counts(judged.filter(F.col("toxic") == side), voters) for side in (1, 0)}
    model = LabelModel(both, count, np.diag(on[1][0]), on[1][1], np.diag(on[0][0]), on[0][1], clean_from)

    labelled = found.join(F.broadcast(sample), "doc_id")
    others = smallest(found.filter(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).join(known, "doc_id", "left_anti"), SAMPLE_OTHER)
    n_words, sizes, slots, counts, votes, toxic = _collected(labelled.unionByName(others.withColumn("toxic", F.lit(None).cast("int"))))
    trust = math.log(LABEL_TRUST / (1 - LABEL_TRUST))
    odds = model.log_odds(votes)
    target = 1 / (1 + np.exp(-np.clip(np.where(toxic < 0, odds, np.clip(odds, -4, 4) + np.where(toxic == 1, 2, -2) * trust), -30, 30)))
    # the sample holds the classes in other shares than the labelled rows; weights undo that
    drawn_rows = [max(1, int((toxic == s).sum())) for s in (0, 1)]
    there = [on[0][1], on[1][1]]
    size = sum(drawn_rows) / max(1, sum(there))
    weight = np.where(toxic == 1, there[1] / drawn_rows[1] * size, np.where(toxic == 0, there[0] / drawn_rows[0] * size, 0.25))
    weights = fit(design(n_words, sizes, slots, counts, votes, floors, voters), target, weight)
    return score(found, weights, floors, voters).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "n_words")
