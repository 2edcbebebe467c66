"""Language identification by a linear-chain conditional random field over the words of a text.

Every word is a state of the chain, its label a language. A word is a letter (Unicode category L) and the letters and marks (M)
that follow it; number signs such as a half, a circled one or a Roman numeral of one sign are no letters. The emission of a word
is the sum of the learned weights of its features: the word itself if it is in the lexicon, its first and last one to three
letters, and its letter pairs and triples. Learned transitions tie neighbours. Forward-backward gives the probability of every
language at every word, so code-switched text is labelled word by word; a document's language is the one with the largest mean,
its score that mean.

Training reads a bounded sample from rows that :func:`learnable` allows (a text, a language, and crc32 of the id, modulo 3, not
1): of every language the different texts with the smallest hash (modulo ``2 ** 40``), as many as its equal part of ``SAMPLE_DOCS``, and
``LEAST_DOCS`` at least; of each a window of ``SAMPLE_CHARS`` characters at a place drawn by the hash. So every language of
these rows is a label, however rare. Their words are cut into segments, and segments of different documents are joined
to sequences that switch languages, from which emissions and transitions are learned together by gradient steps on the
likelihood. The sample is fixed by the data, so reruns learn the same model. The
model is a table of ``2 ** FEATURE_BITS`` rows per language, whatever the corpus, and travels with the task function.

The chain runs through the whole text. Long texts are cut into pieces of ``PIECE`` words only to compute in parallel: the
messages between pieces are the exact products of their transition matrices, so the cut changes nothing.

Nulls and odd input: a null text, or one without a letter, is ``und`` with score 0; so is every text if nothing could be
learned; a null id is neither held out nor learned from; the prediction reads the text alone, so ties and repeated rows agree;
an empty table gives no rows; columns of other names are kept by :func:`keep_identified` and ignored by :func:`identify`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window, functions as F

from fellwalk.llm.common import lean, settle_llm
from fellwalk.llm.tokens import pieces_of
from fellwalk.workspace import settled

SAMPLE_DOCS = 1200
LEAST_DOCS = 20  # of every language, however many there are
SAMPLE_CHARS = 2000
FEATURE_BITS = 17
LEXICON_FLOOR = 3  # a word seen less often in the sample is judged by its letters alone
EPOCHS = 3
PIECE = 64
REMEMBERED = 300_000
UNKNOWN = "und"
MIN_SCORE = 0.35
WORDS = regex.compile(r"\p{L}[\p{L}\p{M}]*")


# ---- features ----


def _features(words: list[str], lexicon: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """Features of words: the word each belongs to, and its hash.

    With a mark before and after each word, letter pairs and triples hold the affixes of one and two letters, and the first
    and last four signs those of three.
    """
    codes = np.frombuffer("".join([f"^{w}$" for w in words]).encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
    size = np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 2
    end = np.cumsum(size)
    owner = np.repeat(np.arange(len(words)), size)
    factors = np.asarray([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], dtype=np.uint64)

    def hashed(at: np.ndarray, n: int) -> np.ndarray:
        sums = np.full(len(at), n, dtype=np.uint64)
        for j in range(n):
            sums += codes[at + j] * factors[j]
        sums = (sums ^ (sums >> np.uint64(31))) * factors[0]
        return (sums >> np.uint64(64 - FEATURE_BITS)).astype(np.int64)

    at, owners, ids = np.arange(len(codes)), [], []
    for n in (2, 3):
        inside = at + n <= end[owner]
        owners.append(owner[inside])
        ids.append(hashed(at[inside], n))
    long = np.flatnonzero(size >= 5)
    for place in (end[long] - size[long], end[long] - 4):
        owners.append(long)
        ids.append(hashed(place, 4))
    entries = np.fromiter((lexicon.get(w, -1) for w in words), dtype=np.int64, count=len(words))
    owners.append(np.flatnonzero(entries >= 0))
    ids.append(entries[entries >= 0])
    return np.concatenate(owners), np.concatenate(ids)


def _emissions(words: list[str], model: "Model") -> np.ndarray:
    owner, ids = _features(words, model.lexicon)
    return np.stack([np.bincount(owner, weights=column[ids], minlength=len(words)) for column in model.weights.T], axis=1)


# ---- the chain ----


def marginals(emissions: np.ndarray, bounds: np.ndarray, transitions: np.ndarray) -> np.ndarray:
    """Label probabilities of every word by forward-backward; text ``i`` has the words ``bounds[i]`` to ``bounds[i + 1]``, one at least.

    Pieces of ``PIECE`` words go side by side. The products of their matrices give the messages at their borders, which are
    passed along each text, and a second sweep fills in the words.
    """
    labels, total = transitions.shape[0], len(emissions)
    if not total:
        return np.zeros((0, labels))
    lengths = np.diff(bounds)
    per_text = -(-lengths // PIECE)
    text = np.repeat(np.arange(len(lengths)), per_text)
    place = np.arange(len(text)) - np.repeat(np.cumsum(per_text) - per_text, per_text)
    start = bounds[:-1][text] + place * PIECE
    size = np.minimum(PIECE, bounds[1:][text] - start)
    longest_piece, most_pieces = int(size.max()), int(per_text.max())
    step = np.exp(transitions)
    potential = np.exp(emissions - emissions.max(axis=1, keepdims=True)) + 1e-12
    left, right = np.ones((len(start), labels)), np.ones((len(start), labels))

    if most_pieces > 1:
        # a piece's product takes the message before it to the message after its last word
        several = np.flatnonzero(per_text[text] > 1)
        products = np.zeros((len(start), labels, labels))
        for k in range(longest_piece):
            here = several[size[several] > k]
            phi = potential[start[here] + k][:, None, :]
            if k:
                moved = (products[here].reshape(-1, labels) @ step).reshape(-1, labels, labels) * phi
            else:  # no step leads to a text's first word
                moved = np.where((place[here] == 0)[:, None, None], np.eye(labels), step) * phi
            products[here] = moved / moved.sum(axis=(1, 2), keepdims=True)
        order = np.argsort(place, kind="stable")
        edges = np.searchsorted(place[order], np.arange(most_pieces + 1))
        for p in range(1, most_pieces):
            here = order[edges[p] : edges[p + 1]]
            message = np.einsum("nl,nlm->nm", left[here - 1], products[here - 1])
            left[here] = message / message.sum(axis=1, keepdims=True)
        for p in range(most_pieces - 1, 0, -1):
            here = order[edges[p] : edges[p + 1]]
            message = np.einsum("nlm,nm->nl", products[here], right[here])
            right[here - 1] = message / message.sum(axis=1, keepdims=True)

    forward, out = np.empty((total, labels)), np.empty((total, labels))
    state = left
    for k in range(longest_piece):
        here = np.flatnonzero(size > k)
        moved = state[here] @ step
        if k == 0:
            moved[place[here] == 0] = 1.0
        moved *= potential[start[here] + k]
        state[here] = forward[start[here] + k] = moved / moved.sum(axis=1, keepdims=True)
    state = right
    for k in range(longest_piece - 1, -1, -1):
        here = np.flatnonzero(size > k)
        both = forward[start[here] + k] * state[here]
        out[start[here] + k] = both / both.sum(axis=1, keepdims=True)
        behind = (state[here] * potential[start[here] + k]) @ step.T
        state[here] = behind / behind.sum(axis=1, keepdims=True)
    return out


# ---- learning ----


class Model:
    def __init__(self, labels: list[str], weights: np.ndarray, transitions: np.ndarray, lexicon: dict[str, int]):
        self.labels, self.weights, self.transitions, self.lexicon = labels, weights, transitions, lexicon


def words_of(text: str) -> list[str]:
    return WORDS.findall(text.lower())


def fit(texts: list[str], langs: list[str], epochs: int = EPOCHS) -> Model:
    """Emissions and transitions learned from labelled texts, by gradient steps on the likelihood of switching sequences."""
    from collections import Counter
    from zlib import crc32

    labels = sorted(set(langs))
    rng = np.random.default_rng(7)
    segments, counts = [], Counter()
    for text, lang in zip(texts, langs):
        words, at = words_of(text), 0
        counts.update(words)
        while at < len(words):
            n = int(rng.integers(4, 25))
            segments.append((words[at : at + n], labels.index(lang)))
            at += n
    mask = (1 << FEATURE_BITS) - 1
    lexicon = {w: crc32(w.encode("utf-8", "surrogatepass")) & mask for w, n in counts.items() if n >= LEXICON_FLOOR}
    size = max(1, len(labels))
    weights, transitions = np.zeros((mask + 1, size)), np.zeros((size, size))
    if size < 2 or not segments:
        return Model(labels, weights.astype(np.float32), transitions, lexicon)
    known = {w: i for i, w in enumerate(counts)}
    owner, ids = _features(list(known), lexicon)
    order = np.argsort(owner, kind="stable")
    flat, per_word = ids[order], np.bincount(owner, minlength=len(known))
    first = np.cumsum(per_word) - per_word
    squares = np.full_like(weights, 1e-2)
    for _ in range(epochs):
        mixed = rng.permutation(len(segments))
        for begin in range(0, len(mixed), 1024):
            some = [segments[i] for i in mixed[begin : begin + 1024]]
            words = np.asarray([known[w] for seg, _ in some for w in seg])
            gold = np.repeat([label for _, label in some], [len(seg) for seg, _ in some])
            ends = np.cumsum([len(seg) for seg, _ in some])
            bounds = np.unique(np.concatenate([[0], ends[3::4], ends[-1:]]))  # four segments make a sequence
            used = np.repeat(np.arange(len(words)), per_word[words])
            begins = np.cumsum(per_word[words]) - per_word[words]
            feature = flat[first[words][used] + np.arange(len(used)) - begins[used]]
            emission = np.add.reduceat(weights[feature], begins, axis=0)
            found = marginals(emission, bounds, transitions)
            error = -found
            error[np.arange(len(words)), gold] += 1
            gradient = np.stack([np.bincount(feature, weights=column[used], minlength=len(weights)) for column in error.T], axis=1)
            squares += gradient**2
            weights += 0.3 * gradient / np.sqrt(squares) - 1e-4 * weights
            inner = np.setdiff1d(np.arange(1, len(words)), bounds)
            made = np.zeros_like(transitions)
            np.add.at(made, (gold[inner - 1], gold[inner]), 1)
            moves = made - _expected_moves(found, transitions, inner)
            transitions = np.clip(transitions + 2.0 * moves / max(1, len(inner)), -4, 4)
    return Model(labels, weights.astype(np.float32), transitions, lexicon)


def _expected_moves(found: np.ndarray, transitions: np.ndarray, inner: np.ndarray) -> np.ndarray:
    """Expected pairs of neighbouring labels: the probabilities of both words joined by the transitions."""
    joint = found[inner - 1][:, :, None] * np.exp(transitions)[None] * found[inner][:, None, :]
    return (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def learnable(docs: DataFrame) -> DataFrame:
    return docs.filter("doc_id IS NOT NULL AND text IS NOT NULL AND lang IS NOT NULL").filter(~held_out(F.col("doc_id")))


def learn(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, sample_chars: int = SAMPLE_CHARS) -> Model:
    """The model of a corpus, from its bounded sample; the driver holds no more than the sample."""
    settle_llm(docs.sparkSession)
    ranked = learnable(docs).select("lang", "text", F.xxhash64("text").alias("_hash"))
    texts = ranked.select("lang", "_hash").distinct()
    counts = settled(texts.groupBy("lang").agg(F.count(F.lit(1)).alias("_n")), "languages")
    languages = counts.count()
    if not languages:
        return Model([], np.zeros((1, 1), dtype=np.float32), np.zeros((1, 1)), {})
    each = max(LEAST_DOCS, sample_docs // languages)
    # four times as many as wanted lie below a language's bound, so no task ranks all of its texts; languages are labels, so few
    place, most = F.pmod("_hash", F.lit(1 << 40)), F.lit(float(1 << 40))
    below = texts.join(F.broadcast(counts), "lang").filter(place <= most * F.least(F.lit(1.0), F.lit(4.0 * each) / F.col("_n")))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(place, "_hash"))
    drawn = below.withColumn("_rank", rank).filter(F.col("_rank") <= each).select("lang", "_hash")
    room = F.greatest(F.length("text") - sample_chars, F.lit(0))
    window = F.substr("text", (F.pmod("_hash", room + 1) + 1).cast("int"), F.lit(sample_chars))
    sample = ranked.join(F.broadcast(drawn), ["lang", "_hash"]).select("_hash", "lang", window.alias("text"))
    rows = sample.groupBy("_hash", "lang").agg(F.min("text").alias("text")).orderBy("_hash", "lang").collect()
    return fit([r.text for r in rows], [r.lang for r in rows])


# ---- labelling ----


def _labeller(model: Model):
    index: dict[str, int] = {}
    table = np.zeros((REMEMBERED, len(model.labels)))

    def label(texts: list[str]) -> list[tuple[np.ndarray, int]]:
        """The summed label probabilities and the number of words of each text."""
        nonlocal table
        split = [words_of(t) for t in texts]
        new = [w for w in set().union(*split) if w not in index]
        if len(index) + len(new) > len(table):
            index.clear()
            new = list(set().union(*split))
            if len(new) > len(table):
                table = np.zeros((len(new), len(model.labels)))
        for at in range(0, len(new), 20_000):
            some = new[at : at + 20_000]
            table[len(index) : len(index) + len(some)] = _emissions(some, model)
            index.update(zip(some, range(len(index), len(index) + len(some))))
        counts = np.asarray([len(words) for words in split])
        sums, filled = np.zeros((len(texts), len(model.labels))), np.flatnonzero(counts)
        if len(filled):
            bounds = np.append(0, np.cumsum(counts[filled]))
            at = np.fromiter((i for words in split for i in map(index.__getitem__, words)), dtype=np.int64, count=int(bounds[-1]))
            sums[filled] = np.add.reduceat(marginals(table[at], bounds, model.transitions), bounds[:-1], axis=0)
        return list(zip(sums, counts.tolist()))

    return label


RESULT = "lang_pred string, score double, n_words bigint, shares map<string,double>"


def predict(docs: DataFrame, model: Model, columns: list[str]) -> DataFrame:
    """``columns`` of the documents with the language of their ``text``, its score, and every language's share of the words."""
    settle_llm(docs.sparkSession)
    # plain values: what is broadcast does not travel with its class
    carried = docs.sparkSession.sparkContext.broadcast((model.labels, model.weights, model.transitions, model.lexicon))
    kept = docs.select(*columns, "text").schema
    passed = [f for f in kept if f.name in columns]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in passed] + [RESULT])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model_ = Model(*carried.value)
        label = _labeller(model_)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            out = []
            for some in pieces_of([t or "" for t in texts], 1 << 20):
                if not model_.labels:
                    out += [(UNKNOWN, 0.0, 0, [])] * len(some)
                    continue
                for sums, n in label([texts[i] or "" for i in some]):
                    mean = sums / max(1, n)
                    best = int(np.argmax(mean))
                    shares = list(zip(model_.labels, mean.tolist())) if n else []
                    out.append((model_.labels[best] if n else UNKNOWN, min(1.0, float(mean[best])) if n else 0.0, n, shares))
            columns_ = list(zip(*out)) if out else [()] * 4
            types = (pa.string(), pa.float64(), pa.int64(), pa.map_(pa.string(), pa.float64()))
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(f.name) for f in passed], *[pa.array(c, t) for c, t in zip(columns_, types)]],
                names=[f.name for f in passed] + ["lang_pred", "score", "n_words", "shares"])

    return docs.select(*dict.fromkeys([*columns, "text"])).mapInArrow(lean(run), schema)


def identify(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, lang_pred, score, n_words, shares`` of every document."""
    found = predict(docs, learn(docs), ["doc_id"])
    return found.withColumn("held_out", held_out(F.col("doc_id")))


def keep_identified(docs: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """The documents whose words are mostly of one language the model knows. All columns stay."""
    packed = docs.select(F.struct("*").alias("_row"), "text")
    found = predict(packed, learn(docs), ["_row"])
    return found.filter((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= min_score)).select("_row.*")
