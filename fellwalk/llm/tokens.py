"""Token ids of whole texts by a public tokenizer, with a bounded memory of words."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from fellwalk.llm.common import worker_memory

END_ID = 1
# Words a worker remembers; beyond that it starts again from those of the last texts. It bounds memory, not results.
REMEMBERED = 500_000
# A control character between new words, a token of its own where they meet, and marks that may close a word (fixed values).
BETWEEN, CLOSING = "\x01", ".,;:!?"


class WordEncoder:
    """Encodes texts with a tokenizer whose tokens never cross a space, as with word-end vocabularies.

    Such a vocabulary gives every string between spaces its own ids, so a text is the concatenation of its words, and a word
    of letters followed by closing marks that of the two. The distinct words of some texts are looked up among those met
    before; new ones are encoded by the library as one text and told apart by the ids that end a word (words of letters)
    or by a mark between them (all others). Words and ids are kept in columns, not in objects.
    """

    def __init__(self, path: str):
        import os

        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        largest = max(vocabulary.values())
        self.kind = np.dtype("<u2" if largest < 1 << 16 else "<u4")
        self.ends = np.zeros(largest + 1, dtype=bool)
        self.ends[[number for token, number in vocabulary.items() if token.endswith("</w>")]] = True
        self.mark = self._encode(BETWEEN)
        parts = [self._encode(part).tolist() for part in ("a", "b", "?!", BETWEEN, "c")]
        self.by_word = len(self.mark) == 1 and self._encode(f"a b?! {BETWEEN} c").tolist() == sum(parts, [])
        self._forget()

    def _forget(self) -> None:
        self.words = pa.array([], pa.large_string())
        self.ids, self.starts, self.sizes = np.zeros(0, dtype=self.kind), np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        self.single = np.zeros(0, dtype=bool)  # whether the library took the word as one

    def _encode(self, text: str) -> np.ndarray:
        return np.asarray(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype=self.kind)

    def _learn(self, words: list[str], plain: bool) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids of new words and their numbers, in runs; ``plain`` words have letters alone."""
        flat, sizes = [], []
        for at in range(0, len(words), 500):
            some = words[at : at + 500]
            ids = self._encode((" " if plain else f" {BETWEEN} ").join(some))
            ends = np.flatnonzero(self.ends[ids]) + 1 if plain else np.append(np.flatnonzero(ids == self.mark[0]), len(ids))
            if len(ends) == len(some):
                sizes.append(np.diff(ends, prepend=0) if plain else np.diff(ends, prepend=-1) - 1)
                flat.append(ids if plain else ids[ids != self.mark[0]])
            else:  # letters that the library parts, or a word that holds the mark
                alone = [self._encode(word) for word in some]
                sizes.append(np.asarray([len(a) for a in alone]))
                flat += alone
        return flat, sizes

    def _look_up(self, words: pa.Array) -> np.ndarray:
        """Places of distinct words among the known ones; new words are learned first."""
        place = pc.index_in(words, value_set=self.words)
        if place.null_count:
            new = words.filter(pc.is_null(place))
            letters = pc.utf8_is_alpha(new)
            for some, plain in ((new.filter(letters), True), (new.filter(pc.invert(letters)), False)):
                flat, sizes = self._learn(some.to_pylist(), plain)
                if sizes:
                    size, ids = np.concatenate(sizes), np.concatenate([self.ids[:0], *flat])
                    bounds = np.append(0, np.cumsum(size))
                    self.single = np.append(self.single, np.diff(np.append(0, np.cumsum(self.ends[ids]))[bounds]) == 1)
                    self.starts = np.append(self.starts, len(self.ids) + bounds[:-1])
                    self.sizes = np.append(self.sizes, size)
                    self.ids = np.append(self.ids, ids)
                    self.words = pa.concat_arrays([self.words, some])
            place = pc.index_in(words, value_set=self.words)
        return place.to_numpy()

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text, as numbers of two or four bytes (``kind``)."""
        if not self.by_word:
            return [self._encode(t) for t in texts]
        if not texts:
            return []
        if len(self.words) > REMEMBERED:
            self._forget()
        split = pc.split_pattern(pc.replace_substring(pa.array(texts, pa.large_string()), "\n", " "), " ")
        coded = split.flatten().dictionary_encode()
        words = coded.dictionary
        # a word of letters and closing marks is looked up as two, all others as themselves and nothing
        core = pc.utf8_rtrim(words, CLOSING)
        two = pc.utf8_is_alpha(core)
        first = pc.if_else(two, core, words)
        more = pc.if_else(two, pc.subtract(pc.utf8_length(words), pc.utf8_length(core)), 0).to_numpy()
        closings = [(more == k, pc.utf8_slice_codeunits(words.filter(pa.array(more == k)), -k)) for k in np.unique(more[more > 0]).tolist()]
        firsts = first.dictionary_encode()
        none = pa.array([""], pa.large_string())
        every = pa.chunked_array([firsts.dictionary, none, *[tails.unique() for _, tails in closings]]).unique()
        known = self._look_up(every)
        place = lambda values: known[pc.index_in(values, value_set=every).to_numpy()]
        part = np.empty((len(words), 2), dtype=np.int64)
        part[:, 0], part[:, 1] = place(firsts.dictionary)[firsts.indices.to_numpy()], place(none)[0]
        for here, tails in closings:
            part[here, 1] = place(tails)
        parted = (more > 0) & ~self.single[part[:, 0]]  # letters that the library does not keep together: as a whole
        if parted.any():
            part[parted, 0], part[parted, 1] = self._look_up(words.filter(pa.array(parted))), place(none)[0]
        at = part[coded.indices.to_numpy()].ravel()
        size = self.sizes[at]
        ends = np.cumsum(size)
        ids = self.ids[np.repeat(self.starts[at] - (ends - size), size) + np.arange(ends[-1])]
        bounds = np.append(0, ends[1::2])[split.offsets.to_numpy() - split.offsets[0].as_py()]
        return [ids[a:b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]


def encoder_of(path: str) -> Callable[[], WordEncoder]:
    """A function that gives the worker's encoder for a vocabulary file."""

    def get() -> WordEncoder:
        return worker_memory(f"encoder of {path}", lambda: WordEncoder(path))

    return get


def pieces_of(texts: list, budget: int = 1 << 22) -> list[list[int]]:
    """Positions of ``texts`` in runs of at most ``budget`` characters (one text at least)."""
    runs, size = [], budget + 1
    for i, text in enumerate(texts):
        if size + len(text) > budget:
            runs.append([])
            size = 0
        runs[-1].append(i)
        size += len(text)
    return runs
