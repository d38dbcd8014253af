"""Token ids of whole texts by the tokenizers library, with words encoded once and remembered.

Both tokenizers here cut a text before its merges, and a space that follows a non-space is always
such a cut. So a text is split at spaces, every distinct word goes through the library, and the
ids of a text are those of its words in order. Texts in which a cut at a space would fall inside
a run of white space go through the library whole. A line feed between two words is such a cut too: with
the one tokenizer it is white space like any other, with the other it is an id of its own before a word without a space.

Words are split, told apart and looked up a batch at a time by Arrow, so that only a batch's new words become
Python strings. A word that is a letter's end and one punctuation mark is remembered without the mark, whose id is its own
in both tokenizers. What is remembered is bounded; when it is full, words that were met once are forgotten.
"""

from __future__ import annotations

import json
import os
import re
import string
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Distinct words an encoder remembers; when it is full, those met once since are forgotten.
REMEMBERED = 800_000
_JOINED = 400
_SLICE = 256
_RUN = re.compile(r"\s\s|\s\Z")
#: White space as Python's ``\s`` has it, for Arrow's expressions, in which ``\s`` is ASCII.
_WHITE = r"[\s\x0b\x1c-\x1f\x85\p{Z}]"
_INSIDE_RUN = rf"{_WHITE} (?:{_WHITE}|\z)|\x00"
_LINE_IN_RUN = rf"{_WHITE}\n|\n{_WHITE}"
#: Names of words without a space before them, the first of a text and those after a line feed; no other word has a zero character.
_FIRST, _AFTER = "\0 ", "\0\n"
#: ASCII punctuation without the apostrophe, which may open a contraction.
_MARKS = string.punctuation.replace("'", "")


def byte_bpe_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def word_bpe_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class WordEncoder:
    """Encodes batches of texts with one tokenizer file; ``add_special_tokens`` is off."""

    def __init__(self, path: str, remembered: int = REMEMBERED):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            parts = json.load(f)
        # byte-level without a normalizer: the space belongs to the word after it
        self.leading = parts["normalizer"] is None and parts["pre_tokenizer"]["type"] == "ByteLevel"
        vocab = self.tokenizer.get_vocab()
        # ids by which words are told apart in a joined text: the first or the last id of each
        self.edge = np.zeros(max(vocab.values()) + 1, bool)
        self.edge[[i for t, i in vocab.items() if (t.startswith("Ġ") if self.leading else t.endswith("</w>"))]] = True
        self.line = vocab.get("Ċ")
        self.mark = np.full(256, -1, np.int64)
        for m in _MARKS:
            ids = self.tokenizer.encode(m, add_special_tokens=False).ids
            self.mark[ord(m)] = ids[0] if len(ids) == 1 else -1
        self.remembered = remembered
        self.known, self.fresh, self.n = pa.array([], pa.string()), [], 0
        self.flat = np.zeros(1 << 20, np.uint32)
        self.at = np.zeros(1 << 16, np.int64)
        self.length = np.zeros(1 << 16, np.int64)
        self.met = np.zeros(1 << 16, np.int64)
        self.used = 0

    def _forget(self) -> None:
        """Keep the words that were met again since they were learnt."""
        keep = np.flatnonzero(self.met[:self.n] > 1)[:self.remembered // 2]
        lengths = self.length[keep]
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        self.flat[:total] = self.flat[np.repeat(self.at[keep] - (ends - lengths), lengths) + np.arange(total)]
        self.at[:len(keep)], self.length[:len(keep)] = ends - lengths, lengths
        self.met[:] = 0
        self.known, self.n = self.known.take(pa.array(keep)), len(keep)
        self.used = total

    def whole(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, keys: list[str], lengths: np.ndarray, ids: np.ndarray) -> None:
        n, need = self.n, len(ids)
        while self.used + need >= len(self.flat):  # one place beyond the last word may be read
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while n + len(keys) > len(self.at):
            self.at, self.length, self.met = (np.concatenate([x, np.zeros_like(x)]) for x in (self.at, self.length, self.met))
        self.length[n:n + len(keys)] = lengths
        self.at[n:n + len(keys)] = self.used + np.cumsum(lengths) - lengths
        self.flat[self.used:self.used + need] = ids
        self.used += need
        self.fresh.append(pa.array(keys, pa.string()))
        self.n += len(keys)

    def _learn_each(self, keys: list[str], texts: list[str]) -> None:
        if keys:
            ids = self.whole(texts)
            self._learn(keys, np.fromiter(map(len, ids), np.int64, len(ids)),
                        np.array([i for x in ids for i in x], np.uint32))

    def _learn_words(self, words: list[str]) -> None:
        """Many words go through the library as one text where the ids tell them apart again."""
        if self.leading:  # the first id of a word, and only it, starts with the space
            first = [w for w in words if w.startswith(_FIRST)]
            self._learn_each(first, [w[len(_FIRST):] for w in first])
            after = [w for w in words if w.startswith(_AFTER)]
            for s in range(0, len(after), _JOINED):
                part = after[s:s + _JOINED]
                self._learn_joined(part, [w[1:] for w in part], "", lambda ids: ids == self.line, np.arange(1, len(part) + 1))
            words = [w for w in words if not w.startswith("\0")]
            ends = [1] * len(words)
        else:  # letters, and punctuation after them, surely end in one last id each
            stems = [w.rstrip(_MARKS) for w in words]
            odd = [w for w, x in zip(words, stems, strict=True) if not x.isalpha()]
            self._learn_each(odd, odd)
            ends = [1 + (len(w) > len(x)) for w, x in zip(words, stems, strict=True) if x.isalpha()]
            words = [w for w, x in zip(words, stems, strict=True) if x.isalpha()]
        space = " " if self.leading else ""
        for s in range(0, len(words), _JOINED):
            part = words[s:s + _JOINED]
            self._learn_joined(part, [space + w for w in part], "" if space else " ", lambda ids: self.edge[ids], np.cumsum(ends[s:s + _JOINED]))

    def _learn_joined(self, keys: list[str], texts: list[str], between: str, edge, upto: np.ndarray) -> None:
        """``edge`` tells the first ids of the texts, or where no space leads the last ids of their parts; ``upto`` counts them."""
        text = between + between.join(texts)
        if not _RUN.search(text):
            ids = np.array(self.whole([text])[0], np.uint32)
            edges = np.flatnonzero(edge(ids))
            if len(edges) == upto[-1]:
                stops = np.r_[edges[1:], len(ids)] if self.leading else edges[upto - 1] + 1
                if stops[-1] == len(ids) and (edges[0] == 0 or not self.leading):
                    self._learn(keys, np.diff(stops, prepend=0), ids)
                    return
        self._learn_each(keys, texts)

    def _stems(self, words: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """The words without one mark that follows a letter of the common alphabets, and that mark's id (else -1)."""
        stems = pc.ascii_rtrim(words, characters=_MARKS)
        sizes, left = pc.binary_length(words).to_numpy(), pc.binary_length(stems).to_numpy()
        data = np.frombuffer(words.buffers()[2] or b"", np.uint8)
        ends = np.frombuffer(words.buffers()[1], np.int32)[words.offset + 1:words.offset + len(words) + 1]
        one = np.flatnonzero((sizes - left == 1) & (left > 0))
        marks, last, lead = (data[np.maximum(ends[one] - k, 0)] for k in (1, 2, 3))
        # ASCII; two bytes of U+00C0 to U+017F and of U+0400 to U+047F, without the signs of multiplication and division
        # and the dotted capital I, which a lower-cased text ends with a combining dot
        two = np.isin(lead, (0xC3, 0xC4, 0xC5, 0xD0, 0xD1)) & (left[one] > 1) & (last & 0xC0 == 0x80)
        letter = ((last | 0x20) - np.uint8(97) < 26) & (last < 128) | two & ~((lead == 0xC3) & np.isin(last, (0x97, 0xB7)) | (lead == 0xC4) & (last == 0xB0))
        tails = np.full(len(words), -1, np.int64)
        tails[one] = np.where(letter, self.mark[marks], -1)
        return pc.if_else(pa.array(tails >= 0), stems, words), tails

    def _places(self, words: pa.Array, counts: np.ndarray) -> np.ndarray:
        """Where each of these distinct words is remembered; those that are counted and new are learnt."""
        places = pc.fill_null(pc.index_in(words, self.known), -1).to_numpy().astype(np.int64)
        new = np.flatnonzero((places < 0) & (counts > 0))
        if len(new):
            before, keys = self.n, words.take(pa.array(new))
            self._learn_words(keys.to_pylist())
            learnt, self.fresh = pa.concat_arrays(self.fresh), []
            places[new] = before + pc.index_in(keys, learnt).to_numpy()
            self.known = pa.concat_arrays([self.known, learnt])
        met = counts > 0
        self.met[places[met]] += counts[met]
        return places

    def encode(self, texts: list[str] | pa.Array) -> list[np.ndarray]:
        """The ids of each text, as unsigned 32-bit integers. Best given a whole batch at once."""
        texts = texts.cast(pa.string()) if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        if self.n > self.remembered:
            self._forget()
        if self.leading:
            whole = pc.match_substring_regex(texts, _INSIDE_RUN)
            odd, texts = texts.filter(whole).to_pylist(), texts.filter(pc.invert(whole))
            odd = iter(self.whole(odd) if odd else [])
            whole = whole.to_pylist()
            texts = pc.if_else(pc.match_substring_regex(texts, _LINE_IN_RUN), texts, pc.replace_substring(texts, "\n", " " + _AFTER))
        else:
            whole, odd = [False] * len(texts), iter(())
            texts = pc.replace_substring(texts, "\n", " ")
        cut = pc.split_pattern(texts, " ")
        bounds, words = cut.offsets.to_numpy(), cut.flatten()
        bounds = bounds - bounds[0]
        n, starts = len(words), bounds[:-1]
        if self.leading:  # the first word has no space before it: remembered under a name of its own
            first = pc.binary_join_element_wise(_FIRST, words.take(pa.array(starts)), "")
            words = pa.concat_arrays([words, first])
        words = words.dictionary_encode()
        codes = words.indices.to_numpy()
        if self.leading:
            first, codes = codes[n:], codes[:n].copy()
            codes[starts] = first
        stems, tails = self._stems(words.dictionary)
        stems = stems.dictionary_encode()
        of = stems.indices.to_numpy()
        counts = np.bincount(of, np.bincount(codes, minlength=len(of)), len(stems.dictionary)).astype(np.int64)
        places = self._places(stems.dictionary, counts)[of]
        at, length = self.at[places], self.length[places] + (tails >= 0)
        known = []
        for s in range(0, len(starts), _SLICE):
            edges = bounds[s:s + _SLICE + 1]
            part = codes[edges[0]:edges[-1]]
            lengths = length[part]
            ends = np.concatenate([[0], np.cumsum(lengths)])
            ids = self.flat[np.repeat(at[part] - ends[:-1], lengths) + np.arange(ends[-1])]
            marks = tails[part]
            marked = np.flatnonzero(marks >= 0)
            ids[ends[marked + 1] - 1] = marks[marked]
            stops = ends[edges - edges[0]].tolist()
            known += [ids[a:z] for a, z in zip(stops[:-1], stops[1:], strict=True)]
        known = iter(known)
        return [np.array(next(odd), np.uint32) if w else next(known) for w in whole]


@lru_cache(maxsize=2)
def encoder(path: str, remembered: int = REMEMBERED) -> WordEncoder:
    """One encoder per Python worker: what it remembers serves every task that the worker runs."""
    return WordEncoder(path, remembered)
