"""Whole-text encoding with a word-wise BPE file of the tokenizers library, each word encoded once.

The vocabulary drops white space and never merges across it, so a text's ids are its words' ids in order. Words
met before come from a bounded dictionary; the others go to the library together, in batches. What is cut, and
why the ids stay those of one call over the whole text:

* Texts are cut at white space only. The file's normaliser (canonical composition, lower case) does not reach
  across white space, nor do its added tokens.
* A word of printable Latin-1 characters without an apostrophe or "<|" falls into runs of letters, single digits
  and runs of other characters, as the file's own pattern cuts it; those runs are encoded by a copy of the model
  that has no normaliser and cuts at spaces. Every run ends in a token marked as a word's end, which gives the
  runs' ids back from one call.
* All other words (other scripts, apostrophes, added tokens, control characters) go to the library as they are.
"""

from __future__ import annotations

import codecs
import os
import re

import numpy as np

LETTER = "a-zªµºß-öø-ÿ"
DIGIT = "0-9²³¹¼½¾"
RUNS = re.compile(f"[{LETTER}]+|[{DIGIT}]|[^{LETTER}{DIGIT}]+")
PLAIN = re.compile("[!-&(-~¡-ÿ]+")
ALL_PLAIN = re.compile("[ !-&(-~¡-ÿ]+")
# white space for Python that may be an ordinary character for the library
ODD = re.compile("[\x1c-\x1f]")
WORDS = 250000  # words of a generation: a Python worker remembers the last full one and the one that grows
KEPT_RUNS = 180000  # runs of a generation, likewise
LONGEST = 64  # characters of a word or run worth remembering
CALL = 200_000  # characters given to the library at once


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class WordEncoder:
    """ids(text): numpy array of 32-bit ids of the whole text (null: none)."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.whole = Tokenizer.from_file(path)
        self.bare = Tokenizer(self.whole.model)
        self.bare.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        vocab = self.whole.get_vocab(with_added_tokens=False)
        self.ends = np.zeros(max(vocab.values()) + 1, dtype=bool)
        self.ends[[i for token, i in vocab.items() if token.endswith("</w>")]] = True
        alphabet = _byte_alphabet()
        self.bytes_as_text = "".join(chr(b) if b < 0x80 else alphabet[b] for b in range(0x100))
        self.words: dict[str, bytes] = {}
        self.runs: dict[str, bytes] = {}
        self.old_words: dict[str, bytes] = {}
        self.old_runs: dict[str, bytes] = {}

    def ids(self, text: str | None) -> np.ndarray:
        return np.frombuffer(self.packed([text])[0], dtype="<u4")

    def packed(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        odd = {i for i, t in enumerate(texts) if t and ODD.search(t)}
        found = [(t or "").split() if i not in odd else [] for i, t in enumerate(texts)]
        if len(self.words) > WORDS:
            self.old_words, self.words = self.words, {}
        known = self.words
        new = _recalled(set().union(*found).difference(known), self.old_words, known)
        if new:
            self._words(new)
        out = [b"".join([known[w] for w in ws]) for ws in found]
        for w in [w for w in new if len(w) > LONGEST]:
            del known[w]
        for i in odd:
            out[i] = self._library([texts[i]])[0]
        return out

    def _words(self, words: set[str]) -> None:
        """Encodes words that are not known and remembers them."""
        out = self.words
        cut: dict[str, list[str]] = {}
        cuts, plain = RUNS.findall, PLAIN.fullmatch
        together = " ".join(words)
        others = [] if "<|" not in together and ALL_PLAIN.fullmatch(together) else [w for w in words if "<|" in w or not plain(w)]
        out.update(zip(others, self._library(others), strict=True))
        for w in words.difference(others) if others else words:
            lower = w.lower()
            cut[w] = ([w] if lower == w else [lower]) if lower.isalpha() else cuts(lower)
        if len(self.runs) > KEPT_RUNS:
            self.old_runs, self.runs = self.runs, {}
        runs = self.runs
        new = list(_recalled(set().union(*cut.values()).difference(runs), self.old_runs, runs))
        at = 0
        while at < len(new):
            upto, size = at, 0
            while upto < len(new) and (size == 0 or size + len(new[upto]) < CALL):
                size += len(new[upto]) + 1
                upto += 1
            batch = new[at:upto]
            text = codecs.charmap_decode(" ".join(batch).encode(), "strict", self.bytes_as_text)[0]
            ids = np.asarray(self.bare.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype="<u4")
            stops = np.flatnonzero(self.ends[ids]) + 1
            if len(stops) != len(batch):
                raise ValueError("the vocabulary does not end every run with a word-end token")
            raw, start = ids.tobytes(), 0
            for r, stop in zip(batch, (4 * stops).tolist(), strict=True):
                runs[r] = raw[start:stop]
                start = stop
            at = upto
        for w, rs in cut.items():
            out[w] = runs[rs[0]] if len(rs) == 1 else b"".join([runs[r] for r in rs])
        for r in [r for r in new if len(r) > LONGEST]:
            del runs[r]

    def _library(self, texts: list[str]) -> list[bytes]:
        out: list[bytes] = []
        at = 0
        while at < len(texts):
            upto, size = at, 0
            while upto < len(texts) and (size == 0 or size + len(texts[upto]) < CALL):
                size += len(texts[upto])
                upto += 1
            out += [np.asarray(e.ids, dtype="<u4").tobytes()
                    for e in self.whole.encode_batch_fast(texts[at:upto], add_special_tokens=False)]
            at = upto
        return out


def _recalled(new: set[str], old: dict[str, bytes], known: dict[str, bytes]) -> set[str]:
    """Takes what the generation before knows into the one that grows; returns what neither knows."""
    again = {w: old[w] for w in new if w in old}
    known.update(again)
    return new.difference(again) if again else new


def _byte_alphabet() -> dict[int, str]:
    """The printable stand-ins of byte-level vocabularies: a byte that prints stands for itself, others follow from 256."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}


def groups(texts: list[str | None], size: int = CALL):
    """Ranges of consecutive texts with about `size` characters, at least one text each."""
    at = 0
    while at < len(texts):
        upto, seen = at, 0
        while upto < len(texts) and (upto == at or seen + len(texts[upto] or "") <= size):
            seen += len(texts[upto] or "")
            upto += 1
        yield at, upto
        at = upto


_encoders: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """One encoder for each Python worker and file."""
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]
