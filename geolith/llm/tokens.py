"""Exact tokenizer output through a cache of space-separated words.

Both vocabularies used here split a text before its merges, and no pre-token reaches over a single
space that has something other than white space on its left. So the ids of a text are the ids of its
space-separated words in a row, and the library need only encode each distinct word once a task.
Texts in which that does not hold (white space in a row, or at an end) are encoded whole.
"""

from __future__ import annotations

import functools
import re
import string
import unicodedata
from array import array

import numpy as np

#: Words beyond this many make a worker's cache start anew; longer words are not kept.
CACHE_WORDS, CACHE_CHARS = 250_000, 48

#: A space after other white space; with \x85 and the separators that Python and the library count alike or not.
_RUN = re.compile(r"[^\S\x20]\x20")
#: A newline beside other white space or at an end; any other is a pre-token of its own, or none.
_BROKEN = re.compile(r"\s\n|\n\s|^\n|\n$")


def _stays_letter(letters: str) -> bool:
    """Whether letters still end in one as the library writes them; a mark at their end would join what follows."""
    return letters.isascii() or unicodedata.normalize("NFC", letters.lower())[-1:].isalpha()


class _Words(dict):
    """word -> its ids as little-endian uint16, with `before` in front of the word."""

    def __init__(self, tokenizer, before: str, bare: _Words | None, any_case: bool) -> None:
        from tokenizers.pre_tokenizers import ByteLevel

        as_bytes = ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        #: The library's own writing of the bytes of the characters that `plain` allows.
        self.written = {c: as_bytes(chr(c))[0][0] for c in range(256) if chr(c).isalpha()}
        self.tokenizer, self.model, self.before, self.any_case = tokenizer, tokenizer.model, before, any_case
        self.mark = as_bytes(before)[0][0] if before else ""
        self.bare = self if bare is None else bare

    def plain(self, word: str) -> bytes:
        """Letters of Latin-1 alone: one pre-token, which Unicode normalisation leaves as it is."""
        if self.any_case:
            word = word.lower()
        if not word.isascii():
            word = word.translate(self.written)
        return array("H", [token.id for token in self.model.tokenize(self.mark + word)]).tobytes()

    def __missing__(self, word: str) -> bytes:
        if word.isalpha() and (word.isascii() or max(word) < "\u0100"):
            ids = self.plain(word)
        elif (letters := word.rstrip(string.punctuation)) != word and letters.isalpha() and _stays_letter(letters):  # what is no letter, digit or space is a pre-token of its own
            ids = self[letters] + self.bare[word[len(letters) :]]
        elif "\n" in word and not _BROKEN.search(word):
            ids = self.bare["\n"].join(map(self.bare.__getitem__, (lines := word.split("\n"))[1:]))
            ids = self[lines[0]] + self.bare["\n"] + ids
        else:
            ids = array("H", self.tokenizer.encode(self.before + word, add_special_tokens=False).ids).tobytes()
        if len(word) <= CACHE_CHARS:
            if len(self) >= CACHE_WORDS:
                self.clear()
            self[word] = ids
        return ids


class WordEncoder:
    """ids(text) equals the library's encode(text, add_special_tokens=False).ids, as uint16 bytes.

    Vocabularies of at most 65,536 ids. A tokenizer either removes white space (word BPE) or leaves the
    space before a word with it (byte-level BPE); either is found by trying.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = tokenizer = Tokenizer.from_file(path)
        if tokenizer.get_vocab_size() > 1 << 16:
            raise ValueError("ids must fit 16 bits")
        tried = lambda text: tokenizer.encode(text, add_special_tokens=False).ids
        self.drops_space = not tried("\x20")
        self.first = _Words(tokenizer, "", None, tried("THE") == tried("the"))
        self.later = self.first if self.drops_space else _Words(tokenizer, "\x20", self.first, False)

    def ids(self, text: str | None) -> bytes:
        if not text:
            return b""
        words = text.split("\x20")
        if self.drops_space:
            return b"".join(map(self.first.__getitem__, words))
        if "" in words or _RUN.search(text):
            return array("H", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        return self.first[words[0]] + b"".join(map(self.later.__getitem__, words[1:]))


@functools.cache
def encoder(path: str) -> WordEncoder:
    """One for a path in each worker, so that its cache serves the tasks after."""
    return WordEncoder(path)


def end_mark(end_id: int) -> bytes:
    return np.array([end_id], "<u2").tobytes()
