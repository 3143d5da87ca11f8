"""Token ids of whole texts, by a tokenizer that drops white space and encodes words apart."""

from __future__ import annotations

import os
import re
from functools import lru_cache
from struct import pack as packed

import numpy as np
from tokenizers import Tokenizer

#: Words that a worker keeps spelled out; twice as many are held at most.
KEPT_WORDS = 400_000
_TAIL = ".,;:!?"
#: Letters that normalisation only lower-cases, one for one: ASCII and Latin-1.
PLAIN = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+")


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    """The place of a public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_letters() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies: printable
    ones for themselves, the others counted on from 256."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in printable]
    return [chr(b) if b in printable else chr(256 + others.index(b)) for b in range(256)]


_LETTER_OF = dict(enumerate(byte_letters()))


def byte_level(text: str) -> str:
    """The text's bytes as the characters of byte-level vocabularies."""
    return text.encode().decode("latin-1").translate(_LETTER_OF)


class Remembered:
    """A mapping of bounded size: what was used since the last turn survives a turn."""

    def __init__(self, size: int):
        self.size, self.new, self.old = size, {}, {}

    def missing(self, keys) -> set:
        """The keys that are not known; known ones are moved to the new generation."""
        if len(self.new) > self.size:
            self.old, self.new = self.new, {}
        new, old = self.new, self.old
        unknown = {key for key in keys if key not in new}
        if old:
            found = {key: old[key] for key in unknown if key in old}
            new.update(found)
            unknown.difference_update(found)
        return unknown


class WordEncoder:
    """Ids as little-endian 32-bit integers, equal to those of encoding the whole text.

    The vocabulary's rules never join what white space separates, so each distinct word
    is encoded once and remembered. A word of plain letters is one piece, and so is the
    punctuation after it; every other word goes through the tokenizer as it stands.
    Strings of special tokens in a text become their ids, as the tokenizer does it.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the tasks are the threads
        self.tokenizer = Tokenizer.from_file(path)
        self.spell = self.tokenizer.model.tokenize
        self.words = Remembered(KEPT_WORDS)
        self.tails: dict[str, bytes] = {"": b""}

    def __call__(self, text: str) -> bytes:
        words = text.replace("\n", " ").split(" ")
        unknown = self.words.missing(words)
        if unknown:
            self._learn(unknown)
        return b"".join(map(self.words.new.__getitem__, words))

    def _learn(self, words: set[str]) -> None:
        known, odd, spell, is_plain, letters_of = self.words.new, [], self.spell, PLAIN.fullmatch, byte_level
        for word in words:
            stem = word.rstrip(_TAIL)
            if is_plain(stem):
                tokens = spell(stem.lower() if stem.isascii() else letters_of(stem.lower()))
                ids = packed(f"<{len(tokens)}I", *[token.id for token in tokens])
                known[word] = ids if len(stem) == len(word) else ids + self._tail(word[len(stem) :])
            else:
                odd.append(word)
        for word, encoding in zip(odd, self.tokenizer.encode_batch_fast(odd, add_special_tokens=False), strict=True):
            known[word] = np.array(encoding.ids, "<u4").tobytes()

    def _tail(self, tail: str) -> bytes:
        if tail not in self.tails:
            ids = np.array(self.tokenizer.encode(tail, add_special_tokens=False).ids, "<u4").tobytes()
            if len(tail) > 3:
                return ids
            self.tails[tail] = ids
        return self.tails[tail]


@lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    """The worker's encoder, shared by its tasks."""
    return WordEncoder(path)
