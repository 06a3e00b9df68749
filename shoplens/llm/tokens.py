"""Token ids of whole texts, with the tokenizers library and a cache of words."""

from __future__ import annotations

import os
import re
import struct
import unicodedata
from functools import cache

import public_tokenizers

from shoplens.llm.memory import on_release

WORD_BPE = "word_bpe_49k.json"
CACHED_WORDS = 1_500_000
# words of lower-case letters of ASCII and Latin-1, which the tokenizer only has to split
PLAIN = re.compile(rb"[a-z]+")
LETTERS = re.compile(rb"(?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])+")
STOPPED = re.compile(LETTERS.pattern + rb"(?=[.,]+\Z)")


class Words(dict):
    """The ids of words as unsigned little-endian 32-bit integers, found when first asked for."""

    def __init__(self, path: str) -> None:
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.split = self.tokenizer.model.tokenize
        top = max(self.tokenizer.get_vocab().values())
        self.packed = [struct.pack("<I", k) for k in range(top + 1)]

    def __missing__(self, word: bytes) -> bytes:
        if PLAIN.fullmatch(word):
            found = [p.id for p in self.split(word.decode())]
        elif stem := STOPPED.match(word):
            # stops behind letters are a word of their own
            self[word] = ids = self[stem[0]] + self[word[stem.end():]]
            return ids
        elif LETTERS.fullmatch(word):
            found = [p.id for p in self.split(word.decode("latin-1").translate(BYTE_LEVEL))]
        else:
            found = self.tokenizer.encode(word.decode(), add_special_tokens=False).ids
        self[word] = ids = b"".join([self.packed[k] for k in found])
        return ids


class WordEncoder:
    """Encodes texts word by word, for tokenizers that drop white space between words.

    Such a tokenizer gives a text the ids of its words one after the other, so each different word
    is encoded once as long as it stays in the cache, which is emptied when it is full.
    """

    def __init__(self, path: str, cached: int = CACHED_WORDS) -> None:
        self.ids = Words(path)
        self.cached = cached

    @staticmethod
    def words(text: str) -> list[bytes]:
        """The text's parts between ASCII white space, in lower case where that changes no id.

        The tokenizer lowers letters itself, one by one, after composing them, but looks for its
        special tokens first.
        """
        if "<|" not in text and "\u03a3" not in text and unicodedata.is_normalized("NFC", text):
            text = text.lower()
        return text.encode().split()

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text as unsigned little-endian 32-bit integers; NULL is empty."""
        ids, out = self.ids, []
        for text in texts:
            if len(ids) > self.cached:
                ids.clear()
            out.append(b"".join(map(ids.__getitem__, self.words(text))) if text else b"")
        return out


def _byte_level() -> dict[int, int]:
    """The letters by which byte-level tokenizers write bytes; the printable ones are themselves."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in printable]
    return {b: 256 + k for k, b in enumerate(others)}


BYTE_LEVEL = _byte_level()


@cache
def encoder(path: str | None = None, cached: int = CACHED_WORDS) -> WordEncoder:
    """One encoder for each file, size of its cache and Python worker."""
    made = WordEncoder(path or public_tokenizers.path(WORD_BPE), cached)
    on_release(made.ids.clear)
    return made
