"""Token ids of a published word-level BPE vocabulary, word by word.

The vocabulary's rules drop white space and never join what white space separates, so a text's ids are
the ids of its words one after another.  Words repeat, so a bounded cache turns most of the work into
look-ups; a word that is not in it goes through the tokenizer's own model.  Texts with characters for
which lower-casing or normalisation could depend on their neighbours go through the whole tokenizer.
"""

from __future__ import annotations

import os
import re

# Fixed values of the vocabulary's published rules: the letters and digits of the plain range after
# lower-casing, and the pattern that cuts words into pieces.
LETTERS = "a-zªµºß-öø-ſ"
DIGITS = "0-9²³¹¼-¾"
PIECES = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[{DIGITS}]|[^\\s{LETTERS}{DIGITS}]+")
# Characters that lower-case one by one and never combine with a neighbour (U+0130 does not qualify).
PLAIN = re.compile("[\n\t\x20-\x7e\xa1-įı-ſ]*")
SPECIAL = "<|"

END = (1).to_bytes(4, "little")
CACHED_WORDS = 300_000


def _byte_letters() -> dict[int, str]:
    """The byte-level alphabet: printable bytes stand for themselves, the others follow from U+0100 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(rest)}


class WordTokens:
    """Ids as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str, cached_words: int = CACHED_WORDS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.alphabet = str.maketrans({chr(b): c for b, c in _byte_letters().items()})
        self.cached_words = cached_words
        self.words: dict[str, bytes] = {}

    def _word(self, word: str) -> bytes:
        ids: list[int] = []
        for piece in PIECES.findall(word):
            if not piece.isascii():
                piece = piece.encode().decode("latin-1").translate(self.alphabet)
            ids += [token.id for token in self.model.tokenize(piece)]
        return b"".join(i.to_bytes(4, "little") for i in ids)

    def ids(self, text: str) -> bytes:
        if SPECIAL in text or not PLAIN.fullmatch(text):
            found = self.tokenizer.encode(text, add_special_tokens=False).ids
            return b"".join(i.to_bytes(4, "little") for i in found)
        words = text.lower().split()
        new = set(words).difference(self.words)
        if new:
            if len(self.words) + len(new) > self.cached_words:
                self.words.clear()
                new = set(words)
            for word in new:
                self.words[word] = self._word(word)
        return b"".join(map(self.words.__getitem__, words))


_loaded: dict[str, WordTokens] = {}


def word_tokens(path: str) -> WordTokens:
    """One tokenizer for each Python worker."""
    if path not in _loaded:
        _loaded[path] = WordTokens(path)
    return _loaded[path]
