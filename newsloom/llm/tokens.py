"""Texts to token ids by a public tokenizer, in Arrow batches.

The vocabulary's normaliser lower-cases, its pre-tokenizer cuts at every blank and line feed and then
into runs of letters, single digits and runs of signs. So a text's words are encoded one by one and
kept, like the runs in them, in bounded caches per Python worker. Words of printable ASCII and
precomposed Latin letters, which normalisation leaves alone, are cut here and their runs go straight
to the vocabulary's merges; all others go through the whole tokenizer. A text with the string of a
special token goes through it in one piece, which gives that token's id. The ids are those of the whole
text.
"""

from __future__ import annotations

import os
import re

import numpy as np

from newsloom.llm.common import worker_cache

CACHED_WORDS = 100_000
CACHED_RUNS = 200_000
END_ID = 1

#: Printable ASCII, Latin-1 letters and Latin Extended-A and B, but for the dotted capital I.
_PLAIN = re.compile("[!-~À-įı-ɏ]*")
#: The tokenizer's own cuts, as they fall within these characters.
_RUNS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\s\w]|_)+")


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte: itself where it is printable, else the next from U+0100."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + n) for n, b in enumerate(others)}


class _Runs(dict):
    """Ids of runs, looked up in the vocabulary's merges when first asked for."""

    def __init__(self, tokenizer) -> None:
        self.tokenize = tokenizer.model.tokenize
        self.letters = _byte_letters()

    def __missing__(self, run: str) -> bytes:
        if len(self) >= CACHED_RUNS:
            self.clear()
        letters = run if run.isascii() else "".join(map(self.letters.__getitem__, run.encode()))
        found = self[run] = np.array([t.id for t in self.tokenize(letters)], dtype="<u4").tobytes()
        return found


class _Words(dict):
    """Ids of the words between blanks."""

    def __init__(self, tokenizer) -> None:
        self.tokenizer = tokenizer
        self.runs = _Runs(tokenizer)
        self[""] = b""

    def __missing__(self, word: str) -> bytes:
        if word.isascii() and word.isalpha():
            found = self.runs[word.lower()]
        elif _PLAIN.fullmatch(word):
            found = b"".join(map(self.runs.__getitem__, _RUNS.findall(word.lower())))
        else:
            found = np.array(self.tokenizer.encode(word, add_special_tokens=False).ids, dtype="<u4").tobytes()
        self[word] = found
        return found


class WordEncoder:
    """`encode` gives a text's ids as the bytes of little-endian unsigned 32-bit numbers."""

    def __init__(self, vocabulary: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(vocabulary)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.words = _Words(self.tokenizer)

    def encode(self, text: str) -> bytes:
        if any(s in text for s in self.special):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
        if len(self.words) > CACHED_WORDS:
            self.words.clear()
            self.words[""] = b""
        return b"".join(map(self.words.__getitem__, text.replace("\n", " ").split(" ")))


def encoder(vocabulary: str) -> WordEncoder:
    return worker_cache(f"encoder {vocabulary}", lambda: WordEncoder(vocabulary))


def document_ids(text: str, vocabulary: str, end_id: int = END_ID) -> bytes:
    """The ids of a text followed by `end_id`."""
    return encoder(vocabulary).encode(text) + end_id.to_bytes(4, "little")
