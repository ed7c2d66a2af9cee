"""Token ids of whole texts from a tokenizer file, fast on ordinary prose.

Both kinds of tokenizer used here split a text before anything else and encode the parts
on their own, and a blank between two other characters is always such a split. Texts are
cut there, byte-level ones at single line breaks as well; the library encodes each distinct
chunk once and its ids are remembered. New chunks go to it many at a time, as one text: a call
per chunk takes twice as long. Its ids are cut where tokens begin with a blank or end a word, and for
other chunks at separators that always are a token of their own. Where a blank touches other
white space, or normalising changes a chunk's length, the library encodes the text in one piece.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import lru_cache
from itertools import batched, islice
from unicodedata import normalize

import numpy as np

#: Chunks remembered, some 200 bytes each: at most 120 MB. At the limit the older half is forgotten.
REMEMBERED = 600_000
#: Characters encoded per step.
STEP_CHARS = 200_000
#: A run of these at a chunk's end is a part of its own after letters.
ENDINGS = ".,;:!?#$%&*|"
#: New chunks that the library gets as one text.
JOINED = 128
#: Where one of these occurs a line break may not be a part of its own.
BREAKS = ("\n\n", "\n ", " \n", "\n\t", "\t\n", "\r")


def steps(texts: list[str]) -> Iterator[list[str]]:
    """Lists of a bounded number of characters, or of one longer text."""
    some, size = [], 0
    for text in texts:
        if some and size + len(text) > STEP_CHARS:
            yield some
            some, size = [], 0
        some.append(text)
        size += len(text)
    if some:
        yield some


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit integers.

    ``glued``: the blank before a word belongs to it (byte-level splitting); otherwise
    the tokenizer drops white space. Strings of special tokens are ordinary text. Tasks share
    the one of their worker process (:func:`encoder`): loading it and learning the commonest
    chunks anew cost more than most tasks.
    """

    def __init__(self, path: str, glued: bool):
        # A task has one core: the library's own threads only cost time.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True
        self.glued = glued
        # Between chunks a line break stands alone; where white space is dropped, a sign between blanks does.
        self.sign = "\n" if glued else "\x01"
        self.separator = self.sign if glued else f" {self.sign} "
        alone = self.library.encode(self.separator, add_special_tokens=False).ids
        self.separating = alone[0] if len(alone) == 1 else None
        vocabulary = self.library.get_vocab(with_added_tokens=True)
        # Tokens that hold a blank, or end a word: one of each chunk that goes to the library without a separator.
        self.marked = np.zeros(max(vocabulary.values(), default=0) + 1, dtype=bool)
        self.marked[[at for token, at in vocabulary.items() if (token.startswith("\u0120") if glued else token.endswith("</w>"))]] = True
        # False: a text with this chunk goes to the library whole.
        self.known: dict[str, bytes | bool] = {}

    def encode(self, texts: list[str | None]) -> Iterator[bytes]:
        for some in steps([text or "" for text in texts]):
            yield from self._encode(some)

    def _library(self, texts: list[str]) -> list[bytes]:
        found = self.library.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(one.ids, dtype="<u4").tobytes() for one in found]

    def _chunks(self, chunks: list[str]) -> Iterator[bytes]:
        """Ids per chunk. Chunks have no separator's sign and, but for a leading blank, no white space at their ends."""
        for some in batched(chunks, JOINED):
            if self.separating is not None:
                ids = np.frombuffer(self._library([self.separator.join(some)])[0], dtype="<u4")
                cuts = 4 * np.flatnonzero(ids == self.separating)
                if len(cuts) == len(some) - 1:
                    octets = ids.tobytes()
                    yield from map(octets.__getitem__, map(slice, [0, *(cuts + 4).tolist()], [*cuts.tolist(), len(octets)]))
                    continue
            yield from self._library(list(some))

    def _words(self, chunks: list[str]) -> Iterator[bytes]:
        """Ids per chunk of which one token is marked: the first with a leading blank, the last of nothing but letters."""
        for some in batched(chunks, JOINED):
            octets = self._library([("" if self.glued else " ").join(some)])[0]
            marks = np.flatnonzero(self.marked[np.frombuffer(octets, dtype="<u4")])
            if len(marks) == len(some):
                cuts = (4 * marks).tolist() + [len(octets)] if self.glued else [0] + (4 * marks + 4).tolist()
                if cuts[0] == 0 and cuts[-1] == len(octets):
                    yield from map(octets.__getitem__, map(slice, cuts, cuts[1:]))
                    continue
            yield from self._chunks(list(some))

    def _cut(self, text: str) -> list[str] | None:
        if not self.glued:
            return text.replace("\n", " ").split(" ")
        if "\0" in text:
            return None
        if not any(pair in text for pair in BREAKS) and text.strip("\n") == text:
            text = text.replace("\n", "\0\n\0")
        return text.replace(" ", "\0 ").split("\0")

    def _encode(self, texts: list[str]) -> Iterator[bytes]:
        if len(self.known) > REMEMBERED:
            # Dictionaries keep the order of insertion, so the latter half is the younger.
            self.known = dict(islice(self.known.items(), len(self.known) // 2, None))
        lists = [self._cut(text) for text in texts]
        get = self.known.get
        found = [list(map(get, chunks or ())) for chunks in lists]
        new = [[at for at, ids in enumerate(some) if ids is None] for some in found]
        self._learn({chunks[at] for chunks, places in zip(lists, new, strict=True) for at in places})
        of = self.known.__getitem__
        for text, chunks, some, places in zip(texts, lists, found, new, strict=True):
            for at in places:
                some[at] = of(chunks[at])
            if chunks is None or False in some:
                yield self._library([text])[0]
            else:
                yield b"".join(some)

    def _learn(self, chunks: set[str]) -> None:
        known, glued, words, parted = self.known, self.glued, [], []
        stems, whole = set(), {"", "\n"}
        for chunk in chunks:
            blank = glued and chunk[:1] == " "
            inner = chunk[1:] if blank else chunk
            letters = inner.isalpha()
            if not letters and glued and chunk and chunk != "\n" and (not inner or inner[0].isspace() or inner[-1].isspace()):
                known[chunk] = False
                continue
            if not (glued or chunk.isascii()) and len(normalize("NFC", chunk).lower()) != len(chunk):
                known[chunk] = False
                continue
            if letters:
                if blank or not glued:
                    words.append(chunk)
                else:
                    whole.add(chunk)
                continue
            stem = chunk.rstrip(ENDINGS)
            if len(stem) < len(chunk) and (stem[1:] if blank else stem).isalpha():
                parted.append((chunk, stem, chunk[len(stem) :]))
                (stems if blank or not glued else whole).add(stem)
                whole.add(chunk[len(stem) :])
            elif blank and "\n" not in chunk:
                words.append(chunk)
            else:
                whole.add(chunk)
        words += [stem for stem in stems if stem not in known and stem not in chunks]
        known.update(zip(words, self._words(words), strict=True))
        new = [chunk for chunk in whole if chunk not in known]
        single = [chunk for chunk in new if not chunk or self.sign in chunk]
        known.update(zip(single, self._library(single), strict=True))
        joined = [chunk for chunk in new if chunk and self.sign not in chunk]
        known.update(zip(joined, self._chunks(joined), strict=True))
        for chunk, stem, ending in parted:
            known[chunk] = known[stem] + known[ending]


@lru_cache(maxsize=1)
def encoder(path: str, glued: bool) -> Encoder:
    """The worker process's encoder for a tokenizer file; another file replaces it."""
    return Encoder(path, glued)
