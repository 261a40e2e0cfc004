"""Token ids of texts with a chunk cache in front of the tokenizer's model.

A byte-level BPE with the usual word pattern never joins across a single space
that stands between two characters that are not white space, so a text is cut
there and each chunk (with its leading space) is encoded once per worker and
kept.  Inside a chunk of letters, digits and symbols the word pattern only cuts
where no merge exists, so such chunks go to the model at once; chunks with an
apostrophe go through the whole tokenizer, and texts in which a cut would touch
other white space, or that hold an added token literally, are encoded whole.
"""

from __future__ import annotations

import re
from array import array
from operator import itemgetter

#: Chunks kept per worker, about 220 bytes each; later ones are encoded each time.
CACHE_ENTRIES = 200_000
#: Not white space, apart from single line breaks inside, and no apostrophe.
_PLAIN = re.compile(r"[^\s']+(?:\n[^\s']+)*")


class _Uncuttable(Exception):
    """A chunk starts or ends with white space, or is empty."""


def _byte_letters() -> dict[str, str]:
    """The printable letter that stands for each byte: itself, or the next one free above 255."""
    table, free = {}, 256
    for byte in range(256):
        if 33 <= byte <= 126 or 161 <= byte <= 172 or byte >= 174:
            continue
        table[chr(byte)] = chr(free)
        free += 1
    return str.maketrans(table)


class ChunkEncoder(dict):
    """Ids as little-endian unsigned 32-bit bytes; identical to encoding whole texts."""

    def __init__(self, path: str, cache_entries: int = CACHE_ENTRIES) -> None:
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        # found in the text before the word pattern, so a cut could go through one
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.model = self.tokenizer.model
        self.tokenize = self.model.tokenize
        self.letters = _byte_letters()
        self.space = " ".translate(self.letters)
        self.entries = cache_entries

    def _whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _piece(self, text: str) -> bytes:
        letters = text.encode().decode("latin-1").translate(self.letters)
        return array("I", [t.id for t in self.model.tokenize(letters)]).tobytes()

    def __missing__(self, chunk: str) -> bytes:
        """Ids of a chunk after a space."""
        if chunk.isascii() and chunk.isprintable() and "'" not in chunk and chunk:
            # printable ASCII stands for itself, and the space has its own letter
            ids = array("I", [t.id for t in self.tokenize(self.space + chunk)]).tobytes()
        elif _PLAIN.fullmatch(chunk):
            ids = self._piece(" " + chunk)
        elif not chunk or chunk[0].isspace() or chunk[-1].isspace():
            raise _Uncuttable
        else:
            ids = self._whole(" " + chunk)
        if len(self) < self.entries:
            self[chunk] = ids
        return ids

    def encode(self, text: str) -> bytes:
        for content in self.added:
            if content in text:
                return self._whole(text)
        first, *rest = text.split(" ")
        try:
            if not rest:
                return self._whole(text)
            if not first or first[-1].isspace():
                raise _Uncuttable
            ids = itemgetter(*rest)(self) if len(rest) > 1 else (self[rest[0]],)
            return (self._piece(first) if _PLAIN.fullmatch(first) else self._whole(first)) + b"".join(ids)
        except _Uncuttable:
            return self._whole(text)


_ENCODERS: dict[str, ChunkEncoder] = {}


def encoder(path: str, cache_entries: int = CACHE_ENTRIES) -> ChunkEncoder:
    """One encoder per worker process and vocabulary file; the cache may grow to the largest size asked for."""
    if path not in _ENCODERS:
        _ENCODERS[path] = ChunkEncoder(path, cache_entries)
    found = _ENCODERS[path]
    found.entries = max(found.entries, cache_entries)
    return found
