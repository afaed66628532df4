"""Token ids of whole texts by a public tokenizer, unit by unit with caches.

A text is cut at blanks (byte-level vocabularies) or at white space (those that
drop it) into units, where the tokenizer's own pre-tokenizer cuts it too, so the
ids of a text are those of its units in a row.  A unit that is not in the
worker's cache is cut further into the pre-tokenizer's pieces (Latin units,
all new ones of a text at once), and only pieces that are not cached either go
to the tokenizer's model.  A text that holds a string of an added token goes to
the tokenizer as it is.
"""

from __future__ import annotations

import codecs
import os
import re
import unicodedata
from array import array
from collections.abc import Collection
from itertools import pairwise

from pitchlake.llm.common import worker_cache

# White space as the tokenizers' patterns see it (the Unicode property).
_SPACE = "\t-\r \x85\xa0  -     　"
_WORDS = re.compile(f"[^{_SPACE}]+")
# Characters that str.split() takes for white space and the patterns don't.
_OTHER_SPLITS = re.compile("[\x1c-\x1f]")
# A blank between white space, or between white space and the end: no cut of the pre-tokenizer.
_INNER_BLANK = re.compile(f"[{_SPACE}] (?![^{_SPACE}])")
# Up to here (Latin letters) the classes of characters are fixed in all Unicode versions.
_LATIN = 0x24F
_NOT_LATIN = re.compile(f"[^\x00-{chr(_LATIN)}]")
_CONTRACTIONS = "'s|'t|'re|'ve|'m|'ll|'d"


def _class(kind: str) -> str:
    """The Latin characters of a Unicode category (L: letters, N: numbers), as the inside of a [...]."""
    return "".join(chr(c) for c in range(_LATIN + 1) if unicodedata.category(chr(c))[0] == kind)


_L, _N = _class("L"), _class("N")
_BYTE_PIECES = re.compile(f"{_CONTRACTIONS}| ?[{_L}]+| ?[{_N}]+| ?[^{_SPACE}{_L}{_N}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+")
_WORD_PIECES = re.compile(f"{_CONTRACTIONS}|[{_L}]+|[{_N}]|[^{_SPACE}{_L}{_N}]+")
# A unit that is empty or begins with white space: after another unit, a cut of the pre-tokenizer could differ.
_BARE_UNIT = re.compile(f" (?![^{_SPACE}])")
# Characters that stand for bytes in byte-level vocabularies: themselves where they print, else those from U+0100 on.
_PRINTED = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_OTHERS = sorted(set(range(256)) - set(_PRINTED))
_BYTE_CHARS = "".join(chr(b) if b in _PRINTED else chr(0x100 + _OTHERS.index(b)) for b in range(256))
# Units and pieces that a worker keeps; later ones are encoded each time (frequent ones come early).
CACHE_UNITS, CACHE_PIECES = 500_000, 200_000


class Encoder:
    """``encode(text)`` gives the ids as little-endian unsigned 32-bit integers.

    ``byte_level``: True for byte-level vocabularies, False for those that lower
    the case and drop white space.  Strings of added tokens in a text give the
    ids of these tokens, as the tokenizer does by itself, or with ``plain_text``
    those of ordinary text.  Null is the empty text.  A text is taken whole,
    whatever its length.
    """

    def __init__(self, path: str, byte_level: bool, plain_text: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = plain_text
        added = [] if plain_text else [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        # The tokenizer finds them in the raw or in the normalised text, so compare without case.
        self.added = re.compile("|".join(map(re.escape, added)), re.IGNORECASE) if added else None
        self.added_start = os.path.commonprefix(added)[:1]
        self.model, self.byte_level = self.tokenizer.model, byte_level
        self.units: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}

    @classmethod
    def of(cls, path: str, byte_level: bool, plain_text: bool = False) -> Encoder:
        """The worker's encoder for this vocabulary file."""
        kept = worker_cache("encoders")
        if (path, byte_level, plain_text) not in kept:
            kept[path, byte_level, plain_text] = cls(path, byte_level, plain_text)
        return kept[path, byte_level, plain_text]

    def _pieces(self, pieces: list[str]) -> list[bytes]:
        """The ids of each of the pre-tokenizer's pieces (Latin), those not cached by the tokenizer's model."""
        found, tokenize = {}, self.model.tokenize
        out = list(map(self.pieces.get, pieces))
        for at, ids in enumerate(out):
            if ids is None:
                piece = pieces[at]
                if piece not in found:
                    written = codecs.charmap_decode(piece.encode(), "strict", _BYTE_CHARS)[0]
                    found[piece] = array("I", [t.id for t in tokenize(written)]).tobytes()
                out[at] = found[piece]
        if len(self.pieces) < CACHE_PIECES:
            self.pieces.update(found)
        return out

    def _ids(self, text: str) -> bytes:
        """The ids of a unit or text: of the pre-tokenizer's pieces (Latin), else by the whole tokenizer."""
        normal = text if self.byte_level or text.isascii() else unicodedata.normalize("NFC", text)
        if not self.byte_level:
            normal = normal.lower()
        if not normal.isascii() and _NOT_LATIN.search(normal):
            return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        return b"".join(self._pieces((_BYTE_PIECES if self.byte_level else _WORD_PIECES).findall(normal)))

    def _units(self, units: Collection[str]) -> dict[str, bytes]:
        """The ids of different units."""
        if not self.byte_level:
            return {u: self._ids(u) for u in units}
        # A blank stands before each and nowhere else, so all can be cut at once.
        text = " " + " ".join(units)
        if _BARE_UNIT.search(text) or not text.isascii() and _NOT_LATIN.search(text):
            return {u: self._ids(" " + u) for u in units}
        pieces = _BYTE_PIECES.findall(text)
        starts = [i for i, p in enumerate(pieces) if p[0] == " "]
        ids = self._pieces(pieces)
        return {u: ids[a] if b == a + 1 else b"".join(ids[a:b]) for u, (a, b) in zip(units, pairwise([*starts, len(pieces)]))}

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if self.added and self.added_start in text and self.added.search(text):
            return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        if self.byte_level:
            if _INNER_BLANK.search(text):
                return self._ids(text)
            # Every unit but the first has a blank before it.
            first, *units = text.split(" ")
            start = self._ids(first)
        else:
            units = _WORDS.findall(text) if _OTHER_SPLITS.search(text) else text.split()
            start = b""
        known = self.units
        ids = list(map(known.get, units))
        if None in ids:
            found = self._units({u for u, i in zip(units, ids) if i is None})
            if len(known) < CACHE_UNITS:
                known.update(found)
            ids = [found[u] if i is None else i for u, i in zip(units, ids)]
        return start + b"".join(ids)
