"""Tokenising whole texts inside tasks.

The library encodes each distinct *unit* of a text once and a bounded memo
keeps its ids. A unit is a run of spaces and newlines with the run of other
characters after it, or with a run of letters that ends before a space or a
punctuation mark (but no apostrophe). Public BPE pre-tokenizers never join
characters across such a boundary, so the ids of the units, in order, are the
ids of the text. Texts with any other white space (where a white-space run
could straddle a boundary) are encoded whole, and so are texts that may hold
the string of an added token: it gets the token's id, as the tokenizer file
says, unless ``special_as_text`` asks for ordinary ids. Where the tokenizer itself
lower-cases and drops white space, Latin-1 texts are folded beforehand, so
that more units are alike.
"""

from __future__ import annotations

import os
import re
import sys
from array import array

_AFTER = r"(?=[ \n,.|!?;:#*$%&\"()<>=+@/-])"
_UNIT = re.compile(r"[ \n]*[A-Za-zÀ-ÖØ-öø-ÿ]+" + _AFTER + r"|[ \n]*[^ \n]+|[ \n]+")
#: The same without the space before a unit, for tokenizers that drop it.
_BARE_UNIT = re.compile(r"[A-Za-zÀ-ÖØ-öø-ÿ]+" + _AFTER + r"|[^ \n]+")
#: White space besides the space and the newline.
_ASCII_SPACES = "\t\r\x0b\x0c\x1c\x1d\x1e\x1f"
_WIDE_SPACES = ("\x85\xa0            "
                "    　")
#: Units remembered per worker, about 200 bytes each: memory against CPU.
MEMO_UNITS = 1_000_000


def _plain(text: str) -> bool:
    return not any(c in text for c in _ASCII_SPACES) and (text.isascii() or not any(c in text for c in _WIDE_SPACES))


class TextEncoder:
    """ids of texts as bytes, ``width`` bytes little-endian an id. With
    ``special_as_text`` the strings of special tokens are ordinary text."""

    def __init__(self, path: str, width: int = 4, memo_units: int = MEMO_UNITS, special_as_text: bool = True):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self._tok = Tokenizer.from_file(path)
        self._tok.encode_special_tokens = special_as_text
        added = [] if special_as_text else [t.content for t in self._tok.get_added_tokens_decoder().values()]
        # the longest part of each that no folding of letters changes
        self._marks = {max(re.split(r"[^\W_]+", c), key=len) for c in added}
        self._width, self._memo_units = width, memo_units
        self._memo: dict[str, bytes] = {}
        one, *same = self._encode(["word été", "Word ÉTÉ", " WORD\n\n  ÉTÉ \n"])
        self._folds = all(x == one for x in same) and self._encode([" \n"]) == [b""]

    def _encode(self, texts: list[str]) -> list[bytes]:
        code = {2: "H", 4: "I"}[self._width]
        out = [array(code, e.ids) for e in self._tok.encode_batch_fast(texts, add_special_tokens=False)]
        if sys.byteorder == "big":
            for a in out:
                a.byteswap()
        return [a.tobytes() for a in out]

    def _units(self, text: str) -> list[str] | None:
        if not _plain(text) or any(m in text for m in self._marks):
            return None
        if self._folds:
            try:
                text.encode("latin-1")      # lower() is per character there
                return _BARE_UNIT.findall(text.lower())
            except UnicodeEncodeError:
                pass
        return _UNIT.findall(text)

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text. Units not in the memo are encoded in one call
        and stay in it while it has room."""
        memo = self._memo
        units = [self._units(t) for t in texts]
        new = list(set().union(*(us for us in units if us)).difference(memo))
        memo.update(zip(new, self._encode(new)))
        whole = iter(self._encode([t for t, us in zip(texts, units) if us is None]))
        ids = memo.__getitem__
        out = [next(whole) if us is None else b"".join(map(ids, us)) for us in units]
        for u in new[max(0, self._memo_units - (len(memo) - len(new))):]:
            del memo[u]
        return out


_ENCODERS: dict[tuple, TextEncoder] = {}


def encoder(path: str, width: int = 4, memo_units: int = MEMO_UNITS, special_as_text: bool = False) -> TextEncoder:
    """The encoder of this worker process (workers are reused by tasks)."""
    key = (path, width, memo_units, special_as_text)
    if key not in _ENCODERS:
        _ENCODERS[key] = TextEncoder(path, width, memo_units, special_as_text)
    return _ENCODERS[key]
