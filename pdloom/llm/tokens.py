"""Token ids of whole texts, with the ids of a word computed once per worker."""

from __future__ import annotations

import re
import sys
from array import array
from collections.abc import Sequence
from os.path import commonprefix

import numpy as np

#: Words a worker remembers before it starts anew; bounds its memory.
REMEMBERED = 800_000
#: A cut between words: before a space that something other than white space follows. Byte-level
#: BPE splits there in any case, so the parts have the same ids as the whole.
_CUT = re.compile(r" (?=\S)")
#: Parts of a text between which byte-level BPE always splits: letters, digits, marks (no apostrophe,
#: as that may start a contraction) and a single line end before a letter.
_PARTS = re.compile(
    r" ?[A-Za-zÀ-ÖØ-öø-ÿ]+| ?[.,!?*$%&#|:;()@=_/<>\[\]{}+\"\-]+| ?[0-9]+|\n(?=[A-Za-zÀ-ÖØ-öø-ÿ])"
)


def _byte_letters() -> list[str]:
    """The character that byte-level BPE writes for each byte: printable ones stand for
    themselves, the others follow from 256 on in order."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(others)) for b in range(256)]


class _PartIds(dict):
    """Packed ids of one part, which the library's model encodes without any further split."""

    def __init__(self, model, packed: list[bytes]) -> None:
        super().__init__()
        self.tokenize, self.packed, self.letters = model.tokenize, packed, _byte_letters()
        # Of the ASCII characters in parts, these two are not written as themselves.
        self.space, self.line_end = self.letters[32], self.letters[10]

    def __missing__(self, part: str) -> bytes:
        if part.isascii():
            text = part.replace(" ", self.space).replace("\n", self.line_end)
        else:
            text = "".join([self.letters[b] for b in part.encode()])
        packed = self.packed
        found = self[part] = b"".join([packed[t.id] for t in self.tokenize(text)])
        return found


class WordEncoder(dict):
    """Ids of texts by a byte-level BPE file of the tokenizers library, as packed unsigned ints.

    A text that parts make up is encoded by its parts. Other texts are cut into words; the
    dictionary maps a word (with its leading space) to its packed ids. A word not seen yet is split
    into parts where these make up all of it, else the library encodes it as a text.
    """

    def __init__(self, path: str) -> None:
        super().__init__()
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # A text that holds one of these is left to the library as a whole.
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.mark = commonprefix(self.added)
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        size, width = max(self.tokenizer.get_vocab().values(), default=-1) + 1, self.dtype.itemsize
        ids = self.pack(range(size))
        self.parts = _PartIds(
            self.tokenizer.model, [ids[i : i + width] for i in range(0, len(ids), width)]
        )

    def pack(self, ids: Sequence[int]) -> bytes:
        packed = array("H" if self.dtype.itemsize == 2 else "I", ids)
        if sys.byteorder == "big":
            packed.byteswap()
        return packed.tobytes()

    def __missing__(self, word: str) -> bytes:
        parts = _PARTS.findall(word)
        if "".join(parts) == word:
            found = b"".join(map(self.parts.__getitem__, parts))
        else:
            found = self.pack(self.tokenizer.encode(word, add_special_tokens=False).ids)
        self[word] = found
        return found

    def encode(self, text: str) -> bytes:
        """Packed ids of the text; none for an empty one."""
        if not text:
            return b""
        if len(self) > REMEMBERED:
            self.clear()
        if len(self.parts) > REMEMBERED:
            self.parts.clear()
        if self.added and self.mark in text and any(a in text for a in self.added):
            return self.pack(self.tokenizer.encode(text, add_special_tokens=False).ids)
        parts = _PARTS.findall(text)
        if "".join(parts) == text:
            return b"".join(map(self.parts.__getitem__, parts))
        return b"".join(map(self.__getitem__, _words(text)))


def _words(text: str) -> list[str]:
    """The text cut into words, each with the space before it."""
    if not ("  " in text or text[-1] == " " or _ODD.search(text)):
        # No space is followed by white space: every space is a cut.
        first, *rest = text.split(" ")
        return [first, *[" " + w for w in rest]]
    first, *rest = _CUT.split(text)
    return [first, *[" " + w for w in rest]]


#: A space before other white space.
_ODD = re.compile(r" [^\S ]")
