"""Token ids of whole texts with the tokenizers library.

A text is cut only where the tokenizer's own pre-tokenizer always cuts, and every distinct piece is encoded
once per worker. ``cut`` names those places: ``space`` for byte-level vocabularies whose words carry a
leading space, ``word`` for vocabularies that drop white space, ``None`` to encode whole texts at once.
Texts with other white space than the cut allows, or with the string of an added token, are encoded whole, so
the ids are always the library's own.

Most pieces are a word of Latin letters, some with punctuation behind. The pre-tokenizer keeps such a word in
one and the punctuation in another, so the library's model is asked for both without the way through the
pre-tokenizer; all other pieces take that way, many at once.
"""

from __future__ import annotations

import os
import sys
from array import array

import numpy as np

from .worker_cache import held

#: Distinct pieces a worker remembers. From half of that on, a piece must be seen twice to be remembered; others
#: are encoded for their batch and forgotten.
REMEMBERED = 600_000
#: Slots for pieces seen once.
SEEN = 1 << 22
#: White space at which only the tokenizer itself can cut, and controls that libraries class differently.
ODD_SPACE = frozenset("\t\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000"
                      + "".join(map(chr, range(0x2000, 0x200B))))
ODD_CONTROL = frozenset("\x1c\x1d\x1e\x1f")
#: Letters up to here are letters for every library, have one lower case (but the dotted I) and no other composition.
LATIN, DOTTED = "\u024f", "\u0130"
MARKS = ".,;:!?"


def byte_letters() -> dict[int, str]:
    """The letter that byte-level vocabularies write for each byte: its own if it shows, else one from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


def tokenizer_path(name: str) -> str:
    """A path as it is, a bare file name from the installed public vocabularies."""
    if os.sep in name:
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


class _Index(dict):
    """Piece to its place in the table; a new piece gets the next place and waits to be encoded."""

    def __init__(self):
        super().__init__()
        self.waiting: list[str] = []
        self.size = 0

    def __missing__(self, piece: str) -> int:
        place = self[piece] = self.size
        self.size += 1
        self.waiting.append(piece)
        return place


class Encoder:
    """``encode(texts)`` gives the ids of each text as little-endian bytes of ``dtype``."""

    def __init__(self, name: str, cut: str | None):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(tokenizer_path(name))
        self.model = self.tokenizer.model
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.code = "H" if self.dtype.itemsize == 2 else "I"
        # Added tokens are found in normalised text too: any spelling of one counts.
        self.added = [t.content.lower() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.cut = cut
        self.index = _Index()
        self.table: list[bytes] = []
        self.once = bytearray(SEEN)
        self.letters = byte_letters()
        self.tails: dict[str, bytes] = {"": b""}
        if cut:
            self.mark = "\n" if cut == "space" else "|"
            (self.mark_id,) = self.tokenizer.encode(self.mark, add_special_tokens=False).ids
            self.line = self.from_model(self.letters[10])

    def from_model(self, word: str) -> bytes:
        """Ids of one word in the vocabulary's own letters."""
        ids = array(self.code, [t.id for t in self.model.tokenize(word)])
        return ids.tobytes() if sys.byteorder == "little" else np.array(ids, self.dtype).tobytes()

    def whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, self.dtype).tobytes()
                for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _has_added(self, text: str) -> bool:
        return any(t in text for t in self.added) or not text.islower() and any(t in text.lower() for t in self.added)

    def pieces(self, text: str) -> list[str] | None:
        if not self.cut or self._has_added(text):
            return None
        if self.cut == "word":
            return None if not ODD_CONTROL.isdisjoint(text) else text.split()
        if not ODD_SPACE.isdisjoint(text):
            return None
        # A line's first word keeps the line break before it; the text's first word gets one, cut off later.
        found = ("\n" + text).replace("\n", " \n").split(" ")[1:]
        return None if "" in found or "\n" in found else found

    def plain(self, piece: str) -> bytes | None:
        """Ids of a Latin word with punctuation behind it, None for any other piece."""
        head, lead = b"", ""
        if self.cut == "space":
            if piece[0] == "\n":
                piece, head = piece[1:], self.line
            else:
                lead = self.letters[32]
        word = piece.rstrip(MARKS)
        if not word.isalpha() or not word.isascii() and (max(word) > LATIN or DOTTED in word):
            return None
        tail = piece[len(word):]
        if tail not in self.tails:
            self.tails[tail] = self.from_model(tail)
        if self.cut == "word":
            word = word.lower()
        if not word.isascii():
            word = word.encode().decode("latin-1").translate(self.letters)
        return head + self.from_model(lead + word) + self.tails[tail]

    def _learn(self) -> None:
        """Ids of the waiting pieces: words from the model, the rest in one text between marks that are tokens."""
        made = [self.plain(p) for p in self.index.waiting]
        places = [i for i, ids in enumerate(made) if ids is None]
        for at in range(0, len(places), 20_000):
            own = places[at:at + 20_000]
            some = [self.index.waiting[i] for i in own]
            if self.cut == "space":
                text = "".join(p if p[0] == "\n" else "\n " + p for p in some)
            else:
                text = "".join("| " + (p if "|" not in p else "") + " " for p in some)
            ids = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.dtype)
            starts = np.flatnonzero(ids == self.mark_id)
            if len(starts) != len(some):
                raise ValueError("the tokenizer does not cut where it was said to")
            ends = [*starts[1:].tolist(), len(ids)]
            data, width = ids.tobytes(), self.dtype.itemsize
            for i, piece, start, end in zip(own, some, starts.tolist(), ends):
                if self.cut == "word" and "|" in piece:
                    made[i] = self.whole([piece])[0]
                else:
                    skip = 0 if self.cut == "space" and piece[0] == "\n" else 1
                    made[i] = data[(start + skip) * width:end * width]
        self.table += made

    def _forget(self, known: int) -> None:
        """Keep of this batch's new pieces what there is room for."""
        if len(self.table) > REMEMBERED // 2:
            kept = known
            for place, piece in enumerate(self.index.waiting, known):
                slot = hash(piece) % SEEN
                if self.once[slot] and kept < REMEMBERED:
                    self.index[piece] = kept
                    self.table[kept] = self.table[place]
                    kept += 1
                else:
                    self.once[slot] = 1
                    del self.index[piece]
            del self.table[kept:]
            self.index.size = kept
        self.index.waiting = []

    def encode(self, texts: list[str]) -> list[bytes]:
        known = len(self.table)
        places = []
        for text in texts:
            pieces = self.pieces(text) if text else []
            places.append(None if pieces is None else list(map(self.index.__getitem__, pieces)))
        self._learn()
        table, out = self.table, []
        first = self.dtype.itemsize if self.cut == "space" else 0
        for text, own in zip(texts, places):
            if own is None:
                out.append(self.whole([text])[0])
            else:
                out.append(b"".join([table[i] for i in own])[first:])
        self._forget(known)
        return out


def encoder(name: str, cut: str | None) -> Encoder:
    """One encoder per worker process, kept between tasks."""
    return held(("encoder", name, cut), lambda: Encoder(name, cut))
