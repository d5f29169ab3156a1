"""Token ids of texts by a public tokenizer, each distinct word encoded once.

The tokenizer drops white space and splits texts into letters, single digits and other signs
before it merges, and no piece reaches across white space.  So a text's ids are its words' ids one
after the other, and a bounded store of words spares most of the work.  Before the look-up, A-Z are
lower-cased and signs behind a word are cut off, as the tokenizer does both: that leaves fewer words
to encode.  Words of common signs and Latin letters are cut into pieces here and merged by the
tokenizer's model; all others take its whole way.
"""

from __future__ import annotations

import os
import re
import struct
from collections.abc import Callable, Iterable

#: Signs that are one piece together; an apostrophe may join letters.
SIGNS = b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
#: Signs behind a letter or digit that end a word; they are one piece.
TAIL = re.compile(rb"[!-/:-@[-`{-~](?<=[A-Za-z0-9].)[!-/:-@[-`{-~]*(?=[ \t\n\r\x0b\f]|\Z)")
#: Lead bytes of U+0300 to U+037F: some of these marks join a letter to one that has another case form.
MARKS = (b"\xcc", b"\xcd")
#: Words that ``PIECE`` cuts once they are in lower case.
PLAIN = re.compile("[!-~À-ÖØ-öø-ÿ]+")
PIECE = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^0-9a-zß-öø-ÿ]+")


def byte_signs() -> dict[int, int]:
    """The sign by which a byte-level model names each byte: itself if it is seen, else one from 256 on."""
    seen = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in seen]
    return {b: 256 + i for i, b in enumerate(hidden)}


class Words(dict):
    """Ids by word.  A word that is not held is taken from the older words, else learnt, and held."""

    def __init__(self, learn: Callable[[bytes], bytes]):
        super().__init__()
        self.learn = learn
        self.older: dict[bytes, bytes] = {}

    def __missing__(self, word: bytes) -> bytes:
        found = self.older.get(word)
        if found is None:
            found = self.learn(word)
        self[word] = found
        return found


class WordTokens:
    """``ids(texts)`` gives the token ids of each text as little-endian unsigned 16-bit bytes.

    Two generations of up to about ``stored`` words are kept; a word of the older one that comes
    again moves to the newer, so frequent words stay when rare ones are dropped.
    """

    def __init__(self, path: str, stored: int = 400_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        if max(self.tokenizer.get_vocab().values()) >= 65_536:
            raise ValueError("ids must fit 16 bits")
        #: Tokens that the tokenizer takes out of a text before anything else.
        self.marked = [t.content.lower().encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.signs = byte_signs()
        self.stored = stored
        self.words = Words(self._learn)

    def _packed(self, ids: list[int]) -> bytes:
        return struct.pack(f"<{len(ids)}H", *ids)

    def _single(self, word: str) -> bytes:
        return self._packed(self.tokenizer.encode(word, add_special_tokens=False).ids)

    def _merged(self, piece: str) -> bytes:
        if not piece.isascii():
            piece = piece.encode().decode("latin-1").translate(self.signs)
        return self._packed([t.id for t in self.model.tokenize(piece)])

    def _has_marked(self, lower: bytes) -> bool:
        return any(m in lower for m in self.marked)

    def _learn(self, word: bytes) -> bytes:
        if word.isalpha():  # of bytes: A-Z and a-z only
            return self._merged(word.lower().decode())
        text = word.decode()
        if PLAIN.fullmatch(text) and not self._has_marked(word.lower()):
            return b"".join(map(self._merged, PIECE.findall(text.lower())))
        return self._single(text)

    def _split(self, text: str) -> list[bytes]:
        raw = text.encode()
        lower = raw.lower()
        if self._has_marked(lower):
            return raw.split()
        return TAIL.sub(rb" \g<0>", raw if any(m in raw for m in MARKS) else lower).split()

    def ids(self, texts: Iterable[str]) -> list[bytes]:
        words, found = self.words, []
        for text in texts:
            if len(words) > self.stored:
                words.older = dict(words)
                words.clear()
            found.append(b"".join(map(words.__getitem__, self._split(text))))
        return found
