"""Token ids of whole texts with the public tokenizers, each distinct word encoded once per worker.

Both vocabularies cut a text into words before they merge, and no piece reaches across the start of a run
of white space, so a text's ids are its words' ids one after the other. Texts with rarer kinds of white
space, for which that may not hold, are encoded whole, and so are texts that may quote a special token,
which gets its one id as in the library's own call.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterable

import numpy as np

#: White space other than the six ASCII characters at which words are cut.
OTHER_SPACE = re.compile("[\\x1c-\\x1f\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]")
#: Words with the white space before them, for vocabularies that keep it; and white space at the end.
SPACED_WORD = re.compile(r"[ \t\n\r\f\v]*[^ \t\n\r\f\v]+|[ \t\n\r\f\v]+")
#: A text without any of these has single spaces and line ends only, and may be cut before each of them.
NOT_SINGLE = ("  ", "\n\n", " \n", "\n ", "\t", "\r", "\f", "\v", "\0")
#: Letters then punctuation: two pieces to either vocabulary, whatever stands around them (ASCII and Latin-1, no apostrophe).
PLAIN = re.compile(r"([ \n]?)([A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff]+)([!-&(-/:-@\[-`{-~]*)")
#: Distinct words and pieces that a worker remembers, each no longer than LONG.
REMEMBERED, LONG = 600_000, 64


def spaced_words(text: str) -> list[str]:
    if any(x in text for x in NOT_SINGLE) or text[-1] in " \n":
        return SPACED_WORD.findall(text)
    return [w for w in text.replace(" ", "\0 ").replace("\n", "\0\n").split("\0") if w]


class TokenIds(dict):
    """Little-endian unsigned ids of words, encoded when they are first met."""

    _kept: dict[str, TokenIds] = {}

    def __init__(self, path: str, spaced: bool):
        from tokenizers import Tokenizer, pre_tokenizers

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.spaced = spaced
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(map(re.escape, special)), re.I) if special else None
        # what all of them begin with, as far as it has no letters: most texts have none of it
        self.mark = re.match(r"[^\w\s]*", os.path.commonprefix(special))[0]
        self.kind = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.pieces: dict[str, bytes] = {}
        by_bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.as_bytes = {c: by_bytes.pre_tokenize_str(chr(c))[0][0] for c in [10, *range(32, 127), *range(0xC0, 0x100)]}

    @classmethod
    def of(cls, path: str, spaced: bool) -> TokenIds:
        """One per worker process and file."""
        if path not in cls._kept:
            cls._kept[path] = cls(path, spaced)
        return cls._kept[path]

    def _piece(self, piece: str) -> bytes:
        """Ids of what the vocabulary doesn't cut any further before merging."""
        ids = self.pieces.get(piece)
        if ids is None:
            ids = np.array([t.id for t in self.tokenizer.model.tokenize(piece.translate(self.as_bytes))], self.kind).tobytes()
            if len(self.pieces) > REMEMBERED:
                self.pieces.clear()
            if len(piece) <= LONG:
                self.pieces[piece] = ids
        return ids

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.kind).tobytes()

    def __missing__(self, word: str) -> bytes:
        m = PLAIN.fullmatch(word)
        if not m:
            ids = self._whole(word)
        elif not self.spaced:
            ids = self._piece(m[2].lower()) + (self._piece(m[3]) if m[3] else b"")
        else:
            ids = (self._piece("\n") + self._piece(m[2]) if m[1] == "\n" else self._piece(m[1] + m[2])) + (self._piece(m[3]) if m[3] else b"")
        if len(word) <= LONG:
            self[word] = ids
        return ids

    def _may_quote(self, text: str) -> bool:
        return self.special is not None and self.mark in text and self.special.search(text) is not None

    def encode(self, texts: Iterable[str | None]) -> list[np.ndarray]:
        """The ids of each text as an array of ``kind``."""
        if len(self) > REMEMBERED:
            self.clear()
        out = []
        for t in texts:
            if not t:
                ids = b""
            elif self._may_quote(t) or OTHER_SPACE.search(t):
                ids = self._whole(t)
            else:
                ids = b"".join(map(self.__getitem__, spaced_words(t) if self.spaced else t.split()))
            out.append(np.frombuffer(ids, self.kind))
        return out
