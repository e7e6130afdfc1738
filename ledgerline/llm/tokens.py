"""Token ids of texts, as bytes of little-endian unsigned 32-bit integers.

The ``tokenizers`` library encodes every distinct word once; a text's ids are then joined
from a bounded cache. The texts are only cut where the library's own pre-tokenizer cuts, so
the result equals ``Tokenizer.encode(text, add_special_tokens=False).ids``. Texts for which
that is not certain go to the library whole.
"""

from __future__ import annotations

import os
import re
from array import array

import numpy as np

#: Words kept per Python worker; about 250 bytes each.
CACHE_WORDS = 700_000
#: Longer words are encoded without being kept.
KEPT_CHARS = 40

#: Letters below U+0100 that neither the splitter nor the normaliser changes (lower case first).
_LETTERS = re.compile("[A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff]+")
#: Byte-level vocabularies write a byte that has no visible character as U+0100 and on.
_HIDDEN = [*range(33), *range(127, 161), 173]
_BYTE_CHARS = {b: chr(256 + i) for i, b in enumerate(_HIDDEN)}
_CONTROLS = re.compile(rb"[\x1c-\x1f]")
#: A space that is not followed by a visible Latin character is no certain cut.
_UNSAFE_SPACE = re.compile(r" (?![!-~\xa1-ɏ])")


class Encoder:
    """A tokenizer file with its word cache; one per worker and file."""

    _made: dict[str, Encoder] = {}

    def __init__(self, file: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(file)
        self.words: dict[str, bytes] = {}
        #: byte-level files keep white space (it belongs to the next word); others drop it
        self.keeps_space = bool(self.plain(" a") != self.plain("a"))
        self.specials = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.mark, self.mark_id = self._separator()
        self.ends: dict[str, bytes] = {"": b""}
        probes = ["hello", "gr\xf6\xdfe", "na\xefve", "ththinger", "\xe9\xe9\xe7\xea", "Zm\xc0\xff"]
        before = " " * self.keeps_space
        self.direct = all(self._core(p if self.keeps_space else p.lower()) == self.plain(before + p) for p in probes)

    @classmethod
    def of(cls, file: str) -> Encoder:
        if file not in cls._made:
            cls._made[file] = cls(file)
        return cls._made[file]

    def plain(self, text: str) -> bytes:
        """Ids by the library alone."""
        return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _separator(self) -> tuple[str, int]:
        """A string between two words of a joint call that becomes one id of its own."""
        if self.keeps_space:
            return "\n", self.library.encode("\n", add_special_tokens=False).ids[0]
        for c in "\xa7\xb6\xa4\xac|~":
            ids = self.library.encode(c, add_special_tokens=False).ids
            if len(ids) == 1:
                return f" {c} ", ids[0]
        raise ValueError("the tokenizer has no single-id separator")

    def _core(self, core: str) -> bytes:
        """Ids of one word of Latin letters, by the model without normaliser and splitter."""
        text = core if core.isascii() else core.encode().decode("latin-1").translate(_BYTE_CHARS)
        if self.keeps_space:
            text = _BYTE_CHARS[32] + text
        return array("I", [t.id for t in self.library.model.tokenize(text)]).tobytes()

    def _word(self, word: str) -> bytes | None:
        """Ids of letters with an optional mark at the end; None: another kind of word."""
        core = word.rstrip(",.!?")
        if not _LETTERS.fullmatch(core):
            return None
        if not self.keeps_space:
            core = core.lower()  # what the file's normaliser does to these letters
        end = word[len(core) :]
        if end not in self.ends:
            self.ends[end] = self.plain(end)
        ids = self.words.get(core) if end else None
        if ids is None:
            ids = self._core(core)
            if end and len(core) <= KEPT_CHARS:
                self.words[core] = ids
        return ids + self.ends[end]

    def _learn(self, words: list[str]) -> dict[str, bytes]:
        """Ids of words that are not in the cache, many in one call of the library."""
        got: dict[str, bytes] = {}
        sign = self.mark.strip(" ")
        joint = []
        for w in words:
            if w.startswith(" " * self.keeps_space) and sign not in w and w.strip():
                joint.append(w)
            else:
                got[w] = self.plain(w)
        for k in range(0, len(joint), 2000):
            part = joint[k : k + 2000]
            ids = np.array(self.library.encode_batch_fast([self.mark.join(part)], add_special_tokens=False)[0].ids, "<u4")
            cuts = np.flatnonzero(ids == self.mark_id)
            if len(cuts) != len(part) - 1:  # a word holds the separator's id itself
                got.update((w, self.plain(w)) for w in part)
                continue
            at = [0, *(cuts + 1).tolist()]
            to = [*cuts.tolist(), len(ids)]
            raw = ids.tobytes()
            got.update((w, raw[4 * a : 4 * b]) for w, a, b in zip(part, at, to, strict=True))
        return got

    def _pieces(self, text: str) -> list[str] | None:
        """Words between which the library certainly cuts; None: not certain."""
        try:
            raw = text.encode("latin-1")
        except UnicodeEncodeError:
            raw = None
        if any(s in text for s in self.specials):
            return None
        if self.keeps_space:
            if _UNSAFE_SPACE.search(text):
                return None
            return text.split(" ")
        if raw is not None:
            return None if _CONTROLS.search(raw) else text.lower().split()
        return None if _UNSAFE_SPACE.search(text) else text.split(" ")

    def encode(self, text: str | None) -> bytes:
        """Ids of a whole text; null counts as empty."""
        if not text:
            return b""
        pieces = self._pieces(text)
        if pieces is None:
            return self.plain(text)
        if not self.keeps_space:
            return self._joined(pieces)
        first, rest = pieces[0], pieces[1:]
        return (self.plain(first) if first else b"") + self._joined(rest, " ")

    def _joined(self, pieces: list[str], before: str = "") -> bytes:
        words = self.words
        got = list(map(words.get, pieces))
        if None in got:
            missing = dict.fromkeys(p for p, g in zip(pieces, got, strict=True) if g is None)
            new = {p: self._word(p) if self.direct else None for p in missing}
            other = [p for p, ids in new.items() if ids is None]
            if other:
                learnt = self._learn([before + p for p in other])
                new.update((p, learnt[before + p]) for p in other)
            if len(words) + len(new) > CACHE_WORDS:
                words.clear()
            words.update((p, ids) for p, ids in new.items() if len(p) <= KEPT_CHARS)
            got = [new[p] if g is None else g for p, g in zip(pieces, got, strict=True)]
        return b"".join(got)
