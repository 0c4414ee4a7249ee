"""Exact, cached word-level encoding with a public BPE vocabulary.

The tokenizer drops white space and its merges never cross a word, so a word
always gives the same ids, and so does a chunk between blanks. A text of plain
Latin letters is cut into words at once; in other texts the chunks that are
plain are. Words and chunks are looked up in a bounded cache; everything else
goes through the tokenizer itself, and so does every text where the vocabulary
file has another normalizer or word pattern."""

from __future__ import annotations

import json
import re

import numpy as np
import regex
from tokenizers import Tokenizer

# Fixed value: the word pattern of the vocabulary file.
_WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
#: Chunks on which lower-casing is per letter and composition changes nothing.
_PLAIN = re.compile("[!-~\u00a1-\u00ac\u00ae-\u012f\u0131-\u024f]+")
_PLAIN_TEXT = re.compile("[\n -~\u00a1-\u00ac\u00ae-\u012f\u0131-\u024f]+")
#: Entries of each of the two generations of the cache.
_MOST = 250_000


def _plain_words() -> re.Pattern:
    """The word pattern with its classes spelt out for plain text."""
    plain = [chr(c) for c in range(0x20, 0x250) if _PLAIN.fullmatch(chr(c))]
    letters = re.escape("".join(c for c in plain if regex.fullmatch(r"\p{L}", c)))
    digits = re.escape("".join(c for c in plain if regex.fullmatch(r"\p{N}", c)))
    return re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{letters}]+|[{digits}]|[^\s{letters}{digits}]+")


_PLAIN_WORDS = _plain_words()


# The form of the vocabulary files that this module repeats.
_NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
_CUT = {"type": "Split", "pattern": {"Regex": _WORDS.pattern}, "behavior": "Removed", "invert": True}
_BYTES = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": False}


def known_form(tok: Tokenizer) -> bool:
    """Whether the file normalizes, cuts and maps bytes as this module does."""
    form = json.loads(tok.to_str())
    norm, pre = (form.get(k) or {} for k in ("normalizer", "pre_tokenizer"))
    cut = pre.get("pretokenizers") or [{}, {}]
    return (norm.get("normalizers") == _NORMALIZERS and len(cut) == 2 and cut[0] == _CUT
            and _BYTES.items() <= cut[1].items() and form["model"]["type"] == "BPE" and not form["model"].get("dropout"))


def _byte_letters() -> dict[int, str]:
    """The printable stand-in of each byte in a byte-level vocabulary: bytes that
    print stay, the others follow from code point 256 on."""
    stay = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(stay)]
    return {b: chr(b) for b in stay} | {b: chr(256 + i) for i, b in enumerate(rest)}


class WordEncoder:
    """``encode(text)`` gives the ids as little-endian ``<u2`` or ``<u4`` bytes."""

    def __init__(self, path: str):
        self.tok = Tokenizer.from_file(path)
        top = max(self.tok.get_vocab().values())
        self.dtype = "<u2" if top < 1 << 16 else "<u4"
        self.size = np.dtype(self.dtype).itemsize
        self.special = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self.letters = _byte_letters()
        self.model = self.tok.model
        self.known = known_form(self.tok)
        # of words and of chunks; the older generation keeps what is looked up again
        self.ids: dict[str, bytes] = {"": b""}
        self.older: dict[str, bytes] = {}

    def _raw(self, text: str) -> bytes:
        return np.array(self.tok.encode(text, add_special_tokens=False).ids, dtype=self.dtype).tobytes()

    def _word(self, word: str) -> bytes:
        """Ids of one match of the word pattern."""
        known = self.ids.get(word)
        if known is None:
            known = self.older.get(word)
        if known is None:
            mapped = word if word.isascii() else "".join(map(self.letters.__getitem__, word.encode()))
            known = b"".join([t.id.to_bytes(self.size, "little") for t in self.model.tokenize(mapped)])
        self.ids[word] = known
        return known

    def _learn(self, chunk: str) -> bytes:
        """Ids of a chunk without blanks and line ends."""
        out = self.older.get(chunk)
        if out is not None:
            pass
        elif not _PLAIN.fullmatch(chunk):
            out = self._raw(chunk)
        elif chunk.isalpha():
            return self._word(chunk.lower())
        else:
            out = b"".join(map(self._word, _WORDS.findall(chunk.lower())))
        self.ids[chunk] = out
        return out

    def encode(self, text: str) -> bytes:
        if not self.known or any(s in text for s in self.special):
            return self._raw(text)
        if len(self.ids) > _MOST:
            self.older, self.ids = self.ids, {"": b""}
        if _PLAIN_TEXT.fullmatch(text):
            words = _PLAIN_WORDS.findall(text.lower())
            got = list(map(self.ids.get, words))
            if None in got:
                word = self._word
                got = [word(w) if g is None else g for w, g in zip(words, got)]
            return b"".join(got)
        parts = text.replace("\n", " ").split(" ")
        got = list(map(self.ids.get, parts))
        if None in got:
            learn = self._learn
            got = [learn(p) if g is None else g for p, g in zip(parts, got)]
        return b"".join(got)


_OPEN: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """One encoder per worker process and vocabulary."""
    if path not in _OPEN:
        _OPEN[path] = WordEncoder(path)
    return _OPEN[path]
