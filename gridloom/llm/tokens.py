"""Access to public tokenizers from Python workers: token ids of whole texts.

A byte-level BPE splits a text into words by a fixed pattern and merges within each word, so the
ids of a text are those of its words in order. Words repeat a great deal: each worker keeps the
ids of the words it met and asks the library's model only for new ones.
"""

import re
import unicodedata
from array import array

import numpy as np

#: Below this code point the character classes of a pattern are the same in every library, and are
#: written out for the standard one, which is faster; texts with any other character are not split so.
NARROW = 0x250
_OTHER = re.compile(f"[^\x00-{chr(NARROW - 1)}]")
#: Words kept by a worker, give or take those of one text; beyond, it begins anew.
CACHE = 750_000
#: Texts whose ids by words must equal the library's before words are used.
_SAMPLES = ["It's a test,  of 3 words\n\n and we'll see: \t\"ÀÉîõü ßçñ\" \xa0x\x85y\x1fz 12345 a--b \x00\x7f", " leading and trailing  ", "\n", "don't DON'T 'em 's"]


def _class(inside) -> str:
    """The characters below NARROW for which inside holds, as ranges of a character class."""
    hit, out = [c for c in range(NARROW) if inside(chr(c))], []
    for c in hit:
        if out and out[-1][1] == c - 1:
            out[-1][1] = c
        else:
            out.append([c, c])
    return "".join(f"\\u{a:04x}-\\u{b:04x}" for a, b in out)


def narrow(pattern: str):
    """findall of pattern for texts below NARROW; its classes are those of Unicode letters, numbers and white space."""
    classes = {
        r"\p{L}": _class(lambda c: unicodedata.category(c)[0] == "L"),
        r"\p{N}": _class(lambda c: unicodedata.category(c)[0] == "N"),
        r"\s": _class(lambda c: c.isspace() and not "\x1c" <= c <= "\x1f"),
    }
    out, bracket = [], False
    for part in re.findall(r"\\p\{\w+\}|\\.|.", pattern, re.S):
        bracket = part == "[" or bracket and part != "]"
        if part == r"\S":
            part = "[^" + classes[r"\s"] + "]"
        elif part in classes:
            part = classes[part] if bracket else f"[{classes[part]}]"
        out.append(part)
    return re.compile("".join(out)).findall


def is_narrow(text: str) -> bool:
    return not _OTHER.search(text)


def byte_letters() -> dict[int, str]:
    """The letter that byte-level vocabularies write for each byte: its own character where that is
    printable, else one from U+0100 on, in order."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {**{b: chr(b) for b in shown}, **{b: chr(256 + k) for k, b in enumerate(hidden)}}


class WordCache(dict):
    """word -> bytes of its ids, in bounded memory; encode(word) gives those of a new one."""

    def __init__(self, encode, size: int = CACHE):
        super().__init__()
        self.encode, self.size = encode, size

    def __missing__(self, word: str) -> bytes:
        found = self[word] = self.encode(word)
        return found

    def ids(self, words: list[str]) -> bytes:
        """The ids of a text's words, as bytes."""
        if len(self) > self.size:
            self.clear()
        return b"".join(map(self.__getitem__, words))


class Encoder:
    """ids of whole texts by a file of the tokenizers library; none are added, but the content of an
    added token in a text is that token, as in the library's plain call.

    Texts with such content, or with characters from NARROW on, go to the library whole. Others are
    split here and their words go one by one to the library's byte-level BPE model, past the steps
    before and after it: it is asked whether the file has other steps than that split, and if so
    every text goes whole.
    """

    _loaded: dict[str, "Encoder"] = {}

    def __init__(self, path: str, pattern: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.split = narrow(pattern)
        self.added = [x.content for x in self.library.get_added_tokens_decoder().values()]
        self.model, self.letters = self.library.model, byte_letters()
        self.dtype = np.dtype("<u2") if self.library.get_vocab_size() <= 1 << 16 else np.dtype("<u4")
        self.code = "H" if self.dtype.itemsize == 2 else "I"
        self.cache = WordCache(self._new)
        self.plain = self.library.normalizer is None and all(b"".join(map(self._new, self.split(t))) == self.whole(t).tobytes() for t in _SAMPLES)

    @classmethod
    def of(cls, path: str, pattern: str) -> "Encoder":
        """One encoder a worker process and file."""
        if path not in cls._loaded:
            import os

            os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
            cls._loaded[path] = cls(path, pattern)
        return cls._loaded[path]

    def forget(self, beyond: int = 0) -> None:
        """Drop the words met so far if there are more than that many: workers live on."""
        if len(self.cache) > beyond:
            self.cache.clear()

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, np.uint32).astype(self.dtype)

    def encode(self, texts: list) -> list[np.ndarray]:
        """The ids of each text; null is empty."""
        return [self._one(t) if t else np.zeros(0, self.dtype) for t in texts]

    def _one(self, text: str) -> np.ndarray:
        if not self.plain or not is_narrow(text) or any(x in text for x in self.added):
            return self.whole(text)
        return np.frombuffer(self.cache.ids(self.split(text)), self.dtype)

    def _new(self, word: str) -> bytes:
        """The model works on a letter for each byte."""
        return array(self.code, [x.id for x in self.model.tokenize(word.encode().decode("latin-1").translate(self.letters))]).tobytes()
