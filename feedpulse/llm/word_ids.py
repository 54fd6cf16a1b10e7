"""Token ids of whole texts by the tokenizers library, word by word.

The vocabulary file lower-cases, drops white space, and merges neither across white
space nor between letters, single digits and signs, so the ids of a text are those
of such words in a row. Words repeat: a worker keeps the ids of those it has met,
and the library encodes the others.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterable, Iterator

import numpy as np

#: Any character but Western letters, ASCII digits, ASCII signs and ASCII white space;
#: the apostrophe counts as other, as it begins endings like 's.
ODD = re.compile("[^ \t-\r!-&(-~À-ÖØ-öø-ÿ]")
#: Between white space, what holds such a character.
OTHER = re.compile("((?<!\\S)[!-&(-~À-ÖØ-öø-ÿ]*+[^\\s!-&(-~À-ÖØ-öø-ÿ]\\S*)")
#: Texts that only the library may split: separators that Python alone takes for
#: white space, those on which versions differ, and the special tokens by name.
WHOLE = re.compile("[\x1c-\x1f\x85\u180e]|<\\|(?:start|end)oftext\\|>")
#: Words of all else, in lower case.
PLAIN = re.compile("[a-zß-öø-ÿ]+|[!-&(-/:-@\\[-`{-~]+|[0-9]")
END = "</w>"
#: Characters of a word that is kept; texts without spaces are one long word.
REMEMBERED = 32


class WordIds:
    """Little-endian unsigned 32-bit ids of texts, as bytes.

    ``limit`` bounds the words kept, of ``REMEMBERED`` characters at most; beyond it the
    memory is emptied, which costs time and changes no result.
    """

    def __init__(self, path: str, limit: int = 800_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a worker for each core
        from tokenizers import Tokenizer, pre_tokenizers

        self.library = Tokenizer.from_file(path)
        # The same model on words that need no clean-up any more.
        self.bare = Tokenizer(self.library.model)
        self.bare.pre_tokenizer = pre_tokenizers.Sequence(
            [
                pre_tokenizers.WhitespaceSplit(),
                pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False),
            ]
        )
        vocabulary = self.library.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith(END)]] = True
        self.limit = limit
        self.words: dict[str, bytes] = {}

    def encode(self, texts: Iterable[str]) -> list[bytes]:
        return [b for some in slices(texts) for b in self._encode(some)]

    def _encode(self, texts: list[str]) -> list[bytes]:
        if len(self.words) > self.limit:
            self.words.clear()
        known, split, others = self.words, [], []
        for text in texts:
            if not ODD.search(text) and "<|" not in text:
                split.append(PLAIN.findall(text.lower()))
                continue
            if WHOLE.search(text):
                split.append(None)
                continue
            parts = OTHER.split(text)
            words = PLAIN.findall(parts[0].lower())
            for other, plain in zip(parts[1::2], parts[2::2]):
                if other not in known:
                    known[other] = self._whole(other)
                    others.append(other)
                words.append(other)
                words += PLAIN.findall(plain.lower())
            split.append(words)
        new = set().union(*[set(ws).difference(known) for ws in split if ws])
        if new:
            self._learn(list(new))
        encoded = [
            self._whole(text) if ws is None else b"".join(map(known.__getitem__, ws))
            for text, ws in zip(texts, split)
        ]
        for word in [w for w in (*others, *new) if len(w) > REMEMBERED]:
            known.pop(word, None)
        return encoded

    def _whole(self, text: str) -> bytes:
        encoded = self.library.encode_batch_fast([text], add_special_tokens=False)
        return np.array(encoded[0].ids, "<u4").tobytes()

    def _learn(self, words: list[str]) -> None:
        ids = np.array(
            self.bare.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids, "<u4"
        )
        stops = ((np.flatnonzero(self.ends[ids]) + 1) * 4).tolist()
        if len(stops) != len(words):
            raise ValueError("the vocabulary does not mark the ends of words")
        raw, start = ids.tobytes(), 0
        for word, stop in zip(words, stops):
            self.words[word] = raw[start:stop]
            start = stop


def slices(texts: Iterable[str], size: int = 2_000_000) -> Iterator[list[str]]:
    """Lists of texts of about ``size`` characters, one text at least."""
    some, n = [], 0
    for text in texts:
        some.append(text)
        n += len(text)
        if n >= size:
            yield some
            some, n = [], 0
    if some:
        yield some


_encoders: dict[str, WordIds] = {}


def encoder(path: str) -> WordIds:
    """The encoder of this Python worker."""
    if path not in _encoders:
        _encoders[path] = WordIds(path)
    return _encoders[path]
