"""Token ids of whole texts, from a public vocabulary through the tokenizers library."""

from __future__ import annotations

import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession
from tokenizers import Tokenizer

LONGEST_KEPT = 64  # bytes of a word whose ids are remembered
MOST_KEPT = 400_000  # words in each of the two generations that a task remembers
JOINED = 1000  # new words that are encoded in one call
CODED_BYTES = 2 << 20  # of texts that are encoded together; the more, the fewer different words
WORD_END = "</w>"
MARKS = b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"  # ASCII marks but the apostrophe
# Marks between an ASCII letter or digit and the end of a word.
TAIL = r"([a-z0-9])([" + re.escape(MARKS.decode()) + r"]+)([ \t-\r]|$)"
# Words of letters that no rule changes: lower-case ones of Latin-1, composed already.
PLAIN = "^[a-zß-öø-ÿ]+$"
# How the names of special tokens begin, and combining marks.
LEFT_WHOLE = "<\\||[\u0300-\u037f]"


class WordCoder(dict):
    """Ids of words as little-endian unsigned 32-bit integers, by the word's bytes.

    The vocabulary's rules end a token at white space, so a text's ids are those
    of its words in turn. They also part marks at a word's end from the letter or
    digit before them, and ignore ASCII capitals, so both are settled before words
    are looked up. A text with combining marks, which join a capital and a small
    letter differently, or with what may be a special token is left to the library
    as a whole. New words of letters only are encoded many at a time; a token that
    ends a word says so. Ids always come from the library.
    """

    def __init__(self, vocabulary: str) -> None:
        super().__init__()
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_str(vocabulary)
        words = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(words.values()) + 1, bool)
        self.ends[[i for word, i in words.items() if word.endswith(WORD_END)]] = True
        self.older: dict[bytes, bytes] = {}

    def __missing__(self, word: bytes) -> bytes:
        ids = self.older.get(word)
        if ids is None:
            stem, mark = self._parts(word)
            if mark:
                ids = self[stem] + self[mark]
            else:
                ids = self._ids(word.decode()).tobytes()
        self._keep(word, ids)
        return ids

    def _keep(self, word: bytes, ids: bytes) -> None:
        if len(word) <= LONGEST_KEPT:
            if len(self) >= MOST_KEPT:
                self.older = dict(self)
                self.clear()
            self[word] = ids

    def _ids(self, text: str) -> np.ndarray:
        found = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids
        return np.array(found, "<u4")

    @staticmethod
    def _parts(word: bytes) -> tuple[bytes, bytes]:
        """A word without its marks at the end, and these."""
        stem = word.rstrip(MARKS)
        if stem and stem != word:
            last = stem[-4:].decode(errors="ignore")[-1:].lower()
            if len(last) == 1 and last.isalnum():
                return stem, word[len(stem) :]
        return word, b""

    def _learn(self, words: list[bytes]) -> None:
        """Remember the ids of new words."""
        older = self.older
        letters, others = [], []
        new = {self._parts(w)[0] for w in words if w not in self and w not in older}
        for stem in new:
            if stem in self or stem in older or len(stem) > LONGEST_KEPT:
                continue
            text = stem.decode()
            plain = text.isalpha() and text.lower().isalpha()
            (letters if plain else others).append((stem, text))
        for start in range(0, len(letters), JOINED):
            some = letters[start : start + JOINED]
            ids = self._ids(" ".join(text for _, text in some))
            ends = np.flatnonzero(self.ends[ids]) + 1
            if len(ends) != len(some):
                others += some  # a letter that is normalised to something else
                continue
            raw, at = ids.tobytes(), 0
            for (stem, _), end in zip(some, (4 * ends).tolist()):
                self._keep(stem, raw[at:end])
                at = end
        found = self.tokenizer.encode_batch_fast([t for _, t in others], add_special_tokens=False)
        for (stem, _), coded in zip(others, found):
            self._keep(stem, np.array(coded.ids, "<u4").tobytes())

    def _ids_of(self, words: pa.Array) -> list[bytes]:
        """The ids of different words: remembered ones, new plain ones many at a time, then the others."""
        known = words.cast(pa.large_binary()).to_pylist()
        ids = list(map(self.get, known))
        new = []
        for i in [i for i, found in enumerate(ids) if found is None]:
            ids[i] = self.older.get(known[i])
            if ids[i] is None:
                new.append(i)
            else:
                self._keep(known[i], ids[i])
        plain = pc.match_substring_regex(words.take(pa.array(new, pa.int64())), PLAIN).to_pylist()
        letters = [i for i, is_plain in zip(new, plain) if is_plain]
        others = [i for i, is_plain in zip(new, plain) if not is_plain]
        for start in range(0, len(letters), JOINED):
            some = letters[start : start + JOINED]
            coded = self._ids(b" ".join([known[i] for i in some]).decode())
            ends = np.flatnonzero(self.ends[coded]) + 1
            if len(ends) != len(some):
                others += some  # letters that this vocabulary parts or leaves out
                continue
            raw, at = coded.tobytes(), 0
            for i, end in zip(some, (4 * ends).tolist()):
                ids[i] = raw[at:end]
                self._keep(known[i], ids[i])
                at = end
        self._learn([known[i] for i in others])
        for i in others:
            ids[i] = self[known[i]]
        return ids

    def encode(self, text: str | None) -> bytes:
        """The ids of a whole text; none for a null or empty one."""
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each whole text.

        Words are cut and counted as columns, so each different word of the
        texts is looked up once; the ids are put together by its number.
        """
        column = pc.fill_null(pa.array(texts, pa.large_string()), "")
        whole = pc.match_substring_regex(column, LEFT_WHOLE)
        parted = pc.replace_substring_regex(pc.ascii_lower(column), TAIL, r"\1 \2\3")
        words = pc.ascii_split_whitespace(pc.if_else(whole, "", parted))
        coded = words.flatten().dictionary_encode()
        ids = self._ids_of(coded.dictionary)
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        pool = np.frombuffer(b"".join(ids), "<u4")
        starts = np.cumsum(sizes) - sizes
        numbers = coded.indices.to_numpy()
        per_word = sizes[numbers]
        ends = np.cumsum(per_word)
        at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts[numbers] - ends + per_word, per_word)
        joined = pool[at].tobytes()
        edges = 4 * np.concatenate([[0], ends])[np.asarray(words.offsets) - words.offsets[0].as_py()]
        return [
            self._ids(text).tobytes() if left else joined[first:last]
            for text, left, first, last in zip(texts, whole.to_pylist(), edges[:-1].tolist(), edges[1:].tolist())
        ]


def vocabulary(path: str) -> str:
    """The file's content, which tasks get by broadcast: only the driver needs the file."""
    with open(path, encoding="utf-8") as file:
        return file.read()


def broadcast_vocabulary(spark: SparkSession, path: str):
    return spark.sparkContext.broadcast(vocabulary(path))
