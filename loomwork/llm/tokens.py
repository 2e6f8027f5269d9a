"""Token ids of whole texts, by a public tokenizer whose vocabulary file is a parameter."""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from loomwork.llm.common import give_back

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: Parts of words whose ids a Python worker keeps; beyond it starts anew. Bounds memory, changes no result.
CACHE_WORDS = 400_000
#: New parts that are encoded as one text.
JOINED = 2048
#: What marks a word's last token.
END = "</w>"
#: Bytes of text that are split into words at once.
SLICE_BYTES = 6 << 20


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


#: Classes of bytes: 0 space, 1 letter, 2 digit, 3 mark, 4 first byte of a Latin-1 letter, 5 its second byte, 9 other.
_KIND = np.full(256, 9, np.uint8)
_KIND[33:127] = 3
_KIND[[*range(65, 91), *range(97, 123)]] = 1
_KIND[48:58] = 2
_KIND[32] = 0
_KIND[0xC3] = 4
_KIND[0x80:0xC0] = 5
_KIND[[ord("'"), ord("<"), 0x97, 0xB7]] = 9


def plain_words(data: bytes, n: int) -> np.ndarray:
    """Which of n words joined by spaces hold nothing but ASCII and Latin-1 letters, digits and marks.

    Words with an apostrophe (contractions), ``<`` (special tokens) or anything else are left to the tokenizer whole.
    """
    kind = _KIND[np.frombuffer(data, np.uint8)]
    before = np.r_[np.uint8(0), kind[:-1]]
    odd = (kind == 9) | ((kind == 5) != (before == 4))
    odd[-1:] |= kind[-1:] == 4
    return np.bincount(np.cumsum(kind == 0), odd, n) == 0


def split_parts(data: bytes, lower: bool) -> tuple[list[str], np.ndarray]:
    """The parts of plain words joined by spaces, in order, and how many each word has: runs of letters, digits, runs of marks."""
    text = np.frombuffer(data, np.uint8).copy()
    kind = _KIND[text]
    kind[kind >= 4] = 1
    earlier = np.r_[np.uint8(0), kind[:-1]]
    begins = (kind != 0) & ((kind != earlier) | (kind == 2))
    counts = np.bincount(np.cumsum(kind == 0), begins, int(np.count_nonzero(kind == 0)) + 1).astype(np.int64)
    if lower:
        second = np.r_[False, text[:-1] == 0xC3]
        text[((text >= 65) & (text <= 90)) | (second & (text >= 0x80) & (text <= 0x9E))] += 32
    parts = np.insert(text, np.flatnonzero(begins & (earlier != 0)), 32)
    return parts.tobytes().decode().split(" "), counts


class Encoder:
    """Ids of texts as ``encode(text, add_special_tokens=False)`` gives them.

    A vocabulary whose tokens mark where a word ends splits texts at white space and, within words, into runs of letters,
    digits and runs of marks, and encodes each part for itself. So each distinct word of a slice is taken once, and each
    distinct part encoded once, many of them in one text, and kept. Texts for other vocabularies are encoded whole.
    """

    def __init__(self, vocabulary: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(vocabulary)
        known = self.tokenizer.get_vocab(with_added_tokens=True)
        self.size = max(known.values()) + 1
        self.is_end = np.zeros(self.size, bool)
        self.is_end[[i for t, i in known.items() if t.endswith(END)]] = True
        self.by_word = bool(self.is_end.any())
        self.lower = self._ids("A À") == self._ids("a à")
        self.reset()

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def reset(self) -> None:
        self.places: dict[str, int] = {}
        self.ids = np.empty(1 << 16, np.uint32)
        self.starts = np.zeros(1 << 16, np.int64)
        self.used = self.words = 0

    def _learn(self, parts: list[str]) -> None:
        """Encodes parts not seen before; should any be split further, all of them one by one."""
        for at in range(0, len(parts), JOINED):
            some = parts[at : at + JOINED]
            ids = np.array(self._ids(" ".join(some)), np.uint32)
            ends = np.flatnonzero(self.is_end[ids]) + 1
            if len(ends) != len(some):
                ids, offsets = self._alone(some)
                ends = offsets[1:]
            self._keep(some, ids, ends)

    def _alone(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [e.ids for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]
        return np.array([i for f in found for i in f], np.uint32), np.r_[0, np.cumsum([len(f) for f in found], dtype=np.int64)]

    def _keep(self, parts: list[str], ids: np.ndarray, ends: np.ndarray) -> None:
        while self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.empty_like(self.ids)])
        while self.words + len(parts) + 1 > len(self.starts):
            self.starts = np.concatenate([self.starts, np.zeros_like(self.starts)])
        self.ids[self.used : self.used + len(ids)] = ids
        self.starts[self.words + 1 : self.words + len(parts) + 1] = self.used + ends
        self.places.update(zip(parts, range(self.words, self.words + len(parts))))
        self.used += len(ids)
        self.words += len(parts)

    def _distinct(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids in a row, and for each word where they begin and how many there are."""
        starts, counts = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        plain = plain_words(" ".join(words).encode("utf-8", "surrogatepass"), len(words))
        # white space at a text's ends leaves an empty word, which has no ids
        some = np.fromiter(map(len, words), np.int64, len(words)) > 0
        easy, hard = np.flatnonzero(plain & some), np.flatnonzero(~plain & some)
        out = np.empty(0, np.uint32)
        if len(easy):
            parts, n = split_parts(" ".join([words[i] for i in easy.tolist()]).encode(), self.lower)
            if self.words > CACHE_WORDS:
                self.reset()
            places = self.places
            if new := [p for p in dict.fromkeys(parts) if p not in places]:
                self._learn(new)
            place = np.fromiter(map(places.__getitem__, parts), np.int64, len(parts))
            out, offsets = self._gather(self.ids, self.starts[place], self.starts[place + 1] - self.starts[place])
            bounds = offsets[np.r_[0, np.cumsum(n)]]
            starts[easy], counts[easy] = bounds[:-1], np.diff(bounds)
        if len(hard):
            ids, offsets = self._alone([words[i] for i in hard.tolist()])
            starts[hard], counts[hard] = len(out) + offsets[:-1], np.diff(offsets)
            out = np.concatenate([out, ids])
        return out, starts, counts

    @staticmethod
    def _gather(ids: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Runs of ids one after another, and where each begins and the last ends."""
        upto = np.r_[0, np.cumsum(counts)]
        where = np.arange(upto[-1], dtype=np.int32)
        where += np.repeat((starts - upto[:-1]).astype(np.int32), counts)
        return ids[where], upto

    def _encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        texts = pc.fill_null(texts, "")
        if not self.by_word:
            return self._alone(texts.to_pylist())
        words = pc.ascii_split_whitespace(texts.cast(pa.large_string()))
        ends = words.offsets.to_numpy().astype(np.int64)
        coded = words.flatten().dictionary_encode()
        ids, starts, counts = self._distinct(coded.dictionary.to_pylist())
        index = coded.indices.to_numpy()
        out, upto = self._gather(ids, starts[index], counts[index])
        return out, upto[ends - ends[0]]

    def encode(self, texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(number of texts, their ids in a row, offsets of the texts in it), slice after slice."""
        if not len(texts):
            return
        give_back()
        sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy().astype(np.int64)
        cuts = np.flatnonzero(np.diff(np.cumsum(sizes) // SLICE_BYTES)) + 1
        for a, b in zip(np.r_[0, cuts], np.r_[cuts, len(texts)]):
            ids, offsets = self._encode(texts.slice(a, b - a))
            yield int(b - a), ids, offsets


_encoders: dict[str, Encoder] = {}


def encoder(vocabulary: str) -> Encoder:
    """One for each Python worker, which keeps it from task to task."""
    if vocabulary not in _encoders:
        _encoders[vocabulary] = Encoder(vocabulary)
    return _encoders[vocabulary]
