"""Word-level BPE: splitting texts into words, exact merges of many words at once, and a cache over both.

Works on tokenizer files whose normaliser is NFC + white space + lower case, whose pre-tokenizer keeps
letters, single digits and runs of other characters, and whose words end in a suffix. Words never cross
white space, so the ids of a text are those of its white-space chunks, one after the other, and each
distinct chunk is encoded once. Texts beyond Latin-1, or with a special token's string in them, go through
the library's own normaliser and pre-tokenizer instead.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: The words of the tokenizer file's pattern, over Latin-1 in lower case.
LATIN_WORD = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zªµºß-öø-ÿ]+|[0-9²³¹¼-¾]|[^\\t-\\r \x85\xa00-9a-zªµºß-öø-ÿ²³¹¼-¾]+")
#: str.split() takes these for white space; the tokenizer does not.
ODD_SPACE = re.compile("[\x1c-\x1f]")
CACHED = 200_000
BYTES_AT_ONCE = 2_000_000


def byte_alphabet() -> list[str]:
    """The printable character of each byte in byte-level vocabularies: itself if printable in Latin-1, else the next from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b) if b in set(own) else chr(next(spare)) for b in range(256)]


class Vocabulary:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            data = json.load(f)
        model = data["model"]
        self.path, self.ids, self.suffix = path, model["vocab"], model["end_of_word_suffix"]
        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}
        self.size = max([*self.ids.values(), *self.special.values()]) + 1
        self.tokens = np.full(self.size, "", object)
        for t, i in [*self.ids.items(), *self.special.items()]:
            self.tokens[i] = t
        alphabet = byte_alphabet()
        self.spelling = {c: "".join(alphabet[b] for b in chr(c).encode()) for c in range(256)}  # only words of Latin-1 are spelt
        self.byte = np.array([self.ids[c] for c in alphabet], np.int32)
        self.last_byte = np.array([self.ids[c + self.suffix] for c in alphabet], np.int32)
        left = np.array([self.ids[a] for a, _ in model["merges"]], np.int64)
        right = np.array([self.ids[b] for _, b in model["merges"]], np.int64)
        made = np.array([self.ids[a + b] for a, b in model["merges"]], np.int64)
        # every token is made by one merge, after its parts: then all occurrences of a pair merge before any pair they give
        born = np.full(self.size, -1)
        born[made] = np.arange(len(made))
        if len(set(made.tolist())) != len(made) or (born[left] >= np.arange(len(made))).any() or (born[right] >= np.arange(len(made))).any():
            raise ValueError("merges out of order")
        key = left * self.size + right
        order = np.argsort(key)
        self.pair_key, self.pair_rank, self.made = key[order], order.astype(np.int32), made.astype(np.int32)

    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a.astype(np.int64) * self.size + b
        at = np.minimum(np.searchsorted(self.pair_key, key), len(self.pair_key) - 1)
        return np.where(self.pair_key[at] == key, self.pair_rank[at], np.iinfo(np.int32).max)

    def merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(lengths, ids) of words that aren't empty: in each round every word merges all occurrences of its lowest-ranked pair."""
        none = np.iinfo(np.int32).max
        lengths = np.array([len(w) for w in words], np.int64)
        raw = np.frombuffer(b"".join(words), np.uint8)
        sym, of = self.byte[raw], np.repeat(np.arange(len(words)), lengths)
        ends = np.cumsum(lengths) - 1
        sym[ends] = self.last_byte[raw[ends]]
        rank = np.full(len(sym), none, np.int32)
        inner = np.flatnonzero(of[:-1] == of[1:])
        rank[inner] = self.ranks(sym[inner], sym[inner + 1])
        done_sym, done_of = [], []
        while len(sym):
            starts = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
            least = np.minimum.reduceat(rank, starts)
            counts = np.diff(np.r_[starts, len(sym)])
            over = np.repeat(least == none, counts)
            if over.any():
                done_sym.append(sym[over])
                done_of.append(of[over])
                sym, of, rank = sym[~over], of[~over], rank[~over]
                least, counts = least[least != none], counts[least != none]
                if not len(sym):
                    break
            hit = rank == np.repeat(least, counts)
            at = np.flatnonzero(hit)
            # of overlapping occurrences (a pair of equal parts) every second one
            fresh = np.r_[True, np.diff(at) > 1]
            nth = np.arange(len(at)) - np.maximum.accumulate(np.where(fresh, np.arange(len(at)), 0))
            at = at[nth % 2 == 0]
            sym[at] = self.made[rank[at]]
            stay = np.ones(len(sym), bool)
            stay[at + 1] = False
            place = (np.cumsum(stay) - 1)[at]
            rank[at] = rank[at + 1]
            sym, of, rank = sym[stay], of[stay], rank[stay]
            redo = np.unique(np.concatenate([place, place - 1]))
            redo = redo[(redo >= 0) & (redo < len(sym) - 1)]
            redo = redo[of[redo] == of[redo + 1]]
            rank[redo] = self.ranks(sym[redo], sym[redo + 1])
            final = place[(place == len(sym) - 1) | (of[np.minimum(place + 1, len(sym) - 1)] != of[place])]
            rank[final] = none
        ids, of = np.concatenate(done_sym or [sym]), np.concatenate(done_of or [of])
        order = np.argsort(of, kind="stable")
        return np.bincount(of, minlength=len(words)), ids[order]

    def byte_level(self, word: str) -> str:
        """The word as the vocabulary's tokens spell it."""
        return word if word.isascii() and word.isprintable() else word.translate(self.spelling)


def is_latin(text: str, special: Iterable[str]) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return not ("<|" in text and any(s in text for s in special)) and not ODD_SPACE.search(text)


class Rows:
    """Rows of ids of different lengths, appended and gathered by number."""

    def __init__(self):
        self.start, self.length, self.data, self.n, self.used = np.zeros(1024, np.int64), np.zeros(1024, np.int64), np.zeros(8192, np.int32), 0, 0

    def append(self, lengths: np.ndarray, ids: np.ndarray) -> None:
        n, used = self.n + len(lengths), self.used + len(ids)
        while n > len(self.start):
            self.start, self.length = np.resize(self.start, 2 * len(self.start)), np.resize(self.length, 2 * len(self.length))
        while used > len(self.data):
            self.data = np.resize(self.data, 2 * len(self.data))
        self.length[self.n : n] = lengths
        self.start[self.n : n] = self.used + np.cumsum(lengths) - lengths
        self.data[self.used : used] = ids
        self.n, self.used = n, used

    def gather(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        lengths = self.length[numbers]
        ends = np.cumsum(lengths)
        at = np.repeat(self.start[numbers] - ends + lengths, lengths) + np.arange(ends[-1] if len(ends) else 0)
        return lengths, self.data[at]


class Numbers(dict):
    """Numbers unseen keys from 0 on."""

    def __missing__(self, key):
        self[key] = n = len(self)
        return n


def _newest(numbered: Numbers, before: int) -> list:
    """Keys numbered from `before` on, in order."""
    return list(islice(reversed(numbered), len(numbered) - before))[::-1]


class CachedEncoder:
    """encode_words: distinct words -> (lengths, ids); encode_odd: ids of a text beyond Latin-1 or with special tokens.

    encode_chunks: distinct chunks in lower case -> (lengths, ids); unless it is given, by LATIN_WORD and encode_words. A full
    cache keeps the chunks met more than once, of those the most frequent, and half its size at most.
    """

    def __init__(self, special: Iterable[str], encode_words: Callable[[list[str]], tuple[np.ndarray, np.ndarray]] | None, encode_odd: Callable[[str], np.ndarray], size: int = CACHED, encode_chunks: Callable[[list[str]], tuple[np.ndarray, np.ndarray]] | None = None):
        self.special, self.encode_words, self.encode_odd, self.size = tuple(special), encode_words, encode_odd, size
        self.encode_chunks = encode_chunks or self._by_words
        self.chunk, self.chunk_rows, self.met = Numbers(), Rows(), np.zeros(1024, np.int64)
        self.word, self.word_rows = Numbers(), Rows()

    def _shrink(self) -> None:
        met = self.met[: len(self.chunk)]
        least = max(2, int(np.partition(met, -self.size // 2)[-self.size // 2]) + 1)
        keep = np.flatnonzero(met >= least)
        rows = Rows()
        rows.append(*self.chunk_rows.gather(keep))
        chunks = Numbers()
        for c, ok in zip(self.chunk, (met >= least).tolist(), strict=True):
            if ok:
                chunks[c]
        self.chunk, self.chunk_rows = chunks, rows
        self.met = np.zeros(max(1024, len(keep)), np.int64)
        self.met[: len(keep)] = met[keep]
        self.word, self.word_rows = Numbers(), Rows()

    def _by_words(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [LATIN_WORD.findall(c) for c in chunks]
        before = len(self.word)
        number = self.word.__getitem__
        numbers = np.array([number(w) for ws in found for w in ws], np.int64)
        if len(self.word) > before:
            self.word_rows.append(*self.encode_words(_newest(self.word, before)))
        each = np.array([len(ws) for ws in found], np.int64)
        lengths, ids = self.word_rows.gather(numbers)
        ends = np.r_[0, np.cumsum(lengths)][np.r_[0, np.cumsum(each)]]
        return np.diff(ends), ids

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        out: list[np.ndarray | None] = [None] * len(texts)
        if len(self.chunk) > self.size:
            self._shrink()
        number, before = self.chunk.__getitem__, len(self.chunk)
        rows, numbers = [], []
        for i, t in enumerate(texts):
            if is_latin(t, self.special):
                numbers.append(np.array(list(map(number, t.lower().split())), np.int64))
                rows.append(i)
            else:
                out[i] = self.encode_odd(t)
        if len(self.chunk) > before:
            self.chunk_rows.append(*self.encode_chunks(_newest(self.chunk, before)))
        if rows:
            every = np.concatenate(numbers)
            if len(self.chunk) > len(self.met):
                self.met = np.concatenate([self.met, np.zeros(len(self.chunk), np.int64)])
            met = np.bincount(every, minlength=0)
            self.met[: len(met)] += met
            lengths, ids = self.chunk_rows.gather(every)
            ends = np.r_[0, np.cumsum(lengths)][np.cumsum([0, *map(len, numbers)])]
            for i, a, b in zip(rows, ends, ends[1:], strict=False):
                out[i] = ids[a:b]
        return out


def portions(texts: pa.Array | list[str]) -> Iterator[tuple[int, int, list]]:
    """(start, stop, texts) in lots of a few million bytes, so that what is made of them at once is bounded; a longer text is alone."""
    sizes = np.array([len(t) for t in texts]) if isinstance(texts, list) else pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    start, held = 0, 0
    for i, n in enumerate(sizes.tolist()):
        if i > start and held + n > BYTES_AT_ONCE:
            yield start, i, _listed(texts, start, i)
            start, held = i, 0
        held += n
    if start < len(sizes):
        yield start, len(sizes), _listed(texts, start, len(sizes))


def _listed(texts: pa.Array | list[str], a: int, b: int) -> list:
    return texts[a:b] if isinstance(texts, list) else texts.slice(a, b - a).to_pylist()
