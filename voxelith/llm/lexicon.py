"""A lexicon of words with id outputs as a minimal acyclic automaton.

Words are added in sorted order; states with the same suffixes are shared as soon as they can't change.
Each transition carries the number of words that sort before those through it, so the sum along a path is
the word's place, and the ids of that place are the output. All of it is a few flat arrays in one buffer,
which a worker maps instead of building objects.
"""

from __future__ import annotations

import mmap

import numpy as np

MAGIC = b"VXLEXI01"


def build(words: list[bytes], lengths: np.ndarray, ids: np.ndarray) -> bytes:
    """words: distinct, sorted, not empty; lengths and ids: their outputs in that order."""
    # a state is [final, {byte: state}]; register: signature of a finished state -> its number
    register: dict[tuple, int] = {}
    final: list[bool] = []
    arcs: list[list[tuple[int, int]]] = []
    count: list[int] = []

    def finish(state: list) -> int:
        sign = (state[0], tuple(state[1].items()))
        got = register.get(sign)
        if got is None:
            got = register[sign] = len(final)
            final.append(state[0])
            arcs.append(list(state[1].items()))
            count.append(state[0] + sum(count[s] for s in state[1].values()))
        return got

    path: list[list] = [[False, {}]]
    last = b""
    for w in words:
        shared = 0
        while shared < len(last) and shared < len(w) and last[shared] == w[shared]:
            shared += 1
        for depth in range(len(last), shared, -1):
            path[depth - 1][1][last[depth - 1]] = finish(path.pop())
        for _ in range(shared, len(w)):
            path.append([False, {}])
        path[len(w)][0] = True
        last = w
    for depth in range(len(last), 0, -1):
        path[depth - 1][1][last[depth - 1]] = finish(path.pop())
    root = finish(path[0])

    key, target, before = [], [], []
    for s, out in enumerate(arcs):
        sum_ = int(final[s])
        for byte, to in out:  # in order of bytes, as words were
            key.append(s * 256 + byte)
            target.append(to)
            before.append(sum_)
            sum_ += count[to]
    parts = [np.array(key, np.int64), np.array(target, np.int32), np.array(before, np.int32), np.array(final, np.uint8), np.asarray(lengths, np.int32), np.asarray(ids, np.int32)]
    head = np.array([root, *map(len, parts)], np.int64).tobytes()
    return b"".join([MAGIC, head, *(p.tobytes() + b"\0" * (-p.nbytes % 8) for p in parts)])


class Lexicon:
    def __init__(self, buffer):
        if bytes(buffer[:8]) != MAGIC:
            raise ValueError("not a lexicon")
        head = np.frombuffer(buffer, np.int64, 7, 8)
        self.root, at, parts = int(head[0]), 64, []
        for n, kind in zip(head[1:].tolist(), (np.int64, np.int32, np.int32, np.uint8, np.int32, np.int32), strict=True):
            parts.append(np.frombuffer(buffer, kind, n, at))
            at += -(-n * np.dtype(kind).itemsize // 8) * 8
        self.key, self.target, self.before, self.final, self.length, self.ids = parts
        self.start = np.cumsum(self.length, dtype=np.int64) - self.length

    @classmethod
    def mapped(cls, blob: bytes) -> Lexicon:
        """From pages mapped for this worker, without a file: nothing is written to the machine's disk."""
        pages = mmap.mmap(-1, max(1, len(blob)))
        pages.write(blob)
        return cls(pages)

    @property
    def states(self) -> int:
        return len(self.final)

    def find(self, words: list[bytes]) -> np.ndarray:
        """The place of each word, or -1; all words go one byte further in each step."""
        place = np.full(len(words), -1, np.int64)
        if not len(self.key) or not words:
            return place
        lengths = np.array([len(w) for w in words], np.int64)
        raw = np.frombuffer(b"".join(words), np.uint8)
        at = np.cumsum(lengths) - lengths
        live = np.flatnonzero(lengths > 0)
        state, sums = np.full(len(words), self.root, np.int64), np.zeros(len(words), np.int64)
        step = 0
        while len(live):
            want = state[live] * 256 + raw[at[live] + step]
            arc = np.minimum(np.searchsorted(self.key, want), len(self.key) - 1)
            ok = self.key[arc] == want
            live, arc = live[ok], arc[ok]
            state[live] = self.target[arc]
            sums[live] += self.before[arc]
            step += 1
            ended = lengths[live] == step
            over = live[ended]
            over = over[self.final[state[over]] == 1]
            place[over] = sums[over]
            live = live[~ended]
        return place

    def outputs(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        lengths = self.length[places].astype(np.int64)
        ends = np.cumsum(lengths)
        at = np.repeat(self.start[places] - ends + lengths, lengths) + np.arange(ends[-1] if len(ends) else 0)
        return lengths, self.ids[at]
