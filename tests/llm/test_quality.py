"""Counting the n-grams of a lot."""

from __future__ import annotations

import random
import tracemalloc

from voxelith.llm import quality


def test_counting_a_lot_takes_few_bytes_a_character():
    rng = random.Random(1)
    words = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(2, 9))) for _ in range(2_000)]
    lot = [(i, " ".join(rng.choice(words) for _ in range(150)), True) for i in range(1_000)]
    chars, alphabet = sum(len(t) for _, t, _ in lot), quality.Alphabet()
    tracemalloc.start()
    *_, n = quality.counted(alphabet, lot)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n.sum() == chars and peak < 56 * chars
