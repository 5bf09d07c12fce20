"""The progressive reader against files of a plain scan writer: runs, long zero runs, end-of-band runs, refinement, restarts."""

from __future__ import annotations

import numpy as np
import pytest

from voxelith.llm import media
from voxelith.llm import progressive_jpeg as pj


class Writer:
    """Symbols and bits of a scan; every symbol has a code of 8 bits."""

    def __init__(self):
        self.items = []

    def symbol(self, s):
        self.items.append(("s", s))

    def bits(self, value, n):
        self.items += [("b", value >> i & 1) for i in range(n - 1, -1, -1)]

    def table(self):
        return sorted({v for k, v in self.items if k == "s"})

    def data(self, table):
        out = []
        for kind, v in self.items:
            out += [v] if kind == "b" else [table.index(v) >> i & 1 for i in range(7, -1, -1)]
        out += [1] * (-len(out) % 8)
        return np.packbits(np.array(out, np.uint8)).tobytes().replace(b"\xff", b"\xff\x00")


class Runs:
    def __init__(self, w):
        self.w, self.n, self.kept = w, 0, []

    def flush(self):
        if self.n:
            k = self.n.bit_length() - 1
            self.w.symbol(k << 4)
            self.w.bits(self.n - (1 << k), k)
            for b in self.kept:
                self.w.bits(b, 1)
        self.n, self.kept = 0, []


def first_dc(blocks, low, w):
    last = 0
    for b in blocks:
        v = int(b[0]) >> low
        d, last = v - last, v
        n = abs(d).bit_length()
        w.symbol(n)
        w.bits(d if d >= 0 else d + (1 << n) - 1, n)


def first_ac(blocks, start, end, low, w):
    runs = Runs(w)
    for b in blocks:
        r = 0
        for k in range(start, end + 1):
            v = abs(int(b[k])) >> low
            if not v:
                r += 1
                continue
            runs.flush()
            while r > 15:
                w.symbol(0xF0)
                r -= 16
            n = v.bit_length()
            w.symbol(r << 4 | n)
            w.bits(v if b[k] > 0 else v ^ ((1 << n) - 1), n)
            r = 0
        runs.n += r > 0
    runs.flush()


def refine_ac(blocks, start, end, low, w):
    runs = Runs(w)
    for b in blocks:
        size = {k: abs(int(b[k])) >> low for k in range(start, end + 1)}
        last = max((k for k, v in size.items() if v == 1), default=-1)
        r, kept = 0, []
        for k, v in size.items():
            if not v:
                r += 1
                continue
            while r > 15 and k <= last:
                runs.flush()
                w.symbol(0xF0)
                r -= 16
                for x in kept:
                    w.bits(x, 1)
                kept = []
            if v > 1:
                kept.append(v & 1)
                continue
            runs.flush()
            w.symbol(r << 4 | 1)
            w.bits(int(b[k] > 0), 1)
            for x in kept:
                w.bits(x, 1)
            r, kept = 0, []
        if r or kept:
            runs.n += 1
            runs.kept += kept
    runs.flush()


def file_of(planes, sampling, height, width, restart=0):
    """planes: (padded rows x padded columns x 64) of each component; the DC scans are interleaved."""
    n = len(planes)
    out = [b"\xff\xd8", pj._segment(0xDB, bytes([0] + [2] * 64))]
    out.append(pj._segment(0xC2, bytes([8]) + height.to_bytes(2, "big") + width.to_bytes(2, "big") + bytes([n, *(x for i, (h, v) in enumerate(sampling) for x in (i + 1, h << 4 | v, 0))])))
    image = pj.Image(width, height, [pj.Component(i + 1, h, v, 0) for i, (h, v) in enumerate(sampling)], {})
    image.lay_out()
    if restart:
        out.append(pj._segment(0xDD, restart.to_bytes(2, "big")))

    def groups(chosen):
        if len(chosen) == 1:
            c = image.components[chosen[0]]
            return [[planes[chosen[0]][y, x]] for y in range(c.rows) for x in range(c.cols)]
        return [[planes[i][gy * c.v + y, gx * c.h + x] for i in chosen for c in [image.components[i]] for y in range(c.v) for x in range(c.h)] for gy in range(image.group_rows) for gx in range(image.group_cols)]

    def scan(chosen, start, end, high, low, write):
        lots = groups(chosen)
        every = restart or len(lots)
        writers = []
        for i in range(0, len(lots), every):
            writers.append(Writer())
            write([b for g in lots[i : i + every] for b in g], writers[-1])
        table = sorted({s for w in writers for s in w.table()})
        if table:
            counts = [0] * 16
            counts[7] = len(table)
            out.append(pj._segment(0xC4, bytes([(1 if start else 0) << 4, *counts, *table])))
        out.append(pj._segment(0xDA, bytes([len(chosen), *(x for i in chosen for x in (i + 1, 0)), start, end, high << 4 | low])))
        out.append(b"".join(w.data(table) + (bytes([0xFF, 0xD0 + i % 8]) if i + 1 < len(writers) else b"") for i, w in enumerate(writers)))

    def dc(blocks, w):  # one predictor for each component would need their order; with one component it is plain
        first_dc(blocks, 1, w)

    if n == 1:
        scan([0], 0, 0, 0, 1, dc)
    else:
        for i in range(n):
            scan([i], 0, 0, 0, 1, dc)
    for i in range(n):
        scan([i], 1, 5, 0, 2, lambda b, w: first_ac(b, 1, 5, 2, w))
        scan([i], 6, 63, 0, 2, lambda b, w: first_ac(b, 6, 63, 2, w))
    scan(list(range(n)), 0, 0, 1, 0, lambda b, w: [w.bits(int(x[0]) & 1, 1) for x in b])
    for low in (1, 0):
        for i in range(n):
            scan([i], 1, 63, low + 1, low, lambda b, w, low=low: refine_ac(b, 1, 63, low, w))
    return b"".join([*out, b"\xff\xd9"])


@pytest.mark.parametrize("seed", range(12))
def test_any_progressive_file(seed):
    rnd = np.random.default_rng(seed)
    height, width = int(rnd.integers(1, 60)), int(rnd.integers(1, 60))
    sampling = [[(1, 1)], [(2, 2), (1, 1), (1, 1)], [(2, 1), (1, 1), (1, 1)]][seed % 3]
    image = pj.Image(width, height, [pj.Component(i + 1, h, v, 0) for i, (h, v) in enumerate(sampling)], {})
    image.lay_out()
    planes = []
    for c in image.components:
        plane = rnd.integers(-9, 10, c.coefficients.shape) * (rnd.random(c.coefficients.shape) < rnd.choice([0.01, 0.1, 0.6]))
        plane[:, :, 0] = rnd.integers(-200, 200, plane.shape[:2])
        plane[c.rows :], plane[:, c.cols :] = 0, 0  # what scans of one component don't cover
        planes.append(plane.astype(np.int32))
    raw = file_of(planes, sampling, height, width, restart=int(rnd.integers(0, 4)))
    for fixed in (True, False):
        got = pj.decode(raw, fixed)
        for c, plane in zip(got.components, planes, strict=True):
            assert (c.coefficients == plane).all()
    assert pj.pixels(got).shape == (height, width, 3)


def test_transform_against_its_definition():
    rnd = np.random.default_rng(1)
    c = pj.Component(1, 1, 1, 0, 1, 1, 1, 1, rnd.integers(-40, 40, (1, 1, 64)).astype(np.int32))
    image = pj.Image(8, 8, [c], {0: np.full(64, 2, np.int32)})
    flat = np.zeros(64)
    flat[pj.ZIGZAG] = c.coefficients.reshape(-1) * 2
    f, want = flat.reshape(8, 8), np.zeros((8, 8))
    scale = lambda k: np.sqrt(0.5) if k == 0 else 1.0
    for y in range(8):
        for x in range(8):
            want[y, x] = sum(scale(u) * scale(v) / 4 * f[v, u] * np.cos((2 * x + 1) * u * np.pi / 16) * np.cos((2 * y + 1) * v * np.pi / 16) for u in range(8) for v in range(8))
    assert np.abs(pj.plane_samples(image, c).astype(float) - np.clip(want + 128, 0, 255)).max() <= 2


def test_payload_profile():
    rnd = np.random.default_rng(2)
    for n in (1, 191, 192, 193, 5000, 40_000):
        payload = media.padded(rnd.integers(0, 256, n, dtype=np.uint8).tobytes())
        raw = pj.encode(payload)
        assert media.payload(pj.decode(raw)) == payload
        if n < 6000:
            slow = pj.decode(raw, fixed=False)
            assert media.payload(slow) == payload
            assert (pj.pixels(slow) == pj.pixels(pj.decode(raw))).all()
    for wrong in (b"", b"\xff\xd8\xff\xd9", b"GIF89a"):
        with pytest.raises(ValueError):
            pj.decode(wrong)


def test_colours_of_flat_images():
    for y, cb, cr, want in ((0, 0, 0, (128, 128, 128)), (400, 0, 0, (178, 178, 178)), (0, 0, 400, (198, 92, 128)), (0, 400, 0, (128, 111, 217))):
        planes = [np.zeros((2, 2, 64), np.int32), np.zeros((1, 1, 64), np.int32), np.zeros((1, 1, 64), np.int32)]
        for p, v in zip(planes, (y, cb, cr), strict=True):
            p[:, :, 0] = v
        comps = [pj.Component(i + 1, h, h, 0, len(p), len(p), len(p), len(p), p) for i, (h, p) in enumerate(zip((2, 1, 1), planes, strict=True))]
        assert (np.abs(pj.pixels(pj.Image(16, 16, comps, {})).astype(int) - want) <= 1).all()
