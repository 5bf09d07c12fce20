"""Progressive JPEG: coefficient arrays in and out, accumulated over spectral-selection and successive-approximation scans.

encode() writes coefficient arrays whose AC values in a band are all of one size (payload_coefficients makes
such arrays of bytes): each then takes the same number of bits in a scan, so a scan is written and read as a
whole array. decode() reads any 8-bit progressive file of Huffman-coded scans (four tables of each class,
restart intervals, runs of blocks without coefficients, refinement); it takes scans of the fixed form as
arrays and any other bit by bit. pixels() dequantises, transforms in numpy, upsamples the chroma planes and
gives the RGB tensor in full resolution. The transform is exact integer arithmetic in float arrays, so a
text gives the same tensor in any batch.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np

#: Fixed values of the format: the zigzag order of an 8 x 8 block, by anti-diagonals of alternating direction.
ZIGZAG = np.array(sorted(range(64), key=lambda i: (i // 8 + i % 8, (i // 8 if (i // 8 + i % 8) % 2 else i % 8))))
UNIT = 192  # payload bytes in a group of 4 + 1 + 1 blocks
PER_BLOCK = 32
BANDS = ((1, 8), (9, 32))
SCALE = 1 << 10
SCAN_END = re.compile(rb"\xff+[^\x00\xd0-\xd7\xff]")


def cosine_basis() -> np.ndarray:
    """64 x 64: the samples (row-major) that each zigzag coefficient adds, times SCALE, in whole numbers."""
    k = np.arange(8)
    one = np.sqrt(np.where(k == 0, 1 / 8, 1 / 4))[:, None] * np.cos((2 * k[None, :] + 1) * k[:, None] * np.pi / 16)
    both = np.einsum("ux,vy->uvxy", one, one).reshape(64, 64)
    return np.round(both[ZIGZAG] * SCALE)


BASIS = cosine_basis()


@dataclass
class Component:
    ident: int
    h: int
    v: int
    table: int
    rows: int = 0  # blocks of the component itself
    cols: int = 0
    padded_rows: int = 0  # blocks with those that fill up the last groups
    padded_cols: int = 0
    coefficients: np.ndarray = field(default_factory=lambda: np.zeros((0, 0, 64), np.int32))


@dataclass
class Image:
    width: int
    height: int
    components: list[Component]
    quantisation: dict[int, np.ndarray]
    comment: bytes = b""

    def lay_out(self) -> None:
        hmax, vmax = max(c.h for c in self.components), max(c.v for c in self.components)
        self.group_cols, self.group_rows = -(-self.width // (8 * hmax)), -(-self.height // (8 * vmax))
        for c in self.components:
            c.cols, c.rows = -(-(-(-self.width * c.h // hmax)) // 8), -(-(-(-self.height * c.v // vmax)) // 8)
            c.padded_cols, c.padded_rows = self.group_cols * c.h, self.group_rows * c.v
            c.coefficients = np.zeros((c.padded_rows, c.padded_cols, 64), np.int32)


# -- writing


def payload_coefficients(payload: bytes) -> tuple[int, int, list[np.ndarray]]:
    """Groups in a row, rows, and the coefficients 1 to 32 of the blocks of Y, Cb and Cr in raster order.

    A byte is a value of sign and size: the high bit gives the sign, 128 plus the low bits the magnitude. The groups
    form a near-square image; those that fill its last row are of byte 0.
    """
    n = len(payload) // UNIT
    cols = max(1, int(np.ceil(np.sqrt(n))))
    rows = -(-n // cols)
    raw = np.zeros(rows * cols * UNIT, np.uint8)
    raw[: len(payload)] = np.frombuffer(payload, np.uint8)
    raw = raw.astype(np.int32)
    value = np.where(raw & 128, -raw, raw + 128).reshape(-1, UNIT)
    return cols, rows, [value[:, :128].reshape(-1, PER_BLOCK), value[:, 128:160], value[:, 160:]]


def payload_bytes(blocks: list[np.ndarray], n: int) -> bytes:
    """The first n bytes from the coefficients 1 to 32 of each plane's blocks."""
    parts = [b.reshape(len(blocks[1]), -1) for b in blocks]
    value = np.concatenate(parts, axis=1).reshape(-1)[:n]
    return np.where(value < 0, -value, value - 128).astype(np.uint8).tobytes()


def _segment(marker: int, body: bytes) -> bytes:
    return b"\xff" + bytes([marker]) + (len(body) + 2).to_bytes(2, "big") + body


def _table(kind: int, number: int, symbols: list[int]) -> bytes:
    """Symbols with codes 0, 10, 110 and so on."""
    return _segment(0xC4, bytes([kind << 4 | number] + [1] * len(symbols) + [0] * (16 - len(symbols)) + symbols))


def _scan(components: list[int], start: int, end: int, high: int, low: int, data: bytes) -> bytes:
    head = bytes([len(components), *(x for c in components for x in (c, 0)), start, end, high << 4 | low])
    return _segment(0xDA, head) + data.replace(b"\xff", b"\xff\x00")


def _refinement(blocks: np.ndarray) -> tuple[list[int], bytes]:
    """End-of-band runs over all blocks, each followed by its correction bits (the values' low bits)."""
    bits, symbols, at = [], [], 0
    while at < len(blocks):
        run = min(len(blocks) - at, 0x7FFF)
        n = run.bit_length() - 1
        if n << 4 not in symbols:
            symbols.append(n << 4)
        k = symbols.index(n << 4)
        head = [1] * k + [0] + [(run - (1 << n)) >> i & 1 for i in range(n - 1, -1, -1)]
        bits += [np.array(head, np.uint8), (np.abs(blocks[at : at + run]) & 1).astype(np.uint8).reshape(-1)]
        at += run
    flat = np.concatenate(bits)
    fill = -len(flat) % 8
    return symbols, np.packbits(np.concatenate([flat, np.ones(fill, np.uint8)])).tobytes()


def encode(payload: bytes) -> bytes:
    """The payload, a positive multiple of 192 bytes, as a progressive 4:2:0 file of coefficients; its length is the comment."""
    cols, rows, planes = payload_coefficients(payload)
    out = [b"\xff\xd8", _segment(0xFE, b"payload %d" % len(payload)), _segment(0xDB, bytes([0] + [1] * 64))]
    out.append(_segment(0xC2, bytes([8]) + (16 * rows).to_bytes(2, "big") + (16 * cols).to_bytes(2, "big") + bytes([3, 1, 0x22, 0, 2, 0x11, 0, 3, 0x11, 0])))
    # DC values are 0: a difference of size 0 each in the first scan, a bit 0 in the second
    count = 6 * rows * cols
    zeros = np.packbits(np.r_[np.zeros(count, np.uint8), np.ones(-count % 8, np.uint8)]).tobytes()
    out += [_table(0, 0, [0]), _scan([1, 2, 3], 0, 0, 0, 1, zeros)]
    # first passes, without the lowest bit: code 0 and seven bits, a byte for each value
    out.append(_table(1, 0, [7]))
    halves = [np.sign(p) * (np.abs(p) >> 1) for p in planes]
    for start, end in BANDS:
        for c, half in enumerate(halves, 1):
            part = half[:, start - 1 : end]
            out.append(_scan([c], start, end, 0, 1, np.where(part > 0, part, part + 127).astype(np.uint8).tobytes()))
    out.append(_scan([1, 2, 3], 0, 0, 1, 0, zeros))
    # second passes: the lowest bit of each
    for start, end in BANDS:
        raster = (planes[0], planes[1], planes[2])
        for c, plane in enumerate(raster, 1):
            symbols, data = _refinement(plane[:, start - 1 : end])
            out += [_table(1, 0, symbols), _scan([c], start, end, 1, 0, data)]
    return b"".join([*out, b"\xff\xd9"])


# -- reading


class Codes:
    """A Huffman table: (length, code) -> symbol."""

    def __init__(self, counts: bytes, symbols: bytes):
        self.symbols = list(symbols)
        self.by_code: dict[tuple[int, int], int] = {}
        code, at = 0, 0
        for length, n in enumerate(counts, 1):
            for _ in range(n):
                self.by_code[length, code] = symbols[at]
                code, at = code + 1, at + 1
            code <<= 1
        self.only = self.symbols[0] if len(self.symbols) == 1 and counts[0] == 1 else None


class Bits:
    def __init__(self, raw: bytes):
        self.bits = np.unpackbits(np.frombuffer(raw, np.uint8)).tolist()
        self.at = 0

    def bit(self) -> int:
        b = self.bits[self.at] if self.at < len(self.bits) else 0
        self.at += 1
        return b

    def take(self, n: int) -> int:
        v = 0
        for _ in range(n):
            v = v << 1 | self.bit()
        return v

    def symbol(self, codes: Codes) -> int:
        code = 0
        for length in range(1, 17):
            code = code << 1 | self.bit()
            got = codes.by_code.get((length, code))
            if got is not None:
                return got
        raise ValueError("no such Huffman code")

    def signed(self, n: int) -> int:
        v = self.take(n)
        return v if n == 0 or v >> (n - 1) else v - (1 << n) + 1


def _first_dc(blocks: list[tuple[int, np.ndarray]], bits: Bits, codes: dict[int, Codes], low: int) -> None:
    last = dict.fromkeys(codes, 0)
    for c, block in blocks:
        last[c] += bits.signed(bits.symbol(codes[c]))
        block[0] = last[c] << low


def _first_ac(blocks: list[np.ndarray], bits: Bits, codes: Codes, start: int, end: int, low: int) -> None:
    skip = 0
    for block in blocks:
        if skip:
            skip -= 1
            continue
        k = start
        while k <= end:
            run, size = divmod(bits.symbol(codes), 16)
            if size:
                k += run
                block[k] = bits.signed(size) * (1 << low)
                k += 1
            elif run == 15:
                k += 16
            else:
                skip = (1 << run) + bits.take(run) - 1
                break


def _refine_ac(blocks: list[np.ndarray], bits: Bits, codes: Codes, start: int, end: int, low: int) -> None:
    step, skip = 1 << low, 0

    def correct(block: np.ndarray, k: int) -> None:
        if bits.bit():
            block[k] += step if block[k] > 0 else -step

    for block in blocks:
        k = start
        if not skip:
            while k <= end:
                run, size = divmod(bits.symbol(codes), 16)
                if size == 0 and run < 15:
                    skip = (1 << run) + bits.take(run)
                    break
                value = 0
                if size:
                    value = step if bits.bit() else -step
                while k <= end:
                    if block[k]:
                        correct(block, k)
                    elif run == 0:
                        break
                    else:
                        run -= 1
                    k += 1
                if value and k <= end:
                    block[k] = value
                k += 1
        if skip:
            for j in range(k, end + 1):
                if block[j]:
                    correct(block, j)
            skip -= 1


def _fixed_ac(raw: bytes, plane: np.ndarray, codes: Codes, start: int, end: int, high: int, low: int) -> bool:
    """A scan of a fixed form as one array; False if it isn't of one. plane: rows x columns x 64."""
    if codes.only is None:
        return False
    rows, cols, _ = plane.shape
    width = end - start + 1
    if not high and 0 < codes.only < 8 and codes.only == 7:
        value = np.frombuffer(raw, np.uint8)
        if len(value) != rows * cols * width or (value & 128).any():
            return False
        value = value.astype(np.int32)
        plane[:, :, start : end + 1] = np.where(value >= 64, value, value - 127).reshape(rows, cols, width) << low
        return True
    if high and codes.only & 15 == 0 and codes.only < 0xF0:
        n = codes.only >> 4
        part = plane[:, :, start : end + 1]
        bits = np.unpackbits(np.frombuffer(raw, np.uint8))
        run = (1 << n) + int(np.packbits(np.r_[np.zeros(32 - n, np.uint8), bits[1 : 1 + n]]).view(">u4")[0]) if len(bits) > n else 0
        if bits[0] or run != rows * cols or not part.all() or len(bits) - 1 - n < part.size:
            return False
        add = bits[1 + n : 1 + n + part.size].astype(np.int32).reshape(part.shape) << low
        part += np.where(part > 0, add, -add)
        return True
    return False


def _restarts(data: bytes) -> list[bytes]:
    """The entropy-coded parts between restart markers, without stuffed zeros."""
    return [p.replace(b"\xff\x00", b"\xff") for p in re.split(rb"\xff[\xd0-\xd7]", data)]


def decode(jpeg: bytes, fixed: bool = True) -> Image:
    """The coefficient arrays (zigzag order) of all scans. fixed: take scans of a fixed form as arrays."""
    if jpeg[:2] != b"\xff\xd8":
        raise ValueError("not a JPEG file")
    at, image, restart = 2, None, 0
    tables: dict[int, Codes] = {}
    quantisation: dict[int, np.ndarray] = {}
    comment = b""
    while at < len(jpeg):
        marker = jpeg[at + 1]
        if marker == 0xFF:
            at += 1
            continue
        if marker == 0xD9:
            break
        size = int.from_bytes(jpeg[at + 2 : at + 4], "big")
        body = jpeg[at + 4 : at + 2 + size]
        at += 2 + size
        if marker == 0xFE:
            comment = body
        elif marker == 0xDB:
            while body:
                wide, number = body[0] >> 4, body[0] & 15
                n = 128 if wide else 64
                quantisation[number] = np.frombuffer(body[1 : 1 + n], ">u2" if wide else np.uint8).astype(np.int32)
                body = body[1 + n :]
        elif marker == 0xC4:
            while body:
                n = sum(body[1:17])
                tables[body[0]] = Codes(body[1:17], body[17 : 17 + n])
                body = body[17 + n :]
        elif marker == 0xDD:
            restart = int.from_bytes(body, "big")
        elif marker == 0xC2:
            height, width = int.from_bytes(body[1:3], "big"), int.from_bytes(body[3:5], "big")
            parts = [body[6 + 3 * i : 9 + 3 * i] for i in range(body[5])]
            image = Image(width, height, [Component(p[0], p[1] >> 4, p[1] & 15, p[2]) for p in parts], quantisation)
            image.lay_out()
        elif marker in (0xC0, 0xC1, 0xC3, *range(0xC5, 0xC8), *range(0xC9, 0xCC), *range(0xCD, 0xD0)):
            raise ValueError("not a progressive Huffman-coded file")
        elif marker == 0xDA:
            ended = SCAN_END.search(jpeg, at)
            data = jpeg[at : ended.start() if ended else len(jpeg)]
            at += len(data)
            n = body[0]
            chosen = [next(c for c in image.components if c.ident == body[1 + 2 * i]) for i in range(n)]
            which = {c.ident: body[2 + 2 * i] for i, c in enumerate(chosen)}
            start, end, high, low = body[1 + 2 * n], body[2 + 2 * n], body[3 + 2 * n] >> 4, body[3 + 2 * n] & 15
            _read_scan(image, chosen, which, tables, start, end, high, low, restart, data, fixed)
    if image is None:
        raise ValueError("no frame")
    image.comment = comment
    return image


def _read_scan(image: Image, chosen: list[Component], which: dict[int, int], tables: dict[int, Codes], start: int, end: int, high: int, low: int, restart: int, data: bytes, fixed: bool) -> None:
    parts = _restarts(data)
    if start == 0 and fixed and not restart:
        codes = [tables.get(which[c.ident] >> 4) for c in chosen]
        bits = np.unpackbits(np.frombuffer(parts[0], np.uint8))
        count = sum(c.h * c.v for c in chosen) * image.group_rows * image.group_cols if len(chosen) > 1 else chosen[0].rows * chosen[0].cols
        if not bits[:count].any() and (high or all(c is not None and c.only == 0 for c in codes)):
            return  # differences or corrections of 0 throughout
    if start and fixed and not restart and _fixed_ac(parts[0], chosen[0].coefficients[: chosen[0].rows, : chosen[0].cols], tables[0x10 | which[chosen[0].ident] & 15], start, end, high, low):
        return
    if len(chosen) == 1:
        c = chosen[0]
        order = [(c.ident, c.coefficients[y, x]) for y in range(c.rows) for x in range(c.cols)]
        groups = [[b] for b in order]
    else:
        groups = [
            [(c.ident, c.coefficients[gy * c.v + y, gx * c.h + x]) for c in chosen for y in range(c.v) for x in range(c.h)]
            for gy in range(image.group_rows) for gx in range(image.group_cols)
        ]
    every = restart or len(groups)
    for i, part in enumerate(parts):
        lot = [b for g in groups[i * every : (i + 1) * every] for b in g]
        bits = Bits(part)
        if start == 0 and high:
            for _, block in lot:
                block[0] |= bits.bit() << low
        elif start == 0:
            _first_dc(lot, bits, {c.ident: tables[which[c.ident] >> 4] for c in chosen}, low)
        elif high:
            _refine_ac([b for _, b in lot], bits, tables[0x10 | which[chosen[0].ident] & 15], start, end, low)
        else:
            _first_ac([b for _, b in lot], bits, tables[0x10 | which[chosen[0].ident] & 15], start, end, low)


def plane_samples(image: Image, c: Component) -> np.ndarray:
    """The component's samples, 0 to 255, over its padded blocks."""
    q = image.quantisation.get(c.table, np.ones(64, np.int32))
    flat = (c.coefficients * q).reshape(-1, 64)
    # sums of whole numbers: exact in float32 while they stay below 2^24, so in any order
    used = np.flatnonzero(flat.any(axis=0))
    kind = np.float32 if len(flat) and np.abs(flat).max(initial=0) * np.abs(BASIS[used]).sum(axis=0).max(initial=0) < 1 << 24 else np.float64
    sums = flat[:, used].astype(kind) @ BASIS[used].astype(kind)
    sums += SCALE // 2
    sums *= kind(1 / SCALE)
    np.floor(sums, out=sums)
    sums += 128
    np.clip(sums, 0, 255, out=sums)
    return sums.astype(np.uint8).reshape(c.padded_rows, c.padded_cols, 8, 8).transpose(0, 2, 1, 3).reshape(8 * c.padded_rows, 8 * c.padded_cols)


def upsampled(plane: np.ndarray, fy: int, fx: int) -> np.ndarray:
    return plane.repeat(fy, axis=0).repeat(fx, axis=1) if fy > 1 or fx > 1 else plane


def pixels(image: Image) -> np.ndarray:
    """height x width x 3, uint8: YCbCr to RGB in 16-bit fixed point; a single component gives grey."""
    hmax, vmax = max(c.h for c in image.components), max(c.v for c in image.components)
    planes = [plane_samples(image, c) for c in image.components]
    if len(planes) == 1:
        return np.repeat(planes[0][: image.height, : image.width, None], 3, axis=2)
    y = upsampled(planes[0], vmax // image.components[0].v, hmax // image.components[0].h)[: image.height, : image.width].astype(np.int16)
    cb, cr = (p.astype(np.int32) - 128 for p in planes[1:3])
    if cb.shape != cr.shape:
        cb, cr = (upsampled(p, vmax // c.v, hmax // c.h) for p, c in zip((cb, cr), image.components[1:3], strict=True))
        fy = fx = 1
    else:
        fy, fx = vmax // image.components[1].v, hmax // image.components[1].h
    # the chroma terms at their own resolution, then upsampled: 1.402, 0.344136, 0.714136 and 1.772 times 65536
    terms = ((91881 * cr + 32768) >> 16, -((22554 * cb + 46802 * cr + 32768) >> 16), (116130 * cb + 32768) >> 16)
    out = np.empty((image.height, image.width, 3), np.uint8)
    for i, t in enumerate(terms):
        wide = upsampled(t.astype(np.int16), fy, fx)[: image.height, : image.width]
        np.clip(y + wide, 0, 255, out=wide)
        out[:, :, i] = wide
    return out
