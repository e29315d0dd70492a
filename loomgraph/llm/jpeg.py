"""Progressive JPEG in numpy: a decoder for any baseline-precision progressive file, and an encoder that carries bytes in coefficients.

The decoder accumulates spectral-selection and successive-approximation scans into one array of coefficients for each component. Runs that have a
regular form (all differences 0, all coefficients of one size, correction bits of an end-of-band run) are taken as whole bit arrays; everything
else goes symbol by symbol.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from functools import cached_property, lru_cache

import numpy as np


def _zigzag() -> np.ndarray:
    """Row-major place of each zigzag index: diagonals, up and down by turns."""
    cells = sorted(((r, c) for r in range(8) for c in range(8)), key=lambda x: (sum(x), x[0] if sum(x) % 2 else x[1]))
    return np.array([r * 8 + c for r, c in cells])


ZIGZAG = _zigzag()
_SCALE = 12
_DCT = np.array([[np.cos((2 * x + 1) * u * np.pi / 16) * (np.sqrt(0.125) if u == 0 else 0.5) for x in range(8)] for u in range(8)])
#: Whole numbers in floats: every sum stays under 2^53, so results do not depend on the order of additions.
_DCT_INT = np.rint(_DCT * (1 << _SCALE))
_MARKER = re.compile(rb"\xff[^\x00\xd0-\xd7\xff]")
_RESTART = re.compile(rb"\xff[\xd0-\xd7]")


@dataclass
class Component:
    ident: int
    h: int
    v: int
    table: int
    rows: int = 0  # of blocks that hold image
    cols: int = 0
    wide: int = 0  # blocks in a row, with the padding of whole MCUs
    coefs: np.ndarray = field(default_factory=lambda: np.zeros((0, 64), np.int32))
    order: np.ndarray | None = None  # of its blocks in a scan of its own


class _Bits:
    """One entropy-coded segment."""

    def __init__(self, data: bytes):
        self.bytes = np.frombuffer(data.replace(b"\xff\x00", b"\xff") if b"\xff" in data else data, np.uint8)
        self.at = 0

    @cached_property
    def bits(self) -> np.ndarray:
        return np.unpackbits(self.bytes)

    def take(self, n: int) -> int:
        v = 0
        for b in self.bits[self.at : self.at + n]:
            v = v << 1 | int(b)
        self.at += n
        return v

    def symbol(self, codes: dict[tuple[int, int], int]) -> int:
        code = 0
        for size in range(1, 17):
            code = code << 1 | int(self.bits[self.at])
            self.at += 1
            if (size, code) in codes:
                return codes[size, code]
        raise ValueError("no such Huffman code")


@lru_cache(maxsize=64)
def _codes(counts: bytes, symbols: bytes) -> dict[tuple[int, int], int]:
    out, code, i = {}, 0, 0
    for size, n in enumerate(counts, 1):
        for _ in range(n):
            out[size, code] = symbols[i]
            code, i = code + 1, i + 1
        code <<= 1
    return out


def _extend(v: np.ndarray | int, size: int):
    return np.where(v < 1 << (size - 1), v - (1 << size) + 1, v)


def _ac_first(b: _Bits, coefs: np.ndarray, where: np.ndarray, codes: dict, start: int, end: int, low: int) -> None:
    only, band, n = codes.get((1, 0)), end - start + 1, len(where)
    if only is not None and only >> 4 == 0 and only:
        stride = only + 1
        if stride == 8 and b.at == 0 and len(b.bytes) >= n * band:
            raw = b.bytes[: n * band].astype(np.int32)
            if not (raw & 128).any():
                coefs[where, start : end + 1] = ((raw - 127 * (raw < 64)) << low).reshape(n, band)
                b.at += 8 * n * band
                return
        part = b.bits[b.at : b.at + n * band * stride]
        if len(part) == n * band * stride:
            grid = part.reshape(-1, stride)
            if not grid[:, 0].any():
                value = grid[:, 1:] @ (1 << np.arange(only - 1, -1, -1))
                coefs[where, start : end + 1] = (_extend(value, only) << low).reshape(n, band)
                b.at += len(part)
                return
    run = 0
    for block in where:
        if run:
            run -= 1
            continue
        k = start
        while k <= end:
            s = b.symbol(codes)
            skip, size = s >> 4, s & 15
            if size:
                k += skip
                coefs[block, k] = int(_extend(b.take(size), size)) << low
                k += 1
            elif skip == 15:
                k += 16
            else:
                run = (1 << skip) - 1 + b.take(skip)
                break


def _correct(b: _Bits, coefs: np.ndarray, blocks: np.ndarray, lo: int, end: int, low: int) -> None:
    """A correction bit for each coefficient that has a value already, in order."""
    if lo > end or not len(blocks):
        return
    part = coefs[blocks, lo : end + 1]
    n = int(np.count_nonzero(part))
    bits = b.bits[b.at : b.at + n].astype(np.int32) << low
    if n == part.size:
        bits = bits.reshape(part.shape)
        coefs[blocks, lo : end + 1] = part + np.where(part > 0, bits, -bits)
    elif n:
        known = part != 0
        part[known] += np.sign(part[known]) * bits
        coefs[blocks, lo : end + 1] = part
    b.at += n


def _ac_refine(b: _Bits, coefs: np.ndarray, where: np.ndarray, codes: dict, start: int, end: int, low: int) -> None:
    i = 0
    while i < len(where):
        k, block = start, where[i]
        while True:
            if k > end:
                i += 1
                break
            s = b.symbol(codes)
            skip, size = s >> 4, s & 15
            if not size and skip < 15:
                run = (1 << skip) + b.take(skip)
                if k == start:
                    _correct(b, coefs, where[i : i + run], start, end, low)
                else:
                    _correct(b, coefs, where[i : i + 1], k, end, low)
                    _correct(b, coefs, where[i + 1 : i + run], start, end, low)
                i += run
                break
            new = (1 if b.take(1) else -1) if size else 0
            while k <= end:
                if coefs[block, k]:
                    if b.take(1):
                        coefs[block, k] += (1 << low) * (1 if coefs[block, k] > 0 else -1)
                elif skip == 0:
                    if new:
                        coefs[block, k] = new << low if new > 0 else -(1 << low)
                    k += 1
                    break
                else:
                    skip -= 1
                k += 1


class Image:
    """A parsed file: components with coefficients in zigzag order, quantisation tables, comments."""

    def __init__(self, data: bytes):
        self.tables: dict[int, np.ndarray] = {}
        self.comments: list[bytes] = []
        self.components: list[Component] = []
        huff: dict[int, dict] = {}
        every, at = 0, 2
        if data[:2] != b"\xff\xd8":
            raise ValueError("no JPEG file")
        while True:
            at = data.index(b"\xff", at) + 1
            kind = data[at]
            at += 1
            if kind == 0xD9:
                break
            size = int.from_bytes(data[at : at + 2])
            body = data[at + 2 : at + size]
            at += size
            if kind == 0xDB:
                while body:
                    wide = body[0] >> 4
                    self.tables[body[0] & 15] = np.frombuffer(body[1 : 65 + 64 * wide], ">u2" if wide else np.uint8).astype(np.int32)
                    body = body[65 + 64 * wide :]
            elif kind == 0xC4:
                while body:
                    n = sum(body[1:17])
                    huff[body[0]] = _codes(body[1:17], body[17 : 17 + n])
                    body = body[17 + n :]
            elif kind == 0xDD:
                every = int.from_bytes(body)
            elif kind == 0xFE:
                self.comments.append(body)
            elif kind == 0xC2:
                self._frame(body)
            elif kind in (0xC0, 0xC1, 0xC3, *range(0xC5, 0xC8), *range(0xC9, 0xCC), *range(0xCD, 0xD0)):
                raise ValueError("not a progressive Huffman file")
            elif kind == 0xDA:
                end = _MARKER.search(data, at)
                stop = end.start() if end else len(data)
                self._scan(body, data[at:stop], huff, every)
                at = stop

    def _frame(self, body: bytes) -> None:
        if body[0] != 8:
            raise ValueError("8 bits a sample are read")
        self.height, self.width = int.from_bytes(body[1:3]), int.from_bytes(body[3:5])
        self.components = [Component(body[i], body[i + 1] >> 4, body[i + 1] & 15, body[i + 2]) for i in range(6, 6 + 3 * body[5], 3)]
        self.hmax, self.vmax = max(c.h for c in self.components), max(c.v for c in self.components)
        self.mcu_rows, self.mcu_cols = -(-self.height // (8 * self.vmax)), -(-self.width // (8 * self.hmax))
        for c in self.components:
            c.rows, c.cols = -(-(-(-self.height * c.v // self.vmax)) // 8), -(-(-(-self.width * c.h // self.hmax)) // 8)
            c.wide = self.mcu_cols * c.h
            c.coefs = np.zeros((self.mcu_rows * c.v * c.wide, 64), np.int32)

    def _scan(self, body: bytes, data: bytes, huff: dict[int, dict], every: int) -> None:
        chosen = [(next(c for c in self.components if c.ident == body[1 + 2 * i]), body[2 + 2 * i]) for i in range(body[0])]
        start, end, approx = body[-3:]
        high, low = approx >> 4, approx & 15
        if len(chosen) == 1:
            c = chosen[0][0]
            if c.order is None:
                c.order = (np.arange(c.rows)[:, None] * c.wide + np.arange(c.cols)).reshape(-1, 1)
            orders = [c.order]
        else:
            r, q = np.divmod(np.arange(self.mcu_rows * self.mcu_cols), self.mcu_cols)
            orders = [(((r * c.v)[:, None, None] + np.arange(c.v)[:, None]) * c.wide + (q * c.h)[:, None, None] + np.arange(c.h)).reshape(len(r), -1) for c, _ in chosen]
        units = len(orders[0])
        parts = _RESTART.split(data) if every else [data]
        for i, part in enumerate(parts):
            lo, hi = (i * every, min(units, (i + 1) * every)) if every else (0, units)
            bits = _Bits(part)
            where = [o[lo:hi] for o in orders]
            if start == 0:
                self._dc(bits, chosen, where, huff, high, low)
            elif high == 0:
                _ac_first(bits, chosen[0][0].coefs, where[0].ravel(), huff[0x10 | chosen[0][1] & 15], start, end, low)
            else:
                _ac_refine(bits, chosen[0][0].coefs, where[0].ravel(), huff[0x10 | chosen[0][1] & 15], start, end, low)

    @staticmethod
    def _dc(b: _Bits, chosen: list, where: list[np.ndarray], huff: dict[int, dict], high: int, low: int) -> None:
        wide = [w.shape[1] for w in where]
        total = sum(wide) * len(where[0])
        if high:
            grid = b.bits[b.at : b.at + total].astype(np.int32).reshape(len(where[0]), -1)
            for (c, _), w, at in zip(chosen, where, np.cumsum([0, *wide]), strict=False):
                c.coefs[w, 0] |= grid[:, at : at + w.shape[1]] << low
            return
        codes = [huff[t >> 4] for _, t in chosen]
        if all(x.get((1, 0)) == 0 for x in codes) and not b.bits[:total].any():
            return  # no difference anywhere
        last = [0] * len(chosen)
        for u in range(len(where[0])):
            for i, (c, _) in enumerate(chosen):
                for block in where[i][u]:
                    if size := b.symbol(codes[i]):
                        last[i] += int(_extend(b.take(size), size))
                    c.coefs[block, 0] = last[i] << low

    def plane(self, c: Component, step: int = 4096) -> np.ndarray:
        """Samples of a component: dequantised, inverse-transformed."""
        out = np.empty((len(c.coefs), 8, 8), np.uint8)
        q = self.tables[c.table]
        for at in range(0, len(c.coefs), step):
            some = np.zeros((min(step, len(c.coefs) - at), 64))
            some[:, ZIGZAG] = c.coefs[at : at + step] * q
            x = (some.reshape(-1, 8) @ _DCT_INT).reshape(-1, 8, 8).transpose(0, 2, 1).reshape(-1, 8) @ _DCT_INT
            x = np.floor((x + (1 << (2 * _SCALE - 1))) / (1 << 2 * _SCALE)) + 128
            out[at : at + step] = np.clip(x, 0, 255).reshape(-1, 8, 8).transpose(0, 2, 1)
        return out.reshape(-1, c.wide, 8, 8).transpose(0, 2, 1, 3).reshape(-1, c.wide * 8)

    def rgb(self) -> np.ndarray:
        """The image at full resolution, (height, width, 3); chroma is repeated."""
        full = []
        for c in self.components:
            p = self.plane(c)
            up, across = self.vmax // c.v, self.hmax // c.h
            p = p.repeat(up, 0) if up > 1 else p
            full.append((p.repeat(across, 1) if across > 1 else p)[: self.height, : self.width])
        if len(full) == 1:
            return np.repeat(full[0][:, :, None], 3, 2)
        y, cb, cr = (x.astype(np.int32) for x in full)
        cb, cr = cb - 128, cr - 128
        out = np.empty((*y.shape, 3), np.uint8)
        # fixed values: 1.402, 0.344136, 0.714136, 1.772 in 16 bits
        for i, add in enumerate((91881 * cr, -22554 * cb - 46802 * cr, 116130 * cb)):
            np.clip(y + ((add + 32768) >> 16), 0, 255, out=add)
            out[:, :, i] = add
        return out


def _segment(kind: int, body: bytes) -> bytes:
    return bytes((0xFF, kind)) + (len(body) + 2).to_bytes(2) + body


def _scan_head(components: tuple[int, ...], start: int, end: int, high: int, low: int) -> bytes:
    return _segment(0xDA, bytes((len(components), *(x for c in components for x in (c, 0)), start, end, high << 4 | low)))


def _packed(bits: np.ndarray) -> bytes:
    pad = -len(bits) % 8
    return np.packbits(np.concatenate((bits, np.ones(pad, np.uint8)))).tobytes().replace(b"\xff", b"\xff\x00")


#: One code of one bit for (run 0, size 7), fifteen of five bits for the runs of bands' ends.
_AC_TABLE = bytes((0x10, 1, 0, 0, 0, 15, *[0] * 11, 0x07, *range(0, 0xF0, 0x10)))
_DC_TABLE = bytes((0x00, 1, *[0] * 15, 0x00))
_SLOTS = 63


def carry(payload: bytes) -> bytes:
    """A progressive 4:2:0 file whose quantised AC coefficients hold the payload: byte v is the coefficient of size 8 with the extra bits v.

    The scans: DC; for each component AC 1 to 5 and 6 to 63 without the last bit, then that bit for 1 to 63. A comment has the payload's length.
    """
    mcus = max(1, -(-len(payload) // (6 * _SLOTS)))
    cols = min(mcus, max(1, int(np.sqrt(mcus))))
    rows = -(-mcus // cols)
    unit = rows * cols
    v = np.full(unit * 6 * _SLOTS, 255, np.uint8)
    v[: len(payload)] = np.frombuffer(payload, np.uint8)
    v = v.reshape(-1, _SLOTS)
    frame = b"\x08" + (rows * 16).to_bytes(2) + (cols * 16).to_bytes(2) + bytes((3, 1, 0x22, 0, 2, 0x11, 0, 3, 0x11, 0))
    out = [b"\xff\xd8", _segment(0xFE, len(payload).to_bytes(8)), _segment(0xDB, b"\x00" + b"\x01" * 64), _segment(0xC2, frame), _segment(0xC4, _DC_TABLE), _segment(0xC4, _AC_TABLE)]
    out += [_scan_head((1, 2, 3), 0, 0, 0, 0), _packed(np.zeros(unit * 6, np.uint8))]
    parts = (v[: 4 * unit], v[4 * unit : 5 * unit], v[5 * unit :])
    for ident, part in enumerate(parts, 1):
        half = part >> 1  # the code 0 and the upper seven bits
        out += [_scan_head((ident,), 1, 5, 0, 1), half[:, :5].tobytes(), _scan_head((ident,), 6, 63, 0, 1), half[:, 5:].tobytes()]
    for ident, part in enumerate(parts, 1):
        last = np.where(part >= 128, part & 1, 1 - (part & 1)).astype(np.uint8)  # of the magnitude
        bits = []
        for at in range(0, len(part), 32767):
            n = min(32767, len(part) - at)
            power = n.bit_length() - 1
            head = (1 << 4 | power) << power | n - (1 << power)
            bits += [np.array([int(x) for x in f"{head:0{5 + power}b}"], np.uint8), last[at : at + n].ravel()]
        out += [_scan_head((ident,), 1, 63, 1, 0), _packed(np.concatenate(bits))]
    return b"".join([*out, b"\xff\xd9"])


def carried(image: Image) -> bytes:
    """The payload of a file of carry()."""
    size = int.from_bytes(image.comments[0])
    c = np.concatenate([x.coefs[:, 1:] for x in image.components])
    return np.where(c > 0, c, c + 255).astype(np.uint8).tobytes()[:size]
