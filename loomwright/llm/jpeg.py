"""Baseline JPEG: a parser, a Huffman decoder on numpy lanes, and a writer of DC-only images.

Reading: markers are parsed (DQT, SOF0, DHT, DRI, SOS; others are skipped), each scan is cut at its restart
markers, and every restart interval of every image of a batch is a lane. All lanes of images with equal
tables and sampling decode their next symbol at the same time. AC coefficients are decoded only to be passed
over: what is kept is the DC of the luminance, so the result is the image at an eighth of its size.

Writing: ``encode`` stores bytes as a grey image whose 8 x 8 blocks are flat. With a DC quantizer of 8 the
quantized DC of a block of value v is v - 128 exactly, so the DC-only luminance that the reader rebuilds is
the stored bytes: the block is the sample of this format. A row of blocks is a restart interval.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

#: Samples (blocks) in a row, and rows in an image (its height is below 65536 pixels).
ROW, MAX_ROWS = 192, 8191
#: Code lengths and symbols of the DC table for luminance in the JPEG standard, Annex K (fixed values).
DC_BITS, DC_VALUES = (0, 1, 5, 1, 1, 1, 1, 1, 1, 0, 0, 0, 0, 0, 0, 0), tuple(range(12))
#: The AC table of flat blocks: the end of block alone, in one bit.
AC_BITS, AC_VALUES = (1, *[0] * 15), (0,)


def canonical(bits, values) -> list[tuple[int, int, int]]:
    """(symbol, code, length) of a table given as counts by length and symbols in order."""
    out, code, at = [], 0, 0
    for length, n in enumerate(bits, 1):
        for _ in range(n):
            out.append((values[at], code, length))
            code, at = code + 1, at + 1
        code <<= 1
    return out


def lookup(bits, values) -> np.ndarray:
    """For every 16 bits: symbol << 8 | length of the code they begin with (0: none)."""
    out = np.zeros(1 << 16, np.int32)
    for symbol, code, length in canonical(bits, values):
        out[code << (16 - length) : (code + 1) << (16 - length)] = symbol << 8 | length
    return out


# --- writing -------------------------------------------------------------------------------------


def _segment(marker: int, body: bytes) -> bytes:
    return bytes([0xFF, marker]) + (len(body) + 2).to_bytes(2, "big") + body


def header(rows: int) -> bytes:
    """Everything before the entropy-coded data of a grey image of ROW x ``rows`` blocks."""
    return b"".join(
        (
            b"\xff\xd8",
            _segment(0xDB, bytes([0, 8, *[1] * 63])),
            _segment(0xC0, bytes([8]) + (8 * rows).to_bytes(2, "big") + (8 * ROW).to_bytes(2, "big") + bytes([1, 1, 0x11, 0])),
            _segment(0xC4, bytes([0x00, *DC_BITS, *DC_VALUES])),
            _segment(0xC4, bytes([0x10, *AC_BITS, *AC_VALUES])),
            _segment(0xDD, ROW.to_bytes(2, "big")),
            _segment(0xDA, bytes([1, 1, 0x00, 0, 63, 0])),
        )
    )


def _difference_codes() -> tuple[np.ndarray, np.ndarray]:
    """Code and length of a block by its DC difference + 255: category, its bits, end of block."""
    dc = {s: (c, n) for s, c, n in canonical(DC_BITS, DC_VALUES)}
    codes, sizes = np.zeros(511, np.int64), np.zeros(511, np.int64)
    for d in range(-255, 256):
        size = abs(d).bit_length()
        code, n = dc[size]
        codes[d + 255] = (code << size | (d if d >= 0 else d + (1 << size) - 1)) << 1
        sizes[d + 255] = n + size + 1
    return codes, sizes


_CODES, _SIZES = _difference_codes()


def _entropy(rows: np.ndarray, last: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Stuffed data of all rows with restart markers, and each row's bytes. ``last``: no marker follows;
    ``number``: the row's place in its image."""
    value = rows.astype(np.int64) - 128
    diff = value.copy()
    diff[:, 1:] -= value[:, :-1]
    diff += 255
    size = _SIZES[diff]
    upto = np.cumsum(size, axis=1)
    n_bytes = -(-upto[:, -1] // 8)
    begin = np.cumsum(n_bytes) - n_bytes
    at = ((upto - size) + 8 * begin[:, None]).ravel()
    word = (_CODES[diff].ravel() << (24 - size.ravel() - (at & 7)))
    place, total = at >> 3, int(n_bytes.sum())
    out = np.zeros(total + 2)
    for k, shift in enumerate((16, 8, 0)):
        out += np.bincount(place + k, (word >> shift) & 255, total + 2)
    data = out[:total].astype(np.uint8)
    pad = 8 * n_bytes - upto[:, -1]
    data[begin + n_bytes - 1] |= ((1 << pad) - 1).astype(np.uint8)
    stuffed = np.flatnonzero(data == 255)
    marks = np.flatnonzero(~last)
    ends = begin + n_bytes
    # After each 0xFF a zero; after each row but an image's last its restart marker.
    extra = np.concatenate([stuffed + 1, np.repeat(ends[marks], 2)])
    what = np.concatenate([np.zeros(len(stuffed), np.uint8), np.column_stack([np.full(len(marks), 255), 0xD0 + number[marks] % 8]).astype(np.uint8).ravel()])
    order = np.argsort(extra, kind="stable")
    data = np.insert(data, extra[order], what[order])
    row_of = np.searchsorted(begin, stuffed, side="right") - 1
    return data, n_bytes + np.bincount(row_of, minlength=len(rows)) + 2 * ~last


def encode(payloads: list[bytes]) -> list[bytes]:
    """Each payload (its length a positive multiple of ROW) as one JPEG, or as several in a row if it has
    more rows than an image can have."""
    rows = [len(p) // ROW for p in payloads]
    number = np.concatenate([np.arange(n) % MAX_ROWS for n in rows])
    final = np.zeros(len(number), bool)
    final[np.cumsum(rows) - 1] = True
    last = final | (number == MAX_ROWS - 1)
    data, size = _entropy(np.frombuffer(b"".join(payloads), np.uint8).reshape(-1, ROW), last, number)
    raw, ends = data.tobytes(), np.cumsum(size)
    images, begin = [], 0
    for k in np.flatnonzero(last):
        images.append(header(int(number[k]) + 1) + raw[begin : ends[k]] + b"\xff\xd9")
        begin = ends[k]
    out = iter(images)
    return [b"".join(next(out) for _ in range(-(-n // MAX_ROWS))) for n in rows]


# --- reading -------------------------------------------------------------------------------------


@dataclass
class Image:
    """One parsed image: what its lanes need, and where its data lies."""

    width: int = 0
    height: int = 0
    components: list[tuple[int, int, int, int]] = field(default_factory=list)  # id, h, v, quantizer
    quantizers: dict[int, int] = field(default_factory=dict)  # the DC entry of each table
    tables: dict[int, tuple[bytes, bytes]] = field(default_factory=dict)  # class << 4 | id
    scan: list[tuple[int, int, int]] = field(default_factory=list)  # component id, DC, AC table
    restart: int = 0
    begin: int = 0
    end: int = 0

    def blocks(self) -> list[int]:
        """Components of the blocks of an MCU, as places in ``scan``."""
        if len(self.scan) == 1:
            return [0]
        size = {c: h * v for c, h, v, _ in self.components}
        return [k for k, (c, _, _) in enumerate(self.scan) for _ in range(size[c])]

    def luminance(self) -> tuple[int, int]:
        """Factors of the first component (1, 1 if it is alone)."""
        return (1, 1) if len(self.scan) == 1 else self.components[0][1:3]

    def grid(self) -> tuple[int, int]:
        """MCUs in a row, and rows."""
        h, v = (1, 1) if len(self.scan) == 1 else (max(c[1] for c in self.components), max(c[2] for c in self.components))
        return -(-self.width // (8 * h)), -(-self.height // (8 * v))

    def key(self) -> tuple:
        return tuple((*c[1:], self.quantizers.get(c[3])) for c in self.components), tuple(self.scan), tuple(sorted(self.tables.items()))


def parse(data: bytes, at: int = 0) -> tuple[Image, int]:
    """The image that begins at ``at``, and where it ends. Raises ValueError for what isn't baseline JPEG."""
    if data[at : at + 2] != b"\xff\xd8":
        raise ValueError("no start of image")
    image, at = Image(), at + 2
    while True:
        if at + 4 > len(data) or data[at] != 0xFF:
            raise ValueError("no marker where one is due")
        marker = data[at + 1]
        if marker == 0xFF:
            at += 1
            continue
        size = int.from_bytes(data[at + 2 : at + 4], "big")
        body, at = data[at + 4 : at + 2 + size], at + 2 + size
        if marker == 0xDB:
            k = 0
            while k < len(body):
                wide = body[k] >> 4
                image.quantizers[body[k] & 15] = int.from_bytes(body[k + 1 : k + 2 + wide], "big")
                k += 1 + 64 * (1 + wide)
        elif marker == 0xC0:
            image.height, image.width = int.from_bytes(body[1:3], "big"), int.from_bytes(body[3:5], "big")
            image.components = [(body[k], body[k + 1] >> 4, body[k + 1] & 15, body[k + 2]) for k in range(6, 6 + 3 * body[5], 3)]
        elif marker in (0xC1, 0xC2, 0xC3, *range(0xC5, 0xC8), *range(0xC9, 0xCC), *range(0xCD, 0xD0)):
            raise ValueError("not a baseline image")
        elif marker == 0xC4:
            k = 0
            while k < len(body):
                n = sum(body[k + 1 : k + 17])
                image.tables[body[k]] = bytes(body[k + 1 : k + 17]), bytes(body[k + 17 : k + 17 + n])
                k += 17 + n
        elif marker == 0xDD:
            image.restart = int.from_bytes(body[:2], "big")
        elif marker == 0xDA:
            image.scan = [(body[k], body[k + 1] >> 4, body[k + 1] & 15) for k in range(1, 1 + 2 * body[0], 2)]
            break
    image.begin = at
    while True:
        at = data.find(b"\xff", at)
        if at < 0 or at + 1 >= len(data):
            raise ValueError("the scan does not end")
        if data[at + 1] == 0 or 0xD0 <= data[at + 1] <= 0xD7:
            at += 2
            continue
        image.end = at
        break
    while data[at : at + 2] != b"\xff\xd9":  # what follows the first scan is passed over
        at = data.find(b"\xff\xd9", at)
        if at < 0:
            raise ValueError("no end of image")
    return image, at + 2


def parse_fast(data: bytes, at: int, known: dict[bytes, Image]) -> tuple[Image, int]:
    """``parse``, but headers that were seen before are copied, and the scan's end is the next EOI marker
    (in a scan a 0xFF is followed by 0 or a restart marker, so EOI cannot occur inside)."""
    stop = data.find(b"\xff\xda", at)
    head = data[at : stop + 10]
    if stop < 0 or head not in known:
        image, end = parse(data, at)
        if stop >= 0 and image.begin == stop + 10:
            known[head] = image
        return image, end
    old = known[head]
    end = data.find(b"\xff\xd9", stop)
    if end < 0:
        raise ValueError("no end of image")
    return Image(old.width, old.height, old.components, old.quantizers, old.tables, old.scan, old.restart, stop + 10, end), end + 2


def dc_images(data: bytes, images: list[Image]) -> list[np.ndarray]:
    """The DC-only luminance of each image (uint8, one value for each block within the image)."""
    out: list[np.ndarray | None] = [None] * len(images)
    kinds: dict[tuple, list[int]] = {}
    for i, image in enumerate(images):
        kinds.setdefault(image.key(), []).append(i)
    for same in kinds.values():
        for i, plane in zip(same, _decode(data, [images[i] for i in same])):
            out[i] = plane
    return out  # type: ignore[return-value]


def _decode(data: bytes, images: list[Image]) -> list[np.ndarray]:
    first = images[0]
    pattern = first.blocks()
    raw = np.concatenate([np.frombuffer(data, np.uint8, i.end - i.begin, i.begin) for i in images])
    scan_begin = np.cumsum([0] + [i.end - i.begin for i in images])
    # Restart markers cut the scans into lanes; the zeros after 0xFF go.
    ff = np.flatnonzero(raw[:-1] == 255)
    mark = ff[(raw[ff + 1] >= 0xD0) & (raw[ff + 1] <= 0xD7)]
    keep = np.ones(len(raw), bool)
    keep[ff[raw[ff + 1] == 0] + 1] = False
    keep[mark] = keep[mark + 1] = False
    starts = np.unique(np.concatenate([scan_begin[:-1], mark + 2]))
    moved = np.concatenate([[0], np.cumsum(keep)])
    lane_byte = moved[starts]
    raw = np.concatenate([raw[keep], np.full(8, 255, np.uint8)]).astype(np.uint32)
    word = (raw[:-3] << 24) | (raw[1:-2] << 16) | (raw[2:-1] << 8) | raw[3:]
    lane_image = np.searchsorted(scan_begin, starts, side="right") - 1
    lane_in_image = np.arange(len(starts)) - np.searchsorted(lane_image, np.arange(len(images)))[lane_image]
    mcus = np.array([i.grid()[0] * i.grid()[1] for i in images])
    step = np.array([i.restart or m for i, m in zip(images, mcus)])
    lane_mcus = np.clip(mcus[lane_image] - lane_in_image * step[lane_image], 0, step[lane_image])
    lumas = sum(k == 0 for k in pattern)
    out_begin = np.concatenate([[0], np.cumsum(mcus * lumas)])
    lane_out = out_begin[lane_image] + lane_in_image * step[lane_image] * lumas
    result = np.zeros(out_begin[-1], np.int32)

    dc = [lookup(*first.tables[d]) for _, d, _ in first.scan]
    ac = [lookup(*first.tables[16 | a]) for _, _, a in first.scan]
    bit = 8 * lane_byte.astype(np.int64)
    predicted = np.zeros((len(first.scan), len(bit)), np.int32)
    live = np.flatnonzero(lane_mcus > 0)
    for m in range(int(lane_mcus.max(initial=0))):
        live = live[lane_mcus[live] > m]
        luma = 0
        for k in pattern:
            at = bit[live]
            got = dc[k][(word[at >> 3] >> (16 - (at & 7)).astype(np.uint32)) & 0xFFFF]
            if not got.all():
                raise ValueError("a code that no table has")
            size = got >> 8
            at = at + (got & 255)
            more = (word[at >> 3].astype(np.int64) >> (32 - (at & 7) - size)) & ((1 << size) - 1)
            diff = np.where(more >> np.maximum(size - 1, 0) == 0, more - (1 << size) + 1, more)
            value = predicted[k][live] + np.where(size == 0, 0, diff)
            predicted[k][live] = value
            if k == 0:
                result[lane_out[live] + m * lumas + luma] = value
                luma += 1
            at = at + size
            # AC: pass over runs and their bits until each block ends.
            todo, place = np.arange(len(live)), np.zeros(len(live), np.int64)
            while len(todo):
                here = at[todo]
                got = ac[k][(word[here >> 3] >> (16 - (here & 7)).astype(np.uint32)) & 0xFFFF]
                if not got.all():
                    raise ValueError("a code that no table has")
                symbol = got >> 8
                at[todo] = here + (got & 255) + (symbol & 15)
                if not symbol.any():
                    break
                place[todo] += (symbol >> 4) + 1
                todo = todo[(symbol != 0) & (place[todo] < 63)]
            bit[live] = at
    planes = []
    for i, image in enumerate(images):
        q = image.quantizers[next(c[3] for c in image.components if c[0] == image.scan[0][0])]
        h, v = image.luminance()
        across, down = image.grid()
        dcs = result[out_begin[i] : out_begin[i + 1]].reshape(down, across, v, h).transpose(0, 2, 1, 3).reshape(down * v, across * h)
        values = np.clip(np.rint(dcs * q / 8).astype(np.int64) + 128, 0, 255).astype(np.uint8)
        fh, fv = (1, 1) if len(image.scan) == 1 else (max(c[1] for c in image.components), max(c[2] for c in image.components))
        planes.append(values[: -(-image.height * v // (8 * fv)), : -(-image.width * h // (8 * fh))])
    return planes


def average_hash(plane: np.ndarray, side: int = 8) -> str:
    """64 bits in hex: which cells of a side x side grid are brighter than the mean of all cells."""
    h, w = plane.shape
    r0, c0 = np.arange(side) * h // side, np.arange(side) * w // side
    r1, c1 = np.maximum(r0 + 1, (np.arange(side) + 1) * h // side), np.maximum(c0 + 1, (np.arange(side) + 1) * w // side)
    table = np.zeros((h + 1, w + 1), np.int64)
    table[1:, 1:] = plane.cumsum(axis=0, dtype=np.int64).cumsum(axis=1)
    total = table[np.ix_(r1, c1)] - table[np.ix_(r0, c1)] - table[np.ix_(r1, c0)] + table[np.ix_(r0, c0)]
    area = (r1 - r0)[:, None] * (c1 - c0)
    mean = total / area
    return np.packbits((mean > mean.mean()).ravel()).tobytes().hex()
