"""FLAC coding of 8-bit mono streams in numpy, many frames at a time.

The format is that of RFC 9639. Encoding picks for every frame the smallest of
a constant, verbatim, fixed-predictor or linear-prediction subframe, writes
Rice-coded residuals, frame checksums, and a seek table with one point a frame.
Decoding reads Rice residuals (both parameter widths, any partition order,
escaped partitions) and linear predictors for all frames of a chunk in step:
step ``t`` reads one codeword of every frame that still has samples. Header,
frame and stream checksums are verified.
"""

from __future__ import annotations

from functools import lru_cache
from hashlib import md5

import numpy as np

FRAME = 1024
#: Frames coded together: what one pass holds is bounded by it (about 75 MB).
FRAMES_AT_ONCE = 1024
RATE = 8000
LPC_ORDER = 4
LPC_BITS = 12
#: Coefficients of the format's fixed predictors, by order.
FIXED = ([], [1], [2, -1], [3, -3, 1], [4, -6, 4, -1])


def _crc_table(poly: int, bits: int) -> np.ndarray:
    top, mask = 1 << (bits - 1), (1 << bits) - 1
    table = []
    for byte in range(256):
        c = byte << (bits - 8)
        for _ in range(8):
            c = (c << 1 ^ poly) & mask if c & top else c << 1 & mask
        table.append(c)
    return np.array(table, np.int64)


CRC8, CRC16 = _crc_table(0x07, 8), _crc_table(0x8005, 16)
_CRC8 = CRC8.tolist()


def crc8(data: bytes) -> int:
    c = 0
    for b in data:
        c = _CRC8[c ^ b]
    return c


def crc16(flat: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Checksums of slices of a byte array, all slices in step."""
    order = np.argsort(-size, kind="stable")
    at, left = start[order], size[order]
    c = np.zeros(len(at), np.int64)
    live = np.searchsorted(-left, -np.arange(int(left[0]) if len(left) else 0), side="left")
    for t, n in enumerate(live.tolist()):
        own = c[:n]
        c[:n] = (own << 8 & 0xFFFF) ^ CRC16[own >> 8 ^ flat[at[:n] + t]]
    out = np.empty_like(c)
    out[order] = c
    return out


@lru_cache(100_000)
def _header(number: int, size: int) -> bytes:
    """Frame header with its checksum."""
    if number < 0x80:
        coded = bytes([number])
    else:
        n = next(i for i in range(2, 8) if number < 1 << (5 * i + 1))
        tail = [0x80 | number >> 6 * i & 0x3F for i in range(n - 1)][::-1]
        coded = bytes([(0xFF << (8 - n) & 0xFF) | number >> 6 * (n - 1), *tail])
    head = bytes([0xFF, 0xF8, 0x70, 0x02]) + coded + (size - 1).to_bytes(2, "big")
    return head + bytes([crc8(head)])


def _predictors(x: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Quantised linear predictors of every row: coefficients and shifts."""
    order = LPC_ORDER
    f = x.astype(np.float64)
    r = np.stack([np.einsum("ij,ij->i", f[:, lag:], f[:, : x.shape[1] - lag]) for lag in range(order + 1)], 1)
    r[:, 0] += 1e-3 + 1e-9 * r[:, 0]
    a = np.zeros((len(x), order + 1))
    a[:, 0] = 1
    error = r[:, 0].copy()
    for i in range(1, order + 1):
        k = -np.einsum("ij,ij->i", a[:, :i], r[:, i:0:-1]) / error
        a[:, 1 : i + 1] += k[:, None] * a[:, i - 1 :: -1][:, :i] if i > 1 else k[:, None] * a[:, :1]
        error *= np.maximum(1 - k * k, 1e-9)
    c = -a[:, 1:]
    most = np.maximum(np.abs(c).max(1), 1e-9)
    shift = np.clip(LPC_BITS - 2 - np.ceil(np.log2(most)).astype(np.int64), 0, 15)
    limit = 2 ** (LPC_BITS - 1)
    return np.clip(np.rint(c * 2.0 ** shift[:, None]), -limit, limit - 1).astype(np.int64), shift


def _residuals(x: np.ndarray, coefficients: np.ndarray, shift: np.ndarray) -> np.ndarray:
    order = coefficients.shape[1]
    guess = np.zeros((len(x), x.shape[1] - order), np.int32)
    for j in range(order):
        guess += coefficients[:, j : j + 1].astype(np.int32) * x[:, order - 1 - j : x.shape[1] - 1 - j]
    return x[:, order:] - (guess >> shift[:, None].astype(np.int32))


def _encode_some(x: np.ndarray, size: np.ndarray, number: np.ndarray) -> list[bytes]:
    """Coded frames of rows ``x`` (int32, padded with zeros) of ``size`` samples."""
    n, width = x.shape
    inside = np.arange(width) < size[:, None]
    best = 8 + 8 * size  # verbatim
    kind = np.full(n, 1)
    constant = ((x == x[:, :1]) | ~inside).all(1)
    best[constant], kind[constant] = 16, 0
    rice = np.zeros(n, np.int64)
    code = np.zeros((n, width), np.int32)
    lpc, lpc_shift = _predictors(x, size)
    choices = [(8 + o, np.tile(np.array(FIXED[o], np.int64), (n, 1)), np.zeros(n, np.int64)) for o in (1, 2)]
    choices.append((31 + LPC_ORDER, lpc, lpc_shift))
    for tag, coefficients, shift in choices:
        order = coefficients.shape[1]
        rest = _residuals(x, coefficients, shift)
        folded = np.where(inside[:, order:], (rest << 1) ^ (rest >> 31), 0)
        count = np.maximum(size - order, 1)
        k = np.clip(np.ceil(np.log2(np.maximum(folded.sum(1, dtype=np.int64) / count * 0.7, 1e-9))), 0, 14).astype(np.int64)
        params = 8 + 8 * order + 10 + ((9 + LPC_BITS * order) if tag > 31 else 0)
        for k in (k, np.maximum(k - 1, 0)):
            bits = params + (size - order) * (1 + k) + (folded >> k[:, None].astype(np.int32)).sum(1, dtype=np.int64)
            won = (bits < best) & (size > order)
            best[won], kind[won], rice[won] = bits[won], tag, k[won]
            code[won, order:] = folded[won]
    # Bits of all frames are laid out one after the other and summed into bytes.
    heads = [_header(a, b) for a, b in zip(number.tolist(), size.tolist())]
    head_size = np.fromiter(map(len, heads), np.int64, n)
    frame_size = head_size + (best + 7) // 8 + 2
    begin = np.cumsum(frame_size) - frame_size
    flat_size = int(frame_size.sum())
    ends, values = [], []

    def put(rows: np.ndarray, end: np.ndarray, value: np.ndarray) -> None:
        ends.append((8 * (begin + head_size))[rows] + end)
        values.append(value)

    every = np.arange(n)
    put(every, np.full(n, 8), kind << 1)
    row = np.flatnonzero(kind == 0)
    put(row, np.full(len(row), 16), x[row, 0] & 255)
    row, col = np.nonzero(inside & (kind == 1)[:, None])
    put(row, 16 + 8 * col, x[row, col] & 255)
    coded = kind > 1
    order = np.where(kind > 31, kind - 31, np.where(coded, kind - 8, 0))
    for j in range(LPC_ORDER):
        row = np.flatnonzero(order > j)
        put(row, np.full(len(row), 16 + 8 * j), x[row, j] & 255)
    at = 8 + 8 * order
    row = np.flatnonzero(kind > 31)
    put(row, at[row] + 4, np.full(len(row), LPC_BITS - 1))
    put(row, at[row] + 9, lpc_shift[row])
    for j in range(LPC_ORDER):
        put(row, at[row] + 9 + LPC_BITS * (j + 1), lpc[row, j] & (2**LPC_BITS - 1))
    at = at + np.where(kind > 31, 9 + LPC_BITS * order, 0)
    row = np.flatnonzero(coded)
    put(row, at[row] + 10, rice[row])  # method 0, one partition, its parameter
    live = inside & coded[:, None] & (np.arange(width) >= order[:, None])
    k = rice[:, None].astype(np.int32)
    length = np.where(live, (code >> k) + 1 + k, 0)
    stop = np.cumsum(length, 1, dtype=np.int64) + (at + 10)[:, None]
    row, col = np.nonzero(live)
    own = rice[row]
    put(row, stop[row, col], (np.int64(1) << own) | (code[row, col] & ((np.int64(1) << own) - 1)))
    last = np.concatenate(ends) - 1
    value = np.concatenate(values).astype(np.int64) << (7 - (last & 7))
    byte = last >> 3
    total = np.bincount(byte, weights=value & 255, minlength=flat_size)
    for back in (1, 2):
        part = value >> 8 * back & 255
        some = np.flatnonzero(part)
        total += np.bincount(byte[some] - back, weights=part[some], minlength=flat_size)
    flat = total.astype(np.uint8)
    head_at = np.repeat(begin - np.cumsum(head_size) + head_size, head_size) + np.arange(int(head_size.sum()))
    flat[head_at] = np.frombuffer(b"".join(heads), np.uint8)
    check = crc16(flat, begin, frame_size - 2)
    flat[begin + frame_size - 2], flat[begin + frame_size - 1] = check >> 8, check & 255
    raw = flat.tobytes()
    return [raw[a : a + b] for a, b in zip(begin.tolist(), frame_size.tolist())]


def encode(payloads: list[bytes]) -> list[bytes]:
    """FLAC streams of byte strings (unsigned 8-bit samples, none empty)."""
    sizes = np.fromiter(map(len, payloads), np.int64, len(payloads))
    flat = np.frombuffer(b"".join(payloads), np.uint8)
    counts = -(-sizes // FRAME)
    number = np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)
    start = np.repeat(np.cumsum(sizes) - sizes, counts) + FRAME * number
    size = np.minimum(FRAME, np.repeat(sizes, counts) - FRAME * number)
    frames: list[bytes] = []
    for a in range(0, len(start), FRAMES_AT_ONCE):
        s, n = start[a : a + FRAMES_AT_ONCE], size[a : a + FRAMES_AT_ONCE]
        place = s[:, None] + np.arange(FRAME)
        inside = np.arange(FRAME) < n[:, None]
        x = np.where(inside, flat[np.minimum(place, len(flat) - 1)].astype(np.int32) - 128, 0).astype(np.int32)
        frames += _encode_some(x, n, number[a : a + FRAMES_AT_ONCE])
    out, at = [], 0
    for payload, count in zip(payloads, counts.tolist()):
        own = frames[at : at + count]
        at += count
        lengths = list(map(len, own))
        rate_etc = RATE << 44 | 0 << 41 | 7 << 36 | len(payload)
        digest = md5((np.frombuffer(payload, np.uint8) ^ 128).tobytes()).digest()
        info = FRAME.to_bytes(2, "big") * 2 + min(lengths).to_bytes(3, "big") + max(lengths).to_bytes(3, "big") + rate_etc.to_bytes(8, "big") + digest
        seek, offset = [], 0
        for i, length in enumerate(lengths):
            seek.append((i * FRAME).to_bytes(8, "big") + offset.to_bytes(8, "big") + min(FRAME, len(payload) - i * FRAME).to_bytes(2, "big"))
            offset += length
        table = b"".join(seek)
        # A metadata block holds less than 16 MB; a longer stream has several tables.
        tables = [table[i : i + 18 * 900_000] for i in range(0, len(table), 18 * 900_000)]
        blocks = [(0, info), *((3, t) for t in tables)]
        head = [bytes([(0x80 if i == len(blocks) - 1 else 0) | tag]) + len(data).to_bytes(3, "big") + data for i, (tag, data) in enumerate(blocks)]
        out.append(b"".join([b"fLaC", *head, *own]))
    return out


class Stream:
    """Metadata of one FLAC stream, with the place of each frame."""

    def __init__(self, data: bytes):
        if data[:4] != b"fLaC":
            raise ValueError("not a FLAC stream")
        at, last, self.points = 4, False, []
        while not last:
            last, tag, size = data[at] >= 128, data[at] & 127, int.from_bytes(data[at + 1 : at + 4], "big")
            body = data[at + 4 : at + 4 + size]
            if tag == 0:
                packed = int.from_bytes(body[10:18], "big")
                self.channels, self.bits, self.samples = (packed >> 41 & 7) + 1, (packed >> 36 & 31) + 1, packed & (2**36 - 1)
                self.block, self.md5 = int.from_bytes(body[:2], "big"), body[18:34]
            elif tag == 3:
                rows = np.frombuffer(body, np.dtype([("sample", ">u8"), ("offset", ">u8"), ("n", ">u2")]))
                self.points += [(int(s), int(o), int(n)) for s, o, n in rows.tolist() if s != 2**64 - 1]
            at += 4 + size
        if (self.channels, self.bits) != (1, 8):
            raise ValueError("only 8-bit mono streams are read")
        self.audio = at
        if sum(n for _, _, n in self.points) != self.samples:
            self._scan(data)

    def _scan(self, data: bytes) -> None:
        """Places of frames without a full seek table: sync codes with a sound header."""
        self.points, at, sample = [], self.audio, 0
        while sample < self.samples:
            at = data.find(b"\xff\xf8", at)
            if at < 0:
                raise ValueError("frames are missing")
            try:
                size, _ = read_header(data, at, self.block)
            except ValueError:
                at += 1
                continue
            before = self.audio + self.points[-1][1] if self.points else None
            if before is not None:
                flat = np.frombuffer(data, np.uint8)
                check = int(crc16(flat, np.array([before]), np.array([at - before - 2]))[0])
                if check != int.from_bytes(data[at - 2 : at], "big"):
                    at += 1
                    continue
            self.points.append((sample, at - self.audio, size))
            sample += size
            at += 2


def read_header(data: bytes, at: int, block: int) -> tuple[int, int]:
    """Samples of the frame at ``at`` and the bytes of its header; verifies its checksum."""
    if data[at : at + 2] != b"\xff\xf8" or data[at + 3] not in (0x00, 0x02):
        raise ValueError("no 8-bit mono frame here")
    size_code, rate_code = data[at + 2] >> 4, data[at + 2] & 15
    lead = data[at + 4]
    end = at + 5 + (0 if lead < 0x80 else 7 - (0xFF ^ lead).bit_length())
    if size_code == 6:
        size, end = data[end] + 1, end + 1
    elif size_code == 7:
        size, end = int.from_bytes(data[end : end + 2], "big") + 1, end + 2
    elif size_code == 1:
        size = 192
    elif size_code in (2, 3, 4, 5):
        size = 576 << (size_code - 2)
    elif size_code >= 8:
        size = 256 << (size_code - 8)
    else:
        size = block
    end += {12: 1, 13: 2, 14: 2}.get(rate_code, 0)
    if crc8(data[at:end]) != data[end]:
        raise ValueError("header checksum does not fit")
    return size, end + 1 - at


class _Bits:
    """A byte array read at many bit positions at once."""

    def __init__(self, flat: np.ndarray):
        padded = np.concatenate([flat, np.zeros(8, np.uint8)])
        self.words = np.zeros(len(flat) + 1, np.uint64)
        for i in range(8):
            self.words |= padded[i : i + len(self.words)].astype(np.uint64) << np.uint64(56 - 8 * i)

    def window(self, at: np.ndarray) -> np.ndarray:
        """64 bits from each position, of which the first 57 count."""
        return self.words[at >> 3] << (at & 7).astype(np.uint64)

    def take(self, at: np.ndarray, rows, n) -> np.ndarray:
        """Next ``n`` (1 to 32) bits of some rows; moves their positions."""
        own = self.window(at[rows]) >> (np.uint64(64) - np.asarray(n).astype(np.uint64))
        at[rows] += n
        return own.astype(np.int64)


def _signed(value: np.ndarray, bits) -> np.ndarray:
    return value - ((value >> (bits - 1) & 1) << bits)


def _decode_some(flat: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Samples (frames x longest) of frames whose coded bits start at byte ``start``."""
    order_of = np.argsort(-size, kind="stable")
    start, size = start[order_of], size[order_of]
    n, longest = len(start), int(size[0])
    bits = _Bits(flat)
    at = start * 8
    tag = bits.take(at, slice(None), 8) >> 1
    out = np.zeros((longest, n), np.int64)
    for i in np.flatnonzero(tag == 0):
        out[: size[i], i] = np.int8(flat[at[i] >> 3])
    for i in np.flatnonzero(tag == 1):
        out[: size[i], i] = flat[at[i] >> 3 : (at[i] >> 3) + size[i]].view(np.int8)
    linear = tag >= 32
    fixed = (tag >= 8) & (tag <= 12)
    if (~(linear | fixed | (tag < 2))).any():
        raise ValueError("unknown subframe")
    order = np.where(linear, tag - 31, np.where(fixed, tag - 8, 0))
    most = int(order.max(initial=0))
    for j in range(most):
        rows = np.flatnonzero(order > j)
        out[j, rows] = _signed(bits.take(at, rows, 8), 8)
    weight, shift = np.zeros((most, n), np.int64), np.zeros(n, np.int64)
    for o in range(1, min(most, 4) + 1):
        weight[:o, fixed & (order == o)] = np.array(FIXED[o])[:, None]
    rows = np.flatnonzero(linear)
    if len(rows):
        precision = np.zeros(n, np.int64)
        precision[rows] = bits.take(at, rows, 4) + 1
        shift[rows] = bits.take(at, rows, 5)
        for j in range(most):
            rows = np.flatnonzero(linear & (order > j))
            weight[j, rows] = _signed(bits.take(at, rows, precision[rows]), precision[rows])
    coded = np.flatnonzero(tag >= 8)
    if len(coded):
        wide = bits.take(at, coded, 2)
        parts = np.int64(1) << bits.take(at, coded, 4)
        span = size[coded] // parts
        width = np.where(wide == 1, 5, 4)
        at, order, shift, weight = at[coded], order[coded], shift[coded], weight[:, coded]
        sizes = size[coded]
        values = out[:, coded]
        k, escaped = np.zeros(len(coded), np.int64), np.zeros(len(coded), bool)
        live_at = np.searchsorted(-sizes, -np.arange(longest), side="left")
        next_part = order.copy()  # sample at which the next parameter stands
        for t in range(longest):
            m = int(live_at[t])
            rows = slice(0, m) if t >= most else np.flatnonzero(order[:m] <= t)
            due = np.flatnonzero(next_part[:m] == t)
            if len(due):
                k[due] = bits.take(at, due, width[due])
                escaped[due] = k[due] == (1 << width[due]) - 1
                raw = due[escaped[due]]
                if len(raw):
                    k[raw] = bits.take(at, raw, 5)
                next_part[due] = (t // span[due] + 1) * span[due]
            window = bits.window(at[rows])
            # Leading zeros of the first 32 bits, from the exponent of their value.
            zeros = np.minimum(1054 - ((window >> np.uint64(32)).astype(np.float64).view(np.int64) >> 52), 32)
            own_k = k[rows]
            long = np.flatnonzero((zeros + own_k > 54) | (zeros >= 32))
            used = (zeros + 1).astype(np.uint64)
            low = ((window << used) >> np.uint64(1)) >> (63 - own_k).astype(np.uint64)
            folded = (zeros.astype(np.int64) << own_k) | low.astype(np.int64)
            moved = zeros + 1 + own_k
            plain = True
            if len(long) or escaped[:m].any():
                index = np.arange(m)[rows]
                plain = False
                for i in long.tolist():  # rare: a run of zeros longer than a window
                    p, q = int(at[index[i]]), 0
                    while not flat[p >> 3] >> (7 - (p & 7)) & 1:
                        p, q = p + 1, q + 1
                    p += 1
                    tail = 0
                    for _ in range(int(own_k[i])):
                        tail, p = tail << 1 | int(flat[p >> 3] >> (7 - (p & 7)) & 1), p + 1
                    folded[i], moved[i] = q << int(own_k[i]) | tail, p - int(at[index[i]])
            rest = (folded >> 1) ^ -(folded & 1)
            if not plain:
                for i in np.flatnonzero(escaped[rows]).tolist():
                    w = int(own_k[i])
                    raw = int(window[i]) >> (64 - w) if w else 0
                    rest[i], moved[i] = raw - ((raw >> (w - 1) & 1) << w) if w else 0, w
            at[rows] += moved
            guess = np.zeros(len(rest), np.int64)
            for j in range(min(most, t)):
                guess += weight[j, rows] * values[t - 1 - j, rows]
            values[t, rows] = rest + (guess >> shift[rows])
        out[:, coded] = values
    back = np.empty((n, longest), np.int64)
    back[order_of] = out.T
    return back


def decode(streams: list[bytes]) -> list[list[tuple[int, int, bytes]]]:
    """Blocks of each stream: first sample, place of the frame in the stream, unsigned PCM."""
    out = []
    heads = [Stream(s) for s in streams]
    flat = np.frombuffer(b"".join(streams), np.uint8)
    base = np.cumsum([0, *map(len, streams)]).tolist()
    rows = []  # stream, first sample, place in stream, samples, start of the coded bits, end of the frame
    for i, (s, head) in enumerate(zip(streams, heads)):
        places = [head.audio + o for _, o, _ in head.points] + [len(s)]
        for (sample, _, n), place, end in zip(head.points, places, places[1:]):
            size, skip = read_header(s, place, head.block)
            if size != n:
                raise ValueError("seek table and frame differ in size")
            rows.append((i, sample, place, n, base[i] + place + skip, base[i] + end))
    table = np.array(rows, np.int64).reshape(-1, 6)
    blocks: list[list[tuple[int, int, bytes]]] = [[] for _ in streams]
    for a in range(0, len(table), FRAMES_AT_ONCE):
        own = table[a : a + FRAMES_AT_ONCE]
        begin = np.array([base[i] + p for i, p in own[:, [0, 2]].tolist()], np.int64)
        first = int(begin[0])
        part = flat[first : int(own[-1, 5])]
        check = crc16(part, begin - first, own[:, 5] - begin - 2)
        ends = own[:, 5] - first
        if (check != (part[ends - 2].astype(np.int64) << 8 | part[ends - 1])).any():
            raise ValueError("frame checksum does not fit")
        samples = _decode_some(part, own[:, 4] - first, own[:, 3])
        pcm = (samples + 128).astype(np.uint8)
        for r, (i, sample, place, n, _, _) in enumerate(own.tolist()):
            blocks[i].append((sample, place, pcm[r, :n].tobytes()))
    for head, own in zip(heads, blocks):
        signed = (np.frombuffer(b"".join(b for _, _, b in own), np.uint8) ^ 128).tobytes()
        if len(signed) != head.samples or (head.md5 != bytes(16) and md5(signed).digest() != head.md5):
            raise ValueError("stream checksum does not fit")
        out.append(own)
    return out
