"""Static range asymmetric numeral system over interleaved lanes (numpy).

One frequency table of total 2 ** ``BITS`` is shared by all blocks. A block is a
run of ids, dealt to ``LANES`` lanes in turn; every lane has its own 64-bit state
and all lanes share one stream of 32-bit words, so that one numpy operation
serves a step of all lanes. Each ``STRIDE`` steps a checkpoint holds the states
and the place in the stream: segments between checkpoints can be decoded
independently and in any order. A block carries checksums of its stream and of
its ids.

Block layout (little-endian): magic, ids, lanes, stride, words, segments, crc32
of the ids, crc32 of what follows the header; then per segment the place in the
stream and the states; then the stream.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

BITS = 20
LANES = 512
STRIDE = 128
#: Segments of a block that are decoded side by side.
TOGETHER = 8
MAGIC = b"vxr1"
_HEAD = struct.Struct("<4s7I")
_LOW = 1 << 31  # states lie in [2 ** 31, 2 ** 63)
U64 = np.uint64
_UP = U64(32)


def scaled(counts: np.ndarray) -> np.ndarray:
    """Frequencies of total 2 ** BITS, at least 1 for every id that occurs."""
    counts = np.asarray(counts, dtype=np.float64)
    total = counts.sum()
    if not total:
        freq = np.zeros(len(counts), np.int64)
        freq[0] = 1 << BITS
        return freq.astype(np.uint32)
    if np.count_nonzero(counts) > 1 << BITS:
        raise ValueError("more ids than the table has places")
    freq = np.where(counts > 0, np.maximum(1, np.floor(counts * ((1 << BITS) / total))), 0).astype(np.int64)
    order = np.argsort(-counts, kind="stable")
    excess = int(freq.sum()) - (1 << BITS)
    if excess < 0:
        freq[order[0]] -= excess
    while excess > 0:  # taken from the most frequent, in proportion, never below 1
        spare = np.maximum(freq - 1, 0)
        take = np.minimum(spare, -(-spare * excess // spare.sum()))
        over = np.cumsum(take[order]) - excess
        cut = np.where(over > 0, np.maximum(0, take[order] - over), take[order])
        freq[order] -= cut
        excess = int(freq.sum()) - (1 << BITS)
    return freq.astype(np.uint32)


class Tables:
    """What encoding and decoding look up."""

    def __init__(self, freq: np.ndarray):
        self.freq = freq.astype(U64)
        self.first = np.concatenate([[0], np.cumsum(self.freq)[:-1]]).astype(U64)
        self.at = np.repeat(np.arange(len(freq), dtype=np.uint16), freq)
        self.filler = int(np.argmax(freq))


def encode(ids: np.ndarray, tables: Tables, lanes: int = LANES, stride: int = STRIDE) -> bytes:
    """One block."""
    n = len(ids)
    lanes = max(1, min(lanes, n))
    steps = -(-n // lanes)
    grid = np.full(steps * lanes, tables.filler, dtype=np.int64)
    grid[:n] = ids
    grid = grid.reshape(steps, lanes)
    # a step in one multiplication: (q << BITS) + (state - q * f) + first = state + q * (2 ** BITS - f) + first
    freq, first = tables.freq[grid], tables.first[grid]
    limit, rest = freq << U64(63 - BITS), U64(1 << BITS) - freq
    state = np.full(lanes, _LOW, dtype=U64)
    q, full = np.empty(lanes, U64), np.empty(lanes, bool)
    out: list[np.ndarray] = []
    words = 0
    marks: list[tuple[int, np.ndarray]] = []
    for t in range(steps - 1, -1, -1):
        at = np.greater_equal(state, limit[t], out=full).nonzero()[0]
        if len(at):
            part = state[at]
            out.append(part.astype("<u4"))  # the low half
            words += len(part)
            state[at] = part >> _UP
        np.floor_divide(state, freq[t], out=q)
        np.multiply(q, rest[t], out=q)
        state += q
        state += first[t]
        if t % stride == 0:
            marks.append((words, state.copy()))
    stream = np.concatenate(out[::-1]) if out else np.empty(0, "<u4")
    body = b"".join(struct.pack("<I", words - behind) + s.astype("<u8").tobytes() for behind, s in marks[::-1])
    body += stream.tobytes()
    return _HEAD.pack(MAGIC, n, lanes, stride, words, len(marks), zlib.crc32(np.asarray(ids, "<u4")),
                      zlib.crc32(body)) + body


def header(block: bytes) -> dict[str, int]:
    magic, n, lanes, stride, words, segments, ids_crc, body_crc = _HEAD.unpack_from(block)
    if magic != MAGIC:
        raise ValueError("not a block of this format")
    return {"n": n, "lanes": lanes, "stride": stride, "words": words, "segments": segments, "ids_crc": ids_crc,
            "body_crc": body_crc}


def _steps(block: bytes, tables: Tables, h: dict[str, int], ks: list[int]) -> list[np.ndarray]:
    """The ids of segments of equally many steps, decoded side by side."""
    lanes, n = h["lanes"], h["n"]
    mark = 4 + 8 * lanes
    ats = [_HEAD.size + k * mark for k in ks]
    places = [struct.unpack_from("<I", block, at)[0] for at in ats]
    state = np.concatenate([np.frombuffer(block, "<u8", lanes, at + 4) for at in ats]).astype(U64)
    stream = np.frombuffer(block, "<u4", h["words"], _HEAD.size + h["segments"] * mark)
    steps = min(h["stride"], -(-n // lanes) - ks[0] * h["stride"])
    out = np.empty((steps, len(state)), np.uint16)
    bits, mask, low = U64(BITS), U64((1 << BITS) - 1), U64(_LOW)
    slot, short = np.empty(len(state), U64), np.empty(len(state), bool)
    ends = [lanes * (i + 1) for i in range(len(ks))]
    for t in range(steps):
        np.bitwise_and(state, mask, out=slot)
        out[t] = tables.at.take(slot.view(np.int64))
        got = out[t].astype(np.int64)
        state >>= bits
        state *= tables.freq.take(got)
        state += slot
        state -= tables.first.take(got)
        at = np.less(state, low, out=short).nonzero()[0]
        if len(at):
            refill, before = [], 0
            for i, behind in enumerate(np.searchsorted(at, ends).tolist()):
                refill.append(stream[places[i]:places[i] + behind - before])
                places[i] += behind - before
                before = behind
            state[at] = (state[at] << _UP) | (np.concatenate(refill) if len(refill) > 1 else refill[0])
    return [out[:, e - lanes:e].ravel()[:max(0, n - k * h["stride"] * lanes)] for k, e in zip(ks, ends)]


def segment(block: bytes, tables: Tables, k: int) -> np.ndarray:
    """The ids of segment ``k`` of a block, from its own checkpoint."""
    return _steps(block, tables, header(block), [k])[0]


def decode(block: bytes, tables: Tables) -> np.ndarray:
    """The ids of a block; raises ValueError where a checksum does not hold."""
    h = header(block)
    if zlib.crc32(memoryview(block)[_HEAD.size:]) != h["body_crc"]:
        raise ValueError("the block's stream is damaged")
    whole = min(h["segments"], -(-h["n"] // h["lanes"]) // h["stride"])  # the others have fewer steps
    parts = [ids for first in range(0, whole, TOGETHER)
             for ids in _steps(block, tables, h, list(range(first, min(whole, first + TOGETHER))))]
    parts += [segment(block, tables, k) for k in range(whole, h["segments"])]
    ids = np.concatenate(parts) if parts else np.empty(0, np.uint16)
    if zlib.crc32(ids.astype("<u4")) != h["ids_crc"]:
        raise ValueError("the block's ids do not match their checksum")
    return ids
