"""Simple-8b coding of unsigned integers in 64-bit words, encoder and decoder on numpy arrays.

A word holds a 4-bit selector in its top bits and ``count`` values of ``bits`` bits each, the first value in
the lowest bits. Selector 15 is an escape: the next word is one value of up to 64 bits as it is. Values are
coded in blocks; a block starts a new word and its place among the words is kept, so that any block can be
decoded alone, or all of them together.
"""

from __future__ import annotations

import numpy as np

BLOCK = 4096  # values per block
# Fixed values of the format: values per word and bits per value, by selector; 15 is the escape.
COUNTS = np.array([240, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1, 0])
BITS = np.array([0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60, 64])
ESCAPE = 15
STEPS = np.where(COUNTS == 0, 1, COUNTS).astype(np.uint8)
SMALL = np.ceil(np.log2(np.arange(1 << 16) + 1.0)).astype(np.uint8)  # bits of 16-bit values


def bit_length(values: np.ndarray) -> np.ndarray:
    if not len(values) or values.max() < 1 << 16:
        return SMALL[values.astype(np.uint16)]
    out, rest = np.zeros(len(values), np.uint8), values
    for shift in (32, 16, 8, 4, 2, 1):
        big = rest >> np.uint64(shift) > 0
        out += big * np.uint8(shift)
        rest = np.where(big, rest >> np.uint64(shift), rest)
    return out + (rest > 0)


def encode(values: np.ndarray, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray]:
    """(words, offsets): uint64 words, and for every block the index of its first word."""
    values = np.ascontiguousarray(values, np.uint64)
    n = len(values)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint32)
    # Bits of every value, in rows of one block each, with zeros beyond the block: they fit anywhere.
    rows = -(-n // block)
    spare = int(COUNTS.max())
    bits = np.zeros((rows, block + spare), np.uint8)
    wide = np.zeros(rows * block, np.uint8)
    wide[:n] = bit_length(values)
    bits[:, :block] = wide.reshape(rows, block)
    # The largest of the next k values, for growing k, by overlapping the windows found so far.
    choice = np.full((rows, block), ESCAPE, np.uint8)
    most, k = bits, 1
    for selector in range(ESCAPE - 1, -1, -1):
        while k < COUNTS[selector]:
            jump = min(k, int(COUNTS[selector]) - k)
            most = np.maximum(most[:, : most.shape[1] - jump], most[:, jump:])
            k += jump
        fits = most[:, :block] <= np.uint8(BITS[selector])
        if not fits.any():
            break  # narrower selectors fit even less
        np.copyto(choice, np.uint8(selector), where=fits)
    # Values that a word starting here takes, not beyond the block or the end.
    room = np.minimum(np.arange(block, 0, -1), 255).astype(np.uint8)
    step = np.minimum(STEPS[choice], room)
    tail = n - (rows - 1) * block
    step[-1, :tail] = np.minimum(step[-1, :tail], np.minimum(np.arange(tail, 0, -1), 255).astype(np.uint8))
    choice, step = choice.ravel()[:n], step.ravel()[:n]
    starts, at = [], 0
    jump = step.tolist()
    while at < n:
        starts.append(at)
        at += jump[at]
    starts = np.array(starts)
    chosen = choice[starts]
    width = np.where(chosen == ESCAPE, 2, 1)
    where = np.cumsum(width) - width
    words = np.zeros(int(width.sum()), np.uint64)
    padded = np.zeros((rows, block + spare), np.uint64)  # beyond the block: zeros
    for row in range(rows):
        part = values[row * block: (row + 1) * block]
        padded[row, : len(part)] = part
    padded = padded.ravel()
    for selector in np.unique(chosen).tolist():
        own = np.flatnonzero(chosen == selector)
        first = starts[own] + starts[own] // block * spare
        if selector == ESCAPE:
            words[where[own]] = np.uint64(ESCAPE << 60)
            words[where[own] + 1] = padded[first]
            continue
        packed = np.full(len(own), selector << 60, np.uint64)
        for lane in range(int(COUNTS[selector]) if BITS[selector] else 0):
            packed |= padded[first + lane] << np.uint64(lane * int(BITS[selector]))
        words[where[own]] = packed
    offsets = where[np.searchsorted(starts, np.arange(0, n, block))]
    return words, offsets.astype(np.uint32)


def decode(words: np.ndarray, offsets: np.ndarray, n: int, block: int = BLOCK) -> np.ndarray:
    """All ``n`` values at once; the per-block offsets give every word the place of its values."""
    out = np.zeros(n, np.uint64)
    if not n:
        return out
    words = np.ascontiguousarray(words, np.uint64)
    selector = (words >> np.uint64(60)).astype(np.int64)
    # A raw value follows an escape. Its top bits are no selector; walk the (rare) escapes in order.
    raw = np.zeros(len(words), bool)
    for at in np.flatnonzero(selector == ESCAPE).tolist():
        if not raw[at]:
            raw[at + 1] = True
    count = np.where(raw, 1, COUNTS[selector])
    before = np.cumsum(count) - count
    offsets = offsets.astype(np.int64)
    of = np.searchsorted(offsets, np.arange(len(words)), "right") - 1  # block of each word
    first = of * block + before - before[offsets][of]
    end = np.minimum((of + 1) * block, n)
    out[first[raw]] = words[raw]
    for s in np.unique(selector[~raw]).tolist():
        if s == ESCAPE or not BITS[s]:
            continue
        rows = (selector == s) & ~raw
        lanes = np.arange(COUNTS[s])
        values = (words[rows][:, None] >> (lanes * BITS[s]).astype(np.uint64)) & np.uint64((1 << int(BITS[s])) - 1)
        index = first[rows][:, None] + lanes
        good = index < end[rows][:, None]
        out[index[good]] = values[good]
    return out


def decode_block(words: np.ndarray, offsets: np.ndarray, n: int, number: int, block: int = BLOCK) -> np.ndarray:
    """The values of one block, from its own words only."""
    low = int(offsets[number])
    high = int(offsets[number + 1]) if number + 1 < len(offsets) else len(words)
    size = min(block, n - number * block)
    return decode(words[low:high], np.zeros(1, np.uint32), size, block)
