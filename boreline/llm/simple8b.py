"""Simple-8b: whole numbers in 64-bit words, coded and decoded as arrays.

The four high bits of a word are its selector. It says how many numbers, of
how many bits each, lie in the other sixty, the first one lowest. A number of
more than sixty bits is an escape: a word of selector 0, whose low bits point
into a list of raw values. Each word takes as many of the next numbers as any
selector can hold; the last may be part empty, so a coded run needs its length
beside it.
"""

from __future__ import annotations

import numpy as np

# Fixed values: (numbers, bits) of the selectors 1 to 15 of Simple-8b; 0 is the escape here.
SELECTORS = [(120, 0), (60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6), (8, 7), (7, 8), (6, 10), (5, 12), (4, 15), (3, 20), (2, 30), (1, 60)]
HELD = np.array([1] + [n for n, _ in SELECTORS])
LOW60 = np.uint64((1 << 60) - 1)
_HIGH = np.uint64(60)


def encode(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words and escaped values, both unsigned 64-bit."""
    values = np.ascontiguousarray(values, np.uint64)
    n = len(values)
    if not n:
        return np.empty(0, np.uint64), np.empty(0, np.uint64)
    selector = np.zeros(n, np.int8)
    padded = np.concatenate((values, np.zeros(SELECTORS[0][0], np.uint64)))
    fit = np.arange(n)
    for k in range(len(SELECTORS), 0, -1):  # from few wide numbers to many narrow ones: what fits one fits those before it
        count, bits = SELECTORS[k - 1]
        if len(fit) * count < n:  # few places are left: look at those only
            fit = fit[(padded[fit[:, None] + np.arange(count)] < np.uint64(1 << bits)).all(axis=1)]
        elif (wide := values >= np.uint64(1 << bits)).any():
            before = np.zeros(n + count, np.int32)
            np.cumsum(wide, out=before[1 : n + 1])
            before[n + 1 :] = before[n]
            fit = fit[before[fit + count] == before[fit]] if len(fit) < n else np.nonzero(before[count:] == before[:n])[0]
        selector[fit] = k
        if not len(fit):
            break
    steps, at, starts = HELD[selector].astype(np.uint8).tobytes(), 0, []
    while at < n:
        starts.append(at)
        at += steps[at]
    starts = np.array(starts)
    chosen = selector[starts]
    words = chosen.astype(np.uint64) << _HIGH
    for k in np.flatnonzero(np.bincount(chosen, minlength=16)):
        rows = np.nonzero(chosen == k)[0]
        if k == 0:
            words[rows] = np.arange(len(rows), dtype=np.uint64)
            continue
        count, bits = SELECTORS[k - 1]
        if bits:
            for j in range(count):
                words[rows] |= padded[starts[rows] + j] << np.uint64(bits * j)
    return words, values[starts[chosen == 0]]


def decode(words: np.ndarray, escapes: np.ndarray, n: int) -> np.ndarray:
    """The first ``n`` numbers of the words."""
    selector = (words >> _HIGH).astype(np.int8)
    held = HELD[selector]
    starts = np.cumsum(held) - held
    out = np.zeros(int(held.sum()) if len(held) else 0, np.uint64)
    for k in np.flatnonzero(np.bincount(selector, minlength=16)):
        rows = np.nonzero(selector == k)[0]
        body = words[rows] & LOW60
        if k == 0:
            out[starts[rows]] = escapes[body.astype(np.int64)]
            continue
        count, bits = SELECTORS[k - 1]
        mask = np.uint64((1 << bits) - 1)
        if bits:
            for j in range(count):
                out[starts[rows] + j] = (body >> np.uint64(bits * j)) & mask
    if len(out) < n:
        raise ValueError(f"the words hold {len(out)} numbers, not {n}")
    return out[:n]
