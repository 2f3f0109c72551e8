"""Triggers and phrases of the prefix-free parse (numpy part of ``suffix``)."""

from __future__ import annotations

import numpy as np

from .kernels import mix64, ship

ship(__name__)

#: Bytes of a trigger string.
GRAM = 24
#: Low bits of a sliding minimum's key: the place in its document. A document
#: beyond 2**28 bytes wraps, which only matters where one trigger string
#: occurs twice within a window that holds the wrap.
PLACE = 28
ODD_BASE = np.uint64(0x9E3779B97F4A7C15)


def word64(raw: np.ndarray) -> np.ndarray:
    """The 8 bytes from each place on as a number (zeros beyond the end)."""
    b = np.concatenate([raw, np.zeros(8, np.uint8)])
    x = b[:-1].astype(np.uint16) | b[1:].astype(np.uint16) << 8
    y = x[:-2].astype(np.uint32) | x[2:].astype(np.uint32) << 16
    return (y[:-4].astype(np.uint64) | y[4:].astype(np.uint64) << np.uint64(32))[:len(raw)]


def rolling_hashes(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of the 8 bytes, hash of the GRAM bytes) from each place on."""
    eight = mix64(word64(raw) + ODD_BASE)
    padded = np.concatenate([eight, np.zeros(GRAM, np.uint64)])
    n = len(raw)
    gram = mix64(eight + padded[8:n + 8] * np.uint64(0xD6E8FEB86659FD93) + padded[16:n + 16] * np.uint64(0xA5CB9243B3D7A52D))
    return eight, gram


def phrases(raw: np.ndarray, starts: np.ndarray, length: int):
    """The phrases of documents ``raw[starts[k]:starts[k + 1]]``.

    Every window of ``length`` bytes has as trigger the least rolling hash of
    its strings of GRAM bytes (the leftmost of equal ones), so equal windows
    have theirs at the same place. Consecutive windows with one trigger are a
    phrase: the bytes from its first window's start to its last window's end.
    Returns (document, first window, last window, trigger place, trigger hash,
    phrase hash); places count from the start of ``raw``.
    """
    sizes = np.diff(starts)
    if not (sizes >= length).any():
        empty = np.zeros(0, np.int64)
        return empty, empty, empty, empty, empty.astype(np.uint64), empty.astype(np.uint64)
    eight, gram = rolling_hashes(raw)
    n = len(raw)
    doc = np.repeat(np.arange(len(sizes)), sizes)
    place = np.arange(n) - np.repeat(starts[:-1], sizes)
    low = np.uint64((1 << PLACE) - 1)
    key = (gram & ~low) | (place.astype(np.uint64) & low)
    width, reach = length - GRAM + 1, 1
    least = key
    while 2 * reach <= width:
        least = np.minimum(least[:-reach], least[reach:])
        reach *= 2
    if reach < width:
        least = np.minimum(least[:len(least) - (width - reach)], least[width - reach:])
    # Windows that begin at places from which the document has ``length`` bytes.
    windows = np.flatnonzero(np.repeat(sizes, sizes)[:len(least)] - place[:len(least)] >= length)
    at = (least[windows] & low).astype(np.int64)
    at += (place[windows] - at) >> PLACE << PLACE if n >= 1 << PLACE else 0
    trigger = at + starts[doc[windows]]
    cut = np.flatnonzero(np.diff(trigger, prepend=-1) | np.diff(doc[windows], prepend=-1))
    first = windows[cut]
    last = windows[np.append(cut[1:], len(windows)) - 1]
    trigger = trigger[cut]
    # A phrase's hash: its bytes as a polynomial, and where its trigger lies.
    power = np.full(n, ODD_BASE)
    power[0] = 1
    power = np.cumprod(power)
    inverse = np.uint64(pow(int(ODD_BASE), -1, 1 << 64))
    back = np.full(n, inverse)
    back[0] = 1
    back = np.cumprod(back)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(eight * power)])
    end = last + length - 8 + 1
    whole = (total[end] - total[first]) * back[first]
    whole = mix64(whole + mix64(((last - first) << 8 | (trigger - first)).astype(np.uint64)))
    return doc[first], first, last, trigger, gram[trigger], whole
