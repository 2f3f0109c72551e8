"""Separator-normalised texts as bytes (numpy part of ``decontam`` and ``resample``).

Words are maximal runs of digits, ASCII letters (A-Z lower-cased) and characters
beyond ASCII. A slice of texts becomes one byte string in which a space stands
before every word and after the last, whatever separated them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from .kernels import ship
from .suffix import raw_texts

ship(__name__)


def byte_classes() -> np.ndarray:
    """What each byte becomes: itself, its lower case, or 0 for a separator."""
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    table[[*range(48), *range(58, 65), *range(91, 97), *range(123, 128)]] = 0
    return table


CLASSES = byte_classes()


def canonical_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, place of the space before each word and of the one after the last,
    row offsets): the words of text k are ``offsets[k]`` to ``offsets[k + 1]``."""
    raw, starts = raw_texts(texts)
    n = len(starts) - 1
    # One separator before each text and one at the end keep texts apart.
    wide = np.zeros(len(raw) + n + 1, np.uint8)
    body = np.ones(len(wide), bool)
    body[starts + np.arange(n + 1)] = False
    wide[body] = CLASSES[raw]
    word = wide > 0
    before = np.zeros(len(wide), bool)
    before[:-1] = ~word[:-1] & word[1:]
    counted = np.concatenate([[0], np.cumsum(before)])
    offsets = counted[starts + np.arange(n + 1)]
    keep = word | before
    text = np.append(wide[keep], np.uint8(0))
    spaces = np.flatnonzero(text == 0)
    text[spaces] = 32
    return text, spaces, offsets
