"""Whole texts to token ids with the tokenizers library, fast.

Byte-level BPE treats each pre-token alone, and a single space between two
other characters always starts a pre-token. So a text is cut there, every
distinct piece is encoded once by the library and kept in a bounded memo of
the Python worker, and a text's ids are the pieces' ids in order. Texts in
which white space meets white space, or other white space than space and
newline occurs, go to the library whole.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .kernels import ragged_positions, ship, text_slices, worker_cache

ship(__name__)

MEMO = 800_000
ODD = ("[\\x{00}-\\x{09}\\x{0b}-\\x{1f}\\x{85}\\x{a0}\\x{1680}\\x{180e}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}"
       "\\x{202f}\\x{205f}\\x{3000}]|[ \n][ \n]|^[ \n]|[ \n]$|^$")
#: A comma or full stop between a letter or digit and white space is a pre-token of its own.
STOP = "([\\p{L}\\p{N}])([,.])([ \n])"


def byte_letters() -> dict[int, str]:
    """The byte-level alphabet: printable bytes stand for themselves, the
    others for the code points from 256 on, in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(rest)}


def pieces_of(texts: pa.Array):
    """(plain rows mask, row offsets, codes, distinct pieces) of texts without nulls.

    A piece's first character says how it stands: 1: at the text's start;
    2: a comma or full stop right after a letter or digit; newline: after a
    newline; else after a space.
    """
    plain = ~np.asarray(pc.match_substring_regex(texts, ODD))
    body = pc.replace_substring_regex(texts.filter(pa.array(plain)), STOP, "\\1 \x02\\2\\3")
    body = pc.replace_substring(body, "\n", " \n")
    lists = pc.split_pattern(pc.binary_join_element_wise("\x01", body, ""), " ")
    enc = lists.flatten().dictionary_encode()
    starts = np.asarray(lists.offsets).astype(np.int64)
    distinct = enc.dictionary.to_numpy(zero_copy_only=False).tolist()
    return plain, starts - starts[0], np.asarray(enc.indices).astype(np.int64), distinct


class PieceEncoder:
    """The library's ids of pieces, memoised."""

    def __init__(self, path: str, memo: int = MEMO):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.tok.no_truncation()
        self.tok.no_padding()
        self.model = self.tok.model
        self.letters = byte_letters() | {10: "\n"}
        self.newline = self.whole(["\n"])[0]
        self.memo = memo
        self.clear()

    def clear(self):
        self.row: dict[str, int] = {}
        self.start, self.length = np.zeros(1024, np.int64), np.zeros(1024, np.int64)
        self.flat, self.used = np.zeros(4096, np.int32), 0

    def whole(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def words(self, words: list[str]) -> list[list[int]]:
        """Ids of strings of letters, some after a space: each is one
        pre-token, so the library's model alone decides."""
        one = self.model.tokenize
        mapped = "\n".join(words).encode().decode("latin-1").translate(self.letters).split("\n")
        return [[t.id for t in one(w)] for w in mapped]

    def learn(self, pieces: list[str]):
        bare = [p[1:] if p[0] in "\x01\x02\n" else " " + p for p in pieces]
        word = [b.isalpha() or b[0] == " " and b[1:].isalpha() for b in bare]
        got = iter(self.words([b for b, w in zip(bare, word) if w]) if any(word) else [])
        other = iter(self.whole([b for b, w in zip(bare, word) if not w]))
        ids = [next(got) if w else next(other) for w in word]
        ids = [self.newline + x if p[0] == "\n" else x for p, x in zip(pieces, ids)]
        n, size = len(self.row), np.fromiter(map(len, ids), np.int64, len(ids))
        while n + len(pieces) > len(self.start):
            self.start, self.length = (np.concatenate([x, np.zeros_like(x)]) for x in (self.start, self.length))
        total = int(size.sum())
        while self.used + total > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        self.start[n:n + len(pieces)] = self.used + np.cumsum(size) - size
        self.length[n:n + len(pieces)] = size
        self.flat[self.used:self.used + total] = [i for x in ids for i in x]
        self.used += total
        self.row.update(zip(pieces, range(n, n + len(pieces))))

    def rows(self, pieces: list[str]) -> np.ndarray:
        new = [p for p in pieces if p not in self.row]
        if self.row and len(self.row) + len(new) > self.memo:
            self.clear()
            new = pieces
        if new:
            self.learn(new)
        return np.fromiter(map(self.row.__getitem__, pieces), np.int64, len(pieces))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(tokens per text, all ids in order)."""
        plain, starts, codes, distinct = pieces_of(texts)
        counts = np.zeros(len(texts), np.int64)
        ids = np.zeros(0, np.int32)
        if len(codes):
            at = self.rows(distinct)[codes]
            size = self.length[at]
            total = np.concatenate([[0], np.cumsum(size)])
            counts[plain] = total[starts[1:]] - total[starts[:-1]]
            ids = self.flat[ragged_positions(self.start[at], size)]
        odd = np.flatnonzero(~plain)
        if len(odd):
            own = self.whole(texts.take(pa.array(odd)).to_pylist())
            counts[odd] = [len(x) for x in own]
            out, ends = np.zeros(int(counts.sum()), np.int32), np.cumsum(counts)
            out[np.repeat(plain, counts)] = ids
            for r, x in zip(odd, own):
                out[ends[r] - len(x):ends[r]] = x
            ids = out
        return counts, ids


def vocabulary_size(path: str) -> int:
    """One more than the greatest id of a tokenizer file."""
    from tokenizers import Tokenizer
    return 1 + max(Tokenizer.from_file(path).get_vocab().values(), default=0)


def encoder(path: str) -> PieceEncoder:
    """This worker's encoder of a tokenizer file."""
    cache = worker_cache("tokens")
    if ("pieces", path) not in cache:
        cache["pieces", path] = PieceEncoder(path)
    return cache["pieces", path]


def encode_slices(texts: pa.Array, path: str, end_id: int | None,
                  max_bytes: int = 6_000_000) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, tokens per row, ids), a slice of bounded text at a
    time; ``end_id`` (if any) ends each text. Null texts are empty."""
    texts = pc.fill_null(texts, "")
    enc = encoder(path)
    for a, b in text_slices(texts, max_bytes):
        counts, ids = enc.encode(texts[a:b])
        if end_id is not None:
            ids = np.insert(ids, np.cumsum(counts), end_id)
            counts = counts + 1
        yield a, b, counts, ids
