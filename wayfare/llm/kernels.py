"""Helpers shared by the operators of this subpackage.

Python code that runs in tasks is shipped by value (``ship``), so executors
need the libraries it imports but not this package. ``worker_cache`` keeps a
model or a memo in a Python worker, across an operator's tasks.
"""

from __future__ import annotations

import ctypes
import sys
import types
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_folder


def ship(module: str) -> None:
    """Pickle the functions of a module by value."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


ship(__name__)


def worker_cache(owner: str) -> dict:
    """A dictionary that lives as long as this Python process, or until another
    operator's task asks for its own: workers serve one stage after another, and
    what an earlier one kept would add up."""
    holder = sys.modules.get("_task_cache")
    if holder is None:
        holder = sys.modules["_task_cache"] = types.ModuleType("_task_cache")
        holder.owner, holder.items = owner, {}
    if holder.owner != owner:
        holder.owner, holder.items = owner, {}
        release()
    return holder.items


def materialise(df: DataFrame, name: str, **options) -> DataFrame:
    """Write a table to the shared folder and read it back: cuts the lineage
    and survives lost executors."""
    path = f"{shared_folder(df.sparkSession)}/llm-{name}-{uuid.uuid4().hex}"
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def masked(df: DataFrame, *names: str) -> tuple[DataFrame, list[str]]:
    """The table with only ``names`` under their own names and all other columns
    as ``_x0``, ``_x1``...: they cannot clash with an operator's. Also the new
    names. The first column with exactly a name is meant, else the first with it in other case."""
    safe = [f"_x{k}" for k in range(len(df.columns))]
    lower = [c.lower() for c in df.columns]
    for n in names:
        if n.lower() in lower:
            safe[df.columns.index(n) if n in df.columns else lower.index(n.lower())] = n
    return df.toDF(*safe), safe


def unmasked(df: DataFrame, safe: list[str], columns: list[str]) -> DataFrame:
    """The columns that ``masked`` renamed, under their old names."""
    return df.select(*[F.col(s).alias(c) for s, c in zip(safe, columns)])


def pick(df: DataFrame, *names: str) -> DataFrame:
    """Only these columns, whatever other columns are called."""
    return masked(df, *names)[0].select(*names)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def mix64(x: np.ndarray) -> np.ndarray:
    """A fixed bijection on 64-bit words (splitmix64's finish)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def release() -> None:
    """Give freed memory back to the system: Python workers live on between
    stages, and what they keep adds up with the next stage's needs."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def text_slices(texts: pa.Array, max_bytes: int = 8_000_000):
    """(first row, end row) ranges of about ``max_bytes`` text each; a row is never cut."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(texts), 0)).astype(np.int64)
    ends = np.cumsum(sizes)
    a = 0
    while a < len(texts):
        before = ends[a - 1] if a else 0
        b = max(a + 1, int(np.searchsorted(ends, before + max_bytes, side="right")))
        yield a, b
        a = b
    release()


def word_lists(texts: pa.Array):
    """Words ``[^\\x20\\x09-\\x0D]+`` of each text: (row offsets, dictionary
    codes of all words in order, dictionary). Null texts have none."""
    lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    flat = lists.flatten()
    starts = np.asarray(lists.offsets).astype(np.int64)
    starts = starts - starts[0]
    keep = np.asarray(pc.greater(pc.binary_length(flat), 0)) if len(flat) else np.zeros(0, bool)
    if not keep.all():
        starts = np.concatenate([[0], np.cumsum(keep)])[starts]
        flat = flat.filter(pa.array(keep))
    enc = flat.dictionary_encode() if len(flat) else pa.array([""]).dictionary_encode()[:0]
    return starts, np.asarray(enc.indices).astype(np.int64), enc.dictionary


def string_hashes(words: pa.Array, seed: int = 1) -> np.ndarray:
    """64-bit hash of each string of a (small) dictionary, the same in every process."""
    import xxhash
    f = xxhash.xxh3_64_intdigest
    return np.fromiter((f(w, seed) for w in words.cast(pa.binary()).to_pylist()), np.uint64, len(words))


def ragged_positions(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices starts[i] .. starts[i]+lengths[i]-1 of all i, concatenated."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(total, dtype=np.int64)


def null_first(column) -> "F.Column":
    """Null ids order before all others."""
    return F.coalesce(column, F.lit(-(2 ** 63)))
