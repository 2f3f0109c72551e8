"""Removal of repeated byte strings over a whole corpus by prefix-free parsing.

Every byte that a string of ``length`` bytes covers goes, if the string also
starts earlier in the corpus (a smaller doc_id, or earlier in the document).

* Rolling-hash triggers parse each document into phrases (``repeats``). A
  window of ``length`` bytes lies in exactly one phrase, and equal windows have
  the same trigger at the same place.
* The dictionary has each distinct phrase once, at its first occurrence; the
  parse's other occurrences repeat whole, so their bytes are covered.
  Phrases are told apart by 128 bits of hashes, and their occurrences are
  dealt by trigger. Every map task first drops its own repetitions, so a
  phrase that a third of all documents have is one row per task.
* Only dictionary phrases that share their trigger with others can hold
  further repetitions. Their texts are fetched, and per bucket the suffixes of
  the dictionary that start a window are sorted by their first ``length`` bytes and,
  where equal, by their place in the parse: of equal ones, all but the first in
  corpus order are covered. Phrases of one trigger are sorted together, a bounded
  slice of triggers at a time. Triggers with more than ``hot`` such phrases are dealt by window
  instead (one row per distinct window and task), with the same result.

All tables move as packed rows, one per task and bucket; the number of buckets
follows the amount of text. Covered ranges meet the texts again
in a join by document.

Defined results: a null text is empty and a null doc_id comes first; rows with
equal ids are documents of their own, in the order of a hash of their texts;
rows that repeat both id and text count as one document and have equal
results; texts under ``length`` bytes stay whole; in ``kept_text`` the rest of a
character that a removed range cuts is dropped; empty tables give no rows;
other columns pass through, but for those with the name of a result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .kernels import masked, materialise, mix64, partitions, ragged_positions, release, ship, text_slices, worker_cache
from .repeats import phrases

ship(__name__)

ROWS = "kind int, bucket int, payload binary"
ROWS_ARROW = pa.schema([("kind", pa.int32()), ("bucket", pa.int32()), ("payload", pa.binary())])
#: Kinds of packed rows and their columns.
SPANS, PHRASES, CONTESTED, TEXTS, WINDOWS = range(5)
PLACE = [("doc", "<i8"), ("sub", "<u4")]
LAYOUT = {
    SPANS: [*PLACE, ("start", "<u4"), ("end", "<u4")],
    PHRASES: [("h", "<u8"), ("g", "<u8"), *PLACE, ("first", "<u4"), ("more", "u1")],
    CONTESTED: [("h", "<u8"), *PLACE, ("first", "<u4"), ("more", "u1"), ("hot", "u1")],
    TEXTS: [("h", "<u8"), *PLACE, ("first", "<u4"), ("more", "u1"), ("data", "u1")],
    WINDOWS: [("h", "<u8"), ("g", "<u8"), *PLACE, ("first", "<u4")],
}


# ------------------------------------------------------------- packed rows

def pack(kind: int, columns: dict[str, np.ndarray]) -> bytes:
    parts = [np.ascontiguousarray(columns[n], t).tobytes() for n, t in LAYOUT[kind]]
    head = np.array([len(p) for p in parts], "<u8").tobytes()
    return zstandard.ZstdCompressor(level=1).compress(head + b"".join(parts))


def unpack(kind: int, payloads: list[bytes]) -> dict[str, np.ndarray]:
    layout, found = LAYOUT[kind], {n: [] for n, _ in LAYOUT[kind]}
    for p in payloads:
        raw = zstandard.ZstdDecompressor().decompress(p)
        at = 8 * len(layout)
        for (n, t), size in zip(layout, np.frombuffer(raw[:at], "<u8").tolist()):
            found[n].append(np.frombuffer(raw, t, size // np.dtype(t).itemsize, at))
            at += size
    return {n: np.concatenate([np.zeros(0, t), *found[n]]) for n, t in layout}


def dealt(kind: int, columns: dict[str, np.ndarray], bucket: np.ndarray):
    """(kind, bucket, payload) of each bucket that has rows."""
    order = np.argsort(bucket, kind="stable")
    cuts = np.flatnonzero(np.diff(bucket[order], prepend=-1)).tolist()
    for a, b in zip(cuts, [*cuts[1:], len(order)]):
        if b > a:
            some = order[a:b]
            yield kind, int(bucket[some[0]]), pack(kind, {n: v[some] for n, v in columns.items()})


def as_batch(rows) -> pa.RecordBatch:
    rows = list(rows)
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(ROWS_ARROW)],
                                      schema=ROWS_ARROW)


def by_doc(doc: np.ndarray, sub: np.ndarray, buckets: int) -> np.ndarray:
    """By id and text: rows that share only their id are dealt apart."""
    key = mix64(doc.astype(np.int64).view(np.uint64)) + sub.astype(np.uint64)
    return (mix64(key) % np.uint64(buckets)).astype(np.int64)


def by_hash(h: np.ndarray, buckets: int) -> np.ndarray:
    return (mix64(h) % np.uint64(buckets)).astype(np.int64)


def payloads(table: pa.Table, kind: int) -> list[bytes]:
    return table.filter(pc.equal(table["kind"], kind))["payload"].to_pylist()


# ----------------------------------------------------------------- documents

def raw_texts(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(all bytes, offsets) of texts; null texts are empty."""
    x = pc.fill_null(texts, "").cast(pa.large_binary())
    ends = np.frombuffer(x.buffers()[1], np.int64)[x.offset:x.offset + len(x) + 1]
    data = x.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[ends[0]:ends[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, ends - ends[0]


def doc_keys(ids: pa.Array, raw: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(id, null as the least; hash of the text) of documents."""
    import xxhash
    ids = np.asarray(pc.fill_null(ids.cast(pa.int64()), -(2 ** 63)))
    view = memoryview(np.ascontiguousarray(raw))
    sub = [xxhash.xxh32_intdigest(view[a:b]) for a, b in zip(starts[:-1].tolist(), starts[1:].tolist())]
    return ids, np.array(sub, np.uint32)


def merged_spans(doc, sub, start, end) -> dict[str, np.ndarray]:
    """Spans of documents, those that meet or overlap as one. Sorted by (doc, sub, start)."""
    if not len(doc):
        return {"doc": doc, "sub": sub, "start": start, "end": end}
    order = np.lexsort((start, sub, doc))
    doc, sub, start, end = doc[order], sub[order], start[order].astype(np.int64), end[order].astype(np.int64)
    new = np.concatenate([[True], (doc[1:] != doc[:-1]) | (sub[1:] != sub[:-1])])
    group = np.cumsum(new) - 1
    # Running maximum of the ends within a document.
    top = np.maximum.accumulate(end + group * (1 << 33)) - group * (1 << 33)
    cut = np.flatnonzero(new | np.concatenate([[True], start[1:] > top[:-1]]))
    last = np.append(cut[1:], len(doc)) - 1
    return {"doc": doc[cut], "sub": sub[cut], "start": start[cut], "end": top[last]}


def distinct_places(c: dict[str, np.ndarray], *names: str) -> dict[str, np.ndarray]:
    """Sorted rows, one of those that are equal in these columns. Rows that repeat
    id and text have the same phrases at the same places: no repetitions."""
    new = np.ones(len(c["doc"]), bool)
    new[1:] = np.any([c[n][1:] != c[n][:-1] for n in names], 0)
    return {n: v[new] for n, v in c.items()}


# --------------------------------------------------------------------- steps

def parse(docs: DataFrame, length: int, buckets: int, flush: int = 250_000) -> DataFrame:
    """Each task's distinct phrases, dealt by trigger, and the spans of their repetitions in the task."""
    def rows_of(held):
        c = {n: np.concatenate([x[n] for x in held]) for n in held[0]}
        order = np.lexsort((c["first"], c["sub"], c["doc"]))
        c = distinct_places({n: v[order] for n, v in c.items()}, "doc", "sub", "first")
        by = np.argsort(c["g"], kind="stable")
        again = np.zeros(len(by), bool)
        again[by[1:]] = (c["g"][by[1:]] == c["g"][by[:-1]]) & (c["h"][by[1:]] == c["h"][by[:-1]])
        rep = {n: v[again] for n, v in c.items()}
        spans = merged_spans(rep["doc"], rep["sub"], rep["first"], rep["first"] + rep["more"] + length)
        yield from dealt(SPANS, spans, by_doc(spans["doc"], spans["sub"], buckets))
        own = {n: v[~again] for n, v in c.items()}
        yield from dealt(PHRASES, own, by_hash(own["h"], buckets))

    def run(batches):
        worker_cache("suffix")
        held, n = [], 0
        for batch in batches:
            for a, b in text_slices(batch.column(1), 1_000_000):
                raw, starts = raw_texts(batch.column(1)[a:b])
                ids, sub = doc_keys(batch.column(0)[a:b], raw, starts)
                doc, first, last, _, h, g = phrases(raw, starts, length)
                held.append({"h": h, "g": g, "doc": ids[doc], "sub": sub[doc],
                             "first": first - starts[doc], "more": last - first})
                n += len(h)
                if n > flush:
                    yield as_batch(rows_of(held))
                    held, n = [], 0
        if n:
            yield as_batch(rows_of(held))
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, ROWS)


def dictionary(parsed: DataFrame, length: int, buckets: int, hot: int) -> DataFrame:
    """Per bucket of triggers: spans of all but the first occurrence of each
    phrase, and the dictionary phrases that share their trigger; all by document."""
    def run(table: pa.Table) -> pa.Table:
        out = [(SPANS, int(b), p) for b, p in zip(table["bucket"].to_pylist(), table["payload"].to_pylist())] \
            if table["kind"][0].as_py() == SPANS else []
        c = unpack(PHRASES, payloads(table, PHRASES))
        if len(c["h"]):
            order = np.lexsort((c["first"], c["sub"], c["doc"], c["g"], c["h"]))
            c = distinct_places({n: v[order] for n, v in c.items()}, "h", "g", "doc", "sub", "first")
            new_h = np.concatenate([[True], c["h"][1:] != c["h"][:-1]])
            new = new_h | np.concatenate([[True], c["g"][1:] != c["g"][:-1]])
            again = {n: v[~new].astype(np.int64) if n in ("first", "more") else v[~new] for n, v in c.items()}
            spans = merged_spans(again["doc"], again["sub"], again["first"], again["first"] + again["more"] + length)
            out += dealt(SPANS, spans, by_doc(spans["doc"], spans["sub"], buckets))
            group = np.cumsum(new_h) - 1
            distinct = np.bincount(group[new])[group]
            some = new & (distinct > 1)
            shared = {n: v[some] for n, v in c.items()} | {"hot": distinct[some] > hot}
            out += dealt(CONTESTED, shared, by_doc(shared["doc"], shared["sub"], buckets))
        release()
        return pa.Table.from_batches([as_batch(out)])
    return parsed.groupBy("kind", "bucket").applyInArrow(run, ROWS)


def packed_texts(docs: DataFrame, buckets: int) -> DataFrame:
    """The documents, compressed, one row per task's slice and bucket of documents."""
    names = docs.columns

    def run(batches):
        for batch in batches:
            texts = batch.column(names.index("text"))
            for a, b in text_slices(texts, 8_000_000):
                part = batch.slice(a, b - a)
                bucket = by_doc(*doc_keys(part.column(names.index("doc_id")), *raw_texts(part.column(names.index("text")))), buckets)
                out = []
                for k in np.unique(bucket):
                    sink = pa.BufferOutputStream()
                    own = part.take(pa.array(np.flatnonzero(bucket == k)))
                    with pa.ipc.new_stream(sink, own.schema,
                                           options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
                        writer.write_batch(own)
                    out.append((TEXTS, int(k), sink.getvalue().to_pybytes()))
                yield as_batch(out)
    docs = docs.withColumn("doc_id", F.col("doc_id").cast("long")).withColumn("text", F.col("text").cast("string"))
    return docs.mapInArrow(run, ROWS)


def unpacked_texts(table: pa.Table) -> pa.Table | None:
    found = [pa.ipc.open_stream(p).read_all() for p in table["payload"].to_pylist()]
    return pa.concat_tables(found).combine_chunks() if found else None


def column(table: pa.Table, name: str) -> pa.Array:
    x = table[name].combine_chunks()
    return pa.concat_arrays(x.chunks) if isinstance(x, pa.ChunkedArray) else x


def contested_texts(texts: DataFrame, contested: DataFrame, length: int, buckets: int) -> DataFrame:
    """The bytes of the shared-trigger phrases by trigger; of hot triggers their windows by hash."""
    from .repeats import word64

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        docs, c = unpacked_texts(left), unpack(CONTESTED, right["payload"].to_pylist())
        if docs is not None and len(c["h"]):
            raw, starts = raw_texts(column(docs, "text"))
            ids, sub = doc_keys(column(docs, "doc_id"), raw, starts)
            row = {k: r for r, k in enumerate(zip(ids.tolist(), sub.tolist()))}
            at = np.fromiter((row[k] for k in zip(c["doc"].tolist(), c["sub"].tolist())), np.int64, len(c["h"]))
            begin, more = starts[at] + c["first"], c["more"].astype(np.int64)
            cold = np.flatnonzero(c["hot"] == 0)
            bucket = by_hash(c["h"][cold], buckets)
            order = np.argsort(bucket, kind="stable")
            cuts = np.flatnonzero(np.diff(bucket[order], prepend=-1)).tolist()
            for a, b in zip(cuts, [*cuts[1:], len(order)]):
                some = cold[order[a:b]]
                data = raw[ragged_positions(begin[some], more[some] + length)]
                out.append((TEXTS, int(bucket[order[a]]), pack(TEXTS, {n: v[some] for n, v in c.items()} | {"data": data})))
            warm = np.flatnonzero(c["hot"])
            if len(warm):
                place = ragged_positions(begin[warm], more[warm] + 1)
                own = np.repeat(warm, more[warm] + 1)
                eight = word64(raw)
                h, g = np.zeros(len(place), np.uint64), c["h"][own]
                for k in [*range(0, length - 8, 8), length - 8]:
                    h = mix64(h * np.uint64(0x9E3779B97F4A7C15) + eight[place + k])
                    g = mix64(g * np.uint64(0xA5CB9243B3D7A52D) ^ eight[place + k])
                w = {"h": h, "g": g, "doc": c["doc"][own], "sub": c["sub"][own], "first": place - starts[at[own]]}
                order = np.lexsort((w["first"], w["sub"], w["doc"], g, h))
                w = {n: v[order] for n, v in w.items()}
                again = np.concatenate([[False], (w["h"][1:] == w["h"][:-1]) & (w["g"][1:] == w["g"][:-1])])
                spans = merged_spans(w["doc"][again], w["sub"][again], w["first"][again], w["first"][again] + length)
                out += dealt(SPANS, spans, by_doc(spans["doc"], spans["sub"], buckets))
                rest = {n: v[~again] for n, v in w.items()}
                out += dealt(WINDOWS, rest, by_hash(rest["h"], buckets))
        return pa.Table.from_batches([as_batch(out)])
    return texts.groupBy("bucket").cogroup(contested.groupBy("bucket")).applyInArrow(run, ROWS)


def repeated_suffixes(data: np.ndarray, places: np.ndarray, length: int) -> np.ndarray:
    """Numbers of those ``places`` (in corpus order) at which ``length`` bytes begin
    that also begin at an earlier one: the suffixes there are sorted by these bytes."""
    view = np.lib.stride_tricks.sliding_window_view(data, length)
    suffix = np.ascontiguousarray(view[places]).view(f"S{length}").ravel()
    by = np.argsort(suffix, kind="stable")
    return by[1:][suffix[by[1:]] == suffix[by[:-1]]]


def trigger_runs(h: np.ndarray, size: np.ndarray, most: int) -> list[tuple[int, int]]:
    """Ranges of whole groups of equal ``h`` (sorted) of about ``most`` bytes."""
    ends = np.append(np.flatnonzero(h[1:] != h[:-1]) + 1, len(h)) if len(h) else np.zeros(0, np.int64)
    total, out, a = np.concatenate([[0], np.cumsum(size)]), [], 0
    while a < len(h):
        k = int(np.searchsorted(total[ends], total[a] + most, side="right"))
        b = int(ends[min(max(k - 1, int(np.searchsorted(ends, a, side="right"))), len(ends) - 1)])
        out.append((a, b))
        a = b
    return out


def suffix_order(fetched: DataFrame, length: int, buckets: int, most: int = 1_000_000) -> DataFrame:
    """Spans of the dictionary's windows that also start earlier. Phrases with one
    trigger are sorted together, about ``most`` bytes of them at a time."""
    def run(table: pa.Table) -> pa.Table:
        kind = table["kind"][0].as_py()
        if kind == SPANS:
            return table
        c = unpack(kind, table["payload"].to_pylist())
        found = []
        if kind == WINDOWS:
            by = np.lexsort((c["first"], c["sub"], c["doc"], c["g"], c["h"]))
            equal = (c["h"][by[1:]] == c["h"][by[:-1]]) & (c["g"][by[1:]] == c["g"][by[:-1]])
            again = by[1:][equal]
            first = c["first"][again].astype(np.int64)
            found.append(merged_spans(c["doc"][again], c["sub"][again], first, first + length))
        else:
            size = c["more"].astype(np.int64) + length
            begin = np.cumsum(size) - size
            order = np.lexsort((c["first"], c["sub"], c["doc"], c["h"]))
            for a, b in trigger_runs(c["h"][order], size[order], most):
                # The slice's phrases, and so the windows in them, in corpus order.
                some = order[a:b]
                some = some[np.lexsort((c["first"][some], c["sub"][some], c["doc"][some]))]
                data = c["data"][ragged_positions(begin[some], size[some])]
                start, more = np.cumsum(size[some]) - size[some], c["more"][some].astype(np.int64)
                place = ragged_positions(start, more + 1)
                again = repeated_suffixes(data, place, length)
                if not len(again):
                    continue
                phrase = np.searchsorted(start, place[again], side="right") - 1
                own = some[phrase]
                first = c["first"][own].astype(np.int64) + place[again] - start[phrase]
                found.append(merged_spans(c["doc"][own], c["sub"][own], first, first + length))
        spans = {n: np.concatenate([np.zeros(0, t), *(f[n] for f in found)]) for n, t in (
            ("doc", "<i8"), ("sub", "<u4"), ("start", "<i8"), ("end", "<i8"))}
        del c, found
        release()
        spans = merged_spans(spans["doc"], spans["sub"], spans["start"], spans["end"])
        return pa.Table.from_batches([as_batch(dealt(SPANS, spans, by_doc(spans["doc"], spans["sub"], buckets)))])
    return fetched.groupBy("kind", "bucket").applyInArrow(run, ROWS)


RESULT = [("n_bytes", pa.int64(), "long"), ("n_removed", pa.int64(), "long"), ("n_spans", pa.int64(), "long"),
          ("kept_sha256", pa.string(), "string"), ("kept_text", pa.string(), "string")]


def without_spans(texts: DataFrame, spans: DataFrame, columns: list[tuple[str, str]], keep_text: bool) -> DataFrame:
    """Every document less its spans."""
    result = [r for r in RESULT if keep_text or r[0] != "kept_text"]

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        docs, names = unpacked_texts(left), [n for n, _ in columns]
        if docs is None:
            return pa.Table.from_batches([], pa.schema([(n, t) for n, t, _ in result]))
        raw, starts = raw_texts(column(docs, "text"))
        ids, sub = doc_keys(column(docs, "doc_id"), raw, starts)
        c = unpack(SPANS, right["payload"].to_pylist())
        row: dict[tuple, list[int]] = {}
        for r, k in enumerate(zip(ids.tolist(), sub.tolist())):
            row.setdefault(k, []).append(r)
        # The spans of each row, rows that repeat id and text having the same ones.
        at = [row[k] for k in zip(c["doc"].tolist(), c["sub"].tolist())]
        times = np.fromiter(map(len, at), np.int64, len(at))
        own = np.array([r for x in at for r in x], np.int64)
        spans = merged_spans(own, np.zeros(len(own), np.int64), np.repeat(c["start"], times), np.repeat(c["end"], times))
        cuts = np.searchsorted(spans["doc"], np.arange(len(ids) + 1)).tolist()
        first, last = spans["start"].tolist(), spans["end"].tolist()
        view, ends = memoryview(np.ascontiguousarray(raw)), starts.tolist()
        removed, digests, kept = [], [], []
        for r in range(len(ids)):
            base, pieces, done = ends[r], [], 0
            for k in range(cuts[r], cuts[r + 1]):
                pieces.append(view[base + done:base + first[k]])
                done = last[k]
            pieces.append(view[base + done:ends[r + 1]])
            left = sum(map(len, pieces))
            removed.append(ends[r + 1] - base - left)
            h = hashlib.sha256()
            for p in pieces:
                h.update(p)
            digests.append(h.hexdigest())
            if keep_text:
                kept.append(str(pieces[0], "utf-8", "ignore") if len(pieces) == 1 else b"".join(pieces).decode("utf-8", "ignore"))
        out = [column(docs, n) for n in names]
        out += [pa.array(np.diff(starts)), pa.array(removed, pa.int64()), pa.array(np.diff(cuts)), pa.array(digests, pa.string())]
        if keep_text:
            out.append(pa.array(kept, pa.string()))
        del docs, raw, view, kept
        release()
        return pa.Table.from_arrays(out, names=[*names, *(n for n, _, _ in result)])
    types = [f"`{n}` {t}" for n, t in columns] + [f"{n} {t}" for n, _, t in result]
    return texts.groupBy("bucket").cogroup(spans.groupBy("bucket")).applyInArrow(run, ", ".join(types))


def remove_repeats(docs: DataFrame, length: int = 100, hot: int = 20_000, keep_text: bool = True,
                   bucket_bytes: int = 8_000_000) -> DataFrame:
    """The documents (without ``text``) with n_bytes, n_removed, n_spans,
    kept_sha256 and, with ``keep_text``, kept_text. A task holds one bucket of
    about ``bucket_bytes`` of text, or a longer document, at a time."""
    names = docs.columns
    docs, safe = masked(docs, "doc_id", "text")
    total = docs.agg(F.sum(F.octet_length(F.col("text").cast("string")))).first()[0] or 0
    buckets = max(partitions(docs.sparkSession), -(-total // bucket_bytes))
    found = materialise(dictionary(parse(docs, length, buckets), length, buckets, hot), "phrases")
    texts = docs.select("doc_id", "text")
    fetched = contested_texts(packed_texts(texts, buckets), found.where(f"kind = {CONTESTED}"), length, buckets)
    more = materialise(suffix_order(fetched, length, buckets), "suffixes")
    spans = found.where(f"kind = {SPANS}").unionByName(more)
    docs = docs.withColumn("doc_id", F.col("doc_id").cast("long"))
    columns = [(f.name, f.dataType.simpleString()) for f in docs.schema if f.name != "text"]
    out = without_spans(packed_texts(docs, buckets), spans, columns, keep_text)
    results = [n for n, _, _ in RESULT if n in out.columns]
    kept = [(s, c) for s, c in zip(safe, names) if s != "text" and c not in results]
    return out.select(*[F.col(s).alias(c) for s, c in kept], *results)
