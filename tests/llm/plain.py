"""Plain versions of the operators, for small tables."""

import collections
import hashlib
import itertools
import math
import re
import zlib

import numpy as np

WORD = re.compile(r"[^\x20\x09-\x0D]+")


class Links:
    """Union of linked things."""

    def __init__(self, n):
        self.up = list(range(n))

    def root(self, x):
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        self.up[self.root(a)] = self.root(b)

    def groups(self):
        out = collections.defaultdict(list)
        for k in range(len(self.up)):
            out[self.root(k)].append(k)
        return out.values()


def counts(text):
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words)"""
    words = WORD.findall(text or "")
    at = collections.defaultdict(list)
    for k in range(len(words) - 7):
        at[tuple(words[k:k + 8])].append(k)
    covered = {j for v in at.values() if len(v) > 1 for k in v for j in range(k, k + 8)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""),
            len(lines) - len(set(lines)), len(covered))


def vector_links(rows, least):
    """Sorted (vec_id, links, component) of rows (vec_id, vector, label)."""
    good = [k for k, (_, v, label) in enumerate(rows) if label is not None and v
            and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    unit = {}
    for k in good:
        x = np.array(rows[k][1], float)
        x /= abs(x).max()
        unit[k] = x / np.sqrt((x * x).sum())
    links, number = Links(len(rows)), collections.Counter()
    for n, a in enumerate(good):
        for b in good[n + 1:]:
            if rows[a][2] == rows[b][2] and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= least:
                links.join(a, b)
                number[a] += 1
                number[b] += 1
    return sorted((rows[k][0], number[k], min(rows[j][0] for j in g)) for g in links.groups() for k in g)


def without_repeats(docs, length):
    """{doc_id: (n_bytes, n_removed, n_spans, kept bytes)}"""
    seen, out = set(), {}
    for key, text in sorted(docs, key=lambda x: (x[0] is not None, x[0])):
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for k in range(len(raw) - length + 1):
            w = raw[k:k + length]
            if w in seen:
                gone[k:k + length] = b"\1" * length
            seen.add(w)
        spans = sum(1 for k in range(len(raw)) if gone[k] and not (k and gone[k - 1]))
        out[key] = (len(raw), sum(gone), spans, bytes(b for b, g in zip(raw, gone) if not g))
    return out


def shingles(text, width=5):
    words = WORD.findall(text or "")
    return {tuple(words[k:k + width]) for k in range(max(len(words) - width + 1, 1))} if words else set()


def near_duplicates(docs, least=0.8):
    """Counter of (doc_id, class_id, n_links) of rows (doc_id, text)."""
    sets = [shingles(t) for _, t in docs]
    having = collections.defaultdict(list)
    for k, s in enumerate(sets):
        for x in s:
            having[x].append(k)
    links, number = Links(len(docs)), collections.Counter()
    for a, s in enumerate(sets):
        common = collections.Counter(b for x in s for b in having[x] if b != a)
        for b, n in common.items():
            if n / (len(s) + len(sets[b]) - n) >= least:
                links.join(a, b)
                number[a] += 1
    least_id = lambda g: min((docs[k][0] for k in g), key=lambda i: (i is not None, i))
    return collections.Counter((docs[k][0], least_id(g), number[k]) for g in links.groups() for k in g)


def sha(data):
    return hashlib.sha256(data).hexdigest()


def ids_sha(ids):
    return sha(np.array(ids, "<u4").tobytes())


def ids_crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


CANONICAL = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def canonical(text):
    return CANONICAL.findall((text or "").translate(LOWER))


def decontaminated(docs, benchmark, size=10):
    """[(doc_id, n_words, n_hit, items, spans)] of rows (doc_id, text), items (item_id, text)."""
    having = collections.defaultdict(set)
    for item, text in benchmark:
        words = canonical(text)
        for k in range(max(len(words) - size + 1, min(len(words), 1))):
            having[tuple(words[k:k + size])].add("" if item is None else str(item))
    lengths, out = {len(p) for p in having}, []
    for doc, text in docs:
        words, hit, items = canonical(text), set(), set()
        for n in lengths:
            for k in range(len(words) - n + 1):
                if tuple(words[k:k + n]) in having:
                    hit |= set(range(k, k + n))
                    items |= having[tuple(words[k:k + n])]
        firsts, lasts = sorted(h for h in hit if h - 1 not in hit), sorted(h for h in hit if h + 1 not in hit)
        out.append((doc, len(words), len(hit), sorted(items), list(zip(firsts, lasts))))
    return out


def features(text, width, buckets):
    words = canonical(text)
    return [zlib.crc32(" ".join(words[k:k + n]).encode()) % buckets
            for n in range(1, width + 1) for k in range(len(words) - n + 1)]


def resampled(docs, target, percent, min_words, width, buckets, seed):
    """[(doc_id, n_features, weight, score, rank)], the first drawn first, undrawn ones in any order."""
    raw, aim = collections.Counter(), collections.Counter()
    for _, t in docs:
        raw.update(features(t, width, buckets))
    for t in target:
        aim.update(features(t, width, buckets))
    up, down = sum(raw.values()) + buckets, sum(aim.values()) + buckets
    rows = []
    for doc, text in docs:
        own = features(text, width, buckets)
        gains = [math.floor(1000 * math.log(((aim[b] + 1) * up) / ((raw[b] + 1) * down))) for b in own]
        weight = sum(gains) // len(gains) if gains else 0
        h = int(sha(f"{seed}:{'' if doc is None else doc}".encode())[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2 ** 32)))
        rows.append((doc, len(own), weight, score, len(canonical(text))))
    fit = sorted((r for r in rows if r[4] >= min_words), key=lambda r: (-r[3], r[0] is not None, r[0]))
    quota = percent * len(fit) // 100
    rest = [r for r in rows if r[4] < min_words] + fit[quota:]
    return [(*r[:4], k + 1) for k, r in enumerate(fit[:quota])] + [(*r[:4], None) for r in rest]


def audited(docs, labels):
    """{(part, order, step): counts} of rows (doc_id, text, source), labels (doc_id, quality, toxic)."""
    good, bad = {d for d, q, _ in labels if q == 1}, {d for d, _, t in labels if t == 1}
    least = {}
    for d, text, _ in docs:
        d = -2 ** 63 if d is None else d
        least[text or ""] = min(least.get(text or "", d), d)
    judged = []
    for d, text, part in docs:
        t, words = text or "", WORD.findall(text or "")
        fails = {"A": len(words) < 50, "B": 100 * len(set(words)) < 65 * len(words),
                 "C": 100 * len(re.findall("[A-Z]", t)) > 5 * len(t), "D": bool(re.search(r"[#$%&*|]", t)),
                 "E": (-2 ** 63 if d is None else d) > least[t]}
        judged.append((part or "", fails, d in good, d in bad))
    out = collections.defaultdict(lambda: [0] * 7)
    for order in itertools.permutations("ABCDE"):
        for part, fails, is_good, is_bad in judged:
            gone = False
            for k, name in enumerate(order):
                c, here = out[part, "".join(order), k + 1], fails[name] and not gone
                c[2] += fails[name] and gone
                gone |= fails[name]
                c[0] += not gone
                c[1] += here
                c[3] += fails[name] and sum(fails.values()) == 1
                c[4] += here and is_good
                c[5] += here and is_bad
    total = collections.Counter()
    for (part, order, k), c in out.items():
        total[part, order[k - 1]] += c[1]
    for (part, order, k), c in out.items():
        c[6] = total[part, order[k - 1]]
    return {k: tuple(map(int, c)) for k, c in out.items()}
