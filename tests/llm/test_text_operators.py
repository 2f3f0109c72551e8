"""Quality rules, toxicity, chat formatting, URL filters."""

import math
import random
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from plain import counts, sha
from pyspark.sql import functions as F

from wayfare.llm import chat, quality, queries, toxicity, urls

SF = "/root/testdata/sf0.001"
WORDS = "the of and river stone light over under green small house water".split()


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + str(rng.randrange(30)) for _ in range(n))


# ----------------------------------------------------------------- quality

EDGE_TEXTS = [None, "", " \n\t", "a", "x " * 50, "a\x0bb\x0cc\rd\te", "é\u00a0ü # * $", "one two\none two\n\n \none two",
              " ".join(f"w{k}" for k in range(8)) + " " + " ".join(f"w{k}" for k in range(8)), "w " * 30_000,
              "\n".join(["same line here"] * 9), "a b c d e f g h a b c d e f g h i"]


def test_counts_match_a_plain_version():
    rng = random.Random(1)
    texts = EDGE_TEXTS + [" ".join(rng.choice("ab|c#") for _ in range(rng.randrange(60))).replace("c", "\n") for _ in range(300)]
    got = quality.count_features(pa.array(texts, pa.string()))
    for k, t in enumerate(texts):
        if t is None or len(t) < 5000:
            assert tuple(int(got[c][k]) for c in quality.COUNTS[:5]) == counts(t), t
    assert got["n_repeat_words"][9] == 30_000


def test_binomial_tail_is_exact():
    for n, p in ((1, 0.3), (20, 0.02), (50, 0.5)):
        for k in range(n + 1):
            want = sum(math.comb(n, i) * p ** i * (1 - p) ** (n - i) for i in range(k + 1))
            assert quality.binomial_tail(k, n, p) == pytest.approx(want, rel=1e-9)


def test_cutoffs_never_exceed_the_bound_and_need_enough_labels():
    good, bad = np.zeros(101), np.zeros(101)
    good[0], bad[60] = 2000, 50
    assert quality.choose_cutoff(good, bad, 0.005, 0.003) == 60
    good[60] = 30
    assert quality.choose_cutoff(good, bad, 0.005, 0.003) is None
    assert quality.choose_cutoff(np.eye(101)[0] * 100, bad, 0.005, 0.003) is None
    assert quality.choose_cutoff(np.zeros(101), bad, 0.005, 0.003) is None


def labelled(spark, n=3000):
    rng = random.Random(2)
    rows, labels = [], []
    for k in range(n):
        bad = k % 10 == 0
        words = prose(rng, 40).split()
        rows.append((k, " ".join(w + "###" for w in words) if bad else " ".join(words), "en" if k % 3 else None, "kept"))
        labels.append((k, int(not bad), k % 7 == 0))
    labels += [(0, None, False), (None, 1, False), (10 ** 9, 1, True)]
    docs = spark.createDataFrame(rows + [(None, None, "xx", "a"), (n, "", "en", "b"), (5, rows[5][1], "en", "c")],
                                 "doc_id long, text string, lang string, n_words string")
    return docs, spark.createDataFrame(labels, "doc_id long, quality int, lang boolean")


def test_equal_texts_are_one_trial(spark):
    """Forty good texts a hundred times over say no more than forty."""
    rng = random.Random(4)
    good, bad = [prose(rng, 40) for _ in range(40)], [" ".join(w + "###" for w in prose(rng, 40).split()) for _ in range(300)]
    texts = good * 100 + bad
    docs = spark.createDataFrame([(k, t, "en") for k, t in enumerate(texts)], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(k, int(k < 4000)) for k in range(len(texts))], "doc_id long, quality int")
    counted = quality.with_counts(quality.with_text_hash(docs), keep_text=False)
    assert [r[k] for r in quality.calibrate(counted, labels).collect() for k in quality.RULES] == [None] * len(quality.RULES)
    distinct = spark.createDataFrame([(k, prose(rng, 40) if k < 4000 else texts[k], "en") for k in range(len(texts))],
                                     "doc_id long, text string, lang string")
    counted = quality.with_counts(quality.with_text_hash(distinct), keep_text=False)
    assert any(r[k] is not None for r in quality.calibrate(counted, labels).collect() for k in quality.RULES)


def test_quality_rules_learn_a_cutoff_per_stratum(spark):
    docs, labels = labelled(spark, 6000)
    got = {r["doc_id"]: r for r in quality.quality_rules(docs, labels).collect()}
    assert all(got[k]["kept"] == (k % 10 != 0) for k in range(6000) if k % 3)
    assert not got[None]["kept"] and got[None]["base_failed"] and got[6000]["base_failed"]
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns and kept.where("n_words = 'c'").count() == 1
    assert kept.where("doc_id % 10 = 0 AND doc_id % 3 <> 0").count() == 0


def test_quality_of_empty_tables(spark):
    docs, labels = labelled(spark, 30)
    assert quality.quality_rules(docs.limit(0), labels).count() == 0
    few = quality.quality_rules(docs, labels.limit(0))
    assert few.where("kept <> (NOT base_failed)").count() == 0 and few.count() == 33


def test_op1_counts_on_the_test_table(spark):
    got = queries.op1_quality_rules(spark, SF)
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = got.collect()
    assert len(rows) == len(texts)
    for r in rows:
        n = counts(texts[r["doc_id"]])
        assert tuple(r[c] for c in quality.COUNTS[:5]) == n
        assert r["base_failed"] == (n[0] < 20 or 100 * n[4] > 30 * n[0]) and not (r["kept"] and r["base_failed"])


# ---------------------------------------------------------------- toxicity

def toxic_table(n=1200, seed=3):
    rng = random.Random(seed)
    rows, labels = [], []
    for k in range(n):
        words = prose(rng, rng.randrange(20, 200)).split()
        if k % 4 == 0:
            for _ in range(5):
                words[rng.randrange(len(words))] = rng.choice(["grumf", "grumfed", "vexling"])
        rows.append((k, " ".join(words)))
        labels.append((k, int(k % 4 == 0)))
    return rows, labels


def test_gradients_match_finite_differences():
    rng = np.random.default_rng(0)
    words = pa.array(["alpha", "beta", "gamma", "a"])
    net = toxicity.Network.fresh({"alpha": 1, "beta": 2}, np.zeros(3, np.float32))
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    codes = rng.integers(0, 4, (6, 5))
    mask = np.ones((6, 5), bool)
    mask[3:, 1] = False
    y = np.array([0, 1, 1, 0, 1.0])
    _, g = net.gradients(words, codes, mask, y)
    for name in ("word", "gram", "input", "forth", "back", "attend", "out", "shift"):
        flat = np.flatnonzero(g[name].ravel())[:4]
        for k in flat:
            value = net.p[name].ravel()[k]
            ends = []
            for step in (1e-3, -1e-3):
                net.p[name].ravel()[k] = value + step
                ends.append(net.gradients(words, codes, mask, y)[0])
            net.p[name].ravel()[k] = value
            assert (ends[0] - ends[1]) / 2e-3 == pytest.approx(g[name].ravel()[k], rel=0.05, abs=2e-4), name


def test_every_window_is_in_one_stretch():
    starts = np.array([0, 0, 5, 37, 70, 1200, 1232])
    row, first, n, begin, size = toxicity.stretches(starts)
    sizes = np.diff(starts)
    for k in range(6):
        mine = row == k
        assert sorted(j for a, c in zip(first[mine], n[mine]) for j in range(a, a + c)) == list(range(max(sizes[k] - 31, 1)))
        for a, c, b, z in zip(first[mine], n[mine], begin[mine] - starts[k], size[mine]):
            assert b == max(a - 16, 0) and b + z == min(a + c - 1 + 32 + 16, sizes[k])


def plain_scores(net, words, table):
    """(greatest logit, its window) of one text: a loop over its stretches, words and windows."""
    H, best = toxicity.HIDDEN, (-np.inf, 0)
    windows = max(len(words) - 31, 1)
    for a in range(0, windows, toxicity.STRETCH):
        b = min(a + toxicity.STRETCH, windows)
        lo, hi = max(a - 16, 0), min(b - 1 + 32 + 16, len(words))
        states = np.zeros((hi - lo, 2 * H))
        for side, name in enumerate(("forth", "back")):
            u, h = net.p[name], np.zeros(H)
            for t in range(lo, hi) if side == 0 else range(hi - 1, lo - 1, -1):
                x, hu = table[words[t], side * 3 * H:(side + 1) * 3 * H], h @ u
                r, z = (toxicity.sigmoid(x[k * H:(k + 1) * H] + hu[k * H:(k + 1) * H]) for k in (0, 1))
                c = np.tanh(x[2 * H:] + r * hu[2 * H:])
                h = c + z * (h - c)
                states[t - lo, side * H:(side + 1) * H] = h
        for w in range(a, b):
            own = states[w - lo:min(w + 32, len(words)) - lo]
            if len(own):
                e = np.exp(own @ net.p["attend"])
                logit = (e / e.sum()) @ own @ net.p["out"] + net.p["shift"][0]
            else:
                logit = net.p["shift"][0]
            best = max(best, (logit, w), key=lambda x: x[0])
    return best


def test_scores_match_a_plain_scorer():
    rng = np.random.default_rng(3)
    names = [f"w{k}" for k in range(60)]
    net = toxicity.Network.fresh({n: k + 1 for k, n in enumerate(names[:40])}, rng.normal(size=41).astype(np.float32), seed=2)
    net.p["attend"] *= 4
    texts = [[], *(rng.integers(0, 60, n).tolist() for n in (1, 5, 31, 32, 33, 64, 190, 223, 224, 225, 700, 40, 40))]
    starts = np.cumsum([0, *map(len, texts)])
    codes = np.array([c for t in texts for c in t], np.int64)
    table = net.gate_table(pa.array(names))
    for block in (3, 1024):
        top, at = net.text_logits(starts, codes, pa.array(names), block=block)
        for k, t in enumerate(texts):
            want, window = plain_scores(net, t, table)
            assert top[k] == pytest.approx(want, abs=1e-4) and at[k] == window
    # One window by itself, as training sees it.
    t = texts[11]
    place = np.arange(100, 164)
    pool = ((np.arange(64) >= 16) & (np.arange(64) < 48))[:, None]
    logit = net.run(table, np.array(t)[place][:, None], np.ones((64, 1), bool), pool)[0][0]
    both = net.all_windows(table, np.array(t)[place][:, None], np.array([64]))
    assert both[16, 0] == pytest.approx(logit, abs=1e-4)


def test_a_passage_at_any_place_is_found(spark):
    rows, labels = toxic_table(800, seed=5)
    rng = random.Random(6)
    clean = prose(rng, 300).split()
    placed = [(10_000 + k, " ".join(clean[:60 + k] + ["grumf", "vexling", "grumfed"] * 2 + clean[60 + k:])) for k in range(40)]
    docs = spark.createDataFrame(rows + placed + [(20_000, " ".join(clean))], "doc_id long, text string")
    got = {r["doc_id"]: r["predicted"] for r in toxicity.toxicity(
        docs, spark.createDataFrame(labels, "doc_id long, toxic int")).where("doc_id >= 10000").collect()}
    assert got.pop(20_000) == 0 and set(got.values()) == {1}


def test_training_texts_are_whole(spark):
    rng = random.Random(8)
    rows = [(k, prose(rng, 9000 if k % 5 else 20)) for k in range(40)]
    labels = spark.createDataFrame([(k, k % 2) for k in range(40)], "doc_id long, toxic int")
    texts, y, share = toxicity.training_sample(spark.createDataFrame(rows, "doc_id long, text string"), labels, 100)
    want = [(t, k % 2) for k, t in rows if zlib.crc32(str(k).encode()) % 5]
    assert list(zip(texts, y.astype(int).tolist())) == want and share == pytest.approx(np.mean([c for _, c in want]))


def test_toxicity_held_out_accuracy(spark):
    rows, labels = toxic_table()
    rng = random.Random(9)
    long = prose(rng, 30_000).split()
    clean = " ".join(long)
    long[-20:-10] = ["grumf"] * 10
    docs = spark.createDataFrame(rows + [(5000, None), (5001, ""), (None, "a grumf"), (5002, " ".join(long)),
                                         (5003, clean), (7, rows[7][1])], "doc_id long, text string").withColumn("score", F.lit("x"))
    table = spark.createDataFrame(labels + [(1, None), (None, 1)], "doc_id long, toxic int")
    got = toxicity.toxicity(docs.drop("score"), table).collect()
    assert len(got) == len(rows) + 6
    truth = dict(labels)
    held = [r for r in got if r["held_out"]]
    assert all((zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) == r["held_out"] for r in got if r["doc_id"] is not None)
    known = [r for r in held if r["doc_id"] in truth]
    assert sum(r["predicted"] == truth[r["doc_id"]] for r in known) >= 0.97 * len(known) > 100
    by = {r["doc_id"]: r for r in got}
    assert by[5002]["predicted"] == 1 and by[5002]["score"] > by[5003]["score"]
    assert 0 <= by[5000]["score"] == by[5001]["score"] < 0.5 and not by[None]["held_out"]
    kept = toxicity.keep_clean(docs, table)
    assert kept.columns == docs.columns and kept.where("score = 'x'").count() == kept.count()
    assert kept.where("doc_id < 1000 AND doc_id % 4 = 0").count() <= 10


def test_toxicity_without_examples(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    one = spark.createDataFrame([(1, 1)], "doc_id long, toxic int")
    for labels in (none, one):
        assert [r["score"] for r in toxicity.toxicity(docs, labels).collect()] == [0.0, 0.0]
    assert toxicity.toxicity(docs.limit(0), none).count() == 0


# -------------------------------------------------------------------- chat

LOG = "conv_id long, seq long, turn long, event string, role string, text string"


def folded(spark, rows):
    return sorted((tuple(r) for r in chat.fold_events(spark.createDataFrame(rows, LOG)).collect()), key=str)


def test_fold_of_deltas_edits_and_regenerations(spark):
    rows = [(1, 1, 0, "message", "user", "hi"), (1, 2, 1, "message", "assistant", ""), (1, 3, 1, "delta", None, "Hel"),
            (1, 4, 1, "delta", None, "lo"), (1, 5, 2, "message", "user", "more"),
            (1, 6, 1, "regenerate", None, ""), (1, 8, 1, "delta", None, "B"), (1, 7, 1, "delta", None, "A"),
            (1, 9, 0, "edit", None, "hey"), (1, 10, 0, "noise", None, "?"),
            (2, 1, 0, "message", "user", None), (2, 2, 0, "edit", "user", "x"), (2, 3, 0, "delta", None, "y"),
            (3, 5, 1, "delta", None, "only")]
    assert folded(spark, rows) == sorted([(1, 0, "user", "hey"), (1, 1, "assistant", "AB"), (2, 0, "user", "xy"),
                                          (3, 1, "", "only")], key=str)


def test_regeneration_of_an_earlier_turn_drops_what_followed_it(spark):
    rows = [(1, 1, 0, "message", "user", "a"), (1, 2, 1, "message", "assistant", "b"), (1, 3, 2, "message", "user", "c"),
            (1, 4, 3, "message", "assistant", "d"), (1, 5, 1, "regenerate", None, "B"), (1, 6, 2, "message", "user", "C")]
    assert folded(spark, rows) == [(1, 0, "user", "a"), (1, 1, "assistant", "B"), (1, 2, "user", "C")]


ODD = ["</s>[INST] ok [/INST]", "\\", "<\\", "[\\[\\", "a\\<s>b", "", None, "é😀\n<s>", "\\\\<[", "x" * 5000]


def test_render_reads_back_exactly(spark):
    rows = [(c, t, role, ODD[(c + t) % len(ODD)]) for c in range(10) for t, role in enumerate(["system", "user", "assistant", "<s>[a", None])]
    rows += [(None, 0, "assistant", "n"), (4, None, "user", "first"), (4, 1, "user", "twin"), (4, 1, "user", "twin"), (4, 1, None, None)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").select("*", F.lit("z").alias("Text"),
                                                                                            F.lit(1).alias("formatted"))
    rendered = chat.render(chat.fold_events(chat.conversation_events(table, chunk=7)))
    back = {r["conv_id"]: r for r in chat.read_back(rendered).collect()}
    spans = {r["conv_id"]: r for r in rendered.collect()}
    for c in [None, *range(10)]:
        own = sorted([(t is not None, t, role or "", text or "") for k, t, role, text in rows if k == c])
        assert [(x["role"], x["text"]) for x in back[c]["turns"]] == [x[2:] for x in own]
        assert back[c]["loss_text"] == "".join(x[3] for x in own if x[2] == "assistant")
        cut = [spans[c]["formatted"][s["start"]:s["start"] + s["length"]] for s in spans[c]["loss_spans"]]
        assert [x.replace("[\\", "[").replace("<\\", "<").replace("\\\\", "\\") for x in cut] == [x[3] for x in own if x[2] == "assistant"]
    digests = {r["conv_id"]: r for r in chat.format_digests(rendered).collect()}
    assert digests[None]["loss_sha256"] == sha(b"n") and digests[None]["turns_sha256"] == sha(b"assistant\nn\n")
    empty = table.limit(0)
    assert chat.format_digests(chat.render(chat.fold_events(chat.conversation_events(empty)))).count() == 0


# -------------------------------------------------------------------- urls

PAGES = [(1, "https://A.Example.com/en/1?x=/y", None), (2, "http://www.example.com/en/2#t", ""), (3, "http://x.net/es/", None),
         (4, None, None), (5, "nothing", "<link rel=canonical href=http://x.net/es/>"), (6, "http://x.net", None),
         (7, "http://a.org/1", '<LINK REL="canonical" href="http://X.net/es/9">'), (8, "http://b.org/2", "<meta http-equiv=refresh content='0; url=http://a.org/1'>"),
         (9, "http://c.org/3", '<link href="/4" rel="canonical">'), (10, "http://c.org/4", '<link rel="canonical" href="http://q.com/">'),
         (11, "http://d.org/5?a=1&b=2", None), (12, "http://d.org/6", '<link rel="canonical" href="http://d.org/5?a=1&amp;b=2">'),
         (13, "http://d.org/5?a=1&b=2", '<link rel="canonical" href="http://z.net/fr/x">'), (13, "http://d.org/5?a=1&b=2", None),
         (None, "http://notexample.com/en/", None), (14, "HTTP://exAmple.COM/en/", None), (15, "a://b://c/es/", None),
         (16, "http://net/fr/" + "y" * 3000, None), (17, "http://k.net/EN/", None), (18, "http://x.net?q/es/", None)]


def test_url_rules_and_aliases(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").select(
        "*", F.lit(1).alias("host"), F.lit("").alias("URL"))
    rules = spark.createDataFrame(queries.URL_RULES + [(None, "/", "block"), ("org", None, "block"), ("x.net", "/es/", "what")],
                                  "host string, path string, verdict string")
    got = {r["page_id"]: r for r in urls.url_filter(pages, rules).collect()}
    verdicts = {k: (r["rule"], r["verdict"]) for k, r in got.items()}
    assert verdicts[1] == ("example.com/en/", "block") and verdicts[2] == ("www.example.com/en/", "allow")
    assert got[1]["host"] == "a.example.com" and got[1]["path"] == "/en/1"
    assert verdicts[3] == ("net/es/", "block") and verdicts[4] == (None, "allow") == verdicts[5] == verdicts[6]
    assert verdicts[7] == (None, "block") == verdicts[8], "aliases of a blocked url"
    assert verdicts[9] == (None, "allow") == verdicts[10], "aliases of an allowed url"
    assert verdicts[11] == (None, "block") == verdicts[12] == verdicts[13]
    assert verdicts[None] == ("com/", "allow") and verdicts[14] == ("example.com/en/", "block")
    assert got[15]["path"] == "//c/es/" and verdicts[16] == ("net/fr/", "block") and verdicts[17] == (None, "allow")
    assert got[18]["path"] == "" and verdicts[18] == (None, "allow")
    assert len(got) == 19 and urls.url_filter(pages, rules).count() == 20
    assert urls.url_filter(pages.limit(0), rules).count() == 0
    more = spark.createDataFrame([("http://x.net", "http://m.net/fr/"), (None, "http://x.net")], "source string, target string")
    assert {r["page_id"]: r["verdict"] for r in urls.url_filter(pages, rules, more).collect()}[6] == "block"


def link(*targets, tag='<link rel="canonical" href="{}">'):
    return "\n".join(tag.format(t) for t in targets)


#: Pages whose blocked alias is behind a second tag or a relative target, or is not an alias at all.
LINKED = [(100, "http://r.org/a/b/c.html", link("http://r.org/free", "http://x1.net/es/")),
          (101, "http://r1.org/a", link("http://r1.org/b") + "<META url='http://x2.net/fr/' HTTP-EQUIV='refresh'>"),
          (102, "http://r2.org/a/b/c.html?z", link("en/x.html")), (103, "http://r2.org/a/b/en/x.html", link("http://x3.net/es/")),
          (104, "http://r3.org/a/b/c", link("../x")), (105, "http://r3.org/a/x", link("http://x4.net/es/")),
          (106, "http://r4.org/q?p=1", link("?p=2")), (107, "http://r4.org/q?p=2", link("http://x5.net/es/")),
          (108, "http://r5.org", link("./k/../../m/.")), (109, "http://r5.org/m/", link("http://x6.net/es/")),
          (110, "http://r6.org/a", link("mailto:a@x.net/es/", "#top", "javascript:x")), (111, "http://r6.org/b", link("http://x7.net/es/")),
          (112, "http://r7.org/a", link("/x?u=http://x8.net/es/")), (113, "http://r7.org/x?u=http://x8.net/es/", None),
          (114, "http://r8.org/a/b", link("../../..")), (115, "http://r8.org/", link("http://x9.net/fr/")),
          (116, "http://r9.org/a", "<link rel=icon href=http://x.net/es/>"), (117, "http://r10.org/d/", link("e;f//g")),
          (118, "http://r10.org/d/e;f//g", link("http://x10.net/fr/"))]


def test_every_tag_and_relative_target_counts(spark, tmp_path):
    pages = spark.createDataFrame(LINKED + PAGES, "page_id long, url string, html string")
    pages.write.parquet(str(tmp_path / "pages.parquet"))
    got = sorted((tuple(r) for r in queries.op10_url_filter(spark, str(tmp_path)).collect()), key=str)
    verdicts = {r[0]: r[4] for r in got}
    assert {k for k in verdicts if k and k >= 100 and verdicts[k] == "allow"} == {110, 112, 113, 116}
    con = duckdb.connect()
    con.sql(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    assert got == sorted(con.sql(queries.ORACLE_SQL["op10_url_filter"]).fetchall(), key=str)


def test_url_query_matches_its_sql(spark, tmp_path):
    spark.createDataFrame(PAGES, "page_id long, url string, html string").coalesce(1).write.parquet(str(tmp_path / "pages.parquet"))
    got = sorted((tuple(r) for r in queries.op10_url_filter(spark, str(tmp_path)).collect()), key=str)
    con = duckdb.connect()
    con.sql(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    assert got == sorted(con.sql(queries.ORACLE_SQL["op10_url_filter"]).fetchall(), key=str)


@pytest.mark.parametrize("name", ["op4_chat_formatting", "op10_url_filter"])
def test_native_queries_match_their_sql(spark, name):
    con = duckdb.connect()
    for t in ("conversations", "pages"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    rel = con.sql(queries.ORACLE_SQL[name])
    got = queries.QUERIES[name](spark, SF).select(*rel.columns)
    assert sorted((tuple(r) for r in got.collect()), key=str) == sorted(rel.fetchall(), key=str)
