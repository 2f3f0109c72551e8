"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .audit import filter_audit
from .bpe import bpe_round_trip
from .chat import conversation_events, fold_events, format_digests, render
from .decontam import contaminated, digests
from .jaccard import near_duplicates
from .kernels import pick
from .packing import pack
from .quality import COUNTS, quality_rules
from .resample import resample
from .subspace import near_vectors
from .suffix import remove_repeats
from .tokenfile import token_files
from .toxicity import toxicity
from .urls import url_filter

URL_RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
             ("net", "/es/", "block"), ("net", "/fr/", "block")]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_file() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def op1_quality_rules(spark, sf_dir):
    judged = quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select("doc_id", *COUNTS[:5], "base_failed", "kept", "rejected_by")


def op2_subspace_pigeonhole(spark, sf_dir):
    return near_vectors(table(spark, sf_dir, "embeddings"), cosine=0.98)


def op3_toxicity_gru(spark, sf_dir):
    scored = toxicity(pick(table(spark, sf_dir, "documents"), "doc_id", "text"), table(spark, sf_dir, "labels"))
    return scored.select("doc_id", "held_out", "score", "predicted")


def op4_chat_formatting(spark, sf_dir):
    probe = "</s>[INST] ok [/INST]"
    own = spark.range(2).selectExpr("-7L AS conv_id", "id AS turn", "if(id = 0, 'user', 'assistant') AS role",
                                    f"'{probe}' AS text")
    conversations = pick(table(spark, sf_dir, "conversations"), "conv_id", "turn", "role", "text").unionByName(own)
    return format_digests(render(fold_events(conversation_events(conversations))))


def op5_suffix_dedup(spark, sf_dir):
    return remove_repeats(pick(table(spark, sf_dir, "documents"), "doc_id", "text"), length=100, keep_text=False)


def op6_chosen_path_join(spark, sf_dir):
    found = near_duplicates(table(spark, sf_dir, "documents"), width=5, threshold=0.8)
    return found.select("doc_id", "class_id", "n_links", "kept")


def op7_best_fit_packing(spark, sf_dir):
    return pack(table(spark, sf_dir, "documents"), tokenizer_file(), capacity=2048, end_id=0)


def op8_bpe_pair_index(spark, sf_dir):
    return bpe_round_trip(table(spark, sf_dir, "documents"), tokenizer_file())


def op9_huffman_token_files(spark, sf_dir):
    return token_files(table(spark, sf_dir, "documents"), tokenizer_file(), end_id=0)


def op10_url_filter(spark, sf_dir):
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_filter(table(spark, sf_dir, "pages"), rules).select("page_id", "host", "path", "rule", "verdict")


def op11_wu_manber_decontamination(spark, sf_dir):
    return digests(contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), size=10))


def op12_prefix_crc_resampling(spark, sf_dir):
    drawn = resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), percent=10, min_words=20)
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


def op13_filter_audit(spark, sf_dir):
    return filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {f.__name__: f for f in (
    op1_quality_rules, op2_subspace_pigeonhole, op3_toxicity_gru, op4_chat_formatting, op5_suffix_dedup,
    op6_chosen_path_join, op7_best_fit_packing, op8_bpe_pair_index, op9_huffman_token_files, op10_url_filter,
    op11_wu_manber_decontamination, op12_prefix_crc_resampling, op13_filter_audit)}

#: Lower-cased words of a text, as the decontamination and the resampling take them.
WORDS_SQL = r"""regexp_extract_all(translate(coalesce("text", ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

ORACLE_SQL = {
    "op4_chat_formatting": r"""
WITH rows_ AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce("text", '') AS t FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
sized AS (
  SELECT *, length(role) + length(t) + length(regexp_replace(role || t, '[^\\<\[]', '', 'g')) + 20 AS n FROM rows_)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || t || chr(10), '' ORDER BY turn, role, t)) AS turns_sha256,
       CAST(coalesce(sum(length(t)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(t, '' ORDER BY turn, role, t) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(n) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id
""",
    "op10_url_filter": r"""
WITH RECURSIVE rules(rhost, rpath, decision) AS (
  VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
         ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
split_ AS (
  SELECT page_id, url, html, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) END AS rest,
         lower(CASE WHEN instr(url, '://') > 0 THEN substr(url, 1, instr(url, '://') - 1) END) AS scheme FROM pages),
p AS (
  SELECT page_id, html, scheme,
         translate(coalesce(regexp_extract(rest, '^[^/?#]*', 0), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                   'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path,
         regexp_extract(rest, '^[^/?#]*([^#]*)', 1) AS tail FROM split_),
tags AS (
  SELECT *, scheme || '://' || host || tail AS node,
    list_transform(list_filter(regexp_extract_all(html, '(?is)<link\b[^>]*>'),
      lambda x: regexp_matches(x, '(?is)\brel\s*=\s*["'']?canonical\b')),
      lambda x: regexp_extract(x, '(?is)\bhref\s*=\s*["'']?([^\s"''>]+)', 1)) AS canonical,
    list_transform(list_filter(regexp_extract_all(html, '(?is)<meta\b[^>]*>'),
      lambda x: regexp_matches(x, '(?is)\bhttp-equiv\s*=\s*["'']?refresh\b')),
      lambda x: regexp_extract(x, '(?is)\burl\s*=\s*[''"]?([^\s"''>]+)', 1)) AS refresh
  FROM p),
targets AS (
  SELECT node, scheme, host, path, replace(target, '&amp;', '&') AS target
  FROM (SELECT node, scheme, host, path, unnest(list_concat(canonical, refresh)) AS target FROM tags) WHERE target <> ''),
relative AS (
  SELECT *, regexp_extract(target, '^[^?#]*') AS own, regexp_extract(target, '^[^?#]*(.*)$', 1) AS rest,
         CASE WHEN starts_with(target, '/') THEN '' ELSE coalesce(nullif(regexp_extract(path, '^(.*/)', 1), ''), '/') END AS folder
  FROM targets),
segments AS (SELECT *, string_split(folder || own, '/')[2:] AS parts FROM relative),
resolved AS (
  SELECT *, '/' || array_to_string(list_reduce(
      list_prepend(CAST([] AS VARCHAR[]), list_transform(CASE WHEN parts[-1] IN ('.', '..') THEN list_append(parts, '') ELSE parts END, lambda x: [x])),
      lambda acc, x: CASE WHEN x[1] = '..' THEN (CASE WHEN len(acc) > 1 THEN acc[1:len(acc) - 1] ELSE CAST([] AS VARCHAR[]) END)
                          WHEN x[1] = '.' THEN acc ELSE list_concat(acc, x) END), '/') AS clean FROM segments),
absolute AS (
  SELECT node, CASE WHEN regexp_matches(target, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN target
                    WHEN regexp_matches(target, '^[A-Za-z][A-Za-z0-9+.-]*:') OR starts_with(target, '#') THEN NULL
                    WHEN starts_with(target, '//') THEN scheme || ':' || target
                    WHEN starts_with(target, '?') THEN scheme || '://' || host || path || target
                    ELSE scheme || '://' || host || clean || rest END AS target FROM resolved),
ends AS (
  SELECT node AS a, lower(substr(target, 1, instr(target, '://') - 1)) || '://'
    || translate(regexp_extract(substr(target, instr(target, '://') + 3), '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                 'abcdefghijklmnopqrstuvwxyz')
    || regexp_extract(substr(target, instr(target, '://') + 3), '^[^/?#]*([^#]*)', 1) AS b
  FROM absolute WHERE target IS NOT NULL),
links AS (SELECT a, b FROM ends UNION SELECT b, a FROM ends),
reach(a, b) AS (SELECT a, a FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
urls AS (
  SELECT DISTINCT host, path FROM p
  UNION SELECT translate(regexp_extract(a, '://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               regexp_extract(a, '://[^/?#]*([^?#]*)', 1) FROM links),
own AS (
  SELECT host, path, arg_max(rhost || rpath, length(rhost || rpath)) AS rule,
         arg_max(decision, length(rhost || rpath)) AS decision
  FROM urls JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath) GROUP BY host, path),
votes AS (
  SELECT r.a AS node, max(CASE WHEN o.decision = 'allow' THEN 2 ELSE 1 END) AS vote
  FROM reach r JOIN own o ON o.host = regexp_extract(r.b, '://([^/?#]*)', 1)
                         AND o.path = regexp_extract(r.b, '://[^/?#]*([^?#]*)', 1) GROUP BY r.a)
SELECT page_id, t.host, t.path, o.rule,
       coalesce(o.decision, CASE v.vote WHEN 2 THEN 'allow' WHEN 1 THEN 'block' END, 'allow') AS verdict
FROM tags t LEFT JOIN own o ON o.host = t.host AND o.path = t.path LEFT JOIN votes v ON v.node = t.node
""",
    "op11_wu_manber_decontamination": f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {WORDS_SQL} AS w FROM documents),
b AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, {WORDS_SQL} AS w FROM benchmark),
pats AS (SELECT DISTINCT item, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS p
         FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
wins AS (SELECT r, i, n, array_to_string(w[i:i + n - 1], ' ') AS p
         FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM pats))),
found AS (SELECT r, i, wins.n, item FROM wins JOIN pats ON wins.n = pats.n AND wins.p = pats.p),
hit AS (SELECT r, count(DISTINCT k) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS k FROM found) GROUP BY r),
items AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS s
          FROM (SELECT DISTINCT r, item FROM found) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(s, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN items USING (r)
""",
    # CRC-32 from its table of 256 entries, byte by byte over the hex digits of each distinct word.
    "op12_prefix_crc_resampling": f"""
WITH crc AS (SELECT list_transform(range(256), lambda n: list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0],
               lambda c, z: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)) AS t),
d AS (SELECT row_number() OVER () AS r, doc_id, {WORDS_SQL} AS w FROM documents),
dw AS (SELECT r, unnest(w) AS x FROM d),
bw AS (SELECT unnest(w) AS x FROM (SELECT {WORDS_SQL} AS w FROM benchmark)),
bytes AS (SELECT x, hex(encode(x)) AS h FROM (SELECT x FROM dw UNION SELECT x FROM bw)),
words AS (SELECT x, xor(list_reduce(list_prepend(4294967295, list_transform(range(length(h) // 2),
                     lambda k: CAST('0x' || substr(h, 2 * k + 1, 2) AS BIGINT))),
                   lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 10000 AS bucket FROM bytes, crc),
s AS (SELECT bucket, count(*) AS n FROM dw JOIN words USING (x) GROUP BY 1),
t AS (SELECT bucket, count(*) AS n FROM bw JOIN words USING (x) GROUP BY 1),
gains AS (SELECT s.bucket, CAST(floor(1000 * ln(((coalesce(t.n, 0) + 1) * CAST((SELECT count(*) FROM dw) + 10000 AS DOUBLE))
                                                / ((s.n + 1) * CAST((SELECT count(*) FROM bw) + 10000 AS DOUBLE)))) AS BIGINT) AS g
          FROM s LEFT JOIN t ON s.bucket = t.bucket),
sums AS (SELECT r, CAST(sum(g) AS BIGINT) AS g FROM dw JOIN words USING (x) JOIN gains USING (bucket) GROUP BY r),
scored AS (
  SELECT r, doc_id, CAST(len(w) AS BIGINT) AS n_features,
         CASE WHEN len(w) = 0 THEN 0 ELSE CAST(floor(g / len(w)) AS BIGINT) END AS weight,
         CAST('0x' || substr(sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) AS h
  FROM d LEFT JOIN sums USING (r)),
noisy AS (SELECT *, weight + CAST(floor(-1000 * ln(-ln((h + 0.5) / 4294967296))) AS BIGINT) AS score FROM scored),
ranked AS (SELECT r, row_number() OVER (ORDER BY score DESC, doc_id NULLS FIRST) AS k, count(*) OVER () AS n
           FROM noisy WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CAST(CASE WHEN k <= 10 * n // 100 THEN k END AS BIGINT) AS rank
FROM noisy LEFT JOIN ranked USING (r)
""",
    "op13_filter_audit": r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(source, '') AS part, coalesce("text", '') AS t,
         regexp_extract_all(coalesce("text", ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
l AS (SELECT doc_id, max(CAST(quality = 1 AS INTEGER)) AS good, max(CAST(toxic = 1 AS INTEGER)) AS bad FROM labels GROUP BY doc_id),
firsts AS (SELECT t, min(coalesce(doc_id, -9223372036854775808)) AS least FROM d GROUP BY t),
m AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(bad, 0) AS bad,
         [len(w) < 50, 100 * len(list_distinct(w)) < 65 * len(w),
          100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 5 * length(t), regexp_matches(t, '[#$%&*|]'),
          coalesce(d.doc_id, -9223372036854775808) > least] AS fails
  FROM d JOIN firsts USING (t) LEFT JOIN l ON d.doc_id = l.doc_id),
c AS (SELECT part, good, bad, fails, count(*) AS n FROM m GROUP BY ALL),
f AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (SELECT a.x || b.x || c.x || d.x || e.x AS o FROM f a, f b, f c, f d, f e
           WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
steps AS (SELECT o, unnest(range(1, 6)) AS k FROM orders),
judged AS (
  SELECT part, o, k, n, good, bad, fails[ascii(o[k]) - 64] AS failed,
         len(list_filter(range(1, k), lambda j: fails[ascii(o[j]) - 64])) > 0 AS gone,
         len(list_filter(fails, lambda x: x)) AS n_fails FROM c, steps),
counted AS (
  SELECT part, o, k, sum(CASE WHEN NOT failed AND NOT gone THEN n ELSE 0 END) AS kept,
         sum(CASE WHEN failed AND NOT gone THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN failed AND gone THEN n ELSE 0 END) AS redundant,
         sum(CASE WHEN failed AND n_fails = 1 THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN failed AND NOT gone AND good = 1 THEN n ELSE 0 END) AS good_lost,
         sum(CASE WHEN failed AND NOT gone AND bad = 1 THEN n ELSE 0 END) AS toxic_lost FROM judged GROUP BY ALL)
SELECT part, o AS filter_order, CAST(k AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, o[k]) AS BIGINT) AS shapley
FROM counted
""",
}
