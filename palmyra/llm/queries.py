"""Registered queries over the document tables, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palmyra.llm import (collocations, decontaminate, fingerprint, merkle, mixing, ngram_join,
                         pii, quality, secret_scan, sharding, token_store, toxicity, warc)
from palmyra.llm.common import prepare_workers
from palmyra.sources.writers import scratch_path

Query = Callable[[SparkSession, str], DataFrame]

N_SHARDS = 24
#: Weights of domains and languages, and the token budget as a share of one epoch.
MIX_WEIGHTS = {"domain": {"web": 0.5, "reference": 0.3, "community": 0.2},
               "lang": {"en": 0.5, "de": 0.2, "fr": 0.2, "es": 0.1}}
MIX_SHARE = 0.8
MIX_EPOCHS = 2
REFERENCE_SOURCES = [f"src{i}" for i in range(1, 10)]

QUERIES: dict[str, Query] = {}


def registered(query: Query) -> Query:
    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        prepare_workers(spark)
        return query(spark, sf_dir)

    QUERIES[query.__name__] = run
    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def domain_of(source: str = "source"):
    return (F.when(F.col(source) == "src0", "web")
            .when(F.col(source).isin(REFERENCE_SOURCES), "reference").otherwise("community"))


@registered
def op1_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch_path(spark, "tokens")
    token_store.write_tokens(table(spark, sf_dir, "documents"), out)
    return token_store.read_tokens(spark, out, with_ids=False).select(
        "doc_id", "start", "n_tokens", "ids_crc32")


@registered
def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.find(table(spark, sf_dir, "documents"), path_col="source")


@registered
def op3_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"), F.col("all_tokens") * MIX_SHARE,
                       MIX_WEIGHTS, domain_of(), MIX_EPOCHS)
    return mixed.select("doc.doc_id", "domain", "lang", "source",
                        F.col("epoch").cast("long").alias("epoch"), "tokens")


@registered
def op4_warc_captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc.captured_pages(spark, table(spark, sf_dir, "pages"), scratch_path(spark, "warc"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@registered
def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.compare_edits(table(spark, sf_dir, "documents"))


@registered
def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_join(table(spark, sf_dir, "documents"))


@registered
def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"),
                                        table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items",
                        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
                        "contaminated")


@registered
def op8_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.summary(pii.find(table(spark, sf_dir, "documents")))


@registered
def op9_rendezvous_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(table(spark, sf_dir, "documents"), [1.0] * N_SHARDS)


@registered
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@registered
def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.audit(table(spark, sf_dir, "documents"))


@registered
def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(table(spark, sf_dir, "documents"))


@registered
def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents")).select(
        "doc_id", *quality.MEASURES, "base_failed", "kept")


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = f"regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
_FIELD = "coalesce(octet_length(encode(CAST({0} AS VARCHAR))) || ':' || {0}, '-')"
_LEAF = "sha256(" + " || ".join(_FIELD.format(c) for c in
                                ("doc_id", "source", "lang", "n_chars", "{text}")) + ")"
#: Characters of each class of op13, in the order of quality.CLASSES.
_INSIDE = ["a-z", "A-Z", "0-9", r" \t", r"\n\r\x0B\x0C", ".,;:", "!?", "''\"()\\[\\]{}\\-/", "#*$%&|<>",
           r"+=@_\^~`\\", r"\x{80}-\x{27F}", r"\x{280}-\x{7FF}", r"\x{800}-\x{FFFF}",
           r"\x{10000}-\x{10FFFF}"]
_COUNT = lambda inside: f"len(regexp_replace(t, '[^{inside}]', '', 'g'))"
_JS = ("sqrt(least(greatest(list_sum([CASE WHEN z[1] > 0 THEN z[1] * log2(2 * z[1] / (z[1] + z[2])) ELSE 0 END"
       " + CASE WHEN z[2] > 0 THEN z[2] * log2(2 * z[2] / (z[1] + z[2])) ELSE 0 END"
       " FOR z IN list_zip({p}, {q})]) / 2, 0), 1))")
_CHANCE = "sqrt({bins} / (8 * ln(2) * greatest({n}, 1)))"
_CASES = lambda column, weights: " ".join(
    f"WHEN {column} = '{k}' THEN {round(1000 * w)}" for k, w in weights.items())


def _level(name: str, path: list[str], before: str) -> str:
    """Shares of one level of the source tree, as mixing.divide has them."""
    keys, parent = ", ".join(path), ", ".join(path[:-1])
    by = f"PARTITION BY {parent}" if parent else ""
    weights = MIX_WEIGHTS.get(path[-1])
    weight = f"CASE {_CASES(path[-1], weights)} ELSE 1000 END" if weights else "1000"
    budget = (f"JOIN {before} USING ({parent})" if parent else
              f"CROSS JOIN (SELECT CAST(floor(sum(tokens) * {MIX_SHARE}) AS BIGINT) AS budget FROM leaf)")
    return f"""
{name}_nodes AS (
  SELECT {keys}, CAST(sum(tokens) AS BIGINT) * {MIX_EPOCHS} AS capacity,
         CAST({weight} AS BIGINT) AS weight FROM leaf GROUP BY {keys}),
{name}_unit AS (
  SELECT *, CAST(budget - coalesce(sum(capacity) OVER (
                {by} ORDER BY capacity / weight, {path[-1]}
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE)
            / CAST(sum(weight) OVER (
                {by} ORDER BY capacity / weight, {path[-1]}
                ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE) AS unit
  FROM {name}_nodes {budget}),
{name} AS (
  SELECT {keys}, least(capacity, CAST(floor(weight * greatest(max(unit) OVER ({by}), 0))
                                      AS BIGINT)) AS budget FROM {name}_unit)"""


ORACLE: dict[str, str] = {
    "op3_source_mix": f"""
WITH docs AS (
  SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         CASE WHEN source = 'src0' THEN 'web'
              WHEN source IN ({", ".join(f"'{s}'" for s in REFERENCE_SOURCES)}) THEN 'reference'
              ELSE 'community' END AS domain,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^ \\t\\n\\r]+')) AS BIGINT) AS tokens
  FROM documents),
leaf AS (SELECT domain, lang, source, sum(tokens) AS tokens FROM docs GROUP BY ALL),
{_level("d", ["domain"], "")},
{_level("l", ["domain", "lang"], "d")},
{_level("s", ["domain", "lang", "source"], "l")},
placed AS (
  SELECT *, sum(tokens) OVER (PARTITION BY domain, lang, source
                              ORDER BY epoch, md5('{mixing.SEED}:' || epoch || ':' || doc_id)) AS upto
  FROM docs, (SELECT unnest(range({MIX_EPOCHS})) AS epoch))
SELECT doc_id, domain, lang, source, epoch, tokens
FROM placed JOIN s USING (domain, lang, source) WHERE budget > 0 AND upto <= budget""",
    "op4_warc_captures": f"""
WITH p AS (
  SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes,
         sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes < {warc.MIN_REVISIT_BYTES} OR page_id = first
            THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN payload_bytes >= {warc.MIN_REVISIT_BYTES} AND page_id <> first
            THEN CAST(first AS DOUBLE) END AS refers_to FROM f""",
    "op6_ngram_join": f"""
WITH RECURSIVE words AS (SELECT doc_id, {_WORDS} AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_sort(list_distinct([array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)]))
    END AS s FROM words),
named AS (SELECT min(doc_id) OVER (PARTITION BY s) AS representative,
                 count(*) OVER (PARTITION BY s) AS n_copies, doc_id, s FROM sets),
reps AS MATERIALIZED (SELECT * FROM named WHERE doc_id = representative AND len(s) > 0),
shingles AS MATERIALIZED (SELECT doc_id, unnest(s) AS g FROM reps),
pairs AS MATERIALIZED (
  SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared
                    FROM shingles x JOIN shingles y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY ALL)
  JOIN reps p ON p.doc_id = a JOIN reps q ON q.doc_id = b
  WHERE shared >= {ngram_join.THRESHOLD} * (len(p.s) + len(q.s) - shared)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM reps
          UNION SELECT reach.a, pairs.b FROM reach JOIN pairs ON reach.b = pairs.a),
class AS (SELECT a, min(b) AS class_id FROM reach GROUP BY a),
links AS (SELECT a, sum(r.n_copies) AS n FROM pairs JOIN reps r ON r.doc_id = b GROUP BY a)
SELECT n.doc_id,
       CASE WHEN len(n.s) = 0 THEN n.doc_id ELSE c.class_id END AS class_id,
       CASE WHEN len(n.s) = 0 THEN n.doc_id ELSE n.representative END AS representative,
       CASE WHEN len(n.s) = 0 THEN 1 ELSE n.n_copies END AS n_copies,
       CASE WHEN len(n.s) = 0 THEN 0
            ELSE CAST(coalesce(l.n, 0) + n.n_copies - 1 AS BIGINT) END AS n_links
FROM named n LEFT JOIN class c ON c.a = n.representative LEFT JOIN links l ON l.a = n.representative""",
    "op7_decontamination": f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS w FROM benchmark),
windows AS MATERIALIZED (
  SELECT DISTINCT item, n, unnest([array_to_string(w[i:i + n - 1], ' ')
                                   FOR i IN range(1, len(w) - n + 2)]) AS g
  FROM (SELECT *, least(len(w), 10) AS n FROM b WHERE len(w) > 0)),
lengths AS (SELECT DISTINCT n FROM windows),
grams AS (
  SELECT doc_id, n, unnest(range(1, len(w) - n + 2)) AS pos,
         unnest([array_to_string(w[i:i + n - 1], ' ') FOR i IN range(1, len(w) - n + 2)]) AS g
  FROM d, lengths WHERE len(w) >= n),
hits AS MATERIALIZED (SELECT doc_id, n, pos, item FROM grams JOIN windows USING (n, g)),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit
            FROM (SELECT doc_id, unnest(range(pos, pos + n)) AS p FROM hits) GROUP BY doc_id),
items AS (SELECT doc_id, count(DISTINCT item) AS n_items,
                 string_agg(DISTINCT item, ',' ORDER BY item) AS list FROM hits GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(list, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)""",
    "op11_merkle_manifest": f"""
WITH RECURSIVE given AS (
  SELECT doc_id, source, lang, n_chars, text,
         coalesce(list_reduce(
           [ord(c) FOR c IN string_split(CAST(doc_id AS VARCHAR), '')],
           lambda crc, c: list_reduce(range(8), lambda v, i: CASE WHEN v & 1 = 1
             THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, xor(crc, c)), 4294967295), 0) AS crc
  FROM documents),
rows AS (
  SELECT doc_id, lang, {_LEAF.format(text="text")} AS leaf,
         CASE WHEN doc_id IS NOT NULL AND xor(crc, 4294967295) % 3 = 0
              THEN {_LEAF.format(text="translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")}
              ELSE {_LEAF.format(text="text")} END AS claimed FROM given),
placed AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos
           FROM rows),
tree AS (
  SELECT lang, 0 AS level, list(leaf ORDER BY pos) AS nodes FROM placed GROUP BY lang
  UNION ALL
  SELECT lang, level + 1, [sha256(array_to_string(nodes[8 * i + 1:8 * i + 8], ''))
                           FOR i IN range(0, (len(nodes) + 7) // 8)] FROM tree WHERE len(nodes) > 1),
subroots AS (SELECT lang, nodes[1] AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS place
             FROM tree WHERE len(nodes) = 1),
above AS (
  SELECT 0 AS level, list(subroot ORDER BY place) AS nodes FROM subroots HAVING count(*) > 0
  UNION ALL
  SELECT level + 1, [sha256(array_to_string(nodes[8 * i + 1:8 * i + 8], ''))
                     FOR i IN range(0, (len(nodes) + 7) // 8)] FROM above WHERE len(nodes) > 1),
steps AS (
  SELECT p.pos, p.lang, t.level, CAST(floor(p.pos / 8 ** t.level) AS BIGINT) AS node, nodes
  FROM placed p JOIN tree t ON t.lang IS NOT DISTINCT FROM p.lang AND len(t.nodes) > 1
  UNION ALL
  SELECT p.pos, p.lang, 1000 + a.level, CAST(floor(s.place / 8 ** a.level) AS BIGINT), nodes
  FROM placed p JOIN subroots s ON s.lang IS NOT DISTINCT FROM p.lang JOIN above a ON len(a.nodes) > 1),
sides AS (
  SELECT pos, lang, row_number() OVER (PARTITION BY lang, pos ORDER BY level) AS nth,
         array_to_string(nodes[node - node % 8 + 1:node], '') AS before,
         array_to_string(nodes[node + 2:node - node % 8 + 8], '') AS after FROM steps),
fold AS (
  SELECT lang, pos, 0 AS nth, claimed AS node FROM placed
  UNION ALL
  SELECT f.lang, f.pos, f.nth + 1, sha256(s.before || f.node || s.after)
  FROM fold f JOIN sides s ON s.lang IS NOT DISTINCT FROM f.lang AND s.pos = f.pos AND s.nth = f.nth + 1),
ends AS (SELECT lang, pos, arg_max(node, nth) AS folded_root FROM fold GROUP BY lang, pos),
proofs AS (SELECT lang, pos, string_agg(before || after, '' ORDER BY nth) AS siblings
           FROM sides GROUP BY lang, pos)
SELECT p.doc_id, p.leaf, s.subroot, r.nodes[1] AS root, sha256(coalesce(siblings, '')) AS proof_sha256,
       folded_root, folded_root = r.nodes[1] AS verified
FROM placed p JOIN subroots s ON s.lang IS NOT DISTINCT FROM p.lang
JOIN above r ON len(r.nodes) = 1
JOIN ends e ON e.lang IS NOT DISTINCT FROM p.lang AND e.pos = p.pos
LEFT JOIN proofs q ON q.lang IS NOT DISTINCT FROM p.lang AND q.pos = p.pos""",
    "op12_phrase_collocations": f"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array({_LOWER}, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces),
grams AS (
  SELECT lang, k, unnest([w[i:i + k - 1] FOR i IN range(1, len(w) - k + 2)]) AS g
  FROM w, (SELECT unnest([1, 2, 3]) AS k) WHERE len(w) >= k),
f AS MATERIALIZED (SELECT lang, k, g, count(*) AS f FROM grams GROUP BY ALL),
sizes AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
candidates AS MATERIALIZED (SELECT * FROM f WHERE k > 1 AND f >= {collocations.LEAST}),
parts AS (SELECT *, unnest(range(1, k)) AS cut FROM candidates),
cuts AS (
  SELECT p.lang, p.k, p.g, p.f AS a, cut, l.f AS l, r.f AS r,
         CAST((1000000::HUGEINT * p.f * p.f) // (l.f::HUGEINT * r.f) AS BIGINT) AS score
  FROM parts p JOIN f l ON l.lang = p.lang AND l.g = p.g[1:cut]
  JOIN f r ON r.lang = p.lang AND r.g = p.g[cut + 1:p.k]),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, cut) = 1),
inner_pairs AS (SELECT lang, unnest([g[1:2], g[2:3]]) AS g, f FROM candidates WHERE k = 3),
covers AS (SELECT lang, g, max(f) AS f FROM inner_pairs GROUP BY ALL),
kept AS (
  SELECT b.* FROM best b LEFT JOIN covers c ON c.lang = b.lang AND c.g = b.g
  WHERE c.f IS NULL OR 100 * c.f < {collocations.INSIDE} * b.a),
ranked AS (
  SELECT lang, array_to_string(g, ' ') AS phrase, a, l, r, score,
         row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(g, ' ')) AS rank
  FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN sizes USING (lang)
WHERE rank <= {collocations.TOP}""",
    "op13_quality_rules": f"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce('=' || lang, '') AS g, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w, {_WORDS} AS terms
  FROM documents),
windows AS (SELECT rid, unnest(range(1, len(w) - 1)) AS pos,
                   unnest([w[i:i + 2] FOR i IN range(1, len(w) - 1)]) AS x FROM d WHERE len(w) >= 3),
twice AS (SELECT rid, unnest([pos, pos + 1, pos + 2]) AS p
          FROM (SELECT *, count(*) OVER (PARTITION BY rid, x) AS n FROM windows) WHERE n > 1),
again AS (SELECT rid, count(DISTINCT p) AS n FROM twice GROUP BY rid),
lines AS (SELECT rid, count(*) - count(DISTINCT line) AS n
          FROM (SELECT rid, unnest(string_split(t, chr(10))) AS line FROM d)
          WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY rid),
measured AS MATERIALIZED (
  SELECT d.rid, doc_id, g, t, terms, len(w) AS n_words,
         CAST(coalesce(list_sum([len(x) FOR x IN w]), 0) AS BIGINT) AS word_chars,
         {_COUNT("#*$%&|<>")} AS n_symbols, coalesce(lines.n, 0) AS n_dup_lines,
         coalesce(again.n, 0) AS n_repeat_words,
         [{", ".join(_COUNT(c) for c in _INSIDE)}] AS named
  FROM d LEFT JOIN again USING (rid) LEFT JOIN lines USING (rid)),
based AS MATERIALIZED (
  SELECT * EXCLUDE (named, t), len(t) AS n_chars,
         n_words < {quality.LEAST_WORDS} OR 100 * n_repeat_words > 50 * n_words AS base_failed,
         [x / greatest(len(t), 1) FOR x IN list_append(named, len(t) - list_sum(named))] AS shares,
         len(t) > 0 AS filled
  FROM measured),
sound AS (SELECT g, rid, shares FROM based WHERE NOT base_failed),
units AS (SELECT g, rid, unnest(range({quality.N_CLASSES})) AS i,
                 CAST(floor(unnest(shares) * {quality.SHARE}) AS BIGINT) AS s FROM sound),
first_means AS (SELECT g, i, sum(s) / (count(*) * {quality.SHARE}.0::DOUBLE) AS m FROM units GROUP BY g, i),
first AS (SELECT g, list(m ORDER BY i) AS reference FROM first_means GROUP BY g),
steps AS (SELECT s.g, rid, floor({_JS.format(p="shares", q="reference")} * {quality.STEPS}) AS step
          FROM sound s JOIN first f ON s.g = f.g),
medians AS (SELECT g, min(step) AS median FROM (
  SELECT g, step, count(*) OVER (PARTITION BY g ORDER BY step) AS upto, count(*) OVER (PARTITION BY g) AS n
  FROM steps) WHERE upto * 2 >= n GROUP BY g),
near AS (SELECT s.rid FROM steps s JOIN medians m ON s.g = m.g WHERE step <= median),
second_means AS (SELECT g, i, sum(s) / (count(*) * {quality.SHARE}.0::DOUBLE) AS m, count(*) AS n
                 FROM units WHERE rid IN (SELECT rid FROM near) GROUP BY g, i),
reference AS (SELECT g, list(m ORDER BY i) AS reference FROM second_means WHERE n >= {quality.LEAST_DOCS} GROUP BY g),
term AS (SELECT rid, g, x, {quality.SHARE} // len(terms) AS s, len(terms) AS n
         FROM (SELECT rid, g, terms, unnest(terms) AS x FROM based)),
ranked AS (SELECT g, x, sum(s) AS s, row_number() OVER (PARTITION BY g ORDER BY sum(s) DESC, x) AS rank
           FROM term GROUP BY g, x),
top AS MATERIALIZED (SELECT r.g, x, rank, s / (n * {quality.SHARE}.0::DOUBLE) AS share
        FROM ranked r JOIN (SELECT g, greatest(count(*) FILTER (filled), 1) AS n FROM based GROUP BY g) sizes
          ON r.g = sizes.g WHERE rank <= {quality.COMMON_WORDS}),
lists AS (SELECT g, list(share ORDER BY rank) AS q FROM top GROUP BY g),
found AS (SELECT rid, rank, count(*) / any_value(n) AS p FROM term JOIN top ON term.g = top.g AND term.x = top.x
          GROUP BY rid, rank),
words AS (SELECT rid, map_from_entries(list((rank, p))) AS ps FROM found GROUP BY rid),
pairs AS (SELECT b.rid, len(terms) AS n, list_append(q, greatest(1 - list_sum(q), 0)) AS q,
                 [coalesce(ps[i], 0) FOR i IN range(1, len(q) + 1)] AS p
          FROM based b JOIN lists l ON b.g = l.g LEFT JOIN words ON words.rid = b.rid
          WHERE len(terms) >= {quality.LEAST_WORDS_COMMON}),
apart AS (SELECT rid, {_JS.format(p="list_append(p, 1 - list_sum(p))", q="q")}
            > {quality.WORD_MARGIN} + {_CHANCE.format(bins="len([x FOR x IN q IF x > 0])", n="n")} AS far FROM pairs)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND (reference IS NULL OR NOT (coalesce(far, false)
         OR {_JS.format(p="shares", q="reference")}
            > {quality.CLASS_MARGIN} + {_CHANCE.format(bins="len([x FOR x IN reference IF x >= 0.001])", n="n_chars")}))
       AS kept
FROM based b LEFT JOIN reference r ON b.g = r.g LEFT JOIN apart a ON a.rid = b.rid""",
}
