"""Registered queries of this folder, with SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from millrace.catalogue.common import Registry, table
from millrace.llm import chat, language, mixing
from millrace.llm.divergence import divergence
from millrace.llm.fill_middle import fill_middle, restore
from millrace.llm.harmonic import pack_documents, packing_digests
from millrace.llm.lattice import near_vectors
from millrace.llm.line_dedup import drop_lines
from millrace.llm.near_copies import near_copies
from millrace.llm.packed_ids import packed_files
from millrace.llm.stable_search import nearest
from millrace.llm.surrogates import KINDS, replace_entities
from millrace.llm.token_counts import count_tokens
from millrace.session import scratch_path

_R = Registry()
QUERIES, SQL = _R.queries, _R.sql

WORD_VOCABULARY = "word_bpe_49k.json"
PIECE_VOCABULARY = "piece_bpe_32k.model"


@_R.add()
def op1_stable_search(spark, d):
    return nearest(table(spark, d, "embeddings"), F.col("vec_id") % 100 == 0)


#: A conversation whose texts hold the template's own marks.
MARKED = (-7, r"\### Assistant: </turn> ok")

_OP2 = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), e AS (
  SELECT *, replace(replace(replace(text, '\', '\\'), '</turn>', '<\/turn>'), '### ', '#\## ') AS body,
    CASE WHEN regexp_full_match(role, '[a-z]+') THEN role
      ELSE '=' || replace(replace(replace(replace(role, '\', '\\'), '</turn>', '<\/turn>'), '### ', '#\## '), ': ', ':\ ') END AS head
  FROM c
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn, role, text)) AS loss_sha256,
  CAST(sum(length(head) + length(body) + 14) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id"""


@_R.add(_OP2)
def op2_chat_formatting(spark, d):
    own = spark.createDataFrame(
        [(MARKED[0], 0, "user", MARKED[1]), (MARKED[0], 1, "assistant", MARKED[1])], "conv_id long, turn long, role string, text string"
    )
    rows = table(spark, d, "conversations").select("conv_id", "turn", "role", "text").union(own)
    return chat.digests(chat.format_chats(chat.log_of(rows)))


@_R.add()
def op3_packed_ids(spark, d):
    return packed_files(table(spark, d, "documents"), public_tokenizers.path(WORD_VOCABULARY))


@_R.add()
def op4_language_id(spark, d):
    docs = table(spark, d, "documents")
    return language.identify(docs, language.train(docs))


#: Exponents on observed shares: rare languages, sources and topics get more than their part.
MIX_TARGETS = {"source": 0.7, "lang": 0.5, "topic": 0.6}
MIX_PART = 0.5
#: The operator stops where all margins hold; SQL writes out more rounds than that takes.
MIX_TOLERANCE = 1e-12
_SQL_ROUNDS, _SQL_SCALES = 15, 16

_STEP = """
  {name} AS (SELECT s, l, t, mass, ts, tl, tt, n, CASE WHEN sum(f) OVER (PARTITION BY {key}) > 0
    THEN f * {target} / sum(f) OVER (PARTITION BY {key}) ELSE 0 END AS f FROM {of})"""


def _rake_sql(rounds: int) -> str:
    """Rounds of raking written out one after the other, and rounds of the capped scale."""
    steps, of = [], "base"
    for i in range(rounds):
        for key, target in (("s", "ts"), ("l", "tl"), ("t", "tt")):
            steps.append(_STEP.format(name=f"r{i}{key}", key=key, target=target, of=of))
            of = f"r{i}{key}"
    scales = ["k0 AS (SELECT (SELECT wanted FROM total) / (SELECT sum(f) FROM fitted) AS k)"]
    for i in range(1, _SQL_SCALES + 1):
        scales.append(
            f"k{i} AS (SELECT coalesce(((SELECT wanted FROM total) - sum(CASE WHEN f * p.k >= mass THEN mass ELSE 0 END))"
            f" / nullif(sum(CASE WHEN f * p.k >= mass THEN 0 ELSE f END), 0), max(p.k)) AS k FROM fitted, k{i - 1} p)"
        )
    return f"""
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS s, coalesce(lang, '') AS l,
    CASE WHEN contains(x, 'Licensed under') OR contains(x, 'is licensed under') OR contains(x, 'All rights reserved') THEN 'legal'
      WHEN contains(x, ' | ') THEN 'table' WHEN contains(x, '!!') OR contains(x, '***') OR contains(x, '%%%') THEN 'marked'
      ELSE 'prose' END AS t,
    greatest(1, CAST(ceil(length(x) / 4.0) AS BIGINT)) AS w
  FROM (SELECT doc_id, source, lang, coalesce(text, '') AS x FROM documents)
), c AS (SELECT s, l, t, sum(w) AS mass FROM d GROUP BY s, l, t),
  total AS (SELECT sum(mass) * 0.5 AS wanted FROM c),
  ms AS (SELECT s, pow(sum(mass), 0.7) AS p FROM c GROUP BY s), ml AS (SELECT l, pow(sum(mass), 0.5) AS p FROM c GROUP BY l),
  mt AS (SELECT t, pow(sum(mass), 0.6) AS p FROM c GROUP BY t),
  base AS (SELECT c.s, c.l, c.t, CAST(mass AS DOUBLE) AS mass, ms.p / (SELECT sum(p) FROM ms) AS ts, ml.p / (SELECT sum(p) FROM ml) AS tl,
    mt.p / (SELECT sum(p) FROM mt) AS tt, 1 AS n, CAST(mass AS DOUBLE) AS f
    FROM c JOIN ms USING (s) JOIN ml USING (l) JOIN mt USING (t)),
{",".join(steps)},
  fitted AS (SELECT * FROM {of} WHERE f > 0),
  {", ".join(scales)},
  p AS (SELECT s, l, t, round(least(1.0, f * (SELECT k FROM k{_SQL_SCALES}) / mass), 6) AS probability FROM {of})
SELECT doc_id, s AS source, l AS lang, t AS topic, w AS weight, probability,
  CAST('0x' || substr(md5('mix:' || doc_id), 1, 13) AS BIGINT) / 4503599627370496.0 < probability AS sampled
FROM d JOIN p USING (s, l, t)"""


@_R.add(_rake_sql(_SQL_ROUNDS))
def op5_mixing(spark, d):
    docs = table(spark, d, "documents")
    categories = {"source": F.col("source"), "lang": F.col("lang"), "topic": mixing.topic_of()}
    mixed = mixing.mix_documents(docs, categories, MIX_TARGETS, MIX_PART, carry=["doc_id"], tolerance=MIX_TOLERANCE)
    return mixed.select("doc.doc_id", *categories, "weight", "probability", "sampled")


#: Key of the surrogates; a real run takes its own from its configuration.
SURROGATE_KEY = "millrace surrogates"


@_R.add()
def op6_surrogates(spark, d):
    docs = replace_entities(table(spark, d, "documents"), SURROGATE_KEY)
    counts = [F.col("__pii_counts")[kind].alias(f"n_{kind}") for kind in KINDS]
    total = F.aggregate(F.map_values("__pii_counts"), F.lit(0).cast("long"), lambda s, n: s + n)
    return docs.select("doc_id", "text", total.alias("n_entities"), *counts)


@_R.add()
def op7_token_counts(spark, d):
    """A cache of its own for each call, so every distinct text is encoded here."""
    cache = f"{scratch_path(spark, 'token-counts')}/cache"
    return count_tokens(table(spark, d, "documents"), public_tokenizers.path(PIECE_VOCABULARY), cache)


@_R.add()
def op8_harmonic_packing(spark, d):
    return packing_digests(pack_documents(table(spark, d, "documents"), public_tokenizers.path(WORD_VOCABULARY)))


@_R.add()
def op9_near_copies(spark, d):
    return near_copies(table(spark, d, "documents"))


@_R.add()
def op10_lattice_links(spark, d):
    return near_vectors(table(spark, d, "embeddings"))


_OP11 = """
WITH h AS (SELECT doc_id, coalesce(text, '') AS x, sha256('1:' || doc_id) AS h FROM documents),
  d AS (SELECT doc_id, x, CAST(length(x) AS BIGINT) AS n, CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
    CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4 FROM h),
  c AS (SELECT doc_id, x, n, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
    CASE WHEN x = '' OR contains(x, '<P>') OR contains(x, '<S>') OR contains(x, '<M>') OR h3 % 100 >= 90 THEN 'plain'
      WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM d),
  p AS (SELECT *, substr(x, 1, a) AS pre, substr(x, a + 1, b - a) AS mid, substr(x, b + 1) AS suf FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN x WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
    ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256, sha256(x) AS restored_sha256
FROM p"""


@_R.add(_OP11)
def op11_fill_middle(spark, d):
    filled = fill_middle(table(spark, d, "documents"), carry=["doc_id"])
    return filled.select(
        "doc.doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restore(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


_OP12 = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
  l AS (SELECT r, doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS place FROM d),
  k AS (SELECT *, translate(trim(line, concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
  f AS (SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
  m AS (SELECT r, doc_id, place, line, keeper IS NOT NULL AND doc_id <> keeper AS gone FROM k LEFT JOIN f USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY r, doc_id"""


@_R.add(_OP12)
def op12_line_dedup(spark, d):
    kept = drop_lines(table(spark, d, "documents"), carry=["doc_id"])
    return kept.select("doc.doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


_OP13 = r"""
WITH d AS (SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS x FROM documents),
  g AS (SELECT DISTINCT lang, source FROM d),
  t AS (SELECT row_number() OVER () AS r, lang, source, regexp_extract_all(x, '[a-z\x{80}-\x{10FFFF}]+') AS ts FROM d),
  o AS (SELECT r, lang, source, unnest(ts) AS term FROM t),
  v AS (SELECT lang, term, count(*) AS n FROM o GROUP BY lang, term HAVING count(DISTINCT r) >= 30),
  size AS (SELECT lang, count(*) AS v, sum(n) AS total FROM v GROUP BY lang),
  c AS (SELECT o.lang, o.source, o.term, count(*) AS n FROM o JOIN v ON o.lang = v.lang AND o.term = v.term GROUP BY ALL),
  gt AS (SELECT g.lang, g.source, coalesce(sum(n), 0) AS total FROM g LEFT JOIN c ON g.lang = c.lang AND g.source = c.source GROUP BY ALL),
  p AS (SELECT g.lang, g.source, v.term, coalesce(c.n, 0) AS n,
      1 + (CAST(1000000000 AS HUGEINT) * (coalesce(c.n, 0) + 5)) // (g.total + 5 * size.v) AS p,
      1 + (CAST(1000000000 AS HUGEINT) * (v.n + 5)) // (size.total + 5 * size.v) AS q
    FROM gt g JOIN v ON g.lang = v.lang JOIN size ON size.lang = g.lang
    LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = v.term),
  s AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
    FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
  pairs AS (SELECT a.lang, a.source, b.source AS item, CAST(coalesce(s.value, 0) AS BIGINT) AS value
    FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
  terms AS (SELECT lang, source, term AS item, CAST(p - q AS BIGINT) AS value FROM p WHERE n > 0 AND p > q)
SELECT lang, source, 'pair' AS part, item, value, CAST(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS INTEGER) AS rank FROM pairs
UNION ALL
SELECT * FROM (SELECT lang, source, 'term' AS part, item, value,
  CAST(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS INTEGER) AS rank FROM terms) WHERE rank <= 50"""


@_R.add(_OP13)
def op13_divergence(spark, d):
    return divergence(table(spark, d, "documents"))
