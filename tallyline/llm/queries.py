"""Named queries of this subpackage and, where SQL can say the same, their SQL."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.llm import (
    cotraining,
    license_scan,
    mixing,
    near_dup,
    packing,
    quality_rules,
    repair,
    resampling,
    sharding,
    token_counts,
    topk,
    url_filter,
    warc,
)
from tallyline.sources.stage import new_path

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        @wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


LOWER_SQL = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

# The CRC of a text, by the table of all 256 bytes that its rule gives.
CRC_TABLE_SQL = """crc_table AS (
  SELECT list(c ORDER BY i) AS crcs FROM (SELECT i, list_reduce(range(8),
    lambda c, j: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) AS c
    FROM range(256) AS t(i)))"""


def crc_sql(text: str) -> str:
    """The unsigned CRC-32 of a text's UTF-8 bytes, given ``crcs`` of the table."""
    codes = f"hex(encode({text}))"
    return f"""xor(4294967295, list_reduce(
      list_transform(range(len({codes}) // 2), lambda i: ('0x' || substr({codes}, 2 * i + 1, 2))::BIGINT),
      lambda c, b: xor(c >> 8, crcs[(xor(c, b) & 255) + 1]), 4294967295::BIGINT))"""


LEDGER_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), g AS (
  SELECT doc_id, i, list_slice(w, i, i + 4) AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM d WHERE len(w) >= 5)
), again AS (
  SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS c FROM g) WHERE c > 1
), covered AS (
  SELECT doc_id, count(DISTINCT i + j) AS n FROM again, range(5) AS t(j) GROUP BY doc_id
), lines AS (
  SELECT doc_id, count(*) AS n, count(*) - count(DISTINCT l) AS dup
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS l FROM d)
  WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY doc_id
), m AS (
  SELECT d.doc_id, len(w)::BIGINT AS n_words,
    length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
    len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols,
    coalesce(lines.n, 0)::BIGINT AS n_lines,
    coalesce(dup, 0)::BIGINT AS n_dup_lines,
    coalesce(covered.n, 0)::BIGINT AS n_repeat_words
  FROM d LEFT JOIN lines USING (doc_id) LEFT JOIN covered USING (doc_id)
), l AS (
  SELECT *, (""" + " + ".join(
    f"CASE WHEN {rule.fails} THEN {1 << i} ELSE 0 END" for i, rule in enumerate(quality_rules.RULES)
) + r""")::BIGINT AS fail_bits FROM m
)
"""


@query(
    "op1_quality_rules",
    LEDGER_SQL
    + f"""SELECT doc_id, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words,
    fail_bits, fail_bits & {quality_rules.BASE.mask} <> 0 AS base_failed,
    fail_bits & {quality_rules.STRICT.mask} = 0 AS kept,
    '{quality_rules.STRICT.version}' AS policy FROM l""",
)
def op1_quality_rules(spark, sf_dir):
    """The ledger of every document and the verdicts of the base and the strict policy."""
    ledger = quality_rules.ledger(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return ledger.select(
        "doc_id",
        *(f"ledger.{m}" for m in quality_rules.MEASURES),
        "ledger.fail_bits",
        (~quality_rules.passes(quality_rules.BASE)).alias("base_failed"),
        quality_rules.passes(quality_rules.STRICT).alias("kept"),
        F.lit(quality_rules.STRICT.version).alias("policy"),
    )


def ablation_sql() -> str:
    rows = ", ".join(
        f"('{p.version}', '{r.name}', {p.mask}, {1 << quality_rules.RULES.index(r)})"
        for p in (quality_rules.BASE, quality_rules.STRICT)
        for r in quality_rules.RULES
        if r.name in p.rules
    )
    return f"""SELECT policy, rule, count(*) FILTER (fail_bits & mask <> 0) AS rejected,
    count(*) FILTER (fail_bits & bit <> 0) AS by_rule,
    count(*) FILTER (fail_bits & mask = bit) AS by_rule_alone,
    count(*) FILTER (fail_bits & (mask & ~bit) <> 0) AS rejected_without
    FROM l, (VALUES {rows}) AS p(policy, rule, mask, bit) GROUP BY policy, rule"""


@query("quality_rule_ablations", LEDGER_SQL + ablation_sql())
def quality_rule_ablations(spark, sf_dir):
    """What each rule contributes to each policy over all documents."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality_rules.ablations(quality_rules.ledger(docs))


LICENSE_SQL = r"""
WITH t AS (
  SELECT *, CASE WHEN exact THEN 2 ELSE 3 END AS k, string_split(phrase, ' ') AS tw
  FROM (VALUES """ + ", ".join(
    f"({i}, '{t.label}', {str(t.exact).lower()}, '{t.text}')"
    for i, t in enumerate(license_scan.PHRASES + license_scan.STATEMENTS)
) + r""") AS v(template, label, exact, phrase)
), tg AS (
  SELECT template, label, exact, k, len(tw) AS length, len(tw) - k + 1 AS n_grams, p AS place,
    array_to_string(list_slice(tw, p + 1, p + k), ' ') AS gram
  FROM (SELECT *, unnest(range(0, len(tw) - k + 1)) AS p FROM t)
), d AS (
  SELECT doc_id, regexp_extract_all(""" + LOWER_SQL.format("coalesce(text, '')") + r""",
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), dg AS (
  SELECT doc_id, k, p AS pos, array_to_string(list_slice(w, p + 1, p + k), ' ') AS gram
  FROM (SELECT doc_id, w, k, unnest(range(0, len(w) - k + 1)) AS p FROM d, (VALUES (2), (3)) AS v(k)
        WHERE len(w) >= k)
), diagonals AS (
  SELECT doc_id, template, label, exact, length, n_grams, pos - place AS diagonal,
    count(*) AS votes, min(pos) AS first, max(pos) AS last
  FROM dg JOIN tg USING (k, gram) GROUP BY ALL
), flagged AS (
  SELECT *, CASE WHEN exact OR lag(diagonal) OVER o IS NULL OR abs(diagonal - lag(diagonal) OVER o) > 2
    OR first > lag(last) OVER o + 5 THEN 1 ELSE 0 END AS apart
  FROM diagonals WINDOW o AS (PARTITION BY doc_id, template ORDER BY first, diagonal)
), numbered AS (
  SELECT *, sum(apart) OVER (PARTITION BY doc_id, template ORDER BY first, diagonal) AS span FROM flagged
), spans AS (
  SELECT doc_id, template, label, exact, length, n_grams, span, sum(votes) AS votes,
    min(first) AS first, max(last) AS last FROM numbered GROUP BY ALL
), found AS (
  SELECT * FROM spans WHERE CASE WHEN exact THEN votes = n_grams
    ELSE 100 * votes >= """ + str(license_scan.COVERAGE) + r""" * n_grams
      AND 100 * (last - first + 3) <= """ + str(license_scan.STRETCH) + r""" * length END
), per AS (
  SELECT doc_id, count(*) FILTER (exact) AS n_base, min(first) FILTER (exact) AS first_word,
    max(first) FILTER (exact) AS last_word,
    coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (exact), '') AS base_labels,
    coalesce(string_agg(DISTINCT label, ',' ORDER BY label), '') AS labels,
    max(least(votes::DOUBLE / n_grams::DOUBLE, 1.0)) AS score
  FROM found GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base,
  first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
  coalesce(score, 0.0)::DOUBLE AS score
FROM d LEFT JOIN per USING (doc_id)
"""


@query("op2_license_scan", LICENSE_SQL)
def op2_license_scan(spark, sf_dir):
    """License phrases and statements in every document."""
    return license_scan.scan(table(spark, sf_dir, "documents"))


@query("op3_sharding")
def op3_sharding(spark, sf_dir):
    """All documents in 16 shards whose counts differ by one at most."""
    return sharding.shard(table(spark, sf_dir, "documents").select("doc_id", "text"))


MIX_SQL = r"""
WITH s AS (
  SELECT doc_id, source,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents
), src AS (
  SELECT *, [3, 1, 2][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::BIGINT] AS weight
  FROM (SELECT source, sum(size)::BIGINT AS source_size FROM s GROUP BY source)
), r AS (
  SELECT *, 2 * source_size / weight::DOUBLE AS lim,
    (sum(source_size) OVER ())::DOUBLE * 150 / 100.0
      - coalesce(sum(2 * source_size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE AS rest,
    (sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS weights
  FROM src WINDOW o AS (ORDER BY 2 * source_size / weight::DOUBLE, source NULLS LAST)
), level AS (
  SELECT rest, weights FROM r WHERE rest * weight <= 2 * source_size * weights
  ORDER BY lim, rest, weights LIMIT 1
), aims AS (
  SELECT source, source_size, round(least(
    coalesce((SELECT rest FROM level) * weight / (SELECT weights FROM level), 2.0 * source_size::DOUBLE),
    2.0 * source_size::DOUBLE), 6)::DOUBLE AS target FROM r
), u AS (
  SELECT *, CASE WHEN source_size > 0 THEN round(least(target / source_size, 2.0) * 16777216) ELSE 0 END::BIGINT
    AS units, ('0x' || substr(md5(coalesce(source, '')), 1, 6))::BIGINT AS shift FROM aims
), b AS (
  SELECT s.doc_id, s.source, s.size, u.source_size, u.target, u.units, u.shift,
    coalesce(sum(u.units) OVER (PARTITION BY s.source ORDER BY
      len(bin(size)) * 8 + ((size >> greatest(len(bin(size)) - 4, 0)) & 7),
      md5(coalesce(s.doc_id::VARCHAR, '')), size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
  FROM s JOIN u ON s.source IS NOT DISTINCT FROM u.source WHERE s.size > 0
), trial AS (
  SELECT source, i, abs(sum(size * ((before + shift + i * 1048576 + units) // 16777216
    - (before + shift + i * 1048576) // 16777216))::DOUBLE - max(target)) AS miss
  FROM b, range(16) AS t(i) GROUP BY source, i
), best AS (
  SELECT source, first(i ORDER BY miss, i) AS i FROM trial GROUP BY source
), c AS (
  SELECT doc_id, size, source_size, target, ((before + shift + i * 1048576 + units) // 16777216
    - (before + shift + i * 1048576) // 16777216)::BIGINT AS copies
  FROM b JOIN best ON b.source IS NOT DISTINCT FROM best.source
  UNION ALL
  SELECT s.doc_id, s.size, u.source_size, u.target, 0
  FROM s JOIN u ON s.source IS NOT DISTINCT FROM u.source WHERE s.size = 0
)
SELECT doc_id, size, source_size, target, copies * size AS taken, copies FROM c
"""


@query("op9_mixing", MIX_SQL)
def op9_mixing(spark, sf_dir):
    """How often the mix takes every document."""
    return mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))


@query("op5_packing")
def op5_packing(spark, sf_dir):
    """Every document's pieces in as few sequences of 2048 tokens as they fit."""
    docs = table(spark, sf_dir, "documents")
    return packing.pack(packing.pieces(docs, public_tokenizers.path("word_bpe_49k.json")))


NEAR_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(""" + LOWER_SQL.format("coalesce(text, '')") + r""",
    '[^\x20\x09-\x0D]+') AS w FROM documents
), sh AS (
  SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + 4), ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM d WHERE len(w) >= 5)
  UNION ALL
  SELECT doc_id, array_to_string(w, ' ') FROM d WHERE len(w) BETWEEN 1 AND 4
), n AS (
  SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id
), pairs AS (
  SELECT p.doc_id AS a, q.doc_id AS b, count(*) AS c
  FROM sh AS p JOIN sh AS q ON p.g = q.g AND p.doc_id < q.doc_id GROUP BY p.doc_id, q.doc_id
), links AS (
  SELECT a, b FROM pairs JOIN n AS x ON x.doc_id = a JOIN n AS y ON y.doc_id = b
  WHERE 100 * c >= 75 * (x.n + y.n - c)
), ways AS (
  SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reach AS (
  SELECT doc_id, doc_id AS r FROM d
  UNION
  SELECT reach.doc_id, ways.b FROM reach JOIN ways ON reach.r = ways.a
), low AS (
  SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, component_id = d.doc_id AS kept
FROM d JOIN low USING (doc_id) LEFT JOIN n USING (doc_id)
"""


@query("op7_near_duplicates", NEAR_SQL)
def op7_near_duplicates(spark, sf_dir):
    """Every document's near-duplicate component."""
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"))


WARC_SQL = r"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS h, sha1(coalesce(html, '')) AS sha FROM pages
), t AS (
  SELECT *, max(page_id) OVER (PARTITION BY sha) AS top FROM p
)
SELECT page_id, octet_length(encode(h))::BIGINT AS payload_bytes,
  array_to_string(list_transform(range(8), lambda g:
    array_to_string(list_transform([15, 10, 5, 0], lambda s:
      substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
        (((('0x' || substr(sha, g * 5 + 1, 5))::BIGINT >> s) & 31) + 1)::BIGINT, 1)), '')), '') AS payload_digest,
  CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> top THEN top END AS refers_to
FROM t
"""


@query("op8_warc", WARC_SQL)
def op8_warc(spark, sf_dir):
    """All pages through WARC archives: responses with payloads, revisits by header."""
    path = new_path(spark, "warc")
    warc.write(table(spark, sf_dir, "pages"), path)
    responses = warc.records(spark, path).where("record_type = 'response'")
    revisits = warc.headers(spark, path).where("record_type = 'revisit'")
    names = ["page_id", "payload_digest", "record_type", "refers_to"]
    return responses.select(
        *names, F.octet_length("payload").cast("bigint").alias("payload_bytes")
    ).unionByName(revisits.select(*names, "payload_bytes"))


@query("op6_url_filter")
def op6_url_filter(spark, sf_dir):
    """Every page's verdict by rule or by boosted trees."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.judged(pages).select("page_id", "judged.*")


TOPK_SQL = r"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
    coalesce(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])), 0)::BIGINT AS score
  FROM v AS q JOIN v AS c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
)
SELECT query_id, rank::INT AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s
) WHERE rank <= 5
"""


@query("op4_top_k", TOPK_SQL)
def op4_top_k(spark, sf_dir):
    """The five nearest vectors of every vector whose id is divisible by 50."""
    vectors = topk.quantized(table(spark, sf_dir, "embeddings"))
    return topk.top_k(vectors, vectors.where("vec_id % 50 = 0"))


@query("op10_cotraining")
def op10_cotraining(spark, sf_dir):
    """Quality scores of all documents from two views trained on each other."""
    return cotraining.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


RESAMPLE_SQL = r"""
WITH """ + CRC_TABLE_SQL + r""", w AS (
  SELECT 0 AS side, doc_id, unnest(regexp_extract_all(""" + LOWER_SQL.format("coalesce(text, '')") + r""",
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM documents
  UNION ALL
  SELECT 1, item_id, unnest(regexp_extract_all(""" + LOWER_SQL.format("coalesce(text, '')") + r""",
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) FROM benchmark
), b AS (
  SELECT w, """ + crc_sql("w") + r""" % 10000 AS bucket FROM (SELECT DISTINCT w FROM w), crc_table
), f AS (
  SELECT side, doc_id, bucket FROM w JOIN b USING (w)
), c AS (
  SELECT bucket, (count(*) FILTER (side = 0))::DOUBLE AS s, (count(*) FILTER (side = 1))::DOUBLE AS t
  FROM f GROUP BY bucket
), g AS (
  SELECT bucket, floor(1000 * ln((t + 1) * (sum(s) OVER () + 10000) / ((s + 1) * (sum(t) OVER () + 10000))))::BIGINT AS gain FROM c
), m AS (
  SELECT d.doc_id, count(gain) AS n_features,
    floor(coalesce(sum(gain), 0)::DOUBLE / greatest(count(gain), 1))::BIGINT AS weight
  FROM documents AS d LEFT JOIN (SELECT doc_id, gain FROM f JOIN g USING (bucket) WHERE side = 0) AS x
    ON x.doc_id = d.doc_id GROUP BY d.doc_id
), sc AS (
  SELECT *, weight + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE)
    / 4294967296::DOUBLE)))::BIGINT AS score FROM m
), r AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS n FROM sc WHERE n_features >= 20
)
SELECT sc.doc_id, n_features, weight, score, CASE WHEN rank <= 10 * n // 100 THEN rank END AS rank
FROM sc LEFT JOIN r USING (doc_id)
"""


@query("op13_resampling", RESAMPLE_SQL)
def op13_resampling(spark, sf_dir):
    """The tenth of all documents that lies towards the benchmark's words, ranked."""
    target = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("doc_id"), "text")
    return resampling.resample(table(spark, sf_dir, "documents"), target)


REPAIR_SQL = r"""
WITH RECURSIVE """ + CRC_TABLE_SQL + r""", fate AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    """ + crc_sql("(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '))") + r""" % 20 AS f
  FROM conversations, crc_table
), d AS (
  SELECT conv_id, turn, CASE f WHEN 4 THEN 'user' ELSE role END AS role,
    CASE f WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM fate, range(2) AS t(copy) WHERE f <> 0 AND (copy = 0 OR f = 3)
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i,
    regexp_replace(text, '[\x20\x09-\x0D]+$', '') AS body FROM d
), faults AS (
  SELECT *, CASE WHEN body = '' THEN 'blank'
      WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
      WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
    left(role, 1) AS initial, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS previous
  FROM placed
), step AS (
  SELECT * FROM (VALUES ('0', 's', 's'), ('0', 'u', 'u'), ('s', 'u', 'u'), ('u', 'a', 'a'), ('a', 'u', 'u')) AS v(p, r, q)
), put AS (
  SELECT p, '' AS more, '' AS said, p AS q FROM (VALUES ('0'), ('s'), ('u'), ('a')) AS v(p)
  UNION ALL SELECT p, 'I', chr(10) || CASE r WHEN 'u' THEN 'user:' ELSE 'assistant:' END, q FROM step WHERE r <> 's'
  UNION ALL SELECT x.p, 'II', chr(10) || CASE x.r WHEN 'u' THEN 'user:' ELSE 'assistant:' END
    || chr(10) || CASE y.r WHEN 'u' THEN 'user:' ELSE 'assistant:' END, y.q
  FROM step AS x JOIN step AS y ON x.q = y.p WHERE x.r <> 's'
), way AS (
  SELECT DISTINCT conv_id, 0::BIGINT AS i, '0' AS state, 0::BIGINT AS cost, '' AS audit, '' AS lines FROM conversations
  UNION ALL
  SELECT conv_id, i, state, cost, audit, lines FROM (
    SELECT *, row_number() OVER (PARTITION BY conv_id, state ORDER BY cost, audit) AS best FROM (
      SELECT w.conv_id, f.i, e.q AS state,
        w.cost + 2 * length(put.more) + e.cost + CASE WHEN e.edit <> 'D' AND f.fault = 'truncated' THEN 1 ELSE 0 END AS cost,
        w.audit || put.more || e.edit AS audit,
        w.lines || put.said || CASE e.edit WHEN 'D' THEN '' WHEN 'K' THEN chr(10) || f.role || ':' || f.text
          ELSE chr(10) || CASE e.r WHEN 'u' THEN 'user:' ELSE 'assistant:' END || f.text END AS lines
      FROM way AS w JOIN faults AS f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.i = w.i + 1
      JOIN put ON put.p = w.state
      JOIN (SELECT p, 'D' AS edit, 3 AS cost, '' AS r, p AS q FROM (VALUES ('0'), ('s'), ('u'), ('a')) AS v(p)
        UNION ALL SELECT p, 'K', 0, r, q FROM step
        UNION ALL SELECT p, 'R', 2, r, q FROM step WHERE r <> 's') AS e
        ON e.p = put.q AND (e.edit = 'D' OR (f.fault NOT IN ('blank', 'duplicate') AND (e.edit = 'R' OR e.r = f.initial)))
    )
  ) WHERE best = 1
), ends AS (
  SELECT conv_id, w.cost + 2 * length(more) AS cost, audit || more AS audit, substr(lines || said, 2) AS lines,
    row_number() OVER (PARTITION BY conv_id ORDER BY w.cost + 2 * length(more), audit || more) AS best
  FROM way AS w JOIN put ON put.p = w.state
  WHERE put.q IN ('0', 'a') AND w.i = coalesce((SELECT max(i) FROM placed AS x WHERE x.conv_id IS NOT DISTINCT FROM w.conv_id), 0)
), counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (previous IS NOT NULL AND previous || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM faults GROUP BY conv_id
)
SELECT e.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, cost::BIGINT AS cost, audit, sha256(lines) AS repaired_sha256
FROM ends AS e LEFT JOIN counts AS c ON c.conv_id IS NOT DISTINCT FROM e.conv_id WHERE best = 1
"""


@query("op12_conversation_repair", REPAIR_SQL)
def op12_conversation_repair(spark, sf_dir):
    """Every damaged conversation's faults and its cheapest repair."""
    return repair.repair(repair.damage(table(spark, sf_dir, "conversations")))


@query("op11_token_counts")
def op11_token_counts(spark, sf_dir):
    """Tokens of every document, and how much of it a limit of 1024 tokens holds."""
    return token_counts.token_counts(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json")
    )


URL_PARTS_SQL = r"""
WITH r AS (SELECT * FROM (VALUES """ + ", ".join(
    f"('{r.verdict}', '{r.host}', '{r.path}')" for r in url_filter.RULES
) + r""") AS v(verdict, h, p)
), u AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), parts AS (
  SELECT page_id, """ + LOWER_SQL.format("regexp_extract(rest, '^[^/?#]*')") + r""" AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u
)
SELECT page_id, host, path, (
    SELECT h || p FROM r WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
    ORDER BY length(h || p) DESC LIMIT 1) AS rule
FROM parts
"""


@query("url_parts", URL_PARTS_SQL)
def url_parts(spark, sf_dir):
    """Host, path and rule of every page's url, as the url filter finds them."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.judged(pages).select("page_id", "judged.host", "judged.path", "judged.rule")


@query(
    "shard_sizes",
    "SELECT doc_id, (octet_length(encode(coalesce(text, ''))) + 1)::BIGINT AS size, 'rows' AS law FROM documents",
)
def shard_sizes(spark, sf_dir):
    """Size and law of every document, as sharding carries them."""
    rows = sharding.shard(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.select("doc_id", "size", "law")
