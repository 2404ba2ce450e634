"""The registered queries of this subpackage, with production parameters, and their SQL.

Each applies its operator to whole tables and takes the digest columns from the operator's
results.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkwell.llm import (
    chat_render,
    dp_packing,
    filter_cascade,
    jaccard_join,
    license_scan,
    line_quality,
    merkle_manifest,
    order_minhash,
    pairwise_quality,
    pii_sanitise,
    pitman_yor,
    source_divergence,
    template_decontamination,
)
from inkwell.llm.common import crc_mod, table
from inkwell.llm.filter_cascade import Rule

URL_RULES = [
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
]
# A conversation whose texts look like control strings.
HARD_CONVERSATION = [
    (-7, 0, "user", "\\### Assistant: </turn> ok"),
    (-7, 1, "assistant", "\\### Assistant: </turn> ok"),
]


def url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return filter_cascade.filter_urls(pages, URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_quality.clean_lines(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "n_lines", "n_bad_lines", "lost_chars", "base_failed", "kept",
    )


def chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hard = spark.createDataFrame(HARD_CONVERSATION, "conv_id long, turn long, role string, text string")
    every = rows.union(hard.select(*[F.col(c).cast(rows.schema[c].dataType) for c in rows.columns]))
    return chat_render.digests(chat_render.format_conversations(every)).withColumn(
        "conv_id", F.col("conv_id").cast("long")
    )


def tokenizer_files() -> dict[str, str]:
    """The byte-level vocabulary in both its formats, and its pattern of words."""
    import public_tokenizers

    return {
        "tokenizer": public_tokenizers.path("byte_bpe_50k.json"),
        "ranks": public_tokenizers.path("byte_bpe_50k.tiktoken"),
        "pattern": public_tokenizers.PATTERN,
    }


def packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dp_packing.pack(docs, **tokenizer_files()).drop("ids")


def quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = pairwise_quality.learn(docs, table(spark, sf_dir, "labels"))
    return pairwise_quality.scored(docs, model).select(
        "doc_id", (crc_mod("doc_id", 5) == 0).alias("held_out"), "score", "predicted"
    )


def language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = pitman_yor.in_fold("doc_id", 7, 2)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", held_out.alias("held_out"))
    return pitman_yor.score(docs, ~F.col("held_out"))


def near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return order_minhash.classes(docs).select("doc_id", "class_id", "class_size")


def decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return template_decontamination.leaks(docs, table(spark, sf_dir, "benchmark")).drop("text_hash")


def pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii_sanitise.sanitise(docs).select(
        "doc_id", "n_email", "n_ip", "n_card", "n_phone", "n_term",
        F.sha2(F.col("base_spans").cast("binary"), 256).alias("base_sha256"), "spans",
    )


def licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(table(spark, sf_dir, "documents").select("doc_id", "text"))


def divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence.audit(table(spark, sf_dir, "documents").select("lang", "source", "text"))


def ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.classes(table(spark, sf_dir, "documents").select("doc_id", "text"))


def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Proofs of all documents, checked against the rows as they would be after tampering with some."""
    docs = table(spark, sf_dir, "documents")
    names = ("doc_id", "source", "lang", "n_chars", "text")
    fields = {name: F.col(name) for name in names}
    touched = {**fields, "n_chars": F.col("n_chars") + F.lit(1)}
    tampered = F.col("doc_id").isNotNull() & F.col("n_chars").isNotNull() & (crc_mod("doc_id", 7) == 0)
    shown = F.when(tampered, merkle_manifest.digest([touched[n] for n in names]))
    leaves = docs.select(
        "doc_id", "lang", merkle_manifest.digest([fields[n] for n in names]).alias("leaf"), shown.alias("shown")
    )
    proven = merkle_manifest.manifest(leaves, "lang", ["doc_id"])
    presented = F.coalesce("shown", "leaf")
    return proven.select(
        "doc_id", "leaf", "subroot", "root",
        F.sha2(merkle_manifest.siblings(F.col("steps")).cast("binary"), 256).alias("proof_sha256"),
        merkle_manifest.folded(presented, F.col("steps")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


URL_SQL = """
WITH parts AS (
  SELECT page_id,
    CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
  FROM pages
), cut AS (
  SELECT page_id,
    translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM parts
), ruled AS (
  SELECT *, CASE
    WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/en/1') THEN 'example.org/en/1'
    WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/es/') THEN 'example.org/es/'
    WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/fr/') THEN 'com/fr/'
    WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/de/') THEN 'com/de/'
    WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/') THEN 'org/'
  END AS rule
  FROM cut
), decided AS (
  SELECT *, CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block' END AS by_rule
  FROM ruled
), hosts AS (
  SELECT host, count(*) FILTER (WHERE by_rule = 'block') > count(*) FILTER (WHERE by_rule = 'allow') AS listed
  FROM decided GROUP BY host
)
SELECT page_id, d.host, path, rule,
  coalesce(by_rule, CASE WHEN listed THEN 'block' ELSE 'allow' END) AS verdict
FROM decided d JOIN hosts h ON d.host = h.host
"""

CHAT_SQL = """
WITH every AS (
  SELECT CAST(conv_id AS BIGINT) AS conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations
  UNION ALL VALUES (CAST(-7 AS BIGINT), 0, 'user', '\\### Assistant: </turn> ok'),
                   (CAST(-7 AS BIGINT), 1, 'assistant', '\\### Assistant: </turn> ok')
), sized AS (
  SELECT *,
    length(role) + length(regexp_replace(role, '[^\\\\#<:\\n]', '', 'g'))
    + length(text) + length(regexp_replace(text, '[^\\\\#<]', '', 'g')) + 15 AS chars
  FROM every
)
SELECT conv_id, count(*) AS n_turns, CAST(0 AS BIGINT) AS rewritten_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text)
    FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id
"""

DIVERGENCE_SQL = """
WITH rows AS (
  SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS words
  FROM documents
), kept AS (
  SELECT lang, term FROM (SELECT lang, unnest(list_distinct(words)) AS term FROM rows)
  GROUP BY lang, term HAVING count(*) >= 3
), groups AS (
  SELECT DISTINCT lang, source FROM rows
), counts AS (
  SELECT lang, source, term, count(*) AS n FROM (SELECT lang, source, unnest(words) AS term FROM rows)
  SEMI JOIN kept USING (lang, term) GROUP BY lang, source, term
), sizes AS (
  SELECT g.lang, g.source, coalesce((SELECT sum(n) FROM counts c WHERE c.lang = g.lang AND c.source = g.source), 0) AS total,
    (SELECT count(*) FROM kept k WHERE k.lang = g.lang) AS v
  FROM groups g
), shares AS (
  SELECT s.lang, s.source, k.term, coalesce(c.n, 0) AS n,
    1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 1)) // (s.total + s.v)::HUGEINT AS p
  FROM sizes s JOIN kept k ON k.lang = s.lang
  LEFT JOIN counts c ON c.lang = s.lang AND c.source = s.source AND c.term = k.term
), whole AS (
  SELECT lang, term, sum(n) AS n, sum(sum(n)) OVER (PARTITION BY lang) AS total, count(*) OVER (PARTITION BY lang) AS v
  FROM counts GROUP BY lang, term
), lang_shares AS (
  SELECT lang, term, 1 + (1000000000::HUGEINT * (n + 1)) // (total + v)::HUGEINT AS q FROM whole
), pairs AS (
  SELECT a.lang, a.source, b.source AS item,
    coalesce((SELECT sum(((x.p - y.p) * (x.p - y.p)) // y.p) FROM shares x JOIN shares y ON x.lang = y.lang AND x.term = y.term
      WHERE x.lang = a.lang AND x.source = a.source AND y.source = b.source), 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source != b.source
), terms AS (
  SELECT s.lang, s.source, s.term AS item, ((s.p - l.q) * (s.p - l.q)) // l.q AS value
  FROM shares s JOIN lang_shares l ON s.lang = l.lang AND s.term = l.term WHERE s.n > 0 AND s.p > l.q
), ranked AS (
  SELECT 'pair' AS part, *, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS rank FROM pairs
  UNION ALL
  SELECT * FROM (
    SELECT 'term' AS part, *, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS rank FROM terms
  ) WHERE rank <= 200
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM ranked
"""

JACCARD_SQL = """
WITH RECURSIVE docs AS (
  SELECT doc_id, row_number() OVER () AS id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents
), sets AS (
  SELECT doc_id, id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS s
  FROM docs
), items AS (
  SELECT id, len(s) AS n, unnest(s) AS t FROM sets
), links AS (
  SELECT a.id AS a, b.id AS b FROM items a JOIN items b ON a.t = b.t AND a.id != b.id
  GROUP BY a.id, b.id, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))
), reached AS (
  SELECT id AS a, id AS b FROM sets UNION SELECT r.a, l.b FROM reached r JOIN links l ON l.a = r.b
)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, min(o.doc_id) AS component_id
FROM sets s JOIN reached r ON r.a = s.id JOIN sets o ON o.id = r.b GROUP BY s.id, s.doc_id, len(s.s)
"""

MANIFEST_SQL = """
WITH RECURSIVE docs AS (
  SELECT *,
    coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
      || coalesce(strlen(lang) || ':' || lang, '-') AS head,
    coalesce(strlen(text) || ':' || text, '-') AS tail
  FROM documents
), leaves AS (
  SELECT doc_id, lang, sha256(head || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') || tail) AS leaf,
    sha256(head || coalesce(strlen((n_chars + 1)::VARCHAR) || ':' || (n_chars + 1), '-') || tail) AS tampered
  FROM docs
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,
    count(*) OVER (PARTITION BY lang) AS n
  FROM leaves
), nodes AS (
  SELECT lang, 0 AS level, i, n, leaf AS h FROM placed
  UNION ALL
  SELECT lang, level + 1, i // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY i))
  FROM nodes WHERE n > 1 GROUP BY lang, level, n, i // 2
), subroots AS (
  SELECT lang, h, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS i, count(*) OVER () AS n
  FROM nodes WHERE n = 1
), top AS (
  SELECT 0 AS level, i, n, h FROM subroots
  UNION ALL
  SELECT level + 1, i // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY i)) FROM top WHERE n > 1 GROUP BY level, n, i // 2
), ends AS (
  SELECT p.doc_id, p.leaf, s.h AS subroot, (SELECT h FROM top WHERE n = 1) AS root, p.lang, p.i, s.i AS group_i,
    p.tampered, row_number() OVER () AS id,
    xor(4294967295, list_reduce(
      [4294967295] || list_transform(string_split(p.doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT),
      lambda c, b: list_reduce([xor(c, b)] || range(8), lambda d, bit: xor(d >> 1, 3988292384 * (d & 1)))
    )) AS crc
  FROM placed p JOIN subroots s ON p.lang IS NOT DISTINCT FROM s.lang
), steps AS (
  SELECT e.id, n.level AS step, e.i >> n.level AS at, max(o.h) AS sibling
  FROM ends e JOIN nodes n ON n.lang IS NOT DISTINCT FROM e.lang AND n.n > 1 AND n.i = e.i >> n.level
  LEFT JOIN nodes o ON o.lang IS NOT DISTINCT FROM n.lang AND o.level = n.level AND o.i = xor(n.i, 1)
  GROUP BY ALL
  UNION ALL
  SELECT e.id, 1000 + t.level, e.group_i >> t.level, max(o.h)
  FROM ends e JOIN top t ON t.n > 1 AND t.i = e.group_i >> t.level
  LEFT JOIN top o ON o.level = t.level AND o.i = xor(t.i, 1)
  GROUP BY ALL
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY step) AS k FROM steps
), fold AS (
  SELECT id, 0 AS k, CASE WHEN crc % 7 = 0 THEN tampered ELSE leaf END AS h FROM ends
  UNION ALL
  SELECT f.id, f.k + 1, sha256(CASE WHEN n.at % 2 = 1 THEN coalesce(n.sibling, '') || f.h ELSE f.h || coalesce(n.sibling, '') END)
  FROM fold f JOIN numbered n ON n.id = f.id AND n.k = f.k + 1
), folded AS (
  SELECT id, arg_max(h, k) AS folded_root FROM fold GROUP BY id
), proofs AS (
  SELECT id, string_agg(sibling, '' ORDER BY k) AS joined FROM numbered GROUP BY id
)
SELECT e.doc_id, e.leaf, e.subroot, e.root, sha256(coalesce(p.joined, '')) AS proof_sha256, f.folded_root,
  f.folded_root = e.root AS verified
FROM ends e JOIN folded f ON e.id = f.id LEFT JOIN proofs p ON p.id = e.id
"""

Query = Callable[[SparkSession, str], DataFrame]


def queries() -> dict[str, Query]:
    return {
        "op1_license_scan": licenses,
        "op2_decontamination": decontamination,
        "op3_pii": pii,
        "op4_near_duplicates": near_duplicates,
        "op5_url_filter": url_filter,
        "op6_quality_rules": quality_rules,
        "op7_chat_format": chat_format,
        "op8_packing": packing,
        "op9_quality_classifier": quality_classifier,
        "op10_language_model": language_model,
        "op11_source_divergence": divergence,
        "op12_ngram_jaccard_join": ngram_join,
        "op13_merkle_manifest": manifest,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op5_url_filter": URL_SQL,
        "op7_chat_format": CHAT_SQL,
        "op11_source_divergence": DIVERGENCE_SQL,
        "op12_ngram_jaccard_join": JACCARD_SQL,
        "op13_merkle_manifest": MANIFEST_SQL,
    }
