"""The registered queries of the operators, with production parameters, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.llm import (
    chat,
    divergence,
    hnsw,
    licences,
    lines,
    manifest,
    mixing,
    packing,
    pages,
    shards,
    simhash,
    toxicity,
    urls,
)
from lectern.llm.common import pick
from lectern.operators.numbering import number_rows

TOKENIZER = "word_bpe_49k.json"
#: Target shares of the mixture; all other sources together get OTHER_WEIGHT.
MIX_WEIGHTS = {"src0": 0.20, "src1": 0.08, "src2": 0.08, "src3": 0.06, "src4": 0.06}
OTHER_WEIGHT = 0.52
MIX_SEED = "mix"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _learnable(labels: DataFrame) -> DataFrame:
    """The labels that may be learned from; the others are held out."""
    return labels.filter(F.crc32(F.col("doc_id").cast("string")) % 3 != 1)


#: A conversation whose texts look like the template.
TRICKY = -7
TRICKY_TEXT = r"\### Assistant: </turn> ok"


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = pick(_table(spark, sf_dir, "conversations"), conv_id="conv_id", turn="turn", role="role", text="text")
    tricky = spark.range(2).select(
        F.lit(TRICKY).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(TRICKY_TEXT).alias("text"),
    )
    shown = chat.formatted_by_turn(rows.unionByName(tricky))
    turns = F.transform(chat.read_turns(F.col("formatted")), chat.read_turn)
    listed = F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    loss = F.array_join(chat.read_loss(F.col("formatted"), F.col("loss_mask")), "")
    return shown.select(
        F.col("tree").alias("conv_id"),
        "n_turns",
        F.sha2(F.array_join(listed, ""), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op2_hnsw(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = hnsw.usable(_table(spark, sf_dir, "embeddings"))
    return hnsw.nearest(rows, rows.filter("vec_id % 50 = 0"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = toxicity.learn(docs, _learnable(_table(spark, sf_dir, "labels")))
    found = toxicity.scored(pick(docs, doc_id="doc_id", text="text"), model)
    return found.select(
        "doc_id",
        (F.crc32(F.col("doc_id").cast("string")) % 3 == 1).alias("held_out"),
        "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
    )


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    field = lines.sampled_field(docs, _table(spark, sf_dir, "labels"))
    found = lines.judged(pick(docs, doc_id="doc_id", text="text"), field)
    return found.select("doc_id", "verdict.*")


URL_RULES = [
    urls.Rule(urls.ALLOW, "org/"),
    urls.Rule(urls.BLOCK, "example.org/es/"),
    urls.Rule(urls.BLOCK, "example.org/en/1"),
    urls.Rule(urls.ALLOW, "com/fr/"),
    urls.Rule(urls.BLOCK, "com/de/"),
]


def op6_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judged(_table(spark, sf_dir, "pages"), URL_RULES)


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = pick(_table(spark, sf_dir, "documents"), doc_id="doc_id", source="source")
    copies = mixing.replicated(docs, MIX_WEIGHTS, OTHER_WEIGHT, seed=MIX_SEED)
    placed = number_rows(copies, F.col("order_key"), F.col("doc_id"), F.col("copy"))
    return placed.select("doc_id", "source", "copy", (F.col("position") - 1).alias("position"))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = pick(_table(spark, sf_dir, "documents"), doc_id="doc_id", text="text")
    sized = docs.select(
        "doc_id",
        shards.byte_size(F.col("text")).alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
        F.xxhash64("text").alias("copies"),
    )
    placed = shards.assigned(sized, size="size", group="copies")
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op9_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus as files in folders source/lang/thousand/hundred/ten of their ids. A text that
    closes with a licence notice is a licence file, of one of the upper four levels by its id."""
    docs = pick(_table(spark, sf_dir, "documents"), doc_id="doc_id", text="text", lang="lang", source="source")
    notice = licences.closing_notice(F.col("text"))
    folders = F.array("source", "lang", *[F.expr(f"cast(doc_id div {n} as string)") for n in (1000, 100, 10)])
    level = F.when(notice, F.coalesce(F.expr("cast(pmod(doc_id, 4) as int) + 1"), F.lit(5))).otherwise(5)
    path = F.concat_ws("/", F.slice(folders, F.lit(1), level), F.col("doc_id").cast("string"))
    files = docs.select("doc_id", "text", path.alias("path"), notice.alias("is_licence_file"))
    return licences.scan(files).withColumnRenamed("file_id", "doc_id")


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed_documents(
        _table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER)
    )


def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(_table(spark, sf_dir, "documents"))


def op12_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.extracted(_table(spark, sf_dir, "pages"))


def op13_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.manifest(_table(spark, sf_dir, "documents"))


OP1_SQL = rf"""
WITH rows AS (
 SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
 UNION ALL SELECT {TRICKY}, i, CASE i WHEN 0 THEN 'user' ELSE 'assistant' END, '{TRICKY_TEXT}' FROM range(2) t(i)),
shown AS (SELECT *,
  replace(replace(replace(text, '\', '\\'), '### ', '\h'), '</turn>', '\c') AS body,
  replace(replace(replace(replace(role, '\', '\\'), '### ', '\h'), '</turn>', '\c'), ':', '\r') AS name
 FROM rows)
SELECT conv_id, count(*) AS n_turns,
 sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
 coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
 sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
 sum(length(body) + length(name) + 14 + CASE WHEN regexp_matches(role, '^[a-z]') THEN 0 ELSE 1 END)::BIGINT AS formatted_chars
FROM shown GROUP BY conv_id
"""

_SHARES = ", ".join(f"('{s}', {w}::DOUBLE)" for s, w in MIX_WEIGHTS.items())
_UNIFORM = "('0x' || md5('{seed}/copies:' || coalesce(doc_id::VARCHAR, ''))[1:13])::BIGINT / 4503599627370496.0::DOUBLE"

OP7_SQL = f"""
WITH RECURSIVE target(bucket, weight) AS (VALUES {_SHARES}),
rows AS (SELECT d.doc_id, d.source, t.bucket, coalesce(t.weight, {OTHER_WEIGHT}::DOUBLE) AS weight,
  {_UNIFORM.format(seed=MIX_SEED)} AS u
 FROM documents d LEFT JOIN target t ON d.source = t.bucket),
sizes AS (SELECT bucket, any_value(weight) AS weight, count(*) AS n FROM rows GROUP BY bucket),
rates AS (SELECT bucket, weight * (SELECT sum(n) FROM sizes)::DOUBLE / ((SELECT sum(weight) FROM sizes) * n) AS rate FROM sizes),
steps(bucket, rate, k, term, reached) AS (
 SELECT bucket, rate, 0, exp(-rate), exp(-rate) FROM rates
 UNION ALL
 SELECT bucket, rate, k + 1, term * rate / (k + 1), reached + term * rate / (k + 1) FROM steps
 WHERE reached < 1 - 2.220446049250313e-16::DOUBLE AND (k < rate OR term > 8.673617379884035e-19::DOUBLE)),
counts AS (SELECT r.doc_id, r.source,
  (SELECT count(*) FROM steps s WHERE s.bucket IS NOT DISTINCT FROM r.bucket AND s.reached <= r.u) AS n FROM rows r),
copies AS (SELECT doc_id, source, unnest(range(n))::INTEGER AS copy FROM counts)
SELECT doc_id, source, copy,
 row_number() OVER (ORDER BY md5('{MIX_SEED}/order:' || coalesce(doc_id::VARCHAR, '') || ':' || copy), doc_id, copy) - 1 AS position
FROM copies
"""

_HOST = r"^.*?://([^/?#]*)"
_PATH = r"^.*?://[^/?#]*([^?#]*)"


def _sql_host(url: str) -> str:
    return f"translate(regexp_extract({url}, '{_HOST}', 1, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _sql_path(url: str) -> str:
    return f"regexp_extract({url}, '{_PATH}', 1, 's')"


def _sql_without_dots(path: str) -> str:
    return rf"""CASE WHEN contains({path}, '/.') THEN list_reduce(list_concat([''], string_split({path}, '/')[2:]),
  lambda done, part: CASE part WHEN '..' THEN regexp_replace(done, '/[^/]*$', '') WHEN '.' THEN done ELSE done || '/' || part END)
  || CASE WHEN regexp_matches({path}, '/\.\.?\z') THEN '/' ELSE '' END ELSE {path} END"""


def _sql_key(url: str) -> str:
    path = rf"regexp_replace({_sql_without_dots(_sql_path(url))}, '(/|/index\.html?|\.html?)$', '')"
    return f"CASE WHEN {_sql_host(url)} <> '' THEN {_sql_host(url)} || {path} END"


def _sql_links(outer: str, inner: str) -> str:
    quote = "[\"'']?"
    value = "([^\"''\\s>]+)"
    tags = f"regexp_extract_all(html, '{outer.format(q=quote)}', 0, 'is')"
    return f"list_transform({tags}, lambda tag: regexp_extract(tag, '{inner.format(q=quote, v=value)}', 1, 'is'))"


_CANONICAL = _sql_links(r"<link\b[^>]*\brel\s*=\s*{q}canonical\b[^>]*>", r"\bhref\s*=\s*{q}{v}")
_REFRESH = _sql_links(r"<meta\b[^>]*\bhttp-equiv\s*=\s*{q}refresh\b[^>]*>", r"\burl\s*=\s*{q}{v}")
_VERDICTS = ", ".join(f"('{r.rule}', '{r.host}', '{r.path}', '{r.verdict}')" for r in URL_RULES)
_SCHEME = "regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*)://', 1)"


def _sql_rule(host: str, path: str) -> str:
    return f"""(SELECT arg_max(r, length(r.rule)) FROM rules r
 WHERE ({host} = r.host OR ends_with({host}, '.' || r.host)) AND starts_with({path}, r.path))"""


OP6_SQL = f"""
WITH RECURSIVE rules(rule, host, path, verdict) AS (VALUES {_VERDICTS}),
found AS (SELECT coalesce(url, '') AS url, unnest(list_concat({_CANONICAL}, {_REFRESH})) AS link FROM pages),
joined AS (SELECT url, CASE WHEN regexp_matches(link, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN link
  WHEN regexp_matches(link, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN NULL
  WHEN starts_with(link, '//') THEN {_SCHEME} || ':' || link
  WHEN starts_with(link, '/') THEN {_SCHEME} || '://' || {_sql_host("url")} || link
  WHEN regexp_matches(link, '^[?#]') THEN {_SCHEME} || '://' || {_sql_host("url")} || {_sql_path("url")} || link
  ELSE {_SCHEME} || '://' || {_sql_host("url")} || coalesce(nullif(regexp_extract({_sql_path("url")}, '^(.*/)', 1, 's'), ''), '/') || link END AS target
 FROM found WHERE link <> ''),
links AS (SELECT url, regexp_extract(target, '^(.*?://[^/?#]*)', 1, 's') || {_sql_without_dots(_sql_path("target"))}
  || regexp_extract(target, '^.*?://[^?#]*(.*)$', 1, 's') AS target FROM joined),
edges AS (SELECT DISTINCT {_sql_key("url")} AS a, {_sql_key("target")} AS b, target FROM links),
named AS (SELECT * FROM edges WHERE a IS NOT NULL AND b IS NOT NULL),
edges_both AS (SELECT a, b FROM named UNION SELECT b, a FROM named),
reach(node, other) AS (SELECT a, a FROM edges_both UNION SELECT a, b FROM edges_both
 UNION SELECT r.node, e.b FROM reach r JOIN edges_both e ON r.other = e.a),
classes AS (SELECT node, min(other) AS class FROM reach GROUP BY node),
judged AS (SELECT page_id, {_sql_host("coalesce(url, '')")} AS host, {_sql_path("coalesce(url, '')")} AS path,
  {_sql_key("coalesce(url, '')")} AS key FROM pages),
ruled AS (SELECT j.*, {_sql_rule("j.host", "j.path")} AS r, coalesce(c.class, j.key) AS class
 FROM judged j LEFT JOIN classes c ON j.key = c.node),
marks AS (SELECT class, r.verdict AS verdict FROM ruled WHERE class IS NOT NULL
 UNION ALL SELECT coalesce(c.class, n.b), {_sql_rule(_sql_host("n.target"), _sql_path("n.target"))}.verdict
 FROM named n LEFT JOIN classes c ON n.b = c.node),
blocked AS (SELECT class FROM marks GROUP BY class
 HAVING coalesce(bool_or(verdict = 'block'), false) AND NOT coalesce(bool_or(verdict = 'allow'), false))
SELECT page_id, host, path, ruled.r.rule AS rule,
 coalesce(ruled.r.verdict, CASE WHEN b.class IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict,
 ruled.class AS alias_class
FROM ruled LEFT JOIN blocked b ON ruled.class = b.class
"""

OP11_SQL = r"""
WITH rows AS (SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
groups AS (SELECT DISTINCT lang, source FROM rows),
used AS (SELECT id, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM rows),
kept AS (SELECT lang, term FROM used GROUP BY lang, term HAVING count(DISTINCT id) >= 3),
counts AS (SELECT lang, source, term, count(*) AS n FROM used SEMI JOIN kept USING (lang, term) GROUP BY ALL),
sizes AS (SELECT g.lang, g.source, coalesce((SELECT sum(n) FROM counts c WHERE c.lang = g.lang AND c.source = g.source), 0) AS total,
  (SELECT count(*) FROM kept k WHERE k.lang = g.lang) AS v FROM groups g),
shares AS (SELECT s.lang, s.source, k.term, coalesce(c.n, 0) AS n,
  (1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 1)) // (s.total + s.v))::HUGEINT AS p
 FROM sizes s JOIN kept k ON s.lang = k.lang
 LEFT JOIN counts c ON c.lang = s.lang AND c.source = s.source AND c.term = k.term),
langs AS (SELECT lang, term, (1 + (1000000000::HUGEINT * (sum(n) + 1)) // (sum(sum(n)) OVER (PARTITION BY lang) + count(*) OVER (PARTITION BY lang)))::HUGEINT AS q
 FROM shares GROUP BY lang, term),
pairs AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
 FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
found AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(p.value, 0)::BIGINT AS value
 FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
 LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
 UNION ALL SELECT s.lang, s.source, 'term', s.term, ((s.p - l.q) * (s.p - l.q) // l.q)::BIGINT
 FROM shares s JOIN langs l ON s.lang = l.lang AND s.term = l.term WHERE s.n > 0 AND s.p > l.q)
SELECT lang, source, part, item, value,
 row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank
FROM found QUALIFY part = 'pair' OR rank <= 200
"""

OP13_SQL = """
WITH RECURSIVE rows AS (SELECT *, row_number() OVER () AS id FROM documents),
fields AS (SELECT id, doc_id, lang, t.tampered,
  concat(coalesce(length(doc_id::VARCHAR) || ':' || doc_id, '-'),
   coalesce(strlen(source) || ':' || source, '-'), coalesce(strlen(lang) || ':' || lang, '-'),
   coalesce(length(n_chars::VARCHAR) || ':' || n_chars, '-')) AS head,
  CASE WHEN t.tampered THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END AS body,
  list_reduce([4294967295::BIGINT] || list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT),
   lambda a, c: list_reduce([xor(a, c)] || range(8), lambda x, i: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)) AS crc
 FROM rows, (VALUES (false), (true)) t(tampered)),
hashed AS (SELECT id, any_value(doc_id) AS doc_id, any_value(lang) AS lang,
  max(sha256(head || coalesce(strlen(body) || ':' || body, '-'))) FILTER (NOT tampered) AS leaf,
  max(sha256(head || coalesce(strlen(body) || ':' || body, '-'))) FILTER (tampered AND xor(crc, 4294967295) % 3 = 0) AS tampered
 FROM fields GROUP BY id),
placed AS (SELECT *, dense_rank() OVER (ORDER BY lang NULLS FIRST) AS tree, count(*) OVER (PARTITION BY lang) AS n,
  row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf, tampered NULLS FIRST) - 1 AS idx FROM hashed),
nodes(tree, level, idx, n, digest) AS (SELECT tree, 0, idx, n, leaf FROM placed
 UNION ALL SELECT tree, level + 1, idx // 8, (n + 7) // 8, sha256(string_agg(digest, '' ORDER BY idx))
 FROM nodes WHERE n > 1 GROUP BY tree, level, idx // 8, n),
subroots AS (SELECT tree, level, digest FROM nodes WHERE n = 1),
tops(level, idx, n, digest) AS (SELECT 0, tree - 1, count(*) OVER (), digest FROM subroots
 UNION ALL SELECT level + 1, idx // 8, (n + 7) // 8, sha256(string_agg(digest, '' ORDER BY idx))
 FROM tops WHERE n > 1 GROUP BY level, idx // 8, n),
every AS (SELECT tree, level, idx, n, digest FROM nodes
 UNION ALL SELECT s.tree, s.level + t.level, t.idx, t.n, t.digest FROM subroots s, tops t WHERE t.level > 0),
family AS (SELECT tree, level, idx, idx // 8 AS run, digest FROM nodes WHERE n > 1
 UNION ALL SELECT s.tree, s.level + t.level, t.idx, t.idx // 8, t.digest FROM subroots s, tops t WHERE t.n > 1),
runs AS (SELECT tree, level, run, list(digest ORDER BY idx) AS members FROM family GROUP BY ALL),
climb(id, tree, level, idx, folded, proof) AS (
 SELECT id, tree, 0, idx, coalesce(tampered, leaf), '' FROM placed
 UNION ALL
 SELECT c.id, c.tree, c.level + 1, p.idx // 8,
  sha256(array_to_string(r.members[:p.idx % 8], '') || c.folded || array_to_string(r.members[p.idx % 8 + 2:], '')),
  c.proof || array_to_string(r.members[:p.idx % 8], '') || array_to_string(r.members[p.idx % 8 + 2:], '')
 FROM climb c JOIN subroots s ON c.tree = s.tree,
  LATERAL (SELECT CASE WHEN c.level = s.level THEN c.tree - 1 ELSE c.idx END AS idx) p
 JOIN runs r ON r.tree = c.tree AND r.level = c.level AND r.run = p.idx // 8)
SELECT p.doc_id, p.leaf, s.digest AS subroot, t.digest AS root, sha256(last.proof) AS proof_sha256,
 last.folded AS folded_root, last.folded = t.digest AS verified
FROM placed p JOIN subroots s ON p.tree = s.tree JOIN (SELECT digest FROM tops WHERE n = 1) t ON true
JOIN (SELECT id, arg_max(folded, level) AS folded, arg_max(proof, level) AS proof FROM climb GROUP BY id) last ON last.id = p.id
"""

Query = Callable[[SparkSession, str], DataFrame]


def llm_queries() -> dict[str, Query]:
    return {
        "op1_chat_format": op1_chat_format,
        "op2_hnsw": op2_hnsw,
        "op3_simhash": op3_simhash,
        "op4_toxicity": op4_toxicity,
        "op5_quality_rules": op5_quality_rules,
        "op6_url_filters": op6_url_filters,
        "op7_mixing": op7_mixing,
        "op8_sharding": op8_sharding,
        "op9_licences": op9_licences,
        "op10_packing": op10_packing,
        "op11_divergence": op11_divergence,
        "op12_html": op12_html,
        "op13_manifest": op13_manifest,
    }


def llm_oracles() -> dict[str, str]:
    """SQL of the queries that SQL can express."""
    return {
        "op1_chat_format": OP1_SQL,
        "op6_url_filters": OP6_SQL,
        "op7_mixing": OP7_SQL,
        "op11_divergence": OP11_SQL,
        "op13_manifest": OP13_SQL,
    }
