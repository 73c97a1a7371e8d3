"""The opN_ queries: each applies one operator to its whole table and derives the agreed columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import attribution, chat, embeddings, langid, licenses, minhash, mixing, packing, simhash, urls
from .common import LOWER, UPPER, read_table


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prompt and masked completions of all conversations, paired by their first turn."""
    return chat.preferences(read_table(spark, sf_dir, "conversations"))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's verdict: page_id, host, path, rule, verdict."""
    found = urls.judge(read_table(spark, sf_dir, "pages"), urls.rule_table(spark))
    return found.select("page_id", "host", "path", "rule", "verdict")


def op3_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts, their likeness, and each document's class of near copies."""
    docs = read_table(spark, sf_dir, "documents")
    return minhash.edited_fingerprints(docs, classes=minhash.document_classes(docs))


def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all embeddings: vec_id, n_links, component_id, kept."""
    return embeddings.near_duplicates(read_table(spark, sf_dir, "embeddings"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's share in the mix: doc_id, size, source_size, target, taken (and source, copies)."""
    return mixing.mix(read_table(spark, sf_dir, "documents"))


def op6_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's predicted language: doc_id, held_out, lang_pred, score (and bits_per_byte)."""
    docs = read_table(spark, sf_dir, "documents")
    found = langid.predict(docs.select("doc_id", "text"), langid.learn(docs))
    return found.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "bits_per_byte")


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every token piece's place: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    return packing.pack(read_table(spark, sf_dir, "documents"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash components of all documents: doc_id, fingerprint (16 hex digits), component_id."""
    found = simhash.simhash_components(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every line of every document: doc_id, section, start, end, n_tokens, n_crossing."""
    return attribution.section_tokens(read_table(spark, sf_dir, "documents"))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's license places and labels: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    return licenses.scan(read_table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_chat_format": op1_chat_format,
    "op2_url_filter": op2_url_filter,
    "op3_minhash": op3_minhash,
    "op4_embedding_dedup": op4_embedding_dedup,
    "op5_mixing": op5_mixing,
    "op6_langid": op6_langid,
    "op7_packing": op7_packing,
    "op8_simhash": op8_simhash,
    "op9_token_counts": op9_token_counts,
    "op10_license_scan": op10_license_scan,
}



def _url_sql() -> str:
    """Judges by rules and carries verdicts over the closure of the page's own links (recursive, so for small tables)."""
    node = "CASE WHEN strpos({u}, '://') > 0 THEN translate(regexp_extract({r}, '^[^/?#]*'), 'A', 'a') || regexp_extract({r}, '^[^/?#]*([^#]*)', 1) END"
    rest = "substr({u}, strpos({u}, '://') + 3)"
    node = node.replace("'A', 'a'", f"'{UPPER}', '{LOWER}'")
    of = lambda u: node.replace("{r}", rest).replace("{u}", u)
    rules = ", ".join(f"('{r}', '{r.partition('/')[0]}', '/{r.partition('/')[2]}', '{a}')" for r, a in urls.RULES)
    link = "regexp_extract(html, '<link[^>]*rel=\"canonical\"[^>]*href=\"(https?://[^\"]+)\"', 1)"
    return f"""
WITH RECURSIVE rules(rule, rh, rp, action) AS (VALUES {rules}),
p AS (SELECT page_id, {of("url")} AS node, html FROM pages),
e0 AS (SELECT node AS a, {of(link)} AS b FROM p WHERE node IS NOT NULL),
e AS (SELECT a, b FROM e0 WHERE a <> b UNION SELECT b, a FROM e0 WHERE a <> b),
nodes AS (SELECT node FROM p WHERE node IS NOT NULL UNION SELECT a FROM e),
parts AS (SELECT node, regexp_extract(node, '^[^/?#]*') AS host, regexp_extract(node, '^[^/?#]*([^?#]*)', 1) AS path FROM nodes),
hits AS (SELECT node, rule, action, row_number() OVER (PARTITION BY node ORDER BY length(rule) DESC, action, rule DESC) AS k
         FROM parts JOIN rules ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp)),
best AS (SELECT node, rule, action FROM hits WHERE k = 1),
reach(node, other) AS (SELECT node, node FROM nodes UNION SELECT r.node, e.b FROM reach r JOIN e ON e.a = r.other),
around AS (SELECT r.node, max(action = 'allow') AS al, max(action = 'block') AS bl FROM reach r LEFT JOIN best b ON b.node = r.other GROUP BY r.node)
SELECT page_id, coalesce(host, '') AS host, coalesce(path, '') AS path, rule,
       coalesce(action, CASE WHEN al THEN 'allow' WHEN bl THEN 'block' ELSE 'allow' END) AS verdict
FROM p LEFT JOIN parts ON p.node = parts.node LEFT JOIN best ON best.node = p.node LEFT JOIN around ON around.node = p.node"""


def _license_sql() -> str:
    places = []
    for phrase in licenses.PHRASES:
        words = phrase.split()
        test = " AND ".join(f"w[i + {k + 1}] = '{x}'" for k, x in enumerate(words))
        places.append(f"list_filter(range(len(w)), lambda i: {test})")
    n, labels = range(len(places)), list(licenses.PHRASES.values())
    sets = ", ".join(f"('{label}', {licenses.template_shingles(text)!r})" for label, text in licenses.TEMPLATES)
    size = licenses.SHINGLE
    return f"""
WITH t AS (SELECT row_number() OVER () AS row, doc_id, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS low FROM documents),
s AS (SELECT row, doc_id, low, list_filter(regexp_split_to_array(low, '{licenses.GAP}'), lambda x: x <> '') AS w FROM t),
b AS (SELECT row, doc_id, len(w) AS n_words, {", ".join(f"{x} AS p{k}" for k, x in enumerate(places))} FROM s),
templates(label, words) AS (VALUES {sets}),
l AS (SELECT row, unnest(regexp_split_to_array(low, '{licenses.BLANK}')) AS block FROM s),
lw AS (SELECT row, list_filter(regexp_split_to_array(block, '{licenses.GAP}'), lambda x: x <> '') AS w FROM l),
ls AS (SELECT row, list_distinct(list_transform(range(1, greatest(len(w) - {size - 1}, 1) + 1), lambda i: array_to_string(w[i:i + {size - 1}], ' '))) AS shingles FROM lw),
m AS (SELECT row, label, len(list_intersect(shingles, words)) / len(words) AS part FROM ls CROSS JOIN templates),
f AS (SELECT row, list(DISTINCT label) AS more, max(part) AS part FROM m WHERE part >= {licenses.THRESHOLD} GROUP BY row),
o AS (SELECT b.*, more, part, list_filter([{", ".join(f"CASE WHEN len(p{k}) > 0 THEN '{labels[k]}' END" for k in n)}], lambda x: x IS NOT NULL) AS own,
      {" || ".join(f"p{k}" for k in n)} AS places FROM b LEFT JOIN f ON b.row = f.row)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(len(places) AS BIGINT) AS n_base, list_min(places) AS first_word, list_max(places) AS last_word,
       array_to_string(list_sort(list_distinct(own)), ',') AS base_labels,
       array_to_string(list_sort(list_distinct(own || coalesce(more, []))), ',') AS labels,
       CASE WHEN len(own) > 0 THEN 1.0::DOUBLE ELSE coalesce(part, 0.0)::DOUBLE END AS score
FROM o"""


def _chat_sql() -> str:
    render = "array_to_string(list_transform({x}, lambda t: '<|' || t.role || '|>' || chr(10) || t.text || '<|end|>' || chr(10)), '')"
    mask = "array_to_string(list_transform({x}, lambda t: (length(t.role) + 5) || ':0,' || (length(t.text) + 8) || CASE WHEN t.role = 'assistant' THEN ':1' ELSE ':0' END), ',')"
    chosen, rejected = "c[shared + 1:]", "r[shared + 1:]"
    return f"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
v AS (SELECT conv_id, list(struct_pack(role := role, text := text) ORDER BY turn NULLS FIRST, role, text) AS turns FROM t GROUP BY conv_id),
q AS (SELECT conv_id, turns, md5(turns[1].role || chr(31) || turns[1].text) AS key, list_filter(turns, lambda t: t.role = 'assistant')[-1] AS reply,
      coalesce(list_max(list_filter(range(1, len(turns) + 1), lambda i: turns[i].role = 'assistant')), 0) AS at FROM v),
g AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY conv_id) AS i, count(*) OVER (PARTITION BY key) AS n FROM q),
p AS (SELECT *, row_number() OVER (ORDER BY key, conv_id) - 1 AS rank, count(*) OVER () AS paired FROM g WHERE NOT (i = n AND n % 2 = 1)),
o AS (SELECT *, row_number() OVER (ORDER BY reply IS NULL, key, conv_id) - 1 AS rank, count(reply) OVER () AS givers FROM g WHERE i = n AND n % 2 = 1),
b AS (SELECT a.rank // 2 AS pair_id, a.conv_id AS chosen_id, z.conv_id AS rejected_id, false AS derived, a.turns AS c, z.turns AS r
      FROM p a JOIN p z ON z.rank = a.rank + 1 WHERE a.rank % 2 = 0
      UNION ALL
      SELECT a.rank + coalesce((SELECT max(paired) FROM p), 0) // 2, a.conv_id, z.conv_id, z.conv_id IS NOT NULL, a.turns,
             CASE WHEN z.conv_id IS NOT NULL THEN list_append(a.turns[1:a.at - 1], z.reply) END
      FROM o a LEFT JOIN o z ON a.reply IS NOT NULL AND a.givers > 1 AND z.rank = (a.rank + 1) % a.givers),
s AS (SELECT *, CASE WHEN r IS NULL THEN 0 ELSE coalesce(list_min(list_filter(range(1, greatest(len(c), len(r)) + 1), lambda i: c[i] IS DISTINCT FROM r[i])) - 1, len(c)) END AS shared FROM b)
SELECT pair_id, chosen_id, rejected_id, derived, CAST(shared AS BIGINT) AS prompt_turns, {render.replace("{x}", "c[1:shared]")} AS prompt,
       {render.replace("{x}", chosen)} AS chosen, {mask.replace("{x}", chosen)} AS chosen_mask,
       CASE WHEN r IS NOT NULL THEN {render.replace("{x}", rejected)} END AS rejected, CASE WHEN r IS NOT NULL THEN {mask.replace("{x}", rejected)} END AS rejected_mask
FROM s"""


def _embedding_sql() -> str:
    """All pairs by brute force (small tables only)."""
    return """
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
u AS (SELECT * FROM v WHERE vec_id IS NOT NULL AND e IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND list_max(list_transform(e, lambda x: abs(x))) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.95),
r(a, b) AS (SELECT vec_id, vec_id FROM v UNION SELECT r.a, l.b FROM r JOIN l ON l.a = r.b)
SELECT v.vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, c AS component_id, v.vec_id = c AS kept
FROM v LEFT JOIN (SELECT a, count(*) AS n FROM l GROUP BY a) x ON x.a = v.vec_id JOIN (SELECT a, min(b) AS c FROM r GROUP BY a) y ON y.a = v.vec_id"""


#: op3 (numpy hashes), op5 (seeded draw), op6 (learned statistics), op7 and op9 (tokenizers) and op8 (XXH64) are tested
#: against brute force instead.
ORACLE_SQL: dict[str, str] = {
    "op1_chat_format": _chat_sql(),
    "op2_url_filter": _url_sql(),
    "op4_embedding_dedup": _embedding_sql(),
    "op10_license_scan": _license_sql(),
}
