"""One query per operator, over its whole table, and the pipeline."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from loadloom.llm import chat, hard_negatives, html, licenses, packing, secrets, sentence_spans, toxicity, trie, vector_search
from loadloom.llm.decontaminate import contaminations
from loadloom.llm.jaccard_join import jaccard_components
from loadloom.llm.sharding import shard_by_bytes

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def op1_html(spark: SparkSession, sf: str) -> DataFrame:
    return html.extract_pages(_table(spark, sf, "pages"))


def op3_sentence_spans(spark: SparkSession, sf: str) -> DataFrame:
    return sentence_spans.remove_repeats(_table(spark, sf, "documents"))


def op5_packing(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf, "documents"))


def op6_vector_search(spark: SparkSession, sf: str) -> DataFrame:
    return vector_search.top_k(_table(spark, sf, "embeddings"))


CONTROL_TEXT = "</s>[INST] ok [/INST]"


def op2_chat(spark: SparkSession, sf: str) -> DataFrame:
    """The rows of ``conversations`` and one record in another layout, conversation -1."""
    turns = [F.struct(F.lit(r).alias("role"), F.lit(CONTROL_TEXT).alias("content")) for r in ("user", "assistant")]
    extra = spark.range(1).select(F.lit(-1).cast("bigint").alias("conv_id"), F.array(*turns).alias("messages"))
    records = _table(spark, sf, "conversations").unionByName(extra, allowMissingColumns=True)
    return chat.conversation_digests(chat.canonical_turns(records, strict=True))


def op4_secrets(spark: SparkSession, sf: str) -> DataFrame:
    return secrets.scan(_table(spark, sf, "documents")).drop("text_key")


def op7_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    return contaminations(_table(spark, sf, "documents"), _table(spark, sf, "benchmark"))


def op8_sharding(spark: SparkSession, sf: str) -> DataFrame:
    """24 shards of near-equal bytes; adding a shard moves other rows too under this law, so grown_shard is null."""
    shards = shard_by_bytes(_table(spark, sf, "documents"), 24)
    return shards.withColumns({"law": F.lit("bytes"), "grown_shard": F.lit(None).cast("int")})


def op10_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    docs = _table(spark, sf, "documents")
    scored = toxicity.score_documents(docs, toxicity.train_on_rest(docs, _table(spark, sf, "labels")))
    return scored.withColumn("held_out", F.coalesce(toxicity.held_out(), F.lit(False)))


def op9_jaccard_join(spark: SparkSession, sf: str) -> DataFrame:
    return jaccard_components(_table(spark, sf, "documents"))


def op11_licenses(spark: SparkSession, sf: str) -> DataFrame:
    return licenses.scan_licenses(_table(spark, sf, "documents"))


def op12_trie(spark: SparkSession, sf: str) -> DataFrame:
    return trie.prefix_trie(*trie.with_shared_heads(trie.ordered_turns(_table(spark, sf, "conversations"))))


def op13_hard_negatives(spark: SparkSession, sf: str) -> DataFrame:
    """Every seventh label moved on by one, so that some labels do not follow the vectors."""
    rows = _table(spark, sf, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(rows.select("vec_id", "embedding", label.alias("label")))


QUERIES: dict[str, Query] = {
    "op1_html": op1_html,
    "op2_chat": op2_chat,
    "op3_sentence_spans": op3_sentence_spans,
    "op4_secrets": op4_secrets,
    "op5_packing": op5_packing,
    "op6_vector_search": op6_vector_search,
    "op7_decontamination": op7_decontamination,
    "op8_sharding": op8_sharding,
    "op9_jaccard_join": op9_jaccard_join,
    "op10_toxicity": op10_toxicity,
    "op11_licenses": op11_licenses,
    "op12_trie": op12_trie,
    "op13_hard_negatives": op13_hard_negatives,
    "pipeline": corpus_pipeline.run,
}

# DuckDB counts code points, sorts and hashes bytes as Spark does.
_CONTROLS = r"<\||</?s>|\[/?INST\]|<</?SYS>>"
_ESCAPED = f"(length({{0}}) + length({{0}}) - length(replace({{0}}, '\\', '')) + len(regexp_extract_all({{0}}, '{_CONTROLS}')))"
_ROLE = _ESCAPED.format("role") + " + length(role) - length(replace(role, chr(10), ''))"
ORACLES: dict[str, str] = {
    "op2_chat": f"""
        WITH c AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -1, 0, 'user', '{CONTROL_TEXT}' UNION ALL SELECT -1, 1, 'assistant', '{CONTROL_TEXT}'
        )
        SELECT conv_id, count(*) AS n_turns,
            sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
            CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
            sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
            CAST(sum({len(chat.OPEN + chat.CLOSE) + 1} + {_ROLE} + {_ESCAPED.format("text")}) AS BIGINT) AS formatted_chars
        FROM c GROUP BY conv_id
    """,
    "op6_vector_search": """
        WITH v AS (
            SELECT DISTINCT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
                AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), s AS (
            SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
            FROM v q JOIN v c ON c.vec_id <> q.vec_id AND len(c.v) = len(q.v) WHERE q.vec_id % 100 = 0
        )
        SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
        FROM s QUALIFY rank <= 10
    """,
}
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ORACLES["op9_jaccard_join"] = f"""
    WITH RECURSIVE words AS (
        SELECT row_number() OVER () AS row, doc_id,
            regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '[^\\x20\\x09-\\x0D]+') AS ws
        FROM documents
    ), sets AS (
        SELECT row, doc_id, CASE
            WHEN len(ws) >= 5 THEN list_distinct(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')))
            WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END AS shingles
        FROM words
    ), held AS (SELECT row, len(shingles) AS n, unnest(shingles) AS shingle FROM sets),
    links AS (
        SELECT a.row AS a, b.row AS b FROM held a JOIN held b ON a.shingle = b.shingle AND a.row <> b.row
        GROUP BY a.row, b.row, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
    ), reach AS (
        SELECT row AS start, row FROM sets UNION SELECT r.start, l.b FROM reach r JOIN links l ON r.row = l.a
    ), least AS (SELECT r.start, min(s.doc_id) AS component_id FROM reach r JOIN sets s ON s.row = r.row GROUP BY r.start)
    SELECT s.doc_id, CAST(len(s.shingles) AS BIGINT) AS n_shingles, l.component_id FROM sets s JOIN least l ON l.start = s.row
"""


def _words_sql(words: list[str]) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


def _licences_sql() -> str:
    """Frequencies, rare words, votes by bands of places and key phrases, as lists of words joined by position."""
    phrases = ", ".join(f"('{label}', {_words_sql(licenses.words_of(p))})" for p, label in licenses.PHRASES.items())
    templates = ", ".join(f"({i}, '{t.label}', {licenses.n_rare(t)}, {_words_sql(licenses.words_of(t.text))})" for i, t in enumerate(licenses.TEMPLATES))
    keys = ", ".join(f"({i}, {j}, {_words_sql(licenses.words_of(k))})" for i, t in enumerate(licenses.TEMPLATES) for j, k in enumerate(t.keys))
    return f"""
    WITH docs AS (
        SELECT row_number() OVER () AS row, doc_id,
            regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
        FROM documents
    ), words AS (SELECT row, ws, unnest(ws) AS word, generate_subscripts(ws, 1) AS pos FROM docs),
    phrases(label, ps) AS (VALUES {phrases}),
    templates(unit, label, rare, ts) AS (VALUES {templates}),
    keys(unit, part, ks) AS (VALUES {keys}),
    places AS (SELECT unit, label, rare, ts, unnest(ts) AS word, generate_subscripts(ts, 1) AS at FROM templates),
    counts AS (SELECT p.word, count(DISTINCT w.row) AS n FROM (SELECT DISTINCT word FROM places) p LEFT JOIN words w USING (word) GROUP BY p.word),
    ranked AS (SELECT p.*, c.n, dense_rank() OVER (PARTITION BY unit ORDER BY c.n, p.word) AS part FROM places p JOIN counts c USING (word)),
    postings AS (SELECT * FROM ranked WHERE part <= rare),
    totals AS (SELECT unit, count(DISTINCT part) AS total FROM postings GROUP BY unit),
    base AS (
        SELECT w.row, p.label, w.pos - 1 AS place FROM words w JOIN phrases p ON w.word = p.ps[1] AND w.ws[w.pos : w.pos + len(p.ps) - 1] = p.ps
    ), votes AS (
        SELECT w.row, p.unit, w.pos - p.at AS place, 'r' || p.part AS part FROM words w JOIN postings p ON w.word = p.word
        UNION ALL
        SELECT w.row, k.unit, w.pos - t.at, 'k' || k.part FROM words w
        JOIN keys k ON w.word = k.ks[1] AND w.ws[w.pos : w.pos + len(k.ks) - 1] = k.ks
        JOIN places t ON t.unit = k.unit AND t.ts[t.at : t.at + len(k.ks) - 1] = k.ks
    ), bands AS (
        SELECT row, unit, shift, floor((place + shift) / {licenses.BAND}.0) AS band,
            count(DISTINCT part) FILTER (part LIKE 'r%') AS n_votes, count(DISTINCT part) FILTER (part LIKE 'k%') AS n_keys
        FROM votes, (VALUES (0), ({licenses.BAND // 2})) s(shift) GROUP BY ALL
    ), judged AS (
        SELECT b.row, t.label, b.n_votes / o.total AS share,
            b.n_votes * 100 >= o.total * {licenses.VOTES} AND b.n_keys = (SELECT count(*) FROM keys k WHERE k.unit = b.unit) AS accepted
        FROM bands b JOIN templates t USING (unit) JOIN totals o USING (unit)
    ), based AS (
        SELECT row, count(*) AS n, min(place) AS a, max(place) AS b, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM base GROUP BY row
    ), named AS (
        SELECT row, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
        FROM (SELECT row, label FROM base UNION SELECT row, label FROM judged WHERE accepted) GROUP BY row
    ), shares AS (SELECT row, max(share) AS share FROM judged GROUP BY row)
    SELECT d.doc_id, CAST(len(d.ws) AS BIGINT) AS n_words, coalesce(b.n, 0) AS n_base, b.a AS first_word, b.b AS last_word,
        coalesce(b.labels, '') AS base_labels, coalesce(n.labels, '') AS labels,
        CAST(CASE WHEN b.n > 0 THEN 1 ELSE coalesce(s.share, 0) END AS DOUBLE) AS score
    FROM docs d LEFT JOIN based b USING (row) LEFT JOIN named n USING (row) LEFT JOIN shares s USING (row)
    """


# The low bits of crc32 take the bitwise rule; texts stand for themselves in a prefix, with their lengths.
_CRC = "list_reduce(list_transform(range(1, length({0}) + 1), lambda i: CAST(ascii(substr({0}, CAST(i AS INTEGER), 1)) AS BIGINT)), lambda c, b: list_reduce([0, 1, 2, 3, 4, 5, 6, 7], lambda a, z: xor(a >> 1, (a & 1) * 3988292384), xor(c, b)), 4294967295)"
ORACLES["op11_licenses"] = _licences_sql()
ORACLES["op12_trie"] = f"""
    WITH turns AS (
        SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS pos,
            coalesce(role, '') AS role, coalesce(text, '') AS text
        FROM conversations WHERE conv_id IS NOT NULL
    ), convs AS (
        SELECT conv_id, conv_id - conv_id % 20 AS base, xor({_CRC.format("CAST(conv_id AS VARCHAR)")}, 4294967295) % 4 AS h
        FROM (SELECT DISTINCT conv_id FROM turns)
    ), lent AS (
        SELECT c.conv_id, t.pos, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.base WHERE t.pos < c.h
    ), rebuilt AS (
        SELECT * FROM lent UNION ALL
        SELECT t.conv_id, t.pos - c.h + (SELECT count(*) FROM lent l WHERE l.conv_id = c.conv_id), t.role, t.text
        FROM turns t JOIN convs c USING (conv_id) WHERE t.pos >= c.h
    ), members AS (
        SELECT conv_id, pos + 1 AS depth, md5(string_agg(length(role) || '/' || length(text) || '/' || role || text, '' ORDER BY pos)
            OVER (PARTITION BY conv_id ORDER BY pos)) AS node, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words
        FROM rebuilt UNION ALL SELECT conv_id, 0, 'root', 0 FROM convs
    ), tops AS (SELECT conv_id, max(depth) AS top FROM members GROUP BY conv_id),
    nodes AS (
        SELECT node, any_value(depth) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(words) AS saved,
            sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (depth = top), '')) AS ends_sha256
        FROM members JOIN tops USING (conv_id) GROUP BY node
    ), edges AS (SELECT DISTINCT a.node, b.node AS parent FROM members a JOIN members b ON a.conv_id = b.conv_id AND a.depth = b.depth + 1),
    kids AS (SELECT parent AS node, count(*) AS n FROM edges GROUP BY parent),
    below AS (SELECT DISTINCT a.node, b.node AS lower FROM members a JOIN members b ON a.conv_id = b.conv_id AND b.depth >= a.depth),
    sums AS (
        SELECT b.node, count(*) FILTER (k.n IS NULL) AS n_leaves, sum(n.saved) AS saved_tokens
        FROM below b JOIN nodes n ON n.node = b.lower LEFT JOIN kids k ON k.node = b.lower GROUP BY b.node
    )
    SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(k.n, 0) AS n_children, s.n_leaves,
        CAST(s.saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256
    FROM nodes n JOIN sums s USING (node) LEFT JOIN kids k USING (node) LEFT JOIN edges e USING (node) LEFT JOIN nodes p ON p.node = e.parent
"""
ORACLES["op13_hard_negatives"] = """
    WITH v AS (
        SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
            list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
        FROM embeddings
        WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
            AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ), s AS (
        SELECT a.vec_id AS anchor_id, a.v AS anchor, a.label = b.label AS same, b.vec_id,
            CAST(list_sum(list_transform(list_zip(a.v, b.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
        FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) WHERE a.vec_id % 100 = 0
    ), p AS (
        SELECT anchor_id, anchor, vec_id AS positive_id, score AS positive_score FROM s WHERE same
        QUALIFY row_number() OVER (PARTITION BY anchor_id, anchor ORDER BY score DESC, vec_id) <= 5
    )
    SELECT p.anchor_id, p.positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
    FROM p JOIN s ON s.anchor_id = p.anchor_id AND s.anchor = p.anchor AND NOT s.same
        AND 80 * p.positive_score <= 100 * s.score AND 100 * s.score <= 100 * p.positive_score
    WINDOW w AS (PARTITION BY p.anchor_id, p.anchor, p.positive_id ORDER BY s.score DESC, s.vec_id) QUALIFY rank <= 5
"""
if corpus_pipeline.ORACLE_SQL:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
