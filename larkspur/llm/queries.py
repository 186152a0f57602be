"""The registered queries of the training-data operators and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.llm import chat, chunks, divergence, jaccard, lines, minhash, mixing, neighbours, packing, rolling, shards, substrings, toxicity

TOKENIZER = "byte_bpe_50k.json"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"), n=5, percent=80)


def op2_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return neighbours.nearest(vectors, vectors.where("vec_id % 20 = 0").select("vec_id"), k=20)


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substrings.remove_repeats(docs, window=50).select("doc_id", "n_words", "n_removed", "kept_sha256")


def op4_interleave(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.shard_documents(table(spark, sf_dir, "documents"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score_documents(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), F.col("tox_score").alias("score"), (F.col("tox_score") >= 0.3).cast("int").alias("predicted"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return lines.dedup_lines(docs).select("doc_id", "n_lines", "n_dropped", "kept_sha256")


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    text = "</s>[INST] ok [/INST]"
    more = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(text).alias("text"))
    record = F.to_json(F.struct("role", "text"), {"ignoreNullFields": "false"})
    return chat.read_back(chat.format_records(rows.unionByName(more), "conv_id", "turn", record))


def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return chunks.edited_pairs(docs, chunks.parts_for(docs))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "copies")


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.best_fit_pack(table(spark, sf_dir, "documents"), tokenizer_path())


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergence_audit(table(spark, sf_dir, "documents"), least_docs=30, top=50)


def op12_rolling_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rolling.rolling_medians(table(spark, sf_dir, "clicks").select("click_id", "ts", "kind", "value"))


def op13_bbit_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), n=2, percent=80)


_LOWER_AZ = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"

NEAR_SQL = f"""
WITH RECURSIVE words AS (
  SELECT doc_id, {_WORDS.format(_LOWER_AZ.format("coalesce(text, '')"))} AS l FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, array_to_string(g, ' ') AS s FROM (
    SELECT doc_id, unnest(CASE WHEN len(l) = 0 THEN [] WHEN len(l) < :n THEN [l]
                               ELSE list_transform(range(1, len(l) - :n + 2), lambda i: l[i:i + :n - 1]) END) AS g FROM words)
), sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS i FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL
), links AS (
  SELECT x, y FROM shared JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y WHERE 100 * i >= 80 * (p.n + q.n - i)
), edges AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach(doc_id, c) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT e.y, r.c FROM reach r JOIN edges e ON e.x = r.doc_id
)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, c AS component_id
FROM documents d LEFT JOIN sizes USING (doc_id) JOIN (SELECT doc_id, min(c) AS c FROM reach GROUP BY doc_id) USING (doc_id)
"""

OP1_SQL = NEAR_SQL.replace(":n", "5")
OP13_SQL = f"SELECT *, doc_id = component_id AS kept FROM ({NEAR_SQL.replace(':n', '2')})"

OP3_SQL = f"""
WITH docs AS (SELECT doc_id, {_WORDS.format("coalesce(text, '')")} AS l FROM documents),
words AS (
  SELECT doc_id, i, l[i] AS word, CASE WHEN i + 49 <= len(l) THEN md5(array_to_string(l[i:i + 49], ' ')) END AS k
  FROM (SELECT doc_id, l, unnest(range(1, len(l) + 1)) AS i FROM docs)
), firsts AS (SELECT k, min(doc_id) AS m FROM words WHERE k IS NOT NULL GROUP BY k),
covered AS (
  SELECT doc_id, i, word, max(coalesce(m < doc_id, false)::INT) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS c
  FROM words LEFT JOIN firsts USING (k)
)
SELECT d.doc_id, len(d.l)::BIGINT AS n_words, coalesce(r.gone, 0)::BIGINT AS n_removed, sha256(coalesce(r.kept, '')) AS kept_sha256
FROM docs d LEFT JOIN (SELECT doc_id, sum(c) AS gone, string_agg(word, ' ' ORDER BY i) FILTER (c = 0) AS kept FROM covered GROUP BY doc_id) r USING (doc_id)
"""

#: The reflected CRC-32 of each byte, from its polynomial; the checksum itself folds the bytes of the UTF-8 text.
_CRC = [reduce(lambda c, _: c >> 1 ^ (0xEDB88320 if c & 1 else 0), range(8), byte) for byte in range(256)]
_CRC32 = f"xor(list_reduce(list_prepend(4294967295, [('0x' || h)::BIGINT for h in regexp_extract_all(hex(encode(text)), '..')]), lambda c, b: xor(c >> 8, {_CRC}[1 + (xor(c, b) & 255)])), 4294967295)"
_HASH60 = "('0x' || substr(md5({}), 1, 15))::BIGINT"

OP4_SQL = f"""
WITH rows AS (
  SELECT doc_id, source, octet_length(encode(text)) + 16 AS size, {_CRC32} AS crc FROM (SELECT doc_id, source, coalesce(text, '') AS text FROM documents)
), seeded AS (
  SELECT *, {_HASH60.format("concat('17:', doc_id, ':', crc, ':', size)")} AS h FROM rows
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY h, doc_id NULLS FIRST, crc, size) - 1 AS r, count(*) OVER (PARTITION BY source) AS n FROM seeded
), placed AS (
  SELECT *, row_number() OVER (ORDER BY (r + 0.5::DOUBLE) / n, {_HASH60.format("concat('17:', source, ':', r)")}, h, doc_id NULLS FIRST, crc, size) - 1 AS g, count(*) OVER () AS total FROM ranked
)
SELECT doc_id, size::BIGINT AS size, crc::BIGINT AS text_crc32, 'rows' AS law, (g * 40 // total)::INTEGER AS shard,
       (g - ((g * 40 // total) * total + 39) // 40)::BIGINT AS slot, NULL::INTEGER AS grown_shard, source
FROM placed
"""

OP6_SQL = f"""
WITH lines AS (
  SELECT doc_id, i, line, {_LOWER_AZ.format("trim(line, chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' ')")} AS key
  FROM (SELECT doc_id, unnest(l) AS line, unnest(range(len(l))) AS i
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents))
), repeated AS (
  SELECT key, min(doc_id) AS keep_in FROM lines WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) >= 2
)
SELECT doc_id, count(*)::BIGINT AS n_lines,
       count(*) FILTER (keep_in IS NOT NULL AND doc_id > keep_in)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (keep_in IS NULL OR doc_id = keep_in), '')) AS kept_sha256
FROM lines LEFT JOIN repeated USING (key) GROUP BY doc_id
"""

_ESCAPE = r"regexp_replace(replace({}, '\', '\\'), '" + chat.CONTROL + r"', '\1\\\2', 'g')"
_MARKS = len(chat.TURN + chat.TEXT + chat.DONE)

OP7_SQL = f"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
)
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum({_MARKS} + length({_ESCAPE.format("role")}) + length({_ESCAPE.format("text")}))::BIGINT AS formatted_chars
FROM rows GROUP BY conv_id
"""

#: All kept terms of all groups, one by one.
OP11_SQL = f"""
WITH docs AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all({_LOWER_AZ.format("coalesce(text, '')")}, '{divergence.TERM}') AS l FROM documents
), occurrences AS (SELECT r, lang, source, unnest(l) AS term FROM docs),
kept AS (SELECT lang, term, count(*) AS total FROM occurrences GROUP BY lang, term HAVING count(DISTINCT r) >= 30),
langs AS (SELECT lang, count(*) AS v, sum(total) AS lang_n FROM kept GROUP BY lang),
counts AS (SELECT lang, source, term, count(*) AS c FROM occurrences JOIN kept USING (lang, term) GROUP BY ALL),
sizes AS (SELECT lang, source, sum(c) AS n FROM counts GROUP BY ALL),
groups AS (SELECT DISTINCT lang, source FROM docs),
dense AS (
  SELECT lang, source, term, coalesce(c, 0) AS c, 1 + 1000000000::HUGEINT * (coalesce(c, 0) + 5) // (coalesce(n, 0) + 5 * v) AS p, 1 + 1000000000::HUGEINT * (total + 5) // (lang_n + 5 * v) AS q
  FROM groups JOIN kept USING (lang) JOIN langs USING (lang) LEFT JOIN sizes USING (lang, source) LEFT JOIN counts USING (lang, source, term)
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(sum(abs(x.p - y.p)), 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN dense x ON x.lang = a.lang AND x.source = a.source
  LEFT JOIN dense y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term GROUP BY ALL
), parts AS (
  SELECT lang, source, 'pair' AS part, item, value FROM pairs UNION ALL SELECT lang, source, 'term', term, p - q FROM dense WHERE c > 0 AND p > q
), ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM parts)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM ranked WHERE part = 'pair' OR rank <= 50
"""

#: Of each click the cents of its window, in order; the distances from the doubled median, in order.
OP12_SQL = """
WITH once AS (
  SELECT DISTINCT ON (click_id) click_id, ts, kind, cents FROM (
    SELECT click_id, ts, kind, CASE WHEN isfinite(value) AND abs(value * 100) < 288230376151711744 THEN CAST(floor(100 * value + 0.5) AS BIGINT) END AS cents FROM clicks WHERE ts IS NOT NULL)
  ORDER BY click_id, ts, kind NULLS FIRST, cents NULLS FIRST
), windows AS (
  SELECT click_id, kind, cents, list_sort(coalesce(list(cents) FILTER (cents IS NOT NULL) OVER (
    PARTITION BY kind ORDER BY ts RANGE BETWEEN INTERVAL '59 minutes 59.999999 seconds' PRECEDING AND CURRENT ROW), [])) AS w FROM once
), medians AS (SELECT *, len(w) AS n, w[(len(w) + 1) // 2] + w[len(w) // 2 + 1] AS m FROM windows),
distances AS (SELECT *, list_sort(list_transform(w, lambda x: abs(2 * x - m))) AS d FROM medians),
measured AS (SELECT *, d[(n + 1) // 2] + d[n // 2 + 1] AS mad FROM distances)
SELECT click_id, kind, n::BIGINT AS n, CASE WHEN n >= 2 THEN m::BIGINT END AS median2, CASE WHEN n >= 2 THEN mad::BIGINT END AS mad4,
       CASE WHEN n >= 2 THEN 2 * abs(2 * cents - m) > 3 * mad END AS far
FROM measured
"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_ngram_jaccard": op1_ngram_jaccard,
    "op2_nn_descent": op2_nn_descent,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_interleave": op4_interleave,
    "op5_toxicity": op5_toxicity,
    "op6_line_dedup": op6_line_dedup,
    "op7_chat_format": op7_chat_format,
    "op8_fingerprints": op8_fingerprints,
    "op9_mixing": op9_mixing,
    "op10_packing": op10_packing,
    "op11_source_divergence": op11_source_divergence,
    "op12_rolling_median": op12_rolling_median,
    "op13_bbit_minhash": op13_bbit_minhash,
}

ORACLE_SQL: dict[str, str] = {
    "op1_ngram_jaccard": OP1_SQL,
    "op3_substring_dedup": OP3_SQL,
    "op4_interleave": OP4_SQL,
    "op6_line_dedup": OP6_SQL,
    "op7_chat_format": OP7_SQL,
    "op11_source_divergence": OP11_SQL,
    "op12_rolling_median": OP12_SQL,
    "op13_bbit_minhash": OP13_SQL,
}
