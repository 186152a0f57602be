"""Queries over texts and conversations."""

from __future__ import annotations

from html.entities import html5

from pyspark.sql import functions as F

from larkspur.functions import text as X
from larkspur.functions import values as W
from larkspur.operators import conversations as V
from larkspur.operators import meteor
from larkspur.operators import text_metrics as M
from larkspur.plans.metric_queries import rounded
from larkspur.plans.stand_in import GRAMS, PAIRS, report_pairs, table, turns

QUERIES = {}
SQL = {}


def add(name, sql=None):
    def keep(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return keep


def doc_text(name, column, sql, source="documents", key="doc_id"):
    """A query of one expression over the texts of a table."""
    QUERIES[name] = lambda spark, d: table(spark, d, source).select(key, column().alias("value"))
    SQL[name] = f"SELECT {key}, {sql} AS value FROM {source}"


T = lambda: F.col("text")
NOISY = lambda: F.concat(F.lit('"'), F.replace(T(), F.lit(" the "), F.lit(" . the_")), F.lit("<|eot_id|> ."))
NOISY_SQL = "'\"' || replace(text, ' the ', ' . the_') || '<|eot_id|> .'"

doc_text("clean_reference", lambda: F.md5(X.clean_reference(NOISY()).cast("binary")), f"md5(replace(replace(replace({NOISY_SQL}, chr(10), ''), ' . ', '.'), ' .', '.'))")
doc_text("clean_prediction", lambda: F.md5(X.clean_prediction(NOISY()).cast("binary")), f"md5(replace(replace(replace(replace(replace(replace({NOISY_SQL}, chr(10), ''), '<|eot_id|>', ''), '\"', ''), '_', ''), ' . ', '.'), ' .', '.'))")
doc_text("clean_answer", lambda: F.md5(X.clean_answer(F.concat(F.lit("<s>"), T(), F.lit("</s><|eot_id|>"))).cast("binary")), "md5(replace(replace(replace(replace('<s>' || text || '</s><|eot_id|>', '<s>', ''), '</s>', ''), '<|eot_id|>', ''), chr(10), ''))")
doc_text("clean_prompt", lambda: F.md5(X.clean_prompt(F.concat(F.lit("('"), T(), F.lit('")'))).cast("binary")), "md5(replace(replace(replace(replace('(''' || text || '\")', '\"', ''), '''', ''), '(', ''), ')', ''))")
doc_text("findings_and_impression", lambda: F.md5(X.findings_and_impression(F.when(F.col("lang") == "de", "Not given.").otherwise(T()), F.when(F.col("lang") == "fr", F.lit(None)).otherwise(F.col("source"))).cast("binary")), "md5(CASE WHEN lang = 'de' THEN '' ELSE text END || CASE WHEN lang = 'fr' THEN '' ELSE source END)")
doc_text("report_template", lambda: F.md5(X.report_template(T(), F.col("source")).cast("binary")), "md5('Findings: ' || text || ' Impression: ' || source)")
doc_text("or_blank", lambda: X.or_blank(F.when(F.col("lang") == "en", F.col("source"))), "CASE WHEN lang = 'en' THEN source ELSE ' ' END")
doc_text("word_count", lambda: X.word_count(T()), "len(list_filter(regexp_split_to_array(text, '\\s+'), lambda w: w <> ''))")
doc_text("normalise_spaces", lambda: F.md5(X.normalise_spaces(T()).cast("binary")), "md5(lower(trim(regexp_replace(text, '\\s+', ' ', 'g'))))")
doc_text("question_bucket", lambda: X.question_bucket(F.element_at(F.array(*[F.lit(x) for x in ("free_response", "multiple_choice", "report_generation", "conversation", "other")]), (F.col("n_chars") % 5 + 1).cast("int"))), "(['Long answer', 'Multiple choice', 'Report generation', 'Long answer', 'Short answer'])[n_chars % 5 + 1]")
doc_text("metric_from_log", lambda: X.metric_from_log(F.when(F.col("n_chars") % 3 == 0, F.concat(F.lit("log Similarity : "), (F.col("n_chars") / 8).cast("string"), F.lit("e0 done"))).otherwise("none"), "Similarity"), "CASE WHEN n_chars % 3 = 0 THEN n_chars / 8 END")
doc_text("dimensions_from_text", lambda: F.aggregate(X.dimensions(F.concat_ws("x", (F.col("n_chars") % 7 + 1).cast("string"), F.lit("0.5"), F.lit("2"))), F.lit(1.0), lambda a, b: a * b), "(n_chars % 7 + 1)::DOUBLE")
doc_text("truth_from_text", lambda: X.truth(F.when(F.col("lang") == "en", "True").otherwise("False")), "lang = 'en'")
doc_text("first_of_list_text", lambda: X.first_of_list_text(F.concat(F.lit("["), (F.col("n_chars") / 4).cast("string"), F.lit(", 0.7]"))), "n_chars / 4")
doc_text("demographic_prompt", lambda: X.demographic_prompt(F.concat(F.lpad((F.col("n_chars") % 120).cast("string"), 3, "0"), F.lit("Y")), F.when(F.col("lang") == "en", "M").when(F.col("lang") == "de", "f"), F.col("source")), "substr(lpad((n_chars % 120)::VARCHAR, 3, '0'), 2) || ' years old ' || CASE lang WHEN 'en' THEN 'male' WHEN 'de' THEN 'female' ELSE 'None' END || ': ' || source")
doc_text("image_token_first", lambda: X.image_token_first(F.when(F.col("lang") == "en", F.concat(F.col("source"), F.lit(" <image> "), F.col("lang"))).otherwise(F.col("source")), True), "CASE WHEN lang = 'en' THEN '<im_start><image><im_end>' || chr(10) || source || '  en' ELSE source END")
doc_text("model_name_from_path", lambda: X.model_name(F.concat(F.lit("/m/"), F.col("source"), F.when(F.col("lang") == "en", "/checkpoint-7/").otherwise("/"))), "CASE WHEN lang = 'en' THEN source || '_checkpoint-7' ELSE source END")
doc_text("stop_keywords", lambda: X.stops(T(), ["###", "</s>"]), "contains(text, '###') OR contains(text, '</s>')")
doc_text("label_count_bucket", lambda: W.count_bucket(F.col("n_chars") % 15), "CASE WHEN n_chars % 15 = 0 THEN 0 WHEN n_chars % 15 <= 3 THEN 1 WHEN n_chars % 15 <= 6 THEN 2 WHEN n_chars % 15 <= 9 THEN 3 WHEN n_chars % 15 <= 12 THEN 4 ELSE 5 END")
doc_text("round_half_even", lambda: W.round_half_even(F.col("n_chars") / 2), "round_even(n_chars / 2, 0)")
doc_text("sigmoid_log", lambda: F.round(W.log_eps(W.sigmoid((F.col("n_chars") % 17) / 4.0 - 2)), 9), "round(ln(1 / (1 + exp(-((n_chars % 17) / 4.0::DOUBLE - 2))) + 1e-20), 9)")
doc_text("slice_count_filter", lambda: W.within(F.col("n_chars"), 100, 600), "n_chars >= 100 AND n_chars <= 600")
doc_text("slice_count_filter_strict", lambda: W.within(F.col("n_chars"), 100, 600, strict=True), "n_chars > 100 AND n_chars < 600")
doc_text("conditional_reversal", lambda: W.reversed_if(F.col("lang") == "de", F.col("source")), "CASE WHEN lang = 'de' THEN reverse(source) ELSE source END")
doc_text("zero_shot_prompts", lambda: F.concat_ws("|", *X.prompt_pair(F.col("source"))), "source || ' is present.|' || source || ' is not present.'")

doc_text("training_prompts", lambda: F.concat_ws("|", *X.prompt_pair(F.col("source"), training=True)), "'There is ' || source || '.|There is no ' || source || '.'")


@add("softmax_pair", "SELECT doc_id, round(exp(a - greatest(a, b)) / (exp(a - greatest(a, b)) + exp(b - greatest(a, b))), 9) AS present FROM (SELECT doc_id, (n_chars % 17) / 5.0::DOUBLE AS a, (n_chars % 13) / 5.0::DOUBLE AS b FROM documents)")
def _softmax(spark, d):
    a, b = (F.col("n_chars") % 17) / 5.0, (F.col("n_chars") % 13) / 5.0
    return table(spark, d, "documents").select("doc_id", F.round(W.softmax(a, b)[0], 9).alias("present"))


@add("text_length_stats", "SELECT lang, round(avg(n), 9) AS mean, round(stddev_samp(n), 9) AS sd FROM (SELECT lang, len(list_filter(regexp_split_to_array(text, '\\s+'), lambda w: w <> '')) AS n FROM documents) GROUP BY lang")
def _stats(spark, d):
    n = table(spark, d, "documents").select("lang", X.word_count(F.col("text")).alias("n"))
    return rounded(n.groupBy("lang").agg(F.avg("n").alias("mean"), F.stddev_samp("n").alias("sd")))


@add("bleu", f"""WITH {PAIRS}, {GRAMS},
p AS (SELECT h.n, sum(least(h.c, coalesce(r.c, 0))) / sum(h.c) AS p FROM hg h LEFT JOIN rg r USING (key, n, gram) GROUP BY h.n),
z AS (SELECT coalesce(max(p) FILTER (n = 1), 0) p1, coalesce(max(p) FILTER (n = 2), 0) p2, coalesce(max(p) FILTER (n = 3), 0) p3, coalesce(max(p) FILTER (n = 4), 0) p4 FROM p),
s AS (SELECT sum(len(ht)) h, sum(len(rt)) r FROM toks), b AS (SELECT CASE WHEN h >= r OR h = 0 THEN 1 ELSE exp(1 - r / h) END AS bp FROM s)
SELECT round(bp * p1, 9) AS bleu_1, round(bp * pow(p1 * p2, 0.5), 9) AS bleu_2, round(bp * pow(p1 * p2 * p3, 1.0::DOUBLE / 3), 9) AS bleu_3, round(bp * pow(p1 * p2 * p3 * p4, 0.25), 9) AS bleu_4,
       round((bp * p1 + bp * pow(p1 * p2, 0.5) + bp * pow(p1 * p2 * p3, 1.0::DOUBLE / 3) + bp * pow(p1 * p2 * p3 * p4, 0.25)) / 4, 9) AS bleu_mean FROM z, b""")
def _bleu(spark, d):
    return rounded(M.bleu(report_pairs(spark, d)))


@add("cider", f"""WITH {PAIRS}, {GRAMS}, df AS (SELECT n, gram, count(*) AS d FROM rg GROUP BY ALL), l AS (SELECT ln(count(*)) AS logn FROM pairs),
hw AS (SELECT key, n, gram, c, c * (logn - ln(greatest(coalesce(d, 1), 1))) AS w FROM hg LEFT JOIN df USING (n, gram), l),
rw AS (SELECT key, n, gram, c, c * (logn - ln(greatest(coalesce(d, 1), 1))) AS w FROM rg LEFT JOIN df USING (n, gram), l),
v AS (SELECT key, n, sum(least(h.w, r.w) * r.w) AS v FROM hw h JOIN rw r USING (key, n, gram) GROUP BY ALL),
hn AS (SELECT key, n, sqrt(sum(w * w)) AS hnorm, sum(c) AS hl FROM hw GROUP BY ALL), rn AS (SELECT key, n, sqrt(sum(w * w)) AS rnorm, sum(c) AS rl FROM rw GROUP BY ALL),
s AS (SELECT key, sum(coalesce(v / nullif(hnorm * rnorm, 0), 0)) AS s, sum(CASE WHEN n = 2 THEN coalesce(hl, 0) - coalesce(rl, 0) ELSE 0 END) AS delta FROM hn FULL JOIN rn USING (key, n) LEFT JOIN v USING (key, n) GROUP BY key)
SELECT key, round(coalesce(s / 4 * exp(-pow(delta, 2) / 72) * 10, 0), 8) AS cider FROM pairs LEFT JOIN s USING (key)""")
def _cider(spark, d):
    return rounded(M.cider(report_pairs(spark, d)), 8)


@add("rouge_l", rf"""WITH RECURSIVE {PAIRS}, t AS (SELECT key, list_filter(regexp_split_to_array(ref, '\s+'), lambda w: w <> '') AS a, list_filter(regexp_split_to_array(hyp, '\s+'), lambda w: w <> '') AS b FROM pairs),
lcs(key, i, v) AS (
  SELECT key, 0, list_transform(b, lambda x: 0) FROM t
  UNION ALL
  SELECT key, i + 1, list_transform(range(1, len(c) + 1), lambda j: list_max(c[1:j])) FROM (
    SELECT key, i, list_transform(range(1, len(b) + 1), lambda k: greatest(v[k], CASE WHEN a[i + 1] = b[k] THEN CASE WHEN k > 1 THEN v[k - 1] ELSE 0 END + 1 ELSE 0 END)) AS c FROM lcs JOIN t USING (key) WHERE i < len(a))),
f AS (SELECT key, len(a) AS r, len(b) AS h, coalesce(max(v[len(b)]), 0) AS l FROM t JOIN lcs USING (key) WHERE i = len(a) GROUP BY ALL)
SELECT key, round(CASE WHEN l = 0 THEN 0 ELSE 2.44::DOUBLE * (l / h) * (l / r) / (l / r + 1.44::DOUBLE * (l / h)) END, 9) AS rouge_l FROM f""")
def _rouge(spark, d):
    return report_pairs(spark, d).select("key", F.round(M.rouge_l("ref", "hyp"), 9).alias("rouge_l"))


@add("meteor_exact_stem")
def _meteor(spark, d):
    """Tests hold alignments against exhaustive search."""
    return rounded(meteor.meteor_exact_stem(report_pairs(spark, d)))


@add("report_generation_document")
def _generation(spark, d):
    from larkspur.sources import sinks

    pairs = report_pairs(spark, d)
    nlg = M.bleu(pairs).crossJoin(pairs.agg(F.avg(M.rouge_l("ref", "hyp")).alias("rouge_l"))).crossJoin(M.cider(pairs).agg(F.avg("cider").alias("cider")))  # one row each
    return sinks.metric_document({"generation": nlg})


@add("next_turn_pairs", f"WITH {PAIRS} SELECT key, md5(ref) AS ref, md5(hyp) AS hyp FROM pairs")
def _pairs(spark, d):
    return report_pairs(spark, d).select("key", F.md5(F.col("ref").cast("binary")).alias("ref"), F.md5(F.col("hyp").cast("binary")).alias("hyp"))


@add("zip_answers", "SELECT c.conv_id AS key, c.turn, c.turn // 2 AS n, md5(a.text) AS answer FROM conversations c JOIN (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS n, text FROM conversations WHERE role = 'assistant') a ON a.conv_id = c.conv_id AND a.n = c.turn // 2")
def _zip(spark, d):
    from pyspark.sql import Window

    t = turns(spark, d)
    own = (F.row_number().over(Window.partitionBy("conv_id").orderBy("turn")) - 1).cast("long")
    answers = t.where("role = 'assistant'").select(F.col("conv_id").alias("key"), own.alias("n"), F.md5(F.col("text").cast("binary")).alias("answer"))
    return V.zip_answers(t.select(F.col("conv_id").alias("key"), "turn"), answers).select("key", "turn", "n", "answer")


@add("drop_lead", """WITH s AS (SELECT *, max((role = 'user')::INT) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS started FROM conversations)
SELECT conv_id, turn, coalesce(lag(role) OVER (PARTITION BY conv_id ORDER BY turn) <> role, true) AS alternates FROM s WHERE started = 1""")
def _lead(spark, d):
    return V.drop_lead(turns(spark, d), "conv_id", "turn", "role").select("conv_id", "turn", "alternates")


@add("speaker_signals", "SELECT conv_id, md5('Chat' || string_agg('### ' || CASE role WHEN 'user' THEN 'USER' WHEN 'assistant' THEN 'ASSISTANT' ELSE 'unknown' END || ': ' || text || chr(10), '' ORDER BY turn) || '### ') AS conversation FROM conversations GROUP BY conv_id")
def _signals(spark, d):
    out = V.with_signals(turns(spark, d), "conv_id", "turn", "role", "text", "Chat")
    return out.select("conv_id", F.md5(F.col("conversation").cast("binary")).alias("conversation"))


def _render_sql(item, head, tail="{}"):
    return f"SELECT conv_id, md5({tail.format(f'{head} || string_agg({item}, chr(0) ORDER BY turn)')}) AS prompt FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS i FROM conversations) GROUP BY conv_id".replace("chr(0)", "''")


WHO = "CASE WHEN i % 2 = 0 THEN 'USER' ELSE 'ASSISTANT' END"
STYLES = {
    "single": _render_sql(f"CASE WHEN text <> '' THEN {WHO} || ': ' || text || ' ' ELSE {WHO} || ':' END", "'Sys '"),
    "two": _render_sql(f"CASE WHEN text <> '' THEN {WHO} || ': ' || text || CASE WHEN i % 2 = 0 THEN ' ' ELSE '</s>' END ELSE {WHO} || ':' END", "'Sys '"),
    "mpt": _render_sql(f"CASE WHEN text <> '' THEN {WHO} || text || ' ' ELSE {WHO} END", "'Sys '"),
    "plain": _render_sql("CASE WHEN text <> '' THEN text || CASE WHEN i % 2 = 0 THEN ' ' ELSE '</s>' END ELSE '' END", "'Sys'"),
    "llama_2": _render_sql("CASE WHEN text = '' THEN '' WHEN i % 2 = 0 THEN ' [INST] ' || CASE WHEN i = 0 THEN '<<SYS>>' || chr(10) || 'Sys' || chr(10) || '<</SYS>>' || chr(10) || chr(10) ELSE '' END || text || ' [/INST]' ELSE ' ' || text || ' </s>' END", "''", "ltrim({}, ' ')"),
}
for _style, _sql in STYLES.items():

    def _render(spark, d, style=_style):
        out = V.render(turns(spark, d), "conv_id", "turn", "text", style, "Sys")
        return out.select("conv_id", F.md5(F.col("prompt").cast("binary")).alias("prompt"))

    QUERIES[f"render_{_style}"], SQL[f"render_{_style}"] = _render, _sql


@add("role_loss_mask", "SELECT conv_id, turn, (role = 'assistant')::INT AS loss FROM conversations")
def _mask(spark, d):
    return V.role_loss_mask(turns(spark, d), "role").select("conv_id", "turn", "loss")


@add("signed_lengths", "SELECT conv_id, CASE WHEN conv_id % 3 = 0 THEN n + 128 ELSE -n END::BIGINT AS length FROM (SELECT conv_id, sum(len(list_filter(regexp_split_to_array(text, '\\s+'), lambda w: w <> ''))) AS n FROM conversations GROUP BY conv_id)")
def _signed(spark, d):
    return V.signed_lengths(turns(spark, d), "conv_id", X.word_count(F.col("text")), F.col("conv_id") % 3 == 0)


TAGGED = lambda: F.concat(F.lit("<1><q> "), F.col("ref"), F.lit(" <a>"), F.col("hyp"), F.lit("<q>again<a> ok <2><1>"))


@add("tagged_sections", f"WITH {PAIRS} SELECT key, '1' AS number, md5('<q> ' || ref || ' <a>' || hyp || '<q>again<a> ok <2>') AS body FROM pairs")
def _sections(spark, d):
    x = report_pairs(spark, d).select("key", F.explode(V.numbered_sections(TAGGED())).alias("s"))
    return x.select("key", "s.number", F.md5(F.col("s.body").cast("binary")).alias("body"))


@add("named_section", f"WITH {PAIRS} SELECT key, md5(hyp) AS body, NULL::VARCHAR AS missing FROM pairs")
def _named(spark, d):
    text = F.concat(F.lit("<description>"), F.col("hyp"), F.lit("</description>"))
    return report_pairs(spark, d).select("key", F.md5(V.named_section(text, "description").cast("binary")).alias("body"), V.named_section(text, "free_response").alias("missing"))


@add("question_answers", f"""WITH {PAIRS}, t AS (SELECT key, '<1><q> ' || ref || ' <a>' || hyp || '<q>again<a> ok <2><1>' AS s FROM pairs),
x AS (SELECT key, regexp_extract_all(s, '(?s)<q>(.*?)<a>(.*?)<', 1) AS q, regexp_extract_all(s, '(?s)<q>(.*?)<a>(.*?)<', 2) AS a FROM t),
u AS (SELECT key, unnest(range(len(q))) AS i, q, a FROM x)
SELECT key, md5(string_agg(trim(q[i + 1], chr(32) || chr(9) || chr(10) || chr(13) || chr(11) || chr(12)) || '|' || trim(a[i + 1], chr(32) || chr(9) || chr(10) || chr(13) || chr(11) || chr(12)), '|' ORDER BY i)) AS turns, max(len(q)) * 2 AS n FROM u GROUP BY key""")
def _qa(spark, d):
    x = report_pairs(spark, d).select("key", V.question_answers(TAGGED()).alias("t"))
    return x.where(F.size("t") > 0).select("key", F.md5(F.array_join("t.value", "|").cast("binary")).alias("turns"), F.size("t").cast("long").alias("n"))


@add("blank_turns", f"WITH {PAIRS} SELECT key, key LIKE '%1' AS broken FROM pairs")
def _blank(spark, d):
    answer = F.when(F.col("key").endswith("1"), " ").otherwise("fine")
    t = F.concat(F.lit("<q>a question<a>"), answer, F.lit("<"))
    return report_pairs(spark, d).select("key", V.has_blank_turn(V.question_answers(t)).alias("broken"))


@add("padded_batch", "SELECT doc_id, list_aggregate(x[1:10], 'sum')::BIGINT AS total, 10 AS size FROM (SELECT doc_id, list_concat(range(n_chars % 14), list_transform(range(10), lambda i: 0)) AS x FROM documents)")
def _padded(spark, d):
    n = (F.col("n_chars") % 14).cast("int")
    ids = F.when(n == 0, F.array().cast("array<int>")).otherwise(F.sequence(F.lit(0), n - 1))
    out = V.padded(ids, 10, 0)
    return table(spark, d, "documents").select("doc_id", F.aggregate(out, F.lit(0).cast("long"), lambda a, b: a + b).alias("total"), F.size(out).alias("size"))


@add("shuffled_sentences", r"""WITH s AS (SELECT doc_id, text, string_split(regexp_replace(text, '([.!?])\s+', '\1' || chr(1), 'g'), chr(1)) AS l FROM documents),
p AS (SELECT doc_id, text, l, unnest(range(len(l))) AS i FROM s),
o AS (SELECT doc_id, string_agg(l[i + 1], ' ' ORDER BY md5('3_' || doc_id || '_' || i), l[i + 1]) AS shuffled FROM p GROUP BY doc_id)
SELECT s.doc_id, md5(CASE WHEN ('0x' || substr(md5('3_' || s.doc_id), 1, 8))::BIGINT % 1000 < 500 THEN shuffled ELSE text END) AS text FROM s JOIN o USING (doc_id)""")
def _shuffled(spark, d):
    return table(spark, d, "documents").select("doc_id", F.md5(V.shuffled_sentences(F.col("text"), F.col("doc_id"), 0.5, 3).cast("binary")).alias("text"))


@add("prompt_bank_choice", "SELECT doc_id, (['Describe the scan.', 'Write a report.', 'What is seen?'])[('0x' || substr(md5(doc_id::VARCHAR), 1, 8))::BIGINT % 3 + 1] AS prompt FROM documents")
def _bank(spark, d):
    return table(spark, d, "documents").select("doc_id", V.pick(["Describe the scan.", "Write a report.", "What is seen?"], F.col("doc_id")).alias("prompt"))


@add("single_line_answers", f"WITH {PAIRS} SELECT key FROM pairs WHERE NOT contains(hyp, chr(10))")
def _single_line(spark, d):
    return report_pairs(spark, d).where(~F.col("hyp").contains("\n")).select("key")


@add("judge_requests", f"""WITH {PAIRS} SELECT key, md5('Question type: Short answer' || chr(10) || chr(10) || 'Question: What does ' || key || ' show?' || chr(10) || chr(10) || 'Ground truth answer: ' || ref || chr(10) || chr(10) || 'Generated answer: ' || hyp) AS request FROM pairs""")
def _judge(spark, d):
    p = report_pairs(spark, d)
    question = F.concat(F.lit("<image>\n<short_answer>What does "), "key", F.lit(" show?"))
    ask = X.judge_request(F.lit("short_answer"), question, F.col("ref"), F.concat(F.lit("<s>"), "hyp", F.lit("</s>")))
    return p.select("key", F.md5(ask.cast("binary")).alias("request"))


@add("masked_tokens", "SELECT conv_id, sum(length(coalesce(text, '')))::BIGINT AS ids, coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS labels FROM conversations GROUP BY conv_id")
def _masked(spark, d):
    from larkspur.operators import tokens

    rows = turns(spark, d).groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("t"))
    both = tokens.masked_rows(rows, "conv_id", "t", lambda text: [ord(c) for c in text])
    kept = F.size(F.filter("labels", lambda x: x != tokens.IGNORED))
    return both.select("conv_id", F.size("ids").cast("long").alias("ids"), kept.cast("long").alias("labels"))


#: Named references of HTML, longest match first where several fit, and numbered ones.
_NAMES = ", ".join(f"('{n}', '{c.replace(chr(39), chr(39) * 2)}')" for n, c in html5.items() if chr(0) not in c)


def _unescape_sql(source):
    """Each reference of ``source`` (page_id, html) as its characters: the text is cut at references, which are looked up and put back."""
    return rf"""(SELECT page_id, coalesce(string_agg(coalesce(CASE WHEN p LIKE '&%' THEN r END, p), '' ORDER BY i), '') AS html
FROM {source} LEFT JOIN (SELECT page_id, unnest(l) AS p, unnest(range(len(l))) AS i FROM (
  SELECT page_id, regexp_extract_all(html, '&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{{1,32}};?)|[^&]+|&') AS l FROM {source})) USING (page_id)
LEFT JOIN (SELECT p, coalesce(any_value(number), arg_max(c || substr(p, 2 + length(n)), length(n))) AS r FROM (
  SELECT p, CASE WHEN p ~ '^&#[0-9]+;?$' THEN chr(regexp_extract(p, '[0-9]+')::INT) WHEN p ~ '^&#[xX]' THEN chr(('0x' || regexp_extract(p, '[0-9a-fA-F]+'))::INT) END AS number
  FROM (SELECT DISTINCT unnest(regexp_extract_all(html, '&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{{1,32}};?)')) AS p FROM {source})) LEFT JOIN names ON starts_with(substr(p, 2), n) GROUP BY p) USING (p) GROUP BY page_id)"""


@add("unescaped_pages", f"WITH names(n, c) AS (VALUES {_NAMES}), once AS MATERIALIZED {_unescape_sql('pages')}, twice AS {_unescape_sql('once')} SELECT page_id, md5(html) AS html FROM twice")
def _unescaped(spark, d):
    return table(spark, d, "pages").select("page_id", F.md5(X.unescaped(F.col("html")).cast("binary")).alias("html"))


@add("article_texts", "SELECT page_id, source AS title, lang || chr(10) || source AS full_text FROM (SELECT doc_id AS page_id, source, lang FROM documents)")
def _articles(spark, d):
    from larkspur.sources import files

    xml = F.concat(F.lit("<article><front><article-title>"), "source", F.lit("</article-title></front><body><sec><title>"), "lang", F.lit("</title><p> "), "source", F.lit(" </p></sec></body></article>"))
    rows = table(spark, d, "documents").select(F.col("doc_id").alias("page_id"), files.parse_articles(xml).alias("a"))
    return rows.select("page_id", "a.title", "a.full_text")
