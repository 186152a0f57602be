"""The test tables seen as the record types of the evaluators: labels, scores, reports, latents, conversations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.functions import keys
from larkspur.operators.align import strict_align
from larkspur.schema import STAND_IN
from larkspur.sources.submissions import label_probabilities


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(key, label, y) from ``labels``, wide to long."""
    rows = table(spark, sf_dir, "labels").withColumn("key", F.concat(F.lit("doc_"), F.col("doc_id").cast("string")))
    return rows.unpivot("key", list(STAND_IN), "label", "y")


def submission(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(input_image_name, probabilities): scores with ties, made from text lengths; more documents than labels."""
    docs = table(spark, sf_dir, "documents")
    scores = F.create_map(*[x for name, m in STAND_IN.items() for x in (F.lit(name), (F.col("n_chars") * m % 17) / 17.0)])
    return docs.select(F.concat(F.lit("doc_"), F.col("doc_id").cast("string"), F.lit(".nii.gz")).alias("input_image_name"), scores.alias("probabilities"))


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(key, label, y, score, yhat): the strict left-align of submission and truth, thresholded at 0.5."""
    preds = label_probabilities(submission(spark, sf_dir), list(STAND_IN)).withColumn("key", keys.stem_without_nii(F.col("key")))
    return strict_align(truth(spark, sf_dir), preds, ["key", "label"], "score").withColumn("yhat", (F.col("score") >= 0.5).cast("int"))


def turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations")


def report_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(key, ref, hyp): a user's turn as reference and the next assistant's as hypothesis."""
    from larkspur.operators.conversations import next_turn_pairs

    pairs = next_turn_pairs(turns(spark, sf_dir), "conv_id", "turn", "role", "text")
    return pairs.select(F.concat_ws("_", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("key"), F.col("question").alias("ref"), F.col("answer").alias("hyp"))


#: The same frames in SQL, as common table expressions.
LONG = """
long AS (
  SELECT 'doc_' || l.doc_id AS key, v.label, v.y, ((d.n_chars * v.m) % 17)::DOUBLE / 17.0::DOUBLE AS score,
         (((d.n_chars * v.m) % 17)::DOUBLE / 17.0::DOUBLE >= 0.5)::INT AS yhat
  FROM (SELECT doc_id, 'quality' AS label, quality AS y, 1 AS m FROM labels UNION ALL SELECT doc_id, 'toxic', toxic, 3 FROM labels) v
  JOIN labels l USING (doc_id) JOIN documents d USING (doc_id)
)"""
CONF = """
conf AS (
  SELECT label, count(*) FILTER (y = 1 AND yhat = 1) AS tp, count(*) FILTER (y = 0 AND yhat = 1) AS fp,
         count(*) FILTER (y = 1 AND yhat = 0) AS fn, count(*) FILTER (y = 0 AND yhat = 0) AS tn FROM long GROUP BY label
)"""
SCORES = """
per_label AS (
  SELECT label, coalesce(tp / nullif(tp + fp, 0), 0)::DOUBLE AS precision, coalesce(tp / nullif(tp + fn, 0), 0)::DOUBLE AS recall,
         coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0)::DOUBLE AS f1, coalesce((tp + tn) / nullif(tp + fp + fn + tn, 0), 0)::DOUBLE AS accuracy,
         tp + fn AS support FROM conf
)"""
LEVELS = """
levels AS (
  SELECT *, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER (PARTITION BY label) AS p_all, sum(neg) OVER (PARTITION BY label) AS n_all
  FROM (SELECT label, score, count(*) FILTER (y = 1) AS pos, count(*) FILTER (y = 0) AS neg FROM long GROUP BY ALL)
  WINDOW w AS (PARTITION BY label ORDER BY score DESC ROWS UNBOUNDED PRECEDING)
)"""
ROC = "roc AS (SELECT label, score AS threshold, fp / n_all AS fpr, tp / p_all AS tpr FROM levels)"
PAIRS = """
nxt AS (SELECT conv_id, turn, role, text, lead(role) OVER w AS r, lead(text) OVER w AS t FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
pairs AS (SELECT conv_id || '_' || turn AS key, text AS ref, t AS hyp FROM nxt WHERE role = 'user' AND r = 'assistant')"""
GRAMS = """
toks AS (SELECT key, list_filter(regexp_split_to_array(ref, '\\s+'), lambda w: w <> '') AS rt, list_filter(regexp_split_to_array(hyp, '\\s+'), lambda w: w <> '') AS ht FROM pairs),
rg AS (SELECT key, n, gram, count(*) AS c FROM (SELECT key, n, unnest(list_transform(range(1, len(rt) - n + 2), lambda i: array_to_string(rt[i:i + n - 1], ' '))) AS gram FROM toks, (SELECT unnest([1, 2, 3, 4]) AS n)) GROUP BY ALL),
hg AS (SELECT key, n, gram, count(*) AS c FROM (SELECT key, n, unnest(list_transform(range(1, len(ht) - n + 2), lambda i: array_to_string(ht[i:i + n - 1], ' '))) AS gram FROM toks, (SELECT unnest([1, 2, 3, 4]) AS n)) GROUP BY ALL)"""
