"""Queries over labels and scores: classification, rank metrics, resampling."""

from __future__ import annotations

from pyspark.sql import functions as F

from larkspur.operators import classification as C
from larkspur.operators import ranked as R
from larkspur.operators import resampling as B
from larkspur.plans.stand_in import CONF, LEVELS, LONG, ROC, SCORES, scored, table, truth
from larkspur.sources import sinks

QUERIES = {}
SQL = {}


def add(name, sql=None):
    def keep(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return keep


def rounded(df, digits=9):
    return df.select(*[F.round(f"`{c}`", digits).alias(c) if t == "double" else F.col(f"`{c}`") for c, t in df.dtypes])


M = "round(precision, 9) AS precision, round(recall, 9) AS recall, round(f1, 9) AS f1"


@add("classification_report", f"""WITH {LONG}, {CONF}, {SCORES},
total AS (SELECT 'micro avg' AS label, sum(tp) tp, sum(fp) fp, sum(fn) fn FROM conf),
per_key AS (SELECT key, count(*) FILTER (y = 1 AND yhat = 1) tp, count(*) FILTER (y = 0 AND yhat = 1) fp, count(*) FILTER (y = 1 AND yhat = 0) fn FROM long GROUP BY key),
rows AS (
  SELECT label, precision, recall, f1, support FROM per_label
  UNION ALL SELECT label, coalesce(tp / nullif(tp + fp, 0), 0), coalesce(tp / nullif(tp + fn, 0), 0), coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), tp + fn FROM total
  UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), sum(support) FROM per_label
  UNION ALL SELECT 'weighted avg', sum(precision * support) / nullif(sum(support), 0), sum(recall * support) / nullif(sum(support), 0), sum(f1 * support) / nullif(sum(support), 0), sum(support) FROM per_label
  UNION ALL SELECT 'samples avg', avg(coalesce(tp / nullif(tp + fp, 0), 0)), avg(coalesce(tp / nullif(tp + fn, 0), 0)), avg(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0)), sum(tp + fn) FROM per_key
) SELECT label, {M}, support::BIGINT AS support FROM rows""")
def _report(spark, d):
    return rounded(C.report(scored(spark, d)))


@add("confusion_counts", f"WITH {LONG}, {CONF} SELECT label, tp, fp, fn, tn FROM conf")
def _confusion(spark, d):
    return C.confusion(scored(spark, d), "label")


@add("label_scores", f"WITH {LONG}, {CONF}, {SCORES} SELECT label, {M}, round(accuracy, 9) AS accuracy, support::BIGINT AS support FROM per_label")
def _scores(spark, d):
    return rounded(C.scores(C.confusion(scored(spark, d), "label")))


@add("macro_scores", f"WITH {LONG}, {CONF}, {SCORES} SELECT round(avg(precision), 9) AS precision, round(avg(recall), 9) AS recall, round(avg(f1), 9) AS f1, round(avg(accuracy), 9) AS accuracy FROM per_label")
def _macro(spark, d):
    per_label = C.scores(C.confusion(scored(spark, d), "label"))
    return rounded(per_label.agg(*[F.avg(c).alias(c) for c in ("precision", "recall", "f1", "accuracy")]))


@add("weighted_average_row", f"""WITH {LONG}, {CONF}, {SCORES} SELECT label, {M}, support::BIGINT AS support FROM per_label
UNION ALL SELECT 'Weighted Average', round(sum(precision * support) / sum(support), 9), round(sum(recall * support) / sum(support), 9), round(sum(f1 * support) / sum(support), 9), sum(support)::BIGINT FROM per_label""")
def _weighted(spark, d):
    return rounded(C.with_weighted_row(scored(spark, d)))


CRG_SQL = f"""WITH {LONG}, c AS (
  SELECT count(*) AS x_all, count(*) FILTER (y = 1) AS a_all, count(*) FILTER (y = 1 AND yhat = 1) AS tp, count(*) FILTER (y = 1 AND yhat = 0) AS fn, count(*) FILTER (y = 0 AND yhat = 1) AS fp FROM long
), s AS (SELECT *, (x_all - a_all) / (2 * a_all) AS r, (x_all - a_all) / 2 AS u FROM c), t AS (SELECT *, r * tp - r * fn - fp AS score_s FROM s)
SELECT tp AS "TP", fn AS "FN", fp AS "FP", x_all AS "X", a_all AS "A", round(r, 9) AS r, round(u, 9) AS "U", round(score_s, 9) AS score_s, round(coalesce(u / nullif(2 * u - score_s, 0), 0), 9) AS "CRG" FROM t"""


@add("crg_score", CRG_SQL)
def _crg(spark, d):
    return rounded(C.crg(scored(spark, d)))


@add("percent_scores", f"""WITH {LONG}, {CONF}, {SCORES}, t AS (SELECT sum(tp) tp, sum(fp) fp, sum(fn) fn, sum(tn) tn FROM conf)
SELECT round(100 * 2 * tp / (2 * tp + fp + fn), 9) AS micro_f1, round(100 * (SELECT avg(f1) FROM per_label), 9) AS macro_f1, round(100 * (tp + tn) / (tp + fp + fn + tn), 9) AS flat_accuracy FROM t""")
def _percent(spark, d):
    return rounded(C.percent_scores(scored(spark, d)))


@add("both_class_f1", f"""WITH {LONG}, {CONF} SELECT label, round((coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0) * (tp + fn) + coalesce(2 * tn / nullif(2 * tn + fp + fn, 0), 0) * (tn + fp)) / (tp + fp + fn + tn), 9) AS f1_weighted FROM conf""")
def _both(spark, d):
    return rounded(C.both_class_f1(scored(spark, d)))


@add("clinical_rates", f"WITH {LONG}, {CONF} SELECT label, round(tp / nullif(tp + fn, 0), 9) AS sensitivity, round(tn / nullif(tn + fp, 0), 9) AS specificity, round(tp / nullif(tp + fp, 0), 9) AS ppv, round(tn / nullif(tn + fn, 0), 9) AS npv FROM conf")
def _clinical(spark, d):
    return rounded(C.clinical_rates(scored(spark, d)))


@add("class_weights", f"WITH {LONG} SELECT label, round(count(*) FILTER (y = 0) / nullif(count(*) FILTER (y = 1), 0), 9) AS pos_weight FROM long GROUP BY label")
def _class_weights(spark, d):
    return rounded(C.class_weights(truth(spark, d)))


AUROC = "sum(pos * (n_all - fp + neg / 2)) / nullif(max(p_all * n_all), 0)"


@add("auroc_per_label", f"WITH {LONG}, {LEVELS} SELECT label, round({AUROC}, 9) AS auroc FROM levels GROUP BY label")
def _auroc(spark, d):
    return rounded(R.auroc(scored(spark, d)))


@add("selected_label_auroc", f"WITH {LONG}, {LEVELS}, a AS (SELECT label, {AUROC} AS auroc FROM levels GROUP BY label) SELECT round(avg(auroc) FILTER (label IN ('toxic')), 9) AS selected, round(avg(auroc), 9) AS macro FROM a")
def _selected(spark, d):
    a = R.auroc(scored(spark, d))
    return rounded(a.agg(F.avg(F.when(F.col("label").isin("toxic"), F.col("auroc"))).alias("selected"), F.avg("auroc").alias("macro")))


@add("average_precision", f"WITH {LONG}, {LEVELS} SELECT label, round(sum(pos / p_all * tp / (tp + fp)), 9) AS ap FROM levels GROUP BY label")
def _ap(spark, d):
    return rounded(R.average_precision(scored(spark, d)))


@add("pr_auc_trapezoid", f"""WITH {LONG}, {LEVELS}, pts AS (SELECT label, score, tp / p_all AS r, tp / (tp + fp) AS p FROM levels),
st AS (SELECT label, (r - lag(r, 1, 0) OVER w) * (p + lag(p, 1, 1) OVER w) / 2 AS a FROM pts WINDOW w AS (PARTITION BY label ORDER BY score DESC)) SELECT label, round(sum(a), 9) AS pr_auc FROM st GROUP BY label""")
def _prauc(spark, d):
    return rounded(R.pr_trapezoid(scored(spark, d)))


@add("roc_curve", f"WITH {LONG}, {LEVELS}, {ROC} SELECT label, round(threshold, 9) AS threshold, round(fpr, 9) AS fpr, round(tpr, 9) AS tpr FROM roc")
def _roc(spark, d):
    return rounded(R.roc_points(scored(spark, d)))


@add("partial_auroc", f"""WITH {LONG}, {LEVELS}, {ROC}, st AS (SELECT label, (fpr - lag(fpr, 1, 0) OVER w) * (tpr + lag(tpr, 1, 0) OVER w) / 2 AS a FROM roc WHERE fpr < 0.2 WINDOW w AS (PARTITION BY label ORDER BY threshold DESC))
SELECT l.label, round(a, 9) AS partial_auroc FROM (SELECT DISTINCT label FROM long) l LEFT JOIN (SELECT label, sum(a) AS a FROM st GROUP BY label) USING (label)""")
def _partial(spark, d):
    return rounded(R.partial_auroc(scored(spark, d)))


@add("youden_operating_point", f"""WITH {LONG}, {LEVELS}, {ROC}, r AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY tpr - fpr DESC, threshold DESC) AS n FROM roc)
SELECT label, round(CASE WHEN tpr - fpr > 0 THEN tpr ELSE 0 END, 9) AS sensitivity, round(CASE WHEN tpr - fpr > 0 THEN 1 - fpr ELSE 0 END, 9) AS specificity, round(CASE WHEN tpr - fpr > 0 THEN threshold END, 9) AS threshold FROM r WHERE n = 1""")
def _youden(spark, d):
    return rounded(R.youden(scored(spark, d)))


@add("threshold_search", f"""WITH {LONG}, g AS (SELECT i, i / 99 AS t FROM range(100) x(i)),
q AS (SELECT label, i, t, count(*) FILTER (y = 1 AND score > t) / count(*) FILTER (y = 1) AS tpr, count(*) FILTER (y = 0 AND score > t) / count(*) FILTER (y = 0) AS fpr FROM long, g GROUP BY ALL),
z AS (SELECT *, round(sqrt((1 - tpr) * (1 - tpr) + fpr * fpr), 12) AS away FROM q), n AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY away, i DESC) AS k FROM z)
SELECT label, round(t, 9) AS threshold, round(away, 9) AS distance FROM n WHERE k = 1""")
def _grid(spark, d):
    return rounded(R.grid_threshold(scored(spark, d)))


@add("topk_label_accuracy", f"""WITH {LONG}, r AS (SELECT key, row_number() OVER w AS k, sum(y) OVER (PARTITION BY key ORDER BY score DESC, label ROWS UNBOUNDED PRECEDING) AS hits, sum(y) OVER (PARTITION BY key) AS p FROM long WINDOW w AS (PARTITION BY key ORDER BY score DESC, label))
SELECT k, round(avg(CASE WHEN p = 0 THEN 1 ELSE hits / least(k, p) END), 9) AS accuracy FROM r GROUP BY k""")
def _topk(spark, d):
    return rounded(R.top_k_label_accuracy(scored(spark, d)))


@add("top1_accuracy", f"WITH {LONG}, r AS (SELECT y, row_number() OVER (PARTITION BY key ORDER BY score DESC, label DESC) AS k FROM long) SELECT round(avg(y), 9) AS accuracy FROM r WHERE k = 1")
def _top1(spark, d):
    return rounded(R.top_1_accuracy(scored(spark, d)))


@add("strict_left_align", f"WITH {LONG} SELECT key, label, y, round(score, 9) AS score FROM long")
def _align(spark, d):
    return rounded(scored(spark, d).select("key", "label", "y", "score"))


@add("strict_threshold", f"WITH {LONG} SELECT label, count(*) FILTER (score >= 8.0::DOUBLE / 17) AS at_least, count(*) FILTER (score > 8.0::DOUBLE / 17) AS above FROM long GROUP BY label")
def _strict(spark, d):
    t = 8.0 / 17
    return scored(spark, d).groupBy("label").agg(F.count_if(F.col("score") >= t).alias("at_least"), F.count_if(F.col("score") > t).alias("above"))


DRAW = "('0x' || substr(md5({}), 1, 8))::BIGINT"


@add("bootstrap_intervals", f"""WITH {LONG}, rows AS (SELECT y, yhat, row_number() OVER (ORDER BY key) - 1 AS pos, count(*) OVER () AS n FROM long WHERE label = 'quality'),
draws AS (SELECT b AS round, {DRAW.format("b || '_' || i")} % (SELECT count(*) FROM labels) AS pos FROM range(50) x(b), range((SELECT count(*) FROM labels)) z(i)),
acc AS (SELECT round, avg((y = yhat)::INT) AS a FROM draws JOIN rows USING (pos) GROUP BY round), s AS (SELECT list_sort(list(a)) AS l, avg(a) AS m FROM acc)
SELECT 'quality' AS label, round(m, 4) AS mean, round(l[greatest(floor(0.025 * len(l))::INT - 1, 0) + 1], 4) AS lower, round(l[greatest(floor(0.975 * len(l))::INT - 1, 0) + 1], 4) AS upper FROM s""")
def _bootstrap(spark, d):
    rows = scored(spark, d).where("label = 'quality'").select("key", "label", (F.col("y") == F.col("yhat")).cast("double").alias("ok"))
    acc = B.bootstrap_rows(spark, B.numbered(rows, "key"), rows.count(), 50).groupBy("label", "round").agg(F.avg("ok").alias("a"))
    return B.interval(acc, "a", "label")


LABEL_METRICS = ("auroc", "f1", "accuracy", "precision")


@add("bootstrap_metrics", f"""WITH {LONG}, {LEVELS}, {ROC}, best AS (SELECT label, threshold FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY tpr - fpr DESC, threshold DESC) AS n FROM roc) WHERE n = 1),
rows AS (SELECT label, y, score, (score >= threshold)::INT AS yhat, dense_rank() OVER (ORDER BY key) - 1 AS pos FROM long JOIN best USING (label)),
draws AS (SELECT b AS round, {DRAW.format("b || '_' || i")} % (SELECT count(*) FROM labels) AS pos FROM range(1000) x(b), range((SELECT count(*) FROM labels)) z(i)),
w AS (SELECT round, pos, count(*) AS w FROM draws GROUP BY ALL),
cells AS (SELECT label, round, score, yhat, sum(w * y) AS p, sum(w * (1 - y)) AS q FROM w JOIN rows USING (pos) GROUP BY ALL),
won AS (SELECT *, sum(q) OVER (PARTITION BY label, round ORDER BY score) AS lower, sum(q) OVER (PARTITION BY label, round, score) AS here FROM cells),
sums AS (SELECT label, round, sum(p) AS P, sum(q) AS N, sum(p * (lower - here / 2)) AS won, sum(CASE WHEN yhat = 1 THEN p ELSE 0 END) AS tp, sum(CASE WHEN yhat = 1 THEN q ELSE 0 END) AS fp FROM won GROUP BY ALL),
m AS (SELECT label, unnest(['auroc', 'f1', 'accuracy', 'precision']) AS metric, unnest([won / nullif(P * N, 0), coalesce(2 * tp / nullif(tp + fp + P, 0), 0), (tp + N - fp) / (P + N), coalesce(tp / nullif(tp + fp, 0), 0)]) AS v FROM sums),
l AS (SELECT label, metric, list_sort(list(v)) AS l, avg(v) AS m FROM m WHERE v IS NOT NULL GROUP BY ALL)
SELECT label, metric, round(m, 4) AS mean, round(l[greatest(floor(0.025 * len(l))::INT - 1, 0) + 1], 4) AS lower, round(l[greatest(floor(0.975 * len(l))::INT - 1, 0) + 1], 4) AS upper FROM l""")
def _bootstrap_metrics(spark, d):
    rows = scored(spark, d)
    keys = B.numbered(rows.select("key").distinct(), "key")
    at = rows.join(R.youden_threshold(rows), "label").withColumn("yhat", (F.col("score") >= F.col("threshold")).cast("int"))
    rounds = B.bootstrap_metrics(spark, at.join(keys, "key").select("pos", "label", "y", "score", "yhat"), keys.count(), 1000)
    long = rounds.unpivot(["label", "round"], list(LABEL_METRICS), "metric", "v").where("v IS NOT NULL")
    found = B.interval(long.withColumn("g", F.concat_ws("/", "label", "metric")), "v", "g")
    return found.select(F.split("g", "/")[0].alias("label"), F.split("g", "/")[1].alias("metric"), "mean", "lower", "upper")


@add("top_2_accuracy", f"WITH {LONG}, r AS (SELECT key, y, row_number() OVER (PARTITION BY key ORDER BY score DESC, label) AS n FROM long) SELECT round(avg(h), 9) AS accuracy FROM (SELECT key, max(CASE WHEN n <= 2 THEN y ELSE 0 END)::DOUBLE AS h FROM r GROUP BY key)")
def _top_2(spark, d):
    return rounded(R.top_k_accuracy(scored(spark, d), 2))


@add("poisson_bootstrap", f"""WITH {LONG}, w AS (SELECT b AS round, y, yhat, {DRAW.format("b || '_' || key")} / 4294967296 AS u FROM long, range(20) x(b) WHERE label = 'toxic'),
k AS (SELECT round, (y = yhat)::INT AS ok, (u >= 0.36787944117144233)::INT + (u >= 0.7357588823428847)::INT + (u >= 0.9196986029286058)::INT + (u >= 0.9810118431238462)::INT + (u >= 0.9963401531726563)::INT + (u >= 0.9994058151824183)::INT + (u >= 0.9999167588507119)::INT + (u >= 0.9999897508033253)::INT AS weight FROM w)
SELECT round, round(sum(ok * weight) / sum(weight), 9) AS accuracy FROM k GROUP BY round""")
def _poisson(spark, d):
    rows = scored(spark, d).where("label = 'toxic'").select("key", (F.col("y") == F.col("yhat")).cast("int").alias("ok"))
    w = B.poisson_weights(rows, "key", 20)
    return rounded(w.groupBy(F.col("round").cast("long").alias("round")).agg((F.sum(F.col("ok") * F.col("weight")) / F.sum("weight")).alias("accuracy")))


@add("hash_split", "SELECT doc_id, CASE WHEN row_number() OVER (ORDER BY md5(doc_id::VARCHAR), doc_id) <= floor(count(*) OVER () * 0.95) THEN 'train' ELSE 'valid' END AS split FROM documents")
def _split(spark, d):
    return B.hash_split(table(spark, d, "documents").select("doc_id"), "doc_id", 0.95)


@add("first_share", "SELECT doc_id FROM (SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS r, count(*) OVER () AS n FROM documents) WHERE r <= floor(n * 0.8)")
def _share(spark, d):
    return B.first_share(table(spark, d, "documents").select("doc_id"), "doc_id", 0.8)


@add("worker_chunks", "SELECT doc_id, ntile(7) OVER (ORDER BY doc_id) - 1 AS worker FROM documents")
def _chunks(spark, d):
    return B.worker_chunks(table(spark, d, "documents").select("doc_id"), "doc_id", 7)


@add("size_batches", """WITH r AS (SELECT doc_id, label, row_number() OVER (PARTITION BY label ORDER BY doc_id) - 1 AS rn FROM (SELECT doc_id, n_chars % 5 AS label FROM documents)),
b AS (SELECT doc_id, label, rn // 8 AS batch, rn % 8 AS slot, count(*) OVER (PARTITION BY label, rn // 8) AS n FROM r)
SELECT doc_id, label, batch, slot + c * n AS slot FROM b, range(8) x(c) WHERE slot + c * n < 8""")
def _batches(spark, d):
    docs = table(spark, d, "documents").select("doc_id", (F.col("n_chars") % 5).alias("label"))
    return B.size_batches(docs, "label", "doc_id", 8)


@add("shuffled_size_batches", """WITH r AS (SELECT doc_id, label, row_number() OVER (PARTITION BY label ORDER BY md5('5_' || doc_id), doc_id) - 1 AS rn FROM (SELECT doc_id, n_chars % 5 AS label FROM documents)),
b AS (SELECT doc_id, label, rn // 8 AS batch, rn % 8 AS slot, count(*) OVER (PARTITION BY label, rn // 8) AS n FROM r)
SELECT doc_id, label, batch, slot + c * n AS slot FROM b, range(8) x(c) WHERE slot + c * n < 8""")
def _shuffled_batches(spark, d):
    docs = table(spark, d, "documents").select("doc_id", (F.col("n_chars") % 5).alias("label"))
    return B.size_batches(docs, "label", "doc_id", 8, seed=5)


@add("length_grouped_sampler", """WITH RECURSIVE d AS (SELECT doc_id, CASE WHEN source LIKE '%1' THEN -n_chars ELSE n_chars END AS length FROM documents),
r AS (SELECT doc_id, abs(length) AS l, CASE WHEN length > 0 THEN 1 ELSE -1 END AS modality, row_number() OVER (PARTITION BY length > 0 ORDER BY md5(doc_id::VARCHAR), doc_id) - 1 AS r FROM d),
m AS (SELECT doc_id, l, modality, r // 64 AS megabatch, row_number() OVER w AS i, ceil(count(*) OVER (PARTITION BY modality, r // 64) / 4) AS per FROM r WINDOW w AS (PARTITION BY modality, r // 64 ORDER BY l DESC, doc_id)),
dealt(modality, megabatch, i, doc_id, worker, load, n) AS (
  SELECT DISTINCT modality, megabatch, 0::BIGINT, NULL::BIGINT, NULL::BIGINT, [0, 0, 0, 0]::BIGINT[], [0, 0, 0, 0]::BIGINT[] FROM m
  UNION ALL
  SELECT modality, megabatch, i, doc_id, w - 1, list_transform(range(1, 5), lambda k: load[k] + CASE WHEN k = w THEN l ELSE 0 END), list_transform(range(1, 5), lambda k: n[k] + (k = w)::BIGINT)
  FROM (SELECT m.*, load, n, list_min(list_transform(list_filter(range(1, 5), lambda k: n[k] < per), lambda k: load[k] * 8 + k)) % 8 AS w
        FROM dealt JOIN m ON m.modality = dealt.modality AND m.megabatch = dealt.megabatch AND m.i = dealt.i + 1)
)
SELECT doc_id, modality, megabatch, worker FROM dealt WHERE i > 0""")
def _lengths(spark, d):
    docs = table(spark, d, "documents").select("doc_id", F.when(F.col("source").endswith("1"), -F.col("n_chars")).otherwise(F.col("n_chars")).alias("length"))
    return B.length_groups(docs, "doc_id", "length", 64, 4)


@add("centre_slices", "SELECT doc_id, list_filter(range(n_chars % 40), lambda i: i >= floor((1 - 0.5) / 2 * (n_chars % 40)) AND i < floor((1 + 0.5) / 2 * (n_chars % 40)) AND (i - floor((1 - 0.5) / 2 * (n_chars % 40))::BIGINT) % 2 = 0)::VARCHAR AS kept FROM documents")
def _centre(spark, d):
    n = (F.col("n_chars") % 40).cast("int")
    arr = F.when(n == 0, F.array().cast("array<int>")).otherwise(F.sequence(F.lit(0), n - 1))
    kept = B.centre_slices(arr, 0.5, 2)
    return table(spark, d, "documents").select("doc_id", F.concat(F.lit("["), F.array_join(kept.cast("array<string>"), ", "), F.lit("]")).alias("kept"))




@add("classification_document")
def _document(spark, d):
    rows = scored(spark, d)
    per = rounded(C.scores(C.confusion(rows, "label")).join(R.auroc(rows), "label"))
    section = per.agg(F.array_sort(F.collect_list(F.struct(*per.columns))).alias("per_label"), F.avg("f1").alias("macro_f1"), F.avg("auroc").alias("macro_auroc"))
    return sinks.metric_document({"classification": section, "crg": C.crg(rows)})


@add("wide_labels", "SELECT 'doc_' || doc_id AS \"AccessionNo\", quality, toxic FROM labels")
def _wide(spark, d):
    return sinks.wide(truth(spark, d), "y", ["quality", "toxic"])


@add("summary_by_run", f"WITH {LONG}, {CONF} SELECT label, round(tp / nullif(tp + fp, 0), 9) AS run_a, round(tp / nullif(tp + fn, 0), 9) AS run_b FROM conf")
def _summary(spark, d):
    s = C.scores(C.confusion(scored(spark, d), "label"))
    long = s.select("label", F.lit("run_a").alias("run"), F.col("precision").alias("value")).unionByName(s.select("label", F.lit("run_b").alias("run"), F.col("recall").alias("value")))
    return rounded(sinks.summary_by_run(long, ["run_a", "run_b"]))


@add("top_scores", "SELECT doc_id, n_chars FROM documents ORDER BY n_chars DESC, doc_id LIMIT 10")
def _top(spark, d):
    return table(spark, d, "documents").select("doc_id", "n_chars").orderBy(F.desc("n_chars"), "doc_id").limit(10)
