"""Divergence of sources inside each language, priced from the supports of their terms.

Every (language, source) group gives each of the language's ``V`` kept terms the smoothed share
``p = 1 + floor(10^9 (count + 5) / (N + 5 V))``. Two groups differ by the sum of ``|p - q|`` over all
kept terms, most of which one of them or both lack. Nothing of that size is made: with ``z`` a
group's share of a term that it lacks and ``S`` the terms that it has, the sum over all terms is

* over ``S`` of the one, ``|p - z'|``: priced by its histogram (how many terms have a share), not term by term;
* over ``S`` of the other, in the same way;
* ``(V - |S| - |S'|) |z - z'|``: a constant for each term outside both;
* for terms in both, which the three above price wrongly, ``|p - q| - |p - z'| - |z - q| + |z - z'|``: a
  join of the postings (term, group, share), which has rows for terms that both groups have only.

Occurrences and documents of a term are counted together and summed before they are shuffled; what
is joined afterwards are postings of kept terms and histograms. All arithmetic is exact, in integers.

* null text, language and source count as empty; an empty one is a language or source of its own;
* a row is a document, so repeated rows count as often as they are there; ids are not read;
* a group without terms still has its shares (all ``z``) and its rows of part ``pair``;
* a language without kept terms: all its ``pair`` values are 0, no ``term`` rows; a language with one source
  has no ``pair`` rows; an empty table has none at all;
* equal values are ranked by the UTF-8 bytes of their items.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larkspur.llm.spark_util import give_back_shuffles, stage_table

#: Runs of ASCII letters and of all characters beyond ASCII.
TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def share(count: str, total: str, terms: str) -> Column:
    """``1 + floor(10^9 (count + 5) / (total + 5 terms))``; null without terms."""
    return F.expr(f"CASE WHEN {terms} > 0 THEN 1 + (cast(1000000000 AS decimal(38, 0)) * ({count} + 5)) div ({total} + 5 * {terms}) END").cast("long")


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, d): occurrences of a term in a group and documents of the group that hold it."""
    clean = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    words = docs.select(clean("lang"), clean("source"), F.regexp_extract_all(F.translate("text", UPPER, LOWER), F.lit(TERM), F.lit(0)).alias("words"))
    # a document's words, then each of them once
    each = words.select("lang", "source", F.size("words").alias("size"), F.posexplode(F.concat("words", F.array_distinct("words"))).alias("at", "term"))
    again = F.col("at") >= F.col("size")
    return each.groupBy("lang", "source", "term").agg(F.count_if(~again).alias("n"), F.count_if(again).alias("d"))


def postings_of(docs: DataFrame, least_docs: int) -> DataFrame:
    """(lang, source, term, n, total) of terms that at least ``least_docs`` documents of the language hold."""
    of_lang = Window.partitionBy("lang", "term")
    rows = term_counts(docs).select("lang", "source", "term", "n", F.sum("n").over(of_lang).alias("total"), F.sum("d").over(of_lang).alias("d"))
    return rows.where(F.col("d") >= least_docs).drop("d")


def groups_of(docs: DataFrame, postings: DataFrame) -> DataFrame:
    """(lang, source, size, support, lang_size, terms, zero) of every group: kept occurrences, kept terms that it has, the language's
    occurrences and kept terms, the share of a term that the group lacks."""
    clean = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    own = postings.groupBy("lang", "source").agg(F.sum("n").alias("size"), F.count(F.lit(1)).alias("support"))
    langs = postings.groupBy("lang", "term").agg(F.sum("n").alias("n")).groupBy("lang").agg(F.sum("n").alias("lang_size"), F.count(F.lit(1)).alias("terms"))
    rows = docs.select(clean("lang"), clean("source")).distinct().join(own, ["lang", "source"], "left").join(langs, "lang", "left")
    return rows.fillna(0, ["size", "support", "lang_size", "terms"]).withColumn("zero", share("0", "size", "terms"))


def pair_values(priced: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value): the sum over all kept terms of ``|p - q|`` for each two sources of a language."""
    other = groups.select("lang", F.col("source").alias("item"), F.col("support").alias("support2"), F.col("zero").alias("zero2"))
    both = groups.join(other, "lang").where("source <> item")
    outside = both.select("lang", "source", "item", ((F.col("terms") - F.col("support") - F.col("support2")) * F.abs(F.col("zero") - F.col("zero2"))).alias("x"))
    histogram = priced.groupBy("lang", "source", "p").agg(F.count(F.lit(1)).alias("m"))
    one_sided = histogram.join(other, "lang").where("source <> item").groupBy("lang", "source", "item").agg(F.sum(F.col("m") * F.abs(F.col("p") - F.col("zero2"))).alias("x"))
    b = priced.select("lang", "term", F.col("source").alias("item"), F.col("p").alias("q"), F.col("zero").alias("zero2"))
    met = priced.join(b, ["lang", "term"]).where("source < item")
    wrong = F.abs(F.col("p") - F.col("q")) - F.abs(F.col("p") - F.col("zero2")) - F.abs(F.col("zero") - F.col("q")) + F.abs(F.col("zero") - F.col("zero2"))
    overlap = met.groupBy("lang", "source", "item").agg(F.sum(wrong).alias("x"))
    for part in (one_sided, overlap):
        swapped = part.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "x")
        outside = outside.union(part).union(swapped)
    return outside.groupBy("lang", "source", "item").agg(F.coalesce(F.sum("x"), F.lit(0)).alias("value"))


def divergence_audit(docs: DataFrame, least_docs: int = 30, top: int = 50) -> DataFrame:
    """(lang, source, part, item, value, rank): how far each source of a language is from each other one (``pair``), and the
    ``top`` terms that it holds more of than the whole language does (``term``)."""
    postings = stage_table(postings_of(docs.select("text", "lang", "source"), least_docs), "postings")
    give_back_shuffles(docs.sparkSession)
    groups = stage_table(groups_of(docs, postings), "groups")
    priced = postings.join(groups, ["lang", "source"]).withColumn("p", share("n", "size", "terms"))
    ranked = lambda rows: rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")))
    pairs = ranked(pair_values(priced, groups)).withColumn("part", F.lit("pair"))
    above = priced.withColumn("q", share("total", "lang_size", "terms")).where("p > q")
    terms = ranked(above.select("lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))).where(F.col("rank") <= top)
    return pairs.unionByName(terms.withColumn("part", F.lit("term"))).select("lang", "source", "part", "item", "value", "rank")
