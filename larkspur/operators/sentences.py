"""X13, sentences by statistics of the corpus itself, after the published unsupervised method of Kiss and Strunk (2006).

A full stop ends a sentence unless its word is an abbreviation or belongs with the word behind it. Both are learned from the texts:

* **Abbreviations** are short words that nearly always carry a stop. For each word, the log-likelihood ratio of "its stop is
  as likely as any word's" to "it nearly always has one" is weighed by its length, its inner stops and its occurrences without stop.
* **Collocations** are pairs (word with stop, word behind it) that occur together far more often than by chance.
* **Starters** are words that far more often than by chance follow a stop that isn't an abbreviation's; a starter
  in upper case ends the sentence even behind an abbreviation.

All of these are counts by word or pair, summed before they are shuffled; pieces of text are counted as they stand and cleaned once each. Of
the places only those before an end are made. The decisions are joined back to them, and only the places of ends come back to their text. White space inside a sentence stays; that between sentences goes.
Null text has no sentences, nor has blank text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspur.staging import staged

# Fixed values of the method: limits of the weighed and the plain ratios, and how sure an abbreviation's stop is.
ABBREVIATION, COLLOCATION, STARTER, SURE = 0.3, 7.88, 30.0, 0.99
_CLOSERS = r"[\"'»”’)\]]*$"


def log_likelihood(k: Column, n: Column, p: Column) -> Column:
    """Of ``k`` hits in ``n`` trials of probability ``p``."""
    part = lambda m, q: F.when(m <= 0, 0.0).otherwise(m * F.log(F.greatest(q, F.lit(1e-300))))
    return part(k, p) + part(n - k, 1 - p)


def pair_ratio(both: Column, first: Column, second: Column, total: Column) -> Column:
    """-2 log of the likelihood ratio of independence for a pair that occurs ``both`` times."""
    p, p1, p2 = second / total, both / first, (second - both) / F.greatest(total - first, F.lit(1))
    rest = second - both
    return -2 * (log_likelihood(both, first, p) + log_likelihood(rest, total - first, p) - log_likelihood(both, first, p1) - log_likelihood(rest, total - first, p2))


def abbreviation_score(stopped: Column, plain: Column, word: Column, total: Column, stops: Column) -> Column:
    n = stopped + plain
    ratio = -2 * (log_likelihood(stopped, n, stops / total) - log_likelihood(stopped, n, F.lit(SURE)))
    inner = F.length(word) - F.length(F.replace(word, F.lit("."), F.lit("")))
    letters = F.length(word) - inner
    return ratio * F.exp(-letters) * (inner + 1) * F.pow(letters.cast("double"), -plain)


def _bare(piece: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.rtrim(F.regexp_replace(piece, r"\s+$", "")), _CLOSERS, ""), r"^[\"'«“‘(\[]+", "")


def _plain(bare: Column) -> Column:
    return F.lower(F.regexp_replace(bare, r"[.!?,;:]+$", ""))


def _ends(bare: Column) -> Column:
    return F.when(bare.rlike(r"[!?]$"), "!").when(bare.rlike(r"\.$"), ".").otherwise("")


def _pieces(text: Column, pattern: str = r"\S+\s*") -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(pattern), F.lit(0))


def _placed(each: DataFrame) -> DataFrame:
    rows = each.select("_key", "at", _bare(F.col("z.p")).alias("w"), _bare(F.col("z.q")).alias("f"))
    first = F.substring("f", 1, 1)
    return rows.select("_key", "at", _plain(F.col("w")).alias("word"), _ends(F.col("w")).alias("ends"), _plain(F.col("f")).alias("following"), (first != F.lower(first)).alias("upper"))


def word_places(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, at, word, ends, following, upper): each word, bare and in lower case, how it ends (``.``, ``!`` or empty), and the word behind it."""
    rows = docs.select(F.col(key).alias("_key"), _pieces(F.col(text)).alias("p"))
    return _placed(rows.select("_key", F.posexplode(F.arrays_zip("p", F.slice("p", F.lit(2), F.greatest(F.size("p"), F.lit(1))).alias("q"))).alias("at", "z")))


def ending_places(docs: DataFrame, key: str, text: str) -> DataFrame:
    """The rows of ``word_places`` with an end."""
    rows = docs.select(F.col(key).alias("_key"), _pieces(F.col(text)).alias("p"))
    ended = F.transform("p", lambda x, i: F.when(x.rlike(_CLOSERS.replace("[", "[.!?][", 1).replace("$", r"\s*$")), F.struct(i.alias("at"), x.alias("p"), F.get("p", i + 1).alias("q"))))
    return _placed(rows.select("_key", F.explode(F.filter(ended, lambda x: x.isNotNull())).alias("z")).select("_key", "z.at", "z"))


def _scored(counts: DataFrame) -> DataFrame:
    sums = counts.agg(F.sum(F.col("stopped") + F.col("plain")).alias("total"), F.sum("stopped").alias("stops"))  # one row
    rows = counts.crossJoin(F.broadcast(sums)).where(F.col("word").rlike(r"\p{L}"))
    return rows.withColumn("score", abbreviation_score(*(F.col(c) for c in ("stopped", "plain", "word", "total", "stops"))))


def word_statistics(places: DataFrame) -> DataFrame:
    """(word, stopped, plain, total, stops, score) of every word with a letter."""
    return _scored(places.where("word <> ''").groupBy("word").agg(F.count_if(F.col("ends") == ".").alias("stopped"), F.count_if(F.col("ends") != ".").alias("plain")))


def text_statistics(docs: DataFrame, text: str) -> DataFrame:
    """The ``word_statistics`` of all places of the texts, from counts of the pieces as they stand, so that a piece is cleaned once."""
    pieces = docs.select(F.explode(_pieces(F.col(text), r"\S+")).alias("p")).groupBy("p").agg(F.count(F.lit(1)).alias("n"))
    forms = pieces.select(_bare(F.col("p")).alias("w"), "n").select(_plain(F.col("w")).alias("word"), _ends(F.col("w")).alias("ends"), "n").where("word <> ''")
    of = lambda test: F.sum(F.when(test, F.col("n")).otherwise(0))
    return _scored(staged(forms.groupBy("word").agg(of(F.col("ends") == ".").alias("stopped"), of(F.col("ends") != ".").alias("plain")), "sentence-counts"))


def collocations(places: DataFrame, words: DataFrame) -> DataFrame:
    """(word, following, both, ratio) of pairs around a stop that occur twice at least."""
    pairs = places.where("ends = '.' AND word <> '' AND following <> ''").groupBy("word", "following").agg(F.count(F.lit(1)).alias("both")).where("both > 1")
    behind = words.select(F.col("word").alias("following"), (F.col("stopped") + F.col("plain")).alias("second"))
    return pairs.join(words.select("word", "stopped", "total"), "word").join(behind, "following").select("word", "following", "both", pair_ratio(F.col("both"), F.col("stopped"), F.col("second"), F.col("total")).alias("ratio"), (F.col("both") / F.col("stopped") > F.col("second") / F.col("total")).alias("more"))


def sentence_starters(places: DataFrame, words: DataFrame, abbreviations: DataFrame) -> DataFrame:
    """(following, ratio) of words behind stops that are no abbreviation's."""
    ended = places.where("ends <> '' AND following <> ''").join(abbreviations, "word", "left_anti").groupBy("following").agg(F.count(F.lit(1)).alias("both"))
    first = ended.crossJoin(F.broadcast(ended.agg(F.sum("both").alias("first"))))  # one row
    behind = words.select(F.col("word").alias("following"), (F.col("stopped") + F.col("plain")).alias("second"), "total")
    return first.join(behind, "following").select("following", pair_ratio(F.col("both"), F.col("first"), F.col("second"), F.col("total")).alias("ratio"), (F.col("both") / F.col("first") > F.col("second") / F.col("total")).alias("more"))


def sentences(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, sentences) of every row; ``key`` tells rows apart."""
    places = staged(ending_places(docs, key, text), "sentence-words")
    words = staged(text_statistics(docs, text), "sentence-statistics")
    short = words.where(F.col("score") >= ABBREVIATION).select("word")
    tied = collocations(places, words).where((F.col("ratio") >= COLLOCATION) & F.col("more")).select("word", "following", F.lit(True).alias("tied"))
    starts = sentence_starters(places, words, short).where((F.col("ratio") >= STARTER) & F.col("more")).select("following", F.lit(True).alias("starts"))
    ends = places.where("ends <> ''").join(short.withColumn("short", F.lit(True)), "word", "left").join(tied, ["word", "following"], "left").join(starts, "following", "left")
    stop = (F.col("ends") == "!") | F.when(F.col("short"), F.coalesce("starts", F.lit(False)) & F.col("upper") & F.col("tied").isNull()).otherwise(F.col("tied").isNull())
    found = ends.where(stop).groupBy("_key").agg(F.collect_list("at").alias("ends"))
    rows = docs.select(F.col(key), _pieces(F.col(text)).alias("p")).join(found, F.col(key).eqNullSafe(F.col("_key")), "left")
    n = F.size("p")
    cuts = F.array_sort(F.array_distinct(F.filter(F.concat(F.coalesce("ends", F.array().cast("array<int>")), F.array(n - 1)), lambda a: a >= 0)))
    # a sentence goes from behind the cut before to its own
    spans = F.transform(cuts, lambda c, i: F.struct(F.when(i == 0, 0).otherwise(F.get(cuts, i - 1) + 1).alias("a"), c.alias("b")))
    joined = F.transform("spans", lambda s: F.regexp_replace(F.array_join(F.slice("p", s["a"] + 1, s["b"] - s["a"] + 1), ""), r"\s+$", ""))
    return rows.withColumn("spans", spans).select(key, joined.alias("sentences"))
