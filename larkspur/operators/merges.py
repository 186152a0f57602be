"""X14, byte-pair encoding as a relational fixpoint.

Every distinct word of a corpus is encoded once. It starts as the characters of its bytes, the last
one with the mark of a word's end. A round joins the adjacent pairs of all open words to the ranked merges,
takes each word's least rank and merges that pair wherever it occurs in the word, from left to right; a word
without a pair that merges is done and leaves. Rounds end when no word is open, so their number is
that of the merges of the word that needs most, whatever the corpus.

The documents are dealt to blocks of about ``BLOCK`` bytes. A block gives its distinct words, of which it has far fewer
than words, gets their ids back and writes them into its documents in Arrow; no row is made for a word of a document.

Null text has no tokens, as empty text has; characters beyond the pattern's classes are none of a word.
"""

from __future__ import annotations

from functools import reduce

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from larkspur.staging import dropped, staged

# Fixed value: the words of the encoding, contractions apart. Every character but white space is in one.
WORDS = r"[\p{L}]++|[\p{N}]|<\|startoftext\|>|<\|endoftext\|>|'(?:[stmd]|re|ve|ll)|[^\s\p{L}\p{N}]++"
#: Words that stand for themselves.
WHOLE = ("<|startoftext|>", "<|endoftext|>")
END = "</w>"
#: Bytes of the documents of a block, about.
BLOCK = 1 << 24
#: Merges of a word between two staged tables.
STEPS = 3


def byte_characters() -> list[str]:
    """The printable character that stands for each byte: itself where it is printable, else one from 256 up, in order."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return [chr(b) if b not in hidden else chr(256 + hidden.index(b)) for b in range(256)]


def words_of(text: Column) -> Column:
    """The words of cleaned text, in order, as one string with a space after each; white space before them is one space."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), rf"(?iU)({WORDS})\s*+|\s++", "$1 ")


def first_symbols(word: Column, end: str = END) -> Column:
    """The symbols of a word as one string with a space on both sides of each; no symbol holds a space."""
    shown = byte_characters()
    octets = F.decode(F.encode(word, "UTF-8"), "ISO-8859-1")  # one character for each byte
    hidden = [b for b in range(256) if shown[b] != chr(b)]
    symbols = F.regexp_replace(F.translate(octets, "".join(map(chr, hidden)), "".join(shown[b] for b in hidden)), "(?s).", " $0 ")
    marked = F.concat(F.substring(symbols, F.lit(1), F.length(symbols) - 1), F.lit(end + " "))
    return F.when(word.isin(*WHOLE), F.concat(F.lit(" "), word, F.lit(" "))).otherwise(marked)


def listed(symbols: Column) -> Column:
    return F.split(F.trim(F.replace(symbols, F.lit("  "), F.lit(" "))), " ")


def merged(symbols: Column, left: Column, right: Column) -> Column:
    """``symbols`` with each pair (left, right) as one, from left to right: every symbol has its own spaces, so pairs that overlap do not both match."""
    one = F.lit(" ")
    return F.replace(symbols, F.concat(one, left, one, one, right, one), F.concat(one, left, right, one))


def read_merges(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(left, right, rank) and (symbol, id) of a tokenizer file: JSON with ``model.merges`` and ``model.vocab``."""
    text = spark.read.text(path, wholetext=True)
    pairs = text.select(F.posexplode(F.from_json(F.get_json_object("value", "$.model.merges"), "array<array<string>>")).alias("rank", "m"))
    ids = text.select(F.explode(F.from_json(F.get_json_object("value", "$.model.vocab"), "map<string,int>")).alias("symbol", "id"))
    return pairs.select(F.col("m")[0].alias("left"), F.col("m")[1].alias("right"), "rank"), ids


def merged_once(words: DataFrame, merges: DataFrame) -> DataFrame:
    """(word, symbols, done) of (word, symbols), after the merge of each word's pair of least rank; done: it has none."""
    apart = words.select("word", "symbols", listed(F.col("symbols")).alias("s"))
    pairs = F.arrays_zip(F.slice("s", F.lit(1), F.size("s") - 1).alias("left"), F.slice("s", F.lit(2), F.size("s")).alias("right"))
    met = apart.select("word", "symbols", F.explode_outer(pairs).alias("p")).select("word", "symbols", "p.left", "p.right").join(merges, ["left", "right"], "left")
    least = met.groupBy("word", "symbols").agg(F.min("rank").alias("rank")).join(merges, "rank", "left")
    return least.select("word", F.coalesce(merged(F.col("symbols"), F.col("left"), F.col("right")), "symbols").alias("symbols"), F.col("rank").isNull().alias("done"))


def merge_words(words: DataFrame, merges: DataFrame, end: str = END) -> DataFrame:
    """(word, symbols) of the distinct ``words`` (word). No two of the ``merges`` (left, right, rank) share a rank."""
    open_ = first = staged(words.where("word <> ''").distinct().select("word", first_symbols(F.col("word"), end).alias("symbols")), "merge-words")
    merges = staged(merges, "merges")
    finished = []
    while True:
        for _ in range(STEPS):
            open_ = merged_once(open_.select("word", "symbols"), merges)
        after = staged(open_, "merge-round")
        finished.append(after.where("done").select("word", listed(F.col("symbols")).alias("symbols")))
        open_ = after.where("NOT done")
        if open_.isEmpty():
            dropped(first)
            return reduce(DataFrame.union, finished)


def _listed_words(docs: pa.Table) -> tuple[pa.Array, pa.Array]:
    """The words of a block's documents, and where each document's begin and end among them."""
    words = pc.split_pattern(docs["words"].combine_chunks(), " ")
    return words.flatten(), words.offsets


def _distinct_words(docs: pa.Table) -> pa.Table:
    words = pc.unique(_listed_words(docs)[0])
    words = words.filter(pc.not_equal(words, ""))
    return pa.table([pa.repeat(docs["_block"][0], len(words)), words], ["_block", "word"])


def _written_in(docs: pa.Table, known: pa.Table) -> pa.Table:
    """The documents of a block with the ids of their words, in order."""
    words, ends = _listed_words(docs)
    found = known["ids"].combine_chunks().take(pc.index_in(words, known["word"].combine_chunks()))
    return pa.table([docs["_key"], pa.ListArray.from_arrays(found.offsets.take(ends), found.values)], ["_key", "ids"])


def encode(docs: DataFrame, key: str, text: str, merges: DataFrame, vocabulary: DataFrame, end: str = END) -> DataFrame:
    """(key, ids): the token ids of every document, in order. ``key`` tells rows apart."""
    each = staged(docs.select(F.col(key).alias("_key"), words_of(F.col(text)).alias("words")), "words")
    blocks = 1 + (each.agg(F.sum(F.octet_length("words"))).first()[0] or 0) // BLOCK
    dealt = each.select(F.pmod(F.xxhash64("_key", "words"), F.lit(blocks)).cast("int").alias("_block"), "_key", "words")
    held = staged(dealt.select("_block", "words").groupBy("_block").applyInArrow(_distinct_words, "_block int, word string"), "block-words")
    symbols = merge_words(held.select("word"), merges, end).select("word", F.posexplode("symbols").alias("i", "symbol")).join(vocabulary, "symbol", "left")
    known = symbols.groupBy("word").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "id"))), lambda s: s["id"]).alias("ids"))
    given = held.join(known, "word").select("_block", "word", "ids")
    form = StructType([StructField("_key", each.schema["_key"].dataType), StructField("ids", given.schema["ids"].dataType)])
    return dealt.groupBy("_block").cogroup(given.groupBy("_block")).applyInArrow(_written_in, form).select(F.col("_key").alias(key), "ids")
