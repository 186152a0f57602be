"""Conversation shaping: tagged model output, turn pairing, prompt rendering, masks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def numbered_sections(text: Column) -> Column:
    """[(number, body)] of ``<n>...<n>``."""
    return F.arrays_zip(F.regexp_extract_all(text, F.lit(r"(?s)<(\d+)>(.*?)<\1>"), 1).alias("number"), F.regexp_extract_all(text, F.lit(r"(?s)<(\d+)>(.*?)<\1>"), 2).alias("body"))


def named_section(text: Column, name: str) -> Column:
    """The body of ``<name>...</name>``; null if absent."""
    return F.when(F.regexp_like(text, F.lit(f"(?s)<{name}>.*?</{name}>")), F.regexp_extract(text, f"(?s)<{name}>(.*?)</{name}>", 1))


def question_answers(text: Column) -> Column:
    """Turns (from, value) of ``<q>...<a>...<``, human and gpt in turn."""
    pattern = F.lit(r"(?s)<q>(.*?)<a>(.*?)<")
    pairs = F.arrays_zip(F.regexp_extract_all(text, pattern, 1).alias("q"), F.regexp_extract_all(text, pattern, 2).alias("a"))
    clean = lambda c, t: F.replace(F.replace(F.btrim(c, F.lit(" \t\n\r\x0b\x0c")), F.lit(f"<{t}>"), F.lit("")), F.lit(f"</{t}>"), F.lit(""))
    return F.flatten(F.transform(pairs, lambda p: F.array(F.struct(F.lit("human").alias("from"), clean(p["q"], "q").alias("value")), F.struct(F.lit("gpt").alias("from"), clean(p["a"], "a").alias("value")))))


def has_blank_turn(turns: Column) -> Column:
    """X4."""
    return F.exists(turns, lambda t: F.trim(t["value"]) == "")


def next_turn_pairs(turns: DataFrame, key: str, turn: str, role: str, text: str, first: str = "user", second: str = "assistant") -> DataFrame:
    """(key, turn, question, answer) where ``first`` is followed by ``second``."""
    w = Window.partitionBy(key).orderBy(turn)
    lagged = turns.withColumn("_r", F.lead(role).over(w)).withColumn("_t", F.lead(text).over(w))
    return lagged.where((F.col(role) == first) & (F.col("_r") == second)).select(key, turn, F.col(text).alias("question"), F.col("_t").alias("answer"))


def zip_answers(truth: DataFrame, answers: DataFrame) -> DataFrame:
    """Truth turns (key, turn, text) with the model's answer number ``turn div 2``; (key, n, answer)."""
    return truth.withColumn("n", F.floor(F.col("turn") / 2)).join(answers, ["key", "n"])


def drop_lead(turns: DataFrame, key: str, turn: str, role: str, first: str = "user") -> DataFrame:
    """Turns before the first human turn go; adds ``alternates``: does the role differ from the one before?"""
    w = Window.partitionBy(key).orderBy(turn)
    started = F.max(F.when(F.col(role) == first, 1).otherwise(0)).over(w.rowsBetween(Window.unboundedPreceding, 0))
    kept = turns.withColumn("_on", started).where("_on = 1").drop("_on")
    return kept.withColumn("alternates", F.coalesce(F.lag(role).over(w) != F.col(role), F.lit(True)))


def speaker(role: Column) -> Column:
    """Human and user are USER, gpt and assistant ASSISTANT, others unknown."""
    return F.when(F.lower(role).isin("human", "user"), "USER").when(F.lower(role).isin("gpt", "assistant"), "ASSISTANT").otherwise("unknown")


def with_signals(turns: DataFrame, key: str, turn: str, role: str, text: str, header: str = "") -> DataFrame:
    """``### ROLE: text`` lines and the signal that opens the next one."""
    line = F.concat(F.lit("### "), speaker(F.col(role)), F.lit(": "), F.col(text), F.lit("\n"))
    rows = turns.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(F.col(turn).alias("t"), line.alias("s")))).alias("x"))
    return rows.select(key, F.concat(F.lit(header), F.array_join("x.s", ""), F.lit("### ")).alias("conversation"))


def render(turns: DataFrame, key: str, turn: str, text: str, style: str, system: str = "", sep: str = " ", sep2: str = "</s>") -> DataFrame:
    """One prompt for each conversation, in one of the separator styles; roles alternate by position."""
    rows = turns.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(F.col(turn).alias("t"), F.col(text).alias("m")))).alias("x"))
    even = lambda i: i % 2 == 0
    role = lambda i: F.when(even(i), "USER").otherwise("ASSISTANT")
    has = lambda x: F.coalesce(x["m"], F.lit("")) != ""
    if style == "single":
        item = lambda x, i: F.when(has(x), F.concat(role(i), F.lit(": "), x["m"], F.lit(sep))).otherwise(F.concat(role(i), F.lit(":")))
        head = system + sep
    elif style == "two":
        item = lambda x, i: F.when(has(x), F.concat(role(i), F.lit(": "), x["m"], F.when(even(i), sep).otherwise(sep2))).otherwise(F.concat(role(i), F.lit(":")))
        head = system + sep
    elif style == "mpt":
        item = lambda x, i: F.when(has(x), F.concat(role(i), x["m"], F.lit(sep))).otherwise(role(i))
        head = system + sep
    elif style == "plain":
        item = lambda x, i: F.when(has(x), F.concat(x["m"], F.when(even(i), sep).otherwise(sep2))).otherwise("")
        head = system
    elif style == "llama_2":
        wrapped = f"<<SYS>>\n{system}\n<</SYS>>\n\n" if system else ""
        ask = lambda x, i: F.concat(F.lit(sep + "[INST] "), F.when(i == 0, wrapped).otherwise(""), x["m"], F.lit(" [/INST]"))
        item = lambda x, i: F.when(~has(x), "").when(even(i), ask(x, i)).otherwise(F.concat(F.lit(" "), x["m"], F.lit(" " + sep2)))
        head = ""
    else:
        raise ValueError(f"no such style: {style}")
    prompt = F.concat(F.lit(head), F.array_join(F.transform("x", item), ""))
    if style == "llama_2" and sep:
        prompt = F.ltrim(prompt, F.lit(sep))
    return rows.select(key, prompt.alias("prompt"))


def role_loss_mask(turns: DataFrame, role: str) -> DataFrame:
    """X10, by role: only the assistant's turns count."""
    return turns.withColumn("loss", (F.col(role) == "assistant").cast("int"))


def signed_lengths(turns: DataFrame, key: str, text_words: Column, has_image: Column, image_tokens: int = 128) -> DataFrame:
    """X11: words of a conversation, plus image tokens; negative without an image."""
    rows = turns.groupBy(key).agg(F.sum(text_words).alias("_n"), F.max(has_image.cast("int")).alias("_i"))
    return rows.select(key, F.when(F.col("_i") == 1, F.col("_n") + image_tokens).otherwise(-F.col("_n")).cast("long").alias("length"))


def padded(ids: Column, length: int, pad: int) -> Column:
    """Cut to ``length`` and padded at the end."""
    cut = F.slice(ids, 1, length)
    return F.concat(cut, F.array_repeat(F.lit(pad), F.lit(length) - F.size(cut)))


def shuffled_sentences(text: Column, key: Column, probability: float, seed: int) -> Column:
    """With ``probability`` the sentences in a seeded order, else the text; sentences end at a stop and a blank."""
    sentences = F.split(text, r"(?<=[.!?])\s+")
    h = lambda *parts: F.md5(F.concat_ws("_", F.lit(seed).cast("string"), key.cast("string"), *parts).cast("binary"))
    order = F.transform(F.array_sort(F.transform(sentences, lambda s, i: F.struct(h(i.cast("string")).alias("h"), s.alias("s")))), lambda x: x["s"])
    chosen = F.conv(F.substring(h(), 1, 8), 16, 10).cast("long") % 1000 < int(probability * 1000)
    return F.when(chosen, F.array_join(order, " ")).otherwise(text)


def pick(bank: list[str], key: Column) -> Column:
    """A prompt of the bank by hash of the key."""
    return F.element_at(F.array(*[F.lit(x) for x in bank]), (F.conv(F.substring(F.md5(key.cast("string").cast("binary")), 1, 8), 16, 10).cast("long") % len(bank) + 1).cast("int"))
