"""Cleaning of reports, prompts and model answers, and small parsers. Order of the steps matters."""

from __future__ import annotations

import html

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def remove(text: Column, *parts: str) -> Column:
    for part in parts:
        text = F.replace(text, F.lit(part), F.lit(""))
    return text


def _tidy_stops(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit(" . "), F.lit(".")), F.lit(" ."), F.lit("."))


def clean_reference(text: Column) -> Column:
    """P6."""
    return _tidy_stops(remove(text, "\n"))


def clean_prediction(text: Column) -> Column:
    """P7."""
    return _tidy_stops(remove(text, "\n", "<|eot_id|>", '"', "_"))


def clean_answer(text: Column) -> Column:
    """P8."""
    return remove(text, "<s>", "</s>", "<|eot_id|>", "\n")


def clean_prompt(text: Column) -> Column:
    """P9."""
    return F.translate(text, "\"'()", "")


def findings_and_impression(findings: Column, impression: Column) -> Column:
    """P10: parts that say ``Not given.`` or are null are empty."""
    blank = lambda c: F.when(c == "Not given.", "").otherwise(F.coalesce(c, F.lit("")))
    return F.concat(blank(findings), blank(impression))


def report_template(findings: Column, impression: Column) -> Column:
    """P11."""
    return F.concat(F.lit("Findings: "), findings, F.lit(" Impression: "), impression)


def demographic_prompt(age: Column, sex: Column, text: Column) -> Column:
    """Age like ``058Y``. A longer age is not cut by the padding."""
    digits = F.substr(age, F.lit(1), F.length(age) - 1)
    padded = F.when(F.length(digits) >= 3, digits).otherwise(F.lpad(digits, 3, "0"))
    years = F.coalesce(F.substr(padded, F.lit(2)), F.lit("None"))
    gender = F.when(F.lower(sex) == "m", "male").when(F.lower(sex) == "f", "female").otherwise("None")
    return F.concat(years, F.lit(" years old "), gender, F.lit(": "), text)


def or_blank(text: Column) -> Column:
    """P13, as meant: null becomes one blank."""
    return F.coalesce(text.cast("string"), F.lit(" "))


def first_of_list_text(text: Column) -> Column:
    """First number of a list literal such as ``[0.7, 0.7]``."""
    return F.from_json(text, "array<double>")[0]


def words(text: Column) -> Column:
    return F.filter(F.split(text, r"\s+"), lambda w: w != "")


def word_count(text: Column) -> Column:
    """P29."""
    return F.size(words(text)).cast("long")


def question_bucket(kind: Column) -> Column:
    """P21."""
    return F.when(kind.isin("free_response", "description", "conversation"), "Long answer").when(kind == "multiple_choice", "Multiple choice").when(kind == "report_generation", "Report generation").otherwise("Short answer")


FLOAT = r"([-+]?(?:\d+\.\d*|\.\d+|\d+)(?:[eE][-+]?\d+)?)"


def metric_from_log(text: Column, name: str) -> Column:
    """The first number after ``name:``; null if there is none."""
    return F.nullif(F.regexp_extract(text, name + r"\s*:\s*" + FLOAT, 1), F.lit("")).try_cast("double")


def dimensions(text: Column) -> Column:
    """``AxBxC`` as numbers."""
    return F.transform(F.split(text, "x"), lambda x: x.cast("double"))


def truth(text: Column) -> Column:
    """P25."""
    return F.lower(text) == "true"


def prompt_pair(label: Column, training: bool = False) -> tuple[Column, Column]:
    """The two sentences that a zero-shot score compares; those of the evaluation, or those used while training."""
    if training:
        return F.concat(F.lit("There is "), label, F.lit(".")), F.concat(F.lit("There is no "), label, F.lit("."))
    return F.concat(label, F.lit(" is present.")), F.concat(label, F.lit(" is not present."))


def normalise_spaces(text: Column) -> Column:
    """X14, cleaning part: white space collapsed, trimmed, lower case."""
    return F.lower(F.trim(F.regexp_replace(text, r"\s+", " ")))


def unescaped(text: Column) -> Column:
    """HTML entities, twice over, as characters."""

    @F.pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(lambda x: None if x is None else html.unescape(html.unescape(x)))

    return run(text)


def judge_request(kind: Column, question: Column, truth: Column, answer: Column) -> Column:
    """T6, without the model: what a judge of answers is asked. Tags of image and kind leave the question, and start and
    end marks the answer. The judge's own instructions are the caller's."""
    asked = remove(question, "<image>\n", "<report_generation>", "<short_answer>", "<long_answer>", "<multiple_choice>")
    parts = [("Question type: ", question_bucket(kind)), ("Question: ", asked), ("Ground truth answer: ", truth), ("Generated answer: ", remove(answer, "<s>", "</s>"))]
    return F.concat_ws("\n\n", *[F.concat(F.lit(head), F.coalesce(value, F.lit(""))) for head, value in parts])


def image_token_first(text: Column, start_end: bool = False) -> Column:
    """An image token moves to its own first line."""
    rest = F.trim(F.replace(text, F.lit("<image>"), F.lit("")))
    moved = F.when(text.contains("<image>"), F.trim(F.concat(F.lit("<image>\n"), rest))).otherwise(text)
    return F.replace(moved, F.lit("<image>"), F.lit("<im_start><image><im_end>")) if start_end else moved


def model_name(path: Column) -> Column:
    """X17."""
    parts = F.split(F.btrim(path, F.lit("/")), "/")
    last = F.element_at(parts, -1)
    return F.when(last.startswith("checkpoint-"), F.concat(F.try_element_at(parts, F.lit(-2)), F.lit("_"), last)).otherwise(last)


def stops(text: Column, keywords: list[str]) -> Column:
    """Does the text hold a stop keyword?"""
    hit = F.lit(False)
    for k in keywords:
        hit = hit | text.contains(k)
    return hit
