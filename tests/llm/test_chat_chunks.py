import hashlib
import json

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from larkspur.llm import chat, chunks

PARTS = st.lists(st.sampled_from(["<|turn|>", "<|text|>", "<|done|>", "</s>", "[INST]", "[/INST]", "\\", "<", "[", "a", "\n", "<|tu", "rn|>", "é"]), max_size=9).map("".join)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(PARTS, PARTS), max_size=4))
def test_escape_is_reversible_and_hides_controls(turns):
    for role, text in turns:
        assert chat.unescape(chat.escape(text)) == text and not chat._CONTROL.search(chat.escape(text))
    whole = "".join(chat.render(r, t)[0] for r, t in turns)
    assert [(chat.unescape(a), chat.unescape(b)) for a, b in chat._SEGMENT.findall(whole)] == turns
    for r, t in turns:
        s, a, b = chat.render(r, t)
        assert chat.unescape(s[a:b]) == t


def test_layouts(spark):
    records = [
        {"prompt": "p", "completion": "c"}, {"system": "s", "prompt": "p", "completion": "c"}, {"instruction": "i", "input": "x", "output": "o", "extra": {"n": 1}},
        {"messages": [{"role": "user", "content": "u"}, {"role": "assistant", "content": None}], "id": 4}, {"conversations": [{"from": "human", "value": "h"}, {"from": "gpt", "value": "g"}]},
        {"role": "user", "text": "t"}, {"prompt": "p", "response": "r"}, {"nothing": 1}, [1], None,
    ]
    df = spark.createDataFrame([(i, 0, None if r is None else json.dumps(r)) for i, r in enumerate(records)] + [(10, 0, "{broken")], "c long, o long, r string")
    got = chat.format_records(df, "c", "o", F.col("r")).orderBy("conv_id", "turn").collect()
    turns = {}
    for r in got:
        turns.setdefault(r["conv_id"], []).extend(chat._SEGMENT.findall(r["segment"]) if r["segment"] else [])
    assert turns == {
        0: [("user", "p"), ("assistant", "c")], 1: [("system", "s"), ("user", "p"), ("assistant", "c")], 2: [("user", "i\n\nx"), ("assistant", "o")], 3: [("user", "u"), ("assistant", "")],
        4: [("user", "h"), ("assistant", "g")], 5: [("user", "t")], 6: [("user", "p"), ("assistant", "r")], 7: [], 8: [], 9: [], 10: [],
    }
    assert {r["layout"] for r in got if r["conv_id"] in (7, 8, 9, 10)} == {None}
    assert dict(chat.conversations(chat.format_records(df, "c", "o", F.col("r"))).collect())[5] == "<|turn|>user<|text|>t<|done|>"


def test_read_back(spark):
    rows = [(1, 0, "user", "a</s>"), (1, 1, "assistant", "b\\<|done|>"), (1, 1, "assistant", "b\\<|done|>"), (2, None, None, None), (None, 0, "assistant", "z")]
    df = spark.createDataFrame(rows, "c long, t long, role string, text string")
    rec = F.to_json(F.struct("role", "text"), {"ignoreNullFields": "false"})
    got = {r["conv_id"]: r for r in chat.read_back(chat.format_records(df, "c", "t", rec)).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert got[1]["turns_sha256"] == sha("user\na</s>\nassistant\nb\\<|done|>\nassistant\nb\\<|done|>\n") and got[1]["loss_sha256"] == sha("b\\<|done|>" * 2) and got[1]["loss_chars"] == 20
    assert (got[2]["n_turns"], got[2]["loss_chars"], got[None]["loss_chars"]) == (1, 0, 1)
    assert chat.read_back(chat.format_records(df.limit(0), "c", "t", rec)).count() == 0


def test_an_insertion_moves_few_chunks():
    text = " ".join(f"word{i * 7919 % 1000}" for i in range(3000))
    a, b, c = chunks.fingerprints(pa.array([text, text[:9000] + "something new" + text[9000:], text]))
    assert (a == c).all() and chunks.likeness(a, b) > 0.95
    assert chunks.containment(chunks.fingerprints(pa.array([text[3000:9000]]))[0], a)[0] > 0.9


def test_cuts_do_not_depend_on_neighbours_in_a_batch():
    texts = [None, "", "short", "abc " * 400, " ".join(f"w{i}" for i in range(900)), "é" * 300]
    alone = [chunks.fingerprints(pa.array([t], pa.string()))[0].tolist() for t in texts]
    assert [x.tolist() for x in chunks.fingerprints(pa.array(texts, pa.string()))] == alone


@pytest.mark.parametrize("parts", [1, 6])
def test_edited_pairs(docs, rows, parts):
    got = {r["doc_id"]: r for r in chunks.edited_pairs(docs, parts).collect()}
    ordered = sorted((r[0], r[1] or "") for r in rows)
    assert sorted(got) == [d for d, _ in ordered]
    texts = {}
    for k, (d, t) in enumerate(ordered):
        nxt = ordered[(k + 1) % len(ordered)][1]
        q = len(t) // 4
        edited = t[: len(t) - q] + nxt[:q]
        r = got[d]
        assert r["n_chars"] == len(t) and r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        own, ed, nx = (chunks.fingerprints(pa.array([x]))[0] for x in (t, edited, nxt))
        assert (r["fingerprint"], r["edited_fingerprint"]) == (chunks.as_text(own), chunks.as_text(ed))
        assert r["near_edited"] == pytest.approx(chunks.likeness(own, ed)) and r["near_next"] == pytest.approx(chunks.likeness(own, nx))
        assert texts.setdefault(t, r["fingerprint"]) == r["fingerprint"]


def test_chunk_edge_cases(odd_docs, rows, no_docs, docs):
    assert chunks.edited_pairs(odd_docs, 3).count() == len(rows) + 6
    assert chunks.edited_pairs(no_docs, 3).count() == 0
    one = docs.where("doc_id = 0")
    r = chunks.edited_pairs(one, 3).first()
    assert r["near_next"] == 1.0


def plain_chunks(raw):
    """Chunk ends by a rolling loop over the bytes."""
    gear = [int(x) for x in chunks._GEAR]
    h, at, ends = 0, 0, []
    for i, b in enumerate(raw):
        h = ((h << 1) + gear[b]) & 0xFFFFFFFF
        n = i + 1 - at
        if i + 1 == len(raw) or n >= chunks.MIN_BYTES and (h >> 24 == 0 if n < chunks.TARGET_BYTES else h >> 27 == 0) or n == chunks.MAX_BYTES:
            ends.append(i + 1)
            at = i + 1
    return ends


def test_fingerprints_equal_a_rolling_loop():
    import random

    r = random.Random(4)
    texts = ["", "a", "x" * 700, *("".join(r.choice("abcdefgh é\n") for _ in range(r.randint(1, 3000))) for _ in range(12))]
    got = chunks.fingerprints(pa.array(texts, pa.string()))
    for text, own in zip(texts, got, strict=True):
        raw = text.encode()
        ends = plain_chunks(raw)
        parts = {raw[a:b] for a, b in zip([0, *ends], ends)}
        assert len(own) == len(parts) and sorted(int(x & 255) + 1 for x in own.tolist()) == sorted(len(p) for p in parts)
        assert chunks.weight(own) == sum(len(p) for p in parts)


def formatted(spark, records):
    df = spark.createDataFrame([(i, 0, json.dumps(x) if not isinstance(x, str) else x) for i, x in enumerate(records)], "conv_id long, n long, record string")
    rows = chat.format_records(df, "conv_id", "n", F.col("record"))
    out = {}
    for r in rows.orderBy("conv_id", "turn").collect():
        own = out.setdefault(r["conv_id"], [r["layout"]])
        own += [tuple(chat.unescape(x) for x in t) for t in chat._SEGMENT.findall(r["segment"] or "")]
    return [out[i] for i in range(len(records))], {r["conv_id"]: r for r in chat.read_back(rows).collect()}


def test_odd_layouts_have_defined_results(spark):
    deep = "[" * 100_000
    got, back = formatted(spark, [
        {"messages": ["hi", None, {"role": "user", "content": "x"}]},
        {"messages": []},
        {"messages": None},
        {"prompt": "p", "completion": "c", "response": "r"},
        {"messages": [{"role": "user", "content": "m"}], "prompt": "p"},
        {"messages": [{"role": "user", "content": [{"type": "text", "text": "a"}, {"type": "image", "url": "u"}, {"type": "text", "text": "b"}], "name": "n"}]},
        '{"prompt": "\\ud800x", "completion": "y"}',
        '{"messages": ' + deep,
        {"messages": [{"role": "user"}]},
        {"conversations": [{"from": "human", "value": 5}, {"from": "gpt", "value": {"k": [1]}}]},
    ])
    assert got[0] == ["messages", ("", "hi"), ("", ""), ("user", "x")]
    assert got[1] == ["messages"] and got[2][0] is None
    assert got[3] == ["prompt_completion", ("user", "p"), ("assistant", "c")]
    assert got[4] == ["messages", ("user", "m")]
    assert got[5] == ["messages", ("user", "ab")]
    assert got[6] == ["prompt_completion", ("user", "�x"), ("assistant", "y")]
    assert got[7] == [None] and got[8] == [None]
    assert got[9] == ["conversations", ("user", "5"), ("assistant", '{"k": [1]}')]
    assert len(back) == 10 and [back[i]["n_turns"] for i in (1, 7, 0)] == [0, 0, 3]


JSON = st.recursive(st.none() | st.booleans() | st.integers(-9, 9) | st.text(max_size=4), lambda x: st.lists(x, max_size=3) | st.dictionaries(st.sampled_from(["messages", "role", "content", "prompt", "completion", "conversations", "from", "value", "text", "x"]), x, max_size=3), max_leaves=9)


@settings(max_examples=300, deadline=None)
@given(JSON)
def test_any_record_has_turns_or_no_layout(value):
    known, table = chat.layout_table(chat.MAPPINGS)
    found = chat.layout_of(value, known, table, chat.MAPPINGS)
    if found:
        for role, text in chat.turns_of(value, found):
            segment, a, b = chat.render(role, text)
            segment.encode()
            assert chat._SEGMENT.fullmatch(segment) and chat.unescape(segment[a:b]) == text


def test_very_long_conversation_and_extra_columns(spark):
    rows = spark.range(3000).selectExpr("7L conv_id", "id n", "if(id % 2 = 0, 'user', 'assistant') role", "repeat('long ', 200) text", "'x' layout", "'y' segment")
    got = chat.read_back(chat.format_records(rows, "conv_id", "n", F.to_json(F.struct("role", "text")))).collect()
    assert [(r["conv_id"], r["n_turns"], r["loss_chars"]) for r in got] == [(7, 3000, 1500 * 1000)]
