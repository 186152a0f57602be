import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from larkspur.llm.bpe import ByteBpe
from larkspur.llm.queries import tokenizer_path


@pytest.fixture(scope="module")
def bpe():
    return ByteBpe(tokenizer_path())


PARTS = ["a", "Bc", " ", "  ", "\n", "'s", "'", "'ll", "'re ", "9", "12", ".", "$$", "é", "ß", "×", "“", " ", "中", "<|endoftext|>", "\x1f", "_", "don't", "\t", "!'s", "'t'd"]


@settings(max_examples=150, deadline=None)
@given(texts=st.lists(st.lists(st.sampled_from(PARTS), max_size=12).map("".join), max_size=6))
def test_ids_equal_the_library(bpe, texts):
    got = [ids.tolist() for _, ids in bpe.encode_column(pa.array([*texts, None], pa.string()))]
    assert got == [bpe.whole.encode(t, add_special_tokens=False).ids for t in [*texts, ""]]


def test_memory_is_bounded(bpe, monkeypatch):
    monkeypatch.setattr(ByteBpe, "MEMORY", 50)
    for k in range(5):
        texts = [f"word{k}x{i} other" for i in range(40)]
        got = [ids.tolist() for _, ids in bpe.encode_column(pa.array(texts))]
        assert got == [bpe.whole.encode(t, add_special_tokens=False).ids for t in texts]
