"""Byte-level BPE over whole Arrow batches.

Text is split by the public byte-level pattern with array operations, every distinct
piece is tokenised once for each worker, and a batch's ids are gathered with one index.
Rows with characters outside the classes told apart here, or with a special token's
string, go to the tokenizers library as they are.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from larkspur.llm.text_arrays import _CODES, span_hashes, text_slices

_SPACE, _LETTER, _DIGIT, _OTHER, _UNKNOWN = 0, 1, 2, 3, 4
_CLASS = np.full(256, _OTHER, np.uint8)
_CLASS[[0x20, *range(0x09, 0x0E)]] = _SPACE
_CLASS[0x30:0x3A] = _DIGIT
_CLASS[0x41:0x5B] = _LETTER
_CLASS[0x61:0x7B] = _LETTER
_CLASS[0x1C:0x20] = _UNKNOWN
_CLASS[0x80:0xC0] = _LETTER  # continuation bytes of the leads below
_CLASS[0xC0:] = _UNKNOWN
_CLASS[[0xC3, 0xC4, 0xC5]] = _LETTER  # U+00C0 to U+017F, all letters but the two signs below
_SIGNS = (0x97, 0xB7)  # after 0xC3
_TAILS = (b"s", b"t", b"re", b"ve", b"m", b"ll", b"d")


def split_pieces(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the pieces, and which texts hold something this split does not know."""
    n = len(data)
    kind = _CLASS[data]
    odd = kind == _UNKNOWN
    odd[1:] |= (data[:-1] == 0xC3) & ((data[1:] == _SIGNS[0]) | (data[1:] == _SIGNS[1]))
    odd_rows = np.unique(np.searchsorted(offsets, np.flatnonzero(odd), "right") - 1)
    first = np.zeros(n + 1, bool)
    first[offsets] = True
    first = first[:n]
    last = np.zeros(n + 1, bool)
    last[offsets[1:][offsets[1:] > 0] - 1] = True
    last = last[:n]
    before = np.empty(n, np.uint8)
    before[1:] = kind[:-1]
    before[first] = 9
    after = np.empty(n, np.uint8)
    after[:-1] = kind[1:]
    after[last] = _SPACE  # nothing follows: white space stays whole
    space = kind == _SPACE
    lone = np.empty(n, bool)  # is the byte before a plain space that joins this piece?
    lone[1:] = data[:-1] == 0x20
    lone[first] = False
    start = first | (space & (before != _SPACE)) | (space & (after != _SPACE))
    start |= ~space & (before == _SPACE) & ~lone
    start |= ~space & (before != _SPACE) & (before != kind)
    for p in np.flatnonzero((data == 0x27) & start & (after == _LETTER)):
        end = offsets[np.searchsorted(offsets, p, "right")]
        rest = data[p + 1 : min(p + 3, end)].tobytes()
        for tail in _TAILS:
            if rest.startswith(tail):
                at = p + 1 + len(tail)
                start[p + 1 : at] = False
                if at < end and kind[at] != _SPACE:
                    start[at] = True
                break
    return np.flatnonzero(start), odd_rows


def is_plain_byte_bpe(spec: dict) -> bool:
    """Whether a tokenizers file works as this module does: no normaliser, the byte-level split with its usual pattern and no
    space put before a text, and BPE by merges whose order is that of the ids."""
    split, model = spec.get("pre_tokenizer") or {}, spec.get("model") or {}
    if spec.get("normalizer") is not None or split.get("type") != "ByteLevel" or split.get("add_prefix_space") or not split.get("use_regex", True):
        return False
    if model.get("type", "BPE") != "BPE" or any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")):
        return False
    vocab = model["vocab"]
    made = [vocab.get("".join(m) if isinstance(m, list) else m.replace(" ", "")) for m in model["merges"]]
    plain = all(x.get("single_word") is not True and not x.get("lstrip") and not x.get("rstrip") for x in spec.get("added_tokens", []))
    return plain and None not in made and all(a < b for a, b in zip(made, made[1:], strict=False))


class ByteBpe:
    """Ids of a tokenizers file of the byte-level kind, with a bounded memory of pieces."""

    MEMORY = 200_000
    _loaded: dict[str, ByteBpe] = {}

    def __init__(self, path: str) -> None:
        import tiktoken

        self.path = path
        self._whole = None
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.known_kind = is_plain_byte_bpe(spec)
        if not self.known_kind:  # every text goes to the tokenizers library
            return
        self.special = [x["content"].encode() for x in spec.get("added_tokens", [])]
        added = {x["content"] for x in spec.get("added_tokens", [])}
        visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        char = {chr(b): b for b in visible}
        char |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(visible))}
        ranks = {bytes(char[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in added}
        self.core = tiktoken.Encoding("file", pat_str=r".+", mergeable_ranks=ranks, special_tokens={})._core_bpe
        self._reset()

    @property
    def whole(self):  # noqa: ANN201
        """The tokenizers library's tokenizer, loaded for the first row that needs it."""
        if self._whole is None:
            from tokenizers import Tokenizer

            self._whole = Tokenizer.from_file(self.path)
        return self._whole

    def _reset(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.at = np.zeros(0, np.int64)
        self.length = np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.uint32)

    @classmethod
    def load(cls, path: str) -> ByteBpe:
        if path not in cls._loaded:
            cls._loaded[path] = cls(path)
        return cls._loaded[path]

    def _learn(self, keys: np.ndarray, pieces: list[bytes]) -> None:
        ids = [self.core.encode_single_piece(x) for x in pieces]
        length = np.array([len(x) for x in ids], np.int64)
        flat = np.fromiter((i for x in ids for i in x), np.uint32, int(length.sum()))
        if len(self.keys) + len(keys) > self.MEMORY:
            self._reset()
        at = np.concatenate([self.at, len(self.flat) + np.cumsum(length) - length])
        all_keys, all_len = np.concatenate([self.keys, keys]), np.concatenate([self.length, length])
        order = np.argsort(all_keys, kind="stable")
        self.keys, self.at, self.length = all_keys[order], at[order], all_len[order]
        self.flat = np.concatenate([self.flat, flat])

    def _ids(self, data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids in order, and how many each piece has."""
        ends = np.append(starts[1:], len(data))
        keys, which = np.unique(span_hashes(_CODES[data], starts, ends), return_inverse=True)
        where = np.searchsorted(self.keys, keys)
        new = np.ones(len(keys), bool)
        inside = where < len(self.keys)
        new[inside] = self.keys[where[inside]] != keys[inside]
        if new.any():
            example = np.empty(len(keys), np.int64)
            example[which] = np.arange(len(starts))
            if len(self.keys) + int(new.sum()) > self.MEMORY:  # start again with this batch's pieces
                self._reset()
                new[:] = True
            raw = data.tobytes()
            self._learn(keys[new], [raw[starts[i] : ends[i]] for i in example[new]])
            where = np.searchsorted(self.keys, keys)
        at, length = self.at[where][which], self.length[where][which]
        total = np.cumsum(length)
        index = np.repeat(at - (total - length), length) + np.arange(total[-1] if len(total) else 0)
        return self.flat[index], length

    def encode_column(self, column: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
        """(row, ids) of every text; null counts as empty."""
        if not self.known_kind:
            for row, text in enumerate(column.to_pylist()):
                yield row, np.array(self.whole.encode(text or "", add_special_tokens=False).ids, np.uint32)
            return
        for low, high, data, offsets in text_slices(column):
            if not len(data):
                for row in range(low, high):
                    yield row, np.zeros(0, np.uint32)
                continue
            starts, odd = split_pieces(data, offsets)
            raw = data.tobytes()
            strange = set(odd.tolist())
            for special in self.special:
                p = raw.find(special)
                while p >= 0:
                    strange.add(int(np.searchsorted(offsets, p, "right")) - 1)
                    p = raw.find(special, p + 1)
            ids, length = self._ids(data, starts)
            ends = np.append(0, np.cumsum(length))
            edges = ends[np.searchsorted(starts, offsets)]
            for i in range(high - low):
                if i in strange:
                    whole = self.whole.encode(raw[offsets[i] : offsets[i + 1]].decode(), add_special_tokens=False)
                    yield low + i, np.array(whole.ids, np.uint32)
                else:
                    yield low + i, ids[edges[i] : edges[i + 1]]
