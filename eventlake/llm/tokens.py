"""Token ids of whole texts by a public byte-level BPE vocabulary (problem 8), and token counts for packing.

Texts are cut into pre-tokens by the tokenizer's own pattern; a pre-token's ids come from a segment tree over the
ranks of its adjacent pairs: the root is the leftmost lowest-ranked merge, a merge updates three leaves, each in
logarithmic time, until no pair of the vocabulary remains. A worker keeps the ids of pre-tokens it has met in a
bounded table. Narrow transformation: nothing is shuffled, and only the id and text columns are read.
"""

from __future__ import annotations

import base64
import re
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

KEEP = 200_000  # pre-tokens a worker remembers
LONG = 2_000_000  # characters from which a text's pre-tokens are streamed
SHORT = 256  # longer pre-tokens are not remembered
# Fixed value: the pre-tokenizer pattern of the vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
NONE = 1 << 62


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def _ranges(test) -> str:
    out, start = [], None
    for c in range(0x10001):
        inside = c < 0x10000 and test(chr(c))
        if inside and start is None:
            start = c
        elif not inside and start is not None:
            out.append(f"\\u{start:04x}-\\u{c - 1:04x}")
            start = None
    return "".join(out)


@lru_cache(maxsize=1)
def _patterns():
    """The pattern for ASCII, for the basic plane (whose classes ``re`` keeps as bitmaps) and for all of Unicode; the classes of all three are those of ``regex``, so what else a text holds changes no word's ids."""
    bmp = [_ranges(regex.compile(c).match) for c in (r"\p{L}", r"\p{N}", r"\s")]
    plain = lambda l, n, s: re.compile(f"'(?:[stmd]|re|ve|ll)| ?[{l}]+| ?[{n}]+| ?[^{s}{l}{n}]+|[{s}]+(?![^{s}])|[{s}]+")  # noqa: E731,E741
    return plain("A-Za-z", "0-9", r" \t\n\v\f\r"), plain(*bmp), regex.compile(PATTERN)


class Ids(dict):
    """Pre-token -> tuple of ids, filled as pre-tokens are met."""

    def __init__(self, vocabulary: bytes):
        self.ranks = {base64.b64decode(t): int(r) for t, r in (line.split() for line in vocabulary.splitlines() if line)}

    def __missing__(self, piece: str) -> tuple[int, ...]:
        ids = merge(piece.encode("utf-8", "replace"), self.ranks)
        if len(piece) <= SHORT:
            if len(self) >= KEEP:
                self.clear()
            self[piece] = ids
        return ids


class Counts(Ids):
    def __missing__(self, piece: str) -> int:
        n = len(merge(piece.encode("utf-8", "replace"), self.ranks))
        if len(piece) <= SHORT:
            if len(self) >= KEEP:
                self.clear()
            self[piece] = n
        return n


def merge(piece: bytes, ranks: dict[bytes, int]) -> tuple[int, ...]:
    """Byte-pair encoding of one pre-token with a segment tree over the ranks of adjacent pairs."""
    n = len(piece)
    if n == 1:
        return (ranks[piece],)
    parts: list[bytes | None] = [piece[i : i + 1] for i in range(n)]
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    size = 1 << (n - 2).bit_length() if n > 2 else 1
    tree = [NONE] * (2 * size)
    for i in range(n - 1):
        r = ranks.get(piece[i : i + 2])
        if r is not None:
            tree[size + i] = r << 32 | i
    for i in range(size - 1, 0, -1):
        a, b = tree[2 * i], tree[2 * i + 1]
        tree[i] = a if a < b else b

    def put(i: int, value: int) -> None:
        i += size
        tree[i] = value
        i >>= 1
        while i:
            a, b = tree[2 * i], tree[2 * i + 1]
            low = a if a < b else b
            if tree[i] == low:
                break
            tree[i] = low
            i >>= 1

    while (best := tree[1]) != NONE:
        i = best & 0xFFFFFFFF
        j = after[i]
        parts[i] += parts[j]
        parts[j] = None
        after[i] = k = after[j]
        if j < n - 1:
            put(j, NONE)
        r = None
        if k < n:
            before[k] = i
            r = ranks.get(parts[i] + parts[k])
        put(i, NONE if r is None else r << 32 | i)
        p = before[i]
        if p >= 0:
            r = ranks.get(parts[p] + parts[i])
            put(p, NONE if r is None else r << 32 | p)
    return tuple(ranks[p] for p in parts if p is not None)


def pieces(text: str):
    ascii_, bmp, full = _patterns()
    p = ascii_ if text.isascii() else bmp if max(text) <= "￿" else full
    return p.findall(text) if len(text) < LONG else (m.group() for m in p.finditer(text))


def _vocabulary(df: DataFrame, path: str | None):
    with open(path or default_path(), "rb") as f:
        return df.sparkSession.sparkContext.broadcast(f.read())  # a vocabulary file, whatever the data's size


def encode(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """(id_col, ids) of every row: the token ids of the whole text, no special tokens; an empty list for empty and null texts.

    Rows are neither dropped nor merged, so repeated ids and texts come out as often as they go in; strings of special
    tokens in a text are ordinary text. An empty table gives no rows; other columns are ignored.
    """
    vocabulary = _vocabulary(df, path)

    def f(batches):
        table = Ids(vocabulary.value)
        get = table.__getitem__
        for b in batches:
            flat, ends = [], [0]
            for text in b.column(1).to_pylist():
                ids = np.fromiter(chain.from_iterable(map(get, pieces(text))), dtype=np.int32) if text else np.empty(0, np.int32)
                flat.append(ids)
                ends.append(ends[-1] + len(ids))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(flat) if flat else np.empty(0, np.int32)))], names=[id_col, "ids"])

    kind = df.schema[id_col].dataType.simpleString()
    return df.select(id_col, df[text_col].cast("string")).mapInArrow(f, f"`{id_col}` {kind}, ids array<int>")


def token_counts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """(id_col, n_tokens) of every row, 0 for empty and null texts; otherwise as :func:`encode`."""
    vocabulary = _vocabulary(df, path)

    def f(batches):
        get = Counts(vocabulary.value).__getitem__
        for b in batches:
            n = [sum(map(get, pieces(t))) if t else 0 for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64())], names=[id_col, "n_tokens"])

    kind = df.schema[id_col].dataType.simpleString()
    return df.select(id_col, df[text_col].cast("string")).mapInArrow(f, f"`{id_col}` {kind}, n_tokens long")
