"""Tokens of a byte-level BPE vocabulary: counts, ids and splits, in Arrow functions.

The default counter of the engine is a Column expression. This one is for limits that a model's own
vocabulary sets; it is given to ``process`` as ``count_tokens``.
"""

from __future__ import annotations

import base64
from collections.abc import Callable
from dataclasses import dataclass
from functools import cache

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

#: How a text is cut into words before they are merged; fixed for vocabularies of this kind.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@cache
def _encoding(path: str, pattern: str):
    """Once for each worker."""
    import tiktoken

    with open(path, "rb") as file:
        ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in file if line.strip())}
    return tiktoken.Encoding(path, pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


@dataclass(frozen=True)
class Vocabulary:
    """Ranks of a vocabulary, a file of lines "base64 rank" that every executor can read by this path.

    Null texts have no count and no ids. Strings of special tokens are ordinary text.
    """

    path: str
    pattern: str = PATTERN

    def _texts(self, kind: str, of: Callable[[list[int]], object]):
        path, pattern = self.path, self.pattern

        @F.arrow_udf(kind)
        def run(texts: pa.Array) -> pa.Array:
            encode = _encoding(path, pattern).encode_ordinary
            return pa.array([None if t is None else of(encode(t)) for t in texts.to_pylist()], _ARROW[kind])

        return run

    def __call__(self, text: Column) -> Column:
        return self._texts("long", len)(text)

    def each(self, texts: Column) -> Column:
        """The counts of an array's texts."""
        path, pattern = self.path, self.pattern

        @F.arrow_udf("array<long>")
        def run(lists: pa.Array) -> pa.Array:
            encode = _encoding(path, pattern).encode_ordinary
            return pa.array([None if x is None else [None if t is None else len(encode(t)) for t in x] for x in lists.to_pylist()], _ARROW["array<long>"])

        return run(texts)

    def encode(self, text: Column) -> Column:
        return self._texts("array<int>", list)(text)

    def decode(self, ids: Column) -> Column:
        """The text; bytes that are no UTF-8, as where ids were cut within a character, become U+FFFD."""
        path, pattern = self.path, self.pattern

        @F.arrow_udf("string")
        def run(lists: pa.Array) -> pa.Array:
            decode = _encoding(path, pattern).decode
            return pa.array([None if x is None else decode(x) for x in lists.to_pylist()], pa.string())

        return run(ids)

    def split(self, text: Column, size: int) -> Column:
        """The text of every ``size`` ids: a split that heeds nothing but length."""
        path, pattern = self.path, self.pattern

        @F.arrow_udf("array<string>")
        def run(texts: pa.Array) -> pa.Array:
            known = _encoding(path, pattern)
            out = []
            for t in texts.to_pylist():
                ids = [] if t is None else known.encode_ordinary(t)
                out.append(None if t is None else [known.decode(ids[i : i + size]) for i in range(0, len(ids), size)])
            return pa.array(out, pa.list_(pa.string()))

        return run(text)


_ARROW = {"long": pa.int64(), "array<int>": pa.list_(pa.int32()), "array<long>": pa.list_(pa.int64())}
