"""Sizes of texts in tokens of a public tokenizer."""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, functions as F

#: Where the vocabulary files lie and which is used; the file must be readable at this path on every executor.
TOKENIZER = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
# Fixed value: the pattern that splits text before the merges of the rank files.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


@lru_cache(maxsize=4)
def encoding(path: str):
    """The tokenizer of a rank file, once per worker."""
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("quillon", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def token_count(text: Column | str, path: str = TOKENIZER) -> Column:
    """Number of tokens of a text; null for null, 0 for an empty text."""

    @F.pandas_udf("int")
    def count(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encode = encoding(path).encode_ordinary
        for p in parts:
            yield p.map(lambda t: None if t is None else len(encode(t))).astype("Int32")

    return count(text)
