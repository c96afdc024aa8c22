"""Token counts with a public byte-level tokenizer (a rank file, never trained here)."""

from __future__ import annotations

import base64
import os
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Path of the rank file; it is a parameter and never copied into the repository.
DEFAULT_RANKS = os.environ.get("VOXLOOM_TOKEN_RANKS", "/opt/tokenizers/byte_bpe_multi_50k.tiktoken")
#: Words with their leading blank, numbers, runs of signs, runs of white space.
PRE_SPLIT = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


@lru_cache(maxsize=4)
def encoding(path: str):
    """The tokenizer of a rank file, loaded once per Python worker."""
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
    return tiktoken.Encoding("ranks", pat_str=PRE_SPLIT, mergeable_ranks=ranks, special_tokens={})


def token_count(text: Column, path: str = DEFAULT_RANKS) -> Column:
    """Number of tokens of a text; null counts 0."""

    @F.pandas_udf("int")
    def count(texts: pd.Series) -> pd.Series:
        enc = encoding(path)
        return pd.Series([len(enc.encode_ordinary(t)) for t in texts], dtype="int32")

    return F.when(F.coalesce(F.length(text), F.lit(0)) == 0, F.lit(0)).otherwise(count(F.coalesce(text, F.lit(""))))
