"""Sizes of texts in tokens of a public tokenizer. The vocabulary file is a parameter and stays where it is."""

from __future__ import annotations

import base64
import os
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: how this vocabulary splits a text before merging.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@lru_cache(maxsize=2)
def encoder(path: str):
    import tiktoken
    from pyspark import SparkFiles

    with open(path if os.path.exists(path) else SparkFiles.get(os.path.basename(path)), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def with_token_counts(df: DataFrame, text: str = "text", out: str = "n_tokens", path: str = DEFAULT_RANKS) -> DataFrame:
    """df with the number of tokens of the whole text; 0 for null and empty texts. The driver's vocabulary file goes to executors that lack it."""
    if os.path.exists(path):
        df.sparkSession.sparkContext.addFile(path)

    @F.pandas_udf("long")
    def count(texts: pd.Series) -> pd.Series:
        encode = encoder(path).encode_ordinary
        return pd.Series([len(encode(t)) if t else 0 for t in texts], dtype="int64")

    return df.withColumn(out, count(F.col(text)))
