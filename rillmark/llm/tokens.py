"""Document sizes in tokens of a public byte-level tokenizer, read from a vocabulary file on the executors."""

from __future__ import annotations

import base64
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame

VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
#: how the vocabulary's makers split text before merging; a fixed value
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

_LOADED: dict = {}


def encoder(path: str):
    """The tokenizer of a rank file, loaded once in a process."""
    if path not in _LOADED:
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _LOADED[path] = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _LOADED[path]


def count_tokens(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """``docs`` without ``text`` and with ``n_tokens``; a null or empty text has none. Whole texts are encoded; no shuffle."""
    keep = [c for c in docs.columns if c not in ("text", "n_tokens")]
    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep) + ", n_tokens long"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = encoder(vocabulary)
        for b in batches:
            yield b[keep].assign(n_tokens=[len(enc.encode_ordinary(t)) if isinstance(t, str) and t else 0 for t in b["text"]])

    return docs.mapInPandas(run, schema)
