"""Token counts by rank-synchronous array merging (see ``bpe.RankMerger``).

Null and empty texts have no tokens. Repeated rows are counted each. Very long texts are cut where
white space begins, so memory stays bounded. Extra columns are ignored; rows keep no order. An empty
table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from . import bpe
from .common import from_texts, steps


def count_tokens(df: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text", limit: int = 512) -> DataFrame:
    """One row for each row of ``df``: id, UTF-8 bytes, tokens, and whether there are over ``limit``."""

    def run(batches):
        tokenizer = bpe.loaded(path, "merge")
        for batch in steps(batches):
            text = batch.column(1)
            n = tokenizer.counts(text.to_pylist())
            size = pc.fill_null(pc.binary_length(text), 0).cast(pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), size, pa.array(n), pa.array(np.greater(n, limit))], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return from_texts(df, run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean", id_column, text_column)
