"""Problem 7: ids of every text under a public byte-level BPE vocabulary."""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import spread
from .batches import pieces
from .bpe import worker_encoder

#: Where the vocabulary files lie; a parameter of every operator that needs one.
TOKENIZERS = os.environ.get("QUIRESPARK_TOKENIZERS", "/opt/tokenizers")
VOCABULARY = "byte_bpe_50k.tiktoken"
#: Texts that are expanded to ids at once; bounds the memory of a worker.
SLICE = 512


def rank_file(spark, tokenizers: str = TOKENIZERS, vocabulary: str = VOCABULARY):
    """Broadcast of the rank file: about half a megabyte, whatever the corpus."""
    with open(os.path.join(tokenizers, vocabulary), "rb") as f:
        return spark.sparkContext.broadcast(f.read())


def encode(df: DataFrame, key: str = "doc_id", text: str = "text", tokenizers: str = TOKENIZERS, vocabulary: str = VOCABULARY) -> DataFrame:
    """``key`` and ``ids`` (array of int) of each row, without special tokens.

    NULL and empty texts give an empty list; strings that look like special
    tokens are ordinary text; rows are neither dropped nor merged, so repeated
    rows and NULL keys stay; other columns are not read.  Map only: no shuffle, unless a
    small table has fewer partitions than there are cores.
    """
    ranks = rank_file(df.sparkSession, tokenizers, vocabulary)
    source = spread(df.select(F.col(key), F.col(text).alias("__text")))
    kind = source.schema[0].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(ranks.value)
        for batch in batches:
            for part in pieces(batch, (1,), SLICE):
                ids, counts = encoder.encode_batch([t or "" for t in part.column(1).to_pylist()])
                offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays([part.column(0), lists], [key, "ids"])

    return source.mapInArrow(run, f"`{key}` {kind}, ids array<int>")
