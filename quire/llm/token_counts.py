"""Token counts of texts without token ids.

A worker cuts each batch of texts into pre-tokens, counts the pieces of every distinct pre-token once (and remembers
them for later batches), joins these counts to the batch's table of (text, pre-token, frequency) and sums. That join
stays inside the task: as a Spark join over all documents the frequency table has about two rows for three words of
the corpus, several times the input in shuffled bytes.

Cases: a null text counts as empty and has 0 tokens and 0 bytes; a null id stays null; repeated rows give repeated
rows; an empty table gives an empty result; texts of any length are counted whole; columns beside id and text are
ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from quire.llm import common
from quire.llm import kernels as K
from quire.llm.tokenizing import PieceCounts, load

SCHEMA = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"


def sentencepiece_counts(path: str):
    """Counter for a .model file: the library counts whole texts, as its pieces cross white space."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)

    class Counts:
        def count(self, column: pa.Array) -> np.ndarray:
            return np.array([len(x) for x in model.encode([t or "" for t in column.to_pylist()], num_threads=1)], np.int64)

    return Counts()


def token_counts(docs: DataFrame, tokenizer: str, limit: int = 512, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens and over_limit (n_tokens > limit) of every row."""
    common.bounded_batches(common.session(docs))
    schema = common.struct(SCHEMA)
    kind = sentencepiece_counts if tokenizer.endswith(".model") else PieceCounts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter, out = load(kind, tokenizer), common.arrow_schema(schema)
        for b in common.slices(batches, 4 << 20):
            n = counter.count(b.column("text"))
            _, at = K.buffer_of(b.column("text"))
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(np.diff(at)), pa.array(n), pa.array(n > limit)], schema=out)

    return common.texts_of(docs, id_col, text_col).mapInArrow(common.tidied(run), schema)
