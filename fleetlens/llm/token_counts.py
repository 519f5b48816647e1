"""Token counts of whole texts: batch encoding in an Arrow function that returns lengths only.

Batches of a task are balanced by bytes, not rows. A text over ``SPLIT_BYTES`` is cut where no token can reach across (see
``_pieces``), so one long text costs as much as many short ones and the sum of the parts is the count of the whole.

Defined cases: null and empty texts have 0 bytes and 0 tokens; repeated rows are counted each; other columns are ignored,
whatever their names; an empty table gives an empty result. Special strings inside texts follow the library's default.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.llm.words import row_chunks, text_column

MODEL = "piece_bpe_32k.model"
LIMIT = 4096
# Bytes of one encoding call, and the size from which a text is cut.
BATCH_BYTES = 1 << 18
SPLIT_BYTES = 1 << 15

_SPACE = "▁"
# A space after something else that has text behind it.
_CUT = re.compile(f"[^ {_SPACE}] (?=.)", re.DOTALL)


@lru_cache(maxsize=4)
def _encoder(model: str):
    """The loaded tokenizer as a function ``texts -> lengths``, and whether texts may be cut before spaces."""
    import public_tokenizers

    path = public_tokenizers.path(model)
    if model.endswith(".json"):
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        return lambda texts: [len(e.ids) for e in tokenizer.encode_batch(texts, add_special_tokens=False)], False
    from sentencepiece import SentencePieceProcessor

    processor = SentencePieceProcessor(model_file=path)
    pieces = (processor.id_to_piece(i) for i in range(processor.get_piece_size()))
    # Tokens may start with spaces but never hold one after another character: then none crosses a cut.
    free = not any(_SPACE in piece.lstrip(_SPACE) for piece in pieces)
    begins = "".join(processor.encode(" a", out_type=str)) == _SPACE * 2 + "a"
    return lambda texts: [len(ids) for ids in processor.encode(texts, num_threads=1)], free and begins


def _pieces(text: str) -> Iterator[str]:
    """Parts of a long text whose counts add up. The space at a cut is left out: the encoder puts one before each text."""
    begin = 0
    while len(text) - begin > SPLIT_BYTES:
        cut = _CUT.search(text, begin + SPLIT_BYTES)
        if not cut:
            break
        yield text[begin:cut.end() - 1]
        begin = cut.end()
    yield text[begin:]


def count_texts(texts: list[str], model: str = MODEL) -> np.ndarray:
    encode, may_cut = _encoder(model)
    parts, owner = [], []
    for i, text in enumerate(texts):
        for part in _pieces(text) if may_cut and len(text) > SPLIT_BYTES else (text,):
            parts.append(part)
            owner.append(i)
    total = np.zeros(len(texts), np.int64)
    begin = 0
    while begin < len(parts):
        end, size = begin, 0
        while end < len(parts) and (end == begin or size + len(parts[end]) <= BATCH_BYTES):
            size += len(parts[end])
            end += 1
        np.add.at(total, owner[begin:end], encode(parts[begin:end]))
        begin = end
    return total


def count_tokens(docs: DataFrame, text: str = "text", key: str = "doc_id", model: str = MODEL,
                 limit: int = LIMIT) -> DataFrame:
    """One row per row of ``docs``: its key, ``n_bytes``, ``n_tokens`` and ``over_limit``."""
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))

    def measured(batches):
        for batch in batches:
            for part in row_chunks(batch, "text"):
                texts = text_column(part.column(1))
                sizes = pc.binary_length(texts).cast(pa.int64())
                counts = count_texts(texts.to_pylist(), model)
                yield pa.record_batch([part.column(0), sizes, pa.array(counts)], names=["doc_id", "n_bytes", "n_tokens"])

    counted = rows.mapInArrow(measured, "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > F.lit(limit))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(spark.read.parquet(f"{sf_dir}/documents.parquet"))
