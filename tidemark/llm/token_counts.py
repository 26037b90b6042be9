"""Tokens per document, counted once per distinct pre-token.

Pre-tokens are counted over the corpus, the vocabulary's library counts the pieces of
each distinct one, and the piece counts meet every document's pre-token frequencies:
the most frequent pre-tokens, a bounded number, through a broadcast table while the
text is read, all others through a join. No ids are made.
"""

from __future__ import annotations

from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frequencies import HEAD, distinct_words, summed
from .pretokens import Classes, Pretokens
from .store import by_text, column, stored, text_key


class Pieces:
    """A tokenizer file's pre-token splitter and piece counter, made once per process."""

    made: dict[int, Pieces] = {}

    def __init__(self, spec: str):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(spec)
        self.classes = Classes(self.tokenizer.pre_tokenizer.pre_tokenize_str)
        self.special = sorted((t.content for t in self.tokenizer.get_added_tokens_decoder().values()), key=len, reverse=True)

    @classmethod
    def of(cls, spec: str) -> Pieces:
        if hash(spec) not in cls.made:
            cls.made[hash(spec)] = cls(spec)
        return cls.made[hash(spec)]

    def split(self, texts: pa.Array) -> Pretokens:
        return Pretokens(texts, self.classes, self.special)

    def count(self, pretokens: list[str]) -> list[int]:
        return [len(e.ids) for e in self.tokenizer.encode_batch(pretokens, add_special_tokens=False)]


def count_tokens(docs: DataFrame, tokenizer: str, *, text: str = "text", limit: int | None = 1024, head: int = HEAD) -> DataFrame:
    """Documents with ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit`` (more than ``limit`` tokens).

    ``tokenizer`` is a file of the ``tokenizers`` library with the byte-level pattern.
    The counts are those of its ``encode`` on the whole text without special tokens
    added; a special token's string inside a text is that token, as by its default.

    Returns the input's columns and the three, which replace columns of the same name.
    Empty table: empty. Null and empty texts: 0 bytes and tokens. Repeated rows: each
    gets its text's counts. Long texts: whole, as a slice of their own.
    """
    spark = docs.sparkSession
    spec = spark.sparkContext.broadcast(Path(tokenizer).read_text(encoding="utf-8"))
    named = docs.select(text_key(column(text)).alias("key"), column(text).cast("string").alias("text"))

    def split(texts: pa.Array) -> Pretokens:
        return Pieces.of(spec.value).split(texts)

    def piece_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = Pieces.of(spec.value).count(batch.column("word").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("word"), batch.column("n"), pa.array(counts, pa.int64())], names=["word", "n", "pieces"])

    distinct = distinct_words(named.withColumn("chosen", F.lit(True)), split).select("word", "n")
    pretokens = stored(distinct.mapInArrow(piece_counts, "word string, n long, pieces long"), "pretokens")
    counts = summed(named, split, pretokens, ["pieces"], head).select("key", F.col("pieces").cast("long").alias("tokens"))
    size = F.coalesce(F.octet_length(F.col(f"in{docs.columns.index(text)}")), F.lit(0)).cast("long")
    over = F.col("tokens") > limit if limit is not None else F.lit(False)
    return by_text(docs, counts, text, n_bytes=size, n_tokens=F.col("tokens"), over_limit=over)
