"""Token counts: an exact histogram of encoded lengths and its suffix sums.

Documents are encoded with a public byte-level vocabulary, counted, and aggregated by length; all
later answers (totals, quantiles, totals under truncation at a context limit) come from suffix sums
over the lengths.

Defined results: a null or empty text has length 0; strings that look like special tokens are
ordinary text; null and repeated ids count each; texts of any length are encoded whole, and runs of
blanks too long for the library's pattern apart; an empty table gives an empty histogram; further columns
don't matter, whatever their names.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from citygrain.session import staged

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"

#: The published pattern of that vocabulary (a fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Runs of blanks, as Unicode has them, that the library's pattern matcher has no stack for.
LONG_RUN = re.compile(r"[^\S\x1c-\x1f]{100000,}")

#: Lengths per block of the two-level suffix sums.
BLOCK = 1024


def read_ranks(path: str = VOCABULARY) -> dict[bytes, int]:
    """Token bytes to id, from a file of base64 tokens and ids."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


def text_length(encoding, text: str) -> int:
    """Tokens of a whole text under ``PATTERN``.

    The pattern takes a run of blanks as one piece, less its last blank where a word follows. So a long
    run is cut off there, and merged without the pattern.
    """
    length = done = 0
    for run in LONG_RUN.finditer(text):
        end = run.end() if run.end() == len(text) else run.end() - 1
        length += len(encoding.encode_ordinary(text[done : run.start()])) + len(encoding._encode_single_piece(text[run.start() : end].encode()))
        done = end
    return length + len(encoding.encode_ordinary(text[done:] if done else text))


def token_counts(docs: DataFrame, path: str = VOCABULARY, pattern: str = PATTERN) -> DataFrame:
    """``doc_id`` and ``n_tokens`` of every whole text.

    The vocabulary, under 1 MB, is read on the driver and broadcast.
    """
    ranks = docs.sparkSession.sparkContext.broadcast(read_ranks(path))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import tiktoken

        encoding = tiktoken.Encoding("counts", pat_str=pattern, mergeable_ranks=ranks.value, special_tokens={})
        for batch in batches:
            lengths = np.zeros(batch.num_rows, dtype=np.int64)
            for row, text in enumerate(batch.column("text")):
                own = text.as_py() or ""
                lengths[row] = text_length(encoding, own) if pattern == PATTERN else len(encoding.encode_ordinary(own))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(lengths)], ["doc_id", "n_tokens"])

    return docs.select("doc_id", "text").mapInArrow(counted, "doc_id long, n_tokens long")


def length_histogram(counts: DataFrame) -> DataFrame:
    """One row per length that occurs, with suffix sums.

    n_tokens, docs (of this length), docs_longer, tokens_total (of all documents), docs_total,
    truncated_total (tokens left when every document is cut at this length) and reached (share of
    documents of this length or less). Sums run over blocks of lengths first and inside blocks then,
    so no task sees every length.
    """
    lengths = staged(counts.groupBy("n_tokens").agg(F.count(F.lit(1)).alias("docs")), "lengths")
    lengths = lengths.withColumn("_block", F.floor(F.col("n_tokens") / BLOCK))
    blocks = lengths.groupBy("_block").agg(F.sum("docs").alias("_docs"), F.sum(F.col("docs") * F.col("n_tokens")).alias("_tokens"))
    everything = Window.partitionBy()
    later = Window.orderBy("_block").rowsBetween(1, Window.unboundedFollowing)
    blocks = blocks.select(
        "_block",
        F.coalesce(F.sum("_docs").over(later), F.lit(0)).alias("_docs_later"),
        F.coalesce(F.sum("_tokens").over(later), F.lit(0)).alias("_tokens_later"),
        F.sum("_docs").over(everything).alias("docs_total"),
        F.sum("_tokens").over(everything).alias("tokens_total"),
    )
    longer = Window.partitionBy("_block").orderBy("n_tokens").rowsBetween(1, Window.unboundedFollowing)
    joined = lengths.join(blocks, "_block").withColumns(
        {
            "docs_longer": F.col("_docs_later") + F.coalesce(F.sum("docs").over(longer), F.lit(0)),
            "_tokens_longer": F.col("_tokens_later") + F.coalesce(F.sum(F.col("docs") * F.col("n_tokens")).over(longer), F.lit(0)),
        }
    )
    return joined.select(
        "n_tokens",
        "docs",
        "docs_longer",
        "docs_total",
        "tokens_total",
        (F.col("tokens_total") - F.col("_tokens_longer") + F.col("n_tokens") * F.col("docs_longer")).alias("truncated_total"),
        ((F.col("docs_total") - F.col("docs_longer")) / F.col("docs_total")).alias("reached"),
    )


def truncated_total(histogram: DataFrame, limit: int) -> DataFrame:
    """Tokens left when every document is cut at ``limit``, for any limit, as one row."""
    kept = F.sum(F.least(F.col("n_tokens"), F.lit(limit)) * F.col("docs"))
    return histogram.agg(F.coalesce(kept, F.lit(0)).alias("truncated_total"))


def quantile(histogram: DataFrame, share: float) -> DataFrame:
    """Smallest length that at least ``share`` of the documents don't exceed, as one row (null if none)."""
    return histogram.where(F.col("reached") >= share).agg(F.min("n_tokens").alias("n_tokens"))
