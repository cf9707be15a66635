"""Tokens attributed to the sections of a document through character offsets.

A whole document is encoded once. Token and section spans are both sorted byte
intervals of the same text, so they are joined by binary search. A token that crosses
a boundary belongs to the section in which it starts; the line break that ends a
section is part of it. So the counts of a document's sections add up to its tokens.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourgrid.llm.bpe import VOCABULARY, pieces, ranks
from hourgrid.llm.common import byte_texts, present, small_batches


def _encoding() -> tuple[tiktoken.Encoding, np.ndarray]:
    own = tiktoken.Encoding(
        "own",
        pat_str=public_tokenizers.PATTERN,
        mergeable_ranks=ranks(VOCABULARY),
        special_tokens={},
    )
    return own, np.array([len(piece) for piece in pieces(VOCABULARY)], dtype=np.int64)


def attribute(token_bytes: np.ndarray, sections: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Tokens that start in each section, and of these the ones that end beyond it.

    ``sections`` holds the byte at which each section starts, the first being 0.
    """
    ends = np.cumsum(token_bytes)
    starts = ends - token_bytes
    home = np.searchsorted(sections, starts, side="right") - 1
    last = np.searchsorted(sections, ends - 1, side="right") - 1
    n = len(sections)
    return np.bincount(home, minlength=n), np.bincount(home[last > home], minlength=n)


def _count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    own, lengths = _encoding()
    for part in parts:
        rows, numbers, starts, counts, crossing = [], [], [], [], []
        for row, text in enumerate(byte_texts(part.column("text"))):
            ids = np.array(own.encode_ordinary(text.decode()), dtype=np.int64)
            breaks = np.flatnonzero(np.frombuffer(text, dtype=np.uint8) == 10) + 1
            begin = np.r_[0, breaks[breaks < len(text)]]
            held, cross = attribute(lengths[ids], begin)
            rows.append(np.full(len(begin), row))
            numbers.append(np.arange(len(begin)))
            starts.append(begin)
            counts.append(held)
            crossing.append(cross)
        if rows:
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id").take(pa.array(np.concatenate(rows))),
                    *(
                        pa.array(np.concatenate(x).astype(np.int64))
                        for x in (numbers, starts, counts, crossing)
                    ),
                ],
                names=["doc_id", "section", "first_byte", "n_tokens", "n_crossing"],
            )


def section_tokens(docs: DataFrame, text: str = "text") -> DataFrame:
    """One row per line of a document: doc_id, section, first_byte, n_tokens, n_crossing.

    A null or empty text has one section without tokens. Repeated rows give repeated
    rows, an empty table gives none, and other columns are not looked at.
    """
    small_batches(docs.sparkSession)
    return docs.select("doc_id", present(F.col(text)).cast("binary").alias("text")).mapInArrow(
        _count,
        "doc_id bigint, section bigint, first_byte bigint, n_tokens bigint, n_crossing bigint",
    )
