"""Packing by power-of-two decomposition.

A document of n tokens (its ids and the closing id) is cut, in order, into as many pieces of ``LENGTH`` tokens as it
holds and then into the powers of two of the rest, longest first. Every piece is a sequence by itself: no sequence
crosses documents and none needs padding. Pieces of one length share a bucket, from which batches of ``LENGTH``
tokens are filled: ``bucket`` and ``batch`` together name a batch of equal sequences. A batch is filled within one
task, whose number it carries, so no two tasks share one, and each task leaves at most one unfilled batch a bucket.

The ids are those of the tokenizer file. A text that holds only printable ASCII, line breaks, tabs and Latin letters
up to U+017F goes through the same vocabulary as ranks in tiktoken, which gives the same ids several times faster;
any other text goes through ``tokenizers`` itself.

Defined results: a null text counts as empty and is one piece of one token; repeated rows give repeated pieces, each
in a sequence of its own; an empty table gives no rows. The plan has no shuffle; a batch of texts is held at a time.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LENGTH = 2048
END = 1
TOKENIZER = "byte_bpe_50k.json"
RANKS = "byte_bpe_50k.tiktoken"
SAME = re.compile("[\\t\\n\\r\\x20-\\x7e\\u00c0-\\u00d6\\u00d8-\\u00f6\\u00f8-\\u017f]*")
FIELDS = (
    ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()),
    ("offset", pa.int64()), ("bucket", pa.int32()), ("batch", pa.int64()),
)
SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, offset long, bucket int, batch long"


class Encoder:
    """Ids of texts by the tokenizer file at ``path``; ``ranks`` is the same vocabulary for tiktoken."""

    def __init__(self, path: str, ranks: str | None, pattern: str | None) -> None:
        from tokenizers import Tokenizer

        self.exact = Tokenizer.from_file(path)
        self.fast = None
        if ranks:
            import tiktoken

            with open(ranks, "rb") as lines:
                merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            self.fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=merges, special_tokens={})

    def __call__(self, text: str) -> np.ndarray:
        if self.fast and "<|" not in text and SAME.fullmatch(text):
            return self.fast.encode_to_numpy(text, disallowed_special=()).astype("<u4", copy=False)
        return np.array(self.exact.encode(text, add_special_tokens=False).ids, dtype="<u4")


def public_encoder() -> Encoder:
    import public_tokenizers

    return Encoder(public_tokenizers.path(TOKENIZER), public_tokenizers.path(RANKS), public_tokenizers.PATTERN)


def pieces(n: int, length: int = LENGTH) -> list[int]:
    """Lengths of the pieces of a document of n tokens, in order."""
    rest = n % length
    return [length] * (n // length) + [1 << k for k in range(rest.bit_length() - 1, -1, -1) if rest >> k & 1]


def pack(docs: DataFrame, encoder=public_encoder, length: int = LENGTH, end: int = END) -> DataFrame:
    """One row per piece; ``encoder`` makes, on the executor, what turns a text into its ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, filled, task = encoder(), {}, TaskContext.get().partitionId() << 33
        for batch in batches:
            out: list[tuple] = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = np.append(encode(text.as_py() or ""), np.uint32(end)).astype("<u4")
                raw, at, n = memoryview(ids.tobytes()), 0, len(ids)
                for size in pieces(n, length):
                    before = filled.get(size, 0)
                    filled[size] = before + 1
                    out.append((doc, at, size, zlib.crc32(raw[4 * at : 4 * (at + size)]), n, 0, size.bit_length() - 1, task + before * size // length))
                    at += size
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*out) if out else [[]] * len(FIELDS), FIELDS)], names=[n for n, _ in FIELDS])

    cut = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, SCHEMA)
    return cut.withColumn("sequence_id", F.monotonically_increasing_id())
