"""A public byte-level vocabulary, read on the driver and sent to the tasks."""

from __future__ import annotations

import base64

from pyspark import Broadcast
from pyspark.sql import SparkSession

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
PIECES = 50_256
#: The published split of this vocabulary (fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def ranks(path: str = VOCABULARY) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, lines)}


def sent(spark: SparkSession, path: str = VOCABULARY) -> Broadcast:
    """The vocabulary (50,256 pieces, a fixed size) for the tasks."""
    return spark.sparkContext.broadcast(ranks(path))


def encoding(table: dict[bytes, int]):
    import tiktoken

    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=table, special_tokens={})
