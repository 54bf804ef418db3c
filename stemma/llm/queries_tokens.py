"""Queries over token ids: files, byte-level BPE and packing."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stemma.llm import byte_bpe, huffman, packing
from stemma.llm.common import read
from stemma.llm.word_ids import token_ids
from stemma.session import scratch_root


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place, size and checksum, read back from Huffman-coded files."""
    path = f"{scratch_root(spark)}/token-files-{uuid.uuid4().hex}"
    huffman.write(token_ids(read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json")), path)
    found = huffman.read_ids(spark, path)
    return found.select("doc_id", "start", (F.length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Checksums of every document's byte-level BPE ids and of what they decode to."""
    found = byte_bpe.round_trip(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return found.select("doc_id", (F.length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 2048 tokens."""
    return digest(packing.pack(token_ids(read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))))


def digest(pieces: DataFrame) -> DataFrame:
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


QUERIES = {f.__name__: f for f in (op1_token_files, op5_byte_bpe, op10_packing)}
ORACLES: dict[str, str] = {}
