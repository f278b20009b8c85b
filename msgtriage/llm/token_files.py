"""Token counts from flat token files by scanning for separators.

A token file is nothing but little-endian 16- or 32-bit token ids, each document ended by an
end-of-document id; it has no index. :func:`scan` cuts files into blocks that tasks read on
their own, finds the separators of a block with one vectorised comparison, and stitches
the documents that cross block borders with a prefix scan over the blocks of each file:
a running count of separators numbers the documents, a running maximum of the last
separator's position gives the start of the one that a block ends.

:func:`write` makes such files from texts with a public byte-pair vocabulary, together
with a stored list (file, place in the file, ``doc_id``) of what it wrote. Files go to the
shared folder by address through ``pyarrow.fs`` under names of their own; the list is written by
Spark's committed write, so only files of tasks that succeeded are read.

Defined results: a null or empty text is a document of 0 tokens; repeated rows and null ids
stay rows of their own; an empty file has no documents; tokens after a file's last
separator are one more document with ``complete`` false. Texts are encoded whole: beyond
``CUT_CHARS`` characters they are handed over in parts, cut before a space that follows and
precedes a letter (where the vocabulary's pattern cuts too); a stretch without any such place
is handed over whole, whatever its length.
"""

from __future__ import annotations

import base64
import re
import uuid
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from msgtriage.session import materialize, scratch_path

PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
CUT_CHARS = 50_000
FILE_TOKENS = 1 << 27
BLOCK_TOKENS = 1 << 20
_CUT = re.compile(r"(?<=[^\W\d_]) (?=[^\W\d_])")


def read_ranks(path: str) -> dict[bytes, int]:
    """Merge ranks of a public byte-pair vocabulary; read on the driver only."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f)}


class Encoder:
    """Byte-pair encoder whose ids end below ``separator``; one per worker process."""

    kept: "tuple[str, Encoder] | None" = None

    def __init__(self, ranks: dict[bytes, int], pattern: str, key: str = ""):
        import tiktoken

        self.encoding = tiktoken.Encoding("token_files", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    @classmethod
    def of(cls, shared) -> "Encoder":
        key = shared.value[2]  # made anew for every vocabulary sent
        if cls.kept is None or cls.kept[0] != key:
            cls.kept = (key, cls(*shared.value))
        return cls.kept[1]

    def encode(self, text: str) -> Iterator[np.ndarray]:
        at = 0
        while len(text) - at > CUT_CHARS and (place := _CUT.search(text, at + CUT_CHARS)):
            yield self.encoding.encode_to_numpy(text[at : place.start()], disallowed_special=())
            at = place.start()
        yield self.encoding.encode_to_numpy(text[at:], disallowed_special=())


def _write(batches: Iterator[pa.RecordBatch], shared, folder: str, separator: int, kind: str) -> Iterator[pa.RecordBatch]:
    encoder = Encoder.of(shared)
    system, root = fs.FileSystem.from_uri(folder)
    out, path, tokens, place = None, "", 0, 0
    for batch in batches:
        for lo in range(0, len(batch), 1000):
            part = batch.slice(lo, 1000)
            paths, places = [], []
            for text in part.column("text").to_pylist():
                if out is None or tokens > FILE_TOKENS:
                    if out is not None:
                        out.close()
                    name = f"{uuid.uuid4().hex}.bin"
                    out, path, tokens, place = system.open_output_stream(f"{root}/{name}", compression=None), f"{folder}/{name}", 0, 0
                for ids in encoder.encode(text or ""):
                    out.write(ids.astype(kind).tobytes())
                    tokens += len(ids)
                out.write(np.array([separator], kind).tobytes())
                tokens += 1
                paths.append(path)
                places.append(place)
                place += 1
            yield pa.record_batch({"path": pa.array(paths), "place": pa.array(places, pa.int64()), "doc_id": part.column("doc_id").cast(pa.int64())})
    if out is not None:
        out.close()


def write(docs: DataFrame, ranks: dict[bytes, int], separator: int, folder: str | None = None, kind: str = "<u2", pattern: str = PATTERN) -> DataFrame:
    """Encode all texts into token files; returns the stored list ``path, place, doc_id``."""
    if separator >= 1 << (8 * np.dtype(kind).itemsize) or max(ranks.values(), default=-1) >= separator:
        raise ValueError("the separator must be above all token ids and fit the file's integers")
    spark = docs.sparkSession
    folder = folder or scratch_path(spark, "tokens")
    folder = folder if "://" in folder or folder.startswith("file:") else f"file://{folder}"
    system, root = fs.FileSystem.from_uri(folder)
    system.create_dir(root, recursive=True)
    shared = spark.sparkContext.broadcast((ranks, pattern, uuid.uuid4().hex))
    rows = docs.select("doc_id", "text").mapInArrow(partial(_write, shared=shared, folder=folder, separator=separator, kind=kind), "path string, place long, doc_id long")
    return materialize(rows, "token-list")


def _blocks(batches: Iterator[pa.RecordBatch], kind: str, block_tokens: int) -> Iterator[pa.RecordBatch]:
    """The blocks of each file, from its length."""
    width = np.dtype(kind).itemsize
    for batch in batches:
        for path in batch.column("path").to_pylist():
            system, name = fs.FileSystem.from_uri(path)
            size = system.get_file_info(name).size
            if size % width:
                raise ValueError(f"{path} does not hold whole tokens")
            first = np.arange(0, size // width, block_tokens, dtype=np.int64)
            yield pa.record_batch({"path": pa.array([path] * len(first), pa.string()), "first": pa.array(first), "tokens": pa.array(np.minimum(block_tokens, size // width - first))})


def _separators(batches: Iterator[pa.RecordBatch], separator: int, kind: str) -> Iterator[pa.RecordBatch]:
    width = np.dtype(kind).itemsize
    for batch in batches:
        for row in batch.to_pylist():
            system, name = fs.FileSystem.from_uri(row["path"])
            with system.open_input_file(name) as f:
                f.seek(row["first"] * width)
                ids = np.frombuffer(f.read(row["tokens"] * width), kind)
            at = row["first"] + np.flatnonzero(ids == separator)
            yield pa.record_batch({"path": [row["path"]], "first": [row["first"]], "tokens": [row["tokens"]], "at": pa.array([at], pa.list_(pa.int64()))})


def scan(files: DataFrame, separator: int, kind: str = "<u2", block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Per document of the files (column ``path``): ``path, place, n_tokens, complete``."""
    spark = files.sparkSession
    blocks = files.select("path").mapInArrow(partial(_blocks, kind=kind, block_tokens=block_tokens), "path string, first long, tokens long")
    spread = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    found = blocks.repartition(spread, "path", "first").mapInArrow(partial(_separators, separator=separator, kind=kind), "path string, first long, tokens long, at array<long>")
    found = materialize(found, "separators")
    before = Window.partitionBy("path").orderBy("first").rowsBetween(Window.unboundedPreceding, -1)
    narrow = found.select("path", "first", F.size("at").alias("n"), F.when(F.size("at") > 0, F.element_at("at", -1)).alias("last"), "tokens")
    scanned = narrow.select(
        "path", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"), F.coalesce(F.max("last").over(before), F.lit(-1)).alias("carry"),
    )
    # each separator ends the document that begins after the one before it
    ends = found.select("path", "first", "at").join(scanned, ["path", "first"])
    size = F.expr("transform(at, (x, k) -> x - if(k > 0, at[k - 1], carry) - 1)")
    ends = ends.select("path", "offset", F.posexplode(size).alias("k", "n_tokens"))
    whole = ends.select("path", (F.col("offset") + F.col("k")).alias("place"), "n_tokens", F.lit(True).alias("complete"))
    tail = narrow.groupBy("path").agg(F.sum("n").alias("place"), (F.sum("tokens") - F.coalesce(F.max("last"), F.lit(-1)) - 1).alias("n_tokens")).where("n_tokens > 0")
    return whole.union(tail.select("path", "place", "n_tokens", F.lit(False)))


def count_tokens(docs: DataFrame, ranks: dict[bytes, int], separator: int) -> DataFrame:
    """``doc_id, n_tokens`` of each document: written to token files and counted there."""
    listed = write(docs, ranks, separator)
    counts = scan(listed.select("path").distinct(), separator)
    return listed.join(counts, ["path", "place"]).select("doc_id", "n_tokens")
