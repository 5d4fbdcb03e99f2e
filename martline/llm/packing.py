"""Packing documents into sequences along a space-filling curve.

Each document's tokens are hashed into buckets; the vector of bucket counts is
projected to few dimensions and its cell gets a Hilbert key.  The documents
are range-sorted by that key and laid end to end, so that neighbours in a
sequence are neighbours on the curve, and the stream is cut every ``capacity``
tokens: only the very last sequence can be short.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martline.llm.common import unpacked, with_text, written
from martline.llm.wordbpe import LibraryIds, default_vocabulary

#: Tokens of a full sequence, and the id that ends each document.
CAPACITY, END_ID = 4096, 2
#: Buckets of the hashed document vector, dimensions of its projection, bits of a coordinate.
BUCKETS, DIMENSIONS, BITS = 1024, 4, 12


def pack_documents(docs: DataFrame, text_col: str = "text", capacity: int = CAPACITY, end_id: int = END_ID,
                   vocabulary: str | None = None) -> DataFrame:
    """One row per piece: the input columns but the text, then ``start, length, ids, doc_tokens, sequence_id, offset``.

    ``ids`` holds the piece's token ids as little-endian unsigned 32-bit
    numbers.  Every id of a document, its final ``end_id`` included, lies in
    exactly one piece; a sequence is filled from offset 0 without gaps.  Null
    texts are packed as empty (one id).  Repeated rows are packed again; an
    empty table gives an empty result.  Input columns with a result's name
    are replaced.
    """
    return _packed(docs, text_col, capacity, end_id, vocabulary, digests=False)


def pack_digests(docs: DataFrame, text_col: str = "text", capacity: int = CAPACITY, end_id: int = END_ID,
                 vocabulary: str | None = None) -> DataFrame:
    """As ``pack_documents``, with the CRC-32 of each piece's ids (``ids_crc32``) in place of the ids."""
    return _packed(docs, text_col, capacity, end_id, vocabulary, digests=True)


def _packed(docs: DataFrame, text_col: str, capacity: int, end_id: int, vocabulary: str | None, digests: bool) -> DataFrame:
    path = vocabulary or default_vocabulary()

    @F.arrow_udf("struct<ids:binary,tokens:long,key:long>")
    def tokens(texts: pa.Array) -> pa.Array:
        cutter = LibraryIds.of(path)
        end = cutter.packed([end_id])
        ids = [cutter.encode(t) + end for t in texts.to_pylist()]
        sizes = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids)) // cutter.width
        return pa.StructArray.from_arrays([pa.array(ids, pa.binary()), pa.array(sizes), pa.array(curve_keys(ids, cutter.width))],
                                          names=["ids", "tokens", "key"])

    cut = written(with_text(docs, text_col, keep=False).select("_row", tokens("_text").alias("_cut"))
                  .select("_row", "_cut.*", F.monotonically_increasing_id().alias("_at")), "packing-tokens", "zstd")
    # The row number breaks ties, so that many copies at one key still spread over partitions.
    lined = cut.repartitionByRange("key", "_at").sortWithinPartitions("key", "_at")
    schema = T.StructType([*lined.schema, T.StructField("_part", T.IntegerType()), T.StructField("_before", T.LongType())])
    lined = written(lined.mapInArrow(_placed, schema), "packing-order", "zstd")
    # One row per partition of the range sort.
    before = lined.groupBy("_part").agg(F.sum("tokens").alias("_all")).select(
        "_part", F.coalesce(F.sum("_all").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)),
                            F.lit(0)).alias("_base"))
    fields = f"start:long,length:long,{'ids_crc32:long' if digests else 'ids:binary'},doc_tokens:long,sequence_id:long,offset:long"

    @F.arrow_udf(f"array<struct<{fields}>>")
    def pieces(ids: pa.Array, sizes: pa.Array, firsts: pa.Array) -> pa.Array:
        return pa.array([cut_pieces(x.as_py(), n, first, capacity, digests)
                         for x, n, first in zip(ids, sizes.to_pylist(), firsts.to_pylist())], type=_piece_type(digests))

    found = lined.join(F.broadcast(before), "_part").select(
        "_row", F.explode(pieces("ids", "tokens", F.col("_base") + F.col("_before"))).alias("_piece"))
    return unpacked(found, {f.name: F.col("_piece").getField(f.name) for f in found.schema["_piece"].dataType})


def cut_pieces(ids: bytes, tokens: int, first: int, capacity: int, digests: bool) -> list[dict]:
    """The pieces of a document whose first id stands at place ``first`` of the stream."""
    wide, found, start = np.frombuffer(ids, dtype=f"<u{len(ids) // tokens}").astype("<u4"), [], 0
    while start < tokens:
        sequence, offset = divmod(first + start, capacity)
        length = min(tokens - start, capacity - offset)
        own = wide[start:start + length].tobytes()
        found.append({"start": start, "length": length, **({"ids_crc32": zlib.crc32(own)} if digests else {"ids": own}),
                      "doc_tokens": tokens, "sequence_id": sequence, "offset": offset})
        start += length
    return found


def _piece_type(digests: bool) -> pa.DataType:
    long = pa.int64()
    return pa.list_(pa.struct([("start", long), ("length", long), ("ids_crc32", long) if digests else ("ids", pa.binary()),
                               ("doc_tokens", long), ("sequence_id", long), ("offset", long)]))


def _placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the partition's number and how many of its tokens come before each row."""
    part, before = TaskContext.get().partitionId(), 0
    for batch in batches:
        tokens = batch.column(batch.schema.get_field_index("tokens")).to_numpy(zero_copy_only=False)
        starts = before + np.concatenate(([0], np.cumsum(tokens)))
        before = int(starts[-1])
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(np.full(len(tokens), part, dtype=np.int32)), pa.array(starts[:-1].astype(np.int64))],
            names=[*batch.schema.names, "_part", "_before"])


def document_vector(ids: np.ndarray) -> np.ndarray:
    """Coordinates of a document: log counts of hashed tokens, normalised and projected."""
    bucket = (ids.astype(np.uint64) * np.uint64(2654435761) % np.uint64(1 << 32)) >> np.uint64(22)
    counts = np.log1p(np.bincount(bucket.astype(np.int64), minlength=BUCKETS))
    return counts @ _PROJECTION / np.linalg.norm(counts)


_PROJECTION = np.random.default_rng(1).standard_normal((BUCKETS, DIMENSIONS))


def curve_keys(ids: list[bytes], width: int) -> np.ndarray:
    """Hilbert key of each document's cell; ids are packed numbers of ``width`` bytes."""
    if not ids:
        return np.zeros(0, dtype=np.int64)
    points = np.stack([document_vector(np.frombuffer(x, dtype=f"<u{width}")) for x in ids])
    cells = np.floor((np.tanh(points) + 1) / 2 * (1 << BITS)).clip(0, (1 << BITS) - 1)
    return hilbert_key(cells.astype(np.int64), BITS)


def hilbert_key(cells: np.ndarray, bits: int) -> np.ndarray:
    """Position along the Hilbert curve of cells given as rows of coordinates below ``2**bits``.

    From the top bit down, each coordinate either inverts or swaps the lower
    bits of the first one; a Gray code over the coordinates then gives the key's digits.
    """
    x = [cells[:, d].copy() for d in range(cells.shape[1])]
    for bit in range(bits - 1, 0, -1):
        low = (1 << bit) - 1
        for d in range(len(x)):
            set_ = (x[d] >> bit) & 1 == 1
            swap = np.where(set_, 0, (x[0] ^ x[d]) & low)
            x[0] = np.where(set_, x[0] ^ low, x[0] ^ swap)
            x[d] = x[d] ^ swap if d else x[0]
    for d in range(1, len(x)):
        x[d] ^= x[d - 1]
    turn = np.zeros(len(cells), dtype=np.int64)
    for bit in range(bits - 1, 0, -1):
        turn ^= np.where((x[-1] >> bit) & 1 == 1, (1 << bit) - 1, 0)
    key = np.zeros(len(cells), dtype=np.int64)
    for bit in range(bits - 1, -1, -1):
        for d in range(len(x)):
            key = (key << 1) | (((x[d] ^ turn) >> bit) & 1)
    return key
