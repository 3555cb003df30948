"""Documents dealt into blocks of bounded size, for work that needs a block at once.

A block holds the rows whose hashed id, or text where there is none, falls to it; the number of blocks
follows the bytes of text, so a block stays about as large however many there
are. Rows of one block travel as compressed Arrow streams.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from inspect import signature

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .rows import quoted
from .words import trim

#: Bytes of text gathered before streams are cut.
GATHERED = 1 << 23


@lru_cache(maxsize=1)
def _codec():
    import zstandard

    return zstandard.ZstdCompressor(level=3), zstandard.ZstdDecompressor()


def block_count(docs: DataFrame, block_bytes: int) -> int:
    """How many blocks of about ``block_bytes`` the texts need."""
    total = docs.agg(F.sum(F.octet_length("text")), F.count("*")).first()
    return max(1, -(-((total[0] or 0) + 64 * total[1]) // block_bytes))


def block_of(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks)).cast("long")


def packed(docs: DataFrame, blocks: int, columns: list[str]) -> DataFrame:
    """(block, stream): the columns of the rows of each block; a block has many streams.

    Rows with one id share a block, rows without an id those with one text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.nbytes
            if size >= GATHERED:
                yield _streams(held)
                held, size = [], 0
        if size:
            yield _streams(held)

    dealt = block_of(F.coalesce(F.col("doc_id").cast("long"), F.xxhash64("text")), blocks).alias("block")
    return docs.select(dealt, F.struct(*map(quoted, columns)).alias("row")).mapInArrow(run, "block long, stream binary")


def _streams(held: list[pa.RecordBatch]) -> pa.RecordBatch:
    table = pa.Table.from_batches(held).combine_chunks()
    block = table["block"].to_numpy()
    order = np.argsort(block, kind="stable")
    found, begins = np.unique(block[order], return_index=True)
    rows = pa.Table.from_struct_array(table["row"])
    streams = []
    for part in np.split(order, begins[1:]):
        sink = pa.BufferOutputStream()
        own = rows.take(pa.array(part)).combine_chunks()
        with pa.ipc.new_stream(sink, own.schema) as out:
            out.write_table(own)
        streams.append(_codec()[0].compress(sink.getvalue().to_pybytes()))
    return pa.RecordBatch.from_arrays([pa.array(found), pa.array(streams, pa.binary())], ["block", "stream"])


def tidied(function):
    """The same function of one or two tables; memory that it no longer uses goes back to the machine."""

    def done(out):
        trim()
        return out

    # Spark looks at how many tables a function takes.
    if len(signature(function).parameters) == 1:
        return lambda table: done(function(table))
    return lambda left, right: done(function(left, right))


def unpacked(streams: pa.ChunkedArray) -> pa.Table:
    """The rows of streams, ordered by id (null last) and text."""
    tables = []
    for stream in streams:
        with pa.ipc.open_stream(_codec()[1].decompress(stream.as_py())) as rows:
            tables.append(rows.read_all())
    table = pa.concat_tables(tables).combine_chunks()
    return table.take(pa.compute.sort_indices(table, [("doc_id", "ascending"), ("text", "ascending")]))
