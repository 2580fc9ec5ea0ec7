"""Texts packed in batches of bounded size, so that a batch can ask the whole corpus for something and get answers back."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame

from islet.llm.common import keep, keep_bucketed


def _packed(size: int):
    """(id, ..., text) -> batches of about ``size`` bytes of text: their ids, and the other columns packed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = 0

        def bundle(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
            nonlocal made
            made += 1
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, pa.schema(list(rows[0].schema)[1:]), options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                for r in rows:
                    out.write_batch(r.select(r.schema.names[1:]))
            ids = pa.concat_arrays([r.column(0) for r in rows])
            ids = pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids)
            return pa.RecordBatch.from_arrays([pa.array([(TaskContext.get().partitionId() << 32) + made]), ids, pa.array([sink.getvalue().to_pybytes()], pa.binary())], ["batch", "ids", "texts"])

        rows, held = [], 0
        for batch in batches:
            ends = np.cumsum(pc.binary_length(batch.column(batch.num_columns - 1)).to_numpy(zero_copy_only=False).astype(np.int64) + 64)
            at = 0
            while at < batch.num_rows:
                done = int(ends[at - 1]) if at else 0
                upto = min(batch.num_rows, int(np.searchsorted(ends, done + size - held)) + 1)
                rows.append(batch.slice(at, upto - at))
                held += int(ends[upto - 1]) - done
                at = upto
                if held >= size:
                    yield bundle(rows)
                    rows, held = [], 0
        if rows:
            yield bundle(rows)

    return run


def bundles(df: DataFrame, size: int, buckets: int = 0) -> DataFrame:
    """(id, ..., text) -> (batch, ids, texts), written once: what ``opened`` gives back is the columns after the id.

    With ``buckets`` the table is bucketed by batch, so what is cogrouped with it by batch comes to it and texts never move again.
    """
    kind = df.schema[0].dataType.simpleString()
    made = df.mapInArrow(_packed(size), f"batch long, ids array<{kind}>, texts binary")
    return keep_bucketed(made, "batch", buckets) if buckets else keep(made)


def opened(texts: bytes) -> pa.Table:
    return pa.ipc.open_stream(texts).read_all().combine_chunks()
