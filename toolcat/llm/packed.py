"""Small tables as one binary value, compressed; rows of them are shuffled and stored like any other."""

from __future__ import annotations

import pyarrow as pa

_HOW = pa.ipc.IpcWriteOptions(compression="zstd")


def pack(**columns) -> bytes:
    sink = pa.BufferOutputStream()
    batch = pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns.values()], names=list(columns))
    with pa.ipc.new_stream(sink, batch.schema, options=_HOW) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def unpack(data) -> dict[str, pa.Array]:
    with pa.ipc.open_stream(data if isinstance(data, bytes) else data.as_buffer()) as found:
        batch = found.read_next_batch()
    return dict(zip(batch.schema.names, batch.columns, strict=True))
