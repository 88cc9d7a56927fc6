"""The replay of bursts holds one block at a time."""

import tracemalloc

import pyarrow as pa

from plumbline.operators.dedup import _FIELDS, _replay


def blocks(n, rows):
    """Blocks in which each second report doubles the one before it."""
    source = ("manual", "codegen")
    one = lambda b: [
        {"ms": b * 60_000 + i * 100, "uid": f"{b}-{i}", "source": source[i % 2], "params": f"{i // 2:064d}", "shape": None, "_context": False}
        for i in range(rows)
    ]
    pending = pa.list_(pa.struct([(f, pa.int64() if f == "ms" else pa.string()) for f in _FIELDS]))
    held = pa.list_(pa.struct([*((f, pa.int64() if f == "ms" else pa.string()) for f in _FIELDS), ("_context", pa.bool_())]))
    columns = [
        pa.array([{"client_id": "c", "event_name": "e", "island": 0}] * n),
        pa.array(range(n), pa.int64()),
        pa.concat_arrays([pa.array([one(b)], held) for b in range(n)]),
        pa.nulls(n, pending),
    ]
    return pa.RecordBatch.from_arrays(columns, names=["burst", "block", "rows", "entry"])


def test_a_batch_is_never_held_as_objects():
    """All blocks of a batch were, some ten times its bytes."""
    batch = blocks(300, 200)
    tracemalloc.start()
    (out,) = _replay(iter([batch]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    print(f"peak {peak / 1e6:.1f} MB for {batch.nbytes / 1e6:.1f} MB")
    assert peak < batch.nbytes
    assert out.column("doubles").to_pylist()[7] == [f"7-{i}" for i in range(1, 200, 2)]
