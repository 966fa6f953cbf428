"""Arrow files in the shared folder, one per shard, that tasks look up.

A shard is one Arrow stream file of a single batch.  A task writes it under a
name of its own and moves it to its final name, so a task that runs twice
replaces whole files by equal ones.  Python workers keep the shards read last,
up to ``CACHE_BYTES``; a shard that has left the cache is read again.
"""

from __future__ import annotations

import uuid
from collections import OrderedDict
from collections.abc import Callable

import pyarrow as pa
from pyarrow import fs

#: Bytes of shards that a Python worker holds (one shard at least).
CACHE_BYTES = 128 << 20

_cache: OrderedDict = OrderedDict()


def make_folder(folder: str) -> None:
    own, root = fs.FileSystem.from_uri(folder)
    own.create_dir(root, recursive=True)


def write_shard(folder: str, shard: int, batch: pa.RecordBatch) -> None:
    own, root = fs.FileSystem.from_uri(folder)
    aside = f"{root}/.{uuid.uuid4().hex}"
    with own.open_output_stream(aside) as out, pa.ipc.new_stream(out, batch.schema) as writer:
        writer.write_batch(batch)
    own.move(aside, f"{root}/{shard:06d}.arrows")


def read_shard(folder: str, shard: int, load: Callable[[pa.RecordBatch], object]):
    """What ``load`` makes of a shard, from the worker's cache where it is there."""
    key = (folder, shard)
    if key not in _cache:
        own, root = fs.FileSystem.from_uri(folder)
        with own.open_input_stream(f"{root}/{shard:06d}.arrows") as f:
            batch = pa.ipc.open_stream(f).read_next_batch()
        held = sum(n for _, n in _cache.values())
        while _cache and held + batch.nbytes > CACHE_BYTES:
            held -= _cache.popitem(last=False)[1][1]
        _cache[key] = load(batch), batch.nbytes
    _cache.move_to_end(key)
    return _cache[key][0]
