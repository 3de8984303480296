"""Sorted hash arrays in the shared folder, written by tasks and memory-mapped by workers.

Keys are 64-bit hashes, dealt to shards by their top bits, so the shards in order are one sorted array. A task writes a shard under
another name and renames it, so a task that runs again after a lost executor leaves the same file. The folder must be mounted
on all machines (``file:``): only files can be mapped.
"""

from __future__ import annotations

import os
from urllib.parse import unquote, urlparse

import numpy as np
from pyspark.sql import SparkSession

from siltstone.sources.scratch import scratch_path, scratch_root


def is_mounted(spark: SparkSession) -> bool:
    """Whether the shared folder is one that workers can map files of."""
    return urlparse(scratch_root(spark)).scheme in ("", "file")


def array_folder(spark: SparkSession, label: str) -> str:
    url = urlparse(scratch_path(spark, label))
    if url.scheme not in ("", "file"):
        raise ValueError(f"memory-mapped arrays need a mounted spark.checkpoint.dir, not {url.scheme}:")
    folder = unquote(url.path)
    os.makedirs(folder, exist_ok=True)
    return folder


def write_array(folder: str, name: str, values: np.ndarray) -> None:
    path = f"{folder}/{name}.npy"
    partial = f"{path}.{os.getpid()}"
    with open(partial, "wb") as f:
        np.save(f, values)
    os.replace(partial, path)


def read_array(folder: str, name: str) -> np.ndarray:
    return np.load(f"{folder}/{name}.npy", mmap_mode="r")


def shard_of(keys: np.ndarray, bits: int) -> np.ndarray:
    return (keys >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)


class SortedHashes:
    """Look-up of keys in the shards ``name-0`` .. of a folder; ``sizes`` has the length of each."""

    def __init__(self, folder: str, name: str, bits: int, sizes: list[int]) -> None:
        self.folder, self.name, self.bits = folder, name, bits
        self.starts = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        self.shards: dict[int, np.ndarray] = {}

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Places in the whole array of ascending ``keys``, -1 where absent."""
        out = np.full(len(keys), -1, np.int64)
        bounds = np.searchsorted(shard_of(keys, self.bits), np.arange((1 << self.bits) + 1))
        for s in np.flatnonzero(np.diff(bounds)):
            if self.starts[s] == self.starts[s + 1]:
                continue
            if s not in self.shards:
                self.shards[s] = read_array(self.folder, f"{self.name}-{s}")
            known, own = self.shards[s], keys[bounds[s] : bounds[s + 1]]
            at = np.minimum(np.searchsorted(known, own), len(known) - 1)
            out[bounds[s] : bounds[s + 1]] = np.where(known[at] == own, at + self.starts[s], -1)
        return out

    def values(self, name: str, places: np.ndarray) -> np.ndarray:
        """Entries of the arrays ``name-0`` .. that go with the keys, at ascending places that exist."""
        if not len(places):
            return np.zeros(0, np.int64)
        bounds = np.searchsorted(places, self.starts)
        return np.concatenate([read_array(self.folder, f"{name}-{s}")[places[bounds[s] : bounds[s + 1]] - self.starts[s]] for s in np.flatnonzero(np.diff(bounds))])
