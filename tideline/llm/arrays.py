"""Sorted arrays in the shared folder, memory-mapped by workers; and blobs of them for shuffles.

Tasks write one file per shard under a name of its own and move it into place, so a task
that runs again after a lost executor leaves the same file. The shared folder must be
mounted on all machines: object stores can't be mapped into memory.
"""

from __future__ import annotations

import os
import uuid
from urllib.parse import urlparse

import numpy as np
import zstandard
from pyspark.sql import SparkSession

from tideline.session import fresh_path, owned


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the shared one, as a path that open() takes."""
    uri = urlparse(owned(fresh_path(spark, name)))
    if uri.scheme not in ("", "file"):
        raise ValueError(f"memory-mapped arrays need a mounted shared folder, not {uri.scheme}://")
    os.makedirs(uri.path, exist_ok=True)
    return uri.path


def save(folder: str, name: str, array: np.ndarray) -> None:
    partial = f"{folder}/.{name}.{uuid.uuid4().hex}.npy"
    np.save(partial, array)
    os.replace(partial, f"{folder}/{name}.npy")


def load(folder: str, name: str, kind: str) -> np.ndarray:
    """The mapped array; an absent file is an empty array, as shards without rows write none."""
    path = f"{folder}/{name}.npy"
    if not os.path.exists(path):
        return np.zeros(0, kind)
    found = np.load(path, mmap_mode="r")
    return found if len(found) else np.zeros(0, kind)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit numbers; different numbers stay different."""
    x = x.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def unmix(x: np.ndarray) -> np.ndarray:
    """What mix() made x of."""
    def inverse(c):
        return np.uint64(pow(c, -1, 1 << 64))

    x = (x ^ (x >> np.uint64(31)) ^ (x >> np.uint64(62))) * inverse(0x94D049BB133111EB)
    x = (x ^ (x >> np.uint64(27)) ^ (x >> np.uint64(54))) * inverse(0xBF58476D1CE4E5B9)
    return (x ^ (x >> np.uint64(30)) ^ (x >> np.uint64(60))) - np.uint64(0x9E3779B97F4A7C15)


def shard_of(hashes: np.ndarray, shards: int) -> np.ndarray:
    """Equal ranges of the hash space, in order."""
    return ((hashes >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)


def packed(array: np.ndarray) -> bytes:
    """Compressed bytes of integers; sorted ones come as differences, a byte plane at a time."""
    values = np.asarray(array).astype(np.uint64)
    steps = np.diff(values, prepend=np.uint64(0))
    planes = np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T)
    return zstandard.compress(planes.tobytes(), 1)


def unpacked(blob: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(blob), np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).ravel(), dtype=np.uint64)


def added(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct keys in order, with the sums of their values."""
    if not len(keys):
        return (keys, *values)
    order = np.argsort(keys)
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return (keys[first], *(np.add.reduceat(v[order], first) for v in values))


class Sharded:
    """A sorted array over all shards, for lookups of many keys at once.

    Values of the keys are mapped when they are first asked for, as they may be written later.
    """

    def __init__(self, folder: str, name: str, shards: int):
        self.folder, self.shards = folder, shards
        self.keys = [load(folder, f"{name}.{s}", "u8") for s in range(shards)]
        self.values: dict[str, list[np.ndarray]] = {}
        self.base = np.concatenate([[0], np.cumsum([len(k) for k in self.keys])])

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The number of each hash in the whole array, or -1."""
        out = np.full(len(hashes), -1, np.int64)
        order = np.argsort(hashes)
        ordered = hashes[order]
        edges = np.searchsorted(shard_of(ordered, self.shards), np.arange(self.shards + 1))
        for s in range(self.shards):
            a, b = edges[s], edges[s + 1]
            if a == b or not len(self.keys[s]):
                continue
            at = np.minimum(np.searchsorted(self.keys[s], ordered[a:b]), len(self.keys[s]) - 1)
            hit = self.keys[s][at] == ordered[a:b]
            out[order[a:b]] = np.where(hit, at + self.base[s], -1)
        return out

    def take(self, name: str, numbers: np.ndarray) -> np.ndarray:
        """Values of known numbers."""
        if name not in self.values:
            self.values[name] = [load(self.folder, f"{name}.{s}", "i8") for s in range(self.shards)]
        parts = self.values[name]
        out = np.zeros(len(numbers), np.int64)
        order = np.argsort(numbers)
        edges = np.searchsorted(numbers[order], self.base)
        for s in range(self.shards):
            a, b = edges[s], edges[s + 1]
            if a < b:
                out[order[a:b]] = parts[s][numbers[order[a:b]] - self.base[s]]
        return out
