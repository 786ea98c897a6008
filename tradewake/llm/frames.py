"""Frames: columns under internal names, stored layers, and numpy helpers for Arrow batches."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tradewake.session import discard, freed, fresh_path, remove, store

__all__ = ["column", "discard", "freed", "fresh_path", "gathered", "lists", "remove", "store"]


def column(name: str) -> F.Column:
    """A column by its exact name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def gathered(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The runs ``flat[start:start + size]`` one after another."""
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return flat[np.repeat(starts - (ends - sizes), sizes) + np.arange(total)]


def lists(parts: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    """One Arrow list per numpy array, without a Python object per value."""
    offsets = np.zeros(len(parts) + 1, np.int32)
    np.cumsum([len(p) for p in parts], out=offsets[1:])
    flat = np.concatenate(parts) if parts else np.zeros(0)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, kind))


