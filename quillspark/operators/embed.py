"""Embedders as a protocol, a factory by name, and vectors of a table by Arrow batches.

An embedder is any object with ``provider``, ``model``, ``dimension`` and ``encode(texts)``. Workers build
theirs from a factory once, so a model is loaded once a worker and never travels. Only the
hashing embedder needs no model; others are registered by whoever has one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from typing import Protocol

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from quillspark.operators.store import EMBED_FORMAT


class Embedder(Protocol):
    provider: str
    model: str
    dimension: int

    def encode(self, texts: list[str]) -> np.ndarray:
        """(text, dimension) vectors."""


def hashed_bucket(token: str, dimension: int) -> int:
    """The bucket of a token: the last hex digits of its MD5; ``dimension`` is a power of two up to 4096."""
    return int(hashlib.md5(token.encode("utf-8")).hexdigest()[-3:], 16) & (dimension - 1)


class HashingEmbedder:
    """Counts of hashed blank-separated tokens, of unit length; texts without a token are zero."""

    provider, model = "hashing", "md5"

    def __init__(self, dimension: int = 512):
        self.dimension = dimension

    def encode(self, texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), self.dimension), dtype=np.float64)
        for row, text in zip(out, texts):
            for token in (text or "").lower().split():
                row[hashed_bucket(token, self.dimension)] += 1
        norms = np.linalg.norm(out, axis=1, keepdims=True)
        return np.divide(out, norms, out=out, where=norms > 0)


Factory = Callable[[], Embedder]
_FACTORIES: dict[str, Callable[..., Embedder]] = {"hashing": HashingEmbedder}


def register(name: str, factory: Callable[..., Embedder]) -> None:
    _FACTORIES[name] = factory


def factory(name: str, **options) -> Factory:
    """A factory for workers: what the registered one makes with these options."""
    if name not in _FACTORIES:
        raise ValueError(f"unknown embedder {name!r}; one of {', '.join(sorted(_FACTORIES))}")
    make = _FACTORIES[name]
    return lambda: make(**options)


def identity(embedder: Embedder) -> dict:
    """What an index says of its vectors, to be held against that of a query."""
    return {"provider": embedder.provider, "model": embedder.model, "dimension": int(embedder.dimension), "embed_format": EMBED_FORMAT}


def embedded(rows: DataFrame, make: Factory, text: str = "text", vector: str = "vector") -> DataFrame:
    """``rows`` without ``text`` and with its ``vector array<float>``; null texts count as empty."""
    keys = [c for c in rows.columns if c != text]
    schema = ", ".join(f"`{c}` {t}" for c, t in rows.dtypes if c != text) + f", `{vector}` array<float>"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        embedder = make()
        for pdf in filter(len, batches):
            yield pdf[keys].assign(**{vector: list(np.asarray(embedder.encode(["" if t is None else t for t in pdf[text]]), dtype=np.float32))})

    return rows.mapInPandas(run, schema)
