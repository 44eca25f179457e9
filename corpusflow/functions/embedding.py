"""D1 embedding: a pluggable model run once per Python worker over Arrow batches.

The default model is deterministic feature hashing, so results can be
recomputed anywhere (also in plain SQL): lower-cased runs of letters and
digits; md5 of each token; the first 8 hex digits pick the bucket, the parity
of the 9th hex digit the sign; counts are L2-normalised (a text without tokens
gives the zero vector). A real model plugs in through ``register_model``: a
factory returning an object with ``embed(list[str]) -> np.ndarray``; it is
built once per worker process and reused for every batch.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from .constants import EMBED_BATCH

TOKEN_PATTERN = r"[\p{L}\p{N}]+"
#: Tokens that a worker remembers, and their length at most: its memory must not grow with the vocabulary.
CACHED, CACHED_CHARS = 1 << 16, 64
#: Micro-batches of texts whose vectors leave the worker together.
TOGETHER = 16


class HashingEmbedder:
    def __init__(self, dim: int = 64):
        import regex

        self.dim = dim
        self._tok = regex.compile(TOKEN_PATTERN)
        self._cache: dict[str, tuple[int, float]] = {}

    def _feature(self, tok: str) -> tuple[int, float]:
        f = self._cache.get(tok)
        if f is None:
            h = hashlib.md5(tok.encode("utf-8")).hexdigest()
            f = (int(h[:8], 16) % self.dim, 1.0 if int(h[8], 16) % 2 == 0 else -1.0)
            if len(self._cache) >= CACHED:
                self._cache.clear()
            if len(tok) <= CACHED_CHARS:
                self._cache[tok] = f
        return f

    def embed(self, texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), self.dim), dtype=np.float64)
        for r, t in enumerate(texts):
            if not t:
                continue
            for tok in self._tok.findall(t.lower()):
                b, s = self._feature(tok)
                out[r, b] += s
        norms = np.sqrt(np.sum(out * out, axis=1, keepdims=True))  # integer counts: exact
        np.divide(out, norms, out=out, where=norms > 0)
        return out.astype(np.float32)


_MODELS: dict[str, Callable[[], object]] = {}
_INSTANCES: dict[tuple[str, int], object] = {}  # per Python worker process


def register_model(name: str, factory: Callable[[], object]) -> None:
    """Make a model available to ``embed_col(model=name)``; the factory runs on workers."""
    _MODELS[name] = factory
    _embed_udf.cache_clear()


def _instance(name: str, dim: int, factory: Callable[[], object] | None):
    key = (name, dim)
    m = _INSTANCES.get(key)
    if m is None:
        m = HashingEmbedder(dim) if factory is None else factory()
        _INSTANCES[key] = m
    return m


@lru_cache(maxsize=None)
def _embed_udf(model: str, dim: int, batch: int):
    if model == "hashing":
        factory = None
    elif model in _MODELS:
        factory = _MODELS[model]  # travels with the UDF; built once per worker
    else:
        raise KeyError(f"embedding model {model!r} is not registered")

    @F.arrow_udf("array<float>")
    def embed(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        m = _instance(model, dim, factory)
        for texts in batches:
            for at in range(0, len(texts), batch * TOGETHER):
                values = texts.slice(at, batch * TOGETHER).to_pylist()
                parts = []
                for i in range(0, len(values), batch):  # W3: micro-batches of ``batch`` texts
                    parts.append(np.asarray(m.embed([v or "" for v in values[i : i + batch]]), dtype=np.float32))
                mat = np.vstack(parts)
                width = mat.shape[1] if mat.ndim == 2 else dim
                flat = pa.array(mat.reshape(-1), pa.float32())
                offsets = pa.array(np.arange(0, (len(values) + 1) * width, width, dtype=np.int32))
                yield pa.ListArray.from_arrays(offsets, flat)

    return embed


def embed_col(text: Column | str, model: str = "hashing", dim: int = 64, batch: int = EMBED_BATCH) -> Column:
    """Vector column for a text column. NULL text embeds as the empty string."""
    col = F.col(text) if isinstance(text, str) else text
    return _embed_udf(model, int(dim), int(batch))(col)


def embed_frame(df, text: str = "text", out: str = "vector", model: str = "hashing", dim: int = 64, batch: int = EMBED_BATCH):
    """D1 as a DataFrame operator: the vector column next to every row, computed
    in parallel over Arrow batches (the input is spread first if it sits in
    fewer partitions than task slots)."""
    from ..session import ensure_parallel

    return ensure_parallel(df).withColumn(out, embed_col(text, model, dim, batch))
