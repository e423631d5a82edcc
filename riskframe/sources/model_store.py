"""Versioned store for fitted models, scaler statistics and centroids.

A version is written completely before it is published, and publishing is one rename that fails if
the number is taken: readers see the last published version or an earlier one, never half of one,
and two writers get two versions. Every version names the columns it was fitted on; loading checks
them against those the caller has.
"""

from __future__ import annotations

import dataclasses
import importlib
import json
import uuid
from collections.abc import Callable, Sequence
from typing import Any

import numpy as np
from pyspark.sql import SparkSession

from riskframe.session import scratch_path

# Only classes of this package are made when a model is read.
PACKAGE = "riskframe."
_session_roots: dict[int, str] = {}


def to_plain(value: Any) -> Any:
    """Numbers, texts, lists and dicts that JSON can hold; dataclasses and arrays keep their kind."""
    if dataclasses.is_dataclass(value) and not isinstance(value, type):
        kind = type(value)
        fields = {f.name: to_plain(getattr(value, f.name)) for f in dataclasses.fields(value)}
        return {"__kind__": f"{kind.__module__}:{kind.__qualname__}", **fields}
    if isinstance(value, np.ndarray):
        return {"__array__": value.tolist(), "dtype": str(value.dtype)}
    if isinstance(value, np.generic):
        return value.item()
    if isinstance(value, dict):
        return {"__dict__": [[to_plain(k), to_plain(v)] for k, v in value.items()]}
    if isinstance(value, tuple):
        return {"__tuple__": [to_plain(v) for v in value]}
    if isinstance(value, list):
        return [to_plain(v) for v in value]
    return value


def from_plain(value: Any) -> Any:
    if isinstance(value, list):
        return [from_plain(v) for v in value]
    if not isinstance(value, dict):
        return value
    if "__array__" in value:
        return np.array(value["__array__"], value["dtype"])
    if "__dict__" in value:
        return {from_plain(k): from_plain(v) for k, v in value["__dict__"]}
    if "__tuple__" in value:
        return tuple(from_plain(v) for v in value["__tuple__"])
    module, _, name = value["__kind__"].partition(":")
    if not module.startswith(PACKAGE):
        raise ValueError(f"a stored model may not be of {module}")
    kind = getattr(importlib.import_module(module), name)
    if not dataclasses.is_dataclass(kind):
        raise ValueError(f"{value['__kind__']} is no model")
    return kind(**{k: from_plain(v) for k, v in value.items() if k != "__kind__"})


class SchemaMismatch(ValueError):
    """A stored model was fitted on other columns."""


class ModelStore:
    """Models below ``root``, a folder on any file system that Spark reaches."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _path(self, *parts: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path("/".join([self.root, *parts]))

    def _fs(self, path):
        return path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _write(self, path, text: str) -> None:
        out = self._fs(path).create(path, False)
        out.write(text.encode())
        out.close()

    def _read(self, path) -> Any:
        return json.loads("".join(r[0] for r in self.spark.read.text(path.toString(), wholetext=True).collect()))

    def versions(self, name: str) -> list[int]:
        """Published versions in order."""
        folder = self._path(name, "published")
        fs = self._fs(folder)
        if not fs.exists(folder):
            return []
        return sorted(int(s.getPath().getName()) for s in fs.listStatus(folder) if s.getPath().getName().isdigit())

    def save(self, name: str, model: Any, columns: Sequence[str]) -> int:
        """Publish a new version of a model; returns its number."""
        key = uuid.uuid4().hex
        self._write(self._path(name, "data", key), json.dumps({"columns": list(columns), "model": to_plain(model)}))
        context = self.spark.sparkContext
        files = context._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            self._path(name).toUri(), context._jsc.hadoopConfiguration()
        )
        plain = context._gateway.new_array(getattr(context._jvm, "org.apache.hadoop.fs.Options$Rename"), 0)
        self._fs(self._path(name, "published")).mkdirs(self._path(name, "published"))
        while True:
            number = max(self.versions(name), default=0) + 1
            waiting, target = self._path(name, "data", f"{key}-{number}"), self._path(name, "published", f"{number:09d}")
            self._write(waiting, json.dumps({"data": key}))
            try:
                files.rename(waiting, target, plain)
                return number
            except Exception as e:
                # Another writer took the number first.
                if "FileAlreadyExists" not in str(e):
                    raise

    def load(self, name: str, columns: Sequence[str], version: int | None = None) -> Any:
        """The last published version (or the given one); None if there is none."""
        known = self.versions(name)
        if version is None and not known:
            return None
        number = known[-1] if version is None else version
        key = self._read(self._path(name, "published", f"{number:09d}"))["data"]
        found = self._read(self._path(name, "data", key))
        if found["columns"] != list(columns):
            raise SchemaMismatch(f"{name} was fitted on {found['columns']}, not {list(columns)}")
        return from_plain(found["model"])

    def load_or_fit(self, name: str, columns: Sequence[str], fit: Callable[[], Any]) -> Any:
        """The stored model, or a new one that is stored before it is used."""
        model = self.load(name, columns)
        if model is None:
            model = fit()
            self.save(name, model, columns)
        return model


def session_store(spark: SparkSession) -> ModelStore:
    """A store in the shared folder that goes with the session's other intermediate data."""
    key = id(spark.sparkContext)
    if key not in _session_roots:
        _session_roots[key] = scratch_path(spark, "models")
    return ModelStore(spark, _session_roots[key])
