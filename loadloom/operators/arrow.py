"""Named Python functions and model wrappers on Arrow batches.

For what SQL cannot express: the body takes and returns whole Arrow arrays, never single rows. Arguments are typed and bound to
columns by name; a model is loaded once per Python worker, not per batch, and stays there for later tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadloom.operators.columns import unused

#: Models of this worker process, by what they were loaded from. A worker serves one task at a time.
_LOADED: dict[tuple, Any] = {}
MODELS_KEPT = 4


@dataclass(frozen=True)
class ArrowFunction:
    """A named scalar function over Arrow arrays, usable from ``bind`` and, once created, from SQL by its name.

    ``body`` gets one array per argument, in the declared types, and returns an array of as many values. NULLs reach it as such.
    """

    name: str
    arguments: Mapping[str, str]
    returns: str
    body: Callable[..., pa.Array]

    def _function(self):
        body, wanted, name = self.body, pa_type(self.returns), self.name

        def run(*arrays: pa.Array) -> pa.Array:
            out = body(*arrays)
            out = out.combine_chunks() if isinstance(out, pa.ChunkedArray) else out
            return out if out.type == wanted else out.cast(wanted)

        run.__name__ = name
        return F.arrow_udf(run, self.returns)

    def create(self, spark: SparkSession) -> ArrowFunction:
        """Makes the function known to SQL for the session."""
        spark.udf.register(self.name, self._function())
        return self

    def bind(self, bindings: Mapping[str, str]) -> Column:
        """The call, each argument bound to a column by name and cast to its declared type."""
        lacking = set(self.arguments) - set(bindings)
        if lacking:
            raise ValueError(f"{self.name}: no column bound to {sorted(lacking)}")
        return self._function()(*[F.col(bindings[a]).cast(t) for a, t in self.arguments.items()])


def pa_type(ddl: str) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(T.StructType.fromDDL(f"x {ddl}")["x"].dataType)


@dataclass(frozen=True)
class ModelWrapper:
    """M6 for a model that is not Spark's: typed inputs bound by name, ``outputs`` predictions per row.

    ``load`` gets ``source`` (a path that executors can read, or the parameters themselves) and runs once per worker; ``predict``
    gets the model and a column of inputs as one Arrow array each, and returns one array per output.
    """

    name: str
    source: str
    load: Callable[[str], Any]
    predict: Callable[[Any, Mapping[str, pa.Array]], Sequence[pa.Array]]
    inputs: Mapping[str, str]
    outputs: Sequence[str]

    def score(self, df: DataFrame, bindings: Mapping[str, str] | None = None) -> DataFrame:
        """The frame with a DOUBLE column per output. Inputs are the columns of their names unless ``bindings`` says otherwise."""
        bound = {a: (bindings or {}).get(a, a) for a in self.inputs}
        wrapper, names = self, list(self.inputs)
        kind = pa.struct([(o, pa.float64()) for o in self.outputs])

        def run(inputs: pa.Array) -> pa.Array:
            model = loaded(wrapper.source, wrapper.load)
            found = wrapper.predict(model, {n: inputs.field(i) for i, n in enumerate(names)})
            return pa.StructArray.from_arrays([a.cast(pa.float64()) for a in found], fields=list(kind))

        call = F.arrow_udf(run, "struct<" + ",".join(f"`{o}`:double" for o in self.outputs) + ">")
        packed = F.struct(*[F.col(bound[a]).cast(t).alias(a) for a, t in self.inputs.items()])
        both = unused("_scored", df)
        scored = df.withColumn(both, call(packed))
        return scored.select(*df.columns, *[F.col(both)[o].alias(o) for o in self.outputs])


def loaded(source: str, load: Callable[[str], Any]) -> Any:
    """The model, kept in the worker; the one longest kept goes when there are ``MODELS_KEPT``."""
    key = (source, load.__module__, load.__qualname__)
    if key not in _LOADED:
        while len(_LOADED) >= MODELS_KEPT:
            _LOADED.pop(next(iter(_LOADED)))
        _LOADED[key] = load(source)
    return _LOADED[key]
