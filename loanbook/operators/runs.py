"""Shuffles of very many narrow rows: rows of one key that adjoin are packed into one row of arrays, and unpacked afterwards.

Whole numbers and days are kept less their place in the run, so those that count up are nearly constant and Spark's
compression leaves little of them. Rows in any order stay right; those that do not adjoin gain nothing.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_COUNTED = (T.IntegerType, T.LongType, T.DateType)


def _packer(keys: list[str], columns: list[str], counted: set[str]):
    """Function for mapInArrow."""

    def pack(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            new = np.zeros(batch.num_rows, bool)
            new[0] = True
            for k in keys:
                of = batch.column(k).dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
                new[1:] |= of[1:] != of[:-1]
            begins = np.flatnonzero(new)
            place = np.arange(batch.num_rows) - begins[np.cumsum(new) - 1]
            step, values = 1, {}
            for c in counted:
                values[c] = batch.column(c).fill_null(0).to_numpy(zero_copy_only=False)
                if values[c].min() < np.iinfo(values[c].dtype).min + batch.num_rows:  # no room below
                    step = 0
            ends = pa.array(np.append(begins, batch.num_rows), pa.int32())
            out = [batch.column(k).take(pa.array(begins)) for k in keys]
            out.append(pa.array(np.full(len(begins), step), pa.int32()))
            for c in columns:
                a = batch.column(c)
                if c in counted:
                    less = (values[c] - place * step).astype(values[c].dtype)
                    a = pa.array(less, a.type, mask=a.is_null().to_numpy(zero_copy_only=False))
                out.append(pa.ListArray.from_arrays(ends, a))
            yield pa.RecordBatch.from_arrays(out, names=[*keys, "_step", *columns])

    return pack


def packed(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row for each run of rows with equal keys in a batch: the keys, and the other columns as arrays (see unpacked)."""
    columns = [c for c in df.columns if c not in keys]
    kinds = {f.name: f.dataType for f in df.schema.fields}
    counted = {c for c in columns if isinstance(kinds[c], _COUNTED)}
    df = df.select(*keys, *[F.unix_date(c).alias(c) if isinstance(kinds[c], T.DateType) else F.col(c) for c in columns])
    schema = T.StructType([*[df.schema[k] for k in keys], T.StructField("_step", T.IntegerType()),
                           *[T.StructField(c, T.ArrayType(df.schema[c].dataType)) for c in columns]])
    return df.mapInArrow(_packer(keys, columns, counted), schema)


def unpacked(runs: DataFrame, like: DataFrame, columns: list[str]) -> DataFrame:
    """The rows of packed runs again, with what else the runs have. ``like``: the frame that was packed."""
    rows = runs.select(*[c for c in runs.columns if c not in columns], F.posexplode(F.arrays_zip(*columns)).alias("_place", "_row"))
    out = {}
    for c in columns:
        kind, value = like.schema[c].dataType, F.col(f"_row.{c}")
        if isinstance(kind, _COUNTED):
            value = value + F.col("_place") * F.col("_step")
        out[c] = F.date_from_unix_date(value) if isinstance(kind, T.DateType) else value
    return rows.withColumns(out).drop("_place", "_row", "_step")
