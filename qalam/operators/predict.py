"""User functions over Arrow batches: generic batch maps and a batched predictor harness.

The model itself is out of scope; a predictor is any picklable factory returning a callable
``list[str] -> list[str]``. It is built once per Python worker and reused across tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import types as Ty

from qalam.operators.batch import assign_batches

_PREDICTORS: dict[bytes, Callable[[list[str]], list[str]]] = {}


def map_batches(df: DataFrame, fn: Callable, schema: Ty.StructType | str) -> DataFrame:
    """Apply ``fn(pandas.DataFrame) -> pandas.DataFrame`` to every Arrow batch."""
    from qalam.session import ship_package

    ship_package(df.sparkSession)

    def run(batches: Iterator):
        for pdf in batches:
            yield fn(pdf)

    return df.mapInPandas(run, schema)


def _predictor(factory) -> Callable[[list[str]], list[str]]:
    key = cloudpickle.dumps(factory)
    p = _PREDICTORS.get(key)
    if p is None:
        p = factory()
        _PREDICTORS[key] = p
    return p


def batch_predict(
    df: DataFrame,
    factory: Callable[[], Callable[[list[str]], list[str]]],
    batch_size: int = 24,
    src_col: str = "source_text",
    out_col: str = "prediction",
    order_col: str = "row_id",
) -> DataFrame:
    """Run a predictor over the batches of ``batch_size`` rows in ``order_col`` order (ids must not repeat);
    predictions are stripped.

    The batches are those of the whole table, whatever its partitions and Arrow batches: a predictor whose
    answers depend on a text's neighbours (padding, say) gives the same ones on any cluster. Rows keep all
    input columns, so references and directions stay aligned without a join."""
    batched = assign_batches(df, batch_size, [order_col], batch_col="_batch").withColumnRenamed("pos", "_at")
    return predict_in_batches(batched, factory, ["_batch"], "_at", src_col, out_col).drop("_batch", "_at")


def predict_in_batches(
    df: DataFrame,
    factory: Callable[[], Callable[[list[str]], list[str]]],
    batch_cols: list[str],
    order_col: str,
    src_col: str = "source_text",
    out_col: str = "prediction",
) -> DataFrame:
    """Run a predictor once for each group of equal ``batch_cols``, its rows in ``order_col`` order. A group
    is whole in its task; one that an Arrow batch cuts is held until its last row has come."""
    from qalam.session import ship_package

    ship_package(df.sparkSession)
    schema = Ty.StructType(df.schema.fields + [Ty.StructField(out_col, Ty.StringType())])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        predict, held = _predictor(factory), None

        def predicted(rows: pd.DataFrame) -> pd.DataFrame:
            new = (rows[batch_cols] != rows[batch_cols].shift()).any(axis=1).to_numpy()
            starts = [*np.flatnonzero(new).tolist(), len(rows)]
            texts, out = rows[src_col].astype(str).tolist(), []
            for start, end in zip(starts, starts[1:], strict=False):
                out.extend(str(o).strip() for o in predict(texts[start:end]))
            return rows.assign(**{out_col: out})

        for rows in batches:
            rows = rows if held is None else pd.concat([held, rows], ignore_index=True)
            if not len(rows):
                continue
            last = (rows[batch_cols] == rows[batch_cols].iloc[-1]).all(axis=1).to_numpy()
            cut = len(rows) - int(last.sum())
            if cut:
                yield predicted(rows.iloc[:cut])
            held = rows.iloc[cut:].reset_index(drop=True)
        if held is not None and len(held):
            yield predicted(held)

    dealt = df.repartition(*batch_cols).sortWithinPartitions(*batch_cols, order_col)
    return dealt.mapInPandas(run, schema)


class CopySourcePredictor:
    """Stand-in model: returns the source text without its direction tag."""

    def __call__(self):
        def predict(batch: list[str]) -> list[str]:
            return [t[6:] if t.startswith(("<2ar> ", "<2en> ")) else t for t in batch]

        return predict


class DictionaryPredictor:
    """Stand-in model: word-by-word lookup in a small dictionary (unknown words copied)."""

    def __init__(self, table: dict[str, str]):
        self.table = dict(table)

    def __call__(self):
        table = self.table

        def predict(batch: list[str]) -> list[str]:
            out = []
            for t in batch:
                body = t[6:] if t.startswith(("<2ar> ", "<2en> ")) else t
                out.append(" ".join(table.get(w, w) for w in body.split()))
            return out

        return predict


def char_lengths(pdf):
    """Example batch function: code-point lengths of ``en`` and ``ar``."""
    return pdf.assign(en_chars=pdf["en"].str.len().astype("int64"), ar_chars=pdf["ar"].str.len().astype("int64"))[
        ["row_id", "en_chars", "ar_chars"]
    ]
