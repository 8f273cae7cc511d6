"""Passes over whole texts: a document is known by its id and a tag of its
text, a pass hands each text, with what is asked of it, to a function."""

from __future__ import annotations

from collections.abc import Callable, Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortflow.llm.common import col, materialize, small_side, text_or_empty


def key_columns(id_col: str, text: Column) -> list[Column]:
    """id (nulls last) and a tag that tells apart texts under one id: 63 bits of
    a hash, its low 31 first."""
    h = F.xxhash64(text)
    return [
        F.coalesce(col(id_col).cast("long"), F.lit(2**63 - 1)).alias("id"),
        F.shiftleft(h.bitwiseAND(F.lit(0x7FFFFFFF)), 32).bitwiseOR(F.shiftrightunsigned(h, 31).bitwiseAND(F.lit(0xFFFFFFFF))).alias("tag"),
    ]


def base_rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = text_or_empty(text_col)
    return docs.select(col(id_col).alias("doc_id"), *key_columns(id_col, text), text.cast("binary").alias("text"))


def over_texts(rows: DataFrame, fn: Callable, schema: str) -> DataFrame:
    """``fn(text, request)`` of every row of (doc_id, id, tag, text, request);
    it returns a tuple of the columns that ``schema`` adds to doc_id, id, tag."""
    types = pa.schema([(f.name, _arrow(f.dataType)) for f in rows.sparkSession.createDataFrame([], schema).schema])
    head = [f"{f.name} {f.dataType.simpleString()}" for f in rows.select("doc_id", "id", "tag").schema]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for b in batches:
            request = b.column(4) if b.num_columns > 4 else None
            for s in range(0, b.num_rows, 512):  # small batches out: a request can be long
                part = range(s, min(s + 512, b.num_rows))
                got = [fn(b.column(3)[i].as_py(), request[i].as_py() if request is not None else None) for i in part]
                cols = [pa.array([g[k] for g in got], types.field(k).type) for k in range(len(types))]
                yield pa.RecordBatch.from_arrays([*(b.column(k).slice(s, len(part)) for k in range(3)), *cols], names=["doc_id", "id", "tag", *types.names])

    return rows.mapInArrow(run, ", ".join([*head, schema]))


def _arrow(t) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(t)


def requested(docs: DataFrame, asked: DataFrame, id_col: str, text_col: str, items: str, repeated: DataFrame | None = None) -> DataFrame:
    """Documents that ``asked`` names, with the structs they are asked for.

    Texts are shuffled to their requests; while the keys asked for are few
    enough to broadcast, the other texts are left out before the shuffle.  Of the
    rows that ``repeated`` (id, tag) names, only one of each is handed on."""
    lists = materialize(asked.groupBy("id", "tag").agg(F.collect_list(items).alias("request")))
    rows = base_rows(docs, id_col, text_col)
    keys = lists.select("id", "tag")
    if (few := small_side(keys, 16)) is not keys:
        rows = rows.join(few, ["id", "tag"], "left_semi")
    if repeated is not None and not repeated.isEmpty():
        many = small_side(repeated, 16)
        once = rows.join(many, ["id", "tag"], "left_semi").groupBy("id", "tag").agg(F.first("doc_id").alias("doc_id"), F.first("text").alias("text"))
        rows = rows.join(many, ["id", "tag"], "left_anti").unionByName(once)
    # always a shuffle of the texts asked for, so that its cost follows the input
    return rows.join(lists.hint("merge"), ["id", "tag"]).select("doc_id", "id", "tag", "text", "request")


def covered(n: int, request: list[dict]) -> np.ndarray:
    """True for each of ``n`` words that some span covers."""
    step = np.zeros(n + 1, np.int64)
    for r in request:
        step[r["lo"]] += 1
        step[min(n, r["lo"] + r["len"])] -= 1
    return np.cumsum(step[:n]) > 0
