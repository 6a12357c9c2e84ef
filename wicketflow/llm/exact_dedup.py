"""Exact duplicates by skew-safe combining.

Texts are equal when they are identical after lower-casing A-Z only; null counts as empty. Three
stages find the groups, each comparing whole texts (in a lossless compressed form, so that equal
bytes mean equal texts):

1. local: inside each Arrow batch of a scan task, copies collapse to one bearer of the text;
2. salted: bearers meet by (digest, salt), so a text that a third of all rows share is spread
   over `salts` tasks and no task sees more than one bearer per batch and salt;
3. global: the at most `salts` winners of a text meet by digest.

The texts cross the network twice, once per meeting; the way back from a group to its rows goes
over row numbers, whose joins have no hot key: bearer numbers are unique per batch.

Defined cases: null or empty texts are copies of each other. A null doc_id is smaller than any
other. Of rows that repeat one doc_id and text the last by row number stays. An empty table gives
an empty result. Other columns of the input are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wicketflow.llm.common import ROW, with_row

_LEAST = -(2**63)
_ROWS = "row bigint, doc_id bigint, bearer bigint, digest binary"
_BEARERS = "bearer bigint, digest binary, packed binary, best_id bigint, best_row bigint, size bigint"
_SALTED = "bearer bigint, leader bigint, digest binary, packed binary, best_id bigint, best_row bigint, size bigint"
_TOTALS = "leader bigint, best_id bigint, best_row bigint, size bigint"
_LOCAL = pa.schema(
    [("bearer", pa.int64()), ("digest", pa.binary()), ("packed", pa.binary()), ("best_id", pa.int64()),
     ("best_row", pa.int64()), ("size", pa.int64())]
)


def _copies(batch: pa.RecordBatch):
    """Codes of equal texts, the distinct texts as bytes, ids (null: least), row numbers."""
    text = pc.ascii_lower(pc.fill_null(batch.column("text").cast(pa.large_string()), ""))
    coded = text.dictionary_encode()
    ids = pc.fill_null(batch.column("doc_id"), _LEAST).to_numpy(zero_copy_only=False)
    rows = batch.column(ROW).to_numpy(zero_copy_only=False)
    codes = coded.indices.to_numpy(zero_copy_only=False)
    return codes, coded.dictionary.cast(pa.large_binary()).to_pylist(), ids, rows


def _local_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows == 0:
            continue
        codes, texts, _, rows = _copies(batch)
        _, first = np.unique(codes, return_index=True)
        digests = pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary())
        yield pa.RecordBatch.from_arrays(
            [pa.array(rows), batch.column("doc_id"), pa.array(rows[first][codes]), digests.take(pa.array(codes))],
            names=["row", "doc_id", "bearer", "digest"],
        )


def _local_bearers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pack = zstandard.ZstdCompressor(level=1).compress
    for batch in batches:
        if batch.num_rows == 0:
            continue
        codes, texts, ids, rows = _copies(batch)
        _, first, size = np.unique(codes, return_index=True, return_counts=True)
        order = np.lexsort((rows, ids, codes))
        last = order[np.cumsum(size) - 1]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(rows[first]),
                pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary()),
                pa.array([pack(t) for t in texts], pa.binary()),
                pa.array(ids[last]), pa.array(rows[last]), pa.array(size),
            ],
            schema=_LOCAL,
        )


def _merge_salted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by digest and salt. Each gives its leader, the leader's own row the totals.

    Held in memory: the distinct texts of one digest, which is one text.
    """
    schema = pa.schema([("bearer", pa.int64()), ("leader", pa.int64()), *list(_LOCAL)[1:]])
    run, key = {}, None

    def totals():
        return [(v[0], v[0], key[0], packed, *v[1], v[2]) for packed, v in run.items()]

    for batch in batches:
        out = []
        columns = [batch.column(n).to_pylist() for n in ("bearer", "digest", "salt", "packed", "best_id", "best_row", "size")]
        for bearer, digest, salt, packed, best_id, best_row, size in zip(*columns):
            if (digest, salt) != key:
                out += totals()
                run, key = {}, (digest, salt)
            held = run.get(packed)
            if held is None:
                run[packed] = [bearer, (best_id, best_row), size]
            else:
                held[1], held[2] = max(held[1], (best_id, best_row)), held[2] + size
                out.append((bearer, held[0], None, None, None, None, None))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
    if run:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*totals()), schema)], schema=schema)


def _merge_global(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by digest; at most one per text and salt, so a run is short."""
    names = ("leader", "best_id", "best_row", "size")
    run, key = {}, None

    def totals():
        return [(leader, *v[0], v[1]) for v in run.values() for leader in v[2]]

    for batch in batches:
        out = []
        columns = [batch.column(n).to_pylist() for n in ("leader", "digest", "packed", "best_id", "best_row", "size")]
        for leader, digest, packed, best_id, best_row, size in zip(*columns):
            if digest != key:
                out += totals()
                run, key = {}, digest
            held = run.setdefault(packed, [(best_id, best_row), 0, []])
            held[0], held[1] = max(held[0], (best_id, best_row)), held[1] + size
            held[2].append(leader)
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=names)
    if run:
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*totals())], names=names)


def duplicate_groups(keyed: DataFrame, salts: int = 16) -> DataFrame:
    """Row number, doc_id, keep_id, group_size, kept and text_sha256 of each row of a `with_row` table."""
    # The name of a plain column: a clashing extra column of the input can't come in here.
    narrow = keyed.select(ROW, F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    rows = narrow.mapInArrow(_local_rows, _ROWS)
    bearers = narrow.mapInArrow(_local_bearers, _BEARERS).withColumn("salt", F.pmod(F.xxhash64("bearer"), F.lit(salts)))
    # Sorted by bearer too: both uses of `salted` must name the same leader, in whatever order blocks arrive.
    salted = (
        bearers.repartition("digest", "salt").sortWithinPartitions("digest", "salt", "bearer")
        .mapInArrow(_merge_salted, _SALTED)
    )
    totals = (
        salted.filter("packed IS NOT NULL").select("leader", "digest", "packed", "best_id", "best_row", "size")
        .repartition("digest").sortWithinPartitions("digest").mapInArrow(_merge_global, _TOTALS)
    )
    groups = salted.select("bearer", "leader").join(totals, "leader").drop("leader")
    return rows.join(groups, "bearer").select(
        F.col("row").alias(ROW), "doc_id",
        F.when(F.col("best_id") != _LEAST, F.col("best_id")).alias("keep_id"),
        F.col("size").alias("group_size"),
        (F.col("row") == F.col("best_row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def mark_duplicates(docs: DataFrame, salts: int = 16) -> DataFrame:
    """One row per document, dropped ones too: doc_id, keep_id, group_size, kept, text_sha256."""
    return duplicate_groups(with_row(docs), salts).drop(ROW)


def drop_duplicates(docs: DataFrame, salts: int = 16) -> DataFrame:
    """The documents that stay, with all their columns."""
    keyed = with_row(docs)
    kept = duplicate_groups(keyed, salts).filter("kept").select(ROW)
    return keyed.join(kept, ROW).drop(ROW)
