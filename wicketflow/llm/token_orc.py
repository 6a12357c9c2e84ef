"""Token ids in ORC files.

Texts are brought into ascending doc_id order by range partitions (before they are turned into ids,
which are larger), encoded in the task that writes them, and written as ORC: integer
columns are stored in run-length encoded streams, each file has row indexes, and doc_id has a Bloom
filter and min/max statistics per row group, so that a lookup reads single row groups and a scan can
read stripes in parallel. `read_tokens` and `find_document` read the files back.

Encoding goes through the tokenizers library. Most of a text repeats words seen before, so texts are
split at white space and their chunks numbered some documents at a time, by Arrow; ids are looked up once
for each distinct chunk and laid out by Arrow. New chunks are cut at the tokenizer's own pattern and handed to the
library in one batch. This holds for chunks of ASCII and simple Latin letters, on which normalisation is
lower-casing; every other chunk goes through the whole tokenizer, and a text with white space or marks
that may tie chunks together goes through it in one piece.

Defined cases: null counts as empty; an empty text has the end id only; null doc_ids come first in the
order; repeated rows each get their place (rows of one doc_id by a hash of the text; the place in the file is stored
and is what `start` is summed up by); an empty table gives an
empty folder that reads back as no rows; other columns are not looked at.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wicketflow.llm.common import Recent
from wicketflow.scratch import shared_folder, stage

END_ID = 1
_CACHED = 400_000
#: Documents encoded at a time: the more, the fewer chunks are looked up again.
_TEXTS = 2048
_ORC = {
    "orc.create.index": "true",
    "orc.row.index.stride": "1000",
    "orc.bloom.filter.columns": "doc_id",
    "orc.bloom.filter.fpp": "0.01",
    "orc.stripe.size": str(64 << 20),
    "compression": "zstd",
}
# Chunks on which the tokenizer's normalisation is plain lower-casing: ASCII and Latin-1 letters.
_PLAIN = re.compile("[!-~À-ÖØ-öø-ÿ]+")
#: Fixed value: the pre-tokenizer's pattern, on such chunks.
_PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\sa-zß-öø-ÿ0-9]+")
# White space beyond ASCII, separators that only some libraries take for it, and combining marks.
_TIES = re.compile("[\x00-\x08\x0e-\x1f\x7f-\xa0̀-ͯ ᠎ -‏ -  -⁯　﻿]")


class ChunkEncoder:
    """Ids of texts by a `tokenizers` file, with bounded tables of chunks and pieces seen lately.

    Ids are kept and joined as bytes of little-endian 32-bit integers.
    """

    def __init__(self, path: str, cached: int = _CACHED):
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        with open(path) as f:
            setting = json.load(f)
        # The same model on pieces that are normalised and cut already.
        setting["normalizer"] = None
        setting["pre_tokenizer"] = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}
        self.pieces = Tokenizer.from_str(json.dumps(setting))
        self.chunks, self.parts = Recent(cached), Recent(cached)

    def _encode_parts(self, parts: list[str]) -> None:
        if not parts:
            return
        encoded = self.pieces.encode(parts, is_pretokenized=True, add_special_tokens=False)
        ids = np.array(encoded.ids, "<i4").tobytes()
        # Every piece gives an id at least, so the words' numbers rise without a gap.
        ends = np.cumsum(np.bincount(np.array(encoded.word_ids), minlength=len(parts))) * 4
        for part, a, b in zip(parts, [0, *ends[:-1].tolist()], ends.tolist()):
            self.parts[part] = ids[a:b]

    def _learn(self, chunks: list[str]) -> None:
        self.parts.turn()
        known, words, mixed, odd = self.parts, [], [], []
        for c in chunks:
            kind = words if c.isascii() and c.isalpha() else odd if "<|" in c or not _PLAIN.fullmatch(c) else mixed
            kind.append(c)
        # Letters alone are one piece.
        lowered, cut = [c.lower() for c in words], [_PIECES.findall(c.lower()) for c in mixed]
        self._encode_parts(known.missing(set(lowered).union(*cut)))
        self.chunks.update(zip(words, map(known.__getitem__, lowered)))
        for c, parts in zip(mixed, cut):
            self.chunks[c] = known[parts[0]] if len(parts) == 1 else b"".join([known[p] for p in parts])
        for c, e in zip(odd, self.whole.encode_batch(odd, add_special_tokens=False)):
            self.chunks[c] = np.array(e.ids, "<i4").tobytes()

    def encode(self, texts: pa.Array, end_id: int | None = None) -> pa.ListArray:
        """Ids of each text (null: empty), each followed by `end_id` if one is given."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        tied = pc.match_substring_regex(texts, _TIES.pattern).to_numpy(zero_copy_only=False)
        # A tied text is one chunk of its own, numbered behind the others.
        lists = pc.ascii_split_whitespace(pc.if_else(pa.array(tied), "", texts) if tied.any() else texts)
        bounds = lists.offsets.to_numpy()
        coded = lists.values.slice(bounds[0], bounds[-1] - bounds[0]).dictionary_encode()
        bounds = (bounds - bounds[0]).astype(np.int64)
        # By way of numpy, which makes strings several times faster than a list of scalars.
        chunks, table = coded.dictionary.to_numpy(zero_copy_only=False).tolist(), self.chunks
        table.turn()
        found = [table.get(c) if c else b"" for c in chunks]
        new = [k for k, f in enumerate(found) if f is None]
        self._learn(table.missing({chunks[k] for k in new}))
        for k in new:
            found[k] = table[chunks[k]]
        whole = np.flatnonzero(tied)
        found += [np.array(e.ids, "<i4").tobytes() for e in self.whole.encode_batch(texts.take(pa.array(whole)).to_pylist(), add_special_tokens=False)]
        found.append(b"" if end_id is None else end_id.to_bytes(4, "little"))
        # All chunks in order, behind each text its whole (if tied) and the end.
        order = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        behind = np.concatenate([bounds[1:][whole], bounds[1:]])
        extra = np.concatenate([len(chunks) + np.arange(len(whole)), np.full(len(texts), len(found) - 1)])
        by_text = np.argsort(np.concatenate([2 * whole, 2 * np.arange(len(texts)) + 1]), kind="stable")
        order = np.insert(order, behind[by_text], extra[by_text])
        # Arrow puts the bytes of the chunks one behind the other.
        laid = pa.array(found, pa.large_binary()).take(pa.array(order))
        upto = np.frombuffer(laid.buffers()[1], np.int64, len(laid) + 1, laid.offset * 8) // 4
        ids = np.frombuffer(laid.buffers()[2] or b"", "<i4", int(upto[-1]))
        per_text = np.zeros(len(texts) + 1, np.int32)
        per_text[1:] = upto[bounds[1:] + 1 + np.arange(len(texts)) + np.cumsum(tied)]
        return pa.ListArray.from_arrays(pa.array(per_text), pa.array(ids))


@cache
def encoder(path: str) -> ChunkEncoder:
    """One per Python worker; workers are used for many tasks."""
    return ChunkEncoder(path)


def _encode(path: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool, place = encoder(path), 0
        for batch in batches:
            # Some documents at a time, which bounds the room of texts and ids.
            for k in range(0, batch.num_rows, _TEXTS):
                part = batch.slice(k, _TEXTS)
                tokens = tool.encode(part.column("text"), end_id)
                places = pa.array(np.arange(place, place + part.num_rows))
                place += part.num_rows
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), places, tokens], names=["doc_id", "place", "tokens"])

    return run


def write_tokens(docs: DataFrame, folder: str, tokenizer: str, end_id: int = END_ID, partitions: int | None = None) -> None:
    """Write doc_id, place in its file and tokens of each document, in ascending doc_id order over the files."""
    narrow = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    # Null ids and repeated ids may be many: the hash of the text lets a range end inside them.
    keyed = narrow.withColumn("tie", F.xxhash64("text"))
    order = ["doc_id", "tie"]
    n = partitions or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = keyed.repartitionByRange(n, *order).sortWithinPartitions(*order).select("doc_id", "text")
    encoded = placed.mapInArrow(_encode(tokenizer, end_id), "doc_id bigint, place bigint, tokens array<int>")
    encoded.write.options(**_ORC).orc(folder)


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema("doc_id bigint, place bigint, tokens array<int>").orc(folder)


def find_document(spark: SparkSession, folder: str, doc_id: int) -> DataFrame:
    """One document's ids; the Bloom filters and row indexes leave out row groups without it."""
    return read_tokens(spark, folder).filter(F.col("doc_id") == doc_id)


def _summary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column("tokens")
        values, offsets = lists.values.to_numpy().astype("<u4"), lists.offsets.to_numpy()
        crc = [zlib.crc32(values[a:b].tobytes()) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("file"), batch.column("place"), pa.array(np.diff(offsets).astype(np.int64)), pa.array(crc, pa.int64())],
            names=["doc_id", "file", "place", "n_tokens", "ids_crc32"],
        )


def token_index(spark: SparkSession, folder: str) -> DataFrame:
    """Per document, from the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32.

    Starts are summed up inside each file, whose size is bounded, and over the files' totals.
    """
    # Files are numbered by the task that wrote them, in the order of their ranges.
    number = F.element_at(F.split("_metadata.file_name", "-"), 2).cast("bigint")
    read = read_tokens(spark, folder).select("doc_id", "place", "tokens", number.alias("file"))
    # Stored, for the ids are read once for both uses.
    docs = stage(spark, read.mapInArrow(_summary, "doc_id bigint, file bigint, place bigint, n_tokens bigint, ids_crc32 bigint"))
    totals = docs.groupBy("file").agg(F.sum("n_tokens").alias("n"))
    earlier = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("file", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    inside = Window.partitionBy("file").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    placed = docs.withColumn("before", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
    return placed.join(starts, "file").select("doc_id", (F.col("base") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")


def encode_to_orc(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Write the ids to the shared folder and return the index read back from the files."""
    spark = docs.sparkSession
    folder = f"{shared_folder(spark)}/tokens"
    write_tokens(docs, folder, tokenizer)
    return token_index(spark, folder)
