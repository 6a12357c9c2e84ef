"""Prefix trie of conversations by fixed-length block hashing.

A node is a distinct sequence of first turns; the conversations that start with it are its members.

1. Each turn becomes a digest and its length; no text crosses the network after that.
2. The turns of a conversation are cut into blocks of `BLOCK`. A block's key is the digest of the key
   before it and its turns' digests, so equal keys mean equal conversations up to there.
3. Conversations are grouped by whole blocks first: rows with the same (key before, key after) are one
   class, added up on both sides of the shuffle.
4. Turn boundaries are refined only where siblings diverge: a class that is alone behind its key has
   the same members at each of its turns and gives its nodes at once; the turns of the others get
   keys of their own and are grouped by them.

Sums over subtrees need no walk. Each node belongs to its smallest member; the nodes of one owner are
the lower end of its path, from the depth on at which it is the smallest. So a sum over the distinct
nodes of a subtree is a sum over its members of what they own, which step 3 and 4 add up like counts:
one pass finds the owners, a second one the sums.

Skew: a first turn or a whole conversation that a third of all share is added up before the shuffle. A
long conversation is numbered by chunks of its turns and is chained by blocks. Nodes whose
children are more than one in `_HOT` of all nodes, of which there are `_HOT` at most, are broadcast
where children look for their parent. The list of ids that end at one node is joined up in parts of
4,096 possible ids and hashed as it streams by.

Defined cases: null roles and texts are empty; a null turn comes first, equal turns follow the order
of their digests; rows without a conv_id belong to no conversation; an empty table has no node, not
even a root. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wicketflow.llm.common import ROW, with_row
from wicketflow.scratch import stage

#: Turns of a block.
BLOCK = 4
#: Keys are this many bytes of a SHA-256 digest.
_KEY = 16
ROOT = hashlib.sha256(b"").digest()[:_KEY]
_TURN = 32
#: Turn numbers of a chunk, and conversation ids of a part, as powers of two.
_CHUNK_BITS, _PART_BITS = 10, 12
_LEAST = -(2**63)
_HOT = 10_000
_CHAINED = "conv_id bigint, block bigint, start binary, end binary, before bigint, after bigint, depth bigint, turns binary, sizes array<bigint>"
_OPENED = "key binary, parent binary, depth bigint, size bigint, before bigint"


def _key(before: bytes, turns: bytes) -> bytes:
    return hashlib.sha256(before + turns).digest()[:_KEY]


def digest_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, digest and size (code points) of each turn, with its row number."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    # The role's length tells where it ends.
    digest = F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256))
    return with_row(conversations.select("conv_id", "turn", "role", "text")).where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.coalesce(F.col("turn").cast("bigint"), F.lit(_LEAST)).alias("turn"),
        digest.alias("digest"), F.length(text).cast("bigint").alias("size"), ROW,
    )


def number_turns(digested: DataFrame) -> DataFrame:
    """`digested` with place, from 0, in the order of turn and digest. Chunks of a long conversation are numbered apart."""
    chunk = F.shiftright("turn", _CHUNK_BITS)
    chunked = digested.withColumn("chunk", chunk)
    earlier = Window.partitionBy("conv_id").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    counts = chunked.groupBy("conv_id", "chunk").agg(F.count("*").alias("n"))
    offsets = counts.withColumn("offset", F.coalesce(F.sum("n").over(earlier), F.lit(0))).drop("n")
    inside = Window.partitionBy("conv_id", "chunk").orderBy("turn", "digest")
    numbered = chunked.withColumn("number", F.row_number().over(inside) - 1).join(offsets, ["conv_id", "chunk"])
    return numbered.select("conv_id", (F.col("offset") + F.col("number")).alias("place"), "digest", "size", ROW)


def paths_as_given(digested: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All conv_ids, and the turns of each by depth (from 1)."""
    paths = number_turns(digested).select("conv_id", (F.col("place") + 1).alias("depth"), "digest", "size", ROW)
    return digested.select("conv_id").distinct(), paths


def paths_with_shared_heads(digested: DataFrame, span: int = 100, most: int = 6) -> tuple[DataFrame, DataFrame]:
    """As `paths_as_given`, the first h turns of a conversation c taken from conversation c - c % span.

    h is the CRC-32 of c's decimal digits modulo `most`; c % span has the sign of c; the conversation goes on with its own turns after
    its first h. If the other one has fewer turns, all of them come first.
    """
    placed = number_turns(digested)
    counts = digested.groupBy("conv_id").agg(F.count("*").alias("n"))
    base = F.col("conv_id") - F.col("conv_id") % span
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % most
    lengths = counts.select(F.col("conv_id").alias("base"), F.col("n").alias("there"))
    heads = counts.select("conv_id", base.alias("base"), h.alias("h")).join(lengths, "base", "left")
    heads = heads.withColumn("taken", F.least("h", F.coalesce("there", F.lit(0))))
    own = placed.join(heads.select("conv_id", "h", "taken"), "conv_id").where("place >= h")
    own = own.select("conv_id", (F.col("taken") + F.col("place") - F.col("h") + 1).alias("depth"), "digest", "size", ROW)
    stems = placed.where((F.col("conv_id") % span == 0) & (F.col("place") < most - 1)).withColumnRenamed("conv_id", "base")
    lent = heads.where("taken > 0").join(stems, "base").where("place < h")
    lent = lent.select("conv_id", (F.col("place") + 1).alias("depth"), "digest", "size", ROW)
    return counts.select("conv_id"), own.unionAll(lent)


def _chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks come by conversation, in order; each gets the keys before and after it and the code points up to there."""
    conv, key, before, depth = None, ROOT, 0, 0
    names = [c.split()[0] for c in _CHAINED.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64())]
    for batch in batches:
        out = []
        for conv_id, block, turns, sizes in zip(*(batch.column(n).to_pylist() for n in ("conv_id", "block", "turns", "sizes"))):
            if conv_id != conv:
                conv, key, before, depth = conv_id, ROOT, 0, 0
            turns = b"".join(turns)
            end, after = _key(key, turns), before + sum(sizes)
            depth += len(sizes)
            out.append((conv_id, block, key, end, before, after, depth, turns, sizes))
            key, before = end, after
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)


def chain_blocks(paths: DataFrame) -> DataFrame:
    """Blocks of each conversation with the keys before and after them."""
    turns = F.sort_array(F.collect_list(F.struct("depth", "digest", "size")))
    cut = paths.groupBy("conv_id", F.floor((F.col("depth") - 1) / BLOCK).alias("block")).agg(turns.alias("turns"))
    cut = cut.select("conv_id", "block", F.col("turns.digest").alias("turns"), F.col("turns.size").alias("sizes"))
    return cut.repartition("conv_id").sortWithinPartitions("conv_id", "block").mapInArrow(_chain, _CHAINED)


def _open(measures: tuple[str, ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each class of blocks as one row per turn, with the keys of the turns."""
        for batch in batches:
            columns = [batch.column(n).to_pylist() for n in ("start", "end", "before", "depth", "turns", "sizes")]
            out, source = [], []
            for k, (start, end, before, depth, turns, sizes) in enumerate(zip(*columns)):
                parent, depth = start, depth - len(sizes)
                for j, size in enumerate(sizes, 1):
                    key = end if j == len(sizes) else _key(start, turns[: j * _TURN])
                    out.append((key, parent, depth + j, size, before))
                    source.append(k)
                    parent, before = key, before + size
            if out:
                kinds = (pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64())
                own = [pa.array(c, k) for c, k in zip(zip(*out), kinds)]
                yield pa.RecordBatch.from_arrays(
                    own + [batch.column(m).take(pa.array(source)) for m in measures], names=[c.split()[0] for c in _OPENED.split(", ")] + list(measures)
                )

    return run


def nodes(chained: DataFrame, measures: tuple[str, ...] = ()) -> DataFrame:
    """All nodes but the root: key, parent, depth, size of the last text, code points before it, n_convs, owner, sums of `measures`."""
    kinds = ("n_convs", *measures, "owner")
    sums = [F.sum(m).alias(m) for m in ("n_convs", *measures)] + [F.min("owner").alias("owner")]
    of_blocks = [F.count("*").alias("n_convs"), *[F.sum(m).alias(m) for m in measures], F.min("conv_id").alias("owner")]
    classes = chained.groupBy("start", "end", "before", "depth", "turns", "sizes").agg(*of_blocks)
    siblings = chained.groupBy("start").agg(F.min("end").alias("end"), F.max("end").alias("last"))
    alone = siblings.where("end = last").select("start", "end", F.lit(True).alias("alone"))
    # Joined on both keys: the classes behind a key that all share are spread.
    marked = classes.join(alone, ["start", "end"], "left")
    opened = marked.mapInArrow(_open((*kinds, "alone")), _OPENED + "".join(f", {k} bigint" for k in kinds) + ", alone boolean")
    keys = [c.split()[0] for c in _OPENED.split(", ")]
    whole = opened.where("alone").select(*keys, *kinds)
    return whole.unionByName(opened.where("alone IS NULL").groupBy(*keys).agg(*sums))


def _hash_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parts of id lists come by key, in order; held is one digest."""
    key, digest = None, None
    for batch in batches:
        out = []
        for mine, ids in zip(batch.column("key").to_pylist(), batch.column("ids").to_pylist()):
            if mine == key:
                digest.update(b"," + ids.encode())
            else:
                out += [(key, digest.hexdigest())] if digest else []
                key, digest = mine, hashlib.sha256(ids.encode())
        if out:
            yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in out], pa.binary()), pa.array([d for _, d in out])], names=["key", "ends_sha256"])
    if digest:
        yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([digest.hexdigest()])], names=["key", "ends_sha256"])


def hash_ends(ends: DataFrame) -> DataFrame:
    """key and SHA-256 of the ascending, comma-joined conv_ids of `ends` (key, conv_id)."""
    part = F.shiftright("conv_id", _PART_BITS).alias("part")
    ids = F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string")), ",")
    parts = ends.groupBy("key", part).agg(ids.alias("ids"))
    return parts.repartition("key").sortWithinPartitions("key", "part").mapInArrow(_hash_ids, "key binary, ends_sha256 string")


def _owner_of_parent(heads: DataFrame, parents: DataFrame, hot_from: int) -> DataFrame:
    """`heads` (owner, depth, before, parent) with the parent's owner. `parents`: key, owner, n_children."""
    names = parents.select(F.col("key").alias("parent"), F.col("owner").alias("parent_owner"), "n_children")
    # At most _HOT rows, as the children of all nodes together are no more than the nodes.
    hot = F.broadcast(names.where(F.col("n_children") >= hot_from).drop("n_children"))
    told = heads.join(hot, "parent", "left")
    cold = names.where(F.col("n_children") < hot_from).drop("n_children")
    rest = told.where("parent_owner IS NULL").drop("parent_owner").join(cold, "parent")
    return told.where("parent_owner IS NOT NULL").unionByName(rest)


def build(convs: DataFrame, paths: DataFrame) -> DataFrame:
    """The trie of conversations `convs` (conv_id) with turns `paths` (conv_id, depth, digest, size): one row per node.

    conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens (code points
    that sharing saves in the subtree), ends_sha256 (of the members that end here).
    """
    spark = convs.sparkSession
    chained = stage(spark, chain_blocks(paths))
    found = stage(spark, nodes(chained))
    last = chained.groupBy("conv_id").agg(F.max(F.struct("block", "end", "after")).alias("last"))
    ended = convs.join(last, "conv_id", "left").select(
        "conv_id", F.coalesce("last.end", F.lit(ROOT)).alias("key"), F.coalesce("last.after", F.lit(0)).cast("bigint").alias("chars")
    )
    ended = stage(spark, ended)
    first, n_convs = ended.agg(F.min("conv_id"), F.count("*")).first()
    ends = ended.groupBy("key").agg(F.count("*").alias("n_ends"))
    children = found.groupBy(F.col("parent").alias("key")).agg(F.count("*").alias("n_children"))

    # What each conversation owns: the first depth of its nodes, the code points before it, the parent there.
    heads = found.groupBy("owner").agg(F.min(F.struct("depth", "before", "parent")).alias("head"))
    heads = heads.where(F.col("owner") != F.lit(first)).select("owner", "head.*")
    root = spark.range(1).select(F.lit(ROOT).alias("key"), F.lit(first).cast("bigint").alias("owner"), F.lit(n_convs).cast("bigint").alias("n_convs"))
    root = root.where("owner IS NOT NULL")
    known = found.select("key", "owner", "n_convs").unionByName(root)
    parents = known.join(children, "key")
    heads = _owner_of_parent(heads, parents, max(1000, found.count() // _HOT))
    own_root = root.select("owner", F.lit(0).cast("bigint").alias("depth"), F.lit(0).cast("bigint").alias("before"), F.lit(None).cast("bigint").alias("parent_owner"))
    heads = stage(spark, heads.drop("parent").unionByName(own_root))
    leaves = known.join(ends, "key").where("n_convs = n_ends").select(F.col("owner").alias("conv_id"), F.lit(1).alias("leaf"))
    owned = ended.join(heads.select(F.col("owner").alias("conv_id"), "before"), "conv_id", "left").join(leaves, "conv_id", "left").select(
        "conv_id", "chars",
        F.coalesce(F.col("chars") - F.col("before"), F.lit(0)).alias("owned"), F.coalesce("leaf", F.lit(0)).cast("bigint").alias("leaves"),
    )
    owned = stage(spark, owned)
    measures = ("chars", "owned", "leaves")
    summed = nodes(chained.join(owned, "conv_id"), measures)
    whole = owned.agg(*[F.sum(m).alias(m) for m in measures]).first()
    zero = F.lit(0).cast("bigint")
    top = root.select(
        "key", F.lit(None).cast("binary").alias("parent"), zero.alias("depth"), zero.alias("size"), zero.alias("before"), "n_convs",
        *[F.lit(whole[m]).cast("bigint").alias(m) for m in measures], "owner",
    )
    every = summed.unionByName(top).join(children, "key", "left").join(hash_ends(ended.select("key", "conv_id")), "key", "left")
    owners = heads.select("owner", F.col("depth").alias("from"), F.col("before").alias("skipped"), "parent_owner")
    return every.join(owners, "owner").select(
        F.col("owner").alias("conv_id"), "depth",
        F.when(F.col("depth") > F.col("from"), F.col("owner")).otherwise(F.col("parent_owner")).alias("parent_conv_id"),
        "n_convs", F.coalesce("n_children", zero).alias("n_children"), F.col("leaves").alias("n_leaves"),
        (F.col("chars") - (F.col("n_convs") - 1) * F.col("before") - F.col("owned") - F.col("skipped")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """The trie of the conversations (conv_id, turn, role, text) as they are."""
    return build(*paths_as_given(stage(conversations.sparkSession, digest_turns(conversations))))


def prefix_trie_with_shared_heads(conversations: DataFrame) -> DataFrame:
    """The trie of the conversations with heads taken from others (`paths_with_shared_heads`)."""
    return build(*paths_with_shared_heads(stage(conversations.sparkSession, digest_turns(conversations))))


def last_turns(trie: DataFrame, paths: DataFrame, conversations: DataFrame) -> DataFrame:
    """`trie` with role and text of each node's last turn (null for the root); `paths` as for `build`, of the same table."""
    texts = with_row(conversations.select("conv_id", "turn", "role", "text")).select(
        ROW, *[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("role", "text")]
    )
    placed = trie.join(paths.select("conv_id", "depth", ROW), ["conv_id", "depth"], "left")
    return placed.join(texts, ROW, "left").drop(ROW)
