"""Prefix trie of conversations by block hashing.

Every turn has a term, a hash of its place and content; the digest of a prefix is
the sum of its terms (two lanes of 60 bits), so prefix digests are running sums
and a long conversation can be cut anywhere.  Conversations are first grouped by
blocks of ``block`` turns: rows with equal digests before and behind a block are
one edge of a coarse trie.  Where only one edge leaves a digest, all members share
the block, and its inner nodes are read off the edge.  Only where edges diverge
are the block's single turns grouped.

Sums over subtrees take a number of rounds that grows with the logarithm of the
depth: in round t every node sends what it has gathered to its ancestor 2^t
levels up, and learns the ancestor 2^(t+1) up.

How it spreads: turns are sorted by range of (conversation, turn), so one huge
conversation spans many tasks, and running sums are carried over the
partition borders (one row per partition).  Groups of copies collapse per task.
The list of the conversations that end in a node is hashed as a stream
of chunks, never held as one group; SHA-256 itself is sequential.

Defined cases: null role and text are empty; rows whose ``conv_id`` is null belong
to no conversation and are left out; turns of one conversation that tie are
ordered by role, then text; repeated rows are turns of their own; ``conv_id % 100``
has the sign of ``conv_id``; an empty table has no node, not even a root.
Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import discard, stage_path

BLOCK = 4
#: Conversations start with turns of their hundred's first conversation: fewer than this many.
SHARED, HUNDRED = 6, 100
_BITS = 60
_MASK = (1 << _BITS) - 1
KEY = ["depth", "a", "b"]


def _runs(key: np.ndarray) -> np.ndarray:
    """Index at which the run of equal keys that holds each row begins."""
    start = np.zeros(len(key), dtype=np.int64)
    cut = np.flatnonzero(key[1:] != key[:-1]) + 1
    start[cut] = cut
    return np.maximum.accumulate(start)


def carried(staged: DataFrame, *sums: str) -> DataFrame:
    """What earlier partitions hold of the conversation that a partition goes on with: pid, conv, and the sums.

    ``staged`` holds partitions ``pid`` sorted by ``conv``; its rows have running values ``sums`` from the start of
    the conversation in that partition.  One row per partition is collected."""
    rows = (staged.groupBy("pid").agg(F.min("conv").alias("first"), F.max(F.struct("conv", "at", *sums)).alias("last"))
            .orderBy("pid").collect())
    out, before, so_far = [], None, ()
    for r in rows:
        had = so_far if before == r["first"] else tuple(0 for _ in sums)
        if any(had):
            out.append((r["pid"], r["first"], *had))
        own = tuple(r["last"][s] for s in sums)
        so_far = tuple((x + y) & _MASK for x, y in zip(had, own)) if r["first"] == r["last"]["conv"] else own
        before = r["last"]["conv"]
    schema = "pid int, conv long, " + ", ".join(f"{s}_before long" for s in sums)
    return F.broadcast(staged.sparkSession.createDataFrame(out, schema))  # at most one row per partition


def ordered(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
            text_col: str = "text") -> tuple[DataFrame, str]:
    """``conv, pos, digest, chars`` of every turn, ``pos`` from 0; also the folder of the table behind it."""
    src = df.select(F.col(conv_col).cast("long").alias("conv"), F.col(turn_col).alias("turn"),
                    F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"),
                    F.coalesce(text_col, F.lit("")).alias("text")).filter(F.col("conv").isNotNull())
    by = ["conv", F.col("turn").asc_nulls_first(), "role", "text"]
    content = F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")
    turns = (src.repartitionByRange(*by).sortWithinPartitions(*by)
             .select("conv", F.md5(content).alias("digest"), F.length("text").cast("long").alias("chars")))

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pid, last, count = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            conv = batch.column(0).to_numpy()
            if not len(conv):
                continue
            start = _runs(conv)
            at = np.arange(1, len(conv) + 1) - start
            if conv[0] == last:
                at[start == 0] += count
            last, count = conv[-1], int(at[-1])
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(conv), pid, dtype=np.int32)), batch.column(0), pa.array(at),
                                              batch.column(1), batch.column(2)], ["pid", "conv", "at", "digest", "chars"])

    staged, path = stage_path(turns.mapInArrow(number, "pid int, conv long, at long, digest string, chars long"), "trie-turns")
    staged = staged.withColumn("n", F.col("at"))
    out = staged.join(carried(staged, "n"), ["pid", "conv"], "left")
    return out.select("conv", (F.col("at") - 1 + F.coalesce("n_before", F.lit(0))).alias("pos"), "digest", "chars"), path


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame, str]:
    """The turns of every rebuilt conversation, and the conversations with their rebuilt lengths (``conv, size``).

    Conversation c takes the first h turns of c - c % 100 and its own behind its first h, h = crc32(c) % 6."""
    conv = F.col("conv")
    h = F.crc32(conv.cast("string")) % SHARED
    base = (turns.filter((conv % HUNDRED == 0) & (F.col("pos") < SHARED - 1)).groupBy(conv.alias("base"))
            .agg(F.sort_array(F.collect_list(F.struct("pos", "digest", "chars"))).alias("shared")))  # at most 5 each
    heads = (turns.groupBy("conv").agg(F.count(F.lit(1)).alias("own")).withColumn("base", conv - conv % HUNDRED)
             .join(base, "base", "left").withColumn("h", h)
             .withColumn("taken", F.least(F.col("h"), F.coalesce(F.size("shared"), F.lit(0)).cast("long")))
             .withColumn("taken", F.when(F.col("shared").isNull(), 0).otherwise(F.col("taken")))
             .select("conv", "taken", (F.col("taken") + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("size"),
                     F.slice("shared", F.lit(1), F.col("taken").cast("int")).alias("head")))
    heads, path = stage_path(heads, "trie-heads")
    first = heads.select("conv", "size", F.inline("head"))
    own = (turns.filter(F.col("pos") >= h).join(heads.select("conv", "taken", "size"), "conv")
           .withColumn("pos", F.col("pos") - h + F.col("taken")))
    cols = ["conv", "pos", "digest", "chars", "size"]
    return first.select(*cols).unionByName(own.select(*cols)), heads.select("conv", "size"), path


def _lane(term: Column, at: int) -> Column:
    return F.conv(F.substring(term, at, 15), 16, 10).cast("long")


def blocks(turns: DataFrame, block: int = BLOCK) -> tuple[DataFrame, str]:
    """One row per conversation and block: digest before it (``sa, sb``), behind each of its turns (arrays ``a, b``), lengths."""
    term = F.md5(F.concat(F.col("pos").cast("string"), F.lit(":"), "digest"))
    src = (turns.select("conv", (F.col("pos") / block).cast("long").alias("k"), "pos", "size", "chars", term.alias("term"))
           .select("conv", "k", "pos", "size", "chars", _lane(F.col("term"), 1).alias("x"), _lane(F.col("term"), 17).alias("y"))
           .repartitionByRange("conv", "k").sortWithinPartitions("conv", "pos"))
    mask = np.uint64(_MASK)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pid, last, sums, rest = TaskContext.get().partitionId(), None, np.zeros(2, dtype=np.uint64), None

        def emit(t: pa.Table) -> pa.RecordBatch:
            nonlocal last, sums
            conv, k, pos, size, chars = (t.column(i).to_numpy() for i in range(5))
            start = _runs(conv)
            lanes = []
            for i in range(2):
                v = t.column(5 + i).to_numpy().astype(np.uint64)
                c = np.cumsum(v, dtype=np.uint64)  # modulo 2^64, hence also modulo 2^60
                c = c - (c - v)[start]
                if conv[0] == last:
                    c[start == 0] += sums[i]
                lanes.append((c & mask, (c - v) & mask))
            last, sums = conv[-1], np.array([lanes[0][0][-1], lanes[1][0][-1]], dtype=np.uint64)
            at = np.flatnonzero(np.r_[True, (conv[1:] != conv[:-1]) | (k[1:] != k[:-1])])
            ends = pa.array(np.r_[at, len(conv)].astype(np.int32))
            arrays = [pa.ListArray.from_arrays(ends, pa.array(x.astype(np.int64))) for x in (lanes[0][0], lanes[1][0], chars)]
            stop = np.r_[at[1:], len(conv)] - 1
            return pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(at), pid, dtype=np.int32)), *(pa.array(x[at].astype(np.int64)) for x in (conv, k)),
                 *(pa.array(x[at].astype(np.int64)) for x in (lanes[0][1], lanes[1][1])), *arrays,
                 pa.array(pos[stop] + 1 == size[stop]), *(pa.array(x[stop].astype(np.int64)) for x in (lanes[0][0], lanes[1][0]))],
                ["pid", "conv", "at", "sa", "sb", "a", "b", "chars", "last", "x", "y"])

        for batch in batches:
            t = pa.Table.from_batches([batch] if rest is None else [*rest.to_batches(), batch])
            if not t.num_rows:
                continue
            conv, k = t.column(0).to_numpy(), t.column(1).to_numpy()
            hold = len(conv) - int(np.argmax((conv[::-1] != conv[-1]) | (k[::-1] != k[-1]))) if (
                (conv != conv[-1]) | (k != k[-1])).any() else 0
            if hold:
                yield emit(t.slice(0, hold))
            rest = t.slice(hold)  # the last block may go on in the next batch
        if rest is not None and rest.num_rows:
            yield emit(rest)

    long_array = "array<long>"
    staged, path = stage_path(src.mapInArrow(
        cut, f"pid int, conv long, at long, sa long, sb long, a {long_array}, b {long_array}, chars {long_array}, "
             "last boolean, x long, y long"), "trie-blocks")
    out = staged.join(carried(staged, "x", "y"), ["pid", "conv"], "left")
    x, y = F.coalesce("x_before", F.lit(0)), F.coalesce("y_before", F.lit(0))

    def on(c: Column, by: Column) -> Column:
        return (c + by).bitwiseAND(F.lit(_MASK))

    return out.select("conv", F.col("at").alias("k"), on(F.col("sa"), x).alias("sa"), on(F.col("sb"), y).alias("sb"),
                      F.transform("a", lambda v: on(v, x)).alias("a"), F.transform("b", lambda v: on(v, y)).alias("b"),
                      "chars", "last"), path


def nodes(cut: DataFrame, convs: DataFrame, block: int = BLOCK) -> tuple[DataFrame, str]:
    """``depth, a, b`` (key), ``pa, pb`` (the parent's), ``conv`` (smallest member), ``n`` members, ``chars`` of the last turn; also the folder."""
    start = ["k", "sa", "sb"]
    edges, path = stage_path(cut.groupBy(*start, "a", "b", "chars").agg(F.count(F.lit(1)).alias("n"), F.min("conv").alias("conv")),
                             "trie-edges")
    ways = edges.groupBy(*start).agg((F.count(F.lit(1)) > 1).alias("parts"))
    here = edges.join(ways, start)
    spread = here.select("parts", "n", "conv", "k", "sa", "sb", "a", "b", F.posexplode(F.arrays_zip("a", "b", "chars")).alias("i", "t"))
    first = F.col("i") == 0
    flat = spread.select(
        "parts", (F.col("k") * block + F.col("i") + 1).alias("depth"), F.col("t.a").alias("a"), F.col("t.b").alias("b"),
        F.when(first, F.col("sa")).otherwise(F.get(F.col("a"), F.col("i") - 1)).alias("pa"),
        F.when(first, F.col("sb")).otherwise(F.get(F.col("b"), F.col("i") - 1)).alias("pb"),
        "conv", "n", F.col("t.chars").alias("chars"))
    flat, flat_path = stage_path(flat, "trie-spread")
    discard(cut.sparkSession, path)
    shared = flat.filter(~F.col("parts")).drop("parts")
    split = (flat.filter("parts").groupBy("depth", "a", "b", "pa", "pb", "chars")
             .agg(F.min("conv").alias("conv"), F.sum("n").alias("n")).select(*shared.columns))
    zero = F.lit(0).cast("long")
    root = (convs.agg(F.min("conv").alias("conv"), F.count(F.lit(1)).alias("n")).filter(F.col("n") > 0)
            .select(zero.alias("depth"), zero.alias("a"), zero.alias("b"), zero.alias("pa"), zero.alias("pb"), "conv", "n",
                    zero.alias("chars")))
    out, kept = stage_path(shared.unionByName(split).unionByName(root), "trie-nodes")
    discard(cut.sparkSession, flat_path)
    return out, kept


def with_parents(found: DataFrame) -> DataFrame:
    """The nodes with ``parent`` (its smallest member) and ``kids``."""
    up = [(F.col("depth") - 1).alias("depth"), F.col("pa").alias("a"), F.col("pb").alias("b")]
    kids = found.filter("depth > 0").groupBy(*up).agg(F.count(F.lit(1)).alias("kids"))
    above = found.select((F.col("depth") + 1).alias("depth"), F.col("a").alias("pa"), F.col("b").alias("pb"),
                         F.col("conv").alias("parent"))
    return (found.join(above, ["depth", "pa", "pb"], "left").join(kids, KEY, "left")
            .withColumn("kids", F.coalesce("kids", F.lit(0))))


def subtree_sums(found: DataFrame, *sums: str) -> DataFrame:
    """``depth, a, b`` of every node and the sums of the columns over its subtree, the node included.

    ``found`` holds the nodes with their parents' digests ``pa, pb``.  log2(depth) rounds; round t touches only
    nodes at least 2^t deep."""
    spark = found.sparkSession
    deepest = found.agg(F.max("depth")).head()[0] or 0
    pieces = [found.select(*KEY, *sums)]
    live, old, step = found.filter("depth > 0").select(*KEY, "pa", "pb", *sums), None, 1
    while step <= deepest:
        sent, _ = stage_path(live.groupBy((F.col("depth") - step).alias("depth"), F.col("pa").alias("a"), F.col("pb").alias("b"))
                             .agg(*[F.sum(s).alias(s) for s in sums]), "trie-sums")
        pieces.append(sent)
        if step * 2 <= deepest:
            got = sent.select(*KEY, *[F.col(s).alias(f"{s}_got") for s in sums])
            higher = live.select((F.col("depth") + step).alias("depth"), F.col("a").alias("pa"), F.col("b").alias("pb"),
                                 F.col("pa").alias("ga"), F.col("pb").alias("gb"))
            nxt = (live.filter(F.col("depth") >= 2 * step).join(got, KEY, "left").join(higher, ["depth", "pa", "pb"])
                   .select(*KEY, F.col("ga").alias("pa"), F.col("gb").alias("pb"),
                           *[(F.col(s) + F.coalesce(f"{s}_got", F.lit(0))).alias(s) for s in sums]))
            live, path = stage_path(nxt, "trie-live")
            if old:
                discard(spark, old)
            old = path
        step *= 2
    total = pieces[0]
    for p in pieces[1:]:
        total = total.unionByName(p)
    return total.groupBy(*KEY).agg(*[F.sum(s).alias(s) for s in sums])


def end_digests(ends: DataFrame) -> DataFrame:
    """``depth, a, b, sha``: SHA-256 of the ascending, comma-joined ids of the conversations that end in a node.

    Ids are sorted by range and joined to chunks inside tasks; the chunks of a node run through one hash."""

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            cols = [batch.column(i).to_numpy() for i in range(4)]
            at = np.flatnonzero(np.r_[True, (cols[0][1:] != cols[0][:-1]) | (cols[1][1:] != cols[1][:-1])
                                      | (cols[2][1:] != cols[2][:-1])])
            ids = list(map(str, cols[3].tolist()))
            joined = [",".join(ids[lo:hi]) for lo, hi in zip(at, [*at[1:], len(ids)])]
            yield pa.RecordBatch.from_arrays([*(pa.array(c[at]) for c in cols), pa.array(joined, pa.string())], [*KEY, "conv", "ids"])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state, done = None, None, []
        for batch in batches:
            for *node, ids in zip(*(batch.column(i).to_pylist() for i in (0, 1, 2, 4))):
                if node == key:
                    state.update(b"," + ids.encode())
                    continue
                if key is not None:
                    done.append((*key, state.hexdigest()))
                key, state = node, hashlib.sha256(ids.encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], [*KEY, "sha"])
                done = []
        if key is not None:
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (*key, state.hexdigest())], [*KEY, "sha"])

    short = (ends.select(*KEY, "conv").repartitionByRange(*KEY, "conv").sortWithinPartitions(*KEY, "conv")
             .mapInArrow(chunks, "depth long, a long, b long, conv long, ids string"))
    return (short.repartition(*KEY).sortWithinPartitions(*KEY, "conv")
            .mapInArrow(digest, "depth long, a long, b long, sha string"))


def conversation_trie(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                      text_col: str = "text", block: int = BLOCK, share_heads: bool = True) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    ``share_heads=False`` takes the conversations as they are, without the hundred's common head."""
    spark = df.sparkSession
    turns, turns_path = ordered(df, conv_col, turn_col, role_col, text_col)
    if share_heads:
        turns, convs, heads_path = rebuilt(turns)
    else:
        convs, heads_path = stage_path(turns.groupBy("conv").agg(F.count(F.lit(1)).alias("size")), "trie-heads")
        turns = turns.join(convs, "conv")
    cut, _ = blocks(turns, block)
    discard(spark, turns_path)
    found, nodes_path = nodes(cut, convs, block)
    linked, _ = stage_path(with_parents(found).withColumn("saved", (F.col("n") - 1) * F.col("chars"))
                           .withColumn("leaves", (F.col("kids") == 0).cast("long")), "trie-linked")
    discard(spark, nodes_path)
    sums = subtree_sums(linked, "leaves", "saved")
    zero = F.lit(0).cast("long")
    ends = cut.filter("last").select(
        (F.col("k") * block + F.size("a")).alias("depth"), F.element_at("a", -1).alias("a"), F.element_at("b", -1).alias("b"), "conv"
    ).unionByName(convs.filter("size = 0").select(zero.alias("depth"), zero.alias("a"), zero.alias("b"), "conv"))
    empty = hashlib.sha256(b"").hexdigest()
    return (linked.drop("leaves", "saved").join(sums, KEY).join(end_digests(ends), KEY, "left")
            .select(F.col("conv").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), F.col("n").alias("n_convs"),
                    F.col("kids").alias("n_children"), F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
                    F.coalesce("sha", F.lit(empty)).alias("ends_sha256")))
