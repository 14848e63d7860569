"""Prefix trie of conversations from the common prefixes of sorted neighbours.

Distinct conversations are sorted by the digests of their turns.  Within a sorted run the number
of turns that neighbours share is an edge between them; edges are taken deepest first, a
union-find joins the runs at their ends, and every merge is a branching node (or one more child
of it).  Nodes that a run shares with its neighbours in other partitions stay open: the run's
forest is contracted to its share of them, and shares of one node are summed across partitions.
A node's own term is counted by the partition in which the node begins, so all sums add up.

No conversation has to fit a row: turns are numbered by place in a sorted table, and a
conversation is cut into segments of SEGMENT turns, each a word of a trie of its own that starts
where the segment before it ended.  Totals of such tries go up by pointer doubling.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postlytics.llm.common import pick, written

#: A conversation takes up to 3 turns of the one whose id is divisible by BLOCK.
BLOCK, HEADS = 20, 4
#: Turns of a segment; distinct segments of a sorted partition, about.
SEGMENT, PART_ROWS = 256, 20_000
#: Bytes of joined ids that are hashed at once.
CHUNK = 1 << 16
TOP = bytes(16)
NO_ENDS = hashlib.sha256(b"").hexdigest()
SPACE = r"[\x20\x09-\x0D]+"


# ------------------------------------------------------------------ turns and segments


def _places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of a sorted partition with their place among the conversation's rows in it."""
    part, last, seen = TaskContext.get().partitionId(), None, 0
    for b in batches:
        if not b.num_rows:
            continue
        conv = b.column("conv_id").to_numpy()
        first = np.concatenate([[0], np.flatnonzero(np.diff(conv)) + 1])
        place = np.arange(len(conv)) - np.repeat(first, np.diff([*first, len(conv)]))
        if conv[0] == last:
            place[:first[1] if len(first) > 1 else len(conv)] += seen
        last, seen = conv[-1], int(place[-1]) + 1
        yield pa.RecordBatch.from_arrays(
            [*map(b.column, ("conv_id", "digest", "words")), pa.array(place), pa.array(np.full(len(conv), part, np.int32))],
            names=["conv_id", "digest", "words", "place", "part"])


def turns(df: DataFrame) -> DataFrame:
    """(conv_id, at, digest, words) of every row with a conv_id: its number from 0 in its
    conversation, by turn (null first) and then digest; the digest of role and text (null:
    empty) as 32 hex digits; the words of the text."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = pick(df, "conv_id", "turn", "role", "text").where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn",
        F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)).alias("digest"),
        F.size(F.array_remove(F.split(text, SPACE), "")).alias("words"),
        F.monotonically_increasing_id().alias("any"))  # lets the range split rows that are equal
    keys = ("conv_id", "turn", "digest", "any")
    rows = (rows.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("turn", "any")
            .mapInArrow(_places, "conv_id long, digest string, words int, place long, part int"))
    rows = written(rows, "trie-turns")
    counts = rows.groupBy("conv_id", "part").agg(F.count(F.lit(1)).alias("c"))
    before = F.sum("c").over(Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    later = counts.select("conv_id", "part", before.alias("before")).where("before > 0")
    # a sorted partition continues at most one conversation: at most one row a partition
    return (rows.join(F.broadcast(later), ["conv_id", "part"], "left")
            .select("conv_id", (F.col("place") + F.coalesce("before", F.lit(0))).alias("at"), "digest", "words"))


def rebuilt(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns (conv_id, n, at, digest, words) of the rebuilt conversations, and (conv_id, n).

    With h the crc32 of the decimal id modulo HEADS, a conversation takes the first h turns of
    the one whose id is divisible by BLOCK, and goes on with its own turns after its first h.
    """
    own = turns(df)
    head = (F.crc32(F.encode(F.col("conv_id").cast("string"), "UTF-8")) % HEADS).cast("int")
    firsts = (own.where((F.col("conv_id") % BLOCK == 0) & (F.col("at") < HEADS - 1)).groupBy("conv_id")
              .agg(F.sort_array(F.collect_list(F.struct("at", "digest", "words"))).alias("firsts"))
              .withColumnRenamed("conv_id", "giver"))
    convs = own.groupBy("conv_id").agg(F.count(F.lit(1)).alias("own")).withColumn("head", head)
    given = F.coalesce(F.slice("firsts", F.lit(1), F.col("head")), F.expr("slice(firsts, 1, 0)"))
    convs = (convs.withColumn("giver", F.col("conv_id") - F.col("conv_id") % BLOCK).join(firsts, "giver", "left")
             .withColumn("given", given).withColumn("got", F.greatest(F.size("given"), F.lit(0)))
             .select("conv_id", "head", "given", "got",
                     (F.greatest(F.col("own") - F.col("head"), F.lit(0)) + F.col("got")).alias("n")))
    convs = written(convs, "trie-conversations")
    kept = (own.where(F.col("at") >= head).join(convs.select("conv_id", "head", "got", "n"), "conv_id")
            .select("conv_id", "n", (F.col("at") - F.col("head") + F.col("got")).alias("at"), "digest", "words"))
    taken = (convs.select("conv_id", "n", F.inline("given"))
             .select("conv_id", "n", F.col("at").cast("long"), "digest", "words"))
    return kept.unionByName(taken), convs.select("conv_id", "n")


def _starts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The node each segment starts at; rows sorted by conversation and segment."""
    last, start = None, TOP
    for b in batches:
        out = []
        for conv, digest in zip(b.column("conv_id").to_pylist(), b.column("digest").to_pylist()):
            start = start if conv == last else TOP
            out.append(start)
            last, start = conv, hashlib.md5(start + digest).digest()
        yield pa.RecordBatch.from_arrays([b.column("conv_id"), b.column("seg"), pa.array(out, pa.binary())],
                                         names=["conv_id", "seg", "start"])


def _bytes_md5(c):
    return F.unhex(F.md5(c))


def segments(df: DataFrame, length: int = SEGMENT) -> DataFrame:
    """(conv_id, seg, start, path, words, more, node): the segments of the rebuilt conversations.

    path holds 16 bytes a turn, words the words of each, start names the node the segment starts
    at and node the one it ends at; more: the conversation goes on.  One without turns has one
    empty segment.
    """
    rows, convs = rebuilt(df)
    seg = (F.col("at") / length).cast("long")
    turn = F.sort_array(F.collect_list(F.struct("at", "digest", "words")))
    segs = rows.groupBy("conv_id", "n", seg.alias("seg")).agg(turn.alias("t")).select(
        "conv_id", "n", "seg", F.unhex(F.array_join("t.digest", "")).alias("path"), F.col("t.words").alias("words"))
    empty = convs.where("n = 0").select("conv_id", "n", F.lit(0).cast("long").alias("seg"),
                                        F.lit(b"").alias("path"), F.expr("cast(array() as array<int>)").alias("words"))
    segs = written(segs.unionByName(empty).withColumn("more", (F.col("seg") + 1) * length < F.col("n")), "trie-segments")
    start = F.lit(TOP)
    if not segs.where("more").isEmpty():
        long = (segs.where(F.col("n") > length).select("conv_id", "seg", _bytes_md5("path").alias("digest"))
                .repartition("conv_id").sortWithinPartitions("conv_id", "seg")
                .mapInArrow(_starts, "conv_id long, seg long, start binary"))
        segs, start = segs.join(long, ["conv_id", "seg"], "left"), F.coalesce("start", start)
    segs = segs.withColumn("start", start)
    return written(segs.withColumn("node", _bytes_md5(F.concat("start", _bytes_md5("path")))).drop("n"), "trie-words")


# ------------------------------------------------------------------ who ends where


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, first, ids): ids of one node in a sorted partition, comma-joined, some CHUNK bytes a row."""
    node, ids, size = None, [], 0

    def out():
        return pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([ids[0]], pa.int64()),
                                           pa.array([",".join(map(str, ids))])], names=["node", "first", "ids"])

    for b in batches:
        for k, c in zip(b.column("node").to_pylist(), b.column("conv_id").to_pylist()):
            if ids and (k != node or size > CHUNK):
                yield out()
                ids, size = [], 0
            node = k
            ids.append(c)
            size += 12
    if ids:
        yield out()


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, ends) of chunks sorted by node and first id: one running SHA-256, so a node that a
    third of all conversations end at streams through in bounded memory."""
    node, sha = None, None
    for b in batches:
        nodes, ends = [], []
        for k, ids in zip(b.column("node").to_pylist(), b.column("ids").to_pylist()):
            if k != node:
                if sha:
                    nodes.append(node)
                    ends.append(sha.hexdigest())
                node, sha = k, hashlib.sha256(ids.encode())
            else:
                sha.update(b"," + ids.encode())
        yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.binary()), pa.array(ends, pa.string())], names=["node", "ends"])
    if sha:
        yield pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([sha.hexdigest()])], names=["node", "ends"])


def ends(segs: DataFrame) -> DataFrame:
    """(node, ends): SHA-256 of the ascending ids of the conversations that end at a node."""
    ids = segs.where("not more").select("node", "conv_id")
    chunks = (ids.repartitionByRange("node", "conv_id").sortWithinPartitions("node", "conv_id")
              .mapInArrow(_joined, "node binary, first long, ids string"))
    return (chunks.repartition("node").sortWithinPartitions("node", "first")
            .mapInArrow(_hashed, "node binary, ends string"))


# ------------------------------------------------------------------ the forest of a sorted partition


def common(a: tuple[bytes, bytes], b: tuple[bytes, bytes]) -> int:
    """Turns that two (start, path) words share, -1 if they start at different nodes."""
    if a[0] != b[0]:
        return -1
    p, q, d = a[1], b[1], 0
    while p[d:d + 16] == q[d:d + 16] != b"":
        d += 16
    return d // 16


NODES = pa.schema([("id", pa.binary()), ("parent_id", pa.binary()), ("conv_id", pa.int64()), ("depth", pa.int64()),
                   ("parent", pa.int64()), ("n_convs", pa.int64()), ("n_children", pa.int64()), ("n_leaves", pa.int64()),
                   ("saved_tokens", pa.int64()), ("ends", pa.string())])


class Forest:
    """The nodes of one sorted partition.

    Nodes 0 to m - 1 are the words themselves, further ones are made by merges.  `left` and
    `right` are the turns that the first and last word share with the partitions beside.
    """

    def __init__(self, rows: list[dict], left: int, right: int):
        self.rows, self.left, self.right = rows, left, right
        m = len(rows)
        self.depth = [len(r["path"]) // 16 for r in rows]
        self.word = list(range(m))                       # a word that holds the node's path
        self.n = [r["n"] for r in rows]
        self.low = [r["low"] for r in rows]
        self.kids, self.leaves, self.saved = [0] * m, [r["leaves"] for r in rows], [r["saved"] for r in rows]
        self.id: list[bytes | None] = [None] * m         # of nodes that others may add to
        self.out: list[list] = []                        # rows of NODES, the parent's node in place of its id

    def node(self, depth: int, word: int) -> int:
        for column, value in ((self.depth, depth), (self.word, word), (self.n, 0), (self.low, None), (self.kids, 0),
                              (self.leaves, 0), (self.saved, 0), (self.id, None)):
            column.append(value)
        return len(self.n) - 1

    def name(self, word: int, depth: int) -> bytes:
        r = self.rows[word]
        if depth == 0 and r["base"]:
            return r["start"]                            # the node that the segment before ended at
        return hashlib.md5(r["start"] + hashlib.md5(r["path"][:16 * depth]).digest()).digest()

    def attach(self, v: int, first: int, last: int, parent: int) -> None:
        """Node v, which covers words first to last, goes below a parent; all depths between are out."""
        m, r = len(self.rows), self.rows[self.word[v]]
        own = v < m
        if own and not self.kids[v] and not r["more"] and not (v == m - 1 and self.right >= self.depth[v]):
            self.leaves[v] += 1
        kids, saved, below = self.kids[v], self.saved[v], None
        for t in range(self.depth[v], self.depth[parent], -1):
            begins = not (first == 0 and t <= self.left)
            is_open = not begins or (last == m - 1 and t <= self.right) or (own and t == self.depth[v] and r["more"])
            saved += (self.n[v] - begins) * r["words"][t - 1]
            ident = self.name(self.word[v], t) if is_open else None
            if below is None:
                self.id[v] = ident
            else:
                below[1], below[4] = ident, None if ident else self.low[v]
            below = [ident, parent, self.low[v], r["base"] + t, None, self.n[v], kids, self.leaves[v], saved,
                     r["ends"] if own and t == self.depth[v] else None]
            self.out.append(below)
            kids = int(begins)
        self.n[parent] += self.n[v]
        self.low[parent] = self.low[v] if self.low[parent] is None else min(self.low[parent], self.low[v])
        self.kids[parent] += kids
        self.leaves[parent] += self.leaves[v]
        self.saved[parent] += saved

    def build(self, totals: bool) -> pa.RecordBatch:
        rows, m = self.rows, len(self.rows)
        edges = sorted((-common((a["start"], a["path"]), (b["start"], b["path"])), i + 1)
                       for i, (a, b) in enumerate(zip(rows, rows[1:])))
        root, last, top = list(range(m)), list(range(m)), list(range(m))  # of a run, by its first word

        def find(i: int) -> int:
            while root[i] != i:
                root[i] = i = root[root[i]]
            return i

        for depth, i in edges:
            if depth > 0:
                break                                    # of different tries
            a, b = find(i - 1), i
            if self.depth[top[a]] > -depth:
                joint = self.node(-depth, self.word[top[a]])
                self.attach(top[a], a, last[a], joint)
                top[a] = joint
            self.attach(top[b], b, last[b], top[a])
            root[b], last[a] = a, last[b]
        for a in range(m):
            if root[a] == a:
                self.finish(a, last[a], top[a], totals)
        for r in self.out:
            if r[1] is not None and not isinstance(r[1], bytes):
                p = r[1]
                r[1], r[4] = self.id[p], None if self.id[p] else self.low[p]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*self.out), NODES)], schema=NODES) \
            if self.out else pa.RecordBatch.from_pylist([], schema=NODES)

    def finish(self, first: int, last: int, v: int, totals: bool) -> None:
        """The trie's root, always open: below another trie it only adds its children there."""
        if self.depth[v]:
            r = self.node(0, self.word[v])
            self.attach(v, first, last, r)
        else:
            r = v
            if v < len(self.rows) and not self.kids[v] and not (v == len(self.rows) - 1 and self.right >= 0):
                self.leaves[v] += 1
        word = self.rows[self.word[r]]
        self.id[r] = self.name(self.word[r], 0)
        inner = word["base"] > 0
        if not totals or inner:
            sums = [self.leaves[r], self.saved[r]] if totals or not inner else [0, 0]
            self.out.append([self.id[r], None, None if inner else self.low[r], word["base"], None, 0 if inner else self.n[r],
                             self.kids[r], *sums, word["ends"] if r < len(self.rows) else None])
        if totals:
            self.out = [x for x in self.out if x[0] is not None and x[2] is None]


def _forest(shared, totals: bool):
    def run(table: pa.Table) -> pa.Table:
        part = table.column("part")[0].as_py()
        rows = sorted(table.drop_columns(["part"]).to_pylist(), key=lambda r: (r["start"], r["path"]))
        return pa.Table.from_batches([Forest(rows, *shared.value[part]).build(totals)])
    return run


SQL_NODES = ("id binary, parent_id binary, conv_id long, depth long, parent long, n_convs long, n_children long, "
             "n_leaves long, saved_tokens long, ends string")


def _neighbours(words: DataFrame) -> dict[int, tuple[int, int]]:
    """Turns that each sorted partition shares with the one before and after it; the first and last
    words pass through the driver one at a time, two numbers a partition stay."""
    key = F.struct("start", "path")
    edges = words.groupBy("part").agg(F.min(key).alias("a"), F.max(key).alias("z")).orderBy("part")
    shared: dict[int, list[int]] = {}
    before, z = None, None
    for r in edges.toLocalIterator():
        a = (bytes(r.a.start), bytes(r.a.path))
        d = -1 if before is None else common(z, a)
        if before is not None:
            shared[before][1] = d
        shared[r.part] = [d, -1]
        before, z = r.part, (bytes(r.z.start), bytes(r.z.path))
    return {k: tuple(v) for k, v in shared.items()}


def _totals(forest: DataFrame, words: DataFrame) -> DataFrame:
    """(node, leaves, saved) of the tries that start at nodes: their own sums and those of all
    tries below them, which go 1, 2, 4, ... tries up, so rounds grow with the logarithm of depth."""
    own = forest.groupBy("id").agg(F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved"))
    up = F.when(F.col("base") > 0, F.col("start"))
    tries = written(words.where("more").select(F.col("node").alias("id"), up.alias("up")).join(own, "id"), "trie-totals")
    while not tries.where("up is not null").isEmpty():
        sent = (tries.where("up is not null").groupBy(F.col("up").alias("id"))
                .agg(F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved")))
        higher = tries.select(F.col("id").alias("up"), F.col("up").alias("up2"))
        tries = tries.join(sent, "id", "left").join(higher, "up", "left").select(
            "id", F.col("up2").alias("up"), (F.col("leaves") + F.coalesce("more_leaves", F.lit(0))).alias("leaves"),
            (F.col("saved") + F.coalesce("more_saved", F.lit(0))).alias("saved"))
        tries = written(tries, "trie-totals")
    return tries.select(F.col("id").alias("node"), "leaves", "saved")


def trie(df: DataFrame, length: int = SEGMENT, part_rows: int = PART_ROWS) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 per
    node of the trie of the rebuilt conversations (see rebuilt).

    Null role and text are empty, null turns come first, rows of one turn are ordered by the
    digest of role and text, and repeated rows are turns of their own.  Rows with a null conv_id
    belong to no conversation and are left out.  An empty table has no conversation and gives no
    row, not even a root.
    """
    spark = df.sparkSession
    segs = segments(df, length)
    words = segs.groupBy("seg", "start", "path", "words", "node").agg(
        F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("low"), F.max("more").alias("more"))
    words = words.join(ends(segs), "node", "left").withColumn("base", F.col("seg") * length).drop("seg")
    words = written(words, "trie-distinct")
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-words.count() // part_rows))
    words = written(words.repartitionByRange(parts, "start", "path").withColumn("part", F.spark_partition_id()), "trie-sorted")
    shared = spark.sparkContext.broadcast(_neighbours(words))  # two numbers a partition

    def forest(rows: DataFrame, totals: bool) -> DataFrame:
        rows = rows.select("part", "start", "path", "words", "base", "n", "low", "more", "ends", "leaves", "saved")
        return rows.groupBy("part").applyInArrow(_forest(shared, totals), SQL_NODES)

    nothing = {"leaves": F.lit(0).cast("long"), "saved": F.lit(0).cast("long")}
    if words.where("more").isEmpty():
        words = words.withColumns(nothing)
    else:
        below = _totals(forest(words.withColumns(nothing), True), words)
        words = words.join(below, "node", "left").fillna(0, ["leaves", "saved"])
    nodes = written(forest(words, False), "trie-nodes")
    joint = nodes.where("id is not null").groupBy("id").agg(
        F.max("parent_id").alias("parent_id"), F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"),
        F.max("parent").alias("parent"), *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
        F.max("ends").alias("ends"))
    joint = written(joint, "trie-joint")
    whole = nodes.where("id is null").unionByName(joint).drop("id")
    lows = joint.select(F.col("id").alias("parent_id"), F.col("conv_id").alias("joint_low"))
    return whole.join(lows, "parent_id", "left").select(
        "conv_id", "depth", F.coalesce("joint_low", "parent").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves",
        "saved_tokens", F.coalesce("ends", F.lit(NO_ENDS)).alias("ends_sha256"))
