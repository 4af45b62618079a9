"""Prefix trie of conversations, with subtree totals by time-forward
processing.

Conversations that begin alike share their first nodes. A node is known by
its depth and the polynomial hash (modulo 2^127 - 1) of its turns; a prefix
hash can be put together from blocks, so the turns are sorted by range and a
conversation that fills many ranges is hashed by many tasks. Texts move once,
in that sort; afterwards a turn is a row of a few numbers.

Subtree totals go from children to parents. Nodes that more than a bounded
share of the turns pass through form the top of the trie; below it hang light
subtrees, cut into bands of levels. Such a band below one node is a shard:
its nodes are sorted by descending level, and each node takes its children's
totals from a priority queue that spills to disk, adds its own and sends the
sum to its parent. Then the same runs over the shards' roots, band by band up
to the top, and over the top itself.
"""

from __future__ import annotations

import hashlib
import heapq
import os
import struct
import tempfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flatgate.llm.common import raw_texts, store, word_runs

PRIME = (1 << 127) - 1
MULTIPLIER = int.from_bytes(hashlib.sha256(b"conversation prefix").digest()[:15], "big")
SHARED = 3  # most turns that a rebuilt conversation takes from another one
FAMILY = 20
# The top holds nodes of more than LEAST_SHARE members, at most MOST_TOP of them.
LEAST_SHARE, MOST_TOP = 1024, 100_000
BAND = 1024  # levels of a shard
QUEUE = 200_000  # messages that a queue holds in memory
IDS_BITS = 12  # ids of one block of an end list: 2^12 at most
KEY = ["depth", "k1", "k2"]


def _halves(value: int) -> tuple[int, int]:
    """A hash as two signed 64-bit numbers."""
    low = value & 0xFFFFFFFFFFFFFFFF
    return value >> 64, low - (1 << 64) if low >> 63 else low


def _whole(high: int, low: int) -> int:
    return (high << 64) | (low & 0xFFFFFFFFFFFFFFFF)


def turn_hash(role: bytes, text: bytes) -> int:
    told = hashlib.blake2b(struct.pack("<q", len(role)) + role, digest_size=16)
    told.update(text)
    return int.from_bytes(told.digest(), "little") % PRIME


def _batches(rows: Iterator[tuple], names: list[str], kinds: list[pa.DataType], size: int = 8192) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held, strict=True), kinds, strict=True)], names=names)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held, strict=True), kinds, strict=True)], names=names)


def _columns(batch: pa.RecordBatch, *names: str) -> Iterator[tuple]:
    return zip(*[batch.column(n).to_pylist() for n in names], strict=True)


def _mapped(df: DataFrame, rows_of, ddl: str) -> DataFrame:
    """``df`` through ``rows_of`` (batches of a task -> rows as tuples)."""
    fields = [f.strip().split(" ") for f in ddl.split(",")]
    names = [n for n, _ in fields]
    kinds = [{"long": pa.int64(), "boolean": pa.bool_(), "string": pa.string(), "int": pa.int32()}[k] for _, k in fields]
    return df.mapInArrow(lambda batches: _batches(rows_of(batches), names, kinds), ddl)


# ---------------------------------------------------------------------------
# turns -> prefix hashes
# ---------------------------------------------------------------------------


def _block_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Sorted turns of one range -> (part, conv_id, i, hash of the prefix in
    the range, hash of the turn, words)."""
    conv, i, prefix, begun = None, 0, 0, False
    for batch in batches:
        roles, texts = raw_texts(batch.column("role")), raw_texts(batch.column("text"))
        for (part, c), role, text in zip(_columns(batch, "part", "conv_id"), roles, texts, strict=True):
            if not begun or c != conv:
                conv, i, prefix, begun = c, 0, 0, True
            x = turn_hash(role, text)
            prefix = (prefix * MULTIPLIER + x) % PRIME
            yield (part, c, i, *_halves(prefix), *_halves(x), sum(map(len, word_runs(text))))
            i += 1


def _block_offsets(table: pa.Table) -> pa.Table:
    """Blocks of one conversation (a row per range that it fills) -> turns
    and prefix hash before each block."""
    out, turns, prefix = [], 0, 0
    blocks = table.select(["conv_id", "part", "n", "q1", "q2"]).to_pylist()
    for b in sorted(blocks, key=lambda b: b["part"]):
        out.append((b["conv_id"], b["part"], turns, *_halves(prefix)))
        prefix = (prefix * pow(MULTIPLIER, b["n"], PRIME) + _whole(b["q1"], b["q2"])) % PRIME
        turns += b["n"]
    return pa.table([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], names=["o_conv", "o_part", "o_turns", "o1", "o2"])


def hashed_turns(conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                 text_col: str = "text") -> DataFrame:
    """``(part, conv_id, i, q1, q2, x1, x2, words)`` per turn, as a written
    table: its place in the conversation, the hash of the conversation up to
    it, its own hash and its words. Turns of one number are ordered by role
    and text."""
    turns = conversations.select(
        F.col(id_col).cast("long").alias("conv_id"), F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col), F.lit("")).alias("role"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    first = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first()]
    ranged = turns.repartitionByRange(*first).sortWithinPartitions(*first, "role", "text")
    ranged = ranged.select(F.spark_partition_id().cast("long").alias("part"), "conv_id", "role", "text")
    blocks_ddl = "part long, conv_id long, i long, q1 long, q2 long, x1 long, x2 long, words long"
    turns, _ = store(_mapped(ranged, _block_rows, blocks_ddl), "turns")
    # a conversation over several ranges: a row per range, at most two ranges' worth of such rows per range
    parts = turns.groupBy("conv_id").agg(F.min("part").alias("a"), F.max("part").alias("b")).filter("a < b").select(F.col("conv_id").alias("s_conv"))
    split = turns.join(F.broadcast(parts), F.col("conv_id").eqNullSafe(F.col("s_conv"))).drop("s_conv")
    blocks = split.groupBy("conv_id", "part").agg(F.count(F.lit(1)).alias("n"), F.max_by(F.struct("q1", "q2"), "i").alias("q"))
    offsets = blocks.select("conv_id", "part", "n", "q.q1", "q.q2").groupBy("conv_id").applyInArrow(
        _block_offsets, "o_conv long, o_part long, o_turns long, o1 long, o2 long")
    offsets, _ = store(offsets, "offsets")
    joined = turns.join(F.broadcast(offsets), F.col("conv_id").eqNullSafe(F.col("o_conv")) & (F.col("part") == F.col("o_part")), "left")

    def placed(batches):
        for batch in batches:
            for part, c, i, q1, q2, x1, x2, words, turns_before, o1, o2 in _columns(
                    batch, "part", "conv_id", "i", "q1", "q2", "x1", "x2", "words", "o_turns", "o1", "o2"):
                if turns_before:
                    q1, q2 = _halves((_whole(o1, o2) * pow(MULTIPLIER, i + 1, PRIME) + _whole(q1, q2)) % PRIME)
                yield part, c, i + (turns_before or 0), q1, q2, x1, x2, words

    if offsets.isEmpty():
        return turns
    return store(_mapped(joined, placed, blocks_ddl), "turns")[0]


# ---------------------------------------------------------------------------
# rebuilt conversations -> paths through the trie
# ---------------------------------------------------------------------------


def shared_turns(conv: Column) -> Column:
    """How many first turns a conversation takes from its family's first."""
    return F.pmod(F.crc32(F.coalesce(conv.cast("string"), F.lit("")).cast("binary")), F.lit(SHARED + 1)).cast("long")


PATH_DDL = "conv_id long, depth long, k1 long, k2 long, p1 long, p2 long, words long, ends boolean"


def trie_paths(turns: DataFrame) -> DataFrame:
    """A row per node on each rebuilt conversation's path, as a written
    table: ``PATH_DDL``, with the parent's hash and whether it ends there."""
    head = F.when(F.col("i") < SHARED, F.struct("i", "x1", "x2", "words"))
    convs = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("turns"), F.array_sort(F.collect_list(head)).alias("own"))
    convs = convs.withColumn("shared", shared_turns(F.col("conv_id")))
    family = F.col("conv_id") - F.col("conv_id") % FAMILY
    bases = convs.filter(F.col("conv_id") == family).select(F.col("conv_id").alias("b_conv"), F.col("own").alias("base"))
    convs = convs.join(bases, family == F.col("b_conv"), "left")

    def heads(batches):
        """(…path row…, adjustment, turns of the base, its own path or the root's)"""
        for batch in batches:
            for c, n, own, shared, base in _columns(batch, "conv_id", "turns", "own", "shared", "base"):
                base = (base or [])[:shared]
                replaced = 0
                for t in own[:shared]:
                    replaced = (replaced * MULTIPLIER + _whole(t["x1"], t["x2"])) % PRIME
                prefix, above = 0, (0, 0)
                over = n <= shared
                rows = [(0, (0, 0), (0, 0), 0)]
                for d, t in enumerate(base, 1):
                    prefix = (prefix * MULTIPLIER + _whole(t["x1"], t["x2"])) % PRIME
                    rows.append((d, _halves(prefix), above, t["words"]))
                    above = _halves(prefix)
                adjust = _halves((prefix - replaced) % PRIME)
                for d, key, parent, words in rows:
                    last = d == len(base)
                    yield (c, d, *key, *parent, words, over and last, *adjust, len(base), n, shared, last)

    firsts, _ = store(_mapped(convs, heads, PATH_DDL + ", a1 long, a2 long, base long, turns long, shared long, last boolean"), "heads")
    one = firsts.filter("last").select(F.col("conv_id").alias("c_conv"), "a1", "a2", "base", "turns", "shared")
    rest = turns.join(one, F.col("conv_id").eqNullSafe(F.col("c_conv"))).filter("i >= shared")
    back = pow(MULTIPLIER, -1, PRIME)

    def own_rows(batches):
        for batch in batches:
            for c, i, q1, q2, x1, x2, words, a1, a2, base, n, shared in _columns(
                    batch, "conv_id", "i", "q1", "q2", "x1", "x2", "words", "a1", "a2", "base", "turns", "shared"):
                k = (_whole(q1, q2) + _whole(a1, a2) * pow(MULTIPLIER, i + 1 - shared, PRIME)) % PRIME
                parent = (k - _whole(x1, x2)) * back % PRIME
                yield (c, base + i - shared + 1, *_halves(k), *_halves(parent), words, i == n - 1)

    columns = [f.strip().split(" ")[0] for f in PATH_DDL.split(",")]
    return store(firsts.select(*columns).unionByName(_mapped(rest, own_rows, PATH_DDL)), "paths")[0]


# ---------------------------------------------------------------------------
# time-forward processing
# ---------------------------------------------------------------------------


def spill_folder() -> str | None:
    """One of the executor's spill folders (``spark.local.dir``), which Spark
    names to its Python workers; None outside of them."""
    folders = [f for f in os.environ.get("SPARK_LOCAL_DIRS", "").split(",") if os.path.isdir(f)]
    return folders[os.getpid() % len(folders)] if folders else None


class SpillingQueue:
    """Priority queue of fixed-size messages: ``limit`` of them in memory,
    the rest in sorted runs where Spark itself spills (a run belongs to one
    task attempt; a task that is run again writes its own)."""

    RECORD = struct.Struct("<qqqqqq")  # order (3), values (3)

    def __init__(self, limit: int = QUEUE):
        self.limit = limit
        self.heap: list[tuple] = []
        self.heads: list[tuple] = []  # (message, run)
        self.runs: list[Iterator[tuple]] = []

    def push(self, order: tuple, values: tuple) -> None:
        heapq.heappush(self.heap, order + values)
        if len(self.heap) > self.limit:
            self._spill()

    def _spill(self) -> None:
        run = self._run(sorted(self.heap))
        self.heap = []
        self.runs.append(run)
        heapq.heappush(self.heads, (next(run), len(self.runs) - 1))

    def _run(self, messages: list[tuple]) -> Iterator[tuple]:
        pack, size = self.RECORD.pack, self.RECORD.size
        file = tempfile.TemporaryFile(dir=spill_folder())
        for m in messages:
            file.write(pack(*m))
        file.seek(0)

        def read():
            with file:
                while block := file.read(size * 1024):
                    yield from self.RECORD.iter_unpack(block)

        return read()

    def take(self, order: tuple) -> tuple[int, int, int]:
        """Sum of the values of all messages with ``order``, which no
        message in the queue comes before."""
        a = b = c = 0
        while True:
            in_memory = self.heap[0] if self.heap else None
            on_disk = self.heads[0][0] if self.heads else None
            least = min((m for m in (in_memory, on_disk) if m is not None), default=None)
            if least is None or least[:3] != order:
                if least is not None and least[:3] < order:
                    raise ValueError(f"a message to {least[:3]} met no node")
                return a, b, c
            if least is in_memory:
                heapq.heappop(self.heap)
            else:
                _, run = heapq.heappop(self.heads)
                if (following := next(self.runs[run], None)) is not None:
                    heapq.heappush(self.heads, (following, run))
            a, b, c = a + least[3], b + least[4], c + least[5]

    def __bool__(self) -> bool:
        return bool(self.heap or self.heads)


FORWARD_DDL = "depth long, k1 long, k2 long, n_children long, n_leaves long, saved long"


def forward(nodes: DataFrame, messages: DataFrame | None = None, limit: int = QUEUE) -> DataFrame:
    """Totals of every node, its subtree within the shard included
    (``FORWARD_DDL``).

    ``nodes``: shard (s1, s2), depth, k1, k2, parent's p1, p2, own values
    ``n_leaves`` and ``saved``, ``root`` for a node whose parent is not in
    the shard. ``messages``: what comes from other shards, the same columns
    without parent and root, ``n_children`` beside them."""
    kinds = {"n_children": 0, "n_leaves": 0, "saved": 0, "p1": 0, "p2": 0}
    columns = ["s1", "s2", *KEY, *kinds, "root", "node"]
    rows = nodes.withColumns({"n_children": F.lit(0).cast("long"), "node": F.lit(True)}).select(*columns)
    if messages is not None:
        sums = messages.groupBy("s1", "s2", *KEY).agg(*[F.sum(c).alias(c) for c in ("n_children", "n_leaves", "saved")])
        sums = sums.withColumns({"p1": F.lit(0).cast("long"), "p2": F.lit(0).cast("long"), "root": F.lit(False), "node": F.lit(False)})
        rows = rows.unionByName(sums.select(*columns))
    ordered = rows.repartition("s1", "s2").sortWithinPartitions("s1", "s2", F.col("depth").desc(), "k1", "k2", "node")

    def passes(batches):
        queue, shard, outside = SpillingQueue(limit), None, (0, 0, 0)
        for batch in batches:
            for s1, s2, depth, k1, k2, children, leaves, saved, p1, p2, root, node in _columns(batch, *columns):
                if shard != (s1, s2):
                    if queue:
                        raise ValueError("messages are left at the end of a shard")
                    shard = (s1, s2)
                if not node:  # comes before its node
                    outside = (children, leaves, saved)
                    continue
                got = queue.take((-depth, k1, k2))
                children, leaves, saved = (x + y + z for x, y, z in zip((children, leaves, saved), got, outside, strict=True))
                outside = (0, 0, 0)
                yield depth, k1, k2, children, leaves, saved
                if not root:
                    queue.push((1 - depth, p1, p2), (1, leaves, saved))
        if queue:
            raise ValueError("messages are left at the end of a shard")

    return _mapped(ordered, passes, FORWARD_DDL)


def trie_nodes(paths: DataFrame) -> DataFrame:
    """A row per node, as a written table: smallest member, members, those
    that end there, words of its last turn, the parent's hash."""
    return store(paths.groupBy(*KEY).agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.count_if("ends").alias("n_ends"),
        F.max("words").alias("words"), F.min("p1").alias("p1"), F.min("p2").alias("p2")), "nodes")[0]


def subtree_totals(nodes: DataFrame, paths: DataFrame, least_share: int = LEAST_SHARE, most_top: int = MOST_TOP,
                   band: int = BAND, limit: int = QUEUE) -> DataFrame:
    """``FORWARD_DDL`` of every node: children, childless nodes and saved
    words of its subtree."""
    spark = nodes.sparkSession
    nodes = nodes.withColumns({
        "n_leaves": (F.col("n_convs") == F.col("n_ends")).cast("long"), "saved": (F.col("n_convs") - 1) * F.col("words")})
    passing = nodes.agg(F.sum("n_convs").alias("n")).first()["n"] or 0
    share = max(least_share, passing // most_top + 1)  # so at most most_top nodes lie above it
    heavy = (F.col("n_convs") > share) | (F.col("depth") == 0)
    # where each conversation leaves the top, and its nodes at the bands' first levels
    top = nodes.filter(heavy).select(*KEY, F.lit(True).alias("in_top"))
    off = paths.join(F.broadcast(top), KEY, "left").groupBy("conv_id").agg(
        F.min(F.when(F.col("in_top").isNull(), F.col("depth"))).alias("below"))
    off, _ = store(off.filter("below IS NOT NULL").select(F.col("conv_id").alias("f_conv"), "below"), "leaving")
    level = F.col("depth") - F.col("below")
    firsts = paths.join(off, F.col("conv_id").eqNullSafe(F.col("f_conv"))).filter((level >= 0) & (level % band == 0))
    firsts, _ = store(firsts.select(F.col("conv_id").alias("r_conv"), (level / band).cast("long").alias("r_band"),
                                    F.col("depth").alias("r_depth"), F.col("k1").alias("s1"), F.col("k2").alias("s2")), "bands")
    light = nodes.filter(~heavy).join(off, F.col("conv_id").eqNullSafe(F.col("f_conv"))).withColumn("band", F.floor(level / band).cast("long"))
    light = light.join(firsts, F.col("conv_id").eqNullSafe(F.col("r_conv")) & (F.col("band") == F.col("r_band")))
    light, _ = store(light.select(
        *KEY, "p1", "p2", "n_leaves", "saved", "conv_id", "band", "s1", "s2", (F.col("depth") == F.col("r_depth")).alias("root")), "light")
    within, _ = store(forward(light, limit=limit), "within")
    roots = light.filter("root").select(*KEY, "p1", "p2", "conv_id", "band")
    if not roots.filter("band > 0").isEmpty():
        # the shards' roots as a trie of their own, by light subtree: its parent is the root of the band above
        above = firsts.select(F.col("r_conv").alias("a_conv"), (F.col("r_band") + 1).alias("a_band"), F.col("s1").alias("u1"), F.col("s2").alias("u2"))
        tops = firsts.filter("r_band = 0").select(F.col("r_conv").alias("t_conv"), F.col("s1").alias("t1"), F.col("s2").alias("t2"))
        chained = roots.join(within, KEY).join(
            above, F.col("conv_id").eqNullSafe(F.col("a_conv")) & (F.col("band") == F.col("a_band")), "left").join(
            tops, F.col("conv_id").eqNullSafe(F.col("t_conv")))
        chained, _ = store(chained, "chained")
        across = forward(chained.select(
            F.col("t1").alias("s1"), F.col("t2").alias("s2"), F.col("band").alias("depth"), "k1", "k2",
            F.coalesce("u1", F.lit(0)).alias("p1"), F.coalesce("u2", F.lit(0)).alias("p2"), "n_leaves", "saved",
            (F.col("band") == 0).alias("root")), limit=limit)
        across, _ = store(across.select(F.col("depth").alias("band"), "k1", "k2", "n_leaves", "saved"), "across")
        whole = chained.select(*KEY, "p1", "p2", "band", "u1", "u2").join(across, ["band", "k1", "k2"])
        below = whole.filter("band > 0").select(
            F.col("u1").alias("s1"), F.col("u2").alias("s2"), (F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"),
            F.col("p2").alias("k2"), F.lit(1).cast("long").alias("n_children"), "n_leaves", "saved")
        within, _ = store(forward(light, below, limit), "within")
    # the top: at most most_top nodes, and a sum for each of them from the light subtrees
    zero = {"s1": F.lit(0).cast("long"), "s2": F.lit(0).cast("long")}
    arriving = roots.filter("band = 0").join(within, KEY).select(
        (F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2"),
        F.lit(1).cast("long").alias("n_children"), "n_leaves", "saved").withColumns(zero)
    crown = nodes.filter(heavy).withColumns({**zero, "root": F.col("depth") == 0})
    return within.unionByName(forward(crown, arriving, limit))


# ---------------------------------------------------------------------------
# members that end at a node
# ---------------------------------------------------------------------------


def end_digests(paths: DataFrame) -> DataFrame:
    """``(depth, k1, k2, ends_sha256)`` of the nodes at which conversations
    end: SHA-256 of their ids, ascending, joined by commas. Ids are sorted
    and joined in blocks of nearby ids; the digest reads a node's blocks in
    order and holds one at a time. A null id is left out."""
    ends = paths.filter("ends AND conv_id IS NOT NULL").select(*KEY, "conv_id", F.shiftright("conv_id", IDS_BITS).alias("block"))
    ids = F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string"))
    blocks = ends.groupBy(*KEY, "block").agg(F.array_join(ids, ",").alias("ids"))
    ordered = blocks.repartition(*KEY).sortWithinPartitions(*KEY, "block")

    def digests(batches):
        node, told = None, None
        for batch in batches:
            for depth, k1, k2, ids in _columns(batch, *KEY, "ids"):
                if node != (depth, k1, k2):
                    if node:
                        yield (*node, told.hexdigest())
                    node, told = (depth, k1, k2), hashlib.sha256()
                else:
                    told.update(b",")
                told.update(ids.encode())
        if node:
            yield (*node, told.hexdigest())

    return _mapped(ordered, digests, "depth long, k1 long, k2 long, ends_sha256 string")


def prefix_trie(conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                text_col: str = "text", **sizes) -> DataFrame:
    """``(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256)`` per node of the trie of rebuilt
    conversations.

    A conversation is rebuilt from the first h turns (h: crc32 of its id
    modulo 4) of the conversation whose id is the next lower multiple of 20
    (as division leaves it for negative ids), followed by its own turns
    after its first h. Null turn numbers come first, turns of one number in
    the order of role and text; a null role or text is empty. Rows without
    an id are one conversation, which takes no turns from others, counts as
    a member, is never the smallest one beside others and is left out of
    ``ends_sha256``. Other columns are ignored; an empty table gives an
    empty result (no root).
    """
    turns = hashed_turns(conversations, id_col, turn_col, role_col, text_col)
    paths = trie_paths(turns)
    nodes = trie_nodes(paths)
    totals, _ = store(subtree_totals(nodes, paths, **sizes), "totals")
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    rows = nodes.select(*KEY, "p1", "p2", "conv_id", "n_convs").join(totals, KEY)
    rows = rows.join(end_digests(paths), KEY, "left").join(parents, ["depth", "p1", "p2"], "left")
    return rows.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))
