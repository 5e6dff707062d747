"""The trie of conversation prefixes, as a table of nodes.

**Prefix digests.** The digest of a prefix is the sum of hashes of its turns,
each taken with its place: 128 bits. A running sum splits into blocks, so a
conversation of any length is many tasks and nothing is chained. Distinct
digests are counted by Spark, partial counts first: a node's members, its
least member, its place and words. All members of a node must agree on the
digest of their parent and on the hash of their last turn, which (from the
root on) makes equal digests equal prefixes; a collision fails the job.

**Runs.** Nodes on a path with the same members form a run, so only the last
node of a run is a node of the table that sums over subtrees; it is known by
its least member and the number of members. A node of one member has one
leaf and saves nothing, so runs of one member are not in that table either.

**Slots.** Runs go to shards by their least member, each with the runs above
it. A shard takes its distinct digests, gives each a slot by a minimal
perfect hash that is verified against the stored keys, scatters counts and
weights into flat arrays by slot, finds the parent slots by lookup and adds
up from the deepest runs to the root. A run that lies in several shards
counts its own share in one of them (that of its least member), so the sums
of the shards, added up, are the sums of the subtrees.

The conversations that end at a node are hashed in order from pieces: their
ids are sorted over many tasks, each writes its part of the text, and one
task a node only feeds the parts to the hash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from topicframe.llm.common import checkpointed, read_table
from topicframe.llm.perfect_hash import PerfectHash
from topicframe.plans.numbering import number_rows

WORD = r"[^\x20\x09-\x0D]+"
#: Turns of a conversation that one task adds up.
BLOCK_TURNS = 4096
#: Conversations that share a base conversation's first turns.
FAMILY = 20
#: Most turns that are taken from a base conversation.
MOST_SHARED = 3
#: Ids of a node that are one piece of its text.
PIECE_IDS = 4096


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, pos (from 0), turn_md5, words of every turn of ``conversations`` (conv_id, turn, role, text).

    Turns are in the order of ``turn``, nulls first, ties by the md5 of role
    and text; null roles and texts are empty. Rows without a conv_id belong
    to no conversation and are left out. Repeated rows are turns of their own.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    light = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"),
        F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary")).alias("turn_md5"),
        F.regexp_count(text, F.lit(WORD)).cast("bigint").alias("words"),
    )
    return number_rows(light, ["conv_id"], ["turn", "turn_md5"], "pos").select("conv_id", "pos", "turn_md5", "words")


def graft(turns: DataFrame) -> DataFrame:
    """Every conversation c of ``turns`` (conv_id, pos and others) rebuilt: the first h turns of
    c - c % 20, then its own after its first h; h is crc32 of the decimal c, modulo 4.

    A base conversation that is absent gives none. At most 39 conversations
    have one base (those around 0), each takes at most 3 of its turns.
    """
    shared = F.crc32(F.col("conv_id").cast("string").cast("binary")) % (MOST_SHARED + 1)
    rest = [c for c in turns.columns if c not in ("conv_id", "pos")]
    convs = turns.groupBy("conv_id").agg(F.count("*").alias("n"))
    heads = turns.where(F.col("pos") < MOST_SHARED)
    own = convs.select("conv_id", shared.alias("h"), (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("base"))
    length = convs.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"))
    own = own.join(length, "base", "left").withColumn("taken", F.least("h", F.coalesce("base_n", F.lit(0))))
    first = own.join(heads.withColumnRenamed("conv_id", "base"), "base").where(F.col("pos") < F.col("h")).select("conv_id", "pos", *rest)
    # a turn's place needs the conversation's h (computed in place) and how many turns its base has: joined for those that have any
    later = turns.withColumn("h", shared).where(F.col("pos") >= F.col("h"))
    later = later.join(own.select("conv_id", "taken"), "conv_id").select("conv_id", (F.col("pos") - F.col("h") + F.col("taken")).alias("pos"), *rest)
    return first.unionByName(later)


def _halves(h: Column) -> list[Column]:
    """The 32-bit halves of a hash, not negative: sums of 2^31 of them fit a bigint."""
    return [F.shiftrightunsigned(h, 32), h.bitwiseAND(F.lit(0xFFFFFFFF))]


def prefix_rows(turns: DataFrame, conversations: DataFrame) -> DataFrame:
    """A row for each conversation and depth from 0: conv_id, depth, k1, k2 (digest), p1, p2 (the parent's), turn (hash), words, total (words so far), last (whether the conversation ends here)."""
    block = F.floor(F.col("pos") / BLOCK_TURNS)
    parts = [h for seed in (1, 2) for h in _halves(F.xxhash64(F.lit(seed), "pos", "turn_md5"))]
    rows = turns.select("conv_id", "pos", block.alias("block"), "words", F.xxhash64("turn_md5").alias("turn"), *[p.alias(f"h{i}") for i, p in enumerate(parts)])
    summed = ["words", *[f"h{i}" for i in range(4)]]
    totals = rows.groupBy("conv_id", "block").agg(*[F.sum(c).alias(f"{c}_of") for c in summed], F.max("pos").alias("end"))
    earlier = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(
        "conv_id", "block", *[F.coalesce(F.sum(f"{c}_of").over(earlier), F.lit(0)).alias(f"{c}_before") for c in summed],
        F.max("end").over(Window.partitionBy("conv_id")).alias("end"),
    )
    inside = Window.partitionBy("conv_id", "block").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.select("conv_id", "pos", "block", "turn", "words", *[F.col(c).alias(f"{c}_own") for c in summed[1:]], *[F.sum(c).over(inside).alias(f"{c}_to") for c in summed])
    rows = rows.join(totals, ["conv_id", "block"])
    s = {c: F.col(f"{c}_to") + F.col(f"{c}_before") for c in summed}
    before = {c: s[c] - F.col(f"{c}_own") for c in summed[1:]}

    def key(seed: int, of: dict, depth: Column) -> Column:
        return F.xxhash64(F.lit(seed), depth, *[of[f"h{2 * seed - 2 + i}"] for i in range(2)])

    depth = F.col("pos") + 1
    nodes = rows.select(
        "conv_id", depth.alias("depth"), *[key(i, s, depth).alias(f"k{i}") for i in (1, 2)],
        *[key(i, before, F.col("pos")).alias(f"p{i}") for i in (1, 2)],
        "turn", "words", s["words"].alias("total"), (F.col("pos") == F.col("end")).alias("last"),
    )
    zero = {f"h{i}": F.lit(0).cast("bigint") for i in range(4)}
    none = F.lit(0).cast("bigint")
    ended = turns.groupBy("conv_id").agg(F.lit(1).alias("some"))
    root = conversations.join(ended, "conv_id", "left").select(
        "conv_id", none.alias("depth"), *[key(i, zero, none).alias(f"k{i}") for i in (1, 2)], none.alias("p1"), none.alias("p2"),
        none.alias("turn"), none.alias("words"), none.alias("total"), F.col("some").isNull().alias("last"),
    )
    return nodes.unionByName(root)


def count_nodes(rows: DataFrame) -> DataFrame:
    """A row a node: key, parent's key, depth, words, total, conv_id (the least member), n_convs, n_ends, and of its children: n_children, n_single (of one member), most (members of the largest)."""
    same = lambda c: F.when(F.min(c) == F.max(c), F.min(c)).otherwise(F.raise_error(F.lit(f"two prefixes have one digest ({c})")).cast("bigint")).alias(c)
    nodes = rows.groupBy("k1", "k2").agg(
        *[same(c) for c in ("depth", "p1", "p2", "turn", "words", "total")], F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"),
        F.sum(F.col("last").cast("bigint")).alias("n_ends"),
    )
    nodes = checkpointed(nodes, "trie-nodes")
    # the children of one node can be a third of all nodes: partial counts first, then one row a parent
    children = nodes.where("depth > 0").groupBy(F.col("p1").alias("k1"), F.col("p2").alias("k2")).agg(
        F.count("*").alias("n_children"), F.sum((F.col("n_convs") == 1).cast("bigint")).alias("n_single"), F.max("n_convs").alias("most"),
    )
    zero = F.lit(0).cast("bigint")
    return checkpointed(
        nodes.join(children, ["k1", "k2"], "left").withColumns({c: F.coalesce(c, zero) for c in ("n_children", "n_single", "most")}).drop("turn"),
        "trie-counted",
    )


class NodeTable:
    """Runs of one shard in flat arrays, by the slots of a minimal perfect hash."""

    def __init__(self, k1: np.ndarray, k2: np.ndarray, depth: np.ndarray, p1: np.ndarray, p2: np.ndarray):
        """Distinct runs of a shard; a parent that is no run of the shard is none."""
        self.hash = PerfectHash(k1, k2)
        slot = self.hash.slots(k1, k2)
        if (slot < 0).any():
            raise ValueError("a run without a slot")
        n = len(k1)
        self.depth, self.parent = np.zeros(n, np.int64), np.zeros(n, np.int64)
        self.depth[slot] = depth
        self.parent[slot] = self.hash.slots(p1, p2)

    def scatter(self, k1: np.ndarray, k2: np.ndarray, values: np.ndarray) -> np.ndarray:
        out = np.zeros(self.hash.n, np.int64)
        np.add.at(out, self.hash.slots(k1, k2), values)
        return out

    def up(self, *values: np.ndarray) -> list[np.ndarray]:
        """Each array plus the sums of all runs below, added from the deepest to the root."""
        out = [v.copy() for v in values]
        order = np.argsort(-self.depth, kind="stable")
        order = order[self.parent[order] >= 0]
        ends = np.flatnonzero(np.diff(self.depth[order], append=-1)) + 1
        for a, b in zip(np.concatenate([[0], ends[:-1]]), ends, strict=True):
            here = order[a:b]
            for v in out:
                np.add.at(v, self.parent[here], v[here])
        return out


_PATH = ["owner", "conv_id", "k1", "k2", "depth", "total", "n_convs", "leaves"]


def run_sums(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """For each run of two or more members: conv_id, n_convs, tail_total (words to its end), n_leaves, and below (what the runs under it save)."""
    tails = nodes.where((F.col("n_convs") > 1) & (F.col("most") < F.col("n_convs"))).select(
        "k1", "k2", "depth", "total", "conv_id", "n_convs", (F.col("n_single") + (F.col("n_children") == 0).cast("bigint")).alias("leaves")
    )
    tails = checkpointed(tails, "trie-runs")
    # the path of every conversation that is the least member of a run, down to its deepest own run
    owners = tails.groupBy(F.col("conv_id").alias("owner")).agg(F.max("depth").alias("deepest"))
    steps = rows.select(F.col("conv_id").alias("owner"), "depth", "k1", "k2").join(owners, "owner").where(F.col("depth") <= F.col("deepest"))
    paths = steps.select("owner", "k1", "k2").join(tails, ["k1", "k2"]).select(*_PATH)
    dealt = paths.repartition("owner").sortWithinPartitions("owner", "depth")

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches)) if (batches := list(batches)) else None
        if table is None or not table.num_rows:
            return
        at = {c: table.column(c).to_numpy() for c in _PATH}
        k1, k2 = at["k1"].view(np.uint64), at["k2"].view(np.uint64)
        # the run above: the row before of the same path
        above = np.arange(len(k1)) - 1
        above[np.concatenate([[True], at["owner"][1:] != at["owner"][:-1]])] = -1
        p1, p2 = np.where(above >= 0, k1[above], 0), np.where(above >= 0, k2[above], 0)
        _, first = np.unique(np.stack([k1, k2]), axis=1, return_index=True)
        runs = NodeTable(k1[first], k2[first], at["depth"][first], p1[first], p2[first])
        # a run is counted on the path of its own least member
        mine = at["owner"] == at["conv_id"]
        saved = (at["n_convs"] - 1) * (at["total"] - np.where(above >= 0, at["total"][above], 0))
        keys = k1[mine], k2[mine]
        own_saved, own_leaves = runs.scatter(*keys, saved[mine]), runs.scatter(*keys, at["leaves"][mine])
        all_saved, all_leaves = runs.up(own_saved, own_leaves)
        slot = runs.hash.slots(k1[first], k2[first])
        yield pa.RecordBatch.from_arrays(
            [pa.array(at[c][first]) for c in ("conv_id", "n_convs", "total")] + [pa.array(all_leaves[slot]), pa.array((all_saved - own_saved)[slot])],
            ["conv_id", "n_convs", "tail_total", "n_leaves", "below"],
        )

    shards = dealt.mapInArrow(add_up, "conv_id long, n_convs long, tail_total long, n_leaves long, below long")
    return shards.groupBy("conv_id", "n_convs", "tail_total").agg(F.sum("n_leaves").alias("n_leaves"), F.sum("below").alias("below"))


def ends_digests(rows: DataFrame) -> DataFrame:
    """k1, k2, ends_sha256 of the nodes at which conversations end."""
    ended = rows.where("last").select("k1", "k2", "conv_id")

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k1, k2, ids = (batch.column(k).to_numpy() for k in range(3))
            cut = np.flatnonzero(np.concatenate([[True], (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1])])[: len(k1)])
            begin = np.concatenate([np.arange(a, b, PIECE_IDS) for a, b in zip(cut, np.append(cut[1:], len(k1)), strict=True)]) if len(cut) else cut
            texts = [",".join(map(str, ids[a:b].tolist())) for a, b in zip(begin, np.append(begin[1:], len(k1)), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(k1[begin]), pa.array(k2[begin]), pa.array(ids[begin]), pa.array(texts, pa.string())], ["k1", "k2", "first", "part"])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sha = None, None
        for batch in batches:
            done: list[tuple] = []
            for k1, k2, part in zip(*(batch.column(c).to_pylist() for c in ("k1", "k2", "part")), strict=True):
                if (k1, k2) == now:
                    sha.update(b",")
                else:
                    if sha:
                        done.append((*now, sha.hexdigest()))
                    now, sha = (k1, k2), hashlib.sha256()
                sha.update(part.encode())
            yield _digests(done)
        if sha:
            yield _digests([(*now, sha.hexdigest())])

    def _digests(done: list[tuple]) -> pa.RecordBatch:
        k1, k2, sha = zip(*done, strict=True) if done else ((), (), ())
        return pa.RecordBatch.from_arrays([pa.array(k1, pa.int64()), pa.array(k2, pa.int64()), pa.array(sha, pa.string())], ["k1", "k2", "ends_sha256"])

    parts = ended.repartitionByRange("k1", "k2", "conv_id").sortWithinPartitions("k1", "k2", "conv_id").mapInArrow(pieces, "k1 long, k2 long, first long, part string")
    parts = checkpointed(parts, "trie-ends")  # a range exchange must not be sampled anew
    return parts.repartition("k1", "k2").sortWithinPartitions("k1", "k2", "first").mapInArrow(digest, "k1 long, k2 long, ends_sha256 string")


def prefix_trie(turns: DataFrame, conversations: DataFrame) -> DataFrame:
    """The nodes of the trie of ``turns`` (conv_id, pos from 0 without gaps, turn_md5, words).

    ``conversations`` (conv_id, distinct) are its members; those without
    turns are members of the root alone. Per node: node and parent (digests,
    32 hexadecimal digits; the root's parent is null), depth, conv_id (the
    least member), parent_conv_id, n_convs, n_ends, n_children, n_leaves,
    saved_tokens, ends_sha256. No conversations give no rows.
    """
    rows = checkpointed(prefix_rows(turns, conversations), "trie-rows")
    nodes = count_nodes(rows)
    runs = checkpointed(run_sums(rows, nodes), "trie-sums").withColumnsRenamed({"n_leaves": "run_leaves", "conv_id": "run_conv", "n_convs": "run_n"})
    parents = nodes.select(F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    ends = ends_digests(rows)
    single = F.col("n_convs") == 1
    shared = nodes.where(~single).join(runs, (F.col("conv_id") == F.col("run_conv")) & (F.col("n_convs") == F.col("run_n")), "left").select(
        *nodes.columns, F.col("run_leaves").alias("n_leaves"),
        (F.col("below") + (F.col("n_convs") - 1) * (F.col("tail_total") - F.col("total") + F.col("words"))).alias("saved_tokens"),
    )
    alone = nodes.where(single).select(*nodes.columns, F.lit(1).cast("bigint").alias("n_leaves"), F.lit(0).cast("bigint").alias("saved_tokens"))
    both = shared.unionByName(alone).join(ends, ["k1", "k2"], "left").join(parents, ["p1", "p2"], "left")
    name = lambda a, b: F.concat(F.lpad(F.lower(F.hex(a)), 16, "0"), F.lpad(F.lower(F.hex(b)), 16, "0"))
    return both.select(
        name("k1", "k2").alias("node"), F.when(F.col("depth") > 0, name("p1", "p2")).alias("parent"), "depth", "conv_id",
        F.when(F.col("depth") > 0, F.col("parent_conv_id")).alias("parent_conv_id"), "n_convs", "n_ends", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
    )


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """The trie of the rebuilt conversations (see :func:`numbered_turns`, :func:`graft`, :func:`prefix_trie`).

    Nulls, ties and repeated rows are as these say; other columns are not read.
    """
    turns = checkpointed(numbered_turns(conversations), "turns")
    return prefix_trie(graft(turns), turns.select("conv_id").distinct())


def op11_prefix_trie(spark, sf_dir: str) -> DataFrame:
    return conversation_trie(read_table(spark, sf_dir, "conversations")).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"
    )
