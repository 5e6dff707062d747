"""Language-model scoring with a probabilistic suffix tree.

Symbols are bytes of the text's words (A-Z lower-cased) joined by one
blank, and an end; so a text's probability is one of its token sequence.
A context is a run of up to ``DEPTH`` symbols before the next one.

1. Every task counts (context of DEPTH symbols, next symbol) of its whole
   training texts in numpy, and the words by hash; Spark sums both.
2. The counts of each level are sums of the level above it. Contexts seen
   ``LEAST_COUNT`` times are candidates, whatever the corpus: a candidate of
   a part of it is one of the whole. A candidate is retained if its
   next-symbol distribution diverges from its suffix's: Kullback-Leibler
   divergence of ``LEAST_DIVERGENCE`` nats a symbol and ``LEAST_GAIN`` nats
   in all. Suffixes of retained contexts are kept: these are the states.
3. Distributions are smoothed towards the suffix's with the weight of the
   number of distinct next symbols (Witten-Bell), the root's towards the
   uniform one. The states are a table, smoothed level by level with joins.
4. The most frequent states (at most ``SENT_STATES``; a state's suffixes
   are with it) go to all tasks, with a bit array that screens for longer
   states. Texts are scored where they lie: each symbol by its longest
   suffix that is a state. Symbols that the screen lets through are summed
   by text and joined with the other states, so no state is lost.

The base score needs every word's training count. The most frequent words
(at most ``FREQUENT``) go to all tasks; a text's other words are joined
with the counts by hash, summed by text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from topicframe.llm.common import bucket_of_id, checkpointed, documents, frequency_step, least_step, most_frequent
from topicframe.llm.spans import BLANKS, Words, mix, text_chunks

#: At most 7: a context and its next symbol then fill 64 bits.
DEPTH = 6
LEAST_COUNT = 64
LEAST_DIVERGENCE = 0.005
LEAST_GAIN = 8.0
FREQUENT = 1 << 18
SENT_STATES = 1 << 19
#: Bits (their log2) of the screen for states that are not sent out.
SCREEN_BITS = 26
END = 10
#: Distinct keys that a task holds before it hands its counts on.
HELD = 2_000_000

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32


def sequences(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """n-gram code of each symbol (DEPTH bytes of context, then it) and each text's first.

    DEPTH ends stand before a text as its context.
    """
    length = words.end - words.start
    n = words.per_row()
    empty = n == 0
    pads = DEPTH * (words.row + 1) + np.cumsum(empty)[words.row]
    size = length + 1
    to = np.cumsum(size) - size + pads
    inside = np.ones(256, bool)
    inside[list(BLANKS)] = False
    out = np.full(int(size.sum()) + DEPTH * words.n_rows + int(empty.sum()), END, np.uint8)
    out[to + length] = 32
    out[np.repeat(to - (np.cumsum(length) - length), length) + np.arange(length.sum())] = _FOLD[words.data[inside[words.data]]]
    symbols = np.bincount(words.row, size, words.n_rows).astype(np.int64) + empty
    first = np.concatenate([[0], np.cumsum(symbols)])
    out[(first[1:] + DEPTH * np.arange(1, words.n_rows + 1)) - 1] = END
    wide = out.astype(np.uint64)
    code = np.zeros(len(out) - DEPTH, np.uint64)
    for k in range(DEPTH + 1):
        code = (code << np.uint64(8)) | wide[k : len(out) - DEPTH + k]
    at = np.arange(first[-1]) + DEPTH * np.repeat(np.arange(words.n_rows), symbols)
    return code[at], first


class Counter:
    """Counts of 64-bit keys, merged when there are many."""

    def __init__(self) -> None:
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, keys: np.ndarray) -> None:
        if len(keys):
            self.parts.append(np.unique(keys, return_counts=True))
            self.size += len(self.parts[-1][0])

    def merge(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.parts:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        keys = np.concatenate([p[0] for p in self.parts])
        order = np.argsort(keys, kind="stable")
        keys, n = keys[order], np.concatenate([p[1] for p in self.parts])[order]
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        self.parts = [(keys[first], np.add.reduceat(n, first))]
        self.size = len(first)
        return self.parts[0]

    def batches(self, kind: int) -> Iterator[pa.RecordBatch]:
        keys, n = self.merge()
        for at in range(0, len(keys), 1 << 16):
            part = slice(at, at + (1 << 16))
            yield pa.RecordBatch.from_pydict({"kind": np.full(len(keys[part]), kind, np.int8), "key": keys[part].view(np.int64), "n": n[part].astype(np.int64)})
        self.parts, self.size = [], 0


def training_counts(docs: DataFrame) -> DataFrame:
    """kind (0 word by hash, 1 symbol with its context), key, n over the texts of ``docs`` (text)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = (Counter(), Counter())
        for batch in batches:
            for _, _, data, offsets in text_chunks(batch.column(0)):
                words = Words(data, offsets)
                held[0].add(words.hashes())
                held[1].add(sequences(words)[0])
                for kind, counter in enumerate(held):
                    if counter.size > 2 * HELD:
                        counter.merge()
                        if counter.size > HELD:
                            yield from counter.batches(kind)
        for kind, counter in enumerate(held):
            yield from counter.batches(kind)

    # tasks hand on distinct keys, so another map-side sum would only spill
    counted = docs.select("text").mapInArrow(count, "kind byte, key long, n long").repartition("kind", "key")
    return counted.groupBy("kind", "key").agg(F.sum("n").alias("n"))


def _bytes(k: int) -> Column:
    """Mask of the last ``k`` bytes of a code."""
    return F.lit((1 << (8 * k)) - 1 if k < 8 else -1)


def candidate_grams(grams: DataFrame, depth: int = DEPTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """level, context, code (context, symbol), n, and the context's total and kinds, of the root and of all contexts seen ``least_count`` times.

    ``grams``: key, n of contexts of ``depth`` symbols, each key once.
    """
    level = grams.select(F.col("key").alias("code"), "n")
    rows = None
    for k in range(depth, -1, -1):
        if k < depth:
            level = level.groupBy(F.col("code").bitwiseAND(_bytes(k + 1)).alias("code")).agg(F.sum("n").alias("n"))
            level = checkpointed(level, f"grams-{k}")
        here = level.select(F.lit(k).alias("level"), F.shiftrightunsigned("code", 8).alias("context"), "code", "n")
        rows = here if rows is None else rows.unionByName(here)
    sums = rows.groupBy("level", "context").agg(F.sum("n").alias("total"), F.count("*").alias("kinds"))
    often = checkpointed(sums.where((F.col("total") >= least_count) | (F.col("level") == 0)), "contexts")  # its size is on record
    return checkpointed(rows.join(often, ["level", "context"]), "candidates")


def tree_states(rows: DataFrame, divergence: float = LEAST_DIVERGENCE, gain: float = LEAST_GAIN) -> DataFrame:
    """level, context of the retained contexts of ``rows`` (candidate_grams) and of all their suffixes, the root included."""
    child = rows.where("level > 0").select("level", "context", "n", "total", F.expr("level - 1").alias("up"), F.expr("code & (shiftleft(1L, 8 * level) - 1)").alias("up_code"))
    parent = rows.select(F.col("level").alias("up"), F.col("code").alias("up_code"), (F.col("n") / F.col("total")).alias("q"))
    share = F.col("n") / F.col("total")
    tested = child.join(parent, ["up", "up_code"]).groupBy("level", "context").agg(F.sum(share * F.log(share / F.col("q"))).alias("kl"), F.first("total").alias("seen"))
    retained = tested.where((F.col("kl") >= divergence) & (F.col("kl") * F.col("seen") >= gain))
    suffixes = retained.select(F.explode(F.sequence(F.lit(0), "level")).alias("level"), "context").select("level", F.expr("context & (shiftleft(1L, 8 * level) - 1)").alias("context"))
    return suffixes.unionByName(rows.where("level = 0").select("level", "context")).distinct()


def build_tree(
    grams: DataFrame, depth: int = DEPTH, least_count: int = LEAST_COUNT, divergence: float = LEAST_DIVERGENCE, gain: float = LEAST_GAIN
) -> DataFrame:
    """The tree as a table, a row a symbol that follows a state: level, context, code, total, log (its log10 probability), weight (the log10 weight of the state's suffix)."""
    rows = candidate_grams(grams, depth, least_count)
    states = checkpointed(tree_states(rows, divergence, gain), "states")
    rows = checkpointed(rows.join(states, ["level", "context"], "left_semi"), "state-grams")
    tree = lower = None
    for k in range(depth + 1):
        here = rows.where(F.col("level") == k)
        if lower is None:
            here = here.withColumn("q", F.lit(1 / 256))
        else:
            here = here.withColumn("up_code", F.col("code").bitwiseAND(_bytes(k))).join(lower, "up_code")
        p = (F.col("n") + F.col("kinds") * F.col("q")) / (F.col("total") + F.col("kinds"))
        here = checkpointed(here.select("level", "context", "code", "total", "kinds", p.alias("p")), f"states-{k}")
        lower = here.select(F.col("code").alias("up_code"), F.col("p").alias("q"))
        tree = here if tree is None else tree.unionByName(here)
    weight = F.log10(F.col("kinds") / (F.col("total") + F.col("kinds")))
    return tree.select("level", "context", "code", "total", F.log10("p").alias("log"), weight.alias("weight"))


Arrays = list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]


def sent_states(tree: DataFrame, depth: int = DEPTH, most: int | None = None) -> tuple[Arrays, np.ndarray, Column]:
    """What every task is given of ``tree``: by level, sorted codes and their logs, sorted contexts and their weights, of at most ``most`` states;
    the bits of the screen; and the condition that a state is not among them.

    A suffix is seen as often as its extension or more, so the bound on the
    count sends a state's suffixes with it.
    """
    contexts = tree.dropDuplicates(["level", "context"]).select("level", "context", "total", "weight")
    contexts = checkpointed(contexts, "state-contexts")
    bound = least_step(contexts.select(F.col("total").alias("n")), SENT_STATES if most is None else most)
    sent = F.lit(False) if bound is None else frequency_step("total") >= bound
    def of_level(table: DataFrame, k: int, key: str, value: str) -> tuple[np.ndarray, np.ndarray]:
        got = table.where(sent & (F.col("level") == k)).select(key, F.col(value).cast("float")).toArrow()
        keys, values = got[0].to_numpy().view(np.uint64), got[1].to_numpy()
        order = np.argsort(keys)
        return keys[order], values[order]

    arrays = [(*of_level(tree, k, "code", "log"), *of_level(contexts, k, "context", "weight")) for k in range(depth + 1)]

    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = screen_place(batch.column(0).to_numpy().astype(np.uint64), batch.column(1).to_numpy().view(np.uint64))
            yield pa.RecordBatch.from_pydict({"word": (at >> np.uint64(6)).astype(np.int64), "bit": (np.uint64(1) << (at & np.uint64(63))).view(np.int64)})

    # the least unsent extension of a sent state (or an unsent root) is met first by any symbol that needs one
    others = contexts.where(~sent).withColumn("up", F.expr("level - 1")).withColumn("suffix", F.expr("context & (shiftleft(1L, 8 * greatest(level - 1, 0)) - 1)"))
    inner = contexts.where(sent).select(F.col("level").alias("up"), F.col("context").alias("suffix"))
    edge = others.join(inner, ["up", "suffix"], "left_semi").select("level", "context").unionByName(others.where("level = 0").select("level", "context"))
    words = edge.mapInArrow(bits, "word long, bit long").groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()  # at most 2^(SCREEN_BITS - 6) rows
    screen = np.zeros(1 << (SCREEN_BITS - 6), np.uint64)
    screen[words["word"].to_numpy()] = words["bits"].to_numpy().view(np.uint64)
    return arrays, screen, ~sent


def screen_place(level: np.ndarray, context: np.ndarray) -> np.ndarray:
    """Bit of a context in the screen."""
    return mix(context + (level << np.uint64(56))) >> np.uint64(64 - SCREEN_BITS)


def log10_next(states: Arrays, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of distinct codes (longest context, symbol): log10 probability at the longest suffix that is a state, and its level (-1: none)."""
    out = np.zeros(len(codes))
    level = np.full(len(codes), -1, np.int8)
    todo = np.arange(len(codes))
    for k in range(len(states) - 1, -1, -1):
        grams, logs, contexts, weights = states[k]
        code = codes[todo] & np.uint64((1 << (8 * k + 8)) - 1)
        hit, at = _find(code, grams)
        out[todo[hit]] += logs[at[hit]]
        level[todo[hit]] = np.maximum(level[todo[hit]], k)
        todo, code = todo[~hit], code[~hit]
        if not len(todo):
            return out, level
        known, at = _find(code >> np.uint64(8), contexts)
        out[todo[known]] += weights[at[known]]
        level[todo[known]] = np.maximum(level[todo[known]], k)
    out[todo] += np.log10(1 / 256)
    return out, level


def open_codes(codes: np.ndarray, level: np.ndarray, screen: np.ndarray, depth: int) -> np.ndarray:
    """Which of ``codes`` may have a longer state than the one of ``level``: the next longer context's bit is set."""
    if not screen.any():
        return np.zeros(len(codes), bool)
    up = (level + 1).astype(np.uint64)
    longer = (codes >> np.uint64(8)) & ((np.uint64(1) << (np.uint64(8) * np.minimum(up, np.uint64(7)))) - np.uint64(1))
    at = screen_place(up, longer)
    return (level < depth) & ((screen[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1)).astype(bool)


def resolve_open(open_: DataFrame, tree: DataFrame, depth: int = DEPTH) -> DataFrame:
    """code, resolved: log10 probability of ``open_`` (code, fallback, above) by the states of ``tree``.

    ``fallback`` is the value at the longest state below level ``above``.
    Codes that have no state from there on are not in the result.
    """
    each = open_.groupBy("code").agg(F.first("fallback").alias("fallback"), F.first("above").cast("int").alias("above"))
    each = each.select(F.col("code").alias("whole"), "fallback", F.explode(F.sequence("above", F.lit(depth))).alias("level"))
    context = F.expr("shiftrightunsigned(whole, 8) & (shiftleft(1L, 8 * level) - 1)")
    # level 7 takes all eight bytes
    code = F.when(F.col("level") >= 7, F.col("whole")).otherwise(F.expr("whole & (shiftleft(1L, 8 * least(level + 1, 7)) - 1)"))
    each = each.select("whole", "fallback", "level", context.alias("context"), code.alias("code"))
    contexts = tree.dropDuplicates(["level", "context"]).select("level", "context", "weight")
    met = each.join(contexts, ["level", "context"]).join(tree.select("level", "code", "log"), ["level", "code"], "left")
    found = met.groupBy("whole").agg(
        F.first("fallback").alias("fallback"),
        F.max(F.when(F.col("log").isNotNull(), F.col("level"))).alias("at"),
        F.max_by("log", F.when(F.col("log").isNotNull(), F.col("level"))).alias("log"),
        F.collect_list(F.struct("level", "weight")).alias("weights"),
    )
    passed = F.aggregate("weights", F.lit(0.0), lambda s, w: s + F.when(w["level"] > F.coalesce(F.col("at"), F.lit(-1)), w["weight"]).otherwise(0.0))
    return found.select(F.col("whole").alias("code"), (passed + F.coalesce("log", "fallback")).alias("resolved"))


def _find(keys: np.ndarray, among: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(among):
        return np.zeros(len(keys), bool), np.zeros(len(keys), np.int64)
    at = np.minimum(np.searchsorted(among, keys), len(among) - 1)
    return among[at] == keys, at


def score_documents(docs: DataFrame, training: DataFrame, depth: int = DEPTH) -> DataFrame:
    """``docs`` (doc_id, text and others that are small) scored by a tree of the texts of ``training`` (text).

    Adds n_tokens, n_known, train_tokens, base_score and score. Words are
    told apart by 64-bit hashes. Null texts are empty: one end token.
    Repeated rows are scored each, whatever their ids. Without training
    texts every token is unknown, the base is uniform and so is the tree.
    Columns of ``docs`` with the names that are added (in any case) are
    replaced by them.
    """
    spark = docs.sparkSession
    counted = checkpointed(training_counts(training), "training-counts")
    counts = counted.where("kind = 0").select("key", "n")
    n_texts = training.count()
    words, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    total, distinct = words + n_texts, distinct + int(n_texts > 0)
    floor = np.log10(total + 0.1 * (distinct + 1))
    tree = build_tree(counted.where("kind = 1").select("key", "n"), depth)
    # bounded: the frequent states, the screen, and the frequent words
    states, screen, unsent = sent_states(tree, depth)
    given = spark.sparkContext.broadcast((states, screen, *most_frequent(counts, FREQUENT)))
    text_at, end_log = docs.columns.index("text"), float(np.log10(n_texts + 0.1) - floor)
    others = [c for c in docs.columns if c.lower() not in ("text", "n_tokens", "n_known", "train_tokens", "base_score", "score")]
    kept_at = [docs.columns.index(c) for c in others]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        states, screen, keys, n_of = given.value
        logs = np.log10(n_of + 0.1) - floor
        row_id = TaskContext.get().partitionId() << 33
        for batch in batches:
            for a, b, data, offsets in text_chunks(batch.column(text_at)):
                found = Words(data, offsets)
                h = found.hashes()
                hit, at = _find(h, keys)
                known = np.bincount(found.row[hit], minlength=b - a) + int(n_texts > 0)
                base = np.bincount(found.row[hit], logs[at[hit]], b - a) + end_log
                # other words: distinct by text, with how often
                rest, row = h[~hit], found.row[~hit]
                order = np.lexsort((rest, row))
                rest, row = rest[order], row[order]
                first = np.flatnonzero(np.concatenate([[True], (rest[1:] != rest[:-1]) | (row[1:] != row[:-1])])[: len(rest)])
                times = np.diff(np.concatenate([first, [len(rest)]])).astype(np.int32)
                places = np.searchsorted(row[first], np.arange(b - a + 1)).astype(np.int32)
                code, begin = sequences(found)
                some, which = np.unique(code, return_inverse=True)
                logs_of, level = log10_next(states, some)
                waits = open_codes(some, level, screen, depth)
                total_log = np.add.reduceat(np.where(waits, 0.0, logs_of)[which], begin[:-1])
                # open ones: distinct by text, with how often
                at_text = np.repeat(np.arange(b - a), np.diff(begin))[waits[which]]
                pair, often = np.unique(at_text * len(some) + which[waits[which]], return_counts=True)
                late, holds = pair % len(some), np.searchsorted(pair // len(some), np.arange(b - a + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(k).slice(a, b - a) for k in kept_at),
                        pa.array(row_id + np.arange(b - a)),
                        pa.array(found.per_row() + 1),
                        pa.array(known.astype(np.int64)),
                        pa.array(base),
                        pa.array(total_log),
                        pa.ListArray.from_arrays(pa.array(places), pa.array(rest[first].view(np.int64))),
                        pa.ListArray.from_arrays(pa.array(places), pa.array(times)),
                        pa.ListArray.from_arrays(pa.array(holds), pa.array(some[late].view(np.int64))),
                        pa.ListArray.from_arrays(pa.array(holds), pa.array(often.astype(np.int32))),
                        pa.ListArray.from_arrays(pa.array(holds), pa.array(logs_of[late])),
                        pa.ListArray.from_arrays(pa.array(holds), pa.array((level[late] + 1).astype(np.int8))),
                    ],
                    names,
                )
                row_id += b - a

    # the columns of docs go by number, so no name of theirs clashes
    carried = [f"c{k}" for k in range(len(others))]
    names = [*carried, "row", "n_tokens", "known", "base", "score", "rare", "times", "codes", "often", "fallback", "above"]
    added = "row long, n_tokens long, known long, base double, score double, rare array<long>, times array<int>, codes array<long>, often array<int>, fallback array<double>, above array<tinyint>"
    schema = ", ".join([f"{name} {dict(docs.dtypes)[c]}" for name, c in zip(carried, others)] + [added])
    scored = checkpointed(docs.mapInArrow(score, schema), "scored")
    pairs = scored.select("row", F.explode(F.arrays_zip("rare", "times")).alias("w")).select("row", F.col("w.rare").alias("key"), F.col("w.times").alias("times"))
    met = pairs.join(counts, "key", "left")
    part = met.groupBy("row").agg(
        F.sum(F.when(F.col("n").isNotNull(), F.col("times")).otherwise(0)).alias("more"),
        F.sum(F.col("times") * (F.log10(F.coalesce("n", F.lit(0)) + 0.1) - float(floor))).alias("rest"),
    )
    waiting = scored.select("row", F.explode(F.arrays_zip("codes", "often", "fallback", "above")).alias("w"))
    waiting = waiting.select("row", F.col("w.codes").alias("code"), F.col("w.often").alias("often"), F.col("w.fallback").alias("fallback"), F.col("w.above").alias("above"))
    resolved = checkpointed(resolve_open(waiting, tree.where(unsent), depth), "resolved")  # its size is on record
    late = waiting.join(resolved, "code", "left").groupBy("row").agg(F.sum(F.col("often") * F.coalesce("resolved", "fallback")).alias("late"))
    return scored.join(part, "row", "left").join(late, "row", "left").select(
        *(F.col(name).alias(c) for name, c in zip(carried, others)),
        "n_tokens",
        (F.col("known") + F.coalesce("more", F.lit(0))).cast("bigint").alias("n_known"),
        F.lit(total).cast("bigint").alias("train_tokens"),
        (F.col("base") + F.coalesce("rest", F.lit(0.0))).alias("base_score"),
        (F.col("score") + F.coalesce("late", F.lit(0.0))).alias("score"),
    )


def op10_suffix_tree_lm(spark, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).withColumn("held_out", bucket_of_id(10) == 0)
    return score_documents(docs, docs.where(~F.col("held_out")).select("text")).select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )
