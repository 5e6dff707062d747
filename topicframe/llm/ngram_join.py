"""Near duplicates by the Jaccard similarity of word n-grams: a grouped prefix join.

A text's set is its distinct n-word shingles; with fewer words its whole
sequence is the one shingle. Texts are linked at similarity ``percent``/100
or more, and a component is what links reach.

1. Shingle frequencies are counted over the whole sets; the ``FREQUENT``
   most frequent get a rank that puts them last in the order. Any one order
   is right; this one keeps common passages out of prefixes.
2. Every task sorts its texts' shingles in that order. By the pigeonhole
   principle two linked sets share a shingle in their prefixes (of
   n - ceil(t n) + 1). Texts of one size and one prefix are one group, and
   equal sets are one class in it: copies cost nothing from here on.
3. Groups that share a prefix shingle are paired. A pair needs sizes within
   t of each other, a shared shingle in the shorter prefixes that the two
   sizes ask for, places of it that leave enough before and behind, and
   enough shared shingles that those behind the last shared one can make
   up the rest (the positional filter).
4. Pairs that pass are expanded to their members' classes and verified on
   the whole sets of the texts.

Groups are first paired like stars: each group with the hub it shares most
with, first by an eighth of the shingles, then by all. The hub of a shingle
is the group that has it first in its prefix: it has the fewest rare
shingles of its own, so it is the nearest to what a family has in common.
Stars go on, among groups that lie in different components, for as long as
a good part of their pairs link. Then groups that still lie in different
components are paired with one another: for each shingle, those outside its
most common component with all others. No link between components is lost,
and a family of copies costs a row a copy.

Shingles are 64-bit hashes; only two that collide inside one pair could
change its similarity.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicframe.llm.common import checkpointed, documents, keep_last, most_frequent, release, scratch
from topicframe.llm.components import connected_components
from topicframe.llm.spans import Words, combine, mix, text_chunks

SHINGLE = 5
PERCENT = 75
#: Shingles that get a rank by frequency, and the frequency from which they may.
FREQUENT = 1 << 20
LEAST_FREQUENT = 4
#: The first stars use one in so many shingles.
STAR_SHARE = 8
#: Stars end when fewer than one in so many of their pairs link.
STAR_YIELD = 20
#: Partners of one class that are verified in one task.
PARTNERS = 256
#: Keys that a task counts at once, and ranges of keys whose counts are added up together (at most 4096, by a part of the key's 58 bits of hash).
HELD_KEYS = 1 << 21
COUNT_RANGES = 1 << 11
#: 64-bit blocks of the filter of shared shingles.
FILTER_BLOCKS = 1 << 20


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of the texts, sorted in each, and the text's first."""
    words = Words(data, offsets)
    hashes, n = words.hashes(), words.per_row()
    shingle, at = combine(hashes, words.row, size)
    row = words.row[at]
    for k in range(1, size):  # texts of fewer words
        some = n[words.row] == k
        if some.any():
            whole, at = combine(hashes[some], words.row[some], k)
            shingle, row = np.concatenate([shingle, mix(whole + np.uint64(k))]), np.concatenate([row, words.row[some][at]])
    if (np.diff(row) < 0).any():
        order = np.argsort(row, kind="stable")
        shingle, row = shingle[order], row[order]
    first = np.searchsorted(row, np.arange(len(offsets)))
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        shingle[a:b].sort()
    new = np.ones(len(shingle), bool)
    new[1:] = (shingle[1:] != shingle[:-1]) | (row[1:] != row[:-1])
    return shingle[new], np.searchsorted(row[new], np.arange(len(offsets)))


def prefix_length(n: np.ndarray, percent: int) -> np.ndarray:
    return np.where(n > 0, n - -(-percent * n // 100) + 1, 0)


def _prefixes(first: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indices of the first ``length`` items of each text, and their places in it."""
    place = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
    return np.repeat(first[:-1], length) + place, place


def frequent_shingles(docs: DataFrame, size: int, most: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys (hash without its last 6 bits, sorted) and ranks (1 to 63, by doublings) of the most frequent shingles."""

    def keys(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        for _, _, data, offsets in text_chunks(batch.column(0)):
            yield shingle_sets(data, offsets, size)[0] >> np.uint64(6)

    counted = key_counts(docs.select("text"), keys, least)
    key, n = most_frequent(checkpointed(counted, "frequent"), most, least)
    return key, np.clip(np.log2(np.maximum(n, 1)), 1, 63).astype(np.uint64)


def _rotated(key: np.ndarray, left: np.uint64, right: np.uint64) -> np.ndarray:
    """``key`` (overwritten) with its bits rotated left by ``left``; ``right`` is 64 - ``left``."""
    low = key >> right
    key <<= left
    key |= low
    return key


def _by_range(held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """Keys and their counts, a row a range of keys: few rows go through the shuffle, whatever the keys.

    ``held`` is emptied. Few copies are made: a worker keeps what it needed at once.
    """
    key = np.concatenate(held)
    held.clear()
    # with the range's bits in front one sort orders ranges and keys
    front = np.uint64(18 - (COUNT_RANGES.bit_length() - 1))
    back = np.uint64(64) - front
    key = _rotated(key, front, back)
    key.sort()
    new = np.ones(len(key), bool)
    np.not_equal(key[1:], key[:-1], out=new[1:])
    n = np.diff(np.flatnonzero(new), append=len(key)).astype(np.uint32)
    key = key[new]
    bucket = (key >> (np.uint64(46) + front)).astype(np.int32)
    key = _rotated(key, back, front)
    first = np.flatnonzero(np.diff(bucket, prepend=-1))
    ends = np.append(first, len(key))
    for a in range(0, len(first), 256):
        at = ends[a : a + 257]
        x, y = at[0], at[-1]
        columns = [
            pa.BinaryArray.from_buffers(pa.binary(), len(at) - 1, [None, pa.py_buffer(((at - x) * v.itemsize).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(v[x:y]))])
            for v in (key, n)
        ]
        yield pa.RecordBatch.from_arrays([pa.array(bucket[at[:-1]]), *columns], ["range", "keys", "counts"])


def key_counts(
    rows: DataFrame, keys: Callable[[pa.RecordBatch], Iterator[np.ndarray]], least: int,
    then: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]] = iter, schema: str = "key long, n long",
) -> DataFrame:
    """key, n of all keys (uint64) that ``keys`` finds at least ``least`` times in the batches of ``rows``.

    ``then`` works on them in the task that adds them up and returns rows of
    ``schema``: with a second step in Python behind it a task would hold two
    Python workers, and Spark keeps them all for the tasks that follow.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for some in keys(batch):
                held.append(some)
                size += len(some)
                if size > HELD_KEYS:
                    yield from _by_range(held)
                    held, size = [], 0
        if size:
            yield from _by_range(held)

    def added(held: list[tuple[bytes, bytes]]) -> pa.RecordBatch:
        key = np.concatenate([np.frombuffer(k, np.uint64) for k, _ in held])
        order = np.argsort(key)
        key, n = key[order], np.concatenate([np.frombuffer(c, np.uint32) for _, c in held])[order]
        first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        total = np.add.reduceat(n.astype(np.int64), first)
        some = total >= least
        return pa.RecordBatch.from_pydict({"key": key[first[some]].view(np.int64), "n": total[some]})

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, last = [], None
        for batch in batches:
            for place, *part in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if place != last and held:
                    yield added(held)
                    held = []
                last = place
                held.append(part)
        if held:
            yield added(held)

    parts = rows.mapInArrow(count, "range int, keys binary, counts binary")
    return parts.repartition("range").sortWithinPartitions("range").mapInArrow(lambda batches: then(add(batches)), schema)


class Ranks:
    """The order: keys of frequent shingles get their rank in the top 6 bits."""

    def __init__(self, keys: np.ndarray, ranks: np.ndarray):
        self.keys, self.ranks = keys, ranks
        self.maybe = np.zeros(1 << 24, bool)
        self.maybe[keys >> np.uint64(34)] = True

    def order_keys(self, shingle: np.ndarray) -> np.ndarray:
        key = shingle >> np.uint64(6)
        some = np.flatnonzero(self.maybe[key >> np.uint64(34)])
        if len(some):
            at = np.minimum(np.searchsorted(self.keys, key[some]), len(self.keys) - 1)
            hit = self.keys[at] == key[some]
            key[some[hit]] |= self.ranks[at[hit]] << np.uint64(58)
        return key


ROWS = "row long, n long, s1 long, s2 long, g long, prefix array<long>"


def _rows(docs: DataFrame, size: int, percent: int, frequent: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """``docs`` (text, and a struct ``doc``) with a row number, set size and signature, group, and the group's prefix once a task."""
    given = docs.sparkSession.sparkContext.broadcast(frequent)

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = Ranks(*given.value)
        row_id, told = TaskContext.get().partitionId() << 33, set()
        for batch in batches:
            for a, b, data, offsets in text_chunks(batch.column(0)):
                shingle, first = shingle_sets(data, offsets, size)
                n = np.diff(first)
                # signatures do not depend on the order of the set
                sums = [np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(shingle ^ np.uint64(salt)), dtype=np.uint64)]) for salt in (11, 1 << 40)]
                s1, s2 = (s[first[1:]] - s[first[:-1]] for s in sums)
                key = ranks.order_keys(shingle)
                for x, y in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
                    key[x:y].sort()
                length = prefix_length(n, percent)
                at, _ = _prefixes(first, length)
                ends = np.concatenate([[0], np.cumsum(length)])
                total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(key[at]), dtype=np.uint64)])
                group = mix(total[ends[1:]] - total[ends[:-1]] + n.astype(np.uint64)).view(np.int64)
                new = np.zeros(b - a, bool)
                for r, g in enumerate(group.tolist()):
                    if g not in told and n[r]:
                        if len(told) < 1 << 20:
                            told.add(g)
                        new[r] = True
                shown = np.where(new, length, 0)
                some, _ = _prefixes(first, shown)
                places = np.concatenate([[0], np.cumsum(shown)]).astype(np.int32)
                prefix = pa.ListArray.from_arrays(pa.array(places), pa.array(key[some].view(np.int64)))
                numbers = [row_id + np.arange(b - a), n.astype(np.int64), s1.view(np.int64), s2.view(np.int64), group]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), *map(pa.array, numbers), prefix],
                    ["text", "doc", "row", "n", "s1", "s2", "g", "prefix"],
                )
                row_id += b - a

    return docs.select("text", "doc").mapInArrow(describe, f"text string, doc {docs.schema['doc'].dataType.simpleString()}, {ROWS}")


def _filter_bits(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Block and the four bits in it that a key sets."""
    h = mix(key)
    word = np.zeros(len(h), np.uint64)
    for k in range(4):
        word |= np.uint64(1) << ((h >> np.uint64(40 + 6 * k)) & np.uint64(63))
    return (h & np.uint64(FILTER_BLOCKS - 1)).astype(np.int64), word


MARKS = "block long, word long"


def _marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words (MARKS) that the keys in the first column of ``batches`` set in a filter."""
    words = np.zeros(FILTER_BLOCKS, np.uint64)
    for batch in batches:
        block, word = _filter_bits(batch.column(0).to_numpy().view(np.uint64))
        np.bitwise_or.at(words, block, word)
    some = np.flatnonzero(words)
    yield pa.RecordBatch.from_pydict({"block": some, "word": words[some].view(np.int64)})


def _bloom(marks: DataFrame) -> np.ndarray:
    """Filter of a fixed size of the tasks' ``marks``: FILTER_BLOCKS words."""
    marked = marks.groupBy("block").agg(F.bit_or("word").alias("word")).toArrow()
    words = np.zeros(FILTER_BLOCKS, np.uint64)
    words[marked["block"].to_numpy()] = marked["word"].to_numpy().view(np.uint64)
    return words


def _posts(rows: DataFrame) -> DataFrame:
    """key, g, n, p: the prefix shingles that were counted more than once, and groups that have them.

    Most shingles are in one group only. Those counted twice or more set
    bits in a filter of a fixed size, and what passes it is posted: also a
    few of one group, which pair with nothing.
    """
    prefixes = rows.where(F.size("prefix") > 0).select("g", "n", "prefix")

    twice = key_counts(prefixes, lambda batch: iter([batch.column(2).flatten().to_numpy().view(np.uint64)]), 2, _marks, MARKS)
    given = rows.sparkSession.sparkContext.broadcast(_bloom(twice))

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = given.value
        for batch in batches:
            prefix = batch.column(2)
            length = pa.compute.list_value_length(prefix).to_numpy()
            key = prefix.flatten().to_numpy().view(np.uint64)
            block, word = _filter_bits(key)
            some = np.flatnonzero((words[block] & word) == word)
            row = np.repeat(np.arange(len(length)), length)[some]
            place = some - np.repeat(np.cumsum(length) - length, length)[some]
            g, n = (batch.column(k).to_numpy()[row] for k in range(2))
            yield pa.RecordBatch.from_pydict({"key": key[some].view(np.int64), "g": g, "n": n, "p": place.astype(np.int32)})

    return prefixes.mapInArrow(post, "key long, g long, n long, p int")


def _texts_of(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """cls, text of the rows ``wanted`` (cls), and of few others: a filter of a fixed size goes to the texts, not the texts to a join."""
    given = rows.sparkSession.sparkContext.broadcast(_bloom(wanted.mapInArrow(_marks, MARKS)))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = given.value
        for batch in batches:
            block, word = _filter_bits(batch.column(0).to_numpy().view(np.uint64))
            yield batch.filter(pa.array((words[block] & word) == word))

    return rows.select(F.col("row").alias("cls"), "text").mapInArrow(keep, "cls long, text string")


def _only(rows: DataFrame, kept: DataFrame, others: DataFrame) -> DataFrame:
    """The ``rows`` whose number is in ``kept``; all their numbers are in ``kept`` or ``others`` (both: row).

    Filters of a fixed size of both go to the texts, not the texts to a join:
    a row that the others' filter keeps back is decided. Only those that both
    let pass, few unless a filter is crowded, are joined.
    """
    given = rows.sparkSession.sparkContext.broadcast([_bloom(some.mapInArrow(_marks, MARKS)) for some in (kept, others)])

    def passing(decided: bool) -> DataFrame:
        def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            filters = given.value
            for batch in batches:
                block, word = _filter_bits(batch.column(0).to_numpy().view(np.uint64))
                wanted, other = ((words[block] & word) == word for words in filters)
                yield batch.filter(pa.array(wanted & (other != decided)))

        return rows.mapInArrow(keep, rows.schema)

    return passing(True).unionByName(passing(False).join(kept, "row", "left_semi"))


def _enough(n1, n2, percent: int):
    """Sizes that can reach the similarity."""
    return (100 * F.least(n1, n2)) >= percent * F.greatest(n1, n2)


def _can_link(pairs: DataFrame, percent: int) -> DataFrame:
    """Group pairs (g1, n1, p1, g2, n2, p2: a row a shared prefix shingle with its places) that pass the positional filter, with ``shared``."""
    met = pairs.groupBy("g1", "g2").agg(F.first("n1").alias("n1"), F.first("n2").alias("n2"), F.count("*").alias("shared"), F.max("p1").alias("p1"), F.max("p2").alias("p2"))
    most = F.col("shared") + F.least(F.col("n1") - F.col("p1") - 1, F.col("n2") - F.col("p2") - 1)
    # |x & y| >= t / (1 + t) * (|x| + |y|)
    return met.where((100 + percent) * most >= percent * (F.col("n1") + F.col("n2")))


def _verified(pairs: DataFrame, rows: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs (a, b) of classes whose sets reach the similarity; ``rows`` has their texts.

    The text of ``a`` is sent once for each PARTNERS of its partners, so a
    hub's partners are spread over tasks.
    """
    pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    pairs = checkpointed(pairs, "pairs")
    texts = checkpointed(_texts_of(rows, pairs.select(F.explode(F.array("a", "b")))), "texts")
    degree = pairs.groupBy("a").agg(F.ceil(F.count("*") / PARTNERS).alias("parts"))
    salted = pairs.join(degree, "a").select("a", "b", F.pmod(F.xxhash64("b"), F.col("parts")).alias("part"))
    partners = salted.join(texts.withColumnRenamed("cls", "b"), "b").select("a", "part", "b", "text")
    hubs = salted.select("a", "part").distinct().join(texts.withColumnRenamed("cls", "a"), "a").select("a", "part", F.lit(None).cast("bigint").alias("b"), "text")
    dealt = partners.unionByName(hubs).repartition("a", "part").sortWithinPartitions("a", "part", F.col("b").asc_nulls_first())

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hub = np.zeros(0, np.uint64)
        for batch in batches:
            a, b = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            linked = []
            for start, _, data, offsets in text_chunks(batch.column(3)):
                shingle, first = shingle_sets(data, offsets, size)
                for r in range(len(first) - 1):
                    own = shingle[first[r] : first[r + 1]]
                    if b[start + r] is None:
                        hub = own
                        continue
                    both = len(np.intersect1d(hub, own, assume_unique=True))
                    if 100 * both >= percent * (len(hub) + len(own) - both) and both:
                        linked.append(start + r)
            yield pa.RecordBatch.from_pydict({"a": pa.array([a[k] for k in linked], pa.int64()), "b": pa.array([b[k] for k in linked], pa.int64())})

    return dealt.mapInArrow(verify, "a long, b long")


def jaccard_components(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """Rows of ``docs`` (doc_id, text and others) and their components.

    The first result has doc_id, n_shingles, row and component (the smallest
    row that links reach); the second row, text and the other columns as a
    struct ``doc``. Both are tables in the shared folder.

    Null, empty and blank texts have no shingles and are components of their
    own. Texts with equal sets are linked whatever their ids, ids may repeat
    or be null. Other columns may have any names. No rows give none.
    """
    others = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"])
    docs = docs.select("text", others.alias("doc"))
    frequent = frequent_shingles(docs, size, FREQUENT, LEAST_FREQUENT)
    release(docs.sparkSession)  # the keys' shuffle files go before the rows are written
    rows = checkpointed(_rows(docs, size, percent, frequent), "shingle-rows")
    release(rows.sparkSession)
    with scratch(rows.sparkSession) as paths:  # all but the rows and the result
        found = checkpointed(_components(rows, size, percent), "components")
        keep_last(paths)
    release(rows.sparkSession)
    return found, rows.select("row", "text", "doc")


def _components(rows: DataFrame, size: int, percent: int) -> DataFrame:
    """doc_id, n_shingles, row, component of ``rows``."""
    sets = ["n", "s1", "s2"]
    classes = checkpointed(rows.where("n > 0").groupBy(*sets).agg(F.min("row").alias("cls"), F.min("g").alias("g")), "classes")
    posts = checkpointed(_posts(rows), "posts")
    heads = classes.groupBy("g").agg(F.min("cls").alias("head"))
    inside = classes.join(heads, "g").where("cls <> head").select(F.col("head").alias("a"), F.col("cls").alias("b"))
    spark = rows.sparkSession
    release(spark)

    # stars: some of the shingles are enough to find most groups a likely partner
    some = posts.where(F.pmod("key", F.lit(STAR_SHARE)) == 0)
    shared = some.groupBy("key").agg(F.min("g").alias("x"), F.max("g").alias("y")).where("x <> y").select("key")
    links = labels = None
    of_hub, of_group = heads.select(F.col("g").alias("g1"), F.col("head").alias("a")), classes.select(F.col("g").alias("g2"), F.col("cls").alias("b"))
    while True:
        with scratch(spark) as paths:
            share = STAR_SHARE if labels is None else 1
            if labels is None:  # all groups are apart
                left = some.join(shared, "key").dropDuplicates(["key", "g"]).withColumns({"x": F.col("g"), "y": F.col("g")})
            else:
                left = _undecided(posts, classes, labels)
            pairs = _stars(left, percent, share).join(of_hub, "g1").join(of_group, "g2").select("a", "b")
            pairs = checkpointed(pairs.unionByName(inside) if links is None else pairs, "pairs")
            found = checkpointed(_verified(pairs, rows, size, percent), "found")
            linked, compared = found.count(), pairs.count()
            links = checkpointed(found if links is None else links.unionByName(found), "links")
            keep_last(paths)
        labels = _labels(links)
        if share == 1 and STAR_YIELD * linked < compared or not compared:
            break

    with scratch(spark) as paths:
        left = _undecided(posts, classes, labels)
        across = checkpointed(_can_link(_apart(left, percent), percent).select("g1", "g2"), "across")
        release(spark)
        # groups whose members lie in different components are paired with themselves
        known = _labelled(classes, labels)
        mixed = known.groupBy("g").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x <> y").select(F.col("g").alias("g1"), F.col("g").alias("g2"))
        first, second = (known.select(F.col("g").alias(f"g{k}"), F.col("cls").alias(x), F.col("component").alias(f"c{k}")) for k, x in ((1, "a"), (2, "b")))
        pairs = across.unionByName(mixed).join(first, "g1").join(second, "g2").where("c1 <> c2").select("a", "b")
        links = checkpointed(links.unionByName(_verified(pairs, rows, size, percent)), "links")
        keep_last(paths)
    component = _labelled(classes, _labels(links)).select(*sets, "component")
    found = rows.select("doc.doc_id", "row", *sets).join(component, sets, "left")
    found = found.select("doc_id", F.col("n").alias("n_shingles"), "row", F.coalesce("component", "row").alias("component"))
    return found


def _stars(left: DataFrame, percent: int, share: int) -> DataFrame:
    """g1, g2: groups of ``left`` (posts with components x, y, of one in ``share`` shingles) and the hub of another component that each shares most with."""
    hub = F.struct(*[F.col(c).alias(f"{c}1") for c in ("g", "n", "x", "y")])
    hubs = left.groupBy("key").agg(F.min_by(hub, F.struct("p", F.xxhash64("g"))).alias("hub"))
    pairs = left.join(hubs, "key").select("hub.*", *[F.col(c).alias(f"{c}2") for c in ("g", "n", "x", "y")])
    pairs = pairs.where((F.col("g1") != F.col("g2")) & _not_one_component() & _enough(F.col("n1"), F.col("n2"), percent))
    # a likely partner shares a quarter of a prefix; the others wait for the last step
    met = pairs.groupBy("g1", "g2").agg(F.count("*").alias("count"), F.least(F.first("n1"), F.first("n2")).alias("n"))
    met = met.where(4 * share * 100 * F.col("count") >= (100 - percent) * F.col("n"))
    return met.groupBy("g2").agg(F.max_by("g1", F.struct("count", "g1")).alias("g1"))


def _not_one_component():
    return (F.col("x1") != F.col("y1")) | (F.col("x2") != F.col("y2")) | (F.col("x1") != F.col("x2"))


def _apart(left: DataFrame, percent: int) -> DataFrame:
    """A row a shared shingle of two groups (g1, n1, p1, g2, n2, p2) that are not in one component and may link.

    Of a shingle's groups only those outside its most common component are
    paired, with each other and with the rest.
    """
    whole = left.where("x = y").groupBy("key", "x").count().groupBy("key").agg(F.max_by("x", F.struct("count", "x")).alias("main"))
    placed = checkpointed(left.join(whole, "key", "left").withColumn("minor", ~((F.col("x") == F.col("y")) & F.col("x").eqNullSafe(F.col("main")))).drop("main"), "placed")
    one, two = (placed.select("key", *[F.col(c).alias(f"{c}{k}") for c in ("g", "n", "p", "x", "y", "minor")]) for k in (1, 2))
    n1, n2, p1, p2 = (F.col(c) for c in ("n1", "n2", "p1", "p2"))
    # an overlap of least = percent / (100 + percent) * (n1 + n2) shows in prefixes of n - least + 1,
    # and is at most what lies before a shared shingle in both, itself, and what lies behind it in both
    least, whole = percent * (n1 + n2), 100 + percent
    may = _enough(n1, n2, percent) & (whole * (n1 - p1) >= least) & (whole * (n2 - p2) >= least)
    may &= whole * (F.least(p1, p2) + 1 + F.least(n1 - p1 - 1, n2 - p2 - 1)) >= least
    once = (F.col("g1") != F.col("g2")) & (~F.col("minor2") | (F.col("g1") < F.col("g2")))
    return one.where("minor1").join(two, "key").where(once & _not_one_component() & may)


def _labels(links: DataFrame) -> DataFrame:
    """Components of the links; tables of the rounds before go."""
    with scratch(links.sparkSession) as paths:
        labels = connected_components(links)
        keep_last(paths)
    release(links.sparkSession)
    return labels


def _labelled(classes: DataFrame, labels: DataFrame) -> DataFrame:
    found = classes.join(labels.withColumnRenamed("node", "cls"), "cls", "left")
    return found.withColumn("component", F.coalesce("component", "cls"))


def _undecided(posts: DataFrame, classes: DataFrame, labels: DataFrame) -> DataFrame:
    """Posts of the keys whose groups do not all lie in one component, with the group's least and greatest component (x, y)."""
    of_group = _labelled(classes, labels).groupBy("g").agg(F.min("component").alias("x"), F.max("component").alias("y"))
    known = checkpointed(posts.join(of_group, "g"), "posts")
    spread = known.groupBy("key").agg(F.min("x").alias("x"), F.max("y").alias("y")).where("x <> y").select("key")
    return checkpointed(known.join(checkpointed(spread, "keys"), "key").dropDuplicates(["key", "g"]), "posts")


def keep_one_of_each(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one row of each component: that with the smallest id (nulls last), of equal ids the first read; columns as before."""
    found, rows = jaccard_components(docs, size, percent)
    kept = checkpointed(found.groupBy("component").agg(F.min_by("row", F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("row")).select("row"), "kept")
    others = found.select("row").join(kept, "row", "left_anti")
    columns = ["text" if c == "text" else F.col(f"doc.`{c}`").alias(c) for c in docs.columns]
    return _only(rows, kept, others).select(*columns)


def op4_ngram_jaccard(spark, sf_dir: str) -> DataFrame:
    found, _ = jaccard_components(documents(spark, sf_dir))
    least = found.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    return found.join(least, "component").select("doc_id", "n_shingles", "component_id")
