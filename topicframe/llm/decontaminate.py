"""Benchmark decontamination: CGK embedding, bit-sampling LSH and exact edit verification.

A leak is a window of a document, as long as a benchmark item, within an
edit distance over words of ``SHARE`` of the item's words; a text that is shorter than the
item is a window as a whole. Items of fewer than ``LEAST_WORDS`` words leak
where they occur exactly. Words are runs of letters and digits, A-Z
lower-cased.

1. Windows of each item length are screened: within k edits a window keeps
   (m - 1) - 2k of the item's m - 1 word pairs (the q-gram lemma), so a
   window with fewer pairs that occur in items of its length holds no leak.
   This loses nothing.
2. The random walk of Chakraborty, Goldenberg and Koucky embeds a window in
   3m steps: each step copies the word under the pointer, and a random bit
   of (step, word) says whether the pointer moves. Strings at small edit
   distance become strings at small Hamming distance.
3. A key samples ``SAMPLES`` steps of one walk. Walks are repeated until a
   window at the largest distance is met with probability ``RECALL``; how
   many that takes is measured for each item length, by the same walks on
   items edited at random. Lengths whose walks would be too many do without:
   their windows are compared with every item of the length.
4. Windows and items of one length that share a key are verified by the
   edit distance itself, by dynamic programming in a band.

Items are handled in blocks of ``BLOCK_ITEMS``, each sent to all tasks: the
documents are scanned once a block and nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicframe.llm.common import documents, gathered, read_table
from topicframe.llm.spans import Words, combine, mix, text_chunks

SHARE = 0.2
SAMPLES = 2
RECALL = 0.95
#: Edited items of each length and kind of edit that the number of walks is measured on.
TRIALS = 400
KINDS = 5
#: From so many walks on it is cheaper to compare all pairs.
ALL_PAIRS = 128
LEAST_WORDS = 8
BLOCK_ITEMS = 20_000
#: Windows that are gathered before they are embedded.
GATHERED = 100_000
PAD = np.uint64(0)
#: Everything of ASCII but letters and digits separates.
NOT_WORD = bytes(c for c in range(128) if not chr(c).isalnum())


def edits(m: int, share: float = SHARE) -> int:
    """Largest edit distance of a leak of an item of ``m`` words."""
    return int(m * share) if m >= LEAST_WORDS else 0


def sampled_key(symbols: np.ndarray, walk: int) -> np.ndarray:
    """Key of each row of ``symbols`` (n x m words): SAMPLES steps of its walk number ``walk``."""
    n, m = symbols.shape
    rng = np.random.default_rng([walk, m])
    steps = set(rng.choice(3 * m, SAMPLES, replace=False).tolist())
    salt = mix(np.arange(1, 3 * m + 1, dtype=np.uint64) + np.uint64((walk + 1) << 20))
    padded = np.hstack([symbols, np.full((n, 1), PAD)])
    at, rows, key = np.zeros(n, np.int64), np.arange(n), np.zeros(n, np.uint64)
    for j in range(max(steps) + 1):
        symbol = padded[rows, at]
        if j in steps:
            key = mix(key * np.uint64(0x9E3779B97F4A7C15) + symbol + np.uint64(j))
        bit = (mix(symbol + salt[j]) >> np.uint64(63)).astype(np.int64)
        at = np.minimum(at + bit, m)
    return key


def edit_distance(a: np.ndarray, b: np.ndarray, most: int, size: np.ndarray | None = None) -> np.ndarray:
    """Edit distance of the rows of ``a`` (their first ``size`` words) and ``b`` (both n x m), or most + 1 where it is larger."""
    n, m = a.shape
    far = most + 1
    short = {} if size is None else {int(i): np.flatnonzero(size == i) for i in np.unique(size[size < m])}
    out = np.full(n, far, np.int16)
    before = np.full((2 * most + 3, n), far, np.int16)  # diagonals -most - 1 .. most + 1
    for d in range(most + 1):
        before[most + 1 + d] = d
    for i in range(1, m + 1):
        now = np.full_like(before, far)
        for d in range(-most, most + 1):
            j = i + d
            if 0 <= j <= m:
                k = d + most + 1
                if j == 0:
                    now[k] = min(i, far)
                    continue
                best = before[k] + (a[:, i - 1] != b[:, j - 1])
                best = np.minimum(best, before[k + 1] + 1)
                now[k] = np.minimum(np.minimum(best, now[k - 1] + 1), far)
        before = now
        if i in short and m - i <= most:
            out[short[i]] = now[most + 1 + m - i, short[i]]
    whole = np.ones(n, bool) if size is None else size >= m
    out[whole] = before[most + 1, whole]
    return out


def _edited(rng: np.random.Generator, row: np.ndarray, kind: int, k: int) -> np.ndarray:
    """``row`` at distance ``k`` at most: words moved out and in (0), changed (1), gone from a text that ends there (2), or the first ones changed (3) or gone (4)."""
    m, words = len(row), list(row)
    new = lambda: np.uint64(rng.integers(1, 1 << 62))
    some = np.arange(k) if kind > 2 else rng.choice(m, (k % 2, k, k)[kind], replace=False)
    for _ in range(k // 2 if kind == 0 else 0):  # a word out and a word in keep the length
        del words[rng.integers(0, len(words))]
        words.insert(rng.integers(0, len(words) + 1), new())
    if kind in (2, 4):
        words = np.delete(row, some).tolist() + [PAD] * k
    else:
        for at in some:
            words[at] = new()
    return np.array(words, np.uint64)


def walks_needed(symbols: np.ndarray, share: float, recall: float, trials: int = TRIALS) -> int | None:
    """Walks 0, 1, ... until a randomly edited row of ``symbols`` (n x m) at the largest distance shares a key with probability ``recall``.

    Every kind of edit must reach it, two standard errors of the trials
    included. None if that takes ``ALL_PAIRS`` walks or more.
    """
    m = symbols.shape[1]
    k = edits(m, share)
    if not k:
        return 1
    rng = np.random.default_rng([7, m])
    picked = symbols[rng.integers(0, len(symbols), trials)]
    changed = np.concatenate([[_edited(rng, row, kind, k) for row in picked] for kind in range(KINDS)])
    picked, kind = np.tile(picked, (KINDS, 1)), np.repeat(np.arange(KINDS), trials)
    most = trials * (1 - min(1.0, recall + 2 * np.sqrt(recall * (1 - recall) / trials)))
    for walk in range(ALL_PAIRS - 1):
        key = sampled_key(np.concatenate([picked, changed]), walk)
        left = key[: len(picked)] != key[len(picked) :]
        picked, changed, kind = picked[left], changed[left], kind[left]
        if np.bincount(kind, minlength=KINDS).max() <= most:
            return walk + 1
    return None


class Index(NamedTuple):
    """Items of a block by their number of words."""

    pairs: np.ndarray  # sorted hashes of all word pairs
    pairs_of: dict[int, np.ndarray]  # whether an item of that size has each
    symbols: dict[int, np.ndarray]  # n x m
    ids: dict[int, np.ndarray]
    keys: dict[int, list[tuple[np.ndarray, np.ndarray]] | None]  # a walk: sorted keys, rows; None: all pairs
    share: float


def build_index(item_ids: list[int], texts: list[str], share: float = SHARE, recall: float = RECALL) -> Index:
    by_size: dict[int, list[tuple[int, np.ndarray]]] = {}
    at = 0
    for a, b, data, offsets in text_chunks(pa.array(texts, pa.string())):
        words = Words(data, offsets, NOT_WORD)
        hashes = words.hashes()
        first = np.searchsorted(words.row, np.arange(b - a + 1))
        for r in range(b - a):
            own = hashes[first[r] : first[r + 1]]
            if len(own):
                by_size.setdefault(len(own), []).append((item_ids[at + r], own))
        at += b - a
    symbols = {m: np.array([x[1] for x in rows]) for m, rows in by_size.items()}
    pairs_in = {m: np.unique(combine(rows.ravel(), np.repeat(np.arange(len(rows)), m), 2)[0]) for m, rows in symbols.items()}
    pairs = np.unique(np.concatenate([np.zeros(0, np.uint64), *pairs_in.values()]))
    pairs_of = {}
    for m, own in pairs_in.items():
        pairs_of[m] = np.zeros(len(pairs), bool)
        pairs_of[m][np.searchsorted(pairs, own)] = True
    keys: dict[int, list[tuple[np.ndarray, np.ndarray]] | None] = {}
    for m, rows in symbols.items():
        walks = walks_needed(rows, share, recall)
        keys[m] = None if walks is None else []
        if walks is None:
            continue
        for walk in range(walks):
            key = sampled_key(rows, walk)
            order = np.argsort(key, kind="stable")
            keys[m].append((key[order], order))
    return Index(pairs, pairs_of, symbols, {m: np.array([x[0] for x in rows]) for m, rows in by_size.items()}, keys, share)


def _screened(index: Index, data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, np.ndarray, tuple[np.ndarray, ...]]]:
    """By item size m: the windows that can hold a leak, m words each (PAD behind a shorter text), and their text, first and end character in it and number of words."""
    words = Words(data, offsets, NOT_WORD)
    hashes = words.hashes()
    if not len(hashes) or not index.pairs_of:
        return
    pair, at = combine(hashes, words.row, 2)
    if len(index.pairs):
        place = np.minimum(np.searchsorted(index.pairs, pair), len(index.pairs) - 1)
        hit = index.pairs[place] == pair
    else:
        place, hit = np.zeros(len(pair), np.int64), np.zeros(len(pair), bool)
    place, at = place[hit], at[hit]  # a pair's first word
    per_row = words.per_row()
    first = np.concatenate([[0], np.cumsum(per_row)])
    chars = None
    for m, has in index.pairs_of.items():
        k = edits(m, index.share)
        if m == 1:  # has no pairs
            start = np.flatnonzero(np.isin(hashes, index.symbols[1]))
        else:
            start = _starts(at[has[place]], m, max(1, m - 1 - 2 * k))
            start = start[start + m <= len(hashes)]
            start = start[words.row[start] == words.row[start + m - 1]]
        if k:  # texts that are shorter, by the same count of pairs
            count = np.bincount(words.row[at[has[place]]], minlength=len(per_row))
            short = first[:-1][(count >= max(1, m - 1 - 2 * k)) & (per_row < m) & (per_row >= m - k)]
        else:
            short = start[:0]
        if not len(start) and not len(short):
            continue
        if chars is None:
            chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        start = np.concatenate([start, short])
        row = words.row[start]
        size = np.minimum(per_row[row], m)
        begin = chars[offsets[row]]
        window = hashes[np.minimum(start[:, None] + np.arange(m), len(hashes) - 1)]
        window[np.arange(m) >= size[:, None]] = PAD
        yield m, window, (row, chars[words.start[start]] - begin, chars[words.end[start + size - 1]] - begin, size)


def _starts(own: np.ndarray, m: int, least: int) -> np.ndarray:
    """First words of the windows of ``m`` words that hold ``least`` of the pairs at ``own``; texts are not told apart."""
    if len(own) < least:
        return np.zeros(0, np.int64)
    # `least` pairs within one window: it may start from `low` to `high`
    high = own[: len(own) - least + 1]
    low = np.maximum(own[least - 1 :] - m + 2, 0)
    some = low <= high
    size = (high - low + 1)[some]
    return np.unique(np.repeat(low[some], size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size))


def _meetings(window_keys: np.ndarray, keys: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(window, item row) pairs with the same key."""
    a, b = np.searchsorted(keys, window_keys, "left"), np.searchsorted(keys, window_keys, "right")
    n = b - a
    window = np.repeat(np.arange(len(window_keys)), n)
    return window, rows[np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(a, n)]


def _matched(index: Index, m: int, window: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """window, row of the item, distance: pairs that share a key and lie within the distance. ``size``: words of each window."""
    k, items = edits(m, index.share), index.symbols[m]
    if index.keys[m] is None:
        step = max(1, 50_000 // len(items))
        parts = (np.arange(at, min(at + step, len(window))) for at in range(0, len(window), step))
        met = (np.stack([np.repeat(part, len(items)), np.tile(np.arange(len(items)), len(part))], axis=1) for part in parts)
    else:
        pairs = [np.zeros((0, 2), np.int64)]
        for walk, (keys, rows) in enumerate(index.keys[m]):
            pairs.append(np.stack(_meetings(sampled_key(window, walk), keys, rows), axis=1))
        both = np.unique(np.concatenate(pairs), axis=0)
        met = np.array_split(both, max(1, len(both) // 50_000))
    found = [(np.zeros((0, 2), np.int64), np.zeros(0, np.int64))]
    for x in met:
        d = edit_distance(window[x[:, 0]], items[x[:, 1]], k, size[x[:, 0]]).astype(np.int64)
        found.append((x[d <= k], d[d <= k]))
    both, d = (np.concatenate(x) for x in zip(*found, strict=True))
    return both[:, 0], both[:, 1], d


def leaks(index: Index, column: pa.Array) -> tuple[np.ndarray, ...]:
    """text, item id, first and end character, distance, words: the nearest window (the first of equals) of each text and item.

    Windows of one size are gathered from many texts before they are embedded.
    """
    found: list[tuple[np.ndarray, ...]] = []
    held: dict[int, list] = {}
    waiting = 0

    def match() -> None:
        for m, parts in held.items():
            window = np.concatenate([p[0] for p in parts])
            row, first, end, size = (np.concatenate([p[1][k] for p in parts]) for k in range(4))
            w, item, d = _matched(index, m, window, size)
            found.append((row[w], index.ids[m][item], first[w], end[w], d, np.full(len(w), m)))
        held.clear()

    for a, _, data, offsets in text_chunks(column):
        for m, window, (row, first, end, size) in _screened(index, data, offsets):
            held.setdefault(m, []).append((window, (a + row, first, end, size)))
            waiting += len(window)
        if waiting > GATHERED:
            match()
            waiting = 0
    match()
    if not sum(len(x[0]) for x in found):
        return tuple(np.zeros(0, np.int64) for _ in range(6))
    row, item, first, end, d, m = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.lexsort((first, d, item, row))
    row, item, first, end, d, m = (x[order] for x in (row, item, first, end, d, m))
    best = np.concatenate([[True], (row[1:] != row[:-1]) | (item[1:] != item[:-1])])
    return tuple(x[best] for x in (row, item, first, end, d, m))


def _blocks(benchmark: DataFrame, share: float, recall: float, block: int) -> Iterator[Index]:
    items = benchmark.where(F.col("text").isNotNull() & F.col("item_id").isNotNull()).select(F.col("item_id").cast("bigint").alias("item_id"), "text").distinct()
    parts = max(1, -(-items.count() // block))
    for k in range(parts):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == k).orderBy("item_id", "text").collect()
        yield build_index([r["item_id"] for r in rows], [r["text"] for r in rows], share, recall)


def find_leaks(docs: DataFrame, benchmark: DataFrame, share: float = SHARE, recall: float = RECALL, block: int = BLOCK_ITEMS) -> DataFrame:
    """doc_id, item_id, start, end, distance, item_words of the leaks in ``docs`` (doc_id, text).

    A row for each document row and item that it leaks: its nearest window,
    the first of equals; start and end are code points, end exclusive.
    Null and empty texts leak nothing, nor do null items and items without
    words; items with fewer than 8 words leak where they occur exactly. A
    text shorter than an item leaks it as a whole or not at all. Equal items with other ids are
    items of their own; of an id with several texts the nearest counts.
    Repeated document rows are repeated; other columns are not read.
    """
    spark = docs.sparkSession
    out = None
    for index in _blocks(benchmark, share, recall, block):
        given = spark.sparkContext.broadcast(tuple(index))

        def scan(batches: Iterator[pa.RecordBatch], given=given) -> Iterator[pa.RecordBatch]:
            index = Index(*given.value)
            for batch in gathered(batches):
                row, *numbers = leaks(index, batch.column(1))
                columns = [batch.column(0).take(pa.array(row)), *map(pa.array, numbers)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "item_id", "start", "end", "distance", "item_words"])

        found = docs.select("doc_id", "text").mapInArrow(scan, f"doc_id {dict(docs.dtypes)['doc_id']}, item_id long, start long, end long, distance long, item_words long")
        out = found if out is None else out.unionByName(found)
    return out


def drop_leaking(docs: DataFrame, benchmark: DataFrame, share: float = SHARE, recall: float = RECALL, block: int = BLOCK_ITEMS) -> DataFrame:
    """``docs`` without the rows that hold a leak; columns as before."""
    spark = docs.sparkSession
    text_at = docs.columns.index("text")
    for index in _blocks(benchmark, share, recall, block):
        given = spark.sparkContext.broadcast(tuple(index))

        def clean(batches: Iterator[pa.RecordBatch], given=given) -> Iterator[pa.RecordBatch]:
            index = Index(*given.value)
            for batch in gathered(batches):
                keep = np.ones(batch.num_rows, bool)
                keep[leaks(index, batch.column(text_at))[0]] = False
                yield batch.filter(pa.array(keep))

        docs = docs.mapInArrow(clean, docs.schema)
    return docs


def op2_cgk_decontamination(spark, sf_dir: str) -> DataFrame:
    return find_leaks(documents(spark, sf_dir), read_table(spark, sf_dir, "benchmark"))
