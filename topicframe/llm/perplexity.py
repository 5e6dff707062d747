"""Quality rules: counts per text, and perplexity bands of a modified Kneser-Ney model.

The n-grams are of ``ORDER`` characters, each told apart from all others, as
symbol and in the contexts (a run of blanks is one symbol, letters have no
case), per language. Below the single characters lies a model of ``SYMBOLS``
classes of them (blanks, a-z, digits, punctuation, 17 classes of other
letters) times each character's share of its class, so that a character never
seen has a probability after any context. The n-grams of characters grow with
the corpus and stay a table; those of classes are at most
``SYMBOLS ** ORDER`` a language however much text they are counted from.

1. Every task counts the n-grams of its whole texts in numpy; Spark sums
   the tasks' counts by language, half of the texts (by the text's hash, so
   copies are together) and n-gram. The counts of the classes are sums of these.
2. One group a language and half turns the counts of classes into interpolated
   modified Kneser-Ney probabilities (three discounts an order, continuation
   counts below the top) and backoff weights, in arrays sorted by a 64-bit
   hash of the n-gram. For the n-grams of characters Spark does the same by
   sums over contexts and joins with the next lower order, for both halves at
   once, so each n-gram of a half gets its probability under the other.
3. The most frequent n-grams (at most ``SENT``) go to all tasks, and texts are
   scored where they lie by the half that they are not in, so no text vouches
   for itself. A text's other n-grams are joined with the table and summed by
   text, so none is lost.
4. Per model, the median and the median absolute deviation of the log
   perplexity over all texts that pass the base rules give a lower and an
   upper bound; texts outside are not kept, nor are those below the lower
   bound of the perplexity of the classes alone. A text above the upper bound may
   mix languages, so it is scored once more by stretches, each by the model
   that suits it best.

The ``models`` most frequent languages have models of their own; others
share one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from topicframe.llm.common import checkpointed, documents, frequency_step, gathered, least_step
from topicframe.llm.spans import Words, combine, mix, text_chunks

ORDER = 4
SYMBOLS = 48
MODELS = 16
CHUNK = 2 << 20
#: Bits of a character's symbol: 0 is the text's edge, others its code point and one.
BITS = 21
#: N-grams of characters that go to all tasks.
SENT = 1 << 20
#: Distinct n-grams that a task holds before it hands its counts on.
HELD = 1 << 20

#: Log10 perplexity of a text's characters, and of their classes.
SCORES = ["log_perplexity", "log_class_perplexity"]
#: Bounds: so many deviations below and above the median log10 perplexity, with a least deviation.
#: Below lie repetitions and, by their classes, strewn signs, close to prose. Texts that mix languages are sound:
#: beyond the upper bound each stretch counts as in the language that suits it best.
BAND_BELOW = 6.0
BAND_ABOVE = 8.0
#: Symbols of such a stretch.
STRETCH = 64
LEAST_DEVIATION = 0.004

MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50
SIGNS = b"#*$%&|<>"


def _classes() -> np.ndarray:
    """Class of each code point of the basic plane: 0 is the text's edge, 1 blank."""
    lower = np.array([ord(chr(c).lower()[0]) for c in range(0x10000)])
    out = 31 + lower % 17
    out[:128] = 30
    out[[*range(9, 14), 32]] = 1
    out[lower < 128] = np.where((lower >= 97) & (lower <= 122), lower - 95, out)[lower < 128]
    out[48:58] = 28
    out[[ord(c) for c in ".,;:!?'\"()-"]] = 29
    return out.astype(np.int64)


_CLASS: list[np.ndarray] = []
#: First of the classes of several characters, and of those of other letters.
SHARED, OTHER_LETTERS = 28, 31


def _tables() -> list[np.ndarray]:
    """Class and symbol of each code point of the basic plane."""
    if not _CLASS:
        symbol = np.array([ord(chr(c).lower()[0]) for c in range(0x10000)]) + 1
        symbol[[*range(9, 14)]] = 33  # as a blank
        _CLASS.extend([_classes(), symbol])
    return _CLASS


def characters(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Context (ORDER - 1 symbols of BITS) and symbol of each character of the texts (a closing edge counts as one), and each text's first."""
    points = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32).astype(np.int64)
    chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[offsets]
    symbol = np.where(points < 0x10000, _tables()[1][np.minimum(points, 0xFFFF)], points + 1)
    keep = np.ones(len(symbol), bool)
    keep[1:] = (symbol[1:] != 33) | (symbol[:-1] != 33)
    keep[chars[:-1][chars[:-1] < len(symbol)]] = True
    kept = np.concatenate([[0], np.cumsum(keep)])[chars]
    n_rows, pad = len(offsets) - 1, ORDER
    row = np.repeat(np.arange(n_rows), np.diff(kept))
    line = np.zeros(kept[-1] + pad * n_rows + 1, np.int64)
    line[np.arange(kept[-1]) + pad * row + pad - 1] = symbol[keep]
    # text r: ORDER - 1 edges, its symbols, one edge
    context = line[: len(line) - pad]
    for k in range(1, ORDER - 1):
        context = context << BITS | line[k : len(line) - pad + k]
    first = kept + np.arange(n_rows + 1)  # symbols of a text: its own and the closing edge
    target = np.arange(first[-1]) + (pad - 1) * np.repeat(np.arange(n_rows), np.diff(first))
    return context[target], line[target + pad - 1], first


def classes(symbol: np.ndarray) -> np.ndarray:
    """Class of each symbol."""
    point = symbol - 1
    cls = np.where(point < 0x10000, _tables()[0][np.clip(point, 0, 0xFFFF)], OTHER_LETTERS + point % (SYMBOLS - OTHER_LETTERS))
    return np.where(symbol == 0, 0, cls)


def class_codes(context: np.ndarray, symbol: np.ndarray) -> np.ndarray:
    """Code of the classes of n-grams of characters."""
    code = np.zeros(len(symbol), np.int64)
    for k in range(ORDER - 2, -1, -1):
        code = code * SYMBOLS + classes(context >> (BITS * k) & ((1 << BITS) - 1))
    return code * SYMBOLS + classes(symbol)


def symbols(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """n-gram code of the classes of each character of the texts with its context, and each text's first."""
    context, symbol, first = characters(data, offsets)
    return class_codes(context, symbol), first


def distinct_grams(group: np.ndarray, context: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The place of each (group, context, symbol) among the distinct ones, and these."""
    at, contexts = pd.factorize(context)
    which, keys = pd.factorize((group * len(contexts) + at) << BITS | symbol)
    pair = keys >> BITS
    return which, pair // max(1, len(contexts)), contexts[pair % max(1, len(contexts))], keys & ((1 << BITS) - 1)


def _merged(parts: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    *grams, n = (np.concatenate(x) for x in zip(*parts))
    which, *grams = distinct_grams(*grams)
    return *grams, np.bincount(which, n, len(grams[0])).astype(np.int64)


def text_key() -> Column:
    """Hash of the text; null and empty are the same. Its last bit is the text's half."""
    return F.xxhash64(F.coalesce("text", F.lit("")))


def model_of(langs: list[str]) -> Column:
    """Number of the row's model: 1 on for ``langs``, 0 for other languages."""
    return F.array_position(F.array(*map(F.lit, langs)).cast("array<string>"), F.coalesce(F.col("lang").cast("string"), F.lit(""))).cast("int")


def _groups(batch: pa.RecordBatch, model: int, key: int) -> np.ndarray:
    """Twice the model and the half of each row."""
    return 2 * batch.column(model).to_numpy().astype(np.int64) + (batch.column(key).to_numpy() & 1)


def ngram_counts(texts: DataFrame) -> DataFrame:
    """model, context, symbol, n0, n1 over all of ``texts`` (text, model, text_key): how often either half's texts have each n-gram."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[tuple[np.ndarray, ...]] = []

        def handed() -> Iterator[pa.RecordBatch]:
            group, context, symbol, n = _merged(parts)
            for at in range(0, len(n), 1 << 16):
                some = slice(at, at + (1 << 16))
                half = group[some] & 1
                columns = [group[some] >> 1, context[some], symbol[some], n[some] * (1 - half), n[some] * half]
                yield pa.RecordBatch.from_arrays([pa.array(c.astype(t)) for c, t in zip(columns, types)], names)

        for batch in batches:
            group = _groups(batch, 1, 2)
            for a, b, data, offsets in text_chunks(batch.column(0), CHUNK):
                context, symbol, first = characters(data, offsets)
                which, *grams = distinct_grams(np.repeat(group[a:b], np.diff(first)), context, symbol)
                parts.append((*grams, np.bincount(which)))
                if len(parts) > 8:
                    parts[:] = [_merged(parts)]
                if sum(len(p[0]) for p in parts) > 2 * HELD:
                    yield from handed()
                    parts.clear()
        if parts:
            yield from handed()

    names, types = ["model", "context", "symbol", "n0", "n1"], [np.int32, np.int64, np.int32, np.int64, np.int64]
    counted = texts.select("text", "model", "text_key").mapInArrow(count, "model int, context long, symbol int, n0 long, n1 long")
    return counted.groupBy("model", "context", "symbol").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))


def class_counts(grams: DataFrame) -> DataFrame:
    """model, half, code, n of the classes of ``grams`` (as of :func:`ngram_counts`); code -1 - c is the character c of a class of several."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in gathered(batches):
            model, context, symbol, *counts = (batch.column(k).to_numpy().astype(np.int64) for k in range(5))
            code = class_codes(context, symbol)
            shared = code % SYMBOLS >= SHARED
            for half, n in enumerate(counts):
                keys = np.concatenate([model << 32 | code, (model << 32 | symbol)[shared] + (1 << 31)])
                n = np.concatenate([n, n[shared]])
                at, keys = pd.factorize(keys[n > 0])
                n = np.bincount(at, n[n > 0], len(keys)).astype(np.int64)
                letter = (keys >> 31 & 1).astype(bool)
                low = keys & ((1 << 31) - 1)
                columns = [(keys >> 32).astype(np.int32), np.full(len(keys), half, np.int8), np.where(letter, -low, low).astype(np.int32), n]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["model", "half", "code", "n"])

    counted = grams.select("model", "context", "symbol", "n0", "n1").mapInArrow(count, "model int, half byte, code int, n long")
    return counted.groupBy("model", "half", "code").agg(F.sum("n").alias("n"))


def _hash(order: int, code: np.ndarray) -> np.ndarray:
    return mix(code.astype(np.uint64) + (np.uint64(order) << np.uint64(40)))


def _discounts(n: np.ndarray) -> np.ndarray:
    """Modified Kneser-Ney discounts of counts 0, 1, 2 and 3 or more."""
    c = [max(1, int((n == k).sum())) for k in range(1, 5)]
    y = c[0] / (c[0] + 2 * c[1])
    raw = [k - (k + 1) * y * c[k] / c[k - 1] for k in range(1, 4)]
    return np.array([0.0] + [min(max(d, 0.05), k - 0.05) for k, d in enumerate(raw, 1)])


def kneser_ney(code: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sorted hashes and log10 probabilities of the n-grams of all orders; sorted hashes and log10 backoffs of their contexts."""
    order = np.argsort(code)
    grams = {ORDER: (code[order].astype(np.int64), n[order].astype(np.int64))}
    for k in range(ORDER - 1, 0, -1):  # distinct left extensions
        grams[k] = np.unique(grams[k + 1][0] % SYMBOLS**k, return_counts=True)
    lower = np.full(SYMBOLS, 1.0 / SYMBOLS)
    lower_codes = np.arange(SYMBOLS)
    hashes, values, contexts, backoffs = [_hash(0, np.arange(SYMBOLS))], [np.log10(lower)], [], []
    for k in range(1, ORDER + 1):
        codes, counts = grams[k]
        d = _discounts(counts)[np.minimum(counts, 3)]
        context, at = np.unique(codes // SYMBOLS, return_inverse=True)
        total = np.bincount(at, counts)
        gamma = np.bincount(at, d) / total
        below = lower[np.searchsorted(lower_codes, codes % SYMBOLS ** max(1, k - 1) if k > 1 else codes)]
        p = (counts - d) / total[at] + gamma[at] * below
        hashes.append(_hash(k, codes))
        values.append(np.log10(p))
        contexts.append(_hash(k, context))
        backoffs.append(np.log10(gamma))
        lower, lower_codes = p, codes
    h, v, c, b = (np.concatenate(x) for x in (hashes, values, contexts, backoffs))
    by_h, by_c = np.argsort(h), np.argsort(c)
    return h[by_h], v[by_h].astype(np.float32), c[by_c], b[by_c].astype(np.float32)


def letter_shares(letter: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The letters, sorted, and the log10 of each one's share of its class; first a row a class (below 0) for letters never seen."""
    order = np.argsort(letter)
    letter, n = letter[order].astype(np.int64), n[order]
    cls = classes(letter + 1) - SHARED
    total, distinct = (np.bincount(cls, w, SYMBOLS - SHARED) for w in (n, np.ones(len(n))))
    rest = total + distinct  # Witten and Bell: a new letter is as likely as the letters of the class were new
    unseen = np.log10(np.maximum(distinct, 1) / np.maximum(rest, 1))
    return np.concatenate([np.arange(-len(total), 0), letter]).astype(np.int32), np.concatenate([unseen, np.log10(n / rest[cls])]).astype(np.float32)


MODEL_SCHEMA = "model int, half byte, hashes binary, values binary, contexts binary, backoffs binary, letters binary, shares binary"


def build_models(counts: DataFrame) -> DataFrame:
    """A row a model and half with its arrays, from :func:`class_counts`; a group has at most SYMBOLS ** ORDER rows, and a row a letter."""

    def build(group: pd.DataFrame) -> pd.DataFrame:
        code, n = group["code"].to_numpy(), group["n"].to_numpy()
        gram = code >= 0
        arrays = *kneser_ney(code[gram], n[gram]), *letter_shares(-1 - code[~gram], n[~gram])
        names = ["model", "half", "hashes", "values", "contexts", "backoffs", "letters", "shares"]
        return pd.DataFrame([[group["model"].iloc[0], group["half"].iloc[0], *(a.tobytes() for a in arrays)]], columns=names)

    return counts.groupBy("model", "half").applyInPandas(build, MODEL_SCHEMA)


def _find(keys: np.ndarray, among: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(among):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(among, keys), len(among) - 1)
    return at, among[at] == keys


class Scorer:
    """log10 probability of n-gram codes of classes under the arrays of one model."""

    #: Scratch of a worker's scorers; each call writes what it reads.
    table = np.zeros(0, np.float32)

    def __init__(self, hashes: bytes, values: bytes, contexts: bytes, backoffs: bytes, letters: bytes = b"", shares: bytes = b""):
        self.letters, self.shares = np.frombuffer(letters, np.int32), np.frombuffer(shares, np.float32)
        self.hashes, self.contexts = np.frombuffer(hashes, np.uint64), np.frombuffer(contexts, np.uint64)
        self.values, self.backoffs = np.frombuffer(values, np.float32), np.frombuffer(backoffs, np.float32)

    def share(self, letter: np.ndarray) -> np.ndarray:
        """log10 of the share of the letters among those of their class."""
        at, hit = _find(letter, self.letters)
        return np.where(hit, self.shares[at], self.shares[classes(letter + 1) - SHARED])

    def distinct(self, codes: np.ndarray) -> np.ndarray:
        out = np.zeros(len(codes))
        todo = np.arange(len(codes))
        for k in range(ORDER, -1, -1):
            code = codes[todo] % SYMBOLS ** max(k, 1)
            at, hit = _find(_hash(k, code), self.hashes)
            out[todo[hit]] += self.values[at[hit]]
            todo, code = todo[~hit], code[~hit]
            if not len(todo):
                break
            at, known = _find(_hash(k, code // SYMBOLS), self.contexts)
            out[todo[known]] += self.backoffs[at[known]]
        return out

    def __call__(self, codes: np.ndarray) -> np.ndarray:
        if len(codes) < 50_000:
            some, at = np.unique(codes, return_inverse=True)
            return self.distinct(some)[at]
        if not len(Scorer.table):
            Scorer.table = np.zeros(SYMBOLS**ORDER, np.float32)
        some = np.flatnonzero(np.bincount(codes))
        self.table[some] = self.distinct(some)
        return self.table[codes]

    def logs(self, codes: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """log10 probability of each symbol's class, by its code, and of the symbol: the class's times its share of it."""
        of_class = self(codes).astype(float)
        out, shared = of_class.copy(), codes % SYMBOLS >= SHARED
        out[shared] += self.share(symbol[shared] - 1)
        return of_class, out


def _discounts_of(half: int) -> Column:
    """:func:`_discounts` of the counts of a half, as an aggregate."""
    c = [F.greatest(F.lit(1), F.count_if(F.col(f"n{half}") == k)) for k in range(1, 5)]
    y = c[0] / (c[0] + 2 * c[1])
    raw = [F.lit(float(k)) - (k + 1) * y * c[k] / c[k - 1] for k in range(1, 4)]
    return F.array(F.lit(0.0), *(F.least(F.greatest(d, F.lit(0.05)), F.lit(k - 0.05)) for k, d in enumerate(raw, 1)))


def interpolated(grams: DataFrame) -> DataFrame:
    """``grams`` (model, context, symbol, n0, n1; each n-gram once) with seen0, rest0, seen1, rest1 in place of counts.

    ``seen`` is the probability of the symbol after its context by a half's
    n-grams of characters of all orders (interpolated modified Kneser-Ney),
    ``rest`` the weight that they leave to the order below the first. An
    n-gram that a half has not (count 0) gets what its shorter contexts give.
    """
    levels = {ORDER: grams}
    for k in range(ORDER - 1, 0, -1):  # distinct left extensions
        short = F.col("context").bitwiseAND((1 << BITS * (k - 1)) - 1)
        held = (F.count_if(F.col(f"n{h}") > 0).alias(f"n{h}") for h in (0, 1))
        levels[k] = checkpointed(levels[k + 1].groupBy("model", short.cast("long").alias("context"), "symbol").agg(*held), "quality-shorter")
    lower = None
    for k in range(1, ORDER + 1):
        discounts = levels[k].groupBy("model").agg(*(_discounts_of(h).alias(f"d{h}") for h in (0, 1)))
        level = levels[k].join(F.broadcast(discounts), "model")  # a row a model
        same = Window.partitionBy("model", "context")  # a row a character at most
        for h in (0, 1):
            n, d = F.col(f"n{h}"), F.get(f"d{h}", F.least(F.col(f"n{h}"), F.lit(3)).cast("int"))
            total = F.sum(n).over(same)
            level = level.withColumns({
                f"seen{h}": F.when(total > 0, (n - d) / total).otherwise(0.0),
                f"rest{h}": F.when(total > 0, F.sum(d).over(same) / total).otherwise(1.0),
            })
        values = ["seen0", "rest0", "seen1", "rest1"]
        if lower is not None:
            below = lower.select("model", F.col("context").alias("short"), "symbol", *(F.col(v).alias(f"{v}_below") for v in values))
            level = level.withColumn("short", F.col("context").bitwiseAND((1 << BITS * (k - 2)) - 1).cast("long")).join(below, ["model", "short", "symbol"])
            for h in (0, 1):
                level = level.withColumns({
                    f"seen{h}": F.col(f"seen{h}") + F.col(f"rest{h}") * F.col(f"seen{h}_below"),
                    f"rest{h}": F.col(f"rest{h}") * F.col(f"rest{h}_below"),
                })
        lower = level.select("model", "context", "symbol", "n0", "n1", *values)
    return lower


def gram_logs(values: DataFrame, arrays: Broadcast) -> DataFrame:
    """``values`` (as of :func:`interpolated`) with log0, log1, class0, class1: log10 probabilities of the symbol and of its class under either half, null where that has no text of the model."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorers: dict[tuple[int, int], Scorer] = {}
        for batch in gathered(batches):
            model, context, symbol = (batch.column(k).to_numpy().astype(np.int64) for k in range(3))
            code = class_codes(context, symbol)
            logs = np.full((4, len(code)), np.nan)
            for m in np.unique(model).tolist():
                mine = np.flatnonzero(model == m)
                for h in (0, 1):
                    if (m, h) not in arrays.value:
                        continue
                    if (m, h) not in scorers:
                        scorers[m, h] = Scorer(*arrays.value[m, h])
                    seen, rest = (batch.column(5 + 2 * h + k).to_numpy()[mine] for k in (0, 1))
                    logs[2 + h, mine], below = scorers[m, h].logs(code[mine], symbol[mine])
                    logs[h, mine] = np.log10(seen + rest * 10.0**below)
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], *(pa.array(x, from_pandas=True) for x in logs)], [*names, "log0", "log1", "class0", "class1"])

    names = ["model", "context", "symbol", "n0", "n1"]
    values = values.select(*names, "seen0", "rest0", "seen1", "rest1")
    return values.mapInArrow(score, "model int, context long, symbol int, n0 long, n1 long, log0 double, log1 double, class0 double, class1 double")


def judging(half: int, name: str = "log") -> Column:
    """The log that judges texts of ``half``: of the other half, or of their own where the other has no text of the model."""
    return F.coalesce(f"{name}{1 - half}", f"{name}{half}")


def by_half(logs: DataFrame) -> DataFrame:
    """model, half, context, symbol, n, logs of the n-grams of either half, from model, context, symbol, n0, n1, logs0, logs1."""
    halves = (F.struct(F.lit(h).alias("half"), F.col(f"n{h}").alias("n"), F.col(f"logs{h}").alias("logs")) for h in (0, 1))
    each = logs.select("model", "context", "symbol", F.explode(F.array(*halves)).alias("x"))
    return each.where("x.n > 0").select("model", "x.half", "context", "symbol", "x.n", "x.logs")


def gram_key(group: np.ndarray, context: np.ndarray, symbol: np.ndarray) -> np.ndarray:
    return mix(context.astype(np.uint64) + mix((group << BITS | symbol).astype(np.uint64)))


def sent_logs(table: DataFrame, most: int) -> tuple[Broadcast, DataFrame]:
    """The most frequent rows of ``table`` (model, half, context, symbol, n, logs), at most ``most``, as keys and logs in every task; the other rows."""
    bound = least_step(table.select("n"), most)
    sent = F.lit(False) if bound is None else frequency_step("n") >= bound
    got = table.where(sent).select("model", "half", "context", "symbol", "logs").toArrow()
    model, half, context, symbol = (got[c].to_numpy().astype(np.int64) for c in got.column_names[:4])
    keys = gram_key(2 * model + half, context, symbol)
    order = np.argsort(keys)
    logs = got["logs"].combine_chunks().flatten().to_numpy().reshape(len(keys), -1) if len(keys) else np.zeros((0, 1))
    return table.sparkSession.sparkContext.broadcast((keys[order], logs[order].T.astype(np.float32).copy())), table.where(~sent)


def run_sums(sent: tuple[np.ndarray, np.ndarray], width: int, group: np.ndarray, begin: np.ndarray, context: np.ndarray, symbol: np.ndarray) -> list[pa.Array]:
    """By runs of symbols (from ``begin``): the sums of the logs sent out, ``width`` of them, and contexts, symbols and times of the n-grams that are not."""
    keys, logs = sent
    which, *grams = distinct_grams(group, context, symbol)
    at, hit = _find(gram_key(*grams), keys)
    sums = np.zeros((len(begin), width))
    for k in range(width if len(keys) else 0):
        value = np.zeros(len(hit))
        value[hit] = logs[k, at[hit]]
        sums[:, k] = np.add.reduceat(value[which], begin)
    waits = np.flatnonzero(~hit[which])
    run = np.searchsorted(begin, waits, "right") - 1
    pair, times = np.unique(run * len(hit) + which[waits], return_counts=True)
    late, places = pair % len(hit), np.searchsorted(pair // len(hit), np.arange(len(begin) + 1)).astype(np.int32)
    lists = [grams[1][late], grams[2][late].astype(np.int32), times.astype(np.int32)]
    every = np.arange(len(begin) + 1, dtype=np.int32) * width
    return [pa.ListArray.from_arrays(pa.array(every), pa.array(sums.ravel())), *(pa.ListArray.from_arrays(pa.array(places), pa.array(x)) for x in lists)]


RUN_SCHEMA = "sums array<double>, contexts array<long>, symbols array<int>, times array<int>"


def late_sums(runs: DataFrame, rest: DataFrame, by: list[str], width: int) -> DataFrame:
    """``by``, late: sums of the logs of the n-grams of ``runs`` (``by``, model, text_key, contexts, symbols, times) that are not sent out."""
    waiting = runs.where(F.size("times") > 0)
    each = waiting.select("model", F.col("text_key").bitwiseAND(1).cast("int").alias("half"), *(c for c in by if c != "model"), F.explode(F.arrays_zip("contexts", "symbols", "times")).alias("w"))
    each = each.select("half", *dict.fromkeys(["model", *by]), F.col("w.contexts").alias("context"), F.col("w.symbols").alias("symbol"), F.col("w.times").alias("times"))
    sums = F.array(*(F.sum(F.col("times") * F.col("logs")[k]) for k in range(width)))
    return each.join(rest.drop("n"), ["model", "half", "context", "symbol"]).groupBy(*by).agg(sums.cast("array<double>").alias("late"))


def all_sums(width: int) -> Column:
    """The sums of a run with those that come late."""
    return F.zip_with("sums", F.coalesce("late", F.array_repeat(F.lit(0.0), width)), lambda x, y: x + y)


def repeated(keys: np.ndarray) -> np.ndarray:
    """Which of ``keys`` occur more than once."""
    s = np.sort(keys)
    twice = np.unique(s[1:][s[1:] == s[:-1]])
    if not len(twice):
        return np.zeros(len(keys), bool)
    return twice[np.minimum(np.searchsorted(twice, keys), len(twice) - 1)] == keys


def text_counts(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of each text."""
    n = len(offsets) - 1
    words = Words(data, offsets)
    sums = lambda mask: np.diff(np.concatenate([[0], np.cumsum(mask)])[offsets])
    blank, sign = np.zeros(256, bool), np.zeros(256, bool)
    blank[[9, 10, 11, 12, 13, 32]] = True
    sign[list(SIGNS)] = True
    word_chars = sums(~blank[data] & ((data & 0xC0) != 0x80))
    seeds = mix(np.arange(1, n + 1, dtype=np.uint64))  # tells equal strings of different texts apart

    lines = Words(data, offsets, b"\n")
    has_word = np.searchsorted(words.start, lines.end) > np.searchsorted(words.start, lines.start)
    row = lines.row[has_word]
    keys = np.unique(mix(lines.hashes(fold=False)[has_word] + seeds[row]), return_index=True)[1]
    dup_lines = np.bincount(row, minlength=n) - np.bincount(row[keys], minlength=n)

    grams, at = combine(words.hashes(fold=False), words.row, 3)
    again = at[repeated(mix(grams + seeds[words.row[at]]))]
    inside = np.zeros(len(words) + 3, bool)
    for k in range(3):
        inside[again + k] = True
    return words.per_row(), word_chars, sums(sign[data]), dup_lines, np.bincount(words.row[inside[: len(words)]], minlength=n)


def own_models(docs: DataFrame, models: int) -> list[str]:
    """The most frequent languages, at most ``models``."""
    by_rows = docs.groupBy(F.coalesce("lang", F.lit("")).alias("lang")).count().orderBy(F.desc("count"), "lang").limit(models).collect()
    return [r["lang"] for r in by_rows]


def quality_models(grams: DataFrame) -> Broadcast:
    """The arrays of the class models by model and half in every task (at most 2 * ``models`` + 2 of bounded size)."""
    built = build_models(class_counts(grams)).collect()
    return grams.sparkSession.sparkContext.broadcast({tuple(r)[:2]: tuple(r)[2:] for r in built})


def mixed_logs(grams: DataFrame, wanted: DataFrame, arrays: Broadcast, sound: list[int]) -> DataFrame:
    """The n-grams ``wanted`` (as of :func:`ngram_counts`, of one model 0) by half, with the log of each model of ``sound``."""
    none = F.lit(0).cast("long")
    asked = wanted.select(F.explode(F.array(*map(F.lit, sound)).cast("array<int>")).alias("model"), "context", "symbol", none.alias("n0"), none.alias("n1"))
    both = grams.where(F.col("model").isin(sound)).unionByName(asked).groupBy("model", "context", "symbol").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    values = interpolated(checkpointed(both, "quality-over-all")).join(wanted.select("context", "symbol"), ["context", "symbol"], "left_semi")
    logs = (F.array(*(F.max(F.when(F.col("model") == m, judging(h))) for m in sound)).cast("array<double>").alias(f"logs{h}") for h in (0, 1))
    return by_half(wanted.join(gram_logs(values, arrays).groupBy("context", "symbol").agg(*logs), ["context", "symbol"]))


def best_stretches(texts: DataFrame, table: DataFrame, width: int, stretch: int = STRETCH) -> DataFrame:
    """text_key, mixed: log10 perplexity of ``texts`` (text, text_key) when each stretch of symbols is scored by the one of ``width`` models that suits it best.

    ``table``: the logs of the texts' n-grams, as of :func:`mixed_logs`.
    """
    sent, rest = sent_logs(table, SENT // max(1, width))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key = batch.column(1).to_numpy()
            for a, b, data, offsets in text_chunks(batch.column(0), CHUNK):
                context, symbol, first = characters(data, offsets)
                size = np.diff(first)
                pieces = -(-size // stretch)
                piece = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                begin = np.repeat(first[:-1], pieces) + stretch * piece
                runs = run_sums(sent.value, width, np.repeat(key[a:b] & 1, size), begin, context, symbol)
                columns = [np.repeat(key[a:b], pieces), piece, np.diff(begin, append=len(symbol))]
                yield pa.RecordBatch.from_arrays([*map(pa.array, columns), *runs], names)

    names = ["text_key", "piece", "size", "sums", "contexts", "symbols", "times"]
    runs = checkpointed(texts.select("text", "text_key").mapInArrow(score, f"text_key long, piece long, size long, {RUN_SCHEMA}"), "quality-stretches")
    by = ["text_key", "piece"]
    late = checkpointed(late_sums(runs.withColumn("model", F.lit(0)), rest, by, width), "quality-stretches-late")  # its size is on record
    best = runs.join(late, by, "left").select("text_key", "size", F.array_max(all_sums(width)).alias("best"))
    return best.groupBy("text_key").agg((-F.sum("best") / F.sum("size")).alias("mixed"))


def score_quality(docs: DataFrame, langs: list[str], table: DataFrame) -> DataFrame:
    """doc_id, lang, its model, the text counts, base_failed, log10 perplexities (per symbol, of the characters and of their classes) and text_key (a hash) of every document.

    ``table``: the logs of the documents' n-grams (model, half, context, symbol, n, logs: of the symbol and of its class).
    """
    sent, rest = sent_logs(table, SENT)
    counted = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    names = ["doc_id", "lang", "model", "text_key", *counted, "size", "sums", "contexts", "symbols", "times"]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            group = _groups(batch, 2, 3)
            for a, b, data, offsets in text_chunks(batch.column(4), CHUNK):
                counts = text_counts(data, offsets)
                context, symbol, first = characters(data, offsets)
                size = np.diff(first)
                runs = run_sums(sent.value, 2, np.repeat(group[a:b], size), first[:-1], context, symbol)
                yield pa.RecordBatch.from_arrays([*(c.slice(a, b - a) for c in batch.columns[:4]), *(pa.array(c.astype(np.int64)) for c in (*counts, size)), *runs], names)

    schema = f"doc_id {dict(docs.dtypes)['doc_id']}, lang string, model int, text_key long, " + "".join(f"{c} long, " for c in [*counted, "size"]) + RUN_SCHEMA
    scored = checkpointed(docs.select("doc_id", F.col("lang").cast("string"), model_of(langs).alias("model"), text_key().alias("text_key"), "text").mapInArrow(score, schema), "quality-sums")
    by = ["model", "text_key"]
    late = checkpointed(late_sums(scored.where(F.size("times") > 0).dropDuplicates(by), rest, by, 2), "quality-late")  # its size is on record
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words"))
    perplexities = ((-all_sums(2)[k] / F.col("size")).alias(name) for k, name in enumerate(SCORES))
    return scored.join(late, by, "left").select("doc_id", "lang", "model", *counted, *perplexities, "text_key", failed.alias("base_failed"))


def perplexity_bands(scored: DataFrame, below: float = BAND_BELOW, above: float = BAND_ABOVE) -> DataFrame:
    """model, lower, upper, class_lower: around the medians over the texts that pass the base rules."""
    good = scored.where(~F.col("base_failed")).select("model", *SCORES)
    medians = good.groupBy("model").agg(*(F.percentile_approx(x, 0.5, 10_000).alias(f"{x}_median") for x in SCORES))
    away = good.join(F.broadcast(medians), "model")  # a row a model
    middle = [F.col(f"{x}_median") for x in SCORES]
    spread = away.groupBy("model", *middle).agg(*(F.percentile_approx(F.abs(F.col(x) - m), 0.5, 10_000).alias(f"{x}_mad") for x, m in zip(SCORES, middle)))
    dev, class_dev = (F.greatest(1.4826 * F.col(f"{x}_mad"), F.lit(LEAST_DEVIATION)) for x in SCORES)
    return spread.select("model", (middle[0] - below * dev).alias("lower"), (middle[0] + above * dev).alias("upper"), (middle[1] - below * class_dev).alias("class_lower"))


def judge_quality(docs: DataFrame, models: int = MODELS, below: float = BAND_BELOW, above: float = BAND_ABOVE) -> DataFrame:
    """doc_id, counts, base_failed, kept, lang, log_perplexity, lower, upper, log_class_perplexity, class_lower of every row of ``docs`` (doc_id, text, lang).

    ``kept`` is false where the base rules fail, the log10 perplexity lies
    outside its model's bounds or that of the characters' classes below its
    own lower one; a text above the upper one is judged by
    ``mixed`` instead, its perplexity when each stretch of it is scored by the
    model that suits it best (null for other texts). Null texts are empty, null languages are
    a language of their own. Repeated rows are judged each. Texts are scored by
    the half of the texts that they are not in, or by their own half where the
    other has none in their language. A model without a text that passes the base rules has no bounds (null). Other
    columns are not read. No rows give none.
    """
    langs = own_models(docs, models)
    texts = docs.select("text", model_of(langs).alias("model"), text_key().alias("text_key"))
    grams = checkpointed(ngram_counts(texts), "quality-ngrams")
    arrays = quality_models(grams)
    logs = gram_logs(interpolated(grams), arrays)
    table = checkpointed(by_half(logs.withColumns({f"logs{h}": F.array(judging(h), judging(h, "class")) for h in (0, 1)})), "quality-logs")
    scored = checkpointed(score_quality(docs, langs, table), "quality")
    bands = checkpointed(perplexity_bands(scored, below, above), "quality-bands")
    out = scored.join(F.broadcast(bands), "model", "left")  # at most models + 1 rows
    over = checkpointed(out.where(~F.col("base_failed") & (F.col("log_perplexity") > F.col("upper"))).select("text_key").distinct(), "quality-over")  # its size is on record: texts are not shuffled for a few keys
    sound = sorted(r["model"] for r in bands.select("model").collect())  # a model without a text that passes the base rules suits none
    again = checkpointed(texts.join(over, "text_key", "left_semi").dropDuplicates(["text_key"]).select("text", F.lit(0).alias("model"), "text_key"), "quality-over-texts")
    wanted = checkpointed(ngram_counts(again), "quality-over-ngrams")
    mixed = best_stretches(again, checkpointed(mixed_logs(grams, wanted, arrays, sound), "quality-over-logs"), len(sound))
    out = out.join(checkpointed(mixed, "quality-mixed"), "text_key", "left")
    out = out.withColumn("mixed", F.when(~F.col("base_failed") & (F.col("log_perplexity") > F.col("upper")), F.col("mixed")))
    inside = F.coalesce("mixed", "log_perplexity").between(F.col("lower"), F.col("upper")) & (F.col("log_class_perplexity") >= F.col("class_lower"))
    inside = F.coalesce(inside, F.lit(True))
    return out.withColumn("kept", ~F.col("base_failed") & inside).drop("model", "text_key")


def op8_ngram_perplexity(spark, sf_dir: str) -> DataFrame:
    return judge_quality(documents(spark, sf_dir, "doc_id", "text", "lang")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "lang", "log_perplexity", "lower", "upper"
    )
