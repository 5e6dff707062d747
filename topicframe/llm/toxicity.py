"""Toxicity: non-negative positive-unlabelled learning on whole texts.

Features of a text are the letter runs (A-Z lower-cased) it contains and
their first 4, 5 and 6 bytes, by 64-bit hash, present or not.

1. Confirmed toxic examples: at most ``MAX_POSITIVE`` labelled ids, taken by
   hash, so the ids can be broadcast. The class prior is the share of toxic
   rows among all labelled training rows, plus a standard error: with few
   labels it errs towards finding them.
2. Spark counts how many of these texts, and how many of all training
   texts, have each feature; the ``FEATURES`` that speak most clearly for
   the toxic ones are kept.
3. Up to ``MEMBERS`` numpy classifiers, each in a task on its share of the
   examples and of at most ``MAX_UNLABELLED`` unlabelled texts, minimise

       prior * R_p(+) + max(0, R_u(-) - prior * R_p(-))

   with the logistic loss; where the bracket is negative the step goes the
   other way, so the negative risk cannot be overfitted below zero.
4. Every text is scored where it lies: the mean of the classifiers'
   probabilities.

Labels are used only of rows whose crc32(id as text) mod 3 is not 1.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicframe.llm.common import bucket_of_id, checkpointed, documents, fresh_name, most_frequent, read_table
from topicframe.llm.spans import Words, text_chunks

MAX_POSITIVE = 20_000
MAX_UNLABELLED = 40_000
FEATURES = 4096
CANDIDATES = 1 << 16
LEAST_TEXTS = 4
MEMBERS = 4
#: Examples that a classifier needs before there is another.
MEMBER_TEXTS = 200
STEPS = 300
THRESHOLD = 0.7
PREFIXES = (4, 5, 6)
#: Everything of ASCII but letters separates.
NOT_LETTERS = bytes(c for c in range(128) if not chr(c).isalpha())


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, feature) of the texts, repeated as often as they occur."""
    words = Words(data, offsets, NOT_LETTERS)
    size = words.end - words.start
    rows, keys = [words.row], [words.hashes()]
    for n in PREFIXES:
        longer = size > n
        rows.append(words.row[longer])
        keys.append(words.hashes(longest=n)[longer])
    return np.concatenate(rows), np.concatenate(keys)


def _distinct(row: np.ndarray, item: np.ndarray, n_items: int) -> tuple[np.ndarray, np.ndarray]:
    both = np.unique(row.astype(np.int64) * n_items + item)
    return both // n_items, both % n_items


def _known(row: np.ndarray, keys: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text, place in the sorted array ``known``) of the features that it has."""
    if not len(known):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
    hit = known[at] == keys
    return _distinct(row[hit], at[hit], len(known))


def texts_with(docs: DataFrame, known: np.ndarray | None = None) -> DataFrame:
    """key, n: the texts of ``docs`` (text) that have each feature (of ``known``, sorted, if given)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        total = None if known is None else np.zeros(len(known), np.int64)
        for batch in batches:
            for _, _, data, offsets in text_chunks(batch.column(0)):
                row, keys = features(data, offsets)
                if total is not None:
                    total += np.bincount(_known(row, keys, known)[1], minlength=len(total))
                    continue
                order = np.lexsort((keys, row))
                row, keys = row[order], keys[order]
                new = np.concatenate([[True], (keys[1:] != keys[:-1]) | (row[1:] != row[:-1])])[: len(keys)]
                held.append(keys[new])
                if sum(map(len, held)) > 1 << 21:
                    yield _counted(np.concatenate(held))
                    held = []
        if total is not None:
            some = np.flatnonzero(total)
            yield pa.RecordBatch.from_pydict({"key": known[some].view(np.int64), "n": total[some]})
        elif held:
            yield _counted(np.concatenate(held))

    return docs.select("text").mapInArrow(count, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))


def _counted(keys: np.ndarray) -> pa.RecordBatch:
    key, n = np.unique(keys, return_counts=True)
    return pa.RecordBatch.from_pydict({"key": key.view(np.int64), "n": n.astype(np.int64)})


def fit_nnpu(
    positive: tuple[np.ndarray, np.ndarray], unlabelled: tuple[np.ndarray, np.ndarray], n_features: int, prior: float,
    steps: int = STEPS, rate: float = 0.1, shrink: float = 1e-4,
) -> np.ndarray:
    """Weights and bias (last) that minimise the non-negative PU risk.

    ``positive`` and ``unlabelled`` are rows of feature numbers: (start of
    each row and the end of the last, numbers).
    """
    parts = []
    for start, item in (positive, unlabelled):
        n = max(1, len(start) - 1)
        parts.append((np.repeat(np.arange(len(start) - 1), np.diff(start)), item, len(start) - 1, n))
    w = np.zeros(n_features + 1)
    w[-1] = np.log(prior / (1 - prior))
    m, v = np.zeros_like(w), np.zeros_like(w)

    def logits(row: np.ndarray, item: np.ndarray, n: int) -> np.ndarray:
        return np.bincount(row, w[item], n) + w[-1]

    def slope(row: np.ndarray, item: np.ndarray, by: np.ndarray) -> np.ndarray:
        return np.append(np.bincount(item, by[row], n_features), by.sum())

    sigmoid = lambda z: 1 / (1 + np.exp(-np.clip(z, -40, 40)))
    for t in range(1, steps + 1):
        (rp, ip, kp, np_), (ru, iu, ku, nu) = parts
        zp, zu = logits(rp, ip, kp), logits(ru, iu, ku)
        negative = np.logaddexp(0, zu).sum() / nu - prior * np.logaddexp(0, zp).sum() / np_
        of_negative = slope(ru, iu, sigmoid(zu) / nu) - prior * slope(rp, ip, sigmoid(zp) / np_)
        step = prior * slope(rp, ip, -sigmoid(-zp) / np_) + of_negative if negative >= 0 else -of_negative
        step[:-1] += shrink * w[:-1]
        m, v = 0.9 * m + 0.1 * step, 0.999 * v + 0.001 * step**2
        w = w - rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w


class ToxicityModel(NamedTuple):
    keys: np.ndarray  # sorted hashes of the features
    weights: np.ndarray  # a row a classifier: a weight a feature, then the bias
    prior: float


def clearest_features(
    keys: np.ndarray, n: np.ndarray, all_keys: np.ndarray, n_all: np.ndarray, n_positive: int, n_texts: int, most: int = FEATURES
) -> np.ndarray:
    """Hashes (sorted) of the features with the largest z of their share among the positive texts against all.

    ``keys`` (sorted) are in ``n`` positive texts, ``all_keys`` in ``n_all`` of all texts.
    """
    everywhere = np.zeros(len(keys))
    everywhere[np.searchsorted(keys, all_keys)] = n_all
    p, q = n / max(1, n_positive), (np.maximum(everywhere, n) + 0.5) / (n_texts + 1)
    z = (p - q) / np.sqrt(q / max(1, n_positive))
    good = np.flatnonzero((z >= 5) & (p >= 1.5 * q))
    return np.sort(keys[good[np.lexsort((keys[good], -z[good]))][:most]])


def fit_toxicity(docs: DataFrame, labels: DataFrame, max_positive: int = MAX_POSITIVE, max_unlabelled: int = MAX_UNLABELLED, members: int = MEMBERS) -> ToxicityModel:
    """A model from ``docs`` (doc_id, text) and ``labels`` (doc_id, toxic).

    A document is toxic if one of its labels is 1. Null labels and ids count
    for nothing. Without toxic training rows the model has no features, and
    gives every text the same low score.
    """
    marked = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & (bucket_of_id(3) != 1))
    marked = marked.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    share, n_marked = marked.agg(F.avg((F.col("toxic") == 1).cast("double")), F.count("*")).first()
    share = share or 0.0
    prior = float(min(0.5, max(0.001, share + np.sqrt(share * (1 - share) / max(1, n_marked)))))
    ids = marked.where("toxic = 1").select("doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_positive)
    training = docs.where(bucket_of_id(3) != 1).select("doc_id", "text")
    # the ids are bounded by max_positive; copies of a text count once
    toxic = training.join(F.broadcast(ids), "doc_id", "left_semi").dropDuplicates(["text"]).select("doc_id", "text")
    n_texts = training.count()
    n_toxic = toxic.count()
    members = max(1, min(members, n_toxic // MEMBER_TEXTS))
    if not n_toxic:
        return ToxicityModel(np.zeros(0, np.uint64), np.array([[np.log(prior / (1 - prior))]]), prior)
    candidates, seen = most_frequent(checkpointed(texts_with(toxic).where(F.col("n") >= LEAST_TEXTS), "toxic-features"), CANDIDATES)
    everywhere = texts_with(training, candidates).toArrow()  # a row a candidate
    keys = clearest_features(candidates, seen, everywhere["key"].to_numpy().view(np.uint64), everywhere["n"].to_numpy(), n_toxic, n_texts)

    rate = min(1.0, max_unlabelled / max(1, n_texts))
    drawn = training.where(F.pmod(F.xxhash64(F.lit("unlabelled"), "doc_id"), F.lit(1 << 20)) < int(rate * (1 << 20)))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in text_chunks(batch.column(2)):
                row, item = _known(*features(data, offsets), keys)
                places = np.searchsorted(row, np.arange(b - a + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), pa.ListArray.from_arrays(pa.array(places), pa.array(item.astype(np.int32)))],
                    ["member", "positive", "items"],
                )

    member = F.pmod(F.xxhash64("doc_id"), F.lit(members)).cast("int").alias("member")
    sample = toxic.select(member, F.lit(True).alias("positive"), "text").unionByName(drawn.select(member, F.lit(False).alias("positive"), "text"))

    def fit(group: pd.DataFrame) -> pd.DataFrame:
        sides = []
        for is_positive in (True, False):
            items = group["items"][group["positive"] == is_positive].to_list()
            start = np.concatenate([[0], np.cumsum([len(x) for x in items])]).astype(np.int64)
            sides.append((start, np.concatenate([np.zeros(0, np.int64), *items]).astype(np.int64)))
        return pd.DataFrame({"weights": [fit_nnpu(*sides, len(keys), prior).tobytes()]})

    fitted = sample.mapInArrow(rows, "member int, positive boolean, items array<int>").groupBy("member").applyInPandas(fit, "weights binary").collect()
    return ToxicityModel(keys, np.array([np.frombuffer(r[0]) for r in fitted]), prior)


def score_toxicity(docs: DataFrame, model: ToxicityModel, column: str = "score") -> DataFrame:
    """``docs`` with a score from 0 to 1 of each whole text; null texts are empty and get the score of no features.

    A column of that name is replaced; the others are as before.
    """
    keys, weights, _ = model
    docs = docs.drop(column)
    text_at = docs.columns.index("text")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [np.zeros(0)]
            for a, b, data, offsets in text_chunks(batch.column(text_at)):
                row, item = _known(*features(data, offsets), keys)
                z = np.array([np.bincount(row, w[item], b - a) + w[-1] for w in weights])
                scores.append((1 / (1 + np.exp(-np.clip(z, -40, 40)))).mean(axis=0))
            yield batch.append_column(pa.field(column, pa.float64()), pa.array(np.concatenate(scores)))

    return docs.mapInArrow(score, docs.withColumn(column, F.lit(0.0)).schema)


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the rows whose score is at least ``threshold``."""
    name = fresh_name(docs, "score")
    return score_toxicity(docs, fit_toxicity(docs, labels), name).where(F.col(name) < threshold).drop(name)


def op6_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = fit_toxicity(docs, read_table(spark, sf_dir, "labels").select("doc_id", "toxic"))
    scored = score_toxicity(docs, model)
    return scored.select("doc_id", (bucket_of_id(3) == 1).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
