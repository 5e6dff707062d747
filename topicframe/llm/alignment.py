"""Cross-tokenizer alignment by products of token-byte incidence matrices.

A text is tokenised by A and by B, each over the same bytes. Row i of A's
incidence matrix has a 1 in every byte that token i covers; B's is built
alike. The rows of A·Bᵀ, taken by Gustavson's scheme (:class:`csr.Csr`),
are the overlap links: token pairs with the number of bytes they share.
Where an A and a B token end together the text is cut into groups, and the
product of the token-group matrices gives the shared-group links. A link of
two tokens that end together is an overlap link with equal ends.

Neither tokenizer merges across the place between a character and a space
behind it, so a text is the sequence of its chunks (a space and what follows
up to the next such place) and the matrices are block diagonal. A block is
made once for each distinct chunk that a worker meets and kept in a bounded
table; a document's figures are the sums over its chunks, another product
by rows (document-chunk times chunk-link). A text for which the pieces do
not spell its own bytes is looked at once more as a whole.

Corpus counts of id pairs: each task adds up the pairs of its documents,
Spark sums them. The most frequent ``FREQUENT`` pairs go to every task; a
document's other pairs are joined with the counts, so no pair is left out.
The highest count of each B id is one number an entry of B's vocabulary.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicframe.llm.common import checkpointed, documents, fresh_name, most_frequent
from topicframe.llm.csr import Csr, spread

BYTE_TOKENIZER = "byte_bpe_50k.json"
BYTE_RANKS = "byte_bpe_50k.tiktoken"
PIECE_TOKENIZER = "piece_bpe_32k.model"

#: Chunks whose blocks a worker keeps; the table is emptied when it is full.
KEPT_CHUNKS = 600_000
#: Their characters, likewise.
KEPT_CHARS = 1 << 24
#: A chunk of more characters is encoded by the library whose merging does not slow down with length.
LONG_CHARS = 400
#: Characters of one text that are cut into chunks at once.
PIECE_CHARS = 1 << 20
#: Pairs whose counts every task gets.
FREQUENT = 1 << 20

#: Between a character and a space behind it.
CUT = re.compile(r"(?<=\S)(?= )")
MARK = "▁"
_SHIFT = 32


def tokenizer_path(name: str) -> str:
    """A path, or a name of ``public_tokenizers``."""
    if "/" in name:
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


#: Of a text: (n_a, n_b, n_groups, n_links), groups_sha256, distinct link keys, how often each.
Alignment = tuple[np.ndarray, str, np.ndarray, np.ndarray]
NOTHING: Alignment = (np.zeros(4, np.int64), "", np.zeros(0, np.int64), np.zeros(0, np.int64))


class ByteTokens:
    """A: ids and byte lengths by a byte-level vocabulary."""

    def __init__(self, name: str, ranks: str):
        import base64

        import public_tokenizers
        import tiktoken

        with open(tokenizer_path(ranks), "rb") as f:
            of_bytes = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.name = name
        self.fast = tiktoken.Encoding("bytes", pat_str=public_tokenizers.PATTERN, mergeable_ranks=of_bytes, special_tokens={})
        self.lengths = np.zeros(max(of_bytes.values()) + 1, np.int64)
        for value, rank in of_bytes.items():
            self.lengths[rank] = len(value)
        self._whole = None

    def __call__(self, texts: list[str]) -> list[list[int]]:
        return [self.fast.encode_ordinary(t) if len(t) <= LONG_CHARS else self.whole(t) for t in texts]

    def whole(self, text: str) -> list[int]:
        if self._whole is None:
            import os

            os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
            from tokenizers import Tokenizer

            self._whole = Tokenizer.from_file(tokenizer_path(self.name))
            self._whole.encode_special_tokens = True
        return self._whole.encode(text, add_special_tokens=False).ids


class PieceTokens:
    """B: ids and byte lengths by a vocabulary of pieces that adds a space in front."""

    def __init__(self, name: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(name))
        self.bytes = [self._bytes(self.model.id_to_piece(k)) for k in range(self.model.get_piece_size())]
        self.lengths = np.array([len(b) for b in self.bytes], np.int64)
        self.space = [self.model.piece_to_id(MARK)]

    @staticmethod
    def _bytes(piece: str) -> bytes:
        if re.fullmatch("<0x[0-9A-F]{2}>", piece):
            return bytes([int(piece[3:5], 16)])
        return piece.replace(MARK, " ").encode("utf-8", "surrogatepass")

    def __call__(self, texts: list[str]) -> list[list[int]]:
        """Each text begins with the space that the tokenizer adds; that space alone is its own piece."""
        return [ids if t != " " else self.space for t, ids in zip(texts, self.model.encode([t[1:] for t in texts], num_threads=1), strict=True)]


@dataclass
class Blocks:
    """Tokens of some texts end to end, with their links.

    ``a``/``b``: ids; ``a_start``/``a_end``, ``b_start``/``b_end``: their bytes,
    counted over all texts; ``cuts``: where an A and a B token end together;
    ``a_text``/``b_text``: the text of a token; ``ok``: texts that both spell.
    """

    a: np.ndarray
    b: np.ndarray
    a_start: np.ndarray
    a_end: np.ndarray
    b_start: np.ndarray
    b_end: np.ndarray
    cuts: np.ndarray
    a_text: np.ndarray
    b_text: np.ndarray
    ok: np.ndarray

    @property
    def a_group(self) -> np.ndarray:
        return np.searchsorted(self.cuts, self.a_end, "left")

    @property
    def b_group(self) -> np.ndarray:
        return np.searchsorted(self.cuts, self.b_end, "left")

    def _incidence(self, start: np.ndarray, end: np.ndarray) -> Csr:
        length = end - start
        bytes_ = spread(start, length)
        n = int(max(self.a_end[-1:].sum(), self.b_end[-1:].sum()))
        return Csr(np.concatenate([[0], np.cumsum(length)]), bytes_, np.ones(len(bytes_), np.int64), n)

    def overlap_links(self) -> Csr:
        """A tokens by B tokens: the number of bytes they share."""
        return self._incidence(self.a_start, self.a_end) @ self._incidence(self.b_start, self.b_end).transposed()

    def group_links(self) -> Csr:
        """A tokens by B tokens of the same group: 1."""
        n = len(self.cuts)
        one = Csr.of(np.arange(len(self.a)), self.a_group, len(self.a), n)
        two = Csr.of(self.b_group, np.arange(len(self.b)), n, len(self.b))
        return one @ two

    def end_links(self) -> tuple[np.ndarray, np.ndarray]:
        """A and B tokens (places) whose byte ranges end together."""
        over = self.overlap_links()
        i, j = over.rows(), over.indices
        same = self.a_end[i] == self.b_end[j]
        return i[same], j[same]


class Aligner:
    """Both tokenizers, and the blocks of the chunks met so far."""

    def __init__(self, byte_tokenizer: str = BYTE_TOKENIZER, ranks: str = BYTE_RANKS, piece_tokenizer: str = PIECE_TOKENIZER):
        self.byte, self.piece = ByteTokens(byte_tokenizer, ranks), PieceTokens(piece_tokenizer)
        self.clear()

    def clear(self) -> None:
        self.index: dict[str, int] = {}
        self.chars = 0
        self.groups: list[str] = []
        self.counts = np.zeros((0, 4), np.int64)  # of a chunk: A tokens, B tokens, groups, spelt
        self.links = Csr(np.zeros(1, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), 0)  # chunk by link: keys as columns

    def blocks(self, texts: list[str]) -> Blocks:
        """Texts that begin with a space, tokenised and laid end to end; those that are not spelt have no tokens."""
        a_ids, b_ids = self.byte(texts), self.piece(texts)
        raw = [t.encode("utf-8", "surrogatepass") for t in texts]
        n_a, n_b = (np.fromiter(map(len, ids), np.int64, len(ids)) for ids in (a_ids, b_ids))
        a, b = (np.fromiter(chain.from_iterable(ids), np.int64) for ids in (a_ids, b_ids))
        spelt = self.piece.bytes.__getitem__
        ok = np.fromiter((b"".join(map(spelt, ids)) == r for ids, r in zip(b_ids, raw, strict=True)), bool, len(raw))
        # A's tokens are runs of the text's own bytes, so they spell it if they are as long
        ok &= np.bincount(np.repeat(np.arange(len(raw)), n_a), self.byte.lengths[a], len(raw)) == np.fromiter(map(len, raw), np.int64, len(raw))
        if not ok.all():
            a, b = a[np.repeat(ok, n_a)], b[np.repeat(ok, n_b)]
            n_a, n_b = n_a[ok], n_b[ok]
        good = np.flatnonzero(ok)
        a_end, b_end = np.cumsum(self.byte.lengths[a]), np.cumsum(self.piece.lengths[b])
        return Blocks(
            a, b, a_end - self.byte.lengths[a], a_end, b_end - self.piece.lengths[b], b_end,
            np.intersect1d(a_end, b_end, assume_unique=True), np.repeat(good, n_a), np.repeat(good, n_b), ok,
        )

    def learn(self, chunks: list[str]) -> None:
        """Blocks of new chunks into the table."""
        if not chunks:
            return
        found = self.blocks(chunks)
        n = len(chunks)
        group_text = np.zeros(len(found.cuts), np.int64)
        group_text[found.a_group] = found.a_text
        counts = np.stack([np.bincount(x, minlength=n) for x in (found.a_text, found.b_text, group_text)] + [found.ok.astype(np.int64)], 1)
        i, j = found.end_links()
        rows = found.a_text[i]
        self.links = Csr(
            np.concatenate([self.links.indptr, self.links.indptr[-1] + np.cumsum(np.bincount(rows, minlength=n))]),
            np.concatenate([self.links.indices, (found.a[i] << _SHIFT) | found.b[j]]),
            np.ones(self.links.indptr[-1] + len(i), np.int64), 0,
        )
        self.counts = np.concatenate([self.counts, counts])
        self.groups += group_strings(found, n)
        self.index.update(zip(chunks, range(len(self.index), len(self.index) + n), strict=True))

    def documents(self, texts: list[str | None]) -> Iterator[Alignment]:
        """The alignment of each text; new chunks of many short texts are learnt together."""
        start = 0
        while start < len(texts):
            end, size = start, 0
            while end < len(texts) and (end == start or size + len(texts[end] or "") <= PIECE_CHARS):
                size += len(texts[end] or "")
                end += 1
            if size > PIECE_CHARS:
                yield self._document(texts[start], chunked(texts[start]))
            else:
                cut = [CUT.split(" " + t) if t else [] for t in texts[start:end]]
                self.ready([c for chunks in cut for c in chunks])
                for text, chunks in zip(texts[start:end], cut, strict=True):
                    yield self._document(text, [chunks]) if text else NOTHING
            start = end

    def _document(self, text: str, pieces: Iterable[list[str]]) -> Alignment:
        digest, first = hashlib.sha256(), True
        total = np.zeros(3, np.int64)
        keys, times = [], []
        for chunks in pieces:
            at = self.places(chunks)
            counts = self.counts[at]
            if not counts[:, 3].all():
                return self.whole(text)
            total += counts[:, :3].sum(0)
            digest.update((("" if first else ";") + ";".join(map(self.groups.__getitem__, at.tolist()))).encode())
            first = False
            some, n = np.unique(at, return_counts=True)
            begin = self.links.indptr[some]
            length = self.links.indptr[some + 1] - begin
            keys.append(self.links.indices[spread(begin, length)])
            times.append(np.repeat(n, length))
        key, where = np.unique(np.concatenate(keys), return_inverse=True)
        n = np.bincount(where, np.concatenate(times), len(key)).astype(np.int64)
        return np.append(total, n.sum()), digest.hexdigest(), key, n

    def ready(self, chunks: list[str]) -> None:
        """Every one of ``chunks`` into the table, which is emptied first if it is full."""
        new = [c for c in dict.fromkeys(chunks) if c not in self.index]
        if new and (len(self.index) > KEPT_CHUNKS or self.chars > KEPT_CHARS):
            self.clear()
            new = list(dict.fromkeys(chunks))
        self.learn(new)
        self.chars += sum(map(len, new))

    def places(self, chunks: list[str]) -> np.ndarray:
        """The table's place of each chunk."""
        try:
            return np.fromiter(map(self.index.__getitem__, chunks), np.int64, len(chunks))
        except KeyError:
            self.ready(chunks)
            return np.fromiter(map(self.index.__getitem__, chunks), np.int64, len(chunks))

    def whole(self, text: str) -> Alignment:
        """A text with a chunk that is not spelt, by the tokenizers at once: it has tokens only if they spell all of it."""
        found = self.blocks([" " + text])
        if not found.ok[0]:
            return NOTHING
        i, j = found.end_links()
        key, n = np.unique((found.a[i] << _SHIFT) | found.b[j], return_counts=True)
        groups = group_strings(found, 1)[0]
        return np.array([len(found.a), len(found.b), len(found.cuts), len(i)]), hashlib.sha256(groups.encode()).hexdigest(), key, n


def group_strings(found: Blocks, n: int) -> list[str]:
    """``a1,a2|b1;a3|b2,b3`` of each of the ``n`` texts, empty where it has no tokens."""
    a_at = np.searchsorted(found.a_end, found.cuts, "right")
    b_at = np.searchsorted(found.b_end, found.cuts, "right")
    text = found.a_text[a_at - 1]
    a, b = list(map(str, found.a.tolist())), list(map(str, found.b.tolist()))
    one = [
        f"{a[i]}|{b[j]}" if i2 - i == 1 == j2 - j else f"{','.join(a[i:i2])}|{','.join(b[j:j2])}"
        for i, i2, j, j2 in zip([0, *a_at[:-1].tolist()], a_at.tolist(), [0, *b_at[:-1].tolist()], b_at.tolist(), strict=True)
    ]
    ends = np.searchsorted(text, np.arange(n), "right").tolist()
    return [";".join(one[i:j]) for i, j in zip([0, *ends], ends, strict=False)]


def chunked(text: str, size: int = PIECE_CHARS) -> Iterator[list[str]]:
    """The chunks of a space and ``text``, about ``size`` characters at a time."""
    start, text = 0, " " + text
    while start < len(text):
        cut = CUT.search(text, start + size) if start + size < len(text) else None
        end = cut.start() if cut else len(text)
        yield CUT.split(text[start:end])
        start = end


_aligners: dict[tuple, Aligner] = {}


def aligner(*names: str) -> Aligner:
    """The worker's aligner of these files."""
    if names not in _aligners:
        _aligners[names] = Aligner(*names)
    return _aligners[names]


def token_links(text: str, kind: str = "end", names: tuple[str, ...] = (BYTE_TOKENIZER, BYTE_RANKS, PIECE_TOKENIZER)) -> list[tuple[int, int, int, int, int]]:
    """Links of one text: place and id of the A token, place and id of the B token, weight.

    ``kind``: "overlap" (weight: shared bytes), "group" or "end" (weight 1).
    Texts without tokens have none.
    """
    if not text:
        return []
    found = aligner(*names).blocks([" " + text])
    if kind == "end":
        i, j = found.end_links()
        w = np.ones(len(i), np.int64)
    else:
        links = found.overlap_links() if kind == "overlap" else found.group_links()
        i, j, w = links.rows(), links.indices, links.values
    return list(zip(*(x.tolist() for x in (i, found.a[i], j, found.b[j], w)), strict=True))


def pair_counts(aligned: DataFrame) -> DataFrame:
    """key, n: how many links corpus-wide hold the id pair; each task adds up its own documents first."""

    def folded(keys: list, times: list) -> pa.RecordBatch:
        key, where = np.unique(np.concatenate(keys), return_inverse=True)
        return pa.RecordBatch.from_arrays([pa.array(key), pa.array(np.bincount(where, np.concatenate(times), len(key)).astype(np.int64))], ["key", "n"])

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, times, held = [], [], 0
        for batch in batches:
            key, n = (batch.column(k).flatten().to_numpy() for k in (0, 1))
            keys.append(key)
            times.append(n)
            held += len(key)
            if held > 4_000_000:
                part = folded(keys, times)
                if part.num_rows > 2_000_000:
                    yield part
                    keys, times, held = [], [], 0
                else:
                    keys, times, held = [part.column(0).to_numpy()], [part.column(1).to_numpy()], part.num_rows
        if keys:
            yield folded(keys, times)

    return aligned.select("_links", "_times").mapInArrow(fold, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))


def align_tokenizers(
    docs: DataFrame,
    byte_tokenizer: str = BYTE_TOKENIZER,
    ranks: str = BYTE_RANKS,
    piece_tokenizer: str = PIECE_TOKENIZER,
    frequent: int = FREQUENT,
) -> DataFrame:
    """The id columns of ``docs`` (all but ``text``) with n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 and links.

    ``links``: (a, b, times) of each distinct linked id pair of the document,
    tokens that end together. Null and empty texts, and texts that the tokens
    of A or B do not spell, have no tokens: zeros, an empty string, no links.
    Repeated rows are documents of their own and count each; ids may be null
    or repeated. Columns of these names in the input give way (they are
    dropped). No rows give none. ``ranks`` is A's vocabulary again, in the
    form that the faster library reads.
    """
    names = (byte_tokenizer, ranks, piece_tokenizer)
    new = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "links"]
    others = [c for c in docs.columns if c.lower() not in ("text", "_row", "_links", "_times", *new)]
    docs = docs.select(*others, "text")
    row = fresh_name(docs, "_row")

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = aligner(*names).documents
        for batch in batches:
            numbers, shas, keys, times = [], [], [], []
            for n, sha, key, count in work(batch.column(len(others)).to_pylist()):
                numbers.append(n)
                shas.append(sha)
                keys.append(key)
                times.append(count)
            offsets = pa.array(np.concatenate([[0], np.cumsum([len(k) for k in keys])]).astype(np.int32))
            numbers = np.array(numbers, np.int64).reshape(-1, 4)
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[: len(others)],
                    *(pa.array(numbers[:, k]) for k in range(4)),
                    pa.array(shas, pa.string()),
                    pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(keys))),
                    pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(times).astype(np.int32))),
                ],
                [*others, *new[:4], "groups_sha256", "_links", "_times"],
            )

    kinds = dict(docs.dtypes)
    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in others), *(f"{c} long" for c in new[:4]), "groups_sha256 string, _links array<long>, _times array<int>"])
    aligned = checkpointed(docs.mapInArrow(align, schema).withColumn(row, F.monotonically_increasing_id()), "aligned")
    counts = checkpointed(pair_counts(aligned), "pair-counts")
    mask = (1 << _SHIFT) - 1
    best_of = counts.groupBy(F.col("key").bitwiseAND(F.lit(mask)).alias("b")).agg(F.max("n").alias("n")).toArrow()  # at most B's vocabulary
    best = np.zeros(1 + max(best_of["b"].to_pylist(), default=0), np.int64)
    best[best_of["b"].to_numpy()] = best_of["n"].to_numpy()
    frequent_keys, frequent_n = most_frequent(counts, frequent)
    given = docs.sparkSession.sparkContext.broadcast((frequent_keys.view(np.int64), frequent_n, best))

    def known(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sums over the frequent pairs, and the document's other pairs."""
        keys, n_of, best = given.value
        for batch in batches:
            key, times = batch.column(1).flatten().to_numpy(), batch.column(2).flatten().to_numpy().astype(np.int64)
            size = np.diff(batch.column(1).offsets.to_numpy())
            doc = np.repeat(np.arange(batch.num_rows), size)
            at = np.minimum(np.searchsorted(keys, key), max(len(keys) - 1, 0))
            hit = keys[at] == key if len(keys) else np.zeros(len(key), bool)
            n = np.where(hit, n_of[at] if len(keys) else 0, 0)
            top = hit & (n == best[key & mask])
            sums = [np.bincount(doc, times * x, batch.num_rows).astype(np.int64) for x in (n, top)]
            rest = np.concatenate([[0], np.cumsum(np.bincount(doc[~hit], minlength=batch.num_rows))]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), *map(pa.array, sums),
                    pa.ListArray.from_arrays(pa.array(rest), pa.array(key[~hit])),
                    pa.ListArray.from_arrays(pa.array(rest), pa.array(times[~hit])),
                ],
                ["_row", "_sum", "_best", "_rare", "_rare_times"],
            )

    # only numbers and the rare pairs go through the shuffle; links stay where they lie
    parts = aligned.select(row, "_links", "_times").mapInArrow(known, "_row long, _sum long, _best long, _rare array<long>, _rare_times array<long>")
    parts = checkpointed(parts, "link-counts")
    rare = parts.select("_row", F.explode(F.arrays_zip("_rare", "_rare_times")).alias("w")).select("_row", F.col("w._rare").alias("key"), F.col("w._rare_times").alias("times"))
    highest = counts.groupBy(F.col("key").bitwiseAND(F.lit(mask)).alias("b")).agg(F.max("n").alias("most"))
    met = rare.join(counts, "key").withColumn("b", F.col("key").bitwiseAND(F.lit(mask))).join(highest, "b")
    more = met.groupBy("_row").agg(F.sum(F.col("times") * F.col("n")).alias("_more_sum"), F.sum(F.when(F.col("n") == F.col("most"), F.col("times")).otherwise(0)).alias("_more_best"))
    summed = parts.select("_row", "_sum", "_best").join(more, "_row", "left").select(
        F.col("_row").alias("_sums_row"),
        (F.col("_best") + F.coalesce("_more_best", F.lit(0))).cast("bigint").alias("n_best"),
        (F.col("_sum") + F.coalesce("_more_sum", F.lit(0))).cast("bigint").alias("count_sum"),
    )
    link = lambda key, n: F.struct(F.shiftright(key, _SHIFT).alias("a"), key.bitwiseAND(F.lit(mask)).alias("b"), n.alias("times"))
    return aligned.join(summed, F.col(row) == F.col("_sums_row")).select(*others, *new[:6], "groups_sha256", F.zip_with("_links", "_times", link).alias("links"))


def op13_cross_tokenizer_alignment(spark, sf_dir: str) -> DataFrame:
    return align_tokenizers(documents(spark, sf_dir)).select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
