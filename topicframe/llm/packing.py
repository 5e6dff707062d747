"""Best-fit packing of token sequences by a configuration linear program.

1. Documents are tokenised where they lie; each task writes its pieces with
   the task's number and the piece's rank among the task's pieces of that
   length. Only documents longer than a sequence are cut.
2. The histogram of lengths (at most ``capacity`` rows, whatever the input)
   goes to the driver. The configuration program - cover every length's
   count with as few fillings of a sequence as possible - is solved by
   multiplicative weights: lengths that are covered least weigh most, and
   the next filling is the best knapsack at these weights (dynamic
   programming over the capacity). The fractional solution is rounded down,
   and what is left is packed best-fit decreasing, by counts.
3. The plan is a list of fillings with multiplicities. A piece finds its
   place by its length and its rank among all pieces of that length: the
   rank is the rank in its task plus the pieces of that length in earlier
   tasks, so a length that a third of all pieces share is nobody's burden.

The token ids of a blank-free chunk do not depend on its neighbours (the
tokenizer's own splitting drops white space), so chunks are encoded once a
worker and kept in a bounded table.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from topicframe.llm.common import checkpointed, documents

CAPACITY = 2048
END_ID = 0
TOKENIZER = "word_bpe_49k.json"

#: Chunks whose ids a worker keeps; the table is emptied when it is full.
KEPT_CHUNKS = 800_000
#: A chunk longer than this is encoded each time and not kept.
KEPT_CHARS = 64
#: Letters that have one lower-case form and no marks that combine, and marks that the splitter keeps together.
LETTERS = "".join(chr(c) for c in [*range(65, 91), *range(97, 123), *range(0xC0, 0x100)] if c not in (0xD7, 0xF7))
MARKS = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum() and c not in "'<|>")
PLAIN = re.compile(f"([{LETTERS}]*)([{re.escape(MARKS)}]*)")
#: Knapsacks that are priced for one program, and programs: the second is for what the first one's rounding left.
ROUNDS, PASSES = 600, 2
#: How much a length that is covered loses in weight, and the share of a length that one round covers.
RATE, STEP = 8.0, 0.25

Pattern = tuple[tuple[int, int], ...]  # ((length, copies), ...), longest first


class ChunkEncoder:
    """Ids of whole texts as little-endian uint32 bytes.

    Most chunks are letters of Latin-1 with punctuation behind. The
    tokenizer's normaliser lowers these letters one by one and its splitter
    cuts before the punctuation, so such chunks go straight to its model,
    spelt with the tokenizer's own spelling of each character. Any other
    chunk goes through the whole tokenizer.
    """

    def __init__(self, path: str):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs a task a core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model.tokenize
        self.spelt = str.maketrans({c: self._spelt(c) for c in LETTERS + MARKS})
        self.kept: dict[str, bytes] = {"": b""}

    def _spelt(self, char: str) -> str:
        normal = self.tokenizer.normalizer.normalize_str(char)
        return "".join(part for part, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(normal))

    def encode(self, text: str) -> bytes:
        chunks = text.replace("\n", " ").split(" ")
        try:
            return b"".join(map(self.kept.__getitem__, chunks))
        except KeyError:
            pass
        if len(self.kept) > KEPT_CHUNKS:
            self.kept = {"": b""}
        kept = self.kept
        new: dict[str, bytes] = {}
        for c in set(chunks):
            if c not in kept:
                (kept if len(c) <= KEPT_CHARS else new)[c] = self._ids(c)
        return b"".join([kept[c] if c in kept else new[c] for c in chunks])

    def _ids(self, chunk: str) -> bytes:
        if plain := PLAIN.fullmatch(chunk):
            ids = [t.id for part in plain.groups() if part for t in self.model(part.translate(self.spelt))]
        else:
            ids = self.tokenizer.encode(chunk, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)


_encoders: dict[str, ChunkEncoder] = {}


def encoder(name: str) -> ChunkEncoder:
    """The worker's encoder of a tokenizer file: a path, or a name of ``public_tokenizers``."""
    if name not in _encoders:
        path = name
        if "/" not in name:
            import public_tokenizers

            path = public_tokenizers.path(name)
        _encoders[name] = ChunkEncoder(path)
    return _encoders[name]


def token_pieces(docs: DataFrame, tokenizer: str = TOKENIZER, capacity: int = CAPACITY, keep_ids: bool = False) -> DataFrame:
    """A row a piece: slice, doc_id, piece, start, length, ids_crc32, rank (and ids).

    ``slice`` is the task, ``rank`` counts its pieces of that length.
    """
    schema = "slice int, doc_id long, piece int, start long, length long, ids_crc32 long, rank long" + ", ids array<int>" * keep_ids

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer).encode
        end = np.array([END_ID], "<u4").tobytes()
        here, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for batch in batches:
            rows: list[tuple] = []
            ids: list[np.ndarray] = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                coded = encode(text.as_py() or "") + end
                for piece, at in enumerate(range(0, len(coded), 4 * capacity)):
                    part = coded[at : at + 4 * capacity]
                    n = len(part) // 4
                    rows.append((here, doc_id, piece, at // 4, n, zlib.crc32(part), int(seen[n])))
                    seen[n] += 1
                    if keep_ids:
                        ids.append(np.frombuffer(part, "<i4"))
            if rows:
                columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _TYPES, strict=True)]
                names = ["slice", "doc_id", "piece", "start", "length", "ids_crc32", "rank"]
                if keep_ids:
                    columns.append(pa.array(ids, pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names)

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(pieces, schema)


_TYPES = [pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]


def best_filling(value: np.ndarray, capacity: int) -> dict[int, int]:
    """The knapsack: copies of each length (index of ``value``; 0 is worthless) with the largest value within ``capacity``."""
    best = np.zeros(capacity + 1)
    taken = np.zeros(capacity + 1, np.int64)
    flipped = best[::-1]
    for c in range(1, capacity + 1):
        # best[c - l] + value[l] for l = 1..c
        gain = flipped[capacity - c + 1 : capacity + 1] + value[1 : c + 1]
        k = int(gain.argmax())
        if gain[k] > best[c - 1]:
            best[c], taken[c] = gain[k], k + 1
        else:
            best[c] = best[c - 1]
    filling: dict[int, int] = {}
    c = capacity
    while c > 0:
        n = int(taken[c])
        if n:
            filling[n] = filling.get(n, 0) + 1
            c -= n
        else:
            c -= 1
    return filling


def configuration_program(counts: np.ndarray, capacity: int, rounds: int = ROUNDS, rate: float = RATE, share: float = STEP) -> list[tuple[Pattern, float]]:
    """Fillings and their fractional multiplicities that hold no more than ``counts`` (by length), by multiplicative weights.

    A token of a length weighs exp(-rate x the share of that length that is
    covered), so all lengths start alike, fillings are full, and those that
    lag behind are taken next. A round covers at most ``share`` of a length.
    The multiplicities are scaled so that the length that is covered most is
    covered once.
    """
    present = np.flatnonzero(counts)
    covered = np.zeros(capacity + 1)
    shares: dict[Pattern, float] = {}
    value = np.full(capacity + 1, -np.inf)
    for _ in range(rounds):
        value[present] = present * np.exp(-rate * (covered[present] - covered[present].min()))
        filling = {n: min(k, int(counts[n])) for n, k in best_filling(value, capacity).items()}
        step = share * min(counts[n] / k for n, k in filling.items())
        pattern = tuple(sorted(filling.items(), reverse=True))
        shares[pattern] = shares.get(pattern, 0.0) + step
        for n, k in filling.items():
            covered[n] += k * step / counts[n]
        if covered[present].min() >= 1:
            break
    scale = covered.max()
    return sorted(((p, x / scale) for p, x in shares.items()), key=lambda t: (-t[1], t[0]))


def best_fit_rest(counts: np.ndarray, capacity: int) -> list[tuple[Pattern, int]]:
    """Best-fit decreasing over counts: open sequences of one filling are handled together."""
    room: dict[int, list[list]] = {}  # free tokens: [filling, how many]
    free = np.zeros(capacity + 1, np.int64)  # open sequences by free tokens

    def put(pattern: list, n: int, left: int) -> None:
        if n:
            room.setdefault(left, []).append([pattern, n])
            free[left] += n

    for length in range(capacity, 0, -1):
        todo = int(counts[length])
        while todo:
            fits = np.flatnonzero(free[length:])
            if not len(fits):
                each = capacity // length
                whole, rest = divmod(todo, each)
                put([(length, each)], whole, capacity - each * length)
                put([(length, rest)], int(rest > 0), capacity - rest * length)
                break
            left = length + int(fits[0])
            pattern, n = room[left].pop()
            free[left] -= n
            each = left // length
            whole = min(n, todo // each)
            put([*pattern, (length, each)], whole, left - each * length)
            todo -= whole * each
            if whole < n:  # fewer than `each` are left: they go into one more
                if todo:
                    put([*pattern, (length, todo)], 1, left - todo * length)
                    put(pattern, n - whole - 1, left)
                    todo = 0
                else:
                    put(pattern, n - whole, left)
    return [(tuple(p), n) for kinds in room.values() for p, n in kinds]


def packing_plan(counts: np.ndarray, capacity: int = CAPACITY) -> list[tuple[Pattern, int]]:
    """Fillings and whole multiplicities that hold exactly ``counts[length]`` pieces of each length."""
    rest = counts.astype(np.int64).copy()
    plan: list[tuple[Pattern, int]] = [(((capacity, 1),), int(rest[capacity]))] if rest[capacity] else []
    rest[capacity] = 0
    for _ in range(PASSES):
        if not rest.any():
            break
        fillings = configuration_program(rest, capacity)
        taken = 0
        for pattern, many in fillings:  # rounded down; a filling with a gap is left to the rest
            n_bins = min(int(many), *(int(rest[n]) // k for n, k in pattern))
            if n_bins and sum(n * k for n, k in pattern) >= capacity - capacity // 512:
                plan.append((pattern, n_bins))
                taken += n_bins
                for n, k in pattern:
                    rest[n] -= k * n_bins
        if not taken:
            break
    return plan + best_fit_rest(rest, capacity)


def _places(plan: list[tuple[Pattern, int]]) -> tuple[np.ndarray, ...]:
    """Per filling and length, by (length, first rank): copies, offset of the first, first sequence."""
    rows, sequence, rank = [], 0, {}
    for pattern, n in plan:
        offset = 0
        for length, k in pattern:
            rows.append((length, rank.get(length, 0), k, offset, sequence))
            rank[length] = rank.get(length, 0) + k * n
            offset += length * k
        sequence += n
    rows.sort()
    table = np.array(rows, np.int64).reshape(-1, 5)
    return tuple(table.T)


def pack_documents(docs: DataFrame, tokenizer: str = TOKENIZER, capacity: int = CAPACITY, keep_ids: bool = False) -> DataFrame:
    """Pieces of ``docs`` (doc_id, text) with the sequence and the offset that hold them.

    Returns doc_id, piece, start, length, ids_crc32, sequence_id, offset, and
    with ``keep_ids`` the token ids. A document is its ids and one id 0;
    null and empty texts are that one id. Repeated rows and ids are
    documents of their own; rows without an id keep a null one. Other
    columns are not read. No rows give no pieces.
    """
    pieces = checkpointed(token_pieces(docs, tokenizer, capacity, keep_ids), "pieces")
    per_slice = pieces.groupBy("length", "slice").agg(F.count("*").alias("n"))
    counts = np.zeros(capacity + 1, np.int64)
    for length, n in per_slice.groupBy("length").agg(F.sum("n")).collect():  # at most `capacity` rows
        counts[length] = n
    length_of, first_rank, copies, offset_of, first_sequence = _places(packing_plan(counts, capacity))
    shift = 1 << 48
    key = length_of * shift + first_rank

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            length, rank = (b.column(b.schema.get_field_index(c)).to_numpy(zero_copy_only=False) for c in ("length", "rank"))
            at = np.searchsorted(key, length * shift + rank, "right") - 1
            bin_, copy = np.divmod(rank - first_rank[at], copies[at])
            kept = [c for c in b.schema.names if c != "rank"]
            yield pa.RecordBatch.from_arrays(
                [b.column(b.schema.get_field_index(c)) for c in kept] + [pa.array(first_sequence[at] + bin_), pa.array(offset_of[at] + copy * length)],
                [*kept, "sequence_id", "offset"],
            )

    earlier = Window.partitionBy("length").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    before = per_slice.select("length", "slice", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * keep_ids
    ranked = pieces.join(before, ["length", "slice"]).select(*columns, (F.col("rank") + F.col("before")).alias("rank"))
    schema = ", ".join(f"{c} {t}" for c, t in ranked.dtypes if c != "rank") + ", sequence_id long, offset long"
    return ranked.mapInArrow(place, schema)


def op7_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    return pack_documents(documents(spark, sf_dir))
