import zlib

import numpy as np
import pytest
from odd_rows import ODD

from topicframe.llm.common import checkpointed
from topicframe.llm.packing import CAPACITY, ChunkEncoder, best_filling, best_fit_rest, pack_documents, packing_plan
from topicframe.llm.shards import ROW_BYTES, find_splitters, shard_documents


def size(text):
    return len((text or "").encode()) + ROW_BYTES


@pytest.mark.parametrize("ranges", [None, 3])
def test_shards_hold_every_row_once_in_order_and_near_equal_bytes(spark, docs_of, ranges):
    rng = np.random.default_rng(3)
    rows = ODD + [(100 + k, "copy of one text " * 3) for k in range(400)] + [(1000 + k, "x" * int(rng.integers(1, 400)) + str(k)) for k in range(800)]
    got = shard_documents(docs_of(rows), 8, ranges_per_shard=ranges).collect()
    assert sorted((r["doc_id"] or -1, r["text"] or "") for r in got) == sorted((d or -1, t or "") for d, t in rows)
    assert all(r["size"] == size(r["text"]) for r in got)
    by_shard = {}
    for r in got:
        by_shard.setdefault(r["shard"], []).append(r)
    for shard in by_shard.values():
        assert sorted(r["slot"] for r in shard) == list(range(len(shard)))
    total, largest = sum(size(t) for _, t in rows), max(size(t) for _, t in rows)
    assert max(sum(r["size"] for r in s) for s in by_shard.values()) <= total / 8 + largest
    small = [sum(r["size"] for r in s) for s in by_shard.values() if max(r["size"] for r in s) < 1000]
    assert max(small) - min(small) <= 2 * 600 or len(small) < 2
    # equal texts lie side by side
    for a, b in zip(*(sorted({r["shard"] for r in got if r["text"] and r["text"].startswith("copy")})[k:] for k in (0, 1))):
        assert b == a + 1


def test_splitters_are_exact_row_counts(spark):
    rows = [(int(h), i, 10) for h in (5, 5, 9, -(2**63), 2**63 - 1) for i in range(50)]
    keys = checkpointed(spark.createDataFrame(rows, "h long, i long, size long"), "k")
    splitters, below, _ = find_splitters(keys, 5, 0.0)
    from topicframe.llm.shards import _of_key

    for s, (size_below, n) in zip(splitters, below, strict=True):
        under = [r for r in rows if (r[0], r[1]) < _of_key(s)]
        assert (size_below, n) == (10 * len(under), len(under))
    assert [b[1] for b in below] == [50, 100, 150, 200]


def test_no_rows_to_shard(docs_of):
    assert shard_documents(docs_of([(1, "x")]).limit(0), 4).count() == 0
    assert shard_documents(docs_of([(1, "x")]), 4).first()["slot"] == 0


def test_chunks_give_the_tokenizers_own_ids():
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    whole, chunked = Tokenizer.from_file(path), ChunkEncoder(path)
    texts = ["", " ", "a", "It's  DON'T we'll\n\nx\ty", "É à ñ ß İ ſ K ① ² 12,345.6", "a\u0301b x \u0301y", "<|endoftext|> a<|startoftext|>b", "ΑΣ ΟΔΟΣ", "(x)[y]{z}|<t>&amp;", "a\x1cb\x85c\u2028d", "\U0001f600\U0001f600 x", "w" * 300, "--- ___ ,,, ...'s"]
    for text in texts * 2:
        assert chunked.encode(text) == np.array(whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def test_knapsack_finds_the_best_value():
    value = np.full(21, -np.inf)
    value[[3, 7, 10]] = [2.0, 5.0, 6.5]
    filling = best_filling(value, 20)
    assert sum(n * k for n, k in filling.items()) <= 20 and sum(value[n] * k for n, k in filling.items()) == 14.0


@pytest.mark.parametrize("seed", range(4))
def test_plans_hold_exactly_the_pieces(seed):
    rng = np.random.default_rng(seed)
    counts = np.zeros(CAPACITY + 1, np.int64)
    np.add.at(counts, rng.integers(1, [60, 900, 2049, 1400][seed], 5000), 1)
    counts[2048] += 40
    plan = packing_plan(counts)
    held = np.zeros_like(counts)
    for pattern, n in plan:
        assert n > 0 and sum(length * k for length, k in pattern) <= CAPACITY
        for length, k in pattern:
            held[length] += k * n
    assert (held == counts).all()
    bins = sum(n for _, n in plan)
    least = -(-int((counts * np.arange(CAPACITY + 1)).sum()) // CAPACITY)
    greedy = sum(n for _, n in best_fit_rest(counts, CAPACITY))
    assert least <= bins <= greedy * 1.01 + 1


def test_best_fit_rest_equals_best_fit_decreasing_one_by_one():
    rng = np.random.default_rng(5)
    lengths = sorted(rng.integers(1, 60, 300).tolist(), reverse=True)
    free = []
    for n in lengths:
        fits = [f for f in free if f >= n]
        if fits:
            free.remove(min(fits))
            free.append(min(fits) - n)
        else:
            free.append(100 - n)
    assert sum(n for _, n in best_fit_rest(np.bincount(lengths, minlength=101), 100)) == len(free)


def test_pieces_tile_their_documents_and_sequences(docs_of):
    rows = ODD + [(50 + k, "same length here") for k in range(300)]
    got = pack_documents(docs_of(rows), keep_ids=True).collect()
    import public_tokenizers
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = []
    for d, t in rows:
        ids = [*whole.encode(t or "", add_special_tokens=False).ids, 0]
        want += [(d or -1, p, s, tuple(ids[s : s + CAPACITY])) for p, s in enumerate(range(0, len(ids), CAPACITY))]
    assert sorted((r["doc_id"] or -1, r["piece"], r["start"], tuple(r["ids"])) for r in got) == sorted(want)
    assert all(r["length"] == len(r["ids"]) and r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes()) for r in got)
    by_sequence = {}
    for r in got:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= CAPACITY
    assert len(by_sequence) == -(-sum(r["length"] for r in got) // CAPACITY)


def test_nothing_to_pack(docs_of):
    assert pack_documents(docs_of([(1, "x")]).limit(0)).count() == 0
