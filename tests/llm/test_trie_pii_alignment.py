"""Prefix trie, personal data and tokenizer alignment against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from odd_rows import ODD

from topicframe.llm import alignment, boosting, pii, trie
from topicframe.llm.csr import Csr
from topicframe.llm.perfect_hash import PerfectHash

WORD = re.compile("[^\x20\x09-\x0d]+")


# ------------------------------------------------------------------ op11


def brute_trie(rows):
    turns = defaultdict(list)
    for c, t, role, text, *_ in rows:
        if c is not None:
            role, text = role or "", text or ""
            tie = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            turns[c].append((t is not None, t or 0, tie, role, text))
    turns = {c: [t[3:] for t in sorted(ts)] for c, ts in turns.items()}
    built = {}
    for c in turns:
        h = zlib.crc32(str(c).encode()) % 4
        built[c] = turns.get(c - int(math.fmod(c, 20)), [])[:h] + turns[c][h:]
    members, ends = defaultdict(set), defaultdict(list)
    for c, s in built.items():
        ends[tuple(s)].append(c)
        for d in range(len(s) + 1):
            members[tuple(s[:d])].add(c)
    children, leaves, saved = Counter(p[:-1] for p in members if p), Counter(), Counter()
    for p, m in members.items():
        for d in range(len(p) + 1):
            saved[p[:d]] += (len(m) - 1) * len(WORD.findall(p[-1][1])) if p else 0
            leaves[p[:d]] += not children[p]
    sha = lambda ids: hashlib.sha256(",".join(map(str, sorted(ids))).encode()).hexdigest()
    return sorted(
        ((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), children[p], leaves[p], saved[p], sha(ends.get(p, []))) for p, m in members.items()), key=str
    )


TRIE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def trie_of(spark, rows):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, node string, depth int").repartition(3)
    return sorted(map(tuple, trie.conversation_trie(df).select(*TRIE).collect()), key=str)


def test_trie_against_brute_force(spark):
    random.seed(5)
    texts = [None, "", "x y", "x y  z", "w"]
    rows = [
        (c, random.choice([None, t, t, t]), random.choice([None, "", "user", "a"]), random.choice(texts))
        for c in random.sample(range(-30, 200), 80) for t in range(random.randint(1, 6))
    ]
    rows += [(None, 1, "user", "x"), (None, None, None, None)]
    rows += [(c, t, "user", "same " * t) for c in range(400, 460) for t in range(12)]  # one group of copies
    rows += [(c, t, "user", f"deep {t}") for c in (500, 520) for t in range(300)] + [(540, 0, "user", "word " * 5000)]
    rows += rows[:5]
    assert trie_of(spark, rows) == brute_trie(rows)


def test_trie_without_conversations(spark):
    assert trie_of(spark, []) == [] and trie_of(spark, [(None, 1, "user", "x")]) == []


def test_perfect_hash_is_minimal_and_verified():
    rng = np.random.default_rng(1)
    k1, k2 = (rng.integers(0, 1 << 63, 20_000).astype(np.uint64) for _ in range(2))
    k1[:500] = 7  # halves may repeat
    table = PerfectHash(k1, k2)
    assert sorted(table.slots(k1, k2)) == list(range(20_000))
    assert (table.slots(k1, k2 + np.uint64(1)) == -1).all()
    assert PerfectHash(k1[:0], k2[:0]).slots(k1[:3], k2[:3]).tolist() == [-1] * 3
    with pytest.raises(ValueError):
        PerfectHash(np.array([1, 1], np.uint64), np.array([2, 2], np.uint64))


# ------------------------------------------------------------------ op12


def brute_spans(text):
    out = [(m.start(), m.end(), 0) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(m.start(), m.end(), 1) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = [int(c) for c in m[0] if c.isdigit()]
        total = sum(d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for i, d in enumerate(reversed(digits)))
        out += [(m.start(), m.end(), 2)] if 14 <= len(digits) <= 19 and total % 10 == 0 else []
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        out += [(m.start(), m.end(), 3)] if 10 <= sum(c.isdigit() for c in m[0]) <= 15 else []
    return sorted(out, key=lambda x: (x[0], x[2], x[1]))


def test_base_patterns_against_their_expressions():
    random.seed(3)
    for alphabet, most in (("aB0123456789.@+-() %_x\né", 40), ("0123456789. +-", 60)):
        for _ in range(15_000):
            text = "".join(random.choice(alphabet) for _ in range(random.randint(0, most)))
            assert pii.base_spans(text) == brute_spans(text), text


def test_base_patterns_are_linear():
    for text in ("1" * 300_000 + "@", "a" * 300_000 + "@", "1." * 150_000, "+1" * 100_000, "1 " * 150_000):
        pii.base_spans(text)


def _luhn(head):
    return next(head + str(d) for d in range(10) if pii.luhn(head + str(d)))


def personal_rows(seed, n=260):
    r, word = random.Random(seed), lambda r: "".join(r.choice("abdehilnorstu") for _ in range(r.randint(2, 7)))
    rows = []
    for k in range(n):
        w = [word(r) for _ in range(30)]
        w[3] = f"{word(r)}.{r.randint(1, 99)}@{word(r)}{r.randint(1, 9)}.example.com"
        w[9] = f"+1 ({r.randint(200, 999)}) 555-{r.randint(1000, 9999)}"
        w[15] = _luhn("4" + "".join(str(r.randint(0, 9)) for _ in range(14)))
        w[20] = "".join(str(r.randint(0, 9)) for _ in range(16))
        w[25] = f"{word(r)} at {word(r)}"
        rows.append((3000 + k, " ".join(w)))
    return rows


def test_trees_find_other_spellings_and_leave_clean_texts_alone(spark, docs_of):
    a, b = _luhn("400000000000001"), _luhn("450000000000022")
    extra = [(1000, f"two of them {a} {b} here"), (1001, "write to anna.77 at mail9 dot example dot com please"),
             (1002, "he sat at home on 2024-01-02 at 10:30 with version 1.2.3 of it"), *((d or -1, t) for d, t in ODD)]
    rows = personal_rows(1) + extra
    got = {r.doc_id: r for r in pii.find_personal_data(docs_of(rows)).collect()}
    for doc_id, text in rows:
        if doc_id not in (4,):
            assert [(s.start, s.end, pii.KINDS.index(s.kind)) for s in got[doc_id].base] == brute_spans(text or "")
        assert {tuple(s) for s in got[doc_id].base} <= {tuple(s) for s in got[doc_id].spans}
    text_of = dict(rows)
    found = lambda d: [text_of[d][s.start : s.end] for s in got[d].spans]
    assert found(1000) == [a, b] and not got[1000].base
    assert found(1001) == ["anna.77 at mail9 dot example dot com"]
    assert found(1002) == []
    added = sum(len(got[k].spans) - len(got[k].base) for k in range(3000, 3260))
    assert added <= 3


def test_all_examples_are_learnt_from_whoever_adds_them_up(spark, monkeypatch):
    from pyspark.sql import functions as F

    rng = random.Random(5)
    rows = [[{"start": k, "end": k + 9, "kind": pii.IP, "label": int(k % 3 == 0), "features": [float(rng.randrange(9) + 4 * (k % 3 == 0)), float(k % 5), float(rng.randrange(6000))]}] for k in range(30_000)]
    found = spark.createDataFrame([(r,) for r in rows], f"_candidates {pii._CANDIDATES}").repartition(3)
    labelled = found.selectExpr("inline(_candidates)")
    edges = pii.feature_edges(labelled)
    counts = pii.example_counts(labelled, edges)
    assert {r.label: r.n for r in counts.groupBy("label").agg(F.sum("n").alias("n")).collect()} == {0: 20_000, 1: 10_000}  # no sample
    assert [len(e) for e in edges[pii.IP]][:2] == [12, 4] and len(edges[pii.IP][2]) < pii.BINS
    grow = pii.grow
    monkeypatch.setattr(pii, "grow", lambda *a: grow(*a, rounds=3))
    here, spread = (pii.fit_model(found, counted=c).kinds[pii.IP] for c in (1 << 20, 0))
    for x, y in zip((here[0].feature, here[0].cut, here[0].value, here[1:]), (spread[0].feature, spread[0].cut, spread[0].value, spread[1:]), strict=True):
        assert np.allclose(x, y)


def test_personal_data_without_texts(docs_of):
    assert pii.find_personal_data(docs_of([(1, "x")]).where("false")).collect() == []
    assert pii.find_personal_data(docs_of([(1, None)])).collect()[0].spans == []


def test_redaction_keeps_the_other_columns(docs_of):
    docs = docs_of([(1, "mail a.1@b.example.com or +1 (222) 555-1234."), (2, None), (3, "clean"), (3, "clean")])
    got = sorted(pii.redact_personal_data(docs).collect(), key=str)
    assert [r.text for r in got] == ["mail <email> or <phone>.", None, "clean", "clean"] and got[0].asDict().keys() == set(docs.columns)


def test_splits_are_those_of_a_plain_search():
    rng = np.random.default_rng(2)
    x = rng.integers(0, 6, (300, 3)).astype(float)
    y = ((x[:, 1] > 2) & (x[:, 2] < 4)).astype(float)
    edges = boosting.bins_of(x, 8)
    code = boosting.binned(x, edges)
    grad, hess = 0.5 - y, np.full(300, 0.25)
    feature, cut = boosting.best_splits(code, np.zeros(300, np.int64), 1, grad, hess, 8, 1.0, 1.0)

    def gain(f, c):
        left = code[:, f] <= c
        parts = [(grad[p].sum(), hess[p].sum()) for p in (left, ~left)]
        if min(h for _, h in parts) < 1:
            return 0
        return sum(g * g / (h + 1) for g, h in parts) - grad.sum() ** 2 / (hess.sum() + 1)

    assert gain(feature[0], cut[0]) == pytest.approx(max(gain(f, c) for f in range(3) for c in range(8)))
    held = rng.integers(0, 6, (200, 3)).astype(float)
    p = boosting.boost(x, y).raw(held) > 0
    assert (p == ((held[:, 1] > 2) & (held[:, 2] < 4))).mean() > 0.97


def test_thresholds_hold_the_precision():
    p, y = np.array([0.9, 0.8, 0.8, 0.7, 0.2]), np.array([1, 1, 1, 0, 1])
    assert boosting.precise_threshold(p, y, 0.99) == 0.8
    assert boosting.precise_threshold(p, 0 * y, 0.99) > 1
    a, b = boosting.platt(np.array([-2.0, -1, 1, 2] * 50), np.array([0, 0, 1, 1] * 50))
    assert a > 0 and 1 / (1 + np.exp(-(a * 2 + b))) > 0.9


# ------------------------------------------------------------------ op13


def test_product_by_rows_is_the_matrix_product():
    rng = np.random.default_rng(3)
    a, b = rng.integers(0, 3, (7, 11)), rng.integers(0, 3, (11, 5))
    sparse = lambda m: Csr.of(*np.nonzero(m), *m.shape, m[np.nonzero(m)])
    got = np.zeros((7, 5), np.int64)
    product = sparse(a) @ sparse(b)
    got[product.rows(), product.indices] = product.values
    assert (got == a @ b).all()
    turned = sparse(a).transposed()
    assert turned.n_rows == 11 and turned.values.sum() == a.sum()


def brute_tokens(text, whole_a, whole_b):
    """(id, start, end) of A and of B, or nothing where they do not spell the text."""
    if not text:
        return [], []
    full = (" " + text).encode()
    out = []
    for ids, spell in ((whole_a.encode(" " + text, add_special_tokens=False).ids, A_BYTES(whole_a)), (whole_b.encode(text), lambda k: B_BYTES(whole_b.id_to_piece(k)))):
        tokens, at, joined = [], 0, b""
        for k in ids:
            joined += spell(k)
            tokens.append((k, at, len(joined)))
            at = len(joined)
        if joined != full:
            return [], []
        out.append(tokens)
    return out


def A_BYTES(tokenizer):
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    of = {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}
    return lambda k: bytes(of[c] for c in tokenizer.id_to_token(k))


def B_BYTES(piece):
    return bytes([int(piece[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", piece) else piece.replace("▁", " ").encode()


def test_alignment_against_both_tokenizers(docs_of):
    import public_tokenizers as P
    import sentencepiece
    from tokenizers import Tokenizer

    whole_a, whole_b = Tokenizer.from_file(P.path("byte_bpe_50k.json")), sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    whole_a.encode_special_tokens = True
    rows = [(d or -1, t) for d, t in ODD if d != 4] + [
        (20, "abc "), (21, "  a  b "), (22, "a▁b c"), (23, "\n\n x\r\n y"), (24, "<s> </s> <|endoftext|> <0x41>"), (25, "tab\t x  y  \x85 z"),
        (26, "x" * 3000 + " y"), (27, " "), (28, "\x1c b\x1d c"), (29, "é ́   \U0001f600 don't 12 345"), (29, "the same"), (29, "the same"),
    ]
    random.seed(4)
    for k in range(60):
        rows.append((100 + k, "".join(random.choice(["the ", "ing", " ", "\n", "é", "don't", "  ", "12", "▁" if k % 9 == 0 else "x", "。", "\t"]) for _ in range(random.randint(1, 40)))))
    per, total = [], Counter()
    for d, t in rows:
        a, b = brute_tokens(t, whole_a, whole_b)
        cuts = sorted({e for *_, e in a} & {e for *_, e in b})
        groups, start = [], 0
        for c in cuts:
            groups.append("|".join(",".join(str(k) for k, s, e in x if start <= s and e <= c) for x in (a, b)))
            start = c
        links = Counter((k, m) for k, _, e in a for m, _, f in b if e == f) if len(a) < 5000 else Counter((k, m) for k, m in zip(_at(a, cuts), _at(b, cuts), strict=True))
        per.append((d, len(a), len(b), len(cuts), links, hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""))
        total.update(links)
    best = {}
    for (_, m), n in total.items():
        best[m] = max(best.get(m, 0), n)
    want = sorted((d, a, b, g, sum(k.values()), sum(n for p, n in k.items() if total[p] == best[p[1]]), sum(n * total[p] for p, n in k.items()), s) for d, a, b, g, k, s in per)
    for frequent in (alignment.FREQUENT, 40, 0):
        got = alignment.align_tokenizers(docs_of(rows), frequent=frequent)
        assert sorted(map(tuple, got.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256").collect())) == want
    kept = {r.doc_id: Counter({(x.a, x.b): x.times for x in r.links}) for r in got.collect()}
    assert all(kept[d] == k for d, *_, k, _ in per if d != 29)  # 29 is three documents
    assert "score" in got.columns  # the input's own columns stay


def _at(tokens, cuts):
    ends = {e: k for k, _, e in tokens}
    return [ends[c] for c in cuts]


def test_overlap_and_group_links_of_a_text():
    text = "don't stop naïvely  12345 \U0001f600"
    over, group, end = (alignment.token_links(text, kind) for kind in ("overlap", "group", "end"))
    found = alignment.aligner(alignment.BYTE_TOKENIZER, alignment.BYTE_RANKS, alignment.PIECE_TOKENIZER).blocks([" " + text])
    spans_a, spans_b = list(zip(found.a_start, found.a_end, strict=True)), list(zip(found.b_start, found.b_end, strict=True))
    shared = {(i, j): min(e, f) - max(s, t) for i, (s, e) in enumerate(spans_a) for j, (t, f) in enumerate(spans_b) if min(e, f) > max(s, t)}
    assert {(i, j): w for i, _, j, _, w in over} == shared
    assert {(i, j) for i, _, j, _, _ in end} == {(i, j) for i, j in shared if spans_a[i][1] == spans_b[j][1]}
    assert {(i, j) for i, _, j, _, _ in group} == {(i, j) for i in range(len(spans_a)) for j in range(len(spans_b)) if found.a_group[i] == found.b_group[j]}
    assert alignment.token_links("", "group") == [] and alignment.token_links("a▁b") == []


def test_alignment_without_documents(docs_of):
    assert alignment.align_tokenizers(docs_of([(1, "x")]).where("false")).collect() == []


def test_a_full_table_is_emptied(monkeypatch):
    monkeypatch.setattr(alignment, "KEPT_CHUNKS", 5)
    small, large = alignment.Aligner(), alignment.aligner(alignment.BYTE_TOKENIZER, alignment.BYTE_RANKS, alignment.PIECE_TOKENIZER)
    texts = [f"one two {k} three {k % 3}" for k in range(30)]
    for a, b in zip(small.documents(texts), large.documents(texts), strict=True):
        assert a[1] == b[1] and a[0].tolist() == b[0].tolist() and a[2].tolist() == b[2].tolist()
