import collections
import functools
import math
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from odd_rows import ODD
from pyspark.sql import functions as F

from topicframe.llm import perplexity as px
from topicframe.llm import suffix_tree as st
from topicframe.llm.common import bucket_of_id, checkpointed, stage
from topicframe.llm.spans import BLANKS, Words, combine, text_chunks

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")


TEXTS = ["", None, " ", "Aa bB  cc\tdd\x0bee\x0cff\x0d\n gg", "é É ß 中文 \U0001f600x", "a\x00b c", "x" * 5000, "one", "end "]


def test_words_rows_and_hashes():
    column = pa.array(["skipped", *TEXTS], pa.string()).slice(1)
    seen = []
    for a, b, data, offsets in text_chunks(column, 40):
        words = Words(data, offsets, BLANKS)
        raw = data.tobytes()
        for r in range(b - a):
            own = np.flatnonzero(words.row == r)
            assert [raw[words.start[k] : words.end[k]].decode() for k in own] == WORD.findall(TEXTS[a + r] or "")
            seen += [(lower(raw[words.start[k] : words.end[k]].decode()), int(words.hashes()[k])) for k in own]
        h, at = combine(words.hashes(), words.row, 2)
        assert len(h) == sum(max(0, n - 1) for n in words.per_row()) and (words.row[at] == words.row[at + 1]).all()
    assert len({w for w, _ in seen}) == len(set(seen)) == len({h for _, h in seen})


def base_counts(text):
    text = text or ""
    words = WORD.findall(text)
    lines, seen, dup = text.split("\n"), set(), 0
    for line in lines:
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    grams = collections.Counter(zip(words, words[1:], words[2:]))
    covered = {k + j for k, g in enumerate(zip(words, words[1:], words[2:])) if grams[g] > 1 for j in range(3)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(covered))


REPEATS = ["a b c a b c", "a a a", "a a a a", "x\ny\nx\n\n \n \nx", "l\r\nl\r\nl", "a b c d a b c\na b c", "#$ %&*|<> **", "A b c a b c"]


def test_text_counts_equal_brute_force():
    column = pa.array([*TEXTS, *REPEATS, *REPEATS], pa.string())
    for a, b, data, offsets in text_chunks(column, 200):
        got = zip(*(c.tolist() for c in px.text_counts(data, offsets)))
        for k, row in zip(range(a, b), got):
            assert row == base_counts(column[k].as_py()), column[k]


def kneser_ney_of(texts):
    """Modified Kneser-Ney by dictionaries, over the same symbols."""
    grams = collections.Counter()
    streams = []
    for a, b, data, offsets in text_chunks(pa.array(texts, pa.string())):
        code, first = px.symbols(data, offsets)
        for r in range(b - a):
            digits = [tuple(c // px.SYMBOLS**k % px.SYMBOLS for k in range(px.ORDER - 1, -1, -1)) for c in code[first[r] : first[r + 1]].tolist()]
            streams.append(digits)
            grams.update(digits)
    counts = {px.ORDER: grams}
    for k in range(px.ORDER - 1, 0, -1):
        counts[k] = collections.Counter(g[1:] for g in counts[k + 1])

    def discounts(c):
        n = [max(1, sum(v == k for v in c.values())) for k in range(1, 5)]
        y = n[0] / (n[0] + 2 * n[1])
        return [0] + [min(max(k - (k + 1) * y * n[k] / n[k - 1], 0.05), k - 0.05) for k in range(1, 4)]

    d = {k: discounts(c) for k, c in counts.items()}
    after = {k: collections.defaultdict(list) for k in counts}
    for k, c in counts.items():
        for g, n in c.items():
            after[k][g[:-1]].append(n)

    def p(g):
        k = len(g)
        if k == 0:
            return 1 / px.SYMBOLS
        below = p(g[1:]) if k > 1 else 1 / px.SYMBOLS
        seen = after[k].get(g[:-1])
        if not seen:
            return below
        n = counts[k].get(g, 0)
        return (n - d[k][min(n, 3)]) / sum(seen) * (n > 0) + sum(d[k][min(x, 3)] for x in seen) / sum(seen) * below

    return p, streams


def test_kneser_ney_equals_dictionaries():
    train = ["the cat sat on the mat", "the dog sat", "a cat and a dog; the end.", "été où", "", "12 34"]
    test = ["the cat and the dog", "zzz qqq", "été", "", "\U0001f600"]
    p, _ = kneser_ney_of(train)
    codes = np.concatenate([px.symbols(d, o)[0] for _, _, d, o in text_chunks(pa.array(train))])
    model = px.Scorer(*(a.tobytes() for a in px.kneser_ney(*np.unique(codes, return_counts=True))))
    _, streams = kneser_ney_of(test)
    for _, _, data, offsets in text_chunks(pa.array(test)):
        code, first = px.symbols(data, offsets)
        logs = model(code)
        for r, digits in enumerate(streams):
            assert np.allclose(logs[first[r] : first[r + 1]], [math.log10(p(g)) for g in digits], atol=1e-5)
    # a distribution: the next symbols of a context sum to one
    context = streams[0][5][:-1]
    assert sum(p((*context, s)) for s in range(px.SYMBOLS)) == pytest.approx(1)


def test_judging_rows(spark, docs_of):
    prose = [(1000 + k, " ".join(f"{'the a of and in'.split()[(k * 7 + j * j) % 5]} word{(j * (k + 3)) % 97}" for j in range(60))) for k in range(60)]
    junk = [(5000, " ".join(f"Zq{j * 7919 % 1000}#@!~^{j * 104729 % 997}" for j in range(80)))]
    rows = ODD + prose + junk
    docs = docs_of(rows).withColumn("lang", F.when(F.col("doc_id") == 1, None).otherwise("en"))
    got = px.judge_quality(docs).collect()
    assert len(got) == len(rows)
    for r in got:
        if r["doc_id"] is not None:
            want = base_counts(dict(rows)[r["doc_id"]])
            assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want
            assert r["base_failed"] == (want[0] < 50 or 100 * want[4] > 50 * want[0])
            assert not (r["kept"] and r["base_failed"])
    kept = {r["doc_id"]: r["kept"] for r in got}
    assert all(kept[d] for d, _ in prose) and not kept[5000]
    assert px.judge_quality(docs.limit(0)).count() == 0


def test_letters_of_one_class_are_told_apart(spark, docs_of):
    # 17 apart: one class of other letters
    a, b = "\u0436", chr(0x436 + 17 * 40)
    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa".split()
    rng = np.random.default_rng(8)
    text = lambda letter: " ".join(rng.choice(words) + letter for _ in range(80))
    rows = [(k, text(a)) for k in range(60)] + [(100, text(b))]
    docs = docs_of(rows, extra=False).withColumn("lang", F.lit("x"))
    assert px.symbols(*next(text_chunks(pa.array([a])))[2:])[0].tolist() == px.symbols(*next(text_chunks(pa.array([b])))[2:])[0].tolist()
    got = {r["doc_id"]: r for r in px.judge_quality(docs).collect()}
    assert got[100]["log_perplexity"] > 0.2 + max(r["log_perplexity"] for d, r in got.items() if d != 100)
    assert not got[100]["kept"] and sum(r["kept"] for r in got.values()) >= 55
    letters, shares = px.letter_shares(np.array([0x436, 0x436 + 17, 0x437]), np.array([6, 2, 5]))
    share = dict(zip(letters.tolist(), (10.0 ** shares).tolist(), strict=True))
    assert np.allclose([share[0x436], share[0x436 + 17], share[0x437]], [6 / 10, 2 / 10, 5 / 6])


def characters_of(text):
    """4-grams of single characters by hand; an edge is the empty string, a run of blanks one."""
    line = ["", "", "", *re.sub(r"[\x20\x09-\x0D]+", " ", text).lower(), ""]
    return [tuple(line[k : k + 4]) for k in range(len(line) - 3)]


def character_model(texts):
    """Log10 probabilities of a text's characters, and of their classes, by dictionaries over the model of classes."""
    codes = lambda some: np.concatenate([px.symbols(d, o)[0] for _, _, d, o in text_chunks(pa.array(some))])
    of_classes = px.Scorer(*(a.tobytes() for a in px.kneser_ney(*np.unique(codes(texts), return_counts=True))))
    counts = {4: collections.Counter(g for t in texts for g in characters_of(t))}
    alike = collections.defaultdict(collections.Counter)  # class: its characters
    for t in texts:
        for g, c in zip(characters_of(t), codes([t]).tolist(), strict=True):
            alike[c % px.SYMBOLS][g[-1]] += 1
    for k in (3, 2, 1):
        counts[k] = collections.Counter(g[1:] for g in counts[k + 1])

    def discounts(c):
        n = [max(1, sum(v == k for v in c.values())) for k in range(1, 5)]
        y = n[0] / (n[0] + 2 * n[1])
        return [0] + [min(max(k - (k + 1) * y * n[k] / n[k - 1], 0.05), k - 0.05) for k in range(1, 4)]

    d = {k: discounts(c) for k, c in counts.items()}
    after = {k: collections.defaultdict(list) for k in counts}
    for k, c in counts.items():
        for g, n in c.items():
            after[k][g[:-1]].append(n)

    def p(g, lowest):
        if not g:
            return lowest
        k, below = len(g), p(g[1:], lowest)
        seen = after[k].get(g[:-1])
        if not seen:
            return below
        n = counts[k].get(g, 0)
        return (n - d[k][min(n, 3)] * (n > 0)) / sum(seen) + sum(d[k][min(x, 3)] for x in seen) / sum(seen) * below

    def share(c, symbol):
        seen = alike[c]
        if c < 28:
            return 1.0
        return (seen[symbol] or max(1, len(seen))) / max(1, sum(seen.values()) + len(seen))

    def logs(text):
        code = codes([text])
        of_class = of_classes(code)
        return [math.log10(p(g, 10.0**x * share(c % px.SYMBOLS, g[-1]))) for g, c, x in zip(characters_of(text), code.tolist(), of_class.tolist(), strict=True)], of_class

    return logs


@pytest.mark.parametrize("sent", [px.SENT, 300, 0])
def test_perplexities_equal_single_characters_by_hand(spark, docs_of, monkeypatch, sent):
    monkeypatch.setattr(px, "SENT", sent)
    rng = np.random.default_rng(11)
    words = ["".join(rng.choice(list("abcdeEIJ0123456789#$%&.,-;\u0436\u0448\u0451\u0416\u4e2d\u6587\U0001f600"), 3)) for _ in range(120)]
    rows = [(k, "en" if k % 3 else "fr", "  ".join(rng.choice(words[: 60 + 20 * (k % 3)], 60)) + "\n" * (k % 2)) for k in range(24)]
    rows += [(100, "en", ""), (101, "de", "only one"), (102, "fr", rows[0][2])]
    docs = docs_of([(k, t) for k, _, t in rows], extra=False).join(spark.createDataFrame([r[:2] for r in rows], "doc_id long, lang string"), "doc_id")
    half = {r["doc_id"]: r["key"] & 1 for r in docs.select("doc_id", px.text_key().alias("key")).collect()}
    models = {}
    for name in ("en", "fr", "de"):
        for h in (0, 1):
            own = [t for k, lang, t in rows if lang == name and half[k] == h]
            if own:
                models[name, h] = character_model(own)
    of = lambda name, h: models.get((name, 1 - h)) or models[name, h]
    # the upper bound is the median: half of the texts are judged by stretches
    got = {r["doc_id"]: r for r in px.judge_quality(docs, above=0.0).collect()}
    assert len(got) == len(rows) and sum(r["mixed"] is not None for r in got.values()) >= 5
    for k, lang, t in rows:
        logs, of_class = of(lang, half[k])(t)
        assert got[k]["log_perplexity"] == pytest.approx(-np.mean(logs), abs=1e-5)
        assert got[k]["log_class_perplexity"] == pytest.approx(-np.mean(of_class), abs=1e-5)
        if got[k]["mixed"] is not None:
            each = [of(name, half[k])(t)[0] for name in ("en", "fr")]  # no text in de passes the base rules
            best = sum(max(sum(x[at : at + px.STRETCH]) for x in each) for at in range(0, len(logs), px.STRETCH))
            assert got[k]["mixed"] == pytest.approx(-best / len(logs), abs=1e-5)


def test_digits_signs_and_contexts_are_told_apart(spark, docs_of):
    rng = np.random.default_rng(9)
    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa".split()
    a, b = "\u0436", chr(0x436 + 17 * 40)  # one class of other letters
    text = lambda digit, sign, two: " ".join(f"{two[0]}{rng.choice(words)}{digit} {two[1]}{rng.choice(words)}{sign}" for _ in range(40))
    rows = [(k, text("7", "#", ("x" + a, "z" + b))) for k in range(60)]
    rows += [(100, text("8", "#", ("x" + a, "z" + b))), (101, text("7", "~", ("x" + a, "z" + b))), (102, text("7", "#", ("x" + b, "z" + a)))]
    got = {r["doc_id"]: r for r in px.judge_quality(docs_of(rows, extra=False).withColumn("lang", F.lit("x"))).collect()}
    most = max(r["log_perplexity"] for d, r in got.items() if d < 100)
    for d in (100, 101, 102):
        assert got[d]["log_perplexity"] > most + 0.05 and not got[d]["kept"]
    assert sum(r["kept"] for r in got.values()) >= 55


def test_counts_are_handed_on(spark, docs_of, monkeypatch):
    monkeypatch.setattr(px, "HELD", 50)
    texts = [f"{k} text {k * 7919 % 101}" for k in range(200)]
    docs = docs_of(list(enumerate(texts)), extra=False).select("text", F.lit(3).alias("model"), px.text_key().alias("text_key"))
    want = collections.Counter(g for t in texts for g in characters_of(t))
    symbol = lambda n: chr(n - 1) if n else ""
    got = {}
    for r in px.ngram_counts(docs).collect():
        got[*(symbol(r["context"] >> px.BITS * k & (1 << px.BITS) - 1) for k in (2, 1, 0)), symbol(r["symbol"])] = r["n0"] + r["n1"]
    assert got == want


def test_rare_languages_share_a_model(spark, docs_of):
    docs = docs_of([(k, f"some words in language {k % 5}") for k in range(50)]).withColumn("lang", F.concat(F.lit("l"), F.col("doc_id") % 5))
    assert px.judge_quality(docs, models=2).where("log_perplexity > 0").count() == 50


@pytest.mark.parametrize("frequent", [st.FREQUENT, 3])
def test_base_scores_equal_brute_force(spark, docs_of, monkeypatch, frequent):
    monkeypatch.setattr(st, "FREQUENT", frequent)
    rows = ODD + [(100 + k, " ".join(f"w{(j * j + k) % 13} W{j % 3}" for j in range(k % 9))) for k in range(80)] + [(990 + k, "only\there") for k in range(20)]
    docs = docs_of(rows, extra=False).withColumn("held_out", bucket_of_id(10) == 0)
    got = st.score_documents(docs, docs.where(~F.col("held_out")).select("text")).collect()
    tokens = lambda t: [*WORD.findall(lower(t)), "\n"]
    held = lambda d: zlib.crc32(b"" if d is None else str(d).encode()) % 10 == 0
    counts = collections.Counter(w for d, t in rows if not held(d) for w in tokens(t))
    total, distinct = sum(counts.values()), len(counts)
    want = sorted((d or -1, held(d), len(tokens(t)), sum(counts[w] > 0 for w in tokens(t)), total, round(sum(math.log10((counts[w] + 0.1) / (total + 0.1 * (distinct + 1))) for w in tokens(t)), 6)) for d, t in rows)
    assert sorted((r["doc_id"] or -1, r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in got) == want
    assert all(r["score"] < 0 for r in got)


def test_suffix_tree_equals_dictionaries(spark):
    train = ["abracadabra abra", "abra cad", "Cadabra", "", "banana band"] * 6
    docs = spark.createDataFrame([(t,) for t in train], "text string")
    tree = st.build_tree(st.training_counts(docs).where("kind = 1").select("key", "n"), least_count=1, divergence=0.02, gain=0.5)
    states, screen, _ = st.sent_states(tree)
    assert not screen.any()  # all were sent
    D = st.DEPTH
    seqs = [bytes([10] * D) + " ".join(WORD.findall(lower(t))).encode() + b"\n" for t in train]
    grams = [(s[k - D : k], s[k]) for s in seqs for k in range(D, len(s))]
    after = collections.defaultdict(collections.Counter)
    for context, symbol in grams:
        for k in range(D + 1):
            after[context[D - k :]][symbol] += 1
    kept = {b""}
    for context, own in after.items():
        if context:
            n, up = sum(own.values()), after[context[1:]]
            kl = sum(c / n * math.log(c / n / (up[s] / sum(up.values()))) for s, c in own.items())
            if kl >= 0.02 and kl * n >= 0.5:
                kept |= {context[k:] for k in range(len(context) + 1)}

    def p(context, symbol):
        while context not in kept:
            context = context[1:]
        own = after[context]
        below = p(context[1:], symbol) if context else 1 / 256
        return (own[symbol] + len(own) * below) / (sum(own.values()) + len(own))

    assert sum(len(s[2]) for s in states) == len(kept)
    for text in ["abra band", "zebra", "cadabra"]:
        s = bytes([10] * D) + text.encode() + b"\n"
        want = [math.log10(p(s[k - D : k], s[k])) for k in range(D, len(s))]
        for _, _, data, offsets in text_chunks(pa.array([text])):
            assert np.allclose(st.log10_next(states, st.sequences(Words(data, offsets))[0])[0], want, atol=1e-5)


def test_states_that_are_not_sent_are_joined(spark, docs_of, monkeypatch):
    rows = ODD + [(100 + k, " ".join(f"word{(j * j + k) % 13} W{j % 3}" for j in range(k % 9))) for k in range(80)]
    monkeypatch.setattr(st, "build_tree", functools.partial(st.build_tree, least_count=3, gain=0.5))
    docs = docs_of(rows).withColumn("score", F.lit("old")).withColumn("N_Tokens", F.lit(0)).withColumn("row", F.lit(1)).withColumn("c0", F.lit(2))
    scores = []
    for sent, bits in [(st.SENT_STATES, st.SCREEN_BITS), (200, st.SCREEN_BITS), (20, 6), (0, st.SCREEN_BITS)]:
        monkeypatch.setattr(st, "SENT_STATES", sent)
        monkeypatch.setattr(st, "SCREEN_BITS", bits)
        got = st.score_documents(docs, docs.where("doc_id % 3 = 0").select("text"))
        assert {c.lower() for c in got.columns} == {c.lower() for c in docs.columns if c != "text"} | {"n_known", "train_tokens", "base_score"}
        scores.append(sorted((r["doc_id"] or -1, r["n_tokens"], r["score"]) for r in got.collect()))
    assert len(scores[0]) == len(rows)
    for other in scores[1:]:
        assert [r[:2] for r in other] == [r[:2] for r in scores[0]]
        assert np.allclose([r[2] for r in other], [r[2] for r in scores[0]], atol=1e-3)


def test_a_candidate_of_a_part_is_one_of_the_whole(spark):
    texts = spark.createDataFrame([(" ".join(f"w{(j * k) % 7}" for j in range(30)),) for k in range(60)], "text string")
    contexts = lambda d: {(r["level"], r["context"]) for r in st.candidate_grams(st.training_counts(d).where("kind = 1").select("key", "n"), least_count=20).select("level", "context").collect()}
    half = contexts(texts.limit(30))
    assert half and half <= contexts(texts.union(texts).union(spark.createDataFrame([("other words " * 500,)], "text string")))


def test_a_second_run_leaves_the_result_of_the_first(spark, docs_of):
    begin = stage(lambda spark, docs, sf_dir: checkpointed(docs, "one"), first=True)
    end = stage(lambda spark, docs, sf_dir: checkpointed(docs, "two"))
    docs, results = docs_of([(1, "a"), (2, "b")]), []
    for _ in range(2):
        kept = begin(spark, docs, "")
        results.append(end(spark, docs, ""))
        with pytest.raises(Exception, match="(?i)not.exist"):
            kept.collect()
    assert [r.count() for r in results] == [2, 2] and all(len(r.collect()) == 2 for r in results)


def test_nothing_to_learn_from(spark, docs_of):
    docs = docs_of([(1, "a b"), (2, None)], extra=False)
    got = {r["doc_id"]: r for r in st.score_documents(docs, docs.limit(0).select("text")).collect()}
    assert got[1]["n_known"] == 0 and got[1]["train_tokens"] == 0 and got[2]["n_tokens"] == 1
    assert got[2]["score"] == pytest.approx(math.log10(1 / 256))
    assert st.score_documents(docs.limit(0), docs.select("text")).count() == 0
