"""Personal data: fixed patterns, and boosted trees over candidate spans.

Patterns give the base spans. Generators with a high recall propose more
and overlapping spans: what stands around an ``@``, a bracketed ``at`` or
the word ``at``; and every window of up to ``MOST_GROUPS`` neighbouring
groups of digits. A candidate has features of its format (of the normalised
address, of the groups and what separates them) and of its context (words
that announce personal data, digits and letters next to it).

Labels come from the corpus itself. A candidate that is a base span is an
example for; one that breaks a rule of its kind, or overlaps a base span
without being it, is one against; the others are not learnt from. Features
that only say that a candidate is spelt as the patterns want it (a literal
``@``, a leading ``+``) are left out, so the trees can judge other spellings.

All examples are learnt from. Features are cut into bins, and examples of
one kind, label and bins are counted: a kind's trees, which see bins only,
are grown from sums over these counts. Where they are few (``MOST_COUNTED``)
the driver adds them up, else a Spark job a level does. Trees are fitted on
four fifths of the examples (by hash); on the last fifth the scores are
calibrated, and the threshold is the least probability with the wanted
precision there. Candidates beyond the threshold that touch no base
span are added, the likeliest first where they overlap. A kind with fewer
than ``LEAST`` examples of either label adds none.

Texts are scanned whole, once; what is found is written, with the features,
and scored from there. Every scan is linear in the text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicframe.llm.boosting import Boosted, Rows, binned, bins_of, descend, grow, platt, precise_threshold
from topicframe.llm.common import checkpointed, documents, fresh_name

KINDS = ["email", "ip", "card", "phone"]
EMAIL, IP, CARD, PHONE = range(4)

#: Fixed values of the base patterns.
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
AT_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IPV4 = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")  # a match takes its last digits whole, so none begins inside a number
DIGITS = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PLUS = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
CARD_DIGITS, PHONE_DIGITS = (14, 19), (10, 15)

AT = re.compile(r"\x20?(?:@|[\[({]\x20?at\x20?[\])}])\x20?|\x20at\x20", re.I)
DOMAIN = re.compile(r"([A-Za-z0-9-]+)((?:(?:\x20?(?:\.|\[\.\]|[\[({]\x20?dot\x20?[\])}])\x20?|\x20dot\x20)[A-Za-z0-9-]+)*)", re.I)
DOT = re.compile(r"\x20?(?:\.|\[\.\]|[\[({]\x20?dot\x20?[\])}])\x20?|\x20dot\x20", re.I)
#: Digits with what may stand between their groups in a number.
NUMBER = re.compile(r"\+?\(?[0-9]+(?:(?:\)?[\x20./ -]?\(?|\[\.\])[0-9]+)*\)?")
GROUP = re.compile("[0-9]+")
#: Most groups of digits in one candidate, and least and most of its digits.
MOST_GROUPS = 6
NUMBER_DIGITS = (4, 19)
#: Words that announce a kind, in the ``CONTEXT`` characters before.
CUES = [
    re.compile(r"mail|contact|write|@", re.I),
    re.compile(r"\bip\b|address|host|server|login", re.I),
    re.compile(r"card|visa|master|amex|credit|pay", re.I),
    re.compile(r"phone|\btel|call|fax|mobile|cell|contact|whatsapp|\bsms", re.I),
]
CONTEXT = 40

#: Counts of examples that the driver adds up itself; of more, only sums come to it.
MOST_COUNTED = 200_000
BINS = 32
#: Distinct values of a feature whose bins are found from the values themselves.
MOST_VALUES = 4096
#: Steps of the scores by which examples are counted for the calibration, and the largest score.
SCORE_STEP, MOST_SCORE = 0.001, 40.0
#: Examples of each label without which a kind adds nothing.
LEAST = 30
#: Share of personal data among the calibration examples beyond the threshold.
PRECISION = 0.99

Span = tuple[int, int, int]  # start, end, place of the kind in KINDS


def luhn(digits: str) -> bool:
    doubled = [sum(divmod(2 * int(d), 10)) for d in digits[-2::-2]]
    return (sum(doubled) + sum(map(int, digits[-1::-2]))) % 10 == 0


def _only_digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    at, free = text.find("@"), 0
    while at >= 0:
        begin = free + len(text[free:at].rstrip(LOCAL))
        m = AT_DOMAIN.match(text, at) if begin < at else None
        if m:
            yield begin, m.end()
        free = m.end() if m else at + 1
        at = text.find("@", free)


def base_spans(text: str) -> list[Span]:
    """Spans of the fixed patterns by start, then by kind as listed."""
    out: list[Span] = [(s, e, EMAIL) for s, e in _emails(text)]
    for m in IPV4.finditer(text):
        if all(len(part.lstrip("0")) <= 3 and int(part[-4:]) <= 255 for part in m[0].split(".")):
            out.append((m.start(), m.end(), IP))
    for m in DIGITS.finditer(text):
        if CARD_DIGITS[0] <= m.end() - m.start() and CARD_DIGITS[0] <= len(d := _only_digits(m[0])) <= CARD_DIGITS[1] and luhn(d):
            out.append((m.start(), m.end(), CARD))
    for m in PLUS.finditer(text):
        if PHONE_DIGITS[0] <= len(_only_digits(m[0])) <= PHONE_DIGITS[1]:
            out.append((m.start(), m.end(), PHONE))
    return sorted(out, key=lambda x: (x[0], x[2], x[1]))


def email_candidates(text: str) -> Iterator[tuple[int, int, list[float]]]:
    """What stands around an at-sign or what is written for one, up to each end that a domain may have."""
    free = 0
    for m in AT.finditer(text):
        begin = free + len(text[free : m.start()].rstrip(LOCAL))
        free = m.end()
        d = DOMAIN.match(text, m.end())
        if begin == m.start() or not d:
            continue
        local = text[begin : m.start()].lower()
        parts = [d[1], *DOT.split(d[2])[1:]]
        ends = [d.end(1), *(d.start(2) + x.start() for x in list(DOT.finditer(d[2]))[1:])] if d[2] else []
        for n, end in zip(range(1, len(parts) + 1), [*ends, d.end()], strict=False):
            if n in (1, len(parts)):
                yield begin, end, _email_features(local, parts[:n])


def _email_features(local: str, labels: list[str]) -> list[float]:
    top, host = labels[-1].lower(), ".".join(labels[:-1])
    return [
        len(labels), len(top), top.isalpha(), len(host), len(local), sum(c.isdigit() for c in local), "." in local[1:-1],
        any(c in "_%+-" for c in local), local[:1] in tuple("._%+-"), sum(c.isdigit() for c in host), labels[-1][:1].isupper(),
    ]


def number_candidates(text: str) -> Iterator[tuple[int, int, int, list[float], bool]]:
    """start, end, kind, features and whether it breaks a rule of the kind, of every window of groups that may be of a kind."""
    for m in NUMBER.finditer(text):
        if m.end() - m.start() < 7:
            continue
        groups = [(g.start(), g.end()) for g in GROUP.finditer(text, m.start(), m.end())]
        for i in range(len(groups)):
            digits = 0
            for j in range(i, min(i + MOST_GROUPS, len(groups))):
                digits += groups[j][1] - groups[j][0]
                if digits > NUMBER_DIGITS[1]:
                    break
                if digits >= NUMBER_DIGITS[0]:
                    yield from _window(text, groups, i, j, digits, m.start(), m.end())


def _window(text: str, groups: list[tuple[int, int]], i: int, j: int, digits: int, left: int, right: int) -> Iterator[tuple[int, int, int, list[float], bool]]:
    start, end = groups[i][0], groups[j][1]
    seps = [text[groups[k][1] : groups[k + 1][0]] for k in range(i, j)]
    sizes = [groups[k][1] - groups[k][0] for k in range(i, j + 1)]
    near = [
        start - groups[i - 1][1] if i else 9, groups[j + 1][0] - end if j + 1 < len(groups) else 9,  # to the groups next to it
        sizes[0], sizes[-1], len(sizes), digits,
    ]
    if len(sizes) == 4 and all(s in (".", "[.]") for s in seps):
        parts = [text[a:b] for a, b in groups[i : j + 1]]
        most = max(int(p[-6:]) for p in parts)
        yield start, end, IP, [*near, most, sum(len(p) > 1 and p[0] == "0" for p in parts), max(sizes)], most > 255 or max(sizes) > 3
    whole = text[start:end]
    if 12 <= digits and all(s in (" ", "-", ".", " ") for s in seps):
        good = luhn(_only_digits(whole))
        first = int(text[start])
        yield start, end, CARD, [*near, good, first, len(set(seps)), max(sizes), min(sizes), first in (3, 4, 5, 6)], not good
    if 7 <= digits <= 15 and len(sizes) > 1:
        while start > left and text[start - 1] in "+(":
            start -= 1
        if text[start:end].count("(") > text[start:end].count(")") and text[end : end + 1] == ")":
            end += 1
        dots = sum(s.count(".") for s in seps)
        features = [*near, max(sizes), min(sizes), sizes[-2], dots, "(" in text[start:end] and ")" in text[start:end], len(set(seps)), sum(s == " " for s in seps), sum("-" in s for s in seps)]
        yield start, end, PHONE, features, max(sizes) > 7 or (len(sizes) == 4 and dots == 3)


def candidates(text: str, base: list[Span]) -> list[tuple[int, int, int, int, list[float]]]:
    """start, end, kind, label and features: 1 for base spans, 0 for what breaks a rule or overlaps a base span, -1 unknown."""
    found = [(s, e, EMAIL, f, len(f) and f[0] < 2) for s, e, f in email_candidates(text)]
    found += number_candidates(text)
    if not found:
        return []
    of_base = set(base)
    edges = np.array([(s, e) for s, e, _ in base], np.int64).reshape(-1, 2)
    reach = np.maximum.accumulate(edges[:, 1]) if len(edges) else edges[:, 1]
    out = []
    for s, e, kind, features, broken in found:
        if (s, e, kind) in of_base:
            label = 1
        else:
            before = int(np.searchsorted(edges[:, 0], e, "left"))  # base spans that begin before its end
            label = 0 if broken or (before and reach[before - 1] > s) else -1
        around = text[max(0, s - CONTEXT) : s]
        after = text[e : e + 2]
        context = [
            CUES[kind].search(around) is not None, around[-1:].isalnum(), after[:1].isalnum(), after[:1] in "@.-/" and after[1:2].isalnum(), around[-1:] in tuple(".-/#_"),
        ]
        out.append((s, e, kind, label, [float(x) for x in (*features, *context)]))
    return out


class Model:
    """Trees, calibration and threshold of each kind that has them."""

    def __init__(self, kinds: dict[int, tuple[Boosted, float, float, float]]):
        self.kinds = kinds

    def probability(self, kind: int, x: np.ndarray) -> np.ndarray:
        trees, a, b, _ = self.kinds[kind]
        return 1 / (1 + np.exp(-np.clip(a * trees.raw(x) + b, -30, 30)))

    def accepted(self, kind: np.ndarray, features: pa.ListArray) -> np.ndarray:
        """The probability of candidates beyond their kind's threshold, else 0."""
        out = np.zeros(len(kind))
        for k in self.kinds:
            at = np.flatnonzero(kind == k)
            if len(at):
                rows = features.take(pa.array(at)).flatten().to_numpy().reshape(len(at), -1)
                p = self.probability(k, rows.astype(float))
                out[at] = np.where(p >= self.kinds[k][3], p, 0)
        return out


_FOUND = "array<struct<start:int,end:int,kind:int>>"
_CANDIDATES = "array<struct<start:int,end:int,kind:int,label:int,features:array<float>>>"


def find_candidates(docs: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """The id, ``_base`` spans and ``_candidates`` with label and features, of every text."""
    span = [("start", pa.int32()), ("end", pa.int32()), ("kind", pa.int32())]
    base_type = pa.list_(pa.struct(span))
    type_ = pa.list_(pa.struct([*span, ("label", pa.int32()), ("features", pa.list_(pa.float32()))]))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bases, found = [], []
            for value in batch.column(1):
                text = value.as_py() or ""
                base = base_spans(text)
                bases.append([{"start": s, "end": e, "kind": k} for s, e, k in base])
                found.append([{"start": s, "end": e, "kind": k, "label": y, "features": f} for s, e, k, y, f in candidates(text, base)])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(bases, base_type), pa.array(found, type_)], [id_column, "_base", "_candidates"])

    return docs.select(id_column, "text").mapInArrow(find, f"`{id_column}` {dict(docs.dtypes)[id_column]}, _base {_FOUND}, _candidates {_CANDIDATES}")


def feature_edges(labelled: DataFrame) -> dict[int, list[np.ndarray]]:
    """Per kind the edges of each feature's bins, by the distinct values of all examples."""
    values = checkpointed(labelled.select("kind", F.posexplode("features").alias("feature", "value")).distinct(), "pii-values")
    # a row a kind and feature
    quantiles = F.percentile_approx(F.col("value").cast("double"), [k / (BINS - 1) for k in range(BINS)], 10_000)
    known = values.groupBy("kind", "feature").agg(F.count("*").alias("n"), quantiles.alias("ends")).collect()
    few = values.join(F.broadcast(values.groupBy("kind", "feature").count().where(F.col("count") <= MOST_VALUES).drop("count")), ["kind", "feature"]).toArrow()
    kind, feature, value = (few[c].to_numpy() for c in ("kind", "feature", "value"))
    out: dict[int, list[np.ndarray]] = {}
    for r in sorted(known, key=lambda r: (r.kind, r.feature)):
        mine = value[(kind == r.kind) & (feature == r.feature)].astype(float)
        out.setdefault(r.kind, []).append(bins_of(mine[:, None], BINS)[0] if r.n <= MOST_VALUES else np.unique(r.ends)[:-1])
    return out


def example_counts(labelled: DataFrame, edges: dict[int, list[np.ndarray]]) -> DataFrame:
    """kind, held (of the last fifth), label, code (a byte a feature: its bin), n of all examples."""

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kind, features, codes = batch.column(0).to_numpy(), batch.column(3), np.empty(batch.num_rows, object)
            for k in np.unique(kind):
                at = np.flatnonzero(kind == k)
                rows = features.take(pa.array(at)).flatten().to_numpy().reshape(len(at), -1)
                codes[at] = [c.tobytes() for c in binned(rows.astype(float), edges[k]).astype(np.uint8)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(codes, pa.binary())], ["kind", "label", "held", "code"])

    held = F.pmod(F.xxhash64("features", "start"), F.lit(5)) == 4
    rows = labelled.select("kind", "label", held.alias("held"), "features").mapInArrow(coded, "kind int, label int, held boolean, code binary")
    return rows.groupBy("kind", "held", "label", "code").agg(F.count("*").alias("n"))


def _arrays(table: pa.Table | pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes, labels and counts of examples of one kind."""
    code = np.frombuffer(b"".join(table["code"].to_pylist()), np.uint8).reshape(table.num_rows, -1)
    return code.astype(np.int64), table["label"].to_numpy(), table["n"].to_numpy().astype(float)


def _sums_by_spark(counts: DataFrame):
    """Sums for :func:`grow` over ``counts`` (of one kind), a Spark job each."""

    def sums(trees: Boosted, t: int, level: int) -> tuple[np.ndarray, np.ndarray]:
        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = 0
            for batch in batches:
                if batch.num_rows:
                    rows = Rows(*_arrays(batch), BINS)
                    total = total + np.stack(rows(trees, t, level)).ravel()
            if np.ndim(total):
                yield pa.RecordBatch.from_pydict({"at": np.arange(len(total)), "x": total})

        got = counts.mapInArrow(add, "at long, x double").groupBy("at").agg(F.sum("x").alias("x")).toArrow()
        out = np.zeros(2 * 2**level * len(trees.edges) * BINS)
        out[got["at"].to_numpy()] = got["x"].to_numpy()
        return tuple(out.reshape(2, 2**level, len(trees.edges), BINS))

    return sums


def _codes_raw(trees: Boosted, code: np.ndarray) -> np.ndarray:
    """Log odds of binned rows, down to a step."""
    depth = int(np.log2(trees.value.shape[1]))
    raw = trees.start + sum(v[descend(code, f, c, depth) - (2**depth - 1)] for f, c, v in zip(trees.feature, trees.cut, trees.value, strict=True))
    return np.floor(np.clip(raw, -MOST_SCORE, MOST_SCORE) / SCORE_STEP)


def held_scores(counts: DataFrame, trees: Boosted) -> DataFrame:
    """step, label, n: a row a step of the score and label, whatever the examples."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                code, label, n = _arrays(batch)
                yield pa.RecordBatch.from_pydict({"step": _codes_raw(trees, code).astype(np.int64), "label": label, "n": n.astype(np.int64)})

    return counts.mapInArrow(score, "step long, label int, n long").groupBy("step", "label").agg(F.sum("n").alias("n"))


def fit_model(found: DataFrame, precision: float = PRECISION, counted: int | None = None) -> Model:
    """The model of all labelled candidates of ``found``.

    The driver holds at most ``counted`` (MOST_COUNTED) counts of a kind's
    examples; beyond that Spark adds them up, to the same trees.
    """
    counted = MOST_COUNTED if counted is None else counted
    labelled = found.select(F.explode("_candidates").alias("c")).select("c.*").where("label >= 0")
    edges = feature_edges(labelled)
    counts = checkpointed(example_counts(labelled, edges), "pii-examples")
    seen = {(r.kind, r.held, r.label): r for r in counts.groupBy("kind", "held", "label").agg(F.sum("n").alias("n"), F.count("*").alias("rows")).collect()}
    kinds = {}
    for kind in sorted(edges):
        n = {(held, label): seen[kind, held, label].n if (kind, held, label) in seen else 0 for held in (False, True) for label in (0, 1)}
        if min(n[False, label] + n[True, label] for label in (0, 1)) < LEAST or not all(n.values()):
            continue
        mine = counts.where(F.col("kind") == kind)
        fitted, held = mine.where("NOT held"), mine.where("held")
        few = sum(r.rows for (k, *_), r in seen.items() if k == kind) <= counted
        sums = Rows(*_arrays(fitted.orderBy("code", "label").toArrow()), BINS) if few else _sums_by_spark(fitted)
        trees = grow(sums, edges[kind], n[False, 1] / (n[False, 0] + n[False, 1]))
        scores = held_scores(held, trees).orderBy("step", "label").toArrow()  # at most a row a step
        raw, y, w = (scores[c].to_numpy().astype(float) for c in ("step", "label", "n"))
        raw = raw * SCORE_STEP
        a, b = platt(raw, y, weight=w)
        p = 1 / (1 + np.exp(-np.clip(a * raw + b, -30, 30)))
        kinds[kind] = trees, a, b, max(0.5, precise_threshold(p, y, precision, w))
    return Model(kinds)


def chosen(base: list[Span], found: list[tuple[int, int, int]], p: np.ndarray) -> list[Span]:
    """Accepted candidates that touch no base span, the likeliest (then the longest, the first) where they overlap."""
    taken = [(s, e) for s, e, _ in base]
    out = []
    for i in sorted(np.flatnonzero(p > 0), key=lambda i: (-p[i], found[i][0] - found[i][1], found[i])):
        s, e, _ = found[i]
        if all(e <= a or b <= s for a, b in taken):
            taken.append((s, e))
            out.append(found[i])
    return out


SPANS = "array<struct<start:int,end:int,kind:string>>"


def find_personal_data(docs: DataFrame, id_column: str = "doc_id", precision: float = PRECISION) -> DataFrame:
    """The id, ``base`` and ``spans`` (base and added ones): arrays of start, end, kind.

    Places are code points, end exclusive. Null and empty texts have no
    spans; repeated rows are scanned each; ids may be null or repeated.
    Other columns are not read. No rows give none.
    """
    found = checkpointed(find_candidates(docs, id_column), "pii-candidates")
    model = fit_model(found, precision)
    type_ = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string())]))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bases, spans = [], []
            # candidates of all texts of the batch are scored together
            offsets, flat = batch.column(2).offsets.to_numpy(), batch.column(2).flatten()
            start, end, kind = (flat.field(k).to_numpy() for k in range(3))
            p = model.accepted(kind, flat.field(4))
            offsets = offsets - offsets[0]
            for base, a, b in zip(batch.column(1).to_pylist(), offsets[:-1], offsets[1:], strict=True):
                base = [(x["start"], x["end"], x["kind"]) for x in base]
                good = a + np.flatnonzero(p[a:b])
                places = list(zip(start[good].tolist(), end[good].tolist(), kind[good].tolist(), strict=True))
                every = sorted([*base, *chosen(base, places, p[good])], key=lambda x: (x[0], x[2], x[1]))
                for column, these in ((bases, base), (spans, every)):
                    column.append([{"start": s, "end": e, "kind": KINDS[k]} for s, e, k in these])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(bases, type_), pa.array(spans, type_)], [id_column, "base", "spans"])

    return found.mapInArrow(judge, f"`{id_column}` {dict(docs.dtypes)[id_column]}, base {SPANS}, spans {SPANS}")


def redact_personal_data(docs: DataFrame, mark: str = "<{}>") -> DataFrame:
    """``docs`` with every span replaced by ``mark`` of its kind (overlapping ones by one mark); other columns are as before."""
    row = fresh_name(docs, "_row")
    numbered = checkpointed(docs.withColumn(row, F.monotonically_increasing_id()), "pii-rows")
    spans = find_personal_data(numbered, row).select(row, F.col("spans").alias(f"{row}_spans"))
    both = numbered.join(spans, row)
    at, spans_at, columns = both.columns.index("text"), both.columns.index(f"{row}_spans"), docs.columns

    def redact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for text, found in zip(batch.column(at).to_pylist(), batch.column(spans_at).to_pylist(), strict=True):
                parts, last = [], 0
                for x in found if text else ():
                    if x["start"] >= last:
                        parts += [text[last : x["start"]], mark.format(x["kind"])]
                    last = max(last, x["end"])
                texts.append("".join(parts) + text[last:] if parts else text)
            yield pa.RecordBatch.from_arrays(
                [pa.array(texts, pa.string()) if k == at else c for k, c in enumerate(batch.columns) if batch.schema.names[k] in columns], columns
            )

    return both.mapInArrow(redact, docs.schema)


def op12_personal_data(spark, sf_dir: str) -> DataFrame:
    found = find_personal_data(documents(spark, sf_dir))
    joined = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    return found.select("doc_id", *map(count, KINDS), F.sha2(joined("base").cast("binary"), 256).alias("base_sha256"), joined("spans").alias("spans"))
