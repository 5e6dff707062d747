"""Secret scan: fixed patterns, and zstandard novelty of strings in sensitive contexts.

Patterns give the base spans. The method adds ``novel`` spans: a candidate
is a run of 12 or more value characters within ``REACH`` characters after a
sensitive word on its line. Its novelty is the marginal compressed size,

    (|zstd(context + candidate)| - |zstd(context)|) / |candidate|,

under a dictionary of the identifiers that the corpus uses around sensitive
words, with the surrounding code as context. Names and words that occur
nearby or in the corpus cost little; keys cost about a byte a character.
The candidate itself is blanked out wherever the context repeats it, so a
key that is written twice is as novel as one that is written once.
Candidates at ``NOVELTY`` or more that no base span touches are reported;
a run of digits or of hexadecimal digits has fewer bits a character, and
its bound is as much lower.

The dictionary's identifiers are counted by Spark over all distinct texts;
the ``DICTIONARY_WORDS`` most frequent are kept, each at most ``WORD_CHARS``
long, so it has a fixed largest size. Of a run that is long enough for a
candidate only the words inside it (letters, at most 16) are counted, so no
copies make a key known. Texts are scanned whole, where they lie; nothing is shuffled but the
identifiers of a text that has sensitive words, and their counts.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicframe.llm.common import documents

#: Fixed patterns: kind, expression, group that is the secret, least characters.
BASE = [
    ("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 2, 12),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 18),
    ("hex", re.compile(r"[0-9a-f]{16,}"), 0, 16),  # maximal runs, as of [0-9a-f]+
]
KINDS = [kind for kind, *_ in BASE]

SENSITIVE = re.compile(r"pass(?:word|wd|phrase)|secret|token|(?:api|access|private|signing)[_-]?key|credential|bearer|authorization", re.I | re.A)
VALUE = re.compile(r"[A-Za-z0-9+/_.=-]")
CANDIDATE = re.compile(r"[A-Za-z0-9+/_.=-]{12,}")
IDENTIFIER = re.compile(r"[A-Za-z_][A-Za-z0-9_]{2,}")
#: Words inside a run of value characters: ``signing_keyRing`` has three.
PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
#: Alphabets that hold no words, and their symbols; digits with points or dashes are addresses and dates.
NUMERALS = [(re.compile("=?[0-9]+"), 10), *((re.compile(f"(?=.*[0-9])(?=.*[{x}])=?[0-9{x}-]+"), 16) for x in ("a-f", "A-F"))]

REACH = 80
CONTEXT = 256
NOVELTY = 0.8
#: Symbols of the alphabet that NOVELTY is meant for.
SYMBOLS = 64
#: Least length of a part of a run, between its ``=``, whose repeats are blanked out too.
LEAST_REPEAT = 8
#: Least and most letters of a word that is learnt from inside a run.
PART_LETTERS = (3, 16)
DICTIONARY_WORDS = 4096
WORD_CHARS = 40
LEVEL = 6

Span = tuple[int, int, str]  # start, end, kind


def base_spans(text: str) -> list[Span]:
    """Spans of the fixed patterns by start, then by kind as listed."""
    out: list[tuple[int, int, int]] = []
    for rank, (_, pattern, group, least) in enumerate(BASE):
        out += [(s, rank, e) for s, e in (m.span(group) for m in pattern.finditer(text)) if e - s >= least]
    return [(s, e, KINDS[rank]) for s, rank, e in sorted(out)]


def sensitive_candidates(text: str) -> list[tuple[int, int]]:
    """Candidate runs within REACH after a sensitive word, on its line; a run is taken whole however long."""
    found: dict[int, int] = {}
    for word in SENSITIVE.finditer(text):
        line = text.find("\n", word.end(), word.end() + REACH)
        limit = word.end() + REACH if line < 0 else line
        at = word.end()
        while (m := CANDIDATE.search(text, at)) and m.start() < limit:
            found[m.start()] = m.end()
            at = m.end()
            if at >= limit:
                break
    return sorted(found.items())


class Novelty:
    """Marginal compressed size under a dictionary."""

    def __init__(self, words: list[str]):
        import zstandard

        content = "\n".join(reversed(words)).encode() + b"\n"
        if len(content) >= 8:
            book = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            book.precompute_compress(level=LEVEL)
            self.size = zstandard.ZstdCompressor(dict_data=book, write_checksum=False, write_content_size=False).compress
        else:
            self.size = zstandard.ZstdCompressor(level=LEVEL, write_checksum=False, write_content_size=False).compress

    def __call__(self, text: str, start: int, end: int) -> float:
        value = text[start:end]
        # repeats may begin or end outside the context
        left, right = max(0, start - CONTEXT), end + CONTEXT
        before = _without(value, text, max(0, left - len(value)), start, left, start)
        after = _without(value, text, end, right + len(value), end, right)
        around = (before + "\n" + after).encode("utf-8", "surrogatepass")
        return (len(self.size(around + value.encode())) - len(self.size(around))) / len(value)


def _without(value: str, text: str, low: int, high: int, start: int, end: int) -> str:
    """text[start:end] with the occurrences of ``value`` in text[low:high] blanked out, also without its ``name=``."""
    piece = text[low:high]
    for part in [value, *(p for p in value.split("=") if len(p) >= LEAST_REPEAT)]:
        piece = piece.replace(part, "\n" * len(part))
    return piece[start - low : end - low]


def least_novelty(value: str, threshold: float = NOVELTY) -> float:
    """Bound of a candidate: ``threshold`` by the bits of a character of its alphabet, for alphabets without words."""
    symbols = next((n for digits, n in NUMERALS if digits.fullmatch(value)), SYMBOLS)
    return threshold * math.log2(symbols) / math.log2(SYMBOLS)


def all_spans(text: str, novelty: Novelty, threshold: float = NOVELTY) -> tuple[list[Span], list[Span]]:
    """Base spans, and these with the novel ones, by start then kind."""
    base = base_spans(text)
    new = [
        (s, e, "novel")
        for s, e in sensitive_candidates(text)
        if not any(s < end and start < e for start, end, _ in base) and novelty(text, s, e) >= least_novelty(text[s:e], threshold)
    ]
    rank = {k: i for i, k in enumerate([*KINDS, "novel"])}
    return base, sorted(base + new, key=lambda x: (x[0], rank[x[2]], x[1]))


def _texts(column: pa.Array) -> Iterator[str]:
    for value in column:
        yield value.as_py() or ""


def learnt_words(text: str) -> set[str]:
    """Identifiers around the sensitive words of ``text`` that may be dictionary words.

    A run that is long enough for a candidate gives the words inside it; one
    that is a single word counts only where it is no candidate.
    """
    found: set[str] = set()
    candidates = end = None
    for m in SENSITIVE.finditer(text):
        if candidates is None:
            candidates, end = dict(sensitive_candidates(text)), 0
        start, end = max(end, m.start() - CONTEXT), max(end, m.end() + CONTEXT)
        # a run is looked at whole
        while start and start < len(text) and VALUE.match(text, start) and VALUE.match(text, start - 1):
            start -= 1
        last = start
        for run in CANDIDATE.finditer(text, start):
            if run.start() >= end:
                break
            found.update(IDENTIFIER.findall(text[last : run.start()]))
            last = run.end()
            parts = PART.findall(run[0])
            if parts == [run[0]]:
                if run.start() not in candidates:
                    found.add(run[0])
            else:
                found.update(p for p in parts if PART_LETTERS[0] <= len(p) <= PART_LETTERS[1])
        found.update(IDENTIFIER.findall(text[last:end]) if last < end else ())
        end = max(end, last)
    return {w for w in found if len(w) <= WORD_CHARS}


def identifier_dictionary(docs: DataFrame, words: int = DICTIONARY_WORDS) -> list[str]:
    """Identifiers around sensitive words in most of the distinct texts of ``docs``, ties by name."""

    def around(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: dict[bytes, list[str]] = {}
            for text in _texts(batch.column(0)):
                if SENSITIVE.search(text):
                    key = hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=16).digest()
                    if key not in found:
                        found[key] = sorted(learnt_words(text))
            yield pa.RecordBatch.from_pydict({"text": pa.array(found.keys(), pa.binary()), "words": pa.array(found.values(), pa.list_(pa.string()))})

    # copies of a text count once
    texts = docs.select("text").mapInArrow(around, "text binary, words array<string>").groupBy("text").agg(F.first("words").alias("words"))
    counted = texts.select(F.explode("words").alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    # a word that is seen in one text is no dictionary word, and may be a secret
    return [r["word"] for r in counted.where("n > 1").orderBy(F.desc("n"), "word").limit(words).collect()]


SPANS = "array<struct<start:int,end:int,kind:string,value:string>>"


def scan_secrets(docs: DataFrame, id_column: str = "doc_id", words: int = DICTIONARY_WORDS, threshold: float = NOVELTY) -> DataFrame:
    """doc_id, ``base`` and ``spans`` (base and novel): arrays of start, end, kind, value.

    Places are code points, end exclusive; an ``assign`` span is the assigned
    value. Null and empty texts have no spans; repeated rows are scanned
    each; ids may be null or repeated. Other columns are not read. No rows give none.
    """
    dictionary = identifier_dictionary(docs, words)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        novelty = Novelty(dictionary)
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string()), ("value", pa.string())]))
        for batch in batches:
            out: tuple[list, list] = ([], [])
            for text in _texts(batch.column(1)):
                for column, spans in zip(out, all_spans(text, novelty, threshold), strict=True):
                    column.append([{"start": s, "end": e, "kind": k, "value": text[s:e]} for s, e, k in spans])
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, kind) for c in out)], [id_column, "base", "spans"])

    return docs.select(id_column, "text").mapInArrow(scan, f"{id_column} {dict(docs.dtypes)[id_column]}, base {SPANS}, spans {SPANS}")


def redact_secrets(docs: DataFrame, words: int = DICTIONARY_WORDS, threshold: float = NOVELTY, mark: str = "<secret>") -> DataFrame:
    """``docs`` with every span replaced by ``mark``; other columns and texts without spans are as before (n_chars follows the text)."""
    dictionary = identifier_dictionary(docs, words)
    at = docs.columns.index("text")

    def redact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        novelty = Novelty(dictionary)
        for batch in batches:
            texts = []
            for value in batch.column(at):
                text = value.as_py()
                parts, last = [], 0
                for s, e, _ in all_spans(text, novelty, threshold)[1] if text else ():
                    if s >= last:
                        parts += [text[last:s], mark]
                    last = max(last, e)
                texts.append("".join(parts) + text[last:] if parts else text)
            yield batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))

    out = docs.mapInArrow(redact, docs.schema)
    return out.withColumn("n_chars", F.length("text").cast(dict(docs.dtypes)["n_chars"])) if "n_chars" in docs.columns else out


def _joined(column: str):
    return F.array_join(F.transform(column, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def op3_secret_scan(spark, sf_dir: str) -> DataFrame:
    found = scan_secrets(documents(spark, sf_dir))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    return found.select("doc_id", *map(count, KINDS), F.sha2(_joined("base").cast("binary"), 256).alias("base_sha256"), _joined("spans").alias("spans"))
