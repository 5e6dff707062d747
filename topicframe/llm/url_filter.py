"""URL filter: a blocked Bloom filter of listed canonical URLs, then an exact hash join.

A list entry is (host, path, verdict): it covers its host and all
subdomains, for paths that start with the entry's path. The entries that
can cover a URL are its host's suffixes, each with the path's starts of the
lengths that occur in the list; these keys are looked up.

1. The filter is a table of 64-bit blocks: a key sets ``BITS`` bits of the
   one block that its hash names. Its number of blocks is a parameter
   (``max_blocks``), so it can be broadcast whatever the list's size; a long
   list only lets more keys pass.
2. Keys that pass are joined with the list on the whole key, which removes
   the filter's false positives. Spark picks broadcast or shuffle by size
   and splits hot keys.
3. The longest covering entry decides; entries with ``named`` true come
   before others.

Everything is built of DataFrame functions. Each distinct (host, path) is
looked up once, so a URL that fills a third of the table is one lookup.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from topicframe.llm.common import fresh_name

BITS = 4
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

ENTRY_SCHEMA = "host string, path string, verdict string, named boolean"


def host_and_path(url: str) -> tuple[Column, Column]:
    """Host and path of a URL column; both empty for null or without ``://``."""
    name = "`" + url.replace("`", "``") + "`"
    rest = F.coalesce(F.expr(f"if(instr({name}, '://') > 0, substring({name}, instr({name}, '://') + 3), '')"), F.lit(""))
    host = F.regexp_extract(rest, "^([^/?#]*)", 1)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return F.translate(host, UPPER, LOWER), path


def _block(key: Column, n_blocks: int) -> Column:
    return F.pmod(F.xxhash64(F.lit("block"), key), F.lit(n_blocks))


def _mask(key: Column) -> Column:
    h = F.xxhash64(F.lit("bits"), key)
    mask = F.lit(0).cast("bigint")
    for i in range(BITS):
        mask = mask.bitwiseOR(_bit(h, i))
    return mask


def _bit(h: Column, i: int) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), F.shiftrightunsigned(h, 6 * i).bitwiseAND(F.lit(63)).cast("int"))


def blocked_bloom(keys: DataFrame, key: str, n_blocks: int) -> DataFrame:
    """The filter of a column of keys: ``block`` (below ``n_blocks``) and its 64-bit ``word``."""
    return keys.groupBy(_block(F.col(key), n_blocks).alias("block")).agg(F.bit_or(_mask(F.col(key))).alias("word"))


def filter_urls(
    pages: DataFrame,
    entries: DataFrame,
    url: str = "url",
    max_blocks: int = 1 << 17,
    entries_per_block: int = 4,
    default: str = "allow",
) -> DataFrame:
    """``pages`` with host, path, rule and verdict.

    ``entries``: host, path, verdict, named. ``rule`` is host and path of the
    deciding entry if it is named, else null; ``verdict`` is that entry's, or
    ``default`` where none covers the URL. The filter has at most
    ``max_blocks`` blocks of 8 bytes.

    Null URLs and those without ``://`` get empty host and path and the
    default. Repeated pages stay. Entries without a host cover nothing; of
    equal entries with different verdicts "block" wins. An empty list gives
    the default everywhere. Columns of ``pages`` that are named like the new
    ones are replaced.
    """
    text = F.coalesce(F.col("path"), F.lit(""))
    listed = (
        entries.where(F.coalesce(F.col("host"), F.lit("")) != "")
        .select(
            F.concat(F.translate("host", UPPER, LOWER), text).alias("key"),
            F.size(F.split("host", r"\.")).alias("labels"),
            F.length(text).alias("path_length"),
            "verdict",
            F.coalesce(F.col("named"), F.lit(False)).alias("named"),
        )
        .groupBy("key", "named")
        .agg(F.max("verdict").alias("verdict"), F.max("labels").alias("labels"), F.max("path_length").alias("path_length"))
    )
    shape = listed.agg(F.count("*").alias("n"), F.max("labels").alias("labels"), F.collect_set("path_length").alias("lengths")).first()
    n_blocks = min(max_blocks, 1 << max(0, (shape["n"] // entries_per_block)).bit_length())

    own_host, own_path = host_and_path(url)
    pages = pages.drop("host", "path", "rule", "verdict").withColumns({"host": own_host, "path": own_path})
    if not shape["n"]:
        return pages.withColumns({"rule": F.lit(None).cast("string"), "verdict": F.lit(default)})
    labels = F.split("host", r"\.")
    lengths = F.array(*[F.lit(n) for n in sorted(shape["lengths"])])
    first = F.greatest(F.lit(1), F.size(labels) - shape["labels"] + 1)
    suffixes = F.transform(F.sequence(first, F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    starts = F.transform(F.filter(lengths, lambda n: n <= F.length("path")), lambda n: F.left(F.col("path"), n))
    keys = F.flatten(F.transform(suffixes, lambda h: F.transform(starts, lambda p: F.concat(h, p))))
    wanted = pages.select("host", "path").where("host != ''").distinct().select("host", "path", F.explode(keys).alias("key"))

    bloom = F.broadcast(blocked_bloom(listed, "key", n_blocks))  # at most n_blocks rows
    passed = (
        wanted.withColumn("block", _block(F.col("key"), n_blocks))
        .join(bloom, "block")
        .where(F.col("word").bitwiseAND(_mask(F.col("key"))) == _mask(F.col("key")))
        .select("host", "path", "key")
    )
    hits = passed.join(listed.select("key", "named", "verdict"), "key")
    best = F.max_by(F.struct("key", "named", "verdict"), F.struct("named", F.length("key"), "key"))
    found = hits.groupBy("host", "path").agg(best.alias(hit := fresh_name(pages, "hit")))
    out = pages.join(found, ["host", "path"], "left")
    return out.withColumns(
        {"rule": F.when(F.col(f"{hit}.named"), F.col(f"{hit}.key")), "verdict": F.coalesce(F.col(f"{hit}.verdict"), F.lit(default))}
    ).drop(hit)


#: The named rules of the query, and hosts that it blocks where no rule fits.
RULES = [
    ("com", "/", "allow", True),
    ("example.com", "/en/", "block", True),
    ("www.example.com", "/en/", "allow", True),
    ("net", "/es/", "block", True),
    ("net", "/fr/", "block", True),
]
LISTED_SITES = ["ads-track", "adult-x", "casino-win", "cheap-pills", "free-bets", "spam-farm"]
LISTED_HOSTS = [f"{site}.example.{top}" for site in LISTED_SITES for top in ("com", "net", "org")]


def op9_url_filter(spark, sf_dir: str) -> DataFrame:
    entries = spark.createDataFrame(RULES + [(h, "/", "block", False) for h in LISTED_HOSTS], ENTRY_SCHEMA)
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    return filter_urls(pages, entries).select("page_id", "host", "path", "rule", "verdict")


_VALUES = ", ".join(f"('{h}', '{p}', '{v}', {int(n)})" for h, p, v, n in RULES + [(h, "/", "block", False) for h in LISTED_HOSTS])
OP9_SQL = f"""
WITH entries(h, p, v, named) AS (VALUES {_VALUES}),
u AS (SELECT page_id, row_number() OVER () AS n,
             CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
w AS (SELECT page_id, n, translate(regexp_extract(rest, '^([^/?#]*)', 1), '{UPPER}', '{LOWER}') AS host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
d AS (SELECT w.n, arg_max(struct_pack(k := h || p, v := v, named := named), named * 100000 + length(h || p)) AS best
      FROM w JOIN entries ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY w.n)
SELECT page_id, host, path, CASE WHEN best.named = 1 THEN best.k END AS rule, coalesce(best.v, 'allow') AS verdict
FROM w LEFT JOIN d USING (n)
"""
