import re

from pyspark.sql import functions as F

from topicframe.llm.chat import rotate_perspectives
from topicframe.llm.url_filter import ENTRY_SCHEMA, RULES, blocked_bloom, filter_urls, op9_url_filter

TURNS = "conv_id long, turn long, role string, text string, position string"


def render(turns, me):
    out, masks = "", []
    for _, role, text in sorted(turns, key=lambda t: (t[0] is not None, t[0] or 0, t[1] or "unknown", t[2] or "")):
        role, text = role or "unknown", text or ""
        kind = "system" if role == "system" else "assistant" if role == me else "user"
        name = f" name={role}" if kind == "user" else ""
        head = f"<|im_start|>{kind}{name}\n"
        if kind == "assistant":
            masks.append((len(out) + len(head), len(out) + len(head) + len(text) + len("<|im_end|>")))
        out += head + text + "<|im_end|>\n"
    return out, masks


def test_perspectives_equal_a_plain_rendering(spark):
    rows = [(1, 0, "system", "be kind"), (1, 1, "ann", "hi"), (1, 2, "bob", None), (1, 2, "ann", "été"), (1, 3, None, "?"), (1, None, "bob", "first"),
            (2, 0, "system", "alone"), (None, 0, "ann", "x"), (3, 5, "ann", "twice"), (3, 5, "ann", "twice")] + [(4, t, "ab"[t % 2], f"t{t}") for t in range(600)]
    got = rotate_perspectives(spark.createDataFrame([(*r, "clash") for r in rows], TURNS)).collect()
    convs = {}
    for c, t, r, x in rows:
        convs.setdefault(c, []).append((t, r, x))
    seen = {}
    for r in got:
        seen.setdefault((r["conv_id"], r["perspective"]), []).append(r)
    assert set(seen) == {(c, r or "unknown") for c, t, r, x in rows if r != "system"}
    for (c, me), segments in seen.items():
        segments.sort(key=lambda r: r["position"])
        text, masks = render(convs[c], me)
        assert "".join(r["segment"] for r in segments) == text
        assert [r["position"] for r in segments] == list(range(len(segments)))
        assert all(text[r["seg_start"] : r["seg_end"]] == r["segment"] for r in segments)
        assert [(r["mask_start"], r["mask_end"]) for r in segments if r["mask_start"] is not None] == masks


def test_no_turns(spark):
    assert rotate_perspectives(spark.createDataFrame([], TURNS)).count() == 0


def judge(url, entries):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = re.sub("[A-Z]+", lambda m: m[0].lower(), host)
    fit = [(n, len(h + p), h + p, v) for h, p, v, n in entries if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fit, default=None)
    return host, path, best[2] if best and best[0] else None, best[3] if best else "allow"


URLS = ["http://A.example.com/en/1", "https://www.example.com/en/x?y#z", "http://x.net/es/", "http://x.net/es", "http://example.com", "no scheme/en/", None, "",
        "http://net/fr/a", "http://éx.NET/fr/É?q", "ftp://spam.org/a", "http://notspam.org/a", "http://x.spam.org/a#b", "http://com/", "x://a://b.com/", "http://x.net/es/"]


def test_rules_equal_brute_force(spark):
    entries = RULES + [("spam.org", "/", "block", False)]
    pages = spark.createDataFrame([(k, u, "x", "y") for k, u in enumerate(URLS)], "page_id long, url string, hit string, verdict string")
    got = filter_urls(pages, spark.createDataFrame(entries, ENTRY_SCHEMA))
    assert set(got.columns) == {"page_id", "url", "hit", "host", "path", "rule", "verdict"}
    assert {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in got.collect()} == {k: judge(u, entries) for k, u in enumerate(URLS)}


def test_a_crowded_filter_is_made_exact_by_the_join(spark):
    entries = [(f"h{k}.org", f"/{'d' * (k % 5)}/", "block", False) for k in range(3000)]
    listed = spark.createDataFrame(entries, ENTRY_SCHEMA)
    keys = spark.range(20_000).select(F.concat(F.lit("z"), "id").alias("key"))
    bloom = blocked_bloom(listed.select(F.concat("host", "path").alias("key")), "key", 16)
    assert bloom.count() == 16 and keys.count()
    urls = [f"http://h{k}.org/{'d' * (k % 7)}/x" for k in range(0, 6000, 3)]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {r["page_id"]: r["verdict"] for r in filter_urls(pages, listed, max_blocks=16).collect()}
    known = {h + p for h, p, *_ in entries}
    want = {k: "block" if any(f"{u[7:].split('/')[0]}/{'d' * n}/" in known and u[7:].split("/", 1)[1].startswith("d" * n + "/") for n in range(5)) else "allow" for k, u in enumerate(urls)}
    assert got == want and "block" in want.values() and "allow" in want.values()


def test_empty_list_and_empty_pages(spark):
    none = spark.createDataFrame([], ENTRY_SCHEMA)
    pages = spark.createDataFrame([(1, "http://a.com/")], "page_id long, url string")
    assert filter_urls(pages, none).first()["verdict"] == "allow"
    assert filter_urls(pages.limit(0), spark.createDataFrame(RULES, ENTRY_SCHEMA)).count() == 0


def test_main_path_has_no_python(spark):
    plan = op9_url_filter(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
