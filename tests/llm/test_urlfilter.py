import random
import re

import pytest

from weirgate.llm import urlfilter

CAPTURES = "id bigint, url string, time bigint"
ENTRIES = "list string, pattern string, time bigint, number int, action string"


@pytest.mark.parametrize(
    "url, patterns",
    [
        ("http://User@A.b.Example.COM:80/x/y.html?q=1#f", ["a.b.example.com", "b.example.com", "example.com", "a.b.example.com/", "a.b.example.com/x/", "a.b.example.com/x/y.html?q=1"]),
        ("https://example.com", ["example.com", "example.com/", "example.com"]),
        ("https://localhost/", ["localhost", "localhost/"]),
        ("no address", []),
        ("", []),
        (None, []),
    ],
)
def test_patterns(spark, url, patterns):
    from pyspark.sql import functions as F

    row = spark.createDataFrame([(url,)], "url string").select(urlfilter.patterns_of(F.col("url")).alias("p")).first()
    assert sorted(row.p or []) == sorted(set(patterns))


def active(entries, pattern_sets, capture):
    _, url, time = capture
    out = []
    log = {}
    for list_, pattern, at, number, action in entries:
        if None not in (list_, pattern, at) and action in ("add", "remove"):
            log.setdefault((list_, pattern), []).append((at, number, action))
    for (list_, pattern), changes in log.items():
        done = [c for c in sorted(changes) if time is not None and c[0] <= time]
        if pattern in pattern_sets.get(url, ()) and done and done[-1][2] == "add":
            out.append((list_, pattern))
    return sorted(out)


@pytest.mark.parametrize("seed, seconds", [(1, 10), (2, 1), (3, 10**6)])
def test_against_replaying_the_log(spark, seed, seconds):
    rng = random.Random(seed)
    hosts = ["a.com", "x.a.com", "b.org", "y.b.org"]
    urls = [f"http://{h}/{d}/p" for h in hosts for d in "uv"]
    entries = [
        (rng.choice(["ads", "spam"]), rng.choice([*hosts, "a.com/u/", "x.a.com/v/"]), rng.randrange(200), k, rng.choice(["add", "remove"]))
        for k in range(120)
    ]
    entries += [(None, "a.com", 1, 1, "add"), ("ads", None, 1, 1, "add"), ("ads", "a.com", None, 1, "add"), ("ads", "b.org", 5, 1, "huh")]
    captures = [(i, rng.choice(urls) if rng.random() < 0.5 else urls[0], rng.randrange(220)) for i in range(300)]
    captures += [(900, None, 5), (901, "http://a.com/", None), (902, "", 7)]
    sets = {}
    for u in urls:
        host, d = u[7:].split("/")[:2]
        parts = host.split(".")
        sets[u] = {".".join(parts[i:]) for i in range(max(1, len(parts) - 1))} | {f"{host}/", f"{host}/{d}/", f"{host}/{d}/p"}
    intervals = urlfilter.validity_intervals(spark.createDataFrame(entries, ENTRIES), seconds)
    found = {}
    for r in urlfilter.active_entries(spark.createDataFrame(captures, CAPTURES), intervals, seconds).collect():
        found.setdefault(r.id, []).append((r.list, r.pattern))
    for c in captures:
        assert sorted(found.get(c[0], [])) == active(entries, sets, c), c
    for r in intervals.collect():
        assert r.valid_to is None or r.valid_from < r.valid_to


def test_verdicts(spark):
    entries = [("ads", "a.com", 10, 1, "add"), ("ads", "a.com", 20, 1, "remove"), ("allow", "a.com/ok/", 0, 1, "add"), ("spam", "b.org", 5, 1, "remove"), ("spam", "b.org", 5, 2, "add")]
    captures = [(1, "http://a.com/x", 9), (2, "http://a.com/x", 10), (3, "http://a.com/x", 19), (4, "http://a.com/x", 20), (5, "http://www.a.com/ok/", 15), (6, "http://a.com/ok/1", 15), (7, "http://b.org", 5), (None, "http://a.com/", 15), (3, "http://a.com/x", 19)]
    rows = urlfilter.judge(spark.createDataFrame(captures, CAPTURES), spark.createDataFrame(entries, ENTRIES)).collect()
    assert len(rows) == len(captures)
    said = {r.id: r.verdict for r in rows if r.id is not None}
    assert said == {1: "unlisted", 2: "blocked", 3: "blocked", 4: "unlisted", 5: "blocked", 6: "allowed", 7: "blocked"}


def test_no_rows_and_extra_columns(spark):
    none, entries = spark.createDataFrame([], CAPTURES), spark.createDataFrame([("ads", "a.com", 1, 1, "add")], ENTRIES)
    assert urlfilter.judge(none, entries).count() == 0
    captures = spark.createDataFrame([(1, "http://a.com/", 5, "p", 3, "l")], CAPTURES + ", pattern string, slice int, list string")
    assert [r.verdict for r in urlfilter.judge(captures, spark.createDataFrame([], ENTRIES)).collect()] == ["unlisted"]
    assert [r.verdict for r in urlfilter.judge(captures, entries).collect()] == ["blocked"]


def test_no_window_over_captures(spark):
    """A host fetched a thousand times in one slice is a key of a join, whose plan orders no captures."""
    captures = spark.createDataFrame([(i, "http://a.com/", 100 + i % 7) for i in range(1000)], CAPTURES)
    entries = [("ads", "a.com", t, t, "add" if t % 2 else "remove") for t in range(95, 105)]
    intervals = urlfilter.validity_intervals(spark.createDataFrame(entries, ENTRIES))
    found = urlfilter.active_entries(captures, intervals)
    assert {r.id for r in found.collect()} == {i for i in range(1000) if i % 7 in (1, 3)}
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if re.search(r"(^|[- :+]) ?Window \[", line)]
    assert windows and not any(re.search(r"\bid#", w) for w in windows)
