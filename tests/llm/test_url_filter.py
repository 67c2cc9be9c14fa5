import re

from pyspark.sql import functions as F

from millrace.llm import queries, url_filter
from tests.conftest import SMALL

URLS = [
    "http://a.net/x", "https://NET/", "http://net", "http://x.example.net/en/1", "http://example.net/en", "https://b.example.com/de/9?x#y",
    "http://example.com/fr/", "http://x.org/fr/1", "http://xorg/fr/1", "http://u@h.org:80/fr/?q", "x://y://z.net/", "://net/a", None, "",
    "no scheme", "http://", "http:///en/", "http://a.net?x=/", "http://a.net#/", "HTTP://ÄÖ.Net/É\n/x", "a\nb://c.net/d", "http://a.net/x",
]


def brute(url):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (re.sub("[A-Z]", lambda x: x[0].lower(), m[1]), m[2]) if m else ("", "")
    fitting = [
        (len(h) + len(p), h + p, what) for what, h, p in queries.URL_RULES
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    return host, path, max(fitting)[1:] if fitting else (None, None)


def test_rules_and_parts(spark):
    rows = spark.createDataFrame([(i, u, 5) for i, u in enumerate(URLS)], "page_id long, url string, rule int")
    got = url_filter.judge_urls(rows, queries.URL_RULES).collect()
    assert len(got) == len(URLS)
    for r in got:
        host, path, (rule, verdict) = brute(r["url"])
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        assert r["verdict"] == (verdict or ("block" if r["block_score"] >= 0.5 else "allow"))
    assert url_filter.judge_urls(rows.limit(0)).count() == 0


def verdicts(spark, urls, labelled=None):
    rows = spark.createDataFrame([(u,) for u in urls], "url string")
    return {r["url"]: (r["verdict"], r["block_score"]) for r in url_filter.judge_urls(rows, labelled=labelled).collect()}


def test_ordinary_and_bad_urls(spark):
    bad = [
        "https://super-casino.example.com/en/5", "http://www.pills-online.example.org/x", "http://free-casino.example.net/de/1",
        "http://www.example.com/casino-bonus/poker-bets", "https://library.example.org/xxx/casino/poker", "http://adult-x.example.com/",
    ]
    good = [
        "https://github.com/login", "https://en.wikipedia.org/wiki/Casino", "https://www.nytimes.com/sports", "https://www.bestbuy.com/",
        "https://www.northlands.example.com/en/5", "http://teaching.example.org/x", "http://m.weathers.example.net/de/1",
        "https://news.ycombinator.com/item?id=1", "https://docs.python.org/3/library/re.html", "http://kleinanzeigen.de/s-anzeige/77", None, "no scheme",
    ]
    found = verdicts(spark, bad + good)
    wrong = [u for u in bad if found[u][0] != "block"] + [u for u in good if found[u][0] != "allow"]
    # One that a table this small misjudges: nothing in it is like the host, and the path is like "xxx".
    assert wrong in ([], ["http://teaching.example.org/x"])
    assert found[None][1] == 0 and 0.01 < found["http://kleinanzeigen.de/s-anzeige/77"][1] < 0.5


def test_held_out_hosts(spark):
    """Of hosts that the model has not seen, in five folds, about nine in ten are judged as their label says."""
    rows = url_filter.labelled_rows()
    hosts = sorted({u.split("/")[2] for u, _ in rows})
    right = total = 0
    for fold in range(5):
        out = {h for i, h in enumerate(hosts) if i % 5 == fold}
        learned = [(u, n) for u, n in rows if u.split("/")[2] not in out]
        asked = [(u, n) for u, n in rows if u.split("/")[2] in out]
        found = verdicts(spark, [u for u, _ in asked], spark.createDataFrame(learned, "url string, label int"))
        right += sum(found[u][0] == ("block" if n else "allow") for u, n in asked)
        total += len(asked)
    assert right / total > 0.88


def test_the_table_is_not_made_from_the_given_hosts(spark):
    given = {re.sub(r"^(www|m|blog)\.", "", r["url"].split("/")[2]).split(".")[0] for r in spark.read.parquet(f"{SMALL}/pages.parquet").select("url").collect()}
    assert not given & {u.split("/")[2].split(".")[-2] for u, _ in url_filter.labelled_rows()}


def test_query_matches_the_rules(spark):
    urls = {r["page_id"]: r["url"] for r in spark.read.parquet(f"{SMALL}/pages.parquet").select("page_id", "url").collect()}
    got = queries.op7_url_filter(spark, SMALL).collect()
    assert len(got) == len(urls)
    for r in got:
        host, path, (rule, verdict) = brute(urls[r["page_id"]])
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule) and r["verdict"] == (verdict or r["verdict"])


def test_training_is_repeatable(spark):
    labelled = url_filter.labelled_urls(spark).unionByName(spark.createDataFrame([("http://x", None)], "url string, label int"))
    assert url_filter.train(labelled) == url_filter.train(labelled.withColumn("extra", F.lit(1)))
