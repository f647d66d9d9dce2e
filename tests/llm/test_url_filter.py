import random
import re

from hourloom.llm.url_filter import Cascade, filter_urls, hosts_with_words, rule_table
from pyspark.sql import functions as F

RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/"), ("block", "b.org", "")]


def brute(url):
    m = re.search(r"://([^/?#]*)([^?#]*)", url or "")
    host, path = (m[1], m[2]) if m else ("", "")
    host = host.translate({i: i + 32 for i in range(65, 91)})
    fits = [(len(h + p), v, h + p) for v, h, p in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    if fits:
        _, verdict, rule = max(fits)
        return host, path, rule, verdict
    return host, path, None, "block" if re.search(r"(^|[.-])(spam|casino)([.-]|$)", host) else "allow"


def urls():
    rng = random.Random(3)
    hosts = ["example.com", "WWW.Example.com", "a.www.example.com", "xexample.com", "com", ".com", "x.net", "net", "NET", "spam-farm.org", "my.casino", "spammer.org", "", "b.org", "a.b.org", "É.com", "x.net.", "a..com", "user@x.net:80"]
    paths = ["", "/", "/en", "/en/", "/en/x", "/es/", "/fr/1?en/", "/EN/", "?/es/", "#/fr/", "/es/\n", "/fr/http://example.com/en/", "//"]
    out = [f"{rng.choice(['http', '', 'x', 'a b'])}://{h}{p}{rng.choice(['', '?q=1', '#t'])}" for h in hosts for p in paths]
    return [*out, None, "", "no scheme/en/", "http:/x", "://", "a://b://net/es/", *out[:20]]


def test_verdicts_equal_brute_force(spark):
    rows = list(enumerate(urls()))
    pages = spark.createDataFrame([(i, u, "k") for i, u in rows] + [(None, "http://x.net/es/", "z")], "page_id long, url string, host string").repartition(5)
    out = filter_urls(pages, rule_table(spark, RULES), hosts_with_words(pages, ["spam", "casino"]))
    assert out.columns == ["page_id", "url", "host", "_host", "_path", "_rule", "_verdict"]
    got = {r.page_id: (r._host, r._path, r._rule, r._verdict) for r in out.collect()}
    assert got.pop(None) == brute("http://x.net/es/")
    assert got == {i: brute(u) for i, u in rows}


def test_cascade_is_exact_over_its_universe(spark):
    keys = spark.range(20_000).select(F.concat(F.lit("host"), "id").alias("key"))
    listed = keys.filter("pmod(xxhash64(key), 7) = 0")
    cascade = Cascade(keys.union(keys.limit(10)), listed)
    assert len(cascade.levels) >= 3
    wrong = keys.withColumn("got", cascade.contains(F.col("key"))).filter("got != (pmod(xxhash64(key), 7) = 0)")
    assert wrong.count() == 0


def test_empty_inputs(spark):
    none = spark.createDataFrame([], "page_id long, url string")
    assert filter_urls(none, rule_table(spark, RULES), hosts_with_words(none, ["spam"])).count() == 0
    some = spark.createDataFrame([(1, "http://a.net/es/")], none.schema)
    row = filter_urls(some, rule_table(spark, []), hosts_with_words(some, ["spam"])).first()
    assert (row._host, row._rule, row._verdict) == ("a.net", None, "allow")


def test_columns_with_clashing_names_stay(spark):
    rows = [(1, "http://a.com/x", "k", 2, "h"), (1, "http://a.com/x", "k", 2, "h"), (2, None, "l", 3, "i")]
    pages = spark.createDataFrame(rows, "page_id long, url string, _keys string, _fitting int, _host string")
    rules = rule_table(spark, [("block", "com", "/")])
    out = filter_urls(pages, rules, spark.createDataFrame([], "key string"))
    got = sorted((r["page_id"], r["_keys"], r["_fitting"], r["_host"], r["_verdict"]) for r in out.collect())
    assert got == [(1, "k", 2, "a.com", "block")] * 2 + [(2, "l", 3, "", "allow")]
