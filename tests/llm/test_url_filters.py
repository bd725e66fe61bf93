import random

from paperlode.llm import url_filters as u


def plain(url, rules):
    if url is None or "://" not in url:
        return "", "", None, "allow"
    rest = url.split("://", 1)[1]
    i = next((i for i, c in enumerate(rest) if c in "/?#"), len(rest))
    host = "".join(c.lower() if c.isascii() else c for c in rest[:i])
    path = next((rest[i:j] for j in range(i, len(rest) + 1) if j == len(rest) or rest[j] in "?#"), "")
    fit = [(len(h + p), len(h), h + p, a) for a, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *(max(fit)[2:] if fit else (None, "allow")))


def test_equals_plain_rules(spark):
    r = random.Random(8)
    label = lambda: r.choice(["a", "b", "www", "example", "É"])
    host = lambda n: ".".join([*(label() for _ in range(r.randint(0, n))), r.choice(["com", "net"])])
    path = lambda: "/" + "".join(r.choice("ab/") for _ in range(r.randint(0, 5)))
    rules = {(h, p): a for a, h, p in [(r.choice(["allow", "block"]), host(2), r.choice([path, lambda: ""])()) for _ in range(60)]}
    rules = [(a, h, p) for (h, p), a in rules.items()] + u.RULES
    rules = [(a, h, p) for (h, p), a in {(h, p): a for a, h, p in rules}.items()]
    urls = [None, "", "no scheme", "http://", "http://COM", "http://com/", "x://a.com?q=://b", "http://www.example.com/en/#/", "http://.com/", "http://com./a", "HTTP://A.com:80/x\ny"]
    urls += ["http://a.com/" + "a/b" * 20_000, "http://" + "a." * 3000 + "www.example.com/en/"]  # very long ones
    urls += [f"http://{host(4)}{r.choice([path(), '', '?x=1', path() + '#f'])}" for _ in range(600)] + ["http://www.example.com/en/a"] * 60
    rows = [(i, x, "clash", 1) for i, x in enumerate(urls)] + [(None, "http://a.com/", "clash", None)]
    df = spark.createDataFrame(rows, "page_id long, url string, host string, verdict int")
    got = {x.page_id: (x.host, x.path, x.rule, x.verdict) for x in u.judge(df, u.rules_frame(spark, rules)).collect()}
    assert len(got) == len(rows)
    for i, x, *_ in rows:
        assert got[i] == plain(x, rules), x
    assert u.judge(df.limit(0), u.rules_frame(spark, rules)).count() == 0
    assert {x.verdict for x in u.judge(df, u.rules_frame(spark, rules).limit(0), default="block").collect()} == {"block"}


def test_rules_are_carried_over_ranges(spark):
    """Every range begins far below the hosts whose rules are open there."""
    rules = [("block", "com", "/a"), ("allow", "x.com", "/a/b"), ("block", "com", "/a/b/c"), ("block", "y.x.com", "")]
    urls = [f"http://{h}{i:04d}.{d}/{p}" for i in range(300) for h, d, p in (("w", "x.com", "a/b"), ("w", "com", "a"), ("w", "y.x.com", "z"), ("w", "net", "a"), ("w", "x.com", "a/b/c"))]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").repartition(5)
    got = {x.page_id: (x.host, x.path, x.rule, x.verdict) for x in u.judge(df, u.rules_frame(spark, rules)).collect()}
    assert got == {i: plain(x, rules) for i, x in enumerate(urls)}
