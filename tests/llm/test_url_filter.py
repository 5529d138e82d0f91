import re

from pyspark.sql import functions as F

from tripflow.llm import url_filter as u


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.split(r"[/?#]", rest, maxsplit=1)[0]
    return re.sub("[A-Z]", lambda m: m.group().lower(), host), re.split(r"[?#]", rest[len(host):], maxsplit=1)[0]


def rule(host, path, rules):
    fits = [(len(r), a, r) for a, r in rules if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0]))
            and path.startswith(r[r.index("/"):])]
    return max(fits)[1:] if fits else (None, None)


URLS = [None, "", "no scheme", "http://", "HTTP://WWW.Example.COM/en/a?x#y", "http://example.com/EN/", "ftp://a.b.example.com/en/q",
        "x://com/", "http://com", "http://xcom/", "http://a.net/es/1", "http://a.net/es", "http://a.net?u=/es/", "http://Ä.net/fr/",
        "http://a.org/1://net/es/", "\n://n\n.net/fr/\n", "http://www.example.com/de/", "http://notexample.com/en/"]


def test_rules_match_brute_force(spark):
    pages = spark.createDataFrame(list(enumerate(URLS)) + [(4, URLS[4])], "page_id long, url string") \
        .withColumn("html", F.lit(None).cast("string")).withColumn("host", F.lit("clash"))
    got = u.judge_urls(pages).collect()
    assert len(got) == len(URLS) + 1
    for r in got:
        host, path = parts(URLS[r.page_id])
        action, name = rule(host, path, u.RULES)
        assert (r.host, r.path, r.rule) == (host, path, name), URLS[r.page_id]
        assert r.verdict == action if action else r.verdict in ("allow", "block")


def test_block_wins_between_equal_rules(spark):
    pages = spark.createDataFrame([(1, "http://a.b/c", None)], "page_id long, url string, html string")
    assert u.judge_urls(pages, [("block", "a.b/"), ("allow", "a.b/")]).first().verdict == "block"
    assert u.judge_urls(pages, []).first().verdict == "allow"


def brute_rank(edges, seeds, turns=200):
    nodes = sorted({x for e in edges for x in e[:2]} | set(seeds))
    out = {n: sum(w for s, _, w in edges if s == n) for n in nodes}
    r = {n: seeds.get(n, 0.0) for n in nodes}
    for _ in range(turns):
        idle = sum(r[n] for n in nodes if not out[n])
        got = {n: sum(r[s] * w / out[s] for s, d, w in edges if d == n) for n in nodes}
        r = {n: (1 - u.DAMPING) * seeds.get(n, 0.0) + u.DAMPING * (got[n] + idle * seeds.get(n, 0.0)) for n in nodes}
    return r


def test_ranks_match_power_iteration(spark):
    edges = [("a", "b", 1.0), ("b", "c", 2.0), ("b", "a", 1.0), ("c", "d", 1.0), ("x", "y", 1.0), ("hub", "a", 1.0), ("a", "hub", 3.0)]
    seeds = {"a": 0.7, "x": 0.3}
    got = u.propagate(spark.createDataFrame([("k", *e) for e in edges], "kind string, src string, dst string, weight double"),
                      spark.createDataFrame([("k", h, s) for h, s in seeds.items()], "kind string, host string, seed double"),
                      tolerance=1e-9, max_turns=80)
    want = brute_rank(edges, seeds)
    assert {r.host for r in got.collect()} == set(want)
    assert all(abs(r["rank"] - want[r.host]) < 1e-6 for r in got.collect())


def test_hosts_that_link_to_blocked_hosts_are_blocked(spark):
    link = lambda h: f'<A HREF = "https://{h}/p">x</a> <img src=//{h}:80/i> <a href="/own">y</a>'
    pages = [(k, f"http://bad.net/es/{k}", None) for k in range(30)]
    pages += [(100, "http://farm.org/", link("bad.net")), (101, "http://clean.org/", link("good.com")), (102, "http://clean.org/2", None),
              (103, "http://bad.net/other", None)]
    pages += [(200 + k, f"http://good.com/{k}", link("good.com")) for k in range(30)]
    got = {r.page_id: r for r in u.judge_urls(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert got[100].verdict == "block" and got[100].rule is None
    assert got[101].verdict == "allow" and got[101].distrust_rate == 0
    assert got[103].verdict == "block" and got[103].rule is None
    assert all(got[200 + k].verdict == "allow" for k in range(30))


def test_no_rows(spark):
    assert u.judge_urls(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def brute_verdicts(pages):
    """{host: verdict} of hosts, by power iteration to its limit."""
    judged = [(*parts(url), html) for url, html in pages]
    judged = [(h, rule(h, p, u.RULES)[0], html) for h, p, html in judged]
    count = {h: sum(x[0] == h for x in judged) for h, _, _ in judged}
    weight = {}
    for h, _, html in judged:
        for target in re.findall(u._LINK, html or ""):
            e = (h, target.lower())
            weight[e] = weight.get(e, 0) + 1
    for h in count:
        parent = h.partition(".")[2]
        if h and parent in count and parent:
            for e in ((h, parent), (parent, h)):
                weight[e] = weight.get(e, 0) + 1
    edges = [(a, b, w) for (a, b), w in weight.items() if a and b and a != b]
    rates = {}
    for kind, own in (("allow", edges), ("block", [(b, a, w) for a, b, w in edges])):
        seeds = {h: sum(x[:2] == (h, kind) for x in judged) for h in count}
        total = sum(seeds.values())
        rank = brute_rank(own, {h: n / total for h, n in seeds.items() if n}) if total else {}
        rates[kind] = {h: rank.get(h, 0.0) * total / count[h] for h in count}
    return {h: "block" if rates["block"][h] >= u.MIN_DISTRUST and rates["block"][h] > rates["allow"][h] else "allow"
            for h in count}, rates


def test_verdicts_at_the_settings_of_the_query(spark):
    """Chains of links behind blocked and allowed pages, with very different numbers of pages."""
    link = lambda *hosts: "".join(f'<a href="http://{h}/x">' for h in hosts)
    pages = [(f"http://seed.net/fr/{k}", link("c0.org") if k % 3 else None) for k in range(60)]
    pages += [(f"http://c{k}.org/", link(f"c{k + 1}.org", "seed.net")) for k in range(12)]
    pages += [(f"http://d{k}.org/", link(f"d{k + 1}.org" if k < 19 else "seed.net")) for k in range(20)]
    pages += [("http://a.com/1", link("d3.org", "c1.org"))] * 9 + [("http://example.com/en/1", link("d5.org"))] * 5
    pages += [(None, link("d1.org")), ("x", None), ("http://sub.seed.net/", None), ("http://" + "long." * 2000 + "org/" + "p" * 50_000, None)]
    want, rates = brute_verdicts(pages)
    got = u.judge_urls(spark.createDataFrame([(k, *p) for k, p in enumerate(pages)], "page_id long, url string, html string")).collect()
    near = 0
    for r in got:
        host, path = parts(pages[r.page_id][0])
        assert r.verdict == (rule(host, path, u.RULES)[0] or want[host]), (host, r)
        for kind, rate in (("allow", r.trust_rate), ("block", r.distrust_rate)):
            assert abs(rate - rates[kind][host]) <= u.RATE_TOLERANCE
        near += rates["block"][host] > 0
    assert len(got) == len(pages) and near > 60 and {"block", "allow"} == set(want.values())
