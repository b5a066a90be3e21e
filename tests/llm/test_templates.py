"""URL templates of nodes with very many children, and of deep paths."""

import random
import re
from collections import defaultdict

import pytest

from pontualis.llm import url_templates


@pytest.mark.parametrize("others", [60, 150])
def test_a_rare_blocked_branch_stays_apart(spark, others):
    """Unlabelled siblings do not take the verdict of a rare branch, however many they are."""
    rules = [("block", "h.com", "/de/"), ("allow", "h.com", "/fr/")]
    urls = [f"http://h.com/de/{i}" for i in range(10)] + [f"http://h.com/fr/{i}" for i in range(200)]
    urls += [f"http://h.com/part{chr(97 + k // 26)}{chr(97 + k % 26)}/{i}" for k in range(others) for i in range(30)]
    urls += [f"http://k.com/de{i}" for i in range(3)]
    more = [("block", "z.net", "/")]
    urls += [f"http://z.net/{i}" for i in range(100)]
    frame = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string")
    got = url_templates.judge_urls(frame, rules + more).collect()
    assert {r.verdict for r in got if r.host == "h.com" and r.rule is None} == {"allow"}
    assert {r.template for r in got if r.rule == "h.com/de/"} == {"/de/*"}


def test_branches_below_the_sixth_segment_are_told_apart(spark):
    rules = [("block", "h.net", "/a/b/c/d/e/f/bad/1"), ("allow", "h.net", "/a/b/c/d/e/f/good/")]
    urls = [f"http://h.net/a/b/c/d/e/f/bad/1{i}" for i in range(40)] + ["http://h.net/a/b/c/d/e/f/bad/77"]
    urls += [f"http://h.net/a/b/c/d/e/f/good/{i}" for i in range(40)]
    frame = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string")
    got = {r.page_id: r for r in url_templates.judge_urls(frame, rules).collect()}
    assert got[40].rule is None and got[40].verdict == "block" and got[50].verdict == "allow"
    assert got[0].template != got[50].template


def test_unlabelled_pages_do_not_take_the_verdict_of_the_only_labelled_branch(spark):
    rules = [("block", "h.com", "/de/")]
    urls = [f"http://h.com/de/{i}" for i in range(10)] + [f"http://h.com/en/{i}" for i in range(500)]
    # One shape, of which a tenth is blocked by the beginning of a number.
    rules.append(("block", "n.org", "/x/1"))
    urls += [f"http://n.org/x/{i}" for i in range(2000, 2090)] + [f"http://n.org/x/{i}" for i in range(100, 110)]
    frame = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string")
    got = url_templates.judge_urls(frame, rules).collect()
    assert {r.template for r in got if r.path.startswith("/en/")}.isdisjoint(
        {r.template for r in got if r.path.startswith("/de/")})
    allowed = [("allow", "a.org", "/")]
    more = urls + [f"http://a.org/{i}" for i in range(100)]
    frame = spark.createDataFrame(list(enumerate(more)), "page_id bigint, url string")
    got = url_templates.judge_urls(frame, rules + allowed).collect()
    assert {r.verdict for r in got if r.path.startswith(("/en/", "/x/2"))} == {"allow"}


def brute_force(urls, rules):
    """Host, path and template of every URL, its purity and verdict, from plain dictionaries."""
    def parts(url):
        rest = url.split("://", 1)[1]
        host, _, path = rest.partition("/")
        return host, "/" + path

    def general(segment):
        if re.search(url_templates._NUMBER, segment):
            return "*" + (re.search(r"\.[A-Za-z]{1,5}$", segment) or [""])[0]
        return "*" if re.search(url_templates._OPAQUE, segment) else segment

    def ruled(host, path):
        fits = [(len(h + p), v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
        return max(fits)[1] if fits else None

    rows = [(*parts(u), ruled(*parts(u))) for u in urls]
    counts = defaultdict(lambda: [0, 0, 0])
    for host, path, verdict in rows:
        c = counts[host, tuple(map(general, path.split("/")))]
        c[0] += 1
        c[1] += verdict is not None
        c[2] += verdict == "block"
    template = {}

    def walk(host, shapes, prefix, level):
        ended = [s for s in shapes if len(s) <= level]
        for s in ended:
            template[host, s] = prefix
        shapes = [s for s in shapes if len(s) > level]
        if len(shapes) == 1:
            template[host, shapes[0]] = prefix + "/*" * (len(shapes[0]) - level)
            return
        total = [sum(counts[host, s][i] for s in shapes) for i in (0, 1, 2)]
        children, branches = defaultdict(list), defaultdict(list)
        for s in shapes:
            children[s[level]].append(s)
        for segment, own in children.items():
            n, k = (sum(counts[host, s][i] for s in own) for i in (1, 2))
            others, hit = total[1] - n, total[2] - k
            if n == 0:
                name = "*?"
            elif min(n, others) < url_templates.LEAST:
                name = segment
            else:
                rate = (total[2] + 1) / (total[1] + 2)
                error = (rate * (1 - rate) * (1 / n + 1 / others)) ** 0.5
                name = "*#" if abs(k / n - hit / others) <= url_templates.DEVIATIONS * error else segment
            branches[name] += own
        for name, own in branches.items():
            walk(host, own, prefix + "/" + name, level + 1)

    hosts = defaultdict(list)
    for host, shape in counts:
        hosts[host].append(shape)
    for host, shapes in hosts.items():
        walk(host, shapes, "", 1)
    pooled = defaultdict(lambda: [0, 0, 0])
    for (host, shape), c in counts.items():
        pool = pooled[host, template[host, shape]]
        for i in (0, 1, 2):
            pool[i] += c[i]
    labelled, blocked = (sum(c[i] for c in counts.values()) for i in (1, 2))
    prior = blocked / max(labelled, 1)
    out = []
    for host, path, verdict in rows:
        name = template[host, tuple(map(general, path.split("/")))]
        pages, n, k = pooled[host, name]
        purity = (k + 4 * prior) / (n + 4) if n >= pages / 2 else prior
        out.append((host, path, name, round(purity, 6), verdict or ("block" if round(purity, 6) >= 0.8 else "allow")))
    return out


def test_tree_equals_brute_force(spark):
    rng = random.Random(6)
    rules = [("block", "a.net", "/ads"), ("allow", "a.net", "/news"), ("block", "b.net", "/x/b"),
             ("allow", "b.net", "/x/"), ("block", "c.net", "/")]
    segments = ["ads", "news", "adsx", "newsy", "x", "bad", "good", "1", "22.html", "p", "q", ""]
    urls = [f"http://{rng.choice('abcd')}.net" + "".join("/" + rng.choice(segments) for _ in range(rng.randint(1, 5)))
            for _ in range(3000)]
    frame = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string").repartition(4)
    got = url_templates.judge_urls(frame, rules).orderBy("page_id").collect()
    assert [(r.host, r.path, r.template, r.purity, r.verdict) for r in got] == brute_force(urls, rules)
    assert len({r.template for r in got}) > 50
