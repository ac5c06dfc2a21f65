"""Top-k search, site lines and URL rules on small tables."""

import math
import random
import zlib
from collections import Counter

import duckdb
from pyspark.sql import functions as F

from storelens.llm import line_dedup, queries, topk_search, url_filter


def brute_force(rows, asked, k):
    def whole(v):
        return v and all(x is not None and math.isfinite(x) for x in v) and [math.floor(256 * x) for x in v]

    clean = {(i, tuple(whole(v))) for i, v in rows if i is not None and whole(v)}
    out = set()
    for i, q in {(i, q) for i, q in clean if i in asked}:
        near = [(-sum(a * b for a, b in zip(q, v)), j) for j, v in clean if j != i and len(v) == len(q)]
        out |= {(i, n, j, -s) for n, (s, j) in enumerate(sorted(near)[:k], 1)}
    return out


def test_top_k_with_ties_and_unusable_rows(spark):
    rows = [(n, [math.sin(n * d) for d in range(1, 9)]) for n in range(200)]
    rows += [(500 + n, rows[7][1]) for n in range(60)]  # one vector many times
    rows += [(900, None), (901, [1.0, None] * 4), (902, [float("nan")] * 8), (903, [float("inf")] * 8), (None, rows[3][1])]
    rows += [(50, rows[60][1]), (50, rows[70][1]), (60, rows[61][1])]  # one id, several vectors
    rows += [(7, rows[7][1]), (904, [1.0, 2.0]), (905, [3.0, 4.0]), (906, [])]
    frame = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<double>, rank int, score int")
    asked = {0, 7, 50, 100, 500, 900, 904}
    for tile in (16, 4096):
        found = topk_search.top_k(frame, frame.where(F.col("vec_id").isin(*asked)), 5, tile_rows=tile).collect()
        assert {tuple(r) for r in found} == brute_force(rows, asked, 5)
        assert len(found) == len(set(found))
    assert topk_search.top_k(frame.limit(0), frame, 5).isEmpty()


def test_scores_beyond_the_exact_range_of_doubles(spark):
    rows = [(n, [(n + 1) * 1e14, 3e13 - n]) for n in range(6)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = topk_search.top_k(frame, frame, 2).collect()
    assert len(found) == 12 and all(r["score"] > 0 for r in found)


def test_site_lines(spark):
    rows = [(n, f"http://Big.example/{n}", f"<p>menu</p><p>own {n}</p><p>menu</p>") for n in range(10)]
    rows += [(20, "http://small.example/1", "<p>menu</p>"), (21, None, None), (22, "no host", "<div>a<br>b</div>"), (20, None, "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", F.lit("clash"))
    found = line_dedup.drop_site_lines(pages, line_dedup.host_of(F.col("url")), line_dedup.html_lines(F.col("html"))).collect()
    got = {(r["page_id"], r["host"]): (r["n_lines"], r["n_dropped"], r["text"]) for r in found}
    assert len(found) == len(rows)
    assert got[3, "big.example"] == (3, 2, "own 3")
    assert got[20, "small.example"] == (1, 0, "menu")
    assert got[21, ""] == (0, 0, "")
    assert got[22, ""] == (2, 0, "a\nb")
    empty = line_dedup.drop_site_lines(pages.limit(0), F.col("url"), line_dedup.text_lines(F.col("html")))
    assert empty.isEmpty()


def test_site_lines_of_repeated_rows_and_at_the_ratio(spark):
    def page(n, *lines):
        return n, "http://one.example/", "".join(f"<p>{x}</p>" for x in lines)

    rows = [page(n, f"own {n}", *(["at"] * (n < 3) + ["over"] * (n < 4))) for n in range(8)]
    rows += [page(0, "own 0", "at", "over")] * 2  # ten pages in all: "own 0" and "at" on three and five of them
    rows += [page(n, "end", "three") if n < 53 else page(n, "x" * n) for n in range(50, 60)]
    rows[10:] = [(i, "http://two.example/", h) for i, _, h in rows[10:]]  # ten pages, "three" on exactly 0.3 of them
    rows += [(70, "http://long.example/", "".join(f"<p>line {n}</p>" for n in range(30_000)))]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = line_dedup.drop_site_lines(pages, line_dedup.host_of(F.col("url")), line_dedup.html_lines(F.col("html"))).collect()
    got = {r["page_id"]: (r["host_pages"], r["n_lines"], r["n_dropped"]) for r in found}
    assert got[0] == (10, 3, 2) and got[4] == (10, 1, 0) and got[50] == (10, 2, 0) and got[70] == (1, 30_000, 0)
    with duckdb.connect() as base:
        base.register("pages", pages.toPandas())
        wanted = base.sql(queries.SITE_LINES).fetchall()
    assert Counter(tuple(r) for r in found) == Counter(wanted)


def judged(rule_list, url):
    if url is None or "://" not in url:
        host = path = ""
    else:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host, path = rest[:cut].lower(), rest[cut:].split("?")[0].split("#")[0]
    fits = [r for r in rule_list if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
    best = max(fits, key=lambda r: len(r[0] + r[1]), default=None)
    return host, path, best and best[0] + best[1], best and best[2]


def test_url_rules_and_models(spark):
    urls = [f"https://www.good{n % 9}.com/news/{n}" for n in range(80)]
    urls += [f"http://bad{n % 7}.net/{'es' if n % 2 else 'fr'}/casino-{n}" for n in range(80)]
    urls += ["http://Example.com/en/x", "http://www.example.com/en/x?y#z", "http://a.example.com/en/", "http://x.com", "x.com/",
             None, "", "://", "http://com/", "ftp://net/es/", "http://notexample.com/en/?://q", "http://site.org/news/5",
             "http://site.org/casino-5", "http://x.net/de/" + "very-long/" * 3000, "http://x.net/de/ü#"]
    rows = [(n % 170, u) for n, u in enumerate(urls)] + [(3, urls[3])]
    pages = spark.createDataFrame(rows, "page_id long, url string").withColumn("verdict", F.lit("clash"))
    found = url_filter.judge_urls(pages, queries.URL_RULES).collect()
    assert len(found) == len(rows)
    wanted = {(n, *judged(queries.URL_RULES, u)) for n, u in rows}
    assert {(r["page_id"], r["host"], r["path"], r["rule"], r["verdict"] if r["rule"] else None) for r in found} == wanted
    verdict = {r["host"] + r["path"]: r["verdict"] for r in found}
    assert verdict["site.org/news/5"] == "allow" and verdict["site.org/casino-5"] == "block"
    assert url_filter.judge_urls(pages.limit(0), queries.URL_RULES).isEmpty()


def model_of(texts):
    """Counts of each context and its next character for every order."""
    seen = [{} for _ in range(url_filter.ORDER + 1)]
    for text in texts:
        signs = [url_filter.BEGIN] * url_filter.ORDER + list(text) + [url_filter.END]
        for at in range(url_filter.ORDER, len(signs)):
            for order, contexts in enumerate(seen):
                nexts = contexts.setdefault(tuple(signs[at - order:at]), {})
                nexts[signs[at]] = nexts.get(signs[at], 0) + 1
    return seen


def log_likelihood(seen, characters, text):
    signs = [url_filter.BEGIN] * url_filter.ORDER + list(text) + [url_filter.END]
    total = 0.0
    for at in range(url_filter.ORDER, len(signs)):
        p = 1 / (characters + 1)
        for order, contexts in enumerate(seen):
            nexts = contexts.get(tuple(signs[at - order:at]), {})
            n = sum(nexts.values())
            if n >= url_filter.LEAST_SEEN:
                p = (nexts.get(signs[at], 0) + len(nexts) * p) / (n + len(nexts))
        total += math.log(p)
    return total


def scores_of(rows, rule_list):
    """Score of each distinct (id, url), by plain loops over whole texts."""
    copies = Counter(rows)
    text = {r: r[1].split("://", 1)[1] if r[1] and "://" in r[1] else "" for r in copies}
    verdict = {r: judged(rule_list, r[1])[3] for r in copies}
    mark = {r: zlib.crc32(("" if r[0] is None else str(r[0])).encode()) % url_filter.HELD_OUT for r in copies}
    learned = {v: [text[r] for r, n in copies.items() if verdict[r] == v and mark[r] for _ in range(n)] for v in ("allow", "block")}
    characters = len({c for t in learned["allow"] + learned["block"] for c in [*t, url_filter.END]})
    models = {v: model_of(t) for v, t in learned.items()}
    raw = dict.fromkeys(copies, 0.0)
    if all(learned.values()):
        for r in copies:
            good, bad = (log_likelihood(models[v], characters, text[r]) for v in ("allow", "block"))
            raw[r] = round((good - bad) / (len(text[r]) + 1), 9)
    held = [(math.floor(raw[r] * url_filter.STEPS), verdict[r] == "allow") for r in copies if verdict[r] and not mark[r]]
    good, bad = [s for s, g in held if g], [s for s, g in held if not g]
    threshold = 0.0
    if good and bad:
        def error(step):
            return sum(s < step for s in good) / len(good) + sum(s >= step for s in bad) / len(bad)
        threshold = min((round(error(s), 12), abs(s), s) for s in {s for s, _ in held})[2] / url_filter.STEPS
    return {r: raw[r] - threshold for r in copies}


def test_url_scores_and_threshold_against_plain_loops(spark):
    draw = random.Random(5)
    rows = [(n, f"https://{draw.choice(['a', 'shop', 'ü'])}{n % 5}.com/{draw.choice(['news', 'Blog', 'x'])}/{n}?page={n % 3}") for n in range(60)]
    rows += [(n, f"http://b{n % 4}.net/{draw.choice(['es', 'fr'])}/{draw.choice(['win', 'news'])}-{n}#{n % 7}") for n in range(60, 120)]
    rows += [(n, f"http://c.org/{draw.choice(['news', 'win', '新聞'])}/{n}?page={n % 3}") for n in range(120, 150)]
    rows += [(3, rows[3][1])] * 40 + [(None, None), (None, "http://q.org/?a=1"), (151, ""), (152, "x://y.com/" + "long/" * 4000)]
    rows += [(153, "http://c.org/same?page=1"), (154, "http://c.org/same?win-4#4")]  # nothing but the query differs
    pages = spark.createDataFrame(rows, "page_id long, url string").withColumns({n: F.lit(0) for n in ("gram_", "key_", "score")})
    wanted = scores_of(rows, queries.URL_RULES)
    expected = Counter((i, round(wanted[i, u], 6)) for i, u in rows)
    found = url_filter.judge_urls(pages, queries.URL_RULES).collect()
    assert Counter((r["page_id"], round(r["score"], 6)) for r in found) == expected
    assert all(r["verdict"] == ("allow" if r["score"] >= 0 else "block") for r in found if not r["rule"])
    assert len({r["score"] for r in found if r["page_id"] in (153, 154)}) == 2


def test_urls_of_one_class_are_allowed(spark):
    rows = [(n, f"http://a.com/{n}") for n in range(20)] + [(30, "http://b.org/zzz")]
    found = url_filter.judge_urls(spark.createDataFrame(rows, "page_id long, url string"), queries.URL_RULES).collect()
    assert len(found) == 21 and {r["verdict"] for r in found} == {"allow"} and {r["score"] for r in found} == {0.0}


def test_models_give_probabilities(spark):
    order = url_filter.ORDER
    contexts = ["\x02" * order, "x" * order, "abcdefgh"[:order]]
    rows = [(c + s, n * (k + 1), n * k) for k, c in enumerate(contexts) for n, s in enumerate("abcx\x03")]
    table = url_filter.log_ratios(spark.createDataFrame(rows, "gram_ string, a_ long, r_ long")).collect()
    assert len(table) == len(rows) and all(0 < r["pa_"] < 1 and 0 < r["pr_"] < 1 for r in table)
    for c in contexts:
        assert sum(r["pa_"] for r in table if r["gram_"].startswith(c)) <= 1
