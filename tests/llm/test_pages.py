"""Archives and page texts."""

import base64
import hashlib
import html
import random
import re
from collections import Counter

from pyspark.sql import functions as F

from lapwright.llm import html_text, warc
from lapwright.llm.common import scratch

PAGES = "page_id long, url string, html string, row string, file string"


def _pages(spark):
    rows = [
        (5, "http://h/a?x=%20y\r\nz", "<p>same</p>"), (2, "http://h/b", "<p>same</p>"), (9, None, None), (4, "u", ""),
        (2, "http://h/b", "<p>same</p>"), (None, None, "<p>same</p>"), (None, "v", "other é"), (-7, "w", "x" * 100_000),
        (2**62, "far", "far"), (11, "k", "<p>same</p>"),
    ]
    return spark.createDataFrame([(*r, "a", "b") for r in rows], PAGES)


def test_archives_come_back_whole(spark):
    pages = _pages(spark)
    root = scratch(spark)
    warc.write(pages, root, shard_bytes=60, roll_bytes=400)
    back = warc.read(spark, root)
    rows = pages.withColumn("html", F.coalesce("html", F.lit(""))).collect()
    smallest = {h: min((r.page_id for r in rows if r.html == h and r.page_id is not None), default=None) for h in {r.html for r in rows}}
    expected = []
    for r in rows:
        data, first = r.html.encode(), smallest[r.html]
        own = r.page_id == first
        expected.append((
            r.page_id, r.url, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(),
            "response" if own else "revisit", None if own else first, data if own else None,
        ))
    got = [(*list(r)[:6], None if r.payload is None else bytes(r.payload)) for r in back.collect()]
    assert sorted(got, key=repr) == sorted(expected, key=repr)
    assert spark.read.json(f"{root}/manifest").count() > 2


def test_files_do_not_depend_on_partitions(spark):
    pages = _pages(spark)
    manifests = []
    for n in (1, 5):
        root = scratch(spark)
        warc.write(pages.repartition(n), root, shard_bytes=200, roll_bytes=500)
        manifests.append(sorted(tuple(r) for r in spark.read.json(f"{root}/manifest").collect()))
    assert manifests[0] == manifests[1]
    root = scratch(spark)
    warc.write(pages.limit(0), root)
    assert warc.read(spark, root).count() == 0


def test_hot_ids_and_null_ids_are_divided(spark):
    rows = [(7 if k % 3 == 0 else None if k % 3 == 1 else k, f"u{k}", f"<p>{k} {'x' * 90}</p>") for k in range(3000)]
    pages = spark.createDataFrame([(*r, "a", "b") for r in rows], PAGES)
    small = pages.selectExpr("page_id", "sha2(html, 256) digest", "octet_length(html) size", "html")
    placed, shards = warc.with_shards(small, small, 10_000)
    dealt = placed.repartitionById(shards, F.col("shard")).withColumn("task", F.spark_partition_id())
    per_task = dealt.groupBy("task").agg(F.sum("size").alias("bytes"), F.count_distinct("shard").alias("shards")).collect()
    assert shards > 30 and max(r.bytes for r in per_task) < 20_000 and {r.shards for r in per_task} == {1}
    root = scratch(spark)
    warc.write(pages, root, shard_bytes=10_000)
    back = warc.read(spark, root).collect()
    key = lambda r: (r[0] is None, r[0], r[1])
    got = [(r.page_id, r.url, bytes(r.payload).decode(), r.record_type) for r in back]
    assert sorted(got, key=key) == sorted([(*r, "response") for r in rows], key=key)


def test_least_bytes_leaves_short_payloads_alone(spark):
    root = scratch(spark)
    warc.write(_pages(spark), root, least_bytes=12)
    assert warc.read(spark, root).filter("record_type = 'revisit'").count() == 0


def test_regions_of_a_page():
    read = lambda h: html_text.read_page(h)[0]
    article = "<h1>T&amp;T</h1><p>One<b>two</b>\n three<br>four<script>var a='</p>'</script>"
    page = f"<body><nav>Menu</nav><article>{article}<aside>side</aside><div class='x ad-slot'>Buy</div><form>f</form>"
    page += "<p>five<ul><li>six<li>seven</ul><section id=comments><p>first!</section></article><footer>End"
    assert read(page) == "T&T Onetwo three four five six seven"
    assert read("<!-- <article>no</article> --><main>yes</main>") == "yes"
    assert read("<p>no article") is None and read("") is None
    assert html_text.read_page("<div>a b</div><footer>c</footer>")[1] == [("a", True), ("b", True), ("c", False)]
    assert read("<article>cut off <b>in the") == "cut off in the"


def test_markup_inside_scripts_is_no_markup():
    read = lambda h: html_text.read_page(h)[0]
    for code in ("for(i=0;i<n;i++){s+=i}", "a='<b'; b=\"<i\";", "x='<!--'", "if(a<b){c='</p>'}"):
        for end in ("</script>", "</SCRIPT >"):
            assert read(f"<head><script>{code}{end}</head><article>kept {code[:1]}</article>") == f"kept {code[:1]}", code
    assert read("<article>kept <style>p::after{content:'<a'}</style>too</article>") == "kept too"
    assert read("<article>kept</article><script>i<n") == "kept"
    assert read("<article>kept <svg><title>no</title></svg>too</article>") == "kept too"


def test_repeats_on_a_host_are_no_text(spark):
    menu = "<div>Home News Sport Weather Contact us today</div>"
    rows = [
        (1, "http://h/a", f"<body>{menu}<p>Unique words about cats</p>"), (2, "http://h/b", f"{menu}<p>Other things</p>"),
        (3, None, None), (4, "http://g/b", f"{menu}<p>Third</p>"), (None, "http://h/c", f"<article>{menu}</article>"),
    ]
    pages = spark.createDataFrame([(*r, "a", "b") for r in rows], PAGES)
    got = {(r.page_id, r.text) for r in html_text.extract(pages).collect()}
    assert got == {
        (1, "Unique words about cats"), (2, "Other things"), (3, ""), (4, "Home News Sport Weather Contact us today Third"),
        (None, "Home News Sport Weather Contact us today"),
    }
    assert html_text.extract(pages.limit(0)).count() == 0


def _texts(spark, rows):
    pages = spark.createDataFrame([(*r, "a", "b") for r in rows], PAGES)
    return {r.page_id: r.text for r in html_text.extract(pages).collect()}


def _words(r, n=30):
    return " ".join(f"w{r.randrange(10**6)}" for _ in range(n))


def test_copies_and_phrases_of_few_pages_stay(spark):
    r = random.Random(1)
    menu, phrase = "Home News Sport Weather Contact us today", "as far as we know from the records"
    copied = _words(r)
    rows = [(k, f"http://c/{k}", f"<div>{copied}</div>") for k in range(5)] + [(k, f"http://c/{k}", f"<div>{_words(r)}</div>") for k in (5, 6)]
    large = {k: f"{_words(r)} {phrase if k % 10 == 0 else 'x'} {_words(r)}" for k in range(100, 400)}
    rows += [(k, f"http://large/{k}", f"<div>{menu}</div><div>{t}</div>") for k, t in large.items()]
    two = {k: f"{menu} {_words(r)}" for k in (500, 501)}
    rows += [(k, f"http://two/{k}", f"<div>{t}</div>") for k, t in two.items()]
    got = _texts(spark, rows)
    assert [got[k] for k in range(5)] == [copied] * 5
    assert {k: got[k] for k in large} == large
    assert {k: got[k] for k in two} == two


def test_articles_and_what_surrounds_them_are_judged_alike(spark):
    r = random.Random(2)
    ask, menu = "<p>Subscribe to our newsletter</p>", "<div>Home News Sport Weather Contact us today</div>"
    body, note = {k: _words(r) for k in range(6)}, {k: _words(r, 5) for k in range(6)}
    rows = [
        (k, f"http://h/{k}", f"{menu}<div>{note[k]}</div><article><p>{body[k]}</p>{ask}<p>end {k}</p></article>") for k in range(6)
    ]
    rows += [(k, f"http://h/{k}", rows[0][2]) for k in (10, 11, 12)]
    got = _texts(spark, rows)
    assert got == {k: f"{note[0 if k > 9 else k]} {body[0 if k > 9 else k]} end {0 if k > 9 else k}" for k in got}
    assert len(got) == 9


def test_vote_against_brute_force(spark):
    r = random.Random(3)
    lines = ["a b c", "d e f g h i j", "k l m n o p", "a b c d e f g h"]
    rows = []
    for k in range(60):
        parts = [f"<div>{r.choice(lines)}</div>" if r.random() < 0.6 else f"<p>{_words(r, 3)} {r.choice(lines)}</p>" for _ in range(4)]
        cut = r.randrange(5)
        if r.random() < 0.5:
            parts.insert(cut, "<article>" + r.choice(lines) + f"<p>{r.choice(lines)}</article>")
        rows.append((k, f"http://{r.choice('xyyyz')}/{k}", "".join(parts)))
    rows += [(100 + k, url, page) for k, url, page in rows[:20]]
    n = html_text.REPEATED
    hosts = {}
    for k, url, page in rows:
        hosts.setdefault(url.split("/")[2], {})[k] = [(z, tuple(e)) for z, e in html_text.runs(html_text.read_blocks(page)[1])]
    expected = {}
    for pages in hosts.values():
        kinds = {tuple(p) for p in pages.values()}
        written = [p for p in kinds if any(z == html_text.ARTICLE_ZONE for z, _ in p)]

        def grams(page, zones):
            return {e[i : i + n] for z, e in page if z in zones for i in range(len(e) - n + 1)}

        within = {html_text.ARTICLE_ZONE}
        every = Counter(g for p in kinds for g in grams(p, {html_text.OPEN_ZONE, *within}))
        inner = Counter(g for p in kinds for g in grams(p, within))
        for k, page in pages.items():
            left = []
            for z, e in page:
                seen, many = (inner, max(3, len(written) / 2)) if z in within else (every, max(3, len(kinds) / 4))
                gone = {j for i in range(len(e) - n + 1) if seen[e[i : i + n]] >= many for j in range(i, i + n)}
                for at in (j for j, t in enumerate(e) if t is not None):
                    low = high = at
                    while at in gone and low - 1 in gone and e[low - 1] is not None:
                        low -= 1
                    while at in gone and high + 1 in gone and e[high + 1] is not None:
                        high += 1
                    # A fragment of a block goes if it is long enough.
                    if at not in gone or high - low + 1 < n and (e[low - 1] is not None or e[high + 1] is not None):
                        left.append(e[at])
            expected[k] = " ".join(left)
    got = _texts(spark, rows)
    assert got == expected
    assert any(len(got[k].split()) < sum(t is not None for _, e in hosts[u.split("/")[2]][k] for t in e) for k, u, _ in rows)


def test_given_pages(spark):
    folder = "/root/testdata/sf0.001"
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{folder}/pages.parquet").collect()}
    for r in html_text.texts(spark, folder).collect():
        inside = re.search("<article>(.*)</article>", pages[r.page_id], re.S)[1]
        text = re.sub("<[^>]*>", lambda m: "" if m[0] in ("<b>", "</b>") else " ", inside)
        assert r.text == " ".join(html.unescape(text).split())
        assert r.n_chars == len(r.text)
