import base64
import gzip
import hashlib
import os
import random
import time
from collections import Counter

import pytest

from papyra.llm import htmldiff, warc
from papyra.shared import shared_path

SCHEMA = "page_id long, url string, html string, text string, sha1 string, kind int"


@pytest.fixture(scope="module")
def given():
    rng = random.Random(6)
    htmls = ["<p>" + "".join(rng.choice("abcé") for _ in range(rng.randint(0, 300))) + "</p>" for _ in range(30)]
    rows = [(i, f"http://h{i % 3}.example/a/{i}", h) for i, h in enumerate(htmls)]
    rows += [(40, "http://x/ ü\n", htmls[2]), (1000, None, htmls[2]), (41, "u", None), (42, "u", ""), (43, "u", None), (None, "n", htmls[5]), (None, None, "only null"), (None, None, "only null"), (44, "b", "same"), (44, "a", "same"), (45, "x", "y" * 300_000)]
    return [(*r, "clash", "clash", 7) for r in rows]


def test_round_trip(spark, given):
    pages = spark.createDataFrame(given, SCHEMA).repartition(3)
    uri = shared_path(spark, "t")
    manifest = warc.write_archives(pages, uri, roll_bytes=2000, shard_payload=4000).collect()
    got = warc.read_archives(spark, uri, payloads=True).collect()
    groups: dict = {}
    for r in given:
        groups.setdefault((r[2] or "").encode(), []).append(r[0])
    low = {h: min((i for i in ids if i is not None), default=None) for h, ids in groups.items()}
    want = Counter()
    seen = set()
    for i, _, h, *_ in sorted(given, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        h = (h or "").encode()
        first = low[h] == i and h not in seen
        seen |= {h} if low[h] == i else set()
        want[i, len(h), base64.b32encode(hashlib.sha1(h).digest()).decode(), "response" if first else "revisit", None if first else low[h]] += 1
    assert Counter((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in got) == want
    assert Counter((r["page_id"], r["url"]) for r in got) == Counter((r[0], r[1]) for r in given)  # blanks and line ends too
    assert all((r["payload"] is None) == (r["record_type"] == "revisit") for r in got)
    assert sum(m["records"] for m in manifest) == len(given) and len(manifest) > 5
    path = uri.removeprefix("file://")
    for m in manifest:
        with open(f"{path}/{m['file']}", "rb") as f:
            data = f.read()
        assert hashlib.sha256(data).hexdigest() == m["sha256"] and len(data) == m["bytes"] and gzip.decompress(data).startswith(b"WARC/1.1\r\nWARC-Type: warcinfo")
    again = shared_path(spark, "t")
    other = warc.write_archives(pages.repartition(5), again, roll_bytes=2000, shard_payload=4000).collect()
    assert {(m["file"], m["sha256"]) for m in other} == {(m["file"], m["sha256"]) for m in manifest}


def test_shards_are_cut_by_bytes(spark):
    pages = [(i, f"u{i}", ("x" if i % 50 else "y" * 200_000) + str(i)) for i in range(400)] + [(None, f"n{i}", "z" * 3000 + str(i)) for i in range(100)]
    uri = shared_path(spark, "t")
    manifest = warc.write_archives(spark.createDataFrame(pages, "page_id long, url string, html string"), uri, shard_payload=150_000).collect()
    sizes = {}
    with_bytes = {r[0]: len(r[2]) for r in pages}
    for r in warc.read_archives(spark, uri).collect():
        sizes[r["page_id"]] = r["payload_bytes"]
    assert len(sizes) == 401 and sizes[50] == with_bytes[50]
    assert len({m["shard"] for m in manifest}) > 8 and max(m["records"] for m in manifest) < 260


def test_a_stopped_run_is_run_again(spark, given, monkeypatch):
    pages = spark.createDataFrame(given, SCHEMA)
    uri = shared_path(spark, "t")
    path = uri.removeprefix("file://")
    with monkeypatch.context() as m:
        real = warc.arrow_map
        calls = []

        def stop(df, fn, schema):
            calls.append(fn.__name__)
            if fn.__name__ == "commit":
                raise RuntimeError("stopped before the commit")
            return real(df, fn, schema)

        m.setattr(warc, "arrow_map", stop)
        with pytest.raises(RuntimeError):
            warc.write_archives(pages, uri, shard_payload=2000)
    assert os.path.isdir(f"{path}/_temporary") and not os.path.isdir(f"{path}/manifest")
    with open(f"{path}/part-000999-0000.warc.gz", "wb") as f:
        f.write(b"left by an earlier run")
    with open(f"{path}/notes.txt", "w") as f:
        f.write("not ours")
    first = {(m["file"], m["sha256"]) for m in warc.write_archives(pages, uri, shard_payload=4000).collect()}
    assert not os.path.isdir(f"{path}/_temporary") and os.path.exists(f"{path}/notes.txt")
    assert {f for f in os.listdir(path) if f.endswith(".gz")} == {f for f, _ in first}
    assert warc.read_archives(spark, uri).count() == len(given)
    again = {(m["file"], m["sha256"]) for m in warc.write_archives(pages, uri, shard_payload=4000).collect()}
    assert again == first


def test_renames_may_be_repeated(tmp_path):
    fs, path = warc.filesystem(str(tmp_path))
    (tmp_path / "a").write_bytes(b"1")
    warc._rename(fs, f"{path}/a", f"{path}/b")
    warc._rename(fs, f"{path}/a", f"{path}/b")  # the task is tried again
    (tmp_path / "a").write_bytes(b"2")
    warc._rename(fs, f"{path}/a", f"{path}/b")
    assert (tmp_path / "b").read_bytes() == b"2" and not (tmp_path / "a").exists()
    with pytest.raises(FileNotFoundError):
        warc._rename(fs, f"{path}/a", f"{path}/c")


def test_small_payloads_are_not_revisited(spark):
    pages = spark.createDataFrame([(1, "a", "xx"), (2, "b", "xx"), (3, "c", "yyyyyy"), (4, "d", "yyyyyy")], "page_id long, url string, html string")
    got = {r["page_id"]: r["record_type"] for r in warc.round_trip(pages, min_revisit=3).collect()}
    assert got == {1: "response", 2: "response", 3: "response", 4: "revisit"}
    assert warc.round_trip(pages.limit(0)).count() == 0


def test_damage_is_found(spark):
    member = warc.page_record(1, "u", b"body", warc.digest(b"body"), 0, None)
    headers, block = warc.parse(gzip.decompress(member))
    assert headers["warc-type"] == "response" and block.endswith(b"\r\n\r\nbody")
    with pytest.raises(ValueError):
        warc.parse(gzip.decompress(member).replace(b"body\r\n", b"bodx\r\n"))


ARTICLE = '<html><head><title>t</title><script>var a="</p>";</script></head><body><nav><ul><li>menu</li></ul></nav><div class="ad">buy</div><article><h1>T &amp; U</h1><p><b>one\n two<br>three<p>four</p><aside>no</aside></article><footer>foot</footer></body></html>'


def test_article():
    assert htmldiff._text(ARTICLE) == "T & U\none two three\nfour"
    assert htmldiff._text("") == htmldiff._text(None) == ""
    assert htmldiff._text('<main><p>a first</p><div id="comments"><p>c</p></div><form><p>f</p></form><p>b<!-- c --></p></main><p>out</p>') == "a first\nb"
    assert htmldiff._text("<article>teaser</article><div>the body of the page, outside</div>") == "teaser\nthe body of the page, outside"
    assert htmldiff._text("plain &lt;text&gt; &#233;") == "plain <text> é"
    assert htmldiff._text('<p>a</p><p class="ad">x<p>b</p><div class="cookie-notice"><div>y</div>z</div><p>c') == "a\nb\nc"


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ('<div class="content no-sidebar"><p>a', "a"),
        ('<div title="a hidden gem">b', "b"),
        ('<article class="post no-comments">c</article>', "c"),
        ('<article><div class="article-header"><h1>Title</h1></div><p>x</article>', "Title\nx"),
        ("<p title=it's>One</p><p>Two don't ...", "One\nTwo don't ..."),
        ('<p title="oops>One</p><p>Two', "One\nTwo"),
        ("1 < 2 and <b>3</b> > 2 <", "1 < 2 and 3 > 2 <"),
        ('<div class="page sidebar"><article>in</article>out</div>', "in"),
        ('<div hidden>x</div>y<input class="search">z<br/>w', "yz w"),
        ("<p>a<script>if (x < 1) '</p>'</script>b<SCRIPT>c</Script>d<style>", "abd"),
        ("<aside><article>teaser</article></aside><p>text", "text"),
    ],
)
def test_marks_and_malformed_markup(page, text):
    assert htmldiff._text(page) == text


@pytest.mark.parametrize("unit", ["<b ", '<p x="', "<div>", "<!--", "<", "<script>", "<p>x", "<nav>", "<article>", "<a b='c> <a b=\"d> ", "&", "</p", "x "])
def test_very_long_pages_take_one_pass(unit):
    took = []
    for size in (1 << 20, 5 << 20):
        begun = time.process_time()
        htmldiff._text(unit * (size // len(unit)))
        took.append(time.process_time() - begun)
    assert took[1] < 12 * took[0] + 0.5


def brute_template(pages):
    """Lines deleted by differencing, from known lines: pages are (host, path, [(line, kind)]) with no line twice in a page."""
    out = {}
    for host in {p[0] for p in pages}:
        own = sorted({(p[1], tuple(p[2])) for p in pages if p[0] == host})
        alike = {}
        for path, lines in own:
            alike.setdefault(lines, path)
        order = sorted(alike, key=lambda x: alike[x])
        for k, lines in enumerate(order):
            size = lambda kinds: sum(len(t) for t, q in lines if q in kinds)  # noqa: B023, E731
            article = size("A") >= max(size("P"), 1)
            text = [x for x in lines if x[1] == "A" or (x[1] == "P" and not article)]
            near = [order[j] for j in (k - 2, k - 1, k + 1, k + 2) if 0 <= j < len(order)]
            shared = [{x for x in lines if (x[0], x[1] == "C") in {(t, q == "C") for t, q in other}} for other in near]
            voters = [s for s in shared if sum(len(x[0]) for x in s if x in text) < 0.8 * sum(len(x[0]) for x in text)]
            gone = set()
            for x in lines:
                v = sum(x in s for s in voters)
                if (v >= 3 and v == len(voters)) if x in text and article else (v and 2 * v >= len(voters)):
                    gone.add(x)
            if shared and not voters:
                every = set.intersection(*shared)
                gone = {x for x in every if x not in text or (not article and set(text) - every)}
            out[host, lines] = (gone, [t for t, q in lines if (t, q) in text and (t, q) not in gone])
    return out


def test_extraction_against_brute_force(spark):
    rng = random.Random(4)
    tag = {"P": "<div>{}</div>", "C": "<nav>{}</nav>", "A": "<p>{}</p>"}
    pages = []
    for i in range(260):
        host, path = rng.choice(["a", "a", "a", "b", "c"]), f"/{rng.choice('xyz')}/{rng.randrange(400):03d}-{i}"
        kind = "A" if rng.random() < 0.5 else "P"
        head = [(f"menu {k} of {host}", "C") for k in range(3) if rng.random() < 0.7] + [(f"banner of {host} for all to see", "P")] * (rng.random() < 0.8)
        body = [(f"story {i} part {k}, told at length" if rng.random() < 0.8 else f"quoted passage {rng.randrange(4)}", kind) for k in range(rng.randint(0, 4))]
        body = list(dict.fromkeys(body)) + [(f"rights of {host}", kind)] * (rng.random() < 0.7)
        tail = [(f"imprint of {host}", "P")] * (rng.random() < 0.8)
        lines = sorted(head) + sorted(body) + tail
        pages.append((host, path, lines))
        if rng.random() < 0.1:
            pages.append((host, path + "/copy", lines))
    pages += [("a", f"/y/{k:03d}/same", pages[0][2]) for k in range(300)]  # a group of copies
    rows = []
    for i, (host, path, lines) in enumerate(pages):
        inner = "".join(f"<article>{tag[k].format(t)}</article>" if k == "A" else tag[k].format(t) for t, k in lines)
        rows.append((i, f"https://{host}.example{path}", f"<html><body>{inner}</body></html>"))
    want = brute_template([(h, f"{p}?", x) for h, p, x in pages])
    got = {r["page_id"]: r for r in htmldiff.extract(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)).collect()}
    for i, (host, _, lines) in enumerate(pages):
        gone, text = want[host, tuple(lines)]
        assert (got[i]["n_template"], got[i]["text"]) == (len(gone), "\n".join(text))
    assert sum(len(g) for g, _ in want.values()) > 300 and any(k == "A" for g, _ in want.values() for _, k in g)


def test_differencing(spark):
    def soup(n, *lines):
        return "".join(f"<div>{x}</div>" for x in ("Site name", "Home News", *lines, f"story {n} with a text of its own", "All rights reserved"))

    rows = [(1, "http://h/a/1", soup(1, "lead one")), (2, "http://h/a/2", soup(2)), (3, "http://h/a/3", soup(3)), (4, "http://other/x", soup(4)), (5, "http://c/1", soup(5)), (6, "http://c/2", soup(5)), (7, None, None), (8, "http://h/z", ARTICLE), (9, "http://h/z2", ARTICLE), (1, "http://h/a/1", soup(1, "lead one")), (None, "::bad[", "<p>x</p>")]
    got = Counter((r["page_id"], r["text"], r["n_chars"]) for r in htmldiff.extract(spark.createDataFrame([(*r, "k") for r in rows], "page_id long, url string, html string, key string")).collect())
    whole = lambda n: "\n".join(["Site name", "Home News", f"story {n} with a text of its own", "All rights reserved"])
    texts = [(2, "story 2 with a text of its own"), (3, "story 3 with a text of its own"), (4, whole(4)), (5, whole(5)), (6, whole(5)), (7, ""), (8, "T & U\none two three\nfour"), (9, "T & U\none two three\nfour"), (None, "x")]
    assert {k for k in got if k[0] != 1} == {(i, t, len(t)) for i, t in texts}
    assert sum(v for k, v in got.items() if k[0] == 1) == 2
    assert htmldiff.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_longest_common_subsequence():
    def length(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            new = [0]
            for j, y in enumerate(b):
                new.append(row[j] + 1 if x == y else max(new[-1], row[j + 1]))
            row = new
        return row[-1]

    rng = random.Random(1)
    for _ in range(500):
        a, b = ([rng.randrange(5) for _ in range(rng.randrange(20))] for _ in range(2))
        pairs = htmldiff.common(a, b)
        assert len(pairs) == length(a, b) and all(a[i] == b[j] for i, j in pairs) and all(p < q and s < t for (p, s), (q, t) in zip(pairs, pairs[1:]))
