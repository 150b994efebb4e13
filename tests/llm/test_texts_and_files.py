"""Packing, HTML extraction, WARC archives, nearest neighbours and the pipeline."""

from __future__ import annotations

import base64
import hashlib
import io
import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import combinations_with_replacement

import numpy as np
import pytest
import zstandard

import corpus_pipeline
from tripmart.llm import html_text, neighbours, packing, queries, warc

# ------------------------------------------------------------------ packing


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(packing.default_tokenizer())


def check_packing(rows, texts, tokenizer, length=1024):
    """``rows`` by document against plain tokenization, and sequences without gaps or overlaps."""
    pieces, bins = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        bins[r.sequence_id].append((r.offset, r.length))
    for i, text in texts.items():
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        at = 0
        for n, r in enumerate(sorted(pieces[i], key=lambda r: r.piece)):
            assert (r.piece, r.start) == (n, at) and (n == 0 or r.length == length)
            assert r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids) and (len(ids) > length or len(pieces[i]) == 1)
    for places in bins.values():
        end = 0
        for offset, size in sorted(places):
            assert offset == end
            end += size
        assert end <= length
    return len(bins)


def test_packing_round_trip(spark, sf_dir, tokenizer):
    rows = queries.op3_packing(spark, sf_dir).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    used = check_packing(rows, texts, tokenizer)
    assert used <= 1.02 * -(-sum(r.length for r in rows) // 1024)


def test_tokens_of_unusual_texts(tokenizer):
    encode = packing.Encoder(packing.default_tokenizer())
    texts = ["", " ", "\n\n  x", "<|endoftext|> a<|endoftext|>", "I'll they've", "你好\U0001f600‍́", "\x00\x7f\x85 "]
    rng = random.Random(0)
    texts += ["".join(chr(c) for c in (rng.randrange(0x20, 0x3000) for _ in range(200))) for _ in range(50)]
    for text in texts:
        assert encode(text).tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def plain_two_fit(counts, room):
    """Best-two-fit, one bin at a time and by trying all pairs."""
    left, bins = Counter(counts), []
    while sum(left.values()):
        gap, contents = room, []
        for size in sorted(left, reverse=True):
            while left[size] and size <= gap:
                contents.append(size)
                left[size] -= 1
                gap -= size
        if gap and len(contents) > 1:
            small = contents[-1]
            pairs = [
                (a + b, b)
                for a, b in combinations_with_replacement(sorted(s for s in left if left[s]), 2)
                if small < a + b <= gap + small and (a != b or left[a] > 1)
            ]
            if pairs:
                total = max(pairs)[0]
                bins_now = next((t, b) for t, b in pairs if t == total)
                contents[-1:] = [bins_now[1], total - bins_now[1]]
                left[small] += 1
                left[bins_now[1]] -= 1
                left[total - bins_now[1]] -= 1
        bins.append(sum(contents))
    return bins


def test_plan_is_best_two_fit():
    rng = random.Random(3)
    for _ in range(60):
        room = rng.choice([10, 37, 100])
        counts = {rng.randrange(1, room + 1): rng.randrange(1, 30) for _ in range(rng.randrange(1, 25))}
        bins = packing.plan(counts, room)
        used = Counter()
        for contents, times in bins:
            assert times > 0 and sum(contents) <= room
            for size in contents:
                used[size] += times
        assert used == Counter(counts)
        plain = plain_two_fit(counts, room)
        assert sum(t for _, t in bins) <= len(plain) + 1


def test_swapping_the_smallest_fills_the_gap():
    # greedy leaves 1 free in 6+3; 2+2 fill it
    assert sorted(packing.plan({6: 1, 3: 1, 2: 2}, 10)[0][0]) == [2, 2, 6]


def test_packing_awkward_rows(awkward, nothing, tokenizer):
    docs = awkward.where("doc_id is not null and doc_id > 1")
    rows = packing.pack(docs).collect()
    check_packing(rows, {r.doc_id: r.text for r in docs.collect()}, tokenizer)
    ids = {(r.doc_id, r.piece): r.ids for r in rows}
    assert ids[3, 0] == [2] and ids[4, 0] == [2]
    assert all(zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 for r in rows)
    every = packing.pack(awkward, with_ids=False).collect()
    assert sum(r.doc_id == 1 for r in every) == 2 and sum(r.doc_id is None for r in every) == 2
    assert packing.pack(nothing).count() == 0


# ------------------------------------------------------------------ HTML


def plain_article(page):
    body = re.search(r"<article>(.*?)</article>", page, re.DOTALL).group(1)
    blocks = [re.sub(r"<[^>]*>", "", re.sub(r"<br>", " ", b)) for b in re.split(r"</?(?:p|h1)>", body)]
    from html import unescape

    return "\n".join(x for x in (re.sub(r"\s+", " ", unescape(b)).strip() for b in blocks) if x)


def test_extraction_against_the_article(spark):
    folder = "/root/testdata/sf0.01"
    pages = {r.page_id: r for r in spark.read.parquet(f"{folder}/pages.parquet").collect()}
    rows = queries.op6_html_extraction(spark, folder).collect()
    assert len(rows) == len(pages)
    for r in rows:
        assert r.text == plain_article(pages[r.page_id].html) and r.n_chars == len(r.text) and r.url == pages[r.page_id].url


PAGE = """<!doctype html><HTML><head><title>T</title><script>if (a<b) "</p>"</script></head><body class="page">
<header><a href="/">Home</a></header><ul class="main-menu"><li>One<li>Two</ul>
<div id="content"><h1>Head&nbsp;line &#233;&amp;</h1><p>First <b>bold
 text</b> x<br>y<p>Second &lt;tag&gt; <!-- <p>no</p> --> end
<ul><li>item a<li>item b</ul><table><tr><td>c1<td>c2<tr><td>c3</table>
<form><p>Subscribe</p><input value=x></form></div>
<div class="cookie-notice">We use cookies</div><section id="comments"><p>Great!</p></section>
<div role="complementary">Side</div><div hidden>secret</div><footer>&copy; 2020</footer>"""


def test_extraction_of_broken_markup():
    want = "Head line é&\nFirst bold text x y\nSecond <tag> end\nitem a\nitem b\nc1\nc2\nc3"
    assert html_text.extracted(PAGE, frozenset()) == want
    for broken in ("", "plain", "<", "<p", "<p>a", "</div></p>a", "<b><i>x</b>y</i>", "<script>never closed", "<!-- open", "<a b='c>d"):
        html_text.extracted(broken, frozenset())
    assert html_text.extracted("plain &amp; <i>simple</i>", frozenset()) == "plain & simple"
    deep = "<div>" * 5000 + "deep" + "</div>" * 5000
    assert html_text.extracted(deep, frozenset()) == "deep"


@pytest.mark.parametrize(
    ("piece", "gone"),
    [
        ("<svg/>", ""), ("<svg viewBox='0 0 1 1'/>", ""), ("<math />", ""), ("<svg><g><svg/></g><text>drawn</text></svg>", "drawn"),
        ("<video src='x'>", ""), ("<video controls><source src='a'>no video</video>", "no video"), ("<audio>", ""),
        ("<object data='x'>", ""), ("<object><object>inner</object>outer</object>", "outer"), ("<object><object>in</object>", "in"),
        ("<canvas>", ""), ("<select><option>one</select>", "one"), ("<template>", ""), ("<iframe>", ""), ("<textarea>typed</textarea>", "typed"),
        ("<script>if (a < b) c()</script>", "c()"), ("<style/>p {}</style>", "p {}"),
    ],
)
def test_elements_without_text_end_where_they_must(piece, gone):
    page = f"<body><article><p>before</p>{piece}<p>after it</p></article><p>the end</p></body>"
    found = html_text.extracted(page, frozenset()).split("\n")
    assert [x for x in found if x != gone] == ["before", "after it", "the end"]
    assert not gone or gone not in found


def test_copies_of_a_page_are_no_template(spark):
    """Mirrors, print views and pages per session are one page, however often they are there."""
    words = [f"word{i}" for i in range(400)]
    sections = "".join(f"<section><p>{' '.join(words[i : i + 40])}</p></section>" for i in range(0, 160, 40))
    article = f"<html><body><article><h1>title</h1>{sections}</article></body></html>"
    rows = [(i, f"http://one.example/a?session={i}", article) for i in range(5)]
    # a box that other pages have too still goes
    box = "<div><p>the same box everywhere</p></div>"
    rows += [
        (10 + i, f"http://one.example/{i}", f"<body><div><p>{' '.join(words[200 + 20 * i : 240 + 20 * i])}</p></div>{box}</body>")
        for i in range(4)
    ]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = {r.page_id: r.text for r in html_text.main_text(frame).collect()}
    assert all(len(found[i].split("\n")) == 5 for i in range(5))
    assert all("box" not in found[10 + i] and found[10 + i].startswith("word") for i in range(4))


def test_site_templates_are_found_by_recurrence(spark):
    def page(i, host):
        boxes = f'<div class="q1"><p>Teaser {i} of the day</p></div>' + '<div class="z9"><p>Read our terms before you go</p></div>'
        text = "".join(f"<p>Paragraph {i}-{k} of this page only.</p>" for k in range(6))
        return i, f"http://{host}/{i}", f'<body><div class="top"><span>{host}</span></div><div class="text">{text}{boxes}</div></body>'

    rows = [page(i, "a.example") for i in range(12)] + [page(50, "b.example")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text.split("\n") for r in html_text.main_text(pages).collect()}
    own = [f"Paragraph 3-{k} of this page only." for k in range(6)]
    # outside the main element frames decide, in it only recurring text
    assert got[3] == [*own, "Teaser 3 of the day"]
    # one page is no site: nothing recurs
    assert got[50][0] == "b.example" and got[50][-1] == "Read our terms before you go"


def test_recurring_paragraphs_of_articles_stay(spark):
    rows = [(i, "http://a/x", "<article><h1>Same title</h1><p>Same words on every page.</p></article>") for i in range(9)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {r.text for r in html_text.main_text(pages).collect()} == {"Same title\nSame words on every page."}


@pytest.mark.parametrize(
    "wrapper", ["<div class='content has-sidebar'>", "<div id='page' class='right-sidebar'>", "<div class='share'><div class='ad x'>", "<form>"]
)
def test_names_of_wrappers_do_not_remove_the_text(wrapper):
    body = "<p>The text of this page, a sentence of some length.</p><p>And one more.</p>"
    want = "The text of this page, a sentence of some length.\nAnd one more."
    menu = "<nav>Home</nav><div class='sidebar'>Side</div>"
    for inner in (f"<article>{body}</article>", f"<div>{body}</div>"):
        assert html_text.extracted(f"<body>{menu}{wrapper}{inner}<div class='widget'>Box</div>", frozenset()) == want
    talk = "<div id='comments'>" + "<p>A comment that goes on and on.</p>" * 20 + "</div>"
    assert html_text.extracted(f"<body>{menu}<article>{body}</article>{talk}", frozenset()) == want


def test_counts_decide_on_pages_with_articles(spark):
    def page(i):
        teasers = "".join(f"<article><p>Teaser {k}</p></article>" for k in range(2))
        links = f'<div class="q7"><a href="/{i}">See also {i}</a></div>'
        body = "".join(f"<p>Paragraph {i}-{k} of the text of this page.</p>" for k in range(4))
        return i, f"http://a.example/{i}", f"<body><div class=z1>{teasers}</div><div class=b>{body}</div><p>All rights kept.</p>{links}"

    def beside(i):
        text = f"<article><p>The article number {i}, longer than the rest.</p></article><div class=k><p>Beside {i}.</p></div>"
        return i, f"http://b.example/{i}", f"<body>{text}<ul><li>Terms of use</ul>"

    rows = [page(i) for i in range(8)] + [beside(i) for i in range(20, 28)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text.split("\n") for r in html_text.main_text(pages).collect()}
    assert got[3] == [f"Paragraph 3-{k} of the text of this page." for k in range(4)]
    assert got[23] == ["The article number 23, longer than the rest.", "Beside 23."]


def test_short_rotating_boxes_beside_long_articles_go(spark):
    def page(i):
        text = "".join(f"<p>Paragraph {i}-{k} of the article of this page.</p>" for k in range(12))
        box = f"<div class=z2>Offer number {i}.</div>"
        return i, f"http://a.example/{i}", f"<body>{box}<article>{text}</article><div class=k><p>{f'Beside {i}, at length. ' * 9}</p></div>"

    pages = spark.createDataFrame([page(i) for i in range(6)], "page_id long, url string, html string")
    for r in html_text.main_text(pages).collect():
        lines = r.text.split("\n")
        assert lines == [f"Paragraph {r.page_id}-{k} of the article of this page." for k in range(12)] + [(f"Beside {r.page_id}, at length. " * 9).strip()]


def test_templates_do_not_depend_on_the_size_of_the_host(spark):
    def page(i):
        box = "<div class=q><p>Spring offers of this section</p></div>" if i < 5 else "<div class=q><p>Twice</p></div>" if i < 7 else ""
        return i, f"http://a.example/{i}", f"<body>{box}<div><p>The text of page {i}, longer than boxes.</p></div></body>"

    for size in (40, 400):
        pages = spark.createDataFrame([page(i) for i in range(size)], "page_id long, url string, html string")
        got = {r.page_id: r.text for r in html_text.main_text(pages).collect()}
        for i in range(size):
            assert got[i] == ("Twice\n" if 5 <= i < 7 else "") + f"The text of page {i}, longer than boxes."


def test_extraction_of_awkward_pages(spark):
    rows = [(1, None, None, "x"), (None, "http://h/1", "", "x"), (2, "no url", "<p>a</p>", None), (2, "no url", "<p>a</p>", None)]
    rows.append((3, "http://h/2", "<article>" + "<p>word</p>" * 50_000 + "</article>", "x"))
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    found = html_text.main_text(pages.withColumn("host", pages.url).withColumn("hash", pages.page_id))
    got = Counter((r.page_id, len(r.text)) for r in found.collect())
    assert got == Counter([(1, 0), (None, 0), (2, 1), (2, 1), (3, 250_000 - 1)])
    assert html_text.main_text(pages.limit(0)).count() == 0


# ------------------------------------------------------------------ WARC


def test_archives_round_trip(spark, pages):
    copies = pages.unionByName(pages.limit(5).selectExpr("page_id + 1000 AS page_id", "concat(url, '?b=é 1') AS url", "html"))
    archives = warc.write(copies)
    rows = {r.page_id: r for r in warc.read(archives).collect()}
    html = {r.page_id: (r.html or "").encode() for r in copies.collect()}
    url = {r.page_id: r.url for r in copies.collect()}
    last = {}
    for i, payload in html.items():
        last[payload] = max(i, last.get(payload, -1))
    assert set(rows) == set(html)
    for i, payload in html.items():
        r = rows[i]
        response = last[payload] == i
        assert r.record_type == ("response" if response else "revisit") and r.target == url[i]
        assert r.refers_to == (None if response else last[payload])
        assert r.payload_bytes == len(payload) and bytes(r.payload) == (payload if response else b"")
        assert r.payload_digest == base64.b32encode(hashlib.sha1(payload).digest()).decode()
    folder = archives.first().path.rpartition("/")[0]
    assert warc.read_files(spark, folder, with_payload=False).count() == len(html)


def test_small_payloads_are_never_revisits(spark):
    pages = spark.createDataFrame([(1, "u", "abc"), (2, "u", "abc"), (3, "u", "abcdef"), (4, "u", "abcdef")], "page_id long, url string, html string")
    rows = {r.page_id: r.record_type for r in warc.read(warc.write(pages, least=4)).collect()}
    assert rows == {1: "response", 2: "response", 3: "revisit", 4: "response"}


def test_archives_of_awkward_pages(spark):
    rows = [(None, None, None, 1), (None, None, None, 1), (1, None, "", 1), (2, "a\r\nWARC-Type: x", "", 1), (3, "u", "x" * 3_000_000, 1), (3, "u", "x" * 3_000_000, 1)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, sha int")
    got = Counter((r.page_id, r.record_type, r.refers_to, r.payload_bytes) for r in warc.read(warc.write(pages)).collect())
    assert got == Counter({
        (None, "response", None, 0): 2,
        (1, "revisit", 2, 0): 1,
        (2, "response", None, 0): 1,
        (3, "response", None, 3_000_000): 2,
    })
    assert warc.read(warc.write(pages.limit(0))).count() == 0


def archive(*records, dictionary=b""):
    shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    compressor = zstandard.ZstdCompressor(dict_data=shared)
    return warc.preamble(dictionary) + b"".join(compressor.compress(r) for r in records)


def record(payload=b"hello", kind="response", **changes):
    fields = {"kind": kind, "record_id": "urn:page:1", "target": "http://x/", "digest": warc.sha1(payload), "payload_bytes": len(payload)}
    return warc.Record(**(fields | {"payload": payload} | changes))


def test_reader_takes_small_chunks_and_both_dictionary_forms(monkeypatch):
    monkeypatch.setattr(warc, "CHUNK", 7)
    samples = [warc.encoded(record(f"payload number {i} of many".encode() * 3)) for i in range(300)]
    trained = zstandard.train_dictionary(2000, samples).as_bytes()
    for dictionary in (b"", trained):
        found = list(warc.records(io.BytesIO(archive(*samples, dictionary=dictionary))))
        assert [r.payload for r in found] == [f"payload number {i} of many".encode() * 3 for i in range(300)]
    packed = zstandard.ZstdCompressor().compress(trained)
    shared = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(trained))
    raw = warc.preamble(packed) + shared.compress(samples[0])
    assert len(list(warc.records(io.BytesIO(raw)))) == 1


@pytest.mark.parametrize(
    ("raw", "message"),
    [
        (archive(b"HTTP/1.1 200 OK\r\n\r\n"), "WARC header"),
        (archive(warc.encoded(record()) + b"more"), "goes on"),
        (archive(warc.encoded(record()) * 2), "goes on"),
        (archive(warc.encoded(record()).replace(b"hello", b"jello")), "digest"),
        (archive(warc.encoded(record()).replace(b"WARC-Date", b"WARC-Dote")), "lacks"),
        (archive(warc.encoded(record()))[:-9], "within a frame"),
        (warc.preamble(b"x" * 99)[:50], "cut off"),
    ],
)
def test_reader_refuses(raw, message):
    with pytest.raises(ValueError, match=message):
        list(warc.records(io.BytesIO(raw)))


@pytest.mark.parametrize("chunk", [1, 3, 1 << 20])
def test_an_archive_cut_anywhere_raises_or_ends(monkeypatch, chunk):
    """No cut makes the reader wait for bytes that never come."""
    monkeypatch.setattr(warc, "CHUNK", chunk)
    frame = zstandard.ZstdCompressor().compress(warc.encoded(record()))
    dictionary = zstandard.train_dictionary(1 << 10, [f"sample {i} of texts".encode() * 9 for i in range(200)]).as_bytes()
    raw = warc.preamble(dictionary)[: 8 + len(dictionary)] + frame

    class Counted(io.BytesIO):
        empty = 0

        def read(self, size=-1):
            got = super().read(size)
            self.empty += not got
            assert self.empty < 3, "the reader asks on after the end"
            return got

    for cut in [*range(1, 12), 8 + len(dictionary) - 1, 8 + len(dictionary) + 3, len(raw) - 1]:
        with pytest.raises((ValueError, zstandard.ZstdError)):
            list(warc.records(Counted(raw[:cut])))
    assert list(warc.records(Counted(raw[: 8 + len(dictionary)]))) == []
    assert len(list(warc.records(Counted(raw)))) == 1


def test_optional_fields_of_foreign_records():
    plain = warc.encoded(record())
    bare = b"\r\n".join(line for line in plain.split(b"\r\n") if not line.startswith(b"WARC-Payload-Digest"))
    assert warc.decoded(bare).digest == warc.sha1(warc.decoded(plain).payload)
    other = plain.replace(b"sha1:", b"md5:")
    assert warc.decoded(other).digest == warc.sha1(warc.decoded(plain).payload)
    again = warc.encoded(record(kind="revisit")).replace(b"WARC-Refers-To", b"WARC-Other")
    assert warc.decoded(again).refers_to is None and warc.decoded(again).kind == "revisit"
    with pytest.raises(ValueError, match="digest"):
        warc.decoded(plain.replace(b"hello", b"jello"))


def test_reader_misses_records_that_were_reported(spark, pages):
    archives = warc.write(pages.limit(10)).selectExpr("path", "n_records + 1 AS n_records")
    with pytest.raises(Exception, match="not 1[01]|holds"):
        warc.read(archives).collect()


# ------------------------------------------------------------------ nearest neighbours


def exact(ids, x, k):
    out = {}
    for i, own in enumerate(ids):
        score = x @ x[i]
        order = [j for j in np.lexsort((ids, -score)) if ids[j] != own][:k]
        out[own] = [(int(ids[j]), float(score[j])) for j in order]
    return out


def answers(frame):
    out = defaultdict(list)
    for r in frame.orderBy("query_id", "rank").collect():
        assert r.rank == len(out[r.query_id]) + 1
        out[r.query_id].append((r.vec_id, r.score))
    return out


def test_recall_against_all_vectors(spark):
    folder = "/root/testdata/sf0.1"
    rows = spark.read.parquet(f"{folder}/embeddings.parquet").collect()
    ids, x = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows])
    want, got = exact(ids, x, 20), answers(queries.op2_nearest_neighbours(spark, folder))
    assert set(got) == {i for i in ids if i % 20 == 0}
    hits = 0
    for i, found in got.items():
        assert len(found) == 20 and found == sorted(found, key=lambda f: (-f[1], f[0]))
        for j, score in found:
            assert score == pytest.approx(float(x[ids == i][0] @ x[ids == j][0]), abs=1e-12)
        hits += len({j for j, _ in found} & {j for j, _ in want[i]})
    assert hits / (20 * len(got)) >= 0.9


def test_clustered_vectors_need_few_buckets(spark):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(60, 16)) * 5
    x = np.concatenate([c + rng.normal(size=(50, 16)) * 0.1 for c in centres])
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    distinct = neighbours.classes(neighbours.usable(frame, "vec_id", "embedding"), 5)
    projections = neighbours.fitted(distinct, 5)
    stored = projections.stored(0, x)
    share = np.mean([np.isin(stored, projections.probed(0, x[i])).mean() for i in range(0, 3000, 100)])
    assert share < 0.3
    got, want = answers(neighbours.search(frame, frame.where("vec_id % 50 = 0"), k=5)), exact(np.arange(3000), x, 5)
    hits = sum(len({j for j, _ in f} & {j for j, _ in want[i]}) for i, f in got.items())
    assert hits / (5 * len(got)) >= 0.9


def test_probes_come_in_the_order_of_success():
    projections = neighbours.Projections(8, 3, 1.0, 1.0)
    rng = np.random.default_rng(2)
    query = rng.normal(size=8)
    query /= np.linalg.norm(query)
    probes = projections.probed(0, query)
    near = np.array([query + rng.normal(size=8) / np.sqrt(8) for _ in range(6000)])
    near /= np.linalg.norm(near, axis=1)[:, None]
    share = [np.mean(projections.stored(0, near) == p) for p in probes]
    assert len(set(probes.tolist())) == len(probes)
    half = len(share) // 2
    assert sum(share[:half]) > sum(share[half:]) and 0.3 < sum(share) < 0.9


def test_ties_copies_and_vectors_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [1.0, 0.0]) for i in range(0, 60)]
    rows += [(100, [0.5, 0.5]), (101, None), (102, []), (103, [0.0, 0.0]), (104, [nan, 1.0]), (105, [inf, 1.0])]
    rows += [(106, [None, 1.0]), (107, [1.0, 2.0, 3.0]), (None, [1.0, 1.0]), (120, [0.0, 1.0]), (120, [0.0, 1.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 AS score", "'x' AS vec")
    got = answers(neighbours.search(frame, frame.where("vec_id % 20 = 0 or vec_id > 100"), k=20))
    assert set(got) == {0, 20, 40, 100, 120}
    assert got[0] == [(i, 1.0) for i in range(1, 21)]
    assert got[20] == [(i, 1.0) for i in range(20)]
    assert got[120] == [(100, 0.5)] + [(i, 0.0) for i in range(19)]
    few = spark.createDataFrame([(0, [3.0, 4.0]), (20, [-1.0, 0.0]), (21, [0.0, 2.0])], "vec_id long, embedding array<float>")
    assert answers(neighbours.search(few, few.where("vec_id % 20 = 0"), k=20)) == {
        0: [(21, 8.0), (20, -3.0)],
        20: [(21, 0.0), (0, -3.0)],
    }
    assert neighbours.search(few.limit(0), few.limit(0)).count() == 0


@pytest.mark.parametrize("n", [60, 5000])
def test_distinct_vectors_with_one_score_go_by_their_ids(spark, monkeypatch, n):
    """The query is (1, 0, 0); all others share its first component and differ in the rest."""
    # all buckets are visited, so that only the order of ties is left to chance
    monkeypatch.setattr(neighbours, "SUCCESS", 1.1)
    ids = list(range(1, n + 1))
    random.Random(9).shuffle(ids)
    turns = [2 * np.pi * i / n for i in range(n)]
    rows = [(v, [0.5, float(np.cos(t)), float(np.sin(t))]) for v, t in zip(ids, turns, strict=True)] + [(0, [1.0, 0.0, 0.0])]
    # the second row of a vector has a larger id than all
    rows += [(100_000 + v, vec) for v, vec in rows[:10]]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(7)
    got = answers(neighbours.search(frame, frame.where("vec_id = 0"), k=20))
    assert got == {0: [(i, 0.5) for i in range(1, 21)]}


def test_queries_without_candidates_are_compared_with_all(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "SUCCESS", 0.0001)
    monkeypatch.setattr(neighbours, "BUCKETS_FOR", 1)
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 6))
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = answers(neighbours.search(frame, frame.where("vec_id % 20 = 0"), k=20))
    assert len(got) == 15 and all(len(f) == 20 for f in got.values())


def test_success_is_reached_at_every_size():
    rng = np.random.default_rng(4)
    for n in (20_000, 30_000_000, 10**9):
        projections = neighbours.Projections(8, neighbours.depth_for(n), 1.0, 1.0)
        for query in rng.normal(size=(20, 8)):
            assert projections.probed(0, query) is not None
    deep = neighbours.Projections(8, 11, 1.0, 1.0)
    assert all(deep.probed(0, query) is None for query in rng.normal(size=(5, 8)))


def test_queries_beyond_the_beam_are_compared_with_all(spark, monkeypatch):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(3000, 8))
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    monkeypatch.setattr(neighbours, "BEAM", 2)
    monkeypatch.setattr(neighbours, "depth_for", lambda n: 3)
    got, want = answers(neighbours.search(frame, frame.where("vec_id % 50 = 0"), k=10)), exact(np.arange(3000), x, 10)
    assert all([j for j, _ in got[i]] == [j for j, _ in want[i]] for i in range(0, 3000, 50))


@pytest.mark.parametrize(("noise", "beam"), [(0.2, 2048), (0.4, 2048), (0.2, 64)])
def test_recall_of_each_part_of_a_table_of_mixed_density(spark, monkeypatch, noise, beam):
    monkeypatch.setattr(neighbours, "BEAM", beam)
    rng = np.random.default_rng(6)
    tight = [c + rng.normal(size=(60, 64)) * noise for c in rng.normal(size=(60, 64))]
    x = np.concatenate([*tight, rng.normal(size=(2400, 64))])
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got, want = answers(neighbours.search(frame, frame.where("vec_id % 60 = 0"), k=20)), exact(np.arange(6000), x, 20)
    for part in (range(0, 3600, 60), range(3600, 6000, 60)):
        hits = sum(len({j for j, _ in got[i]} & {j for j, _ in want[i]}) for i in part)
        assert hits / (20 * len(part)) >= 0.88


# ------------------------------------------------------------------ pipeline


def test_pipeline_stages(spark, sf_dir, tokenizer):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, frames = docs.columns, [docs]
    assert [name for name, _ in corpus_pipeline.STAGES][0] == "quality classifier" and len(corpus_pipeline.STAGES) == 5
    for _, stage in corpus_pipeline.STAGES[:-1]:
        from tripmart.llm.shared import written

        frames.append(written(stage(spark, frames[-1], sf_dir)))
        assert frames[-1].columns == columns
    rows = [{r.doc_id: r for r in f.collect()} for f in frames]
    from test_duplicates import plain_clusters, plain_cut

    groups = plain_clusters({i: r.text for i, r in rows[1].items()})
    assert set(rows[2]) == {i for i, (_, root) in groups.items() if i == root}
    want = plain_cut([(i, r.text) for i, r in rows[2].items()])
    for i, r in rows[3].items():
        assert r.text.encode() == want[i][1].decode(errors="ignore").encode() and r.n_chars == len(r.text)
    copies = Counter(r.doc_id for r in frames[4].collect())
    assert set(copies) <= set(rows[3]) and max(copies.values()) <= 2
    packed = corpus_pipeline.STAGES[-1][1](spark, frames[4], sf_dir).collect()
    tokens = sum(r.length for r in packed)
    assert tokens == sum(n * (len(tokenizer.encode(rows[3][i].text, add_special_tokens=False).ids) + 1) for i, n in copies.items())
    assert len({r.sequence_id for r in packed}) <= 1.02 * -(-tokens // 1024)


def test_pipeline_keeps_clean_documents_and_drops_junk(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = {r.doc_id for r in corpus_pipeline.quality(spark, docs, folder).collect()}
    labels = spark.read.parquet(f"{folder}/labels.parquet").collect()
    assert all((r.doc_id in kept) == (r.quality == 1) for r in labels if r.quality is not None)


def test_pipeline_of_awkward_rows(awkward, nothing, spark, sf_dir, tokenizer):
    from test_duplicates import plain_cut

    from tripmart.llm.shared import written

    docs = awkward.select("doc_id", "text", "lang", "source", "n_chars")
    once = written(corpus_pipeline.near_dedup(spark, docs.union(docs), sf_dir))
    # a copy of a row, of a text and a near copy go; rows without words are alike only in that
    kept = Counter((r.doc_id, r.text and r.text[:9]) for r in once.collect())
    assert kept == {
        (1, "the quick"): 1, (3, None): 2, (None, "a text wi"): 1, (None, None): 2, (4, ""): 2, (5, " \n\t "): 2,
        (6, "word0 and"): 1, (8, "naïve caf"): 1,
    }
    cut = written(corpus_pipeline.passage_dedup(spark, once, sf_dir))
    texts = sorted({(9 if r.doc_id is None else r.doc_id, r.text or "") for r in once.collect()})
    want = plain_cut([(n, t) for n, (_, t) in enumerate(texts)])
    left = {texts[n]: body.decode(errors="ignore") for n, (_, body, _) in want.items()}
    assert Counter(r.text for r in cut.collect()) == Counter(
        left[9 if r.doc_id is None else r.doc_id, r.text or ""] for r in once.collect()
    )
    mixed = written(corpus_pipeline.mix(spark, cut, sf_dir))
    before, after = (Counter((r.doc_id, r.text) for r in f.collect()) for f in (cut, mixed))
    assert set(after) <= set(before) and all(n <= 2 * before[k] for k, n in after.items())
    packed = corpus_pipeline.pack(spark, mixed, sf_dir).collect()
    tokens = sum(n * (len(tokenizer.encode(t or "", add_special_tokens=False).ids) + 1) for (_, t), n in after.items())
    assert sum(r.length for r in packed) == tokens and tokens > 0
    for _, stage in corpus_pipeline.STAGES[1:]:
        assert stage(spark, nothing, sf_dir).collect() == []
