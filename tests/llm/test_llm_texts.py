"""Fingerprints and HTML extraction, and the pipeline made of the operators."""

from __future__ import annotations

import hashlib
import html as H
import random
import re

import pytest

from filelens.llm import fingerprints as FP
from filelens.llm import html_extraction as X


def test_query_equals_the_plain_definition(spark, sf, documents):
    from filelens.llm.queries import QUERIES

    rows = {r.doc_id: r for r in QUERIES["op3_fingerprints"](spark, sf).collect()}
    assert len(rows) == len(documents)
    for d, n in zip(documents, documents[1:] + documents[:1], strict=True):
        text, after, r = d[1], n[1], rows[d[0]]
        cut = len(text) // 4
        edited = text[: len(text) - cut] + after[:cut]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert (r.fingerprint, r.edited_fingerprint) == tuple(FP.fingerprints([text, edited]))
        assert r.near_edited == pytest.approx(FP.likeness(*FP.fingerprints([text, edited])))
        assert r.near_next == pytest.approx(FP.likeness(*FP.fingerprints([text, after])))
    long = [r for r in rows.values() if r.n_chars > 800]
    assert sum(r.near_edited for r in long) / len(long) > 0.6 > 0.1 > sorted(r.near_next for r in long)[len(long) // 2]


def test_chunks_move_with_the_content():
    rng = random.Random(4)
    text = "".join(rng.choices("abcdefg hijkl mnop", k=6000))
    assert FP.likeness(*FP.fingerprints([text, "some new beginning " + text])) > 0.95
    assert FP.likeness(*FP.fingerprints([text, text[2000:]])) > 0.95
    assert FP.fingerprints([text, "x", text])[0] == FP.fingerprints([text])[0]
    assert FP.likeness("", "") == 1 and FP.likeness("", FP.fingerprints(["abc"])[0]) == 0
    ends = FP.chunk_ends([text.encode()])[0]
    sizes = [b - a for a, b in zip([0, *ends[:-1]], ends, strict=True)]
    assert max(sizes) <= FP.MOST and min(sizes[:-1]) >= FP.LEAST and FP.LEAST < sum(sizes) / len(sizes) < 2 * FP.NORMAL


def test_next_rows_of_odd_tables(spark, odd, none):
    rows = FP.compare_with_next(odd).collect()
    assert len(rows) == odd.count() and all(0 <= r.near_next <= 1 and 0 <= r.near_edited <= 1 for r in rows)
    one = FP.compare_with_next(odd.where("doc_id = 6")).collect()
    assert len(one) == 1 and one[0].near_next == 1 == one[0].near_edited
    assert FP.compare_with_next(none).count() == 0


@pytest.mark.parametrize("n", [2, 7, 100])
def test_next_rows_across_ranges(spark, n):
    docs = [(i * 3, f"text number {i} " * (1 + i % 4)) for i in range(n)]
    df = spark.createDataFrame(docs[::-1], "doc_id bigint, text string").repartition(5)
    got = {r.doc_id: r.edited_sha256 for r in FP.compare_with_next(df).collect()}
    for (i, t), (_, after) in zip(docs, docs[1:] + docs[:1], strict=True):
        cut = len(t) // 4
        assert got[i] == hashlib.sha256((t[: len(t) - cut] + after[:cut]).encode()).hexdigest()


def brute_chunks(data):
    """Chunks by rolling the hash byte by byte over the last ``SPAN`` bytes."""
    gear = [int.from_bytes(hashlib.sha256(bytes([b])).digest()[:4], "little") for b in range(256)]

    def hash_at(i):
        h = 0
        for b in data[max(0, i - FP.SPAN + 1) : i + 1]:
            h = (h << 1) + gear[b] & 0xFFFFFFFF
        return h

    out, start = [], 0
    while start < len(data):
        end = min(start + FP.MOST, len(data))
        for i in range(start + FP.LEAST - 1, end):
            mask = int(FP.HARD) if i < start + FP.NORMAL else int(FP.EASY)
            if hash_at(i) & mask == 0:
                end = i + 1
                break
        out.append(data[start:end])
        start = end
    return out


def test_fingerprints_against_a_rolling_loop(documents):
    import xxhash

    rng = random.Random(9)
    texts = [d[1] for d in documents][:60] + ["", "é" * 300, "".join(rng.choices("ab \n", k=3000))]
    for text, got in zip(texts, FP.fingerprints(texts), strict=True):
        chunks = set(brute_chunks(text.encode()))
        assert got == "".join(sorted(xxhash.xxh64_hexdigest(c) + f"{len(c):02x}" for c in chunks))
    a, b = (set(brute_chunks(t.encode())) for t in texts[:2])
    both, least = sum(map(len, a & b)), min(sum(map(len, a)), sum(map(len, b)))
    assert FP.likeness(*FP.fingerprints(texts[:2])) == pytest.approx(both / least)


def test_ranges_are_even_at_two_thousand_partitions(spark):
    """Also where one id has a third of the rows, with texts of its own."""
    from filelens.operators.batches import cut_ranges

    df = spark.range(0, 200_000, 1, 8).selectExpr("IF(id % 3 = 0, 77, id) AS doc_id", "xxhash64(id) AS h")
    sizes = [r["count"] for r in cut_ranges(df, ["doc_id", "h"], 2000, "part").groupBy("part").count().collect()]
    assert len(sizes) > 1900 and max(sizes) < 4 * 200_000 / 2000


def test_articles_of_the_pages(spark, sf):
    import duckdb

    from filelens.llm.queries import QUERIES

    rows = {r.page_id: r for r in QUERIES["op5_html_extraction"](spark, sf).collect()}
    pages = duckdb.sql(f"SELECT page_id, html FROM '{sf}/pages.parquet'").fetchall()
    assert len(rows) == len(pages)
    for i, page in pages:
        inner = re.search(r"<article>(.*?)(</article>|$)", page, re.S)[1]
        parts = [" ".join(H.unescape(re.sub(r"<[^>]*>", "", p.replace("<br>", " "))).split()) for p in re.split(r"</?(?:p|h1)>", inner)]
        assert rows[i].text == "\n\n".join(p for p in parts if p) and rows[i].n_chars == len(rows[i].text)


PAGE = """<!DOCTYPE html><html><head><title>T {n}</title><style>p{{}}</style><script>var a="<p>no</p>";</script></head><body class="with-sidebar">
<header><h1>Site</h1></header><nav><ul><li>Home<li>About</ul></nav><div class="cookie-notice">We use cookies {n}</div>
<div class="layout"><div id="c" class="entry"><h2>Title {n}</h2><p>First&nbsp;&amp; only
 paragraph {n}.<p>Second <b>bold</b>, {n}<br>line</div><div class="sidebar">Related {n}</div>
<section id="comments"><p>Nice {n}!</p></section><form><p>Your name {n}</p></form></div><footer>&copy; {n}</footer></body></html>"""


def test_slot_of_a_host_without_article_marks(spark):
    pages = [(i, f"http://h.example/{i}", PAGE.format(n=f"number{i}")) for i in range(6)] + [(9, "http://other.example/", PAGE.format(n="x"))]
    rows = {r.page_id: r.text for r in X.extract_text(spark.createDataFrame(pages, "page_id bigint, url string, html string")).collect()}
    for i, _, p in pages:
        n = p[p.index("<title>T ") + 9 : p.index("</title>")]
        assert rows[i] == f"Title {n}\n\nFirst & only paragraph {n}.\n\nSecond bold, {n} line"


LONG_LIST = "<article><h1>Head {n}</h1><p>Intro {n}.</p><ul>" + "<li>A long item of the list, {n}</li>" * 20 + "</ul></article>"
BODY = ("<article><h1>Head {n}</h1><div class=body>" + "<p>A long paragraph of the body, {n}</p>" * 20 + "</div><section class=faq><h2>FAQ {n}</h2></section>"
        "<blockquote>Quote {n}</blockquote></article>")
PLAIN = "<div class=top><h1>Head {n}</h1></div><div class=text><table><tr><td>Cell {n}</td></tr></table>" + "<p>A long paragraph, {n}</p>" * 20 + "</div>"


def test_nothing_unmarked_is_dropped(spark):
    frame = "<html><body><nav><a>Menu {n}</a></nav>%s<footer>Foot {n}</footer></body></html>"
    pages = [(k * 100 + i, f"http://{k}.example/{i}", (frame % page).format(n=f"number {i}")) for k, page in enumerate((LONG_LIST, BODY, PLAIN))
             for i in range(6)]
    pages += [(900 + k, f"http://one{k}.example/", (frame % page).format(n="x")) for k, page in enumerate((LONG_LIST, BODY, PLAIN))]
    rows = {r.page_id: r.text for r in X.extract_text(spark.createDataFrame(pages, "page_id bigint, url string, html string")).collect()}
    for i, _, page in pages:
        inner = page[page.index("</nav>") + 6 : page.index("<footer>")]
        assert rows[i] == "\n\n".join(p for p in re.split(r"<[^>]*>", inner) if p)


def test_odd_pages(spark):
    pages = [(1, None, None), (2, "http://a.b/", ""), (3, "http://a.b/x", "plain text &lt; only"), (3, "http://a.b/x", "plain text &lt; only"),
             (None, "no url", "<p>open <b>tags"), (5, "http://a.b/", "<article><p>cut off &am"), (6, "http://a.b/", "<div><script>never closed <p>x"),
             (7, "http://long.example/", "<body><article>" + "<p>x y</p>" * 20000 + "</article>"), (8, "http://deep.example/", "<div>" * 20000 + "deep")]
    df = spark.createDataFrame([(*p, "extra") for p in pages], "page_id bigint, url string, html string, text string")
    rows = X.extract_text(df).collect()
    texts = {r.page_id: r.text for r in rows}
    assert len(rows) == len(pages)
    assert texts[1] == texts[2] == texts[6] == "" and texts[3] == "plain text < only" and texts[None] == "open tags"
    assert texts[5] == "cut off &am" and texts[7] == "\n\n".join(["x y"] * 20000) and texts[8] == "deep"
    assert X.extract_text(df.limit(0)).count() == 0


def test_pipeline_stages(spark, sf, documents):
    import corpus_pipeline as P

    assert [n for n, _ in P.STAGES] == ["toxicity", "near_dedup", "decontamination", "pii", "bpe"] and P.ORACLE_SQL is None
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out = P.run(spark, sf).collect()
    ids = [r.doc_id for r in out]
    assert len(ids) == len(set(ids)) and set(ids) <= {d[0] for d in documents}
    assert len(ids) > 0.6 * len(documents)
    from filelens.llm import pii

    text = {d[0]: d[1] for d in documents}
    for r in out:  # what the decoded ids say is the text with the patterns' matches replaced, unless terms went too
        plain = pii.replaced(text[r.doc_id], pii.base_spans(text[r.doc_id]))
        assert len(r.token_ids) == r.n_tokens
        if hashlib.sha256(plain.encode()).hexdigest() != r.decoded_sha256:
            assert pii.base_spans(text[r.doc_id])
    for name, stage in P.STAGES[:-1]:
        kept = stage(spark, docs.limit(0), sf)
        assert kept.columns == docs.columns and kept.count() == 0, name


def _extract(spark, pages):
    df = spark.createDataFrame(pages, "page_id bigint, url string, html string")
    return {r.page_id: r.text for r in X.extract_text(df).collect()}


MENU = ("<html><body><div class=x1><p>Start page</p><p>All stories</p><p>Our team</p></div><div class=x2><h1>Head {n}</h1><p>A paragraph, {n}, which is the longest of the page by far.</p>"
        "<p>Read our terms before you go.</p><p>Another one, {n}, is not so long.</p></div></body></html>")


def test_template_text_leaves_the_page_by_deduction_alone(spark):
    """An unmarked menu and a fixed line: without the deduction both would stay on every page."""
    pages = [(i, f"http://m.example/{i}", MENU.format(n=f"number {i}")) for i in range(20)]
    got = _extract(spark, pages)
    want = {i: f"Head {n}\n\nA paragraph, {n}, which is the longest of the page by far.\n\nAnother one, {n}, is not so long."
            for i, n in ((i, f"number {i}") for i in range(20))}
    assert got == want
    alone = X.main_text(pages[0][2], X.Template())
    assert "Start page" in alone and "Read our terms" in alone and alone != want[0]


def brute_template(pages):
    """``pages`` of one host: template containers, common and fixed blocks by whole occurrence vectors."""
    vectors = {}
    for k, page in enumerate(pages):
        blocks, containers = X.read_page(page)
        for token in [(b.key, True) for b in blocks] + [(c.role, False) for c in containers]:
            vectors.setdefault(token, [0] * len(pages))[k] += 1
    classes = {}
    for token, v in vectors.items():
        if sum(map(bool, v)) >= X.SUPPORT * len(pages):
            classes.setdefault(tuple(v), []).append(token)
    valid = {t: v for v, ts in classes.items() if len(ts) >= X.CLASS_SIZE for t in ts}
    often = [t for ts in classes.values() for t in ts]
    return ({k for k, block in valid if not block}, {k for k, block in often if block},
            {k for (k, block), v in valid.items() if block and len(pages) >= X.MIN_PAGES and sum(map(bool, v)) >= X.FIXED * len(pages)})


def test_templates_against_whole_occurrence_vectors(spark, sf):
    import duckdb

    pages = duckdb.sql(f"SELECT url, html FROM '{sf}/pages.parquet'").fetchall()
    hosts = {"menu.example": [MENU.format(n=i) for i in range(9)], "mixed.example": [PAGE.format(n=i % 3) for i in range(7)] + [MENU.format(n=1)] * 2}
    for url, html in pages:
        hosts.setdefault(re.match(r"\w+://([^/?#]*)", url)[1].lower(), []).append(html)
    rows = [(h, f"http://{h}/{k}", p) for h, ps in hosts.items() for k, p in enumerate(ps)]
    got = {r.host: (set(r.frame), set(r.common), set(r.fixed)) for r in X.templates(spark.createDataFrame(rows, "host string, url string, html string")).collect()}
    assert got == {h: brute_template(ps) for h, ps in hosts.items()} and any(f for *_, f in got.values())


def test_names_need_the_template(spark):
    """A section of one article keeps its name; a part that all pages have goes by it."""
    page = ("<html><body><article><h1>Head {n}</h1><p>Long paragraph {n} of the article, with all it has to say.</p>{own}"
            "<div class=\"post-comments\"><p>Nice {n}!</p></div><div class=article-sidebar><p>More on {n}</p></div>"
            "<article class=\"comment\"><p>I agree {n}</p></article></article></body></html>")
    own = {0: "<section class=\"social-history\"><p>Social history.</p></section>", 1: "<section id=\"notice-of-death\"><p>They died.</p></section>"}
    pages = [(i, f"http://n.example/{i}", page.format(n=f"number {i}", own=own.get(i, ""))) for i in range(8)]
    got = _extract(spark, pages)
    for i in range(8):
        extra = {0: "\n\nSocial history.", 1: "\n\nThey died."}.get(i, "")
        assert got[i] == f"Head number {i}\n\nLong paragraph number {i} of the article, with all it has to say." + extra


def test_attributes_as_html_reads_them():
    page = "<p title=it's>First para.</p><p>Second don't stop.</p><div data-x='a>b' class=\"a > b\">Third</div><br/><p a=\"x>Never closed"
    assert X.main_text(page, X.Template()) == "First para.\n\nSecond don't stop.\n\nThird\n\nNever closed"
    assert X.main_text("<DIV CLASS='Cookie-Notice'>no</DIV><div class=no-sidebar>yes</div><p hidden>x</p>", X.Template()) == "yes\n\nx"
    assert X.main_text("<script a='>'>no</script x><p>a < b</p><div hidden>no</div><div aria-hidden=true>no</div>", X.Template()) == "a < b"


def test_deep_pages_take_linear_memory():
    import tracemalloc

    page = "<div>" * 20_000 + "deep" + "</div>" * 20_000
    tracemalloc.start()
    assert X.main_text(page, X.Template()) == "deep"
    assert X.slot_sums(page, X.Template())[0][2:] == (4, 4)
    assert tracemalloc.get_traced_memory()[1] < 100 << 20
    tracemalloc.stop()


def test_pipeline_over_repeated_rows_and_extra_columns(spark, sf, documents):
    """Every stage passes columns of any name on; of a repeated row one is left from the second stage on."""
    import corpus_pipeline as P

    rows = [(d[0], d[1], d[2], d[3], d[4], "x", 0.5, 1, [1], None) for d in documents[:60]]
    extra = "score string, predicted double, h1 int, spans array<int>, text_key string"
    docs = spark.createDataFrame(rows + rows[:20] + [(None, None, None, None, None, None, None, None, None, None)] * 2,
                                 f"doc_id bigint, text string, lang string, source string, n_chars bigint, {extra}")
    for k, (name, stage) in enumerate(P.STAGES):
        out = stage(spark, docs, sf)
        kept = out.collect()
        if k < len(P.STAGES) - 1:
            assert out.columns == docs.columns, name
            assert all((r.score, r.h1, r.spans) == ("x", 1, [1]) for r in kept if r.doc_id is not None), name
            docs = spark.createDataFrame(kept, docs.schema)
        if k:
            ids = [r.doc_id for r in kept]
            assert len(ids) == len(set(ids)), name
    assert {"token_ids", "n_tokens", "ids_sha256", "decoded_sha256"} <= set(out.columns) and len(kept) > 30
