"""Language identification and main text of pages."""

import html
import random
import re

import numpy as np
import pytest

from llm_data import SF, empty, messy, messy_rows, needs_tables
from retailflow.llm import html_text, language, queries

EN = "the house and the river are with us when they have been there".split()
DE = "der hund und die katze sind nicht über das grüne feld gelaufen".split()
RU = "это не только слова но и предложения которые были здесь".split()


def labelled(spark):
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choice(w) for _ in range(30)), lang, None, None) for i, (w, lang) in enumerate([(EN, "en"), (DE, "de"), (RU, "ru")] * 40)]
    return spark.createDataFrame(rows + [(999, "nothing", None, None, None)], "doc_id long, text string, lang string, source string, n_chars long")


@pytest.fixture(scope="module")
def model(spark):
    return language.learn(labelled(spark))


def plain_viterbi(scores, switch):
    best, back = list(scores[0]), []
    for row in scores[1:]:
        step, new = [], []
        for j in range(len(row)):
            options = [best[i] - (switch if i != j else 0) for i in range(len(row))]
            i = j if options[j] >= max(options) else max(range(len(row)), key=lambda x: options[x])
            step.append(i)
            new.append(options[i] + row[j])
        back.append(step)
        best = new
    path = [max(range(len(best)), key=lambda x: best[x])]
    for step in reversed(back):
        path.append(step[path[-1]])
    return path[::-1], max(best)


def cost(path, scores, switch):
    return sum(scores[t][p] for t, p in enumerate(path)) - switch * sum(a != b for a, b in zip(path, path[1:]))


def test_viterbi_finds_the_best_path_of_every_text():
    rng = np.random.default_rng(3)
    count = np.array([0, 5, 1, 40, 0, 17, 3])
    first = np.cumsum(count) - count
    scores = rng.normal(size=(int(count.sum()), 3)).astype(np.float32) * 3
    got = language.viterbi(scores, first, count, 4.0)
    for f, c in zip(first, count):
        if c:
            _, best = plain_viterbi(scores[f: f + c].tolist(), 4.0)
            assert cost(got[f: f + c].tolist(), scores[f: f + c].tolist(), 4.0) == pytest.approx(best, abs=1e-3)


def test_labels_of_hundreds_of_languages():
    scores = np.zeros((5, 300))
    scores[:, 290] = 3
    assert language.viterbi(scores, np.array([0, 3]), np.array([3, 2])).tolist() == [290] * 5


def test_sample_limit_holds_for_any_number_of_rows():
    assert language.sample_limit(4000, 3000) == language.sample_limit(4000, 4000) == 2 ** 63 - 1
    for n in (4001, 10 ** 6, 10 ** 11, 10 ** 15):
        share = (language.sample_limit(4000, n) + 2 ** 63 + 1) / 2 ** 64
        assert abs(share * n - 4000) < 1


def test_words_are_runs_of_one_script():
    w = language.Words(["Ab1c", "", "дом-house", "it's 你好world"])
    points = " ".join(["Ab1c", "", "дом-house", "it's 你好world", ""])
    assert [points[a:b] for a, b in zip(w.start, w.stop)] == ["Ab", "c", "дом", "house", "it", "s", "你好", "world"]
    assert w.text.tolist() == [0, 0, 2, 2, 3, 3, 3, 3]
    assert len(w.bucket) == int(w.size.sum()) and (w.size == w.stop - w.start + 1).all()


def test_spans_of_mixed_text(model):
    text = " ".join(EN) + ". " + " ".join(DE) + " " + " ".join(RU)
    langs, scores, spans = language.predict(model, [text, "", " ".join(DE)])
    assert [s["lang"] for s in spans[0]] == ["en", "de", "ru"]
    assert text[spans[0][2]["start"]: spans[0][2]["stop"]] == " ".join(RU)
    assert langs[1:] == ["und", "de"] and scores[1:] == [0.0, 1.0] and 0 < scores[0] < 0.5


def test_scripts_narrow_candidates(model):
    langs, _, _ = language.predict(model, ["xyz", "щщщ", "αβγ", "123"])
    assert langs[0] in ("de", "en") and langs[1] == "ru" and langs[2] in ("de", "en", "ru") and langs[3] == "und"


def test_identify_awkward_rows(spark, model):
    out = language.identify(messy(spark), model)
    rows = out.collect()
    assert len(rows) == len(messy_rows())
    for r in rows:
        letters = any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred == "und") == (not letters) and 0 <= r.score <= 1 and (r.lang_pred in ("und", "de", "en", "ru"))
        assert bool(r.spans) == letters
    assert language.identify(empty(spark), model).collect() == []
    nothing = language.learn(empty(spark))
    assert {(r.lang_pred, r.score) for r in language.identify(messy(spark), nothing).collect()} == {("und", 0.0)}


@needs_tables
def test_op4_on_held_out_documents(spark):
    truth = {r.doc_id: r.lang for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang").collect()}
    got = queries.op4(spark, "/root/testdata/sf0.01").collect()
    import zlib
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got) and len(got) == len(truth)
    held = [r for r in got if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.98 * len(held)


# Pages

def text_of(source):
    return "\n".join(html_text.Page(source).article({}, set()))


@pytest.mark.parametrize("source, want", [
    ("", ""), ("just text", "just text"), ("<p>a &lt; b &amp; c&nbsp;d &#233; &copy", "a < b & c d é ©"),
    ("<article><h1>T</h1><p>one\n  two</p><p>three<br>four</article><footer>no</footer>", "T\none two\nthree\nfour"),
    ("<nav>no</nav><main><p>yes <b>bold</b>ly</p><aside>no</aside><form>no<input></form></main>", "yes boldly"),
    ("<body><header>no</header><article><header><h1>yes</h1></header><p>p</article>", "yes\np"),
    ("<article>a<script>var x='</p><article>';</script>b<style>p{}</style><!-- c --></article>", "ab"),
    ("<article>a<div class='ad'>no</div><div class=comments>no<p>no</div><p class='cookie-notice'>no<p>b</article>", "a\nb"),
    ("<div id=menu>no</div><div class='post no-sidebar'><p>yes yes yes</p></div><div class=sidebar>no</div>", "yes yes yes"),
    ("<article><p>unclosed <i>tags<p>go on</article><p>outside", "unclosed tags\ngo on"), ("<article>x<!-- open", "x"), ("<article><p title='a>b'>q</p> <a href=\"x\">link</a>", "q\nlink"),
    ("<div><div><p>" + "long text " * 30 + "</p></div><div><ul><li>a</li></ul></div></div>", ("long text " * 30).strip()),
    ("<article><div class='entry-header'><h1>Title</h1></div><p>x</p><ol class='comment-list'><li>no</ol></article>", "Title\nx"),
    ("<div class='site-header'>no</div><main>yes<div role=complementary>no</div><div class='cookie_banner'>no</div></main>", "yes"),
    ("<article><p class=it's>a</p><p title=\"x>y\">b</p><p \">c</p>don't</article>", "a\nb\nc\ndon't"),
    ("<article hidden>no</article><article>yes</article>", "yes"), ("<article>5 < 6 and 7 > 3</article>", "5 < 6 and 7 > 3")])
def test_text_of_single_pages(source, want):
    assert text_of(source) == want


def site(n):
    """Pages of one host without helpful names: template text around data."""
    rng = random.Random(n)
    line = lambda: " ".join("".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(40))
    pages = []
    for i in range(n):
        a, b = line(), line()
        pages.append((i, f"https://H.example/p{i}", f"<body><div class=x1><div class=q1>Menu one</div><div class=q2>Menu two and more words that fill the page {'so very ' * 60}"
                      f"</div></div><div class=x2><div class=q3><p>Always here.</p><p>{a}</p><p>{b}</p></div></div><div class=x3>Imprint</div></body>", f"{a}\n{b}"))
    return pages


def test_template_of_a_host_is_deduced(spark):
    pages = site(20)
    df = spark.createDataFrame([p[:3] for p in pages], "page_id long, url string, html string").repartition(4)
    got = {r.page_id: r.text for r in html_text.extract(df).collect()}
    assert got == {p[0]: p[3] for p in pages}


def extracted(spark, pages):
    df = spark.createDataFrame([p[:3] for p in pages], "page_id long, url string, html string").repartition(4)
    return {r.page_id: r.text for r in html_text.extract(df).collect()}


@pytest.mark.parametrize("n", [1, 2, 7, 8, 100])
@pytest.mark.parametrize("named", [True, False])
@pytest.mark.parametrize("title", ["Same", None])
def test_equal_pages_keep_their_article(spark, n, named, title):
    """Pages of one host that are all alike, or but for their titles."""
    box = "<article>{}</article>" if named else "<div class=z1><div class=z2>{}</div></div>"
    long_ = "words of the article " * 20
    pages = [(i, "https://same.example/p", "<body><div class=menu>no</div>" + box.format(f"<h1>{title or 'Title %d' % i}</h1><p>One {long_}</p><p>Two {long_}</p>") + "<footer>no</footer>",
              f"{title or 'Title %d' % i}\nOne {long_.strip()}\nTwo {long_.strip()}") for i in range(n)]
    assert extracted(spark, pages) == {p[0]: p[3] for p in pages}


def test_pages_without_a_url_are_hosts_of_their_own(spark):
    pages = [(i, None if i % 2 else "no host", "<article><p>all alike</p></article>", "all alike") for i in range(20)]
    assert extracted(spark, pages) == {p[0]: p[3] for p in pages}


def test_the_template_decides_where_names_do_not(spark):
    """The same pages with and without their host's template: the longest text is the menu's."""
    pages = site(20)
    assert extracted(spark, pages) == {p[0]: p[3] for p in pages}
    alone = [(i, f"https://h{i}.example/", source, want) for i, _, source, want in pages]
    assert all(extracted(spark, alone)[p[0]] != p[3] for p in pages)


def test_extract_of_awkward_rows(spark):
    rows = [(1, None, None, 0), (2, "", "", 0), (3, "x", "<p>t", 0), (3, "x", "<p>t", 0), (None, "//a/b", "<article>é</article>", 0), (5, "http://a/", "<article>" + "w " * 50_000, 0)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, host int")
    df = df.withColumns({c: df.host for c in ("data", "fixed", "page", "role", "_row")})
    out = html_text.extract(df)
    assert set(out.columns) >= {"page_id", "url", "text", "n_chars", "data", "fixed", "page"}
    got = sorted(((r.page_id, r.text[:9], r.n_chars) for r in out.collect()), key=repr)
    assert got == sorted([(1, "", 0), (2, "", 0), (3, "t", 1), (3, "t", 1), (None, "é", 1), (5, "w w w w w", 99_999)], key=repr)
    assert html_text.extract(df.where("false")).collect() == []


@needs_tables
def test_op10_beside_a_plain_reading_of_these_pages(spark):
    def plain(source):
        inner = re.search(r"<article>(.*?)</article>", source or "", re.S)
        blocks = re.sub(r"<[^>]*>", "", re.sub(r"</?(?:p|h1|br)>", "\0", inner.group(1))).split("\0")
        return "\n".join(t for t in (" ".join(html.unescape(b).split()) for b in blocks) if t)
    truth = {r.page_id: plain(r.html) for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = queries.op10(spark, SF).collect()
    assert {r.page_id: r.text for r in got} == truth and all(r.n_chars == len(r.text) for r in got)
