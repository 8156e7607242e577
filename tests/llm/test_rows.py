"""Operators that judge rows: quality, personal data, language, pages, URLs, tokens, mixing."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tallyspark.llm import html_text, language_id, mixing, pii, quality, token_counts, url_filter
from tallyspark.llm.textbytes import Hasher, texts_of
from tests.llm.conftest import SCHEMA, invented

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# --- quality ---


def plain_quality(text):
    text = text or ""
    w = WORD.findall(text)
    triples = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    often, hit = Counter(triples), set()
    for i, t in enumerate(triples):
        if often[t] > 1:
            hit |= {i, i + 1, i + 2}
    seen, dup, lost = set(), 0, 0
    for line in text.split("\n"):
        v = WORD.findall(line)
        if not v:
            continue
        copy = line in seen
        seen.add(line)
        dup += copy
        n, chars = len(v), sum(map(len, v))
        bad = (
            10 * sum(c in "#*$%&|<>" for c in line) >= chars
            or (line.count("!") >= 3 and 3 * line.count("!") > n)
            or (n >= 10 and re.search(r"[A-Za-z0-9,]\Z", v[-1]))
            or (sum(x in tuple("|>»›·•") for x in v) >= 3 and 4 * sum(x in tuple("|>»›·•") for x in v) >= n)
            or (n >= 5 and 2 * sum(a == b for a, b in zip(v, v[1:])) > n)
            or (n <= 40 and any(p in line.lower() for p in quality.BOILERPLATE))
            or copy
        )
        lost += n if bad else 0
    failed = len(w) < 50 or 100 * len(hit) > 50 * len(w)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, len(hit), lost, failed, not failed and 2 * lost <= len(w)


def test_quality_equals_plain_rules(odd_docs, odd_rows):
    want = {r[0]: plain_quality(r[1]) for r in odd_rows}
    found = quality.score(odd_docs).collect()
    assert len(found) == len(odd_rows)
    for r in found:
        assert tuple(r)[1:] == want[r.doc_id]


def test_quality_on_invented_lines():
    rng = random.Random(3)
    pieces = ["a b c", "home | about | more | end.", "Click here now", "stop !!! !!!", "go go go go go.", "", "  ", "é ü, ß", "x" * 9, "a b c d e f g h i j k", "cost $$ ##", "a » b › c • d.", "é · é · é ·", "© Tous droits réservés.", "Alle Rechte vorbehalten", "Todos los derechos."]
    texts = ["\n".join(rng.choice([*pieces, invented(rng, 12) + "."]) for _ in range(rng.randint(0, 25))) for _ in range(300)]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])
    got = []
    for t in texts_of(batch, at_most=900):
        out, _ = quality.judge(t, Hasher())
        got += list(zip(*[c.tolist() for c in out.values()], strict=True))
    assert got == [plain_quality(t) for t in texts]


def test_failed_lines_go(spark):
    rng = random.Random(12)
    lines = [f"{invented(rng, 15)}." for _ in range(8)]
    text = "\n".join([*lines[:4], "Home | News | About | Contact", *lines[4:], "Accept our cookie policy"])
    rows = [(1, text, "l"), (2, None, "l"), (3, "Home | News | About | Contact\n" * 40, "l")]
    found = quality.clean(spark.createDataFrame(rows, "doc_id long, text string, kept string")).collect()
    assert [(r.doc_id, r.text.rstrip("\n"), r.kept) for r in found] == [(1, "\n".join(lines), "l")]


def test_quality_of_nothing(no_docs):
    assert quality.score(no_docs).collect() == [] and quality.clean(no_docs).collect() == []


# --- personal data ---


def plain_base(text):
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append(("email", *m.span()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m.group().split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m.group())
        odd = sum(map(int, d[-1::-2])) + sum(sum(divmod(2 * int(x), 10)) for x in d[-2::-2])
        if 14 <= len(d) <= 19 and odd % 10 == 0:
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            out.append(("phone", *m.span()))
    return sorted(out, key=lambda s: (s[1], pii.KINDS.index(s[0]), s[2]))


def test_base_spans_equal_patterns():
    rng = random.Random(8)
    known = ["a.b@c.de", "1.2.3.4", "4111 1111 1111 1111", "4111-1111-1111-1111", "+1 (555) 010-9999", "300.1.1.1", "a@b", "x@y.z@w.v", "@", "٣"]
    for _ in range(4_000):
        text = "".join(rng.choice([*known, *"ab.@+- 0123456789()é"]) for _ in range(rng.randint(0, 25)))
        assert pii.base_spans(text) == plain_base(text), text


def test_long_runs_take_linear_time():
    for text in ("a" * 300_000, "1" * 300_000, "1." * 150_000, "+1" * 150_000, "a@" * 150_000):
        pii.base_spans(text)


@pytest.fixture(scope="module")
def tagger():
    rng = random.Random(1)
    return pii.train(*pii.labelled_windows([invented(rng, 200) for _ in range(30)]))


def test_tagger_learns_held_out_windows(tagger):
    rng = random.Random(77)
    windows, labels = pii.labelled_windows([invented(rng, 200) for _ in range(30)], seed=99)
    path = pii._viterbi(pii._scores(tagger, windows.T)[0], tagger.moves).T
    assert (path == labels).mean() > 0.95
    assert (path[labels > 0] == labels[labels > 0]).mean() > 0.85


def test_gradient_of_the_crf():
    rng = np.random.default_rng(0)
    scores, moves, gold = rng.normal(size=(5, 2, 3)), rng.normal(size=(3, 3)), rng.integers(0, 3, (5, 2))

    def loss(s, m):
        alpha = s[0]
        for t in range(1, 5):
            alpha = s[t] + np.log(np.exp(alpha[:, :, None] + m).sum(1))
        right = s[np.arange(5)[:, None], np.arange(2), gold].sum(0) + m[gold[:-1], gold[1:]].sum(0)
        return (np.log(np.exp(alpha).sum(1)) - right).mean()

    d_scores, d_moves = pii._crf_gradient(scores, moves, gold)
    for array, grad in ((scores, d_scores), (moves, d_moves)):
        for at in np.ndindex(array.shape):
            array[at] += 1e-6
            up = loss(scores, moves)
            array[at] -= 2e-6
            down = loss(scores, moves)
            array[at] += 1e-6
            assert abs((up - down) / 2e-6 - grad[at]) < 1e-5


def test_tagger_adds_and_keeps(tagger):
    texts = ["", "clean words only here", "see joe.b@mail.example.com or 4111.1111.1111.1111 now", "call +1 (555) 010-9999 4111111111111111 today"]
    base, both = pii.all_spans(texts, tagger)
    assert all(set(b) <= set(a) for b, a in zip(base, both, strict=True))
    assert both[0] == both[1] == [] and base[2] == [("email", 4, 26)]
    for spans in both:
        assert all(x[2] <= y[1] for x, y in zip(spans, spans[1:]))


@pytest.mark.parametrize("address", ["joe.b@mailing.com", "joe.b @ mailing.com", "joe.b [@] mailing.com", "joe.b@mailing . com", "joe.b [@] mailing . com", "joe.b (at) mailing.com", "joe.b [at] mailing . com"])
def test_each_trained_form_of_an_address_is_masked(tagger, address):
    text = f"abcde fgh and {address} the abc with"
    begin = text.index(address)
    assert pii._plausible(text, "email", begin, begin + len(address)) == ("email", begin, begin + len(address))
    assert pii.masked(text, pii.all_spans([text], tagger)[1][0]) == "abcde fgh and [EMAIL] the abc with"


def test_words_around_a_sign_are_no_address():
    for text in ("see joe [@] mailing.com", "joe [@] mailing com", "[@] mailing.com", "joe mailing.com"):
        assert pii._plausible(text, "email", 0, len(text)) is None


@pytest.mark.parametrize("begin, end", [(5, 28), (6, 27), (7, 29), (7, 30)])
def test_a_part_of_a_neighbouring_word_falls_off(begin, end):
    text = "and more joe.b@mail.host.org text"
    assert pii._plausible(text, "email", begin, end) == ("email", 9, 28)


def test_tagger_alone_finds_the_base_spans_of_real_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = [r["text"] for r in docs.where("text rlike '[0-9@]'").collect()]
    wanted, found = Counter(), Counter()
    for text, spans in zip(texts, pii.tag(texts, pii.fit(docs)), strict=True):
        base = pii.base_spans(text)
        wanted.update(k for k, _, _ in base)
        found.update(k for k, a, b in base if (k, a, b) in spans)
    assert set(wanted) == set(pii.KINDS)
    assert all(found[k] >= 0.9 * n for k, n in wanted.items()), (wanted, found)


def test_tagger_learns_the_same_from_other_orders_of_rows(spark):
    rng = random.Random(8)
    rows = [(k, invented(rng, 60)) for k in range(40)]
    rows += [(k + 40, rows[0][1]) for k in range(900)]  # more copies than the sample has places
    drawn = []
    for part in (rows, rows[::-1]):
        frame = spark.createDataFrame(part, "doc_id long, text string").repartition(3 + len(drawn))
        model = pii.fit(frame)
        drawn.append(np.concatenate([w.ravel() for w in (*model.forward, *model.backward, model.out, model.moves)]))
    assert np.array_equal(*drawn)


def test_window_starts_cover_all():
    text = "a" * 100 + "1" + "b" * 20 + "@" + "c" * 500 + "9"
    starts = pii._window_starts(text)
    for at in (100, 121, 622):
        assert max(min(at - s, s + pii.WINDOW - 1 - at) for s in starts if s <= at < s + pii.WINDOW) >= pii.STEP // 2 - 1


def test_find_and_mask(odd_docs, odd_rows, spark, tagger):
    found = pii.find(odd_docs, tagger).collect()
    assert len(found) == len(odd_rows)
    for r in found:
        text = next(x[1] for x in odd_rows if x[0] == r.doc_id) or ""
        assert r.base_sha256 == hashlib.sha256(pii.joined(plain_base(text)).encode()).hexdigest()
    rows = [(1, "mail a.b@c.de, ip 1.2.3.4.", "s"), (2, None, "t")]
    shown = pii.mask(spark.createDataFrame(rows, "doc_id long, text string, spans string"), tagger).collect()
    assert sorted(tuple(r) for r in shown) == [(1, "mail [EMAIL], ip [IP].", "s"), (2, None, "t")]


def test_personal_data_of_nothing(no_docs):
    assert pii.find(no_docs).collect() == []


# --- language ---


def test_language_of_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = language_id.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(found) > 150
    assert np.mean([r.lang_pred == r.lang for r in found]) > 0.95
    assert all(0 <= r.score <= 1 for r in found)


def test_language_of_odd_rows(odd_docs, odd_rows, no_docs):
    found = language_id.identify(odd_docs).collect()
    assert len(found) == len(odd_rows)
    for r in found:
        text = next(x[1] for x in odd_rows if x[0] == r.doc_id)
        if not any(map(str.isalpha, text or "")):
            assert (r.lang_pred, r.score, r.rejected) == ("und", 0.0, True)
        else:
            assert r.lang_pred == "en"  # the only label there is
    assert language_id.identify(no_docs).collect() == []


def test_subwords_do_not_cross_texts():
    texts = ["abcdef", "", "xy", "ghijkl", "mnopq"]
    one = pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])
    together = np.concatenate([language_id._histograms(t) for t in texts_of(one)])
    for row, text in zip(together, texts, strict=True):
        alone = pa.RecordBatch.from_arrays([pa.array([text])], ["text"])
        assert np.allclose(row, np.concatenate([language_id._histograms(t) for t in texts_of(alone)])[0])


# --- pages ---

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p>";</script></head><body class="main">
<nav><ul><li><a href=/a>Home</a><li><a href=/b>News</a></ul></nav><header><h2>Site name</h2></header>
<div class="cookie-notice">We use cookies on this site, and you may read all about it in many words here.</div>
<article><header><h1>Title &amp; more</h1></header><p>First   para<b>graph</b>\n with <a href="#">a link</a> in some words of text &lt;tag&gt;.
<p>Second paragraph has words, too, and is not closed<br>after a break.<form><label>Mail</label><input></form>
<aside>Related things to read elsewhere today</aside><div class="ad">Buy this and that now for little money only.</div></p>
<blockquote>Quoted words of somebody who said them.</blockquote></article>
<section id="comments"><p>A reader says that all of this is quite wrong, and says so in many words.</p></section>
<footer>&copy; 2020 Somebody</footer></body></html>"""


def test_page_gives_its_article():
    assert html_text.main_text(PAGE, html_text.default_tree()).split("\n") == [
        "Title & more",
        "First paragraph with a link in some words of text <tag>.",
        "Second paragraph has words, too, and is not closed after a break.",
        "Quoted words of somebody who said them.",
    ]


@pytest.mark.parametrize(
    "names", ["layout with-sidebar", "no-sidebar", "comments-open", "page share-enabled", "social-science", "hasSidebar", "nav-collapsed", "is-menu-open"]
)
def test_a_wrapper_that_speaks_of_boilerplate_keeps_its_text(names):
    sentence = "A sentence of some words that says what the page is about."
    inside = f"<article><h1>A title</h1><p>{sentence}</p><p>{sentence}</p></article>"
    page = f"<body><div class='{names}'><nav><a href=x>Home</a></nav>{inside}<div class='related-posts'><p>{sentence} Other.</p></div></div></body>"
    assert html_text.main_text(page, html_text.default_tree()) == f"A title\n{sentence}\n{sentence}"


def test_a_page_without_an_article_keeps_its_sentences():
    tree = html_text.default_tree()
    assert html_text.main_text("<p>This page is quite short.</p><p>It has two small sentences.</p>", tree) == "This page is quite short.\nIt has two small sentences."
    page = "<ul><li><a href=a>Home</a></li><li><a href=b>About us</a></li></ul><p>Only one sentence stands on this page, with some words.</p><a href=c>Back</a>"
    assert html_text.main_text(page, tree) == "Only one sentence stands on this page, with some words."


def test_density_decides_where_the_markup_says_nothing():
    """Without any zone, dense blocks go and most of the text stays."""
    rng = random.Random(31)
    tree, right, count = html_text.default_tree(), 0, 0
    for _ in range(60):
        blocks, want = [], []
        for part in ["links"] * 3 + ["text"] * rng.randint(3, 8) + ["links"] * 4:
            words = rng.randint(15, 90) if part == "text" else rng.randint(1, 5)
            blocks.append(html_text.Block("x", words, 0 if part == "text" else words, 0))
            want.append(part == "text")
        got = html_text.is_main(tree, html_text.features(blocks))
        right += (got == np.array(want)).sum()
        count += len(want)
    assert right >= 0.97 * count


def test_tree_fits_its_table():
    table = np.array([[float(x) for x in line.split()] for line in html_text.LABELLED.strip().splitlines()])
    assert (html_text.is_main(html_text.default_tree(), table[:, :-1]) == (table[:, -1] == 1)).all()


def test_broken_pages():
    tree = html_text.default_tree()
    for page in ("", None, "<", "<p", "a < b", "<" * 5_000, "<div>" * 5_000, "</p></p>", "<script>x", "<!-- x", "<p title='>'>x", "&#0;&bogus;", "<a " * 5_000 + ">"):
        html_text.main_text(page, tree)


def test_pages_equal_their_markup(spark):
    import html

    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    found = {r.page_id: r for r in html_text.extract(pages).collect()}
    for page in pages.collect():
        inside = page.html.split("<article>")[1].split("</article>")[0]
        parts = (" ".join(html.unescape(re.sub("<[^>]*>", "", p)).split()) for p in re.split("</?(?:p|h1)>", inside))
        want = "\n".join(p for p in parts if p)
        assert found[page.page_id].text == want and found[page.page_id].n_chars == len(want)


def test_odd_pages(spark):
    rows = [(1, None, None, "x"), (1, None, None, "x"), (None, "u", PAGE, "y"), (2, "u", "", "z")]
    found = html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string, text string")).collect()
    assert sorted((str(r.page_id), r.n_chars > 0) for r in found) == [("1", False), ("1", False), ("2", False), ("None", True)]


LONG = "These are the words of a main text that a reader wants to have, and they are not few at all, so they count as text."


@pytest.mark.parametrize(
    ("attributes", "shown"),
    [
        ('class="overflow-hidden"', True),
        ("class='hidden'", True),
        ('style="overflow:hidden"', True),
        ('style="content: display; none: x"', True),
        ('style="display:none; display:block"', True),
        ('data-x="hidden" data-hidden=1', True),
        ('title="a hidden display:none aria-hidden=true"', True),
        ('aria-hidden="false"', True),
        ("data-aria-hidden=true", True),
        ("hidden", False),
        ('class="a"HIDDEN', False),
        ('hidden=""', False),
        ('style="color:red; DISPLAY : none !important; display:block"', False),
        ("style=display:none", False),
        ("aria-hidden='true'", False),
    ],
)
def test_only_hidden_elements_are_left_out(attributes, shown):
    page = f"<html><body><article {attributes}><p>{LONG}</p></article><article><p>{LONG} Two.</p></article></body></html>"
    text = html_text.main_text(page, html_text.default_tree())
    assert text.split("\n") == [LONG] * shown + [f"{LONG} Two."]


@pytest.mark.parametrize(
    "before",
    [
        "<nav><ul>" + "<li><a href=/x>Link</a>" * 1_000 + "</ul></nav>",
        "<div class=sidebar><table>" + "<tr><td>Cell<th>Cell" * 600 + "</table></div>",
        "<aside><dl>" + "<dt>Term<dd>Words" * 600 + "</dl></aside>",
        "<form><select>" + "<option>Choice" * 1_000 + "</select></form>",
        "<nav>" + "<b>x" * 1_000 + "</nav>",
        "<nav><ul><li>One<ul><li>Inner<li>Inner</ul><li>Two</ul></nav>",
        "<aside><table><tr><td><table><tr><td>Inner<tr><td>Inner</table><td>Outer</table></aside>",
        "<nav><p>" + "<i>x" * 100 + "<div>Block</div></nav>",
    ],
)
def test_unclosed_elements_end_where_they_must(before):
    page = f"<html><body>{before}<article><p>{LONG}</p></article></body></html>"
    assert html_text.main_text(page, html_text.default_tree()) == LONG


@pytest.mark.parametrize("head", ["<head><title>T</title><body>", "<head><meta x><noscript><img><body>", "<head><link>", "<head>", "<head></head><body>"])
def test_an_open_head_ends_at_the_body(head):
    page = f"<html>{head}<article><p>{LONG}</p></article></html>"
    assert html_text.main_text(page, html_text.default_tree()) == LONG


def test_outer_items_stay_open_around_inner_lists():
    page = "<main><ul><li hidden>Gone<ul><li>Gone too<li>And this</ul>Still gone<li>" + LONG + "</ul></main>"
    assert html_text.main_text(page, html_text.default_tree()) == LONG


# --- URLs ---


def plain_rule(url):
    at = (url or "").find("://")
    rest = url[at + 3 :] if at >= 0 else ""
    host, path = re.match(r"([^/?#]*)([^?#]*)", rest).groups()
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h + p), h + p, v) for v, h, p in url_filter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits) if fits else (0, None, None)
    return host, path, best[1], best[2]


def plain_ratios(urls, labels):
    """Log-likelihood ratio per character, by dictionaries."""
    shown = ["  " + re.sub(r"[^\x21-\x7E]", " ", "".join(c.lower() if "A" <= c <= "Z" else c for c in u)) + " " for u in urls]
    every = {s[i : i + 3] for s in shown for i in range(len(s) - 2)}
    models = []
    for label in ("allow", "block"):
        n = Counter(s[i : i + 3] for s, x in zip(shown, labels, strict=True) if x == label for i in range(len(s) - 2))
        two, one = Counter(), Counter()
        for g, k in n.items():
            two[g[1:]] += k
            one[g[2]] += k

        def blend(count, context, lower):
            weight = sum(context.values()) + sum(v > 0 for v in context.values())
            return (count + sum(v > 0 for v in context.values()) * lower) / weight if weight else lower

        after1, after2 = {}, {}
        for g, k in two.items():
            after1.setdefault(g[0], Counter())[g[1]] += k
        for g, k in n.items():
            after2.setdefault(g[:2], Counter())[g[2]] += k
        p = {}
        for g in every:
            p0 = blend(one[g[2]], one, 1 / url_filter.SYMBOLS)
            p1 = blend(two[g[1:]], after1.get(g[1], {}), p0)
            p[g] = np.log(blend(n[g], after2.get(g[:2], {}), p1))
        models.append(p)
    return [np.mean([models[0][s[i : i + 3]] - models[1][s[i : i + 3]] for i in range(len(s) - 2)]) for s in shown]


def test_urls_equal_plain_models(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    odd = [(9001, None, "h"), (9002, "", "h"), (9003, "no scheme", "h"), (9004, "HTTP://A.Example.ORG/es/x?y", "h"), (9005, "x://é.com/fr/#", "h"), (9005, "x://é.com/fr/#", "h"), (None, "http://org", "h")]
    pages = pages.unionAll(spark.createDataFrame(odd, pages.schema))
    rows = pages.selectExpr("page_id", "url", "pmod(xxhash64(url), 5) = 0 AS held").collect()
    labels = [None if r.held else plain_rule(r.url)[3] for r in rows]
    ratios = plain_ratios([r.url or "" for r in rows], labels)
    want = sorted((str(r.page_id), *map(str, plain_rule(r.url)[:3]), round(float(x), 4)) for r, x in zip(rows, ratios, strict=True))
    found = url_filter.judge_urls(pages).collect()
    got = sorted((str(r.page_id), r.host, r.path, str(r.rule), round(r.score, 4)) for r in found)
    assert [g[:4] for g in got] == [w[:4] for w in want]
    assert np.allclose([g[4] for g in got], [w[4] for w in want], atol=2e-4)
    for r in found:
        ruled = plain_rule(r.url)[3]
        assert r.verdict == (ruled or ("allow" if r.score > r.threshold else "block"))


def test_ratio_tells_held_out_urls_apart(spark):
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet")
    found = url_filter.judge_urls(pages).selectExpr("pmod(xxhash64(url), 5) = 0 AS held", "rule", "url", "score > threshold AS yes").collect()
    right = [r.yes == (plain_rule(r.url)[3] == "allow") for r in found if r.held and r.rule]
    assert len(right) > 100 and np.mean(right) > 0.8


def test_urls_of_nothing(spark):
    assert url_filter.judge_urls(spark.createDataFrame([], "page_id long, url string")).collect() == []
    one = url_filter.judge_urls(spark.createDataFrame([(1, None)], "page_id long, url string")).first()
    assert (one.host, one.path, one.rule, one.verdict, one.score) == ("", "", None, "block", 0.0)


# --- tokens ---


@pytest.fixture(scope="module")
def model_file():
    return pytest.importorskip("public_tokenizers").path("piece_bpe_32k.model")


def test_token_counts_and_cache(spark, odd_docs, odd_rows, model_file, tmp_path):
    import sentencepiece

    processor = sentencepiece.SentencePieceProcessor(model_file=model_file)
    cache = str(tmp_path / "cache")
    want = sorted((str(r[0]), len((r[1] or "").encode()), len(processor.encode(r[1] or ""))) for r in odd_rows)
    for _ in range(2):
        found = token_counts.count_tokens(odd_docs, cache, model_file, limit=100).collect()
        assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens) for r in found) == want
        assert all(r.over_limit == (r.n_tokens > 100) for r in found)
    stored = spark.read.parquet(cache)
    assert stored.count() == len({r[1] or "" for r in odd_rows})  # each distinct text once, nothing anew
    more = spark.createDataFrame([(1, "new words"), (2, "one")], "doc_id long, text string")
    token_counts.count_tokens(more, cache, model_file).collect()
    assert spark.read.parquet(cache).count() == stored.count() + 1


def test_other_tokenizer_is_not_served(spark, model_file, tmp_path):
    cache = str(tmp_path / "cache")
    row = [("f" * 64, hashlib.sha256(b"x").hexdigest(), 99)]
    spark.createDataFrame(row, token_counts.CACHE).write.parquet(cache)
    found = token_counts.count_tokens(spark.createDataFrame([(1, "x")], "doc_id long, text string"), cache, model_file).first()
    assert found.n_tokens < 99


def test_tokens_of_nothing(no_docs, model_file, tmp_path):
    assert token_counts.count_tokens(no_docs, str(tmp_path / "c"), model_file).collect() == []


# --- mixing ---


def plain_targets(sizes):
    """Targets by filling again and again; sources by code point, null last."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    open_, target, rest = set(names), {}, 1.5 * sum(sizes.values())
    while open_:
        level = rest / sum(weight[s] for s in open_)
        full = {s for s in open_ if 2 * sizes[s] <= weight[s] * level}
        if not full:
            return {**target, **{s: weight[s] * level for s in open_}}
        for s in full:
            target[s] = 2.0 * sizes[s]
            rest -= target[s]
        open_ -= full
    return target


def test_mix_of_invented_sources(spark):
    rng = random.Random(5)
    rows = []
    for k in range(900):
        source = rng.choices([None, "a", "b", "c", "d", "é"], [3, 1, 300, 100, 30, 5])[0]
        rows.append((k, "w " * rng.randint(0, 40), source))
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    found = mixing.mix(docs).collect()
    assert sorted(r.doc_id for r in found) == list(range(900))
    sizes, taken = Counter(), Counter()
    for r in found:
        assert r.size == len(rows[r.doc_id][1].split()) and r.taken == r.copies * r.size and r.copies in (0, 1, 2)
        sizes[r.source] += r.size
        taken[r.source] += r.taken
    want = plain_targets(sizes)
    for r in found:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
    assert all(abs(taken[s] - want[s]) <= 80 for s in sizes)
    assert 0 <= sum(want.values()) - sum(taken.values()) <= 80
    again = mixing.mix(docs.repartition(7)).collect()
    assert sorted(tuple(r) for r in again if r.source) == sorted(tuple(r) for r in found if r.source)


def test_mix_of_odd_rows(odd_docs, odd_rows, no_docs):
    found = mixing.mix(odd_docs).collect()
    assert len(found) == len(odd_rows)
    assert all(r.taken <= 2 * r.size for r in found)
    assert mixing.mix(no_docs).collect() == []


def test_mix_of_wordless_documents(spark):
    found = mixing.mix(spark.createDataFrame([(1, None, "a"), (2, " ", None)], "doc_id long, text string, source string")).collect()
    assert sorted((r.doc_id, r.size, r.target, r.taken) for r in found) == [(1, 0, 0.0, 0), (2, 0, 0.0, 0)]
