"""Url filters, HTML extraction and language identification."""
import random
import re
from collections import Counter

import pytest
from cases import DOCS, doc

from tallywatch.llm import language, urls, wrappers
from tallywatch.llm.queries import LISTED_HOSTS, URL_RULES

PAGES = "page_id long, url string, html string, host string, path string, text string, wrapper string, lang string"
URLS = [None, "", "no scheme", "://", "http://", "http://Example.COM/en/1", "https://www.example.com/en/x?y=/fr/", "http://a.b.example.com/en", "http://a.b.example.com/en/",
        "http://example.com", "http://example.com?/en/", "http://notexample.com/en/1", "http://x.net/es/1", "http://net/fr/", "http://x.net/de/", "ftp://q.org/p#://com/", "x?u=http://y.com/",
        "http://spam-farm.example.org/en/", "http://sub.spam-farm.example.org", "http://com/", "http://com", "http://com./a", "http://a..com/b", "http://" + "x." * 500 + "com/" + "a/" * 3000]


def page(i, url, html=""):
    return (i, url, html, "h", "p", "t", "w", "l")


def plain_verdict(url):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (m[1].translate({65 + i: 97 + i for i in range(26)}), m[2]) if m else ("", "")
    fits = [k for k, _ in URL_RULES if (host == k.split("/")[0] or host.endswith("." + k.split("/")[0])) and path.startswith("/" + k.partition("/")[2])]
    rule = max(fits, key=len, default=None)
    listed = any(host == h or host.endswith("." + h) for h in LISTED_HOSTS)
    return host, path, rule, dict(URL_RULES)[rule] if rule else "block" if listed else "allow"


@pytest.mark.parametrize("array_bytes", [64 << 20, 1])
def test_verdicts(spark, array_bytes):
    rows = [page(i, u) for i, u in enumerate(URLS)] + [page(5, URLS[5])]
    out = urls.judge(spark.createDataFrame(rows, PAGES), list(URL_RULES), list(LISTED_HOSTS), array_bytes).collect()
    assert Counter((r.page_id, r.host, r.path, r.rule, r.verdict) for r in out) == Counter((r[0], *plain_verdict(r[1])) for r in rows)


def test_no_pages_no_rules(spark):
    assert urls.judge(spark.createDataFrame([], PAGES), list(URL_RULES)).count() == 0
    assert urls.judge(spark.createDataFrame([page(1, URLS[5])], PAGES), []).first().verdict == "allow"


def test_equal_digests_are_told_apart():
    array = urls.DigestArray(["a.com/x", "b.com/y"], ["block", "allow"])
    array.digest[:] = array.digest[0]
    import xxhash
    real, xxhash.xxh64_intdigest = xxhash.xxh64_intdigest, lambda k: int(array.digest[0])
    try:
        found = array.probe(["b.com/y", "c.com/z", "a.com/x"])
    finally:
        xxhash.xxh64_intdigest = real
    assert [array.keys[i] if i >= 0 else None for i in found] == ["b.com/y", None, "a.com/x"]


def article(blocks, extra="", tail="</article><footer>&copy; host</footer></body></html>"):
    return (f"<!DOCTYPE html><html lang='en'><head><title>T</title><style>p{{}}</style><script>var t='</p><p>no';</script></head><body><nav><ul><li><a href=x>menu</a></li></ul></nav>"
            f"<!-- <p>no</p> --><div class=\"ad\">buy</div><article>{extra}{blocks}{tail}")


def test_main_text(spark):
    cases = {
        article("<h1>Title &amp; more</h1><p><b>Bold <i>text</i>.<br><p>Second\n  line&nbsp;x</p>"): "Title & more\nBold text .\nSecond line x".replace(" .", "."),
        article("<p>one<p>two</p>", "<aside>side</aside><div class='cookie-notice'>cookies</div>", "<form>f<input></form><section id=comments><p>me too</p></section></article><footer>f</footer>"): "one\ntwo",
        article("<p>cut &a", tail=""): "cut &a", article("<p>1 < 2 &lt;b&gt; &#233;&eacute;", tail="</p"): "1 < 2 <b> éé",
        article("<ul><li>a<li>b</ul><table><tr><td>c<td>d</table>"): "a\nb\nc\nd", "": "", "<p>": "", "<script>never closed <p>x</p>": "",
        "plain": "plain"}
    rows = [page(i, f"http://h{i}.org/{i}", h) for i, h in enumerate(cases)] + [page(100, None, None), page(101, "no scheme", article("<p>z</p>")), page(0, "http://h0.org/0", next(iter(cases)))]
    got = {r.page_id: r.text for r in wrappers.main_text(spark.createDataFrame(rows, PAGES)).collect()}
    assert {h: got[i] for i, h in enumerate(cases)} == cases
    assert got[100] == "" and got[101] == "z"
    assert wrappers.main_text(spark.createDataFrame([], PAGES)).count() == 0


def test_wrapper_finds_the_text_without_landmarks(spark):
    rng = random.Random(3)

    def story(i):
        paragraphs = [" ".join(f"w{rng.randint(0, 999)}" for _ in range(40)) for _ in range(rng.randint(1, 5))]
        optional = "<div class='byline'>by someone</div>" if i % 2 else ""
        html = f"<html><body><div class='top'>Site name</div><div class='links'><a>x</a></div><div class='box'>{optional}{''.join(f'<h2>h{j}</h2><p>{p}</p>' for j, p in enumerate(paragraphs))}</div><div class='low'>All rights</div></body></html>"
        return html, "\n".join(x for j, p in enumerate(paragraphs) for x in (f"h{j}", p))

    made = [story(i) for i in range(30)]
    rows = [page(i, "http://one.org/", h) for i, (h, _) in enumerate(made)]
    got = {r.page_id: r.text for r in wrappers.main_text(spark.createDataFrame(rows, PAGES).repartition(5)).collect()}
    assert {i: t.replace("by someone\n", "") for i, t in got.items()} == {i: t for i, (_, t) in enumerate(made)}


def test_deep_pages(spark):
    """Elements nested 5,000 deep, two such pages of one host that differ at the bottom, and repeats of deep elements."""
    deep = "<body>" + "<div>" * 5000
    rows = [page(1, "http://d.org/1", deep + "<p>bottom one"), page(2, "http://d.org/2", deep + "<p>bottom two<p>more"), page(3, "http://d.org/3", deep + "<p>bottom one"),
            page(4, "http://e.org/", article("<p>top</p>" + "<div>" * 5000 + "low", tail="")), page(5, "http://f.org/", "<body>" + ("<div>" * 3000 + "x" + "</div>" * 3000) * 2)]
    got = {r.page_id: r.text for r in wrappers.main_text(spark.createDataFrame(rows, PAGES)).collect()}
    assert got == {1: "bottom one", 2: "bottom two\nmore", 3: "bottom one", 4: "top\nlow", 5: "x\nx"}


def test_mixed_layouts_of_a_host(spark):
    """Pages with an article, with main and with a div, and cards in articles beside the text, share a host or have no url."""
    text = [f"Story {i} " + " ".join(f"w{i}x{j}" for j in range(60)) for i in range(24)]
    cards = lambda i: "".join(f"<article><h3>card {i} {j}</h3></article>" for j in range(3))
    bodies = [lambda i: f"<article><p>{text[i]}</p></article>", lambda i: f"<main><p>{text[i]}</p></main>", lambda i: f"<div class='box'><p>{text[i]}</p></div>",
              lambda i: f"<main><div class='story'><p>{text[i]}</p></div></main><div class='more'>{cards(i)}</div>"]
    made = [f"<html><body><nav>menu</nav>{bodies[i % 4](i)}<footer>foot</footer></body></html>" for i in range(24)]
    rows = [page(i, "http://mixed.org/", h) for i, h in enumerate(made)] + [page(100 + i, None, h) for i, h in enumerate(made)]
    got = {r.page_id: r.text for r in wrappers.main_text(spark.createDataFrame(rows, PAGES)).collect()}
    assert got == {k + i: t for k in (0, 100) for i, t in enumerate(text)}


def test_repeats_become_groups():
    a, b = (wrappers.shape(wrappers.parse("<body>" + "<h2>t</h2><p>x</p>" * n + "</body>")) for n in (3, 1))
    body = wrappers.combine(a, b)[wrappers.ITEMS][0]
    assert [(x[wrappers.LABELS], x[wrappers.MANY]) for x in body[wrappers.ITEMS]] == [(["h2", "p"], True)]
    c = wrappers.shape(wrappers.parse("<body><h2>t</h2><table></table><p>y</p></body>"))
    d = wrappers.shape(wrappers.parse("<body><h2>t</h2><p>x</p></body>"))
    items = wrappers.combine(c, d)[wrappers.ITEMS][0][wrappers.ITEMS]
    assert [(x[wrappers.LABELS], x[wrappers.OPTIONAL], x[wrappers.TEXT]) for x in items] == [(["h2"], False, "t"), (["table"], True, None), (["p"], False, True)]


SYLLABLES = {"aa": "ka ri to sun mel".split(), "bb": "ych zor qua plu dve".split(), "cc": "éti ouà nèr ûle çon".split()}


def speech(rng, lang, n):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 3))) for _ in range(n))


def test_languages(spark):
    rng = random.Random(4)
    labelled = [doc(i, speech(rng, lang, 60), lang) for i, lang in enumerate([*SYLLABLES] * 60)]
    model = language.fit(spark.createDataFrame(labelled, DOCS).select("text", "lang"))
    assert model.languages == sorted(SYLLABLES)
    kind = "id long, text string, declared string, suffix string, domain string, host string, grams string, loglik string, n string"
    rows, want = [], {}
    for i in range(120):
        lang = [*SYLLABLES][i % 3]
        rows.append((i, speech(rng, lang, rng.choice([3, 30, 3000])), lang if i % 4 else None, None, "d", f"host-{lang}", "g", "l", "n"))
        want[i] = lang
    rows += [(200, None, "aa", None, None, None, "", "", ""), (201, "", None, None, None, None, "", "", ""), (202, "12 !!! 34", None, None, None, None, "", "", ""),
             (203, speech(rng, "bb", 50), "zz", "unseen", "x", "y", "", "", ""), rows[0], (None, speech(rng, "aa", 20), None, None, None, None, "", "", "")]
    out = language.identify(spark.createDataFrame(rows, kind), model).collect()
    got = {r.id: r for r in out}
    assert len(out) == len(rows) and all(got[i].lang == w and not got[i].rejected for i, w in want.items())
    assert all(got[i].rejected and got[i].lang == "und" for i in (200, 201, 202)) and got[203].lang == "bb" and got[None].lang == "aa"
    assert language.identify(spark.createDataFrame([], kind), model).count() == 0
    none = language.fit(spark.createDataFrame([], DOCS).select("text", "lang"))
    assert {r.lang for r in language.identify(spark.createDataFrame(rows, kind), none).collect()} == {"und"}


def test_priors_decide_where_texts_do_not(spark):
    model = language.fit(spark.createDataFrame([doc(i, speech(random.Random(i), lang, 60), lang) for i, lang in enumerate([*SYLLABLES] * 40)], DOCS).select("text", "lang"))
    rng = random.Random(1)
    kind = "id long, text string, declared string, suffix string, domain string, host string"
    rows = [(i, speech(rng, "bb", 40), "bb", "b", "d", "only-bb") for i in range(60)] + [(i, speech(rng, "aa", 40), "aa", "a", "e", "only-aa") for i in range(60, 120)]
    rows += [(900, "xxx", "bb", "b", "d", "only-bb"), (901, "xxx", "aa", "a", "e", "only-aa")]
    got = {r.id: r.lang for r in language.identify(spark.createDataFrame(rows, kind), model).collect()}
    assert got[900] == "bb" and got[901] == "aa"


def test_held_out_accuracy(spark):
    from pyspark.sql import functions as F
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("length(text) > 60")
    model = language.fit(docs.where("doc_id % 2 = 0").select("text", "lang"), 100)
    none = F.lit(None).cast("string")
    rows = docs.where("doc_id % 2 = 1").select(F.col("doc_id").alias("id"), "text", none.alias("declared"), none.alias("suffix"), none.alias("domain"), none.alias("host"))
    right = language.identify(rows, model).join(docs.select(F.col("doc_id").alias("id"), F.col("lang").alias("true")), "id").select(F.avg((F.col("lang") == F.col("true")).cast("int"))).first()[0]
    assert right >= 0.97


def test_small_languages_have_models(spark):
    """A share of under a thousandth, more than 64 languages, and labels with fewer texts than a model takes."""
    rng = random.Random(6)

    def word(k):
        return "".join(chr(0x4E00 + 40 * k + rng.randint(0, 9)) for _ in range(4))

    labelled = [doc(i, speech(rng, "aa", 8), "aa") for i in range(6000)]
    labelled += [doc(i, " ".join(word(k) for _ in range(20)), f"l{k:02}") for k in range(70) for i in range(5)]
    labelled += [doc(i, " ".join(word(90) for _ in range(20)), "rare") for i in range(language.LEAST_TEXTS - 1)]
    model = language.fit(spark.createDataFrame(labelled, DOCS).select("text", "lang"))
    assert model.languages == ["aa", *(f"l{k:02}" for k in range(70))]
    kind = "id long, text string, declared string, suffix string, domain string, host string"
    rows = [(k, " ".join(word(k) for _ in range(60)), f"l{k:02}", None, None, None) for k in range(70)] + [(100, speech(rng, "aa", 60), None, None, None, None)]
    got = {r.id: r.lang for r in language.identify(spark.createDataFrame(rows, kind), model).collect()}
    assert got == {k: f"l{k:02}" for k in range(70)} | {100: "aa"}


def test_copies_do_not_thin_the_sample(spark):
    """Rows that are nearly all copies: the sample has every distinct text, or as many as asked for."""
    rng = random.Random(8)
    bb = [speech(rng, "bb", 5) for _ in range(5)]
    labelled = [doc(i, bb[i % 5], "bb") for i in range(20_000)] + [doc(i, speech(rng, "aa", 5), "aa") for i in range(50)]
    df = spark.createDataFrame(labelled, DOCS).select("text", "lang")
    model = language.fit(df, 10)
    assert model.languages == ["aa", "bb"]
    grams = [set(language.Model.trigrams(language.np.frombuffer(t.encode(), "u1")).tolist()) for t in bb]
    seen = model.log[:, 1] > model.log[:, 1].min()
    assert set(language.np.flatnonzero(seen).tolist()) == set().union(*grams)


def test_stage_keeps_documents_of_labels_without_a_model(spark):
    import corpus_pipeline
    rng = random.Random(7)
    rows = [doc(i, speech(rng, lang, 300), lang) for i, lang in enumerate(["aa", "bb"] * 40)]
    foreign = "".join(chr(0x4E00 + rng.randint(0, 5000)) for _ in range(300))
    rows += [doc(200, foreign, "rare"), doc(201, foreign, None), doc(202, "12 !!", "rare"), doc(203, None, "rare")]
    kept = {r.doc_id for r in corpus_pipeline.by_language(spark, spark.createDataFrame(rows, DOCS), "").collect()}
    assert kept == {*range(80), 200}
