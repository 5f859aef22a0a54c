"""Pages and toxicity against brute force and held-out rows, and on nulls, blanks and empty tables."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from firegrid.llm import hosts, html_text, toxicity


# ---- hosts

def brute_host(url):
    url = url or ""
    if "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.split("[/?#]", rest)[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), re.split("[?#]", rest[len(host):])[0]


def brute_rule(host, path):
    fits = [(len(h + p), h + p, a) for a, h, p in hosts.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else (None, None)


URLS = [
    "http://a.net/x", "https://A.NET/x?y#z", "http://a.net", "http://a.net?x/", "http://net/q", "http://sub.example.net/en/1", "http://example.net/en",
    "http://www.example.com/de/1", "http://www.example.com/en/1", "http://myexample.com/de/1", "http://x.org/fr/2", "http://org/fr/", "http://x.org/de/2",
    "no scheme", None, "", "://", "x://y://z/p", "http://É.net/x", "http://h.com#f", "http://h.com:80/p?q", "http://victim.com/a", "http://friend.com/b",
]


@pytest.fixture(scope="module")
def pages(spark):
    link = {"http://victim.com/a": '<a href="http://a.net/1">x</a><a HREF=\'//A.net/2\'>y</a><a href="/own">z</a>', "http://x.org/fr/2": "<a href=https://friend.com/>f</a>"}
    rows = [(i, u, link.get(u, None if i % 3 else "<p>t</p>"), "clash", "clash") for i, u in enumerate(URLS)]
    return spark.createDataFrame(rows + [rows[0], (None, "http://x.org/fr/9", "<a href=https://friend.com/>f</a>", "a", "b")],
                                 "page_id bigint, url string, html string, host string, verdict string")


def test_hosts(pages):
    got = hosts.judge(pages).collect()
    assert len(got) == len(URLS) + 2
    for r in got:
        if r.page_id is not None:
            host, path = brute_host(URLS[r.page_id])
            rule, action = brute_rule(host, path)
            assert (r.host, r.path, r.rule) == (host, path, rule)
            if action:
                assert r.verdict == action
    by = {r.host: r for r in got}
    assert by["victim.com"].distrust > 0 and by["friend.com"].trust > 0
    assert by["victim.com"].verdict == "block" and by["friend.com"].verdict == by["h.com"].verdict == by[""].verdict == "allow"


def test_propagation(spark):
    """Against plain power iteration on a random graph."""
    rng = random.Random(1)
    edges = sorted({(rng.randrange(20), rng.randrange(20)) for _ in range(60)})
    out = Counter(a for a, _ in edges)
    seed = {0: 1.0, 3: 0.5}
    rank = {h: 0.15 * s for h, s in seed.items()}
    for _ in range(hosts.ROUNDS):
        new = Counter({h: 0.15 * s for h, s in seed.items()})
        for a, b in edges:
            new[b] += 0.85 * rank.get(a, 0.0) / out[a]
        rank = new
    e = spark.createDataFrame([("trust", str(a), str(b), 1 / out[a]) for a, b in edges], "kind string, src string, dst string, share double")
    s = spark.createDataFrame([("trust", str(h), v) for h, v in seed.items()], "kind string, host string, seed double")
    got = {int(r.host): r["rank"] for r in hosts.propagate(e, s).collect() if r["rank"]}
    assert got == pytest.approx({h: v for h, v in rank.items() if v})


def test_hosts_empty(spark):
    assert hosts.judge(spark.createDataFrame([], "page_id bigint, url string, html string")).count() == 0


# ---- main text

PAGE = """<!DOCTYPE html><html><head><title>T &amp; t</title><style>p{}</style><script>var x="</p><p>no</p>";</script></head><body>
<header>Site <h1>Site name</h1></header><nav><ul><li><a href=/>Home</a></li></ul></nav><div class="cookie-notice">We use cookies</div>
<article><header>By <b>someone</b></header><h1>A  title</h1><p>First <b>bold
 text</b> &lt;here&gt; &eacute;&#233;&nbsp;x<br>next<p>Second <i>one</i></p><div class="ad">Buy</div><form><label>Name</label><input></form>
<ul><li>point one<li>point two</ul><table><tr><td>a<td>b</table><aside>side</aside><div id="comments"><p>I think</p></div></article>
<div class="sidebar"><p>More and more and more links to be found here in the sidebar of the page</p></div><footer>&copy; x</footer></body></html>"""


def test_main_text():
    assert html_text.main_text(PAGE).split("\n") == [
        "By someone", "A title", "First bold text <here> éé x next", "Second one", "point one", "point two", "a", "b"]
    assert html_text.main_text(None) == html_text.main_text("") == html_text.main_text("<p> </p><!-- x -->") == ""
    assert html_text.main_text("<article><p>a<b>b</article>") == "ab"
    assert html_text.main_text("<article>" + "<div>" * 5000 + "deep" + "</div>" * 5000 + "</article>") == "deep"


def test_main_text_without_marks():
    body = "".join(f"<p>{'Sentence with a good many words in it. ' * 4}</p>" for _ in range(5)) + "<p>Short end.</p>"
    links = "<div>" + "".join(f"<span><a href=x>{i}</a></span>" for i in range(12)) + "</div>"
    text = html_text.main_text(f"<body>{links}<div>{body}</div>{links}</body>").split("\n")
    assert len(text) == 6 and text[-1] == "Short end."


def test_extract(spark):
    rows = [(1, "u", PAGE, "x"), (1, "u", PAGE, "x"), (None, None, None, None), (3, "v", "", "y"), (4, "w", "<p>" + "long " * 200_000, "z")]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string, text string")
    got = sorted(html_text.extract(df).collect(), key=lambda r: (r.page_id is None, r.page_id))
    assert [r.page_id for r in got] == [1, 1, 3, 4, None]
    assert got[0] == got[1] and got[4].text == got[2].text == "" and got[3].n_chars == 5 * 200_000 - 1
    assert all(r.n_chars == len(r.text) for r in got)
    assert html_text.extract(df.limit(0)).count() == 0


# ---- toxicity

BAD = ["blorgat", "snivelig", "grumptus"]


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(8)
    syllables = "ta re mi no ka lu pe so di va".split()
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randrange(1, 4)))
    rows, labels = [], []
    for i in range(1200):
        text = [word() for _ in range(rng.randrange(10, 40))]
        bad = rng.random() < 0.2
        if bad:
            text.insert(rng.randrange(len(text)), rng.choice(BAD))
        rows.append((i, " ".join(text)))
        if i < 1000:
            labels.append((i, 1, int(bad)))
    return rows, labels, spark.createDataFrame(rows, "doc_id bigint, text string"), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")


def test_toxicity_held_out(corpus):
    rows, labels, docs, lab = corpus
    got = {r.doc_id: r for r in toxicity.toxicity(docs, lab).collect()}
    truth = {i: any(b in t for b in BAD) for i, t in rows}
    assert all(got[i].predicted == int(truth[i]) for i, _ in rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got.values())
    assert 0.1 < sum(r.held_out for r in got.values()) / len(got) < 0.3
    import zlib

    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in got.items())


def test_disguises(spark, corpus):
    _, _, docs, lab = corpus
    model = toxicity.train(docs, lab)
    for text in ("bl0rgat", "BL0RG4T", "b l o r g a t", "b-l-o-r-g-a-t", "bloooorgat", "snivel1g", "$nivelig", "grumptu5", "gr_ump_tus", "b.l.o.r.g.a.t", "bl*rgat", "bllorrgat"):
        assert model.score(f"ta remi {text} kalu") > 0.5, text
    for text in ("", None, "ta re mi", "1 2 3 4 5", "a@b.c 192.168.0.1", "%%% *** $$$", "t a r e m i", "x" * 100_000, "tareee no", "a " * 50_000):
        assert model.score(text) < 0.5, text


def test_what_a_task_keeps_of_tokens_is_bounded():
    """Long tokens fill the room as many short ones do, and no token outlives its task."""
    letters = toxicity.LetterModel([("__a", 1), ("_ab", 1), ("ab_", 1)])
    restorer = toxicity.Restorer(letters, toxicity.features)
    token = "abcdefghij" * 500
    for i in range(5000):
        restorer.of(f"{token}{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10 % 10]}{'uvwxyzabcd'[i // 100 % 10]}{'efghijklmn'[i // 1000]}")
        restorer.one(f"#{i}")
    held = sum(len(k) + sum(map(len, v)) for k, v in restorer.known.items()) + sum(map(len, restorer.ones))
    assert 0 < held <= toxicity.CACHE_CHARS
    assert restorer.words("s t u p i d") == toxicity.Restorer(letters, toxicity.features).words("s t u p i d")
    assert not hasattr(toxicity.single, "cache_info")


def test_spaced_disguises(spark, corpus):
    """Single characters beside punctuation, mixed with look-alikes, with wide gaps and over line ends."""
    _, _, docs, lab = corpus
    model = toxicity.train(docs, lab)
    for text in ("b l o r g a t.", "b l o r g a t,", '"b l o r g a t"', "(b l o r g a t)!", "b l 0 r g @ t", "b 1 0 r 9 4 t", "b  l   o  r \t g  a  t",
                 "b l o\nr g a t", "b, l, o, r, g, a, t", "b l * r g a t"):
        assert model.score(f"ta remi {text} kalu") > 0.5, text
    assert toxicity.spaced_runs('see "i d i o t." or 1 d 1 0 t, d u m b, 1 2 3 4 and ........t o o'.split()) == ["i d i o t", "1 d 1 0 t d u m b 1 2 3 4", "t o o"]
    for text in ("1 2 3 4 5", "1, 2, 3", "% % %", "- - - a", "t, a. r e m i"):
        assert model.score(text) < 0.5, text


def test_words_that_others_explain_are_learnt_and_those_of_copies_are_not(spark):
    """Every bad row has both words; many rows are copies of one bad text with rare words of its own."""
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("ta re mi no ka lu pe so di va".split()) for _ in range(3))
    texts = []
    for i in range(900):
        text = [word() for _ in range(20)]
        if i % 5 == 0:
            for bad in ("blorgat", "snivelig"):
                text.insert(rng.randrange(len(text)), bad)
        texts.append((" ".join(text), int(i % 5 == 0)))
    texts += [("one qwertzu asdfgh blorgat yxcvbn two " + " ".join(word() for _ in range(3)), 1) for _ in range(60)]
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(texts)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, 1, y) for i, (_, y) in enumerate(texts)], "doc_id bigint, quality int, toxic int")
    model = toxicity.train(docs, labels)
    assert model.score("ta remi blorgat") > 0.5 and model.score("ta remi snivelig") > 0.5
    assert model.score("qwertzu asdfgh yxcvbn") < 0.5


def test_many_rare_words_of_copies_leave_room_for_toxic_words(spark):
    """Copies of a long bad text have more words than one batch of features; a bad word in fewer rows is learnt all the same."""
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("ta re mi no ka lu pe so di va".split()) for _ in range(3))
    rare = " ".join("".join(rng.choice("qwxzjfghbcy") for _ in range(8)) for _ in range(3000))
    texts = [(" ".join(word() for _ in range(12)), 0) for _ in range(900)]
    texts += [(" ".join([word(), word(), "blorgat", word()]), 1) for _ in range(30)]
    texts += [(f"{rare} {word()}", 1) for _ in range(60)]
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(texts)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, 1, y) for i, (_, y) in enumerate(texts)], "doc_id bigint, quality int, toxic int")
    assert toxicity.train(docs, labels).score("ta remi blorgat") > 0.5


def test_labels_are_no_inputs(spark, corpus):
    """Labels of held-out rows, other label columns and other columns of the documents change no score."""
    _, labels, docs, lab = corpus
    a = toxicity.toxicity(docs, lab).orderBy("doc_id").collect()
    flipped = lab.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic"))).withColumn("quality", F.lit(0))
    extra = docs.withColumn("toxic", F.lit(1)).withColumn("score", F.lit("x")).withColumn("feature", F.lit("y"))
    assert a == toxicity.toxicity(extra, flipped).orderBy("doc_id").collect()


def test_toxicity_edges(spark, corpus):
    _, _, docs, lab = corpus
    none = lab.limit(0)
    odd = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, None), (2, "")], "doc_id bigint, text string")
    assert Counter(r.doc_id for r in toxicity.toxicity(odd, none).collect()) == {1: 2, None: 1, 2: 1}
    assert toxicity.toxicity(docs.limit(0), lab).count() == 0
    kept = toxicity.keep_clean(docs.withColumn("score", F.lit(1)), lab)
    assert kept.columns == ["doc_id", "text", "score"] and 0 < kept.count() < docs.count()
