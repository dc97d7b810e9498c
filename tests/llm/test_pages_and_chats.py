"""The operators over pages and conversations."""

import hashlib
import html
import random
import re
from collections import Counter

import pytest

SF = "/root/testdata/sf0.01"


def article(page):
    """Main text by the markup of the test pages: what stands in <article>."""
    inner = re.search(r"<article[^>]*>(.*?)</article>", page, re.S)[1]
    out = []
    for part in re.split(r"</?(?:p|h1)[^>]*>", inner):
        part = re.sub(r"</?[a-z][^>]*>", "", part.replace("<br>", " "))
        out.append(" ".join(html.unescape(part).split()))
    return "\n\n".join(x for x in out if x)


@pytest.fixture(scope="module")
def labeller():
    from tessera.llm.html_extract import trained
    return trained()


def test_labeller_on_unseen_pages(labeller):
    import numpy as np

    from tessera.llm.html_extract import encode, labelled_page
    from tessera.llm.html_samples import sample_pages
    made = [x for x in map(labelled_page, sample_pages(200, 12345)) if x[0]]
    share = labeller.main_share(encode([b for b, _ in made]))
    label = np.concatenate([y for _, y in made])
    assert ((share >= 0.5) == label).mean() > 0.99


def test_extract(spark, labeller):
    from tessera.llm.html_extract import extract
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    got = {r["page_id"]: r for r in extract(pages).collect()}
    want = {r["page_id"]: article(r["html"]) for r in pages.collect()}
    right = sum(got[k]["text"] == t for k, t in want.items())
    assert len(got) == len(want) and right / len(want) >= 0.98
    assert all(r["n_chars"] == len(r["text"]) for r in got.values())


def test_blocks_behind_embedded_elements():
    """No text is lost behind elements that are empty or never closed."""
    from tessera.llm.html_blocks import blocks_of

    def texts(page):
        return [b.text for b in blocks_of(page)]
    want = ["one", "two", "three"]
    for tag in ('<svg class="i"/>', "<svg>", "<math/>", "<noscript>", "<object>", "<audio src=a>", "<video>", "<canvas>",
                "<svg><title>icon</title></svg>", "<noscript><img src=a></noscript>", "<video><source src=a></video>",
                "<script>x</script>", "<iframe src=a></iframe>", "<iframe>"):
        assert texts(f"<p>one</p><p>{tag}two</p><p>three</p>") == want, tag
    formula = ("<math><semantics><mrow><mi>x</mi><mo>=</mo><mn>1</mn></mrow>"
               "<annotation encoding='application/x-tex'>x = 1</annotation></semantics></math>")
    assert texts(f"<p>one</p><p>so {formula} holds</p><p>three</p>") == ["one", "so x=1 holds", "three"]
    assert texts("<p>one</p><script>two</p><p>three</p>") == ["one"]


@pytest.mark.parametrize("family", [
    '<a x="', "<iframe><video>", "<svg>", "<script", "<script>", "<!--", "<annotation>", "<math><annotation>", "<div>a", "</p>",
    "<b><p></p>", "<b>a<hr>", "<noscript><canvas> ", "<a class='x\" id=\"", "<", "<a b ", "<object> <audio> ", "<p><b><li>", "<div></x>"])
def test_hostile_pages_end(family):
    """The scanner reads a megabyte of what never closes in seconds."""
    import time

    from tessera.llm.html_blocks import DEPTH, blocks_of
    start = time.process_time()
    found = blocks_of(family * (1_000_000 // len(family)))
    assert time.process_time() - start < 20
    assert all(len(b.path) <= 4 * DEPTH for b in found)


def test_lstm_equals_plain_loop(labeller):
    """The batched layers against one page, one step and one number at a time."""
    import math

    import numpy as np

    from tessera.llm.html_extract import HIDDEN
    rng = np.random.default_rng(0)
    layer = labeller.ahead
    steps = [5, 1, 3]
    x = rng.normal(size=(5, 3, layer.wx.shape[0])).astype(np.float32)
    live = np.arange(5)[:, None] < np.array(steps)
    got = layer.run(x, live)
    sig = lambda v: 1 / (1 + math.exp(-min(30, max(-30, v))))
    for page, n in enumerate(steps):
        h, c = [0.0] * HIDDEN, [0.0] * HIDDEN
        for t in range(n):
            z = [float(layer.b[j]) + sum(float(x[t, page, i]) * float(layer.wx[i, j]) for i in range(x.shape[2]))
                 + sum(h[i] * float(layer.wh[i, j]) for i in range(HIDDEN)) for j in range(4 * HIDDEN)]
            for j in range(HIDDEN):
                c[j] = sig(z[HIDDEN + j]) * c[j] + sig(z[j]) * math.tanh(z[3 * HIDDEN + j])
            h = [sig(z[2 * HIDDEN + j]) * math.tanh(c[j]) for j in range(HIDDEN)]
            assert np.allclose(got[t, page], h, atol=1e-4)
        assert not got[n:, page].any()


def test_extract_edges(spark, labeller):
    from tessera.llm.html_extract import extract
    long = "<article>" + "<p>Some &lt;long&gt; &amp; plain text of the story, told once more.</p>" * 3000 + "</article>"
    body = ('<nav><a href="/">Home</a></nav><div class="cookie-banner">We use cookies.</div><article><h1>A title</h1>'
            '<p title="a > b">First\n paragraph of&nbsp;the <b>story</b>, long enough to be read.<p>Second one follows here.'
            '<script>if (a < b) { x = "<p>no</p>" }</script><!-- <p>no</p> --></article>'
            '<section class="comments"><h3>2 comments</h3><p>I liked this story a lot.</p></section>'
            '<form><label>Email</label><input></form><footer>All rights reserved.</footer>')
    rows = [(1, None, None), (2, "u", ""), (3, "u", long), (4, "u", body), (4, "u", body), (None, "u", "plain words"),
            (5, "u", "<p class=\"x"), (6, "u", "<" * 2000), (7, "u", "<nav>" * 500)]
    schema = "page_id long, url string, html string"
    got = extract(spark.createDataFrame([(*r, 0) for r in rows], schema + ", text int")).collect()
    assert len(got) == len(rows)
    text = {r["page_id"]: r["text"] for r in got}
    assert text[1] == text[2] == "" and text[7] == ""
    assert text[3] == "\n\n".join(["Some <long> & plain text of the story, told once more."] * 3000)
    assert text[4] == ("A title\n\nFirst paragraph of the story, long enough to be read.\n\nSecond one follows here.")
    assert extract(spark.createDataFrame([], schema)).count() == 0


def test_url_filter(spark):
    from tessera.llm.queries import URL_RULES
    from tessera.llm.url_filter import filter_urls
    urls = [None, "", "no scheme", "http://", "HTTP://A.Example.COM/en/x?y", "x://www.example.com/en/1#top", "http://example.com",
            "http://example.com/", "http://badexample.com/en/", "http://net/es/", "http://a.b.net/fr/1/2/3/4/5/6/7",
            "http://a.net/de/1", "ftp://x.org/?u=http://y.net/es/", "http://a.net?/es/", "http://x.com/" + "s/" * 3000]
    rows = [(k, u, 0) for k, u in enumerate(urls + urls[:7])] + [(None, "http://net/es/", 0)]
    got = filter_urls(spark.createDataFrame(rows, "page_id long, url string, n int"), URL_RULES).collect()
    assert len(got) == len(rows)
    for r in got:
        u = "http://net/es/" if r["page_id"] is None else (urls + urls[:7])[r["page_id"]] or ""
        m = re.search(r"://([^/?#]*)([^?#]*)", u)
        host, path = (m[1].lower(), m[2]) if m else ("", "")
        fit = [(len(t), t, v) for v, t in URL_RULES for h, _, p in [t.partition("/")]
               if (host == h or host.endswith("." + h)) and path.startswith("/" + p)]
        assert (r["host"], r["path"], r["rule"]) == (host, path, max(fit)[1] if fit else None)
        assert r["verdict"] == (max(fit)[2] if fit else "allow")
    assert filter_urls(spark.createDataFrame([], "page_id long, url string"), URL_RULES).count() == 0


def test_url_templates(spark):
    """Generated segments fall together; a branch of blocked pages is rejected for
    its unlabelled pages too, its neighbours are not."""
    from tessera.llm.url_filter import filter_urls
    rows = [f"http://h.org/{a}/{b}{k}" for a, b, n in (("win", "casino/", 40), ("news", "day/", 40)) for k in range(n)]
    rules = [("block", "h.org/win/casino/1"), ("allow", "h.org/news/day/1")]
    df = spark.createDataFrame(list(enumerate(rows)), "page_id long, url string")
    got = filter_urls(df, rules).collect()
    assert {r["template"].rsplit("/", 1)[1] for r in got} == {"*"}
    assert Counter((r["path"].split("/")[1], r["verdict"]) for r in got) == {("win", "block"): 40, ("news", "allow"): 40}


def test_url_back_off(spark):
    """A branch without labels goes by its nearest labelled ancestor, as far as that is labelled."""
    from tessera.llm.url_filter import filter_urls
    made = [("b.org", "bad", 20, True), ("b.org", "other", 2, False),        # nearly all labelled and blocked
            ("s.org", "es", 5, True), ("s.org", "de", 7, False), ("s.org", "en", 8, False),  # one section of three
            ("n.org", "x", 9, False),                                         # no label at all
            ("d.org", "keep/deep", 6, False), ("d.org", "keep/bad", 30, True), ("d.org", "fine", 40, "allow")]
    urls = [(h, p, f"http://{h}/{p}/page{k}" + "abcdefghij"[k % 10]) for h, p, n, _ in made for k in range(n)]
    rules = [("block", "b.org/bad/"), ("block", "s.org/es/"), ("block", "d.org/keep/bad/"), ("allow", "d.org/fine/")]
    df = spark.createDataFrame([(k, u) for k, (_, _, u) in enumerate(urls)], "page_id long, url string")
    got = {r["page_id"]: r["verdict"] for r in filter_urls(df, rules).collect()}

    def want(host, part):
        label = {(h, p): kind for h, p, _, kind in made}[host, part]
        if label:
            return "allow" if label == "allow" else "block"
        # labelled, blocked and all URLs below the nearest ancestor with labels
        for depth in range(part.count("/"), -1, -1):
            top = part.split("/")[:depth]
            under = [(n, kind) for h, p, n, kind in made if h == host and p.split("/")[:depth] == top]
            labelled = sum(n for n, kind in under if kind)
            if labelled:
                rate = (sum(n for n, kind in under if kind is True) + 0.4) / (labelled + 4)
                return "block" if 0.1 + labelled / sum(n for n, _ in under) * (rate - 0.1) >= 0.5 else "allow"
        return "allow"
    verdicts = {(h, p): {got[k] for k, (a, b, _) in enumerate(urls) if (a, b) == (h, p)} for h, p, _, _ in made}
    assert verdicts == {(h, p): {want(h, p)} for h, p, _, _ in made}
    assert verdicts["b.org", "other"] == verdicts["d.org", "keep/deep"] == {"block"}
    assert verdicts["s.org", "de"] == verdicts["n.org", "x"] == {"allow"}


def escaped(x):
    return x.replace("\\", "\\\\").replace("<|", "<\\|")


def test_chat_round_trip(spark):
    from tessera.llm.chat import format_chats, linear_replies, read_back
    rng = random.Random(4)
    parts = ["<|im_end|>", "<|im_start|>assistant ok", "\\", "<", "|", "\n", "\\n", "<\\|", "ü", " ", "x", "\\\\", "日本"]
    rows = [(c, t, rng.choice(["user", "assistant", "system", None, "as\nsi<|st", "\\"]),
             rng.choice([None, "", "".join(rng.choices(parts, k=rng.randint(1, 30)))]), 0)
            for c in range(30) for t in range(rng.choice((1, 2, 9, 40)))]
    rows += [(None, 0, "user", "a", 0), (None, None, "assistant", "b", 0), (7, 0, rows[0][2], rows[0][3], 0), rows[5], rows[5],
             (99, 0, "assistant", "long " * 50_000, 0)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, node int")
    got = read_back(format_chats(linear_replies(df.drop("node"), "conv_id", ["turn", "role", "text"]), tree="conv_id")).collect()
    want = {}
    key = lambda r: tuple((x is not None, x) for x in r[1:4])
    for r in sorted(rows, key=key):
        want.setdefault(r[0], []).append((r[2] or "", r[3] or ""))
    assert {r["tree"] for r in got} == set(want) and len(got) == len(want)
    for r in got:
        turns = want[r["tree"]]
        assert [tuple(t) for t in r["turns"]] == turns and r["n_turns"] == len(turns)
        assert r["trained"] == "".join(t for role, t in turns if role == "assistant")
        assert r["formatted"] == "".join(
            f"<|im_start|>{escaped(a)}\n{escaped(b)}<|im_end|>\n".replace(escaped(a), escaped(a).replace("\n", "\\n"), 1)
            if a else f"<|im_start|>\n{escaped(b)}<|im_end|>\n" for a, b in turns)
    assert format_chats(linear_replies(df.drop("node").limit(0), "conv_id", ["turn"]), tree="conv_id").count() == 0


def test_reply_trees(spark):
    from tessera.llm.chat import format_chats
    # 1 -> 2 -> 4, 1 -> 3 -> {5, 6}; an orphan; a cycle; ties
    rows = [("t", 1, None, "user", "q", 0.0), ("t", 2, 1, "assistant", "bad", 1.0), ("t", 4, 2, "user", "x", 1.0),
            ("t", 3, 1, "assistant", "good", 2.0), ("t", 5, 3, "user", "y", 1.0), ("t", 6, 3, "user", "z", 1.0),
            ("t", 6, 3, "user", "z", 1.0), ("o", 1, 77, "user", "alone", None), ("c", 1, 2, "user", "a", 1.0),
            ("c", 2, 1, "user", "b", 1.0), ("c", 3, None, "user", "root", 1.0)]
    df = spark.createDataFrame(rows, "tree string, node long, parent long, role string, text string, score double")
    got = {(r["tree"], r["rank"]): r for r in format_chats(df, score="score", top=2).collect()}
    assert set(got) == {("t", 1), ("t", 2), ("o", 1), ("c", 1)}
    assert [got["t", k]["leaf"] for k in (1, 2)] == [5, 6] and got["t", 1]["score"] == 3.0
    assert re.findall(r">(\w+)\n(.*?)<", got["t", 1]["formatted"]) == [("user", "q"), ("assistant", "good"), ("user", "y")]
    assert got["c", 1]["formatted"] == "<|im_start|>user\nroot<|im_end|>\n"
    start, length = got["t", 1]["loss"][0]
    assert got["t", 1]["formatted"][start:start + length] == "good" and len(got["t", 1]["loss"]) == 1
    best = {(r["tree"], r["leaf"]) for r in format_chats(df, score="score").collect()}
    assert best == {("t", 5), ("o", 1), ("c", 3)}


def test_deep_tree(spark):
    from tessera.llm.chat import format_chats
    df = spark.range(1000).selectExpr("0 AS tree", "id AS node", "CASE WHEN id > 0 THEN id - 1 END AS parent",
                                      "'user' AS role", "string(id) AS text")
    r, = format_chats(df).collect()
    want = "".join(f"<|im_start|>user\n{k}<|im_end|>\n" for k in range(1000))
    assert hashlib.sha256(r["formatted"].encode()).hexdigest() == hashlib.sha256(want.encode()).hexdigest()
