"""Token counts, decontamination, packing, chat, toxicity and HTML against brute force or round trips."""
import hashlib
import re
import time
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

from turnstone.llm import arrays, chat, decontaminate, html_text, packing, toxicity, wordpiece
from turnstone.llm import grammar as G

from .conftest import frame, hard_rows, words

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SPACE = re.compile(rb"[^\x20\x09-\x0D]+")
SF = "/root/testdata/sf0.01"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_token_counts(hard, empty):
    entries = set(wordpiece.vocabulary(packing.default_vocabulary()))
    most = max(map(len, entries))

    def pieces(s):
        n = 0
        while s:
            s = s[next(k for k in range(min(most, len(s)), 0, -1) if s[:k] in entries):]
            n += 1
        return n
    want = []
    for i, t in hard_rows():
        w = SPACE.findall((t or "").encode())
        want.append((i, len(w), sum(pieces(b" " + x) for x in w)))
    assert rows(wordpiece.count_tokens(hard)) == sorted(want, key=str)
    assert wordpiece.count_tokens(empty).collect() == []


def test_automaton_needs_all_bytes():
    with pytest.raises(ValueError):
        wordpiece.LongestMatch([b"a", b"ab"])


def leaks_brute(data, items):
    item_words = [(str(i) if i is not None else "null", WORD.findall((t or "").translate(LOW))) for i, t in items]
    out = []
    for d, t in data:
        w = WORD.findall((t or "").translate(LOW))
        hit, found = set(), set()
        for name, x in item_words:
            n = min(10, len(x))
            grams = {tuple(x[i:i + n]) for i in range(len(x) - n + 1)} if x else set()
            for p in range(len(w) - n + 1):
                if x and tuple(w[p:p + n]) in grams:
                    hit |= set(range(p, p + n))
                    found.add(name)
        ids = sorted(found)
        out.append((d, len(w), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def test_leaks(spark, hard):
    base = words(80, 1)
    items = [(1, " ".join(base[10:40])), (2, " ".join(base[30:39])), (3, None), (4, ""), (5, "One, two; THREE!"),
             (5, "One, two; THREE!"), (None, "été"), (6, " ".join(words(25, 99))), (20, " ".join(base[60:75] + words(9, 4))),
             (21, "w1 " * 30)]
    data = hard_rows() + [(50, "w1 " * 15 + "x " + "w1 " * 11), (51, "a b c " + " ".join(base[10:20])), (52, " ".join(base[10:19]))]
    docs, bench = frame(spark, data), spark.createDataFrame(items, "item_id bigint, text string")
    want = leaks_brute(data, items)
    assert rows(decontaminate.decontaminate(docs, bench)) == want
    assert rows(decontaminate.decontaminate(docs, bench, block_words=40)) == want  # several blocks give the same
    nothing = bench.limit(0)
    assert not any(r.contaminated for r in decontaminate.decontaminate(docs, nothing).collect())
    assert decontaminate.decontaminate(docs.limit(0), bench).collect() == []
    kept = decontaminate.drop_leaks(docs, bench)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(
        str(r[0]) for r in want if not r[5] or r[0] is None)


def test_leaks_of_repeated_words(spark):
    r = np.random.default_rng(4)
    data = [(i, " ".join(r.choice(["a", "B", "c"], n, p=[.6, .3, .1]))) for i, n in enumerate([0, 3, 9, 10, 11, 40, 200, 400])]
    items = [(i, " ".join(r.choice(["A", "b"], n, p=[.7, .3]))) for i, n in enumerate([0, 1, 2, 4, 9, 10, 12, 60])] + [(4, "c a c")]
    got = decontaminate.decontaminate(frame(spark, data), spark.createDataFrame(items, "item_id bigint, text string"))
    assert rows(got) == leaks_brute(data, items)


@pytest.mark.parametrize("phrase", ["na ", "na no ", "a b c a d e "])
def test_leaks_take_linear_work(phrase):
    """An item of thousands and a document of hundreds of thousands of repeated words are searched in seconds."""
    index = decontaminate.ItemIndex(["x", "y"], [phrase * 3_000, "end " + phrase * 3_000], 10, 5)
    (s,) = arrays.slices(pa.array(["start " + phrase * 150_000 + "stop"]))
    w = arrays.Words(s, arrays.ALNUM, arrays.LOWER)
    begun = time.perf_counter()
    hit, items = index.search(w.hash, w.doc, s.data, w.start, w.end)
    assert time.perf_counter() - begun < 20
    assert hit.sum() == w.n - 2 and items == {0: {"x", "y"}}


def test_packing(spark, hard, empty):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(packing.default_vocabulary())
    data = hard_rows() + [(100 + i, " ".join(words(i % 7 * 50, i))) for i in range(80)]
    got = packing.pack(frame(spark, data)).toPandas()
    want = []
    for i, t in data:
        ids = np.array(tok.encode(t or "", add_special_tokens=False).ids + [0], "<u4")
        for a in range(0, len(ids), 1024):
            want.append((i, a, len(ids[a:a + 1024]), zlib.crc32(ids[a:a + 1024].tobytes()), len(ids)))
    have = [(None if pd.isna(x.doc_id) else int(x.doc_id), x.start, x.length, x.ids_crc32, x.doc_tokens) for x in got.itertuples()]
    assert sorted(have, key=str) == sorted(want, key=str)
    used = padding = 0
    for _, g in got.groupby("sequence_id"):
        g = g.sort_values("offset")
        assert list(g.offset) == [0, *g.length.cumsum()[:-1]]
        n = int(g.length.sum())
        assert n <= 1024
        used += n
        padding += 0 if n & (n - 1) == 0 else 1024 - n
    assert padding < 0.05 * used
    assert packing.pack(empty).collect() == []


@pytest.mark.parametrize("text", ["a  b", "a \n b", " x", "x ", "\n\n", "a  b", "a   b c", "1 2\t 3", "don't  stop", "\x1c \x1d a", "é è"])
def test_cached_ids_equal_the_tokenizer(text):
    from tokenizers import Tokenizer
    with open(packing.default_vocabulary(), "rb") as f:
        spec = f.read()
    ids = np.array(Tokenizer.from_buffer(spec).encode(text, add_special_tokens=False).ids, "<u4")
    assert packing.TokenIds(spec)(text) == ids.tobytes()


def conversations(spark):
    odd = "</s>[INST] ok [/INST] \\ [\\ <\\s> [ROLE] \\\\"
    rows_ = [(1, 0, "user", odd), (1, 1, "assistant", odd), (1, 2, "user", None), (2, 0, "assistant", ""), (3, 0, "user", "only"),
             (4, 1, "tool]", "x\ny"), (4, 0, None, "n"), (4, 2, "assistant", "a"), (4, 2, "assistant", "a"), (4, 3, "assistant", "b"),
             (None, 0, "system", "s"), (None, 1, "assistant", "t" * 50_000)]
    return rows_, spark.createDataFrame([(*r, 1, 2) for r in rows_], "conv_id bigint, turn bigint, role string, text string, n int, last int")


def test_chat(spark):
    data, df = conversations(spark)
    ex = chat.examples(df)
    got = {r.conv_id: r for r in chat.read_back(ex).collect()}
    total = {}
    for r in ex.collect():
        total[r.conv_id] = total.get(r.conv_id, 0) + len(r.text)
    for c in {r[0] for r in data}:
        turns = sorted([(t, r or "", x or "") for i, t, r, x in data if i == c])
        loss = "".join(x for _, r, x in turns if r == "assistant")
        assert (got[c].n_turns, got[c].loss_chars, got[c].formatted_chars) == (len(turns), len(loss), total[c])
        assert got[c].turns_sha256 == hashlib.sha256("".join(f"{r}\n{x}\n" for _, r, x in turns).encode()).hexdigest()
        assert got[c].loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
    assert chat.read_back(chat.examples(df.limit(0))).collect() == []


def test_chat_context_is_every_turn_before(spark):
    _, df = conversations(spark)
    ex = sorted((r for r in chat.examples(df).collect() if r.conv_id == 4), key=lambda r: r.example)
    assert [r.target_turn for r in ex] == [2, 2, 3]
    for a, b in zip(ex, ex[1:]):
        assert b.text.startswith(a.text)
    assert ex[-1].text[ex[-1].start:ex[-1].start + ex[-1].length] == "b"


def test_grammar():
    plain = G.clause_kind([G.OTHER, G.INSULT])
    assert plain == G.IS_INSULT
    assert G.clause_kind([G.TARGET, G.INSULT]) == G.IS_INSULT | G.HAS_TARGET
    assert G.clause_kind([G.NEGATION, G.OTHER, G.INSULT]) == G.IS_INSULT | G.IS_NEGATED
    assert G.clause_kind([G.NEGATION, G.OTHER, G.OTHER, G.OTHER, G.INSULT]) == plain
    assert G.clause_kind([G.REPORT, G.INSULT]) == G.IS_INSULT | G.IS_REPORTED
    assert G.clause_kind([G.INSULT, G.REPORT]) == plain
    assert G.clause_kind([G.THREAT]) == 0
    assert G.clause_kind([G.INTENT, G.THREAT, G.TARGET]) == G.IS_THREAT | G.HAS_TARGET


def test_toxicity_learns_the_grammar(spark, hard, empty):
    rng = np.random.default_rng(2)
    texts, y = [], []
    for i in range(900):
        w = words(30, i)
        kind = i % 6
        if kind == 0:
            w[10] = rng.choice(["vilfo", "vilfor", "vilfoun", "grob"])
        elif kind == 1:  # reported, so clean
            w[9:11] = ["said", "grob"]
        texts.append(" ".join(w[:8]) + ". " + " ".join(w[8:]))
        y.append(int(kind == 0))
    model = toxicity.fit(pa.array(texts), np.array(y))
    fresh = ["nothing here", "w1 vilfoxx w2", "he w1. w2 vilfor", None, ""]
    s = model.scores(pa.array(fresh))
    assert s[0] < 0.3 and s[1] >= 0.7 and s[2] >= 0.7 and s[3] == s[4] == model.base
    out = toxicity.score_toxicity(hard, model)
    assert out.columns == ["doc_id", "held_out", "score", "predicted"] and out.count() == len(hard_rows())
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in out.collect())
    assert {r.doc_id: r.held_out for r in out.collect() if r.doc_id} == {
        i: zlib.crc32(str(i).encode()) % 3 == 1 for i, _ in hard_rows() if i}
    assert toxicity.drop_toxic(hard, model).columns == hard.columns
    labels = spark.createDataFrame([(1, 1, None)], "doc_id bigint, quality int, toxic int")
    none = toxicity.train(empty, labels.limit(0))
    assert toxicity.score_toxicity(empty, none).collect() == []
    assert toxicity.train(hard, labels).entries == {}


def test_toxicity_learns_insults_that_clean_texts_quote_or_negate():
    texts, y = [], []
    for i in range(900):
        w = words(30, i)
        kind = i % 6
        if kind == 0:
            w[10] = ["vilfo", "vilfor", "vilfoun", "grob"][i // 6 % 4]
        elif kind in (1, 2):  # reported or negated, so clean
            w[9:11] = [["said", "not"][kind - 1], "grob"]
        texts.append(" ".join(w[:8]) + ". " + " ".join(w[8:]))
        y.append(int(kind == 0))
    model = toxicity.fit(pa.array(texts), np.array(y))
    s = model.scores(pa.array(["w1 grob w2", "w1 said grob w2", "w1 not grob w2", "w1 said grob. w2 grob", "w1 vilfor"]))
    assert (s >= 0.7).tolist() == [True, False, False, True, True]


def test_toxicity_counts_clauses_as_the_machine_does():
    from turnstone.llm.arrays import ALNUM, LOWER, Words, slices
    rng = np.random.default_rng(5)
    some = ["said", "not", "x", "zz", "you", "kill", "q.", "w", "he;"]
    texts = [" ".join(rng.choice(some, rng.integers(0, 40))) for _ in range(200)] + ["", "said " + "x " * 500]
    fixed = toxicity.Model().fixed
    for s in slices(pa.array(texts)):
        w = Words(s, ALNUM, LOWER)
        cls = toxicity._classes(w, fixed).tolist()
        want = np.zeros(w.n, bool)
        for a, b in zip(*toxicity._clauses(s, w)):
            for i in range(a, b):
                want[i] = bool(G.clause_kind(cls[a:i] + [G.INSULT]) & (G.IS_NEGATED | G.IS_REPORTED))
        assert toxicity._lowered(s, w, fixed).tolist() == want.tolist() and want.any() and not want.all()


def test_toxicity_held_out(spark):
    from turnstone.llm.queries import op8_toxicity
    out = op8_toxicity(spark, SF).toPandas().merge(pd.read_parquet(f"{SF}/labels.parquet"), on="doc_id")
    test = out[out.held_out]
    assert ((test.predicted == test.toxic).mean()) >= 0.85
    assert not ((out.predicted == 1) & (out.toxic == 0)).any()


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var x="</p><p>no";</script></head><body class="x">
<header><h2>Site name</h2></header><nav><ul><li><a href="/a">Menu of the site</a></li></ul></nav><div class="cookie-notice">We use cookies
and the like to make it all better for you and for all of us in this house.</div><aside><p>Aside of the and the of the and in the to the of and</p></aside>
<article><h1>A &amp; B</h1><p><b>Bold</b>face<br>next&nbsp;line &lt;x&gt;</p><p>Ti.<p>the cat and the dog were in the house with all of their
friends for the day<div class="ad">Buy the new thing of the year</div><p>SHOUT!! NAMES!!</p><form><input value="a>b"><button>Send</button></form>
<section class="comments"><p>I think that the author is right about all of it and so on</p></section></article>
<footer><p>&copy; the firm and its friends in the town and on the road</p></footer></body></html>"""


def test_html(spark):
    want = ("A & B Boldface next line <x> Ti. the cat and the dog were in the house with all of their friends for the day "
            "SHOUT!! NAMES!!")
    assert html_text.main_text(PAGE) == want
    assert html_text.main_text(None) == "" and html_text.main_text("") == ""
    assert html_text.main_text("<p>just a bit</p>") == "just a bit"
    assert html_text.main_text("<p>open <b>tags <script>x") == "open tags"
    assert len(html_text.main_text("<article>" + "<p>word</p>" * 20_000)) == 5 * 20_000 - 1
    data = [(1, "u", PAGE, "t", 1), (2, None, None, "t", 1), (2, None, "", "t", 1), (None, "v", "<p>x", "t", 1)]
    df = spark.createDataFrame(data, "page_id bigint, url string, html string, text string, n_chars int")
    assert rows(html_text.extract(df)) == sorted([(1, "u", want, len(want)), (2, None, "", 0), (2, None, "", 0), (None, "v", "x", 1)], key=str)
    assert html_text.extract(df.limit(0)).collect() == []


LONG = "the cat and the dog were in the house with all of their friends for the day"
MORE = "she said that it was not the one they had been at for a year of their time"


def test_html_wrappers_are_not_regions():
    body = f"<h1>Title</h1><p>{LONG}</p><p>{MORE}</p>"
    want = f"Title {LONG} {MORE}"
    menu = '<nav><a href="/">Home of the site</a></nav><div class="sidebar"><p>Side of it</p></div>'
    for page in (
            f'<body class="single no-sidebar">{body}</body>', f'<html class="has-navbar"><body id="comments">{body}</body></html>',
            f'<body>{menu}<main class="has-sidebar sidebar">{body}</main></body>',
            f'<body>{menu}<article class="post has-comments" id="related">{body}</article></body>',
            f'<body><div id="page" class="with-navbar layout-without-menu">{menu}<article>{body}</article></div></body>',
            f'<body><div class="layout sidebar">{menu}<article>{body}</article></div></body>',
            f'<body><div class="ads header"><main>{body}</main></div></body>',
            f'<body><form action="/x"><div class="sidebar"><p>Side of it</p></div>{body}</form></body>',
            f'<body><form><div class="widget"><article>{body}</article></div></form></body>'):
        assert html_text.main_text(page) == want, page


def test_html_regions_stay_regions():
    post = f"<article><p>{LONG}</p></article>"
    for part in (f'<div class="comments"><article>{MORE}</article><article>{MORE}</article><p>{MORE}</p></div>',
                 f'<div class="related"><article>{MORE}</article></div>', f"<form><p>{MORE}</p><textarea>{MORE}</textarea></form>",
                 f'<div class="sidebar has-ads"><p>{MORE}</p><p>{MORE}</p></div>', f'<aside><main><p>{MORE}</p></main></aside>'):
        assert html_text.main_text(f"<body>{post}{part}</body>") == LONG, part
        assert html_text.main_text(f"<body><form>{post}{part}</form></body>") == LONG, part
    short = '<article><h1>Title</h1><div class="ad"><p>' + MORE + "</p></div></article>"
    assert html_text.main_text(f"<body>{short}</body>") == "Title"
    assert html_text.main_text(f'<p>{LONG} <span class="share">Share it</span> and {MORE}</p>') == f"{LONG} and {MORE}"


def test_html_keeps_text_of_inline_elements():
    page = (f"<article><p>{LONG} <math><mi>x</mi><mo>=</mo><mn>2</mn></math> <canvas>drawn</canvas> <object>thing</object></p>"
            f"<noscript><p>{MORE}</p></noscript><textarea>typed</textarea><svg><title>no</title></svg></article>")
    assert html_text.main_text(page) == f"{LONG} x=2 drawn thing {MORE} typed"


POLISH = ["Wczoraj wieczorem mieszkańcy naszego miasta spotkali się przed ratuszem, aby porozmawiać na temat nowej szkoły.",
          "Burmistrz obiecał, że budowa rozpocznie się jeszcze przed zimą, jeżeli rada przyjmie budżet bez poprawek."]
JAPANESE = "昨日の夕方、町の人々は新しい学校について話し合うために市役所の前に集まりました。"


def test_html_of_other_languages():
    nav, foot = '<nav><a href="/">Strona</a> <a href="/k">Kontakt</a></nav>', "<footer>Wszelkie prawa zastrzeżone</footer>"
    for body in (POLISH, [JAPANESE], ["Nagłówek", *POLISH]):
        page = nav + "".join(f"<p>{x}</p>" for x in body) + '<ul><li><a href="/a">Inne wiadomości z naszego miasta</a></li></ul>' + foot
        assert html_text.main_text(page) == " ".join(body)
    assert html_text.main_text(f"{nav}<p>Krótki tekst</p>{foot}") == "Krótki tekst"
    assert html_text.main_text(nav + foot) == ""
    names = " ".join(f"Name{i}" for i in range(30))  # known words elsewhere: no block is text by its length alone
    assert html_text.main_text(f"{nav}<div>{names}</div>{nav}{nav}<p>{LONG}</p>{foot}") == LONG


def test_html_quotes():
    assert html_text.main_text(f'<p title="x>{LONG}</p><p class="a">{MORE}</p>') == f"{LONG} {MORE}"
    assert html_text.main_text(f'<p title="a > b" data-x=\'"<i>"\'>{LONG}</p>') == LONG
    assert html_text.main_text(f"<p don't>{LONG}</p>") == LONG
    assert html_text.main_text(f"<p title='x>{LONG}</p>") == LONG
    assert html_text.main_text("<p>a < b and b <3 x") == "a < b and b <3 x"


@pytest.mark.parametrize("part", ["<a ", "<", "</", "<!", "<a =' > ' ", "<script>x", "<script </script ", '<p title="x>', "<!--", "<p =\"> "])
def test_html_takes_linear_work(part):
    begun = time.perf_counter()
    html_text.main_text("<p>start</p>" + part * (1_000_000 // len(part)))
    assert time.perf_counter() - begun < 20


def test_html_against_marked_articles():
    import html
    block = re.compile(r"</?(?:p|div|h1|article|br)[^>]*>")
    for page in pd.read_parquet(f"{SF}/pages.parquet").html:
        inner = re.search(r"<article>(.*?)</article>", page, re.S)[1]
        want = " ".join(html.unescape(re.sub(r"<[^>]*>", "", block.sub(" ", inner))).split())
        assert html_text.main_text(page) == want


def test_token_ids_of_long_runs():
    from tokenizers import Tokenizer
    from turnstone.llm import packing
    path = packing.default_vocabulary()
    with open(path, "rb") as f:
        ids = packing.TokenIds(f.read())
    own = Tokenizer.from_file(path)
    for text in (" " * 2_000_000, "\n" * 1_000_000, "a word" + "\t " * 600_000 + "and more  words", "x" * 150_000, "!" * 200_000,
                 "head " + " " * 99_990 + "tail", "y" * 100_001 + " z"):
        assert np.frombuffer(ids(text), "<u4").tolist() == own.encode(text, add_special_tokens=False).ids
