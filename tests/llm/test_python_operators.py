"""Operators beyond SQL, against plain Python."""

import collections
import datetime
import hashlib
import itertools
import math
import re
import time
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st

from shelfwise.llm import graph, html_text, language, language_model, near_dedup, packing, pii, toxicity
from tests.conftest import SF_MID, SF_SMALL
from tests.llm.cases import DOCS, frame

TOKENIZER = __import__("public_tokenizers").path("byte_bpe_50k.json")


# --- personal data ------------------------------------------------------------------------------
def feistel(kind, values, radices, key):
    values, half = list(values), len(values) // 2
    for r in range(pii.ROUNDS):
        other = values[half:] if r % 2 == 0 else values[:half]
        salt = "|".join([key, kind, str(len(values)), str(r), ",".join(map(str, other))])
        for i in range(half) if r % 2 == 0 else range(half, len(values)):
            drawn = int(hashlib.sha256(f"{salt}|{i}".encode()).hexdigest()[:12], 16)
            values[i] = (values[i] + drawn) % radices[i]
    return values


def check_digit(digits):
    total = sum(d if n % 2 else (2 * d - 9 if d > 4 else 2 * d) for n, d in enumerate(reversed(digits)))
    return (10 - total % 10) % 10


def fill(shape, digits):
    digits = iter(digits)
    return "".join(str(next(digits)) if c.isdigit() else c for c in shape)


def plain_pseudonym(value, key):
    digits = [int(c) for c in value if c.isdigit()]
    if "@" in value:
        name, at, host = value.partition("@")
        base = [48 if c.isdigit() else 65 if "A" <= c <= "Z" else 97 if "a" <= c <= "z" else ord(c) for c in name]
        moved = feistel("email", [ord(c) - b for c, b in zip(name, base)], [10 if b == 48 else 26 if b in (65, 97) else 1 for b in base], key)
        return "".join(chr(m + b) for m, b in zip(moved, base)) + at + host
    if re.fullmatch(pii._PHONE, value):
        return fill(value, digits[:-10] + feistel("phone", digits[-10:], [10] * 10, key))
    if re.fullmatch(pii._SSN, value):
        return fill(value, feistel("ssn", digits, [10] * 9, key))
    if re.fullmatch(pii._DATE, value):
        for shape in ("%Y-%m-%d", "%m/%d/%Y", "%d.%m.%Y"):
            try:
                day = datetime.datetime.strptime(value, shape).date()
            except ValueError:
                continue
            first = datetime.date(1800, 1, 1)
            n = (day - first).days
            if not 0 <= n < 146097:
                return None
            a, b = feistel("date", [n // 773, n % 773], [189, 773], key)
            return (first + datetime.timedelta(a * 773 + b)).strftime(shape)
        return None
    if re.fullmatch(pii._IP, value):
        parts = [int(x) for x in value.split(".")]
        return ".".join(map(str, feistel("ip", parts, [256] * 4, key))) if max(parts) < 256 else None
    if check_digit(digits[:-1]) == digits[-1]:
        moved = feistel("card", digits[:-1], [10] * (len(digits) - 1), key)
        return fill(value, [*moved, check_digit(moved)])
    return None


def plain_text(text, key=pii.EXAMPLE_KEY):
    return None if text is None else re.sub(pii.VALUES, lambda m: plain_pseudonym(m[0], key) or m[0], text)


PRIVATE = ["mail Bob.Smith42@mail8.example.com, or +1 (988) 555-2485", "4041894974608795 and 4041-8949-7460-8795 or 4041894974608796",
           "152.143.123.131 999.1.1.1 1.2.3.4", "2021-02-28 2021-02-30 12/31/1999 31.12.1999 13/13/2000 1700-01-01", "123-45-6789 a@b.co",
           "(212) 555 1234 x 212-555-1234 378282246310005", "a@", "@", "12", "x" * 9000 + " 1.2.3.4"]


def test_pseudonyms_equal_plain_python(spark):
    rows = [*DOCS, *[(100 + n, t) for n, t in enumerate(PRIVATE)]]
    out = pii.pseudonymized(frame(spark, rows).withColumnRenamed("score", "pii"))
    assert out.columns == ["doc_id", "text", "lang", "source", "n_words", "kept_text", "pii"]
    got = sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["text"] or "") for r in out.collect())
    assert got == sorted((i if i is not None else -1, plain_text(t) or "") for i, t in rows)
    listed = {r["doc_id"]: [tuple(x) for x in r["pii"]] for r in out.collect()}
    assert listed[101][0][:2] == ("4041894974608795", "card") and len(listed[101]) == 2 and listed[0] == []
    assert listed[101][0][2] == listed[101][1][2].replace("-", "")  # one number, one pseudonym
    assert pii.pseudonymized(frame(spark).limit(0)).collect() == []


def test_given_documents_lose_all_valid_values(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    for before, after in zip(docs.collect(), pii.pseudonymized(docs).collect(), strict=True):
        assert after["text"] == plain_text(before["text"])


RUNS = ["a", "7", ".", "@", "+", "a.", "7.", "a@", "@a.", "+1 ", "A1", "aGVsbG8gd29ybGQ", "-", "1-", "x@a-", "0/", "(1", "DE89 "]


@pytest.mark.parametrize("before", ["", "x@", "bob@a.b.", "+", "1 "])
def test_long_runs_take_little_time(spark, before):
    """Texts of a megabyte, one run each: no stack is too small and no pattern is tried again and again."""
    rows = [(n, before + run * (1_000_000 // len(run)) + end) for n, run in enumerate(RUNS) for end in ("", " bob@example.com")]
    began = time.time()
    got = {(r["doc_id"], r["text"]) for r in pii.pseudonymized(spark.createDataFrame(rows, "doc_id long, text string").repartition(8)).collect()}
    assert time.time() - began < 5 * len(rows)
    assert len(got) == len(rows)
    found = [t for _, t in got if not t.endswith(" bob@example.com") and t.endswith("@example.com")]
    assert len(found) == len(RUNS)


def test_mail_addresses_at_their_borders(spark):
    name = "n" * 64
    texts = ["x@" + "a." * 3000 + "1", "x@" + "a." * 3000 + "com", f"{name}@x.org", f"{name}n@x.org", f"p.{name}@x.org", ".bob@x.org", "-a@b.c.1",
             "a@b.c1", "a@b..c", "a@@b.c", "a@b@c.d", "a@" + "l" * 63 + ".org", "a@" + "l" * 64 + ".org", "É.a@b.org", "éa@b.org", "_a@b.org"]
    out = pii.pseudonymized(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    got = {r["doc_id"]: r for r in out.collect()}
    assert [got[n]["text"] for n in range(len(texts))] == [plain_text(t) for t in texts]
    assert [n for n in range(len(texts)) if got[n]["pii"]] == [0, 1, 2, 4, 5, 6, 7, 10, 11, 13, 14, 15]


def test_the_network_is_a_permutation():
    seen = {tuple(feistel("date", [a, b], [189, 773], "k")) for a in range(189) for b in range(0, 773, 7)}
    assert len(seen) == 189 * 111
    assert len({tuple(feistel("x", v, [10, 10, 10], "k")) for v in itertools.product(range(10), repeat=3)}) == 1000


def mod97(iban):
    iban = iban.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97


def test_more_formats_of_valid_values(spark):
    found = {"31/12/1985": "date", "13/02/2001": "date", "1985/12/31": "date", "5.3.1990": "date", "25/3/1990": "date", "3/5/1990": "date",
             "+49 30 12345678": "phone", "+33 1 23 45 67 89": "phone", "+33123456789": "phone", "+44 20 7946 0958": "phone",
             "555 123 4567": "phone", "3782 822463 10005": "card", "DE89 3704 0044 0532 0130 00": "iban",
             "GB29NWBK60161331926819": "iban", "FR14 2004 1010 0505 0001 3M02 606": "iban"}
    left = ["31/02/1985", "32/12/1985", "1985/13/01", "3782 822463 10006", "DE89 3704 0044 0532 0130 01"]
    rows = [(n, f"x {v}, y") for n, v in enumerate([*found, *left])]
    out = pii.pseudonymized(frame(spark, rows)).collect()
    got = {}
    for r, (value, kind) in zip(sorted(out, key=lambda r: r["doc_id"]), [*found.items(), *((v, None) for v in left)], strict=True):
        if kind is None:
            assert r["text"] == f"x {value}, y"
            continue
        assert [x["kind"] for x in r["pii"]] == [kind] and r["pii"][0]["value"] == value
        got[value] = r["pii"][0]["pseudonym"]
        assert r["text"] == f"x {got[value]}, y" and got[value] != value
    assert int(got["31/12/1985"][:2]) > 12 and datetime.datetime.strptime(got["31/12/1985"], "%d/%m/%Y")
    assert datetime.datetime.strptime(got["1985/12/31"], "%Y/%m/%d") and got["+49 30 12345678"].startswith("+49 ")
    assert got["+33 1 23 45 67 89"].replace(" ", "") == got["+33123456789"] and got["+33123456789"].startswith("+33")
    assert all(mod97(p) == 1 and p[:2] == v[:2] and len(p) == len(v) for v, p in got.items() if found[v] == "iban")
    assert re.fullmatch("[0-9]{4} [0-9]{6} [0-9]{5}", got["3782 822463 10005"])


def test_days_after_the_12th_are_numbered(spark):
    from pyspark.sql import functions as F
    days = spark.sql("SELECT explode(sequence(DATE'1800-01-01', DATE'2199-12-31')) d").where("day(d) > 12")
    out = days.select("d", pii._day_number(F.date_format("d", "dd/MM/yyyy")).alias("n"))
    out = out.select("d", "n", pii._late_day(F.col("n").cast("int")).alias("back"))
    assert out.agg(F.count("*"), F.countDistinct("n"), F.min("n"), F.max("n"), F.sum((F.col("d") != F.col("back")).cast("int"))).first()[:] == (
        88497, 88497, 0, 88496, 0)


# --- language -------------------------------------------------------------------------------------
def parse_count(sample, codes):
    text, n, i = "".join(map(chr, sample)), 0, 0
    codes = "".join(map(chr, codes))
    while i < len(codes):
        size = 1
        while i + size < len(codes) and codes[i:i + size + 1] in text:
            size += 1
        n, i = n + 1, i + size
    return n


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 4), min_size=1, max_size=40), st.lists(st.integers(1, 5), max_size=60))
def test_parsing_takes_the_longest_phrases(sample, codes):
    table = language.parse_table(sample, 6)
    state = count = 0
    for c in codes:
        entry = int(table[state + c])
        count += entry & 1
        state = entry >> 1
    assert count == parse_count(sample, codes)
    assert all(table[s * 6] == s * 12 for s in range(len(table) // 6))  # padding changes nothing


def test_phrases_of_whole_texts(monkeypatch):
    monkeypatch.setattr(language, "PIECE", 7)
    model = language.Model({"aa": ["the cat sat", "on the mat"], "bb": ["le chat dort", "sur le lit"]})
    texts = ["The CAT... sat on the mat!", "le chat 123 dort", "", "123 !", "zzz the", "x" * 100]
    counts, sizes = model.phrases(texts)
    for row, t in enumerate(texts):
        codes = model.codes(np.array([ord(c) for c in t.lower()], dtype=np.uint32)).tolist()
        if not re.search("[a-z]", t.lower()):
            assert sizes[row] == 0
            continue
        for k, lang in enumerate(model.languages):
            sample = [c for s in {"aa": ["the cat sat", "on the mat"], "bb": ["le chat dort", "sur le lit"]}[lang]
                      for c in [*model.codes(np.array([ord(x) for x in s], dtype=np.uint32)).tolist(), 1]]
            assert counts[row, k] == sum(parse_count(sample, codes[a:a + 7]) for a in range(0, len(codes), 7))
    langs, score = model.predict(texts)
    assert langs[:4] == ["aa", "bb", "und", "und"] and ((score >= 0) & (score <= 1)).all()


def test_languages_of_held_out_documents(spark):
    out = language.op4_language(spark, SF_MID).toPandas()
    truth = pd.read_parquet(f"{SF_MID}/documents.parquet").set_index("doc_id").lang
    held = out[out.held_out]
    assert (held.held_out == held.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % 4 == 2)).all() and len(held) > 100
    assert (held.lang_pred == held.doc_id.map(truth)).mean() > 0.98


def test_languages_on_odd_rows(spark):
    docs = frame(spark).withColumnRenamed("n_words", "lang_pred")
    out = language.identify(docs, docs)
    assert out.columns == ["doc_id", "text", "lang", "source", "kept_text", "lang_pred", "score"]
    got = {r["doc_id"]: r["lang_pred"] for r in out.collect()}
    assert got[0] == got[1] == got[2] == got[3] == "und" and got[4] == "en"
    assert {r["lang_pred"] for r in language.identify(docs, docs.limit(0)).collect()} == {"und"}
    assert language.identify(docs.limit(0), docs).collect() == []
    kept = language.keep_identified(frame(spark), frame(spark))
    assert kept.columns == frame(spark).columns and kept.count() == len(DOCS) - 4


def test_scripts_have_letters_of_their_own():
    # two scripts beside Latin, and two languages that differ only in the rarest letters
    samples = {"cs": ["a\u011b\u0161" * 5], "el": ["".join(map(chr, range(0x3B1, 0x3CA))) * 2], "ru": ["".join(map(chr, range(0x430, 0x450))) * 2],
               "la": ["abcdefghijklmnopqrstuvwxyz" * 9], "x1": ["\u05d0\u05d1\u05d2" * 3], "x2": ["\u05d3\u05d4\u05d5" * 3],
               "zh": ["".join(map(chr, range(0x4E00, 0x4F90)))]}
    model = language.Model(samples)
    assert model.width > 255 and set("".join(t for ts in samples.values() for t in ts)) == set(model.letters)
    assert model.predict([ts[0] for ts in samples.values()])[0] == list(samples)
    codes = model.codes(np.array([ord(c) for c in samples["zh"][0]], dtype=np.uint32))
    assert len(set(codes.tolist())) == len(samples["zh"][0])


def test_sample_is_taken_from_anywhere(spark):
    rows = [(n, " ".join(f"{chr(97 + k // 26)}{chr(97 + k % 26)}" for k in range(600)), "en") for n in range(40)]
    rows.append((99, "." * 3000 + "z" + "." * 3000, "zz"))
    out = language.training_sample(spark.createDataFrame(rows, "doc_id long, text string, lang string"), "text", "lang", "doc_id")
    assert len(set(out["en"])) > 5 and {len(t) for t in out["en"]} == {language.SAMPLE_CHARS}
    assert out["zz"] == ["z" + "." * (language.SAMPLE_CHARS - 1)]


# --- html -----------------------------------------------------------------------------------------
def article(page):
    inside = re.search(r"<article>(.*?)(</article>|$)", page, re.S)[1]
    inside = re.sub(r"</?(?:b|i|a|span)>", "", re.sub(r"<!--.*?-->", "", inside, flags=re.S))
    return " ".join(__import__("html").unescape(re.sub(r"<[^>]*>", " ", inside)).split())


def test_given_pages_give_their_articles(spark):
    out = {r["page_id"]: r for r in html_text.op5_html_extraction(spark, SF_SMALL).collect()}
    pages = pd.read_parquet(f"{SF_SMALL}/pages.parquet")
    assert len(out) == len(pages)
    for p in pages.itertuples():
        assert out[p.page_id]["text"] == article(p.html) and out[p.page_id]["n_chars"] == len(article(p.html))


def trained():
    pages = pd.read_parquet(f"{SF_SMALL}/pages.parquet").html
    return html_text.fit(sum((html_text.count_page(p, n % 2 == 0) for n, p in enumerate(pages[:60])), collections.Counter()))


@pytest.mark.parametrize("page,want", [
    ('<article><script>var a = "<!--";</script><p>Hello <b>world</b> this is text</p><!-- end --><p>More text here</p></article>',
     [("script", 'var a = "<!--";'), ("p", "Hello "), ("b", "world"), ("p", " this is text"), ("p", "More text here")]),
    ("<article><script>if (a<b) s='it';//don't</script><p class=\"x\">Hello there</p></article>",
     [("script", "if (a<b) s='it';//don't"), ("p", "Hello there")]),
    ("<p>a<b here, isn't it</p><p class='x'>Second paragraph isn't</p>", [("p", "a"), ("p", "Second paragraph isn't")]),
    ("<a title = \"x>y\" href=z'>t</a> 5 < 6 <i", [("a", "t"), ("#page", " 5 < 6 <i")]),
    ("<style>p</styles>q</style >z<!-- y", [("style", "p</styles>q"), ("#page", "z")]),
])
def test_markup_inside_scripts_values_and_comments(page, want):
    nodes, parts = html_text.parse(page)
    assert [(nodes[n].tag, t) for n, t in parts if t] == want


def test_deep_and_broken_pages_take_little_time():
    began = time.time()
    for page in ("<div>" * 100_000, "<ul>" + "<div>" * 50_000 + "<li>" * 50_000, "<a " * 200_000, "<a x='" * 100_000, "<!--" * 100_000,
                 "<table>" + "<tr><td>" * 50_000, "<b>" * 50_000 + "<li>x</li>" * 20_000, "</x>" * 100_000):
        html_text.measure(*html_text.parse(page))
    assert time.time() - began < 60


def test_marginals_equal_sums_over_all_labellings():
    model = trained()
    for page in ("<div><p>some words of text here<a href=x>link</a></p><ul><li>a<li>b</ul></div>", "<nav><p>x</nav><h1>t</h1>", "text"):
        nodes, parts = html_text.parse(page)
        html_text.measure(nodes, parts)
        role = [html_text._role(n) for n in nodes]
        own = [-html_text.CERTAIN if r in ("never", "boilerplate") else 0.0 if r == "inline" or n == 0 else html_text.DAMPED * sum(
            model.weights.get(s, html_text._suggested(s)) for s in html_text.signs(nodes[n])) for n, r in enumerate(role)]
        total, want = 0.0, [0.0] * len(nodes)
        for labels in itertools.product((0, 1), repeat=len(nodes)):
            w = sum(o for o, y in zip(own, labels) if y)
            for n, node in enumerate(nodes[1:], start=1):
                w += model.ties[html_text._tied(role[node.parent], role[n])][labels[node.parent]][labels[n]]
            total += math.exp(w)
            want = [x + math.exp(w) * y for x, y in zip(want, labels)]
        assert model.marginals(nodes) == pytest.approx([x / total for x in want], abs=1e-9)


def test_pages_without_an_article_and_broken_ones(spark):
    model = trained()
    page = ('<body><div class="sidebar"><p>Side text that is long enough to look like content, with many words in it</p></div>'
            '<div id="content"><h1>Title &amp; more</h1><p>Real text that goes on\n for a while, with <a href=x>a link</a>&nbsp;in it.'
            '<div class="comments"><p>Nice post by a reader, quite long too, with words</p></div></div><form>Name</form></body>')
    assert html_text.main_text(page, model) == "Title & more Real text that goes on for a while, with a link in it."
    rows = [(0, None), (1, ""), (2, "<"), (3, "<p>open <b>text"), (4, "<script>var t='</p>'"), (5, "<!-- c"), (6, "<p a='x>y'>q</p>"),
            (7, "<div>" * 3000 + "deep words" + "</div>" * 10), (7, "<a" * 500), (None, "</p></div>")]
    df = spark.createDataFrame([(i, h, "t", 1) for i, h in rows], "page_id long, html string, text string, n_chars int")
    out = html_text.extract(df, model)
    assert out.columns == ["page_id", "html", "text", "n_chars"]
    got = [(r["page_id"], r["text"]) for r in out.collect()]
    assert got[:2] == [(0, ""), (1, "")] and got[3][1] == "open text" and got[4][1] == "" and got[6][1] == "q" and len(got) == len(rows)
    assert html_text.extract(df.limit(0), html_text.train(df.limit(0))).collect() == []


# --- near duplicates ------------------------------------------------------------------------------
def test_near_duplicates_near_the_threshold_in_small_blocks(spark, monkeypatch):
    """Groups around a common text with links only between some members, compared in many blocks."""
    monkeypatch.setattr(near_dedup, "BLOCK", 7)
    g = np.random.default_rng(3)
    base = [f"b{i}" for i in range(200)]
    texts = []
    for n in range(60):
        words = list(base)
        for at in g.choice(200, size=int(g.integers(1, 14)), replace=False):
            words[at] = f"e{n}x{at}"
        texts.append(" ".join(words))
    sets = [{tuple(t.split()[i:i + 5]) for i in range(196)} for t in texts]
    parent = list(range(60))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(range(60), 2):
        if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
            a, b = sorted((root(a), root(b)))
            parent[b] = a
    want = {n: root(n) for n in range(60)}
    assert 1 < len(set(want.values())) < 60
    out = near_dedup.near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    assert {r["doc_id"]: r["component_id"] for r in out.collect()} == want


def test_components(spark):
    g = np.random.default_rng(1)
    path = g.permutation(np.arange(1000, 1040)).tolist()  # nodes are numbered at random, as by hashes
    edges = [(int(a), int(b)) for a, b in g.integers(0, 300, size=(220, 2))] + list(zip(path, path[1:]))
    parent = {x: x for e in edges for x in e}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    got = {r["node"]: r["component"] for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: root(x) for e in edges if e[0] != e[1] for x in e}
    assert graph.components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_estimates_are_close_to_the_similarity():
    g = np.random.default_rng(2)
    for share in (0.3, 0.6, 0.9):
        both = g.integers(0, 2**63, size=int(3000 * share)).astype(np.uint64)
        sets = [np.concatenate([both, g.integers(0, 2**63, size=3000 - len(both)).astype(np.uint64)]) for _ in range(2)]
        regs = near_dedup.registers(sets)
        j = len(both) / (6000 - len(both))
        got = near_dedup.estimated_similarity(regs[:1], regs[1:], np.array([3000]), np.array([3000]))[0]
        assert abs(got - j) < 5 * math.sqrt(j * (1 - j) / near_dedup.REGISTERS)


# --- toxicity -------------------------------------------------------------------------------------
def test_field_marginals_equal_sums_over_all_labellings():
    g = np.random.default_rng(0)
    f = toxicity.Field(g.normal(size=5), g.normal(size=(2, 2)))
    for _ in range(40):
        n = int(g.integers(1, 9))
        c = np.where(g.random(n) < 0.4, g.integers(1, 5, n), 0)
        at = np.flatnonzero(c)
        total, want = 0.0, np.zeros(n)
        for y in itertools.product((0, 1), repeat=n):
            w = math.exp(sum(f.state[k] * v for k, v in zip(c, y)) + sum(f.pair[a, b] for a, b in zip(y, y[1:])))
            total += w
            want += w * np.array(y)
        assert f.marginals(n, at, c[at]) == pytest.approx((want / total)[at])


def test_toxicity_of_held_out_documents(spark):
    out = toxicity.op8_toxicity(spark, SF_MID).toPandas()
    held = out[out.held_out].merge(pd.read_parquet(f"{SF_MID}/labels.parquet"), on="doc_id")
    assert len(held) > 40 and ((out.score >= 0) & (out.score <= 1)).all()
    assert (held.predicted == held.toxic).mean() > 0.93
    assert held[(held.predicted == 1) & (held.toxic == 0)].shape[0] <= 2


def test_toxicity_on_odd_rows(spark):
    rows = [(n, f"you are a total idiot and a moron number {n}" if n % 2 else f"what a fine day number {n}") for n in range(40)]
    labels = spark.createDataFrame([(n, n % 2, 0) for n in range(40)] + [(3, 1, 0), (None, 1, 0), (5, None, 0)], "doc_id long, toxic int, score int")
    model = toxicity.train(frame(spark, rows), labels)
    out = toxicity.tag(frame(spark, [*DOCS, (50, "é An IDIOT, a moron.")]), model)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_words", "kept_text", "score", "spans"]
    got = {r["doc_id"]: r for r in out.collect()}
    assert got[50]["score"] > 0.5 > got[4]["score"] and got[0]["spans"] == [] == got[1]["spans"]
    assert [("é An IDIOT, a moron."[s["start"]:s["end"]]) for s in got[50]["spans"]][-2:] == ["IDIOT", "moron"] or len(got[50]["spans"]) >= 2
    none = toxicity.train(frame(spark, rows), labels.limit(0))
    assert {round(r["score"], 3) for r in toxicity.tag(frame(spark), none).collect()} == {0.5}
    assert toxicity.tag(frame(spark).limit(0), model).collect() == []


# --- language model -------------------------------------------------------------------------------
def plain_scores(rows, train, mixed=language_model.MIX):
    fold = lambda t: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)
    tokens = [[*re.findall(r"[^\x20\x09-\x0D]+", fold(t or "")), "</s>"] for _, t in rows]
    seen, both = collections.Counter(), collections.Counter()
    for ts, use in zip(tokens, train, strict=True):
        if use:
            seen.update(ts)
            both.update(zip(["<s>", *ts[:-1]], ts))
    n, v = sum(seen.values()), len(seen)
    d = language_model.discount(sum(c == 1 for c in seen.values()), sum(c == 2 for c in seen.values()))
    for ts in tokens:
        base = sum(math.log10((seen[w] + 1) / (n + v + 1)) for w in ts)
        score = 0.0
        for u, w in zip(["<s>", *ts[:-1]], ts):
            root = 1.0 if not n else (seen[w] - d) / n if seen[w] else d * v / n
            before = seen["</s>"] if u == "<s>" else seen[u]
            score += math.log10(mixed * both[u, w] / before + (1 - mixed) * root if before else root)
        yield len(ts), sum(w in seen and seen[w] > 0 for w in ts), n, base, score


@pytest.mark.parametrize("train", ["doc_id % 3 <> 1", "false"])
def test_scores_equal_plain_python(spark, train):
    from pyspark.sql import functions as F
    rows = [r for n, r in enumerate(DOCS) if r not in DOCS[:n]]
    docs = frame(spark, rows)
    out = language_model.score_texts(docs, F.expr(train))
    assert out.columns == ["doc_id", "text", "lang", "source", "n_words", "kept_text", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    got = {r["doc_id"]: r for r in out.collect()}
    used = [train != "false" and i is not None and i % 3 != 1 for i, _ in rows]
    for (i, _), want in zip(rows, plain_scores(rows, used), strict=True):
        r = got[i]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == want[:3]
        assert (r["base_score"], r["score"]) == pytest.approx(want[3:], rel=1e-9, abs=1e-9)
    assert language_model.score_texts(docs.limit(0), F.lit(True)).collect() == []


def test_the_model_beats_single_words_on_held_out_documents(spark):
    out = language_model.op9_language_model(spark, SF_MID).toPandas()
    held = out[out.held_out]
    assert held.score.sum() > held.base_score.sum() + 0.2 * held.n_tokens.sum()


# --- packing --------------------------------------------------------------------------------------
@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 40), max_size=25))
def test_plans_use_every_piece_once_and_waste_little(counts):
    plan = packing.packing_plan(counts, 64)
    used = collections.Counter()
    for parts, times in plan:
        assert sum(parts) <= 64 and times > 0
        for p in parts:
            used[p] += times
    assert used == collections.Counter(counts)
    total = sum(n * c for n, c in counts.items())
    assert sum(t for _, t in plan) <= 11 / 9 * max(-(-total // 64), sum(c for n, c in counts.items() if n > 32)) + 4


def test_exact_complements_are_found():
    plan = packing.packing_plan({1000: 5, 24: 5, 512: 4, 400: 3, 300: 3, 200: 3, 124: 3}, 1024)
    assert sum(t for _, t in plan) == 10


def test_unit_ids_equal_the_tokenizer():
    from tokenizers import Tokenizer
    exact = Tokenizer.from_file(TOKENIZER)
    texts = ["", " ", "a ", "a  b", "\n\n x\n", "don't  it's", "naïve  café\n", "12345 678", "日本 語", "😀 😀😀", "a\n\nb  \n c", "é" * 50 + " ü",
             *[t or "" for _, t in DOCS], *pd.read_parquet(f"{SF_SMALL}/documents.parquet").text[:60]]
    plain = [t for t in texts if not packing._ODD_SPACE.search(t)]
    encoder = packing.UnitEncoder(TOKENIZER)
    for _ in range(2):  # anew, and from memory
        from shelfwise.llm.words import utf8
        ids, bounds = encoder.encode(*utf8(pa.array(plain)))
        for k, t in enumerate(plain):
            assert ids[bounds[k]:bounds[k + 1]].tolist() == exact.encode(t, add_special_tokens=False).ids


def test_added_tokens_in_a_text_get_their_ids(spark):
    from tokenizers import Tokenizer
    exact = Tokenizer.from_file(TOKENIZER)  # special tokens as the contract has them
    texts = ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|><|endoftext|>  y\n", "a <|endoftext| b", "plain", "é\xa0<|endoftext|>\u3000z",
             "word " * 1500 + "<|endoftext|> tail"]
    assert exact.encode(texts[0], add_special_tokens=False).ids == [64, 220, 50256, 275]
    out = packing.pack(frame(spark, list(enumerate(texts))), TOKENIZER).toPandas()
    for i, t in enumerate(texts):
        ids = np.array([*exact.encode(t, add_special_tokens=False).ids, 2], dtype="<u4")
        own = out[out.doc_id == i]
        assert own.length.sum() == len(ids)
        for p in own.itertuples():
            assert p.ids_crc32 == zlib.crc32(ids[p.start:p.start + p.length].tobytes())


def test_packed_documents(spark):
    from tokenizers import Tokenizer
    exact = Tokenizer.from_file(TOKENIZER)
    rows = [r for n, r in enumerate(DOCS) if r not in DOCS[:n]]
    out = packing.pack(frame(spark, [*rows, (7, rows[7][1])]), TOKENIZER).toPandas()
    for i, t in rows:
        ids = np.array([*exact.encode(t or "", add_special_tokens=False).ids, 2], dtype="<u4")
        own = out[out.doc_id.isna() if i is None else out.doc_id == i].sort_values(["piece", "sequence_id"])
        assert own.length.sum() == len(ids) * (2 if i == 7 else 1)
        for p in own.itertuples():
            assert p.ids_crc32 == zlib.crc32(ids[p.start:p.start + p.length].tobytes())
        assert (own.length[1:] == 1024).all() or i == 7
    placed = out.sort_values(["sequence_id", "offset"])
    assert ((placed.groupby("sequence_id").length.cumsum() - placed.length) == placed.offset).all()
    assert placed.groupby("sequence_id").length.sum().max() <= 1024
    assert packing.pack(frame(spark).limit(0), TOKENIZER).collect() == []
