"""Language, line dedup, decontamination, packing, URL rules, extraction, SimHash."""

import hashlib
import math
import random
import re
from collections import defaultdict

import numpy as np
import pytest
from helpers import awkward_documents, empty_like, frame, prose
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kiln.llm import decontaminate as leaks
from kiln.llm import extract, language, packing, simhash, url_rules
from kiln.llm.language import documents_in_known_languages, fit_text_model, identify
from kiln.llm.lines import repeated_units, without_repeats
from kiln.llm.queries import op3_language, page_language

SF = "/root/testdata/sf0.001"


# --- language ---------------------------------------------------------------

def test_language_of_held_out_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    train, held = docs.filter("doc_id % 2 = 0"), docs.filter("doc_id % 2 = 1")
    model = fit_text_model(train, F.col("text"), F.col("lang"))
    blind = identify(held, F.col("text"), F.lit(None), F.lit(None), model).collect()
    right = sum(r.detected == r.lang for r in blind)
    assert right >= 0.95 * len(blind)


def test_language_uses_declaration_and_host_where_the_text_is_short(spark):
    rows = [(i, prose(i, 60), "en", "news.example.uk") for i in range(40)]
    rows += [(100 + i, " ".join(w[::-1] + "ß" for w in prose(i, 60).split()), "de", "zeitung.example.de") for i in range(40)]
    rows += [(200, "ok", "de", "zeitung.example.de"), (201, "ok.", "en", "news.example.uk"),
             (202, "слова на другом языке " * 20, "en", "news.example.uk"), (203, None, "en", "x"), (204, "", None, None),
             (205, "theof 4572244787104698 andin +1 (252) 555-8630 72.224.129.199 isfor", "en", "news.example.uk")]
    df = frame(spark, rows, "doc_id long, text string, lang string, host string")
    model = fit_text_model(df.filter("doc_id < 200"), F.col("text"), F.col("lang"))
    got = {r.doc_id: r for r in identify(df, F.col("text"), F.col("lang"), F.col("host"), model).collect()}
    assert got[201].detected == "en" and got[202].detected == "und" and not got[202].accepted
    assert got[205].accepted and got[205].detected == "en"  # numbers and codes are no evidence
    assert not got[203].accepted and not got[204].accepted
    assert all(got[i].accepted and got[i].detected == "en" for i in range(40))
    assert all(got[100 + i].detected == "de" for i in range(40))


def test_language_awkward_rows(spark):
    df = awkward_documents(spark)
    kept = documents_in_known_languages(df)
    assert kept.columns == df.columns
    ids = [r.doc_id for r in kept.collect()]
    assert {1, 2, 3, 7} <= set(ids) and ids.count(2) == 2 and not {4, 5} & set(ids)
    assert documents_in_known_languages(empty_like(df)).count() == 0
    unlabelled = df.withColumn("lang", F.lit(None).cast("string"))
    assert documents_in_known_languages(unlabelled).count() == 0


def test_rare_language_beside_a_common_one(spark):
    rare = [(i, " ".join(w[::-1] + "ß" for w in prose(i, 40).split()), "xx", "b") for i in range(30)]
    # 440 characters are too little evidence for a model, but no reason to lose the rows that say what they are
    other = [(100, "слова на другом языке " * 20, "ru", "b"), (101, "слова на другом языке " * 20, None, "b")]
    few = frame(spark, rare + other, "doc_id long, text string, lang string, source string")
    common = spark.range(1000, 36_000).select(
        F.col("id").alias("doc_id"), F.concat(F.lit("the and of to in is that it was for on are with "), "id").alias("text"),
        F.lit("en").alias("lang"), F.lit("a").alias("source"))
    kept = {r.doc_id for r in documents_in_known_languages(few.unionByName(common)).filter("doc_id < 1000").collect()}
    assert kept == {r.doc_id for r in documents_in_known_languages(few).collect()} == {*range(30), 100}
    judged = identify(few, F.col("text"), F.col("lang"), F.col("source"), fit_text_model(few, F.col("text"), F.col("lang")))
    assert {r.doc_id: (r.detected, r.accepted) for r in judged.collect() if r.doc_id >= 100} == {100: ("ru", True), 101: ("und", False)}


def test_short_texts_are_judged_by_declaration(spark):
    rows = [(i, prose(i, 60), "en", "a") for i in range(40)] + [(100 + k, t, "en", "a") for k, t in enumerate(
        ("1", "12", "123", "a", "é", "\t \n", "", None))]
    kept = documents_in_known_languages(frame(spark, rows, "doc_id long, text string, lang string, source string"))
    assert {r.doc_id for r in kept.collect()} == {*range(40), 100, 101, 102, 103, 104}


def plain_verdicts(rows: dict, model) -> dict:
    """Key to (language, posterior) by the formula of the module; ``rows``: key to (text, declared, host)."""
    n = len(model.languages)

    def score(text):
        b = (text or "").lower().encode()
        b = [0x20, *[c if 97 <= c <= 122 or c >= 128 else 0x20 for c in b], 0x20]
        hit = [(((b[i - 1] << 16 | b[i] << 8 | b[i + 1]) * 2654435761) % 2**32) >> 16
               for i in range(1, len(b) - 1) if b[i] != 0x20]
        return [language.TEMPER * math.fsum(float(model.logs[x][k]) for x in hit) for k in range(n)]

    def shares(logs):
        parts = [math.exp(x - max(logs)) for x in logs]
        return [x / sum(parts) for x in parts]

    flat = [math.log((1 - language.UNKNOWN_PRIOR) / max(1, n - 1))] * (n - 1) + [math.log(language.UNKNOWN_PRIOR)]
    scores = {k: score(t) for k, (t, _, _) in rows.items()}
    by_host, by_suffix, by_declared, corpus = (defaultdict(lambda: [0.0] * n) for _ in range(4))
    suffix = lambda h: h.rsplit(".", 1)[1].lower() if h and "." in h else "" if h is not None else None
    said = lambda d: None if d is None else d.split("-")[0].lower()
    for k, (_, d, h) in rows.items():
        p = shares([x + y for x, y in zip(scores[k], flat)])
        for table, key in ((by_host, h), (by_suffix, suffix(h)), (by_declared, said(d)), (corpus, 0)):
            table[key] = [x + y for x, y in zip(table[key], p)]
    base = [(x + 1) / (sum(corpus[0]) + n) for x in corpus[0]]
    smooth = lambda c, p: [(x + language.STRENGTH * y) / (sum(c) + language.STRENGTH) for x, y in zip(c, p)]
    out = {}
    for k, (_, d, h) in rows.items():
        prior = smooth(by_host[h], smooth(by_suffix[suffix(h)], base))
        declares = [(x + 1) / (c + len(by_declared)) for x, c in zip(by_declared[said(d)], corpus[0])]
        post = shares([a + math.log(b) + math.log(c) for a, b, c in zip(scores[k], prior, declares)])
        out[k] = model.languages[post.index(max(post))], max(post)
    return out


def agree(got: dict, want: dict) -> None:
    """``got``: key to row; texts without words or in a language without a model are not among ``want``'s cases here."""
    assert got.keys() == want.keys()
    for k, (name, top) in want.items():
        assert got[k].detected == name and abs(got[k].posterior - top) < 1e-6, (k, name, top, got[k])
        assert got[k].accepted == (name != "und" and top >= 0.5)


def test_language_query_against_plain_recomputation(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = fit_text_model(docs, F.col("text"), F.col("lang"))
    rows = {r.doc_id: (r.text, r.lang, r.source) for r in docs.collect()}
    got = {r.doc_id: r for r in op3_language(spark, SF).collect()}
    agree(got, plain_verdicts(rows, model))


def test_page_language_query_against_plain_recomputation(spark):
    rows = {}
    for r in spark.read.parquet(f"{SF}/pages.parquet").collect():
        html = r.html or ""
        said = re.search(r"<html[^>]*\blang\s*=\s*[\"']?([a-zA-Z-]+)", html, re.I)
        plain = re.sub(r"<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>|&[#\w]+;", " ", html, flags=re.I | re.S)
        host = re.match(r"[^/?#]*", r.url.split("://", 1)[1])[0].lower()
        rows[r.page_id] = (plain, said and said[1], host)
    train = frame(spark, [(t, d) for t, d, _ in rows.values()], "plain string, declared string")
    model = fit_text_model(train, F.col("plain"), F.col("declared"))
    assert len(model.languages) > 1
    got = {r.page_id: r for r in page_language(spark, SF).collect()}
    assert {k: g.host for k, g in got.items()} == {k: h for k, (_, _, h) in rows.items()}
    agree(got, plain_verdicts(rows, model))


# --- lines ------------------------------------------------------------------

def test_repeated_units_against_brute_force(spark):
    r = random.Random(5)
    pool = [prose(i, 7 + i % 5).replace("\n", " ").rstrip(".") for i in range(30)]

    def text(i):
        out = ""
        for k in range(r.randrange(0, 12)):
            own = prose(1000 + 40 * i + k, r.randrange(1, 12)).replace("\n", " ")
            out += (r.choice(pool) if r.random() < 0.4 else own) + r.choice([".\n", ". ", "!  ", "\n\n", " and "])
        return out

    docs = [(i, text(i)) for i in range(80)]
    df = frame(spark, docs, "doc_id long, text string").repartition(3)
    first, want = {}, {}
    for d, t in docs:
        at = 0
        for line in t.split("\n"):
            for unit in re.split(r"(?<=[.!?])(?=[ \t])", line):  # blanks lead the unit here
                a, b = at + len(unit) - len(unit.lstrip(" \t")), at + len(unit)
                at = b
                words = unit.lower().split()
                if len(words) >= 7 and first.setdefault(" ".join(words), (d, a)) != (d, a):
                    want[d, a] = (first[" ".join(words)][0], t[a:b].rstrip(" \t"))
            at += 1
    got = repeated_units(df).collect()
    texts = dict(docs)
    assert {(x.doc_id, x.start): (x.kept_doc_id, texts[x.doc_id][x.start:x.end].rstrip(" \t")) for x in got} == want
    assert len(got) == len(want) > 20
    for x in without_repeats(df).collect():
        left, old = "", texts[x.doc_id]
        for a, b in zip([0] + [s.end for s in x.removed], [s.start for s in x.removed] + [len(old)]):
            left += old[a:b]
        assert x.text == left and {(x.doc_id, s.start) for s in x.removed} == {k for k in want if k[0] == x.doc_id}


def test_passage_inside_a_line_is_found(spark):
    passage = " ".join(prose(70 + i, 9).replace("\n", " ").replace(".", "") + "." for i in range(6))
    rows = [(i, f"own{i} words before {passage} and own words{i} after") for i in range(3)]
    got = repeated_units(frame(spark, rows, "doc_id long, text string")).collect()
    # the first sentence is glued to what stands before
    assert sorted((x.doc_id, x.kept_doc_id) for x in got) == [(1, 0)] * 5 + [(2, 0)] * 5


def test_lines_awkward_rows(spark):
    df = awkward_documents(spark)
    out = without_repeats(df)
    rows = out.collect()
    assert out.columns == [c for c in df.columns if c != "removed"] + ["removed"] and len(rows) == df.count()
    assert [x.removed for x in rows if x.doc_id == 1] == [[]]
    assert all(len(x.removed) > 5 for x in rows if x.doc_id == 2)  # both copies, the repeated row too
    assert repeated_units(empty_like(df)).count() == 0 and without_repeats(empty_like(df)).count() == 0


# --- decontamination --------------------------------------------------------

def semi_global(pattern: str, text: str) -> tuple[int, int]:
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        new = [i]
        for j, c in enumerate(text, 1):
            new.append(min(row[j - 1] + (p != c), row[j] + 1, new[j - 1] + 1))
        row = new
    best = min(row)
    return best, row.index(best)


@settings(max_examples=200, deadline=None)
@given(st.text("abc", min_size=1, max_size=70), st.text("abcd", max_size=90))
def test_myers_distance(pattern, text):
    assert leaks.best_end(leaks._masks(pattern), len(pattern), text) == semi_global(pattern, text)


@settings(max_examples=100, deadline=None)
@given(st.integers(0, 10**6), st.integers(0, 12))
def test_any_item_within_the_budget_is_found(seed, edits):
    r = random.Random(seed)
    item = prose(seed, 12)
    plain = leaks.normalised(item)
    hurt = list(plain)
    edits = min(edits, leaks.errors(len(plain)))
    for _ in range(edits):
        k, way = r.randrange(1, len(hurt) - 1), r.randrange(3)
        hurt[k:k + (way != 1)] = r.choice("xyz") if way != 2 else ""
    text = prose(seed + 1, 20) + " " + "".join(hurt) + " " + prose(seed + 2, 20)
    found = leaks.Matcher([(7, item)]).find(text)
    assert [f[0] for f in found] == [7] and found[0][1] == semi_global(plain, leaks.normalised(text))[0] <= edits


def test_leaks_awkward_rows(spark):
    items = frame(spark, [(1, prose(2, 40)[:200]), (2, None), (3, ""), (4, "one two"), (None, prose(50, 40)), (5, "!!")],
                  "item_id long, text string").withColumn("start", F.lit("x"))
    df = awkward_documents(spark)
    got = leaks.find_leaks(df, items).collect()
    assert sorted((r.doc_id, r.item_id, r.distance) for r in got) == [
        (1, 1, 0), (2, 1, 0), (2, 1, 0), (3, 1, 0), (8, 4, 0), (9, 4, 0)]
    kept = leaks.without_leaks(df, items)
    # "one two" is reported, but too short to remove documents on
    assert kept.columns == df.columns and kept.count() == df.count() - 4
    assert leaks.without_leaks(df, items.limit(0)).count() == df.count()
    assert leaks.find_leaks(df, items.limit(0)).count() == leaks.find_leaks(empty_like(df), items).count() == 0


def test_short_items_are_reported_but_remove_nothing(spark):
    docs = frame(spark, [(i, prose(i, 80) + " over the hill and far away") for i in range(20)], "doc_id long, text string")
    items = frame(spark, [(1, "The"), (2, "over the hill"), (3, "the hill and far"), (4, "Over the hill, and far away!"),
                          (4, "over the hill and far away"), (6, "Over the hill, and far away!")], "item_id long, text string")
    found = leaks.find_leaks(docs, items).collect()
    want = {}
    for r in docs.collect():
        text = leaks.normalised(r.text)
        for i in items.collect():
            plain = leaks.normalised(i.text)
            hit = semi_global(plain, text)[0] <= leaks.errors(len(plain)) if leaks.errors(len(plain)) else f" {plain} " in f" {text} "
            want[r.doc_id, i.item_id] = want.get((r.doc_id, i.item_id), 0) + hit
    got = {}
    for r in found:
        got[r.doc_id, r.item_id] = got.get((r.doc_id, r.item_id), 0) + 1
    assert got == {k: n for k, n in want.items() if n} and got[3, 4] == 2 and got[3, 6] == 1  # equal items, each
    assert leaks.without_leaks(docs, items.filter("item_id <= 3")).count() == 20
    assert leaks.without_leaks(docs, items).count() == 0


def test_benchmark_in_several_blocks(spark, monkeypatch):
    items = frame(spark, [(i, prose(300 + i, 30)) for i in range(12)], "item_id long, text string")
    docs = frame(spark, [(i, prose(i, 10) + " " + prose(300 + i, 30) + " end") for i in range(15)], "doc_id long, text string")
    whole = sorted(map(tuple, leaks.find_leaks(docs, items).collect()))
    monkeypatch.setattr(leaks, "BLOCK_CHARS", 700)
    assert sorted(map(tuple, leaks.find_leaks(docs, items).collect())) == whole
    assert [w[:3] for w in whole] == [(i, i, 0) for i in range(12)]
    assert leaks.without_leaks(docs, items).count() == 3


# --- packing ----------------------------------------------------------------

@pytest.fixture(scope="module")
def encoder():
    with open(packing.VOCABULARY, "rb") as f:
        return packing.Encoder(f.read())


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from(list("ab'st1. \n\t é!")), max_size=60))
def test_word_wise_encoding_equals_the_tokenizer(text):
    own = _ENCODER.setdefault(0, None) or _ENCODER.update({0: packing.Encoder(open(packing.VOCABULARY, "rb").read())}) or _ENCODER[0]
    assert own.encode(text).tolist() == own.bpe.encode_ordinary(text)


_ENCODER: dict = {}


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=60))
def test_best_fit_against_a_linear_search(lengths):
    rows = []
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        fits = [(50 - sum(lengths[j] for j in row), k) for k, row in enumerate(rows)
                if sum(lengths[j] for j in row) + lengths[i] <= 50]
        if fits:
            rows[min(fits)[1]].append(i)
        else:
            rows.append([i])
    got = packing.best_fit_decreasing(lengths, 50)
    loads = lambda x: sorted(sum(lengths[j] for j in row) for row in x)
    assert loads(got) == loads(rows) and sorted(sum(got, [])) == list(range(len(lengths)))


def test_packing_round_trip(spark, encoder, tmp):
    df = awkward_documents(spark)
    packing.write_packed(packing.pack_documents(df, row_tokens=256, block_tokens=3000), tmp + "/packed")
    parts = defaultdict(list)
    for r in spark.read.parquet(tmp + "/packed").collect():
        ids = np.frombuffer(r.ids, encoder.dtype)
        assert len(ids) == 256 and r.cu_seqlens[0] == 0 and r.cu_seqlens[-1] == r.n_tokens
        assert r.resets == r.cu_seqlens[:-1] and (ids[r.n_tokens:] == encoder.size).all()
        for a, b, d, row, at in zip(r.cu_seqlens, r.cu_seqlens[1:], r.doc_ids, r.doc_rows, r.chunk_starts):
            parts[d, r.part, row].append((at, ids[a:b].tolist()))
    got = sorted((str(d), sum((c for _, c in sorted(p)), [])) for (d, _, _), p in parts.items())
    want = sorted((str(r.doc_id), encoder.bpe.encode_ordinary(r.text)) for r in df.collect() if r.text)
    assert got == want
    assert packing.pack_documents(empty_like(df)).count() == 0


# --- URLs -------------------------------------------------------------------

def brute_verdict(url, rules):
    m = re.search(r"://([^/?#]*)([^?#]*)", url or "", re.S)
    host, path = (m.group(1), m.group(2)) if m else ("", "")
    host = "".join(c.lower() if c.isascii() else c for c in host)
    fits = [r for r in rules if re.search(r.pattern, host + path)]
    best = max(fits, key=lambda r: r.rank, default=None)
    return host, path, best.name if best else None, best.verdict if best else "allow"


def test_url_rules_against_brute_force(spark):
    urls = ["http://example.org/es/1", "https://a.example.org/en/12?x", "http://example.org/en/2", "http://x.ORG/Path#f",
            "ftp://notexample.org/es/", "http://com/fr/a", "https://www.shop.com/de/", "http://com/dex", "no scheme", None, "",
            "http://org", "http://x.net/login", "http://x.net/blogin", "http://ads.x.net/a", "http://x.net/a.ZIP",
            "http://x.net:80/search/q", "://org/", "http://a.com/fr/://example.org/es/", "http://x.com/fr/login"]
    df = frame(spark, [(i, u) for i, u in enumerate(urls)] + [(0, urls[0])], "page_id long, url string")
    df = df.withColumn("rule", F.lit("own")).withColumn("token", F.lit("own"))
    got = [(r.page_id, r.host, r.path, r.rule, r.verdict) for r in url_rules.judge_urls(df).collect()]
    want = [(i, *brute_verdict(u, url_rules.RULES)) for i, u in enumerate(urls)]
    assert sorted(got) == sorted(want + [want[0]]) if all(g[3] for g in got) else sorted(map(str, got)) == sorted(map(str, want + [want[0]]))
    assert url_rules.judge_urls(df.limit(0)).count() == 0


def test_rules_are_filed_under_their_rarest_token(spark):
    urls = frame(spark, [(["example", "org", "x"],), (["org"],), (["example", "org", "en"],)], "tokens array<string>")
    index = {r.name: r.token for r in url_rules.rule_index(urls, url_rules.ADDRESS_RULES, spark).collect()}
    assert index == {"org/": "org", "example.org/es/": "es", "example.org/en/1": "en", "com/fr/": "com", "com/de/": "com"}


# --- extraction -------------------------------------------------------------

PAGE = """<!DOCTYPE html><html><head><title>Title words</title><style>p{}</style><script>if (a<b) "</p>"</script></head>
<body><header><h1>Site</h1></header><nav><ul><li><a href="/a>b">Home page here</a></li></ul></nav>
<div class="cookie-notice">We use cookies on all of these pages</div>
<article><h1>Fish &amp; chips</h1><p>First <b>para</b>graph,\n  with&nbsp;blanks<p>Second &lt;one&gt; &copy
<aside>See also this</aside><ul><li>item one</li><li>item two</li></ul><form><input name=x>Send</form>
<!-- a comment <p>no</p> --><div id="comments"><p>great post, thank you all so much</p></div></article>
<footer>All rights reserved by the owner of the site and others</footer></body></html>"""


def test_main_text_of_one_page(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    weights = extract.fit_weights(pages)
    want = "Fish & chips\nFirst paragraph, with blanks\nSecond <one> ©\nitem one\nitem two"
    assert extract.main_text(PAGE, weights) == want == extract.main_text(PAGE.replace("article", "main"), weights)
    assert extract.main_text(PAGE.replace("<article>", '<div class="post">').replace("</article>", "</div>"), weights) == want


@pytest.mark.parametrize("name, kept", [
    ("user-comments", False), ("reader-discussion", False), ("reviews", False), ("comment-list", False), ("post_replies", False),
    ("has-comments", True), ("elementor-widget", True), ("reviewed", True)])
def test_discussions_by_compound_names(name, kept):
    weights = {"word p": 11.0, "tag div": -0.05, "tag p": -0.05}
    page = f"<article><p>one two three</p></article><div class='{name}'><p>four five</p></div>"
    assert extract.main_text(page, weights) == ("one two three\nfour five" if kept else "one two three")


@pytest.mark.parametrize("tag", ["<b>", "<div class=ad>", "<option>", "<p><b>", "</i>"])
def test_unclosed_elements_take_linear_time(tag):
    import time
    start = time.perf_counter()
    extract.main_text((tag + "x ") * 100_000, {})
    assert time.perf_counter() - start < 20  # 1 to 4 s; the square would be minutes


@pytest.mark.parametrize("start,end", [
    ('<div class="content has-sidebar">', "</div>"), ('<main class="with-sidebar">', "</main>"),
    ('<div class="elementor-widget">', "</div>"), ('<div class="widget">', "</div>"), ('<div id="sidebar menu">', "</div>")])
def test_main_text_inside_a_wrapper(start, end):
    parts = [prose(i, 60) for i in range(4)]
    text = "".join(f"<p>{p}</p>" for p in parts)
    notes = '<div class="cookie-notice">We use cookies</div><div class="comment-list"><p>nice post</p></div>'
    want = "\n".join(" ".join(p.split()) for p in parts)
    for inner in (text, f"<article>{text}</article>"):
        for page in (f"<body>{start}{notes}{inner}{end}</body>", f"<body>{start}{inner}{end}{notes}</body>"):
            assert extract.main_text(page, {}) == want
    each = "".join(f'<div class="elementor-widget">{p}</div>' for p in parts)
    assert extract.main_text(f"<article>{each}</article>", {}) == want
    talk = "".join(f'<article class="comment-body"><p>{prose(50 + i, 90)}</p></article>' for i in range(9))
    assert extract.main_text(f'<body>{text}<div id="comments">{talk}</div></body>', {}) == want


def test_main_text_awkward_rows(spark):
    pages = ["", None, "plain words only", "<p>unclosed <b>bold", "<<>><p", "<p>a</p>" * 5000, "<nav>menu</nav>", PAGE, PAGE,
             '<div title="x>y">text</div>', "<article></article>", "<p class='a>open quote"]
    df = frame(spark, list(enumerate(pages)), "page_id long, html string").withColumn("text", F.lit("own")).withColumn("n_chars", F.lit("own"))
    out = extract.extract_text(df)
    got = {r.page_id: (r.text, r.n_chars) for r in out.collect()}
    assert got[0] == got[1] == got[6] == got[10] == ("", 0) and got[2] == ("plain words only", 16)
    assert got[3][0] == "unclosed bold" and got[5][0] == "\n".join("a" * 5000) and got[7] == got[8] and got[9][0] == "text"
    assert all(n == len(t) for t, n in got.values())
    assert extract.extract_text(df.limit(0)).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(-5, 5), max_size=30))
def test_best_region_against_all_stretches(scores):
    a, b = extract.best_region(scores)
    best = max((sum(scores[i:j]) for i in range(len(scores)) for j in range(i, len(scores) + 1)), default=0)
    assert sum(scores[a:b]) == max(0, best)


# --- SimHash ----------------------------------------------------------------

def plain_fingerprint(text):
    from kiln.llm.near_dups import _STEP, _mix, word_hashes
    words = (text or "").encode().translate(simhash._LOWER).split()
    counts = defaultdict(int)
    width = min(3, len(words))
    for i in range(len(words) - width + 1) if words else ():
        h = np.uint64(width)
        for w in words[i:i + width]:
            with np.errstate(over="ignore"):
                h = h * _STEP + word_hashes([w])[0]
        with np.errstate(over="ignore"):
            counts[int(_mix(np.array([h]))[0])] += 1
    votes = [0] * 64
    for h, n in counts.items():
        for bit in range(64):
            votes[bit] += n.bit_length() * (1 if h >> bit & 1 else -1)
    return sum(1 << bit for bit in range(64) if votes[bit] > 0)


def check_fingerprints(df, got):
    rows = [(r.doc_id, r.text or "") for r in df.select("doc_id", "text").collect()]
    assert len(got) == len(rows)
    for r in got:
        assert int(r.fingerprint, 16) in {simhash.fingerprint(t) for d, t in rows if d == r.doc_id}
    ordered = sorted((x for x in rows if x[0] is not None), reverse=True)
    by_id = {r.doc_id: r for r in got}
    ids = [d for d, _ in ordered]
    for (d, t), (_, after) in zip(ordered, ordered[1:] + ordered[:1]):
        if ids.count(d) == 1 and (d != ids[-1] or len(ids) == len(rows)):
            k = len(t) // 3
            edited = t[:len(t) - k] + after[:k]
            r = by_id[d]
            assert r.n_chars == len(t) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
            assert int(r.edited_fingerprint, 16) == simhash.fingerprint(edited)
            assert r.near_next == simhash.likeness(simhash.fingerprint(t), simhash.fingerprint(after))
            assert r.near_edited == simhash.likeness(simhash.fingerprint(t), simhash.fingerprint(edited))


def test_fingerprints_against_the_definition(spark):
    for seed in range(5):
        text = prose(seed, 30 * seed) + " a b c a b c a b c"
        assert simhash.fingerprint(text) == plain_fingerprint(text)
    rows = [(i * 3, prose(i % 400, 3 + i % 90)) for i in range(700)]
    df = frame(spark, rows, "doc_id long, text string").repartition(5)
    got = simhash.document_fingerprints(df).collect()
    check_fingerprints(df, got)
    prints = {r.doc_id: int(r.fingerprint, 16) for r in got}
    for r in got:
        want = sum((prints[r.doc_id] ^ x).bit_count() <= 3 for x in prints.values())
        assert r.n_near == (want if r.doc_id % 20 == 0 else None)
        assert r.class_id == min(d for d, x in prints.items() if x == prints[r.doc_id])


def test_fingerprints_awkward_rows(spark):
    df = awkward_documents(spark)
    check_fingerprints(df, simhash.document_fingerprints(df).collect())
    assert simhash.document_fingerprints(empty_like(df)).count() == 0
    one = frame(spark, [(5, "abcdef")], "doc_id long, text string")
    assert simhash.document_fingerprints(one).first().edited_sha256 == hashlib.sha256(b"abcdab").hexdigest()


@settings(max_examples=50, deadline=None)
@given(st.integers(0, 2**64 - 1), st.sets(st.integers(0, 63), max_size=3))
def test_block_tables_share_a_key_within_the_radius(x, flips):
    y = x
    for bit in flips:
        y ^= 1 << bit
    edges = [64 * k // simhash.BLOCKS for k in range(simhash.BLOCKS + 1)]
    same = [b for b in range(simhash.BLOCKS) if (x ^ y) >> edges[b] & ((1 << (edges[b + 1] - edges[b])) - 1) == 0]
    assert len(same) >= simhash.BLOCKS - simhash.RADIUS


@pytest.mark.parametrize("radius", [0, 3, 11, 14])
def test_near_sums_against_brute_force(radius, monkeypatch):
    r = np.random.default_rng(radius)
    centres = r.integers(0, 2**64, 20, np.uint64)
    prints = []
    for _ in range(1500):
        x = int(r.choice(centres)) if r.random() < 0.7 else int(r.integers(0, 2**64, dtype=np.uint64))
        for bit in r.choice(64, r.integers(0, 18), replace=False):
            x ^= 1 << int(bit)
        prints.append(x)
    prints = np.array(prints, np.uint64)
    weights, queries = r.integers(1, 9, 1500), prints[:200]
    want = [int(weights[np.bitwise_count(prints ^ q) <= radius].sum()) for q in queries]
    assert simhash.near_sums(queries, prints, weights, radius).tolist() == want
    monkeypatch.setattr(simhash, "CANDIDATES", 7)
    assert simhash.near_sums(queries, prints, weights, radius).tolist() == want


def test_near_copies_lie_in_the_radius_of_the_query(spark):
    from __spark_entry__ import queries
    from kiln.llm.near_dups import shingle_set

    docs = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    sets = {d: set(shingle_set(t.encode()).tolist()) for d, t in docs.items() if t}
    got = {r.doc_id: r for r in queries()["op10_simhash"](spark, "/root/testdata/sf0.01").collect()}
    prints = {d: int(r.fingerprint, 16) for d, r in got.items()}
    pairs = [(a, b) for a in sets for b in sets if a < b and docs[a] != docs[b] and sets[a] & sets[b]
             and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    assert len(pairs) >= 5 and all((prints[a] ^ prints[b]).bit_count() <= simhash.COPY_RADIUS for a, b in pairs)
    for d, r in got.items():
        want = sum((prints[d] ^ x).bit_count() <= simhash.COPY_RADIUS for x in prints.values())
        assert r.n_near == (want if d % 20 == 0 else None)
