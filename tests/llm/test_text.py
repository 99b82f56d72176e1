"""PII, quality, toxicity and page text: brute force, planted cases, odd rows."""

import hashlib
import re
import time
import zlib
from collections import Counter

import numpy as np
import pytest

from tallywell.llm import html_text, pii, quality, toxicity
from tests_llm_documents import documents

# The patterns of the contract.
BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    doubled = [int(c) * (1 + k % 2) for k, c in enumerate(reversed(digits))]
    return sum(v - 9 * (v > 9) for v in doubled) % 10 == 0


def base_spans(text):
    found = []
    for order, (kind, pattern) in enumerate(BASE.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "card" and not (12 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            found.append((m.start(), order, f"{kind}:{m.start()}:{m.end()}"))
    return ",".join(s for _, _, s in sorted(found))


PERSONAL = [
    "mail a.b+c@x-y.example.com or a@b.c._q@d.e now",
    "1.2.3.4.5.6.7.8 256.1.1.1 0255.1.1.1 1.2.3",
    "4111 1111 1111 1111 4111-1111-1111-1112 4111  1111 1111 1111",
    "+1 (555) 123-4567 ++49 30 1234567 +1234 +1........2",
    "\U0001f600 a@b.cd \x01 8.8.8.8 \x02",
    "123456789012@x.com a@1.2.3.4",
    "a" * 40_000 + "@" + "1" * 40_000,
    "1" * 50_000 + " " + "a@b.c " * 300,
]


def test_base_spans_equal_the_plain_patterns(spark, odd_rows):
    rows = odd_rows + list(enumerate(PERSONAL, 100))
    found = pii.digests(pii.find_personal_data(documents(spark, rows))).collect()
    expected = Counter((i, hashlib.sha256(base_spans(t).encode()).hexdigest()) for i, t in rows)
    assert Counter((r["doc_id"], r["base_sha256"]) for r in found) == expected
    assert {r["doc_id"]: r["n_email"] for r in found}[107] == 300


def test_contexts_find_unseen_identifiers(spark):
    rows = [(k, f"well, please write me at someone{k}@mail.example.com soon") for k in range(5)]
    rows += [(10, "please write me at agent007 soon"), (11, "a version 2.0 of it"), (12, "and look at room 12 there")]
    found = {r["doc_id"]: r["spans"] for r in pii.digests(pii.find_personal_data(documents(spark, rows))).collect()}
    assert found[10] == "context:19:27" and found[11] == "" and found[12] == ""
    masked = {r["doc_id"]: r["text"] for r in pii.mask_documents(documents(spark, rows)).collect()}
    assert masked[10] == "please write me at [CONTEXT] soon" and masked[0] == "well, please write me at [EMAIL] soon"
    assert masked[11] == rows[6][1]


def test_ordinary_words_behind_a_context_speak_against_it(spark):
    rows = [(k, f"send it to u{k}@mail.example.com") for k in range(4)] + [(50 + k, f"back to home{k * 'x'} again") for k in range(9)] + [(99, "to b52")]
    found = {r["doc_id"]: r["spans"] for r in pii.digests(pii.find_personal_data(documents(spark, rows))).collect()}
    assert found[99] == ""


def test_grouped_identifiers_are_masked_whole(spark):
    rows = [(k, f"account{'' if k % 2 else ' number'} is: person{k}@mail.example.com, thanks") for k in range(9)]
    rows += [(50, "account is: ES91 2100 0418 4502, thanks"), (51, "it takes 12 2100 steps")]
    masked = {r["doc_id"]: r["text"] for r in pii.mask_documents(documents(spark, rows)).collect()}
    assert masked[50] == "account is: [CONTEXT], thanks" and masked[51] == rows[10][1]


def test_context_words_of_any_length_and_words_behind(spark):
    long = "c" * 500
    rows = [(k, f"by {long} p{k}@mail.example.com") for k in range(5)] + [(10, f"by {long} agent007")]
    rows += [(20 + k, f"z{k * 'z'} q{k}@mail.example.com wrote") for k in range(5)] + [(30, "then agent8 wrote")]
    found = {r["doc_id"]: r["spans"] for r in pii.digests(pii.find_personal_data(documents(spark, rows))).collect()}
    assert found[10] == "context:504:512" and found[30] == "context:5:11"


def test_no_pattern_lends_belief_to_itself(spark):
    rows = [(k, f"please ask {'e%d@mail.example.com' % k if k < 5 else 'room%d' % k} now{k * 'w'}") for k in range(10)]
    found = {r["doc_id"]: r["spans"] for r in pii.digests(pii.find_personal_data(documents(spark, rows))).collect()}
    assert all(found[k] == "" for k in range(5, 10))


def test_many_matches_in_one_long_text(spark):
    text = "12 a1@b.co " * 450_000
    docs = documents(spark, [(1, text)])
    started = time.monotonic()
    row = pii.digests(pii.find_personal_data(docs)).first()
    masked = pii.mask_documents(docs).first()["text"]
    assert time.monotonic() - started < 240
    assert row["n_email"] == 450_000 and row["base_sha256"] == hashlib.sha256(base_spans(text).encode()).hexdigest()
    assert masked.count("[EMAIL]") == 450_000 and "@" not in masked


def test_masking_keeps_rows_and_columns(spark, odd_rows):
    docs = documents(spark, odd_rows)
    masked = pii.mask_documents(docs)
    assert masked.columns == docs.columns
    assert Counter((r["doc_id"], r["text"]) for r in masked.collect()) == Counter(odd_rows)
    assert pii.mask_documents(documents(spark, [])).count() == 0


def plain_statistics(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = list(zip(words, words[1:], words[2:]))
    found, covered, lines, repeated = Counter(windows), set(), set(), 0
    for k, w in enumerate(windows):
        if found[w] > 1:
            covered |= {k, k + 1, k + 2}
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            repeated += line in lines
            lines.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), repeated, len(covered)


def test_quality_statistics(spark, odd_rows):
    rows = odd_rows + [(20, "a b c a b c\n a b\n\na b\n a b\n"), (21, "# * $ % & | < >")]
    found = quality.quality_rules(documents(spark, rows)).collect()
    assert Counter((r["doc_id"], *(r[n] for n in quality.STATISTICS)) for r in found) == Counter((i, *plain_statistics(t)) for i, t in rows)
    assert all(r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"]) for r in found)
    assert not any(r["kept"] and r["base_failed"] for r in found)


def test_kneser_ney_sums_to_one():
    codes, _ = quality.trigram_codes(["the cat sat on the mat", "that hat", "été"])
    values, counts = np.unique(codes, return_counts=True)
    model = quality.KneserNey(values, counts)
    for context in (0, values[0] // quality.SYMBOLS, values[-1] // quality.SYMBOLS, 77):
        assert 2.0 ** model.log2(context * quality.SYMBOLS + np.arange(quality.SYMBOLS)) @ np.ones(quality.SYMBOLS) == pytest.approx(1.0)
    assert quality.KneserNey(np.zeros(0), np.zeros(0)).log2(np.array([5])) == pytest.approx(np.log2(1 / 128))


def test_bands_reject_what_reads_unlike_its_language(spark):
    rng = np.random.default_rng(1)
    words = "the old house by river stands and people walk along water every quiet evening until lights come on".split()
    rows = [(k, " ".join(rng.choice(words, 200))) for k in range(60)]
    rows += [(100, " ".join("".join(rng.choice(list("qxzjkvwpy#%$&"), 6)) for _ in range(200)))]
    found = {r["doc_id"]: r["kept"] for r in quality.quality_rules(documents(spark, rows)).collect()}
    assert not found[100] and all(found[k] for k in range(60))
    docs = documents(spark, rows)
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == set(range(60))
    assert quality.quality_rules(documents(spark, [])).count() == 0


def test_copies_of_one_text_do_not_narrow_the_band(spark):
    rng = np.random.default_rng(5)
    words = "the old house by river stands and people walk along water every quiet evening until lights come on".split()
    texts = [" ".join(rng.choice(words, 200)) for _ in range(61)]
    # one text has 80 % of the language
    rows = [*enumerate(texts[:60]), *((1000 + k, texts[60]) for k in range(240))]
    rows += [(100, " ".join("".join(rng.choice(list("qxzjkvwpy#%$&"), 6)) for _ in range(200)))]
    found = {r["doc_id"]: r["kept"] for r in quality.quality_rules(documents(spark, rows)).collect()}
    assert not found[100] and all(kept for k, kept in found.items() if k != 100)
    assert {r["doc_id"] for r in quality.keep_good(documents(spark, rows)).collect()} == found.keys() - {100}


def toxic_rows():
    rng = np.random.default_rng(2)
    plain = [f"w{k}" for k in range(300)]
    rows, labels = [], []
    for k in range(400):
        toxic = k % 8 == 0
        words = [*rng.choice(plain, 40), *(rng.choice(["stinker", "stinky", "rotter"], 3) if toxic else [])]
        rng.shuffle(words)
        rows.append((k, " ".join(words)))
        labels.append((k, 1, int(toxic)))
    return rows, labels


def test_toxicity_on_held_out_rows(spark):
    rows, labels = toxic_rows()
    extra = [(1000, None), (1001, ""), (None, "w1 w2"), (1002, "stinky " * 20_000), (7, rows[7][1])]
    docs = documents(spark, rows + extra)
    marks = spark.createDataFrame([*labels, (None, 0, 1), (5000, 1, None)], "doc_id long, quality int, toxic int")
    found = toxicity.score_toxicity(docs, marks).collect()
    assert len(found) == len(rows) + len(extra)
    held = [r for r in found if r["held_out"] and r["doc_id"] is not None and r["doc_id"] < 400]
    assert held and all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in held)
    assert all(r["predicted"] == (r["doc_id"] % 8 == 0) for r in held)
    by_id = {r["doc_id"]: r for r in found}
    assert by_id[1000]["score"] == by_id[1001]["score"] < 0.5 and by_id[1002]["predicted"] == 1
    kept = toxicity.drop_toxic(docs, marks)
    assert kept.columns == docs.columns and {0, 8, 1002}.isdisjoint(r["doc_id"] for r in kept.collect())


def test_without_labels_or_documents(spark):
    rows, labels = toxic_rows()
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r["score"] for r in toxicity.score_toxicity(documents(spark, rows[:5]), none).collect()} == {0.0}
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    assert toxicity.score_toxicity(documents(spark, []), marks).count() == 0


def test_all_examples_tied_with_the_last_neighbour_vote(spark):
    rows = [(k, "stinker " + f"w{k % 7} " * 5) for k in range(1, 1400)] + [(5000 + k, f"w{k % 7} w{k % 5}") for k in range(2000)]
    training = [(i, 1, int(i < 5000)) for i, _ in rows if zlib.crc32(str(i).encode()) % 5]
    # of those with the word, 90 toxic and 20 clean ones stay
    with_word = [x[0] for x in training if x[0] < 5000]
    marks = [(i, 1, int(i in set(with_word[:90]))) for i in with_word[:110]] + [x for x in training if x[0] >= 5000]
    docs = documents(spark, rows)
    model = toxicity.fit(docs, spark.createDataFrame(marks, "doc_id long, quality int, toxic int"))
    assert len(model.toxic) == 1 and model.rows.tolist() == [110] and model.toxic[0] == pytest.approx(90 / 110)
    score, near = model.score(toxicity._TermCounter(model.place).count("a stinker"))
    assert len(near) == 1 and score == pytest.approx(90 / 110, abs=0.01)
    # ties between entries as well
    entries = np.array([(e, 0, 0.5) for e in range(110)], [("example", np.int64), ("term", np.int64), ("weight", float)])
    tied = toxicity.Examples(["a"], np.ones(1), entries, np.repeat([0, 1], [20, 90]), np.ones(110), 0.0)
    assert tied.score(Counter({0: 1}))[0] > 0.8


def test_rare_toxic_words_stay_terms_beside_copies_of_one_text(spark):
    from tallywell.llm.catalog import make_importable

    make_importable(spark)
    rng = np.random.default_rng(4)
    plain = [f"w{k}" for k in range(300)]
    clean = [(" ".join(rng.choice(plain, 20)), 0, 1.0) for _ in range(2000)]
    # chi-square of the copies' words would be a hundred times that of the others
    copies = [("copied " + " ".join(plain[:10]), 1, 1.0)] * 900
    rare = [(f"vile{word} " + " ".join(rng.choice(plain, 20)), 1, 1.0) for word in "abcdefghij" * 15]
    terms = toxicity.choose_terms(spark.createDataFrame(clean + copies + rare, "text string, toxic int, share double"))
    assert "copied" not in terms and "vile*" in terms
    words = [(" ".join(rng.choice([f"x{k:03}y" for k in range(150)], 75, replace=False)), 1, 1.0) for _ in range(300)]
    terms = toxicity.choose_terms(spark.createDataFrame(clean + words, "text string, toxic int, share double"))
    assert sum(t.startswith("x") for t in terms) == 150


def test_block_max_search_is_exact():
    rng = np.random.default_rng(3)
    terms, examples = 30, 700
    dense = np.where(rng.random((examples, terms)) < 0.1, rng.random((examples, terms)), 0)
    dense[rng.random(examples) < 0.3] = dense[0]
    dense /= np.maximum(np.linalg.norm(dense, axis=1, keepdims=True), 1e-9)
    entries = np.array([(e, t, dense[e, t]) for e, t in zip(*np.nonzero(dense))], [("example", np.int64), ("term", np.int64), ("weight", float)])
    model = toxicity.Examples([str(t) for t in range(terms)], np.ones(terms), entries, np.zeros(examples, int), np.ones(examples), 0.0)
    for _ in range(40):
        chosen = np.sort(rng.choice(terms, 4, replace=False))
        weights = rng.random(4)
        scores = dense[:, chosen] @ weights
        found = model.nearest(chosen, weights)
        best = np.sort(scores[scores > 0])[::-1][:15]
        assert [s for _, s in found] == pytest.approx(best.tolist())
        assert all(scores[x] == pytest.approx(s) for x, s in found)


PAGES = [
    (
        "<html><head><title>T</title><style>p{}</style><script>var a='</p>';</script></head><body><nav><ul><li><a href=/a>Home</a></ul></nav>"
        "<!-- x --><div class='ad'>Buy</div><article><h1>Head</h1><p><b>One&nbsp;&amp;  two<br>three<p>Four</article><footer>&copy; me</footer>",
        "Head\nOne & two three\nFour",
    ),
    (
        "<body><div class='menu'><a href=x>Home</a> <a>News</a></div><div id=content><h1>Title</h1><p>A first paragraph that is long enough to be "
        "the text of a page that names no article, and more.<p>Second &amp; last.</div><div class='comments'><p>Nice read</div><div id='footer'>(c)</div>",
        "Title\nA first paragraph that is long enough to be the text of a page that names no article, and more.\nSecond & last.",
    ),
    ("<main><header><h1>T</h1></header><p>x</p><div class='ad box'>buy<p>now</p></div><form>q<input></form><p>z &lt;b&gt;</p></main><p>after", "T\nx\nz <b>"),
    ("<article><p hidden>no</p><p title='a>b'>yes</p></article><article class='comment'><p>a very long comment about it all</article>", "yes"),
    ("a < b and c", "a < b and c"),
    ("", ""),
    (None, ""),
    ("<div>", ""),
    ("<p>" + "long " * 50_000, ("long " * 50_000).strip()),
]


def test_pages(spark):
    from tallywell.llm.catalog import make_importable

    make_importable(spark)
    pages = spark.createDataFrame([(k, f"u{k}", html, "t", 1) for k, (html, _) in enumerate(PAGES)], "page_id long, url string, html string, text string, n_chars int")
    rows = sorted(html_text.extract_pages(pages).collect(), key=lambda r: r["page_id"])
    assert [r["text"] for r in rows] == [text for _, text in PAGES]
    assert all(r["n_chars"] == len(r["text"]) and r["url"] == f"u{r['page_id']}" for r in rows)
    assert html_text.extract_pages(pages.limit(0)).count() == 0


LONG = "A paragraph of the article that is long enough for a window of lines to surge at it, even alone."
SIDE = "<div class=ad><p>Buy</p><p>now</p><p>here</p></div>"
LINKED = "<ul><li><a href=a>One story</a><li><a href=b>Another story</a><li><a href=c>A third story</a></ul>"


@pytest.mark.parametrize(
    "html, text",
    [
        (f"<body><div class=x><p>{LONG} 1<p>{LONG} 2{SIDE}<p>Short.<p>{LONG} 3</div>", f"{LONG} 1\n{LONG} 2\nShort.\n{LONG} 3"),
        (f"<body><p>{LONG} 1</p>{SIDE}<p>{LONG} 2</p></body>", f"{LONG} 1\n{LONG} 2"),
        (f"<article><p>{LONG}</p><div>{LINKED}</div></article>", LONG),
        (f"<main><p>Teaser</p></main><div class=x><p>{LONG}<p>{LONG}</div>", f"Teaser\n{LONG}\n{LONG}"),
    ],
)
def test_surges_and_dives_pick_the_text(html, text):
    assert html_text.main_text(html) == text


@pytest.mark.parametrize(
    "page",
    [
        "<a " * 1_700_000,
        "<!--" * 1_250_000,
        "<a title='" * 500_000,
        "<script>" + "</script " * 500_000,
        '<a ">" ' * 300_000 + '"',
        "<div>" * 100_000 + "</span></section>" * 50_000,
        "<i><div>" + "<b>" * 100_000 + "</i><p></p>" * 50_000,
        "<p><ul>" + "<b>" * 100_000 + "<p></p>" * 50_000,
    ],
    ids=["tags", "comments", "quotes", "script", "attributes", "containers", "closings", "paragraphs"],
)
def test_malformed_pages_take_one_pass(page):
    begin = time.process_time()
    html_text.main_text("<p>text " + page)
    assert time.process_time() - begin < 10


def test_unclosed_markup_keeps_its_text():
    assert [x.text for x in html_text.lines_of("<p>one <b two")] == ["one <b two"]
    assert [x.text for x in html_text.lines_of("<p>one<!-- two > three")] == ["one"]
    assert [x.text for x in html_text.lines_of("<p>one<!--> two")] == ["one"]
    assert [x.text for x in html_text.lines_of("<div><p>a<ul><li>b<li>c</ul><i>d</div>e")] == ["a", "b", "c", "d", "e"]
