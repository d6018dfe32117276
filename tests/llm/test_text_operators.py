import hashlib
import random

import pytest

from shelfmark.llm import extraction, fingerprints, languages, tokens, toxicity

from .conftest import EDGE, LONG


@pytest.mark.parametrize("model", ["piece_bpe_32k.model", "byte_bpe_50k.json"])
def test_spliced_counts_equal_whole_counts(model):
    encoder, rng = tokens.encoder(model), random.Random(5)
    texts = ["a" * 900, "x" * 300 + " " + "y" * 700, " " * 500, "\n\n a b  c\n" * 90, "<s> <|endoftext|> " * 60, "ab cd " * 200, "a b" * 200 + "q" * 900 + " r s" * 90]
    texts += ["".join(rng.choice("ab cé \n☃.1") for _ in range(900)) for _ in range(20)]
    for text in texts:
        for chunk, overlap in ((100, 4), (333, 32)):
            assert tokens.spliced_count(text, encoder.starts, chunk, overlap) == encoder.counts([text])[0]


def test_token_counts_of_edge_rows(edge, nothing):
    encoder = tokens.encoder(tokens.MODEL)
    key = lambda r: str(r)
    got = sorted(((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in tokens.count_tokens(edge, chunk=2000).collect()), key=key)
    want = [(i, len((t or "").encode()), n := encoder.counts([t])[0] if t else 0, n > 4096) for i, t in EDGE]
    assert got == sorted(want, key=key)
    assert tokens.count_tokens(nothing).count() == 0


def test_fingerprints_follow_the_edit_rule(docs_of, nothing):
    rows = [(i, t) for i, t in EDGE if i not in (4, None)] + [(4, "one\ntwo"), (30, "two\none"), (31, LONG), (None, "first")]
    got = fingerprints.fingerprint_documents(docs_of(rows)).collect()
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    for (i, text), (_, following) in zip(ordered, ordered[1:] + ordered[:1]):
        text, following = text or "", following or ""
        half = len(text) // 2
        row = next(r for r in got if r.doc_id == i)
        assert (row.n_chars, row.edited_sha256) == (len(text), hashlib.sha256((text[: len(text) - half] + following[:half]).encode()).hexdigest())
        assert 0 <= row.near_edited <= 1 and 0 <= row.near_next <= 1
    by = {r.doc_id: r for r in got}
    assert len(got) == len(rows)
    assert by[7].fingerprint == by[8].fingerprint == by[31].fingerprint and by[7].near_next == 1.0
    assert by[4].fingerprint == by[30].fingerprint != by[5].fingerprint
    assert by[1].fingerprint == by[2].fingerprint
    assert fingerprints.fingerprint_documents(nothing).count() == 0
    single = fingerprints.fingerprint_documents(docs_of([(1, "abcd")])).first()
    assert single.edited_sha256 == hashlib.sha256(b"abab").hexdigest() and single.near_next == 1.0


def test_fingerprint_edits_without_the_text():
    made = fingerprints.encoded(*fingerprints.vectors(["a line\nb line\nc line", "c line\nnew\na line"]))
    assert fingerprints.changed(made[0], insert=["new"], delete=["b line"]) == made[1]


def test_likeness_of_long_repetitive_texts(docs_of):
    rules = ("=" * 80 + "\n") * 1000
    got = {r.doc_id: r for r in fingerprints.fingerprint_documents(docs_of([(1, "a" * 40_000), (2, "b" * 40_000), (3, rules), (4, rules + "end")])).collect()}
    # half of the equal windows stay: 2 * 1 * 0.5 / (1 + 0.25 + 0.25)
    assert got[1].near_edited == pytest.approx(2 / 3, abs=0.01) and got[1].near_next < 0.01
    assert got[3].near_edited > 0.99 and got[3].near_next > 0.99
    whole = fingerprints.encoded(*fingerprints.vectors(["c" * 40_000 + "\nline", "line"]))
    assert fingerprints.changed(whole[0], delete=["c" * 40_000]) == whole[1]


PAGE = (
    "<html><head><title>T</title><script>x='<p>no</p>'</script></head><body><header><a href=/>Home</a></header><nav><ul><li><a href=a>one</a></ul></nav>"
    "<div class='cookie-notice'>We use cookies and a lot of words about them, more than the article has, really many words.</div>"
    "<article><h1>Head &amp; line</h1><p>First   <b>bold</b>\n text.<p>Second&nbsp;one<br>goes on.<form><input value=q>Send</form></article>"
    "<section id=comments><p>Nice post, thanks</p></section><aside>More</aside><footer>&copy; me")


def test_main_text(spark):
    rows = [(1, "u", PAGE), (2, "u", None), (3, None, ""), (4, "u", "plain words"), (5, "u", "<p"), (None, "u", PAGE), (6, "u", "<div>" * 3000 + "deep")]
    pages = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, text string")
    got = {r.page_id: (r.text, r.n_chars) for r in extraction.extract_pages(pages).collect()}
    want = "Head & line\n\nFirst bold text.\n\nSecond one goes on."
    assert got[1] == got[None] == (want, len(want))
    assert got[2] == got[3] == got[5] == ("", 0) and got[4] == ("plain words", 11) and got[6] == ("deep", 4)
    assert extraction.extract_pages(pages.filter("false")).count() == 0


def test_density_finds_text_without_an_article(spark):
    body = "".join(f"<p>Paragraph {i} has a good many words, so that it is dense, long and clearly text.</p>" for i in range(6))
    html = f"<body><div><a href=1>a</a> <a href=2>b</a> <a href=3>c</a></div><div id=x>{body}</div><div class='sidebar'>other things</div></body>"
    assert extraction.main_text(html) == "\n\n".join(f"Paragraph {i} has a good many words, so that it is dense, long and clearly text." for i in range(6))


LINES = "".join(f"<p>Paragraph {i} has a good many words, so that it is dense, long and clearly text.</p>" for i in range(6))
LINKS = "".join(f"<li><a href=s{i}>Source number {i}</a></li>" for i in range(5))


@pytest.mark.parametrize("html, kept, dropped", [
    (f"<body><div class='content has-sidebar'>{LINES}</div></body>", ["Paragraph 5"], []),
    (f"<body><div id='main-menu-page'><article>{LINES}</article></div></body>", ["Paragraph 5"], []),
    (f"<body><section class='no-comments'><article>{LINES}</article></section></body>", ["Paragraph 5"], []),
    (f"<body><div class='comments'>{LINES}</div></body>", ["Paragraph 5"], []),
    (f"<article><div class='article-header'><h1>Title</h1></div>{LINES}</article>", ["Title", "Paragraph 5"], []),
    (f"<article><header class='post-header'><h1>Title</h1></header>{LINES}</article>", ["Title", "Paragraph 5"], []),
    (f"<article>{LINES}<h2>Sources</h2><ul>{LINKS}</ul></article>", ["Paragraph 5", "Source number 4"], []),
    (f"<article>{LINES}<section id='legal'><p>{'The law says many things on this. ' * 9}</p></section></article>", ["The law says"], []),
    (f"<article>{LINES}<div class='comments'>{LINES.replace('Para', 'Comment para')}</div></article>", ["Paragraph 5"], ["Comment"]),
    (f"<article>{LINES}<div class='related-posts'><ul>{LINKS}</ul></div></article>", ["Paragraph 5"], ["Source"]),
    (f"<body><main>{LINES}</main><div class='related'><article>Other <a href=1>thing</a></article></div></body>", ["Paragraph 5"], ["Other"]),
    (f"<body><div class='navbar'><ul>{LINKS}</ul></div><div>{LINES}</div></body>", ["Paragraph 5"], ["Source"]),
])
def test_class_words_are_weighed(html, kept, dropped):
    text = extraction.main_text(html)
    assert all(t in text for t in kept) and not any(t in text for t in dropped)


CARDS = "".join(f"<div><h3><a href=c{i}>Card {i}</a></h3><p>Short card text</p><a href=c{i}>more</a></div>" for i in range(6))


@pytest.mark.parametrize("html, kept, dropped", [
    (f"<main><h1>Title</h1><div>{LINES}</div><div>{CARDS}</div></main>", ["Title", "Paragraph 5"], ["Card 3", "Short card"]),
    (f"<main><h1>Title</h1>{LINES}<div>{'<a href=1>Card</a> ' * 4}</div></main>", ["Title", "Paragraph 5"], ["Card"]),
    (f"<body><article>{LINES}</article><article>{LINES.replace('Para', 'Second para')}</article></body>", ["Paragraph 5", "Second paragraph 5"], []),
    (f"<body><div><article>{LINES}</article></div><div><article>{LINES.replace('Para', 'Other para')}</article></div><article><a href=1>Card</a></article></body>", ["Paragraph 5", "Other paragraph 5"], ["Card"]),
    (f"<article><h1>Title</h1><section><h2>One</h2>{LINES}</section><section><h2>Two</h2><p>Short.</p></section></article>", ["Title", "One", "Paragraph 5", "Two", "Short."], []),
    (f"<main><h1>Title</h1><p>Lead.</p><div>{LINES}</div><p>End with <a href=1>link</a> in it, as they say.</p></main>", ["Title", "Lead.", "Paragraph 5", "End with link"], []),
])
def test_density_selects_inside_and_beside_articles(html, kept, dropped):
    text = extraction.main_text(html)
    assert all(t in text for t in kept) and not any(t in text for t in dropped)


def _talk(rng, words):
    return " ".join(rng.choice(words) for _ in range(60))


def test_language_held_out_accuracy(docs_of, nothing):
    rng = random.Random(2)
    speech = {"en": "the of and with from house water they".split(), "fr": "le de et avec maison être où déjà".split(), "de": "der und mit haus über können straße nicht".split()}
    rows = [(i, _talk(rng, speech[lang]), lang) for i in range(300) for lang in [rng.choice(list(speech))]]
    rows += [(1000, None, "en"), (1001, "", "fr"), (1002, "12 $$", "de"), (1003, _talk(rng, speech["fr"]), None), (None, _talk(rng, speech["de"]), "de")]
    got = {r.doc_id: r for r in languages.identify(docs_of(rows)).collect()}
    assert all(got[i].lang_pred == lang for i, _, lang in rows[:300] if got[i].held_out)
    assert [got[i].lang_pred for i in (1000, 1001, 1002, 1003, None)] == ["und", "und", "und", "fr", "de"]
    assert all(0 <= r.score <= 1 for r in got.values()) and any(r.held_out for r in got.values())
    mixed = " ".join([_talk(rng, speech["en"])] * 3 + [_talk(rng, speech["fr"])])
    row = languages.identify(docs_of([*rows, (5000, mixed, None)])).filter("doc_id = 5000").first()
    assert row.lang_pred == "en" and 0.55 < row.score < 0.95
    kept = languages.identified(docs_of(rows))
    assert kept.columns == docs_of(rows).columns and kept.count() == len(rows) - 3
    assert languages.identify(nothing).count() == 0


def test_toxicity_held_out(spark, docs_of, nothing):
    rng = random.Random(3)
    plain, bad = [f"w{i}" for i in range(300)], ["vileword", "nastyone", "uglyterm"]
    rows, marks = [], []
    for i in range(900):
        toxic = i % 5 == 0
        text = [rng.choice(plain) for _ in range(40)] + (rng.sample(bad, 2) if toxic else [])
        rng.shuffle(text)
        rows.append((i, " ".join(text)))
        marks.append((i, 0, int(toxic)))
    rows += [(5000, None), (5001, ""), (None, "vileword nastyone"), (5002, LONG)]
    labels = spark.createDataFrame([*marks, (5000, 0, None), (None, 0, 1), (3, 0, 0)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in toxicity.score_toxicity(docs_of(rows), labels).collect()}
    held = [(got[i], toxic) for i, _, toxic in marks if got[i].held_out]
    assert sum(r.predicted == t for r, t in held) / len(held) > 0.97
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got.values()) and got[5000].score == got[5001].score and got[5001].predicted == 0
    none = toxicity.score_toxicity(docs_of(rows[:5]), labels.filter("false")).collect()
    assert len(none) == 5 and len({r.score for r in none}) == 1
    assert toxicity.score_toxicity(nothing, labels).count() == 0


def test_stray_tags_cost_no_climb():
    import time

    text = "<p>" + "A paragraph with a good many words that is clearly text and no menu. " * 5 + "</p>"
    began = time.process_time()
    root = extraction.parse("<article>" + "<b>" * 1000 + "</i>" * 200_000 + "</b>" * 1000 + text + "</article>")
    assert time.process_time() - began < 5
    assert [c.tag for c in root.children] == ["article"] and root.children[0].children[-1].tag == "p"
