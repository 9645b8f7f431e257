"""Page text, classifiers, URLs, tokenizers and the pipeline against plain versions."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

import corpus_pipeline
from gradeflow.llm import bpe, html_extraction, markup, quality, token_counts, toxicity, urls

PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORDS = public_tokenizers.path("word_bpe_49k.json")

PAGES = "page_id long, url string, html string, host string, hash long, text string, n long, templates string"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "h", 1, "t", 2, "x") for r in rows], PAGES).repartition(3)


def block_text(html):
    return markup.main_text(markup.parse(html), frozenset())


@pytest.mark.parametrize(
    ("html", "text"),
    [
        ("", ""),
        ("plain  text\n here", "plain text here"),
        ("<p>a &amp; b&nbsp;&eacute;&#x41;</p><p>c", "a & b éA\n\nc"),
        ("<body><nav>x</nav><header>y</header><p>one<p>two<footer>z</footer>", "one\n\ntwo"),
        ("<article><header><h1>t</h1></header><p><b>a<br><p>b</p></article><p>c</p>", "t\n\na\n\nb"),
        ("<script>var a='</p>';</script><style>p{}</style><title>t</title>x", "x"),
        ("a<!-- b --> c <!-- d", "a c"),
        ("a < b <c", "a < b"),
        ("<div class='ad-box'>x</div><div id=cookie-notice>y</div><div>z</div>", "z"),
        ("<article><p>a</p><div class=comments><p>b</p></div><aside>c</aside></article>", "a"),
        ("<main><p>a</p><form><p>b</p></form></main><div>c</div>", "a"),
        ("<ul><li>a<li>b</ul><table><tr><td>c<td>d</table>", "a\n\nb\n\nc\n\nd"),
        ("</div></p>a</b><div>b", "a\n\nb"),
        ('<p title="a > b" class="x">c</p>', "c"),
        ("<p hidden>a</p><p aria-hidden='true'>b</p><p style='display: none'>c</p>d", "d"),
        ("<article class='comment'><p>a</p></article><article><p>b</p></article>", "b"),
        ("<p>a<textarea>b</textarea><svg><text>c</text></svg></p>", "a"),
        ("<div>" * 5000 + "deep", "deep"),
        ("x" * 300_000 + "<a" * 1000, "x" * 300_000),
    ],
)
def test_blocks_of_markup(html, text):
    assert block_text(html) == text


@pytest.mark.parametrize("name", ["font", "div", "b", "span"])
def test_no_number_of_open_elements_changes_the_text(name):
    many = f"<{name}>" * 5000
    rest = "<form><p>f</p></form><div class=comments><p>c</p></div><nav>n</nav><article>x</article><p>b</p></article><p>out</p>"
    assert block_text(f"<article><p>a</p>{many}{rest}") == "a\n\nx\n\nb"
    # Each step looks at the top of the stack only, or this would take hours.
    deep = "".join(f"<{name}><li>{i}" for i in range(50_000)) + "</ul></i>" * 50_000
    assert block_text(deep).count("\n\n") == 49_999


def test_templates_of_a_host_are_removed_and_copies_kept(spark):
    notice = "<div><p>Join   us</p><p>today</p></div>"
    rows = [(i, f"http://A.org/{i}", f"<body>{notice}<p>own {i}</p></body>") for i in range(30)]
    rows += [(100 + i, f"http://b.org/{i}", f"<body>{notice}<p>own {i}</p></body>") for i in range(3)]
    rows += [(200 + i, "http://c.org/x", "<article><h1>T</h1><p>same</p></article>") for i in range(40)]
    rows += [(300, None, "<p>n</p>"), (301, "no scheme", None), (302, "http://a.org/", ""), rows[0], rows[0]]
    got = html_extraction.extract(pages(spark, rows)).collect()
    wanted = []
    for page_id, url, html in rows:
        text = block_text(html or "")
        if url and url.startswith("http://A"):
            text = f"own {page_id}"
        wanted.append((page_id, url, text, len(text)))
    assert sorted(map(str, wanted)) == sorted(str((r.page_id, r.url, r.text, r.n_chars)) for r in got)
    assert html_extraction.extract(pages(spark, [])).collect() == []


@pytest.mark.parametrize(
    "html",
    [
        "<body><div id=page><article><h1>T</h1><p>same</p></article></div></body>",
        "<article><div class=body><p>same</p><p>text</p></div></article>",
        "<article><section><h2>T</h2><ul><li>a</li><li>b</li></ul></section></article>",
        "<article><p>x</p><table><tr><td>a</td><td>b</td></tr></table><figure><img>c</figure><ol><li>d</ol></article>",
        "<body><div><p>same</p><div>loose text</div></div></body>",
    ],
)
def test_copies_keep_their_text_in_whatever_elements(spark, html):
    rows = [(i, f"http://c.org/{i}", f"<nav>{i}</nav>{html}<footer>f {i}</footer>") for i in range(40)]
    rows += [rows[0]] * 20
    got = html_extraction.extract(pages(spark, rows)).collect()
    assert len(got) == 60 and {r.text for r in got} == {block_text(html)}


def test_counts_decide_on_every_subtree(spark):
    around = "<nav><ul><li><a>Home</a></li><li>News</li></ul></nav><div class=ad>Buy</div><p>Loose <b>words</b></p>"
    inside = "<p>Read more on our site.</p><ul><li>Share this</li></ul><div>loose</div>"
    html = [f"{around}<article><h1>T {i}</h1><p>own {i}</p>{inside}</article>" for i in range(30)]
    rows = [(i, f"http://a.org/{i}", text) for i, text in enumerate(html)]
    rows += [(100 + i, f"http://b.org/{i}", text) for i, text in enumerate(html[:3])]
    got = {r.page_id: r.text for r in html_extraction.extract(pages(spark, rows)).collect()}
    # Inside an article a list or a division goes, its own headings and paragraphs stay.
    wanted = {i: f"T {i}\n\nown {i}\n\nRead more on our site." for i in range(30)}
    assert got == wanted | {100 + i: f"{wanted[i]}\n\nShare this\n\nloose" for i in range(3)}
    # What is marked as around the text is counted as well, alone and as a whole.
    found = html_extraction.templates(html_extraction.with_parts(pages(spark, rows[:30]).select("page_id", "url", "html")))
    hashes = {h for r in found.collect() for h in r.templates}
    page = markup.parse(html[0], "a.org")
    inner = [i for i, level in enumerate(page.within) if level == 2]
    assert {page.blocks[i] for i in inner} == {"T 0", "own 0", "Read more on our site.", "Share this", "loose"}
    alone = {page.blocks[t.start] for t in page.subtrees if t.stop == t.start + 1 and t.hash in hashes}
    assert alone == {"Home", "News", "Buy", "Loose words", "Share this", "loose"}
    assert any(t.hash in hashes and t.stop - t.start == 2 and page.blocks[t.start] == "Home" for t in page.subtrees)


def test_articles_keep_recurring_headings_and_paragraphs_as_the_host_grows(spark):
    def page(i):
        return f"<article><h1>Weekly</h1><p>own {i}</p><section><h2>Notes</h2><p>note {i}</p></section><p>As ever.</p></article>"

    def texts(count):
        rows = [(i, f"http://a.org/{i}", page(i)) for i in range(count)]
        return {r.page_id: r.text for r in html_extraction.extract(pages(spark, rows)).collect()}

    small, large = texts(20), texts(40)
    assert small == {i: f"Weekly\n\nown {i}\n\nNotes\n\nnote {i}\n\nAs ever." for i in range(20)}
    assert all(large[i] == text for i, text in small.items())


def test_templates_do_not_depend_on_host_size(spark):
    box = "<div><p>Side box</p></div>"
    # On the large host the box is on one page in 50, and the foot is hot.
    large = [f"{box if i % 50 == 0 else ''}<p>own {i}</p><p>Foot</p>" for i in range(1000)]
    rows = [(i, f"http://large.org/{i}", text) for i, text in enumerate(large)]
    rows += [(2000 + i, f"http://small.org/{i}", f"{box}<p>own {i}</p><p>Foot</p>") for i in range(20)]
    rows += [(3000 + i, f"http://less.org/{i}", f"{box if i < 7 else ''}<p>own {i}</p>") for i in range(40)]
    got = {r.page_id: r.text for r in html_extraction.extract(pages(spark, rows)).collect()}
    wanted = {i: f"own {i % 1000}" for i in (*range(1000), *range(2000, 2020), *range(3000, 3040))}
    assert got == wanted | {3000 + i: f"Side box\n\nown {i}" for i in range(7)}


DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, label int, digest string"


def documents(spark, rows):
    return spark.createDataFrame([(i, t, "en", f"s{(i or 0) % 3}", 0, 1.0, 2, "d") for i, t in rows], DOCS).repartition(3)


def labels(spark, rows):
    return spark.createDataFrame([(i, q, x, 0.5) for i, q, x in rows], "doc_id long, quality int, toxic int, score double")


def corpus(seed, count=600):
    """Documents of random words; bad ones have shouted lines, toxic ones words of their own."""
    chance = random.Random(seed)
    word = lambda: "".join(chance.choices("abcdefgh", k=chance.randint(2, 8)))
    docs, marks = [], []
    for i in range(count):
        bad, toxic = chance.random() < 0.3, chance.random() < 0.3
        lines = [" ".join(word() for _ in range(chance.randint(5, 30))).capitalize() + "." for _ in range(6)]
        if bad:
            lines = [(line + " " + line).upper().replace(" ", "!! ") for line in lines]
        if toxic:
            lines[chance.randrange(6)] += " zounds blaggard" if chance.random() < 0.5 else " blaggard knave"
        docs.append((i, "\n".join(lines)))
        marks.append((i, int(not bad), int(toxic)))
    odd = [(count, None), (count + 1, ""), (count + 2, " \n "), (count + 3, "Word " * 50_000), (None, "alone"), docs[0], docs[0]]
    return docs + odd, [*marks, (None, 1, 1), (3, None, None), (7, marks[7][1], marks[7][2])]


@pytest.mark.parametrize(
    ("operator", "column", "modulus", "remainder", "threshold"),
    [(quality, 1, 5, 0, 0.3), (toxicity, 2, 3, 1, 0.7)],
)
def test_classifiers_on_documents_they_did_not_see(spark, operator, column, modulus, remainder, threshold):
    rows, marks = corpus(3)
    got = operator.classify(documents(spark, rows), labels(spark, marks)).collect()
    assert len(got) == len(rows)
    truth = {m[0]: m[column] for m in marks if m[0] is not None and m[column] is not None}
    right = []
    for r in got:
        held = zlib.crc32(str("" if r.doc_id is None else r.doc_id).encode()) % modulus == remainder
        assert r.held_out == held and 0 <= r.score <= 1 and r.predicted == int(r.score >= threshold)
        if held and r.doc_id in truth:
            right.append(r.predicted == truth[r.doc_id])
    assert len(right) > 50 and np.mean(right) > 0.95
    assert len({r.score for r in got if r.doc_id == 0}) == 1


@pytest.mark.parametrize("operator", [quality, toxicity])
def test_classifiers_learn_nothing_from_held_out_labels(spark, operator):
    rows, marks = corpus(5, 150)
    held = lambda i: zlib.crc32(str(i).encode()) % operator.MODULUS == operator.REMAINDER
    turned = [(i, 1 - q, 1 - x) if i is not None and q is not None and held(i) else (i, q, x) for i, q, x in marks]
    scores = [
        sorted((str(r.doc_id), r.score) for r in operator.classify(documents(spark, rows), labels(spark, m)).collect())
        for m in (marks, turned)
    ]
    assert scores[0] == scores[1]


@pytest.mark.parametrize("operator", [quality, toxicity])
def test_classifiers_without_examples(spark, operator):
    none = labels(spark, [])
    assert operator.classify(documents(spark, []), none).collect() == []
    got = operator.classify(documents(spark, [(1, "a b"), (2, None)]), none).collect()
    assert {r.score for r in got} == {0.5 if operator is quality else 0.0}
    same = labels(spark, [(1, 1, 1), (2, 1, 1), (3, 1, 1), (4, 1, 1)])
    got = operator.classify(documents(spark, [(i, "a b") for i in range(1, 5)]), same).collect()
    assert {r.score for r in got} == {1.0}


def plain_terms(text):
    """Words, and how many longer ones begin with the same four letters, in doublings."""
    out = {}
    for word in re.findall(r"[^\W\d_]+", text.lower()):
        out[word] = out.get(word, 0) + 1
    begun = {}
    for word, n in out.items():
        if len(word) > 4:
            begun[word[:4]] = begun.get(word[:4], 0) + n
    for prefix, n in begun.items():
        for power in range(20):
            if 2**power <= n:
                out[f"{prefix}*{2**power if power else ''}"] = 1
    return out


def plain_neighbours(examples, text, k=15):
    """(-cosine, doc_id) over all terms of all examples, with the weights written out."""
    n, toxic = len(examples), sum(label for *_, label in examples)
    counts = {i: plain_terms(t) for i, t, _ in examples}
    df, tdf = {}, {}
    for i, _, label in examples:
        for term in counts[i]:
            df[term] = df.get(term, 0) + 1
            tdf[term] = tdf.get(term, 0) + label
    rate = toxic / n

    def weight(term):
        p, more = tdf[term] / df[term], 0.0
        if p > rate:
            more = df[term] * (p * math.log(p / rate) + ((1 - p) * math.log((1 - p) / (1 - rate)) if p < 1 else 0))
        return math.log(1 + n / df[term]) * (1 + max(0.0, more - math.log(len(df))))

    def vector(c):
        v = {t: (1 + math.log(m)) * weight(t) for t, m in c.items() if t in df}
        norm = math.sqrt(sum(x * x for x in v.values())) or 1
        return {t: x / norm for t, x in v.items()}

    asked = vector(plain_terms(text))
    near = []
    for i, _, _ in examples:
        own = vector(counts[i])
        near.append((-round(sum(x * own.get(t, 0) for t, x in asked.items()), 9), i))
    return sorted(x for x in near if x[0] < 0)[:k]


def test_neighbours_equal_all_cosines_over_all_words(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "BLOCK", 4)
    monkeypatch.setattr(toxicity, "OFTEN", 5)
    chance = random.Random(4)
    word = lambda: "".join(chance.choices("abcdé", k=chance.randint(1, 7)))
    stock = [word() for _ in range(150)]
    insults = ["rotter", "rottene", "rottish"]
    examples = []
    for i in range(240):
        text = chance.choices(stock, k=chance.randint(0, 40)) + [word() for _ in range(3)]
        toxic = int(chance.random() < 0.2)
        if toxic and chance.random() < 0.8:
            text[1:1] = chance.choices(insults, k=chance.randint(1, 4))
        examples.append((i, " ".join(text), toxic))
    rows = spark.createDataFrame(examples, "doc_id long, text string, label int").repartition(3)
    index = toxicity.learn(rows)
    asked = [t for _, t, _ in examples[::8]] + ["rotters Rotting", "nothing known here 12", "", stock[0]]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(asked)], "doc_id long, text string")
    got = {r.doc_id: r.evidence for r in toxicity.score(docs, index).collect()}
    for i, text in enumerate(asked):
        want = plain_neighbours(examples, text)
        assert [-round(e.cosine, 9) for e in got[i]] == pytest.approx([c for c, _ in want], abs=2e-9)
        last = want[-1][0] if want else 0
        assert {e.doc_id for e in got[i] if -e.cosine < last - 1e-8} == {d for c, d in want if c < last - 1e-8}
    # No word is left out: toxic examples without an insult are found by their other words.
    plain = [i for i, t, toxic in examples[::8] if toxic and not any(w in t for w in insults)]
    assert plain and all(got[i // 8][0].doc_id == i for i in plain)
    assert got[len(asked) - 3] == [] and got[len(asked) - 2] == []


def test_marginals_equal_all_labellings():
    chance = np.random.default_rng(1)
    emissions, counts, moves = chance.normal(size=9), np.array([4, 1, 3, 1]), chance.normal(size=(2, 2))
    good, expected = quality.marginals(emissions, counts, moves)
    start = 0
    for chain, n in enumerate(counts):
        weights, pairs = {}, np.zeros((2, 2))
        for number in range(2**n):
            ys = [number >> i & 1 for i in range(n)]
            score = sum(y * e for y, e in zip(ys, emissions[start : start + n])) + sum(moves[a, b] for a, b in zip(ys, ys[1:]))
            weights[tuple(ys)] = np.exp(score)
        total = sum(weights.values())
        for ys, w in weights.items():
            for a, b in zip(ys, ys[1:]):
                pairs[a, b] += w / total
        for i in range(n):
            assert np.isclose(good[start + i], sum(w for ys, w in weights.items() if ys[i]) / total)
        assert np.allclose(expected[chain], pairs)
        start += n


def brute_rule(host, path):
    best = None
    for verdict, rule in urls.RULES:
        domain, _, rest = rule.partition("/")
        fits = (host == domain or host.endswith("." + domain)) and path.startswith("/" + rest)
        if fits and (best is None or len(rule) > len(best[1])):
            best = (verdict, rule)
    return best or (None, None)


def brute_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end])
    return host, rest[end:].split("?")[0].split("#")[0]


def test_urls_follow_the_rules(spark):
    chance = random.Random(6)
    rows = [None, "", "x", "://", "http://", "a://net", "a://net/", "a://Example.NET/en/x://y", "a://xnet/", "a://É.NET?/b"]
    rows += ["a://example.com/de/?/fr/", "a://example.com/de", "a://b.org/fr/\n/c", "a://b.org#/fr/", "http://" + "q" * 99999 + ".net/"]
    for _ in range(400):
        host = chance.choice(["", "www.", "M."]) + chance.choice(["example", "spam", "x1"]) + "." + chance.choice(["net", "com", "org"])
        rows.append(f"http://{host}/{chance.choice(['en', 'de', 'fr'])}/{chance.randint(1, 999)}{chance.choice(['', '?a=1&b=2', '#t'])}")
    rows += [rows[-1]] * 3
    shape = "page_id long, url string, html string, host string, label int, rule string, f_length int, features int"
    made = spark.createDataFrame([(i, u, None, "h", 1, "r", 2, 3) for i, u in enumerate(rows)], shape)
    got = {r.page_id: r for r in urls.judge(made).collect()}
    assert len(got) == len(rows)
    for i, url in enumerate(rows):
        host, path = brute_parts(url)
        verdict, rule = brute_rule(host, path)
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, rule)
        assert got[i].verdict == verdict if verdict else got[i].verdict == ("block" if got[i].score >= 0.5 else "allow")
    assert {got[i].score >= 0.5 for i in range(15, len(rows)) if got[i].rule} == {True, False}
    right = [(got[i].score >= 0.5) == (got[i].verdict == "block") for i in range(15, len(rows)) if got[i].rule]
    assert np.mean(right) > 0.95


def test_urls_without_labels(spark):
    none = spark.createDataFrame([], "page_id long, url string")
    assert urls.judge(none).collect() == []
    got = urls.judge(spark.createDataFrame([(1, "http://a.com/"), (2, None)], none.schema)).collect()
    assert [(r.verdict, r.score) for r in got] == [("allow", 0.0)] * 2
    got = urls.judge(spark.createDataFrame([(1, "http://a.net/"), (2, None)], none.schema)).collect()
    assert [r.verdict for r in got] == ["block"] * 2


SIGNS = [" ", " ", "  ", "\n", "\t", "\r", "the", "The", "don't", "É", "é", "e\u0301", "ΣΑΣ", "42", "...", "!!", "<|endoftext|>"]
SIGNS += ["<|ENDOFTEXT|>", "<s>", "▁", "\u3000", "\xa0", "漢字", "😀", "İ", "ß", "\x00", "\x1c", "'s", "_", "x" * 70]


def odd_texts(seed, count):
    chance = random.Random(seed)
    texts = ["".join(chance.choices(SIGNS, k=chance.randint(0, 40))) for _ in range(count)]
    shared = " ".join("".join(chance.choices("abcdef", k=6)) for _ in range(400))
    return [*texts, None, "", shared, "start " + shared, shared + ", end", "a" * 40_000, "ab c " * 20_000, texts[0], texts[0]]


def test_token_counts_equal_the_library(spark):
    rows = [*enumerate(odd_texts(1, 400)), (None, "no id")]
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    got = token_counts.count_tokens(documents(spark, rows), PIECES, remembered=50, table_size=20).collect()
    wanted = []
    for i, text in rows:
        n = len(library.encode(text or ""))
        wanted.append((i, len((text or "").encode()), n, n > 4096))
    assert sorted(map(str, wanted)) == sorted(str(tuple(r)) for r in got)
    assert token_counts.count_tokens(documents(spark, []), PIECES).collect() == []


def test_long_texts_are_split_at_runs_of_spaces(monkeypatch):
    monkeypatch.setattr(token_counts, "SLICE", 5)
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    for text in odd_texts(2, 500):
        found = sum(sum(token_counts.lengths(PIECES, w)) for w in token_counts.pre_tokens(text or ""))
        assert found == len(library.encode(text or ""))


def test_bpe_equals_the_library(spark):
    rows = [*enumerate(odd_texts(3, 300)), (None, "no id")]
    library = Tokenizer.from_file(WORDS)
    got = bpe.encoded(documents(spark, rows), WORDS, texts=True).collect()
    wanted = []
    for i, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
        wanted.append((i, len(ids), digest(" ".join(map(str, ids))), digest(decoded), ids, decoded))
    assert sorted(map(str, wanted)) == sorted(str(tuple(r)) for r in got)
    assert bpe.encoded(documents(spark, []), WORDS).collect() == []


def test_joins_of_chunks_are_repaired(monkeypatch):
    monkeypatch.setattr(bpe, "CUT_BITS", 2)
    monkeypatch.setattr(bpe, "LONGEST", 7)
    monkeypatch.setattr(bpe, "WORDS", 40)
    monkeypatch.setattr(bpe, "CHUNKS", 30)
    library, encoder = Tokenizer.from_file(WORDS), bpe.Encoder(WORDS)
    texts = [t for t in odd_texts(4, 1500) if t and len(t) < 20_000]
    for start in range(0, len(texts), 10):
        some = texts[start : start + 10]
        for text, ids in zip(some, encoder.encode(some)):
            assert ids.tolist() == library.encode(text, add_special_tokens=False).ids


def test_chunks_are_cut_alike_and_cover_the_text():
    chance = random.Random(9)
    shared = "".join(chance.choices("abcdeé ", k=20_000))
    one, two = bpe.chunks("front " + shared), bpe.chunks("another beginning " + shared + " tail")
    assert "".join(one) == "front " + shared
    assert len(set(one) & set(two)) > 0.9 * len(one)
    assert all(len(c.encode()) <= bpe.LONGEST + 3 for c in bpe.chunks("é" * 50_000))


def test_pipeline_keeps_clean_documents_once(spark, tmp_path):
    rows, marks = corpus(11, 400)
    copies = [(1000 + i, t) for i, t in rows[:40]]
    full = [(i, t, "en", f"s{(i or 0) % 3}", 0) for i, t in [*rows, *copies]]
    docs = spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels(spark, marks).drop("score").write.parquet(f"{tmp_path}/labels.parquet")
    truth = {i: (q, x) for i, q, x in marks if i is not None and q is not None}
    kept = {}
    extra = docs.selectExpr("*", "1 as score", "2 as class", "3 as hash", "4 as key")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs if kept else extra
        docs = corpus_pipeline.landed(stage(spark, before, str(tmp_path)))
        assert docs.columns == list(corpus_pipeline.COLUMNS)
        kept[name] = {r.doc_id for r in docs.select("doc_id").collect()}
    known = set(truth)
    assert len({i for i in known if truth[i][1]} & kept["toxicity"]) <= 0.05 * len(known)
    clean = {i for i in known if truth[i] == (1, 0)}
    assert len(clean - kept["quality"]) <= 0.03 * len(clean)
    assert not {i for i, _ in copies} & kept["near_dedup"]
    assert clean & kept["quality"] <= kept["near_dedup"]
    assert kept["mixing"] <= kept["near_dedup"]
    made = corpus_pipeline.run(spark, str(tmp_path))
    assert made.count() == docs.count()
    assert {r.doc_id for r in made.collect()} == kept["mixing"]
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, str(tmp_path)).collect() == []
