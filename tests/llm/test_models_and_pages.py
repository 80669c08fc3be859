"""Operators 2, 4, 6 and 9, and the pipeline."""

from __future__ import annotations

import hashlib
import html
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from hearth.llm import byte_bpe, main_text, neighbours, pii, toxicity
from hearth.llm.queries import tokenizer_path, tokenizer_pattern
from tests.llm.conftest import odd_rows, prose

SMALL = "/root/testdata/sf0.001"


# Operator 2 -------------------------------------------------------------------
def plain_spans(text):
    out = []
    for kind, pattern in (("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
                          ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), ("card", r"[0-9]([\x20-]?[0-9])+"),
                          ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            luhn = sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(digits))) % 10 == 0
            if (kind == "email" or kind == "ip" and all(int(p) <= 255 for p in m[0].split("."))
                    or kind == "card" and 13 <= len(digits) <= 19 and luhn or kind == "phone" and 9 <= len(digits) <= 15):
                out.append((kind, m.start(), m.end()))
    return out


def test_base_spans_match_plain_patterns():
    random.seed(5)
    for n in range(20_000):
        text = "".join(random.choice("a@.-+1234 5%_(é") for _ in range(random.randint(0, 30)))
        if n % 3 == 0:
            text = text.replace("a", "1").replace("@", ".")
        assert pii.base_spans(text) == plain_spans(text), text
    for text in ("a@b.c_d@e.f", "1.2.3.4.5.6.7.8", "4111 1111 1111 1111 22", "+1 (643) 555-5742.", "x@y@z.w", "0" * 5000 + ".1.2.3"):
        assert pii.base_spans(text) == plain_spans(text) if len(text) < 4000 else pii.base_spans(text) == [("ip", 0, 5006)]


def private_rows():
    near = [(i, f"lead{i} text{i} one{i} two{i} thing contact Zorblax Quendle at zq@corp.example now{i} or{i} later{i} x{i} y{i} z{i} the end")
            for i in range(6)]
    copies = [(50 + i, f"mail rare wordy copy of one text to only@one.example in every copy of it number {'s' * (i // 4)} the end") for i in range(8)]
    return near + copies + [(100 + i, f"common words the end {i} nothing here {i * 7} contact") for i in range(60)] + [
        (200, None), (201, "Zorblax alone"), (202, ""), (None, "zq@corp.example"), (203, "+1 (643) 555-5742 é 10.0.0.1, 4111111111111111")]


def test_revealing_terms_are_sanitised(spark):
    docs = spark.createDataFrame(private_rows(), "doc_id long, text string")
    got = {r.doc_id: r for r in pii.find_personal_data(docs).collect()}
    kinds = lambda r: [(s.kind, r_text[r.doc_id][s.start:s.end]) for s in r.spans]
    r_text = dict(private_rows())
    assert ("email", "zq@corp.example") == kinds(got[0])[0]
    assert {"Zorblax", "Quendle"} <= {t for k, t in kinds(got[0]) if k in pii.ADDED}
    assert not {"the", "end"} & {t for k, t in kinds(got[0])}
    assert [t for _, t in kinds(got[201])] == ["Zorblax"] and "Zorblax" not in got[201].text
    # copies of one text are no independent evidence; clean texts stay as they are
    assert kinds(got[50]) == [("email", "only@one.example")]
    assert got[100].spans == [] and got[100].text == r_text[100]
    assert got[200].text is None and got[202].text == "" and got[200].spans == []
    assert got[203].text == "[PHONE] é [IP], [CARD]"
    assert {r.doc_id: r.spans for r in pii.find_personal_data(docs, texts=False, block_rows=2).collect()}.keys() == got.keys()


def test_terms_of_a_fixed_line(spark):
    """Different texts that share a long contact line are evidence, near copies with other words
    at the reach's ends aren't; a customer number is a term."""
    words = lambda i, n, key: " ".join(f"{key}{i}q{j}" for j in range(n))
    line = "for any help with your order please write to Vornic 884213 at vk@shop.example or call us on every working day from nine until"
    rows = [(i, f"{words(i, 30, 'own')} {line} {words(i, 12, 'end')}") for i in range(5)]
    for i in range(6):
        copy = (words(0, 40, "same") + " Brindle lives by bl@home.example here " + words(1, 40, "same")).split()
        copy[35], copy[50] = f"left{i}", f"right{i}"
        rows.append((20 + i, " ".join(copy)))
    rows += [(40 + i, words(i, 9, "other") + " for any help with your order please write to us or call from nine until every working day") for i in range(60)]
    rows += [(200, "customer 884213 of Vornic")]
    got = {r.doc_id: (r.text, [s.kind for s in r.spans]) for r in pii.find_personal_data(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i in range(5):
        assert "removed" in got[i][1] and "Vornic" not in got[i][0] and "884213" not in got[i][0] and " your order please write to " in got[i][0]
    assert "884213" not in got[200][0] and "Vornic" not in got[200][0] and got[200][0].startswith("customer [")
    assert all(got[20 + i][1] == ["email"] for i in range(6)) and all(got[40 + i][1] == [] for i in range(60))


def test_marking_and_replacing_share_a_worker(spark):
    docs = spark.createDataFrame(private_rows(), "doc_id long, text string")
    for out in (pii.sanitise(docs), pii.find_personal_data(docs), pii.find_personal_data(docs, block_rows=2)):
        assert out._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1


def test_digests_and_sanitised_tables(spark, odd, empty):
    got = {(r.doc_id, r.n_email): r for r in pii.digests(spark.createDataFrame(private_rows(), "doc_id long, text string")).collect()}
    for key, text in private_rows():
        spans = plain_spans(text or "")
        r = got[key, sum(s[0] == "email" for s in spans)]
        assert r.base_sha256 == hashlib.sha256(",".join("%s:%d:%d" % s for s in spans).encode()).hexdigest()
        assert (r.n_ip, r.n_card, r.n_phone) == tuple(sum(s[0] == k for s in spans) for k in ("ip", "card", "phone"))
    assert pii.digests(empty).collect() == [] and pii.sanitise(empty).collect() == []
    same = pii.sanitise(odd)
    assert same.columns == odd.columns and sorted(map(str, (r.text for r in same.collect()))) == sorted(str(t) for _, t in odd_rows())


def test_blocks_of_terms_dont_change_texts(spark):
    """A term that is also a word of the marks, with terms in blocks of their own."""
    rows = [(i, " ".join(f"a{i}q{j}" for j in range(12)) + " Zorblax removed name zq@corp.example " + " ".join(f"b{i}q{j}" for j in range(12)))
            for i in range(5)] + [(9, "removed Zorblax name")] + [(10 + i, f"common text {i}") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = {r.doc_id: r.text for r in pii.find_personal_data(docs).collect()}
    assert "[REMOVED]" in want[0] + want[9] or "[NAME]" in want[9]
    for size in (1, 2, 1000):
        assert {r.doc_id: r.text for r in pii.sanitise(docs, size).collect()} == want


# Operator 4 -------------------------------------------------------------------
def test_neighbours_of_odd_vectors(spark):
    rows = [(0, [1.0, 0.0]), (50, [1.0, 0.0]), (2, [2.0, 0.0]), (3, None), (4, [0.0, 0.0]), (5, [math.nan, 1.0]), (6, [1.0, None]), (7, [1.0]),
            (8, [0.0, 1.0]), (2, [2.0, 0.0]), (None, [1.0, 1.0]), (9, [math.inf, 1.0]), (100, [])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 as score", "2 as rank")
    got = [tuple(r) for r in neighbours.nearest_neighbours(vectors, vectors.where("vec_id % 50 = 0"), 5).collect()]
    assert sorted(got) == [(0, 1, 2, 1.0), (0, 2, 2, 1.0), (0, 3, 50, 1.0), (0, 4, 8, 0.0),
                           (50, 1, 0, 1.0), (50, 2, 2, 1.0), (50, 3, 2, 1.0), (50, 4, 8, 0.0)]
    assert neighbours.nearest_neighbours(vectors.limit(0), vectors, 5).collect() == []
    assert neighbours.nearest_neighbours(vectors, vectors.limit(0), 5).collect() == []


@pytest.mark.parametrize("bits", [64, 96])
def test_recall_against_brute_force(spark, bits):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(40, 48))
    x = np.concatenate([centres[rng.integers(0, 40, 1500)] + 0.4 * rng.normal(size=(1500, 48)), rng.normal(size=(300, 48)),
                        np.repeat(rng.normal(size=(1, 48)), 400, axis=0)]).astype(np.float32)
    vectors = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>").repartition(5)
    got = neighbours.nearest_neighbours(vectors, vectors.where("vec_id % 20 = 0"), 5, bits=bits, block_rows=300, query_bytes=8_000).collect()
    unit = x.astype(np.float64) / np.linalg.norm(x.astype(np.float64), axis=1, keepdims=True)
    hit, asked = 0, range(0, len(x), 20)
    for q in asked:
        score = unit @ unit[q]
        score[q] = -2
        want = np.lexsort((np.arange(len(x)), -np.round(score, 12)))[:5]
        own = {r.vec_id: r.score for r in got if r.query_id == q}
        assert len(own) == 5 and all(abs(score[i] - s) < 1e-9 for i, s in own.items())
        hit += sum(abs(a - b) < 1e-9 for a, b in zip(sorted(own.values()), sorted(score[want])))
    assert hit >= 0.9 * 5 * len(asked)


# Operator 6 -------------------------------------------------------------------
def test_risk_is_learnt_without_negatives():
    """Toxic texts share a few cells; the unlabelled ones are toxic with the prior's share."""
    rng = np.random.default_rng(1)

    def text(toxic):
        cells = set(rng.integers(1000, 200_000, 40).tolist()) | set(rng.integers(0, 30, 5).tolist())
        return np.array(sorted(cells | (set(rng.choice([500, 501, 502, 503], 3, replace=False).tolist()) if toxic else set())))

    model = toxicity.fit_pu([text(True) for _ in range(150)], [text(rng.random() < 0.2) for _ in range(800)], 0.2)
    score = lambda t: model.bias + model.weight[t].sum()
    assert np.mean([score(text(True)) > 0 for _ in range(200)]) > 0.95
    assert np.mean([score(text(False)) < 0 for _ in range(200)]) > 0.95


def test_toxicity_of_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    known = labels.where("toxic is not null").select("doc_id", "toxic")
    some = docs.join(known, "doc_id").select(docs.columns)
    rows = toxicity.toxicity(some, labels).join(known, "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    held = [r for r in rows if r.held_out]
    assert np.mean([r.predicted == r.toxic for r in held]) > 0.97
    assert sum(r.predicted and not r.toxic for r in held) <= 0.05 * sum(r.predicted for r in held)


def test_toxicity_without_labels_and_odd_rows(spark, odd, empty):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    rows = toxicity.toxicity(odd, none).collect()
    assert len(rows) == len(odd_rows()) and {r.predicted for r in rows} == {0}
    labels = spark.createDataFrame([(1, 1), (1, 0), (4, 0), (None, 1), (8, None), (77, 1)], "doc_id long, toxic int")
    assert len(toxicity.toxicity(odd, labels).collect()) == len(odd_rows())
    assert toxicity.toxicity(empty, labels).collect() == []
    assert toxicity.drop_toxic(odd, none).columns == odd.columns and toxicity.drop_toxic(odd, none).count() == len(odd_rows())


# Operator 9 -------------------------------------------------------------------
PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{x}</style></head><body class="with-sidebar">
<header class="site-header"><h1>Site name</h1></header><div class="cookie-notice">We use cookies here</div>
<nav><ul><li><a href="/a">Home</a></li><li>News</li></ul></nav>%s<aside>Related things</aside>
<div id="comments"><p>first reader comment</p></div><form><label>Mail</label><input><button>Send</button></form>
<footer>&copy; 2020 all rights</footer><script>var t="</p>";</script></body></html>"""
BODY = """<h1>The &amp; title</h1><p>One <b>two</b>\n three&nbsp;four.<br>Five<p>Six.</p><div class="ad">buy it now</div>
<ul><li>first</li><li>second</li></ul><blockquote>Said &lt;so&gt;</blockquote><aside>boxed</aside><section class="comments">bad words</section><p>End.</p>"""
WANTED = "The & title\n\nOne two three four. Five\n\nSix.\n\nfirst\n\nsecond\n\nSaid <so>\n\nEnd."


@pytest.mark.parametrize("wrap", ["<article>%s</article>", "<main>%s</main>", '<div class="content post"><div>%s</div></div>'])
def test_main_text_of_a_page(spark, wrap):
    pages = spark.createDataFrame([(1, "u", PAGE % (wrap % BODY))], "page_id long, url string, html string")
    assert main_text.main_text(pages).first().text == WANTED


@pytest.mark.parametrize("wrap", [
    '<div class="content-sidebar-wrap"><main>%s</main><div class="related"><article>other</article></div></div>',
    '<div class="layout-sidebar-right"><article>%s</article></div>', '<div class="post comments-open"><div>%s</div></div>',
    '<div id="search"><main>%s</main></div>',
    '<div class="content">%s</div><div id="comments" class="comments-area">' + "<p>words of readers</p>" * 60 + "</div>"])
def test_names_of_wrappers_drop_no_text(spark, wrap):
    pages = spark.createDataFrame([(1, "u", PAGE % (wrap % BODY))], "page_id long, url string, html string")
    assert main_text.main_text(pages).first().text == WANTED


@pytest.mark.parametrize("wrap", [
    '<div class="layout-sidebar-right">%s</div>', '<div id="search-results">%s</div>',
    '<article>%s</article><div class="related"><article>another card</article></div>'])
def test_names_of_wrappers_without_marks(spark, wrap):
    blocks = [f"block {i} " + "of many words " * 20 for i in range(4)]
    body = "".join(f"<p>{b}</p>" for b in blocks) + '<div class="ad">buy it now</div>'
    pages = spark.createDataFrame([(1, "u", PAGE % (wrap % body))], "page_id long, url string, html string")
    assert main_text.main_text(pages).first().text == "\n\n".join(b.strip() for b in blocks)


INSIDE = [
    ('<section id="social"><h2>Social policy</h2><p>It has a history.</p></section>', "Social policy\n\nIt has a history."),
    ('<div id="search-engines"><p>How engines search.</p></div>', "How engines search."),
    ('<div class="share-price-table"><table><tr><td>12</td><td>13</td></tr></table></div>', "12\n\n13"),
    ('<p>Press the <button>Start</button> button.</p>', "Press the Start button."),
    ('<div class="ad-slot"><p>buy it now</p></div><div class="comment-list"><p>so bad</p></div><div class="sponsored">by us</div>', ""),
    ('<section class="comments">' + "<p>many words of readers</p>" * 200 + "</section>", "")]


@pytest.mark.parametrize("part, text", INSIDE)
def test_names_inside_marked_text_weigh(spark, part, text):
    """Subjects stay, adverts and comments go, and what goes doesn't part the text around it."""
    rows = [(1, "u", f"<body><nav>menu</nav><article><h1>Top</h1><p>First words.</p>{part}<p>Last words.</p></article><footer>end</footer></body>")]
    got = main_text.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).first().text
    assert got == "\n\n".join(x for x in ("Top", "First words.", text, "Last words.") if x)


def test_deep_pages_take_linear_time():
    import time
    weight = main_text.weights({})
    for opening in ("<div>", '<div class="related menu-x">', "<article>", "<ul><li>"):
        page = opening * 50_000 + "some words" + "</p></div>" * 60_000
        began = time.process_time()
        assert main_text.extract(page, weight) in ("some words", "")
        main_text.wrappers(page)
        list(main_text._counts(iter([pa.record_batch({"html": [page]})])))
        assert time.process_time() - began < 15            # a walk over all open containers at each event takes minutes


def against(names):
    return any(n[0] in ".-" and (n[1:] in main_text.STRONG_NAMES | main_text.WEAK_NAMES or n[1:].startswith("comment")) for n in names)


def state(stack, page_marks=True):
    """Whether the innermost of (tag, names) lies in marked text, and in a dropped element."""
    marked = [page_marks and any(t in main_text.TEXT_MARKS and not any(against(x) for _, x in stack[:j + 1]) for j, (t, _) in enumerate(stack[:i]))
              for i in range(len(stack) + 1)]
    return marked[-1], any(t in main_text.DROPPED or (t == "header" and not marked[i]) for i, (t, _) in enumerate(stack))


def has_marks(page):
    """Whether words stand in a mark that isn't dropped."""
    stack = []
    for m in re.finditer(r"<(/?)(\w+)([^>]*)>|([^<]+)", page):
        if m[4]:
            if m[4].split() and any(t in main_text.TEXT_MARKS and not state(stack[:i + 1])[1] for i, (t, _) in enumerate(stack)) and not state(stack)[1]:
                return True
        elif m[1]:
            stack.pop()
        else:
            stack.append((m[2], main_text.names_of(m[2], m[3])))
    return False


class Plain:
    """Scores of a page's words and tags, each from a walk over all open containers, on well-formed pages."""

    def __init__(self, page, weight):
        self.scores, self.kept, stack, self.page_marks = [], [], [], has_marks(page)
        for m in re.finditer(r"<(/?)(\w+)([^>]*)>|([^<]+)", page):
            if m[4]:
                inside, dropped = state([x[:2] for x in stack], self.page_marks)
                w, within = self.around(stack, weight, inside)
                w += main_text.WORD
                if m[4].split():
                    keep = w > 0 and not dropped
                    self.scores.append(0.0 if within and not keep else w * len(m[4].split()))
                    self.kept.append(m[4].split() if keep else [])
                continue
            if m[1]:
                stack.pop()
            else:
                stack.append((m[2], main_text.names_of(m[2], m[3])))
            inside, dropped = state(stack, self.page_marks)
            w, within = self.around(stack, weight, inside)
            self.scores.append(0.0 if within and (w + main_text.WORD <= 0 or dropped) else w + main_text.TAG)
            self.kept.append([])

    def around(self, stack, weight, inside):
        total, seen, within = 0.0, set(), False
        for i, (_, names) in enumerate(stack):
            own = [n for n in names if n not in main_text.TEXT_MARKS or state(stack[:i + 1], self.page_marks)[0]]
            total = min(total + sum(float(weight[main_text.cell(n)]) for n in own if n not in seen), main_text.CLIP)
            seen |= set(own)
            within |= total >= main_text.WITHIN
        return total if inside or not self.page_marks else min(total, 0.0) - 2 * main_text.WORD, within

    def words(self):
        """Words of the best region, over all regions; the first and shortest of equal ones."""
        sums = np.concatenate([[0.0], np.cumsum(self.scores)])
        best = max(((sums[j] - sums[i], -i, -j) for i in range(len(self.scores)) for j in range(i + 1, len(sums))), default=(0, 0, 0))
        return [w for part in self.kept[-best[1]:-best[2]] for w in part] if best[0] > 1e-9 else []


def test_scan_and_weights_equal_a_plain_version():
    rng = np.random.default_rng(4)
    kinds = ["div", "section", "nav", "article", "aside", "header", "footer"]
    names = ["", ' class="ad"', ' class="search"', ' id="comment-list"', ' class="content"', ' class="x y-menu"', ' class="post"']

    def part(depth):
        inner = "".join(part(depth - 1) if depth and rng.random() < 0.6 else " ".join(["w%d" % rng.integers(99)] * rng.integers(1, 9)) + " "
                        for _ in range(rng.integers(1, 4)))
        tag = rng.choice(kinds, p=[0.35, 0.2, 0.1, 0.1, 0.1, 0.05, 0.1])
        return f"<{tag}{rng.choice(names)}>{inner}</{tag}>"

    pages = ["".join(part(3) for _ in range(rng.integers(1, 5))) for _ in range(150)]
    # weights: words under each name, by a stack of names for each word
    counts = {}
    for page in pages:
        if main_text.wrappers(page)[0]:
            continue
        own, stack, page_marks = Counter(), [], has_marks(page)
        assert main_text.wrappers(page)[1] == page_marks
        for m in re.finditer(r"<(/?)(\w+)([^>]*)>|([^<]+)", page):
            if m[4]:
                marked, dropped = state(stack, page_marks)
                inside = marked and not dropped
                if marked and any(against(x) for _, x in stack):
                    continue
                own_names = lambda i: [n for n in stack[i][1] if n not in main_text.TEXT_MARKS or state(stack[:i + 1], page_marks)[0]]
                for n in {n for i in range(len(stack)) for n in own_names(i)} | {""}:
                    own[n, int(inside)] += len(m[4].split())
            elif m[1]:
                stack.pop()
            else:
                stack.append((m[2], main_text.names_of(m[2], m[3])))
        if own["", 1]:
            for (n, inside), k in own.items():
                if n:
                    counts.setdefault(main_text.cell(n), [0, 0])[inside] += k
    plain = [p for p in pages if not main_text.wrappers(p)[0]]
    (batch,) = main_text._counts(iter([pa.record_batch({"html": plain})]))
    got = {r["cell"]: [r["outside"], r["inside"]] for r in batch.to_pylist()}
    assert got == {c: n for c, n in counts.items() if any(n)} and len(plain) > 50
    weight = main_text.weights({c: tuple(n) for c, n in counts.items()})
    for page in plain:
        scan = main_text._Scan(weight, frozenset(), has_marks(page))
        scan.walk(page)
        want = Plain(page, weight)
        assert np.allclose(scan.scores, want.scores)
        region = main_text.best_region(scan.scores)
        assert (region is None) == (want.words() == []) or not main_text.extract(page, weight)
        if region:
            sums = np.concatenate([[0.0], np.cumsum(want.scores)])
            most = max(sums[j] - sums[:j].min() for j in range(1, len(sums)))
            assert np.isclose(sum(scan.scores[region[0]:region[1] + 1]), most)


def test_odd_pages(spark):
    rows = [(1, "a", None), (2, "b", ""), (3, None, "<p>no closing"), (None, "d", "<script>x"), (5, "e", "plain words alone &amp more"),
            (5, "e", "plain words alone &amp more"), (6, "f", "<" * 5000), (7, "g", "<div" + ' a="' * 3000), (8, "h", "<p>" * 20_000 + "x"),
            (9, "i", "<article>" + "<p>long text </p>" * 5000 + "</article>"), (10, "j", "<!-- open <p>text")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "7 as text", "8 as n_chars")
    got = [(r.page_id, r.url, r.text, r.n_chars) for r in main_text.main_text(pages).collect()]
    assert len(got) == len(rows) and all(n == len(t) for *_, t, n in got)
    text = {k: t for k, _, t, _ in got}
    assert text[1] == text[2] == text[10] == "" and text[3] == "no closing" and text[5] == "plain words alone & more"
    assert text[9] == "\n\n".join(["long text"] * 5000)
    assert main_text.main_text(pages.limit(0)).collect() == []


def test_pages_with_marked_articles(spark):
    pages = spark.read.parquet(f"{SMALL}/pages.parquet")
    got = {r.page_id: r.text for r in main_text.main_text(pages).collect()}
    for r in pages.collect():
        article = re.search("<article>(.*?)</article>", r.html, re.S)[1]
        blocks = [" ".join(html.unescape(re.sub("<[^>]*>", " ", re.sub("</?b>", "", b))).split()) for b in re.split("</?(?:p|h1)>", article)]
        assert got[r.page_id] == "\n\n".join(b for b in blocks if b)


# Pipeline ---------------------------------------------------------------------
def test_pipeline_stages(spark):
    """Each stage on its own input, against plain versions of what it has to do."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    before = {r.doc_id: r.text for r in docs.collect()}
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "ngram_jaccard", "decontamination", "personal_data", "byte_bpe"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SMALL).columns == docs.columns

    def sets(text):
        w = re.findall("[^\x20\x09-\x0d]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text))
        return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()

    grams, root = {k: sets(t) for k, t in before.items()}, {k: k for k in before}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sorted(before):
        for b in sorted(before):
            common = len(grams[a] & grams[b]) if a < b else 0
            if common and 100 * common >= 75 * len(grams[a] | grams[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    assert sorted(r.doc_id for r in stages["ngram_jaccard"](spark, docs, SMALL).collect()) == sorted(k for k in before if find(k) == k)
    masked = {r.doc_id: r for r in stages["personal_data"](spark, docs, SMALL).collect()}
    for k, r in masked.items():
        assert r.n_chars == len(r.text) and (plain_spans(before[k]) or r.text == before[k])
        assert not any(before[k][a:b] in r.text for kind, a, b in plain_spans(before[k]) if kind == "email")
    ids = {r.doc_id: r for r in stages["byte_bpe"](spark, docs, SMALL).collect()}
    assert all(r.decoded_sha256 == hashlib.sha256(before[k].encode()).hexdigest() for k, r in ids.items())
    tok = byte_bpe.build(tokenizer_path("byte_bpe_multi_50k.tiktoken"), tokenizer_pattern())
    assert all(np.frombuffer(r.ids, "<u4").tolist() == tok.encode(before[k], add_special_tokens=False).ids for k, r in list(ids.items())[:20])


def test_whole_pipeline(spark):
    rows = corpus_pipeline.run(spark, SMALL).collect()
    keys = [r.doc_id for r in rows]
    assert 0 < len(keys) == len(set(keys)) < spark.read.parquet(f"{SMALL}/documents.parquet").count()
    assert all(r.n_tokens * 4 == len(r.ids) and r.ids_sha256 == hashlib.sha256(r.ids).hexdigest() for r in rows)
