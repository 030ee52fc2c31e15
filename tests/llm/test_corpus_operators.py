"""Operators that look across documents, pages or vectors, and the pipeline, against brute force."""

import random
from collections import Counter
from itertools import product

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import corpus_pipeline
from fieldglass.llm import cap_filters, components, count_tree, crf_lines, html_wrapper, ngram_join, queries, site_quality, words
from fieldglass.llm.html_tree import measure, parse
from fieldglass.llm.text_features import LINE_FEATURES, line_features, lines_of

SF = "/root/testdata/sf0.001"
SPACES = "\x20\x09\x0a\x0b\x0c\x0d"


def split(text):
    """Words by the contract's definition."""
    return [w.decode() for w in (text or "").encode().split()]


def small_roots(pairs, items):
    root = {i: i for i in items}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in pairs:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {i: find(i) for i in items}


# Words and lines


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("aab é\x85\xa0\x1c" + SPACES), max_size=60))
def test_words_of_odd_texts(text):
    data = words.byte_array(text)
    starts, ends = words.word_spans(data)
    assert [bytes(data[a:b]).decode() for a, b in zip(starts, ends)] == split(text)
    hashes = words.word_hashes(data, starts, ends)
    assert len(set(hashes.tolist())) == len(set(split(text)))


def repeated_by_definition(own):
    windows = Counter(tuple(own[i : i + 5]) for i in range(len(own) - 4))
    covered = {i + k for i in range(len(own) - 4) if windows[tuple(own[i : i + 5])] > 1 for k in range(5)}
    return len(covered)


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("ab#| \n\t\x0bé"), max_size=80))
def test_base_measures(text):
    lines, own = lines_of(text), split(text)
    with_word = [x for x in text.split("\n") if split(x)]
    assert lines.n_words == len(own)
    assert lines.word_chars == sum(map(len, own))
    assert lines.n_symbols == sum(text.count(c) for c in "#*$%&|<>")
    assert lines.n_dup_lines == len(with_word) - len(set(with_word))
    assert lines.n_repeat_words == repeated_by_definition(own)
    assert len(line_features(lines)) == len(with_word)


# Line labels


def test_viterbi_is_the_best_of_all_labellings():
    pick = random.Random(3)
    for _ in range(60):
        scores = [pick.uniform(-3, 3) for _ in range(pick.randint(1, 7))]
        field = crf_lines.Field(np.zeros(1), np.array([[pick.uniform(-2, 2) for _ in range(2)] for _ in range(2)]), pick.uniform(-1, 1))

        def value(labels):
            total = field.start * labels[0] + sum(s for s, y in zip(scores, labels) if y)
            return total + sum(field.between[a, b] for a, b in zip(labels, labels[1:]))

        best = max(product((0, 1), repeat=len(scores)), key=value)
        assert value(crf_lines.viterbi(scores, field)) == pytest.approx(value(best))


def test_field_learns_lines():
    good = [lines_of("some plain words here\nand more words follow them\n" * 3) for _ in range(20)]
    junk = [lines_of("BUY!! NOW!! $$$ ###\nx | y | z | %% ||\n" * 3) for _ in range(20)]
    field = crf_lines.fit([line_features(x) for x in good + junk], [1] * 20 + [0] * 20)
    labels = crf_lines.line_labels("plain words are here\n\nand there are more\nBUY!! $$$ ### |||\nx | y | %% | z\n", field)
    assert [y for _, y in labels][:2] == [1, 1] and [y for _, y in labels][-1] == 0
    assert crf_lines.fit([line_features(x) for x in good], [1] * 20) is crf_lines.ALL_CONTENT


def test_line_rules_query(spark):
    larger = SF.replace("0.001", "0.01")
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{larger}/documents.parquet").collect()}
    quality = {r.doc_id: r.quality for r in spark.read.parquet(f"{larger}/labels.parquet").collect()}
    rows = {r.doc_id: r for r in queries.op2_line_rules(spark, larger).collect()}
    assert rows.keys() == texts.keys()
    for key, r in rows.items():
        own = split(texts[key])
        assert r.n_words == len(own) and r.word_chars == sum(map(len, own)) and r.n_repeat_words == repeated_by_definition(own)
        assert r.base_failed == (len(own) < 10 or 100 * r.n_repeat_words > 20 * len(own))
        assert not (r.base_failed and r.kept)
    judged = [(rows[k].kept, q) for k, q in quality.items() if not rows[k].base_failed]
    assert sum(kept for kept, q in judged if q) >= 0.98 * sum(q for _, q in judged)
    assert sum(kept for kept, q in judged if not q) <= 0.2 * sum(not q for _, q in judged)


def test_field_learns_from_whole_documents_of_mixed_lines(spark):
    pick = random.Random(5)
    words, signs = "some plain words of a text that goes on with others".split(), ["BUY!!", "$$$", "###", "NOW!!", "|", "%%"]

    def lines(n, of):
        return "\n".join(" ".join(pick.choice(of) for _ in range(pick.randint(5, 9))) + f" {pick.random()}" for _ in range(n))

    good = [lines(40, words) + "\n" + lines(12, signs) for _ in range(60)]
    junk = [lines(8, words) + "\n" + lines(44, signs) for _ in range(60)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(good + junk)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 60)) for i in range(120)], "doc_id long, quality int")
    field = crf_lines.fit_on(docs, labels)
    found = [[y for _, y in crf_lines.line_labels(t, field)] for t in good + junk]
    want = [[1] * 40 + [0] * 12] * 60 + [[1] * 8 + [0] * 44] * 60
    assert np.mean(np.concatenate(found) == np.concatenate(want)) > 0.97
    assert [list(r) for r in crf_lines.stretches(30, 7)] == [list(range(30))]
    for at in range(100):
        first, middle, last = crf_lines.stretches(31 + at, 17 * at)
        assert first.start == 0 and first.stop <= middle.start and middle.stop <= last.start and last.stop == 31 + at


def test_sample_has_one_row_per_repeated_id(spark):
    rows = [(0, f"copy {n} of the same id") for n in range(9000)] + [(n, f"BUY $$ {n}") for n in range(1, 9)] + [(9, None), (None, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(n, int(n == 0)) for n in range(10)], "doc_id long, quality int")
    sampled = crf_lines.sampled_features(docs, labels, "quality", 50, lambda text: np.array([len(text or "")]))
    assert [(r.id, r.label) for r in sampled] == [(n, int(n == 0)) for n in range(10)]
    assert crf_lines.fit_on(docs, labels) is not crf_lines.ALL_CONTENT
    assert len(set(site_quality.fit_on(docs, labels).scale.tolist())) > 1


# Joins of word windows


def brute_components(texts, window, share):
    sets = {}
    for key, text in texts.items():
        own = split("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
        sets[key] = {tuple(own[i : i + window]) for i in range(len(own) - window + 1)} or ({tuple(own)} if own else set())
    keys = sorted(sets)
    pairs = [(a, b) for i, a in enumerate(keys) for b in keys[i + 1 :] if sets[a] and share[1] * len(sets[a] & sets[b]) >= share[0] * len(sets[a] | sets[b])]
    return {k: len(s) for k, s in sets.items()}, small_roots(pairs, keys)


def compare_groups(spark, texts, window=4, share=(85, 100)):
    frame = spark.createDataFrame([(k, t, "x") for k, t in texts.items()], "doc_id long, text string, set_id string")
    rows = ngram_join.duplicate_groups(frame, window=window, share=share).collect()
    sizes, roots = brute_components(texts, window, share)
    assert {r.doc_id: r.n_shingles for r in rows} == sizes
    assert {r.doc_id: r.component_id for r in rows} == roots
    return roots


def test_ngram_query_equals_brute_force(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    sizes, roots = brute_components(texts, 4, (85, 100))
    rows = queries.op4_ngram_join(spark, SF).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == {k: (sizes[k], roots[k]) for k in texts}
    assert len(set(roots.values())) < len(texts)


def varied(pick, base, edits):
    own = list(base)
    for _ in range(edits):
        at = pick.randrange(len(own))
        own[at : at + 1] = pick.choice([[], [f"n{pick.randrange(10**6)}"], [own[at], f"n{pick.randrange(10**6)}"]])
    return " ".join(own)


@pytest.mark.parametrize("page", [512, 5])
def test_ngram_families_near_the_threshold(spark, monkeypatch, page):
    monkeypatch.setattr(ngram_join, "PAGE_POINTS", page)
    pick = random.Random(page)
    texts = {}
    for size, copies, most in ((300, 40, 14), (60, 40, 4), (14, 30, 2), (6, 30, 1), (900, 12, 30)):
        base = [f"w{pick.randrange(10**6)}" for _ in range(size)]
        for _ in range(copies):
            texts[len(texts)] = varied(pick, base, pick.randint(0, most))
    passage = " ".join(f"p{i}" for i in range(60))
    for _ in range(30):
        texts[len(texts)] = passage + " " + " ".join(f"w{pick.randrange(10**6)}" for _ in range(pick.randint(1, 20)))
    roots = compare_groups(spark, texts)
    assert max(Counter(roots.values()).values()) >= 20


def test_ngram_edges(spark):
    texts = {1: None, 2: "", 3: " \n ", 4: "one", 5: "ONE", 6: "one two three", 7: "One\ttwo\x0bthree", 8: "a b c d", 9: "A B C D", 10: "é b c d", 11: "É b c d"}
    roots = compare_groups(spark, texts)
    assert [roots[k] for k in (2, 5, 7, 9, 11)] == [2, 4, 6, 8, 11]
    frame = spark.createDataFrame([(None, "same text of five words"), (7, "same text of five words"), (7, "same text of five words"), (None, "x y z w v"), (3, None)], "doc_id long, text string")
    rows = Counter((r.doc_id, r.component_id) for r in ngram_join.duplicate_groups(frame).collect())
    assert rows == Counter({(None, 7): 1, (7, 7): 2, (None, None): 1, (3, 3): 1})
    assert ngram_join.duplicate_groups(frame.limit(0)).count() == 0
    kept = Counter((r.doc_id, r.text) for r in ngram_join.keep_one(frame).collect())
    assert kept == Counter({(7, "same text of five words"): 1, (None, "x y z w v"): 1, (3, None): 1})
    assert ngram_join.keep_one(frame.limit(0)).count() == 0


def test_one_of_many_rows_without_a_telling_id_stays(spark):
    rows = [(7, "same text of five words", i, "x") for i in range(50)] + [(None, "SAME text of five words", i, "y") for i in range(50)] + [(None, "other text of some six words", 1, "z")] * 9
    frame = spark.createDataFrame(rows, "doc_id long, text string, _ROW int, _gone string")
    kept = ngram_join.keep_one(frame)
    assert kept.columns == frame.columns
    assert sorted((r.doc_id or 0, r._gone) for r in kept.collect()) == [(0, "z"), (7, "x")]


@settings(max_examples=200, deadline=None)
@given(st.sets(st.integers(0, 90), min_size=1, max_size=60), st.sets(st.integers(0, 90), max_size=4), st.sets(st.integers(0, 90), max_size=4))
def test_linked_sets_share_a_key(base, added, removed):
    to_hash = lambda s: np.unique(words.mixed(np.array(sorted(s), np.uint64)))
    for share in ((85, 100), (80, 100)):
        a, b = to_hash(base), to_hash((base | added) - removed)
        if len(b) and ngram_join.set_id(a) != ngram_join.set_id(b) and ngram_join.linked(a, b, share):
            assert set(ngram_join.group_keys(a, share).tolist()) & set(ngram_join.group_keys(b, share).tolist())


def test_count_tree_finds_all_within_the_bound():
    random_counts = np.random.default_rng(5).poisson(4, (400, 16))
    sizes = random_counts.sum(axis=1)
    tree = count_tree.CountTree(random_counts, sizes, (60, 100))
    for i in range(0, 400, 7):
        found = sorted(int(j) for others, _ in tree.leaves(random_counts[i], int(sizes[i])) for j in others)
        want = [j for j in range(400) if np.minimum(random_counts[i], random_counts[j]).sum() * 160 >= 60 * (sizes[i] + sizes[j])]
        assert found == want


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 25), st.integers(0, 25)), max_size=40))
def test_components(spark, edges):
    frame = spark.createDataFrame(edges, "a long, b long")
    roots = small_roots(edges, range(26))
    got = {r.vertex: r.root for r in components.components(frame).collect()}
    assert {i: got.get(i, i) for i in range(26)} == roots


def test_components_of_a_long_path(spark):
    frame = spark.range(300).selectExpr("id AS a", "id + 1 AS b")
    assert {r.root for r in components.components(frame).collect()} == {0}


# Pages


def truth(html):
    """The article of the test pages by plain means."""
    import re
    from html import unescape

    inside = html[html.index("<article>") + 9 : html.index("</article>")]
    parts = [" ".join(unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in re.split(r"</?(?:h1|p)>", inside)]
    return "\n".join(p for p in parts if p)


def test_html_query(spark):
    pages = {r.page_id: r for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    rows = {r.page_id: r for r in queries.op5_html_text(spark, SF).collect()}
    assert rows.keys() == pages.keys()
    for key, page in pages.items():
        assert rows[key].text == truth(page.html) and rows[key].n_chars == len(rows[key].text) and rows[key].url == page.url


LAYOUT = (
    "<html><body><div id='top-menu'><a href=x>Home</a></div><div class=wrap><div class='story s{n}'><h1>Title {n} &amp; more</h1>{body}"
    "<div class='ad-box'>Buy</div><form>x</form></div><div class=sidebar>side</div></div><section class=comments><article><p>I disagree</p></article></section>"
    "<div class=x9><p>{foot}</p></div><footer>foot"
)


def test_wrapper_of_a_host_without_article_tags(spark):
    rows = []
    for n in range(12):
        body = "".join(f"<p>Paragraph {i} of page {n} goes on for quite a while, with   <b>some</b> words.<br>" for i in range(n % 4 + 1))
        rows.append((n, "http://h.example.com/a", LAYOUT.format(n=n, body=body, foot="Same words on every page." if n % 2 else "Others.")))
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    texts = {r.page_id: r.text for r in html_wrapper.extract(pages).collect()}
    for n in range(12):
        lines = [f"Title {n} & more", *(f"Paragraph {i} of page {n} goes on for quite a while, with some words." for i in range(n % 4 + 1))]
        assert texts[n] == "\n".join(lines)
    hosted = pages.selectExpr("'h' AS host", "page_id AS hash", "html")
    wrapper = html_wrapper.wrappers(hosted).first()
    assert "(<p>#TEXT" in wrapper.wrapper and ")+" in wrapper.wrapper and '"div.s.story"' in wrapper.region


def test_wrapper_leaves_out_what_a_host_repeats(spark):
    legal = "".join(f"<p>Clause {i} is the same on all pages of this host, and it is long. {'word ' * 60}</p>" for i in range(6))
    page = "<body><div class=box><div class=legal>{}</div><div class=story><h1>The paper</h1><p>Story {} is short.</p><p>Again</p></div></div></body>"
    rows = [(n, "http://h/x", page.format(legal, n)) for n in range(6)] + [(9, "http://other/x", page.format(legal, 9))]
    got = {r.page_id: r.text for r in html_wrapper.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(got[n].startswith(f"The paper\nStory {n} is short.") and "Clause" not in got[n] for n in range(6))
    flat = "<body><p>{} of the pages of the host, which has many of them.</p><p>Same words on every page.</p><p>{} is at the end of it</p></body>"
    rows = [(n, "http://h/x", flat.format(n, n)) for n in range(5)] + [(n, "http://copies/x", flat.format(0, 0)) for n in range(5, 9)]
    got = {r.page_id: r.text.split("\n") for r in html_wrapper.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert [len(got[n]) for n in range(9)] == [2] * 5 + [3] * 4


def test_wrapper_reads_other_templates_and_all_parts(spark):
    long = "Words of the text of page {n}, which go on and on for a while. " * 8
    usual = "<body><article><h1>T{n}</h1><p>" + long + "</p></article></body>"
    teaser = "<body><article><p>Teaser {n}</p></article><div class=post><p>" + long + "</p></div></body>"
    parts = "<body><article><p>First {n}</p></article><article><p>" + long + "</p></article></body>"
    links = "<body><div class=story><h2><a href=x>Linked heading {n}</a></h2><p>" + long + "</p><ul><li><a href=y>Source {n}</a></li></ul></div></body>"
    split = "<body><div class=wrap><div class=part1><p>One {n}</p></div><figure>x</figure><div class=part2><p>" + long + "</p></div></div></body>"
    rows = [(n, "http://many/x", (teaser if n % 20 == 7 else usual).format(n=n)) for n in range(60)]
    rows += [(100 + n, "http://parts/x", parts.format(n=n)) for n in range(4)]
    rows += [(200 + n, "http://links/x", links.format(n=n)) for n in range(4)]
    rows += [(300 + n, "http://split/x", split.format(n=n)) for n in range(4)]
    got = {r.page_id: r.text for r in html_wrapper.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for n in range(60):
        assert long.format(n=n).strip() in got[n]
    for n in range(4):
        assert got[100 + n] == f"First {n}\n" + long.format(n=n).strip()
        assert got[200 + n] == f"Linked heading {n}\n" + long.format(n=n).strip() + f"\nSource {n}"
        assert got[300 + n].startswith(f"One {n}\n") and long.format(n=n).strip() in got[300 + n]


def test_alignment_resolves_mismatches():
    def page(html):
        root = parse(html)
        measure(root)
        return html_wrapper.outline(root)

    wrapper = html_wrapper.infer([page(h) for h in ("<div><h1>a</h1><p>x<p>y</div>", "<div><h1>a</h1><p>z</div>", "<div><h1>a</h1><h2>b</h2><p>z</div>")])
    assert str(wrapper) == "<div><h1>text</h1>(<h2>text</h2>)?(<p>#TEXT</p>)+</div>"


def test_html_edges(spark):
    rows = [(1, None, None), (2, "u", ""), (None, "http://h/x", "<p>a<p>b"), (3, "http://h/x", "plain &lt;text&gt; &amp &nbsp; x"), (3, "http://h/x", "<article><p>" + "word " * 50_000), (4, "http://h/y", "<div>" * 3000 + "deep"), (5, "http://h/z", "<script>x</SCRIPT ><!-- c --><p title='a>b'>ok</p><style>")]
    pages = spark.createDataFrame([(*r, "c") for r in rows], "page_id long, url string, html string, host string")
    got = sorted(((r.page_id or 0, r.text) for r in html_wrapper.extract(pages).collect()), key=lambda x: (x[0], len(x[1])))
    assert [t for _, t in got] == ["a\nb", "", "", "plain <text> & x", ("word " * 50_000).strip(), "deep", "ok"]
    assert html_wrapper.extract(pages.limit(0)).count() == 0


# Quality


def test_site_quality_query(spark):
    larger = SF.replace("0.001", "0.1")
    quality = {r.doc_id: r.quality for r in spark.read.parquet(f"{larger}/labels.parquet").collect()}
    rows = {r.doc_id: r for r in queries.op8_site_quality(spark, larger).collect()}
    assert len(rows) == 10_000
    assert sum(rows[k].kept for k, q in quality.items() if q) >= 0.985 * sum(quality.values())
    assert sum(rows[k].kept for k, q in quality.items() if not q) <= 0.15 * sum(1 - q for q in quality.values())


def test_site_scores_equal_plain_sums(spark):
    """Posteriors and scores from the documents' own evidence, in plain Python."""
    rows = queries.op8_site_quality(spark, SF).collect()
    p = [1 / (1 + np.exp(-r.evidence)) for r in rows]
    rate = sum(p) / len(p)

    def strength(groups, centre):
        n = sum(len(g) for g in groups.values())
        mean = {k: sum(g) / len(g) for k, g in groups.items()}
        spread = sum(len(g) * (mean[k] - centre(k)) ** 2 for k, g in groups.items())
        noise = sum(sum(x * x for x in g) / len(g) - mean[k] ** 2 for k, g in groups.items())
        whole = sum(len(g) * centre(k) * (1 - centre(k)) for k, g in groups.items())
        between = (spread - noise) / n
        low, high = site_quality.STRENGTH
        return min(max(whole / n / between - 1, low), high) if between > 0 else high

    hosts, paths = {}, {}
    for r, own in zip(rows, p):
        hosts.setdefault(r.source, []).append(own)
        paths.setdefault((r.source, r.lang), []).append(own)
    k = strength(hosts, lambda _: rate)
    host_rate = {h: (sum(g) + k * rate) / (len(g) + k) for h, g in hosts.items()}
    k = strength(paths, lambda key: host_rate[key[0]])
    odds = lambda q: np.log(min(max(q, 1e-6), 1 - 1e-6) / (1 - min(max(q, 1e-6), 1 - 1e-6)))
    for r, own in zip(rows, p):
        group = paths[r.source, r.lang]
        others = (sum(group) - own + k * host_rate[r.source]) / (len(group) - 1 + k)
        shift = min(max(odds(others) - odds(rate), -site_quality.SITE_BOUND), site_quality.SITE_BOUND)
        assert abs(r.host_rate - host_rate[r.source]) < 1e-9 and abs(r.path_rate - others) < 1e-9
        assert abs(r.score - (r.evidence + shift)) < 1e-7 and r.kept == (r.score >= 0)


def test_sparse_sites_shrink(spark):
    rows = [("big", "a", 3.0)] * 400 + [("bad", "a", -3.0)] * 400 + [("mixed", "a", 3.0)] * 50 + [("mixed", "b", -3.0)] * 50 + [("one", "a", -3.0), (None, None, 3.0)]
    evidence = spark.createDataFrame(rows, f"host string, path string, {site_quality.EVIDENCE} double")
    found = site_quality.sites(evidence, "host", "path")
    rates = {(r[site_quality.HOST], r[site_quality.PATH]): r[site_quality.RATE] for r in found.paths.collect()}
    assert rates["big", "a"] > 0.9 and rates["bad", "a"] < 0.1 and abs(rates["one", "a"] - found.rate) < 0.35 and (None, None) in rates


def test_quality_edges(spark):
    docs = spark.createDataFrame([(1, None, "s", None, 5), (2, "", None, "l", 6), (None, "a b", "s", "l", 7), (1, "x " * 50_000, "s", "l", 8)], "doc_id long, text string, source string, lang string, score int")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert site_quality.classify(docs, none).count() == 4
    assert site_quality.keep_good(docs, none).columns == docs.columns
    some = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (2, 0, None), (9, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    assert site_quality.classify(docs, some).count() == 4
    assert site_quality.classify(docs.limit(0), some).count() == 0
    field = crf_lines.fit_on(docs, some)
    assert crf_lines.label_documents(docs, field).count() == 4
    assert crf_lines.keep_content(docs, crf_lines.ALL_CONTENT).count() == 0
    assert crf_lines.label_documents(docs.limit(0), field).count() == 0


# Vectors


def brute_vectors(rows, threshold=0.98):
    usable = {}
    for i, (_, label, v) in enumerate(rows):
        if label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            usable[i] = np.array(v, float)
    pairs = []
    for i in usable:
        for j in usable:
            if i < j and rows[i][1] == rows[j][1] and len(usable[i]) == len(usable[j]):
                a, b = usable[i], usable[j]
                if a @ b / (np.linalg.norm(a) * np.linalg.norm(b)) >= threshold:
                    pairs.append((i, j))
    return pairs


@pytest.mark.parametrize("page", [1024, 16])
def test_vector_links_equal_brute_force(spark, monkeypatch, page):
    monkeypatch.setattr(cap_filters, "PAGE", page)
    random_state = np.random.default_rng(8)
    rows = []
    for label in (0, 1):
        for centre in random_state.standard_normal((12, 64)):
            for _ in range(random_state.integers(1, 60)):
                v = centre + random_state.standard_normal(64) * random_state.uniform(0.02, 0.2)
                rows.append((len(rows), label, v.astype(np.float32).tolist()))
    rows += [(len(rows) + k, *rows[5 * k][1:]) for k in range(20)]
    pairs = brute_vectors(rows)
    counts, roots = Counter(i for p in pairs for i in p), small_roots(pairs, range(len(rows)))
    frame = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>")
    got = {r.vec_id: r for r in cap_filters.near_duplicates(frame).collect()}
    assert sum(r.n_links for r in got.values()) >= 0.999 * 2 * len(pairs)
    assert all(got[i].n_links <= counts[i] for i in got)
    assert np.mean([got[i].component_id == roots[i] for i in got]) > 0.99
    assert all(r.kept == (r.vec_id == r.component_id) for r in got.values())


@pytest.mark.parametrize("width", [1, 2, 3, 4, 6, 8, 32, 64, 768])
def test_pairs_at_the_threshold_share_a_filter(width):
    for vectors in (5_000, 50_000):
        code = cap_filters.code_for(vectors, width)
        first, second = cap_filters.pairs_at(0.9801, width, 4000, 77)
        a, b = (cap_filters.decode_filters(x, code) for x in (first, second))
        assert np.mean([len(np.intersect1d(f, g)) > 0 for f, g in zip(a, b)]) >= 0.999
        longer = 3.7 * first
        c = cap_filters.decode_filters(longer / np.linalg.norm(longer, axis=1, keepdims=True), code)
        assert all(len(np.intersect1d(f, g)) for f, g in zip(a, c))


@pytest.mark.parametrize("width", [1, 3, 4])
def test_narrow_vectors_keep_their_links(spark, width):
    random_state = np.random.default_rng(width)
    rows = [(i, 0, v.tolist()) for i, v in enumerate(random_state.standard_normal((300, width)).astype(np.float32))]
    pairs = brute_vectors(rows)
    frame = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>")
    got = {r.vec_id: r.n_links for r in cap_filters.near_duplicates(frame).collect()}
    counts = Counter(i for p in pairs for i in p)
    assert len(pairs) > 50 and sum(got.values()) >= 0.999 * 2 * len(pairs) and all(got[i] <= counts[i] for i in got)


def test_vector_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, 0, [1.0, 2.0]), (2, 0, [2.0, 4.0]), (3, 1, [1.0, 2.0]), (4, None, [1.0, 2.0]), (5, 0, None), (6, 0, [0.0, 0.0]), (7, 0, [nan, 1.0]), (8, 0, [inf, 1.0]), (9, 0, [None, 1.0]), (10, 0, []), (11, 0, [1.0, 2.0, 3.0]), (None, 0, [1.0, 2.0]), (2, 0, [2.0, 4.0])]
    frame = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>")
    got = Counter((r.vec_id, r.n_links, r.component_id, r.kept) for r in cap_filters.near_duplicates(frame).collect())
    assert got == Counter({(1, 3, 1, True): 1, (2, 3, 1, False): 2, (None, 3, 1, False): 1, **{(i, 0, i, True): 1 for i in range(3, 12)}})
    assert cap_filters.near_duplicates(frame.limit(0)).count() == 0


# Pipeline


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = rows
        rows = stage(spark, before, SF)
        assert rows.columns == docs.columns, name
        ids = {r.doc_id for r in rows.select("doc_id").collect()}
        assert ids <= {r.doc_id for r in before.select("doc_id").collect()}
    kept = {r.doc_id: r.text for r in rows.collect()}
    assert "AKIA" not in "".join(kept.values())
    _, roots = brute_components(kept, 5, (80, 100))
    assert len(set(roots.values())) >= len(kept) - 1
    packed = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id for r in packed} == set(kept)


def test_pipeline_judges_lines_by_the_field_of_the_whole_table(spark):
    larger = SF.replace("0.001", "0.01")
    docs = spark.read.parquet(f"{larger}/documents.parquet")
    labels = spark.read.parquet(f"{larger}/labels.parquet")
    good = docs.join(labels.where("quality = 1").select("doc_id"), "doc_id", "left_semi").select(docs.columns)
    junk = "BUY!! NOW!! $$$ ###\nX | Y | Z | %% ||\n## FREE $$ CASH !! && **\nCLICK | HERE | $$ ||\n"
    # Only documents of one label are left, so a field fitted on them finds content everywhere.
    assert crf_lines.judge(junk, crf_lines.ALL_CONTENT)[-1]
    given = good.unionByName(spark.createDataFrame([(-1, junk, "en", "s", len(junk))], docs.schema))
    kept = [r.doc_id for r in corpus_pipeline.keep_content(spark, given, larger).collect()]
    field = crf_lines.fit_on(docs, labels)
    assert field is not crf_lines.ALL_CONTENT
    assert sorted(kept) == sorted(r.doc_id for r in given.collect() if crf_lines.judge(r.text, field)[-1])
    verdicts = {r.doc_id: r.kept for r in queries.op2_line_rules(spark, larger).collect()}
    assert all(verdicts[k] for k in kept) and -1 not in kept


def test_pipeline_of_empty_documents(spark, tmp_path):
    for name in ("documents", "labels"):
        spark.read.parquet(f"{SF}/{name}.parquet").limit(0).write.parquet(str(tmp_path / f"{name}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_ngram_keys_travel_once_and_packed(spark, monkeypatch):
    """Keys packed, and the members of repeated keys as counted one by one, also when many keys are repeated and few are packed together."""
    monkeypatch.setattr(ngram_join, "PACKED_KEYS", 100)
    monkeypatch.setattr(ngram_join, "BROADCAST_ROWS", 1)
    pick = random.Random(8)
    base = [f"w{pick.randrange(10**6)}" for _ in range(80)]
    texts = [varied(pick, base, pick.randint(0, 3)) for _ in range(40)] + [" ".join(base)] * 5 + [None, "one", "x" * 600 + " a b c d e"]
    docs = spark.createDataFrame([(i, t, None) for i, t in enumerate(texts)], "id long, text string, tag long")
    owners = {}
    for text in texts:
        tokens = words.shingle_set(text, 4)
        for key in ngram_join.group_keys(tokens).tolist():
            owners.setdefault(key >> 20, set()).add((ngram_join.set_id(tokens), len(tokens)))
    wanted = {(k, s, min(i for i, _ in own)) for k, own in owners.items() if len(own) > 1 for s, _ in own}
    cells = ngram_join.keyed(docs, 4, (85, 100)).collect()
    assert max(len(c.entries) for c in cells) < 13 * 100
    rows = ngram_join.repeated_keys(ngram_join.keyed(docs, 4, (85, 100)), (85, 100)).collect()
    assert len(rows) == len(wanted) > 100
    assert {(r.key, r.set_id, r.pivot) for r in rows} == wanted
    most = {s: n for own in owners.values() for s, n in own}
    assert all(most[r.set_id] <= r.n <= 2 * most[r.set_id] for r in rows)
    assert len(compare_groups(spark, dict(enumerate(texts)))) == len(texts)


def test_places_of_sets_are_broadcast_by_their_size(spark):
    names = ["key", "page", "block_size", "pivot"]
    for places, shuffled in ((120, True), (2, False)):
        rows = spark.range(4000 * places).selectExpr(f"id % {places} AS key", "1 AS page", "7L AS block_size", "0L AS pivot", f"id div {places} AS set_id")
        sets = spark.range(5000).selectExpr("id AS set_id", "id * 3 AS n")
        found = ngram_join._placed(rows, sets)
        # few rows with long lists are no small table: the driver would have to hold them
        assert ("ResolvedHint (strategy=broadcast)" not in found._jdf.queryExecution().analyzed().toString()) == shuffled
        assert found.columns == [*names, "set_id", "n"]
        total = found.agg({"*": "count", "key": "sum", "n": "sum"}).first()
        assert (total["count(1)"], total["sum(key)"], total["sum(n)"]) == (4000 * places, 4000 * sum(range(places)), 3 * places * sum(range(4000)))


def test_texts_cut_together_give_the_same_sets(monkeypatch):
    texts = [None, "", " ", "a", "A b", "one two  three\tfour five", "É b c d e f", "x" * 600 + " a b c d e", "a b c d a b c d a b c d", "last words of all the texts"] * 3
    for together in (1, 20, 200, 1 << 16):
        monkeypatch.setattr(words, "TOGETHER", together)
        for n in (1, 4, 5):
            assert [s.tolist() for s in words.shingle_sets(texts, n)] == [words.shingle_set(t, n).tolist() for t in texts]
    assert words.shingle_sets([], 4) == []
