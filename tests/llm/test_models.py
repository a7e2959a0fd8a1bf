"""Trained operators: held-out quality, defined cases, and the packing plan against brute force."""

import itertools
import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from strandlake.llm import htmltext, labelled_urls, langid, packing, toxicity, urlfilter
from strandlake.llm.queries import op5_main_text, op7_toxicity, op8_packing, op10_url_filter

from ..conftest import DATA

SF = f"{DATA}/sf0.001"


@pytest.fixture(scope="module")
def field():
    return htmltext.fit(htmltext.labelled_pages(200))


def test_field_on_held_out_pages(field):
    pages = htmltext.labelled_pages(80, seed=99)
    pairs = [(a, b) for page, labels in pages for a, b in zip(field.decode(htmltext.blocks(page)), labels, strict=True)]
    assert sum(a == b for a, b in pairs) / len(pairs) > 0.97


def test_viterbi_is_exact(field):
    found = htmltext.blocks("<body><nav><a href=/>x</a></nav><article><h1>T</h1><p>Some text, here.</p><p>More.</p></article><div class=comments><p>No.</p></div>")
    gain = [field.weights["bias"] + sum(field.weights.get(f, 0) for f in x) for x in htmltext.features(found)]
    kind = htmltext.same_parent(found)

    def score(y):
        return sum(g for g, v in zip(gain, y, strict=True) if v) + sum(field.steps[kind[i], y[i - 1], y[i]] for i in range(1, len(y)))

    assert score(field.decode(found)) == pytest.approx(max(score(y) for y in itertools.product((0, 1), repeat=len(found))))


def test_blocks_repair_markup():
    page = "<p>a <b>b<br>c<p>d&amp;e&nbsp;f</div><ul><li>x<li>y</ul><script>var s='<p>no</p>'</script>tail <a href='>'>link</a> 1 < 2<!-- gone --><style>p{}"
    assert [b.text for b in htmltext.blocks(page)] == ["a b c", "d&e f", "x", "y", "tail link 1 < 2"]
    assert htmltext.blocks(None) == htmltext.blocks("") == htmltext.blocks("<p> \n</p>") == []


def test_blocks_after_unclosed_tags():
    rest = "<article><h1>Title</h1><p>Body text.</p></article>"
    said = ["Title", "Body text."]
    for tag in ("svg", "math", "object", "canvas", "audio", "video", "option", "noscript", "template", "iframe", "select"):
        assert [b.text for b in htmltext.blocks(f"<div><{tag}></div>{rest}")] == said, tag
        assert [b.text for b in htmltext.blocks(f"<{tag}>{rest}")] == said, tag
    assert [b.text for b in htmltext.blocks(f"<datalist><option value=a><option value=b></datalist>{rest}")] == said
    assert [b.text for b in htmltext.blocks("<p>a<script>var x = 1;")] == ["a"]


def hostile_pages():
    yield "<a " * 340_000 + '"'
    yield '<a x="' * 170_000
    yield "<div>" * 200_000 + "x" + "</span>" * 100_000
    yield "<!--" * 250_000
    yield "<script>" * 100_000
    yield "<a " + "= " * 500_000


@pytest.mark.parametrize("page", list(hostile_pages()), ids=range(6))
def test_hostile_pages_take_linear_time(page):
    htmltext.blocks("<p>x")
    times = []
    for part in (page[: len(page) // 4], page):
        began = time.process_time()
        htmltext.blocks(part)
        times.append(time.process_time() - began)
    assert times[1] < max(1.0, 8 * times[0])


def test_extract_cases(spark):
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    assert htmltext.extract(empty).collect() == []
    long = "<article>" + "<p>Some words in a paragraph of the text, as they come.</p>" * 20_000 + "</article>"
    rows = [(1, "u", None), (2, None, ""), (3, "u", long), (3, "u", long), (None, "u", "<p>x")]
    got = htmltext.extract(spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({"text": F.lit(1), "n_chars": F.lit("n")})).collect()
    assert [(r.text, r.n_chars) for r in got if r.page_id in (1, 2)] == [("", 0)] * 2
    assert all(r.n_chars == len(r.text) > 1_000_000 for r in got if r.page_id == 3)


def test_blocks_keep_formulas_and_objects():
    page = "<p>So <math><mi>x</mi><mo>=</mo><mn>2</mn></math> holds <svg viewBox='0'><title>icon</title><g><path d='M0'/></g></svg>here.</p><object data=a>Instead of it.</object><p>End.</p>"
    found = htmltext.blocks(page)
    assert [b.text for b in found] == ["So x=2 holds here.", "Instead of it.", "End."]
    assert [[t for t, _ in b.path] for b in found] == [["p"], ["object"], ["p"]]


def test_extraction(spark, field):
    page = "<html><nav><ul><li><a href=/>Home</a></li></ul></nav><article><h1>Title &amp; more</h1><p>First   line\n here.</p><p>Second, line.</p></article><footer>&copy; x &middot; y.</footer></html>"
    rows = [(1, "u", page), (2, None, None), (3, "u", ""), (None, "u", page), (1, "u", page)]
    got = htmltext.extract(spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit(1)), field).collect()
    text = "Title & more\n\nFirst line here.\n\nSecond, line."
    assert sorted((r.text, r.n_chars) for r in got) == [("", 0), ("", 0), *[(text, len(text))] * 3]


def test_extraction_of_test_pages(spark):
    import html

    pages = {r.page_id: r for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    for r in op5_main_text(spark, SF).collect():
        inner = re.search("(?s)<article>(.*?)</article>", pages[r.page_id].html)[1]
        parts = [" ".join(html.unescape(re.sub("<[^>]+>", " ", x)).split()) for x in re.split("</?(?:p|h1)>", inner)]
        assert r.text == "\n\n".join(p for p in parts if p)


def test_language_of_documents(spark):
    docs = spark.read.parquet(f"{DATA}/sf0.01/documents.parquet")
    got = langid.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert np.mean([r.language == r.lang for r in got]) > 0.98
    assert np.mean([r.accepted for r in got]) > 0.99


def test_language_cases(spark):
    docs = spark.read.parquet(f"{DATA}/sf0.01/documents.parquet").select("doc_id", "text", "lang", "source")
    odd = spark.createDataFrame([(-1, None, "en", "s"), (-2, "", None, None), (-3, "12345 !!", "en", "s"), (-4, "Съешь же ещё этих мягких французских булок, да выпей чаю. " * 9, None, "s"), (-5, "the and of with " * 20, None, None), (-6, "the and of with " * 20, "xx", "new")], "doc_id long, text string, lang string, source string")
    df = docs.unionByName(odd).withColumns({"language": F.lit(1), "sl_logs": F.lit(2), "Posterior": F.lit(3)})
    got = {r.doc_id: r for r in langid.identify(df.select("doc_id", "text", "lang", "source")).filter("doc_id < 0").collect()}
    assert all(got[i].language == "und" and not got[i].accepted for i in (-1, -2, -3, -4))
    assert all(got[i].language == "en" and got[i].accepted for i in (-5, -6))
    kept = langid.keep_accepted(df)
    assert kept.columns == df.columns
    assert {r.doc_id for r in kept.filter("doc_id < 0").collect()} == {-5, -6}
    assert langid.identify(docs.limit(0)).count() == 0


def test_every_declared_language_has_its_class(spark):
    rng = random.Random(5)
    rows = []
    for k in range(60):
        words = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(6)) for _ in range(25)]
        rows += [(len(rows) + i, " ".join(rng.choice(words) for _ in range(40)), f"{chr(97 + k // 26)}{chr(97 + k % 26)}", "s") for i in range(6 if k < 50 else 4)]
    got = langid.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()
    said = {r[0]: r[2] for r in rows}
    assert all(r.language == said[r.doc_id] and r.accepted for r in got)
    assert len({r.language for r in got}) == 60


def test_language_evidence_is_fused(spark):
    docs = spark.read.parquet(f"{DATA}/sf0.01/documents.parquet")
    model = langid.train(docs)
    short = spark.createDataFrame([(1, "la", "es", "h"), (2, "la", "fr", "h")] + [(i, "la de", "es" if i % 2 else "fr", "h") for i in range(3, 9)], "doc_id long, text string, lang string, source string")
    many = docs.select("doc_id", "text", "lang", "source").unionByName(short.withColumn("doc_id", -F.col("doc_id")))
    got = {r.doc_id: r.language for r in langid.identify(many, model=model, declared_col="lang").filter("doc_id in (-1, -2)").collect()}
    assert got == {-1: "es", -2: "fr"}
    page = spark.createDataFrame([("<!DOCTYPE html><html class='x' lang=\"de-AT\"><p>", "https://www.Shop.example.at/x")], "html string, url string")
    assert tuple(page.select(*langid.page_evidence(F.col("html"), F.col("url"))).first()) == ("de-AT", "www.shop.example.at", "at")


def test_language_of_pages(spark):
    docs = spark.read.parquet(f"{DATA}/sf0.01/documents.parquet")
    said, host, suffix = langid.page_evidence(F.col("html"), F.col("url"))
    text = F.regexp_replace("html", "(?s)^.*<article>|</article>.*$|<[^>]*>", " ")
    pages = spark.read.parquet(f"{DATA}/sf0.01/pages.parquet").select("page_id", text.alias("text"), said.alias("said"), host.alias("host"), suffix.alias("suffix"))
    found = langid.identify(pages, id_col="page_id", declared_col="said", host_col="host", suffix_col="suffix", model=langid.train(docs))
    got = found.withColumnRenamed("doc_id", "page_id").join(pages, "page_id").collect()
    assert np.mean([r.language == r.said for r in got]) > 0.98
    assert np.mean([r.accepted for r in got]) > 0.98


def test_language_fusion_matches_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = langid.train(docs)
    found, _ = langid.with_language(docs.withColumn("sfx", F.substring("source", -1, 1)), declared_col="lang", suffix_col="sfx", model=model)
    rows = [(r.text, r.lang, r.source or "", r.sfx or "", r.language, r.posterior) for r in found.collect()]
    k = len(model.languages)

    def soft(x):
        e = np.exp(np.asarray(x) - max(x))
        return e / e.sum()

    said = lambda lang: model.languages.index(lang) if lang in model.languages else k
    like = [model.likelihoods(r[0]) for r in rows]
    host, suffix, table = {}, {}, np.full((k + 1, k), 0.5)
    for r, x in zip(rows, like, strict=True):
        if x is not None:
            p = soft(x)
            host[r[2], r[3]] = host.get((r[2], r[3]), 0) + p
            suffix[r[3]] = suffix.get(r[3], 0) + p
            table[said(r[1])] += p
    whole = table.sum(0) / table.sum()
    for r, x in zip(rows, like, strict=True):
        if x is None:
            assert (r[4], r[5]) == ("und", 0.0)
            continue
        above = (suffix[r[3]] + whole * langid.SMOOTH_SUFFIX) / (suffix[r[3]].sum() + langid.SMOOTH_SUFFIX)
        own = host[r[2], r[3]]
        prior = (own + above * langid.SMOOTH_HOST) / (own.sum() + langid.SMOOTH_HOST)
        p = soft(np.array(x) + np.log(prior) + np.log(table[said(r[1])] / table.sum(0)))
        assert model.languages[int(p.argmax())] == r[4]
        assert r[5] == pytest.approx(p.max(), abs=1e-9)


def test_text_likelihoods_match_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = langid.train(docs)
    for r in docs.limit(40).collect():
        raw = [b for b in f" {r.text.lower()} ".encode() if 97 <= b <= 122 or b >= 128 or b in (10, 32)]
        slots = [((a * 40503 + b * 9973 + c * 31) * 2654435761 & 0xFFFFFFFF) >> 17 for a, b, c in zip(raw, raw[1:], raw[2:], strict=False)]
        got = model.likelihoods(r.text)
        if got is not None:
            want = [sum(float(model.table[s, i]) for s in slots) / len(slots) * min(len(slots), langid.EVIDENCE) for i in range(len(model.languages))]
            assert got == pytest.approx(want, rel=1e-5)


def test_languages_tie_in_alphabetical_order(spark):
    rows = [(i, "same words here", lang, "s") for i, lang in enumerate(["b", "a", "b", "a"])]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    assert {r.language for r in langid.identify(df).collect()} == {"a"}


def test_corpus_query_covers_documents_and_pages(spark):
    docs, pages = (spark.read.parquet(f"{DATA}/sf0.01/{t}.parquet") for t in ("documents", "pages"))
    got = langid.identify_corpus(docs, pages).collect()
    assert sorted(r.doc_id for r in got if r.kind == "document") == sorted(r.doc_id for r in docs.collect())
    assert sorted(r.page_id for r in got if r.kind == "page") == sorted(r.page_id for r in pages.collect())
    said = {r.page_id: r.lang for r in pages.select("page_id", F.regexp_extract("html", 'lang="([a-z]+)', 1).alias("lang")).collect()}
    assert np.mean([r.language == said[r.page_id] for r in got if r.kind == "page"]) > 0.97


def test_margin_is_the_sum_over_pairs():
    rng = np.random.default_rng(4)
    for n in (0, 1, 2, 9):
        w, v, bias = rng.normal(size=n), rng.normal(size=(n, 8)), 0.3
        scale = 1 / np.sqrt(1 + n / 16)
        want = bias + scale * sum(w) + scale * scale * sum(float(v[i] @ v[j]) for i in range(n) for j in range(i))
        assert toxicity.margin(bias, w, v) == pytest.approx(want)


def test_scores_match_brute_force(spark):
    docs, labels = (spark.read.parquet(f"{DATA}/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    machine = toxicity.train(docs, labels)
    got = {r.doc_id: r.score for r in toxicity.score_documents(docs, labels).collect()}
    for r in docs.limit(120).collect():
        terms = {t for w in re.findall(r"[^\W\d_]+", (r.text or "").lower()) for t in (w, *("^" + w[:n] for n in (4, 5) if len(w) > n))}
        at = sorted({machine.place[s] for s in {zlib.crc32(t.encode()) % toxicity.SLOTS for t in terms} if s in machine.place})
        scale = 1 / np.sqrt(1 + len(at) / 16)
        pairs = sum(float(machine.factors[i] @ machine.factors[j]) for i, j in itertools.combinations(at, 2))
        z = machine.bias + scale * sum(machine.weights[at]) + scale * scale * pairs
        assert got[r.doc_id] == pytest.approx(1 / (1 + np.exp(-np.clip(z, -30, 30))), abs=1e-9)


def test_machine_learns_pairs():
    rng = random.Random(0)
    rows = []
    for _ in range(3000):
        insult, group = rng.random() < 0.5, rng.random() < 0.5
        words = [f"w{rng.randint(0, 300)}q" for _ in range(15)] + ["vermin"] * insult + ["zorgons"] * group
        words = [w.translate(str.maketrans("0123456789", "abcdefghij")) for w in words]
        rows.append((" ".join(words), int(insult and group)))
    machine = toxicity.fit([(toxicity.text_slots(t), y) for t, y in rows[:2000]], epochs=25)
    wrong = sum((machine.score(t) >= 0.5) != bool(y) for t, y in rows[2000:])
    assert wrong / 1000 < 0.03
    assert machine.score("vermin zorgons") > 0.5 > max(machine.score("vermin"), machine.score("zorgons"), machine.score(""))


def test_toxicity_of_documents(spark):
    labels = spark.read.parquet(f"{DATA}/sf0.1/labels.parquet")
    got = op7_toxicity(spark, f"{DATA}/sf0.1").join(labels, "doc_id").filter("held_out").collect()
    hit = sum(r.predicted and r.toxic for r in got)
    assert hit / sum(r.toxic for r in got) > 0.85  # the labels of these tables are noisy
    assert hit / sum(r.predicted for r in got) > 0.9
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)


def test_toxicity_cases(spark):
    docs = spark.createDataFrame([(i, f"fine words {'idiot' if i % 3 == 0 else 'calm'}") for i in range(60)] + [(100, None), (101, ""), (None, "idiot"), (5, "calm")], "doc_id long, text string").withColumns({"label": F.lit(1), "score": F.lit(2), "body": F.lit(3)})
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(60)] + [(None, 1), (7, None)], "doc_id long, toxic int")
    got = toxicity.score_documents(docs, labels).collect()
    assert len(got) == 64
    by = {r.doc_id: r.score for r in got}
    assert by[100] == by[101]
    assert by[None] > 0.5 > by[5]
    assert toxicity.keep_clean(docs, labels).columns == docs.columns
    assert toxicity.keep_clean(docs, labels).filter("doc_id < 60 and doc_id % 3 = 0").count() == 0
    none = toxicity.score_documents(docs, labels.limit(0)).collect()
    assert max(r.score for r in none) < 1e-9
    assert toxicity.score_documents(docs.limit(0), labels).count() == 0


def least_number(items, size):
    items, best = sorted(items, reverse=True), [len(items)]

    def put(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(items):
            best[0] = len(bins)
            return
        for room in {b for b in bins if b + items[i] <= size}:
            j = bins.index(room)
            put(i + 1, [*bins[:j], room + items[i], *bins[j + 1 :]])
        put(i + 1, [*bins, items[i]])

    put(0, [])
    return best[0]


def test_bin_completion_is_optimal_on_small_sets():
    rng = random.Random(1)
    better = 0
    for _ in range(150):
        items = [rng.randint(5, 60) for _ in range(rng.randint(1, 12))]
        bins = packing.bin_completion(dict(Counter(items)), 100)
        assert Counter(x for b, n in bins for x in b for _ in range(n)) == Counter(items)
        assert all(sum(b) <= 100 for b, _ in bins)
        best = least_number(items, 100)
        assert sum(n for _, n in bins) == best
        assert packing.least_bins(dict(Counter(items)), 100) <= best
        better += sum(n for _, n in packing.best_fit(dict(Counter(items)), 100)) > best
    assert better


def test_bin_completion_of_many():
    rng = random.Random(2)
    counts = Counter(min(2048, int(rng.lognormvariate(6, 1)) + 1) for _ in range(20_000))
    bins = packing.bin_completion(dict(counts))
    got = Counter()
    for b, n in bins:
        got.update({x: c * n for x, c in Counter(b).items()})
    assert got == counts
    assert sum(n for _, n in bins) <= packing.least_bins(dict(counts), 2048) + 1


@pytest.mark.parametrize("low,high", [(60, 200), (30, 300)])
def test_bin_completion_of_many_short_pieces(low, high):
    rng = random.Random(5)
    counts = Counter(rng.randint(low, high) for _ in range(50_000))
    bins = packing.bin_completion(dict(counts))
    assert sum(n for _, n in bins) <= packing.least_bins(dict(counts), 2048) + 1


def test_fillings_are_all_undominated_ones():
    rng = random.Random(6)
    for _ in range(60):
        counts = Counter(rng.randint(3, 30) for _ in range(rng.randint(1, 9)))
        room = rng.randint(10, 60)
        lengths = sorted((x for x in counts if x <= room), reverse=True)
        work = packing._Work(10**9)
        got = list(packing.fillings(lengths, counts, room, work))
        every = {tuple(sorted(c, reverse=True)) for k in range(len(list(counts.elements())) + 1) for c in itertools.combinations([x for x in counts.elements() if x <= room], k) if sum(c) <= room}

        def beaten(f, every=every, counts=counts, room=room):
            left = counts - Counter(f)
            for k in range(len(f) + 1):
                for part in itertools.combinations(f, k):
                    if any(sum(part) <= y <= room - sum(f) + sum(part) and not (len(part) == 1 and part[0] == y) for y in left):
                        return True
            return False

        assert set(got) == {f for f in every if not beaten(f)}
        assert len(got) == len(set(got))
        assert [sum(f) for f in got] == sorted((sum(f) for f in got), reverse=True)


def test_ids_are_those_of_tokenizers(spark):
    from tokenizers import Tokenizer

    path = packing.default_tokenizer()
    tok = Tokenizer.from_file(path)
    encode = packing.encoder(path)
    texts = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").collect()]
    for t in [*texts, "", " ", "\n\n  x", "a<|endoftext|>b", "hello <|endoftext|> world", "<|endoftext|>", "<|endoftext|><|endoftext|> <|endoftext", "x" * 20_000, " " * 20_000, "don't  stop\t123 é漢字🙂"]:
        assert list(encode(t)) == tok.encode(t, add_special_tokens=False).ids


def check_packing(rows, lengths):
    assert {(r.doc_id, r.piece): 1 for r in rows}.keys() == {(d, k) for d, n in lengths.items() for k in range(len(packing.cut(n)))}
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spans in by.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 2048
    return len(by)


def test_packing_of_documents(spark):
    encode = packing.encoder(packing.default_tokenizer())
    ids = {r.doc_id: np.array([*encode(r.text or ""), 0], "<u4") for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = op8_packing(spark, SF).collect()
    n = check_packing(rows, {d: len(x) for d, x in ids.items()})
    assert n <= -(-sum(map(len, ids.values())) // 2048) + 1
    for r in rows:
        assert zlib.crc32(ids[r.doc_id][r.start : r.start + r.length]) == r.ids_crc32
    assert all(r.length == 2048 for r in rows if r.piece)


def test_packing_cases(spark):
    rows = [(1, None), (2, ""), (3, "word " * 9000), (None, "x"), (4, "same"), (4, "same")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"length": F.lit("x"), "salt": F.lit(1), "rank": F.lit(1)})
    got = packing.pack(df).collect()
    assert sorted((r.length for r in got if r.doc_id in (1, 2))) == [1, 1]
    assert len([r for r in got if r.doc_id == 4]) == 2
    places = [(r.sequence_id, r.offset) for r in got]
    assert len(set(places)) == len(places)
    assert packing.pack(df.limit(0)).count() == 0


def test_rules(spark):
    urls = ["http://a.com/x", "http://com/", "http://a.com", "https://Example.COM/en/1?q", "https://m.example.com/en/", "https://www.example.com/en/2", "https://example.com/english", "x://a.net/es/", "x://a.net/fr/1#z", "x://net.org/es/", None, "no scheme/net/es/", "", "x://b.example.com/en/?/", "a://b://c.net/es/", "x://\n.net/es/\n"]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id int, url string").withColumns({"host": F.lit(1), "rule": F.lit(2), "score": F.lit(3)})

    def plain(url):
        if url is None or "://" not in url:
            return "", "", None
        rest = url.split("://", 1)[1]
        host = re.match("(?s)[^/?#]*", rest)[0]
        path = re.match("(?s)[^?#]*", rest[len(host) :])[0]
        host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
        fits = []
        for said, rule in urlfilter.RULES:
            h, _, p = rule.partition("/")
            if (host == h or host.endswith("." + h)) and path.startswith("/" + p):
                fits.append((len(rule), rule, said))
        return host, path, max(fits)[1:] if fits else None

    for r in urlfilter.judge(df).collect():
        host, path, hit = plain(urls[r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, hit and hit[0])
        assert r.verdict == hit[1] if hit else r.verdict in ("allow", "block")


def test_url_model_on_held_out_hosts(spark):
    rows = labelled_urls.rows()
    fold = lambda url: zlib.crc32(url.split("/")[2].encode()) % 5
    assert len({r[0].split("/")[2] for r in rows}) == len(rows)
    right = 0
    for k in range(5):
        model = urlfilter.fit(spark, [r for r in rows if fold(r[0]) != k])
        held = spark.createDataFrame([r for r in rows if fold(r[0]) == k], "url string, y int")
        got = held.select("y", urlfilter.score(*urlfilter.split_url(F.col("url")), model).alias("p")).collect()
        right += sum((r.p >= 0.5) == bool(r.y) for r in got)
    assert right / len(rows) > 0.9


def test_url_scores_match_brute_force(spark):
    w, b = urlfilter.fit(spark)
    urls = ["http://a.net/x", "", None, "https://Blog.Example.org/a/b?c", "x://y", *(r[0] for r in labelled_urls.rows()[::9]), "http://h.org/" + "long/" * 500]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id int, url string")
    got = {r.page_id: r for r in urlfilter.judge(df.unionAll(df)).collect()}
    grams = {f"{mark}^{text}$"[:1] + f"^{text}$"[i : i + n] for r in got.values() for mark, text in (("h", r.host), ("p", r.path)) for n in urlfilter.GRAMS for i in range(max(len(text) + 3 - n, 1))}
    slot = {r.g: r.s for r in spark.createDataFrame([(g,) for g in grams], "g string").select("g", F.pmod(F.xxhash64("g"), F.lit(urlfilter.DIMS)).alias("s")).collect()}
    for r in got.values():
        at = [slot[mark + f"^{text}$"[i : i + n]] for mark, text in (("h", r.host), ("p", r.path)) for n in urlfilter.GRAMS for i in range(max(len(text) + 3 - n, 1))]
        z = sum(float(f"{w[s]:.6g}") for s in at) / np.sqrt(len(at)) + b
        assert r.score == pytest.approx(1 / (1 + np.exp(-z)), abs=1e-9)


def test_url_query(spark):
    plan = op10_url_filter(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
    assert urlfilter.judge(spark.createDataFrame([], "page_id long, url string")).count() == 0
