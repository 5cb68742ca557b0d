"""The corpus operators against brute force, round trips and held-out accuracy, with awkward rows."""

import base64
import hashlib
import html
import re
import time
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import compare
import corpus_pipeline
from triagelake.llm import (
    classifier, common, fingerprints, html_text, lm_scores, mixing, ngram_join, packing, rules, token_files, tokens, url_filter,
)
from triagelake.session import scratch_path

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, row long, key string, label string, n long"
LONG = " ".join(f"word{i % 977} and, more" for i in range(40_000))
SAME = "one two three four five six seven eight nine ten. " * 12
ROWS = [
    (1, "Plain words make a sentence here.\nAnd another line follows it.", "en", "a"),
    (2, None, "en", "a"), (3, "", None, None), (4, "  \t\n ", "en", "b"), (5, LONG, "en", "a"),
    (6, SAME, "en", "b"), (7, SAME, "en", "c"), (7, SAME, "en", "c"), (None, "an id that is null, with text.", "en", None),
    (8, "THE É'S <|endoftext|> it's 12 x\x0by\x1cz ﬁ İ 漢字", "en", "b"), (9, "two words", "en", "a"),
    (7, "other text under the same id, and it is longer than four words.", "en", "c"),
]


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and very long texts, ties, repeated rows, and extra columns with clashing names."""
    rows = [(*r, None if r[1] is None else len(r[1]), i, "k", None, 3) for i, r in enumerate(ROWS)]
    return spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return common.table(spark, sf_dir, "documents")


@pytest.fixture(scope="module")
def texts(sf_dir):
    return dict(duckdb.sql(f"SELECT doc_id, coalesce(text, '') FROM '{sf_dir}/documents.parquet' ORDER BY doc_id").fetchall())


def raw(text):
    return np.frombuffer(text.encode(), dtype=np.uint8)


@pytest.mark.parametrize("name", ["op1_url_filter", "op6_quality_rules", "op10_mixing"])
def test_queries_match_sql(spark, sf_dir, name):
    con = compare.connect(sf_dir)
    assert compare.difference(entry.queries()[name](spark, sf_dir), con, entry.oracle_sql()[name]) is None


def test_word_hashes_follow_words(texts):
    for text in [*list(texts.values())[:100], *[r[1] or "" for r in ROWS]]:
        words = [w.translate({i: i + 32 for i in range(65, 91)}) for w in WORD.findall(text)]
        got = common.word_hashes(raw(text))
        assert len(got) == len(words)
        assert len(set(got.tolist())) == len(set(words))


def test_blocks_of_long_texts_do_not_change_hashes(monkeypatch):
    whole = common.word_hashes(raw(LONG))
    monkeypatch.setattr(common, "BLOCK", 100)
    assert (common.word_hashes(raw(LONG)) == whole).all()


def test_url_cascade_is_exact_in_one_block_and_in_several(spark, monkeypatch):
    names = [f"h{i}.example{i % 7}.com" for i in range(3000)]
    listed = spark.createDataFrame([(n,) for n in names if hash_mod(n, 5)] + [(None,), ("",), ("x.org",)], "key string")
    pages = spark.createDataFrame(
        [(i, f"http://www.{n.upper()}/p") for i, n in enumerate(names)] + [(-1, None), (-2, "no scheme"), (-3, "a://x.org"), (-4, "a:///p")],
        "page_id long, url string",
    )
    want = {i: "block" if hash_mod(n, 5) else "allow" for i, n in enumerate(names)} | {-1: "allow", -2: "allow", -3: "block", -4: "allow"}
    assert {r.page_id: r.verdict for r in url_filter.judge_urls(pages, listed, []).collect()} == want
    monkeypatch.setattr(url_filter, "SHARD_BITS", 256)
    monkeypatch.setattr(url_filter, "BLOCK_SHARDS", 2)
    assert {r.page_id: r.verdict for r in url_filter.judge_urls(pages, listed, []).collect()} == want
    assert url_filter.judge_urls(pages.limit(0), listed, url_filter.RULES).count() == 0
    assert {r.verdict for r in url_filter.judge_urls(pages, listed.limit(0), []).collect()} == {"allow"}


def hash_mod(name, n):
    return zlib.crc32(name.encode()) % n == 0


def test_url_rules(spark):
    cases = {
        "HTTP://Sub.Example.NET/en/x?a": ("sub.example.net", "/en/x", "example.net/en/", "allow"),
        "http://example.net/de/": ("example.net", "/de/", "net/", "block"), "http://example.net": ("example.net", "", None, "allow"),
        "http://example.com/de/1": ("example.com", "/de/1", "example.com/de/", "block"), "x://a.org/fr/": ("a.org", "/fr/", "org/fr/", "allow"),
        "x://xexample.com/de/": ("xexample.com", "/de/", None, "allow"), "x://net/#y": ("net", "/", "net/", "block"),
    }
    none = spark.createDataFrame([], "key string")
    pages = spark.createDataFrame([(u, "clash") for u in cases], "url string, host string")
    got = {r.url: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judge_urls(pages, none, url_filter.RULES).collect()}
    assert got == cases


def test_classifier_on_held_out_labels(spark, sf_dir):
    found = entry.queries()["op2_quality_classifier"](spark, sf_dir)
    known = found.join(common.table(spark, sf_dir, "labels"), "doc_id").where("held_out").select("predicted", "quality", "score").collect()
    assert sum(r.predicted == r.quality for r in known) >= 0.95 * len(known) and len(known) > 30
    assert all(0 <= r.score <= 1 for r in known)


def test_classifier_takes_any_rows(spark, odd, docs, sf_dir):
    labels = common.table(spark, sf_dir, "labels")
    model = classifier.train(docs, labels)
    got = classifier.score_documents(odd, model).collect()
    assert len(got) == len(ROWS) and all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if r.text == SAME}) == 1
    assert {r.score for r in classifier.score_documents(odd, classifier.train(docs, labels.limit(0))).collect()} == {0.5}
    assert classifier.score_documents(odd.limit(0), model).count() == 0


def test_attention_gradients():
    draw = np.random.default_rng(1)
    bags, y = [draw.normal(size=(n, classifier.MEASURES)) for n in (1, 3, 2)], np.array([1.0, 0.0, 1.0])
    x, of, starts = np.concatenate(bags), np.array([0, 1, 1, 1, 2, 2]), np.array([0, 1, 4])
    h, g = classifier.HIDDEN, classifier.GATE
    p = {"W": draw.normal(size=(classifier.MEASURES, h)) / 5, "b": draw.normal(size=h), "V": draw.normal(size=(h, g)),
         "U": draw.normal(size=(h, g)), "w": draw.normal(size=g), "u": draw.normal(size=h), "c": np.zeros(1)}

    def loss():
        s = classifier._forward(p, x, starts, of)[0]
        return -(y * np.log(s) + (1 - y) * np.log(1 - s)).mean()

    p["x"] = x
    for name, found in classifier._gradients(p, x, starts, of, y).items():
        flat, at = p[name].reshape(-1), p[name].size // 2
        flat[at] += 1e-5
        up = loss()
        flat[at] -= 2e-5
        down = loss()
        flat[at] += 1e-5
        assert found.reshape(-1)[at] == pytest.approx((up - down) / 2e-5, abs=1e-6)


def test_embedding_gradients():
    draw = np.random.default_rng(2)
    table_, words = draw.normal(size=(1 << classifier.ROW_BITS, classifier.DIM)), np.array([2, 0, 3], dtype=np.int32)
    rows = np.array([[1, 2, 2], [3, 1, 5], [9, 9, 9], [1, 4, 6], [5, 2, 7]], dtype=np.uint16)
    de = draw.normal(size=(3, classifier.DIM))
    want = np.zeros_like(table_)
    for word, passage in enumerate([0, 0, 2, 2, 2]):
        for at in rows[word]:
            want[at] += de[passage] / (classifier.LOOKUPS * words[passage])
    assert classifier._to_embeddings(de, words, rows) == pytest.approx(want)
    mean = np.stack([table_[rows[a:b].reshape(-1)].sum(0) / max(1, 3 * (b - a)) for a, b in ((0, 2), (2, 2), (2, 5))])
    assert classifier._embedded(table_, words, rows) == pytest.approx(mean)


def test_classifier_learns_words():
    """Labels that only the words tell: lengths, letters and punctuation have one distribution."""
    draw = np.random.default_rng(3)
    names = ["".join(draw.choice(list("abcdefgh"), 6)) for _ in range(400)]
    made = [" ".join(draw.choice(names[200 * good:200 * good + 200], 150)) for good in [0, 1] * 150]
    bags, labels = [classifier.passages(raw(t)) for t in made], np.array([0.0, 1.0] * 150)
    model = classifier.fit(bags[:200], labels[:200])
    assert np.mean([(model.score(b) >= 0.5) == y for b, y in zip(bags[200:], labels[200:], strict=True)]) > 0.95
    whole = classifier.passages(raw(made[0]))
    assert len(whole.rows) == 150 and whole.words.tolist() == [64, 64, 22]


def test_page_texts(spark, sf_dir):
    pages = duckdb.sql(f"SELECT page_id, html FROM '{sf_dir}/pages.parquet'").fetchall()
    got = {r.page_id: (r.text, r.n_chars) for r in entry.queries()["op3_main_text"](spark, sf_dir).collect()}
    for page_id, source in pages:
        body = re.search(r"<article>(.*?)(</article>|\Z)", source, re.S)[1]
        body = re.sub(r"</?b>", "", body)
        want = " ".join(html.unescape(re.sub(r"<[^>]*>", " ", body)).split())
        assert got[page_id] == (want, len(want))


@pytest.mark.parametrize("source, want", [
    (None, ""), ("", ""), ("a &amp; b\n\n c", "a & b c"), ("<p>x<p>y</div><li>z", "x y z"), ("<script>var a='<p>no</p>'", ""),
    ("<p>text<!-- open", "text"), ("<p>text</p><di", "text"),
    ("<nav>menu</nav><div><p>" + "good text, " * 20 + "</p></div><div class='cookie-notice'><p>" + "bad, " * 60 + "</div>", ("good text, " * 20).strip()),
    ("<article><p>" + "body, " * 20 + "</p><div id=comments><p>" + "said, " * 80 + "</p></div></article><footer>f", ("body, " * 20).strip()),
    ("<div><a href=x>" + "link, " * 50 + "</a></div><div><p>" + "real text, " * 20 + "</p></div>", ("real text, " * 20).strip()),
])
def test_page_cases(source, want):
    assert html_text.main_text(source) == want


@pytest.mark.parametrize("source, want", [
    ("<script>var o=\"<!--\";</script><article><p>Text</p></article>", "Text"),
    ("<style>a{content:'<!--'}</style><article><p title='<!--'>Text</p></article>", "Text"),
    ("<article><p>Text <!-- a --> more</p><!-- b <p>c</p></article>", "Text more"),
])
def test_page_comments(source, want):
    assert html_text.main_text(source) == want


@pytest.mark.parametrize("source, want", [
    ("<article><p class='share'>Share<p>One.</p><p>Two.</p></article>", "One. Two."),
    ("<article><ul><li class=ad>Buy<li>One<li>Two</ul><p>Three</article>", "One Two Three"),
    ("<table><tr><td class=ad>Buy<td>One<tr class=promo><td>No<tr><td>Two</table>", "One Two"),
    ("<dl><dt class=ad>Buy<dd>One<dt>Two</dl>", "One Two"),
    ("<article><div><nav><a href=x>Menu</div><p>One</p></article>", "One"),
    ("<div><nav><p>a<p>b<ul><li>c<li>d</ul></nav><p>One</div>", "One"),
])
def test_page_skipping_ends(source, want):
    assert html_text.main_text(source) == want


TEXT, MORE = ("good text, " * 20).strip(), ("more said here, " * 12).strip()


@pytest.mark.parametrize("source, want", [
    (f"<div class='site-content has-sidebar'><p>{TEXT}</p></div>", TEXT),
    (f"<div class=has-sidebar><article><p>{TEXT}</p></article><div class=sidebar><p>{MORE}</p></div></div>", TEXT),
    (f"<article class='post comments-open'><p>{TEXT}</p><div class=comments><p>{MORE * 9}</p></div></article>", TEXT),
    (f"<body><form id=aspnetForm><input><div><p>{TEXT}</p></div></form>", TEXT),
    (f"<form><article><p>{TEXT}</p><form class=search>Find it here</form></article></form>", TEXT),
    (f"<article><p>{TEXT}</p><section id=search><h2>Search</h2><p>{MORE}</p></section></article>", f"{TEXT} Search {MORE}"),
    (f"<article><p>{TEXT}</p><section id=related-work><h2>Related</h2><p>{MORE}</p></section></article>", f"{TEXT} Related {MORE}"),
    (f"<article><h2 id=advertising>Adverts</h2><p>{TEXT}</p></article>", f"Adverts {TEXT}"),
    (f"<article><p>{TEXT}</p><pre>x = 1 <span class=hljs-comment># one</span></pre></article>", f"{TEXT} x = 1 # one"),
    (f"<article><p>{TEXT}</p><div class=related><h2>See</h2><a href=x>{MORE}</a></div><p class=share>Share</p></article>", TEXT),
    (f"<article><p>{TEXT}</p><form><p>{MORE}</p></form><ol class=comments><li><article class=comment><p>{MORE}</article></ol></article>", TEXT),
    (f"<div><p>{TEXT}</p></div><div aria-hidden=true><p>{MORE}</p></div><p hidden>{MORE}</p>", TEXT),
])
def test_page_doubtful_parts(source, want):
    assert html_text.main_text(source) == want


def reference_ids(path):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids + [2]


def crc(ids):
    return zlib.crc32(np.asarray(ids, dtype="<u4").tobytes())


def test_encoder_equals_the_tokenizer(texts):
    path = tokens.default_path()
    ids = reference_ids(path)
    some = [*list(texts.values())[:150], *[r[1] for r in ROWS if r[1] != LONG], "don't 'll x'sy é́ a\u0301b №5 ß ǅ", "a" * 5000]
    assert [crc([*np.frombuffer(x, dtype="<u4"), 2]) for x in tokens.encoder(path).encode(some)] == [crc(ids(x)) for x in some]


def test_encoder_keeps_marks_that_lower_case_adds():
    path = tokens.default_path()
    ids = reference_ids(path)
    some = ["visit İzmir now", "İ", "İİ x", "a İ\nb", "KELVIN \u212a, İSTANBUL!"]
    assert [[*np.frombuffer(x, dtype="<u4"), 2] for x in tokens.encoder(path).encode(some)] == [ids(x) for x in some]


@pytest.mark.parametrize("hot", ["7", "null", "7 + (1L << 60) + id % 2"])
def test_id_slices_follow_the_order_and_cut_a_hot_id(spark, hot):
    rows = spark.range(9000).select(
        F.expr(f"if(id % 3 = 0, {hot}, id)").cast("long").alias("doc_id"), F.xxhash64("id").alias("order")
    )
    number, n = common.id_slices(rows, "doc_id", "order", 30)
    got = rows.select(number.alias("slice"), "doc_id", "order").collect()
    got.sort(key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.order))
    numbers = [r.slice for r in got]
    assert numbers == sorted(numbers) and numbers[0] >= 0 and numbers[-1] < n
    if "60" not in hot:
        assert max(Counter(numbers).values()) < 3 * 9000 / 30
    number, n = common.id_slices(rows.limit(0), "doc_id", "order", 30)
    assert n == 1 and rows.limit(0).select(number).count() == 0


def test_token_files_round_trip(spark, odd):
    ids, path = reference_ids(tokens.default_path()), tokens.default_path()
    folder = scratch_path(spark, "test-tokens")
    token_files.write_tokens(odd, folder, path)
    got = sorted(token_files.token_digest(spark, folder).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted((r[0] for r in ROWS), key=lambda x: (x is not None, x))
    start = 0
    for row in got:
        assert row.start == start
        start += row.n_tokens
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == Counter((r[0], len(ids(r[1])), crc(ids(r[1]))) for r in ROWS)
    plan = token_files.read_tokens(spark, folder).where("doc_id = 5")._jdf.queryExecution().toString()
    assert "PushedFilters: [IsNotNull(doc_id), EqualTo(doc_id,5)]" in plan
    empty = scratch_path(spark, "test-tokens")
    token_files.write_tokens(odd.limit(0), empty, path)
    assert token_files.token_digest(spark, empty).count() == 0


def test_packing_covers_every_id_once(spark, odd):
    ids = reference_ids(tokens.default_path())
    want = {i: ids(r[1]) for i, r in enumerate(ROWS)}
    by_size = defaultdict(list)
    for r in packing.pack(odd, tokens.default_path()).collect():
        assert r.offset == 0 and r.length & (r.length - 1) == 0 and r.length <= 4096 and crc(r.ids) == r.ids_crc32
        by_size[r.doc_id].append(r)
    assert len({r.sequence_id for rows in by_size.values() for r in rows}) == sum(map(len, by_size.values()))
    for doc_id in (1, 2, 3, 5, 6, 8, 9, None):
        rows = sorted(by_size[doc_id], key=lambda r: r.start)
        own = next(want[i] for i, r in enumerate(ROWS) if r[0] == doc_id)
        assert [x for r in rows for x in r.ids] == own and {r.doc_tokens for r in rows} == {len(own)}
    assert packing.pack(odd.limit(0), tokens.default_path()).count() == 0
    assert all(sum(packing.piece_lengths(n)) == n for n in range(1, 9000, 7))


@pytest.mark.parametrize("page", [
    lambda n: "<span>x" * n + "</p>" * n, lambda n: "<div>some text, " * n, lambda n: "<b><div>" + "<span>" * n + "</b>" * n,
    lambda n: "<table>" + "<tr><td>cell, of a table that never ends " * n, lambda n: "<ul>" + "<li>item" * n + "</b>" * n,
    lambda n: "<article class=comment>" * n + "x" * 200, lambda n: "<div><p>one</p>" + "<h2>two</h2>" * n + "</div>",
])
def test_the_work_on_a_page_goes_with_its_length(page):
    """2 MB of nested or unclosed elements in a few seconds."""
    text = page(100)
    started = time.process_time()
    html_text.main_text(page(2_000_000 * 100 // len(text)))
    assert time.process_time() - started < 12


def test_encoder_equals_the_library_on_any_characters(monkeypatch):
    """Random texts of letters of all kinds, digits, marks, white space, broken and special tokens, in calls of any size."""
    ids, draw = reference_ids(tokens.default_path()), np.random.default_rng(11)
    pieces = ["a", "b", "the", "Z", "É", "é", "ß", "÷", "×", "ÿ", "Þ", "İ", "'", "'s", "1", "23", ".", ",", "--", "<", "|", "<|endoftext|>",
              "<|ENDOFTEXT|>", "漢", "ﬁ", "\u0301", "\u00a0", "\x0b", "\x1c", "\x00", "\u2028", "😀", "ª", "_", " ", " ", " ", "\n", "\t\r", "  "]
    texts = ["".join(draw.choice(pieces, draw.integers(0, 30))) for _ in range(1500)] + ["", None, " ", "\n\n", "x"]
    want = [ids(x)[:-1] for x in texts]
    for at_once in (1, 200, 1 << 20):
        monkeypatch.setattr(tokens, "AT_ONCE", at_once)
        got = [np.frombuffer(x, dtype="<u4").tolist() for x in tokens.Encoder(tokens.default_path()).encode(texts)]
        assert [i for i, (x, y) in enumerate(zip(got, want, strict=True)) if x != list(y)] == []


def test_packed_files_round_trip(spark, odd, sf_dir):
    want = packing.pack(odd, tokens.default_path())
    got = packing.packed(odd, tokens.default_path())
    assert got.columns == want.columns and got.dtypes == want.dtypes
    rows, names = got.collect(), ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids"]
    assert Counter(str([r[x] for x in names]) for r in rows) == Counter(str([r[x] for x in names]) for r in want.collect())
    assert all(len(r.ids) == r.length and crc(r.ids) == r.ids_crc32 for r in rows)
    assert len({r.sequence_id for r in rows}) == len(rows)
    files = [(r.length, re.search(r"/length=(\d+)/", r.file)) for r in got.select("length", F.input_file_name().alias("file")).collect()]
    assert all(at and int(at[1]) == n for n, at in files)
    assert packing.packed(odd.limit(0), tokens.default_path()).count() == 0
    for query in (entry.queries()["op8_packing"](spark, sf_dir), corpus_pipeline.pack(spark, odd, sf_dir)):
        assert "/length=" in query.select(F.input_file_name()).first()[0]


def words5(text):
    words = [w.translate({i: i + 32 for i in range(65, 91)}) for w in WORD.findall(text)]
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def test_fingerprints_of_edits(spark, sf_dir, texts):
    got = {r.doc_id: r for r in entry.queries()["op5_fingerprints"](spark, sf_dir).collect()}
    ids, errors = list(texts), []
    assert sorted(got) == ids
    for i, doc_id in enumerate(ids):
        text, after = texts[doc_id], texts[ids[(i + 1) % len(ids)]]
        cut = len(text) // 2
        edited = text[:len(text) - cut] + after[:cut]
        row = got[doc_id]
        assert (row.n_chars, row.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        a, b = words5(text), words5(edited)
        errors.append(abs(row.near_edited - (len(a & b) / len(a | b) if a | b else 1.0)))
    assert np.mean(errors) < 0.05 and max(errors) < 0.25
    by_text = defaultdict(set)
    for doc_id, text in texts.items():
        by_text[text].add(got[doc_id].fingerprint)
    assert all(len(x) == 1 for x in by_text.values())


def test_sketches_estimate_and_merge(spark, odd):
    a, b = fingerprints.sketch(raw(LONG)), fingerprints.sketch(raw(LONG[:len(LONG) // 2]))
    assert fingerprints.distinct_shingles(a) == pytest.approx(len(words5(LONG)), rel=0.3)
    assert fingerprints.containment(b, a) > 0.9 and len(fingerprints.from_text(fingerprints.as_text(a))) == fingerprints.K
    parts = spark.createDataFrame(
        [("x", fingerprints.as_text(fingerprints.sketch(raw(f"part {i % 50} of the text with words {i % 50}")))) for i in range(500)] + [("y", "")],
        "key string, fingerprint string",
    )
    got = {r.key: r.fingerprint for r in fingerprints.merge_sketches(parts, "key").collect()}
    whole = fingerprints.smallest(np.concatenate([fingerprints.sketch(raw(f"part {i} of the text with words {i}")) for i in range(50)]), fingerprints.K)
    assert got == {"x": fingerprints.as_text(whole), "y": ""}
    found = fingerprints.fingerprint_edits(odd)
    assert found.count() == len(ROWS) and found.where("near_edited is null").isEmpty()
    assert base64.b64decode(found.where("doc_id = 2").first().fingerprint) == b""
    assert fingerprints.fingerprint_edits(odd.limit(0)).count() == 0


def test_quality_rules_on_odd_rows(spark, odd):
    con = duckdb.connect()
    short = F.coalesce(F.length("text"), F.lit(0)) < 10_000
    con.register("odd", odd.where(short).select("doc_id", "text").toPandas())
    want = con.execute(f"SELECT n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, kept FROM ({rules.kept_sql('odd')})").fetchall()
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "kept"]
    assert Counter(map(tuple, rules.judge_quality(odd.where(short)).select(names).collect())) == Counter(want)
    words = WORD.findall(LONG)
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = {q for p in range(len(words) - 2) if windows[tuple(words[p:p + 3])] > 1 for q in (p, p + 1, p + 2)}
    long = rules.judge_quality(odd.where(~short)).first()
    assert (long.n_words, long.n_repeat_words, long.kept) == (len(words), len(covered), False)
    assert rules.cleaned_documents(odd).columns == odd.columns
    assert rules.judge_quality(odd.limit(0)).count() == 0
    good = "\n".join(f"Line{i} tells of{i} some{i} other{i} things{i} again{i}." for i in range(12))
    junk = good + "\nHome | News | Sport | About\nAll rights reserved.\n" + good.split("\n")[0]
    cleaned = rules.cleaned_documents(odd.limit(1).withColumn("text", F.lit(junk))).first()
    assert cleaned.text == good and cleaned.n_chars == len(good)


PROSE = " ".join(f"some{i} words{i} of{i} a{i} paragraph{i}" for i in range(20))


@pytest.mark.parametrize("text", [
    PROSE, PROSE + " 。", PROSE + " with a cookie in it.", PROSE + " see the catalog in print.", "。".join("漢字の文" * 3 + f" {i}" for i in range(60)) + "。",
])
def test_rules_leave_prose_alone(spark, text):
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert rules.judge_quality(docs).first().kept
    assert not rules.judge_quality(docs.withColumn("text", F.lit("\n".join(["Sign up for our cookie letter"] * 9 + [f"Log in {i}" for i in range(20)])))).first().kept


def test_rules_keep_blank_lines(spark):
    lines = [f"Line{i} tells of{i} some{i} other{i} things{i} again{i}." for i in range(12)]
    text = "\n\n".join(lines[:6]) + "\n \t\n\n" + "\n".join(lines[6:]) + "\nHome | News | Sport | About\n" + lines[0]
    docs = spark.createDataFrame([(1, text, 0)], "doc_id long, text string, n_chars long")
    got = rules.cleaned_documents(docs).first()
    assert got.text == "\n\n".join(lines[:6]) + "\n\n\n" + "\n".join(lines[6:]) and got.n_chars == len(got.text)
    assert rules.judge_quality(docs).first().n_dup_lines == 1


def brute_components(rows, words, percent):
    sets = []
    for _, text in rows:
        w = [x.translate({i: i + 32 for i in range(65, 91)}) for x in WORD.findall(text or "")]
        sets.append(frozenset(tuple(w[i:i + words]) for i in range(max(1, len(w) - words + 1))) if w else frozenset())
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            shared = len(sets[i] & sets[j])
            if shared and 100 * shared >= percent * len(sets[i] | sets[j]):
                parent[find(i)] = find(j)
    least = defaultdict(list)
    for i, (doc_id, _) in enumerate(rows):
        least[find(i)].append(doc_id)
    return [(doc_id, len(sets[i]), min((x for x in least[find(i)] if x is not None), default=None)) for i, (doc_id, _) in enumerate(rows)]


@pytest.mark.parametrize(("percent", "width", "few"), [(85, 3, 0), (60, 100, 1000)])
def test_join_finds_every_component(spark, odd, percent, width, few, monkeypatch):
    monkeypatch.setattr(ngram_join, "SLICE", width)
    monkeypatch.setattr(ngram_join, "FEW_LINKS", few)
    draw = np.random.default_rng(3)
    rows = [(r[0], r[1]) for r in ROWS]
    base = [f"w{i}" for i in range(60)]
    for i in range(150):  # near copies that drift apart, so that components are chains
        base[draw.integers(60)] = f"n{i}"
        rows.append((100 + i, " ".join(base)))
    for i in range(60):
        rows.append((300 + i, "a passage that many share " * 3 + " ".join(f"q{draw.integers(40)}" for _ in range(8))))
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = Counter(map(tuple, ngram_join.near_duplicates(frame, percent=percent).select("doc_id", "n_shingles", "component_id").collect()))
    want = Counter(brute_components(rows, 4, percent))
    assert (got - want, want - got) == (Counter(), Counter())
    kept = ngram_join.one_of_each(frame, percent=percent)
    shown = {x[2] for x in brute_components(rows, 4, percent) if x[1]}
    assert len({r.doc_id for r in kept.collect()} & shown) == len(shown)


@pytest.mark.parametrize("few", [0, 1000])
def test_components_of_paths_stars_and_rings(spark, few, monkeypatch):
    monkeypatch.setattr(ngram_join, "FEW_LINKS", few)
    draw = np.random.default_rng(5)
    groups = [[draw.permutation(40).tolist()], [list(range(100, 130))], [[200, x] for x in range(201, 260)], [[300, 301, 302, 300], [302, 299]]]
    links = [(a, b) for group in groups for path in group for a, b in zip(path, path[1:], strict=False)]
    frame = spark.createDataFrame([links[i] for i in draw.permutation(len(links))], "a long, b long").repartition(4)
    got = {r.node: r.label for r in ngram_join.components(frame).collect()}
    want = {x: min(min(path) for path in group) for group in groups for path in group for x in path}
    assert got == want


def test_join_of_nothing(spark, odd):
    assert ngram_join.near_duplicates(odd.limit(0)).count() == 0
    assert ngram_join.one_of_each(odd).columns == odd.columns


def test_lm_scores_against_counts(spark, odd):
    rows = [(1, "the cat sat on the mat", True), (2, "the dog sat on the log", False), (3, None, None), (4, "cat mat cat mat", True)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, target boolean").repartition(2)
    counts = lm_scores.gather(docs)
    got = {r.doc_id: r for r in lm_scores.score_documents(docs, counts).collect()}
    size = 1 << lm_scores.WORD_BITS
    for doc_id, text, _ in rows:
        for name, keep in (("background_loss", lambda t: True), ("target_loss", bool)):
            single, pair = Counter(), Counter()
            for _, other, mark in rows:
                words = (other or "").split() if keep(mark) else []
                single.update(words)
                pair.update(zip([None, *words], words))
            starts = sum(n for (v, _), n in pair.items() if v is None)
            losses = []
            for v, w in zip([None, *(text or "").split()], (text or "").split()):
                share = (single[w] + 0.5) / (sum(single.values()) + 0.5 * size)
                seen = pair[v, w] if v is None else single[v]
                losses.append(-np.log2((pair[v, w] + 8 * share) / (max(seen, pair[v, w]) + 8)))
            assert starts >= 0 and got[doc_id][name] == pytest.approx(np.mean(losses) if losses else 0.0, rel=1e-4)
    assert lm_scores.score_documents(odd, counts).count() == len(ROWS)
    assert lm_scores.gather(docs.limit(0))["words"].sum() == 0


def test_lm_counts_keep_every_word_and_pair_apart(spark):
    rows = [(i, " ".join(f"w{i}x{k}" for k in range(3000)), i % 2 == 0) for i in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, target boolean").repartition(4)
    counts = lm_scores.gather(docs)
    assert counts["distinct"] == 300_000 and counts["words"].tolist() == [300_000, 150_000]
    got = {r.doc_id: r for r in lm_scores.score_documents(docs, counts).collect()}
    share, none = 1.5 / (300_000 + 0.5 * 300_001), 0.5 / (150_000 + 0.5 * 300_001)
    for i, row in got.items():
        assert row.n_words == 3000 and row.background_loss == pytest.approx(-np.log2((1 + 8 * share) / 9), rel=1e-9)
        if i % 2:
            assert row.target_loss == pytest.approx(-np.log2(none), rel=1e-9)


def lm_rows(frame):
    return sorted([(r.doc_id is not None, r.doc_id or 0, r.n_words, *[pytest.approx(x, rel=1e-9, abs=1e-12) for x in r[2:]]) for r in frame.collect()],
                  key=lambda r: (r[:3], str(r[3])))


@pytest.mark.parametrize("chunk_bytes", [1, 300, 1 << 24])
def test_a_corpus_is_scored_alike_by_stored_models_and_in_one_pass(spark, odd, chunk_bytes):
    docs = odd.withColumn("target", F.col("row") % 2 == 0)
    want = lm_rows(lm_scores.score_documents(docs, lm_scores.gather(docs)))
    got = lm_rows(lm_scores.score_corpus(docs, chunk_bytes=chunk_bytes))
    assert len(got) == len(ROWS) and got == want
    assert lm_scores.score_corpus(docs.limit(0)).collect() == []


def test_lm_query_scores_every_document(spark, sf_dir, texts):
    rows = entry.queries()["op9_lm_scores"](spark, sf_dir).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    assert all(r.n_words == len(WORD.findall(texts[r.doc_id])) for r in rows)


def test_packed_keys_round_trip():
    draw = np.random.Generator(np.random.PCG64(1))
    for n in (0, 1, 1000):
        keys = np.sort(draw.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2))
        assert (lm_scores._unpack_keys(lm_scores._pack_keys(keys)) == keys).all()


def test_mix_of_odd_rows(spark, odd):
    sized = mixing.sized_documents(odd)
    plan = mixing.plan_mix(sized.select("source", "size", "hash"))
    rows = plan.copies(sized).collect()
    assert len(rows) == len(ROWS) and {r._copies for r in rows} <= {0, 1, 2}
    assert sum({r.source: r.target for r in rows}.values()) == pytest.approx(1.5 * sum(r.size for r in rows))
    assert all(r.target <= 2 * r.source_size for r in rows)
    assert mixing.mixed_documents(odd).columns == odd.columns
    assert mixing.mixed_documents(odd.limit(0)).count() == 0


def test_mix_of_one_id_and_clashing_columns(spark):
    """A thousand rows without an id are taken one by one; columns named like the plan's keep their values."""
    rows = [(None, f"text {i} has some words " + "more " * (i % 7), "a", -1.5, "mine", 7) for i in range(1000)]
    rows += [(i, "other " * 900, "b", -2.5, "yours", 8) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, target double, hash string, source_size int")
    plan = mixing.plan_mix(mixing.sized_documents(docs).select("source", "size", "hash"))
    goals = {r.source: r.target for r in plan.sources.collect()}
    found = mixing.mixed_documents(docs)
    assert found.columns == docs.columns
    taken = found.collect()
    for source, goal in goals.items():
        assert sum(len(r.text.split()) for r in taken if r.source == source) == pytest.approx(goal, rel=0.02)
    assert {(r.source, r.target, r.hash, r.source_size) for r in taken} == {("a", -1.5, "mine", 7), ("b", -2.5, "yours", 8)}


def test_mix_of_capped_sources_takes_empty_documents_no_third_time(spark):
    rows = [(i, "" if i % 2 else "some words here", "a") for i in range(200)] + [(i, "word " * 900, "b") for i in range(200, 300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    plan = mixing.plan_mix(mixing.sized_documents(docs).select("source", "size", "hash"))
    capped = plan.sources.where("target = 2 * source_size").collect()
    assert [(r.source, r.every, r.below) for r in capped] == [("a", 2, 0)]
    taken = Counter(r.doc_id for r in mixing.mixed_documents(docs).where("source = 'a'").collect())
    assert len(taken) == 200 and set(taken.values()) == {2}


def test_stages_keep_clashing_columns(spark, odd, sf_dir):
    """Documents with columns named like the stages' own come out of each stage with their own values and types."""
    clash = odd.withColumns({"score": F.lit("mine"), "predicted": F.lit(9.5), "target": F.lit("t"), "source_size": F.lit(None).cast("string"),
                             "hash": F.lit(True), "kept": F.lit("k"), "own": F.lit(1)})
    for name, stage in corpus_pipeline.STAGES[:-1]:
        found = stage(spark, clash, sf_dir)
        assert found.dtypes == clash.dtypes, name
        assert {(r.score, r.predicted, r.target, r.source_size, r.hash, r.kept, r.own) for r in found.collect()} <= {("mine", 9.5, "t", None, True, "k", 1)}, name
        assert stage(spark, clash.limit(0), sf_dir).collect() == [], name


def test_pipeline_stages(spark, sf_dir, docs):
    found, names = docs, docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = found
        found = corpus_pipeline.materialize(stage(spark, before, sf_dir), "test-stage")
        assert found.columns == names, name
        rows = [(r.doc_id, r.text) for r in before.select("doc_id", "text").collect()]
        after = Counter(r.doc_id for r in found.select("doc_id").collect())
        if stage is corpus_pipeline.quality_rules:
            assert set(after) == {r.doc_id for r in rules.judge_quality(before).where("kept").collect()}
        elif stage is corpus_pipeline.quality_classifier:
            model = classifier.train(before, common.table(spark, sf_dir, "labels"))
            assert set(after) == {i for i, t in rows if model.score(classifier.passages(raw(t))) >= classifier.THRESHOLD}
        elif stage is corpus_pipeline.near_duplicates:
            assert set(after) == {x[2] for x in brute_components(rows, 5, 80)}
        else:
            assert max(after.values()) <= 2 and found.count() > before.count()
    ids = reference_ids(tokens.default_path())
    pieces = corpus_pipeline.pack(spark, found, sf_dir)
    assert pieces.agg(F.sum("length")).first()[0] == sum(len(ids(r.text)) for r in found.select("text").collect())
