"""The prefix trie, the ranked search and the archives against brute force, SQL and round trips, with awkward rows."""

import hashlib
import heapq
import io
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import pyarrow as pa
import pytest
import zstandard
from pyarrow import fs

import __spark_entry__ as entry
import compare
from triagelake.llm import prefix_trie, ranked_search, warc_files

NEW = ["op11_prefix_trie", "op12_ranked_search", "op13_warc_files"]


@pytest.mark.parametrize("name", NEW)
def test_queries_match_sql(spark, sf_dir, name):
    con = compare.connect(sf_dir)
    assert compare.difference(entry.queries()[name](spark, sf_dir), con, entry.oracle_sql()[name]) is None


# --- prefix trie -----------------------------------------------------------------------------------------------

TURNS = "conv_id long, turn long, role string, text string, depth long, k1 string, n_convs long"


def turn_frame(spark, rows, parts=3):
    return spark.createDataFrame([(*r, 1, "k", None) for r in rows], TURNS).repartition(parts)


def brute_trie(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [r[2:] for r in sorted(turns, key=lambda r: r[:2])] for c, turns in own.items()}
    whole = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        whole[c] = own.get(c - int(math.fmod(c, 100)), [])[:h] + turns[h:]
    members = defaultdict(list)
    for c in sorted(whole):
        for d in range(len(whole[c]) + 1):
            members[tuple(whole[c][:d])].append(c)
    children = defaultdict(list)
    for path in members:
        if path:
            children[path[:-1]].append(path)
    total, out = {}, []
    for path in sorted(members, key=len, reverse=True):
        leaves = sum(total[x][0] for x in children[path]) if children[path] else 1
        own_saved = (len(members[path]) - 1) * (len(path[-1][1]) if path else 0)
        total[path] = leaves, own_saved + sum(total[x][1] for x in children[path])
        ends = ",".join(str(c) for c in members[path] if len(whole[c]) == len(path))
        out.append((
            members[path][0], len(path), members[path[:-1]][0] if path else None, len(members[path]), len(children[path]),
            *total[path], hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(out, key=lambda r: (r[1], r[0]))


def trie_rows(frame):
    return sorted((tuple(r) for r in frame.collect()), key=lambda r: (r[1], r[0]))


def test_trie_on_awkward_rows(spark):
    rows = [
        (0, 1, "user", "hello"), (0, 2, "bot", "Ünï 漢字"), (0, None, None, "first"), (0, 3, "user", None), (0, 4, "a", "b"),
        (1, 1, "user", "x" * 200_000), (None, 1, "user", "no conversation"), (-7, 1, "ab", "c"), (-7, 2, "a", "bc"),
        (205, 1, "r", "turnless if its opening is cut"), (9, 5, "user", "same"), (9, 5, "user", "same"),
        (10**15 + 3, 1, "", ""),
    ]
    rows += [(100 + c, t, "user", f"turn {t}") for c in range(0, 60) for t in range(1 + c % 9)]
    assert trie_rows(prefix_trie.prefix_trie(turn_frame(spark, rows))) == brute_trie(rows)


def test_trie_of_an_empty_table(spark):
    assert prefix_trie.prefix_trie(turn_frame(spark, [])).collect() == []
    assert prefix_trie.prefix_trie(turn_frame(spark, [(None, 1, "a", "b")])).collect() == []


@pytest.fixture
def many_partitions(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_trie_with_a_very_long_conversation_and_many_copies(spark, monkeypatch, many_partitions):
    monkeypatch.setattr(prefix_trie, "LEAST_HEAVY", 4)  # a deep top of the tree and several shards
    rows = [(100, t, "user", f"t{t % 50}") for t in range(3000)]
    rows += [(101, t, "user", f"t{t % 50}") for t in range(2990)]
    rows += [(c, t, "user", f"t{t}") for c in range(300, 700) for t in range(8)]
    rows += [(c, t, "user", f"other {t} {c // 3 * (t > 4)}") for c in range(1000, 1100) for t in range(9)]
    assert trie_rows(prefix_trie.prefix_trie(turn_frame(spark, rows, 7))) == brute_trie(rows)


def test_running_sums_cross_partitions(spark, many_partitions):
    """One conversation holds most rows and spans all partitions."""
    rows = [(5, t, "u", str(t)) for t in range(2000)] + [(c, 0, "u", "x") for c in range(30)]
    got = prefix_trie.numbered_turns(turn_frame(spark, rows)).where("conv_id = 5").orderBy("pos").collect()
    assert [r["pos"] for r in got] == list(range(1, len(got) + 1))
    assert all(a["s1"] == b["q1"] and a["s2"] == b["q2"] for a, b in zip(got, got[1:], strict=False))
    assert len({r["pid"] for r in got}) > 1


def test_spilling_queue():
    draw = random.Random(3)
    queue, plain = prefix_trie.SpillingQueue(2, limit=5, most_runs=3), []
    for _ in range(3000):
        if plain and draw.random() < 0.45:
            assert queue.top() == plain[0]
            assert queue.pop() == heapq.heappop(plain)
        else:
            entry = (draw.randrange(-50, 50), draw.randrange(1 << 62))
            queue.push(entry)
            heapq.heappush(plain, entry)
    assert queue.made > 3
    assert [queue.pop() for _ in range(len(plain))] == sorted(plain)
    assert queue.top() is None


# --- ranked search ---------------------------------------------------------------------------------------------

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_search(docs, items, k):
    words = [(d, TERM.findall((t or "").translate(LOWER))) for d, t in docs]
    held = [x for x in words if x[1]]
    n_docs, n_terms = len(held), sum(len(w) for _, w in held)
    df = Counter(x for _, w in held for x in set(w))
    out = []
    for item, text in items:
        scores = []
        for doc, found in held:
            tf, m = Counter(found), 75 + 25 * len(found) * n_docs // n_terms
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[x] + 1))) * (10**9 * tf[x] // (1000 * tf[x] + 12 * m))
                for x in TERM.findall((text or "").translate(LOWER)) if x in tf
            )
            if score > 0:
                scores.append((-score, doc is None, doc))
        out += [(item, i, d, -s) for i, (s, _, d) in enumerate(sorted(scores, key=lambda x: (x[0], x[1], x[2] or 0))[:k], 1)]
    return sorted(out, key=str)


ODD_DOCS = [
    (1, "Plain words, plain WORDS and Ärger mit ärger"), (2, None), (3, ""), (4, "...---..."), (5, "words and " * 30_000),
    (None, "plain without an id"), (7, "copy copy"), (7, "copy copy"), (8, "copy copy"), (6, "copy copy"), (9, "x_y-z 42 \x7f a b"),
]
ODD_ITEMS = [
    (1, "plain words"), (2, None), (3, ""), (4, "nothing known here"), (None, "copy"), (5, "words words words ärger"), (5, "a b Y 42"),
    (6, "the copy of plain"),
]


@pytest.mark.parametrize(("k", "block"), [(20, 10**6), (2, 3)])
def test_search_on_awkward_rows(spark, k, block):
    docs = spark.createDataFrame([(*r, 1, "s") for r in ODD_DOCS], "doc_id long, text string, rank long, item string").repartition(3)
    items = spark.createDataFrame([(*r, 1.0) for r in ODD_ITEMS], "item_id long, text string, score double")
    got = ranked_search.search(docs, items, k, block)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute_search(ODD_DOCS, ODD_ITEMS, k)


def test_search_of_empty_tables(spark):
    docs = spark.createDataFrame(ODD_DOCS, "doc_id long, text string")
    items = spark.createDataFrame(ODD_ITEMS, "item_id long, text string")
    assert ranked_search.search(docs, items.limit(0)).collect() == []
    assert ranked_search.search(docs.limit(0), items).collect() == []
    assert ranked_search.search(docs.where("doc_id IN (2, 3, 4)"), items).collect() == []


def test_heaps_keep_the_best_of_any_order():
    draw = random.Random(5)
    rows = [(draw.randrange(1, 6), i) for i in range(200)]
    draw.shuffle(rows)
    heaps = ranked_search.Heaps(1, 20)
    for score, doc in rows:
        heaps.add(pa.array([score]).to_numpy().reshape(1, 1), [doc])
    assert sorted((-s, -d) for s, d in heaps.heaps[0]) == sorted((-s, d) for s, d in rows)[:20]


# --- archives --------------------------------------------------------------------------------------------------

BIG, OTHER = "<p>gleich ü " * 200, "<div>" + "z" * 2000
ODD_PAGES = [
    (1, "http://a.example/x", BIG), (2, "http://a.example/y", BIG), (9, None, BIG), (None, "http://n.example/", BIG),
    (3, "http://b.example/a b\r\nX: 1", "small"), (4, "http://b.example/", "small"), (5, "u", None), (6, "", ""),
    (7, "http://twice.example/", OTHER), (7, "http://twice.example/", OTHER), (7, "http://twice.example/2", OTHER),
    (8, "http://long.example/", "ab\r\n\r\ncd" * 300_000), (10, "x", "é" * 499 + "a"), (11, "x", "é" * 499 + "a"),
    (12, "x", "é" * 500), (13, "x", "é" * 500), (None, "v", "q" * 1500), (None, "v", "q" * 1500),
]
PAGES = "page_id long, url string, html string, payload_digest string, start long, refers_to string"


def odd_pages(spark):
    return spark.createDataFrame([(*r, "clash", 5, "x") for r in ODD_PAGES], PAGES).repartition(3)


def brute_records(pages):
    groups = defaultdict(list)
    for i, (page_id, _, html) in enumerate(pages):
        raw = (html or "").encode()
        groups[raw if len(raw) >= 1000 else i].append((page_id, raw))
    out = []
    for rows in groups.values():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0), reverse=True)
        for n, (page_id, raw) in enumerate(rows):
            out.append((page_id, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if n else "response", rows[0][0] if n else None))
    return sorted(out, key=str)


def test_archives_round_trip(spark, monkeypatch):
    for name, value in (("SAMPLE", 3000), ("BLOCK", 500)):
        monkeypatch.setattr(warc_files, name, value)
    folder = warc_files.shared_uri(spark, "archives")
    blocks = warc_files.write_archives(odd_pages(spark), folder, archive=2000)
    assert blocks.select("path").distinct().count() > 2
    got = warc_files.read_archives(spark, blocks, folder, with_payload=True).collect()
    names = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert sorted((tuple(r[x] for x in names) for r in got), key=str) == brute_records(ODD_PAGES)
    texts = {hashlib.sha1((h or "").encode()).hexdigest(): (h or "").encode() for _, _, h in ODD_PAGES}
    assert all(bytes(r["payload"]) == texts[r["payload_digest"]] for r in got if r["record_type"] == "response")
    assert all(r["payload"] is None for r in got if r["record_type"] == "revisit")
    assert {r["url"] for r in got if r["page_id"] == 3} == {"http://b.example/a%20b%0D%0AX:%201"}
    assert {r["url"] for r in got if r["page_id"] == 9} == {None}


def test_an_archive_can_be_read_by_itself(spark):
    """From front to back with the dictionary in its first frame, and each record from its own frame."""
    folder = warc_files.shared_uri(spark, "archives")
    blocks = warc_files.write_archives(odd_pages(spark).coalesce(1), folder).collect()
    system, _ = fs.FileSystem.from_uri(folder)
    paths = sorted({r["path"] for r in blocks})
    found, ids = 0, set()
    for path in paths:
        with system.open_input_file(path) as file:
            raw = file.read()
        dictionary = warc_files.dictionary_of(io.BytesIO(raw))
        unpack = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary))
        with unpack.stream_reader(io.BytesIO(raw), read_across_frames=True) as reader:
            whole = reader.read()
        assert whole.count(b"WARC/1.1\r\n") == sum(r["records"] for r in blocks if r["path"] == path)
        for record in warc_files.records_of(io.BytesIO(raw), 8 + len(dictionary), len(raw), unpack):
            ids.add(re.search(rb"WARC-Record-ID: (\S+)", record)[1])
            found += 1
    assert found == len(ODD_PAGES)
    assert len(ids) >= found - 2  # small repeated payloads without a page_id may share one


def test_damaged_records_are_refused():
    record = warc_files.warc_record(1, "u", b"payload", hashlib.sha1(b"payload").hexdigest(), False, None, "<urn:x>")
    assert warc_files.parse_record(record)["payload"] == b"payload"
    for damaged in (record.replace(b"payload\r\n", b"paYload\r\n"), record[:-1], b"X" + record):
        with pytest.raises(ValueError, match="record"):
            warc_files.parse_record(damaged)


def test_the_dictionary_makes_records_smaller():
    draw = random.Random(1)
    names = [f"section-{i}" for i in range(50)]
    records = [("<html><head><title>page</title></head>" + "".join(
        f"<div class='{draw.choice(names)}'>{draw.random()}</div>" for _ in range(8))).encode() for _ in range(400)]
    dictionary = zstandard.ZstdCompressionDict(warc_files.trained(records[:200]))
    with_it, without = zstandard.ZstdCompressor(dict_data=dictionary), zstandard.ZstdCompressor()
    assert sum(len(with_it.compress(x)) for x in records[200:]) < 0.7 * sum(len(without.compress(x)) for x in records[200:])


def test_archives_of_an_empty_table(spark):
    folder = warc_files.shared_uri(spark, "archives")
    blocks = warc_files.write_archives(odd_pages(spark).limit(0), folder)
    assert warc_files.read_archives(spark, blocks, folder).collect() == []
