"""Decontamination, periodic runs and conversation tries next to brute force, and their results for odd input."""

import hashlib
import random
import zlib

import duckdb
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from uptide.llm import decontaminate, periodic_runs, prefix_trie, queries

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
CLASH = ["v", "data", "n", "runs", "spans", "items", "top", "row", "found", "key", "wave", "h", "block", "depth", "path"]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def over(sql, **tables):
    """Rows of a query in DuckDB over lists of tuples or Parquet files."""
    con = duckdb.connect()
    for name, path in tables.items():
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con.execute(sql).fetchall()


# Decontamination -----------------------------------------------------------------------------------------------------


def brute_hits(text, items, window=10):
    words = decontaminate.words_of((text or "").encode())
    hit, names = set(), set()
    for name, other in items:
        x = decontaminate.words_of((other or "").encode())
        k = min(window, len(x))
        wins = {tuple(x[i : i + k]) for i in range(len(x) - k + 1)} if x else set()
        for i in range(len(words) - k + 1):
            if tuple(words[i : i + k]) in wins:
                hit.update(range(i, i + k))
                names |= {str(name)} if name is not None else set()
    return len(words), hit, names


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.sampled_from("aBcé"), max_size=9).map(" ".join), max_size=5), st.lists(st.sampled_from(["a", "b", "C", "é", "zz", "-"]), max_size=30).map(" ".join), st.integers(1, 5))
def test_automaton_matches_brute_force(items, text, window):
    coded = [(f"i{n}", decontaminate.words_of(t.encode()), True) for n, t in enumerate(items)]
    matcher = decontaminate.Matcher(decontaminate.build_automaton([c for c in coded if c[1]], window))
    n, spans, names, _ = matcher.match(text.encode())
    assert (n, {p for a, b in spans for p in range(a, b)}, set(names)) == brute_hits(text, [(f"i{i}", t) for i, t in enumerate(items)], window)
    assert all(a[1] < b[0] for a, b in zip(spans, spans[1:]))


def test_longest_match_and_stretches(monkeypatch):
    item = " ".join(f"w{i}" for i in range(30))
    matcher = decontaminate.Matcher(decontaminate.build_automaton([("a", decontaminate.words_of(item.encode()), True)]))
    text = ("x y " + item[:70] + " ... " * 50 + "w20 w21 Q").encode()
    whole = matcher.match(text)
    assert whole[3] == 22 and whole[1] == [[2, 24]]
    for stretch in (1, 5, 64):
        monkeypatch.setattr(decontaminate, "STRETCH", stretch)
        assert matcher.match(text) == whole


@pytest.fixture(scope="module")
def contaminated(spark, sf):
    docs = [tuple(r)[:5] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    long = " ".join(f"t{i % 997}x{i}" for i in range(9000))
    items += [(900, None), (901, ""), (902, "Tiny Item"), (902, "Tiny Item"), (903, "tiny"), (None, "no id here"), (904, long), (905, items[0][1]), (905, items[1][1])]
    docs += [(70_000, None, None, None, None), (70_001, "", "en", "s", 0), (70_002, "a TINY item; no-id HERE", "en", "s", 0), (70_002, "a TINY item; no-id HERE", "en", "s", 0), (70_002, "other", "en", "s", 0)]
    docs += [(None, "tiny", "en", "s", 0), (70_003, "x " * 30_000 + items[0][1], "en", "s", 0), (70_004, " ".join(long.split()[4080:4120]).upper(), "en", "s", 0)]
    frame = spark.createDataFrame(docs, DOCS).repartition(4).withColumns({c: F.lit("clash") for c in CLASH})
    tests = spark.createDataFrame(items, "item_id long, text string").withColumns({c: F.lit("clash") for c in ["item", "part", "whole", "wave"]})
    return docs, items, frame, tests


@pytest.mark.parametrize("wave_words", [1 << 17, 1500])
def test_contamination_matches_brute_force(spark, contaminated, wave_words):
    docs, items, frame, tests = contaminated
    wanted = []
    for d in docs:
        n, hit, names = brute_hits(d[1], items)
        wanted.append((d[0], n, len(hit), len(names), sha(",".join(sorted(names))), bool(hit)))
    assert rows(decontaminate.contamination_report(frame, tests, wave_words=wave_words)) == sorted(wanted, key=str)
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contamination_report(frame, none).where("contaminated or n_items > 0").count() == 0
    assert decontaminate.contamination_report(frame.limit(0), tests).collect() == []


def test_removal_keeps_columns_and_clean_rows(contaminated):
    docs, items, frame, tests = contaminated
    out = decontaminate.remove_overlaps(frame, tests)
    assert out.columns == frame.columns
    kept = [(r["doc_id"], r["text"]) for r in out.collect()]
    shares = [(d[0], d[1], *brute_hits(d[1], items)[:2]) for d in docs]
    assert len(kept) == sum(len(hit) <= n / 2 for _, _, n, hit in shares)
    clean = {(i, t) for i, t, _, hit in shares if not hit}
    assert clean <= set(kept)
    by_id = dict(kept)
    for i, t, n, hit in shares:
        if hit and len(hit) <= n / 2 and i is not None:
            words = decontaminate.words_of(t.encode())
            assert decontaminate.words_of(by_id[i].encode()) == [w for p, w in enumerate(words) if p not in hit]


# Periodic runs -------------------------------------------------------------------------------------------------------


def brute_runs(w, least=6, times=4):
    out = []
    for q in range(1, len(w) // times + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            size = j - i + q
            if j > i and size >= max(least, times * q) and not any(all(w[k] == w[k + p] for k in range(i, i + size - p)) for p in range(1, q)):
                out.append((i, size, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


periodic = st.builds(lambda a, p, n, b: a + p * n + b, *(st.lists(st.sampled_from([b"a", b"b", b"c"]), max_size=k) for k in (6, 5)), st.integers(0, 7), st.lists(st.sampled_from([b"a", b"b"]), max_size=9))


@settings(max_examples=200, deadline=None)
@given(st.lists(periodic, max_size=4), st.sampled_from([(6, 4), (2, 2), (5, 3), (9, 2)]))
def test_runs_match_brute_force(documents, limits):
    found = periodic_runs.runs_of(documents, *limits)
    assert found == [brute_runs(w, *limits) for w in documents]


def test_long_runs_in_one_text():
    assert periodic_runs.runs_of([[b"a"] * 100_000, [], [b"x", b"y", b"z"] * 30_000]) == [[(0, 100_000, 1)], [], [(0, 90_000, 3)]]
    part = [str(i).encode() for i in range(700)]
    assert periodic_runs.runs_of([part * 30 + [b"end"]]) == [[(0, 21_000, 700)]]


def brute_report(doc_id, text):
    w = [x.encode() for x in (text or "").replace("\x0b", " ").replace("\x0c", " ").replace("\t", " ").replace("\n", " ").replace("\r", " ").split(" ") if x]
    if w and doc_id is not None and zlib.crc32(str(doc_id).encode()) % 10 == 0:
        g = zlib.crc32(str(doc_id).encode()) // 10
        a = g % len(w)
        p = 1 + (len(w) - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(len(w))]
    runs = brute_runs(w) if len(w) < 700 else [r for r in periodic_runs.runs_of([w])[0]]
    gone = {k for s, n, q in runs for k in range(s + q, s + n)}
    top = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=None)
    longest = (top[0], top[1], top[2], 1000 * top[1] // top[2]) if top else (None,) * 4
    return (doc_id, len(runs), *longest, sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), hashlib.sha256(b" ".join(x for i, x in enumerate(w) if i not in gone)).hexdigest())


def test_run_report_matches_brute_force(spark, contaminated):
    docs = [*contaminated[0], (80_000, "la " * 9 + "di da " * 5, "en", "s", 0), (80_001, "\x0bé é é é é é\x0c日 本 x", "en", "s", 0), (80_002, "x" * 50_000, "en", "s", 0)]
    frame = spark.createDataFrame(docs, DOCS).repartition(3).withColumns({c: F.lit("clash") for c in CLASH})
    assert rows(periodic_runs.run_report(frame)) == sorted((brute_report(d[0], d[1]) for d in docs), key=str)
    assert periodic_runs.run_report(frame.limit(0)).collect() == []


# Conversation tries --------------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def conversations(spark, sf):
    given_ = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").collect()]
    rnd = random.Random(4)
    deep = [(5000 + c, t, "u", f"same {t}" if t < 40 + c else f"own {c} {t}") for c in range(4) for t in range(60)]
    hot = [(6000, i, "u", "word " * (i % 3)) for i in range(900)]
    copies = [(7000 + c, t, "ua"[t % 2], f"line {t if t < 2 else rnd.randrange(3)}") for c in range(120) for t in range(rnd.randrange(5))]
    odd = [(8000, None, None, None), (8000, None, None, None), (8001, 1, "u", "tie b"), (8001, 1, "u", "tie a"), (8002, 5, "", ""), (8003, -2, "u", "ab"), (8004, -2, "ua", "b"), (None, 1, "u", "lost"), (-21, 0, "u", "é 日本"), (0, 3, None, "again")]
    data = given_ + deep + hot + copies + odd
    rnd.shuffle(data)
    return spark.createDataFrame(data, "conv_id long, turn long, role string, text string").repartition(7)


def expected(frame, folder):
    frame.select("conv_id", "turn", "role", "text").write.parquet(str(folder))
    return sorted(over(queries.SQL["op13_prefix_trie"], conversations=f"{folder}/*.parquet"), key=str)


def test_trie_matches_sql(spark, conversations, tmp_path):
    wanted = expected(conversations, tmp_path / "c")
    clash = conversations.withColumns({c: F.lit("clash") for c in CLASH})
    assert rows(prefix_trie.trie_report(clash)) == wanted
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # more blocks a conversation
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        assert rows(prefix_trie.trie_report(conversations)) == wanted
        assert rows(prefix_trie.prefix_trie(*prefix_trie.grafted_turns(conversations), height=3)) == wanted
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_trie_of_plain_conversations(spark):
    data = [(1, 0, "u", "a b"), (1, 1, "u", "c"), (2, 0, "u", "a b"), (3, 0, "u", "a b"), (3, 1, "u", "d e f"), (4, 0, "u", "a b"), (4, 1, "u", "c")]
    turns = spark.createDataFrame(data, "conv_id long, turn long, role string, text string")
    got = rows(prefix_trie.prefix_trie(*prefix_trie.plain_turns(turns)))
    assert got == [
        (1, 0, None, 4, 1, 2, 7, sha("")),
        (1, 1, 1, 4, 2, 2, 7, sha("2")),
        (1, 2, 1, 2, 0, 1, 1, sha("1,4")),
        (3, 2, 1, 1, 0, 1, 0, sha("3")),
    ]
    assert prefix_trie.trie_report(turns.limit(0)).collect() == []


def test_ends_stream_over_runs(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "RUN", 7)
    turns = spark.createDataFrame([(c, 0, "u", "hi") for c in range(-30, 400, 3)], "conv_id long, turn long, role string, text string")
    got = {r["depth"]: r["ends_sha256"] for r in prefix_trie.prefix_trie(*prefix_trie.plain_turns(turns)).collect()}
    assert got == {0: sha(""), 1: sha(",".join(str(c) for c in range(-30, 400, 3)))}


def test_crc_in_sql():
    con = duckdb.connect()
    for text in ("0", "7", "-15", "1234567890"):
        assert con.execute(f"SELECT {prefix_trie.crc32_sql(repr(text))}").fetchone()[0] == zlib.crc32(text.encode())
