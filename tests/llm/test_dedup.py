"""Near, suffix and line dedup against brute force over whole small tables."""

import hashlib
import re

import numpy as np
import pytest
from shared_rows import ODD, SMALL

from hypothesis import given, settings
from hypothesis import strategies as st

from vantagrid.llm import components, hashing, lines, neardup, oracle, queries, suffixes
from vantagrid.llm.common import Scratch
from vantagrid.llm.hashing import Digests, exact_shingle_sets, shingle_sets


def shingles(text, size):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))) if words else frozenset()


def classes(texts, size):
    """Least reachable id of every id, by comparing all pairs."""
    ids = sorted(i for i in texts if i is not None)
    sets, root = {i: shingles(texts[i], size) for i in ids}, {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= 80 * (len(sets[a]) + len(sets[b]) - common):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: find(i) for i in ids}, {i: len(s) for i, s in sets.items()}


def family(seed, n, words=120, edits=12):
    """Copies of one text with ever more words changed, some of them on both sides of the limit."""
    draw = np.random.default_rng(seed)
    base = [f"w{v}" for v in draw.integers(0, 10**6, words)]
    out = []
    for k in range(n):
        own = list(base)
        for at in draw.integers(0, words, k % edits):
            own[at] = f"e{draw.integers(10**6)}"
        out.append(" ".join(own))
    return out


def test_near_dedup_of_whole_table(spark, corpus):
    got = {r.doc_id: (r.component_id, r.n_shingles, r.kept) for r in queries.op5_near_dedup(spark, SMALL).collect()}
    root, size = classes(corpus, 4)
    assert got == {i: (root[i], size[i], root[i] == i) for i in corpus}


@pytest.mark.parametrize("name", sorted(oracle.ORACLE_SQL))
def test_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SMALL}/documents.parquet'")
    df = queries.QUERIES[name](spark, SMALL)
    result = con.execute(oracle.ORACLE_SQL[name])
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert sorted(tuple(r[c] for c in columns) for r in df.collect()) == sorted(result.fetchall())


@pytest.mark.parametrize("block", [256, 8])
def test_near_dedup_of_families(spark, documents, monkeypatch, block):
    monkeypatch.setattr(neardup, "BLOCK", block)
    texts = dict(enumerate([*family(1, 40), *family(2, 25, words=30, edits=5), "same text here", "same text here", "", None, " \n"]))
    root, _ = classes(texts, 5)
    got = {r.doc_id: r.component_id for r in neardup.near_duplicates(documents(list(texts.items()))).collect()}
    assert got == root
    kept = neardup.representatives(documents(list(texts.items())).selectExpr("*", "1 AS component_id", "2 AS id"))
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i in root if root[i] == i) and "component_id" in kept.columns


def test_near_dedup_of_odd_rows(spark, documents, sf_dir):
    rows = neardup.near_duplicates(documents(ODD)).collect()
    assert len(rows) == len(ODD)
    got = {r.doc_id: (r.component_id, r.n_shingles) for r in rows}
    assert got[1] == (1, 0) and got[2] == (2, 0) and got[3] == (3, 0) and got[4] == (4, 2) and got[5] == (4, 2) and got[None][0] is None
    assert neardup.near_duplicates(documents([])).count() == 0
    assert queries.op5_near_dedup(spark, sf_dir([])).count() == 0


def test_sketch_estimates_hold():
    draw = np.random.default_rng(5)
    for similar, below in ((0.8, True), (0.5, False)):
        misses = 0
        for _ in range(60):
            n = 600
            common = int(round(n * 2 * similar / (1 + similar)))
            a = draw.integers(0, 2**63, n, dtype=np.uint64)
            b = np.concatenate([a[:common], draw.integers(0, 2**63, n - common, dtype=np.uint64)])
            s = neardup.odd_sketches(np.array([neardup.minhash(a), neardup.minhash(b)]))
            misses += (int(np.bitwise_count(s[0] ^ s[1]).sum()) <= neardup.most_bits(0.8)) != below
        assert misses == 0


def test_shingles_are_those_of_the_definition():
    texts = ["A b\tC d e", "a", "a b c", "", "é É x y z w", "a b c d a b c d a b c d"]
    got = shingle_sets([t.encode() for t in texts], 4, Digests())
    assert [len(s) for s in got] == [len(shingles(t, 4)) for t in texts]
    assert got[0].tolist() == shingle_sets([b"a B c D E"], 4, Digests())[0].tolist()


@settings(max_examples=80, deadline=None)
@given(st.lists(st.text(alphabet="abA \t\n", max_size=24), min_size=1, max_size=6), st.integers(1, 5))
def test_exact_shingles_meet_where_the_words_do(texts, size):
    want = [shingles(t, size) for t in texts]
    for got in (exact_shingle_sets([t.encode() for t in texts], size), shingle_sets([t.encode() for t in texts], size, Digests())):
        assert [len(s) for s in got] == [len(s) for s in want]
        for a, x in zip(got, want, strict=True):
            assert [len(np.intersect1d(a, b)) for b in got] == [len(x & y) for y in want]


def test_words_are_cut_alike_in_pieces(monkeypatch):
    text = b" Aa  b\tcc " * 40 + b"x" * 100
    whole = exact_shingle_sets([text], 4)[0]
    monkeypatch.setattr(hashing, "CHUNK", 7)
    assert exact_shingle_sets([text], 4)[0].tolist() == whole.tolist() and len(hashing.Digests().of(text)) == 121


def texts_by_row(rows, size):
    """Component of every (id, text), by all pairs of texts, where rows of one id are one document."""
    root, _ = classes(dict(enumerate(t for _, t in rows)), size)
    joined = components_of([(k, root[k]) for k in root] + [(a, b) for a, (i, _) in enumerate(rows) for b, (j, _) in enumerate(rows) if i == j and a < b])
    least = {}
    for k, (i, _) in enumerate(rows):
        least[joined[k]] = min(i, least.get(joined[k], i))
    return sorted((i, least[joined[k]]) for k, (i, _) in enumerate(rows))


def components_of(edges):
    root = {x: x for e in edges for x in e}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    return {i: find(i) for i in root}


def test_near_dedup_of_documents_with_several_texts(spark, documents):
    one, two, other = (" ".join(f"{c}{k}" for k in range(30)) for c in "abc")
    rows = [(3, one), (7, one), (7, two), (9, two), (11, ""), (11, other), (12, other), (12, other), (20, " ")]
    got = sorted((r.doc_id, r.component_id) for r in neardup.near_duplicates(documents(rows)).collect())
    assert got == texts_by_row(rows, 5) == [(3, 3), (7, 3), (7, 3), (9, 3), (11, 11), (11, 11), (12, 11), (12, 11), (20, 20)]
    kept = lambda rows: sorted((r.doc_id, r.text) for r in neardup.representatives(documents(rows).selectExpr("*", "1 AS DID_0", "2 AS mark_0")).collect())
    assert kept([(3, one), (7, one), (7, two), (8, other)]) == [(3, one), (7, two), (8, other)]
    assert kept([*rows, (12, two + " x"), (1, two), (1, two)]) == [(1, two), (3, one), (11, ""), (11, other), (20, " ")]


def test_unlike_words_are_never_linked(spark, documents):
    # sequences on which polynomials modulo a power of two collide
    morse = "".join("ab"[bin(k).count("1") % 2] for k in range(4096))
    flipped = morse.translate(str.maketrans("ab", "ba"))
    rows = [(1, " ".join([morse] * 3)), (2, " ".join([flipped] * 3)), (3, morse + " " + flipped), (4, flipped + " " + morse)]
    got = {r.doc_id: (r.component_id, r.n_shingles) for r in neardup.near_duplicates(documents(rows), shingle=1).collect()}
    assert got == {1: (1, 1), 2: (2, 1), 3: (3, 2), 4: (3, 2)}


def test_components(spark):
    draw = np.random.default_rng(2)
    edges = [(int(a), int(b)) for a, b in draw.integers(0, 300, (220, 2))] + [(k, k + 1) for k in range(1000, 1060)] + [(2000, k) for k in range(2001, 2100)]
    root = {x: x for e in edges for x in e}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    got = components.components(spark.createDataFrame(edges, "u long, v long"), Scratch(spark, "t"))
    assert {r.id: r.component for r in got.collect()} == {i: find(i) for i in {x for a, b in edges if a != b for x in (a, b)}}
    assert components.components(spark.createDataFrame([], "u long, v long"), Scratch(spark, "t")).count() == 0


def repeats_removed(rows, window=100):
    """(id, text) in order to (bytes, removed, spans, digest)."""
    seen, out = set(), []
    for i, text in rows:
        data = (text or "").encode()
        gone = np.zeros(len(data), bool)
        for s in range(len(data) - window + 1):
            w = data[s : s + window]
            if w in seen:
                gone[s : s + window] = True
            seen.add(w)
        spans = int((gone & ~np.concatenate([[False], gone[:-1]])).sum()) if len(data) else 0
        kept = bytes(np.frombuffer(data, np.uint8)[~gone])
        out.append((i, len(data), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def test_suffix_dedup_of_whole_table(spark, corpus):
    got = sorted(tuple(r) for r in queries.op9_suffix_dedup(spark, SMALL).collect())
    assert got == repeats_removed(sorted(corpus.items()))


@pytest.mark.parametrize("hot,held,block,sampled", [(256, 1 << 21, 1 << 19, 1 / 16), (0, 50, 300, 1.0), (2, 1 << 21, 128, 1.0)])
def test_suffix_dedup_of_hard_texts(spark, sf_dir, monkeypatch, hot, held, block, sampled):
    monkeypatch.setattr(suffixes, "HOT", hot)
    monkeypatch.setattr(suffixes, "SAMPLED", sampled)
    monkeypatch.setattr(suffixes, "FILLED", 0.0)
    monkeypatch.setattr(suffixes, "HELD", held)
    monkeypatch.setattr(suffixes, "BLOCK", block)
    draw = np.random.default_rng(4)
    passage = "".join(draw.choice(list("abcdef éü"), 400))
    texts = ["".join(draw.choice(list("abc "), 150)) + passage[draw.integers(0, 90) : draw.integers(250, 400)] + "".join(draw.choice(list("xyz"), 60)) for _ in range(30)]
    texts += ["a" * 500, "a" * 99, "a" * 100, "ab" * 300, passage, passage, None, "", "é" * 130]
    for k in range(12):
        edited = list(passage * 2)
        for at in draw.integers(0, 800, k):
            edited[at] = "#"
        texts.append("".join(edited))
    rows = list(enumerate(texts))
    got = sorted(tuple(r) for r in queries.op9_suffix_dedup(spark, sf_dir(rows)).collect())
    assert got == repeats_removed(rows)


def test_suffix_dedup_of_odd_rows(spark, documents):
    rows = suffixes.without_repeats(documents(ODD).selectExpr("*", "1 AS id", "2 AS mark", "3 AS spans")).collect()
    assert len(rows) == len(ODD) and sum(r.doc_id is None for r in rows) == 1
    twice = [r for r in rows if r.doc_id == 4]
    assert twice[0].kept == twice[1].kept == b"one two three four five six"
    assert suffixes.without_repeats(documents([])).count() == 0


def test_suffix_dedup_of_repeated_rows(spark, sf_dir):
    draw = np.random.default_rng(8)
    make = lambda n: "".join(draw.choice(list("abcdefgh "), n))
    passage = make(442)
    a, b, c = make(150) + passage + make(80), make(60) + passage[20:] + make(300), make(90) + passage[:300]
    rows = [(4, a), (4, a), (5, b), (5, b), (5, b), (6, c), (7, a), (8, b), (8, c), (8, c)]
    got = sorted(tuple(r) for r in queries.op9_suffix_dedup(spark, sf_dir(rows)).collect())
    # rows of one id stand in the order of their texts' hashes
    frame = spark.createDataFrame(sorted(set(rows)), "id long, text string").selectExpr("id", "text", "xxhash64(text) AS mark")
    once = [(r.id, r.text) for r in sorted(frame.collect(), key=lambda r: (r.id, r.mark))]
    want = dict(zip(once, repeats_removed(once), strict=True))
    assert got == sorted(want[r] for r in rows)
    assert [r[2] for r in got if r[0] == 4] == [0, 0]


def chunked(text):
    lines = text.split("\n")
    hashes = [int(hashlib.md5(x.encode()).hexdigest()[:8], 16) for x in lines]
    out, own = [], []
    for k, x in enumerate(lines):
        own.append(x)
        if k + 1 == len(lines) or hashes[k] % 2 == 0 or hashes[k + 1] // 8 % 2 == 0:
            out.append("\n".join(own))
            own = []
    return out


def lines_removed(rows):
    """Texts without chunks that an earlier text, or place of the text, has too, alone or with the chunk behind them."""
    seen, out = set(), {}
    for i, text in sorted(rows):
        own, gone = chunked(text), set()
        for wide in (1, 2):
            for k in range(len(own) - wide + 1):
                unit = "\n".join(own[k : k + wide])
                if sum(bool(x.strip(" \t\r\f\v")) for x in unit.split("\n")) >= 2:
                    if unit in seen:
                        gone.update(range(k, k + wide))
                    seen.add(unit)
        out[i] = "\n".join(c for k, c in enumerate(own) if k not in gone)
    return out


def repeated_runs(rows):
    """(words, words gone) of each run of two or more lines, none blank, of over 50 words that an earlier other text has as well."""
    kept, seen, out = lines_removed(rows), {}, []
    for i, text in sorted(rows):
        lines, k = text.split("\n"), 0
        while k + 1 < len(lines):
            best = 0
            for j, at in seen.get((lines[k], lines[k + 1]), ()):
                n = 0
                while k + n < len(lines) and at + n < len(j) and lines[k + n] == j[at + n] and lines[k + n].strip():
                    n += 1
                best = max(best, n)
            words = sum(len(x.split()) for x in lines[k : k + best])
            if best >= 2 and words > 50:
                left = kept[i].split("\n")
                out.append((words, sum(len(x.split()) for x in lines[k : k + best] if x not in left)))
            k += max(best, 1)
        for k in range(len(lines) - 1):
            if lines[k].strip() and lines[k + 1].strip():
                seen.setdefault((lines[k], lines[k + 1]), []).append((lines, k))
    return out


def repeated_lines(seed):
    draw = np.random.default_rng(seed)
    pool = [f"line {k} of many" for k in range(60)] + ["", " "]
    blocks = [[pool[j] for j in draw.integers(0, len(pool), 12)] for _ in range(4)]
    out = []
    for k in range(30):
        own = [pool[j] for j in draw.integers(0, len(pool), 5)] + blocks[k % 4] + [f"tail {k}"]
        out.append((k, "\n".join(own)))
    return out


@pytest.mark.parametrize("key_bits", [64, 2])
def test_line_dedup(spark, documents, key_bits):
    rows = repeated_lines(1)
    got = {r.doc_id: r.text for r in lines.deduplicated(documents(rows), key_bits).collect()}
    want = lines_removed(rows)
    assert got == want and any(len(want[i]) < len(t) for i, t in rows)


def test_line_dedup_of_whole_table(spark, corpus):
    got = {r.doc_id: r.kept_sha256 for r in queries.op10_line_dedup(spark, SMALL).collect()}
    assert got == {i: hashlib.sha256(t.encode()).hexdigest() for i, t in lines_removed(corpus.items()).items()}


def test_repeated_passages_of_lines_mostly_go():
    found = []
    for seed in range(40):
        draw = np.random.default_rng(seed)
        line = lambda: " ".join(f"w{v}" for v in draw.integers(0, 10**6, 30))
        passage = [line() for _ in range(2 + seed % 5)]
        found += repeated_runs([(k, "\n".join([line(), line(), *passage, line(), line()])) for k in range(3)])
    assert len(found) == 80 and sum(g for _, g in found) > 0.75 * sum(w for w, _ in found)


def test_line_dedup_of_odd_rows(spark, documents):
    docs = documents([*ODD, (8, "\n\n\n\n"), (9, "\n\n\n\n")]).selectExpr("*", "1 AS key", "2 AS chunk", "3 AS mark", "4 AS at", "5 AS __vg_id", "6 AS id_0", "7 AS mark_0", "8 AS Told_0")
    out = lines.deduplicated(docs)
    assert out.columns == [*docs.columns, "__vg"]
    assert sorted((str(r.doc_id), r.text) for r in out.select("doc_id", "text").collect() if r.text) == sorted((str(r.doc_id), r.text) for r in docs.select("doc_id", "text").collect() if r.text)
    assert out.count() == len(ODD) + 2 and lines.deduplicated(documents([])).count() == 0
