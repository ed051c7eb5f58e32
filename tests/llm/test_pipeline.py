"""The pipeline: each stage against brute force on what the stage before kept."""

from collections import Counter, defaultdict

import numpy as np
import pytest
from shared_rows import ODD
from test_dedup import classes, family, lines_removed, repeated_lines
from test_values import filled, labelled, sizes

import corpus_pipeline
from vantagrid.llm import mixing, pieces, toxicity
from vantagrid.llm.common import Scratch, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def kept(spark, sf_dir):
    """Rows of every stage, by its name, and the folder."""
    rows = [(i, t, f"s{i % 5}") for i, t, _ in labelled(240, 5)]
    rows += [(1000 + i, t, "lines") for i, t in repeated_lines(2)] + [(2000 + i, t, "family") for i, t in enumerate(family(3, 20))]
    rows += [(3000 + (r[0] or 0), r[1], r[2]) for r in ODD if r[0] != 4] + [(4000, "same words in both of these", "s1"), (4001, "same words in both of these", None)]
    rows += [(5000 + k, "\n".join(f"line {j} of a document that stands here three times" for j in range(4)), "s2") for k in range(3)]
    root = sf_dir(rows, [(i, y) for i, _, y in labelled(240, 5)])
    docs, work, out = table(spark, root, "documents"), Scratch(spark, "t"), {"documents": rows}
    for name, stage in corpus_pipeline.STAGES:
        docs = work.keep(stage(spark, docs, root))
        out[name] = docs.collect()
        assert name == corpus_pipeline.STAGES[-1][0] or docs.columns == COLUMNS
    return out, root


def texts(rows):
    return {r.doc_id: r.text for r in rows}


def test_stages_and_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line dedup", "near dedup", "source mix", "pieces"]


def test_toxic_documents_go_and_clean_ones_stay(kept):
    out, _ = kept
    left, bad = texts(out["toxicity"]), {i for i, _, y in labelled(240, 5) if y}
    every = {r[0] for r in out["documents"]}
    assert every - bad <= set(left) and len(bad & set(left)) <= 0.1 * len(bad)
    assert all(left[r[0]] == r[1] for r in out["documents"] if r[0] in left)


def test_toxicity_is_the_models_decision(spark, kept):
    out, root = kept
    docs = table(spark, root, "documents")
    scores = toxicity.scored(docs, toxicity.fit(docs, table(spark, root, "labels"))).collect()
    assert sorted(r.doc_id for r in scores if r.score < 0.7) == sorted(texts(out["toxicity"]))


def test_lines(kept):
    out, _ = kept
    before, after = texts(out["toxicity"]), texts(out["line dedup"])
    want = lines_removed([(i, t) for i, t in before.items() if t is not None])
    # copies of whole documents go with their lines
    want = {i: t for i, t in want.items() if t.strip() or not before[i].strip()}
    assert after == want | {i: None for i, t in before.items() if t is None} and after != before
    assert 5000 in after and 5001 not in after and 5002 not in after
    assert all(r.n_chars == len(r.text) for r in out["line dedup"] if r.text is not None)


def test_one_of_each_group(kept):
    out, _ = kept
    before = texts(out["line dedup"])
    root, _ = classes(before, 4)
    assert texts(out["near dedup"]) == {i: t for i, t in before.items() if root[i] == i}
    assert 4000 in texts(out["near dedup"]) and 4001 not in texts(out["near dedup"])


def test_mix(kept):
    out, _ = kept
    rows = [(r.doc_id, r.text, r.source) for r in out["near dedup"]]
    n = dict(zip([r[0] for r in rows], sizes(rows), strict=True))
    copies = Counter(r.doc_id for r in out["source mix"])
    assert set(copies) <= set(n) and max(copies.values()) <= 2
    names = sorted({r[2] for r in rows}, key=lambda s: (s is None, s or ""))
    total, taken, largest = defaultdict(int), defaultdict(int), defaultdict(int)
    for i, _, s in rows:
        total[s] += n[i]
        taken[s] += n[i] * copies[i]
        largest[s] = max(largest[s], n[i])
    for s, t in zip(names, filled([total[s] for s in names], [mixing.WEIGHTS[k % 3] for k in range(len(names))]), strict=True):
        assert abs(taken[s] - t) <= largest[s] / 2 + 1e-6


def test_pieces_decode_to_the_mix(kept):
    out, _ = kept
    v = pieces.Vocabulary()
    got = Counter((r.doc_id, r.source, v.decode(r.ids)) for r in out["pieces"])
    assert got == Counter((r.doc_id, r.source, r.text) for r in out["source mix"])


def test_run_gives_the_last_stage(spark, kept):
    out, root = kept
    assert Counter((r.doc_id, tuple(r.ids)) for r in corpus_pipeline.run(spark, root).collect()) == Counter((r.doc_id, tuple(r.ids)) for r in out["pieces"])


def test_odd_and_empty_tables(spark, sf_dir):
    assert corpus_pipeline.run(spark, sf_dir([])).count() == 0
    got = corpus_pipeline.run(spark, sf_dir(ODD)).collect()
    assert {r.doc_id for r in got} <= {r[0] for r in ODD} and np.all([len(r.ids) > 0 for r in got])
