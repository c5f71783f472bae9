"""Classifier, near-duplicate operators and the pipeline."""

import collections
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from llm_helpers import corpus

SF = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_classifier_on_held_out_labels(spark):
    from martlet.llm.classifier import op1_quality_classifier

    scores = {r.doc_id: r for r in op1_quality_classifier(spark, SF).collect()}
    assert len(scores) == spark.read.parquet(f"{SF}/documents.parquet").count()
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    held = [(labels[k], r.score, r.predicted) for k, r in scores.items() if r.held_out and k in labels]
    good, bad = [s for y, s, _ in held if y], [s for y, s, _ in held if not y]
    assert len(bad) >= 5 and np.mean([g > b for g in good for b in bad]) > 0.97
    assert np.mean([y == p for y, _, p in held]) > 0.95


def test_classifier_edges(spark, docs, no_docs):
    from martlet.llm.classifier import document_vectors, fit, keep_good, score

    labels = spark.createDataFrame(
        [(k, int(k % 2), 0) for k in range(0, 40)] + [(None, 1, 0), (3, None, 0), (3, 1, 0)],
        "doc_id long, quality int, toxic int")
    known = document_vectors(docs)
    out = score(known, fit(known, labels)).collect()
    assert len(out) == len(corpus()) and all(0 <= r.score <= 1 for r in out)
    by_id = collections.defaultdict(set)
    for r in out:
        by_id[r.doc_id].add(r.score)
    assert len(by_id[7]) == 1  # repeated rows score alike
    one_class = fit(known, labels.filter("quality = 1"))
    assert one_class.means is None and all(r.score > 0.5 for r in score(known, one_class).collect())
    assert {r.score for r in score(known, fit(known, labels.limit(0))).collect()} == {0.5}
    nothing = document_vectors(no_docs)
    assert score(nothing, fit(nothing, labels)).count() == 0
    kept = keep_good(docs, labels.limit(0))
    assert kept.columns == docs.columns and kept.count() == len(corpus())


def test_labels_and_ids_are_no_inputs(spark, docs):
    from pyspark.sql import functions as F

    from martlet.llm.classifier import document_vectors

    a = {tuple(r.x) for r in document_vectors(docs).collect()}
    b = {tuple(r.x) for r in document_vectors(
        docs.withColumn("doc_id", -F.col("doc_id")).withColumn("lang", F.lit("xx"))).collect()}
    assert a == b


def brute_similarity(a, b):
    """Probability Jaccard of two weighted sets, from its definition."""
    every = a.keys() | b.keys()
    return sum(1 / sum(max(a.get(j, 0) / a[i], b.get(j, 0) / b[i]) for j in every) for i in a.keys() & b.keys())


def brute_classes(rows):
    sets = {}
    for k, text in rows:
        w = WORD.findall(text or "")
        n = collections.Counter(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else {("", text or ""): 1}
        sets[k] = {x: 1 + np.log(c) for x, c in n.items()}
    parent = {k: k for k in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in sets:
        for b in sets:
            # a similarity of 0.8 needs many common elements; the full sum is for the few pairs that have some
            common = len(sets[a].keys() & sets[b].keys())
            if a < b and common and brute_similarity(sets[a], sets[b]) >= 0.8:
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {k: find(k) for k in sets}


def test_near_documents_match_brute_force(spark, docs):
    from martlet.llm.near_documents import classify, keep_one

    out = classify(docs).collect()
    assert len(out) == len(corpus())
    want = brute_classes([(k, t) for k, t, *_ in corpus() if k is not None])
    assert {r.id: r.class_id for r in out if r.id < 1 << 62} == want
    base = next(t for k, t, *_ in corpus() if k == 300)
    kept = keep_one(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(x for x in ids if x is not None) == sorted(k for k, c in want.items() if k == c)
    assert sum(x is None for x in ids) == 2  # two texts without an id are near no other
    assert sum(r.text == base for r in kept.collect()) <= 1


def test_near_documents_chain_links(spark):
    """A class held together by neighbours only: each text is close to the next, not to the first."""
    from martlet.llm.near_documents import classify

    rng = random.Random(8)
    words = [f"w{i}" for i in range(100)]
    rows = []
    for i in range(12):
        rows.append((i, " ".join(words)))
        at = rng.randrange(len(words))
        words[at] = f"n{i}"
    got = {r.id: r.class_id for r in classify(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute_classes(rows)


def test_near_documents_with_repeated_passages(spark):
    """Repeats weigh: candidates and links follow the same weighted similarity, on both sides of 0.8."""
    from martlet.llm.near_documents import classify

    rng = random.Random(21)
    rows = []
    for i in range(30):
        x, y = ([f"w{rng.randrange(10**6)}" for _ in range(50)] for _ in range(2))
        rows += [(2 * i, " ".join(x + y)), (2 * i + 1, " ".join(x + y * (1 + i % 6)))]
    got = {r.id: r.class_id for r in classify(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute_classes(rows)
    assert len(set(got.values())) not in (30, 60)  # some pairs are near, some are not


def test_weighted_similarity_matches_its_definition():
    from martlet.llm.near_documents import probability_jaccard

    rng = np.random.default_rng(4)
    for _ in range(200):
        a = {int(k): float(w) for k, w in zip(rng.choice(30, rng.integers(1, 20), replace=False), rng.uniform(0.5, 4, 20))}
        b = {int(k): float(w) for k, w in zip(rng.choice(30, rng.integers(1, 20), replace=False), rng.uniform(0.5, 4, 20))}
        pick = lambda d: (np.array(sorted(d), np.uint64), np.array([d[k] for k in sorted(d)]))
        assert probability_jaccard(*pick(a), *pick(b)) == pytest.approx(brute_similarity(a, b))


def test_recall_on_near_copies(spark):
    """Copies with a few words changed, at every similarity from 0.8 up: each is found."""
    from martlet.llm.near_documents import classify

    rng = random.Random(33)
    rows = []
    for i in range(120):
        w = [f"w{rng.randrange(10**6)}" for _ in range(rng.choice([60, 200, 700]))]
        copy, want = list(w), rng.uniform(0.8, 0.99)
        while True:  # change words until one more would fall under the wanted similarity
            at = rng.randrange(len(copy))
            was, copy[at] = copy[at], f"n{rng.randrange(10**6)}"
            a, b = ({tuple(x[k:k + 5]) for k in range(len(x) - 4)} for x in (w, copy))
            if len(a & b) < want * len(a | b):
                copy[at] = was
                break
        rows += [(2 * i, " ".join(w)), (2 * i + 1, " ".join(copy))]
    got = {r.id: r.class_id for r in classify(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert sum(got[2 * i + 1] == 2 * i for i in range(120)) == 120


def test_of_equal_rows_the_first_by_its_other_columns_stays(spark):
    from martlet.llm.near_documents import keep_one

    rows = [(1, "a b c d e f", "x"), (1, "a b c d e f", None), (1, "a b c d e f", "a"), (2, "other text", "z")]
    for parts in (1, 4):
        kept = keep_one(spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(parts)).collect()
        assert sorted(tuple(r) for r in kept) == [(1, "a b c d e f", "a"), (2, "other text", "z")]


def brute_links(rows):
    ok = [(k, v) for k, v in rows if k is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    n, parent = collections.Counter(), {k: k for k, _ in ok}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, v) in enumerate(ok):
        for b, w in ok[i + 1:]:
            if len(v) == len(w):
                x, y = np.array(v, float), np.array(w, float)
                x, y = x / np.abs(x).max(), y / np.abs(y).max()
                if x @ y / np.sqrt((x @ x) * (y @ y)) >= 0.95:
                    n[a] += 1
                    n[b] += 1
                    p, q = find(a), find(b)
                    parent[max(p, q)] = min(p, q)
    return {k: (n[k], find(k)) for k, _ in ok}


@pytest.mark.parametrize("shape, block", [(None, 2000), (None, 16), ({"blocks": 2, "tables": 12, "probes": 4}, 50)])
def test_vector_links_match_brute_force(spark, shape, block):
    from pyspark.sql import functions as F

    from martlet.llm.near_vectors import link_vectors

    rng = np.random.default_rng(5)
    centers = rng.standard_normal((30, 64))
    x = [c + rng.standard_normal(64) * rng.choice([0.02, 0.1, 0.2]) for c in centers for _ in range(6)]
    x += [centers[0] + rng.standard_normal(64) * 0.05 for _ in range(60)]
    rows = [(i, [float(np.float32(a)) for a in v]) for i, v in enumerate(x)]
    rows += [(1000, None), (1001, [0.0] * 64), (1002, [1.0] * 63 + [None]), (1003, [float("nan")] * 64),
             (1004, [float("inf")] + [1.0] * 63), (1005, []), (None, rows[3][1]), (1006, rows[3][1]), (1007, rows[3][1]),
             (1008, [2.0 * a for a in rows[3][1]]), (1009, [1.0, 2.0]), (1010, [2.0, 4.0]), (1011, [1e-30] * 64),
             (1012, [1e30] * 64)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("keys", F.lit(1)).withColumn("id", F.lit(2))
    got = link_vectors(df, shape=shape, block=block).collect()
    assert len(got) == len(rows)
    want = brute_links([(r.vec_id, r.embedding) for r in df.collect()])
    have = {r.vec_id: (r.n_links, r.component_id) for r in got if r.vec_id in want}
    missed = sum(have[k] != v for k, v in want.items())
    assert missed <= (0 if shape is None else 0.1 * len(want))
    for r in got:
        if r.vec_id not in want:
            assert r.n_links == 0 and r.component_id == r.vec_id
        assert r.kept == (r.vec_id is not None and r.vec_id == r.component_id)
    assert link_vectors(df.limit(0)).count() == 0


def test_vectors_of_two_lengths_match_brute_force(spark):
    """Half 64, half 32 components: no length takes another's links."""
    from martlet.llm.near_vectors import link_vectors

    rng = np.random.default_rng(11)
    rows = []
    for d in (64, 32):
        for c in rng.standard_normal((40, d)):
            rows += [(len(rows) + k, [float(np.float32(a)) for a in c + rng.standard_normal(d) * 0.05]) for k in range(8)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = {r.vec_id: (r.n_links, r.component_id) for r in link_vectors(df).collect()}
    assert got == brute_links(rows)


def test_cells_of_two_lengths_differ():
    from martlet.llm.lattice import Tables

    rng = np.random.default_rng(3)
    cells = []
    for d in (64, 63, 32):
        x = rng.standard_normal((5000, d))
        cells.append(np.unique(Tables(d, 4, 1, 5.0, 2).keys(x / np.linalg.norm(x, axis=1, keepdims=True))))
    assert len(np.unique(np.concatenate(cells))) == sum(map(len, cells))


def test_pipeline_stages(spark, tmp_dir):
    import corpus_pipeline as cp

    assert [n for n, _ in cp.STAGES] == ["quality classifier", "near dedup", "suffix dedup", "secret scan", "packing"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    states = [docs]
    for i, (_, stage) in enumerate(cp.STAGES):
        stage(spark, states[-1], SF).write.parquet(f"{tmp_dir}/{i}")
        states.append(spark.read.parquet(f"{tmp_dir}/{i}"))
    for s in states[1:5]:
        assert s.columns == docs.columns
    # 1: held-out clean documents stay, rejected ones go
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    first = {r.doc_id for r in states[1].collect()}
    assert np.mean([k in first for k, y in labels.items() if y]) > 0.97
    assert np.mean([k in first for k, y in labels.items() if not y]) < 0.05
    # 2: the least of each class stays
    classes = brute_classes([(k, texts[k]) for k in first])
    assert {r.doc_id for r in states[2].collect()} == {k for k, c in classes.items() if k == c}
    # 3: exactly the bytes outside repeated 200-byte strings stay
    before = {r.doc_id: r.text.encode() for r in states[2].collect()}
    seen = collections.Counter(x[i:i + 200] for x in before.values() for i in range(len(x) - 199))
    for r in states[3].collect():
        x = before[r.doc_id]
        gone = bytearray(len(x))
        for i in range(len(x) - 199):
            if seen[x[i:i + 200]] > 1:
                gone[i:i + 200] = b"\1" * 200
        assert r.text == bytes(c for c, g in zip(x, gone) if not g).decode("utf-8", "ignore")
        assert r.n_chars == len(r.text)
    # 4: no secret is left, other texts are as they were
    third = {r.doc_id: r.text for r in states[3].collect()}
    for r in states[4].collect():
        assert not re.search(r"[0-9a-f]{32}|AKIA[A-Z0-9]{12}", r.text)
        assert r.text == third[r.doc_id] or "[REDACTED]" in r.text
    # 5: every document that is left is packed
    assert {r.doc_id for r in states[5].collect()} == {r.doc_id for r in states[4].collect()}


def test_queries_are_registered():
    import __spark_entry__ as entry

    names = set(entry.queries())
    assert {f"op{n}" for n in range(1, 14)} <= {n.split("_")[0] for n in names} and "pipeline" in names
