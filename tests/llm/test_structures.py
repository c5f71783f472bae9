"""Suffix sorting, FM-index, E8 lattice, windows and components on random small inputs."""

import itertools
import random

import numpy as np
import pytest


def common(a, b):
    n = 0
    while n < len(a) and n < len(b) and a[n] == b[n]:
        n += 1
    return n


@pytest.mark.parametrize("seed", range(3))
def test_suffix_sort_with_recursion_and_spill(seed):
    from martlet.llm.suffix_sort import _Kept, sort_suffixes

    rng = random.Random(seed)
    for _ in range(150):
        sigma = rng.choice([1, 2, 3, 5])
        segs = [[rng.randint(1, sigma) for _ in range(rng.randint(1, 25))] for _ in range(rng.randint(1, 6))]
        segs += segs[:2] if rng.random() < 0.3 else []
        text, suffix = [0], {}
        for s in segs:
            suffix |= {len(text) + i: s[i:] for i in range(len(s))}
            text += [*s, 0]
        kept = _Kept(None)
        sort_suffixes(np.array(text), sigma + 1, kept, base=rng.choice([0, 3, 10 ** 6]),
                      in_memory=rng.choice([1, 5, 10 ** 6]))
        places, lcp = kept.ascending()
        assert sorted(places.tolist()) == sorted(suffix)
        for j in range(1, len(places)):
            a, b = suffix[places[j - 1]], suffix[places[j]]
            assert a <= b and common(a, b) == lcp[j]


def test_matching_statistics():
    from martlet.llm.fm_index import FmIndex

    rng = random.Random(1)
    for _ in range(60):
        sigma = rng.choice([2, 4, 9])
        texts = [[rng.randrange(1, sigma) for _ in range(rng.randint(1, 30))] for _ in range(rng.randint(1, 7))]
        values = np.array([rng.randrange(4) for _ in texts])
        index = FmIndex(np.array([x for t in texts for x in [*t, 0]]), sigma, values)
        got = index.matching_statistics(np.array([x for t in texts for x in t]),
                                        np.cumsum([len(t) for t in texts]), values)
        want = [max(common(t[i:], o[j:]) if v < values[k] else 0 for o, v in zip(texts, values) for j in range(len(o)))
                for k, t in enumerate(texts) for i in range(len(t))]
        assert got.tolist() == want


def test_lattice_points_are_nearest():
    from martlet.llm.lattice import STEPS, nearest

    assert len(STEPS) == 240 and np.allclose(np.square(STEPS).sum(1), 2)
    x = np.random.default_rng(0).uniform(-2, 2, (500, 8))
    p = nearest(x)
    doubled = np.rint(2 * p).astype(int)
    assert ((doubled % 2 == doubled[:, :1] % 2).all()) and (np.rint(p.sum(1)).astype(int) % 2 == 0).all()
    distance = np.square(x - p).sum(1)
    assert distance.max() <= 1 + 1e-9  # the covering radius
    for step in STEPS:
        assert (distance <= np.square(x - p - step).sum(1) + 1e-9).all()


def test_equal_windows_have_equal_anchors():
    from martlet.llm.repeats import BYTES_200, WORDS_50, anchors

    rng = random.Random(2)
    for spec, unit in ((BYTES_200, ""), (WORDS_50, " ")):
        word = lambda: "".join(rng.choice("abcd") for _ in range(rng.randint(1, 5)))
        passage = unit.join(word() for _ in range(300))
        docs = [unit.join([*(word() for _ in range(n)), passage, word()]).encode() for n in (0, 7, 90)]
        data = np.frombuffer(b"".join(docs), np.uint8)
        starts, ends, first, h = spec.units(data, np.concatenate(([0], np.cumsum([len(d) for d in docs]))))
        doc, lo, nw, ao, g, _, times = anchors(h, first, spec)
        assert (times == 1).all()
        assert [nw[doc == k].sum() for k in range(3)] == [max(n - spec.width + 1, 0) for n in np.diff(first)]
        key = {}
        raw = data.tobytes()
        for d, a, n, o, gram in zip(doc, lo, nw, ao, g):
            for k in range(n):
                p = first[d] + a + k
                content = (raw[starts[p]:ends[p + spec.width - 1]] if spec.by_words else raw[p:p + spec.width])
                assert key.setdefault(content, (gram, o - k)) == (gram, o - k)


def test_word_views_match_a_regex():
    import re

    import pyarrow as pa

    from martlet.llm.texts import chunks, word_hashes, words

    texts = ["a bc  d", None, "", " ", "é\x0bx", "no-break space", "bc", "x" * 5000]
    got, seen = [], {}
    for rows, data, offsets in chunks(pa.array(texts), 6):
        starts, ends, first = words(data, offsets)
        raw = data.tobytes()
        found = [raw[a:b].decode() for a, b in zip(starts, ends)]
        for w, h in zip(found, word_hashes(data, starts, ends).tolist()):
            assert seen.setdefault(w, h) == h
        got += [found[a:b] for a, b in zip(first[:-1], first[1:])]
    assert got == [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    assert len(set(seen.values())) == len(seen)


def test_components(spark):
    from martlet.llm.components import components

    rng = random.Random(4)
    links = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(i, i + 1) for i in range(100, 140)]
    parent = {x: x for p in links for x in p}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    df = spark.createDataFrame([*links, (None, 1), (5, None)], "u long, v long")
    got = {r.node: r.component for r in components(df).collect()}
    linked = {x for a, b in links if a != b for x in (a, b)}
    assert got == {x: find(x) for x in linked}
    assert components(df.limit(0)).count() == 0


def test_prob_minhash_estimates_probability_jaccard():
    from martlet.llm.near_documents import REGISTERS, prob_minhash

    rng = np.random.default_rng(0)
    agree, want = [], []
    for _ in range(60):
        values = rng.integers(1, 1 << 62, 50).astype(np.uint64)
        wa, wb = rng.uniform(0.5, 3, 50), rng.uniform(0.5, 3, 50)
        wa[:10], wb[40:] = 0, 0
        a, b = wa > 0, wb > 0
        sig = prob_minhash(np.repeat([0, 1], [a.sum(), b.sum()]), np.concatenate((values[a], values[b])),
                           np.concatenate((wa[a], wb[b])), 2)
        agree.append((sig[0] == sig[1]).mean())
        both = np.flatnonzero(a & b)
        want.append(sum(1 / np.maximum(wa / wa[i], wb / wb[i]).sum() for i in both))
    assert abs(np.mean(agree) - np.mean(want)) < 4 * 0.5 / np.sqrt(60 * REGISTERS)
    assert (prob_minhash(np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0), 2) == 0).all()


def test_pair_table_holds_all_pairs():
    from martlet.llm.bpe import NONE, PairTable

    rng = np.random.default_rng(1)
    pairs = np.unique(rng.integers(0, 3000, (20000, 2)), axis=0)
    table = PairTable(pairs[:, 0], pairs[:, 1], np.arange(len(pairs)))
    assert (table.find(pairs[:, 0], pairs[:, 1]) == np.arange(len(pairs))).all()
    known = {tuple(p) for p in pairs.tolist()}
    probe = rng.integers(-1, 3000, (5000, 2))
    got = table.find(probe[:, 0], probe[:, 1])
    assert all((g != NONE) == (tuple(p) in known) for g, p in zip(got, probe.tolist()))


def test_union_of_spans():
    from martlet.llm.repeats import union_of_spans

    rng = random.Random(6)
    for _ in range(100):
        spans = [(a, a + rng.randint(1, 6)) for a in (rng.randrange(40) for _ in range(rng.randint(0, 8)))]
        covered = {x for a, b in spans for x in range(a, b)}
        got = union_of_spans(spans)
        assert {x for a, b in got for x in range(a, b)} == covered
        assert all(x[1] < y[0] for x, y in itertools.pairwise(got))


def test_a_stored_table_sends_texts_to_workers_in_small_batches(spark):
    import pyarrow as pa

    from martlet.llm.common import ARROW_ROWS, stored

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows])], ["n"])

    before = spark.conf.get(ARROW_ROWS)
    table = spark.range(0, 1000, 1, 1).mapInArrow(sizes, "n long")
    got = [r.n for r in stored(table, "sizes", 300).collect()]
    assert sum(got) == 1000 and max(got) == 300
    assert spark.conf.get(ARROW_ROWS) == before
