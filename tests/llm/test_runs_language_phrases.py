"""Periodic runs, language identification and collocations against brute force."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from llm_helpers import corpus, sentence

SF = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def runs_by_hand(s, least_words=6, least_times=4):
    n, out = len(s), set()
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if s[i] != s[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and s[j] == s[j + q]:
                j += 1
            part = s[i:j + q]
            smaller = any(all(part[k] == part[k + p] for k in range(len(part) - p)) for p in range(1, q))
            if len(part) >= max(least_words, least_times * q) and not smaller:
                out.add((i, len(part), q))
            i = j
    return sorted(out)


def test_runs_of_random_sequences():
    from martlet.llm.periodic_runs import runs_of_sequence, stretches

    rng = random.Random(1)
    for _ in range(2500):
        n, k = rng.randrange(0, 60), rng.choice([1, 2, 2, 3, 4])
        s = [rng.randrange(k) for _ in range(n)]
        if rng.random() < 0.5 and n:
            a, p = rng.randrange(n), rng.randrange(1, 8)
            s = [s[i] if i < a else s[min(a + (i - a) % p, n - 1)] for i in range(n)]
        for least in ((6, 4), (2, 2)):
            assert runs_of_sequence(s, *least) == runs_by_hand(s, *least), s
        # the sieve loses no run and lets none be cut
        lo, hi = stretches(np.array([x * 7919 + 1 for x in s], np.uint64), np.array([0, n]))
        assert sorted((a, m, q) for x, y in zip(lo.tolist(), hi.tolist())
                      for a, m, q in [(x + a, m, q) for a, m, q in runs_of_sequence(s[x:y])]) == runs_by_hand(s)


def rewritten(doc_id, ws):
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    n, g = len(ws), h // 10
    if h % 10 or not n:
        return ws
    a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
    return [w if i < a else ws[a + (i - a) % p] for i, w in enumerate(ws)]


def runs_answer(doc_id, text):
    ws = rewritten(doc_id, WORD.findall(text or ""))
    runs = runs_by_hand(ws) if len(ws) < 1500 else []
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in sorted(runs, key=lambda r: (r[0], r[2])))
    top = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    best = (None,) * 4 if top is None else (*top, 1000 * top[1] // top[2])
    kept = " ".join(w for i, w in enumerate(ws) if i not in gone)
    return (doc_id, len(runs), *best, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


def test_runs_query_matches_brute_force(spark, docs, no_docs, tmp_dir):
    from martlet.llm.periodic_runs import op11_periodic_runs

    rng = random.Random(4)
    rows = [(r[0], r[1]) for r in corpus() if len(r[1] or "") < 9000]
    rows += [(1000 + i, sentence(rng, rng.randrange(1, 200))) for i in range(120)]
    rows += [(2000, "a b " * 20 + "c " + "d " * 7 + "e f g " * 5), (2001, "x\ty\n" * 9), (2002, "A a " * 8)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_dir}/documents.parquet")
    got = collections.Counter(tuple(r) for r in op11_periodic_runs(spark, tmp_dir).collect())
    assert got == collections.Counter(runs_answer(*r) for r in rows)
    assert sum(1 for r in got if r[1]) > 10
    no_docs.write.parquet(f"{tmp_dir}/none/documents.parquet")
    assert op11_periodic_runs(spark, f"{tmp_dir}/none").count() == 0


def test_runs_of_long_and_clashing_rows(spark, docs):
    from martlet.llm.periodic_runs import periodic_runs

    found = {r.doc_id: r for r in periodic_runs(docs).collect() if r.doc_id is not None}
    assert found[400].runs == [] and found[400].collapsed == "" and found[401].n_words == 0
    assert [tuple(r) for r in found[405].runs] == [(0, 400, 2)] and found[405].collapsed == "x y"
    long = spark.createDataFrame([(1, "w " * 400_000)], "doc_id long, text string")
    row = periodic_runs(long).first()
    assert [tuple(r) for r in row.runs] == [(0, 400_000, 1)] and row.collapsed == "w"


def test_language_of_held_out_documents(spark):
    from martlet.llm.language_id import op12_language_id

    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang").collect()}
    got = op12_language_id(spark, SF).collect()
    assert len(got) == len(truth)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out]
    assert len(held) > 200 and np.mean([r.lang_pred == truth[r.doc_id] for r in held]) >= 0.99


def test_bundles_by_hand():
    from martlet.llm.language_id import Bundler, letter_signs

    dims, texts = 128, ["Ab, c!", "", "é 12 É", "abc abc", "中文字"]
    signs = {c: 1 - 2 * letter_signs(np.array([ord(c)], np.uint32), dims)[0].astype(int) for c in " abcé中文字"}
    got = Bundler(dims).bundle(texts)
    for text, vector in zip(texts, got):
        plain = " " + re.sub(" +", " ", "".join(c.lower() if c.isalpha() else " " for c in text)).strip() + " "
        want = np.zeros(dims)
        for i in range(len(plain) - 2):
            want += np.roll(signs[plain[i]], 2) * np.roll(signs[plain[i + 1]], 1) * signs[plain[i + 2]]
        assert (vector == (want if plain.strip() else 0)).all(), text


def test_language_edges(spark, docs, no_docs):
    from martlet.llm.language_id import identify, learn

    rows = [(1, "the cat sat on the mat and the dog", "en"), (2, "der hund und die katze schlafen nicht", "de"),
            (3, "nothing known", None), (4, None, "fr"), (5, "12 34", "es")]
    p = learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert p.langs == ["de", "en"]
    got = {r.doc_id: r for r in identify(docs, p).collect()}
    assert [got[k].lang_pred for k in (400, 401, 402)] == ["und"] * 3 and got[400].score == 0
    assert got[404].lang_pred in p.langs
    assert identify(docs, p).count() == docs.count() and identify(no_docs, p).count() == 0
    none = learn(no_docs)
    assert none.langs == [] and {r.lang_pred for r in identify(docs, none).collect()} == {"und"}
    # whatever the partitions, the same profile
    again = learn(spark.createDataFrame(rows * 3, "doc_id long, text string, lang string").repartition(5))
    assert np.allclose(again.prototypes, p.prototypes)


def phrases_by_hand(rows, least, most, top):
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    n, f = collections.Counter(), collections.Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(lower)):
            ws = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(ws)
            f.update((lang, tuple(ws[i:i + k])) for k in range(1, most + 1) for i in range(len(ws) - k + 1))
    cands = {x: a for x, a in f.items() if len(x[1]) > 1 and a >= least}
    inside = {(lang, p[i:i + k]) for (lang, p), a in cands.items() for k in range(2, len(p)) for i in range(len(p) - k + 1)
              if a == f[lang, p[i:i + k]]}
    out = []
    for lang in n:
        scored = []
        for (x, p), a in cands.items():
            if x == lang and (x, p) not in inside:
                score, _, l, r = min((1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]])
                                     for k in range(1, len(p)))
                scored.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (s, a, p, l, r) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, n[lang], -s))
    return sorted(out)


@pytest.mark.parametrize("least,most,top,bits", [(2, 5, 2000, 24), (3, 4, 7, 15), (2, 2, 50, 15)])
def test_collocations_match_brute_force(spark, docs, least, most, top, bits):
    from martlet.llm.collocations import collocations

    rng = random.Random(8)
    text = lambda: "".join(rng.choice(["new York ", "of the ", "The cat", "in\tNew york", ". ", "a,", "é È ", "\x01 ", "a\x01b ", "a\x0eb ", "\x00a ", "a\x0e\x11"])
                           for _ in range(rng.randrange(60)))
    rows = [(r[2], r[1]) for r in corpus()] + [(rng.choice(["en", "de", None, "und"]), text()) for _ in range(60)]
    df = spark.createDataFrame(rows, "lang string, text string").repartition(5)
    got = sorted(tuple(r) for r in collocations(df, least, most, top, bits).collect())
    assert got == phrases_by_hand(rows, least, most, top)
    assert {x[0] for x in got} >= {"en", "und"}


def test_collocations_of_nothing(spark, no_docs):
    from martlet.llm.collocations import collocations

    assert collocations(no_docs).count() == 0


def test_sorted_union_over_cut_ranges():
    from martlet.llm.collocations import SortedUnion

    rng = random.Random(2)
    paths = sorted((["en"] + [rng.choice("ab") for _ in range(rng.randint(1, 4))], rng.randint(1, 5)) for _ in range(300))
    want = collections.Counter()
    for p, w in paths:
        want.update({tuple(p[1:k]): w for k in range(2, len(p) + 1)})
    for least in (1, 40):
        got, at = collections.Counter(), 0
        while at < len(paths):  # ranges of any size; equal keys stay together
            stop = min(len(paths), at + rng.randint(1, 90))
            while stop < len(paths) and paths[stop][0] == paths[stop - 1][0]:
                stop += 1
            union = SortedUnion(least)
            for p, w in paths[at:stop]:
                union.add(p, w)
            union.end()
            for p, w in union.out:
                got[tuple(p[1:])] += w
            at = stop
        assert {k: v for k, v in got.items() if v >= least} == {k: v for k, v in want.items() if v >= least}


def test_shard_paths_grow_like_the_texts(spark):
    """Of five times the texts, five times the words can be frequent; the paths still follow the words."""
    from martlet.llm.collocations import deal_of, filter_of, shard_transducers, word_counts

    rng = random.Random(5)
    made = []
    for size in (400, 2000):
        rows = [("en", " ".join(rng.choice("abcdefghijklmnopqrst") for _ in range(50))) for _ in range(size)]
        df = spark.createDataFrame(rows, "lang string, text string")
        counts = word_counts(df)
        words = counts.filter("word IS NOT NULL")
        assert words.agg({"w": "sum"}).first()[0] == size * 50
        packs = shard_transducers(df, 5, filter_of(words, 100, 15), deal_of(counts, size * 50))
        made.append(packs.agg({"n": "sum"}).first()[0])
    assert made[1] <= 6 * made[0]


def test_paths_of_common_pairs_are_dealt_over_blocks(spark):
    from martlet.llm.collocations import counted_phrases, deal_of, filter_of, shard_transducers, word_counts

    rng = random.Random(6)
    rows = [("en", " ".join(f"of the {rng.choice('abcdefgh')} {rng.choice('xyz')}{rng.randrange(90)}" for _ in range(40)) + rng.choice(["", " of the"]))
            for _ in range(150)]
    df = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    counts = word_counts(df)
    deal = deal_of(counts, 24000, 500)
    assert deal.blocks == 48 and len(deal.pairs) and deal.spread.max() > 4
    packs = shard_transducers(df, 5, filter_of(counts.filter("word IS NOT NULL"), 2, 15), deal).collect()
    assert sum(r.n for r in packs) > 1000 and len({r.block for r in packs}) > 10
    f = collections.Counter()
    for _, text in rows:
        ws = text.split()
        f.update(tuple(ws[i:i + k]) for k in range(1, 6) for i in range(len(ws) - k + 1))
    for least in (2, 100):
        got, total = counted_phrases(df, least, block_words=500)
        assert {(r.lang, tuple(r.phrase), r.f) for r in got.collect()} == {("en", p, a) for p, a in f.items() if a >= least}
        assert [tuple(r) for r in total.collect()] == [("en", sum(a for p, a in f.items() if len(p) == 1))]
