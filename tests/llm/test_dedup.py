"""Mixing, exact dedup, n-gram join and substring dedup against brute force, on awkward tables."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import zstandard

from sonorium.llm import op1_mixing as op1
from sonorium.llm import op2_ngram_join as op2
from sonorium.llm import op3_substring as op3
from sonorium.llm import op5_exact as op5

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, mark string, Copies int"
LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(30_000))


def table(spark, rows, parts=3):  # noqa: ANN001, ANN201
    """(doc_id, text, source) rows with columns whose names clash with those used inside."""
    return spark.createDataFrame([(i, t, "en", s, len(t or ""), "m", 7) for i, t, s in rows], SCHEMA).repartition(parts)


def awkward(n=60):  # noqa: ANN001, ANN201
    base = [" ".join(f"t{(i * 7 + j * (i + 3)) % 97}" for j in range(20 + i % 40)) for i in range(n)]
    rows = [(i, t, f"s{i % 3}") for i, t in enumerate(base)]
    rows += [(100 + i, base[i], None) for i in range(5)]
    rows += [(200 + i, base[i] + f" extra{i}", "s1") for i in range(8)]
    rows += [(300, "", "s0"), (301, "", None), (302, None, "s0"), (None, base[0], "s1"), (None, None, None), (303, "!!! ...", "s0"), (304, "one", "s0"), (305, "One!", "s2"), (0, base[0], "s0"), (0, base[0], "s0")]
    rows += [(400, LONG, "s0"), (401, LONG + " tail", "s0"), (402, LONG, "s1")]
    return rows


def words(t):  # noqa: ANN001, ANN201
    return re.findall(r"[0-9a-z\x80-\U0010ffff]+", t.lower())


def grams(t, n=op2.N):  # noqa: ANN001, ANN201
    w = words(t)
    return frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)]) if w else frozenset()


def test_mixing_rates(spark):
    docs = table(spark, [(i, f"d{i}", "a" if i % 4 else "b") for i in range(4000)])
    got = Counter(r["source"] for r in op1.mix_sources(docs, {"a": 0.5, "b": 0.5}, epochs=2.0).collect())
    assert abs(got["a"] - 4000) < 300 and abs(got["b"] - 4000) < 300
    rare = op1.mix_sources(table(spark, [(i, "x", "a" if i else "b") for i in range(1000)]), {"b": 0.5, "a": 0.5}).groupBy("source").count().collect()
    assert 380 < {r["source"]: r["count"] for r in rare}["b"] < 620  # a rate of 500, in pieces


def test_mixing_is_the_same_in_any_order_and_keeps_columns(spark):
    docs = table(spark, awkward())
    a, b = (Counter(map(tuple, op1.mix_sources(d).collect())) for d in (docs, docs.repartition(7, "text")))
    assert a == b and op1.mix_sources(docs).columns == docs.columns
    assert op1.mix_sources(docs.limit(0)).count() == 0
    for i, n in Counter(r["doc_id"] for r in op1.mix_sources(docs, copy="copy").filter("doc_id = 0").collect()).items():
        assert n % 3 == 0 and i == 0  # three rows of one id share their draw


def brute_exact(rows):  # noqa: ANN001, ANN201
    least = {}
    for i, t, _ in rows:
        if i is not None and t is not None:
            least[t] = min(i, least.get(t, i))
    return Counter((i, i if i is None or t is None else least[t], i is not None and t is not None and least[t] != i) for i, t, _ in rows)


@pytest.mark.parametrize(("fan_in", "bits", "block"), [(2, 64, op5.BLOCK), (2, 64, 3), (8, 64, 5), (2, 2, 2), (3, 2, 100)])
def test_exact_duplicates(spark, fan_in, bits, block):
    rows = awkward()
    assert Counter(map(tuple, op5.exact_duplicates(table(spark, rows, 5), fan_in, bits, block).collect())) == brute_exact(rows)


def test_merging_streams_blocks():
    """Blocks of many runs merge to the sorted distinct entries, and blocks stay small."""
    rnd = np.random.default_rng(3)
    runs = []
    for _ in range(9):
        x = np.zeros(500, op5._RUN)
        x["d"] = np.sort(rnd.integers(-300, 300, 500))
        x["a"], x["id"], x["copies"] = rnd.integers(0, 2, 500), rnd.integers(0, 1 << 40, 500), 1
        runs.append(op5.least_of_equals(x))
    want = {}
    for r in runs:
        for d, a, i in zip(r["d"].tolist(), r["a"].tolist(), r["id"].tolist()):
            want[d, a] = min(i, want.get((d, a), i))
    blocks = sorted((int(r["d"][at]), r[at : at + 7].tobytes()) for r in runs for at in range(0, len(r), 7))
    batch = pa.RecordBatch.from_arrays([pa.array([0] * len(blocks), pa.int32()), pa.array([4] * len(blocks), pa.int32()), pa.array([f for f, _ in blocks], pa.int64()), pa.array([b for _, b in blocks], pa.binary())], ["slice", "to", "first", "run"])
    got = [np.frombuffer(x, op5._RUN) for b in op5._merge(7)(iter([batch])) for x in b.column("run").to_pylist()]
    assert max(map(len, got)) <= 7
    every = np.concatenate(got)
    assert [(d, a) for d, a in zip(every["d"].tolist(), every["a"].tolist())] == sorted(want)
    assert {(d, a): i for d, a, i in zip(every["d"].tolist(), every["a"].tolist(), every["id"].tolist())} == want


def test_drop_exact_duplicates(spark):
    rows = awkward()
    docs = table(spark, rows, 5)
    kept = op5.drop_exact_duplicates(docs)
    assert kept.columns == docs.columns
    got = Counter((r["doc_id"], r["text"]) for r in kept.collect())
    keep = {(i, t) for i, t, _ in rows if i is not None and t is not None and all(j >= i for j, u, _ in rows if u == t and j is not None)}
    want = Counter({k: 1 for k in keep}) + Counter((i, t) for i, t, _ in rows if i is None or t is None)
    assert got == want
    assert op5.drop_exact_duplicates(docs.limit(0)).count() == 0 and op5.exact_duplicates(docs.limit(0)).count() == 0


def brute_pairs(rows, n=op2.N, t=op2.THRESHOLD):  # noqa: ANN001, ANN201
    lead, out = defaultdict(lambda: 1 << 60), {}
    for i, text, _ in rows:
        if i is not None and text is not None and grams(text, n):
            lead[grams(text, n)] = min(lead[grams(text, n)], i)
    for i, text, _ in rows:
        if i is not None and text is not None and grams(text, n) and i > lead[grams(text, n)]:
            out[lead[grams(text, n)], i] = 1.0
    sets = list(lead.items())
    for k, (x, i) in enumerate(sets):
        for y, j in sets[k + 1 :]:
            if i != j and (jac := len(x & y) / len(x | y)) >= t - 1e-9:
                key = (min(i, j), max(i, j))
                out[key] = max(jac, out.get(key, 0))
    return out


def brute_classes(rows, n=op2.N, t=op2.THRESHOLD):  # noqa: ANN001, ANN201
    """(doc_id, class_id, n_links, nearest) of every document, from all pairs of documents."""
    docs = sorted({(i, grams(text or "", n)) for i, text, _ in rows if i is not None}, key=lambda d: (d[0], sorted(d[1])))
    root, links, best = list(range(len(docs))), [0] * len(docs), [None] * len(docs)

    def find(x):  # noqa: ANN001, ANN202
        while root[x] != x:
            x = root[x]
        return x

    for i, (_, x) in enumerate(docs):
        for j in range(i + 1, len(docs)):
            y = docs[j][1]
            if x and y and (jac := len(x & y) / len(x | y)) >= t - 1e-9:
                for k in (i, j):
                    links[k] += 1
                    best[k] = max(best[k] or 0, jac)
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return Counter((d[0], docs[find(k)][0], links[k], best[k] and round(best[k], 9)) for k, d in enumerate(docs))


def found_classes(docs, *args):  # noqa: ANN001, ANN002, ANN201
    return Counter((r["doc_id"], r["class_id"], r["n_links"], r["nearest"] and round(r["nearest"], 9)) for r in op2.jaccard_classes(docs, *args).collect())


@pytest.mark.parametrize(("n", "t", "entries"), [(op2.N, op2.THRESHOLD, op2.BUCKET_ENTRIES), (3, 0.3, 500), (1, 0.9, 50), (2, 0.55, 100)])
def test_jaccard_classes(spark, monkeypatch, n, t, entries):
    monkeypatch.setattr(op2, "BUCKET_ENTRIES", entries)
    rows = awkward(40)
    rows += [(1000 + k, " ".join(f"z{j}" for j in range(60) if j % 17 != k % 17 and (k * 5 + j) % 23), "s") for k in range(60)]
    rows += [(7, "another text under an id that has one", "s"), (8, rows[9][1], "s")]
    assert found_classes(table(spark, rows, 4), n, t) == brute_classes(rows, n, t)


def test_jaccard_of_large_neighbourhoods(spark, monkeypatch):
    """Cells that are split count the same links."""
    monkeypatch.setattr(op2, "CELL", 4)
    rows = [(k, " ".join(f"z{j}" for j in range(50) if j != k % 50 and j != k // 2), "s") for k in range(60)]
    assert found_classes(table(spark, rows)) == brute_classes(rows)


def copies(n, m=80, seed=4):  # noqa: ANN001, ANN201
    """n near copies of one text and m other texts, some of which take half of it."""
    rnd = np.random.default_rng(seed)
    base = [f"z{j}" for j in range(150)]
    rows = [(k, " ".join(w if rnd.random() < 0.97 else f"y{rnd.integers(1000)}" for w in base), "s") for k in range(n)]
    rows += [(n + k, " ".join(base[: 150 - k] + [f"x{rnd.integers(40)}" for _ in range(k)]), "s") for k in range(m)]
    return rows + rows[:5] + [(5000 + k, t, s) for k, t, s in rows[:20]]


@pytest.mark.parametrize("part", [16, op2.PART])
def test_families_count_the_same_links(spark, monkeypatch, part):
    """Pairs inside a family are counted by matrices, all others as before, whatever the parts are."""
    monkeypatch.setattr(op2, "DENSE", 10)
    monkeypatch.setattr(op2, "PART", part)
    rows = copies(100) + awkward(10)
    seen, inside = [], op2._inside
    monkeypatch.setattr(op2, "_inside", lambda *a: seen.append(len(a[2][0])) or inside(*a))
    assert found_classes(table(spark, rows)) == brute_classes(rows)
    assert seen[0] > 80


def test_copies_of_one_text_are_no_rows_of_pairs(spark, monkeypatch):
    """1,200 near copies have 720,000 pairs; nearly none of them travels."""
    sizes = {}
    write = op2.cut

    def counted(df, name):  # noqa: ANN001, ANN202
        out = write(df, name)
        sizes[name] = max(out.count(), sizes.get(name, 0))
        return out

    monkeypatch.setattr(op2, "cut", counted)
    rows = [r for r in copies(1200, 0) if r[0] < 1200]
    got = op2.jaccard_classes(table(spark, rows)).collect()
    sets = [grams(t) for _, t, _ in rows[:1200]]
    assert {r["class_id"] for r in got} == {0}
    for r in got[:20]:
        x = sets[r["doc_id"]]
        assert r["n_links"] == sum(len(x & y) / len(x | y) >= op2.THRESHOLD - 1e-9 for y in sets) - 1
    assert sizes["candidates"] < 100_000 and sizes["found"] < 10_000


def test_a_bucket_and_a_cell_hold_few_pairs(monkeypatch):
    """However many pairs meet, parts of bounded size leave; together they are all pairs."""
    real = op2.gram_sets(pa.array([" ".join(f"g{j}" for j in range(60) if j != k % 50) + f" h{k}" for k in range(2500)]), 1)
    text = pa.RecordBatch.from_arrays([pa.array([" ".join(f"g{j}" for j in range(60) if j != k % 50) + f" h{k}" for k in range(2500)], pa.large_string())], ["text"])
    blobs = [tuple(b.column(i)[0].as_py() for i in (1, 2, 3)) for b in op2._second_pass(np.zeros(op2.CELLS, np.uint8), 1, 0.55, 1)(iter([text]))]
    parts = list(op2._bucket_parts(list(blobs), 0.55, 0, 1))
    assert len(parts) > 1
    assert len(np.unique(np.concatenate([np.stack(p[:2], 1) for p in parts]), axis=0)) == len(real) * (len(real) - 1) // 2
    nodes = np.sort(np.array([op2.digest(s) for s in real]))
    assert not len(next(iter(op2._bucket_parts(list(blobs), 0.55, 0, 1, (nodes, np.ones(len(nodes), np.int64)))))[0])
    monkeypatch.setattr(op2, "_KEEP", 10)
    cell = [(7, 0, k, 1, b"x") for k in range(9)] + [(7, 1, i, j, None) for i in range(9) for j in range(i)]
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*cell)], ["cell", "kind", "a", "b", "blob"])
    out = list(op2._in_cells(lambda b: b, lambda p, q: 1.0, lambda found: [(1, x, y, None, v) for x, y, _, _, v in found])(iter([batch])))
    assert len(out) == 4 and sum(b.num_rows for b in out) == 36


def test_pairs_that_share_one_gram_are_few_candidates(spark, monkeypatch):
    """40 texts of 39 words, each of which a text shares with one other text alone, make few candidates; short texts keep what one gram decides."""
    sizes = {}
    write = op2.cut

    def counted(df, name):  # noqa: ANN001, ANN202
        out = write(df, name)
        sizes[name] = out.count()
        return out

    monkeypatch.setattr(op2, "cut", counted)
    rows = [(k, " ".join(f"e{min(k, j)}with{max(k, j)}" for j in range(40) if j != k), "s") for k in range(40)]
    assert found_classes(table(spark, rows), 1) == brute_classes(rows, 1)
    assert sizes["candidates"] < 60  # of some 240 that meet: a shared mark needs no second gram
    rows = [(k, " ".join(f"b{(k * 7 + j) % 9}" for j in range(1 + k % 4)), "s") for k in range(60)] + [(100 + k, f"c{k} d e", "s") for k in range(3)]
    for t in (0.3, 0.55):
        assert found_classes(table(spark, rows), 2, t) == brute_classes(rows, 2, t)


def test_overlaps_and_forests():
    rnd = np.random.default_rng(2)
    x, y = ([np.unique(rnd.integers(0, top, 30).astype(np.uint64)) for top in [60] * 40 + [1 << 20] * 5] for _ in range(2))
    assert (op2.overlaps(x, y) == [[len(np.intersect1d(a, b)) for b in y] for a in x]).all()
    for share in (0, 0.02, 0.1, 1):
        agree = rnd.random((40, 30)) < share

        def roots(pairs):  # noqa: ANN001, ANN202
            label = list(range(70))
            for _ in range(70):
                for i, j in pairs:
                    label[i] = label[40 + j] = min(label[i], label[40 + j])
            return label

        pairs = op2.forest(agree)
        assert all(agree[p] for p in pairs) and roots(pairs) == roots(np.argwhere(agree).tolist())


def test_buckets_report_every_similar_pair():
    """Over many buckets, each pair that agrees is reported once at least, and by one bucket if it shares a mark."""
    rnd = np.random.default_rng(9)
    base = [np.unique(rnd.integers(0, 1 << 56, 60, dtype=np.uint64)) for _ in range(12)]
    sets = [np.unique(np.concatenate([s[rnd.random(len(s)) < 0.9], rnd.integers(0, 1 << 56, 4, dtype=np.uint64)])) for s in base for _ in range(8)]
    text = pa.RecordBatch.from_arrays([pa.array([" ".join(f"g{x}" for x in s) for s in sets], pa.large_string())], ["text"])
    real = op2.gram_sets(text.column("text"), 1)
    common = np.zeros(op2.CELLS, np.uint8)
    for buckets in (1, 7, 60):
        blobs = defaultdict(list)
        for b in op2._second_pass(common, 1, 0.55, buckets)(iter([text, text])):
            blobs[b.column("bucket")[0].as_py()].append(tuple(b.column(i)[0].as_py() for i in (1, 2, 3)))
        found = Counter()
        for k, x in blobs.items():
            found.update(zip(*(y.tolist() for y in op2.bucket_pairs(list(x), 0.55, k, buckets))))
        nodes = [op2.digest(s) for s in real]
        want = {(min(nodes[i], nodes[j]), max(nodes[i], nodes[j])) for i in range(len(real)) for j in range(i) if len(np.intersect1d(real[i], real[j])) / len(np.union1d(real[i], real[j])) >= 0.55}
        assert want and want <= found.keys()
        assert buckets == 1 or sum(found[p] for p in want) < 4 * len(want)


def test_drop_near_duplicates(spark):
    rows = awkward(40)
    docs = table(spark, rows, 4)
    root = {i: i for i, t, _ in rows if i is not None}

    def find(x):  # noqa: ANN001, ANN202
        while root[x] != x:
            x = root[x]
        return x

    for a, b in brute_pairs(rows):
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    want = {(i, t) for i, t, _ in rows if i is None or t is None or not grams(t) or find(i) == i}
    kept = op2.drop_near_duplicates(docs)
    got = [(r["doc_id"], r["text"]) for r in kept.collect()]
    assert set(got) == want and kept.columns == docs.columns
    assert len([g for g in got if g[0] == 0]) == 1  # a repeated row stays once
    assert op2.drop_near_duplicates(docs.limit(0)).count() == 0 and op2.jaccard_classes(docs.limit(0)).count() == 0


def test_prefix_and_suffix_filters_are_safe():
    rnd = np.random.default_rng(5)
    for _ in range(300):
        n = int(rnd.integers(1, 400))
        x = np.unique(rnd.integers(0, 1 << 56, n, dtype=np.uint64))
        y = np.unique(np.concatenate([x[rnd.random(len(x)) < 0.8], rnd.integers(0, 1 << 56, int(rnd.integers(1, 80)), dtype=np.uint64)]))
        overlap = len(np.intersect1d(x, y))
        jac = overlap / (len(x) + len(y) - overlap)
        hist = [np.frombuffer(zstandard.decompress(op2.histogram(s)), np.uint8) for s in (x, y)]
        assert op2.most_common(*hist) >= overlap
        if jac >= 0.55:
            p, q = op2.prefixes([x, y], np.zeros(op2.CELLS, np.uint8), 0.55)
            assert len(np.intersect1d(p, q))


def brute_passages(rows, window):  # noqa: ANN001, ANN201
    where = defaultdict(set)
    seen = defaultdict(int)
    for i, t, _ in rows:
        if i is not None and t is not None:
            w = words(t)
            for at in range(len(w) - window + 1):
                where[tuple(w[at : at + window])].add((i, at))
                seen[tuple(w[at : at + window])] += 1
    cover = [defaultdict(set), defaultdict(set)]
    for g, places in where.items():
        if seen[g] > 1:
            ordered = sorted(places)
            later = ordered if seen[g] > len(ordered) and Counter((i, t) for i, t, _ in rows)[next((i, t) for i, t, _ in rows if i == ordered[0][0])] > 1 else ordered[1:]
            for kind, mine in ((0, ordered), (1, later)):
                for i, at in mine:
                    cover[kind][i].update(range(at, at + window))
    return {i: (len(cover[0][i]), len(cover[1][i])) for i in cover[0]}


def test_repeated_passages(spark):
    shared = " ".join(f"p{j}" for j in range(70))
    rows = [(i, " ".join(f"u{i}q{j}" for j in range(30)) + " " + (shared if i % 3 == 0 else "") + f" end{i}", "s") for i in range(20)]
    rows += [(50, shared.upper() + " " + shared, "s"), (51, None, "s"), (52, "", "s"), (None, shared, "s"), (53, "few words", "s"), (60, LONG, "s")]
    docs = table(spark, rows)
    got = {r["doc_id"]: (r["repeated_words"], r["cut_words"]) for r in op3.repeated_passages(docs).collect()}
    assert got == brute_passages(rows, op3.WINDOW)
    assert op3.repeated_passages(docs.limit(0)).count() == 0
    small = {r["doc_id"]: (r["repeated_words"], r["cut_words"]) for r in op3.repeated_passages(docs, 8, 4).collect()}
    assert small == brute_passages(rows, 8)


def test_repeated_rows_share_their_passages(spark):
    text = " ".join(f"p{j}" for j in range(60))
    got = op3.repeated_passages(table(spark, [(1, text, "s"), (1, text, "s")])).collect()
    assert [(r["doc_id"], r["repeated_words"]) for r in got] == [(1, 60)]


def test_sketch_never_loses_a_repeated_window(spark):
    rows = [(i, " ".join(f"a{(i * j) % 53}" for j in range(90)), "s") for i in range(60)]
    parts = table(spark, rows).select("text").mapInArrow(op3._sketches(20, 6), op3._PART)
    made = [op3.Windows(pa.array([t], pa.large_string()), 20, 6) for _, t, _ in rows]
    counts = Counter(w for m in made for w in m.anchor[m.ok].tolist())
    repeated = np.array([w for w, n in counts.items() if n > 1], np.uint64)
    assert len(repeated)
    for bits in (12, 22):
        selected = Counter(w for m in made for w in m.anchors().tolist())
        sure = np.array([w for w in repeated.tolist() if selected[w] > 1], np.uint64)
        assert op3._repeated(sure, op3.repeated_cells(parts, bits), bits).all()
