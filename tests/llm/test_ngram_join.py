import random

import numpy as np

from weftlink.llm import ngram_join
from weftlink.llm.ngram_join import count_links, least_matches, min_hashes, one_of_each, prefix, shingle_sets, similar

from weftlink.llm.common import Scratch

from .conftest import prose


def naive(text):
    w = (text or "").lower().split()
    return frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def classes(rows):
    sets = [naive(t) for _, t in rows]
    home = list(range(len(rows)))

    def find(x):
        while home[x] != x:
            x = home[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and len(a & sets[j]) >= 0.8 * len(a | sets[j]) - 1e-12:
                home[find(i)] = find(j)
    groups = {}
    for k, (id, _) in enumerate(rows):
        groups.setdefault(find(k), []).append(id)
    return sorted(tuple(sorted(g, key=repr)) for g in groups.values())


def corpus():
    r = random.Random(3)
    rows, passage = [], prose(999, 40)
    for k in range(60):
        rows.append((len(rows), prose(k, r.randint(20, 90))))
        rows.append((len(rows), passage + " " + prose(5000 + k, 30)))  # one passage in many
    for k in range(40):  # edited copies, some in a chain
        words = rows[k][1].split()
        for _ in range(r.randint(1, 3)):
            words[r.randrange(len(words))] = "edit" + str(r.randint(0, 5))
            rows.append((len(rows), (" " if k % 2 else "\n").join(words)))
    big = prose(777, 60).split()
    for k in range(90):  # one large group, edited all over
        own = list(big)
        own[(7 * k) % 60] = f"new{k}"
        rows.append((len(rows), " ".join(own)))
    rows += [(len(rows) + k, rows[4][1].upper() if k % 2 else rows[4][1]) for k in range(20)]
    return rows + [(900, None), (901, ""), (902, "one two"), (903, "One  two"), (904, "a b c d e"), (905, "\t")]


def test_brute_force(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "LEAST_COMMON", 30)
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = similar(df).collect()
    assert len(got) == len(rows)
    groups = {}
    for r in got:
        groups.setdefault(r.class_id, []).append(r)
    assert sorted(tuple(sorted((r.doc_id for r in g), key=repr)) for g in groups.values()) == classes(rows)
    for id, g in groups.items():
        assert id == min(r.doc_id for r in g) and [r.doc_id for r in g if r.representative] == [id]
        assert len({r.copy_id for r in g}) == 1 or all(r.n_links for r in g)
    by = {}
    for id, t in rows:
        if naive(t):
            by.setdefault(naive(t), []).append(id)
    assert {r.doc_id: r.copy_id for r in got} == {id: min(by.get(naive(t), [id])) for id, t in rows}


def links(rows):
    sets = [naive(t) for _, t in rows]
    return {id: sum(1 for j, b in enumerate(sets) if j != k and a and b and len(a & b) >= 0.8 * len(a | b) - 1e-12) for k, ((id, _), a) in enumerate(zip(rows, sets, strict=True))}


def test_every_link_counts(spark, monkeypatch):
    rows = corpus()
    big = prose(778, 120).split()
    for k in range(300):  # near copies that share few of the rarest n-grams, some of them twice
        own = list(big)
        own[(7 * k) % 120] = f"new{k}"
        rows += [(1000 + 3 * k + j, " ".join(own) if j else " ".join(own).upper()) for j in range(1 + (k % 5 == 0))]
    want = links(rows)
    assert sorted(want.values())[-300] > 250
    monkeypatch.setattr(ngram_join, "BLOCK_SETS", 50)  # large components are several blocks
    got = similar(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert {r.doc_id: r.n_links for r in got} == want


def test_count_links():
    rng = np.random.default_rng(1)
    whole = rng.integers(0, 2**63, 60).astype(np.uint64)
    sets = [np.unique(np.r_[whole[rng.random(60) > 0.06], rng.integers(0, 2**63, rng.integers(0, 5)).astype(np.uint64)]) for _ in range(150)]
    sets += [np.array([k], np.uint64) for k in range(5)]  # n-grams that no other set has
    weights = rng.integers(1, 4, len(sets)).astype(float)
    alike = np.array([[len(np.intersect1d(x, y)) >= 0.8 * len(np.union1d(x, y)) - 1e-12 for y in sets] for x in sets])
    for sizes in ({}, {"tile": 40, "panel": 7, "frequent": 3}, {"tile": 33, "frequent": 1000}):
        assert (count_links(sets, weights, 0, 0.8, **sizes) == alike @ weights).all()
        across = alike.copy()
        across[:70, :70] = across[70:, 70:] = False
        assert (count_links(sets, weights, 70, 0.8, **sizes) == across @ weights).all()


def test_one_ngram_in_many_unlike_documents(spark, monkeypatch):
    """Documents of 10 of 40 passages: every n-gram is in a quarter of them, no two are alike but for planted copies."""
    r = random.Random(9)
    passages = [prose(4000 + k, 12) for k in range(40)]
    rows = [(k, " ".join(r.sample(passages, 10))) for k in range(1200)]
    rows += [(2000 + k, rows[k][1].rsplit(" ", 1)[0] + " edit") for k in range(0, 1200, 100)]
    made = {}
    keep = Scratch.keep
    monkeypatch.setattr(Scratch, "keep", lambda self, df, name: made.setdefault(name, keep(self, df, name).cache()))
    got = similar(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    assert {r.doc_id: r.class_id for r in got if r.doc_id >= 2000} == {2000 + k: k for k in range(0, 1200, 100)}
    assert made["open"].groupBy("key").count().agg({"count": "max"}).first()[0] > 2 * ngram_join.SPLIT_MEMBERS  # long lists of different components
    assert made["left"].count() < 0.02 * len(rows) ** 2 / 2  # unlike pairs agree in a band with a probability of 1 %


def test_parts():
    texts = [prose(1, 30), None, "", " a ", "a b c d e f", "A b c\nd e f"]
    sets = shingle_sets(texts)
    assert [len(s) for s in sets] == [len(naive(t)) for t in texts]
    assert (sets[4] == sets[5]).all()
    steps = least_matches(0.8, 1e-6)
    assert [n for n, _ in steps] == list(range(16, 129, 16)) and all(m <= 0.8 * n for n, m in steps)
    rng = np.random.default_rng(0)
    for _ in range(40):
        whole = rng.integers(0, 2**63, 120).astype(np.uint64)
        x, y = np.unique(whole[:110]), np.unique(whole[10:])  # similarity 100 / 120
        a, b = min_hashes(x), min_hashes(y)
        assert all((a[:n] == b[:n]).sum() >= m for n, m in steps)
        common = (np.arange(0), np.arange(0))
        assert set(prefix(x, common, 0.8)[0].tolist()) & set(prefix(y, common, 0.8)[0].tolist())


def test_oddities(odd, none):
    left = one_of_each(odd)
    assert left.columns == odd.columns
    assert sorted(repr(naive(r.text)) for r in left.collect() if naive(r.text)) == sorted({repr(naive(r.text)) for r in odd.collect() if naive(r.text)} - {repr(naive(prose(2, 60) + " end"))})
    assert similar(none).count() == one_of_each(none).count() == 0


def test_long_lists_make_no_pairs(spark, monkeypatch):
    """A group of edited copies without their base: most share long lists and are not linked; rows follow the members, not their pairs."""
    r = random.Random(11)
    rows = []
    for base in (prose(6000, 150).split(), prose(6001, 150).split()):
        for _ in range(250):
            own = list(base)
            for _ in range(r.randint(1, 5)):
                own[r.randrange(150)] = f"w{r.randint(0, 99999)}"
            rows.append((len(rows), " ".join(own)))
    made = {}
    keep = Scratch.keep
    monkeypatch.setattr(Scratch, "keep", lambda self, df, name: made.setdefault(name, keep(self, df, name).cache()))
    monkeypatch.setattr(ngram_join, "BLOCK_SETS", 100)  # lists and groups are several blocks
    got = similar(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    groups = {}
    for x in got:
        groups.setdefault(x.class_id, []).append(x.doc_id)
    assert sorted(tuple(sorted(g, key=repr)) for g in groups.values()) == classes(rows) and 20 < len(groups) < 480
    assert {x.doc_id: x.n_links for x in got} == links(rows)
    assert made["suspects"].count() > 0
    assert sum(made[name].count() for name in ("pairs", "left", "suspects")) < 10 * len(rows)  # of 62,250 pairs of a base
    plain = similar(spark.createDataFrame(rows, "doc_id long, text string").repartition(2), count=False).collect()
    assert {x.doc_id: x.class_id for x in plain} == {x.doc_id: x.class_id for x in got}


def test_likely_labels():
    rng = np.random.default_rng(2)
    whole = rng.integers(0, 2**63, 200).astype(np.uint64)
    sets = [np.unique(np.r_[whole[:120][rng.random(120) > 0.07], rng.integers(0, 2**63, 9).astype(np.uint64)]) for _ in range(60)]
    sets += [np.unique(np.r_[whole[120:140], rng.integers(0, 2**63, 100).astype(np.uint64)]) for _ in range(60)]  # a passage, not alike
    n, pos, part = np.array([len(x) for x in sets]), np.zeros(len(sets), np.int64), np.arange(len(sets)) // 2 * 2
    bits = np.stack([ngram_join.low_bits(min_hashes(x)) for x in sets]).view(np.uint64)
    least = least_matches(0.9, 1e-6)[-1][1]
    for split in (0, 50):
        label = ngram_join.likely_labels(n, pos, part, bits, split, 0.8, least, tile=16)
        for i in range(len(sets)):
            assert label[i] == label[part[i]] == label[label[i]] <= i
            for j in range(i):
                if (not split or j < split <= i) and len(np.intersect1d(sets[i], sets[j])) >= 0.8 * len(np.union1d(sets[i], sets[j])):
                    assert label[i] == label[j]
        assert len(np.unique(label[60:])) == 30  # only parts
