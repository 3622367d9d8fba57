import random

from weftlink.llm import decontaminate
from weftlink.llm.decontaminate import Index, find_items, normalise

from .conftest import prose

ITEMS = [(k, prose(300 + k, 12 + k % 20)) for k in range(25)]


def distance(item, text):
    """Least edits between the item and any part of the text."""
    last = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        now = [i]
        for j, d in enumerate(text, 1):
            now.append(min(last[j - 1] + (c != d), last[j] + 1, now[-1] + 1))
        last = now
    return min(last)


def edited(text, edits, r):
    own = list(text)
    for _ in range(edits):
        p, kind = r.randrange(len(own)), r.randint(0, 2)
        own[p : p + (kind != 1)] = [] if kind == 2 and len(own) > 1 else [r.choice("abz ")]
    return "".join(own)


def test_brute_force():
    r = random.Random(3)
    index = Index(ITEMS)
    for n in range(40):
        k = r.randrange(len(index.texts))
        budget = int(index.budget[k])
        text = normalise(prose(n, 30) + " " + edited(index.texts[k], r.randint(0, budget + 3), r) + " " + prose(n + 1, 20))
        found = {m[0]: m for m in index.search(["x y", text, ""])[1]}
        for j, item in enumerate(index.texts):
            least = distance(item, text)
            if least > index.budget[j]:
                assert index.ids[j] not in found
            else:
                _, start, end, edits = found[index.ids[j]]
                assert edits == least == distance(item, text[start:end])


def test_table(spark, odd, none, monkeypatch):
    benchmark = spark.createDataFrame([*ITEMS, (77, None), (78, "short"), (79, ""), (None, prose(1, 80))], "item_id long, text string")
    docs = spark.createDataFrame([(1, "Xx  " + ITEMS[3][1].upper().replace(" ", "\n ") + " yy " + ITEMS[8][1], 1), (2, prose(50, 200), 2), (3, None, 3), (4, "", 4)], "doc_id long, text string, leaks int")
    for size in (10**6, 500):  # one block of the index, then many
        monkeypatch.setattr(decontaminate, "INDEX_CHARS", size)
        got = {r.doc_id: [(m.item_id, m.edits) for m in sorted(r.leaks)] for r in find_items(docs, benchmark).collect()}
        assert got == {1: [(3, 0), (8, 0)], 2: [], 3: [], 4: []}
    assert find_items(odd, benchmark).count() == odd.count() and find_items(none, benchmark).count() == 0
    assert all(r.leaks == [] for r in find_items(odd, benchmark.limit(0)).collect())


def test_long_text(monkeypatch):
    index = Index(ITEMS)
    text = normalise(prose(60, 300) + " " + ITEMS[5][1] + " " + prose(61, 300) + " " + ITEMS[9][1])
    monkeypatch.setattr(decontaminate, "SPAN", 400)
    assert sorted(index.search_long(text)) == sorted(index.search([text])[0])


def test_short_items():
    index = Index([(1, "Sea whale"), (2, "whale?"), (3, "(c) now"), (4, "?!"), (5, "whale"), (6, "blue whale")])
    find = lambda text: [(key, text[start:end], edits) for key, start, end, edits in index.search([text])[0]]
    assert find("a sea whale, (c) now") == [(1, "sea whale", 0), (3, "(c) now", 0), (5, "whale", 0)]
    assert find("sea whales, seawhale sea  whale ?! (c) nowhere") == [(5, "whale", 0)]
    assert find("is it a whale?") == [(2, "whale?", 0), (5, "whale", 0)]
    assert find("blue whales") == [(6, "blue whale", 0)] and find("blue-whale") == [(5, "whale", 0)]  # a q-gram long, no edits
    assert index.search_long("x " * 10 + "whale")[0] == (5, 20, 25, 0)
    assert index.search(["", "no"]) == [[], []]


def test_every_length_against_brute_force():
    r = random.Random(4)
    items = [(n, "".join(r.choice("abcd ") for _ in range(n)).strip().replace("  ", "a b") or "q") for n in range(1, 45)]
    index = Index(items)
    for n in range(25):
        key, item = r.choice(items)
        text = normalise(prose(n, 6) + " " + edited(item, r.randint(0, 2), r) + " " + prose(n + 1, 6))
        found = {m[0]: m[3] for m in index.search([text])[0]}
        for key, item in items:
            item = normalise(item)
            if len(item) >= decontaminate.Q:
                budget = min(int(len(item) * decontaminate.RATE), (len(item) - decontaminate.Q) // decontaminate.Q)
                least = distance(item, text)
                assert (key in found) == (least <= budget) and found.get(key, least) == least


def test_one_index_at_a_time(spark, monkeypatch):
    made, gone = [], []
    kind = type(spark.sparkContext.broadcast(0))
    destroy = kind.destroy
    monkeypatch.setattr(decontaminate, "INDEX_CHARS", 300)
    init = Index.__init__
    monkeypatch.setattr(Index, "__init__", lambda self, items: made.append(len(made) - len(gone)) or init(self, items))
    monkeypatch.setattr(kind, "destroy", lambda self, *a: gone.append(1) or destroy(self, *a))
    benchmark = spark.createDataFrame(ITEMS, "item_id long, text string")
    docs = spark.createDataFrame([(k, f"{prose(k, 20)} {text} {prose(k + 1, 20)}") for k, text in ITEMS for _ in range(3)], "doc_id long, text string")
    got = find_items(docs, benchmark).collect()
    assert len(got) == len(ITEMS) * 3 and all(r.doc_id in [m.item_id for m in r.leaks] for r in got)
    assert len(made) > 5 and set(made) == {0}  # every index is gone before the next is made
