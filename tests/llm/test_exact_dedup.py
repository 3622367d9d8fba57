from collections import Counter, defaultdict
from hashlib import sha256

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from weftlink.llm.exact_dedup import CountingQuotientFilter, deduplicate, group_copies, repeated_fingerprints

lists = st.lists(st.integers(0, 2**20 - 1) | st.integers(0, 15), max_size=200)


@settings(deadline=None, max_examples=60)
@given(lists, lists, lists)
def test_filters_merge_without_loss(a, b, c):
    made = [CountingQuotientFilter.build(np.array(x, np.uint64), 20) for x in (a, b, c)]
    made = [CountingQuotientFilter.from_bytes(x.to_bytes()) for x in made]
    whole = CountingQuotientFilter.from_bytes(made[0].merge(*made[1:]).to_bytes())
    assert dict(zip(whole.fingerprints().tolist(), whole.counts.tolist(), strict=True)) == Counter(a + b + c)
    assert dict(zip(*(x.tolist() for x in whole.repeated()), strict=True)) == {k: n for k, n in Counter(a + b + c).items() if n > 1}


def test_repeated_fingerprints(spark):
    rng = np.random.default_rng(0)
    values = rng.integers(-(2**63), 2**63 - 1, 3000).tolist()
    values += values[:500] + values[:100] * 4
    df = spark.createDataFrame([(v,) for v in values], "x long").repartition(7)
    assert {(r.fp, r.n) for r in repeated_fingerprints(df, "x", 10**9).collect()} == {(k, n) for k, n in Counter(values).items() if n > 1}


def test_groups(odd):
    rows = odd.select("doc_id", "text").collect()
    groups = defaultdict(list)
    for r in rows:
        groups[r.text or ""].append(r.doc_id)
    got = group_copies(odd).collect()
    assert len(got) == len(rows)
    assert sum(r.kept for r in got) == len(groups)
    largest = {sha256(t.encode()).hexdigest(): (max((x for x in ids if x is not None), default=None), len(ids)) for t, ids in groups.items()}
    for r in got:
        assert (r.keep_id, r.group_size) == largest[r.text_sha256]
        assert not r.kept or r.doc_id == r.keep_id


def test_rows_that_stay(odd, none):
    left = deduplicate(odd)
    assert left.columns == odd.columns
    texts = [r.text or "" for r in left.collect()]
    assert sorted(texts) == sorted({r.text or "" for r in odd.collect()})
    assert group_copies(none).count() == deduplicate(none).count() == 0


def test_hot_group(spark):
    df = spark.range(3000).selectExpr("id as doc_id", "if(id % 3 = 0, 'hot', concat('t', id)) as text")
    got = group_copies(df).where("group_size > 1").collect()
    assert len(got) == 1000 and {r.keep_id for r in got} == {2997} and sum(r.kept for r in got) == 1
