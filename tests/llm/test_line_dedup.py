import random
import re

import pytest
from pyspark.sql import functions as F

from weftlink.llm.line_dedup import WHITE_SPACE, find_duplicate_lines, normalised, remove_lines


def within_one(a, b):
    if abs(len(a) - len(b)) > 1:
        return False
    if len(a) > len(b):
        a, b = b, a
    k = 0
    while k < len(a) and a[k] == b[k]:
        k += 1
    return a[k + 1 :] == b[k + 1 :] if len(a) == len(b) else a[k:] == b[k + 1 :]


def brute(rows):
    seen, out = [], []
    for id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        n, drops = 0, []
        for k, line in enumerate((text or "").split("\n")):
            line = re.sub(r"^\s+|\s+$", "", line).lower()
            if line:
                n += 1
                if any(line == s or within_one(line, s) for s in seen):
                    drops.append(k)
                seen.append(line)
        out.append((id, n, n - len(drops), drops))
    return out


def test_brute_force(spark):
    r = random.Random(5)
    base = [f"the quick brown fox jumps {k}" for k in range(20)] + ["a" * 20, "ab" * 8, "short", "shoot", "", " \t", "x" * 12, "x" * 11]

    def edit(s):
        kind, p, c = r.randint(0, 3), r.randrange(len(s)) if s else 0, r.choice("abxyé ")
        return s if not s or kind == 0 else s[:p] + c + s[p:] if kind == 1 else s[:p] + s[p + 1 :] if kind == 2 else s[:p] + c + s[p + 1 :]

    rows = [(k, "\n".join(edit(edit(r.choice(base))) for _ in range(r.randint(1, 8)))) for k in range(150)] + [(300, None), (301, ""), (None, base[3])]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = find_duplicate_lines(df)
    got = sorted(((x.doc_id, x.n_lines, x.n_kept, x.dropped) for x in found.collect()), key=lambda x: (x[0] is not None, x[0] or 0))
    assert got == brute(rows)
    left = {x.doc_id: x.text for x in remove_lines(df, found).collect()}
    for id, _, _, drops in got:
        text = dict(rows)[id]
        assert left[id] == (text and "\n".join(x for k, x in enumerate(text.split("\n")) if k not in drops))


def test_short_lines(spark):
    r = random.Random(6)
    rows = [(k, "\n".join("".join(r.choice("abc漢") for _ in range(r.randint(0, 5))) for _ in range(2))) for k in range(0, 60)] + [(k, "".join(r.choice("xyzuvw") for _ in range(4 + k % 4))) for k in range(100, 130)]
    found = find_duplicate_lines(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    assert sorted((x.doc_id, x.n_lines, x.n_kept, x.dropped) for x in found.collect()) == brute(rows)


def test_white_space(spark):
    texts = [f"{c}{c}A {c} b{c}" for c in WHITE_SPACE] + [f"{chr(c)}a" for c in (0, 28, 31, 0x200B, 0xFEFF)]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(normalised(F.col("t"))).collect()]
    assert got == [f"a {c} b" for c in WHITE_SPACE] + texts[len(WHITE_SPACE) :]
    java = spark.range(0, 0x3001).select(F.chr("id").alias("c")).where(F.col("c").rlike(r"(?U)^\s$"))
    assert {r.c for r in java.collect()} <= {*WHITE_SPACE}


def test_oddities(odd, none):
    with pytest.raises(ValueError):
        remove_lines(odd, find_duplicate_lines(odd))
    assert find_duplicate_lines(odd).count() == odd.count()
    assert find_duplicate_lines(none).count() == 0
