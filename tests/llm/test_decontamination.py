import random

import numpy as np
from pyspark.sql import functions as F

from wardframe.llm.decontamination import Index, align, benchmark_matches, code_points, decontaminated, fold, op4_benchmark_decontamination, qgrams

LETTERS = "abcdefghijklmnopqrstuvwxyzäé "


def prose(rng, n):
    return "".join(rng.choices(LETTERS, k=n))


def edited(rng, text, n):
    c = list(text)
    for _ in range(n):
        at = rng.randrange(len(c))
        c[at : at + 1] = rng.choice([[], [rng.choice(LETTERS)], [c[at], rng.choice(LETTERS)]])
    return "".join(c)


def distance(a, b):
    """Fewest edits between a and any part of b, cell by cell."""
    row = [0] * (len(b) + 1)
    for i, x in enumerate(a, start=1):
        new = [i]
        for j, y in enumerate(b, start=1):
            new.append(min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (x != y)))
        row = new
    return min(row)


def test_qgrams_are_equal_where_texts_are():
    for q in (2, 5, 8, 9, 13):
        a, b = qgrams(code_points("zxabcdefghijklmnop"), q), qgrams(code_points("abcdefghijklmnopyw"), q)
        assert len(a) == 18 - q + 1
        assert (a[2:] == b[: len(a) - 2]).all()
        assert len(np.unique(np.concatenate([a, b]))) == len(a) + 2


def test_alignment_matches_plain_dynamic_programming():
    rng = random.Random(1)
    for _ in range(150):
        a = prose(rng, rng.randrange(5, 30))
        b = prose(rng, rng.randrange(0, 20)) + edited(rng, a, rng.randrange(6)) + prose(rng, 10)
        assert align(a, b, 99)[0] == distance(a, b)


def test_no_region_within_the_budget_is_missed():
    rng = random.Random(2)
    items = [(k, prose(rng, rng.randrange(30, 320))) for k in range(40)]
    index = Index(items)
    for _ in range(250):
        k = rng.randrange(len(index.segments))
        segment, budget = index.segments[k], int(index.budget[k])
        text = fold(prose(rng, 200) + " " + edited(rng, segment, rng.randrange(budget + 4)) + " " + prose(rng, 200))
        within = distance(segment, text) <= budget
        assert (index.items[k] in [m[0] for m in index.matches(text)]) >= within
    assert not any(index.matches(prose(rng, 3000)) for _ in range(20))


def test_any_half_of_an_item_is_found():
    rng = random.Random(5)
    items = [(n, fold(prose(rng, n))) for n in (*range(60, 420, 4), 81, 159, 161, 200, 239, 1001)]
    index = Index(items)
    for k, text in items:
        half = (len(text) + 1) // 2
        for at in {0, len(text) - half, *(rng.randrange(len(text) - half + 1) for _ in range(6))}:
            for stretch in (text[at : at + half], edited(rng, text[at : at + half], 1)):
                found = [m[0] for m in index.matches(prose(rng, 150) + "q" + stretch + "q" + prose(rng, 150))]
                assert k in found, (k, at)
    # Of a short item, every stretch that is long enough to be evidence.
    short = Index([(1, "".join(rng.sample("abcdefghijklmnopqrstuvwxyz0123456789äéüöçñ", 40)))])
    assert all(short.matches("#" * 50 + short.segments[0][at : at + 30] + "#" * 50) for at in range(11))


def test_blocks_give_the_same_result_and_columns_stay(documents, spark):
    rng = random.Random(3)
    items = [(k, prose(rng, 150)) for k in range(12)]
    benchmark = spark.createDataFrame(items + [(3, items[3][1]), (None, "x" * 90), (77, None), (78, "short")], "item_id long, text string")
    rows = [(k, prose(rng, 300) + (items[k % 12][1].upper() if k % 3 == 0 else "") + prose(rng, 300)) for k in range(30)]
    rows += [(100, None), (101, ""), (0, rows[0][1])]
    docs = documents(rows, {"matches": F.lit("clash")})
    found = lambda size: sorted((r.record.doc_id, [m.item_id for m in r.matches]) for r in benchmark_matches(docs, benchmark, ["doc_id"], block_chars=size).collect())
    one = found(10**9)
    assert one == found(400)
    assert one == sorted((d, [d % 12] if d < 30 and d % 3 == 0 else []) for d, _ in rows)
    clean = decontaminated(docs, benchmark)
    assert clean.columns == docs.columns
    assert sorted(r.doc_id for r in clean.collect()) == sorted(d for d, _ in rows if not (d < 30 and d % 3 == 0))


def test_query_and_empty_tables(documents, stored, spark):
    benchmark = spark.createDataFrame([], "item_id long, text string")
    assert op4_benchmark_decontamination(spark, stored(documents=documents([(1, "some text")]), benchmark=benchmark)).collect() == []
