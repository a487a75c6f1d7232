import random

import corpus_pipeline
import __spark_entry__ as entry

from wardframe.llm.queries import ORACLES, QUERIES


def test_registered_once_each():
    names = entry.queries()
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 11)] == [1] * 10
    assert set(QUERIES) | {"pipeline"} <= set(names) and set(ORACLES) <= set(QUERIES)


def test_stages_take_effect(documents, stored, spark):
    rng = random.Random(1)
    words = ["".join(rng.choices("abcdefghijklm", k=rng.randrange(2, 9))) for _ in range(600)]
    prose = lambda n: " ".join(rng.choices(words, k=n))
    passage, item = prose(60), prose(40)
    rows = [(k, prose(rng.randrange(60, 200))) for k in range(300)]
    junk = [(400 + k, " ".join(w.upper() + "!!" for w in prose(80).split())) for k in range(60)]
    near = (500, rows[0][1] + " extra")
    cut = [(501, prose(90) + " " + passage), (502, prose(90) + " " + passage)]
    leak = (503, prose(100) + " " + item + " " + prose(50))
    sf = stored(
        documents=documents(rows + junk + [near, *cut, leak]),
        labels=spark.createDataFrame([(k, 1, 0) for k in range(300)] + [(400 + k, 0, 0) for k in range(60)], "doc_id long, quality int, toxic int"),
        benchmark=spark.createDataFrame([(1, item)], "item_id long, text string"),
    )
    docs, seen = spark.read.parquet(f"{sf}/documents.parquet"), []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, sf)
        if k < 4:
            assert out.columns == docs.columns
        out.write.parquet(f"{sf}/out{k}")
        docs = spark.read.parquet(f"{sf}/out{k}")
        seen.append({r.doc_id: r for r in docs.collect()})
    good, single, whole, clean, packed = seen
    assert sum(k in good for k in range(300)) >= 297 and sum(400 + k in good for k in range(60)) <= 3
    assert 0 in single and 500 not in single and {501, 502, 503} <= set(single)
    assert passage in whole[501].text and passage not in whole[502].text and whole[502].n_chars == len(whole[502].text)
    assert 503 not in clean and set(clean) == set(whole) - {503} and set(packed) == set(clean)
    rerun = corpus_pipeline.run(spark, sf)
    assert {r.doc_id for r in rerun.collect()} == set(packed)
