import hashlib
import random

import pytest
from pyspark.sql import functions as F

from wardframe.llm.substring_dedup import removed_words, without_repeats


def brute(rows, window):
    words = [(d, (t or "").split()) for d, t in rows]
    first = {}
    for d, w in words:
        for s in range(len(w) - window + 1):
            key, at = tuple(w[s : s + window]), (-1 if d is None else d, s)
            first[key] = min(first.get(key, at), at)
    out = []
    for d, w in words:
        gone = [False] * len(w)
        for s in range(len(w) - window + 1):
            if first[tuple(w[s : s + window])] < (-1 if d is None else d, s):
                gone[s : s + window] = [True] * window
        kept = [x for x, g in zip(w, gone) if not g]
        out.append((d, len(w), sum(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest()))
    return out


def corpus(seed):
    rng = random.Random(seed)
    words = [f"w{k}é" for k in range(30)]
    passages = [rng.choices(words, k=rng.randrange(18, 70)) for _ in range(6)]
    rows = []
    for k in range(60):
        text = rng.choices(words, k=rng.randrange(0, 60))
        for _ in range(rng.randrange(0, 4)):
            at = rng.randrange(len(text) + 1)
            text[at:at] = rng.choice(passages)
        rows.append((k, "  ".join(text)))
    return rows + [(100 + k, rows[k][1]) for k in range(8)] + [(200, "same " * 70), (201, None), (202, ""), (None, rows[9][1]), (None, "null id first " * 10)]


@pytest.mark.parametrize("seed,window,gram", [(1, 20, 8), (2, 20, 8), (3, 6, 3)])
def test_matches_definition(documents, seed, window, gram):
    rows = corpus(seed)
    random.Random(seed).shuffle(rows)
    got = removed_words(documents(rows, {"th": F.lit(1), "rid": F.lit("a")}), window, gram).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(brute(rows, window), key=repr)


def test_repeated_rows_agree(documents):
    text = " ".join(f"a{k}" for k in range(40))
    got = removed_words(documents([(1, text), (1, text), (2, text)])).collect()
    assert sorted((r.doc_id, r.n_removed) for r in got) == [(1, 0), (1, 0), (2, 40)]


def test_kept_texts(documents):
    passage = " ".join(f"p{k}" for k in range(25))
    docs = documents([(1, "begin\n" + passage), (2, "other " + passage + " end"), (3, passage), (4, None), (5, "a\n b")])
    got = {r.record.doc_id: (r.kept_text, r.n_removed) for r in without_repeats(docs).collect()}
    assert got == {1: ("begin\n" + passage, 0), 2: ("other end", 25), 3: ("", 25), 4: (None, 0), 5: ("a\n b", 0)}


def test_empty_table(documents):
    assert removed_words(documents([])).collect() == []
