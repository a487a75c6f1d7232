import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from wardframe.llm.quality_rules import _chi2_cdf, _half_factor, robust_outliers, text_counts, with_counts


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    grams = Counter(zip(words, words[1:], words[2:]))
    inside = set()
    for i in range(len(words) - 2):
        if grams[tuple(words[i : i + 3])] > 1:
            inside |= {i, i + 1, i + 2}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(inside), len(lines)


def test_counts_match_definition():
    rng = random.Random(1)
    for _ in range(400):
        text = "".join(rng.choices(["a", "b", "é", "b#", " ", "  ", "\n", "\t", "\x0b", "\x85", " ", "<|>", "ab a b"], k=rng.randrange(60)))
        assert text_counts(text) == brute(text), repr(text)
    assert text_counts(None) == text_counts("") == (0,) * 6


def test_chi_square_factors():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(200_000, 5))
    d = (x**2).sum(1)
    assert abs(_chi2_cdf(4.35146, 5) - 0.5) < 1e-4
    near = x[d <= np.quantile(d, 0.5)]
    assert abs(near.var(0).mean() - _half_factor(0.5)) < 0.01


@pytest.fixture
def prose():
    rng = random.Random(7)
    words = ["".join(rng.choices("abcdefghij", k=rng.randrange(2, 9))) for _ in range(400)]
    return lambda n: " ".join(rng.choices(words, k=n)) if n else ""


def test_outliers_go_and_usual_texts_stay(documents, prose):
    rng = random.Random(8)
    rows = [(k, prose(rng.randrange(60, 400)), "en", "hot" if k % 3 else f"s{k % 40}") for k in range(700)]
    rows += [(1000 + k, " ".join(w + "###" for w in prose(120).split()), "en", "hot") for k in range(30)]
    rows += [(2000, None, None, None), (2001, "", "en", "hot"), (2002, "few words", "en", "hot"), (2003, "again and " * 60, "en", "hot"), (2004, prose(300), None, None)]
    counted = with_counts(documents(rows, {"kept": F.lit(1), "pool": F.lit("x")}))
    out = {r.record.doc_id: r for r in robust_outliers(counted, "record.lang", "record.source").collect()}
    assert len(out) == len(rows)
    assert not any(out[1000 + k].kept for k in range(30)) and not any(out[1000 + k].base_failed for k in range(30))
    assert sum(out[k].kept for k in range(700)) >= 699
    assert [out[k].base_failed for k in range(2000, 2005)] == [True] * 4 + [False] and out[2004].kept
    assert not any(out[k].kept for k in range(2000, 2004))


def test_each_axis_can_reject_by_itself(documents, prose):
    rng = random.Random(9)
    lines = lambda n: [prose(rng.randrange(6, 14)) for _ in range(n)]
    rows = [(k, "\n".join(lines(rng.randrange(8, 40))), "en", "s") for k in range(600)]
    some = lambda text: " ".join(w + "##" * (rng.random() < 0.3) for w in text.split(" "))
    doubled = lambda text: "\n".join(f"{x}\nread on" for x in text.split("\n"))
    phrases = lambda text: " ".join(f"{w} of all the things we saw" if k % 9 == 0 else w for k, w in enumerate(text.split()))
    for k in range(20):
        plain = "\n".join(lines(20))
        rows += [(1000 + k, some(plain), "en", "s"), (2000 + k, doubled(plain), "en", "s"), (3000 + k, phrases(plain), "en", "s")]
    out = {r.record.doc_id: r for r in robust_outliers(with_counts(documents(rows)), "record.lang", "record.source").collect()}
    assert not any(r.base_failed for r in out.values())
    for bad in (1000, 2000, 3000):
        assert not any(out[bad + k].kept for k in range(20)), bad
    assert sum(out[k].kept for k in range(600)) >= 597


def test_constant_group_and_empty_table(documents):
    text = " ".join(f"w{k}" for k in range(80))
    same = robust_outliers(with_counts(documents([(k, text) for k in range(250)])), "record.lang", "record.source").collect()
    assert all(r.kept for r in same) and len(same) == 250
    assert robust_outliers(with_counts(documents([])), "record.lang", "record.source").collect() == []


def test_rows_of_pools_that_are_too_small_are_kept(documents, prose):
    """Nine rows are no estimate: a text far from the others stays, without a distance, until ``least`` is met."""
    rows = [(k, prose(100 + k), "en", "s") for k in range(8)] + [(8, " ".join(w + "###" for w in prose(100).split()), "fr", "t")]
    counted = with_counts(documents(rows))
    few = robust_outliers(counted, "record.lang", "record.source").collect()
    assert len(few) == 9 and all(r.kept and r.distance is None for r in few)
    own = robust_outliers(counted, "record.lang", "record.source", least=9).collect()
    assert all(r.distance is not None for r in own) and [r.record.doc_id for r in own if not r.kept] == [8]
