"""The k best of a token join: as by brute force, without a row for each pair."""

import math
import random
from collections import Counter, defaultdict

import pytest

from lakeknot.operators import retrieve, topk


def tables(n: int, seed: int):
    """Rows (country, id, sig, k) of queries and documents with few, mostly frequent tokens, equal texts, ties and odd rows."""
    rng = random.Random(seed)
    sig = lambda: sorted({f"t{int(rng.random() ** 2 * 12)}" for _ in range(rng.randrange(6))} | {f"r{rng.randrange(n)}"} | {"all"})
    docs = [(rng.choice("AB"), f"d{i}", sig() if i % 9 else ["all"]) for i in range(n)] + [("A", "empty", []), (None, "nowhere", ["t1"]), ("C", "alone", ["t1", "t2"])]
    queries = [(rng.choice("AB"), f"q{i}", sig() if i % 7 else ["all"], rng.choice((1, 3, 7))) for i in range(n)] + [("A", "none", [], 3), (None, "nowhere", ["t1"], 3), ("C", "one", ["t1", "x"], 7), ("D", "lost", ["t1"], 3), ("A", "dull", None, 3)]
    return queries, docs


def brute(queries, docs, maxdf, r, most, norm=True):
    out = set()
    for country in {c for c, *_ in queries} - {None}:
        own = [(i, s) for c, i, s in docs if c == country]
        df = Counter(t for _, s in own for t in s)
        idf = {t: math.log(len(own) / n) for t, n in df.items() if n <= maxdf}
        held = [(i, [t for t in s if t in idf]) for i, s in own]
        for c, query, s, k in queries:
            if c != country:
                continue
            asked = sorted((t for t in s or [] if t in idf), key=lambda t: (df[t], t))[:r]
            asked = [t for n, t in enumerate(asked) if n == 0 or idf[t] > 0]
            scores = defaultdict(float)
            for i, have in held:
                for t in asked:
                    if t in have:
                        scores[i] += idf[t] / (math.sqrt(len(have)) if norm else 1)
            best = sorted(((-round(x, 6), i) for i, x in scores.items()))[: min(k, most)]
            out |= {(country, query, i, -x, n) for n, (x, i) in enumerate(best, 1)}
    return out


@pytest.mark.parametrize(("maxdf", "r", "norm", "limits"), [(1000, 28, True, {}), (60, 4, True, {}), (1000, 28, False, {"POSTINGS": 150, "QUERIES": 40, "TOKENS": 200}), (1000, 28, True, {"VOCABULARY_MOST": 0})])
def test_best_are_those_of_all_pairs(spark, monkeypatch, maxdf, r, norm, limits):
    for name, value in limits.items():
        monkeypatch.setattr(topk, name, value)
    queries, docs = tables(240, maxdf + r)
    found = retrieve.search(spark.createDataFrame(queries, "country string, id string, sig array<string>, k int"), spark.createDataFrame(docs, "country string, id string, sig array<string>"), maxdf, r, 5, norm)
    assert sorted((x["country"], x["query"], x["id"], x["score"], x["rn"]) for x in found.collect()) == sorted(brute(queries, docs, maxdf, r, 5, norm))


def test_opens_further_tokens_where_the_first_do_not_do():
    """Blocks with few opened tokens find what brute force finds."""
    import numpy as np
    import pyarrow as pa

    rng = np.random.default_rng(1)
    weights = np.log(400 / np.arange(4, 44)).clip(0.1)
    toks = [np.unique((rng.random(rng.integers(1, 8)) ** 0.4 * 40).astype(np.int32)) for _ in range(400)]
    rows = pa.table({"id": pa.array(range(400)), "toks": pa.array([t.tolist() for t in toks], pa.list_(pa.int32()))})
    block = topk.Block(topk._block(9)((pa.scalar("A"), pa.scalar(0)), rows)["block"][0].as_py(), weights.tobytes(), True, 9)
    for p in (1, 2):
        for asked in toks[:150]:
            got = block.best(asked, min(p, len(asked)), 9)
            scores = topk.rounded(np.array([weights[np.intersect1d(t, asked)].sum() / np.sqrt(len(t)) for t in toks]))
            order = [i for i in np.lexsort((np.arange(400), -scores))[:9] if scores[i] > 0]
            assert (got[0].tolist(), got[1].tolist()) == (order, scores[order].tolist())


def test_pairs_are_no_rows(spark, monkeypatch):
    """Records whose rarest tokens are frequent: what is written between the steps grows with the input, not with the pairs."""
    rows = [("A", f"{i}", [f"a{i % 20}", f"b{i // 20 % 20}", f"c{i % 3}"]) for i in range(1200)]
    written, write = [], retrieve.scratch

    def counting(made, name):
        out = write(made, name)
        written.append(out.count())
        return out

    for module in (retrieve, topk):
        monkeypatch.setattr(module, "scratch", counting)
    docs = spark.createDataFrame(rows, "country string, id string, sig array<string>")
    assert retrieve.search(docs, docs, 60_000, 28, 3).count() == 3600
    assert max(written) <= 3 * len(rows)


def test_scores_are_completed_by_the_fewer_entries():
    """Long documents that share an opened token: the others' short lists are read, not all that the documents hold."""
    import numpy as np
    import pyarrow as pa

    n, vocabulary = 300, 20_000
    rng = np.random.default_rng(3)
    # token 0 is in every third document, 1 to 9 in some, the others fill the documents up
    toks = [np.unique(np.concatenate([[0] * (i % 3 == 0), rng.choice(np.arange(1, 10), 2), rng.integers(10, vocabulary, 400)])).astype(np.int32) for i in range(n)]
    weights = rng.uniform(1, 3, vocabulary)
    rows = pa.table({"id": pa.array(range(n)), "toks": pa.array([t.tolist() for t in toks], pa.list_(pa.int32()))})
    block = topk.Block(topk._block(5)((pa.scalar("A"), pa.scalar(0)), rows)["block"][0].as_py(), weights.tobytes(), True, 5)
    block.toks = None
    asked = np.arange(10, dtype=np.int32)
    scores = topk.rounded(np.array([weights[np.intersect1d(t, asked)].sum() / np.sqrt(len(t)) for t in toks]))
    order = np.lexsort((np.arange(n), -scores))[:5]
    for _ in range(2):  # the second finds the sums as the first did
        got = block.best(asked, 1, 5)
        assert (got[0].tolist(), got[1].tolist()) == (order.tolist(), scores[order].tolist())


def test_shared_further_tokens_are_summed_once(monkeypatch):
    """Queries with the same further tokens find what brute force finds, and the postings of these are read once for all."""
    import numpy as np
    import pyarrow as pa

    rng = np.random.default_rng(3)
    weights = np.log(400 / np.arange(4, 44)).clip(0.1)
    toks = [np.unique((rng.random(rng.integers(1, 8)) ** 0.4 * 40).astype(np.int32)) for _ in range(400)]
    rows = pa.table({"id": pa.array(range(400)), "toks": pa.array([t.tolist() for t in toks], pa.list_(pa.int32()))})
    block = topk.Block(topk._block(9)((pa.scalar("A"), pa.scalar(0)), rows)["block"][0].as_py(), weights.tobytes(), True, 9)
    read, completed = [], block.completed
    monkeypatch.setattr(block, "completed", lambda *a: read.append(1) or completed(*a))
    for rest in ([30, 33, 38], [25], [36, 37, 38, 39], []):
        for first in ([0], [1, 2], [3, 9, 20], [5, 6]):
            asked = np.array(first + rest, np.int32)
            got = block.best(asked, len(first), 9, True)
            scores = topk.rounded(np.array([weights[np.intersect1d(t, asked)].sum() / np.sqrt(len(t)) for t in toks]))
            order = [i for i in np.lexsort((np.arange(400), -scores))[:9] if scores[i] > 0]
            assert (got[0].tolist(), got[1].tolist()) == (order, scores[order].tolist())
    assert not read


def test_a_small_index_is_searched_by_many_tasks(spark):
    """5,000 queries of a few documents are no work of a single task."""
    docs = spark.createDataFrame([("A", i, [f"a{i % 7}", f"b{i}"]) for i in range(40)], "country string, id long, sig array<string>")
    asked = spark.createDataFrame([("A", i, [f"a{i % 7}", f"b{i % 40}"], 1) for i in range(5000)], "country string, id long, sig array<string>, k int")
    found = retrieve.search(asked, docs, 1000, 28, 1)
    tasks = found.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()
    assert sum(tasks) == 5000 and sum(n > 0 for n in tasks) > 1
