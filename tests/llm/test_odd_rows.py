"""Every query and stage, by its registered name, over a table of odd rows: nulls in every column, shared ids, a text above every chunk size, clashing columns."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from lakeknot.llm import automaton, language, media, quality, registry, wordbpe
from lakeknot.llm.common import column, read_table

r = random.Random(17)
WORDS = ["".join(r.choice("abcdefghiklmnoprstu") for _ in range(r.randrange(2, 9))) for _ in range(4000)]
PASSAGE = "these words stand in several documents and they are over fifty bytes long, "


def prose(n):
    return " ".join(r.choice(WORDS) for _ in range(n))


LONG = prose(900_000)[: 5 << 20] + PASSAGE + prose(10)
BASE = prose(80)
#: (doc_id, text): the long text has the largest id.
ROWS = [(None, BASE), (None, None), (1, None), (2, ""), (3, BASE), (4, BASE + " more"), (5, PASSAGE + prose(20)), (6, prose(9) + PASSAGE), (7, prose(60)), (7, prose(60)), (8, BASE), (8, BASE), (9, "x"), (90, LONG)]
EXTRA = {"kept": "k", "ranges": "r", "n_bytes": "5", "__id": "i", "__scored": "s", "_held_out": "h", "a.b": "dot", "row": None, "tie": "t", "Copy": "c", "held": "z", "rank": None}


@pytest.fixture(scope="module")
def odd_dir(spark, tmp_path_factory):
    at = str(tmp_path_factory.mktemp("odd"))
    names = ", ".join(f"`{c}` string" for c in EXTRA)
    rows = [(i, t, None if k % 2 else "en", None, len(t or ""), *EXTRA.values()) for k, (i, t) in enumerate(ROWS)]
    docs = spark.createDataFrame(rows, f"doc_id long, text string, lang string, source string, n_chars long, {names}")
    docs.repartition(3).write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame([(3, 1), (5, None), (None, 1), (6, 0), (6, 0), (7, 1)], "doc_id long, quality int").write.parquet(f"{at}/labels.parquet")
    spark.createDataFrame([(0, [1.0, 2.0]), (None, [1.0, 1.0]), (50, None), (50, [0.5, 0.5]), (3, [1.0, None]), (4, [2.0, 1.0]), (4, [2.0, 1.0])], "vec_id long, embedding array<float>").write.parquet(f"{at}/embeddings.parquet")
    return at


def run(spark, name, at):
    return registry.QUERIES[name](spark, at).collect()


def test_token_queries(spark, odd_dir):
    library = wordbpe.encoder(wordbpe.vocabulary()).library
    ids = [(i, library.encode(t or "", add_special_tokens=False).ids + [1]) for i, t in ROWS]
    crc = lambda x: zlib.crc32(np.array(x, "<u4").tobytes())
    rows = run(spark, "op9_token_id_files", odd_dir)
    assert Counter((x["doc_id"], x["n_tokens"], x["ids_crc32"]) for x in rows) == Counter((i, len(x), crc(x)) for i, x in ids)
    at = 0
    for x in sorted(rows, key=lambda x: x["start"]):
        assert x["start"] == at
        at += x["n_tokens"]
    order = [x["doc_id"] for x in sorted(rows, key=lambda x: x["start"])]
    assert order == sorted(order, key=lambda i: (i is not None, i))
    rows = run(spark, "op1_best_fit_packing", odd_dir)
    want = [(i, k, 4096 * k, len(x[4096 * k : 4096 * k + 4096]), crc(x[4096 * k : 4096 * k + 4096])) for i, x in ids for k in range(-(-len(x) // 4096))]
    assert Counter(tuple(x)[:5] for x in rows) == Counter(want)
    fill = Counter()
    for x in sorted(rows, key=lambda x: (x["sequence_id"], x["offset"])):
        assert x["offset"] == fill[x["sequence_id"]]
        fill[x["sequence_id"]] += x["length"]
    assert max(fill.values()) <= 4096


def test_codec_query(spark, odd_dir):
    from tokenizers import Tokenizer

    library, want = Tokenizer.from_file(automaton.vocabulary()), Counter()
    for i, t in ROWS:
        ids = library.encode(t or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        want[i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()] += 1
    assert Counter(tuple(x)[:4] for x in run(spark, "op2_bpe_automaton", odd_dir)) == want


def naive_feature(payload):
    """Peaks and pairs by a plain transform of every frame."""
    x = np.array([payload[abs(k) if k < len(payload) else 2 * len(payload) - 2 - k] for k in range(-media.FRAME // 2, len(payload) + media.FRAME // 2)], float) - 128
    hann = np.array([0.5 - 0.5 * np.cos(2 * np.pi * k / media.FRAME) for k in range(media.FRAME)])
    turn = np.exp(-2j * np.pi * np.outer(np.arange(media.FRAME // 2 + 1), np.arange(media.FRAME)) / media.FRAME)
    power = [np.abs(turn @ (x[a : a + media.FRAME] * hann)) ** 2 for a in range(0, len(x) - media.FRAME + 1, media.HOP)]
    peaks = [[lo + int(p[lo:hi].argmax()) for lo, hi in media.BANDS] for p in power]
    out = []
    for at in range(len(peaks)):
        for gap in range(media.FAN + 1):
            for k in range(len(media.BANDS)):
                if at + gap < len(peaks):
                    out.append((at * media.HOP * 1000 // media.RATE, k << 18 | peaks[at][k] << 10 | peaks[at + gap][(k + 1) % 3] << 2 | gap))
    return out


def test_media_query(spark, odd_dir):
    want = Counter()
    for i, t in ROWS:
        raw = (t or "").encode()
        payload = raw.ljust(max(192, -(-len(raw) // 192) * 192))
        want[i, len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:])] += 1
    assert Counter(tuple(x)[:5] for x in run(spark, "op7_media_columns", odd_dir)) == want
    docs = spark.createDataFrame([(1, BASE)], "doc_id long, text string")
    got = media.fingerprint(media.to_wav(docs)).head()
    raw = BASE.encode()
    assert list(zip(got["time_ms"], got["code"], strict=True)) == naive_feature(raw.ljust(-(-len(raw) // 192) * 192))


def test_join_query(spark, odd_dir):
    def shingles(t):
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").lower())
        return {tuple(w[k : k + 4]) for k in range(len(w) - 3)} if len(w) >= 4 else ({tuple(w)} if w else set())

    rows = Counter(map(tuple, run(spark, "op8_ngram_jaccard_join", odd_dir)))
    sizes = [(i, len(shingles(t))) for i, t in ROWS]
    group = {3: 3, 4: 3, 8: 3}
    assert rows == Counter((i, n, None if i is None else group.get(i, i)) for i, n in sizes)


def test_repeats_query(spark, odd_dir):
    seen, want = set(), Counter()
    for i, t in sorted(ROWS, key=lambda x: (x[0] is not None, x[0])):
        raw = (t or "").encode()
        keep = np.ones(len(raw), bool)
        for k in range(len(raw) - 49 if i is not None else 0):
            if raw[k : k + 50] in seen:
                keep[k : k + 50] = False
        if i is not None and i < 90 and i != 7 and i != 8:
            seen.update(raw[k : k + 50] for k in range(len(raw) - 49))
        want[i, len(raw), int((~keep).sum()), hashlib.sha256(bytes(np.frombuffer(raw, np.uint8)[keep])).hexdigest()] += 1
    got = run(spark, "op10_suffix_array_dedup", odd_dir)
    assert Counter((x["doc_id"], x["n_bytes"], x["n_removed"], x["kept_sha256"]) for x in got) == want


def test_other_queries(spark, odd_dir):
    ids = Counter(i for i, _ in ROWS)
    for name in ("op3_license_scan", "op4_quality_classifier", "op6_language_id"):
        rows = run(spark, name, odd_dir)
        assert Counter(x["doc_id"] for x in rows) == ids, name
        assert all(0 <= x["score"] <= 1 for x in rows), name
    pairs = sorted((x["query_id"], x["rank"], x["vec_id"], x["score"]) for x in run(spark, "op5_exact_top_k", odd_dir))
    assert pairs == [(0, 1, 4, 262144), (0, 2, 4, 262144), (0, 3, 50, 98304), (50, 1, 0, 98304), (50, 2, 4, 98304), (50, 3, 4, 98304)]


def test_quality_features_and_language_network_by_plain_loops():
    texts = ["ab ab, cd ab", "", "x", "é日🙂 ab"]
    raw = [t.encode() for t in texts]
    off = np.cumsum([0, *map(len, raw)])
    data = np.frombuffer(b"".join(raw), np.uint8)
    parts = quality.features(data, off)
    for k, t in enumerate(texts):
        alone = quality.features(np.frombuffer(raw[k], np.uint8), np.array([0, len(raw[k])]))
        words = t.split()
        n = sum(max(0, len(t) - g + 1) for g in quality.GRAMS) + len(words) + sum(a == b for lag in quality.LAGS for a, b in zip(words, words[lag:], strict=False))
        both = [np.concatenate([b[at[j] : at[j + 1]] for b, at in some]).tolist() for some, j in ((parts, k), (alone, 0))]
        assert both[0] == both[1]
        assert len(both[0]) == n
    g = np.random.default_rng(3)
    win = g.integers(0, 256, (6, language.WINDOW)).astype(np.uint8)
    net = language.train(win, np.array([0, 1, 2, 0, 1, 2]), ["a", "b", "c"])
    for w, p in zip(win, net.probabilities(win), strict=True):
        x = net.embed[w]
        top = [max(float((x[i : i + language.SPAN].ravel() * net.filters[:, f]).sum()) for i in range(language.WINDOW - language.SPAN + 1)) for f in range(net.filters.shape[1])]
        z = np.maximum(np.array(top) + net.bias, 0) @ net.out + net.out_bias
        assert np.allclose(np.exp(z - z.max()) / np.exp(z - z.max()).sum(), p, atol=1e-4)


def test_stages(spark, odd_dir):
    docs = read_table(spark, odd_dir, "documents")
    for table in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            after = stage(spark, table, odd_dir)
            assert after.columns == docs.columns, name
            rows = after.select(column("doc_id"), column("a.b")).collect()
            assert {x[1] for x in rows} <= {"dot"}, name
            if table is docs and name in ("near", "repeats"):
                assert Counter(x[0] for x in rows) == Counter(i for i, _ in ROWS if name == "repeats" or i not in (4, 8)), name
    assert corpus_pipeline.STAGES[-1][1](spark, docs.limit(0), odd_dir).count() == 0


def test_fingerprints_of_short_texts(spark):
    texts = ["", "x", "a short text", "another short text of other words", "Line 1\nLine 2, and so on until here: 192 bytes are not reached"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = media.fingerprint(media.to_wav(docs)).collect()
    assert all(len(r["code"]) == len(r["time_ms"]) > 0 for r in rows)
    assert len({tuple(r["code"]) for r in rows if r["doc_id"] > 1}) == 3


def test_every_place_in_a_frame_reaches_a_peak():
    samples = np.random.default_rng(3).integers(32, 127, 40 * 192).astype(np.uint8)
    codes = media.peak_pairs(media.peak_bins(samples))[1].tolist()
    for at in range(192):
        other = samples.copy()
        other[at::192] = 255
        assert media.peak_pairs(media.peak_bins(other))[1].tolist() != codes, at
