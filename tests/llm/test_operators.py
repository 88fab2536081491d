"""Every operator over a small table of odd rows: nulls, empty and long texts, ties, repeated rows, clashing columns, no rows."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from lakeknot.llm import automaton, covertree, graph, idfiles, language, licenses, media, ngramjoin, packing, quality, substrings, wordbpe
from lakeknot.llm.common import read_table

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, predicted string, rank int"
rng = random.Random(5)
VOCAB = ["".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 7))) for _ in range(300)]


def prose(n):
    return " ".join(rng.choice(VOCAB) for _ in range(n))


BASE, LONG = prose(60), prose(3000)
PASSAGE = "this passage of over fifty bytes stands in several documents, " * 2
TEXTS = [
    None, "", " \n\t", "x", "...", "42", "a b c", BASE, BASE, BASE.upper(), BASE + " tail", "head " + BASE, LONG, LONG + " more",
    PASSAGE + prose(30), prose(20) + PASSAGE + prose(5), "Straße ÉTÉ İstanbul Σας 日本語 😀 \x1c\x85 ñ", "<|endoftext|> a <|startoftext|>b", "don't WE'LL  it's 12½",
    "Released under the MIT License. MIT license apache LICENSE", "This work is licensed under the GNU General Public License, version 3.", "A" * 5000, "ab" * 3000, " ".join(["w"] * 500),
]
near = BASE.split()
for k in range(80):  # a group of near copies, longer than a short index list
    words = list(near)
    words[rng.randrange(60)] = f"new{k}"
    TEXTS.append(" ".join(words))
ROWS = [(i, t, "en" if i % 2 else None, "s", 0, 0.5, "p", 1) for i, t in enumerate(TEXTS)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3).persist()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def word_ids():
    library = wordbpe.encoder(wordbpe.vocabulary()).library
    return {i: library.encode(t or "", add_special_tokens=False).ids + [1] for i, t in enumerate(TEXTS)}


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_packing(docs, none, word_ids):
    rows = packing.pack_documents(docs, wordbpe.vocabulary(), capacity=512).collect()
    by_doc, by_seq = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_seq.setdefault(r["sequence_id"], []).append(r)
        assert r["ids_crc32"] == crc(word_ids[r["doc_id"]][r["start"] : r["start"] + r["length"]])
    for d, ids in word_ids.items():
        parts = sorted(by_doc[d], key=lambda r: r["piece"])
        assert [p["start"] for p in parts] == list(range(0, len(ids), 512))
        assert sum(p["length"] for p in parts) == len(ids)
    for parts in by_seq.values():
        at = 0
        for p in sorted(parts, key=lambda r: r["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= 512
    # beside a piece that leaves no room for m, no other of at least m; of these at most k elsewhere
    bound = -(-sum(map(len, word_ids.values())) // 512)
    for k in range(1, 6):
        m = 512 // (k + 1) + 1
        alone = sum(r["length"] > 512 - m for r in rows)
        bound = max(bound, alone + -(-sum(m <= r["length"] <= 512 - m for r in rows) // k))
    assert len(by_seq) <= bound + 1
    assert packing.pack_documents(none, wordbpe.vocabulary()).count() == 0


def test_genetic_steps_keep_every_piece():
    g = np.random.default_rng(1)
    p = packing.Packer(g.integers(1, 60, 400), 100, 2)
    first = p.first()
    child = p.cross(first, p.mutate(first))
    for genome in (first, child, *p.evolve([], 5)):
        assert len(genome) == 400
        assert p.fills(genome).max() <= 100
        assert len(np.unique(genome)) == genome.max() + 1


def test_evolution_beats_best_fit():
    """Lengths that best fit packs badly: triples that fill a sequence exactly, and evenly spread ones."""
    g = np.random.default_rng(0)
    a = g.integers(380, 490, 20)
    b = np.array([g.integers(250, (1000 - x) // 2 + 1) for x in a])
    for lengths, capacity in ((np.concatenate([a, b, 1000 - a - b]), 1000), (np.random.default_rng(0).integers(20, 101, 120), 150)):
        p = packing.Packer(lengths, capacity, 0)
        first, best = p.first(), p.evolve([], 200)[0]
        assert p.bound <= best.max() + 1 < first.max() + 1
        assert p.fills(best).max() <= capacity


def test_shards_share_their_last_sequences(spark):
    """Each of many small shards would leave a sequence nearly empty."""
    pieces = spark.createDataFrame([(i, 0, 0, 30, 0) for i in range(400)], "doc_id long, piece int, start long, length long, ids_crc32 long")
    rows = packing.pack(pieces, capacity=300, shard_pieces=25).collect()
    fill = Counter()
    for r in rows:
        fill[r["sequence_id"]] += r["length"]
    assert len(rows) == 400
    assert len({(r["sequence_id"], r["offset"]) for r in rows}) == 400
    assert max(fill.values()) <= 300
    assert len(fill) <= 42


def test_word_encoder():
    """Random Latin-1 texts, marks, apostrophes, special tokens and other scripts against the library."""
    made, r = wordbpe.encoder(wordbpe.vocabulary()), random.Random(8)
    kinds = ["".join(map(chr, range(256))), "ab's.,t'!é \n1½ÀçµªºÿßÉ\xa0\x85\x1c\x0b", "don't l'autre s're ve'll ''!s1's", "abc<| |>ﬁ日🙂é "]
    texts = ["", "x" * 30000, "!" * 500, *["".join(r.choice(r.choice(kinds)) for _ in range(r.randrange(60))) for _ in range(1500)]]
    texts += ["".join(r.choice(k) for _ in range(r.randrange(60))) for k in kinds for _ in range(1500)]
    for t, ids in zip(texts, made.encode_texts(texts), strict=True):
        assert ids.tolist() == made.library.encode(t, add_special_tokens=False).ids


def test_automaton(docs, none):
    library = Tokenizer.from_file(automaton.vocabulary())
    rows = automaton.decode_ids(automaton.encode_texts(docs, automaton.vocabulary()), automaton.vocabulary()).collect()
    assert len(rows) == len(TEXTS)
    for r in rows:
        ids = library.encode(TEXTS[r["doc_id"]] or "", add_special_tokens=False).ids
        assert np.frombuffer(r["ids"], "<u4").tolist() == ids
        assert r["text"] == library.decode(ids, skip_special_tokens=False)
    assert automaton.encode_texts(none, automaton.vocabulary()).count() == 0


def test_automaton_against_merging():
    """Random merges over three letters: the automaton's only path is what merging by rank gives."""
    for seed in range(30):
        r = random.Random(seed)
        labels, merges = {0: b"a", 1: b"b", 2: b"c"}, []
        for _ in range(12):
            u, v = r.choice(list(labels)), r.choice(list(labels))
            if labels[u] + labels[v] not in labels.values():
                merges.append((u, v, len(labels)))
                labels[len(labels)] = labels[u] + labels[v]
        made = automaton.Automaton(labels, merges)
        for _ in range(200):
            word = bytes(r.choice(b"abc") for _ in range(r.randrange(1, 12)))
            ids = [made.id_of[word[k : k + 1]] for k in range(len(word))]
            while True:
                found = [(k, m) for k, m in enumerate(merges) if any((ids[i], ids[i + 1]) == m[:2] for i in range(len(ids) - 1))]
                if not found:
                    break
                u, v, uv = found[0][1]
                out, i = [], 0
                while i < len(ids):
                    if ids[i : i + 2] == [u, v]:
                        out.append(uv)
                        i += 2
                    else:
                        out.append(ids[i])
                        i += 1
                ids = out
            assert made.encode(word) == ids


def test_words_together_are_encoded_as_one_by_one(monkeypatch):
    """Also with a table of answers so small that its entries displace one another, and a cache that is always full."""
    r = random.Random(9)
    words = ["", *["".join(r.choices(" abcdehinorst'é0ß语", k=r.randrange(1, 40))) for _ in range(400)]] * 2
    raw = [w.encode() for w in words]
    for slots in (automaton.ARC_SLOTS, 8):
        monkeypatch.setattr(automaton, "ARC_SLOTS", slots)
        made = automaton.Codec(automaton.vocabulary())
        ids, off = made.automaton.encode_all(raw)
        assert [ids[a:z].tolist() for a, z in zip(off[:-1], off[1:], strict=True)] == [made.automaton.encode(w) for w in raw]
    assert [x.tolist() for x in made.automaton.encode_all([])] == [[], [0]]
    monkeypatch.setattr(automaton, "CACHE_ENTRIES", 0)
    texts = [*words, "x" * 200 + " yes", "<|endoftext|>a<|endoftext|>", "a\x1c b\x0b  c\x85 d"]
    library = Tokenizer.from_file(automaton.vocabulary())
    library.no_truncation(), library.no_padding()
    for part in (texts[:300], texts[300:]):
        got = [np.frombuffer(x, made.dtype).tolist() for x in made.encode_many(part)]
        assert got == [library.encode(t, add_special_tokens=False).ids for t in part]


def test_licenses(docs, none):
    rows = {r["doc_id"]: r for r in licenses.scan(docs).collect()}
    pattern = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    for i, t in enumerate(TEXTS):
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
        words = pattern.findall(low)
        places = [k for k in range(len(words)) for p in licenses.PHRASES if words[k : k + len(p.split())] == p.split()]
        r = rows[i]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"]) == (len(words), len(places), min(places, default=None), max(places, default=None))
    mit, gpl = TEXTS.index(next(t for t in TEXTS if t and t.startswith("Released"))), TEXTS.index(next(t for t in TEXTS if t and t.startswith("This work")))
    assert rows[mit]["labels"] == "apache,mit,mit-notice"
    assert rows[gpl]["labels"] == "gpl,gpl-3.0"
    assert rows[0]["labels"] == "" and rows[0]["score"] == 0
    assert licenses.scan(none).count() == 0


def test_license_blocks(spark):
    r = random.Random(3)
    long = " ".join(f"{r.choice(VOCAB)}{k}" for k in range(120))
    texts = [
        "The board released a report under the new driving license rules",
        prose(40) + " released under the MIT license " + prose(40),
        prose(333) + " " + long + " " + prose(50),
        prose(77) + " " + " ".join(w for k, w in enumerate(long.split()) if k % 6) + " " + prose(5),
        " ".join(long.split()[:80]),
        licenses.TEMPLATES["mit-text"].upper(),
    ]
    rows = licenses.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), licenses.TEMPLATES | {"long": long}).orderBy("doc_id").collect()
    assert [x["labels"] for x in rows] == ["", "mit,mit-notice", "long", "long", "", "mit-grant,mit-text"]
    at = {m["label"]: (m["first_word"], m["words"]) for m in rows[2]["matches"]}["long"]
    assert at[0] <= 333 + 24
    assert at[1] == 256


def test_quality(spark, sf_dir, docs, none):
    model = quality.fit(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
    rows = quality.score(docs, model, keep=docs.columns, prefix="__")
    assert rows.columns == [*docs.columns, "__held_out", "__score", "__predicted"]
    got = rows.collect()
    assert all(0 <= r["__score"] <= 1 for r in got)
    assert {r["doc_id"]: r["text"] for r in got} == dict(enumerate(TEXTS))
    same = {r["__score"] for r in got if r["text"] == BASE}
    assert len(same) == 1
    untrained = quality.fit(docs, spark.createDataFrame([], "doc_id long, quality int"))
    assert {r["score"] for r in quality.score(docs, untrained).collect()} == {0.5}
    assert quality.score(none, model).count() == 0


def test_quality_held_out(spark):
    from lakeknot.llm.quality import op4_quality_classifier

    rows = op4_quality_classifier(spark, "/root/testdata/sf0.01").join(read_table(spark, "/root/testdata/sf0.01", "labels"), "doc_id").where("held_out").collect()
    assert np.mean([r["predicted"] == r["quality"] for r in rows]) >= 0.95


def test_language(spark, docs, none):
    rows = language.op6_language_id(spark, "/root/testdata/sf0.01").join(read_table(spark, "/root/testdata/sf0.01", "documents"), "doc_id").where("held_out").collect()
    assert np.mean([r["lang_pred"] == r["lang"] for r in rows]) >= 0.95
    got = {r["doc_id"]: r for r in language.predict(docs, language.fit(docs)).collect()}
    for i, t in enumerate(TEXTS):
        assert got[i]["lang_pred"] == ("en" if any(map(str.isalpha, t or "")) else "und")
    assert {r["lang_pred"] for r in language.predict(docs, language.fit(none)).collect()} == {"und"}
    assert language.predict(none, None).count() == 0


def test_top_k(spark):
    g = np.random.default_rng(4)
    vec = [(i, g.normal(size=8).tolist(), 0) for i in range(600)] + [(600 + i, [0.25] * 8, 0) for i in range(80)]
    vec += [(900, None, 0), (901, [1.0] * 7 + [float("nan")], 0), (902, [1.0] * 7 + [None], 0), (903, [float("inf")] * 8, 0), (950, [], 0)]
    rows = covertree.top_k(spark.createDataFrame(vec, "vec_id long, embedding array<double>, label int"), every=20).collect()
    z = {i: np.floor(256 * np.array(v)).astype(np.int64) for i, v, _ in vec[:680]}
    for qid in range(0, 680, 20):
        best = sorted((-int(z[qid] @ z[i]), i) for i in z if i != qid)[:5]
        assert [(-r["score"], r["vec_id"]) for r in sorted(rows, key=lambda r: r["rank"]) if r["query_id"] == qid] == best
    assert {r["query_id"] for r in rows} == set(range(0, 680, 20))
    few = covertree.top_k(spark.createDataFrame(vec[:3], "vec_id long, embedding array<double>, label int"), every=20).collect()
    assert len(few) == 2
    assert covertree.top_k(spark.createDataFrame([], "vec_id long, embedding array<double>, label int")).count() == 0


def test_top_k_of_many_blocks_and_large_numbers(spark):
    g = np.random.default_rng(6)
    vec = [(i, (g.normal(size=3) * 10.0 ** g.integers(0, 14)).tolist()) for i in range(300)]
    vec += [(2000, [1e300] * 4), (2001, [1e300] * 4), (2020, [-1e300, 1.0, 2.0, 3.0]), (2040, [1.0] * 4), (2041, [0.0, 1.0, 2.0, 3.5]), (2060, [1.7e308] * 4)]
    z = {i: [int(np.floor(np.clip(x * 256, -covertree.LARGEST, covertree.LARGEST))) for x in v] for i, v in vec}
    rows = covertree.top_k(spark.createDataFrame(vec, "vec_id long, embedding array<double>"), every=20, index_rows=40, query_rows=10).collect()
    for q in [i for i in z if i % 20 == 0]:
        best = sorted((-max(min(sum(a * b for a, b in zip(z[q], z[i], strict=True)), 2**63 - 1), 1 - 2**63), i) for i in z if i != q and len(z[i]) == len(z[q]))[:5]
        assert [(-r["score"], r["vec_id"]) for r in sorted(rows, key=lambda r: r["rank"]) if r["query_id"] == q] == best


def test_known_scores_prune_other_blocks():
    g = np.random.default_rng(1)
    near, far = g.normal(size=(2, 800, 8)).round(2) * 100
    ask = covertree.CoverTree(np.arange(10_000, 10_040), np.round(near[:40] + 3000))
    kth = covertree.DualSearch(ask, covertree.CoverTree(np.arange(800), np.round(near + 3000)), 5).score[:, -1]
    other = covertree.CoverTree(np.arange(5000, 5800), np.round(far))
    assert covertree.DualSearch(ask, other, 5).compared > 0
    assert covertree.DualSearch(ask, other, 5, kth).compared == 0


def test_dual_search_prunes():
    g = np.random.default_rng(0)
    centres = g.normal(size=(12, 16)) * 900
    points = np.round(np.repeat(centres, 200, 0) + g.normal(size=(2400, 16)) * 5)
    tree, ask = covertree.CoverTree(np.arange(2400), points), covertree.CoverTree(np.arange(0, 2400, 40), points[::40])
    found = covertree.DualSearch(ask, tree, 5)
    assert found.compared < 60 * 2400 / 2


def test_media(docs, none):
    rows = {r["doc_id"]: r for r in media.fingerprint(media.to_wav(docs)).collect()}
    for i, t in enumerate(TEXTS):
        raw = (t or "").encode()
        payload = raw.ljust(max(192, -(-len(raw) // 192) * 192))
        r = rows[i]
        assert media.wav_payload(r["media"]) == payload
        assert (r["n_bytes"], r["payload_sha256"], r["tail_crc32"]) == (len(raw), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]))
        assert len(r["time_ms"]) == len(r["code"])
        assert r["time_ms"] == sorted(r["time_ms"])
    assert rows[7]["code"] == rows[8]["code"]
    assert media.to_wav(none).count() == 0


def brute_groups(words, percent):
    sets = {}
    for i, t in enumerate(TEXTS):
        w = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
        sets[i] = {tuple(w[k : k + words]) for k in range(len(w) - words + 1)} if len(w) >= words else ({tuple(w)} if w else set())
    group = {i: i for i in sets}

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in sets:
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]):
                a, b = root(i), root(j)
                group[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), root(i)) for i in sets}


@pytest.mark.parametrize(("words", "percent"), [(4, 85), (5, 80), (4, 93)])
def test_groups(docs, words, percent):
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngramjoin.groups(docs, words, percent).collect()}
    assert got == brute_groups(words, percent)


def brute_sets(words):
    out = {}
    for i, t in enumerate(TEXTS):
        w = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
        out[i] = frozenset(tuple(w[k : k + words]) for k in range(len(w) - words + 1)) if len(w) >= words else frozenset({tuple(w)} if w else ())
    return out


@pytest.mark.parametrize(("words", "percent"), [(4, 85), (5, 60)])
def test_every_link(docs, words, percent):
    sets, least = brute_sets(words), {}
    for i, s in sets.items():
        least.setdefault(s, i)
    reps = sorted(i for s, i in least.items() if s)
    want = {(a, b) for a in reps for b in reps if a < b and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])}
    rows = ngramjoin.links(docs, words, percent).collect()
    assert len(rows) == len(want)
    assert {(r["a"], r["b"]) for r in rows} == want


def test_list_blocks_are_skipped():
    g = np.random.default_rng(2)
    n = g.integers(20, 400, 600)
    place = (g.random(600) * n).astype(np.int64)
    pairs, seen = ngramjoin.list_pairs(np.arange(600), n, place, 80)
    want, in_range = set(), 0
    for i in range(600):
        for j in range(i):
            most = max(n[i], n[j])
            if 100 * min(n[i], n[j]) >= 80 * most:
                in_range += 1
                if 100 * (min(place[i], place[j]) + min(n[i] - place[i], n[j] - place[j])) >= 80 * most:
                    want.add((j, i))
    assert set(pairs) == want
    assert len(want) <= seen < 0.75 * in_range


def test_groups_of_no_rows_and_null_ids(spark, none):
    assert ngramjoin.groups(none).count() == 0
    rows = spark.createDataFrame([(None, BASE), (None, BASE), (3, BASE)], "doc_id long, text string")
    assert sorted(ngramjoin.groups(rows).collect(), key=str) == sorted([(None, 56, None), (None, 56, None), (3, 56, 3)], key=str)


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, 101), (101, 103), (7, 7)]
    got = {r["node"]: r["component"] for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 1 for i in range(2, 41)} | {101: 100, 103: 100}


def test_id_files(spark, docs, none, word_ids, tmp_path):
    path = idfiles.write_ids(docs, f"file://{tmp_path}/ids", wordbpe.vocabulary())
    rows = {r["doc_id"]: r for r in idfiles.read_ids(spark, path).join(idfiles.block_starts(spark, path), ["file_no", "block_no"]).collect()}
    at = 0
    for i, ids in word_ids.items():
        assert np.frombuffer(rows[i]["ids_u32"], "<u4").tolist() == ids
        assert rows[i]["block_start"] + rows[i]["start_in_block"] == at
        at += len(ids)
    path = idfiles.write_ids(none, f"file://{tmp_path}/none", wordbpe.vocabulary())
    assert idfiles.read_ids(spark, path).count() == 0


def huffman_cost(weights):
    cost = 0
    while len(weights) > 1:
        a, b, *rest = sorted(weights)
        cost += a + b
        weights = [a + b, *rest]
    return cost


def test_code_lengths():
    n = np.array([1, 1, 2, 3, 5, 8, 13, 21, 34, 55, 89, 144])
    for limit in (4, 5, 8, 16):
        lengths = idfiles.code_lengths(n, limit)
        assert lengths.max() <= max(limit, 5)
        assert (2.0**-lengths).sum() == 1.0
    assert (n * idfiles.code_lengths(n, 16)).sum() == huffman_cost(n.tolist())
    book = idfiles.Codebook(np.arange(12), idfiles.code_lengths(n, 16))
    ids = np.random.default_rng(0).integers(0, 12, 1000)
    raw, offset, inside = book.encode(ids, np.array([0, 300, 300, 700]))
    starts = np.array([0, 300, 700])
    got = book.decode(raw, offset[[0, 2, 3]] * 8, np.diff(np.append(starts, 1000)))
    assert got.tolist() == ids.tolist()


def brute_repeats():
    seen, out = set(), {}
    for i, t in enumerate(TEXTS):
        raw = (t or "").encode()
        keep = np.ones(len(raw), bool)
        runs = [raw[k : k + 50] for k in range(len(raw) - 49)]
        for k, run in enumerate(runs):
            if run in seen:
                keep[k : k + 50] = False
        seen.update(runs)
        edge = np.diff(np.r_[False, ~keep, False].astype(int))
        out[i] = (len(raw), int((~keep).sum()), int((edge == 1).sum()), bytes(np.frombuffer(raw, np.uint8)[keep]))
    return out


def test_repeats(docs, none):
    rows = substrings.remove_repeats(docs).collect()
    assert {r["row"]["doc_id"]: (r["n_bytes"], r["n_bytes"] - len(r["kept"]), len(r["ranges"]), bytes(r["kept"])) for r in rows} == brute_repeats()
    assert substrings.remove_repeats(none).count() == 0


def test_intervals():
    words = sorted("banana"[k:] for k in range(6))
    common = [len(__import__("os").path.commonprefix([a, b])) for a, b in zip(words, words[1:], strict=False)]
    got = {(words[a][:n], z - a + 1) for n, a, z in substrings.intervals(common)}
    assert got == {("", 6), ("a", 3), ("ana", 2), ("na", 2)}


def test_pipeline(spark, sf_dir, docs):
    documents = read_table(spark, sf_dir, "documents")
    kept = documents
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, kept, sf_dir).persist()
        assert after.columns == documents.columns, name
        assert after.count() <= kept.count()
        kept = after
    labels = read_table(spark, sf_dir, "labels").join(documents.select("doc_id"), "doc_id")
    good = labels.where("quality = 1").count()
    assert corpus_pipeline.quality_stage(spark, documents, sf_dir).join(labels.where("quality = 1"), "doc_id").count() >= 0.95 * good
    packed = corpus_pipeline.STAGES[-1][1](spark, kept, sf_dir)
    assert packed.select("doc_id").distinct().count() == kept.count()
    for stage in (corpus_pipeline.near_stage, corpus_pipeline.repeats_stage):
        assert stage(spark, docs, sf_dir).columns == docs.columns
    left = Counter(r["doc_id"] for r in corpus_pipeline.near_stage(spark, docs, sf_dir).collect())
    assert set(left) == {root for i, (n, root) in brute_groups(5, 80).items() if root == i}


def test_cut_characters(spark):
    rows = spark.createDataFrame([(bytearray("aé�".encode()),), (bytearray("aé".encode()[:2]),)], "k binary")
    assert [r[0] for r in rows.select(substrings.valid_text(F.col("k"))).collect()] == ["aé�", "a"]


def test_sets_are_compared_in_rounds_of_bounded_bytes(spark, monkeypatch):
    """Links over several rounds are those of one, and no round is sent more than its share of the sets."""
    import random

    from lakeknot.llm import ngramjoin as J

    rng = random.Random(5)
    word = lambda: f"w{rng.randrange(4000)}"
    base = [[word() for _ in range(120)] for _ in range(6)]
    docs = [(k, " ".join(w if rng.random() > 0.006 else word() for w in base[k % 6])) for k in range(420)]
    table = spark.createDataFrame(docs, "doc_id long, text string")
    whole = sorted(map(tuple, J.links(table, 4, 85).collect()))
    sent, sets = [], J._sets
    monkeypatch.setattr(J, "_sets", lambda base, ids, words: sent.append(ids.count()) or sets(base, ids, words))
    monkeypatch.setattr(J, "ROUND", 0)
    monkeypatch.setattr(J, "ROUND_LEAST", 100_000)
    assert sorted(map(tuple, J.links(table, 4, 85).collect())) == whole and whole
    assert len(sent) > 3 and max(sent) < 320


def test_sketches_drop_no_pair_that_links():
    rng = np.random.default_rng(5)
    dropped = 0
    for percent in (80, 85):
        for _ in range(1500):
            n, lost, added = rng.integers(1, 900), rng.integers(0, 200), rng.integers(0, 200)
            a = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
            b = np.unique(np.concatenate([a[min(lost, len(a) - 1) :], rng.integers(0, 1 << 63, added, dtype=np.uint64)]))
            shared = len(np.intersect1d(a, b))
            may = ngramjoin.able(len(a), len(b), ngramjoin.sketch(a), ngramjoin.sketch(b), percent)
            assert may or 100 * shared < percent * (len(a) + len(b) - shared)
            dropped += not may
    assert dropped > 500


def test_sets_of_pairs_that_share_a_passage_alone_are_not_sent(spark, monkeypatch):
    """Each passage of twenty words is in two texts of sixty further words."""
    rng, sent, sets = random.Random(2), [], ngramjoin._sets
    word = lambda: f"w{rng.randrange(10**9)}"
    passages = [" ".join(word() for _ in range(20)) for _ in range(60)]
    rows = [(i, passages[i // 2] + " " + " ".join(word() for _ in range(60))) for i in range(120)]
    rows += [(200, rows[0][1] + " one"), (201, rows[2][1] + " one")]

    def counted(base, ids, words):
        sent.append(ids.count())
        return sets(base, ids, words)

    monkeypatch.setattr(ngramjoin, "_sets", counted)
    found = ngramjoin.links(spark.createDataFrame(rows, "doc_id long, text string"), 4, 85).collect()
    assert sorted(map(tuple, found)) == [(0, 200), (2, 201)]
    assert sum(sent) <= 8
