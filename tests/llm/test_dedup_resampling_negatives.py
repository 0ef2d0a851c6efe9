"""Suffix dedup, importance resampling and hard negatives against brute force, with edge cases."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest

from statmart.llm import hard_negatives, importance, suffix_dedup

DOCS = "doc_id long, text string, hi long, mark long, rank string"


def frame(spark, texts):
    """Documents with clashing extra columns."""
    return spark.createDataFrame([(i, t, 1, 2, "x") for i, t in texts], DOCS).repartition(3)


# --- suffix dedup -------------------------------------------------------------------------------

def repeats_by_force(raws, length):
    count = collections.Counter(r[i:i + length] for r in raws for i in range(len(r) - length + 1))
    out = []
    for r in raws:
        gone = [False] * len(r)
        for i in range(len(r) - length + 1):
            if count[r[i:i + length]] > 1:
                gone[i:i + length] = [True] * length
        spans = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        out.append((len(r), sum(gone), spans, hashlib.sha256(bytes(b for b, g in zip(r, gone) if not g)).hexdigest()))
    return out


@pytest.fixture(scope="module")
def repeating():
    rng = random.Random(4)
    words = [f"w{i}" for i in range(60)]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randrange(5, 300))) for _ in range(40)]
    texts += [texts[0], None, "", "short", "a" * 3000, "ab" * 900, texts[1][100:700] + "X" + texts[2][:500], "é" * 400 + texts[3]]
    texts += [texts[4][:300] + str(i) + texts[4][300:600 + i] for i in range(30)]  # near copies: a hot mark
    texts += ["abcdefg" * 200 + str(i) for i in range(3)]
    return list(enumerate(texts)) + [(None, texts[5]), (3, "own " + texts[6][:250])]


@pytest.mark.parametrize("length,gram,group", [(200, 50, 1 << 17), (200, 50, 500), (40, 12, 100)])
def test_suffix_dedup_equals_brute_force(spark, repeating, length, gram, group):
    got = suffix_dedup.remove_repeats(frame(spark, repeating), length, gram, group).collect()
    expected = [(i, *x) for (i, _), x in zip(repeating, repeats_by_force([(t or "").encode() for _, t in repeating], length))]
    assert sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got), key=str) == sorted(expected, key=str)
    for r in got:
        assert (r.kept is None) == (r.n_removed == 0)
        assert r.kept is None or hashlib.sha256(r.kept).hexdigest() == r.kept_sha256


def test_suffix_dedup_of_an_empty_table(spark):
    assert suffix_dedup.remove_repeats(frame(spark, [])).collect() == []
    assert [r.n_removed for r in suffix_dedup.remove_repeats(frame(spark, [(1, None), (1, None)])).collect()] == [0, 0]


def test_long_texts_come_in_chunks(monkeypatch):
    monkeypatch.setattr(suffix_dedup, "CHUNK", 300)
    rng = random.Random(2)
    raw = bytes(rng.randrange(97, 99) for _ in range(2000))
    finder, seen = suffix_dedup.Runs(40, 12), []
    for held in suffix_dedup.chunks([raw, b"", raw[:39], raw[:60]], 40):
        texts, places, parts = zip(*held)
        data = np.frombuffer(b"".join(parts), dtype=np.uint8)
        owner = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
        begin = np.array(places) - (np.cumsum([len(p) for p in parts]) - [len(p) for p in parts])
        own, first, counts, *_ = finder.of(data, owner)
        seen += [(texts[o], f + begin[o] + k) for o, f, c in zip(own, first, counts) for k in range(c)]
    assert sorted(seen) == [(0, i) for i in range(1961)] + [(3, i) for i in range(21)]


def test_deep_shallow_sort_equals_sorting():
    rng = random.Random(7)
    for length in (8, 40, 64, 200):
        base = bytes(rng.randrange(97, 100) for _ in range(300))
        raws = [base[:a] + bytes([rng.randrange(97, 123)]) + base[a:] for a in rng.sample(range(300), 6)] + [base, base, b"\0" * 260, b"\xff" * 260]
        data = b"".join(raws)
        ends = np.cumsum([len(r) for r in raws])
        places = np.concatenate([np.arange(e - len(r), e - length + 1) for r, e in zip(raws, ends)])
        groups = np.array([len(places) // 2, len(places) - len(places) // 2])
        order, classes = suffix_dedup.deep_shallow(data, places, groups, length)
        texts = [data[p:p + length] for p in places]
        for first, last in ((0, groups[0]), (groups[0], len(places))):
            own = order[first:last].tolist()
            assert sorted(own) == list(range(first, last))
            assert [texts[i] for i in own] == sorted(texts[first:last])
            steps = [classes[k] != classes[k - 1] for k in range(first + 1, last)]
            assert steps == [texts[a] != texts[b] for a, b in zip(own[1:], own)]


# --- importance resampling ----------------------------------------------------------------------

WORD = re.compile(importance.WORD)


def resampled_by_force(rows, target, max_n, buckets, seed, share, least):
    def features(text):
        words = WORD.findall((text or "").encode().lower().decode())
        return len(words), [zlib.crc32(" ".join(words[i:i + n]).encode()) % buckets for n in range(1, max_n + 1) for i in range(len(words) - n + 1)]

    docs = [(i, *features(t)) for i, t in rows]
    s, t = collections.Counter(b for _, _, x in docs for b in x), collections.Counter(b for x in target for b in features(x)[1])
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (s_all + buckets) / ((s[b] + 1) * (t_all + buckets)))) for b in range(buckets)]
    out = []
    for i, n_words, x in docs:
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in x)
        out.append([i, len(x), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n_words, None])
    able = sorted((r for r in out if r[4] >= least), key=lambda r: (-r[3], r[0] is None, r[0], r[2], r[1]))
    for k, r in enumerate(able[:share[0] * len(able) // share[1]]):
        r[5] = k + 1
    return sorted(((*r[:4], r[5]) for r in out), key=str)


@pytest.mark.parametrize("max_n", [1, 3])
def test_importance_resampling_equals_brute_force(spark, max_n):
    rng = random.Random(5)
    words = ["The", "cat", "naïve", "Ünder", "日本語", "x9", "a-b", "don't", "\x00z", "Σ", "é", "---"]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(0, 60)))) for i in range(120)]
    rows += [(200, None), (201, ""), (202, "!!! --- \n"), (None, rows[3][1]), (3, rows[3][1]), (4, rows[5][1]), (203, "word " * 20000), (204, "w" * 50000)]
    target = ["the cat x9", None, "naïve ünder the Ünder"]
    got = importance.resample(frame(spark, rows), spark.createDataFrame([(t,) for t in target], "text string"), max_n, 97, 11, (30, 100), 10)
    assert sorted(((r.doc_id, r.n_features, r.weight, r.score, r["rank"]) for r in got.collect()), key=str) == resampled_by_force(rows, target, max_n, 97, 11, (30, 100), 10)


def test_importance_resampling_of_empty_tables(spark):
    none = spark.createDataFrame([], "text string")
    assert importance.resample(frame(spark, []), none).collect() == []
    rows = [(i, "one two three " * 10) for i in range(20)]
    got = importance.resample(frame(spark, rows), none).collect()
    assert sorted(((r.doc_id, r.n_features, r.weight, r.score, r["rank"]) for r in got), key=str) == resampled_by_force(rows, [], 1, 10_000, 2024, (10, 100), 20)


def test_split_gives_words_with_offsets():
    split, rng = importance.splitter(), random.Random(1)
    for _ in range(500):
        text = "".join(chr(rng.choice([rng.randrange(128), rng.randrange(0x80, 0x300), 0x4E00, 0x1F600, 97, 48, 32, 0x2028])) for _ in range(rng.randrange(30)))
        text = text.encode().lower().decode()
        assert [(w, text[a:b]) for w, (a, b) in split(text)] == [(w, w) for w in WORD.findall(text)]


# --- hard negatives -----------------------------------------------------------------------------

VECTORS = "vec_id long, label int, embedding array<float>, q string, norm int"


def vectors(spark, rows):
    return spark.createDataFrame([(i, y, v, "q", 0) for i, y, v in rows], VECTORS).repartition(3)


def mined_by_force(rows, every, positives, negatives, window):
    low, high, unit = window
    fine = [(i, y, [math.floor(256 * float(np.float32(x))) for x in v]) for i, y, v in rows
            if None not in (i, y) and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out, seen = [], set()
    for i, y, v in fine:
        if i % every or (i, y, tuple(v)) in seen:
            continue
        seen.add((i, y, tuple(v)))
        scored = sorted((-sum(a * b for a, b in zip(v, w)), j, z) for j, z, w in fine if len(w) == len(v))
        for p, j, _ in [r for r in scored if r[2] == y and r[1] != i][:positives]:
            fits = [r for r in scored if r[2] != y and low * -p <= unit * -r[0] <= high * -p][:negatives]
            out += [(i, j, k + 1, r[1], -p, -r[0]) for k, r in enumerate(fits)]
    return sorted(out)


def test_hard_negatives_equal_brute_force(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(6, 12))
    rows = [(i, int(rng.integers(4)), (base[rng.integers(6)] + rng.normal(size=12) * rng.choice([0.02, 0.3, 2])).astype(np.float32).tolist()) for i in range(400)]
    rows += [(1000 + i, 1 + i % 2, rows[20][2]) for i in range(60)]  # a very common vector: ties
    rows += [(2000, None, rows[1][2]), (2010, 1, None), (2020, 1, [None] * 12), (2030, 1, [float("nan")] * 12), (2040, 2, [float("inf")] * 12),
             (2050, 1, [0.0] * 12), (2060, 1, []), (2061, 1, []), (2062, 2, []), (2070, 1, [0.5, 0.5]), (2071, 1, [0.5, 0.25]), (2072, 2, [0.5, 0.1]),
             (None, 1, rows[1][2]), rows[10], rows[20], (30, 3, rows[40][2])]
    got = hard_negatives.hard_negatives(vectors(spark, rows), 10, 5, 10, (30, 90, 100))
    expected = mined_by_force(rows, 10, 5, 10, (30, 90, 100))
    assert len(expected) > 500
    assert sorted(tuple(r) for r in got.collect()) == expected
    assert hard_negatives.hard_negatives(vectors(spark, [])).collect() == []


def test_large_components_are_exact(spark):
    rows = [(0, 1, [1e7, 1e4]), (1, 1, [1e7, -1e4]), (2, 2, [5e6, 7.0]), (3, 2, [5e6, 8.0]), (4, 2, [1.0, 1.0])]
    expected = mined_by_force(rows, 10, 5, 10, (30, 90, 100))
    assert len(expected) == 2
    assert sorted(tuple(r) for r in hard_negatives.hard_negatives(vectors(spark, rows), 10).collect()) == expected
    huge = [(i, y, [x * 1e20 for x in v]) for i, y, v in rows]  # beyond a long: no crash
    assert {r.positive_score for r in hard_negatives.hard_negatives(vectors(spark, huge), 10).collect()} <= {2 ** 63 - 1}


def test_bounds_hold_and_leave_rows_out():
    rng = np.random.default_rng(1)
    q = np.floor(256 * np.concatenate([rng.normal(size=(300, 16)), rng.normal(size=(1, 16)) + rng.normal(size=(300, 16)) * 0.01]))
    norms = np.sqrt((q * q).sum(axis=1))
    angles = hard_negatives.angles_to(q, norms, hard_negatives.reference_directions(q, 16))
    block = hard_negatives.Block.__new__(hard_negatives.Block)
    block.q, block.norms, block.angles, block.ids = q, norms, angles, np.arange(len(q))
    for i in range(0, 600, 20):
        low, high = hard_negatives.score_bounds(angles[i], norms[i], block)
        assert ((low <= q @ q[i]) & (q @ q[i] <= high)).all()
    least, most = hard_negatives.score_bounds(angles[450], norms[450], block)
    near = np.partition(least, -10)[-10]
    assert (most < near).sum() > 200  # an anchor in a cluster needs few exact scores
