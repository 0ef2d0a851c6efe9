"""Operators that SQL can't express, held against plain versions of themselves and held-out labels."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from statmart.llm import pieces, url_filter
from statmart.llm.common import PieceTable

SF = "/root/testdata/sf0.001"


def every_segmentation(model, text):
    """All (score, ids) of a text without characters that have no piece."""
    if not text:
        return [(0.0, [])]
    out = []
    node = 0
    for k, c in enumerate(text, 1):
        node = model.children.get((node, ord(c)))
        if node is None:
            break
        if model.piece_at[node] >= 0:
            i = int(model.piece_at[node])
            out += [(float(model.scores[i]) + s, [i, *ids]) for s, ids in every_segmentation(model, text[k:])]
    return out


def test_n_best_of_whole_texts_equal_enumeration(spark):
    model = pieces.PieceModel(public_tokenizers.path("piece_bpe_32k.model"))
    texts = ["the cat", "a b c d", "  two  ", "hi the hi", "x", "no no no", "in\tit", "oo oo oo", "", "ab ba ab"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in pieces.encode(docs).collect():
        text = texts[r.doc_id]
        plain = " " + text
        if any((0, ord(c)) not in model.children or model.piece_at[model.children[0, ord(c)]] < 0 for c in plain):
            assert r.round_trip  # characters without a piece: tested by word
            continue
        wanted = every_segmentation(model, plain)
        scores = {tuple(ids): s for s, ids in wanted}
        got = [(r.score, list(r.ids))]
        for other in r.alternatives:
            ids = list(r.ids)
            for edit in sorted(other.edits, key=lambda e: -e.start):
                ids[edit.start:edit.start + edit.length] = edit.ids
            got.append((other.score, ids))
        best = sorted((s for s, _ in wanted), reverse=True)[:pieces.N_BEST]
        assert [s for s, _ in got] == pytest.approx(best), text
        assert len({tuple(ids) for _, ids in got}) == len(got)
        for score, ids in got:  # each alternative, once its edits are made, is a segmentation of that score
            assert scores[tuple(ids)] == pytest.approx(score)


def test_trie_lookups_in_tables_equal_the_dictionary():
    model = pieces.PieceModel(public_tokenizers.path("piece_bpe_32k.model"))
    rng = random.Random(3)
    known = [*model.children, *((node, ord(c)) for node in rng.sample(range(len(model.piece_at)), 2000) for c in "aeé \U0001F600")]
    nodes, codes = (np.array(x, dtype=np.int64) for x in zip(*known))
    targets, hit = model._step(nodes, codes)
    assert [int(t) if h else None for t, h in zip(targets, hit)] == [model.children.get(key) for key in known]
    points = np.array([*range(0x3000), 0xD800, 0x10FFFF])
    assert model.first.take(points, mode="clip").tolist() == [model.children.get((0, c), 0) for c in points.tolist()]


def test_word_segmentations_equal_a_star_and_words_are_encoded_once():
    model = pieces.PieceModel(public_tokenizers.path("piece_bpe_32k.model"))
    rng = random.Random(5)
    words = [" " + "".join(rng.choice("abcdeinorst'é中\U0001F600") for _ in range(rng.randint(0, 14))) for _ in range(400)]
    asked = []
    words_seen = PieceTable(lambda units: asked.extend(units) or model.best_of_words(units))
    codes = np.concatenate([words_seen.codes(words[:250]), words_seen.codes(words)])[250:]
    assert asked == list(dict.fromkeys(words))
    ends = np.cumsum(words_seen.lengths[codes])
    ids = np.split(words_seen.gather(codes), ends[:-1])
    for word, found, score, loss in zip(words, ids, words_seen.extra[0][codes], words_seen.extra[1][codes]):
        best = model.n_best_of_word(word, 2)
        assert score == pytest.approx(best[0][0])
        assert loss == pytest.approx(best[0][0] - best[1][0] if len(best) > 1 else np.inf)
        assert len(best) > 1 and loss < 1e-9 or found.tolist() == best[0][1]


def plain_url(url):
    """(host, path, rule, verdict of the rule) as the contract words them."""
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:]
    path = path[:min([path.find(c) for c in "?#" if c in path], default=len(path))]
    fits = [(len(h) + len(p), h + p, v) for v, h, p in url_filter.RULES
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    _, rule, verdict = max(fits, default=(0, None, None))
    return host, path, rule, verdict


def test_rules_equal_a_plain_version(spark):
    rng = random.Random(11)
    parts = ["http", "://", "example", ".", "net", "com", "org", "/", "en/", "de/", "fr/", "?", "#", "A", "Ä", "\n", "://x", "//", "İ"]
    urls = ["".join(rng.choice(parts) for _ in range(rng.randrange(14))) for _ in range(1500)]
    urls += [f"s://{h}{p}" for h in ("net", "a.net", "example.net", "m.EXAMPLE.com", "org", "xorg", "b.org") for p in ("", "/", "/en/", "/de/x", "/fr/", "/fr")]
    urls += [None, ""] + [r.url for r in spark.read.parquet(f"{SF}/pages.parquet").select("url").collect()]
    frame = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {r.page_id: r for r in url_filter.judge_urls(frame).collect()}
    assert len(got) == len(urls)
    for i, url in enumerate(urls):
        host, path, rule, verdict = plain_url(url)
        r = got[i]
        assert (r.host, r.path, r.rule) == (host, path, rule), repr(url)
        assert r.verdict == (verdict or ("block" if (r.score or 0) >= 0.5 else "allow")), repr(url)


def test_held_out_urls_are_scored_rightly(spark):
    """Hosts whose labels the trees haven't seen. The rules that label these urls look at paths, of which the
    features hold the depth only, so the ranking is far from sure: 0.73 when this was written."""
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet").select("page_id", "url")
    ruled = pages.withColumns({"host": url_filter.host_of(F.col("url")), "path": url_filter.path_of(F.col("url"))})
    ruled = ruled.withColumn("hit", url_filter.rule_of(F.col("host"), F.col("path"))).where("hit is not null")
    known = ruled.withColumn("label", F.when(F.col("hit.verdict") == "block", 1.0).otherwise(0.0)).drop("hit")
    rows = known.collect()
    held = {r.page_id for r in rows if zlib.crc32(r.host.encode()) % 4 == 0}
    train = known.where(~F.col("page_id").isin(list(held)))
    test = known.where(F.col("page_id").isin(list(held)))
    scored = url_filter.score_urls(test, train).collect()
    ones = [r.score for r in scored if r.label == 1]
    zeros = [r.score for r in scored if r.label == 0]
    assert len(ones) > 100 and len(zeros) > 100
    ranked = sum((a > b) + 0.5 * (a == b) for a in ones for b in zeros) / (len(ones) * len(zeros))
    assert ranked > 0.65
