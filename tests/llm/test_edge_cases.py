"""Empty tables, repeated rows and extra columns with clashing names."""

import pytest

from statmart.llm import chat, mixing, ngram_join, pii, toxicity, url_filter

DOCS = "doc_id long, text string, lang string, source string, n_chars long, node long, key string, score double"
PAGES = "page_id long, url string, host string, path string, label double, score double"
TURNS = "conv_id long, turn long, role string, text string, doc_id long, ids string, key string"


@pytest.mark.parametrize("name", ["urls", "chat", "redact", "mix", "keep", "drop"])
def test_empty_tables_give_none(spark, name):
    docs = spark.createDataFrame([], DOCS)
    made = {"urls": lambda: url_filter.judge_urls(spark.createDataFrame([], PAGES)),
            "chat": lambda: chat.formatted_digests(spark.createDataFrame([], TURNS)),
            "redact": lambda: pii.redact(docs), "mix": lambda: mixing.mix(docs), "keep": lambda: ngram_join.keep_one(docs),
            "drop": lambda: toxicity.drop_toxic(docs, spark.createDataFrame([], "doc_id long, toxic int"))}[name]()
    assert made.count() == 0


def test_repeated_urls_with_clashing_columns(spark):
    urls = ["http://a.net/x", "http://a.net/x", None, None, "http://b.org/fr/1", "http://b.org/fr/1"]
    pages = spark.createDataFrame([(i // 2, u, "h", "p", 9.0, 7.0) for i, u in enumerate(urls)], PAGES)
    got = sorted((r.page_id, r.host, r.rule) for r in url_filter.judge_urls(pages).collect())
    assert got[:2] == [(0, "a.net", "net/")] * 2 and got[4:] == [(2, "b.org", "org/fr/")] * 2 and len(got) == 6


def test_clashing_columns_of_turns(spark):
    plain = [(1, 0, "user", "hi"), (1, 1, "assistant", "yes"), (2, 0, "assistant", "")]
    wide = [(*t, 5, "x", "k") for t in plain]
    digests = [sorted(map(str, chat.formatted_digests(spark.createDataFrame(rows, schema)).collect()))
               for rows, schema in ((wide, TURNS), (plain, "conv_id long, turn long, role string, text string"))]
    assert digests[0] == digests[1] and len(digests[0]) == 2


def test_repeated_documents_have_equal_spans(spark):
    text = "mail jane@example.com or 10.0.0.1"
    docs = spark.createDataFrame([(1, text, "en", "s", 3, 1, "k", 0.1)] * 3, DOCS)
    got = pii.find_personal_data(docs).collect()
    assert len(got) == 3 and len({str(r) for r in got}) == 1
