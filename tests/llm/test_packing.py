"""Best-fit packing: ids as the library's, every constraint kept, nothing lost, few sequences."""

import random
import zlib

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from nextcat.llm import packing as P
from nextcat.llm.queries import QUERIES

DIR = "/root/testdata/sf0.001"
LIBRARY = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def library_ids(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


@pytest.fixture(scope="module")
def tokenizer(spark):
    return P.load(spark)


def test_ids_of_odd_texts_equal_the_library():
    with open(public_tokenizers.path("word_bpe_49k.json"), "rb") as f:
        words = P.Words(f.read())
    r = random.Random(3)
    texts = ["", " ", "W̊ a", "́a b", "it's  WE'LL don't 's", "ΣΑΣ ΣΑΣ.", "a.b, c!!) 1234 ½²", "\x1c\x1d a\x85b\xa0c\xadd", "x <|endoftext|> y <| z", "İstanbul ǅ ǆ ʼn ſ",
             "日本語 123", "éé ﬁ ÀÉ Åström", "a" * 3000, "it''s 'sit", " 　", "¹²³ ªº µ"]
    alphabet = ["a", "B", "é", "Ż", " ", "\n", "'", "s", "t", ".", "7", "½", "\xa0", "Σ", "́", "-", "<", "|", "ǆ", "\x1f"]
    texts += ["".join(r.choice(alphabet) for _ in range(r.randint(1, 60))) for _ in range(400)]
    assert [x.tolist() for x in words.of(texts)] == [library_ids(t) for t in texts]
    limit, P.WORDS = P.WORDS, 5  # forgetting changes nothing
    try:
        assert [x.tolist() for x in words.of(texts[-50:])] == [library_ids(t) for t in texts[-50:]]
    finally:
        P.WORDS = limit


def check(rows, texts, conf):
    """Pieces of (doc, piece, start, length, ids, sequence, offset) rows against the library and the capacities."""
    by_doc = {}
    for r in rows:
        by_doc.setdefault(r[0], []).append(r)
    assert set(by_doc) == set(texts)
    for i, text in texts.items():
        want, own = [*library_ids(text), conf.end_id], sorted(by_doc[i], key=lambda r: r[1])
        assert [r[1] for r in own] == list(range(-(-len(want) // conf.tokens))) and all(r[3] == conf.tokens for r in own[:-1])
        assert [r[2] for r in own] == [n * conf.tokens for n in range(len(own))]
        assert [x for r in own for x in np.frombuffer(r[4], "<u4").tolist()] == want and sum(r[3] for r in own) == len(want)
    by_bin = {}
    for r in rows:
        by_bin.setdefault(r[5], []).append(r)
    for own in by_bin.values():
        own.sort(key=lambda r: r[6])
        assert [r[6] for r in own] == [sum(x[3] for x in own[:n]) for n in range(len(own))]
        assert sum(r[3] for r in own) <= conf.tokens and len(own) <= conf.documents and sum(r[3] ** 2 for r in own) <= conf.attention
    return len(by_bin)


@pytest.mark.parametrize("conf", [P.Packing(), P.Packing(rule="dot"), P.Packing(tokens=64, documents=3, attention=64 * 64 + 300, group=40, bins=8),
                                  P.Packing(tokens=100, documents=5, attention=10_000, rule="dot", group=25, bins=1000)])
def test_pieces_and_capacities(spark, tokenizer, conf):
    r = random.Random(6)
    vocabulary = ["alpha", "beta", "Gamma,", "xyzzyq", "l'été", "12"]
    texts = {i: " ".join(r.choice(vocabulary) for _ in range(r.choice([0, 1, 3, 10, 40, 90, 400]))) for i in range(250)}
    texts |= {900: "", 901: "word " * 9000, 902: "日本 " * 50}
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in texts.items()] + [(903, None, 2, "y")], "doc_id long, text string, piece int, Ids string").repartition(5)
    texts[903] = None
    rows = [tuple(x) for x in P.pack_documents(df, tokenizer, conf).collect()]
    made = check(rows, texts, conf)
    tokens = sum(x[3] for x in rows)
    least = max(-(-tokens // conf.tokens), -(-len(rows) // conf.documents), -(-sum(x[3] ** 2 for x in rows) // conf.attention))
    assert made <= 1.25 * least + 3


def test_query_on_the_smallest_table(spark):
    docs = pd.read_parquet(f"{DIR}/documents.parquet")
    got = QUERIES["op11_best_fit_packing"](spark, DIR).collect()
    by = {}
    for x in got:
        by.setdefault(x.doc_id, {})[x.piece] = x
    for i, text in zip(docs.doc_id, docs.text):
        ids = np.array([*library_ids(text), 1], "<u4")
        for n, a in enumerate(range(0, len(ids), 4096)):
            x, some = by[i].pop(n), ids[a:a + 4096]
            assert (x.start, x.length, x.ids_crc32) == (a, len(some), zlib.crc32(some.tobytes()))
        assert not by[i]
    tokens = sum(x.length for x in got)
    assert len({x.sequence_id for x in got}) <= tokens / 4096 * 1.02 + 1


def test_rows_of_equal_and_null_ids_and_empty_table(spark, tokenizer):
    df = spark.createDataFrame([(1, "a b c")] * 7 + [(None, "d")] * 3 + [(None, None)], "doc_id long, text string")
    rows = P.pack_documents(df, tokenizer, P.Packing(tokens=8, attention=64)).collect()
    assert len(rows) == 11 and sum(x.length for x in rows) == 7 * 4 + 3 * 2 + 1
    assert P.pack_documents(df.limit(0), tokenizer).collect() == []
    with pytest.raises(ValueError):
        P.Packing(attention=10)


def test_sequences_hold_their_pieces(spark, tokenizer):
    df = spark.createDataFrame([(i, f"text number {i} " * (i % 9)) for i in range(60)], "doc_id long, text string")
    packed = P.pack_documents(df, tokenizer, P.Packing(tokens=50, attention=2500))
    pieces = {(x.doc_id, x.piece): bytes(x.ids) for x in packed.collect()}
    for s in P.sequences(packed).collect():
        raw = bytes(s.ids)
        assert len(raw) <= 200 and raw == b"".join(pieces[p.doc_id, p.piece] for p in s.parts)
        assert [p.offset for p in s.parts] == [sum(x.length for x in s.parts[:n]) for n in range(len(s.parts))]


def test_groups_lose_few_sequences(spark):
    g = np.random.default_rng(4)
    sizes = np.clip(g.lognormal(5.5, 1.1, 20_000).astype(int), 1, 4096)
    df = spark.createDataFrame(pd.DataFrame({"n": np.arange(len(sizes)), "length": sizes}))
    one = P.pack(df).select("sequence_id").distinct().count()
    many = P.pack(df, P.Packing(group=1000, bins=64)).select("sequence_id").distinct().count()
    assert one <= sizes.sum() / 4096 * 1.005 + 1 and many <= one * 1.01 + 2


def test_long_text_in_stretches(spark, tokenizer, monkeypatch):
    text = "some words, and more " * 3000
    parts = list(P.segments("ab cd " * 1_500_000))
    assert "".join(parts) == "ab cd " * 1_500_000 and all(len(p) <= P.CHUNK + 4 for p in parts) and all(p[0] == " " for p in parts[1:])
    want = [*library_ids(text), 1]
    conf = P.Packing(tokens=len(want), attention=len(want) ** 2)
    row = P.pieces(spark.createDataFrame([(1, text)], "doc_id long, text string"), tokenizer, conf).select("length", F.crc32("ids").alias("c")).collect()
    assert [(x.length, x.c) for x in row] == [(len(want), zlib.crc32(np.array(want, "<u4").tobytes()))]
