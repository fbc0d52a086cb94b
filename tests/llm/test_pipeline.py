"""The whole pipeline against a brute-force version of its stages, and the
queries without SQL against plain Python, on the smallest table."""

import brute
import pandas as pd
from pyspark.sql import functions as F

import corpus_pipeline
from nextcat.llm import oracle, quality
from nextcat.llm.queries import QUERIES

DIR = "/root/testdata/sf0.001"


def documents():
    return pd.read_parquet(f"{DIR}/documents.parquet")


def shared_and_rare():
    """Documents that hold what sf0.001 lacks: lines shared over half of a
    document, a copy of nothing but shared lines, and a rare language."""
    import random
    r = random.Random(6)
    body = lambda n, script=(97, 122): " ".join("".join(chr(r.randint(*script)) for _ in range(r.randint(2, 8))) for _ in range(n))
    head, foot = body(12), body(14)
    rows = [(10_000 + i, f"{head}\n{body(45)}\n{foot}", "en", f"site{i}") for i in range(12)]
    rows += [(10_100, f"{head}\n{foot}", "en", "site0"), (10_101, body(100, (0x627, 0x63A)), "ar", "site1"), (10_102, body(60, (0x4E00, 0x9FA5)), None, "site2")]
    return pd.DataFrame([(i, t, lang, s, len(t)) for i, t, lang, s in rows], columns=["doc_id", "text", "lang", "source", "n_chars"])


def test_pipeline_equals_brute_force(spark, tmp_path):
    docs = pd.concat([documents(), shared_and_rare()], ignore_index=True)
    docs.to_parquet(tmp_path / "documents.parquet")
    docs = docs[docs.doc_id.isin(brute.sql_over(docs, oracle.quality_sql()).query("kept").doc_id)]
    assert {10_101, 10_102} <= set(docs.doc_id)
    cleaned = brute.sql_over(docs, oracle.line_sql()).set_index("doc_id")
    assert (cleaned.n_removed > 0.5 * cleaned.n_lines).any() and (cleaned.n_shared == cleaned.n_lines).any()
    docs = docs.assign(text=docs.doc_id.map(cleaned.text)).sort_values("doc_id", ignore_index=True)
    roots = brute.components([brute.fingerprint(t) for t in docs.text])
    docs = docs[[r == i for i, r in enumerate(roots)]]
    mix = brute.sql_over(docs, oracle.mix_sql()).set_index("doc_id")
    plain, want = brute.tokenizer(), []
    for doc_id, text in zip(docs.doc_id, docs.text):
        size, taken = int(mix.loc[doc_id, "size"]), int(mix.loc[doc_id, "taken"])
        # whole copies; a cut one is cut after its words (both copies can be cut only if the first is whole)
        parts = [size] * (taken // size) + ([taken % size] if taken % size else []) if size else []
        for n in parts:
            some = text if n == size else brute.first_words(text, n)
            want.append((doc_id, plain.encode_ordinary(some), brute.sha(some), True))
    got = [(r.doc_id, list(r.ids), r.decoded_sha256, r.round_trip) for r in corpus_pipeline.run(spark, str(tmp_path)).collect()]
    assert sorted(got) == sorted(want)


def test_stages_keep_the_columns_of_documents(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, DIR).columns == docs.columns


def test_quality_stage_keeps_scripts_without_case(spark):
    import random
    r = random.Random(3)
    latin = [" ".join(r.choice(["the", "of", "and", *(f"{a}{b}" for a in ("Lor", "ips", "dol") for b in ("em", "um", "or"))])
                      for _ in range(120)) + "." for _ in range(40)]
    word = lambda low, high: "".join(chr(r.randint(low, high)) for _ in range(r.randint(3, 7)))
    scripts = [(0x627, 0x63A), (0x5D0, 0x5EA), (0x905, 0x939), (0xE01, 0xE2E), (0xAC00, 0xD7A3), (0x4E00, 0x9FA5)]
    clean = [" ".join(word(*s) for _ in range(100)) + "." for s in scripts]
    noise = [" ".join("#$%&*|" for _ in range(60)), " ".join("\u2603\u2604" + chr(0x2600 + i) + chr(0x2580 + i // 2) for i in range(100))]
    rows = [(i, t, "en") for i, t in enumerate(latin)] + [(100 + i, t, None) for i, t in enumerate(clean)]
    rows += [(200 + i, t, "xx") for i, t in enumerate(clean)] + [(300 + i, t, None) for i, t in enumerate(noise)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    kept = {x.doc_id for x in corpus_pipeline.quality(spark, docs, DIR).collect()}
    # no reference of the own language: base rules alone judge, which the repeated symbols fail
    assert kept == {*range(40), *range(100, 106), *range(200, 206), 301}


def test_verdicts_do_not_switch_with_other_documents(spark):
    import random
    r = random.Random(8)
    arabic = lambda: " ".join("".join(chr(r.randint(0x627, 0x63A)) for _ in range(r.randint(3, 7))) for _ in range(100))
    text, others = arabic(), [arabic() for _ in range(39)]
    latin = [(i, " ".join(r.choice(["the", "of", "and", "lorem", "ipsum"]) for _ in range(60)) + f" {i}", "en") for i in range(50)]
    for rows in ([(900, text, "ar")], [(900, text, "ar"), *latin], [(900, text, "ar"), *[(1000 + i, t, "ar") for i, t in enumerate(others)], *latin]):
        docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
        assert quality.quality_rules(docs).where("doc_id = 900").first().quality.kept


def test_tokens_stage_decodes(spark, monkeypatch):
    texts = ["one two", "\u00e9 \u00fc\n", "", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in corpus_pipeline.tokens(spark, docs, DIR).collect()}
    assert [(got[i].decoded_sha256, got[i].round_trip) for i in range(4)] == [(brute.sha(t or ""), True) for t in texts]
    encode = corpus_pipeline.bpe.encode
    monkeypatch.setattr(corpus_pipeline.bpe, "encode", lambda *a, **k: encode(*a, **k).withColumn("decoded", F.lit("x").cast("binary")))
    assert not any(r.round_trip for r in corpus_pipeline.tokens(spark, docs, DIR).collect())


def test_lines_stage_removes_any_share(spark):
    rows = [(i, f"header\nown body {i}\n footer ", "en", f"s{i}", 0) for i in range(10)] + [(20, "header\n\nfooter", "en", "s0", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = {r.doc_id: r.text for r in corpus_pipeline.lines(spark, docs, DIR).collect()}
    assert got == {i: f"own body {i}" for i in range(10)} | {20: "header\n\nfooter"}


def test_byte_bpe_query(spark):
    plain = brute.tokenizer()
    got = QUERIES["op1_byte_bpe"](spark, DIR).toPandas().set_index("doc_id")
    for doc_id, text in documents()[["doc_id", "text"]].itertuples(index=False):
        ids = plain.encode_ordinary(text)
        r = got.loc[doc_id]
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), brute.sha(" ".join(map(str, ids))), brute.sha(text))


def test_substring_query(spark):
    docs = documents()
    got = QUERIES["op9_substring_dedup"](spark, DIR).toPandas().set_index("doc_id")
    for doc_id, text, kept in zip(docs.doc_id, docs.text, brute.kept_words(docs.text)):
        r = got.loc[doc_id]
        n = len(brute.words(text))
        assert (r.n_words, r.n_removed, r.kept_sha256) == (n, n - len(kept), brute.sha(" ".join(kept)))


def test_simhash_query(spark):
    docs = documents().sort_values("doc_id", ignore_index=True)
    prints = [brute.fingerprint(t) for t in docs.text]
    want = {i: (f"{p:016x}", docs.doc_id[k]) for i, p, k in zip(docs.doc_id, prints, brute.components(prints))}
    got = QUERIES["op7_simhash"](spark, DIR).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in got} == want and len(got) == len(docs)


def test_language_query_on_held_out_texts(spark):
    got = QUERIES["op6_language_id"](spark, "/root/testdata/sf0.01").toPandas().merge(
        pd.read_parquet("/root/testdata/sf0.01/documents.parquet")[["doc_id", "lang"]])
    held = got[got.held_out]
    assert len(held) > 300 and (held.lang == held.lang_pred).mean() > 0.99


def test_extract_query(spark):
    import html
    import re
    got = QUERIES["op4_html_extract"](spark, DIR).toPandas().set_index("page_id")
    for page_id, page in pd.read_parquet(f"{DIR}/pages.parquet")[["page_id", "html"]].itertuples(index=False):
        article = re.search(r"<article>(.*?)</article>", page, re.S)[1]
        blocks = (" ".join(html.unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in re.split(r"</?p>|</?h1>", article))
        want = "\n\n".join(b for b in blocks if b)
        assert (got.loc[page_id].text, got.loc[page_id].n_chars) == (want, len(want))
