"""Defined cases of every operator on small tables: nulls, empty and long
texts, ties, repeated rows, empty tables, columns with clashing names."""

import random
import re

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from nextcat.llm import bpe, chat, extract, labelled_pages, langid, line_dedup, mixing, oracle, quality, simhash, substring, topk
from nextcat.operators import trends

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that the operators use themselves, and one in another case.
CLASH = {"_key": "int", "size": "int", "taken": "int", "quality": "string", "lines": "string", "ids": "string", "Key": "string",
         "fp": "int", "root": "int", "line": "int", "pos": "int", "_ref": "int", "site": "int", "first": "int", "spans": "int"}


def sample():
    r = random.Random(5)
    vocabulary = [f"w{i}" for i in range(400)]
    body = lambda n: " ".join(r.choice(vocabulary) for _ in range(n))
    shared = body(60)
    rows = [(1, body(100), "en", "a"), (2, body(30) + " " + shared, "en", "b"), (3, shared + "\n" + body(25), "de", None),
            (4, None, "en", "a"), (5, "", None, "b"), (6, "  \n\t ", "en", "c"), (7, "one", "en", "a"), (8, "a " * 3000, "en", "a"),
            (9, body(4000), "fr", "c"), (None, body(50), "en", "a"), (10, "é ü 　 ß", "de", "zé"), (11, "  lead " + body(40), "en", "")]
    rows += [rows[0]] * 3 + [(20 + i, rows[8][1].replace("w1 ", f"x{i} ", 1), "fr", "b") for i in range(5)] + [(None, None, None, None)] * 2
    return [(i, t, lang, s, None if t is None else len(t)) for i, t, lang, s in rows]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(sample(), DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def clashing(df):
    return df.select("*", *[F.lit("1").cast(k).alias(c) for c, k in CLASH.items()])


def rows_of(df):
    return sorted(map(repr, df.collect()))


# ---------------------------------------------------------------- 1

def test_bpe_round_trip(spark, docs, empty):
    tok, plain = bpe.load(spark), brute.tokenizer()
    got = bpe.encode(clashing(docs), tok).withColumn("back", bpe.decoder(tok)("ids")).collect()
    want = sorted(repr((i, plain.encode_ordinary(t or ""), (t or "").encode())) for i, t, *_ in sample())
    assert sorted(repr((r.doc_id, r.ids, bytes(r.back))) for r in got) == want
    assert bpe.encode(empty, tok).collect() == []


def test_bpe_long_and_odd_pieces(spark):
    vocab, plain = bpe.Vocabulary(*bpe.load(spark).value), brute.tokenizer()
    r = random.Random(2)
    texts = ["a" * 5000, " " * 777 + "x", "ab" * 900, "\n" * 300, "<|endoftext|>", "‍😀" * 200, "it's we'LL 'S", "\x1c\x1d a\x85b "]
    texts += ["".join(chr(r.choice([r.randint(1, 0x7f), r.randint(0x80, 0x2fff), r.randint(0xe000, 0x1ffff)])) for _ in range(200)) for _ in range(50)]
    assert [x.tolist() for x in bpe.encode_texts(vocab, texts)] == [plain.encode_ordinary(t) for t in texts]
    assert [bpe.merge_one(vocab, t.encode()) for t in ("", "a", "hello")] == [[], plain.encode_ordinary("a"), plain.encode_ordinary("hello")]


# ---------------------------------------------------------------- 2

def test_mix_equals_sql_and_reruns(docs, empty):
    frame = docs.toPandas().astype({"doc_id": "Int64"})
    want = brute.sql_over(frame, oracle.mix_sql())
    got = mixing.mix_report(clashing(docs)).toPandas()
    columns = ["size", "source_size", "target", "taken"]
    assert sorted(map(tuple, got[columns].round(6).values.tolist())) == sorted(map(tuple, want[columns].round(6).values.tolist()))
    again = mixing.mix_report(docs.repartition(7)).toPandas()
    assert sorted(map(repr, got.values.tolist())) == sorted(map(repr, again.values.tolist()))
    assert mixing.mix_report(empty).collect() == [] and mixing.mixed_documents(empty).collect() == []


def test_mix_by_hand(spark):
    # three sources of 100, 1000 and 1000 words with weights 5, 2, 1: budget 3150; a stops at 200, b would get
    # 2 / 3 of 2950 = 1966.7 and c 983.3, both below twice their size; documents of 10 words finish one after another,
    # and the 197th of b comes before the 99th of c: 1970 + 980 words fill the budget
    rows = [(s * 1000 + i, "w " * 10, "en", "abc"[s], 20) for s, n in enumerate((10, 100, 100)) for i in range(n)]
    got = mixing.mix_report(spark.createDataFrame(rows, DOCS)).join(
        spark.createDataFrame([(r[0], r[3]) for r in rows], "id long, source string"), "id").groupBy("source").agg(
        F.sum("taken").alias("taken"), F.max("target").alias("target"), F.max("taken").alias("most")).orderBy("source").collect()
    assert [r.taken for r in got] == [200, 1970, 980] and sum(r.taken for r in got) == 3150
    assert [round(r.target, 3) for r in got] == [200.0, 1966.667, 983.333]
    assert max(r.most for r in got) <= 20


def test_mix_is_cut_once_and_near_every_target(spark):
    r = random.Random(11)
    rows = [(i, "w " * r.choice([1, 5, 30, 200]), "en", r.choice("aaaabbc") if i else "giant", 0) for i in range(600)]
    rows += [(9000, "w " * 4000, "en", "giant", 0)] + [(None, "same text here", "en", "a", 0)] * 150  # a document over its source's target; a group of equal rows
    docs, mixed = mixing.mix_sources(spark.createDataFrame(rows, DOCS).repartition(6))
    got, goal = mixed.orderBy("position").collect(), {x.source: x for x in docs.groupBy("source").agg(
        F.max("target").alias("target"), F.max("size").alias("longest"), F.max("source_size").alias("size")).collect()}
    budget = int(1.5 * sum(x.size for x in goal.values()))
    assert [x.position for x in got] == [sum(y.taken for y in got[:i]) for i in range(len(got))] and sum(x.taken for x in got) == budget
    order = [(x.finish, x.source, x.epoch, x.slot) for x in got]
    assert order == sorted(order)
    taken = {s: sum(x.taken for x in got if x.source == s) for s in goal}
    spare = sum(x.longest for x in goal.values())
    assert all(-x.longest <= taken[s] - x.target <= spare for s, x in goal.items()) and all(taken[s] <= 2 * x.size for s, x in goal.items())
    sizes = {(d.source, d.slot): d.size for d in docs.collect()}
    assert [x.taken for x in got[:-1]] == [sizes[(x.source, x.slot)] for x in got[:-1]]  # only the last copy may be cut


def test_finish_ranges_ascend(spark):
    times = [0.0, 1e-9, 0.3, 0.99999, 1.0, 1.5, 1.9999, 2.0, 2.01, 7.0, 1e6, 1e12]
    got = [x.r for x in spark.createDataFrame([(t,) for t in times], "t double").select("t", mixing.finish_range(F.col("t"), 4096).alias("r")).orderBy("t").collect()]
    assert got == sorted(got) and got[-1] < 12_000 and got[7] == 8192 + 64


def test_targets_of_many_sources(spark, monkeypatch):
    r = random.Random(4)
    names = sorted(f"s{i}" for i in range(500)) + [None]
    size = {n: r.choice([0, 1, r.randint(1, 50), r.randint(1, 5000)]) for n in names}
    left, stopped = 1.5 * sum(size.values()), set()
    weight = {n: (5, 2, 1)[i % 3] for i, n in enumerate(names)}
    while True:  # sources that stop give what is over to the others
        share = (left - sum(2 * size[n] for n in stopped)) / sum(weight[n] for n in names if n not in stopped)
        full = {n for n in names if n not in stopped and share * weight[n] > 2 * size[n]}
        if not full:
            break
        stopped |= full
    rows = r.sample(list(size.items()), len(size))
    for patched in (mixing, trends):  # the whole plan in one piece
        monkeypatch.setattr(patched, "cut", lambda df: df)
    made = mixing.targets(spark.createDataFrame(rows, "source string, source_size long").repartition(5))
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    windows = [x for x in plan.splitlines() if re.search(r"\bWindow \[", x)]
    assert windows and all("_part#" in x for x in windows)  # over ranges, or inside one
    monkeypatch.undo()
    got = mixing.targets(spark.createDataFrame(rows, "source string, source_size long").repartition(5)).collect()
    assert {x.source: x.source_size for x in got} == size and len(got) == len(size)
    assert all(x.target == pytest.approx(2 * size[x.source] if x.source in stopped else share * weight[x.source]) for x in got)


def test_mix_order_and_positions(docs):
    _, mixed = mixing.mix_sources(docs)
    rows = mixed.orderBy("position").collect()
    assert [r.position for r in rows] == [sum(x.taken for x in rows[:i]) for i in range(len(rows))]
    assert all(a.finish <= b.finish for a, b in zip(rows, rows[1:]))


def test_mixed_documents_repeat_rows_and_cut(docs):
    taken = sum(r.taken for r in mixing.mix_report(docs).collect())
    out = mixing.mixed_documents(clashing(docs))
    assert out.columns == clashing(docs).columns
    assert sum(len(brute.words(r.text)) for r in out.collect()) == taken
    rows, mixed = mixing.mix_sources(docs)
    order = [r.taken for r in mixed.orderBy("position").collect()]
    assert [len(brute.words(r.text)) for r in mixing.mixed_documents(docs).collect()] == order


def test_first_words(spark):
    texts = ["a b  c\nd ", "  a\tb", "one", " é x y"]
    for n in (0, 1, 2):
        df = spark.createDataFrame([(t, n) for t in texts], "t string, n int")
        got = [r.x for r in df.select(mixing.first_words(F.col("t"), F.col("n")).alias("x")).collect()]
        assert [g.strip() for g in got] == [brute.first_words(t, min(n, len(brute.words(t)))).strip() for t in texts]


# ---------------------------------------------------------------- 3

def test_quality_equals_sql(docs, empty):
    frame = docs.toPandas().astype({"doc_id": "Int64"})
    want = brute.sql_over(frame, oracle.quality_sql())
    got = quality.quality_rules(clashing(docs), out="q").select("doc_id", "q.*").toPandas()
    columns = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    assert sorted(map(repr, got[columns].values.tolist())) == sorted(map(repr, want[columns].values.tolist()))
    assert quality.quality_rules(empty).collect() == []
    assert quality.keep_good(clashing(docs)).columns == clashing(docs).columns


@pytest.mark.parametrize("text, repeated", [("", 0), ("a " * 8, 0), ("a " * 9, 9), ("a b c d e f g h " * 2, 16),
                                            ("a b c d e f g h x a b c d e f g h", 16), ("a b c d e f g x a b c d e f g", 0)])
def test_repeated_words_by_hand(spark, text, repeated):
    h = F.transform(quality.words_of(F.col("t")), lambda w: F.xxhash64(w))
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(quality.repeated_words(h, F.size(quality.words_of(F.col("t"))), 8).alias("n")).first().n == repeated


def test_js_distance_by_hand(spark):
    d = lambda a, b: spark.range(1).select(quality.js_distance(F.array(*map(F.lit, a)), F.array(*map(F.lit, b))).alias("d")).first().d
    assert d([1, 0], [0, 1]) == pytest.approx(1.0) and d([2, 2], [1, 1]) == pytest.approx(0.0) and d([0, 0], [1, 1]) is None


# ---------------------------------------------------------------- 4

PAGE = """<!DOCTYPE html><html><head><title>T</title><script>if (a < b) document.write("<p>no</p>")</script></head><body>
<header><h2>Site</h2></header><nav><ul><li><a href="/">Home</a><li><a href="/x">More</a></ul></nav>
<div class="cookie-notice"><p>We use cookies here.</p></div><article><h1>Tom &amp; Jerry&#39;s   day</h1><p>First <b>bold
text.<p>Second &lt;p&gt; here<br>and on.</p><div class="ad">Buy now</div><p>x</p></article>
<section class="comments"><p>Great post, thanks for writing.</p></section><aside class="sidebar"><p>Also read this</p></aside>
<form><p>Sign up</p><input></form><footer>&copy; Site</footer></body></html>"""


@pytest.fixture(scope="module")
def model(spark):
    return extract.train(spark.createDataFrame([(p,) for p in labelled_pages.labelled_pages(300)], "html string"))


def test_extract_by_hand(spark, model):
    pages = spark.createDataFrame([(1, "u", PAGE), (2, None, None), (3, "v", ""), (4, "w", "<nav><a href='/'>x</a></nav>"), (1, "u", PAGE),
                                   (5, "d", "<div>" * 3000 + "</div>" * 10), (6, "b", "<p <<< &bogus; &#xD800; <!-- ")], "page_id long, url string, html string")
    got = {r.page_id: r.text for r in extract.extract(pages, model).collect()}
    assert got[1] == "Tom & Jerry's day\n\nFirst bold text.\n\nSecond <p> here and on.\n\nx"
    assert got[2] == got[3] == got[4] == got[5] == ""
    assert extract.extract(pages, model).count() == 7 and extract.extract(pages.limit(0), model).count() == 0


@pytest.mark.parametrize("html, texts", [
    ("<html><head><title>T</title><article><p>Text.</p></article></html>", ["Text."]),
    ("<head><meta charset=x><title>T</title><style>p {}</style><noscript><img src=x></noscript><link rel=x>\n Plain <b>text</b>.", ["Plain text."]),
    ("<head><title>T</title><noscript><div>no</div></noscript><script>'<p>no</p>'</script></head><body><p>Text.", ["Text."]),
    ("<head><title>T<body><p>Text.", ["Text."]), ("<head><title>T</title></head>Text.", ["Text."]),
    ("<title>no <p>no</div> no</title><div>Text.</div>", ["Text."]),
    ("<div><p>One.</p><svg><path d=x><title>no</title></div><p>Two.</p>", ["One.", "Two."]),
    ("<svg><g><text>no</text><p>Text.</p>", ["Text."]),
    ("<div><svg><foreignObject><div><p>no</p></div>no</foreignObject><desc/><text>no</text></svg>Text.</div>", ["Text."]),
    ("<section>One.<math><mi>x</mi><mo>no</section><p>Two.", ["One.", "Two."]),
    ("<div>One. <noscript><div><p>no<div>no</p></div>no</div>no</noscript>Two.</div>", ["One. Two."]),
    ("<div><object><p>no</p>no</div><p>Text.</p>", ["Text."]), ("<div><noscript>no<x-y>no</x-y>no</div>Text.", ["Text."]),
    ("<div><template><p>no</p></div>no</template>Text.", ["Text."]), ("<div><textarea></div>no</textarea>Text.", ["Text."]),
    ("<p>One.<svg>no", ["One."]), ("<div><select><option>no</body>", []), ("<head/><p>Text.", ["Text."]),
    ("<svg>" * 3000 + "<p>Text.", ["Text."]), ("<div><canvas>" + "<div>" * 3000 + "no" + "</div>" * 3001 + "Text.", ["Text."])])
def test_hidden_elements_end(html, texts):
    tree = extract.parse(html)
    assert [t for t in tree.text if t] == texts
    assert tree.parent[0] == -1 and all(0 <= p < i for i, p in enumerate(tree.parent) if i)


def test_extract_without_end_of_head(spark, model):
    pages = spark.createDataFrame([(1, "u", "<html><head><title>T</title><article><p>Text of the page, some words.</p></article></html>")],
                                  "page_id long, url string, html string")
    assert [r.text for r in extract.extract(pages, model).collect()] == ["Text of the page, some words."]


def test_extract_on_held_out_pages(model):
    right = wrong = 0
    for html in labelled_pages.labelled_pages(100, seed=77):
        tree = extract.parse(html)
        mark = list(tree.mark)
        for i in range(1, len(mark)):
            mark[i] = mark[i] or mark[tree.parent[i]]
        for y, p, tag in zip(mark, extract.marginals(tree, model), tree.tag):
            if not tag:
                right += (y == "c") == (p[1] > 0.5)
                wrong += (y == "c") != (p[1] > 0.5)
    assert right / (right + wrong) > 0.97


def test_marginals_equal_enumeration(model):
    from itertools import product
    tree = extract.parse("<div class=content><p>some words, here.</p><aside>x</aside></div>")
    own = [model.evidence(f, not t) for f, t in zip(extract.features(tree), tree.tag)]
    sums = np.zeros((len(own), 3))
    for labels in product(range(3), repeat=len(own)):
        p = model.root[labels[0]]
        for i, y in enumerate(labels):
            p *= own[i][y] * (model.step[labels[tree.parent[i]], y, not tree.tag[i]] if i else 1)
        for i, y in enumerate(labels):
            sums[i, y] += p
    assert np.allclose(sums / sums.sum(axis=1, keepdims=True), extract.marginals(tree, model))


# ---------------------------------------------------------------- 5

def test_lines_equal_sql_and_by_hand(spark, docs, empty):
    rows = [(300 + i, f"own line {i}\n  Licensed to all \nmore {i}\nyet more {i}", "en", f"s{i % 12}", 0) for i in range(24)]
    rows += [(100 + i, "Licensed to all", "en", f"s{i}", 0) for i in range(12)] + [(200, "x\nsame\ny\nz", "en", None, 0), (201, None, "en", "s", 0)]
    many = docs.unionByName(spark.createDataFrame(rows, DOCS))
    got = line_dedup.line_dedup(clashing(many), out="l").select("doc_id", "l.*", "text").toPandas()
    want = brute.sql_over(many.toPandas().astype({"doc_id": "Int64"}), oracle.line_sql())
    columns = ["n_lines", "n_shared", "n_removed", "text"]
    assert sorted(map(repr, got[columns].values.tolist())) == sorted(map(repr, want[columns].values.tolist()))
    by_id = got.set_index("doc_id")
    assert by_id.loc[303].text == "own line 3\nmore 3\nyet more 3" and by_id.loc[103].text == "Licensed to all"
    assert line_dedup.drop_shared_lines(empty).collect() == []
    assert line_dedup.drop_shared_lines(clashing(docs)).columns == clashing(docs).columns


def test_lines_exact_near_the_threshold(spark):
    rows = [(n * 100 + s, f"line {n}\nown {n} {s} a\nown {n} {s} b", "en", f"s{s}", 0) for n in range(5, 16) for s in range(n)]
    got = line_dedup.line_dedup(spark.createDataFrame(rows, DOCS)).groupBy((F.col("doc_id") / 100).cast("int").alias("n")).agg(F.max("lines.n_removed").alias("x"))
    assert {r.n: r.x for r in got.collect()} == {n: int(n >= 10) for n in range(5, 16)}


# ---------------------------------------------------------------- 6

def test_language_cases(spark, docs, empty):
    text = {"en": "the cat and the dog of that house", "de": "der hund und die katze des hauses", "fr": "le chat et les chiens de la maison"}
    rows = [(i, text[k] + f" {i}", k, "s", 0) for i, k in enumerate(["en", "de", "fr"] * 5)]
    model = langid.train(spark.createDataFrame(rows + [(99, None, "xx", "s", 0), (98, "abc", None, "s", 0), (97, "12", "yy", "s", 0)], DOCS))
    assert model.languages == ["de", "en", "fr"]
    tests = [(1, "THE HOUSE AND THE DOG", None, None, 0), (2, None, "en", "s", 0), (3, "12 .,!  ", "en", "s", 0), (4, "die katze " * 20000, "en", "s", 0)]
    got = {r.doc_id: r for r in langid.predict(clashing(spark.createDataFrame(tests, DOCS)), model).collect()}
    assert [got[i].lang_pred for i in (1, 2, 3, 4)] == ["en", "und", "und", "de"]
    assert got[2].score == got[3].score == 0 and all(0 <= r.score <= 1 for r in got.values())
    nothing = langid.train(empty)
    assert nothing.languages == [] and {r.lang_pred for r in langid.predict(docs, nothing).collect()} == {"und"}
    assert langid.predict(empty, model).collect() == []


def test_language_profiles_equal_plain_sums():
    conf = langid.Profiles(dim=64)
    text = "Ab, cab!"
    seq = [0, *map(ord, "ab"), 0, *map(ord, "cab"), 0]
    want = np.zeros(64)
    for a, b, c in zip(seq, seq[1:], seq[2:]):
        v = [langid._vector(x, conf).astype(int) for x in (a, b, c)]
        want += np.roll(v[0], 2) * np.roll(v[1], 1) * v[2]
    made = np.zeros((3, 64))
    langid.add_profiles([text, None, ""], [0, 1, 2], conf, made)
    assert np.array_equal(made[0], want) and not made[1:].any()


def test_language_training_does_not_depend_on_dealing(docs):
    a, b = langid.train(docs.repartition(1)), langid.train(docs.repartition(5))
    assert a.languages == b.languages and np.array_equal(a.vectors, b.vectors)


# ---------------------------------------------------------------- 7

def test_simhash_equals_brute_force(docs, empty):
    rows = sample()
    prints = [brute.fingerprint(r[1]) for r in rows]
    roots = brute.components(prints)
    least = {}
    for r, k in zip(rows, roots):
        least[k] = min([x for x in (least.get(k), r[0]) if x is not None], default=None)
    want = sorted(repr((r[0], p, least[k])) for r, p, k in zip(rows, prints, roots))
    got = sorted(repr((r.id, r.fp % 2**64, r.component)) for r in simhash.simhash_groups(clashing(docs)).collect())
    assert got == want
    kept = simhash.drop_near_copies(clashing(docs))
    assert kept.columns == clashing(docs).columns
    assert kept.count() == len(set(roots))
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == sorted(x for x in least.values() if x is not None)
    assert simhash.simhash_groups(empty).collect() == []


@pytest.mark.parametrize("radius, blocks, bucket", [(4, 6, 4096), (4, 6, 16), (3, 5, 8), (1, 2, 4)])
def test_links_connect_what_the_radius_connects(spark, radius, blocks, bucket):
    r = random.Random(radius)
    prints = set()
    for _ in range(40):
        x = r.getrandbits(64)
        for _ in range(r.randint(1, 12)):
            prints.add(x ^ sum(1 << b for b in r.sample(range(64), r.randint(0, radius + 1))))
    prints |= {0, 1, 3, (1 << 64) - 1}
    prints = sorted(prints)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    conf = simhash.SimHash(radius=radius, blocks=blocks, bucket_rows=bucket)
    edges = simhash.links(spark.createDataFrame([(p,) for p in signed], "fp long"), conf)
    got = {r.node: r.root for r in simhash.components(edges).collect()}
    names = [got.get(s, ("alone", s)) for s in signed]
    roots = brute.components(prints, radius)
    assert len(set(names)) == len(set(roots)) == len(set(zip(names, roots)))


def test_components_of_a_long_chain(spark):
    n = 300
    got = simhash.components(spark.createDataFrame([(i, i + 1) for i in range(n)], "a long, b long")).collect()
    assert len(got) == n + 1 and len({r.root for r in got}) == 1


# ---------------------------------------------------------------- 8

CHAT = "conv_id long, turn long, role string, text string"


def chats():
    r = random.Random(3)
    say = lambda n: " ".join(r.choice(["<b>", "\\b", "ok", "</turn>\n", "<turn user>", "é", ">", "\\l"]) for _ in range(n))
    rows = [(1, 0, "system", say(20)), (1, 1, "user", say(50)), (1, 2, "assistant", say(700)), (1, 3, "user", None), (1, 4, "assistant", "")]
    rows += [(2, i, ["user", "assistant"][i % 2], say(r.randint(0, 90))) for i in range(60)] + [(3, 0, "system", "only")]
    rows += [(4, None, "user", "x"), (4, 0, None, "y"), (4, 0, "assistant", "z"), (4, 0, "assistant", "z"), (4, 1, "system", "late")]
    return rows + [(None, 0, "user", "q"), (None, 1, "assistant", "a >\n b"), (5, 0, "a>\nb", "odd role")]


def test_chat_equals_sql(spark):
    import duckdb
    df = spark.createDataFrame(chats(), CHAT).withColumn("window", F.lit(1)).withColumn("at", F.lit(2))
    got = chat.conversation_digests(chat.format_windows(df)).toPandas()
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", chats())
    want = con.execute(oracle.chat_sql()).df()
    want = want[want.conv_id.isna() | (want.conv_id != -7)]
    columns = ["n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    assert sorted(map(repr, got[columns].values.tolist())) == sorted(map(repr, want[columns].values.tolist()))


def test_chat_windows(spark):
    conf = chat.ChatWindows(budget=100, history=30)
    windows = chat.format_windows(spark.createDataFrame(chats(), CHAT), conf).orderBy("conv_id", "window").collect()
    tokens = lambda turns: sum(len(brute.words(t.text)) + 3 for t in turns)
    read = spark.createDataFrame(windows).select("conv_id", "window", "repeated", "text", "loss", chat.read_turns(F.col("text")).alias("turns")).collect()
    for w in read:
        new = w.turns[w.repeated:]
        assert tokens(w.turns) <= conf.budget or len(new) == 1
        first = w.window == min(x.window for x in read if x.conv_id == w.conv_id)
        if w.conv_id == 1:
            assert w.turns[0].role == "system"
        history = [t for t in w.turns[:w.repeated] if t.role != "system"]
        assert first and w.repeated == 0 or tokens(history) <= conf.history
        masked = [w.text[x.begin:x.end] for x in w.loss]
        assert len(masked) == sum(t.role == "assistant" for t in new) and not any("<" in m for m in masked)
    assert any(x.repeated > 1 for x in read)
    assert chat.format_windows(spark.createDataFrame([], CHAT)).collect() == []


# ---------------------------------------------------------------- 9

def test_substrings_equal_brute_force(docs, empty):
    rows = sample()
    want = sorted(repr((r[0], len(brute.words(r[1])), " ".join(k))) for r, k in zip(rows, brute.kept_words([r[1] for r in rows])))
    for conf in (substring.Substrings(), substring.Substrings(width=substring.SHARD, depth=1), substring.Substrings(gram=35), substring.Substrings(kinds=1),
                 substring.Substrings(most=0), substring.Substrings(width=substring.SHARD, depth=1, most=0)):
        got = substring.substring_dedup(clashing(docs), conf).collect()
        assert sorted(repr((r.doc_id, r.n_words, r.kept)) for r in got) == want
        assert all(r.n_words - r.n_removed == len(brute.words(r.kept)) for r in got)
    assert substring.substring_dedup(empty).collect() == []
    assert substring.substring_dedup(empty, substring.Substrings(most=0)).collect() == []


def test_substrings_partial_overlaps(spark):
    r = random.Random(9)
    base = [f"v{r.randint(0, 30)}" for _ in range(400)]
    rows = [(i, " ".join(base[a:a + n] + [f"u{i}"] + base[b:b + m]), "en", "s", 0) for i, (a, n, b, m) in enumerate(
        [(r.randint(0, 300), r.randint(0, 100), r.randint(0, 300), r.randint(0, 100)) for _ in range(60)])]
    want = {row[0]: " ".join(k) for row, k in zip(rows, brute.kept_words([row[1] for row in rows]))}
    for conf in (substring.Substrings(), substring.Substrings(most=0)):
        assert {r.doc_id: r.kept for r in substring.substring_dedup(spark.createDataFrame(rows, DOCS), conf).collect()} == want


# ---------------------------------------------------------------- 10

def test_top_products_equal_brute_force(spark):
    r = np.random.default_rng(4)
    make = lambda n, d, spread: [(r.normal(size=d) * r.lognormal(0, spread)).astype(np.float32).tolist() for _ in range(n)]
    vectors = make(300, 8, 1.0) + make(40, 3, 0.1) + [[0.0] * 8] * 3 + [None, [1.0, None, 2.0], [float("nan")] * 8, [float("inf")] * 8]
    rows = [(i, v) for i, v in enumerate(vectors)] + [(None, vectors[0]), (7, vectors[7]), (400, vectors[1]), (401, vectors[1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("rank", F.lit(1)).withColumn("score", F.lit(2))
    valid = [(i, [int(np.floor(256 * float(x))) for x in v]) for i, v in rows
             if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    want = []
    for i, q in {(i, tuple(v)) for i, v in valid if i % 10 == 0}:
        found = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v in valid if j != i and len(v) == len(q))
        want += [(i, n + 1, j, -s) for n, (s, j) in enumerate(found[:5])]
    for conf in (topk.TopK(), topk.TopK(bucket=16, block=4, group=2), topk.TopK(bucket=8, coordinate_from=0.1, focus=2)):
        got = topk.top_products(df.where("vec_id % 10 = 0"), df, conf)
        assert sorted(map(tuple, got.collect())) == sorted(want)
    assert topk.top_products(df.limit(0), df).collect() == [] and topk.top_products(df.limit(3), df.limit(0)).collect() == []


def test_products_beyond_doubles():
    a = np.array([[2.0**40 + 1, 3.0]])
    assert topk.products(a, a)[0, 0] == (2**40 + 1)**2 + 9
