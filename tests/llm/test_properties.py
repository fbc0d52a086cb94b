"""Properties on generated input, and plans of the native operators."""

import brute
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from nextcat.llm import bpe, chat, extract, line_dedup, mixing, quality, simhash, substring

DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def vocab(spark):
    return bpe.Vocabulary(*bpe.load(spark).value)


@settings(max_examples=150, deadline=None)
@given(texts=st.lists(st.text(st.characters(exclude_categories=["Cs"]), max_size=80), max_size=4))
def test_bpe_equals_the_library_and_comes_back(vocab, texts):
    ids = bpe.encode_texts(vocab, texts)
    plain = brute.tokenizer_once()
    assert [x.tolist() for x in ids] == [plain.encode_ordinary(t) for t in texts]
    assert [bpe.decode_ids(vocab, x).decode() for x in ids] == texts


@settings(max_examples=60, deadline=None)
@given(piece=st.binary(min_size=1, max_size=64))
def test_bpe_trees_agree(vocab, piece):
    width = max(2, 1 << (len(piece) - 1).bit_length())
    ids, n = bpe.merge_in_step(vocab, [piece, b"a"], width)
    assert ids[:n[0]].tolist() == bpe.merge_one(vocab, piece)


@settings(max_examples=60, deadline=None)
@given(values=st.lists(st.integers(0, 2**64 - 1) | st.integers(0, 255), min_size=2, max_size=150, unique=True),
       cut=st.integers(0, 150), radius=st.integers(1, 7))
def test_bit_slices_find_all_close_pairs(values, cut, radius):
    v = np.array(values, np.uint64)
    run = (np.arange(len(v)) >= cut).astype(int)
    got = {(a, b) for x, y in simhash.close_pairs(v, run, radius) for a, b in zip(x.tolist(), y.tolist())}
    want = {(a, b) for b in range(len(v)) for a in range(b) if run[a] == run[b] and (values[a] ^ values[b]).bit_count() <= radius}
    assert got == want


@settings(max_examples=60, deadline=None)
@given(sizes=st.lists(st.integers(0, 40), min_size=1, max_size=5), letters=st.integers(1, 4), seed=st.integers(0, 99))
def test_equal_windows_have_equal_anchors(sizes, letters, seed):
    r = np.random.default_rng(seed)
    docs = [[b"%d" % x for x in r.integers(0, letters, n)] for n in sizes]
    conf = substring.Substrings(window=6, gram=3)
    doc, first, length, anchor, windows = substring.runs_of(docs, conf)
    spots = [(d, f + i, a) for d, f, n, a in zip(doc, first, length, anchor) for i in range(n)]
    assert len(spots) == len(windows) == sum(max(0, n - 5) for n in sizes)
    seen, words = {}, {}
    for (d, at, a), h in zip(spots, windows.tolist()):
        text = tuple(docs[d][at:at + 6])
        assert seen.setdefault(text, (a, h)) == (a, h) and words.setdefault((a, h), text) == text
    # an anchor is put out at least as often as any window it stands for
    starts = {}
    for a in anchor.tolist():
        starts[a] = starts.get(a, 0) + 1
    often = {}
    for (_, _, a), h in zip(spots, windows.tolist()):
        often[a, h] = often.get((a, h), 0) + 1
    assert all(starts[a] >= n for (a, _), n in often.items())


@settings(max_examples=200, deadline=None)
@given(html=st.lists(st.sampled_from([*"<>/&;pdivabr \"'=!-x\n", "<p>", "</p>", "<div>", "</div>", "<li>", "<script>", "</script>", "<!--", "-->",
                                     "<select>", "</select>", "<body>", "</body>", "<br/>", "<a href=x>", "</a>"]), max_size=60).map("".join))
def test_any_markup_is_read(html):
    tree = extract.parse(html)
    assert all(p < i for i, p in enumerate(tree.parent)) and all(t or tag for t, tag in zip(tree.text, tree.tag))


@pytest.mark.parametrize("make", [
    lambda d: quality.quality_rules(d), lambda d: line_dedup.line_dedup(d), lambda d: mixing.mix_report(d), lambda d: mixing.mixed_documents(d)])
def test_native_plans_on_documents(spark, make):
    plan = make(spark.read.parquet(f"{DIR}/documents.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "InArrow", "Cartesian"))


def test_native_plan_on_conversations(spark):
    df = chat.conversation_digests(chat.format_windows(spark.read.parquet(f"{DIR}/conversations.parquet")))
    assert not any(x in df._jdf.queryExecution().executedPlan().toString() for x in ("Python", "Pandas", "InArrow", "Cartesian"))
