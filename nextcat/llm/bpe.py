"""Byte-level BPE encoding and decoding.

A text is split by the tokenizer's pattern; each piece is merged on its own.  A
piece's segment tree has a leaf per byte position, holding the rank of the pair
that starts there (infinite if the pair has none, or the position was merged
away) and every inner node the leftmost minimum; each merge reads the root and
updates the paths of the merged pair and its live neighbours.

Pieces of up to 64 bytes are merged in step: the trees of all different pieces
of some megabytes of text are rows of one array, and each step merges one pair
in every row that still has one.  Longer pieces use one tree each.

Defined cases: a null text is an empty text and has no ids; special tokens are
ordinary text; lone surrogates cannot occur in a Spark string; rows repeat as
they come; only the id and text columns are read."""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import importable

#: Characters of text whose pieces are merged together, and ids that are decoded together.
CHUNK = 8 << 20
IDS = 1 << 20
_NONE = np.int64(1) << 62


class Vocabulary:
    """Token bytes by id, and the rank (that is, the id) of every pair of tokens that joins to a token."""

    def __init__(self, file: bytes, pattern: str):
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in file.splitlines() if line)}
        self.size = max(ranks.values()) + 1
        self.ranks = ranks
        self.bytes = [b""] * self.size
        for token, rank in ranks.items():
            self.bytes[rank] = token
        self.flat = np.frombuffer(b"".join(self.bytes), np.uint8)
        self.lengths = np.fromiter(map(len, self.bytes), np.int64, self.size)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.split = regex.compile(pattern).findall
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        pairs = [(ranks[t[:i]] * self.size + ranks[t[i:]], rank) for t, rank in ranks.items()
                 for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks]
        table = np.array(sorted(pairs), np.int64).reshape(-1, 2)
        self.pair, self.rank = table[:, 0].copy(), table[:, 1].copy()

    def pair_ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        code = a * self.size + b
        at = np.minimum(np.searchsorted(self.pair, code), max(len(self.pair) - 1, 0))
        return np.where(self.pair[at] == code, self.rank[at], _NONE) if len(self.pair) else np.full(len(code), _NONE)


def merge_in_step(vocab: Vocabulary, pieces: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all pieces (1 to ``width`` bytes; width a power of two) one after
    another, and their number per piece."""
    n, m = len(pieces), width
    lengths = np.fromiter(map(len, pieces), np.int64, n)
    raw = np.frombuffer(b"".join([p.ljust(m, b"\0") for p in pieces]), np.uint8).reshape(n, m)
    inside = np.arange(m) < lengths[:, None]
    symbol = np.where(inside, vocab.byte_ids[raw], -1).ravel()
    after = np.where(np.arange(1, m + 1) < lengths[:, None], np.arange(1, m + 1), m).ravel()  # m: no neighbour
    before = np.tile(np.arange(-1, m - 1), n)
    leaves = np.full((n, 2 * m), _NONE)
    row, col = np.nonzero(inside[:, 1:])
    rank = vocab.pair_ranks(symbol[row * m + col], symbol[row * m + col + 1])
    leaves[row, m + col] = np.where(rank < _NONE, rank * m + col, _NONE)
    for k in range(m - 1, 0, -1):
        np.minimum(leaves[:, 2 * k], leaves[:, 2 * k + 1], out=leaves[:, k])
    tree = leaves.ravel()  # row r's tree begins at 2 m r, its positions at m r

    def put(row: np.ndarray, at: np.ndarray, value) -> None:
        base, node, size = row * (2 * m), at + m, m
        tree[base + node] = value
        while size > 1:  # all leaves are equally deep
            node = node >> 1
            size >>= 1
            child = base + 2 * node
            tree[base + node] = np.minimum(tree[child], tree[child + 1])

    def pair_key(row: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = np.full(len(row), _NONE)
        has = np.flatnonzero(right < m)
        base, at = row[has] * m, left[has]
        rank = vocab.pair_ranks(symbol[base + at], symbol[base + right[has]])
        key[has] = np.where(rank < _NONE, rank * m + at, _NONE)
        return key

    row = np.flatnonzero(tree[1::2 * m] < _NONE)
    while len(row):
        token, p = np.divmod(tree[row * (2 * m) + 1], m)
        base = row * m
        q = after[base + p]
        r = after[base + q]
        symbol[base + p], symbol[base + q] = token, -1
        after[base + p] = r
        has = r < m
        before[(base + r)[has]] = p[has]
        put(row, q, _NONE)
        put(row, p, pair_key(row, p, r))
        left = before[base + p]
        has = np.flatnonzero(left >= 0)
        if len(has):
            put(row[has], left[has], pair_key(row[has], left[has], p[has]))
        row = row[tree[row * (2 * m) + 1] < _NONE]
    return symbol[symbol >= 0].astype(np.int32), (symbol.reshape(n, m) >= 0).sum(axis=1)


def merge_one(vocab: Vocabulary, piece: bytes) -> list[int]:
    """Ids of one piece of any length, by one segment tree."""
    n = len(piece)
    if n < 2:
        return [vocab.ranks[piece]] if n else []
    m = 1 << (n - 1).bit_length()
    none = int(_NONE)
    part: list[bytes | None] = [piece[i:i + 1] for i in range(n)]
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    get = vocab.ranks.get

    def key(i: int) -> int:
        j = after[i]
        rank = get(part[i] + part[j]) if j < n else None
        return none if rank is None else rank * m + i

    tree = [none] * (2 * m)
    tree[m:m + n] = [key(i) for i in range(n)]
    for k in range(m - 1, 0, -1):
        tree[k] = min(tree[2 * k], tree[2 * k + 1])

    def put(i: int, value: int) -> None:
        k = i + m
        tree[k] = value
        while k > 1:
            k >>= 1
            low = min(tree[2 * k], tree[2 * k + 1])
            if tree[k] == low:
                return
            tree[k] = low

    while tree[1] < none:
        p = tree[1] % m
        q = after[p]
        r = after[q]
        part[p], part[q] = part[p] + part[q], None
        after[p] = r
        if r < n:
            before[r] = p
        put(q, none)
        put(p, key(p))
        if before[p] >= 0:
            put(before[p], key(before[p]))
    return [vocab.ranks[x] for x in part if x is not None]


def encode_texts(vocab: Vocabulary, texts: list[str]) -> list[np.ndarray]:
    """Ids of every text; different pieces are merged once."""
    number: dict[str, int] = {}
    spots = [np.array([number.setdefault(p, len(number)) for p in vocab.split(t)], np.int64) for t in texts]
    pieces = [p.encode("utf-8") for p in number]
    lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
    sizes, starts, flat, total = np.zeros(len(pieces), np.int64), np.zeros(len(pieces), np.int64), [], 0
    widths = np.array([max(2, 1 << (n - 1).bit_length()) for n in range(1, 65)])
    width = np.where(lengths <= 64, widths[np.minimum(lengths, 64) - 1], 0)  # 0: a tree of its own
    for w in np.unique(width).tolist():
        which = np.flatnonzero(width == w)
        step = max(1, (1 << 18) // w) if w else 1  # bounds the arrays
        for k in range(0, len(which), step):
            own = which[k:k + step]
            if w:
                ids, n = merge_in_step(vocab, [pieces[i] for i in own.tolist()], w)
            else:
                ids = np.array(merge_one(vocab, pieces[own[0]]), np.int32)
                n = np.array([len(ids)])
            sizes[own] = n
            starts[own] = total + np.cumsum(n) - n
            flat.append(ids)
            total += len(ids)
    flat = np.concatenate(flat) if flat else np.zeros(0, np.int32)
    return [_gather(flat, starts[at], sizes[at])[0] for at in spots]


def _gather(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The stretches of ``flat`` one after another, and where each ends."""
    ends = np.cumsum(sizes)
    return flat[np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)], ends


def decode_ids(vocab: Vocabulary, ids: np.ndarray) -> bytes:
    return b"".join(_gather(vocab.flat, vocab.starts[x], vocab.lengths[x])[0].tobytes()
                    for x in np.split(ids, range(IDS, len(ids), IDS)))


@lru_cache(maxsize=4)
def _vocabulary(file: bytes, pattern: str) -> Vocabulary:
    return Vocabulary(file, pattern)


def load(spark: SparkSession, path: str | None = None, pattern: str = public_tokenizers.PATTERN) -> Broadcast:
    """The rank file (fixed, under a megabyte) for the executors."""
    importable(spark)
    with open(path or public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        return spark.sparkContext.broadcast((f.read(), pattern))


def encode(docs: DataFrame, tokenizer: Broadcast, id_col: str = "doc_id", text: str = "text", decoded: bool = False) -> DataFrame:
    """(id_col, ids array<int>) per row of ``docs``, and with ``decoded`` also
    decoded binary: the bytes that the ids stand for, made from them in the same
    task (a text that comes back unequal shows a fault of the vocabulary)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = _vocabulary(*tokenizer.value)
        for batch in batches:
            begin = size = 0
            texts: list[str] = []
            for i in range(batch.num_rows):
                texts.append(batch.column(1)[i].as_py() or "")
                size += len(texts[-1])
                if size >= CHUNK or i == batch.num_rows - 1:
                    made = encode_texts(vocab, texts)
                    offsets = np.concatenate(([0], np.cumsum([len(x) for x in made])))
                    ids = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate(made), pa.int32()))
                    columns = [batch.column(0).slice(begin, i + 1 - begin), ids]
                    if decoded:
                        columns.append(pa.array([decode_ids(vocab, x) for x in made], pa.binary()))
                    yield pa.RecordBatch.from_arrays(columns, names)
                    begin, size, texts = i + 1, 0, []
    names = [id_col, "ids", "decoded"][:3 if decoded else 2]
    schema = f"`{id_col}` {dict(docs.dtypes)[id_col]}, ids array<int>" + (", decoded binary" if decoded else "")
    return docs.select(id_col, F.col(text).cast("string").alias("text")).mapInArrow(run, schema)


def decoder(tokenizer: Broadcast):
    """A column function: array<int> of ids to the bytes they stand for."""
    @F.arrow_udf("binary")
    def decode(ids: pa.Array) -> pa.Array:
        vocab = _vocabulary(*tokenizer.value)
        return pa.array([decode_ids(vocab, x.values.to_numpy()) if x.is_valid else None for x in ids], pa.binary())
    return decode


def id_text(ids: Column) -> Column:
    """Decimal ids joined by one space."""
    return F.array_join(ids.cast("array<string>"), " ")
