"""Best-fit packing of tokenised documents into sequences of bounded size.

Every document becomes its token ids and an end id; one longer than a sequence
is cut into pieces of a sequence's length.  A sequence (bin) has three
capacities: tokens, documents, and attention cost, the sum of the squared piece
lengths, since a piece attends to itself alone.  Pieces are placed longest
first, each into an open bin that can take it in all three capacities, chosen
by what is left there: by the smallest weighted norm of the residual vector
after placing (rule ``norm``), or by the largest weighted dot product of the
piece's demand with the residual vector (rule ``dot``), both in shares of the
capacities.  A piece that no open bin can take opens one.

Pieces are dealt at random to groups of bounded size, as many as the counted
pieces and tokens ask for, and a task packs one group.  The least filled bins
of a group are opened again and their pieces dealt to fewer groups, until one
group is left: what is lost to half-empty bins does not grow with the groups.

Defined cases: a null or empty text is one piece of the end id; rows with null
or equal ids are documents of their own; rows that repeat are packed as often
as they stand; ties of score go to the bin opened first; an empty table gives no
rows; only the id and text columns are read, whatever other columns are named."""

from __future__ import annotations

import os
import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, fresh, importable

#: Characters of text that are tokenised together, and pre-tokens that a task remembers.
CHUNK = 4 << 20
WORDS = 400_000


@dataclass(frozen=True)
class Packing:
    tokens: int = 4096             # capacities of a sequence
    documents: int = 4096
    attention: int = 4096 * 4096   # sum of squared piece lengths
    weights: tuple[float, float, float] = (1.0, 0.05, 0.05)  # of the three in the score
    rule: str = "norm"             # "norm" | "dot"
    group: int = 65_536            # pieces that a task packs, on average
    bins: int = 1024               # sequences that a task fills, on average
    end_id: int = 1

    def __post_init__(self) -> None:
        if self.rule not in ("norm", "dot") or min(self.tokens, self.documents) < 1 or self.attention < self.tokens ** 2:
            raise ValueError("a sequence must be able to hold one full piece; rule is 'norm' or 'dot'")


# ---------------------------------------------------------------- tokens

class Words:
    """Token ids of texts by the tokenizer library.

    The tokenizer makes texts NFC, drops white space, lower-cases, splits by a
    pattern and tokenises each pre-token on its own, so the ids of a text are
    those of its pre-tokens one after another and each different pre-token is
    tokenised once.  That holds for texts of composed Latin letters, where
    lower case and classes of characters are beyond doubt; any other text goes
    through the library whole."""

    _letter, _number, _space = r"A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u024f", r"0-9\xb2\xb3\xb9\xbc-\xbe", r"\t\n\r\x20\xa0"
    _other = re.compile(r"[^\t\n\r\x20-\x7e\xa0-\u024f]|<\|").search
    # Fixed value: the pre-tokens of the tokenizer's file, for the characters above.
    _split = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_letter}]+|[{_number}]|[^{_space}{_letter}{_number}]+").findall

    def __init__(self, file: bytes):
        from tokenizers import Tokenizer
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has the tasks
        self.tokenizer = Tokenizer.from_buffer(file)
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)  # ids that end a pre-token
        for token, i in vocabulary.items():
            self.ends[i] = token.endswith("</w>")
        self.ids: dict[str, bytes] = {}  # of pre-tokens

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(x.ids, "<u4") for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, units: list[str]) -> None:
        joined = [units[i:i + 512] for i in range(0, len(units), 512)]
        for some, ids in zip(joined, self._encode(list(map(" ".join, joined)))):
            ends = np.flatnonzero(self.ends[ids]) + 1
            if len(ends) != len(some):  # a vocabulary that marks no ends
                self.ids.update(zip(some, (x.tobytes() for x in self._encode(some))))
                continue
            raw, at = ids.tobytes(), 0
            for unit, end in zip(some, (4 * ends).tolist()):
                self.ids[unit] = raw[at:end]
                at = end

    def of(self, texts: list[str]) -> list[np.ndarray]:
        latin = [self._other(t) is None and unicodedata.is_normalized("NFC", t) for t in texts]
        units = [self._split(t.lower()) if plain else [] for t, plain in zip(texts, latin)]
        if len(self.ids) > WORDS:
            self.ids.clear()
        self._learn(list(set().union(*units) - self.ids.keys()))
        whole = iter(self._encode([t for t, plain in zip(texts, latin) if not plain]))
        get = self.ids.__getitem__
        return [np.frombuffer(b"".join(map(get, u)), "<u4") if plain else next(whole) for u, plain in zip(units, latin)]


def segments(text: str) -> Iterator[str]:
    """The text in stretches of some megabytes that end before white space."""
    at = 0
    while len(text) - at > CHUNK:
        m = re.compile(r"[ \t-\r]").search(text, at + CHUNK)
        if m is None:
            break
        yield text[at:m.start()]
        at = m.start()
    yield text[at:]


@lru_cache(maxsize=2)
def _words(file: bytes) -> Words:
    return Words(file)


def load(spark: SparkSession, path: str | None = None) -> Broadcast:
    """The tokenizer's file (fixed, a few megabytes) for the executors."""
    importable(spark)
    with open(path or public_tokenizers.path("word_bpe_49k.json"), "rb") as f:
        return spark.sparkContext.broadcast(f.read())


def pieces(docs: DataFrame, tokenizer: Broadcast, conf: Packing = Packing(), id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id_col, piece int, start long, length long, ids binary): the pieces of
    every row, ids as little-endian unsigned 32-bit numbers."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _words(tokenizer.value)
        end = np.array([conf.end_id], "<u4")

        def put(batch: pa.RecordBatch, rows: list[int], texts: list[str]) -> Iterator[pa.RecordBatch]:
            own: dict[int, list[np.ndarray]] = {}
            for row, ids in zip(rows, words.of(texts)):
                own.setdefault(row, []).append(ids)
            row_of, piece, start, length, raw = [], [], [], [], []
            for row, parts in own.items():
                ids = np.concatenate([*parts, end])
                for n, at in enumerate(range(0, len(ids), conf.tokens)):
                    some = ids[at:at + conf.tokens]
                    for column, value in zip((row_of, piece, start, length, raw), (row, n, at, len(some), some.tobytes())):
                        column.append(value)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row_of, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                 pa.array(length, pa.int64()), pa.array(raw, pa.binary())], [id_col, "piece", "start", "length", "ids"])
        for batch in batches:
            rows, texts, size = [], [], 0
            for i in range(batch.num_rows):
                whole = batch.column(1)[i].as_py() or ""
                if len(whole) > CHUNK:
                    parts = [words.of([s])[0] for s in segments(whole)]
                    ids = np.concatenate([*parts, end])
                    at = np.arange(0, len(ids), conf.tokens)
                    for n, a in enumerate(at.tolist()):
                        some = ids[a:a + conf.tokens]
                        yield pa.RecordBatch.from_arrays(
                            [batch.column(0).slice(i, 1), pa.array([n], pa.int32()), pa.array([a], pa.int64()),
                             pa.array([len(some)], pa.int64()), pa.array([some.tobytes()], pa.binary())], [id_col, "piece", "start", "length", "ids"])
                    continue
                rows.append(i)
                texts.append(whole)
                size += len(whole)
                if size >= CHUNK:
                    yield from put(batch, rows, texts)
                    rows, texts, size = [], [], 0
            if rows:
                yield from put(batch, rows, texts)
    schema = f"`{id_col}` {dict(docs.dtypes)[id_col]}, piece int, start long, length long, ids binary"
    return docs.select(id_col, F.col(text).cast("string").alias("text")).mapInArrow(run, schema)


# ---------------------------------------------------------------- packing

def best_fit(lengths: np.ndarray, conf: Packing) -> tuple[np.ndarray, np.ndarray]:
    """Bin number and offset of every piece."""
    cap = np.array([conf.tokens, conf.documents, conf.attention], float)
    weight = np.array(conf.weights, float)
    n = len(lengths)
    bin_of, offset = np.empty(n, np.int64), np.zeros(n, np.int64)
    order = np.argsort(-lengths, kind="stable")
    alone = int((lengths == conf.tokens).sum())  # full pieces fill a bin each
    bin_of[order[:alone]] = np.arange(alone)
    made, least = alone, int(lengths.min(initial=conf.tokens))
    left = np.empty((3, 64))              # of the open bins, in the order in which they were opened
    names = np.empty(64, np.int64)
    count = shut = 0
    for i, size in zip(order[alone:].tolist(), lengths[order[alone:]].tolist()):
        need = np.array([size, 1, size * size], float)
        rest = left[:, :count] - need[:, None]
        fits = np.flatnonzero((rest >= 0).all(axis=0))
        if len(fits):
            if conf.rule == "norm":
                share = rest[:, fits] / cap[:, None]
                b = fits[int((weight @ (share * share)).argmin())]
            else:
                b = fits[int(((weight * need / cap) @ (left[:, fits] / cap[:, None])).argmax())]
        else:
            if count == len(names):
                open_ = left[0, :count] >= least
                open_ &= left[1, :count] >= 1
                kept = int(open_.sum())
                room = 2 * kept if 2 * kept > count else count
                old, names_ = left[:, :count][:, open_], names[:count][open_]
                left, names = np.empty((3, max(64, room))), np.empty(max(64, room), np.int64)
                left[:, :kept], names[:kept] = old, names_
                count, shut = kept, 0
            b = count
            left[:, b] = cap
            names[b] = made
            count += 1
            made += 1
        bin_of[i] = names[b]
        offset[i] = conf.tokens - int(left[0, b])
        left[:, b] -= need
        if left[0, b] < least:
            left[0, b] = -1.0  # shut
            shut += 1
            if shut >= 64 and 2 * shut >= count:
                open_ = left[0, :count] >= 0
                kept = int(open_.sum())
                left[:, :kept], names[:kept] = left[:, :count][:, open_], names[:count][open_]
                count, shut = kept, 0
    return bin_of, offset


def reopened(lengths: np.ndarray, bin_of: np.ndarray, conf: Packing) -> np.ndarray:
    """Which pieces lie in the least filled bins: at most 64 bins, and a
    sixteenth of a group's pieces."""
    if not len(lengths):
        return np.zeros(0, bool)
    filled, many = np.bincount(bin_of, lengths), np.bincount(bin_of)
    worst = np.argsort(filled, kind="stable")[:64]
    worst = worst[filled[worst] < conf.tokens]
    some = worst[np.cumsum(many[worst]) <= max(conf.group // 16, 1)]
    return np.isin(bin_of, some)


def _packer(conf: Packing, length: str, columns: tuple[str, str, str], made: int, last: bool):
    """The function that packs one group of the round ``made``."""
    number, group, again = columns

    def run(key: tuple, table: pa.Table) -> pa.Table:
        table = table.drop_columns([group]).sort_by([(number, "ascending")])
        sizes = table[length].to_numpy().astype(np.int64)
        bin_of, offset = best_fit(sizes, conf)
        more = np.zeros(len(sizes), bool) if last else reopened(sizes, bin_of, conf)
        ids = (made << 58) + (key[0].as_py() << 24) + bin_of
        return (table.append_column("sequence_id", pa.array(ids, pa.int64())).append_column("offset", pa.array(offset, pa.int64()))
                .append_column(again, pa.array(more)))
    return run


def pack(rows: DataFrame, conf: Packing = Packing(), length: str = "length") -> DataFrame:
    """``rows`` with sequence_id and offset; every row is a piece of ``length``
    tokens (1 to a sequence's).  The other columns pass through."""
    importable(rows.sparkSession)
    number, group, again = columns = fresh(rows, "_number", "_group", "_again")
    todo = cut(rows.withColumn(number, F.monotonically_increasing_id()))
    schema = ", ".join(f"`{c}` {t}" for c, t in todo.dtypes) + f", sequence_id long, offset long, `{again}` boolean"
    made, out = 0, None
    while True:
        n, tokens = todo.agg(F.count("*"), F.coalesce(F.sum(length), F.lit(0))).first()
        groups = max(1, -(-n // conf.group), -(-tokens // (conf.tokens * conf.bins)))
        dealt = todo.withColumn(group, F.pmod(F.xxhash64(number, F.lit(made)), F.lit(groups)).cast("long"))
        placed = dealt.groupBy(group).applyInArrow(_packer(conf, length, columns, made, groups == 1), schema)
        if groups > 1:
            placed = cut(placed)
        done = placed.where(~F.col(again)).select(*rows.columns, "sequence_id", "offset")
        out = done if out is None else out.unionAll(done)
        if groups == 1:
            return out
        todo = placed.where(F.col(again)).select(*todo.columns)
        made += 1


def pack_documents(docs: DataFrame, tokenizer: Broadcast, conf: Packing = Packing(), id_col: str = "doc_id", text: str = "text",
                   digest: Column | None = None) -> DataFrame:
    """The pieces of ``docs`` with their places: (id_col, piece, start, length,
    ids binary, sequence_id, offset); with ``digest``, an expression of ids, that
    column (named by its alias) instead of ids, so that no ids are shuffled."""
    cut_up = pieces(docs, tokenizer, conf, id_col, text)
    return pack(cut_up if digest is None else cut_up.select(id_col, "piece", "start", "length", digest), conf)


def sequences(packed: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(sequence_id, ids binary, parts): a row per sequence, its pieces' ids one
    after another, and what each part is: array of (id_col, piece, offset, length).
    A sequence's size is bounded, so is the row."""
    part = F.struct("offset", "ids", id_col, "piece", "length")
    return (packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(part)).alias("p"))
            .select("sequence_id", F.concat_ws("", F.transform("p", lambda x: F.hex(x["ids"]))).alias("h"),
                    F.transform("p", lambda x: F.struct(x[id_col].alias(id_col), x["piece"].alias("piece"), x["offset"].alias("offset"),
                                                        x["length"].alias("length"))).alias("parts"))
            .select("sequence_id", F.unhex("h").alias("ids"), "parts"))
