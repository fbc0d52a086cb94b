"""Language identification by hyperdimensional profiles.

Every letter has a random vector of +1 and -1, made from its code point and the
seed alone.  A group of n letters is the product of its letters' vectors, each
rotated by its place; a text is the sum of its groups, a language the sum of
its training texts.  A text's language is that of the prototype with the
largest cosine.

Texts are lower-cased (a final sigma is a sigma); whatever is not a letter parts words, and a word's edge
counts as a letter.  Sums are over integers, so results do not depend on how
rows are dealt.  Prototypes are ``dim`` numbers a language.  Up to ``MAX_LANGUAGES``
they are broadcast at once; more stay a table, whose blocks of languages (dealt by
hash, half as many each on average) are broadcast in turn, each text keeping the
best so far.

Defined cases: null texts and texts without letters are ``und`` with score 0,
as are all texts if no row trains; rows with a null text or language do not
train; a tie goes to the smaller language name; texts are used whole."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from .common import cut, fresh, importable

UNKNOWN = "und"
MAX_LANGUAGES = 10_000
#: Blocks of languages that a task holds at once.
BLOCKS = 4
#: Characters, texts and groups that are handled together.
CHUNK_CHARS, CHUNK_TEXTS, BLOCK = 1 << 20, 256, 1 << 13
_CODES = 0x110000


@dataclass(frozen=True)
class Profiles:
    dim: int = 1024
    n: int = 3  # letters of a group, 2 at least
    seed: int = 7

    def __post_init__(self) -> None:
        if self.n < 2:
            raise ValueError("groups have two letters at least")


@dataclass(frozen=True)
class Prototypes:
    conf: Profiles
    languages: list[str] = field(default_factory=list)
    vectors: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))  # unit length, a row per language


@dataclass(frozen=True)
class PrototypeTable:
    """Prototypes of more languages than the driver holds: (block, lang, v), in ``blocks`` blocks."""
    conf: Profiles
    table: DataFrame
    blocks: int

    def __iter__(self) -> Iterator[Prototypes]:
        for b in range(self.blocks):
            yield _prototypes(self.conf, self.table.where(F.col("block") == b).select("lang", "v").collect())


def _prototypes(conf: Profiles, rows: list[Row]) -> Prototypes:
    found = sorted(((r["lang"], np.array([x["v"] for x in r["v"]], np.float64)) for r in rows), key=lambda x: x[0])
    found = [(name, v) for name, v in found if v.any()]
    if not found:
        return Prototypes(conf)
    vectors = np.stack([v for _, v in found])
    return Prototypes(conf, [name for name, _ in found], vectors / np.linalg.norm(vectors, axis=1, keepdims=True))


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(_CODES)), bool, _CODES)


@lru_cache(maxsize=4096)
def _vector(code: int, conf: Profiles) -> np.ndarray:
    random = np.random.Generator(np.random.Philox(key=[conf.seed, code]))
    return (random.integers(0, 2, conf.dim, dtype=np.int8) * 2 - 1).astype(np.int8)


def letter_codes(text: str, n: int, size: int = CHUNK_CHARS) -> Iterator[np.ndarray]:
    """Code points of a text's letters, 0 for each word's edge, in stretches of
    about ``size`` characters; a stretch begins with the last n - 1 codes of the one
    before, so that every group of n codes lies in one of them, once."""
    kept, at = np.zeros(1, np.int64), 0
    while True:
        end = min(len(text), at + size)
        low = text[at:end].lower().replace("\u03c2", "\u03c3")  # the one letter whose lower case depends on its neighbours
        code = np.frombuffer(low.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        code = np.concatenate((kept, np.where(_letters()[code], code, 0), [0] if end == len(text) else np.zeros(0, np.int64)))
        code = code[(code != 0) | np.concatenate(([True], code[:-1] != 0))]
        if len(code) >= n:
            yield code
        if end == len(text):
            return
        kept, at = code[len(code) - n + 1:] if len(code) >= n else code, end


def _numbered(values: np.ndarray, below: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The different values, the place of each value among them, and how often
    they occur; by counting where all possible ones fit some megabytes."""
    if below > 1 << 22:
        return np.unique(values, return_inverse=True, return_counts=True)
    often = np.bincount(values, minlength=below)
    seen = np.flatnonzero(often)
    place = np.zeros(below, np.int64)
    place[seen] = np.arange(len(seen))
    return seen, place[values], often[seen]


def group_counts(rows: list[int], parts: list[np.ndarray], n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, group, count) of the groups that each row's codes hold, sorted by
    group, and the groups' code points; never larger than the codes."""
    alphabet = np.flatnonzero(np.bincount(np.concatenate([np.flatnonzero(np.bincount(p)) if len(p) > 1 << 16 else p for p in parts])))
    number = np.zeros(int(alphabet[-1]) + 1, np.int64)
    number[alphabet] = np.arange(len(alphabet))
    k, codes = len(alphabet), []
    for p in parts:
        x = number[p]
        c = x[:len(x) - n + 1].copy()
        for j in range(1, n):
            c = c * k + x[j:len(x) - n + 1 + j]
        codes.append(c)
    row = np.concatenate([np.full(len(c), r) for r, c in zip(rows, codes)])
    seen, column, _ = _numbered(np.concatenate(codes), k ** n)
    top = int(row.max()) + 1
    pair, _, count = _numbered(column * top + row, len(seen) * top)
    digits = np.stack([seen // k ** (n - 1 - j) % k for j in range(n)], axis=1)
    return pair % top, pair // top, count, alphabet[digits]


def bundle(rows: list[int], parts: list[np.ndarray], conf: Profiles, out: np.ndarray) -> None:
    """Add the group vectors of every row's codes to its line of ``out``.  Groups
    are taken some thousands at a time, so that neither their vectors nor the
    matrix of rows and groups grow with the text."""
    row, group, count, groups = group_counts(rows, parts, conf.n)
    used, line = np.unique(row, return_inverse=True)
    for k in range(0, len(groups), BLOCK):
        a, b = np.searchsorted(group, (k, k + BLOCK))
        part = np.zeros((len(used), min(BLOCK, len(groups) - k)), np.float32)
        part[line[a:b], group[a:b] - k] = count[a:b]
        out[used] += part @ group_vectors(groups[k:k + BLOCK], conf).astype(np.float32)


def group_vectors(groups: np.ndarray, conf: Profiles) -> np.ndarray:
    """Bound vectors (int8) of groups of code points."""
    alphabet, place = np.unique(groups, return_inverse=True)
    letters = np.stack([_vector(int(c), conf) for c in alphabet])
    place = place.reshape(groups.shape)
    out = letters[place[:, -1]]
    for j in range(1, conf.n):
        out = out * np.roll(letters, j, axis=1)[place[:, conf.n - 1 - j]]
    return out


def add_profiles(texts: list[str | None], lines: list[int], conf: Profiles, out: np.ndarray) -> None:
    """Add every text's profile to its line of ``out``."""
    rows: list[int] = []
    parts: list[np.ndarray] = []
    chars = 0
    for i, text in zip(lines, texts):
        for code in letter_codes(text or "", conf.n):
            rows.append(i)
            parts.append(code)
            chars += len(code)
            if chars >= CHUNK_CHARS or len(rows) >= CHUNK_TEXTS:
                bundle(rows, parts, conf, out)
                rows, parts, chars = [], [], 0
    if rows:
        bundle(rows, parts, conf, out)


def train(docs: DataFrame, conf: Profiles = Profiles(), text: str = "text", lang: str = "lang") -> Prototypes | PrototypeTable:
    """Prototypes from all rows with a language and a text."""
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            names, which = np.unique(np.array(batch.column(1).to_pylist(), object).astype(str), return_inverse=True)
            made = np.zeros((len(names), conf.dim))
            add_profiles(batch.column(0).to_pylist(), which.tolist(), conf, made)
            for name, v in zip(names.tolist(), made):
                total[name] = total[name] + v if name in total else v
        for name, v in total.items():
            yield pa.RecordBatch.from_arrays([pa.array([name] * conf.dim), pa.array(np.arange(conf.dim, dtype=np.int32)),
                                              pa.array(np.rint(v).astype(np.int64))], ["lang", "i", "v"])
    importable(docs.sparkSession)
    rows = docs.select(F.col(text).cast("string").alias("text"), F.col(lang).cast("string").alias("lang")).where(
        "text IS NOT NULL AND lang IS NOT NULL")
    made = (rows.mapInArrow(sums, "lang string, i int, v long").groupBy("lang", "i").agg(F.sum("v").alias("v"))
            .groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("i", "v"))).alias("v")))
    found = made.limit(MAX_LANGUAGES + 1).collect()
    if len(found) <= MAX_LANGUAGES:
        return _prototypes(conf, found)
    made = cut(made)
    blocks = -(-2 * made.count() // MAX_LANGUAGES)
    return PrototypeTable(conf, made.withColumn("block", F.pmod(F.xxhash64("lang"), F.lit(blocks))), blocks)


def best_languages(texts: list[str | None], m: Prototypes) -> tuple[list[str], np.ndarray]:
    """Every text's best language and its cosine; ``und`` and 0 if there is none."""
    names = np.array([*m.languages, UNKNOWN], object)
    best, score = [np.zeros(0, np.int64)], [np.zeros(0)]
    for at in range(0, len(texts), CHUNK_TEXTS):
        some = texts[at:at + CHUNK_TEXTS]
        profile = np.zeros((len(some), m.conf.dim))
        add_profiles(some, list(range(len(some))), m.conf, profile)
        length = np.linalg.norm(profile, axis=1)
        if m.languages:
            cosine = profile @ m.vectors.T / np.maximum(length, 1e-300)[:, None]
            top = cosine.argmax(axis=1)
            best.append(np.where(length > 0, top, len(m.languages)))
            score.append(np.where(length > 0, cosine[np.arange(len(top)), top], 0))
        else:
            best.append(np.zeros(len(length), np.int64))
            score.append(np.zeros(len(length)))
    return names[np.concatenate(best)].tolist(), np.concatenate(score)


def predict(docs: DataFrame, model: Prototypes | PrototypeTable, text: str = "text",
            keep: tuple[str | Column, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` of ``docs``, then lang_pred string and score double (the cosine, 0 at least)."""
    importable(docs.sparkSession)
    if isinstance(model, PrototypeTable):
        return _predict_by_blocks(docs, model, text, keep)
    kept = docs.select(*keep)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names_out = [*kept.columns, "lang_pred", "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            best, score = best_languages(batch.column(batch.num_columns - 1).to_pylist(), shared.value)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(best, pa.string()), pa.array(np.clip(score, 0, 1))], names_out)
    fields = ", ".join(f"`{c}` {k}" for c, k in kept.dtypes)
    t = F.col(text).cast("string").alias("_text")
    return docs.select(*keep, t).mapInArrow(run, f"{fields}, lang_pred string, score double")


def _predict_by_blocks(docs: DataFrame, model: PrototypeTable, text: str, keep: tuple[str | Column, ...]) -> DataFrame:
    """``predict`` for a table of prototypes, a block of languages after the other."""
    kept = docs.select(*keep)
    t, = fresh(kept, "_text")
    out = docs.select(*keep, F.col(text).cast("string").alias(t), F.lit(None).cast("string").alias("lang_pred"), F.lit(-2.0).alias("score"))

    def better(block: Prototypes):
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                *rest, old, before = batch.columns
                best, score = best_languages(rest[-1].to_pylist(), shared.value)
                pairs = [(lang, s) if s > b or s == b and lang < o else (o, b)
                         for lang, s, o, b in zip(best, score.tolist(), old.to_pylist(), before.to_pylist())]
                yield pa.RecordBatch.from_arrays([*rest, pa.array([x for x, _ in pairs], pa.string()),
                                                  pa.array([s for _, s in pairs], pa.float64())], batch.schema.names)
        return run
    for i, block in enumerate(b for b in model if b.languages):
        out = (cut(out) if i and i % BLOCKS == 0 else out).mapInArrow(better(block), out.schema)
    found = F.coalesce(F.col("lang_pred"), F.lit(UNKNOWN))
    return out.select(*kept.columns, found.alias("lang_pred"), F.greatest(F.lit(0.0), F.least(F.lit(1.0), "score")).alias("score"))
