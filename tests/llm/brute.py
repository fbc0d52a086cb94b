"""Plain Python versions of the operators, for small tables."""

from __future__ import annotations

import base64
import hashlib
import re
from collections import Counter
from functools import lru_cache

import duckdb
import public_tokenizers
import tiktoken
import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def sha(text):
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()


def tokenizer():
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def fingerprint(text, k=4):
    w = words("".join(c.lower() if c < "\x80" else c for c in (text or "")))
    if not w:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(w[i:i + k]).encode(), 42) for i in range(max(1, len(w) - k + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(prints, radius=4):
    """Root position per position."""
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i
    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]


def kept_words(texts, window=35):
    all_words = [words(t) for t in texts]
    seen = Counter(tuple(w[i:i + window]) for w in all_words for i in range(len(w) - window + 1))
    out = []
    for w in all_words:
        keep = [True] * len(w)
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i:i + window])] > 1:
                keep[i:i + window] = [False] * window
        out.append([x for x, k in zip(w, keep) if k])
    return out


def first_words(text, n):
    spans = [m.end() for m in WORD.finditer(text)]
    return text[:spans[n - 1]] if n else ""


def sql_over(documents, sql):
    """Rows of ``sql`` over a pandas frame as the table documents."""
    con = duckdb.connect()
    con.register("documents_frame", documents)
    con.execute("CREATE TABLE documents AS SELECT * FROM documents_frame")
    return con.execute(sql).df()


@lru_cache(maxsize=1)
def tokenizer_once():
    return tokenizer()
