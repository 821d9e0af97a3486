"""Token ids of a corpus by a public byte-level BPE vocabulary.

Texts are cut by the vocabulary's pattern. Within a cut the byte tokens are
the leaves of a segment tree over the ranks of adjacent pairs: its root is
the leftmost pair of lowest rank, a merge updates three leaves, and merging
goes on until the root holds no pair. A cut of n bytes takes O(n log n),
however long it is. Cuts are remembered, since most recur.

Defined cases: null has null ids, an empty text the empty list; text that
looks like a special token is plain text; lone surrogates become the
replacement character. The vocabulary is read by the driver from a path
given as a parameter and broadcast: its size is fixed, 50,256 entries.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapesh.runtime import spread

VOCABULARY_PATH = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: the pattern by which byte_bpe_50k cuts texts.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Cuts that a worker remembers, each of at most LONGEST bytes.
REMEMBERED, LONGEST = 300_000, 64
_NONE = 1 << 62


def load_ranks(path: str = VOCABULARY_PATH) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


def merge(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one cut."""
    n = len(word)
    parts = [word[i : i + 1] for i in range(n)]
    if n == 1:
        return [ranks[word]]
    shift = n.bit_length()
    size = 1 << (n - 2).bit_length() if n > 2 else 1
    tree = [_NONE] * (2 * size)  # leaf i: rank and place of the pair that starts at token i
    get = ranks.get
    for i in range(n - 1):
        if (r := get(word[i : i + 2])) is not None:
            tree[size + i] = r << shift | i
    for k in range(size - 1, 0, -1):
        a, b = tree[2 * k], tree[2 * k + 1]
        tree[k] = a if a < b else b
    after = list(range(1, n + 1))
    before = list(range(-1, n - 1))
    place = (1 << shift) - 1

    def put(i: int, value: int) -> None:
        k = size + i
        tree[k] = value
        k >>= 1
        while k:
            a, b = tree[2 * k], tree[2 * k + 1]
            low = a if a < b else b
            if tree[k] == low:
                break
            tree[k] = low
            k >>= 1

    while (top := tree[1]) != _NONE:
        i = top & place
        j = after[i]
        parts[i] += parts[j]
        k = after[i] = after[j]
        if j < n - 1:
            put(j, _NONE)
        if k < n:
            before[k] = i
            r = get(parts[i] + parts[k])
            put(i, _NONE if r is None else r << shift | i)
        else:
            put(i, _NONE)
        if (h := before[i]) >= 0:
            r = get(parts[h] + parts[i])
            put(h, _NONE if r is None else r << shift | h)
    out, i = [], 0
    while i < n:
        out.append(ranks[parts[i]])
        i = after[i]
    return out


def encoder(ranks: dict[bytes, int], pattern: str = PATTERN) -> Callable[[str], list[int]]:
    import regex

    cut = regex.compile(pattern).findall
    memory: dict[str, list[int]] = {}

    def encode(text: str) -> list[int]:
        out: list[int] = []
        for word in cut(text):
            ids = memory.get(word)
            if ids is None:
                try:
                    raw = word.encode()
                except UnicodeEncodeError:
                    raw = word.encode("utf-16", "surrogatepass").decode("utf-16", "replace").encode()
                ids = merge(raw, ranks)
                if len(raw) <= LONGEST and len(memory) < REMEMBERED:
                    memory[word] = ids
            out += ids
        return out

    return encode


def _shared(spark: SparkSession, path: str):
    return spark.sparkContext.broadcast(load_ranks(path))


def encode_texts(df: DataFrame, text: str, out: str = "ids", path: str = VOCABULARY_PATH) -> DataFrame:
    """df with out, the array of ids of text."""
    ranks, df = _shared(df.sparkSession, path), spread(df)

    def ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encode = encoder(ranks.value)
        for batch in batches:
            yield pa.array([None if t is None else encode(t) for t in batch.to_pylist()], pa.list_(pa.int32()))

    return df.withColumn(out, F.arrow_udf(ids, "array<int>").asNondeterministic()(text))


def decode_texts(df: DataFrame, ids: str, out: str = "text", path: str = VOCABULARY_PATH) -> DataFrame:
    """df with out, the text of an array of ids; null for null."""
    ranks, df = _shared(df.sparkSession, path), spread(df)

    def text(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        token = {i: b for b, i in ranks.value.items()}
        for batch in batches:
            yield pa.array([None if x is None else b"".join(map(token.__getitem__, x)).decode("utf-8", "replace") for x in batch.to_pylist()], pa.string())

    return df.withColumn(out, F.arrow_udf(text, "string")(ids))


def count_tokens(df: DataFrame, text: str, out: str = "n_tokens", path: str = VOCABULARY_PATH) -> DataFrame:
    """df with out, the number of ids of text; null for null."""
    ranks, df = _shared(df.sparkSession, path), spread(df)

    def number(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encode = encoder(ranks.value)
        for batch in batches:
            yield pa.array([None if t is None else len(encode(t)) for t in batch.to_pylist()], pa.int64())

    return df.withColumn(out, F.arrow_udf(number, "bigint").asNondeterministic()(text))
