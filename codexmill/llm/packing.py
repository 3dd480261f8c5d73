"""Problem 8: filling containers of fixed capacity with whole documents.

Sizes are tokens of a public tokenizer. Documents are dealt to shards by hash;
a shard holds at most about ``SHARD`` documents and is packed by one task, so
neither a task nor the driver ever holds more. In a shard, documents above a
third of the capacity are matched first, at most two to a container: the largest
left takes the largest that still fits beside it. The smaller ones then fill the
remaining gaps, largest first, each where the least space stays unused.
"""

from __future__ import annotations

import base64
import math
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codexmill.session import written

TOKENIZERS = "/opt/tokenizers"
# Fixed value: the pattern by which this public vocabulary parts a text before its merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
CAPACITY = 2048
SHARD = 40_000


@lru_cache(maxsize=2)
def encoding(folder: str = TOKENIZERS, name: str = "byte_bpe_50k.tiktoken"):
    """A byte-level BPE tokenizer from its public rank file."""
    import tiktoken

    with open(f"{folder}/{name}", "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding(name, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def pieces(text: str, enc, capacity: int) -> list[tuple[int, int, int]]:
    """(begin, end, tokens) of a text's pieces: the text itself, or as few pieces as possible, none above the capacity."""
    if (n := len(enc.encode_ordinary(text))) <= capacity:
        return [(0, len(text), n)]
    out, at = [], 0
    while at < len(text):
        tokens = enc.encode_ordinary(text[at : at + 16 * capacity])
        if len(tokens) <= capacity:
            end = min(len(text), at + 16 * capacity)
            n = len(tokens)
        else:
            n = capacity
            while True:
                part = enc.decode_bytes(tokens[:n]).decode("utf-8", "ignore")
                size = len(enc.encode_ordinary(part))
                if part and size <= capacity:
                    break
                n -= 1
            end, n = at + len(part), size
        out.append((at, end, n))
        at = end
    return out


def fill(sizes: list[int], capacity: int) -> list[int]:
    """The container of each item."""
    order = sorted(range(len(sizes)), key=lambda i: (-sizes[i], i))
    large = [i for i in order if 3 * sizes[i] > capacity]
    home = [-1] * len(sizes)
    gaps: list[int] = []
    # matching: a list of large items of each size, and a mask of the sizes there are
    by_size: list[list[int]] = [[] for _ in range(capacity + 1)]
    mask = 0
    for i in reversed(large):
        by_size[sizes[i]].append(i)
        mask |= 1 << sizes[i]

    def take(limit: int) -> int:
        nonlocal mask
        fits = mask & ((1 << (limit + 1)) - 1)
        if not fits:
            return -1
        size = fits.bit_length() - 1
        i = by_size[size].pop()
        if not by_size[size]:
            mask &= ~(1 << size)
        return i

    while (i := take(capacity)) >= 0:
        home[i] = len(gaps)
        gap = capacity - sizes[i]
        if 3 * gap > capacity and (j := take(gap)) >= 0:
            home[j] = len(gaps)
            gap -= sizes[j]
        gaps.append(gap)
    open_by_gap: list[list[int]] = [[] for _ in range(capacity + 1)]
    mask = 0
    for k, gap in enumerate(gaps):
        open_by_gap[gap].append(k)
        mask |= 1 << gap
    for i in order[len(large) :]:
        fits = mask >> sizes[i]
        if fits:
            gap = sizes[i] + (fits & -fits).bit_length() - 1
            k = open_by_gap[gap].pop()
            if not open_by_gap[gap]:
                mask &= ~(1 << gap)
        else:
            k, gap = len(gaps), capacity
            gaps.append(gap)
        home[i] = k
        gap -= sizes[i]
        open_by_gap[gap].append(k)
        mask |= 1 << gap
    return home


def sized(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY, tokenizers: str = TOKENIZERS) -> DataFrame:
    """(doc_id, piece, begin, end, tokens): each document's pieces, one unless it alone exceeds the capacity."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding(tokenizers)
        for batch in batches:
            rows = []
            for d, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                rows += [(d, k, a, b, n) for k, (a, b, n) in enumerate(pieces(t, enc, capacity))]
            cols = list(zip(*rows, strict=True)) or [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32()), strict=True)], names=["doc_id", "piece", "begin", "end", "tokens"])

    return documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")).mapInArrow(count, "doc_id long, piece int, begin int, end int, tokens int")


def containers(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY, shard: int = SHARD, tokenizers: str = TOKENIZERS) -> DataFrame:
    """(container, doc_id, piece, begin, end, tokens): every document in exactly one container, none above the capacity.

    ``begin`` and ``end`` are places in characters. Null and empty texts have no
    tokens and take no space, but are placed as well; repeated rows are placed
    once each. A document is split only if it alone exceeds the capacity.
    """
    items = written(sized(documents, doc_id, text, capacity, tokenizers), "sizes")
    shards = max(1, math.ceil(items.count() / shard))

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["doc_id", "piece"], kind="stable").reset_index(drop=True)
        pdf["container"] = pdf["shard"].astype("int64") * (1 << 32) + pd.Series(fill(pdf["tokens"].tolist(), capacity), dtype="int64")
        return pdf[["container", "doc_id", "piece", "begin", "end", "tokens"]]

    dealt = items.withColumn("shard", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(shards)).cast("int"))
    return dealt.groupBy("shard").applyInPandas(pack, "container long, doc_id long, piece int, begin int, end int, tokens int")
