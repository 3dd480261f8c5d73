"""Problem 9: passages of held-out items inside documents.

A MinHash containment search in partitions by size. An item is short and a
document may be a thousand times longer, so the Jaccard similarity of the whole
sets says nothing. Both sides are therefore cut to comparable sizes: an item
into segments a little shorter than half of the smallest stretch to be found,
a document into windows of each size class. A segment is looked up among the
windows of its own class, by the smallest hash under each of ``HASHES``
permutations; one agreement makes a candidate. A candidate document is then
verified by the exact shingles it shares with the item in one stretch.

The items are a stated query set; they are sent to the executors in blocks of
``BLOCK`` items, and each block reads the documents once.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codexmill.llm.vectext import M1, Tokens, mix, portions

WORDS, IDEOGRAPHS = 3, 5
CLASSES = (4, 8, 16, 32)  # segment sizes in shingles; windows are twice as long
HASHES = 16
BLOCK = 5_000
BITS = 20
SHARE = 0.4
SLACK = 0.08  # of the share, for shingles lost at the ends and to changed words
# a tag is well formed on one line; a reference or comment holds no other opening and no empty line, so that a broken one ends nowhere
TAG = r"</?[A-Za-z][A-Za-z0-9]*(?:[ \t][^<>\n]*)?/?>"
TARGET = r"\[\[[^\[\]|\n]*\|"
MARKS = re.compile(rf"<!--|-->|{TAG}|{TARGET}")
ASIDE = re.compile(rf"<ref(?:[ \t][^<>\n]*)?(?<!/)>(?:(?!</?ref\b|\n[ \t]*\n).)*</ref>|<!--(?:(?!<!--|-->|\n[ \t]*\n).)*-->|{TAG}|{TARGET}", re.S)


def forms(text: str | None) -> list[str]:
    """The texts to be searched: as stored, without marks but with what they enclose, and without references and comments.

    No form alone will do: a passage may stand inside a reference, a comment
    or a link target, and another may have one in its middle. Equal forms
    come once; null and empty texts have none.
    """
    if not text:
        return []
    if "<" not in text and "-->" not in text and "|" not in text:
        return [text]
    return list(dict.fromkeys((text, MARKS.sub(" ", text), ASIDE.sub(" ", text))))


class Items:
    """The queries, cut into segments, ready to be looked up."""

    def __init__(self, ids: list[int], texts: list[str], share: float = SHARE):
        tokens = Tokens(texts)
        hashes, fits = tokens.shingles(WORDS, IDEOGRAPHS)
        self.ids = np.array(ids)
        self.share = share
        self.shingles, self.sizes = [], []
        keys: dict[int, list[np.ndarray]] = {c: [] for c in CLASSES}
        for i in range(len(texts)):
            a, b = tokens.first[i], tokens.first[i + 1]
            own = hashes[a:b][fits[a:b]]
            self.shingles.append(own)
            self.sizes.append(b - a)
            if not len(own):
                continue
            half = max(1, int(share * len(own) / 2))
            size = max([c for c in CLASSES if c <= half], default=CLASSES[0])
            step = max(1, size // 2)
            for at in range(0, max(1, len(own) - size + 1), step):
                keys[size].append(own[at : at + size])
        self.keys = {c: np.unique(np.concatenate([signature(s) for s in segments])) if segments else None for c, segments in keys.items()}
        # items with no shingle are looked up whole: by the number of their tokens, the hash of all of them
        self.short: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        few = [(n, whole(tokens.hash[tokens.first[i] : tokens.first[i + 1]], n)[0], i) for i, n in enumerate(self.sizes) if n and not len(self.shingles[i])]
        for n in {n for n, _, _ in few}:
            own = sorted((h, i) for m, h, i in few if m == n)
            self.short[n] = np.array([h for h, _ in own], np.uint64), np.array([i for _, i in own])
        flat = np.concatenate(self.shingles) if self.shingles else np.zeros(0, np.uint64)
        order = np.argsort(flat, kind="stable")
        self.flat = flat[order]
        self.item = np.repeat(np.arange(len(texts)), [len(s) for s in self.shingles])[order]
        self.place = np.concatenate([np.arange(len(s)) for s in self.shingles] or [np.zeros(0, int)])[order]
        self.maps = {c: bitmap(k) for c, k in self.keys.items() if k is not None}
        self.map = bitmap(self.flat)


def bitmap(keys: np.ndarray) -> np.ndarray:
    out = np.zeros(1 << BITS, bool)
    out[keys >> np.uint64(64 - BITS)] = True
    return out


def whole(hashes: np.ndarray, n: int) -> np.ndarray:
    """A hash of each ``n`` tokens in a row, of whatever kind."""
    h = np.zeros(max(0, len(hashes) - n + 1), np.uint64)
    for k in range(n):
        h = h * M1 + hashes[k : k + len(h)]
    return mix(h)


def short_hits(tokens: Tokens, items: Items) -> list[tuple[int, int]]:
    """(document, item) for the items with no shingle that stand whole in a document of the batch."""
    out: set[tuple[int, int]] = set()
    for n, (keys, owners) in items.short.items():
        h = whole(tokens.hash, n)
        lo, hi = np.searchsorted(keys, h, "left"), np.searchsorted(keys, h, "right")
        for at in np.flatnonzero(hi > lo).tolist():
            if tokens.doc[at] == tokens.doc[at + n - 1]:
                out |= {(int(tokens.doc[at]), int(i)) for i in owners[lo[at] : hi[at]]}
    return sorted(out)


SALTS = mix(np.arange(1, HASHES + 1, dtype=np.uint64) * M1) | np.uint64(1)


def permuted(x: np.ndarray, k: int) -> np.ndarray:
    return (x ^ (x >> np.uint64(29))) * SALTS[k]


def tagged(x: np.ndarray, k: int) -> np.ndarray:
    return mix(np.atleast_1d(x) + np.uint64(k))


def signature(shingles: np.ndarray) -> np.ndarray:
    """The smallest hash of a segment under each permutation, tagged with the permutation."""
    return np.concatenate([tagged(permuted(shingles, k).min(), k) for k in range(HASHES)])


def candidates(hashes: np.ndarray, fits: np.ndarray, doc: np.ndarray, items: Items) -> np.ndarray:
    """The documents of a batch with a window that agrees with a segment under some permutation.

    Documents that share no shingle with any item can't be verified, and are left out first.
    """
    x, d = hashes[fits], doc[fits]
    maybe = np.flatnonzero(items.map[x >> np.uint64(64 - BITS)])
    maybe = maybe[np.isin(x[maybe], items.flat)]
    if len(maybe):
        shares = np.zeros(d[-1] + 1, bool)
        shares[d[maybe]] = True
        x, d = x[shares[d]], d[shares[d]]
    else:
        x, d = x[:0], d[:0]
    found: list[np.ndarray] = []
    if not len(x):
        return np.zeros(0, np.int64)
    opens = np.flatnonzero(np.append(True, d[1:] != d[:-1]))
    # blocks of CLASSES[0] shingles that don't cross documents
    within = np.arange(len(x)) - np.repeat(opens, np.diff(np.append(opens, len(x))))
    edges = np.flatnonzero(within % CLASSES[0] == 0)
    owner = d[edges]
    for k in range(HASHES):
        low = np.minimum.reduceat(permuted(x, k), edges)
        for c in CLASSES:
            if c > CLASSES[0]:
                # a block of this class is two of the one before, at every second place
                low = paired(low, owner, c // CLASSES[0] // 2)
            if items.keys[c] is None:
                continue
            window = tagged(paired(low, owner, c // CLASSES[0]), k)
            maybe = np.flatnonzero(items.maps[c][window >> np.uint64(64 - BITS)])
            if len(maybe):
                at = np.searchsorted(items.keys[c], window[maybe])
                hit = items.keys[c][np.minimum(at, len(items.keys[c]) - 1)] == window[maybe]
                found.append(owner[maybe[hit]])
    return np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)


def paired(low: np.ndarray, owner: np.ndarray, ahead: int) -> np.ndarray:
    """The smaller of each block's value and that of the block ``ahead``, where both are of one document."""
    out = low.copy()
    if ahead < len(low):
        same = owner[ahead:] == owner[:-ahead]
        np.minimum(out[:-ahead], low[ahead:], out=out[:-ahead], where=same)
    return out


def stretches(hashes: np.ndarray, items: Items) -> dict[int, float]:
    """Of each item met in a document: the share of its shingles that stand in one stretch of it, exactly."""
    lo = np.searchsorted(items.flat, hashes, "left")
    hi = np.searchsorted(items.flat, hashes, "right")
    n = hi - lo
    where = np.flatnonzero(n)
    if not len(where):
        return {}
    n = n[where]
    rows = np.repeat(lo[where], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    doc_at, item, item_at = np.repeat(where, n), items.item[rows], items.place[rows]
    out: dict[int, float] = {}
    order = np.lexsort((doc_at, item))
    doc_at, item, item_at = doc_at[order], item[order], item_at[order]
    for i in np.unique(item):
        a, b = np.searchsorted(item, [i, i + 1])
        size = len(items.shingles[i])
        span = size + max(10, size // 2)
        p, q = doc_at[a:b], item_at[a:b]
        best, left = 0, 0
        seen: dict[int, int] = {}
        for right in range(len(p)):
            seen[q[right]] = seen.get(q[right], 0) + 1
            while p[right] - p[left] > span:
                seen[q[left]] -= 1
                if not seen[q[left]]:
                    del seen[q[left]]
                left += 1
            best = max(best, len(seen))
        out[int(i)] = best / size
    return out


def leaks(documents: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", share: float = SHARE, block: int = BLOCK) -> DataFrame:
    """(doc_id, item_id, share): documents that hold at least about ``share`` of an item in one stretch.

    Null and empty texts leak nothing; an item shorter than one shingle leaks
    where it stands whole; repeated items and documents are reported once per id. Every form of
    a document is searched, and the greatest share counts. Other columns are not
    read. An empty side gives an empty result.
    """
    spark = documents.sparkSession
    corpus = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).where("text <> ''")
    wanted = items.select(F.col(item_id).cast("long").alias("item_id"), F.col(item_text).alias("text")).where("text <> ''").orderBy("item_id", "text")
    found, rows = None, []

    def search(held: list) -> DataFrame:
        # what a reference or comment of an item encloses is part of the item
        sides = [(r[0], t) for r in held for t in forms(r[1])[:2]]
        send = spark.sparkContext.broadcast(([i for i, _ in sides], [t for _, t in sides]))

        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = Items(*send.value, share=share)
            for batch in batches:
                sides = [(i, t) for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) for t in forms(text)]
                ids, texts = [i for i, _ in sides], [t for _, t in sides]
                out = []
                for part in portions(texts):
                    tokens = Tokens(texts[part])
                    hashes, fits = tokens.shingles(WORDS, IDEOGRAPHS)
                    out += [(ids[part.start + i], int(index.ids[j]), 1.0) for i, j in short_hits(tokens, index)]
                    for i in candidates(hashes, fits, tokens.doc, index):
                        a, b = tokens.first[i], tokens.first[i + 1]
                        own = hashes[a:b][fits[a:b]]
                        out += [(ids[part.start + i], int(index.ids[j]), s) for j, s in stretches(own, index).items() if s >= share - SLACK]
                yield pa.RecordBatch.from_pandas(pd.DataFrame(out, columns=["doc_id", "item_id", "share"]).astype({"doc_id": "int64", "item_id": "int64", "share": "float64"}), preserve_index=False)

        return corpus.mapInArrow(scan, "doc_id long, item_id long, share double")

    for row in wanted.toLocalIterator():
        rows.append(row)
        if len(rows) == block:
            found = search(rows) if found is None else found.unionByName(search(rows))
            rows = []
    if rows or found is None:
        found = search(rows) if found is None else found.unionByName(search(rows))
    return found.groupBy("doc_id", "item_id").agg(F.max("share").alias("share"))
