"""Problem 7: near-duplicate texts with small edits, insertions or reordering.

Texts in one form (see ``canonical``) are counted once however many records
carry them. Their shingles are weighted by TF-IDF, sampled by improved
consistent weighted sampling, and the samples banded; texts that agree in a
band are verified by the exact weighted Jaccard similarity of their shingles.

Document frequencies are kept in ``2**IDF_BITS`` hashed counters summed over all
texts, so the weights are a table of fixed size at any size of corpus.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from codexmill.llm.canonical import canonical
from codexmill.llm.vectext import M1, Tokens, mix, portions, table_sum
from codexmill.session import drop_written, written

WORDS, IDEOGRAPHS = 2, 4
IDF_BITS = 20
TEXT_BITS = 18  # of the number of a text among those that are worked on at once
BANDS, ROWS = 48, 4
SIMILARITY = 0.36
POWER = 2  # of the inverse document frequency: wording that many texts share hardly counts
TABLE, LEVELS = 1 << 10, 32
TOGETHER = 4  # samples whose ranks, drawn apart, stand at one place of a table and are looked up at once
LOG_WEIGHTS = (-2.3, 8.5)  # range of log weights that are told apart in sampling
SLICE = 256  # members of a band that are compared in one piece
READ = 8 << 20  # bytes of bands that a task reads


def leaves(text: str | None) -> str:
    """The text inside a JSON document: its strings in order, without those that name a kind; other text as it is."""
    if not text:
        return ""
    if text[0] not in '{["':
        return text
    try:
        value = json.loads(text)
    except ValueError:
        return text
    if isinstance(value, str) and value[:1] in ("{", "["):
        return leaves(value)
    out: list[str] = []
    stack = [value]
    while stack:
        x = stack.pop()
        if isinstance(x, str):
            out.append(x)
        elif isinstance(x, list):
            stack += reversed(x)
        elif isinstance(x, dict):
            stack += [v for k, v in reversed(x.items()) if k not in ("type", "id", "lang", "language", "class", "style", "href", "src")]
    return "\n".join(out)


@F.pandas_udf(T.StringType())
def leaves_udf(texts: pd.Series) -> pd.Series:
    return texts.map(leaves)


def features(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(shingle, term frequency, first): the distinct shingles of each text, sorted, and where each text's begin.

    A text shorter than one shingle has its tokens for shingles. Hashes have
    ``64 - TEXT_BITS`` bits, in front.
    """
    tokens = Tokens(texts)
    h, fits = tokens.shingles(WORDS, IDEOGRAPHS)
    counts = np.diff(tokens.first)
    short = np.bincount(tokens.doc[fits], minlength=len(texts)) == 0 if len(h) else np.ones(len(texts), bool)
    if len(h):
        alone = short[tokens.doc]
        h = np.where(alone, tokens.hash, h)
        fits = fits | alone
    # the text in front and the hash behind it in one number, so that one plain sort brings both in order
    key = tokens.doc[fits].astype(np.uint64) << np.uint64(64 - TEXT_BITS) | h[fits] >> np.uint64(TEXT_BITS)
    key.sort()
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    at = np.flatnonzero(new)
    tf = np.diff(np.append(at, len(key)))
    key = key[at]
    first = np.searchsorted(key, np.arange(len(counts) + 1, dtype=np.uint64) << np.uint64(64 - TEXT_BITS)) if len(counts) else np.zeros(1, np.int64)
    return key << np.uint64(TEXT_BITS), tf, first


def slot(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(64 - IDF_BITS)).astype(np.int64)


def document_frequencies(texts: DataFrame) -> tuple[np.ndarray, int]:
    """(counters, number of texts) over the column ``form``."""

    size = 1 << IDF_BITS

    def count(table: np.ndarray, batch: pa.RecordBatch) -> None:
        rows = batch.column(0).to_pylist()
        table[size] += len(rows)
        for part in portions(rows):
            table[:size] += np.bincount(slot(features(rows[part])[0]), minlength=size)

    table = table_sum(texts.select("form"), size + 1, count)
    return table[:size].astype(float), int(table[size])


class Sampler:
    """Improved consistent weighted sampling with random numbers drawn from tables by a shingle's hash.

    Log weights are rounded to ``LEVELS`` steps before sampling, so that the
    value of a shingle depends on its place in the table and its level alone:
    all values are worked out and ranked once, and a sample is the least rank of
    a text with the shingle's hash behind it. Equal values have equal ranks, so
    a sample names a shingle and a quantised weight, as the method has it. The
    tables have a fixed size at any size of corpus.
    """

    def __init__(self, df: np.ndarray, n: int, samples: int = BANDS * ROWS, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.idf = np.log((n + 1) / (df + 0.5)).clip(0.01).astype(np.float32)
        steps = np.linspace(*LOG_WEIGHTS, LEVELS)[:, None]
        self.n = samples
        ranks = np.zeros((-(-samples // TOGETHER), LEVELS * TABLE, TOGETHER), np.uint16)
        for k in range(samples):
            r, log_c, b = rng.gamma(2, 1, TABLE), np.log(rng.gamma(2, 1, TABLE)), rng.random(TABLE)
            value = log_c - r * (np.floor(steps / r + b) - b + 1)
            ranks[k // TOGETHER, :, k % TOGETHER] = np.unique(value, return_inverse=True)[1].ravel()
        self.ranks = ranks.view(np.uint64)[:, :, 0]
        self.odd = (mix(np.arange(1, len(ranks) + 1, dtype=np.uint64) * M1) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)

    def weights(self, h: np.ndarray, tf: np.ndarray) -> np.ndarray:
        return tf * self.idf[slot(h)] ** POWER

    def samples(self, h: np.ndarray, w: np.ndarray, first: np.ndarray) -> np.ndarray:
        """One hash for each sample and text; two texts agree in one as often as their weighted Jaccard similarity."""
        full = np.flatnonzero(np.diff(first))
        out = np.zeros((self.n, len(first) - 1), np.uint32)
        if not len(full):
            return out
        low, high = LOG_WEIGHTS
        level = np.rint((np.log(w) - low) * ((LEVELS - 1) / (high - low))).clip(0, LEVELS - 1).astype(np.uint32) * np.uint32(TABLE)
        # what shares a place in the table is told apart by as many bits again
        upper, rest = (h >> np.uint64(32)).astype(np.uint32), (h >> np.uint64(TEXT_BITS)).astype(np.uint32) & np.uint32(0x1FFFF)
        at, key, starts = np.empty_like(upper), np.empty_like(rest), first[full]
        for g, ranks in enumerate(self.ranks):
            np.multiply(upper, self.odd[g], out=at)
            at >>= np.uint32(32 - TABLE.bit_length() + 1)
            at += level
            found = ranks.take(at).view(np.uint16).reshape(-1, TOGETHER)
            for j in range(min(TOGETHER, self.n - g * TOGETHER)):
                np.left_shift(found[:, j], np.uint32(17), out=key, dtype=np.uint32)
                key |= rest
                out[g * TOGETHER + j, full] = np.minimum.reduceat(key, starts)
        return out

    def bands(self, samples: np.ndarray) -> np.ndarray:
        h = np.zeros((BANDS, samples.shape[1]), np.uint64)
        for k in range(ROWS):
            h = mix(h * M1 + samples[k * BANDS : (k + 1) * BANDS])
        return mix(h + np.arange(BANDS, dtype=np.uint64)[:, None])


def jaccard(ha: np.ndarray, wa: np.ndarray, hb: np.ndarray, wb: np.ndarray) -> float:
    """Weighted Jaccard similarity of two sorted sets of shingles."""
    _, i, j = np.intersect1d(ha, hb, assume_unique=True, return_indices=True)
    low = np.minimum(wa[i], wb[j]).sum()
    return float(low / (wa.sum() + wb.sum() - low)) if low else 0.0


def packed(bands: np.ndarray, ids: np.ndarray, cells: int) -> pa.RecordBatch:
    """Rows (cell, data) of the bands of texts: each band's last 32 bits and the text's id, in one piece for each cell.

    What 32 bits and the cell don't tell apart is told by the verification. Ids
    are kept as the gaps between them, all first bytes before all second ones,
    so that in order of the ids most of it is zeros, which shuffles compress.
    """
    cell = ((bands >> np.uint64(48)) * np.uint64(cells) >> np.uint64(16)).astype(np.uint16)
    order = np.argsort(cell, kind="stable")
    cell, low, ids = cell[order], bands[order].astype(np.uint32), ids[order]
    at = np.flatnonzero(np.append(True, cell[1:] != cell[:-1])) if len(cell) else np.zeros(0, np.int64)
    gaps = np.diff(ids, prepend=0)
    gaps[at] = 0
    planes = np.ascontiguousarray(gaps.view(np.uint8).reshape(-1, 8).T)
    planes = planes[: 1 + max(np.flatnonzero(planes.any(1)), default=0)]
    data = [np.array([j - i, ids[i]], np.int64).tobytes() + low[i:j].tobytes() + planes[:, i:j].tobytes() for i, j in zip(at.tolist(), np.append(at[1:], len(cell))[: len(at)].tolist(), strict=True)]
    return pa.RecordBatch.from_arrays([pa.array(cell[at].astype(np.int32)), pa.array(data, pa.binary())], names=["cell", "data"])


def unpacked(cell: int, data: bytes) -> tuple[np.ndarray, np.ndarray]:
    n, first = np.frombuffer(data, np.int64, 2).tolist()
    band = np.frombuffer(data, np.uint32, n, 16) | np.uint64(cell << 32)
    planes = np.frombuffer(data, np.uint8, -1, 16 + 4 * n).reshape(-1, n)
    gaps = np.zeros((n, 8), np.uint8)
    gaps[:, : len(planes)] = planes.T
    return band, first + np.cumsum(gaps.view(np.int64)[:, 0])


class Meeting:
    """The pairs of ids that share a band, of the bands of a few cells.

    Bands of more than ``slice_`` ids aren't written out but handed on as rows,
    as soon as more than ``most`` entries are held, so that what is held depends
    on the number of cells and not on how many share a band.
    """

    def __init__(self, slice_: int, most: int = 1 << 22):
        self.slice, self.most, self.held, self.size = slice_, most, [], 0
        self.hot = np.zeros(0, np.uint64)

    def add(self, band: np.ndarray, ids: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.held.append((band, ids))
        self.size += len(band)
        if self.size > self.most:
            yield from self.shed()
            self.most = max(self.most, 2 * self.size)

    def shed(self) -> Iterator[pa.RecordBatch]:
        """Hand on the entries of large bands, and keep the rest in order."""
        band, ids = (np.concatenate(x) for x in zip(*self.held, strict=True))
        order = np.argsort(band)
        band, ids = band[order], ids[order]
        kinds, counts = np.unique(band, return_counts=True)
        self.hot = np.union1d(self.hot, kinds[counts > self.slice])
        out = np.isin(band, self.hot)
        if out.any():
            yield met(ids[out], band[out].view(np.int64), True)
        self.held, self.size = [(band[~out], ids[~out])], int((~out).sum())

    def pairs(self) -> Iterator[pa.RecordBatch]:
        if not self.held:
            return
        yield from self.shed()
        band, ids = self.held[0]
        # the ends of what is left of each entry's band, one place further every time
        at = np.arange(len(band))
        for ahead in range(1, self.slice):
            at = at[at + ahead < len(band)]
            at = at[band[at + ahead] == band[at]]
            if not len(at):
                return
            x, y = ids[at], ids[at + ahead]
            yield met(np.minimum(x, y), np.maximum(x, y), False)


def met(a: np.ndarray, b: np.ndarray, hot: bool) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(np.full(len(a), hot))], names=["a", "b", "hot"])


def sliced_pairs(entries: DataFrame, slice_: int = SLICE) -> DataFrame:
    """(a, b): all pairs of ids (a) that share a band (b), each of the band's pairs of slices compared by itself."""
    sized = entries.groupBy("b").agg(F.ceil(F.count("*") / slice_).cast("int").alias("slices"))
    held = entries.join(sized, "b").select(F.col("b").alias("band"), F.col("a").alias("id"), F.pmod(F.xxhash64("a"), F.col("slices")).cast("int").alias("slice"))
    left = held.select("band", "slice", F.col("id").alias("x"))
    right = held.select("band", F.explode(F.sequence(F.lit(0), "slice")).alias("slice"), F.col("slice").alias("home"), F.col("id").alias("y"))
    both = left.join(right, ["band", "slice"]).where("home > slice or x < y")
    return both.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))


def band_pairs(texts: DataFrame, bands_of: Callable[[pa.RecordBatch], Iterator[tuple[np.ndarray, np.ndarray]]], parts: int, slice_: int = SLICE) -> DataFrame:
    """(a, b) with a < b: all pairs of ids that share a band, each once; ``bands_of`` gives the bands of a batch's texts, a column for each, and their ids.

    Bands are shuffled packed, in one piece from each task to each of ``parts``
    tasks, and met there in arrays. Bands that many share are cut into slices,
    so that none is one task's work.
    """
    cells = min(8 * parts, 1 << 16)

    def piece(held: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        bands, ids = (np.concatenate(x, axis=-1) for x in zip(*held, strict=True))
        order = np.argsort(ids)
        return packed(bands[:, order].T.ravel(), np.repeat(ids[order], len(bands)), cells)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for bands, ids in bands_of(batch):
                held.append((bands, ids))
                size += bands.size
                if size > 1 << 20:
                    yield piece(held)
                    held, size = [], 0
        if held:
            yield piece(held)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        meeting = Meeting(slice_)
        for batch in batches:
            for cell, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                yield from meeting.add(*unpacked(cell, data))
        yield from meeting.pairs()

    found = written(texts.mapInArrow(pack, "cell int, data binary").repartition(parts, "cell").mapInArrow(meet, "a long, b long, hot boolean"), "met")
    return found.where("not hot").select("a", "b").unionByName(sliced_pairs(found.where("hot").select("a", "b"), slice_)).distinct()


def similar_texts(texts: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(a, b, similarity) with a < b, of distinct texts (id, field, form); only texts of one field are compared.

    Ids are whole numbers. Empty texts have no shingles and are similar to nothing.
    """
    spark = texts.sparkSession
    df, n = document_frequencies(texts)
    send = spark.sparkContext.broadcast(Sampler(df, n))

    def bands_of(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        s = send.value
        ids, fields, rows = batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(2).to_pylist()
        for part in portions(rows, 150_000):
            h, tf, first = features(rows[part])
            bands = s.bands(s.samples(h, s.weights(h, tf), first)) ^ mix(fields[part].astype(np.uint64) + M1)
            full = np.flatnonzero(np.diff(first))
            yield bands[:, full], ids[part][full]

    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n * BANDS * 8 // READ))
    pairs = written(band_pairs(texts.select("id", "field", "form"), bands_of, parts), "pairs")
    known = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    forms = written(texts.select("id", "form").join(known.hint("shuffle_hash"), "id", "left_semi"), "known")
    both = pairs.join(forms.toDF("a", "form_a"), "a").join(forms.toDF("b", "form_b"), "b")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = send.value
        for batch in batches:
            left, right = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            scores = []
            for part in portions(left):
                sides = []
                for rows in (left[part], right[part]):
                    h, tf, first = features(rows)
                    sides.append((h, s.weights(h, tf), first))
                (ha, wa, fa), (hb, wb, fb) = sides
                scores += [jaccard(ha[fa[i] : fa[i + 1]], wa[fa[i] : fa[i + 1]], hb[fb[i] : fb[i + 1]], wb[fb[i] : fb[i + 1]]) for i in range(len(fa) - 1)]
            keep = pa.array([x >= similarity for x in scores], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(scores, pa.float64())], names=["a", "b", "similarity"]).filter(keep)

    return both.select("a", "b", "form_a", "form_b").mapInArrow(verify, "a long, b long, similarity double")


def formed(localizations: DataFrame) -> DataFrame:
    """(locId, late, unit, field, form) of the summaries (field 0) and description texts (1) of all deliveries, where they lie."""
    unit = F.lower(F.regexp_replace("unitId", r"^\s+|\s+$", "")).alias("unit")
    rows = localizations.where("locId is not null").select("locId", F.struct("capturedAt", "updatedAt").alias("late"), unit, "summary", "description")

    def form(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for field, read in ((0, str), (1, leaves)):
                made = [(i, f) for i, t in enumerate(batch.column(3 + field).to_pylist()) if t and (f := (canonical(read(t)) or "").lower())]
                at = pa.array([i for i, _ in made], pa.int32())
                yield pa.RecordBatch.from_arrays([*(batch.column(k).take(at) for k in range(3)), pa.array([field] * len(made), pa.int32()), pa.array([f for _, f in made], pa.string())], names=["locId", "late", "unit", "field", "form"])

    late = rows.schema["late"].dataType.simpleString()
    return rows.mapInArrow(form, f"locId long, late {late}, unit string, field int, form string")


def near_duplicate_classes(localizations: DataFrame, excluded: DataFrame | None = None, similarity: float = SIMILARITY) -> tuple[DataFrame, DataFrame]:
    """(members, links): localizations with the class of each of their texts, and the pairs of classes that are nearly the same.

    ``members`` holds (class, field, locId, unit): texts that look the same are
    one class, however many carry it. ``links`` holds (a, b, similarity), a < b,
    of classes of one field. Neither grows with the pairs within a class. Null
    and empty texts are no text; repeated deliveries count once, by their last;
    ``excluded`` holds the ``locId`` of those that take no part.
    """
    # two hashes of 64 bits stand for a form
    texts = written(formed(localizations).select("*", F.xxhash64(F.lit(1), "form").alias("k1"), F.xxhash64(F.lit(2), "form").alias("k2"), F.monotonically_increasing_id().alias("id")), "formed")
    last = localizations.where("locId is not null").groupBy("locId").agg(F.max(F.struct("capturedAt", "updatedAt")).alias("last"))
    live = texts.drop("form").join(last.hint("shuffle_hash"), "locId").where("late <=> last").drop("late", "last")
    if excluded is not None:
        live = live.join(excluded.select("locId").hint("shuffle_hash"), "locId", "left_anti")
    spark = localizations.sparkSession
    live = written(live.groupBy("locId", "unit", "field", "k1", "k2").agg(F.min("id").alias("id")), "live")
    # the first row of a class stands for it
    classes = live.groupBy("field", "k1", "k2").agg(F.min("id").alias("class"))
    members = written(live.drop("id").join(classes.hint("shuffle_hash"), ["field", "k1", "k2"]).select("class", "field", "locId", "unit"), "members")
    drop_written(spark, live)
    standing = members.select(F.col("class").alias("id")).distinct()
    kept = written(texts.select("id", "field", "form").join(standing.hint("shuffle_hash"), "id", "left_semi"), "classes")
    drop_written(spark, texts)
    links = similar_texts(kept, similarity)
    # the links read only the texts of candidates, which are written by themselves
    drop_written(spark, kept)
    return members, links


def near_duplicates(localizations: DataFrame, excluded: DataFrame | None = None, similarity: float = SIMILARITY) -> DataFrame:
    """(locIdA, locIdB): localizations of different books whose summaries, or description texts, are nearly the same.

    The classes of ``near_duplicate_classes`` written out into pairs.
    """
    members, links = near_duplicate_classes(localizations, excluded, similarity)
    m = members.select("class", "locId", "unit")
    a, b = m.toDF("a", "locIdA", "unitA"), m.toDF("b", "locIdB", "unitB")
    different = links.join(a, "a").join(b, "b").where("unitA <> unitB").select("locIdA", "locIdB")
    several = m.groupBy("class").agg(F.count("*").alias("n")).where("n > 1").select(F.col("class").alias("a"))
    equal = a.join(several.hint("shuffle_hash"), "a", "left_semi").join(b.withColumnRenamed("b", "a"), "a").where("unitA <> unitB and locIdA < locIdB").select("locIdA", "locIdB")
    return different.unionByName(equal).select(F.least("locIdA", "locIdB").alias("locIdA"), F.greatest("locIdA", "locIdB").alias("locIdB")).distinct()
