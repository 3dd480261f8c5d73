"""Candidate search by an inverted index of character n-grams, and texts one edit apart."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructType

from codexmill.operators.catalog import top_each


IDEOGRAPHS = r"[\u3040-\u30ff\u3400-\u9fff\uac00-\ud7af\uf900-\ufaff]"


def by_script(c: Column | str, ideographs: int = 2, letters: int = 6) -> Column:
    """The length of n-grams for a text: shorter where it has ideographs, kana or syllables, of which each says more."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(c.rlike(IDEOGRAPHS), F.lit(ideographs)).otherwise(F.lit(letters))


def ngrams(c: Column | str, n: int | Column) -> Column:
    """The distinct n-grams of a text; a shorter text is one by itself, an empty one has none."""
    c, n = F.col(c) if isinstance(c, str) else c, F.lit(n) if isinstance(n, int) else n
    places = F.when(F.length(c) >= n, F.sequence(F.lit(1), F.length(c) - (n - 1)))
    whole = F.when(c != "", F.array(c)).otherwise(F.array().cast("array<string>"))
    return F.coalesce(F.array_distinct(F.transform(places, lambda i: F.substr(c, i, n))), whole)


def candidates(rows: DataFrame, ident: str, text: str, n: int | Column = 3, budget: int = 50, most: int = 20) -> DataFrame:
    """(source, candidate, score, rank): the texts most alike to each, by shared n-grams over all of both.

    Equal texts are compared once and go by their smallest id. The n-grams of
    a text are ordered by rarity; what two texts share begins with some n-gram
    and lies in the rest of both behind it. So texts with the same rest and
    size form a class of that n-gram, whose members all score alike: classes
    are compared instead of texts, and the first ids of a class stand for it
    (``_nearest``). The more frequent an n-gram is, the fewer can stand behind
    it, so it has few classes. Nothing is left out. ``budget`` has no effect
    any more and is kept for callers. Ids are unique; ties go to the smaller
    id. Null and empty texts take no part. Texts and n-grams are told by
    hashes of 64 bits, so that no text is shuffled with a pair.
    """
    held = rows.where(F.col(text) != "").select(F.col(ident).alias("id"), F.col(text).alias("s"), F.xxhash64(text).alias("t"), F.lit(n).alias("n") if isinstance(n, int) else n.alias("n"))
    known = held.groupBy("t").agg(F.min("id").alias("text"), F.first("n").alias("n"), F.first("s").alias("s"))
    texts = known.select("text", F.transform(ngrams("s", F.col("n")), lambda g: F.xxhash64(g)).alias("grams"))
    entries = texts.select("text", F.size("grams").alias("size"), F.explode("grams").alias("gram"))
    # an n-gram of one text leads nowhere, it counts for the size alone
    common = entries.join(entries.groupBy("gram").agg(F.count("*").alias("df")).where("df > 1"), "gram")
    ordered = common.groupBy("text", "size").agg(F.array_sort(F.collect_list(F.struct("df", "gram")))["gram"].alias("grams"))
    rests = ordered.select("text", "size", "grams", F.posexplode("grams").alias("place", "gram")).select("gram", "text", "size", F.slice("grams", F.col("place") + 1, F.size("grams")).alias("rest")).withColumn("class", F.xxhash64("rest", "size"))
    kind = rests.schema["text"].dataType
    near = StructType().add("text", kind).add("near", ArrayType(kind)).add("scores", ArrayType(DoubleType()))
    met = rests.repartition("gram").sortWithinPartitions("gram", "class", "text").mapInArrow(_nearest(most + 1), near)
    # a pair that shares several n-grams is met at each, with its whole score at the rarest
    pairs = met.repartition("text").select("text", F.inline(F.arrays_zip("near", "scores"))).groupBy("text", "near").agg(F.max("scores").alias("score"))
    order = [F.desc("score"), F.asc("near")]
    others = top_each(pairs, ["text"], order, most).select("text", "near", "score")
    own = known.select("text", F.col("text").alias("near"), F.lit(1.0).alias("score"))
    # of equal texts no more ids than there are places, and one for the source itself
    first = top_each(held.select("t", "id"), ["t"], [F.asc("id")], most + 1).join(known.select("t", "text"), "t").select(F.col("text").alias("near"), F.col("id").alias("candidate"))
    order = [F.desc("score"), F.asc("candidate")]
    best = top_each(others.unionByName(own).join(first, "near"), ["text"], order, most + 1).select("text", "candidate", "score")
    found = held.join(known.select("t", "text"), "t").select(F.col("id").alias("source"), "text").join(best, "text").where("source <> candidate").select("source", "candidate", "score")
    return top_each(found, ["source"], order, most)


BLOCK = 1 << 21  # pairs that are held at once, about 100 MB


def _nearest(most: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Over (gram, text, size, rest, class) in order of n-gram, class and text: what is nearest to each text among those with the n-gram.

    A class keeps its first ``most`` texts: all others of it score no better
    with any text, so as many stand before them. For the same reason no more
    than ``most`` are given for a class. A text is not given for itself.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            gram = batch.column(0).to_numpy()
            # the last n-gram may go on in the next batch
            cut = int(np.searchsorted(gram, gram[-1]))
            if cut or held and held[-1].column(0)[-1].as_py() != gram[0]:
                held += [batch.slice(0, cut)] if cut else []
                yield from of(held)
                held = []
            held.append(batch.slice(cut))
        if held:
            yield from of(held)

    def of(batches: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(batches).combine_chunks()
        gram, cls = (rows.column(c).to_numpy() for c in ("gram", "class"))
        new = np.r_[True, (gram[1:] != gram[:-1]) | (cls[1:] != cls[:-1])]
        head, member = np.flatnonzero(new), np.cumsum(new) - 1
        if len(head) == 1 and len(gram) == 1:
            return
        names, text = np.unique(rows.column("text").to_numpy(), return_inverse=True)
        # the first texts of each class
        size, count = rows.column("size").to_numpy()[head].astype(np.int64), np.diff(np.r_[head, len(gram)])
        kept = np.minimum(count, most)
        # classes of each n-gram
        of_gram = np.cumsum(np.r_[True, gram[head][1:] != gram[head][:-1]]) - 1
        wide = np.bincount(of_gram)
        start = (np.cumsum(wide) - wide)[of_gram]
        width = wide[of_gram]
        # the n-grams of the rests, those of one n-gram's classes that are equal under one number
        rest = rows.column("rest").take(pa.array(head)).combine_chunks()
        ends = rest.offsets.to_numpy().astype(np.int64)
        values, ends = rest.values.to_numpy()[ends[0] : ends[-1]], ends - ends[0]
        long = np.diff(ends)
        owner = np.repeat(np.arange(len(head)), long)
        order = np.lexsort((values, of_gram[owner]))
        v, o = values[order], of_gram[owner[order]]
        group = np.cumsum(np.r_[True, (v[1:] != v[:-1]) | (o[1:] != o[:-1])]) - 1
        many = np.bincount(group)
        first, where, by = np.cumsum(many) - many, np.empty(len(values), np.int64), owner[order]
        where[order] = group
        cost = np.maximum(np.add.reduceat(many[where], ends[:-1]), width * most)
        block = np.cumsum(cost) // BLOCK
        for a, b in zip(borders := np.r_[0, np.flatnonzero(np.diff(block)) + 1, len(head)], borders[1:]):
            mine = where[ends[a] : ends[b]]
            base = np.cumsum(width[a:b]) - width[a:b]
            left = np.repeat(owner[ends[a] : ends[b]], many[mine])
            right = by[_runs(first[mine], many[mine])]
            shared = np.bincount(base[left - a] + right - start[left], minlength=int(width[a:b].sum()))
            i, j = np.repeat(np.arange(a, b), width[a:b]), _runs(start[a:b], width[a:b])
            score = shared / (size[i] + size[j] - shared)
            # no more than the classes that can fill the places
            good = np.ones(len(i), bool)
            for k in np.flatnonzero(width[a:b] > 2 * most):
                mean = score[base[k] : base[k] + width[a + k]]
                good[base[k] : base[k] + width[a + k]] = mean >= np.partition(mean, -most)[-most]
            i, j, score = i[good], j[good], score[good]
            ids, i, score = text[_runs(head[j], kept[j])], np.repeat(i, kept[j]), np.repeat(score, kept[j])
            best = np.lexsort((ids, -score, i))
            i = i[best]
            n = np.bincount(i - a, minlength=b - a)
            best = best[np.arange(len(i)) - np.repeat(np.cumsum(n) - n, n) < most]
            n = np.minimum(n, most)
            # what a class is given goes to each of its texts
            rows_of = np.arange(head[a], head[b] if b < len(head) else len(gram))
            m = n[member[rows_of] - a]
            at = best[_runs((np.cumsum(n) - n)[member[rows_of] - a], m)]
            other = ids[at] != np.repeat(text[rows_of], m)
            lists = np.r_[0, np.cumsum(np.bincount(np.repeat(np.arange(len(rows_of)), m)[other], minlength=len(rows_of)))].astype(np.int32)
            kind = rows.schema.field("text").type
            near = pa.ListArray.from_arrays(lists, pa.array(names[ids[at][other]], kind))
            out = pa.RecordBatch.from_arrays([pa.array(names[text[rows_of]], kind), near, pa.ListArray.from_arrays(lists, pa.array(score[at][other]))], ["text", "near", "scores"])
            yield out.filter(pa.array(np.diff(lists) > 0))

    return run


def _runs(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ... for each count, one after the other."""
    return np.arange(int(count.sum())) + np.repeat(start - (np.cumsum(count) - count), count)


def one_edit_pairs(rows: DataFrame, text: str) -> DataFrame:
    """(title, term): all pairs of different texts of two or more characters that are one edit apart, each once, title < term.

    Every text is joined on what is left of it without one character: two
    texts that leave the same at the same place differ by a substitution, one
    that is what the other leaves by an insertion. So no pair is missed, and a
    key pairs nothing but what is found. Null texts take no part.
    """
    names = rows.select(F.col(text).alias("title")).where(F.length("title") >= 2).distinct()
    places = F.sequence(F.lit(1), F.length("title"))
    left = names.select("title", F.posexplode(F.transform(places, lambda i: F.concat(F.left("title", i - 1), F.substr("title", i + 1)))).alias("place", "rest"))
    swapped = left.join(left.withColumnRenamed("title", "term"), ["place", "rest"]).where("title < term").select("title", "term")
    # a run of one character leaves the same at each of its places
    shorter = left.where("length(rest) >= 2").select("title", "rest").distinct().join(names.select(F.col("title").alias("rest")), "rest")
    return swapped.unionByName(shorter.select(F.least("title", "rest").alias("title"), F.greatest("title", "rest").alias("term")))
