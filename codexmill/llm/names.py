"""Problem 4: variant spellings of one person or organisation.

Each spelling is reduced to comparable forms (parts in stored and in sorted
order, Han names also romanised by readings learned from the catalog, surnames
with what the summary says of place and year). All forms go through one
pigeonhole segment join: a form is cut into ``EDITS + 1`` segments, of which at
least one stays whole under ``EDITS`` edits (a swap across a border is undone in
the index); position-shifted substrings of the other forms are looked up in an
inverted index of the segments, and hits are
verified by banded edit distance. Segments that many forms share are joined a
second time on segments of what remains of the form, which is as exact and keeps
common given names from pairing everybody. Verified pairs are judged by their
parts and by place and year, and linked into entities.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from codexmill.llm.canonical import canonical
from codexmill.llm.components import connected
from codexmill.session import written

EDITS = 2
COMMON = 64  # forms from which a segment is joined on what remains, too
# Words that belong to no name.
ROLES = {"the", "et", "al", "author", "pseud", "editor", "ed", "translator", "trans", "illustrator", "official", "new", "writer", "studio account", "dr", "mr", "mrs", "ms", "prof"}
LEGAL = {"co", "ltd", "inc", "gmbh", "llc", "corp", "corporation", "company", "limited", "ag", "sa", "bv", "plc", "kg", "sarl", "srl"}
HAN_ROLES = re.compile(r"(?:作品集|工作室|老师|本人|作者|著|编著|编|译|绘|先生|女士|官方)$")
# Usual short forms in the names of firms; others are learned (see ``expanded``).
SHORT = {"pr": "press", "bks": "books", "bk": "book", "publ": "publishing", "pub": "publishing", "pubs": "publishers", "st": "street", "mt": "mountain", "hse": "house", "ent": "entertainment", "intl": "international", "univ": "university", "assoc": "associates", "bros": "brothers", "grp": "group"}
# Given names and their short forms.
NICK = """abigail abby|alexander alex|amanda mandy|andrew andy|anthony tony|arthur art|barbara barb|benjamin ben|bernard bernie|catherine cathy|cecil cec|charles charlie|charles chuck|christine chris|christine chrissie|christopher chris|conrad con|daniel dan|daniel danny|david dave|deborah deb|deborah debbie|dorothy dot|dorothy dottie|edward ed|edward ted|edward eddie|elizabeth liz|elizabeth beth|elizabeth betty|emily em|florence flo|frances fran|francis frank|frederick fred|gabrielle gabby|george georgie|gerald gerry|gregory greg|harold harry|henry harry|henry hank|james jim|james jimmy|jennifer jen|jennifer jenny|jeremy jerry|jessica jess|john jack|jonathan jon|joseph joe|joseph joey|joshua josh|judith judy|julia jules|katherine kate|katherine kathy|katherine katie|kenneth ken|kenneth kenny|laurence larry|leonard len|leonie leo|lorenz enzo|magnus mag|margaret maggie|margaret meg|margaret peggy|matthew matt|matilda tilda|michael mike|michael mick|nathaniel nate|nicholas nick|nicholas nicky|oskar ossie|pamela pam|patricia pat|patricia patty|patricia trish|patrick pat|patrick paddy|peter pete|philip phil|rebecca becky|richard dick|richard rick|richard rich|robert bob|robert rob|robert bobby|ronald ron|rosa rosie|samuel sam|sandra sandy|silas si|stephen steve|susan sue|susan susie|theodore ted|theodore theo|theresa tess|theresa terry|thomas tom|thomas tommy|timothy tim|ursula uschi|victoria vicky|vincent vince|wanda wendy|william bill|william will|william billy"""
NICKS: dict[str, set[str]] = defaultdict(set)
for _pair in NICK.split("|"):
    _full, _nick = _pair.split()
    NICKS[_nick].add(_full)
HAN = re.compile(r"[㐀-鿿]")
SYLLABLE = re.compile(r"(?:zh|ch|sh|[bpmfdtnlgkhjqxrzcsyw])?(?:iang|iong|uang|ueng|ang|eng|ing|ong|ian|iao|uai|uan|ai|an|ao|ei|en|er|ia|ie|in|iu|ou|ua|ue|ui|un|uo|ve|a|e|i|o|u|v)")


def plain(text: str) -> str:
    """Lower case without accents."""
    return "".join(c for c in unicodedata.normalize("NFD", text.lower()) if not unicodedata.combining(c))


def parts(title: str) -> tuple[str, ...]:
    """The parts of a name: one string of Han characters, or its words without titles, roles and legal forms."""
    text = canonical(title) or ""
    text = re.sub(r"_\w{1,5}$|[<>*@#]", " ", text)
    if HAN.search(text):
        # what stands in brackets is a note, unless only a role stands outside of them
        outside = "".join(HAN.findall(re.sub(r"[(（\[【〔].*?[)）\]】〕]", "", text)))
        han = outside if HAN_ROLES.sub("", outside) else "".join(HAN.findall(text))
        for _ in range(2):
            if len(han) > 2:
                han = HAN_ROLES.sub("", han)
        return (han,) if han else ()
    text = re.sub(r"(?<=\w)\s*[(\[{].*?[)\]}]", " ", text)
    text = re.sub(r"(?<=[a-zà-ÿ])(?=[A-ZÀ-Þ][a-zà-ÿ])", " ", text)
    words = [w for w in re.findall(r"[^\W\d_]+", plain(text).replace("'", "").replace("’", ""))]
    kept = [w for w in words if w not in ROLES and w not in LEGAL]
    return tuple(SHORT.get(w, w) for w in kept or words)


def expanded(names: tuple[str, ...], common: frozenset[str]) -> tuple[str, ...]:
    """The parts of a name with short ones written out: those without vowels, each the only common part whose letters it has in order, the first in front; an x stands for cs or ks."""
    return tuple(_long(p, common) for p in names)


@lru_cache(maxsize=100_000)
def _long(part: str, common: frozenset[str]) -> str:
    if not re.fullmatch("[b-df-hj-np-tv-xz]{2,4}", part) or part in common:
        return part
    found = {c for c in common if len(c) >= 5 and c[0] == part[0] and any(in_order(part.replace("x", x), c) for x in ("cs", "ks"))}
    return found.pop() if len(found) == 1 else part


def in_order(letters: str, word: str) -> bool:
    rest = iter(word)
    return all(c in rest for c in letters)


def facts(names: DataFrame) -> DataFrame:
    """(unit, said): what the summaries of units say of place and year, as one string, for those that say both.

    The place is taken to be the rarest word with a capital, by the number of
    units that have it in a summary (to a factor of two, then the longest); a word of more than half a percent of them
    (held by two standard deviations) is no place.
    """
    told = names.where("summary <> ''").select("unit", "summary").distinct()
    year = F.regexp_extract("summary", r"(?<!\d)(1[5-9]\d\d|20\d\d)(?!\d)", 1).alias("year")
    words = told.select("unit", "summary", year, F.explode(F.regexp_extract_all("summary", F.lit(r"[A-ZÀ-Þ][a-zà-ÿ]{3,}"), F.lit(0))).alias("word")).where("year <> ''")
    each = words.select("unit", "word").distinct().groupBy("word").agg(F.count("*").alias("n"))
    bound = frequent(0.005, told.select("unit").distinct().count())
    rare = words.join(each.where(~bound), "word").groupBy("unit", "summary", "year").agg(F.min_by("word", F.struct(F.floor(F.log2(F.greatest("n", F.lit(4)))), -F.length("word"), "word")).alias("word"))
    flat = F.pandas_udf(lambda x: x.map(plain), T.StringType())
    return rare.select("unit", F.concat(flat("word"), "year").alias("said")).groupBy("unit").agg(F.min("said").alias("said"))


def frequent(share: float, units: int) -> Column:
    """Whether a count ``n`` lies above a share of so many units by two standard deviations, so that few units tell as many do."""
    return F.col("n") - 2 * F.sqrt("n") >= share * units


def segment(s: str, k: int = EDITS) -> list[tuple[int, str]]:
    """(place, segment) of k + 1 segments of nearly equal length, longer ones last."""
    n, extra = divmod(len(s), k + 1)
    out, at = [], 0
    for i in range(k + 1):
        size = n + (i > k - extra)
        out.append((at, s[at : at + size]))
        at += size
    return out


def index_keys(s: str, k: int = EDITS) -> list[tuple[str, str]]:
    """(key, what remains) of each segment, as it stands and with the characters at one of its borders swapped.

    A swap of neighbours within a segment spoils one, but across a border two;
    with the border swapped in the index one of them stays whole. A form too
    short for segments is indexed under its length.
    """
    n = len(s)
    if n <= k:
        return [(f"{n}", s)]
    cut = segment(s, k)
    out = [(f"{n}:{i}:{seg}", s[:at] + s[at + len(seg) :]) for i, (at, seg) in enumerate(cut)]
    for i, (at, _) in enumerate(cut[1:], 1):
        if s[at - 1] != s[at]:
            t = s[: at - 1] + s[at] + s[at - 1] + s[at + 1 :]
            out += [(f"{n}:{j}:{t[a : a + len(seg)]}", t[:a] + t[a + len(seg) :]) for j, (a, seg) in ((i - 1, cut[i - 1]), (i, cut[i]))]
    return out


def probe_keys(s: str, k: int = EDITS) -> list[tuple[str, str]]:
    """Keys under which forms of no greater length within k edits are indexed, with what remains of this one."""
    out = []
    for size in range(max(1, len(s) - k), len(s) + 1):
        if size <= k:
            out.append((f"{size}", s))
            continue
        gap = len(s) - size
        for i, (at, seg) in enumerate(segment("\0" * size, k)):
            # a whole segment shifts by no more than the edits before it, and after it
            low = max(0, at - min(i, (k - gap) // 2 + 0), at + gap - (k - i))
            high = min(len(s) - len(seg), at + min(i, k), at + gap + (k - i))
            out += [(f"{size}:{i}:{s[p : p + len(seg)]}", s[:p] + s[p + len(seg) :]) for p in range(max(0, min(low, at - i)), high + 1)]
    return out


def within(a: str, b: str, k: int = EDITS) -> int:
    """The edit distance, swaps of neighbours counted once, if it is at most k, else k + 1; only a band of 2k + 1 is filled."""
    if a == b:
        return 0
    if abs(len(a) - len(b)) > k:
        return k + 1
    big = k + 1
    before, row = [], {j: j for j in range(min(k, len(b)) + 1)}
    older: dict[int, int] = {}
    for i in range(1, len(a) + 1):
        here: dict[int, int] = {}
        for j in range(max(0, i - k), min(len(b), i + k) + 1):
            if j == 0:
                here[0] = i
                continue
            v = min(row.get(j, big) + 1, here.get(j - 1, big) + 1, row.get(j - 1, big) + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                v = min(v, older.get(j - 2, big) + 1)
            here[j] = v
        if min(here.values()) > k:
            return big
        older, row = row, here
    return min(row.get(len(b), big), big)


def alike(a: str, b: str) -> bool:
    """Whether one part of a name may stand for another: equal, an initial, a short form, a nickname, a typo."""
    if a == b:
        return True
    a, b = sorted((a, b), key=len)
    if len(a) == 1:
        return b.startswith(a)
    if a in NICKS and (b in NICKS[a] or b in NICKS and NICKS[a] & NICKS[b]) or b in NICKS and a in NICKS[b]:
        return True
    if len(a) <= 4 and a[0] == b[0] and len(b) > len(a) + 1:
        if in_order(a, b):
            return True
    return len(a) >= 4 and within(a, b, 1 if len(a) < 7 else 2) <= (1 if len(a) < 7 else 2)


def compatible(a: tuple[str, ...], b: tuple[str, ...], common: frozenset[str] = frozenset()) -> bool:
    """Whether the parts of the shorter name can be assigned to parts of the longer, and one long part that isn't common is shared."""
    a, b = sorted((a, b), key=len)
    left, shared = list(b), False
    for p in sorted(a, key=lambda p: -len(p)):
        best = min((x for x in left if alike(p, x)), key=lambda x: (x != p, -len(x)), default=None)
        if best is None:
            return False
        shared |= len(p) >= 4 and len(best) >= 4 and p not in common and best not in common and within(p, best) <= EDITS
        left.remove(best)
    return shared


def forms(names: tuple[str, ...], said: str, readings: dict[str, str], common: frozenset[str] = frozenset()) -> list[str]:
    """The strings under which a name is joined; those with '#' hold only with more evidence."""
    if not names:
        return []
    out = []
    if HAN.match(names[0]):
        out.append(names[0])
        if all(c in readings for c in names[0]):
            out.append("".join(readings[c] for c in names[0]))
        return out + [f"#{said}{x}" for x in out if said]
    whole, ordered = "".join(names), "".join(sorted(names))
    out += [whole, ordered, "".join(names[1:] + names[:1]), "".join(names[-1:] + names[:-1])]
    long = [p for p in names if len(p) >= 4]
    if said:
        out += [f"#{said}{p}" for p in (whole, *long)]
    for k, p in enumerate(names):
        if len(p) >= 5 and p not in common:
            initials = {x[0] for j, q in enumerate(names) if j != k for x in (q, *NICKS.get(q, ()))}
            out += [f"#{p}#{i}" for i in sorted(initials)]
    return list(dict.fromkeys(out))


def learned_readings(names: DataFrame) -> dict[str, str]:
    """The commonest syllable of each Han character, from units that carry a name in Han and in Latin letters.

    One entry for each character, so its size is bounded by the script.
    """

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            count: Counter = Counter()
            for p, q in zip(map(parts, batch.column(0).to_pylist()), map(parts, batch.column(1).to_pylist()), strict=True):
                if p and q and HAN.match(p[0]) and not HAN.match(q[0]) and (cut := syllables("".join(q), len(p[0]))) is not None:
                    count.update(zip(p[0], cut, strict=True))
            keys = list(count)
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.string()), pa.array([count[k] for k in keys], pa.int64())], names=["c", "s", "n"])

    han = F.col("title").rlike(HAN.pattern)
    both = names.where(han).select("unit", F.col("title").alias("h")).join(names.where(~han).select("unit", F.col("title").alias("l")), "unit").select("h", "l")
    summed = both.mapInArrow(pairs, "c string, s string, n long").groupBy("c", "s").agg(F.sum("n").alias("n"))
    best = summed.groupBy("c").agg(F.max_by("s", F.struct("n", "s")).alias("s"))
    return {r["c"]: r["s"] for r in best.collect()}


def syllables(latin: str, n: int) -> list[str] | None:
    """A cut of a romanised name into n syllables, None where there is none; longer syllables first."""
    if n == 0:
        return [] if not latin else None
    for size in range(min(6, len(latin)), 0, -1):
        if SYLLABLE.fullmatch(latin[:size]) and (rest := syllables(latin[size:], n - 1)) is not None:
            return [latin[:size], *rest]
    return None


@F.pandas_udf(T.ArrayType(T.StringType()))
def _parts_udf(s: pd.Series) -> pd.Series:
    return s.map(parts)


def keyed(rows: DataFrame, keys: Callable[[str], list[tuple[str, str]]], own: Sequence[str]) -> DataFrame:
    """Rows (own, key, rest) for each distinct key of the last column of ``rows``; ``own`` are columns of text before it."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [list(dict.fromkeys(keys(f))) for f in batch.column(len(own)).to_pylist()]
            at = pa.array([i for i, ks in enumerate(made) for _ in ks], pa.int32())
            flat = [[k[j] for ks in made for k in ks] for j in range(2)]
            yield pa.RecordBatch.from_arrays([*(batch.column(i).take(at) for i in range(len(own))), *(pa.array(c, pa.string()) for c in flat)], names=[*own, "key", "rest"])

    return rows.mapInArrow(scan, ", ".join(f"{c} string" for c in (*own, "key", "rest")))


@F.pandas_udf(T.IntegerType())
def _within_udf(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([within(x, y) for x, y in zip(a, b, strict=True)], dtype="int32")


def near_forms(distinct: DataFrame) -> DataFrame:
    """(a, b, edits): all pairs of different strings of the column ``form`` within ``EDITS`` edits, a swap of neighbours being one."""
    index = written(keyed(distinct.select(F.col("form").alias("a"), "form"), index_keys, ["a"]), "index")
    size = index.groupBy("key").agg(F.count("*").alias("n"))
    # most keys that are asked for are in no form; those that are serve both joins
    probe = written(keyed(distinct.select(F.col("form").alias("b"), "form"), probe_keys, ["b"]).join(size, "key"), "probe")
    first = index.join(probe.where(F.col("n") <= COMMON).select("key", "b"), "key").select("a", "b")
    common = size.where(F.col("n") > COMMON).select("key")
    held = keyed(index.join(common, "key", "left_semi").select("a", F.col("key").alias("first"), "rest"), index_keys, ["a", "first"]).select("a", "first", "key")
    asked = keyed(probe.where(F.col("n") > COMMON).select("b", F.col("key").alias("first"), "rest"), probe_keys, ["b", "first"]).select("b", "first", "key")
    second = held.join(asked, ["first", "key"]).select("a", "b")
    hits = first.unionByName(second).where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    # a swap is two plain edits, so twice the edits bound what the exact distance has to look at
    close = hits.where(F.levenshtein("a", "b", 2 * EDITS) >= 0)
    return close.withColumn("edits", _within_udf("a", "b")).where(F.col("edits") <= EDITS)


def credited_names(attributions: DataFrame) -> DataFrame:
    """(unit, title, summary): the names of each credited unit, each once; null and empty titles are no names."""
    unit = F.lower(F.regexp_replace("creditedUnitId", r"^\s+|\s+$", "")).alias("unit")
    return attributions.select(unit, F.explode("localizations").alias("x")).where("unit <> ''").select("unit", "x.title", "x.summary").distinct()


NONE, WEAK, STRONG = 0, 1, 2


def verdict(x: dict, y: dict, common: frozenset[str] = frozenset()) -> int:
    """How surely two units are one entity by a name of each and what they say of place and year.

    ``WEAK`` is a name that may be short for the other where place and year
    can't tell; it holds only where nobody else fits.
    """
    agree = bool(x["said"] and y["said"]) and within(x["said"], y["said"], 1) <= 1
    if x["said"] and y["said"] and not agree:
        return NONE
    p, q = tuple(x["parts"]), tuple(y["parts"])
    han = bool(HAN.match(p[0])), bool(HAN.match(q[0]))
    if all(han):
        d = within(p[0], q[0])
        return STRONG if d == 0 or d <= (EDITS if agree else 1) and min(len(p[0]), len(q[0])) >= 3 else NONE
    if any(han):
        own, other = (x, q) if han[0] else (y, p)
        return STRONG if own["reading"] and within(own["reading"], "".join(other)) <= EDITS else NONE
    size = min(len("".join(p)), len("".join(q)))
    most = 0 if size < 6 else 1 if size < 10 else EDITS
    if min((within(f, g, most) for f in orders(p) for g in orders(q)), default=EDITS + 1) <= most:
        return STRONG
    if compatible(p, q, common):
        return STRONG if agree else WEAK
    return NONE


def orders(p: tuple[str, ...]) -> set[str]:
    return {"".join(p), "".join(sorted(p)), "".join(p[1:] + p[:1]), "".join(p[-1:] + p[:-1])}


def links(attributions: DataFrame) -> DataFrame:
    """(a, b, sure): pairs of credited units judged to be one entity, before they are joined into entities."""
    spark = attributions.sparkSession
    names = written(credited_names(attributions), "names")
    titled = names.where("title <> ''")
    readings = spark.sparkContext.broadcast(learned_readings(titled.select("unit", "title").distinct()))

    # parts that many names share are given names and trades; at three parts a name there are at most 1,500 of them
    units = names.select("unit").distinct().count()
    words = titled.select("unit", F.explode(_parts_udf("title")).alias("part")).distinct().groupBy("part").agg(F.count("*").alias("n"))
    common = spark.sparkContext.broadcast(frozenset(r["part"] for r in words.where(frequent(0.002, units) & F.col("part").rlike("^[a-z]")).collect()))

    def shape(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for unit, title, said in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if p := expanded(parts(title), common.value):
                    reading = "".join(readings.value.get(c, "?") for c in p[0]) if HAN.match(p[0]) else ""
                    out.append((unit, list(p), said, "" if "?" in reading else reading, forms(p, said, readings.value, common.value)))
            cols = list(zip(*out, strict=True)) or [[]] * 5
            text = pa.list_(pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), text, pa.string(), pa.string(), text), strict=True)], names=["unit", "parts", "said", "reading", "forms"])

    shaped = titled.select("unit", "title").distinct().join(facts(names), "unit", "left").select("unit", "title", F.coalesce("said", F.lit("")).alias("said"))
    known = written(shaped.mapInArrow(shape, "unit string, parts array<string>, said string, reading string, forms array<string>"), "shaped")
    named = written(known.select("unit", "parts", "said", "reading").distinct(), "named")
    # units of equal names and saying are judged alike, so the least of them stands for all; a set of names is told by its hashes
    of = ("parts", "said", "reading")
    prints = named.groupBy("unit").agg(F.bit_xor(F.xxhash64(*of)).alias("h1"), F.bit_xor(F.xxhash64(F.lit(1), *of)).alias("h2"), F.count("*").alias("n"))
    least = prints.groupBy("h1", "h2", "n").agg(F.min("unit").alias("least"))
    own = written(prints.join(least, ["h1", "h2", "n"]).select("unit", "least"), "own")
    standing = own.where("unit = least").select("unit")
    entries = written(known.join(standing, "unit", "left_semi").select("unit", F.explode("forms").alias("form"), "said").distinct(), "forms")
    near = near_forms(entries.select("form").distinct()).select("a", "b")
    left, right = (entries.select(F.col("unit").alias(f"u{k}"), F.col("form").alias(k), F.col("said").alias(f"s{k}")) for k in "ab")
    # where both say something it has to agree (a swap of neighbours is two plain edits)
    agree = (F.col("sa") == "") | (F.col("sb") == "") | (F.levenshtein("sa", "sb", 2) >= 0)
    # every pair on a form, as one that refuses both may stand between two that fit. Two that say something and agree share a form
    # that holds what they say, so on other forms only those that are silent are joined, and of equal silent names one stands for all
    silent = left.where("sa = ''").join(right.withColumnRenamed("b", "a"), "a").where("sb <> '' or ua < ub")
    saying = left.where("sa <> '' and startswith(a, concat('#', sa))").join(right.withColumnRenamed("b", "a"), "a").where("sb <> '' and ua < ub")
    pairs = near.join(left, "a").join(right, "b").where(agree).select("ua", "ub").unionByName(silent.select("ua", "ub")).unionByName(saying.select("ua", "ub")).where("ua <> ub")
    pairs = pairs.unionByName(own.where("unit <> least").select(F.col("least").alias("ua"), F.col("unit").alias("ub"))).select(F.least("ua", "ub").alias("a"), F.greatest("ua", "ub").alias("b")).distinct()
    # name against name, so that no unit's names are collected
    na, nb = (named.select(F.col("unit").alias(k), F.struct(*of).alias(f"n{k}")) for k in "ab")
    both = pairs.join(na, "a").join(nb, "b")
    judge = F.pandas_udf(lambda x, y: pd.Series([verdict(p, q, common.value) for p, q in zip(x.to_dict("records"), y.to_dict("records"), strict=True)], dtype="int32"), T.IntegerType())
    return written(both.select("a", "b", judge("na", "nb").alias("sure")).groupBy("a", "b").agg(F.max("sure").alias("sure")).where("sure > 0"), "links")


def same_entities(attributions: DataFrame) -> DataFrame:
    """(creditedUnitIdA, creditedUnitIdB): all pairs of credited units that are one person or organisation.

    Units without any title are no case; repeated rows count once. Ids are
    compared in lower case without outer blanks.
    """
    found = links(attributions)
    sure, unsure = found.where(F.col("sure") == STRONG).select("a", "b"), found.where(F.col("sure") == WEAK)
    known = written(connected(sure, "a", "b"), "sure")
    both = unsure.select("a", "b").unionByName(unsure.select(F.col("b").alias("a"), F.col("a").alias("b")))
    fits = both.join(known.toDF("b", "group"), "b", "left").select("a", "b", F.coalesce("group", "b").alias("group"))
    one = fits.groupBy("a").agg(F.countDistinct("group").alias("n"), F.min("b").alias("b")).where("n = 1").select("a", "b")
    members = written(connected(sure.unionByName(one), "a", "b"), "entities")
    a, b = members.toDF("creditedUnitIdA", "group"), members.toDF("creditedUnitIdB", "group")
    return a.join(b, "group").where("creditedUnitIdA < creditedUnitIdB").select("creditedUnitIdA", "creditedUnitIdB")
