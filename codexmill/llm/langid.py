"""Problem 6: the language of texts, and of the parts of mixed ones.

Word-first backoff. A known word is scored by its log frequency in each
language; an unseen one by the longest of its character n-grams that any
language knows, down to single characters. Scripts without blanks have pairs of
neighbouring characters for words and single characters for their n-grams.

The model is fitted on at most ``SAMPLE`` labelled texts of each language,
chosen by a hash of their id; after a first fit the texts whose label the model
contradicts are left out and it is fitted again.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codexmill.llm.neardup import leaves
from codexmill.llm.vectext import BMP, M1, codes, mix, portions, powers

LANGUAGES = ("zh", "ja", "ko", "en", "de", "fr", "es", "ru")
SAMPLE = 500
NGRAMS = (5, 4, 3, 2, 1)
LEAST_WIDE, LEAST = 8, 20  # characters from which a sentence can be told, in scripts of ideographs and others
OTHER, SPACE, LINE, DOT, SLASH, END, LETTER, WIDE = range(8)  # kinds of characters
ENDS = "。！？!?…"
MARGIN = 0.6  # nats a word by which the best language has to lead
# Codes of the languages in ISO 639-1, 639-2 and 639-3.
CODES = {
    "zh": "zh", "zho": "zh", "chi": "zh", "cmn": "zh", "ja": "ja", "jpn": "ja", "ko": "ko", "kor": "ko", "en": "en", "eng": "en",
    "de": "de", "deu": "de", "ger": "de", "fr": "fr", "fra": "fr", "fre": "fr", "es": "es", "spa": "es", "ru": "ru", "rus": "ru",
}
def base_language(label: str | None) -> str | None:
    """The language a label names, however it is written; None where it names none of them."""
    if not label:
        return None
    return CODES.get(re.split(r"[-_@.]", label.strip().lower())[0])


@lru_cache(maxsize=1)
def tables() -> tuple[np.ndarray, np.ndarray]:
    """(kind, letter) of each code point of the basic plane: what it is for sentences and words, and its lower case."""
    kind, low = np.zeros(BMP + 1, np.uint8), np.arange(BMP + 1, dtype=np.uint64)
    for c in range(BMP):
        ch = chr(c)
        if ch.isspace():
            kind[c] = SPACE
        elif ch.isalpha():
            kind[c] = WIDE if 0x3041 <= c < 0x3100 or 0x3400 <= c < 0xA000 or 0xF900 <= c < 0xFB00 else LETTER
            if len(ch.lower()) == 1:
                low[c] = ord(ch.lower())
    kind[10], kind[ord(".")], kind[ord("/")] = LINE, DOT, SLASH
    kind[[ord(c) for c in ENDS]] = END
    kind[BMP] = WIDE  # ideographs beyond the basic plane, and symbols, which no language knows
    return kind, mix(low + M1)


class Split:
    """Sentences of a batch of texts and the words in them, as arrays.

    A word is a run of letters, or a pair of neighbours in a run of ideographs
    and kana (one that stands alone is a word by itself).

    begin, end   places of each sentence in the batch's code points
    text         the text each sentence is of
    size         how much there is to tell by: letters, ideographs and kana counting for ``LEAST / LEAST_WIDE`` each
    start, stop  places of each word
    sentence     the sentence each word is of
    """

    def __init__(self, texts: list[str]):
        raw, at = codes(texts)
        self.low = np.minimum(raw, BMP)
        kinds, letters = tables()
        n = len(raw)
        kind = kinds[self.low]
        after = np.append(kind[1:], SPACE)
        after[at[1:][at[1:] > 0] - 1] = SPACE
        ends = (kind == LINE) | (kind == END) & (after != END) | (kind == DOT) & ((after == SPACE) | (after == LINE))
        if n > 2:
            ends[2:] |= (kind[2:] == SPACE) & (kind[1:-1] == SLASH) & (kind[:-2] == SPACE)
        opens = np.zeros(n + 1, bool)
        opens[1:] = ends
        opens[at] = True
        self.begin = np.flatnonzero(opens[:n])
        self.end = np.append(self.begin[1:], n) if n else self.begin
        self.text = np.searchsorted(at, self.begin, "right") - 1
        owner = np.cumsum(opens[:n]) - 1
        wide, letter = kind == WIDE, kind == LETTER
        self.size = np.bincount(owner, letter + wide * (LEAST / LEAST_WIDE), len(self.begin))
        same = np.zeros(n, bool)  # whether a character goes on with the run before it
        same[1:] = (kind[1:] == kind[:-1]) & ~opens[1:n]
        begins = np.flatnonzero(letter & ~same)
        stops = np.flatnonzero(letter & ~np.append(same[1:], False)) + 1
        pairs = np.flatnonzero(wide & same)
        alone = np.flatnonzero(wide & ~same & ~np.append(same[1:], False))
        self.start = np.concatenate([begins, pairs - 1, alone])
        self.stop = np.concatenate([stops, pairs + 1, alone + 1])
        order = np.argsort(self.start, kind="stable")
        self.start, self.stop = self.start[order], self.stop[order]
        self.sentence = owner[self.start] if n else self.start
        up, self.down = powers(1 << max(12, int(n).bit_length()))
        self.run = np.zeros(n + 1, np.uint64)
        np.cumsum(letters[self.low] * up[:n], out=self.run[1:])
        self.word = self.hashes(self.start, self.stop)

    def hashes(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """A hash of the characters between places, in lower case, wherever they stand."""
        return mix((self.run[stop] - self.run[start]) * self.down[start] + (stop - start).astype(np.uint64))


class Scores:
    """Scores in each language by hash; arrays in the order of the hashes."""

    def __init__(self, keys: np.ndarray, scores: np.ndarray):
        self.keys, self.scores = keys, scores.astype(np.float32)

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place of each hash, whether it is known)"""
        if not len(self.keys):
            return np.zeros(len(h), np.int64), np.zeros(len(h), bool)
        at = np.minimum(np.searchsorted(self.keys, h), len(self.keys) - 1)
        return at, self.keys[at] == h


def shares(h: np.ndarray, lang: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct hashes, summed weight of each in every language)"""
    keys, at = np.unique(h, return_inverse=True)
    table = np.bincount(at * len(LANGUAGES) + lang, weight, len(keys) * len(LANGUAGES))
    return keys, table.reshape(-1, len(LANGUAGES))


class Speaker:
    """Log frequencies of words and character n-grams in each language."""

    floor = 1e-6

    def __init__(self, texts: list[tuple[str, str]]):
        kept = texts
        for _ in range(2):
            self._fit(kept)
            told = self.tell_many([t for _, t in texts])
            kept = [own for own, (lang, _) in zip(texts, told, strict=True) if lang == own[0]]

    def _fit(self, texts: list[tuple[str, str]]) -> None:
        split = Split([t for _, t in texts])
        spoken = np.array([LANGUAGES.index(lang) for lang, _ in texts], np.int64)
        lang = spoken[split.text[split.sentence]] if len(split.word) else np.zeros(0, np.int64)
        words = np.maximum(1, np.bincount(lang, minlength=len(LANGUAGES)))
        weight = 1 / words[lang]
        keys, seen = shares(split.word, lang, weight)
        # a word seen once is no better known than its parts
        known = seen.max(axis=1, initial=0) > 3 * self.floor
        scores = np.log(seen[known] + self.floor)
        self.words = Scores(keys[known], scores - scores.mean(axis=1, keepdims=True))
        self.grams = {}
        for n in NGRAMS:
            which, start = windows_of(split.start, split.stop, n)
            keys, seen = shares(split.hashes(start, start + n), lang[which], weight[which])
            scores = np.log(seen / (seen.sum(axis=0) + 1e-9) + self.floor)
            kept = seen.max(axis=1, initial=0) > 2 * self.floor
            self.grams[n] = Scores(keys[kept], scores[kept])

    def unseen(self, split: Split, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """Scores of words that aren't known: the mean over the longest of their n-grams that any language knows."""
        out = np.zeros((len(start), len(LANGUAGES)), np.float32)
        left = np.arange(len(start))
        for n in NGRAMS:
            which, begin = windows_of(start[left], stop[left], n)
            at, known = self.grams[n].find(split.hashes(begin, begin + n))
            which, at = which[known], at[known]
            met = np.bincount(which, minlength=len(left))
            done = np.flatnonzero(met)
            if len(done):
                first = np.searchsorted(which, done)
                own = np.add.reduceat(self.grams[n].scores[at], first, axis=0) / met[done, None]
                out[left[done]] = own - own.mean(axis=1, keepdims=True)
            left = left[met == 0]
        return out

    def tell(self, split: Split) -> tuple[np.ndarray, np.ndarray]:
        """(language, lead over the next in nats a word) of each sentence; -1 for one without words."""
        lang, lead = np.full(len(split.begin), -1), np.zeros(len(split.begin))
        if not len(split.word):
            return lang, lead
        at, known = self.words.find(split.word)
        scores = np.zeros((len(split.word), len(LANGUAGES)), np.float32)
        scores[known] = self.words.scores[at[known]]
        strange = np.flatnonzero(~known)
        if len(strange):
            _, first, back = np.unique(split.word[strange], return_index=True, return_inverse=True)
            own = self.unseen(split, split.start[strange[first]], split.stop[strange[first]])
            scores[strange] = own[back]
        opens = np.flatnonzero(np.append(True, split.sentence[1:] != split.sentence[:-1]))
        full = split.sentence[opens]
        s = np.add.reduceat(scores, opens, axis=0) / np.diff(np.append(opens, len(scores)))[:, None]
        order = np.sort(s, axis=1)
        lang[full], lead[full] = s.argmax(axis=1), order[:, -1] - order[:, -2]
        return lang, lead

    def tell_many(self, texts: list[str]) -> list[tuple[str | None, float]]:
        """For each text (language, lead); (None, 0) for one without words."""
        split = Split(texts)
        split.sentence = split.text[split.sentence] if len(split.word) else split.sentence
        split.begin = np.arange(len(texts))
        return [(LANGUAGES[k] if k >= 0 else None, float(x)) for k, x in zip(*self.tell(split), strict=True)]


def windows_of(start: np.ndarray, stop: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(word, begin) of every window of n characters inside words."""
    room = np.maximum(stop - start - n + 1, 0)
    which = np.repeat(np.arange(len(start)), room)
    return which, start[which] + np.arange(len(which)) - np.repeat(np.cumsum(room) - room, room)


def segments_many(texts: list[str], speaker: Speaker) -> list[list[tuple[str, str, float]]]:
    """For each text the (language, part, confidence) of its parts, neighbouring sentences of one language together.

    Sentences too short to tell go with the part before them, those in front of
    the first that tells with the part it begins. The parts of a text add up to
    it; a text none of whose sentences tells has none.
    """
    split = Split(texts)
    told, leads = speaker.tell(split)
    sure = (told >= 0) & (leads >= MARGIN) & (split.size >= LEAST)
    _, at = codes(texts)
    out: list[list] = [[] for _ in texts]
    for k in np.flatnonzero(sure).tolist():
        parts, begin = out[split.text[k]], int(split.begin[k] - at[split.text[k]])
        if parts and parts[-1][0] == told[k]:
            parts[-1][2].append(float(leads[k]))
        else:
            parts.append([int(told[k]), begin if parts else 0, [float(leads[k])]])
    made = []
    for t, parts in zip(texts, out, strict=True):
        stops = [p[1] for p in parts[1:]] + [len(t)] * bool(parts)
        made.append([(LANGUAGES[lang], t[a:b], 1 - math.exp(-sum(x) / len(x))) for (lang, a, x), b in zip(parts, stops, strict=True)])
    return made


def segments(text: str, speaker: Speaker) -> list[tuple[str, str, float]]:
    return segments_many([text], speaker)[0]


def sample(rows: DataFrame, bound: int = SAMPLE) -> list[tuple[str, str]]:
    """At most about ``bound`` labelled texts of each language, whichever have the smallest hashes."""
    label = F.split(F.lower(F.trim("language")), "[-_@.]")[0]
    named = F.create_map(*[F.lit(x) for pair in CODES.items() for x in pair])
    labelled = rows.select("locId", F.element_at(named, label).alias("lang"), "text").where("lang is not null and length(text) >= 12")
    n = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not n:
        return []
    share = F.create_map(*[F.lit(x) for lang, k in n.items() for x in (lang, min(1.0, bound / k))])
    chosen = labelled.where(F.pmod(F.xxhash64("locId", F.lit(6)), F.lit(1_000_000)) < F.element_at(share, F.col("lang")) * 1_000_000)
    return [(r["lang"], r["text"]) for r in chosen.dropDuplicates(["locId"]).orderBy("locId").collect()]


FIELDS = ("title", "summary", "description")


def fitted(localizations: DataFrame, bound: int = SAMPLE) -> Speaker:
    """A model of the labelled summaries of localizations."""
    return Speaker(sample(localizations.where("locId is not null").select("locId", "language", F.col("summary").alias("text")), bound))


def scanned(localizations: DataFrame, excluded: DataFrame | None, kind: str, scan: Callable[[list[str | None], int], list[pa.Array]], first: int = 0) -> DataFrame:
    """What ``scan`` finds in each field of all deliveries where they lie, held against each localization's last delivery.

    ``scan`` takes the texts of a batch's field, of descriptions the text inside,
    and the field's number, and gives the row of each finding and its columns,
    named in ``kind``. Fields are those from the ``first``.
    """
    rows = localizations.where("locId is not null").select("locId", F.struct("capturedAt", "updatedAt").alias("late"), "language", *FIELDS[first:])
    names = ["locId", "late", "language", *(c.split()[0] for c in kind.split(", "))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for field in range(first, len(FIELDS)):
                texts = batch.column(3 + field - first).to_pylist()
                found = scan([leaves(t) for t in texts] if field == 2 else texts, field)
                yield pa.RecordBatch.from_arrays([*(batch.column(k).take(found[0]) for k in range(3)), *found[1:]], names=names)

    late = rows.schema["late"].dataType.simpleString()
    found = rows.mapInArrow(run, f"locId long, late {late}, language string, {kind}")
    last = rows.groupBy("locId").agg(F.max("late").alias("last"))
    found = found.join(last, "locId").where("late <=> last").drop("late", "last")
    return found if excluded is None else found.join(excluded.select("locId"), "locId", "left_anti")


def identified(localizations: DataFrame, excluded: DataFrame | None = None, bound: int = SAMPLE) -> DataFrame:
    """(locId, language, field, at, lang, confidence, part): the language of each part of a localization's title, summary and description text.

    ``at`` is the part's number in its field, from 0; the parts of a field add up
    to its text. Null, empty and too short texts have no rows; repeated
    deliveries count once, by their last; ``excluded`` holds the ``locId`` of
    those left out.
    """
    send = localizations.sparkSession.sparkContext.broadcast(fitted(localizations, bound))

    def scan(texts: list[str | None], field: int) -> list[pa.Array]:
        out = []
        for p in portions(texts, 100_000):
            for k, own in enumerate(segments_many([t or "" for t in texts[p]], send.value), p.start):
                out += [(k, FIELDS[field], at, lang, conf, part) for at, (lang, part, conf) in enumerate(own)]
        cols = list(zip(*out, strict=True)) or [[]] * 6
        return [pa.array(c, t) for c, t in zip(cols, (pa.int32(), pa.string(), pa.int32(), pa.string(), pa.float64(), pa.string()), strict=True)]

    return scanned(localizations, excluded, "field string, at int, lang string, confidence double, part string", scan).distinct()


def mislabelled(localizations: DataFrame, excluded: DataFrame | None = None, bound: int = SAMPLE) -> DataFrame:
    """(locId, lang): languages really present where the label is missing, names another, or the text holds two.

    The languages of a localization are those of the sentences of its summary
    and of the text in its description. A title is a name, which may be of
    another language than the text and doesn't make one mixed, so it is told by
    ``identified`` and decides nothing here.
    """
    send = localizations.sparkSession.sparkContext.broadcast(fitted(localizations, bound))

    def scan(texts: list[str | None], field: int) -> list[pa.Array]:
        rows, langs = [], []
        for p in portions(texts, 100_000):
            split = Split([t or "" for t in texts[p]])
            told, leads = send.value.tell(split)
            sure = np.flatnonzero((told >= 0) & (leads >= MARGIN) & (split.size >= LEAST))
            own = np.unique(split.text[sure] * len(LANGUAGES) + told[sure])
            rows.append(p.start + own // len(LANGUAGES))
            langs.append(own % len(LANGUAGES))
        rows, langs = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (rows, langs))
        return [pa.array(rows, pa.int32()), pa.array(np.array(LANGUAGES)[langs], pa.string())]

    found = scanned(localizations, excluded, "lang string", scan, first=1)
    each = found.groupBy("locId").agg(F.first("language").alias("language"), F.collect_set("lang").alias("langs"))
    named = F.create_map(*[F.lit(x) for pair in CODES.items() for x in pair])
    label = F.element_at(named, F.split(F.lower(F.trim(F.coalesce("language", F.lit("")))), "[-_@.]")[0])
    return each.where((F.size("langs") > 1) | label.isNull() | ~F.array_contains("langs", F.coalesce(label, F.lit("")))).select("locId", F.explode("langs").alias("lang"))
