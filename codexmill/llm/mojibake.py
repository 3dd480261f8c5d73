"""Problem 10: text that was decoded with the wrong character encoding.

One pass over all documents counts adjacent characters; the counts are summed
by Spark into a table of fixed size. The score of a pair is its cubed mutual
information, ``log(p(xy)**3 / (p(x) p(y)))``: unlike the plain one it doesn't
reward two rare characters for only ever meeting each other, which is just what
garbled text looks like. A second pass finds in each document the segments whose
pairs are improbable (maximum-scoring segments of the negated score over a
threshold), and tries only there what would undo each known confusion of
encodings. A segment counts as garbled where an inverse mapping gives text that
is more probable, or where characters were lost (replacement characters).
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codexmill.llm.vectext import BMP, M1, codes, mix, portions, table_sum

BITS = 20
THRESHOLD = 12.0  # of the negated score in nats, from which a pair may belong to a garbled segment
SUSPECT = 22.0  # from which a segment is tried for older encodings
STRANGE = 30.0  # from which a pair has no place in an undone text
BRIDGE = 0.1  # nats that each pair below the threshold costs a segment
AROUND = 60  # characters around an improbable part that have to gain with it
LOST = chr(0xFFFD)
# What a text's bytes were read as, and what they were.
UTF8_READ_AS = ("cp1252", "latin-1", "cp1250", "cp1251", "mac_roman", "cp437", "cp1254", "koi8-r", "cp866", "gb18030", "cp932", "big5", "euc_kr")
LEGACY = [
    *(("cp1252", r) for r in ("mac_roman", "cp850", "cp1251", "koi8-r", "cp866", "gb18030", "cp932", "euc_jp", "euc_kr", "big5")),
    ("mac_roman", "cp1252"), ("cp850", "cp1252"), ("cp437", "cp1252"), ("cp1250", "cp1252"), ("cp1251", "cp1252"), ("koi8-r", "cp1252"),
    ("cp1251", "koi8-r"), ("koi8-r", "cp1251"), ("cp1251", "cp866"), ("cp866", "cp1251"), ("mac_roman", "cp1251"), ("cp1251", "mac_cyrillic"),
    ("cp932", "euc_jp"), ("cp932", "gb18030"), ("gb18030", "cp932"), ("gb18030", "euc_kr"), ("gb18030", "euc_jp"), ("euc_kr", "gb18030"),
]
WIDE = ("gb18030", "cp932", "big5", "euc_kr", "euc_jp")
LITERAL = re.compile(r"<(code|nowiki|tt|kbd|samp|pre)\b[^<>]*>(.*?)</\1>", re.S | re.I)


@lru_cache(maxsize=1)
def symbols() -> np.ndarray:
    """ASCII letters count as one small and one capital letter, digits as one digit; the rest stand for themselves."""
    out = np.arange(BMP + 1, dtype=np.uint64)
    out[ord("a") : ord("z") + 1] = ord("a")
    out[ord("A") : ord("Z") + 1] = ord("A")
    out[ord("0") : ord("9") + 1] = ord("0")
    out[[9, 10, 13]] = 32
    return out


@lru_cache(maxsize=1)
def continuations() -> np.ndarray:
    """Whether a character is what a byte that goes on in UTF-8 looks like, read as Western European."""
    out = np.zeros(BMP + 1, bool)
    out[0x80:0xC0] = True
    out[[ord(bytes([b]).decode("cp1252", "replace")) for b in range(0x80, 0xC0)]] = True
    out[ord(LOST)] = False
    return out


def points(text: str) -> np.ndarray:
    """A text's code points, those beyond the basic plane as one."""
    return np.minimum(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32), BMP)


def pair_slots(low: np.ndarray) -> np.ndarray:
    s = symbols()[low]
    return (mix(s[:-1] * M1 + s[1:]) >> np.uint64(64 - BITS)).astype(np.int64)


def counts(corpus: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(characters, pairs) of all texts, as arrays of fixed size."""

    split = BMP + 1

    def count(table: np.ndarray, batch: pa.RecordBatch) -> None:
        texts = batch.column(0).to_pylist()
        for part in portions(texts):
            low = np.minimum(codes(texts[part])[0], BMP)
            table[:split] += np.bincount(low, minlength=split)
            if len(low) > 1:
                table[split:] += np.bincount(pair_slots(low), minlength=1 << BITS)

    table = table_sum(corpus.select("text"), split + (1 << BITS), count).astype(float)
    ones, pairs = table[:split], table[split:]
    grouped = np.bincount(symbols().astype(np.int64), weights=ones, minlength=BMP + 1)
    return grouped[symbols().astype(np.int64)], pairs


class Model:
    """Scores from counts; float32 arrays of fixed size, so they may be broadcast at any size of corpus."""

    def __init__(self, ones: np.ndarray, pairs: np.ndarray):
        total = max(1.0, pairs.sum())
        self.one = np.log((ones + 0.5) / total).astype(np.float32)
        self.pair = np.log((pairs + 0.05) / total).astype(np.float32)
        self.rare = float(np.log(3 / total))

    def improbable(self, low: np.ndarray) -> np.ndarray:
        """The negated cubed mutual information of each adjacent pair."""
        return self.one[low[:-1]] + self.one[low[1:]] - 3 * self.pair[pair_slots(low)]

    def total(self, text: str) -> float:
        """Summed log probability of a text's pairs."""
        low = points(text)
        return float(self.pair[pair_slots(low)].sum()) if len(low) > 1 else 0.0

    def totals(self, texts: list[str]) -> np.ndarray:
        """``total`` of texts without line ends, all at once."""
        low = points("\n".join(texts))
        if len(low) < 2:
            return np.zeros(len(texts))
        ends = low == 10
        p = np.where(ends[:-1] | ends[1:], np.float32(0), self.pair[pair_slots(low)])
        starts = np.append(0, np.flatnonzero(ends) + 1)
        return np.diff(np.append(0.0, np.cumsum(p, dtype=np.float64)[np.append(starts[1:] - 1, len(low) - 1) - 1]))

    def unseen(self, text: str) -> float:
        """The share of a text's characters beyond ASCII that the corpus hardly has."""
        low = points(text)
        low = low[low > 127]
        return float((self.one[low] < self.rare).mean()) if len(low) else 0.0

    def odd(self, text: str) -> tuple[int, int]:
        """How many of a text's pairs with a character beyond ASCII are improbable, and how many there are."""
        low = points(text)
        if len(low) < 2:
            return 0, 0
        matters = (low[:-1] > 127) | (low[1:] > 127)
        unseen = self.one[low] < self.rare
        return int((matters & ((self.improbable(low) > STRANGE) | unseen[:-1] | unseen[1:])).sum()), int(matters.sum())


@lru_cache(maxsize=32)
def to_bytes(encoding: str) -> dict[str, int]:
    """Character to byte of a one-byte encoding; bytes it leaves undefined stand as control characters."""
    out = {chr(b): b for b in range(256)} if encoding in ("cp1252", "latin-1", "cp1250", "cp1254") else {chr(b): b for b in range(128)} | {chr(b): b for b in range(0x80, 0xA1)}
    for b in range(128, 256):
        try:
            out[bytes([b]).decode(encoding)] = b
        except UnicodeDecodeError:
            pass
    return out


@lru_cache(maxsize=1)
def begun() -> re.Pattern:
    """What the first two bytes of a character in UTF-8 look like, read in any one-byte encoding."""
    pairs = []
    for e in (e for e in UTF8_READ_AS if e not in WIDE):
        of = {b: re.escape(c) for c, b in to_bytes(e).items() if c > "\x7f"}
        pairs.append("[" + "".join(of[b] for b in range(0xC2, 0xF5) if b in of) + "][" + "".join(of[b] for b in range(0x80, 0xC0) if b in of) + "]")
    return re.compile("|".join(pairs))


@lru_cache(maxsize=32)
def byte_table(encoding: str) -> dict[int, int]:
    """For str.translate: a character to the one whose code is its byte; what the encoding doesn't have becomes 0xFF."""
    return _Table({ord(c): b for c, b in to_bytes(encoding).items()})


class _Table(dict):
    def __missing__(self, c: int) -> int:
        return 0x110


def undo(text: str, wrong: str, right: str) -> tuple[str, float] | None:
    """The text as it was before its ``right`` bytes were read as ``wrong``, and the share of characters lost."""
    if wrong in WIDE:
        try:
            raw = text.encode(wrong)
        except UnicodeEncodeError as e:
            # control and private characters stand for bytes the encoding has no character for
            c = ord(text[e.start])
            if not (0x80 <= c < 0x100 or 0xE000 <= c < 0xF900 or c == 0xFFFD):
                return None
            raw = b"".join(_encoded(ch, wrong) for ch in text)
    else:
        made = text.translate(byte_table(wrong))
        strange = made.count(chr(0x110))
        if strange > 0.1 * len(text):
            return None
        raw = made.replace(chr(0x110), chr(0xFF)).encode("latin-1")
    made = raw.decode(right, "replace")
    lost = made.count(LOST)
    if lost > 0.5 * len(made) or made.isascii() or made == text:
        return None
    return made, lost / (len(made) - len(made.encode("ascii", "ignore")))


class Bytes:
    """The bytes that several texts were read from, if they were read as ``wrong``."""

    def __init__(self, texts: list[str], wrong: str):
        self.texts, self.wrong, self.raw, self.strange, self.none = texts, wrong, None, None, False
        joined = "\n".join(texts)
        if wrong in WIDE:
            try:
                self.raw = joined.encode(wrong)
            except UnicodeEncodeError:
                pass
            return
        known = to_bytes(wrong)
        if not any(c in known for c in set(joined) if c > "\x7f"):
            self.none = True
            return
        made = joined.translate(byte_table(wrong))
        if chr(0x110) in made:
            self.strange = [p.count(chr(0x110)) > 0.1 * len(p) for p in made.split("\n")]
            made = made.replace(chr(0x110), chr(0xFF))
        self.raw = made.encode("latin-1")

    def read(self, right: str) -> list[tuple[str, float] | None]:
        """``undo`` of each text."""
        if self.none:
            return [None] * len(self.texts)
        pieces = self.raw.decode(right, "replace").split("\n") if self.raw is not None else []
        if len(pieces) != len(self.texts):
            return [undo(t, self.wrong, right) for t in self.texts]
        out: list[tuple[str, float] | None] = []
        for k, (p, t) in enumerate(zip(pieces, self.texts, strict=True)):
            lost = p.count(LOST)
            out.append(None if self.strange and self.strange[k] or lost > 0.5 * len(p) or p == t or p.isascii() else (p, lost / (len(p) - len(p.encode("ascii", "ignore"))) if lost else 0.0))
        return out


def _encoded(ch: str, encoding: str) -> bytes:
    try:
        return ch.encode(encoding)
    except UnicodeEncodeError:
        return bytes([ord(ch)]) if ord(ch) < 256 else b"\xff"


def segments(score: np.ndarray) -> list[tuple[int, int]]:
    """All maximum-scoring segments: none can be made longer or joined with the next without losing score.

    Pairs above the threshold add what they exceed it by; each pair between
    them costs ``BRIDGE``. Runs of either kind count as one value, so the work
    follows the improbable pairs and not the length of the text.
    """
    at = np.flatnonzero(score > 0)
    if not len(at):
        return []
    opens = np.flatnonzero(np.append(True, np.diff(at) > 1))
    begins, ends = at[opens].tolist(), (at[np.append(opens[1:], len(at)) - 1] + 1).tolist()
    if len(begins) == 1:
        return [(begins[0], ends[0] + 1)]
    gains = np.add.reduceat(score[at], opens).tolist()
    found: list[tuple[int, int, float, float]] = []  # begin, end, running sum before and after
    total, last = 0.0, begins[0]
    for begin, end, gain in zip(begins, ends, gains, strict=True):
        before = total - BRIDGE * (begin - last)
        total, last = before + gain, end
        now = (begin, end, before, total)
        while True:
            # the nearest segment that began lower; it is joined if its end lies lower, too
            k = len(found) - 1
            while k >= 0 and found[k][2] >= now[2]:
                k -= 1
            if k < 0 or found[k][3] >= now[3]:
                break
            now = (found[k][0], now[1], found[k][2], now[3])
            del found[k:]
        found.append(now)
    return [(a, b + 1) for a, b, _, _ in found]


class Inverter:
    """Undoes UTF-8 that was read as something else, run by run; what a run becomes is remembered."""

    def __init__(self, model: Model):
        self.model, self.known, self.parts, self.cuts = model, {}, {}, {}

    def run(self, run: str, before: str, after: str) -> str | None:
        """The undoing of a run of characters beyond ASCII that makes it more probable between its neighbours."""
        if run not in self.known:
            self.learn([run])
        best, start = None, None
        for made, lost in self.known[run]:
            if start is None:
                start = self.model.total(before + run + after)
            gain = self.model.total(before + made + after) - start
            # a reading without loss is evidence by itself: few strings are valid UTF-8 by chance
            if self.model.unseen(made) > 0.3:
                continue
            if lost:
                bad, pairs = self.model.odd(made.replace(LOST, ""))
                if bad > 0.1 * pairs or gain < 0.7 * len(made):
                    continue
            if gain > 0 and (best is None or gain > best[0]):
                best = (gain, made)
        return best and best[1]

    def split(self, runs: list[tuple[tuple[int, int], str]]) -> list[tuple[tuple[int, int], str]]:
        """Runs, learned before, with their places; one that can't be read whole without loss is parted where what can begins and ends."""
        out = []
        for (a, b), run in runs:
            # no one-byte encoding has an ideograph, kana or syllable
            if len(run) < 6 or min(run) >= "\u2e80" or any(not lost for _, lost in self.known[run]) or not begun().search(run):
                out.append(((a, b), run))
                continue
            cuts = self.cuts.get(run) or self.cuts.setdefault(run, self.borders(run))
            out += [((a + x, a + y), run[x:y]) for x, y in zip(cuts, cuts[1:], strict=False)]
        if len(out) > len(runs):
            self.learn([run for _, run in out])
        return out

    @staticmethod
    def borders(run: str) -> list[int]:
        """Where a run parts into sound text and UTF-8 read in a one-byte encoding, if it does in one place.

        Two-byte encodings read so hold valid UTF-8 by chance, but in many places.
        """
        best, most = [0, len(run)], 5
        for wrong in UTF8_READ_AS:
            if wrong in WIDE:
                continue
            spans = [m.span() for m in WHOLE_UTF8.finditer(run.translate(byte_table(wrong)))]
            if len(spans) == 1 and (spans[0][0] == 0 or spans[0][1] == len(run)) and (size := spans[0][1] - spans[0][0]) > most:
                best, most = sorted({0, len(run), *spans[0]}), size
        return best

    def learn(self, runs: list[str]) -> None:
        """Work out the readings of runs not yet met, all at once."""
        if len(self.known) > 200_000:
            self.known.clear()
            self.cuts.clear()
        new = [r for r in dict.fromkeys(runs) if r not in self.known]
        for r, readings in zip(new, self.readings(new), strict=True):
            self.known[r] = readings

    def readings(self, runs: list[str], depth: int = 0) -> list[list[tuple[str, float]]]:
        """What UTF-8 each run may have been; up to three confusions in a row."""
        out: list[list[tuple[str, float]]] = [[] for _ in runs]
        for wrong in UTF8_READ_AS if runs else ():
            for k, made in enumerate(Bytes(runs, wrong).read("utf-8")):
                if made and made not in out[k] and (not made[1] or made[1] <= 0.34 and len(runs[k]) > 4):
                    out[k].append(made)
        if depth < 2:
            for k, own in enumerate(out):
                if sound := [m for m, lost in own if not lost]:
                    for more in self.readings(sound, depth + 1):
                        own += [m for m in more if m not in own]
        return out

    def legacy(self, parts: list[str]) -> list[tuple[str, str]]:
        """The confusions between older encodings whose undoing makes improbable parts probable, best first."""
        total, good = np.zeros(len(LEGACY)), np.zeros(len(LEGACY), int)
        if len(self.parts) > 100_000:
            self.parts.clear()
        self.profile([p for p in dict.fromkeys(parts) if p not in self.parts])
        for part in parts:
            gain, changed = self.parts[part]
            total += gain
            good += changed
        total[(good < 3) & (total < 18) | (good == 0)] = 0
        return [LEGACY[k] for k in np.argsort(-total) if total[k] > 12]

    def holds(self, text: str, spots: list[tuple[int, int]], way: tuple[str, str]) -> bool:
        """Whether undoing everything around improbable parts gains too: sound text would be spoiled by it."""
        total, gain, last = 0.0, 0.0, 0
        for a, b in spots:
            if a - AROUND > last:
                total, gain = total + gain * (gain > 6), 0.0
            for m in MIXED.finditer(text, max(last, a - AROUND), min(len(text), b + AROUND)):
                last = m.end()
                x, y = text[m.start() - 1 : m.start()], text[m.end() : m.end() + 1]
                made = undo(m.group(), *way)
                if made is None or made[1] > 0.1:
                    continue
                bad, pairs = self.model.odd(made[0])
                gain += -5.0 if bad > 0.15 * pairs else self.model.total(x + made[0] + y) - self.model.total(x + m.group() + y)
        return total + gain * (gain > 6) > 12

    def profile(self, parts: list[str]) -> None:
        """What each confusion's undoing of each part gains, and how many characters it yields; 0 where it yields strange pairs."""
        if not parts:
            return
        before = self.model.totals(parts)
        cores = [p.strip() for p in parts]
        for p in parts:
            self.parts[p] = (np.zeros(len(LEGACY)), np.zeros(len(LEGACY), int))
        raw = {wrong: Bytes(cores, wrong) for wrong in {w for w, _ in LEGACY}}
        for k, (wrong, right) in enumerate(LEGACY):
            if raw[wrong].none:
                continue
            sound = [(i, m[0]) for i, m in enumerate(raw[wrong].read(right)) if m and m[1] <= 0.1 and "\n" not in m[0]]
            if not sound:
                continue
            texts = [parts[i][: len(parts[i]) - len(parts[i].lstrip())] + m + parts[i][len(parts[i].rstrip()) :] for i, m in sound]
            gains = self.model.totals(texts) - before[[i for i, _ in sound]]
            for j in np.flatnonzero(gains > 3):
                i, made = sound[j]
                bad, pairs = self.model.odd(made)
                if bad <= 0.15 * pairs:
                    gain, changed = self.parts[parts[i]]
                    gain[k], changed[k] = gains[j], len(made) - len(made.encode("ascii", "ignore"))


BEYOND = re.compile(r"[^\x00-\x7f]+")
# bytes as characters that are whole characters in UTF-8
WHOLE_UTF8 = re.compile("(?:[\xc2-\xdf][\x80-\xbf]|[\xe0-\xef][\x80-\xbf]{2}|[\xf0-\xf4][\x80-\xbf]{3})+")
# bytes of two-byte encodings may look like single letters between the others
MIXED = re.compile(r"[^\x00-\x7f](?:[!-~]?[^\x00-\x7f])*")


def repair(text: str, inverter: Inverter, score: np.ndarray, restore: bool = True) -> tuple[bool, str]:
    """Whether any part of a text is garbled, and the text with what could be restored (as far as was looked unless ``restore``)."""
    shown = [m.span(2) for m in LITERAL.finditer(text)] if "<" in text else []
    spans = segments(score)
    found, made = _undone(text, inverter, score, spans, shown, restore)
    if found and restore and made[2]:
        # once UTF-8 is undone somewhere, what is as frequent in the corpus as sound text is looked at too
        again = _undone(text, inverter, score, [*spans, *(m.span() for m in BEYOND.finditer(text))], shown, restore)[1]
        made = again if again[2] else made
    if found and not restore:
        return True, text
    text, score, _, rest = made
    spots = [m.span() for a, b in rest for m in MIXED.finditer(text, a, b) if score[max(0, m.start() - 1) : m.end()].max(initial=0) > SUSPECT - THRESHOLD]
    made = older(text, spots, inverter, restore)
    return found or made is not None, text if made is None else made


def _undone(text: str, inverter: Inverter, score: np.ndarray, spans: list[tuple[int, int]], shown: list[tuple[int, int]], restore: bool) -> tuple[bool, tuple[str, np.ndarray, bool, list[tuple[int, int]]]]:
    """Whether UTF-8 was undone or is lost in spans of a text, and the text, its scores, whether any was undone, and the parts of spans left."""
    found, changed, out, marks, last, size, rest = False, False, [], [], 0, 0, []
    parted: list = []
    for a, b in sorted(spans):
        if shown and any(x <= a + 1 and b - 1 <= y for x, y in shown):
            continue  # a reader is shown these characters as such
        while a > 0 and text[a - 1] > "\x7f":
            a -= 1
        while b < len(text) and text[b] > "\x7f":
            b += 1
        if parted and a < parted[-1][1]:
            a, b = parted[-1][0], max(b, parted.pop()[1])
        parted.append((a, b, [(m.span(), m.group()) for m in BEYOND.finditer(text, a, b)]))
    inverter.learn([run for _, _, runs in parted for _, run in runs])
    parted = [(a, b, inverter.split(runs)) for a, b, runs in parted]
    readings = inverter.known
    for a, b, runs in parted:
        begin = a
        for (start, stop), run in runs:
            if not readings[run] and LOST not in run:
                continue
            made = inverter.run(run, text[start - 1 : start] if start else "", text[stop : stop + 1])
            if made is None and LOST not in run:
                continue
            if not restore:
                return True, (text, score, made is not None, rest)
            found, changed = True, changed or made is not None
            out += [text[last:start], run if made is None else made]
            marks += [score[last:start], np.full(len(out[-1]), -THRESHOLD, np.float32)]
            if begin < start:
                rest.append((begin + size - last, start + size - last))
            size += len(out[-2]) + len(out[-1])
            begin = last = stop
        if begin < b:
            rest.append((begin + size - last, b + size - last))
    if not found:
        return False, (text, score, False, rest)
    return True, ("".join(out) + text[last:], np.concatenate([*marks, score[last:]]), changed, rest)


def older(text: str, spots: list[tuple[int, int]], inverter: Inverter, restore: bool = True) -> str | None:
    """A text with its confusions between older encodings undone, None where there are none.

    The best confusion of what is left is undone in the clusters of spots that
    it fits best, and in the runs around them that become no less probable (a
    single character: clearly more), until none holds any more.
    """

    def part(a: int, b: int) -> str:
        # a letter beside a part counts as any letter does, so the part is soon met again
        x, y = (t if t in "aA0 " or not t.isalnum() else "0" if t.isdigit() else "A" if t.isupper() else "a" for t in (text[a - 1 : a] if a else "", text[b : b + 1]))
        return x.replace("\n", " ") + text[a:b] + y.replace("\n", " ")

    def undone(a: int, b: int, way: tuple[str, str]) -> str | None:
        """What a run becomes, None where that is less probable."""
        made = undo(text[a:b], *way)
        if made is None or made[1] > 0.1:
            return None
        x, y = text[a - 1 : a] if a else "", text[b : b + 1]
        return made[0] if inverter.model.total(x + made[0] + y) >= inverter.model.total(x + text[a:b] + y) else None

    def sure(a: int, b: int, made: str) -> bool:
        """Whether a run that isn't strange by itself may be taken for garbled: whole, and a single character with a clear gain."""
        x, y = text[a - 1 : a] if a else "", text[b : b + 1]
        if LOST in made or inverter.model.odd(x + made + y)[0] or inverter.model.unseen(made):
            return False
        few = sum(c > "\x7f" for c in text[a:b]) < 2
        return not few or inverter.model.total(x + made + y) - inverter.model.total(x + text[a:b] + y) > 6

    done: dict[tuple[int, int], str] = {}
    late: dict[tuple[int, int], tuple[str, str]] = {}
    shown = [m.span(2) for m in LITERAL.finditer(text)] if "<" in text else []
    left, any_way = spots, False
    while left:
        parts = [part(a, b) for a, b in left]
        way = next((w for w in inverter.legacy(parts) if inverter.holds(text, left, w)), None)
        if way is None:
            break
        any_way = True
        if not restore:
            break
        clusters: list[list[int]] = []
        for k, (a, _) in enumerate(left):
            if not clusters or a - left[clusters[-1][-1]][1] > AROUND:
                clusters.append([])
            clusters[-1].append(k)
        at = LEGACY.index(way)
        gains = [sum(inverter.parts[parts[k]][0] for k in c) for c in clusters]
        fit = [c for c, g in zip(clusters, gains, strict=True) if g[at] > 0 and g[at] >= g.max()] or [c for c, g in zip(clusters, gains, strict=True) if g[at] > 0]
        new = {}
        for x in left:
            late.setdefault(x, way)
        for k in (k for c in fit for k in c):
            late[left[k]] = way
            if (made := undone(*left[k], way)) is not None:
                new[left[k]] = made
        if not new:
            break
        done |= new
        # runs around those undone, as far as each next one is undone too
        taken = sorted({*done, *left})
        runs = [m.span() for m in MIXED.finditer(text)]
        runs = [(a, b) for a, b in runs if not any(x < b and a < y for x, y in taken) and not any(x <= a and b <= y for x, y in shown)]
        for line, sign in ((runs, 1), (runs[::-1], -1)):
            ends = sorted(new, reverse=sign < 0)
            reach, k = None, 0
            for a, b in line:
                while k < len(ends) and (ends[k][0] < a if sign > 0 else ends[k][0] > a):
                    reach, k = ends[k], k + 1
                if (a, b) in done or reach is None or (a - reach[1] if sign > 0 else reach[0] - b) > AROUND:
                    continue
                if (made := undone(a, b, way)) is not None and sure(a, b, made):
                    done[a, b], reach = made, (a, b)
        left = [x for x in left if x not in done]
    if not any_way:
        return None
    for x, way in late.items():
        # what no other confusion fits was damaged as its surroundings were
        if x not in done and (made := undo(text[x[0] : x[1]], *way)) and made[1] <= 0.1:
            done[x] = made[0]
    pieces, last = [], 0
    for (a, b), made in sorted(done.items()):
        pieces += [text[last:a], made]
        last = b
    return "".join(pieces) + text[last:]


def garbled(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", restore: bool = True) -> DataFrame:
    """(doc_id, text): the garbled documents and their text with what could be restored (null unless ``restore``).

    Null and empty texts are not garbled. Repeated rows are reported once each.
    A segment that stands whole inside an element for literal text (``code``,
    ``nowiki`` and the like) is an example and no damage.
    """
    spark = documents.sparkSession
    corpus = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).where("text <> ''")
    send = spark.sparkContext.broadcast(Model(*counts(corpus)))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = send.value
        inverter = Inverter(model)
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            rows = []
            for part in portions(texts):
                raw, at = codes(texts[part])
                low = np.minimum(raw, BMP)
                if len(low) < 2:
                    continue
                signs = symbols()[low]
                score = np.full(len(low), -THRESHOLD, np.float32)
                beyond = low > 127
                matters = np.flatnonzero(beyond[:-1] | beyond[1:])
                score[matters] = model.one[low[matters]] + model.one[low[matters + 1]] - 3 * model.pair[(mix(signs[matters] * M1 + signs[matters + 1]) >> np.uint64(64 - BITS)).astype(np.int64)] - THRESHOLD
                # what begins as UTF-8 read in a one-byte encoding does is tried however often the corpus has it
                signed = np.flatnonzero((low[:-1] >= 0xC2) & (low[:-1] <= 0xF4) & continuations()[low[1:]])
                # a character beyond ASCII by itself is hardly ever a piece of UTF-8, so it has to be stranger
                alone = ~(beyond[matters] & beyond[matters + 1]) & (low[matters] != ord(LOST)) & (low[matters + 1] != ord(LOST))
                score[matters[alone & (score[matters] <= SUSPECT - THRESHOLD)]] = -THRESHOLD
                score[signed] = np.maximum(score[signed], 1.0)
                odd = np.unique(np.searchsorted(at, np.flatnonzero(score > 0), "right") - 1)
                for i in odd:
                    own = texts[part.start + i]
                    bad, made = repair(own, inverter, score[at[i] : at[i + 1] - 1], restore)
                    if bad:
                        rows.append((ids[part.start + i], made if restore else None))
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.string())], names=["doc_id", "text"])

    return corpus.mapInArrow(scan, "doc_id long, text string")
