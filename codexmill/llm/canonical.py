"""Problem 5: one form for texts that look the same.

A transducer over grapheme clusters. Its rules (what a cluster becomes) are all
worked out before any text is read: single characters from the Unicode tables
and the letters of other scripts with a Latin shape, then every cluster of a
base and marks that has a composed form, over all bases that look alike, and the
Hangul syllables in letters. The rules are checked for conflicts and compiled to
one pattern of clusters, each of which is rewritten by its longest match in the
table, so a text is rewritten in one pass from left to right.

Case, accents and visible punctuation change the look and are kept. Width,
composition of accents, kinds of blanks, invisible characters, mathematical
alphabets, Roman numerals in one character, Kangxi radicals and compatibility
ideographs, ligatures of Latin letters and look-alike letters don't.
"""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache
from itertools import product

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from codexmill.session import written

# Letters of other scripts, or rare ones, that have the shape of a Latin letter or digit (after Unicode's
# confusables), by script. Where a letter could be I, l or 1, the one of its case is taken.
LOOKALIKES = {
    "Cyrillic": ("АВЕЅІЈКМНОРСТУХԚԜҮԌѴӀаеѕіјорсухѵԛԝһӏԁҽүꙇ", "ABESIJKMHOPCTYXQWYGVIaesijopcyxvqwhldeyi"),
    "Greek": ("ΑΒΕΖΗΙΚΜΝΟΡΤΥΧϹͿοϲϳν", "ABEZHIKMNOPTYXCJocjv"),
    "Latin": ("ıɑɡɩɪʋʏᴄᴏᴜᴠᴡᴢꜱ", "iagiivycouvwzs"),
    "Coptic": ("ⲎⲒⲔⲘⲚⲞⲟⲢⲣⲤⲥⲦⲨⲬ", "HIKMNOoPpCcTYX"),
    "Armenian": ("ՍՕհոսցքօ", "UOhnugfo"),
    "Cherokee": ("ᎠᎡᎢᎥᎪᎫᎬᎳᎷᎻᎽᏀᏃᏎᏏᏔᏕᏙᏚᏞᏟᏢᏦᏧᏮᏴꭵꮁꮃꮓꮩꮪꮯ", "DRTiAJEWMHYGZ4bWSVSLCPKd6Birwzvsc"),
    "Lisu": ("ꓐꓑꓒꓓꓔꓖꓗꓙꓚꓜꓝꓟꓠꓡꓢꓣꓦꓧꓪꓫꓬꓮꓰꓲꓳꓴ", "BPdDTGKJCZFMNLSRVHWXYAEIOU"),
    "Deseret": ("𐐄𐐕𐐛𐐠𐐬𐐽𐑈", "OCLSocs"),
}
# Punctuation that is drawn alike, by code point.
SAME_MARK = {chr(0x2010): "-", chr(0x2011): "-", chr(0x37E): ";", chr(0x387): chr(0xB7), chr(0x2BC): chr(0x2019), chr(0x2024): ".", chr(0x2044): "/", chr(0x2215): "/"}
# Characters that take no room and show nothing, by code point.
INVISIBLE = "".join(map(chr, (0xAD, 0x34F, 0x61C, 0x115F, 0x1160, 0x17B4, 0x17B5, 0x180B, 0x180C, 0x180D, 0x180E, *range(0x200B, 0x2010), *range(0x202A, 0x202F), *range(0x2060, 0x2070), 0x3164, *range(0xFE00, 0xFE10), 0xFEFF, 0xFFA0, *range(0xFFF9, 0xFFFC), *range(0xE0000, 0xE01F0))))
JAMO = re.compile("[\u1100-\u11ff]")
MARK_RUNS = re.compile("[\u0300-\u036f]{2,}")
LONGEST = 4
# places of single characters that may have a rule; ideographs, syllables, surrogates and private characters have none
RANGES = ((0x80, 0x3400), (0x4DC0, 0x4E00), (0xA000, 0xAC00), (0xF900, 0x20000), (0x2F800, 0x2FA20))
DAKUTEN = {chr(0x3099): chr(0xFF9E), chr(0x309A): chr(0xFF9F)}


def _one(ch: str) -> str:
    """What a single character becomes, from its decomposition in the Unicode tables."""
    c = ord(ch)
    kind = unicodedata.decomposition(ch).partition(" ")[0]
    if c in (0x85, 0x2028, 0x2029) or unicodedata.category(ch) == "Zs":
        return " "
    if kind in ("<wide>", "<narrow>", "<font>", "<initial>", "<medial>", "<final>", "<isolated>") or 0x2160 <= c < 0x2189 or 0x2E80 <= c < 0x2FE0 or 0xFB00 <= c < 0xFB07:
        return unicodedata.normalize("NFKC", ch)
    return unicodedata.normalize("NFC", ch)


def singles() -> dict[str, str]:
    """Every rule for a single character, followed to its end so that no output is the input of another."""
    same = {a: b for source, target in LOOKALIKES.values() for a, b in zip(source, target, strict=True)} | SAME_MARK
    table: dict[str, str] = {}
    for c in (c for a, b in RANGES for c in range(a, b)):
        ch = chr(c)
        # a letter of the list under an accent is still that letter
        flat = unicodedata.normalize("NFD", _one(ch))
        to = unicodedata.normalize("NFC", "".join(same.get(x, x) for x in flat))
        if to != ch:
            table[ch] = to
    table |= {chr(c): " " for c in (*range(9, 14), 0x1F)} | {chr(c): "" for c in (*range(1, 9), *range(14, 31), 0x7F)}
    return table | dict.fromkeys(INVISIBLE, "")


@lru_cache(maxsize=1)
def rules() -> dict[str, str]:
    """All rules: what each single character and each cluster becomes."""
    table = singles()
    alike: dict[str, list[str]] = {}
    for a, b in table.items():
        if len(b) == 1 and b.isalpha() and a <= "\uffff" and not unicodedata.combining(a):
            alike.setdefault(b, []).append(a)
    composed = [chr(c) for a, b in RANGES[:4] for c in range(a, b) if len(unicodedata.normalize("NFD", chr(c))) > 1]
    for ch in composed:
        to = table.get(ch, ch)
        flat = unicodedata.normalize("NFD", to)
        if len(flat) < 2 or unicodedata.normalize("NFC", flat) != to:
            continue
        # the base and any marks it has taken up already, then the rest one by one
        for k in range(1, len(flat)):
            head = unicodedata.normalize("NFC", flat[:k])
            if len(head) > 1:
                continue
            tails = [(m, DAKUTEN[m]) if m in DAKUTEN else (m,) for m in flat[k:]]
            for base, tail in product((head, *alike.get(head, ())), product(*tails)):
                if (key := base + "".join(tail)) != to:
                    table[key] = to
    lead, vowel, tail = 0x1100, 0x1161, 0x11A7
    for k in range(19 * 21):
        block = chr(0xAC00 + 28 * k)
        table[chr(lead + k // 21) + chr(vowel + k % 21)] = block
        for t in range(1, 28):
            table[chr(lead + k // 21) + chr(vowel + k % 21) + chr(tail + t)] = table[block + chr(tail + t)] = chr(0xAC00 + 28 * k + t)
    check(table)
    return table


def check(table: dict[str, str]) -> None:
    """No rule may yield what another rule would change, alone or as its beginning: one pass must be the last."""
    longer = {k for k in table if len(k) > 1}
    bad = [(a, b) for a, b in table.items() if any(x in table for x in b) or any(b[i:j] in longer for i in range(len(b)) for j in range(i + 2, len(b) + 1))]
    if bad:
        raise ValueError(f"conflicting rules: {bad[:5]}")


@lru_cache(maxsize=1)
def transducer() -> tuple[re.Pattern, dict[int, str]]:
    """The pattern of what may be the input of a rule, longest clusters first, and the rules beyond the basic plane.

    An automaton over characters of the basic plane takes each as one step of a
    table, which it can't with those beyond; these are mapped ahead of it.
    """
    table = rules()
    low = [k for k in table if len(k) == 1 and k <= "\uffff"]
    tails = {c for k in table if len(k) > 1 and not JAMO.match(k[1]) for c in k[1:]} | set(map(chr, range(0x300, 0x370)))
    marks = "[" + "".join(map(re.escape, sorted(tails))) + "]"
    skip = "[" + "".join(re.escape(c) for c in INVISIBLE if c <= "\uffff") + "]*"
    jamo = JAMO.pattern
    cluster = f"(?!{marks})[^\\s](?:{skip}{marks})+|(?:{jamo}|[\uac00-\ud7a3])(?:{skip}{jamo})+|[{''.join(map(re.escape, low))}]"
    return re.compile(cluster), {ord(k): v for k, v in table.items() if len(k) == 1 and k > "\uffff"}


def rewritten(cluster: str) -> str:
    """What a cluster becomes: the rule of its longest beginning, then of the longest of the rest, and so on."""
    table = rules()
    if (to := table.get(cluster)) is not None:
        return to
    flat = "".join(c for c in cluster if c not in INVISIBLE)
    # marks in a row have one order
    flat = MARK_RUNS.sub(lambda m: "".join(sorted(m.group(), key=unicodedata.combining)), flat)
    out, i = [], 0
    while i < len(flat):
        j = next((j for j in range(min(len(flat), i + LONGEST), i, -1) if flat[i:j] in table), None)
        out.append(flat[i] if j is None else table[flat[i:j]])
        i = j or i + 1
    return "".join(out)


def canonical(text: str | None) -> str | None:
    """The one form of a text; null stays null, an empty text stays empty, blanks at the ends are dropped."""
    if text is None:
        return None
    if text.isascii() and text.isprintable():
        return text.strip()
    pattern, beyond = transducer()
    if max(text) > "\uffff":
        text = text.translate(beyond)
    return pattern.sub(lambda m: rewritten(m.group()), text).strip()


@F.pandas_udf(T.StringType())
def canonical_udf(texts: pd.Series) -> pd.Series:
    return texts.map(canonical, na_action="ignore")


def display_strings(localizations: DataFrame, aliases: DataFrame) -> DataFrame:
    """(unit, raw) of all titles, summaries and alias terms, repeats included; ids in lower case without outer blanks."""
    unit = F.lower(F.regexp_replace("unitId", r"^\s+|\s+$", "")).alias("unit")
    texts = localizations.select(unit, F.explode(F.array("title", "summary")).alias("raw"))
    return texts.unionByName(aliases.select(unit, F.col("term").alias("raw"))).where("unit <> '' and raw <> ''")


def spellings(localizations: DataFrame, aliases: DataFrame) -> DataFrame:
    """(form, raw, unit): the units with each spelling of a form that is spelt in two ways or more.

    The class of an equal-looking string is its ``form``; both are hashes of 128
    bits, so no text is shuffled. The rows grow with the units, never with pairs.
    """
    forms = display_strings(localizations, aliases).withColumn("form", canonical_udf("raw")).where("form <> ''")
    rows = written(forms.select(F.unhex(F.md5("form")).alias("form"), F.unhex(F.md5("raw")).alias("raw"), "unit").distinct(), "forms")
    several = rows.groupBy("form").agg(F.min("raw").alias("x"), F.max("raw").alias("y")).where("x <> y").select("form")
    return rows.join(several, "form", "left_semi")


def look_alikes(localizations: DataFrame, aliases: DataFrame) -> DataFrame:
    """(unitIdA, unitIdB): pairs of different books with texts that look the same but are stored otherwise.

    Null and empty texts look like nothing and make no pair; repeated rows
    count once. Spelling is joined against spelling, and units are added after,
    so a form that any number of books store alike makes no pair among those.
    """
    held = written(spellings(localizations, aliases), "spellings")
    kinds = held.select("form", "raw").distinct()
    each = kinds.withColumnRenamed("raw", "ra").join(kinds.withColumnRenamed("raw", "rb"), "form").where("ra < rb")
    a = held.select("form", F.col("raw").alias("ra"), F.col("unit").alias("ua"))
    b = held.select("form", F.col("raw").alias("rb"), F.col("unit").alias("ub"))
    pairs = each.join(a, ["form", "ra"]).join(b, ["form", "rb"]).where("ua <> ub")
    return pairs.select(F.least("ua", "ub").alias("unitIdA"), F.greatest("ua", "ub").alias("unitIdB")).distinct()
