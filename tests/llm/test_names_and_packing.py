"""Problems 4 and 8."""

import random
from collections import Counter

import pytest

from codexmill.llm import names, packing


def edit(a, b):
    """Edits between two strings, a swap of neighbours being one."""
    rows = [list(range(len(b) + 1))]
    for i, c in enumerate(a, 1):
        row = [i]
        for j, d in enumerate(b, 1):
            best = min(row[j - 1] + 1, rows[-1][j] + 1, rows[-1][j - 1] + (c != d))
            if i > 1 and j > 1 and c == b[j - 2] and a[i - 2] == d:
                best = min(best, rows[-2][j - 2] + 1)
            row.append(best)
        rows.append(row)
    return rows[-1][-1]


def swapped(s, *places):
    for p in places:
        s = s[:p] + s[p + 1] + s[p] + s[p + 2 :]
    return s


def test_segment_join_equals_brute_force(spark, monkeypatch):
    rng = random.Random(1)
    base = ["".join(rng.choice("abcd") for _ in range(rng.randint(1, 14))) for _ in range(110)]
    long = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(6, 16))) for _ in range(30)]
    forms = {*base, *(x[: len(x) // 2] + "b" + x[len(x) // 2 + 1 :] for x in base)}
    for x in long:
        p, q = sorted(rng.sample(range(len(x) - 1), 2))
        forms |= {x, swapped(x, p, q) if q > p + 1 else swapped(x, p), swapped(x, p)[:-1] + "z", swapped(x, q)[1:], swapped(x, p) + "y"}
    forms = sorted(forms - {""})
    want = {(a, b): edit(a, b) for a in forms for b in forms if a < b and abs(len(a) - len(b)) < 3 and edit(a, b) <= 2}
    assert all(names.within(a, b) == n for (a, b), n in want.items())
    for common in (1, 64):
        monkeypatch.setattr(names, "COMMON", common)
        got = {(r["a"], r["b"]): r["edits"] for r in names.near_forms(spark.createDataFrame([(f,) for f in forms], "form string")).collect()}
        assert got == want


def test_no_pair_of_swaps_is_without_a_key():
    rng = random.Random(2)
    for _ in range(4000):
        s = "".join(rng.sample("abcdefghijklmnopqrs", rng.randint(5, 12)))
        p = rng.randrange(len(s) - 1)
        q = rng.randrange(len(s) - 1)
        t = swapped(s, p, q) if abs(p - q) > 1 else swapped(s, p)
        if rng.random() < 0.5:
            k = rng.randrange(len(t))
            t = rng.choice([t[:k] + t[k + 1 :], t[:k] + "z" + t[k + 1 :], t[:k] + "z" + t[k:]])
        if names.within(s, t) <= 2:
            a, b = sorted((s, t), key=len)
            assert {k for k, _ in names.index_keys(a)} & {k for k, _ in names.probe_keys(b)}, (s, t)
    assert {k for k, _ in names.index_keys("abcdefghi")} & {k for k, _ in names.probe_keys("abdcefhgi")}


def test_parts_and_short_forms():
    assert names.parts('"Nurqobik Ltn. Bks Co., Ltd."') == ("nurqobik", "ltn", "books")
    common = frozenset({"lantern", "harbor", "street", "studio", "comics"})
    assert names.expanded(("nurqobik", "ltn", "hbr", "cmx", "st", "xyz"), common) == ("nurqobik", "lantern", "harbor", "comics", "st", "xyz")
    assert names.parts("JohnSmith") == ("john", "smith") and names.parts("月飞云西南·著") == ("月飞云西南",) and names.parts("") == ()
    assert names.compatible(("a", "simlubis"), ("astrid", "bruno", "simlubis")) and not names.compatible(("anna", "simlubis"), ("bruno", "simlubis"))


def test_facts_are_the_rarest_capital_and_the_year(spark):
    said = {"a": "Born in Setvoford. Novelist; debut 2013.", "b": "小说作者，2013年出道，现居Setvoford。", "c": None, "d": "A writer.", "e": "Novelist, 1960", "f": "Seit 1931 lebt die Autorin Novelist in Überberg."}
    said |= {f"x{i}": f"Novelist. Born in {chr(65 + i % 26)}{chr(97 + i // 26)}town, since 1990." for i in range(80)}
    found = names.facts(spark.createDataFrame([(u, t, t) for u, t in said.items()], "unit string, title string, summary string"))
    got = {r["unit"]: r["said"] for r in found.collect()}
    assert got["a"] == got["b"] == "setvoford2013" and got["x0"] == "aatown1990" and not {"c", "d", "e"} & set(got)
    assert got["f"] == "uberberg1931"


def test_same_entities(spark, clash):
    x = "Novelist from Makwuford, first published in 1960."
    people = {
        "a1": ("Astrid Bruno Simlubis", x), "a2": ("simlubis, astrid bruno", None), "a3": ("Astrid Bruno Simlubsi", "Born in Makwuford. Novelist; debut 1960."), "a4": ("A. B. Simlubis", None),
        "b1": ("Karl Simlubis", "Novelist from Hopenberg, first published in 1931."), "c1": ("Polceman Lantern Press Ltd", "Publisher in Laklaford, founded 1980."),
        "c2": ("The Polceman Ltn. Pr.", "Laklaford imprint, since 1980."), "c3": ("Polceman Brewery Ltd", "Record label in Sandaberg, founded 1999."), "d1": (None, None), "d2": ("", ""),
        "h1": ("云青夜桃冬", "译者，1998年出道，现居Hokpestad。"), "h2": ("【云青夜桃冬】著", None), "h3": ("Yunqing Yetaodong", None), "h4": ("朝夏梅绿火", None),
    }
    rows = [(u, [(("zh" if t and t[0] > "㐀" else "en"), t, s)]) for u, (t, s) in people.items()]
    rows += [("h1", [("en", "Yunqing Yetaodong", None)]), (" A1 ", rows[0][1]), (None, rows[0][1]), ("z", None), ("y", [])] + rows[:2]
    df = clash(spark.createDataFrame(rows, "creditedUnitId string, localizations array<struct<language:string,title:string,summary:string>>"))
    got = {tuple(r) for r in names.same_entities(df).collect()}
    want = {(a, b) for s in (("a1", "a2", "a3", "a4"), ("c1", "c2"), ("h1", "h2", "h3")) for a in s for b in s if a < b}
    assert got == want
    assert names.same_entities(df.limit(0)).count() == 0


@pytest.mark.parametrize("place", [None, "Novelist from Makwuford, first published in 1960."])
def test_every_pair_on_a_form_is_judged(spark, place):
    people = {"a": ("Walter Harper", None), "b": ("Will Harper", None), "c": ("William Harper", place), "d": ("Will Harper", None), "e": ("Astrid Simlubis", None)}
    rows = [(u, [("en", t, s)]) for u, (t, s) in people.items()]
    df = spark.createDataFrame(rows, "creditedUnitId string, localizations array<struct<language:string,title:string,summary:string>>")
    assert {tuple(r) for r in names.same_entities(df).collect()} == {("b", "c"), ("b", "d"), ("c", "d")}


@pytest.mark.parametrize("seed", range(6))
def test_fill_keeps_the_capacity_and_wastes_little(seed):
    rng = random.Random(seed)
    sizes = [rng.choice([rng.randint(0, 60), rng.randint(0, 700), rng.randint(300, 1000), 1000]) for _ in range(3000)]
    home = packing.fill(sizes, 1000)
    used = Counter()
    for i, k in enumerate(home):
        used[k] += sizes[i]
    assert max(used.values()) <= 1000 and min(home) == 0
    bound = max(-(-sum(sizes) // 1000), sum(s > 500 for s in sizes))
    assert len(used) <= 1.03 * bound + 1
    large = Counter(k for i, k in enumerate(home) if 3 * sizes[i] > 1000)
    assert max(large.values()) <= 2
    assert packing.fill([], 10) == []


def test_containers(spark, clash):
    pytest.importorskip("tiktoken")
    rng = random.Random(3)
    texts = {i: " ".join(f"w{rng.randint(0, 999)}" for _ in range(rng.randint(0, 60))) for i in range(300)} | {900: "字é😀 word " * 900, 901: "", 902: None, 903: "x" * 30_000}
    df = clash(spark.createDataFrame(list(texts.items()), "doc_id long, text string"))
    enc = packing.encoding()
    for shard in (40_000, 50):
        rows = packing.containers(df, capacity=256, shard=shard).collect()
        used, pieces = Counter(), {}
        for r in rows:
            used[r["container"]] += r["tokens"]
            pieces.setdefault(r["doc_id"], []).append((r["piece"], r["begin"], r["end"], r["tokens"]))
        assert max(used.values()) <= 256 and set(pieces) == set(texts)
        for i, own in pieces.items():
            own.sort()
            text = texts[i] or ""
            assert "".join(text[a:b] for _, a, b, _ in own) == text
            assert all(len(enc.encode_ordinary(text[a:b])) == n for _, a, b, n in own)
            assert len(own) == 1 or len(enc.encode_ordinary(text)) > 256
    assert packing.containers(df.limit(0)).count() == 0
