"""Dedup, state, resolution, quality, export, fan-in and crawl against plain versions."""

import random

import pytest
from pyspark.sql import functions as F

from tessera.operators import dedup, export, fanin, quality, resolve, state
from tessera.operators.components import components
from tessera.sources import crawl


def test_first_wins(spark):
    df = spark.createDataFrame([(3, "a"), (1, "a"), (2, "b"), (4, None), (5, None)], "ord long, k string")
    assert sorted(r.ord for r in dedup.first_wins(df, "k", "ord").collect()) == [1, 2, 4]


@pytest.mark.parametrize("seed", range(3))
def test_two_keys(spark, seed):
    r = random.Random(seed)
    rows = [(i, r.choice([None, *"abcdefgh"]), r.choice([None, *"stuvwxyz"])) for i in range(60)]
    kept, seen_a, seen_b = [], set(), set()
    for i, a, b in rows:
        if (a is None or a not in seen_a) and (b is None or b not in seen_b):
            kept.append(i)
            seen_a.add(a)
            seen_b.add(b)
    df = spark.createDataFrame(rows, "o long, a string, b string").repartition(3)
    assert sorted(x.o for x in dedup.two_keys(df, "a", "b", "o").collect()) == kept


def test_two_keys_of_the_survey(spark):
    df = spark.createDataFrame([(1, "f1", "n1"), (2, "f1", "n2"), (3, "f2", "n2")], "o long, a string, b string")
    assert sorted(x.o for x in dedup.two_keys(df, "a", "b", "o").collect()) == [1, 3]
    assert dedup.two_keys(df.limit(0), "a", "b", "o").collect() == []


@pytest.mark.parametrize("one_task", [5, 10**6])
def test_two_keys_of_a_long_chain(spark, monkeypatch, one_task):
    """a0b0, a0b1, a1b1, a1b2 ...: every second row stays, though rounds alone would take one for every two rows."""
    monkeypatch.setattr(dedup, "ONE_TASK", one_task)
    monkeypatch.setattr(dedup, "ROUNDS", 2)
    n = 14 if one_task == 5 else 10_000
    rows = [(i, i // 2, (i + 1) // 2) for i in range(n)] + [(n + 1, None, None), (n + 2, None, 0), (n + 3, n, None)]
    df = spark.createDataFrame(rows, "o long, a long, b long").repartition(3)
    assert sorted(x.o for x in dedup.two_keys(df, "a", "b", "o").collect()) == [*range(0, n, 2), n + 1, n + 3]


@pytest.mark.parametrize("seed", range(2))
def test_two_keys_by_components(spark, monkeypatch, seed):
    monkeypatch.setattr(dedup, "ONE_TASK", 12)
    monkeypatch.setattr(dedup, "ROUNDS", 1)
    r = random.Random(seed)
    rows = [((0, f"p{i:03}"), f"a{r.randint(0, 60)}", f"b{r.randint(0, 60)}") for i in range(120)]
    kept, seen = [], set()
    for o, a, b in rows:
        if not {a, b} & seen:
            kept.append(o)
            seen |= {a, b}
    df = spark.createDataFrame(rows, "o struct<s: int, p: string>, a string, b string").repartition(3)
    assert sorted(tuple(x.o) for x in dedup.two_keys(df, "a", "b", "o").collect()) == kept


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 30)] + [(100, 101), (101, 100), (102, 102), (None, 1), (103, 30)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**dict.fromkeys([*range(31), 103], 0), 100: 100, 101: 100}


def test_scratch_is_deleted(spark):
    import os

    def paths(df):
        return [p for p in df.inputFiles() if os.path.exists(p.removeprefix("file://"))]

    with state.scoped(spark) as scope:
        inner = state.staged(spark.range(3))
        kept = scope.keep(inner.filter("id > 0"))
        assert paths(inner) and paths(kept)
    assert not os.path.exists(inner._staged_at.removeprefix("file:")) and kept.count() == 2
    state.unstaged(kept)
    assert not os.path.exists(kept._staged_at.removeprefix("file:"))
    with pytest.raises(ZeroDivisionError), state.scoped(spark):
        gone = state.staged(spark.range(3))
        1 / 0
    assert not os.path.exists(gone._staged_at.removeprefix("file:"))


def test_save_batch(spark, tmp_path):
    path = str(tmp_path / "t")
    df = dedup.with_fingerprint(spark.createDataFrame([(1, "https://a.com/x/"), (2, "HTTPS://A.com/x"), (3, "https://b.com")], "o long, u string"), "u")
    assert dedup.save_batch(df, path, "o", dry_run=True) == (2, 1)
    assert state.read_or_none(spark, path) is None
    assert dedup.save_batch(df, path, "o") == (2, 1)
    assert dedup.save_batch(df, path, "o") == (0, 3)
    assert spark.read.parquet(path).count() == 2


def test_versioned_table(spark, tmp_path):
    t = state.VersionedTable(spark, str(tmp_path / "v"))
    assert t.read() is None and t.delete("k = 1") == 0
    t.upsert(spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"), "k")
    t.upsert(spark.createDataFrame([(2, "c"), (3, "d")], "k int, v string"), "k")
    t.upsert(spark.createDataFrame([(4, None)], "k int, v string"), "k")
    assert sorted(tuple(r) for r in t.read().collect()) == [(1, "a"), (2, "c"), (3, "d"), (4, None)]
    assert len(t.versions()) == 2 and t.delete("v = 'c'") == 1 and t.read().count() == 3


def test_checkpoints(spark, tmp_path):
    c = state.Checkpoints(spark, str(tmp_path / "c"))
    assert c.get("jobs", "x") is None and c.all() is None
    c.save("jobs", "x", processed=5, cursor="7", status="interrupted")
    c.save("news", "y", status="completed")
    assert c.resume("jobs", "x").cursor == "7" and c.resume("news", "y") is None
    c.save("jobs", "x", processed=9)
    assert c.get("jobs", "x").processed == 9 and c.all().count() == 2
    assert c.reset("jobs") == 1 and c.reset() == 1


def test_sets_and_latest(spark):
    held = spark.createDataFrame([(1, ["b"]), (2, None)], "k int, xs array<string>")
    add = spark.createDataFrame([(1, " a "), (1, "b"), (2, " "), (2, "c"), (9, "z")], "k int, x string")
    assert sorted((r.k, r.xs) for r in state.added_to_set(held, add, "k", "xs", "x").collect()) == [(1, ["b", "a"]), (2, ["c"])]
    rows = spark.createDataFrame([(1, 5, "x"), (1, 7, "y"), (2, 1, "z")], "k int, o int, v string")
    assert sorted(tuple(r) for r in state.latest(rows, "k", "o").collect()) == [(1, 7, "y"), (2, 1, "z")]
    assert [r.rows for r in state.violations(rows, "k").collect()] == [2]


# ---- resolution -------------------------------------------------------------------------------------------------------


def plain_match(raw, entities):
    """The stages in order over all entities, as (id, method, confidence)."""
    from tessera.functions.text import comparable

    norm = comparable(raw)
    for ok, method, sure in (
        (lambda n, a: raw == n, "exact", 1.0), (lambda n, a: raw in [x.strip() for x in a], "alias", 0.9),
        (lambda n, a: norm and norm == comparable(n), "normalized", 0.95), (lambda n, a: norm and norm in map(comparable, a), "alias", 0.9),
    ):
        for i, n, a in entities:
            if ok(n, a):
                return i, method, sure
    best = sorted((-round(max(resolve.similarity(norm, comparable(x)) for x in [n, *a]), 2), i) for i, n, a in entities)
    best = [b for b in best if -b[0] >= 0.8]
    if not best or (len(best) > 1 and -best[0][0] + best[1][0] < 0.03):
        return f"unresolved_{norm or 'entity'}", "unresolved", 0.0
    return best[0][1], "fuzzy", -best[0][0]


@pytest.mark.parametrize("extra", [0, 12])
def test_resolve(spark, extra):
    more = [(f"z{i:02}", f"Company number {i} of many", []) for i in range(extra)]
    ents = sorted([(i, n, a) for i, n, _, a, _ in resolve.SEED] + more)
    names = ["OpenAI", "Open AI", "OPENAI", "openai.com", "OpenAI, Inc.", "https://github.com/openai", "Anthropc", "Deep Mind", "microsft", "!!!", "Acme", " OpenAI ", "", None, "Company number 3 of man"]
    df = spark.createDataFrame([(n, "u") for n in names], "raw_name string, source_url string")
    dim = spark.createDataFrame(ents, "canonical_id string, canonical_name string, aliases array<string>")
    got = {r.raw_name: (r.canonical_id, r.match_method, round(r.confidence, 4)) for r in resolve.resolve(df, dim).collect()}
    want = {n.strip(): plain_match(n.strip(), ents) for n in names if n and n.strip()}
    assert got == {k: (a, b, round(c, 4)) for k, (a, b, c) in want.items()}


def blocked_match(raw, entities):
    """The similarity stage over the entities that share a blocking key, or all if none does, pair by pair."""
    from tessera.functions.text import comparable

    def keys(n):
        words = n.split(" ")
        return {f"tok:{words[0]}", f"len:{len(words)}", *([f"pref:{n[:3]}"] if len(n) >= 3 else [])} if n else set()

    norm = comparable(raw)
    near = [e for e in entities if any(keys(norm) & keys(comparable(x)) for x in [e[1], *e[2]])]
    return plain_match(raw, near or entities)


@pytest.mark.parametrize("seed", range(2))
def test_resolve_against_all_pairs(spark, seed):
    """Random misspelt names: what the search keys leave out could not score enough."""
    r = random.Random(seed)
    syllables = ["ka", "ro", "mi", "ten", "lab", "ai", "so", "ft", "a", "zu", "net", "co"]
    word = lambda: "".join(r.choice(syllables) for _ in range(r.randint(1, 3)))
    ents = sorted({f"e{i:03}": (f"e{i:03}", " ".join(word() for _ in range(r.randint(1, 3))), [word()] * (r.random() < 0.2)) for i in range(60)}.values())

    def spoilt(n):
        n = list(n)
        for _ in range(r.randint(0, 3)):
            k, at = r.random(), r.randrange(len(n) + 1)
            if k < 0.4 and n:
                n.pop(min(at, len(n) - 1))
            elif k < 0.7:
                n.insert(at, r.choice("abeiors "))
            else:
                n = list(" ".join(r.sample("".join(n).split(), len("".join(n).split()))))
        return "".join(n).strip() or "x"

    names = sorted({spoilt(r.choice(ents)[1]) for _ in range(250)} | {"ab", "abc", "ac", "a b c d e", "kaka zu ai net"})
    df = spark.createDataFrame([(n, "u") for n in names], "raw_name string, source_url string")
    dim = spark.createDataFrame(ents, "canonical_id string, canonical_name string, aliases array<string>")
    got = {x.raw_name: (x.canonical_id, x.match_method, round(x.confidence, 4)) for x in resolve.resolve(df, dim).collect()}
    want = {n: blocked_match(n, ents) for n in {" ".join(n.split("\t")).strip() for n in names}}
    bad = {n: (got[n], want[n]) for n in want if got[n] != (want[n][0], want[n][1], round(want[n][2], 4)) and want[n][1] not in ("exact", "alias", "normalized")}
    assert not bad and sum(w[1] == "fuzzy" for w in want.values()) > 20


def one_by_one(names, entities):
    """Names in order, each an alias of its entity for those after it."""
    held, out = [(i, n, list(a)) for i, n, a in entities], {}
    for n in names:
        found = plain_match(n, held) if len(held) <= resolve.FEW else blocked_match(n, held)
        out[n] = (found[0], found[1], round(found[2], 4))
        for i, _, aliases in held:
            if i == found[0] and n not in aliases:
                aliases.append(n)
    return out


@pytest.mark.parametrize("extra", [0, 14])
def test_names_in_order_are_as_one_by_one(spark, extra):
    """A chain of 10 aliases of which each needs the one before, the same chain backwards, and misspelt names in any order."""
    import hashlib

    r = random.Random(extra)
    letters = lambda x: hashlib.md5(x.encode()).hexdigest() + hashlib.md5(b"2" + x.encode()).hexdigest()
    chain = lambda x: [letters(x)[3 * i : 3 * i + 20] for i in range(11)]
    up, down = chain("up"), chain("down")
    ents = [("a", up[0], []), ("b", down[0], []), ("c", "Kamiten Labor", ["Kami Labs"])] + [(f"z{i:02}", f"{letters(str(i))[:9]} {letters(str(i))[40:46]}", []) for i in range(extra)]
    spoilt = lambda n: "".join(c for c in n if r.random() > 0.07) + r.choice(["", "", " x", " labs"])
    others = list(dict.fromkeys(spoilt(r.choice(ents)[1]) for _ in range(40)))
    names = up[1:] + others[:20] + down[:0:-1] + others[20:]
    names = [n for i, n in enumerate(names) if n.strip() == n and n not in names[:i]]
    df = spark.createDataFrame([(n, "u", i) for i, n in enumerate(names)] + [(names[0], "v", 99)], "raw_name string, source_url string, place int")
    dim = spark.createDataFrame(ents, "canonical_id string, canonical_name string, aliases array<string>")
    got = {x.raw_name: (x.canonical_id, x.match_method, round(x.confidence, 4)) for x in resolve.resolve_in_order(df, dim, "place").collect()}
    want = one_by_one(names, ents)
    same = lambda x: x if x[1] == "fuzzy" else (x[0], x[1] in ("exact", "alias", "normalized"))
    assert {n: (same(got[n]), same(want[n])) for n in want if same(got[n]) != same(want[n])} == {} and set(got) == set(want)
    assert all(want[n][0] == "a" for n in up[1:]) and sum(want[n][0] == "b" for n in down[1:]) == 1


def test_letters_bound_is_never_too_low(spark):
    """Pairs that the bound drops cannot score; it drops most of the others."""
    r = random.Random(8)
    word = lambda: "".join(r.choice("abcdeilmnorst") for _ in range(r.randint(1, 9)))
    rows = []
    for i in range(3000):
        a = " ".join(word() for _ in range(r.randint(1, 3)))
        b = "".join(c for c in a if r.random() > 0.15) if i % 3 == 0 else " ".join(r.sample(a.split(), 1)) if i % 7 == 0 else " ".join(word() for _ in range(r.randint(1, 3)))
        rows.append((i, a, " ".join(b.split())))
    df = spark.createDataFrame(rows, "i int, a string, b string")
    may = {x.i: x.may for x in df.select("i", resolve.may_reach(F.col("a"), F.col("b"), resolve.FUZZY).alias("may")).collect()}
    enough = {i for i, a, b in rows if round(resolve.similarity(a, b), 2) >= resolve.FUZZY}
    assert len(enough) > 300 and all(may[i] for i in enough)
    assert sum(may.values()) < 1.5 * len(enough), "of two pairs that cannot match, most stay out of Python"


def test_plain_names_stay_in_columns(spark):
    from tessera.functions.text import with_comparable

    df = spark.createDataFrame([("Acme, Inc.",), ("ﬁne ½",), (None,), ("Café",)], "v string")
    done = with_comparable(df, F.col("v"), "n")
    assert sorted((r.v, r.n) for r in done.collect() if r.v) == [("Acme, Inc.", "acme"), ("Café", "cafe"), ("ﬁne ½", "fine 1 2")]
    plan = with_comparable(df, F.col("v"), "n")._jdf.queryExecution().optimizedPlan().toString()
    left, right = plan.split("+- ")[0], plan
    assert right.count("ArrowEvalPython") == 1 and "Union" in left


@pytest.mark.parametrize("least", [resolve.FUZZY, resolve.NEAR])
def test_names_that_are_near_share_a_key(spark, least):
    r = random.Random(7)
    near = lambda s: "".join(r.choice(["", c, c, c, c, c, c, c, c + "x", "y"]) for c in s).strip()
    long_ = ["".join(r.choice("abcdefgh ") for _ in range(r.choice([26, 40, 61]))).strip() for _ in range(12)]
    short = ["".join(r.choice("ab1") for _ in range(r.randint(1, 7))) for _ in range(40)]
    plain = [f"maker {k} {w}" for k in (1, 12, 123, 1234, 21, 4321) for w in ("one", "on", "other")] + [f"maker {k}" for k in (1, 12, 123, 1234)] + ["\U0001f600 ab", "\U0001f600 abc"]
    names = sorted({" ".join(x.split()) for x in [*long_, *map(near, long_), *short, *plain] if x.strip()})
    keys = {x.s: (set(), set()) for x in spark.createDataFrame([(n,) for n in names], "s string").collect()}
    rows = spark.createDataFrame([(n, True, True) for n in names], "s string, is_own boolean, is_other boolean")
    for x in resolve._search_keys(rows, least).collect():
        keys[x.s][0].update(x.own)
        keys[x.s][1].update(x.other)
    enough = [(a, b) for a in names for b in names if round(resolve.similarity(a, b), 2) >= least]
    assert len(enough) > len(names) and [p for p in enough if not keys[p[0]][0] & keys[p[1]][1]] == []


def test_both_ends_find_every_loss():
    """Whatever letters two names lack of each other, and wherever, one of the ways has a choice of both."""
    import numpy as np

    r = random.Random(5)
    way = lambda s, m, more, front: set(resolve._chosen(np.array([[ord(c) for c in s]], dtype=np.uint64), m, more, front, 0)[0])
    seen = 0
    for _ in range(1500):
        a, b = r.randint(14, 26), r.randint(14, 26)
        ends = resolve.at_ends(a, b, resolve.FUZZY)
        if ends is None:
            continue
        seen += 1
        common = [r.choice("0123456789abcdef") for _ in range(resolve.least_matched(a, b, resolve.FUZZY))]

        def grown(n, letter, common=common):
            out, where = list(common), r.choice([lambda k: 0, lambda k: k, lambda k: r.randint(0, k), lambda k: r.choice([0, k]), lambda k: k // 2])
            while len(out) < n:
                out.insert(where(len(out)), letter)
            return "".join(out)

        x, y = grown(a, "x"), grown(b, "y")
        assert any(way(x, ends[0], i, front) & way(y, ends[0], j, front) for front, i, j in ends[1]), (x, y)
    assert seen > 300


def test_names_of_any_letters_have_few_keys(spark):
    """Names that differ at both ends are sought by both: under 100 keys each, not 495, and what is near still shares one."""
    r = random.Random(6)
    letters = lambda n: "".join(r.choice("0123456789abcdef") for _ in range(n))
    names = {letters(20) for _ in range(30)} | {h[3 * i : 3 * i + 20] for h in (letters(40) for _ in range(10)) for i in range(5)}
    for n in sorted(names):
        left = [c for k, c in enumerate(n) if k not in r.sample(range(20), 3)]
        for _ in range(3):
            left.insert(r.randrange(len(left) + 1), r.choice("0123456789abcdef"))
        names.add("".join(left)[:20].ljust(20, "0"))
    rows = spark.createDataFrame([(n, True, True) for n in sorted(names)], "s string, is_own boolean, is_other boolean")
    keys = {n: (set(), set()) for n in names}
    for x in resolve._search_keys(rows).collect():
        keys[x.s][0].update(x.own)
        keys[x.s][1].update(x.other)
    enough = [(a, b) for a in names for b in names if a != b and round(resolve.similarity(a, b), 2) >= resolve.FUZZY]
    assert len(enough) > 60 and [p for p in enough if not keys[p[0]][0] & keys[p[1]][1]] == []
    assert max(len(own) for own, _ in keys.values()) < 100


def test_candidates_grow_with_the_names(spark):
    """Names that have most letters in common are not paired all with all: twice the names, about twice the pairs."""

    def pairs(n):
        names = spark.range(1000, 1000 + n).select(F.concat(F.lit("maker "), "id").alias("raw_name"), F.concat(F.lit("maker "), "id").alias("norm"))
        dim = spark.range(1000, 1000 + n).select(F.col("id").cast("string").alias("canonical_id"), F.concat(F.lit("Maker "), "id", F.lit(" one")).alias("canonical_name"), F.array(F.concat(F.lit("maker "), "id", F.lit(" one"))).alias("norms"))
        return resolve.candidate_pairs(names, dim).count()

    few, more = pairs(150), pairs(600)
    assert few >= 150 and more < 8 * few


def test_best_of_many_alike(spark):
    """With a chooser all candidates of an ambiguous name down to 0.80 are given, without one the verdict is the same."""
    from tessera.functions.text import comparable

    ents = [(f"e{k}", f"Maker {k} one", []) for k in range(100, 160)] + [("twin", "Maker 101 one!", [])]
    dim = spark.createDataFrame(ents, "canonical_id string, canonical_name string, aliases array<string>")
    names = spark.createDataFrame([(f"Maker {k} on", None) for k in range(100, 160)], "raw_name string, source_url string")
    seen = resolve.resolve(names, dim, chooser=lambda name, options: (options[-1]["canonical_id"], float(len(options))))
    plain = {x.raw_name: (x.canonical_id, x.match_method) for x in resolve.resolve(names, dim).collect()}
    assert plain["Maker 101 on"][1] == "unresolved" and all(plain[f"Maker {k} on"] == (f"e{k}", "fuzzy") for k in range(102, 160))
    asked = {x.raw_name: x for x in seen.collect()}
    best = [i for i, n, _ in ents if round(resolve.similarity("maker 101 on", comparable(n)), 2) >= resolve.FUZZY]
    assert asked["Maker 101 on"].match_method == "llm" and asked["Maker 101 on"].confidence == len(best) > 2


def test_resolve_by_hundredths(spark):
    """0.96 and 0.93 are 0.03 apart in hundredths, though not in binary."""
    ents = [(f"e{k}", f"Maker {k} one", []) for k in range(5000, 5012)] + [("f", "Maker 50001 one", [])]
    dim = spark.createDataFrame(ents, "canonical_id string, canonical_name string, aliases array<string>")
    names = spark.createDataFrame([(f"Maker {k} on", None) for k in (5000, 5001)], "raw_name string, source_url string")
    got = lambda **more: {x.raw_name: (x.canonical_id, x.match_method, x.confidence) for x in resolve.resolve(names, dim, **more).collect()}
    assert round(resolve.similarity("maker 5000 on", "maker 5000 one"), 2) == 0.96 and round(resolve.similarity("maker 5000 on", "maker 50001 one"), 2) == 0.93
    exact = got(hundredths=True)
    assert exact["Maker 5000 on"] == ("e5000", "fuzzy", 0.96) and exact["Maker 5001 on"] == ("e5001", "fuzzy", 0.96)
    assert got()["Maker 5000 on"][1] == "unresolved"


def test_resolve_keeps_and_refreshes(spark):
    dim = resolve.seeds(spark)
    names = spark.createDataFrame([("Acme", "u"), ("OpenAI", "u")], "raw_name string, source_url string")
    first = state.staged(resolve.resolve(names, dim))
    wider = dim.unionByName(spark.createDataFrame([("acme", "Acme", "STARTUP", [], [])], resolve.ENTITY))
    kept = {r.raw_name: r.match_method for r in resolve.resolve(names, wider, first).collect()}
    assert kept == {"Acme": "unresolved", "OpenAI": "exact"}
    again = {r.raw_name: r.match_method for r in resolve.resolve(names, wider, first, refresh_unresolved=True).collect()}
    assert again == {"Acme": "exact", "OpenAI": "exact"}
    grown = resolve.with_new_aliases(wider, resolve.resolve(spark.createDataFrame([("Anthropc", "u")], "raw_name string, source_url string"), wider))
    assert "Anthropc" in grown.filter("canonical_id = 'ent_anthropic_001'").first().aliases
    assert [r.canonical_id for r in resolve.find_by_name(wider, "openai inc").collect()] == ["ent_openai_001"]
    assert resolve.with_seeds(wider, spark).count() == 5 and resolve.with_seeds(None, spark).count() == 4


def test_chooser(spark):
    dim = spark.createDataFrame([("a", "alpha systems one", []), ("b", "alpha systems two", [])], "canonical_id string, canonical_name string, aliases array<string>")
    names = spark.createDataFrame([("alpha systems", "u")], "raw_name string, source_url string")
    pick = lambda choice: resolve.resolve(names, dim, chooser=choice).first()
    assert pick(None).match_method == "unresolved"
    got = pick(lambda name, options: (options[1]["canonical_id"], 0.7))
    assert (got.match_method, got.canonical_id, got.confidence) == ("llm", "b", 0.7)
    assert pick(lambda name, options: ("other", 1.0)).match_method == "unresolved"
    assert pick(lambda name, options: 1 / 0).match_method == "unresolved"


def test_attach_and_iterate(spark):
    dim = resolve.seeds(spark)
    names = spark.createDataFrame([("OpenAI", None), ("Anthropc", None)], "raw_name string, source_url string")
    m = state.staged(resolve.resolve_in_order(names, dim, "raw_name"))
    rows = spark.createDataFrame([(1, " OpenAI "), (2, "none")], "k int, company string")
    got = {r.k: (r.canonical_id, r.resolution_match_method) for r in resolve.attach(rows, m, "company").collect()}
    assert got == {1: ("ent_openai_001", "exact"), 2: (None, None)}
    assert {r.match_method: r.n for r in resolve.method_counts(m).collect()} == {"exact": 1, "fuzzy": 1}


# ---- quality and export -----------------------------------------------------------------------------------------------

GOOD = {
    "startup": {"source_name": "s", "source_url": "https://a.com", "entityName": "A", "employeeCount": "50", "collectedAt": "2024-01-01T00:00:00Z"},
    "product": {"source_name": "s", "source_url": "https://a.com", "startupName": "A", "pricingModel": "FREE", "collectedAt": "1700000000"},
    "paper": {"title": "T", "paper_url": "https://a.com", "github_stars": "50.0", "published_date": "2024-01-01", "collectedAt": "2024-01-01"},
    "news": {"source_name": "s", "source_url": "https://a.com", "title": "T", "url": "https://b.com", "published_date": "2024-01-01", "collectedAt": "2024-01-01"},
    "job": {"company": "C", "date": "2024-01-01", "is_remote": "yes", "collectedAt": "2024-01-01"},
    "mapping": {"raw_name": "r", "normalized_name": "n", "canonical_name": "c", "canonical_id": "i", "match_method": "exact", "confidence": "1.0", "timestamp": "2024-01-01"},
}
BAD = [
    ("startup", "recordType", "JOB"), ("startup", "source_url", "x"), ("startup", "employeeCount", "abc"), ("startup", "employeeCount", "-1"), ("startup", "employeeCount", "50.5"), ("startup", "entityName", "  "), ("startup", "collectedAt", "bad"),
    ("product", "pricingModel", "CHEAP"), ("product", "startupName", None), ("paper", "title", ""), ("paper", "github_url", "x"), ("paper", "github_stars", "abc"), ("paper", "published_date", "bad"),
    ("news", "url", "x"), ("news", "source_name", None), ("job", "is_remote", "maybe"), ("job", "is_remote", None), ("job", "date", "bad"), ("job", "company", None),
    ("mapping", "confidence", "1.1"), ("mapping", "confidence", "high"), ("mapping", "match_method", "guess"), ("mapping", "source_url", "x"), ("mapping", "raw_name", None),
]
OK = [("startup", "employeeCount", None), ("startup", "employeeCount", "0"), ("product", "pricingModel", None), ("job", "is_remote", "0"), ("mapping", "confidence", "0"), ("mapping", "source_url", None), ("paper", "github_url", "https://github.com/a/b")]


@pytest.mark.parametrize("kind", list(GOOD))
def test_constraints(spark, kind):
    bad = [{**GOOD[kind], n: v} for k, n, v in BAD if k == kind]
    good = [GOOD[kind], *({**GOOD[kind], n: v} for k, n, v in OK if k == kind)]
    names = sorted({n for r in bad + good for n in r})
    df = spark.createDataFrame([tuple(r.get(n) for n in names) for r in good + bad], ", ".join(f"{n} string" for n in names))
    a, b = quality.split(df, kind)
    assert a.count() == len(good) and [len(r.errors) for r in b.collect()] == [1] * len(bad)


def test_reports(spark):
    t = spark.createDataFrame([("a", "u", []), ("a", "", ["x"]), (None, None, [])], "k string, source_url string, errors array<string>")
    r = quality.quality_report({"t": t}, {"t": "k"}).first()
    assert (r.total, r.valid, r.invalid, r.missing_url, r.duplicates) == (3, 2, 1, 2, 1)
    assert quality.verdict(quality.quality_report({"t": t})).first().status == "FAIL"
    assert quality.verdict(quality.quality_report({"t": t.limit(0)})).first().status == "PASS"
    s, p, c = quality.audited(spark.createDataFrame([("Acme Inc", 5, "u"), ("X", None, "u")], "entity_name string, employee_count int, source_url string"), spark.createDataFrame([("a", "FREE", "https://g/awesome list"), ("b", "PAID", None)], "startup_name string, pricing_model string, source_url string"))
    assert tuple(c.first()) == (2, 1, 1, 1, 2, 1, 1, 1, 1) and s.count() == p.count() == 2


def test_export(spark, tmp_path):
    jobs = spark.createDataFrame([("C", True, "u"), ("D", None, "=1+1"), (None, False, "u")], "company string, is_remote boolean, url string")
    rows = [tuple(r)[:5] for r in export.rows(jobs, "job").collect()]
    assert rows == [("C", "", "True", "", "u"), ("D", "", "", "", "=1+1")]
    assert [h for h in export.rows(jobs, "jobs").columns] == export.HEADERS["jobs"]
    got = export.export({"jobs": jobs}, str(tmp_path))
    assert [(r.sheet, r.queried, r.written, r.skipped, r.status) for r in got] == [("jobs", 3, 2, 1, "written")]
    back = spark.read.option("header", True).csv(str(tmp_path / "jobs"))
    assert back.columns == export.HEADERS["jobs"] and sorted(r.url for r in back.collect()) == ["'=1+1", "u"]
    assert export.export({"jobs": jobs}, None)[0].status == "not_configured"
    assert export.export({"jobs": jobs}, None, dry_run=True)[0].written == 0
    assert export.export({"jobs": jobs}, str(tmp_path), only="news") == []
    with pytest.raises(ValueError, match="unknown vertical"):
        export.vertical("x")
    assert tuple(export.telemetry({"jobs": jobs}).first()) == ("jobs", 3, 2, 1)


def test_layout_and_quota(spark, tmp_path):
    import json

    assert [export.column_letter(n) for n in (1, 26, 27, 52, 53, 702, 703)] == ["A", "Z", "AA", "AZ", "BA", "ZZ", "AAA"]
    jobs = spark.createDataFrame([("C", "u"), (None, "u")], "company string, url string")
    export.export({"jobs": jobs}, str(tmp_path))
    shown = json.loads(spark.read.text(str(tmp_path / "layouts" / "jobs")).first().value)
    assert (shown["frozen_rows"], shown["bold"], shown["filter"]) == (1, "A1:H1", "A1:H2") and len(shown["autosize"]) == 8
    waits, tries = [], []

    def busy():
        tries.append(1)
        if len(tries) < 4:
            raise OSError("HTTP 429: quota exceeded")
        return "done"

    assert export.put(busy, waits.append) == "done" and [int(w) for w in waits] == [1, 2, 4]
    tries.clear()
    with pytest.raises(RuntimeError, match=r"Bearer \[REDACTED\]"):
        export.put(lambda: tries.append(1) or (_ for _ in ()).throw(OSError("denied: bearer abc.def")), waits.append)
    assert len(tries) == 1
    with pytest.raises(RuntimeError, match="429"):
        export.put(lambda: tries.append(1) or (_ for _ in ()).throw(OSError("429")), lambda s: None)
    assert len(tries) == 6


def test_retrying_and_logs():
    import io
    import json

    from tessera import logs
    from tessera.retry import retrying

    waits, calls = [], []

    @retrying(4, 1.0, 3.0, sleep=waits.append, when=lambda e: isinstance(e, OSError))
    def call(kind):
        calls.append(kind)
        raise kind("x")

    with pytest.raises(OSError):
        call(OSError)
    with pytest.raises(KeyError):
        call(KeyError)
    assert waits == [1.0, 2.0, 3.0] and len(calls) == 5
    out = io.StringIO()
    logs.set_up("warning", out)
    logs.event("x", "quiet")
    logs.event("x", "loud", 30, n=3)
    assert [(r["event"], r["level"], r["logger"], r["n"]) for r in map(json.loads, out.getvalue().splitlines())] == [("loud", "warning", "tessera.x", 3)]
    logs.set_up("nonsense", out)
    logs.event("x", "heard")
    assert "heard" in out.getvalue()


# ---- fan-in and crawl -------------------------------------------------------------------------------------------------


def test_fan_in(spark):
    make = lambda n: spark.range(n).select(F.col("id").alias("ord"))
    got = [(r.source_key, r.ord) for r in fanin.fan_in({"a": make(10), "b": make(1), "c": make(10)}, 7).collect()]
    assert got == [("a", 0), ("a", 1), ("a", 2), ("b", 0), ("c", 0), ("c", 1), ("c", 2)]
    assert [r.ord for r in fanin.sliced(make(5), 2, 4).collect()] == [4] and fanin.sliced(make(5), 2, 9).collect() == []
    assert fanin.share(12, 5) == 3 and fanin.share(3, 8, 5) == 5


def answers(url, headers, timeout):
    if "boom" in url:
        raise OSError("no route")
    code = int(url.rsplit("/", 1)[1])
    return code, "ok é" if code < 400 else None, "text/html", 0.0


def test_crawl(spark):
    policy = crawl.CrawlPolicy(backoff_base=0.0, jitter=False, retries=3)
    urls = ["http://a/200", "http://a/404", "http://b/503", "http://c/boom", "http://a/418", "http://a/200", "http://b/429"]
    df = spark.createDataFrame(list(enumerate(urls)), "ord long, url string")
    got = {r.ord: r for r in crawl.fetch(df, policy, answers).collect()}
    assert {i: (r.status_code, r.attempts, r.success) for i, r in got.items()} == {0: (200, 1, True), 1: (404, 1, False), 2: (503, 3, False), 3: (None, 3, False), 4: (418, 1, False), 5: (200, 1, True), 6: (429, 3, False)}
    assert {i: r.error_class for i, r in got.items()} == {0: None, 1: "http", 2: "http", 3: "connection", 4: "http", 5: None, 6: "rate_limit"}
    assert got[3].error == "OSError: no route" and got[0].fingerprint == got[5].fingerprint
    cache = state.staged(crawl.fetch(df, policy, answers))
    again = crawl.fetch(df, policy, lambda *a: (500, None, None, None), cache)
    assert {r.ord for r in again.filter("success").collect()} == {0, 5}
    assert tuple(crawl.summary(cache).first()) == (7, 2, 5, 10)


def test_error_classes():
    import urllib.error

    kinds = [TimeoutError("x"), urllib.error.URLError(TimeoutError("timed out")), urllib.error.URLError("refused"), ConnectionResetError("x"), ValueError("x")]
    assert [crawl.error_class(None, e) for e in kinds] == ["timeout", "timeout", "connection", "connection", "other"]
    assert [crawl.error_class(s) for s in (200, 301, 404, 429, 500, None)] == [None, None, "http", "rate_limit", "http", None]


def test_hosts_do_not_wait_for_one_another(spark):
    import time

    def slow(url, headers, timeout):
        time.sleep(0.3)
        return 200, "x", None, None

    urls = spark.createDataFrame([(i, f"http://h{i}/") for i in range(12)], "ord long, url string")
    began = time.perf_counter()
    assert crawl.fetch(urls, crawl.CrawlPolicy(concurrency=12), slow).filter("success").count() == 12
    assert time.perf_counter() - began < 12 * 0.3 + 2


def test_policy():
    waits = []
    crawl.fetch_one("http://h/429", crawl.CrawlPolicy(jitter=False), lambda *a: (429, None, None, 9.0), waits.append)
    assert waits == [9.0, 9.0]
    seen = []
    crawl.fetch_one("http://other/", crawl.CrawlPolicy(token="t"), lambda u, h, t: seen.append(h) or (200, "", None, None))
    crawl.fetch_one("https://api.github.com/x", crawl.CrawlPolicy(token="t"), lambda u, h, t: seen.append(h) or (200, "", None, None))
    assert seen == [{}, {"Authorization": "Bearer t"}]
    assert crawl.fetch_one("http://x.org/", crawl.CrawlPolicy(allowed_domains=("a.com",)), None)["error"] == "domain not allowed"
    with pytest.raises(ValueError):
        crawl.CrawlPolicy(concurrency=0)


def test_find_by_names(spark):
    from tessera.functions.text import comparable

    entities = spark.createDataFrame([("e1", "Acme, Inc."), ("e2", "ACME"), ("e3", "Ünal GmbH"), ("e4", "???"), ("e5", None), ("e1", "Acme, Inc.")], "canonical_id string, canonical_name string")
    asked = ["acme", "Acme Inc", "ünal", "!!!", "???", None, "", "nobody", "acme"]
    names = spark.createDataFrame([(i, n) for i, n in enumerate(asked)], "row int, name string")
    got = sorted((r.row, r.canonical_id or "") for r in resolve.find_by_names(names, entities, "name").collect())
    want = []
    for i, n in enumerate(asked):
        hits = {r.canonical_id for r in entities.collect() if n is not None and r.canonical_name is not None and (r.canonical_name == n or comparable(n) == comparable(r.canonical_name) != "")}
        want += [(i, h) for h in hits or {""}]
    assert got == sorted(want) and (0, "e1") in got and (0, "e2") in got and (4, "e4") in got and (3, "") in got
    assert resolve.find_by_names(names.limit(0), entities, "name").count() == 0
    assert resolve.find_by_names(names, entities.limit(0), "name").filter("canonical_id is not null").count() == 0
