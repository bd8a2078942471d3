"""Entity resolution: distinct raw names against a snapshot of canonical entities, in stages of falling certainty.

exact name (1.0), alias (0.90), comparable name (0.95), comparable alias (0.90): equi joins. Then, for what is left, the
similarity of names that share a blocking key, 0.80 or more; two best ones closer than 0.03 are ambiguous and go to a
chooser, if there is one. `resolve` takes names against the snapshot, whatever their order; their aliases are added afterwards.
`resolve_in_order` gives what taking them one by one does, where every name that is resolved is an alias for those after it.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from difflib import SequenceMatcher
from functools import lru_cache
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from tessera.functions.basic import filled, strip
from tessera.functions.text import blocking_keys, comparable, with_comparable
from tessera.operators.fanin import numbered
from tessera.operators.state import added_to_set, staged, upserted

FUZZY, DELTA = 0.80, 0.03
#: Names are sought down to this similarity first: the best of a name that has one of NEAR + DELTA or more is told by that.
NEAR = 0.92
#: Choices of letters a name and length of a partner, at most, and fewest letters of a choice that says enough.
MOST_KEYS, LEAST_LETTERS = 500, 6
#: The same where both ends of names are sought.
MOST_AT_ENDS = 350
#: With so many entities or fewer, every name is compared with each.
FEW = 10
ENTITY = "canonical_id string, canonical_name string, entity_type string, aliases array<string>, source_urls array<string>"
MAPPING = ["raw_name", "normalized_name", "canonical_name", "canonical_id", "match_method", "confidence", "source_url"]

# The seed entities and their spellings.
SEED = [
    ("ent_openai_001", "OpenAI", "STARTUP", ["Open AI", "OpenAI Inc.", "OpenAI, Inc.", "openai.com"], ["https://github.com/openai", "https://openai.com"]),
    ("ent_anthropic_001", "Anthropic", "STARTUP", ["Anthropic PBC", "anthropic.com"], ["https://github.com/anthropic", "https://anthropic.com"]),
    ("ent_deepmind_001", "Google DeepMind", "ORGANIZATION", ["DeepMind", "DeepMind Labs", "google deepmind"], ["https://deepmind.google"]),
    ("ent_microsoft_001", "Microsoft", "COMPANY", ["Microsoft Corporation", "microsoft.com"], ["https://github.com/microsoft", "https://microsoft.com"]),
]


def similarity(a: str, b: str) -> float:
    """Ratio of matching blocks; equal sets of words give 1, a subset 0.85 and a tenth of its share of the larger set."""
    if not a or not b:
        return 0.0
    x, y = set(a.split()), set(b.split())
    if a == b or (x and x == y):
        return 1.0
    ratio = SequenceMatcher(None, a, b).ratio()
    return max(ratio, 0.85 + 0.10 * len(x & y) / max(len(x), len(y))) if x and y and (x <= y or y <= x) else ratio


@F.pandas_udf(DoubleType())
def best_score(name: pd.Series, others: pd.Series) -> pd.Series:
    """The best similarity of a name to one of a list, to two places of its binary value."""
    return pd.Series([round(max((similarity(n or "", o or "") for o in os), default=0.0), 2) for n, os in zip(name, others, strict=True)], dtype="float64")


def seeds(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(SEED, ENTITY)


def prepared(entities: DataFrame) -> DataFrame:
    """Entities with their comparable names: canonical_id, canonical_name, aliases (trimmed), norm, norms (with the aliases')."""
    e = entities.select("canonical_id", "canonical_name", F.transform(F.coalesce("aliases", F.array().cast("array<string>")), strip).alias("aliases"))
    names = with_comparable(staged(e.select("canonical_id", F.explode(F.concat(F.array("canonical_name"), "aliases")).alias("name"))), F.col("name"), "n")
    norms = names.groupBy("canonical_id").agg(F.collect_set("n").alias("norms"))
    return staged(with_comparable(e, F.col("canonical_name"), "norm").join(norms, "canonical_id"))


def equi_stages(names: DataFrame, entities: DataFrame, learned: DataFrame | None = None) -> DataFrame:
    """Of names (raw_name, norm) those that a stage by equality resolves, with canonical_id, canonical_name, method, confidence.

    learned (s, canonical_id, canonical_name, at) are comparable aliases that count for names with a larger `at`.
    """
    alias = with_comparable(staged(entities.select("canonical_id", "canonical_name", F.explode("aliases").alias("alias"))), F.col("alias"), "norm_alias")
    key = lambda df, stage, c: df.select(F.lit(stage).alias("stage"), F.col(c).alias("key"), "canonical_id", "canonical_name").filter("key <> ''")
    keys = key(entities, 1, "canonical_name").unionByName(key(alias, 2, "alias")).unionByName(key(entities, 3, "norm")).unionByName(key(alias, 4, "norm_alias")).distinct()
    at = [c for c in names.columns if c == "at"]
    asked = names.select("raw_name", *at, F.posexplode(F.array("raw_name", "raw_name", "norm", "norm")).alias("i", "key")).select("raw_name", *at, (F.col("i") + 1).alias("stage"), "key")
    if learned is not None:
        keys = keys.withColumn("since", F.lit(-1).cast("long")).unionByName(learned.select(F.lit(4).alias("stage"), F.col("s").alias("key"), "canonical_id", "canonical_name", F.col("at").alias("since")))
    met = asked.join(keys, ["stage", "key"])
    hit = (met if learned is None else met.filter("since < at")).groupBy("raw_name").agg(F.min(F.struct("stage", "canonical_id", "canonical_name")).alias("m"))
    method = F.element_at(F.array(*[F.lit(x) for x in ("exact", "alias", "normalized", "alias")]), F.col("m.stage"))
    sure = F.element_at(F.array(*[F.lit(x) for x in (1.0, 0.90, 0.95, 0.90)]), F.col("m.stage"))
    return hit.select("raw_name", "m.canonical_id", "m.canonical_name", method.alias("match_method"), sure.alias("confidence"))


def least_matched(a: int, b: int, least: float) -> int:
    """Letters that must match for the ratio of names of a and b letters, rounded to two places, to be `least`."""
    return max(1, math.ceil((least - 0.0051) * (a + b) / 2))


@lru_cache(maxsize=None)
def shape(a: int, b: int, least: float) -> tuple[int, int, int] | None:
    """How names of a and b letters are sought: (m, letters of the one that go, of the other); (0, 0, 0): by pairs of letters; None:
    they can't score enough.

    Of the letters that match the last m (or the first) are the same in both, in the same order: of a name that lacks i
    letters at most they are m of its last m + i. m is as large as MOST_KEYS choices of them allow; where that leaves few
    letters, as in long names, a choice says too little.
    """
    matched = least_matched(a, b, least)
    i, j = a - matched, b - matched
    if i < 0 or j < 0:
        return None
    m = matched
    while m and math.comb(m + max(i, j), m) > MOST_KEYS:
        m -= 1
    return (m, i, j) if m >= min(matched, LEAST_LETTERS) else (0, 0, 0)


@lru_cache(maxsize=None)
def at_ends(a: int, b: int, least: float) -> tuple[int, list[tuple[bool, int, int]]] | None:
    """How names of a and b letters are sought by both ends: (m, [(at the first letters, more letters of the one, of the other)]), or
    None if `shape` serves better.

    At either end m of the letters that match are in the first or last m and some more. What goes of a name, i letters of the one
    and j of the other, goes before one end or after the other: where both lose half at most at one end, few choices find them.
    Else the one loses most at one end and the other at the other, and at one of the ends the one loses less than half.
    """
    matched = least_matched(a, b, least)
    i, j, m = a - matched, b - matched, matched // 2
    while m and math.comb(m + j, m) > MOST_AT_ENDS:
        m -= 1
    if i < 0 or j < 0 or m < LEAST_LETTERS:
        return None
    ways = [(first, i // 2, j // 2) for first in (False, True)]
    return m, ways + [(first, i - i // 2 - 1, j) for first in (False, True)] * (i > 0 and j > 0)


@lru_cache(maxsize=256)
def _choices(n: int, m: int) -> np.ndarray:
    return np.array(list(combinations(range(n), m)), dtype=np.intp).reshape(-1, m)


def _chosen(codes: np.ndarray, m: int, more: int, first: bool, tag: int) -> np.ndarray:
    """One number for each choice of m of the last (or first) m + more letters of names of one length: a row a name."""
    n = min(m + more, codes.shape[1])
    part = codes[:, :n] if first else codes[:, codes.shape[1] - n :]
    picked = _choices(n, m)
    with np.errstate(over="ignore"):
        h = np.full((len(codes), len(picked)), tag + 1, dtype=np.uint64)
        for k in range(m):
            h = (h ^ (h >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + part[:, picked[:, k]]
        return (h ^ (h >> np.uint64(32))).view(np.int64)


def _lengths(strings: DataFrame) -> list:
    """A row a length of strings (s, is_own, is_other): n, own, other, first, last (how many beginnings and ends there are)."""
    ends = lambda f: F.approx_count_distinct(f)
    seen = strings.groupBy(F.length("s").alias("n")).agg(F.max("is_own").alias("own"), F.max("is_other").alias("other"), ends(F.substring("s", 1, LEAST_LETTERS)).alias("first"), ends(F.right("s", F.lit(LEAST_LETTERS))).alias("last"))
    return seen.collect()


def _letter_keys(strings: DataFrame, least: float, lengths: list) -> DataFrame:
    """s, own, other (and at, if it is there) for strings (s, is_own, is_other) by the letters that match: by both ends (see `at_ends`)
    where names of a length differ at both about as much, else by the one at which they differ more (see `shape`).

    lengths: those of all strings, of which these may be a part.
    """
    owned, offered = [r["n"] for r in lengths if r["own"]], [r["n"] for r in lengths if r["other"]]
    first = {r["n"]: r["first"] > r["last"] for r in lengths}
    both = {r["n"]: 2 * min(r["first"], r["last"]) >= max(r["first"], r["last"]) for r in lengths}
    at = [c for c in strings.columns if c == "at"]

    def keys(codes: np.ndarray, length: int, own: bool) -> np.ndarray:
        found = []
        for partner in offered if own else owned:
            a, b = (length, partner) if own else (partner, length)
            how, tag = shape(a, b, least), (a << 20) + b
            if how is None or not how[0]:
                continue
            if both[a] and (ends := at_ends(a, b, least)):
                found += [_chosen(codes, ends[0], x if own else y, front, ((k + 1) << 44) + tag) for k, (front, x, y) in enumerate(ends[1])]
            else:
                found.append(_chosen(codes, how[0], how[1] if own else how[2], first[a], tag))
        return np.concatenate(found, axis=1) if found else np.empty((len(codes), 0), dtype=np.int64)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for length, same in batch.groupby(batch["s"].str.len()):
                for start in range(0, len(same), 128):
                    part = same.iloc[start : start + 128]
                    codes = np.frombuffer("".join(part["s"]).encode("utf-32-le"), dtype=np.uint32).reshape(len(part), int(length)).astype(np.uint64)

                    def pick(held: pd.Series, own: bool, codes=codes, length=int(length)) -> list[np.ndarray]:
                        rows = keys(codes, length, own) if held.any() else np.empty((len(codes), 0), dtype=np.int64)
                        return [np.unique(r) if h else r[:0] for r, h in zip(rows, held, strict=True)]

                    yield pd.DataFrame({"s": part["s"].to_numpy(), **{c: part[c].to_numpy() for c in at}, "own": pick(part["is_own"], True), "other": pick(part["is_other"], False)})

    return strings.mapInPandas(run, f"s string, {'at long, ' * len(at)}own array<long>, other array<long>")


def _part_keys(strings: DataFrame, least: float, lengths: list) -> DataFrame:
    """s, own, other for strings (s, is_own, is_other) by pairs of letters, where `shape` has it so, and by words."""
    owned, offered = [r["n"] for r in lengths if r["own"]], [r["n"] for r in lengths if r["other"]]
    own_pairs = [a for a in owned if any(shape(a, b, least) == (0, 0, 0) for b in offered)]
    other_pairs = [b for b in offered if any(shape(a, b, least) == (0, 0, 0) for a in owned)]
    n = F.length("s")
    pairs = strings.filter((F.col("is_own") & n.isin(own_pairs)) | (F.col("is_other") & n.isin(other_pairs))).select("s")
    numbered = lambda parts: F.transform(parts, lambda x, i: F.concat(x, F.lit("\x01"), F.size(F.filter(F.slice(parts, 1, i), lambda y: y == x)).cast("string")))
    letters = F.when(n > 1, F.transform(F.sequence(F.lit(1), n - 1), lambda i: F.substring(F.col("s"), i, F.lit(2)))).otherwise(F.array().cast("array<string>"))
    of_letters = pairs.select("s", F.lit("p").alias("kind"), F.explode(numbered(letters)).alias("part"))
    of_words = strings.select("s", F.lit("w").alias("kind"), F.explode(F.array_distinct(F.split("s", " "))).alias("part"))
    each = of_letters.unionByName(of_words)
    often = each.groupBy("kind", "part").agg(F.count("*").alias("n"))
    ranked = each.join(often, ["kind", "part"]).groupBy("s", "kind").agg(F.array_sort(F.collect_list(F.struct("n", "part"))).alias("parts"))
    fewest = F.greatest(F.lit(1), F.ceil(0.3058 * F.length("s") - 1).cast("int"))
    few = F.slice("parts", 1, F.greatest(F.lit(1), F.size("parts") - fewest + 1))
    every, rare = F.transform("parts", lambda x: x["part"]), F.transform(few, lambda x: x["part"])
    tagged = lambda tag, xs: F.transform(xs, lambda x: F.xxhash64(F.concat(F.lit(tag), x)))
    of_pairs = F.struct(tagged("p:", rare).alias("own"), tagged("p:", rare).alias("other"))
    rarest = F.slice(every, 1, 1)
    of_words = F.struct(F.concat(tagged("a:", rarest), tagged("b:", every)).alias("own"), F.concat(tagged("a:", every), tagged("b:", rarest)).alias("other"))
    return ranked.select("s", F.when(F.col("kind") == "p", of_pairs).otherwise(of_words).alias("k")).select("s", "k.own", "k.other")


def _search_keys(strings: DataFrame, least: float = FUZZY) -> DataFrame:
    """s, own, other for distinct comparable names (s, is_own, is_other): two names whose similarity can reach `least` share a key,
    `own` of one and `other` of the other; keys are few a name, and what all names have in common is no key by itself.

    By letters: `_letter_keys`. For long names, similarity by blocks: at 0.79 of all T letters matched, what does not match parts
    the blocks, so two names share 0.185 T - 1 pairs of neighbouring letters at least, and T is 1.65 times the letters of either.
    Of n pairs in order of rareness the first n - t + 1 then hold a common one (t: the least shared). By words: of two names one
    of which has all words of the other, the rarest word of that one is in both. Pairs of letters and words are numbered by how
    often they came in the name before.
    """
    lengths = _lengths(strings)
    return _letter_keys(strings, least, lengths).unionByName(_part_keys(strings, least, lengths))


class Links:
    """Which comparable names of asked names score FUZZY or more with which of entities: s, t, score.

    A name is sought among the strings t that are added, each of them once: first those that entities have, then such as they
    learn. So what a round of `resolve_in_order` adds is all that it seeks. Pairs are of the strings' hashes until they are read.
    """

    def __init__(self, asked: DataFrame, dim: DataFrame) -> None:
        names = asked.filter("norm <> ''").groupBy(F.col("norm").alias("s")).agg(F.max("at").alias("last"), F.min("at").alias("since"))
        held = dim.select(F.explode("norms").alias("s")).filter("s <> ''").distinct().withColumn("held", F.lit(True))
        mine, since = F.col("last").isNotNull(), F.when(F.col("held"), F.lit(-1).cast("long")).otherwise(F.col("since"))
        self.strings = staged(names.join(held, "s", "full").select("s", "last", since.alias("since"), mine.alias("is_own"), F.lit(True).alias("is_other"), F.coalesce("held", F.lit(False)).alias("held")))
        self.lengths = _lengths(self.strings)
        self.tasks = int(asked.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        self.parts = staged(_part_keys(self.strings, FUZZY, self.lengths))
        own = self.strings.filter("is_own").select("s", F.col("last").alias("at"), "is_own", F.lit(False).alias("is_other"))
        self.own = staged(self._keys(own, "own"))
        self.added = staged(self.strings.filter("held").select("s"))
        self.found = self._found(self.added)

    def _keys(self, strings: DataFrame, side: str) -> DataFrame:
        """h, at, keys of strings (s, at, is_own, is_other)."""
        # A number, as Spark joins partitions of few bytes else, and a string has hundreds of keys.
        by_letters = _letter_keys(strings.repartition(self.tasks, "s"), FUZZY, self.lengths).select("s", "at", side)
        by_parts = self.parts.join(strings.select("s", "at"), "s").select("s", "at", side)
        return by_letters.unionByName(by_parts).select(F.xxhash64("s").alias("h"), "at", F.col(side).alias("keys"))

    def _found(self, targets: DataFrame) -> DataFrame:
        others = self._keys(self.strings.join(targets, "s", "left_semi").select("s", F.col("since").alias("at"), F.lit(False).alias("is_own"), "is_other"), "other")
        left = self.own.select(F.col("h").alias("hs"), F.col("at").alias("last"), F.explode("keys").alias("key"))
        right = others.select(F.col("h").alias("ht"), F.col("at").alias("since"), F.explode("keys").alias("key"))
        pairs = left.join(right, "key").filter("since < last").select("hs", "ht").distinct()
        text = lambda h, s: self.strings.select(F.xxhash64("s").alias(h), F.col("s").alias(s))
        able = staged(pairs.join(text("hs", "s"), "hs").join(text("ht", "t"), "ht").select("s", "t").filter(may_reach(F.col("s"), F.col("t"), FUZZY)))
        return staged(able.withColumn("score", best_score.asNondeterministic()("s", F.array("t"))).filter(F.col("score") >= FUZZY))

    def add(self, strings: DataFrame) -> None:
        """Names are sought among these strings (s), too; those that are there already cost nothing."""
        new = staged(strings.filter("s <> ''").distinct().join(self.added, "s", "left_anti"))
        if not new.isEmpty():
            self.found = staged(self.found.unionByName(self._found(new)))
            self.added = staged(self.added.unionByName(new))


def _dated(entities: DataFrame) -> DataFrame:
    """canonical_id, canonical_name, dated: the comparable names of entities with the place from which they count (-1: always)."""
    own = F.transform("norms", lambda x: F.struct(x.alias("s"), F.lit(-1).cast("long").alias("at")))
    return entities.select("canonical_id", "canonical_name", (F.concat(own, "learned") if "learned" in entities.columns else own).alias("dated"))


def search_keys(norms: DataFrame, entities: DataFrame, least: float = FUZZY) -> DataFrame:
    """The keys of `_search_keys` for comparable names (norm) and those of entities."""
    right = _dated(entities).select(F.explode("dated.s").alias("s")).filter("s <> ''")
    own = norms.select(F.col("norm").alias("s")).filter("s <> ''")
    both = own.select("s", F.lit(True).alias("is_own"), F.lit(False).alias("is_other")).unionByName(right.select("s", F.lit(False).alias("is_own"), F.lit(True).alias("is_other")))
    return staged(_search_keys(staged(both.groupBy("s").agg(F.max("is_own").alias("is_own"), F.max("is_other").alias("is_other"))), least))


def candidate_pairs(names: DataFrame, entities: DataFrame, least: float = FUZZY) -> DataFrame:
    """raw_name, norm, canonical_id, canonical_name, norms for names (raw_name, norm) and the entities that they are compared
    with: those that share a blocking key, or all for a name that shares none or if there are only FEW. Of those, only such as
    can score `least` are given (see `_search_keys`): whole blocks, as of all names of two words, are never paired.
    """
    names, dim = names.select("raw_name", "norm", F.lit((1 << 62)).cast("long").alias("at")), _dated(entities)
    columns = ["raw_name", "norm", "canonical_id", "canonical_name", "norms"]
    if entities.count() <= FEW:
        every = names.withColumn("_all", F.lit(1)).join(F.broadcast(dim.withColumn("_all", F.lit(1))), "_all")
        return every.select("raw_name", "norm", "canonical_id", "canonical_name", _before())
    right, keys = _by_string(dim), search_keys(names, entities, least)
    asked = names.select("raw_name", "at", F.col("norm").alias("s")).join(keys.select("s", F.explode("own").alias("key")), "s").select("raw_name", "at", "key")
    offered = right.join(keys.select("s", F.explode("other").alias("key")), "s").select("canonical_id", "since", "key")
    pairs = asked.join(offered, "key").filter("since < at").select("raw_name", "canonical_id").distinct()
    return _in_blocks(pairs, names, dim, right).select(*columns)


def _before() -> Column:
    """norms: of an entity's dated names those from before a name's place."""
    return F.transform(F.filter("dated", lambda x: x["at"] < F.col("at")), lambda x: x["s"]).alias("norms")


def _by_string(dim: DataFrame) -> DataFrame:
    """canonical_id, s, since: a row a name of an entity."""
    return dim.select("canonical_id", F.explode("dated").alias("d")).select("canonical_id", "d.s", F.col("d.at").alias("since")).filter("s <> ''").groupBy("canonical_id", "s").agg(F.min("since").alias("since"))


def _in_blocks(pairs: DataFrame, names: DataFrame, dim: DataFrame, strings: DataFrame) -> DataFrame:
    """Pairs (raw_name, canonical_id and more) that share a blocking key, or whose name shares none with any; with norm,
    canonical_name and norms."""
    held = names.select("raw_name", "norm", "at").join(_blocked(names, strings).withColumn("_blocked", F.lit(True)), "raw_name", "left")
    full = pairs.join(held, "raw_name").join(dim, "canonical_id").select(*pairs.columns, "norm", "canonical_name", _before(), "_blocked")
    common = F.exists("norms", lambda o: F.arrays_overlap(blocking_keys(o), blocking_keys(F.col("norm"))))
    return full.filter(F.col("_blocked").isNull() | common).drop("_blocked")


def _blocked(names: DataFrame, strings: DataFrame) -> DataFrame:
    """raw_name of names that share a blocking key with any string before them: by the distinct keys, without pairing."""
    blocks = strings.select(F.explode(blocking_keys(F.col("s"))).alias("block"), "since").groupBy("block").agg(F.min("since").alias("since"))
    own = names.select("raw_name", "at", F.explode(blocking_keys(F.col("norm"))).alias("block"))
    return own.join(blocks, "block").filter("since < at").select("raw_name").distinct()


def may_reach(a: Column, b: Column, least: float) -> Column:
    """Whether the similarity of two names, rounded to two places, can be `least`: never false where it is.

    Matching blocks match each letter once, so at most as many letters as both have of each; a name all of whose words the
    other has may score more than its letters.
    """
    often = lambda s, c: F.length(s) - F.length(F.replace(s, c, F.lit("")))
    both = F.aggregate(F.array_distinct(F.split(b, "")), F.lit(0), lambda n, c: n + F.when(c == "", 0).otherwise(F.least(often(a, c), often(b, c))))
    words, others = F.split(a, " "), F.split(b, " ")
    within = (F.size(F.array_except(words, others)) == 0) | (F.size(F.array_except(others, words)) == 0)
    return (2 * both >= (least - 0.006) * (F.length(a) + F.length(b))) | within


def scored(pairs: DataFrame, least: float = FUZZY) -> DataFrame:
    """Pairs with a score of at least `least`. Only names that can reach it, by their letters and words, go to Python."""
    able = staged(pairs.withColumn("norms", F.filter("norms", lambda o: may_reach(F.col("norm"), o, least))).filter(F.size("norms") > 0))
    return able.withColumn("score", best_score.asNondeterministic()("norm", "norms")).filter(F.col("score") >= least).drop("norms")


def linked(names: DataFrame, entities: DataFrame, links: DataFrame) -> DataFrame:
    """`scored` for names with a place `at` by the links of their comparable names: of the names that entities have learned only
    those of smaller places count."""
    dim = _dated(entities)
    right = _by_string(dim)
    met = names.select("raw_name", "at", F.col("norm").alias("s")).join(links, "s").join(right.withColumnRenamed("s", "t"), "t").filter("since < at")
    scores = met.groupBy("raw_name", "canonical_id").agg(F.max("score").alias("score"))
    if entities.count() <= FEW:
        return scores.join(dim.select("canonical_id", "canonical_name"), "canonical_id")
    return _in_blocks(scores, names, dim, right)


def ranked(scores: DataFrame, hundredths: bool = False) -> DataFrame:
    """Of each name the best entity, with `ambiguous`, and all candidates as an array from the best on; ties by canonical_id.

    hundredths: see `resolve`.
    """
    all_ = F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("neg"), "canonical_id", "canonical_name")))
    top = scores.groupBy("raw_name").agg(all_.alias("c"))
    second = F.try_element_at(F.col("c"), F.lit(2))["neg"]
    apart = -F.col("c")[0]["neg"] + second
    gap = F.coalesce(F.round(apart * 100) < round(100 * DELTA) if hundredths else apart < DELTA, F.lit(False))
    candidates = F.transform("c", lambda x: F.struct(x["canonical_id"].alias("canonical_id"), x["canonical_name"].alias("canonical_name"), (-x["neg"]).alias("score")))
    return top.select("raw_name", gap.alias("ambiguous"), candidates.alias("candidates"))


def _best(names: DataFrame, dim: DataFrame, every: bool, links: DataFrame | None, hundredths: bool = False) -> DataFrame:
    """`ranked` for names (raw_name, norm); every: of ambiguous names all candidates are wanted, else the best will do.

    Names that have much in common are alike in great numbers, but most have one that is nearer: those whose best, and all that
    can contend with it, are at NEAR or above are done by that, and only the others are sought among all down to FUZZY.
    """
    if links is not None:
        return staged(ranked(linked(names, dim, links), hundredths))
    near = staged(ranked(scored(candidate_pairs(names, dim, least=NEAR), NEAR), hundredths))
    told = F.round(F.col("candidates")[0]["score"] * 100) >= round(100 * (NEAR + DELTA))
    done = near.filter(told & ~F.col("ambiguous") if every else told)
    rest = staged(names.join(done.select("raw_name"), "raw_name", "left_anti"))
    return done if rest.isEmpty() else staged(done.unionByName(ranked(scored(candidate_pairs(rest, dim)), hundredths)))


def choose(ambiguous: DataFrame, chooser: Callable[[str, list[dict]], tuple[str, float] | None]) -> DataFrame:
    """raw_name, canonical_id, confidence where the chooser picks one of a name's candidates; other answers, and errors, are none."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for name, candidates in zip(b["raw_name"], b["candidates"], strict=True):
                options = [dict(c) if isinstance(c, dict) else c.asDict() for c in candidates]
                try:
                    got = chooser(name, options)
                except Exception:  # noqa: BLE001 - a failing chooser leaves the name unresolved
                    got = None
                if got and got[0] in {o["canonical_id"] for o in options}:
                    out.append((name, got[0], float(got[1])))
            yield pd.DataFrame(out, columns=["raw_name", "canonical_id", "confidence"])

    return ambiguous.select("raw_name", "candidates").mapInPandas(run, "raw_name string, canonical_id string, confidence double")


def _asked(names: DataFrame, mappings: DataFrame | None, refresh: bool, *more) -> tuple[DataFrame, DataFrame | None]:
    """(the distinct names to resolve: raw_name, source_url, norm and more; mappings that are kept)."""
    asked = names.select(filled(F.col("raw_name")).alias("raw_name"), "source_url", *[c for c, _ in more]).filter("raw_name is not null")
    asked = asked.groupBy("raw_name").agg(F.min("source_url").alias("source_url"), *[a for _, a in more])
    kept = None
    if mappings is not None:
        kept = mappings.filter("match_method <> 'unresolved'") if refresh else mappings
        kept = kept.join(asked.select("raw_name"), "raw_name", "left_semi").select(*MAPPING)
        asked = asked.join(kept.select("raw_name"), "raw_name", "left_anti")
    return staged(with_comparable(asked, F.col("raw_name"), "norm")), kept


def _resolved(asked: DataFrame, dim: DataFrame, chooser: Callable | None, learned: DataFrame | None = None, links: DataFrame | None = None, hundredths: bool = False) -> DataFrame:
    """MAPPING for asked names (raw_name, source_url, norm, and at where aliases are learned)."""
    equal = staged(equi_stages(asked, dim, learned))
    rest = asked.join(equal.select("raw_name"), "raw_name", "left_anti").filter("norm <> ''")
    best = _best(staged(rest), dim, chooser is not None, links, hundredths)
    clear = best.filter("not ambiguous").select("raw_name", F.col("candidates")[0]["canonical_id"].alias("canonical_id"), F.col("candidates")[0]["canonical_name"].alias("canonical_name"), F.lit("fuzzy").alias("match_method"), F.col("candidates")[0]["score"].alias("confidence"))
    found = equal.unionByName(clear)
    if chooser is not None:
        picked = choose(best.filter("ambiguous"), chooser).join(dim.select("canonical_id", "canonical_name"), "canonical_id").withColumn("match_method", F.lit("llm"))
        found = found.unionByName(picked)
    named = asked.join(found, "raw_name", "left")
    norm = F.when(F.col("norm") != "", F.col("norm"))
    return named.select(
        "raw_name",
        F.coalesce(norm, F.lower("raw_name")).alias("normalized_name"),
        F.coalesce("canonical_name", "raw_name").alias("canonical_name"),
        F.coalesce("canonical_id", F.concat(F.lit("unresolved_"), F.coalesce(norm, F.lit("entity")))).alias("canonical_id"),
        F.coalesce("match_method", F.lit("unresolved")).alias("match_method"),
        F.coalesce("confidence", F.lit(0.0)).alias("confidence"),
        "source_url",
    )


def resolve(names: DataFrame, entities: DataFrame, mappings: DataFrame | None = None, chooser: Callable | None = None, refresh_unresolved: bool = False, hundredths: bool = False) -> DataFrame:
    """MAPPING for every distinct non-blank raw_name of names (columns raw_name, source_url).

    A name with a mapping keeps it (an unresolved one is sought again on refresh_unresolved). An unresolved name gets the id
    unresolved_<comparable name> and its own name. Scores have two places; their difference is taken as it is in binary, where
    0.96 and 0.93 are closer than 0.03, or in hundredths, where they are not.
    """
    asked, kept = _asked(names, mappings, refresh_unresolved)
    out = _resolved(asked, prepared(entities), chooser, hundredths=hundredths)
    return out if kept is None else out.unionByName(kept)


def resolve_in_order(names: DataFrame, entities: DataFrame, order: str, mappings: DataFrame | None = None, chooser: Callable | None = None, refresh_unresolved: bool = False) -> DataFrame:
    """MAPPING as of names that are taken one by one in order (ties by name), each an alias of its entity for those after it.

    All names are resolved at once against the entities; then those that a new alias of an earlier name can touch are resolved
    again, with all aliases so far, and so on until no alias is new or gone. As a name depends on earlier ones only, that ends,
    after as many rounds as the longest chain of names of which each needs the one before; a round works on touched names alone.
    A name is touched by an alias that it equals, by an entity with a new alias if it scores enough with any name of it, or, if it shares no blocking key with any entity at first, by an alias with a blocking key of it.
    """
    asked, kept = _asked(names, mappings, refresh_unresolved, (F.col(order).alias("_place"), F.min("_place").alias("_order")))
    asked = staged(numbered(asked, ["_order", "raw_name"], "at").drop("_order"))
    dim = prepared(entities)
    links = Links(asked, dim)
    # An alias that the entity has already, as a comparable name, changes nothing.
    had = staged(dim.select("canonical_id", F.explode("norms").alias("s")).distinct())
    strings = dim.select(F.explode("norms").alias("s")).filter("s <> ''").select("s", F.lit(-1).cast("long").alias("since"))
    loose = staged(asked.join(_blocked(asked, strings), "raw_name", "left_anti").select("raw_name", "at", "norm"))
    todo, out, learned = asked, None, None
    while True:
        if learned is None:
            part = staged(_resolved(todo, dim, chooser, None, links.found))
        else:
            more = learned.groupBy("canonical_id").agg(F.collect_list(F.struct("s", "at")).alias("learned"))
            grown = dim.join(more, "canonical_id", "left").withColumn("learned", F.coalesce("learned", F.array().cast("array<struct<s:string,at:bigint>>")))
            part = staged(_resolved(todo, staged(grown), chooser, learned, links.found))
        out = part if out is None else staged(out.join(part.select("raw_name"), "raw_name", "left_anti").unionByName(part))
        found = out.filter("match_method <> 'unresolved'").select("raw_name", "canonical_id", "canonical_name").join(asked.select("raw_name", F.col("norm").alias("s"), "at"), "raw_name").filter("s <> ''")
        # Of names that compare alike only the first one's alias counts.
        now = staged(found.join(had, ["canonical_id", "s"], "left_anti").groupBy("canonical_id", "s").agg(F.min("at").alias("at"), F.first("canonical_name").alias("canonical_name")))
        same = ["canonical_id", "s", "at"]
        changed = staged(now if learned is None else now.join(learned, same, "left_anti").unionByName(learned.join(now, same, "left_anti")))
        if changed.isEmpty():
            break
        delta = changed.groupBy("s").agg(F.min("at").alias("since"))
        # An entity that is found by a new alias is compared by all its names, so whatever is near any of them is touched.
        grew = changed.groupBy("canonical_id").agg(F.min("at").alias("since"))
        theirs = had.unionByName(now.select("canonical_id", "s")).join(grew, "canonical_id").unionByName(changed.select("canonical_id", "s", F.col("at").alias("since")))
        links.add(changed.select("s"))
        near = links.found.join(theirs.select(F.col("s").alias("t"), "since"), "t").groupBy("s").agg(F.min("since").alias("since")).unionByName(delta)
        by_key = asked.join(near, F.col("norm") == F.col("s")).filter("since < at").select("raw_name")
        touched = by_key.unionByName(_blocked(loose, delta)).distinct()
        learned, todo = now, staged(asked.join(touched, "raw_name", "left_semi"))
        if todo.isEmpty():
            break
    return out if kept is None else out.unionByName(kept)


def with_new_aliases(entities: DataFrame, mappings: DataFrame) -> DataFrame:
    """Entities whose aliases hold every raw name that was resolved to them."""
    found = mappings.filter("match_method <> 'unresolved'").select("canonical_id", F.col("raw_name").alias("alias"))
    return added_to_set(entities, found, "canonical_id", "aliases", "alias")


def find_by_name(entities: DataFrame, name: str) -> DataFrame:
    """Entities with this name, or the same comparable one."""
    found = with_comparable(entities, F.col("canonical_name"), "_norm")
    return found.filter((F.col("canonical_name") == name) | (F.col("_norm") == comparable(name))).drop("_norm")


def find_by_names(names: DataFrame, entities: DataFrame, name: str) -> DataFrame:
    """Rows of names with canonical_id, once for each entity that has the row's name or the same comparable one; null if none has.

    Equal names have equal comparable forms, so this is one equi join on those. A name of which nothing is comparable (signs
    alone) is sought as it is, so that such names don't all meet. Null names and null entity names find nothing.
    """
    key, taken = "_find_key", {"canonical_id", "_find_key", "_find_norm"} & set(names.columns)
    if taken:
        raise ValueError(f"columns that are set here: {sorted(taken)}")

    def keyed(rows: DataFrame, column: Column) -> DataFrame:
        keys = with_comparable(rows, column, "_find_norm")
        return keys.withColumn(key, F.when(F.col("_find_norm") != "", F.col("_find_norm")).otherwise(F.concat(F.lit("\n"), column))).drop("_find_norm")

    held = keyed(staged(entities.select("canonical_id", "canonical_name")), F.col("canonical_name")).select(key, "canonical_id").distinct()
    return keyed(staged(names), F.col(name)).join(held, key, "left").drop(key)


def with_seeds(entities: DataFrame | None, spark: SparkSession) -> DataFrame:
    """Entities, and the seeds that they lack."""
    seed = seeds(spark)
    return seed if entities is None else entities.unionByName(seed.join(entities.select("canonical_id"), "canonical_id", "left_anti"), allowMissingColumns=True)


def attach(rows: DataFrame, mappings: DataFrame, name: str, prefix: str = "canonical") -> DataFrame:
    """Rows with the entity of their name: <prefix>_id, <prefix>_name and resolution_match_method, null without a mapping."""
    m = mappings.select(F.col("raw_name").alias("_raw"), F.col("canonical_id").alias(f"{prefix}_id"), F.col("canonical_name").alias(f"{prefix}_name"), F.col("match_method").alias("resolution_match_method"))
    return rows.join(m, filled(F.col(name)) == F.col("_raw"), "left").drop("_raw")


def method_counts(mappings: DataFrame) -> DataFrame:
    return mappings.groupBy("match_method").agg(F.count("*").alias("n"))


def merge_mappings(held: DataFrame | None, new: DataFrame) -> DataFrame:
    return new if held is None else upserted(held, new, "raw_name")
