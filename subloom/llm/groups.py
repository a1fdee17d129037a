"""Splits that keep related records together (problem 6).

Entities are linked where they name the same show or share half of the smaller one's texts. Hash-to-min finds the
components: each node sends its neighbour cluster to the cluster's minimum and that minimum to the cluster, until
nothing changes. Components go to splits by weighted rendezvous hashing, whose weights are fitted to the wanted shares.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from subloom.operators.skew import hot_keys, salted_join
from subloom.session import cut, stored

#: Season and episode marks, in lower case (fixed values): s01e02, 1x02, season 1 episode 2, ep 02, s2.
_MARK = r"(?:s\d+[ ._-]*e\d+|(?<![a-z0-9])\d+x\d+|(?<![a-z])season[ ._-]*\d+|(?<![a-z])(?:episode|ep|e)[ ._-]*\d+|(?<![a-z])s\d+(?![a-z0-9])).*$"
_TEAM = r"^\s*(?:\[[^\]]*\]|\([^)]*\)|\{[^}]*\})"


def show_key(name: Column) -> Column:
    """Letters and digits of the words before the season or episode mark, a leading team tag aside; null where none are."""
    plain = F.regexp_replace(F.lower(name), _TEAM, "")
    head = F.regexp_replace(plain, _MARK, "")
    key = F.regexp_replace(head, r"[^\p{L}\p{N}]", "")
    return F.when(key != "", key)


def text_key(text: Column) -> Column:
    """Hash of the letters and digits of a text, without case; null for texts that have none."""
    key = F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]", "")
    return F.when(key != "", F.xxhash64(key))


def half_shared(df: DataFrame, entity: str, text: str) -> DataFrame:
    """a, b: links that join all entities of which the one with fewer distinct texts has at least half of them in the other.

    An entity of one or two texts goes with all that hold one of them, so each such text makes a star around one holder.
    For the others a prefix filter: whatever half of its texts an entity shares, one of its n // 2 + 1 rarest is among them,
    so only those (and texts as rare) look for partners among all texts; the shared texts of the pairs found are then
    counted in full. A stock line that every entity has is among the rarest of none but tiny entities, so it makes no pairs
    elsewhere. Entities of very many texts and texts of very many entities are salted in the joins.
    """
    each = stored(df.select(F.col(entity).alias("e"), text_key(F.col(text)).alias("k")).dropna().distinct())
    sizes = stored(each.groupBy("e").agg(F.count(F.lit(1)).alias("n")))
    # A text of one entity only has no partner: it takes a place in the prefix, but needs no row.
    held = stored(each.groupBy("k").agg(F.count(F.lit(1)).alias("df")).filter("df > 1"))
    rows = each.count()
    hot, hot_k = hot_keys(sizes, ["e"], "n", rows), hot_keys(held, ["k"], "df", rows)
    common = stored(salted_join(salted_join(each, held, ["k"], hot_k, "e"), sizes, ["e"], hot, "k"))
    few = common.filter("n <= 2").groupBy("k").agg(F.min("e").alias("a"))
    stars = salted_join(common, few, ["k"], hot_k, "e").filter("a <> e").select("a", F.col("e").alias("b"))
    levels = common.filter("n > 2").groupBy("e", "n", "df").agg(F.count(F.lit(1)).alias("m"))
    window = Window.partitionBy("e")
    upto = F.sum("m").over(window.orderBy("df").rowsBetween(Window.unboundedPreceding, -1))
    needed = levels.withColumns({"before": F.coalesce(upto, F.lit(0)), "m_all": F.sum("m").over(window)}).filter(F.col("before") + F.col("n") - F.col("m_all") < F.floor(F.col("n") / 2) + 1)
    limits = needed.groupBy("e").agg(F.max("df").alias("last_df"))
    prefix = salted_join(common, limits, ["e"], hot, "k").filter("df <= last_df").select("k", F.col("e").alias("a"), F.col("n").alias("na"))
    other = common.filter("n > 2").select("k", F.col("e").alias("b"), F.col("n").alias("nb"))
    pairs = salted_join(other, prefix, ["k"], hot_k, "b").filter((F.col("na") < F.col("nb")) | ((F.col("na") == F.col("nb")) & (F.col("a") < F.col("b")))).select("a", "b", "na").distinct()
    named = lambda c: hot.select(F.col("e").alias(c)) if hot is not None else None
    left = salted_join(common.select(F.col("e").alias("a"), "k"), stored(pairs), ["a"], named("a"), "k")
    both = left.join(common.select(F.col("e").alias("b"), "k"), ["b", "k"])
    found = both.groupBy("a", "b", "na").agg(F.count(F.lit(1)).alias("shared")).filter(2 * F.col("shared") >= F.col("na"))
    return stars.union(found.select("a", "b")).distinct()


def same_show(df: DataFrame, entity: str) -> DataFrame:
    """a, b: each entity of a show with the smallest of that show; a show of any size gives one link an entity."""
    named = df.select(F.col(entity).alias("b"), show_key(F.col(entity)).alias("s")).dropna().distinct()
    first = named.groupBy("s").agg(F.min("b").alias("a"))
    return named.join(first, "s").filter("a <> b").select("a", "b")


def components(links: DataFrame, rounds: int = 64) -> DataFrame:
    """node, component (its smallest node) for the nodes of the links a, b, by hash-to-min.

    Links are read once, so they should be stored. The rows of a node that has very many neighbours are salted.
    """
    c = cut(links.select(F.explode(F.array(*[F.struct(F.col(x).alias("v"), F.col(y).alias("u")) for x in "ab" for y in "ab"])).alias("x")).select("x.v", "x.u").distinct())
    before = None
    for _ in range(rounds):
        least = stored(c.groupBy("v").agg(F.min("u").alias("m"), F.count(F.lit(1)).alias("n")))
        total = least.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
        sent = salted_join(c, least.select("v", "m"), ["v"], hot_keys(least, ["v"], "n", total), "u")
        c = cut(sent.select(F.explode(F.array(F.struct(F.col("m").alias("v"), "u"), F.struct(F.col("u").alias("v"), F.col("m").alias("u")))).alias("x")).select("x.v", "x.u").distinct())
        now = tuple(c.agg(F.count(F.lit(1)), F.sum(F.xxhash64("v", "u").cast("decimal(20,0)"))).first())
        if now == before:
            return c.groupBy(F.col("v").alias("node")).agg(F.min("u").alias("component"))
        before = now
    raise RuntimeError(f"components not stable after {rounds} rounds")


def related(df: DataFrame, entity: str, text: str) -> DataFrame:
    """node, component of every entity that is linked to another.

    Null entities and texts without letters or digits link nothing; an empty table gives an empty one.
    """
    rows = df.select(F.col(entity).cast("string").alias("entity"), F.col(text).cast("string").alias("text"))
    return components(stored(half_shared(rows, "entity", "text").union(same_show(rows, "entity"))))


def related_pairs(found: DataFrame) -> DataFrame:
    """a, b: all pairs within each component, the smaller first (as the result is stated)."""
    x = found.select("component", F.col("node").alias("a"))
    return x.join(found.select("component", F.col("node").alias("b")), "component").filter("a < b").select("a", "b")


def rendezvous_splits(sized: DataFrame, shares: dict[str, float], seed: int = 42, rounds: int = 12, tries: int = 16, close: float = 0.005) -> DataFrame:
    """component, split for component and n (its rows): the split with the largest -weight / ln(hash).

    Weights start as the shares; as components differ in size, they are then fitted by a few sums over the components
    until rows meet the shares. Where they don't come within `close`, as a huge component is in a small split, the hash is
    seeded anew, and the best of `tries` seeds is taken. The same seed gives the same splits; an empty table gives an empty
    one.
    """
    names = list(shares)
    total = sized.agg(F.sum("n")).first()[0] or 0

    def assigned(w: dict[str, float], salt: int) -> Column:
        score = [F.struct((-w[s] / F.log((F.pmod(F.xxhash64(F.lit(f"{seed}:{salt}:{s}"), "component"), F.lit(1 << 52)) + 0.5) / float(1 << 52))).alias("x"), F.lit(s).alias("s")) for s in names if w[s] > 0]
        return F.array_max(F.array(*score)).getField("s")

    def rows_of(weights: dict[int, dict[str, float]]) -> dict[int, dict[str, int]]:
        """Rows of each split for each seed, in one pass over the components."""
        told = sized.select("n", *[assigned(w, salt).alias(f"s{salt}") for salt, w in weights.items()])
        sums = told.agg(*[F.coalesce(F.sum(F.when(F.col(f"s{salt}") == s, F.col("n"))), F.lit(0)).alias(f"{salt} {s}") for salt in weights for s in names]).first()
        return {salt: {s: sums[f"{salt} {s}"] for s in names} for salt in weights}

    best = (math.inf, dict(shares), 0)
    for salts in ([0], range(1, tries)) if total else ():
        weights = {salt: dict(shares) for salt in salts}
        for _ in range(rounds):
            for salt, rows in rows_of(weights).items():
                off = max(abs(rows[s] / total - shares[s]) for s in names)
                if off < best[0]:
                    best = (off, weights[salt], salt)
                weights[salt] = {s: weights[salt][s] * (max(shares[s], 1e-9) / max(rows[s] / total, shares[s] / 8, 1e-9)) ** 0.7 for s in names}
            if best[0] < 0.002:
                break
        if best[0] < close:
            break
    return sized.select("component", assigned(best[1], best[2]).alias("split"))


def grouped_splits(df: DataFrame, id_col: str, entity: str, text: str, shares: dict[str, float], seed: int = 42) -> DataFrame:
    """id_col, component, split of every row; a row with a null entity is a component of its own."""
    found = related(df, entity, text).withColumnRenamed("node", "_e")
    e = F.col(entity).cast("string")
    rows = df.select(id_col, e.alias("_e")).join(found, "_e", "left")
    rows = rows.select(id_col, F.coalesce("component", "_e", F.concat(F.lit("\u0000"), F.col(id_col).cast("string"))).alias("component"))
    sized = stored(rows.groupBy("component").agg(F.count(F.lit(1)).alias("n")))
    return rows.join(rendezvous_splits(sized, shares, seed), "component").select(id_col, "component", "split")
