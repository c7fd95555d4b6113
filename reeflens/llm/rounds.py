"""From shared buckets to components: rounds of verification that lose no link between components."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import components
from .scratch import drop_stored, stored

#: Buckets of up to so many members are compared pair by pair.
FEW = 64
#: Rounds between components before that; what they leave apart is compared after them, so that their number changes no result.
TURNS = 1
#: Most nodes of a cluster that share a rare shingle, in clusters of 400 nodes or more.
RARE = 8
#: So few pairs are verified at once at the end: steps before that would take more than they save.
SOME = 2_000
#: 64-bit words of an odd sketch, a power of two.
ODD_WORDS = 16


def shared_buckets(members: DataFrame) -> DataFrame:
    """``(key, node, leader)`` of ``members(key, node)`` in buckets with two nodes or more.

    The leader is the bucket's smallest node: a partial aggregate, joined back,
    so that a bucket's rows never have to meet in one task.  Leaders have one
    row per key, which a hash table per partition holds.
    """
    leaders = members.groupBy("key").agg(F.min("node").alias("leader"), F.max("node").alias("last")).where("leader <> last")
    return members.join(leaders.hint("shuffle_hash"), "key").select("key", "node", "leader")


def odd_place(shingle: Column) -> tuple[Column, Column]:
    """The word and the bit of an odd sketch that a shingle's hash is counted at."""
    word = F.shiftright(shingle, 6).bitwiseAND(F.lit(ODD_WORDS - 1)).cast("int")
    return word, F.call_function("shiftleft", F.lit(1).cast("long"), shingle.bitwiseAND(F.lit(63)).cast("int"))


def odd_sketches(shingles: DataFrame) -> DataFrame:
    """``(node, o0, o1, ..)`` of the distinct ``shingles(node, shingle)``: the parity of the number of shingles at each bit."""
    word, bit = odd_place(F.col("shingle"))
    words = shingles.select("node", bit.alias("bit"), word.alias("word")).groupBy("node", "word").agg(F.bit_xor("bit").alias("bits"))
    return words.groupBy("node").agg(*[
        F.coalesce(F.max(F.when(F.col("word") == i, F.col("bits"))), F.lit(0).cast("long")).alias(f"o{i}")
        for i in range(ODD_WORDS)])


def _may_reach(x: str, y: str, percent: int) -> Column:
    """Whether two sets can have a Jaccard of ``percent``, by their sizes and odd sketches.

    A shingle that only one of two sets has changes one bit, so that as many bits
    differ as shingles or fewer, and no pair that reaches ``percent`` is lost.
    """
    differ = None
    for i in range(ODD_WORDS):
        one = F.bit_count(F.col(f"{x}.o{i}").bitwiseXOR(F.col(f"{y}.o{i}")))
        differ = one if differ is None else differ + one
    return (100 + percent) * differ <= (100 - percent) * (F.col(f"{x}.n") + F.col(f"{y}.n"))


def _apart(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """The pairs (a, b) whose ends lie in different components."""
    la = labels.select(F.col("node").alias("a"), F.col("component").alias("ca"))
    lb = labels.select(F.col("node").alias("b"), F.col("component").alias("cb"))
    return (pairs.join(la, "a", "left").join(lb, "b", "left")
            .where(F.coalesce("ca", "a") != F.coalesce("cb", "b")).select("a", "b"))


def _placed(shared: DataFrame, labels: DataFrame) -> DataFrame:
    """``(key, node, part, c)`` of the buckets with several components; c members each.

    The only pair of a bucket of two has been tried, as its leader and the other one.
    """
    placed = shared.join(labels, "node", "left").select("key", "node", F.coalesce("component", "node").alias("part"))
    several = placed.groupBy("key").agg(
        F.min("part").alias("lo"), F.max("part").alias("hi"), F.count("*").alias("c")).where("lo <> hi and c > 2").select("key", "c")
    return placed.join(several, "key")


def _merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels`` with the components that ``links(a, b)`` join made one; nodes new to ``labels`` come in.

    Only the graph of components is searched: its edges are the links between
    different ones, so a round costs what it found, not what is known.
    """
    both = links.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    every = labels.unionByName(both.join(labels, "node", "left_anti").select("node", F.col("node").alias("component")))
    la = labels.select(F.col("node").alias("a"), F.col("component").alias("ca"))
    lb = labels.select(F.col("node").alias("b"), F.col("component").alias("cb"))
    edges = links.join(la, "a", "left").join(lb, "b", "left").select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b"))
    joined = components(edges).select(F.col("node").alias("component"), F.col("component").alias("root"))
    return every.join(joined, "component", "left").select("node", F.coalesce("root", "component").alias("component"))


def _cores(clusters: DataFrame, sizes: DataFrame, listed: DataFrame, parts: DataFrame, rare_in: int) -> tuple[DataFrame, DataFrame, list[DataFrame]]:
    """``(node, n, core)``, where core counts the shingles that are not rare; pairs of unequal parts that share a rare one.

    A shingle is rare if ``rare_in`` nodes of its cluster have it, or fewer in
    a small cluster, so that it makes few pairs.  Shingles that only one part has
    make none.  The third has the tables that both are read from.
    """
    most = F.least(F.lit(rare_in), 1 + F.floor(F.count("*") / 50))
    rarity = clusters.groupBy("cluster").agg(most.alias("most"))
    # up to three owners are known by the least, the greatest and the bits of all: ``listed`` need not be joined with the counts
    counts = listed.groupBy("cluster", "shingle").agg(
        F.count("*").alias("c"), F.min("node").alias("lo"), F.max("node").alias("hi"), F.bit_xor("node").alias("bits"))
    counts = stored(counts.where(F.col("c") <= rare_in), "counts")
    several = counts.where("c > 1").join(rarity, "cluster").where("c <= most")
    middle = F.col("bits").bitwiseXOR(F.col("lo")).bitwiseXOR(F.col("hi"))
    owners = several.where("c <= 3").select(
        F.when(F.col("c") == 2, F.array("lo", "hi")).otherwise(F.array(F.col("lo"), middle, F.col("hi"))).alias("owners"))
    if rare_in > 3:
        more = listed.join(several.where("c > 3").select("cluster", "shingle"), ["cluster", "shingle"])
        owners = owners.unionByName(more.groupBy("cluster", "shingle").agg(F.sort_array(F.collect_list("node")).alias("owners")).select("owners"))
    # the shingles of one edit have the same owners, who are dealt with once and not once a shingle
    owners = stored(owners.groupBy("owners").agg(F.count("*").alias("times")), "owners")
    each = owners.select("owners", "times", F.explode("owners").alias("node"))
    alone = counts.where("c = 1").select(F.col("lo").alias("node"), F.lit(1).cast("long").alias("times"))
    owned = alone.unionByName(each.select("node", "times")).groupBy("node").agg(F.sum("times").alias("rare"))
    bound = clusters.select("node").join(sizes, "node").join(owned, "node", "left").select(
        "node", "n", (F.col("n") - F.coalesce("rare", F.lit(0))).alias("core"))
    placed = each.join(parts.select("node", "part"), "node").groupBy("owners").agg(
        F.sort_array(F.collect_list(F.struct("part", "node"))).alias("placed"))
    placed = placed.where("placed[0].part <> element_at(placed, -1).part")
    across = F.flatten(F.transform("placed", lambda x: F.transform(
        F.filter("placed", lambda y: x["part"] < y["part"]),
        lambda y: F.struct(F.least(x["node"], y["node"]).alias("a"), F.greatest(x["node"], y["node"]).alias("b")))))
    pairs = placed.select(F.explode(across).alias("pair")).select("pair.a", "pair.b").distinct()
    return bound, pairs, [counts, owners]


def joined_up(shared: DataFrame, verified: Callable[[DataFrame], DataFrame], percent: int, sketches: DataFrame,
              alike: Callable[[str, str], Column], sizes: DataFrame | None, listed: Callable[[DataFrame], DataFrame],
              rare_in: int = RARE, given: DataFrame | None = None) -> DataFrame:
    """``(node, component)`` of the nodes that ``verified`` links, and those that ``given(a, b)`` does, stored.

    ``verified`` keeps the pairs of a table ``(a, b)`` whose shingle sets have
    a Jaccard of ``percent`` or more; ``alike`` is a cheap test that such pairs
    pass, on two aliases of ``sketches``, which may hold the sizes and odd sketches already, in buckets by node.  Every node first meets one leader of
    its buckets, then its other leaders, and then the other members, each time
    only where the two are still in different components.  For large buckets
    of the last step ``sizes`` has the sets' sizes as ``(node, n)``, or is None
    where the listed shingles are to be counted, and ``listed`` makes
    ``(node, cluster, shingle)`` of ``(node, cluster)``; nodes that share such a bucket are in one cluster.  Two nodes with no rare
    shingle of the cluster in common share no more than the smaller of what
    else they have; pairs that this rules out are not compared.
    """
    labels, sharp, done = None, "o0" in sketches.columns, []

    def keep(table: DataFrame) -> DataFrame:
        done.append(table)
        return table

    def take(links: DataFrame) -> bool:
        """Bring verified links into ``labels``; whether there were any."""
        nonlocal labels
        links = stored(links, "links")
        if labels is not None and links.isEmpty():
            drop_stored(links)
            return False
        before, labels = labels, stored(components(links) if labels is None else _merged(labels, links), "labels")
        for done in filter(None, (before, links)):
            drop_stored(done)
        return True

    def tested(pairs: DataFrame) -> DataFrame:
        """The pairs that ``alike`` lets pass."""
        # the pairs are the smaller hash table; sketches in buckets need not be sorted for them
        pairs = pairs.hint("shuffle_hash") if sharp else pairs
        return pairs.join(sketches.alias("x"), F.col("a") == F.col("x.node")).join(
            sketches.alias("y"), F.col("b") == F.col("y.node")).where(alike("x", "y")).select("a", "b")

    def stored_pairs(pairs: DataFrame) -> DataFrame:
        """What ``verified`` reads twice, where both ends are looked up."""
        return keep(stored(pairs, "pairs")) if sharp else pairs

    stars = shared.where("node <> leader").select(F.col("leader").alias("a"), F.col("node").alias("b")).distinct()
    stars = stored(tested(stars), "stars")
    # odd sketches leave few pairs that are no links: all are tried at once
    tried = stars if sharp else stars.groupBy("b").agg(F.min("a").alias("a")).select("a", "b")
    take(verified(tried) if given is None else verified(tried).unionByName(given))
    if not sharp:  # only what the first links have left apart asks whether it was tried
        take(verified(_apart(stars, labels).join(tried, ["a", "b"], "left_anti")))

    # one member of each component of a bucket against one of its first component, others each time
    left = None  # a bucket in one component stays so: each turn starts from the buckets that the last one found open
    for turn in range(TURNS):
        before, placed = left, stored(_placed(shared if left is None else left, labels), "open")
        if before is not None:
            drop_stored(before)
        left = placed.select("key", "node")
        one = placed.groupBy("key", "part").agg(F.min_by("node", F.xxhash64("node", F.lit(turn))).alias("node"))
        head = one.groupBy("key").agg(F.min_by("node", "part").alias("a"), F.min("part").alias("part")).alias("h")
        pairs = one.alias("o").join(head, (F.col("o.key") == F.col("h.key")) & (F.col("o.part") != F.col("h.part"))).select(
            F.least("a", "o.node").alias("a"), F.greatest("a", "o.node").alias("b")).distinct()
        if not take(verified(stored_pairs(tested(pairs).join(stars, ["a", "b"], "left_anti")))):
            break

    before, placed = left, stored(_placed(left, labels), "open")
    drop_stored(before)
    core = F.least("x.core", "y.core")
    within = 100 * core >= percent * (F.col("x.n") + F.col("y.n") - core)

    # a bucket of few members makes few pairs
    few = placed.where(F.col("c") <= FEW).join(sketches, "node")
    rest = few.alias("x").join(few.alias("y"), (F.col("x.key") == F.col("y.key")) & (F.col("x.part") < F.col("y.part"))
                               & alike("x", "y")).select("x.node", F.col("y.node").alias("other"))
    # the members of large buckets: the few outside a cluster's main component against the others
    many = placed.where(F.col("c") > FEW)
    done += [placed, stars]
    if not many.isEmpty():
        least = many.groupBy("key").agg(F.min("node").alias("a"))
        clusters = components(many.join(least, "key").select("a", F.col("node").alias("b")).distinct())
        clusters = stored(clusters.select("node", F.col("component").alias("cluster")), "clusters")
        parts = stored(many.select("node", "part").distinct().join(clusters, "node"), "parts")
        each = stored(listed(clusters), "listed")
        counted = each.groupBy("node").agg(F.count("*").alias("n")) if sizes is None else sizes
        bound, other, rare = _cores(clusters, counted, each, parts, rare_in)
        odd = sketches if sharp else odd_sketches(each).join(sketches, "node")
        marked = stored(odd.drop("n").join(bound, "node"), "marked")
        main = parts.groupBy("cluster", "part").agg(F.count("*").alias("c")).groupBy("cluster").agg(
            F.max_by("part", F.struct("c", "part")).alias("main"))
        near = parts.join(marked, "node").where(100 * F.col("core") >= percent * F.col("n")).join(main, "cluster")
        near = stored(near.withColumn("inner", F.col("part") == F.col("main")), "near")
        outer = near.where("not inner").alias("x").join(
            near.alias("y"), (F.col("x.cluster") == F.col("y.cluster")) & (F.col("x.part") != F.col("y.part"))
            & (F.col("y.inner") | (F.col("x.node") < F.col("y.node"))) & within & _may_reach("x", "y", percent) & alike("x", "y"))
        rest = rest.unionByName(outer.select("x.node", F.col("y.node").alias("other")))
        # written, so that the anti join below comes after these tests
        other = stored(other.join(marked.alias("x"), F.col("a") == F.col("x.node")).join(
            marked.alias("y"), F.col("b") == F.col("y.node")).where(_may_reach("x", "y", percent) & alike("x", "y")).select("a", "b"), "other")
        rest = rest.unionByName(other.select(F.col("a").alias("node"), F.col("b").alias("other")))
        done += [clusters, each, parts, *rare, marked, near, other]
    rest = rest.select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")).distinct()
    rest = rest.join(stars, ["a", "b"], "left_anti")
    if sharp:  # one pair of each node goes ahead, after which most of the others lie within a component
        rest = stored(rest, "rest")
        done.append(rest)
    if sharp and rest.count() > SOME:
        pair = F.struct("a", "b")
        ends = rest.select(F.explode(F.array("a", "b")).alias("node"), "a", "b")
        ahead = stored(ends.groupBy("node").agg(F.min_by(pair, F.xxhash64("a", "b")).alias("pair")).select("pair.*").distinct(), "ahead")
        done.append(ahead)
        take(verified(ahead))
        rest = stored_pairs(_apart(rest, labels).join(ahead, ["a", "b"], "left_anti"))
    take(verified(rest))
    for table in done:
        drop_stored(table)
    return labels
