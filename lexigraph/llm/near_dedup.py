"""MinHash near-dedup with bottom-k sketches from one hash function.

A document's set is its distinct shingles, as 64-bit hashes in order; its sketch the SKETCH
smallest of them. Documents are linked if their sets' Jaccard similarity reaches THRESHOLD.

1. Documents with equal sets form a class; only classes go on.
2. Inverted lists: a class stands in a list for every two neighbouring values of its sketch.
   Sets that are linked have at least four shared values for each differing one, so by the
   pigeonhole principle two shared values are neighbours in both: among sets that fit the sketch
   none is missed. Among larger ones a pair at the threshold goes unseen with a chance of up to
   6.1e-9 here and 4.4e-9 at the estimate, reached when one set holds the other.
3. Linked sets that fit their sketches share 3/5 of their lists less one, larger ones far more than
   SHARED of them, so a class needs only the rarest of its lists to meet its partners (prefix
   filter). That leaves out lists of a passage or phrase that many documents hold without being
   alike, and drops no link.
4. STARS times, each class is compared with the class that leads most of its lists, unless they are
   in one component already or a member of the class's component has led before. A list is led by
   the class that meets most others: of a text and its edited copies that is the text. The union
   of two sketches estimates their similarity; pairs that may reach the threshold are verified on
   full sets. Links make components.
5. Classes whose lists still hold several components are joined on their full sets: in the order of
   rarity among them, linked sets of n and m values share one of their first values, at places that
   leave t (n + m) / (1 + t) behind (prefix and positional filter, exact). An edited copy's own
   values come first, so copies that are too far from each other never meet, however many there
   are. Pairs of different components are estimated and verified as before: no link between
   components is lost, and the pairs inside a large group of near copies are never made.

Defined cases: a document with fewer words than a shingle is one shingle; without words its set is
empty and linked with nothing. Rows with a NULL doc_id take the component of their class (NULL
without another member) and lead none; rows that repeat a doc_id are judged by their own text and
belong together through it. Other columns take no part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from lexigraph.llm.common import let, lower_ascii, split_words, written
from lexigraph.operators.keyed import broadcast_if_bounded

SHINGLE = 5
THRESHOLD = 80  # hundredths
SKETCH = 64
SHARED = 0.2
MARGIN = 0.32  # more than six standard deviations of an estimate from SKETCH values
STARS = 2
ROUNDS = 60


def shingle_set(text: Column, n: int) -> Column:
    """Sorted hashes of the distinct runs of ``n`` words."""
    words = split_words(lower_ascii(text))

    def hashes(w: Column) -> Column:
        runs = F.transform(
            F.sequence(F.lit(0), F.size(w) - n), lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(n)])
        )
        return (
            F.when(F.size(w) >= n, runs)
            .when(F.size(w) > 0, F.array(F.xxhash64(w)))
            .otherwise(F.array().cast("array<bigint>"))
        )

    return F.sort_array(F.array_distinct(let(words, hashes)))


def union_estimate(s: Column, t: Column, n_x: Column, n_y: Column, k: int) -> Column:
    """Share of the union's smallest k values that both sketches hold; exact for whole sets of
    ``n_x`` and ``n_y`` values."""
    def of(both: Column, shared: Column) -> Column:
        last = F.element_at(F.sort_array(both), k)
        cut = F.size(F.filter(shared, lambda v: v <= last)) / F.lit(float(k))
        return F.when((n_x <= k) & (n_y <= k), F.size(shared) / F.size(both)).otherwise(cut)

    return let(F.array_intersect(s, t), lambda shared: let(F.array_union(s, t), lambda both: of(both, shared)))


def _similar_sizes(threshold: int) -> Column:
    return F.least("n_x", "n_y") * 100 >= F.greatest("n_x", "n_y") * threshold


def _may_link(pairs: DataFrame, sketches: DataFrame, threshold: int, k: int) -> DataFrame:
    """``pairs`` (x, y) whose sketches leave a link possible."""
    one = sketches.select(F.col("class").alias("x"), F.col("sketch").alias("s"), F.col("n").alias("n_x"))
    two = sketches.select(F.col("class").alias("y"), F.col("sketch").alias("t"), F.col("n").alias("n_y"))
    need = threshold / 100
    least = F.when((F.col("n_x") <= k) & (F.col("n_y") <= k), need - 1e-9).otherwise(need - MARGIN)
    estimate = union_estimate(F.col("s"), F.col("t"), F.col("n_x"), F.col("n_y"), k)
    # nothing is grouped here, so the rows of a class that many are compared with can be split
    found = pairs.join(one, "x").join(two, "y").where(_similar_sizes(threshold) & (estimate >= least))
    return written(found.select("x", "y"), "possible-pairs")


def _verified(pairs: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """``pairs`` whose full sets are similar enough."""
    one = sets.select(F.col("class").alias("x"), F.col("set").alias("s"))
    two = sets.select(F.col("class").alias("y"), F.col("set").alias("t"))
    both = F.size(F.array_intersect("s", "t"))
    return (
        pairs.join(one, "x").join(two, "y")
        .where(both * 100 >= (F.size("s") + F.size("t") - both) * threshold)
        .select("x", "y")
    )


def components(nodes: DataFrame, edges: DataFrame, name: str = "components") -> DataFrame:
    """``class, comp``: the smallest class that each of ``nodes`` reaches over ``edges`` (x, y).

    Labels travel along edges and are then shortened to the label's own label; every round is a
    table in the shared folder, so a lost executor costs at most one round.
    """
    both = written(
        edges.select("x", "y").unionByName(edges.select(F.col("y").alias("x"), F.col("x").alias("y"))).distinct(),
        f"{name}-edges",
    )
    labels = written(nodes.select("class", F.col("class").alias("comp")), f"{name}-0")
    if both.isEmpty():
        return labels
    # only nodes with an edge ever change
    ends = both.select(F.col("x").alias("class")).distinct()
    active = written(ends.select("class", F.col("class").alias("comp")), f"{name}-active")
    for turn in range(1, ROUNDS + 1):
        heard = (
            both.join(active.withColumnRenamed("class", "x"), "x")
            .groupBy(F.col("y").alias("class")).agg(F.min("comp").alias("heard"))
        )
        stepped = written(
            active.join(heard, "class").select("class", F.least("comp", "heard").alias("comp"),
                                               (F.col("heard") < F.col("comp")).alias("moved")),
            f"{name}-{turn}-step",
        )
        if stepped.where("moved").isEmpty():
            break
        jump = stepped.select(F.col("class").alias("comp"), F.col("comp").alias("to"))
        active = written(stepped.join(jump, "comp").select("class", F.col("to").alias("comp")), f"{name}-{turn}")
    else:
        raise RuntimeError(f"components did not settle in {ROUNDS} rounds")
    found = active.select("class", F.col("comp").alias("_found"))
    return written(
        labels.join(found, "class", "left").select("class", F.coalesce("_found", "comp").alias("comp")), f"{name}-all"
    )


def _lists(classes: DataFrame) -> DataFrame:
    """class, key, central: the shared lists in which each class needs to stand, and how many
    others it meets in all its lists."""
    sketch = F.col("sketch")
    keys = F.transform(
        F.sequence(F.lit(0), F.size(sketch) - 2), lambda i: F.xxhash64(F.get(sketch, i), F.get(sketch, i + 1))
    )
    stood = classes.where(F.size(sketch) > 1).select("class", F.size(sketch).alias("m"), F.explode(keys).alias("key"))
    sizes = written(
        stood.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > 1), "list-sizes"
    )
    found = stood.join(sizes, "key").groupBy("class", "m").agg(
        F.sort_array(F.collect_list(F.struct("size", "key"))).alias("found"),  # fewer than SKETCH
        (F.sum("size") - F.count(F.lit(1))).alias("central"),
    )
    lists = F.col("m") - 1
    # Of i shared values at most i / 4 neighbourhoods are broken by a value that differs, and i is
    # at least 4 / 5 of the set: whole sets share 3 / 5 of their lists, less one.
    whole = F.floor(F.col("m") * 0.4) + 1
    need = F.when(F.col("m") < 0.8 * SKETCH, whole).otherwise(F.ceil(lists * (1 - SHARED)) + 1)
    # lists of their own come first in rarity
    left = F.greatest(F.lit(0), need - (lists - F.size("found"))).cast("int")
    kept = F.transform(F.slice("found", F.lit(1), left), lambda x: x.key)
    return found.select("class", "central", F.explode(kept).alias("key"))


def _led(members: DataFrame) -> DataFrame:
    """(x, y): each class with the class that leads most of its lists. A list is led by the member
    that meets most others: of a text and its edited copies that is the text."""
    lead = F.max(F.struct("central", (-F.col("class")).alias("low"), "comp")).alias("lead")
    leads = written(members.groupBy("key").agg(lead).select("key", "lead.*"), "leads")
    own = leads.select("key", (-F.col("low")).alias("y"), F.col("comp").alias("led_by"))
    return (
        members.join(own, "key").where(F.col("comp") != F.col("led_by"))
        .groupBy(F.col("class").alias("x"), "y").agg(F.count(F.lit(1)).alias("votes"))
        .groupBy("x").agg(F.max_by("y", F.struct("votes", "y")).alias("y"))
    )


def _mixed(members: DataFrame, comps: DataFrame, name: str) -> DataFrame:
    """Members of the lists in which several components stand."""
    placed = written(members.drop("comp").join(comps, "class"), f"{name}-placed")
    several = written(
        placed.groupBy("key").agg(F.min("comp").alias("a"), F.max("comp").alias("b"))
        .where(F.col("a") < F.col("b")).select("key"),
        f"{name}-several",
    )
    return written(placed.join(several, "key", "left_semi"), name)


def _full_sets(docs: DataFrame, ids: DataFrame, shingle: int) -> DataFrame:
    """``class, set, n, set_id`` of the classes in ``ids``, from their leading documents' texts.

    Only those texts are cut again. Their ids are broadcast if a probe proves them few; else the
    texts are shuffled once.
    """
    ids = written(ids.distinct(), "compared")
    own = docs.select(F.col("doc_id").cast("bigint").alias("class"), "text")
    own = own.join(broadcast_if_bounded(ids)[0], "class", "left_semi")
    sets = own.select("class", let(shingle_set(F.col("text"), shingle), lambda s: F.struct(
        s.alias("set"), F.size(s).alias("n"), F.xxhash64(s).alias("set_id")
    )).alias("s"))
    return written(sets.select("class", "s.*"), "full-sets")


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("x").alias("class")).unionByName(pairs.select(F.col("y").alias("class")))


def _crossing(sets: DataFrame, comps: DataFrame, threshold: int) -> DataFrame:
    """Pairs (x, y) of different components that may be linked, by their full ``sets``."""
    # a class has several sets if its id is repeated with other texts
    own = ["class", "set_id"]
    values = sets.select("class", "set_id", "n", F.explode("set").alias("value"))
    often = written(
        values.groupBy("value").agg(F.count(F.lit(1)).alias("often")).where(F.col("often") > 1), "frequent-values"
    )
    # values of one class come before all others and meet nobody
    common = values.join(often, "value")
    rarest = Window.partitionBy(*own).orderBy("often", "value")
    kept = F.ceil(F.col("n") * (threshold / 100) - 1e-9)
    first = written(
        common.withColumn("rank", F.row_number().over(rarest))
        .withColumn("alone", F.col("n") - F.count(F.lit(1)).over(Window.partitionBy(*own)))
        .withColumn("place", F.col("alone") + F.col("rank"))
        .where(F.col("place") <= F.col("n") - kept + 1)
        .join(comps, "class").select("value", "class", "comp", "n", "place"),
        "first-values",
    )
    one = first.select("value", *_renamed(("class", "comp", "n", "place"), ("x", "c", "n_x", "i")))
    two = first.select("value", *_renamed(("class", "comp", "n", "place"), ("y", "d", "n_y", "j")))
    behind = 1 + F.least(F.col("n_x") - F.col("i"), F.col("n_y") - F.col("j"))
    need = F.ceil((F.col("n_x") + F.col("n_y")) * (threshold / (100 + threshold)) - 1e-9)
    found = one.join(
        two,
        (one["value"] == two["value"]) & (F.col("c") < F.col("d")) & _similar_sizes(threshold) & (behind >= need),
    )
    return written(found.select("x", "y").distinct(), "cross-pairs")


def _renamed(columns: tuple[str, ...], names: tuple[str, ...]) -> list[Column]:
    return [F.col(c).alias(n) for c, n in zip(columns, names)]


def near_groups(
    docs: DataFrame, shingle: int = SHINGLE, threshold: int = THRESHOLD, sketch: int = SKETCH
) -> DataFrame:
    """doc_id, n_shingles, component_id, kept, and the set's hashes k1, k2: a row per row of
    ``docs``."""
    same = ["n", "k1", "k2"]
    marked = written(
        docs.select(F.col("doc_id").cast("bigint"), let(shingle_set(F.col("text"), shingle), lambda s: F.struct(
            F.size(s).alias("n"), F.xxhash64(s).alias("k1"), F.xxhash64(F.lit("2"), s).alias("k2"),
            F.slice(s, 1, sketch).alias("sketch"),
        )).alias("m")).select("doc_id", "m.*"),
        "sketches",
    )
    classes = written(
        marked.where(F.col("n") > 0).groupBy(*same).agg(F.min("doc_id").alias("class")), "classes"
    )
    # The class's smallest id stands for it. An id that is repeated with other texts stands for
    # several sets and so joins them.
    firsts = written(
        marked.join(classes.withColumnRenamed("class", "doc_id"), ["doc_id", *same], "left_semi")
        .select(F.col("doc_id").alias("class"), "n", "sketch").distinct(),
        "leaders",
    )
    members = _lists(firsts.select("class", "sketch"))
    nodes = firsts.select("class").distinct()
    comps = nodes.select("class", F.col("class").alias("comp"))
    links = leaders = None
    for turn in range(1, STARS + 1):
        members = _mixed(members, comps, f"star-{turn}")
        voters = members
        if leaders is not None:  # they have been compared; now the others elect
            had = written(comps.join(leaders, "class").select("comp").distinct(), f"star-{turn}-had")
            voters = members.join(had, "comp", "left_anti")
        led = written(_led(voters), f"star-{turn}-led")
        pairs = _may_link(led, firsts, threshold, sketch)
        found = _verified(pairs, _full_sets(docs, _ends(pairs), shingle), threshold)
        links = written(found if links is None else links.unionByName(found), f"star-{turn}-links")
        comps = components(nodes, links, f"star-{turn}")
        leaders = led.select(F.col("y").alias("class")).distinct()

    sets = _full_sets(docs, _mixed(members, comps, "rest").select("class"), shingle)
    pairs = _may_link(_crossing(sets, comps, threshold), firsts, threshold, sketch)
    links = written(links.unionByName(_verified(pairs, sets, threshold)), "links")
    comps = components(nodes, links, "groups")

    known = written(classes.join(comps, "class", "left").select(*same, "comp"), "class-components")
    rows = marked.select("doc_id", *same).join(known, same, "left")
    component = F.coalesce("comp", F.when(F.col("n") == 0, F.col("doc_id")))
    return rows.select(
        "doc_id", F.col("n").cast("bigint").alias("n_shingles"), component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(False)).alias("kept"), "k1", "k2",
    )


def drop_near_copies(docs: DataFrame, shingle: int = SHINGLE, threshold: int = THRESHOLD) -> DataFrame:
    """One document of each component: the one with the smallest id; of rows that repeat its id,
    all that carry the same id stay. Rows without an id stay, as none can stand for them."""
    groups = near_groups(docs, shingle, threshold)
    gone = written(groups.where(~F.col("kept") & F.col("doc_id").isNotNull()).select("doc_id").distinct(), "near-copies")
    # texts are moved only if the ids are too many to send
    return docs.join(broadcast_if_bounded(gone)[0], "doc_id", "left_anti")
