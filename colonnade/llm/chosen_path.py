"""Near duplicates by a chosen-path set similarity join with exact confirmation.

A document is the set of its distinct shingles of ``SHINGLE`` words. ``TREES`` independent trees branch
documents by minwise tokens: the path of a document in a tree is its minwise token under the tree's first
hash, then its second, and so on. A node of at most ``SMALL`` sets is a leaf and is compared exhaustively;
a larger one branches again by the next token. Two sets of similarity s share a path of depth d with
probability s^d, so trees are repeated until the recall aimed at is met (``recall``). Nodes that stay large at
``DEPTH`` hold sets that are alike: they are linked by a star around their centre, the member with the fewest elements of its own,
and after that only members that are not yet in one component are compared. There, what each set has in common with the
centre, and the elements outside the centre that both hold, bound what two sets can share, which spares most comparisons of
sets that only resemble each other.

Equal sets are one vertex, so copies never make pairs. Candidates whose sizes or minwise signatures rule the
threshold out are dropped; the others are confirmed on full sets, in rounds, leaving out pairs whose
ends already are in one component (their link would change nothing).

Defined cases: null text, or text without words: the empty set, linked with nothing. Fewer words than a
shingle: the whole sequence is the only element. Null doc_ids take part; a component of null ids only has a
null component_id, and its rows are kept. Rows that share a doc_id are told apart by their sets. Other
columns are ignored.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from colonnade.llm import common
from colonnade.plans.components import connected_components
from colonnade.session import BROADCAST, held_conf, least_broadcast, materialize, materialize_with

SHINGLE = 4
THRESHOLD = 80  # per cent
DEPTH = 4
RECALL = 0.9999  # of pairs at the threshold, also of those that meet only in nodes at ``DEPTH``
SMALL = 32
FIRST = 4  # partners of a set that are compared before components are looked at
MISS = 1e-7  # chance that a pair at the threshold fails the signature test
RELATION = 1 << 20  # most bytes of files that a join may broadcast; the driver's relation is about eight times as large, and it holds several

MULTIPLIERS = common.mix(np.arange(1, 1 << 12, dtype=np.uint64)) | np.uint64(1)


def trees_for(target: float, similarity: float, depth: int) -> int:
    """The fewest trees in which a pair of that similarity meets at the given depth with probability ``target``."""
    return math.ceil(math.log(1 - target) / math.log(1 - similarity ** depth))


TREES = trees_for(RECALL, THRESHOLD / 100, DEPTH)


def recall(similarity: float, trees: int = TREES, depth: int = 1) -> float:
    """Chance that a pair meets in a node of the given depth in at least one tree."""
    return 1 - (1 - similarity ** depth) ** trees


def least_agreement(functions: int, threshold: float, miss: float = MISS) -> int:
    """The most agreeing minwise tokens that can be asked for so that a pair at the threshold falls below with
    probability ``miss`` at most."""
    below, k = 0.0, 0
    while k <= functions:
        below += math.comb(functions, k) * threshold ** k * (1 - threshold) ** (functions - k)
        if below > miss:
            return k
        k += 1
    return functions


def shingle_sets(column: pa.Array, size: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    raw, off = common.utf8(column)
    raw = common.lower_bytes(raw)
    start, end, row = common.words(raw, off)
    w = common.span_hashes(raw, start, end)
    n = len(off) - 1
    first = np.searchsorted(row, np.arange(n + 1))
    code = np.zeros(max(len(w) - size + 1, 0), np.uint64)
    for k in range(size):
        code = code * np.uint64(common.BASE) + w[k:k + len(code)]
    code = common.mix(code)
    out = []
    for i in range(n):
        a, z = int(first[i]), int(first[i + 1])
        if z - a >= size:
            out.append(np.unique(code[a:z - size + 1]))
        elif z > a:
            short = np.uint64(z - a)
            for x in w[a:z]:
                short = common.mix(np.array([short ^ x]))[0]
            out.append(np.array([short]))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def minwise(s: np.ndarray, functions: int) -> np.ndarray:
    """The minwise token of a set under each hash function."""
    out = np.full(functions, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(s), 4096):
        np.minimum(out, (s[None, i:i + 4096] * MULTIPLIERS[:functions, None]).min(1), out=out)
    return out


def set_name(s: np.ndarray) -> bytes:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest()


def describe(docs: DataFrame, size: int, functions: int) -> DataFrame:
    """doc_id, mark (of the text), n (set size), name (128-bit fingerprint of the set) and sig (minwise tokens) of
    every row."""

    def run(batches):
        for b in common.pieces(batches):
            sets = shingle_sets(b.column("text"), size)
            sig = [minwise(s, functions).view(np.int64) if len(s) else None for s in sets]
            yield pa.record_batch([b.column("doc_id"), b.column("mark"), pa.array([len(s) for s in sets], pa.int64()),
                                   pa.array([set_name(s) for s in sets], pa.binary()), pa.array(sig, pa.list_(pa.int64()))],
                                  ["doc_id", "mark", "n", "name", "sig"])

    kind = dict(docs.dtypes)["doc_id"]
    text = common.text_of(docs)
    rows = docs.select("doc_id", F.xxhash64(text).alias("mark"), text.alias("text"))
    return rows.mapInArrow(run, f"doc_id {kind}, mark long, n long, name binary, sig array<long>")


def full_sets(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """(name, members) of the sets named in ``wanted`` (name, doc_id of one holder)."""

    def run(batches):
        for b in common.pieces(batches):
            sets = shingle_sets(b.column("text"), size)
            yield pa.record_batch([pa.array([set_name(s) for s in sets], pa.binary()), pa.array([s.tobytes() for s in sets], pa.binary())], ["name", "members"])

    rows = docs.select("doc_id", common.text_of(docs).alias("text"))
    ids = wanted.select(F.col("doc_id").alias("w_id")).distinct()
    held = rows.join(ids, rows["doc_id"].eqNullSafe(ids["w_id"]), "left_semi").select("text").mapInArrow(run, "name binary, members binary")
    return held.join(wanted.select("name").distinct(), "name", "left_semi").groupBy("name").agg(F.first("members").alias("members"))


def branch(sets: DataFrame, trees: int, depth: int, small: int) -> tuple[DataFrame | None, DataFrame | None]:
    """The leaves (node, name) of all trees with at least two sets, and the nodes that stay large at ``depth``."""
    tree = F.explode(F.sequence(F.lit(0), F.lit(trees - 1)))
    rows = sets.select("name", "sig", tree.alias("tree")).select(
        "name", "tree", F.expr(f"slice(sig, tree * {depth} + 1, {depth})").alias("tokens"))
    leaves = None
    for level in range(1, depth + 1):
        path = F.xxhash64("tree", F.lit(level), F.slice("tokens", 1, level))
        rows = rows.withColumn("node", path)
        sizes = rows.groupBy("node").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
        rows, seen = materialize_with(rows.join(sizes, "node"), "tree-level", large=F.count_if(F.col("size") > small))
        own = rows.filter(F.col("size") <= small).select("node", "name")
        leaves = own if leaves is None else leaves.unionByName(own)
        rows = rows.filter(F.col("size") > small)
        if not seen["large"]:
            return leaves, None
        if level < depth:
            rows = rows.drop("node", "size")
    return leaves, rows.select("node", "name")


def common_elements(members: DataFrame) -> DataFrame:
    """(name, shared): how many elements of each set another of the given sets holds too."""

    def run(batches):
        for b in batches:
            each = [np.frombuffer(x.as_buffer(), np.int64) for x in b.column("members")]
            for i in range(0, len(each), 256):
                part = each[i:i + 256]
                yield pa.record_batch([b.column("name").take(pa.array(np.repeat(np.arange(i, i + len(part)), [len(x) for x in part]))),
                                       pa.array(np.concatenate(part))], ["name", "element"])

    elements = members.mapInArrow(run, "name binary, element long")
    twice = elements.groupBy("element").agg(F.count(F.lit(1)).alias("k")).filter("k > 1").select("element")
    return elements.join(twice, "element").groupBy("name").agg(F.count(F.lit(1)).alias("shared"))


def centres(dense: DataFrame, sets: DataFrame) -> DataFrame:
    """(node, centre): in every dense node the member with the fewest elements of its own. ``dense`` has node, name, shared."""
    own = dense.join(sets.select("name", "n"), "name").withColumn("lone", F.col("n") - F.col("shared"))
    return own.groupBy("node").agg(F.min_by("name", F.struct("lone", "name")).alias("centre"))


def candidate_pairs(leaves: DataFrame, dense: DataFrame | None) -> DataFrame:
    """Distinct pairs (a < b): all pairs of a leaf, and in every dense node a star around its centre. ``dense`` has node, name, centre."""
    x, y = leaves.select("node", F.col("name").alias("a")), leaves.select("node", F.col("name").alias("b"))
    pairs = x.join(y, "node").filter("a < b").select("a", "b")
    if dense is not None:
        star = dense.filter("name <> centre")
        pairs = pairs.union(star.select(F.least("name", "centre").alias("a"), F.greatest("name", "centre").alias("b")))
    return pairs.distinct()


def plausible(n_a, n_b, sig_a, sig_b, functions: int, threshold: int):
    """Whether sizes and signatures leave the threshold possible, and the agreeing tokens."""
    agree = F.size(F.filter(F.zip_with(sig_a, sig_b, lambda x, y: x == y), lambda same: same))
    fits = F.least(n_a, n_b) * 100 >= F.greatest(n_a, n_b) * threshold
    return agree, fits & (agree >= least_agreement(functions, threshold / 100))


def prune(pairs: DataFrame, sets: DataFrame, functions: int, threshold: int) -> DataFrame:
    """(a, b, agree) of the pairs that may reach the threshold."""
    a = sets.select(F.col("name").alias("a"), F.col("n").alias("n_a"), F.col("sig").alias("sig_a"))
    b = sets.select(F.col("name").alias("b"), F.col("n").alias("n_b"), F.col("sig").alias("sig_b"))
    agree, fits = plausible(F.col("n_a"), F.col("n_b"), F.col("sig_a"), F.col("sig_b"), functions, threshold)
    return pairs.join(a, "a").join(b, "b").filter(fits).select("a", "b", agree.alias("agree"))


def confirm(pairs: DataFrame, members: DataFrame, threshold: int) -> DataFrame:
    """The pairs (a, b) with 100 * intersection >= threshold * union on full sets."""

    def run(batches):
        for b in batches:
            keep = []
            for x, y in zip(b.column("x"), b.column("y")):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                at = np.minimum(np.searchsorted(y, x), len(y) - 1)
                shared = int((y[at] == x).sum())
                keep.append(100 * shared >= threshold * (len(x) + len(y) - shared))
            yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b")], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    both = (pairs.select("a", "b").join(members.select(F.col("name").alias("a"), F.col("members").alias("x")), "a")
            .join(members.select(F.col("name").alias("b"), F.col("members").alias("y")), "b"))
    return both.select("a", "b", "x", "y").mapInArrow(run, "a binary, b binary")


def labelled(pairs: DataFrame, components: DataFrame) -> DataFrame:
    """``pairs`` with the components of both ends (a set without a link is its own)."""
    c = components
    return (pairs.join(c.select(F.col("vertex").alias("a"), F.col("component").alias("ca")), "a", "left")
            .join(c.select(F.col("vertex").alias("b"), F.col("component").alias("cb")), "b", "left")
            .withColumns({"ca": F.coalesce("ca", "a"), "cb": F.coalesce("cb", "b")}))


def resolve(pairs: DataFrame, members: DataFrame, threshold: int, components: DataFrame | None) -> DataFrame | None:
    """Components after every pair that joins two components has been confirmed or refused: first the pairs in which a set
    agrees best with another (``FIRST`` of each), then all others whose ends have not met by those."""
    order = Window.partitionBy("a").orderBy(F.col("agree").desc(), "b")
    ranked, seen = materialize_with(pairs.select("a", "b", F.row_number().over(order).alias("rank")), "ranked", last=F.max("rank"))
    rounds = [F.col("rank") <= FIRST, F.col("rank") > FIRST]
    for some in rounds if (seen["last"] or 0) > FIRST else rounds[:1]:
        batch = ranked.filter(some).select("a", "b")
        if components is not None:
            batch = labelled(batch, components).filter("ca <> cb").select("a", "b")
        links, found = materialize_with(confirm(batch, members, threshold), "links")
        if found["rows"]:
            edges = links.select(F.col("a").alias("u"), F.col("b").alias("v"))
            if components is not None:
                edges = edges.union(components.select(F.col("vertex").alias("u"), F.col("component").alias("v")))
            components = materialize(connected_components(edges), "components")
    return components


def against_centre(ties: DataFrame, members: DataFrame) -> DataFrame:
    """(name, centre, k, other): of each tie (name, centre), how many elements the centre holds too, and the other elements."""

    def run(batches):
        for b in batches:
            k, other = [], []
            for x, c in zip(b.column("x"), b.column("c")):
                x, c = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(c.as_buffer(), np.uint64)
                held = c[np.minimum(np.searchsorted(c, x), len(c) - 1)] == x
                k.append(int(held.sum()))
                other.append(x[~held].view(np.int64))
            yield pa.record_batch([b.column("name"), b.column("centre"), pa.array(k, pa.int64()), pa.array(other, pa.list_(pa.int64()))], ["name", "centre", "k", "other"])

    both = ties.join(members.select("name", F.col("members").alias("x")), "name").join(members.select(F.col("name").alias("centre"), F.col("members").alias("c")), "centre")
    return both.select("name", "centre", "x", "c").mapInArrow(run, "name binary, centre binary, k long, other array<long>")


def rest_of_dense(dense: DataFrame, members: DataFrame, components: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """Pairs inside dense nodes whose ends are in different components and that may reach the threshold. Nodes with the same centre
    are one group; in each, members outside its largest component meet all members. Two sets share at most the elements that
    each has in common with the centre, and the elements outside the centre that both hold: the first bound alone lets few pairs
    through, all others have such elements, and are found by the rarest of them (a prefix filter)."""
    own = dense.select("centre", "name", "shared").distinct().join(components.withColumnRenamed("vertex", "name"), "name", "left").join(sets.select("name", "n"), "name")
    own = own.withColumn("component", F.coalesce("component", "name"))
    main = own.groupBy("centre", "component").agg(F.count(F.lit(1)).alias("size")).groupBy("centre").agg(
        F.max_by("component", F.struct("size", "component")).alias("main"), F.count(F.lit(1)).alias("parts")).filter("parts > 1").drop("parts")
    within = own.join(main, "centre").filter(F.col("shared") * 100 >= F.col("n") * threshold)  # else it is like no other member
    within = materialize(within.withColumn("out", F.col("component") != F.col("main")).select("centre", "name", "n", "component", "out"), "dense-members")
    tied = materialize(within.join(against_centre(within.select("name", "centre"), members), ["name", "centre"]), "dense-ties")
    # elements outside the centre that another member holds too, the rarest first, and how many of them a link needs at least
    each = tied.select("centre", "name", F.explode("other").alias("element"))
    twice = each.groupBy("centre", "element").agg(F.count(F.lit(1)).alias("holders")).filter("holders > 1")
    rare = each.join(twice, ["centre", "element"]).groupBy("centre", "name").agg(F.array_sort(F.collect_list(F.struct("holders", "element"))).alias("rare"))
    least = tied.groupBy("centre").agg(F.min("n").alias("least_n"))
    member = tied.drop("other").join(rare, ["centre", "name"], "left").join(least, "centre").withColumn(
        "rare", F.coalesce(F.transform("rare", lambda e: e["element"]), F.array().cast("array<long>")))
    member = member.withColumn("wants", F.ceil((F.col("n") + F.col("least_n")) * threshold / (100 + threshold)) - F.col("k"))
    member = materialize(member.filter(F.size("rare") >= F.col("wants")), "dense-rare")  # the others reach no member's threshold
    x = member.filter("out").select("centre", F.col("name").alias("a"), F.col("component").alias("ca"), F.col("n").alias("na"), F.col("k").alias("ka"), F.col("rare").alias("ra"), "wants")
    y = member.select("centre", F.col("name").alias("b"), F.col("component").alias("cb"), F.col("n").alias("nb"), F.col("k").alias("kb"), F.col("rare").alias("rb"))
    enough = lambda k: k * (100 + threshold) >= (F.col("na") + F.col("nb")) * threshold
    by_centre = x.drop("ra", "wants").join(y.drop("rb"), "centre").filter((F.col("ca") != F.col("cb")) & enough(F.least("ka", "kb"))).select("a", "b")
    # who shares as many of them as it wants shares one of all but so many of the rarest
    first = F.slice("ra", 1, F.size("ra") - F.greatest("wants", F.lit(1)).cast("int") + 1)
    held = x.filter(F.size("ra") > 0).withColumn("element", F.explode(first)).drop("wants").join(y.withColumn("element", F.explode("rb")), ["centre", "element"]).filter("ca <> cb")
    met = held.groupBy("centre", "a", "b", "na", "nb", "ka", "kb").agg(F.any_value("ra").alias("ra"), F.any_value("rb").alias("rb"))
    by_element = met.filter(enough(F.least("ka", "kb") + F.size(F.array_intersect("ra", "rb")))).select("a", "b")
    pairs = by_centre.union(by_element)
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def classes(docs: DataFrame, size: int, threshold: int, trees: int, depth: int, small: int) -> tuple[DataFrame, DataFrame]:
    """The described rows, and (name, least): the smallest doc_id of the component of every set."""
    functions = trees * depth
    rows = materialize(describe(docs, size, functions), "sets")
    sets = materialize(rows.filter("n > 0").groupBy("name").agg(F.min("doc_id").alias("doc_id"), F.first("n").alias("n"), F.first("sig").alias("sig")), "set-names")
    leaves, dense = branch(sets, trees, depth, small)
    members = None
    if dense is not None:
        members = materialize(full_sets(docs, sets.select("name", "doc_id").join(dense.select("name").distinct(), "name", "left_semi"), size), "dense-sets")
        shared = materialize(common_elements(members), "shared")
        dense = dense.join(shared, "name")  # a set that shares nothing has no link here
        dense = materialize(dense.join(centres(dense, sets), "node"), "dense")
    pairs, seen = materialize_with(prune(candidate_pairs(leaves, dense), sets, functions, threshold), "pairs")
    components = None
    if seen["rows"]:
        used = pairs.select(F.col("a").alias("name")).union(pairs.select("b")).distinct()
        if members is not None:
            used = used.join(members.select("name"), "name", "left_anti")
        more = materialize(full_sets(docs, sets.select("name", "doc_id").join(used, "name", "left_semi"), size), "members")
        members = more if members is None else members.unionByName(more)
        components = resolve(pairs, members, threshold, None)
    if dense is not None:
        if components is None:
            components = docs.sparkSession.createDataFrame([], "vertex binary, component binary")
        rest = rest_of_dense(dense, members, components, sets, threshold)
        more = materialize(prune(rest.join(pairs.select("a", "b"), ["a", "b"], "left_anti"), sets, functions, threshold), "dense-pairs")
        components = resolve(more, members, threshold, components)
    if components is None:
        own = rows.withColumn("component_id", F.col("doc_id"))
        totals = sets.select("name", F.col("doc_id").alias("least"))
    else:
        own = rows
        named = sets.join(components.select(F.col("vertex").alias("name"), "component"), "name", "left").withColumn("component", F.coalesce("component", "name"))
        least = named.groupBy("component").agg(F.min("doc_id").alias("least"))
        totals = named.select("name", "component").join(least, "component").select("name", "least")
    return own, materialize(totals, "classes")


def near_duplicates(docs: DataFrame, size: int = SHINGLE, threshold: int = THRESHOLD, trees: int = TREES, depth: int = DEPTH,
                    small: int = SMALL) -> DataFrame:
    """One row per row of ``docs``: doc_id, mark (64-bit fingerprint of its text), n_shingles, set_name, component_id, kept."""
    with held_conf(docs.sparkSession, BROADCAST, least_broadcast(docs.sparkSession, RELATION)):
        own, multiple = classes(docs, size, threshold, trees, depth, small)
    out = own.select("doc_id", "mark", "n", "name").join(multiple.hint("merge"), "name", "left")  # as many rows as sets
    component = F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("least"))
    return out.select("doc_id", "mark", F.col("n").alias("n_shingles"), F.hex("name").alias("set_name"), component.alias("component_id"),
                      F.col("doc_id").eqNullSafe(component).alias("kept"))


def drop_near_duplicates(docs: DataFrame, size: int = 5, threshold: int = THRESHOLD) -> DataFrame:
    """The row of smallest doc_id of every component of ``docs``; all columns stay. Rows equal in id and text stay or
    go together."""
    found = near_duplicates(docs, size, threshold)
    gone = materialize(found.filter("not kept").select(F.col("doc_id").alias("__gone"), F.col("mark").alias("__mark")).distinct(), "near-gone")
    same = docs["doc_id"].eqNullSafe(F.col("__gone")) & (F.xxhash64(common.text_of(docs)) == F.col("__mark"))
    return docs.join(gone, same, "left_anti")
