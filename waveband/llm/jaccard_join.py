"""Jaccard join of word-shingle sets with adaptive multi-match prefixes.

Two documents link when ``100 * intersection >= percent * union`` of their shingle sets. The
tokens (shingle hashes) of a set of n are ordered by hash; a partner shares at least
``overlap = ceil(percent * n / 100)`` of them, so any two linked sets share at least l tokens
among the first ``n - overlap + l`` of each. The steps:

1. One pass hashes all shingles. Equal sets get one node; a node keeps its first tokens, one
   and a half times the shortest prefix and eight more (the *pool*).
2. Tokens of one node only are dropped. A linked node shares pool tokens with its partner, at
   least as many as the two pools have in common for any size of the partner; nodes with fewer
   shared ones go. The full sets of the others are written once.
3. Groups of near copies: each node is compared with up to three other nodes, leading sharers of its
   first tokens: those with the fewest pool tokens of their own, which are nearest to what the group has in
   common, with two (seeded) hashes for ties, and one by hash alone. Verified links make first components,
   at a cost linear in a group's size. Only links between components are still wanted; nodes whose
   tokens are not shared between components go as in step 2, by twice as many tokens.
4. The rest are ordered by cost (how many nodes have a token), then by hash, and a node's prefix is
   lengthened by the estimated number of candidates that its shortest prefix would bring, with
   ``steps`` as bounds: l = 1, 2 or 3. A pair needs as many shared prefix tokens as the smaller l of
   the two. The smaller set of a pair needs the prefix for ``2 * percent / (100 + percent)`` of its
   size only, as its partner is no smaller.
   Every set also has a sketch of :data:`SKETCH_WORDS` 64-bit words: the parity of its tokens' buckets.
   A token that only one of two sets has turns one bit, so the bits that differ are at most the
   tokens that differ. Tokens that no other component has differ too. Components are paired first, by
   bounds over their nodes: least and largest size, fewest tokens of their own, and the bits that all, or
   none, of their sketches have; what differs in those differs in every pair of their nodes.
   Pairs with more than a link allows are dropped inside the join, not after it.
   Before they are paired, components that share a token with more than :data:`CROWD` others are joined in rounds: a set's
   least tokens in each of some buckets make :data:`BANDS` keys, which near sets have in common far more often than others, and a
   node is compared with at most six leaders of its keys from other components. A round's cost is linear in the nodes, and
   components that it joins are no longer paired; rounds end when few are. The pairing after them takes all that is left.
5. Candidates are verified on the full sets; final components come from all links. There is no
   cap on a token's documents, on candidates or on partners.

Tokens and nodes are 64-bit hashes of words; the chance that any two of N different sets share
one is N squared over 2 to the power of 65. Words are compared after lower-casing A-Z.

Defined cases: a text without words (or null) has an empty set and links with nothing; a text
with fewer words than a shingle has the whole sequence as its only one; a row without an id is
linked with nothing and gets no component; rows that repeat an id are linked by their own texts.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waveband.llm import flat
from waveband.llm.components import relabelled, smallest_reachable
from waveband.llm.shared import written

#: bits of the sketch that tells which rows' full sets are needed; it only saves work
SKETCH_BITS = 1 << 22
SKETCH_WORDS = 32
STAR_TOKENS, STAR_SEEDS = 16, (1, 2, 3)
#: components with a token of more components than this are joined in rounds first; a round that joins no more than this share of them is the
#: last: the pairing, which goes by the square, would be spared a third of its work or less by a further one
CROWD, LEAST_JOINED = 16, 0.2
#: keys of a set, and the buckets whose least tokens make one key
BANDS, BAND_BUCKETS = 8, 16
#: SQL of what a set of n needs, for a percentage
_OVERLAP = "((n * {0} + 99) div 100)"
_POOL = "least(n, (n - ((n * {0} + 99) div 100) + 1) + (n - ((n * {0} + 99) div 100) + 1) div 2 + 8)"
#: the second time full sets are there, and more of their tokens tell more
_SECOND = "least(n, 3 * (n - ((n * {0} + 99) div 100) + 1) + 8)"


def _need(pool: str, percent: int) -> str:
    """SQL of the shared tokens that a linked set of n has in its pool at least, over all sizes m of a partner.

    The partner shares tokens from its own pool only, which can be the smaller of the two.
    """
    both = f"(({percent} * (n + m) + {99 + percent}) div {100 + percent})"
    size = pool.format(percent)
    of_m = re.sub(r"\bn\b", "m", size)
    partners = f"sequence((n * {percent} + 99) div 100, n * 100 div {percent})"
    return f"aggregate({partners}, CAST(n AS BIGINT), (least_m, m) -> least(least_m, {size} - n + {both}, {of_m} - m + {both}, {both}))"


def _sets(column: pa.Array, words: int) -> Iterator[tuple[int, int, list[np.ndarray], np.ndarray]]:
    """For each slice of rows: the sorted distinct shingle hashes of each row, and the set hashes."""
    for begin, end, data, offsets in flat.slices(column):
        low = flat.LOWER[data]
        starts, ends = flat.word_spans(~flat.BLANK[low], offsets)
        hashes = flat.word_hashes(low, starts, ends)
        bounds = flat.word_bounds(starts, offsets)
        n = max(len(hashes) - words + 1, 0)
        shingles = np.zeros(n, np.uint64)
        for k in range(words):
            shingles = flat.mix(shingles + np.uint64(k + 1)) + hashes[k : n + k]
        shingles = flat.mix(shingles)
        sets = []
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            if b - a >= words:
                sets.append(np.unique(shingles[a : b - words + 1]))
            elif b > a:
                whole = np.uint64(b - a)
                for h in hashes[a:b]:
                    whole = flat.mix(np.array([whole]) * np.uint64(3) + h)[0]
                sets.append(np.array([whole]))
            else:
                sets.append(np.zeros(0, np.uint64))
        sizes = np.array([len(s) for s in sets])
        spread = flat.mix(np.concatenate([*sets, np.zeros(1, np.uint64)]) ^ np.uint64(0xA0761D6478BD642F))
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(spread, dtype=np.uint64)])
        stop = np.cumsum(sizes)
        yield begin, end, sets, flat.mix(sums[stop] - sums[stop - sizes] + sizes.astype(np.uint64))


def _overlap(n, percent: int):
    return (n * percent + 99) // 100


def _lists(parts: list[np.ndarray]) -> pa.Array:
    sizes = np.array([len(p) for p in parts])
    values = np.concatenate([*parts, np.zeros(0, np.uint64)]).view(np.int64)
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), pa.array(values))


def _parities(sets: list[np.ndarray]) -> list[np.ndarray]:
    """For each set the parity of its tokens in each of 64 * SKETCH_WORDS buckets, as 64-bit words."""
    n = 64 * SKETCH_WORDS
    odd = [np.bincount((s & np.uint64(n - 1)).astype(np.int64), minlength=n) & 1 for s in sets]
    return [np.packbits(o.astype(np.uint8), bitorder="little").view(np.uint64) for o in odd]


def _bands(sets: list[np.ndarray]) -> list[np.ndarray]:
    """For each set BANDS hashes, each of its least tokens in BAND_BUCKETS buckets of their own (0 for an empty bucket)."""
    n, found = BANDS * BAND_BUCKETS, []
    for s in sets:
        least = np.zeros(n, np.uint64)
        buckets, first = np.unique(flat.mix(s) & np.uint64(n - 1), return_index=True)  # a set is sorted, so the first is the least
        least[buckets.astype(np.int64)] = s[first]
        keys = np.arange(BANDS, dtype=np.uint64)
        for column in least.reshape(BANDS, BAND_BUCKETS).T:
            keys = flat.mix(keys * np.uint64(3) + column)
        found.append(keys)
    return found


def _pools(docs: DataFrame, doc_id: str, text: str, words: int, percent: int) -> DataFrame:
    source = docs.select(F.col(text).alias("text"), F.col(doc_id).alias("id"))
    schema = T.StructType([source.schema["id"], T.StructField("n", T.LongType()), T.StructField("node", T.LongType()), T.StructField("pool", T.ArrayType(T.LongType()))])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, end, sets, nodes in _sets(batch.column(0), words):
                pools = []
                for s in sets:
                    base = len(s) - _overlap(len(s), percent) + 1
                    # a set this small links with its equals only, unless one more token keeps the overlap
                    alone = 100 * len(s) < percent * (len(s) + 1)
                    pools.append(s[: 0 if alone else base + base // 2 + 8])
                ids, n = batch.column(1).slice(begin, end - begin), np.array([len(s) for s in sets])
                node = pa.array(nodes.view(np.int64), mask=n == 0)
                yield pa.RecordBatch.from_arrays([ids, pa.array(n.astype(np.int64)), node, _lists(pools)], names=schema.names)

    return source.mapInArrow(run, schema)


def _full_sets(docs: DataFrame, doc_id: str, text: str, words: int, nodes: DataFrame) -> DataFrame:
    """``(node, tokens, sketch, bands, own)`` of the given nodes ``(node, own)``; a bitmap of fixed size keeps most other rows out of the shuffle.

    The sketch has one bit for each value of a node's low bits, so it is at most SKETCH_BITS large for any input.
    """
    bits = nodes.selectExpr(f"shiftright(node & {SKETCH_BITS - 1}L, 6) AS at", "shiftleft(1L, CAST(node & 63L AS INT)) AS bit")
    marked = np.zeros(SKETCH_BITS // 64, np.int64)
    for at, word in bits.groupBy("at").agg(F.bit_or("bit")).collect():
        marked[at] = word
    sketch = docs.sparkSession.sparkContext.broadcast(marked.view(np.uint64))
    source = docs.where(F.col(doc_id).isNotNull()).select(F.col(text).alias("text"))
    longs = T.ArrayType(T.LongType())
    schema = T.StructType([T.StructField("node", T.LongType()), T.StructField("tokens", longs), T.StructField("sketch", longs), T.StructField("bands", longs)])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, sets, hashes in _sets(batch.column(0), words):
                low = (hashes & np.uint64(SKETCH_BITS - 1)).astype(np.int64)
                taken = np.flatnonzero(sketch.value[low >> 6] >> (low & 63).astype(np.uint64) & np.uint64(1))
                seen = {int(hashes[i]): i for i in taken}  # equal sets of a slice once
                taken = np.array(sorted(seen.values()), np.int64)
                chosen = [sets[i] for i in taken]
                yield pa.RecordBatch.from_arrays([pa.array(hashes[taken].view(np.int64)), _lists(chosen), _lists(_parities(chosen)), _lists(_bands(chosen))], names=schema.names)

    first = [F.first(c).alias(c) for c in ("tokens", "sketch", "bands")]
    return source.mapInArrow(run, schema).join(nodes.select("node"), "node", "left_semi").groupBy("node").agg(*first).join(nodes, "node")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs, of nodes ``a`` and ``b``, whose sets link."""
    left = sets.select(F.col("node").alias("a"), F.col("tokens").alias("of_a"))
    right = sets.select(F.col("node").alias("b"), F.col("tokens").alias("of_b"))
    shared = F.size(F.array_intersect("of_a", "of_b"))
    return pairs.join(left, "a").join(right, "b").where(100 * shared >= percent * (F.size("of_a") + F.size("of_b") - shared)).select(*pairs.columns)


def _star_links(sets: DataFrame, percent: int) -> DataFrame:
    """Verified links of each node with one leading sharer of its first tokens for each order of leading."""
    first = sets.select("node", "own", F.explode(F.slice("tokens", 1, STAR_TOKENS)).alias("token"))
    orders = {seed: [F.xxhash64("node", F.lit(seed)), "node"] for seed in STAR_SEEDS}
    for seed in STAR_SEEDS[:2]:
        orders[seed].insert(0, "own")
    leads = [F.min(F.struct(*order))["node"].alias(f"lead_{seed}") for seed, order in orders.items()]
    led = first.join(first.groupBy("token").agg(*leads), "token")
    each = F.explode(F.array(*(F.struct(F.lit(seed).alias("seed"), F.col(f"lead_{seed}").alias("lead")) for seed in STAR_SEEDS)))
    # dealt by node once, for all that follows
    counted = led.select("node", each.alias("x")).select("node", "x.*").where("node <> lead").repartition("node").groupBy("node", "seed", "lead").count()
    best = counted.groupBy("node", "seed").agg(F.max(F.struct("count", "lead"))["lead"].alias("lead"))
    # the lead, which many share, comes last, so that its rows meet it in a join that AQE can split
    return _verified(best.select(F.col("node").alias("a"), F.col("lead").alias("b")).distinct(), sets, percent)


def _bits(of) -> Column:
    return sum((F.bit_count(of(i)) for i in range(SKETCH_WORDS)), F.lit(0))


def _may_link(percent: int) -> Column:
    """Whether a node of a and a larger one of b may link; each is a node, or a component by its bounds.

    ``low`` and ``high`` are bounds of the sizes, ``own`` of the tokens that no other component has, ``some`` has the bits that
    any node's sketch has, ``every`` (null: as ``some``) those that all have. Of equal sizes the one in the smaller component is a.
    """
    c = F.col
    ordered = (c("low_a") < c("high_b")) | ((c("low_a") == c("high_b")) & (c("comp_a") < c("comp_b")))
    sizes = (100 * c("high_a") >= percent * c("low_b")) & (100 * c("high_b") >= percent * c("low_a"))
    allowed = (c("high_a") + c("high_b")) * (100 - percent)
    every = lambda x: F.coalesce(f"every_{x}", f"some_{x}")
    without = lambda x, y, i: every(x)[i].bitwiseAND(F.bitwise_not(c(f"some_{y}")[i]))
    differ = _bits(lambda i: without("a", "b", i)) + _bits(lambda i: without("b", "a", i))
    return ordered & sizes & ((c("own_a") + c("own_b")) * (100 + percent) <= allowed) & (differ * (100 + percent) <= allowed)


_BOUNDS = ("low", "high", "own", "some", "every")


def _bounded(rows: DataFrame, by: str) -> DataFrame:
    """Bounds over the nodes of each component."""
    words = range(SKETCH_WORDS)
    found = rows.groupBy(by).agg(
        F.min("n").alias("low"), F.max("n").alias("high"), F.min("own").alias("own"), (F.min("node") < F.max("node")).alias("several"),
        *(F.bit_or(F.col("sketch")[i]).alias(f"some_{i}") for i in words), *(F.bit_and(F.col("sketch")[i]).alias(f"every_{i}") for i in words))
    return found.select(by, "low", "high", "own", F.array(*(f"some_{i}" for i in words)).alias("some"),
                        F.when(F.col("several"), F.array(*(f"every_{i}" for i in words))).alias("every"))


def _named(rows: DataFrame, x: str, *columns: str) -> DataFrame:
    """Each of the columns with ``_x`` behind its name, and the bounds: a component's, or those that a node is for itself."""
    itself = {"low": F.col("n"), "high": F.col("n"), "own": F.col("own"), "some": F.col("sketch"), "every": F.lit(None).cast("array<bigint>")}
    bounds = {b: F.col(b) if b in rows.columns else itself[b] for b in _BOUNDS}
    return rows.select(*(F.col(c).alias(f"{c}_{x}") for c in columns), *(of.alias(f"{b}_{x}") for b, of in bounds.items()))


def _groups(prefixes: DataFrame, comps: DataFrame, may: Column) -> DataFrame:
    """The pairs of components that share a prefix token and may link by their bounds, once for each token."""
    of = lambda rows, x: _named(rows.select("token", "comp").distinct().join(comps, "comp"), x, "token", "comp")
    smaller, larger = of(prefixes.where("short"), "a"), of(prefixes, "b")
    return smaller.join(larger, F.col("token_a") == F.col("token_b")).where((F.col("comp_a") != F.col("comp_b")) & may).select("comp_a", "comp_b")


def _between(rows: DataFrame) -> DataFrame:
    """The tokens of the rows that several components share."""
    return rows.groupBy("token").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).where("low < high").select("token")


def _crowded(rows: DataFrame) -> DataFrame:
    """The rows ``(token, node, comp)`` of those tokens that more than CROWD components share."""
    crowded = rows.select("token", "comp").distinct().groupBy("token").count().where(F.col("count") > CROWD)
    return rows.select("token", "node", "comp").join(crowded.select("token"), "token")


def _led(keyed: DataFrame, at: int) -> DataFrame:
    """``(a, comp_a, b, comp_b)``: nodes with leaders of their tokens (here keys) from other components, at most two for each seed, in the round ``at``.

    A token is led by its components of least and largest hash, so one of the two at least isn't the node's own.
    """
    leads = []
    for seed in STAR_SEEDS:
        by = F.struct(F.xxhash64("comp", F.lit(at), F.lit(seed)), "comp", F.xxhash64("node", F.lit(at)), "node")
        leads += [F.min(by).alias(f"least_{seed}"), F.max(by).alias(f"most_{seed}")]
    of = [f"{end}_{seed}" for seed in STAR_SEEDS for end in ("least", "most")]
    led = keyed.join(keyed.groupBy("token").agg(*leads), "token")
    lead = lambda c: F.struct(F.col(c)["node"].alias("b"), F.col(c)["comp"].alias("comp_b"))
    each = F.array(*(F.when(F.col(c)["comp"] != F.col("comp"), F.struct(F.lit(k).alias("k"), lead(c).alias("lead"))) for k, c in enumerate(of)))
    counted = led.select("node", "comp", F.explode(each).alias("x")).where("x IS NOT NULL").repartition("node").groupBy("node", "comp", "x.k", "x.lead").count()
    best = counted.groupBy("node", "comp", "k").agg(F.max(F.struct("count", "lead"))["lead"].alias("lead"))
    # the lead, which many share, comes last, so that its rows meet it in a join that AQE can split
    return best.select(F.col("node").alias("a"), F.col("comp").alias("comp_a"), "lead.b", "lead.comp_b").distinct()


def _relabelled(rows: DataFrame, labels: DataFrame, column: str = "comp") -> DataFrame:
    """The components' new labels ``(comp, label)``, where they have one, as the column."""
    return relabelled(rows, labels.select(F.col("comp").alias("node"), "label"), column)


def _hooked(links: DataFrame) -> DataFrame:
    """``(comp, label)``: for each linked component the smallest that it reaches in one step, or in two by that one's own smallest.

    Not the smallest reachable: what a round leaves apart is left to the next one, and to the components of all links at the end.
    """
    both = links.select(F.col("comp_a").alias("comp"), F.col("comp_b").alias("near"))
    both = both.union(both.select(F.col("near").alias("comp"), F.col("comp").alias("near")))
    one = both.groupBy("comp").agg(F.min("near").alias("near")).select("comp", F.least("comp", "near").alias("label"))
    return _relabelled(one, one, "label")


def _rounds(prefixes: DataFrame, sets: DataFrame, percent: int) -> tuple[DataFrame | None, DataFrame | None]:
    """Verified links between components of nodes with crowded tokens, and the labels ``(comp, label)`` of these components.

    Both are None where no token is crowded. What the rounds don't find is left to the pairing. A round writes its links
    and the labels, no more; its rows are the first ones under the labels so far.
    """
    links, at = None, 0
    crowd = _crowded(prefixes).select("node", "comp").distinct()
    banded = crowd.join(sets.select("node", "bands"), "node").select("node", "comp", F.explode("bands").alias("token"))
    keyed = written(banded.join(_between(banded), "token").select("token", "node", "comp"), "keyed")
    joined = written(keyed.select("comp", F.col("comp").alias("label")).distinct(), "labels")
    before = joined.count()
    if not before:
        return None, None
    while True:
        found = written(_verified(_led(_relabelled(keyed, joined) if at else keyed, at), sets, percent), "links")
        links = found.select("a", "b") if links is None else links.union(found.select("a", "b"))
        joined = written(_relabelled(joined, _hooked(found), "label"), "labels")
        after = joined.where("comp = label").count()
        if before - after <= LEAST_JOINED * before:
            return links, joined
        before, at = after, at + 1


def _across(prefixes: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Node pairs of different components that may link, each once; the smaller set is a.

    Components are paired first, so the nodes of one never meet.
    """
    may = _may_link(percent)
    comps = written(_bounded(nodes, "comp"), "comps")
    groups = written(_groups(prefixes, comps, may).distinct(), "groups")
    node = lambda x: _named(nodes, x, "node", "comp")
    # the nodes of a's component against b's bounds, then those of b's
    of_a = groups.join(_named(comps, "b", "comp"), "comp_b").join(node("a"), "comp_a").where(may)
    pairs = of_a.select("comp_a", "comp_b", "node_a", *(f"{b}_a" for b in _BOUNDS)).join(node("b"), "comp_b").where(may)
    return pairs.select("node_a", "node_b")


def _cross_links(sets: DataFrame, labels: DataFrame, percent: int, steps: tuple[int, int]) -> DataFrame:
    """Verified links between nodes of different components."""
    placed = sets.join(labels, "node", "left").select("node", F.coalesce("label", "node").alias("comp"), F.size("tokens").cast("long").alias("n"), "tokens", "sketch")
    pooled = placed.select("node", "comp", "n", F.explode(F.expr(f"slice(tokens, 1, CAST({_SECOND.format(percent)} AS INT))")).alias("token"))
    able = pooled.join(_between(pooled), "token").groupBy("node", "n").agg(F.count("*").alias("n_live")).where(f"n_live >= {_need(_SECOND, percent)}").select("node")
    able = written(placed.join(able, "node"), "able")
    tokens = able.select("node", "comp", F.explode("tokens").alias("token"))
    costs = tokens.groupBy("token").agg(F.count("*").alias("cost"), (F.min("comp") < F.max("comp")).alias("live"))
    held = able.select("node", "comp")
    own, by_node = Window.partitionBy("node").orderBy("cost", "token"), Window.partitionBy("node")
    ordered = (
        tokens.select("node", "token").join(costs, "token").withColumn("pos", F.row_number().over(own) - 1)
        .withColumn("n_live", F.sum(F.col("live").cast("int")).over(by_node)).where("live").join(able.select("node", "n"), "node")
        .withColumn("first", F.expr(f"n - {_OVERLAP.format(percent)} + 1"))
        .withColumn("estimate", F.sum(F.when(F.col("pos") < F.col("first"), F.col("cost") - 1)).over(by_node))
        .withColumn("l", F.when(F.col("estimate") > steps[1], 3).when(F.col("estimate") > steps[0], 2).otherwise(1))
        .where(f"pos < first + l - 1 AND n_live >= {_OVERLAP.format(percent)}")
    )
    # as the smaller of a pair, a set of n shares at least 2 * percent * n / (100 + percent)
    short = f"pos < n - (2 * {percent} * n + {99 + percent}) div {100 + percent} + l"
    prefixes = written(ordered.select("token", "node", "n", "l", (F.col("n") - F.col("n_live")).alias("own"), F.expr(short).alias("short")).join(held, "node"), "prefixes")
    firsts = prefixes.groupBy("node").agg(F.collect_list("token").alias("prefix"), *(F.first(c).alias(c) for c in ("n", "l", "own")))
    nodes = written(firsts.join(able.select("node", "comp", "sketch"), "node"), "prefixes")
    links, joined = _rounds(prefixes, sets, percent)
    if joined is not None:
        prefixes, nodes = (written(_relabelled(rows, joined), "prefixes") for rows in (prefixes, nodes))
        prefixes = prefixes.join(_between(prefixes), "token")
    pairs = _across(prefixes, nodes, percent)
    of = lambda x: nodes.select(F.col("node").alias(f"node_{x}"), F.col("prefix").alias(f"prefix_{x}"), F.col("l").alias(f"l_{x}"))
    enough = F.size(F.array_intersect("prefix_a", "prefix_b")) >= F.least("l_a", "l_b")
    found = pairs.join(of("a"), "node_a").join(of("b"), "node_b").where(enough)
    rest = _verified(found.select(F.col("node_a").alias("a"), F.col("node_b").alias("b")), sets, percent)
    return rest if links is None else links.union(rest)


def _merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``(node, label)``: the components of ``labels`` with those of ``links`` between them, which are taken by component."""
    further = smallest_reachable(relabelled(relabelled(links, labels, "a"), labels, "b"))
    return relabelled(labels, further, "label").union(further.join(labels, "node", "left_anti"))


def join(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = 3, percent: int = 90,
         steps: tuple[int, int] = (8, 64)) -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` for every row: the smallest id that its links reach."""
    pools = written(_pools(docs, doc_id, text, words, percent), "pools")
    every = pools.where("id IS NOT NULL").select("node", F.explode("pool").alias("token"))
    shared = every.groupBy("token").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low < high").select("token")
    # rows with equal sets bring the same tokens, so a node's count is a multiple of its rows
    hits = every.join(shared, "token").groupBy("node").agg(F.count("*").alias("n_hits"))
    sizes = pools.where("id IS NOT NULL AND n > 0").groupBy("node").agg(F.min("n").alias("n"), F.count("*").alias("n_rows"))
    own = f"CAST({_POOL.format(percent)} - n_hits div n_rows AS INT) AS own"
    nodes = written(hits.join(sizes, "node").where(f"n_hits >= n_rows * {_need(_POOL, percent)}").selectExpr("node", own), "nodes")
    sets = written(_full_sets(docs, doc_id, text, words, nodes), "sets")

    labels = smallest_reachable(_star_links(sets, percent))
    labels = _merged(labels, _cross_links(sets, labels, percent, steps))

    rows = pools.select("id", "n", "node")
    comp = F.coalesce("label", "node")
    placed = rows.join(labels, "node", "left").withColumn("comp", comp)
    names = written(placed.where("id IS NOT NULL").groupBy("comp").agg(F.min("id").alias("first_id")), "names")
    component = F.when(F.col("id").isNull(), None).when(F.col("n") == 0, F.col("id")).otherwise(F.col("first_id"))
    return placed.join(names, "comp", "left").select(F.col("id").alias(doc_id), F.col("n").alias("n_shingles"), component.alias("component_id"))
