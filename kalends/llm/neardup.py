"""MinHash near-duplicates with odd sketches.

Plan: every text becomes one row of sketches (MinHash bands, odd sketch, set digest). Equal sets collapse to the
smallest id, so copies cost one aggregate. Buckets of all bands are contracted to candidate clusters: a member keeps
one edge to the smallest head of its buckets, and two heads get an edge only if they are left apart by that, so a group
of m copies costs about m edges and not m for each band.

Links are confirmed on full sets in two steps. First every member meets the head of its edge: that is linear, and joins
most of a cluster. Only members of parts still apart meet in pairs of blocks of a bounded size, if their sizes allow
the threshold and they are not both of the cluster's largest part. Odd sketches estimate each such pair from the
population count of an XOR, and only pairs whose estimate allows the threshold are confirmed. A block returns no more
links than it has members (those that connect), so no pair list is ever written.

Recall: with 50 bands of 8 samples a pair at similarity 0.85 misses every band with probability 1.2e-7.
Odd sketches: 400 samples in 1024 bits; the estimate may be `SLACK` short of the threshold before a pair is dropped.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, join_counted, materialize

BANDS, ROWS, BITS = 50, 8, 1024
SEED = 20_240_607
#: An estimate from 400 samples has a standard error of about 0.02 at 0.85; six of them.
SLACK = 0.12
#: Members and shingles of a block; a pair of blocks is what one group holds in memory.
BLOCK_MEMBERS, BLOCK_SHINGLES = 600, 1_500_000
#: Members that meet one copy of their head's text.
STAR = 200
#: From here on stand ids made of texts, for rows without one.
NO_ID = 1 << 62

_M64 = (1 << 64) - 1


def _mix(x: np.ndarray) -> np.ndarray:
    """splitmix64's finaliser on an array of uint64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Sets of hashed word shingles; words are hashed once while the cache holds them."""

    def __init__(self, width: int, cache: int = 400_000):
        import xxhash

        self.width, self.limit, self.known, self.digest = width, cache, {}, xxhash.xxh64_intdigest

    def ids(self, words: list[bytes]) -> np.ndarray:
        known = self.known
        try:
            return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        except KeyError:
            if len(known) > self.limit:
                known.clear()
            for w in set(words).difference(known):
                known[w] = self.digest(w)
            return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))

    def set(self, text: bytes | None) -> np.ndarray:
        """Distinct shingles, sorted. Fewer words than the width: the whole sequence as one; none: empty."""
        words = text.lower().split() if text else []  # of bytes: A-Z and the six ASCII blanks only
        if not words:
            return np.empty(0, np.uint64)
        h = self.ids(words)
        n = max(1, len(h) - self.width + 1)
        out = np.full(n, len(words) if len(words) < self.width else self.width, np.uint64)
        for k in range(min(self.width, len(h))):
            out = _mix(out * np.uint64(0x9E3779B97F4A7C15) + h[k : k + n])
        return np.unique(out)


def _family(count: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(SEED)
    return rng.integers(0, 1 << 32, count, np.uint64).astype(np.uint32) | np.uint32(1), rng.integers(0, 1 << 32, count, np.uint64).astype(np.uint32)


def minhash(shingles: np.ndarray, a: np.ndarray, b: np.ndarray, chunk: int = 512) -> np.ndarray:
    """One MinHash sample for each hash function: the smallest of a * x + b over the set, modulo 2**32."""
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    best = np.full(len(a), 0xFFFFFFFF, np.uint32)
    for k in range(0, len(x), chunk):
        part = x[k : k + chunk, None] * a
        part += b
        np.minimum(best, part.min(axis=0), out=best)
    return best


def odd_sketch(samples: np.ndarray) -> bytes:
    """Parity bitmap: sample i flips the bit that (i, value) hashes to."""
    where = _mix(samples.astype(np.uint64) + (np.arange(len(samples), dtype=np.uint64) << np.uint64(32))) % np.uint64(BITS)
    bits = (np.bincount(where.astype(np.int64), minlength=BITS) & 1).astype(np.uint8)
    return np.packbits(bits).tobytes()


def odd_estimate(differ: np.ndarray, samples: int) -> np.ndarray:
    """Similarity from the number of bits in which two odd sketches differ."""
    x = np.clip(1 - 2 * differ / BITS, 1e-9, 1)
    return 1 + BITS / (4 * samples) * np.log(x)


def _sketches(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        shingler = Shingler(width)
        a, b = _family(BANDS * ROWS)
        salt = _mix(np.arange(1, BANDS + 1, dtype=np.uint64))
        for batch in batches:
            texts = batch.column(1)
            n, digest, keys, odd = [], [], [], []
            for k in range(len(texts)):
                s = shingler.set(texts[k].as_py())
                n.append(len(s))
                if not len(s):
                    digest.append(None), keys.append(None), odd.append(None)
                    continue
                digest.append(xxhash.xxh128_digest(s.tobytes()))
                m = minhash(s, a, b)
                key = salt.copy()
                for column in m.reshape(BANDS, ROWS).T:
                    key = _mix(key * np.uint64(0x9E3779B97F4A7C15) + column)
                keys.append(key.view(np.int64))
                odd.append(odd_sketch(m))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(n, pa.int64()), pa.array(digest, pa.binary()), pa.array(keys, pa.list_(pa.int64())), pa.array(odd, pa.binary())],
                names=["doc_id", "th", "n_shingles", "digest", "bands", "odd"],
            )

    return run


def link_block(ids: np.ndarray, sets: list[np.ndarray], odd: np.ndarray, side: np.ndarray, percent: int, part: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Links that connect the members of a pair of blocks, each confirmed on full sets.

    ``side`` is 0 or 1; where both occur, pairs within one side belong to another call and are skipped, as are pairs
    of one ``part`` (known to be connected). Returns at most len(ids) - 1 links: those that join two parts not joined
    before.
    """
    m = len(ids)
    if m < 2:
        return []
    sizes = np.array([len(s) for s in sets])
    tokens, flat = np.unique(np.concatenate(sets), return_inverse=True)
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    owner = np.repeat(np.arange(m), sizes)
    part = np.arange(m) if part is None else np.unique(part, return_inverse=True)[1]
    words = odd.reshape(m, -1).view(np.uint64)
    both = len(np.unique(side)) > 1
    mark = np.zeros(len(tokens), bool)
    out = []
    for i in range(m - 1):
        open_ = np.flatnonzero(part[i + 1 :] != part[i]) + i + 1
        if both:
            open_ = open_[side[open_] != side[i]]
        low, high = np.minimum(sizes[open_], sizes[i]), np.maximum(sizes[open_], sizes[i])
        open_ = open_[100 * low >= percent * high]
        if not len(open_):
            continue
        differ = np.bitwise_count(words[open_] ^ words[i]).sum(axis=1)
        open_ = open_[odd_estimate(differ, BANDS * ROWS) >= percent / 100 - SLACK]
        if not len(open_):
            continue
        mark[flat[starts[i] : starts[i] + sizes[i]]] = True
        if 4 * len(open_) > m:
            shared = np.bincount(owner, mark[flat], m)[open_].astype(np.int64)
        else:
            shared = np.array([np.count_nonzero(mark[flat[starts[j] : starts[j] + sizes[j]]]) for j in open_])
        mark[flat[starts[i] : starts[i] + sizes[i]]] = False
        for j in open_[100 * shared >= percent * (sizes[i] + sizes[open_] - shared)]:
            if part[j] != part[i]:
                part[part == part[j]] = part[i]
                out.append((int(ids[i]), int(ids[j])))
    return out


#: What a block holds of each member: its key (g, i, j), the representative, its side and part, sketch and text.
MEMBER = ["g", "i", "j", "rep", "th", "side", "part", "odd", "text"]


def _links(width: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by (g, i, j); a group may span batches."""
        shingler = Shingler(width)
        now, held, seen = None, ([], [], [], [], []), set()

        def close() -> list[tuple[int, int]]:
            ids, sets, odd, side, part = held
            order = np.argsort(np.array(ids, np.int64), kind="stable")
            got = link_block(
                np.array(ids, np.int64)[order], [sets[k] for k in order], np.frombuffer(b"".join(odd[k] for k in order), np.uint8), np.array(side, np.int64)[order], percent, np.array(part, np.int64)[order]
            )
            for x in held:
                x.clear()
            return got

        for batch in batches:
            rows, found = batch.to_pydict(), []
            for g, i, j, rep, th, side, part, odd, text in zip(*(rows[c] for c in MEMBER)):
                if (g, i, j) != now:
                    if held[0]:
                        found += close()
                    now = (g, i, j)
                    seen.clear()
                if (rep, th) in seen:  # a repeated row
                    continue
                seen.add((rep, th))
                for column, x in zip(held, (rep, shingler.set(text), odd, side, part)):
                    column.append(x)
            yield pa.RecordBatch.from_pydict({"u": pa.array([x[0] for x in found], pa.int64()), "v": pa.array([x[1] for x in found], pa.int64())})
        if held[0]:
            found = close()
            yield pa.RecordBatch.from_pydict({"u": pa.array([x[0] for x in found], pa.int64()), "v": pa.array([x[1] for x in found], pa.int64())})

    return run


def _candidates(reps: DataFrame) -> DataFrame:
    """Edges (u, v) that connect all reps with a common bucket, and no others: about one a rep.

    A bucket's star has its smallest rep as head. Each rep keeps its edge to the smallest of its heads, m; its other
    heads h stand for edges between m of the rep and m of h, of which most are the same."""
    entries = materialize(reps.select("rep", F.explode("bands").alias("key")), "entries")
    buckets = materialize(entries.groupBy("key").agg(F.min("rep").alias("head"), F.count("*").alias("n")).where("n > 1"), "buckets")
    met = join_counted(entries, buckets, ["key"])
    own = materialize(met.groupBy("rep").agg(F.min("head").alias("m"), F.collect_set("head").alias("heads")), "heads")  # as many as bands at most
    first = own.where("rep <> m").select(F.col("rep").alias("u"), F.col("m").alias("v"))
    apart = own.select(F.col("m").alias("u"), F.explode("heads").alias("head")).where("u <> head").distinct()
    up = own.select(F.col("rep").alias("head"), F.col("m").alias("v"))
    return first.unionByName(apart.join(up, "head").select("u", "v").where("u <> v").distinct())


def _blocks(m: str, s: str) -> F.Column:
    return F.greatest(F.lit(1), F.ceil(F.col(m) / BLOCK_MEMBERS), F.ceil(F.col(s) / BLOCK_SHINGLES)).cast("long")


def _confirmed(dealt: DataFrame, base: DataFrame, width: int, percent: int) -> DataFrame:
    """Links (u, v) of members dealt to blocks (g, i, j), with their texts from ``base``."""
    full = dealt.join(base.withColumnRenamed("doc_id", "rep"), ["rep", "th"])
    full = full.repartition("g", "i", "j").sortWithinPartitions("g", "i", "j")
    return full.select(*MEMBER).mapInArrow(_links(width, percent), "u long, v long")


def _stars(members: DataFrame, edges: DataFrame) -> DataFrame:
    """Every edge's u meets its v: members dealt in groups of `STAR`, each with one copy of the head."""
    ends = edges.select(F.col("u").alias("rep"), F.col("v").alias("g"))
    load = members.join(ends, "rep").groupBy("g").agg(F.count("*").alias("m"), F.sum("n_shingles").alias("s"))
    salts = F.greatest(F.ceil(F.col("m") / STAR), F.ceil(F.col("s") / BLOCK_SHINGLES)).cast("long")
    load = materialize(load.select("g", salts.alias("salts"), F.col("m").alias("n")), "stars")
    nothing = F.lit(0).cast("long")
    row = lambda side: [F.lit(side).alias("side"), F.col("rep").alias("part"), "odd", "th"]
    with_ends = materialize(members.join(ends, "rep").select("rep", "g", *row(1)), "ends")
    leaves = join_counted(with_ends, load, ["g"]).select("g", F.pmod(F.xxhash64("rep"), F.col("salts")).alias("i"), nothing.alias("j"), "rep", "side", "part", "odd", "th")
    heads = members.join(load.withColumnRenamed("g", "rep"), "rep").select("rep", *row(0), F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)).alias("i"))
    return leaves.unionByName(heads.select(F.col("rep").alias("g"), "i", nothing.alias("j"), "rep", "side", "part", "odd", "th"))


def _pairs_apart(members: DataFrame, percent: int) -> DataFrame:
    """Members (rep, th, n_shingles, odd, cluster, part) of clusters that hold several parts, dealt to pairs of blocks.

    A cluster's members fall in groups: by size, in steps of the threshold, and by whether they are of its largest
    part. Groups whose sizes cannot reach the threshold do not meet, nor do two of the largest part."""
    parts = members.groupBy("cluster", "part").agg(F.count("*").alias("k"))
    open_ = parts.groupBy("cluster").agg(F.max(F.struct("k", "part"))["part"].alias("core"), F.count("*").alias("parts"), F.sum("k").alias("n")).where("parts > 1").select("cluster", "core", "n")
    step = F.floor(F.log(F.col("n_shingles").cast("double")) / F.log(F.lit(100 / percent)) + F.lit(1e-9)).cast("long")
    group = (2 * step + F.when(F.col("part") == F.col("core"), 1).otherwise(0)).alias("group")
    placed = materialize(join_counted(members, materialize(open_, "open"), ["cluster"]).select("cluster", group, "rep", "th", "n_shingles", "odd", "part"), "placed")
    load = materialize(placed.groupBy("cluster", "group").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("s")).select("cluster", "group", "n", _blocks("n", "s").alias("blocks")), "load")
    # a row of `load` is a group of a cluster; they are as many as steps of size
    other = load.select("cluster", F.col("group").alias("to"), F.col("blocks").alias("to_blocks"))
    near = (F.abs(F.floor(F.col("group") / 2) - F.floor(F.col("to") / 2)) <= 1) & ~((F.col("group") % 2 == 1) & (F.col("to") % 2 == 1))
    meets = load.join(other, "cluster").where(near).groupBy("cluster", "group", "n", "blocks").agg(F.collect_list(F.struct("to", "to_blocks")).alias("meets"))
    each = join_counted(placed, materialize(meets, "meets"), ["cluster", "group"]).withColumn("b", F.pmod(F.xxhash64("rep"), F.col("blocks")))
    each = each.withColumn("w", F.explode("meets")).withColumn("o", F.explode(F.sequence(F.lit(0).cast("long"), F.col("w.to_blocks") - 1)))
    own, first = F.col("group") == F.col("w.to"), F.col("group") < F.col("w.to")
    pick = lambda same, low, high: F.when(own, same).when(first, low).otherwise(high)
    g = F.xxhash64("cluster", F.least("group", "w.to"), F.greatest("group", "w.to"))
    i, j = pick(F.least("b", "o"), F.col("b"), F.col("o")), pick(F.greatest("b", "o"), F.col("o"), F.col("b"))
    side = pick(F.when(F.col("b") > F.col("o"), 1).otherwise(0), F.lit(0), F.lit(1))
    return each.select(g.alias("g"), i.alias("i"), j.alias("j"), "rep", side.alias("side"), "part", "odd", "th")


def key(doc_id: F.Column, text: F.Column) -> F.Column:
    """doc_id, or for rows without one a number of their text's from `NO_ID` on."""
    return F.coalesce(doc_id.cast("long"), F.lit(NO_ID) + F.shiftrightunsigned(F.xxhash64(text.cast("binary")), 2))


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id, kept.

    Two texts are linked when their sets of ``width``-word shingles (A-Z lower-cased) have a Jaccard similarity of
    at least ``percent`` / 100. component_id is the smallest doc_id reachable over links; kept marks that document.

    Null, empty and blank texts have an empty set and are linked with nothing. Rows with a null doc_id get
    n_shingles, a null component_id and kept = true (:func:`key` gives them ids first where they must count). Rows
    that repeat a doc_id count as one document with several texts: they share a component, and each such row is marked
    alike. Columns other than doc_id and text are ignored.
    """
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text")).withColumn("th", F.xxhash64("text"))
    sketch = materialize(base.mapInArrow(_sketches(width), "doc_id long, th long, n_shingles long, digest binary, bands array<long>, odd binary"), "sketch")
    keyed = sketch.where("doc_id is not null and digest is not null")
    sets = materialize(keyed.groupBy("digest").agg(F.min("doc_id").alias("rep"), F.count("*").alias("n")), "sets")
    reps = materialize(
        keyed.withColumnRenamed("doc_id", "rep").join(sets.drop("n"), ["digest", "rep"]).dropDuplicates(["digest", "rep"]).select("rep", "th", "n_shingles", "bands", "odd"),
        "reps",
    )
    candidates = materialize(_candidates(reps), "candidates")
    clusters = components(candidates).select(F.col("node").alias("rep"), F.col("component").alias("cluster"))
    members = materialize(reps.select("rep", "th", "n_shingles", "odd").join(clusters, "rep"), "members")
    links = materialize(_confirmed(_stars(members.drop("cluster"), candidates), base, width, percent), "links")
    joined = components(links).select(F.col("node").alias("rep"), F.col("component").alias("part"))
    parts = members.join(joined, "rep", "left").withColumn("part", F.coalesce("part", "rep"))
    late = materialize(_confirmed(_pairs_apart(materialize(parts, "parts"), percent), base, width, percent), "late")
    several = keyed.groupBy("doc_id").agg(F.min("digest").alias("a"), F.max("digest").alias("b")).where("a <> b").select("doc_id")
    same_id = keyed.join(several, "doc_id").join(sets.drop("n"), "digest").select(F.col("doc_id").alias("u"), F.col("rep").alias("v"))
    more = late.unionByName(same_id).where("u <> v")
    if not more.isEmpty():
        joined = components(links.unionByName(more)).select(F.col("node").alias("rep"), F.col("component").alias("part"))
    by_set = materialize(sets.join(joined, "rep", "left").select("digest", F.coalesce("part", "rep").alias("component"), "n"), "by_set")
    found = join_counted(keyed.select("doc_id", "n_shingles", "digest"), by_set, ["digest"]).select("doc_id", "n_shingles", F.col("component").alias("component_id"), (F.col("doc_id") == F.col("component")).alias("kept"))
    alone = sketch.where("doc_id is null or digest is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"), F.lit(True).alias("kept"))
    return found.unionByName(alone)
