"""How many links each slot has by the rule of :mod:`kalends.operators.resolve`, counted by classes: no pair is listed.

The rule has two parts. Titles that score `TITLE` match if their places are alike (P); places that are the same or
nearly so (Q, which implies P) match if the starts are close, whatever the titles. So

    matched = titles alike and P  +  Q and close starts, without titles alike
    near    = titles in the near-miss band, of other sources  -  those of them with Q and close starts

The first terms need no times: they are counted over distinct titles and distinct places of a night, as products of a
matrix of counts with the relation of places. The others only look at the slots around a quarter of an hour."""

from __future__ import annotations

import itertools
import os
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kalends.functions import geo, text
from kalends.functions.geo import RADIUS_M
from kalends.functions.text import token_set
from kalends.operators.graph import cut, forget
from kalends.operators.resolve import CLOSE_M, CLOSE_S, NEAR, TIGHT_M, TITLE, VENUE, _cells, _met, _title_bound

#: Places of one block; titles that are counted at once; slots whose pairs are looked at, at once; seconds of a group.
BLOCK, TITLES, PAIRS, BUCKET = 8192, 256, 1_000_000, 3600
#: Tasks that count titles and places, at least; cells counted at once; letters and shared words of a name that is
#: compared along with others; so few names are scored one by one; titles whose likeness is looked up in a table.
TASKS, CHUNK, LETTERS, SHARED, FEW, TABLE = 16, 2048, 64, 8, 12, 4096
NIGHT = "nightlife_date"
#: Stands for a missing source, which is neither the same as another nor another than any.
NONE = 0


def links(slots: DataFrame) -> DataFrame:
    """(event_id, nightlife_date, class_id, n_matched, n_near) for the slots of ``resolve.candidates``.

    Links count in both directions: the sum over events is twice the number of pairs. class_id is the smallest event
    with the same title and place in that night. Slots without a title have no row, as ``resolve.pairs`` has none for
    them. Titles, places and sources are told apart by 64-bit hashes."""
    placed = F.lit(True)
    for c in ("lat", "lon"):
        placed = placed & (F.coalesce(F.col(c), F.lit(0.0)) != 0)
    somewhere = placed & ~F.isnan("lat") & ~F.isnan("lon") | (F.coalesce("venue_id", F.lit("")) != "")
    worded = lambda c: F.trim(F.col(c)) != ""
    raw = cut(
        slots.where("t is not null").select(
            "event_id", NIGHT, "start_s", F.when(F.col("source").isNull(), NONE).otherwise(F.xxhash64("source")).alias("source"), "t", "v", "venue_id", "lat", "lon",
            F.xxhash64("t").alias("tid"), F.xxhash64("v", "venue_id", "lat", "lon").alias("pid"), F.xxhash64("venue_id", "lat", "lon").alias("sid"),
            F.when(worded("t"), somewhere | F.coalesce(worded("v"), F.lit(False))).otherwise(F.lit(False)).alias("own_a"), (~worded("t") & somewhere).alias("own_b"),
        ),
        "slots",
    )
    titles = cut(raw.select("tid", "t").distinct(), "titles")
    spots = raw.select("pid", "sid", "v", "venue_id", "lat", "lon").dropDuplicates(["pid"])
    coded = cut(raw.dropDuplicates(["event_id", NIGHT, "start_s"]).select("event_id", NIGHT, "start_s", "source", "tid", "pid", "sid", "own_a", "own_b"), "coded")
    places = _blocks(cut(spots, "spots"))
    forget(raw.sparkSession, raw)
    alike = _titles(coded, titles)
    one = [NIGHT, "tid", "pid", "start_s", "source"]
    classes = cut(coded.groupBy(*one, "sid").agg(F.count("*").alias("n"), F.min("event_id").alias("class_id")), "classes")
    cells = cut(classes.groupBy(NIGHT, "tid", "pid").agg(F.sum("n").alias("n"), F.min("class_id").alias("class_id")), "cells")
    timeless = _products(cells, alike, places)
    others = _other_sources(classes, alike)
    timed = _close_starts(classes, alike, places)

    out = classes.drop("n", "class_id", "sid").join(cells.drop("n"), [NIGHT, "tid", "pid"]).join(timeless, [NIGHT, "tid", "pid"], "left")
    out = out.join(others["all"], [NIGHT, "tid"], "left").join(others["same"], [NIGHT, "tid", "source"], "left").join(timed, one, "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    near = F.when(F.col("source") != NONE, zero("n_all") - zero("n_same") - zero("n_timed_near")).otherwise(0)
    counted = out.select(*one, "class_id", (zero("n_timeless") + zero("n_timed")).alias("matched"), near.alias("near"))
    counted = counted.withColumnsRenamed({c: f"_{c}" for c in one})
    slot = coded.join(counted, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in one]).select("event_id", NIGHT, "class_id", "start_s", "own_a", "own_b", "matched", "near")
    events = slot.groupBy("event_id", NIGHT).agg(
        F.min("class_id").alias("class_id"), F.sum("matched").alias("matched"), F.sum("near").alias("n_near"), F.max("own_a").alias("own_a"), F.max("own_b").alias("own_b"), F.collect_list("start_s").alias("s")
    )
    # An event does not link with itself; the counts above have its own slots in them.
    close = F.expr(f"aggregate(s, 0L, (n, x) -> n + size(filter(s, y -> abs(x - y) <= {CLOSE_S})))")
    own = F.when(F.col("own_a"), F.size("s") * F.size("s")).when(F.col("own_b"), close).otherwise(0)
    return events.select("event_id", NIGHT, "class_id", (F.col("matched") - own).alias("n_matched"), "n_near")


def _titles(coded: DataFrame, titles: DataFrame) -> DataFrame:
    """(a, b, score) of titles of one night that reach the near-miss band, both ways, and of each with itself."""
    void = lambda kind: F.lit(None).cast(kind)
    one = coded.select(NIGHT, "tid").distinct().join(titles, "tid").select(F.col("tid").alias("event_id"), NIGHT, "t", F.lit(0).cast("long").alias("start_s"), void("string").alias("venue_id"), void("double").alias("lat"), void("double").alias("lon"))
    met = _met(one).select("u", "v").distinct()
    side = lambda p: titles.select(F.col("tid").alias(p), F.col("t").alias(f"{p}_t"))
    scored = met.join(side("u"), "u").join(side("v"), "v").where(_title_bound() >= NEAR).select("u", "v", text.token_set_similarity(F.col("u_t"), F.col("v_t")).alias("score"))
    found = cut(scored.where(F.col("score") >= NEAR), "found")
    back = found.select(F.col("v").alias("u"), F.col("u").alias("v"), "score")
    self = titles.where("trim(t) <> ''").select(F.col("tid").alias("u"), F.col("tid").alias("v"), F.lit(100.0).alias("score"))
    return cut(found.unionByName(back).unionByName(self).toDF("a", "b", "score"), "alike")


def _blocks(spots: DataFrame) -> DataFrame:
    """Places with their block and their number in it."""
    n = max(1, -(-spots.count() // BLOCK))
    number = F.row_number().over(Window.partitionBy("block").orderBy("pid")) - 1
    return cut(spots.withColumn("block", F.pmod("pid", F.lit(n)).cast("int")).withColumn("k", number), "places")


def _words(names: list[str]) -> list[frozenset[str]]:
    return [frozenset(x.split()) for x in names]


def _line(words: frozenset[str]) -> str:
    return " ".join(sorted(words))


def _alike_names(one: list[str], two: list[str]) -> np.ndarray:
    """Which of ``two`` score `VENUE` or more with which of ``one``, as :func:`token_set` has it.

    A pair is compared by what is left of both names without the words they share. So names are taken together by sets
    of words that both sides have, from small sets to large: what a pair got under a part of its shared words is
    overwritten under all of them. Names that are long or share many words are scored one by one."""
    out = np.zeros((len(one), len(two)), bool)
    sides = (_words(one), _words(two))
    vocabulary = frozenset().union(*sides[0]) & frozenset().union(*sides[1])
    groups: list[dict] = []
    odd: list[list[int]] = []
    for side, names in zip(sides, (one, two)):
        having, single = {}, []
        for x, w in enumerate(side):
            shared = w & vocabulary
            if sum(map(len, w)) + len(w) > LETTERS or len(shared) > SHARED or "\0" in names[x]:
                single.append(x)
            elif w:
                having.setdefault(shared, []).append(x)
        sets: dict[frozenset[str], list] = {}
        for shared, members in having.items():
            for k in range(len(shared) + 1):
                for c in map(frozenset, itertools.combinations(shared, k)):
                    if not groups or c in groups[0]:
                        there = sets.get(c)
                        if there is None:
                            sets[c] = [list(members), shared]
                        else:
                            there[0].extend(members)
                            there[1] &= shared
        groups.append(sets)
        odd.append(single)
    for c in sorted(groups[1], key=len):
        (rows, u), (cols, v) = groups[0][c], groups[1][c]
        if len(u & v) == len(c):  # else all of them share a word more
            _compare(out, rows, cols, sides[0], sides[1], c)
    for x in odd[0]:
        out[x] = [token_set(one[x], y) >= VENUE for y in two]
    for y in odd[1]:
        out[:, y] = [token_set(x, two[y]) >= VENUE for x in one]
    return out


def _compare(out: np.ndarray, rows: list[int], cols: list[int], one: list, two: list, shared: frozenset[str]) -> None:
    """Sets out for these names, all of which have the words of ``shared``, as if they shared no others.

    The longest common subsequence of a row with all columns at once: a whole number of bits for each column, as in
    :func:`kalends.functions.text.common_length`; rows are sorted and start where they leave the row before."""
    if len(cols) < len(rows):
        out, rows, cols, one, two = out.T, cols, rows, two, one
    if len(cols) <= FEW:
        for x in rows:
            for y in cols:
                out[x, y] = one[x] == two[y] or token_set(_line(one[x]), _line(two[y])) >= VENUE
        return
    right = [_line(two[y] - shared) for y in cols]
    sizes = np.array([len(x) for x in right])
    most = max(1, int(sizes.max()))
    width = next(w for w in (8, 16, 32, 64) if w >= most)
    kind = np.dtype(f"u{width // 8}")
    left = sorted((_line(one[x] - shared), x) for x in rows)
    letters = np.array(right, f"<U{most}").view(np.uint32).reshape(len(right), most)
    at = np.arange(most, dtype=kind)
    tables = {x: np.bitwise_or.reduce((letters == ord(x)).astype(kind) << at, axis=1) for x in set().union(*(set(x) for x, _ in left))}
    n = len(_line(shared))
    lead = n + 1 if n else 0

    def bound(size: int) -> np.ndarray:
        """A column is alike if fewer bits of it are left."""
        first, of = lead + size, np.zeros(most + 1, np.uint8)
        for m in range(most + 1):
            second = lead + m
            if n and (not m or max(200.0 * n / (n + first), 200.0 * n / (n + second)) >= VENUE):
                of[m] = 255
                continue
            enough = next((x for x in range(min(size, m) + 1) if first + second and 200.0 * (lead + x) / (first + second) >= VENUE), None)
            of[m] = 0 if enough is None else width - enough + 1
        return of[sizes]

    bounds: dict[int, np.ndarray] = {}
    states = np.empty((1 + max(len(x) for x, _ in left), len(cols)), kind)
    states[0] = np.iinfo(kind).max
    hit, up = np.empty_like(states[0]), np.empty_like(states[0])
    target = slice(None) if len(cols) == out.shape[1] and cols == sorted(cols) else np.array(cols)
    before = ""
    for line, x in left:
        if not line:
            out[x, target] = True
            continue
        d = len(os.path.commonprefix((before, line)))
        for k in range(d, len(line)):
            table = tables[line[k]]
            np.bitwise_and(states[k], table, out=hit)
            np.add(states[k], hit, out=up)
            np.subtract(states[k], hit, out=hit)
            np.bitwise_or(up, hit, out=states[k + 1])
        if len(line) not in bounds:
            bounds[len(line)] = bound(len(line))
        out[x, target] = np.bitwise_count(states[len(line)]) < bounds[len(line)]
        before = line


def _ramp(count: np.ndarray) -> np.ndarray:
    """0, 1, ... below each count in turn."""
    return np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)


def _mark(near: np.ndarray, a: np.ndarray, b: np.ndarray, one: np.ndarray, two: np.ndarray) -> None:
    """Sets near for all rows whose number in a is in one with all columns whose number in b is beside it in two."""
    rows, cols = np.argsort(a, kind="stable"), np.argsort(b, kind="stable")
    first, n = (np.searchsorted(a[rows], one, x) for x in ("left", "right"))
    second, m = (np.searchsorted(b[cols], two, x) for x in ("left", "right"))
    n, m = n - first, m - second
    low, ends = 0, np.cumsum(n * m)
    while low < len(one):
        high = max(low + 1, int(np.searchsorted(ends, (ends[low - 1] if low else 0) + PAIRS, "right")))
        count = (n * m)[low:high]
        x, each = _ramp(count), np.repeat(np.arange(low, high), count)
        near[rows[first[each] + x // m[each]], cols[second[each] + x % m[each]]] = True
        low = high


def _points(a: dict) -> tuple[np.ndarray, np.ndarray]:
    """Different points of places, and the number of each place's point, or -1 where it has none."""
    there = (a["lat"] != 0) & (a["lon"] != 0) & ~np.isnan(a["lat"]) & ~np.isnan(a["lon"])
    number = np.full(len(there), -1)
    points, number[there] = np.unique(np.column_stack((a["lat"], a["lon"]))[there], axis=0, return_inverse=True)
    return points, number


def _near_places(a: dict, b: dict) -> np.ndarray:
    """Which places of b are alike (P) to which of a."""
    (ia, ua), (ib, ub) = (pd.factorize(d["v"]) for d in (a, b))
    near = _alike_names(list(ua), list(ub))
    if len(ua) < len(ia):
        near = near[ia]
    if len(ub) < len(ib):
        near = near[:, ib]
    (p, number), (q, other) = _points(a), _points(b)  # sorted by latitude
    reach = np.degrees(CLOSE_M / RADIUS_M) * 1.001
    low, high = np.searchsorted(q[:, 0], p[:, 0] - reach, "left"), np.searchsorted(q[:, 0], p[:, 0] + reach, "right")
    at, ends = 0, np.cumsum(high - low)
    while at < len(p):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + PAIRS, "right")))
        count = (high - low)[at:to]
        u = np.repeat(np.arange(at, to), count)
        v = np.repeat(low[at:to], count) + _ramp(count)
        (x, s), (y, t) = np.radians(p[u]).T, np.radians(q[v]).T
        h = np.sin((y - x) / 2) ** 2 + np.cos(x) * np.cos(y) * np.sin((t - s) / 2) ** 2
        close = 2 * RADIUS_M * np.arcsin(np.sqrt(h)) <= CLOSE_M
        _mark(near, number, other, u[close], v[close])
        at = to
    code, _ = pd.factorize(np.concatenate([d["venue_id"] for d in (a, b)]))
    va, vb = (np.where(d["venue_id"] == "", -1, x) for d, x in zip((a, b), np.split(code, [len(ia)])))
    same = np.intersect1d(va, vb)
    same = same[same >= 0]
    _mark(near, va, vb, same, same)
    return near


def _bits(x: np.ndarray) -> np.ndarray:
    """Rows of bits in whole numbers of 64."""
    x = np.packbits(x, axis=1)
    return np.ascontiguousarray(np.pad(x, ((0, 0), (0, -x.shape[1] % 8)))).view(np.uint64)


def _pack(x: np.ndarray) -> bytes:
    """Numbers from 0 on, as narrow as the largest; the first byte says how narrow."""
    kind = np.min_scalar_type(int(x.max()) if len(x) else 0)
    return bytes([kind.itemsize]) + x.astype(kind).tobytes()


def _unpack(b: bytes) -> np.ndarray:
    return np.frombuffer(b, f"u{b[0]}", offset=1)


class _Column:
    """Slots of one night in one block of places, by title and place."""

    def __init__(self, tids: bytes, runs: bytes, k: bytes, n: bytes):
        self.tids, self.runs, self.k, self.n = np.frombuffer(tids, np.int64), _unpack(runs).astype(np.int64), _unpack(k).astype(np.int64), _unpack(n)
        ends = np.cumsum(self.runs)
        self.at = dict(zip(self.tids.tolist(), zip((ends - self.runs).tolist(), ends.tolist())))


def _count_alike(query: _Column, data: _Column, around: dict[int, list[int]], near: np.ndarray, width: int) -> np.ndarray:
    """For each title and place of query: how many slots of data have an alike title and an alike place. A title's
    slots are bits of a mask of places, a mask for each binary digit of their number."""
    total = np.zeros(len(query.k), np.int64)
    which = np.repeat(np.arange(len(query.tids)), query.runs)
    for low in range(0, len(query.tids), TITLES):
        part = query.tids[low : low + TITLES].tolist()
        others = [[data.at[b] for b in around.get(a, ()) if b in data.at] for a in part]
        bound = int(data.n.max()) * max(map(len, others))
        if not bound:
            continue
        weights = np.zeros((len(part), width), np.min_scalar_type(bound))
        for row, spans in enumerate(others):
            for x, y in spans:
                weights[row, data.k[x:y]] += data.n[x:y].astype(weights.dtype, copy=False)  # a title has a place once
        x, y = np.searchsorted(which, (low, low + len(part)))
        for digit in range(int(weights.max()).bit_length()):
            plane = weights >> digit & 1
            masks, some = _bits(plane), plane.any(axis=1)
            asked = x + np.flatnonzero(some[which[x:y] - low])
            for at in range(0, len(asked), CHUNK):
                z = asked[at : at + CHUNK]
                common = near[query.k[z]]
                common &= masks[which[z] - low]
                total[z] += np.bitwise_count(common).sum(axis=1, dtype=np.int64) << digit
    return total


def _blank(kind: str) -> Column:
    """What a row of another kind has in a column; no null in numbers, which pandas would turn into floats."""
    return F.lit(0 if kind in ("int", "long", "boolean") else None).cast(kind)


def _columns(cells: DataFrame, places: DataFrame) -> DataFrame:
    """A row for each night and block of places, in which :class:`_Column` reads all cells."""
    kind = cells.schema[NIGHT].dataType.simpleString()

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["tid", "k"])
        tids, runs = np.unique(pdf["tid"].to_numpy(np.int64), return_counts=True)
        return pd.DataFrame({NIGHT: [key[0]], "j": [key[1]], "tids": [tids.tobytes()], "runs": [_pack(runs)], "k": [_pack(pdf["k"].to_numpy())], "n": [_pack(pdf["n"].to_numpy())]})

    at = cells.join(places.select("pid", F.col("block").alias("j"), "k"), "pid").select(NIGHT, "j", "tid", "k", "n")
    return cut(at.groupBy(NIGHT, "j").applyInPandas(run, f"{NIGHT} {kind}, j int, tids binary, runs binary, k binary, n binary"), "columns")


def _products(cells: DataFrame, alike: DataFrame, places: DataFrame) -> DataFrame:
    """(night, tid, pid, n_timeless): slots of that night with an alike title and an alike place, itself included.

    A task has the places of one block and a part of the nights; it finds out which of all places are alike to them,
    block by block, and counts at once, so this relation is never written."""
    kind = cells.schema[NIGHT].dataType.simpleString()
    n = (places.agg(F.max("block")).first()[0] or 0) + 1
    parts = max(1, -(-TASKS // n))
    every = lambda m: F.explode(F.sequence(F.lit(0), F.lit(m - 1)))
    nights = cells.select(NIGHT).distinct().withColumn("g", (F.row_number().over(Window.orderBy(NIGHT)) % parts).cast("int"))
    near = alike.where(F.col("score") >= TITLE).groupBy(F.col("a").alias("tid")).agg(F.collect_list("b").alias("others"))
    text_ = lambda c: F.coalesce(F.col(c), F.lit("")).alias(c)
    number = lambda c: F.coalesce(F.col(c), F.lit(0.0)).alias(c)
    listed = places.groupBy(F.col("block").alias("j")).agg(F.sort_array(F.collect_list(F.struct("k", "pid", text_("v"), text_("venue_id"), number("lat"), number("lon")))).alias("s"))
    fields = {"pid": "array<long>", "v": "array<string>", "venue_id": "array<string>", "lat": "array<double>", "lon": "array<double>"}
    void = {NIGHT: kind, "j": "int", "tid": "long", "others": "array<long>", "tids": "binary", "runs": "binary", "k": "binary", "n": "binary"} | fields
    row = lambda df, kind, *has: df.select("i", "g", F.lit(kind).alias("kind"), *(F.col(c).cast(t).alias(c) if c in has else _blank(t).alias(c) for c, t in void.items()))
    rows = (
        row(listed.select("j", *(F.col(f"s.{c}").alias(c) for c in fields)).withColumn("i", every(n)).withColumn("g", every(parts)), 0, "j", *fields)
        .unionByName(row(_columns(cells, places).join(F.broadcast(nights), NIGHT).withColumn("i", every(n)), 1, NIGHT, "j", "tids", "runs", "k", "n"))
        .unionByName(row(cells.select(NIGHT, "tid").distinct().join(F.broadcast(nights), NIGHT).select("g", "tid").distinct().join(near, "tid").withColumn("i", every(n)), 2, "tid", "others"))
    )

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        of = pdf["kind"].to_numpy()
        blocks = {r.j: {"pid": np.asarray(r.pid, np.int64), "v": np.asarray(r.v, object), "venue_id": np.asarray(r.venue_id, object), "lat": np.asarray(r.lat, float), "lon": np.asarray(r.lon, float)} for r in pdf[of == 0].itertuples()}
        columns: dict = {}
        for r in pdf[of == 1].itertuples():
            columns.setdefault(getattr(r, NIGHT), {})[r.j] = _Column(r.tids, r.runs, r.k, r.n)
        around = dict(zip(pdf["tid"][of == 2].tolist(), pdf["others"][of == 2]))
        totals = {night: np.zeros(len(c[key[0]].k), np.int64) for night, c in columns.items() if key[0] in c}
        for j in sorted(blocks) if totals else ():
            relation, width = _bits(_near_places(blocks[key[0]], blocks[j])), len(blocks[j]["pid"])
            for night, total in totals.items():
                if j in columns[night]:
                    total += _count_alike(columns[night][key[0]], columns[night][j], around, relation, width)
        own = {night: columns[night][key[0]] for night in totals}
        join = lambda arrays, kind: np.concatenate([np.zeros(0, kind), *arrays])
        out = pd.DataFrame({NIGHT: join((np.full(len(x), night, object) for night, x in totals.items()), object), "tid": join((np.repeat(c.tids, c.runs) for c in own.values()), np.int64), "pid": join((blocks[key[0]]["pid"][c.k] for c in own.values()), np.int64), "n_timeless": join(totals.values(), np.int64)})
        return out[out["n_timeless"] > 0]

    tasks = rows.repartition(min(n * parts, 2000), "i", "g")  # few bytes, but long work
    return cut(tasks.groupBy("i", "g").applyInPandas(run, f"{NIGHT} {kind}, tid long, pid long, n_timeless long"), "timeless")


def _other_sources(classes: DataFrame, alike: DataFrame) -> dict[str, DataFrame]:
    """For a title of a night, slots with a title of the near-miss band: of all sources, and of each."""
    counts = classes.where(F.col("source") != NONE).groupBy(NIGHT, "tid", "source").agg(F.sum("n").alias("n"))
    near = alike.where(F.col("score") < TITLE).select("a", F.col("b").alias("tid"))
    there = classes.select(NIGHT, F.col("tid").alias("a")).distinct()
    same = cut(counts.join(near, "tid").groupBy(NIGHT, "a", "source").agg(F.sum("n").alias("n_same")).join(there, [NIGHT, "a"], "left_semi").withColumnRenamed("a", "tid"), "same")
    return {"same": same, "all": same.groupBy(NIGHT, "tid").agg(F.sum("n_same").alias("n_all"))}


def _tight(places: DataFrame) -> DataFrame:
    """(sid, others): places with the same venue or within `TIGHT_M` (Q), itself included if it has one. Names play
    no part, so places that differ by these only are one."""
    venue = F.when(F.coalesce("venue_id", F.lit("")) != "", F.array(F.concat(F.lit("v:"), "venue_id"))).otherwise(F.array().cast("array<string>"))
    keyed = places.dropDuplicates(["sid"]).select("sid", "venue_id", "lat", "lon", F.explode(F.array_distinct(F.concat(venue, _cells()))).alias("key"))
    a, b = keyed.alias("a"), keyed.alias("b")
    metres = geo.haversine_m(F.col("a.lat"), F.col("a.lon"), F.col("b.lat"), F.col("b.lon"))
    there = F.lit(True)
    for c in ("a.lat", "a.lon", "b.lat", "b.lon"):
        there = there & (F.coalesce(F.col(c), F.lit(0.0)) != 0)
    same = F.coalesce((F.col("a.venue_id") != "") & (F.col("a.venue_id") == F.col("b.venue_id")), F.lit(False))
    met = a.join(b, F.col("a.key") == F.col("b.key")).where(same | F.coalesce(there & (metres <= TIGHT_M), F.lit(False)))
    return met.select(F.col("a.sid").alias("sid"), F.col("b.sid").alias("other")).distinct().groupBy("sid").agg(F.collect_list("other").alias("others"))


def _count_close(rows: pd.DataFrame) -> pd.DataFrame:
    """Of one night and time: for each class of slots that starts in it, the slots of the same place that start within
    `CLOSE_S` and have no alike title, and those of them in the near-miss band and of another source."""
    kind = rows["kind"].to_numpy()
    slots = rows[kind == 0].sort_values(["sid", "start_s"])
    around = dict(zip(rows["sid"][kind == 1].astype("int64"), rows["others"][kind == 1]))
    sid, start, n = (slots[c].to_numpy(np.int64) for c in ("sid", "start_s", "n"))
    tids, title = np.unique(slots["tid"].to_numpy(np.int64), return_inverse=True)
    source = slots["source"].to_numpy(np.int64)
    look = _likeness(tids, rows[kind == 2])
    sids, place = np.unique(sid, return_inverse=True)
    number = {p: x for x, p in enumerate(sids.tolist())}
    near = [[number[o] for o in around.get(p, ()) if o in number] for p in sids.tolist()]
    degree, first = np.array([len(x) for x in near]), np.cumsum([0] + [len(x) for x in near])
    flat = np.array([o for x in near for o in x], np.int64)
    base, span = start.min() - 2 * CLOSE_S, int(start.max() - start.min()) + 5 * CLOSE_S
    key = place * span + (start - base)
    own = np.flatnonzero(slots["own"].to_numpy(bool))
    one = np.repeat(own, degree[place[own]])
    ramp = np.arange(len(one)) - np.repeat(np.cumsum(degree[place[own]]) - degree[place[own]], degree[place[own]])
    target = flat[first[place[one]] + ramp] if len(one) else np.zeros(0, np.int64)
    low = np.searchsorted(key, target * span + start[one] - base - CLOSE_S, "left")
    high = np.searchsorted(key, target * span + start[one] - base + CLOSE_S, "right")
    count = high - low
    ends = np.cumsum(count)
    plain, band = np.zeros(len(slots), np.int64), np.zeros(len(slots), np.int64)
    at = 0
    while at < len(one):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + PAIRS, "right")))
        c = count[at:to]
        u = np.repeat(one[at:to], c)
        v = np.repeat(low[at:to] - (np.cumsum(c) - c), c) + np.arange(len(u))
        like = look(title[u], title[v])
        free = like < 2
        np.add.at(plain, u[free], n[v[free]])
        mixed = (like == 1) & (source[u] != source[v]) & (source[u] != NONE) & (source[v] != NONE)
        np.add.at(band, u[mixed], n[v[mixed]])
        at = to
    some = np.flatnonzero(plain)
    out = slots.iloc[some]
    return pd.DataFrame({"tid": out["tid"].to_numpy(np.int64), "pid": out["pid"].to_numpy(np.int64), "start_s": out["start_s"].to_numpy(np.int64), "source": out["source"].to_numpy(np.int64), "n_timed": plain[some], "n_timed_near": band[some]})


def _likeness(tids: np.ndarray, rows: pd.DataFrame) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    """2 for alike titles, 1 for those of the near-miss band, else 0, by their numbers in tids."""
    number = {t: x for x, t in enumerate(tids.tolist())}
    codes: list[list[int]] = [[], []]
    for t, alike, band in zip(rows["tid"].tolist(), rows["others"], rows["band"]):
        for found, others in zip(codes, (band, alike)):
            found.extend(number[t] * len(tids) + number[o] for o in others.tolist() if o in number)
    if len(tids) <= TABLE:
        table = np.zeros(len(tids) ** 2, np.uint8)
        for x, found in enumerate(codes, 1):
            table[found] = x
        return lambda a, b: table[a * len(tids) + b]
    code, value = np.array(codes[0] + codes[1], np.int64), np.repeat(np.array([1, 2], np.uint8), list(map(len, codes)))
    order = np.argsort(code)
    code, value = np.append(code[order], -1), np.append(value[order], 0)  # the last is met by none

    def look(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        x = a * len(tids) + b
        at = np.searchsorted(code[:-1], x)
        return np.where(code[at] == x, value[at], 0)

    return look


def _close_starts(classes: DataFrame, alike: DataFrame, places: DataFrame) -> DataFrame:
    """(night, tid, pid, start_s, source, n_timed, n_timed_near) where there are any."""
    hour = lambda d: F.floor((F.col("start_s") + d) / BUCKET)
    dealt = classes.drop("class_id").withColumn("h", F.explode(F.sequence(hour(-CLOSE_S), hour(CLOSE_S)))).withColumn("own", F.col("h") == hour(0))
    void = {"tid": "long", "pid": "long", "sid": "long", "start_s": "long", "source": "long", "n": "long", "own": "boolean", "others": "array<long>", "band": "array<long>"}
    row = lambda df, kind, *has: df.select(NIGHT, "h", F.lit(kind).alias("kind"), *(F.col(c).cast(t).alias(c) if c in has else _blank(t).alias(c) for c, t in void.items()))
    dealt = cut(dealt, "dealt")
    listed = lambda when, c: F.collect_list(F.when(when, F.col("b"))).alias(c)
    around = alike.groupBy(F.col("a").alias("tid")).agg(listed(F.col("score") >= TITLE, "others"), listed(F.col("score") < TITLE, "band"))
    rows = (
        row(dealt, 0, "tid", "pid", "sid", "start_s", "source", "n", "own")
        .unionByName(row(dealt.where("own").select(NIGHT, "h", "sid").distinct().join(_tight(places), "sid"), 1, "sid", "others"))
        .unionByName(row(dealt.select(NIGHT, "h", "tid").distinct().join(around, "tid"), 2, "tid", "others", "band"))
    )
    kind = classes.schema[NIGHT].dataType.simpleString()

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        out = _count_close(pdf)
        out.insert(0, NIGHT, key[0])
        return out

    timed = cut(rows.groupBy(NIGHT, "h").applyInPandas(run, f"{NIGHT} {kind}, tid long, pid long, start_s long, source long, n_timed long, n_timed_near long"), "timed")
    forget(timed.sparkSession, dealt)
    return timed
