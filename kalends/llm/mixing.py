"""Mixing sources to target weights by iterative proportional fitting.

Token counts are aggregated to cells (source, language, topic). Raking multiplies the cells by one factor for each
source, language and topic until every marginal has its target share. A document's weight is the product of its three
factors, scaled to a probability; documents are then sampled by a hash of their id and text. The topic is a column of
the documents if one is named; a class that the text's words hash to stands in for it otherwise.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BLANKS, free, materialize

TOPICS = 8
#: Default targets: each marginal's observed share to this power, normalised.
TEMPERATURE = 0.8
#: Up to so many cells are raked on the driver, more as tables; every source and language has its own factor in both.
CELLS = 100_000
ROUNDS, TOLERANCE = 200, 1e-9
KEYS = ("_source", "_lang", "_topic")
SEED = 104_729


def weighed(docs: DataFrame, names: list[str], topic: str | None = None) -> DataFrame:
    """``docs`` with four more columns ``names``: tokens (words), source, lang and topic as strings (null as empty).

    Without a ``topic`` column, the topic needs no lexicon: of the `TOPICS` classes that a text's words of six letters
    or more hash to it is the most frequent, the lowest if tied, and 0 without such words."""
    tokens, source, lang, own = names
    trimmed, words, classes = free(docs, "trimmed", "words", "classes")
    split = docs.withColumn(trimmed, F.btrim(F.coalesce("text", F.lit("")), F.lit(" \t\n\x0b\x0c\r")))
    split = split.withColumn(words, F.when(F.col(trimmed) == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, BLANKS)))
    out = split.withColumn(tokens, F.size(words).cast("long"))
    if topic is None:
        long = F.filter(words, lambda x: F.char_length(x) > 5)
        out = out.withColumn(classes, F.transform(long, lambda x: F.pmod(F.xxhash64(F.lower(x)), F.lit(TOPICS)).cast("int")))
        held = lambda k: F.size(F.filter(classes, lambda x: x == k))
        counts = F.array(*(F.struct(held(k).alias("n"), F.lit(-k).alias("k")) for k in range(TOPICS)))
        out = out.withColumn(own, (-F.array_max(counts)["k"]).cast("string"))
    else:
        out = out.withColumn(own, F.coalesce(F.col(f"`{topic}`").cast("string"), F.lit("")))
    plain = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    columns = [F.col(f"`{c}`") for c in docs.columns]
    return out.select(*columns, tokens, plain("source").alias(source), plain("lang").alias(lang), own)


def rake(cells: dict[tuple, float], targets: list[dict], rounds: int = ROUNDS, tolerance: float = TOLERANCE) -> list[dict]:
    """Factors for each marginal, so that the weighted cells have the target shares (where the cells allow it)."""
    share = np.array(list(cells.values())) / (sum(cells.values()) or 1.0)
    names = [list(t) for t in targets]
    place = [{k: i for i, k in enumerate(n)} for n in names]
    at = [np.array([p[key[axis]] for key in cells], np.int64) for axis, p in enumerate(place)]
    want = [np.array(list(t.values()), float) for t in targets]
    factors = [np.ones(len(t)) for t in targets]
    for _ in range(rounds):
        worst = 0.0
        for axis, target in enumerate(want):
            w = share.copy()
            for f, k in zip(factors, at):
                w *= f[k]
            sums = np.bincount(at[axis], w, len(target))
            some = sums > 0
            worst = max(worst, np.abs(sums - target)[some].max(initial=0.0))
            factors[axis][some] *= target[some] / sums[some]
        if worst < tolerance:
            break
    return [dict(zip(n, f.tolist())) for n, f in zip(names, factors)]


def _share(sums: dict, want: dict | None) -> dict:
    """Target shares of a marginal with observed shares ``sums``.

    Without ``want`` the observed shares to the power `TEMPERATURE`. Values that ``want`` does not name keep their
    observed share, and those it names divide the rest as their weights say; a weight of 0 leaves a value out."""
    if not want:
        raw = {k: s**TEMPERATURE for k, s in sums.items()}
        whole = sum(raw.values()) or 1.0
        return {k: v / whole for k, v in raw.items()}
    named = sum(want[k] for k in sums if k in want)
    rest = 1.0 - sum(s for k, s in sums.items() if k not in want)
    return {k: (want[k] / named * rest if named else 0.0) if k in want else s for k, s in sums.items()}


def _targets(cells: dict[tuple, float], given: list[dict | None]) -> list[dict]:
    total, out = sum(cells.values()) or 1.0, []
    for axis, want in enumerate(given):
        sums: dict = {}
        for key, n in cells.items():
            sums[key[axis]] = sums.get(key[axis], 0.0) + n / total
        out.append(_share(sums, want))
    return out


def _weights_on_driver(parts: DataFrame, given: list[dict | None]) -> DataFrame:
    """The cells of ``parts`` with the product of their factors as _weight, over the largest of a cell with tokens."""
    cells = {(r[0], r[1], r[2]): float(r[3]) for r in parts.select(*KEYS, "n").collect()}
    held = {k: n for k, n in cells.items() if n}
    factors = rake(held, _targets(held, given), ROUNDS) if held else [{}, {}, {}]

    def weight(key: tuple) -> float:
        out = 1.0
        for f, k in zip(factors, key):
            out *= f.get(k, 1.0)
        return out

    scale = max(map(weight, held), default=1.0) or 1.0
    return F.broadcast(parts.sparkSession.createDataFrame([(*k, weight(k) / scale) for k in cells], "_source string, _lang string, _topic string, _weight double"))


def _weights_as_tables(parts: DataFrame, given: list[dict | None]) -> DataFrame:
    """The same for any number of cells: a marginal is updated by an aggregation and a join."""
    spark = parts.sparkSession
    total = float(parts.agg(F.sum("n")).first()[0] or 1)
    cells = parts.select(*KEYS, (F.col("n") / total).alias("share"), *(F.lit(1.0).alias(f"f{c}") for c in KEYS))
    product = F.lit(1.0)
    for c in KEYS:
        product = product * F.col(f"f{c}")
    targets = []
    for c, want in zip(KEYS, given):
        sums = cells.groupBy(c).agg(F.sum("share").alias("s")).where("s > 0")
        if want:  # see `_share`
            given_ = F.broadcast(spark.createDataFrame([(str(k), float(v)) for k, v in want.items()], f"{c} string, raw double"))
            sums = materialize(sums.join(given_, c, "left"), f"named{c}")
            named, rest = sums.agg(F.sum("raw"), F.sum(F.when(F.col("raw").isNull(), F.col("s")))).first()
            told = F.col("raw") * F.lit((1.0 - (rest or 0.0)) / named if named else 0.0)
            targets.append(materialize(sums.select(c, F.coalesce(told, F.col("s")).alias("target")), f"target{c}"))
            continue
        raw = materialize(sums.select(c, F.pow("s", F.lit(TEMPERATURE)).alias("raw")), f"raw{c}")
        targets.append(raw.select(c, (F.col("raw") / F.lit(raw.agg(F.sum("raw")).first()[0] or 1.0)).alias("target")))
    for _ in range(ROUNDS):
        worst = 0.0
        for c, target in zip(KEYS, targets):
            sums = cells.groupBy(c).agg(F.sum(F.col("share") * product).alias("s")).where("s > 0")
            step = materialize(sums.join(target, c).select(c, (F.col("target") / F.col("s")).alias("ratio"), F.abs(F.col("s") - F.col("target")).alias("off")), f"step{c}")
            worst = max(worst, step.agg(F.max("off")).first()[0] or 0.0)
            cells = cells.join(step.drop("off"), c, "left").withColumn(f"f{c}", F.col(f"f{c}") * F.coalesce("ratio", F.lit(1.0))).drop("ratio")
        cells = materialize(cells, "raked")
        if worst < TOLERANCE:
            break
    scale = cells.where("share > 0").agg(F.max(product)).first()[0] or 1.0
    return cells.select(*KEYS, (product / F.lit(scale)).alias("_weight"))


def mix(docs: DataFrame, sources: dict | None = None, langs: dict | None = None, topics: dict | None = None, seed: int = SEED, topic: str | None = None, prefix: str = "_") -> DataFrame:
    """``docs`` (doc_id, text, source, lang and any others) with _tokens, _topic, _probability and _sampled.

    Targets are shares by value; by default the observed shares of tokens to the power 0.8. Values that given targets
    do not name keep their observed share; those named with 0 are not sampled. ``topic`` names a column of topics; if
    none is named, a hash class of the words stands in for it. Sampling keeps a document if the hash of (seed, doc_id,
    text) falls below its probability, so repeated rows share their fate.

    A null source, language or topic is a value of its own (the empty one). Probabilities are scaled so that the
    largest is 1, and none is cut: the more a target raises a rare cell, the fewer documents of all others are kept.
    A text without words has no tokens and the probability of its cell, where a source, language or topic without
    tokens has factor 1. An empty table gives no rows. Every source and language has a factor of its own; up to
    `CELLS` cells are raked on the driver, more as tables. Columns that have the four names (under ``prefix``) are
    replaced; others may have any name.
    """
    out_names = [f"{prefix}{n}" for n in ("tokens", "topic", "probability", "sampled")]
    docs = docs.drop(*out_names)
    names = free(docs, "tokens", "source", "lang", "topic")
    rows = weighed(docs, names, topic)
    # written once: several questions are asked of it, and each would read all texts again
    parts = materialize(rows.groupBy(*(F.col(n).alias(k) for n, k in zip(names[1:], KEYS))).agg(F.sum(names[0]).alias("n")), "cells")
    weights = _weights_on_driver if parts.limit(CELLS + 1).count() <= CELLS else _weights_as_tables
    given = [{str(k): v for k, v in want.items()} if want else None for want in (sources, langs, topics)]
    cells = weights(parts, given)
    chance = F.pmod(F.xxhash64(F.lit(seed), "doc_id", "text"), F.lit(2**53)) / F.lit(float(2**53))
    c_names = free(docs, "c_source", "c_lang", "c_topic", "weight")
    cells = cells.toDF(*c_names)
    on = [rows[a] == cells[b] for a, b in zip(names[1:], c_names)]
    joined = rows.join(cells, on, "left")
    probability = F.least(F.lit(1.0), F.coalesce(F.col(c_names[3]), F.lit(1.0)))
    shown = F.col(names[3]) if topic is not None else F.col(names[3]).cast("int")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    return joined.select(*columns, F.col(names[0]).alias(out_names[0]), shown.alias(out_names[1]), probability.alias(out_names[2]), (chance < probability).alias(out_names[3]))
