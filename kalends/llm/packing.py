"""Best-fit packing of tokenised documents into fixed sequences by linear grouping.

Lengths are whole numbers up to the capacity, so the whole packing problem is the histogram of piece lengths: at most
``capacity`` counts, whatever the corpus size. The driver solves that histogram:

1. large lengths are sorted and cut into groups of equal cardinality; each group is rounded up to its longest member,
2. configurations of these few sizes are optimised by column generation (a knapsack prices new configurations),
3. the configurations' slots are filled with actual lengths of the slot's group,
4. what is left, and all small lengths, go best-fit into the remaining gaps, longest first.

The outcome is a list of runs: a sequence content (a list of lengths) and how many sequences have it. Executors then
number the pieces of each length (in salted buckets, so that a length that a third of all pieces share has no single
task) and look their place up in the runs.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

CAPACITY, GROUPS = 2048, 96
#: Large is what exceeds the capacity divided by one of these; the one that needs the fewest sequences is taken.
CUTS = (2, 3, 4, 8)
#: Bytes of text whose different words are encoded at once, and documents whose ids are put together at once.
BLOCK, TOGETHER = 16_000_000, 256
#: Words of letters only that are encoded as one line; the ends of words tell their ids apart.
LINE = 200
#: Signs that part from a letter or digit before them; without ' (it may start a token of letters) and without what
#: names of special tokens are made of.
SIGNS = '!"#$%&()*+,-./:;=?@[\\]^_`{}~'
#: ASCII letters and digits and, as two bytes, Latin letters, but for what is two characters in lower case.
AFTER = np.zeros(65536, bool)
AFTER[[int.from_bytes(c.encode()) for c in map(chr, range(0x250)) if c.isalnum() and (c.isascii() or c.isalpha()) and len(c.lower()) == 1]] = True
#: Words of small Latin letters, which no normaliser changes.
SMALL = "^[" + "".join(c for c in map(chr, range(0x250)) if c.isalpha() and c == c.lower()) + "]+$"
#: Pieces numbered by one task; sets the number of salts.
NUMBERED = 20_000

PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"


def _spans(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Positions of runs, one run behind the other."""
    return np.repeat(start - (np.cumsum(count) - count), count) + np.arange(count.sum())


def _encoder(path: str | None):
    """Text to little-endian 32-bit ids. White space ends every token of this vocabulary, so each distinct run of
    other bytes is encoded once a block; Arrow finds them and numpy puts the ids together."""
    import os

    from tokenizers import Tokenizer, normalizers, pre_tokenizers

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core; the library's own threads only spin on it
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer, plain = Tokenizer.from_file(path), Tokenizer.from_file(path)
    plain.normalizer = normalizers.Sequence([])  # it changes no small Latin letter, and letters are one run
    plain.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
    suffix = tokenizer.model.end_of_word_suffix
    last = np.zeros(tokenizer.get_vocab_size() + 1, bool)
    last[[k for w, k in tokenizer.get_vocab().items() if suffix and w.endswith(suffix)]] = True

    def encoded(words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of different words, and of each word the first one's position and how many there are."""
        small = pc.match_substring_regex(words, SMALL).to_numpy(zero_copy_only=False)
        letters = ~small & pc.match_substring_regex(words, r"^\pL+$").to_numpy(zero_copy_only=False)
        count, start = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        rest, order, got = [np.flatnonzero(~small & ~letters)], [np.zeros(0, np.int64)], [np.zeros(0, np.uint32)]
        for mask, by in ((small, plain), (letters, tokenizer)):
            rows = np.flatnonzero(mask)
            cuts = pa.array(np.append(np.arange(0, len(rows), LINE), len(rows)), pa.int32())
            lines = pc.binary_join(pa.ListArray.from_arrays(cuts, words.take(pa.array(rows))), " ").to_pylist() if len(rows) else []
            for k, e in enumerate(by.encode_batch_fast(lines, add_special_tokens=False)):
                line, ids = rows[k * LINE : (k + 1) * LINE], np.array(e.ids, np.uint32)
                ends = np.flatnonzero(last[ids]) + 1
                if len(ends) == len(line):  # blanks part words, so a word that is not one piece only makes more ends
                    count[line] = np.diff(ends, prepend=0)
                    order.append(line)
                    got.append(ids)
                else:
                    rest.append(line)
        alone = np.concatenate(rest)
        for k in range(0, len(alone), 20_000):
            rows = alone[k : k + 20_000]
            ids = [e.ids for e in tokenizer.encode_batch_fast(words.take(pa.array(rows)).to_pylist(), add_special_tokens=False)]
            count[rows] = [len(x) for x in ids]
            order.append(rows)
            got.append(np.fromiter(chain.from_iterable(ids), np.uint32))
        rows = np.concatenate(order)
        start[rows] = np.cumsum(count[rows]) - count[rows]
        return np.concatenate(got), start, count

    def parted(words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The same; signs after a Latin letter or digit always are tokens of their own, so they are encoded apart."""
        stem, at = pc.ascii_rtrim(words, characters=SIGNS), words.offset
        edges = np.frombuffer(words.buffers()[1], np.int32)[at : at + len(words) + 1].astype(np.int64)
        data = np.frombuffer((words.buffers()[2] if edges[-1] else None) or b"\0", np.uint8)
        n, m = np.diff(edges), pc.binary_length(stem).to_numpy().astype(np.int64)
        end = edges[:-1] + m
        ended = (m > 0) & (m < n)
        one, two = (data[np.where(m > k, end - 1 - k, 0)].astype(np.int64) * (m > k) for k in (0, 1))
        ended &= AFTER[one] | AFTER[two << 8 | one]
        rows = np.flatnonzero(ended)
        tails = data[_spans(end[rows], (n - m)[rows])]
        cuts = np.append(0, np.cumsum((n - m)[rows])).astype(np.int32)
        signs = pa.StringArray.from_buffers(len(rows), pa.py_buffer(cuts), pa.py_buffer(tails))
        both = pc.dictionary_encode(pa.concat_arrays([pc.if_else(pa.array(ended), stem, words), signs]))
        part = both.indices.to_numpy()
        ids, start, count = encoded(both.dictionary)
        parts = np.insert(part[: len(n)], rows + 1, part[len(n) :])
        total = count[part[: len(n)]]
        total[rows] += count[part[len(n) :]]
        return ids[_spans(start[parts], count[parts])], np.cumsum(total) - total, total

    def encode(texts: pa.Array | list[bytes | None]) -> list[bytes]:
        """The vocabulary is lower case; only names of special tokens are told apart by case, and they start with <|."""
        column = (pa.array(texts, pa.binary()) if isinstance(texts, list) else texts).fill_null(b"")
        try:
            column = column.cast(pa.string())
        except pa.ArrowInvalid:  # wrong bytes
            column = pa.array([t.decode("utf-8", "replace") for t in column.to_pylist()], pa.string())
        split = pc.ascii_split_whitespace(pc.if_else(pc.match_substring(column, "<|"), column, pc.ascii_lower(column)))
        edges, coded = split.offsets.to_numpy(), pc.dictionary_encode(split.flatten())
        if not len(coded):
            return [b""] * len(column)
        (ids, start, count), word = parted(coded.dictionary), coded.indices.to_numpy()
        out: list[bytes] = []
        for k in range(0, len(column), TOGETHER):
            cuts = edges[k : k + TOGETHER + 1]
            w = word[cuts[0] : cuts[-1]]
            raw = ids[_spans(start[w], count[w])].tobytes()
            at = (4 * np.append(0, np.cumsum(count[w]))[cuts - cuts[0]]).tolist()
            out += [raw[a:b] for a, b in zip(at, at[1:])]
        return out

    return encode


def _blocks(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Rows in blocks of about `BLOCK` bytes of text, a row at least."""
    size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy().astype(np.int64))
    at = 0
    while at < batch.num_rows:
        upto = max(at + 1, int(np.searchsorted(size, (size[at - 1] if at else 0) + BLOCK, "right")))
        yield batch.slice(at, upto - at)
        at = upto


def _cut(path: str | None, capacity: int, end: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, tail = _encoder(path), np.array([end], "<u4").tobytes()
        for batch in batches:
            n = 6 if with_ids else 5
            out: list[list] = [[] for _ in range(n)]
            for block in _blocks(batch):
                for doc, ids in zip(block.column(0).to_pylist(), encode(block.column(1))):
                    ids += tail
                    for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                        part = ids[at : at + 4 * capacity]
                        for column, x in zip(out, (doc, piece, at // 4, len(part) // 4, zlib.crc32(part), part)):
                            column.append(x)
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out[:n], kinds)], names=names[:n])

    return run


def pieces(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, end: int = 0, with_ids: bool = False) -> DataFrame:
    """Documents as pieces of at most ``capacity`` ids; with ``with_ids`` also the ids, 32-bit little-endian."""
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return base.mapInArrow(_cut(path, capacity, end, with_ids), PIECE + ", ids binary" * with_ids)


def _configurations(sizes: list[int], demand: list[int], capacity: int, rounds: int = 600) -> list[tuple[np.ndarray, float]]:
    """Column generation for the fewest sequences: (items of each size, times) of the relaxed optimum."""
    k = len(sizes)
    w, d = np.array(sizes), np.array(demand, float)
    columns = [np.eye(k, dtype=int)[i] * (capacity // w[i]) for i in range(k)]
    inverse = np.diag([1.0 / (capacity // s) for s in w])
    x = inverse @ d
    for _ in range(rounds):
        y = inverse.sum(axis=0)  # duals: every column costs one sequence
        best, last = np.zeros(capacity + 1), np.full((k, capacity + 1), 0, np.int16)
        for i in range(k):
            value, count = best.copy(), last[i]
            for c in range(1, capacity // w[i] + 1):
                other = best[: capacity + 1 - c * w[i]] + c * y[i]
                better = other > value[c * w[i] :] + 1e-12
                value[c * w[i] :][better] = other[better]
                count[c * w[i] :][better] = c
            best = value
        if best[capacity] <= 1 + 1e-7:
            break
        new, room = np.zeros(k, int), capacity
        for i in reversed(range(k)):
            new[i] = last[i, room]
            room -= new[i] * w[i]
        direction = inverse @ new
        ratio = np.where(direction > 1e-10, x / np.maximum(direction, 1e-10), np.inf)
        leave = int(ratio.argmin())
        if not np.isfinite(ratio[leave]):
            break
        pivot = inverse[leave] / direction[leave]
        inverse -= np.outer(direction, pivot)
        inverse[leave] = pivot
        columns[leave] = new
        x = np.maximum(inverse @ d, 0)
    return list(zip(columns, x))


def _take(queue: list[list[int]], n: int) -> list[list[int]]:
    """The first n items of a queue of [length, count] runs."""
    out = []
    while n:
        length, count = queue[0]
        c = min(n, count)
        out.append([length, c])
        n -= c
        if c == count:
            queue.pop(0)
        else:
            queue[0][1] -= c
    return out


def plan(histogram: dict[int, int], capacity: int = CAPACITY, groups: int = GROUPS) -> list[tuple[list[int], int]]:
    """Runs (lengths in a sequence, number of such sequences) that hold exactly the pieces of ``histogram``."""
    plans = (_plan(histogram, capacity, groups, capacity // cut) for cut in CUTS)
    return min(plans, key=lambda runs: sum(times for _, times in runs))


def _plan(histogram: dict[int, int], capacity: int, groups: int, small: int) -> list[tuple[list[int], int]]:
    """The scheme with lengths over ``small`` as the large ones."""
    runs = [([capacity], histogram[capacity])] if histogram.get(capacity) else []
    left = {s: n for s, n in histogram.items() if s < capacity and n}
    large = sorted((s for s in left if s > small), reverse=True)
    total = sum(left[s] for s in large)
    share = max(1, -(-total // groups))
    queues: list[list[list[int]]] = []
    room = 0
    for s in large:
        n = left[s]
        while n:
            if not room:
                queues.append([])
                room = share
            c = min(n, room)
            queues[-1].append([s, c])
            n, room = n - c, room - c
    merged: dict[int, list[list[int]]] = {}
    for q in queues:
        merged.setdefault(q[0][0], []).extend(q)
    sizes = list(merged)
    open_: dict[int, list[tuple[list[int], int]]] = {}

    def put(content: list[int], times: int) -> None:
        gap = capacity - sum(content)
        if gap:
            open_.setdefault(gap, []).append((content, times))
        else:
            runs.append((content, times))

    if sizes:
        for column, x in _configurations(sizes, [sum(c for _, c in merged[s]) for s in sizes], capacity):
            times = int(x + 1e-9)
            for s, c in zip(sizes, column):
                if c:
                    times = min(times, sum(n for _, n in merged[s]) // int(c))
            if not times:
                continue
            slots = [_take(merged[s], times) for s, c in zip(sizes, column) for _ in range(c)]
            while slots[0]:
                n = min(q[0][1] for q in slots)
                put([q[0][0] for q in slots], n)
                for q in slots:
                    q[0][1] -= n
                    if not q[0][1]:
                        q.pop(0)
    rest: dict[int, int] = {}
    for q in merged.values():
        for s, n in q:
            rest[s] = rest.get(s, 0) + n
    for s, n in left.items():
        if s <= small:
            rest[s] = rest.get(s, 0) + n
    for s in sorted(rest, reverse=True):
        n = rest[s]
        while n:
            gap = min((g for g in open_ if g >= s), default=None)
            if gap is None:
                fit = capacity // s
                if n // fit:
                    put([s] * fit, n // fit)
                if n % fit:
                    put([s] * (n % fit), 1)
                break
            content, times = open_[gap].pop()
            if not open_[gap]:
                del open_[gap]
            fit = gap // s
            full = min(times, n // fit)
            if full:
                put(content + [s] * fit, full)
                n, times = n - full * fit, times - full
            if times and n:  # fewer than one such sequence takes
                put(content + [s] * n, 1)
                n, times = 0, times - 1
            if times:
                put(content, times)
    return runs + [x for v in open_.values() for x in v]


def _places(runs: list[tuple[list[int], int]]) -> dict[int, tuple]:
    """For each length: first numbers of its slots by run, items a sequence, first sequence, offsets."""
    table: dict[int, list] = {}
    used: dict[int, int] = {}
    sequence = 0
    for content, times in runs:
        at, offsets = 0, {}
        for s in content:
            offsets.setdefault(s, []).append(at)
            at += s
        for s, o in offsets.items():
            table.setdefault(s, []).append((used.get(s, 0), len(o), sequence, o))
            used[s] = used.get(s, 0) + times * len(o)
        sequence += times
    return {s: (np.array([r[0] for r in rows]), np.array([r[1] for r in rows]), np.array([r[2] for r in rows]), np.concatenate([r[3] for r in rows]), np.cumsum([0] + [len(r[3]) for r in rows])[:-1]) for s, rows in table.items()}


def _assign(places: dict[int, tuple]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, number = batch.column("length").to_numpy(), batch.column("number").to_numpy()
            sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            order = np.argsort(length, kind="stable")
            for rows in np.split(order, np.flatnonzero(np.diff(length[order])) + 1) if len(order) else []:
                first, each, base, offsets, at = places[int(length[rows[0]])]
                r = np.searchsorted(first, number[rows], "right") - 1
                t = number[rows] - first[r]
                sequence[rows] = base[r] + t // each[r]
                offset[rows] = offsets[at[r] + t % each[r]]
            columns = [batch.column(k) for k in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(sequence), pa.array(offset)], names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return run


def pack(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, end: int = 0) -> DataFrame:
    """Place every piece of ``docs`` (doc_id, text): doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A null or empty text is the end id alone. Null doc_ids are kept as they are; repeated rows are packed each.
    An empty table gives no rows. Columns other than doc_id and text are ignored. Equal pieces of one document are
    interchangeable, otherwise the result depends only on the rows.
    """
    cut = materialize(pieces(docs, path, capacity, end), "pieces")
    histogram = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most `capacity` rows
    places = _places(plan(histogram, capacity))
    salts = max(1, -(-sum(histogram.values()) // NUMBERED))
    salted = cut.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(salts)).cast("int"))
    counts = salted.groupBy("length", "salt").agg(F.count("*").alias("n"))
    before = counts.select("length", "salt", (F.sum("n").over(Window.partitionBy("length").orderBy("salt")) - F.col("n")).alias("before"))
    row = F.row_number().over(Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32"))
    numbered = salted.withColumn("row", row).join(before, ["length", "salt"]).withColumn("number", F.col("before") + F.col("row") - 1)
    return numbered.select("doc_id", "piece", "start", "length", "ids_crc32", "number").mapInArrow(_assign(places), PIECE + ", sequence_id long, offset long")


def sequences(docs: DataFrame, placed: DataFrame, path: str | None = None, capacity: int = CAPACITY, end: int = 0) -> DataFrame:
    """The packed token ids, one row a sequence (sequence_id, ids array<int>), for unique doc_ids.

    A sequence gathers at most ``capacity`` ids, so a group is bounded.
    """
    cut = pieces(docs, path, capacity, end, with_ids=True).select("doc_id", "piece", "ids")
    grouped = cut.join(placed.select("doc_id", "piece", "sequence_id", "offset"), ["doc_id", "piece"]).groupBy("sequence_id")
    part = F.array_sort(F.collect_list(F.struct("offset", "ids")))

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [np.frombuffer(b"".join(x["ids"] for x in row), "<i4").tolist() for row in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32()))], names=["sequence_id", "ids"])

    return grouped.agg(part.alias("parts")).mapInArrow(unpack, "sequence_id long, ids array<int>")
