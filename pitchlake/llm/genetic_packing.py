"""Best-fit packing of documents into fixed-length sequences by a grouping genetic algorithm.

A solution of a shard is a list of bins.  Crossover injects the best-filled
bins of one parent into the other, removes bins that hold a document twice,
and packs the displaced documents anew by best fit, longest first.  Islands of a
shard evolve apart, one task each; after every epoch their elite migrates to
the next island of the ring, through a written table.  Shards are ranges of a hash, of
bounded size, so the work grows with the pieces and any lost task is redone from
the last written epoch.  The worst-filled bins of all shards are opened again and
evolve on in fewer shards, with the bins as they are for a first migrant, until one
shard is left: a shard's last sequence is filled from others, and no round loses a sequence.
"""

from __future__ import annotations

import random
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitchlake.llm.common import written
from pitchlake.llm.tokens import Encoder

CAPACITY = 2048
# Pieces per shard (about), islands, epochs, generations per epoch, solutions per island.
SHARD_PIECES, ISLANDS, EPOCHS, GENERATIONS, POPULATION = 8000, 2, 2, 5, 4
# Generations per epoch in the last round, of one shard; a round opens one bin of so many again.
LAST_GENERATIONS, OPENED = 40, 8
PIECES = "uid long, key long, piece int, start long, length long, ids binary, ids_crc32 long"


def token_pieces(docs: DataFrame, tokenizer: str, byte_level: bool, end_id: int, key: str = "doc_id",
                 text: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """The ids of each document with ``end_id``, whole or, if longer than ``capacity``, in pieces.

    All pieces of a cut document are full but the first, which has the rest.  A
    null or empty text is the end id alone.  ``ids`` is little-endian, unsigned, 32
    bits.  ``uid`` tells rows apart (task and place in it), also those of one key:
    write the table before using it twice.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = Encoder.of(tokenizer, byte_level), np.array([end_id], dtype="<u4").tobytes()
        uid = TaskContext.get().partitionId() << 40
        for batch in batches:
            rows = []
            for k, t in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = encoder.encode(t.as_py()) + end
                n = len(ids) // 4
                first = n % capacity or min(n, capacity)
                for p, a in enumerate([0, *range(first, n, capacity)]):
                    part = ids[4 * a:4 * (a + (capacity if p else first))]
                    rows.append((uid, k, p, a, len(part) // 4, part, zlib.crc32(part)))
                    uid += 1
            types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [()] * 7, types)],
                                             names=["uid", "key", "piece", "start", "length", "ids", "ids_crc32"])

    return docs.select(F.col(key).cast("long"), text).mapInArrow(run, PIECES)


class Bins:
    """A solution: ``bins`` are lists of items; ``left`` is the free room of each."""

    def __init__(self, sizes: list[int], capacity: int, bins: list[list[int]] | None = None, left: list[int] | None = None):
        self.sizes, self.capacity = sizes, capacity
        self.bins = bins or []
        self.left = left if left is not None else [capacity - sum(map(sizes.__getitem__, b)) for b in self.bins]
        self._fitness: tuple[int, int] | None = None

    def best_fit(self, items: list[int]) -> None:
        """Put each item into the fullest bin that has room, longest first."""
        self._fitness = None
        room = sorted((r, i) for i, r in enumerate(self.left) if r)
        for x in sorted(items, key=self.sizes.__getitem__, reverse=True):
            size = self.sizes[x]
            at = bisect_left(room, (size, -1))
            if at < len(room):
                r, i = room.pop(at)
                self.bins[i].append(x)
            else:
                r, i = self.capacity, len(self.bins)
                self.bins.append([x])
                self.left.append(r)
            self.left[i] = r - size
            if r > size:
                insort(room, (r - size, i))

    def fitness(self) -> tuple[int, int]:
        """Fewer bins first; then bins filled unevenly, as they leave larger rooms."""
        if self._fitness is None:
            self._fitness = -len(self.bins), sum((self.capacity - r) ** 2 for r in self.left)
        return self._fitness

    def worst(self, n: int) -> list[int]:
        """At most ``n`` bins with room, those with most of it."""
        return sorted((i for i, r in enumerate(self.left) if r), key=lambda i: -self.left[i])[:n]


def crossover(a: Bins, b: Bins, rng: random.Random) -> Bins:
    """Whole well-filled bins of ``a`` go into ``b``; what they displace is best-fitted again."""
    ranked = sorted(range(len(a.bins)), key=lambda i: (a.left[i], rng.random()))
    injected = ranked[:max(1, len(ranked) // 2)]
    taken = {x for i in injected for x in a.bins[i]}
    kept, left, displaced = [list(a.bins[i]) for i in injected], [a.left[i] for i in injected], []
    for g, r in zip(b.bins, b.left):
        if taken.isdisjoint(g):
            kept.append(list(g))
            left.append(r)
        else:
            displaced += [x for x in g if x not in taken]
    child = Bins(a.sizes, a.capacity, kept, left)
    child.best_fit(displaced)
    return child


def mutate(a: Bins, rng: random.Random, share: float = 0.1) -> Bins:
    """Empty some of the worst-filled bins and a few others, and best-fit their items again."""
    n = max(1, int(share * len(a.bins)))
    worst = sorted(range(len(a.bins)), key=lambda i: -a.left[i])[:n]
    gone = {*worst, *rng.sample(range(len(a.bins)), min(n, len(a.bins)))}
    stay = [i for i in range(len(a.bins)) if i not in gone]
    child = Bins(a.sizes, a.capacity, [list(a.bins[i]) for i in stay], [a.left[i] for i in stay])
    child.best_fit([x for i in gone for x in a.bins[i]])
    return child


def first_solution(sizes: list[int], capacity: int, rng: random.Random, perfect: bool = False) -> Bins:
    """Best fit of all items, longest first within either half; which half an item is in is chance.

    ``perfect``: plain best fit, longest first, to compare with; no island starts from it.
    """
    out = Bins(sizes, capacity)
    items = list(range(len(sizes)))
    if not perfect:
        items.sort(key=[rng.random() for _ in sizes].__getitem__)
        out.best_fit(items[:len(items) // 2])
        items = items[len(items) // 2:]
    out.best_fit(items)
    return out


def evolve(sizes: list[int], capacity: int, seeds: list[list[list[int]]], rng: random.Random,
           generations: int = GENERATIONS, population: int = POPULATION) -> Bins:
    """The best solution after ``generations``, starting from migrants (``seeds``) and fresh solutions."""
    bound = -(-sum(sizes) // capacity)
    pool = [Bins(sizes, capacity, s) for s in seeds]
    while len(pool) < population:
        pool.append(first_solution(sizes, capacity, rng))
    for _ in range(generations):
        pool.sort(key=Bins.fitness, reverse=True)
        if len(pool[0].bins) <= bound:
            break
        child = crossover(pool[0], pool[rng.randrange(1, len(pool))], rng)
        pool = pool[:population - 1] + [max(child, mutate(child, rng), key=Bins.fitness)]
    return max(pool, key=Bins.fitness)


def _spread(solution: Bins, n: int, opened: int = 0) -> list[int]:
    """The bin of each item; -1 - bin in the ``opened`` worst bins."""
    of = [0] * n
    again = set(solution.worst(opened)) if opened else ()
    for i, g in enumerate(solution.bins):
        for x in g:
            of[x] = -1 - i if i in again else i
    return of


def pack(pieces: DataFrame, capacity: int = CAPACITY, shard_pieces: int = SHARD_PIECES, islands: int = ISLANDS,
         epochs: int = EPOCHS) -> DataFrame:
    """(uid, sequence_id, offset) for every piece of ``pieces`` (uid, length).

    Full pieces are sequences of their own.  The others are dealt to shards by a
    hash of ``uid``; pieces of bins opened again, by that of their bin, so that the bins are a solution
    of their new shard.  Offsets in a sequence have no gap.  Pieces of equal length
    are told apart by ``uid``.  An empty table gives no rows.
    """
    rows = pieces.filter(F.col("length") < capacity).select("uid", "length", F.lit(None).cast("long").alias("was"))
    packed = pieces.filter(F.col("length") >= capacity).select(
        "uid", (-1 - F.col("uid")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    before, number = None, 0
    while True:
        shards = max(1, -(-rows.count() // shard_pieces))
        # Each round has half as many shards as the one before or is the last, so that there are few.
        last = shards == 1 or (before is not None and 2 * shards > before)
        placed = _round(rows, shards, capacity, islands, epochs, number, last)
        if not last:
            placed = written(placed, "packing-round")
        closed = placed.filter("bin >= 0")
        inside = Window.partitionBy("shard", "bin").orderBy(F.desc("length"), "uid").rowsBetween(Window.unboundedPreceding, -1)
        packed = packed.union(closed.select("uid", _sequence(number, F.col("bin")).alias("sequence_id"),
                                            F.coalesce(F.sum("length").over(inside), F.lit(0).cast("long")).alias("offset")))
        if last:
            return packed
        rows = placed.filter("bin < 0").select("uid", "length", _sequence(number, -1 - F.col("bin")).alias("was"))
        before, number = shards, number + 1


def _sequence(number: int, of: Column) -> Column:
    """A bin's number among all rounds and shards."""
    return F.lit(number << 58).cast("long") + F.col("shard").cast("long") * F.lit(1 << 32) + of


def _round(rows: DataFrame, shards: int, capacity: int, islands: int, epochs: int, number: int, last: bool) -> DataFrame:
    """(uid, length, shard, bin) of every row (uid, length, was) after ``epochs``; ``bin`` is -1 - bin where it is to be opened again."""
    rows = rows.withColumn("shard", F.pmod(F.xxhash64(F.coalesce("was", "uid")), F.lit(shards)).cast("int"))
    # One row per shard: about ``shard_pieces`` numbers.  The bins of an earlier round are its first migrant.
    shard = written(rows.groupBy("shard").agg(F.sort_array(F.collect_list(F.struct("length", "uid", "was"))).alias("p"))
                    .select("shard", F.col("p.length").alias("lengths"), F.col("p.was").alias("was")), "packing-shards")
    first = F.array("was") if number else F.array().cast("array<array<long>>")
    state = shard.select("shard", "lengths", F.explode(F.sequence(F.lit(0), F.lit(islands - 1))).alias("island"), first.alias("migrants"))
    for epoch in range(epochs):
        # The work is in the evolution, not in the bytes: a task for each island.
        opened = 0 if last or epoch + 1 < epochs else OPENED
        solved = written(state.repartition(shards * islands, "shard", "island").mapInArrow(
            _island(capacity, epoch, LAST_GENERATIONS if last and shards == 1 else GENERATIONS, opened),
            "shard int, island int, bins int, fill long, solution array<int>"), "packing-epoch")
        if epoch + 1 < epochs:
            here = solved.select("shard", "island", F.array("solution").alias("own"))
            there = solved.select("shard", F.pmod(F.col("island") + 1, F.lit(islands)).alias("island"), F.col("solution").alias("came"))
            moved = here.join(there, ["shard", "island"]).select("shard", "island", F.array_append("own", F.col("came")).alias("migrants"))
            state = shard.join(moved, "shard").select("shard", "lengths", "island", "migrants")
    # The elite of all islands; ties go to the first island.
    elite = solved.groupBy("shard").agg(F.min_by("solution", F.struct("bins", -F.col("fill"), "island")).alias("solution"))
    numbered = rows.withColumn("at", F.row_number().over(Window.partitionBy("shard").orderBy("length", "uid")))
    return numbered.join(elite, "shard").select("uid", "length", "shard", F.element_at("solution", F.col("at")).alias("bin"))


def _island(capacity: int, epoch: int, generations: int, opened: int):  # noqa: ANN202
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                sizes = row["lengths"]
                seeds = []
                for of in row["migrants"]:
                    bins: dict[int, list[int]] = {}
                    for x, i in enumerate(of):
                        bins.setdefault(i, []).append(x)
                    seeds.append(list(bins.values()))
                rng = random.Random(row["shard"] * 1009 + row["island"] * 31 + epoch)
                best = evolve(sizes, capacity, seeds, rng, generations)
                bins, fill = best.fitness()
                solution = _spread(best, len(sizes), -(-len(best.bins) // opened) if opened else 0)
                yield pa.RecordBatch.from_pylist([{"shard": row["shard"], "island": row["island"], "bins": -bins, "fill": fill,
                                                   "solution": solution}], schema=pa.schema([
                                                       ("shard", pa.int32()), ("island", pa.int32()), ("bins", pa.int32()),
                                                       ("fill", pa.int64()), ("solution", pa.list_(pa.int32()))]))

    return run


def pack_documents(docs: DataFrame, tokenizer: str, byte_level: bool, end_id: int, key: str = "doc_id", text: str = "text",
                   capacity: int = CAPACITY) -> DataFrame:
    """Every piece of ``docs`` with its ids and place: key, piece, start, length, ids, ids_crc32, sequence_id, offset.

    Null and repeated keys are documents like any others.
    """
    pieces = written(token_pieces(docs, tokenizer, byte_level, end_id, key, text, capacity), "packing-pieces")
    placed = pack(pieces.select("uid", "length"), capacity)
    return pieces.join(placed, "uid").select("key", "piece", "start", "length", "ids", "ids_crc32", "sequence_id", "offset")


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences themselves: sequence_id, n_ids, ids (pieces in offset order, little-endian 32-bit)."""
    return packed.groupBy("sequence_id").agg(F.sum("length").alias("n_ids"), F.array_sort(F.collect_list(
        F.struct("offset", "ids"))).alias("p")).select("sequence_id", "n_ids", F.expr(
            "aggregate(p.ids, cast('' as binary), (a, x) -> concat(a, x))").alias("ids"))
