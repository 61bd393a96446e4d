"""N-gram Jaccard join: documents whose sets of five-word shingles are alike, exactly, without all pairs.

Method: a metric-space join under the Jaccard distance, with document pivots, regions around them, windows of the triangle
inequality and recursion. Equal sets are one node from the start; all that follows is about nodes.

* Seeds. Where two documents share nothing their distance is 1 whatever the pivot, so distances alone cannot part a
  corpus of unlike texts. Each node therefore enters the regions of the first shingles of its set in an order common to
  all: two nodes within distance 0.2 share one of the first fifth (and one) of their shingles. Shingles that many documents
  hold, as counted exactly over all of them, come last in this order, by how common they are.
* Middle pivots. Each region has a node as its pivot, the one with the least place, and all others are measured against it. Those within
  0.2 are linked to it, which mostly closes the region: it holds one component only.
* Open regions of a few nodes are joined node by node, between components.
* Larger open regions with the same middle are one region from here on, and are joined recursively by distance. In each round a region takes
  pivots, and every node is measured against them. Nodes within 0.2 of a pivot are linked to it and belong to the Voronoi region of the
  nearest one. A node within 0.4 of a pivot is replicated to that pivot's region, where it meets the region's own nodes in the window
  of the triangle inequality: distances to the pivot that differ by over 0.2 rule out a link, and a node beyond 0.4 has none into the region.
  They also meet only where their sizes and least places among the middle's regions still allow a link, and by steps of size, so that near
  copies of one text don't meet each of those that are too far from it.
  So all links of nodes with a Voronoi region are found; what lies within 0.2 of no pivot goes to the next round, with four times as many
  pivots. A link to be found has a node outside of the region's largest component, and its smaller set has the shingle of some region
  among its first ninth (core). So pivots are drawn from the core outside of the largest component; when all of it has a Voronoi region, the
  core of the largest component meets what is outside of it, shingle by shingle.

Parity sketches, whose Hamming distance never exceeds the symmetric difference of two sets, bound distances from below and
spare most pairs the comparison of their texts; they rule out no link.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ironsift.llm.arrowtext import GOLD, LOWER_IDS, U, grams, id_and_text, mix, pieces, range_hashes, rows_of, signed, text_buffers, tokens
from ironsift.llm.bit_filter import BitFilter, filter_of
from ironsift.llm.components import components
from ironsift.llm.shared import Kept, hinted

WORDS = 5
PERCENT = 80
RADIUS = 1 - PERCENT / 100 + 1e-9
NEAR = 60  # similarity in percent at twice the distance of a link
FEW = 16  # a region of so many nodes is joined node by node
PIVOTS = 8  # of a large region in the first round, besides its middle; four times as many in each further one
SIZE_STEP = 1.05  # sizes in one step differ by a factor below it
STEP, MOST_LEVELS = 8, 12  # a shingle is as common as its count has factors STEP
COMMON_BITS = 1 << 26
TEXTS = 256  # so many texts are measured against one copy of a pivot's


def shingle_sets(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row and hash of every distinct shingle, by row and hash; and the size of each row's set."""
    ids, starts, _ = tokens(data, offs, ids=LOWER_IDS)
    _, first = rows_of(starts, offs)
    hashes, at = grams(ids, first, WORDS)
    n = np.diff(first)
    short = np.flatnonzero((n > 0) & (n < WORDS))
    row = np.concatenate((np.searchsorted(first, at, "right") - 1, short))
    hashes = np.concatenate((hashes, range_hashes(ids, first[short], first[short] + n[short])))
    order = np.lexsort((hashes, row))
    row, hashes = row[order], hashes[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (hashes[1:] != hashes[:-1])
    row, hashes = row[new], hashes[new]
    return row, hashes, np.bincount(row, minlength=len(offs) - 1)


def set_ids(h: np.ndarray, n: np.ndarray) -> np.ndarray:
    """A hash of each row's set, from two that are independent."""
    first = np.concatenate(([0], np.cumsum(n)))
    sums = np.concatenate(([U(0)], np.cumsum(mix(h ^ GOLD), dtype=U)))
    return mix(range_hashes(h, first[:-1], first[1:]) ^ mix(sums[first[1:]] - sums[first[:-1]]))


def window_size(n: np.ndarray) -> np.ndarray:
    return n - (PERCENT * n + 99) // 100 + 1


def _parts(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    data, offs = text_buffers(column)
    for a, b in pieces(offs):
        yield a, b, *shingle_sets(data[offs[a] : offs[b]], offs[a : b + 1] - offs[a])


def _sketches(row: np.ndarray, h: np.ndarray, n: np.ndarray) -> list[bytes]:
    """For each row a bit for every residue of its shingles, set where an odd number of them has it. The number of bits is
    a power of two, twice the size of the set or more."""
    wide = np.array([max(64, 1 << int(2 * x - 1).bit_length()) if x else 64 for x in n.tolist()], np.int64)
    base = np.concatenate(([0], np.cumsum(wide)))
    at, times = np.unique(base[row] + (h & (wide[row] - 1).astype(U)).astype(np.int64), return_counts=True)
    flags = np.zeros(base[-1], np.uint8)
    flags[at[times & 1 == 1]] = 1
    raw = np.packbits(flags, bitorder="little").tobytes()
    return [raw[i // 8 : j // 8] for i, j in zip(base[:-1].tolist(), base[1:].tolist(), strict=True)]


#: A row with a region is a place of a node in it: of a batch's pivot (held: nodes of the batch there), or of another node and the
#: batch's pivot. A row without one says which node a document is (pivot: the document), once in a batch with its sketch.
_ROWS = "key long, region long, node long, place int, size int, pivot long, pivot_place int, pivot_size int, held int, bits binary"


def _all_shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each shingle, once for each document."""
    for batch in batches:
        for _, _, _, h, _ in _parts(batch.column("text")):
            yield pa.RecordBatch.from_arrays([pa.array(signed(h))], ["h"])


def _levels(n: str) -> Column:
    """0 up to the number of times that the count holds the factor STEP."""
    return F.sequence(F.lit(0), F.floor(F.log(F.col(n) + 0.5) / float(np.log(STEP))).cast("int") - 1)


def _at_level(h: np.ndarray, level: int) -> np.ndarray:
    return mix(h ^ np.full(1, level + 1, U) * GOLD)


def _leveled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A hash for each shingle and level."""
    for batch in batches:
        h = batch.column("h").to_numpy().view(U)
        level = batch.column("level").to_numpy().astype(U)
        yield pa.RecordBatch.from_arrays([pa.array(signed(mix(h ^ (level + U(1)) * GOLD)))], ["h"])


def common_shingles(docs: DataFrame, tables: Kept) -> BitFilter:
    """The shingles that STEP documents or more hold, once more for each further factor STEP, counted exactly over all documents. The filter has a
    fixed size; what it lets through besides only changes the order of shingles, which may be any."""
    counts = docs.select("text").mapInArrow(_all_shingles, "h long").repartition("h").groupBy("h").agg(F.count("*").alias("n")).filter(F.col("n") >= STEP)
    leveled = tables.keep(counts.select("h", F.explode(_levels("n")).alias("level")).mapInArrow(_leveled, "h long"), "common")
    out = filter_of(leveled, COMMON_BITS)
    tables.drop(leveled)
    return out


def _classes(h: np.ndarray, common: BitFilter) -> np.ndarray:
    """How common each shingle is: the levels that it has in the filter."""
    out, left = np.zeros(len(h), np.int8), np.arange(len(h))
    for level in range(MOST_LEVELS):
        left = left[common(_at_level(h[left], level))]
        if not len(left):
            break
        out[left] += 1
    return out


def _seed_rows(common: BitFilter) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Each node in the regions of its window. Of the nodes of a region, the batch's own pivot alone goes on to meet those of
    other batches, so that no region has more rows under its key than there are batches."""

    def places(column: pa.Array) -> Iterator[tuple]:
        for a, _, row, h, n in _parts(column):
            order = np.lexsort((h, _classes(h, common), row))
            place = np.arange(len(h)) - np.concatenate(([0], np.cumsum(n)))[row]
            within = place < window_size(n)[row]
            yield row[within] + a, h[order][within], place[within], n, set_ids(h, n), _sketches(row, h, n)

    return lambda batches: _seed_batches(batches, places)


def _seed_batches(batches: Iterator[pa.RecordBatch], places: Callable[[pa.Array], Iterator[tuple]]) -> Iterator[pa.RecordBatch]:
    names = [x.split()[0] for x in _ROWS.split(", ")]
    for batch in batches:
        got = list(places(batch.column("text")))
        if not got:
            continue
        row, region, place, n, node = (np.concatenate([x[k] for x in got]) for k in range(5))
        bits = [y for x in got for y in x[5]]
        docs = batch.column("doc_id").to_numpy(zero_copy_only=False).astype(np.int64)
        node = np.where(n > 0, node, mix(docs.view(U) ^ GOLD))  # without words a document is like no other
        by = np.lexsort((docs, node))
        new = np.concatenate(([True], node[by][1:] != node[by][:-1]))
        leads = np.zeros(len(docs), bool)
        leads[by[new]] = True
        m = len(docs)
        none = [pa.nulls(m, pa.int32()), pa.nulls(m, pa.int32()), pa.array(np.zeros(m), pa.int32())]
        sketch = pa.array([x if k else None for x, k in zip(bits, leads.tolist(), strict=True)], pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(signed(mix(docs.view(U)))), pa.nulls(m, pa.int64()), pa.array(signed(node)), pa.nulls(m, pa.int32()), pa.array(n, pa.int32()), pa.array(docs), *none, sketch], names)
        stay = leads[row]
        row, region, place = row[stay], region[stay], place[stay]
        of, size = signed(node)[row], n[row]
        order = np.lexsort((of, place, region))
        of, size, region, place = of[order], size[order], region[order], place[order]
        at = np.flatnonzero(np.concatenate(([True], region[1:] != region[:-1]))) if len(region) else np.zeros(0, np.int64)
        held = np.diff(np.concatenate((at, [len(region)])))
        lead = np.repeat(at, held)
        own = lead == np.arange(len(region))
        key = np.where(own, region, mix(region ^ mix(of.view(U))))
        for a in range(0, len(region), 100_000):
            c = slice(a, a + 100_000)
            far = [pa.array(x[lead[c]], kind, mask=own[c]) for x, kind in ((of, pa.int64()), (place, pa.int32()), (size, pa.int32()))]
            near = [pa.array(signed(key[c])), pa.array(signed(region[c])), pa.array(of[c]), pa.array(place[c], pa.int32()), pa.array(size[c], pa.int32())]
            yield pa.RecordBatch.from_arrays([*near, *far, pa.array(np.where(own[c], np.repeat(held, held)[c], 0), pa.int32()), pa.nulls(len(of[c]), pa.binary())], names)


def _seeds(rows: DataFrame) -> DataFrame:
    """Rows of regions with two nodes or more, each with the pivot to measure against; and the rows without a region."""
    lead = F.col("pivot").isNull()
    by = Window.partitionBy("key").orderBy("place", "node")
    alone = (F.lead("node").over(by).isNull() & F.lag("node").over(by).isNull()) & (F.col("held") == 1)
    first = {x: F.first(x).over(by) for x in ("node", "place", "size")}
    rows = rows.withColumns({"alone": lead & alone, **{f"first_{k}": v for k, v in first.items()}}).filter(~F.col("alone"))
    pick = {"pivot": "node", "pivot_place": "place", "pivot_size": "size"}
    return rows.select("region", "node", "place", "size", *(F.when(lead, F.col(f"first_{x}")).otherwise(F.col(k)).alias(k) for k, x in pick.items()), "bits")


def _near(size_a: str, place_a: str, size_b: str, place_b: str) -> Column:
    """Whether sizes, and places of a common shingle, still allow an overlap of 80 percent of the union."""
    a, b = F.col(size_a), F.col(size_b)
    need = PERCENT * (a + b)
    return (F.least(a, b) * 100 >= F.greatest(a, b) * PERCENT) & (F.least(a - F.col(place_a), b - F.col(place_b)) * (100 + PERCENT) >= need)


def _places() -> Column:
    """_near for the two sides of a join."""
    return _near("x_size", "x_place", "y_size", "y_place")


def _step(size: Column) -> Column:
    """The step of a size."""
    return F.floor(F.log(size) / float(np.log(SIZE_STEP)) + 1e-6)


def _of_size(x: DataFrame) -> DataFrame:
    """Each row with the step of its size."""
    return x.withColumn("step", _step(F.col("size")))


def _by_partner(x: DataFrame) -> DataFrame:
    """Each row once for every step of the sizes that its own size and place leave to another node, if any."""
    size, rest = F.col("size"), F.col("size") - F.col("place")
    most = F.least(size * 100 / PERCENT, rest * (100 + PERCENT) / PERCENT - size)
    least = size * PERCENT / 100
    return x.filter(most + 1e-6 >= least).withColumn("step", F.explode(F.sequence(_step(least - 1e-3), _step(most + 1e-3))))


def _folded(bits: bytes, size: int) -> int:
    """The sketch with 8 * size bits, from one with as many or more."""
    value, have = int.from_bytes(bits, "little"), len(bits)
    while have > size:
        have //= 2
        value = (value >> 8 * have) ^ (value & ((1 << 8 * have) - 1))
    return value


def _possible(percent: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Pairs whose sketches allow a similarity, with a lower bound of their distance: each unequal bit takes a shingle that only
    one of the two has, and the similarity leaves (100 - percent) / (100 + percent) of both sizes for these."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, bound = [], []
            columns = (batch.column(k).to_pylist() for k in ("bits_a", "bits_b", "size_a", "size_b"))
            for x, y, m, n in zip(*columns, strict=True):
                least = min(len(x), len(y))
                unequal = max(abs(m - n), (_folded(x, least) ^ _folded(y, least)).bit_count())
                keep.append(unequal * (100 + percent) <= (100 - percent) * (m + n))
                bound.append(2 * unequal / max(1, m + n + unequal))
            out = batch.select(["a", "b", "doc_a", "doc_b"]).append_column("bound", pa.array(bound, pa.float64()))
            yield out.filter(pa.array(keep, pa.bool_()))

    return run


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Over rows by pivot a and part, the pivot's own text first: the overlap of every other text with it. Rows whose text
    is not that of their node (another document of the same id) don't count."""
    of, own = None, np.zeros(0, U)
    for batch in batches:
        columns = {k: batch.column(k).to_numpy(zero_copy_only=False) for k in ("a", "part", "node", "own")}
        done: list[tuple[int, int, int, int]] = []
        for a, _, row, h, n in _parts(batch.column("text")):
            first, ids = np.concatenate(([0], np.cumsum(n))), signed(set_ids(h, n))
            for k in range(len(n)):
                i = a + k
                if ids[k] != columns["node"][i]:
                    continue
                mine = h[first[k] : first[k + 1]]
                if columns["own"][i]:
                    of, own = (columns["a"][i], columns["part"][i]), mine.copy()
                elif of == (columns["a"][i], columns["part"][i]):
                    at = np.minimum(np.searchsorted(own, mine), len(own) - 1)
                    shared = int((own[at] == mine).sum())
                    done.append((int(of[0]), int(ids[k]), shared, len(own) + len(mine) - shared))
        yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in done], pa.int64()) for k in range(4)], ["a", "b", "n_shared", "n_union"])


class _Join:
    """One join: its documents (doc_id, text), the sketches of its nodes, and the tables it keeps."""

    def __init__(self, docs: DataFrame, few: int) -> None:
        self.docs, self.few = docs, few
        self.tables = Kept(docs.sparkSession)
        rows = docs.mapInArrow(_seed_rows(common_shingles(docs, self.tables)), _ROWS)
        self.seeds = self.tables.keep(_seeds(rows), "seeds")
        sets = self.seeds.filter(F.col("region").isNull()).select("node", F.col("pivot").alias("doc_id"), "size", "bits")
        first = sets.groupBy("node").agg(F.min("doc_id").alias("doc_id"))
        # Each node once, with its first document: the first of its batch too, so it has the sketch.
        self.nodes = self.tables.keep(sets.filter(F.col("bits").isNotNull()).join(first, ["node", "doc_id"], "left_semi").dropDuplicates(["node"]), "nodes")
        self.members = sets.select("doc_id", "node")

    def same_document(self) -> DataFrame:
        """Links between the nodes of documents that share an id."""
        of = self.members.groupBy("doc_id").agg(F.min("node").alias("a"), F.max("node").alias("b")).filter("a <> b").select("doc_id", "a")
        return self.members.join(of, "doc_id").select("a", F.col("node").alias("b")).filter("a <> b").distinct()

    def plausible(self, pairs: DataFrame, percent: int = PERCENT, rows: int | None = None) -> DataFrame:
        """a, b, doc_a, doc_b and a lower bound of the distance of the pairs that their sketches don't rule out. rows: of pairs, at most."""
        side = lambda k: self.nodes.select(F.col("node").alias(k), F.col("doc_id").alias(f"doc_{k}"), F.col("size").alias(f"size_{k}"), F.col("bits").alias(f"bits_{k}"))
        both = pairs.select("a", "b").distinct().join(side("b"), "b").join(side("a"), "a")
        both = both.select("a", "b", "doc_a", "doc_b", "size_a", "size_b", "bits_a", "bits_b")
        return self.tables.keep(both.mapInArrow(_possible(percent), "a long, b long, doc_a long, doc_b long, bound double"), "pairs", rows)

    def measured(self, pairs: DataFrame) -> DataFrame:
        """a, b and the exact overlap and union of plausible pairs. The texts of the b's of one a are measured in parts
        of about TEXTS, each with one copy of a's text, so that no task holds more and no copy is made for each pair."""
        rows = pairs.count()
        if not rows:
            return self.docs.sparkSession.createDataFrame([], "a long, b long, n_shared long, n_union long")
        parts = pairs.groupBy("a").agg(F.ceil(F.count("*") / TEXTS).alias("parts"))
        pairs = pairs.join(hinted(parts, rows), "a").withColumn("part", F.pmod(F.xxhash64("b"), "parts"))
        others = pairs.select("a", "part", F.col("b").alias("node"), F.lit(False).alias("own"), F.col("doc_b").alias("doc_id"))
        pivots = pairs.select("a", "part", F.col("a").alias("node"), F.lit(True).alias("own"), F.col("doc_a").alias("doc_id")).distinct()
        texts = self.docs.select("doc_id", "text").join(hinted(others.union(pivots), 2 * rows), "doc_id").select("a", "part", "node", "own", "text")
        texts = texts.repartition("a", "part").sortWithinPartitions("a", "part", F.desc("own"), "node")
        out = texts.mapInArrow(_measure, "a long, b long, n_shared long, n_union long")
        return self.tables.keep(out.dropDuplicates(["a", "b"]), "measured", rows)

    def links(self, pairs: DataFrame, rows: int | None = None) -> DataFrame:
        """The pairs that are linked, with the exact overlap and union."""
        return self.measured(self.plausible(pairs, rows=rows)).filter(_linked())

    def open(self, places: DataFrame, found: DataFrame) -> DataFrame:
        """Places in regions that hold several components, with the node's component, and whether the region is large."""
        rooted = places.join(found, "node", "left").withColumn("component", F.coalesce("root", "node")).drop("root")
        rooted = self.tables.keep(rooted, "rooted")
        parts = rooted.groupBy("region", "component").agg(F.count("*").alias("n"))
        sizes = parts.groupBy("region").agg(F.sum("n").alias("n"), F.count("*").alias("parts")).filter("parts > 1")
        return self.tables.keep(rooted.join(sizes.select("region", (F.col("n") > self.few).alias("large")), "region"), "open")

    def by_distance(self, places: DataFrame, found: DataFrame, rows: int) -> tuple[list[DataFrame], DataFrame]:
        """Links of large regions, and the components that they make with those known; see the method. rows: the number of places.

        Regions with the same node in their middle (the least place) are one from here on."""
        middle = places.groupBy("region").agg(F.min_by("node", F.struct("place", "node")).alias("middle"))
        core = (F.col("size") - F.col("place")) * (100 + PERCENT) >= 2 * PERCENT * F.col("size")
        places = self.tables.keep(places.withColumn("core", core).join(hinted(middle, rows), "region"), "places", rows)
        cells = places.groupBy(F.col("middle").alias("region"), "node", "size").agg(F.min("place").alias("place"), F.max("core").alias("core"))
        links, level, first, most = [], 0, None, rows
        while True:
            cells = self.tables.keep(cells, "cells", rows)
            rows = cells.count()
            if not rows:
                break
            own = self.tables.keep(found.join(hinted(cells.select("node").distinct(), rows), "node", "left_semi"), "own", rows)
            rooted = cells.join(hinted(own, rows), "node", "left").withColumn("component", F.coalesce("root", "node")).drop("root")
            parts = rooted.groupBy("region", "component").agg(F.count("*").alias("n"))
            main = F.max_by("component", F.struct("n", "component"))
            sizes = parts.groupBy("region").agg(F.sum("n").alias("n"), F.count("*").alias("parts"), main.alias("main")).filter("parts > 1")
            rooted = rooted.join(hinted(sizes, rows), "region").withColumn("minor", F.col("component") != F.col("main")).select("region", "node", "size", "place", "core", "component", "minor", "n")
            rooted = self.tables.keep(rooted if first is None else rooted.drop("minor").join(hinted(first, rows), ["region", "node"]), "open", rows)
            if first is None:
                first = self.tables.keep(rooted.select("region", "node", "minor"), "first", rows)
            small, large = rooted.filter(F.col("n") <= self.few), rooted.filter(F.col("n") > self.few)
            large = large.join(hinted(large.filter("minor AND core").select("region").distinct(), rows), "region", "left_semi")
            met = F.col("x_minor") & (~F.col("y_minor") | (F.col("x_node") < F.col("y_node")))
            links.append(self.links(_apart(small, small, met & _places(), rows)))
            found = self.grown(found, links[-1])
            n_large = large.count()
            if not n_large:
                break
            drawn = F.row_number().over(Window.partitionBy("region").orderBy(F.xxhash64("node", F.lit(level)), "node")) <= PIVOTS * 4**level
            chosen = large.filter("minor AND core").withColumn("drawn", drawn).filter("drawn").select("region", F.col("node").alias("pivot"))
            if level == 0:
                chosen = chosen.union(large.select("region", F.col("region").alias("pivot"))).distinct()
            chosen = self.tables.keep(chosen, "pivots", n_large)
            n_pivots = chosen.count()
            pairs = large.join(hinted(chosen, n_pivots), "region").select("region", "node", "pivot")
            apart = pairs.filter("node <> pivot").select(F.col("pivot").alias("a"), F.col("node").alias("b"))
            near = self.measured(self.plausible(apart, NEAR, n_large * min(n_pivots, PIVOTS * 4**level + 1)))
            links.append(near.filter(_linked()))
            found = self.grown(found, links[-1])
            distance = near.select(F.col("a").alias("pivot"), F.col("b").alias("node"), (1 - F.col("n_shared") / F.col("n_union")).alias("distance"))
            distance = distance.union(chosen.select("pivot", F.col("pivot").alias("node"), F.lit(0.0).alias("distance")).distinct())
            around = self.tables.keep(pairs.join(distance, ["pivot", "node"]), "around")
            home = around.filter(F.col("distance") <= RADIUS).groupBy("region", "node").agg(F.min_by("pivot", F.struct("distance", "pivot")).alias("pivot"))
            home = self.tables.keep(home, "home", n_large)  # the Voronoi region of a node
            info = large.select("region", "node", "size", "place").join(found, "node", "left").withColumn("component", F.coalesce("root", "node")).drop("root")
            info = self.tables.keep(info, "info", n_large)
            seen = around.join(hinted(info, n_large), ["region", "node"])
            inner = seen.join(hinted(home, n_large), ["region", "node", "pivot"], "left_semi")
            of = info.select("region", F.col("node").alias("pivot"), F.col("component").alias("around"))
            outer = seen.join(hinted(of, n_large), ["region", "pivot"]).filter(F.col("component") != F.col("around")).drop("around")
            window = F.abs(F.col("x_distance") - F.col("y_distance")) <= RADIUS
            links.append(self.links(_apart(_of_size(inner), _by_partner(outer), window & _places(), on=["region", "pivot", "step"])))
            found = self.grown(found, links[-1])
            cells = large.join(hinted(home, n_large), ["region", "node"], "left_anti").select("region", "node", "size", "place", "core")
            level, rows = level + 1, n_large
        # What is left: links of a core node of the first largest component with a node outside of it.
        if first is not None:
            sides = places.join(hinted(first.withColumnRenamed("region", "middle"), most), ["middle", "node"]).join(found, "node", "left").withColumn("component", F.coalesce("root", "node"))
            sides = self.tables.keep(sides.select("region", "node", "size", "place", "core", "minor", "component"), "sides")
            main, minor = _of_size(sides.filter("core AND NOT minor")), _by_partner(sides.filter("minor"))
            links.append(self.links(_apart(main, minor, _places(), on=["region", "step"])))
            found = self.grown(found, links[-1])
        return links, found

    def grown(self, found: DataFrame, links: DataFrame) -> DataFrame:
        """The components that new links make with those known."""
        n = links.count()
        if not n:
            return found
        roots = found.select(F.col("root").alias("a"), F.col("node").alias("b"))
        return self.tables.keep(components(links.select("a", "b").union(roots), "a", "b"), "found")


def _apart(x: DataFrame, y: DataFrame, where: Column, rows: int | None = None, on: list[str] | None = None) -> DataFrame:
    """Pairs of nodes that share a region (or what else on names), are in different components and of sizes that may be linked; where: a
    condition on those with the columns of both sides. rows: of y, at most, if known."""
    on = on or ["region"]
    x, y = (t.select(*on, *(F.col(c).alias(f"{k}_{c}") for c in t.columns if c not in on)) for k, t in (("x", x), ("y", y)))
    sizes = F.least("x_size", "y_size") * 100 >= F.greatest("x_size", "y_size") * PERCENT
    met = x.join(y if rows is None else hinted(y, rows), on).filter((F.col("x_node") != F.col("y_node")) & (F.col("x_component") != F.col("y_component")) & sizes)
    return met.filter(where).select(F.least("x_node", "y_node").alias("a"), F.greatest("x_node", "y_node").alias("b"))


def _linked() -> Column:
    return F.col("n_shared") * 100 >= F.col("n_union") * PERCENT


def similar_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", few: int = FEW) -> tuple[DataFrame, DataFrame]:
    """(documents, spanning): doc_id, n_shingles and component_id (the class of linked documents) of every document; and the
    measured links, between sets (a, b: their 64-bit hashes), that connect each class. These are not all links: within a
    class, pairs whose link would connect nothing further are not measured.

    Null and empty texts have no shingles and no links. A document with a null id links with nothing and has a null
    component. Rows that share an id are one document, linked when any of its texts is. Other columns are ignored. few: regions
    of more nodes are split further; results don't depend on it. Sets and shingles are told apart by 64-bit hashes.
    """
    docs = id_and_text(docs, id_col, text_col)
    join = _Join(docs.filter(F.col("doc_id").isNotNull()), few)
    tables, pair = join.tables, lambda x: x.select("a", "b")
    placed = join.seeds.filter(F.col("region").isNotNull())
    near = placed.filter((F.col("pivot") != F.col("node")) & _near("size", "place", "pivot_size", "pivot_place"))
    links = [join.links(near.select(F.col("pivot").alias("a"), F.col("node").alias("b")))]
    found = tables.keep(components(pair(links[0]).union(join.same_document()), "a", "b"), "found")

    open_ = join.open(placed.select("region", "node", "size", "place"), found)
    small, large = (open_.filter(F.col("large") == x).drop("large") for x in (False, True))
    links.append(join.links(_apart(small, small, (F.col("x_node") < F.col("y_node")) & _places())))
    found = join.grown(found, links[-1])
    rows = large.count()
    if rows:
        more, found = join.by_distance(large.select("region", "node", "size", "place"), found, rows)
        links += more
    spanning = reduce(DataFrame.unionByName, links)

    rooted = join.nodes.select("node", F.col("doc_id").alias("first"), "size").join(found, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    classes = rooted.join(least, "root").select("node", F.col("size").cast("long").alias("n_shingles"), "component_id")
    out = tables.keep(join.members, "members").join(classes, "node").select("doc_id", "n_shingles", "component_id")
    tables.drop(join.seeds)
    unnamed = docs.filter(F.col("doc_id").isNull()).mapInArrow(_sizes, "doc_id long, n_shingles long")
    return out.unionByName(unnamed.withColumn("component_id", F.lit(None).cast("long"))), spanning


def _sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n = [x for *_, x in _parts(batch.column("text"))]
        n = pa.array(np.concatenate(n) if n else np.zeros(0), pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), n], ["doc_id", "n_shingles"])
