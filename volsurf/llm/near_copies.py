"""Near copies of texts: wide SimHash candidates by tiled comparison, confirmed by exact Jaccard similarity.

Two texts are linked if the sets of their WIDTH-word shingles have a Jaccard
similarity of SIMILARITY or more.  Texts with equal sets collapse to one node.
Every node has a SimHash of 128 bits; unlike ``simhash.links``, whose radius of
2 is the result itself, fingerprints only propose here, and the radius is as
wide as the similarity demands: at a similarity of 0.8 a bit differs with a
chance of 0.151, 19.4 of 128 bits are expected to differ, and RADIUS lies 3.6
standard deviations above that (a pair right at 0.8 is missed about twice in
10,000; closer ones never in practice).  Nodes of few shingles, whose bits are
coarser, have the wider radius SMALL.

Nodes go to tiles of TILE rows or TILE_SHINGLES shingles at most, by the sizes
of their sets, and within a band of nearly equal sizes by a hash.  Sizes within
a factor of SIMILARITY and population counts within the radius
are necessary, so tile pairs beyond either are skipped; the others are
compared in full with numpy exclusive-or and bit counts.  At this radius
population counts skip little and sizes most: the comparison stays quadratic in
distinct texts of similar length, at about 1 ns a pair.

A tile pair first names the nodes that have candidates.  The shingle sets of
these, and of no other nodes, are made once and shipped to the pair's task as
one block, where candidates are confirmed against them: no pair is ever a row.
First the tiles by themselves, then pairs of tiles, which start from the
components that the first step has found.  Within a task candidates come
closest first; one whose ends are connected already is skipped.  A sharper sketch
comes before the exact test: sets hashed to bitmaps of 16 bits a member bound
their intersection from above by the common bits and the members that share a
bit, so a pair that fails this bound can't be linked.  A task gives a spanning
forest of its links.  So a graded group costs bitmap tests in proportion to its
pairs that are alike but not linked, some 2 µs each, and exact ones only near
the threshold.

Shingle sets never leave the cluster.  A task holds those of two tiles at most.

Edge cases: texts of fewer than WIDTH words have one shingle, all their words;
null, empty and blank texts have none and are copies of each other.  Of a
group the row with the smallest id stays, of equal ids the one with the
smaller text hash, of equal rows one; null ids count as the largest.  Extra
columns pass through.  An empty table stays empty.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, materialize, small_batches
from .components import connected_components
from .words import give_back, slices

WIDTH, SIMILARITY, SEED = 5, 0.8, 42
TILE, TILE_SHINGLES, BAND = 16_384, 8_000_000, 0.01
#: Candidates that are confirmed before the others are looked through again for those whose ends have been connected.
CHUNK = 512
#: Bits of a member in the bitmaps of sets, and the most 64-bit words of one.
SPREAD, MOST_WORDS = 16, 256
#: Bits that may differ of the first 64 and of all 128, from SMALL_SIZE shingles on and below.
RADIUS, SMALL, SMALL_SIZE = (20, 34), (24, 42), 64
BROADCAST_ROWS = 500_000
_BLOCK = 128
_NODE = np.dtype([("node", "<i8"), ("low", "<u8"), ("high", "<u8"), ("size", "<i4")])


def shingles(text: str | None, width: int = WIDTH) -> np.ndarray:
    """The sorted distinct XXH64 values of a text's word shingles; words as in ``simhash.fingerprint``."""
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    runs = map(b" ".join, zip(*(words[i:] for i in range(width)), strict=False)) if len(words) >= width else [b" ".join(words)]
    digest = xxhash.xxh64_intdigest
    return np.unique(np.array([digest(s, SEED) for s in runs], np.uint64))


def _node_of(hashes: np.ndarray) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(hashes.tobytes(), SEED) - (1 << 63)


def _majority(hashes: np.ndarray) -> int:
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        block = np.ascontiguousarray(hashes[at : at + (1 << 16)]).view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view("<u8")[0])


def sketch(hashes: np.ndarray) -> tuple[int, int]:
    """128 bits: the majorities of the hashes' bits and of those of a second mix of them."""
    mixed = hashes * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(32)
    return _majority(hashes), _majority(mixed * np.uint64(0xD6E8FEB86659FD93))


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, two hashes of the text that stand for it together, and the text."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return small_batches(docs).select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("k1"), F.xxhash64(F.lit(7), text).alias("k2"), text.alias("text"))


def sketches(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, k1, k2, node, low, high, size) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            out = np.zeros(batch.num_rows, _NODE)
            for i, text in enumerate(batch.column("text")):
                found = shingles(text.as_py())
                out[i] = (_node_of(found), *sketch(found), len(found))
            made = [pa.array(np.ascontiguousarray(out[c]).view(k)) for c, k in (("node", np.int64), ("low", np.int64), ("high", np.int64), ("size", np.int32))]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", "k1", "k2")), *made], ["doc_id", "k1", "k2", "node", "low", "high", "size"])

    return _keyed(docs, id_col, text_col).mapInArrow(run, "doc_id long, k1 long, k2 long, node long, low long, high long, size int")


def _plan(counts: list[tuple[int, int, int]], tile: int, most: int = TILE_SHINGLES) -> list[tuple[int, int, int]]:
    """(band, first tile, tiles) from the rows and shingles of each band: neighbouring bands share a tile until it is full, a crowded one has several."""
    out, at, held, shingled = [], 0, 0, 0
    for band, n, total in counts:
        if held and (held + n > tile or shingled + total > most):
            at, held, shingled = at + 1, 0, 0
        k = max(1, -(-n // tile), -(-total // most))
        out.append((band, at, k))
        at, held, shingled = (at, held + n, shingled + total) if k == 1 else (at + k, 0, 0)
    return out


def _tiles(nodes: DataFrame, tile: int) -> DataFrame:
    """Nodes of similar sizes together: (tile, least and greatest size, least and greatest population count, rows as bytes)."""
    banded = nodes.select("node", "low", "high", "size", F.floor(F.log(F.greatest("size", F.lit(1))) / BAND).cast("int").alias("band"))
    # sizes are below 2^31: at most 2149 bands
    counts = sorted(map(tuple, banded.groupBy("band").agg(F.count("*").alias("n"), F.sum("size").alias("total")).collect()))
    plan = F.broadcast(nodes.sparkSession.createDataFrame(_plan(counts, tile), "band int, first int, tiles int"))
    placed = banded.join(plan, "band").withColumn("tile", (F.col("first") + F.pmod(F.xxhash64(F.lit(5), "node"), F.col("tiles"))).cast("long"))

    def pack(group: pa.Table) -> pa.Table:
        rows = np.zeros(group.num_rows, _NODE)
        for c in _NODE.names:
            rows[c] = group.column(c).to_numpy().view(_NODE[c])
        rows.sort(order=["size", "node"])
        ones = np.bitwise_count(rows["low"])
        values = [group.column("tile")[0].as_py(), int(rows["size"][0]), int(rows["size"][-1]), int(ones.min()), int(ones.max()), rows.tobytes()]
        kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.binary())
        return pa.table({n: pa.array([v], t) for n, v, t in zip(("tile", "least", "most", "few", "many", "rows"), values, kinds, strict=True)})

    return placed.select("tile", "node", "low", "high", "size").groupBy("tile").applyInArrow(pack, "tile long, least int, most int, few int, many int, rows binary")


def _tile_pairs(tiles: DataFrame) -> DataFrame:
    """(a, b) of tiles that may hold links, each once; sizes meet in bands of a factor, so pairs come from one equi-join."""
    bounds = tiles.select("tile", "least", "most", "few", "many")
    step = float(-np.log(SIMILARITY))
    band = lambda c: F.floor(F.log(F.greatest(F.col(c), F.lit(1))) / step).cast("int")
    a = bounds.select(*(F.col(c).alias(f"a_{c}") for c in bounds.columns), F.explode(F.sequence(band("least"), band("most") + 1)).alias("band"))
    b = bounds.select(*(F.col(c).alias(f"b_{c}") for c in bounds.columns), F.explode(F.sequence(band("least"), band("most"))).alias("band"))
    wide = SMALL[0]
    near = (F.col("b_least") * SIMILARITY <= F.col("a_most")) & (F.col("a_least") * SIMILARITY <= F.col("b_most"))
    near &= (F.col("b_few") - F.col("a_many") <= wide) & (F.col("a_few") - F.col("b_many") <= wide)
    found = a.join(b, "band").filter(near)
    return found.select(F.least("a_tile", "b_tile").alias("a"), F.greatest("a_tile", "b_tile").alias("b")).distinct()


class _Groups:
    """Labels of rows, equal where they are known to be connected."""

    def __init__(self, labels: np.ndarray):
        self.labels = np.unique(labels, return_inverse=True)[1]

    def confirm(self, i: np.ndarray, j: np.ndarray, linked: Callable[[int, int], bool]) -> list[int]:
        """Tries the pairs (i, j) in order where their ends are apart; the numbers of those that were linked, a forest."""
        up: dict[int, int] = {}
        taken = []

        def root(x: int) -> int:
            while (y := up.get(x, x)) != x:
                up[x] = up.get(y, y)
                x = y
            return x

        for k, (m, n, x, y) in enumerate(zip(i.tolist(), j.tolist(), self.labels[i].tolist(), self.labels[j].tolist(), strict=True)):
            x, y = root(x), root(y)
            if x != y and linked(m, n):
                up[max(x, y)] = min(x, y)
                taken.append(k)
        if up:
            move = np.arange(int(self.labels.max()) + 1)
            move[np.fromiter(up, np.int64, len(up))] = [root(x) for x in list(up)]
            self.labels = move[self.labels]
        return taken


class _Sets:
    """Shingle sets of rows, with a bitmap of each."""

    def __init__(self, values: np.ndarray, ends: np.ndarray):
        self.values, self.ends = values, ends
        self.size = np.diff(ends)
        most = int(self.size.max(initial=1))
        words = 1 << max(0, int(most * SPREAD - 1).bit_length() - 6)
        self.words = min(max(words, 1), MOST_WORDS)
        bits = (values >> np.uint64(17)) % np.uint64(self.words * 64)
        self.bitmap = np.zeros((len(self.size), self.words), np.uint64)
        row = np.repeat(np.arange(len(self.size)), self.size)
        np.bitwise_or.at(self.bitmap, (row, (bits >> np.uint64(6)).astype(np.int64)), np.uint64(1) << (bits & np.uint64(63)))
        #: members that share their bit with another one
        self.lost = self.size - np.bitwise_count(self.bitmap).sum(1, dtype=np.int64)

    def may_link(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Whether the sets can be similar, from a bound on what they have in common."""
        out = np.zeros(len(i), bool)
        step = max(1, (1 << 21) // self.words)
        for at in range(0, len(i), step):
            a, b = i[at : at + step], j[at : at + step]
            common = np.bitwise_count(self.bitmap[a] & self.bitmap[b]).sum(1, dtype=np.int64) + np.minimum(self.lost[a], self.lost[b])
            out[at : at + step] = common >= SIMILARITY * (self.size[a] + self.size[b] - common) - 1e-9
        return out

    def linked(self, i: int, j: int) -> bool:
        a, b = self.values[self.ends[i] : self.ends[i + 1]], self.values[self.ends[j] : self.ends[j + 1]]
        common = len(np.intersect1d(a, b, assume_unique=True))
        return common >= SIMILARITY * (len(a) + len(b) - common) - 1e-9


def _hits(x: np.ndarray, y: np.ndarray, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Index pairs, with how many bits differ, within the radius and the ratio of sizes, block by block; x and y are sorted by size."""
    x_low, y_low = (np.ascontiguousarray(z["low"]) for z in (x, y))
    width = 4096
    differ, ones, close = (np.empty(_BLOCK * width, t) for t in (np.uint64, np.uint8, bool))
    for lo in range(0, len(x), _BLOCK):
        part = x[lo : lo + _BLOCK]
        near, whole = SMALL if part["size"][0] < SMALL_SIZE else RADIUS
        begin = max(int(np.searchsorted(y["size"], np.floor(part["size"][0] * SIMILARITY))), lo + 1 if same else 0)
        end = int(np.searchsorted(y["size"], np.ceil(part["size"][-1] / SIMILARITY), side="right"))
        for at in range(begin, end, width):
            n = min(width, end - at)
            cells = len(part) * n
            shaped = lambda z: z[:cells].reshape(len(part), n)  # noqa: B023, E731
            np.bitwise_xor(x_low[lo : lo + len(part), None], y_low[None, at : at + n], out=shaped(differ))
            np.bitwise_count(differ[:cells], out=ones[:cells])
            np.less_equal(ones[:cells], near, out=close[:cells])
            close[cells : cells + 7] = False
            # eight at a time, as hits are few
            some = np.flatnonzero(close[: -(-cells // 8) * 8].view(np.uint64))
            if not len(some):
                continue
            spot = (some[:, None] * 8 + np.arange(8)).ravel()
            i, j = np.divmod(spot[close[spot]], n)
            i, j = i + lo, j + at
            bits = np.bitwise_count(x["low"][i] ^ y["low"][j]) + np.bitwise_count(x["high"][i] ^ y["high"][j])
            s, t = x["size"][i].astype(np.int64), y["size"][j].astype(np.int64)
            keep = (bits <= whole) & (np.minimum(s, t) >= SIMILARITY * np.maximum(s, t) - 1e-9)
            if same:
                keep &= i < j
            if keep.any():
                yield i[keep], j[keep], bits[keep]


def _rows(value: bytes) -> np.ndarray:
    return np.frombuffer(value, _NODE)


def _named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each tile pair (a, b, rows of both): the nodes that have a candidate, as rows (a, b, node)."""
    for batch in batches:
        for k in range(batch.num_rows):
            row = batch.slice(k, 1).to_pylist()[0]
            same = row["a"] == row["b"]
            x, y = _rows(row["a_rows"]), _rows(row["b_rows"])
            left, right = np.zeros(len(x), bool), np.zeros(len(y), bool)
            for i, j, _ in _hits(x, y, same):
                left[i] = True
                right[j] = True
            if same:
                left |= right
            nodes = x["node"][left] if same else np.concatenate([x["node"][left], y["node"][right]])
            if len(nodes):
                full = lambda v: pa.array(np.full(len(nodes), v))  # noqa: B023, E731
                yield pa.RecordBatch.from_arrays([full(row["a"]), full(row["b"]), pa.array(np.ascontiguousarray(nodes))], ["a", "b", "node"])


def _block(key: tuple, group: pa.Table) -> pa.Table:
    """The sets of a tile pair's nodes in one row: nodes, where each set ends, and their values, as bytes."""
    lists = group.column("shingles").combine_chunks()
    ends = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())]).astype("<i8")
    values = np.ascontiguousarray(lists.flatten().to_numpy()).astype("<i8", copy=False)
    made = [key[0].as_py(), key[1].as_py(), group.column("node").to_numpy().astype("<i8").tobytes(), ends.tobytes(), values.tobytes()]
    kinds = (pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary())
    return pa.table({n: pa.array([v], t) for n, v, t in zip(("a", "b", "nodes", "ends", "sets"), made, kinds, strict=True)})


def _confirmed(row: dict) -> tuple[np.ndarray, np.ndarray]:
    """The links (u, v) of a tile pair that connect what is apart."""
    same = row["a"] == row["b"]
    held = np.frombuffer(row["nodes"], "<i8")
    order = np.argsort(held)
    # only nodes with candidates come again
    x, y = (r[np.isin(r["node"], held)] for r in (_rows(row["a_rows"]), _rows(row["b_rows"])))
    nodes = x["node"] if same else np.concatenate([x["node"], y["node"]])
    at = order[np.searchsorted(held, nodes, sorter=order)]
    ends, values = np.frombuffer(row["ends"], "<i8"), np.frombuffer(row["sets"], "<u8")
    sets = _Sets(values, ends)
    known = dict(zip(row["labelled"] or (), row["labels"] or (), strict=True))
    groups = _Groups(np.array([known.get(v, v) for v in nodes.tolist()], np.int64))
    us, vs = [], []
    shift = 0 if same else len(x)
    for i, j, bits in _hits(x, y, same):
        j = j + shift
        nearest = np.argsort(bits, kind="stable")
        i, j, size = i[nearest], j[nearest], CHUNK
        while len(i):
            apart = groups.labels[i] != groups.labels[j]
            i, j = i[apart], j[apart]
            some = np.flatnonzero(sets.may_link(at[i[:size]], at[j[:size]]))
            taken = groups.confirm(i[some], j[some], lambda m, n: sets.linked(at[m], at[n]))
            us.append(nodes[i[some[taken]]])
            vs.append(nodes[j[some[taken]]])
            i, j, size = i[size:], j[size:], 2 * size
    return tuple(np.concatenate([np.zeros(0, np.int64), *z]) for z in (us, vs))


def _confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(batch.num_rows):
            u, v = _confirmed(batch.slice(k, 1).to_pylist()[0])
            if len(u):
                yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(u)), pa.array(np.ascontiguousarray(v))], ["u", "v"])
    give_back()


def _sets(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(node, shingles) of nodes; ``wanted`` (node, k1, k2) names one text of each."""
    wanted = F.broadcast(wanted) if wanted.count() <= BROADCAST_ROWS else wanted
    texts = _keyed(docs, id_col, text_col).drop("doc_id").join(wanted, ["k1", "k2"]).select("node", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in slices(batches):
            ids = batch.column("node").to_pylist()
            new = [k for k, v in enumerate(ids) if v not in seen and not seen.add(v)]
            if new:
                made = [shingles(batch.column("text")[k].as_py()).view(np.int64) for k in new]
                offsets = np.concatenate([[0], np.cumsum([len(m) for m in made])]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(made)))
                yield pa.RecordBatch.from_arrays([pa.array([ids[k] for k in new], pa.int64()), lists], ["node", "shingles"])

    return texts.mapInArrow(run, "node long, shingles array<long>").groupBy("node").agg(F.first("shingles").alias("shingles"))


def links(docs: DataFrame, nodes: DataFrame, id_col: str = "doc_id", text_col: str = "text", tile: int = TILE) -> DataFrame:
    """The components (node, root) of confirmed links; nodes without a smaller one in their component are absent."""
    tiles = materialize(_tiles(nodes, tile), "tiles")
    rows = tiles.select("tile", "rows")
    pairs = _tile_pairs(tiles)
    named = materialize(pairs.join(rows.toDF("a", "a_rows"), "a").join(rows.toDF("b", "b_rows"), "b").mapInArrow(_named, "a long, b long, node long"), "candidates")
    ends = materialize(named.select("node").distinct(), "ends")
    sets = materialize(_sets(docs, nodes.select("node", "k1", "k2").join(ends, "node"), id_col, text_col), "shingles")
    # a pair's block holds TILE_SHINGLES shingles of each tile at most
    blocks = materialize(named.join(sets, "node").groupBy("a", "b").applyInArrow(_block, "a long, b long, nodes binary, ends binary, sets binary"), "blocks")
    work = blocks.join(rows.toDF("a", "a_rows"), "a").join(rows.toDF("b", "b_rows"), "b")
    none = F.lit(None).cast("array<long>")
    alone = work.filter("a = b").withColumns({"labelled": none, "labels": none})
    found = materialize(alone.mapInArrow(_confirm, "u long, v long"), "links")
    labels = connected_components(found)
    # labels of the nodes that have moved, by the pairs that ask for them
    moved = named.filter("a != b").join(labels, "node").groupBy("a", "b").agg(F.collect_list(F.struct("node", "root")).alias("m"))
    moved = moved.select("a", "b", F.col("m.node").alias("labelled"), F.col("m.root").alias("labels"))
    more = materialize(work.filter("a != b").join(moved, ["a", "b"], "left").mapInArrow(_confirm, "u long, v long"), "links")
    whole = connected_components(found.unionByName(more))
    discard(tiles, named, ends, sets, blocks, found, labels, more)
    return whole


def grouped(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tile: int = TILE) -> tuple[DataFrame, DataFrame]:
    """Rows (doc_id, k1, k2, node) and groups (node, k1, k2, root, null_id, keep_id, keep_k1, keep_k2): what stays of the node's group."""
    rows = materialize(sketches(docs, id_col, text_col), "sketches")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("null_id"), "doc_id", "k1", "k2")).alias("best")
    values = [F.first(c).alias(c) for c in ("low", "high", "size")]
    nodes = rows.groupBy("node").agg(first, *values)
    nodes = materialize(nodes.select("node", "best", F.col("best.k1").alias("k1"), F.col("best.k2").alias("k2"), "low", "high", "size"), "nodes")
    roots = links(docs, nodes, id_col, text_col, tile)
    named = materialize(nodes.join(roots, "node", "left").select("node", "best", F.coalesce("root", "node").alias("root")), "named")
    best = materialize(named.groupBy("root").agg(F.min("best").alias("keep")), "kept")
    return rows.select("doc_id", "k1", "k2", "node"), materialize(named.join(best, "root").select("node", "root", "keep"), "groups")


def representatives(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tile: int = TILE) -> DataFrame:
    """The rows of ``docs`` less near copies: one row of each group stays, with all its columns."""
    rows, groups = grouped(docs, id_col, text_col, tile)
    counted = rows.groupBy("node", "k1", "k2", "doc_id").agg(F.count("*").alias("n"))
    counted = materialize(counted.join(groups, "node").select("root", "k1", "k2", "doc_id", "n", "keep"), "counted")
    # texts of groups with more than one row: which of their ids stays, if any
    crowds = counted.groupBy("root").agg(F.sum("n").alias("n")).filter("n > 1").select("root")
    texts = counted.join(crowds, "root").select("k1", "k2", "keep").distinct()
    stays = (F.col("keep.k1") == F.col("k1")) & (F.col("keep.k2") == F.col("k2"))
    texts = materialize(texts.select(F.col("k1").alias("_k1"), F.col("k2").alias("_k2"), stays.alias("_stays"), F.col("keep.doc_id").alias("_keep")), "copies")
    again = materialize(counted.filter(stays & F.col("keep.doc_id").eqNullSafe(F.col("doc_id")) & (F.col("n") > 1)).select(F.col("k1").alias("_k1"), F.col("k2").alias("_k2")), "repeated")
    # one column holds the row, so that no name clashes
    text = F.coalesce(F.col(text_col), F.lit(""))
    whole = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row"), F.col(id_col).cast("long").alias("_id"), F.xxhash64(text).alias("_k1"), F.xxhash64(F.lit(7), text).alias("_k2"))
    texts = F.broadcast(texts) if texts.count() <= BROADCAST_ROWS else texts
    kept = whole.join(texts, ["_k1", "_k2"], "left").filter(F.col("_stays").isNull() | F.col("_stays") & F.col("_id").eqNullSafe(F.col("_keep")))
    n = again.count()
    if not n:
        return kept.select("_row.*")
    again = F.broadcast(again) if n <= BROADCAST_ROWS else again
    once = kept.join(again, ["_k1", "_k2"], "left_anti").select("_row")
    one = kept.join(again, ["_k1", "_k2"], "left_semi").groupBy("_k1", "_k2").agg(F.max_by("_row", F.to_json("_row")).alias("_row")).select("_row")
    return once.unionByName(one).select("_row.*")
