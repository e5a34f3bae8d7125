"""SimHash near-duplicate detection by tiled exact comparison.

Fingerprints are compared exactly, tile against tile, with numpy exclusive-or
and bit counts.  A fingerprint's population counts (those of its four 16-bit
quarters) place it in a cell.  Two fingerprints within ``radius`` bits have
population counts that differ by ``radius`` at most in sum, so only tiles of
cells that close are paired; all other tile pairs are skipped unread.

Scale: copies collapse to one row per distinct fingerprint before anything is
compared (with partial aggregation, so a group holding a third of the corpus
costs one row a task).  Cells are cut into tiles of about ``TILE`` rows, so a
crowded cell becomes many tiles and many small tasks.  Of 41 cells within
reach of a cell half are probed, which is about one pair in 75 of all pairs.

Edge cases: null and empty texts and texts without words have fingerprint 0
and link like any other.  Rows with a null id keep a fingerprint but name no
component: they take part in links, and get the component of their group
(null if no row of it has an id).  Repeated rows stay, with equal results.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, materialize
from .components import connected_components
from .words import slices

SEED, SHINGLE, RADIUS, TILE = 42, 3, 2, 1024
QUARTERS, BASE = 4, 32


def fingerprint(text: str | None, width: int = SHINGLE) -> int:
    """64-bit SimHash over word shingles: a bit is set if set in over half of the shingles' XXH64."""
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    runs = [words[i:] for i in range(width)]
    shingles = map(b" ".join, zip(*runs, strict=False)) if len(words) >= width else [b" ".join(words)]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(s, SEED) for s in shingles], dtype="<u8")
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        block = hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp long): one row per input row, whole texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            fps = np.fromiter((fingerprint(t.as_py()) for t in batch.column("text")), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(fps.view(np.int64))], ["doc_id", "fp"])

    kept = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return kept.mapInArrow(run, "doc_id long, fp long")


def _cell():
    """Population counts of the quarters as digits of a number; two spare digits on each side keep neighbours apart."""
    digits = [(F.bit_count(F.shiftrightunsigned("fp", 16 * i).bitwiseAND(F.lit(0xFFFF))) + 2) * BASE**i for i in range(QUARTERS)]
    return sum(digits[1:], digits[0]).cast("long")


def _steps(radius: int) -> list[int]:
    """Cell distances within the radius, one of each pair of opposite ones."""
    near = [d for d in product(range(-radius, radius + 1), repeat=QUARTERS) if sum(map(abs, d)) <= radius]
    return sorted({abs(sum(x * BASE**i for i, x in enumerate(d))) for d in near})


def _forest(hit: np.ndarray, same: bool) -> list[tuple[int, int]]:
    """Links that span the same components as ``hit``; rows and columns are one set if ``same``."""
    rows, cols = np.nonzero(hit)
    if len(rows) <= sum(hit.shape):
        return list(zip(rows.tolist(), cols.tolist(), strict=True))
    out: list[tuple[int, int]] = []
    free_r, free_c = np.ones(hit.shape[0], bool), np.ones(hit.shape[1], bool)
    if same:
        hit = hit | hit.T
    for start in np.unique(rows).tolist():
        if not free_r[start]:
            continue
        free_r[start] = False
        stack = [(start, True)]
        while stack:
            k, is_row = stack.pop()
            if is_row:
                new = np.nonzero(hit[k] & (free_r if same else free_c))[0].tolist()
                (free_r if same else free_c)[new] = False
                out += [(k, c) for c in new]
                stack += [(c, same) for c in new]
            else:
                new = np.nonzero(hit[:, k] & free_r)[0].tolist()
                free_r[new] = False
                out += [(r, k) for r in new]
                stack += [(r, True) for r in new]
    return out


def _compare(radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            us, vs = [], []
            for same, a, b in zip(*(batch.column(c) for c in ("same", "a", "b")), strict=True):
                x, y = (z.values.to_numpy(zero_copy_only=False).view(np.uint64) for z in (a, b))
                hit = np.bitwise_count(x[:, None] ^ y[None, :]) <= radius
                if same := same.as_py():
                    hit = np.triu(hit, 1)
                if hit.any():
                    i, j = np.array(_forest(hit, same)).T
                    us.append(x[i].view(np.int64))
                    vs.append(y[j].view(np.int64))
            if us:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(us)), pa.array(np.concatenate(vs))], ["u", "v"])

    return run


def links(fps: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """Links (u, v) between distinct fingerprints, enough to span every component.

    ``fps`` has one row per distinct fingerprint.  Within a pair of tiles a
    spanning forest of the links is kept, so a dense group of near copies
    yields as many links as it has members, not their square.
    """
    placed = fps.select("fp", _cell().alias("cell"))
    # 17 population counts for each of four quarters: never over 83,521 rows of two numbers
    crowd = placed.groupBy("cell").agg(F.ceil(F.count("*") / tile).cast("long").alias("k"))
    tiles = placed.join(F.broadcast(crowd), "cell").withColumn("part", F.pmod(F.xxhash64("fp", F.lit(7)), F.col("k")))
    tiles = materialize(tiles.groupBy("cell", "part").agg(F.collect_list("fp").alias("b")), "tiles")
    probes = tiles.select(F.col("cell").alias("own"), F.col("part").alias("own_part"), F.col("b").alias("a"), F.explode(F.array(*map(F.lit, _steps(radius)))).alias("step")).withColumn("cell", (F.col("own") + F.col("step")).cast("long"))
    pairs = probes.join(tiles, "cell").filter((F.col("step") != 0) | (F.col("own_part") <= F.col("part")))
    same = (F.col("step") == 0) & (F.col("own_part") == F.col("part"))
    return pairs.select(same.alias("same"), "a", "b").mapInArrow(_compare(radius), "u long, v long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS) -> DataFrame:
    """(doc_id, fp, component_id): component_id is the smallest id reachable over links."""
    rows = materialize(fingerprints(docs, id_col, text_col), "fingerprints")
    distinct = materialize(rows.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "distinct")
    roots = connected_components(links(distinct.select("fp"), radius))
    named = distinct.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "least_id", F.coalesce("root", "fp").alias("root"))
    named = materialize(named, "named")
    whole = materialize(named.groupBy("root").agg(F.min("least_id").alias("component_id")), "components")
    by_fp = materialize(named.join(whole, "root").select("fp", "component_id"), "by_fp")
    discard(distinct, named, whole)
    return rows.join(by_fp, "fp").select("doc_id", "fp", "component_id")


def hex_digits(column):
    """An unsigned 64-bit number as 16 lowercase hex digits."""
    return F.lower(F.lpad(F.hex(column), 16, "0"))
