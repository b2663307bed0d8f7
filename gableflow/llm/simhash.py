"""Operator 10: SimHash near-dedup with bit-sliced comparison.

Fingerprints are computed in numpy batches. Distinct fingerprints that agree in two of radius + 2 blocks of bits meet in a
bucket; a pair within the radius must. Buckets are cut into tiles of bounded size, of which those that cannot connect
anything new are left out. A tile's fingerprints are compared with bit planes stored vertically: one XOR of a plane
advances 64 distances, carry-save counters add them up, and a block is abandoned once all its distances exceed the radius.
A tile returns a star of links for each of its components, never all pairs. Components are then joined up over all tiles.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import discard, in_batches, slices, table, whole_text, written
from .components import connected

RADIUS, SHINGLE, TILE = 3, 3, 4096

#: XXH64 as published: fixed values.
P1, P2, P3, P4, P5 = (np.uint64(x) for x in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))
SEED = 42


def _rotl(x: np.ndarray, r: int) -> np.ndarray:
    return (x << np.uint64(r)) | (x >> np.uint64(64 - r))


def _round(acc, lane: np.ndarray) -> np.ndarray:
    return _rotl(acc + lane * P2, 31) * P1


def xxh64(buf: bytes, start: np.ndarray, length: np.ndarray, seed: int = SEED) -> np.ndarray:
    """XXH64 of many slices of one buffer at once. The buffer must have 8 more bytes than the slices use."""
    lanes = np.ndarray((len(buf) - 7,), "<u8", buffer=buf, strides=(1,))
    quads = np.ndarray((len(buf) - 3,), "<u4", buffer=buf, strides=(1,))
    octets = np.frombuffer(buf, np.uint8)
    with np.errstate(over="ignore"):
        s = np.uint64(seed)
        h = np.full(len(start), s + P5)
        pos, left = start.astype(np.int64), length.astype(np.int64)
        if len(long := np.flatnonzero(left >= 32)):
            acc = [np.full(len(long), x) for x in (s + P1 + P2, s + P2, s, s - P1)]
            stripes, at, on, k = left[long] // 32, pos[long], np.arange(len(long)), 0
            while len(on):
                for i in range(4):
                    acc[i][on] = _round(acc[i][on], lanes[at[on] + 32 * k + 8 * i])
                k += 1
                on = on[stripes[on] > k]
            x = _rotl(acc[0], 1) + _rotl(acc[1], 7) + _rotl(acc[2], 12) + _rotl(acc[3], 18)
            for a in acc:
                x = (x ^ _round(np.uint64(0), a)) * P1 + P4
            h[long] = x
            pos[long] += 32 * stripes
            left[long] -= 32 * stripes
        h += length.astype(np.uint64)
        for _ in range(3):
            if not len(on := np.flatnonzero(left >= 8)):
                break
            h[on] = _rotl(h[on] ^ _round(np.uint64(0), lanes[pos[on]]), 27) * P1 + P4
            pos[on] += 8
            left[on] -= 8
        on = np.flatnonzero(left >= 4)
        h[on] = _rotl(h[on] ^ (quads[pos[on]].astype(np.uint64) * P1), 23) * P2 + P3
        pos[on] += 4
        left[on] -= 4
        for _ in range(3):
            if not len(on := np.flatnonzero(left > 0)):
                break
            h[on] = _rotl(h[on] ^ (octets[pos[on]].astype(np.uint64) * P5), 11) * P1
            pos[on] += 1
            left[on] -= 1
        h ^= h >> np.uint64(33)
        h *= P2
        h ^= h >> np.uint64(29)
        h *= P3
        h ^= h >> np.uint64(32)
    return h


def shingle_hashes(texts: list[str | None], shingle: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(how many shingles each text has, all their hashes in order). Repeats count; fewer words make one shingle, none none."""
    words: list[bytes] = []
    count = np.zeros(len(texts), np.int64)
    for i, text in enumerate(texts):
        own = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: only A-Z change, only ASCII space splits
        count[i] = len(own)
        words += own
    made = np.where(count > 0, np.maximum(count - shingle + 1, 1), 0)
    if not words:
        return made, np.zeros(0, np.uint64)
    size = np.fromiter(map(len, words), np.int64, len(words))
    begin = np.cumsum(size + 1) - (size + 1)
    buf = b" ".join(words) + bytes(8)
    del words
    first = np.arange(made.sum()) + np.repeat(np.cumsum(count) - count - (np.cumsum(made) - made), made)
    last = first + np.repeat(np.minimum(count, shingle) - 1, made)
    out = np.empty(len(first), np.uint64)
    for at in range(0, len(out), 1 << 16):
        f, t = first[at : at + (1 << 16)], last[at : at + (1 << 16)]
        out[at : at + (1 << 16)] = xxh64(buf, begin[f], begin[t] + size[t] - begin[f])
    return made, out


def majority(made: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """The 64-bit SimHash of each text: a bit is set if it is set in over half of the hashes."""
    out = np.zeros(len(made), np.uint64)
    has = np.flatnonzero(made)
    n = made[has]
    ends = np.cumsum(n)
    docs_at, step = 0, 1 << 16
    while docs_at < len(has):
        a = int(ends[docs_at] - n[docs_at])
        to = max(docs_at + 1, int(np.searchsorted(ends, a + step, "right")))
        total = np.zeros((to - docs_at, 64), np.int64)
        for c in range(a, int(ends[to - 1]), step):  # one document may have more shingles than a step
            d = min(int(ends[to - 1]), c + step)
            bits = np.unpackbits(hashes[c:d].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            lo = int(np.searchsorted(ends, c, "right"))
            hi = int(np.searchsorted(ends, d - 1, "right")) + 1
            cuts = np.maximum(ends[lo:hi] - n[lo:hi] - c, 0)
            total[lo - docs_at : hi - docs_at] += np.add.reduceat(bits, cuts, axis=0, dtype=np.int32)
        over = (2 * total > n[docs_at:to, None]).astype(np.uint8)
        out[has[docs_at:to]] = np.packbits(over, axis=1, bitorder="little").view(np.uint64).ravel()
        docs_at = to
    return out


def fingerprints(texts: list[str | None], shingle: int = SHINGLE) -> np.ndarray:
    """The 64-bit SimHash of each text over its word shingles; zero for a text without words."""
    return majority(*shingle_hashes(texts, shingle))


def planes(fps: np.ndarray) -> np.ndarray:
    """Bit planes: row j holds bit j of every fingerprint, 64 fingerprints to a word; the tail is padded with zeros."""
    bits = np.unpackbits(np.ascontiguousarray(fps).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").T
    packed = np.packbits(bits, axis=1, bitorder="little")
    return np.ascontiguousarray(np.pad(packed, ((0, 0), (0, -packed.shape[1] % 8)))).view(np.uint64)


class CarrySave:
    """Many small counters held as bit planes; `over` marks the lanes whose count has passed the radius."""

    def __init__(self, shape: tuple[int, ...], radius: int):
        self.bits = [np.zeros(shape, np.uint64) for _ in range(max(1, (radius + 1).bit_length()))]
        self.start = (1 << len(self.bits)) - (radius + 1)  # counters start so high that radius + 1 overflows them
        for i, plane in enumerate(self.bits):
            if self.start >> i & 1:
                plane[...] = ~np.uint64(0)
        self.over = np.zeros(shape, np.uint64)

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        """Two planes at once: a full adder takes both and the lowest bit, what it carries ripples on."""
        low = self.bits[0]
        half = a ^ b
        carry = (a & b) | (half & low)
        self.bits[0] = low ^ half
        for i in range(1, len(self.bits)):
            self.bits[i], carry = self.bits[i] ^ carry, self.bits[i] & carry
        self.over |= carry

    def keep(self, rows: np.ndarray) -> None:
        self.bits = [x[rows] for x in self.bits]
        self.over = self.over[rows]


def within(a: np.ndarray, b: np.ndarray, radius: int = RADIUS) -> np.ndarray:
    """Which pairs a[i], b[i] differ in at most radius bits."""
    diff = planes(a ^ b)
    counter = CarrySave(diff.shape[1:], radius)
    for j in range(0, 64, 2):
        counter.add(diff[j], diff[j + 1])
    return np.unpackbits((~counter.over).view(np.uint8), bitorder="little")[: len(a)].astype(bool)


def near(queries: np.ndarray, block: np.ndarray, radius: int = RADIUS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (query, member of block) within the radius, a batch at a time."""
    lanes = 1024
    for at in range(0, len(block), lanes):
        part = planes(block[at : at + lanes])
        spare = np.arange(part.shape[1] * 64) >= len(block[at : at + lanes])
        padding = np.packbits(spare, bitorder="little").view(np.uint64)
        for q in range(0, len(queries), 256):
            own = queries[q : q + 256]
            alive = np.arange(len(own))
            counter = CarrySave((len(own), part.shape[1]), radius)
            counter.over |= padding
            for j in range(0, 64, 2):
                masks = [np.where(own[alive] >> np.uint64(i) & np.uint64(1), ~np.uint64(0), np.uint64(0))[:, None] for i in (j, j + 1)]
                counter.add(part[j] ^ masks[0], part[j + 1] ^ masks[1])
                if j % 8 == 6:
                    rows = (counter.over != ~np.uint64(0)).any(axis=1)
                    if rows.sum() < 0.75 * len(rows):
                        alive = alive[rows]
                        counter.keep(rows)
                        if not len(alive):
                            break
            if len(alive):
                hit = np.unpackbits((~counter.over).view(np.uint8).reshape(len(alive), -1), axis=1, bitorder="little")
                x, y = np.nonzero(hit)
                yield q + alive[x], at + y


def joined(root: np.ndarray, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """root: the least index known of each index's component. Returns it after the links u[i] - v[i]."""
    while True:
        a, b = root[u], root[v]
        if not (off := a != b).any():
            return root
        u, v, a, b = u[off], v[off], a[off], b[off]
        low = np.minimum(a, b)
        np.minimum.at(root, a, low)
        np.minimum.at(root, b, low)
        while (deeper := root[root]).tolist() != root.tolist() if len(root) < 64 else not np.array_equal(deeper := root[root], root):
            root = deeper


TILE_SCHEMA = pa.schema([("u", pa.int64()), ("v", pa.int64())])


def linked(key: np.ndarray, a: np.ndarray, b: np.ndarray, part: np.ndarray, fp: np.ndarray, radius: int, name: np.ndarray | None = None, alike=None) -> tuple[np.ndarray, np.ndarray]:
    """Stars of links (names, fingerprints without) of whole tiles; the rows of a tile (key, a, b) stand together.

    alike(i, j), where given, has the last word on two rows that are within the radius; it is not asked about rows that
    are connected already.
    """
    new = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
    size = np.diff(np.r_[new, len(key)])
    root = np.arange(len(fp))
    run = np.repeat(np.arange(len(new)), size)

    def joined_by(root: np.ndarray, u: np.ndarray, v: np.ndarray, base: int = 0) -> np.ndarray:
        if alike is None:
            return joined(root, u, v)
        open_ = np.flatnonzero(root[u] != root[v])
        for i, j in zip(u[open_].tolist(), v[open_].tolist(), strict=True):
            p, q = root[i], root[j]
            if p != q and alike(base + i, base + j):
                root[root == max(p, q)] = min(p, q)
        return root

    small = np.repeat((size <= 32) & (a[new] == b[new]), size)
    at = np.flatnonzero(small)
    for k in range(1, int(size[(size <= 32)].max(initial=1))):
        i = at[:-k]
        i = i[run[i + k] == run[i]] if len(i) else i
        if not len(i):
            break
        hit = i[within(fp[i], fp[i + k], radius)]
        if alike is None:
            root = joined(root, hit, hit + k)
        else:
            for x in hit.tolist():  # a run has few rows: its roots are looked through one by one
                lo, hi = new[run[x]], new[run[x]] + size[run[x]]
                p, q = root[x], root[x + k]
                if p != q and alike(x, x + k):
                    own = root[lo:hi]
                    own[own == max(p, q)] = min(p, q)
    for t in np.flatnonzero(~small[new]):
        rows = np.arange(new[t], new[t] + size[t])
        if a[new[t]] == b[new[t]]:
            left = right = rows
        else:
            left, right = rows[part[rows] == a[new[t]]], rows[part[rows] == b[new[t]]]
        own = np.arange(len(rows))
        for x, y in near(fp[left], fp[right], radius):
            own = joined_by(own, left[x] - new[t], right[y] - new[t], new[t])
        root[rows] = own + new[t]
    out = np.flatnonzero(root != np.arange(len(root)))
    name = fp if name is None else name
    return name[out], name[root[out]]


def _tiles(radius: int, similarity: float | None = None):
    """Rows (key, a, b, part, fp, and with a similarity: num, shingles), sorted by tile -> links."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []

        def flush(cols):
            if len(cols[0]):
                name = alike = None
                if similarity is not None:
                    name, sets = cols[5], [unpacked(x) for x in cols[6]]
                    asked: dict[tuple[int, int], bool] = {}

                    def alike(i, j):
                        pair = (int(name[i]), int(name[j]))
                        if pair not in asked:
                            asked[pair] = alike_sets(sets[i], sets[j], similarity)
                        return asked[pair]

                u, v = linked(*cols[:4], cols[4].view(np.uint64), radius, name, alike)
                yield pa.record_batch([u.view(np.int64), v.view(np.int64)], schema=TILE_SCHEMA)

        for batch in batches if similarity is None else slices(batches, 6):
            if not batch.num_rows:
                continue
            held.append([np.asarray(c) for c in batch.columns[:6]] + [np.array([x.as_py() for x in c], object) for c in batch.columns[6:]])
            last = [c[-1] for c in held[-1][:3]]
            if all(c[0] == x for c, x in zip(held[-1][:3], last, strict=True)):
                continue  # the tile goes on
            cols = [np.concatenate(c) for c in zip(*held, strict=True)]
            same = (cols[0] == last[0]) & (cols[1] == last[1]) & (cols[2] == last[2])
            yield from flush([c[~same] for c in cols])
            held = [[c[same] for c in cols]]
        if held:
            yield from flush([np.concatenate(c) for c in zip(*held, strict=True)])

    return run


def with_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(id, fp): one row per row of docs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            fps = fingerprints(batch.column(1).to_pylist(), shingle)
            yield pa.record_batch([batch.column(0), pa.array(fps.view(np.int64))], names=["id", "fp"])

    kind = docs.schema[id_col].dataType.simpleString()
    return in_batches(docs.select(F.col(id_col).alias("id"), whole_text(text_col).alias("text")), run, f"id {kind}, fp bigint")


def links(fps: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """Distinct fingerprints (fp) -> links (u, v) that connect every pair within the radius, directly or through others."""
    blocks = radius + 2
    cuts = [64 * i // blocks for i in range(blocks + 1)]
    value = lambda i: F.shiftrightunsigned("fp", cuts[i]).bitwiseAND((1 << (cuts[i + 1] - cuts[i])) - 1)
    wide = max(b - a for a, b in zip(cuts, cuts[1:], strict=False))
    keys = [F.lit(t << 2 * wide).bitwiseOR(F.shiftleft(value(i), wide)).bitwiseOR(value(j)) for t, (i, j) in enumerate(combinations(range(blocks), 2))]
    placed = fps.select(F.explode(F.array(*keys)).alias("key"), "fp")
    return _linked_buckets(placed, tile, _tiles(radius))


def _linked_buckets(placed: DataFrame, tile: int, run, details: DataFrame | None = None) -> DataFrame:
    """placed (key, fp, maybe num and size) -> links (u, v) that connect all pairs of a bucket that run links; details (num, shingles) go with rows of buckets with several rows only.

    Of buckets that hold the same rows, as pairs that agree in several places make them, one is compared. A bucket's rows
    are dealt to parts of tile rows; where rows have a size, a part is bounded by TILE_SHINGLES in sum as well. First every
    part is compared with part 0. In a bucket of near copies this connects almost all rows, and rows that are connected
    need no comparison: after it only the rows outside the bucket's largest component are compared with all others. So a
    bucket's work grows with its rows, times those that are not near copies of the others.
    """
    own = [c for c in placed.columns if c not in ("key", "size")]
    name = own[-1]
    most = F.sum("size") if "size" in placed.columns else F.lit(0)
    same = [F.bit_xor(F.xxhash64(name)).alias("x"), F.sum(F.shiftright(F.xxhash64(name, F.lit(1)), 32)).alias("y"), F.min(name).alias("z")]
    sizes = placed.groupBy("key").agg(F.count("*").alias("n"), most.alias("held"), *same).where("n > 1")
    sizes = written(sizes.groupBy("n", "held", "x", "y", "z").agg(F.min("key").alias("key")).select("key", "n", "held"), "bucket-sizes")
    parts = F.greatest(F.ceil(F.col("n") / tile), F.ceil(F.col("held") / TILE_SHINGLES)).cast("int")
    cut = placed.join(sizes, "key").select("key", *own, parts.alias("parts"), F.pmod(F.xxhash64(*own), parts).cast("int").alias("part"))

    def compared(rows: DataFrame, others) -> DataFrame:
        """Links over the tiles that each row's part makes with the parts in others."""
        if details is not None:
            rows = rows.join(details, "num")
        tiles = rows.withColumn("other", F.explode(others))
        tiles = tiles.select("key", F.least("part", "other").alias("a"), F.greatest("part", "other").alias("b"), "part", *own, *(["shingles"] if details is not None else []))
        n = int(placed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        return in_batches(tiles.repartition(n, "key", "a", "b").sortWithinPartitions("key", "a", "b"), run, "u bigint, v bigint")

    first = compared(cut, F.when(F.col("part") == 0, F.sequence(F.lit(0), F.col("parts") - 1)).otherwise(F.array(F.lit(0))))
    if not sizes.where(parts > 1).limit(1).count():
        return first
    first = written(first, "first-links")
    hot = cut.where("parts > 1").join(connected(first), F.col(name) == F.col("node"), "left").withColumn("root", F.coalesce("root", name)).drop("node")
    hot = written(hot, "hot-rows")
    counts = hot.groupBy("key", "root").agg(F.count("*").alias("n"))
    largest = counts.groupBy("key").agg(F.max(F.struct("n", "root")).alias("top"), F.sum("n").alias("all"))
    rest = F.col("all") - F.col("top.n")
    largest = written(largest.where(rest > 0).select("key", F.col("top.root").alias("main"), rest.alias("rest"), "all"), "largest-components")
    marked = hot.join(largest, "key").withColumn("apart", F.greatest(F.ceil(F.col("rest") * F.col("parts") / F.col("all")), F.lit(1)).cast("int"))
    off = F.col("root") != F.col("main")
    # parts of the rows outside come first, those of the largest component behind them
    marked = marked.withColumn("part", F.when(off, F.pmod(F.xxhash64(*own), F.col("apart"))).otherwise(F.col("apart") + F.col("part")).cast("int"))
    beside = F.when(off, F.sequence(F.lit(0), F.col("apart") + F.col("parts") - 1)).otherwise(F.sequence(F.lit(0), F.col("apart") - 1))
    return first.unionByName(compared(marked.select("key", *own, "part", "apart", "parts", "root", "main"), beside))


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, shingle: int = SHINGLE, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """One row per row of docs: id_col, fingerprint (16 hex digits), component_id (smallest id reachable over links).

    A null text counts as empty; a text without words has fingerprint zero and is linked like any other. Very long texts
    are read whole, their shingles in steps. Rows that repeat are rows like any other, and ties cannot change a component.
    Null ids are ignored when the smallest id is sought, so a component of null ids alone has a null component_id. Other
    columns are neither read nor returned. An empty table gives an empty result.
    """
    rows = written(with_fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    known = written(rows.groupBy("fp").agg(F.min("id").alias("least")), "distinct-fingerprints")
    stars = connected(links(known.select("fp"), radius, tile))
    rooted = written(known.join(stars, known["fp"] == stars["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root")), "rooted")
    least = written(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "component-ids")
    named = written(rooted.join(least, "root").select("fp", "component_id"), "named")
    return rows.join(named, "fp").select(F.col("id").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


#: Near copies by similarity: shingle, similarity, radius of the comparison, bands and their rows, shingles of a side of a tile.
NEAR_SHINGLE, SIMILARITY, NEAR_RADIUS, BANDS, ROWS, TILE_SHINGLES = 5, 0.8, 24, 12, 4, 2 << 20


def band_keys(made: np.ndarray, hashes: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """(texts, bands): texts share a band with probability similarity ** rows. Texts without words share all."""
    out = np.zeros((len(made), bands), np.uint64)
    has = np.flatnonzero(made)
    if len(has):
        starts = np.cumsum(made[has]) - made[has]
        factors = np.random.default_rng(11).integers(1, 1 << 63, bands * rows, np.int64).view(np.uint64) * np.uint64(2) + np.uint64(1)
        with np.errstate(over="ignore"):
            for b in range(bands):
                key = np.full(len(has), np.uint64(b + 1) * P5)
                for f in factors[b * rows : (b + 1) * rows]:
                    key = _rotl((key ^ np.minimum.reduceat(hashes * f, starts)) * P1, 31) * P2
                out[has, b] = key
    return out


def packed(hashes: np.ndarray) -> bytes:
    """Distinct hashes, 48 bits of each, in order: at a million shingles two in a text agree by chance with probability 0.002."""
    own = np.unique(hashes >> np.uint64(16)).astype("<u8")
    return own.view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def unpacked(of: bytes) -> np.ndarray:
    own = np.zeros((len(of) // 6, 8), np.uint8)
    own[:, :6] = np.frombuffer(of, np.uint8).reshape(-1, 6)
    return own.view("<u8").ravel()


def alike_sets(a: np.ndarray, b: np.ndarray, similarity: float) -> bool:
    """Whether two texts' sets of shingle hashes, whole and in order, have at least the similarity; empty sets are equal."""
    few, many = sorted((len(a), len(b)))
    if not few or few < similarity * many - 1e-6:  # sizes alone tell
        return few == many
    common = len(np.intersect1d(a, b, assume_unique=True))
    return common / (few + many - common) >= similarity


def near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, shingle: int = NEAR_SHINGLE, similarity: float = SIMILARITY, radius: int = NEAR_RADIUS, tile: int = TILE // 2) -> DataFrame:
    """One row per row of docs: id_col, component_id (smallest id reachable over links of at least the similarity).

    At this similarity SimHash fingerprints of linked texts differ in up to a third of their bits, too many for blocks of
    equal bits. Texts meet where all rows of a band of sampled shingles agree, a bucket's fingerprints are compared bit-
    sliced as above at a wide radius, and pairs that pass are checked by their whole shingle sets. Nulls, repeats and empty
    texts are treated as in simhash_components.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            made, hashes = shingle_hashes(batch.column(2).to_pylist(), shingle)
            ends = np.cumsum(made)
            keys = band_keys(made, hashes).view(np.int64)
            bands = pa.ListArray.from_arrays(pa.array(np.arange(len(made) + 1, dtype=np.int32) * keys.shape[1]), pa.array(keys.ravel()))
            sets = [np.unique(hashes[e - n : e]) for e, n in zip(ends.tolist(), made.tolist(), strict=True)]
            size = np.fromiter(map(len, sets), np.int64, len(sets))
            fps = majority(size, np.concatenate(sets))  # repeats do not count in the similarity, so neither here
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(fps.view(np.int64)), bands, pa.array(size), pa.array(kept := [packed(x) for x in sets], pa.binary()), pa.array([hashlib.blake2b(x, digest_size=16).digest() for x in kept], pa.binary())], names=["num", "id", "fp", "bands", "size", "shingles", "digest"])

    numbered = docs.select(F.monotonically_increasing_id().alias("num"), F.col(id_col).alias("id"), whole_text(text_col).alias("text"))
    rows = written(in_batches(numbered, run, f"num bigint, id {kind}, fp bigint, bands array<bigint>, size bigint, shingles binary, digest binary"), "near-features")
    firsts = written(rows.groupBy("digest").agg(F.min("num").alias("first")), "distinct-sets")  # equal sets are compared once
    placed = rows.join(firsts.select(F.col("first").alias("num")), "num", "left_semi").select(F.explode("bands").alias("key"), "fp", "num", "size")
    stars = connected(_linked_buckets(placed, tile, _tiles(radius, similarity), rows.select("num", "shingles")))
    named = written(firsts.join(stars, firsts["first"] == stars["node"], "left").select("digest", F.coalesce("root", "first").alias("root")), "named-sets")
    rooted = written(rows.select("id", "digest").join(named, "digest").select("id", "root"), "rooted")
    least = written(rooted.groupBy("root").agg(F.min("id").alias("component_id")), "component-ids")
    discard(rows, firsts, named)
    return rooted.join(least, "root").select(F.col("id").alias(id_col), "component_id")


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(table(spark, sf_dir, "documents"))
