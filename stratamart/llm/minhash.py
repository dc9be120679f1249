"""Near-duplicate documents by MinHash.

Every text becomes a set of word shingles and a signature of universal hash minima.
Texts with equal sets are collapsed first. Bands of the signature put the rest into
buckets; pairs from a bucket pass the signature estimate and are then confirmed on
their full shingle sets. Components come from alternating large-star and small-star.

No bucket emits its pairs. First every bucket's members are compared with the bucket's
smallest one alone. In the buckets that are then still of several components, the members
outside the largest one are compared with all members, inside the task that holds the bucket
or a tile of it: by sizes, signatures and parity maps of the sets (two maps differ in no more
cells than the sets in shingles, so a pair they exclude is no link). This is done twice. Once a
tile sends out a forest of its likely links, the most alike first, to be confirmed; that joins
most of what belongs together. Then the texts of members with a likely link to another
component come to the tile, links are confirmed there, and a forest of them leaves it. So
a tile never sends more pairs than it has members, and no link between two components is left
out; links inside a component cannot change it.

A null or empty text, or one without words, has no shingles and links with nothing.
A row without an id links with nothing either: its component is null and it is kept.
Rows that share an id are one node with the links of all of them. Other columns
pass through.
"""

from __future__ import annotations

import random
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratamart.llm.common import emit, forget_worker_memory, hot_keys, spread_join, stage
from stratamart.llm.components import components
from stratamart.llm.shingles import WORDS, WordHashes, shared, shingle_set

BANDS, ROWS = 38, 5
# A pair is dropped unconfirmed if its signatures agree this many standard
# deviations less often than at the threshold (about 3 in 100,000 links that
# lie at the threshold itself).
SLACK = 4.0
# Members of a bucket that are compared with in one tile of it.
TILE = 4_096
# Shingles of all members that are compared with in one tile (128 MB of hashes).
TILE_SHINGLES = 1 << 24
# Fewest cells of a parity map (64 bytes).
LEAST_CELLS = 512
# Bits of the map that tells which texts to shuffle for confirmation (2 MB, 262,144
# rows at most). A full map lets all texts through.
TEXT_BITS = 1 << 24
_BLOCK = 512


def _multipliers(n: int) -> tuple[np.ndarray, np.ndarray]:
    draw = random.Random(20)
    a = np.array([draw.getrandbits(64) | 1 for _ in range(n)], np.uint64)
    return a, np.array([draw.getrandbits(64) for _ in range(n)], np.uint64)


def signature(shingles: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """High halves of the minima of ``a * x + b`` mod 2**64 over the set."""
    least = np.full(len(a), np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(shingles), _BLOCK):
        x = shingles[start:start + _BLOCK]
        np.minimum(least, (x[:, None] * a + b).min(axis=0), out=least)
    return (least >> np.uint64(32)).astype(np.uint32)


def parity(shingles: np.ndarray) -> bytes:
    """Whether each cell holds an odd number of the shingles; four to eight cells a shingle."""
    cells = max(LEAST_CELLS, 1 << (4 * len(shingles) - 1).bit_length())
    at = (shingles * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(32)
    odd = np.bincount((at & np.uint64(cells - 1)).astype(np.int64), minlength=cells) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def _sign(bands: int, rows: int, words: int):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_worker_memory()
        a, b = _multipliers(bands * rows)
        cache = WordHashes()
        kinds = {"node": pa.int64(), "id": pa.int64(), "n_shingles": pa.int64(), "mark": pa.binary(), "sig": pa.binary(),
                 "parity": pa.binary()}

        def each():
            for batch in batches:
                for node, doc_id, text in zip(*(c.to_pylist() for c in batch.columns)):
                    found = shingle_set(text, cache, words)
                    if not len(found):
                        yield node, doc_id, 0, None, None, None
                        continue
                    mark = xxhash.xxh3_128_digest(found.tobytes())
                    yield node, doc_id, len(found), mark, signature(found, a, b).tobytes(), parity(found)

        return emit(kinds, each(), 4_000)

    return sign


def _buckets(bands: int, rows: int):
    """(bucket, node, size) of each band of the full minima."""

    def buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, _ = _multipliers(rows)
        turn = np.arange(1, bands + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        for batch in batches:
            ids, sizes = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            if not len(ids):
                continue
            sigs = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.uint32)
            mixed = (sigs.reshape(len(ids), bands, rows).astype(np.uint64) * a).sum(axis=2, dtype=np.uint64)
            mixed = (mixed ^ turn) * np.uint64(0xD6E8FEB86659FD93)
            mixed ^= mixed >> np.uint64(32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(mixed.ravel().view(np.int64)), pa.array(np.repeat(ids, bands)),
                 pa.array(np.repeat(sizes, bands))],
                names=["bucket", "node", "size"])

    return buckets


def _short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            low = _bytes(batch.column("sig"))[:, ::4]
            rows = pa.array([r.tobytes() for r in low], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), batch.column("size"), rows, batch.column("parity")],
                names=["node", "size", "sig", "parity"])


def _least(threshold: float, n: int) -> float:
    return threshold - SLACK * np.sqrt(threshold * (1 - threshold) / n)


def _bytes(column) -> np.ndarray:
    held = column.to_pylist()
    return np.frombuffer(b"".join(held), np.uint8).reshape(len(held), -1)


def _alike(threshold: float):
    """Pairs whose signatures agree often enough."""

    def alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                left, right = (_bytes(batch.column(k)) for k in ("sig_x", "sig_c"))
                keep = (left == right).mean(axis=1) >= _least(threshold, left.shape[1])
                yield batch.select(["x", "c"]).filter(pa.array(keep))

    return alike


class _Tile:
    """Targets of one tile of a bucket, and which of their components are joined by now."""

    def __init__(self, percent: int):
        self.percent, self.held = percent, []
        self.place: dict[int, int] = {}
        self.root = np.zeros(0, np.int64)

    def add(self, run: pa.RecordBatch) -> None:
        self.held.append(run)

    def close(self) -> None:
        """Called once, when all targets are there."""
        run = pa.Table.from_batches(self.held).combine_chunks()
        self.node, self.part, self.size = (run.column(k).to_numpy() for k in ("node", "component", "size"))
        self.sig = _bytes(run.column("sig"))
        self.least = np.ceil(_least(self.percent / 100, self.sig.shape[1]) * self.sig.shape[1])
        self.local = np.array([self.of(c) for c in self.part.tolist()], np.int64)
        held = run.column("parity").to_pylist()
        self.length = np.array([len(x) for x in held])
        self.row, self.parity = np.zeros(len(held), np.int64), {}
        for length in np.unique(self.length).tolist():
            places = np.flatnonzero(self.length == length)
            self.row[places] = np.arange(len(places))
            self.parity[length] = np.frombuffer(b"".join(held[i] for i in places), np.uint64).reshape(len(places), -1)
        self.text = run.column("text").to_pylist() if "text" in run.column_names else []
        self.sets: dict[int, np.ndarray] = {}
        self.held = []

    def of(self, component: int) -> int:
        """Number of a component in this tile."""
        if component not in self.place:
            self.place[component] = len(self.root)
            self.root = np.append(self.root, len(self.root))
        return self.place[component]

    def join(self, one: int, other: int) -> None:
        self.root[self.root == self.root[other]] = self.root[one]

    def _differ(self, places: np.ndarray, parity: bytes) -> np.ndarray:
        """Odd cells in which targets and ``parity`` differ: no more than shingles in one only."""
        out = np.zeros(len(places), np.int64)
        own = np.frombuffer(parity, np.uint64)[None, :]
        for length, rows in self.parity.items():
            some = self.length[places] == length
            if some.any():
                one, other = _folded(rows[self.row[places[some]]], own)
                out[some] = np.bitwise_count(one ^ other).sum(axis=1, dtype=np.int64)
        return out

    def near(self, node: int, component: int, size: int, sig: np.ndarray, parity: bytes):
        """Targets of components not joined to this one that may be links, and their agreement."""
        p = self.percent
        own = self.of(component)
        apart = self.root[self.local] != self.root[own]
        places = np.flatnonzero(
            apart & (self.node != node) & (100 * np.minimum(self.size, size) >= p * np.maximum(self.size, size)))
        agree = np.count_nonzero(self.sig[places] == sig, axis=1)
        places, agree = places[agree >= self.least], agree[agree >= self.least]
        most = self._differ(places, parity) * (100 + p) <= (100 - p) * (self.size[places] + size)
        return places[most], agree[most]


def _folded(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both parities at the length of the shorter one; halves add up modulo two."""
    while a.shape[1] > b.shape[1]:
        a = a[:, :a.shape[1] // 2] ^ a[:, a.shape[1] // 2:]
    while b.shape[1] > a.shape[1]:
        b = b[:, :b.shape[1] // 2] ^ b[:, b.shape[1] // 2:]
    return a, b


def _tiles(batches: Iterator[pa.RecordBatch], percent: int):
    """(tile, asking rows or None, key) from rows sorted by bucket, tile and role.

    A tile comes with each run of its asking rows, and last with None.
    """
    tile, key = None, None
    for batch in batches:
        if not batch.num_rows:
            continue
        bucket, number, asks = (
            batch.column(k).to_numpy(zero_copy_only=False) for k in ("bucket", "tile", "asks"))
        change = (np.diff(bucket) != 0) | (np.diff(number) != 0) | (np.diff(asks) != 0)
        bounds = [0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows]
        for low, high in zip(bounds, bounds[1:]):
            here = (int(bucket[low]), int(number[low]))
            if here != key:
                if tile is not None and not tile.held:
                    yield tile, None, key
                tile, key = _Tile(percent), here
            run = batch.slice(low, high - low)
            if not asks[low]:
                tile.add(run)
                continue
            if tile.held:
                tile.close()
            if hasattr(tile, "node"):
                yield tile, run, key
    if tile is not None and not tile.held:
        yield tile, None, key


def _asking(run: pa.RecordBatch):
    sigs = _bytes(run.column("sig"))
    columns = [run.column(k).to_pylist() for k in ("node", "component", "size", "parity")]
    return zip(*columns, sigs)


_PAIR = {"x": pa.int64(), "c": pa.int64()}
_CELL = {"bucket": pa.int64(), "tile": pa.int64(), "node": pa.int64(), "component": pa.int64(), "asks": pa.int32()}


def _best_first(percent: int):
    """Of every tile a forest of its likely links, the most alike first; not confirmed.

    At most one pair less than the tile has components leaves it.
    """

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def each():
            for tile, run, _ in _tiles(batches, percent):
                for node, component, size, parity, sig in _asking(run) if run is not None else ():
                    places, agree = tile.near(node, component, size, sig, parity)
                    own = tile.of(component)
                    for i in places[np.argsort(-agree, kind="stable")]:
                        if tile.root[tile.local[i]] != tile.root[own]:
                            tile.join(own, tile.local[i])
                            yield max(node, int(tile.node[i])), min(node, int(tile.node[i]))

        return emit(_PAIR, each())

    return best


def _undecided(percent: int):
    """The rows of every tile that have a likely link to another component, each once."""

    def undecided(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def each():
            for tile, run, key in _tiles(batches, percent):
                if run is None:
                    if hasattr(tile, "wanted"):
                        for i in np.flatnonzero(tile.wanted):
                            yield *key, int(tile.node[i]), int(tile.part[i]), 0
                    continue
                if not hasattr(tile, "wanted"):
                    tile.wanted = np.zeros(len(tile.node), bool)
                for node, component, size, parity, sig in _asking(run):
                    places, _ = tile.near(node, component, size, sig, parity)
                    tile.wanted[places] = True
                    if len(places):
                        yield *key, node, component, 1

        return emit(_CELL, each())

    return undecided


def _forest(percent: int, words: int):
    """Of every tile a forest of its links, each confirmed on full sets before it counts."""

    def forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = WordHashes()

        def each():
            for tile, run, _ in _tiles(batches, percent):
                if run is None:
                    continue
                for (node, component, size, parity, sig), text in zip(_asking(run), run.column("text").to_pylist()):
                    places, agree = tile.near(node, component, size, sig, parity)
                    if not len(places):
                        continue
                    own, mine = tile.of(component), shingle_set(text, cache, words)
                    for i in places[np.argsort(-agree, kind="stable")].tolist():
                        if tile.root[tile.local[i]] == tile.root[own]:
                            continue
                        if i not in tile.sets:
                            tile.sets[i], tile.text[i] = shingle_set(tile.text[i], cache, words), None
                        both = shared(mine, tile.sets[i])
                        if 100 * both >= percent * (len(mine) + len(tile.sets[i]) - both):
                            tile.join(own, tile.local[i])
                            yield max(node, int(tile.node[i])), min(node, int(tile.node[i]))

        return emit(_PAIR, each())

    return forest


def _confirm(percent: int, words: int):
    """Pairs with 100 * intersection >= percent * union, on their full sets."""

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = WordHashes()
        centre: tuple = (None, None)

        def each():
            nonlocal centre
            for batch in batches:
                for x, c, text_x, text_c in zip(
                    *(batch.column(k).to_pylist() for k in ("x", "c", "text_x", "text_c"))
                ):
                    if centre[0] != c:
                        centre = (c, shingle_set(text_c, cache, words))
                    a, b = shingle_set(text_x, cache, words), centre[1]
                    both = shared(a, b)
                    if 100 * both >= percent * (len(a) + len(b) - both):
                        yield x, c

        return emit({"x": pa.int64(), "c": pa.int64()}, each())

    return confirm


def _hot(counted: DataFrame, key: str) -> list:
    return hot_keys(counted.groupBy(key).agg(F.count("*").alias("n")), key)


def _texts(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, text) of the wanted nodes; a map of bits keeps other texts from the shuffle."""
    word = F.expr(f"pmod(node, {TEXT_BITS}) DIV 64").alias("_word")
    mask = F.expr("shiftleft(1L, CAST(pmod(node, 64) AS INT))")
    wanted = stage(nodes.distinct(), "wanted")
    bits = stage(wanted.groupBy(word).agg(F.bit_or(mask).alias("_bits")), "bits")
    likely = docs.withColumn("_word", word).join(F.broadcast(bits), "_word").where(
        F.col("_bits").bitwiseAND(mask) != 0)
    return stage(
        likely.select("node", "text").join(wanted, "node", "left_semi")
        .dropDuplicates(["node"]), "texts")


def _links(near: DataFrame, docs: DataFrame, percent: int, words: int) -> DataFrame:
    """The alike pairs (x, c) that are links, confirmed on their full sets."""
    near = stage(near.distinct(), "near")
    texts = _texts(docs, near.select(F.col("x").alias("node")).union(near.select("c")))
    full = spread_join(
        near.join(texts.withColumnsRenamed({"node": "x", "text": "text_x"}), "x"),
        texts.withColumnsRenamed({"node": "c", "text": "text_c"}), "c", _hot(near, "c"), F.col("x"))
    found = full.select("x", "c", "text_x", "text_c").mapInArrow(_confirm(percent, words), "x long, c long")
    return stage(found, "links")


def _cells(members: DataFrame, labels: DataFrame, hot: list) -> DataFrame:
    """(bucket, tile, node, component, asks): who is compared with whom.

    Every member of a bucket of several components is a target in one tile of it; those
    outside the largest component ask in all its tiles.
    """
    state = stage(
        members.join(labels.withColumnRenamed("id", "node"), "node", "left")
        .withColumn("component", F.coalesce("component", "node")), "state")
    sizes = state.groupBy("bucket", "component").agg(F.count("*").alias("n"), F.sum("size").alias("sizes"))
    live = stage(sizes.groupBy("bucket").agg(
        F.max_by("component", F.struct("n", "component")).alias("largest"),
        F.sum("n").alias("n"), F.sum("sizes").alias("sizes"), F.count("*").alias("parts"),
    ).where("parts > 1").select("bucket", "largest", F.greatest(
        F.ceil(F.col("n") / TILE), F.ceil(F.col("sizes") / TILE_SHINGLES)).alias("tiles")), "live")
    tiled = spread_join(state, live, "bucket", hot, F.col("node")).withColumn(
        "tile", F.pmod(F.xxhash64("node"), F.col("tiles"))).withColumn("asks", F.lit(0))
    asking = tiled.where("component <> largest").withColumn(
        "tile", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1))).withColumn("asks", F.lit(1))
    columns = ["bucket", "tile", "node", "component", "asks"]
    return tiled.select(*columns).unionByName(asking.select(*columns))


def _tiled(cells: DataFrame) -> DataFrame:
    return cells.repartition("bucket", "tile").sortWithinPartitions("bucket", "tile", "asks")


def one_of_each(docs: DataFrame, *, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` without those whose group of near duplicates has an earlier row.

    Every row is a document of its own here, also where ids are null or shared by different
    texts. The row with the smallest doc_id stays (nulls last; among equal ids the first one
    written). Rows without words all stay. Columns may have any names.
    """
    numbered = stage(
        docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc"))
        .withColumn("row", F.monotonically_increasing_id()), "numbered")
    found = near_duplicates(
        numbered.select(F.col("row").alias("doc_id"), F.col("doc.text").alias("text")), percent=percent)
    groups = stage(found.where("n_shingles > 0").select(F.col("doc_id").alias("row"), "component_id").join(
        numbered.select("row", F.struct(F.col("doc.doc_id").isNull(), "doc.doc_id", "row").alias("place")),
        "row"), "groups")
    # Groups of one row need no join.
    several = groups.groupBy("component_id").agg(F.min("place").alias("first"), F.count("*").alias("n")).where("n > 1")
    several = stage(several, "several")
    dropped = spread_join(groups, several, "component_id", hot_keys(several, "component_id"), F.col("row")).where(
        "place <> first").select("row")
    return numbered.join(dropped, "row", "left_anti").select("doc.*")


def near_duplicates(
    docs: DataFrame, *, percent: int = 80, words: int = WORDS, bands: int = BANDS, rows: int = ROWS
) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id, kept.

    Links are pairs with a Jaccard similarity of at least ``percent`` / 100.
    ``component_id`` is the smallest doc_id reachable, ``kept`` is true for it.
    """
    base = docs.select(F.col("doc_id").cast("long").alias("id"), "text")
    base = base.withColumn("node", F.xxhash64("id", "text"))
    signed = stage(base.select("node", "id", "text").mapInArrow(
        _sign(bands, rows, words), "node long, id long, n_shingles long, mark binary, sig binary, parity binary"),
        "signatures")
    usable = signed.where("id IS NOT NULL AND mark IS NOT NULL")
    # Equal sets: all hang on the smallest id, one text stands for all. Counts tell
    # the hot sets.
    sets = stage(
        usable.groupBy("mark").agg(F.min(F.struct("id", "node")).alias("lead"), F.count("*").alias("n"))
        .select("mark", "n", F.col("lead.id").alias("rep"), F.col("lead.node").alias("node")), "sets")
    copies = spread_join(
        usable.select("id", "mark"), sets.select("mark", "rep"), "mark", hot_keys(sets, "mark"), F.col("id")
    ).where("id <> rep").select(F.col("id").alias("u"), F.col("rep").alias("v"))
    leads = stage(
        usable.join(sets.select("node"), "node", "left_semi").dropDuplicates(["node"])
        .select("node", "id", F.col("n_shingles").alias("size"), "sig", "parity"), "leads")
    banded = stage(
        leads.select("node", "size", "sig").mapInArrow(_buckets(bands, rows), "bucket long, node long, size long"),
        "buckets")
    found = stage(
        banded.groupBy("bucket").agg(F.count("*").alias("n"), F.min("node").alias("first")).where("n > 1"),
        "shared-buckets")
    hot = hot_keys(found, "bucket")
    members = stage(spread_join(banded, found.drop("n"), "bucket", hot, F.col("node")), "members")
    pairs = stage(
        members.where("node <> first").select(F.col("node").alias("x"), F.col("first").alias("c")).distinct(),
        "pairs")
    # For estimates a byte of each minimum is enough; chance agreement is 1 in 256.
    known = stage(leads.select("node", "size", "sig", "parity").mapInArrow(
        _short, "node long, size long, sig binary, parity binary"), "bytes")
    sig = known.select("node", "sig")
    near = spread_join(
        pairs.join(sig.withColumnsRenamed({"node": "x", "sig": "sig_x"}), "x"),
        sig.withColumnsRenamed({"node": "c", "sig": "sig_c"}), "c", _hot(pairs, "c"), F.col("x"))
    near = near.select("x", "c", "sig_x", "sig_c").mapInArrow(_alike(percent / 100), "x long, c long")
    links = _links(near, base, percent, words)
    joined = links.select(F.col("x").alias("u"), F.col("c").alias("v"))
    # Buckets that are still of several components: likely links first, then what is left.
    labels = components(joined)
    best = _tiled(_cells(members, labels, hot).join(known, "node")).mapInArrow(
        _best_first(percent), "x long, c long")
    added = _links(best, base, percent, words)
    links = links.unionByName(added)
    labels = components(labels.toDF("u", "v").unionByName(added.toDF("u", "v")))
    left = stage(_tiled(_cells(members, labels, hot).join(known, "node")).mapInArrow(
        _undecided(percent), "bucket long, tile long, node long, component long, asks int"), "undecided")
    texts = _texts(base, left.select("node"))
    last = _tiled(left.join(known, "node").join(texts, "node")).mapInArrow(
        _forest(percent, words), "x long, c long")
    links = links.unionByName(stage(last.distinct(), "last-links"))
    # From nodes back to ids, together with the copies.
    ids = leads.select("node", "id")
    linked = links.join(ids.withColumnsRenamed({"node": "x", "id": "u"}), "x").join(
        ids.withColumnsRenamed({"node": "c", "id": "v"}), "c").select("u", "v")
    whole = components(linked.unionByName(copies))
    out = signed.select("id", "n_shingles").join(whole, "id", "left")
    component = F.coalesce("component", "id")
    return out.select(
        F.col("id").alias("doc_id"), "n_shingles", component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))
