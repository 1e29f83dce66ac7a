"""Near-duplicate documents: circulant MinHash, banding and exact Jaccard confirmation on word shingles."""

from __future__ import annotations

import hashlib
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loamwork.llm.common import PrefixHash, arrow_schema, components, in_tiles, key_runs, map_batches, mix, raw_texts, slices, sorted_by, word_spans, written

#: Coordinates are ROWS * BANDS. Two sets of similarity s share no band with probability (1 - s**ROWS)**BANDS: 2e-6 at 0.75.
ROWS, BANDS = 5, 48

#: Sketch of two sets of similarity 0.75 falls below this estimate with a probability under 1e-5.
LEAST_ESTIMATE = 0.62

#: Rows of one block of a bucket, and members confirmed against one hub in one task.
BLOCK, MEMBERS = 512, 512


class Shingler:
    """Distinct hashed word shingles of texts; a text with fewer words is one shingle."""

    def __init__(self, width: int = 5) -> None:
        self.width, self.hashes = width, PrefixHash()

    def sets(self, texts: list[bytes]) -> list[np.ndarray]:
        text = np.frombuffer(b"\n".join(texts).lower(), np.uint8)
        begin = np.cumsum([0, *[len(t) + 1 for t in texts]])
        starts, ends = word_spans(text)
        words = self.hashes.words(text, starts, ends)
        bounds = np.searchsorted(starts, begin).tolist()
        rolled = self.rolled(words)
        out = []
        for first, last in zip(bounds, bounds[1:], strict=False):
            n = last - first
            if n >= self.width:
                out.append(np.unique(rolled[first : last - self.width + 1]))
            elif n:
                out.append(mix(self.folded(words[first:last]) + np.uint64(n)))
            else:
                out.append(np.empty(0, np.uint64))
        return out

    def rolled(self, words: np.ndarray) -> np.ndarray:
        n = len(words) - self.width + 1
        if n < 1:
            return np.empty(0, np.uint64)
        total = np.zeros(n, np.uint64)
        for k in range(self.width):
            total = total * np.uint64(0x100000001B3) + words[k : k + n]
        return mix(total)

    @staticmethod
    def folded(words: np.ndarray) -> np.ndarray:
        total = np.zeros(1, np.uint64)
        for w in words:
            total = total * np.uint64(0x100000001B3) + w
        return total


def shingles(text: bytes, width: int) -> set[tuple[bytes, ...]]:
    """The shingles themselves."""
    words = text.lower().split()
    return set(zip(*(words[k:] for k in range(width)), strict=False)) if len(words) >= width else {tuple(words)} if words else set()


class CirculantMinHash:
    """All coordinates from two permutations of one universe.

    The first permutation scatters the elements. The second is read at places shifted by one more for every
    coordinate: coordinate k of a set is the least ``second[(first[x] + k) mod size]`` over its elements x.
    """

    def __init__(self, coordinates: int, bits: int = 22, seed: int = 20) -> None:
        draw = np.random.default_rng(seed)
        self.size, self.coordinates = 1 << bits, coordinates
        self.first = draw.permutation(self.size).astype(np.int64)
        second = draw.permutation(self.size).astype(np.uint32)
        self.second = np.concatenate((second, second[:coordinates]))
        #: row p holds the values at places p, p + 1, ... for all coordinates
        self.windows = np.lib.stride_tricks.sliding_window_view(self.second, coordinates)

    def sketch(self, sets: list[np.ndarray]) -> np.ndarray:
        """Coordinates by rows, one column for each set; sets must not be empty."""
        places = self.first[(np.concatenate(sets) & np.uint64(self.size - 1)).astype(np.int64)]
        out, start = np.empty((len(sets), self.coordinates), np.uint32), 0
        for row, end in zip(out, np.cumsum([len(s) for s in sets]).tolist(), strict=True):
            parts = [self.windows[places[i : min(i + 512, end)]].min(0) for i in range(start, end, 512)]
            np.minimum.reduce(parts, out=row)
            start = end
        return out.T


def band_keys(sketch: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit key per set and band."""
    bands = sketch.shape[0] // rows
    keys = np.empty((sketch.shape[1], bands), np.uint64)
    for b in range(bands):
        key = np.full(sketch.shape[1], b + 1, np.uint64)
        for r in range(rows):
            key = mix(key * np.uint64(0x9E3779B97F4A7C15) + sketch[b * rows + r])
        keys[:, b] = key
    return keys.view(np.int64)


def sketched(docs: DataFrame, width: int, kind: str) -> DataFrame:
    """(doc_id, n_shingles, key, bands, sketch): ``key`` is the digest of the whole shingle set, NULL if it is empty.

    ``sketch`` holds the low byte of every coordinate, then 32 bits of every band key.
    """

    def make():
        shingler, hasher = Shingler(width), CirculantMinHash(ROWS * BANDS)

        def step(batch):
            for part in slices(batch):
                sets = shingler.sets(raw_texts(part))
                full = [i for i, s in enumerate(sets) if len(s)]
                keys, bands, small = [None] * len(sets), [None] * len(sets), [None] * len(sets)
                if full:
                    sketch = hasher.sketch([sets[i] for i in full])
                    low = np.ascontiguousarray((sketch & 0xFF).astype(np.uint8).T)
                    for j, (i, row) in enumerate(zip(full, band_keys(sketch, ROWS), strict=True)):
                        keys[i], bands[i] = hashlib.blake2b(sets[i].tobytes(), digest_size=16).digest(), row
                        small[i] = low[j].tobytes() + (row & 0x7FFFFFFF).astype(np.int32).tobytes()
                yield {"doc_id": part.column("doc_id"), "n_shingles": [len(s) for s in sets], "key": keys, "bands": bands, "sketch": small}

        return step

    return map_batches(docs, f"doc_id {kind}, n_shingles long, key binary, bands array<long>, sketch binary", make)


def confirmed(pairs: DataFrame, texts: DataFrame, width: int, percent: int, kind: str) -> DataFrame:
    """Pairs (a, b) whose full shingle sets reach the similarity, by their hashes first and then by the shingles themselves.

    Every hub ``a`` meets its members in a stream sorted by hub: one set is held at a time. A hub of many members
    is dealt to several streams.
    """
    many = pairs.groupBy("a").agg(F.ceil(F.count("*") / MEMBERS).alias("_n"))
    dealt = pairs.join(many, "a").select("a", F.pmod(F.xxhash64("b"), "_n").alias("part"), "b")
    hubs = dealt.select("a", "part").distinct().join(texts, F.col("a") == F.col("doc_id")).select("a", "part", F.lit(None).cast(kind).alias("b"), "text")
    members = dealt.join(texts, F.col("b") == F.col("doc_id")).select("a", "part", "b", "text")
    stream = hubs.unionByName(members).repartition("a", "part").sortWithinPartitions("a", "part", F.col("b").asc_nulls_first())
    ddl = f"a {kind}, b {kind}"
    schema = arrow_schema(ddl)

    def run(batches):
        shingler, hub, own = Shingler(width), None, []
        for batch in batches:
            for part in slices(batch):
                found, texts = {"a": [], "b": []}, raw_texts(part)
                for a, b, s, t in zip(part.column("a").to_pylist(), part.column("b").to_pylist(), shingler.sets(texts), texts, strict=True):
                    if b is None:
                        own = [*own, Document(s, t, width)] if a == hub else [Document(s, t, width)]
                        hub = a
                    elif a == hub and any(o.alike(Document(s, t, width), percent) for o in own):
                        found["a"].append(a)
                        found["b"].append(b)
                if found["a"]:
                    yield pa.RecordBatch.from_pydict(found, schema=schema)

    return stream.mapInArrow(run, ddl)


class Document:
    """A text's hashed shingles, and the shingles themselves once they are asked for."""

    def __init__(self, hashed: np.ndarray, text: bytes, width: int) -> None:
        self.hashed, self.text, self.width = hashed, text, width

    @cached_property
    def shingles(self) -> set[tuple[bytes, ...]]:
        return shingles(self.text, self.width)

    def alike(self, other: Document, percent: int) -> bool:
        """Hashes rule out most pairs; the others are decided on the words."""
        if not alike(self.hashed, other.hashed, percent):
            return False
        if self.text == other.text:
            return True
        both = len(self.shingles & other.shingles)
        return 100 * both >= percent * (len(self.shingles) + len(other.shingles) - both)


def alike(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Sorted distinct arrays with 100 * intersection >= percent * union."""
    small, large = (x, y) if len(x) <= len(y) else (y, x)
    if not len(small) or 100 * len(small) < percent * len(large):
        return False
    at = np.minimum(np.searchsorted(large, small), len(large) - 1)
    both = int((large[at] == small).sum())
    return 100 * both >= percent * (len(x) + len(y) - both)


def tile_links(tiles: DataFrame, width: int, percent: int, kind: str) -> DataFrame:
    """Links (a, b) between different components of a bucket, as many as it takes to connect them, over tiles of buckets.

    tiles(bucket, t, node, component, sketch, text, _own, _ti, _tj), sorted by bucket and tile. Pairs whose sketches
    look similar are confirmed on full sets, the closest first; what is connected by then needs no more pairs. A pair
    is left to the first band that it shares, so no pair is confirmed twice and none is sent on.
    """
    ddl = f"a {kind}, b {kind}"
    schema = arrow_schema(ddl)
    coordinates, least = ROWS * BANDS, LEAST_ESTIMATE + (1 - LEAST_ESTIMATE) / 256

    def look_alike(tile: pa.Table, component: np.ndarray) -> np.ndarray:
        own = tile.column("_own").to_numpy()
        t, ti, tj = (tile.column(c)[0].as_py() for c in ("t", "_ti", "_tj"))
        packed = np.frombuffer(b"".join(tile.column("sketch").to_pylist()), np.uint8).reshape(len(own), -1)
        sketch, marks = packed[:, :coordinates], np.ascontiguousarray(packed[:, coordinates:]).view(np.int32)[:, :t]
        right = np.flatnonzero(own == tj)
        found = []
        for i in np.flatnonzero(own == ti):
            at = right[(component[right] != component[i]) & ((ti != tj) | (right > i))]
            same = (sketch[at] == sketch[i]).mean(1)
            close = same >= least
            at, same = at[close], same[close]
            first = ~(marks[at] == marks[i]).any(1)
            found.append(np.stack((same[first], np.full(first.sum(), i), at[first]), 1))
        pairs = np.concatenate(found) if found else np.empty((0, 3))
        return pairs[np.argsort(-pairs[:, 0], kind="stable"), 1:].astype(np.int64)

    def run(batches):
        shingler = Shingler(width)
        for tile in key_runs(batches, ["bucket", "_ti", "_tj"]):
            component = np.unique(tile.column("component").to_numpy(), return_inverse=True)[1]
            pairs = look_alike(tile, component) if component.max() else []
            root, sets, out = list(range(component.max() + 1)), {}, {"a": [], "b": []}

            def top(x: int) -> int:
                while root[x] != x:
                    root[x] = x = root[root[x]]
                return x

            nodes, texts = tile.column("node"), tile.column("text")
            for pair in pairs:
                p, q = (top(component[i]) for i in pair)
                if p == q:
                    continue
                for i in pair:
                    if i not in sets:
                        text = (texts[int(i)].as_py() or "").encode()
                        sets[i] = Document(shingler.sets([text])[0], text, width)
                if sets[pair[0]].alike(sets[pair[1]], percent):
                    root[p] = q
                    out["a"].append(nodes[int(pair[0])].as_py())
                    out["b"].append(nodes[int(pair[1])].as_py())
            if out["a"]:
                yield pa.RecordBatch.from_pydict(out, schema=schema)

    return tiles.mapInArrow(run, ddl)


def near_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text", width: int = 5, percent: int = 75) -> DataFrame:
    """Per row: (id, n_shingles, component_id, kept): documents linked by 100 * intersection >= percent * union.

    Words are runs without tab to carriage return and blank, A-Z in lower case. A text of fewer than ``width`` words is
    one shingle; NULL, empty and blank texts have none and link with nothing. Rows with equal ids are one document.
    Rows with NULL id link with nothing: component_id NULL, kept. An empty table gives no rows.

    Equal shingle sets become one node first, so exact copies never meet in pairs. Nodes are confirmed against the
    smallest node of their buckets; what those links join needs no more pairs. Then only buckets that still hold several
    components are compared, tile by tile, and every pair between components that looks close is confirmed on full
    sets in place, unless it is connected by then.
    """
    kind = dict(docs.dtypes)[id]
    rows = docs.select(F.col(id).alias("doc_id"), F.col(text).alias("text"))
    marked = written(sketched(rows, width, kind), "sketches")
    named = marked.filter("key is not null and doc_id is not null")
    heads = named.groupBy("key").agg(F.min("doc_id").alias("node"))
    nodes = named.join(heads.withColumnRenamed("key", "_key"), (F.col("key") == F.col("_key")) & (F.col("doc_id") == F.col("node")), "left_semi").select(F.col("doc_id").alias("node"), "bands", "sketch")
    entries = nodes.select("node", F.posexplode("bands").alias("t", "bucket"))
    shared = entries.groupBy("bucket").agg(F.min("node").alias("hub"), F.max("node").alias("far")).filter("hub <> far").select("bucket", "hub")
    members = written(entries.join(shared, "bucket"), "members")
    involved = members.select("node").distinct()
    texts = written(rows.join(involved, rows.doc_id == involved.node, "left_semi"), "texts")
    stars = members.filter("node <> hub").groupBy(F.col("node").alias("b")).agg(F.min("hub").alias("a")).select("a", "b")
    links = written(confirmed(stars, texts, width, percent, kind), "links")
    reached = components(links)
    labelled = members.join(reached, "node", "left").select("bucket", "t", "node", F.coalesce("component", "node").alias("component"))
    mixed = labelled.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low <> high").select("bucket")
    tiles = written(in_tiles(labelled.join(mixed, "bucket", "left_semi"), ["bucket"], "node", BLOCK), "tiles")
    read = nodes.join(tiles.select("node").distinct(), "node", "left_semi").select("node", "sketch").join(texts, F.col("node") == F.col("doc_id")).select("node", "sketch", "text")
    more = written(tile_links(sorted_by(tiles.join(read, "node"), ["bucket", "_ti", "_tj"]), width, percent, kind), "links")
    if not more.isEmpty():
        reached = components(links.unionByName(more))
    groups = heads.join(reached, "node", "left").select(F.col("key").alias("_key"), F.coalesce("component", "node").alias("component"))
    out = marked.join(groups, (F.col("key") == F.col("_key")) & F.col("doc_id").isNotNull(), "left")
    component = F.coalesce("component", "doc_id")
    return out.select(F.col("doc_id").alias(id), "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))
