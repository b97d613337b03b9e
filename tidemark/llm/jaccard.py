"""N-gram Jaccard join by PartEnum signatures.

Two sets with Jaccard similarity t or more, the smaller of size a, differ in at most
``a * (1 - t) / t`` elements. Sizes are cut into bands; a band has a bound ``k`` on
that difference. PartEnum's two levels: the domain of shingles is dealt into groups, and
each group into ``cells`` parts. A difference of ``k`` elements leaves a group with ``spare``
differences at most as soon as there are more than ``k / (spare + 1)`` groups, and those
spoil ``spare`` of its parts at most. So all subsets of ``cells - spare`` parts of each
group are enumerated as signatures, each the hash of all shingles in its parts: two
similar sets have one of them alike, in the band of the smaller. A set emits for
its own band and for those of all smaller sets it can be similar to.

Subsets without a shingle, or with shingles only that very many documents have, say
little. They are left out as long as the groups of which every subset has others
outnumber those that the difference can spoil; else the set emits them as well, and if
even its filled subsets are too few, each of its shingles. Of two similar sets, the one
that leaves out more is sure of a subset alike, and the other emits that too, so no link
between them is lost.

Signatures are shipped in packed blocks and sorted bucket by bucket. Those that a sample
shows in very many sets are dealt out by set instead, as plain rows that meet their
signature's first set in a broadcast join, so no task gets all sets of one. A shared
signature gives candidate pairs of its first set with each other one. Bitmaps of
their shingles, two bytes a shingle, bound what two sets can share; pairs that pass
are compared exactly on their shingle sets. Where a signature's sets do not all
end in one component that way, its most widely shared set is compared with the others. What is
still apart then is compared across components: bitmap by bitmap in a row for each small
group, which makes pairs of the close ones only. Where many share a signature, as edited copies of
one text do, the sets are first grouped anew by their rarest shingles: two similar sets share one
of the first that each has in an order by rarity, and the smaller has it among fewer still.
What is large even so is compared tile by tile of some hundred sets; there the sets outside
a group's largest component meet all of it. Only components are wanted, so pairs inside one need no comparison.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored, stored_with
from tidemark.llm.components import components
from tidemark.llm.hashing import CHUNK, mixed, offsets, shingle_sets

BLOCK_TEXTS = 512
SIGNATURES_PER_BUCKET = 500_000
BROADCAST_IDS = 1_000_000
COMMON_SAMPLE = 16_000
COMMON_SHARE = 0.0005
HOT_SAMPLE = 4_000
HOT_SETS = 4_000
HOT_LEAST = 8
TILE_SETS = 512
LARGE_GROUP = 64
GROUP_BYTES = 2048
# Rows that a Python worker gets at once: a small group has up to 128 KB, a pair of tiles some MB.
GROUP_ROWS = {"spark.sql.execution.arrow.maxRecordsPerBatch": "64"}
TILE_ROWS = {"spark.sql.execution.arrow.maxRecordsPerBatch": "2"}
RANKED_SAMPLE = 4_000
RANKED_SHINGLES = 500_000
RANKED_BUCKETS = 64

_u = np.uint64


@dataclass(frozen=True)
class Bands:
    """Bands of set sizes with the parts of the domain for each. ``top`` is a band's largest size."""

    percent: int = 75
    ratio: float = 1.5
    slack: float = 1.15
    cells: int = 3
    spare: int = 1

    def top(self, band: int) -> int:
        """The largest size of a band; band 0 holds size 1."""
        return int(self.ratio**band * 1.000001) if band < 8 else int(self.ratio**band)

    def band(self, size: int) -> int:
        band = max(0, int(np.log(max(1, size)) / np.log(self.ratio)) - 1)
        while self.top(band) < size:
            band += 1
        return band

    def difference(self, size: int) -> int:
        """How many elements a set of this size, as the smaller, may differ in."""
        return size * (100 - self.percent) // self.percent

    def spoiled(self, difference: int) -> int:
        """How many groups may have more than ``spare`` differences."""
        return difference // (self.spare + 1)

    def groups(self, band: int) -> int:
        return int(self.slack * (self.spoiled(self.difference(self.top(band))) + 1)) + 1

    def subsets(self) -> np.ndarray:
        """The parts of each enumerated subset of a group, one subset a row."""
        return np.array(list(combinations(range(self.cells), self.cells - self.spare)))

    def emitted(self, size: int) -> range:
        """The bands in which a set may meet a similar one that is smaller, or itself the smaller."""
        return range(self.band(-(-size * self.percent // 100)), self.band(size) + 1)


def _chunks(sets: list[np.ndarray]) -> Iterator[tuple[int, list[np.ndarray]]]:
    """The sets in lists of about ``CHUNK`` shingles, each with the place of its first set."""
    at, held = 0, 0
    for i, s in enumerate(sets):
        held += len(s)
        if held >= CHUNK:
            yield at, sets[at : i + 1]
            at, held = i + 1, 0
    if at < len(sets):
        yield at, sets[at:]


def signatures(shingles: np.ndarray, bands: Bands, common: np.ndarray) -> np.ndarray:
    """All signatures of one set of shingle hashes."""
    return signatures_of([shingles], bands, common)[0]


def signatures_of(sets: list[np.ndarray], bands: Bands, common: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All signatures of some sets of shingle hashes, and the place of the set that each is of."""
    names, owners = [np.zeros(0, dtype=np.uint64)], [np.zeros(0, dtype=np.int64)]
    for at, some in _chunks(sets):
        for found, owner in _signatures(some, bands, common):
            names.append(found)
            owners.append(owner + at)
    return np.concatenate(names), np.concatenate(owners)


def _signatures(sets: list[np.ndarray], bands: Bands, common: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The signatures of the sets band by band: what all sets of a band have is computed at once."""
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    shingles, which = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
    spread = mixed(shingles ^ _u(0x5BD1E995)) >> _u(32)
    part_hash = mixed(shingles + _u(1))
    rare = np.ones(len(shingles), dtype=bool)
    if len(common):
        rare = common[np.minimum(np.searchsorted(common, shingles), len(common) - 1)] != shingles
    emitted = [bands.emitted(n) if n else range(0) for n in sizes.tolist()]
    first, behind = np.array([e.start for e in emitted]), np.array([e.stop for e in emitted])
    subsets = bands.subsets()
    for band in range(first.min(), behind.max()):
        most = bands.difference(bands.top(band))
        here = (first <= band) & (band < behind)
        if most == 0 or not here.any():
            continue  # only equal sets are similar here
        groups = bands.groups(band)
        parts = groups * bands.cells
        own = np.flatnonzero(here)
        shape = (len(own), groups, bands.cells)
        taken = here[which]
        row = (np.cumsum(here) - 1)[which[taken]]
        part = row * parts + (spread[taken] * _u(parts) >> _u(32)).astype(np.int64)
        content = np.zeros(len(own) * parts, dtype=np.uint64)
        np.add.at(content, part, part_hash[taken])
        filled, telling = np.zeros((2, len(own) * parts), dtype=bool)
        filled[part] = True
        telling[part[rare[taken]]] = True
        content, filled, telling = (x.reshape(shape) for x in (content, filled, telling))
        place = np.arange(groups * len(subsets), dtype=np.uint64).reshape(groups, -1) + _u(band << 40)
        names = mixed(sum(content[:, :, cell] for cell in subsets.T) ^ mixed(place))
        spoiled = np.array([bands.spoiled(min(bands.difference(n), most)) for n in sizes[own].tolist()])

        def too_few(parts_with: np.ndarray) -> np.ndarray:
            """Whether the groups of a set of which every subset has such a part may all be spoiled."""
            held = sum(parts_with[:, :, cell].view(np.uint8) for cell in range(bands.cells))
            return np.count_nonzero(held > bands.spare, axis=1) <= spoiled

        def with_any(parts_with: np.ndarray) -> np.ndarray:
            return reduce(np.logical_or, (parts_with[:, :, cell] for cell in subsets.T))

        more = too_few(telling)
        emits = with_any(telling) | (with_any(filled) & more[:, None, None])
        yield names[emits], np.repeat(own, np.count_nonzero(emits, axis=(1, 2)))
        each = np.zeros(len(sets), dtype=bool)
        each[own] = more & too_few(filled)
        if each.any():
            yield mixed(shingles[each[which]] ^ _u((band << 40) + 7)), which[each[which]]


def set_hashes(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of each set."""
    first, second = np.zeros((2, len(sets)), dtype=np.uint64)
    for at, some in _chunks(sets):
        sizes = np.array([len(s) for s in some])
        shingles, ends = np.concatenate(some), offsets(sizes)
        for out, salt, extra in ((first, 11, sizes.astype(np.uint64)), (second, 23, _u(0))):
            sums = np.concatenate((np.zeros(1, dtype=np.uint64), np.cumsum(mixed(shingles + _u(salt)), dtype=np.uint64)))
            out[at : at + len(some)] = mixed(sums[ends[1:]] - sums[ends[:-1]] + extra)
    return first, second


def _blocks(batches: Iterator[pd.DataFrame], width: int) -> Iterator[tuple[pd.DataFrame, list[np.ndarray]]]:
    for batch in batches:
        for at in range(0, len(batch), BLOCK_TEXTS):
            block = batch.iloc[at : at + BLOCK_TEXTS]
            yield block, shingle_sets(block["text"].tolist(), width)


def _classes(docs: DataFrame, width: int) -> DataFrame:
    """Per document: its set size and its class, the hash of its set; null for the empty set."""

    def classify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for block, sets in _blocks(batches, width):
            first, second = set_hashes(sets)
            sizes = np.array([len(s) for s in sets])
            yield pd.DataFrame(
                {"id": block["id"].array, "text_hash": block["text_hash"].to_numpy(), "size": sizes, "set": pd.array(first.view(np.int64), dtype="Int64").copy(), "other": second.view(np.int64)}
            ).assign(set=lambda f: f["set"].mask(f["size"] == 0))

    hashed = docs.withColumn("text_hash", F.xxhash64("text"))
    return hashed.mapInPandas(classify, "id long, text_hash long, size long, set long, other long")


def _sample(docs: DataFrame) -> DataFrame:
    """The texts of a bounded sample of the documents."""
    sample = docs.orderBy(F.xxhash64("id"), "id").select("id").limit(COMMON_SAMPLE)
    return stored(docs.join(F.broadcast(sample.distinct()), "id").select("text"), "jaccard-sample")


def _common(sample: DataFrame, width: int) -> np.ndarray:
    """Shingles that an estimated share of all documents has.

    They only steer which parts count as telling; any list gives the same links.
    """

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for _, sets in _blocks(batches, width):
            values, times = np.unique(np.concatenate(sets), return_counts=True)
            yield pd.DataFrame({"shingle": values.view(np.int64), "n": times})

    counted = sample.mapInPandas(count, "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n"))
    least = max(2, int(COMMON_SAMPLE * COMMON_SHARE))
    found = counted.where(F.col("n") >= least).select("shingle").toPandas()["shingle"].to_numpy(dtype=np.int64)
    return np.sort(found.view(np.uint64))


def _hot(sample: DataFrame, total: int, width: int, bands: Bands, common: np.ndarray) -> np.ndarray:
    """Signatures that an estimated ``HOT_SETS`` of the ``total`` sets have, or so large a share of them that a sample tells.

    They only steer how signatures are dealt out; any list gives the same candidates.
    """
    few = sample.select("text", F.xxhash64("text").alias("key")).dropDuplicates(["key"]).orderBy("key").limit(HOT_SAMPLE)
    few = few.repartition(int(sample.sparkSession.conf.get("spark.sql.shuffle.partitions")), "key").select("text")
    few, (sampled,) = stored_with(few, "jaccard-hot-sample", F.count("*"))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for _, sets in _blocks(batches, width):
            found, of = signatures_of([s for s in sets if len(s)], bands, common)
            values, times = np.unique(found[_once(found, of)], return_counts=True)
            yield pd.DataFrame({"name": values.view(np.int64), "n": times})

    counted = few.mapInPandas(count, "name long, n long").groupBy("name").agg(F.sum("n").alias("n"))
    least = max(HOT_LEAST, HOT_SETS * min(1.0, sampled / max(1, total)))
    found = counted.where(F.col("n") >= least).select("name").toPandas()["name"].to_numpy(dtype=np.int64)
    return np.sort(found.view(np.uint64))


def _candidates(docs: DataFrame, width: int, bands: Bands, buckets: int, common: np.ndarray, hot: np.ndarray) -> DataFrame:
    """Rows of three kinds: candidate ``pair``s a, b; a group and its ``member`` of a signature of three or more sets; a ``hot`` signature and its set."""

    def emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        done: set[int] = set()
        for batch in batches:
            names: list[np.ndarray] = []
            owners: list[np.ndarray] = []
            held = 0
            for _, sets in _blocks(iter([batch]), width):
                sets = [s for s in sets if len(s)]
                classes, _ = set_hashes(sets)
                fresh = []
                for i, own in enumerate(classes.tolist()):
                    if own in done:
                        continue  # a copy within this task adds nothing
                    if len(done) < 1_000_000:
                        done.add(own)
                    fresh.append(i)
                found, of = signatures_of([sets[i] for i in fresh], bands, common)
                names.append(found)
                owners.append(classes[fresh][of])
                held += len(found)
                if held > SIGNATURES_PER_BUCKET:
                    yield from pack(names, owners)
                    names, owners, held = [], [], 0
            yield from pack(names, owners)

    def pack(names: list[np.ndarray], owners: list[np.ndarray]) -> Iterator[pd.DataFrame]:
        if not names:
            return
        name, owner = np.concatenate(names), np.concatenate(owners)
        bucket = (name >> _u(32)) * _u(buckets) >> _u(32)
        if len(hot):
            # Behind the other buckets, and dealt out by set: a signature's place in the list stands for it.
            place = np.minimum(np.searchsorted(hot, name), len(hot) - 1)
            is_hot = hot[place] == name
            bucket = np.where(is_hot, _u(buckets) + ((mixed(owner) >> _u(32)) * _u(buckets) >> _u(32)), bucket)
            name = np.where(is_hot, place.astype(np.uint64), name)
        order = np.argsort(bucket.astype(np.uint32), kind="stable")
        name, owner, bucket = name[order], owner[order], bucket[order]
        edges = np.flatnonzero(np.diff(bucket)) + 1
        starts = np.concatenate(([0], edges)) if len(name) else edges
        yield pd.DataFrame(
            {
                "bucket": bucket[starts].astype(np.int64),
                # The bucket has the upper half; a name met by chance costs one comparison more.
                "names": [x.tobytes() for x in np.split(name.astype(np.uint32), edges)] if len(name) else [],
                "owners": [x.tobytes() for x in np.split(owner, edges)] if len(name) else [],
            }
        )

    def meet(block: pd.DataFrame) -> pd.DataFrame:
        name = np.frombuffer(b"".join(block["names"]), dtype=np.uint32)
        owner = np.frombuffer(b"".join(block["owners"]), dtype=np.uint64)
        if block["bucket"].iloc[0] >= buckets:
            fresh = _once(name, owner)
            return pd.DataFrame({"kind": "hot", "a": hot[name[fresh].astype(np.int64)].view(np.int64), "b": owner[fresh].view(np.int64)})
        order = _order(name)
        name, owner = name[order], owner[order]
        again = np.zeros(len(name), dtype=bool)
        again[1:] = name[1:] == name[:-1]
        again[:-1] |= again[1:].copy()
        name, owner = name[again], owner[again]  # signatures of one set alone meet nothing
        order = np.argsort(owner)
        order = order[_order(name[order])]
        name, owner = name[order], owner[order]
        fresh = np.ones(len(name), dtype=bool)
        fresh[1:] = (name[1:] != name[:-1]) | (owner[1:] != owner[:-1])
        name, owner = name[fresh], owner[fresh]
        start = np.flatnonzero(np.concatenate(([True], name[1:] != name[:-1]))) if len(name) else np.zeros(0, int)
        size = np.diff(np.append(start, len(name)))
        hub = np.repeat(owner[start], size) if len(name) else owner
        left, right = hub[hub != owner], owner[hub != owner]
        pairs = _once(left, right)
        group, member = _groups(owner, start, size)
        return pd.DataFrame(
            {
                "kind": np.repeat(["pair", "member"], [len(pairs), len(member)]),
                "a": np.append(left[pairs], group).view(np.int64),
                "b": np.append(right[pairs], member).view(np.int64),
            }
        )

    packed = docs.mapInPandas(emit, "bucket long, names binary, owners binary")
    # Signatures of one group often bring the same sets together in several buckets.
    return packed.groupBy("bucket").applyInPandas(meet, "kind string, a long, b long").distinct()


def _once(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Where each different pair of values stands first, in the pairs' order."""
    order = np.lexsort((second, first))
    first, second = first[order], second[order]
    fresh = np.ones(len(order), dtype=bool)
    fresh[1:] = (first[1:] != first[:-1]) | (second[1:] != second[:-1])
    return order[fresh]


def _order(names: np.ndarray) -> np.ndarray:
    """The order of 32-bit names, equal ones as they stood; plain values sort much faster than places."""
    order = (names.astype(np.uint64) << _u(32)) | np.arange(len(names), dtype=np.uint64)
    order.sort()
    return (order & _u(0xFFFFFFFF)).astype(np.int64)


def _by_bucket(bucket: np.ndarray, columns: dict[str, np.ndarray]) -> pd.DataFrame:
    """A row for each bucket, with its values of each column as bytes."""
    order = np.argsort(bucket, kind="stable")
    bucket = bucket[order]
    start = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])[: len(bucket)])
    return pd.DataFrame(
        {"bucket": bucket[start].astype(np.int64)}
        | {k: [x.tobytes() for x in np.split(v[order], start[1:])] if len(start) else [] for k, v in columns.items()}
    )


def _groups(owner: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Name and member of each different group of three or more sets; groups of one name are one."""
    if not len(start):
        return owner, owner
    first = mixed(np.add.reduceat(mixed(owner + _u(31)), start) + size.astype(np.uint64))
    second = np.add.reduceat(mixed(owner + _u(47)), start)
    at = _once(first, second)
    at = at[size[at] > 2]
    ends = np.cumsum(size[at])
    rows = np.arange(ends[-1] if len(at) else 0) + np.repeat(start[at] - (ends - size[at]), size[at])
    return np.repeat(first[at] ^ mixed(second[at]), size[at]), owner[rows.astype(np.int64)]


def _met(found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The distinct candidate pairs, and the groups with their sets as group and node."""
    hot = found.where("kind = 'hot'").select(F.col("a").alias("name"), F.col("b").alias("node"))
    once = hot.groupBy("name").agg(
        F.min("node").alias("hub"), F.count("*").alias("n"), F.bit_xor(F.xxhash64("node")).alias("x"), F.bit_xor(F.xxhash64("node", F.lit(1))).alias("y")
    )
    # Of hot signatures with the same sets one is enough; their list is bounded by the sample.
    once = stored(once.where("n > 1").groupBy("n", "x", "y").agg(F.min(F.struct("name", "hub")).alias("one")).select("n", "one.*"), "jaccard-hot")
    shared = hot.join(F.broadcast(once), "name")
    pairs = found.where("kind = 'pair'").select("a", "b").union(
        shared.where("node != hub").select(F.col("hub").alias("a"), F.col("node").alias("b"))
    )
    members = found.where("kind = 'member'").select(F.col("a").alias("group"), F.col("b").alias("node"))
    members = members.union(shared.where("n > 2").select("name", "node"))
    return stored(pairs.distinct(), "jaccard-pairs"), stored(members, "jaccard-groups")


def _slots(size: int) -> int:
    """Bits of a set's bitmap: a power of two, 8 to 16 for each shingle."""
    return 1 << max(6, (16 * size).bit_length() - 1)


def sketch(shingles: np.ndarray) -> bytes:
    """A bitmap of the slots that the shingles fall in."""
    bits = np.zeros(_slots(len(shingles)), dtype=bool)
    bits[(shingles & _u(len(bits) - 1)).astype(np.int64)] = True
    return np.packbits(bits, bitorder="little").tobytes()


def _folded(bitmaps: np.ndarray, width: int) -> np.ndarray:
    """Bitmaps, one a row, over the fewer slots of ``width`` bytes."""
    if bitmaps.shape[1] == width:
        return bitmaps
    return np.bitwise_or.reduce(bitmaps.reshape(len(bitmaps), -1, width), axis=1)


def _filled(bitmaps: np.ndarray) -> np.ndarray:
    words = np.ascontiguousarray(bitmaps).view(np.uint64)
    return np.bitwise_count(words).sum(axis=1, dtype=np.int64)


def may_be_similar(a: bytes, size_a: int, others: np.ndarray, sizes: np.ndarray, percent: int) -> np.ndarray:
    """False only for sets that can't be similar to the first; all others have one bitmap length.

    Common shingles lie in common slots. They are no more than these, but for those
    shingles of either set that share a slot with another one of it.
    """
    own = np.frombuffer(a, dtype=np.uint8)[None, :]
    width = min(own.shape[1], others.shape[1])
    own, others = _folded(own, width), _folded(others, width)
    lost = np.minimum(size_a - _filled(own), sizes - _filled(others))
    shared = np.minimum(_filled(own & others) + lost, np.minimum(size_a, sizes))
    return 100 * shared >= percent * (size_a + sizes - shared)


def _sets(docs: DataFrame, classes: DataFrame, pairs: DataFrame, width: int, whole: bool) -> DataFrame:
    """set, size and content (the sketch, or the ``whole`` set) of the sets in the pairs, from one document each."""
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("set")).distinct()
    firsts, (ids,) = stored_with(classes.join(wanted, "set").select(F.col("first").alias("id")).distinct(), "jaccard-wanted", F.count("*"))
    if ids <= BROADCAST_IDS:
        firsts = F.broadcast(firsts)

    def contents(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for _, sets in _blocks(batches, width):
            sets = [s for s in sets if len(s)]
            first, _ = set_hashes(sets)
            yield pd.DataFrame(
                {"set": first.view(np.int64), "size": [len(s) for s in sets], "content": [s.tobytes() if whole else sketch(s) for s in sets]}
            )

    texts = docs.join(firsts, docs["id"].eqNullSafe(firsts["id"]), "left_semi").select("text")
    return stored(texts.mapInPandas(contents, "set long, size long, content binary"), "jaccard-contents")


def _compared(pairs: DataFrame, sets: DataFrame, test) -> DataFrame:
    """The distinct pairs whose sizes and contents pass the test."""
    left = sets.select(F.col("set").alias("a"), F.col("size").alias("size_a"), F.col("content").alias("left"))
    right = sets.select(F.col("set").alias("b"), F.col("size").alias("size_b"), F.col("content").alias("right"))
    both = pairs.join(right, "b").join(left, "a")
    return both.where(test("left", "size_a", "right", "size_b")).select("a", "b").distinct()


def _links(docs: DataFrame, classes: DataFrame, pairs: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs whose sets are similar, by exact comparison of those that may be."""

    @F.pandas_udf("boolean")
    def may_be(left: pd.Series, size_a: pd.Series, right: pd.Series, size_b: pd.Series) -> pd.Series:
        out = [
            may_be_similar(x, n, np.frombuffer(y, dtype=np.uint8)[None, :], np.array([m]), percent)[0]
            for x, n, y, m in zip(left, size_a.tolist(), right, size_b.tolist())
        ]
        return pd.Series(out, dtype=bool)

    close = stored(_compared(pairs, _sets(docs, classes, pairs, width, False), may_be), "jaccard-close")
    return _exact(close, _sets(docs, classes, close, width, True), percent)


def _exact(close: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose sets are similar, by comparison of the whole sets."""

    @F.pandas_udf("boolean")
    def similar(left: pd.Series, size_a: pd.Series, right: pd.Series, size_b: pd.Series) -> pd.Series:
        out = []
        for x, y in zip(left, right):
            a, b = np.frombuffer(x, dtype=np.uint64), np.frombuffer(y, dtype=np.uint64)
            both = np.concatenate((a, b))
            both.sort(kind="stable")
            shared = np.count_nonzero(both[1:] == both[:-1])
            out.append(100 * shared >= percent * (len(a) + len(b) - shared))
        return pd.Series(out, dtype=bool)

    return stored(_compared(close, sets, similar), "jaccard-links")


def _open_groups(members: DataFrame, joined: DataFrame) -> DataFrame:
    """group, node, root and number of members of the signatures whose sets are in more than one component."""
    rooted = members.join(joined, "node", "left").select("group", "node", F.coalesce("root", "node").alias("root"))
    split = rooted.groupBy("group").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count("*").alias("members")).where("low < high")
    return stored(rooted.join(split.select("group", "members"), "group"), "jaccard-open")


def _shingle_counts(sets: DataFrame) -> DataFrame:
    """How many of the sets have each shingle, packed: bucket, shingles and times."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            values, times = np.unique(np.frombuffer(b"".join(batch["content"]), dtype=np.uint64), return_counts=True)
            yield _by_bucket((values >> _u(32)) * _u(RANKED_BUCKETS) >> _u(32), {"shingles": values, "times": times.astype(np.int64)})

    return sets.mapInPandas(count, "bucket long, shingles binary, times binary")


def _ranked(sets: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that several sets of a bounded sample have, sorted, and how many do.

    They only steer the order in which a set's shingles are taken; any list gives the same links.
    """
    few = stored(sets.orderBy(F.xxhash64("set"), "set").limit(RANKED_SAMPLE).repartition(
        int(sets.sparkSession.conf.get("spark.sql.shuffle.partitions")), "set"
    ).select("content"), "jaccard-ranked-sample")

    def add(block: pd.DataFrame) -> pd.DataFrame:
        """Most shingles are of one set alone and never become rows."""
        values = np.frombuffer(b"".join(block["shingles"]), dtype=np.uint64)
        values, at = np.unique(values, return_inverse=True)
        times = np.zeros(len(values), dtype=np.int64)
        np.add.at(times, at, np.frombuffer(b"".join(block["times"]), dtype=np.int64))
        return pd.DataFrame({"shingle": values.view(np.int64), "n": times})[times > 1]

    counted = _shingle_counts(few).groupBy("bucket").applyInPandas(add, "shingle long, n long")
    found = counted.orderBy(F.desc("n"), "shingle").limit(RANKED_SHINGLES).toPandas()
    shingle, times = found["shingle"].to_numpy(dtype=np.int64).view(np.uint64), found["n"].to_numpy(dtype=np.int64)
    order = np.argsort(shingle)
    return shingle[order], times[order]


def first_shingles(shingles: np.ndarray, ranked: np.ndarray, times: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """A set's rarest shingles, and whether each is ``able``.

    All that two sets share lies behind the first shared one, in either. So that one
    leaves at least ``percent`` of a set behind it, itself included, and of the smaller set, or
    of both if equal in size, what two sets of its size have to share: there it is able.
    """
    often = np.zeros(len(shingles), dtype=np.int64)
    if len(ranked):
        place = np.minimum(np.searchsorted(ranked, shingles), len(ranked) - 1)
        often = np.where(ranked[place] == shingles, times[place], 0)
    size = len(shingles)
    first = shingles[np.lexsort((shingles, often))][: size + 1 + (-percent * size // 100)]
    return first, np.arange(len(first)) <= size + (-2 * percent * size // (100 + percent))


def _regrouped(groups: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The sets of the groups in new ones, by rare shingles: group, node, root, able, and number of members.

    Similar sets of different components have a group in common where one of them is able.
    """
    nodes = groups.select("node", "root").distinct()
    rows, (total,) = stored_with(
        nodes.join(sets.withColumnRenamed("set", "node"), "node").select("node", "root", "content"),
        "jaccard-regrouped-sets", F.coalesce(F.sum(F.length("content")), F.lit(0)),
    )
    ranked, times = _ranked(rows.withColumnRenamed("node", "set"))

    often = ranked[times >= HOT_LEAST]
    buckets = max(int(total // 8 // SIGNATURES_PER_BUCKET) + 1, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))

    def take(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [first_shingles(np.frombuffer(x, dtype=np.uint64), ranked, times, percent) for x in batch["content"]]
            if found:
                counts = [len(first) for first, _ in found]
                shingle = np.concatenate([first for first, _ in found])
                node = np.repeat(batch["node"].to_numpy(), counts)
                bucket = (shingle >> _u(32)) * _u(buckets) >> _u(32)
                if len(often):
                    # Behind the other buckets, and dealt out by set: so no task gets all sets of such a shingle.
                    is_often = often[np.minimum(np.searchsorted(often, shingle), len(often) - 1)] == shingle
                    bucket = np.where(is_often, _u(buckets) + ((mixed(node.view(np.uint64)) >> _u(32)) * _u(buckets) >> _u(32)), bucket)
                yield _by_bucket(bucket, {
                    "shingles": shingle, "nodes": node, "roots": np.repeat(batch["root"].to_numpy(), counts), "ables": np.concatenate([able for _, able in found])
                })

    def meet(block: pd.DataFrame) -> pd.DataFrame:
        """Most shingles are of one component alone, or able nowhere, and never become rows."""
        kinds = {"shingles": np.int64, "nodes": np.int64, "roots": np.int64, "ables": np.bool_}
        shingle, node, root, able = (np.frombuffer(b"".join(block[k]), dtype=kind) for k, kind in kinds.items())
        if block["bucket"].iloc[0] < buckets:
            order = np.lexsort((root, shingle))
            shingle, node, root, able = shingle[order], node[order], root[order], able[order]
            start = np.flatnonzero(np.append(True, shingle[1:] != shingle[:-1]))
            size = np.diff(np.append(start, len(shingle)))
            meets = np.repeat((root[start] != root[start + size - 1]) & np.logical_or.reduceat(able, start), size)
            shingle, node, root, able = shingle[meets], node[meets], root[meets], able[meets]
        return pd.DataFrame({"group": shingle, "node": node, "root": root, "able": able})

    packed = rows.mapInPandas(take, "bucket long, shingles binary, nodes binary, roots binary, ables binary")
    taken = stored(packed.groupBy("bucket").applyInPandas(meet, "group long, node long, root long, able boolean"), "jaccard-first-shingles")
    split = taken.groupBy("group").agg(
        F.min("root").alias("low"), F.max("root").alias("high"), F.max("able").alias("able"), F.count("*").alias("members"),
        F.bit_xor(F.xxhash64("node", "able")).alias("x"), F.bit_xor(F.xxhash64("node", "able", F.lit(1))).alias("y"),
    ).where("low < high AND able")
    # Of groups with the same sets one is enough.
    once = split.groupBy("members", "x", "y").agg(F.min("group").alias("group")).select("group", "members")
    return stored(taken.join(once, "group"), "jaccard-regrouped")


def _close_in_groups(sets: DataFrame, groups: DataFrame, percent: int) -> DataFrame:
    """Pairs from different components of small groups that may be similar.

    A group's bitmaps meet in one row and are compared there, so no pairs are made of
    sets that can't be similar. Bitmaps are folded to ``GROUP_BYTES``, so a row stays small.
    """

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            bitmaps = [np.frombuffer(sketch(np.frombuffer(x, dtype=np.uint64)), dtype=np.uint8)[None, :] for x in batch["content"]]
            yield batch.assign(content=[_folded(x, min(x.shape[1], GROUP_BYTES))[0].tobytes() for x in bitmaps])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("sets")
            rows = lists.flatten()
            ends = offsets(lists.value_lengths().to_numpy(zero_copy_only=False))
            node, root, size = (rows.field(k).to_numpy(zero_copy_only=False) for k in ("node", "root", "size"))
            held = [np.zeros((0, 2), dtype=np.int64)]
            for at, to in zip(ends[:-1].tolist(), ends[1:].tolist()):
                held.extend(_close_of(node[at:to], root[at:to], size[at:to], rows.field("content").slice(at, to - at).to_pylist(), percent))
            found = np.concatenate(held)
            found = found[_once(found[:, 0], found[:, 1])]
            yield pa.RecordBatch.from_pydict({"a": found[:, 0], "b": found[:, 1]})

    wanted = sets.withColumnRenamed("set", "node").join(groups.select("node").distinct(), "node", "left_semi")
    folded = stored(wanted.select("node", "size", "content").mapInPandas(fold, "node long, size long, content binary"), "jaccard-folded")
    together = groups.join(folded, "node").groupBy("group").agg(F.collect_list(F.struct("node", "root", "size", "content")).alias("sets"))
    return stored(together.select("sets").mapInArrow(compare, "a long, b long").distinct(), "jaccard-close-in-groups", GROUP_ROWS)


def _close_of(nodes: np.ndarray, roots: np.ndarray, sizes: np.ndarray, contents: list[bytes], percent: int) -> Iterator[np.ndarray]:
    """Pairs of one group's sets, as rows of the lesser and the greater, that may be similar and are not in one component."""
    lengths = np.array([len(x) for x in contents])
    blocks = []
    for length in np.unique(lengths).tolist():
        own = np.flatnonzero(lengths == length)
        bitmaps = np.frombuffer(b"".join([contents[i] for i in own]), dtype=np.uint8).reshape(len(own), -1)
        blocks.append((bitmaps, nodes[own], roots[own], sizes[own]))
    for at, (left, node, root, size) in enumerate(blocks):
        for right, others, other_roots, other_sizes in blocks[at:]:
            for i in range(len(node)):
                near = (100 * np.minimum(other_sizes, size[i]) >= percent * np.maximum(other_sizes, size[i])) & (other_roots != root[i])
                if right is left:
                    near[: i + 1] = False
                to = np.flatnonzero(near)
                if len(to):
                    found = others[to[may_be_similar(left[i].tobytes(), size[i], right[to], other_sizes[to], percent)]]
                    yield np.stack([np.minimum(node[i], found), np.maximum(node[i], found)], axis=1)


def _by_members(groups: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Groups that fit in a row each, and larger ones."""
    return groups.where(F.col("members") < LARGE_GROUP), groups.where(F.col("members") >= LARGE_GROUP)


def _placed(groups: DataFrame) -> DataFrame:
    """group, node, root, whether the node is outside the group's largest component, and the node's tile.

    A set's home is its largest group; homes are cut into tiles by hash, the largest
    component apart from the others, and sets that are able there from those that are not.
    """
    if "able" not in groups.columns:
        groups = groups.withColumn("able", F.lit(True))
    parts = groups.groupBy("group", "root").agg(F.count("*").alias("n"))
    major = parts.groupBy("group").agg(F.max(F.struct("n", "root")).alias("major"))
    rooted = groups.join(major, "group").select("group", "node", "root", "members", "able", (F.col("root") != F.col("major.root")).alias("minor"))
    homes = rooted.groupBy("node").agg(F.max(F.struct("members", "group", "minor", "able")).alias("home"))
    homes = homes.select("node", F.struct("home.group", "home.minor", "home.able").alias("home"))
    counts = homes.groupBy("home").agg(F.ceil(F.count("*") / TILE_SETS).alias("tiles"))
    tile = F.xxhash64("home.group", "home.minor", "home.able", F.pmod(F.xxhash64("node"), F.col("tiles"))).alias("tile")
    tiles = homes.join(counts, "home").select("node", tile)
    return stored(rooted.join(tiles, "node").select("group", "node", "root", "minor", "able", "tile"), "jaccard-placed")


def _tile_pairs(placed: DataFrame) -> DataFrame:
    """Tiles i and j to compare: in a group, those with sets outside its largest component meet all, if either has able ones."""
    met = placed.groupBy("group", "tile").agg(F.max("minor").alias("minor"), F.max("able").alias("able"))
    what = (F.xxhash64("tile", "minor", "able"), F.xxhash64("tile", "minor", "able", F.lit(1)))
    same = met.groupBy("group").agg(F.count("*").alias("n"), F.bit_xor(what[0]).alias("x"), F.bit_xor(what[1]).alias("y"))
    met = stored(met.join(same.groupBy("n", "x", "y").agg(F.min("group").alias("group")).select("group"), "group"), "jaccard-met")
    left = met.where("minor").select("group", F.col("tile").alias("x"), F.col("able").alias("able_x"))
    right = met.select("group", F.col("tile").alias("y"), F.col("able").alias("able_y"))
    return left.join(right, "group").where("able_x OR able_y").select(F.least("x", "y").alias("i"), F.greatest("x", "y").alias("j")).distinct()


def _close_in_tiles(sets: DataFrame, groups: DataFrame, percent: int) -> DataFrame:
    """Pairs from different components of large groups that may be similar.

    Two tiles are compared once, however many groups they share.
    """
    placed = _placed(groups)
    nodes = placed.select("node", "root", "tile").distinct()

    def sketches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.assign(content=[sketch(np.frombuffer(x, dtype=np.uint64)) for x in batch["content"]])

    whole = nodes.join(sets.withColumnRenamed("set", "node"), "node").select("node", "root", "tile", "size", "content")
    tiles = (
        whole.mapInPandas(sketches, "node long, root long, tile long, size long, content binary")
        .groupBy("tile", F.length("content").alias("bytes"))
        .agg(F.collect_list(F.struct("node", "root", "size", "content")).alias("sets"))
    )
    tiles = stored(tiles, "jaccard-tiles")
    tile_pairs = _tile_pairs(placed)

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for left, right in zip(batch["left"], batch["right"]):
                left, right = sorted((left, right), key=len)
                bitmaps = np.frombuffer(b"".join(r["content"] for r in right), dtype=np.uint8).reshape(len(right), -1)
                node, root, size = (np.array([r[k] for r in right], dtype=np.int64) for k in ("node", "root", "size"))
                for x in left:
                    near = (100 * np.minimum(size, x["size"]) >= percent * np.maximum(size, x["size"])) & (root != x["root"])
                    at = np.flatnonzero(near)
                    if len(at):
                        found = node[at[may_be_similar(x["content"], x["size"], bitmaps[at], size[at], percent)]]
                        if len(found):
                            yield pd.DataFrame({"a": np.minimum(x["node"], found), "b": np.maximum(x["node"], found)})

    joined = tile_pairs.join(tiles.select(F.col("tile").alias("i"), F.col("sets").alias("left")), "i").join(
        tiles.select(F.col("tile").alias("j"), F.col("sets").alias("right")), "j"
    )
    return stored(joined.select("left", "right").mapInPandas(compare, "a long, b long").distinct(), "jaccard-close-in-tiles", TILE_ROWS)


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, bands: Bands = Bands()
) -> DataFrame:
    """One row per document: id, n_shingles, component_id, the smallest id reachable by links, text_hash and component.

    Two documents link when their sets of ``width``-word shingles have a Jaccard
    similarity of ``bands.percent`` or more. Documents with fewer words have one
    shingle; those without words, or with a null text, have none and link with
    nothing, not even with each other. Documents with equal sets always link.

    ``component`` tells components apart also where ids repeat or are null; it is null
    for documents without words.

    Repeated rows are rows of their own in the result. A null id is never the
    smallest; where a component has no other, its component_id is null. No documents
    give no rows. Other columns are ignored, whatever their names.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    rows = stored(_classes(docs, width), "jaccard-classes")
    classes, (distinct, total) = stored_with(
        rows.where("set IS NOT NULL").groupBy("set", "other").agg(F.min("id").alias("first"), F.max("size").alias("size")),
        "jaccard-sets", F.count("*"), F.coalesce(F.sum("size"), F.lit(0)),
    )
    buckets = max(int(total // SIGNATURES_PER_BUCKET) + 1, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    sample = _sample(docs)
    common = _common(sample, width)
    hot = _hot(sample, distinct, width, bands, common)
    found = stored(_candidates(docs.select("text"), width, bands, buckets, common, hot), "jaccard-candidates")

    pairs, members = _met(found)
    links = _links(docs, classes, pairs, width, bands.percent)
    joined = components(links)

    # What a shared signature leaves in more than one component is compared across them.
    groups = _open_groups(members, joined)
    if not groups.isEmpty():
        # Of a group of edited copies the least edited one shares the most signatures.
        spread = members.groupBy("node").agg(F.count("*").alias("spread"))
        hubs = groups.join(spread, "node").groupBy("group").agg(F.max(F.struct("spread", "node", "root")).alias("hub"))
        stars = groups.join(hubs, "group").where(F.col("root") != F.col("hub.root")).select(
            F.least("node", "hub.node").alias("a"), F.greatest("node", "hub.node").alias("b")
        )
        more = _links(docs, classes, stored(stars.distinct().join(pairs, ["a", "b"], "left_anti"), "jaccard-stars"), width, bands.percent)
        links = links.union(more)
        joined = components(links)
        groups = _open_groups(members, joined)
    if not groups.isEmpty():
        sets = _sets(docs, classes, groups.select(F.col("node").alias("a"), F.col("node").alias("b")), width, True)
        small, large = _by_members(groups)
        if not large.isEmpty():
            fewer, large = _by_members(_regrouped(large, sets, bands.percent))
            small = small.union(fewer.select(small.columns))
        close = _close_in_groups(sets, small, bands.percent)
        if not large.isEmpty():
            close = close.union(_close_in_tiles(sets, large, bands.percent)).distinct()
        links = links.union(_exact(close, sets, bands.percent))
        joined = components(links)

    rooted = classes.select("set", "other", "first").join(joined.withColumnRenamed("node", "set"), "set", "left").select(
        "set", "other", "first", F.coalesce("root", "set").alias("root")
    )
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = stored(rooted.join(least, "root").select("set", "other", "component_id", "root"), "jaccard-components")
    linked = rows.where("set IS NOT NULL").join(named, ["set", "other"]).select("id", "text_hash", "size", "component_id", "root")
    alone = rows.where("set IS NULL").select("id", "text_hash", "size", F.col("id").alias("component_id"), F.lit(None).cast("long").alias("root"))
    return linked.union(alone).select(
        F.col("id").alias(id_col), F.col("size").alias("n_shingles"), "component_id", "text_hash", F.col("root").alias("component")
    )
