"""Near-duplicate texts by a parity-sketch join on word shingles.

A text is the set of its word shingles, as 64-bit hashes. By size the sets fall into bands, so
that linked sets lie in one band or in neighbouring ones. For each band the hash space is cut
into blocks, and a block's sketch is the XOR of the hashes in it. A shingle which only one of
two sets has changes one block, so the number of differing blocks is a lower bound of the
symmetric difference; with ``d`` as its largest value for linked sets of a band and ``d + q``
blocks, linked sets agree in ``q`` blocks at least. Pairs are found by joining on (band, block,
sketch). ``q`` exceeds the number of poor blocks, with too few shingles to be telling, that a
set normally has, so poor blocks need no join; a set with ``q`` or more of them joins on those
too, and its partners do the same, so no link is lost.

A bucket gives no list of pairs: its members are paired with the most central one, pairs are
verified on the whole sets, and only where a bucket still holds several components are their
members compared across, inside its group. A bit sketch (each shingle flips one bit, so the Hamming distance is
again a lower bound) sorts out pairs before texts are moved. It has about as many bits as there are shingles, as
fewer would tell nothing of a large set; a larger sketch folds to a smaller one by XOR.

Nulls and edges: a null text, an empty one and one without words have an empty set, linked
with nothing; with fewer words than a shingle the whole sequence is the one shingle; equal
texts link; rows with one ``doc_id`` are one document, linked by any of its texts; a null
``doc_id`` has no component; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from parley.llm.common import id_filter, prepare_workers, stored
from parley.llm.components import components

#: Odd factors of the hashes, one per word of a shingle and for mixing.
_FACTORS = [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F]
_MIX, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
#: Bits of the sketch of a small set, and of the largest ones.
SKETCH_BITS, MOST_SKETCH_BITS = 1024, 1 << 16
#: Members that one verification group holds next to its hub.
GROUP = 128
#: Members of a bucket that are compared across with as many others in one group.
CHUNK = 2048
#: Sets remembered in a task, of which only the first copy sends its blocks.
COPIES = 200_000


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


class Shingles:
    """The sorted distinct hashes of a text's word shingles."""

    def __init__(self, words: int):
        self.words = words
        factors = [_FACTORS[i % 5] + 2 * (i // 5) for i in range(words)]
        self.factors = [np.uint64(f) for f in factors]

    def of(self, text: str | None) -> np.ndarray:
        found = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
        if not found:
            return np.empty(0, np.uint64)
        if len(found) < self.words:
            return np.array([xxhash.xxh3_64_intdigest(b" ".join(found))], np.uint64)
        # a word is hashed faster than it is looked up, and nothing is remembered
        hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found))
        count = len(hashes) - self.words + 1
        total = hashes[:count] * self.factors[0]
        for i in range(1, self.words):
            total += hashes[i : count + i] * self.factors[i]
        total = _mixed(total)
        total.sort()
        return total[np.concatenate([[True], total[1:] != total[:-1]])]


class Bands:
    """Sizes that may link, and the blocks of each band, for a similarity of part / whole."""

    def __init__(self, part: int, whole: int):
        self.part, self.whole = part, whole
        self.firsts = [1, 2]
        self._extend(1 << 16)

    def _extend(self, size: int) -> None:
        while self.firsts[-1] <= size:
            last = self.firsts[-1]
            self.firsts.append(max(last + 1, (last - 1) * self.whole // self.part + 1))
        self.edges = np.array(self.firsts)

    def of(self, size: int) -> int:
        if size >= self.firsts[-1]:
            self._extend(size)
        return int(np.searchsorted(self.edges, size, "right")) - 1

    @lru_cache(maxsize=None)  # noqa: B019
    def plan(self, band: int) -> tuple[int, int, int]:
        """(blocks, q, c): blocks are d + q, and poor with at most c shingles."""
        while band + 1 >= len(self.firsts):
            self._extend(2 * self.firsts[-1])
        largest, smallest = self.firsts[band + 1] - 1, self.firsts[max(0, band - 1)]
        d = 2 * largest * (self.whole - self.part) // (self.whole + self.part)
        for poor, most in ((1, 1.3 * d), (0, 1.5 * d + 2)):
            q = 1
            while d + q <= most + 1:
                mean = smallest / (d + q)
                expected = (d + q) * math.exp(-mean) * (1 + mean * poor)
                need = 1 + math.ceil(expected + 2 * math.sqrt(expected))
                if need <= q:
                    return d + q, q, poor
                q = need
        return d + 1, 1, 0

    def keys(self, hashes: np.ndarray) -> np.ndarray:
        """The join keys of a set, for its own band and the next one."""
        if not len(hashes):
            return np.empty(0, np.int64)
        own = self.of(len(hashes))
        out = []
        # hashes are sorted, so the blocks of their upper bits are runs
        upper, mixed = hashes >> np.uint64(32), _mixed(hashes)
        for band in (own, own + 1):
            blocks, q, poor = self.plan(band)
            place = (upper * np.uint64(blocks)) >> np.uint64(32)
            starts = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
            sketch = np.bitwise_xor.reduceat(mixed, starts)
            block = place[starts]
            filled = np.diff(np.append(starts, len(place)))
            rich = filled > poor
            if blocks - int(rich.sum()) >= q:
                missing = np.setdiff1d(np.arange(blocks, dtype=np.uint64), block, assume_unique=True)
                block = np.concatenate([block, missing])
                sketch = np.concatenate([sketch, np.zeros(len(missing), np.uint64)])
            else:
                block, sketch = block[rich], sketch[rich]
            out.append(_mixed(sketch ^ _mixed(block + np.uint64(band + 1 << 40))))
        return np.concatenate(out).view(np.int64)


def _signature(hashes: np.ndarray) -> tuple[int, int]:
    """Two numbers that equal sets share."""
    mixed = _mixed(hashes)
    return int(np.bitwise_xor.reduce(mixed).view(np.int64)), int(_mixed(mixed + np.uint64(1)).sum().view(np.int64))


def _bits(hashes: np.ndarray) -> np.ndarray:
    """The parity of the shingles at each place of the sketch, in words of 64."""
    size = min(max(SKETCH_BITS, 1 << max(0, len(hashes) - 1).bit_length()), MOST_SKETCH_BITS)
    places = np.bincount((hashes & np.uint64(size - 1)).astype(np.int64), minlength=size) & 1
    return np.packbits(places.astype(np.uint8)).view(np.int64)


def _folded_rows(bits: pa.ListArray) -> np.ndarray:
    """Sketches of sets as rows, all folded to the size of the smallest."""
    # numpy counts the bits of a signed number's absolute value
    sizes, flat = bits.value_lengths().to_numpy(), bits.flatten().to_numpy().view(np.uint64)
    starts, least = np.cumsum(sizes) - sizes, sizes.min()
    out = np.empty((len(sizes), least), flat.dtype)
    for size in np.unique(sizes):
        which = np.flatnonzero(sizes == size)
        rows = flat[starts[which][:, None] + np.arange(size)]
        out[which] = np.bitwise_xor.reduce(rows.reshape(len(which), size // least, least), axis=1)
    return out


PRINT = "doc_id bigint, n bigint, s1 bigint, s2 bigint, bits array<bigint>, keys array<bigint>"
_PRINT = pa.schema(
    [("doc_id", pa.int64()), ("n", pa.int64()), ("s1", pa.int64()), ("s2", pa.int64()), ("bits", pa.list_(pa.int64())), ("keys", pa.list_(pa.int64()))]
)


def prints(docs: DataFrame, words: int, part: int, whole: int) -> DataFrame:
    """One row per row: size and signature of the set, bit sketch, join keys.

    Of equal sets in a task only the first sends keys; the others are found by signature. A row
    without id, which links with nothing, sends none.
    """
    prepare_workers(docs.sparkSession)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, bands = Shingles(words), Bands(part, whole)
        seen: set[int] = set()
        for batch in batches:
            rows: tuple[list, ...] = ([], [], [], [], [])
            for known, text in zip(batch.column(0).is_valid().to_pylist(), batch.column(1), strict=True):
                hashes = shingles.of(text.as_py())
                first, second = _signature(hashes) if len(hashes) else (0, 0)
                keys = bands.keys(hashes) if known and first not in seen else np.empty(0, np.int64)
                if len(seen) >= COPIES:
                    seen.clear()
                if known:
                    seen.add(first)
                for column, value in zip(rows, (len(hashes), first, second, _bits(hashes), keys), strict=True):
                    column.append(value)
            columns = [batch.column(0)] + [pa.array(c, f.type) for c, f in zip(rows, list(_PRINT)[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(columns, schema=_PRINT)

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(make, PRINT)


def _folded(bits: Column, words: Column) -> Column:
    """A sketch folded to so many words, if it has more."""

    def word(place: Column) -> Column:
        places = F.sequence(place, F.size(bits) - 1, words)
        return F.aggregate(places, F.lit(0).cast("bigint"), lambda total, i: total.bitwiseXOR(F.get(bits, i)))

    return F.when(F.size(bits) > words, F.transform(F.sequence(F.lit(0), words - 1), word)).otherwise(bits)


def _distance(a: Column, b: Column) -> Column:
    words = F.least(F.size(a), F.size(b))
    differing = F.zip_with(_folded(a, words), _folded(b, words), lambda x, y: F.bit_count(x.bitwiseXOR(y)).cast("int"))
    return F.aggregate(differing, F.lit(0), lambda total, x: total + x)


def _plausible(pairs: DataFrame, classes: DataFrame, part: int, whole: int) -> DataFrame:
    """Pairs (a, b) whose sizes and bit sketches allow a link."""
    side = classes.select("rep", "n", "bits")
    both = pairs.join(side.select(F.col("rep").alias("a"), F.col("n").alias("na"), F.col("bits").alias("ba")), "a")
    both = both.join(side.select(F.col("rep").alias("b"), F.col("n").alias("nb"), F.col("bits").alias("bb")), "b")
    sizes = whole * F.least("na", "nb") >= part * F.greatest("na", "nb")
    bound = (F.col("na") + F.col("nb")) * (whole - part)
    close = _distance(F.col("ba"), F.col("bb")) * (whole + part) <= bound
    return both.where(sizes & close).select("a", "b")


def verify(pairs: DataFrame, docs: DataFrame, words: int, part: int, whole: int) -> DataFrame:
    """The pairs (a, b) that link, decided on the whole sets.

    Texts go to the groups of their hub ``b``, of ``GROUP`` members each; a task reads them in
    order and holds one hub and one member.
    """
    counts = pairs.groupBy("b").agg(F.ceil(F.count(F.lit(1)) / GROUP).cast("int").alias("_groups"))
    chunked = pairs.join(counts, "b").withColumn("_group", F.pmod(F.xxhash64("a"), F.col("_groups")).cast("int"))
    members = chunked.select(F.col("a").alias("doc_id"), F.col("b").alias("_hub"), "_group", F.lit(1).alias("_role"))
    hubs = counts.select(F.col("b").alias("doc_id"), F.col("b").alias("_hub"), F.explode(F.sequence(F.lit(0), F.col("_groups") - 1)).alias("_group"), F.lit(0).alias("_role"))
    wanted = stored(members.union(hubs))
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").where("text IS NOT NULL")
    sent = id_filter(texts, wanted)[0].join(wanted, "doc_id")
    ordered = sent.repartition("_hub", "_group").sortWithinPartitions("_hub", "_group", "_role", "doc_id")
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles(words)
        group, hubs = None, []
        for batch in batches:
            found: tuple[list, list] = ([], [])
            numbers = zip(*(batch.column(i).to_pylist() for i in (0, 2, 3, 4)), strict=True)
            for (doc_id, hub, chunk, role), text in zip(numbers, batch.column(1), strict=True):
                if (hub, chunk) != group:
                    group, hubs = (hub, chunk), []
                own = shingles.of(text.as_py())
                if not role:
                    hubs.append(own)
                    continue
                for other in hubs:
                    common = len(np.intersect1d(own, other, assume_unique=True))
                    if len(own) and whole * common >= part * (len(own) + len(other) - common):
                        found[0].append(doc_id)
                        found[1].append(hub)
                        break
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in found], schema=schema)

    return ordered.select("doc_id", "text", "_hub", "_group", "_role").mapInArrow(check, "a bigint, b bigint")


def _buckets(rows: DataFrame) -> DataFrame:
    """(doc_id, keys, weight): the buckets of each document that others share, one row each.

    Near copies share most of their buckets with the same others. A bucket is therefore named
    by its members, so those with equal members are one; should two names meet, their members
    are compared in vain and nothing is lost. ``weight`` is the number of members of all
    buckets together.
    """
    keyed = rows.select(F.explode("keys").alias("key"), "doc_id")
    same = Window.partitionBy("key")
    members = F.xxhash64(F.bit_xor(F.xxhash64("doc_id")).over(same), F.col("size"))
    sized = keyed.withColumn("size", F.count(F.lit(1)).over(same)).withColumn("members", members).where("size > 1")
    return sized.groupBy("doc_id").agg(F.collect_set("members").alias("keys"), F.sum("size").alias("weight"))


def _stars(buckets: DataFrame) -> DataFrame:
    """Distinct pairs (x, hub) of a bucket's members and its most central one.

    Central is who meets the most others over all its buckets: of near copies of one text the
    text itself, and all find the same one.
    """
    members = buckets.select(F.explode("keys").alias("key"), "doc_id", "weight")
    heaviest = F.max(F.struct("weight", "doc_id")).over(Window.partitionBy("key"))["doc_id"]
    hubs = members.withColumn("hub", heaviest).where(F.col("doc_id") != F.col("hub"))
    return hubs.select(F.col("doc_id").alias("x"), F.col("hub").alias("y")).distinct()


def _between_classes(pairs: DataFrame, named: DataFrame) -> DataFrame:
    """Pairs of documents as distinct pairs a > b of their classes."""
    left = named.select(F.col("doc_id").alias("x"), F.col("rep").alias("rx"))
    right = named.select(F.col("doc_id").alias("y"), F.col("rep").alias("ry"))
    moved = pairs.join(left, "x").join(right, "y").where(F.col("rx") != F.col("ry"))
    return moved.select(F.greatest("rx", "ry").alias("a"), F.least("rx", "ry").alias("b")).distinct()


def _across(buckets: DataFrame, labels: DataFrame, classes: DataFrame, part: int, whole: int) -> DataFrame:
    """Distinct pairs a > b which share a bucket, carry different labels, and may link.

    Members of a bucket are dealt to chunks of about ``CHUNK``, and each pair of chunks is one
    group, so a task holds two chunks. Only pairs that pass the bounds leave the group.
    """
    placed = buckets.join(labels.select("doc_id", "rep", "label"), "doc_id").select(F.explode("keys").alias("key"), "rep", "label")
    bucket = Window.partitionBy("key")
    spans = placed.withColumns(
        {
            "least": F.min("label").over(bucket), "most": F.max("label").over(bucket),
            "chunks": F.ceil(F.count(F.lit(1)).over(bucket) / CHUNK).cast("int"),
        }
    )
    mixed = spans.where(F.col("least") < F.col("most")).select("key", "rep", "label", "chunks").distinct()
    members = mixed.join(classes.select("rep", "n", "bits"), "rep")
    own = F.pmod(F.xxhash64("rep"), F.col("chunks")).cast("int")
    members = members.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    members = members.withColumns({"first": F.least("own", "other"), "second": F.greatest("own", "other")})
    group = ["key", "first", "second"]
    ordered = members.repartition(*group).sortWithinPartitions(*group).select(*group, "own", "rep", "label", "n", "bits")
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: set[tuple[int, int]] = set()
        for own, rep, label, n, bits in _groups(batches, 3):
            found: tuple[list, list] = ([], [])
            one_chunk = (own == own[0]).all()
            for i in range(len(rep)):
                # each pair once: inside a chunk with those behind, across chunks from the lower one
                others = slice(i + 1, None) if one_chunk else own > own[i]
                far = label[others] != label[i]
                if not far.any():
                    continue
                sizes, which = n[others][far], rep[others][far]
                fits = (whole * np.minimum(sizes, n[i]) >= part * np.maximum(sizes, n[i])).nonzero()[0]
                apart = np.bitwise_count(bits[others][far][fits] ^ bits[i]).sum(axis=1, dtype=np.int64)
                close = apart * (whole + part) <= (sizes[fits] + n[i]) * (whole - part)
                for j in which[fits[close]].tolist():
                    pair = (max(j, int(rep[i])), min(j, int(rep[i])))
                    if pair not in known:
                        known.add(pair)
                        found[0].append(pair[0])
                        found[1].append(pair[1])
            if len(known) > COPIES:
                known.clear()
            if found[0]:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in found], schema=schema)

    return ordered.mapInArrow(compare, "a bigint, b bigint").distinct()


def _groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Columns behind the keys, for each run of equal keys; a run may go over batches."""
    held: list[pa.RecordBatch] = []
    last: tuple | None = None

    def columns() -> tuple[np.ndarray, ...]:
        whole = pa.Table.from_batches(held)
        flat = [whole.column(i).to_numpy() for i in range(keys, whole.num_columns - 1)]
        return (*flat, _folded_rows(whole.column(whole.num_columns - 1).combine_chunks()))

    for batch in batches:
        if not batch.num_rows:
            continue
        values = [batch.column(i).to_numpy() for i in range(keys)]
        changes = np.zeros(batch.num_rows, bool)
        for value in values:
            changes[1:] |= value[1:] != value[:-1]
        starts = [0, *np.flatnonzero(changes).tolist(), batch.num_rows]
        for at, end in zip(starts, starts[1:], strict=False):
            key = tuple(int(v[at]) for v in values)
            if last is not None and key != last:
                yield columns()
                held = []
            held.append(batch.slice(at, end - at))
            last = key
    if held:
        yield columns()


def near_duplicates(docs: DataFrame, words: int = 5, part: int = 80, whole: int = 100) -> DataFrame:
    """doc_id, n_shingles, component_id for every row of ``docs``.

    Two texts link when whole * |intersection| >= part * |union| of their shingle sets.
    """
    rows = stored(prints(docs, words, part, whole))
    some = rows.where("n > 0 AND doc_id IS NOT NULL")
    classes = stored(some.groupBy("n", "s1", "s2").agg(F.min("doc_id").alias("rep"), F.min("bits").alias("bits")))
    named = some.select("doc_id", "n", "s1", "s2").join(classes.select("n", "s1", "s2", "rep"), ["n", "s1", "s2"])
    named = stored(named.select("doc_id", "rep").distinct())
    # a document with several texts joins the classes of all of them
    own = named.where(F.col("doc_id") != F.col("rep")).select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    several = named.groupBy("doc_id").agg(F.max("rep").alias("a"), F.min("rep").alias("b")).where(F.col("a") != F.col("b"))
    buckets = stored(_buckets(some))
    stars = stored(_plausible(_between_classes(_stars(buckets), named), classes, part, whole))
    links = stored(verify(stars, docs, words, part, whole)).union(several.select("a", "b"))
    joined = stored(components(links))
    # buckets that hold several components still: compare across them
    label = F.coalesce("component", "rep").alias("label")
    labels = named.join(joined, named["rep"] == joined["node"], "left").select("doc_id", "rep", label)
    untested = stored(_across(buckets, labels, classes, part, whole).join(stars, ["a", "b"], "left_anti"))
    late = stored(verify(untested, docs, words, part, whole))
    final = components(links.union(late).union(own))
    found = rows.select("doc_id", "n").join(final, rows["doc_id"] == final["node"], "left")
    component = F.when(F.col("n") > 0, F.coalesce("component", "doc_id")).otherwise(F.col("doc_id"))
    return found.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))
