"""Similar documents by the Jaccard index of their n-grams: a prefix-tree join."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from hazeline.llm import arrays
from hazeline.llm.components import components
from hazeline.llm.exchange import (
    BLOCK_BYTES, BUCKET_BYTES, NO_ID, PACKED, Layout, blocked, cuts, delta, layout, ordered, pack, unpack,
)
from hazeline.llm.tables import stored, unused

#: Words of a shingle, and the share of the union, in hundredths, that makes two documents alike.
WORDS = 5
PERCENT = 80
#: Shingles that one cell of the join holds per side, and that a task gets at a time.
CELL = 1 << 20
#: Numbers of common shingles, one per pair of sets, that are held at once.
PAIRS = 1 << 22
#: A shingle that one in so many sets of a cell has is counted by a product of matrices, others by lists of their sets.
DENSE = 8
U = np.uint64


def shingles(texts: list[bytes], words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of each text as sorted 64-bit hashes, and where each text starts.

    Words are in ASCII lower case. A text with fewer words has one shingle, of them all.
    """
    data = np.frombuffer(b"".join(texts), np.uint8)
    offsets = np.cumsum([0, *map(len, texts)])
    word, _, _, of = arrays.hashed_words(data, offsets)
    del data
    begins = np.searchsorted(of, np.arange(len(texts) + 1))
    found = []
    for first, last in zip(begins.tolist(), begins[1:].tolist()):
        n, own = last - first, word[first:last]
        total = np.zeros(max(min(n, 1), n - words + 1), U)
        if 0 < n < words:
            total += U(n)
        for at in range(min(n, words)):
            total *= U(0x100000001B3)
            total += own[at : at + len(total)]
        found.append(np.unique(arrays.mixed(total)))
    sizes = np.cumsum([0, *map(len, found)])
    return np.concatenate([np.zeros(0, U), *found]), sizes.astype(np.int64)


def needed(one: int, other: int, percent: int) -> int:
    """Common shingles that make sets of these sizes alike."""
    return -(-percent * (one + other) // (100 + percent))


def set_hash(keys: np.ndarray) -> int:
    """A hash of a set of shingles, as a signed integer."""
    with np.errstate(over="ignore"):
        total = np.bitwise_xor.reduce(keys) * U(3) + arrays.mixed(keys).sum(dtype=U) + U(len(keys))
    return int(arrays.mixed(np.array([total], U)).view(np.int64)[0])


class Block:
    """The sets of a block's documents, in a fixed order."""

    def __init__(self, table: pa.Table, words: int):
        self.order, rows = ordered(table)
        self.ids = [number for number, _ in rows]
        self.keys, self.begins = shingles([text.encode() for _, text in rows], words)

    def sets(self) -> Iterator[tuple[int, np.ndarray]]:
        for at, number in enumerate(self.ids):
            yield number, self.keys[self.begins[at] : self.begins[at + 1]]

    def chosen(self, own: pa.Table) -> list[tuple[int, np.ndarray]]:
        """The sets that this block stands for, by hash."""
        wanted = {node for node in own.column("node").to_pylist() if node is not None}
        found = {}
        for _, keys in self.sets():
            if len(keys) and (node := set_hash(keys)) in wanted:
                found.setdefault(node, keys)
        return sorted(found.items(), key=lambda item: item[0])


def _distinct(sets: list[tuple[int, np.ndarray]], bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles of a block, cut to the bits of the bucket and 32 more, with their number of sets."""
    keys = np.concatenate([np.zeros(0, U), *(keys for _, keys in sets)]) >> U(32 - bits)
    return np.unique(keys, return_counts=True)


def _packed(block: int, sets: list[tuple[int, np.ndarray]], bits: int) -> pa.Table:
    keys, counts = _distinct(sets, bits)
    rows = [
        (bucket, pack(delta((keys[a:b] & U(0xFFFFFFFF)).astype(np.uint32)), counts[a:b].astype(np.uint32)))
        for bucket, a, b in cuts(keys << U(32 - bits), bits)
    ]
    return pa.table(
        {
            "bucket": pa.array([bucket for bucket, _ in rows], pa.int64()),
            "block": pa.array([block] * len(rows), pa.int32()),
            "packed": pa.array([packed for _, packed in rows], pa.binary()),
        }
    )


def _count(key: tuple, table: pa.Table) -> pa.Table:
    """Tell each block how many sets of all blocks have each of its shingles."""
    blocks = table.column("block").to_pylist()
    parts = [unpack(packed, ("u4", "u4")) for packed in table.column("packed").to_pylist()]
    keys = np.concatenate([np.cumsum(part[0], dtype=np.uint32) for part in parts])
    _, entry = np.unique(keys, return_inverse=True)
    totals = np.bincount(entry, np.concatenate([part[1] for part in parts])).astype(np.uint32)[entry]
    begins = np.cumsum([0, *(len(part[0]) for part in parts)])
    return pa.table(
        {
            "bucket": pa.array([key[0].as_py()] * len(blocks), pa.int64()),
            "block": pa.array(blocks, pa.int32()),
            "packed": pa.array([pack(totals[a:b]) for a, b in zip(begins, begins[1:], strict=False)], pa.binary()),
        }
    )


def _candidates(sets: list[tuple[int, np.ndarray]], replies: pa.Table, bits: int, percent: int) -> pa.Table:
    """Sets that may be like another one, with the shingles they would share.

    In the order of number of sets with a shingle and then of its hash, two sets that are alike
    share one of the first ``n - needed + 1`` of their shingles. A shingle of one set is shared
    with none, so a set whose first shingles are all its own is like no other.
    """
    keys, _ = _distinct(sets, bits)
    frequency = np.ones(len(keys), np.uint32)
    starts = {bucket: (a, b) for bucket, a, b in cuts(keys << U(32 - bits), bits)}
    for bucket, packed in zip(replies.column("bucket").to_pylist(), replies.column("packed").to_pylist(), strict=True):
        if packed is not None:
            a, b = starts[bucket]
            frequency[a:b] = unpack(packed, ("u4",))[0]
    nodes, sizes, prefixes, kept = [], [], [], []
    for node, own in sets:
        often = frequency[np.searchsorted(keys, own >> U(32 - bits))]
        first = len(own) - -(-percent * len(own) // 100) + 1
        if int((often == 1).sum()) >= first:
            continue
        order = np.lexsort((own, often))[:first]
        prefix = own[order][often[order] > 1]
        nodes.append(node)
        sizes.append(len(own))
        prefixes.append(prefix.view(np.int64))
        kept.append(own.tobytes())
    return pa.table(
        {
            "node": pa.array(nodes, pa.int64()),
            "n": pa.array(sizes, pa.int64()),
            "prefix": pa.array(prefixes, pa.list_(pa.int64())),
            "keys": pa.array(kept, pa.binary()),
        }
    )


class Tree:
    """Sets as a compressed prefix tree, most frequent shingles first, so that like sets share paths.

    A node has the shingles that its sets have in common beyond its parent's, its children, the
    sets that end there, sizes of the smallest and largest set below, the longest path below, and
    how many sets below are still to be found.
    """

    def __init__(self, sets: list[np.ndarray]):
        values, which, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        rank = np.empty(len(values), np.int64)
        rank[np.argsort(-counts, kind="stable")] = np.arange(len(values))
        shared = counts > 1
        self.width = int(shared.sum())
        ends = np.cumsum([len(own) for own in sets])
        self.sizes = [len(own) for own in sets]
        self.ranks = []
        for own in np.split(which, ends[:-1]):
            self.ranks.append(np.sort(rank[own[shared[own]]]))
        order = sorted(range(len(sets)), key=lambda at: self.ranks[at].astype(">u4").tobytes())
        lcp = [0]
        for one, other in zip(order, order[1:], strict=False):
            a, b = self.ranks[one], self.ranks[other]
            n = min(len(a), len(b))
            differ = np.flatnonzero(a[:n] != b[:n])
            lcp.append(int(differ[0]) if len(differ) else n)
        self.segments: list[np.ndarray] = []
        self.children: list[list[int]] = []
        self.ending: list[list[int]] = []
        self.parents: list[int] = []
        self.home = [0] * len(sets)
        waiting = [(0, len(order), 0, -1)]
        while waiting:
            low, high, depth, parent = waiting.pop()
            number = len(self.segments)
            first = self.ranks[order[low]]
            common = len(first) if high - low == 1 else min(lcp[low + 1 : high])
            self.segments.append(first[depth:common])
            self.children.append([])
            self.ending.append([])
            self.parents.append(parent)
            if parent >= 0:
                self.children[parent].append(number)
            start = low
            for at in range(low + 1, high + 1):
                if at == high or lcp[at] == common:
                    if at - start == 1 and len(self.ranks[order[start]]) == common:
                        self.ending[number].append(order[start])
                        self.home[order[start]] = number
                    else:
                        waiting.append((start, at, common, number))
                    start = at
        count = len(self.segments)
        self.least, self.most = [1 << 60] * count, [0] * count
        self.longest, self.open = [0] * count, [0] * count
        for number in reversed(range(count)):
            for own in self.ending[number]:
                self.least[number] = min(self.least[number], self.sizes[own])
                self.most[number] = max(self.most[number], self.sizes[own])
            self.open[number] += len(self.ending[number])
            parent = self.parents[number]
            if parent >= 0:
                self.least[parent] = min(self.least[parent], self.least[number])
                self.most[parent] = max(self.most[parent], self.most[number])
                self.longest[parent] = max(self.longest[parent], self.longest[number] + len(self.segments[number]))
                self.open[parent] += self.open[number]

    def remove(self, own: int) -> None:
        """A set that is found is not looked for again."""
        at = self.home[own]
        self.ending[at].remove(own)
        while at >= 0:
            self.open[at] -= 1
            at = self.parents[at]

    def alike(self, probe: int, percent: int) -> list[int]:
        """The sets still to be found that are like one.

        The overlap with a path counts for all sets below it. A subtree is left if no set in it
        is of a size that fits, or if even all that is left of the probe and of the longest path
        in it would not be enough.
        """
        size, ranks = self.sizes[probe], self.ranks[probe]
        mask = np.zeros(self.width + 1, np.int64)
        mask[ranks] = 1
        left = len(ranks) - np.cumsum(mask)
        smallest, largest = -(-percent * size // 100), 100 * size // percent
        found, waiting = [], [(0, 0, len(ranks))]
        while waiting:
            number, overlap, rest = waiting.pop()
            if not self.open[number] or self.most[number] < smallest or self.least[number] > largest:
                continue
            segment = self.segments[number]
            if len(segment):
                overlap += int(mask[segment].sum())
                rest = int(left[segment[-1]])
            if overlap + min(rest, self.longest[number]) < needed(size, max(smallest, self.least[number]), percent):
                continue
            found += [own for own in self.ending[number] if overlap >= needed(size, self.sizes[own], percent)]
            waiting += [(child, overlap, rest) for child in self.children[number]]
        return found


def forest(nodes: list[int], sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links enough to connect all sets that links connect.

    Each set is asked once which of those not yet found are like it; these are found, so that a
    group of like sets costs about a visit per set rather than per pair.
    """
    links = []
    if len(sets) == 2:
        common = len(np.intersect1d(*sets, assume_unique=True))
        return [(nodes[0], nodes[1])] if common >= needed(*map(len, sets), percent) else []
    tree = Tree(sets)
    seen = [False] * len(sets)
    for start in range(len(sets)):
        if seen[start]:
            continue
        seen[start] = True
        tree.remove(start)
        waiting = [start]
        while waiting:
            probe = waiting.pop()
            for other in tree.alike(probe, percent):
                seen[other] = True
                tree.remove(other)
                waiting.append(other)
                links.append((nodes[probe], nodes[other]))
    return links


def numbers(sets: list[np.ndarray], groups: np.ndarray, inner: tuple[int, ...], percent: int) -> np.ndarray:
    """Of all links between sets, the number that each set has with larger ones, or later equal ones.

    Links within one of the ``groups`` count only if that is in ``inner``. Every pair of sizes that
    fit is counted: common shingles are summed up, without a step per pair, in steps of a bounded
    number of pairs.
    """
    sizes = np.array([len(own) for own in sets])
    order = np.argsort(sizes, kind="stable")
    sizes, groups, m = sizes[order], groups[order], len(sets)
    _, which, often = np.unique(np.concatenate([sets[at] for at in order]), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(m), sizes)
    dense, light = often * DENSE >= m, (often > 1) & (often * DENSE < m)
    table = np.zeros((m, int(dense.sum())), np.float32)
    some = dense[which]
    table[owner[some], (np.cumsum(dense) - 1)[which[some]]] = 1
    some = np.flatnonzero(light[which])
    by_key = some[np.argsort(which[some], kind="stable")]
    begins = np.searchsorted(which[by_key], np.arange(len(often) + 1))
    lists, keys, key_of = owner[by_key], which[some], np.searchsorted(owner[some], np.arange(m + 1))
    ends = np.searchsorted(sizes, 100 * sizes // percent, "right")
    counted = np.isin(groups, inner)
    cost = np.cumsum(ends - np.arange(m) + np.bincount(owner[some], often[keys], m).astype(np.int64))
    found, start = np.zeros(m, np.int64), 0
    while start < m:
        done = int(cost[start - 1]) if start else 0
        end = max(start + 1, int(np.searchsorted(cost, done + PAIRS, "right")))
        end = min(end, start + max(1, PAIRS // (int(ends[end - 1]) - start)))
        last = int(ends[end - 1])
        common = table[start:end] @ table[start:last].T
        own = keys[key_of[start] : key_of[end]]
        if len(own):
            n = begins[own + 1] - begins[own]
            rows = np.repeat(np.repeat(np.arange(end - start), np.diff(key_of[start : end + 1])), n)
            others = lists[arrays.ranges(begins[own], n)] - start
            fits = (others >= 0) & (others < last - start)
            at = rows[fits] * (last - start) + others[fits]
            common += np.bincount(at, minlength=common.size).reshape(common.shape)
        one, other = np.arange(start, end)[:, None], np.arange(start, last)[None, :]
        alike = common.astype(np.int64) * (100 + percent) >= percent * (sizes[one] + sizes[other])
        alike &= (other > one) & ((groups[one] != groups[other]) | counted[one])
        found[start:end] = alike.sum(axis=1)
        start = end
    result = np.empty(m, np.int64)
    result[order] = found
    return result


def _cells(percent: int, counting: bool):
    """Links of each cell; when ``counting``, also rows that link a set with itself and say of how many
    links of the cell it is the first end. Links within a part are counted in the part's first cell."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        cells: dict[tuple, tuple[list, list, list]] = {}
        for cell, low, high, part, node, keys in zip(
            *(table.column(name).to_pylist() for name in ("cell", "low", "high", "part", "node", "keys")), strict=True
        ):
            nodes, sets, parts = cells.setdefault((cell, low, high), ([], [], []))
            nodes.append(node)
            sets.append(np.frombuffer(keys, U))
            parts.append(part)
        rows: list[tuple[int, int, int]] = []
        for cell in sorted(cells):
            nodes, sets, parts = cells[cell]
            if len(nodes) < 2:
                continue
            links = forest(nodes, sets, percent)
            rows += [(a, b, 0) for a, b in links]
            if counting and links:
                _, low, high = cell
                inner = (low, high) if high <= 1 else (high,) if low == 0 else ()
                found = numbers(sets, np.array(parts), inner, percent)
                rows += [(nodes[at], nodes[at], int(found[at])) for at in np.flatnonzero(found)]
        columns = zip(*rows, strict=True) if rows else ([], [], [])
        return pa.table({name: pa.array(column, pa.int64()) for name, column in zip("abn", columns, strict=True)})

    return run


def _grouped(
    docs: DataFrame, rows: DataFrame, plan: Layout, words: int, percent: int, counting: bool = False
) -> tuple[DataFrame, DataFrame]:
    """``block, at, id, n, component`` of each row: its place, shingles and group, null without any;
    and when ``counting``, ``component, n_links`` of each group with links.

    Steps: blocks count in how many classes each shingle is; classes whose rarest shingles are
    shared become candidates; candidates that share one of these come together, each in one
    group, or if that is too large for a task in cells of two parts of it; a prefix tree per
    cell finds links, as many as connect what is alike; when counting, all are counted. Sets and shingles are known by 64-bit
    hashes, which are taken for them.
    """
    bits = plan.bits

    def measured(key: tuple, table: pa.Table) -> pa.Table:
        found = [(number, len(keys), set_hash(keys) if len(keys) else None) for number, keys in Block(table, words).sets()]
        return pa.table(
            {
                "block": pa.array([key[0].as_py()] * len(found), pa.int32()),
                "at": pa.array(range(len(found)), pa.int32()),
                "id": pa.array([row[0] for row in found], pa.int64()),
                "n": pa.array([row[1] for row in found], pa.int64()),
                "node": pa.array([row[2] for row in found], pa.int64()),
            }
        )

    schema = "block int, at int, id long, n long, node long"
    sized = stored(rows.groupBy("block").applyInArrow(measured, schema), "sizes")
    classes = sized.filter("node IS NOT NULL").groupBy("node").agg(F.min("block").alias("block"))
    own = classes.select("block", "node")

    def keys(key: tuple, table: pa.Table, mine: pa.Table) -> pa.Table:
        sets = Block(table, words).chosen(mine) if table.num_rows and mine.num_rows else []
        return _packed(key[0].as_py(), sets, bits)

    def chosen(key: tuple, table: pa.Table, mine: pa.Table) -> pa.Table:
        sets = Block(table, words).chosen(mine) if table.num_rows and mine.num_rows else []
        return _candidates(sets, mine, bits, percent)

    counted = (
        rows.groupBy("block").cogroup(own.groupBy("block")).applyInArrow(keys, PACKED)
        .groupBy("bucket").applyInArrow(_count, PACKED)
    )
    empty = [F.lit(None).cast(kind).alias(name) for kind, name in (("long", "bucket"), ("binary", "packed"))]
    told = own.select("block", "node", *empty).unionByName(
        counted.select("block", F.lit(None).cast("long").alias("node"), "bucket", "packed")
    )
    candidates = stored(
        rows.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(
            chosen, "node long, n long, prefix array<long>, keys binary"
        ),
        "candidates",
    )
    links = stored(_linked(candidates, percent, counting), "links")
    linked = components(links)
    of = stored(linked, "components") if counting else linked
    counts = (
        links.filter("n > 0").select(F.col("a").alias("node"), F.col("n").alias("links"))
        .join(of, "node").groupBy("component").agg(F.sum("links").alias("n_links"))
    )
    return sized.join(of, "node", "left").select(
        "block", "at", "id", "n", F.coalesce("component", "node").alias("component")
    ), counts


def similar(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT,
    links: bool = False, block_bytes: int = BLOCK_BYTES, bucket_bytes: int = BUCKET_BYTES,
) -> DataFrame:
    """``id, n_shingles, component_id`` of each row of ``docs``, and with ``links`` also ``n_links``.

    Rows are linked if the common shingles of their sets are at least ``percent`` hundredths of
    all; ``component_id`` is the smallest id that links reach. Equal sets are one class and
    compared once; ``n_links`` is the number of links between different sets of the row's group, all of
    them, 0 in a group of one set. Null and empty texts, and those without words, have no shingles and no links.
    A row without an id takes part; its id and, if all it reaches have none, its component are
    null. Rows with equal ids are compared as others are.
    """
    plan: Layout = layout(docs, text_col, block_bytes, bucket_bytes)
    grouped, counts = _grouped(docs, blocked(docs, plan, id_col, text_col), plan, words, percent, links)
    labels = grouped.filter("component IS NOT NULL").groupBy("component").agg(F.min("id").alias("label"))
    if links:
        labels = labels.join(counts, "component", "left")
    # Stored, so that both sides of the join are dealt anew and a large group can be split.
    labels = stored(labels, "labels")
    label = F.coalesce("label", "id")
    return grouped.join(labels, "component", "left").select(
        F.when(F.col("id") != NO_ID, F.col("id")).alias(id_col),
        F.col("n").alias("n_shingles"),
        F.when(label != NO_ID, label).alias("component_id"),
        *([F.coalesce("n_links", F.lit(0)).alias("n_links")] if links else []),
    )


def representatives(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT,
    block_bytes: int = BLOCK_BYTES, bucket_bytes: int = BUCKET_BYTES,
) -> DataFrame:
    """One row of ``docs`` per group of ``similar``, with the smallest id, as it was.

    Rows without shingles are alike to none and all stay. Of equal rows one stays.
    """
    plan: Layout = layout(docs, text_col, block_bytes, bucket_bytes)
    others = [c for c in docs.columns if c != text_col]
    none = unused("_none", docs.columns)
    marked = docs.withColumn(none, F.col(text_col).isNull())
    rows = blocked(marked, plan, id_col, text_col, [*others, none])
    grouped = stored(_grouped(docs, rows, plan, words, percent)[0], "groups")
    place = F.struct("id", "block", "at")
    best = grouped.filter("component IS NOT NULL").groupBy("component").agg(F.min(place).alias("best"))
    stay = best.select("best.block", "best.at").unionByName(grouped.filter("component IS NULL").select("block", "at"))

    def kept(key: tuple, table: pa.Table, mine: pa.Table) -> pa.Table:
        order, _ = ordered(table)
        at = pa.array(sorted(order[number] for number in mine.column("at").to_pylist()), pa.int64())
        return table.select(["text", "row"]).take(at)

    schema = StructType([StructField("text", StringType()), rows.schema["row"]])
    found = rows.groupBy("block").cogroup(stay.groupBy("block")).applyInArrow(kept, schema)
    text = F.when(~F.col("row")[none], F.col("text"))
    return found.select(*[text.alias(c) if c == text_col else F.col("row")[c].alias(c) for c in docs.columns])


def _linked(candidates: DataFrame, percent: int, counting: bool) -> DataFrame:
    """Links ``a, b`` between candidates that share a shingle among their rarest, and numbers ``n`` of links."""
    tokens = candidates.select("node", "n", F.explode("prefix").alias("token"))
    least = tokens.groupBy("token").agg(F.min("node").alias("a"), F.max("node").alias("z"))
    near = tokens.join(least.filter("a <> z").drop("z"), "token").select("a", F.col("node").alias("b")).distinct()
    groups = components(near).select("node", F.col("component").alias("cell"))
    parts = (
        candidates.join(groups, "node").groupBy("cell").agg(F.sum("n").alias("all"))
        .select("cell", F.ceil(F.col("all") / CELL).cast("int").alias("parts"), "all")
    )
    total = parts.agg(F.sum(F.col("all") * F.col("parts")).alias("n")).first().n or 0
    tasks = max(1, 4 * int(candidates.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(total / CELL))
    mine = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")
    spread = (
        candidates.select("node", "keys").join(groups, "node").join(parts.drop("all"), "cell")
        .withColumn("part", mine)
        # A part meets each other part in a cell; a group of one part is a cell by itself.
        .withColumn(
            "with",
            F.explode(
                F.when(F.col("parts") == 1, F.array(F.lit(0))).otherwise(
                    F.array_remove(F.sequence(F.lit(0), F.col("parts") - 1), F.col("part"))
                )
            ),
        )
        .select(
            "cell", F.least("part", "with").alias("low"), F.greatest("part", "with").alias("high"), "part", "node", "keys"
        )
        .withColumn("task", F.pmod(F.xxhash64("cell", "low", "high"), F.lit(tasks)).cast("int"))
    )
    return spread.groupBy("task").applyInArrow(_cells(percent, counting), "a long, b long, n long")
