"""SimHash near-duplicates by the generalised pigeonhole principle.

Fingerprints of at most ``MAX_BITS`` differing bits are linked, and documents
that links connect form a group. Only distinct fingerprints are searched; any
number of equal documents is one of them.

Search: the 64 bits are dealt into m parts, correlated bits together. If part i
has threshold t_i (-1: unused) and the t_i + 1 sum to more than the maximum
distance, two linked fingerprints are within t_i bits of each other in some
part. Dynamic programming allots the thresholds, part sizes being unequal, so
that the estimated candidates and probes cost least, and the cheapest m is
taken; the estimates come from bit statistics of all fingerprints. A part with
threshold t is probed with every value within t bits, so both sides meet in a
bucket; every candidate is verified on all 64 bits. The allotment decides only
the cost, never the result.

Within a bucket, links are found by search from one fingerprint to all those
not reached yet, so a dense bucket costs about a pass and emits one row less
than it has fingerprints, never all pairs. A bucket above ``BUCKET`` rows is
dealt anew by parts of its other bits, in other tasks (its linked pairs agree
on one of MAX_BITS + 1 parts), ``LEVELS`` times at most; what is still larger
then is so dense that the search empties it quickly. Groups are the connected
components of the links, by alternating large-star and small-star steps on
written tables.

Defined results: a null, empty or blank text has fingerprint zero and is linked
like any other; repeated documents are equal; a null id has its row, but is no
candidate for the smallest id of a group (a group of null ids has component
null); an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relaymart.sinks.digests import digest
from relaymart.llm.common import forget, map_frames, map_text, written

SHINGLE = 4
SEED = 42
MAX_BITS = 4
BUCKET = 32_768
LEVELS = 3
ALL_BITS = (1 << 64) - 1


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The SimHash of a text's word shingles (repeats count)."""
    ws = [] if text is None else text.encode("utf-8", "surrogatepass").lower().split()
    if not ws:
        return 0
    joined = b" ".join(ws)
    if len(ws) <= shingle:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, ws), np.int64, len(ws)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = len(ws) - shingle + 1
    counts = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, n, 16_384):  # bounded memory for a text of any length
        upto = min(n, at + 16_384)
        spans = zip(starts[at:upto].tolist(), ends[at + shingle - 1:upto + shingle - 1].tolist())
        h = np.array([digest(joined[a:b], SEED) for a, b in spans], "<u8")
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += np.add.reduce(bits, axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id and fp (the fingerprint as a signed long) of every document."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            fps = np.array([fingerprint(t, shingle) for t in frame.pop("text")], np.uint64)
            yield frame.assign(fp=fps.view(np.int64))

    return map_frames(docs.select("doc_id", "text"), "doc_id", run, "doc_id long, fp long")


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def bit_statistics(nodes: DataFrame) -> tuple[int, np.ndarray]:
    """How many fingerprints there are, and how often bits i and j are both 1."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n, both = 0, np.zeros((64, 64))
        for frame in frames:
            fps = np.ascontiguousarray(frame["fp"].to_numpy())
            bits = np.unpackbits(fps.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)
            both += bits.T @ bits
            n += len(frame)
        cell = np.arange(64 * 64)
        yield pd.DataFrame({"cell": np.append(cell, -1), "n": np.append(both.ravel(), n).astype(np.int64)})

    rows = nodes.select("fp").mapInPandas(run, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect()
    total, both = 0, np.zeros(64 * 64)  # 4,097 numbers, whatever the input
    for r in rows:
        if r.cell < 0:
            total = r.n
        else:
            both[r.cell] = r.n
    return total, both.reshape(64, 64)


def group_bits(n: int, both: np.ndarray, parts: int) -> list[list[int]]:
    """Deal the bits into parts: each grows around its first bit by the bit
    most correlated with those it has."""
    p = np.diag(both) / max(n, 1)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-9))
    correlation = np.abs(both / max(n, 1) - np.outer(p, p)) / np.outer(spread, spread)
    left, out = list(range(64)), []
    for k in range(parts):
        size = len(left) // (parts - k)
        part = [left.pop(0)]
        while len(part) < size:
            best = max(left, key=lambda b: (correlation[b, part].mean(), -b))
            left.remove(best)
            part.append(best)
        out.append(sorted(part))
    return out


def _within(differ: np.ndarray, most: int) -> np.ndarray:
    """Chance that at most 0..most of independent bits differ."""
    chance = np.zeros(most + 1)
    chance[0] = 1
    for d in differ:
        chance[1:] = chance[1:] * (1 - d) + chance[:-1] * d
        chance[0] *= 1 - d
    return np.cumsum(chance)


#: Relative costs of a probe row (shuffled and sorted) and of a verification.
PROBE_COST, VERIFY_COST = 1.0, 0.002


def allot(n: int, both: np.ndarray, max_bits: int = MAX_BITS) -> list[tuple[list[int], int]]:
    """The cheapest parts with thresholds: (bits, threshold) of those in use."""
    p = np.diag(both) / max(n, 1)
    best: tuple[float, list[tuple[list[int], int]]] | None = None
    for m in range(2, max_bits + 2):
        parts = group_bits(n, both, m)
        costs = []
        for part in parts:
            near = _within(2 * p[part] * (1 - p[part]), max_bits)
            probes = np.cumsum([math.comb(len(part), t) for t in range(max_bits + 1)])
            costs.append([0.0, *(PROBE_COST * n * (probes + (probes > 1)) + VERIFY_COST * n * n / 2 * near)])
        # table[s]: least cost and thresholds with the (t_i + 1) so far summing to s
        table: dict[int, tuple[float, tuple[int, ...]]] = {0: (0.0, ())}
        for cost in costs:
            longer: dict[int, tuple[float, tuple[int, ...]]] = {}
            for s, (c, ts) in table.items():
                for t in range(-1, max_bits + 1):
                    to = min(s + t + 1, max_bits + 1)
                    new = (c + cost[t + 1], (*ts, t))
                    if to not in longer or new < longer[to]:
                        longer[to] = new
            table = longer
        total, thresholds = table[max_bits + 1]
        if best is None or total < best[0]:
            best = total, [(b, t) for b, t in zip(parts, thresholds) if t >= 0]
    return best[1]


def _mask(bits: list[int]) -> int:
    return sum(1 << b for b in bits)


def _flips(bits: list[int], most: int) -> list[int]:
    """Masks of 1 to ``most`` of the bits."""
    out, last = [], [(0, 0)]
    for _ in range(most):
        last = [(m | 1 << bits[k], k + 1) for m, start in last for k in range(start, len(bits))]
        out += [m for m, _ in last]
    return out


def _probes(nodes: DataFrame, plan: list[tuple[list[int], int]]) -> DataFrame:
    """Buckets of each fingerprint: its own value in a part, and for a
    threshold above 0 every value within it. used: the part's bits."""
    def of_part(i: int, bits: list[int], threshold: int) -> Column:
        mask = F.lit(_signed(_mask(bits)))
        value = F.col("fp").bitwiseAND(mask)
        flips = F.array(*[F.lit(_signed(f)) for f in (0, *_flips(bits, threshold))])
        return F.transform(flips, lambda f: F.struct(
            F.xxhash64(F.lit(i), value.bitwiseXOR(f)).alias("bucket"), mask.alias("used")))

    entries = [of_part(i, bits, threshold) for i, (bits, threshold) in enumerate(plan)]
    return nodes.select("fp", F.explode(F.concat(*entries)).alias("e")).select("fp", "e.bucket", "e.used")


def _dealt_anew(rows: DataFrame, used: list[int], max_bits: int) -> tuple[DataFrame, list[int]]:
    """Smaller buckets for the rows of heavy ones: within a bucket, linked
    fingerprints agree on one of max_bits + 1 parts of the other bits."""
    choices, masks = [], []
    for u in used:
        free = [b for b in range(64) if not u >> b & 1]
        subs = [sub for k in range(max_bits + 1) if (sub := _mask(free[k::max_bits + 1]))]
        masks += [u | s for s in subs]
        choices += [F.lit(_signed(u)), F.array(*[F.lit(_signed(s)) for s in subs])]
    sub = F.explode(F.element_at(F.create_map(*choices), F.col("used")))
    out = rows.select("fp", "bucket", "used", sub.alias("sub")).select(
        "fp",
        F.xxhash64("bucket", "sub", F.col("fp").bitwiseAND(F.col("sub"))).alias("bucket"),
        F.col("used").bitwiseOR(F.col("sub")).alias("used"))
    return out, sorted(set(masks))


def _tree(fps: np.ndarray, max_bits: int) -> Iterator[tuple[int, int]]:
    """(fingerprint, its component's smallest) for linked ones of a bucket."""
    left = fps  # ascending as signed longs
    while len(left) > 1:
        root, left, frontier = left[0], left[1:], [left[0]]
        while frontier and len(left):
            near = np.bitwise_count((left ^ frontier.pop()).view(np.uint64)) <= max_bits
            if near.any():
                new, left = left[near], left[~near]
                frontier.extend(new)
                yield from ((x, root) for x in new)


def _links(probes: DataFrame, max_bits: int) -> DataFrame:
    """Spanning links (a, b) of every bucket's linked fingerprints."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def found(bucket_fps: list[np.ndarray]):
            fps = np.unique(np.concatenate(bucket_fps))
            return list(_tree(fps, max_bits)) if len(fps) > 1 else []

        last, open_fps = None, []
        for frame in frames:
            if not len(frame):
                continue
            buckets, fps = frame["bucket"].to_numpy(), frame["fp"].to_numpy()
            cuts = np.concatenate(([0], np.flatnonzero(np.diff(buckets)) + 1, [len(buckets)]))
            edges = []
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                if last is not None and buckets[a] != last:
                    if len(open_fps) > 1 or len(open_fps[0]) > 1:
                        edges += found(open_fps)
                    open_fps = []
                open_fps.append(fps[a:b])
                last = buckets[a]
            yield pd.DataFrame(edges, columns=["a", "b"], dtype=np.int64)
        if open_fps:
            yield pd.DataFrame(found(open_fps), columns=["a", "b"], dtype=np.int64)

    dealt = probes.select("bucket", "fp").repartition("bucket").sortWithinPartitions("bucket")
    return dealt.mapInPandas(run, "a long, b long")


def links(nodes: DataFrame, max_bits: int = MAX_BITS, bucket: int = BUCKET) -> DataFrame:
    """Links that connect all fingerprints within ``max_bits`` of one another."""
    n, both = bit_statistics(nodes)
    plan = allot(n, both, max_bits)
    rows, used, out = _probes(nodes, plan), [_mask(b) for b, _ in plan], None
    for level in range(LEVELS + 1):
        heavy = None
        if level < LEVELS:
            heavy = rows.groupBy("bucket").count().filter(F.col("count") > bucket).select("bucket")
            heavy = written(heavy, "heavy-buckets")
            if heavy.isEmpty():
                heavy = None
        light = rows if heavy is None else rows.join(heavy, "bucket", "left_anti")
        found = _links(light, max_bits)
        out = found if out is None else out.unionByName(found)
        if heavy is None:
            break
        rows, used = _dealt_anew(rows.join(heavy, "bucket", "left_semi"), used, max_bits)
    return written(out.distinct(), "links")


def components(edges: DataFrame) -> DataFrame:
    """node, root (the smallest node reachable) of every node with a link."""
    # each node points to smaller ones; both steps keep what is connected
    edges = written(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                    .filter("u <> v").distinct(), "edges")
    was = digest(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = written(both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m")), "least")
        # large star: larger neighbours point to the smallest neighbour
        large = both.join(least, "u").filter("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = written(large.distinct(), "large-star")
        # small star: smaller neighbours, and the node, point to the smallest one
        least_large = written(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        small = large.join(least_large, "u").select(
            F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v"))))
            .alias("e")).select("e.u", "e.v").filter("u <> v").distinct()
        small = written(small, "small-star")
        forget(edges, least, large, least_large)
        edges, now = small, digest(small)  # distinct links: number and hash tell whether any changed
        if now == was:
            break
        was = now
    stars = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return stars.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def groups(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every document."""
    prints = written(fingerprints(docs, shingle), "fingerprints")
    nodes = written(prints.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "fingerprint-classes")
    roots = written(components(links(nodes.select("fp"), max_bits)), "components")
    rooted = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least_id", F.coalesce("root", "fp").alias("root"))
    rooted = written(rooted, "rooted-classes")
    of_root = written(rooted.groupBy("root").agg(F.min("least_id").alias("component_id")), "component-ids")
    named = written(rooted.join(of_root, "root").select("fp", "component_id"), "named-classes")
    # a plain exchange on either side: Spark splits the partition of a hot fingerprint
    return prints.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """The documents, all columns as they are, with one of each group: that of
    the smallest id (null last; of repeated rows, one)."""
    fp, row = _free_name(docs, "fp"), _free_name(docs, "row")

    def make():
        def one(text: str | None):
            return text, int(np.uint64(fingerprint(text, shingle)).astype(np.int64))

        return one

    # written, so that each row keeps its number
    marked = map_text(docs, "text", make, f"{fp} long").withColumn(row, F.monotonically_increasing_id())
    marked = written(marked, "fingerprinted")
    prints = marked.select(F.col("doc_id").alias("doc_id"), F.col(fp).alias("fp"), F.col(row).alias("row"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row")).alias("first")
    nodes = written(prints.groupBy("fp").agg(first), "fingerprint-classes")
    roots = written(components(links(nodes.select("fp"), max_bits)), "components")
    of_root = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").groupBy(
        F.coalesce("root", "fp").alias("root")).agg(F.min("first").alias("first"))
    stay = written(of_root.select(F.col("first.row").alias(row)), "stay")
    # the same plan at every size: a few rows are not broadcast
    return marked.hint("merge").join(stay, row, "left_semi").select(*docs.columns)


def _free_name(docs: DataFrame, name: str) -> str:
    while name.lower() in {c.lower() for c in docs.columns}:
        name += "_"
    return name
