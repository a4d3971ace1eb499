"""Near-duplicates by a chosen-path set similarity join.

Every document becomes a set of word shingles, and every distinct set one
representative with a signature of minwise tokens. Trees branch the representatives:
a node holds those that agree on the tokens chosen on the way to it. Members are compared
with one of them, the node's pivot. Nodes that are still unconnected branch on further
tokens while they are large. The others are leaves: a small one compares all its pairs; of a
larger one each member's shingles are counted over all such leaves, members meet the one with the
most common shingles, the likely origin of copies, and then only those pairs of different
components are compared that share a shingle among their rarest, as every link must
(``_rare_pairs``; that step is exact). Every link is confirmed on full sets. Members that are
already connected need no comparison, and one that differs from all others by more than
a link allows has no rare shingle to meet them by, so a large group of near-copies costs
a few comparisons a member.

Recall: a node passes each member on to ``BRANCH`` children. Two sets of similarity s stay
together below a root with probability at least 1 - q, q the smallest root of
q = (1 - s + s q) ** BRANCH; at 0.75 and three branches q is 0.019, so four independent
trees miss a link with probability 1.3e-7 however deep they are, and with 0.25 ** 12 = 6e-8
where the first nodes are small.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkfold.llm import shingles
from inkfold.llm.components import components
from inkfold.llm.storage import bucketed, neutral, stored

PERCENT = 75  # similarity that links
TREES = 4
BRANCH = 3
TOKENS = 64  # of a signature
AGREE = 27  # of 64 tokens that two sets of similarity 0.75 share but for 6e-9
DIFFER = 42  # of a sketch's 128 bits in which they differ at most, but for 3e-7
FEW = 32  # members up to which a leaf compares all its pairs
LEAF = 4096  # members up to which a node does not branch; doubles each level
SLICE = 200_000  # shingles counted in a task before they are passed on, and sent back to
ROWS = 256

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _constants() -> tuple[np.ndarray, np.ndarray]:
    made = np.random.default_rng(20177).integers(0, 2**63, (2, TOKENS), np.uint64)
    return made[0], made[1] | np.uint64(1)


def _signatures(sets: list[np.ndarray]) -> np.ndarray:
    """The least hash under each of TOKENS functions, a row per set; zeros for empty sets."""
    out = np.zeros((len(sets), TOKENS), np.int32)
    full = [i for i, s in enumerate(sets) if len(s)]
    if full:
        together = np.concatenate([sets[i] for i in full])
        begin = np.concatenate([[0], np.cumsum([len(sets[i]) for i in full])[:-1]])
        for t, (x, m) in enumerate(zip(*_constants())):
            least = np.minimum.reduceat((together ^ x) * m, begin)
            out[full, t] = (least >> np.uint64(20)).astype(np.uint32).view(np.int32)
    return out


def _sketches(tokens: np.ndarray) -> np.ndarray:
    """Two bits of every token, as two 64-bit numbers a row."""
    bits = np.stack([tokens & 1, (tokens >> 1) & 1], 1).astype(np.uint8)
    return np.packbits(bits, axis=2).reshape(len(tokens), 2, -1).view("<i8")[:, :, 0]


def signed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, text_key, n, set_key, tokens, s1, s2) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = shingles.WordHashes()
        for whole in batches:
            for start in range(0, whole.num_rows, ROWS):
                batch = whole.slice(start, ROWS)
                sets = [shingles.shingle_set(t, hashes) for t in batch["text"].to_pylist()]
                tokens = _signatures(sets)
                sketches = _sketches(tokens)
                keys = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["id"],
                        batch["text_key"],
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array(keys, pa.binary()),
                        pa.array(list(tokens), pa.list_(pa.int32())),
                        pa.array(sketches[:, 0].copy()),
                        pa.array(sketches[:, 1].copy()),
                    ],
                    names=["id", "text_key", "n", "set_key", "tokens", "s1", "s2"],
                )

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(
        F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_key"), F.col(text_col).alias("text")
    ).mapInArrow(
        run,
        f"id {kind}, text_key bigint, n bigint, set_key binary, tokens array<int>, s1 bigint, s2 bigint",
    )


def _children(rows: DataFrame, level: int) -> DataFrame:
    """(path, tree, branch, set_key, s1, s2): each row goes on to BRANCH nodes by a token each.

    Which tokens, the path decides. At the root all trees choose different ones.
    """
    made = []
    for b in range(BRANCH):
        if level == 0:
            at = F.col("tree") * BRANCH + b
        else:
            # A stride through the signature that starts anew on each path.
            at = F.pmod(F.xxhash64("path") + F.lit(b + level * BRANCH) * 23, F.lit(TOKENS)).cast("int")
        token = F.element_at("tokens", at + 1)
        path = F.xxhash64("path", F.lit(level), at, token)
        made.append(F.struct(path.alias("path"), F.lit(b).alias("branch")))
    return rows.select(F.explode(F.array(*made)).alias("n"), "tree", "set_key", "s1", "s2").select(
        "n.path", "tree", "n.branch", "set_key", "s1", "s2"
    )


def _members(rows: DataFrame, level: int) -> DataFrame:
    """The children's members, with the pivot of their node, where it has two members."""
    placed = _children(rows, level)
    pivot = F.min(F.struct(F.xxhash64("path", "set_key").alias("by"), "set_key", "s1", "s2"))
    nodes = stored(
        placed.groupBy("path", "tree")
        .agg(F.count(F.lit(1)).alias("size"), pivot.alias("pivot"))
        .filter("size > 1")
        .select(
            "path",
            "tree",
            F.col("pivot.set_key").alias("pivot"),
            F.col("pivot.s1").alias("p1"),
            F.col("pivot.s2").alias("p2"),
        ),
        "path-nodes",
    )
    return stored(placed.join(nodes.hint("merge"), ["path", "tree"]), "path-members")


def _alike(a1: str, a2: str, b1: str, b2: str):
    """Whether two sketches differ in few enough bits."""
    bits = lambda a, b: F.bit_count(F.col(a).bitwiseXOR(F.col(b)))
    return bits(a1, b1) + bits(a2, b2) <= DIFFER


def _rooted(rows: DataFrame, ends: DataFrame | None, key: str, name: str) -> DataFrame:
    """``rows`` with the root of ``key`` so far, itself where it has none."""
    if ends is None:
        return rows.withColumn(name, F.col(key))
    found = ends.select(F.col("node").alias("_node"), F.col("root").alias("_root"))
    joined = rows.join(found.hint("merge"), F.col(key) == F.col("_node"), "left")
    return joined.withColumn(name, F.coalesce("_root", key)).drop("_node", "_root")


def _across(rows: DataFrame, keys: list[str], *more: str) -> DataFrame:
    """(u, v): alike pairs of rows that share ``keys`` and are of different components.

    ``more``: columns that the pairs have twice, as they are and with ``p_`` before the name.
    """
    parts = rows.groupBy(*keys, "root").agg(F.count(F.lit(1)).alias("n"))
    main = parts.groupBy(*keys).agg(F.count(F.lit(1)).alias("roots"), F.max(F.struct("n", "root")).alias("most"))
    main = main.filter("roots > 1").select(*keys, F.col("most.root").alias("main"))
    apart = stored(rows.join(main.hint("merge"), keys), "path-apart")
    # All pairs but those inside a component have a member outside the largest one.
    outside = apart.filter("root != main").select(
        *keys, F.col("set_key").alias("u"), F.col("root").alias("root_u"),
        F.col("s1").alias("p1"), F.col("s2").alias("p2"), *(F.col(c).alias(f"p_{c}") for c in more),
    )
    return (
        apart.select(*keys, F.col("set_key").alias("v"), "root", "s1", "s2", *more)
        .join(outside.hint("merge"), keys)
        .filter("root != root_u")
        .filter(_alike("s1", "s2", "p1", "p2"))
    )


def _open(members: DataFrame, ends: DataFrame | None, level: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Pairs of small leaves, then members of larger leaves and of nodes that branch.

    Nodes halve at least from level to level, so a deeper leaf may have twice as many
    members. That keeps the tree short.
    """
    rows = stored(_rooted(members, ends, "set_key", "root"), "path-rooted")
    nodes = rows.groupBy("path", "tree").agg(
        F.count(F.lit(1)).alias("size"), F.min("root").alias("low"), F.max("root").alias("high")
    )
    nodes = stored(nodes.filter("low != high").select("path", "tree", "size"), "path-sizes")
    rows = rows.select("path", "tree", "set_key", "root", "s1", "s2")
    rows = stored(rows.join(nodes.hint("merge"), ["path", "tree"]), "path-open")
    small = _across(rows.filter(F.col("size") <= FEW), ["path", "tree"]).select("u", "v")
    leaf = F.col("size") <= LEAF * 2**level
    return small, rows.filter((F.col("size") > FEW) & leaf), rows.filter(~leaf).select("path", "tree", "set_key")


_SLICE_DDL = "slice string, keys binary, sizes binary, shingles binary"


def _sliced(texts: DataFrame) -> DataFrame:
    """The sets of ``texts``, some SLICE shingles in a row, one set after another."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, keys, sets = shingles.WordHashes(), [], []

        def row() -> pa.RecordBatch:
            sizes = np.array([len(s) for s in sets], "<i8").tobytes()
            made = [keys[0].hex(), b"".join(keys), sizes, np.concatenate(sets).tobytes()]
            kinds = [pa.string(), pa.binary(), pa.binary(), pa.binary()]
            made = [pa.array([m], k) for m, k in zip(made, kinds)]
            return pa.RecordBatch.from_arrays(made, names=["slice", "keys", "sizes", "shingles"])

        size = 0
        for batch in batches:
            for key, text in zip(batch["set_key"].to_pylist(), batch["text"]):
                keys.append(key)
                sets.append(shingles.shingle_set(text.as_py(), hashes))
                size += len(sets[-1])
                if size > SLICE:
                    yield row()
                    keys, sets, size = [], [], 0
        if keys:
            yield row()

    return texts.select("set_key", "text").mapInArrow(run, _SLICE_DDL)


def _shared_counts(slices: DataFrame) -> DataFrame:
    """(slice, shingles, counts): each slice's shingles that several sets have, and how many.

    A slice counts its own first, so a shingle of very many sets is sent once a slice.
    """
    buckets = int(slices.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, raw in zip(batch["slice"].to_pylist(), batch["shingles"].to_pylist()):
                found, counts = np.unique(np.frombuffer(raw, np.uint64), return_counts=True)
                bucket = (found % np.uint64(buckets)).astype(np.int32)
                by = np.argsort(bucket, kind="stable")
                parts = np.split(by, np.flatnonzero(np.diff(bucket[by])) + 1)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([bucket[p[0]] for p in parts], pa.int32()),
                        pa.array([name] * len(parts)),
                        pa.array([found[p].tobytes() for p in parts], pa.binary()),
                        pa.array([counts[p].astype("<i8").tobytes() for p in parts], pa.binary()),
                    ],
                    names=["bucket", "slice", "shingles", "counts"],
                )

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(rows: list[dict]) -> Iterator[pa.RecordBatch]:
            parts = [np.frombuffer(r["shingles"], np.uint64) for r in rows]
            counts = np.concatenate([np.frombuffer(r["counts"], np.int64) for r in rows])
            _, which = np.unique(np.concatenate(parts), return_inverse=True)
            total = np.zeros(which.max() + 1, np.int64)
            np.add.at(total, which, counts)
            total = np.split(total[which], np.cumsum([len(p) for p in parts])[:-1])
            several = [t > 1 for t in total]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([r["slice"] for r in rows]),
                    pa.array([p[m].tobytes() for p, m in zip(parts, several)], pa.binary()),
                    pa.array([t[m].tobytes() for t, m in zip(total, several)], pa.binary()),
                ],
                names=["slice", "shingles", "counts"],
            )

        held: list[dict] = []
        for batch in batches:
            for row in batch.to_pylist():
                if held and row["bucket"] != held[0]["bucket"]:
                    yield from flush(held)
                    held = []
                held.append(row)
        if held:
            yield from flush(held)

    sent = slices.select("slice", "shingles").mapInArrow(
        local, "bucket int, slice string, shingles binary, counts binary"
    )
    placed = sent.repartition("bucket").sortWithinPartitions("bucket")
    return placed.mapInArrow(meet, "slice string, shingles binary, counts binary")


def _profiles(keys: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """(set_key, n, common, shingles, rest) of those of ``keys`` that can have a link.

    ``common`` is the mean number of sets that have a shingle of the set. ``shingles`` are the
    rarest of the set that others have too, and ``rest`` how many of the set are no rarer.
    At least one of them is in the intersection with any set that it links to.
    """
    slices = stored(_sliced(texts.join(keys.hint("merge"), "set_key")), "path-slices")
    several = _shared_counts(slices).groupBy("slice").agg(
        F.collect_list(F.struct("shingles", "counts")).alias("several")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                keys = [row["keys"][i : i + 16] for i in range(0, len(row["keys"]), 16)]
                sizes, found = np.frombuffer(row["sizes"], np.int64), np.frombuffer(row["shingles"], np.uint64)
                known = np.concatenate([np.frombuffer(x["shingles"], np.uint64) for x in row["several"]])
                counts = np.concatenate([np.frombuffer(x["counts"], np.int64) for x in row["several"]])
                by = np.argsort(known)
                known, counts = np.append(known[by], found[:1]), np.append(counts[by], 1)
                at = np.searchsorted(known[:-1], found)
                sets = np.where(known[at] == found, counts[at], 1)
                out = []
                for key, n, end in zip(keys, sizes, np.cumsum(sizes)):
                    own, often = found[end - n : end], sets[end - n : end]
                    order = np.lexsort((own, often))
                    rest = n - np.arange(n)
                    keep = (often[order] > 1) & (100 * rest >= percent * n)
                    if keep.any():
                        out.append((key, n, often.mean(), own[order][keep].view(np.int64), rest[keep]))
                kinds = [pa.binary(), pa.int64(), pa.float64(), pa.list_(pa.int64()), pa.list_(pa.int64())]
                columns = zip(*out) if out else [[]] * len(kinds)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(c), k) for c, k in zip(columns, kinds)],
                    names=["set_key", "n", "common", "shingles", "rest"],
                )

    ddl = "set_key binary, n bigint, common double, shingles array<bigint>, rest array<bigint>"
    return stored(slices.join(several.hint("merge"), "slice").mapInArrow(run, ddl), "path-profiles")


def _central_pairs(leaves: DataFrame, profiles: DataFrame) -> DataFrame:
    """(u, v): each member of a leaf that can have a link and the one with the most common shingles."""
    rows = stored(leaves.join(profiles.select("set_key", "common").hint("merge"), "set_key"), "path-leaves")
    most = rows.groupBy("path", "tree").agg(F.max(F.struct("common", "set_key", "root", "s1", "s2")).alias("most"))
    most = most.select(
        "path", "tree", F.col("most.set_key").alias("v"), F.col("most.root").alias("root_v"),
        F.col("most.s1").alias("p1"), F.col("most.s2").alias("p2"),
    )
    near = rows.join(most.hint("merge"), ["path", "tree"]).filter("root != root_v")
    return near.filter(_alike("s1", "s2", "p1", "p2")).select(F.col("set_key").alias("u"), "v")


def _rare_pairs(leaves: DataFrame, profiles: DataFrame, ends: DataFrame | None, percent: int) -> DataFrame:
    """(u, v): pairs of different components that share a shingle among the rarest of both.

    In one order of all shingles, the first one that two sets share has the whole
    intersection behind it on either side; a link needs percent / (100 + percent) of
    both sizes together there.
    """
    sketches = leaves.groupBy("set_key").agg(F.first("s1").alias("s1"), F.first("s2").alias("s2"))
    rows = profiles.join(sketches.hint("merge"), "set_key")
    rows = _rooted(rows, ends, "set_key", "root")
    rows = rows.select(
        "set_key", "root", "s1", "s2", "n", F.explode(F.arrays_zip("shingles", "rest")).alias("at")
    ).select("set_key", "root", "s1", "s2", "n", F.col("at.shingles").alias("shingle"), F.col("at.rest").alias("rest"))
    pairs = _across(stored(rows, "path-rare"), ["shingle"], "n", "rest")
    enough = (100 + percent) * F.least("rest", "p_rest") >= percent * (F.col("n") + F.col("p_n"))
    return pairs.filter(enough).select("u", "v")


def _candidates(pairs: DataFrame, sets: DataFrame, tested: DataFrame | None, percent: int) -> DataFrame:
    """Pairs (u, v) not tested before whose sizes and signatures allow a link."""
    pairs = pairs.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    pairs = pairs.filter("u > v").distinct()
    if tested is not None:
        pairs = pairs.join(tested, ["u", "v"], "left_anti")
    left = sets.select(F.col("set_key").alias("u"), F.col("n").alias("n_u"), F.col("tokens").alias("t_u"))
    right = sets.select(F.col("set_key").alias("v"), F.col("n").alias("n_v"), F.col("tokens").alias("t_v"))
    same = F.aggregate(
        F.zip_with("t_u", "t_v", lambda x, y: (x == y).cast("int")), F.lit(0), lambda a, x: a + x
    )
    return (
        pairs.join(left.hint("merge"), "u")
        .join(right.hint("merge"), "v")
        .filter(100 * F.least("n_u", "n_v") >= percent * F.greatest("n_u", "n_v"))
        .filter(same >= AGREE)
        .select("u", "v")
    )


def _confirmed(candidates: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """The candidates whose full sets are similar enough.

    ``texts`` is bucketed by set, so it is not moved. A pair moves the text of u to v;
    partitions of a v with very many pairs are split.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, last, one = shingles.WordHashes(), None, None
        for batch in batches:
            keep = []
            for v, x, y in zip(batch["v"].to_pylist(), batch["text_u"], batch["text_v"]):
                if v != last:  # rows come sorted by v
                    last, one = v, shingles.shingle_set(y.as_py(), hashes)
                other = shingles.shingle_set(x.as_py(), hashes)
                both = len(np.intersect1d(one, other, assume_unique=True))
                keep.append(100 * both >= percent * (len(one) + len(other) - both))
            yield batch.select(["u", "v"]).filter(pa.array(keep, pa.bool_()))

    left = texts.select(F.col("set_key").alias("u"), F.col("text").alias("text_u"))
    right = texts.select(F.col("set_key").alias("v"), F.col("text").alias("text_v"))
    mine = stored(candidates.select("v").distinct().join(right.hint("merge"), "v"), "path-right")
    pairs = candidates.join(left.hint("merge"), "u").join(mine.hint("merge"), "v")
    return pairs.select("u", "v", "text_u", "text_v").mapInArrow(run, "u binary, v binary")


def _texts(
    docs: DataFrame, sets: DataFrame, keys: DataFrame, id_col: str, text_col: str
) -> tuple[DataFrame, str]:
    """A table with one text for each of ``keys``, bucketed by set, and its name."""
    wanted = stored(
        keys.distinct().join(sets.select("set_key", "best"), "set_key").select("set_key", "best.*"),
        "path-wanted",
    ).hint("merge")
    rows = docs.select(
        F.col(id_col).alias("_id"), F.xxhash64(text_col).alias("_key"), F.col(text_col).alias("text")
    )
    fetched = rows.join(
        wanted, [F.col("_id").eqNullSafe(F.col("id")), F.col("_key") == F.col("text_key")]
    ).select("set_key", "text")
    # Repeated rows bring the same text once more; one is enough.
    return bucketed(fetched.dropDuplicates(["set_key"]), "set_key", "path_texts")


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """(id, text_key, n_shingles, component_id, best, times) of every row of ``docs``.

    ``component_id`` is the smallest id reachable over links, ``best`` is true for the
    row (or the ``times`` equal rows) of its component to keep. Null counts as empty; a
    text without words has no shingles and is its own component. A null id is carried
    along and never smallest unless alone. Rows with equal sets are one node of the
    graph, whatever their number, so copies make no pairs. A repeated id is a row like
    any other. An empty table gives an empty result; other columns are not read.
    """
    rows = stored(signed(docs, id_col, text_col), "path-rows")
    full = rows.filter("n > 0")
    sets, name = bucketed(
        full.groupBy("set_key")
        .agg(
            F.min(F.struct("id", "text_key")).alias("best"),
            F.min("id").alias("least_id"),
            F.first("n").alias("n"),
            F.first("tokens").alias("tokens"),
            F.first("s1").alias("s1"),
            F.first("s2").alias("s2"),
        ),
        "set_key",
        "path_sets",
    )
    roots = stored(_linked(docs, sets, id_col, text_col, percent), "path-roots")
    named = sets.select("set_key", "least_id", "best").join(roots, sets.set_key == roots.node, "left")
    named = named.select("set_key", "least_id", "best", F.coalesce("root", "set_key").alias("root"))
    least = named.groupBy("root").agg(
        F.min("least_id").alias("component_id"), F.min("best").alias("component_best")
    )
    labelled = stored(named.join(least, "root").select("set_key", "component_id", "component_best"), "path-labels")
    docs.sparkSession.sql(f"drop table {name}")
    multiple = rows.groupBy("id", "text_key").agg(F.count(F.lit(1)).alias("times")).filter("times > 1")
    mine = F.struct("id", "text_key")
    return (
        rows.select("id", "text_key", "n", "set_key")
        .join(labelled, "set_key", "left")
        .join(
            multiple.select(F.col("id").alias("_id"), F.col("text_key").alias("_key"), "times"),
            [F.col("id").eqNullSafe(F.col("_id")), F.col("text_key") == F.col("_key")],
            "left",
        )
        .select(
            "id",
            "text_key",
            F.col("n").alias("n_shingles"),
            F.when(F.col("n") == 0, F.col("id")).otherwise(F.col("component_id")).alias("component_id"),
            ((F.col("n") == 0) | mine.eqNullSafe(F.col("component_best"))).alias("best"),
            F.coalesce("times", F.lit(1).cast("bigint")).alias("times"),
        )
    )


def _linked(docs: DataFrame, sets: DataFrame, id_col: str, text_col: str, percent: int) -> DataFrame:
    """(node, root) of all sets that link to a smaller one."""
    spark = docs.sparkSession
    trees = F.explode(F.array(*map(F.lit, range(TREES)))).alias("tree")
    inner = sets.select("set_key", "tokens", "s1", "s2", trees).withColumn("path", F.col("tree").cast("bigint"))
    members = _members(inner, 0)
    texts, name = _texts(docs, sets, members.select("set_key"), id_col, text_col)
    ends = tested = None

    def compare(pairs: DataFrame) -> None:
        nonlocal ends, tested
        candidates = stored(_candidates(pairs, sets, tested, percent), "path-candidates")
        tested = candidates if tested is None else tested.unionByName(candidates)
        links = _confirmed(candidates, texts, percent)
        if ends is not None:
            links = links.unionByName(ends.select(F.col("node").alias("u"), F.col("root").alias("v")))
        ends = components(stored(links, "path-links"))

    # Pivots differ from node to node. What one node connects, the next need not compare.
    rounds = ["tree = 0 and branch = 0", "true"]
    level, exhaustive = 0, None
    while True:
        for which in rounds:
            near = members.filter(which).filter(_alike("s1", "s2", "p1", "p2"))
            pairs = near.filter("set_key != pivot").select("set_key", "pivot")
            pairs = _rooted(_rooted(pairs.distinct(), ends, "set_key", "x"), ends, "pivot", "y")
            pairs = pairs.filter("x != y").select(F.col("set_key").alias("u"), F.col("pivot").alias("v"))
            if exhaustive is not None:
                pairs, exhaustive = pairs.unionByName(exhaustive), None
            compare(pairs)
        exhaustive, leaves, large = _open(members, ends, level)
        if not leaves.isEmpty():
            profiles = _profiles(leaves.select("set_key").distinct(), texts, percent)
            compare(exhaustive.unionByName(_central_pairs(leaves, profiles)))
            exhaustive = _rare_pairs(leaves, profiles, ends, percent)
        if large.isEmpty():
            break
        level, rounds = level + 1, ["true"]
        members = _members(large.join(sets.select("set_key", "tokens", "s1", "s2").hint("merge"), "set_key"), level)
    compare(exhaustive)
    spark.sql(f"drop table {name}")
    return ends


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` with one of each component, all without words, and no other.

    Of the smallest id's rows the one with the least text hash stays, once. Any column
    names will do.
    """
    columns = docs.columns
    docs, id_col, text_col = neutral(docs, id_col, text_col)
    decided = stored(groups(docs, id_col, text_col, percent), "path-decisions")
    drop = decided.filter("not best").select(F.col("id").alias("_id"), F.col("text_key").alias("_key")).distinct()
    key = F.xxhash64(docs[text_col])
    match = lambda other: [docs[id_col].eqNullSafe(other["_id"]), key == other["_key"]]
    kept = docs.join(drop.hint("merge"), match(drop), "left_anti")
    again = decided.filter("best and times > 1 and n_shingles > 0").select(
        F.col("id").alias("_id"), F.col("text_key").alias("_key")
    ).distinct()
    if again.isEmpty():
        return kept.toDF(*columns)
    once = docs.join(again, match(again), "left_semi").dropDuplicates([id_col, text_col])
    return kept.join(again, match(again), "left_anti").unionByName(once).toDF(*columns)
