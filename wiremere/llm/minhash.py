"""Near-duplicate documents: MinHash bands, signature test, full sets, connected components.

Documents with equal shingle sets are merged first, so a group of exact copies is one node. Band
buckets then propose pairs: every member against the bucket's smallest node, which takes one row
per member and joins most of a group of near copies in one round. Members that are still in different
components meet in blocks, and only links leave a block. Every link is confirmed on full shingle sets.

Nulls: a null text is empty. Empty texts have no shingles and are linked with nothing. A row without
doc_id takes no part in links; its component_id is null and it is kept. Repeated equal rows give
equal results. Of a doc_id with several texts every row goes by its own text: nodes are sets, not ids,
so texts that resemble nothing stay in components of their own.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wiremere.llm import words
from wiremere.llm.tables import components, prepare, stored

WIDTH = 5
THRESHOLD = 75  # hundredths of the Jaccard similarity
BANDS, ROWS = 32, 4
# At similarity 0.75 a signature of 128 values agrees in fewer than 70 places once in 10**6 times.
LEAST_EQUAL = 70
BLOCK = 128
PARTS = 64  # tasks that share the nodes of one component

_RNG = np.random.default_rng(7)
_A = _RNG.integers(1, 1 << 63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _RNG.integers(1, 1 << 63, BANDS * ROWS, dtype=np.uint64)


def signatures(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Universal-hash minima per set, one row of 32-bit values each; empty sets are left zero."""
    out = np.zeros((len(offsets) - 1, BANDS * ROWS), np.uint32)
    full = np.flatnonzero(np.diff(offsets))
    if len(full):
        begins = offsets[:-1][full]
        for k in range(BANDS * ROWS):
            out[full, k] = np.minimum.reduceat((values * _A[k] + _B[k]) >> np.uint64(32), begins)
    return out


def band_keys(minima: np.ndarray) -> np.ndarray:
    """One 64-bit key per band, which holds the band's number."""
    parts = minima.reshape(len(minima), BANDS, ROWS).astype(np.uint64)
    key = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), parts.shape[:2])
    for r in range(ROWS):
        key = words.mix(key * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, r])
    return key


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, hashes, texts = batch.columns
        for start, end in words.slices(texts):
            values, offsets = words.shingle_sets(texts.slice(start, end - start), WIDTH)
            minima = signatures(values, offsets)
            keys = [
                hashlib.blake2b(values[a:b].tobytes(), digest_size=16).digest() if b > a else None
                for a, b in zip(offsets[:-1], offsets[1:])
            ]
            flat = np.arange(0, (end - start + 1) * BANDS, BANDS)
            yield pa.RecordBatch.from_arrays(
                [
                    ids.slice(start, end - start),
                    hashes.slice(start, end - start),
                    pa.array(np.diff(offsets)),
                    pa.array(keys, pa.binary()),
                    words.lists(np.ascontiguousarray(band_keys(minima)).reshape(-1), flat),
                    pa.array([m.tobytes() for m in minima.astype(np.uint8)], pa.binary()),
                ],
                ["doc_id", "text_hash", "n_shingles", "set_key", "bands", "marks"],
            )


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        nodes, texts = batch.column(0), batch.column(1)
        for start, end in words.slices(texts):
            values, offsets = words.shingle_sets(texts.slice(start, end - start), WIDTH)
            yield pa.RecordBatch.from_arrays(
                [nodes.slice(start, end - start), words.lists(values, offsets)], ["node", "shingles"]
            )


def _texts(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash and text; the first two tell rows of one doc_id apart."""
    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))


def features(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, n_shingles, set_key, bands, marks (low bytes of the signature) per row."""
    return _texts(docs).mapInArrow(
        _features, "doc_id long, text_hash long, n_shingles long, set_key binary, bands array<long>, marks binary"
    )


def _similar_marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            marks = [np.frombuffer(b"".join(c.to_pylist()), np.uint8) for c in batch.columns[2:4]]
            a, b = (m.reshape(-1, BANDS * ROWS) for m in marks)
            near = (a == b).sum(axis=1) >= LEAST_EQUAL
            yield batch.select([0, 1]).filter(pa.array(near))


def _alike(size_a, size_b):
    """Sets whose sizes alone do not rule out the similarity."""
    return (100 * F.least(size_a, size_b)) >= (THRESHOLD * F.greatest(size_a, size_b))


def _tested(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Distinct pairs (u, v) whose sizes and signatures allow the similarity."""
    marks = nodes.select("node", "n_shingles", "marks")
    side = lambda n: marks.select(F.col("node").alias(n), F.col("n_shingles").alias(f"n{n}"), F.col("marks").alias(f"m{n}"))
    joined = pairs.distinct().join(side("u"), "u").join(side("v"), "v").filter(_alike(F.col("nu"), F.col("nv")))
    return joined.select("u", "v", "mu", "mv").mapInArrow(_similar_marks, "u long, v long")


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs whose full shingle sets reach the similarity."""
    side = lambda n: sets.select(F.col("node").alias(n), F.col("shingles").alias(f"s{n}"))
    joined = pairs.join(side("u"), "u").join(side("v"), "v")
    both = F.size(F.array_intersect("su", "sv"))
    return (
        joined.select("u", "v", both.alias("both"), (F.size("su") + F.size("sv")).alias("sizes"))
        .filter(100 * F.col("both") >= THRESHOLD * (F.col("sizes") - F.col("both")))
        .select("u", "v")
    )


def _runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Whole runs of rows with equal keys, from rows that arrive sorted by them."""
    rest: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        table = table if rest is None else pa.concat_tables([rest, table]).combine_chunks()
        at = np.stack([table.column(c).to_numpy() for c in keys])
        cuts = np.flatnonzero((at[:, 1:] != at[:, :-1]).any(axis=0)) + 1
        for a, b in zip([0, *cuts], cuts):
            yield table.slice(a, b - a)
        rest = table.slice(cuts[-1] if len(cuts) else 0)
    if rest is not None:
        yield rest


def _block_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links (u, v) from strays to members of other components, within one home and block pair.

    Sizes and signatures rule out most members; the rest are compared on full sets. One link per
    stray and component is enough to join the two.
    """
    for run in _runs(batches, ["home", "left", "right"]):
        ids, component, size = (run.column(c).to_numpy() for c in ("node", "component", "n_shingles"))
        stray = run.column("stray").to_numpy()
        marks = np.frombuffer(b"".join(run.column("marks").to_pylist()), np.uint8).reshape(len(ids), -1)
        sets = run.column("shingles").combine_chunks()
        bounds, values = sets.offsets.to_numpy(), sets.values.to_numpy()
        others = np.flatnonzero(~stray)
        found = []
        for i in np.flatnonzero(stray):
            at = others[component[others] != component[i]]
            at = at[100 * np.minimum(size[at], size[i]) >= THRESHOLD * np.maximum(size[at], size[i])]
            at = at[(marks[at] == marks[i]).sum(axis=1) >= LEAST_EQUAL]
            if not len(at):
                continue
            own = np.sort(values[bounds[i] : bounds[i + 1]])
            theirs = np.concatenate([values[bounds[j] : bounds[j + 1]] for j in at])
            hit = own[np.minimum(np.searchsorted(own, theirs), len(own) - 1)] == theirs
            both = np.add.reduceat(hit, np.concatenate([[0], np.cumsum(size[at])[:-1]]), dtype=np.int64)
            near = at[100 * both >= THRESHOLD * (size[at] + size[i] - both)]
            near = near[np.unique(component[near], return_index=True)[1]]
            found += [(ids[i], ids[j]) for j in near]
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*found)], ["u", "v"])


def _apart(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Members of buckets that still hold several components: (bucket, node, component, home).

    `home` is the component with most members in the bucket. Pairs inside a component need no check,
    so only members outside of home have to meet the rest.
    """
    labelled = members.join(labels, "node", "left").select(
        "bucket", "node", F.coalesce("component", "node").alias("component")
    )
    counts = labelled.groupBy("bucket", "component").agg(F.count("*").alias("n"))
    homes = counts.groupBy("bucket").agg(
        F.max(F.struct("n", "component")).alias("most"), F.count("*").alias("parts")
    )
    homes = homes.filter("parts > 1").select("bucket", F.col("most.component").alias("home"))
    return labelled.join(homes, "bucket")


def _late_links(apart: DataFrame, nodes: DataFrame) -> DataFrame:
    """Links of strays, met block by block with all that share a home with them.

    Two members of a bucket that are in different components are a stray and a home member, or two
    strays of the same home. So per home, each block of strays meets each block of all. Blocks are
    dealt by hash and every pair of blocks is one small group: a home of any size spreads over many
    tasks, a node is not met once per bucket, and only links leave a block.
    """
    groups = apart.select("home", "node", "component").distinct()
    sizes = groups.groupBy("home").agg(F.count("*").alias("members"), F.count_if(F.col("component") != F.col("home")).alias("strays"))
    full = groups.join(sizes, "home").join(nodes, "node")
    blocks = lambda n: F.ceil(F.col(n) / F.lit(BLOCK)).cast("long")
    own = lambda n: F.pmod(F.xxhash64("node"), blocks(n))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), blocks(n) - 1))
    columns = ["home", "left", "right", "stray", "node", "component", "n_shingles", "marks", "shingles"]
    strays = full.filter("component <> home").withColumns({"stray": F.lit(True), "left": own("strays")})
    strays = strays.withColumn("right", every("members")).select(columns)
    others = full.withColumns({"stray": F.lit(False), "right": own("members")})
    others = others.withColumn("left", every("strays")).select(columns)
    keys = ["home", "left", "right"]
    met = strays.unionByName(others).repartition(*keys).sortWithinPartitions(*keys)
    return met.mapInArrow(_block_links, "u long, v long")


def _least_heads(labels: DataFrame, classes: DataFrame) -> DataFrame:
    """(node, least): the smallest head of each node's component.

    A component may hold a third of all nodes. Its nodes are dealt over PARTS parts; the smallest head is
    found per part, then per component, and goes back to the parts and from there to the nodes.
    """
    part = F.pmod(F.xxhash64("node"), F.lit(PARTS)).alias("part")
    labelled = labels.join(classes.select("node", "head"), "node").select("node", "component", "head", part)
    parts = labelled.groupBy("component", "part").agg(F.min("head").alias("head"))
    least = parts.groupBy("component").agg(F.min("head").alias("least"))
    parts = parts.select("component", "part").join(least, "component")
    return labelled.select("node", "component", "part").join(parts, ["component", "part"]).select("node", "least")


def near_duplicates(docs: DataFrame, rows: bool = False) -> DataFrame:
    """doc_id, n_shingles, component_id and kept per row of docs (doc_id, text).

    With `rows`, also text_hash and stays: whether the row's doc_id and text are those by which its
    group is kept. Where a doc_id has several texts, `kept` may hold for two of one group, `stays` not.
    """
    prepare(docs.sparkSession)
    table = stored(features(docs))
    # A node per distinct set, numbered as it is written; results do not depend on the numbers.
    classes = table.filter("set_key is not null and doc_id is not null")
    classes = classes.groupBy("set_key").agg(F.min(F.struct("doc_id", "text_hash")).alias("head"))
    classes = stored(classes.withColumn("node", F.monotonically_increasing_id()))
    heads = table.join(classes.select("set_key", "node", "head.*"), ["set_key", "doc_id", "text_hash"]).dropDuplicates(["set_key"])

    spread = heads.select("node", F.explode("bands").alias("bucket"))
    shared = spread.groupBy("bucket").agg(F.min("node").alias("lead"), F.max("node").alias("last"))
    members = stored(spread.join(shared.filter("lead < last"), "bucket").select("bucket", "node", "lead"))

    # Full sets of all nodes that share a bucket; their texts are shuffled once, at any size.
    wanted = members.select("node").distinct().join(classes.select("node", "head.*"), "node")
    chosen = _texts(docs).join(wanted.hint("merge"), ["doc_id", "text_hash"])
    chosen = chosen.dropDuplicates(["doc_id", "text_hash"]).select("node", "text")
    sets = chosen.mapInArrow(_sets, "node long, shingles array<long>")
    nodes = stored(heads.select("node", "n_shingles", "marks").join(sets, "node"))

    first = members.filter("node <> lead").select(F.col("lead").alias("u"), F.col("node").alias("v"))
    links = stored(_confirmed(stored(_tested(first, nodes)), nodes))
    labels = components(links)
    late = stored(_late_links(stored(_apart(members, labels)), nodes))
    if not late.isEmpty():
        labels = components(links.unionByName(late))

    # A component goes by the smallest doc_id of its nodes, and of that one's texts by the least hash.
    groups = classes.select("set_key", "node", "head").join(_least_heads(labels, classes), "node", "left")
    groups = groups.select("set_key", F.coalesce("least", "head").alias("least"))

    out = table.select("doc_id", "text_hash", "n_shingles", "set_key").join(groups, "set_key", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("least.doc_id", "doc_id")).alias("component_id")
    out = out.withColumn("component_id", component).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    own = F.col("doc_id").isNull() | F.col("set_key").isNull() | (F.col("text_hash") == F.col("least.text_hash"))
    extra = ["text_hash", (F.col("kept") & own).alias("stays")]
    return out.select("doc_id", "n_shingles", "component_id", "kept", *(extra if rows else []))
