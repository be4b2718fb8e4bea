"""Document fingerprints from spot signatures.

A spot is a common word with the chain of content words that follow it. A document's fingerprint is the
sorted set of its spots' hashes, written in hexadecimal; equal texts have equal fingerprints, and the
likeness of two documents is the Jaccard similarity of their sets. The start of a text counts as a
common word too, so every text with words has a spot; a text without any has the empty fingerprint.
Likeness of two empty fingerprints is 1.

Common words are a fixed list and the COMMON words that stand in the most documents, counted over all of
them, if in one of SHARE documents at least; ties go to the smaller hash. The rule is the same for a table of
any size, and a table that holds each row several times has the fingerprints of the rows taken once. Content words that no chain reaches begin chains of their own: the first of
such a run, and the word of least hash of every CHAIN in a row, so that an edit changes the chains around
it only. Words left over at the end of a text, where chains are cut off, form chains among themselves.
Thus spots cover the whole text, but for one or two left-over words that hold a common one.

No query runs `similar_pairs`. Its pairs of similar documents are found over partitions by set length: a document can only meet those of
its own and the next partition. Inside them, documents meet through the rarest of their spots, so many
as a similar pair cannot avoid to share, and a comparison is pruned by lengths and by the place where
the shared spot stands.

Nulls: a null text is empty. Rows are ordered by doc_id (null last), then by text hash; repeated rows
are neighbours of each other.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wiremere.llm import words
from wiremere.llm.tables import prepare, stored

CHAIN = 3
STEP = 1
THRESHOLD = 75  # hundredths
HEX = 8  # digits per spot
COMMON = 100  # most frequent words that are anchors too
SHARE = 50  # such a word stands in one of so many documents, at least

ANCHORS = (
    "the of and to in is that it a for was on as with be by this are at from "
    "der die und das den von zu mit sich des auf für ist im dem nicht ein eine "
    "de la le les et des un une du en que pour dans est au il qui sur pas par "
    "el los las y del se por con una su para no es al lo como"
).split()


def frequent(docs: DataFrame) -> np.ndarray:
    """Hashes of the COMMON words that stand in the most rows of docs, in one of SHARE at least."""
    prepare(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(0)
            for start, end in words.slices(column):
                data, offsets = words.utf8(column.slice(start, end - start))
                starts, ends, before = words.spans(words.ALNUM[data], offsets)
                word = words.hashes(words.LOWER[data], starts, ends) if len(starts) else np.zeros(0, np.uint64)
                row = np.repeat(np.arange(len(before) - 1), np.diff(before))
                order = np.argsort(word, kind="stable")
                word, row = word[order], row[order]
                new = np.ones(len(word), bool)
                new[1:] = (word[1:] != word[:-1]) | (row[1:] != row[:-1])
                value, n = np.unique(word[new], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(value.view(np.int64)), pa.array(n, pa.int64())], ["word", "n"])

    counts = docs.select(F.col("text").cast("string")).mapInArrow(count, "word long, n long")
    counts = counts.groupBy("word").agg(F.sum("n").alias("n"))
    rows = counts.orderBy(F.col("n").desc(), "word").limit(COMMON).collect()
    least = docs.count() / SHARE if rows else 0
    return np.array([r["word"] for r in rows if r["n"] >= least], np.int64).view(np.uint64)


def _restarts(word: np.ndarray, run: np.ndarray) -> np.ndarray:
    """Where chains begin in runs of words: at each run's first, and at the least of every CHAIN in a row."""
    first = np.flatnonzero(np.diff(run, prepend=-1))
    window = np.flatnonzero(run[: 1 - CHAIN] == run[CHAIN - 1 :])
    least = window + word[window[:, None] + np.arange(CHAIN)].argmin(axis=1)
    return np.unique(np.concatenate([first, least]))


def spot_sets(texts: pa.Array, anchors: list[str] = ANCHORS, learned: np.ndarray | None = None) -> list[np.ndarray]:
    """Sorted distinct 32-bit spot hashes of every text; `learned` are hashes of further anchors."""
    data, offsets = words.utf8(texts)
    starts, ends, before = words.spans(words.ALNUM[data], offsets)
    n = len(offsets) - 1
    if not len(starts):
        return [np.zeros(0, np.uint32)] * n
    word = words.hashes(words.LOWER[data], starts, ends)
    common = np.array([words.hash_word(a) for a in anchors], np.uint64)
    common = np.unique(common if learned is None else np.concatenate([common, learned]))
    is_anchor = common[np.minimum(np.searchsorted(common, word), len(common) - 1)] == word
    content = np.flatnonzero(~is_anchor)
    first = np.searchsorted(content, before)  # content words before each text
    anchor = np.flatnonzero(is_anchor)
    row = np.searchsorted(before, anchor, side="right") - 1
    # Texts whose rows are empty share an offset with the next; side="right" picks the last of them.
    begin = np.searchsorted(content, anchor)
    whole = begin + (CHAIN - 1) * STEP < first[row + 1]
    anchor, row, begin = anchor[whole], row[whole], begin[whole]
    spot = word[anchor]
    covered = np.zeros(len(word), bool)
    covered[anchor] = True
    for k in range(CHAIN):
        spot = words.mix(spot * np.uint64(0x9E3779B97F4A7C15) + word[content[begin + k * STEP]])
        covered[content[begin + k * STEP]] = True
    # The start of a text: its first content words, or first words if it has none.
    heads = [content[a : min(a + CHAIN, b)] for a, b in zip(first, first[1:])]
    heads = [h if len(h) else np.arange(a, min(a + CHAIN, b)) for h, a, b in zip(heads, before, before[1:])]
    covered[np.concatenate(heads)] = True
    # Content words that no chain has reached.
    free = np.flatnonzero(~covered[content])
    owner = np.searchsorted(first, free, side="right") - 1
    run = np.cumsum((np.diff(free, prepend=-2) > 1) | (np.diff(owner, prepend=-1) > 0))
    again = _restarts(word[content[free]], run)
    again, owner = free[again], owner[again]
    whole = again + CHAIN <= first[owner + 1]
    again, owner = again[whole], owner[whole]
    for k in range(CHAIN):
        covered[content[again + k]] = True
    # What is left over at the ends.
    left = np.flatnonzero(~covered)
    at = np.searchsorted(left, before)
    holder = np.searchsorted(before, left, side="right") - 1
    last = at[holder + 1]
    tail = _restarts(word[left], holder)
    tail = np.union1d(tail[tail + CHAIN <= last[tail]], at[1:][np.diff(at) >= CHAIN] - CHAIN)
    values = [spot, words.chain(word[content], again, CHAIN), words.chain(word[left], tail, CHAIN)]
    rows = np.concatenate([row, owner, holder[tail]])
    order = np.argsort(rows, kind="stable")
    spot, row = np.concatenate(values)[order], rows[order]
    cuts = np.searchsorted(row, np.arange(n + 1))
    out = []
    for r in range(n):
        found = [spot[cuts[r] : cuts[r + 1]]]
        if len(heads[r]):
            found.append(_folded(word[heads[r]]))
        end = left[at[r] : at[r + 1]]
        if 0 < len(end) < CHAIN and not is_anchor[end].any():
            found.append(_folded(word[end]))
        out.append(np.unique((np.concatenate(found) >> np.uint64(32)).astype(np.uint32)))
    return out


def _folded(values: np.ndarray) -> np.ndarray:
    total = np.full(1, len(values), np.uint64)
    for v in values:
        total = words.mix(total * np.uint64(0x9E3779B97F4A7C15) + v)
    return total


def written(spots: np.ndarray) -> str:
    return spots.astype(">u4").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of two sorted sets."""
    if not len(a) and not len(b):
        return 1.0
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def fingerprints(docs: DataFrame) -> DataFrame:
    """docs with `fingerprint`, in place of a column of that name."""
    prepare(docs.sparkSession)
    learned = frequent(docs)

    @F.pandas_udf("string")
    def of(texts):
        array = pa.array(texts, pa.large_string())
        found = [written(s) for a, b in words.slices(array) for s in spot_sets(array.slice(a, b - a), learned=learned)]
        return type(texts)(found, dtype=object)

    return docs.withColumn("fingerprint", of(F.coalesce(F.col("text").cast("string"), F.lit(""))))


# ---- a document, its edited text and its neighbour ----

NEIGHBOURS = (
    "doc_id long, n_chars long, edited_text string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def _neighbours(batches: Iterator[pa.RecordBatch], learned: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Rows of (bucket, guest, doc_id, text), sorted, with the next bucket's head as guest at the end."""
    carry: list[tuple] = []
    names = ["doc_id", "n_chars", "edited_text", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    for batch in batches:
        for start, end in words.slices(batch.column(3), 1 << 19):
            part = batch.slice(start, end - start)
            rows = carry + list(zip(*[c.to_pylist() for c in part.columns]))
            carry = rows[-1:]
            if len(rows) < 2:
                continue
            own = [r[3] or "" for r in rows]
            sets = spot_sets(pa.array(own, pa.large_string()), learned=learned)
            # A row is followed by its neighbour; guests are only followed, and not by another bucket.
            at = [i for i in range(len(rows) - 1) if not rows[i][1] and rows[i][0] == rows[i + 1][0]]
            edited = []
            for i in at:
                k = len(own[i]) // 3
                edited.append(own[i][: len(own[i]) - k] + own[i + 1][:k])
            changed = spot_sets(pa.array(edited, pa.large_string()), learned=learned)
            if at:
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([rows[i][2] for i in at], pa.int64()),
                        pa.array([len(own[i]) for i in at], pa.int64()),
                        pa.array(edited, pa.string()),
                        pa.array([written(sets[i]) for i in at]),
                        pa.array([written(c) for c in changed]),
                        pa.array([likeness(sets[i], c) for i, c in zip(at, changed)]),
                        pa.array([likeness(sets[i], sets[i + 1]) for i in at]),
                    ],
                    names,
                )


def with_neighbours(docs: DataFrame) -> DataFrame:
    """Every document with its edited text, both fingerprints and their likeness to it and its neighbour.

    The neighbour is the next document by falling doc_id, after the last the first. The edited text
    has its last third replaced by the neighbour's beginning. Texts are range-shuffled once; the
    first row of every range is copied to the end of the range before it.
    """
    spark = docs.sparkSession
    prepare(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    learned = frequent(rows)
    least = -(1 << 63)
    rows = rows.withColumns({"key": F.coalesce("doc_id", F.lit(least)), "h": F.xxhash64("text")})
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shares = [i / ranges for i in range(1, ranges)]
    bounds = rows.agg(F.percentile_approx("key", shares, 10 * ranges).alias("b")).first()["b"] if shares else []
    bounds = np.array(sorted(set(bounds or [])), np.int64)

    @F.pandas_udf("int")
    def bucket(key):
        return type(key)(len(bounds) - np.searchsorted(bounds, key.to_numpy(), side="left"), dtype="int32")

    rows = rows.withColumn("bucket", bucket("key"))
    # Narrow: one head per range reaches the driver.
    heads = rows.groupBy("bucket").agg(F.max(F.struct("key", "h")).alias("head")).orderBy("bucket").collect()
    if not heads:
        return spark.createDataFrame([], NEIGHBOURS)
    after = {r["bucket"]: heads[i - 1]["bucket"] for i, r in enumerate(heads)}  # where a head is guest
    guest_of = F.create_map(*[F.lit(x) for pair in after.items() for x in pair])

    def head(field):
        found = F.create_map(*[F.lit(x) for r in heads for x in (r["bucket"], r["head"][field])])
        return F.element_at(found, F.col("bucket"))

    is_head = (F.col("key") == head("key")) & (F.col("h") == head("h"))
    own = F.struct(F.col("bucket").alias("at"), F.lit(False).alias("guest"))
    guest = F.struct(F.element_at(guest_of, F.col("bucket")).alias("at"), F.lit(True).alias("guest"))
    places = F.when(is_head, F.array(own, guest)).otherwise(F.array(own))
    dealt = rows.withColumn("place", F.explode(places))
    dealt = dealt.select(F.col("place.at").alias("bucket"), F.col("place.guest").alias("guest"), "doc_id", "text", "key", "h")
    dealt = dealt.repartitionById(len(bounds) + 1, "bucket")
    dealt = dealt.sortWithinPartitions("bucket", "guest", F.col("key").desc(), F.col("h").desc())
    return dealt.select("bucket", "guest", "doc_id", "text").mapInArrow(lambda batches: _neighbours(batches, learned), NEIGHBOURS)


# ---- similar pairs ----

def length_partition(size, threshold: int = THRESHOLD):
    """Partitions whose bounds grow by 1 / threshold: similar sets are in equal or adjacent ones."""
    return F.floor(F.log(size) / F.log(F.lit(100.0 / threshold)) + F.lit(1e-9)).cast("long")


def similar_pairs(docs: DataFrame, threshold: int = THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """Classes of equal fingerprints (doc_id, class_id) and similar pairs of classes (u, v, likeness).

    Copies of one fingerprint are one class, named by its smallest doc_id, and are not expanded.
    """
    table = stored(fingerprints(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")).select("doc_id", "fingerprint"))
    classes = table.groupBy("fingerprint").agg(F.min("doc_id").alias("class_id"))
    members = table.join(classes, "fingerprint").select("doc_id", "class_id")
    spot = f"substr(fingerprint, i * {HEX} + 1, {HEX})"
    spots = F.expr(f"transform(sequence(0, length(fingerprint) div {HEX} - 1), i -> {spot})")
    heads = stored(classes.filter("length(fingerprint) > 0 and class_id is not null").select("class_id", spots.alias("spots")))
    counts = heads.select(F.explode("spots").alias("spot")).groupBy("spot").agg(F.count("*").alias("n"))
    # Each class's spots by rarity; a similar pair shares one of the first size - ceil(t * size) + 1.
    rows = heads.select("class_id", F.size("spots").alias("size"), F.explode("spots").alias("spot")).join(counts, "spot")
    ordered = rows.groupBy("class_id", "size").agg(F.array_sort(F.collect_list(F.struct("n", "spot"))).alias("o"))
    prefix = F.col("size") - F.ceil(F.col("size") * threshold / F.lit(100)) + 1
    rarest = F.posexplode(F.slice("o", F.lit(1), prefix.cast("int"))).alias("pos", "s")
    part = length_partition(F.col("size"), threshold).alias("part")
    probes = ordered.select("class_id", "size", rarest)
    probes = stored(probes.select("class_id", "size", "pos", F.col("s.spot").alias("spot"), part))
    side = lambda n: [F.col("class_id").alias(n), F.col("size").alias(f"n{n}"), F.col("pos").alias(f"p{n}"), "spot"]
    left = probes.select(*side("u"), F.explode(F.array("part", F.col("part") + 1)).alias("part"))
    right = probes.select(*side("v"), "part")
    shorter = (F.col("nu") < F.col("nv")) | ((F.col("nu") == F.col("nv")) & (F.col("u") < F.col("v")))
    # What is left after the shared spot bounds the overlap.
    most = F.least(F.col("nu") - F.col("pu"), F.col("nv") - F.col("pv"))
    need = F.col("nu") + F.col("nv")
    met = left.join(right, ["spot", "part"]).filter(
        shorter & (F.col("nu") * 100 >= F.col("nv") * threshold) & (most * (100 + threshold) >= need * threshold)
    )
    pairs = met.select("u", "v").distinct()
    side = lambda n: heads.select(F.col("class_id").alias(n), F.col("spots").alias(f"s{n}"))
    both = F.size(F.array_intersect("su", "sv"))
    joined = pairs.join(side("u"), "u").join(side("v"), "v").withColumn("both", both)
    joined = joined.withColumn("likeness", F.col("both") / (F.size("su") + F.size("sv") - F.col("both")))
    found = joined.filter(F.col("likeness") * 100 >= threshold - 1e-9)
    return members, found.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"), "likeness")
