"""Exact top-k search by inner product with block-at-a-time pruning.

Vectors are lists of integer terms. They lie in ranges of ids, one partition each, and a range is cut
into blocks; a block keeps its vectors as a forward index (a matrix) and the largest and smallest value
of each term. For a query, the sum over its terms of the larger of value times maximum and value times
minimum bounds every score in a block. Blocks are visited by falling bound, and a query leaves a range
when the bound of the next block falls below its k-th score. Queries meet every range in chunks of a
fixed size, so no task holds more than one range and one chunk.

Ties go to the smaller id. Vectors that are null, empty or hold null or non-finite components take no part.
Vectors meet those of their own length. Components are whole numbers in doubles, which hold them exactly
whatever their size, and scores are sums of exact integers; one beyond a long is given as the largest or
smallest long. Repeated ids are rows of their own; a query skips its own id.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wiremere.llm.tables import prepare, stored

SCALE = 1024
EVERY = 100
K = 10
RANGE_ROWS = 8192
BLOCK_ROWS = 256
BLOCK_BYTES = 1 << 17  # a block of long vectors has fewer rows
CHUNK_ROWS = 512
LEAST, MOST = -(1 << 63), (1 << 63) - 1  # larger scores are given as these


def terms(vectors: DataFrame, column: str = "embedding", scale: int = SCALE) -> DataFrame:
    """(vec_id, width, x): the components of usable vectors as doubles."""
    x = F.transform(F.col(column), lambda v: v.cast("double"))
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    usable = vectors.filter(F.col(column).isNotNull() & F.col("vec_id").isNotNull() & (F.size(column) > 0))
    usable = usable.filter(F.coalesce(finite, F.lit(False)))
    return usable.select(F.col("vec_id").cast("long").alias("vec_id"), F.size(column).alias("width"), x.alias("x"))


def _matrix(column: pa.Array, scale: int) -> np.ndarray:
    """floor(scale * x) in doubles; what would be beyond the largest double counts as that."""
    x = column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)
    with np.errstate(over="ignore"):
        return np.nan_to_num(np.floor(x * scale))


def _packed(most_rows: int, most_bytes: int, scale: int):
    """A partition, sorted by width and id, as blocks of equally long vectors: ids, matrix, term minima and maxima."""

    def row(table: pa.Table) -> pa.RecordBatch:
        ids = table.column("vec_id").to_numpy()
        matrix = _matrix(table.column("x").combine_chunks(), scale)
        parts = [ids.astype("<i8"), *[m.astype("<f8") for m in (matrix, matrix.min(axis=0), matrix.max(axis=0))]]
        return pa.RecordBatch.from_arrays(
            [table.column("part")[:1].combine_chunks(), *[pa.array([p.tobytes()], pa.binary()) for p in parts]],
            ["part", "ids", "matrix", "least", "most"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest, now = None, 0
        for batch in batches:
            widths = batch.column("width").to_numpy()
            cuts = [0, *np.flatnonzero(np.diff(widths)) + 1, len(widths)]
            for start, end in zip(cuts, cuts[1:]):
                if start == end:
                    continue
                if rest is not None and rest.num_rows and widths[start] != now:
                    yield row(rest)
                    rest = None
                now = int(widths[start])
                table = pa.Table.from_batches([batch.slice(start, end - start)])
                rest = table if rest is None else pa.concat_tables([rest, table])
                n = max(1, min(most_rows, most_bytes // (8 * now)))
                while rest.num_rows >= n:
                    yield row(rest.slice(0, n))
                    rest = rest.slice(n)
        if rest is not None and rest.num_rows:
            yield row(rest)

    return run


PACKED = "part int, ids binary, matrix binary, least binary, most binary"


def _numbers(data: bytes) -> np.ndarray:
    return np.frombuffer(data, "<f8")


def _whole(matrix: np.ndarray, kind: type) -> np.ndarray:
    """Whole numbers as doubles, 64-bit or unbounded integers."""
    return np.frompyfunc(int, 1, 1)(matrix) if kind is object else matrix.astype(kind)


def search(ids: np.ndarray, queries: np.ndarray, blocks: list[tuple], k: int) -> list[tuple]:
    """As `exact_search`, with scores as longs."""
    return [(a, b, np.array([_clipped(s) for s in scores], np.int64)) for a, b, scores in exact_search(ids, queries, blocks, k)]


def _clipped(score: int) -> int:
    return min(max(score, LEAST), MOST)


def _beyond(score: int) -> str:
    """A text that orders scores which are one long: larger ones after smaller ones."""
    if LEAST <= score <= MOST:
        return "~" if score < 0 else ""
    digits = f"{len(str(abs(score))):06d}{abs(score)}"
    return digits if score > 0 else digits.translate(str.maketrans("0123456789", "9876543210"))


def exact_search(ids: np.ndarray, queries: np.ndarray, blocks: list[tuple], k: int) -> list[tuple]:
    """The k best (query, id, score) per query among blocks (ids, matrix, least, most).

    Products are exact: sums of fewer than 2**53 in doubles, else integers.
    """
    width = queries.shape[1]
    size = max([int(np.abs(queries).max(initial=0)), *[int(np.abs(b[1]).max(initial=0)) for b in blocks]])
    kind = np.float64 if size * size * width < 2**53 else object if size * size * width >= 2**63 else np.int64
    q = _whole(queries, kind)
    rising, falling = np.maximum(q, 0), np.minimum(q, 0)
    bounds = np.stack([rising @ _whole(most, kind) + falling @ _whole(least, kind) for _, _, least, most in blocks], axis=1)
    order = np.argsort(-bounds, axis=1, kind="stable")
    top_score = np.full((len(q), k), -np.inf, dtype=np.float64 if kind is np.float64 else object)
    top_id = np.full((len(q), k), np.iinfo(np.int64).max)
    active = np.arange(len(q))
    for step in range(len(blocks)):
        active = active[bounds[active, order[active, step]] >= top_score[active, -1]]
        if not len(active):
            break
        # Queries whose next block is the same score it together.
        for b in np.unique(order[active, step]):
            some = active[order[active, step] == b]
            vec_ids, matrix, _, _ = blocks[b]
            scores = (q[some] @ _whole(matrix, kind).T).astype(top_score.dtype)
            scores[vec_ids[None, :] == ids[some, None]] = -np.inf
            all_scores = np.hstack([top_score[some], scores])
            all_ids = np.hstack([top_id[some], np.broadcast_to(vec_ids, scores.shape)])
            for n, row in enumerate(some):
                best = np.lexsort((all_ids[n], -all_scores[n]))[:k]
                top_score[row], top_id[row] = all_scores[n][best], all_ids[n][best]
    row, rank = np.nonzero(top_score > -np.inf)
    return [(ids[row], top_id[row, rank], [int(s) for s in top_score[row, rank]])]


def _searched(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Rows arrive by range and queries' range; the chunks of queries come before the blocks they meet.
        now, chunks, blocks = None, [], []

        def answer() -> Iterator[pa.RecordBatch]:
            for ids, asked in chunks:
                own = [b for b in blocks if b[1].shape[1] == asked.shape[1]]
                for query, vec, scores in exact_search(ids, asked, own, k) if own else []:
                    given = [pa.array([f(s) for s in scores], t) for f, t in ((_clipped, pa.int64()), (_beyond, pa.string()))]
                    yield pa.RecordBatch.from_arrays([pa.array(query), pa.array(vec), *given], ["query_id", "vec_id", "score", "beyond"])

        for batch in batches:
            for r in batch.to_pylist():
                if (r["part"], r["chunk"]) != now:
                    yield from answer()
                    now, chunks, blocks = (r["part"], r["chunk"]), [], []
                ids = np.frombuffer(r["ids"], "<i8")
                matrix = _numbers(r["matrix"]).reshape(len(ids), -1)
                if r["query"]:
                    chunks.append((ids, matrix))
                elif chunks:
                    blocks.append((ids, matrix, _numbers(r["least"]), _numbers(r["most"])))
        yield from answer()

    return run


def top_k(vectors: DataFrame, every: int = EVERY, k: int = K, scale: int = SCALE) -> DataFrame:
    """query_id, rank, vec_id, score: the k best of all other rows for each vec_id divisible by `every`."""
    prepare(vectors.sparkSession)
    table = stored(terms(vectors, scale=scale))
    asked_for = F.count_if(F.col("vec_id") % every == 0)
    counts = table.agg(F.count("*"), asked_for).first()
    if not counts[1]:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    ranges, chunks = -(-counts[0] // RANGE_ROWS), -(-counts[1] // CHUNK_ROWS)

    def packed(rows: DataFrame, n: int, most_rows: int, most_bytes: int) -> DataFrame:
        parts = rows.repartitionByRange(n, "width", "vec_id").sortWithinPartitions("width", "vec_id")
        return stored(parts.withColumn("part", F.spark_partition_id()).mapInArrow(_packed(most_rows, most_bytes, scale), PACKED))

    index = packed(table, ranges, BLOCK_ROWS, BLOCK_BYTES)
    asked = packed(table.filter(F.col("vec_id") % every == 0), chunks, CHUNK_ROWS, 8 * BLOCK_BYTES)
    # Numbers of partitions, of which some may be empty.
    last = lambda packed: packed.agg(F.coalesce(F.max("part"), F.lit(0))).first()[0]
    every_part, every_chunk = (F.explode(F.sequence(F.lit(0), F.lit(last(p)))) for p in (index, asked))
    columns = ["part", "chunk", "query", "ids", "matrix", "least", "most"]
    queries = asked.withColumnRenamed("part", "chunk").withColumns({"part": every_part, "query": F.lit(True)}).select(columns)
    blocks = index.withColumns({"chunk": every_chunk, "query": F.lit(False)}).select(columns)
    met = queries.unionByName(blocks).repartition("part", "chunk")
    met = met.sortWithinPartitions("part", "chunk", F.col("query").desc())
    found = met.mapInArrow(_searched(k), "query_id long, vec_id long, score long, beyond string")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("beyond").desc(), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
