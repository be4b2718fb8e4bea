"""Quality classifier: random Fourier features, ridge regression, isotonic calibration.

Texts become a fixed number of document statistics, which a random cosine map turns into features whose
inner products approximate a Gaussian kernel. Every partition sums its part of the normal equations, per
fold; the sums are added up by matrix row and solved on the driver, whose share has a fixed size. Scores
of each fold by the model of the other folds are counted in fixed bins, over which isotonic regression
is fitted, so calibration never sees a score of a model that knew the row.

Nulls: a null text is empty and is scored like any text; labels that are null are skipped. Without
labels of both kinds every score is the mean label, or 0.5. Repeated rows and labels each count.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wiremere.llm import words
from wiremere.llm.tables import prepare, stored

FEATURES = 192
BANDWIDTH = 3.0
RIDGE = 1e-3
BINS = 400
FOLDS = 5
THRESHOLD = 0.3
TIE_BREAK = 0.02  # share of the score that keeps the order inside one isotonic step

_STOPS = (
    "the of and to in is that it a for was on as with be by this are at from "
    "und der die das den von zu mit sich auf de la le les et des un une que pour "
    "el en los se del las y no con"
).split()

STATISTICS = [
    "log_words",
    "word_length",
    "word_length_spread",
    "distinct_words",
    "repeated_neighbour",
    "stop_words",
    "upper_case",
    "capitalised",
    "digits",
    "symbols",
    "stops",
    "exclamations",
    "lone_symbols",
    "symbol_ends",
    "line_words",
    "distinct_lines",
    "spaces",
    "beyond_ascii",
]


def _class(chars: str) -> np.ndarray:
    return np.isin(np.arange(256), [ord(c) for c in chars])


_UPPER, _DIGIT = _class("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), _class("0123456789")
_LETTER = _UPPER | _class("abcdefghijklmnopqrstuvwxyz") | (np.arange(256) >= 128)
_STOP, _MARK = _class(".,;:"), _class("!?")
_SYMBOL = (np.arange(256) < 128) & (np.arange(256) > 32) & ~_LETTER & ~_DIGIT & ~_STOP & ~_MARK & ~_class("'\"()-")
_CODES = _STOP * 1 + _MARK * 2 + _SYMBOL * 3  # kinds of a word's last byte


def statistics(texts: pa.Array) -> np.ndarray:
    """One row of STATISTICS per text."""
    data, offsets = words.utf8(texts)
    n = len(offsets) - 1
    starts, ends, before = words.spans(~words.SPACES[data], offsets)
    word_row = np.repeat(np.arange(n), np.diff(before))
    n_bytes = np.maximum(np.diff(offsets), 1)
    n_words = np.maximum(np.diff(before), 1)

    def bytes_of(kind: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(kind[data])])
        return sums[offsets[1:]] - sums[offsets[:-1]]

    def words_of(flag: np.ndarray) -> np.ndarray:
        return np.bincount(word_row, flag, n) if len(flag) else np.zeros(n)

    length = (ends - starts).astype(float)
    code = _CODES[data[ends - 1]] if len(ends) else np.zeros(0)
    letters = np.concatenate([[0], np.cumsum(_LETTER[data])])
    uppers = np.concatenate([[0], np.cumsum(_UPPER[data])])
    word_letters = letters[ends] - letters[starts]
    word_uppers = uppers[ends] - uppers[starts]
    # Words without a trailing mark, so "of," counts as "of".
    cores = ends - ((code > 0) & (length > 1)) if len(ends) else ends
    key = words.hashes(words.LOWER[data], starts, cores) if len(starts) else np.zeros(0, np.uint64)
    order = np.lexsort((key, word_row))
    sorted_key, sorted_row = key[order], word_row[order]
    new = np.ones(len(key), bool)
    new[1:] = (sorted_key[1:] != sorted_key[:-1]) | (sorted_row[1:] != sorted_row[:-1])
    repeat = np.zeros(len(key), bool)
    repeat[1:] = (key[1:] == key[:-1]) & (word_row[1:] == word_row[:-1])
    stop_keys = np.array(sorted(words.hash_word(w) for w in _STOPS), np.uint64)
    at = np.minimum(np.searchsorted(stop_keys, key), len(stop_keys) - 1)

    line_starts, line_ends, line_before = words.spans(data != 10, offsets)
    lines = np.diff(line_before)
    line_key = words.hashes(data, line_starts, line_ends) if len(line_starts) else np.zeros(0, np.uint64)
    line_row = np.repeat(np.arange(n), lines)
    line_order = np.lexsort((line_key, line_row))
    new_line = np.ones(len(line_key), bool)
    new_line[1:] = (line_key[line_order][1:] != line_key[line_order][:-1]) | (line_row[line_order][1:] != line_row[line_order][:-1])

    mean = words_of(length) / n_words
    spread = np.sqrt(np.maximum(words_of(length**2) / n_words - mean**2, 0))
    columns = [
        np.log1p(np.diff(before)),
        np.log1p(mean),
        np.log1p(spread),
        np.bincount(sorted_row, new, n) / n_words,
        words_of(repeat) / n_words,
        words_of(stop_keys[at] == key) / n_words,
        bytes_of(_UPPER) / n_bytes,
        words_of((word_uppers > 0) & (word_uppers < word_letters)) / n_words,
        bytes_of(_DIGIT) / n_bytes,
        bytes_of(_SYMBOL) / n_bytes,
        words_of(code == 1) / n_words,
        bytes_of(_MARK) / n_bytes,
        words_of((code == 3) & (length == 1)) / n_words,
        words_of((code == 3) & (length > 1)) / n_words,
        np.log1p(np.diff(before) / np.maximum(lines, 1)),
        np.bincount(line_row, new_line[np.argsort(line_order)] if len(line_key) else None, n) / np.maximum(lines, 1),
        bytes_of(words.SPACES) / n_bytes,
        bytes_of(np.arange(256) >= 128) / n_bytes,
    ]
    # Square roots spread small shares, where most of the differences lie.
    return np.stack([c if i in (0, 1, 2, 14) else np.sqrt(c) for i, c in enumerate(columns)], axis=1)


def _statistics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start, end in words.slices(batch.column(1)):
            x = statistics(batch.column(1).slice(start, end - start)).astype(np.float32)
            flat = pa.array(np.ascontiguousarray(x).reshape(-1))
            bounds = pa.array(np.arange(0, (len(x) + 1) * len(STATISTICS), len(STATISTICS)), pa.int32())
            columns = [batch.column(0).slice(start, end - start), pa.ListArray.from_arrays(bounds, flat)]
            columns += [c.slice(start, end - start) for c in batch.columns[2:]]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "x", *batch.schema.names[2:]])


def document_statistics(docs: DataFrame, hashed: bool = False) -> DataFrame:
    """doc_id and statistics x, stored: texts are read once. With `hashed`, also the text's hash."""
    prepare(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    if hashed:
        texts = texts.withColumn("text_hash", F.xxhash64("text"))
    return stored(texts.mapInArrow(_statistics, "doc_id long, x array<float>" + ", text_hash long" * hashed))


def held_out(doc_id: Column) -> Column:
    """Rows that learning must not see."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


class Model:
    """Scale of the statistics, cosine map, ridge weights and calibration."""

    def __init__(self, mean: np.ndarray, spread: np.ndarray):
        rng = np.random.default_rng(11)
        self.mean, self.spread = mean, spread
        self.directions = rng.normal(0, 1 / BANDWIDTH, (len(STATISTICS), FEATURES))
        self.phases = rng.uniform(0, 2 * np.pi, FEATURES)
        self.weights = np.zeros(FEATURES + 1)
        self.steps = self.levels = np.zeros(0)

    def features(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.spread, -6, 6)
        waves = np.sqrt(2 / FEATURES) * np.cos(z @ self.directions + self.phases)
        return np.hstack([waves, np.ones((len(x), 1))])

    def score(self, raw: np.ndarray) -> np.ndarray:
        level = np.interp(raw, self.steps, self.levels) if len(self.steps) else np.full(len(raw), 0.5)
        return (1 - TIE_BREAK) * level + TIE_BREAK / (1 + np.exp(-4 * (np.clip(raw, -2, 3) - 0.5)))


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1).astype(float)


def _equations(model: Model):
    """Partition sums of the normal equations: one row per fold and matrix row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = FEATURES + 1
        sums = np.zeros((FOLDS, size, size + 1))
        for batch in batches:
            if batch.num_rows:
                z, y = model.features(_matrix(batch.column(0))), batch.column(1).to_numpy().astype(float)
                fold = batch.column(2).to_numpy()
                for f in np.unique(fold):
                    some = z[fold == f]
                    sums[f] += some.T @ np.hstack([some, y[fold == f, None]])
        used = np.flatnonzero(sums[:, -1, -2])
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(used, size), pa.int32()),
                pa.array(np.tile(np.arange(size), len(used)), pa.int32()),
                pa.array(list(sums[used].reshape(-1, size + 1)), pa.list_(pa.float64())),
            ],
            ["fold", "row", "sums"],
        )

    return run


def _added(key, batch):
    total = _matrix(batch.column("sums").combine_chunks()).sum(axis=0)
    schema = pa.schema([("fold", pa.int32()), ("row", pa.int32()), ("sums", pa.list_(pa.float64()))])
    return pa.table({"fold": [key[0].as_py()], "row": [key[1].as_py()], "sums": [total]}, schema)


def _solve(sums: np.ndarray) -> np.ndarray:
    a, b = sums[:, :-1], sums[:, -1]
    return np.linalg.solve(a + RIDGE * max(a[-1, -1], 1.0) * np.eye(len(a)), b)


def isotonic(scores: np.ndarray, mean: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: the nearest non-decreasing levels to means at growing scores."""
    pools: list[list[float]] = []
    for s, m, w in zip(scores, mean, weight):
        pools.append([m, w, s * w])
        while len(pools) > 1 and pools[-2][0] >= pools[-1][0]:
            m2, w2, s2 = pools.pop()
            m1, w1, s1 = pools.pop()
            pools.append([(m1 * w1 + m2 * w2) / (w1 + w2), w1 + w2, s1 + s2])
    return np.array([p[2] / p[1] for p in pools]), np.array([p[0] for p in pools])


def fit(rows: DataFrame) -> Model:
    """Fit on rows (x, label, fold with values below FOLDS); all of them, at any number.

    What reaches the driver has a fixed size: sums of statistics, one matrix per fold, binned scores.
    """
    rows = stored(rows)
    each = [F.col("x")[i].cast("double") for i in range(len(STATISTICS))]
    sums = rows.agg(F.count("*"), F.avg("label"), *[F.avg(c) for c in each], *[F.stddev_pop(c) for c in each]).first()
    count, base = sums[0], sums[1]
    k = len(STATISTICS)
    if not count or base in (0.0, 1.0):
        model = Model(np.zeros(k), np.ones(k))
        model.steps, model.levels = np.array([0.0]), np.array([0.5 if base is None else base])
        return model
    model = Model(np.array(sums[2 : k + 2]), np.maximum(np.array(sums[k + 2 :]), 1e-6))
    partial = rows.select("x", F.col("label").cast("double"), F.col("fold").cast("int")).mapInArrow(
        _equations(model), "fold int, row int, sums array<double>"
    )
    added = partial.groupBy("fold", "row").applyInArrow(_added, "fold int, row int, sums array<double>").collect()
    size = FEATURES + 1
    folds = np.zeros((FOLDS, size, size + 1))
    for r in added:
        folds[r["fold"], r["row"]] = r["sums"]
    total = folds.sum(axis=0)
    model.weights = _solve(total)
    without = np.stack([_solve(total - f) if f.any() and not np.allclose(f, total) else model.weights for f in folds])

    @F.pandas_udf("int")
    def bin_of(x, fold):
        z = model.features(np.stack(x.to_numpy()))
        raw = np.einsum("ij,ij->i", z, without[fold.to_numpy()])
        return type(fold)(np.clip(((raw + 1) / 3 * BINS).astype(int), 0, BINS - 1), dtype="int32")

    binned = rows.select(bin_of("x", F.col("fold").cast("int")).alias("bin"), "label").groupBy("bin")
    bins = sorted(binned.agg(F.avg("label"), F.count("*")).collect())
    at, mean, weight = (np.array(c, float) for c in zip(*bins))
    model.steps, model.levels = isotonic((at + 0.5) / BINS * 3 - 1, mean, weight)
    return model


def scored(rows: DataFrame, model: Model) -> DataFrame:
    """rows with `score`, from their statistics x."""

    @F.pandas_udf("double")
    def score(x):
        return type(x)(model.score(model.features(np.stack(x.to_numpy())) @ model.weights)) if len(x) else x.astype(float)

    return rows.withColumn("score", score("x"))


def classify(docs: DataFrame, labels: DataFrame, hashed: bool = False) -> DataFrame:
    """doc_id, held_out, score and predicted per row of docs, fitted on labels (doc_id, quality).

    With `hashed`, also text_hash, which tells rows without doc_id or of one doc_id apart.
    """
    rows = document_statistics(docs, hashed)
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("double").alias("label"))
    known = known.filter(F.col("label").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    # The row's own fold comes from its id, as the held-out rows do.
    fold = (F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS).cast("int")
    model = fit(rows.join(known, "doc_id").select("x", "label", fold.alias("fold")))
    result = scored(rows, model).withColumn("held_out", held_out(F.col("doc_id")))
    predicted = (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    return result.select("doc_id", "held_out", "score", predicted, *["text_hash"] * hashed)
