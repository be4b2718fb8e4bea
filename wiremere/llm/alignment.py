"""Alignment of two tokenizers over a corpus, each distinct text once.

Texts are shuffled whole, so that equal ones meet: each distinct text is tokenised and aligned once and
carries its multiplicity. Tokens of both vocabularies cover the same bytes (a space and the text), so two
tokens are linked where their byte ranges overlap, and every cut of either tokenizer ends one link. A pair of
ids counts the documents that hold it linked, copies included. The counts then return to the texts, and the
texts' measures go to the doc_ids by the text's SHA-256.

Texts of a task are taken in blocks of some megabytes. A block lists its distinct pairs once, so pairs are
summed before they are shuffled, a pair has at most one row per block, and the counts go back to the block,
not to each text. Within a block a word (what stands between single spaces) is tokenised once: neither
vocabulary has a token across the place where a space follows a visible character. Texts with any other
arrangement of white space, or with a word whose tokens do not give back its bytes, are tokenised whole.

Nulls and empty texts have no tokens, and so have texts that a vocabulary does not give back byte by byte:
zeros, and an empty digest. A row without doc_id counts as a document and returns without doc_id. Repeated
rows are documents of their own. An empty table gives an empty result. Other columns are left out. A block
may be longer than its bound by one text; long texts are never cut.
"""

import hashlib
import re
from collections.abc import Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wiremere.llm.tables import prepare, stored

BLOCK_BYTES = 4 << 20
PAIRS_A_ROW = 8192
UNITS_AT_ONCE = 4096
MEASURES = ["n_a", "n_b", "n_groups", "n_links"]
ALIGNED = (
    "block long, text_key binary, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    "held binary, times binary, first int, pairs array<long>, documents array<long>"
)
ODD_SPACE = re.compile(r"[^\S ] ")


def vocabulary_paths() -> tuple[str, str]:
    """The byte and the piece vocabulary of the installed public tokenizers."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def pieces(path: str) -> int:
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path).get_piece_size()


def byte_alphabet() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for.

    Printable Latin-1 characters stand for themselves, the other bytes for characters from 256 on.
    """
    printed = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in printed]
    return {chr(b): b for b in printed} | {chr(256 + i): b for i, b in enumerate(rest)}


def _sum_per_unit(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(values)])
    return sums[offsets[1:]] - sums[offsets[:-1]]


def ragged(offsets: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the given rows' entries, one row after the other, and the rows' bounds among them."""
    sizes = offsets[rows + 1] - offsets[rows]
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    return np.arange(bounds[-1]) + np.repeat(offsets[rows] - bounds[:-1], sizes), bounds


class Units:
    """Aligned pieces of text: counts per unit, links and written groups, one unit after the other."""

    def __init__(self, good: np.ndarray, counts: dict[str, np.ndarray], pairs: np.ndarray, groups: list[bytes]):
        self.good = good  # whether both vocabularies give the unit back; the rest is of good units only
        self.place = np.cumsum(good) - 1
        self.counts = counts
        self.pairs = pairs
        self.offsets = np.concatenate([[0], np.cumsum(counts["n_links"])]).astype(np.int64)
        self.groups = groups


class Aligner:
    """Both tokenizers, with the bytes of their tokens; `of` keeps one per process."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        alphabet = byte_alphabet()
        names = {i: t for t, i in self.a.get_vocab(with_added_tokens=False).items()}
        self.bytes_a = [bytes(alphabet[c] for c in names.get(i, "")) for i in range(max(names) + 1)]
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.size_b = len(pieces)
        self.span = len(self.bytes_a) * len(self.bytes_b)  # a pair of ids is one number below it
        # Words can be taken apart only if no piece goes on after a space that follows something else.
        self.by_words = not any(re.search("[^▁]▁", p) for p in pieces)
        self.long_a, self.long_b = (np.array([len(t) for t in table], np.int64) for table in (self.bytes_a, self.bytes_b))
        ids = [str(i).encode() for i in range(max(len(self.bytes_a), self.size_b))]
        self.n_digits = np.array([len(i) for i in ids], np.int64)
        self.digits = np.zeros((len(ids), int(self.n_digits.max())), np.uint8)
        for i, digits in enumerate(ids):
            self.digits[i, : len(digits)] = list(digits)

    @staticmethod
    @cache
    def of(path_a: str, path_b: str) -> "Aligner":
        return Aligner(path_a, path_b)

    def _tokens(self, ids: list[list[int]], table: list[bytes], raw: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Flat ids, their number per unit, and which units' tokens give back their bytes."""
        flat = list(chain.from_iterable(ids))
        given = [table[i] for i in flat]
        numbers = np.fromiter(map(len, ids), np.int64, len(ids))
        good = np.ones(len(ids), bool)
        if b"".join(given) != b"".join(raw):
            ends = np.cumsum(numbers).tolist()
            good[:] = [b"".join(given[e - n : e]) == r for e, n, r in zip(ends, numbers.tolist(), raw)]
        else:
            sizes = np.fromiter(map(len, given), np.int64, len(given))
            good &= _sum_per_unit(sizes, np.concatenate([[0], np.cumsum(numbers)])) == [len(r) for r in raw]
        return np.array(flat, np.int32), numbers, good

    def _encoded(self, units: list[str]) -> Iterator[tuple]:
        """Units in portions: the libraries' own results take many times the room of the ids."""
        for start in range(0, len(units), UNITS_AT_ONCE):
            some = units[start : start + UNITS_AT_ONCE]
            spaced = [" " + u for u in some]
            raw = [s.encode() for s in spaced]
            a = self._tokens([e.ids for e in self.a.encode_batch_fast(spaced, add_special_tokens=False)], self.bytes_a, raw)
            b = self._tokens(self.b.encode(some, num_threads=1), self.bytes_b, raw)
            good = a[2] & b[2]
            yield good, a[0][np.repeat(good, a[1])], b[0][np.repeat(good, b[1])], a[1][good], b[1][good], np.array([len(r) for r in raw])[good]

    def align(self, units: list[str]) -> Units:
        """Tokens, groups and links of every unit, each read as a space and the unit."""
        if not units:
            units = [""]  # arrays of the right types, of which nothing is used
        good, a, b, n_a, n_b, sizes = (np.concatenate(x) for x in zip(*self._encoded(units)))
        # Ends of all tokens, in bytes from the first good unit on: both count the same bytes.
        ends_a, ends_b = np.cumsum(self.long_a[a]), np.cumsum(self.long_b[b])
        unit_ends = np.cumsum(sizes)
        cuts = np.sort(np.concatenate([ends_a, ends_b]), kind="stable")
        twice = cuts[1:] == cuts[:-1]
        common, cuts = cuts[1:][twice], cuts[np.concatenate([[True], ~twice])] if len(cuts) else cuts
        pairs = a[np.searchsorted(ends_a, cuts)].astype(np.int64) * self.size_b + b[np.searchsorted(ends_b, cuts)]
        counts = {
            "n_a": n_a,
            "n_b": n_b,
            "n_groups": np.diff(np.searchsorted(common, unit_ends, side="right"), prepend=0),
            "n_links": np.diff(np.searchsorted(cuts, unit_ends, side="right"), prepend=0),
        }
        return Units(good, counts, pairs, self._written(a, b, ends_a, ends_b, common, n_a + n_b))

    def _written(self, a, b, ends_a, ends_b, common, sizes) -> list[bytes]:
        """Each unit's groups as `a1,a2|b1;`, with a semicolon after the last one too."""
        group_a, group_b = np.searchsorted(common, ends_a), np.searchsorted(common, ends_b)
        ids, mark = np.empty(len(a) + len(b), np.int64), np.empty(len(a) + len(b), np.uint8)
        at_a = np.arange(len(a)) + np.searchsorted(group_b, group_a)
        at_b = np.arange(len(b)) + np.searchsorted(group_a, group_b, side="right")
        ids[at_a], ids[at_b] = a, b
        closes_a, closes_b = (np.append(common, -1)[group] == ends for group, ends in ((group_a, ends_a), (group_b, ends_b)))
        mark[at_a], mark[at_b] = np.where(closes_a, ord("|"), ord(",")), np.where(closes_b, ord(";"), ord(","))
        long = self.n_digits[ids]
        starts = np.concatenate([[0], np.cumsum(long + 1)])
        out = np.empty(starts[-1], np.uint8)
        for k in range(self.digits.shape[1]):
            some = long > k
            out[starts[:-1][some] + k] = self.digits[ids[some], k]
        out[starts[:-1] + long] = mark
        text, bounds = out.tobytes(), starts[np.concatenate([[0], np.cumsum(sizes)])].tolist()
        return [text[s:e] for s, e in zip(bounds, bounds[1:])]

    def units_of(self, text: str) -> list[str]:
        """The words of a text that can be tokenised apart, else the text as one unit."""
        parts = text.split(" ")
        return parts if self.by_words and "" not in parts and not ODD_SPACE.search(text) else [text]


def align_block(aligner: Aligner, texts: list[str], weights: np.ndarray) -> tuple:
    """Measures, held pairs and digests of a block's texts, and the block's pairs with their documents."""
    split = [aligner.units_of(t) for t in texts]
    number: dict[str, int] = {}
    flat = np.array([number.setdefault(u, len(number)) for us in split for u in us], np.int64)
    bounds = np.concatenate([[0], np.cumsum([len(us) for us in split])])
    units = aligner.align(list(number))
    fit = _sum_per_unit(units.good[flat], bounds) == np.diff(bounds)
    if not fit.all() and any(len(split[i]) > 1 for i in np.flatnonzero(~fit)):
        # A word that is not given back: such texts are judged whole.
        split = [us if ok else [t] for us, ok, t in zip(split, fit, texts)]
        number = {}
        flat = np.array([number.setdefault(u, len(number)) for us in split for u in us], np.int64)
        bounds = np.concatenate([[0], np.cumsum([len(us) for us in split])])
        units = aligner.align(list(number))
        fit = _sum_per_unit(units.good[flat], bounds) == np.diff(bounds)
    n_words = np.where(fit, np.diff(bounds), 0)
    flat = units.place[flat[np.repeat(fit, np.diff(bounds))]]
    bounds = np.concatenate([[0], np.cumsum(n_words)])
    measures = {m: _sum_per_unit(units.counts[m][flat], bounds) for m in MEASURES}
    digests = []
    for i, ok in enumerate(fit):
        joined = b"".join([units.groups[u] for u in flat[bounds[i] : bounds[i + 1]].tolist()])
        digests.append(hashlib.sha256(joined[:-1]).hexdigest() if ok else "")

    places, per_word = ragged(units.offsets, flat)
    text_of = np.repeat(np.arange(len(texts)), np.diff(per_word[bounds]))
    held, times = np.unique(text_of * aligner.span + units.pairs[places], return_counts=True)
    pairs, local = np.unique(held % aligner.span, return_inverse=True)
    holder = held // aligner.span
    documents = np.zeros(len(pairs), np.int64)
    np.add.at(documents, local, weights[holder])
    return measures, digests, (np.searchsorted(holder, np.arange(len(texts) + 1)), local, times), (pairs, documents)


def _planes(values: np.ndarray) -> bytes:
    """32-bit values, all first bytes before all second ones: compresses well where most are small."""
    return values.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _values(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.uint8).reshape(4, -1).T.copy().view("<u4").reshape(-1).astype(np.int64)


def _aligned(paths: tuple[str, str]):
    def block_rows(number: int, rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        keys, texts, weights = zip(*rows)
        measures, digests, (at, local, times), (pairs, documents) = align_block(Aligner.of(*paths), list(texts), np.array(weights, np.int64))
        schema = pa.schema([
            ("block", pa.int64()), ("text_key", pa.binary()), *[(m, pa.int64()) for m in MEASURES], ("groups_sha256", pa.string()),
            ("held", pa.binary()), ("times", pa.binary()), ("first", pa.int32()), ("pairs", pa.list_(pa.int64())), ("documents", pa.list_(pa.int64())),
        ])
        spans = list(zip(at, at[1:]))
        given = {
            "block": np.full(len(rows), number),
            "text_key": keys,
            **measures,
            "groups_sha256": digests,
            # A text's places in the block's list of pairs ascend: steps are small.
            "held": [_planes(np.diff(local[s:e], prepend=0)) for s, e in spans],
            "times": [_planes(times[s:e]) for s, e in spans],
        }
        parts = range(0, len(pairs), PAIRS_A_ROW)
        listed = {
            "block": [number] * len(parts),
            "first": list(parts),
            "pairs": [pairs[s : s + PAIRS_A_ROW] for s in parts],
            "documents": [documents[s : s + PAIRS_A_ROW] for s in parts],
        }
        for columns in (given, listed):
            n = len(columns["block"])
            arrays = [pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in schema]
            yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, rows, size = TaskContext.get().partitionId() << 32, [], 0
        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns]):
                rows.append(row)
                size += len(row[1].encode())
                if size >= BLOCK_BYTES:
                    yield from block_rows(number, rows)
                    number, rows, size = number + 1, [], 0
        if rows:
            yield from block_rows(number, rows)

    return run


def _measured(texts: pa.Table, counts: pa.Table) -> pa.Table:
    """n_best and count_sum of a block's texts, from the counts of the block's pairs."""
    order = np.argsort(counts.column("place").to_numpy())
    total = counts.column("total").to_numpy()[order]
    best = counts.column("best").to_numpy(zero_copy_only=False)[order].astype(np.int64)
    n_best, sums = [], []
    for held, times in zip(texts.column("held").to_pylist(), texts.column("times").to_pylist()):
        at, often = np.cumsum(_values(held)), _values(times)
        n_best.append(int(often @ best[at]))
        sums.append(int(often @ total[at]))
    kept = texts.select(["text_key", *MEASURES, "groups_sha256"])
    return kept.append_column("n_best", pa.array(n_best, pa.int64())).append_column("count_sum", pa.array(sums, pa.int64()))


def align(docs: DataFrame, path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 per row of docs (doc_id, text)."""
    given = vocabulary_paths()
    paths = (path_a or given[0], path_b or given[1])
    prepare(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    key = F.unhex(F.sha2("text", 256))
    distinct = docs.filter("text <> ''").groupBy("text").agg(F.count("*").alias("copies"))
    table = stored(distinct.select(key.alias("text_key"), "text", "copies").mapInArrow(_aligned(paths), ALIGNED))
    texts = table.filter("text_key is not null").drop("first", "pairs", "documents")
    listed = table.filter("text_key is null").select("block", "first", F.posexplode(F.arrays_zip("pairs", "documents")))
    listed = listed.select("block", (F.col("first") + F.col("pos")).alias("place"), "col.pairs", "col.documents")

    totals = listed.groupBy("pairs").agg(F.sum("documents").alias("total"))
    totals = stored(totals.withColumn("a", F.expr(f"pairs div {pieces(paths[1])}")))
    # One row per id of the first vocabulary at most, whatever the corpus.
    highest = totals.groupBy("a").agg(F.max("total").alias("highest"))
    counts = totals.join(F.broadcast(highest), "a").select("pairs", "total", (F.col("total") == F.col("highest")).alias("best"))
    counts = listed.join(counts, "pairs").select(F.col("block").alias("home"), "place", "total", "best")
    schema = "text_key binary, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum long"
    measured = texts.groupBy("block").cogroup(counts.groupBy("home")).applyInArrow(_measured, schema)

    rows = docs.select("doc_id", F.when(F.col("text") != "", key).alias("text_key"))
    joined = rows.join(stored(measured), "text_key", "left")
    numbers = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in [*MEASURES, "n_best", "count_sum"]]
    return joined.select("doc_id", *numbers, F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"))
