"""BPE encoding and decoding of whole texts.

Every pre-token is merged by a segment tree over the ranks of its adjacent pairs: a leaf holds rank and
place of the pair that begins there, a node the smaller of its children, so the root is the leftmost
pair of lowest rank. A merge changes three leaves and the paths above them; the pre-token is done when
the root is empty. Short pre-tokens, which are nearly all, are merged side by side in arrays, long ones
one at a time.

Words recur, so each Python worker keeps the results of recent words in tables, bounded by number and by
size, so that neither many words nor long ones fill its memory; a text is the concatenation of its words'
ids. Splitting at white space first is exact, since this vocabulary drops
white space and no rule of it looks across.

Nulls: a null text is empty and has no ids. Special tokens in a text are one id each.
"""

import json
import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wiremere.llm import words
from wiremere.llm.tables import prepare

CACHED_WORDS = 400_000
CACHED_SIZE = 1 << 26  # characters of cached words and pieces, and bytes of their ids and names
SIDE_BY_SIDE = 64  # longest pre-token that is merged in arrays with others
NONE = np.iinfo(np.int64).max

# Printable ASCII and the Latin letters beyond it that have one composed form and one lower case.
LATIN = re.compile("[!-~À-ÖØ-öø-įĲ-ɏ]+")
# The vocabulary's split rule, for such words in lower case.
LATIN_SPLIT = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zÀ-ÖØ-öø-ɏ]+|[0-9]|[^a-z0-9À-ÖØ-öø-ɏ]+")
# Python's split() also breaks at these; the vocabulary does not.
SEPARATORS = re.compile("[\x1c-\x1f]")
PLAIN_SPACE = re.compile("[ \t\n\r]+")


def vocabulary_path() -> str:
    """The word vocabulary of the installed public tokenizers."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class Codec:
    """Encoder and decoder of one vocabulary file; `of` keeps one per process."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self.suffix = model["end_of_word_suffix"] or ""
        self.ids = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = {i: t for t, i in self.ids.items()} | {i: t for t, i in self.special.items()}
        self.at_special = re.compile("|".join(map(re.escape, self.special)) or r"(?!)")
        library = Tokenizer.from_file(path)
        self.normalize = library.normalizer.normalize_str
        self.pre_tokenize = library.pre_tokenizer.pre_tokenize_str

        pairs = [m if isinstance(m, list) else m.split(" ", 1) for m in model["merges"]]
        self.width = 1 << max(self.ids.values()).bit_length()
        self.ranks = {}
        for rank, (a, b) in enumerate(pairs):
            if a + b in self.ids:
                self.ranks[self.ids[a] * self.width + self.ids[b]] = rank
        self.merged = np.array([self.ids.get(a + b, 0) for a, b in pairs], np.int64)
        order = sorted(self.ranks)
        self.pair_keys = np.array(order, np.int64)
        self.pair_ranks = np.array([self.ranks[k] for k in order], np.int64)
        alphabet = [c for c in self.ids if len(c) == 1]
        self.inner = np.full(max(map(ord, alphabet)) + 1, -1, np.int64)
        self.final = self.inner.copy()
        for c in alphabet:
            self.inner[ord(c)], self.final[ord(c)] = self.ids[c], self.ids[c + self.suffix]
        # Bytes that do not print stand for themselves as characters from 256 on, in their order.
        printed = [*range(33, 127), *range(161, 173), *range(174, 256)]
        self.visible = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in printed)}
        self.names = np.array([self.tokens.get(i, "") for i in range(max(self.tokens) + 1)], object)
        self.words: dict[str, tuple[bytes, str]] = {}
        self.parts: dict[str, tuple[bytes, str]] = {}
        self.held = 0  # size of both tables

    @staticmethod
    @cache
    def of(path: str) -> "Codec":
        return Codec(path)

    # ---- merging ----

    def symbols(self, tokens: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of single characters, the last of a pre-token with the end-of-word mark, and offsets."""
        chars = np.frombuffer("".join(tokens).encode("utf-32-le"), np.uint32)
        offsets = np.concatenate([[0], np.cumsum([len(t) for t in tokens])]).astype(np.int64)
        ids = self.inner[chars]
        ids[offsets[1:] - 1] = self.final[chars[offsets[1:] - 1]]
        return ids, offsets

    def _keys(self, left: np.ndarray, right: np.ndarray, place: np.ndarray, size: int) -> np.ndarray:
        """Leaf values rank * size + place of pairs; NONE where there is no merge."""
        pair = left * self.width + right
        at = np.minimum(np.searchsorted(self.pair_keys, pair), len(self.pair_keys) - 1)
        known = (left >= 0) & (right >= 0) & (self.pair_keys[at] == pair)
        return np.where(known, self.pair_ranks[at] * size + place, NONE)

    def merge_rows(self, rows: np.ndarray) -> np.ndarray:
        """Merge many short symbol rows side by side; -1 fills up to a width that is a power of two."""
        n, size = rows.shape
        # One column more than the tree on either side stands for "no neighbour".
        symbol = np.full((n, size + 2), -1, np.int64)
        symbol[:, 1:-1] = rows
        after = np.tile(np.minimum(np.arange(1, size + 3), size + 1), (n, 1))
        before = np.tile(np.maximum(np.arange(-1, size + 1), 0), (n, 1))
        place = np.arange(size)
        levels = [self._keys(symbol[:, 1:-1], symbol[:, 2:], place, size)]
        while levels[-1].shape[1] > 1:
            levels.append(np.minimum(levels[-1][:, 0::2], levels[-1][:, 1::2]))
        while True:
            row = np.flatnonzero(levels[-1][:, 0] != NONE)
            if not len(row):
                break
            root = levels[-1][row, 0]
            i = root % size + 1
            j = after[row, i]
            k = after[row, j]
            h = before[row, i]
            symbol[row, i] = self.merged[root // size]
            symbol[row, j] = -1
            after[row, i] = k
            before[row, k] = i
            levels[0][row, j - 1] = NONE
            levels[0][row, i - 1] = self._keys(symbol[row, i], symbol[row, k], i - 1, size)
            some = h > 0
            levels[0][row[some], h[some] - 1] = self._keys(symbol[row[some], h[some]], symbol[row[some], i[some]], h[some] - 1, size)
            changed_row = np.concatenate([row, row, row[some]])
            changed = np.concatenate([i - 1, j - 1, h[some] - 1])
            for low, high in zip(levels, levels[1:]):
                changed >>= 1
                high[changed_row, changed] = np.minimum(low[changed_row, 2 * changed], low[changed_row, 2 * changed + 1])
        return symbol

    def merge_long(self, row: list[int]) -> list[int]:
        """Merge one long symbol row, with the tree in a plain list."""
        n = len(row)
        size = 1 << (n - 1).bit_length()
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        none = (1 << 62, 0)

        def leaf(i: int) -> tuple[int, int]:
            j = after[i]
            rank = self.ranks.get(row[i] * self.width + row[j]) if j < n else None
            return none if rank is None else (rank, i)

        tree = [none] * size + [leaf(i) for i in range(n)] + [none] * (size - n)
        for node in range(size - 1, 0, -1):
            tree[node] = min(tree[2 * node], tree[2 * node + 1])

        def put(i: int, value: tuple[int, int]) -> None:
            node = size + i
            tree[node] = value
            while node > 1:
                node >>= 1
                least = min(tree[2 * node], tree[2 * node + 1])
                if tree[node] == least:
                    return
                tree[node] = least

        while tree[1] != none:
            rank, i = tree[1]
            j = after[i]
            row[i], row[j] = int(self.merged[rank]), -1
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            put(j, none)
            put(i, leaf(i))
            if before[i] >= 0:
                put(before[i], leaf(before[i]))
        return [s for s in row if s >= 0]

    def merge(self, tokens: list[str]) -> dict[str, tuple[bytes, str]]:
        """Ids and decoded text of distinct pre-tokens."""
        out = {}
        ids, offsets = self.symbols(tokens)
        lengths = np.diff(offsets)
        for row in np.flatnonzero(lengths > SIDE_BY_SIDE):
            out[tokens[row]] = self.entry(self.merge_long(ids[offsets[row] : offsets[row + 1]].tolist()))
        size = 1
        while size <= SIDE_BY_SIDE:
            some = np.flatnonzero((lengths > size // 2) & (lengths <= size))
            if len(some):
                column = np.arange(size)
                at = offsets[some][:, None] + column
                inside = column < lengths[some][:, None]
                rows = np.where(inside, ids[np.minimum(at, len(ids) - 1)], -1)
                symbol = self.merge_rows(rows)
                kept = symbol >= 0
                flat = symbol[kept]
                ends = np.cumsum(kept.sum(axis=1)).tolist()
                data, names, start = flat.astype("<u4").tobytes(), self.names[flat].tolist(), 0
                for row, end in zip(some.tolist(), ends):
                    out[tokens[row]] = data[4 * start : 4 * end], " ".join(names[start:end])
                    start = end
            size *= 2
        return out

    def entry(self, ids: list[int]) -> tuple[bytes, str]:
        return np.array(ids, "<u4").tobytes(), self.text(ids)

    # ---- texts ----

    def pieces(self, word: str) -> list[str | int]:
        """Pre-tokens of a word, special tokens as ids."""
        if LATIN.fullmatch(word) and "<|" not in word:
            low = word.lower()
            found = [low] if low.isalpha() else LATIN_SPLIT.findall(low)
            return found if low.isascii() else [p.encode().decode("latin-1").translate(self.visible) for p in found]
        out, start = [], 0
        for found in [*self.at_special.finditer(word), None]:
            part = word[start : found.start() if found else None]
            if part:
                out += [t for t, _ in self.pre_tokenize(self.normalize(part))]
            if found:
                out.append(self.special[found.group()])
                start = found.end()
        return out

    def learn(self, fresh: set[str]) -> None:
        """Encode words that are not in the table yet."""
        split = {word: self.pieces(word) for word in fresh}
        wanted = {p for ps in split.values() for p in ps if isinstance(p, str)}
        if new := list(wanted - self.parts.keys()):
            merged = self.merge(new)
            self.parts |= merged
            self.held += _size(merged)
        parts, known = self.parts, self.words
        for word, ps in split.items():
            if len(ps) == 1 and type(ps[0]) is str:
                known[word] = parts[ps[0]]
            else:
                found = [parts[p] if type(p) is str else self.entry([p]) for p in ps]
                known[word] = b"".join([f[0] for f in found]), " ".join([f[1] for f in found if f[1]])
        self.held += _size({word: known[word] for word in split})

    def text(self, ids) -> str:
        """Decode: this vocabulary has no decoder of its own, so its tokens are set apart by spaces."""
        return " ".join([self.tokens[i] for i in ids])

    def encode(self, texts: list[str]) -> Iterator[tuple[bytes, str]]:
        """Ids as little-endian 32-bit integers and decoded text, per text."""
        parts = [[p for p in PLAIN_SPACE.split(t) if p] if SEPARATORS.search(t) else t.split() for t in texts]
        every = set().union(*parts)
        fresh = every - self.words.keys()
        if max(len(self.words) + len(fresh), len(self.parts)) > CACHED_WORDS or self.held > CACHED_SIZE:
            self.words.clear()
            self.parts.clear()
            self.held = 0
            fresh = every
        self.learn(fresh)
        for ps in parts:
            if ps:
                ids, names = zip(*map(self.words.__getitem__, ps))
                yield b"".join(ids), " ".join(filter(None, names))  # only rare white space has no name
            else:
                yield b"", ""


def _size(table: dict[str, tuple[bytes, str]]) -> int:
    return sum(len(word) + len(ids) + len(names) for word, (ids, names) in table.items())


def _round_trip(path: str, texts: pa.Array) -> Iterator[tuple[int, int, list[bytes], list[str]]]:
    codec = Codec.of(path)
    texts = texts.cast(pa.large_string()).fill_null("")
    for start, end in words.slices(texts, 1 << 20):
        found = list(codec.encode(texts.slice(start, end - start).to_pylist()))
        yield start, end, [f[0] for f in found], [f[1] for f in found]


def encode(docs: DataFrame, column: str = "text", path: str | None = None, decoded: bool = False) -> DataFrame:
    """docs with `ids`, the column's token ids as little-endian 32-bit integers.

    With `decoded`, also the text that these ids decode to. Other columns go through unchanged.
    """
    path = path or vocabulary_path()
    prepare(docs.sparkSession)
    kept = [c for c in docs.columns if c not in ("ids", "decoded")]
    extra = ", decoded string" if decoded else ""
    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in kept) + ", ids binary" + extra

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, end, ids, texts in _round_trip(path, batch.column(len(kept))):
                columns = [batch.column(i).slice(start, end - start) for i in range(len(kept))]
                columns += [pa.array(ids, pa.binary()), *([pa.array(texts, pa.string())] if decoded else [])]
                yield pa.RecordBatch.from_arrays(columns, [*kept, "ids", *(["decoded"] if decoded else [])])

    return docs.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{column}`").cast("string").alias("_text")).mapInArrow(run, schema)


def decode(docs: DataFrame, column: str = "ids", path: str | None = None) -> DataFrame:
    """docs with `decoded`, the text of a column of ids; a null stays null."""
    path = path or vocabulary_path()
    prepare(docs.sparkSession)

    @F.pandas_udf("string")
    def text(ids):
        codec = Codec.of(path)
        return ids.map(lambda b: None if b is None else codec.text(np.frombuffer(b, "<u4").tolist()))

    return docs.withColumn("decoded", text(F.col(column)))
