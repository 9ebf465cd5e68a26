"""Cross-tokenizer alignment by diagonal run skipping.

A text has two tokenizations: A by a byte-level BPE vocabulary file, B by a piece model with
byte fallback. Both cover the bytes of a space and the text, so a token is a byte range and a
tokenization the rising array of its ends. Where an end is common to both, a group ends.

``staircase`` walks the two arrays. It holds a shift between the places in A and in B; along
the diagonal of that shift the arrays are compared in blocks of doubling size, and the block
that differs is halved, so a stretch of one-to-one tokens costs a few block comparisons whatever its
length. At a difference the group is resolved token by token, until both have an end in
common, and the shift becomes what it is there. The walk is returned as a path: one byte a step,
bit 1 where a token of A ends, bit 2 where one of B ends (3: a group ends). Each step is one
link: the pair of tokens that share the bytes of the step.

Corpus counts: each document gives its distinct links with how often it has them; their sums
over the corpus are the counts of the id pairs. Pairs that occur often (as many as fit
``FREQUENT_PAIRS``, by count) meet the documents in a broadcast of bounded size, so no join
has a hot key; all others by a shuffled join. Both ways give the same numbers.

Very long texts are tokenized in slices that end before a space after a character that isn't
white space. There both tokenizations have an end: A's split pattern splits there, and no piece of B
holds a space after another character (checked when the model is loaded; a model that has
such pieces, or that alters spaces, is given whole texts).

Edge cases: a null or empty text, and one whose tokens of A or of B don't join to the bytes of
a space and the text (B writes a space for U+2581), has no tokens: empty arrays, counts of 0.
Strings of special tokens are plain text. Rows are taken one by one, so repeated rows, null and
repeated ids each give a row. An empty table gives an empty result. Columns beside ``id_col`` and
``text_col`` aren't read.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import SPLIT, byte_letters
from .common import small_batches, staged

#: Most id pairs that travel in the broadcast.
FREQUENT_PAIRS = 1 << 18
#: Texts longer than this many characters are tokenized in slices.
SLICE_CHARS = 1 << 16
#: Text that is tokenized and summarised at once, in characters.
PIECE_CHARS = 1 << 18

ALIGNED = "a_ids array<int>, b_ids array<int>, path binary"
LINKS = "array<struct<a: int, b: int, times: int>>"

_CUT = re.compile(r"(?<=\S) ")


class ByteVocabulary:
    """Tokenization A: a byte-level BPE vocabulary file; ``of_id`` holds the bytes of each token."""

    def __init__(self, path: str):
        import tiktoken

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = byte_letters()
        added = {t["content"] for t in spec.get("added_tokens", [])}
        ranks = {bytes(letters[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in added}
        made = [spec["model"]["vocab"]["".join(m.split(" ") if isinstance(m, str) else m)] for m in spec["model"]["merges"]]
        if made != sorted(made):
            raise ValueError(f"{path}: ids don't follow the order of merges")
        self.of_id = [b""] * (max(ranks.values(), default=0) + 1)
        for data, i in ranks.items():
            self.of_id[i] = data
        self.coder = tiktoken.Encoding("vocabulary", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [self.coder.encode_ordinary(t) for t in texts]


class PieceModel:
    """Tokenization B: a piece model that puts a space before a text."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = m = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [m.id_to_piece(i) for i in range(m.get_piece_size())]
        self.of_id = [bytes([int(p[3:5], 16)]) if m.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        probe = b"".join(self.of_id[i] for i in m.encode("a  b "))
        self.sliced = probe == b" a  b " and not any("▁" in p.lstrip("▁") for p in pieces)

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


@lru_cache(2)
def _coders(vocabulary: str, model: str) -> tuple[ByteVocabulary, PieceModel]:
    return ByteVocabulary(vocabulary), PieceModel(model)


def slices(text: str, size: int = SLICE_CHARS) -> list[str]:
    """Parts of a text, cut at a space after a character that isn't white space (the space is left out)."""
    out, at = [], 0
    while len(text) - at > size and (m := _CUT.search(text, at + size)):
        out.append(text[at:m.start()])
        at = m.end()
    return [*out, text[at:]]


def tokenize(texts: list[str], a: ByteVocabulary, b: PieceModel) -> list[tuple[list[int], list[int]]]:
    """(ids of A, ids of B) of a space and each text; ([], []) where the tokens don't join to it."""
    parts = [slices(t) if b.sliced else [t] for t in texts]
    flat = [p for some in parts for p in some]
    ids_a, ids_b = iter(a.encode([" " + p for p in flat])), iter(b.encode(flat))
    out = []
    for text, some in zip(texts, parts):
        of_a, of_b = next(ids_a), next(ids_b)
        for _ in some[1:]:
            of_a += next(ids_a)
            of_b += next(ids_b)
        whole = b" " + text.encode()
        same = text and all(whole == b"".join(map(c.of_id.__getitem__, ids)) for c, ids in ((a, of_a), (b, of_b)))
        out.append((of_a, of_b) if same else ([], []))
    return out


def run_length(a: bytes, b: bytes, i: int, j: int, most: int) -> int:
    """How many ends agree from places i and j on, along the diagonal: exponential probing, then halving of the block that differs.

    ``a`` and ``b`` hold the ends as 4-byte integers; ``most`` bounds the run.
    """
    n, step = 0, 1
    while n < most:
        step = min(step, most - n)
        if a[4 * (i + n):4 * (i + n + step)] == b[4 * (j + n):4 * (j + n + step)]:
            n += step
            step *= 2
        else:
            while step > 1:  # the first difference is among the next ``step`` ends
                half = step // 2
                if a[4 * (i + n):4 * (i + n + half)] == b[4 * (j + n):4 * (j + n + half)]:
                    n += half
                    step -= half
                else:
                    step = half
            return n
    return n


def staircase(ends_a: np.ndarray, ends_b: np.ndarray) -> bytes:
    """The path through two rising arrays with the same last element."""
    raw_a, raw_b = ends_a.astype("<u4").tobytes(), ends_b.astype("<u4").tobytes()
    list_a, list_b = ends_a.tolist(), ends_b.tolist()
    n_a, n_b = len(list_a), len(list_b)
    path = bytearray()
    i = shift = 0
    while i < n_a:
        j = i + shift
        end_a, end_b = list_a[i], list_b[j]
        if end_a == end_b:
            run = run_length(raw_a, raw_b, i, j, min(n_a - i, n_b - j))
            path += b"\3" * run
            i += run
            continue
        while end_a != end_b:  # an irregular group: step on the side that is behind
            if end_a < end_b:
                path.append(1)
                i += 1
                end_a = list_a[i]
            else:
                path.append(2)
                j += 1
                end_b = list_b[j]
        path.append(3)
        i += 1
        shift = j + 1 - i
    return bytes(path)


def _groups(texts: list[str], most: int) -> Iterator[list[str]]:
    some: list[str] = []
    size = 0
    for t in texts:
        if some and size + len(t) > most:
            yield some
            some, size = [], 0
        some.append(t)
        size += len(t)
    if some:
        yield some


def _lists(parts: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, parts)])
    flat = np.concatenate(parts) if parts else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat.astype(np.int32, copy=False)))


def align_documents(docs: DataFrame, vocabulary: str, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, ``a_ids``, ``b_ids`` and ``path``.

    ``vocabulary`` (A) and ``model`` (B) are paths of files on the executors.
    """
    kind = docs.select(F.col(id_col).alias(id_col)).schema[0].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = _coders(vocabulary, model)
        size_a, size_b = (np.array([len(x) for x in c.of_id], np.int64) for c in (a, b))
        for batch in batches:
            row = 0
            for texts in _groups([t or "" for t in batch.column(1).to_pylist()], PIECE_CHARS):
                of_a, of_b, paths = [], [], []
                for ids_a, ids_b in tokenize(texts, a, b):
                    x, y = np.array(ids_a, np.int32), np.array(ids_b, np.int32)
                    of_a.append(x)
                    of_b.append(y)
                    paths.append(staircase(np.cumsum(size_a[x]), np.cumsum(size_b[y])))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(row, len(texts)), _lists(of_a), _lists(of_b), pa.array(paths, pa.binary())],
                    names=[id_col, "a_ids", "b_ids", "path"])
                row += len(texts)

    return small_batches(docs).select(F.col(id_col).alias(id_col), F.col(text_col).cast("string").alias("__text")).mapInArrow(
        run, f"`{id_col}` {kind}, {ALIGNED}")


class Paths:
    """The paths of a batch of aligned rows, one after the other."""

    def __init__(self, batch: pa.RecordBatch):
        a, b, path = (batch.column(batch.schema.get_field_index(c)) for c in ("a_ids", "b_ids", "path"))
        paths = path.to_pylist()
        self.steps = np.frombuffer(b"".join(paths), np.uint8)
        self.a = a.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        self.b = b.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        self.n_a, self.n_b = (np.diff(c.offsets.to_numpy()).astype(np.int64) for c in (a, b))
        self.n_links = np.array([len(p) for p in paths], np.int64)
        self.rows = len(self.n_a)
        self.ends_group = self.steps == 3
        self.ends_a, self.ends_b = (self.steps & 1) > 0, self.steps >= 2

    def n_groups(self) -> np.ndarray:
        until = np.concatenate([[0], np.cumsum(self.ends_group)])
        at = np.concatenate([[0], np.cumsum(self.n_links)])
        return until[at[1:]] - until[at[:-1]]

    def links(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, id of A, id of B) of each step."""
        i = np.cumsum(self.ends_a) - self.ends_a
        j = np.cumsum(self.ends_b) - self.ends_b
        return np.repeat(np.arange(self.rows), self.n_links), self.a[i], self.b[j]

    def distinct_links(self) -> pa.Array:
        """Per row its different links with how often it has them."""
        row, a, b = self.links()
        if max(int(self.a.max(initial=0)), int(self.b.max(initial=0))) >= 1 << 21 or self.rows >= 1 << 21:
            raise ValueError("vocabularies of at most 2^21 ids, batches of at most 2^21 rows")
        keys = np.sort((row << 42) | (a << 21) | b)
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
        times = np.diff(np.append(first, len(keys)))
        keys = keys[first]
        ends = np.searchsorted(keys >> 42, np.arange(self.rows + 1))
        low = (1 << 21) - 1
        fields = [pa.array(x.astype(np.int32)) for x in ((keys >> 21) & low, keys & low, times)]
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(fields, ["a", "b", "times"]))

    def group_texts(self, names: tuple[list[str], ...]) -> Iterator[str]:
        """Per row ``a1,a2|b1;a3|b2,b3``; ``names`` holds for each id of A "id," and "id|", of B "id," and "id;"."""
        last_a, last_b = self.ends_group[self.ends_a], self.ends_group[self.ends_b]
        until_a = np.flatnonzero(last_a) + 1  # tokens of A up to each group's end
        before_b = np.concatenate([[0], np.flatnonzero(last_b) + 1])  # tokens of B before each group
        place_a = np.arange(len(self.a)) + before_b[np.cumsum(last_a) - last_a]
        place_b = np.arange(len(self.b)) + until_a[np.cumsum(last_b) - last_b]
        of_a, of_b = len(names[0]), len(names[2])
        order = np.empty(len(self.a) + len(self.b), np.int64)
        order[place_a] = self.a + of_a * last_a
        order[place_b] = self.b + 2 * of_a + of_b * last_b
        table = [s for some in names for s in some]
        at = np.concatenate([[0], np.cumsum(self.n_a + self.n_b)]).tolist()
        for s, e in zip(at, at[1:]):
            yield "".join(map(table.__getitem__, order[s:e].tolist()))[:-1]


@lru_cache(2)
def _names(vocabulary: str, model: str) -> tuple[list[str], ...]:
    a, b = _coders(vocabulary, model)
    return tuple([f"{i}{end}" for i in range(len(c.of_id))] for c, end in ((a, ","), (a, "|"), (b, ","), (b, ";")))


def summarise(aligned: DataFrame, vocabulary: str, model: str, id_col: str = "doc_id") -> DataFrame:
    """Per aligned row: id, rid (a number of its own), n_a, n_b, n_groups, n_links, groups_sha256 ('' without tokens) and its distinct links."""
    kind = aligned.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = Paths(batch)
            digests = [hashlib.sha256(t.encode()).hexdigest() if t else "" for t in p.group_texts(_names(vocabulary, model))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(x, pa.int64()) for x in (p.n_a, p.n_b, p.n_groups(), p.n_links)],
                 pa.array(digests, pa.string()), p.distinct_links()],
                names=[id_col, "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "links"])

    out = aligned.select(id_col, "a_ids", "b_ids", "path").mapInArrow(
        run, f"`{id_col}` {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, links {LINKS}")
    return out.withColumn("rid", F.monotonically_increasing_id())


def link_counts(rows: DataFrame) -> DataFrame:
    """(a, b, n, best): how many links of all ``rows`` hold the pair; best where no pair with that b has more."""
    counts = rows.select(F.inline("links")).groupBy("a", "b").agg(F.sum(F.col("times").cast("long")).alias("n"))
    counts = staged(counts, "link-counts")
    top = counts.groupBy("b").agg(F.max("n").alias("top"))  # at most one row for each id of B
    return counts.join(top, "b").select("a", "b", "n", (F.col("n") == F.col("top")).alias("best"))


def frequent_bound(counts: DataFrame, most: int) -> tuple[int, bool]:
    """(n, whether pairs with less are left): at most ``most`` pairs occur n times or more."""
    scale = F.floor(F.log2("n") * 8).cast("int")
    steps = counts.groupBy(scale.alias("s")).agg(F.count("*").alias("pairs"), F.min("n").alias("low")).orderBy(F.desc("s"))
    bound, held = (1 << 62), 0
    for step in steps.collect():  # at most 8 rows for each power of two
        held += step["pairs"]
        if held > most:
            return bound, True
        bound = step["low"]
    return bound, False


def alignment_report(rows: DataFrame, id_col: str = "doc_id", most: int = FREQUENT_PAIRS) -> DataFrame:
    """Summarised rows with n_best and count_sum over their links. ``rows`` is a written table: it is read several times."""
    counts = staged(link_counts(rows), "link-counts-best")
    bound, rare = frequent_bound(counts, most)
    often = F.broadcast(counts.where(F.col("n") >= bound))
    links = rows.select("rid", F.inline("links"))

    def sums(met: DataFrame) -> DataFrame:
        return met.groupBy("rid").agg(
            F.sum(F.when(F.col("best"), F.col("times")).otherwise(0).cast("long")).alias("n_best"),
            F.sum(F.col("times") * F.col("n")).alias("count_sum"))

    of_rows = sums(links.join(often, ["a", "b"]))
    if rare:
        others = links.join(often.select("a", "b"), ["a", "b"], "left_anti").join(counts.where(F.col("n") < bound), ["a", "b"])
        of_rows = of_rows.union(sums(others)).groupBy("rid").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    return rows.drop("links").join(of_rows, "rid", "left").select(
        id_col, "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", F.lit(0)).alias("n_best"),
        F.coalesce("count_sum", F.lit(0)).alias("count_sum"), "groups_sha256")
