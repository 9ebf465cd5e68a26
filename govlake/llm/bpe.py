"""BPE encoding and decoding as bounded-lookahead streaming transducers.

Encoding. A merge at some place can only be upset from the right by an earlier merge that
takes the right part (or the end of it) together with what follows, and that one only by a
still earlier one. Following these chains over the merge list, in order of rank, gives the
number of bytes after a token that can have a say in it: the sufficient lookahead
(``sufficient_lookahead``). The encoder reads text into a window, merges the window, and emits
each token that has at least that many bytes after it; those are stable whatever comes next.
The rest stays in the window. So a piece of any length needs a constant window.

Text reaches the encoder in slices. A slice ends before white space that follows a
character that isn't white space: there the split pattern always splits, so slices are
split as the whole text would be. Short pieces come from a bounded cache; those that are not in it yet
are merged together (``Windows``).

Decoding. Token ids become bytes, and an incremental state machine turns bytes to text,
holding back the bytes of a character until it is complete (``IdsToText``).

Edge cases: null counts as empty (no tokens, empty text). The strings of added tokens in a
text become their ids, as the tokenizers library does by default. Very long texts and
very long pieces use constant memory. An empty table gives an empty result; rows may repeat;
columns beside ``id_col`` and ``text_col`` are not read.
"""

from __future__ import annotations

import codecs
import heapq
import json
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_out, freed, small_batches
from .language_id import ExactTable

# Fixed value: the split pattern of byte-level BPE vocabularies.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

SLICE_CHARS = 1 << 16
GROUP_PIECES = 50_000
CACHE_PIECES = 100_000
CACHE_PIECE_BYTES = 64


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in the vocabulary file: printable Latin-1 as itself, others from U+0100."""
    printable = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


def sufficient_lookahead(merges: list[tuple[bytes, bytes]]) -> int:
    """Bytes after a token that can change it, from the merge list alone.

    reach(i): how far to the right of merge i's right part the chain of earlier merges that
    can upset it goes. Merge j < i can upset i if it takes, as its left part, the right part
    of i or any token on that part's right edge; it then depends on its own right part.
    """
    whole = {a + b: (a, b) for a, b in reversed(merges)}  # how each token is made: by its first merge
    best: dict[bytes, int] = {}  # of the merges so far with this left part: length of the right part plus reach
    most = 0
    for a, b in merges:
        reach, edge = 0, b
        while True:
            reach = max(reach, best.get(edge, 0))
            if edge not in whole:
                break
            edge = whole[edge][1]
        best[a] = max(best.get(a, 0), len(b) + reach)
        most = max(most, len(b) + reach)
    return most


class Vocabulary:
    """Merge ranks, ids and bytes of a byte-level BPE vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = byte_letters()

        def to_bytes(token: str) -> bytes:
            return bytes(letters[c] for c in token)

        vocab = spec["model"]["vocab"]
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
        self.merges = [(to_bytes(a), to_bytes(b)) for a, b in pairs]
        self.rank = {}
        for i, (a, b) in enumerate(pairs):
            self.rank[vocab[a], vocab[b]] = (i, vocab[a + b])
        self.added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.of_byte = [0] * 256
        for c, b in letters.items():
            self.of_byte[b] = vocab[c]
        self.text = [b""] * (max([*vocab.values(), *self.added.values()]) + 1)
        for token, i in vocab.items():
            if token not in self.added:
                self.text[i] = to_bytes(token)
        for token, i in self.added.items():
            self.text[i] = token.encode()
        self.lookahead = sufficient_lookahead(self.merges)
        self.windows = Windows(self.of_byte, self.rank)


def merge(ids: list[int], rank: dict) -> list[int]:
    """BPE of one window: the lowest-ranked pair first, leftmost first."""
    n = len(ids)
    if n < 2:
        return ids
    if n <= 24:
        while True:
            found = min(((*rank[p], i) for i, p in enumerate(zip(ids, ids[1:])) if p in rank), key=lambda x: (x[0], x[2]), default=None)
            if found is None:
                return ids
            ids = [*ids[:found[2]], found[1], *ids[found[2] + 2:]]
    after, before, ids = [*range(1, n), -1], [*range(-1, n - 1)], list(ids)
    heap = [(r[0], i, r[1], a, b) for i, (a, b) in enumerate(zip(ids, ids[1:])) if (r := rank.get((a, b)))]
    heapq.heapify(heap)
    while heap:
        _, i, new, a, b = heapq.heappop(heap)
        j = after[i]
        if ids[i] != a or j < 0 or ids[j] != b:
            continue  # one of the two has been merged since
        ids[i], ids[j], after[i] = new, -1, after[j]
        if after[i] >= 0:
            before[after[i]] = i
            if r := rank.get((new, ids[after[i]])):
                heapq.heappush(heap, (r[0], i, r[1], new, ids[after[i]]))
        if before[i] >= 0 and (r := rank.get((ids[before[i]], new))):
            heapq.heappush(heap, (r[0], before[i], r[1], ids[before[i]], new))
    return [t for t in ids if t >= 0]


class Windows:
    """BPE of many short windows at once: in each round every window makes its lowest-ranked merge, leftmost first."""

    NONE = np.int32(2**31 - 1)

    def __init__(self, of_byte: list[int], rank: dict[tuple[int, int], tuple[int, int]]):
        self.of_byte = np.array(of_byte, np.int32)
        pairs = sorted(rank, key=lambda p: rank[p][0])
        self.order = np.array([rank[p][0] for p in pairs], np.int32)
        self.made = np.zeros(int(self.order.max(initial=0)) + 1, np.int32)
        self.made[self.order] = [rank[p][1] for p in pairs]
        self.table = ExactTable(np.array([a << 32 | b for a, b in pairs], np.uint64))

    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        found = self.table.find((a.astype(np.uint64) << np.uint64(32)) | b.astype(np.uint64))
        return np.where(found >= 0, self.order[found], self.NONE)

    def merge(self, windows: list[bytes]) -> list[bytes]:
        """Ids of each window as little-endian unsigned 32-bit integers."""
        sizes = np.array([len(w) for w in windows])
        width = int(sizes.max(initial=1)) + 1
        ids = np.full((len(windows), width), -1, np.int32)  # -1: past the end
        inside = np.arange(width) < sizes[:, None]
        ids[inside] = self.of_byte[np.frombuffer(b"".join(windows), np.uint8)]
        rank = np.full((len(windows), width), self.NONE)
        pair = inside[:, 1:]
        rank[:, :-1][pair] = self.ranks(ids[:, :-1][pair], ids[:, 1:][pair])
        live = np.arange(len(windows))
        while len(live):
            r = rank[live]
            at = r.argmin(axis=1)
            best = r[np.arange(len(live)), at]
            some = best != self.NONE
            live, at, best = live[some], at[some], best[some]
            if not len(live):
                break
            sizes[live] -= 1
            rest = np.arange(width - 1) > at[:, None]  # all after the merged pair moves up by one
            for table in (ids, rank):
                t = table[live]
                t[:, :-1] = np.where(rest, t[:, 1:], t[:, :-1])
                table[live] = t
            ids[live, at] = self.made[best]
            for left in (at - 1, at):
                known = (left >= 0) & (left + 1 < sizes[live])
                row, left = live[known], left[known]
                rank[row, left] = self.ranks(ids[row, left], ids[row, left + 1])
            last = sizes[live] - 1
            rank[live, last] = self.NONE
        flat = ids[np.arange(width) < sizes[:, None]].astype("<u4").tobytes()
        ends = (4 * np.cumsum(sizes)).tolist()
        return [flat[a:b] for a, b in zip([0, *ends], ends)]


class Encoder:
    """Streaming transducer from text to token ids; ids leave as little-endian unsigned 32-bit integers."""

    def __init__(self, vocab: Vocabulary, window: int = 8192):
        self.vocab = vocab
        self.window = max(window, 2 * vocab.lookahead)
        self.cache: dict[str, bytes] = {}
        self.split = regex.compile(SPLIT)
        self.specials = regex.compile("|".join(regex.escape(t) for t in sorted(vocab.added, key=len, reverse=True))) if vocab.added else None

    def transduce(self, stream: Iterable[bytes]) -> Iterator[list[int]]:
        """Token ids of one piece that arrives in parts; a token leaves once enough bytes follow it."""
        v, held = self.vocab, b""
        for part in stream:
            held += part
            while len(held) >= self.window + v.lookahead:
                window = held[:self.window + v.lookahead]
                stable, at = [], 0
                for t in merge([v.of_byte[b] for b in window], v.rank):
                    if at + len(v.text[t]) + v.lookahead > len(window):
                        break
                    stable.append(t)
                    at += len(v.text[t])
                yield stable
                held = held[at:]
        if held:
            yield merge([v.of_byte[b] for b in held], v.rank)

    def long_piece(self, piece: str) -> Iterator[bytes]:
        """Ids of a piece that isn't cached."""
        data = piece.encode()
        for ids in self.transduce(data[i:i + self.window] for i in range(0, len(data), self.window)):
            yield np.array(ids, "<u4").tobytes()

    def learn(self, pieces: set[str]) -> None:
        """Cache the ids of short pieces. A piece that fits the window is merged at its end, so all of them go together."""
        if len(self.cache) + len(pieces) > CACHE_PIECES:
            self.cache = {"": b""}
        by_size: dict[int, list[tuple[str, bytes]]] = {}
        for p in pieces:
            data = p.encode()
            by_size.setdefault(max(4, (len(data) - 1).bit_length()), []).append((p, data))
        for some in by_size.values():
            self.cache.update(zip([p for p, _ in some], self.vocab.windows.merge([d for _, d in some])))

    def slices(self, text: str) -> Iterator[str]:
        """Slices of the text that end before white space after a character that isn't white space."""
        at = 0
        while len(text) - at > SLICE_CHARS:
            end = at + SLICE_CHARS
            while end < len(text) and not (_is_space(text[end]) and not _is_space(text[end - 1])):
                end += 1
            yield text[at:end]
            at = end
        if at < len(text):
            yield text[at:]

    def parts(self, text: str) -> Iterator[list[str] | bytes]:
        """The pieces of each slice of the text, and the ids of added tokens between them."""
        at = 0
        if self.specials:
            for m in self.specials.finditer(text):
                for part in self.slices(text[at:m.start()]):
                    yield self.split.findall(part)
                yield self.vocab.added[m.group()].to_bytes(4, "little")
                at = m.end()
        for part in self.slices(text[at:] if at else text):
            yield self.split.findall(part)

    def encode_many(self, texts: Iterable[str]) -> Iterator[tuple[int, bytes]]:
        """(number of the text, ids) in order, slice by slice; the slices of about GROUP_PIECES pieces are looked at together."""
        held: list[tuple[int, list[str] | bytes]] = []
        size = 0
        for number, text in enumerate(texts):
            for part in self.parts(text):
                held.append((number, part))
                size += len(part)
                if size >= GROUP_PIECES:
                    yield from self._group(held)
                    held, size = [], 0
        yield from self._group(held)

    def _group(self, held: list[tuple[int, list[str] | bytes]]) -> Iterator[tuple[int, bytes]]:
        known = self.cache
        new = {w for _, part in held if not isinstance(part, bytes) for w in part if w not in known}
        large = {w for w in new if len(w.encode()) > CACHE_PIECE_BYTES}
        if new:
            if len(known) + len(new) > CACHE_PIECES:  # the cache starts anew with all pieces of this group
                new = {w for _, part in held if not isinstance(part, bytes) for w in part}
            self.learn(new - large)
        known = self.cache
        for number, part in held:
            if isinstance(part, bytes):
                yield number, part
            elif not large or large.isdisjoint(part):
                yield number, b"".join([known[w] for w in part])
            else:
                for w in part:
                    if w in large:
                        for ids in self.long_piece(w):
                            yield number, ids
                    else:
                        yield number, known[w]

    def encode(self, text: str) -> Iterator[bytes]:
        """Ids of a text, slice by slice."""
        for _, ids in self.encode_many([text]):
            yield ids


@lru_cache(1 << 12)
def _is_space(c: str) -> bool:
    return regex.match(r"\s", c) is not None


class IdsToText:
    """Incremental state machine from ids to text: ids become bytes, incomplete characters wait for their next bytes."""

    def __init__(self, of_id: list[bytes]):
        self.of_id = of_id
        self.machine = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: bytes) -> str:
        of_id = self.of_id
        return self.machine.decode(b"".join([of_id[i] for i in np.frombuffer(ids, "<u4").tolist()]))

    def close(self) -> str:
        return self.machine.decode(b"", True)


class Decoder:
    def __init__(self, vocab: Vocabulary):
        self.text = vocab.text

    def machine(self) -> IdsToText:
        return IdsToText(self.text)

    def decode(self, id_slices: Iterable[bytes]) -> Iterator[str]:
        machine = self.machine()
        for ids in id_slices:
            yield machine.feed(ids)
        yield machine.close()


@lru_cache(2)
def _coders(path: str) -> tuple[Encoder, Decoder]:
    vocab = Vocabulary(path)
    return Encoder(vocab), Decoder(vocab)


def encode_documents(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, n_tokens, token_ids (binary: little-endian unsigned 32-bit integers) and decoded (their text).

    ``vocabulary`` is the path of the vocabulary file on the executors.
    """
    kind = docs.select(F.col(id_col).alias(id_col)).schema[0].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, decoder = _coders(vocabulary)
        for b in batches:
            ids = b.column(0)
            of_ids, of_text = [], []
            rows = encoder.encode_many(value.as_py() or "" for value in b.column(1))
            number, part = next(rows, (-1, b""))
            for row in range(b.num_rows):
                machine, kept_ids, kept_text = decoder.machine(), [], []
                while number == row:
                    kept_ids.append(part)
                    kept_text.append(machine.feed(part))
                    number, part = next(rows, (-1, b""))
                of_ids.append(b"".join(kept_ids))
                of_text.append("".join([*kept_text, machine.close()]))
            yield arrow_out(pa.schema([(id_col, ids.type), ("n_tokens", pa.int64()), ("token_ids", pa.binary()), ("decoded", pa.string())]),
                            {id_col: ids, "n_tokens": [len(x) // 4 for x in of_ids], "token_ids": of_ids, "decoded": of_text})

    return small_batches(docs).select(F.col(id_col).alias(id_col), F.col(text_col).cast("string").alias("__text")).mapInArrow(
        freed(run), f"`{id_col}` {kind}, n_tokens long, token_ids binary, decoded string")
