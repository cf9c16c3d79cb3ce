"""Word-end BPE by an index of pair occurrences, and decoding."""

from __future__ import annotations

import functools
import heapq
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from riskloom.llm.vocab import parts, vocabulary

VOCABULARY = "word_bpe_49k.json"
NEVER = np.int32(2**31 - 1)
#: A task forgets its chunks' ids when it holds ids of so many chunks or chunks of so many characters.
KNOWN_CHUNKS, KNOWN_CHARS = 300_000, 10_000_000
SPACE = re.compile(r"\s")
#: Characters of texts that are encoded together.
BATCH_CHARS = 2_000_000
#: Chunks that go through the normaliser and splitter in one call.
TOGETHER = 1000


class Merges:
    """Ranks of (left id, right id) pairs: sorted keys, one binary search for many pairs."""

    def __init__(self, model: dict):
        ids = model["vocab"]
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        joined = np.array([ids[a + b] for a, b in pairs], dtype=np.int32)
        keys = np.array([ids[a] << 32 | ids[b] for a, b in pairs], dtype=np.int64)
        made = {int(token): rank for rank, token in enumerate(joined)}
        if any(made.get(ids[side], -1) >= rank for rank, pair in enumerate(pairs) for side in pair):
            raise ValueError("a merge needs a token that a later merge makes")
        order = np.argsort(keys)
        self.keys, self.ranks, self.joined = keys[order], order.astype(np.int32), joined

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        wanted = left.astype(np.int64) << 32 | right.astype(np.int64)
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.ranks[at], NEVER)


class Occurrences:
    """The symbols of many pieces in one row, linked to their neighbours, and for each mergeable pair the list of all
    places at which it stands.

    A merge makes only pairs of higher rank (``Merges`` checks that), so ranks can be applied to all pieces at once in
    ascending order: every place of the least active rank is joined, and the pairs on both sides of each place are
    entered in the lists of their new ranks. Work and memory are in proportion to the number of symbols, for one long
    piece as for many short ones.
    """

    def __init__(self, merges: Merges, symbols: np.ndarray, sizes: np.ndarray):
        n = len(symbols)
        self.merges, self.ids, self.sizes = merges, symbols.copy(), sizes
        self.after, self.before = np.arange(1, n + 1, dtype=np.int32), np.arange(-1, n - 1, dtype=np.int32)
        ends = np.cumsum(sizes)
        self.after[ends - 1] = -1
        self.before[ends - sizes] = -1
        self.alive = np.ones(n, dtype=bool)
        self.rank = np.full(n, NEVER, dtype=np.int32)
        self.places: dict[int, list[np.ndarray]] = {}
        self.active: list[int] = []
        self.enter(np.flatnonzero(self.after >= 0))

    def enter(self, at: np.ndarray) -> None:
        """Rank the pairs that start at these places (ascending) and append each to its rank's list."""
        rank = self.merges.find(self.ids[at], self.ids[self.after[at]])
        self.rank[at] = rank
        held = rank != NEVER
        at, rank = at[held], rank[held]
        if not len(at):
            return
        order = np.argsort(rank, kind="stable")
        at, rank = at[order], rank[order]
        cuts = np.flatnonzero(rank[1:] != rank[:-1]) + 1
        for r, here in zip(rank[np.concatenate([[0], cuts])].tolist(), np.split(at, cuts)):
            if r not in self.places:
                self.places[r] = []
                heapq.heappush(self.active, r)
            self.places[r].append(here)

    def run(self) -> list[bytes]:
        """Ids of each piece as little-endian unsigned 32-bit integers."""
        while self.active:
            r = heapq.heappop(self.active)
            lists = self.places.pop(r)
            at = ascending(lists)
            at = at[self.rank[at] == r]
            if len(at):
                self.join(at, self.merges.joined[r])
        raw = self.ids[self.alive].astype("<u4").tobytes()
        left = np.add.reduceat(self.alive, np.cumsum(self.sizes) - self.sizes) if len(self.sizes) else self.sizes
        ends = np.cumsum(left, dtype=np.int64) * 4
        return [raw[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())]

    def join(self, at: np.ndarray, token: int) -> None:
        right = self.after[at]
        if self.ids[at[0]] == self.ids[right[0]]:
            at = every_other(at, right)
            right = self.after[at]
        self.ids[at] = token
        self.alive[right] = False
        self.rank[at] = self.rank[right] = NEVER
        beyond = self.after[right]
        self.after[at] = beyond
        more = beyond >= 0
        self.before[beyond[more]] = at[more]
        before = self.before[at]
        before = before[before >= 0]
        fresh = at[more]
        if len(before):
            fresh = ascending([before, fresh])
        if len(fresh):
            self.enter(fresh)


def ascending(lists: list[np.ndarray]) -> np.ndarray:
    """The distinct values of the lists in order."""
    if len(lists) == 1:
        return lists[0]
    merged = np.concatenate(lists)
    merged.sort()
    return merged[np.concatenate([[True], merged[1:] != merged[:-1]])]


def every_other(at: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Of places whose pairs may overlap, as in a run of equal symbols, the first, third, ... of each run."""
    chained = np.concatenate([[False], right[:-1] == at[1:]])
    starts = np.flatnonzero(~chained)
    nth = np.arange(len(at)) - np.repeat(starts, np.diff(np.append(starts, len(at))))
    return at[nth % 2 == 0]


class ChunkEncoder:
    """Ids of texts. The tokenizer file's normaliser and splitter never join what a blank or line feed parts, so each
    distinct chunk between these is split into pieces once a task, and the new pieces of a batch are merged together.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        ids, suffix = spec["model"]["vocab"], spec["model"]["end_of_word_suffix"]
        self.merges = Merges(spec["model"])
        # First symbols by code point: of a character inside a piece and of a piece's last one.
        letters = [c for c in ids if len(c) == 1]
        self.inner, self.last = (np.full(max(map(ord, letters)) + 1, -1, dtype=np.int32) for _ in range(2))
        for c in letters:
            self.inner[ord(c)], self.last[ord(c)] = ids[c], ids[c + suffix]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.cut = re.compile("(" + "|".join(map(re.escape, self.special)) + ")")
        library = Tokenizer.from_file(path)
        self.normal, self.split = library.normalizer.normalize_str, library.pre_tokenizer.pre_tokenize_str
        # The file's own pattern, for chunks of printable ASCII: there its normaliser only lowers letters, and the bytes
        # of a piece are its characters. Blanks between the chunks are matched as well.
        rule = next(r for r in spec["pre_tokenizer"]["pretokenizers"] if r["type"] == "Split")
        self.ascii_pieces = regex.compile(rule["pattern"]["Regex"] + "| ").findall
        self.known: dict[str, bytes] = {}
        self.piece_ids: dict[str, bytes] = {}
        self.held = 0

    def ascii_split(self, chunks: list[str]) -> Iterator[list[str]]:
        """The pieces of each chunk of printable ASCII."""
        found: list[str] = []
        for piece in self.ascii_pieces(" ".join(chunks).lower() + " "):
            if piece == " ":
                yield found
                found = []
            else:
                found.append(piece)

    def pieces(self, chunks: list[str]) -> list[list[str]]:
        """The pieces of chunks without white space; many go through the library in one call, with blanks between them."""
        normal = self.normal(" ".join(chunks))
        found: list[list[str]] = [[] for _ in chunks]
        ends = iter(np.cumsum([len(c) + 1 for c in normal.split(" ")]).tolist())
        k, end = 0, next(ends)
        for piece, (start, _) in self.split(normal):
            while start >= end:
                k, end = k + 1, next(ends)
            found[k].append(piece)
        return found

    def alone(self, chunk: str) -> list[str]:
        """The pieces of any chunk."""
        return [piece for piece, _ in self.split(self.normal(chunk))]

    def merged(self, pieces: list[str]) -> dict[str, bytes]:
        """Ids of each of these distinct pieces."""
        sizes = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces))
        points = np.frombuffer("".join(pieces).encode("utf-32-le"), dtype="<u4")
        symbols, ends = self.inner[points], np.cumsum(sizes) - 1
        symbols[ends] = self.last[points[ends]]
        return dict(zip(pieces, Occurrences(self.merges, symbols, sizes).run()))

    def learn(self, chunks: list[str]) -> None:
        """Enter chunks that are not known yet."""
        odd = [c for c in chunks if "|" in c and self.cut.search(c)]
        marked = [[part if k % 2 else self.alone(part) for k, part in enumerate(self.cut.split(c))] for c in odd]
        rest = set(chunks).difference(odd)
        simple = [c for c in rest if c.isascii() and c.isprintable()]
        spaced = [c for c in rest.difference(simple) if SPACE.search(c)]
        other = list(rest.difference(simple, spaced))
        plain = simple + other + spaced
        found = list(self.ascii_split(simple)) if simple else []
        found += [made for i in range(0, len(other), TOGETHER) for made in self.pieces(other[i : i + TOGETHER])]
        found += map(self.alone, spaced)
        distinct = set().union(*found, *(part for parted in marked for part in parted[::2]))
        ids = self.piece_ids
        ids.update(self.merged(list(distinct - ids.keys())))
        for chunk, made in zip(plain, found):
            self.known[chunk] = ids[made[0]] if len(made) == 1 else b"".join([ids[p] for p in made])
        for chunk, parted in zip(odd, marked):
            self.known[chunk] = b"".join(
                self.special[part].to_bytes(4, "little") if k % 2 else b"".join([ids[p] for p in part])
                for k, part in enumerate(parted)
            )

    def __call__(self, texts: list[str]) -> list[bytes]:
        chunks = [text.replace("\n", " ").split(" ") for text in texts]
        if len(self.known) > KNOWN_CHUNKS or self.held > KNOWN_CHARS:
            self.known, self.piece_ids, self.held = {}, {}, 0
        fresh = list(set().union(*chunks) - self.known.keys())
        self.held += sum(map(len, fresh))
        self.learn(fresh)
        return [b"".join(map(self.known.__getitem__, split)) for split in chunks]


@functools.cache
def encoder_of(path: str) -> ChunkEncoder:
    return ChunkEncoder(path)


def encode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id and ids (array<int>) of every text, by a word-end BPE of a tokenizer file.

    As the file's library encodes: strings of special tokens in a text are these tokens, none are added. No shuffle:
    each task encodes the rows of its split, and its distinct pieces are merged once. A null or empty text has no ids
    (an empty array, not null). Null and repeated doc_ids are kept; an empty table gives no rows; other columns are
    ignored.
    """
    path = path or vocabulary(VOCABULARY)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(path)
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            start = 0
            for part in parts(texts, BATCH_CHARS):
                raw = encoder(part)
                ends = np.concatenate([[0], np.cumsum([len(r) // 4 for r in raw])]).astype(np.int32)
                ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(raw), dtype="<i4")))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(start, len(part)), ids], ["doc_id", "ids"])
                start += len(part)

    chosen = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return chosen.mapInArrow(run, "doc_id bigint, ids array<int>")


@functools.cache
def tokens_of(path: str) -> pa.Array:
    """The token of each id, null where the vocabulary has none."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    named = spec["model"]["vocab"] | {t["content"]: t["id"] for t in spec["added_tokens"]}
    tokens: list[str | None] = [None] * (max(named.values()) + 1)
    for token, i in named.items():
        tokens[i] = token
    return pa.array(tokens, pa.string())


def joined(ids: pa.ListArray, tokens: pa.Array) -> pa.Array:
    """The tokens of each list joined by one blank; what stands for no token is left out."""
    flat = pc.list_flatten(ids)
    known = pc.fill_null(pc.and_(pc.greater_equal(flat, 0), pc.less(flat, len(tokens))), False)
    found = tokens.take(pc.if_else(known, flat, None))
    kept = pc.is_valid(found)
    lengths = pc.fill_null(pc.list_value_length(ids), 0).to_numpy()
    ends = np.concatenate([[0], np.cumsum(lengths)])
    left = np.concatenate([[0], np.cumsum(kept.to_numpy(zero_copy_only=False))])[ends].astype(np.int32)
    texts = pc.binary_join(pa.ListArray.from_arrays(pa.array(left), found.filter(kept)), " ")
    return pc.if_else(pc.is_valid(ids), texts, None)


def decode(coded: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, ids and ``decoded``: the tokens of the column ``ids`` joined by one blank, as the library decodes a file
    without decoder, special tokens included.

    Ids that the vocabulary does not know and null ids are left out, null arrays give null. Other columns are ignored.
    """
    path = path or vocabulary(VOCABULARY)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 500):
                part = batch.slice(i, 500)
                texts = joined(part.column(1), tokens_of(path))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), texts], ["doc_id", "ids", "decoded"])

    chosen = coded.select(F.col("doc_id").cast("bigint"), F.col("ids").cast("array<int>"))
    return chosen.mapInArrow(run, "doc_id bigint, ids array<int>, decoded string")
