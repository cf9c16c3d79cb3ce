"""Subword lattice language model: every segmentation of a word into vocabulary pieces adds to its probability."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.exprs import text_of
from riskloom.llm.shingles import span_hashes, word_hashes, word_spans
from riskloom.llm.vocab import parts, vocabulary
from riskloom.session import materialize

VOCABULARY = "piece_bpe_32k.model"
BLANK = "▁"  # stands for the blank before a word in the vocabulary
HELD_OUT = 2
MODULUS = 7
#: Rounds of expectation and maximisation over the distinct training words.
ROUNDS = 2
#: Words with at least this share of all words go to every task; there can be 500,000 of them at most.
COMMON_SHARE = 1 / 500_000
#: Cells (words times bytes) of one matrix.
CELLS = 400_000
STEP = np.uint64(0x9E3779B97F4A7C15)
LN10 = float(np.log(10.0))


@dataclass
class Pieces:
    """The vocabulary as byte strings, a blank standing for the start of a word, and their log probabilities.

    Pieces that start a word and all others are two distributions; ``stop`` and ``go`` are the log probabilities that
    a word ends, or goes on, after a piece.
    """

    pieces: list[bytes]
    logs: np.ndarray
    stop: float
    go: float


def read_pieces(path: str) -> Pieces:
    """Pieces of the vocabulary and the 256 single bytes. The stored scores are the negative ranks of the pieces; as
    first weights they follow Zipf's law, and single bytes come last."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    score: dict[bytes, float] = {}
    for i in range(model.get_piece_size()):
        if model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i):
            continue
        piece = model.id_to_piece(i).replace(BLANK, " ").encode()
        if b" " not in piece[1:]:
            score[piece] = max(score.get(piece, -np.inf), model.get_score(i))
    last = min(score.values()) - 1.0
    for b in range(256):
        score.setdefault(bytes([b]), last)
    pieces = sorted(score)
    weights = np.array([1.0 / (2.0 - score[p]) for p in pieces])
    return normalised(pieces, weights, 1.0, 2.0)


def normalised(pieces: list[bytes], weights: np.ndarray, n_words: float, n_pieces: float) -> Pieces:
    first = np.array([p[:1] == b" " for p in pieces])
    logs = np.where(first, np.log(weights / weights[first].sum()), np.log(weights / weights[~first].sum()))
    return Pieces(pieces, logs, float(np.log(n_words / n_pieces)), float(np.log1p(-n_words / n_pieces)))


class Lattice:
    """Forward and backward sums over words, in matrices of words of similar length."""

    def __init__(self, model: Pieces):
        self.model = model
        self.longest = max(map(len, model.pieces))
        top = self.longest + 1
        self.power = np.cumprod(np.concatenate([[np.uint64(1)], np.full(top, STEP)]), dtype=np.uint64)
        self.tables = []  # by length: sorted hashes and their piece numbers
        for size in range(1, top):
            own = [k for k, p in enumerate(model.pieces) if len(p) == size]
            cells = np.frombuffer(b"".join(model.pieces[k] for k in own), dtype=np.uint8).reshape(-1, size)
            hashes = ((cells.astype(np.uint64) + np.uint64(1)) * self.power[:size]).sum(axis=1, dtype=np.uint64)
            order = np.argsort(hashes)
            self.tables.append((hashes[order], np.array(own, dtype=np.int64)[order]))

    def edges(self, cells: np.ndarray) -> list[list[tuple[int, np.ndarray, np.ndarray, np.ndarray]]]:
        """By the byte where they start: the size, rows, numbers and log weights of the pieces found there. Only the
        first piece of a word is not preceded by another."""
        width, n = cells.shape
        value = cells.astype(np.uint64) + np.uint64(1)
        out: list[list] = [[] for _ in range(width)]
        hashes = np.zeros((width, n), dtype=np.uint64)
        for size, (known, numbers) in enumerate(self.tables, 1):
            if size > width:
                break
            hashes = hashes[: width - size + 1] + value[size - 1 :] * self.power[size - 1]
            if not len(known):
                continue
            at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
            starts, rows = np.nonzero(known[at] == hashes)
            found = numbers[at[starts, rows]]
            logs = self.model.logs[found] + np.where(starts > 0, self.model.go, 0.0)
            cuts = np.searchsorted(starts, np.arange(width - size + 2))
            for start, (a, b) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist())):
                if b > a:
                    out[start].append((size, rows[a:b], found[a:b], logs[a:b]))
        return out

    def forward(self, edges: list[list], width: int, n: int) -> np.ndarray:
        alpha = np.full((width + 1, n), -np.inf)
        alpha[0] = 0.0
        for start in range(width):
            for size, rows, _, logs in edges[start]:
                end = alpha[start + size]
                end[rows] = np.logaddexp(end[rows], alpha[start][rows] + logs)
        return alpha

    def backward(self, edges: list[list], width: int, n: int) -> np.ndarray:
        beta = np.full((width + 1, n), -np.inf)
        beta[width] = 0.0
        for start in range(width - 1, -1, -1):
            begin = beta[start]
            for size, rows, _, logs in edges[start]:
                begin[rows] = np.logaddexp(begin[rows], beta[start + size][rows] + logs)
        return beta

    def groups(self, texts: list[str]) -> Iterator[tuple[list[int], np.ndarray]]:
        """Words of one length in bytes (with the blank before them), one per column of matrices of bounded size."""
        coded = [b" " + t.encode() for t in texts]
        by_size: dict[int, list[int]] = {}
        for k, c in enumerate(coded):
            by_size.setdefault(len(c), []).append(k)
        for size, rows in by_size.items():
            step = max(1, CELLS // size)
            for i in range(0, len(rows), step):
                part = rows[i : i + step]
                cells = np.frombuffer(b"".join(coded[k] for k in part), dtype=np.uint8).reshape(-1, size)
                yield part, np.ascontiguousarray(cells.T)

    def log10(self, texts: list[str]) -> np.ndarray:
        """log10 of the sum over all segmentations of each word."""
        out = np.zeros(len(texts))
        for rows, cells in self.groups(texts):
            alpha = self.forward(self.edges(cells), *cells.shape)
            out[rows] = (alpha[-1] + self.model.stop) / LN10
        return out

    def expected(self, texts: list[str]) -> np.ndarray:
        """How often each piece is used in the words, over all segmentations by their shares."""
        total = np.zeros(len(self.model.pieces))
        for _, cells in self.groups(texts):
            edges = self.edges(cells)
            alpha, beta = self.forward(edges, *cells.shape), self.backward(edges, *cells.shape)
            for start, found in enumerate(edges):
                for size, rows, numbers, logs in found:
                    share = np.exp(alpha[start][rows] + logs + beta[start + size][rows] - alpha[-1][rows])
                    total += np.bincount(numbers, share, len(total))
        return total


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % MODULUS == HELD_OUT, F.lit(False))


def word_counts(docs: DataFrame) -> DataFrame:
    """Every lower-cased word (A to Z) of all texts with its count (``total``) and that in the texts to learn from
    (``seen``). Tasks count batches of texts first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            learn, start = batch.column(0).to_numpy(zero_copy_only=False).astype(float), 0
            for part in parts(batch.column(1).to_pylist()):
                data, starts, ends, counts = word_spans(part)
                _, first, own, total = np.unique(
                    span_hashes(data, starts, ends), return_index=True, return_inverse=True, return_counts=True
                )
                seen = np.bincount(own, np.repeat(learn[start : start + len(part)], counts), len(total))
                raw = data.tobytes()
                found = [raw[a:b] for a, b in zip(starts[first].tolist(), ends[first].tolist())]
                yield pa.RecordBatch.from_arrays([
                    pa.array(found, pa.binary()).cast(pa.string()), pa.array(total), pa.array(seen.astype(np.int64)),
                ], ["token", "total", "seen"])
                start += len(part)

    rows = docs.select((~held_out(F.col("doc_id"))).alias("learn"), text_of("text").alias("text"))
    counted = rows.mapInArrow(run, "token string, total bigint, seen bigint")
    return counted.groupBy("token").agg(F.sum("total").alias("total"), F.sum("seen").alias("seen"))


def fit_pieces(counts: DataFrame, path: str, rounds: int = ROUNDS) -> Pieces:
    """Piece probabilities from the distinct training words: the vocabulary's scores weigh the first round's
    segmentations. Each word counts once, as the lattice stands for words not seen yet. Only sums per piece (a
    vocabulary's length of them) reach the driver."""
    model = read_pieces(path)
    training = counts.filter("seen > 0").select("token")
    n_words = training.count()
    for _ in range(rounds):
        def run(batches: Iterator[pa.RecordBatch], model: Pieces = model) -> Iterator[pa.RecordBatch]:
            lattice, total = Lattice(model), np.zeros(len(model.pieces))
            for batch in batches:
                total += lattice.expected(batch.column(0).to_pylist())
            used = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["piece", "uses"])

        sums = training.mapInArrow(run, "piece bigint, uses double").groupBy("piece").agg(F.sum("uses").alias("uses"))
        uses = np.full(len(model.pieces), 0.1)
        for row in sums.collect():
            uses[row.piece] += row.uses
        model = normalised(model.pieces, uses, n_words + 1.0, uses.sum() + 2.0)
    return model


def with_word_logs(counts: DataFrame, model: Pieces) -> DataFrame:
    """``word`` (a 64-bit hash) and ``lattice`` (log10 of the lattice's probability) of each word."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = Lattice(model)
        for batch in batches:
            texts = batch.column(0).to_pylist()
            words = word_hashes(texts, lower=False)[0].view(np.int64)
            yield pa.RecordBatch.from_arrays([
                pa.array(words), batch.column(1), batch.column(2), pa.array(lattice.log10(texts)),
            ], ["word", "total", "seen", "lattice"])

    schema = "word bigint, total bigint, seen bigint, lattice double"
    return counts.select("token", "total", "seen").mapInArrow(run, schema)


def text_sums(rows: DataFrame, common: np.ndarray, logs: np.ndarray) -> tuple[DataFrame, DataFrame]:
    """Of frames (doc_id, row, text): the sums over each row's common words, and its other words with their counts.

    ``common`` holds sorted word hashes, ``logs`` their (known, base, own) in three lines.
    """
    def looked_up(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            start = 0
            for part in parts(batch.column(2).to_pylist()):
                words, counts = word_hashes(part)
                own = np.repeat(np.arange(len(part)), counts)
                at = np.minimum(np.searchsorted(common, words), max(len(common) - 1, 0))
                hit = common[at] == words if len(common) else np.zeros(len(words), dtype=bool)
                yield batch.slice(start, len(part)), words, counts, own, at, hit
                start += len(part)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, _, counts, own, at, hit in looked_up(batches):
            known, base, chosen = (np.bincount(own[hit], line[at[hit]], len(counts)) for line in logs)
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), pa.array(counts.astype(np.int64)), pa.array(known.astype(np.int64)),
                pa.array(base), pa.array(chosen),
            ], ["doc_id", "row", "n_words", "known", "base", "own"])

    def others(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, words, _, own, _, hit in looked_up(batches):
            pairs = np.stack([own[~hit].astype(np.uint64), words[~hit]])
            pairs, uses = np.unique(pairs, axis=1, return_counts=True) if pairs.size else (pairs, np.zeros(0, np.int64))
            row = batch.column(1).to_numpy()[pairs[0].astype(np.int64)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(row), pa.array(pairs[1].view(np.int64)), pa.array(uses.astype(np.int64))], ["row", "word", "uses"]
            )

    return (
        rows.mapInArrow(sums, "doc_id bigint, row bigint, n_words bigint, known bigint, base double, own double"),
        rows.mapInArrow(others, "row bigint, word bigint, uses bigint"),
    )


def score(docs: DataFrame, path: str | None = None, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row.

    Texts whose crc32(doc_id as text) mod 7 is not 2 are learnt from. A word's probability is its discounted share of
    the training tokens, plus what the discount frees times the lattice's probability: the sum over all segmentations
    of the word into pieces of the vocabulary, by the forward recursion in log space. Piece probabilities start from
    the vocabulary's scores and are refitted on the training words. A text's probability is the product over its words
    and its end; over all words it sums to one at most, unlike the base score, which grants each unseen word as much.

    Counts cover all texts. Words with a large share of the corpus, a bounded number of them, are looked up in the
    tasks; the others of a text meet the counts in a shuffle, by 64-bit hashes.

    A null text is empty and has only its end. A null doc_id is learnt from. Repeated rows are rows of their own. An
    empty table gives no rows; without any training text only the lattice counts. Other columns are ignored.
    """
    path = path or vocabulary(VOCABULARY)
    counts = materialize(word_counts(docs), "words")
    n, distinct, once, twice, total = counts.agg(
        F.coalesce(F.sum("seen"), F.lit(0)), F.count_if(F.col("seen") > 0), F.count_if(F.col("seen") == 1),
        F.count_if(F.col("seen") == 2), F.coalesce(F.sum("total"), F.lit(0)),
    ).first()
    ends = docs.filter(~held_out(F.col("doc_id"))).count()
    n, distinct = n + ends, distinct + (ends > 0)
    model = fit_pieces(counts, path, rounds)
    discount = (once + 1) / (once + 2 * twice + 2)
    unseen = discount * distinct / n if n else 1.0
    counted = F.greatest(F.col("seen") - discount, F.lit(0.0)) / max(n, 1)
    likely = counted + unseen * F.pow(F.lit(10.0), F.col("lattice"))
    # far below the smallest double, where no count helps, the logarithm is put together from its parts
    log_likely = F.when((F.col("seen") > 0) | (F.col("lattice") > -290), F.log10(likely)).otherwise(
        F.col("lattice") + float(np.log10(unseen))
    )
    logs = materialize(with_word_logs(counts, model).select(
        "word", "total", (F.col("seen") > 0).cast("int").alias("known"),
        F.log10((F.col("seen") + 1) / F.lit(float(n + distinct + 1))).alias("base"), log_likely.alias("own"),
    ), "word-logs")
    frequent = logs.filter(F.col("total") >= total * COMMON_SHARE).orderBy("word").toPandas()  # 500,000 rows at most
    order = np.argsort(frequent["word"].to_numpy().astype(np.int64).view(np.uint64))
    common = frequent["word"].to_numpy().astype(np.int64).view(np.uint64)[order]
    lines = frequent[["known", "base", "own"]].to_numpy().astype(float)[order].T
    end = (float(ends > 0), float(np.log10((ends + 1) / (n + distinct + 1))), float(np.log10(max(ends - discount, 0.1) / max(n, 1))))

    rows = docs.select(F.col("doc_id").cast("bigint"), F.xxhash64("doc_id", text_of("text")).alias("row"),
                       text_of("text").alias("text"))
    summed, rare = text_sums(rows, common, lines)
    summed = materialize(summed, "text-sums")
    # rows of equal id and text share a key: their other words are summed over all of them
    copies = summed.groupBy("row").agg(F.count("*").alias("copies"))
    more = rare.join(logs.drop("total"), "word").groupBy("row").agg(
        *[F.sum(F.col("uses") * F.col(c)).alias(f"more_{c}") for c in ("known", "base", "own")]
    ).join(copies, "row")
    whole = summed.join(more, "row", "left")

    def added(name: str, at_end: float) -> Column:
        return F.col(name) + F.coalesce(F.col(f"more_{name}") / F.col("copies"), F.lit(0.0)) + F.lit(at_end)

    return whole.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), (F.col("n_words") + 1).alias("n_tokens"),
        F.round(added("known", end[0])).cast("bigint").alias("n_known"),
        F.lit(int(n)).cast("bigint").alias("train_tokens"), added("base", end[1]).alias("base_score"),
        added("own", end[2]).alias("score"),
    )
