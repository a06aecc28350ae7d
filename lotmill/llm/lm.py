"""Language-model scores by a weighted backoff automaton over smoothed word bigrams.

Counts are taken over all training documents. They never meet in one place: documents are
dealt into blocks of bounded size, each block asks for the counts of its own
n-grams, and so gets just the states and arcs that its texts can reach.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotmill.llm.common import by_bytes, held_out, mix, word_hashes, words

# No word holds white space, so these are none.
START, END = word_hashes([b"\t", b"\n"])
# Weight of the shorter history, in tokens.
PRIOR = 8.0
BLOCK_BYTES = 4_000_000
BLOCKS_PER_SHARD = 2


def tokens(text: str | None) -> np.ndarray:
    """Hashes of the words of a text and of the end."""
    return np.append(word_hashes(words(text)) if text else np.empty(0, np.uint64), END)


@dataclass
class Grams:
    """The n-grams of a block: distinct sorted keys, the place of each token's key, and training counts."""

    starts: np.ndarray
    word_keys: np.ndarray
    word_at: np.ndarray
    word_train: np.ndarray
    pair_keys: np.ndarray
    pair_at: np.ndarray
    pair_train: np.ndarray
    train_docs: int


def grams(texts: list[str | None], train: np.ndarray) -> Grams:
    own = [tokens(t) for t in texts]
    lengths = np.array([len(t) for t in own], np.int64)
    flat = np.concatenate(own) if own else np.empty(0, np.uint64)
    starts = np.cumsum(lengths) - lengths
    before = np.empty_like(flat)
    before[1:] = flat[:-1]
    before[starts] = START
    word_keys, word_at = np.unique(flat, return_inverse=True)
    pair_keys, pair_at = np.unique(mix(mix(before) ^ flat), return_inverse=True)
    learn = np.repeat(train, lengths)
    count = lambda at, keys: np.bincount(at[learn], minlength=len(keys))
    return Grams(starts, word_keys, word_at, count(word_at, word_keys), pair_keys, pair_at, count(pair_at, pair_keys), int(train.sum()))


class BackoffAutomaton:
    """States are histories, arcs the n-grams seen after them, failure arcs lead to the shorter history.

    A missing arc costs the weight of the failure arc and is sought again from the state it
    leads to; the root has an arc for every word. Every arc leads to the state of its word.
    """

    ROOT = 0

    def __init__(self, words: int, root: list[float]):
        self.words = words
        self.arcs: dict[int, float] = dict(enumerate(root))  # of the root: state 0
        self.failure = [0.0] * (words + 2)
        self.start = words + 1

    def state(self, word: int) -> int:
        return word + 1

    def add_arcs(self, states: np.ndarray, next_words: np.ndarray, weights: np.ndarray) -> None:
        self.arcs.update(zip((states * self.words + next_words).tolist(), weights.tolist()))

    def score(self, text: list[int]) -> float:
        """Sum of the log-probabilities of a text, read once from left to right."""
        arcs, failure, n, state, total = self.arcs, self.failure, self.words, self.start, 0.0
        for word in text:
            weight = arcs.get(state * n + word)
            if weight is None:
                total += failure[state] + arcs[word]
            else:
                total += weight
            state = word + 1
        return total


def automaton(block: Grams, word_count: np.ndarray, pair_count: np.ndarray, totals: tuple[int, int, int], prior: float) -> BackoffAutomaton:
    """The part of the model that the block's texts can reach.

    The shorter history weighs as much as ``prior`` tokens:
    P(w | v) = (c(v w) + prior P(w)) / (c(v) + prior), P(w) = (c(w) + 1) / (N + V + 1).
    """
    n_tokens, n_words, n_docs = totals
    n = len(block.word_keys)
    plain = (word_count + 1) / (n_tokens + n_words + 1)
    made = BackoffAutomaton(n, np.log10(plain).tolist())
    history = np.append(word_count, n_docs)  # of the words, then of the start
    made.failure = [0.0, *np.log10(prior / (history + prior)).tolist()]
    first = np.zeros(len(block.pair_keys), np.int64)
    first[block.pair_at[::-1]] = np.arange(len(block.pair_at))[::-1]  # where each pair stands first
    seen = np.flatnonzero(pair_count > 0)
    at = first[seen]
    left = np.where(np.isin(at, block.starts), n, block.word_at[at - 1])
    right = block.word_at[at]
    made.add_arcs(left + 1, right, np.log10((pair_count[seen] + prior * plain[right]) / (history[left] + prior)))
    return made


def _shard(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each key; grows with the key, so sorted keys are sorted by shard."""
    return ((keys >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)


def pack(values: np.ndarray) -> bytes:
    """Whole numbers as bytes of equal weight side by side, so that Spark's block compression takes the empty ones."""
    return values.view(np.uint8).reshape(-1, values.itemsize).T.tobytes()


def unpack(data: bytes, kind) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(width, -1).T).view(kind).reshape(-1)


def pack_sorted(keys: np.ndarray) -> bytes:
    """Sorted keys as packed differences."""
    return pack(np.diff(keys, prepend=np.uint64(0)))


def unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data, np.uint64), dtype=np.uint64)


def _by_shard(keys: np.ndarray, counts: np.ndarray, shards: int):
    """(shard, keys, counts) of sorted keys."""
    cuts = np.searchsorted(_shard(keys, shards), np.arange(shards + 1))
    for shard, (a, b) in enumerate(zip(cuts, cuts[1:])):
        if a < b:
            yield shard, pack_sorted(keys[a:b]), pack(counts[a:b].astype(np.uint32))


def _totals(docs: DataFrame, shards: int) -> tuple[int, int, int]:
    """Training tokens, distinct training tokens, training documents."""

    def counted(batches):
        for batch in by_bytes(batches, "text"):
            texts = batch.column("text").to_pylist()
            if not texts:
                continue
            keys, counts = np.unique(np.concatenate([tokens(t) for t in texts]), return_counts=True)
            rows = [(s, k, c, 0) for s, k, c in _by_shard(keys, counts, shards)]
            rows.append((0, b"", b"", len(texts)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in zip(zip(*rows), (pa.int32(), pa.binary(), pa.binary(), pa.int64()))], names=["shard", "k", "c", "docs"]
            )

    def summed(group: pd.DataFrame) -> pd.DataFrame:
        keys, counts = np.concatenate([unpack_sorted(k) for k in group["k"]]), np.concatenate([unpack(c, np.uint32) for c in group["c"]])
        return pd.DataFrame({"n": [int(counts.sum())], "v": [len(np.unique(keys))], "docs": [int(group["docs"].sum())]})

    parts = docs.filter("NOT held_out").select("text").mapInArrow(counted, "shard int, k binary, c binary, docs long")
    row = parts.groupBy("shard").applyInPandas(summed, "n long, v long, docs long").agg(F.sum("n"), F.sum("v"), F.sum("docs")).first()
    return int(row[0] or 0), int(row[1] or 0), int(row[2] or 0)


def score_documents(docs: DataFrame, modulus: int = 7, left: int = 2, prior: float = PRIOR) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row of ``docs``.

    Documents of the held-out fold are scored and not learned from; one with a null id is learned
    from. A null text is an empty one: the end alone. Repeated rows count and are scored each.
    Scores are log10, rounded to six digits; without any training token all words are equally unknown.
    Columns other than doc_id and text are not read.

    Each block sends its distinct keys, packed and cut by key range, to shards that add the
    training counts of all blocks and answer in the order of the question. Blocks and shards
    grow in number with the text, not in size; a frequent n-gram is asked for once per block.
    """
    bytes_ = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-bytes_ // BLOCK_BYTES))
    shards = max(1, -(-blocks // BLOCKS_PER_SHARD))
    rows = docs.select("doc_id", "text", held_out(F.col("doc_id"), modulus, left).alias("held_out"))
    totals = _totals(rows, shards)
    dealt = rows.withColumn("block", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(blocks)).cast("int"))

    def ask(block: pd.DataFrame) -> pd.DataFrame:
        g = grams(block["text"].tolist(), ~block["held_out"].to_numpy(bool))
        asked = [(1, *x) for x in _by_shard(g.word_keys, g.word_train, shards)] + [(2, *x) for x in _by_shard(g.pair_keys, g.pair_train, shards)]
        out = pd.DataFrame(asked, columns=["gram", "shard", "k", "c"])
        out.insert(0, "block", block["block"].iloc[0])
        return out

    def answer(shard: pd.DataFrame) -> pd.DataFrame:
        keys = [unpack_sorted(k) for k in shard["k"]]
        _, at = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.bincount(at, np.concatenate([unpack(c, np.uint32) for c in shard["c"]])).astype(np.uint64)
        cuts = np.cumsum([len(k) for k in keys])[:-1]
        kind = np.uint32 if total.max() < 2**32 else np.uint64
        answers = [pack(x) for x in np.split(total[at].astype(kind), cuts)]
        return pd.DataFrame({"block": shard["block"], "gram": shard["gram"], "shard": shard["shard"], "width": np.dtype(kind).itemsize, "c": answers})

    def score(block: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        g = grams(block["text"].tolist(), ~block["held_out"].to_numpy(bool))
        answers = answers.sort_values(["gram", "shard"])
        counts = {1: [np.empty(0, np.int64)], 2: [np.empty(0, np.int64)]}
        for gram, width, c in zip(answers["gram"], answers["width"], answers["c"]):
            counts[gram].append(unpack(c, f"u{width}").astype(np.int64))
        word_count, pair_count = np.concatenate(counts[1]), np.concatenate(counts[2])
        if len(word_count) != len(g.word_keys) or len(pair_count) != len(g.pair_keys):
            raise RuntimeError("the input gave other rows when it was read again")
        model = automaton(g, word_count, pair_count, totals, prior)
        ends = np.append(g.starts[1:], len(g.word_at))
        plain = np.log10((word_count + 1) / (totals[0] + totals[1] + 1))[g.word_at]
        known = (word_count > 0)[g.word_at].astype(np.int64)
        return pd.DataFrame(
            {
                "doc_id": block["doc_id"],
                "held_out": block["held_out"],
                "n_tokens": ends - g.starts,
                "n_known": np.add.reduceat(known, g.starts),
                "train_tokens": totals[0],
                "base_score": np.round(np.add.reduceat(plain, g.starts), 6),
                "score": np.round([model.score(g.word_at[a:b].tolist()) for a, b in zip(g.starts, ends)], 6),
            }
        )

    asked = dealt.groupBy("block").applyInPandas(ask, "block int, gram int, shard int, k binary, c binary")
    answered = asked.groupBy("gram", "shard").applyInPandas(answer, "block int, gram int, shard int, width int, c binary")
    result = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return dealt.groupBy("block").cogroup(answered.groupBy("block")).applyInPandas(score, result)
