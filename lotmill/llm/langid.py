"""Language identification: script ranges, per-word scores, and Viterbi with a switching penalty.

A word is a run of letters. Its letters' script leaves the languages that were
learned with that script; each of these scores the word by its letter n-grams; Viterbi
then labels all words of a text, where a change of language costs a penalty.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotmill.llm.common import by_bytes, held_out

UNKNOWN = "und"
# Buckets of hashed letter n-grams; the model is this many numbers for each language.
BUCKETS = 2**15
SMOOTHING = 0.5
SWITCH = 8.0
# A language whose letters are less often of a script than this is no candidate for its words.
SCRIPT_SHARE = 0.001
FORBIDDEN = -1e4
# Words are scored for so many bytes of text at a time, and labelled for four times as many.
PART_BYTES = 250_000
# The model is held on the driver and sent to every task: 128 KB a language.
MOST_LANGUAGES = 1000

# Code point ranges of scripts, in order.
SCRIPTS = [
    ("latin", 0x0041, 0x024F),
    ("ipa", 0x0250, 0x02FF),
    ("greek", 0x0370, 0x03FF),
    ("cyrillic", 0x0400, 0x052F),
    ("armenian", 0x0530, 0x058F),
    ("hebrew", 0x0590, 0x05FF),
    ("arabic", 0x0600, 0x077F),
    ("devanagari", 0x0900, 0x097F),
    ("bengali", 0x0980, 0x09FF),
    ("tamil", 0x0B80, 0x0BFF),
    ("telugu", 0x0C00, 0x0C7F),
    ("thai", 0x0E00, 0x0E7F),
    ("georgian", 0x10A0, 0x10FF),
    ("hangul jamo", 0x1100, 0x11FF),
    ("ethiopic", 0x1200, 0x137F),
    ("khmer", 0x1780, 0x17FF),
    ("latin", 0x1E00, 0x1EFF),
    ("greek", 0x1F00, 0x1FFF),
    ("kana", 0x3040, 0x30FF),
    ("han", 0x3400, 0x9FFF),
    ("hangul", 0xAC00, 0xD7AF),
]
OTHER = "other"
NAMES = [*dict.fromkeys(name for name, _, _ in SCRIPTS), OTHER]


@cache
def _letter_scripts() -> np.ndarray:
    """Script number of every code point, -1 for what is no letter."""
    out = np.full(0x110000, -1, np.int8)
    out[[i for i in range(0x110000) if chr(i).isalpha()]] = NAMES.index(OTHER)
    for name, low, high in SCRIPTS:
        block = out[low : high + 1]
        block[block >= 0] = NAMES.index(name)
    return out


@dataclass
class Words:
    """The words of several texts: script and letters of each, text of each, and their n-grams."""

    text: np.ndarray
    script: np.ndarray
    letters: np.ndarray
    gram: np.ndarray
    gram_word: np.ndarray


def _bucket(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = (a * np.uint32(0x9E3779B1)) ^ (b * np.uint32(0x85EBCA77)) ^ (c * np.uint32(0xC2B2AE3D))
        h ^= h >> np.uint32(15)
        h *= np.uint32(0x2C1B3C6D)
    return (h >> np.uint32(17)).astype(np.int32)


def read_words(texts: list[str | None]) -> Words:
    """Lower-cased letter runs; n-grams are pairs and triples of letters with the word's edges."""
    lowered = [(t or "").lower() for t in texts]
    codes = np.frombuffer("\n".join([*lowered, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    ends = np.cumsum([len(t) + 1 for t in lowered])
    scripts = _letter_scripts()[codes] if len(codes) else np.empty(0, np.int8)
    letter = scripts >= 0
    z = np.where(letter, codes, 0).astype(np.uint32)
    at = np.flatnonzero(letter)
    before = np.concatenate([[0, 0], z]).astype(np.uint32)  # before[i + 1] is the letter in front of i
    first = before[at + 1] == 0
    word = np.cumsum(first) - 1
    one, two = before[at + 1], np.where(first, 0, before[at]).astype(np.uint32)
    here = z[at]
    last = np.append(z, 0)[at + 1] == 0
    edge = np.uint32(1)
    grams = [
        _bucket(np.full(len(at), 7, np.uint32), one, here),
        _bucket(two, one + edge, here),
        _bucket(one[last] + np.uint32(3), here[last], np.zeros(last.sum(), np.uint32)),
    ]
    starts = at[first]
    n = len(starts)
    return Words(
        np.searchsorted(ends, starts, "right"),
        scripts[starts].astype(np.int64),
        np.bincount(word, minlength=n) if n else np.empty(0, np.int64),
        np.concatenate(grams),
        np.concatenate([word, word, word[last]]),
    )


@dataclass
class Model:
    """Languages in order, log-probabilities of n-gram buckets, and the languages of each script."""

    languages: list[str]
    weights: np.ndarray
    allowed: np.ndarray

    def scores(self, words: Words) -> np.ndarray:
        """Score of each word (row) in each language (column)."""
        n, out = len(words.text), np.empty((len(words.text), len(self.languages)), np.float32)
        for k in range(len(self.languages)):
            out[:, k] = np.bincount(words.gram_word, self.weights[k][words.gram], n)
        narrow = self.allowed[words.script]
        out[~narrow & narrow.any(axis=1, keepdims=True)] += FORBIDDEN
        return out


def viterbi(scores: np.ndarray, texts: np.ndarray, n_texts: int, switch: float = SWITCH) -> np.ndarray:
    """Best label of each word; words of one text stand together, texts in order.

    All texts advance side by side, the longest first, a word at a step. Of equal ways the one
    without a change is taken, then the language that comes first.
    """
    path = np.zeros(len(scores), np.int16)
    lengths = np.bincount(texts, minlength=n_texts)
    starts = np.cumsum(lengths) - lengths
    order = np.argsort(-lengths, kind="stable")
    starts, lengths = starts[order], lengths[order]
    if not len(scores):
        return path
    steps = int(lengths[0])
    active = np.searchsorted(-lengths, -np.arange(steps), "left")  # texts longer than the step
    back = np.empty(scores.shape, np.int16)
    own = np.arange(scores.shape[1], dtype=np.int16)
    value = scores[starts[: active[0]]].copy()
    for t in range(1, steps):
        k = active[t]
        now = value[:k]
        best = now.argmax(axis=1)
        now -= now[np.arange(k), best][:, None]  # only differences count, and sums of long texts have no room for them in float32
        at = starts[:k] + t
        back[at] = np.where(now >= -np.float32(switch), own, best[:, None])
        np.maximum(now, -np.float32(switch), out=now)
        now += scores[at]
    label = value.argmax(axis=1).astype(np.int16)
    for t in range(steps - 1, -1, -1):
        at = starts[: active[t]] + t
        path[at] = label[: active[t]]
        if t:
            label[: active[t]] = back[at, label[: active[t]]]
    return path


def learn(rows: DataFrame) -> Model:
    """The model of all ``rows`` (text, lang) with neither of them null.

    Every text counts whole. The counts, languages times buckets at most, go to the driver.
    """

    def counted(batches):
        found: dict[str, np.ndarray] = {}
        for batch in batches:
            for part in by_bytes([batch], "text", PART_BYTES):
                langs = np.array(part.column("lang").to_pylist(), object)
                texts = np.array(part.column("text").to_pylist(), object)
                for lang in dict.fromkeys(langs):
                    words = read_words(texts[langs == lang].tolist())
                    counts = found.setdefault(lang, np.zeros(BUCKETS + len(NAMES), np.int64))
                    counts[:BUCKETS] += np.bincount(words.gram, minlength=BUCKETS)
                    counts[BUCKETS:] += np.bincount(words.script, words.letters, len(NAMES)).astype(np.int64)
        for lang, counts in found.items():
            at = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(counts[at])], names=["lang", "bucket", "n"]
            )

    parts = rows.filter("text IS NOT NULL AND lang IS NOT NULL").select("text", "lang").mapInArrow(counted, "lang string, bucket int, n long")
    counts = parts.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    if counts.select("lang").distinct().count() > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    got = counts.toPandas()
    languages = sorted(got["lang"].unique())
    table = np.zeros((len(languages), BUCKETS + len(NAMES)))
    table[np.searchsorted(languages, got["lang"]) if len(got) else [], got["bucket"].to_numpy(int)] = got["n"]
    grams, scripts = table[:, :BUCKETS] + SMOOTHING, table[:, BUCKETS:]
    share = scripts / np.maximum(scripts.sum(axis=1, keepdims=True), 1)
    return Model(languages, np.log(grams / grams.sum(axis=1, keepdims=True)).astype(np.float64), (share >= SCRIPT_SHARE).T.copy())


def _scored(model: Model, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text, letters, letters in a script of some learned language, and scores of every word, worked out for a few texts at a time."""
    owner, letters, known, scores = [np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty((0, len(model.languages)), np.float32)]
    start = size = 0
    for stop, text in enumerate(texts, 1):
        size += len(text or "")
        if size >= PART_BYTES or stop == len(texts):
            words = read_words(texts[start:stop])
            owner.append(words.text + start)
            letters.append(words.letters)
            known.append(words.letters * model.allowed[words.script].any(axis=1))
            scores.append(model.scores(words))
            start, size = stop, 0
    return np.concatenate(owner), np.concatenate(letters), np.concatenate(known), np.concatenate(scores)


def _labelled(model: Model, texts: list[str | None]) -> tuple[list, list, list]:
    """Predicted language, its share of the letters, and spans of each text."""
    return _judged(model, texts)[:3]


def _judged(model: Model, texts: list[str | None]) -> tuple[list, list, list, list]:
    """As :func:`_labelled`, and the share of letters in learned scripts of each text."""
    n = len(texts)
    owner, letters, known, scores = _scored(model, texts)
    if not model.languages or not len(owner):
        return [UNKNOWN] * n, [0.0] * n, [[] for _ in range(n)], [0.0] * n
    path = viterbi(scores, owner, n)
    cells = np.bincount(owner * len(model.languages) + path, letters, n * len(model.languages)).reshape(n, -1)
    best, total = cells.argmax(axis=1), cells.sum(axis=1)
    spans = [[] for _ in range(n)]
    change = np.flatnonzero(np.diff(path, prepend=-1) | np.diff(owner, prepend=-1))
    starts = np.searchsorted(owner, np.arange(n))
    for a, b in zip(change.tolist(), [*change[1:].tolist(), len(path)]):
        text = int(owner[a])
        spans[text].append({"first_word": a - int(starts[text]), "n_words": b - a, "lang": model.languages[path[a]]})
    langs = [model.languages[k] if t else UNKNOWN for k, t in zip(best, total)]
    shares = np.bincount(owner, known, n) / np.maximum(total, 1)
    return langs, (cells.max(axis=1) / np.maximum(total, 1)).tolist(), spans, shares.tolist()


SPANS = "array<struct<first_word:int,n_words:int,lang:string>>"


def label(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with lang_pred, score, spans and known.

    lang_pred has most letters on the best path (ties: the first by name); score is its
    share of them. A null text, or one without a letter, or any text if nothing was learned, gets ``und`` with score 0 and no spans.
    Spans count words from 0. ``known`` is the share of letters in words of a script that some learned language is written in. A column of ``docs`` with a result's name gives way to it.
    """
    docs = docs.drop("lang_pred", "score", "spans", "known")
    arrow = pa.list_(pa.struct([("first_word", pa.int32()), ("n_words", pa.int32()), ("lang", pa.string())]))

    def run(batches):
        for batch in by_bytes(batches, "text", 4 * PART_BYTES):
            langs, scores, spans, known = _judged(model, batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(spans, arrow), pa.array(known, pa.float64())],
                names=[*batch.schema.names, "lang_pred", "score", "spans", "known"],
            )

    own = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(run, f"{own}, lang_pred string, score double, spans {SPANS}, known double")


def identify(docs: DataFrame, modulus: int = 3, left: int = 1) -> DataFrame:
    """doc_id, held_out, text, lang_pred, score, spans, known of every row of ``docs`` (doc_id, text, lang).

    Learned from the rows outside the held-out fold whose lang is not null; one with a null doc_id is
    in no fold and is learned from. Repeated rows count each.
    """
    rows = docs.select("doc_id", "text", "lang", held_out(F.col("doc_id"), modulus, left).alias("held_out"))
    return label(rows.select("doc_id", "text", "held_out"), learn(rows.filter("NOT held_out")))
