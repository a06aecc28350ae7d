"""Toxicity by weak supervision.

Voters are mined lexicon terms (whole words and word beginnings) and fixed patterns. A
generative model of their votes, fitted without labels by expectation maximisation,
estimates how often each votes on either class and how strongly voters are correlated; a linear
classifier is then trained on the posterior labels. Terms are counted over all labelled documents
and votes over all documents, labelled or not; only the classifier is fitted on a bounded sample.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotmill.llm.common import by_bytes, held_out, letters, materialize

# The classifier is fitted on at most so many labelled documents, those with the least hashes.
FIT_ROWS = 20_000
# Rows of the sample that the fit multiplies out at a time.
SLICE = 2_000
# A term becomes a voter if its share of toxic documents is above the mean by this divergence, in
# nats over its documents (about the log of the odds against chance); the strongest so many stay, which
# bounds the model: the joint votes of two voters are a table of MOST_TERMS squared on the driver.
MIN_NATS, MOST_TERMS = 12.0, 1000
# A mined voter is toxic in so many of its documents at least.
MIN_SHARE = 0.7
# A voter with fewer votes is not judged by the labels.
RARE = 5
# The weight of a lexicon word where nothing is known of it.
LEXICON_WEIGHT = 4.0
STEM = 6
# Labels of up to so many documents, counted first, are sent to every executor; more are joined by a shuffle.
BROADCAST_LABELS = 500_000
# Rounds of expectation maximisation, and the change of posterior mass, as a share of it, that ends them.
ROUNDS, SETTLED = 15, 1e-4

# Abusive English words that vote without any label.
LEXICON = "idiot moron stupid dumb trash garbage scum loser clown pathetic worthless disgusting vermin".split()
# Patterns that vote.
PATTERNS = {
    "insult to a reader": r"\byou(?:'re| are)?\s+(?:a |an |such a )?(?:" + "|".join(LEXICON) + r")\b",
    "lexicon in capitals": r"\b(?:" + "|".join(w.upper() for w in LEXICON) + r")\b",
    "masked word": r"\b[a-z]{1,3}\*{2,}[a-z]*\b",
    "many exclamation marks": r"!{3,}",
    "wish of harm": r"\b(?:kill|hurt|shut up|go away|hate you)\b",
}


def terms(words: Iterable[str]) -> set[str]:
    """Terms of words: each whole word, and its beginning if it is longer."""
    found = set()
    for w in words:
        found.add("=" + w)
        if len(w) > STEM:
            found.add("^" + w[:STEM])
    return found


@dataclass
class Scorer:
    """Voters with their classifier weights."""

    names: list[str]
    weights: np.ndarray
    bias: float

    def __post_init__(self):
        self.word = {n[1:]: i for i, n in enumerate(self.names) if n[0] == "="}
        self.stem = {n[1:]: i for i, n in enumerate(self.names) if n[0] == "^"}
        self.pattern = [(i, re.compile(PATTERNS[n[1:]])) for i, n in enumerate(self.names) if n[0] == "~"]

    def votes(self, text: str | None) -> dict[int, int]:
        """Voters that fire, with how often."""
        if not text:
            return {}
        word, stem = self.word, self.stem
        found: dict[int, int] = {}
        for w, n in Counter(letters(text)).items():
            k = word.get(w)
            if k is not None:
                found[k] = found.get(k, 0) + n
            if len(w) > STEM:
                k = stem.get(w[:STEM])
                if k is not None:
                    found[k] = found.get(k, 0) + n
        for k, pattern in self.pattern:
            n = sum(1 for _ in pattern.finditer(text))
            if n:
                found[k] = n
        return found

    def score(self, text: str | None) -> float:
        logit = self.bias + sum(self.weights[k] * feature(n) for k, n in self.votes(text).items())
        return float(1 / (1 + np.exp(-np.clip(logit, -30, 30))))


def feature(n: int | np.ndarray) -> float | np.ndarray:
    """A voter's value for the classifier, by how often it fires."""
    return np.minimum(n, 3) / 3 + (n > 0) * 2 / 3


# ---- mining

def distinct_words(docs: DataFrame) -> DataFrame:
    """(doc_id, words) of ``docs`` (doc_id, text): the different words of a text with blanks between, so a shuffle carries each once."""

    def run(batches):
        for batch in by_bytes(batches, "text"):
            words = [" ".join(dict.fromkeys(letters(text or ""))) for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(words, pa.string())], names=["doc_id", "words"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, words string")


def labelled_words(docs: DataFrame, known: DataFrame, sent: bool) -> DataFrame:
    """(text, toxic) of the labelled rows of ``docs``, or (words, toxic) where texts would be shuffled.

    ``sent``: ``known`` is marked to go to every executor. Texts then meet them where they are read, and terms are counted in the same
    Python step; a second one would have two workers for each running task, which stay for the rest of the session.
    """
    if sent:
        return docs.select("doc_id", "text").join(known, "doc_id").select("text", "toxic")
    return distinct_words(docs).join(known, "doc_id").select("words", "toxic")


def term_counts(labelled: DataFrame) -> DataFrame:
    """(term, n, pos): in how many rows of ``labelled`` (text or words, toxic) a term stands, and in how many toxic ones."""
    column = "words" if "words" in labelled.columns else "text"
    split = letters if column == "text" else (lambda words: words.split(" "))

    def counted(batches):
        for batch in by_bytes(batches, column):
            every, toxic = Counter(), Counter()
            for text, y in zip(batch.column(column).to_pylist(), batch.column("toxic").to_pylist()):
                own = terms(dict.fromkeys(split(text))) if text else set()
                every.update(own)
                if y:
                    toxic.update(own)
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(every), pa.string()), pa.array(list(every.values()), pa.int64()), pa.array([toxic[t] for t in every], pa.int64())],
                names=["term", "n", "pos"],
            )

    parts = labelled.select(column, "toxic").mapInArrow(counted, "term string, n long, pos long")
    return parts.groupBy("term").agg(F.sum("n").alias("n"), F.sum("pos").alias("pos"))


def mined_terms(labelled: DataFrame, n_docs: int, n_toxic: int) -> list[str]:
    """Terms that stand in toxic documents of ``labelled`` (text or words, toxic) far more often than by chance."""
    p = n_toxic / n_docs
    share, clean = F.col("pos") / F.col("n"), F.col("n") - F.col("pos")
    nats = F.col("pos") * F.log(share / p) + F.when(clean > 0, clean * F.log(clean / F.col("n") / (1 - p))).otherwise(0.0)
    strong = term_counts(labelled).filter(share >= max(p, MIN_SHARE)).withColumn("nats", nats).filter(F.col("nats") >= MIN_NATS)
    return [r["term"] for r in strong.orderBy(F.col("nats").desc(), "term").limit(MOST_TERMS).select("term").collect()]


# ---- the label model

@dataclass
class LabelModel:
    """Prior of class 1, each voter's rate of voting on either class, and its discounts for correlation.

    A voter that does not fire abstains. That no voter fires is a vote of its own.
    """

    prior: float
    on_toxic: np.ndarray
    on_clean: np.ndarray
    discount_toxic: np.ndarray
    discount_clean: np.ndarray
    silence: tuple[float, float]

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        speaks = np.maximum(self.discount_toxic * np.log(self.on_toxic) - self.discount_clean * np.log(self.on_clean), 0)
        a, b = self.silence
        silent = np.where(votes.any(axis=1), 0.0, np.log(a / b))
        logit = np.log(self.prior / (1 - self.prior)) + silent + votes @ speaks
        return 1 / (1 + np.exp(-np.clip(logit, -30, 30)))

    @property
    def accuracy(self) -> np.ndarray:
        """Share of each voter's votes that the model takes for right."""
        right = self.prior * self.on_toxic
        return right / (right + (1 - self.prior) * self.on_clean)


@dataclass
class VoteStatistics:
    """Sums over documents, each by its weight: ``q`` is a document's posterior, a document is taken for toxic from 0.5 on."""

    docs: float
    mass: float
    silent_docs: float
    silent_mass: float
    taken: float
    fired: np.ndarray
    fired_mass: np.ndarray
    fired_taken: np.ndarray
    joint_taken: np.ndarray
    joint_clean: np.ndarray

    @staticmethod
    def none(voters: int) -> VoteStatistics:
        row, square = np.zeros(voters), np.zeros((voters, voters))
        return VoteStatistics(0.0, 0.0, 0.0, 0.0, 0.0, row, row.copy(), row.copy(), square, square.copy())

    def add(self, votes: np.ndarray, q: np.ndarray, weight: np.ndarray) -> None:
        """Count documents of ``votes`` (documents by voters, 0 or 1) in."""
        toxic, silent = q >= 0.5, ~votes.any(axis=1)
        self.docs += float(weight.sum())
        self.mass += float(weight @ q)
        self.silent_docs += float(weight[silent].sum())
        self.silent_mass += float(weight[silent] @ q[silent])
        self.taken += float(weight[toxic].sum())
        self.fired += weight @ votes
        self.fired_mass += (weight * q) @ votes
        self.fired_taken += weight[toxic] @ votes[toxic]
        self.joint_taken += (votes[toxic] * weight[toxic, None]).T @ votes[toxic]
        self.joint_clean += (votes[~toxic] * weight[~toxic, None]).T @ votes[~toxic]


def first_guess(votes: np.ndarray) -> np.ndarray:
    """Posteriors to begin with, by the count of votes."""
    fired = votes.sum(axis=1)
    return np.where(fired >= 2, 0.95, np.where(fired == 1, 0.3, 0.02))


def label_model(s: VoteStatistics, prior: float) -> LabelModel:
    """The model that makes the statistics likeliest.

    Voters that agree more than a class explains share their weight in it: a voter counts
    one part in one plus its summed correlation with the others inside that class.
    """
    rest = s.docs - s.mass
    a = np.clip((s.fired_mass + prior) / (s.mass + 1), 1e-6, 1 - 1e-6)
    b = np.clip((s.fired - s.fired_mass + 0.1) / (rest + 1), 1e-6, 1 - 1e-6)
    silence = ((s.silent_mass + 0.5) / (s.mass + 1), (s.silent_docs - s.silent_mass + 0.5) / (rest + 1))
    on_toxic = _correlation(s.joint_taken, s.fired_taken, s.taken)
    on_clean = _correlation(s.joint_clean, s.fired - s.fired_taken, s.docs - s.taken)
    return LabelModel(float(np.clip(s.mass / max(s.docs, 1), 1e-3, 0.5)), a, b, 1 / (1 + on_toxic), 1 / (1 + on_clean), silence)


def fit_label_model(statistics: Callable[[Callable[[np.ndarray], np.ndarray]], VoteStatistics], prior: float, rounds: int = ROUNDS) -> LabelModel:
    """Expectation maximisation; ``statistics`` sums votes over all documents for posteriors by a given function."""
    prior = min(max(prior, 1e-3), 0.5)
    posterior, mass = first_guess, -1.0
    for _ in range(rounds):
        sums = statistics(posterior)
        model = label_model(sums, prior)
        if abs(sums.mass - mass) <= SETTLED * sums.mass:
            break
        posterior, mass = model.posterior, sums.mass
    return model


def _correlation(joint: np.ndarray, fired: np.ndarray, docs: float) -> np.ndarray:
    """Summed positive correlation of each voter with the others over the ``docs`` documents taken for one class."""
    n = max(docs, 1)
    both, rate = joint / n, fired / n
    # Three documents' weight of independence, so that a few joint votes of rare voters show nothing.
    spread = np.sqrt(rate * (1 - rate)) + np.sqrt(3 / n)
    r = (both - np.outer(rate, rate)) / np.outer(spread, spread)
    np.fill_diagonal(r, 0)
    return np.where(r > 0.2, r, 0).clip(0, 1).sum(axis=1)


def sum_votes(sets: DataFrame, place: np.ndarray, posterior: Callable[[np.ndarray], np.ndarray]) -> VoteStatistics:
    """Statistics of all rows of ``sets`` (k: voters that fire, docs: documents with just these), one Spark job.

    ``place`` is each voter's place in the model, -1 without one. Tasks add their rows up and send sums of
    voters and of pairs that occur; these are added by key, so the driver gets each pair once.
    """
    voters = int((place >= 0).sum())
    one, pair, total = range(3)

    def summed(batches):
        s = VoteStatistics.none(voters)
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE):
                part = batch.slice(start, SLICE)
                lists = part.column("k")
                rows = np.repeat(np.arange(part.num_rows), np.diff(lists.offsets.to_numpy()))
                at = place[lists.flatten().to_numpy(zero_copy_only=False)]
                votes = np.zeros((part.num_rows, voters))
                votes[rows[at >= 0], at[at >= 0]] = 1
                s.add(votes, posterior(votes), part.column("docs").to_numpy().astype(float))
        out = [(total, 0, 0, s.docs, s.mass, s.taken), (total, 1, 0, s.silent_docs, s.silent_mass, 0.0)]
        out += [(one, i, 0, s.fired[i], s.fired_mass[i], s.fired_taken[i]) for i in np.flatnonzero(s.fired)]
        out += [(pair, i, j, s.joint_taken[i, j], s.joint_clean[i, j], 0.0) for i, j in zip(*np.nonzero(np.triu(s.joint_taken + s.joint_clean)))]
        kinds = (pa.int32(), pa.int32(), pa.int32(), pa.float64(), pa.float64(), pa.float64())
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), kinds)], names=["what", "i", "j", "a", "b", "c"])

    parts = sets.select("k", "docs").mapInArrow(summed, "what int, i int, j int, a double, b double, c double")
    got = parts.groupBy("what", "i", "j").agg(F.sum("a").alias("a"), F.sum("b").alias("b"), F.sum("c").alias("c")).toPandas()
    s = VoteStatistics.none(voters)
    for i, a, b, c in got.loc[got["what"] == total, ["i", "a", "b", "c"]].itertuples(index=False):
        if i == 0:
            s.docs, s.mass, s.taken = a, b, c
        else:
            s.silent_docs, s.silent_mass = a, b
    own, both = got[got["what"] == one], got[got["what"] == pair]
    s.fired[own["i"]], s.fired_mass[own["i"]], s.fired_taken[own["i"]] = own["a"], own["b"], own["c"]
    for joint, sums in ((s.joint_taken, both["a"]), (s.joint_clean, both["b"])):
        joint[both["i"], both["j"]] = sums
        joint[both["j"], both["i"]] = sums
    return s


def fit_linear(x: np.ndarray, q: np.ndarray, ridge: float = 1.0, rounds: int = 25) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels by damped Newton steps; the bias is not shrunk."""
    x = np.column_stack([x, np.ones(len(x))]).astype(np.float64, copy=False)
    shrink = np.full(x.shape[1], ridge)
    shrink[-1] = 1e-6
    w = np.zeros(x.shape[1])
    w[-1] = np.log((q.sum() + 0.5) / ((1 - q).sum() + 0.5))

    def loss(w):
        z = x @ w
        return float((np.logaddexp(0, z) - q * z).sum() + (shrink * w * w).sum() / 2)

    now = loss(w)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - q) + shrink * w
        spread = p * (1 - p)
        # In slices, so that no second matrix of the sample's size stands beside it.
        bend = sum((x[a : a + SLICE] * spread[a : a + SLICE, None]).T @ x[a : a + SLICE] for a in range(0, len(x), SLICE)) + np.diag(shrink)
        step = np.linalg.solve(bend, slope)
        size = 1.0
        while (then := loss(w - size * step)) > now and size > 1e-3:
            size /= 2
        if now - then < 1e-6 * (1 + abs(now)):
            break
        w, now = w - size * step, then
    return w[:-1], float(w[-1])


# ---- the operator

def known_labels(labels: DataFrame) -> DataFrame:
    """(doc_id, toxic), one row an id: labels that differ count as toxic; null ids and labels take no part."""
    return (
        labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL")
        .groupBy("doc_id")
        .agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    )


def fit_sample(docs: DataFrame, known: DataFrame, most: int = FIT_ROWS) -> DataFrame:
    """(text, toxic) of at most ``most`` labelled documents of ``docs``, those whose ids have the least hashes.

    Of the texts of one doc_id the least is taken; null texts take no part.
    """
    texts = docs.select("doc_id", "text").filter("text IS NOT NULL")
    present = known.join(texts.select("doc_id"), "doc_id", "left_semi")
    # Bounded by `most` ids, so they go to every executor.
    chosen = present.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    joined = texts.join(F.broadcast(chosen), "doc_id")
    return joined.groupBy("doc_id").agg(F.min("text").alias("text"), F.any_value("toxic").alias("toxic")).select("text", "toxic")


def vote_lists(docs: DataFrame, scorer: Scorer, *carried: str) -> DataFrame:
    """``carried`` columns of ``docs`` (doc_id, text, ...) with k, the voters that fire in order, and n, how often."""

    def voted(batches):
        for batch in by_bytes(batches, "text"):
            out = [sorted(scorer.votes(text).items()) for text in batch.column("text").to_pylist()]
            k, n = [[v for v, _ in own] for own in out], [[m for _, m in own] for own in out]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in carried), pa.array(k, pa.list_(pa.int32())), pa.array(n, pa.list_(pa.int32()))], names=[*carried, "k", "n"]
            )

    own = "".join(f"{c} {docs.schema[c].dataType.simpleString()}, " for c in carried)
    return docs.select(*carried, "text").mapInArrow(voted, f"{own}k array<int>, n array<int>")


def fit(docs: DataFrame, labels: DataFrame, most: int = FIT_ROWS) -> Scorer:
    """Voters, label model and classifier, from ``docs`` (doc_id, text) and ``labels`` (doc_id, toxic).

    Terms are counted over all rows with a label and votes over all rows; repeated rows count each. Votes are written
    without texts, as distinct sets with counts, which every round of the label model adds up again. The driver holds
    sums of voters and pairs of voters, and the votes of the classifier's sample, at most FIT_ROWS by MOST_TERMS.
    """
    known, texts = materialize(known_labels(labels), "toxicity-labels"), docs.filter("text IS NOT NULL")
    sent = known.count() <= BROADCAST_LABELS
    if sent:
        known = F.broadcast(known)
    n, toxic = texts.select("doc_id").join(known, "doc_id").agg(F.count("*"), F.sum("toxic")).first()
    if not toxic or toxic == n:  # nothing to set the scores to
        return Scorer(["=" + w for w in LEXICON], np.full(len(LEXICON), LEXICON_WEIGHT), -3.0)
    prior = (toxic + 0.5) / (n + 5)
    mined = mined_terms(labelled_words(texts, known, sent), n, toxic)
    names = [*dict.fromkeys(["=" + w for w in LEXICON] + mined), *("~" + p for p in PATTERNS)]
    scorer = Scorer(names, np.zeros(len(names)), 0.0)
    votes = materialize(vote_lists(texts, scorer, "doc_id").select("doc_id", "k"), "toxicity-votes")
    # Voters that the labels contradict are left out; rare ones are left to the label model.
    judged = votes.join(known, "doc_id").select(F.explode("k").alias("k"), "toxic").groupBy("k").agg(F.count("*").alias("n"), F.sum("toxic").alias("right"))
    fired, right = np.zeros(len(names)), np.zeros(len(names))
    for r in judged.collect():
        fired[r["k"]], right[r["k"]] = r["n"], r["right"]
    used = np.flatnonzero((right >= MIN_SHARE * fired) | (fired < RARE))
    place = np.full(len(names), -1)
    place[used] = np.arange(len(used))
    sets = materialize(votes.groupBy("k").agg(F.count("*").alias("docs")), "toxicity-sets")
    model = fit_label_model(lambda posterior: sum_votes(sets, place, posterior), prior)
    # The rest says nothing about the class.
    kept = model.accuracy > model.prior

    sample = materialize(fit_sample(docs, known, most), "toxicity-sample")
    got = vote_lists(sample, scorer, "toxic").toPandas()
    column = np.full(len(names), -1)
    column[used[kept]] = np.arange(int(kept.sum()))
    x, y, q = np.zeros((len(got), int(kept.sum())), np.float32), got["toxic"].to_numpy(float), np.zeros(len(got))
    for start in range(0, len(got), SLICE):
        fires = np.zeros((min(SLICE, len(got) - start), len(used)))
        for i, (k, c) in enumerate(zip(got["k"][start : start + SLICE], got["n"][start : start + SLICE])):
            k, c = np.asarray(k, int), np.asarray(c, int)
            fires[i, place[k[place[k] >= 0]]] = 1
            own = column[k] >= 0
            x[start + i, column[k[own]]] = feature(c[own])
        q[start : start + SLICE] = model.posterior(fires)
    weights = np.zeros(len(names))
    w, bias = fit_linear(x, q)
    if 0 < y.sum() < len(y):
        # The posterior's scale is the label model's own; a line through the logits sets it to the labels.
        (slope,), shift = fit_linear((x @ w + bias)[:, None], y, ridge=0.1)
        w, bias = w * slope, float(bias * slope + shift)
    weights[used[kept]] = w
    # Words of the fixed lexicon that no document of the sample holds keep a fixed weight.
    seen = {int(v) for own in got["k"] for v in own}
    unseen = [k for k, name in enumerate(names) if name[1:] in LEXICON and name[0] == "=" and k not in seen]
    weights[unseen] = LEXICON_WEIGHT
    live = np.flatnonzero(weights)
    return Scorer([names[k] for k in live], weights[live], bias)


def score_texts(docs: DataFrame, scorer: Scorer) -> DataFrame:
    """``docs`` with score (0 to 1) and predicted (1 from 0.5 on). A null or empty text scores as one without any vote.

    A column of ``docs`` with a result's name gives way to it.
    """
    docs = docs.drop("score", "predicted")

    def run(batches):
        for batch in by_bytes(batches, "text"):
            scores = [scorer.score(text) for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(scores, pa.float64()), pa.array([int(s >= 0.5) for s in scores], pa.int32())],
                names=[*batch.schema.names, "score", "predicted"],
            )

    own = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(run, f"{own}, score double, predicted int")


def toxicity(docs: DataFrame, labels: DataFrame, modulus: int = 5, left: int = 0) -> DataFrame:
    """doc_id, held_out, text, score, predicted of every row of ``docs``.

    Only labelled documents outside the held-out fold are learned from. Repeated rows are scored
    each; without labels, or with labels of one class only, the fixed lexicon votes alone.
    """
    rows = docs.select("doc_id", "text", held_out(F.col("doc_id"), modulus, left).alias("held_out"))
    scorer = fit(rows.filter("NOT held_out"), labels.filter(~held_out(F.col("doc_id"), modulus, left)))
    return score_texts(rows, scorer)
