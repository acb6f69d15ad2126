"""Toxicity by weak supervision.

Many weak voters look at a document: beginnings of words from a seed lexicon
and of words that the labelled rows set apart, and patterns.  A generative
label model estimates each voter's rates by expectation maximisation and the
correlations that remain between voters given the label, and shares the weight
of correlated voters among them.  Its posterior labels train the linear
classifier that scores whole texts.  The label given for a training row is one
more voter, so that wrong ones are outvoted.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held_out, table
from .training import labelled_sample
from .words import join_texts, slices, word_hashes

SAMPLE = 8_000
VOTERS = 240
CUT = 0.5
PREFIXES = (4, 5, 6, 7, 8)

#: Beginnings of insults in English, German, French and Spanish.
SEEDS = """idiot moron stupid pathetic loser worthless scum trash disgusting clown imbecile bastard asshole bitch whore
dumbass retard faggot vermin subhuman arschloch schlampe wichser dummkopf missgeburt abschaum salope connard encul
pétasse ordure abruti imbécile estúpid gilipollas cabrón idiota imbécil basura escoria""".split()

_PATTERNS = (
    re.compile(rb"\b(?:you|u|ur) (?:are|r) (?:a |an |such )?(?:\w+ )?(?:%s)" % "|".join(SEEDS[:10]).encode()),
    re.compile(rb"\b\w+[*@#$]{2,}\w+\b"),
    re.compile(rb"\b(?:kill|hate|hurt) (?:you|them|yourself)\b"),
    re.compile(rb"\b(?:shut up|get lost|go to hell)\b"),
)


def _prefix_hashes(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each prefix length: hashes of the words' beginnings, and the text of each."""
    buf, begin = join_texts([t.lower() for t in texts])
    for n in PREFIXES:
        hashes, starts, ends = word_hashes(buf, n)
        enough = ends - starts >= n
        yield hashes[enough], (np.searchsorted(begin, starts[enough], side="right") - 1)


def seed_hashes() -> np.ndarray:
    out = [word_hashes(w.encode()[:n], n)[0][0] for w in SEEDS for n in PREFIXES if len(w.encode()) == n or n == PREFIXES[-1] < len(w.encode())]
    return np.unique(np.array(out, np.uint64))


def votes(texts: list[bytes], lexicon: np.ndarray) -> np.ndarray:
    """One row of 0/1 votes for each text.  ``lexicon``: sorted hashes of word
    beginnings, a voter each; then the patterns, shouting, and many hits."""
    out = np.zeros((len(texts), len(lexicon) + len(_PATTERNS) + 2))
    for hashes, doc in _prefix_hashes(texts):
        at = np.minimum(np.searchsorted(lexicon, hashes), max(len(lexicon) - 1, 0))
        hit = lexicon[at] == hashes if len(lexicon) else np.zeros(len(hashes), bool)
        out[doc[hit], at[hit]] = 1
    for i, text in enumerate(texts):
        low = text.lower()
        for j, p in enumerate(_PATTERNS):
            out[i, len(lexicon) + j] = p.search(low) is not None
        upper = sum(map(text.count, (b"A", b"E", b"I", b"O", b"N", b"T")))
        out[i, -2] = upper > 0.15 * len(text)
    out[:, -1] = out[:, : len(lexicon)].sum(axis=1) >= 3
    return out


def label_model(votes: np.ndarray, given: np.ndarray, rounds: int = 15) -> tuple[np.ndarray, dict]:
    """Posterior of label 1 for each row, and the estimates.

    ``votes``: rows by voters, 0 or 1; ``given``: the given labels, the voter
    that starts the estimation.  Each voter has a rate of voting 1 given each
    label; it abstains otherwise, and that no voter speaks is a vote of its own.  Voters that agree beyond what the label explains are one opinion:
    in each row a voter's log-odds are divided by one plus the sum of its
    positive correlations (given the label) with the others that speak.
    """
    silent = (votes.sum(axis=1) == 0).astype(float)
    v = np.column_stack((votes, silent, given))
    q = 0.02 + 0.96 * given
    for _ in range(rounds):
        prior = np.clip(q.mean(), 1e-3, 1 - 1e-3)
        rate = [(v.T @ w + 0.5 * v.mean(axis=0) + 1e-3) / (w.sum() + 1) for w in (q, 1 - q)]
        rate = [np.clip(r, 1e-4, 1 - 1e-4) for r in rate]
        rest = v - np.outer(q, rate[0]) - np.outer(1 - q, rate[1])
        cov = rest.T @ rest / len(v)
        sd = np.sqrt(np.maximum(np.diag(cov), 1e-9))
        corr = cov / np.outer(sd, sd)
        np.fill_diagonal(corr, 0)
        share = 1 / (1 + v @ np.where(corr > 0.1, corr, 0))
        yes = np.log(rate[0]) - np.log(rate[1])
        no = np.log1p(-rate[0]) - np.log1p(-rate[1])
        no[:-1] = 0  # a voter that finds nothing abstains; only the given label says no
        odds = np.log(prior / (1 - prior)) + (v * yes * share).sum(axis=1) + (1 - v) @ no
        new = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
        if np.abs(new - q).max() < 1e-6:
            break
        q = new
    return q, {"prior": prior, "rates": rate, "correlations": corr}


@dataclass
class Linear:
    lexicon: np.ndarray
    weight: np.ndarray
    bias: float

    def score(self, texts: list[bytes]) -> np.ndarray:
        odds = votes(texts, self.lexicon) @ self.weight + self.bias
        return 1 / (1 + np.exp(-np.clip(odds, -30, 30)))


def fit_linear(x: np.ndarray, target: np.ndarray, l2: float = 0.3, rounds: int = 30) -> tuple[np.ndarray, float]:
    """Logistic regression on posterior labels, by Newton's method."""
    z = np.column_stack((x, np.ones(len(x))))
    w = np.zeros(z.shape[1])
    ridge = np.diag([l2] * x.shape[1] + [1e-3])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + ridge, z.T @ (p - target) + ridge @ w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w[:-1], float(w[-1])


def _stems(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """label, text -> stem, ones, rows: distinct word beginnings, counted by slice"""
    for part, texts in slices(batches, 1):
        label = part.column(0).to_numpy(zero_copy_only=False)
        pairs = [np.unique(np.rec.fromarrays(x, names="h,d")) for x in _prefix_hashes(texts)]
        h, d = (np.concatenate([p[k] for p in pairs]) for k in ("h", "d"))
        stem, inverse = np.unique(h, return_inverse=True)
        ones = np.bincount(inverse, label[d], len(stem)).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(stem.view(np.int64)), pa.array(ones), pa.array(np.bincount(inverse, minlength=len(stem)).astype(np.int64))], names=["stem", "ones", "rows"])


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", sample: int = SAMPLE, voters: int = VOTERS) -> Linear:
    """Fits on at most ``sample`` labelled rows that aren't held out; the
    ``voters`` most telling word beginnings and the rows' votes reach the driver.
    Without rows of both labels only the seeds' votes count."""
    rows = labelled_sample(docs, labels, label, sample).select("label", "text")
    n, ones = rows.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0))).first()
    lexicon = seed_hashes()
    if not 0 < ones < n:
        return Linear(lexicon, np.concatenate((np.full(len(lexicon), 4.0), np.full(len(_PATTERNS), 2.0), [0.0, 1.0])), -3.0)
    counts = rows.mapInArrow(_stems, "stem long, ones long, rows long").groupBy("stem").agg(F.sum("ones").alias("ones"), F.sum("rows").alias("rows"))
    zeros = F.col("rows") - F.col("ones")
    part = lambda k, share: F.when(k > 0, k * F.log(k / (F.col("rows") * share))).otherwise(0.0)
    # log-likelihood ratio against the overall share: 25 is five standard deviations
    telling = counts.withColumn("g", 2 * (part(F.col("ones"), ones / n) + part(zeros, 1 - ones / n)))
    telling = telling.where((F.col("g") >= 25) & (F.col("ones") >= 4 * F.col("rows") * (ones / n)))
    found = [r.stem for r in telling.orderBy(F.desc("g"), "stem").limit(voters).collect()]
    lexicon = np.unique(np.concatenate((lexicon, np.array(found, np.int64).view(np.uint64))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in slices(batches, 1):
            packed = np.packbits(votes(texts, lexicon).astype(np.uint8), axis=1)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array([x.tobytes() for x in packed], pa.binary())], names=["label", "v"])

    got = rows.mapInArrow(run, "label int, v binary").toArrow()
    got = got.sort_by([("label", "ascending"), ("v", "ascending")])
    width = len(lexicon) + len(_PATTERNS) + 2
    x = np.unpackbits(np.frombuffer(b"".join(got.column("v").to_pylist()), np.uint8).reshape(got.num_rows, -1), axis=1)[:, :width].astype(float)
    posterior, _ = label_model(x, np.array(got.column("label").to_pylist(), float))
    return Linear(lexicon, *fit_linear(x, posterior))


def score(docs: DataFrame, model: Linear, cut: float = CUT) -> DataFrame:
    """doc_id, held_out, score, predicted: one row per row, of the whole text.

    Null and empty texts get the score of a text without votes.  Rows are
    independent: repeated rows and ties score alike, null doc_ids stay null
    (held out).  Other columns are ignored; an empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in slices(batches, 1):
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(model.score(texts))], names=["doc_id", "score"])

    out = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, score double")
    return out.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= cut).cast("int").alias("predicted"))


def query(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return score(docs, train(docs, table(spark, sf_dir, "labels")))
