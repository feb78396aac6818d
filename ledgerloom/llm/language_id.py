"""Language identification by error-correcting output codes.

Each language has a codeword of +1 and -1 (exhaustive for up to 7 languages, else random rows of good distance). One
binary classifier per bit, logistic over hashed byte n-grams of one to three bytes, tells the bit of a text. Decoding
weighs the classifiers by their accuracy in training and takes the language of least exponential-free logistic loss
over all bits; the score is that language's share of the soft losses. A text is ambiguous if the losses of the nearest and
the second codeword, per weight of the bits in which the two codewords differ, differ by less than AMBIGUOUS of what is
the median of the documents that training took for the nearest language; so the bound means the same for any number of
languages, and labels with errors lower it.

Training reads at most SAMPLE documents per language and SAMPLE_ALL in all (beyond SAMPLE_ALL languages the first by
name are learnt), those of least hash of their id among the texts with a letter; rows that agree in id, language and
text count once. A document's features are counts in BUCKETS buckets, so what comes to the driver is bounded.
Prediction reads every text whole.

Features. Runs of characters other than letters count as one space, letters are in lower case. A text is its share of
each n-gram, scaled by inverse document frequency in training.

Defined cases. A null text, or one without a letter, is `und` with score 0 and is never trained on. Rows with a null
language or id are never trained on; held_out is false for a null id. With no language to learn all texts are `und`,
with one language all others get it with score 1. Repeated rows are rows of their own. An empty table gives no rows.
Other columns are kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import small_batches, tidy, unused

#: Documents that training reads at most: per language, and of all languages together. Buckets of n-grams.
SAMPLE, SAMPLE_ALL, BUCKETS = 250, 4_000, 1 << 14
#: Gradient steps of training.
STEPS = 120
UNKNOWN = "und"
#: A margin below this share of its language's median in training flags a text as ambiguous.
AMBIGUOUS = 0.16
#: Characters that a worker turns into features at once.
CHUNK = 1_000_000
_NOT_LETTERS = regex.compile(r"[^\p{L}]+")


def held_out(doc_id: str, of: int, remainder: int) -> Column:
    """Whether crc32 of the id as text leaves this remainder; false for a null id."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(of)) == remainder, F.lit(False))


def plain(text: str | None) -> bytes:
    """Letters in lower case, all else as single spaces; empty if there is no letter."""
    found = _NOT_LETTERS.sub(" ", text).strip().lower() if text else ""
    return f" {found} ".encode() if found else b""


def _ngrams(data: np.ndarray) -> np.ndarray:
    """Buckets of the n-grams that start at each byte but the last two: rows for one, two and three bytes."""
    b = data.astype(np.uint32)
    a, c, d = b[:-2], b[1:-1], b[2:]
    one = a * np.uint32(2654435761)
    two = (a * np.uint32(257) + c) * np.uint32(2246822519) + np.uint32(77)
    three = ((a * np.uint32(257) + c) * np.uint32(263) + d) * np.uint32(3266489917) + np.uint32(191)
    return np.stack([one, two, three]) >> np.uint32(32 - (BUCKETS - 1).bit_length())


def counts(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Buckets and counts of a text's n-grams."""
    if len(text) < 3:
        return np.zeros(0, dtype=np.int64), np.zeros(0)
    return (lambda n: (np.flatnonzero(n), n[n > 0]))(np.bincount(_ngrams(np.frombuffer(text, np.uint8)).ravel(), minlength=BUCKETS).astype(np.float64))


def codewords(n: int, seed: int = 3) -> np.ndarray:
    """A codeword of +1 and -1 per language: exhaustive for 3 to 7, else random with the best least distance."""
    if n <= 2:
        return np.array([[1], [-1]])[:n]
    if n <= 7:
        bits = np.arange(2 ** (n - 1) - 1)
        rows = [np.ones(len(bits), dtype=int)]
        for k in range(1, n):  # runs of -1 and +1 of halving length
            run = 2 ** (n - 1 - k)
            rows.append(np.where(bits // run % 2 == 0, -1, 1))
        return np.array(rows)
    rng = np.random.default_rng(seed)
    best, width = None, int(np.ceil(10 * np.log2(n)))
    for _ in range(200):
        code = np.where(rng.random((n, width)) < 0.5, -1, 1)
        apart = (width - code @ code.T) // 2 + width * np.eye(n, dtype=int)
        if (np.abs(code.sum(axis=0)) < n).all() and (best is None or apart.min() > best[0]):
            best = (apart.min(), code)
    return best[1]


class Codes:
    """A trained model: languages, codewords, weights of n-grams per bit, bias and weight of each bit."""

    def __init__(self, languages: list[str], features: np.ndarray, labels: np.ndarray):
        self.languages, self.code = languages, codewords(len(languages))
        if len(languages) < 2:
            return
        x = features  # one matrix of 32-bit numbers, changed in place
        x /= np.maximum(1, x.sum(axis=1, keepdims=True))
        self.idf = (np.log((1 + len(x)) / (1 + np.count_nonzero(x, axis=0))) + 0.1).astype(np.float32)
        np.sqrt(x, out=x)
        x *= self.idf
        self.scale = np.float32(1 / max(1e-12, np.sqrt(np.einsum("ij,ij->i", x, x)).mean()))
        x *= self.scale
        y = self.code[labels]
        of_language = np.bincount(labels, minlength=len(languages))
        weight = (1 / of_language[labels])[:, None] / len(languages)
        w, bias = np.zeros((x.shape[1], y.shape[1])), np.zeros(y.shape[1])
        fast_w, fast_b, before = w.copy(), bias.copy(), 1.0
        for _ in range(STEPS):  # gradient steps with momentum on the mean logistic loss
            margin = y * (x @ fast_w.astype(np.float32) + fast_b)
            pull = -y * weight / (1 + np.exp(np.clip(margin, -30, 30)))
            step_w = fast_w - 4.0 * (x.T @ pull.astype(np.float32) + 1e-4 * fast_w)
            step_b = fast_b - 4.0 * pull.sum(axis=0)
            after = (1 + np.sqrt(1 + 4 * before**2)) / 2
            fast_w, fast_b = step_w + (before - 1) / after * (step_w - w), step_b + (before - 1) / after * (step_b - bias)
            w, bias, before = step_w, step_b, after
        self.w, self.bias = (w * self.scale * self.idf[:, None]).astype(np.float32), bias
        right = ((y * (x @ w + bias) > 0) * weight).sum(axis=0)
        gain = np.maximum(1e-3, 2 * right - 1)
        self.bit_weight = gain / gain.sum()
        best, _, margin = self.decode(x @ w.astype(np.float32) + bias)
        self.typical = np.array([np.median(margin[best == k]) if (best == k).any() else np.median(margin) for k in range(len(languages))])

    def decode(self, outputs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Language, score and margin of rows of bit outputs, by loss-weighted decoding."""
        margin = self.code[None, :, :] * outputs[:, None, :]
        loss = (np.logaddexp(0, -margin) * self.bit_weight).sum(axis=2)
        share = np.exp(-3 * (loss - loss.min(axis=1, keepdims=True)))
        share /= share.sum(axis=1, keepdims=True)
        row = np.arange(len(loss))
        best, second = np.argsort(loss, axis=1, kind="stable")[:, :2].T
        apart = ((self.code[best] != self.code[second]) * self.bit_weight).sum(axis=1)
        return best, share[row, best], (loss[row, second] - loss[row, best]) / np.maximum(1e-12, apart)

    def outputs(self, texts: list[bytes]) -> np.ndarray:
        """Bit outputs of texts, all of which have letters."""
        out = np.zeros((len(texts), self.w.shape[1]))
        for k, text in enumerate(texts):
            n = np.bincount(_ngrams(np.frombuffer(text, np.uint8)).ravel(), minlength=BUCKETS)
            some = np.flatnonzero(n)
            out[k] = np.sqrt(n[some] / n.sum()).astype(np.float32) @ self.w[some] + self.bias
        return out

    def predict(self, texts: list[str | None]) -> pd.DataFrame:
        raw = [plain(t) for t in texts]
        known = np.array([len(r) > 0 for r in raw], dtype=bool)
        name, score, margin = np.full(len(raw), UNKNOWN, dtype=object), np.zeros(len(raw)), np.zeros(len(raw))
        if known.any() and self.languages:
            if len(self.languages) == 1:
                best, sure, apart = np.zeros(known.sum(), dtype=int), np.ones(known.sum()), np.full(known.sum(), np.inf)
            else:
                best, sure, apart = self.decode(self.outputs([r for r in raw if r]))
                apart = apart / self.typical[best]
            name[known], score[known], margin[known] = np.array(self.languages, dtype=object)[best], sure, apart
        return pd.DataFrame({"lang": name, "score": score, "ambiguous": margin < AMBIGUOUS})


def fit(df: DataFrame, learn: Column, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", sample: int = SAMPLE) -> Codes:
    """Train on rows that `learn` chooses. Rows are picked by narrow columns first, then their texts are read."""
    known = df.where(learn & F.col(lang).isNotNull() & F.col(doc_id).isNotNull() & F.col(text).rlike(r"\p{L}"))
    rows = known.select(F.col(doc_id).alias("doc_id"), F.col(lang).alias("lang"), F.xxhash64(text).alias("hash"))
    top = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id", "hash")
    picked = rows.withColumn("n", F.row_number().over(top)).where(F.col("n") <= sample)
    picked = {tuple(r) for r in picked.orderBy("n", "lang", "doc_id", "hash").limit(SAMPLE_ALL).select("doc_id", "lang", "hash").collect()}
    if not picked:
        return Codes([], np.zeros((0, BUCKETS)), np.zeros(0, dtype=int))

    def features(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tidy()
        for part in parts:
            found = [counts(plain(t)) for t in part["text"]]
            yield pd.DataFrame({"lang": part["lang"], "at": [a.astype("<u2").tobytes() for a, _ in found], "n": [n.astype("<f4").tobytes() for _, n in found]})

    ids = df.sparkSession.createDataFrame(sorted(picked), "doc_id long, lang string, hash long")
    texts = known.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(lang).alias("lang"), F.xxhash64(text).alias("hash"), F.col(text).alias("text"))
    # at most SAMPLE_ALL keys; rows that agree in all three are one training document
    chosen = texts.join(F.broadcast(ids), ["doc_id", "lang", "hash"], "left_semi").groupBy("doc_id", "lang", "hash").agg(F.min("text").alias("text"))
    found = chosen.select("lang", "text").mapInPandas(features, "lang string, at binary, n binary").where("length(at) > 0").collect()
    found = sorted(found, key=lambda r: (r["lang"], bytes(r["at"]), bytes(r["n"])))
    languages = sorted({r["lang"] for r in found})
    x = np.zeros((len(found), BUCKETS), dtype=np.float32)
    for k, r in enumerate(found):
        x[k, np.frombuffer(r["at"], "<u2")] = np.frombuffer(r["n"], "<f4")
    return Codes(languages, x, np.array([languages.index(r["lang"]) for r in found], dtype=int))


def identify(df: DataFrame, model: Codes, text: str = "text", out: str = "language") -> DataFrame:
    """df with the struct `out`: lang, score and ambiguous."""
    small_batches(df.sparkSession)

    @F.pandas_udf("lang string, score double, ambiguous boolean")
    def predict(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        tidy()
        for texts in parts:
            yield model.predict(texts.tolist())

    return df.withColumn(out, predict(F.col(text)))


def keep_identified(df: DataFrame, model: Codes) -> DataFrame:
    """The rows of df whose text has a language and a score above an even share, with df's own columns.

    Rows that are only ambiguous stay: where the same text is labelled with two languages the flag holds whole documents.
    """
    out = unused(df, "language")
    least = min(0.3, 1.1 / max(1, len(model.languages)))
    return identify(df, model, out=out).where((F.col(f"{out}.lang") != UNKNOWN) & (F.col(f"{out}.score") >= least)).select(*df.columns)
