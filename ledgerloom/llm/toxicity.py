"""Toxicity by the nearest labelled examples: exact TF-IDF cosine over block-max inverted indexes.

Examples. At most SAMPLE labelled documents of each label, those of least hash of their id, make the index.
Terms. Words in lower case, and stems: the first 5, 6 and 7 letters of longer words, where a text has two words or more
of the stem. All terms of the examples are the vocabulary. Weights. (1 + ln tf) * idf * relevance, with the document
frequencies of all documents of the table, not of the examples alone. A term's relevance is FLOOR plus its gain as a
share of the largest one, gain being the log-likelihood ratio of its presence in toxic and clean examples, so it doesn't
depend on how many labels there are. Rows are scaled to length one, so the cosine is an inner product.

Search. Examples are cut into blocks of BLOCK. The HEAD longest lists of postings are kept block by block with each
block's largest weight of the term, the others as plain lists. For a query the plain lists are summed; those sums and the
block maxima of the long lists bound every block. Blocks of the largest bounds are finished first, and those that can't
beat the k-th best cosine so far are left out. So the K nearest examples are exact; ties go to the smaller doc_id.
Queries go in batches, so that a block's long lists are one matrix product for all that need it.

Score. Votes of the neighbours are weighted by 1 / (distance + 0.05), distance being 1 - cosine; a share of the weight
is kept for the rate of toxic examples (the prior), so that weak evidence stays weak; an example counts for as many
labelled documents as its label has for each one taken. A logistic curve fitted to the examples' own leave-one-out votes
makes it a probability. Evidence is the neighbours' doc_id, cosine and label.

Defined cases. A text without a term of the vocabulary (null and empty ones too) has no neighbours and the prior's
score. Labels that are null, or whose doc_id is null or has no document, are not examples; where a doc_id is labelled
repeatedly the largest label holds. Without examples of both labels no term is learnt and all scores are the rate of
toxic examples, 0 without any. Repeated rows are rows of their own. An empty table gives no rows. Other columns are
kept.
"""

from __future__ import annotations

import re
from array import array
from collections import Counter
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import small_batches, tidy, unused

#: Examples of each label, neighbours, examples in a block of postings.
SAMPLE, K, BLOCK = 2_000, 15, 64
#: Relevance of a term that is as common in toxic as in clean examples; the most telling term has 1 more.
FLOOR = 0.01
#: Groups of terms whose document frequencies are summed apart.
SLOTS = 64
TOXIC_FROM = 0.7
#: Terms whose weights are matrices. Queries and postings that a worker holds at once; characters of texts.
HEAD, QUERIES, POSTINGS, CHUNK = 512, 128, 1_000_000, 1_000_000
#: Above the rounding of cosines summed in 32 bits.
SLACK = 1e-5
#: Words besides the vocabulary whose terms a worker keeps; a full store is emptied, which changes no result.
CACHE_WORDS = 300_000
_WORD = re.compile(r"[^\W\d_]+")
_NOT_LETTERS = {k: " " for k in range(128) if not chr(k).isalpha()}


def words(text: str | None) -> list[str]:
    """Runs of letters, in lower case."""
    if not text:
        return []
    return text.lower().translate(_NOT_LETTERS).split() if text.isascii() else _WORD.findall(text.lower())


def stems_of(word: str) -> list[str]:
    """The beginnings of a word, shortest first, marked by a star."""
    return [word[:n] + "*" for n in (5, 6, 7) if len(word) > n]


def terms(text: str | None) -> dict[str, int]:
    """How often each term is in the text; a stem counts from its second word on."""
    found = Counter(words(text))
    stems: Counter[str] = Counter()
    for word, n in found.items():
        for stem in stems_of(word):
            stems[stem] += n
    return found | {stem: n - 1 for stem, n in stems.items() if n > 1}


def _ranges(start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """The numbers from each start up to its stop, one range after another."""
    n = stop - start
    return np.repeat(start - (np.cumsum(n) - n), n) + np.arange(n.sum())


class BlockMaxIndex:
    """Examples as unit vectors, by term, in blocks of BLOCK examples.

    Terms of the HEAD longest lists are matrices, one per block, with the largest weight of each term in the block; the
    other terms are lists of postings.
    """

    def __init__(self, ids: np.ndarray, vectors: list[tuple[np.ndarray, np.ndarray]], n_terms: int):
        self.ids, self.blocks = ids, max(1, -(-len(ids) // BLOCK))
        term = np.concatenate([np.zeros(0, dtype=np.int64), *(at for at, _ in vectors)])
        weight = np.concatenate([np.zeros(0), *(w for _, w in vectors)])
        doc = np.repeat(np.arange(len(ids)), [len(at) for at, _ in vectors])
        longest = np.argsort(-np.bincount(term, minlength=n_terms), kind="stable")[:HEAD]
        self.column = np.full(n_terms, -1, dtype=np.int32)
        self.column[longest] = np.arange(len(longest))
        inside = self.column[term] >= 0
        head = np.zeros((self.blocks * BLOCK, len(longest)))
        head[doc[inside], self.column[term[inside]]] = weight[inside]
        self.head = head
        self.rough = head.astype(np.float32).reshape(self.blocks, BLOCK, -1)  # of 32 bits, to choose; cosines are summed in 64
        self.head_max = self.rough.max(axis=1, initial=0.0)
        term, doc, weight = term[~inside], doc[~inside], weight[~inside]
        order = np.argsort(term, kind="stable")  # postings by term, then by example
        self.docs, self.weights = doc[order].astype(np.int32), weight[order]
        self.starts = np.searchsorted(term[order], np.arange(n_terms + 1))

    def search(self, at: np.ndarray, weight: np.ndarray, k: int, without: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """Positions and cosines of the k nearest examples with a cosine above 0; `without` is left out."""
        _, doc, cosine = self.search_all(np.array([0, len(at)]), at, weight, k, np.array([without]))
        return doc, cosine

    def search_all(self, begins: np.ndarray, at: np.ndarray, weight: np.ndarray, k: int, without: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The same for many queries, each from one of `begins` to the next: numbers of queries, positions and cosines."""
        lists = np.where(self.column[at] < 0, self.starts[at + 1] - self.starts[at], 0)
        read = np.concatenate(([0], np.cumsum(lists)))[begins]
        parts, first = [], 0
        while first < len(begins) - 1:  # as many as keep the postings at hand few
            last = min(first + QUERIES, max(first + 1, int(np.searchsorted(read, read[first] + POSTINGS, side="right")) - 1))
            mine = slice(begins[first], begins[last])
            row, doc, cosine = self._search(begins[first : last + 1] - begins[first], at[mine], weight[mine], k, None if without is None else without[first:last])
            parts.append((row + first, doc, cosine))
            first = last
        none = np.zeros(0, dtype=np.int64)
        return tuple(np.concatenate(x) for x in zip(*parts, strict=True)) if parts else (none, none, np.zeros(0))

    def _search(self, begins: np.ndarray, at: np.ndarray, weight: np.ndarray, k: int, without: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        n, blocks = len(begins) - 1, self.blocks
        row = np.repeat(np.arange(n), np.diff(begins))
        column = self.column[at]
        often = column >= 0
        query = np.zeros((n, self.head_max.shape[1]))
        query[row[often], column[often]] = weight[often]
        at, row, weight = at[~often], row[~often], weight[~often]
        found, held = _ranges(self.starts[at], self.starts[at + 1]), self.starts[at + 1] - self.starts[at]
        cell = np.repeat(row * (blocks * BLOCK), held) + self.docs[found]
        total = np.bincount(cell, np.repeat(weight, held) * self.weights[found], minlength=n * blocks * BLOCK).astype(np.float64).reshape(n, blocks, BLOCK)
        if without is not None:
            out = np.flatnonzero(without >= 0)
            total[out, without[out] // BLOCK, without[out] % BLOCK] = -np.inf
        # no example of a block has a larger cosine: the lists are summed, the matrices bounded by their largest weights
        rough = query.astype(np.float32)
        bound = rough @ self.head_max.T + total.max(axis=2)
        order = np.argsort(-bound, axis=1, kind="stable")
        near = np.zeros((n, blocks, BLOCK), dtype=np.float32)
        best = np.zeros((n, k), dtype=np.float32)
        place, size = 0, 4
        while place < blocks:
            step = order[:, place : place + size]
            limit = np.take_along_axis(bound, step, axis=1)
            who, which = np.nonzero((limit > 0) & (limit >= best[:, :1] - SLACK))
            if not len(who):
                break
            mine = step[who, which]
            by = np.argsort(mine, kind="stable")
            for some in np.split(by, np.flatnonzero(np.diff(mine[by])) + 1):
                block, rows = mine[some[0]], who[some]
                near[rows, block] = rough[rows] @ self.rough[block].T + total[rows, block]
            both = np.concatenate((best, np.take_along_axis(near, step[:, :, None], axis=1).reshape(n, -1)), axis=1)
            best = np.partition(both, both.shape[1] - k, axis=1)[:, -k:]  # the k-th best comes first
            place, size = place + size, 4 * size
        row, doc = np.nonzero((near > 0).reshape(n, -1) & (near >= best[:, :1, None] - SLACK).reshape(n, -1))
        cosine = total.reshape(n, -1)[row, doc]
        for a in range(0, len(row), 4096):
            some = slice(a, a + 4096)
            cosine[some] += np.einsum("ij,ij->i", query[row[some]], self.head[doc[some]])
        cosine = np.round(cosine, 12)
        by = np.lexsort((self.ids[doc], -cosine, row))
        row, doc, cosine = row[by], doc[by], cosine[by]
        top = np.arange(len(row)) - np.searchsorted(row, row) < k
        return row[top], doc[top], cosine[top]


class Words(dict):
    """Numbers of words: those of the vocabulary, and others on first sight. A number's terms are a word's own one and
    its stems, -1 for those not known; number 0 is all words without a term.
    """

    def __init__(self, terms: dict[str, int]):
        super().__init__()
        self.terms, self.flat = terms, array("i", [-1] * 4)
        for word in terms:
            if not word.endswith("*"):
                self[word]  # noqa: B018
        self.vocabulary = len(self), len(self.flat)

    def __missing__(self, word: str) -> int:
        get = self.terms.get
        own = get(word, -1)
        stem = get(word[:5] + "*", -1) if len(word) > 5 else -1
        if own < 0 and stem < 0:  # who has two words of a longer stem has two of the shortest one
            self[word] = 0
            return 0
        n = len(word)
        number = self[word] = len(self.flat) // 4
        self.flat.extend((own, stem, get(word[:6] + "*", -1) if n > 6 else -1, get(word[:7] + "*", -1) if n > 7 else -1))
        return number

    def terms_of(self, numbers: np.ndarray) -> np.ndarray:
        return np.frombuffer(self.flat, dtype=np.int32).reshape(-1, 4)[numbers]

    def forget(self) -> None:
        """Keep the vocabulary alone, whose words came first."""
        while len(self) > self.vocabulary[0]:
            self.popitem()
        self.flat = self.flat[: self.vocabulary[1]]

    def __reduce__(self):
        words, numbers = self.vocabulary
        return Words._of, (self.terms, dict(islice(self.items(), words)), self.flat[:numbers].tobytes())

    @classmethod
    def _of(cls, terms: dict[str, int], words: dict[str, int], flat: bytes) -> Words:
        out = cls.__new__(cls)
        out.update(words)
        out.terms, out.flat = terms, array("i", flat)
        out.vocabulary = len(out), len(out.flat)
        return out


class Model:
    """Vocabulary, weights of its terms, index, labels, prior and calibration."""

    def __init__(self, terms: list[str], term_weight: np.ndarray, ids: np.ndarray, labels: np.ndarray, tfs: list[tuple[np.ndarray, np.ndarray]], per_example: tuple[float, float] = (1.0, 1.0)):
        """tfs: of each example the numbers of its terms and how often it has them."""
        self.per_example = np.array(per_example)
        self.terms, self.term_weight = {t: k for k, t in enumerate(terms)}, term_weight
        self.is_stem = np.array([t.endswith("*") for t in terms], dtype=bool)
        self.words = Words(self.terms)
        order = np.array([k for k in np.lexsort((labels, ids)).tolist() if len(tfs[k][0])], dtype=np.int64)
        self.labels = labels[order]
        begins, at, weight = self.vectors(np.repeat(np.arange(len(order)), [len(tfs[k][0]) for k in order]), *(np.concatenate([np.zeros(0, dtype=np.int64), *(tfs[k][i] for k in order)]) for i in (0, 1)), len(order))
        self.index = BlockMaxIndex(ids[order], [(at[a:b], weight[a:b]) for a, b in zip(begins[:-1], begins[1:], strict=True)], len(terms))
        self.prior = float((self.per_example[labels] * labels).sum() / self.per_example[labels].sum()) if len(labels) else 0.0
        self.slope, self.offset = 1.0, 0.0
        if 0 < self.labels.sum():
            votes = self.votes(len(order), *self.index.search_all(begins, at, weight, K, np.arange(len(order))))
            self._calibrate(np.append(votes, [0.0, 1.0]), np.append(self.labels, [0, 1]))

    def vectors(self, row: np.ndarray, at: np.ndarray, n: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Unit vectors of rows: where each begins (and the end), terms and weights."""
        weight = (1 + np.log(n)) * self.term_weight[at]
        length = np.sqrt(np.bincount(row, weight**2, minlength=rows))
        return np.searchsorted(row, np.arange(rows + 1)), at, weight / length[row]

    def votes(self, rows: int, row: np.ndarray, docs: np.ndarray, cosine: np.ndarray) -> np.ndarray:
        """Weighted share of toxic neighbours of each row, with the prior as one distant neighbour."""
        weight = self.per_example[self.labels[docs]] / (1.05 - np.minimum(1.0, cosine))
        return (np.bincount(row, weight * self.labels[docs], minlength=rows) + self.prior) / (np.bincount(row, weight, minlength=rows) + 1)

    def _calibrate(self, votes: np.ndarray, labels: np.ndarray) -> None:
        """A rising logistic curve over the votes' log-odds, by Newton steps with a little shrinkage."""
        x = np.log(np.clip(votes, 1e-4, 1 - 1e-4) / (1 - np.clip(votes, 1e-4, 1 - 1e-4)))
        beta, weight = np.array([1.0, 0.0]), self.per_example[labels]
        for _ in range(50):
            p = 1 / (1 + np.exp(-(beta[0] * x + beta[1])))
            pull = np.array([(weight * (p - labels) * x).sum() + (beta[0] - 1), (weight * (p - labels)).sum() + beta[1]])
            v = weight * p * (1 - p)
            curve = np.array([[(v * x * x).sum() + 1, (v * x).sum()], [(v * x).sum(), v.sum() + 1]])
            step = np.linalg.solve(curve, pull)
            beta = beta - np.clip(step, -1, 1)
            if np.abs(step).max() < 1e-9:
                break
        self.slope, self.offset = max(0.1, float(beta[0])), float(beta[1])

    def counts(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Terms of the vocabulary in texts: numbers of texts (rising), terms (rising in a text), how often."""
        if len(self.words) > len(self.terms) + CACHE_WORDS:
            self.words.forget()
        number = self.words.__getitem__
        each = [np.fromiter(map(number, w), np.int64, len(w)) for w in map(words, texts)]
        of_word = self.words.terms_of(np.concatenate([np.zeros(0, dtype=np.int64), *each]))
        row = np.repeat(np.arange(len(texts)), [len(e) for e in each])
        known = of_word >= 0
        # a stem's words are all its occurrences, so one count of pairs serves words and stems
        key, n = np.unique((row[:, None] * len(self.terms) + of_word)[known], return_counts=True)
        row, at = np.divmod(key, max(1, len(self.terms)))
        n = n - self.is_stem[at]  # a stem counts from its second word on
        return row[n > 0], at[n > 0], n[n > 0]

    def score(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Scores of texts, and the evidence: numbers of texts (rising), positions of the nearest examples, cosines."""
        found, first = [], 0
        for last in _cuts(texts):
            rows = last - first
            row, docs, cosine = self.index.search_all(*self.vectors(*self.counts(texts[first:last]), rows), K)
            vote = np.clip(self.votes(rows, row, docs, cosine), 1e-4, 1 - 1e-4)
            scores = 1 / (1 + np.exp(-(self.slope * np.log(vote / (1 - vote)) + self.offset)))
            scores[np.bincount(row, minlength=rows) == 0] = self.prior
            found.append((scores, row + first, docs, cosine))
            first = last
        none = np.zeros(0, dtype=np.int64)
        return tuple(np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0), none, none, np.zeros(0))


def _cuts(texts: list[str | None]) -> Iterator[int]:
    """Ends of runs of texts of about CHUNK characters (a longer text is alone)."""
    held = 0
    for k, t in enumerate(texts):
        n = len(t) if t else 0
        if held and held + n > CHUNK:
            yield k
            held = 0
        held += max(1, n)
    if texts:
        yield len(texts)


def gains(toxic: np.ndarray, clean: np.ndarray, all_toxic: int, all_clean: int) -> np.ndarray:
    """Log-likelihood ratios of terms' presence, from the numbers of toxic and clean examples that have them."""
    n, both = all_toxic + all_clean, toxic + clean
    part = lambda seen, expected: seen * np.log(np.where(seen > 0, seen, 1) / np.where(seen > 0, expected, 1))
    return 2 * sum(part(seen, both * side / n) + part(side - seen, (n - both) * side / n) for seen, side in ((toxic, all_toxic), (clean, all_clean)))


def _document_frequencies(docs: DataFrame, chosen: list[str]) -> np.ndarray:
    """In how many rows of docs (text) each term is: every task counts on its own, the counts are summed by slot."""
    counter = Model(chosen, np.ones(len(chosen)), np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), [])
    size, sent = len(chosen), docs.sparkSession.sparkContext.broadcast(counter)
    edges = np.linspace(0, size, SLOTS + 1).astype(np.int64)
    packed = lambda n: {"at": np.flatnonzero(n).astype("<u4").tobytes(), "n": n[n > 0].astype("<i8").tobytes()}

    def of_task(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tidy()
        counter, df = sent.value, np.zeros(size, dtype=np.int64)
        for part in parts:
            texts, first = part["text"].tolist(), 0
            for last in _cuts(texts):
                df += np.bincount(counter.counts(texts[first:last])[1], minlength=size)
                first = last
        yield pd.DataFrame([{"slot": k} | packed(df[edges[k] : edges[k + 1]]) for k in range(SLOTS) if df[edges[k] : edges[k + 1]].any()], columns=["slot", "at", "n"])

    def summed(part: pd.DataFrame) -> pd.DataFrame:
        slot = int(part["slot"].iloc[0])
        df = np.zeros(edges[slot + 1] - edges[slot], dtype=np.int64)
        for at, n in zip(part["at"], part["n"], strict=True):
            df[np.frombuffer(at, "<u4")] += np.frombuffer(n, "<i8")
        return pd.DataFrame([{"slot": slot} | packed(df)])

    form = "slot int, at binary, n binary"
    out = np.zeros(size, dtype=np.int64)
    for r in docs.select("text").mapInPandas(of_task, form).groupBy("slot").applyInPandas(summed, form).collect():
        out[edges[r["slot"]] + np.frombuffer(r["at"], "<u4").astype(np.int64)] = np.frombuffer(r["n"], "<i8")
    return out


def fit(docs: DataFrame, labels: DataFrame, learn: Column, sample: int = SAMPLE) -> Model:
    """Train on docs (doc_id, text) and the rows of labels (doc_id, toxic) that `learn` chooses."""
    small_batches(docs.sparkSession)
    spark, docs = docs.sparkSession, docs.select("doc_id", "text")
    marked = labels.where(learn & F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1)).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    marked = marked.join(docs.select("doc_id"), "doc_id", "left_semi")
    # the first of each label by hash: every task keeps its own first ones, no label is sorted as a whole
    first = [marked.where(F.col("toxic") == x).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample).select("doc_id", "toxic").collect() for x in (0, 1)]
    picked = first[0] + first[1]
    # a label of which more examples exist than were taken counts for as many
    of_label = {r["toxic"]: r["n"] for r in marked.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    taken = Counter(r["toxic"] for r in picked)
    stands_for = tuple(of_label.get(x, 1) / max(1, taken[x]) for x in (0, 1))
    none = Model([], np.zeros(0), np.array([r["doc_id"] for r in picked], dtype=np.int64), np.array([r["toxic"] for r in picked], dtype=np.int64), [(np.zeros(0, dtype=np.int64), np.zeros(0))] * len(picked), stands_for)
    toxic = sum(r["toxic"] for r in picked)
    if not 0 < toxic < len(picked):
        return none
    ids = spark.createDataFrame([(r["doc_id"], int(r["toxic"])) for r in picked], "_id long, _toxic int")
    examples = docs.join(F.broadcast(ids), F.col("doc_id") == F.col("_id")).select("doc_id", F.col("_toxic").alias("toxic"), "text")  # at most 2 * sample ids
    # one text for a repeated id: the least
    examples = examples.groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))

    def own_terms(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tidy()
        for part in parts:
            found = [terms(t) for t in part["text"]]
            yield pd.DataFrame({"doc_id": part["doc_id"], "toxic": part["toxic"], "terms": [" ".join(f) for f in found], "n": [np.array(list(f.values()), dtype="<i4").tobytes() for f in found]})

    # all terms of at most 2 * sample examples come to the driver, as one text and one row of numbers each
    rows = examples.mapInPandas(own_terms, "doc_id long, toxic int, terms string, n binary").collect()
    if not any(r["terms"] for r in rows):
        return none
    chosen = sorted(set().union(*(r["terms"].split() for r in rows)))
    place = {t: k for k, t in enumerate(chosen)}
    tfs = []
    for r in rows:
        at = np.fromiter((place[t] for t in r["terms"].split()), np.int64)
        order = np.argsort(at)
        tfs.append((at[order], np.frombuffer(r["n"], "<i4")[order]))
    marks = np.array([r["toxic"] for r in rows], dtype=np.int64)
    seen = np.zeros((2, len(chosen)))
    for (at, _), x in zip(tfs, marks.tolist(), strict=True):
        seen[x, at] += 1
    gain = gains(seen[1], seen[0], int(marks.sum()), int((1 - marks).sum()))
    relevance = FLOOR + gain / gain.max() if gain.max() > 1e-9 else np.ones(len(chosen))
    idf = np.log((1 + docs.count()) / (1 + _document_frequencies(docs, chosen))) + 1
    return Model(chosen, idf * relevance, np.array([r["doc_id"] for r in rows], dtype=np.int64), marks, tfs, stands_for)


def score(df: DataFrame, model: Model, text: str = "text", out: str = "toxicity") -> DataFrame:
    """df with the struct `out`: score, predicted (1 from TOXIC_FROM on) and evidence."""
    small_batches(df.sparkSession)
    # a worker unpickles it once, not for every task, and lets it go when a stage without it comes
    sent = df.sparkSession.sparkContext.broadcast(model)

    form = pa.struct([("score", pa.float64()), ("evidence", pa.list_(pa.struct([("doc_id", pa.int64()), ("cosine", pa.float64()), ("label", pa.int32())])))])

    @F.arrow_udf("score double, evidence array<struct<doc_id: long, cosine: double, label: int>>")
    def predict(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tidy()
        model = sent.value
        for part in parts:
            scores, row, docs, cosine = model.score(part.to_pylist())
            near = pa.StructArray.from_arrays([pa.array(model.index.ids[docs]), pa.array(cosine), pa.array(model.labels[docs], pa.int32())], fields=list(form[1].type.value_type))
            begins = pa.array(np.searchsorted(row, np.arange(len(scores) + 1)), pa.int32())
            yield pa.StructArray.from_arrays([pa.array(scores), pa.ListArray.from_arrays(begins, near)], fields=list(form))

    scored = df.withColumn(out, predict(F.col(text)))
    return scored.withColumn(out, F.col(out).withField("predicted", F.when(F.col(f"{out}.score") >= TOXIC_FROM, 1).otherwise(0)))


def keep_clean(df: DataFrame, model: Model) -> DataFrame:
    """The rows of df that aren't predicted toxic, with df's own columns."""
    out = unused(df, "toxicity")
    return score(df, model, out=out).where(F.col(f"{out}.predicted") == 0).select(*df.columns)
