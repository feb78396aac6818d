"""Byte-level BPE encoding and decoding with a segment tree over adjacent pair ranks.

The vocabulary is read from a public tokenizer file (its path is a parameter); nothing is trained.

Defined cases. A null or empty text has no ids and decodes to the empty text. Special tokens written out in a
text become their ids, as the tokenizers library does, and decode to their text. Bytes that are no UTF-8 decode
to U+FFFD. Texts may be of any length: a text is cut at white space and only distinct pieces are merged.
Rows are independent, so ties, repeated rows, empty tables and extra columns need no rule: other columns are kept.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import held, small_batches, unused

# White space of the tokenizers library's \s, and the pattern that splits text before merging.
SPACE = "\\t\\n\\x0b\\x0c\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
WORD = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^" + SPACE + r"\p{L}\p{N}]+"

#: A leaf of the tree without a mergeable pair.
NONE = np.int64(1) << 62
#: Words of up to so many bytes are merged in step; longer ones one by one. So many words in one step.
WIDEST, STEP_WORDS = 64, 8192

#: Pieces and words kept per worker, and their characters at most, so that the store's bytes are bounded; a full store
#: is emptied, which costs time and changes no result.
CACHE_PIECES, CACHE_LONGEST = 600_000, 64


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    letters = {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}
    return [letters[b] for b in range(256)]


class SegmentTreeBPE:
    """Encoder and decoder of one byte-level vocabulary."""

    def __init__(self, spec: str):
        data = json.loads(spec)
        vocab: dict[str, int] = data["model"]["vocab"]
        letters = byte_letters()
        self.byte_id = [vocab[x] for x in letters]
        #: (left id, right id) in one number -> (rank, id of the merged symbol)
        self.pair: dict[int, tuple[int, int]] = {}
        for rank, merge in enumerate(data["model"]["merges"]):
            a, b = merge if isinstance(merge, list) else merge.split(" ")
            self.pair.setdefault(vocab[a] << 32 | vocab[b], (rank, vocab[a + b]))
        of_letter = {x: b for b, x in enumerate(letters)}
        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}
        names = vocab | self.special
        self.token_bytes = [b""] * (max(names.values()) + 1)
        for text, i in names.items():
            known = all(x in of_letter for x in text)
            self.token_bytes[i] = bytes(of_letter[x] for x in text) if known else text.encode()
        keys = np.array(sorted(self.pair), dtype=np.int64)
        self.pair_keys = np.append(keys, np.int64(1) << 62)
        self.pair_ranks = np.array([self.pair[k][0] for k in keys.tolist()] + [0], dtype=np.int64)
        self.merged = np.zeros(len(self.pair_keys), dtype=np.int64)
        for rank, merged in self.pair.values():
            self.merged[rank] = merged
        self.byte_ids = np.array(self.byte_id, dtype=np.int64)
        self.pieces = re.compile(f" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")
        self.words = regex.compile(WORD)
        longest_first = sorted(self.special, key=len, reverse=True)
        self.specials = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")") if longest_first else None
        #: ids as 32-bit numbers, which take a third of the memory of Python's
        self.known: dict[str, bytes] = {}

    def merge(self, word: str) -> tuple[int, ...]:
        """Ids of one piece of the pattern.

        Leaf i of the tree holds rank and position of the pair that starts at symbol i. The root is the least of
        them, so the leftmost pair of lowest rank; a merge changes three leaves and their ancestors.
        """
        ids = [self.byte_id[b] for b in word.encode()]
        n = len(ids)
        if n == 1:
            return (ids[0],)
        pair = self.pair
        size = 1 << (n - 1).bit_length()
        none = int(NONE)
        tree = [none] * (2 * size)
        for i in range(n - 1):
            found = pair.get(ids[i] << 32 | ids[i + 1])
            if found:
                tree[size + i] = found[0] << 32 | i
        for i in range(size - 1, 0, -1):
            a, b = tree[2 * i], tree[2 * i + 1]
            tree[i] = a if a < b else b
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        while tree[1] != none:
            i = tree[1] & 0xFFFFFFFF
            j = after[i]
            ids[i] = pair[ids[i] << 32 | ids[j]][1]
            k = after[i] = after[j]
            ids[j] = -1
            changed = [(j, none)]
            if k < n:
                before[k] = i
                found = pair.get(ids[i] << 32 | ids[k])
                changed.append((i, found[0] << 32 | i if found else none))
            else:
                changed.append((i, none))
            h = before[i]
            if h >= 0:
                found = pair.get(ids[h] << 32 | ids[i])
                changed.append((h, found[0] << 32 | h if found else none))
            for at, value in changed:
                at += size
                if tree[at] == value:
                    continue
                tree[at] = value
                at >>= 1
                while at:
                    a, b = tree[2 * at], tree[2 * at + 1]
                    least = a if a < b else b
                    if tree[at] == least:
                        break
                    tree[at] = least
                    at >>= 1
        return tuple(x for x in ids if x >= 0)

    def _leaf(self, left: np.ndarray, right: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Leaves of the pairs that start at `at`; NONE where no merge is known or a symbol is missing."""
        key = left << 32 | right
        found = np.searchsorted(self.pair_keys, key)
        found[found == len(self.pair_keys)] -= 1
        ok = (self.pair_keys[found] == key) & (left >= 0) & (right >= 0)
        return np.where(ok, self.pair_ranks[found] << 32 | at, NONE)

    def merge_many(self, words: list[str]) -> list[bytes]:
        """merge() of many words at once: their trees are rows of one array and advance in step."""
        raw = [w.encode() for w in words]
        out = [b""] * len(words)
        classes: dict[int, list[int]] = {}
        for k, b in enumerate(raw):
            if len(b) > WIDEST:
                out[k] = np.array(self.merge(words[k]), dtype=np.int32).tobytes()
            else:
                classes.setdefault(max(2, 1 << (len(b) - 1).bit_length()), []).append(k)
        for size, members in classes.items():
            for start in range(0, len(members), STEP_WORDS):
                part = members[start : start + STEP_WORDS]
                for k, ids in zip(part, self._merge_rows([raw[k] for k in part], size), strict=True):
                    out[k] = ids
        return out

    def _merge_rows(self, raw: list[bytes], size: int) -> list[bytes]:
        n = len(raw)
        lengths = np.array([len(b) for b in raw])
        ids = np.full((n, size + 1), -1, dtype=np.int64)  # the last column stands for "no symbol"
        filled = np.arange(size + 1) < lengths[:, None]
        ids[filled] = self.byte_ids[np.frombuffer(b"".join(raw), dtype=np.uint8)]
        after = np.tile(np.arange(1, size + 2), (n, 1))
        after[after >= lengths[:, None]] = size
        before = np.tile(np.arange(-1, size), (n, 1))
        tree = np.full((n, 2 * size), NONE, dtype=np.int64)
        at = np.broadcast_to(np.arange(size - 1), (n, size - 1))
        tree[:, size : 2 * size - 1] = self._leaf(ids[:, : size - 1], ids[:, 1:size], at)
        level = size // 2
        while level:
            tree[:, level : 2 * level] = np.minimum(tree[:, 2 * level : 4 * level : 2], tree[:, 2 * level + 1 : 4 * level : 2])
            level //= 2
        rows = np.arange(n)
        while True:
            root = tree[rows, 1]
            open_ = root != NONE
            rows, root = rows[open_], root[open_]
            if not len(rows):
                break
            i = root & 0xFFFFFFFF
            j = after[rows, i]
            new = self.merged[root >> 32]
            k = after[rows, j]
            ids[rows, i] = new
            ids[rows, j] = -1
            after[rows, i] = k
            before[rows, k] = i
            h = before[rows, i]
            h_or_none = np.where(h < 0, size, h)
            right, left = self._leaf(new, ids[rows, k], i), self._leaf(ids[rows, h_or_none], new, h)
            spots = [j + size, i + size, np.where(h < 0, i, h) + size]
            tree[rows, spots[0]] = NONE
            tree[rows, spots[1]] = right
            tree[rows, spots[2]] = np.where(h < 0, right, left)
            depth = size
            while depth > 1:
                depth //= 2
                for s in range(3):
                    spots[s] = p = spots[s] >> 1
                    tree[rows, p] = np.minimum(tree[rows, 2 * p], tree[rows, 2 * p + 1])
        kept = ids >= 0
        flat, ends = ids[kept].astype(np.int32).tobytes(), np.cumsum(4 * kept.sum(axis=1)).tolist()
        return [flat[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]

    def _learn(self, pieces: set[str]) -> None:
        """Bring the ids of pieces into the store, which holds words too: a piece of one word is that word.

        White space is one word of the pattern.
        """
        cut = [(p, [p] if p.isspace() else self.words.findall(p)) for p in pieces]
        fresh = list({w for _, words in cut for w in words} - self.known.keys())
        known = self.known
        known.update(zip(fresh, self.merge_many(fresh), strict=True))
        for p, words in cut:
            if len(words) > 1:
                known[p] = b"".join(map(known.__getitem__, words))

    def encode_batch(self, texts: list[str | None]) -> list[np.ndarray]:
        """Ids of texts; null counts as empty."""
        find = self.pieces.findall
        parts = [(self.specials.split(t) if self.specials else [t]) if t else [] for t in texts]
        cut = [[np.int32(self.special[x]).tobytes() if k % 2 else find(x) for k, x in enumerate(p)] for p in parts]
        new: set[str] = set().union(*(x for c in cut for x in c if isinstance(x, list)))
        if len(self.known) + len(new) > CACHE_PIECES:
            self.known.clear()
        self._learn(new - self.known.keys())
        get = self.known.__getitem__
        found = [np.frombuffer(b"".join([x if isinstance(x, bytes) else b"".join(map(get, x)) for x in c]), dtype=np.int32) for c in cut]
        for piece in [p for p in new if len(p) > CACHE_LONGEST]:
            for word in (piece, *self.words.findall(piece)):
                if len(word) > CACHE_LONGEST:
                    self.known.pop(word, None)
        return found

    def encode(self, text: str | None) -> list[int]:
        """Ids of one text."""
        return self.encode_batch([text])[0].tolist()

    def decode(self, ids) -> str:
        """Text of ids, special tokens included."""
        ids = ids.tolist() if isinstance(ids, np.ndarray) else ids
        return b"".join(map(self.token_bytes.__getitem__, ids)).decode("utf-8", "replace")


def _codec(spec: str) -> SegmentTreeBPE:
    return held(("bpe", spec), lambda: SegmentTreeBPE(spec))


def load_spec(path: str) -> str:
    """The tokenizer file's text. The driver reads it and ships it, so executors need no such file."""
    with open(path, encoding="utf-8") as f:
        return f.read()


def encoder(spec: str):
    """A Pandas UDF: text -> array of ids."""

    @F.pandas_udf("array<int>")
    def bpe_encode(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        codec = _codec(spec)
        for texts in parts:
            yield pd.Series(codec.encode_batch(texts.tolist()), dtype=object)

    return bpe_encode


def decoder(spec: str):
    """A Pandas UDF: array of ids -> text."""

    @F.pandas_udf("string")
    def bpe_decode(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        codec = _codec(spec)
        for ids in parts:
            yield pd.Series(["" if x is None else codec.decode(x) for x in ids], dtype=object)

    return bpe_decode


def round_trip(df: DataFrame, path: str, text: str = "text", ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """df with the ids of its text column and the text decoded from those ids.

    One UDF makes both: two in a row would run two Python workers for each task.
    """
    small_batches(df.sparkSession)
    spec = load_spec(path)

    @F.pandas_udf("ids array<int>, decoded string")
    def bpe_round_trip(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        codec = _codec(spec)
        for texts in parts:
            # rows that repeat a text, as a mix does one after another, are encoded once
            rows = texts.tolist()
            place = {t: k for k, t in enumerate(dict.fromkeys(rows))}
            found = codec.encode_batch(list(place))
            back = [codec.decode(x) for x in found]
            yield pd.DataFrame({"ids": pd.Series([found[place[t]] for t in rows], dtype=object), "decoded": [back[place[t]] for t in rows]})

    both = unused(df, "bpe")
    done = df.withColumn(both, bpe_round_trip(F.col(text)))
    return done.select(*[c for c in df.columns if c not in (ids, decoded)], F.col(f"{both}.ids").alias(ids), F.col(f"{both}.decoded").alias(decoded))
