"""Token ids in a binary file format: Simple-8b words of 64 bits, with escapes and block offsets.

A file is a run of segments. All numbers are little-endian and every part is a whole number of 8-byte words:

    header   "S8BSEG01", documents, ids, blocks, words           (5 words)
    table    doc_id and id count of each document                (2 words each)
    blocks   first word and id count of each block               (2 words each)
    words    4 bits of selector, then 60 bits of ids, first id lowest
    trailer  "S8BEND.."                                          (1 word)

Selector s from 2 to 15 packs COUNTS[s] ids of BITS[s] bits. Selector 0 is an escape: the next word holds one id of
up to 64 bits as it is. Selector 1 is a run: the low 60 bits hold how many zeros follow. A block holds BLOCK_IDS ids
(the last one of a segment fewer), never shares a word with the next and so can be decoded alone.

Files go through Spark's own writer, whose commit keeps one copy of each task's output when executors are lost, and
whose file system is any that Spark knows. A segment is one line of that writer; the trailer is its line separator.

Defined cases. A null text counts as empty; it has the end id alone. Rows are in ascending order of doc_id, null
first, ties (repeated ids) by text; rows of one id, so all with a null one, are written by one task, a segment at a
time. An empty table gives no rows. Other columns are not read. Texts of any length
are encoded whole; a segment closes after SEGMENT_IDS ids, but always holds whole documents.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import new_folder, settle, small_batches

# Ids and bits of each Simple-8b selector; 0 and 1 are the escape and the run.
COUNTS = [1, 0, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1]
BITS = [64, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60]
MAGIC, TRAILER = b"S8BSEG01", b"S8BEND.."
BLOCK_IDS = 4096
SEGMENT_IDS = 1 << 20
#: Documents with a null id carry this one in the table.
NO_ID = -(1 << 63)


def _pack_block(ids: np.ndarray) -> np.ndarray:
    """Words of one block."""
    n = len(ids)
    if not n:
        return np.zeros(0, dtype=np.uint64)
    count = np.ones(n, dtype=np.int32)
    selector = np.zeros(n, dtype=np.uint8)
    top = int(ids.max())
    narrow = ids.astype(np.uint32) if top < 1 << 32 else ids  # half the memory to go through
    place = np.arange(n, dtype=np.int32)
    end = np.int32(n)
    for s in range(15, 1, -1):  # from few wide ids to many narrow ones; the last that fits holds most
        limit = 1 << BITS[s]
        if top < limit:
            fits = n - place
        else:
            stop = np.where(narrow >= narrow.dtype.type(limit), place, end)
            fits = np.minimum.accumulate(stop[::-1])[::-1] - place
            if fits.max() < COUNTS[s]:
                break  # narrower ones need more ids and fit fewer
        ok = fits >= COUNTS[s]
        count[ok] = COUNTS[s]
        selector[ok] = s
    zeros = None
    if not int(narrow.min()):
        stop = np.where(narrow != 0, place, end)
        zeros = np.minimum.accumulate(stop[::-1])[::-1] - place
        run = zeros > 60
        count[run], selector[run] = zeros[run], 1
    steps = count.tolist()
    starts, i = [], 0
    while i < n:
        starts.append(i)
        i += steps[i]
    at = np.array(starts, dtype=np.int64)
    sel = selector[at]
    wide = sel == 0
    place_of = np.arange(len(at)) + np.cumsum(wide) - wide  # an escape takes two words
    words = np.zeros(len(at) + int(wide.sum()), dtype=np.uint64)
    words[place_of[wide] + 1] = ids[at[wide]]
    if zeros is not None and (sel == 1).any():
        words[place_of[sel == 1]] = np.uint64(1) << np.uint64(60) | zeros[at[sel == 1]].astype(np.uint64)
    for s in np.unique(sel[sel > 1]).tolist():
        mine = at[sel == s]
        packed = np.full(len(mine), s << 60, dtype=np.uint64)
        for k in range(COUNTS[s]):
            packed |= ids[mine + k] << np.uint64(k * BITS[s])
        words[place_of[sel == s]] = packed
    return words


def _unpack_block(words: np.ndarray, n: int) -> np.ndarray:
    """The n ids of one block."""
    out = np.zeros(n, dtype=np.uint64)
    if not n:
        return out
    sel = (words >> np.uint64(60)).astype(np.int64)
    raw = np.zeros(len(words), dtype=bool)
    escapes = np.flatnonzero(sel == 0)
    if len(escapes):  # a raw word can look like an escape: walk those that can
        last = -2
        for e in escapes.tolist():
            if e != last + 1 or not raw[e]:
                if e + 1 >= len(words):
                    raise ValueError("an escape at the end of a block has no value")
                raw[e + 1] = True
                last = e
    low = words & np.uint64((1 << 60) - 1)
    counts = np.array(COUNTS, dtype=np.int64)[sel]
    runs = (sel == 1) & ~raw
    counts[runs] = low[runs].astype(np.int64)
    counts[raw] = 0
    ends = np.cumsum(counts)
    if ends[-1] != n:
        raise ValueError(f"a block holds {ends[-1]} ids and announces {n}")
    first = ends - counts
    for s in np.unique(sel[~raw]).tolist():
        mine = np.flatnonzero((sel == s) & ~raw)
        if s == 0:
            out[first[mine]] = words[mine + 1]
        elif s > 1:
            shifts = np.arange(COUNTS[s], dtype=np.uint64) * np.uint64(BITS[s])
            values = (low[mine][:, None] >> shifts) & np.uint64((1 << BITS[s]) - 1)
            out[(first[mine][:, None] + np.arange(COUNTS[s])).ravel()] = values.ravel()
    return out


def pack_segment(doc_ids: list[int], counts: list[int], ids: np.ndarray) -> bytes:
    """One segment without its trailer: whole documents, their ids one after another."""
    ids = np.ascontiguousarray(ids, dtype=np.uint64)
    blocks = [_pack_block(ids[i : i + BLOCK_IDS]) for i in range(0, len(ids), BLOCK_IDS)]
    sizes = np.array([len(b) for b in blocks], dtype=np.int64)
    words = np.concatenate(blocks) if blocks else np.zeros(0, dtype=np.uint64)
    header = np.array([len(doc_ids), len(ids), len(blocks), len(words)], dtype="<i8")
    docs = np.array([doc_ids, counts], dtype="<i8").T
    held = np.minimum(BLOCK_IDS, len(ids) - np.arange(len(blocks)) * BLOCK_IDS)
    index = np.array([np.cumsum(sizes) - sizes, held], dtype="<i8").T
    return MAGIC + header.tobytes() + docs.tobytes() + index.tobytes() + words.astype("<u8").tobytes()


def read_segments(data: bytes) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(doc ids, id counts, all ids) of each segment of a file; raises ValueError where the file is damaged."""
    at = 0
    while at < len(data):
        if data[at : at + 8] != MAGIC:
            raise ValueError(f"no segment starts at byte {at}")
        n_docs, n_ids, n_blocks, n_words = np.frombuffer(data, "<i8", 4, at + 8).tolist()
        at += 40
        docs = np.frombuffer(data, "<i8", 2 * n_docs, at).reshape(-1, 2)
        at += 16 * n_docs
        index = np.frombuffer(data, "<i8", 2 * n_blocks, at).reshape(-1, 2)
        at += 16 * n_blocks
        words = np.frombuffer(data, "<u8", n_words, at)
        at += 8 * n_words
        if data[at : at + 8] != TRAILER:
            raise ValueError(f"no segment ends at byte {at}")
        at += 8
        begins, stops = index[:, 0].tolist(), [*index[1:, 0].tolist(), n_words][:n_blocks]
        blocks = [_unpack_block(words[a:b], n) for a, b, n in zip(begins, stops, index[:, 1].tolist(), strict=True)]
        ids = np.concatenate(blocks) if blocks else np.zeros(0, dtype=np.uint64)
        if len(ids) != n_ids or docs[:, 1].sum() != n_ids:
            raise ValueError("a segment's counts disagree")
        yield docs[:, 0], docs[:, 1], ids


class _Store(dict):
    """Values by key, each made on first sight."""

    def __init__(self, make: Callable[[str], bytes]):
        super().__init__()
        self.make = make

    def __missing__(self, key: str) -> bytes:
        value = self[key] = self.make(key)
        return value


class WordTokenizer:
    """Ids by the tokenizers library. Its model runs once for each distinct piece.

    A piece is what the file's normaliser and splitter leave whole, so text is cut at white space first. Lower-case
    Latin text is cut here by the same rules; any text with other characters goes through the whole library.
    """

    #: Entries of each store of a worker; a full one is emptied, which costs time and changes no result.
    CACHE_PIECES = 600_000

    def __init__(self, spec: str):
        from tokenizers import Tokenizer

        from .bpe import byte_letters

        self.tokenizer = Tokenizer.from_str(spec)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model = self.tokenizer.model
        self.plain_ok = self._is_plain(spec)
        letters = byte_letters()
        self.letters = {chr(b): letters[b] for b in range(128)}
        self.all_letters = letters
        self.pieces, self.words, self.chunks = _Store(self._piece), _Store(self._word), _Store(self._chunk)
        #: Characters for which this class doesn't cut text itself, and openings of special tokens.
        self.other = re.compile("[^\t-\r -ſ]|[\x7f-\xbf]|<\\|")
        self.ascii = bytes([*range(9, 14), *range(32, 127)])
        self.pattern = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z\xaa\xb5\xba\xdf-\xf6\xf8-ſ]+|[0-9]|[^\\sa-z0-9\xaa\xb5\xba\xdf-\xf6\xf8-ſ]+")

    @staticmethod
    def _is_plain(spec: str) -> bool:
        """Whether the file's rules are those that this class applies itself."""
        import json

        data = json.loads(spec)
        kinds = [x["type"] for x in (data["normalizer"] or {}).get("normalizers", [])]
        cut = (data["pre_tokenizer"] or {}).get("pretokenizers", [])
        # Fixed value: the splitting pattern of the public word-level file.
        pattern = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
        return kinds == ["NFC", "Replace", "Lowercase"] and len(cut) == 2 and cut[0].get("pattern", {}).get("Regex") == pattern and not any(t["lstrip"] or t["rstrip"] or not t["content"].startswith("<|") for t in data["added_tokens"])

    def _word(self, word: str) -> bytes:
        spelt = word if word.isascii() else "".join(self.all_letters[b] for b in word.encode())
        return np.array([t.id for t in self.model.tokenize(spelt)], dtype="<u4").tobytes()

    def _piece(self, piece: str) -> bytes:
        if piece.isalpha():
            return self.words[piece]
        if piece[:-1].isalpha() and piece[-1] in ".,;:!?":
            return self.words[piece[:-1]] + self.words[piece[-1]]
        return b"".join(map(self.words.__getitem__, self.pattern.findall(piece)))

    def _is_cut_here(self, text: str) -> bool:
        if text.isascii():
            return "<|" not in text and not text.encode().translate(None, self.ascii)
        return self.other.search(text) is None

    def _chunk(self, chunk: str) -> bytes:
        return np.array(self.tokenizer.encode(chunk, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def encode(self, text: str) -> np.ndarray:
        """Ids of one text."""
        for store in (self.pieces, self.words, self.chunks):
            if len(store) > self.CACHE_PIECES:
                store.clear()
        if not self.plain_ok:
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4")
        if self._is_cut_here(text):
            store, parts = self.pieces, text.lower().split()
        else:
            store, parts = self.chunks, [x for x in re.split("[\t-\r ]+", text) if x]
        return np.frombuffer(b"".join(map(store.__getitem__, parts)), dtype="<u4")


@lru_cache(maxsize=2)
def _word_tokenizer(spec: str) -> WordTokenizer:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return WordTokenizer(spec)


def write_ids(df: DataFrame, spec: str, end_id: int, path: str) -> None:
    """Encode doc_id and text of df and write the files to path, in ascending order of doc_id over all files."""
    small_batches(df.sparkSession)

    def segments(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tokenizer = _word_tokenizer(spec)
        end = np.array([end_id], dtype="<u4")
        docs: list[int] = []
        counts: list[int] = []
        held: list[np.ndarray] = []
        total = 0
        for part in parts:
            for doc_id, text in zip(part["doc_id"].tolist(), part["text"].tolist(), strict=True):
                ids = np.append(tokenizer.encode(text) if text else end, end[: 1 if text else 0])
                docs.append(int(doc_id))
                counts.append(len(ids))
                held.append(ids)
                total += len(ids)
                if total >= SEGMENT_IDS:
                    yield pd.DataFrame({"segment": [pack_segment(docs, counts, np.concatenate(held))]})
                    docs, counts, held, total = [], [], [], 0
        if docs:
            yield pd.DataFrame({"segment": [pack_segment(docs, counts, np.concatenate(held))]})

    placed = df.select(F.coalesce(F.col("doc_id"), F.lit(NO_ID)).alias("doc_id"), "text")
    placed = placed.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    lines = placed.mapInPandas(segments, "segment binary")
    # a cast keeps the bytes as they are, and the text writer puts them out unchanged
    lines.select(F.col("segment").cast("string").alias("value")).write.option("lineSep", TRAILER.decode()).text(path)


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """Per document of the files, in their order: part, place in the part, doc_id, ids before it in the part, ids."""
    return _from_files(spark, path, "ids array<long>", lambda ids, begins, ends: [[ids[a:b].astype(np.int64) for a, b in zip(begins, ends, strict=True)]])


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """As read_ids, with the number of ids and the crc32 of the ids as 32-bit little-endian numbers in their place."""

    def digest(ids: np.ndarray, begins: list[int], ends: list[int]) -> list[list]:
        raw = memoryview(ids.astype("<u4").tobytes())
        return [[b - a for a, b in zip(begins, ends, strict=True)], [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(begins, ends, strict=True)]]

    return _from_files(spark, path, "n_tokens long, ids_crc32 long", digest)


def _from_files(spark: SparkSession, path: str, schema: str, make) -> DataFrame:
    names = [x.split(" ")[0] for x in schema.split(", ")]

    def documents(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for file, data in zip(part["path"].tolist(), part["content"].tolist(), strict=True):
                number = int(re.search(r"part-(\d+)", file.rsplit("/", 1)[1])[1])
                place, before = 0, 0
                for docs, counts, ids in read_segments(data):
                    ends = np.cumsum(counts)
                    begins = (ends - counts).tolist()
                    made = make(ids, begins, ends.tolist())
                    same = {"part": number, "place": np.arange(place, place + len(docs)), "doc_id": docs, "before": before + ends - counts}
                    yield pd.DataFrame(same | dict(zip(names, made, strict=True)))
                    place += len(docs)
                    before += int(ends[-1]) if len(ends) else 0

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    out = files.mapInPandas(documents, f"part int, place long, doc_id long, before long, {schema}")
    return out.withColumn("doc_id", F.when(F.col("doc_id") != NO_ID, F.col("doc_id")))


def encode_table(df: DataFrame, spec: str, end_id: int = 2) -> DataFrame:
    """Write the ids of df to files in the shared folder, read them back and return one row per document.

    Columns: doc_id, start (ids of all documents before it), n_tokens, ids_crc32, part (number of the file). What is
    summed in one task is one row per file, never per document.
    """
    from pyspark.sql import Window

    spark = df.sparkSession
    path = new_folder(spark, "token-ids")
    write_ids(df, spec, end_id, path)
    found = settle(read_digests(spark, path))
    totals = found.groupBy("part").agg(F.sum("n_tokens").alias("held"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("part", F.coalesce(F.sum("held").over(earlier), F.lit(0)).alias("base"))
    return found.join(bases, "part").select("doc_id", (F.col("base") + F.col("before")).alias("start"), "n_tokens", "ids_crc32", "part")
