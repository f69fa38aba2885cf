"""Token ids in binary files: Simple-8b words in blocks, with a document index a block.

A word of 64 bits holds a selector in its high 4 bits and as many ids of equal width as fit in the other 60. Selectors
0 and 1 stand for runs of zeros, 15 for an escape: the whole next word is one id. A block holds the ids of some
hundred documents; its header has the counts, so each block is decoded alone and as a whole with numpy.

File: blocks, then for each block its offset as an unsigned 64-bit integer, then the number of blocks, then a magic.
Block: documents, ids, words (unsigned 64-bit); for each document its id (signed), whether it has an id, its number of
ids; then the words. All little-endian.
"""

from __future__ import annotations

import json
import os
import re
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from civicframe.llm.common import open_store, release, stored

END_MAGIC = b"S8BFILE1"
#: Selector: how many ids a word holds. Those of selectors 2 to 14 have 60 // n bits each. Fixed values of Simple-8b.
COUNTS = (240, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2)
#: Selector of one id of 60 bits is folded into the escape, which takes 64 bits in a word of its own.
ESCAPE = 15
_BITS = tuple(0 if i < 2 else 60 // n for i, n in enumerate(COUNTS))
_WIDTHS = np.array([i.bit_length() for i in range(1 << 16)], np.uint8)


def _width(ids: np.ndarray) -> np.ndarray:
    """Bits that each id needs."""
    if ids.max() < len(_WIDTHS):
        return _WIDTHS[ids]
    bits, rest = np.zeros(len(ids), np.uint8), ids.copy()
    for shift in (32, 16, 8, 4, 2, 1):
        high = rest >> np.uint64(shift) != 0
        bits[high] += shift
        rest[high] >>= np.uint64(shift)
    return bits + (ids != 0).astype(np.uint8)


def pack(ids: np.ndarray) -> np.ndarray:
    """Words (uint64) that hold ``ids`` (uint64)."""
    n = len(ids)
    if not n:
        return np.zeros(0, np.uint64)
    bits = _width(ids)
    took, chosen = np.ones(n, np.uint8), np.full(n, ESCAPE, np.uint8)
    widest = {1: np.concatenate((bits, np.zeros(max(COUNTS), np.uint8)))}  # at n: of the n ids from a place
    for count in sorted(COUNTS):
        half = max(k for k in widest if k < count)
        step = count - half
        widest[count] = np.maximum(widest[half][: len(widest[half]) - step], widest[half][step:])
    for selector in range(len(COUNTS) - 1, -1, -1):  # fewest ids a word first, so that the fullest that fits stays
        count = COUNTS[selector]
        fits = widest[count][:n] <= _BITS[selector]
        if selector < 2:  # runs of zeros must be whole
            fits[max(0, n - count + 1) :] = False
        if fits.any():
            took[fits], chosen[fits] = count, selector
    starts, follow, at = [], took.tolist(), 0
    while at < n:
        starts.append(at)
        at += follow[at]
    starts = np.array(starts)
    selectors = chosen[starts].astype(np.uint64)
    slots = 1 + (selectors == ESCAPE)
    out = np.zeros(int(slots.sum()), np.uint64)
    first = np.cumsum(slots) - slots
    out[first] = selectors << np.uint64(60)
    out[first[selectors == ESCAPE] + 1] = ids[starts[selectors == ESCAPE]]
    padded = np.concatenate((ids, np.zeros(max(COUNTS), np.uint64)))
    for selector in range(2, len(COUNTS)):
        mine = selectors == selector
        if mine.any():
            values = padded[starts[mine][:, None] + np.arange(COUNTS[selector])]
            shifts = (np.arange(COUNTS[selector]) * _BITS[selector]).astype(np.uint64)
            out[first[mine]] |= np.bitwise_or.reduce(values << shifts, axis=1)
    return out


def unpack(words: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` ids (uint64) of :func:`pack`."""
    selectors = (words >> np.uint64(60)).astype(np.int64)
    escapes = np.flatnonzero(selectors == ESCAPE)
    raw = np.zeros(len(words), bool)
    if len(escapes):  # a raw word may look like an escape: only those that no escape precedes count
        last = -2
        for i in escapes.tolist():
            if i != last + 1:
                raw[i + 1] = True
                last = i
    held = np.array([*COUNTS, 1])[selectors]
    held[raw] = 0
    first = np.cumsum(held) - held
    out = np.zeros(int(held.sum()), np.uint64)
    for selector in range(2, len(COUNTS)):
        mine = (selectors == selector) & ~raw
        if mine.any():
            width = _BITS[selector]
            shifts = (np.arange(COUNTS[selector]) * width).astype(np.uint64)
            values = (words[mine][:, None] >> shifts) & np.uint64((1 << width) - 1)
            out[first[mine][:, None] + np.arange(COUNTS[selector])] = values
    at = np.flatnonzero((selectors == ESCAPE) & ~raw)
    out[first[at]] = words[at + 1]
    return out[:n]


def block(doc_ids: list[int | None], ids: list[np.ndarray]) -> bytes:
    """A block of the documents' ids."""
    lengths = np.array([len(x) for x in ids], np.uint64)
    packed = pack(np.concatenate(ids).astype(np.uint64) if ids else np.zeros(0, np.uint64))
    counts = np.array([len(ids), int(lengths.sum()), len(packed)], "<u8")
    known = np.array([x is not None for x in doc_ids], np.uint8)
    return b"".join((counts.tobytes(), np.array([x or 0 for x in doc_ids], "<i8").tobytes(), known.tobytes(), lengths.astype("<u8").tobytes(), packed.astype("<u8").tobytes()))


def blocks(f, size: int) -> Iterator[tuple[list[int | None], list[np.ndarray]]]:
    """Document ids and token ids, block by block, of an open file."""
    f.seek(size - 16)
    tail = f.read(16)
    if tail[8:] != END_MAGIC:
        raise ValueError("not a whole token file")
    n = int(np.frombuffer(tail[:8], "<u8")[0])
    f.seek(size - 16 - 8 * n)
    for at in np.frombuffer(f.read(8 * n), "<u8").tolist():
        f.seek(at)
        docs, ids, packed = (int(x) for x in np.frombuffer(f.read(24), "<u8"))
        doc_ids = np.frombuffer(f.read(8 * docs), "<i8").tolist()
        known = np.frombuffer(f.read(docs), np.uint8)
        lengths = np.frombuffer(f.read(8 * docs), "<u8").astype(np.int64)
        values = unpack(np.frombuffer(f.read(8 * packed), "<u8"), ids)
        yield [x if k else None for x, k in zip(doc_ids, known, strict=True)], np.split(values, np.cumsum(lengths)[:-1]) if docs else []


#: How a tokenizer must normalise and split for its words to be encoded one by one; fixed values of the vocabulary file.
_NORMAL = ["NFC", "Replace", "Lowercase"]
_PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: The same pieces of printable small Latin-1 text, whose letters are composed and stay so.
_latin_pieces = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zªµºß-öø-ÿ]+|[0-9²³¹¼-¾]|[^a-zªµºß-öø-ÿ0-9²³¹¼-¾]+").findall
#: Bytes that byte-level vocabularies write as another sign: those that can't be printed, in turn from 256 on.
_SHOWN = {b: 256 + i for i, b in enumerate([*range(33), *range(127, 161), 173])}
_controls, _marks = re.compile("[\x1c-\x1f]").search, re.compile("[\u0300-\u036f]").search
_words = re.compile(r"[^\x20\x09-\x0D]+").findall


class WordEncoder:
    """Texts to token ids, equal to those of the library for whole texts.

    A tokenizer that drops white space, lower-cases and joins nothing across white space (``plain``) encodes each distinct
    string between white space once; a text costs a look-up a word. A new word is normalised and split by the library itself, unless it
    is Latin-1, where both are plain, and each new piece is merged once. Words and pieces are held in two generations of ``keep`` each: when the young one
    is full it takes the place of the old one, and what is met again moves back, so frequent words stay. Words with control
    strings of the vocabulary go to the library as they are. For any other tokenizer whole texts go to the library.
    """

    def __init__(self, path: str, keep: int = 1 << 18) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.library, self.keep = Tokenizer.from_file(path), keep
        self.library.no_padding()
        self.library.no_truncation()
        made = json.loads(self.library.to_str())
        normal = [x["type"] for x in (made["normalizer"] or {}).get("normalizers", [])]
        splits = [x.get("pattern", {}).get("Regex") for x in (made["pre_tokenizer"] or {}).get("pretokenizers", [])]
        self.plain = normal == _NORMAL and splits == [_PIECES, None]
        self.known: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}
        self.old: tuple[dict[str, bytes], dict[str, bytes]] = ({}, {})

    def _whole(self, text: str) -> bytes:
        return array("I", self.library.encode(text, add_special_tokens=False).ids).tobytes()

    def _piece(self, shown: str) -> bytes:
        """Ids of a piece in the letters that the vocabulary writes bytes in."""
        ids = self.pieces.get(shown)
        if ids is None:
            ids = self.old[1].get(shown)
            if ids is None:
                ids = array("I", [t.id for t in self.library.model.tokenize(shown)]).tobytes()
            self.pieces[shown] = ids
        return ids

    def _learn(self, word: str) -> bytes:
        if "<|" in word:
            return self._whole(word)
        if word.isprintable() and max(word) <= "\xff":
            pieces = _latin_pieces(word.lower())
            return b"".join([self._piece(p if p.isascii() else p.encode().decode("latin-1").translate(_SHOWN)) for p in pieces])
        normal = self.library.normalizer.normalize_str(word)
        return b"".join([self._piece(p) for p, _ in self.library.pre_tokenizer.pre_tokenize_str(normal)])

    def split(self, text: str) -> list[str]:
        """Strings between white space, A-Z in lower case where that can't matter."""
        if "<|" not in text and (text.isascii() or not _marks(text)):  # a small letter may join with a mark where its capital doesn't
            text = text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")
        return _words(text) if _controls(text) else text.split()  # str.split also cuts at four control codes

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        if not self.plain:
            return [np.frombuffer(self._whole(x), np.uint32) for x in texts]
        if len(self.known) > self.keep:
            self.old, self.known = (self.known, self.old[1]), {}
        if len(self.pieces) > self.keep:
            self.old, self.pieces = (self.old[0], self.pieces), {}
        split, known = [self.split(x) for x in texts], self.known
        for word in set().union(*split).difference(known):
            ids = self.old[0].get(word)
            known[word] = self._learn(word) if ids is None else ids
        return [np.frombuffer(b"".join(map(known.__getitem__, ws)), np.uint32) for ws in split]


encoders: dict[tuple[str, int], WordEncoder] = {}


def word_encoder(path: str, keep: int = 1 << 17) -> WordEncoder:
    """The encoder of a vocabulary file that this worker process holds, so that later tasks find its words."""
    from civicframe.llm import tokens  # the module's own store, also for functions that were sent to a worker by value

    if (path, keep) not in tokens.encoders:
        tokens.encoders[path, keep] = WordEncoder(path, keep)
    return tokens.encoders[path, keep]


def write_tokens(docs: DataFrame, uri: str, tokenizer_path: str, *, end_id: int, id_col: str = "doc_id", text_col: str = "text", tasks: int | None = None, block_docs: int = 512, keep: int = 1 << 17) -> DataFrame:
    """Encode the texts and write their ids in ascending ``id_col`` order; return (part, path, size, docs, ids).

    Ids of documents are whole numbers. Null texts count as empty; each document ends with ``end_id``. Rows with a null id come first; rows with equal ids
    are ordered by a hash of their text. Other columns are ignored. An empty table gives an empty list. The texts are
    dealt by ranges of id and hash, so each task writes a run of the corpus and rows that share an id, or have none, are
    dealt over tasks too. ``keep`` words and pieces are held a worker (:class:`WordEncoder`): more cost memory, fewer time. Files of attempts that did not count are not listed.
    """
    tasks = tasks or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = open_store(uri)
        part = TaskContext.get().partitionId()
        path, out, offsets, size, total, count, encode = "", None, [], 0, 0, 0, None
        for batch in batches:
            if not batch.num_rows:
                continue
            if out is None:
                fs.create_dir(base, recursive=True)
                path = f"{base}/part-{part:05d}-{uuid.uuid4().hex}.s8b"
                out, encode = fs.open_output_stream(path, compression=None), word_encoder(tokenizer_path, keep)
            doc_ids = batch.column(0).to_pylist()
            for i in range(0, len(doc_ids), block_docs):
                ids = [np.append(x, np.uint32(end_id)) for x in encode(batch.column(1).slice(i, block_docs).to_pylist())]
                data = block(doc_ids[i : i + block_docs], ids)
                out.write(data)
                offsets.append(size)
                size, total, count = size + len(data), total + sum(map(len, ids)), count + len(ids)
        if out is not None:
            release()
            tail = np.array([*offsets, len(offsets)], "<u8").tobytes() + END_MAGIC
            out.write(tail)
            out.close()
            yield pa.RecordBatch.from_pydict({"part": [part], "path": [path], "size": [size + len(tail)], "docs": [count], "ids": [total]})

    order = ["id", F.xxhash64("text")]
    ranged = rows.repartitionByRange(tasks, *order).sortWithinPartitions(*order, "text")
    return stored(ranged.mapInArrow(write, "part long, path string, size long, docs long, ids long"), "token-files")


def read_tokens(files: DataFrame, uri: str) -> DataFrame:
    """Per document of the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # over the list of files
    placed = files.withColumn("base", F.coalesce(F.sum("ids").over(before), F.lit(0).cast("long"))).select("path", "size", "base")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, _ = open_store(uri)
        for batch in batches:
            for path, size, start in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                with fs.open_input_file(path) as f:
                    for doc_ids, ids in blocks(f, size):
                        lengths = [len(x) for x in ids]
                        starts = (start + np.cumsum([0, *lengths])).tolist()
                        start = starts.pop()
                        sums = [zlib.crc32(x.astype("<u4").tobytes()) for x in ids]
                        yield pa.RecordBatch.from_arrays([pa.array(doc_ids, pa.int64()), pa.array(starts, pa.int64()), pa.array(lengths, pa.int64()), pa.array(sums, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    tasks = files.sparkSession.sparkContext.defaultParallelism * 4
    return placed.repartition(tasks).mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")
