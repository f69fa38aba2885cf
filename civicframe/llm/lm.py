"""Language-model scores by a weighted backoff automaton of order 3.

The model. Root, where each word has its add-one probability; a state for each word, and for the start of a text, and a
state for each pair of words, if they occur ``LEAST`` times in the texts that are learned from. Every word that follows
a state there is an arc, however rare. With n its count, c the state's and k the state's strength (``STRENGTH``), an arc
weighs log10((n + k * p) / (c + k)), where p is the word's probability in the state that the failure arc leads to; the
failure arc weighs log10(k / (c + k)). So the probabilities of all words in a state sum to one, with one unseen word
counted as known by the add-one rule. A word that has no arc in the state of the two words before it takes failure arcs, from the pair to the word and from the word
to the root, until it has one. After a word the state is that of the longest of its endings that is a state. The arcs of a block are not
built as one table: they are looked up order by order for all tokens of the block at once, and the weights of the failure
arcs taken on the way are added, which gives the sum that a walk from left to right gives.

Counting. Texts are read once into blocks, files of token numbers of some million tokens with the block's own
vocabulary. A block sends each distinct gram (a word, later a pair, then a triple) of its texts with its count once, as
a 64-bit hash; the total comes back to it. Grams are dealt by ranges of the hash, so a range holds about as many grams
as a block has, and a common gram is one entry a block. Nothing is dropped and nobody holds the whole model: a block
gets the arcs and states that its own texts can take. The order of sending is that of the hash, so totals come
back as bare numbers. Two grams that share a hash would share a count: of n grams about n ** 2 / 2 ** 65 pairs do.
"""

from __future__ import annotations

import io
import math
import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civicframe.llm.common import open_store, shared_path, stored

#: Occurrences, in the texts learned from, of a word or a pair that is a state.
LEAST = 2
#: Weight of the lower order, in occurrences: in states of a word, and of a pair.
STRENGTH = (500.0, 20.0)
#: Tokens of a block, about.
BLOCK = 1 << 22
#: Key of the start of a text among the keys of words.
START = np.uint64(0x5851F42D4C957F2D)
END = "\n"  # no word holds white space

_UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
_find = re.compile(r"[^\x20\x09-\x0D]+").findall


def tokens(text: str | None) -> list[str]:
    """Words of the text, A-Z in lower case, and one end."""
    text = text or ""
    return [*_find(text.lower() if text.isascii() else text.translate(_UPPER)), END]


def packed(numbers: np.ndarray) -> bytes:
    """Whole numbers as compressed planes of bytes: those that are mostly zero take next to nothing."""
    planes = np.ascontiguousarray(numbers).view(np.uint8).reshape(-1, numbers.itemsize).T.tobytes()
    return len(numbers).to_bytes(8, "little") + pa.compress(planes, codec="zstd", asbytes=True)


def unpacked(data: bytes, kind: type) -> np.ndarray:
    """The numbers of :func:`packed`."""
    n, size = int.from_bytes(data[:8], "little"), np.dtype(kind).itemsize
    planes = pa.decompress(memoryview(data)[8:], n * size, codec="zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(size, n).T).view(kind).ravel()


def packed_keys(keys: np.ndarray) -> bytes:
    """Ascending hashes, as the steps between them."""
    return packed(np.diff(keys, prepend=np.uint64(0)))


def unpacked_keys(data: bytes) -> np.ndarray:
    """The hashes of :func:`packed_keys`."""
    return np.cumsum(unpacked(data, np.uint64), dtype=np.uint64)


class Block:
    """The texts of a block: ``ids`` are numbers in its vocabulary, whose ``keys`` are in ascending order."""

    def __init__(self, ids: np.ndarray, keys: np.ndarray, docs: np.ndarray, known: np.ndarray, lengths: np.ndarray, held: np.ndarray) -> None:
        self.ids, self.keys, self.docs, self.known, self.lengths, self.held = ids, keys, docs, known, lengths, held.astype(bool)
        self.first = np.zeros(len(ids), bool)
        self.first[np.cumsum(lengths) - lengths] = True
        self.learned = ~np.repeat(self.held, lengths)

    @classmethod
    def of(cls, texts: list[tuple[int | None, bool, np.ndarray]], number: dict[str, int]) -> Block:
        """A block of (id, held out, token numbers); ``number`` names the words in the order of their numbers."""
        keys = np.fromiter((xxhash.xxh3_64_intdigest(w.encode("utf-8", "surrogatepass")) for w in number), np.uint64, len(number))
        order = np.argsort(keys)
        place = np.empty(len(order), np.int32)
        place[order] = np.arange(len(order), dtype=np.int32)
        docs, held, ids = zip(*texts, strict=True)
        return cls(place[np.concatenate(ids)], keys[order], np.array([x or 0 for x in docs], np.int64), np.array([x is not None for x in docs], np.uint8), np.array([len(x) for x in ids], np.int64), np.array(held, np.uint8))

    def write(self, fs, path: str) -> None:
        """The block as a file."""
        out = io.BytesIO()
        parts = {"ids": packed(self.ids), "keys": packed_keys(self.keys), "docs": packed(self.docs), "known": packed(self.known), "lengths": packed(self.lengths), "held": packed(self.held)}
        np.savez(out, **{k: np.frombuffer(v, np.uint8) for k, v in parts.items()})
        with fs.open_output_stream(path, compression=None) as f:
            f.write(out.getbuffer())

    @classmethod
    def read(cls, fs, path: str) -> Block:
        """The block of a file."""
        with fs.open_input_file(path) as f:
            parts = np.load(io.BytesIO(f.read()))
            kinds = {"ids": np.int32, "docs": np.int64, "known": np.uint8, "lengths": np.int64, "held": np.uint8}
            return cls(keys=unpacked_keys(parts["keys"].tobytes()), **{k: unpacked(parts[k].tobytes(), t) for k, t in kinds.items()})


def _joined(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Keys of grams that put a word after others: a hash of both keys."""
    x = (before ^ (before >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15) + word
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Walk:
    """What the automaton meets at each token of a block, order by order from the word alone upwards.

    ``c`` has, for each order above the first, the count of the state that the tokens before make (0: no state), and
    ``n`` the count of the arc that the token takes there (0: none). ``totals`` are the answers of the lower orders.
    """

    def __init__(self, block: Block, starts: int, totals: list[np.ndarray]) -> None:
        self.block = block
        self.gram_keys, self.place, self.live = block.keys, block.ids, None  # of the order that is asked for next
        self.c: list[np.ndarray] = []
        self.n: list[np.ndarray] = [totals[0][block.ids]] if totals else []
        key = block.keys[block.ids]
        for order in range(2, min(len(totals), len(STRENGTH)) + 2):
            before = np.empty(len(key), np.int64)
            before[1:] = self.n[-1][:-1]
            before[block.first] = starts if order == 2 else 0
            state = np.where(before >= LEAST, before, 0)
            self.c.append(state)
            history = np.empty(len(key), np.uint64)
            history[1:] = key[:-1] if order == 2 else self._keys[:-1]
            history[block.first] = START
            self._keys = _joined(history, block.keys[block.ids])
            self.live = state > 0
            self.gram_keys, self.place = np.unique(self._keys[self.live], return_inverse=True)
            if order <= len(totals):
                self.n.append(np.zeros(len(key), np.int64))
                self.n[-1][self.live] = totals[order - 1][self.place]

    def counts(self) -> np.ndarray:
        """How often each of ``gram_keys`` is in the texts learned from."""
        learned = self.block.learned if self.live is None else self.block.learned[self.live]
        return np.bincount(self.place[learned], minlength=len(self.gram_keys)).astype(np.int64)

    def weights(self, norm: int) -> tuple[np.ndarray, np.ndarray]:
        """Log-probabilities of the tokens at the root, and in the state that the walk is in."""
        p = [(self.n[0] + 1.0) / norm]
        for k, c, n in zip(STRENGTH, self.c, self.n[1:], strict=True):
            p.append(np.where(c > 0, (n + k * p[-1]) / (c + k), p[-1]))
        root, total = np.log10(p[0]), np.zeros(len(p[0]))
        waits = np.ones(len(total), bool)
        for k, c, n, arc in zip(reversed(STRENGTH), reversed(self.c), reversed(self.n), reversed(p), strict=False):
            in_state = waits & (c > 0)
            taken, failed = in_state & (n > 0), in_state & (n == 0)
            total[taken] += np.log10(arc[taken])
            total[failed] += np.log10(k / (c[failed] + k))
            waits &= ~taken
        total[waits] += root[waits]
        return root, total


FILES = "block string, path string, tokens long, starts long"


def blocks(docs: DataFrame, held_out: Column, *, id_col: str, text_col: str, block: int = BLOCK) -> tuple[DataFrame, str]:
    """Write the texts as block files. Returns their list, with ``starts``, the texts learned from, and their folder."""
    rows = docs.select(F.col(id_col).cast("long"), F.coalesce(held_out.cast("boolean"), F.lit(False)), F.col(text_col))
    uri = shared_path(docs.sparkSession, "lm-blocks")

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = open_store(uri)
        number: dict[str, int] = {}
        texts: list[tuple[int | None, bool, np.ndarray]] = []
        size = 0

        def flush() -> pa.RecordBatch:
            nonlocal number, texts, size
            fs.create_dir(base, recursive=True)
            name = uuid.uuid4().hex  # a file of an attempt that did not count is not in the list
            Block.of(texts, number).write(fs, f"{base}/{name}")
            row = {"block": [name], "path": [f"{base}/{name}"], "tokens": [size], "starts": [sum(not held for _, held, _ in texts)]}
            number, texts, size = {}, [], 0
            return pa.RecordBatch.from_pydict(row)

        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                for doc, out, text in zip(*(c.to_pylist() for c in batch.slice(at, 256).columns), strict=True):
                    words = tokens(text)
                    for w in set(words).difference(number):
                        number[w] = len(number)
                    texts.append((doc, out, np.fromiter(map(number.__getitem__, words), np.int32, len(words))))
                    size += len(words)
                    if size >= block:
                        yield flush()
        if texts:
            yield flush()

    return stored(rows.mapInArrow(build, FILES), "lm-files"), uri


CHUNKS = "range int, block string, keys binary, counts binary"
TOTALS = "block string, range int, gram int, totals binary, n long, v long"


def _answers(batch: pa.Table, orders: int) -> list[np.ndarray]:
    """A block's totals of the first ``orders`` orders, in the order of its keys."""
    rows = sorted(zip(batch["gram"].to_pylist(), batch["range"].to_pylist(), batch["totals"].to_pylist(), strict=True), key=lambda r: r[:2])
    return [np.concatenate([unpacked(t, np.int64) for g, _, t in rows if g == k] or [np.zeros(0, np.int64)]) for k in range(1, orders + 1)]


def _per_block(files: DataFrame, answers: DataFrame | None, work, schema: str) -> DataFrame:
    """``work(path, answers)`` for each block, whose results are tables; ``answers`` has the totals so far, if any."""
    if answers is None:

        def alone(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for name, path in zip(batch["block"].to_pylist(), batch["path"].to_pylist(), strict=True):
                    yield from work(name, path, None).to_batches()

        spread = files.repartition(files.sparkSession.sparkContext.defaultParallelism * 4, "block")
        return spread.select("block", "path").mapInArrow(alone, schema)
    both = lambda mine, totals: work(mine["block"][0].as_py(), mine["path"][0].as_py(), totals)
    return files.select("block", "path").groupBy("block").cogroup(answers.select("block", "range", "gram", "totals").groupBy("block")).applyInArrow(both, schema)


def totals(files: DataFrame, uri: str, answers: DataFrame | None, order: int, *, starts: int, bits: int) -> DataFrame:
    """Totals of the grams of ``order`` words, over all blocks, for each block that has them: rows of ``TOTALS``.

    ``n`` and ``v`` are the sum of the counts of a range and the number of its grams that were learned, once a range.
    """

    def ask(name: str, path: str, known: pa.Table | None) -> pa.Table:
        fs, _ = open_store(uri)
        walk = Walk(Block.read(fs, path), starts, [] if known is None else _answers(known, order - 1))
        keys, counts = walk.gram_keys, walk.counts()
        part = (keys >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)
        cuts = np.searchsorted(part, np.arange((1 << bits) + 1)).tolist()
        some = [(r, a, b) for r, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)) if a < b]
        columns = [pa.array([r for r, *_ in some], pa.int32()), pa.array([name] * len(some), pa.string()), pa.array([packed_keys(keys[a:b]) for _, a, b in some], pa.binary()), pa.array([packed(counts[a:b]) for _, a, b in some], pa.binary())]
        return pa.Table.from_arrays(columns, [c.split()[0] for c in CHUNKS.split(", ")])

    def answer(asked: pa.Table) -> pa.Table:
        chunks = [unpacked_keys(x) for x in asked["keys"].to_pylist()]
        counts = np.concatenate([unpacked(x, np.int64) for x in asked["counts"].to_pylist()])
        _, inverse = np.unique(np.concatenate(chunks), return_inverse=True)
        total = np.bincount(inverse, counts).astype(np.int64)  # exact below 2 ** 53
        back = np.split(total[inverse], np.cumsum([len(x) for x in chunks])[:-1])
        m = len(chunks)
        columns = [asked["block"].combine_chunks(), asked["range"].combine_chunks(), pa.array([order] * m, pa.int32()), pa.array([packed(x) for x in back], pa.binary()), pa.array([int(total.sum())] + [0] * (m - 1), pa.int64()), pa.array([int((total > 0).sum())] + [0] * (m - 1), pa.int64())]
        return pa.Table.from_arrays(columns, [c.split()[0] for c in TOTALS.split(", ")])

    return stored(_per_block(files, answers, ask, CHUNKS).groupBy("range").applyInArrow(answer, TOTALS), f"lm-totals-{order}")


SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def score(docs: DataFrame, held_out: Column, *, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """Scores of all rows of ``docs`` by a model of those that are not held out.

    Returns doc_id, held_out, n_tokens (the end counts), n_known, train_tokens, base_score (add-one unigrams) and score
    (the automaton). Null texts are empty: their only token is the end. Repeated rows count as often as they come.
    A null ``held_out`` counts as false. If all rows are held out, every token is unknown and both scores are those of
    one unseen word. Other columns are ignored; an empty table gives no rows.
    """
    files, uri = blocks(docs, held_out, id_col=id_col, text_col=text_col, block=block)
    size = files.agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("tokens"), F.coalesce(F.sum("starts"), F.lit(0)).alias("starts")).first()
    starts, bits = size.starts, max(0, math.ceil(math.log2(max(size.tokens, 1) / block)))
    answers = totals(files, uri, None, 1, starts=starts, bits=bits)
    n, v = answers.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("v"), F.lit(0))).first()
    for order in range(2, len(STRENGTH) + 2):
        answers = answers.unionByName(totals(files, uri, answers, order, starts=starts, bits=bits))

    def rate(_: str, path: str, known: pa.Table) -> pa.Table:
        fs, _ = open_store(uri)
        own = Block.read(fs, path)
        walk = Walk(own, starts, _answers(known, len(STRENGTH) + 1))
        root, weight = walk.weights(n + v + 1)
        begins = np.cumsum(own.lengths) - own.lengths
        doc = pa.array(own.docs, mask=own.known == 0)
        columns = [doc, own.held, own.lengths, np.add.reduceat((walk.n[0] > 0).astype(np.int64), begins), np.full(len(begins), n, np.int64), np.add.reduceat(root, begins), np.add.reduceat(weight, begins)]
        return pa.Table.from_arrays([pa.array(x) for x in columns], names=[k.split()[0] for k in SCORES.split(", ")])

    return _per_block(files, answers, rate, SCORES)
