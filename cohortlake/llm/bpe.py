"""Encoding and decoding with a public BPE tokenizer, reusing content-defined chunks.

Texts are cut where a rolling (gear) hash of the bytes before a word has zeros in its low
bits, so equal passages give equal chunks wherever they stand. Documents that share a
chunk are sent to the same task by the smallest chunk digest of each; there a chunk is
encoded once and its ids and decoded pieces are reused. Pieces meet at white space, and
every join is checked: the words around it are encoded together, and if that differs from
the two sides put together, the stretch is widened and encoded anew until it agrees.
"""

from __future__ import annotations

import functools
import hashlib
import importlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from cohortlake.llm.common import free_name, ship, table

#: On average one chunk in so many bytes; the hash looks at the 32 bytes before a cut.
CHUNK_BYTES = 2048
#: Bytes of encoded chunks, and number of encoded words, that a Python worker remembers at most.
STORE_BYTES, STORE_WORDS = 48 << 20, 400_000
#: Marks that are encoded apart from the letters before them.
MARKS = ".,!?:;%&$#*|"
GEAR = np.random.default_rng(8).integers(0, 1 << 32, 256, dtype=np.uint32)
_WHITE = np.zeros(256, dtype=bool)
_WHITE[[9, 10, 11, 12, 13, 32]] = True


def default_vocabulary() -> str:
    """The file of the public word-level vocabulary; another path can be given to every function here."""
    return importlib.import_module("public_tokenizers").path("word_bpe_49k.json")


def gear_hash(raw: np.ndarray) -> np.ndarray:
    """At each byte, the gear hash of the 32 bytes up to it, by doubling the window five times."""
    h = GEAR[raw]
    for k in (1, 2, 4, 8, 16):
        add = np.zeros_like(h)
        add[k:] = h[:-k] << np.uint32(k)
        h = h + add
    return h


def chunks(text: bytes, average: int = CHUNK_BYTES) -> list[bytes]:
    """The text cut at white space by content; put together, the chunks are the text."""
    if len(text) < average // 4:
        return [text] if text else []
    raw = np.frombuffer(text, dtype=np.uint8)
    # The top bits depend on all 32 bytes. Only white space may be a cut: about one byte in six.
    want = np.uint32((1 << 32) // max(1, average // 6))
    ends = np.flatnonzero(_WHITE[raw] & (gear_hash(raw) < want)) + 1
    at = [0, *ends.tolist()]
    if at[-1] != len(text):
        at.append(len(text))
    return [text[i:j] for i, j in zip(at, at[1:], strict=False)]


class Store:
    """A dictionary of at most ``limit`` units in two generations; the older one is dropped when the newer is full."""

    def __init__(self, limit: int):
        self.limit, self.size, self.new, self.old = limit // 2, 0, {}, {}

    def get(self, key):
        got = self.new.get(key)
        if got is None and (got := self.old.get(key)) is not None:
            self.put(key, got)
        return got

    def put(self, key, value, units: int = 1) -> None:
        if self.size >= self.limit:
            self.old, self.new, self.size = self.new, {}, 0
        self.new[key] = value
        self.size += units


class Codec:
    """Encodes whole texts to (count of ids, ids as text, decoded text), each as the library gives it.

    ``lower``: the vocabulary's normalizer lower-cases, so A-Z may be lower-cased first.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.added = [str(t).encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.words, self.store = Store(STORE_WORDS), Store(STORE_BYTES)
        size = max([-1, *self.tokenizer.get_vocab().values()]) + 1
        #: By id: a space and the number, a space and the piece.
        self.numbers = [b" %d" % i for i in range(size)]
        self.names = [b" " + (self.tokenizer.id_to_token(i) or "").encode() for i in range(size)]
        self.ends = [x.endswith(b"</w>") for x in self.names]
        self.splits, self.lower, self.spaced = self._drops_space(), self._same_lowered(), self._joins_by_space()

    def _drops_space(self) -> bool:
        """Whether white space never shows in the ids, so that words can be encoded on their own."""
        alone = self._encode(["ab", "cd"])
        return self._encode(["ab  cd\n"])[0] == alone[0] + alone[1]

    def _same_lowered(self) -> bool:
        return self._encode(["THE Cat"])[0] == self._encode(["the cat"])[0]

    def _joins_by_space(self) -> bool:
        """Whether decoding only puts a space between the pieces of the ids."""
        ids = self._encode(["abcxyz the (d) 12"])[0]
        return self.tokenizer.decode(ids, skip_special_tokens=False) == " ".join(map(self.tokenizer.id_to_token, ids))

    def _encode(self, texts: list[str]) -> list[list[int]]:
        # One by one: the library's own threads would take cores that Spark has given to other tasks.
        return [self.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]

    def _piece(self, ids: list[int]) -> tuple[bytes, bytes]:
        """Ids and pieces, each after a space."""
        numbers, names = self.numbers, self.names
        return b"".join([numbers[i] for i in ids]), b"".join([names[i] for i in ids])

    def _learn(self, words: set[bytes]) -> None:
        """Remember ids and pieces of new words. A word is its stem and the marks after it; letters and marks never merge."""
        stems: dict[str, tuple[bytes, bytes]] = {}
        parts = []
        for word in words:
            if self.words.get(word) is not None:  # it was in the older generation
                continue
            text = word.decode("utf-8", "surrogatepass")
            stem = text.rstrip(MARKS)
            parts.append((word, stem, text[len(stem):]) if stem.isalpha() else (word, text, ""))
        new = list(dict.fromkeys(x for part in parts for x in part[1:] if x))
        plain = [x for x in new if x.isalpha()]
        # Letters alone make one piece of text each, closed by an id that ends a word.
        ids = self.tokenizer.encode(" ".join(plain), add_special_tokens=False).ids
        ends = [k + 1 for k, i in enumerate(ids) if self.ends[i]]
        single = new
        if len(ends) == len(plain) and [len(ids)] == ends[-1:]:
            single = [x for x in new if not x.isalpha()]
            stems = {x: self._piece(ids[i:j]) for x, i, j in zip(plain, [0, *ends[:-1]], ends, strict=True)}
        stems.update((x, self._piece(i)) for x, i in zip(single, self._encode(single), strict=True))
        for word, stem, marks in parts:
            got = stems[stem]
            if marks:
                got = got[0] + stems[marks][0], got[1] + stems[marks][1]
            self.words.put(word, got)

    def _chunk(self, chunk: bytes) -> tuple[bytes, bytes]:
        """Ids and pieces of a chunk, word by word."""
        words = chunk.split()
        found = [*map(self.words.new.get, words)]
        if None in found:
            self._learn({w for w, x in zip(words, found, strict=True) if x is None})
            # One by one only if a chunk has more new words than the store holds.
            found = [self.words.get(w) or self._piece(self._encode([w.decode("utf-8", "surrogatepass")])[0]) for w in words]
        return b"".join([x[0] for x in found]), b"".join([x[1] for x in found])

    def _joined(self, left: bytes, right: bytes) -> bool:
        """Whether the words around a join encode together as on their own."""
        a, b = left.rsplit(None, 1)[-1:], right.split(None, 1)[:1]
        if not a or not b:
            return True
        together = self._encode([(a[0].rstrip() + b" " + b[0].rstrip()).decode("utf-8", "surrogatepass")])[0]
        return self._piece(together)[0] == self._chunk(a[0])[0] + self._chunk(b[0])[0]

    def encode_many(self, texts: list[str | None]) -> list[tuple[int, bytes, bytes]]:
        """``encode`` of each text; the words that are new in all of them are learnt together."""
        if self.splits and self.spaced:
            fresh: set[bytes] = set()
            for text in texts:
                fresh.update(self._raw(text).split())
                if len(fresh) > STORE_WORDS // 8:
                    self._learn(fresh.difference(self.words.new))
                    fresh.clear()
            self._learn(fresh.difference(self.words.new))
        return [self.encode(t) for t in texts]

    def _raw(self, text: str | None) -> bytes:
        raw = (text or "").encode("utf-8", "surrogatepass")
        # Added tokens are matched as they are spelled, so a text that may hold one keeps its case.
        return raw.lower() if self.lower and b"<|" not in raw else raw

    def encode(self, text: str | None) -> tuple[int, bytes, bytes]:
        raw = self._raw(text)
        if not self.splits or not self.spaced or any(t in raw for t in self.added):
            # Added tokens may take white space with them, and other vocabularies keep it.
            ids = self._encode([text or ""])[0]
            decoded = self.tokenizer.decode(ids, skip_special_tokens=False)
            return len(ids), b" ".join([b"%d" % i for i in ids]), decoded.encode()
        out: list[tuple[bytes, tuple[bytes, bytes]]] = []
        for part in chunks(raw):
            key = hashlib.blake2b(part, digest_size=16).digest()
            got = self.store.get(key)
            if got is None:
                got = self._chunk(part)
                self.store.put(key, got, len(got[0]) + len(got[1]) + 200)
            while out and not self._joined(out[-1][0], part):
                # Repair: encode the chunk before and this one as one stretch, then look at the join before it.
                part = out.pop()[0] + part
                got = self._piece(self._encode([part.decode("utf-8", "surrogatepass")])[0])
            out.append((part, got))
        ids = b"".join([g[0] for _, g in out])
        return ids.count(b" "), ids[1:], b"".join([g[1] for _, g in out])[1:]


@functools.lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    """One for each Python worker, so that its stores outlive a task."""
    return Codec(path)


def sketch(text: str | None) -> int:
    """The smallest digest of the text's chunks: texts that share most chunks mostly share it."""
    found = chunks((text or "").encode("utf-8", "surrogatepass"))
    return min((int.from_bytes(hashlib.blake2b(x, digest_size=8).digest(), "big", signed=True) for x in found), default=0)


def _mapped(docs: DataFrame, path: str | None, text: str, keep: list[str], columns: list[tuple[str, T.DataType]], result: Callable) -> DataFrame:
    """``keep`` and the columns that ``result`` makes of what the codec gives for each whole text."""
    ship(docs.sparkSession)
    path = path or default_vocabulary()
    kinds = {f.name: f for f in docs.schema.fields}
    mark, body = free_name("sketch", docs.columns), free_name("body", docs.columns)
    carried = docs.select(*keep, F.col(text).alias(body))

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = pa.array([sketch(t) for t in batch.column(body).to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, marks], names=[*batch.schema.names, mark])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = codec(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 128):  # ids and decoded text are several times the text
                part = batch.slice(at, 128)
                made = zip(*map(result, tool.encode_many(part.column(body).to_pylist())), strict=True)
                arrays = [pa.array(x, to_arrow_type(kind)) for x, (_, kind) in zip(made, columns, strict=True)]
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in keep], *arrays], names=[*keep, *[c for c, _ in columns]])

    first = T.StructType([*carried.schema.fields, T.StructField(mark, T.LongType())])
    last = T.StructType([*[kinds[c] for c in keep], *[T.StructField(*c) for c in columns]])
    return carried.mapInArrow(dealt, first).hint("rebalance", mark).mapInArrow(encode, last)


def encoded(docs: DataFrame, path: str | None = None, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns with ``n_tokens``, ``ids`` (array) and ``decoded`` of every whole text.

    A null text is an empty one: no ids, empty decoded text. Repeated rows give repeated
    rows, an empty table gives none. Other columns of the input are left out, whatever
    their names. Rows are dealt by their sketch with a rebalance, which cuts sketches that
    very many documents share into several tasks.
    """
    kinds = [("n_tokens", T.LongType()), ("ids", T.ArrayType(T.IntegerType())), ("decoded", T.StringType())]
    return _mapped(docs, path, text, list(keep), kinds, lambda g: (g[0], [int(i) for i in g[1].split()], g[2].decode()))


def digests(docs: DataFrame, path: str | None = None, text: str = "text") -> DataFrame:
    """One row per document: ``doc_id``, ``n_tokens``, ``ids_sha256``, ``decoded_sha256``.

    The digests are those of ``encoded``: of the decimal ids joined by one space, and of
    the decoded text in UTF-8. Nulls and repeated rows as there.
    """
    kinds = [("n_tokens", T.LongType()), ("ids_sha256", T.StringType()), ("decoded_sha256", T.StringType())]
    return _mapped(docs, path, text, ["doc_id"], kinds, lambda g: (g[0], hashlib.sha256(g[1]).hexdigest(), hashlib.sha256(g[2]).hexdigest()))


def op8_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return digests(table(spark, folder, "documents").select("doc_id", "text"))
